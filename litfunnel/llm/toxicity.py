"""Toxicity by maximum-scoring segments.

Tokens get log-odds between toxic and clean documents under an informative Dirichlet prior;
a word and its leading characters are features, so that words built on a toxic stem count
before they were ever seen. One linear scan of a document finds every maximal scoring
segment; under the extreme-value law a segment of score S in n tokens has the expectation
K n exp(-lambda S); the document's score is a logistic of its summed significance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import short_batches, slices, staged, texts_of

WORD = re.compile(r"\w+")
#: Size of the token table: a model holds so many numbers, whatever the corpus.
BUCKETS = 1 << 19
STEMS = (3, 4, 5, 6, 7)
#: Where the checksums of words and of stems of each length begin, so that equal letters differ by length.
WHOLE, BEGUN = zlib.crc32(b"99:"), tuple((n, zlib.crc32(f"{n}:".encode())) for n in STEMS)
#: Pseudo-counts: so many in each bucket, and so many more dealt by the bucket's share of the corpus.
PRIOR_EACH, PRIOR = 0.5, 500.0
#: Standard errors by which log-odds are drawn towards zero.
SHRINK = 1.5
#: Taken from each token's log-odds, so that clean text scores below zero.
DRIFT = 0.7
#: Bound on the labelled documents a model is fitted on (those with the least hash of doc_id).
FIT_ROWS = 20_000
CACHE_WORDS = 100_000


def features(word: str) -> list[int]:
    """Buckets of the word and of its stems."""
    size = len(word)
    if word.isascii():
        letters = word.encode()
        return [zlib.crc32(letters[:99], WHOLE) % BUCKETS, *[zlib.crc32(letters[:n], begun) % BUCKETS for n, begun in BEGUN if n < size]]
    return [zlib.crc32(word[:99].encode(), WHOLE) % BUCKETS, *[zlib.crc32(word[:n].encode(), begun) % BUCKETS for n, begun in BEGUN if n < size]]


def log_odds(toxic: np.ndarray, clean: np.ndarray, corpus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each bucket and its standard error, the prior in proportion to the corpus."""
    alpha = PRIOR_EACH + PRIOR * corpus / max(corpus.sum(), 1)
    n1, n0 = toxic.sum() + alpha.sum(), clean.sum() + alpha.sum()
    y1, y0 = toxic + alpha, clean + alpha
    delta = np.log(y1 / (n1 - y1)) - np.log(y0 / (n0 - y0))
    return delta, np.sqrt(1 / y1 + 1 / y0)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time.

    Runs of one sign are summed first; then each positive run is joined leftwards as long as
    the stretch gains by it.
    """
    if not len(scores):
        return []
    sign = scores > 0
    if not sign.any():
        return []
    cut = np.flatnonzero(np.r_[True, sign[1:] != sign[:-1]])
    sums, ends = np.add.reduceat(scores, cut), np.r_[cut[1:], len(scores)]
    held: list[tuple[int, int, float, float]] = []  # start, end, total before start, total at end
    total = 0.0
    above = bool(sign[0])
    for a, b, s in zip(cut.tolist(), ends.tolist(), sums.tolist(), strict=True):
        start, left, right = a, total, total + s
        total, above = right, not above
        if above:  # this run was below zero
            continue
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= left:
                j -= 1
            if j < 0 or held[j][3] >= right:
                held.append((start, b, left, right))
                break
            start, left = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, right - left) for a, b, left, right in held]


def best_segment(scores: np.ndarray) -> float:
    """Score of the best segment, 0 if no token scores above zero."""
    if not len(scores):
        return 0.0
    total = np.cumsum(scores)
    return max(float((total - np.minimum(np.minimum.accumulate(total), 0.0)).max()), 0.0)


@dataclass
class Model:
    """Bounded: two arrays of BUCKETS numbers and four parameters. Once words are scored, the arrays stay as they are."""

    delta: np.ndarray
    error: np.ndarray
    rate: float = 1.0  # lambda
    scale: float = 0.1  # K
    slope: float = 1.0
    intercept: float = -1.0

    @cached_property
    def of_buckets(self) -> tuple[memoryview, memoryview]:
        """How sure each bucket's log-odds are, and what they give a token."""
        d, e = self.delta.astype(float), SHRINK * self.error.astype(float)
        given = np.where(d > e, d - e, np.where(d < -e, d + e, 0.0)) - DRIFT
        return memoryview(np.abs(self.delta / self.error)), memoryview(given)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "of_buckets"}

    def word_score(self, word: str) -> float:
        """What the surest of the word's buckets (the first of several) gives."""
        sure, given = self.of_buckets
        return given[max(features(word), key=sure.__getitem__)]

    def scores(self, text: str, cache: dict[str, float]) -> np.ndarray:
        words = WORD.findall(text.lower())
        for w in set(words).difference(cache):
            cache[w] = self.word_score(w)
        out = np.fromiter(map(cache.__getitem__, words), float, len(words))
        if len(cache) > CACHE_WORDS:
            cache.clear()
        return out

    def significant(self, text: str, cache: dict[str, float], at_most: float = 1.0) -> tuple[list[tuple[int, int, float]], int]:
        """Segments (first token, end token, -log of the expectation) whose expectation is below at_most; tokens."""
        s = self.scores(text, cache)
        base = np.log(max(self.scale * len(s), 1e-9))
        # Most texts have no segment that could be significant; sums of runs and of tokens differ by rounding.
        if self.rate * (best_segment(s) + 1e-6) - base <= -np.log(at_most):
            return [], len(s)
        return [(a, b, e) for a, b, x in maximal_segments(s) if (e := self.rate * x - base) > -np.log(at_most)], len(s)

    def evidence(self, text: str, cache: dict[str, float]) -> float:
        return sum(e for _, _, e in self.significant(text, cache)[0])

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(evidence) + self.intercept, -30, 30)))


def fitted_rows(docs: DataFrame, labels: DataFrame, at_most: int = FIT_ROWS) -> DataFrame:
    """(text, toxic, tuning) of at most at_most labelled documents outside the held-out third.

    Labels of one document are one (toxic if any says so); rows without id or label fall out.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seal = F.crc32(F.col("doc_id").cast("string"))
    known = known.where(seal % 3 != 1).withColumn("tuning", F.floor(seal / 3) % 4 == 0)
    bounded = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)
    bounded = bounded.select(F.col("doc_id").alias("_doc"), "toxic", "tuning")
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return d.join(F.broadcast(bounded), d["doc_id"] == bounded["_doc"]).select("text", "toxic", "tuning")


def corpus_counts(docs: DataFrame) -> np.ndarray:
    """In how many documents each bucket's words occur, over all documents; at most BUCKETS rows reach the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        cache: dict[str, list[int]] = {}
        for batch in slices(batches, "text"):
            words: Counter[str] = Counter()
            for text in texts_of(batch.column("text")):
                words.update(set(WORD.findall(text.lower())))
            found = []
            for w in words:
                f = cache.get(w)
                if f is None:
                    f = features(w)
                    if len(cache) < CACHE_WORDS:
                        cache[w] = f
                found.append(f)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((b for f in found for b in f), np.int64, int(sizes.sum()))
            np.add.at(n, flat, np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes))
        b = np.flatnonzero(n)
        yield pa.record_batch([pa.array(b.astype(np.int32)), pa.array(n[b])], names=["bucket", "n"])

    sums = short_batches(docs).select("text").mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS)
    out[sums["bucket"].to_numpy(int)] = sums["n"]
    return out


def fit(docs: DataFrame, labels: DataFrame, at_most: int = FIT_ROWS) -> Model:
    """A model from a bounded sample of labelled documents; three quarters give the log-odds,
    the last quarter, which they never saw, the extreme-value law and the logistic. The prior
    is counted over all documents."""
    rows = staged(fitted_rows(docs, labels, at_most), "toxic-fit")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BUCKETS), np.int64)
        cache: dict[str, list[int]] = {}
        for batch in slices(batches, "text"):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                for w in set(WORD.findall(text.lower())):
                    if w not in cache:
                        cache[w] = features(w)
                        if len(cache) > CACHE_WORDS:
                            cache = {w: cache[w]}
                    n[int(toxic), cache[w]] += 1
        b = np.flatnonzero(n.any(0))
        yield pa.record_batch([pa.array(b.astype(np.int32)), pa.array(n[1, b]), pa.array(n[0, b])], names=["bucket", "toxic", "clean"])

    sums = rows.where("NOT tuning").select("text", "toxic").mapInArrow(counted, "bucket int, toxic long, clean long").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toPandas()
    counts = np.zeros((2, BUCKETS))
    counts[:, sums["bucket"].to_numpy(int)] = sums["toxic"].to_numpy(), sums["clean"].to_numpy()
    delta, error = log_odds(counts[0], counts[1], corpus_counts(docs))
    model = Model(delta.astype(np.float32), error.astype(np.float32))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in slices(batches, "text"):
            out = []
            for text in batch.column("text").to_pylist():
                s = shared.value.scores(text, cache)
                out.append(([x for _, _, x in maximal_segments(s)], len(s)))
            yield pa.record_batch([batch.column("toxic"), pa.array([x for x, _ in out], pa.list_(pa.float64())), pa.array([n for _, n in out], pa.int64())], names=["toxic", "segments", "tokens"])

    tuned = staged(rows.where("tuning").select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(best, "toxic int, segments array<double>, tokens long"), "toxic-segments")
    tops = tuned.select("toxic", "tokens", F.coalesce(F.array_max("segments"), F.lit(0.0)).alias("top")).toPandas()
    set_law(model, tops["toxic"].to_numpy(int), tops["top"].to_numpy(float), tops["tokens"].to_numpy(int))
    base = F.log(F.greatest(F.lit(model.scale) * F.col("tokens"), F.lit(1e-9)))
    summed = F.aggregate("segments", F.lit(0.0), lambda total, x: total + F.greatest(F.lit(model.rate) * x - base, F.lit(0.0)))
    evidence = tuned.select("toxic", summed.alias("evidence")).toPandas()
    set_logistic(model, evidence["toxic"].to_numpy(int), evidence["evidence"].to_numpy(float))
    return model


def set_law(model: Model, toxic: np.ndarray, top: np.ndarray, tokens: np.ndarray) -> None:
    """Set lambda and K by the method of moments on clean maxima."""
    clean = (toxic == 0) & (tokens > 0)
    if clean.sum() >= 20:
        shifted = top[clean]
        spread = max(float(shifted.std()), 0.15)
        model.rate = float(np.pi / (np.sqrt(6) * spread))
        mode = shifted.mean() - 0.5772 * spread * np.sqrt(6) / np.pi
        model.scale = float(np.exp(model.rate * mode) / np.exp(np.log(tokens[clean]).mean()))


def set_logistic(model: Model, toxic: np.ndarray, evidence: np.ndarray) -> None:
    """Set the logistic on the summed significance of all segments."""
    x, y = np.log1p(evidence), toxic.astype(float)
    if 0 < y.sum() < len(y):
        w = np.zeros(2)
        design = np.c_[x, np.ones(len(x))]
        for _ in range(50):  # Newton steps with a light ridge
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(2), design.T @ (y - p) - 0.05 * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        model.slope, model.intercept = max(float(w[0]), 1e-3), float(w[1])


def score_toxicity(docs: DataFrame, model: Model, score_column: str = "score") -> DataFrame:
    """docs with a score column, 0 to 1; all columns are kept, and an own column of that name is replaced.

    Null text counts as empty and gets the model's score of no evidence.
    """
    docs = short_batches(docs.drop(score_column))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in slices(batches, "text"):
            evidence = np.array([shared.value.evidence(t, cache) for t in texts_of(batch.column("text"))])
            columns = [*batch.columns, pa.array(shared.value.probability(evidence), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, score_column])

    from pyspark.sql.types import DoubleType, StructType

    return docs.mapInArrow(scored, StructType([*docs.schema.fields]).add(score_column, DoubleType()))


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where the words of the lower-case text stand in the text itself. One character may become several
    in lower case; a word that begins or ends inside such a character takes all of it."""
    low = text.lower()
    spans = [m.span() for m in WORD.finditer(low)]
    if len(low) == len(text):
        return spans
    ends = np.cumsum([len(c.lower()) for c in text])
    at = np.array(spans, np.int64).reshape(-1, 2)
    first, last = np.searchsorted(ends, at[:, 0], "right"), np.searchsorted(ends, at[:, 1] - 1, "right") + 1
    return list(zip(first.tolist(), last.tolist(), strict=True))


def toxic_passages(docs: DataFrame, model: Model, at_most: float = 0.01) -> DataFrame:
    """One row per significant passage: doc_id, start, end (code points of the text as it stands), significance
    (-log of the expectation), passage.

    Null and empty texts and those without words have none; texts are read whole. Repeated rows give their
    passages again, a null doc_id stays null, other columns are ignored. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                segments, _ = shared.value.significant(text, cache, at_most)
                if segments:
                    spans = word_spans(text)
                    rows += [(doc_id, spans[a][0], spans[b - 1][1], e, text[spans[a][0] : spans[b - 1][1]]) for a, b, e in segments]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.string()]
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "end", "significance", "passage"])

    return docs.select("doc_id", "text").mapInArrow(found, "doc_id long, start int, end int, significance double, passage string")
