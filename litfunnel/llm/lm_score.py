"""Cross-entropy difference of documents under two matched bigram models.

The background model is counted over all documents, the target model over those marked as
target; both share the vocabulary (every word of the corpus), order, smoothing and cutoff:
p(b | a) = (n(a, b) + M u(b)) / (n(a) + M) with u(b) = (n(b) + w / V) / (N + w), where pairs seen
less than CUTOFF times in the corpus don't count. A document's score is the mean over its words
of log p(background) - log p(target): the lower, the more it resembles the target.

Only the HEAD most frequent words, and the pairs among the FREQUENT first of them, are shipped to
all tasks; they decide what travels, not what counts. A task sums up what follows from them and
deals the rest by key, where all uses of a key meet:
- pairs of two head words by pair; pairs of a rarer and a head word by pair;
- every use of a rarer word by that word, with a hash of the word before it, so that the counts of
  the word and of its pairs are known in one place.
What a key adds to a document goes back to the document's batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import BROADCAST_ROWS, discard, hidden, short_batches, slices, staged, texts_of
from litfunnel.llm.words import coded_words

#: Words shipped to all tasks, the place of the rarer ones included.
HEAD = 1 << 16
#: The most frequent words, whose pairs are counted beforehand.
FREQUENT = 1024
#: Pairs seen less often in the corpus are left to the words.
CUTOFF = 2
#: Weight of the word distribution in a pair's distribution, and of the uniform in the word's.
BIGRAM_MASS, WORD_MASS = 50.0, 1.0
SHARD_BYTES, LEAST_SHARDS = 6 << 20, 512
BATCH_BYTES, BATCH_DOCS = 5 << 20, 1 << 15
TARGET = 1 << 15
_STEP = np.uint64(0x9E3779B97F4A7C15)


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BATCH_BYTES):
        for i in range(0, batch.num_rows, BATCH_DOCS):
            yield batch.slice(i, BATCH_DOCS)


def target_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("target").to_numpy(zero_copy_only=False).astype(bool)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, target_n) over all texts, counted in each batch before anything is shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            words, codes, bounds = coded_words(texts_of(batch.column("text")))
            inside = np.repeat(target_of(batch), np.diff(bounds))
            counts = [pa.array(np.bincount(c, minlength=len(words))) for c in (codes, codes[inside])]
            yield pa.record_batch([pa.array(words, pa.string()), *counts], names=["word", "n", "target_n"])

    rows = docs.select("text", "target").mapInArrow(counted, "word string, n long, target_n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("target_n").alias("target_n"))


class Models:
    """What each task needs of both models: bounded by HEAD and FREQUENT."""

    def __init__(self, words: list[str], counts: np.ndarray, totals: np.ndarray, distinct: int, cutoff: int):
        """Counts (background, target) have the rarer words at 0; words go by falling frequency."""
        self.ids = {w: i + 1 for i, w in enumerate(words)}
        self.totals, self.distinct, self.cutoff = totals.astype(float), distinct, cutoff
        self.share = self.share_of(counts)
        self.context = np.log(counts + BIGRAM_MASS)
        self.frequent = np.zeros((FREQUENT, FREQUENT), np.float32)

    def share_of(self, counts: np.ndarray) -> np.ndarray:
        """u of both models from the counts of words."""
        return (counts + WORD_MASS / (self.distinct + 1)) / (self.totals[:, None] + WORD_MASS)

    def gain(self, pairs: np.ndarray, share: np.ndarray) -> np.ndarray:
        """What counted pairs add to log p(background) - log p(target)."""
        mass = BIGRAM_MASS * share
        more = np.log(pairs + mass) - np.log(mass)
        return np.where(pairs[0] >= self.cutoff, more[0] - more[1], 0.0)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Head number (0: a rarer word) and 48-bit hash (0: a head word) of each word, and the bounds of texts."""
        words, codes, bounds = coded_words(texts)
        head = np.fromiter((self.ids.get(w, 0) for w in words), np.int64, len(words))
        rare = np.fromiter((0 if i else xxhash.xxh3_64_intdigest(w) >> 16 | 1 for w, i in zip(words, head.tolist(), strict=True)), np.uint64, len(words))
        return head[codes], rare[codes], bounds


def fitted_words(docs: DataFrame, head: int = HEAD, cutoff: int = CUTOFF) -> Models:
    """The word level of both models; at most head words reach the driver."""
    if not 1 < head <= HEAD:
        raise ValueError(f"head must lie in 2..{HEAD}: pair keys have 16 bits for a head word")
    both = staged(word_counts(docs), "words")
    top = both.orderBy(F.desc("n"), "word").limit(head - 1).toPandas().sort_values(["n", "word"], ascending=[False, True])
    n, target_n, distinct = both.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("target_n"), F.lit(0)), F.count("*")).first()
    discard(both)
    totals = np.array([n, target_n])
    own = np.array([top["n"].to_numpy(np.int64), top["target_n"].to_numpy(np.int64)])
    return Models(top["word"].tolist(), np.c_[totals - own.sum(1), own], totals, distinct, cutoff)


def neighbours(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each word has one before it, and one after it, in its text."""
    before, after = np.ones(n, bool), np.ones(n, bool)
    full = bounds[:-1] < bounds[1:]
    before[bounds[:-1][full]], after[bounds[1:][full] - 1] = False, False
    return before, after


def frequent_pairs(docs: DataFrame, models: Models) -> np.ndarray:
    """What the pairs of the FREQUENT most frequent words add, by their counts over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, FREQUENT * FREQUENT), np.int32)
        for batch in batches_of(batches):
            head, _, bounds = shared.value.codes(texts_of(batch.column("text")))
            inside = np.repeat(target_of(batch), np.diff(bounds))
            before, _ = neighbours(bounds, len(head))
            at = np.flatnonzero(before)
            at = at[(head[at] > 0) & (head[at] < FREQUENT) & (head[at - 1] > 0) & (head[at - 1] < FREQUENT)]
            pair = head[at - 1] * FREQUENT + head[at]
            for k, own in ((0, pair), (1, pair[inside[at]])):
                found, n = np.unique(own, return_counts=True)
                total[k, found] += n.astype(np.int32)
        held = np.flatnonzero(total[0])
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(total[0, held]), pa.array(total[1, held])], names=["pair", "n", "target_n"])

    rows = docs.select("text", "target").mapInArrow(counted, "pair int, n int, target_n int").groupBy("pair").agg(F.sum("n").alias("n"), F.sum("target_n").alias("target_n")).toPandas()
    pair = rows["pair"].to_numpy(np.int64)
    out = np.zeros(FREQUENT * FREQUENT, np.float32)
    out[pair] = models.gain(np.array([rows["n"], rows["target_n"]], float), models.share[:, pair % FREQUENT])
    return out.reshape(FREQUENT, FREQUENT)


SENT = pa.schema([
    ("shard", pa.int32()), ("batch", pa.int64()), ("pairs", pa.binary()), ("rare_pairs", pa.binary()), ("words", pa.binary()), ("befores", pa.binary()), ("owners", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int32())), ("sums", pa.list_(pa.float64())),
])
SENT_SQL = "shard int, batch long, pairs binary, rare_pairs binary, words binary, befores binary, owners binary, doc_ids array<long>, tokens array<int>, sums array<double>"


def dealt(shard: np.ndarray, shards: int, *columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The columns in order of shard, and where each shard begins."""
    order = np.argsort(shard, kind="stable")
    return np.searchsorted(shard[order], np.arange(shards + 1)), [c[order] for c in columns]


def sent(docs: DataFrame, models: Models, shards: int) -> DataFrame:
    """Rows for the shards, and for each batch one row with what needs no shard."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batch_no = TaskContext.get().partitionId() << 24
        for batch in batches_of(batches):
            m = shared.value
            head, rare, bounds = m.codes(texts_of(batch.column("text")))
            n = np.diff(bounds)
            text = np.repeat(np.arange(len(n)), n)
            owner = (text + np.where(target_of(batch), TARGET, 0)[text]).astype("<u2")
            before, after = neighbours(bounds, len(head))
            first = np.r_[0, head[:-1]] if len(head) else head
            # Words by themselves: the mass that each gives to what follows it, and its own share.
            own = np.where(head > 0, np.log(m.share[0])[head] - np.log(m.share[1])[head], 0.0)
            own -= np.where((head > 0) & after, (m.context[0] - m.context[1])[head], 0.0)
            near = before & (first > 0) & (first < FREQUENT) & (head > 0) & (head < FREQUENT)
            own[near] += m.frequent[first[near], head[near]]
            columns = {"shard": [batch_no % shards], "batch": [batch_no], "doc_ids": [batch.column("doc_id").to_pylist()], "tokens": [n.tolist()], "sums": [np.bincount(text, own, len(n)).tolist()]}
            yield pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None]), f.type) for f in SENT], schema=SENT)
            previous = np.r_[np.uint64(0), rare[:-1]] if len(rare) else rare
            at = np.flatnonzero(before & (first > 0) & (head > 0) & ~near)
            key = (first[at] << 16 | head[at]).astype("<u4")
            e1, (pairs, o1) = dealt((key.astype(np.uint64) * _STEP >> np.uint64(33)) % np.uint64(shards), shards, key, owner[at])
            at = np.flatnonzero(before & (previous > 0) & (head > 0))
            key = previous[at] << np.uint64(16) | head[at].astype(np.uint64)
            e2, (rare_pairs, o2) = dealt((key * _STEP >> np.uint64(33)) % np.uint64(shards), shards, key, owner[at])
            at = np.flatnonzero(rare > 0)
            word = rare[at] << np.uint64(16) | before[at].astype(np.uint64) | after[at].astype(np.uint64) << np.uint64(1)
            hashed = ((previous[at] + first[at].astype(np.uint64)) * _STEP >> np.uint64(32)).astype("<u4")
            e3, (words, befores, o3) = dealt(rare[at] % np.uint64(shards), shards, word, hashed, owner[at])
            used = np.flatnonzero((e1[1:] > e1[:-1]) | (e2[1:] > e2[:-1]) | (e3[1:] > e3[:-1])).tolist()
            for i in range(0, len(used), 256):
                part = used[i : i + 256]
                cut = lambda e, c: [c[e[k] : e[k + 1]].tobytes() for k in part]  # noqa: E731, B023
                owners = [x + y + z for x, y, z in zip(cut(e1, o1), cut(e2, o2), cut(e3, o3), strict=True)]
                columns = {"shard": part, "batch": [batch_no] * len(part), "pairs": cut(e1, pairs), "rare_pairs": cut(e2, rare_pairs), "words": cut(e3, words), "befores": cut(e3, befores), "owners": owners}
                yield pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * len(part)), f.type) for f in SENT], schema=SENT)
            batch_no += 1

    return docs.select("doc_id", "text", "target").mapInArrow(rows, SENT_SQL)


GAINED = pa.schema([("batch", pa.int64()), ("owners", pa.binary()), ("gains", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int32())), ("sums", pa.list_(pa.float64()))])
GAINED_SQL = "batch long, owners binary, gains binary, doc_ids array<long>, tokens array<int>, sums array<double>"


def counted_by(key: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Background and target counts of each distinct key, in both rows, and the place of each use's key."""
    _, which = np.unique(key, return_inverse=True)
    return np.array([np.bincount(which), np.bincount(which, target)], float), which


def pair_gains(m: Models, key: np.ndarray, target: np.ndarray) -> np.ndarray:
    n, which = counted_by(key, target)
    second = np.empty(n.shape[1], np.int64)
    second[which] = (key & key.dtype.type(0xFFFF)).astype(np.int64)
    return m.gain(n, m.share[:, second])[which]


def word_gains(m: Models, word: np.ndarray, hashed: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What each use of a rarer word adds: its share, its pair with the word before it, its mass for the one after it."""
    n, which = counted_by(word >> np.uint64(16), target)
    share = m.share_of(n)
    context = np.log(n + BIGRAM_MASS)
    before, after = (word & np.uint64(1)) > 0, (word & np.uint64(2)) > 0
    out = (np.log(share[0]) - np.log(share[1]))[which] - np.where(after, (context[0] - context[1])[which], 0.0)
    at = np.flatnonzero(before)
    pairs, pair = counted_by(which[at].astype(np.uint64) << np.uint64(32) | hashed[at], target[at])
    of_pair = np.empty(pairs.shape[1], np.int64)
    of_pair[pair] = which[at]
    out[at] += m.gain(pairs, share[:, of_pair])[pair]
    return out


def shard_gains(table: pa.Table, m: Models) -> pa.Table:
    """One shard: what its keys add to the documents of each batch."""
    heads = table.filter(table["doc_ids"].is_valid())
    out = [pa.RecordBatch.from_arrays([r.column(f.name) if f.name in r.schema.names else pa.nulls(r.num_rows, f.type) for f in GAINED], schema=GAINED) for r in heads.to_batches()]
    table = table.filter(table["doc_ids"].is_null())
    if table.num_rows:
        column = lambda name, kind: [np.frombuffer(x, kind) for x in table[name].to_pylist()]
        pairs, rare, words, befores, owners = column("pairs", "<u4"), column("rare_pairs", np.uint64), column("words", np.uint64), column("befores", "<u4"), column("owners", "<u2")
        # Owners lie row by row; keys are counted kind by kind.
        cuts = [(len(a), len(a) + len(b)) for a, b in zip(pairs, rare, strict=True)]
        split = [[o[:a] for o, (a, _) in zip(owners, cuts, strict=True)], [o[a:b] for o, (a, b) in zip(owners, cuts, strict=True)], [o[b:] for o, (_, b) in zip(owners, cuts, strict=True)]]
        o1, o2, o3 = map(np.concatenate, split)
        gains = [pair_gains(m, np.concatenate(pairs), o1 >= TARGET), pair_gains(m, np.concatenate(rare), o2 >= TARGET), word_gains(m, np.concatenate(words), np.concatenate(befores), o3 >= TARGET)]
        row = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in split]
        key, which = np.unique(np.concatenate(row) * TARGET + (np.concatenate([o1, o2, o3]) & (TARGET - 1)), return_inverse=True)
        total = np.bincount(which, np.concatenate(gains))
        real = total != 0
        key, total = key[real], total[real].astype("<f4")
        edges = np.searchsorted(key, np.arange(table.num_rows + 1) * TARGET)
        used = np.flatnonzero(np.diff(edges)).tolist()
        owner, batches = (key % TARGET).astype("<u2"), table["batch"].to_numpy()[used]
        columns = {"batch": batches, "owners": [owner[edges[i] : edges[i + 1]].tobytes() for i in used], "gains": [total[edges[i] : edges[i + 1]].tobytes() for i in used]}
        out.append(pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(used), f.type) for f in GAINED], schema=GAINED))
    return pa.Table.from_batches(out, GAINED)


def batch_scores(table: pa.Table) -> pa.Table:
    """One row per document from the rows of its batch."""
    head = table.filter(table["doc_ids"].is_valid())
    sums = np.array(head["sums"][0].as_py(), float)
    rest = table.filter(table["doc_ids"].is_null())
    for owners, gains in zip(rest["owners"].to_pylist(), rest["gains"].to_pylist(), strict=True):
        sums[np.frombuffer(owners, "<u2")] += np.frombuffer(gains, "<f4")
    tokens = np.array(head["tokens"][0].as_py(), np.int64)
    return pa.table({"doc_id": pa.array(head["doc_ids"][0].as_py(), pa.int64()), "n_tokens": tokens, "score": np.where(tokens > 0, sums / np.maximum(tokens, 1), 0.0)})


def cross_entropy_difference(docs: DataFrame, target: str = "target", head: int = HEAD, cutoff: int = CUTOFF) -> DataFrame:
    """One row per document: doc_id, n_tokens, score (mean log p(background) - log p(target)).

    docs needs doc_id, text and a boolean column that marks the target's documents (null: no);
    other columns are ignored. Both models are counted over all their texts and all words.
    Texts without words, null included, have n_tokens 0 and score 0. Repeated rows and null
    doc_ids are scored like any row. An empty target gives every word the uniform share. An
    empty table gives no rows. head changes what travels, not the scores.
    """
    docs = short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col(target), F.lit(False)).alias("target"))
    models = fitted_words(docs, head, cutoff)
    models.frequent = frequent_pairs(docs, models)
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(LEAST_SHARDS, int(volume * 1.2) // SHARD_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    gained = sent(docs, models, shards).groupBy("shard").applyInArrow(lambda t: shard_gains(t, shared.value), GAINED_SQL)
    return gained.groupBy("batch").applyInArrow(batch_scores, "doc_id long, n_tokens long, score double")


def with_target(docs: DataFrame, labels: DataFrame, column: str = "target") -> DataFrame:
    """docs with a column that marks those labelled as of high quality. Up to BROADCAST_ROWS
    labelled identifiers are broadcast, more are joined; repeated labels count once."""
    name = hidden()
    good = staged(labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias(name)).distinct(), "target")
    few = good.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    docs = docs.drop(column)
    return docs.join(F.broadcast(good) if few else good.hint("merge"), docs["doc_id"] == good[name], "left").select(*docs.columns, F.col(name).isNotNull().alias(column))
