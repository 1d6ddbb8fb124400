"""Spelling variants by full neighbourhood generation.

1. Words are counted over all texts; partial counts are made before anything is shuffled.
2. Of every word, all strings that one deletion, replacement or insertion of a letter of the observed
   alphabet makes are generated, each once, as hashes: for a polynomial hash all variants of a block
   of words are a few array sums. A bitmap of the vocabulary's hashes, whose size is bounded, rules
   out nearly all that aren't words; only the others become strings.
3. An equi-join of these strings with the vocabulary is the answer: a string that joins is a word one
   edit away, so distances need no check, and what the bitmap let through by chance finds no partner.
4. Forms are followed to their roots by pointer doubling.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import BROADCAST_ROWS, discard, hidden, staged

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, STRONGER = 6, 5, 5
#: Of the runs of a document, those whose checksum this divides lose a letter.
TYPO_EVERY = 199
#: Bits of the bitmap for each word, and the most there are: 128 MB. Beyond, it lets more through, and the join decides.
BITS_PER_WORD, MOST_BITS = 64, 1 << 30
PROBES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Variants hashed at once, and words of one task.
BLOCK, TASK_WORDS = 1 << 18, 20_000
#: Bits of one row of Spark's bitmap aggregates.
BUCKET_BITS = 32_768


def runs_of(docs: DataFrame, least: int = LEAST_LETTERS, every: int = TYPO_EVERY) -> DataFrame:
    """word: the runs of at least so many letters, A-Z in lower case, of every text, after the letter that some of
    them lose; what is left may be one letter shorter."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.translate(F.coalesce("text", F.lit("")), upper, upper.lower())
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all(low, F.lit(f"([{LETTERS}]{{{least},}})"), F.lit(1))).alias("w"))
    runs = runs.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "w").cast("binary")))
    at = (F.col("h") % F.length("w")).cast("int")
    return runs.select(F.when(F.col("h") % every == 0, F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))).otherwise(F.col("w")).alias("word"))


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, every: int = TYPO_EVERY) -> DataFrame:
    """word, n of the words of at least so many letters that occur at least so often."""
    return runs_of(docs, least, every).where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points (word, letter) of the words of each length."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.array([words[i] for i in at], f"U{size}").view(np.uint32).reshape(len(at), size).astype(np.uint64)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def probed(hashes: np.ndarray, probe: int, bits: int) -> np.ndarray:
    return (hashes * np.uint64(probe)) >> np.uint64(64 - bits)


def bitmap_bits(words: int) -> tuple[int, int]:
    """Width of bitmap places in bits, and probes: several where there is room, one where words are many."""
    bits = max(15, min(MOST_BITS, words * BITS_PER_WORD).bit_length())
    bits = min(bits, MOST_BITS.bit_length() - 1)
    return bits, len(PROBES) if (1 << bits) >= 16 * words else 1


def bitmap(vocab: DataFrame, bits: int, probes: int) -> np.ndarray:
    """The places of all words, as bytes; built by bitmap aggregates in the tasks."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes in by_length(batch.column("word").to_pylist()):
                hashes = (codes * powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)
                for probe in PROBES[:probes]:
                    yield pa.record_batch([pa.array(probed(hashes, probe, bits).astype(np.int64) + 1)], names=["place"])

    set_bits = vocab.select("word").mapInArrow(places, "place long").groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("held"))
    out = np.zeros((max(1, (1 << bits) // BUCKET_BITS), BUCKET_BITS // 8), np.uint8)
    for row in set_bits.toLocalIterator():
        out[row["bucket"] - 1] = np.frombuffer(row["held"], np.uint8)
    return out.ravel()


def held(hashes: np.ndarray, held_bits: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Places, in the flattened hashes, of those that the bitmap may hold."""
    flat = hashes.ravel()
    found = np.arange(0)
    for k, probe in enumerate(PROBES[:probes]):
        place = probed(flat if k == 0 else flat[found], probe, bits)
        hit = np.flatnonzero((held_bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
        found = hit if k == 0 else found[hit]
    return found


def variants(codes: np.ndarray, alphabet: np.ndarray, held_bits: np.ndarray, bits: int, probes: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, word, place, letter) of the deletions, replacements and insertions of words of one length that the
    bitmap may hold, each string once: of equal neighbours only the first counts as deleted, and none
    is inserted behind its like."""
    rows, size = codes.shape
    step = max(1, BLOCK // ((size + 1) * len(alphabet)))
    width = max(1, BLOCK // len(alphabet))
    power = powers(size + 1)
    for top in range(0, rows, step):
        c = codes[top : top + step]
        value = c * power[:size]
        ahead = np.zeros((len(c), size + 1), np.uint64)
        np.cumsum(value, axis=1, out=ahead[:, 1:])
        total = ahead[:, -1:]
        w, i = np.divmod(held(ahead[:, :-1] + np.uint64(BASE_INVERSE) * (total - ahead[:, 1:]), held_bits, bits, probes), size)
        fresh = (i == 0) | (c[w, i] != c[w, i - 1])
        yield "deletion", w[fresh] + top, i[fresh], np.zeros(fresh.sum(), np.uint64)
        for left in range(0, size + 1, width):
            right = min(left + width, size + 1)
            letters = power[left:right, None] * alphabet[None, :]
            for kind, base in (("replacement", (total - value)[:, left:right]), ("insertion", (ahead + np.uint64(BASE) * (total - ahead))[:, left:right])):
                at, a = np.divmod(held(base[:, :, None] + letters[None, : base.shape[1]], held_bits, bits, probes), len(alphabet))
                w, i = np.divmod(at, max(1, base.shape[1]))
                i += left
                fresh = alphabet[a] != c[w, i] if kind == "replacement" else (i == 0) | (alphabet[a] != c[w, i - 1])
                yield kind, w[fresh] + top, i[fresh], alphabet[a[fresh]]


def neighbourhood(vocab: DataFrame, alphabet: Sequence[str], sent: Broadcast, bits: int, probes: int) -> DataFrame:
    """word, near: the strings one edit from a word that the bitmap doesn't rule out."""
    letters = np.array([ord(a) for a in alphabet], np.uint64)

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for at, codes in by_length(words):
                for kind, ws, places, added in variants(codes, letters, sent.value, bits, probes):
                    if not len(ws):
                        continue
                    own = [words[at[w]] for w in ws]
                    after = 0 if kind == "insertion" else 1
                    put = [""] * len(own) if kind == "deletion" else [chr(x) for x in added]
                    near = [x[:i] + a + x[i + after :] for x, i, a in zip(own, places.tolist(), put, strict=True)]
                    yield pa.record_batch([pa.array(own), pa.array(near)], names=["word", "near"])

    return vocab.select("word").mapInArrow(generate, "word string, near string")


def near_words(vocab: DataFrame) -> DataFrame:
    """word, near, near_n: every pair of words of vocab (word, n; a staged table) that one edit tells apart, both ways round.

    Words are distinct and not null. The alphabet is that of the words: at most as many values as there are letters.
    """
    count = vocab.count()
    alphabet = sorted(r[0] for r in vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("a")).where("a <> ''").distinct().collect())
    if not alphabet:
        return vocab.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).where("false")
    bits, probes = bitmap_bits(count)
    sent = vocab.sparkSession.sparkContext.broadcast(bitmap(vocab, bits, probes))
    found = neighbourhood(vocab.repartition(-(-count // TASK_WORDS), "word"), alphabet, sent, bits, probes)
    right = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.join(F.broadcast(right) if count <= BROADCAST_ROWS else right, "near").select("word", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of the words that have a form: the last of the forms that follow each other. A staged table.

    forms: word, form, without nulls; no word may come back to itself. Each round doubles the way that
    is known, so there are as many rounds as the logarithm of the longest way.
    """
    way = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        small = way.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        on = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = staged(way.join(F.broadcast(on) if small else on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        discard(way)
        way = longer
        if way.where("moved").isEmpty():
            return way.select("word", "root")


def spelling_variants(docs: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, stronger: int = STRONGER, every: int = TYPO_EVERY) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of docs (doc_id, text; other columns are ignored).

    A word's form is its near word of largest n, of equal ones the first in code-point order, if that n is
    at least stronger (2 or more) times its own; its root is the last of the forms that follow, the word
    itself where there is none. Null and empty texts have no words; a null doc_id counts as empty in
    checksums. Rows that repeat are rows. Texts are read whole, words may be of any length. An empty
    table gives no rows.
    """
    if stronger < 2:
        raise ValueError("a form must occur at least twice as often as the word")
    vocab = staged(vocabulary(docs, least, least_count, every), "vocabulary")
    best: Column = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_words(vocab).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = vocab.join(near, "word", "left")
    follows = -F.col("best.less") >= stronger * F.col("n")
    judged = staged(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(follows, F.col("best.near")).alias("form"), F.when(follows, -F.col("best.less")).alias("form_n")), "judged")
    discard(vocab)
    own = hidden()
    ends = roots(judged.where("form IS NOT NULL")).withColumnRenamed("word", own)
    small = ends.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    out = judged.join(F.broadcast(ends) if small else ends, F.col("word") == F.col(own), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
