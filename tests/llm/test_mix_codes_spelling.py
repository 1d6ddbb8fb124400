"""Mixing, vector codes and spelling variants against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from litfunnel.llm import mixing, spelling, vector_codes

# -- mixing ---------------------------------------------------------------------------------------

DOCS = "doc_id long, source string, text string"


def plain_targets(sizes: dict, share=Fraction(3, 2), most=2) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    stopped: set = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        free = sum(weight[s] for s in order if s not in stopped)
        target = {s: Fraction(most * sizes[s]) if s in stopped else left * weight[s] / free for s in order}
        over = {s for s in order if s not in stopped and target[s] > most * sizes[s]}
        if not over:
            return target
        stopped |= over


def corpus(seed=5):
    r = random.Random(seed)
    rows = []
    for i in range(400):
        source = r.choice([None, "", "a", "B", "é", "zz", "zz", "zz", "zz"])
        rows.append((i, source, None if i % 41 == 0 else " ".join(["w"] * r.choice([0, 1, 3, r.randrange(40), r.randrange(300)]))))
    # Repeated rows, rows without an id, a source without words, a very long text.
    rows += [(7, "a", "x y z")] * 30 + [(None, "a", "x y")] * 25 + [(900 + i, "none", "\t \n") for i in range(3)] + [(999, "B", "w " * 8_000)]
    return rows


def test_mix_targets_and_sums(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit("clash")).withColumn("copies", F.lit(-1)).repartition(5)
    got = mixing.mixed_sizes(df, range_rows=7).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((x.doc_id, x.source, x.size) for x in got) == Counter((i, s, words(t)) for i, s, t in rows)
    sizes: Counter = Counter()
    for _, s, t in rows:
        sizes[s] += words(t)
    target = plain_targets(sizes)
    taken: Counter = Counter()
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(float(target[x.source]), rel=1e-12)
        assert x.taken == x.copies * x.size and 0 <= x.copies <= 2
        taken[x.source] += x.taken
    for s, t in target.items():
        # The source of the long text can come no nearer than half of it.
        assert abs(taken[s] - t) <= (4_000 if s == "B" else 0.5), s
    # The same rows in other partitions give the same result.
    key = lambda xs: Counter((x.doc_id, x.source, x.size, x.target, x.taken) for x in xs)
    assert key(mixing.mixed_sizes(df.repartition(2, "text"), range_rows=50).collect()) == key(got)
    assert key(mixing.mixed_sizes(df, seed=1, range_rows=7).collect()) != key(got)


def test_mix_is_nearest_for_few_documents(spark):
    r = random.Random(2)
    for trial in range(40):
        lengths = np.array(sorted(r.sample(range(1, 400), r.randrange(1, 9))))
        left = np.ones(len(lengths), np.int64)
        wanted = r.random() * lengths.sum()
        sums = [sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths.tolist(), k)]
        best = min(abs(x - wanted) for x in sums)
        assert abs(float((mixing.fitted(lengths, left, wanted) * lengths).sum()) - wanted) == pytest.approx(best), trial


def test_mix_fits_large_counts_and_long_documents():
    r = np.random.default_rng(3)
    lengths = np.unique(r.integers(1, 30_000, 4_000))
    left = r.integers(1, 50, len(lengths))
    for wanted in (12_345.0, 1e6, 3.3e8):
        assert abs(float((mixing.fitted(lengths, left, wanted) * lengths).sum()) - wanted) <= 0.5
    long = np.array([300_000, 310_007, 420_011, 500_000])
    taken = mixing.fitted(long, np.array([10, 10, 10, 10]), 3_000_000.0)
    assert (taken <= 10).all() and abs(float((taken * long).sum()) - 3_000_000) < 300_000


def test_mixture_rows(spark):
    rows = corpus(6)
    df = spark.createDataFrame(rows, DOCS).withColumn("_c", F.lit("x")).withColumn("target", F.lit(0))
    want: Counter = Counter()
    for x in mixing.mixed_sizes(df).collect():
        want[(x.doc_id, x.source, x.size)] += x.copies
    out = mixing.mixture(df)
    assert out.columns == df.columns
    got = Counter((x.doc_id, x.source, x.size) for x in out.withColumn("size", mixing.words_of(F.col("text"))).collect())
    assert got == +want


def test_mix_of_nothing(spark):
    assert mixing.mixed_sizes(spark.createDataFrame([], DOCS)).count() == 0
    none = mixing.mixed_sizes(spark.createDataFrame([(1, None, None), (2, "a", "")], DOCS)).collect()
    assert {(x.doc_id, x.target, x.taken) for x in none} == {(1, 0.0, 0), (2, 0.0, 0)}
    with pytest.raises(ValueError):
        mixing.judged(spark.createDataFrame([], DOCS), weights=(1, 0))


# -- vector codes ---------------------------------------------------------------------------------


def plain_codes(rows, entries, rounds, parts=4):
    kept = [(i, [math.floor(Fraction(x) * 1024) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    firsts = {}
    for i, v, _ in kept:
        firsts[i] = min(v, firsts.get(i, v))
    ids = sorted(firsts, key=lambda i: (i is None, i or 0))[:entries]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(firsts[i], p) for i in ids] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups: dict = {}
            for _, v, _ in kept:
                groups.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else b for k, b in enumerate(books[p])]
    out, by_label = [], Counter()
    for i, v, lab in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        by_label[lab] += out[-1][3]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter((i, c, e, by_label[lab], digest) for i, lab, c, e in out)


VECTORS = "vec_id long, embedding array<double>, label string"


@pytest.mark.parametrize("scale", [0.2, 30_000.0, 1e12])
def test_codes_against_plain(spark, scale):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, scale) for _ in range(8)], r.choice([None, "a", "b"])) for i in range(90)]
    rows += [rows[0], (3, [0.0] * 8, "b"), (None, [scale] * 8, None), (200, None, "a"), (201, [1.0, None] * 4, "a"), (202, [float("nan")] * 8, "a"), (203, [float("inf")] + [0.0] * 7, "a")]
    df = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("clash")).withColumn("error", F.lit(1)).repartition(4)
    got = Counter((x.vec_id, x.code, x.error, x.label_error, x.codebooks_sha256) for x in vector_codes.compressed(df, entries=12, rounds=3, block=7).collect())
    want = plain_codes(rows, 12, 3)
    if scale < 1e12:
        assert got == want
    else:  # errors beyond 64 bits are null
        assert {(i, c, d) for i, c, _, _, d in got} == {(i, c, d) for i, c, _, _, d in want} and all(e is None or e < 1 << 63 for _, _, e, _, _ in got)


def test_codes_of_odd_vectors(spark):
    assert vector_codes.compressed(spark.createDataFrame([], VECTORS)).count() == 0
    odd = vector_codes.compressed(spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], "a"), (2, [1.0], "a"), (3, [], None)], VECTORS)).collect()
    assert {(x.vec_id, x.code, x.error) for x in odd} == {(1, "00000000", 0), (2, None, None), (3, None, None)}
    none = vector_codes.compressed(spark.createDataFrame([(1, [], "a"), (2, [], "a")], VECTORS)).collect()
    assert {(x.code, x.error, x.label_error) for x in none} == {("00000000", 0, 0)}
    uneven = vector_codes.compressed(spark.createDataFrame([(1, [1.0, 2.0], "a")], VECTORS)).collect()
    assert [(x.code, x.codebooks_sha256) for x in uneven] == [(None, None)]


def test_label_sums_of_many_labels(spark):
    codes = spark.createDataFrame([(i, None if i % 3 else "x", "c", i) for i in range(60)], "vec_id long, label string, code string, error long")
    few, many = (sorted((x.vec_id, x.label_error) for x in vector_codes.with_label_error(codes, most).collect()) for most in (10, 1))
    assert few == many and len(few) == 60


# -- spelling variants ----------------------------------------------------------------------------


def plain_variants(docs, least=6, least_count=5, stronger=5, every=199):
    n: Counter = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % every == 0 else w] += 1
    words = {w: c for w, c in n.items() if len(w) >= least and c >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    found = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in found.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= stronger * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(found[w]), words[form[w]] if form[w] else None))
    return out


def spelt(rows):
    return {(x.word, x.form, x.root, x.n, x.n_near, x.form_n) for x in rows}


def test_variants_against_plain(spark):
    r = random.Random(4)
    base = ["straße", "Übermut", "aaaaaa", "aabbaa", "banana", "strasse", "naïveté", "wörter", "×××÷÷÷", "llllll" * 40]
    docs = []
    for i in range(150):
        words = []
        for _ in range(60):
            w = r.choice(base)
            for _ in range(r.choice([0, 0, 0, 0, 1, 2])):
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("abé") + w[k + 1 :], w[:k] + r.choice("alß") + w[k:]])
            words.append(w.upper() if w.isascii() and r.random() < 0.2 else w)
        docs.append((i if i % 9 else None, r.choice([" ", "1", "\n", "_", "ſ"]).join(words)))
    docs += [(500, None), (501, ""), (502, "12 34"), (503, "short a bc")] + [docs[3]] * 2
    long = "".join(r.choice("abc") for _ in range(3000))
    docs += [(600 + k, f"{long} {long[:1500]}{long[1501:]}") for k in range(6)]
    docs += [(700 + k, "zzzzyy " * 50 + "zzzzzy " * 8 + "zzzzzz") for k in range(6)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(0)).repartition(6)
    want = plain_variants(docs, every=19)
    assert spelt(spelling.spelling_variants(df, every=19).collect()) == want
    assert any(f and ro != f for _, f, ro, *_ in want) and max(k for *_, k, _ in want) > 5


def test_bitmap_rules_out_no_word(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "kitten mitten sitten kittens smitten bitten") for i in range(6)], "doc_id long, text string")
    want = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert spelt(spelling.spelling_variants(docs).collect()) == want
    # A bitmap that is far too small lets all through: the join alone decides.
    monkeypatch.setattr(spelling, "MOST_BITS", 1 << 15)
    monkeypatch.setattr(spelling, "BITS_PER_WORD", 1)
    monkeypatch.setattr(spelling, "bitmap", lambda vocab, bits, probes: np.full((1 << bits) // 8, 255, np.uint8))
    monkeypatch.setattr(spelling, "BLOCK", 16)
    assert spelt(spelling.spelling_variants(docs).collect()) == want


def test_variants_are_distinct_and_whole():
    alphabet = np.array([ord(c) for c in "abc"], np.uint64)
    every = np.full(1 << 12, 255, np.uint8)
    for word in ("a", "abca", "aab", "ccc"):
        codes = np.array([[ord(c) for c in word]], np.uint64)
        made = []
        for kind, _, i, a in spelling.variants(codes, alphabet, every, 15, 1):
            after = 0 if kind == "insertion" else 1
            made += [word[:p] + ("" if kind == "deletion" else chr(x)) + word[p + after :] for p, x in zip(i.tolist(), a.tolist(), strict=True)]
        size = len(word)
        want = {word[:i] + word[i + 1 :] for i in range(size)} | {word[:i] + c + word[i + 1 :] for i in range(size) for c in "abc"} | {word[:i] + c + word[i:] for i in range(size + 1) for c in "abc"}
        assert len(made) == len(set(made)) and set(made) == want - {word}


def test_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, "once only")], "doc_id long, text string")).count() == 0
