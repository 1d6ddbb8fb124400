"""The registered queries as they stand: the contracts of their columns, against SQL or plain Python."""

import collections
import hashlib
import random
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from litfunnel.llm import toxicity
from litfunnel.llm.common import tokenizer_path
from litfunnel.llm.queries import ORACLE, QUERIES
from tests.llm.test_llm import components, edit_distance_within, plain_record, plain_spans
from tests.test_queries import rows

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(ORACLE[name]).df())


@needs_data
def test_op1_formats_control_strings(spark):
    r = QUERIES["op1_chat_format"](spark, SF).where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars) == (2, len(said))
    assert r.turns_sha256 == hashlib.sha256("".join(f"{x}\n{said}\n" for x in ("user", "assistant")).encode()).hexdigest()
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


@needs_data
def test_op2_columns(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    assert set(got) == {i for i, _ in documents}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


@needs_data
def test_op3_finds_only_what_is_there(spark, duck, documents):
    from litfunnel.llm.words import coded_words

    def words(text):
        distinct, codes, _ = coded_words([text])
        return [distinct[c] for c in codes]

    texts, items = dict(documents), dict(duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    found = QUERIES["op3_decontaminate"](spark, SF).collect()
    for r in found:
        item, stretch = words(items[r.item_id]), words(texts[r.doc_id])[r.first_word : r.end_word]
        assert r.edits == edit_distance_within(item, stretch) <= int(0.2 * len(item)) and r.item_words == len(item)
    # Items that stand word for word in a document are found.
    shown = {(r.doc_id, r.item_id) for r in found}
    plain = {i: " ".join(words(t)) for i, t in texts.items()}
    whole = {(d, i) for d, t in plain.items() for i, x in items.items() if f" {' '.join(words(x))} " in f" {t} "}
    assert whole and whole <= shown


@needs_data
def test_op4_scores_every_document(spark, documents):
    got = QUERIES["op4_lm_score"](spark, SF).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(i for i, _ in documents)
    assert all(np.isfinite(r.score) for r in got)


@needs_data
def test_op5_and_op7_against_the_tokenizer(spark, documents):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokenizer_path())
    ids = {i: np.array([*tk.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in documents}
    held = collections.defaultdict(int)
    for r in QUERIES["op5_pack"](spark, SF).collect():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id]) and r.offset + r.length <= 2048
        held[r.doc_id] += r.length
    assert held == {i: len(x) for i, x in ids.items()}
    tk.encode_special_tokens = True
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op7_token_counts"](spark, SF).collect()}
    assert counts == {i: len(tk.encode(t, add_special_tokens=False).ids) for i, t in documents}


@needs_data
def test_op9_digests_against_hashlib(spark, duck):
    pages = duck.execute("SELECT page_id, url, html FROM pages").fetchall()
    want = collections.Counter((p, hashlib.sha256(plain_record(u, h)).hexdigest()) for p, u, h in pages)
    got = [r for r in QUERIES["op9_warc_fixity"](spark, SF).collect() if r.status != "extra"]
    assert {(r.page_id, r.record_sha256) for r in got} == set(want)
    for r in got:
        assert (r.replica_sha256 is None) == (r.status == "missing") and (r.replica_sha256 == r.record_sha256) == (r.status in ("ok", "moved"))


@needs_data
def test_op10_base_spans_against_a_plain_scanner(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op10_secret_scan"](spark, SF).collect()}
    for i, t in documents:
        spans = plain_spans(t)
        kinds = collections.Counter(k for _, k, _ in spans)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
        assert {f"{k}:{s}:{e}" for s, k, e in spans} <= set(got[i].spans.split(",")) | {""}


@pytest.fixture
def fixture_dir(spark, tmp_path):
    """Documents with toxic texts, exact and near copies, benchmark passages, nulls, and clashing columns."""
    r = random.Random(12)
    words = ["w" + str(i) for i in range(900)]
    items = [(i, " ".join(r.choices(words, k=r.randint(8, 25)))) for i in range(6)]
    base = [r.choices(words, k=r.randint(40, 90)) for _ in range(150)]
    texts = [" ".join(w) for w in base]
    for i in range(0, 150, 5):
        w = list(base[i])
        for _ in range(8):
            w[r.randrange(len(w))] = r.choice(["vile", "nasty", "rotten"])
        texts[i] = " ".join(w)
    toxic = set(range(0, 150, 5))
    for i in range(1, 150, 10):
        texts.append(texts[i].replace(" ", "  \n", 3))  # exact copies
        near = texts[i + 1].split()
        near[len(near) // 2] = "changed" + str(i)
        texts.append(" ".join(near))
    for i in range(3, 150, 25):
        texts[i] += " " + items[i % 6][1]
    texts += [None, "", "   ", "one"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 0.5) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, _digest string, score double")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), texts, items


def test_pipeline_against_a_plain_version(spark, fixture_dir):
    sf, texts, items = fixture_dir
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    kept = [i for i, t in enumerate(texts) if model.probability(np.array([model.evidence(t or "", {})]))[0] < corpus_pipeline.TOXIC_FROM]
    assert 10 < len(texts) - len(kept) < 50
    first = {}
    for i in kept:
        first.setdefault(" ".join((texts[i] or "").replace("\n", " ").split(" ")).replace("   ", " ").replace("  ", " "), i)
    kept = sorted({i for i in first.values()})
    of, n = components([texts[i] for i in kept], 5, 80)
    kept = [i for k, i in enumerate(kept) if of[k] == k or not n[k]]
    plain = lambda t: (t or "").lower().split()
    kept = [i for i in kept if not any(edit_distance_within(x.split(), plain(texts[i])) <= int(0.2 * len(x.split())) for _, x in items)]
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == set(kept)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "decontaminate", "pack"]
    # Each stage but the last gives rows and columns of documents, values included.
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.subtract(docs).isEmpty()


def test_pipeline_of_nothing(spark, fixture_dir):
    sf, _, _ = fixture_dir
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_columns_that_clash_keep_their_values(spark):
    d = spark.createDataFrame([(1, "a b c d e", "p", "q", "r"), (1, "a b c d e", "p", "q", "r"), (2, "a  b c d e", "s", "t", "u"), (None, None, None, None, None), (3, "", "v", "w", "x")], "doc_id long, text string, _digest string, _sha string, _keep string")
    from litfunnel.llm import exact_dedup, ngram_join

    once = [tuple(x) for x in exact_dedup.without_duplicates(d).collect()]
    assert sorted(once, key=str) == sorted([(1, "a b c d e", "p", "q", "r"), (3, "", "v", "w", "x")], key=str)
    renamed = d.withColumnsRenamed({"_digest": "_key", "_sha": "_id", "_keep": "text_key"})
    near = [tuple(x) for x in ngram_join.one_of_each(renamed).collect()]
    assert collections.Counter(near) == collections.Counter([(1, "a b c d e", "p", "q", "r")] * 2 + [(3, "", "v", "w", "x"), (None,) * 5])
    empty = d.limit(0).withColumn("target", F.lit(True))
    assert exact_dedup.without_duplicates(empty).count() == ngram_join.one_of_each(empty).count() == 0
