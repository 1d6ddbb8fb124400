import gzip
import json

from pyspark.sql import functions as F

from litfunnel.operators import core, ingest, relevance, signals
from litfunnel.sources import raw_files
from litfunnel.sources.keyed_table import KeyedTable

A, B, C = "a" * 16, "b" * 16, "c" * 16


def put(root, day, name, body):
    folder = root / "ror" / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(gzip.compress(body.encode()))


def test_newest_file_of_each_request(spark, tmp_path):
    put(tmp_path, "2024/01/02", f"20240102T000000Z_{A}_x.json.gz", '{"v": 2}')
    put(tmp_path, "2024/01/01", f"20240101T230000Z_{A}_x.json.gz", '{"v": 1}')
    put(tmp_path, "2024/01/01", f"20240101T000000Z_{B}_y_z.json.gz", '{"v": 3}')
    put(tmp_path, "2024/01/03", f"20240103T000000Z_{B}_y_z.json.gz", '{"v": ')
    put(tmp_path, "2024/01/03", f"20240103T000000Z_{C}_.json.gz", "")
    put(tmp_path, "2024/01/03", "notes.json.gz", "{}")
    got = {r.request: r for r in raw_files.newest_responses(spark, str(tmp_path)).collect()}
    assert (json.loads(got[A].payload), got[A].entity, got[A].error) == ({"v": 2}, "x", None)
    assert (got[B].payload, got[B].entity, got[B].error) == (None, "y_z", raw_files.BROKEN)
    assert set(got) == {A, B, C} and got[C].error == raw_files.BROKEN
    only = raw_files.newest_responses(spark, str(tmp_path), spark.createDataFrame([(A,), (A,), ("d" * 16,)], "request string"))
    assert [r.request for r in only.collect()] == [A]


def test_response_names_are_read_back(spark):
    r = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05' AS t").select(raw_files.response_name(F.col("t"), F.lit(A), F.lit("10.1/é " + "x" * 80)).alias("n")).first().n
    assert r == f"20240102T030405Z_{A}_10.1_é_{'x' * 53}.json.gz"


def test_feed_days_missing_and_broken(spark, tmp_path):
    for day, text in (("2024-01-01", '[{"paper": {"id": "1"}}]\n\n[]\n'), ("2024-01-03", '[{"paper"\n{"a": 1}\n[{"paper": {"id": "2"}}]\n'), ("2024-02-01", "[]\n")):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "f.txt").write_text(text)
    got = raw_files.feed_lines(spark, str(tmp_path), signals.feed_days("2024-01-01", "2024-01-02", "2024-01-04"))
    rows = sorted((str(r.day), r.body or "", r.error or "") for r in got.collect())
    assert rows == [("2024-01-01", "[]", ""), ("2024-01-01", '[{"paper": {"id": "1"}}]', ""), ("2024-01-02", "", "missing"), ("2024-01-03", "", "not valid JSON"), ("2024-01-03", "", "not valid JSON"), ("2024-01-03", '[{"paper": {"id": "2"}}]', ""), ("2024-01-04", "", "missing")]


def test_json_policy_keeps_types(spark):
    s = "k long, m string"
    old = spark.createDataFrame([(1, '{"a": 1, "b": {"x": [1]}}'), (2, None), (3, '{"a": 1}'), (4, "no")], s)
    new = spark.createDataFrame([(1, '{"c": true, "a": "z"}'), (2, '{"a": 2}'), (4, '{"q": null}'), (5, '{"n": 1.5}')], s)
    got = {r.k: r.m and json.loads(r.m) for r in core.merged(old, new, "k", {"m": "json"}).collect()}
    assert got == {1: {"a": "z", "b": {"x": [1]}, "c": True}, 2: {"a": 2}, 3: {"a": 1}, 4: {"q": None}, 5: {"n": 1.5}}


def test_scores_merge_their_reasons(spark, tmp_path):
    kept = KeyedTable.create(spark, str(tmp_path / "s"), "k long, ai_relevance double, scoring_reason string, scored_at string", ["k"], 4)
    kept.replace(spark.createDataFrame([(1, 2.0, '{"judge": "x", "via": "old"}', "t0")], "k long, ai_relevance double, scoring_reason string, scored_at string"))
    scored = spark.createDataFrame([(1, 7.5, "why"), (2, 1.0, "no")], "k long, relevance_score double, relevance_reason string")
    kept.upsert(relevance.score_rows(scored, "k", "here", F.lit("t1")), relevance.SCORE_POLICIES)
    got = {r.k: (r.ai_relevance, json.loads(r.scoring_reason), r.scored_at) for r in kept.read().collect()}
    assert got == {1: (7.5, {"judge": "x", "via": "here", "relevance_reason": "why"}, "t1"), 2: (1.0, {"relevance_reason": "no", "via": "here"}, "t1")}


def test_distinct_across_sets(spark):
    ids = ["2401.00001", "2401.00002", "2401.0001", "math/0001001", None, ""]
    rows = [(s, i, False, ["cs.LG"], c) for s, own in (("cs", ids), ("stat", ids[:1] + ids[3:4])) for i in own for c in ("2023-05-01", "2024-01-01")]
    rows += [("cs", "2401.00009", True, ["cs.LG"], None), ("cs", "2401.00008", False, ["q-bio.X"], None)]
    parsed = spark.createDataFrame(rows, "s string, arxiv_id string, deleted boolean, categories array<string>, created string")
    got = {r.set_spec: r for r in ingest.projected_harvest(parsed, "s", 10, 2024).collect()}
    cs, whole = got["cs"], got[None]
    assert (cs.seen, cs.deleted, cs.kept, cs.revision, cs.unique) == (14, 5, 8, 4, 4)
    assert (whole.seen, whole.kept, whole.unique, whole.projected_unique, whole.projected_revision, whole.projected_new) == (18, 12, 5, 50, 25, 25)
    empty = ingest.projected_harvest(parsed.where("false"), "s", 10, 2024).collect()
    assert [(r.seen, r.unique, r.projected_new) for r in empty] == [(0, 0, 0)]
