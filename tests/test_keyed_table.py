import os

import pytest
from pyspark.sql import functions as F

from litfunnel.operators import ledger
from litfunnel.operators.core import latest_per_key
from litfunnel.sources.keyed_table import KeyedTable, VersionTaken
from litfunnel.streaming.projection import first_seen, keep_projection, read_projection

SCHEMA = "k long, a string, b string"
POLICIES = {"a": "new", "b": "fill"}


@pytest.fixture
def kept(spark, tmp_path):
    return KeyedTable.create(spark, str(tmp_path / "t"), SCHEMA, ["k"], 8)


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def content(table, version=None):
    return sorted(map(tuple, table.read(version).collect()))


def test_upsert_twice_changes_nothing(spark, kept):
    new = rows(spark, *[(i, f"a{i}", "") for i in range(100)])
    assert kept.upsert(new, POLICIES) == 1
    before = kept.manifest()
    assert kept.upsert(new, POLICIES) == 1 and kept.manifest() == before
    assert kept.read().count() == 100


def test_only_touched_buckets_are_written(spark, kept):
    kept.upsert(rows(spark, *[(i, "x", "y") for i in range(200)]), POLICIES)
    one = kept.manifest()["folders"]
    kept.upsert(rows(spark, (7, None, "z"), (8, "new", None)), POLICIES)
    two = kept.manifest()["folders"]
    assert sum(one[b] != two[b] for b in one) == 1  # key 7 keeps both of its values
    got = {r.k: (r.a, r.b) for r in kept.read().collect()}
    assert len(got) == 200 and got[7] == ("x", "y") and got[8] == ("new", "y")
    assert {r.k: r.a for r in kept.read(1).collect()}[8] == "x"


def test_bad_keys_leave_the_table(spark, kept):
    kept.upsert(rows(spark, (1, "a", "b")), POLICIES)
    for bad in ([(None, "a", "b")], [(2, "a", "b"), (2, "c", "d")], [(1, "a", "b"), (1, "c", "b")]):
        with pytest.raises(ValueError):
            kept.upsert(rows(spark, *bad), POLICIES)
    assert kept.versions() == [0, 1] and content(kept) == [(1, "a", "b")]


def test_second_writer_of_a_version_fails(spark, kept):
    stale = kept.manifest() | {"version": 1}
    kept.replace(rows(spark, (1, "a", None)))
    with pytest.raises(VersionTaken):
        kept._publish(stale)
    with pytest.raises(VersionTaken):
        KeyedTable.create(spark, kept.path, SCHEMA, ["k"])
    assert content(kept) == [(1, "a", None)]


def test_empty_change_types_and_vacuum(spark, kept):
    assert kept.replace(rows(spark)) == 0 and content(kept) == []
    kept.replace(spark.createDataFrame([(1, "a", "extra", "b")], "k int, a string, other string, b string"))
    kept.replace(rows(spark, (1, "c", "b")))
    assert content(kept, 1) == [(1, "a", "b")] and content(kept) == [(1, "c", "b")]
    assert kept.vacuum() == 1 and kept.versions() == [2] and content(kept) == [(1, "c", "b")]


def test_numbered_changes_are_applied_once(spark, kept):
    more = lambda old, new: new.join(old.withColumnRenamed("a", "was").drop("b"), "k", "left").withColumn("a", F.concat(F.coalesce("was", F.lit("")), "a"))
    one = rows(spark, (1, "a", None))
    kept.change(one, more, applied=("w", 0))
    kept.change(one, more, applied=("w", 0))
    kept.change(one, more, applied=("w", 1))
    assert content(kept) == [(1, "aa", None)]


def test_checkpoints_of_windows(spark, tmp_path):
    kept = ledger.checkpoint_table(spark, str(tmp_path / "cp"), 4)
    windows = spark.createDataFrame([("oai", "cs", "2024-01-01", "2024-01-07"), ("oai", "cs", "2024-01-08", "2024-01-14")], "source string, set_spec string, window_from string, window_until string")
    ledger.start_windows(kept, windows, F.lit("t1"))
    assert {r.status for r in kept.read().collect()} == {"RUNNING"}
    done = windows.withColumn("status", F.when(F.col("window_from") == "2024-01-01", "COMPLETE").otherwise("FAILED")).withColumn("error", F.when(F.col("status") == "FAILED", F.repeat(F.lit("x"), 3000)))
    done = done.select("*", F.lit(5).alias("seen"), F.lit(4).alias("kept"), F.lit(3).alias("new"), F.lit(1).alias("dupe"))
    ledger.finish_windows(kept, done, F.lit("t2"))
    got = {r.window_from: r for r in kept.read().collect()}
    first, second = got["2024-01-01"], got["2024-01-08"]
    assert (first.status, first.seen, first.started_at, first.ended_at, first.error) == ("COMPLETE", 5, "t1", "t2", None)
    assert second.status == "FAILED" and len(second.error) == 2000
    assert [r.window_from for r in ledger.unfinished(windows, kept).collect()] == ["2024-01-08"]
    assert ledger.unfinished(windows, kept, force=True).count() == 2
    ledger.start_windows(kept, ledger.unfinished(windows, kept), F.lit("t3"))
    again = {r.window_from: r for r in kept.read().collect()}["2024-01-08"]
    assert (again.status, again.seen, again.error, again.started_at, again.ended_at) == ("RUNNING", 0, None, "t3", None)


def test_projection_writes_changed_buckets_and_survives_replay(spark, tmp_path):
    batches = [[(i, 1, "a") for i in range(50)], [(3, 2, "b"), (4, 0, "late"), (99, 1, "n")], [(3, 2, "b"), (4, 1, "a")]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, "k long, at long, v string").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
        for f in (tmp_path / "in" / str(i)).iterdir():
            os.utime(f, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    log = spark.readStream.schema("k long, at long, v string").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = lambda checkpoint: keep_projection(log, ["k"], "at", "v", str(tmp_path / "out"), str(tmp_path / checkpoint), 16).awaitTermination(120)
    run("one")
    whole = spark.createDataFrame([r for b in batches for r in b], "k long, at long, v string")
    want = sorted(map(tuple, latest_per_key(whole, ["k"], "at", "v").collect()))
    assert sorted(map(tuple, read_projection(spark, str(tmp_path / "out")).collect())) == want
    kept = KeyedTable(spark, str(tmp_path / "out"))
    folders = [kept.manifest(v)["folders"] for v in kept.versions()]
    changed = [sum(a.get(b) != f for b, f in z.items()) for a, z in zip(folders, folders[1:], strict=False)]
    assert changed[1] <= 2 and changed[2] == 0
    last = kept.manifest()["folders"]
    run("two")  # the whole log once more, as by a writer who has lost its checkpoint
    assert kept.manifest()["folders"] == last


def test_first_seen_drops_what_is_sent_again(spark, tmp_path):
    sent = [("a", "2024-01-01"), ("b", "2024-01-02"), ("a", "2024-01-03"), ("a", "2024-01-01"), ("c", "2024-01-01")]
    for i, r in enumerate(sent):
        spark.createDataFrame([r], "k string, d string").select("k", F.to_timestamp("d").alias("at")).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    log = spark.readStream.schema("k string, at timestamp").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = first_seen(log, ["k"], "at").writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.k for r in spark.table("firsts").collect()) == ["a", "b", "c"]
