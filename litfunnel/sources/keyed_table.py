"""A table of one row per key whose versions share the files that didn't change.

Rows lie in buckets by the hash of their key, each bucket in a folder of the write that made it. A
manifest names the folder of every bucket; it is all that a reader needs and all that the driver
holds, so its size follows the number of buckets and not the rows. A change writes only the buckets
in which some row really changes, then a manifest under the next number, created only if nobody has
created it: readers see the version before or the one after, and of two writers of one version the
second fails and leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litfunnel.operators import core
from litfunnel.sources.staging import removed, unused, written

BUCKETS = 64
BUCKET = "table_bucket"


class VersionTaken(RuntimeError):
    """Another writer has made this version first."""


class KeyedTable:
    """The table under path, with one row for each value of the key columns.

    create() fixes schema, key and number of buckets; a table of 100 TB takes some hundred
    thousand. Keys are never null and no change may name one twice: both are errors that leave the
    table as it was. Columns of any name but BUCKET are data.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._at = lambda name: hadoop(f"{self.path}/{name}")
        self._fs = hadoop(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: str, key: Sequence[str], buckets: int = BUCKETS) -> KeyedTable:
        """A new table without rows; one that is there already is an error."""
        made = cls(spark, path)
        made._publish({"version": 0, "schema": schema, "key": list(key), "buckets": buckets, "folders": {}, "applied": {}})
        return made

    def exists(self) -> bool:
        return bool(self.versions())

    def versions(self) -> list[int]:
        folder = self._at("manifests")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """What version (the newest if None) consists of."""
        number = self.versions()[-1] if version is None else version
        stream = self._fs.open(self._at(f"manifests/{number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version, of these buckets only if given."""
        return self._rows(self.manifest(version), buckets)

    def upsert(self, new: DataFrame, policies: Mapping[str, str], applied: tuple[str, int] | None = None) -> int:
        """Merge new by core.merged with these policies (one key column; columns without a policy are an
        error). Returns the version that holds the result."""
        (key,) = self.manifest()["key"]
        return self.change(new, lambda old, rows: core.merged(old, rows, key, policies).drop("is_new"), applied)

    def replace(self, new: DataFrame, applied: tuple[str, int] | None = None) -> int:
        """Rows of new take the place of those with their keys."""
        return self.change(new, lambda _, rows: rows, applied)

    def change(self, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], applied: tuple[str, int] | None = None) -> int:
        """Put merge(stored rows of the keys in new, new) in place of the stored rows; returns the version.

        Only buckets with a changed row are written; without one the version stays, so a change made
        twice is made once. applied names a writer and the number of its change: one that the
        table already holds, or an earlier one, is left out unread.
        """
        before = self.manifest()
        if applied and before["applied"].get(applied[0], -1) >= applied[1]:
            return before["version"]
        key = before["key"]
        met = [r[0] for r in new.select(self._bucket(before)).distinct().collect()]
        old = self._rows(before, met)
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in old.schema]
        same = old.join(new.select(*key).distinct(), key, "left_semi").select(*typed)
        result = written(merge(same, new).select(*typed), "result")
        delta = None
        try:
            n = unused()
            twice = result.groupBy(*key).agg(F.count("*").alias(n)).where(" OR ".join([f"{n} > 1", *(f"`{c}` IS NULL" for c in key)]))
            if not twice.isEmpty():
                raise ValueError("a key is null or has two rows")
            delta = written(result.subtract(same), "delta")
            touched = [r[0] for r in delta.select(self._bucket(before)).distinct().collect()]
            if not touched and not applied:
                return before["version"]
            after = before | {"version": before["version"] + 1, "folders": dict(before["folders"]), "applied": before["applied"] | (dict([applied]) if applied else {})}
            if touched:
                after["folders"] |= {str(b): folder for b, folder in self._write(before, delta, touched).items()}
            self._publish(after)
            return after["version"]
        finally:
            for spent in (result, delta):
                if spent is not None:
                    removed(spent)

    def vacuum(self, keep: int = 1) -> int:
        """Remove all but the last keep versions and the folders that only they use; returns how many folders.
        Not for use while a writer is at work."""
        numbers = self.versions()
        manifests = {v: self.manifest(v) for v in numbers}
        alive = {f for v in numbers[-keep:] for f in manifests[v]["folders"].values()}
        for v in numbers[:-keep]:
            self._fs.delete(self._at(f"manifests/{v:012d}.json"), False)
        dead = {f for m in manifests.values() for f in m["folders"].values()} - alive
        for folder in dead:
            self._fs.delete(self._at(folder), True)
        return len(dead)

    def _bucket(self, manifest: dict) -> Column:
        return F.pmod(F.xxhash64(*manifest["key"]), F.lit(manifest["buckets"])).cast("int").alias(BUCKET)

    def _rows(self, manifest: dict, buckets: Iterable[int] | None) -> DataFrame:
        wanted = manifest["folders"].values() if buckets is None else [manifest["folders"][str(b)] for b in buckets if str(b) in manifest["folders"]]
        folders = sorted(set(wanted))
        if not folders:
            return self.spark.createDataFrame([], manifest["schema"])
        return self.spark.read.schema(manifest["schema"]).parquet(*(f"{self.path}/{f}" for f in folders))

    def _write(self, before: dict, delta: DataFrame, touched: list[int]) -> dict[int, str]:
        """The touched buckets with delta in place, each in a folder of its own."""
        key, name = before["key"], uuid.uuid4().hex
        rest = self._rows(before, touched).join(delta.select(*key), key, "left_anti").select(*delta.columns)
        whole = rest.unionByName(delta).withColumn(BUCKET, self._bucket(before))
        whole.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{name}")
        return {b: f"data/{name}/{BUCKET}={b}" for b in touched}

    def _publish(self, manifest: dict) -> None:
        """Write the manifest under its version, whole or not at all."""
        name, draft = f"manifests/{manifest['version']:012d}.json", self._at(f"manifests/draft-{uuid.uuid4().hex}")
        if self._fs.exists(self._at(name)):
            raise VersionTaken(f"version {manifest['version']} of {self.path} is there already")
        stream = self._fs.create(draft, False)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        jvm = self.spark._jvm.org.apache.hadoop.fs
        how = self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
        how[0] = jvm.Options.Rename.NONE
        try:
            # Unlike FileSystem.rename, this one refuses a name that is there.
            jvm.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf()).rename(draft, self._at(name), how)
        except Exception as e:
            self._fs.delete(draft, False)
            raise VersionTaken(f"version {manifest['version']} of {self.path} is another writer's") from e
