"""Versioned Parquet snapshots of the marts (the pipeline's sink and state).

Layout under a shared warehouse root (HDFS, object store or a local folder in
tests)::

    <root>/<mart>/v=000001/part-*.parquet     written by one Spark job
    <root>/<mart>/_facts/000001.json          what is known of the version: rows, maxima, whether checked
    <root>/<mart>/_commits/000001             empty marker = version committed

A new version is written next to the old ones, checked, and only then
committed by creating its marker, so a failed or interrupted run leaves the
previous version current, and a reader never sees half a table. Old versions
are kept until ``prune`` is called explicitly. One writer per mart at a time
is assumed (the reference also runs one build at a time).

Reading a snapshot back from storage is also what cuts the lineage between
marts: downstream marts read files, not the upstream plan.

Bucketing: written with ``bucket_keys``, a version is saved as a Spark
bucketed table (``bucketBy(n, keys)``, sorted by the keys) and re-registered
as such when read. Its scan is then already hash-partitioned on the merge
key, so the next run's merge join, key lookups, dedupe window and key checks
shuffle only the other (small) side. The bucket count is fixed at the first
write of a table (``<root>/<mart>/_buckets/<n>``) and reused afterwards; keep
it at or above ``spark.sql.shuffle.partitions`` so the planner keeps the
table's partitioning instead of re-shuffling it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self._run, self._staged = uuid.uuid4().hex, []
        self._tag = hashlib.md5(self.root.encode()).hexdigest()[:10]
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # -- paths
    def _fs(self, path: str):
        p = self._Path(path)
        return p.getFileSystem(self._conf), p

    def table_dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    def version_dir(self, name: str, version: int) -> str:
        return f"{self.table_dir(name)}/v={version:06d}"

    def _commit_dir(self, name: str) -> str:
        return f"{self.table_dir(name)}/_commits"

    # -- versions
    def versions(self, name: str) -> list[int]:
        fs, p = self._fs(self._commit_dir(name))
        if not fs.exists(p):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(p))

    def current_version(self, name: str) -> int | None:
        v = self.versions(name)
        return v[-1] if v else None

    def exists(self, name: str) -> bool:
        return self.current_version(name) is not None

    def bucket_count(self, name: str) -> int | None:
        fs, p = self._fs(f"{self.table_dir(name)}/_buckets")
        if not fs.exists(p):
            return None
        names = [int(st.getPath().getName()) for st in fs.listStatus(p)]
        return names[0] if names else None

    def _table_name(self, name: str, version: int) -> str:
        return f"tidemark_{self._tag}_{name}_v{version:06d}"

    def read(self, name: str, schema: T.StructType | None = None, version: int | None = None,
             bucket_keys: Sequence[str] | None = None) -> DataFrame | None:
        """The committed snapshot (latest unless ``version``), or None if there is none."""
        version = self.current_version(name) if version is None else version
        if version is None:
            return None
        n = self.bucket_count(name) if bucket_keys else None
        if n:
            table = self._table_name(name, version)
            if not self.spark.catalog.tableExists(table):
                path = self.version_dir(name, version)
                fields = (schema or self.spark.read.parquet(path).schema).fields
                cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
                keys = ", ".join(f"`{k}`" for k in bucket_keys)
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
                               f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {n} BUCKETS "
                               f"LOCATION '{path}'")
            return self.spark.table(table)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(self.version_dir(name, version))

    def write(self, name: str, df: DataFrame, bucket_keys: Sequence[str] | None = None) -> int:
        """Write ``df`` as the next version (not yet committed); returns the version."""
        fs, p = self._fs(self.table_dir(name))
        taken = [0] + self.versions(name)
        if fs.exists(p):
            for s in fs.listStatus(p):
                n = s.getPath().getName()
                if n.startswith("v="):
                    taken.append(int(n[2:]))
        version = max(taken) + 1
        path = self.version_dir(name, version)
        n = None
        if bucket_keys:
            n = self.bucket_count(name)
            if n is None:
                n = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
                fs.mkdirs(self._Path(f"{self.table_dir(name)}/_buckets/{n}"))
        if n:
            (df.write.mode("errorifexists").format("parquet").bucketBy(n, *bucket_keys)
             .sortBy(*bucket_keys).option("path", path).saveAsTable(self._table_name(name, version)))
        else:
            df.write.mode("errorifexists").parquet(path)
        return version

    def record(self, name: str, version: int, facts: Mapping) -> None:
        """Store what is known of a written version; call it before :meth:`commit`."""
        fs, p = self._fs(self._facts_file(name, version))
        out = fs.create(p, True)
        try:
            out.write(bytearray(json.dumps(facts).encode()))
        finally:
            out.close()

    def commit(self, name: str, version: int) -> None:
        fs, p = self._fs(f"{self._commit_dir(name)}/{version:06d}")
        fs.mkdirs(p)

    # -- intermediate tables of a run
    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written under ``<root>/_staged`` and read back; gone with :meth:`drop_staged`."""
        path = f"{self.root}/_staged/{self._run}/{name}-{len(self._staged):06d}"
        df.write.mode("errorifexists").parquet(path)
        self._staged.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_staged(self) -> None:
        """Delete what this store staged; call it when nothing planned on it will run any more."""
        for path in self._staged:
            fs, p = self._fs(path)
            fs.delete(p, True)
        self._staged.clear()

    def _facts_file(self, name: str, version: int) -> str:
        return f"{self.table_dir(name)}/_facts/{version:06d}.json"

    def facts(self, name: str, version: int | None = None) -> dict:
        """What was stored with a version (the current one by default); empty if nothing was."""
        version = self.current_version(name) if version is None else version
        if version is None:
            return {}
        fs, p = self._fs(self._facts_file(name, version))
        if not fs.exists(p):
            return {}
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def prune(self, name: str, keep: int = 2) -> list[int]:
        """Delete all but the ``keep`` newest committed versions; returns the deleted ones.

        The current version always stays. Catalog entries of deleted versions go with them.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1: the current version cannot be pruned")
        gone = self.versions(name)[:-keep]
        for v in gone:
            fs, p = self._fs(f"{self._commit_dir(name)}/{v:06d}")
            fs.delete(p, True)
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(name, v)}")
            for path in (self.version_dir(name, v), self._facts_file(name, v)):
                fs, p = self._fs(path)
                fs.delete(p, True)
        return gone
