"""Line dedup with levelled sorted runs of line hashes, in DataFrame functions only.

A run is an immutable table of (h1, h2, n): two 64-bit hashes of a line's key and
the number of documents of its batches that hold it, bucketed and sorted by the
hashes, so runs merge and anti-join each other without a shuffle. A batch is
merge-anti-joined with the runs, so that keys that the runs already condemn (n
at the limit) are not stored again, and what is left becomes a run of level 0.
When a level holds ``fanout`` runs they are compacted (counts added up) into one
run of the next level: a key is rewritten a logarithmic number of times.

A key: the line without white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in
lower case. Empty keys are never dropped.

Defined results: null or empty text is one empty line. Every row is a document
of its own, so a repeated row counts again towards the limit; a key counts once
a row. A null doc_id is a row like any other. Empty tables give empty results.
Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import WS_CHARS, lower_ascii, n_partitions, row_key, scratch_root, stage, text_or_empty, unused_name

KEY = ["h1", "h2"]


def line_hashes(text: Column) -> Column:
    """array<struct<h1,h2>> of the text's lines, in order; null for an empty key."""
    def one(line: Column) -> Column:
        key = F.btrim(line, F.lit(WS_CHARS))
        return F.when(key != "", F.struct(F.xxhash64(key).alias("h1"),
                                          F.xxhash64(F.lit("second"), key).alias("h2")))
    return F.transform(F.split(lower_ascii(text), "\n"), one)


class LineRuns:
    """Levelled runs of line keys; ``add_batch`` takes (h1, h2, n) rows, one a key."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = n_partitions(spark)
        self.levels: list[list[str]] = []
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.made = 0

    def _runs(self) -> list[DataFrame]:
        return [self.spark.table(t) for level in self.levels for t in level]

    def _write(self, keys: DataFrame) -> str:
        self.made += 1
        table = f"{self.name}_{self.made}"
        (keys.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", f"{scratch_root(self.spark)}/llm/{table}").format("parquet").saveAsTable(table))
        return table

    def _add_up(self, tables: list[str]) -> DataFrame:
        """Merge sorted runs pairwise by full outer joins on the hashes, adding up the counts."""
        def merge(a: DataFrame, b: DataFrame) -> DataFrame:
            return (a.join(b.withColumnRenamed("n", "m"), KEY, "full_outer")
                    .select(*KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n")))
        return reduce(merge, [self.spark.table(t) for t in tables])

    def novel(self, batch: DataFrame) -> DataFrame:
        """The batch's rows whose key no run holds (exact keep-first dedup across batches)."""
        for run in self._runs():
            batch = batch.join(run.select(*KEY), KEY, "left_anti")
        return batch

    def add_batch(self, batch: DataFrame) -> None:
        """Anti-join the batch with what the runs condemn, and add the rest as a run of level 0."""
        for run in self._runs():
            batch = batch.join(run.filter(F.col("n") >= self.min_docs).select(*KEY), KEY, "left_anti")
        self._push(0, self._write(batch.select(*KEY, "n")))

    def _push(self, level: int, table: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(table)
        if len(self.levels[level]) >= self.fanout:
            merged, old = self._write(self._add_up(self.levels[level])), self.levels[level]
            self.levels[level] = []
            for t in old:
                self._drop(t)
            self._push(level + 1, merged)

    def _drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE {table}")

    def counts(self) -> DataFrame:
        """(h1, h2, n) over all batches; a condemned key's n is at least the limit, not its total."""
        return self._add_up([t for level in self.levels for t in level])

    def condemned(self) -> DataFrame:
        return self.counts().filter(F.col("n") >= self.min_docs).select(*KEY)

    def close(self) -> None:
        """Forget the catalog entries; files stay in the scratch folder."""
        for level in self.levels:
            for t in level:
                self._drop(t)
        self.levels = []


def batch_keys(docs: DataFrame, n_batches: int) -> DataFrame:
    """(batch, h1, h2, n): documents that hold each key, by batch of document ids; counted before shuffling."""
    keys = docs.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(n_batches)).cast("int").alias("batch"),
        F.explode(F.array_distinct(F.filter(line_hashes(text_or_empty()), lambda x: x.isNotNull()))).alias("k"))
    return keys.groupBy("batch", "k.h1", "k.h2").agg(F.count("*").alias("n"))


def condemned_keys(docs: DataFrame, min_docs: int, n_batches: int = 4) -> DataFrame:
    spark = docs.sparkSession
    keys = stage(batch_keys(docs, n_batches), "line-keys", ["batch"])
    runs = LineRuns(spark, min_docs)
    for b in range(n_batches):
        runs.add_batch(keys.filter(F.col("batch") == b).select(*KEY, "n"))
    bad = stage(runs.condemned(), "line-condemned")
    runs.close()
    return bad


def drop_lines(docs: DataFrame, min_docs: int = 10, n_batches: int = 4, name: str = "_lines") -> DataFrame:
    """``docs`` with one more column: struct(n_lines, n_dropped, kept_text)."""
    bad = condemned_keys(docs, min_docs, n_batches)
    d = docs.select("doc_id", text_or_empty().alias("text"))
    ident = [F.coalesce(F.col("doc_id"), F.lit(-1)).alias("row_id"), row_key(F.col("text")).alias("row_hash")]
    at = d.select(*ident, F.posexplode(line_hashes(F.col("text"))).alias("pos", "k")).filter("k IS NOT NULL")
    at = at.select("row_id", "row_hash", "pos", "k.h1", "k.h2").join(bad, KEY, "left_semi")
    # Positions of the lines to drop; a row has no more of them than lines. Identical rows share them.
    gone = at.groupBy("row_id", "row_hash").agg(F.collect_set("pos").alias("gone"))
    gone = gone.select(F.col("row_id").alias("_row_id"), F.col("row_hash").alias("_row_hash"), "gone")
    text = F.coalesce(F.col("d.text").cast("string"), F.lit(""))
    out = docs.alias("d").join(gone, (F.coalesce(F.col("d.doc_id"), F.lit(-1)) == gone["_row_id"])
                               & (row_key(text) == gone["_row_hash"]), "left")
    lines = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone["gone"])
    kept = F.when(gone["gone"].isNull(), text).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    return out.select("d.*", F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        F.when(gone["gone"].isNull(), 0).otherwise(F.size(gone["gone"])).cast("long").alias("n_dropped"),
        kept.alias("kept_text")).alias(name))


def dedup_lines(docs: DataFrame, min_docs: int = 10, n_batches: int = 4) -> DataFrame:
    """``docs`` with the condemned lines gone from text, and n_chars (if there) brought up to date."""
    name = unused_name(docs, "_lines")
    out = drop_lines(docs, min_docs, n_batches, name)
    kept = F.col(f"{name}.kept_text")
    changed = {"text": kept, **({"n_chars": F.length(kept).cast(docs.schema["n_chars"].dataType)}
                                if "n_chars" in docs.columns else {})}
    return out.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
