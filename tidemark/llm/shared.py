"""Helpers shared by the operators: staged tables, row identity, folds, components."""

from __future__ import annotations

import pickle
import uuid

from pyspark import SparkContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed by the contracts: the white space that ends a word, and words.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"
HELD_OUT_FOLD = 2


def scratch_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a fresh local one only where it is unset (tests)."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile
        root = tempfile.mkdtemp(prefix="tidemark-llm-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def staged_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    Cuts lineage: what follows survives a lost executor without recomputing
    ``df``, and a result used twice is computed once.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_path = path
    return back


def drop_staged(df: DataFrame) -> None:
    """Delete the folder of a table that :func:`stage` returned and nothing reads any more."""
    jvm = SparkContext._active_spark_context._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession, model: object):
    """Broadcast a model of bounded size; the returned function gives it in a worker, once a task.

    Pickled by value, as executors need not have this package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    return lambda: pickle.loads(sent.value)


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4."""
    return F.crc32(doc_id.cast("string")) % 4


def held_out(doc_id: Column) -> Column:
    """True for fold 2; rows without an id are never learned from, so they count as held out."""
    return F.coalesce(fold_of(doc_id) == HELD_OUT_FOLD, F.lit(True))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def row_key(text: Column) -> Column:
    """Second half of a row's identity (doc_id, this): rows equal in both give equal results."""
    return F.xxhash64(text, F.lit("row"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is. ``lower`` does that on pure ASCII, faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component = its smallest node.

    Alternating large-star and small-star rounds on the edge table. A round
    leaves at most as many edges as it found, each node's minimum is a combinable
    aggregate, and every round's edges are staged, so hubs and lost executors
    are harmless. Stops when every edge points at its component's minimum.
    """
    cur = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .filter("a <> b").distinct(), "cc")
    last = None
    for _ in range(max_rounds):
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("k"), F.least("a", "m").alias("m"))
        # Large star: neighbours above a node move to the node's smallest neighbour.
        large = (both.filter("b > a").join(low, F.col("a") == F.col("k"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        # Small star: a node's neighbours below it meet at the smallest of them.
        low2 = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = (large.join(low2, F.col("a") == F.col("k"))
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a <> b").distinct())
        nxt = stage(small, "cc")
        state = nxt.agg(F.count("*"), F.count_distinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_staged(cur)
        cur = nxt
        # A forest of stars: one edge a node, and no change any more.
        if state[0] == state[1] and state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
