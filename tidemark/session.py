"""SparkSession construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on. Shuffle partitions and file split size are
# left to the caller: at cluster scale they are sized from the input volume.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set to shared storage and is used as is. Only when it
    is unset (local tests) is ``fallback`` installed as the checkpoint folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    os.makedirs(fallback, exist_ok=True)
    sc.setCheckpointDir(fallback)
    return sc.getCheckpointDir() or fallback


def scratch_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a fresh local folder only on a local master without one (tests)."""
    fallback = None
    if spark.sparkContext.master.startswith("local"):
        fallback = os.path.join(tempfile.gettempdir(), f"tidemark-{uuid.uuid4().hex}")
    return checkpoint_dir(spark, fallback).rstrip("/")
