"""The raw landing tables: batches appended under their ingest date, scanned with an explicit schema.

A landing table is a Parquet folder partitioned by :attr:`Landing.column`, the ingest date cut to
:attr:`Landing.grain`. Scans give that column beside the raw ones;
:func:`tidemark.operators.incremental.incremental_filter` turns a high-water mark into a predicate on
it, so that an incremental run lists and opens only the folders that can hold newer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.incremental import Landing


def land_raw(df: DataFrame, path: str, schema: T.StructType, ingested: Column | str, landing: Landing = Landing(),
             sort_by: str = "updated_at", mode: str = "append", dealt: bool = False) -> None:
    """Append ``df`` to the landing table at ``path``, each row under the date of its ``ingested`` time.

    ``df`` is brought to ``schema`` by name: a missing column is NULL, one that the schema lacks is
    left out, a type that doesn't fit raises. Rows without an ingest time go to the default
    partition, which no incremental scan reads and every full scan does.

    Rows are rebalanced by date: a date that holds a third of all rows (a backfill) is split over
    several tasks and files, dates with few rows share a task. Inside a file they are sorted by
    ``sort_by``, so that row groups below a mark are skipped too. Appending the same batch again
    doubles its rows; every model reads the latest version or distinct values, so marts stay the same.

    ``dealt``: ``df`` comes from :func:`deal_by_date` and has its ingest date; ``ingested`` and ``sort_by``
    were given there, and the rows are written as they lie.
    """
    dated = df if dealt else df.withColumn(landing.column, _date(ingested, landing))
    dated = dated.to(T.StructType([*schema.fields, T.StructField(landing.column, T.DateType())]))
    if not dealt:
        dated = _dealt(dated, landing, sort_by)
    dated.write.mode(mode).partitionBy(landing.column).parquet(path)


def deal_by_date(df: DataFrame, ingested: Column | str, landing: Landing, sort_by: str) -> DataFrame:
    """``df`` with its ingest date, dealt and sorted as :func:`land_raw` does it.

    For rows that are narrow before they take the raw schema: the shuffle and the sort then see the
    narrow rows only.
    """
    return _dealt(df.withColumn(landing.column, _date(ingested, landing)), landing, sort_by)


def _date(ingested: Column | str, landing: Landing) -> Column:
    return landing.date_of(F.col(ingested) if isinstance(ingested, str) else ingested)


def _dealt(dated: DataFrame, landing: Landing, sort_by: str) -> DataFrame:
    return dated.hint("rebalance", F.col(landing.column)).sortWithinPartitions(landing.column, sort_by)


def read_raw(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
             landing: Landing | None = None) -> DataFrame:
    """Lazy scan of one raw table; Catalyst prunes columns and pushes filters into it.

    With ``landing`` the table is partitioned as :func:`land_raw` writes it, and its ingest date is a
    column of the result.
    """
    if landing is not None:
        schema = T.StructType([*schema.fields, T.StructField(landing.column, T.DateType())])
    return spark.read.schema(schema).format(fmt).load(path)
