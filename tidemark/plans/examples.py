"""The two starter models (D11): a literal union and a filter over it.

They run on fixed literal rows, so they are exercised by the tests only and
are not registered as queries. The not-null check on the first model fails
by construction (it emits a NULL id), as in the original project.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_SCHEMA = T.StructType([T.StructField("id", T.IntegerType())])


def first_model(spark: SparkSession) -> DataFrame:
    """``select 1 as id union all select null as id``."""
    one = spark.createDataFrame([(1,)], ID_SCHEMA)
    null = spark.createDataFrame([(None,)], ID_SCHEMA)
    return one.unionByName(null)


def second_model(first: DataFrame) -> DataFrame:
    """Rows of the first model with ``id = 1``."""
    return first.filter(F.col("id") == 1)
