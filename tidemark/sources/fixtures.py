"""Raw-shaped inputs derived from the driver's TPC-H-like tables.

The rules only use modulo, concat, floor and casts; the DuckDB twin in
:mod:`tidemark.plans.oracle_sql` spells them the same way. ``k`` is
``o_orderkey`` and ``c`` is ``o_custkey``; ``extract_seq`` (= k) stands in for
the ingestion time and is the final tie-breaker of every recency order.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.incremental import Landing
from tidemark.schemas import (
    ORDER_BOOL_COLUMNS, ORDER_JSON_COLUMNS, ORDER_NUMERIC_COLUMNS, ORDER_TEXT_COLUMNS, ORDER_TS_COLUMNS,
    raw_customers_schema, raw_journey_schema, raw_orders_schema,
)
from tidemark.sources.raw import deal_by_date, land_raw, read_raw

FIXTURE_EXTRACTED_COL = "extract_seq"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The derivation rules, as Spark SQL expressions over ``orders`` (k = o_orderkey,
# c = o_custkey) joined to ``customer`` where needed. Each frame is one
# ``selectExpr``: a single call, whatever the number of columns.
CUSTOMER_RULES = {
    "id": "o_custkey",
    "email": "CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 97 = 0 THEN '' "
             "ELSE concat('u', CAST(o_custkey % 700 AS STRING), '@example.com') END",
    "phone": "CASE WHEN o_custkey % 3 = 0 THEN NULL WHEN o_custkey % 89 = 0 THEN '' "
             "ELSE concat('+1', CAST(o_custkey % 900 AS STRING)) END",
    "currency": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END",
    "addresses": "CASE WHEN o_orderkey % 6 = 0 THEN NULL "
                 "ELSE concat('[{\"nation\":', CAST(c_nationkey AS STRING), '}]') END",
    "first_name": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_name END",
    "last_name": "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE concat(c_mktsegment, CAST(o_orderkey % 3 AS STRING)) END",
    "tags": "CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE o_orderstatus END",
    "created_at": "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP_NTZ) - INTERVAL 3 HOUR END",
    "updated_at": "CAST(o_orderdate AS TIMESTAMP_NTZ)",
    FIXTURE_EXTRACTED_COL: "o_orderkey",
}
ORDER_RULES = {
    "id": "CAST(floor(o_orderkey / 2) AS BIGINT)",
    "customer": "CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN '{\"id\":{\"x\":1}}' "
                "WHEN o_orderkey % 31 = 0 THEN '{\"id\":\"12.7\"}' "
                "ELSE concat('{\"id\":', CAST(o_custkey AS STRING), '}') END",
    "name": "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE concat('#', CAST(o_orderkey AS STRING)) END",
    "line_items": "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 19 = 1 THEN '{}' "
                  "WHEN o_orderkey % 19 = 2 THEN '[]' "
                  "ELSE concat('[{\"sku\":\"S', CAST(o_custkey % 10 AS STRING), '\",\"product_id\":', "
                  "CAST(o_orderkey % 50 AS STRING), '},{\"sku\":null,\"product_id\":\"x\"},{\"sku\":\"T\"}]') END",
    "shipping_lines": "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 13 = 1 THEN '[{}]' "
                      "ELSE concat('[{\"discounted_price\":\"', CAST(o_orderkey % 20 AS STRING), "
                      "'.25\"},{\"discounted_price\":\"bad\"},{\"discounted_price\":\"1.50\"}]') END",
    "total_price": "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(38,9)) END",
    "created_at": "CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP_NTZ) END",
    "updated_at": "CAST(o_orderdate AS TIMESTAMP_NTZ)",
    FIXTURE_EXTRACTED_COL: "o_orderkey",
}


def _passed_through() -> dict[str, str]:
    """Rules of the order columns that no model looks into: no two alike, each NULL in its own rows."""
    def but(every: int, value: str) -> str:
        return f"CASE WHEN o_orderkey % {every} = 0 THEN NULL ELSE {value} END"

    def rest(columns):
        return enumerate(c for c in columns if c not in ORDER_RULES)
    rules = {"app_id": but(6, "o_orderkey % 17")}
    for i, c in rest(ORDER_JSON_COLUMNS):
        rules[c] = but(20 + i, f"concat('{{\"{c}\":', CAST(o_orderkey % 100 AS STRING), '}}')")
    for i, c in rest(ORDER_TEXT_COLUMNS):
        rules[c] = but(5 + i, f"concat('{c} ', CAST(o_orderkey % 1000 AS STRING))")
    for i, c in rest(ORDER_BOOL_COLUMNS):
        rules[c] = but(7, f"(o_orderkey + {i}) % {2 + i} = 0")
    for i, c in rest(ORDER_NUMERIC_COLUMNS):
        rules[c] = but(7 + i, f"o_orderkey % 1000 + {1000 * (i + 1)}")
    for i, c in rest(ORDER_TS_COLUMNS):
        rules[c] = but(9 + i, f"CAST(o_orderdate AS TIMESTAMP_NTZ) + INTERVAL {i + 1} HOUR")
    return rules


# The fields of a visit, snake and camel.
VISIT_FIELDS = (("landing_page", "landingPage"), ("occurred_at", "occurredAt"), ("referral_code", "referralCode"),
                ("referrer_url", "referrerUrl"), ("source", "source"), ("source_type", "sourceType"),
                ("utm_parameters", "utmParameters"))


def candidate_document(best: int) -> str:
    """A journey summary whose values lie in places ``best`` to 3 of their four, each place with its own value."""
    d: dict = {"ready": best % 2 == 0, "moments": [{"m": i} for i in range(best)]}
    for n, names in enumerate((("order_index", "orderIndex", "customer_order_index", "customerOrderIndex"),
                               ("day_to_conversion", "dayToConversion", "days_to_conversion", "daysToConversion"))):
        d |= {name: 10 * (n + 1) + place for place, name in enumerate(names) if place >= best}
    counts = ({"moments_count": {"count": 31}, "momentsCount": {"count": 32}}, {"moments_count": 33, "momentsCount": {"count": 34}},
              {"moments_count": 35, "momentsCount": 36}, {"momentsCount": 37})
    d |= counts[best]
    for v, visit in enumerate(("first", "last")):
        nested: tuple[dict, dict] = ({}, {})
        for f, (snake, camel) in enumerate(VISIT_FIELDS):
            spots = ((d, f"{visit}_{snake}"), (d, f"{visit}{camel[0].upper()}{camel[1:]}"), (nested[0], snake), (nested[1], camel))
            for place, (where, name) in enumerate(spots):
                if place >= best:
                    text = f"{visit} {snake} {place}"
                    where[name] = (f"2024-0{v + 1}-0{place + 1}T03:04:05Z" if snake == "occurred_at"
                                   else {"at": text} if snake == "utm_parameters" else text)
        d |= {name: part for name, part in ((f"{visit}_visit", nested[0]), (f"{visit}Visit", nested[1])) if part}
    return json.dumps(d, separators=(",", ":"))


# Journey summaries by k % 8 (c9 = o_custkey % 9).
JOURNEY_SUMMARY = (
    "CASE o_orderkey % 8 "
    "WHEN 0 THEN NULL "
    "WHEN 1 THEN concat('{\"order_index\":', CAST(o_custkey % 9 AS STRING), ',\"ready\":true,\"moments\":[{\"a\":1},{\"a\":2}]}') "
    "WHEN 2 THEN concat('{\"orderIndex\":\"', CAST(o_custkey % 9 AS STRING), '\",\"daysToConversion\":3,\"ready\":\"yes\",\"momentsCount\":{\"count\":4}}') "
    "WHEN 3 THEN '{\"first_visit\":{\"landing_page\":\"/a\",\"occurred_at\":\"2024-01-02T03:04:05Z\",\"utm_parameters\":{\"s\":\"x\"}},\"moments_count\":7}' "
    "WHEN 4 THEN '{\"firstVisit\":{\"landingPage\":\"/b\",\"occurredAt\":\"12:30\",\"utmParameters\":{\"s\":\"y\"}},\"lastVisit\":{\"source\":\"z\"}}' "
    "WHEN 5 THEN '{\"first_landing_page\":\"\",\"firstLandingPage\":\"/c\",\"order_index\":\"x\",\"orderIndex\":5}' "
    "WHEN 6 THEN '{bad' "
    "ELSE CASE o_orderkey % 64 "
    + " ".join(f"WHEN {8 * best + 7} THEN '{candidate_document(best)}'" for best in range(4))
    + " ELSE '{\"moments\":null,\"first_source\":{\"k\":1},\"firstSource\":\"s\"}' END END"
)
JOURNEY_RULES = {
    "order_id": "CAST(floor(o_orderkey / 2) AS BIGINT)",
    "shop_url": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('shop', CAST(o_orderkey % 5 AS STRING), '.example.com') END",
    "customer_journey_summary": JOURNEY_SUMMARY,
    "created_at": "CAST(o_orderdate AS TIMESTAMP_NTZ) - INTERVAL 1 HOUR",
    "updated_at": "CAST(o_orderdate AS TIMESTAMP_NTZ)",
    FIXTURE_EXTRACTED_COL: "o_orderkey",
}


def _project(df: DataFrame, typed: list[tuple[str, str]], rules: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"CAST({rules.get(c, 'NULL')} AS {t}) AS `{c}`" for c, t in typed], *_ingest_date(df))


def _ingest_date(source: DataFrame) -> list[str]:
    """The ingest date of rows that are dealt for landing."""
    return [f"`{FIXTURE_LANDING.column}`"] if FIXTURE_LANDING.column in source.columns else []


def _customer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    c = _table(spark, sf_dir, "customer")
    # Customers grow with the input, and their file's size tells too little of their size in memory to broadcast them by it.
    return o.join(c.hint("merge"), o.o_custkey == c.c_custkey, "inner")


def _order_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders")


def _customers_of(source: DataFrame) -> DataFrame:
    return source.selectExpr(*[f"{rule} AS `{name}`" for name, rule in CUSTOMER_RULES.items()], *_ingest_date(source))


def _orders_of(source: DataFrame) -> DataFrame:
    typed = ([("id", "BIGINT"), ("app_id", "BIGINT")]
             + [(c, "STRING") for c in ORDER_JSON_COLUMNS + ORDER_TEXT_COLUMNS]
             + [(c, "BOOLEAN") for c in ORDER_BOOL_COLUMNS]
             + [(c, "DECIMAL(38,9)") for c in ORDER_NUMERIC_COLUMNS]
             + [(c, "TIMESTAMP_NTZ") for c in ORDER_TS_COLUMNS]
             + [(FIXTURE_EXTRACTED_COL, "BIGINT")])
    return _project(source, typed, ORDER_RULES | _passed_through())


def _journey_of(source: DataFrame) -> DataFrame:
    return source.selectExpr(*[f"{rule} AS `{name}`" for name, rule in JOURNEY_RULES.items()], *_ingest_date(source))


def fx_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order = one version of the shop customer ``o_custkey``."""
    return _customers_of(_customer_source(spark, sf_dir))


def fx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions per order id (``floor(k / 2)``), raw order columns."""
    return _orders_of(_order_source(spark, sf_dir))


def fx_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions per order id, one journey summary each."""
    return _journey_of(_order_source(spark, sf_dir))


def fixture_inputs(spark: SparkSession, sf_dir: str, where: Column | None = None):
    """Lazy mapping customers/orders/journey -> DataFrame, optionally filtered by ``where``."""
    from tidemark.plans.marts import LazyTables

    def make(fn):
        return lambda: fn(spark, sf_dir) if where is None else fn(spark, sf_dir).filter(where)
    return LazyTables({"customers": make(fx_customers), "orders": make(fx_orders),
                       "journey": make(fx_journey)})


FIXTURE_LANDING = Landing(grain="month")
RAW_SOURCES = {"customers": (_customer_source, _customers_of), "orders": (_order_source, _orders_of),
               "journey": (_order_source, _journey_of)}
RAW_SCHEMAS = {"customers": raw_customers_schema, "orders": raw_orders_schema, "journey": raw_journey_schema}


def landed_inputs(spark: SparkSession, sf_dir: str, root: str):
    """The same rows as raw landing tables under ``root``, each written when it is first asked for.

    A version arrives nought to two days after its ``updated_at`` (by ``extract_seq % 3``). The rows are
    dealt by ingest date while they are rows of the given tables, before the raw columns are derived.
    """
    from tidemark.plans.marts import LazyTables

    def make(name):
        schema = RAW_SCHEMAS[name](extracted_col=FIXTURE_EXTRACTED_COL, extracted_type=T.LongType())

        def scan():
            path = f"{root}/{name}"
            source, derive = RAW_SOURCES[name]
            arrived = F.expr("CAST(o_orderdate AS TIMESTAMP_NTZ) + make_dt_interval(o_orderkey % 3)")
            dealt = deal_by_date(source(spark, sf_dir), arrived, FIXTURE_LANDING, "o_orderdate")
            land_raw(derive(dealt), path, schema, FIXTURE_LANDING.column, FIXTURE_LANDING, dealt=True)
            return read_raw(spark, path, schema, landing=FIXTURE_LANDING)
        return scan
    return LazyTables({name: make(name) for name in RAW_SCHEMAS})
