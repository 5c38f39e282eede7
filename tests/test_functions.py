"""Golden cases for JSON extraction and guarded casts (hazards H3-H6)."""

import duckdb
from pyspark.sql import functions as F

from tidemark.functions import (
    json_array_length, json_scalar, json_subtree, key_uuid, parse_doc, safe_bigint, safe_bool,
    safe_decimal, safe_timestamp,
)

DOCS = [
    ('{"a":1}', "1"), ('{"a":1.50}', "1.5"), ('{"a":"x"}', "x"), ('{"a":"[1"}', "[1"),
    ('{"a":{"b":1}}', None), ('{"a":[1,2]}', None), ('{"a":null}', None), ('{"a":true}', "true"),
    ("{}", None), ("{bad", None), ("", None), (None, None),
]


def test_json_scalar(spark):
    df = spark.createDataFrame([(d,) for d, _ in DOCS], "s string")
    got = [r[0] for r in df.select(json_scalar(parse_doc("s"), "$.a")).collect()]
    assert got == [e for _, e in DOCS]


def test_json_subtree_keeps_order_and_quotes_strings(spark):
    rows = [('{"a":{"b":1,"a":2}}',), ('{"a":"x"}',), ('{"a":null}',), ('{"b":1}',), ('{bad',),
            ('{"a":[{"q":1,"p":2}]}',), ('{"a":7}',)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(json_subtree("s", "$.a")).collect()]
    assert got == ['{"b":1,"a":2}', '"x"', None, None, None, '[{"q":1,"p":2}]', "7"]


def test_json_array_length(spark):
    df = spark.createDataFrame([('{"m":[1,2,3]}',), ('{"m":{}}',), ('{"m":null}',), (None,)], "s string")
    got = [r[0] for r in df.select(json_array_length(parse_doc("s"), "$.m")).collect()]
    assert got == [3, 0, 0, 0]


def test_guarded_casts(spark):
    vals = ["12", " 12 ", "+5", "-3", "12.7", "1e3", "0x1F", "yes", "TRUE", "false", "x", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = df.select(safe_bigint(F.col("s")).alias("i"), safe_bool(F.col("s")).alias("b")).collect()
    assert [r.i for r in got] == [12, 12, 5, -3, None, None, None, None, None, None, None, None]
    assert [r.b for r in got] == [None] * 8 + [True, False, None, None]


def test_safe_decimal_and_timestamp(spark):
    import datetime as dt
    from decimal import Decimal
    df = spark.createDataFrame([("1.50", "2024-01-02T03:04:05Z"), ("bad", "12:30"),
                                (" 2.25 ", "2024-01-02 03:04:05+02:00"), (None, "2024-1-2")],
                               "d string, t string")
    got = df.select(safe_decimal(F.col("d")).alias("d"), safe_timestamp(F.col("t")).alias("t")).collect()
    assert [r.d for r in got] == [Decimal("1.5"), None, Decimal("2.25"), None]
    assert [r.t for r in got] == [dt.datetime(2024, 1, 2, 3, 4, 5), None,
                                  dt.datetime(2024, 1, 2, 1, 4, 5), dt.datetime(2024, 1, 2)]


def test_key_uuid_matches_duckdb(spark):
    df = spark.createDataFrame([("a", "b"), ("", "+1")], "e string, p string")
    got = [r[0] for r in df.select(key_uuid(F.col("e"), F.col("p"))).collect()]
    want = [duckdb.sql(f"select md5(concat('{e}', chr(31), '{p}'))").fetchall()[0][0] for e, p in [("a", "b"), ("", "+1")]]
    assert [g.replace("-", "") for g in got] == want
    assert all(len(g) == 36 and g.count("-") == 4 for g in got)


def test_safe_timestamp_ignores_session_time_zone(spark):
    import datetime as dt
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02 03:04:05+02:00",), ("2024-01-02 03:04:05",)],
                               "t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in df.select(safe_timestamp(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 1, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5)]


def test_aware_datetimes_become_utc(spark):
    from datetime import datetime, timedelta, timezone
    from pyspark.sql import types as T
    from tidemark.functions.timex import ts_literal
    aware = datetime(2024, 1, 1, 8, tzinfo=timezone(timedelta(hours=8)))
    row = spark.range(1).select(ts_literal(aware).cast("string"), ts_literal(aware, T.TimestampType()).cast("long")).first()
    assert row[0] == "2024-01-01 00:00:00" and row[1] == int(aware.timestamp())


def test_decimal_sums_are_exact_or_raise(spark):
    import pytest
    from pyspark.sql import functions as F
    from tidemark.plans.models import _sum_decimals

    def total(*values):
        arr = F.array(*[F.lit(v).cast("decimal(38,9)") for v in values])
        return spark.range(1).select(_sum_decimals(arr).cast("string")).first()[0]
    assert total("1.10", None, "2.05") == "3.150000000" and total(None) is None
    assert total("9" * 28, "-1") == "9" * 27 + "8.000000000"
    for pair in (("1.00", "2" + "0" * 28), ("2" + "0" * 28, "1.00")):
        with pytest.raises(Exception, match="out of range"):
            total(*pair)


def test_ids_survive_what_the_variant_parser_refuses(spark):
    from tidemark.functions import object_scalar
    long = '{"note": "' + "x" * 20_100_000 + '", "id": 7}'
    texts = ['{"id": 5}', '{"id": 5, "a": 1, "a": 2}', '{"id": {"x": 1}, "a": 1, "a": 2}', '{"id": 5, "a": 1,', None, long]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r[0]: r[1] for r in df.select("i", object_scalar("t", "$.id")).collect()}
    assert got == {0: "5", 1: "5", 2: None, 3: None, 4: None, 5: "7"}
