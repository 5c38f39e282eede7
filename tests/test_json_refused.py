"""Documents that the VARIANT parser refuses: a repeated key counts once, by its first value that is not null."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.jsonx import array_scalars, object_scalar, parse_doc, rebuilt_object, text_scalar
from tidemark.plans import models

LONG = 20_100_000


def one(spark, text, *columns):
    df = spark.createDataFrame([(text,)], "t string").select("t", parse_doc("t").alias("doc"))
    return tuple(df.select(*columns).first())


def lines(spark, text):
    return one(spark, text, parse_doc("t").isNull(), models.line_item_skus(F.col("t"), F.col("doc")),
               models.line_item_products(F.col("t"), F.col("doc")))


def test_line_items_with_repeated_keys(spark):
    text = ('[{"sku":"A","sku":"B","product_id":7},{"sku":null,"sku":"q\\"1","product_id":"x"},{"sku":{"a":1,"a":2},"product_id":9},'
            '{"sku":"{t","product_id":[1]},{},{"product_id":" 8 "}, 5, null, "s"]')
    refused, skus, products = lines(spark, text)
    assert refused and json.loads(skus) == ["A", 'q"1', "{t"] and json.loads(products) == [7, None, 9, 8]


@pytest.mark.parametrize("text", ["[]", "{}", "null", "", "[1,", '{"sku":"A","sku":"B"}', None])
def test_line_items_of_other_texts_are_empty(spark, text):
    assert lines(spark, text)[1:] == ("[]", "[]")


def test_both_readers_agree_on_documents_that_parse(spark):
    text = '[{"sku":"A"},{"sku":1.50},{"sku":true},{"sku":null},{"sku":{"a":1}},{"sku":[1]},{"x":"y"},{"sku":""},{"sku":"é\\n"},7]'
    by_doc, by_text = one(spark, text, array_scalars("t", "doc", "$.sku"), array_scalars("t", F.lit(None).cast("variant"), "$.sku"))
    assert by_doc == by_text == ["A", "1.5", "true", None, None, None, None, "", "é\n", None]


def test_shipping_total_with_repeated_keys(spark):
    total = models.shipping_total(F.col("t"), F.col("doc"))
    assert one(spark, '[{"discounted_price":"1.25","discounted_price":"9"},{"discounted_price":"bad"},{"discounted_price":2}]',
               total) == (Decimal("3.250000000"),)
    assert one(spark, '[{"a":1,"a":2}]', total) == (None,)


def test_object_scalars(spark):
    for text, want in (('{"id":5,"id":6}', "5"), ('{"id":{"x":1,"x":2}}', None), ('{"id":[1],"b":1,"b":2}', None),
                       ('{"id":"{x","b":1,"b":2}', "{x"), ('{"b":1,"b":2}', None), ('{"id":5,"id":', None)):
        assert one(spark, text, object_scalar("t", "$.id")) == (want,), text
    assert one(spark, '{"a":{"b":"x","b":"y"}}', text_scalar("t", "$.a.b")) == ("x",)


def journey(spark, text):
    rec = models.journey_record("t")
    df = spark.createDataFrame([(text,)], "t string").select("t", rec.struct().alias("r"))
    fields = models.journey_fields(rec.bind("r"))
    return df.select(*[c.alias(n) for n, c in fields.items()]).first().asDict()


def test_journey_with_repeated_keys(spark):
    text = ('{"order_index":"x","orderIndex":3,"order_index":9,"ready":true,"ready":false,'
            '"first_visit":{"landing_page":"","landing_page":"/b","source":"s1","source":"s2","utm_parameters":{"k":1,"k":2}},'
            '"firstVisit":{"referralCode":"rc"},"lastVisit":{"source":"z"},"moments":[{"a":1,"a":2},{"b":1}],'
            '"first_landing_page":null,"last_occurred_at":"2024-01-02T03:04:05Z","extra":{"q":1,"q":2}}')
    got = journey(spark, text)
    assert got["order_index"] == 3 and got["ready"] is True and got["first_source"] == "s1" and got["last_source"] == "z"
    assert got["first_landing_page"] == "" and got["first_referral_code"] == "rc" and got["moments_count"] == 2
    assert got["first_utm_parameters"] == '{"k":1,"k":2}' and got["moments"] == '[{"a":1,"a":2},{"b":1}]'
    assert str(got["last_occurred_at"]) == "2024-01-02 03:04:05"


def test_rebuilt_object_reads_as_the_document_itself(spark):
    """On documents that parse, the rebuilt object gives the same fields."""
    texts = ['{"order_index":"4","ready":true,"moments":[{"a":1},{"a":2}],"first_source":{"k":1},"firstSource":"s"}',
             '{"first_visit":{"landing_page":"/a","occurred_at":"2024-01-02","utm_parameters":{"s":"x"}},"moments_count":7}',
             '{"moments_count":{"count":5},"moments":null,"last_visit":null,"lastVisit":{"sourceType":"é\\"t"}}', "{}"]
    for text in texts:
        doc = spark.createDataFrame([(text,)], "t string").select(rebuilt_object("t", models.journey_paths()).alias("t")).first()[0]
        want, got = journey(spark, text), journey(spark, doc)
        assert {k: v for k, v in got.items()} == want, text


def test_strings_beyond_the_parser(spark):
    big = F.repeat(F.lit("x"), (F.col("id") + LONG).cast("int"))   # of a column, so that no plan holds it
    items = spark.range(1).select(F.concat(F.lit('[{"note":"'), big, F.lit('","sku":"A"},{"sku":"B","product_id":4}]')).alias("t"))
    items = items.select("t", parse_doc("t").alias("doc"))
    assert tuple(items.select(F.col("doc").isNull(), models.line_item_skus(F.col("t"), F.col("doc")),
                              models.line_item_products(F.col("t"), F.col("doc"))).first()) == (True, '["A","B"]', "[4]")
    rec = models.journey_record("t")
    doc = spark.range(1).select(F.concat(F.lit('{"note":"'), big, F.lit('","order_index":2,"firstVisit":{"source":"s"}}')).alias("t"))
    doc = doc.select("t", rec.struct().alias("r"))
    fields = models.journey_fields(rec.bind("r"))
    assert tuple(doc.select(fields["order_index"], fields["first_source"]).first()) == (2, "s")
