"""Source and mart schemas, and the per-mart configuration (MartSpec).

Timestamps are parametric: the driver test tables carry ``timestamp_ntz``
(wall clock, UTC by convention); a warehouse landing zone usually carries
``timestamp``. Every builder takes the timestamp type of its sources and the
marts inherit it, so no implicit time-zone shift happens inside the pipeline.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)
TS_NTZ = T.TimestampNTZType()

# Order-table column groups by type, as the orders model projects them.
ORDER_JSON_COLUMNS = (
    "customer", "line_items", "shipping_lines", "refunds", "fulfillments",
    "client_details", "discount_codes", "billing_address", "shipping_address",
    "total_discounts_set", "current_total_tax_set", "discount_applications",
    "payment_gateway_names",
)
ORDER_TEXT_COLUMNS = (
    "name", "note", "tags", "email", "phone", "currency", "shop_url", "browser_ip",
    "source_name", "landing_site", "contact_email", "referring_site", "customer_locale",
    "deleted_message", "fulfillment_status", "presentment_currency",
)
ORDER_BOOL_COLUMNS = ("confirmed", "duties_included", "buyer_accepts_marketing")
ORDER_NUMERIC_COLUMNS = (
    "total_price", "subtotal_price", "estimated_taxes", "total_discounts", "total_price_usd",
    "current_total_tax", "total_outstanding", "current_total_price", "current_subtotal_price",
    "total_line_items_price", "current_total_discounts", "total_weight",
)
ORDER_TS_COLUMNS = ("created_at", "updated_at", "closed_at", "deleted_at", "cancelled_at",
                    "processed_at")


def raw_orders_schema(ts: T.DataType = TS_NTZ, extracted_col: str = "_airbyte_extracted_at",
                      extracted_type: T.DataType | None = None) -> T.StructType:
    fields = [T.StructField("id", T.LongType()), T.StructField("app_id", T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in ORDER_JSON_COLUMNS + ORDER_TEXT_COLUMNS]
    fields += [T.StructField(c, T.BooleanType()) for c in ORDER_BOOL_COLUMNS]
    fields += [T.StructField(c, NUMERIC) for c in ORDER_NUMERIC_COLUMNS]
    fields += [T.StructField(c, ts) for c in ORDER_TS_COLUMNS]
    fields.append(T.StructField(extracted_col, extracted_type or ts))
    return T.StructType(fields)


def raw_customers_schema(ts: T.DataType = TS_NTZ, extracted_col: str = "_airbyte_extracted_at",
                         extracted_type: T.DataType | None = None) -> T.StructType:
    return T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("addresses", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("created_at", ts),
        T.StructField("updated_at", ts),
        T.StructField(extracted_col, extracted_type or ts),
    ])


def raw_journey_schema(ts: T.DataType = TS_NTZ, extracted_col: str = "_airbyte_extracted_at",
                       extracted_type: T.DataType | None = None) -> T.StructType:
    return T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("shop_url", T.StringType()),
        T.StructField("customer_journey_summary", T.StringType()),
        T.StructField("created_at", ts),
        T.StructField("updated_at", ts),
        T.StructField(extracted_col, extracted_type or ts),
    ])


# ---------------------------------------------------------------- marts

def identity_map_schema(ts: T.DataType = TS_NTZ) -> T.StructType:
    return T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("created_at", ts),
        T.StructField("updated_at", ts),
    ])


def id_registry_schema(ts: T.DataType = TS_NTZ) -> T.StructType:
    return T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("merge_record", T.StringType()),
        T.StructField("created_at", ts),
        T.StructField("updated_at", ts),
    ])


def shop_map_schema(ts: T.DataType = TS_NTZ) -> T.StructType:
    return T.StructType([
        T.StructField("created_at", ts),
        T.StructField("updated_at", ts),
        T.StructField("customer_id", T.StringType()),
        T.StructField("shopify_id", T.LongType()),
    ])


def customer_schema(ts: T.DataType = TS_NTZ) -> T.StructType:
    return T.StructType([
        T.StructField("created_at", ts),
        T.StructField("updated_at", ts),
        T.StructField("customer_id", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("addresses", T.StringType()),
        T.StructField("firstname", T.StringType()),
        T.StructField("lastname", T.StringType()),
        T.StructField("shopify_created_at", ts),
        T.StructField("shopify_tags", T.StringType()),
    ])


@dataclass(frozen=True)
class MartSpec:
    """Configuration of one incremental, keyed mart.

    ``keys``: merge key. ``exclude_on_update``: columns an update keeps from the
    existing row; ``carry_on_update``: those it keeps unless they are NULL. ``dedupe_order``: recency order used by the pre-merge dedupe
    of the current snapshot (empty = no dedupe). ``dedupe_normalise``: key
    columns coalesced to '' before the dedupe.
    """

    name: str
    keys: tuple[str, ...]
    exclude_on_update: tuple[str, ...] = ("created_at",)
    carry_on_update: tuple[str, ...] = ()
    dedupe_order: tuple[str, ...] = ()
    dedupe_normalise: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    unique_combos: tuple[tuple[str, ...], ...] = field(default_factory=tuple)


IDENTITY_MAP = MartSpec(
    "dwd_customer_email_phone_map", ("email", "phone"), carry_on_update=("customer_id",),
    dedupe_order=("updated_at", "created_at", "customer_id"),
    dedupe_normalise=("email", "phone"),
    not_null=("customer_id",), unique_combos=(("email", "phone"),))
ID_REGISTRY = MartSpec(
    "dwd_customer_id", ("customer_id",), carry_on_update=("merge_record",),
    dedupe_order=("updated_at", "created_at", "merge_record"),
    not_null=("customer_id",), unique=("customer_id",))
SHOP_MAP = MartSpec(
    "dwd_customer_shopify_map", ("customer_id", "shopify_id"),
    dedupe_order=("updated_at", "created_at"),
    not_null=("customer_id", "shopify_id"), unique_combos=(("customer_id", "shopify_id"),))
CUSTOMER = MartSpec(
    "dwd_customer", ("customer_id",), not_null=("customer_id",), unique=("customer_id",))
ORDERS = MartSpec(
    "dwd_orders", ("order_id",), not_null=("order_id", "customer_id", "shopify_id"),
    unique=("order_id",))
JOURNEY = MartSpec(
    "dwd_customers_journey", ("shopify_order_id",),
    not_null=("shopify_order_id", "customer_id", "shopify_id"), unique=("shopify_order_id",))

MARTS = (IDENTITY_MAP, ID_REGISTRY, SHOP_MAP, CUSTOMER, ORDERS, JOURNEY)


# Output columns of the latest-orders view, in order, and the
# source column of each renamed one (the others keep their source name).
ORDERS_LATEST_RENAMES = {
    "order_id": "id",
    "order_name": "name",
    "order_created_at": "created_at",
    "order_deleted_at": "deleted_at",
    "order_updated_at": "updated_at",
    "order_cancelled_at": "cancelled_at",
    "order_processed_at": "processed_at",
}
ORDERS_LATEST_COLUMNS = (
    "order_id", "shopify_id", "order_name", "note", "tags", "email", "phone", "app_id",
    "refunds", "currency", "shop_url", "closed_at", "confirmed", "browser_ip",
    "order_created_at", "order_deleted_at", "line_items", "order_updated_at",
    "order_cancelled_at", "source_name", "total_price", "fulfillments", "landing_site",
    "order_processed_at", "total_weight", "contact_email", "client_details", "discount_codes",
    "referring_site", "shipping_lines", "subtotal_price", "billing_address", "customer_locale",
    "deleted_message", "duties_included", "estimated_taxes", "total_discounts",
    "total_price_usd", "shipping_address", "current_total_tax", "total_outstanding",
    "fulfillment_status", "current_total_price", "total_discounts_set", "presentment_currency",
    "current_total_tax_set", "discount_applications", "payment_gateway_names",
    "current_subtotal_price", "total_line_items_price", "buyer_accepts_marketing",
    "current_total_discounts",
)
# Output columns of the orders mart, in order.
ORDERS_MART_COLUMNS = (
    "created_at", "updated_at", "order_id", "customer_id", "shopify_id", "order_name", "note",
    "tags", "email", "phone", "app_id", "refunds", "currency", "shop_url", "closed_at",
    "confirmed", "browser_ip", "order_created_at", "order_deleted_at", "sku",
    "shopify_product_id", "order_updated_at", "order_cancelled_at", "source_name",
    "total_price", "fulfillments", "landing_site", "order_processed_at", "total_weight",
    "contact_email", "client_details", "discount_codes", "referring_site", "shipping_price",
    "subtotal_price", "billing_address", "customer_locale", "deleted_message",
    "duties_included", "estimated_taxes", "total_discounts", "total_price_usd",
    "shipping_address", "current_total_tax", "total_outstanding", "fulfillment_status",
    "current_total_price", "total_discounts_set", "presentment_currency",
    "current_total_tax_set", "discount_applications", "payment_gateway_names",
    "current_subtotal_price", "total_line_items_price", "buyer_accepts_marketing",
    "current_total_discounts",
)
# Output columns of the journey mart, in order.
JOURNEY_MART_COLUMNS = (
    "created_at", "updated_at", "customer_id", "shopify_id", "shopify_order_id", "shop_url",
    "order_index", "day_to_conversion", "ready", "first_landing_page", "first_occurred_at",
    "first_referral_code", "first_referrer_url", "first_source", "first_source_type",
    "first_utm_parameters", "last_landing_page", "last_occurred_at", "last_referral_code",
    "last_referrer_url", "last_source", "last_source_type", "last_utm_parameters", "moments",
    "moments_count",
)
