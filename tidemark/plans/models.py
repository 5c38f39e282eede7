"""The pipeline's models: views (D1-D4) and the row sets merged into marts.

Every function maps DataFrames to a lazy DataFrame. Mart functions take a
:class:`RunContext` carrying the run time and the mart's current snapshot; they
return the rows to merge, which :mod:`tidemark.plans.marts` upserts.

Scale notes (what each model shuffles):

* orders/journey latest: the order columns alone tell an id's latest version (one row per id and
  map task); the wide rows are shuffled once, on the order id, and stay there up to the merge.
* identity map: one aggregate on (email, phone) with map-side combine, one
  join with the current snapshot on the same key.
* shop map: customers are reduced to one row per (shop id, contact value)
  with max(updated_at) *before* the email/phone equi-joins; blank contact
  values (a hot key by construction) are salted.
* customer profile: raw customers are aggregated to one row per shop id,
  joined to the shop links (inner, so AQE may split a hot shop id), combined
  per customer id map-side, then joined 1:1 to the identities.
* orders/journey marts: JSON arrays are handled with higher-order functions
  inside the row (no explode, no shuffle); each document is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import safe_bigint, safe_bool, safe_decimal, safe_timestamp
from tidemark.functions.ids import key_uuid
from tidemark.functions.jsonx import JsonRecord, array_scalars, object_scalar, parse_doc
from tidemark.operators.incremental import RunContext, changed_keys, fresh_versions, incremental_filter, keep_keys
from tidemark.operators.latest import latest_value, latest_version, newest_versions
from tidemark.operators.links import HOT_SALTS, find_hot_values, grid_equi_join, link_on_any, salted_equi_join
from tidemark.schemas import (
    JOURNEY_MART_COLUMNS, NUMERIC, ORDERS_LATEST_COLUMNS, ORDERS_LATEST_RENAMES, ORDERS_MART_COLUMNS, TS_NTZ,
)

UNKNOWN_CUSTOMER = "unknown"
EMPTY_JSON_OBJECT = "{}"


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


# ------------------------------------------------------------------ D1-D4

def contact_pairs(customers: DataFrame) -> DataFrame:
    """Distinct (email, phone, updated_at) with NULL -> '', at least one contact present."""
    return (customers
            .filter(_present(F.col("email")) | _present(F.col("phone")))
            .select(_blank(F.col("email")).alias("email"), _blank(F.col("phone")).alias("phone"),
                    "updated_at")
            .distinct())


def _shop_id() -> Column:
    return safe_bigint(object_scalar("customer", "$.id"))


def orders_latest(orders: DataFrame, extracted_col: str = "_airbyte_extracted_at") -> DataFrame:
    """Latest version per order id, projected and renamed; shop customer id read from JSON."""
    latest = latest_version(orders.filter(F.col("id").isNotNull()), "id", ["updated_at", extracted_col])
    shop_id = latest.select("*", _shop_id().alias("_shopify_id"))
    renames = dict(ORDERS_LATEST_RENAMES, shopify_id="_shopify_id")
    return shop_id.selectExpr(*[f"`{renames.get(c, c)}` AS `{c}`" for c in ORDERS_LATEST_COLUMNS],
                              f"`{extracted_col}`", "updated_at")


def journey_latest(journey: DataFrame, extracted_col: str = "_airbyte_extracted_at") -> DataFrame:
    """D3: latest journey summary per order id."""
    kept = journey.filter(F.col("order_id").isNotNull()
                          & F.col("customer_journey_summary").isNotNull())
    latest = latest_version(kept, "order_id", ["updated_at", extracted_col])
    return latest.select(F.col("order_id").alias("shopify_order_id"), "shop_url", "created_at",
                         "customer_journey_summary", "updated_at", extracted_col)


def _identity_keys(identity_map: DataFrame) -> DataFrame:
    return identity_map.select("customer_id", _blank(F.col("email")).alias("email"),
                               _blank(F.col("phone")).alias("phone"))


def _hot(ignore_blank: bool) -> tuple[str, ...]:
    return () if ignore_blank else ("",)


def shop_links(customers: DataFrame, identity_map: DataFrame, ignore_blank: bool = False,
               salts: int = HOT_SALTS, pairs_per_task: int | None = None) -> DataFrame:
    """Distinct (customer_id, shopify_id, updated_at) where email OR phone matches.

    Written as two salted equi-joins instead of the OR join. A blank ('')
    contact matches every identity whose value is blank (H2); ``ignore_blank``
    drops those matches instead. ``pairs_per_task``: hot contacts are found from the
    data (see :func:`tidemark.operators.links.find_hot_values`) instead of '' being salted.
    """
    src = customers.filter(F.col("id").isNotNull()).select(
        "email", "phone", F.col("id").alias("shopify_id"), "updated_at")
    if ignore_blank:
        src = src.select(F.nullif("email", F.lit("")).alias("email"),
                         F.nullif("phone", F.lit("")).alias("phone"), "shopify_id", "updated_at")
    # the identity side holds every NULL-normalised blank: spread it, copy the raw side
    return link_on_any(src, _identity_keys(identity_map), [("email", "email"), ("phone", "phone")],
                       ["shopify_id", "updated_at"], ["customer_id"], _hot(ignore_blank), salts,
                       replicate="left", pairs_per_task=pairs_per_task).select("customer_id", "shopify_id", "updated_at")


# ------------------------------------------------------------------ D5-D7

def identity_map_updates(customers: DataFrame, ctx: RunContext) -> DataFrame:
    """One row per (email, phone), with the id derived from the pair; the merge keeps an id known before."""
    now = ctx.now_col()
    src = customers.filter(_present(F.col("email")) | _present(F.col("phone")))
    src = incremental_filter(src, ctx.source_ts, ctx)
    pairs = src.groupBy(_blank(F.col("email")).alias("email"),
                        _blank(F.col("phone")).alias("phone")).agg(F.max("updated_at").alias("_max_ts"))
    return pairs.select(key_uuid(F.col("email"), F.col("phone")).alias("customer_id"), "email", "phone",
                        now.alias("created_at"), now.alias("updated_at"))


def id_registry_updates(identity_map: DataFrame, ctx: RunContext) -> DataFrame:
    """Every customer id of the identity map; the merge carries a known merge_record forward."""
    now = ctx.now_col()
    return identity_map.select("customer_id").distinct().select(
        "customer_id", F.lit(EMPTY_JSON_OBJECT).alias("merge_record"), now.alias("created_at"), now.alias("updated_at"))


def shop_map_updates(customers: DataFrame, identity_map: DataFrame, ctx: RunContext,
                     ignore_blank: bool = False, salts: int = HOT_SALTS,
                     pairs_per_task: int | None = None) -> DataFrame:
    """One row per (customer_id, shopify_id) linked since the high-water mark.

    Same result as grouping :func:`shop_links` by the pair with max(updated_at),
    but each contact arm is first reduced to one row per (shop id, value). With
    ``pairs_per_task`` hot contacts are found from the data, as in :func:`shop_links`.
    """
    now = ctx.now_col()
    src = incremental_filter(customers.filter(F.col("id").isNotNull()), ctx.source_ts, ctx)
    ids = _identity_keys(identity_map)
    arms = []
    for c in ("email", "phone"):
        left = src.filter(F.col(c).isNotNull())
        if ignore_blank:
            left = left.filter(F.col(c) != "")
        contacts = left.select(F.col(c).alias("_k"))
        left = (left.groupBy(F.col(c).alias("_k"), F.col("id").alias("shopify_id"))
                .agg(F.max("updated_at").alias("updated_at")))
        right = ids.select(F.col(c).alias("_k"), "customer_id").distinct()
        if pairs_per_task is None:
            # the identity side holds every NULL-normalised blank: spread it, copy the raw side
            arm = salted_equi_join(right, left, "_k", _hot(ignore_blank), salts)
        else:
            arm = grid_equi_join(left, right, "_k", find_hot_values(contacts, right, "_k", pairs_per_task))
        arms.append(arm.select("customer_id", "shopify_id", "updated_at"))
    links = (arms[0].unionByName(arms[1]).groupBy("customer_id", "shopify_id")
             .agg(F.max("updated_at").alias("_max_ts")))
    return links.select(now.alias("created_at"), now.alias("updated_at"), "customer_id", "shopify_id")


def shop_latest_customer(shop_map: DataFrame) -> DataFrame:
    """A4: most recently mapped customer per shop id (ties: larger customer id)."""
    return (shop_map.groupBy("shopify_id")
            .agg(latest_value("customer_id", ["updated_at", "customer_id"]).getField("v")
                 .alias("customer_id")))


# ------------------------------------------------------------------ D8

PROFILE_LATEST = (("currency", "currency"), ("addresses", "addresses"),
                  ("first_name", "firstname"), ("last_name", "lastname"))


def changed_customer_ids(customers: DataFrame, identity_map: DataFrame, shop_map: DataFrame,
                         ctx: RunContext) -> DataFrame:
    """I4: ids touched since the customer mart's mark in the maps or the raw customers."""
    touched_raw = (incremental_filter(customers, ctx.source_ts, ctx).select(F.col("id").alias("shopify_id"))
                   .join(shop_map.select("customer_id", "shopify_id").hint("merge"), "shopify_id", "inner"))
    return changed_keys("customer_id",
                        incremental_filter(identity_map, "updated_at", ctx),
                        incremental_filter(shop_map, "updated_at", ctx),
                        touched_raw)


def customer_profile_updates(customers: DataFrame, identity_map: DataFrame, shop_map: DataFrame,
                             ctx: RunContext, tiebreak: str | None = None) -> DataFrame:
    """One profile row per identity, values from the linked shop customers.

    Latest non-NULL currency/addresses/names by updated_at (then ``tiebreak``),
    earliest created_at, sorted distinct tags as a JSON array (NULL when none).

    Plan: raw customers -> one row per shop id; shop links x that (inner join,
    skew-splittable) -> partial + final aggregate per customer id; identities
    LEFT JOIN the per-customer row (1:1). No step fans out over versions, and a
    customer id linked to very many shops is combined map-side.
    """
    now = ctx.now_col()
    order = ["updated_at"] + ([tiebreak] if tiebreak else [])
    raw = customers.filter(F.col("id").isNotNull()).withColumnRenamed("id", "shopify_id")
    idmap = identity_map.select("customer_id", "email", "phone", F.col("created_at").alias("_map_created"))
    links = shop_map.select("customer_id", "shopify_id")
    if ctx.incremental:
        # the key set feeds identities, links and raw rows: worked out once where the run can store it
        changed = ctx.staged("changed_customers", changed_customer_ids(customers, identity_map, shop_map, ctx))
        idmap = keep_keys(idmap, changed, "customer_id")
        links = keep_keys(links, changed, "customer_id")
        # only the raw versions of shops linked to a changed customer are aggregated
        raw = keep_keys(raw, links.select("shopify_id").distinct(), "shopify_id")
    per_shop = raw.groupBy("shopify_id").agg(
        *[latest_value(src, order, when=F.col(src).isNotNull()).alias(f"_l_{out}")
          for src, out in PROFILE_LATEST],
        F.min("created_at").alias("_min_created"))
    # Distinct (customer, tag) pairs first: what is then collected is no more than the output.
    shop_tags = raw.filter(F.col("tags").isNotNull()).select("shopify_id", F.col("tags").alias("_tag")).distinct()
    # Stored links are far more in memory than their file's size tells: they are shuffled, never broadcast by it.
    tag_lists = (links.join(shop_tags.hint("merge"), "shopify_id", "inner").select("customer_id", "_tag").distinct()
                 .groupBy("customer_id").agg(F.sort_array(F.collect_list("_tag")).alias("_tag_list")))
    per_customer = links.join(per_shop.hint("merge"), "shopify_id", "inner").groupBy("customer_id").agg(
        *[F.max(f"_l_{out}").getField("v").alias(out) for _, out in PROFILE_LATEST],
        F.min("_min_created").alias("shopify_created_at"))
    src = idmap.join(per_customer, "customer_id", "left").join(tag_lists, "customer_id", "left")
    created = F.coalesce(F.col("_map_created"), now)
    shop_tags = F.when(F.size("_tag_list") > 0, F.to_json("_tag_list"))
    return src.select(created.alias("created_at"), now.alias("updated_at"), "customer_id", "email",
                      "phone", "currency", "addresses", "firstname", "lastname", "shopify_created_at",
                      shop_tags.alias("shopify_tags"))


# ------------------------------------------------------------------ D9

def _sum_decimals(arr: Column) -> Column:
    """Sum of a decimal(38,9) array; NULL when empty or all NULL.

    Both sides of an addition are narrowed to (37,9), so that its type stays (38,9) with no scale loss.
    A sum or addend that does not fit raises: an addend is never left out.
    """
    d37 = "decimal(37,9)"

    def narrow(v: Column) -> Column:
        too_large = F.raise_error(F.concat(F.lit("decimal sum out of range: "), v.cast("string"))).cast(d37)
        return F.coalesce(v.try_cast(d37), F.when(v.isNotNull(), too_large))
    return F.aggregate(arr, F.lit(None).cast(NUMERIC), lambda acc, x: F.when(acc.isNull(), x).when(
        x.isNull(), acc).otherwise((narrow(acc) + narrow(x)).cast(NUMERIC)))


def line_item_skus(line_items: Column, doc: Column) -> Column:
    """JSON array of the non-NULL ``sku`` scalars of the line items (text and parsed ``doc``), in order."""
    skus = F.filter(array_scalars(line_items, doc, "$.sku"), lambda s: s.isNotNull())
    return F.to_json(F.coalesce(skus, F.array().cast("array<string>")))


def line_item_products(line_items: Column, doc: Column) -> Column:
    """JSON array of product ids; a present but non-integer id becomes null."""
    texts = F.filter(array_scalars(line_items, doc, "$.product_id"), lambda s: s.isNotNull())
    ids = F.transform(texts, lambda s: safe_bigint(s))
    return F.to_json(F.coalesce(ids, F.array().cast("array<bigint>")))


def shipping_total(shipping_lines: Column, doc: Column) -> Column:
    """Sum of ``discounted_price`` over the shipping lines as decimal(38,9)."""
    return _sum_decimals(F.transform(array_scalars(shipping_lines, doc, "$.discounted_price"), lambda p: safe_decimal(p)))


def late_resolved_orders(stored: DataFrame, fresh_ids: DataFrame, shop_map: DataFrame, ctx: RunContext) -> DataFrame:
    """Stored orders without a customer whose shop id was linked since the orders mart's mark, now resolved.

    A delta join: the links since the mark name the shop ids, only these ids' links are reduced to the
    latest customer, and only stored 'unknown' rows (a filter in the scan) meet them. Orders that the run
    rewrites anyway (``fresh_ids``) are left to it. ``created_at`` is kept by the merge.
    """
    linked = incremental_filter(shop_map, "updated_at", ctx).select("shopify_id").distinct()
    customer = shop_latest_customer(keep_keys(shop_map, linked, "shopify_id")).withColumnRenamed("customer_id", "_found")
    waiting = (stored.filter(F.col("customer_id") == UNKNOWN_CUSTOMER).join(customer, "shopify_id", "inner")
               .join(fresh_ids, "order_id", "left_anti"))
    new = {"customer_id": F.col("_found"), "updated_at": ctx.now_col()}
    return waiting.select(*[new.get(c, F.col(c)).alias(c) for c in ORDERS_MART_COLUMNS])


def with_customer(latest: DataFrame, versions: DataFrame, shop_map: DataFrame, extracted_col: str) -> DataFrame:
    """``latest`` orders with the latest customer of their shop id (``_map_customer``, NULL if none).

    (order id, shop id) pairs look the customer up, so that the wide orders need not be dealt out by shop
    id: they meet the pair of their own shop id where the order id has put them. The pairs are those of all
    versions that may be an order's latest one.
    """
    newest = newest_versions(versions.filter(F.col("id").isNotNull()), "id", ["updated_at", extracted_col])
    pairs = (newest.select(F.col("id").alias("_order"), _shop_id().alias("shopify_id"))
             .filter(F.col("shopify_id").isNotNull()).distinct())
    found = pairs.join(shop_latest_customer(shop_map), "shopify_id").select(
        "_order", F.col("shopify_id").alias("_shop"), F.col("customer_id").alias("_map_customer"))
    # Two comparisons instead of an equality, which would deal the orders out by shop id as well.
    same = (F.col("shopify_id") <= F.col("_shop")) & (F.col("shopify_id") >= F.col("_shop"))
    return latest.join(found, (F.col("order_id") == F.col("_order")) & same, "left").drop("_order", "_shop")


def orders_mart_updates(orders: DataFrame, shop_map: DataFrame, ctx: RunContext,
                        extracted_col: str = "_airbyte_extracted_at", resolve_late: bool = False) -> DataFrame:
    """Latest orders with a shop customer id, resolved to a customer id ('unknown' if none).

    The high-water filter is applied to the raw versions *before* the
    latest-per-id window (:func:`fresh_versions`), so the window only sees rows
    newer than the mark, and the filter reaches the scan. No look at the target
    is needed: the merge keeps ``created_at``. ``resolve_late`` adds
    :func:`late_resolved_orders` in an incremental run.
    """
    now = ctx.now_col()
    versions = fresh_versions(orders, "id", ctx)
    fresh = orders_latest(versions, extracted_col).filter(F.col("shopify_id").isNotNull())
    src = with_customer(fresh, versions, shop_map, extracted_col).select("*", parse_doc("line_items").alias("_li"), parse_doc("shipping_lines").alias("_sl"))
    derived = {
        "created_at": now,
        "updated_at": now,
        "customer_id": F.coalesce(F.col("_map_customer"), F.lit(UNKNOWN_CUSTOMER)),
        "order_name": _blank(F.col("order_name")),
        "email": _blank(F.col("email")),
        "order_created_at": F.coalesce(F.col("order_created_at"), now),
        "sku": line_item_skus(F.col("line_items"), F.col("_li")),
        "shopify_product_id": line_item_products(F.col("line_items"), F.col("_li")),
        "total_price": F.coalesce(F.col("total_price"), F.lit(0).cast(NUMERIC)),
        "shipping_price": shipping_total(F.col("shipping_lines"), F.col("_sl")),
    }
    src = src.select("*", *[v.alias(f"_d_{k}") for k, v in derived.items()])
    updates = src.selectExpr(*[f"`_d_{c}` AS `{c}`" if c in derived else f"`{c}`" for c in ORDERS_MART_COLUMNS])
    if resolve_late and ctx.incremental:
        updates = updates.unionByName(late_resolved_orders(ctx.target, fresh.select("order_id"), shop_map, ctx))
    return updates


# ------------------------------------------------------------------ D10

def _camel(snake: str) -> str:
    head, *rest = snake.split("_")
    return head + "".join(p.capitalize() for p in rest)


def visit_paths(prefix: str, field: str) -> list[str]:
    """Candidate paths of a visit field: flat snake, flat camel, nested snake, nested camel."""
    return [f"$.{prefix}_{field}", f"$.{_camel(prefix + '_' + field)}",
            f"$.{prefix}_visit.{field}", f"$.{prefix}Visit.{_camel(field)}"]


def snake_camel_paths(*names: str) -> list[str]:
    out = []
    for n in names:
        out += [f"$.{n}", f"$.{_camel(n)}"]
    return out


# Names the journey summary may use for each output.
ORDER_INDEX_NAMES = ("order_index", "customer_order_index")
DAY_TO_CONVERSION_NAMES = ("day_to_conversion", "days_to_conversion")
MOMENTS_COUNT_PATHS = ("$.moments_count.count", "$.momentsCount.count", "$.moments_count",
                       "$.momentsCount")
VISIT_TEXT_FIELDS = ("referral_code", "referrer_url", "source", "source_type")


def journey_paths() -> list[str]:
    paths = snake_camel_paths(*ORDER_INDEX_NAMES) + snake_camel_paths(*DAY_TO_CONVERSION_NAMES)
    paths += ["$.ready", "$.moments", *MOMENTS_COUNT_PATHS]
    for prefix in ("first", "last"):
        for f in ("landing_page", "occurred_at", *VISIT_TEXT_FIELDS, "utm_parameters"):
            paths += visit_paths(prefix, f)
    return paths


def journey_record(text) -> JsonRecord:
    subtrees = ["$.moments", *[p for v in ("first", "last") for p in visit_paths(v, "utm_parameters")]]
    return JsonRecord(text, journey_paths(), subtrees, ["$.moments"])


def journey_fields(rec: JsonRecord, ts_type: T.DataType = TS_NTZ) -> dict[str, Column]:
    """The journey summary fields, by ordered fallback over candidate paths.

    ``rec`` must be bound to the parsed summary (see :class:`JsonRecord`); times come out as ``ts_type``.
    """
    out = {
        "order_index": rec.first_scalar(snake_camel_paths(*ORDER_INDEX_NAMES), safe_bigint, 0),
        "day_to_conversion": rec.first_scalar(snake_camel_paths(*DAY_TO_CONVERSION_NAMES), safe_bigint, 0),
        "ready": F.coalesce(safe_bool(rec.scalar("$.ready")), F.lit(False)),
    }
    for prefix in ("first", "last"):
        out[f"{prefix}_landing_page"] = rec.first_scalar(
            visit_paths(prefix, "landing_page"), lambda t: F.nullif(t, F.lit("")), "")
        out[f"{prefix}_occurred_at"] = rec.first_scalar(
            visit_paths(prefix, "occurred_at"), lambda t: safe_timestamp(t, ts_type), convert_each=False)
        for f in VISIT_TEXT_FIELDS:
            out[f"{prefix}_{f}"] = rec.first_scalar(visit_paths(prefix, f))
        out[f"{prefix}_utm_parameters"] = rec.first_subtree(visit_paths(prefix, "utm_parameters"))
    out["moments"] = rec.subtree("$.moments")
    out["moments_count"] = rec.first_scalar(MOMENTS_COUNT_PATHS, safe_bigint, rec.array_length("$.moments").cast("bigint"))
    return out


def journey_mart_updates(journey: DataFrame, orders_mart: DataFrame, ctx: RunContext,
                         extracted_col: str = "_airbyte_extracted_at") -> DataFrame:
    """Journeys of orders with a resolved customer, summary fields flattened.

    As in the orders mart, the high-water filter runs before the latest-per-id
    window (exact for the same reason).
    """
    now = ctx.now_col()
    resolved = orders_mart.filter(
        F.col("customer_id").isNotNull() & (F.col("customer_id") != UNKNOWN_CUSTOMER)
        & F.col("shopify_id").isNotNull()
    ).select(F.col("order_id").alias("shopify_order_id"), "customer_id", "shopify_id")
    latest = journey_latest(fresh_versions(journey, "order_id", ctx), extracted_col)
    # The journeys lie sorted by order id; the orders join them there, not by a broadcast that the file's size suggests.
    src = latest.join(resolved.hint("merge"), "shopify_order_id", "inner")
    rec = journey_record("customer_journey_summary")
    src = src.select("*", rec.struct().alias("_rec"))
    derived = journey_fields(rec.bind("_rec"), ctx.ts_type)
    derived.update({
        "created_at": now, "updated_at": now,
        "shop_url": _blank(F.col("shop_url")),
    })
    return src.select(*[(derived[c] if c in derived else F.col(c)).alias(c) for c in JOURNEY_MART_COLUMNS])
