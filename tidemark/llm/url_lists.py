"""URL filters as a temporal list join, in DataFrame functions only.

Dated list entries (kind, pattern, action, effective_on) become validity
intervals: an entry holds from its date to the next entry of the same kind and
pattern. Every capture (id, url, fetched_on) is then evaluated against the
entries in force when it was fetched: an as-of join on the pattern, with the date
inside the interval. Of the entries that match, the most specific decides.

Kinds, from the least to the most specific: ``domain`` (the host or a host below
it), ``host`` (that host), ``prefix`` (host and path from their start, up to a
slash or the end). Within a kind the longer pattern decides. Actions: ``block``,
``allow`` and ``remove`` (ends what was in force). Of entries of one date for one
pattern, allow stands before block before remove.

A capture has as many patterns as its host has labels and its path has segments;
they are joined by hash of kind and pattern. A host with a third of all captures
is a skewed key of that equi-join, which adaptive execution splits, as the other
side has few rows a key.

Defined results: a null or hostless url, or a null date, matches nothing and is
kept. Entries with a null in any column are ignored. Repeated captures each get
a row. Empty lists keep everything. Extra columns of captures stay out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("domain", "host", "prefix")
ACTIONS = ("remove", "block", "allow")


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    authority = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")


def path_of(url: Column) -> Column:
    """The path without query and fragment; at least a slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", "/").otherwise(path)


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, action, valid_from, valid_to): what is in force when; valid_to is exclusive, or null."""
    rank = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    e = entries.select("kind", F.lower("pattern").alias("pattern"), "action",
                       F.col("effective_on").cast("date").alias("valid_from")).dropna()
    e = e.withColumn("rank", rank).filter("rank > 0 AND kind IN ('domain', 'host', 'prefix')")
    e = e.groupBy("kind", "pattern", "valid_from").agg(F.max("rank").alias("rank"))
    e = e.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy("kind", "pattern").orderBy("valid_from")))
    return (e.withColumn("action", F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("rank").cast("int")))
            .filter("action <> 'remove'").drop("rank"))


def patterns(captures: DataFrame) -> DataFrame:
    """(id, url, fetched_on, kind, pattern): one row for each pattern that would match the capture."""
    c = captures.filter("url IS NOT NULL AND fetched_on IS NOT NULL").distinct()
    c = c.withColumns({"host": host_of(F.col("url")), "path": F.lower(path_of(F.col("url")))}).filter("host <> ''")
    labels = F.split("host", r"\.")
    steps = F.split(F.regexp_replace("path", "^/", ""), "/")
    c = c.withColumns({"labels": labels, "steps": steps})
    domains = F.transform(F.sequence(F.lit(1), F.size("labels")),
                          lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    # host/, host/a/, host/a/b/ ... and the whole path.
    folders = F.transform(F.sequence(F.lit(0), F.size("steps") - 1),
                          lambda i: F.concat("host", F.lit("/"), F.array_join(
                              F.transform(F.slice("steps", F.lit(1), i), lambda s: F.concat(s, F.lit("/"))), "")))
    whole = F.concat("host", "path")

    def named(kind: str, values: Column) -> Column:
        return F.transform(values, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern")))
    every = F.concat(named("domain", domains), named("host", F.array("host")),
                     named("prefix", F.array_distinct(F.concat(folders, F.array(whole)))))
    return c.select("id", "url", "fetched_on", F.inline(every))


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures (id, url, fetched_on) with blocked, and kind, pattern and valid_from of the deciding entry."""
    captures = captures.select("id", "url", F.col("fetched_on").cast("date").alias("fetched_on"))
    inside = ((F.col("fetched_on") >= F.col("valid_from"))
              & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to"))))
    active = patterns(captures).join(intervals(entries), ["kind", "pattern"]).filter(inside)
    order = F.struct(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("specific"),
                     F.length("pattern").alias("long"), "kind", "pattern", "action", "valid_from")
    decided = active.groupBy("id", "url", "fetched_on").agg(F.max(order).alias("x"))
    decided = decided.select(F.col("id").alias("_id"), F.col("url").alias("_url"), F.col("fetched_on").alias("_on"), "x")
    same = (F.col("id").eqNullSafe(F.col("_id")) & (F.col("url") == F.col("_url"))
            & (F.col("fetched_on") == F.col("_on")))
    return captures.join(decided, same, "left").select(
        "id", "url", "fetched_on", F.coalesce(F.col("x.action") == "block", F.lit(False)).alias("blocked"),
        F.col("x.kind").alias("kind"), F.col("x.pattern").alias("pattern"), F.col("x.valid_from").alias("valid_from"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: the tables hold no fetch date, so it follows from the page's id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(366)).cast("int"))
    return pages.select(F.col("page_id").alias("id"), "url", day.alias("fetched_on"))


def page_list(pages: DataFrame) -> DataFrame:
    """A dated list made from the hosts of the pages: blocks that are lifted again, and allowed folders."""
    hosts = pages.filter("page_id IS NOT NULL").select("page_id", host_of(F.col("url")).alias("host")).filter("host <> ''")
    hosts = hosts.groupBy("host").agg(F.min("page_id").alias("m"))

    def entries(kind: str, pattern: Column, action: str, every: int, shift: Column) -> DataFrame:
        day = F.date_add(F.lit("2024-01-01").cast("date"), shift.cast("int"))
        return hosts.filter(F.pmod("m", F.lit(every)) == 0).select(
            F.lit(kind).alias("kind"), pattern.alias("pattern"), F.lit(action).alias("action"), day.alias("effective_on"))
    m = F.col("m")
    parent = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    lists = [entries("host", F.col("host"), "block", 3, F.pmod(m, F.lit(200))),
             entries("host", F.col("host"), "remove", 3, F.pmod(m, F.lit(200)) + 90),
             entries("domain", parent, "block", 5, F.pmod(m, F.lit(300))),
             entries("prefix", F.concat("host", F.lit("/en/")), "allow", 2, F.pmod(m, F.lit(250)))]
    out = lists[0]
    for other in lists[1:]:
        out = out.union(other)
    return out.filter("pattern <> ''")
