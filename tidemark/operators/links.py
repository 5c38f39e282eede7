"""Link rows whose email OR phone matches (J1), without a nested-loop join.

``a.email = b.email OR a.phone = b.phone`` has no equi-join key, so Spark
plans it as a nested-loop join. It equals the union of two equi-joins, one per
arm, made distinct. Each arm de-duplicates its inputs first, and keeps a pair
only where it is met first, so that the links need no distinct of their own.

Blank values ('') match every other blank (hazard H2), which makes '' a hot
key that can hold a large share of the rows. Hot keys are split with a salt:
rows of the larger side get a salt from a hash of the row, rows of the
smaller side are replicated over all salts, so one hot key spreads over
``salts`` tasks instead of one. Other keys keep salt 0 and are not copied.
Hot keys that are not known in advance are found by :func:`find_hot_values` (approximate top-k of both
sides) and spread over a grid (:func:`grid_equi_join`); what neither names is left to AQE's skew-join
split.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_SALTS = 64
PAIRS_PER_TASK = 4_000_000
TOP_VALUES = 64
TRACKED_VALUES = 10_000

Grid = tuple[int, int]              # parts of the left and of the right rows of a value
Grids = Mapping[str, Grid]


def salted_equi_join(big: DataFrame, small: DataFrame, key: str, hot: Sequence[str],
                     salts: int = HOT_SALTS, how: str = "inner") -> DataFrame:
    """Equi-join on ``key``; keys listed in ``hot`` are spread over ``salts`` tasks.

    The salt is a hash of the row, not a random number, so a task recomputed
    after an executor loss assigns every row to the same salt again.
    """
    if salts <= 1 or not hot:
        return big.join(small, key, how)
    is_hot_big = F.col(key).isin(*hot)
    big_s = big.withColumn(
        "_salt", F.when(is_hot_big, F.pmod(F.xxhash64(*big.columns), F.lit(salts))).otherwise(0))
    small_s = small.withColumn(
        "_salt", F.explode(F.when(F.col(key).isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1)))
                           .otherwise(F.array(F.lit(0)))))
    return big_s.join(small_s, [key, "_salt"], how).drop("_salt")


def grid_of(left_rows: int, right_rows: int, pairs_per_task: int = PAIRS_PER_TASK) -> Grid:
    """How to split a value's rows so that a task joins about ``pairs_per_task`` of its pairs or fewer.

    The left rows fall into a parts and the right rows into b, a task joining one part with another. Of
    all (a, b) with enough tasks the one is taken that copies least: left rows are copied b times, right
    rows a times. A side with few rows thus stays whole and is copied, the other is spread.
    """
    tasks = max(1, math.ceil(left_rows * right_rows / pairs_per_task))
    a = min(max(1, round(math.sqrt(tasks * left_rows / max(right_rows, 1)))), tasks, max(left_rows, 1))
    b = min(math.ceil(tasks / a), max(right_rows, 1))
    return min(math.ceil(tasks / b), max(left_rows, 1)), b


def find_hot_values(left: DataFrame, right: DataFrame, key: str, pairs_per_task: int = PAIRS_PER_TASK,
                    k: int = TOP_VALUES, tracked: int = TRACKED_VALUES) -> dict[str, Grid]:
    """Values of ``key`` with more pairs than a task should join, and the grid of each.

    One job, which reads the key columns of both sides only: an approximate top-k per side, merged from
    sketches of ``tracked`` values a task, so at most ``2 * k`` values come back whatever the input.
    A value that a full list doesn't name counts as that list's last one: too fine a grid costs copies,
    not links. It is worked out once, before the join is planned: both sides must see the same grids, and
    an approximate count could come out differently the second time.
    """
    def top(df: DataFrame, side: str) -> DataFrame:
        return df.filter(F.col(key).isNotNull()).agg(
            F.expr(f"approx_top_k(`{key}`, {k}, {tracked})").alias("top")).select(F.lit(side).alias("side"), "top")
    lists = {r["side"]: {t["item"]: t["count"] for t in r["top"] or ()} for r in top(left, "l").unionByName(top(right, "r")).collect()}

    def rows(side: str, value: str) -> int:
        known = lists[side]
        return known.get(value, min(known.values()) if len(known) >= k else 0)
    grids = {v: grid_of(rows("l", v), rows("r", v), pairs_per_task) for v in {**lists["l"], **lists["r"]}}
    return {v: g for v, g in grids.items() if g != (1, 1)}


def grid_equi_join(left: DataFrame, right: DataFrame, key: str, grids: Grids) -> DataFrame:
    """Inner equi-join on ``key``; the rows of a value in ``grids`` are joined part by part.

    A row's part is a hash of the row, so a task recomputed after an executor loss puts it there again.
    Each pair of rows meets in exactly one task: the left row's part, the right row's part. Both sides are
    shuffled: a plan's size estimate doesn't see the copies, which grow with the other side's rows, and
    a broadcast chosen by it would gather them all in the driver.
    """
    if not grids:
        return left.join(right, key)
    known = F.create_map(*[x for v, (a, b) in grids.items() for x in (F.lit(v), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")))])
    one = F.struct(F.lit(1).alias("a"), F.lit(1).alias("b"))

    def parts(df: DataFrame, own: str, own_part: str, other: str, other_part: str) -> DataFrame:
        row = F.xxhash64(*df.columns)
        grid = F.coalesce(F.try_element_at(known, F.col(key)), one)
        return (df.select("*", grid.alias("_grid"), row.alias("_row"))
                .select(*df.columns, F.pmod(F.col("_row"), F.col(f"_grid.{own}")).cast("int").alias(own_part),
                        F.explode(F.sequence(F.lit(0), F.col(f"_grid.{other}") - 1)).alias(other_part)))
    return (parts(left, "a", "_i", "b", "_j").join(parts(right, "b", "_j", "a", "_i").hint("merge"), [key, "_i", "_j"])
            .drop("_i", "_j"))


def link_on_any(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
                left_cols: Sequence[str], right_cols: Sequence[str],
                hot_values: Sequence[str] = ("",), salts: int = HOT_SALTS,
                replicate: str = "left", pairs_per_task: int | None = None) -> DataFrame:
    """Distinct ``left_cols + right_cols`` of rows where any ``left.l = right.r`` holds.

    ``pairs`` lists the (left column, right column) equalities of the OR.
    Right-side join columns must already be normalised (e.g. NULL -> '').
    A NULL on the left never matches. For keys in ``hot_values`` the
    ``replicate`` side is copied over the salts and the other side spread. With ``pairs_per_task``
    hot values, their parts and the side that is copied are found from the data instead (one job).

    There can be many more links than rows, so they are not shuffled to be made distinct where that can be
    told from the two rows: if the output columns of each stand in one row only, the pair is kept in the
    first arm that it meets in. Pairs with a row whose output columns repeat with other join values are
    made distinct by a shuffle.
    """
    def rows(df: DataFrame, cols: Sequence[str], side: int) -> tuple[DataFrame, DataFrame]:
        """Distinct rows whose output columns stand in no other one, and all others."""
        d = df.select(*cols, *[F.col(p[side]).alias(f"_{'lr'[side]}{i}") for i, p in enumerate(pairs)]).distinct()
        d = d.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*cols)))
        return d.filter("_n = 1").drop("_n"), d.filter("_n > 1").drop("_n")

    def arm(i: int, lrows: DataFrame, rrows: DataFrame, hot) -> DataFrame:
        l_arm = lrows.filter(F.col(f"_l{i}").isNotNull()).withColumn("_k", F.col(f"_l{i}"))
        r_arm = rrows.filter(F.col(f"_r{i}").isNotNull()).withColumn("_k", F.col(f"_r{i}"))
        if pairs_per_task is not None:
            return grid_equi_join(l_arm, r_arm, "_k", hot)
        big, small = (r_arm, l_arm) if replicate == "left" else (l_arm, r_arm)
        return salted_equi_join(big, small, "_k", hot, salts)

    (l_one, l_more), (r_one, r_more) = rows(left, left_cols, 0), rows(right, right_cols, 1)
    once, again = [], []
    for i, (lcol, rcol) in enumerate(pairs):
        hot = hot_values if pairs_per_task is None else find_hot_values(
            left.select(F.col(lcol).alias("_k")), right.select(F.col(rcol).alias("_k")), "_k", pairs_per_task)
        links = arm(i, l_one, r_one, hot)
        for j in range(i):
            links = links.filter(~F.coalesce(F.col(f"_l{j}") == F.col(f"_r{j}"), F.lit(False)))
        once.append(links)
        again += [arm(i, l_more, r_one.unionByName(r_more), hot), arm(i, l_one, r_more, hot)]

    def union(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, [p.select(*left_cols, *right_cols) for p in parts])
    return union(once).unionByName(union(again).distinct())


def matches_any(pairs: Sequence[tuple[str, str]], left_alias: str, right_alias: str) -> Column:
    """The OR predicate itself (used by tests to compare with the rewrite)."""
    cond = None
    for lcol, rcol in pairs:
        l = F.col(f"{left_alias}.{lcol}")
        c = l.isNotNull() & (l == F.col(f"{right_alias}.{rcol}"))
        cond = c if cond is None else (cond | c)
    return cond
