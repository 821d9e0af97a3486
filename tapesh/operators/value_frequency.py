"""Per-key results when a few keys hold most rows, by value-frequency compression.

Rows are grouped by key and value before key, so a task gets a key's distinct
values with their weights, never the key's rows.

Defined cases: a null key is a key of its own unless the caller filters it;
null values are counted by no function here, except that a null sorts first
in select_at. Ties are broken by the later order columns, then by value. An
empty table gives an empty result. Columns not named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapesh.runtime import Scratch, hot_values, lookup_join

#: Order-preserving prefixes of microseconds since the epoch, coarse to fine; no step has over 10^6 values within one of the step before it, but the first.
TIME_STEPS = (86_400_000_000, 1_000_000, 1)
#: The same for ids.
ID_STEPS = (1 << 40, 1 << 20, 1)
_LOWEST = -(1 << 62)


def value_frequencies(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, value, n: how often each key has each non-null value."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(frequencies: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, n_rows, n_distinct from value_frequencies; exact."""
    return frequencies.groupBy(*keys).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))


def modes(frequencies: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, mode, mode_n: the most frequent value of each key, the smallest of equally frequent ones."""
    return frequencies.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias("mode"), F.max("n").alias("mode_n"))


def value_stats(frequencies: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, n_rows, n_distinct, mode, mode_n in one aggregation."""
    mode = F.min_by(value, F.struct(-F.col("n"), F.col(value)))
    return frequencies.groupBy(*keys).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), mode.alias("mode"), F.max("n").alias("mode_n"))


def _steps(column: str, steps: Sequence[int]) -> list[Column]:
    value = f"coalesce(`{column}`, {_LOWEST} + 1)"
    return [F.expr(value if s == 1 else f"({value} div {s}L) - if({value} < 0 and {value} % {s}L <> 0, 1, 0)") for s in steps]


def select_at(rows: DataFrame, keys: Sequence[str], order: dict[str, Sequence[int]], place: str) -> DataFrame:
    """The row of each key at a place of its order.

    order maps bigint columns to their steps (TIME_STEPS, ID_STEPS); place is
    a SQL expression on _n, a key's number of rows, counted from 1. A key's rows
    are compressed to the values of the first step of the order with their
    weights, the value that holds the place is kept, and so on with finer
    steps, over the rows of the values kept. A key is done once its value has
    one row, or at the last step. No rows are sorted: a task holds a key's
    distinct values of one step, whatever the key's share of the rows.

    Returns keys, the order columns, n.
    """
    return select_places(rows, keys, order, {"": place}).drop("which")


def select_places(rows: DataFrame, keys: Sequence[str], order: dict[str, Sequence[int]], places: dict[str, str]) -> DataFrame:
    """which, keys, the order columns, n: select_at() for several places at once, each with its name."""
    scratch = Scratch(rows.sparkSession, "select")
    steps = [(f"_s{k}", step) for k, step in enumerate(step for column, its in order.items() for step in _steps(column, its))]
    # the keys as one struct, in which nulls are equal
    row = [f"_o{k}" for k in range(len(order))]
    left = rows.select(F.struct(*keys).alias("_key"), *[F.col(c).alias(o) for c, o in zip(order, row, strict=True)], *[step.alias(name) for name, step in steps])
    all_places = F.array(*[F.struct(F.lit(which).alias("which"), F.expr(place).alias("_place")) for which, place in places.items()])
    found: DataFrame | None = None
    for k, (name, _) in enumerate(steps):
        # one pass for all places at the first step, later the rows of each place's value
        of = ["_key"] if k == 0 else ["which", "_key"]
        kept = [] if k == 0 else [F.max("_n").alias("_n"), F.max("_place").alias("_place")]
        weights = left.groupBy(*of, name).agg(F.count(F.lit(1)).alias("_cnt"), *kept, *[F.min(o).alias(o) for o in row])
        by = Window.partitionBy(*of)
        weights = weights.withColumn("_cum", F.sum("_cnt").over(by.orderBy(name).rowsBetween(Window.unboundedPreceding, 0)))
        if k == 0:
            weights = weights.withColumn("_n", F.sum("_cnt").over(by)).select("*", F.explode(all_places).alias("_p")).select("*", "_p.*").drop("_p")
        hit = weights.where((F.col("_cum") >= F.col("_place")) & (F.col("_cum") - F.col("_cnt") < F.col("_place")))
        hit = hit.select("which", "_key", name, *row, "_n", (F.col("_place") - F.col("_cum") + F.col("_cnt")).alias("_place"), "_cnt", F.xxhash64("_key", name).alias("_hash"))
        hit = scratch.write(hit, f"step{k}")
        last = k == len(steps) - 1
        done = (hit if last else hit.where("_cnt = 1")).select("which", "_key.*", *[F.col(o).alias(c) for c, o in zip(order, row, strict=True)], F.col("_n").alias("n"))
        found = done if found is None else found.unionByName(done)
        if last:
            return found
        more = hit.where("_cnt > 1")
        n_more, most = more.agg(F.count(F.lit(1)), F.max("_cnt")).first()
        if not n_more:
            return found
        hot_of = lambda counts: hot_values(counts, "_hash", "_cnt", rows=most * len(places))
        of_value = ["_hash", "_key", name] if k == 0 else ["_hash", "which", "_key", name]
        rows_now = left.drop("_n", "_place").withColumn("_hash", F.xxhash64("_key", name))
        if k == 0:  # the places of a value go together, the rows are copied to each after the join
            asked = more.groupBy(*of_value).agg(F.max("_cnt").alias("_cnt"), F.max("_n").alias("_n"), F.collect_list(F.struct("which", "_place")).alias("_w"))
            now = lookup_join(rows_now, asked.drop("_cnt"), of_value, hot_of(asked), F.struct(*row))
            now = now.select("*", F.explode("_w").alias("_p")).select("*", "_p.*").drop("_w", "_p")
        else:
            now = lookup_join(rows_now, more.select(*of_value, "_n", "_place"), of_value, hot_of(more), F.struct(*row))
        before, left = left, scratch.write(now.drop("_hash", name), f"rows{k}")
        scratch.drop(before)
    raise AssertionError("unreachable")


#: Place of the lower median among _n rows: ceil(n / 2).
LOWER_MEDIAN = "cast((_n + 1) div 2 as bigint)"
