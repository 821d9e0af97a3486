"""Vectors as array<float> columns: DOUBLE arithmetic in code generation, aggregates by position.

A null vector stays null; a zero vector has cosine 0 with any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapesh.runtime import lookup_join


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0)))


def unit(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: F.coalesce(F.try_divide(x.cast("double"), n), F.lit(0.0)))


def or_zeros(a: Column, dim: int) -> Column:
    """The vector, or zeros where embedding failed."""
    return F.coalesce(a, F.array_repeat(F.lit(0.0).cast("float"), dim))


#: Elements of a vector that are aggregated as columns of one row.
BLOCK = 32


def positional(df: DataFrame, keys: Sequence[str], vec: Column, how: str, out: str) -> DataFrame:
    """keys, out: element-wise 'sum' or 'avg' of vectors, combined before the shuffle.

    A vector goes as a row per BLOCK elements, whose sums are columns, not as
    a row per element. Elements that are null in all vectors are left out.
    """
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(vec) - 1, F.lit(0)), F.lit(BLOCK)), lambda i: F.slice(vec, i + 1, BLOCK))
    rows = df.where(F.size(vec) > 0).select(*keys, F.posexplode(blocks).alias("_i", "_b"))
    each = [getattr(F, how)(F.get("_b", F.lit(j)).cast("double")).alias(f"_x{j}") for j in range(BLOCK)]
    parts = rows.groupBy(*keys, "_i").agg(*each).select(*keys, "_i", F.array(*[f"_x{j}" for j in range(BLOCK)]).alias("_x"))
    ordered = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_a"))
    return ordered.select(*keys, F.filter(F.flatten(F.transform("_a", lambda p: p["_x"])), lambda x: x.isNotNull()).alias(out))


def centroids(df: DataFrame, keys: Sequence[str], vec: str, out: str = "centroid") -> DataFrame:
    return positional(df, keys, F.col(vec), "avg", out)


def medoids(df: DataFrame, keys: Sequence[str], row: str, vec: str, hot: list | None = None) -> DataFrame:
    """keys, row, vec, row_sum of the member with the largest sum of cosines; of equal ones the smallest row.

    The sum of cosines to all members is the product with the sum of unit
    vectors, so the work is linear in the members. The largest is found by a
    combinable maximum, so that no task holds a cluster.
    """
    u = df.select(*keys, row, F.col(vec), unit(F.col(vec)).alias("_u"))
    total = positional(u, keys, F.col("_u"), "sum", "_sum")
    scored = lookup_join(u, total, list(keys), hot, F.col(row)).withColumn("row_sum", F.round(dot(F.col("_u"), F.col("_sum")), 9))
    best = scored.groupBy(*keys).agg(F.max(F.struct("row_sum", (-F.col(row)).alias("_neg"), F.col(vec).alias("v"))).alias("b"))
    return best.select(*keys, (-F.col("b._neg")).alias(row), F.col("b.v").alias(vec), F.col("b.row_sum").alias("row_sum"))
