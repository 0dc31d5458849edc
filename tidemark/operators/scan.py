"""Ordered scans in two levels, for groups too large to order in one task.

A window over a whole group puts it into one task. Here the group is cut into
blocks of its order (say months); the window runs inside each block, and a
second one over a row per block carries state from block to block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def previous_row(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """``value`` of the row before, per ``keys`` in the order of (block, order)."""
    inside = Window.partitionBy(*keys, block).orderBy(*order)
    own = df.withColumn("_own", F.lag(F.struct(F.col(value).alias("_value"))).over(inside))
    ends = df.groupBy(*keys, block).agg(F.max(F.struct(*order, F.col(value).alias("_value"))).alias("_end"))
    across = ends.select(*keys, block, F.lag("_end._value").over(Window.partitionBy(*keys).orderBy(block)).alias("_before"))
    return own.alias("o").join(across.alias("a"), [F.col(f"o.{k}").eqNullSafe(F.col(f"a.{k}")) for k in (*keys, block)], "left").select(
        *[F.col(f"o.{c}") for c in df.columns], F.when(F.col("o._own").isNotNull(), F.col("o._own._value")).otherwise(F.col("a._before")).alias(name)
    )


def last_known(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """The last non-null ``value`` up to each row, per ``keys`` in the order of (block, order)."""
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = df.withColumn("_own", F.last(value, ignorenulls=True).over(inside))
    ends = df.groupBy(*keys, block).agg(F.max(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_value")))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    across = ends.select(*keys, block, F.last("_end._value", ignorenulls=True).over(before).alias("_before"))
    return own.alias("o").join(across.alias("a"), [F.col(f"o.{k}").eqNullSafe(F.col(f"a.{k}")) for k in (*keys, block)], "left").select(
        *[F.col(f"o.{c}") for c in df.columns], F.coalesce("o._own", "a._before").alias(name)
    )


def running(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], value: str, name: str, how: str = "sum") -> DataFrame:
    """The running sum, or with ``how`` max the running maximum, of ``value`` up to each row, per ``keys`` in the order of (block, order)."""
    total = {"sum": F.sum, "max": F.max}[how]
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = df.withColumn("_own", total(value).over(inside))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    across = df.groupBy(*keys, block).agg(total(value).alias("_all")).select(*keys, block, total("_all").over(before).alias("_before"))
    both = F.coalesce(F.col("o._own") + F.col("a._before"), "o._own", "a._before") if how == "sum" else F.greatest("o._own", "a._before")
    return own.alias("o").join(across.alias("a"), [F.col(f"o.{k}").eqNullSafe(F.col(f"a.{k}")) for k in (*keys, block)], "left").select(*[F.col(f"o.{c}") for c in df.columns], both.alias(name))
