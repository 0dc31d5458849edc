"""Trailing totals per entity over calendar days, from prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

AMOUNT = "decimal(28,12)"


def trailing_totals(
    df: DataFrame,
    entity: Column,
    day: str,
    amount: str,
    version: str,
    windows: Sequence[int] = (7, 30),
) -> DataFrame:
    """Totals and averages of ``amount`` over the last k calendar days of each entity.

    One row per entity and calendar day from its first to its last row, with
    ``total_k`` and ``average_k`` for each k. The prefix sum of an entity is
    taken over its rows, spread forward over the days up to the next row, and a
    trailing total is the prefix at the day less the prefix k days before.

    Sums are exact decimals (12 places), so a window without activity is
    exactly zero. Rows are first reduced to one per entity and day, with the
    partial step before the shuffle: a hot entity then holds no more rows than
    its span has days, however often its days are delivered.

    Cases: the row with the latest ``version`` holds (a null version is the
    oldest); at equal versions the larger amount. Null, NaN or infinite amounts
    count as zero. Rows without entity or day belong to no window and are left
    out. Days before the first row count as zero. Other columns are not read,
    so their names cannot clash. An empty table gives an empty result.
    """
    rows = df.select(
        entity.alias("entity"),
        F.col(day).alias("day"),
        F.struct(F.col(version).alias("version"), F.expr(f"try_cast(`{amount}` AS {AMOUNT})").alias("amount")).alias("held"),
    ).where("entity IS NOT NULL AND day IS NOT NULL")
    held = rows.groupBy("entity", "day").agg(F.max("held").alias("held"))
    by_row = Window.partitionBy("entity").orderBy("day")
    zero = F.lit(0).cast(AMOUNT)
    steps = held.select(
        "entity",
        "day",
        F.sum(F.coalesce("held.amount", zero)).over(by_row.rowsBetween(Window.unboundedPreceding, 0)).alias("prefix"),
        F.lead("day").over(by_row).alias("next_day"),
    )
    dense = steps.select(
        "entity",
        F.explode(F.sequence("day", F.coalesce(F.date_sub("next_day", 1), "day"))).alias("day"),
        "prefix",
    )
    by_day = Window.partitionBy("entity").orderBy("day")
    out = dense.select(
        "entity",
        "day",
        *[(F.col("prefix") - F.coalesce(F.lag("prefix", k).over(by_day), zero)).alias(f"total_{k}") for k in windows],
    )
    return out.select("*", *[(F.col(f"total_{k}").cast("double") / F.lit(float(k))).alias(f"average_{k}") for k in windows])
