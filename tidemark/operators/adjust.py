"""Retroactive factors: dividend adjustment, its correction, drift and repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _later_factors(df: DataFrame, key: str, order: str) -> DataFrame:
    """``later``: log of the product of the dividend factors strictly after each row."""
    w = Window.partitionBy(key).orderBy(order)
    prior = F.lag("close").over(w)
    counts = (F.coalesce("dividends", F.lit(0.0)) > 0) & (F.col("prior") > 0) & (F.col("dividends") < F.col("prior"))
    logs = df.withColumn("prior", prior).withColumn("log_factor", F.when(counts, F.log(1 - F.col("dividends") / F.col("prior"))).otherwise(0.0))
    return logs.withColumn("later", F.coalesce(F.sum("log_factor").over(w.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0))).drop("prior", "log_factor")


def adjusted(df: DataFrame, key: str, order: str, as_of: Column | None = None, end: Column | None = None) -> DataFrame:
    """``adj_factor`` and ``adj_close`` from dividends known by ``as_of``.

    Rows after ``as_of`` are dropped before the factors are built, rows after
    ``end`` only afterwards: a factor needs the dividends behind its own row.
    """
    seen = df if as_of is None else df.where(F.col(order) <= as_of)
    out = _later_factors(seen, key, order).withColumn("adj_factor", F.exp("later")).withColumn("adj_close", F.col("close") * F.col("adj_factor")).drop("later")
    return out if end is None else out.where(F.col(order) <= end)


def corrected(df: DataFrame, key: str, order: str) -> DataFrame:
    """The adjustment each row should have: the lowest that a later stored one implies.

    Rows without a positive close and stored value are dropped first.
    """
    good = df.where("close > 0 AND adj_close > 0")
    w = Window.partitionBy(key).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    logs = _later_factors(good, key, order).withColumn("stored_log", F.log(F.col("adj_close") / F.col("close")))
    ratio = F.exp(F.col("later") + F.min(F.col("stored_log") - F.col("later")).over(w))
    return logs.select(key, order, "close", F.col("adj_close").alias("stored"), ratio.alias("ratio")).withColumn("adj_close", F.col("close") * F.col("ratio"))


def drift(target: DataFrame, key: str, tolerance: float) -> DataFrame:
    """Per key the rows whose stored value is off by more than ``tolerance`` of itself."""
    off = F.abs(F.col("adj_close") - F.col("stored")) / F.col("stored")
    return target.groupBy(key).agg(F.count_if(off > tolerance).alias("stale_rows"), F.max(off).alias("worst")).where("stale_rows > 0")


def repair(df: DataFrame, target: DataFrame, keys: Sequence[str], column: str, tolerance: float) -> DataFrame:
    """``column`` replaced by the target's where off by ``tolerance`` of the target or more."""
    t = target.select(*keys, F.col(column).alias("_target"))
    off = F.coalesce(F.abs(F.col("_target") - F.col(column)) / F.col("_target") >= tolerance, F.lit(False))
    return df.join(t, list(keys), "left").withColumn("was_repaired", off).withColumn(column, F.when(F.col("was_repaired"), F.col("_target")).otherwise(F.col(column))).drop("_target")
