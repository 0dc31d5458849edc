"""Quarterly values from year-to-date facts, and ladders of probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

QUARTER_DAYS = 91.3
SLACK_DAYS = 25


def first_reported(df: DataFrame, keys: list[str], known: str) -> DataFrame:
    """The value of each period as it was first reported."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last(known), *[c for c in df.columns if c not in keys and c != known]))
    return df.withColumn("_r", rank).where("_r = 1").drop("_r")


def quarterly(df: DataFrame, key: str, start: str, end: str, value: str, known: str) -> DataFrame:
    """Values of single quarters out of facts that run from a year's start: key, quarter_end, value, known.

    A fact of n quarters (days / 91.3, within 25 days) less the fact of n - 1
    quarters with the same start is the last quarter's value, known when both
    are. Where several give the same quarter, the earliest start wins.
    """
    n = F.round((F.datediff(end, start) + 1) / F.lit(QUARTER_DAYS)).cast("int")
    near = F.abs(F.datediff(end, start) + 1 - n * F.lit(QUARTER_DAYS)) <= SLACK_DAYS
    facts = first_reported(df.select(key, start, end, value, known).where(F.col(start).isNotNull() & F.col(end).isNotNull()), [key, start, end], known).withColumn("_n", n).where(near & F.col("_n").between(1, 4))
    w = Window.partitionBy(key, start).orderBy(end)
    step = facts.withColumn("_before", F.lag(F.struct("_n", value, known)).over(w))
    follows = F.col("_before._n") == F.col("_n") - 1
    single = step.where((F.col("_n") == 1) | follows).select(
        key, start, F.col(end).alias("quarter_end"),
        F.when(F.col("_n") == 1, F.col(value)).otherwise(F.col(value) - F.col(f"_before.{value}")).alias("value"),
        F.when(F.col("_n") == 1, F.col(known)).otherwise(F.greatest(F.col(known), F.col(f"_before.{known}"))).alias("known"),
    )
    pick = F.row_number().over(Window.partitionBy(key, "quarter_end").orderBy(start))
    return single.withColumn("_r", pick).where("_r = 1").drop("_r", start)


def monotone(df: DataFrame, event: str, strike: str, p: str) -> DataFrame:
    """Probabilities of being above each strike made to fall: the mean of the two tightest monotone hulls."""
    w = Window.partitionBy(event).orderBy(strike)
    low = F.min(p).over(w.rowsBetween(Window.unboundedPreceding, 0))
    high = F.max(p).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn("p_above", (low + high) / 2)


def ladder_median(df: DataFrame, event: str, strike: str, p: str) -> DataFrame:
    """Where the monotone ladder crosses one half, between two strikes linearly: event, median.

    Null where it starts below or never reaches one half; the first strike where
    it starts at one half.
    """
    w = Window.partitionBy(event).orderBy(strike)
    m = monotone(df.where(F.col(strike).isNotNull() & F.col(p).isNotNull()), event, strike, p).withColumn("_k", F.lag(strike).over(w)).withColumn("_p", F.lag("p_above").over(w))
    share = (F.col("_p") - 0.5) / (F.col("_p") - F.col("p_above"))
    crossing = (F.col("p_above") <= 0.5) & (F.col("_p") > 0.5)
    at = F.when(crossing, F.col("_k") + share * (F.col(strike) - F.col("_k"))).when(F.col("_p").isNull() & (F.col("p_above") == 0.5), F.col(strike))
    return m.withColumn("_at", at).groupBy(event).agg(F.min("_at").alias("median"))


# Kinds of strikes that say "above" and "below", and those that stand alone.
ABOVE, BELOW, TOUCH = ["greater", "greater_or_equal"], ["less", "less_or_equal"], ["touch_above", "touch_below"]


def event_views(df: DataFrame, event: str, kind: str, floor: str, p: str, outcome: str, exclusive: str) -> DataFrame:
    """What the outcomes of each event say: event, view, median, below_range, above_range, top, top_prob, normalised.

    Views: ``empty`` (no probability at all), ``binary`` (one market), ``ladder``
    (strikes above a value, or buckets whose probabilities are made to sum to
    one; median where the ladder crosses one half), ``touch`` (strikes that stand
    alone), ``multi`` (outcomes that don't exclude each other), ``outcomes`` (the
    likeliest, probabilities normalised where they sum to less than 0.95 or more
    than 1.05). Sums are rounded to nine places, so that the order of adding
    decides nothing. Of equally likely outcomes the least name is the top.
    """
    rows = df.where(F.col(p).isNotNull()).select(event, F.col(kind).alias("_kind"), F.col(floor).cast("double").alias("_floor"), F.col(p).cast("double").alias("_p0"), F.col(outcome).alias("_outcome"), exclusive)
    names = lambda values: F.array(*[F.lit(v) for v in values])
    within = lambda values: (F.size("_kinds") > 0) & (F.size(F.array_except("_kinds", names(values))) == 0)
    facts = rows.groupBy(event).agg(F.count("*").alias("_n"), F.collect_set("_kind").alias("_kinds"), F.bool_and(F.col("_floor").isNotNull()).alias("_floors"), F.bool_or(F.coalesce(exclusive, F.lit(False))).alias("_exclusive"), F.sum("_p0").alias("_total"), F.max("_p0").alias("_single"))
    form = (
        F.when(F.col("_n") == 1, "binary")
        .when(within(ABOVE) & F.col("_floors"), "above")
        .when(within(TOUCH), "touch")
        .when(F.array_contains("_kinds", "between") | (within([*ABOVE, *BELOW]) & (F.size("_kinds") > 1)), "buckets")
        .when(~F.col("_exclusive"), "multi")
        .otherwise("outcomes")
    )
    formed = facts.withColumn("_form", form)
    joined = rows.join(formed.select(event, "_form", "_total"), event)
    above = joined.where("_form = 'above' AND _floor IS NOT NULL").groupBy(event, "_floor").agg(F.max("_p0").alias("_above"))
    mass = joined.where("_form = 'buckets' AND _total > 0").groupBy(event, "_floor").agg(F.try_divide(F.sum("_p0"), F.max("_total")).alias("_mass")).where("_floor IS NOT NULL")
    from_here = Window.partitionBy(event).orderBy("_floor").rowsBetween(0, Window.unboundedFollowing)
    ladder = above.unionByName(mass.select(event, "_floor", F.round(F.sum("_mass").over(from_here), 9).alias("_above")))
    curve = monotone(ladder, event, "_floor", "_above")
    ends = curve.groupBy(event).agg(F.min_by("p_above", "_floor").alias("_low"), F.max_by("p_above", "_floor").alias("_high"))
    medians = ladder_median(ladder, event, "_floor", "_above").join(ends, event)
    named = joined.where("_form = 'outcomes'").groupBy(event, "_outcome").agg(F.round(F.sum("_p0"), 9).alias("_p1"))
    tops = named.groupBy(event).agg(F.max("_p1").alias("_p1"), F.min_by("_outcome", F.struct(-F.col("_p1"), "_outcome")).alias("_top"))
    every = df.select(event).distinct().join(formed, event, "left").join(medians, event, "left").join(tops, event, "left")
    off = (F.col("_total") > 1.05) | (F.col("_total") < 0.95)
    form = F.col("_form")
    return every.select(
        event,
        F.when(form.isNull(), "empty").when(form.isin("above", "buckets"), "ladder").otherwise(form).alias("view"),
        F.when((F.col("_low") >= 0.5) & (F.col("_high") <= 0.5), F.col("median")).alias("median"),
        F.coalesce(F.col("_low") < 0.5, F.lit(False)).alias("below_range"),
        F.coalesce((F.col("_low") >= 0.5) & (F.col("_high") > 0.5), F.lit(False)).alias("above_range"),
        F.when(form == "binary", "Yes").otherwise(F.col("_top")).alias("top"),
        F.when(form == "binary", F.col("_single")).when(form == "outcomes", F.try_divide(F.col("_p1"), F.when(off, F.col("_total")).otherwise(1.0))).alias("top_prob"),
        ((form == "outcomes") & off).alias("normalised"),
    )
