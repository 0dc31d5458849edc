"""Reported facts as they were known: point-in-time reads, priorities, and quarters joined up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators import pit, quarters

#: Days that three steps between four consecutive quarters span.
YEAR_OF_QUARTERS = (250, 300)


def facts_known(
    facts: DataFrame, as_of: Column, concepts: Sequence[str], symbols: Sequence[str] | None = None, forms: Sequence[str] = ("10-K", "10-Q"),
    keys: Sequence[str] = ("symbol", "concept"), period: str = "end_date", known: str = "filed_date", ties: Sequence[str] = (),
) -> DataFrame:
    """Per symbol and concept the latest period known on a day, in its latest restatement known by then.

    Empty ``concepts`` or ``symbols`` give no rows, ``symbols`` None means all,
    empty ``forms`` any. Facts without a known day are never known.
    """
    wanted = facts.where(F.col("concept").isin(list(concepts))) if concepts else facts.limit(0)
    if forms:
        wanted = wanted.where(F.col("form_type").isin(list(forms)))
    if symbols is not None:
        wanted = wanted.where(F.col("symbol").isin([s.upper() for s in symbols])) if symbols else wanted.limit(0)
    return pit.latest_known(wanted, keys, period, known, as_of, ties=ties)


def first_by_priority(facts: DataFrame, keys: Sequence[str], concept: str, priority: Sequence[str], before: Sequence[Column] = ()) -> DataFrame:
    """The row of the first concept of ``priority`` per key, after the order ``before`` (say, the latest period first)."""
    rank = F.array_position(F.array(*[F.lit(c) for c in priority]), F.col(concept))
    return pit.top_per_key(facts.where(F.col(concept).isin(list(priority))), keys, [*before, rank])


def revenue_known(facts: DataFrame, as_of: Column, priority: Sequence[str], symbols: Sequence[str] | None = None, forms: Sequence[str] = ("10-K", "10-Q")) -> DataFrame:
    """The latest known value of a measure that goes by several concepts, the first of ``priority`` where a period has several."""
    return first_by_priority(facts_known(facts, as_of, priority, symbols, forms), ["symbol"], "concept", priority, [F.desc("end_date")])


def trailing_years(quarterly: DataFrame, key: str, value: str, known: str = "known", quarter_end: str = "quarter_end") -> DataFrame:
    """Adds ``ttm`` (the sum of four consecutive quarters, else null) and ``ttm_known`` (the running maximum of ``known``)."""
    w = Window.partitionBy(key).orderBy(quarter_end)
    span = F.datediff(quarter_end, F.lag(quarter_end, 3).over(w)).between(*YEAR_OF_QUARTERS)
    four = w.rowsBetween(-3, 0)
    total = F.when(span & (F.count(value).over(four) == 4), F.sum(value).over(four))
    return quarterly.withColumn("ttm", total).withColumn("ttm_known", F.max(known).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def split_factor(df: DataFrame, key: str, day: str, splits: DataFrame, split_day: str, ratio: str, name: str = "split_factor") -> DataFrame:
    """Adds the product of the key's splits strictly after ``day`` (1 without any; null days get the product of all)."""
    later = splits.where(F.col(ratio) > 0).groupBy(key).agg(F.collect_list(F.struct(F.col(split_day).alias("d"), F.col(ratio).cast("double").alias("r"))).alias("_splits"))
    after = F.filter("_splits", lambda s: F.col(day).isNull() | (s["d"] > F.col(day)))
    # A company has a handful of splits, so its list is small.
    return df.join(later, key, "left").withColumn(name, F.coalesce(F.aggregate(after, F.lit(1.0), lambda a, s: a * s["r"]), F.lit(1.0))).drop("_splits")


def _series(facts: DataFrame, group: Sequence[str], flow: bool) -> DataFrame:
    """One value per symbol and period end out of several concepts: symbol, quarter_end, value, known."""
    own = facts.where(F.col("concept").isin(list(group)))
    if flow:
        single = quarters.quarterly(own.withColumn("_key", F.struct("symbol", "concept")), "_key", "start_date", "end_date", "value", "filed_date").select("_key.symbol", "_key.concept", "quarter_end", "value", "known")
    else:
        single = quarters.first_reported(own.select("symbol", "concept", F.col("end_date").alias("quarter_end"), "value", F.col("filed_date").alias("known")), ["symbol", "concept", "quarter_end"], "known")
    return first_by_priority(single, ["symbol", "quarter_end"], "concept", group).drop("concept")


def quarterly_fundamentals(facts: DataFrame, flows: Mapping[str, Sequence[str]], instants: Mapping[str, Sequence[str]], shares: Sequence[str], splits: DataFrame, lead: str, tolerance_days: int = 20) -> DataFrame:
    """A row per symbol and quarter of the flow ``lead``: trailing sums, balances, shares on today's split basis, and when all was known.

    ``flows`` and ``instants`` name the concepts of each measure in order of
    priority. Flows become single quarters (year-to-date facts are differenced)
    and sums of four consecutive ones; balances are the last within
    ``tolerance_days`` before the quarter's end; shares carry over at most two
    missing quarters. ``known`` is the latest first filing among the inputs, and
    never falls from one quarter to the next.
    """
    base = _series(facts, flows[lead], True).select("symbol", "quarter_end")
    knowns = []
    for name, group in flows.items():
        own = _series(facts, group, True).select("symbol", "quarter_end", F.col("value").alias(f"_{name}"), F.col("known").alias(f"_{name}_known"))
        base = base.join(own, ["symbol", "quarter_end"], "left")
        knowns.append(f"_{name}_known")
    held = _series(facts, shares, False).select("symbol", "quarter_end", F.col("value").alias("_shares"), F.col("known").alias("_shares_known"))
    base = base.join(held, ["symbol", "quarter_end"], "left")
    w = Window.partitionBy("symbol").orderBy("quarter_end")
    recent = w.rowsBetween(-2, 0)
    for column in ("_shares", "_shares_known"):
        base = base.withColumn(column, F.last(column, ignorenulls=True).over(recent))
    knowns.append("_shares_known")
    for name, group in instants.items():
        base = pit.as_of_join(base, _series(facts, group, False).withColumnRenamed("quarter_end", "_at"), ["symbol"], "quarter_end", "_at", ["value", "known"], tolerance_days=tolerance_days, prefix=f"_{name}_")
        base = base.withColumnRenamed(f"_{name}_value", name)
        knowns.append(f"_{name}_known")
    w = Window.partitionBy("symbol").orderBy("quarter_end")
    span = F.datediff("quarter_end", F.lag("quarter_end", 3).over(w)).between(*YEAR_OF_QUARTERS)
    four = w.rowsBetween(-3, 0)
    for name in flows:
        base = base.withColumn(f"{name}_ttm", F.when(span & (F.count(f"_{name}").over(four) == 4), F.sum(f"_{name}").over(four)))
    latest = F.greatest(*knowns) if len(knowns) > 1 else F.col(knowns[0])
    base = base.withColumn("known", F.max(latest).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    adjusted = split_factor(base, "symbol", "known", splits, "date", "stock_splits")
    return adjusted.select("symbol", "quarter_end", *[f"{n}_ttm" for n in flows], *instants, (F.col("_shares") * F.col("split_factor")).alias("shares"), "known")


def fiscal_quarters(filings: DataFrame, key: str, period: str, form: str) -> DataFrame:
    """Number of the quarter that each period end closes: key, close, quarter.

    An annual report closes the fourth; an interim one is numbered by its
    distance from the year end before, or else from the one after. Without any
    year end the number is null; a number outside 1 to 3 means a missing report
    and leaves the period out.
    """
    kind = F.split(F.col(form), "/")[0]
    closes = filings.where(kind.isin("10-K", "10-KT", "10-Q") & F.col(period).isNotNull()).groupBy(key, F.col(period).alias("close")).agg(F.bool_or(kind != "10-Q").alias("_year"))
    w = Window.partitionBy(key).orderBy("close")
    end = F.when(F.col("_year"), F.col("close"))
    before = F.last(end, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(end, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    steps = lambda a, b: F.round(F.datediff(a, b) / F.lit(91.3)).cast("int")
    number = F.when(F.col("_year"), 4).when(before.isNotNull(), steps("close", before)).when(after.isNotNull(), 4 - steps(after, "close"))
    return closes.withColumn("quarter", number).where("_year OR quarter IS NULL OR quarter BETWEEN 1 AND 3").select(key, "close", "quarter")
