"""Grouped and windowed statistics in built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import fits_one_task


def unsigned(c: Column, digits: int) -> Column:
    """Rounded, with -0.0 as 0.0."""
    return F.round(c, digits) + F.lit(0.0)


def rolling_slope(y: Column, x: Column, frame, least: int) -> Column:
    """Slope of y on x over a frame, from explicit sums; null below ``least`` pairs or without spread."""
    both = x.isNotNull() & y.isNotNull()
    n = F.count(F.when(both, 1)).over(frame)
    sx, sy = F.sum(F.when(both, x)).over(frame), F.sum(F.when(both, y)).over(frame)
    sxy, sxx = F.sum(F.when(both, x * y)).over(frame), F.sum(F.when(both, x * x)).over(frame)
    spread = sxx - sx * sx / n
    return F.when((n >= least) & (spread != 0), (sxy - sx * sy / n) / spread)


def relative_trend(y: Column, x: Column, frame, least: int) -> Column:
    """The rolling slope over the frame's mean absolute value; null where the latest value is missing or the level is zero."""
    level = F.avg(F.abs(y)).over(frame)
    return F.when(y.isNotNull() & (level > 0), rolling_slope(y, x, frame, least) / level)


def _in_slices(df: DataFrame, groups: Sequence[str], values: Sequence[str], slices: int) -> DataFrame:
    """Rows with ``_slice_<value>`` for each value: equal parts of the group's values in order.

    Their edges come from quantile sketches of bounded size; only how even the
    slices are depends on them, not any result.
    """
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    edges = df.groupBy(*groups).agg(*[F.percentile_approx(v, shares, 4 * slices).alias(f"_edges_{v}") for v in values])
    placed = df.join(edges, list(groups))
    return placed.select(*df.columns, *[F.size(F.filter(f"_edges_{v}", lambda e: e < F.col(v))).alias(f"_slice_{v}") for v in values])  # noqa: B023


def _slice_sizes(placed: DataFrame, groups: Sequence[str], piece: str) -> DataFrame:
    """Per slice its rows, those before it, and all of the group: ``_rows``, ``_before``, ``_n``."""
    sizes = placed.groupBy(*groups, piece).agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy(*groups).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sizes.select(*groups, piece, "_rows", before.alias("_before"), F.sum("_rows").over(Window.partitionBy(*groups)).alias("_n"))


def with_average_ranks(df: DataFrame, groups: Sequence[str], values: dict[str, str], slices: int = 32, sliced: bool | None = None) -> DataFrame:
    """Adds ranks from 1 per group under new names (``values``: column to name); equal values share the mean of their ranks.

    Rows without one of the values are left out. Where a group could be more
    than a task should order (``sliced``), ranks are taken within slices of the
    values and moved up by the rows before the slice.
    """
    known = df.where(" AND ".join(f"`{v}` IS NOT NULL" for v in values))
    sliced = not fits_one_task(known) if sliced is None else sliced
    out = _in_slices(known, groups, list(values), slices) if sliced else known
    placed = out
    for value, name in values.items():
        piece = [f"_slice_{value}"] if sliced else []
        w = Window.partitionBy(*groups, *piece).orderBy(value)
        same = w.rangeBetween(Window.currentRow, Window.currentRow)
        out = out.withColumn(name, F.rank().over(w) + (F.count("*").over(same) - 1) / F.lit(2.0))
        if sliced:
            sizes = _slice_sizes(placed, groups, piece[0]).select(*groups, *piece, "_before")
            out = out.join(sizes, [*groups, *piece]).withColumn(name, F.col(name) + F.col("_before")).drop("_before")
    return out.select(*df.columns, *values.values())


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, shares: Sequence[float], slices: int = 32, sliced: bool | None = None) -> DataFrame:
    """Exact quantiles per group, between two values linearly: groups, ``q`` (array in the order of ``shares``), ``n`` values.

    Where a group could be more than a task should hold (``sliced``), counts of
    slices tell in which ones the wanted places lie; only those are sorted.
    Groups without a value give no row.
    """
    known = df.where(F.col(value).isNotNull()).select(*groups, value)
    if not (not fits_one_task(known) if sliced is None else sliced):
        return known.groupBy(*groups).agg(F.percentile(value, F.array(*[F.lit(float(s)) for s in shares])).alias("q"), F.count(value).alias("n"))
    placed, piece = _in_slices(known, groups, [value], slices), f"_slice_{value}"
    at = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(s)) * (F.col("_n") - 1)).alias("at")) for i, s in enumerate(shares)])
    places = _slice_sizes(placed, groups, piece).withColumn("_q", F.explode(at))
    low = F.floor("_q.at")
    wanted = places.select("*", F.explode(F.array_distinct(F.array(low, F.ceil("_q.at")))).alias("_place")).where((F.col("_place") >= F.col("_before")) & (F.col("_place") < F.col("_before") + F.col("_rows")))
    weight = F.when(F.col("_place") == low, 1 - (F.col("_q.at") - low)).otherwise(F.col("_q.at") - low)
    wanted = wanted.select(*groups, piece, "_n", F.col("_q.i").alias("_i"), (F.col("_place") - F.col("_before") + 1).alias("_nth"), weight.alias("_weight"))
    held = placed.join(wanted.select(*groups, piece).distinct(), [*groups, piece], "left_semi").withColumn("_nth", F.row_number().over(Window.partitionBy(*groups, piece).orderBy(value)))
    found = held.select(*groups, piece, "_nth", F.col(value).cast("double").alias("_value")).join(wanted, [*groups, piece, "_nth"])
    each = found.groupBy(*groups, "_i").agg(F.sum(F.col("_value") * F.col("_weight")).alias("_quantile"), F.max("_n").alias("_n"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("_i", "_quantile"))), lambda s: s["_quantile"])
    return each.groupBy(*groups).agg(in_order.alias("q"), F.max("_n").alias("n"))


def rank_correlation(df: DataFrame, groups: Sequence[str], a: str, b: str, least: int = 2, sliced: bool | None = None) -> DataFrame:
    """Correlation of average ranks of a and b per group (rows with both), null below ``least`` rows."""
    ranked = with_average_ranks(df.select(*groups, F.col(a).alias("_va"), F.col(b).alias("_vb")), groups, {"_va": "_a", "_vb": "_b"}, sliced=sliced)
    return ranked.groupBy(*groups).agg(F.count("*").alias("n"), F.corr("_a", "_b").alias("ic")).withColumn("ic", F.when(F.col("n") >= least, F.col("ic")))


def clipped_zscore(df: DataFrame, group: str, value: str, weight: str, clip: float = 0.025, least: int = 3) -> DataFrame:
    """z-scores per group: clipped at two quantiles, centred by weight, scaled by the sample deviation.

    Quantiles, centre and deviation are aggregates, a row per group, that are joined back.
    """
    bounds = exact_quantiles(df, [group], value, [clip, 1 - clip]).withColumnsRenamed({"q": "_q", "n": "_n"})
    joined = df.join(bounds, group, "left").withColumn("_c", F.when(F.col(value).isNotNull(), F.greatest(F.least(F.col(value), F.col("_q")[1]), F.col("_q")[0])))
    known = F.when(F.col("_c").isNotNull(), F.col(weight))
    level = joined.groupBy(group).agg((F.sum(F.col("_c") * F.col(weight)) / F.sum(known)).alias("_centre"), F.stddev_samp("_c").alias("_spread"))
    scored = joined.join(level, group, "left")
    return scored.withColumn("zscore", F.when((F.col("_n") >= least) & (F.col("_spread") > 0), (F.col("_c") - F.col("_centre")) / F.col("_spread"))).drop("_q", "_n", "_c", "_centre", "_spread")


def quantile_spread(df: DataFrame, groups: Sequence[str], by: str, value: str, low: float, high: float) -> DataFrame:
    """Per group the rows at or below the low and at or above the high quantile of ``by``, and the spread of their mean ``value``: low_n, high_n, spread."""
    bounds = exact_quantiles(df, groups, by, [low, high])
    below, above = F.col(by) <= F.col("q")[0], F.col(by) >= F.col("q")[1]
    return df.join(bounds, list(groups)).groupBy(*groups).agg(F.count_if(below).alias("low_n"), F.count_if(above).alias("high_n"), (F.avg(F.when(above, F.col(value))) - F.avg(F.when(below, F.col(value)))).alias("spread"))


def mean_of_means(df: DataFrame, outer: Sequence[str], cluster: str, value: str, least: int = 12) -> DataFrame:
    """Mean of cluster means and its t value per group, null below ``least`` clusters."""
    means = df.groupBy(*outer, cluster).agg(F.avg(value).alias("_m"))
    out = means.groupBy(*outer).agg(F.count("_m").alias("clusters"), F.avg("_m").alias("mean"), F.stddev_samp("_m").alias("_s"))
    ok = F.col("clusters") >= least
    return out.select(*outer, "clusters", F.when(ok, F.col("mean")).alias("mean"), F.when(ok & (F.col("_s") > 0), F.col("mean") / F.col("_s") * F.sqrt("clusters")).alias("t"))


def trailing_filler(df: DataFrame, key: str, order: str, is_filler: Column) -> DataFrame:
    """Without the filler rows at the end of each key; filler in between stays."""
    last_real = F.max(F.when(~is_filler, F.col(order))).over(Window.partitionBy(key))
    return df.withColumn("_last", last_real).where(F.col(order) <= F.col("_last")).drop("_last")


def rotating_slice(df: DataFrame, order: str, offset: int, size: int) -> DataFrame:
    """``size`` rows of a small sorted list, beginning at ``offset`` and wrapping round."""
    ranked = df.withColumn("_at", F.row_number().over(Window.orderBy(order)) - 1).withColumn("_n", F.count("*").over(Window.partitionBy()))
    return ranked.where(F.pmod(F.col("_at") - F.lit(offset), F.col("_n")) < size).drop("_at", "_n")


def threshold_report(minutes: DataFrame, key: str, day: str, amount: str, bars_a_day: int) -> DataFrame:
    """Per key the threshold that gives so many bars on an average day, and what it costs.

    Columns: threshold, daily (mean total), median_minute, max_minute,
    typical_overshoot and open_overshoot (per cent of a bar, half of a minute's
    amount on average) and exceeds (a minute alone fills a bar).
    """
    daily = minutes.groupBy(key, day).agg(F.sum(amount).alias("_t")).groupBy(key).agg(F.avg("_t").alias("daily"))
    single = minutes.groupBy(key).agg(F.median(amount).alias("median_minute"), F.max(amount).alias("max_minute"))
    joined = daily.join(single, key).withColumn("threshold", F.col("daily") / max(bars_a_day, 1))
    over = lambda c: 100 * F.col(c) / (2 * F.col("threshold"))
    return joined.withColumn("typical_overshoot", over("median_minute")).withColumn("open_overshoot", over("max_minute")).withColumn("exceeds", F.col("max_minute") >= F.col("threshold"))


def last_complete_day(df: DataFrame, day: str, value: str, days: int = 30, share: float = 0.9) -> DataFrame:
    """The latest of the last ``days`` days on which at least ``share`` of the greatest number of values is there: session."""
    counts = df.groupBy(day).agg(F.count(value).alias("_n")).orderBy(F.desc(day)).limit(days)
    most = counts.agg(F.max("_n").alias("_most"))
    return counts.crossJoin(most).agg(F.max(F.when(F.col("_n") >= share * F.col("_most"), F.col(day))).alias("session"))  # one row


def against_last(df: DataFrame, key: str, order: str, value: str, n: int) -> DataFrame:
    """Rows with ``usual``, the median of the ``n`` values before, where there are any."""
    before = F.collect_list(value).over(Window.partitionBy(key).orderBy(order).rowsBetween(-n, -1))
    held = df.withColumn("_held", F.sort_array(before)).where(F.size("_held") > 0)
    size = F.size("_held")
    middle = (F.get("_held", F.floor((size - 1) / 2).cast("int")) + F.get("_held", F.floor(size / 2).cast("int"))) / 2
    return held.withColumn("usual", middle).drop("_held")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows chosen by a hash of their key and a seed: random to look at, the same on every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)
