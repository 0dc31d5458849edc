"""Option contracts: is a quote worth a model, what does it imply, and how puts and calls trade."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.options import with_iv_and_greeks
from tidemark.functions.text import finite

# The quality flags in the order of their label, and those that rule a quote out.
FLAGS = ["zero_bid", "crossed_market", "wide_spread", "below_intrinsic", "no_time_value", "expired", "deep_itm", "no_solution", "bad_input", "unidentifiable", "implausible_iv"]
RULED_OUT = ["zero_bid", "crossed_market", "wide_spread", "below_intrinsic", "no_time_value", "expired", "bad_input", "implausible_iv"]
# The widest spread as a share of the middle, the least vega, the tick, the greatest believable volatility, deep moneyness, the least time value.
MOST_SPREAD, LEAST_VEGA, TICK, MOST_VOL, DEEP, LEAST_TIME_VALUE = 0.50, 1e-3, 0.01, 3.0, 0.35, 1e-4
# The tenor (days) and log-moneyness (spot to strike) from which the surface is summed up.
TENOR, AT_THE_MONEY, WING = (20, 45), 0.03, (0.05, 0.12)


def years_to_expiry(days: Column) -> Column:
    """Half a day at least, in years of 365 days."""
    return F.greatest(days.cast("double"), F.lit(0.5)) / F.lit(365.0)


def _flagged(conditions: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(conditions[f], F.lit(f)) for f in FLAGS if f in conditions]))


def assess_quotes(df: DataFrame, spot: str, strike: str, years: str, bid: str, ask: str, last: str, is_call: str) -> DataFrame:
    """Adds mid_price, intrinsic_value, time_value, moneyness, log_moneyness and flags (array of names).

    The middle of bid and ask; without a bid half the ask, else the last trade,
    flagged as zero_bid. Without spot, strike or any price the contract is
    bad_input, at or past its end it is expired; then there is no price. NaN,
    infinite and null inputs count as missing.
    """
    s, k, t = finite(F.col(spot)), finite(F.col(strike)), F.col(years)
    b, a, trade = (F.when(finite(F.col(c)) > 0, F.col(c)) for c in (bid, ask, last))
    sound = F.coalesce((s > 0) & (k > 0), F.lit(False))
    alive = sound & F.coalesce(t > 0, F.lit(False))
    price = F.when(alive, F.coalesce((b + a) / 2, a / 2, trade))
    gain = F.greatest(F.lit(0.0), F.when(F.col(is_call), s - k).otherwise(k - s))
    priced = df.withColumn("mid_price", price).withColumn("intrinsic_value", F.when(F.col("mid_price").isNotNull(), gain))
    p, i = F.col("mid_price"), F.col("intrinsic_value")
    two_sided = b.isNotNull() & a.isNotNull()
    has = p.isNotNull()
    flags = _flagged(
        {
            "zero_bid": alive & ~two_sided & (a.isNotNull() | trade.isNotNull()),
            "crossed_market": has & two_sided & (b >= a),
            "wide_spread": has & two_sided & ((a - b) / p > MOST_SPREAD),
            "below_intrinsic": has & (p < i - 1e-9),
            "no_time_value": has & (p >= i - 1e-9) & (p - i < LEAST_TIME_VALUE),
            "expired": sound & ~alive,
            "deep_itm": has & (F.abs(F.log(k / s)) > DEEP),
            "bad_input": ~sound | (alive & ~has),
        }
    )
    ratio = F.when(sound, s / k)
    return priced.withColumn("time_value", p - i).withColumn("moneyness", ratio).withColumn("log_moneyness", F.log(ratio)).withColumn("flags", flags)


def usable(flags: Column) -> Column:
    """Whether no flag rules the quote out (deep, unsolved and unidentifiable ones don't by themselves)."""
    return ~F.arrays_overlap(flags, F.array(*[F.lit(f) for f in RULED_OUT]))


def label(flags: Column) -> Column:
    return F.when(F.size(flags) == 0, "ok").otherwise(F.concat_ws("|", flags))


def analyse_contracts(df: DataFrame, spot: str, strike: str, years: str, rate: str, dividend_yield: str, bid: str, ask: str, last: str, is_call: str) -> DataFrame:
    """Flags, implied volatility and sensitivities of each contract.

    Only usable quotes are solved. A price that no volatility gives is
    no_solution; with a vega below LEAST_VEGA the sensitivities stay and the
    volatility goes (unidentifiable); one above MOST_VOL stays, flagged as
    implausible. Adds quality_flags (names joined by |, or ok), iv_usable and
    iv_uncertainty, in volatility points for a tick.
    """
    assessed = assess_quotes(df, spot, strike, years, bid, ask, last, is_call).withColumn("_value", F.when(usable(F.col("flags")), F.col("mid_price")))
    solved = with_iv_and_greeks(assessed, spot, strike, years, rate, dividend_yield, "_value", is_call)
    tried, found = F.col("_value").isNotNull(), F.col("iv").isNotNull()
    faint = found & (F.col("vega") < LEAST_VEGA)
    later = {"no_solution": tried & ~found, "unidentifiable": faint, "implausible_iv": found & ~faint & (F.col("iv") > MOST_VOL)}
    every = F.concat("flags", _flagged(later))
    in_order = F.filter(F.array(*[F.lit(f) for f in FLAGS]), lambda f: F.array_contains(every, f))
    out = solved.withColumn("flags", in_order).withColumn("iv_uncertainty", F.when(found & ~faint, TICK / F.col("vega") / 100)).withColumn("iv", F.when(~faint, F.col("iv")))
    return out.withColumn("quality_flags", label(F.col("flags"))).withColumn("iv_usable", F.col("iv").isNotNull() & usable(F.col("flags"))).drop("_value", "flags")


def with_curve_rate(df: DataFrame, years: str, curve: DataFrame, maturity: str, rate: str, fallback: float, name: str = "rate") -> DataFrame:
    """Adds the curve's rate at ``years``: linear between its points, flat beyond them, ``fallback`` without any.

    A curve has a point per maturity, a handful; it becomes one array in one row.
    """
    points = curve.where(F.col(maturity).isNotNull() & F.col(rate).isNotNull()).groupBy(F.col(maturity).cast("double").alias("m")).agg(F.max(F.col(rate).cast("double")).alias("r"))
    line = points.agg(F.sort_array(F.collect_list(F.struct("m", "r"))).alias("_line"))
    at = F.col(years)
    below, above = F.filter("_line", lambda p: p["m"] <= at), F.filter("_line", lambda p: p["m"] >= at)
    low, high = F.try_element_at(below, F.lit(-1)), F.try_element_at(above, F.lit(1))
    between = F.when(high["m"] == low["m"], low["r"]).otherwise(low["r"] + (at - low["m"]) / (high["m"] - low["m"]) * (high["r"] - low["r"]))
    return df.crossJoin(line).withColumn(name, F.coalesce(between, low["r"], high["r"], F.lit(fallback))).drop("_line")  # one row


def trailing_yields(bars: DataFrame, key: str, day: str, dividend: str, close: str, as_of: Column, days: int = 370, most: float = 0.25) -> DataFrame:
    """Dividends of the last ``days`` over the last close, at most ``most``: key, dividend_yield (only where positive)."""
    recent = bars.where(F.col(day).between(F.date_sub(as_of, days), as_of))
    found = recent.groupBy(key).agg(F.sum(F.coalesce(dividend, F.lit(0.0))).alias("_paid"), F.max_by(close, F.when(F.col(close).isNotNull(), F.col(day))).alias("_close"))
    return found.where("_paid > 0 AND _close > 0").select(key, F.least(F.col("_paid") / F.col("_close"), F.lit(most)).alias("dividend_yield"))


def put_call_flow(chains: DataFrame, keys: Sequence[str], option_type: str, volume: str, open_interest: str, expiration: str, spot: str, order: Sequence[str]) -> DataFrame:
    """Volume and open interest of puts and calls per key, ratios (null without calls), contracts, expirations, first spot."""
    side = lambda c, kind: F.sum(F.when(F.col(option_type) == kind, F.coalesce(c, F.lit(0))).otherwise(0)).cast("bigint")
    sums = {f"{kind}_{name}": side(c, kind) for name, c in (("volume", volume), ("open_interest", open_interest)) for kind in ("call", "put")}
    out = chains.groupBy(*keys).agg(
        *[v.alias(n) for n, v in sums.items()], F.count("*").cast("int").alias("contracts"), F.countDistinct(expiration).cast("int").alias("expirations"), F.min_by(spot, F.struct(*order)).alias("underlying_price")
    )
    ratio = lambda name: F.when(F.col(f"call_{name}") != 0, F.col(f"put_{name}") / F.col(f"call_{name}"))
    return out.withColumn("put_call_volume_ratio", ratio("volume")).withColumn("put_call_oi_ratio", ratio("open_interest"))


def surface_summary(analysed: DataFrame, keys: Sequence[str], option_type: str, days: str, iv: str = "iv", usable: str = "iv_usable", log_moneyness: str = "log_moneyness") -> DataFrame:
    """Per key the median volatility at the money and the skew between the wings, of usable contracts of a month or so.

    Both are chosen by log-moneyness, which doesn't depend on the volatility
    itself; medians, so that one quote doesn't decide.
    """
    m, v = F.col(log_moneyness), F.col(iv)
    fit = analysed.where(F.col(usable) & v.isNotNull() & F.col(days).between(*TENOR))
    put = F.median(F.when((F.col(option_type) == "put") & m.between(*WING), v))
    call = F.median(F.when((F.col(option_type) == "call") & m.between(-WING[1], -WING[0]), v))
    return fit.groupBy(*keys).agg(F.median(F.when(F.abs(m) < AT_THE_MONEY, v)).alias("atm_iv_30d"), (put - call).alias("skew_25d"))


def options_report(chains: DataFrame, keys: Sequence[str], curve: DataFrame, yields: DataFrame, fallback_rate: float = 0.04) -> tuple[DataFrame, DataFrame]:
    """The whole job over a snapshot of chains: (contracts analysed, flow with surface per key).

    ``chains`` has the keys (the first is the symbol), expiration, option_type, strike, dte,
    underlying_price, bid, ask, last_price, volume, open_interest; ``curve`` maturity and rate,
    ``yields`` the symbol and dividend_yield.
    """
    with_rate = with_curve_rate(chains.withColumn("years", years_to_expiry(F.coalesce("dte", F.lit(0)))), "years", curve, "maturity", "rate", fallback_rate, "risk_free_rate")
    ready = with_rate.join(yields.select(keys[0], "dividend_yield"), keys[0], "left").fillna(0.0, ["dividend_yield"]).withColumn("is_call", F.lower("option_type") == "call")
    analysed = analyse_contracts(ready, "underlying_price", "strike", "years", "risk_free_rate", "dividend_yield", "bid", "ask", "last_price", "is_call")
    flow = put_call_flow(chains, keys, "option_type", "volume", "open_interest", "expiration", "underlying_price", ["expiration", "option_type", "strike"])
    return analysed, flow.join(surface_summary(analysed, keys, "option_type", "dte"), list(keys), "left")


def options_between(
    chains: DataFrame, first: Column, last: Column, symbols: Sequence[str] | None = None, least_days: int | None = None, most_days: int | None = None, option_type: str | None = None,
    snapshot: str = "snapshot_date", days: str = "dte",
) -> DataFrame:
    """Contracts of the snapshots in [first, last]; filters that are None don't apply, an empty list of symbols gives no rows."""
    found = chains.where(F.col(snapshot).between(first, last))
    if symbols is not None:
        found = found.where(F.col("symbol").isin([s.upper() for s in symbols])) if symbols else found.limit(0)
    if least_days is not None:
        found = found.where(F.col(days) >= least_days)
    if most_days is not None:
        found = found.where(F.col(days) <= most_days)
    return found if option_type is None else found.where(F.col("option_type") == option_type.lower())
