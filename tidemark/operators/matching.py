"""Matching by name, by time window and one to one."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import GENERIC_NAMES, company_stem


def name_index(companies: DataFrame, key: str, name: str, least: int = 6, generic: Sequence[str] = GENERIC_NAMES) -> DataFrame:
    """Name stems that tell a company: stem, key; short and generic ones are left out, of several keys the greatest stays."""
    stem = company_stem(F.col(name)).alias("stem")
    named = companies.where(F.col(name).isNotNull()).select(stem, key)
    return named.where((F.length("stem") >= least) & ~F.col("stem").isin(list(generic))).groupBy("stem").agg(F.max(key).alias(key))


def earliest_mention(documents: DataFrame, doc: str, mentions: str, index: DataFrame, key: str, max_offset: int) -> DataFrame:
    """The company that each document names first: doc, key, offset.

    ``mentions`` is ``Name,offset;Name,offset``; those beyond ``max_offset``,
    without a number or unknown to ``index`` don't count. At equal offsets the
    earlier in the list wins. Documents without a match give no row.
    """
    entries = documents.select(doc, F.posexplode(F.split(mentions, ";")).alias("_nth", "_entry"))
    spots = entries.select(doc, "_nth", company_stem(F.regexp_extract("_entry", r"^(.*),[^,]*$", 1)).alias("stem"), F.trim(F.regexp_extract("_entry", r"^.*,([^,]*)$", 1)).try_cast("int").alias("offset"))
    found = spots.where((F.col("offset") <= max_offset) & (F.col("stem") != "")).join(index, "stem")
    first = found.groupBy(doc).agg(F.min_by(F.struct(key, "offset"), F.struct("offset", "_nth")).alias("_m"))
    return first.select(doc, f"_m.{key}", "_m.offset")


def nearest_within(left: DataFrame, right: DataFrame, keys: Sequence[str], left_day: str, right_day: str, days: int, values: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Left rows with the right row of the same keys whose day is nearest, at most ``days`` away; left rows without one are left out.

    Days are cut into blocks of ``days``; a left row looks into its own block and
    both beside it, so the join is on keys and block and a hot key is spread out.
    At equal distance the earlier day, then ``ties``.
    """
    block = lambda c: F.floor(F.unix_date(F.col(c).cast("date")) / days)
    l = left.where(F.col(left_day).isNotNull()).withColumn("_row", F.struct(*left.columns))  # noqa: E741
    l = l.select(*keys, "_row", F.col(left_day).cast("date").alias("_day"), F.explode(F.array(*[block(left_day) + d for d in (-1, 0, 1)])).alias("_block"))  # noqa: E741
    r = right.where(F.col(right_day).isNotNull()).select(*keys, F.col(right_day).cast("date").alias("_at"), block(right_day).alias("_block"), *[c for c in dict.fromkeys([*values, *ties]) if c not in keys])
    away = F.abs(F.datediff("_day", "_at"))
    near = l.join(r, [*keys, "_block"]).withColumn("_away", away).where(F.col("_away") <= days)
    best = near.groupBy("_row").agg(F.min(F.struct("_away", "_at", *ties, *[v for v in values if v not in ties])).alias("_best"))
    return best.select("_row.*", F.col("_best._at").alias("matched_day"), F.col("_best._away").alias("days_away"), *[F.col(f"_best.{v}").alias(v) for v in values])


def claim_latest(periods: DataFrame, events: DataFrame, key: str, close: str, filed: str, day: str, event_id: str, floor_days: int = 7, cap_days: int = 75, slack_days: int = 2) -> DataFrame:
    """One event for each period, each event for one period: key, close, day, event_id.

    Periods take turns by their close; each takes the latest event from
    ``floor_days`` after the close to ``cap_days`` after it (or ``slack_days``
    after ``filed``, if earlier) that no period has taken. Events of the same
    day are one, named by the least id. A key has a period a quarter and an
    event a day at most, so its group is bounded by the calendar.
    """
    p = periods.where(F.col(close).isNotNull()).groupBy(F.col(key).alias("key"), F.col(close).cast("date").alias("close")).agg(F.min(F.col(filed).cast("date")).alias("filed"))
    e = events.where(F.col(day).isNotNull()).groupBy(F.col(key).alias("key"), F.col(day).cast("date").alias("day")).agg(F.min(F.col(event_id)).alias("event"))
    kind, id_kind = periods.schema[key].dataType.simpleString(), events.schema[event_id].dataType.simpleString()

    def run(own: pa.Table, seen: pa.Table) -> pa.Table:
        by_day = dict(zip(seen.column("day").to_pylist(), seen.column("event").to_pylist(), strict=True))
        days = sorted(by_day)
        out = []
        for row in sorted(own.to_pylist(), key=lambda r: r["close"]):
            high = row["close"] + timedelta(cap_days)
            if row["filed"] is not None:
                high = min(high, row["filed"] + timedelta(slack_days))
            fit = [d for d in days if row["close"] + timedelta(floor_days) <= d <= high]
            if fit:
                days.remove(fit[-1])
                out.append({"key": row["key"], "close": row["close"], "day": fit[-1], "event": by_day[fit[-1]]})
        return pa.Table.from_pylist(out, pa.schema([own.schema.field("key"), ("close", pa.date32()), ("day", pa.date32()), seen.schema.field("event") if seen.num_rows else ("event", pa.null())])) if out else empty(own)

    def empty(own: pa.Table) -> pa.Table:
        return pa.table({"key": pa.array([], own.schema.field("key").type), "close": pa.array([], pa.date32()), "day": pa.array([], pa.date32()), "event": pa.array([], to_arrow)})

    to_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_kind]
    found = p.groupBy("key").cogroup(e.groupBy("key")).applyInArrow(run, f"key {kind}, close date, day date, event {id_kind}")
    return found.select(F.col("key").alias(key), F.col("close").alias("close"), F.col("day").alias("day"), F.col("event").alias(event_id))


def expected_releases(releases: DataFrame, calendar: DataFrame, today: str, horizon_days: int = 120, least_days: int = 7, most_days: int = 75) -> DataFrame:
    """Past releases and those to come: symbol, fiscal_close, release_date, source.

    ``releases`` has symbol, fiscal_close, release_date and report_filed (which
    stands in where the release is null), ``calendar`` symbol and date. The next
    close is the one four quarters back plus 364 days (91 days after the last,
    with fewer); its release the first calendar date 7 to 75 days after it and
    after the last release, else the median lag of the last eight. A symbol has
    a close a quarter, so its group is small.
    """
    past = releases.select(
        "symbol", F.col("fiscal_close").cast("date").alias("fiscal_close"), F.coalesce("release_date", "report_filed").cast("date").alias("release_date"), F.when(F.col("release_date").isNotNull(), "released").otherwise("filed").alias("source")
    ).where("release_date IS NOT NULL AND fiscal_close IS NOT NULL")
    end = pd.Timestamp(today) + pd.Timedelta(days=horizon_days)

    def run(own: pd.DataFrame, dates: pd.DataFrame) -> pd.DataFrame:
        if own.empty:
            return own
        own = own.assign(fiscal_close=pd.to_datetime(own["fiscal_close"]), release_date=pd.to_datetime(own["release_date"])).sort_values("fiscal_close", kind="stable")
        lag = (own["release_date"] - own["fiscal_close"]).dt.days.tail(8).median()
        closes, last = list(own["fiscal_close"]), own["release_date"].max()
        hits = sorted(pd.to_datetime(dates["date"]))
        new = []
        while True:
            close = closes[-4] + pd.Timedelta(days=364) if len(closes) >= 4 else closes[-1] + pd.Timedelta(days=91)
            if close <= closes[-1]:
                close = closes[-1] + pd.Timedelta(days=91)
            if close > end:
                break
            closes.append(close)
            fit = [d for d in hits if close + pd.Timedelta(days=least_days) <= d <= close + pd.Timedelta(days=most_days) and d > last]
            new.append((own["symbol"].iloc[0], close, fit[0] if fit else close + pd.Timedelta(days=round(float(lag))), "calendar" if fit else "estimated"))
        return pd.concat([own, pd.DataFrame(new, columns=list(own.columns))]) if new else own

    cal = calendar.where("date IS NOT NULL").select("symbol", F.col("date").cast("date").alias("date"))
    out = past.groupBy("symbol").cogroup(cal.groupBy("symbol")).applyInPandas(run, "symbol string, fiscal_close timestamp, release_date timestamp, source string")
    return out.select("symbol", F.to_date("fiscal_close").alias("fiscal_close"), F.to_date("release_date").alias("release_date"), "source")


def window_status(windows: DataFrame, key: str, shut: str, reopen: str, release: str, day: Column) -> DataFrame:
    """Per key on a day: whether a window is shut, when it reopens and by which release, the next shut and release."""
    now = (F.col(shut) <= day) & (F.col(reopen) > day)
    return windows.groupBy(key).agg(
        F.bool_or(F.coalesce(now, F.lit(False))).alias("shut"), F.max(F.when(now, F.col(reopen))).alias("reopens"), F.max_by(release, F.when(now, F.struct(reopen, release))).alias("window_release"),
        F.min(F.when(F.col(shut) > day, F.col(shut))).alias("next_shut"), F.min(F.when(F.col(release) >= day, F.col(release))).alias("next_release"),
    )


def shut_share(windows: DataFrame, key: str, shut: str, reopen: str) -> DataFrame:
    """Per day the keys with a window, those whose window is shut, and the share: day, covered, shut, share.

    A key counts from its first shut to its last reopening. Windows become days,
    counted where they overlap once.
    """
    good = windows.where(F.col(reopen) > F.col(shut))
    days = lambda a, b: F.explode(F.sequence(a, F.date_sub(b, 1))).alias("day")
    closed = good.select(key, days(F.col(shut), F.col(reopen))).distinct().groupBy("day").agg(F.count("*").alias("shut"))
    spans = good.groupBy(key).agg(F.min(shut).alias("_a"), F.max(reopen).alias("_b"))
    covered = spans.select(days(F.col("_a"), F.col("_b"))).groupBy("day").agg(F.count("*").alias("covered"))
    return covered.join(closed, "day", "left").select("day", "covered", F.coalesce("shut", F.lit(0)).alias("shut"), (F.coalesce("shut", F.lit(0)) / F.col("covered")).alias("share"))


def still_to_do(keys: DataFrame, ledger: DataFrame, key: str, status: str, attempts: str, most_attempts: int = 3) -> DataFrame:
    """Keys that a resumed run takes up: never tried, or failed fewer than ``most_attempts`` times and not since completed."""
    seen = ledger.groupBy(key).agg(F.bool_or(F.col(status).isin("completed", "skipped")).alias("_done"), F.max(attempts).alias("_tries"))
    return keys.select(key).distinct().join(seen, key, "left").where(f"_done IS NULL OR (NOT _done AND coalesce(_tries, 0) < {most_attempts})").select(key)
