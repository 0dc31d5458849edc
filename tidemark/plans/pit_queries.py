"""Point-in-time queries: membership, known facts, as-of and interval joins, adjustments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions.symbols import canonical
from tidemark.operators import adjust, pit
from tidemark.plans.registry import BARS_SQL, MEMBERS_SQL, SYMBOL_SQL, Catalogue
from tidemark.session import table

C = Catalogue()
AS_OF = "2020-06-30"


def day(text: str):
    return F.lit(text).cast("date")


def bars(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Bars as they hold; only ``columns`` are read."""
    names = ["symbol", "date", "ingested_at", *columns]
    rows = table(spark, sf_dir, "ohlcv").select(*names).withColumn("symbol", canonical(F.col("symbol"))).where("symbol IS NOT NULL AND date IS NOT NULL")
    return pit.latest_version(rows, ["symbol", "date"], "ingested_at")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership as it holds, with the interval's end as ``end_eff``."""
    rows = table(spark, sf_dir, "membership").withColumn("symbol", canonical(F.col("symbol"))).where("symbol IS NOT NULL AND index_name IS NOT NULL AND start_date IS NOT NULL")
    rows = rows.withColumn("version", F.struct("first_seen_utc", F.coalesce("end_date", day(pit.OPEN_END))))
    held = pit.latest_version(rows, ["symbol", "index_name", "start_date"], "version").drop("version")
    return held.withColumn("end_eff", F.coalesce("end_date", day(pit.OPEN_END)))


def sp500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir).where("index_name = 'SP500'")


@C.add(f"WITH {MEMBERS_SQL} SELECT DISTINCT symbol FROM members WHERE index_name = 'SP500' AND start_date <= date '{AS_OF}' AND end_eff >= date '{AS_OF}'")
def pf01_members_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit.members_on(sp500(spark, sf_dir), day(AS_OF))


@C.add(f"WITH {MEMBERS_SQL} SELECT DISTINCT symbol FROM members WHERE index_name = 'SP500' AND end_date IS NULL")
def ca05_current_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp500(spark, sf_dir).where("end_date IS NULL").select("symbol").distinct()


@C.add(f"WITH {MEMBERS_SQL} SELECT DISTINCT symbol FROM members WHERE index_name = 'SP500' AND end_eff >= date '2018-01-01' ORDER BY symbol")
def ag01_tracked_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp500(spark, sf_dir).where("end_eff >= date'2018-01-01'").select("symbol").distinct().orderBy("symbol")


@C.add(f"""WITH {MEMBERS_SQL} SELECT symbol, start_date AS day, 'added' AS change_type FROM members WHERE index_name = 'SP500' AND start_date BETWEEN date '2019-01-01' AND date '2020-12-31'
UNION ALL SELECT symbol, end_date, 'removed' FROM members WHERE index_name = 'SP500' AND end_date BETWEEN date '2019-01-01' AND date '2020-12-31'""")
def st01_membership_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit.membership_changes(sp500(spark, sf_dir), day("2019-01-01"), day("2020-12-31"))


@C.add(f"WITH {MEMBERS_SQL} SELECT symbol, index_name, last_data_date, consecutive_empty_runs FROM members WHERE suspected_delisted")
def hx01_suspected_delistings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir).where("suspected_delisted").select("symbol", "index_name", "last_data_date", "consecutive_empty_runs")


@C.add(f"""WITH {MEMBERS_SQL} SELECT index_name, count(*) AS intervals, count(DISTINCT symbol) AS symbols, count(*) FILTER (WHERE end_date IS NULL) AS open_intervals,
  count(*) FILTER (WHERE suspected_delisted) AS suspected FROM members GROUP BY 1""")
def ag26_membership_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir).groupBy("index_name").agg(
        F.count("*").alias("intervals"), F.countDistinct("symbol").alias("symbols"), F.count_if(F.col("end_date").isNull()).alias("open_intervals"), F.count_if("suspected_delisted").alias("suspected")
    )


@C.add(f"""WITH {MEMBERS_SQL} SELECT symbol FROM (SELECT symbol, max(end_eff) AS last_end, bool_or(coalesce(suspected_delisted, false)) AS flagged FROM members WHERE index_name = 'SP500' GROUP BY 1)
WHERE last_end >= date '{AS_OF}' - 30 AND NOT flagged""")
def ca20_tracked_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols still in the index or removed within 30 days, unless flagged."""
    own = sp500(spark, sf_dir).groupBy("symbol").agg(F.max("end_eff").alias("last_end"), F.bool_or(F.coalesce("suspected_delisted", F.lit(False))).alias("flagged"))
    return own.where((F.col("last_end") >= F.date_sub(day(AS_OF), 30)) & ~F.col("flagged")).select("symbol")


_PANEL = f"""WITH {BARS_SQL}, {MEMBERS_SQL} SELECT b.symbol, b.date, b.close, m.start_date AS matched_start_date
FROM bars b JOIN members m ON b.symbol = m.symbol AND b.date BETWEEN m.start_date AND m.end_eff WHERE m.index_name = 'SP500'"""


@C.add(_PANEL)
def jn01_pit_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the days on which their symbol was a member; a row for each covering interval."""
    panel = pit.interval_join(bars(spark, sf_dir, "close"), "symbol", "date", sp500(spark, sf_dir).select("symbol", "start_date", "end_date"), "start_date", "end_date")
    return panel.select("symbol", "date", "close", "matched_start_date")


@C.add(f"WITH {BARS_SQL}, {MEMBERS_SQL} SELECT symbol, date, close FROM bars b WHERE EXISTS (SELECT 1 FROM members m WHERE m.index_name = 'SP500' AND b.symbol = m.symbol AND b.date BETWEEN m.start_date AND m.end_eff)")
def jn02_member_bars_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit.interval_join(bars(spark, sf_dir, "close"), "symbol", "date", sp500(spark, sf_dir).select("symbol", "start_date", "end_date"), "start_date", "end_date", "left_semi").select("symbol", "date", "close")


@C.add(f"""WITH {BARS_SQL}, {MEMBERS_SQL}, ends AS (SELECT max(date) AS date FROM bars GROUP BY date_trunc('month', date))
SELECT DISTINCT e.date AS day, m.symbol FROM ends e JOIN members m ON m.start_date <= e.date AND m.end_eff > e.date WHERE m.index_name = 'SP500'""")
def jn03_members_at_month_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members on the last session of each month, with ends exclusive.

    The few month ends are laid on each interval's months, so the join is by month, not by range.
    """
    ends = bars(spark, sf_dir).groupBy(F.trunc("date", "MM").alias("month")).agg(F.max("date").alias("day"))
    last = ends.agg(F.max("month").alias("newest"))
    months = sp500(spark, sf_dir).where("end_eff >= start_date").crossJoin(last).where("trunc(start_date, 'MM') <= newest").select("symbol", "start_date", "end_eff", F.explode(F.expr("sequence(trunc(start_date, 'MM'), least(trunc(end_eff, 'MM'), newest), interval 1 month)")).alias("month"))
    return months.join(ends, "month").where("start_date <= day AND end_eff > day").select("day", "symbol").distinct()


@C.add(f"""WITH rel AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, release_id, release_date::date AS released, fiscal_close::date AS closed FROM earnings_releases WHERE release_date IS NOT NULL),
{BARS_SQL} SELECT b.symbol, b.date, r.release_id AS asof_release_id FROM bars b ASOF LEFT JOIN (SELECT symbol, released, max(release_id) AS release_id FROM rel WHERE symbol IS NOT NULL GROUP BY 1, 2) r ON b.symbol = r.symbol AND b.date > r.released""")
def jn04_release_known_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each bar with the release last known strictly before its day."""
    rel = table(spark, sf_dir, "earnings_releases").select(canonical(F.col("symbol")).alias("symbol"), "release_id", F.col("release_date").cast("date").alias("released")).where("symbol IS NOT NULL AND released IS NOT NULL")
    return pit.as_of_join(bars(spark, sf_dir), rel, ["symbol"], "date", "released", ["release_id"], strict=True).select("symbol", "date", "asof_release_id")


@C.add(f"""WITH {BARS_SQL}, d AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, fiscal_close::date AS day FROM earnings_releases WHERE fiscal_close IS NOT NULL AND symbol IS NOT NULL)
SELECT d.symbol, d.day, CASE WHEN d.day - b.date <= 20 THEN b.close END AS asof_close FROM d ASOF LEFT JOIN bars b ON d.symbol = b.symbol AND d.day >= b.date""")
def jn05_price_at_close_20d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The close of each fiscal day or the last one up to 20 days before."""
    days = table(spark, sf_dir, "earnings_releases").select(canonical(F.col("symbol")).alias("symbol"), F.col("fiscal_close").cast("date").alias("day")).where("symbol IS NOT NULL AND day IS NOT NULL").distinct()
    return pit.as_of_join(days, bars(spark, sf_dir, "close"), ["symbol"], "day", "date", ["close"], tolerance_days=20)


@C.add("SELECT e.user_id, e.event_id, p.event_id AS asof_event_id FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p ON e.user_id = p.user_id AND e.ts >= p.ts")
def jn06_last_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    buys = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought"), "event_id")
    return pit.as_of_join(events.select("user_id", "event_id", "ts"), buys, ["user_id"], "ts", "bought", ["event_id"]).select("user_id", "event_id", "asof_event_id")


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, lag(date) OVER (PARTITION BY symbol ORDER BY date) AS prior_session FROM bars")
def jn07_prior_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select("symbol", "date", F.lag("date").over(Window.partitionBy("symbol").orderBy("date")).alias("prior_session"))


@C.add(f"""WITH s AS (SELECT DISTINCT snapshot_date FROM live_constituents), v AS (SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS before, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS after FROM s),
{BARS_SQL}, days AS (SELECT DISTINCT date FROM bars), listed AS (SELECT DISTINCT snapshot_date, {SYMBOL_SQL} AS symbol FROM live_constituents)
SELECT d.date, v.snapshot_date, count(l.symbol) AS listed FROM days d JOIN v ON (v.before IS NULL OR d.date >= v.snapshot_date) AND (v.after IS NULL OR d.date < v.after) JOIN listed l USING (snapshot_date) GROUP BY 1, 2""")
def jn08_listed_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many symbols were listed on each session, by the latest snapshot then."""
    listed = table(spark, sf_dir, "live_constituents").select("snapshot_date", canonical(F.col("symbol")).alias("symbol")).distinct()
    validity = pit.snapshot_validity(listed, "snapshot_date")
    counts = listed.groupBy("snapshot_date").agg(F.count("symbol").alias("listed"))
    days = bars(spark, sf_dir).select("date").distinct()
    on = (F.col("valid_from").isNull() | (F.col("date") >= F.col("valid_from"))) & (F.col("valid_to").isNull() | (F.col("date") <= F.col("valid_to")))
    return days.join(validity, on).join(counts, "snapshot_date").select("date", "snapshot_date", "listed")


@C.add(f"""WITH r AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, release_id, fiscal_close, release_date, report_filed FROM earnings_releases WHERE symbol IS NOT NULL)
SELECT symbol, release_id, fiscal_close FROM r WHERE release_date <= timestamptz '{AS_OF} 00:00:00+00' QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY fiscal_close DESC NULLS LAST, release_date DESC, release_id DESC) <= 2""")
def wn05_latest_known_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two latest fiscal closes per symbol among releases known by a day."""
    rel = table(spark, sf_dir, "earnings_releases").select(canonical(F.col("symbol")).alias("symbol"), "release_id", "fiscal_close", "release_date").where("symbol IS NOT NULL").distinct()
    return pit.latest_known(rel, ["symbol"], "fiscal_close", "release_date", F.lit(f"{AS_OF} 00:00:00").cast("timestamp"), 2, ["release_id"]).select("symbol", "release_id", "fiscal_close")


@C.add("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def wn04_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit.top_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderdate")


@C.add("SELECT event_type, value FROM events WHERE ts <= timestamp '2024-01-20' AND value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1")
def wn06_latest_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value per series at or before a time, as one aggregate without a sort."""
    seen = table(spark, sf_dir, "events").where("ts <= timestamp_ntz'2024-01-20 00:00:00' AND value IS NOT NULL")
    return seen.groupBy("event_type").agg(F.max(F.struct("ts", "event_id", "value")).alias("m")).select("event_type", "m.value")


@C.add(f"WITH l AS (SELECT max(snapshot_date) AS d FROM live_constituents WHERE snapshot_date <= date '2024-06-30') SELECT DISTINCT {SYMBOL_SQL} AS symbol, snapshot_date FROM live_constituents JOIN l ON snapshot_date = d")
def pf07_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "live_constituents").select("snapshot_date", canonical(F.col("symbol")).alias("symbol"))
    return pit.snapshot_as_of(rows, "snapshot_date", day("2024-06-30")).select("symbol", "snapshot_date").distinct()


@C.add(f"""WITH s AS (SELECT DISTINCT snapshot_date, {SYMBOL_SQL} AS symbol FROM live_constituents), n AS (SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS nth FROM (SELECT DISTINCT snapshot_date FROM s)),
r AS (SELECT symbol, s.snapshot_date, nth, nth - row_number() OVER (PARTITION BY symbol ORDER BY nth) AS island FROM s JOIN n USING (snapshot_date))
SELECT symbol, min(snapshot_date) AS start_date, CASE WHEN max(nth) < (SELECT max(nth) FROM n) THEN max(snapshot_date) END AS end_date FROM r GROUP BY symbol, island""")
def wn20_intervals_from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit.intervals_from_snapshots(table(spark, sf_dir, "live_constituents").withColumn("symbol", canonical(F.col("symbol"))), "symbol", "snapshot_date")


@C.add("""WITH d AS (SELECT DISTINCT user_id, ts::date AS d FROM events), r AS (SELECT *, d - row_number() OVER (PARTITION BY user_id ORDER BY d)::int AS island FROM d)
SELECT user_id, min(d) AS first_day, max(d) AS last_day, count(*) AS days FROM r GROUP BY user_id, island""")
def wn20_active_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit.islands(table(spark, sf_dir, "events"), "user_id", "ts")


@C.add(f"""WITH a AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol FROM live_constituents WHERE snapshot_date = (SELECT min(snapshot_date) FROM live_constituents)), b AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol FROM live_constituents WHERE snapshot_date = (SELECT max(snapshot_date) FROM live_constituents))
SELECT coalesce(a.symbol, b.symbol) AS symbol, CASE WHEN a.symbol IS NULL THEN 'added' WHEN b.symbol IS NULL THEN 'removed' ELSE 'unchanged' END AS change FROM a FULL JOIN b ON a.symbol = b.symbol""")
def jn13_universe_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "live_constituents").select("snapshot_date", canonical(F.col("symbol")).alias("symbol"))
    first = rows.join(rows.agg(F.min("snapshot_date").alias("snapshot_date")), "snapshot_date")
    last = rows.join(rows.agg(F.max("snapshot_date").alias("snapshot_date")), "snapshot_date")
    return pit.key_changes(first, last, "symbol")


@C.add("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def jn12_keys_not_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("bigint").alias("c_custkey"))
    return pit.rows_not_in(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), stored, ["c_custkey"])


@C.add(f"""WITH {BARS_SQL}, p AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prior FROM bars WHERE date <= date '2024-12-31'),
f AS (SELECT *, CASE WHEN coalesce(dividends, 0) > 0 AND prior > 0 AND dividends < prior THEN 1 - dividends / prior ELSE 1 END AS factor FROM p),
c AS (SELECT *, exp(coalesce(sum(ln(factor)) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)) AS adj FROM f)
SELECT symbol, date, round(adj, 6) AS adj_factor, round(close * adj, 4) AS adj_close FROM c WHERE date <= date '2023-12-31'""")
def ca01_adjusted_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes adjusted for dividends known by the end of 2024, for days up to 2023."""
    out = adjust.adjusted(bars(spark, sf_dir, "close", "dividends"), "symbol", "date", as_of=day("2024-12-31"), end=day("2023-12-31"))
    return out.select("symbol", "date", F.round("adj_factor", 6).alias("adj_factor"), F.round("adj_close", 4).alias("adj_close"))


_CORRECTED = f"""WITH {BARS_SQL}, p AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prior FROM bars WHERE close > 0 AND adj_close > 0),
f AS (SELECT *, CASE WHEN coalesce(dividends, 0) > 0 AND prior > 0 AND dividends < prior THEN 1 - dividends / prior ELSE 1 END AS factor FROM p),
l AS (SELECT *, coalesce(sum(ln(factor)) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later, ln(adj_close / close) AS stored FROM f),
b AS (SELECT *, min(stored - later) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS best FROM l),
corrected AS (SELECT symbol, date, close, adj_close AS stored, exp(later + best) AS ratio, close * exp(later + best) AS adj_close FROM b)"""


@C.add(f"{_CORRECTED} SELECT symbol, date, stored, round(ratio, 6) AS ratio, round(adj_close, 4) AS adj_close FROM corrected")
def ca02_corrected_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = adjust.corrected(bars(spark, sf_dir, "close", "adj_close", "dividends"), "symbol", "date")
    return out.select("symbol", "date", "stored", F.round("ratio", 6).alias("ratio"), F.round("adj_close", 4).alias("adj_close"))


@C.add(f"""{_CORRECTED} SELECT symbol, count(*) FILTER (WHERE abs(adj_close - stored) / stored > 0.05) AS stale_rows, round(max(abs(adj_close - stored) / stored), 5) AS worst FROM corrected GROUP BY symbol
HAVING count(*) FILTER (WHERE abs(adj_close - stored) / stored > 0.05) > 0""")
def ca03_adjustment_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = adjust.drift(adjust.corrected(bars(spark, sf_dir, "close", "adj_close", "dividends"), "symbol", "date"), "symbol", 0.05)
    return out.select("symbol", "stale_rows", F.round("worst", 5).alias("worst"))


@C.add(f"""{_CORRECTED} SELECT b.symbol, b.date, round(CASE WHEN c.symbol IS NOT NULL AND abs(c.adj_close - b.adj_close) / c.adj_close >= 0.05 THEN c.adj_close ELSE b.adj_close END, 4) AS adj_close,
  coalesce(abs(c.adj_close - b.adj_close) / c.adj_close >= 0.05, false) AS was_repaired FROM bars b LEFT JOIN corrected c ON b.symbol = c.symbol AND b.date = c.date""")
def sk12_repaired_adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored values that drifted from their target get it; rows without a target stay."""
    rows = bars(spark, sf_dir, "close", "adj_close", "dividends")
    out = adjust.repair(rows, adjust.corrected(rows, "symbol", "date"), ["symbol", "date"], "adj_close", 0.05)
    return out.select("symbol", "date", F.round("adj_close", 4).alias("adj_close"), "was_repaired")
