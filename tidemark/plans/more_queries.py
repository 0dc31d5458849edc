"""Further entries of the inventory: snapshots, matching by name, runs of empty days, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions.dates import market_time
from tidemark.functions.symbols import canonical
from tidemark.functions.text import first_tone
from tidemark.operators import pit, quarters
from tidemark.plans.pit_queries import bars, members
from tidemark.plans.registry import BARS_SQL, MEMBERS_SQL, SYMBOL_SQL, Catalogue
from tidemark.session import shared_dir, table
from tidemark.sources import parsers

C = Catalogue()


@C.add(f"SELECT DISTINCT {SYMBOL_SQL} AS symbol, snapshot_date FROM live_constituents WHERE snapshot_date BETWEEN date '2024-03-01' AND date '2024-05-31'")
def sc05_snapshot_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots written by day and read in a range: other folders are not opened (SK10)."""
    path = shared_dir(spark, "snapshots")
    rows = table(spark, sf_dir, "live_constituents").select(canonical(F.col("symbol")).alias("symbol"), "snapshot_date").distinct()
    rows.repartition("snapshot_date").write.partitionBy("snapshot_date").parquet(path)
    return spark.read.schema("symbol string, snapshot_date date").parquet(path).where("snapshot_date BETWEEN date'2024-03-01' AND date'2024-05-31'")


@C.add("SELECT o_orderkey, o_orderdate::date AS trade_date, CASE WHEN o_orderkey % 4 <> 0 AND o_custkey > 0 THEN o_custkey / 2.0::double END AS open, date '2002-01-16' - o_orderdate::date AS dte FROM orders WHERE o_orderkey % 5 <> 0")
def sc15_contract_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract's days as CSV: without trades the open is null; days without a settlement are dropped."""
    o = table(spark, sf_dir, "orders")
    cell = lambda c: c.cast("string")
    lines = o.select(F.concat_ws(",", cell(F.col("o_orderkey")), F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 4 == 0, "0").otherwise(cell(F.col("o_custkey") / 2.0)), F.when(F.col("o_orderkey") % 5 == 0, "0").otherwise("7.25")).alias("line"))
    head = spark.createDataFrame([("o_orderkey,Trade Date,Open,Settle",)], "line string")
    rows = parsers.delimited(lines.unionAll(head), "line", {"o_orderkey": "bigint", "trade_date": "date", "open": "double", "settle": "double"}, sep=",")
    out = parsers.positive_or_null(rows.where("settle > 0"), ["open"])
    return out.select("o_orderkey", "trade_date", "open", F.datediff(F.lit("2002-01-16").cast("date"), F.col("trade_date")).cast("bigint").alias("dte"))


@C.add("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 <> 0 THEN s_name END AS organisation, greatest(-1, least(1, (s_suppkey - 50) / 40.0::double)) AS sentiment FROM supplier""")
def sc19_tab_separated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated lines by position with an organisation list and a tone tuple."""
    orgs = F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.concat("s_name", F.lit(",12;OTHER,90")))
    tone = F.concat(((F.col("s_suppkey") - 50) * 2.5).cast("string"), F.lit(",1,3"))
    lines = table(spark, sf_dir, "supplier").select(F.concat_ws("\t", F.col("s_suppkey").cast("string"), orgs, tone).alias("line"))
    cells = parsers.delimited(lines, "line", {"s_suppkey": "bigint", "orgs": "string", "tone": "string"}, sep="\t")
    return cells.select("s_suppkey", F.nullif(F.split(F.split("orgs", ";")[0], ",")[0], F.lit("")).alias("organisation"), first_tone(F.col("tone")).alias("sentiment"))


@C.add("SELECT event_id, (ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York')::date AS session FROM events")
def sc23_session_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.to_date(market_time(F.col("ts").cast("timestamp"))).alias("session"))


@C.add(f"SELECT DISTINCT {SYMBOL_SQL} AS symbol, release_id FROM earnings_releases WHERE release_date IS NOT NULL AND release_date <= timestamptz '2019-12-31 00:00:00+00'")
def pf09_known_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts by the date on which they were known, never by the one for which they hold."""
    known = F.col("release_date").isNotNull() & (F.col("release_date") <= F.lit("2019-12-31 00:00:00").cast("timestamp"))
    return table(spark, sf_dir, "earnings_releases").where(known).select(canonical(F.col("symbol")).alias("symbol"), "release_id").distinct()


@C.add("SELECT n_name, count(c_custkey) AS customers, coalesce(max(s.n), 0) AS suppliers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey GROUP BY 1")
def jn20_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    joined = table(spark, sf_dir, "nation").select("n_nationkey", "n_name").join(c, "n_nationkey", "left").join(s, "n_nationkey", "left")
    return joined.select("n_name", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("suppliers", F.lit(0)).alias("suppliers"))


@C.add("SELECT o_custkey, min(o_orderdate) AS first_close, round(sum(o_totalprice), 2) AS volume, bool_or(contains(o_orderpriority, '1')) AS any_urgent FROM orders GROUP BY 1")
def ag18_event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_close"), F.round(F.sum("o_totalprice"), 2).alias("volume"), F.bool_or(F.contains("o_orderpriority", F.lit("1"))).alias("any_urgent"))


@C.add("SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice) / stddev_samp(o_totalprice) * sqrt(count(*)), 4) AS t FROM orders GROUP BY 1")
def ag22_t_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice") / F.stddev_samp("o_totalprice") * F.sqrt(F.count("*")), 4).alias("t"))


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, max(ingested_at) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS known, max(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS best_before FROM bars")
def wn11_running_and_shifted_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running maximum of a known time, and the maximum of the 20 rows before (WN13)."""
    w = Window.partitionBy("symbol").orderBy("date")
    return bars(spark, sf_dir, "close").select("symbol", "date", F.max("ingested_at").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("known"), F.max("close").over(w.rowsBetween(-20, -1)).alias("best_before"))


@C.add("""WITH l AS (SELECT l_partkey AS event, l_quantity AS k, round(avg(l_discount * 10), 6) AS p FROM lineitem GROUP BY 1, 2) SELECT event, k, (min(p) OVER (PARTITION BY event ORDER BY k ROWS UNBOUNDED PRECEDING) + max(p) OVER (PARTITION BY event ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) / 2 AS p_above FROM l""")
def wn18_monotone_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ladder made monotone from both ends; its crossing of one half (WN19) is ca15_ladder_medians."""
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("event"), F.col("l_quantity").alias("k")).agg(F.round(F.avg(F.col("l_discount") * 10), 6).alias("p"))  # noqa: E741
    return quarters.monotone(l, "event", "k", "p").select("event", "k", "p_above")


@C.add(f"""WITH {BARS_SQL}, g AS (SELECT symbol, date, close, count(close) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS island FROM bars) SELECT symbol, date, count(*) FILTER (WHERE close IS NULL) OVER (PARTITION BY symbol, island ORDER BY date ROWS UNBOUNDED PRECEDING) AS empty_runs, empty_runs >= 3 AS suspected FROM g""")
def wn21_empty_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive rows without a value, reset by the next value, and whether they reach three."""
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    g = bars(spark, sf_dir, "close").withColumn("island", F.count("close").over(w))
    run = Window.partitionBy("symbol", "island").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return g.select("symbol", "date", F.count(F.when(F.col("close").isNull(), 1)).over(run).alias("empty_runs")).withColumn("suspected", F.col("empty_runs") >= 3)


@C.add("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def so02_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-25 report."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@C.add("SELECT l_orderkey, l_linenumber, round(l_quantity * l_extendedprice, 2) AS notional, CASE WHEN l_discount > 0.05 AND l_tax > 0.04 THEN 'both' WHEN l_discount > 0.05 THEN 'first' WHEN l_tax > 0.04 THEN 'second' ELSE 'neither' END AS quadrant FROM lineitem")
def fn34_notional_and_quadrant(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("l_discount") > 0.05, F.col("l_tax") > 0.04
    label = F.when(a & b, "both").when(a, "first").when(b, "second").otherwise("neither")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_quantity") * F.col("l_extendedprice"), 2).alias("notional"), label.alias("quadrant"))


@C.add(f"WITH {MEMBERS_SQL} SELECT index_name, max(start_date) AS last_start, max(end_date) AS last_end FROM members GROUP BY 1")
def hx03_last_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir).groupBy("index_name").agg(F.max("start_date").alias("last_start"), F.max("end_date").alias("last_end"))


@C.add(f"""WITH a AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol FROM live_constituents WHERE snapshot_date = (SELECT min(snapshot_date) FROM live_constituents)), b AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol FROM live_constituents WHERE snapshot_date = (SELECT max(snapshot_date) FROM live_constituents))
SELECT CASE WHEN a.symbol IS NULL THEN 'added' WHEN b.symbol IS NULL THEN 'removed' ELSE 'unchanged' END AS change, count(*) AS n FROM a FULL JOIN b ON a.symbol = b.symbol GROUP BY 1""")
def hx04_diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "live_constituents").select("snapshot_date", canonical(F.col("symbol")).alias("symbol"))
    edge = lambda f: rows.join(rows.agg(f("snapshot_date").alias("snapshot_date")), "snapshot_date")
    return pit.key_changes(edge(F.min), edge(F.max), "symbol").groupBy("change").agg(F.count("*").alias("n"))
