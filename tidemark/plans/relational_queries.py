"""Filters, aggregates, windows, sorts and set operations of the reference inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions.symbols import canonical
from tidemark.operators import scan, stats
from tidemark.operators.pit import top_per_key
from tidemark.plans.pit_queries import bars, day, members
from tidemark.plans.registry import BARS_SQL, MEMBERS_SQL, SYMBOL_SQL, Catalogue
from tidemark.session import table

C = Catalogue()


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def short_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "short_volume_files").withColumn("symbol", canonical(F.col("symbol")))


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, close FROM bars WHERE symbol IN ('ZQX', 'XXZK') AND date BETWEEN date '2020-01-01' AND date '2021-12-31' ORDER BY symbol, date")
def pf02_symbols_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of some symbols; the list is upper-cased, an empty one would give no rows."""
    wanted = [s.upper() for s in ("zqx", "xxzk")]
    return bars(spark, sf_dir, "close").where(F.col("symbol").isin(wanted) & F.col("date").between("2020-01-01", "2021-12-31")).select("symbol", "date", "close").orderBy("symbol", "date")


@C.add("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linestatus = 'O' AND l_quantity >= 10 AND l_quantity <= 20 AND l_shipdate >= timestamp '1996-01-01'")
def pf03_optional_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).where("l_linestatus = 'O' AND l_quantity >= 10 AND l_quantity <= 20 AND l_shipdate >= timestamp_ntz'1996-01-01 00:00:00'").select("l_orderkey", "l_linenumber", "l_quantity")


@C.add("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def pf04_positional_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_view")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM orders_view WHERE o_orderstatus = ? AND o_totalprice > ?", args=["F", 100000])


@C.add(f"WITH {MEMBERS_SQL} SELECT symbol, index_name, start_date, end_eff, end_date IS NULL AS is_current, 'member' AS tag FROM members")
def pf05_derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir).select("symbol", "index_name", "start_date", "end_eff", F.col("end_date").isNull().alias("is_current"), F.lit("member").alias("tag"))


@C.add("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(?i)(green|blue)') OR starts_with(p_type, 'PROMO')")
def pf08_text_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(F.col("p_name").rlike("(?i)(green|blue)") | F.col("p_type").startswith("PROMO")).select("p_partkey", "p_name")


@C.add(f"WITH {BARS_SQL} SELECT DISTINCT date FROM bars WHERE isodow(date) = 5 AND day(date) BETWEEN 15 AND 21")
def pf10_third_fridays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).where("weekday(date) = 4 AND day(date) BETWEEN 15 AND 21").select("date").distinct()


@C.add(f"""WITH {BARS_SQL} SELECT symbol, date FROM (SELECT *, max(CASE WHEN NOT coalesce(open = high AND high = low AND low = close AND volume = 0, false) THEN date END) OVER (PARTITION BY symbol) AS last_real FROM bars) WHERE date <= last_real""")
def pf11_without_trailing_filler(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = F.coalesce((F.col("open") == F.col("high")) & (F.col("high") == F.col("low")) & (F.col("low") == F.col("close")) & (F.col("volume") == 0), F.lit(False))
    return stats.trailing_filler(bars(spark, sf_dir, "open", "high", "low", "close", "volume"), "symbol", "date", flat).select("symbol", "date")


@C.add(f"""WITH {BARS_SQL}, n AS (SELECT date, count(close) AS bars_n FROM bars GROUP BY 1), p AS (SELECT *, max(bars_n) OVER (ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS best FROM n)
SELECT date, bars_n FROM p WHERE date <= (SELECT max(date) FROM p WHERE bars_n >= 0.9 * coalesce(best, bars_n))""")
def pf12_complete_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days up to the last that has 9 in 10 of the bars that the 20 before had at best."""
    n = bars(spark, sf_dir, "close").groupBy("date").agg(F.count("close").alias("bars_n"))  # a row a day from here on
    p = n.withColumn("best", F.max("bars_n").over(Window.orderBy("date").rowsBetween(-20, -1)))
    last = p.where(F.col("bars_n") >= 0.9 * F.coalesce("best", "bars_n")).agg(F.max("date").alias("last"))
    return p.join(last, F.col("date") <= F.col("last")).select("date", "bars_n")


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, CASE WHEN close <= 0 OR close > 400 THEN NULL ELSE close END AS close FROM bars")
def pf13_outliers_blanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir, "close").select("symbol", "date", F.when((F.col("close") <= 0) | (F.col("close") > 400), None).otherwise(F.col("close")).alias("close"))


@C.add(f"""WITH {MEMBERS_SQL}, s AS (SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT symbol FROM members)) SELECT symbol FROM s WHERE ((place - 7300) % n + n) % n < 25""")
def pf14_rotating_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rotating_slice(members(spark, sf_dir).select("symbol").distinct(), "symbol", 7300, 25)


@C.add("SELECT 20 AS drawn, 20 AS distinct_keys, 20 AS known_keys, true AS repeats FROM region LIMIT 1")
def pf15_random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 20 customers by a seeded hash: all different, all customers, and the same again when drawn again."""
    customers = table(spark, sf_dir, "customer")
    draw = lambda: stats.seeded_sample(customers, "c_custkey", 20, 7).select("c_custkey", F.lit(True).alias("drawn"))
    first, again = draw(), draw().withColumnRenamed("drawn", "again")
    known = customers.select("c_custkey", F.lit(True).alias("known"))
    both = first.join(again, "c_custkey", "full").join(known, "c_custkey", "left")
    return both.agg(F.count("drawn").cast("int").alias("drawn"), F.countDistinct("c_custkey").cast("int").alias("distinct_keys"), F.count("known").cast("int").alias("known_keys"), F.bool_and(F.col("drawn") & F.col("again")).alias("repeats"))


@C.add(f"WITH {BARS_SQL}, r AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, fiscal_close::date AS date, release_id FROM earnings_releases) SELECT b.symbol, b.date, r.release_id FROM bars b LEFT JOIN r ON b.symbol = r.symbol AND b.date = r.date")
def jn09_left_on_symbol_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "earnings_releases").select(canonical(F.col("symbol")).alias("symbol"), F.col("fiscal_close").cast("date").alias("date"), "release_id").distinct()
    return bars(spark, sf_dir).select("symbol", "date").join(r, ["symbol", "date"], "left")


@C.add(f"""WITH w AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, window_id, fiscal_close::date AS period FROM blackout_windows), r AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, release_id, fiscal_close::date AS period, report_filed FROM earnings_releases)
SELECT w.symbol, w.period, window_id, release_id, report_filed AS report_filed_new FROM w JOIN r ON w.symbol = r.symbol AND w.period = r.period""")
def jn10_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    sym = canonical(F.col("symbol")).alias("symbol")
    period = F.col("fiscal_close").cast("date").alias("period")
    w = table(spark, sf_dir, "blackout_windows").select(sym, "window_id", period).distinct()
    r = table(spark, sf_dir, "earnings_releases").select(sym, "release_id", period, F.col("report_filed").alias("report_filed_new")).distinct()
    return w.join(r, ["symbol", "period"])


@C.add("SELECT o.o_orderkey, o.o_totalprice, round(sum(l_extendedprice), 2) AS lines_total FROM orders o JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2")
def jn11_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lineitem(spark, sf_dir).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("s"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").join(lines, "o_orderkey").select("o_orderkey", "o_totalprice", F.round("s", 2).alias("lines_total"))


@C.add(f"""WITH {BARS_SQL}, s AS (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS nth, close FROM bars) SELECT a.symbol, a.date, round(b.close / a.close - 1, 6) AS forward_5 FROM s a JOIN s b ON a.symbol = b.symbol AND b.nth = a.nth + 5 WHERE a.close > 0 AND b.close IS NOT NULL""")
def jn22_forward_by_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The return over the next five sessions, as a lead instead of a self-join."""
    ahead = F.lead("close", 5).over(Window.partitionBy("symbol").orderBy("date"))
    out = bars(spark, sf_dir, "close").withColumn("ahead", ahead).where("close > 0 AND ahead IS NOT NULL")
    return out.select("symbol", "date", F.round(F.col("ahead") / F.col("close") - 1, 6).alias("forward_5"))


@C.add(f"""WITH w AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, shut, reopen FROM blackout_windows WHERE shut IS NOT NULL AND reopen IS NOT NULL), d AS (SELECT DISTINCT symbol, unnest(generate_series(shut::timestamp, (reopen - 1)::timestamp, interval 1 day))::date AS day FROM w WHERE shut < reopen)
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS shut_symbols FROM d GROUP BY 1""")
def jn21_shut_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols in a window on each day, in long form: shut <= day < reopen."""
    w = table(spark, sf_dir, "blackout_windows").select(canonical(F.col("symbol")).alias("symbol"), "shut", "reopen").where("shut < reopen").distinct()
    days = w.select("symbol", F.explode(F.sequence("shut", F.date_sub("reopen", 1))).alias("day")).distinct()
    return days.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("shut_symbols"))


@C.add(f"SELECT market, count(*) AS n, count(DISTINCT {SYMBOL_SQL}) AS symbols, count(DISTINCT date) AS days FROM short_volume_files GROUP BY 1")
def ag02_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return short_volume(spark, sf_dir).groupBy("market").agg(F.count("*").alias("n"), F.countDistinct("symbol").alias("symbols"), F.countDistinct("date").alias("days"))


@C.add(f"SELECT {SYMBOL_SQL} AS symbol, count(DISTINCT date) AS days, count(*) AS n FROM short_volume_files GROUP BY 1 ORDER BY days DESC, n DESC, symbol LIMIT 20")
def ag04_top_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-20 report: a limit with a total order."""
    return short_volume(spark, sf_dir).groupBy("symbol").agg(F.countDistinct("date").alias("days"), F.count("*").alias("n")).orderBy(F.desc("days"), F.desc("n"), "symbol").limit(20)


@C.add("""SELECT l_returnflag, round(sum(l_quantity) FILTER (WHERE l_linestatus = 'F') / nullif(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0), 6) AS ratio, round(avg(CASE WHEN l_discount > 0.05 THEN l_extendedprice END), 4) AS mean_discounted FROM lineitem GROUP BY 1""")
def ag05_filtered_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = lambda s: F.sum(F.when(F.col("l_linestatus") == s, F.col("l_quantity")))
    return lineitem(spark, sf_dir).groupBy("l_returnflag").agg(F.round(F.try_divide(q("F"), q("O")), 6).alias("ratio"), F.round(F.avg(F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice"))), 4).alias("mean_discounted"))


@C.add(f"WITH {BARS_SQL} SELECT symbol, min(date) AS first_day, max(date) AS last_day, count(*) AS n FROM bars GROUP BY 1")
def ag06_first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).groupBy("symbol").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count("*").alias("n"))


@C.add("SELECT o_orderpriority, median(o_totalprice) AS middle, median(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS middle_f FROM orders GROUP BY 1")
def ag08_filtered_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("f"))
    middle = lambda c, name: stats.exact_quantiles(o, ["o_orderpriority"], c, [0.5]).select("o_orderpriority", F.col("q")[0].alias(name))
    return middle("o_totalprice", "middle").join(middle("f", "middle_f"), "o_orderpriority", "left")


@C.add(f"""WITH {BARS_SQL}, m AS (SELECT max(date) AS last FROM bars) SELECT symbol, round(CASE WHEN y > 0.25 THEN 0.25 ELSE y END, 6) AS dividend_yield FROM (SELECT symbol, sum(CASE WHEN date > last - 370 THEN coalesce(dividends, 0) END) / nullif(arg_max(close, date) FILTER (WHERE close IS NOT NULL), 0) AS y FROM bars, m GROUP BY 1)""")
def ag09_trailing_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(spark, sf_dir, "close", "dividends")
    joined = b.crossJoin(b.agg(F.max("date").alias("last")))  # one row
    recent = F.sum(F.when(F.col("date") > F.date_sub("last", 370), F.coalesce("dividends", F.lit(0.0))))
    last_close = F.max_by("close", F.when(F.col("close").isNotNull(), F.col("date")))
    return joined.groupBy("symbol").agg(F.round(F.least(F.try_divide(recent, last_close), F.when(F.try_divide(recent, last_close).isNotNull(), 0.25)), 6).alias("dividend_yield"))


@C.add("""SELECT user_id, time_bucket(interval 1 hour, ts) AS bar_start, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, round(sum(value), 6) AS volume, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2""")
def ag11_time_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("ts", "event_id")
    e = table(spark, sf_dir, "events").where("value IS NOT NULL")
    return e.groupBy("user_id", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("bar_start")).agg(
        F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.round(F.sum("value"), 6).alias("volume"), F.count("*").alias("n")
    )


@C.add("""WITH d AS (SELECT user_id, ts::date AS day, sum(value) AS total, max(value) AS biggest FROM events GROUP BY 1, 2) SELECT user_id, round(avg(total) / 50, 6) AS threshold, round(median(total), 6) AS middle_day, round(max(biggest), 6) AS biggest FROM d GROUP BY 1""")
def ag12_calibrated_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").groupBy("user_id", F.col("ts").cast("date").alias("d")).agg(F.sum("value").alias("total"), F.max("value").alias("biggest"))
    return d.groupBy("user_id").agg(F.round(F.avg("total") / 50, 6).alias("threshold"), F.round(F.median("total"), 6).alias("middle_day"), F.round(F.max("biggest"), 6).alias("biggest"))


@C.add("SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 8) AS weighted FROM lineitem GROUP BY 1")
def ag13_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).groupBy("l_returnflag").agg(F.round(F.sum(F.col("l_discount") * F.col("l_quantity")) / F.sum("l_quantity"), 8).alias("weighted"))


_SPLIT = "SELECT o_orderpriority AS g, quantile_cont(o_totalprice, 0.3) AS lo, quantile_cont(o_totalprice, 0.7) AS hi FROM orders GROUP BY 1"


@C.add(f"""WITH q AS ({_SPLIT}) SELECT g, count(*) FILTER (WHERE o_totalprice <= lo) AS low_n, count(*) FILTER (WHERE o_totalprice >= hi) AS high_n,
round(avg(o_totalprice) FILTER (WHERE o_totalprice >= hi) - avg(o_totalprice) FILTER (WHERE o_totalprice <= lo), 4) AS spread FROM orders JOIN q ON o_orderpriority = g GROUP BY 1""")
def ag14_quantile_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low and high groups by the 30 and 70 % quantiles and the spread of their means."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("g"), F.col("o_totalprice").alias("v"))
    return stats.quantile_spread(o, ["g"], "v", "v", 0.3, 0.7).withColumn("spread", F.round("spread", 4))


@C.add("""SELECT p_brand, round(median(l_discount), 6) AS middle, round(avg(CASE WHEN l_tax > l_discount THEN 1.0 ELSE 0 END), 6) AS rising, round((sum(CASE WHEN l_tax > l_discount THEN 1 ELSE 0 END) - sum(CASE WHEN l_tax < l_discount THEN 1 ELSE 0 END))
/ nullif(sum(CASE WHEN l_tax <> l_discount THEN 1 ELSE 0 END), 0)::double, 6) AS breadth, count(DISTINCT l_suppkey) AS names FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def ag15_group_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = lineitem(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")  # noqa: E741
    up, down = F.count_if(F.col("l_tax") > F.col("l_discount")), F.count_if(F.col("l_tax") < F.col("l_discount"))
    return l.groupBy("p_brand").agg(
        F.round(F.median("l_discount"), 6).alias("middle"), F.round(F.avg(F.when(F.col("l_tax") > F.col("l_discount"), 1.0).otherwise(0.0)), 6).alias("rising"), F.round(F.try_divide(up - down, up + down), 6).alias("breadth"), F.countDistinct("l_suppkey").alias("names")
    )


@C.add(f"SELECT {SYMBOL_SQL} AS symbol, round(sum(short_exempt_volume), 2) AS exempt FROM short_volume_files GROUP BY 1")
def ag16_sum_null_if_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return short_volume(spark, sf_dir).groupBy("symbol").agg(F.round(F.sum("short_exempt_volume"), 2).alias("exempt"))


@C.add("SELECT event_type, count(*) FILTER (WHERE ts > timestamp '2024-01-20') AS recent, min(ts) AS first_ts, round(sum(value), 6) AS total, bool_or(value > 99) AS any_high FROM events GROUP BY 1")
def ag17_recent_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count_if(F.expr("ts > timestamp_ntz'2024-01-20 00:00:00'")).alias("recent"), F.min("ts").alias("first_ts"), F.round(F.sum("value"), 6).alias("total"), F.bool_or(F.col("value") > 99).alias("any_high")
    )


@C.add("SELECT user_id, event_type, round(sum(value) / sum(sum(value)) OVER (PARTITION BY user_id), 8) AS share FROM events WHERE value IS NOT NULL GROUP BY 1, 2")
def ag19_shares_that_sum_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "events").where("value IS NOT NULL").groupBy("user_id", "event_type").agg(F.sum("value").alias("s"))
    return s.select("user_id", "event_type", F.round(F.col("s") / F.sum("s").over(Window.partitionBy("user_id")), 8).alias("share"))


@C.add("SELECT l_shipdate::date AS day, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / nullif(sum(l_quantity), 0), 6) AS share FROM lineitem GROUP BY 1")
def ag20_weighted_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
    return lineitem(spark, sf_dir).groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.round(F.try_divide(part, F.sum("l_quantity")), 6).alias("share"))


@C.add("""WITH m AS (SELECT o_orderpriority, date_trunc('month', o_orderdate) AS mth, avg(o_totalprice) AS m FROM orders GROUP BY 1, 2) SELECT o_orderpriority, count(m) AS clusters, round(avg(m), 4) AS mean, round(avg(m) / stddev_samp(m) * sqrt(count(m)), 4) AS t FROM m GROUP BY 1 HAVING count(m) >= 12""")
def ag21_clustered_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("mth", F.date_trunc("month", F.col("o_orderdate")))
    out = stats.mean_of_means(o, ["o_orderpriority"], "mth", "o_totalprice")
    return out.where("clusters >= 12").select("o_orderpriority", "clusters", F.round("mean", 4).alias("mean"), F.round("t", 4).alias("t"))


@C.add("""WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_returnflag, l_discount) - 1) / 2.0 AS a,
rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS b FROM lineitem) SELECT l_returnflag, count(*) AS n, round(corr(a, b), 6) AS ic FROM r GROUP BY 1""")
def ag23_rank_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rank_correlation(lineitem(spark, sf_dir), ["l_returnflag"], "l_discount", "l_extendedprice").withColumn("ic", F.round("ic", 6))


@C.add("""WITH q AS (SELECT l_shipdate::date AS d, quantile_cont(l_quantity, 0.2) AS lo, quantile_cont(l_quantity, 0.8) AS hi FROM lineitem GROUP BY 1) SELECT l_shipdate::date AS d, round(avg(l_discount) FILTER (WHERE l_quantity >= hi) - avg(l_discount) FILTER (WHERE l_quantity <= lo), 6) AS spread
FROM lineitem JOIN q ON l_shipdate::date = d GROUP BY 1""")
def ag24_quintile_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = lineitem(spark, sf_dir).select(F.col("l_shipdate").cast("date").alias("d"), "l_quantity", "l_discount")  # noqa: E741
    return stats.quantile_spread(l, ["d"], "l_quantity", "l_discount", 0.2, 0.8).select("d", F.round("spread", 6).alias("spread"))


@C.add("SELECT 'orders' AS dataset, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def ag25_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [table(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("dataset"), "n") for t in ("orders", "lineitem", "events")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@C.add(f"SELECT {SYMBOL_SQL} AS symbol, round(avg(CASE WHEN short_volume > 0 THEN 1.0 ELSE 0 END), 6) AS coverage FROM short_volume_files GROUP BY 1")
def ag27_share_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return short_volume(spark, sf_dir).groupBy("symbol").agg(F.round(F.avg(F.when(F.col("short_volume") > 0, 1.0).otherwise(0.0)), 6).alias("coverage"))


@C.add(f"SELECT {SYMBOL_SQL} AS symbol, date, market, CASE WHEN total_volume > 0 THEN round(short_volume / total_volume, 6) END AS ratio, ingested_at FROM short_volume_files")
def ag28_ratio_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return short_volume(spark, sf_dir).select("symbol", "date", "market", F.when(F.col("total_volume") > 0, F.round(F.col("short_volume") / F.col("total_volume"), 6)).alias("ratio"), "ingested_at")


@C.add(f"""WITH {BARS_SQL}, w AS (SELECT symbol, date, close, lag(close) OVER o AS prior, avg(close) OVER (o ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma20, max(close) OVER (o ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS hi FROM bars WHERE close IS NOT NULL WINDOW o AS (PARTITION BY symbol ORDER BY date))
SELECT date, count(*) FILTER (WHERE close > prior) AS advancers, count(*) FILTER (WHERE close < prior) AS decliners, count(*) FILTER (WHERE close >= hi) AS new_highs, count(*) AS n FROM w GROUP BY 1""")
def ag29_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advancers, decliners and new highs a day (own definition of breadth)."""
    w = Window.partitionBy("symbol").orderBy("date")
    b = bars(spark, sf_dir, "close").where("close IS NOT NULL").withColumn("prior", F.lag("close").over(w)).withColumn("hi", F.max("close").over(w.rowsBetween(-251, 0)))
    return b.groupBy("date").agg(F.count_if(F.col("close") > F.col("prior")).alias("advancers"), F.count_if(F.col("close") < F.col("prior")).alias("decliners"), F.count_if(F.col("close") >= F.col("hi")).alias("new_highs"), F.count("*").alias("n"))


_SLOPE = "CASE WHEN n >= {least} AND y IS NOT NULL AND n * sxx - sx * sx <> 0 AND level > 0 THEN round((sxy - sx * sy / n) / (sxx - sx * sx / n) / level, 6) + 0.0 END"


@C.add(f"""WITH {BARS_SQL}, t AS (SELECT symbol, date, close AS y, row_number() OVER (PARTITION BY symbol ORDER BY date)::double AS i FROM bars), u AS (SELECT *, CASE WHEN y IS NOT NULL THEN i END AS x FROM t),
s AS (SELECT symbol, date, y, count(x) OVER o AS n, sum(x) OVER o AS sx, sum(y) OVER o AS sy, sum(x * y) OVER o AS sxy, sum(x * x) OVER o AS sxx, avg(abs(y)) OVER o AS level FROM u
WINDOW o AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)) SELECT symbol, date, {_SLOPE.format(least=8)} AS trend FROM s""")
def ag30_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope over at most twelve rows relative to their mean level, of at least eight values, the latest among them."""
    order = Window.partitionBy("symbol").orderBy("date")
    b = bars(spark, sf_dir, "close").withColumn("x", F.row_number().over(order).cast("double"))
    return b.select("symbol", "date", stats.unsigned(stats.relative_trend(F.col("close"), F.col("x"), order.rowsBetween(-11, 0), 8), 6).alias("trend"))


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, lag(close) OVER w AS prior, round(close / nullif(lag(close) OVER w, 0) - 1, 6) AS change, round(ln(close / nullif(lag(close) OVER w, 0)), 6) AS log_return FROM bars WHERE close > 0 WINDOW w AS (PARTITION BY symbol ORDER BY date)")
def wn01_lags_and_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(spark, sf_dir, "close").where("close > 0").withColumn("prior", F.lag("close").over(Window.partitionBy("symbol").orderBy("date")))
    return b.select("symbol", "date", "prior", F.round(F.col("close") / F.col("prior") - 1, 6).alias("change"), F.round(F.log(F.col("close") / F.col("prior")), 6).alias("log_return"))


@C.add("SELECT event_id, round(sum(value) OVER (PARTITION BY user_id, ts::date ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS running, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS highest FROM events")
def wn07_running_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sums per session and running maxima, carried on from day to day."""
    w = Window.partitionBy("user_id", "day").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", F.col("ts").cast("date").alias("day")).withColumn("running", F.sum("value").over(w))
    return scan.running(e, ["user_id"], "day", ["ts", "event_id"], "value", "highest", "max").select("event_id", F.round("running", 4).alias("running"), "highest")


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS filled, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS filled_2 FROM bars")
def wn09_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("symbol").orderBy("date")
    return bars(spark, sf_dir, "close").select("symbol", "date", F.last("close", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("filled"), F.last("close", True).over(w.rowsBetween(-2, 0)).alias("filled_2"))


@C.add(f"""WITH q AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, fiscal_close::date AS qend, release_id FROM earnings_releases WHERE fiscal_close IS NOT NULL), u AS (SELECT symbol, qend, (max(release_id) % 100)::double AS v FROM q GROUP BY 1, 2)
SELECT symbol, qend, CASE WHEN qend - lag(qend, 3) OVER w BETWEEN 250 AND 300 THEN sum(v) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) END AS ttm FROM u WINDOW w AS (PARTITION BY symbol ORDER BY qend)""")
def wn10_four_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over four rows, given only where these are consecutive quarters."""
    w = Window.partitionBy("symbol").orderBy("qend")
    q = table(spark, sf_dir, "earnings_releases").select(canonical(F.col("symbol")).alias("symbol"), F.col("fiscal_close").cast("date").alias("qend"), "release_id").where("qend IS NOT NULL")
    u = q.groupBy("symbol", "qend").agg((F.max("release_id") % 100).cast("double").alias("v"))
    return u.select("symbol", "qend", F.when(F.datediff("qend", F.lag("qend", 3).over(w)).between(250, 300), F.sum("v").over(w.rowsBetween(-3, 0))).alias("ttm"))


@C.add("""WITH t AS (SELECT event_id, user_id, ts, value AS y, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS x FROM events), s AS (SELECT event_id, count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) OVER o AS n, sum(CASE WHEN y IS NOT NULL THEN x END) OVER o AS sx, sum(CASE WHEN x IS NOT NULL THEN y END) OVER o AS sy, sum(x * y) OVER o AS sxy,
sum(CASE WHEN y IS NOT NULL THEN x * x END) OVER o AS sxx FROM t WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)) SELECT event_id, CASE WHEN n >= 6 AND sxx - sx * sx / n <> 0 THEN round((sxy - sx * sy / n) / (sxx - sx * sx / n), 4) + 0.0 END AS beta FROM s""")
def wn12_rolling_beta(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    t = table(spark, sf_dir, "events").withColumn("x", F.lag("value").over(order))
    return t.select("event_id", stats.unsigned(stats.rolling_slope(F.col("value"), F.col("x"), order.rowsBetween(-12, -1), 6), 4).alias("beta"))


@C.add("SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN INTERVAL 365 DAYS PRECEDING AND CURRENT ROW), 2) AS year_total FROM orders")
def wn14_range_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_view")
    return spark.sql("SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN INTERVAL '365' DAY PRECEDING AND CURRENT ROW), 2) AS year_total FROM orders_view")


@C.add(f"""WITH {BARS_SQL}, s AS (SELECT symbol, date AS split_day, stock_splits AS ratio FROM bars WHERE stock_splits > 0 AND stock_splits <> 1), d AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, fiscal_close::date AS known FROM earnings_releases WHERE fiscal_close IS NOT NULL)
SELECT d.symbol, d.known, round(coalesce(product(s.ratio), 1), 6) AS factor FROM d LEFT JOIN s ON d.symbol = s.symbol AND s.split_day > d.known GROUP BY 1, 2""")
def wn15_later_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product of splits strictly after a day."""
    s = bars(spark, sf_dir, "stock_splits").where("stock_splits > 0 AND stock_splits != 1").select("symbol", F.col("date").alias("split_day"), F.col("stock_splits").alias("ratio"))
    d = table(spark, sf_dir, "earnings_releases").select(canonical(F.col("symbol")).alias("symbol"), F.col("fiscal_close").cast("date").alias("known")).where("known IS NOT NULL AND symbol IS NOT NULL").distinct()
    joined = d.join(s.withColumnRenamed("symbol", "_s"), (F.col("symbol") == F.col("_s")) & (F.col("split_day") > F.col("known")), "left")
    return joined.groupBy("symbol", "known").agg(F.round(F.coalesce(F.product("ratio"), F.lit(1.0)), 6).alias("factor"))


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, CASE WHEN volume > 3 * m OR volume * 3 < m THEN NULL ELSE volume END AS volume FROM (SELECT symbol, date, volume, median(volume) OVER (PARTITION BY symbol) AS m FROM bars)")
def wn16_against_group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = bars(spark, sf_dir, "volume")
    b = v.join(stats.exact_quantiles(v, ["symbol"], "volume", [0.5]).select("symbol", F.col("q")[0].alias("m")), "symbol", "left")
    far = (F.col("volume") > 3 * F.col("m")) | (F.col("volume") * 3 < F.col("m"))
    return b.select("symbol", "date", F.when(far, None).otherwise(F.col("volume")).alias("volume"))


@C.add("""WITH o AS (SELECT *, date_trunc('month', o_orderdate)::date AS mth FROM orders), q AS (SELECT mth, quantile_cont(o_totalprice, 0.025) AS lo, quantile_cont(o_totalprice, 0.975) AS hi, count(o_totalprice) AS n FROM o GROUP BY 1),
c AS (SELECT o.*, greatest(least(o_totalprice, hi), lo) AS c, n FROM o JOIN q USING (mth)), z AS (SELECT o_orderkey, n, c - sum(c * (o_custkey + 1)) OVER (PARTITION BY mth) / sum(o_custkey + 1) OVER (PARTITION BY mth) AS d, stddev_samp(c) OVER (PARTITION BY mth) AS s FROM c)
SELECT o_orderkey, CASE WHEN n >= 3 AND s > 0 THEN round(d / s, 4) + 0.0 END AS z FROM z""")
def wn17_clipped_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("mth", F.trunc("o_orderdate", "MM")).withColumn("w", F.col("o_custkey") + 1)
    return stats.clipped_zscore(o, "mth", "o_totalprice", "w").select("o_orderkey", stats.unsigned(F.col("zscore"), 4).alias("z"))


@C.add(f"WITH {BARS_SQL} SELECT DISTINCT max(date) OVER (PARTITION BY date_trunc('month', date)) AS month_end FROM bars")
def wn24_month_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).groupBy(F.trunc("date", "MM").alias("m")).agg(F.max("date").alias("month_end")).select("month_end")


@C.add(f"""WITH {BARS_SQL}, d AS (SELECT symbol, date, dividends, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM bars WHERE dividends > 0) SELECT symbol, round(median(dividends), 6) AS middle, count(*) AS n FROM d WHERE rn <= 4 GROUP BY 1""")
def wn22_median_of_last_four(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = top_per_key(bars(spark, sf_dir, "dividends").where("dividends > 0"), ["symbol"], [F.desc("date")], 4)
    return last.groupBy("symbol").agg(F.round(F.median("dividends"), 6).alias("middle"), F.count("*").alias("n"))


@C.add(f"""WITH {BARS_SQL} SELECT symbol, count(*) AS off FROM bars WHERE close > 0 AND adj_close > 0 AND abs(adj_close / close - 1) > 0.02 AND abs(adj_close - close) > 0.01 GROUP BY 1 HAVING count(*) >= 3 AND max(ln(adj_close / close)) - min(ln(adj_close / close)) < 0.005""")
def wn23_rescaled_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose two series differ by one constant factor."""
    ratio = F.log(F.col("adj_close") / F.col("close"))
    off = bars(spark, sf_dir, "close", "adj_close").where("close > 0 AND adj_close > 0").where((F.abs(F.col("adj_close") / F.col("close") - 1) > 0.02) & (F.abs(F.col("adj_close") - F.col("close")) > 0.01))
    g = off.groupBy("symbol").agg(F.count("*").alias("off"), (F.max(ratio) - F.min(ratio)).alias("width"))
    return g.where("off >= 3 AND width < 0.005").select("symbol", "off")


@C.add(f"WITH {MEMBERS_SQL} SELECT symbol, index_name, start_date, end_date FROM members ORDER BY end_date NULLS LAST, symbol, index_name, start_date")
def so01_total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls last in an ascending order, sorted over range partitions."""
    order = [F.asc_nulls_last("end_date"), "symbol", "index_name", "start_date"]
    return members(spark, sf_dir).select("symbol", "index_name", "start_date", "end_date").orderBy(*order)


@C.add("SELECT c_mktsegment, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) <= 3")
def so03_top_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_per_key(table(spark, sf_dir, "customer"), ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 3).select("c_mktsegment", "c_custkey", "c_acctbal")


@C.add("""SELECT o_custkey, o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END, o_orderkey) = 1""")
def so05_priority_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(3)
    return top_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], [place, F.asc("o_orderkey")]).select("o_custkey", "o_orderpriority", "o_orderkey")


@C.add("SELECT r_name AS name, r_regionkey, NULL::int AS n_nationkey FROM region UNION ALL SELECT n_name, n_regionkey, n_nationkey FROM nation")
def st02_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), "r_regionkey")
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("r_regionkey"), "n_nationkey")
    return r.unionByName(n, allowMissingColumns=True)


@C.add("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def st03_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").cast("bigint").alias("k")))


@C.add("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def st03_set_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).intersect(table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").cast("bigint").alias("k")))


@C.add("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def sql_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arbitrary SQL passes through to the engine."""
    lineitem(spark, sf_dir).createOrReplaceTempView("lineitem_view")
    return spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem_view GROUP BY CUBE (l_returnflag, l_linestatus)")
