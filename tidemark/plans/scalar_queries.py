"""Scalar functions of the reference inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import contracts
from tidemark.functions import dates, options, text
from tidemark.functions.symbols import canonical
from tidemark.plans.pit_queries import bars
from tidemark.plans.registry import BARS_SQL, SYMBOL_SQL, Catalogue
from tidemark.session import table

C = Catalogue()


@C.add(f"SELECT DISTINCT symbol AS raw, {SYMBOL_SQL} AS canonical, replace(upper(trim(symbol, ' ')), '.', '-') AS vendor FROM ohlcv")
def fn01_symbol_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("symbol")
    return table(spark, sf_dir, "ohlcv").select("symbol").distinct().select(s.alias("raw"), canonical(s).alias("canonical"), text.vendor_symbol(s).alias("vendor"))


@C.add(r"SELECT file_path, regexp_replace(file_path, '[^A-Za-z0-9._-]', '_', 'g') AS safe FROM short_volume_files GROUP BY 1")
def fn02_safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "short_volume_files").select("file_path").distinct().select("file_path", text.safe_name(F.col("file_path")).alias("safe"))


@C.add("SELECT r_name, CASE WHEN starts_with(r_name, '^') THEN r_name ELSE '^' || r_name END AS index_name FROM region")
def fn03_index_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select("r_name", text.index_symbol(F.col("r_name")).alias("index_name"))


#: ``company_stem`` in SQL.
STEM_SQL = r"regexp_replace(regexp_replace(upper(regexp_replace({0}, '^\s+|\s+$', '', 'g')), '" + text.ending_pattern() + r"', ''), '^[ ,.&-]+|[ ,.&-]+$', '', 'g')"


@C.add(f"SELECT DISTINCT company_name, {STEM_SQL.format('company_name')} AS stem FROM membership WHERE company_name IS NOT NULL")
def fn05_company_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "membership").select("company_name").where("company_name IS NOT NULL").distinct()
    return names.select("company_name", text.company_stem(F.col("company_name")).alias("stem"))


@C.add("""SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'touch_above' WHEN 1 THEN 'touch_below' WHEN 2 THEN 'between' WHEN 3 THEN 'less' WHEN 4 THEN 'greater' WHEN 5 THEN 'greater' WHEN 6 THEN 'less' ELSE 'custom' END AS kind,
CASE p_partkey % 8 WHEN 0 THEN p_size WHEN 1 THEN p_size WHEN 2 THEN p_size WHEN 4 THEN p_size * 1000000.0 WHEN 5 THEN 1000.0 + p_size * 1000 END::double AS floor, CASE p_partkey % 8 WHEN 2 THEN p_size + 20 WHEN 3 THEN p_size * 1000 WHEN 6 THEN p_size END::double AS cap FROM part""")
def fn06_strike_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of strikes made of part sizes, of every form."""
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 8
    forms = [F.concat(F.lit("↑ $"), n), F.concat(F.lit("↓ $"), n), F.concat(F.lit("$"), n, F.lit("-$"), (F.col("p_size") + 20).cast("string")), F.concat(F.lit("<$"), n, F.lit("k")), F.concat(F.lit("above "), n, F.lit("m")),
             F.concat((F.col("p_size") + 1).cast("string"), F.lit("k+")), F.concat(F.lit("less than "), n), F.col("p_name")]
    label = F.coalesce(*[F.when(k == i, f) for i, f in enumerate(forms)])
    return table(spark, sf_dir, "part").select("p_partkey", text.parse_strike(label).alias("s")).select("p_partkey", "s.kind", "s.floor", "s.cap")


@C.add("SELECT l_orderkey, l_linenumber, CASE WHEN l_tax - l_discount BETWEEN 0 AND 0.15 THEN round((l_tax + l_discount) / 2, 6) ELSE l_extendedprice END AS mid FROM lineitem")
def fn07_gated_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = F.col("l_tax") - F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(gap.between(0, 0.15), F.round((F.col("l_tax") + F.col("l_discount")) / 2, 6)).otherwise(F.col("l_extendedprice")).alias("mid"))


@C.add(r"SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)\b(cut|lower|ease)') THEN 'cut' WHEN regexp_matches(text, '(?i)\b(hike|raise|lift)') THEN 'hike' ELSE 'hold' END AS side, nullif(regexp_extract(text, '\(([A-Z]{1,5})\)', 1), '') AS underlying FROM documents WHERE text IS NOT NULL")
def fn08_sides_and_underlyings(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    side = F.when(t.rlike(r"(?i)\b(cut|lower|ease)"), "cut").when(t.rlike(r"(?i)\b(hike|raise|lift)"), "hike").otherwise("hold")
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", side.alias("side"), F.nullif(F.regexp_extract(t, r"\(([A-Z]{1,5})\)", 1), F.lit("")).alias("underlying"))


_PAGE = "'<html><head><style>p {x}</style></head><p>part ' || p_partkey || '</p><div style=\"color: red; display: none\"><div>secret</div> more</div><b>' || p_name || '</b> &amp; <ix:header><p>facts</p></ix:header>' || p_brand || '<br/>end</html>'"


@C.add(f"SELECT p_partkey, 'part ' || p_partkey || chr(10) || p_name || chr(10) || '&' || chr(10) || p_brand || chr(10) || 'end' AS plain FROM part")
def fn10_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of pages made from part rows, with nested hidden parts."""
    return table(spark, sf_dir, "part").select("p_partkey", text.plain_text(F.expr(_PAGE)).alias("plain"))


@C.add()
def fn10_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every document, without SQL: DuckDB has no such rules."""
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", text.plain_text(F.col("text")).alias("plain"))


@C.add("""SELECT DISTINCT cik, lpad(regexp_replace(cik, '\\D', '', 'g'), 10, '0') AS padded, nullif(ltrim(regexp_replace(cik, '\\D', '', 'g'), '0'), '') AS bare FROM membership WHERE cik IS NOT NULL""")
def fn11_ciks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("cik")
    return table(spark, sf_dir, "membership").where("cik IS NOT NULL").select(c, text.padded_cik(c).alias("padded"), F.nullif(F.ltrim(F.regexp_replace(c, r"\D", ""), F.lit("0")), F.lit("")).alias("bare")).distinct()


@C.add("SELECT release_id, substr(d, 1, 10) || '-' || substr(d, 11, 2) || '-' || substr(d, 13, 6) AS accession FROM (SELECT DISTINCT release_id, lpad(regexp_replace(accession_number, '-', '', 'g'), 18, '0') AS d FROM earnings_releases WHERE accession_number IS NOT NULL)")
def fn11_accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.regexp_replace("accession_number", "-", "")
    return table(spark, sf_dir, "earnings_releases").where("accession_number IS NOT NULL").select("release_id", text.accession_with_dashes(digits).alias("accession")).distinct()


@C.add("SELECT doc_id, sha1(concat_ws('|', doc_id::varchar, source)) AS event_id FROM documents")
def fn12_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.event_id(F.col("doc_id").cast("string"), F.col("source")).alias("event_id"))


@C.add("SELECT event_id, greatest(-1, least(1, try_cast(split_part(value::varchar || ',0,1', ',', 1) AS double) / 100.0)) AS sentiment FROM events WHERE value IS NOT NULL")
def fn13_tone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("value IS NOT NULL").select("event_id", text.first_tone(F.concat(F.col("value").cast("string"), F.lit(",0,1"))).alias("sentiment"))


@C.add("SELECT o_orderkey, o_orderkey % 4 IN (0, 3) AS has_202 FROM orders")
def fn14_item_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a comma-separated list has an item, exactly."""
    items = F.element_at(F.array(*map(F.lit, ("2.02,9.01", "12.02", "2.020 , 1.01", "1.01 , 2.02"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.has_item(items, "2.02").alias("has_202"))


@C.add("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 1000.5 + o_orderkey % 1000 WHEN 3 THEN -o_orderkey END::double AS value FROM orders")
def fn15_loose_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with thousands separators, blanks, marks of absence and junk."""
    key = F.col("o_orderkey")
    raw = F.when(key % 5 == 0, F.concat(F.lit("1,"), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(".5"))).when(key % 5 == 1, ".").when(key % 5 == 2, "N/A").when(key % 5 == 3, F.concat(F.lit(" -"), key.cast("string"), F.lit(" "))).otherwise(F.concat(F.lit("x"), key.cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.loose_number(raw).alias("value"))


@C.add("SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 2) THEN o_orderdate::date END AS value FROM orders")
def fn16_loose_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days spelled with and without a time, a day that does not exist, and null."""
    day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 4
    raw = F.when(k == 0, day).when(k == 1, "2023-02-29").when(k == 2, F.concat(day, F.lit("T10:00:00Z")))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.loose_date(raw).alias("value"))


@C.add("SELECT event_id, floor(epoch(ts))::bigint AS seconds, date_trunc('second', ts) AS stamp FROM events")
def fn17_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as 14 digits and read again, and as epoch seconds."""
    e = table(spark, sf_dir, "events").withColumn("utc", F.col("ts").cast("timestamp"))
    return e.select("event_id", F.unix_seconds("utc").alias("seconds"), text.stamp(F.date_format("utc", "yyyyMMddHHmmss")).cast("timestamp_ntz").alias("stamp"))


@C.add("SELECT event_id, (ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York')::date AS session_day, hour(l) * 100 + minute(l) AS clock, hour(l) * 60 + minute(l) BETWEEN 570 AND 959 AS in_session FROM (SELECT *, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS l FROM events)")
def fn18_market_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = dates.market_time(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", F.to_date(local).alias("session_day"), (F.hour(local) * 100 + F.minute(local)).cast("bigint").alias("clock"), dates.in_session(F.col("ts").cast("timestamp")).alias("in_session"))


#: Holidays of the New York exchange from 2000 to 2030 by rule, in SQL (Easter by Meeus' algorithm).
HOLIDAYS_SQL = """y AS (SELECT unnest(range(2000, 2031))::int AS y), g AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM y), h AS (SELECT *, (19 * a + b - b // 4 - ((b - (b + 8) // 25 + 1) // 3) + 15) % 30 AS h FROM g),
l AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM h), e AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM l),
nth AS (SELECT y, m, w, k FROM y, (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (11, 4, 4)) t(m, w, k)), f AS (SELECT y, make_date(y, m, 1) AS d, w, k FROM nth),
fixed AS (SELECT y, make_date(y, m, d) AS d, m FROM y, (VALUES (1, 1), (7, 4), (12, 25), (6, 19)) t(m, d) WHERE m <> 6 OR y >= 2022),
holidays AS (SELECT make_date(y, (n // 31)::int, (n % 31 + 1)::int) - 2 AS day FROM e UNION SELECT d + ((w - isodow(d) + 7) % 7)::int + 7 * (k - 1) FROM f UNION SELECT make_date(y, 5, 31) - (isodow(make_date(y, 5, 31)) - 1)::int FROM y
UNION SELECT CASE isodow(d) WHEN 7 THEN d + 1 WHEN 6 THEN d - 1 ELSE d END FROM fixed WHERE NOT (m = 1 AND isodow(d) = 6))"""


@C.add(f"WITH {HOLIDAYS_SQL} SELECT DISTINCT day FROM holidays")
def fn19_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.holiday_table(spark, 2000, 2030).select("day")


@C.add(f"WITH {HOLIDAYS_SQL}, d AS (SELECT unnest(generate_series(timestamp '2000-01-01', timestamp '2030-12-31', interval 1 day))::date AS day) SELECT date_trunc('month', day)::date AS mth, count(*) AS sessions, max(day) AS last FROM d WHERE isodow(day) < 6 AND day NOT IN (SELECT day FROM holidays) GROUP BY 1")
def fn19_trading_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each month and the last one, over 31 years."""
    return dates.trading_days(spark, "2000-01-01", "2030-12-31").groupBy(F.trunc("day", "MM").alias("mth")).agg(F.count("*").alias("sessions"), F.max("day").alias("last"))


# Third Fridays, and days thirty before one, that were no sessions; all others from 2015 to 2026 were.
@C.add("""WITH m AS (SELECT unnest(generate_series(timestamp '2015-01-01', timestamp '2026-12-01', interval 1 month))::date AS month),
f AS (SELECT month, n + ((5 - isodow(n) + 7) % 7)::int + 14 AS friday FROM (SELECT month, (month + interval 1 month)::date AS n FROM m)),
g AS (SELECT month, CASE WHEN friday IN (date '2019-04-19', date '2022-04-15', date '2025-04-18', date '2026-06-19') THEN friday - 1 ELSE friday END - 30 AS day FROM f)
SELECT month, CASE WHEN day IN (date '2024-06-19') THEN day - 1 ELSE day END AS expires FROM g""")
def fn20_futures_expirations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.futures_expirations(spark, "2015-01-01", "2026-12-01")


@C.add("SELECT o_orderkey, o_orderdate::date AS day, (CASE isodow(d) WHEN 4 THEN d + 4 WHEN 5 THEN d + 4 WHEN 6 THEN d + 3 WHEN 7 THEN d + 2 ELSE d + 2 END)::date AS later FROM (SELECT *, o_orderdate::date AS d FROM orders)")
def fn21_business_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", d.alias("day"), dates.plus_business_days(d, 2).alias("later"))


@C.add("""WITH s AS (SELECT day::date AS session FROM (SELECT unnest(generate_series(timestamp '2023-12-20', timestamp '2024-02-10', interval 1 day)) AS day) WHERE isodow(day) < 6 AND day::date NOT IN (date '2023-12-25', date '2024-01-01', date '2024-01-15')),
e AS (SELECT event_id, l, hour(l) * 100 + minute(l) AS clock FROM (SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS l FROM events)) SELECT event_id, (SELECT min(session) FROM s WHERE session >= CASE WHEN clock < 930 AND clock <> 0 THEN l::date ELSE l::date + 1 END) AS entry FROM e""")
def fn22_entry_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return dates.entry_session(e, "ts", dates.trading_days(spark, "2023-12-20", "2024-02-10"), "day").select("event_id", "entry")


@C.add("""WITH c AS (SELECT s_nationkey / 4.0::double AS m, avg(s_acctbal) / 1e5 AS r FROM supplier GROUP BY 1), x AS (SELECT l_orderkey, l_linenumber, l_quantity / 4 - 1 AS x FROM lineitem),
p AS (SELECT m, r, lead(m) OVER (ORDER BY m) AS m2, lead(r) OVER (ORDER BY m) AS r2 FROM c), e AS (SELECT min(m) AS lo, max(m) AS hi, arg_min(r, m) AS rlo, arg_max(r, m) AS rhi FROM c)
SELECT l_orderkey, l_linenumber, round(CASE WHEN x <= lo THEN rlo WHEN x >= hi THEN rhi ELSE r + (x - m) / (m2 - m) * (r2 - r) END, 8) AS rate FROM x CROSS JOIN e LEFT JOIN p ON x >= m AND x < m2""")
def fn23_interpolated_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates from a curve table (here mean balances by nation), flat beyond its ends."""
    curve = table(spark, sf_dir, "supplier").groupBy((F.col("s_nationkey") / 4.0).alias("m")).agg((F.avg("s_acctbal") / 1e5).alias("r"))
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 4 - 1).alias("x"))  # noqa: E741
    return contracts.with_curve_rate(l, "x", curve, "m", "r", 0.04).select("l_orderkey", "l_linenumber", F.round("rate", 8).alias("rate"))


@C.add()
def fn27_iv_and_greeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Implied volatility and sensitivities of a contract made from each line item."""
    l = table(spark, sf_dir, "lineitem").where("l_quantity > 0")  # noqa: E741
    contracts = l.select(
        "l_orderkey", "l_linenumber", F.lit(100.0).alias("spot"), (80 + F.col("l_quantity") * 0.8).alias("strike"), ((F.col("l_linenumber") * 30) / 365.0).alias("years"),
        F.lit(0.04).alias("rate"), (F.col("l_discount") / 10).alias("dividend_yield"), (2 + F.col("l_tax") * 100).alias("value"), (F.col("l_linestatus") == "O").alias("is_call"),
    )
    return options.with_iv_and_greeks(contracts, "spot", "strike", "years", "rate", "dividend_yield", "value", "is_call")


@C.add("SELECT l_orderkey, l_linenumber, l_extendedprice / (l_quantity * 1000) AS moneyness, round(ln(l_extendedprice / (l_quantity * 1000)), 6) AS log_moneyness, round(greatest(l_extendedprice - l_quantity * 1000, 0), 4) AS intrinsic FROM lineitem WHERE l_quantity > 0")
def fn30_moneyness(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = F.col("l_extendedprice") / (F.col("l_quantity") * 1000)
    return table(spark, sf_dir, "lineitem").where("l_quantity > 0").select("l_orderkey", "l_linenumber", ratio.alias("moneyness"), F.round(F.log(ratio), 6).alias("log_moneyness"), F.round(F.greatest(F.col("l_extendedprice") - F.col("l_quantity") * 1000, F.lit(0.0)), 4).alias("intrinsic"))


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, round((low * volume + high * open) / nullif(volume + open, 0), 4) AS microprice, round((volume - open) / nullif(volume + open, 0), 6) AS imbalance, high - low AS spread FROM bars")
def fn31_quote_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microprice, imbalance and spread of two prices and two sizes (here low, high, volume, open)."""
    size = F.col("volume") + F.col("open")
    b = bars(spark, sf_dir, "low", "high", "open", "volume")
    return b.select("symbol", "date", F.round(F.try_divide(F.col("low") * F.col("volume") + F.col("high") * F.col("open"), size), 4).alias("microprice"), F.round(F.try_divide(F.col("volume") - F.col("open"), size), 6).alias("imbalance"), (F.col("high") - F.col("low")).alias("spread"))


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, round(abs(close - adj_close) / nullif(abs(adj_close), 0), 6) AS off, abs(close - adj_close) / nullif(abs(adj_close), 0) <= 0.02 AS passed, round((high + low + close) / 3 * volume, 2) AS dollars FROM bars")
def fn33_differences_and_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    off = F.try_divide(F.abs(F.col("close") - F.col("adj_close")), F.abs("adj_close"))
    b = bars(spark, sf_dir, "close", "adj_close", "high", "low", "volume")
    return b.select("symbol", "date", F.round(off, 6).alias("off"), (off <= 0.02).alias("passed"), F.round((F.col("high") + F.col("low") + F.col("close")) / 3 * F.col("volume"), 2).alias("dollars"))


@C.add("SELECT event_id, props::json->>'$.k' AS k, date_trunc('month', ts)::date AS mth FROM events")
def fn38_json_and_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.trunc("ts", "MM").alias("mth"))
