"""Queries over landed payloads and streams."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.symbols import canonical
from tidemark.operators import orderbook
from tidemark.plans.registry import SYMBOL_SQL, Catalogue
from tidemark.sources import parsers
from tidemark.sources.lake import Lake
from tidemark.streaming import streams
from tidemark.session import shared_dir, table

C = Catalogue()


@C.add("SELECT r_regionkey, r_name, NULL::varchar AS r_comment FROM region")
def sc01_lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset of several files read by declared schema (SC01, SC02, SC03, SC07); a column that no file has is null."""
    root = shared_dir(spark, "lake")
    r = table(spark, sf_dir, "region")
    r.where("r_regionkey < 2").write.parquet(f"{root}/region/a")
    r.where("r_regionkey >= 2").select("r_name", "r_regionkey").write.parquet(f"{root}/region/b")
    lake = Lake(spark, root, {"region": "r_regionkey int, r_name string, r_comment string", "nowhere": "x int"})
    return lake.sql("SELECT region.r_regionkey, r_name, r_comment FROM region LEFT JOIN nowhere ON x = r_regionkey")


@C.add(f"SELECT {SYMBOL_SQL} AS symbol, date, total_volume, market FROM short_volume_files WHERE symbol IS NOT NULL")
def sc09_pipe_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as pipe-delimited lines with a header and a footer, and parsed back."""
    s = table(spark, sf_dir, "short_volume_files").where("symbol IS NOT NULL").select(canonical(F.col("symbol")).alias("symbol"), "date", "total_volume", "market")
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    lines = s.select(F.concat_ws("|", *[cell(c) for c in s.columns]).alias("line"))
    noise = spark.createDataFrame([("symbol|date|total_volume|market",), ("12345",), ("",)], "line string")
    return parsers.delimited(lines.unionAll(noise), "line", {"symbol": "string", "date": "date", "total_volume": "double", "market": "string"})


@C.add("SELECT p_partkey, p_name, nullif(p_brand, 'Brand#11') AS market FROM part")
def sc10_listing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings written as pipe-delimited lines with a header and a trailer, and parsed back."""
    lines = table(spark, sf_dir, "part").select(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", F.when(F.col("p_brand") == "Brand#11", " ").otherwise(F.col("p_brand"))).alias("line"))
    noise = spark.createDataFrame([("p_partkey|Security Name|Market",), ("File Creation Time: 0102202418:01||",)], "line string")
    return parsers.delimited(lines.unionAll(noise), "line", {"p_partkey": "bigint", "p_name": "string", "market": "string"}, skip="^File Creation Time")


@C.add("""WITH d AS (SELECT o_orderdate::date AS date, count(*) AS n, min(o_orderkey) AS k FROM orders GROUP BY 1)
SELECT date, 'Mkt-RF' AS factor, n / 4.0::double AS value FROM d WHERE n % 3 <> 0 UNION ALL SELECT date, 'SMB', -n::double FROM d WHERE n < 99 UNION ALL SELECT date, 'RF', k::double FROM d""")
def sc11_prose_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that begin with a day among prose, wide to long, without the marks of missing values."""
    d = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("k"))
    market = F.when(F.col("n") % 3 == 0, "-99.99").otherwise(F.format_string("%.2f", F.col("n") / 4.0))
    lines = d.select(F.concat(F.date_format("d", "yyyyMMdd"), F.lit(", "), market, F.lit(",-"), F.col("n").cast("string"), F.lit(",  "), F.col("k").cast("string")).alias("line"))
    prose = spark.createDataFrame([("Created by someone, with notes",), (",Mkt-RF,SMB,RF",), ("",), ("Copyright 2024",)], "line string")
    return parsers.dated_csv_long(lines.unionAll(prose), "line", ["Mkt-RF", "SMB", "RF"])


@C.add("""SELECT date '2024-01-01' + n_nationkey AS date, '1M' AS tenor, n_regionkey + 0.5::double AS value FROM nation WHERE n_nationkey % 4 <> 0
UNION ALL SELECT date '2024-01-01' + n_nationkey, '10Y', n_nationkey / 8.0::double FROM nation""")
def sc12_xml_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed for each region with a property block for each nation; empty values give no row."""
    n = table(spark, sf_dir, "nation")
    tag = lambda name, value: F.concat(F.lit(f"<d:{name} m:type='x'>"), value, F.lit(f"</d:{name}>"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_nationkey")), "yyyy-MM-dd'T'00:00:00")
    month = F.when(F.col("n_nationkey") % 4 == 0, "").otherwise((F.col("n_regionkey") + 0.5).cast("string"))
    block = F.concat(F.lit("<m:properties>"), tag("NEW_DATE", day), tag("BC_1MONTH", month), tag("BC_10YEAR", (F.col("n_nationkey") / 8.0).cast("string")), F.lit("</m:properties>"))
    feeds = n.groupBy("n_regionkey").agg(F.concat(F.lit("<feed>"), F.array_join(F.collect_list(block), "\n"), F.lit("</feed>")).alias("x"))
    return parsers.property_blocks(feeds, "x", "properties", "NEW_DATE", {"BC_1MONTH": "1M", "BC_10YEAR": "10Y"})


@C.add("""SELECT c_custkey, c_mktsegment || CASE WHEN c_custkey % 5 = 0 THEN ' - MINI' ELSE '' END AS market, CASE WHEN c_custkey % 3 <> 0 THEN 'X' || c_nationkey END AS exchange, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey - 12 END AS net
FROM customer WHERE NOT (c_custkey % 3 = 0 AND c_custkey % 5 = 0)""")
def sc13_market_and_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of market and exchange split at the last dash, and long less short (null where one is)."""
    c = table(spark, sf_dir, "customer").where("NOT (c_custkey % 3 = 0 AND c_custkey % 5 = 0)")
    name = F.concat("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, " - MINI").otherwise(""), F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit(" - X"), F.col("c_nationkey").cast("string"))).otherwise(""))
    rows = c.select("c_custkey", parsers.market_and_exchange(name).alias("m"), (F.col("c_nationkey") - F.when(F.col("c_custkey") % 7 != 0, 12)).alias("net"))
    return rows.select("c_custkey", "m.market", "m.exchange", "net")


@C.add("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN l_discount END AS l_discount, CASE WHEN l_tax > 0 THEN l_tax END AS l_tax FROM lineitem")
def sc14_positive_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsers.positive_or_null(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax"), ["l_discount", "l_tax"])


@C.add("SELECT o_custkey AS cik, 'us' AS taxonomy, o_orderstatus AS concept, 'USD' AS unit, o_totalprice AS value, o_orderdate::date AS end_date FROM orders")
def sc16_nested_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders packed into nested facts per customer and flattened again."""
    o = table(spark, sf_dir, "orders")
    entry = F.struct(F.lit(None).cast("string").alias("start"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("end"), F.col("o_totalprice").alias("val"))
    units = o.groupBy("o_custkey", "o_orderstatus").agg(F.collect_list(entry).alias("entries"))
    concepts = units.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", F.struct(F.create_map(F.lit("USD"), F.col("entries")).alias("units"))))).alias("concepts"))
    payload = concepts.select(F.to_json(F.struct(F.col("o_custkey").alias("cik"), F.create_map(F.lit("us"), F.col("concepts")).alias("facts"))).alias("payload"))
    return parsers.company_facts(payload, "payload").select("cik", "taxonomy", "concept", "unit", "value", "end_date")


@C.add("SELECT c_name AS form, c_custkey::varchar AS accession FROM customer")
def sc17_zipped_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.collect_list(F.struct("c_name", "c_custkey")).alias("r"))
    payload = packed.select(F.to_json(F.struct(F.col("r.c_name").alias("form"), F.col("r.c_custkey").cast("array<string>").alias("accession"))).alias("payload"))
    return parsers.zipped_arrays(payload, "payload", ["form", "accession"])


@C.add("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def sc18_index_of_tracked_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index lines of wanted kinds whose key is tracked."""
    c = table(spark, sf_dir, "customer")
    lines = c.select(F.concat_ws("|", "c_mktsegment", "c_name", F.col("c_custkey").cast("string"), F.lit("x"), F.lit("y")).alias("line"))
    index = parsers.delimited(lines, "line", {"kind": "string", "c_name": "string", "c_custkey": "bigint", "a": "string", "b": "string"})
    tracked = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("bigint").alias("c_custkey"))
    return index.where(F.col("kind").isin("BUILDING", "MACHINERY")).join(tracked, "c_custkey", "left_semi").select("c_custkey", "c_name")


@C.add("SELECT o_custkey AS event_id, o_orderkey::varchar AS id, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 100 / 128.0::double END AS bid FROM orders WHERE o_orderstatus <> 'F'")
def sc20_nested_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their markets as nested JSON; closed markets are dropped."""
    market = F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderstatus") == "F", "settled").when(F.col("o_orderstatus") == "O", "open").alias("status"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey") % 100 / 128.0).alias("bid")
    )
    events = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(market).alias("markets"))
    payload = events.select(F.to_json(F.array(F.struct(F.col("o_custkey").cast("string").alias("event"), F.lit("T").alias("title"), "markets"))).alias("p"))
    return parsers.nested_markets(payload, "p").select(F.col("event_id").cast("bigint").alias("event_id"), "id", "bid")


@C.add("SELECT o_orderdate::date AS date, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey / 4.0::double END AS value FROM orders")
def sc21_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series as JSON observations in which a dot is a missing value."""
    value = F.when(F.col("o_orderkey") % 6 == 0, ".").otherwise(F.format_string("%.2f", F.col("o_orderkey") / 4.0))
    series = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), value.alias("value"))).alias("observations"))
    return parsers.observations(series.select(F.to_json(F.struct("observations")).alias("p")), "p")


@C.add("SELECT l_orderkey, l_linenumber, measure, amount FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem) ON l_discount, l_tax INTO NAME measure VALUE amount)")
def sc22_wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return parsers.wide_to_long(wide, ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"], "measure", "amount").where("amount IS NOT NULL")


@C.add("SELECT l_orderkey, CASE l_linestatus WHEN 'O' THEN 'call' ELSE 'put' END AS option_type, date_diff('day', date '1992-01-01', l_shipdate::date) AS dte FROM lineitem")
def sc24_both_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    side = lambda s: l.where(F.col("l_linestatus") == s).select("l_orderkey", F.col("l_shipdate").cast("date").alias("expiration"))
    return parsers.both_sides(side("O"), side("F"), F.lit("1992-01-01").cast("date"), "expiration").select("l_orderkey", "option_type", F.col("dte").cast("bigint").alias("dte"))


@C.add("SELECT c_custkey, nullif(c_acctbal, 0) AS target FROM customer WHERE coalesce(nullif(c_acctbal, 0)::varchar, c_mktsegment) IS NOT NULL")
def sc25_zero_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.nullif("c_acctbal", F.lit(0.0))
    return table(spark, sf_dir, "customer").where(F.coalesce(target.cast("string"), F.col("c_mktsegment")).isNotNull()).select("c_custkey", target.alias("target"))


@C.add("""SELECT epoch_us(ts) * 1000 AS ts, 'U' || user_id AS symbol, CASE event_type WHEN 'click' THEN 'buy' WHEN 'view' THEN 'sell' ELSE 'trade' END AS side, event_id / 10000.0::double AS price, event_id % 1000 AS size
FROM events WHERE event_type <> 'error'""")
def sc26_binary_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary depth segments, a message for each event, written and decoded; unknown message types are skipped."""
    e = table(spark, sf_dir, "events").select((F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("ts"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"), "event_type", "event_id")
    return orderbook.decode_segments(e.mapInArrow(_segments, "payload binary"))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of 50 messages; every other one has a message of another length in it."""
    kinds = {"click": orderbook.BUY, "view": orderbook.SELL, "error": 0x53}
    for batch in batches:
        bodies = [orderbook.LEVEL_MESSAGE.pack(kinds.get(r["event_type"], orderbook.TRADE), 0, r["ts"], r["symbol"].ljust(8).encode(), r["event_id"] % 1000, r["event_id"]) for r in batch.to_pylist()]
        blocks = [len(b).to_bytes(2, "little") + b for b in bodies]
        odd = (9).to_bytes(2, "little") + b"\x53" + bytes(8)
        yield pa.RecordBatch.from_pydict({"payload": [bytes(orderbook.SEGMENT_HEADER) + b"".join(blocks[i : i + 50]) + odd * (i // 50 % 2) for i in range(0, len(blocks), 50)]})


@C.add("SELECT n_name AS name, n_nationkey::varchar AS key FROM nation")
def sc27_html_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a table in a page, chosen by its size."""
    rows = table(spark, sf_dir, "nation").select(F.concat(F.lit("<tr><td><b>"), "n_name", F.lit("</b></td><td>"), F.col("n_nationkey").cast("string"), F.lit("</td></tr>")).alias("r"))
    page = rows.agg(F.concat(F.lit("<table><tr><td>small</td></tr></table><table>"), F.array_join(F.collect_list("r"), ""), F.lit("</table>")).alias("html"))
    return parsers.html_rows(page, "html", 10).select(F.col("cells")[0].alias("name"), F.col("cells")[1].alias("key"))


@C.add("SELECT DISTINCT c_nationkey, c_mktsegment AS segment FROM customer")
def sc28_packed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_join(F.collect_list("c_mktsegment"), " , ").alias("packed"))
    return parsers.packed_list(packed, ["c_nationkey"], "packed", "segment")


@C.add("SELECT DISTINCT (min(ts) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York')::date AS release_date FROM events GROUP BY user_id")
def sc30_first_close_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return parsers.release_days(e, "user_id", "at")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").withColumn("at", F.col("ts").cast("timestamp"))


@C.add("SELECT time_bucket(interval 1 hour, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows of a stream, run to the end of what is there (own addition)."""
    out = streams.run_to_end(streams.windowed_totals(event_stream(spark, sf_dir), "at", ["event_type"], "value"), "complete")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@C.add("SELECT event_id, user_id FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream joined with itself twice over and deduplicated within the watermark (own addition)."""
    s = event_stream(spark, sf_dir)
    return streams.run_to_end(streams.deduplicated(s.unionByName(s), "at", ["event_id"]).select("event_id", "user_id"))


@C.add("SELECT e.event_id, o_orderkey FROM events e JOIN orders ON o_custkey = e.user_id AND o_orderstatus = 'O'")
def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream rows with the intervals of a static table that cover their day (own addition)."""
    open_ = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    intervals = open_.select(F.col("o_custkey").cast("bigint").alias("user_id"), "o_orderkey", F.col("o_orderdate").cast("date").alias("start_date"), F.lit("9999-12-31").cast("date").alias("end_eff"))
    s = event_stream(spark, sf_dir).withColumn("day", F.to_date("at"))
    return streams.run_to_end(streams.with_known_interval(s, "day", "user_id", intervals).select("event_id", "o_orderkey"))


def book_messages(df: DataFrame) -> DataFrame:
    """Level updates and trades made from events; six symbols."""
    side = F.when(F.col("event_type") == "click", "buy").when(F.col("event_type") == "view", "sell").otherwise("trade")
    price = F.when(side == "sell", 101 + F.floor(F.col("value") / 20)).otherwise(100 - F.floor(F.col("value") / 20)).cast("double")
    return df.where("value IS NOT NULL").select(
        F.to_date("at").alias("session"), (F.unix_micros("at") * 1000).alias("ts"), F.col("event_id").alias("seq"), F.concat(F.lit("S"), (F.col("user_id") % 6).cast("string")).alias("symbol"),
        side.alias("side"), price.alias("price"), (F.col("event_id") % 50).cast("bigint").alias("size"),
    )


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderbook.minute_snapshots(book_messages(table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))))


# Every level's size after each minute and after each update, by the last message at it.
_BOOK_SQL = """m AS (SELECT ts::date AS session, epoch_us(ts) * 1000 AS ts, event_id AS seq, 'S' || (user_id % 6) AS symbol, CASE event_type WHEN 'click' THEN 'buy' WHEN 'view' THEN 'sell' ELSE 'trade' END AS side,
CASE WHEN event_type = 'view' THEN 101 + floor(value / 20) ELSE 100 - floor(value / 20) END AS price, event_id % 50 AS size FROM events WHERE value IS NOT NULL),
n AS (SELECT *, row_number() OVER (ORDER BY session, symbol, ts, seq) AS pos, ts // 60000000000 AS minute FROM m), lv AS (SELECT DISTINCT session, symbol, side, price FROM n WHERE side <> 'trade'),
bk AS (SELECT session, symbol, side, price, pos, size FROM n WHERE side <> 'trade')"""
_ENDS_SQL = """mins AS (SELECT DISTINCT session, minute FROM n), first AS (SELECT session, symbol, min(minute) AS lo FROM n GROUP BY 1, 2),
ends AS (SELECT f.session, f.symbol, i.minute, (SELECT max(pos) FROM n x WHERE x.session = f.session AND x.symbol = f.symbol AND x.minute <= i.minute) AS pos FROM first f JOIN mins i ON i.session = f.session AND i.minute >= f.lo),
st AS (SELECT e.session, e.symbol, e.minute, l.side, l.price, b.size FROM ends e JOIN lv l USING (session, symbol) ASOF JOIN bk b ON b.session = e.session AND b.symbol = e.symbol AND b.side = l.side AND b.price = l.price AND b.pos <= e.pos WHERE b.size > 0),
rk AS (SELECT *, row_number() OVER (PARTITION BY session, symbol, minute, side ORDER BY CASE side WHEN 'buy' THEN -price ELSE price END) AS k FROM st),
top AS (SELECT session, symbol, minute, max(price) FILTER (WHERE side = 'buy') AS best_bid, min(price) FILTER (WHERE side = 'sell') AS best_ask, coalesce(sum(size) FILTER (WHERE side = 'buy' AND k <= 5), 0) AS bid_depth,
coalesce(sum(size) FILTER (WHERE side = 'sell' AND k <= 5), 0) AS ask_depth, max(price) FILTER (WHERE side = 'buy' AND k = 2) AS bid_px_2, max(size) FILTER (WHERE side = 'sell' AND k = 1) AS ask_sz_1 FROM rk GROUP BY 1, 2, 3)"""


@C.add(f"""WITH {_BOOK_SQL}, {_ENDS_SQL}, c AS (SELECT session, symbol, minute, count(*) FILTER (WHERE side <> 'trade') AS u, count(*) FILTER (WHERE side = 'trade') AS t, coalesce(sum(size) FILTER (WHERE side = 'trade'), 0) AS v,
coalesce(sum(size * price) FILTER (WHERE side = 'trade'), 0) AS p FROM n GROUP BY 1, 2, 3) SELECT symbol, minute, best_bid, best_ask, bid_depth, ask_depth, bid_px_2, ask_sz_1, coalesce(u, 0) AS n_updates, coalesce(t, 0) AS n_trades,
coalesce(v, 0)::bigint AS trade_volume, coalesce(p, 0) AS trade_notional FROM top LEFT JOIN c USING (session, symbol, minute)""")
def ss01_book_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute snapshots of order books rebuilt per symbol and day, with levels and trades (SS01, SS03, SS04, HX05)."""
    return _snapshots(spark, sf_dir).select("symbol", "minute", "best_bid", "best_ask", "bid_depth", "ask_depth", "bid_px_2", "ask_sz_1", "n_updates", "n_trades", "trade_volume", "trade_notional")


@C.add(f"""WITH {_BOOK_SQL}, ups AS (SELECT session, symbol, minute, pos, ts FROM n WHERE side <> 'trade'), st AS (SELECT e.*, l.side, l.price, b.size FROM ups e JOIN lv l USING (session, symbol)
ASOF JOIN bk b ON b.session = e.session AND b.symbol = e.symbol AND b.side = l.side AND b.price = l.price AND b.pos <= e.pos WHERE b.size > 0),
tp AS (SELECT session, symbol, minute, pos, any_value(ts) AS ts, max(price) FILTER (WHERE side = 'buy') AS bid, min(price) FILTER (WHERE side = 'sell') AS ask, arg_max(size, price) FILTER (WHERE side = 'buy') AS b, arg_min(size, price) FILTER (WHERE side = 'sell') AS a FROM st GROUP BY 1, 2, 3, 4),
nx AS (SELECT session, symbol, minute, pos, lead(ts) OVER (PARTITION BY session, symbol, minute ORDER BY pos) - ts AS dt FROM ups),
w AS (SELECT session, symbol, minute, sum(dt) AS q, sum((ask - bid) * dt) AS s, sum((ask + bid) / 2 * dt) AS m, sum((b - a) / (b + a)::double * dt) AS i FROM tp JOIN nx USING (session, symbol, minute, pos) WHERE bid < ask AND dt > 0 GROUP BY 1, 2, 3)
SELECT symbol, minute, round(q / 1e9, 6) AS quoted_seconds, round(s / q, 6) AS twa_spread, round(m / q, 6) AS twa_mid, round(i / q, 6) AS twa_imbalance FROM w""")
def ss02_time_weighted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-weighted spread, middle and imbalance of the minutes that had a two-sided book between updates (HX06)."""
    s = _snapshots(spark, sf_dir).where("quoted_seconds > 0")
    return s.select("symbol", "minute", *[F.round(c, 6).alias(c) for c in ("quoted_seconds", "twa_spread", "twa_mid", "twa_imbalance")])


@C.add(f"""WITH {_BOOK_SQL}, {_ENDS_SQL}, l AS (SELECT symbol, minute, best_bid, best_ask, to_timestamp(minute * 60) AT TIME ZONE 'America/New_York' AS t FROM top)
SELECT symbol, minute, best_bid, best_ask FROM l WHERE hour(t) * 60 + minute(t) BETWEEN 570 AND 959""")
def ss05_market_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of the regular session; the books know what came before."""
    return orderbook.in_market_hours(_snapshots(spark, sf_dir)).select("symbol", "minute", "best_bid", "best_ask")


@C.add("SELECT ts::date AS session, ts::date <= date '2024-01-10' AS skipped FROM events WHERE value IS NOT NULL GROUP BY 1, 2")
def ss06_replayed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions replayed to files in two runs: the second skips those of the first."""
    path = shared_dir(spark, "replay")
    messages = book_messages(table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp")))
    orderbook.replay(messages.where("session <= date'2024-01-10'"), path)
    return orderbook.replay(messages, path)


@C.add()
def ss01_streamed_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream with state per session; the rows are those of the batch form."""
    return streams.books_to_end(book_messages(event_stream(spark, sf_dir)))
