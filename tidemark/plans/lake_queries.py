"""Writes, merges, maintenance, bars and derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.symbols import canonical
from tidemark.operators import bars as bar_ops, compaction, quarters, writer
from tidemark.plans.pit_queries import bars, members
from tidemark.plans.registry import BARS_SQL, MEMBERS_SQL, SYMBOL_SQL, Catalogue
from tidemark.session import shared_dir, table
from tidemark.sources.lake import Lake

C = Catalogue()
BAR_SCHEMA = "symbol string, date date, close double, volume bigint"


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, close, volume FROM bars WHERE date BETWEEN date '2020-02-10' AND date '2021-03-20'")
def sc04_month_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars written by month of their own date (SK01, SK07, SK09), read back in a range: other months are not opened."""
    path = shared_dir(spark, "bars")
    b = bars(spark, sf_dir, "close", "volume").select("symbol", "date", "close", "volume")
    writer.write_partitioned(b, path, {"year": F.year("date"), "month": F.month("date")}, ["symbol", "date"])
    return writer.read_months(spark, path, T._parse_datatype_string(BAR_SCHEMA), "date", "2020-02-10", "2021-03-20")


@C.add("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate::date AS day, NULL::double AS missing FROM orders")
def sc02_schema_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns only: extra ones dropped, absent ones as typed nulls."""
    o = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return writer.coerce(o, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "day": "date", "missing": "double"})


@C.add("SELECT column_name, lower(column_type) AS kind, 0::bigint AS n FROM (DESCRIBE SELECT symbol, date, close, volume, ingested_at FROM ohlcv)")
def sc06_empty_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset without files read by its schema: no rows, and each column with its type."""
    names = {"string": "varchar", "timestamp": "timestamp with time zone"}
    schema = T.StructType([f for f in table(spark, sf_dir, "ohlcv").schema.fields if f.name in ("symbol", "date", "close", "volume", "ingested_at")])
    nothing = writer.empty(spark, schema)
    kinds = [(f.name, names.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in nothing.schema.fields]
    rows = nothing.agg(F.count("*").alias("n"))
    return rows.crossJoin(spark.createDataFrame(kinds, "column_name string, kind string")).select("column_name", "kind", "n")  # one row


@C.add("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def sc08_ad_hoc_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT c_mktsegment, count(*) AS n FROM parquet.`{sf_dir}/customer.parquet` GROUP BY 1")


@C.add("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders UNION ALL SELECT o_orderkey + 100000000, 'N', 0.0 FROM orders WHERE o_orderkey % 100 = 0")
def sk02_keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with every tenth revised and some new ones (SK02, SK04): new rows win whole."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    revised = o.where("o_orderkey % 10 = 0").withColumn("o_orderstatus", F.lit("X"))
    fresh = o.where("o_orderkey % 100 = 0").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.lit(0.0).alias("o_totalprice"))
    return writer.merge(o, revised.unionByName(fresh), ["o_orderkey"])


@C.add("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders UNION ALL SELECT o_orderkey + 100000000, 'N', NULL FROM orders WHERE o_orderkey % 100 = 0")
def sk03_absent_is_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A revision without the price column and with a null status: the price stays, the status goes."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    revised = o.where("o_orderkey % 10 = 0").select("o_orderkey", F.lit(None).cast("string").alias("o_orderstatus"))
    fresh = o.where("o_orderkey % 100 = 0").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    return writer.merge(o, revised.unionByName(fresh), ["o_orderkey"])


@C.add(f"WITH {BARS_SQL} SELECT symbol, date, close, ingested_at FROM bars")
def sk04_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "ohlcv").select(canonical(F.col("symbol")).alias("symbol"), "date", "close", "ingested_at").where("symbol IS NOT NULL AND date IS NOT NULL")
    return writer.keep_last(rows, ["symbol", "date"], ["ingested_at"])


@C.add("SELECT event_id, ts::date AS day, try_cast(value::varchar AS bigint) AS whole FROM events WHERE contains(value::varchar, '.') = false UNION ALL SELECT event_id, ts::date, NULL FROM events WHERE contains(value::varchar, '.') OR value IS NULL")
def sk06_best_effort_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("day"), F.col("value").cast("string").alias("whole"))
    text = e.withColumn("whole", F.when(~F.contains("whole", F.lit(".")), F.col("whole")))
    return writer.coerce(text, {"event_id": "bigint", "day": "date", "whole": "bigint"})


@C.add(f"""WITH b AS (SELECT {SYMBOL_SQL} AS symbol, date, close, high, low, volume FROM ohlcv), k AS (SELECT count(*) AS n FROM b GROUP BY symbol, date)
SELECT 'null symbol' AS rule, count(*) FILTER (WHERE symbol IS NULL) AS breaches FROM b UNION ALL SELECT 'null date', count(*) FILTER (WHERE date IS NULL) FROM b UNION ALL SELECT 'not positive close', count(*) FILTER (WHERE close <= 0) FROM b
UNION ALL SELECT 'negative volume', count(*) FILTER (WHERE volume < 0) FROM b UNION ALL SELECT 'high below low', count(*) FILTER (WHERE high < low) FROM b UNION ALL SELECT 'too few rows', CASE WHEN count(*) < 100 THEN 1 ELSE 0 END FROM b
UNION ALL SELECT 'duplicate key', coalesce(sum(n - 1), 0)::bigint FROM k""")
def sk08_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "ohlcv").withColumn("symbol", canonical(F.col("symbol")))
    return writer.validate(b, ["symbol", "date"], ["close"], ["volume"], [("high", "low")], ["symbol", "date"], least_rows=100)


@C.add("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_custkey % 5 = 0)")
def sk13_relabelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows whose identity comes back under another label are dropped; rows not returned stay."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    back = o.where("o_custkey % 5 = 0").select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "2-HIGH").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return writer.relabelled(o, back, ["o_orderkey"], "o_orderpriority")


@C.add("SELECT o_orderkey, o_orderdate::date AS d, o_orderstatus FROM orders WHERE o_orderdate < timestamp '1998-01-01' UNION ALL SELECT o_orderkey, o_orderdate::date, 'R' FROM orders WHERE o_orderdate >= timestamp '1998-01-01'")
def sk14_replaced_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that come in again are replaced whole, the others kept."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderstatus")
    return writer.replace_slice(o, o.where("d >= date'1998-01-01'").withColumn("o_orderstatus", F.lit("R")), ["d"])


@C.add("SELECT c_custkey, c_name, c_acctbal FROM customer")
def sk15_csv_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as CSV (SK15, SK16) and read back with its schema."""
    path = shared_dir(spark, "mirror")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    c.write.option("header", True).csv(path)
    return spark.read.schema(c.schema).option("header", True).csv(path)


@C.add("SELECT l_orderkey, l_linenumber, round(l_tax, 4) AS value_num, l_tax <= 0.05 AS passed, 'tax' AS metric FROM lineitem")
def sk18_quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round("l_tax", 4).alias("value_num"), (F.col("l_tax") <= 0.05).alias("passed"), F.lit("tax").alias("metric"))


@C.add(f"""WITH {MEMBERS_SQL}, live AS (SELECT {SYMBOL_SQL} AS symbol, max(nullif(trim(company_name, ' '), '')) AS company_name FROM live_constituents GROUP BY 1)
SELECT m.symbol, m.index_name, m.start_date, coalesce(live.company_name, m.company_name) AS company_name FROM members m LEFT JOIN live USING (symbol)""")
def hx02_live_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = table(spark, sf_dir, "live_constituents").select(canonical(F.col("symbol")).alias("symbol"), "company_name")
    return writer.overlay(members(spark, sf_dir).select("symbol", "index_name", "start_date", "company_name"), live, "symbol", ["company_name"])


_AMOUNTS = "SELECT user_id, ts::date AS day, row_number() OVER (PARTITION BY user_id, ts::date ORDER BY ts, event_id) AS rn, value FROM events WHERE value IS NOT NULL"


@C.add(f"""WITH RECURSIVE e AS ({_AMOUNTS}), r AS (SELECT user_id, day, rn, value AS acc, 0 AS bar, value >= 100 AS closed FROM e WHERE rn = 1
UNION ALL SELECT e.user_id, e.day, e.rn, CASE WHEN r.closed THEN e.value ELSE r.acc + e.value END, CASE WHEN r.closed THEN r.bar + 1 ELSE r.bar END, CASE WHEN r.closed THEN e.value ELSE r.acc + e.value END >= 100 FROM r JOIN e ON e.user_id = r.user_id AND e.day = r.day AND e.rn = r.rn + 1)
SELECT user_id, day, bar, count(*) AS rows, round(max(acc), 4) AS amount, bool_or(closed) AS complete FROM r GROUP BY 1, 2, 3""")
def ca08_threshold_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars per user and day that close at 100; the sum restarts at zero."""
    e = table(spark, sf_dir, "events").where("value IS NOT NULL").select("user_id", F.col("ts").cast("date").alias("day"), "ts", "event_id", "value")
    out = bar_ops.threshold_bars(e, ["user_id", "day"], ["ts", "event_id"], "value", "value", 100.0)
    return out.select("user_id", "day", "bar", "rows", F.round("amount", 4).alias("amount"), "complete")


@C.add("""WITH m AS (SELECT *, sign(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS mv FROM events), s AS (SELECT *, coalesce(last_value(nullif(mv, 0) IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 1)::double AS sgn FROM m)
SELECT event_id, sgn AS sign, round(sum(sgn * value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) + 0.0 AS imbalance FROM s""")
def ca09_signed_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bar_ops.signed_volume(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value", "value", F.col("ts").cast("date"))
    return out.select("event_id", "sign", (F.round("imbalance", 4) + 0.0).alias("imbalance"))


@C.add("""WITH f AS (SELECT o_custkey AS k, date_trunc('year', o_orderdate)::date AS s, last_day(o_orderdate::date) AS e, o_totalprice AS v FROM orders WHERE month(o_orderdate) IN (3, 6, 9, 12)),
t AS (SELECT k, s, e, sum(v) OVER (PARTITION BY k, s ORDER BY e) AS v, (month(e) // 3)::int AS n, lag((month(e) // 3)::int) OVER (PARTITION BY k, s ORDER BY e) AS pn, lag(v2) OVER (PARTITION BY k, s ORDER BY e) AS pv FROM (SELECT k, s, e, sum(v) AS v, sum(sum(v)) OVER (PARTITION BY k, s ORDER BY e) AS v2 FROM f GROUP BY 1, 2, 3))
SELECT k, e AS quarter_end, round(CASE WHEN n = 1 THEN v ELSE v - pv END, 2) AS value FROM t WHERE n = 1 OR pn = n - 1""")
def ca10_quarters_from_ytd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly amounts from running totals of the year (built from orders)."""
    o = table(spark, sf_dir, "orders").where("month(o_orderdate) IN (3, 6, 9, 12)")
    f = o.groupBy(F.col("o_custkey").alias("k"), F.trunc("o_orderdate", "YEAR").alias("s"), F.last_day("o_orderdate").alias("e")).agg(F.sum("o_totalprice").alias("v"))
    from pyspark.sql import Window

    ytd = f.withColumn("v", F.sum("v").over(Window.partitionBy("k", "s").orderBy("e"))).withColumn("known", F.date_add("e", 40))
    return quarters.quarterly(ytd, "k", "s", "e", "v", "known").select("k", "quarter_end", F.round("value", 2).alias("value"))


@C.add("""WITH l AS (SELECT l_partkey AS event, l_quantity AS k, round(avg(l_discount * 10), 6) AS p FROM lineitem GROUP BY 1, 2), m AS (SELECT event, k, (min(p) OVER (PARTITION BY event ORDER BY k ROWS UNBOUNDED PRECEDING) + max(p) OVER (PARTITION BY event ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) / 2 AS pa FROM l),
g AS (SELECT *, lag(k) OVER (PARTITION BY event ORDER BY k) AS k0, lag(pa) OVER (PARTITION BY event ORDER BY k) AS p0 FROM m) SELECT event, round(min(CASE WHEN pa <= 0.5 AND p0 > 0.5 THEN k0 + (p0 - 0.5) / (p0 - pa) * (k - k0) WHEN p0 IS NULL AND pa = 0.5 THEN k END), 6) AS median FROM g GROUP BY 1""")
def ca15_ladder_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    ladder = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("event"), F.col("l_quantity").alias("k")).agg(F.round(F.avg(F.col("l_discount") * 10), 6).alias("p"))
    return quarters.ladder_median(ladder, "event", "k", "p").select("event", F.round("median", 6).alias("median"))


@C.add("SELECT s_nationkey, count(*) AS n, 1 AS files FROM supplier GROUP BY 1")
def sk11_compacted_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in many small files per directory, compacted where it lies and read again."""
    path = shared_dir(spark, "small-files")
    table(spark, sf_dir, "supplier").repartition(12).write.partitionBy("s_nationkey").parquet(path)
    compaction.compact_lake(spark, path, force=True)
    found = spark.read.parquet(path).select("s_nationkey", F.input_file_name().alias("file"))
    return found.groupBy("s_nationkey").agg(F.count("*").alias("n"), F.countDistinct("file").alias("files"))


@C.add("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS status, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0)
SELECT 'merged' AS done, count(*) AS n, count(*) FILTER (WHERE status = 'X') AS changed, round(sum(o_totalprice), 0) AS total FROM o UNION ALL SELECT 'skipped, empty', 0, 0, 0""")
def sk01_write_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One writer in its modes: a table is written, merged with rows that lack a column, then neither skipped nor empty input changes it."""
    path = shared_dir(spark, "written")
    o = table(spark, sf_dir, "orders").where("o_orderkey % 7 <> 0").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    schema = {"o_orderkey": "bigint", "status": "string", "o_totalprice": "double"}
    writer.write(o, path, schema, sort=["o_orderkey"])
    done = writer.write(o.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("X").alias("status"), F.lit(1).alias("not_declared")), path, schema, "merge", ["o_orderkey"])
    others = [writer.write(o.limit(1), path, schema, "skip_if_exists"), writer.write(o.limit(0), path, schema)]
    stored = spark.read.parquet(path).agg(F.lit(done).alias("done"), F.count("*").alias("n"), F.count_if(F.col("status") == "X").alias("changed"), F.round(F.sum("o_totalprice"), 0).alias("total"))
    return stored.unionByName(stored.select(F.lit(", ".join(others)).alias("done"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("changed"), F.lit(0.0).alias("total")))


@C.add("SELECT o_orderkey, o_orderdate::date AS day, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderdate::date END AS from_text FROM orders")
def sk05_days_and_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days, times and their spellings aligned in one column."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    spelled = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).when(k == 2, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", writer.align_days(d, "date").alias("day"), writer.align_days(spelled, "date").alias("from_text"))


@C.add("SELECT * FROM (VALUES ('region', 'r_name', true), ('region', 'r_regionkey', true), ('region', 'r_comment', false), ('region', 'extra', true)) t(dataset, column_name, on_disk)")
def sc03_columns_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns the footers of a dataset's files have, a broken file and a declared column in none of them beside."""
    root = shared_dir(spark, "lake")
    r = table(spark, sf_dir, "region")
    r.where("r_regionkey < 2").write.parquet(f"{root}/region/a")
    r.select("r_name", F.lit(1).alias("extra")).write.parquet(f"{root}/region/b")
    lake = Lake(spark, root, {"region": "r_regionkey int, r_name string, r_comment string"})
    found = lake.columns_on_disk("region")
    names = sorted({*found, *lake.schemas["region"].fieldNames()})
    return spark.createDataFrame([("region", n, n in found) for n in names], "dataset string, column_name string, on_disk boolean")


@C.add("SELECT 'orders' AS dataset, count(*) AS n, 3 AS files, true AS has_bytes FROM orders")
def ag25_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, files and bytes of a dataset (HX17)."""
    root = shared_dir(spark, "lake")
    table(spark, sf_dir, "orders").repartition(3).write.parquet(f"{root}/orders")
    lake = Lake(spark, root, {"orders": "o_orderkey bigint"})
    files = lake.files("orders").agg(F.count("*").cast("int").alias("files"), (F.sum("length") > 0).alias("has_bytes"))
    return lake.counts().crossJoin(files).select("dataset", "n", "files", "has_bytes")  # one row
