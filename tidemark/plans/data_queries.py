"""Queries of the data-processing operators over the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.symbols import CANONICAL_SQL, bare_number, canonical, day_text, tidy
from tidemark.operators import compaction, drift
from tidemark.operators.intervals import merge_intervals
from tidemark.operators.known_at import attributes_known_at, last_value_held
from tidemark.operators.rolling import trailing_totals
from tidemark.operators.snapshots import snapshot_changes
from tidemark.session import shared_dir, table

def symbol() -> Column:
    return canonical(F.col("symbol"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_changes(table(spark, sf_dir, "landed_rows")).select("file_id", "change", "old_field", "new_field").distinct()


def p2_unified_ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.unify(table(spark, sf_dir, "landed_rows"), "ohlcv")


def p2_unified_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.unify(table(spark, sf_dir, "landed_rows"), "quality")


def p2_uncast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per target and column, how many values were present and how many of them could not be cast."""
    landed = table(spark, sf_dir, "landed_rows")
    return drift.uncast_counts(drift.unify(landed, "ohlcv"), "ohlcv").unionByName(drift.uncast_counts(drift.unify(landed, "quality"), "quality"))


def p3_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and averages of the last 7 and 30 days for every day of each symbol."""
    return trailing_totals(table(spark, sf_dir, "ohlcv"), symbol(), "date", "dividends", "ingested_at")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Averages are compared as exact totals: t7 / 7 < t30 / 30.
    return p3_totals(spark, sf_dir).where("total_7 > 0 AND total_7 * 30 < total_30 * 7").select(F.col("entity").alias("symbol"), day_text(F.col("day")).alias("day"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "short_volume_files")
    # The landing log stands for the small files themselves: they are written out, then compacted.
    files_at, joined_at = shared_dir(spark, "files"), shared_dir(spark, "compacted")
    finished = rows.where(~F.col("file_path").endswith(compaction.UNFINISHED))
    compaction.encode_files(finished, "file_path").write.parquet(files_at)
    compaction.consolidate(spark.read.parquet(files_at)).write.parquet(joined_at)
    joined = spark.read.parquet(joined_at)
    columns = ["symbol", "date", "market", "total_volume", "ingested_at"]
    records = compaction.read_consolidated(joined, T.StructType([f for f in rows.schema.fields if f.name in columns]))
    held = (
        records.groupBy("partition_path", symbol().alias("symbol"), "date", "market")
        .agg(F.max(F.struct("ingested_at", "total_volume")).alias("held"))
        .groupBy("partition_path")
        .agg(F.count("*").alias("records_kept"), F.sum(F.round(F.coalesce("held.total_volume", F.lit(0.0))).cast("long")).alias("volume_kept"))
    )
    report = compaction.compaction_report(joined).select("partition_path", "files_merged")
    return report.join(held, "partition_path").select("partition_path", "files_merged", "records_kept", "volume_kept")


def _snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = {c: tidy(F.col(c)) for c in ("company_name", "gics_sector", "gics_sub_industry")} | {"cik": bare_number(F.col("cik"))}
    return snapshot_changes(table(spark, sf_dir, "live_constituents"), "snapshot_date", symbol(), attributes, "ingested_at")


def p5_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change between consecutive snapshots with the names of changed attributes, joined by commas."""
    return _snapshot_changes(spark, sf_dir).withColumn("fields", F.array_join("fields", ","))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot_changes(spark, sf_dir).select(day_text(F.col("snapshot")).alias("snapshot_date"), F.col("key").alias("symbol"), "change")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "membership").where("index_name = 'SP500'")
    known = attributes_known_at(table(spark, sf_dir, "ohlcv"), symbol(), "date", versions, symbol(), "start_date", "end_date", "first_seen_utc", "gics_sector")
    final = last_value_held(versions, symbol(), "start_date", "end_date", "first_seen_utc", "gics_sector")
    return (
        known.where("known IS NOT NULL")
        .join(final, "entity", "left")
        .where("NOT (known <=> final)")
        .select(F.col("entity").alias("symbol"), day_text(F.col("day")).alias("bar_date"), F.col("known").alias("gics_sector"))
    )


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merge_intervals(table(spark, sf_dir, "membership"), {"symbol": symbol(), "index_name": F.col("index_name")}, "start_date", "end_date", "first_seen_utc")
    last = F.when(F.col("last_day").isNull(), "open").otherwise(day_text(F.col("last_day")))
    return found.where("kind = 'gap' OR intervals >= 2").select("symbol", "index_name", "kind", day_text(F.col("first_day")).alias("first_day"), last.alias("last_day"))


QUERIES = {f.__name__: f for f in (p2_found, p2_unified_ohlcv, p2_unified_quality, p2_uncast, p3_found, p3_totals, p4_found, p5_found, p5_changes, p6_found, p7_found)}

_S = CANONICAL_SQL.format("symbol")

SQL = {
    "p3_totals": f"""
WITH held AS (
  SELECT {_S} AS entity, date AS day, arg_max(coalesce(dividends, 0), ingested_at) AS amount
  FROM (SELECT *, row_number() OVER (PARTITION BY {_S}, date ORDER BY ingested_at DESC, dividends DESC NULLS LAST) AS rn FROM ohlcv WHERE symbol IS NOT NULL AND date IS NOT NULL)
  WHERE rn = 1 GROUP BY 1, 2),
spans AS (SELECT entity, min(day) AS lo, max(day) AS hi FROM held GROUP BY 1),
days AS (SELECT entity, unnest(generate_series(lo::timestamp, hi::timestamp, interval 1 day))::date AS day FROM spans),
filled AS (SELECT d.entity, d.day, coalesce(h.amount, 0)::decimal(28,12) AS amount FROM days d LEFT JOIN held h ON d.entity = h.entity AND d.day = h.day),
totals AS (SELECT entity, day,
  sum(amount) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS total_7,
  sum(amount) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS total_30 FROM filled)
SELECT entity, day, total_7, total_30, total_7::double / 7.0::double AS average_7, total_30::double / 30.0::double AS average_30 FROM totals""",
}
SQL["p3_found"] = f"SELECT entity AS symbol, strftime(day, '%Y-%m-%d') AS day FROM ({SQL['p3_totals']}) WHERE total_7 > 0 AND total_7 * 30 < total_30 * 7"
SQL["p4_found"] = rf"""
WITH rows_ AS (SELECT *, regexp_replace(file_path, '/[^/]*$', '') AS partition_path, {_S} AS canon FROM short_volume_files WHERE NOT ends_with(file_path, '.tmp')),
files AS (SELECT partition_path, count(DISTINCT file_path) AS files_merged FROM rows_ GROUP BY 1 HAVING count(DISTINCT file_path) > 1),
held AS (SELECT * FROM rows_ QUALIFY row_number() OVER (PARTITION BY partition_path, canon, date, market ORDER BY ingested_at DESC, total_volume DESC NULLS LAST) = 1)
SELECT partition_path, files_merged, count(*) AS records_kept, sum(round(coalesce(total_volume, 0))::bigint)::bigint AS volume_kept
FROM held JOIN files USING (partition_path) GROUP BY 1, 2"""
_TIDY = r"nullif(trim(regexp_replace({0}, '[\s\x{{00a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g')), '')"
_T = {c: _TIDY.format(c) for c in ("company_name", "gics_sector", "gics_sub_industry", "cik")}
_P5 = f"""
WITH latest AS (
  SELECT snapshot_date, {_S} AS symbol, {_T['company_name']} AS a, {_T['gics_sector']} AS b, {_T['gics_sub_industry']} AS c, nullif(ltrim({_T['cik']}, '0'), '') AS d
  FROM live_constituents WHERE snapshot_date IS NOT NULL AND symbol IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY snapshot_date, {_S} ORDER BY ingested_at DESC) = 1),
days AS (SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS prior FROM (SELECT DISTINCT snapshot_date FROM latest)),
cur AS (SELECT l.*, prior FROM latest l JOIN days USING (snapshot_date) WHERE prior IS NOT NULL),
old AS (SELECT l.*, d.snapshot_date AS later FROM latest l JOIN days d ON l.snapshot_date = d.prior),
both_ AS (SELECT coalesce(cur.snapshot_date, old.later) AS snapshot, coalesce(cur.symbol, old.symbol) AS key, CASE WHEN old.symbol IS NULL THEN 'added' WHEN cur.symbol IS NULL THEN 'removed' ELSE 'changed' END AS change,
  concat_ws(',', CASE WHEN cur.a IS DISTINCT FROM old.a THEN 'company_name' END, CASE WHEN cur.b IS DISTINCT FROM old.b THEN 'gics_sector' END, CASE WHEN cur.c IS DISTINCT FROM old.c THEN 'gics_sub_industry' END, CASE WHEN cur.d IS DISTINCT FROM old.d THEN 'cik' END) AS fields
FROM cur FULL JOIN old ON cur.symbol = old.symbol AND cur.snapshot_date = old.later
WHERE old.symbol IS NULL OR cur.symbol IS NULL OR (cur.a, cur.b, cur.c, cur.d) IS DISTINCT FROM (old.a, old.b, old.c, old.d))"""
SQL["p5_found"] = f"{_P5} SELECT strftime(snapshot, '%Y-%m-%d') AS snapshot_date, key AS symbol, change FROM both_"
SQL["p5_changes"] = f"{_P5} SELECT snapshot, key, change, CASE WHEN change = 'changed' THEN fields END AS fields FROM both_"
_CANON = "CASE " + " ".join(f"WHEN field IN ({', '.join(repr(a) for a in aliases)}) THEN '{name}'" for name, aliases in drift.ALIASES.items()) + " ELSE field END"
SQL["p2_found"] = f"""
WITH r AS (SELECT feed, file_id, landed_at, try_cast(payload AS json) AS doc FROM landed_rows WHERE feed IS NOT NULL AND file_id IS NOT NULL),
files AS (SELECT feed, file_id, row_number() OVER (PARTITION BY feed ORDER BY min(landed_at), file_id) AS nth FROM r GROUP BY 1, 2),
lasts AS (SELECT feed, max(nth) AS last FROM files GROUP BY 1),
k AS (SELECT feed, file_id, doc, unnest(json_keys(doc)) AS field FROM r WHERE json_type(doc) = 'OBJECT'),
t AS (SELECT feed, file_id, field, max(CASE json_type(doc, '$."' || field || '"') WHEN 'BOOLEAN' THEN 1 WHEN 'BIGINT' THEN 2 WHEN 'UBIGINT' THEN 2 WHEN 'DOUBLE' THEN 3 WHEN 'OBJECT' THEN 4 WHEN 'ARRAY' THEN 5 WHEN 'VARCHAR' THEN 6 END) AS kind FROM k GROUP BY 1, 2, 3),
c AS (SELECT feed, nth, field, {_CANON} AS canon, kind FROM t JOIN files USING (feed, file_id)),
m AS (SELECT *, CASE WHEN lag(nth) OVER w IS NULL OR lag(nth) OVER w < nth - 1 THEN 1 ELSE 0 END AS fresh FROM c WINDOW w AS (PARTITION BY feed, canon ORDER BY nth, field)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY feed, canon ORDER BY nth, field ROWS UNBOUNDED PRECEDING) AS chain FROM m),
p AS (SELECT *, last_value(kind IGNORE NULLS) OVER (PARTITION BY feed, canon, chain ORDER BY nth, field ROWS UNBOUNDED PRECEDING) AS carried FROM n),
s AS (SELECT feed, nth, canon, field, kind, row_number() OVER (PARTITION BY feed, nth, canon ORDER BY field) AS i FROM p WHERE nth > 1 AND NOT EXISTS (SELECT 1 FROM p q WHERE q.feed = p.feed AND q.field = p.field AND q.nth = p.nth - 1)),
e AS (SELECT feed, nth + 1 AS nth, canon, field, carried AS kind, row_number() OVER (PARTITION BY feed, nth, canon ORDER BY field) AS i FROM p JOIN lasts USING (feed) WHERE nth < last AND NOT EXISTS (SELECT 1 FROM p q WHERE q.feed = p.feed AND q.field = p.field AND q.nth = p.nth + 1)),
b AS (SELECT coalesce(s.feed, e.feed) AS feed, coalesce(s.nth, e.nth) AS nth, e.field AS old, s.field AS new, s.field IS NOT NULL AND e.field IS NOT NULL AND coalesce(s.kind = e.kind, true) AS same
  FROM s FULL JOIN e ON s.feed = e.feed AND s.nth = e.nth AND s.canon = e.canon AND s.i = e.i),
x AS (SELECT feed, nth, 'renamed' AS change, old AS old_field, new AS new_field FROM b WHERE same UNION ALL SELECT feed, nth, 'removed', old, '' FROM b WHERE NOT same AND old IS NOT NULL UNION ALL SELECT feed, nth, 'added', '', new FROM b WHERE NOT same AND new IS NOT NULL
  UNION ALL SELECT p.feed, p.nth, 'retyped', p.field, p.field FROM p JOIN p q ON q.feed = p.feed AND q.field = p.field AND q.nth = p.nth - 1 WHERE p.carried <> q.carried)
SELECT DISTINCT file_id, change, old_field, new_field FROM x JOIN files USING (feed, nth)"""
_HELD = f"""held AS (
  SELECT {_S} AS sym, index_name, start_date, coalesce(end_date, date '9999-12-31') AS end_date, gics_sector
  FROM membership WHERE symbol IS NOT NULL AND index_name IS NOT NULL AND start_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {_S}, index_name, start_date ORDER BY first_seen_utc DESC NULLS LAST, coalesce(end_date, date '9999-12-31') DESC) = 1)"""
SQL["p6_found"] = f"""
WITH {_HELD},
final AS (SELECT sym, arg_max(coalesce(gics_sector, chr(1)), start_date) AS final FROM held WHERE index_name = 'SP500' AND end_date >= start_date GROUP BY 1),
seen AS (SELECT {_S} AS sym, start_date, coalesce(end_date, date '9999-12-31') AS end_date, gics_sector, first_seen_utc::date AS seen FROM membership
  WHERE index_name = 'SP500' AND symbol IS NOT NULL AND start_date IS NOT NULL AND first_seen_utc IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {_S}, start_date, first_seen_utc::date ORDER BY first_seen_utc DESC, coalesce(end_date, date '9999-12-31') DESC) = 1),
known AS (SELECT *, lead(seen) OVER (PARTITION BY sym, start_date ORDER BY seen) AS replaced FROM seen),
bars AS (SELECT DISTINCT {_S} AS sym, date FROM ohlcv WHERE symbol IS NOT NULL AND date IS NOT NULL),
picked AS (SELECT b.sym, b.date, arg_max(coalesce(k.gics_sector, chr(1)), k.start_date) AS sector FROM bars b JOIN known k
  ON b.sym = k.sym AND b.date BETWEEN k.start_date AND k.end_date AND b.date >= k.seen AND (k.replaced IS NULL OR b.date < k.replaced) GROUP BY 1, 2)
SELECT p.sym AS symbol, strftime(p.date, '%Y-%m-%d') AS bar_date, p.sector AS gics_sector FROM picked p LEFT JOIN final f ON p.sym = f.sym
WHERE p.sector <> chr(1) AND p.sector IS DISTINCT FROM f.final"""
SQL["p7_found"] = f"""
WITH {_HELD},
good AS (SELECT *, max(end_date) OVER (PARTITION BY sym, index_name ORDER BY start_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM held WHERE end_date >= start_date),
marked AS (SELECT *, sum(CASE WHEN reach IS NULL OR (reach < date '9999-12-31' AND start_date > reach + 1) THEN 1 ELSE 0 END) OVER (PARTITION BY sym, index_name ORDER BY start_date) AS island FROM good),
periods AS (SELECT sym, index_name, island, min(start_date) AS lo, max(end_date) AS hi, count(*) AS n FROM marked GROUP BY 1, 2, 3),
beside AS (SELECT *, lead(lo) OVER (PARTITION BY sym, index_name ORDER BY lo) AS after FROM periods)
SELECT sym AS symbol, index_name, 'period' AS kind, strftime(lo, '%Y-%m-%d') AS first_day, CASE WHEN hi >= date '9999-12-31' THEN 'open' ELSE strftime(hi, '%Y-%m-%d') END AS last_day FROM periods WHERE n >= 2
UNION ALL SELECT sym, index_name, 'gap', strftime(hi + 1, '%Y-%m-%d'), strftime(after - 1, '%Y-%m-%d') FROM beside WHERE after IS NOT NULL"""
