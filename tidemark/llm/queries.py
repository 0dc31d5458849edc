"""Queries of this subpackage's operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.symbols import CANONICAL_SQL, canonical
from tidemark.llm import abuse
from tidemark.llm.byte_bpe import encode_corpus
from tidemark.llm.leakage import leaked_items
from tidemark.llm.nearest import nearest_in_time
from tidemark.session import table

DAY = 86_400_000_000


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbol = canonical(F.col("symbol"))
    found = nearest_in_time(
        table(spark, sf_dir, "blackout_windows"), "window_id", symbol,
        table(spark, sf_dir, "earnings_releases"), "release_id", symbol,
        [("fiscal_close", 10 * DAY), ("release_date", 3 * DAY)],
    )
    return found.select(F.col("query").alias("window_id"), "field", F.col("record").alias("release_id"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def _scored(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = abuse.fit(abuse.labelled_sample(documents, table(spark, sf_dir, "doc_labels")))
    return abuse.score_documents(documents, model, keep=keep)


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    return _scored(spark, sf_dir)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_scores(spark, sf_dir).where("flagged").select("doc_id").distinct()


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: documents, those flagged, their share and the mean score."""
    return abuse.rates(_scored(spark, sf_dir, "source"), "source")


QUERIES = {f.__name__: f for f in (p1_found, p8_ids, p9_found, p10_found, p10_scores, p10_rates)}

_NEAR = """
SELECT window_id, '{field}' AS field, release_id FROM (
  SELECT DISTINCT w.window_id, r.release_id, abs(epoch_us(w.{field}) - epoch_us(r.{field})) AS gap
  FROM blackout_windows w JOIN earnings_releases r ON {left} = {right}
  WHERE abs(epoch_us(w.{field}) - epoch_us(r.{field})) <= {tolerance})
QUALIFY row_number() OVER (PARTITION BY window_id ORDER BY gap, release_id) = 1"""

SQL = {
    "p1_found": " UNION ALL ".join(
        f"SELECT * FROM ({_NEAR.format(field=f, tolerance=t, left=CANONICAL_SQL.format('w.symbol'), right=CANONICAL_SQL.format('r.symbol'))})" for f, t in (("fiscal_close", 10 * DAY), ("release_date", 3 * DAY))
    )
}
