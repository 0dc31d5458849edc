"""A module's queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.symbols import CANONICAL_SQL

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a query under its function's name; ``sql`` gives the same rows in DuckDB."""

        def register(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register


SYMBOL_SQL = CANONICAL_SQL.format("symbol")
#: Bars as they hold: canonical symbol, the latest delivery of each (symbol, date).
BARS_SQL = f"""bars AS (SELECT * FROM (SELECT * REPLACE ({SYMBOL_SQL} AS symbol) FROM ohlcv)
  WHERE symbol IS NOT NULL AND date IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ingested_at DESC) = 1)"""
#: Membership as it holds: the version of each (symbol, index_name, start_date) seen last.
MEMBERS_SQL = f"""members AS (SELECT *, coalesce(end_date, date '9999-12-31') AS end_eff FROM (SELECT * REPLACE ({SYMBOL_SQL} AS symbol) FROM membership)
  WHERE symbol IS NOT NULL AND index_name IS NOT NULL AND start_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY symbol, index_name, start_date ORDER BY first_seen_utc DESC NULLS LAST, coalesce(end_date, date '9999-12-31') DESC) = 1)"""
