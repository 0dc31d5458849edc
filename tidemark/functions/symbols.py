"""Canonical ticker symbols and names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The same rule for DuckDB; ``{0}`` is the column.
CANONICAL_SQL = r"replace(upper(regexp_replace({0}, '[\s\x{{00a0}}]+', '', 'g')), '-', '.')"


def canonical(symbol: Column) -> Column:
    """Upper case, no blanks of any kind, ``.`` before a share class; null stays null."""
    return F.translate(F.upper(F.regexp_replace(symbol, r"(?U)\s+", "")), "-", ".")


def tidy(text: Column) -> Column:
    """Trimmed, each run of white space (non-breaking too) one blank, empty as null."""
    squeezed = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(squeezed != "", squeezed)


def bare_number(text: Column) -> Column:
    """An identifier without leading zeros; empty as null."""
    digits = F.regexp_replace(tidy(text), "^0+", "")
    return F.when(digits != "", digits)


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")
