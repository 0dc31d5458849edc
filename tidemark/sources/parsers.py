"""Landed text, CSV, XML, JSON and HTML payloads as rows, in built-in expressions.

Each takes a frame with the text in one column and never drops a readable row;
unreadable cells come out null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import market_time
from tidemark.functions.text import loose_number


def delimited(df: DataFrame, line: str, columns: Mapping[str, str], sep: str = "|", skip: str | None = None) -> DataFrame:
    """Delimited lines by position; header, footer and short lines are left out.

    A line counts if it has a cell for each column and doesn't match ``skip``
    (trailers such as a creation time).
    """
    cells = F.split(F.col(line), "\\" + sep, -1)
    names = list(columns)
    rows = df.select(cells.alias("_c")).where((F.size("_c") >= len(names)) & (F.lower(F.trim(F.col("_c")[0])) != names[0].lower()))
    if skip:
        rows = rows.where(~F.col("_c")[0].rlike(skip))
    return rows.select(*[F.nullif(F.trim(F.col("_c")[i]), F.lit("")).try_cast(t).alias(n) for i, (n, t) in enumerate(columns.items())])


def dated_csv_long(df: DataFrame, line: str, names: Sequence[str], missing: float = -99.0) -> DataFrame:
    """Lines that begin with eight digits, wide to long; values at or below ``missing`` are dropped."""
    cells = F.split(F.col(line), r"\s*,\s*")
    rows = df.where(F.col(line).rlike(r"^\s*\d{8}\s*,")).select(F.to_date(F.trim(cells[0]), "yyyyMMdd").alias("date"), cells.alias("c"))
    pairs = F.array(*[F.struct(F.lit(n).alias("factor"), loose_number(F.col("c")[i + 1]).alias("value")) for i, n in enumerate(names)])
    return rows.select("date", F.inline(pairs)).where(F.col("value") > missing)


def property_blocks(df: DataFrame, text: str, block: str, day: str, fields: Mapping[str, str]) -> DataFrame:
    """Values in ``<prefix:NAME>...</prefix:NAME>`` of each block, wide to long by ``fields`` (name -> label)."""
    blocks = df.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(rf"(?s)<(?:\w+:)?{block}[ >](.*?)</(?:\w+:)?{block}>"), 1)).alias("b"))
    get = lambda name: F.regexp_extract("b", rf"(?s)<(?:\w+:)?{name}(?: [^>]*)?>([^<]*)<", 1)
    pairs = F.array(*[F.struct(F.lit(label).alias("tenor"), loose_number(get(name)).alias("value")) for name, label in fields.items()])
    return blocks.select(F.to_date(F.substring(get(day), 1, 10)).alias("date"), F.inline(pairs)).where("value IS NOT NULL")


def market_and_exchange(name: Column) -> Column:
    """``market - exchange`` split at the last dash."""
    return F.struct(F.trim(F.regexp_extract(name, r"^(.*?)(?:\s+-\s+([^-]*))?$", 1)).alias("market"), F.nullif(F.trim(F.regexp_extract(name, r"^(.*)\s+-\s+([^-]*)$", 2)), F.lit("")).alias("exchange"))


def positive_or_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) > 0, F.col(c)) for c in columns})


def company_facts(df: DataFrame, payload: str) -> DataFrame:
    """facts -> taxonomy -> concept -> unit -> entries, flattened."""
    entry = "struct<start:string,end:string,val:double,fy:int,fp:string,form:string,filed:string,accn:string,frame:string>"
    facts = F.from_json(F.col(payload), f"struct<cik:bigint,facts:map<string,map<string,struct<label:string,units:map<string,array<{entry}>>>>>>").alias("p")
    a = df.select(facts).select("p.cik", F.explode("p.facts").alias("taxonomy", "concepts"))
    b = a.select("cik", "taxonomy", F.explode("concepts").alias("concept", "c")).select("cik", "taxonomy", "concept", F.explode("c.units").alias("unit", "entries"))
    e = b.select("cik", "taxonomy", "concept", "unit", F.explode("entries").alias("e"))
    day = lambda c: F.to_date(F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd")))
    return e.select("cik", "taxonomy", "concept", "unit", F.col("e.val").alias("value"), day("e.start").alias("start_date"), day("e.end").alias("end_date"), day("e.filed").alias("filed_date"), F.col("e.form").alias("form_type"), F.col("e.accn").alias("accession_number"))


def zipped_arrays(df: DataFrame, payload: str, columns: Sequence[str]) -> DataFrame:
    """A JSON object of equally long arrays as rows; shorter arrays are filled with nulls."""
    p = F.from_json(F.col(payload), "struct<" + ",".join(f"{c}:array<string>" for c in columns) + ">").alias("p")
    return df.select(p).select(F.explode(F.arrays_zip(*[F.col(f"p.{c}").alias(c) for c in columns])).alias("r")).select(*[f"r.{c}" for c in columns])


def nested_markets(df: DataFrame, payload: str) -> DataFrame:
    """Events with their open markets as outcomes; closed ones are dropped."""
    shape = "array<struct<event:string,title:string,markets:array<struct<id:string,label:string,status:string,bid:double,ask:double,last:double,volume:double>>>>"
    e = df.select(F.explode(F.from_json(F.col(payload), shape)).alias("e"))
    return e.select(F.col("e.event").alias("event_id"), F.col("e.title").alias("event_title"), F.inline("e.markets")).where("coalesce(status, '') NOT IN ('closed', 'settled', 'finalized')")


def observations(df: DataFrame, payload: str) -> DataFrame:
    """Series observations; a lone dot is a missing value."""
    o = df.select(F.explode(F.from_json(F.col(payload), "struct<observations:array<struct<date:string,value:string>>>").getField("observations")).alias("o"))
    return o.select(F.to_date("o.date").alias("date"), loose_number(F.col("o.value")).alias("value"))


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def both_sides(calls: DataFrame, puts: DataFrame, snapshot: Column, expiration: str) -> DataFrame:
    """Calls and puts in one frame with the days to expiration."""
    both = calls.withColumn("option_type", F.lit("call")).unionByName(puts.withColumn("option_type", F.lit("put")), allowMissingColumns=True)
    return both.withColumn("dte", F.datediff(F.col(expiration), snapshot))


def html_rows(df: DataFrame, html: str, least_rows: int = 1) -> DataFrame:
    """Cells of the rows of every table with at least ``least_rows`` rows: cells (array of string)."""
    tables = df.select(F.explode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<table\b.*?</table>"), 0)).alias("t"))
    rows = tables.select(F.regexp_extract_all("t", F.lit(r"(?is)<tr\b.*?</tr>"), 0).alias("r")).where(F.size("r") >= least_rows).select(F.explode("r").alias("r"))
    cells = F.transform(F.regexp_extract_all("r", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), 1), lambda c: F.trim(F.regexp_replace(c, r"<[^>]+>", "")))
    return rows.select(cells.alias("cells")).where(F.size("cells") > 0)


def packed_list(df: DataFrame, keys: Sequence[str], packed: str, name: str) -> DataFrame:
    """A comma-packed list as a row for each distinct non-empty entry."""
    entries = F.array_distinct(F.filter(F.transform(F.split(F.col(packed), ","), lambda x: F.trim(x)), lambda x: x != ""))
    return df.select(*keys, F.explode(entries).alias(name))


def release_days(df: DataFrame, event: str, close_time: str) -> DataFrame:
    """The New York days of each event's first close."""
    first = df.groupBy(event).agg(F.min(close_time).alias("first_close"))
    return first.select(F.to_date(market_time(F.col("first_close"))).alias("release_date")).distinct()
