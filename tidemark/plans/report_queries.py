"""Contracts, facts, matching and reports of the inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions import text
from tidemark.functions.symbols import canonical
from tidemark.operators import contracts, facts, matching, quarters, stats
from tidemark.plans.pit_queries import bars
from tidemark.plans.registry import BARS_SQL, SYMBOL_SQL, Catalogue
from tidemark.plans.scalar_queries import STEM_SQL
from tidemark.session import table

C = Catalogue()

# --- labels ------------------------------------------------------------------------

_NAMES = """p_partkey, CASE WHEN p_partkey % 23 = 0 THEN p_brand || '$A' ELSE p_brand END AS symbol, p_partkey % 31 = 0 AS etf, p_partkey % 37 = 0 AS test,
p_name || CASE p_partkey % 13 WHEN 0 THEN ' Warrants' WHEN 1 THEN ' Rights' WHEN 2 THEN ' Units' WHEN 3 THEN ' Preferred Stock' WHEN 4 THEN ' Notes due 2030' WHEN 5 THEN ' American Depositary Shares'
WHEN 6 THEN ' Common Units L.P.' WHEN 7 THEN ' Units, each consisting of one share and one right' WHEN 8 THEN ' Depositary Shares, preferred' WHEN 9 THEN ' Copyrights Inc' WHEN 10 THEN ' Preferred and Income Fund' WHEN 11 THEN ' PFD' ELSE '' END AS name"""


@C.add(f"""WITH n AS (SELECT {_NAMES} FROM part), l AS (SELECT *, lower(name) AS n, regexp_matches(lower(name), '\\beach consisting of\\b|\\bunits?\\b') AS u,
regexp_matches(lower(name), 'preferred (stock|shares|securities)|\\bpfd\\b|depositary shares.*preferred') AS p FROM n)
SELECT p_partkey, CASE WHEN test THEN 'test' WHEN etf THEN 'etf' WHEN contains(symbol, '$') THEN 'preferred' WHEN contains(n, 'depositary') THEN CASE WHEN p THEN 'preferred' ELSE 'common' END
WHEN contains(n, 'each consisting of') THEN 'unit' WHEN regexp_matches(n, '\\bwarrants?\\b') THEN 'warrant' WHEN regexp_matches(n, '\\brights?\\b') AND NOT u THEN 'right'
WHEN u AND NOT regexp_matches(n, 'common units|beneficial interest|partnership|royalty|limited partner|\\bl\\.?p\\.?(\\s|$)|holding|investment trust') THEN 'unit'
WHEN p THEN 'preferred' WHEN regexp_matches(n, '\\bnotes?\\b|\\bdebentures?\\b') THEN 'note' ELSE 'common' END AS kind FROM l""")
def fn04_security_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "part").selectExpr(*_split(_NAMES))
    return n.select("p_partkey", text.security_kind(F.col("symbol"), F.col("name"), F.col("etf"), F.col("test")).alias("kind"))


def _split(columns: str) -> list[str]:
    """Top-level items of a list of expressions, which SQL and Spark share."""
    out, depth, quoted, start = [], 0, False, 0
    for i, c in enumerate(columns + ","):
        quoted ^= c == "'"
        depth += (c == "(") - (c == ")")
        if c == "," and not depth and not quoted:
            out.append(columns[start:i].strip())
            start = i + 1
    return out


_RATINGS = """o_orderkey, CASE o_custkey % 6 WHEN 0 THEN 'up' WHEN 1 THEN 'down' WHEN 2 THEN 'init' WHEN 3 THEN 'main' WHEN 4 THEN 'reit' END AS action,
CASE o_orderkey % 5 WHEN 0 THEN ' Buy' WHEN 1 THEN 'SELL ' WHEN 2 THEN 'Hold' WHEN 3 THEN 'Moderate Sell' END AS to_grade, CASE o_orderkey % 4 WHEN 0 THEN 'Raises' WHEN 1 THEN 'Lowers' WHEN 2 THEN 'Maintains' END AS target"""


@C.add(f"""WITH r AS (SELECT {_RATINGS} FROM orders), g AS (SELECT *, lower(trim(coalesce(to_grade, ''))) AS g FROM r)
SELECT o_orderkey, CASE WHEN action = 'up' THEN 'upgrade' WHEN action = 'down' THEN 'downgrade' WHEN action = 'init' AND g IN ('buy') THEN 'init bullish' WHEN action = 'init' AND g IN ('sell', 'moderate sell') THEN 'init bearish'
WHEN action = 'init' THEN 'init neutral' WHEN action IN ('main', 'reit') AND target = 'Raises' THEN 'target raised' WHEN action IN ('main', 'reit') AND target = 'Lowers' THEN 'target lowered' ELSE 'other' END AS kind FROM g""")
def fn09_rating_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "orders").selectExpr(*_split(_RATINGS))
    return r.select("o_orderkey", text.rating_kind(F.col("action"), F.col("to_grade"), F.col("target")).alias("kind"))


# --- contracts ---------------------------------------------------------------------

# Quotes made of line items, with every kind of fault; SQL and Spark share the expressions.
_QUOTES = """l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_suppkey % 40 = 0 THEN NULL WHEN l_suppkey % 41 = 0 THEN 0.0 ELSE 100.0 END AS spot, 60 + l_quantity * 1.6 AS strike,
(l_linenumber - 1) * 30 / 365.0 AS years, round(l_tax * 100, 2) AS bid, CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE round(l_tax * 100 + l_discount * 40, 2) END AS ask,
CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE round(l_extendedprice / 10000, 2) END AS last_price, l_linestatus = 'O' AS is_call, 0.04 AS rate, l_discount / 10 AS dividend_yield"""


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = table(spark, sf_dir, "lineitem").selectExpr(*_split(_QUOTES))
    return quotes.withColumns({c: F.col(c).cast("double") for c in ("spot", "strike", "years", "bid", "ask", "last_price", "rate")})


@C.add(f"""WITH q AS (SELECT {_QUOTES} FROM lineitem), c AS (SELECT *, CASE WHEN bid > 0 THEN bid END AS b, CASE WHEN ask > 0 THEN ask END AS a, CASE WHEN last_price > 0 THEN last_price END AS l, coalesce(spot > 0 AND strike > 0, false) AS sound FROM q),
p AS (SELECT *, sound AND years > 0 AS alive, CASE WHEN sound AND years > 0 THEN coalesce((b + a) / 2, a / 2, l) END AS price, greatest(0, CASE WHEN is_call THEN spot - strike ELSE strike - spot END) AS gain FROM c),
f AS (SELECT *, concat_ws('|', CASE WHEN alive AND (b IS NULL OR a IS NULL) AND (a IS NOT NULL OR l IS NOT NULL) THEN 'zero_bid' END, CASE WHEN price IS NOT NULL AND b >= a THEN 'crossed_market' END,
CASE WHEN price IS NOT NULL AND (a - b) / price > 0.5 THEN 'wide_spread' END, CASE WHEN price < gain - 1e-9 THEN 'below_intrinsic' END, CASE WHEN price >= gain - 1e-9 AND price - gain < 1e-4 THEN 'no_time_value' END,
CASE WHEN sound AND NOT alive THEN 'expired' END, CASE WHEN price IS NOT NULL AND abs(ln(strike / spot)) > 0.35 THEN 'deep_itm' END, CASE WHEN NOT sound OR (alive AND price IS NULL) THEN 'bad_input' END) AS flags FROM p)
SELECT l_orderkey, l_linenumber, CASE WHEN flags = '' THEN 'ok' ELSE flags END AS quality, round(price, 4) AS mid_price, round(CASE WHEN price IS NOT NULL THEN price - gain END, 4) AS time_value,
NOT regexp_matches(flags, 'zero_bid|crossed|wide|below|no_time|expired|bad') AS usable FROM f""")
def fn28_quote_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality flags of quotes, the price to solve for, and whether the quote is usable (HX07)."""
    q = contracts.assess_quotes(_quotes(spark, sf_dir), "spot", "strike", "years", "bid", "ask", "last_price", "is_call")
    return q.select("l_orderkey", "l_linenumber", contracts.label(F.col("flags")).alias("quality"), F.round("mid_price", 4).alias("mid_price"), F.round("time_value", 4).alias("time_value"), contracts.usable(F.col("flags")).alias("usable"))


@C.add()
def fn29_analysed_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags, volatility and sensitivities of the quotes of fn28; tested by pricing them again."""
    return contracts.analyse_contracts(_quotes(spark, sf_dir), "spot", "strike", "years", "rate", "dividend_yield", "bid", "ask", "last_price", "is_call")


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return l.select(
        F.col("l_suppkey").alias("symbol"), F.col("l_partkey").alias("expiration"), F.when(F.col("l_linestatus") == "F", "put").otherwise("call").alias("option_type"), F.col("l_quantity").alias("volume"), F.col("l_extendedprice").alias("open_interest"),
        F.col("l_extendedprice").alias("spot"), "l_orderkey", "l_linenumber", (F.col("l_linenumber") * 9).alias("dte"), F.round(F.col("l_discount") + 0.1, 2).alias("iv"), (F.col("l_tax") > 0.01).alias("iv_usable"), F.round((F.col("l_quantity") - 25) / 200, 4).alias("log_moneyness"),
    )


@C.add("""SELECT l_suppkey AS symbol, v_call AS call_volume, v_put AS put_volume, o_call AS call_open_interest, o_put AS put_open_interest, contracts, expirations, underlying_price, v_put / nullif(v_call, 0) AS put_call_volume_ratio, o_put / nullif(o_call, 0) AS put_call_oi_ratio FROM (
SELECT l_suppkey, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus <> 'F'), 0)::bigint AS v_call, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0)::bigint AS v_put, floor(coalesce(sum(l_extendedprice) FILTER (WHERE l_linestatus <> 'F'), 0))::bigint AS o_call,
floor(coalesce(sum(l_extendedprice) FILTER (WHERE l_linestatus = 'F'), 0))::bigint AS o_put, count(*) AS contracts, count(DISTINCT l_partkey) AS expirations, arg_min(l_extendedprice, (l_partkey, l_orderkey, l_linenumber)) AS underlying_price FROM lineitem GROUP BY 1)""")
def ag07_two_sided_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Put and call volume, open interest and ratios per symbol."""
    return contracts.put_call_flow(_chains(spark, sf_dir), ["symbol"], "option_type", "volume", "open_interest", "expiration", "spot", ["expiration", "l_orderkey", "l_linenumber"])


@C.add("""WITH c AS (SELECT l_suppkey AS symbol, l_linestatus = 'F' AS put, round(l_discount + 0.1, 2) AS iv, round((l_quantity - 25) / 200, 4) AS m FROM lineitem WHERE l_tax > 0.01 AND l_linenumber * 9 BETWEEN 20 AND 45)
SELECT symbol, round(median(iv) FILTER (WHERE abs(m) < 0.03), 6) AS atm_iv_30d, round(median(iv) FILTER (WHERE put AND m BETWEEN 0.05 AND 0.12) - median(iv) FILTER (WHERE NOT put AND m BETWEEN -0.12 AND -0.05), 6) AS skew_25d FROM c GROUP BY 1""")
def ag08_surface_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volatility at the money and skew of the wings per symbol, for tenors of about a month."""
    s = contracts.surface_summary(_chains(spark, sf_dir), ["symbol"], "option_type", "dte")
    return s.select("symbol", F.round("atm_iv_30d", 6).alias("atm_iv_30d"), F.round("skew_25d", 6).alias("skew_25d"))


@C.add()
def ca07_options_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on chains made of line items: curve, yields, analysis, flow and surface."""
    chains = _quotes(spark, sf_dir).select(
        F.col("l_suppkey").alias("symbol"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("l_linenumber") * 9).alias("expiration"), F.when(F.col("is_call"), "call").otherwise("put").alias("option_type"), "strike", (F.col("l_linenumber") * 9).alias("dte"),
        F.col("spot").alias("underlying_price"), "bid", "ask", "last_price", F.col("l_linenumber").alias("volume"), F.col("l_linenumber").alias("open_interest"),
    )
    nations = table(spark, sf_dir, "nation")
    curve = nations.select((F.col("n_nationkey") / 10 + 0.01).alias("maturity"), (0.03 + F.col("n_regionkey") / 1000).alias("rate"))
    yields = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("symbol"), F.lit(0.01).alias("dividend_yield"))
    return contracts.options_report(chains, ["symbol"], curve, yields)[1]


@C.add("""SELECT l_orderkey, l_linenumber, l_shipdate::date AS snapshot_date, l_linenumber * 9 AS dte FROM lineitem WHERE l_shipdate::date BETWEEN date '1997-01-01' AND date '1997-12-31' AND 'S' || l_suppkey IN ('S1', 'S7', 'S12') AND l_linenumber * 9 BETWEEN 18 AND 45 AND l_linestatus = 'F'""")
def ca06_options_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts of some symbols over a range of snapshots, by type and days to expiry."""
    chains = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("snapshot_date"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"), (F.col("l_linenumber") * 9).alias("dte"), F.when(F.col("l_linestatus") == "F", "put").otherwise("call").alias("option_type"))
    day = lambda d: F.lit(d).cast("date")
    return contracts.options_between(chains, day("1997-01-01"), day("1997-12-31"), ["s1", "S7", "s12"], 18, 45, "PUT").select("l_orderkey", "l_linenumber", "snapshot_date", "dte")


# --- facts -------------------------------------------------------------------------

_FACTS = """'C' || o_custkey AS symbol, o_orderpriority AS concept, CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-Q' ELSE '8-K' END AS form_type, CAST(o_orderdate AS date) AS end_date,
CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(o_orderdate AS date) + CAST(l_linenumber * 10 AS int) END AS filed_date, l_extendedprice AS value, o_orderkey * 10 + l_linenumber AS accession"""
_KNOWN = f"f AS (SELECT {_FACTS} FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"
_PRIORITY = ["1-URGENT", "2-HIGH", "5-LOW"]


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _split(_FACTS.replace("CAST(o_orderdate AS date) + CAST(l_linenumber * 10 AS int)", "date_add(CAST(o_orderdate AS date), CAST(l_linenumber * 10 AS int))"))
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    return o.selectExpr(*columns)


_PICK = f"""WITH {_KNOWN}, k AS (SELECT * FROM f WHERE concept IN ('1-URGENT', '2-HIGH', '5-LOW') AND form_type IN ('10-K', '10-Q') AND filed_date <= date '1998-06-30'
QUALIFY row_number() OVER (PARTITION BY symbol, concept ORDER BY end_date DESC, filed_date DESC, accession DESC, value DESC) = 1)"""


@C.add(f"{_PICK} SELECT symbol, concept, value, end_date, filed_date FROM k")
def ca04_facts_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest period of some concepts as known on a day, by form."""
    return facts.facts_known(_facts(spark, sf_dir), F.lit("1998-06-30").cast("date"), _PRIORITY, ties=["accession", "value"]).select("symbol", "concept", "value", "end_date", "filed_date")


@C.add(f"{_PICK} SELECT symbol, concept, end_date FROM k QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY end_date DESC, CASE concept WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END) = 1")
def ca04_revenue_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest known value under several concepts, the first by priority where a period has several."""
    return facts.revenue_known(_facts(spark, sf_dir), F.lit("1998-06-30").cast("date"), _PRIORITY).select("symbol", "concept", "end_date")


@C.add("""WITH q AS (SELECT 'C' || o_custkey AS symbol, year(o_orderdate) AS y, quarter(o_orderdate) AS n, round(sum(o_totalprice)) AS s, count(*) AS c FROM orders GROUP BY 1, 2, 3),
t AS (SELECT *, last_day(make_date(y, n * 3, 1)) AS qend, sum(s) OVER (PARTITION BY symbol, y ORDER BY n) AS ytd, lag(n) OVER (PARTITION BY symbol, y ORDER BY n) AS pn FROM q),
b AS (SELECT symbol, y, qend, n, s, CASE WHEN n <> 3 THEN c END AS c FROM t WHERE n = 1 OR pn = n - 1),
g AS (SELECT symbol, qend, s, last_value(c IGNORE NULLS) OVER r AS c, last_value(CASE WHEN c IS NOT NULL THEN qend + 60 END IGNORE NULLS) OVER r AS c_known, lag(qend, 3) OVER w AS q3, sum(s) OVER f AS four, count(*) OVER f AS nf FROM b
WINDOW w AS (PARTITION BY symbol ORDER BY qend), r AS (PARTITION BY symbol ORDER BY qend ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), f AS (PARTITION BY symbol ORDER BY qend ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
k AS (SELECT *, max(greatest(qend + 40, c_known, qend + 25)) OVER (PARTITION BY symbol ORDER BY qend) AS known FROM g),
x AS (SELECT 'C' || o_custkey AS symbol, o_orderdate::date AS day FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
SELECT symbol, qend AS quarter_end, CASE WHEN nf = 4 AND qend - q3 BETWEEN 250 AND 300 THEN four END AS ni_ttm, s AS assets, c * power(2, (SELECT count(*) FROM x WHERE x.symbol = k.symbol AND x.day > k.known)) AS shares, known FROM k""")
def ca11_quarterly_fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing sums, balances and split-adjusted shares per quarter with the day all was known, from year-to-date facts made of orders."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("C"), F.col("o_custkey")).alias("symbol"), F.col("o_orderdate").cast("date").alias("d"), "o_totalprice", "o_orderpriority", "o_orderstatus")
    q = o.groupBy("symbol", F.year("d").alias("y"), F.quarter("d").alias("n")).agg(F.round(F.sum("o_totalprice")).alias("s"), F.count("*").cast("double").alias("c"))
    end = F.last_day(F.make_date("y", F.col("n") * 3, F.lit(1)))
    ytd = F.sum("s").over(Window.partitionBy("symbol", "y").orderBy("n"))
    wide = q.withColumn("end", end).withColumn("ytd", ytd)
    fact = lambda concept, start, e, value, lag: F.struct(F.lit(concept).alias("concept"), start.alias("start_date"), e.alias("end_date"), value.alias("value"), F.date_add(e, lag).alias("filed_date"))
    rows = F.array_compact(
        F.array(
            fact("NetIncome", F.make_date("y", F.lit(1), F.lit(1)), F.col("end"), F.col("ytd"), 40),
            fact("Assets", F.lit(None).cast("date"), F.date_sub("end", 5), F.col("s"), 30),
            F.when(F.col("n") != 3, fact("Shares", F.lit(None).cast("date"), F.col("end"), F.col("c"), 60)),
        )
    )
    made = wide.select("symbol", F.inline(rows))
    splits = o.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select("symbol", F.col("d").alias("date"), F.lit(2.0).alias("stock_splits"))
    return facts.quarterly_fundamentals(made, {"ni": ["NetIncome"]}, {"assets": ["Assets"]}, ["Shares"], splits, "ni")


@C.add(f"""WITH c AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, fiscal_close::date AS close, month(fiscal_close) = 12 AS yr FROM earnings_releases WHERE fiscal_close IS NOT NULL AND symbol IS NOT NULL),
w AS (SELECT *, last_value(CASE WHEN yr THEN close END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY close ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, first_value(CASE WHEN yr THEN close END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY close ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM c),
n AS (SELECT *, CASE WHEN yr THEN 4 WHEN before IS NOT NULL THEN round((close - before) / 91.3) WHEN after IS NOT NULL THEN 4 - round((after - close) / 91.3) END::int AS quarter FROM w)
SELECT symbol, close, quarter FROM n WHERE yr OR quarter IS NULL OR quarter BETWEEN 1 AND 3""")
def ca25_fiscal_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter numbers of period ends by their distance from the year end."""
    r = table(spark, sf_dir, "earnings_releases").where("fiscal_close IS NOT NULL AND symbol IS NOT NULL")
    filings = r.select(canonical(F.col("symbol")).alias("symbol"), F.col("fiscal_close").cast("date").alias("period"), F.when(F.month("fiscal_close") == 12, "10-K/A").otherwise("10-Q").alias("form"))
    return facts.fiscal_quarters(filings, "symbol", "period", "form")


# --- matching ----------------------------------------------------------------------

_COMPANIES = "n_nationkey, n_name || CASE n_nationkey % 4 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' Holdings Corp' WHEN 2 THEN ' & Co' ELSE '' END AS company"
_MENTIONS = """s_suppkey, concat(' Nobody,3;', lower(a), ' Group Ltd,', CAST(s_suppkey * 37 % 700 AS string), ';', b, ' (The),', CAST(s_suppkey * 53 % 700 AS string), ';', a, ';', b, ',x') AS mentions"""


@C.add(f"""WITH i AS (SELECT {STEM_SQL.format('company')} AS stem, max(n_nationkey) AS n_nationkey FROM (SELECT {_COMPANIES} FROM nation) GROUP BY 1 HAVING length(stem) >= 6 AND stem NOT IN ('UNITED')),
m AS (SELECT {_MENTIONS.replace('AS string', 'AS varchar')} FROM (SELECT s_suppkey, x.n_name AS a, y.n_name AS b FROM supplier JOIN nation x ON x.n_nationkey = s_nationkey JOIN nation y ON y.n_nationkey = (s_nationkey + 1) % 25)),
e AS (SELECT s_suppkey, unnest(string_split(mentions, ';')) AS entry, generate_subscripts(string_split(mentions, ';'), 1) AS nth FROM m),
s AS (SELECT s_suppkey, nth, {STEM_SQL.format("regexp_extract(entry, '^(.*),[^,]*$', 1)")} AS stem, try_cast(trim(regexp_extract(entry, '^.*,([^,]*)$', 1)) AS int) AS "offset" FROM e)
SELECT s_suppkey, n_nationkey, "offset" FROM s JOIN i USING (stem) WHERE "offset" <= 400 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY "offset", nth) = 1""")
def jn14_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company that a text names first, by name stems, up to an offset."""
    nation = table(spark, sf_dir, "nation")
    index = matching.name_index(nation.selectExpr(*_split(_COMPANIES)), "n_nationkey", "company")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", ((F.col("s_nationkey") + 1) % 25).alias("other"))
    a, b = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("a")), nation.select(F.col("n_nationkey").alias("other"), F.col("n_name").alias("b"))
    documents = s.join(a, "s_nationkey").join(b, "other").selectExpr(*_split(_MENTIONS))
    return matching.earliest_mention(documents, "s_suppkey", "mentions", index, "n_nationkey", 400)


@C.add(rf"""WITH d AS (SELECT doc_id, {SYMBOL_SQL} AS symbol, published_at::date AS day FROM documents WHERE regexp_matches(text, '(?i)\bquarter') AND symbol IS NOT NULL AND published_at IS NOT NULL),
r AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, release_date::date AS released, release_id FROM earnings_releases WHERE release_date IS NOT NULL)
SELECT doc_id, release_id, released AS matched_day, abs(day - released) AS days_away FROM d JOIN r USING (symbol) WHERE abs(day - released) <= 10 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY abs(day - released), released, release_id) = 1""")
def jn15_nearest_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that speak of a quarter with the company's release nearest to their day, at most ten days away."""
    d = table(spark, sf_dir, "documents").where(F.col("text").rlike(r"(?i)\bquarter") & F.col("symbol").isNotNull()).select("doc_id", canonical(F.col("symbol")).alias("symbol"), F.col("published_at").cast("date").alias("day"))
    r = table(spark, sf_dir, "earnings_releases").select(canonical(F.col("symbol")).alias("symbol"), F.col("release_date").cast("date").alias("released"), "release_id").distinct()
    return matching.nearest_within(d, r, ["symbol"], "day", "released", 10, ["release_id"], ["release_id"]).select("doc_id", "release_id", "matched_day", "days_away")


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "blackout_windows").where("symbol IS NOT NULL AND shut IS NOT NULL AND reopen IS NOT NULL")
    return w.select(canonical(F.col("symbol")).alias("symbol"), "shut", "reopen", F.col("release_date").cast("date").alias("release"), F.col("fiscal_close").cast("date").alias("close"), "window_id").distinct()


def _releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "earnings_releases").where("symbol IS NOT NULL")
    return r.select(canonical(F.col("symbol")).alias("symbol"), F.col("fiscal_close").cast("date").alias("fiscal_close"), F.col("release_date").cast("date").alias("release_date"), "report_filed", "release_id").distinct()


@C.add()
def jn16_claimed_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each window's fiscal close with a release of its own: the last in its range that no earlier close took; tested by brute force."""
    periods = _windows(spark, sf_dir).withColumn("filed", F.date_add("close", 60))
    return matching.claim_latest(periods, _releases(spark, sf_dir), "symbol", "close", "filed", "release_date", "release_id")


@C.add()
def jn19_expected_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past releases and those expected within 120 days of a date, by calendar or usual lag; tested on fixtures."""
    calendar = _windows(spark, sf_dir).select("symbol", F.col("release").alias("date"))
    return matching.expected_releases(_releases(spark, sf_dir), calendar, "2024-01-15")


_WINDOWS_SQL = f"w AS (SELECT DISTINCT {SYMBOL_SQL} AS symbol, shut, reopen, release_date::date AS release FROM blackout_windows WHERE symbol IS NOT NULL AND shut IS NOT NULL AND reopen IS NOT NULL)"


@C.add(f"""WITH {_WINDOWS_SQL} SELECT symbol, bool_or(shut <= date '2019-04-15' AND reopen > date '2019-04-15') AS shut, max(reopen) FILTER (WHERE shut <= date '2019-04-15' AND reopen > date '2019-04-15') AS reopens,
arg_max(release, epoch(reopen::timestamp) * 1e6 + epoch(coalesce(release, date '1970-01-01')::timestamp) / 86400) FILTER (WHERE shut <= date '2019-04-15' AND reopen > date '2019-04-15' AND release IS NOT NULL) AS window_release,
min(shut) FILTER (WHERE shut > date '2019-04-15') AS next_shut, min(release) FILTER (WHERE release >= date '2019-04-15') AS next_release FROM w GROUP BY 1""")
def ca14_window_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _windows(spark, sf_dir).select("symbol", "shut", "reopen", "release").distinct()
    return matching.window_status(w, "symbol", "shut", "reopen", "release", F.lit("2019-04-15").cast("date"))


@C.add(f"""WITH {_WINDOWS_SQL}, g AS (SELECT * FROM w WHERE reopen > shut), c AS (SELECT DISTINCT symbol, unnest(generate_series(shut::timestamp, (reopen - 1)::timestamp, interval 1 day))::date AS day FROM g),
s AS (SELECT symbol, unnest(generate_series(min(shut)::timestamp, (max(reopen) - 1)::timestamp, interval 1 day))::date AS day FROM g GROUP BY symbol),
n AS (SELECT day, count(*) AS covered FROM s GROUP BY 1), k AS (SELECT day, count(*) AS shut FROM c GROUP BY 1) SELECT day, covered, coalesce(shut, 0) AS shut, coalesce(shut, 0) / covered::double AS share FROM n LEFT JOIN k USING (day)""")
def ca14_shut_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.shut_share(_windows(spark, sf_dir), "symbol", "shut", "reopen")


_OUTCOMES = """l_orderkey, l_linenumber, CASE l_orderkey % 6 WHEN 0 THEN 'greater' WHEN 1 THEN CASE WHEN l_linenumber = 1 THEN 'less' ELSE 'greater' END WHEN 2 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'touch_above' ELSE 'touch_below' END
WHEN 5 THEN CASE WHEN l_linenumber = 1 THEN 'less' ELSE 'between' END END AS kind, CASE WHEN l_orderkey % 6 IN (1, 5) AND l_linenumber = 1 THEN NULL ELSE l_quantity END AS floor, CASE WHEN l_tax = 0 THEN NULL ELSE round(l_discount * 10, 1) END AS p, l_orderkey % 6 = 3 AS exclusive"""


@C.add(f"""WITH o AS (SELECT {_OUTCOMES} FROM lineitem), r AS (SELECT *, l_orderkey AS k FROM o WHERE p IS NOT NULL),
f AS (SELECT k, count(*) AS n, list(DISTINCT kind) FILTER (WHERE kind IS NOT NULL) AS kinds, bool_and(floor IS NOT NULL) AS floors, bool_or(exclusive) AS excl, sum(p) AS total, max(p) AS single FROM r GROUP BY 1),
g AS (SELECT *, CASE WHEN n = 1 THEN 'binary' WHEN kinds = ['greater'] AND floors THEN 'above' WHEN len(kinds) > 0 AND list_has_all(['touch_above', 'touch_below'], kinds) THEN 'touch' WHEN list_contains(kinds, 'between') OR (len(kinds) = 2 AND list_has_all(['greater', 'less'], kinds)) THEN 'buckets'
WHEN NOT excl THEN 'multi' ELSE 'outcomes' END AS form FROM f),
a AS (SELECT k, floor, max(p) AS above FROM r JOIN g USING (k) WHERE form = 'above' GROUP BY 1, 2 UNION ALL SELECT k, floor, round(sum(mass) OVER (PARTITION BY k ORDER BY floor ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 9) FROM (SELECT k, floor, sum(p) / max(total) AS mass FROM r JOIN g USING (k) WHERE form = 'buckets' AND total > 0 AND floor IS NOT NULL GROUP BY 1, 2)),
m AS (SELECT k, floor, (min(above) OVER (PARTITION BY k ORDER BY floor ROWS UNBOUNDED PRECEDING) + max(above) OVER (PARTITION BY k ORDER BY floor ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) / 2 AS pa FROM a),
l AS (SELECT *, lag(floor) OVER w AS k0, lag(pa) OVER w AS p0 FROM m WINDOW w AS (PARTITION BY k ORDER BY floor)),
d AS (SELECT k, arg_min(pa, floor) AS low, arg_max(pa, floor) AS high, min(CASE WHEN pa <= 0.5 AND p0 > 0.5 THEN k0 + (p0 - 0.5) / (p0 - pa) * (floor - k0) WHEN p0 IS NULL AND pa = 0.5 THEN floor END) AS median FROM l GROUP BY 1),
t AS (SELECT k, l_linenumber, round(sum(p), 9) AS p1 FROM r JOIN g USING (k) WHERE form = 'outcomes' GROUP BY 1, 2), u AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY k ORDER BY p1 DESC, l_linenumber) = 1)
SELECT e.l_orderkey, CASE WHEN form IS NULL THEN 'empty' WHEN form IN ('above', 'buckets') THEN 'ladder' ELSE form END AS view, round(CASE WHEN low >= 0.5 AND high <= 0.5 THEN median END, 6) AS median, coalesce(low < 0.5, false) AS below_range, coalesce(low >= 0.5 AND high > 0.5, false) AS above_range,
CASE WHEN form = 'binary' THEN 'Yes' ELSE l_linenumber::varchar END AS top, round(CASE WHEN form = 'binary' THEN single WHEN form = 'outcomes' THEN CASE WHEN total > 1.05 OR total < 0.95 THEN p1 / nullif(total, 0) ELSE p1 END END, 6) AS top_prob
FROM (SELECT DISTINCT l_orderkey FROM lineitem) e LEFT JOIN g ON g.k = e.l_orderkey LEFT JOIN d ON d.k = e.l_orderkey LEFT JOIN u ON u.k = e.l_orderkey""")
def ca15_event_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the outcomes of an event say, by the kind of their strikes."""
    o = table(spark, sf_dir, "lineitem").selectExpr(*_split(_OUTCOMES)).withColumn("outcome", F.col("l_linenumber").cast("string"))
    v = quarters.event_views(o, "l_orderkey", "kind", "floor", "p", "outcome", "exclusive")
    return v.select("l_orderkey", "view", F.round("median", 6).alias("median"), "below_range", "above_range", "top", F.round("top_prob", 6).alias("top_prob"))


# --- reports and small rules -------------------------------------------------------


@C.add("""WITH m AS (SELECT user_id, time_bucket(interval 1 minute, ts) AS minute, sum(value) AS v FROM events WHERE value IS NOT NULL GROUP BY 1, 2), d AS (SELECT user_id, minute::date AS day, sum(v) AS total FROM m GROUP BY 1, 2),
t AS (SELECT user_id, avg(total) AS daily FROM d GROUP BY 1), x AS (SELECT user_id, median(v) AS middle, max(v) AS biggest FROM m GROUP BY 1)
SELECT user_id, round(daily / 50, 6) AS threshold, round(daily, 6) AS daily, round(middle, 6) AS median_minute, round(biggest, 6) AS max_minute, round(100 * middle / (2 * daily / 50), 4) AS typical_overshoot, round(100 * biggest / (2 * daily / 50), 4) AS open_overshoot, biggest >= daily / 50 AS exceeds FROM t JOIN x USING (user_id)""")
def hx08_threshold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a threshold for 50 bars a day would do: overshoot, and whether one minute fills a bar."""
    m = table(spark, sf_dir, "events").where("value IS NOT NULL").groupBy("user_id", F.date_trunc("minute", "ts").alias("minute")).agg(F.sum("value").alias("v"))
    r = stats.threshold_report(m.withColumn("day", F.to_date("minute")), "user_id", "day", "v", 50)
    return r.select("user_id", *[F.round(c, 6).alias(c) for c in ("threshold", "daily", "median_minute", "max_minute")], *[F.round(c, 4).alias(c) for c in ("typical_overshoot", "open_overshoot")], "exceeds")


@C.add(f"""WITH {BARS_SQL}, c AS (SELECT date, count(close) AS n FROM bars GROUP BY 1 ORDER BY date DESC LIMIT 30) SELECT max(date) FILTER (WHERE n >= 0.9 * (SELECT max(n) FROM c)) AS session FROM c""")
def hx09_last_complete_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest of the last 30 days on which at least 90 % of the usual number of symbols have a close."""
    return stats.last_complete_day(bars(spark, sf_dir, "close"), "date", "close", 30, 0.9)


@C.add("SELECT user_id, event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE value END AS number, CASE WHEN value IS NULL OR event_id % 7 = 0 OR event_id % 11 = 0 THEN '{\"event_id\":' || event_id || '}' ELSE '{\"event_id\":' || event_id || ',\"n\":' || floor(value)::int || '.0}' END AS js FROM events")
def hx11_finite_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that are not finite become null (HX13), also in JSON."""
    odd = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).when(F.col("event_id") % 11 == 0, F.lit(float("inf")))
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.coalesce(odd, F.col("value")).alias("v"), F.coalesce(odd, F.floor("value").cast("double")).alias("n"))
    return e.select("user_id", "event_id", text.finite(F.col("v")).alias("number"), text.json_row("event_id", "n", types={"n": "double"}).alias("js"))


@C.add("""WITH l AS (SELECT o_custkey AS k, bool_or(o_orderstatus = 'F') AS done, max(o_orderkey % 5) AS tries FROM orders WHERE o_orderpriority = '3-MEDIUM' GROUP BY 1)
SELECT c_custkey FROM customer LEFT JOIN l ON k = c_custkey WHERE done IS NULL OR (NOT done AND tries < 3)""")
def hx16_still_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that a resumed run takes up, by a ledger of attempts (SS07)."""
    ledger = table(spark, sf_dir, "orders").where("o_orderpriority = '3-MEDIUM'").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"), (F.col("o_orderkey") % 5).alias("attempts"))
    return matching.still_to_do(table(spark, sf_dir, "customer"), ledger, "c_custkey", "status", "attempts")


@C.add(f"""WITH {BARS_SQL}, p AS (SELECT symbol, date, dividends FROM bars WHERE dividends > 0), t AS (SELECT a.symbol, a.date, any_value(a.dividends) AS paid, median(b.dividends) AS usual FROM p a JOIN LATERAL
(SELECT dividends FROM p x WHERE x.symbol = a.symbol AND x.date < a.date ORDER BY x.date DESC LIMIT 4) b ON true GROUP BY 1, 2) SELECT symbol, date, round(usual, 6) AS usual, abs(paid / usual / 100 - 1) <= 0.01 AS hundredfold FROM t""")
def wn22_hundredfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments against the median of the four before, and whether they look a hundredfold."""
    return stats.against_last(bars(spark, sf_dir, "dividends").where("dividends > 0"), "symbol", "date", "dividends", 4).select("symbol", "date", F.round("usual", 6).alias("usual"), (F.abs(F.col("dividends") / F.col("usual") / 100 - 1) <= 0.01).alias("hundredfold"))


@C.add(f"""WITH {BARS_SQL}, t AS (SELECT symbol, date_trunc('month', date)::date AS mth, sum((high + low + close) / 3 * volume) AS dollars, sum(volume) AS shares FROM bars WHERE high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL GROUP BY 1, 2) SELECT symbol, mth, round(dollars / nullif(shares, 0), 4) AS vwap FROM t""")
def fn36_vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume-weighted mean of the typical price per symbol and month."""
    b = bars(spark, sf_dir, "high", "low", "close", "volume").where("high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL")
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    return b.groupBy("symbol", F.trunc("date", "MM").alias("mth")).agg(F.round(F.try_divide(F.sum(typical * F.col("volume")), F.sum("volume")), 4).alias("vwap"))
