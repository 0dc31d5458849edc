"""Literal fixtures for operators that SQL cannot express or that keep state."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tidemark.functions import dates, options, text
from tidemark.operators import bars, contracts, matching, orderbook, pit, quarters, scan, stats, writer
from tidemark.plans import scalar_queries
from tidemark.sources.lake import Lake
from tidemark.streaming import streams

DAY = date(2024, 3, 4)


def test_option_values():
    """Put-call parity, the way back from price to volatility, and sensitivities as slopes."""
    rng = np.random.default_rng(1)
    n = 400
    spot, strike, years, rate, dividend, vol = (rng.uniform(a, b, n) for a, b in ((40, 160), (50, 150), (0.2, 2), (0, 0.08), (0, 0.05), (0.15, 0.9)))
    call, put = options.price(spot, strike, years, rate, dividend, vol, True), options.price(spot, strike, years, rate, dividend, vol, False)
    assert np.abs(call - put - spot * np.exp(-dividend * years) + strike * np.exp(-rate * years)).max() < 1e-10
    seen = options.greeks(spot, strike, years, rate, dividend, vol, True)["vega"] > 0.02
    assert np.abs(options.implied_volatility(spot, strike, years, rate, dividend, call, True) - vol)[seen].max() < 1e-4
    assert np.isnan(options.implied_volatility(spot, strike, years, rate, dividend, spot * 2, True)).all()
    h = 1e-4
    for is_call in (True, False):
        g = options.greeks(spot, strike, years, rate, dividend, vol, is_call)
        p = lambda s=0.0, t=0.0, r=0.0, v=0.0: options.price(spot + s, strike, years + t, rate + r, dividend, vol + v, is_call)  # noqa: B023, E731
        for name, up, down, scale in (("delta", p(s=h), p(s=-h), 1), ("vega", p(v=h), p(v=-h), 100), ("theta", p(t=-h), p(t=h), 365), ("rho", p(r=h), p(r=-h), 100)):
            assert np.abs((up - down) / (2 * h) / scale - g[name]).max() < 1e-4


def test_analysed_contracts_price_back(spark):
    """What is solved prices back to the quote; each fault of a quote is told."""
    rows = [
        ("fair", 50.0, 52.0, 0.4, 2.9, 3.1, None, True), ("no bid", 50.0, 52.0, 0.4, 0.0, 3.0, None, True), ("only last", 50.0, 52.0, 0.4, None, None, 2.5, False), ("nothing", 50.0, 52.0, 0.4, None, float("nan"), None, True),
        ("crossed", 50.0, 52.0, 0.4, 3.2, 3.0, None, True), ("wide", 50.0, 52.0, 0.4, 1.0, 3.0, None, True), ("below", 90.0, 52.0, 0.4, 30.0, 31.0, None, True), ("past", 50.0, 52.0, 0.0, 2.0, 2.1, None, True),
        ("no spot", None, 52.0, 0.4, 2.0, 2.1, None, True), ("deep", 90.0, 52.0, 0.4, 38.9, 39.1, None, True), ("too dear", 50.0, 52.0, 0.4, 49.0, 51.5, None, True),
    ]
    df = spark.createDataFrame(rows, "id string, spot double, strike double, years double, bid double, ask double, last double, is_call boolean").withColumns({"rate": F.lit(0.03), "q": F.lit(0.01)})
    got = {r.id: r for r in contracts.analyse_contracts(df, "spot", "strike", "years", "rate", "q", "bid", "ask", "last", "is_call").collect()}
    labels = {k: r.quality_flags for k, r in got.items()}
    assert labels == {
        "fair": "ok", "no bid": "zero_bid", "only last": "zero_bid", "nothing": "bad_input", "crossed": "crossed_market", "wide": "wide_spread", "below": "below_intrinsic|deep_itm", "past": "expired",
        "no spot": "bad_input", "deep": "deep_itm", "too dear": "no_solution",
    }
    assert {k for k, r in got.items() if r.iv_usable} == {"fair", "deep"}
    for k in ("fair", "deep"):
        r = got[k]
        assert abs(options.price(r.spot, r.strike, r.years, r.rate, r.q, r.iv, r.is_call) - r.mid_price) < 1e-4 and r.iv_uncertainty > 0
    assert got["no bid"].mid_price == 1.5 and got["no bid"].delta is None and got["nothing"].mid_price is None


def test_threshold_bars(spark):
    at = datetime(2024, 3, 4, 14, 30)
    amounts = [700, 300, 650, 4000, 100, 200, 700, 1, 2]  # 1000, then 4650 (what goes over is lost), 1000, and a rest of 3
    rows = [("A", DAY, at + timedelta(minutes=i), 50 - i, v) for i, v in enumerate(amounts)] + [("B", DAY, at, 7.0, 999), ("C", DAY, at, 7.0, 1000), ("C", DAY, at + timedelta(minutes=1), 8.0, None)]
    df = spark.createDataFrame([(s, d, t, float(p), v) for s, d, t, p, v in rows], "symbol string, session date, at timestamp, close double, volume long")
    out = {(r.symbol, r.bar): (r.rows, r.amount, r.complete, r.open, r.close) for r in bars.threshold_bars(df, ["symbol", "session"], ["at"], "close", "volume", 1_000).collect()}
    assert out == {
        ("A", 0): (2, 1000.0, True, 50.0, 49.0), ("A", 1): (2, 4650.0, True, 48.0, 47.0), ("A", 2): (3, 1000.0, True, 46.0, 44.0), ("A", 3): (2, 3.0, False, 43.0, 42.0),
        ("B", 0): (1, 999.0, False, 7.0, 7.0), ("C", 0): (1, 1000.0, True, 7.0, 7.0), ("C", 1): (1, 0.0, False, 8.0, 8.0),
    }


def test_tick_rule(spark):
    df = spark.createDataFrame([("A", i, p, v) for i, (p, v) in enumerate([(7.0, 3.0), (7.0, 1.0), (6.5, 2.0), (6.5, 5.0), (6.8, 1.0), (6.8, 4.0), (6.1, 2.0)])], "s string, i int, p double, v double")
    got = bars.signed_volume(df, ["s"], ["i"], "p", "v").orderBy("i").collect()
    assert [r.sign for r in got] == [1, 1, -1, -1, 1, 1, -1] and [r.imbalance for r in got] == [3, 4, 2, -3, -2, 2, 0]


def test_quarters_from_year_to_date(spark):
    """A year of facts that run on, one filed again with another value, one missing, and a single quarter beside."""
    ends = [date(2022, 3, 31), date(2022, 6, 30), date(2022, 9, 30), date(2022, 12, 31)]
    start, filed = date(2022, 1, 1), [e + timedelta(33) for e in ends]
    rows = [("A", start, e, v, f) for e, v, f in zip(ends, [8.0, 19.0, 37.0, 64.0], filed, strict=True)] + [("A", start, ends[1], 20.0, filed[3])]
    rows += [("B", start, ends[0], 5.0, filed[0]), ("B", start, ends[2], 30.0, filed[2]), ("B", date(2022, 10, 1), ends[3], 6.0, filed[3]), ("B", None, ends[3], 1.0, filed[3])]
    out = quarters.quarterly(spark.createDataFrame(rows, "k string, s date, e date, v double, known date"), "k", "s", "e", "v", "known")
    got = {(r.k, r.quarter_end): (r.value, r.known) for r in out.collect()}
    assert got == {("A", e): (v, f) for e, v, f in zip(ends, [8, 11, 18, 27], filed, strict=True)} | {("B", ends[0]): (5, filed[0]), ("B", ends[3]): (6, filed[3])}


def test_ladder_median(spark):
    rows = [("even", k, p) for k, p in ((10.0, 0.9), (20.0, 0.6), (30.0, 0.2))] + [("bumpy", k, p) for k, p in ((1.0, 0.8), (2.0, 0.5), (3.0, 0.6), (4.0, 0.1))] + [("never", 1.0, 0.9), ("below", 1.0, 0.3)]
    got = {r.e: r.median for r in quarters.ladder_median(spark.createDataFrame(rows, "e string, k double, p double"), "e", "k", "p").collect()}
    assert abs(got["even"] - 22.5) < 1e-9 and abs(got["bumpy"] - (3 + 0.05 / 0.45)) < 1e-9 and got["never"] is None and got["below"] is None


def test_time_weighted_book():
    """Spread 2 for 3 s and 4 for 1 s; nothing for the first update, a one-sided book, or the time after the last update."""
    s = 1_000_000_000
    messages = [(1, "buy", 20.0, 8), (2, "sell", 22.0, 4), (3, "buy", 19.0, 9), (5, "sell", 22.0, 0), (6, "sell", 24.0, 8), (7, "buy", 18.0, 1), (30, "trade", 21.0, 3), (125, "trade", 21.0, 5)]
    book = orderbook.Book()
    rows = orderbook.advance(book, "A", *map(list, zip(*[(t * s, *rest) for t, *rest in messages], strict=True)), minutes=[0, 1, 2])
    first, second = (dict(zip(orderbook._NAMES, r, strict=True)) for r in rows)
    assert (first["twa_spread"], first["quoted_seconds"], first["n_updates"], first["n_trades"], first["trade_notional"]) == (2.5, 4.0, 6, 1, 63.0)
    assert abs(first["twa_imbalance"] - (3 * 4 / 12 + 0) / 4) < 1e-12 and (first["best_ask"], first["bid_px_2"], first["bid_sz_3"], first["ask_px_2"]) == (24.0, 19.0, 1.0, None)
    assert (second["minute"], second["best_bid"], second["n_updates"], second["twa_mid"]) == (1, 20.0, 0, None) and (book.minute, book.trades, book.volume) == (2, 1, 5)


def test_book_tops_equal_a_plain_rebuild():
    rng = np.random.default_rng(4)
    n = 3000
    ts = np.sort(rng.integers(0, 20 * orderbook.MINUTE, n)).tolist()
    sides = rng.choice(["buy", "sell", "trade"], n, p=[0.45, 0.45, 0.1]).tolist()
    prices = [float(p) for p in np.where(np.array(sides) == "buy", rng.integers(90, 102, n), rng.integers(99, 111, n))]
    sizes = rng.choice([0, 0, 1, 5], n).tolist()
    rows = orderbook.advance(orderbook.Book(), "A", ts, sides, prices, sizes)
    for row in rows:
        got = dict(zip(orderbook._NAMES, row, strict=True))
        bids, asks, area, quoted, last = {}, {}, 0.0, 0, None
        for t, side, price, size in zip(ts, sides, prices, sizes, strict=True):
            if t // orderbook.MINUTE > got["minute"] or side == "trade":
                continue
            if t // orderbook.MINUTE == got["minute"]:
                if last is not None and bids and asks and max(bids) < min(asks):
                    area, quoted = area + (min(asks) - max(bids)) * (t - last), quoted + t - last
                last = t
            levels = bids if side == "buy" else asks
            levels[price] = size
            if not size:
                del levels[price]
        assert got["best_bid"] == (max(bids) if bids else None) and got["best_ask"] == (min(asks) if asks else None)
        assert abs(got["quoted_seconds"] - quoted / 1e9) < 1e-9 and (got["twa_spread"] is None) == (quoted == 0) and (not quoted or abs(got["twa_spread"] - area / quoted) < 1e-9)


def test_segments_are_decoded_alike():
    """Segments of equal messages, read at once, and mixed ones, read one by one."""
    pack = lambda kind, ts, name, size, price: orderbook.LEVEL_MESSAGE.pack(kind, 0, ts, name.ljust(8).encode(), size, price)
    block = lambda body: len(body).to_bytes(2, "little") + body
    head = bytes(orderbook.SEGMENT_HEADER)
    messages = [pack(k, i, s, i * 3, 10_500 + i) for i, (k, s) in enumerate([(orderbook.BUY, "AB"), (orderbook.TRADE, "AB"), (0x53, "AB"), (orderbook.SELL, "C.D")])]
    plain, mixed = head + b"".join(map(block, messages)), head + b"".join(map(block, [*messages, b"\x53xyz"]))
    want = [(0, "AB", "buy", 1.05, 0), (1, "AB", "trade", 1.0501, 3), (3, "C.D", "sell", 1.0503, 9)]
    for payloads, n in (([plain], 1), ([mixed], 1), ([plain, None, mixed, head, b""], 2)):
        assert list(zip(*[c.to_pylist() for c in orderbook._columns(payloads)], strict=True)) == want * n


def test_claimed_events_by_brute_force(spark):
    rng = np.random.default_rng(6)
    periods = [("A", date(2020, 3, 31) + timedelta(int(91 * i + rng.integers(-20, 20))), None if i % 3 else date(2020, 3, 31) + timedelta(91 * i + 45)) for i in range(12)]
    events = [("A", date(2020, 3, 1) + timedelta(int(d)), int(n)) for n, d in enumerate(rng.integers(0, 1200, 60))] + [("A", None, 99), ("B", date(2020, 1, 1), 5)]
    got = {(r.close, r.day, r.event) for r in matching.claim_latest(spark.createDataFrame(periods, "k string, close date, filed date"), spark.createDataFrame(events, "k string, day date, event long"), "k", "close", "filed", "day", "event").collect()}
    left, want = {}, set()
    for _, d, n in sorted((e for e in events if e[0] == "A" and e[1]), key=lambda e: e[2], reverse=True):
        left[d] = n
    for _, close, filed in sorted(periods, key=lambda p: p[1]):
        fit = [d for d in left if close + timedelta(7) <= d <= min(close + timedelta(75), filed + timedelta(2) if filed else date.max)]
        if fit:
            want.add((close, max(fit), left.pop(max(fit))))
    assert got == want and len(got) > 6
    none = spark.createDataFrame([], "k string, day date, event long")
    assert matching.claim_latest(spark.createDataFrame(periods, "k string, close date, filed date"), none, "k", "close", "filed", "day", "event").count() == 0


def test_expected_releases(spark):
    """Three quarters known: the next close is 91 days on; its release comes from the calendar, the one after from the usual lag."""
    past = [("A", date(2023, 3, 31), date(2023, 4, 20), None), ("A", date(2023, 6, 30), None, date(2023, 7, 30)), ("A", date(2023, 9, 30), date(2023, 10, 25), None), ("B", date(2023, 9, 30), None, None)]
    calendar = [("A", date(2024, 1, 2)), ("A", date(2024, 1, 29)), ("A", date(2024, 2, 9)), ("C", date(2024, 2, 9))]
    out = matching.expected_releases(spark.createDataFrame(past, "symbol string, fiscal_close date, release_date date, report_filed date"), spark.createDataFrame(calendar, "symbol string, date date"), "2024-01-05")
    got = [tuple(r)[1:] for r in out.orderBy("fiscal_close").collect()]
    assert got == [
        (date(2023, 3, 31), date(2023, 4, 20), "released"), (date(2023, 6, 30), date(2023, 7, 30), "filed"), (date(2023, 9, 30), date(2023, 10, 25), "released"),
        (date(2023, 12, 30), date(2024, 1, 29), "calendar"), (date(2024, 3, 29), date(2024, 4, 23), "estimated"),
    ]


def test_batch_books_follow_the_feed(spark):
    minute = orderbook.MINUTE
    rows = [("d", 0, 0, "A", "buy", 1.0, 5), ("d", 1, 1, "A", "sell", 2.0, 5), ("d", 3 * minute, 2, "B", "trade", 1.0, 1), ("d", 4 * minute, 3, "A", "buy", 1.0, 0)]
    df = spark.createDataFrame(rows, "session string, ts long, seq long, symbol string, side string, price double, size long")
    got = {(r.symbol, r.minute): r.best_bid for r in orderbook.minute_snapshots(df).collect()}
    assert got == {("A", 0): 1.0, ("A", 3): 1.0, ("A", 4): None}  # the resting book in another symbol's minute; no row for an empty book


def test_merge_truth_table(spark):
    stored = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 9.0)], "k int, s string, v double")
    incoming = spark.createDataFrame([(1, None), (3, "c"), (3, "d"), (None, "m")], "k int, s string")
    want = {(1, None, 1.0), (2, "b", 2.0), (3, "d", None), (None, "m", 9.0)}
    once = writer.merge(stored, incoming, ["k"])
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in writer.merge(once, incoming, ["k"]).collect()}
    assert writer.merge(stored, incoming.limit(0), ["k"]).count() == 3


def test_write_modes(spark, tmp_path):
    path, schema = f"file://{tmp_path}/t", {"k": "int", "v": "double", "w": "string"}
    rows = lambda: sorted(map(tuple, spark.read.parquet(path).select("k", "v", "w").collect()))
    df = spark.createDataFrame([(2, "1.5", "a"), (1, "x", "b")], "k int, v string, w string")
    assert writer.write(df.limit(0), path, schema) == "empty" and not (tmp_path / "t").exists()
    assert writer.write(df, path, schema, sort=["k"]) == "written" and rows() == [(1, None, "b"), (2, 1.5, "a")]
    new = spark.createDataFrame([(2, 7.0), (3, 8.0)], "k int, v double")
    assert writer.write(new, path, schema, "merge", ["k"]) == "merged" and rows() == [(1, None, "b"), (2, 7.0, "a"), (3, 8.0, None)]
    assert writer.write(new, path, schema, "skip_if_exists") == "skipped" and len(rows()) == 3
    assert writer.write(new.limit(0), path, schema, allow_empty=True) == "written" and rows() == []
    with pytest.raises(ValueError):
        writer.write(new, path, schema, "append")
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_partitioned_write_and_pruned_read(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([("A", date(2024, m, 5), float(m)) for m in range(1, 13)], "s string, day date, v double")
    parts = {"year": F.year("day"), "month": F.month("day")}
    writer.write_partitioned(df, path, parts, ["s"])
    writer.write_partitioned(df.where("month(day) = 3").withColumn("v", F.lit(0.0)), path, parts, ["s"])
    writer.write_partitioned(df.limit(0), path, parts, ["s"])
    back = writer.read_months(spark, path, df.schema, "day", "2024-02-10", "2024-04-05")
    assert sorted(r.v for r in back.collect()) == [0.0, 4.0]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_validation_can_be_strict(spark):
    df = spark.createDataFrame([(1, -1.0), (1, None)], "k int, v double")
    got = {r.rule: r.breaches for r in writer.validate(df, ["k", "v", "gone"], positive=["v"], unique_on=["k"]).collect()}
    assert (got["null v"], got["missing gone"], got["not positive v"], got["duplicate key"]) == (1, 1, 1, 1)
    with pytest.raises(ValueError):
        writer.validate(df, positive=["v"], strict=True)


def test_sliced_ranks_and_quantiles_equal_the_plain_ones(spark):
    """Ties, nulls, a hot group, a group of one and one without values: slices change nothing."""
    rng = np.random.default_rng(2)
    rows = [("hot" if i % 3 else f"g{i % 5}", None if i % 11 == 0 else float(rng.integers(0, 60)), float(rng.normal())) for i in range(900)] + [("one", 1.0, 2.0), ("none", None, 1.0), (None, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double")
    ranks = [{tuple(r) for r in stats.with_average_ranks(df, ["g"], {"a": "ra", "b": "rb"}, slices=7, sliced=s).where("g IS NOT NULL").collect()} for s in (False, True)]
    assert ranks[0] == ranks[1] and len(ranks[0]) > 700
    shares = [0.0, 0.025, 0.5, 0.8, 1.0]
    plain, sliced = ({r.g: (r.n, [round(x, 9) for x in r.q]) for r in stats.exact_quantiles(df.where("g IS NOT NULL"), ["g"], "a", shares, slices=7, sliced=s).collect()} for s in (False, True))
    assert plain == sliced and set(plain) == {"hot", "one", *[f"g{k}" for k in range(5)]}
    hot = [a for g, a, _ in rows if g == "hot" and a is not None]
    assert np.allclose(plain["hot"][1], np.quantile(hot, shares))


def test_two_level_scans_equal_one_window(spark):
    rng = np.random.default_rng(3)
    rows = [(f"k{i % 2}", int(d), i, None if i % 4 == 0 else float(rng.normal())) for i, d in enumerate(rng.integers(0, 9, 200))] + [(None, 1, 900, 1.0), (None, 2, 901, None)]
    df = spark.createDataFrame(rows, "k string, d int, i int, v double")
    w = Window.partitionBy("k").orderBy("d", "i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = {r.i: r for r in df.select("i", F.lag("v").over(w).alias("lag"), F.last("v", True).over(upto).alias("last"), F.sum("v").over(upto).alias("sum"), F.max("v").over(upto).alias("max")).collect()}
    got = scan.previous_row(df, ["k"], "d", ["i"], "v", "lag")
    got = scan.last_known(got, ["k"], "d", ["i"], "v", "last")
    got = scan.running(scan.running(got, ["k"], "d", ["i"], "v", "sum"), ["k"], "d", ["i"], "v", "max", "max")
    for r in got.collect():
        x = want[r.i]
        assert (r.lag, r.last, r.max) == (x.lag, x.last, x.max) and (r.sum is None) == (x.sum is None) and (r.sum is None or abs(r.sum - x.sum) < 1e-9)


@pytest.mark.parametrize("spread", [False, True])
def test_as_of_join_strictness_and_tolerance(spark, spread):
    left = spark.createDataFrame([("a", DAY), ("a", DAY + timedelta(9)), ("b", DAY), (None, DAY)], "k string, d date")
    right = spark.createDataFrame([("a", DAY, 1), ("a", DAY - timedelta(1), 2), ("a", DAY, 0)], "k string, at date, v int")
    run = lambda **m: {(r.k, r.d): r.asof_v for r in pit.as_of_join(left, right, ["k"], "d", "at", ["v"], spread=spread, **m).collect()}
    late = DAY + timedelta(9)
    assert run() == {("a", DAY): 1, ("a", late): 1, ("b", DAY): None, (None, DAY): None}
    assert run(strict=True)["a", DAY] == 2 and run(tolerance_days=5)["a", late] is None


def test_calendar_rules():
    assert dates.easter(2024) == date(2024, 3, 31) and dates.easter(2000) == date(2000, 4, 23) and dates.easter(1981) == date(1981, 4, 19)
    assert date(2021, 12, 31) not in dates.holidays(2021) and date(2022, 1, 1) not in dates.holidays(2022) and date(2023, 1, 2) in dates.holidays(2023)


def test_filing_text(spark):
    html = "<html><style>x</style><ix:header>h</ix:header><p>One  two</p><div style=\"display:none\">no</div><script>s</script><p>three</p></html>"
    got = spark.createDataFrame([(html,)], "h string").select(text.plain_text(F.col("h"))).first()[0]
    assert [x.strip() for x in got.split("\n") if x.strip()] == ["One two", "three"]


def test_lake(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(f"{tmp_path}/t")
    lake = Lake(spark, str(tmp_path), {"t": "x int, y string, z double", "none": "x int"})
    assert [tuple(r) for r in lake.sql("SELECT * FROM t").collect()] == [(1, "a", None)] and lake.columns_on_disk("t") == ["x", "y"]
    assert {r.dataset: r.n for r in lake.counts().collect()} == {"t": 1, "none": 0} and lake.files("t").count() >= 1
    assert lake.arrow("SELECT x FROM t WHERE x = ?", [1]).num_rows == 1
    lake.export("SELECT x FROM t", f"{tmp_path}/out.csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/out.csv").first().x == "1"


def test_plain_texts_are_returned(spark, tmp_path):
    texts = ["<p>Cut&nbsp;rates</p> \n <script>x()</script><b>now</b>", "no  markup", "<div style=\"display: none\">gone</div>", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.plain for r in scalar_queries.fn10_texts(spark, str(tmp_path)).collect()}
    assert got == {0: "Cut rates\nnow", 1: "no markup", 2: "", 3: ""}


def test_streamed_books_equal_the_batch_form(spark, tmp_path):
    """In two batches, with minutes of other symbols only, two sessions and open minutes at the end."""
    schema = "session date, ts long, seq long, symbol string, side string, price double, size long"
    at = lambda m, s: (m * 60 + s) * 1_000_000_000
    first = [(DAY, at(100, 1), 1, "A", "buy", 9.0, 5), (DAY, at(100, 30), 2, "A", "sell", 10.0, 7), (DAY, at(101, 0), 3, "B", "buy", 3.0, 1), (DAY, at(103, 5), 4, "B", "trade", 3.0, 2)]
    second = [(DAY, at(103, 50), 5, "A", "buy", 9.5, 1), (DAY, at(106, 0), 6, "B", "sell", 4.0, 1), (DAY + timedelta(days=1), at(1540, 0), 7, "A", "buy", 8.0, 1)]
    for k, part in enumerate((first, second)):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/m/b={k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/m/b=[01]")
    got, want = (sorted(map(tuple, df.collect()), key=repr) for df in (streams.books_to_end(stream), orderbook.minute_snapshots(spark.createDataFrame(first + second, schema))))
    assert got == want and len(got) == 4 + 3 + 1
