"""Order books from price-level messages: minute snapshots with time-weighted means."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.dates import in_session

# Message types and the layout of the depth feed.
BUY, SELL, TRADE = 0x38, 0x35, 0x54
LEVEL_MESSAGE = struct.Struct("<BBq8sIq")
PRICE_SCALE = 10_000
SEGMENT_HEADER = 40
MINUTE = 60_000_000_000
#: Levels of each side that a snapshot shows.
DEPTH = 5
_SIDES = {BUY: "buy", SELL: "sell", TRADE: "trade"}
_RECORD = np.dtype([("length", "<u2"), ("kind", "u1"), ("flags", "u1"), ("ts", "<i8"), ("name", "S8"), ("shares", "<u4"), ("price", "<i8")])
_LEVELS = [f"{side}_{what}_{n}" for n in range(1, DEPTH + 1) for side in ("bid", "ask") for what in ("px", "sz")]
SNAPSHOT = (
    "symbol string, minute bigint, best_bid double, best_ask double, spread double, mid double, microprice double, imbalance double, bid_depth double, ask_depth double, "
    "twa_spread double, twa_mid double, twa_imbalance double, quoted_seconds double, n_updates int, n_trades int, trade_volume bigint, trade_notional double, " + ", ".join(f"{c} double" for c in _LEVELS)
)
_NAMES = [c.split(" ")[0] for c in SNAPSHOT.split(", ")]
_ARROW = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "int": pa.int32()}[c.split(" ")[1]]) for n, c in zip(_NAMES, SNAPSHOT.split(", "), strict=True)])


class Book:
    """The book of one symbol, and what the open minute has gathered.

    Only a change at the best level makes the top be looked for again; time is
    credited when the top changes or the minute is cut, not with each message.
    """

    __slots__ = ("bids", "asks", "minute", "since", "last", "spread", "mid", "imbalance", "quoted", "updates", "trades", "volume", "notional", "top")

    def __init__(self) -> None:
        self.bids: dict[float, int] = {}
        self.asks: dict[float, int] = {}
        self.minute: int | None = None
        self.top: tuple[float, int, float, int] | None = None
        self._empty_minute(None)

    def _empty_minute(self, minute: int | None) -> None:
        self.minute, self.since, self.last = minute, None, None
        self.spread = self.mid = self.imbalance = self.notional = 0.0
        self.quoted = self.updates = self.trades = self.volume = 0

    def _credit(self) -> None:
        """Time from ``since`` to the last update belongs to the top as it stood."""
        if self.top is not None and self.since is not None and self.last > self.since:
            bid, bid_size, ask, ask_size = self.top
            dt = self.last - self.since
            self.spread += (ask - bid) * dt
            self.mid += (ask + bid) / 2 * dt
            self.imbalance += (bid_size - ask_size) / (bid_size + ask_size) * dt
            self.quoted += dt

    def _look(self) -> tuple[float, int, float, int] | None:
        """Best bid and ask with sizes; None where one-sided or crossed."""
        if not self.bids or not self.asks:
            return None
        bid, ask = max(self.bids), min(self.asks)
        return (bid, self.bids[bid], ask, self.asks[ask]) if bid < ask else None

    def take(self, ts: Sequence[int], sides: Sequence[str], prices: Sequence[float], sizes: Sequence[int]) -> None:
        """Messages of the open minute in order: a level is set to a size, 0 removes it."""
        bids, asks, top = self.bids, self.asks, self.top
        for at, side, price, size in zip(ts, sides, prices, sizes, strict=True):
            if side == "trade":
                self.trades += 1
                self.volume += size
                self.notional += price * size
                continue
            self.updates += 1
            self.last = at if self.last is None or at > self.last else self.last
            if self.since is None:
                self.since = at  # the first update of a minute has no time before it
            levels = bids if side == "buy" else asks
            if top is None or (price >= top[0] if side == "buy" else price <= top[2]):
                self._credit()
                self.since = self.last
                if size:
                    levels[price] = size
                else:
                    levels.pop(price, None)
                self.top = top = self._look()
            elif size:
                levels[price] = size
            else:
                levels.pop(price, None)

    def snapshot(self, symbol: str) -> tuple | None:
        """The open minute's row; none where the book is empty."""
        if not self.bids and not self.asks:
            return None
        self._credit()
        self.since = self.last
        bids = sorted(self.bids.items(), reverse=True)[:DEPTH]
        asks = sorted(self.asks.items())[:DEPTH]
        bid, ask = bids[0][0] if bids else None, asks[0][0] if asks else None
        spread = mid = micro = imbalance = None
        if bids and asks:
            b, a = bids[0][1], asks[0][1]
            spread, mid, micro, imbalance = ask - bid, (ask + bid) / 2, (bid * a + ask * b) / (a + b), (b - a) / (a + b)
        twa = [s / self.quoted for s in (self.spread, self.mid, self.imbalance)] if self.quoted else [None] * 3
        levels = [v for n in range(DEPTH) for side in (bids, asks) for v in ((side[n][0], float(side[n][1])) if n < len(side) else (None, None))]
        depth = [float(sum(size for _, size in side)) for side in (bids, asks)]
        return (symbol, self.minute, bid, ask, spread, mid, micro, imbalance, *depth, *twa, self.quoted / 1e9, self.updates, self.trades, self.volume, self.notional, *levels)

    def roll(self, minute: int) -> None:
        """Begin a minute: the book stays, the sums don't."""
        self._empty_minute(minute)


def advance(book: Book, symbol: str, ts: Sequence[int], sides: Sequence[str], prices: Sequence[float], sizes: Sequence[int], minutes: Iterable[int] = ()) -> list[tuple]:
    """Rows of the minutes that end before the last message's; ``minutes`` are those of the whole feed.

    A minute in which only other symbols had messages still gives a row of the
    resting book. Older times don't open a closed minute again: they count in
    the open one.
    """
    if not len(ts):
        return []
    out = []
    own = np.maximum.accumulate(np.asarray(ts, np.int64) // MINUTE)
    if book.minute is None:
        book.roll(int(own[0]))
    own = np.maximum(own, book.minute)
    edges = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
    todo, at = sorted(minutes), 0
    for start, end in zip(edges, edges[1:], strict=False):
        minute = int(own[start])
        while minute > book.minute:
            if row := book.snapshot(symbol):
                out.append(row)
            while at < len(todo) and todo[at] <= book.minute:
                at += 1
            book.roll(min(minute, todo[at]) if at < len(todo) else minute)
        book.take(ts[start:end], sides[start:end], prices[start:end], sizes[start:end])
    return out


def decode_payload(payload: bytes) -> list[tuple[int, str, str, float, int]]:
    """Messages of one segment: (ts, symbol, side, price, size); unknown types are skipped."""
    out, at = [], SEGMENT_HEADER
    while at + 2 <= len(payload):
        size = int.from_bytes(payload[at : at + 2], "little")
        body = payload[at + 2 : at + 2 + size]
        at += 2 + size
        if len(body) >= LEVEL_MESSAGE.size and body[0] in _SIDES:
            kind, _, ts, name, shares, price = LEVEL_MESSAGE.unpack_from(body)
            out.append((ts, name.decode("ascii").strip(), _SIDES[kind], price / PRICE_SCALE, shares))
    return out


def _columns(payloads: list[bytes | None]) -> list[pa.Array]:
    """Messages of many segments as columns; segments of equally long messages are read at once."""
    plain, rows = [], []
    for payload in payloads:
        body = (payload or b"")[SEGMENT_HEADER:]
        if body and len(body) % _RECORD.itemsize == 0:
            records = np.frombuffer(body, _RECORD)
            if (records["length"] == LEVEL_MESSAGE.size).all():
                plain.append(records)
                continue
        rows += decode_payload(payload or b"")
    parts = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 5, (pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64()), strict=True)]
    if not plain:
        return parts
    records = np.concatenate(plain)
    records = records[np.isin(records["kind"], list(_SIDES))]
    names, which = np.unique(records["name"], return_inverse=True)
    symbols = pa.array([n.decode("ascii").strip() for n in names.tolist()], pa.string()).take(pa.array(which))
    order = np.array(sorted(_SIDES))
    sides = pa.array([_SIDES[k] for k in order.tolist()]).take(pa.array(np.searchsorted(order, records["kind"])))
    read = [pa.array(records["ts"]), symbols, sides, pa.array(records["price"] / PRICE_SCALE), pa.array(records["shares"].astype(np.int64))]
    return [pa.concat_arrays([a, b]) for a, b in zip(read, parts, strict=True)]


def decode_segments(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Messages of binary segments: ts (nanoseconds), symbol, side, price, size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_columns(batch.column(0).to_pylist()), names=["ts", "symbol", "side", "price", "size"])

    return df.select(payload).mapInArrow(run, "ts bigint, symbol string, side string, price double, size bigint")


def minute_snapshots(messages: DataFrame, session: str = "session") -> DataFrame:
    """Batch reconstruction per symbol and session from (session, ts, seq, symbol, side, price, size).

    The minutes of a session are those in which any symbol had a message, at
    most 1,440; they are sent to each of its books once, beside the messages.
    """
    minute = F.floor(F.col("ts") / MINUTE).cast("bigint")
    minutes = messages.groupBy(session).agg(F.collect_set(minute).alias("minutes"))
    clock = messages.select(session, "symbol").distinct().join(minutes, session).select(F.col(session).alias("_session"), F.col("symbol").alias("_symbol"), "minutes")

    def run(own: pa.Table, clock: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _ARROW.empty_table()
        rows = own.sort_by([("ts", "ascending"), ("seq", "ascending")])
        symbol = rows.column("symbol")[0].as_py()
        todo = sorted(clock.column("minutes")[0].as_py())
        book = Book()
        out = advance(book, symbol, *[rows.column(c).to_pylist() for c in ("ts", "side", "price", "size")], todo)
        for minute in todo:
            if minute >= book.minute:
                if minute > book.minute:
                    book.roll(minute)
                if row := book.snapshot(symbol):
                    out.append(row)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _ARROW, strict=True)], schema=_ARROW) if out else _ARROW.empty_table()

    keys = [session, "symbol"]
    return messages.select(*keys, "ts", "seq", "side", "price", "size").groupBy(*keys).cogroup(clock.groupBy("_session", "_symbol")).applyInArrow(run, SNAPSHOT)


def minute_start(minute: Column) -> Column:
    return F.timestamp_seconds(minute * 60)


def in_market_hours(snapshots: DataFrame) -> DataFrame:
    """Snapshots of minutes from 09:30 to 16:00 in New York; what came before is in the books all the same."""
    return snapshots.where(in_session(minute_start(F.col("minute"))))


def replay(messages: DataFrame, path: str, session: str = "session", overwrite: bool = False) -> DataFrame:
    """Write the snapshots of each session to a folder of its own below ``path``; sessions that have one are skipped.

    Returns session and ``skipped``. A session's folder appears when all of it
    is written (Spark commits the job as a whole), so a run that broke off is
    taken up where it stopped. ``session`` is the UTC day of ``ts``.
    """
    spark: SparkSession = messages.sparkSession
    kind = messages.schema[session].dataType.simpleString()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [s.getPath().getName().split("=", 1)[1] for s in system.listStatus(root) if s.isDirectory() and "=" in s.getPath().getName()] if system.exists(root) else []
    done = spark.createDataFrame([(d,) for d in there], "d string").select(F.col("d").cast(kind).alias(session)) if there and not overwrite else None
    new = messages if done is None else messages.join(done, session, "left_anti")
    snapshots = minute_snapshots(new, session).withColumn(session, F.to_date(minute_start(F.col("minute"))).cast(kind))
    snapshots.repartition(session).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(session).parquet(path)
    every = new.select(session).distinct().withColumn("skipped", F.lit(False))
    return every if done is None else every.unionByName(done.withColumn("skipped", F.lit(True)))


def snapshot_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_NAMES)
