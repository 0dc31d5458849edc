"""Structured Streaming: windows, deduplication, stream-static joins and order books."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.orderbook import MINUTE, SNAPSHOT, Book, advance, snapshot_frame
from tidemark.session import shared_dir


def windowed_totals(stream: DataFrame, ts: str, keys: list[str], value: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Count and sum per tumbling window and keys; rows later than ``late`` are dropped."""
    w = stream.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return w.select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def sessions(stream: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    w = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return w.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def deduplicated(stream: DataFrame, ts: str, keys: list[str], within: str = "1 hour") -> DataFrame:
    """The first row per key; repeats within the watermark's reach are dropped, so state stays bounded."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)


def with_known_interval(stream: DataFrame, day: str, key: str, intervals: DataFrame) -> DataFrame:
    """Stream rows of days that an interval of the static table (key, start_date, end_eff) covers."""
    rest = [c for c in intervals.columns if c not in (key, "start_date", "end_eff") and c not in stream.columns]
    i = intervals.select(F.col(key).alias("_key"), F.col("start_date").alias("_from"), F.col("end_eff").alias("_to"), *rest)
    return stream.join(i, (F.col(key) == F.col("_key")) & F.col(day).between(F.col("_from"), F.col("_to"))).drop("_key", "_from", "_to")


def _book_step(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    books: dict[str, Book] = pickle.loads(state.get[0]) if state.exists else {}
    rows = pd.concat(list(frames)).sort_values(["ts", "seq"])
    minutes = sorted({t // MINUTE for t in rows["ts"].tolist()})
    out = []
    for symbol, own in rows.groupby("symbol"):
        out += advance(books.setdefault(symbol, Book()), symbol, *[own[c].tolist() for c in ("ts", "side", "price", "size")], minutes)
    for symbol, book in books.items():
        for minute in minutes:
            if minute > book.minute:
                if row := book.snapshot(symbol):
                    out.append(row)
                book.roll(minute)
    state.update((pickle.dumps(books),))
    if out:
        yield snapshot_frame(out)


def streamed_snapshots(messages: DataFrame) -> DataFrame:
    """Minute snapshots per session and symbol as messages (session, ts, seq, symbol, side, price, size) arrive.

    As in the batch form any symbol's message closes the minute of all books of
    its session, so a session is one key. The minute that is open at the end is
    written by ``books_to_end``. Messages later than their minute's end count in
    the open minute. A session's books stay in the state after its end.
    """
    return messages.groupBy("session").applyInPandasWithState(_book_step, SNAPSHOT, "books binary", "append", GroupStateTimeout.NoTimeout)


def books_to_end(messages: DataFrame) -> DataFrame:
    """All snapshots of the messages that are available now, those of the open minutes included."""
    spark: SparkSession = messages.sparkSession
    path = shared_dir(spark, "stream")
    closed = run_to_end(streamed_snapshots(messages), path=path)

    def open_minutes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for state in frame["books"]:
                out = [row for symbol, book in pickle.loads(state).items() if (row := book.snapshot(symbol))]
                if out:
                    yield snapshot_frame(out)

    states = spark.read.format("statestore").load(f"{path}-state")
    return closed.unionByName(states.select(F.col("value.groupState.books").alias("books")).mapInPandas(open_minutes, SNAPSHOT))


def run_to_end(stream: DataFrame, mode: str = "append", path: str | None = None) -> DataFrame:
    """All that is available now, written as Parquet with a checkpoint in the shared folder, and read back."""
    spark: SparkSession = stream.sparkSession
    out = path or shared_dir(spark, "stream")
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").outputMode(mode).trigger(availableNow=True).start()
    else:
        query = stream.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).option("checkpointLocation", f"{out}-state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
