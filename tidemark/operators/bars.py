"""Bars that close on traded amounts, and signed volume."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.runs import sorted_runs
from tidemark.operators.scan import last_known, previous_row, running


def bar_ends(amount: np.ndarray, threshold: float) -> np.ndarray:
    """Last row of each bar: the sum restarts at zero after a bar, so what goes over is lost.

    Searches the running total for the next threshold, one step a bar.
    """
    total = np.cumsum(amount)
    ends, base = [], 0.0
    while True:
        at = int(np.searchsorted(total, base + threshold - 1e-9 * max(1.0, abs(base)), "left"))
        if at >= len(total):
            break
        ends.append(at)
        base = total[at]
    return np.array(ends, np.int64)


def threshold_bars(df: DataFrame, keys: list[str], order: list[str], price: str, volume: str, threshold: float, amount: Column | None = None) -> DataFrame:
    """Bars per key that close when ``amount`` (default volume) reaches the threshold.

    Columns: keys, bar, open, high, low, close, volume, rows, amount, complete.
    The rest after the last full bar is a bar with complete = false. Keys name a
    session, so a group is bounded by the session's length. Null amounts count
    as zero; negative ones too.
    """
    rows = df.select(*keys, *[c for c in order if c not in keys], F.col(price).cast("double").alias("_p"), F.col(volume).cast("double").alias("_v"), F.greatest(F.coalesce(amount if amount is not None else F.col(volume), F.lit(0.0)), F.lit(0.0)).cast("double").alias("_a"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keys)
    shape = f"{types}, bar int, open double, high double, low double, close double, volume double, rows bigint, amount double, complete boolean"

    def bars_of(key: tuple, table: pa.Table) -> list[pa.Array]:
        p, v, a = (table.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("_p", "_v", "_a"))
        ends = bar_ends(a, threshold)
        last = np.append(ends, len(a) - 1) if not len(ends) or ends[-1] < len(a) - 1 else ends
        first = np.concatenate(([0], last[:-1] + 1))
        columns = [pa.array([k] * len(last), table.schema.field(n).type) for n, k in zip(keys, key, strict=True)]
        lows, highs = np.fmin.reduceat(p, first), np.fmax.reduceat(p, first)
        values = (p[first], highs, lows, p[last], np.add.reduceat(np.nan_to_num(v), first))
        columns += [pa.array(np.arange(len(last)), pa.int32()), *[pa.array(x, pa.float64(), from_pandas=True) for x in values]]
        return [*columns, pa.array(last - first + 1, pa.int64()), pa.array(np.add.reduceat(a, first)), pa.array(np.arange(len(last)) < len(ends))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keys, "bar", "open", "high", "low", "close", "volume", "rows", "amount", "complete"]
        made: list[pa.RecordBatch] = []
        for key, table in sorted_runs(batches, keys):
            made.append(pa.RecordBatch.from_arrays(bars_of(key, table), names=names))
            if len(made) == 2000:
                yield from pa.Table.from_batches(made).combine_chunks().to_batches()
                made = []
        if made:
            yield from pa.Table.from_batches(made).combine_chunks().to_batches()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, shape)


def signed_volume(df: DataFrame, keys: list[str], order: list[str], price: str, volume: str, block: Column | None = None) -> DataFrame:
    """Volume signed by the last price move (at first +1) and its running sum.

    With ``block``, a coarsening of the order (a day, say), no task orders all
    rows of a key: state is handed on from block to block.
    """
    placed = df.withColumn("_block", block if block is not None else F.lit(0))
    moved = previous_row(placed, keys, "_block", order, price, "_prior").withColumn("_move", F.nullif(F.signum(F.col(price) - F.col("_prior")), F.lit(0.0)))
    signed = last_known(moved, keys, "_block", order, "_move", "_last").withColumn("sign", F.coalesce("_last", F.lit(1.0))).withColumn("signed", F.col("sign") * F.col(volume))
    return running(signed, keys, "_block", order, "signed", "imbalance").drop("_block", "_prior", "_move", "_last")
