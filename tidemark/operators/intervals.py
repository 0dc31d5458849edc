"""Overlapping and gapped day intervals: continuous periods and the gaps between."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Day number of 9999-12-31, which stands for an open end.
OPEN_DAY = 2932896
#: Rows of a task that are combined at once before the first shuffle.
COMBINE_ROWS = 200_000
#: Partial lists of a key are first merged in this many groups.
FAN_IN = 16


def merge_lists(group: np.ndarray, first: np.ndarray, last: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted disjoint intervals of each group, from intervals or such lists.

    The state of the aggregate is the list (first, last, count), where count is
    the number of original intervals in a period. Merging is associative and
    commutative, so partial lists can be combined in any tree. A stable sort of
    runs that are sorted already merges them in linear time.
    """
    order = np.argsort(first, kind="stable")
    order = order[np.argsort(group[order], kind="stable")]
    g, a, b, n = group[order], first[order], last[order], count[order]
    if not len(g):
        return g, a, b, n
    # Running maximum of the ends within each group: groups ascend, so a shift by group keeps them apart.
    span = int(b.max() - min(a.min(), b.min())) + 2
    rank = np.concatenate(([0], np.cumsum(g[1:] != g[:-1]))).astype(np.int64)
    reach = np.maximum.accumulate(b + rank * span) - rank * span
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (a[1:] > reach[:-1] + 1)
    at = np.flatnonzero(fresh)
    return g[at], a[at], np.append(reach[at[1:] - 1], reach[-1]), np.add.reduceat(n, at)


def _state_table(keys: list[pa.Array], names: list[str], g: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for each group with its list."""
    at = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.array([], int)
    offsets = pa.array(np.append(at, len(g)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (a, b, n)]
    which = pa.array(g[at], pa.int64())
    return pa.RecordBatch.from_arrays([*[k.take(which) for k in keys], *lists], names=[*names, "firsts", "lasts", "counts"])


def _combine(table: pa.Table, keys: Sequence[str]) -> pa.RecordBatch:
    """One row per key with the merged list; ``table`` has partial lists in any order."""
    ids = np.zeros(table.num_rows, np.int64)
    for name in keys:
        codes = table.column(name).combine_chunks().dictionary_encode()
        ids = np.unique(ids * (len(codes.dictionary) + 1) + codes.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1].astype(np.int64)
    sizes = np.diff(table.column("firsts").combine_chunks().offsets.to_numpy())
    flat = [table.column(c).combine_chunks().flatten().to_numpy() for c in ("firsts", "lasts", "counts")]
    sample = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
    sample[ids] = np.arange(len(ids))
    named = [table.column(k).combine_chunks().take(pa.array(sample)) for k in keys]
    return _state_table(named, list(keys), *merge_lists(np.repeat(ids, sizes), *flat))


def _combine_all(keys: Sequence[str]):
    """Combine whatever a task holds, some rows at a time; for partial results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= COMBINE_ROWS:
                held = [_combine(pa.Table.from_batches(held), keys)]
                if held[0].num_rows * 2 >= COMBINE_ROWS:
                    yield held.pop()
        if held and sum(b.num_rows for b in held):
            yield _combine(pa.Table.from_batches(held), keys)

    return run


def _combine_sorted(keys: Sequence[str]):
    """Combine rows that are sorted by key, keeping back the last key of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            merged = _combine(pa.Table.from_batches([rest, batch] if rest is not None else [batch]), keys)
            final = [batch.column(k)[-1] for k in keys]
            tail = next(i for i in range(merged.num_rows - 1, -1, -1) if all(merged.column(k)[i] == v for k, v in zip(keys, final, strict=True)))
            rest = merged.slice(tail, 1)
            others = [merged.slice(0, tail), merged.slice(tail + 1)]
            yield from (o for o in others if o.num_rows)
        if rest is not None:
            yield rest

    return run


def interval_lists(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The mergeable aggregate: one row per key with sorted disjoint intervals.

    ``df`` has string ``keys`` (not null) and day numbers ``first`` and ``last``
    (long). Lists are combined inside each task, then in FAN_IN groups per key,
    then per key: no task ever sees the rows of a hot key, only its lists. A
    list of disjoint, non-adjacent day intervals has at most one entry for two
    days of the calendar, which bounds it whatever the number of rows.
    """
    shape = ", ".join(f"`{k}` string" for k in keys) + ", firsts array<bigint>, lasts array<bigint>, counts array<bigint>"
    single = df.select(*keys, F.array("first").alias("firsts"), F.array("last").alias("lasts"), F.array(F.lit(1).cast("long")).alias("counts"))
    partial = single.mapInArrow(_combine_all(keys), shape).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))
    grouped = partial.repartition(*keys, "salt").drop("salt").mapInArrow(_combine_all(keys), shape)
    return grouped.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_combine_sorted(keys), shape)


def holding_intervals(df: DataFrame, keys: dict[str, Column], start: str, end: str, version: str) -> DataFrame:
    """The version of each (keys, start) that became known last, with days as numbers.

    A null end or 9999-12-31 is open. Versions that end before they start are
    dropped after the choice, so they still replace an older one. At equal
    versions the later end holds; a null version is the oldest. Rows with a null
    key or start name no interval and are left out.
    """
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long")
    rows = df.select(
        *[c.alias(k) for k, c in keys.items()],
        day(F.col(start)).alias("first"),
        F.struct(F.col(version).alias("version"), F.coalesce(day(F.col(end)), F.lit(OPEN_DAY).cast("long")).alias("last")).alias("held"),
    ).where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, "first"]))
    held = rows.groupBy(*keys, "first").agg(F.max("held").alias("held"))
    return held.select(*keys, "first", F.col("held.last").alias("last")).where("last >= first")


def periods_and_gaps(lists: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Continuous periods and the gaps between neighbours, from interval lists.

    Columns: keys, ``kind`` (period, gap), ``first_day``, ``last_day`` (date; null
    where a period is open), ``intervals`` (how many made the period; null for gaps).
    """
    day = lambda n: f"date_add(date'1970-01-01', cast({n} as int))"
    items = lists.select(
        *keys,
        F.expr(
            f"""concat(
            transform(arrays_zip(firsts, lasts, counts), x -> struct('period' as kind, {day("x.firsts")} as first_day,
                if(x.lasts >= {OPEN_DAY}, null, {day("x.lasts")}) as last_day, x.counts as intervals)),
            if(size(firsts) < 2, array(), transform(arrays_zip(slice(lasts, 1, size(lasts) - 1), slice(firsts, 2, size(firsts) - 1)),
                x -> struct('gap' as kind, {day("x.`0` + 1")} as first_day, {day("x.`1` - 1")} as last_day, cast(null as bigint) as intervals))))"""
        ).alias("items"),
    )
    return items.select(*keys, F.inline("items"))


def merge_intervals(df: DataFrame, keys: dict[str, Column], start: str, end: str, version: str) -> DataFrame:
    """Periods and gaps of the intervals that hold. See the parts for the cases."""
    return periods_and_gaps(interval_lists(holding_intervals(df, keys, start, end, version), list(keys)), list(keys))
