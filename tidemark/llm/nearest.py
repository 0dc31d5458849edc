"""Nearest record in time of the same entity, by x-fast tries."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import buckets_for

#: A block of an entity's time line is 2**BLOCK_BITS microseconds, about 102 days.
BLOCK_BITS = 43
BUCKET_BYTES = 4 << 20
#: Groups of one trie; a bucket with more gets several tries, one after another, so that tables stay small.
TRIE_GROUPS = 1 << 16


class HashTable:
    """Open addressing over numpy arrays: 64-bit keys to row numbers."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.mask = (1 << max(4, int(2 * len(keys)).bit_length())) - 1
        self.keys = np.zeros(self.mask + 1, np.uint64)
        self.values = np.full(self.mask + 1, -1, np.int64)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.values[slot] < 0
            # Of several keys for a free slot the last written stays; the others move on.
            self.values[slot[free]] = values[left[free]]
            self.keys[slot[free]] = keys[left[free]]
            lost = self.values[slot] != values[left]
            left, slot = left[lost], (slot[lost] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        # Groups lie in the high bits and prefixes in the low ones: both must reach the bits that are used.
        mixed = (keys ^ (keys >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed >> np.uint64(20)) & np.uint64(self.mask)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            value = self.values[slot]
            match = (value >= 0) & (self.keys[slot] == keys[left])
            out[left[match]] = value[match]
            go_on = (value >= 0) & ~match
            left, slot = left[go_on], (slot[go_on] + 1) & self.mask
        return out


def most_groups(bits: int) -> int:
    """How many groups fit into 64-bit keys beside prefixes of ``bits`` bits and their mark."""
    return 1 << (63 - bits)


class XFastTrie:
    """x-fast tries of many groups in shared hash tables.

    ``group`` (integers below ``most_groups(bits)``, as a key holds group and prefix) and ``time`` (non-negative, below 2**bits) are
    sorted together and without repeats. For each prefix length there is a hash
    table from (group, prefix) to the first leaf below; leaves are linked by
    their order.
    """

    def __init__(self, group: np.ndarray, time: np.ndarray, bits: int):
        if len(group) and group[-1] >= most_groups(bits):
            raise ValueError(f"group {group[-1]} does not fit into a key beside {bits} bits of time")
        self.group, self.time, self.bits = group, time, bits
        self.tables, self.ends = [], []
        for length in range(bits + 1):
            key = self._key(group, time, np.full(len(time), length))
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.array([], int)
            node = np.arange(len(first))
            self.tables.append(HashTable(key[first], node))
            self.ends.append((first, np.append(first[1:], len(key)) - 1 if len(first) else first))

    def _key(self, group: np.ndarray, time: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The group and the first ``length`` bits of the time, marked by a leading one."""
        prefix = (time >> (self.bits - length)) | (np.int64(1) << length)
        return (group.astype(np.uint64) << np.uint64(self.bits + 1)) | prefix.astype(np.uint64)

    def neighbours(self, group: np.ndarray, time: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf at or before and leaf at or after each query, or -1."""
        low = np.full(len(time), -1, np.int64)
        high = np.full(len(time), self.bits, np.int64)
        node = np.full(len(time), -1, np.int64)
        # Binary search for the longest prefix that is in a table; low is the longest found.
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_] + 1) // 2
            key = self._key(group[open_], time[open_], middle)
            found = np.full(len(open_), -1, np.int64)
            for length in np.unique(middle):
                at = np.flatnonzero(middle == length)
                found[at] = self.tables[length].get(key[at])
            hit = found >= 0
            low[open_[hit]], node[open_[hit]] = middle[hit], found[hit]
            high[open_[~hit]] = middle[~hit] - 1
        before, after = np.full(len(time), -1, np.int64), np.full(len(time), -1, np.int64)
        for length in np.unique(low[low >= 0]):
            at = np.flatnonzero(low == length)
            first, last = self.ends[length][0][node[at]], self.ends[length][1][node[at]]
            if length == self.bits:
                before[at] = after[at] = first
                continue
            # All leaves below lie on the other side of the query's next bit.
            above = (time[at] >> (self.bits - 1 - length)) & 1 == 1
            before[at] = np.where(above, last, first - 1)
            after[at] = np.where(above, last + 1, first)
        for side in (before, after):
            side[side >= len(self.time)] = -1
            known = side >= 0
            side[known] = np.where(self.group[side[known]] == group[known], side[known], -1)
        return before, after


def _groups(*columns: pa.Table) -> list[np.ndarray]:
    """The (entity, field, block) of each table's rows as small integers, the same over all."""
    both = pa.concat_tables([c.select(["entity", "field", "block"]) for c in columns]).combine_chunks()
    code = np.zeros(both.num_rows, np.int64)
    for name in ("entity", "field", "block"):
        own = both.column(name).combine_chunks().dictionary_encode()
        code = np.unique(code * (len(own.dictionary) + 1) + own.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1].astype(np.int64)
    return np.split(code, np.cumsum([c.num_rows for c in columns])[:-1])


def _neighbours(group: np.ndarray, time: np.ndarray, q_group: np.ndarray, q_time: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``XFastTrie.neighbours`` for any number of groups: one trie after another, each of as many as fit."""
    before, after = np.full(len(q_time), -1, np.int64), np.full(len(q_time), -1, np.int64)
    step = min(TRIE_GROUPS, most_groups(bits))
    order = np.argsort(q_group, kind="stable")
    for start in range(0, int(group[-1]) + 1, step):
        here = slice(*np.searchsorted(group, [start, start + step]))
        asked = order[slice(*np.searchsorted(q_group, [start, start + step], sorter=order))]
        if here.start == here.stop or not len(asked):
            continue
        found = XFastTrie(group[here] - start, time[here], bits).neighbours(q_group[asked] - start, q_time[asked])
        for side, leaf in zip((before, after), found, strict=True):
            side[asked] = np.where(leaf >= 0, leaf + here.start, -1)
    return before, after


def _match_bucket(bits: int):
    def run(queries: pa.Table, records: pa.Table) -> pa.Table:
        shape = pa.schema([("query", pa.int64()), ("field", pa.string()), ("record", pa.int64())])
        if not queries.num_rows or not records.num_rows:
            return shape.empty_table()
        q_group, r_group = _groups(queries, records)
        base = lambda t: t.column("block").to_numpy().astype(np.int64) << bits
        wide = bits + 2  # a record may lie one block before or after: shifted by a block, all offsets fit
        r_time = records.column("at").to_numpy() - base(records) + (1 << bits)
        q_time = queries.column("at").to_numpy() - base(queries) + (1 << bits)
        ids = records.column("record").to_numpy()
        order = np.lexsort((ids, r_time, r_group))
        g, t, ids = r_group[order], r_time[order], ids[order]
        # Of records at the same time the smallest id stands for all.
        first = np.concatenate(([True], (g[1:] != g[:-1]) | (t[1:] != t[:-1])))
        g, t, ids = g[first], t[first], ids[first]
        before, after = _neighbours(g, t, q_group, q_time, wide)
        tolerance = queries.column("tolerance").to_numpy()
        far = np.int64(1) << np.int64(62)
        gap = lambda leaf: np.where(leaf >= 0, np.abs(t[leaf] - q_time), far)
        left, right = gap(before), gap(after)
        pick = np.where((right < left) | ((right == left) & (ids[after] < ids[before])), after, before)
        ok = np.minimum(left, right) <= tolerance
        return pa.table([queries.column("query").filter(pa.array(ok)), queries.column("field").filter(pa.array(ok)), pa.array(ids[pick[ok]], pa.int64())], schema=shape)

    return run


def nearest_in_time(
    queries: DataFrame,
    query_id: str,
    query_entity: Column,
    records: DataFrame,
    record_id: str,
    record_entity: Column,
    fields: Sequence[tuple[str, int]],
    block_bits: int = BLOCK_BITS,
    buckets: int | None = None,
) -> DataFrame:
    """For each query and field the record of the same entity nearest in time.

    ``fields``: (timestamp column of both tables, tolerance in microseconds).
    Columns: query, field, record; queries without a record within the tolerance
    (bounds included) yield none. At equal distance the smaller record id.

    An entity's time line is cut into blocks of 2**block_bits microseconds, no
    shorter than the tolerance; a record goes to its own block and, where it
    lies within the tolerance of an edge, to the block beyond. So a hot entity
    is spread over its blocks. (entity, field, block) are hashed into buckets;
    in each, timestamps become x-fast tries in hash tables, and predecessor and
    successor are found by binary search over prefix lengths.

    Cases: null ids, entities or times take no part. Repeated rows count once.
    An exact match is at distance 0. Other columns are not read.
    """
    if any(tolerance > 1 << block_bits for _, tolerance in fields):
        raise ValueError("a block must be at least as long as the tolerance")

    def long_form(df: DataFrame, key: str, entity: Column, name: str) -> DataFrame:
        values = F.array(*[F.struct(F.lit(f).alias("field"), F.unix_micros(F.col(f).cast("timestamp")).alias("at"), F.lit(t).cast("long").alias("tolerance")) for f, t in fields])
        rows = df.select(F.col(key).cast("long").alias(name), entity.alias("entity"), F.inline(values)).where(f"{name} IS NOT NULL AND entity IS NOT NULL AND at IS NOT NULL")
        return rows.distinct()

    q = long_form(queries, query_id, query_entity, "query").withColumn("block", F.shiftright("at", block_bits))
    r = long_form(records, record_id, record_entity, "record")
    spread = F.array_distinct(F.transform(F.array(-F.col("tolerance"), F.lit(0).cast("long"), F.col("tolerance")), lambda s: F.shiftright(F.col("at") + s, block_bits)))
    r = r.select("record", "entity", "field", "at", F.explode(spread).alias("block"))
    n = buckets or buckets_for(queries.select(query_id, *[f for f, _ in fields]), BUCKET_BYTES, least=int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.pmod(F.xxhash64("entity", "field", "block"), F.lit(n)).alias("bucket")
    return q.groupBy(bucket).cogroup(r.groupBy(bucket)).applyInArrow(_match_bucket(block_bits), "query bigint, field string, record bigint")
