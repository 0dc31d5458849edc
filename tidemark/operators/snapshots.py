"""What changed between consecutive full snapshots, by content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import shared_dir

#: A key whose hash is 0 modulo this starts a chunk.
CHUNK_KEYS = 64


def _tag_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name each row's chunk by the boundary key at or before it in key order.

    The rows of a task are sorted by key over all snapshots, so snapshots agree
    on the chunks of a key range; the first key of a task is a boundary too.
    """
    current: str | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key")
        edge = batch.column("edge").to_numpy(zero_copy_only=False).astype(bool)
        if current is None:
            edge[0] = True
        at = np.maximum.accumulate(np.where(edge, np.arange(len(edge)), -1))
        named = pc.take(key, pa.array(np.where(at < 0, None, at), pa.int64()))
        chunk = pc.fill_null(named, current) if current is not None else named
        current = chunk[-1].as_py()
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], chunk], names=[*batch.schema.names[:-1], "chunk"])


def snapshot_changes(
    df: DataFrame,
    snapshot: str,
    key: Column,
    attributes: dict[str, Column],
    version: str,
    chunk_keys: int = CHUNK_KEYS,
) -> DataFrame:
    """Rows added, removed or changed between each snapshot and the one before.

    Columns: ``snapshot`` (the later one), ``key``, ``change`` (added, removed,
    changed) and ``fields`` (names of the attributes that differ). Snapshots are
    sorted by key over range partitions and cut into chunks where the hash of a
    key says so; a chunk whose row count and two 64-bit digests equal those of
    the previous snapshot is dropped unread, and only rows of other chunks are
    joined by key and compared value by value.

    Cases: the row with the latest ``version`` holds per snapshot and key (null
    is the oldest; at equal versions the greatest attributes). Null differs from
    a value and equals null. Rows without snapshot or key are left out. The
    first snapshot yields nothing. A snapshot in which a key range vanished
    yields its rows as removed. Repeated rows count once.
    """
    names = list(attributes)
    rows = df.select(
        F.col(snapshot).alias("snapshot"),
        key.alias("key"),
        F.struct(F.col(version).alias("version"), *[c.alias(n) for n, c in attributes.items()]).alias("held"),
    ).where("snapshot IS NOT NULL AND key IS NOT NULL")
    latest = rows.groupBy("snapshot", "key").agg(F.max("held").alias("held"))
    values = F.struct(*[F.col(f"held.{n}").alias(n) for n in names])
    flat = latest.select("snapshot", "key", values.alias("attrs"), F.pmod(F.xxhash64("key"), F.lit(chunk_keys)).alias("edge"))
    sorted_rows = flat.repartitionByRange("key").sortWithinPartitions("key", "snapshot")
    schema = "snapshot date, key string, attrs struct<" + ",".join(f"`{n}`:string" for n in names) + ">, chunk string"
    tagged = sorted_rows.select("snapshot", "key", "attrs", (F.col("edge") == 0).alias("edge")).mapInArrow(_tag_chunks, schema)
    # Chunk names follow from where tasks begin, so they are settled once and read back by all that use them.
    tagged_at = shared_dir(df.sparkSession, "chunks")
    tagged.write.parquet(tagged_at)
    tagged = df.sparkSession.read.schema(schema).parquet(tagged_at)

    # One row a snapshot: at most as many as there were deliveries.
    in_order = Window.orderBy("snapshot")
    days = latest.select("snapshot").distinct().select(
        "snapshot", F.lead("snapshot").over(in_order).alias("next"), F.when(F.lag("snapshot").over(in_order).isNotNull(), F.col("snapshot")).alias("own")
    )

    def digest(seed: int) -> Column:
        return F.bit_xor(F.xxhash64(F.lit(seed), "key", *[F.coalesce(f"attrs.{n}", F.lit("\0")) for n in names], *[F.col(f"attrs.{n}").isNull() for n in names]))

    chunks = tagged.groupBy("chunk", "snapshot").agg(F.count("*").alias("n"), digest(1).alias("d1"), digest(2).alias("d2"))

    def on_pair(frame: DataFrame) -> DataFrame:
        """Each row as the later side of its own snapshot and the earlier side of the next."""
        sides = F.array(*[F.struct(F.col(c).alias("pair"), F.lit(late).alias("later")) for c, late in (("own", True), ("next", False))])
        return frame.join(days, "snapshot").select(*frame.columns, F.inline(sides)).where("pair IS NOT NULL")

    unmatched = (
        on_pair(chunks)
        .groupBy("chunk", "pair")
        .agg(F.count("*").alias("sides"), *[f(c).alias(f"{s}_{c}") for c in ("n", "d1", "d2") for s, f in (("lo", F.min), ("hi", F.max))])
        .where("NOT (sides = 2 AND lo_n = hi_n AND lo_d1 = hi_d1 AND lo_d2 = hi_d2)")
        .select("chunk", "pair")
    )
    left = on_pair(tagged).join(unmatched, ["chunk", "pair"], "left_semi").select("pair", "key", "attrs", "later")
    new = left.where("later").select("pair", "key", F.col("attrs").alias("new"), F.lit(True).alias("in_new"))
    old = left.where("NOT later").select("pair", "key", F.col("attrs").alias("old"), F.lit(True).alias("in_old"))
    differing = F.array_compact(F.array(*[F.when(~F.col(f"new.{n}").eqNullSafe(F.col(f"old.{n}")), F.lit(n)) for n in names]))
    return (
        new.join(old, ["pair", "key"], "full_outer")
        .withColumn("change", F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").otherwise("changed"))
        .withColumn("fields", F.when(F.col("change") == "changed", differing))
        .where("change != 'changed' OR size(fields) > 0")
        .select(F.col("pair").alias("snapshot"), "key", "change", "fields")
    )
