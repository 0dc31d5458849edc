"""Attributes as known at event time: an as-of join against what was known."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import buckets_for

#: Estimated bytes of events for each bucket of entities.
BUCKET_BYTES = 4 << 20


def known_states(versions: Iterable[tuple[str, int, int, int, str | None]]) -> list[tuple[str, int, str | None]]:
    """Disjoint states (entity, valid from, value) out of versions with precedence.

    ``versions``: (entity, from, to, start, value), days as numbers, both ends
    inclusive. On each day the version with the latest start gives the value;
    where none covers a day the state is null. Sorted by entity and day.
    """
    out: list[tuple[str, int, str | None]] = []
    by_entity: dict[str, list[tuple[int, int, int, str | None]]] = {}
    for entity, since, until, start, value in versions:
        by_entity.setdefault(entity, []).append((since, until, start, value))
    for entity in sorted(by_entity):
        own = sorted(by_entity[entity], key=lambda v: v[0])
        days = sorted({v[0] for v in own} | {v[1] + 1 for v in own})
        heap: list[tuple[int, int, int]] = []
        at = 0
        for day in days:
            while at < len(own) and own[at][0] <= day:
                heapq.heappush(heap, (-own[at][2], at, own[at][1]))
                at += 1
            while heap and heap[0][2] < day:
                heapq.heappop(heap)
            out.append((entity, day, own[heap[0][1]][3] if heap else None))
    return out


def _join_bucket(events: pa.Table, versions: pa.Table) -> pa.Table:
    import duckdb

    columns = [versions.column(c).to_pylist() for c in ("entity", "since", "until", "start", "value")]
    states = known_states(zip(*columns, strict=True))
    state = pa.table({"entity": pa.array([s[0] for s in states], pa.string()), "since": pa.array([s[1] for s in states], pa.int32()), "value": pa.array([s[2] for s in states], pa.string())})  # noqa: F841
    bars = events.select(["entity", "day"])  # noqa: F841
    con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
    try:
        return con.execute("SELECT b.entity, b.day, s.value AS known FROM bars b ASOF LEFT JOIN state s ON b.entity = s.entity AND b.day >= s.since").to_arrow_table().cast(
            pa.schema([("entity", pa.string()), ("day", pa.int32()), ("known", pa.string())])
        )
    finally:
        con.close()


def attributes_known_at(
    events: DataFrame,
    event_entity: Column,
    event_day: str,
    versions: DataFrame,
    version_entity: Column,
    start: str,
    end: str,
    known: str,
    value: str,
    buckets: int | None = None,
) -> DataFrame:
    """Each event (entity, day) with the attribute valid and known on that day.

    A version is known from the UTC day of ``known`` on. Per (entity, start) the
    last version known by the day counts; of those that cover the day (both ends
    inclusive, null end open) the one with the latest start gives ``known``.

    Versions first get the days on which they are current: from the day they
    are known until the day before the next version of the same start, and
    within their own interval. Entities are hashed into buckets; in each, these
    are turned into disjoint states ordered by availability and joined by an
    embedded DuckDB ASOF LEFT JOIN. Events are reduced to distinct
    (entity, day) before the shuffle, so a hot entity has no more than the
    calendar has days.

    Cases: versions known on the same day are settled by the later ``known``
    time, then the later end, then the greater value. Null ``known``: never known; such a
    version is left out. Null entity, start or day: left out. Null value: the
    state is null. Events with nothing known get null. Other columns are not read.
    """
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    distinct = events.select(event_entity.alias("entity"), day(F.col(event_day)).alias("day")).where("entity IS NOT NULL AND day IS NOT NULL").distinct()
    rows = versions.select(
        version_entity.alias("entity"),
        day(F.col(start)).alias("start"),
        day(F.col(known).cast("date")).alias("seen"),
        F.struct(F.col(known).alias("at"), F.coalesce(day(F.col(end)), F.lit(2932896)).alias("last"), F.col(value).alias("value")).alias("held"),
    ).where("entity IS NOT NULL AND start IS NOT NULL AND seen IS NOT NULL")
    # Ties first: one version for each start and day on which something became known.
    settled = rows.groupBy("entity", "start", "seen").agg(F.max("held").alias("held"))
    following = F.lead("seen").over(Window.partitionBy("entity", "start").orderBy("seen"))
    current = settled.select("entity", "start", "seen", "held", (following - 1).alias("replaced")).select(
        "entity",
        F.greatest("seen", "start").alias("since"),
        F.least("held.last", F.coalesce("replaced", F.lit(2932896))).alias("until"),
        "start",
        F.col("held.value").alias("value"),
    ).where("until >= since")
    n = buckets or buckets_for(events.select(event_day), BUCKET_BYTES, least=int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.pmod(F.xxhash64("entity"), F.lit(n))
    joined = (
        distinct.groupBy(bucket.alias("bucket"))
        .cogroup(current.groupBy(bucket.alias("bucket")))
        .applyInArrow(_join_bucket, "entity string, day int, known string")
    )
    return joined.select("entity", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).alias("day"), "known")


def last_value_held(versions: DataFrame, entity: Column, start: str, end: str, known: str, value: str) -> DataFrame:
    """The value of each entity's row with the latest start, in hindsight.

    Of each (entity, start) the version known last holds; those that end before
    they start do not count. Columns: entity, final.
    """
    held = (
        versions.select(entity.alias("entity"), F.col(start).alias("start"), F.struct(F.col(known).alias("at"), F.coalesce(F.col(end), F.lit("9999-12-31").cast("date")).alias("last"), F.col(value).alias("value")).alias("held"))
        .where("entity IS NOT NULL AND start IS NOT NULL")
        .groupBy("entity", "start")
        .agg(F.max("held").alias("held"))
        .where("held.last >= start")
    )
    return held.groupBy("entity").agg(F.max(F.struct("start", "held.value")).alias("top")).select("entity", F.col("top.value").alias("final"))
