"""Point-in-time reads: intervals, what was known, and joins that never look ahead.

All operators take column names, return lazy frames and leave join strategies to
Catalyst; nothing is broadcast by hint, since no side here has a fixed size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.scan import last_known
from tidemark.session import fits_one_task

OPEN_END = "9999-12-31"


def latest_version(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row with the greatest ``version`` per key; null versions are the oldest.

    Ties go to the greatest row. Reduced before the shuffle, so a key that is
    delivered over and over stays small.
    """
    rest = [c for c in df.columns if c not in keys and c != version]
    held = df.groupBy(*keys).agg(F.max(F.struct(version, *rest)).alias("_held"))
    return held.select(*[c if c in keys else F.col(f"_held.{c}").alias(c) for c in df.columns])


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in a total order (Catalyst limits groups before the shuffle)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest_known(df: DataFrame, keys: Sequence[str], valid: str, known: str, as_of: Column, n: int = 1, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` latest facts per key among those known by ``as_of``.

    The filter on the known time comes before the ranking: a later restatement
    can't hide what was known. Facts without a known time are never known.
    """
    known_facts = df.where(F.col(known).isNotNull() & (F.col(known) <= as_of))
    return top_per_key(known_facts, keys, [F.desc(valid), F.desc(known), *[F.desc(t) for t in ties]], n)


def covers(day: Column, start: str, end: str, inclusive: bool = True) -> Column:
    """Whether a day lies in [start, end], or [start, end) where not ``inclusive``; a null end is open."""
    last = F.coalesce(F.col(end), F.lit(OPEN_END).cast("date"))
    return (F.col(start) <= day) & ((last >= day) if inclusive else (last > day))


def members_on(members: DataFrame, day: Column, inclusive: bool = True) -> DataFrame:
    return members.where(covers(day, "start_date", "end_date", inclusive)).select("symbol").distinct()


def membership_changes(members: DataFrame, first: Column, last: Column) -> DataFrame:
    """Additions and removals with their days, within [first, last]."""
    added = members.where(F.col("start_date").between(first, last)).select("symbol", F.col("start_date").alias("day"), F.lit("added").alias("change_type"))
    removed = members.where(F.col("end_date").between(first, last)).select("symbol", F.col("end_date").alias("day"), F.lit("removed").alias("change_type"))
    return added.unionByName(removed)


def interval_join(events: DataFrame, key: str, day: str, intervals: DataFrame, start: str, end: str, how: str = "inner", inclusive: bool = True) -> DataFrame:
    """Events with the intervals of the same key that cover their day.

    ``inner`` gives a row for each covering interval, ``left_semi`` each event once.
    """
    i = intervals.select(F.col(key).alias("_key"), F.col(start).alias("_start"), F.col(end).alias("_end"), *[c for c in intervals.columns if c not in (key, start, end) and c not in events.columns])
    on = (events[key] == F.col("_key")) & covers(events[day], "_start", "_end", inclusive)
    joined = events.join(i, on, how)
    return joined.drop("_key") if how == "left_semi" else joined.drop("_key").withColumnsRenamed({"_start": f"matched_{start}", "_end": f"matched_{end}"})


def as_of_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, values: Sequence[str], strict: bool = False, tolerance_days: int | None = None, prefix: str = "asof_", spread: bool | None = None
) -> DataFrame:
    """Each left row with the right row last before it (at it too, unless ``strict``).

    Both sides are stacked and sorted by time within a key, and the last right
    row is carried forward. Where a key could be more than a task should order
    (``spread``), that is done within months, and a row for each month carries on
    from one to the next. Times are dates or timestamps. With a tolerance older
    rows give null. Right rows at equal times: the greatest values win. Left
    columns are kept.
    """
    packed = F.struct(F.col(right_at).alias("at"), *values)
    stacked = left.select(*[F.col(k) for k in keys], F.col(left_at).alias("_at"), F.lit(0 if strict else 1).alias("_side"), F.struct(*left.columns).alias("_left"), F.lit(None).cast(right.select(packed.alias("p")).schema["p"].dataType).alias("_right")).unionByName(
        right.groupBy(*keys, right_at).agg(F.max(packed).alias("_right")).select(*keys, F.col(right_at).alias("_at"), F.lit(1 if strict else 0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("p")).schema["p"].dataType).alias("_left"), "_right")
    )
    if not fits_one_task(left, right) if spread is None else spread:
        carried = last_known(stacked.withColumn("_month", F.trunc("_at", "MM")), keys, "_month", ["_at", "_side"], "_right", "_last")
    else:
        carried = stacked.withColumn("_last", F.last("_right", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)))
    found = carried.where(F.col("_left").isNotNull())
    ok = F.lit(True) if tolerance_days is None else F.datediff(F.col("_at").cast("date"), F.col("_last.at").cast("date")) <= tolerance_days
    return found.select("_left.*", *[F.when(ok, F.col(f"_last.{v}")).alias(f"{prefix}{v}") for v in values])


def snapshot_as_of(df: DataFrame, snapshot: str, day: Column) -> DataFrame:
    """The rows of the latest snapshot at or before a day."""
    latest = df.where(F.col(snapshot) <= day).agg(F.max(snapshot).alias("_latest"))
    return df.join(latest, F.col(snapshot) == F.col("_latest")).drop("_latest")


def snapshot_validity(df: DataFrame, snapshot: str) -> DataFrame:
    """Each snapshot day with the days for which it is the latest: snapshot, valid_from, valid_to.

    Days before the first snapshot use the first.
    """
    w = Window.orderBy(snapshot)  # one row a snapshot
    return df.select(snapshot).distinct().select(
        snapshot,
        F.when(F.lag(snapshot).over(w).isNotNull(), F.col(snapshot)).alias("valid_from"),
        F.date_sub(F.lead(snapshot).over(w), 1).alias("valid_to"),
    )


def islands(df: DataFrame, key: str, day: str) -> DataFrame:
    """Runs of consecutive days per key: key, first_day, last_day, days."""
    days = df.select(key, F.col(day).cast("date").alias("d")).distinct()
    run = days.withColumn("island", F.date_sub("d", F.row_number().over(Window.partitionBy(key).orderBy("d"))))
    return run.groupBy(key, "island").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count("*").alias("days")).drop("island")


def intervals_from_snapshots(df: DataFrame, key: str, snapshot: str) -> DataFrame:
    """Membership intervals out of snapshots: a key stays while it is in consecutive ones.

    The interval ends with the last snapshot that has the key, and is open where
    that is the newest of all.
    """
    order = df.select(snapshot).distinct().withColumn("nth", F.row_number().over(Window.orderBy(snapshot)))
    newest = order.agg(F.max("nth").alias("newest"))
    seen = df.select(key, snapshot).distinct().join(order, snapshot)
    run = seen.withColumn("island", F.col("nth") - F.row_number().over(Window.partitionBy(key).orderBy("nth")))
    spans = run.groupBy(key, "island").agg(F.min(snapshot).alias("start_date"), F.max(snapshot).alias("last_seen"), F.max("nth").alias("last_nth"))
    return spans.crossJoin(newest).select(key, "start_date", F.when(F.col("last_nth") < F.col("newest"), F.col("last_seen")).alias("end_date"))


def key_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys added, removed and unchanged between two sets."""
    o = old.select(key).distinct().withColumn("_old", F.lit(True))
    n = new.select(key).distinct().withColumn("_new", F.lit(True))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("unchanged")
    return o.join(n, key, "full_outer").select(key, change.alias("change"))


def rows_not_in(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't stored yet; null key parts compare equal."""
    s = stored.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)]).distinct()
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & df[k].eqNullSafe(s[f"_s{i}"])
    return df.join(s, on, "left_anti")
