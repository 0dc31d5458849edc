"""A schema-enforced Parquet lake: coercion, validation, keyed merges, partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def coerce(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """The declared columns in order: extra ones dropped, absent ones null, unreadable cells null."""
    have = dict(df.dtypes)
    return df.select(*[(F.expr(f"try_cast(`{c}` AS {t})") if c in have else F.lit(None).cast(t)).alias(c) for c, t in schema.items()])


def validate(
    df: DataFrame,
    required: Sequence[str] = (),
    positive: Sequence[str] = (),
    not_negative: Sequence[str] = (),
    at_least: Sequence[tuple[str, str]] = (),
    unique_on: Sequence[str] = (),
    least_rows: int = 0,
    most_rows: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """One row per rule with the number of breaches: rule, breaches.

    All rules but the duplicates are counted in one pass. With ``strict`` the
    report is computed and any breach raises ValueError.
    """
    missing = [c for c in required if c not in df.columns]
    checks: dict[str, Column] = {f"missing {c}": F.lit(1) for c in missing}
    checks |= {f"null {c}": F.count_if(F.col(c).isNull()) for c in required if c not in missing}
    checks |= {f"not positive {c}": F.count_if(F.col(c) <= 0) for c in positive}
    checks |= {f"negative {c}": F.count_if(F.col(c) < 0) for c in not_negative}
    checks |= {f"{a} below {b}": F.count_if(F.col(a) < F.col(b)) for a, b in at_least}
    checks["too few rows"] = F.when(F.count("*") < least_rows, 1).otherwise(0)
    if most_rows is not None:
        checks["too many rows"] = F.when(F.count("*") > most_rows, 1).otherwise(0)
    counts = df.agg(*[c.cast("bigint").alias(f"c{i}") for i, c in enumerate(checks.values())])
    report = counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"c{i}").alias("breaches")) for i, n in enumerate(checks)])))
    if unique_on:
        doubles = df.groupBy(*unique_on).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("breaches"))
        report = report.unionByName(doubles.select(F.lit("duplicate key").alias("rule"), "breaches"))
    if strict and (bad := report.where("breaches > 0").collect()):
        raise ValueError("; ".join(f"{r.rule}: {r.breaches}" for r in bad))
    return report


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``; null key parts compare equal."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    top = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_top"))
    return top.select(*[c if c in keys else F.col(f"_top.{c}").alias(c) for c in df.columns])


def merge(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert by key with the stored schema; an incoming row wins whole.

    Columns that ``incoming`` lacks altogether keep their stored values (a
    column that is there but null overwrites). Without every key column nothing
    is carried forward. One full outer join; repeated incoming keys are reduced
    to their greatest row first.
    """
    absent = [c for c in stored.columns if c not in incoming.columns]
    have_key = all(k in incoming.columns for k in keys)
    if not have_key:
        return stored.unionByName(incoming, allowMissingColumns=True)
    own = keep_last(incoming.select(*[c for c in stored.columns if c in incoming.columns]), keys, [])
    s, i = stored.withColumn("_stored", F.lit(True)), own.withColumn("_new", F.lit(True))
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys]
    joined = s.alias("s").join(i.alias("i"), on, "full_outer")
    pick = [F.col(f"s.{c}") if c in absent else F.when(F.col("i._new"), F.col(f"i.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in stored.columns]
    return joined.select(*pick)


def relabelled(stored: DataFrame, returned: DataFrame, identity: Sequence[str], label: str) -> DataFrame:
    """Stored rows without those that ``returned`` issues again under another label.

    A row that is not returned at all stays.
    """
    r = returned.select(*identity, F.col(label).alias("_label")).distinct()
    labels = r.groupBy(*identity).agg(F.collect_set("_label").alias("_labels"))
    return stored.join(labels, list(identity), "left").where(F.col("_labels").isNull() | F.array_contains("_labels", F.col(label))).drop("_labels")


def write_partitioned(df: DataFrame, path: str, partitions: Mapping[str, Column], sort: Sequence[str], mode: str = "overwrite") -> None:
    """Write sorted zstd files below partition folders; only partitions with rows are replaced.

    Rows are gathered by partition so that each gets few files; empty input
    leaves the table as it is. ``ignore`` keeps what exists.
    """
    if df.isEmpty():
        return
    made = df.withColumns(dict(partitions))
    names = list(partitions)
    (
        made.repartition(*names)
        .sortWithinPartitions(*names, *sort)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", 131_072)
        .partitionBy(*names)
        .parquet(path)
    )


def read_months(spark: SparkSession, path: str, schema: T.StructType, day: str, first: str | None, last: str | None) -> DataFrame:
    """A table laid out by year and month, read only where [first, last] can lie.

    Columns that no file has come out null; the partition columns are dropped.
    """
    full = T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
    df = spark.read.schema(full).parquet(path)
    at = F.col("year") * 100 + F.col("month")
    for bound, keep, same in ((first, lambda b: at >= b, lambda b: F.col(day) >= b), (last, lambda b: at <= b, lambda b: F.col(day) <= b)):
        if bound:
            df = df.where(keep(int(bound[:4]) * 100 + int(bound[5:7]))).where(same(F.lit(bound).cast("date")))
    return df.drop("year", "month")


def replace_slice(stored: DataFrame, incoming: DataFrame, slice_keys: Sequence[str]) -> DataFrame:
    """Stored rows outside the slices that ``incoming`` covers, and all of ``incoming``."""
    covered = incoming.select(*slice_keys).distinct()
    return stored.join(covered, list(slice_keys), "left_anti").unionByName(incoming)


def overlay(base: DataFrame, live: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` taken from ``live`` where it has a non-empty value."""
    own = live.groupBy(key).agg(*[F.max(F.nullif(F.trim(c), F.lit(""))).alias(f"_{c}") for c in columns])
    joined = base.join(own, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in columns}).drop(*[f"_{c}" for c in columns])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)




def align_days(column: Column, kind: str) -> Column:
    """Days, times and their spellings in one column as the declared type (date or timestamp); what can't be read is null."""
    return F.coalesce(column.try_cast(kind), F.try_to_timestamp(column.cast("string")).cast(kind))


def write(df: DataFrame, path: str, schema: Mapping[str, str], mode: str = "overwrite", keys: Sequence[str] = (), sort: Sequence[str] = (), allow_empty: bool = False) -> str:
    """Coerce and write a dataset; says what was done: written, merged, skipped (it exists) or empty.

    ``merge`` upserts by ``keys`` into what is stored, ``skip_if_exists`` leaves
    that alone. Empty input writes nothing unless allowed. The old files stay
    until the new ones are complete: both are written beside and renamed.
    """
    if mode not in ("overwrite", "merge", "skip_if_exists"):
        raise ValueError(f"unknown mode {mode}")
    spark = df.sparkSession
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = system.exists(target)
    if there and mode == "skip_if_exists":
        return "skipped"
    rows = coerce(df, schema)
    if not allow_empty and rows.isEmpty():
        return "empty"
    merging = there and mode == "merge"
    if merging:
        rows = merge(spark.read.schema(", ".join(f"`{c}` {t}" for c, t in schema.items())).parquet(path), coerce_present(df, schema), keys)
    beside, old = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{suffix}") for suffix in ("new", "old"))
    for left in (beside, old):
        system.delete(left, True)
    (rows.sortWithinPartitions(*sort) if sort else rows).write.option("compression", "zstd").parquet(beside.toString())
    if there:
        system.rename(target, old)
    system.rename(beside, target)
    system.delete(old, True)
    return "merged" if merging else "written"


def coerce_present(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """The declared columns that are there, each as declared; absent ones stay absent, so that a merge keeps what is stored."""
    return coerce(df, {c: t for c, t in schema.items() if c in df.columns})
