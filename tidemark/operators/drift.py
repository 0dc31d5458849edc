"""Schemas that drift between files: a catalogue of column lifespans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import checkpointed

#: Files of a feed that are ordered in one task.
BLOCK_FILES = 4096
# Other names under which producers land the declared columns.
ALIASES = {
    "symbol": ["ticker"],
    "adj_close": ["adjClose", "adjusted_close"],
    "volume": ["shares_traded", "vol"],
    "dividends": ["cash_dividend", "div_amount"],
    "repaired": ["is_repaired", "price_repaired", "repairFlag", "was_fixed"],
    "source": ["origin", "vendor"],
    "ingested_at": ["ingestTime", "loaded_at"],
    "stage": ["phase_name", "step"],
    "dataset": ["dataset_name", "ds", "feedName", "target_table"],
    "value_num": ["metric_value"],
    "passed": ["check_ok", "is_pass"],
    "recorded_at": ["logged_at"],
}
# The declared columns of each target.
TARGETS = {
    "ohlcv": {
        "symbol": "string", "date": "date", "open": "double", "high": "double", "low": "double", "close": "double", "adj_close": "double", "volume": "bigint",
        "dividends": "double", "stock_splits": "double", "repaired": "boolean", "source": "string", "ingested_at": "timestamp",
    },
    "quality": {
        "run_id": "string", "run_date": "date", "stage": "string", "dataset": "string", "metric": "string", "value_num": "double", "value_text": "string",
        "passed": "boolean", "recorded_at": "timestamp",
    },
}


def canonical_field(field: Column) -> Column:
    """The declared name of a field by the alias table; unknown names stay."""
    out = field
    for name, aliases in ALIASES.items():
        out = F.when(field.isin(aliases), F.lit(name)).otherwise(out)
    return out


def _kind(value: Column) -> Column:
    """boolean, integer, decimal, string, array, object, or null for a null value."""
    shape = F.schema_of_variant(value)
    return (
        F.when(shape == "BOOLEAN", "boolean")
        .when(shape.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), "decimal")
        .when(shape == "STRING", "string")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape.startswith("OBJECT"), "object")
    )


def file_catalogue(landed: DataFrame) -> DataFrame:
    """One row per file and field: kind, records with the key, records with a value.

    Stands for the metadata that columnar files carry in their footers; here the
    records are JSON, so it is gathered in one pass and a partial aggregate. A
    file whose values are of several kinds gets the widest (string, array,
    object, decimal, integer, boolean). Payloads that are no JSON object, null
    or have a key twice show no fields; they leave a row without a field, so
    that every file is there.
    """
    doc = F.try_parse_json("payload")
    rows = landed.where("feed IS NOT NULL AND file_id IS NOT NULL").select("feed", "target", "file_id", "landed_at", F.when(F.schema_of_variant(doc).startswith("OBJECT"), doc).alias("doc"))
    fields = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("doc").outer())).select("feed", "target", "file_id", "landed_at", F.col("key").alias("field"), _kind(F.col("value")).alias("kind"))
    widest = ["boolean", "integer", "decimal", "object", "array", "string"]
    order = F.lit(None).cast("int")
    for place, name in enumerate(widest):
        order = F.when(F.col("kind") == name, place).otherwise(order)
    found = fields.groupBy("feed", "file_id", "field").agg(
        F.max("target").alias("target"), F.min("landed_at").alias("landed_at"), F.max(order).alias("rank"), F.count("*").alias("records"), F.count("kind").alias("filled")
    )
    kind = F.lit(None).cast("string")
    for place, name in enumerate(widest):
        kind = F.when(F.col("rank") == place, name).otherwise(kind)
    return found.select("feed", "target", "file_id", "landed_at", "field", kind.alias("kind"), "records", "filled")


def file_sequence(files: DataFrame) -> DataFrame:
    """Per feed the files in order of landed_at and file_id: feed, file_id, nth (from 0), last.

    Files are numbered within a day, days are counted up: no task orders all
    files of a feed.
    """
    day = F.coalesce(F.to_date("landed_at"), F.lit("0001-01-01").cast("date")).alias("day")
    every = files.groupBy("feed", "file_id").agg(F.min("landed_at").alias("landed_at")).select("feed", "file_id", "landed_at", day)
    within = every.withColumn("within", F.row_number().over(Window.partitionBy("feed", "day").orderBy("landed_at", "file_id")))
    of_feed = Window.partitionBy("feed")
    days = every.groupBy("feed", "day").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(of_feed.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = days.select("feed", "day", before.alias("before"), (F.sum("n").over(of_feed) - 1).alias("last"))
    return within.join(days, ["feed", "day"]).select("feed", "file_id", (F.col("before") + F.col("within") - 1).alias("nth"), "last")


def _blocks(nth: str = "nth") -> Column:
    return F.expr(f"{nth} div {BLOCK_FILES}")


def carried_kinds(placed: DataFrame) -> DataFrame:
    """Adds ``carried``: the last kind of the column, through all-null files and renames, since it appeared.

    Within blocks of files by a window; the state at the end of a block, a row
    for each, is handed on to the next.
    """
    keys = ["feed", "canonical", "block"]
    inside = Window.partitionBy(*keys).orderBy("nth", "field")
    # '' marks where a column appears, so that no kind is carried over a removal.
    mark = F.coalesce("kind", F.when(F.lag("nth").over(inside) < F.col("nth") - 1, F.lit("")))
    own = placed.withColumn("block", _blocks()).withColumn("mark", mark).withColumn("own", F.last("mark", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    ends = own.groupBy(*keys).agg(F.min("nth").alias("first"), F.max("nth").alias("end"), F.max_by("own", F.struct("nth", "field")).alias("state"))
    blocks = Window.partitionBy("feed", "canonical").orderBy("block")
    entered = ends.withColumn("state", F.when(F.lag("end").over(blocks) == F.col("first") - 1, F.lag("state").over(blocks)).otherwise(F.lit("")))
    entered = entered.select(*keys, F.last("state", ignorenulls=True).over(blocks.rowsBetween(Window.unboundedPreceding, 0)).alias("entered"))
    return own.join(entered, keys).withColumn("carried", F.nullif(F.coalesce("own", "entered"), F.lit(""))).select(*placed.columns, "carried")


def field_lifespans(catalogue: DataFrame, files: DataFrame) -> DataFrame:
    """The catalogue (see ``file_catalogue``, ``file_sequence``) as islands: per producer, field and kind, runs of consecutive files.

    Columns: feed, file_id, nth, field, canonical, kind, carried, last, and
    ``before`` and ``after``: the carried kind (or '' for none) of the same field
    in the file before and in the one after, null where the field is not there. An
    island of a field starts where ``before`` is null and ends where ``after``
    is; one of a kind also where they differ. Both come from lag and lead within
    blocks of files; the rows at a block's edge are in both blocks.
    """
    fields = catalogue.where("field IS NOT NULL").withColumn("canonical", canonical_field(F.col("field")))
    placed = carried_kinds(fields.join(files, ["feed", "file_id"]).select("feed", "file_id", "nth", "last", "field", "canonical", "kind"))
    at = F.array(*[F.expr(f"(nth + {d}) div {BLOCK_FILES}") for d in (-1, 0, 1)])
    spread = placed.select("*", _blocks().alias("own_block"), F.explode(F.array_distinct(at)).alias("block"))
    order = Window.partitionBy("feed", "field", "block").orderBy("nth")
    beside = lambda f, d: F.when(f("nth").over(order) == F.col("nth") + d, F.coalesce(f("carried").over(order), F.lit("")))
    linked = spread.select("*", beside(F.lag, -1).alias("before"), beside(F.lead, 1).alias("after"))
    return linked.where("block = own_block").select("feed", "file_id", "nth", "last", "field", "canonical", "kind", "carried", "before", "after")


def schema_changes(landed: DataFrame) -> DataFrame:
    """Every change of a file against the previous file of its feed.

    Columns: feed, file_id, change (added, removed, renamed, retyped), old_field,
    new_field, old_kind, new_kind. Islands that end in a file and islands that
    start in it are paired as renamed where the alias table gives them the same
    column and their kinds agree (a field without a kind agrees with any).

    Cases: repeated rows change nothing. The first file of a feed has no
    changes. A file without a single readable record has lost every field. If
    several names of one column end or start at once, they pair in the order of
    names; the rest are added or removed.
    """
    # Payloads are read once; what is known of the files is small and kept.
    catalogue = checkpointed(file_catalogue(landed))
    files = file_sequence(catalogue)
    spans = field_lifespans(catalogue, files)
    event = lambda change, nth, kind: F.struct(F.lit(change).alias("change"), nth.alias("nth"), kind.alias("kind"))
    retyped = (F.col("before") != "") & F.col("carried").isNotNull() & (F.col("before") != F.col("carried"))
    log = F.array_compact(
        F.array(
            F.when(F.col("before").isNull() & (F.col("nth") > 0), event("start", F.col("nth"), F.col("kind"))),
            F.when(F.col("after").isNull() & (F.col("nth") < F.col("last")), event("end", F.col("nth") + 1, F.col("carried"))),
            F.when(retyped, event("retyped", F.col("nth"), F.col("carried"))),
        )
    )
    logged = spans.select("feed", "canonical", "field", "before", F.inline(log))
    side = lambda change: F.sort_array(F.collect_list(F.when(F.col("change") == change, F.struct("field", "kind", F.col("before").alias("was")))))
    # A column has few names, so few of its fields start or end in one file.
    met = logged.groupBy("feed", "nth", "canonical").agg(side("start").alias("new"), side("end").alias("old"), side("retyped").alias("retyped"))
    pairs = F.arrays_zip("old", "new")
    change = lambda name, old, new, old_kind, new_kind: F.struct(F.lit(name).alias("change"), old.alias("old_field"), new.alias("new_field"), old_kind.alias("old_kind"), new_kind.alias("new_kind"))
    none, empty = F.lit(None).cast("string"), F.lit("")

    def of_pair(p: Column) -> Column:
        old, new = p["old"], p["new"]
        same = F.coalesce(old["kind"] == new["kind"], F.lit(True))
        renamed = old.isNotNull() & new.isNotNull() & same
        return F.when(renamed, F.array(change("renamed", old["field"], new["field"], old["kind"], new["kind"]))).otherwise(
            F.array_compact(
                F.array(
                    F.when(old.isNotNull(), change("removed", old["field"], empty, old["kind"], none)),
                    F.when(new.isNotNull(), change("added", empty, new["field"], none, new["kind"])),
                )
            )
        )

    moved = F.flatten(F.transform(pairs, of_pair))
    kept = F.transform("retyped", lambda r: change("retyped", r["field"], r["field"], r["was"], r["kind"]))
    changes = met.select("feed", "nth", F.inline(F.concat(moved, kept)))
    return changes.join(files.select("feed", "nth", "file_id"), ["feed", "nth"]).select("feed", "file_id", "change", "old_field", "new_field", "old_kind", "new_kind")


def _epoch(number: Column) -> Column:
    """Seconds, milliseconds, microseconds or nanoseconds since 1970 (10, 13, 16 or 19 digits in our time) as a timestamp."""
    size = F.abs(number)
    return (
        F.when(size < 10**11, F.timestamp_seconds(number))
        .when(size < 10**14, F.timestamp_millis(number))
        .when(size < 10**17, F.timestamp_micros(number))
        .otherwise(F.timestamp_micros(F.floor(number.cast("decimal(20,0)") / 1000).cast("bigint")))
    )


def _cast(text: Column, kind: str) -> Column:
    """A value's JSON text as a declared type; what can't be read is null."""
    bare = F.trim(text)
    if kind == "boolean":
        return F.when(F.lower(bare).isin("true", "1", "t", "yes", "y"), True).when(F.lower(bare).isin("false", "0", "f", "no", "n"), False)
    if kind == "timestamp":
        return F.when(bare.rlike("^-?[0-9]+$"), _epoch(bare.try_cast("bigint"))).otherwise(F.try_to_timestamp(bare))
    if kind == "bigint":
        return bare.try_cast("double").try_cast("bigint")
    return text if kind == "string" else bare.try_cast(kind)


def unify(landed: DataFrame, target: str) -> DataFrame:
    """All records of a target in its declared columns, by casts from the alias table.

    Each column takes the first of its names that has a value in the record;
    one-element arrays are unwrapped, longer ones joined by commas. Columns that
    are not declared are kept as JSON text in ``extras``. Repeated rows count
    once per (file_id, line_no). ``uncast`` maps a column to its landed text
    where a value was present but could not be cast (null if there is none), so
    a spelling that is not known differs from a missing value.
    """
    rows = landed.where((F.col("target") == target) & F.col("file_id").isNotNull()).select("feed", "file_id", "line_no", "landed_at", "payload").dropDuplicates(["feed", "file_id", "line_no", "payload"]).withColumn("doc", F.from_json("payload", "map<string,string>"))
    columns = []
    failed = []
    known = []
    for name, kind in TARGETS[target].items():
        names = [name, *ALIASES.get(name, [])]
        known += names
        landed_text = text = F.coalesce(*[F.col("doc")[n] for n in names])
        if name == "dataset":
            text = F.when(text.startswith("["), F.array_join(F.from_json(text, "array<string>"), ",")).otherwise(text)
        value = _cast(text, kind)
        columns.append(value.alias(name))
        failed.append(F.when(landed_text.isNotNull() & value.isNull(), F.struct(F.lit(name), landed_text)))
    extras = F.map_filter("doc", lambda k, v: ~k.isin(known))
    uncast = F.map_from_entries(F.array_compact(F.array(*failed)))
    return rows.select("feed", "file_id", "line_no", *columns, F.when(F.size(extras) > 0, F.to_json(extras)).alias("extras"), F.when(F.size(uncast) > 0, uncast).alias("uncast"))


def uncast_counts(unified: DataFrame, target: str) -> DataFrame:
    """Per declared column: target, column, records with a value (``present``), those not cast (``uncast``)."""
    each = [F.struct(F.lit(n).alias("column"), F.col(n).isNotNull().alias("cast"), F.coalesce(F.map_contains_key("uncast", n), F.lit(False)).alias("failed")) for n in TARGETS[target]]
    counts = unified.select(F.inline(F.array(*each))).groupBy("column").agg(F.count_if(F.col("cast") | F.col("failed")).alias("present"), F.count_if("failed").alias("uncast"))
    return counts.select(F.lit(target).alias("target"), "column", "present", "uncast")
