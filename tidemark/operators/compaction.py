"""Consolidating far too many small Parquet files by copying encoded blocks."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.parquet_blocks import CHUNK_INDEX_AT, CHUNK_INDEX_LENGTH, FILE_GROUPS, GROUP_COLUMNS, ParquetBlockError, footer_bytes, join_blocks, read_footer
from tidemark.operators.parquet_footers import Shape, cut_pages, page_locations, read_footers
from tidemark.session import shared_dir

#: Bytes of small files that go into one consolidated file, about.
TARGET_BYTES = 64 << 20
#: Bytes of joined files that a task hands over at once.
WRITE_BYTES = 32 << 20
#: Directories beyond the target size of which so many, at some hundred bytes each, are sent to all tasks.
MOST_BROADCAST = 50_000
UNFINISHED = ".tmp"
RESULT = "partition_path string, part int, files_merged bigint, blocks bigint, row_total bigint, bytes_before bigint, bytes_after bigint, content binary, error string"


def _written(table: pa.Table, **options) -> pa.Buffer:
    """One Parquet file of one row group; pages of so few rows gain nothing by compression."""
    sink = pa.BufferOutputStream()
    with pq.ParquetWriter(sink, table.schema, compression="none", use_dictionary=False, write_statistics=False, store_schema=False, **options) as writer:
        writer.write_table(table, row_group_size=max(1, table.num_rows))
    return sink.getvalue()


def _encoded(table: pa.Table, rows: int) -> list[bytes]:
    """Parquet files of ``rows`` rows each: one file with a page for each is written, and cut up by its page index.

    Where pages came out otherwise (nested columns), files are written one by one.
    """
    first = _written(table.slice(0, rows)).to_pybytes()
    rest = table.num_rows // rows - 1
    if rest < 2:
        return [first, *[_written(table.slice(rows * (i + 1), rows)).to_pybytes() for i in range(rest)]]
    whole = _written(table.slice(rows), write_page_index=True, data_page_size=0, write_batch_size=rows)
    blob = memoryview(whole)
    try:
        (group,) = read_footer(whole.to_pybytes())[FILE_GROUPS][1][1]
        found = [page_locations(bytes(blob[(at := chunk[CHUNK_INDEX_AT][1]) : at + chunk[CHUNK_INDEX_LENGTH][1]])) for chunk in group[GROUP_COLUMNS][1][1]]
        if any(len(f) != rest or (f[:, 2] != np.arange(rest) * rows).any() for f in found):
            raise ParquetBlockError("pages of other rows")
        return [first, *cut_pages(blob, np.stack(found, axis=1)[:, :, :2], Shape(footer_bytes(first)))]
    except (ParquetBlockError, KeyError, ValueError):
        return [first, *[_written(table.slice(rows * (i + 1), rows)).to_pybytes() for i in range(rest)]]


def encode_files(rows: DataFrame, path: str) -> DataFrame:
    """Rows of a landing log back as the small Parquet files they came in.

    Columns: path, length, content. One file for each non-null ``path``, with
    all other columns. Files of the same number of rows are written together.
    """
    schema = to_arrow_schema(T.StructType([f for f in rows.schema.fields if f.name != path]))

    def files(table: pa.Table) -> pa.RecordBatch:
        code = table.column(path).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        begin = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        sizes = np.diff(np.append(begin, len(code)))
        names = table.column(path).take(pa.array(begin))
        own = table.drop_columns([path]).cast(schema).combine_chunks()
        content: list[bytes] = [b""] * len(begin)
        for n in sorted(set(sizes.tolist())):
            which = np.flatnonzero(sizes == n)
            part = own.take(pa.array((begin[which][:, None] + np.arange(n)).ravel())).combine_chunks()
            for i, blob in zip(which.tolist(), _encoded(part, n), strict=True):
                content[i] = blob
        return pa.RecordBatch.from_arrays([names.combine_chunks().cast(pa.string()), pa.array([len(c) for c in content], pa.int64()), pa.array(content, pa.binary())], names=["path", "length", "content"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(path)
            last = names[-1].as_py()
            # The file at the end may go on in the next batch.
            cut = int(np.argmax(pc.equal(names, last).to_numpy(zero_copy_only=False)))
            if cut or (held and held[-1].column(path)[0].as_py() != last):
                yield files(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield files(pa.Table.from_batches(held))

    found = rows.where(F.col(path).isNotNull())
    return found.repartition(path).sortWithinPartitions(path).mapInArrow(run, "path string, length bigint, content binary")


def _joined(blobs: list[bytes], blocks: list) -> tuple:
    """The joined file of ``blobs`` as a row of RESULT from files_merged on."""
    joined, copied, total = join_blocks(blobs, blocks)
    return len(blobs), copied, total, sum(map(len, blobs)), len(joined), joined, None


def _passed(blob: bytes | None, why: object) -> tuple:
    return 1, 0, 0, len(blob or b""), len(blob or b""), blob, str(why)


def _join(files: list[tuple[bytes | None, object]]) -> list[tuple]:
    """Rows of RESULT, from files_merged on, for the files of one part."""
    by_schema: dict[bytes, list[tuple[bytes, object]]] = {}
    rows = []
    for blob, blocks in files:
        if isinstance(blocks, ParquetBlockError):
            rows.append(_passed(blob, blocks))
        else:
            by_schema.setdefault(blocks.shape.schema, []).append((blob, blocks))
    for own in by_schema.values():
        try:
            rows.append(_joined(*map(list, zip(*own, strict=True))))
        except ParquetBlockError:
            # One file may spoil the whole: those that cannot be joined even alone are passed through.
            fit = []
            for blob, blocks in own:
                try:
                    _joined([blob], [blocks])
                    fit.append((blob, blocks))
                except ParquetBlockError as e:
                    rows.append(_passed(blob, e))
            try:
                rows += [_joined(*map(list, zip(*fit, strict=True)))] if fit else []
            except ParquetBlockError as e:
                rows += [_passed(b, e) for b, _ in fit]
    return rows


def _result(held: list[tuple]) -> pa.RecordBatch:
    """Rows of RESULT, with the extents and totals of joined files as a fresh reading of their footers has them."""
    joined = [r for r in held if r[8] is None]
    for row, seen in zip(joined, read_footers([r[7] for r in joined]), strict=True):
        if isinstance(seen, ParquetBlockError) or seen.rows != row[4]:
            raise ParquetBlockError(f"the joined file of {row[0]} has other totals: {seen}")
    types = [pa.string(), pa.int32(), *[pa.int64()] * 5, pa.binary(), pa.string()]
    names = [f.split(" ")[0] for f in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def _join_runs(least_files: int):
    """Batches sorted by partition_path, part and path to rows of RESULT; ``whole`` says that the part is the directory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        own: dict[str, tuple] = {}
        done: list[tuple] = []
        size = 0

        def close() -> int:
            if key is None or (len(own) < least_files and key[2]):
                return 0
            new = [(key[0], key[1], *r) for r in _join(list(own.values()))]
            done.extend(new)
            return sum(r[6] for r in new)

        for batch in batches:
            blobs = batch.column("content").to_pylist()
            read = read_footers([b or b"" for b in blobs])
            for at, path, blob, blocks in zip(zip(*[batch.column(c).to_pylist() for c in ("partition_path", "part", "whole")], strict=True), batch.column("path").to_pylist(), blobs, read, strict=True):
                if at != key:
                    size += close()
                    key, own = at, {}
                    if size > WRITE_BYTES:
                        yield _result(done)
                        done, size = [], 0
                own[path] = (blob, blocks)
        close()
        if done:
            yield _result(done)

    return run


def consolidate(files: DataFrame, target_bytes: int = TARGET_BYTES, least_files: int = 2) -> DataFrame:
    """Small Parquet files of each directory joined into files of about ``target_bytes``.

    ``files`` has path, length and content, as Spark's ``binaryFile`` source
    gives them (lengths are read without contents). A directory with fewer than
    ``least_files`` finished files is left as it is. Larger directories are cut
    into parts by a hash of the path, as many as their bytes ask for, so no
    task holds a whole hot directory. What has to be cut is known from paths and
    lengths; contents are shuffled once. Within a part, encoded column data are
    copied without decoding and footers rewritten; schemas, extents and row
    totals are checked, before and in a fresh reading of the result.

    Cases: names ending in .tmp are no files. A path given several times is one
    file. Files of another schema in the same part get a file of their own. A
    file that can't be read is passed through whole with ``error`` set. Empty
    files (no rows) are joined and add none. Null paths are left out.
    """
    finished = files.where(F.col("path").isNotNull() & ~F.col("path").endswith(UNFINISHED)).withColumn("partition_path", F.regexp_replace("path", "/[^/]*$", ""))
    sizes = finished.groupBy("partition_path", "path").agg(F.max("length").alias("length")).groupBy("partition_path").agg(F.sum("length").alias("bytes"))
    large = sizes.where(F.col("bytes") > target_bytes).select("partition_path", F.ceil(F.col("bytes") / target_bytes).cast("int").alias("parts"))
    placed = finished.withColumn("parts", F.lit(1))
    # Directories beyond the target size are few; only where they aren't, contents go through a shuffled join.
    number = large.count()
    if number:
        placed = finished.join(F.broadcast(large) if number <= MOST_BROADCAST else large, "partition_path", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    placed = placed.select("partition_path", F.pmod(F.xxhash64("path"), "parts").cast("int").alias("part"), (F.col("parts") == 1).alias("whole"), "path", "content")
    in_order = placed.repartition("partition_path", "part").sortWithinPartitions("partition_path", "part", "path")
    return in_order.mapInArrow(_join_runs(least_files), RESULT)


def write_consolidated(joined: DataFrame, root: str) -> DataFrame:
    """Write each consolidated file below ``root``; returns what was written where.

    File names follow from partition and part, so a task that runs again writes
    the same file. ``root`` is any URI that pyarrow's file systems know. Files
    that could not be joined are not written and have a null path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            paths = []
            for row in batch.to_pylist():
                if row["error"] is not None:
                    paths.append(None)
                    continue
                folder = f"{base}/{row['partition_path']}"
                system.create_dir(folder, recursive=True)
                path = f"{folder}/part-{row['part']:05d}-{row['row_total']}.parquet"
                with system.open_output_stream(path) as sink:
                    sink.write(row["content"])
                paths.append(path)
            yield pa.RecordBatch.from_arrays([batch.column("partition_path"), pa.array(paths, pa.string()), batch.column("row_total")], names=["partition_path", "path", "row_total"])

    return joined.mapInArrow(run, "partition_path string, path string, row_total bigint")


def read_consolidated(joined: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of consolidated files: partition_path and the columns of ``schema``.

    Only the columns of ``schema`` are decoded. Files that could not be joined
    (``error`` set) are decoded as they came; if one is no readable Parquet file
    either, reading fails rather than leaving its records out (who accepts that
    passes ``joined`` without it).
    """
    target = to_arrow_schema(T.StructType([T.StructField("partition_path", T.StringType()), *schema.fields]))
    names = schema.fieldNames()

    def read(blob: bytes, rows: int, whose: str, error: str | None = None) -> pa.Table:
        try:
            file = pq.ParquetFile(pa.BufferReader(blob))
            table = file.read(columns=names, use_threads=False).select(names)
            whole = table.num_rows == file.metadata.num_rows == (rows if rows >= 0 else table.num_rows)
        except (pa.ArrowException, OSError) as e:
            raise ParquetBlockError(f"a file of {whose} cannot be read ({error}): {e}") from e
        if not whole:
            raise ParquetBlockError(f"a file of {whose} has other rows than its footer says ({error})")
        return table

    def named(partitions: list[str], rows: list[int], table: pa.Table) -> Iterator[pa.RecordBatch]:
        own = pa.array(partitions, pa.string()).take(pa.array(np.repeat(np.arange(len(rows)), rows)))
        yield from pa.Table.from_arrays([own, *[c.cast(f.type) for c, f in zip(table.columns, list(target)[1:], strict=True)]], schema=target).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            partitions, blobs, errors = (batch.column(n).to_pylist() for n in ("partition_path", "content", "error"))
            together: dict[tuple, list[int]] = {}
            footers = read_footers([b or b"" for b in blobs])
            for i, (blob, error, seen) in enumerate(zip(blobs, errors, footers, strict=True)):
                if error is None and not isinstance(seen, ParquetBlockError) and seen.shape.key is not None and len(blob) < WRITE_BYTES:
                    together.setdefault(seen.shape.key, []).append(i)
                else:
                    table = read(blob or b"", -1, partitions[i], error)
                    yield from named([partitions[i]], [table.num_rows], table)
            # Files that may share column chunks are read as one.
            for which in together.values():
                at, size = 0, 0
                for end in range(1, len(which) + 1):
                    size += len(blobs[which[end - 1]])
                    if size < WRITE_BYTES and end < len(which):
                        continue
                    own = which[at:end]
                    rows = [footers[i].rows for i in own]
                    blob, _, total = join_blocks([blobs[i] for i in own], [footers[i] for i in own])
                    try:
                        table = read(blob, total, f"{partitions[own[0]]} and others")
                    except ParquetBlockError:
                        for i in own:  # says which one it is
                            read(blobs[i], footers[i].rows, partitions[i])
                        raise
                    yield from named([partitions[i] for i in own], rows, table)
                    at, size = end, 0

    return joined.select("partition_path", "content", "error").mapInArrow(run, T.StructType([T.StructField("partition_path", T.StringType()), *schema.fields]))


def compaction_report(joined: DataFrame) -> DataFrame:
    """Per directory what was merged, as it is: files, blocks, rows, bytes, errors."""
    return joined.groupBy("partition_path").agg(
        F.sum("files_merged").alias("files_merged"),
        F.count_if(F.col("error").isNull()).alias("files_written"),
        F.sum("blocks").alias("blocks"),
        F.sum("row_total").alias("row_total"),
        F.sum("bytes_before").alias("bytes_before"),
        F.sum("bytes_after").alias("bytes_after"),
        F.count("error").alias("errors"),
    )


def _filesystem(path: str):
    """The file system of a path as Spark lists it, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def _write_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each group's files joined into one hidden file beside them; those that can't be joined are left as they are."""
    for batch in batches:
        for row in batch.to_pylist():
            system, folder = _filesystem(row["partition_path"])
            opened = [_filesystem(p)[1] for p in sorted(row["paths"])]
            blobs = []
            for path in opened:
                with system.open_input_stream(path) as source:
                    blobs.append(source.read())
            read = read_footers(blobs)
            fit = [i for i, b in enumerate(read) if not isinstance(b, ParquetBlockError)]
            same = [i for i in fit if read[i].shape.schema == read[fit[0]].shape.schema]
            out = {"partition_path": row["partition_path"], "hidden": None, "sources": [opened[i] for i in same], "rows": 0, "left": len(blobs) - len(same)}
            if len(same) > 1:
                joined, _, out["rows"] = join_blocks([blobs[i] for i in same], [read[i] for i in same])
                (seen,) = read_footers([joined])
                if isinstance(seen, ParquetBlockError) or seen.rows != out["rows"]:
                    raise ParquetBlockError(f"the joined file of {folder} has other totals: {seen}")
                name = hashlib.sha1("\n".join(out["sources"]).encode()).hexdigest()[:16]
                out["hidden"] = f"{folder}/.compacted-{row['part']:05d}-{name}.parquet"
                with system.open_output_stream(out["hidden"]) as sink:
                    sink.write(joined)
            yield pa.RecordBatch.from_pylist([out], _SWAP)


_SWAP = pa.schema([("partition_path", pa.string()), ("hidden", pa.string()), ("sources", pa.list_(pa.string())), ("rows", pa.int64()), ("left", pa.int64())])


def _swap_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sources deleted and hidden files named; a task that runs again finds done what is done."""
    from pyarrow import fs

    for batch in batches:
        for row in batch.to_pylist():
            if row["hidden"]:
                system, _ = _filesystem(row["partition_path"])
                for source in row["sources"]:
                    if system.get_file_info(source).type == fs.FileType.File:
                        system.delete_file(source)
                folder, name = row["hidden"].rsplit("/", 1)
                if system.get_file_info(row["hidden"]).type == fs.FileType.File:
                    system.move(row["hidden"], f"{folder}/{name[1:]}")
        yield batch


def compact_lake(spark: SparkSession, root: str, min_age_days: float = 1.0, force: bool = False, target_bytes: int = TARGET_BYTES, least_files: int = 2) -> DataFrame:
    """Join the small files of each directory below ``root`` where they lie; returns what was done per directory.

    Columns: partition_path, files_merged, files_written, rows, left (files that
    were not joined). Files younger than ``min_age_days`` are left alone unless
    ``force``. Planned on paths and lengths; each task opens its own files. New
    files are hidden until all are written and checked; then sources go and
    hidden files get their names, in tasks that may run again. A second run finds
    one file a directory and does nothing.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select("path", "length", "modificationTime")
    if not force:
        listed = listed.where(F.col("modificationTime") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(min_age_days * 86400)))
    finished = listed.withColumn("partition_path", F.regexp_replace("path", "/[^/]*$", ""))
    totals = finished.groupBy("partition_path").agg(F.sum("length").alias("bytes"), F.count("*").alias("n")).where(F.col("n") >= least_files)
    parts = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int")
    groups = finished.join(totals, "partition_path").groupBy("partition_path", F.pmod(F.xxhash64("path"), parts).cast("int").alias("part")).agg(F.collect_list("path").alias("paths"))
    done_at = shared_dir(spark, "compaction")
    groups.mapInArrow(_write_groups, "partition_path string, hidden string, sources array<string>, rows bigint, left bigint").write.parquet(done_at)
    done = spark.read.parquet(done_at)
    done.mapInArrow(_swap_groups, done.schema).write.format("noop").mode("overwrite").save()
    merged = F.when(F.col("hidden").isNotNull(), F.size("sources")).otherwise(0)
    return done.groupBy("partition_path").agg(F.sum(merged).alias("files_merged"), F.count("hidden").alias("files_written"), F.sum("rows").alias("rows"), F.sum("left").alias("left"))
