"""The core data operators: brute force on small tables, and the cases their docstrings state."""

from __future__ import annotations

import io
import json
import random
from datetime import date, datetime, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions.symbols import bare_number, canonical, tidy
from tidemark.operators import compaction, drift, intervals, known_at
from tidemark.operators.parquet_blocks import FILE_ROWS, STRUCT, ParquetBlockError, _put, join_blocks, read_footer
from tidemark.operators.parquet_footers import Shape, read_footers
from tidemark.operators.rolling import trailing_totals
from tidemark.operators.snapshots import snapshot_changes
from tidemark.plans import data_queries

D = date(2024, 1, 1)
AT = datetime(2024, 1, 1, 12)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- trailing totals ---------------------------------------------------------

BAR = "symbol string, date date, dividends double, ingested_at timestamp, entity string, prefix int"


def totals(spark, data):
    df = spark.createDataFrame([(*r, "clash", 1) for r in data], BAR)
    return trailing_totals(df, canonical(F.col("symbol")), "date", "dividends", "ingested_at")


def test_trailing_totals_against_brute_force(spark):
    rng = random.Random(1)
    data = []
    for s in ("A", "B", "C.A"):
        for k in sorted(rng.sample(range(120), 25)):
            for v in range(rng.choice([1, 1, 3])):
                data.append((rng.choice([s, s.lower(), f" {s.replace('.', '-')}"]), D + timedelta(k), rng.choice([None, 0.0, 0.1, 1.3]), AT + timedelta(seconds=v)))
    data += data[:10]
    held = {}
    for s, d, v, at in data:
        key = (s.strip().upper().replace("-", "."), d)
        if key not in held or held[key][1] < at:
            held[key] = (v or 0.0, at)
    want = {}
    for s in {k[0] for k in held}:
        days = [k[1] for k in held if k[0] == s]
        day = min(days)
        while day <= max(days):
            want[s, day] = [sum(held.get((s, day - timedelta(i)), (0.0, 0))[0] for i in range(n)) for n in (7, 30)]
            day += timedelta(1)
    got = {(r.entity, r.day): [float(r.total_7), float(r.total_30)] for r in totals(spark, data).collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k]) for k in want)


def test_trailing_totals_cases(spark):
    nan = float("nan")
    data = [("A", D, nan, AT), ("A", D + timedelta(3), 1.0, AT), ("A", D + timedelta(3), 2.0, AT), (None, D, 1.0, AT), ("A", None, 9.0, AT), ("B", D, None, None), ("B", D, 5.0, AT)]
    got = {(r.entity, r.day): float(r.total_7) for r in totals(spark, data).collect()}
    assert got == {("A", D): 0, ("A", D + timedelta(1)): 0, ("A", D + timedelta(2)): 0, ("A", D + timedelta(3)): 2.0, ("B", D): 5.0}
    assert totals(spark, []).count() == 0


# --- snapshots ---------------------------------------------------------------

LIVE = "snapshot_date date, symbol string, name string, cik string, ingested_at timestamp, chunk int, edge int"


def changes(spark, data, **more):
    df = spark.createDataFrame([(*r, 0, 0) for r in data], LIVE)
    out = snapshot_changes(df, "snapshot_date", canonical(F.col("symbol")), {"name": tidy(F.col("name")), "cik": bare_number(F.col("cik"))}, "ingested_at", **more)
    return {(r.snapshot, r.key, r.change, tuple(r.fields or ())) for r in out.collect()}


@pytest.mark.parametrize("chunk_keys", [1, 7, 1000])
def test_snapshot_changes_against_brute_force(spark, chunk_keys):
    rng = random.Random(2)
    state, data, want, old = {}, [], set(), None
    for s in range(4):
        for k in range(60):
            if rng.random() < 0.1:
                state.pop(f"K{k}", None)
            elif rng.random() < 0.1 or s == 0:
                state[f"K{k}"] = (rng.choice(["x", "y", None]), rng.choice(["1", "2"]))
        day = D + timedelta(7 * s)
        for k, (n, c) in state.items():
            data.append((day, rng.choice([k, k.lower()]), n and rng.choice([n, f" {n} "]), rng.choice([c, "00" + c]), AT))
        if old is not None:
            want |= {(day, k, "added", ()) for k in state.keys() - old.keys()} | {(day, k, "removed", ()) for k in old.keys() - state.keys()}
            want |= {(day, k, "changed", tuple(f for f, a, b in zip(("name", "cik"), old[k], state[k]) if a != b)) for k in state.keys() & old.keys() if state[k] != old[k]}
        old = dict(state)
    assert changes(spark, data + data[:20], chunk_keys=chunk_keys) == want


def test_snapshot_cases(spark):
    later = AT + timedelta(1)
    data = [(D, "a", "old", "1", AT), (D, "A", "new", "1", later), (D + timedelta(1), "A", "NEW", "01", AT), (D + timedelta(1), None, "x", "1", AT), (None, "Z", "x", "1", AT), (D + timedelta(1), "B", None, "", AT), (D + timedelta(5), "B", "", None, AT)]
    assert changes(spark, data) == {(D + timedelta(1), "A", "changed", ("name",)), (D + timedelta(1), "B", "added", ()), (D + timedelta(5), "A", "removed", ())}
    assert changes(spark, []) == set()
    assert changes(spark, data[:1]) == set()


def test_snapshot_changes_without_reused_exchanges(spark):
    """Key ranges that are cut anew each time they are needed must not lose changes."""
    n = 6000
    data = [(D + timedelta(days=d), f"k{i:05d}", str(i if i % 3 else i + d), AT) for d in range(2) for i in range(n)]
    df = spark.createDataFrame(data, "day date, k string, a string, seen timestamp").repartition(3)
    changed = {"spark.sql.exchange.reuse": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.rangeExchange.sampleSizePerPartition": "5"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        got = {(r.key, r.change) for r in snapshot_changes(df, "day", F.col("k"), {"a": F.col("a")}, "seen", chunk_keys=1 << 40).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {(f"k{i:05d}", "changed") for i in range(0, n, 3)}


# --- intervals ---------------------------------------------------------------

SPAN = "symbol string, index_name string, start_date date, end_date date, first_seen_utc timestamp, first int, firsts int"


def periods(spark, data):
    df = spark.createDataFrame([(*r, 0, 0) for r in data], SPAN)
    out = intervals.merge_intervals(df, {"symbol": canonical(F.col("symbol")), "index_name": F.col("index_name")}, "start_date", "end_date", "first_seen_utc")
    return {tuple(r) for r in out.collect()}


def test_intervals_against_brute_force(spark):
    rng = random.Random(3)
    data = []
    for s in ("A", "B", "C"):
        for k in rng.sample(range(300), 25):
            a = D + timedelta(k)
            data.append((s, "I", a, a + timedelta(rng.randint(-2, 12)), AT))
    want = set()
    for s in ("A", "B", "C"):
        own = sorted((a, b) for k, _, a, b, _ in data if k == s and b >= a)
        merged = []
        for a, b in own:
            if merged and a <= merged[-1][1] + timedelta(1):
                merged[-1] = [merged[-1][0], max(merged[-1][1], b), merged[-1][2] + 1]
            else:
                merged.append([a, b, 1])
        want |= {(s, "I", "period", a, b, n) for a, b, n in merged}
        want |= {(s, "I", "gap", x[1] + timedelta(1), y[0] - timedelta(1), None) for x, y in zip(merged, merged[1:])}
    assert periods(spark, data + data[:9]) == want


def test_interval_cases(spark):
    far = date(9999, 12, 31)
    data = [
        ("A", "I", D, D + timedelta(5), AT), ("a ", "I", D, D + timedelta(2), AT + timedelta(1)),  # the later version is shorter
        ("A", "I", D + timedelta(3), None, AT), ("A", "I", D + timedelta(9), far, AT),
        ("B", "I", D, D - timedelta(1), AT), (None, "I", D, D, AT), ("C", None, D, D, AT), ("C", "I", None, D, AT), ("D", "I", D, D, None),
    ]
    assert periods(spark, data) == {("A", "I", "period", D, None, 3), ("D", "I", "period", D, D, 1)}
    assert periods(spark, []) == set()


def test_merging_lists_is_associative():
    rng = np.random.default_rng(4)
    g, a = rng.integers(0, 5, 200), rng.integers(0, 400, 200)
    b = a + rng.integers(0, 6, 200)
    n = np.ones(200, np.int64)
    order = np.argsort(g, kind="stable")
    whole = intervals.merge_lists(g[order], a[order], b[order], n)
    parts = [intervals.merge_lists(g[i::3][np.argsort(g[i::3])], a[i::3][np.argsort(g[i::3])], b[i::3][np.argsort(g[i::3])], n[i::3]) for i in range(3)]
    tree = intervals.merge_lists(*[np.concatenate(x) for x in zip(*parts)])
    assert all((x == y).all() for x, y in zip(whole, tree))


# --- what was known ----------------------------------------------------------


def test_known_at_against_brute_force(spark):
    rng = random.Random(5)
    versions, events = [], []
    for s in ("A", "B"):
        for start in rng.sample(range(60), 8):
            for v in range(rng.choice([1, 2, 3])):
                a = D + timedelta(start)
                end = rng.choice([None, a + timedelta(rng.randint(-1, 20))])
                versions.append((s, a, end, AT + timedelta(start + rng.randint(-10, 25), seconds=len(versions)), rng.choice(["x", "y", "z", None])))
        events += [(s, D + timedelta(k)) for k in range(-5, 100)]
    want = {}
    for s, d in events:
        last = {}
        for k, a, b, seen, v in sorted(versions, key=lambda r: r[3]):
            if k == s and seen.date() <= d:
                last[a] = (b, v)
        covering = [(a, v) for a, (b, v) in last.items() if a <= d and (b is None or d <= b)]
        want[s, d] = max(covering)[1] if covering else None
    e = spark.createDataFrame([(*r, "x") for r in events + events[:30]], "symbol string, date date, known string")
    v = spark.createDataFrame(versions + versions[:4], "symbol string, start_date date, end_date date, seen timestamp, sector string")
    out = known_at.attributes_known_at(e, F.col("symbol"), "date", v, F.col("symbol"), "start_date", "end_date", "seen", "sector", buckets=3)
    assert {(r.entity, r.day): r.known for r in out.collect()} == want
    none = known_at.attributes_known_at(e, F.col("symbol"), "date", v.limit(0), F.col("symbol"), "start_date", "end_date", "seen", "sector", buckets=3)
    assert {r.known for r in none.collect()} == {None}
    assert known_at.attributes_known_at(e.limit(0), F.col("symbol"), "date", v, F.col("symbol"), "start_date", "end_date", "seen", "sector", buckets=3).count() == 0


def test_known_at_nulls(spark):
    e = spark.createDataFrame([("A", D), (None, D), ("A", None)], "symbol string, date date")
    v = spark.createDataFrame([("A", D, None, None, "x"), (None, D, None, AT, "x"), ("A", None, None, AT, "x")], "symbol string, start_date date, end_date date, seen timestamp, sector string")
    out = known_at.attributes_known_at(e, F.col("symbol"), "date", v, F.col("symbol"), "start_date", "end_date", "seen", "sector", buckets=2)
    assert rows(out) == [("A", D, None)]


# --- compaction --------------------------------------------------------------


def parquet(table, **more):
    sink = io.BytesIO()
    pq.write_table(table, sink, **more)
    return sink.getvalue()


@pytest.mark.parametrize("more", [{}, {"compression": "zstd", "use_dictionary": False}, {"row_group_size": 7, "write_page_index": True}, {"data_page_version": "2.0"}, {"use_dictionary": ["s"]}, {"row_group_size": 3, "use_dictionary": False, "data_page_version": "2.0"}])
@pytest.mark.parametrize("group_bytes", [1, 128 << 20])
def test_joined_blocks_hold_the_same_rows(more, group_bytes):
    tables = [pa.table({"i": pa.array(range(k, k + n), pa.int64()), "s": pa.array([f"t{j % 3}" * (k + 1) if j % 4 else None for j in range(n)], pa.string()), "l": [[j, None] for j in range(n)], "b": [j % 2 == 0 for j in range(n)]}) for k, n in ((0, 20), (100, 5), (200, 20), (70_000, 1))]
    blobs = [parquet(t, **more) for t in tables]
    joined, blocks, total = join_blocks(blobs, read_footers(blobs), group_bytes)
    back = pq.ParquetFile(io.BytesIO(joined))
    assert total == 46 == back.metadata.num_rows and blocks == sum(pq.ParquetFile(io.BytesIO(b)).metadata.num_row_groups for b in blobs)
    assert sorted(back.read().to_pylist(), key=lambda r: r["i"]) == pa.concat_tables(tables).to_pylist()
    if not more.get("use_dictionary", True):
        assert back.metadata.num_row_groups == (1 if group_bytes > 1 else blocks)


def test_footers_read_at_once_say_what_each_says_alone():
    rng = random.Random(5)
    blobs = [parquet(pa.table({"i": list(range(n)), "s": ["x" * rng.randint(0, 300)] * n}), use_dictionary=bool(n % 2), row_group_size=50) for n in (rng.choice([1, 3, 100, 170]) for _ in range(60))]
    blobs += [b"junk", b"", blobs[0][:-20]]
    for blob, own in zip(blobs, read_footers(blobs), strict=True):
        if isinstance(own, ParquetBlockError):
            assert blob in blobs[-3:]
            continue
        meta = pq.ParquetFile(io.BytesIO(blob)).metadata
        assert own.rows == meta.num_rows and own.group_rows == [meta.row_group(g).num_rows for g in range(meta.num_row_groups)]
        for g in range(meta.num_row_groups):
            for c in range(2):
                chunk = meta.row_group(g).column(c)
                assert (own.compressed[g][c], own.uncompressed[g][c], own.values[g][c]) == (chunk.total_compressed_size, chunk.total_uncompressed_size, chunk.num_values)
                assert own.start[g][c] == (chunk.dictionary_page_offset or chunk.data_page_offset)


def test_footers_are_written_as_they_were_read():
    blob = parquet(pa.table({"i": [1, 2], "s": ["a", None]}))
    shape = Shape(compaction.footer_bytes(blob))
    assert shape.write(np.array([shape.first] * 3)) == [compaction.footer_bytes(blob)] * 3


@pytest.mark.parametrize("rows", [1, 3])
def test_many_files_are_encoded_as_each_would_be(rows):
    """Nulls, long and empty texts, and nested columns, which are written one by one."""
    rng = random.Random(7)
    n = 40 * rows
    flat = {"i": pa.array([rng.choice([None, rng.randint(-(10**12), 10**12)]) for _ in range(n)], pa.int64()), "s": pa.array([rng.choice([None, "", "x" * rng.randint(0, 400)]) for _ in range(n)], pa.string()), "b": pa.array([rng.choice([None, True, False]) for _ in range(n)]), "none": pa.array([None] * n, pa.float64())}
    for table in (pa.table(flat), pa.table(flat | {"l": pa.array([[1] * rng.randint(0, 4) for _ in range(n)])})):
        blobs = compaction._encoded(table, rows)
        assert len(blobs) == 40
        for i, blob in enumerate(blobs):
            assert pq.read_table(io.BytesIO(blob)).equals(table.slice(i * rows, rows))
        joined, _, total = join_blocks(blobs, read_footers(blobs))
        assert total == n and pq.read_table(io.BytesIO(joined)).equals(table)


def test_blocks_that_do_not_fit():
    a, b = parquet(pa.table({"i": [1]})), parquet(pa.table({"i": ["x"]}))
    with pytest.raises(ParquetBlockError, match="schemas differ"):
        join_blocks([a, b], read_footers([a, b]))
    assert [isinstance(f, ParquetBlockError) for f in read_footers([a, a[:-20], b"PAR1"])] == [False, True, True] and read_footers([]) == []
    blobs = [a, parquet(pa.table({"i": pa.array([], pa.int64())})), a]
    joined, _, total = join_blocks(blobs, read_footers(blobs))
    assert total == 2 and pq.read_table(io.BytesIO(joined)).column("i").to_pylist() == [1, 1]


def test_consolidation_loses_and_doubles_nothing(spark):
    data = [(f"t/p={p}/f{f}.parquet", f"{p}{f}{r}", r) for p in range(3) for f in range(p * 4 + 1) for r in range(1 + f % 3)] + [("t/p=2/x.tmp", "no", 0), (None, "no", 0)]
    df = spark.createDataFrame(data, "file_path string, v string, n int")
    files = compaction.encode_files(df, "file_path")
    joined = compaction.consolidate(files.unionByName(files), target_bytes=1000)
    report = {r.partition_path: (r.files_merged, r.row_total, r.errors) for r in compaction.compaction_report(joined).collect()}
    count = lambda p: sum(1 for x in data if x[0] and x[0].startswith(f"t/p={p}/f"))
    assert report == {"t/p=1": (5, count(1), 0), "t/p=2": (9, count(2), 0)}
    assert joined.count() > 2  # a hot directory goes into several files
    back = compaction.read_consolidated(joined, T._parse_datatype_string("v string, n int"))
    assert sorted(r.v for r in back.collect()) == sorted(v for p, v, _ in data if p and p.startswith(("t/p=1/f", "t/p=2/f")))


def test_consolidation_of_bad_and_different_files(spark):
    a, b = parquet(pa.table({"i": [1, 2]})), parquet(pa.table({"i": ["x"]}))
    files = spark.createDataFrame([(f"d/{i}", len(c), bytearray(c)) for i, c in enumerate((a, a, b, b"junk", b""))], "path string, length bigint, content binary")
    got = sorted((r.files_merged, r.row_total, r.error is None) for r in compaction.consolidate(files).collect())
    assert got == [(1, 0, False), (1, 0, False), (1, 1, True), (2, 4, True)]
    assert compaction.consolidate(files.limit(0)).count() == 0


def test_files_that_cannot_be_joined_are_still_read(spark, tmp_path):
    good = [parquet(pa.table({"i": [k, k + 10]})) for k in range(3)]
    broken = good[0][:4] + b"\xff" * 20 + good[0][24:]  # the footer is whole, the data are not
    files = lambda *blobs: spark.createDataFrame([(f"d/{i}", len(c), bytearray(c)) for i, c in enumerate(blobs)], "path string, length bigint, content binary")
    values = lambda joined: sorted(r.i for r in compaction.read_consolidated(joined, T._parse_datatype_string("i bigint")).collect())
    with_error = compaction.consolidate(files(*good)).withColumn("error", F.lit("could not be joined"))
    assert values(with_error) == [0, 1, 2, 10, 11, 12]
    written = compaction.write_consolidated(compaction.consolidate(files(*good, b"junk")), f"file://{tmp_path}").collect()
    assert sorted((r.path is None, r.row_total) for r in written) == [(False, 6), (True, 0)]
    for bad in (b"junk", b"", broken):
        with pytest.raises(Exception, match="a file of d cannot be read"):
            values(compaction.consolidate(files(*good, bad)))


def test_one_file_does_not_spoil_its_group():
    good = [parquet(pa.table({"i": [k, k + 10]})) for k in range(3)]
    footer = read_footer(good[0])
    tail = bytearray()
    footer[FILE_ROWS] = (footer[FILE_ROWS][0], 7)  # a total that its row groups do not have
    _put(tail, STRUCT, footer)
    length = int.from_bytes(good[0][-8:-4], "little")
    bad = good[0][: -8 - length] + bytes(tail) + len(tail).to_bytes(4, "little") + b"PAR1"
    batch = pa.RecordBatch.from_pydict({"partition_path": ["d"] * 4, "part": pa.array([0] * 4, pa.int32()), "whole": [True] * 4, "path": list("abcd"), "content": [good[0], bad, *good[1:]]})
    got = sorted((r["files_merged"], r["row_total"], r["error"]) for b in compaction._join_runs(2)(iter([batch])) for r in b.to_pylist())
    assert got == [(1, 0, "row counts of footer and row groups differ"), (3, 6, None)]


def test_written_files_can_be_read(spark, tmp_path):
    df = spark.createDataFrame([(f"t/f{f}.parquet", r) for f in range(5) for r in range(3)], "file_path string, n int")
    joined = compaction.consolidate(compaction.encode_files(df, "file_path"))
    written = compaction.write_consolidated(joined, f"file://{tmp_path}").collect()
    assert sum(r.row_total for r in written) == 15
    assert spark.read.parquet(f"file://{tmp_path}/t").count() == 15


def test_lake_is_compacted_where_it_lies(spark, tmp_path):
    """Young files wait, forced runs take all, bad and other files stay, and a second run finds nothing to do."""
    for p in range(3):
        (tmp_path / f"p={p}").mkdir()
        for f in range(p + 1):
            pq.write_table(pa.table({"n": [p * 10 + f, -1]}), tmp_path / f"p={p}" / f"f{f}.parquet")
    (tmp_path / "p=2" / "bad.parquet").write_bytes(b"junk")
    pq.write_table(pa.table({"other": ["x"]}), tmp_path / "p=2" / "z.parquet")
    root = f"file://{tmp_path}"
    files = lambda: sorted(str(f.relative_to(tmp_path)) for f in tmp_path.rglob("*.parquet"))
    before = files()
    assert compaction.compact_lake(spark, root, min_age_days=1).count() == 0 and files() == before
    done = {r.partition_path.rsplit("/", 1)[1]: (r.files_merged, r.files_written, r.rows, r.left) for r in compaction.compact_lake(spark, root, force=True).collect()}
    assert done == {"p=1": (2, 1, 4, 0), "p=2": (3, 1, 6, 2)}
    after = files()
    assert len(after) == 5 and {"p=0/f0.parquet", "p=2/bad.parquet", "p=2/z.parquet"} < set(after)
    values = sorted(v for f in after if "compacted" in f or f == "p=0/f0.parquet" for v in pq.read_table(tmp_path / f).column("n").to_pylist())
    assert values == sorted([0, -1, 10, -1, 11, -1, 20, -1, 21, -1, 22, -1])
    again = compaction.compact_lake(spark, root, force=True).collect()
    assert all(r.files_merged == 0 for r in again) and files() == after


def test_swap_may_run_again(spark, tmp_path):
    """A task that was lost after deleting sources finds the hidden file; one lost at the very end finds all done."""
    (tmp_path / ".compacted-x.parquet").write_bytes(b"new")
    row = {"partition_path": f"file:{tmp_path}", "hidden": f"{tmp_path}/.compacted-x.parquet", "sources": [f"{tmp_path}/gone.parquet"], "rows": 1, "left": 0}
    for _ in range(2):
        list(compaction._swap_groups(iter([pa.RecordBatch.from_pylist([row], compaction._SWAP)])))
        assert [f.name for f in tmp_path.iterdir()] == ["compacted-x.parquet"]


# --- schema drift ------------------------------------------------------------


def landed(spark, files, target="ohlcv"):
    """files: (feed, file_id, hour, [record or text])"""
    out = [(i, feed, target, f"f{i}", AT + timedelta(hours=h), n, r if isinstance(r, (str, type(None))) else json.dumps(r)) for feed, i, h, records in files for n, r in enumerate(records)]
    return spark.createDataFrame(out, "file_id long, feed string, target string, file_name string, landed_at timestamp, line_no int, payload string")


def test_lifespans_do_not_depend_on_where_blocks_end(spark, monkeypatch):
    """Random feeds with unreadable files, all-null fields and renames: any block size logs the same changes."""
    rng = random.Random(3)
    files = []
    for i in range(60):
        record = {rng.choice(["repaired", "is_repaired"]): rng.choice([True, 1, None, None]), rng.choice(["vol", "volume"]): rng.choice([1, 1.5, None])}
        record |= {k: rng.choice([None, "x", 3]) for k in rng.sample(["a", "b"], rng.randint(0, 2))}
        files.append((f"f{i % 2}", i, i * 7 % 50, [record] if rng.random() > 0.1 else [rng.choice([None, "no json", "[1]"])]))
    df = landed(spark, files)
    found = []
    for n in (4096, 3, 1):
        monkeypatch.setattr(drift, "BLOCK_FILES", n)
        found.append(sorted(map(repr, drift.schema_changes(df).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) > 60
    numbered = drift.file_sequence(drift.file_catalogue(df)).collect()
    for feed in ("f0", "f1"):
        own = sorted((r.nth, r.file_id) for r in numbered if r.feed == feed)
        assert [f for _, f in own] == [i for _, i in sorted((i * 7 % 50, i) for i in range(60) if f"f{i % 2}" == feed)]
        assert [n for n, _ in own] == list(range(30)) and {r.last for r in numbered if r.feed == feed} == {29}


def drifted(spark, files):
    return {(r.file_id, r.change, r.old_field, r.new_field) for r in drift.schema_changes(landed(spark, files)).collect()}


def test_every_kind_of_change(spark):
    files = [
        ("a", 9, 0, [{"symbol": "X", "repaired": True, "volume": 1, "v": None}, {"symbol": "Y"}]),
        ("a", 4, 24 * 40, [{"ticker": "X", "is_repaired": False, "volume": None, "note": "n"}]),  # a month later; v is gone
        ("a", 7, 24 * 41, [{"ticker": "X", "repaired": "true", "volume": 1.0, "note": "n"}] * 2),  # another kind: no rename
        ("a", 8, 24 * 42, ["not json", None]),
        ("a", 3, 24 * 43, [{"ticker": 5, "repaired": [True]}]),
        ("b", 1, 0, [{"x": 1}]),
    ]
    assert drifted(spark, files) == {
        (4, "renamed", "symbol", "ticker"), (4, "renamed", "repaired", "is_repaired"), (4, "removed", "v", ""), (4, "added", "", "note"),
        (7, "removed", "is_repaired", ""), (7, "added", "", "repaired"), (7, "retyped", "volume", "volume"),
        *[(8, "removed", f, "") for f in ("ticker", "repaired", "volume", "note")], (3, "added", "", "ticker"), (3, "added", "", "repaired"),
    }


def test_all_null_fields_keep_their_kind(spark):
    files = [("a", 1, 0, [{"volume": 1}]), ("a", 2, 1, [{"vol": None}]), ("a", 3, 2, [{"vol": 2}]), ("a", 4, 3, [{"vol": "2"}]), ("a", 5, 4, [{}]), ("a", 6, 5, [{"vol": 1}])]
    assert drifted(spark, files) == {(2, "renamed", "volume", "vol"), (4, "retyped", "vol", "vol"), (5, "removed", "vol", ""), (6, "added", "", "vol")}
    assert drifted(spark, []) == set()


def test_unified_table(spark):
    files = [("a", 1, 0, [{"ticker": "X", "date": "2024-01-02", "vol": "7", "price_repaired": 1, "ingestTime": 1704067200, "extra": [1]}, {"symbol": "Y", "close": "bad"}])]
    got = {r.symbol: r for r in drift.unify(landed(spark, files), "ohlcv").collect()}
    assert (got["X"].date, got["X"].volume, got["X"].repaired, got["X"].ingested_at, got["X"].extras) == (date(2024, 1, 2), 7, True, datetime(2024, 1, 1), '{"extra":"[1]"}')
    assert got["Y"].close is None


def test_unified_epoch_units(spark):
    """The same second in seconds, milliseconds, microseconds and nanoseconds; fractions stay."""
    numbers = [1704067200, 1704067200000, "1704067200000", 1704067200000000, 1704067200000000000, 1674791366123, -1000, "99999999999999999999"]
    got = {r.line_no: r.ingested_at for r in drift.unify(landed(spark, [("a", 1, 0, [{"ingested_at": n} for n in numbers])]), "ohlcv").collect()}
    assert [got[n] for n in range(5)] == [datetime(2024, 1, 1)] * 5
    assert (got[5], got[6], got[7]) == (datetime(2023, 1, 27, 3, 49, 26, 123000), datetime(1969, 12, 31, 23, 43, 20), None)


def test_unified_booleans_and_uncast_values(spark):
    spellings = ["Y", "y", "N", " n ", True, 0, "maybe", None, ""]
    records = [{"check_ok": v} for v in spellings] + [{"value_num": "n/a", "run_date": "2024-01-02", "dataset": "[bad"}]
    unified = drift.unify(landed(spark, [("a", 1, 0, records)], "quality"), "quality")
    got = {r.line_no: r for r in unified.collect()}
    assert [got[n].passed for n in range(9)] == [True, True, False, False, True, False, None, None, None]
    assert [got[n].uncast for n in range(5, 10)] == [None, {"passed": "maybe"}, None, {"passed": ""}, {"value_num": "n/a", "dataset": "[bad"}]
    counts = {r.column: (r.present, r.uncast) for r in drift.uncast_counts(unified, "quality").collect()}
    assert {c: n for c, n in counts.items() if n[0]} == {"passed": (8, 2), "value_num": (1, 1), "run_date": (1, 0), "dataset": (1, 1)}
    assert set(counts) == set(drift.TARGETS["quality"])


def test_unified_queries_keep_undeclared_fields(spark, tmp_path):
    bar = {"symbol": "X", "currency": "EUR", "tags": ["a", "b"], "vwap": 63.26, "n_trades": None}
    landed(spark, [("a", 1, 0, [bar, {"symbol": "Y"}, '{"symbol": "Z", "muted": true, "muted": false}'])]).write.parquet(f"{tmp_path}/landed_rows.parquet")
    got = {r.symbol: r.extras for r in data_queries.p2_unified_ohlcv(spark, str(tmp_path)).collect()}
    assert json.loads(got["X"]) == {"currency": "EUR", "tags": '["a","b"]', "vwap": "63.26", "n_trades": None} and got["Y"] is None and "muted" in got["Z"]
    assert "extras" in data_queries.p2_unified_quality(spark, str(tmp_path)).columns
