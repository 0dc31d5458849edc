"""Joining Parquet files by copying their encoded column blocks.

A footer is read and written in Thrift's compact protocol, without knowing more
of its structures than the offsets that move. Column data are never decoded.
"""

from __future__ import annotations

from typing import Any

MAGIC = b"PAR1"
# Field numbers of the Parquet footer (parquet.thrift).
FILE_SCHEMA, FILE_ROWS, FILE_GROUPS, FILE_CREATED_BY = 2, 3, 4, 6
GROUP_COLUMNS, GROUP_SIZE, GROUP_ROWS, GROUP_SORTED, GROUP_OFFSET, GROUP_COMPRESSED, GROUP_ORDINAL = 1, 2, 3, 4, 5, 6, 7
CHUNK_PATH, CHUNK_OFFSET, CHUNK_META = 1, 2, 3
CHUNK_INDEX_FIELDS = (4, 5, 6, 7)
CHUNK_INDEX_AT, CHUNK_INDEX_LENGTH = 4, 5
CHUNK_CRYPTO_FIELDS = {8, 9}
META_TYPE, META_ENCODINGS, META_NAME, META_CODEC, META_VALUES, META_UNCOMPRESSED, META_COMPRESSED, META_DATA_PAGE, META_INDEX_PAGE, META_DICTIONARY_PAGE = 1, 2, 3, 4, 5, 6, 7, 9, 10, 11
META_BLOOM_FIELDS = (14, 15)
# Type codes of the compact protocol.
TRUE, FALSE, BYTE, I16, I32, I64, DOUBLE, BINARY, LIST, SET, MAP, STRUCT = range(1, 13)
#: A struct that is given as its bytes.
RAW = -1


class ParquetBlockError(ValueError):
    """A file that can't be joined by copying blocks."""


def _varint(data: bytes, at: int) -> tuple[int, int]:
    shift = value = 0
    while (byte := data[at]) > 0x7F:
        value |= (byte & 0x7F) << shift
        shift += 7
        at += 1
    return value | byte << shift, at + 1


def _value(data: bytes, at: int, kind: int) -> tuple[Any, int]:
    if kind == BINARY:
        size, at = _varint(data, at)
        return data[at : at + size], at + size
    if kind in (I16, I32, I64):
        n, at = _varint(data, at)
        return (n >> 1) ^ -(n & 1), at
    if kind == STRUCT:
        return _struct(data, at)
    if kind in (LIST, SET):
        head = data[at]
        at += 1
        size, inner = head >> 4, head & 15
        if size == 15:
            size, at = _varint(data, at)
        if inner in (TRUE, FALSE):
            return (inner, list(data[at : at + size])), at + size
        items = []
        for _ in range(size):
            item, at = _value(data, at, inner)
            items.append(item)
        return (inner, items), at
    if kind in (TRUE, FALSE):
        return None, at
    if kind in (BYTE, DOUBLE):
        size = 1 if kind == BYTE else 8
        return data[at : at + size], at + size
    raise ParquetBlockError(f"type {kind} in a footer")


def _struct(data: bytes, at: int) -> tuple[dict[int, tuple[int, Any]], int]:
    """Field number -> (type, value), and the place after the struct."""
    fields: dict[int, tuple[int, Any]] = {}
    last = 0
    while head := data[at]:
        at += 1
        kind = head & 15
        if head > 15:
            last += head >> 4
        else:
            n, at = _varint(data, at)
            last = (n >> 1) ^ -(n & 1)
        if I16 <= kind <= I64 and (byte := data[at]) < 0x80:  # most numbers take a byte
            fields[last] = (kind, (byte >> 1) ^ -(byte & 1))
            at += 1
        else:
            value, at = _value(data, at, kind)
            fields[last] = (kind, value)
    return fields, at + 1


def _put_varint(out: bytearray, n: int) -> None:
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)


def _put(out: bytearray, kind: int, value: Any) -> None:
    if I16 <= kind <= I64:
        _put_varint(out, (value << 1) ^ (value >> 63))
    elif kind == BINARY:
        _put_varint(out, len(value))
        out += value
    elif kind == RAW:
        out += value
    elif kind == STRUCT:
        last = 0
        for number in sorted(value):
            inner, item = value[number]
            code = STRUCT if inner == RAW else inner
            if 0 < number - last < 16:
                out.append(number - last << 4 | code)
            else:
                out.append(code)
                _put_varint(out, (number << 1) ^ (number >> 63))
            _put(out, inner, item)
            last = number
        out.append(0)
    elif kind in (LIST, SET):
        inner, items = value
        out.append(min(len(items), 15) << 4 | (STRUCT if inner == RAW else inner))
        if len(items) >= 15:
            _put_varint(out, len(items))
        if inner in (TRUE, FALSE):
            out += bytes(items)
        else:
            for item in items:
                _put(out, inner, item)
    elif kind in (BYTE, DOUBLE):
        out += value


def footer_bytes(blob: bytes) -> bytes:
    if len(blob) < 12 or blob[:4] != MAGIC or blob[-4:] != MAGIC:
        raise ParquetBlockError("no Parquet file")
    size = int.from_bytes(blob[-8:-4], "little")
    if size + 12 > len(blob):
        raise ParquetBlockError("footer longer than the file")
    return bytes(blob[len(blob) - 8 - size : len(blob) - 8])


def read_footer(blob: bytes) -> dict[int, tuple[int, Any]]:
    try:
        return _struct(footer_bytes(blob), 0)[0]
    except IndexError as e:
        raise ParquetBlockError("footer cut short") from e


def _moved(group: dict[int, tuple[int, Any]], by: int) -> None:
    """Shift a row group's offsets; page indexes and bloom filters, which lie outside it, are left behind."""
    for chunk in group[GROUP_COLUMNS][1][1]:
        if CHUNK_PATH in chunk:
            raise ParquetBlockError("column data in another file")
        for number in CHUNK_INDEX_FIELDS:
            chunk.pop(number, None)
        meta = chunk[CHUNK_META][1]
        for number in META_BLOOM_FIELDS:
            meta.pop(number, None)
        for fields, number in ((meta, META_DATA_PAGE), (meta, META_INDEX_PAGE), (meta, META_DICTIONARY_PAGE), (chunk, CHUNK_OFFSET)):
            if number in fields and fields[number][1]:
                fields[number] = (fields[number][0], fields[number][1] + by)
    if GROUP_OFFSET in group:
        group[GROUP_OFFSET] = (I64, group[GROUP_OFFSET][1] + by)


def _extent(group: dict[int, tuple[int, Any]]) -> tuple[int, int]:
    """First byte of a row group's column data and the byte after the last."""
    spans = []
    for chunk in group[GROUP_COLUMNS][1][1]:
        meta = chunk[CHUNK_META][1]
        pages = [meta[n][1] for n in (META_DICTIONARY_PAGE, META_DATA_PAGE) if n in meta and meta[n][1] > 0]
        spans.append((min(pages), min(pages) + meta[META_COMPRESSED][1]))
    return min(s for s, _ in spans), max(e for _, e in spans)


def _chunk_heads(shapes: list) -> list[bytes]:
    """By column, a chunk that pages of all ``shapes`` (with a row group each) share, up to where its numbers begin."""
    first, g = shapes[0]
    if len(shapes) == 1 and (known := first.chunk_heads.get(g)):
        return known
    heads = []
    for c, chunk in enumerate(first.groups[g][GROUP_COLUMNS][1][1]):
        meta = {k: v for k, v in chunk[CHUNK_META][1].items() if k < META_VALUES}
        meta[META_ENCODINGS] = (LIST, (I32, sorted({e for s, at in shapes for e in s.groups[at][GROUP_COLUMNS][1][1][c][CHUNK_META][1][META_ENCODINGS][1][1]})))
        own = bytearray()
        _put(own, STRUCT, {CHUNK_OFFSET: (I64, 0), CHUNK_META: (STRUCT, meta)})
        heads.append(bytes(own[:-2]))  # neither struct is closed
    if len(shapes) == 1:
        first.chunk_heads[g] = heads
    return heads


def _merged_group(parts: list, out: bytearray) -> dict[int, tuple[int, Any]]:
    """One row group of the pages of many, column by column: ``parts`` are (blob, its blocks, row group)."""
    first = len(out)
    pages = zip(*[[blob[s : s + n] for s, n in zip(b.start[g], b.compressed[g], strict=True)] for blob, b, g in parts], strict=True)
    totals = lambda name: [sum(column) for column in zip(*[getattr(b, name)[g] for _, b, g in parts], strict=True)]
    raw, n = totals("uncompressed"), totals("values")
    shapes = list({id(b.shape): (b.shape, g) for _, b, g in parts}.values())
    heads = _chunk_heads(shapes)
    chunks = []
    for own, head, *numbers in zip(pages, heads, n, raw, strict=True):
        at = len(out)
        out += b"".join(own)
        chunk = bytearray(head)
        _put(chunk, STRUCT, {1: (I64, numbers[0]), 2: (I64, numbers[1]), 3: (I64, len(out) - at), 3 + META_DATA_PAGE - META_COMPRESSED: (I64, at)})
        chunks.append(chunk + b"\0")
    rows = sum([b.group_rows[g] for _, b, g in parts])
    return {GROUP_COLUMNS: (LIST, (RAW, chunks)), GROUP_SIZE: (I64, sum(raw)), GROUP_ROWS: (I64, rows), GROUP_OFFSET: (I64, first), GROUP_COMPRESSED: (I64, len(out) - first)}


def join_blocks(blobs: list[bytes], blocks: list, group_bytes: int = 128 << 20) -> tuple[bytes, int, int]:
    """One Parquet file of all ``blobs`` (of one schema, with their blocks as read by ``read_footers``): (file, blocks copied, rows).

    Pages without a dictionary are laid one after another in common column
    chunks, a row group for each ``group_bytes``; what has a dictionary is copied
    as a row group of its own. Nothing is decoded. A file without rows adds none.
    """
    out = bytearray(MAGIC)
    groups: list[dict[int, tuple[int, Any]]] = []
    merging: dict[tuple, list] = {}
    single = []
    copied = 0
    for blob, own in zip(blobs, blocks, strict=True):
        if isinstance(own, ParquetBlockError):
            raise own
        if own.shape.schema != blocks[0].shape.schema:
            raise ParquetBlockError("schemas differ")
        for g, n in enumerate(own.group_rows):
            copied += 1
            if n and own.shape.key is not None:
                merging.setdefault(own.shape.key, []).append((blob, own, g))
            elif n:
                single.append((blob, g))
    for parts in merging.values():
        held: list = []
        size = 0
        for part in parts:
            held.append(part)
            size += sum(part[1].compressed[part[2]])
            if size >= group_bytes:
                groups.append(_merged_group(held, out))
                held, size = [], 0
        if held:
            groups.append(_merged_group(held, out))
    for blob, g in single:
        group = read_footer(blob)[FILE_GROUPS][1][1][g]
        start, end = _extent(group)
        if not 4 <= start <= end <= len(blob) - 8:
            raise ParquetBlockError("column data outside the file")
        _moved(group, len(out) - start)
        out += blob[start:end]
        groups.append(group)
    for ordinal, group in enumerate(groups):
        group[GROUP_ORDINAL] = (I16, ordinal % 32768)
    shape = blocks[0].shape
    rows = sum([b.rows for b in blocks])
    tail = bytearray(shape.prefix)
    _put(tail, STRUCT, {FILE_ROWS - FILE_SCHEMA: (I64, rows), FILE_GROUPS - FILE_SCHEMA: (LIST, (STRUCT, groups))})
    tail[-1:] = shape.rest
    out += tail + len(tail).to_bytes(4, "little") + MAGIC
    return bytes(out), copied, rows
