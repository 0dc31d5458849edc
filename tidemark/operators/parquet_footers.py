"""Footers of many Parquet files at once.

Small files of one producer have footers of the same shape: the same bytes but
for sizes, offsets and counts. The shape is learned from one footer; then all
others are read, or written, in a numpy step per number instead of a Python step
per number and file. Footers of other shapes are found out and learned in turn.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemark.operators.parquet_blocks import (
    BINARY, BYTE, CHUNK_CRYPTO_FIELDS, CHUNK_META, CHUNK_OFFSET, CHUNK_PATH, DOUBLE, FALSE, FILE_CREATED_BY, FILE_GROUPS, FILE_ROWS, FILE_SCHEMA, GROUP_COLUMNS, GROUP_COMPRESSED, GROUP_OFFSET, GROUP_ROWS,
    GROUP_SIZE, I16, I32, I64, LIST, META_CODEC, META_COMPRESSED, META_DATA_PAGE, META_DICTIONARY_PAGE, META_ENCODINGS, META_INDEX_PAGE, META_NAME, META_TYPE, META_UNCOMPRESSED, META_VALUES, SET, STRUCT, TRUE,
    ParquetBlockError, _put, _struct, _value, _varint, footer_bytes,
)

LITERAL, NUMBER, BYTES, SKIP = range(4)
# Codes of the encodings that need a dictionary page (parquet.thrift).
DICTIONARY_ENCODINGS = {2, 8}
_ALIKE = {META_TYPE, META_ENCODINGS, META_NAME, META_CODEC}


class Shape:
    """A footer as steps: bytes that are the same in all files, numbers, and parts that are passed over."""

    def __init__(self, footer: bytes):
        self.steps: list[list] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.first: list[int] = []
        self.schema = b""
        at = last = 0
        while head := footer[at]:
            start, kind, last = at, head & 15, last + (head >> 4)
            at += 1
            if head < 16 or last > FILE_GROUPS:
                raise ParquetBlockError("fields of the footer in another order")
            if last == FILE_GROUPS:
                self._literal(footer[start:at])
                at = self._trace(footer, at, kind, (last,))
                break
            if last == FILE_ROWS:
                self._literal(footer[start:at])
                at = self._trace(footer, at, kind, (last,))
            else:
                at = _value(footer, at, kind)[1]
                self._literal(footer[start:at])
                if last == FILE_SCHEMA:
                    self.prefix, self.schema = footer[:at], footer[start:at]
        self.tail = footer[at:]
        fields = _struct(footer, 0)[0]
        groups = fields.get(FILE_GROUPS)
        if groups is None or not self.schema or (FILE_ROWS,) not in self.numbers:
            raise ParquetBlockError("a footer without its fields")
        self.groups = groups[1][1]
        self.columns = len(self.groups[0][GROUP_COLUMNS][1][1]) if self.groups else 0
        for chunk in (c for g in self.groups for c in g[GROUP_COLUMNS][1][1]):
            if CHUNK_PATH in chunk or CHUNK_META not in chunk or CHUNK_CRYPTO_FIELDS & set(chunk):
                raise ParquetBlockError("column data in another file, or encrypted")
        #: What comes after the row groups of a file made of many: no metadata of single files.
        rest = bytearray()
        _put(rest, STRUCT, {n - FILE_GROUPS: v for n, v in fields.items() if n > FILE_GROUPS + 1} | {FILE_CREATED_BY - FILE_GROUPS: (BINARY, b"tidemark")})
        self.rest = bytes(rest)
        self.chunk_heads: dict[int, list[bytes]] = {}
        #: Files of the same key may share column chunks; None where pages need a dictionary of their own.
        self.key = self._chunk_key()

    def _chunk_key(self) -> tuple | None:
        key = []
        for group in self.groups:
            own = []
            for chunk in group[GROUP_COLUMNS][1][1]:
                meta = chunk[CHUNK_META][1]
                if META_DICTIONARY_PAGE in meta or META_INDEX_PAGE in meta or DICTIONARY_ENCODINGS & set(meta[META_ENCODINGS][1][1]):
                    return None
                own.append((meta[META_TYPE][1], meta[META_CODEC][1], tuple(meta[META_NAME][1][1])))
            key.append(tuple(own))
        return (self.schema, key[0]) if key and all(k == key[0] for k in key) else None

    def _literal(self, data: bytes) -> None:
        if self.steps and self.steps[-1][0] == LITERAL:
            self.steps[-1][1] += data
        else:
            self.steps.append([LITERAL, data, -1])

    def _trace(self, data: bytes, at: int, kind: int, path: tuple[int, ...]) -> int:
        alike = len(path) > 5 and path[2] == GROUP_COLUMNS and path[4] == CHUNK_META and path[5] in _ALIKE
        start = at
        if alike:
            at = _value(data, at, kind)[1]
            self._literal(data[start:at])
        elif kind == STRUCT:
            last = 0
            while head := data[at]:
                start, at = at, at + 1
                if head > 15:
                    last += head >> 4
                else:
                    n, at = _varint(data, at)
                    last = (n >> 1) ^ -(n & 1)
                self._literal(data[start:at])
                at = self._trace(data, at, head & 15, (*path, last))
            self._literal(b"\0")
            at += 1
        elif kind in (LIST, SET):
            size, inner = data[at] >> 4, data[at] & 15
            at += 1
            if size == 15:
                size, at = _varint(data, at)
            if inner in (TRUE, FALSE):
                at += size
                self._literal(data[start:at])
            else:
                self._literal(data[start:at])
                for i in range(size):
                    at = self._trace(data, at, inner, (*path, i))
        elif I16 <= kind <= I64:
            value, at = _value(data, at, kind)
            self.numbers[path] = len(self.first)
            self.steps.append([NUMBER, data[start:at], len(self.first)])
            self.first.append(value)
        elif kind == BINARY:
            at = _value(data, at, kind)[1]
            self.steps.append([BYTES, data[start:at], -1])
        elif kind in (BYTE, DOUBLE):
            at += 1 if kind == BYTE else 8
            self.steps.append([SKIP, data[start:at], -1])
        return at

    def read(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which footers (from ``at`` to ``end`` in ``data``) have this shape, and the numbers of all."""
        at, fits, limit = at.copy(), np.ones(len(at), bool), len(data) - 1
        values = np.zeros((len(at), len(self.first)), np.int64)
        for kind, literal, column in self.steps:
            if kind == LITERAL:
                there = data[np.minimum(at[:, None] + np.arange(len(literal)), limit)]
                fits &= (there == np.frombuffer(literal, np.uint8)).all(axis=1)
                at += len(literal)
            elif kind == SKIP:
                at += len(literal)
            else:
                number, at = _numbers(data, at, limit)
                if kind == BYTES:
                    at += np.minimum(number, len(data)).astype(np.int64)
                else:
                    values[:, column] = (number >> np.uint64(1)).astype(np.int64) ^ -(number & np.uint64(1)).astype(np.int64)
        return fits & (at <= end), values

    def write(self, values: np.ndarray) -> list[bytes]:
        """Footers with these numbers, else as the first."""
        same = (values == values[:1]).all(axis=0)
        first = values[0].tolist() if len(values) else []
        literals, varying = [bytearray()], []
        for kind, literal, column in self.steps:
            if kind != NUMBER:
                literals[-1] += literal
            elif same[column]:
                literals[-1] += packed(first[column])
            else:
                varying.append(column)
                literals.append(bytearray())
        literals[-1] += self.tail
        head, *rest = map(bytes, literals)
        known: dict[int, bytes] = {}
        out = []
        for row in values[:, varying].tolist():
            parts = [head]
            for number, literal in zip(row, rest, strict=True):
                if number not in known:
                    known[number] = packed(number)
                parts += (known[number], literal)
            out.append(b"".join(parts))
        return out


def packed(number: int) -> bytes:
    """A signed number in the compact protocol."""
    out = bytearray()
    _put(out, I64, number)
    return bytes(out)


def _numbers(data: np.ndarray, at: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length numbers at all places, and the places after them."""
    byte = data[np.minimum(at, limit)]
    value, at = (byte & 0x7F).astype(np.uint64), at + 1
    more, shift = np.flatnonzero(byte > 0x7F), 7
    while len(more) and shift < 64:
        byte = data[np.minimum(at[more], limit)]
        value[more] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
        at[more] += 1
        more, shift = more[byte > 0x7F], shift + 7
    return value, at


@dataclass
class FileBlocks:
    """Where the column chunks of a file lie: arrays by row group and column, and row counts."""

    shape: Shape
    rows: int
    group_rows: list[int]
    start: list[list[int]]
    compressed: list[list[int]]
    uncompressed: list[list[int]]
    values: list[list[int]]


def read_footers(blobs: list[bytes]) -> list[FileBlocks | ParquetBlockError]:
    """The blocks of each file, or why there are none."""
    out: list[FileBlocks | ParquetBlockError | None] = [None] * len(blobs)
    footers: list[bytes] = []
    for i, blob in enumerate(blobs):
        try:
            footers.append(footer_bytes(blob))
        except ParquetBlockError as e:
            out[i] = e
            footers.append(b"")
    sizes = np.array([len(f) for f in footers], np.int64)
    data = np.frombuffer(b"".join(footers) + b"\0", np.uint8)
    ends = np.cumsum(sizes)
    left = np.array([i for i, o in enumerate(out) if o is None], np.int64)
    lengths = np.array([len(b) for b in blobs], np.int64)
    while len(left):
        first = int(left[0])
        try:
            shape = Shape(footers[first])
            fits, values = shape.read(data, ends[left] - sizes[left], ends[left])
            _place(out, left[fits], shape, values[fits], lengths)
            if not fits[0]:
                raise ParquetBlockError("a footer that does not read as it was traced")
            left = left[~fits]
        except (ParquetBlockError, IndexError, KeyError) as e:
            out[first] = e if isinstance(e, ParquetBlockError) else ParquetBlockError(f"a footer that cannot be read: {e!r}")
            left = left[1:]
    return out  # type: ignore[return-value]


def _place(out: list, which: np.ndarray, shape: Shape, values: np.ndarray, lengths: np.ndarray) -> None:
    groups, columns = len(shape.groups), shape.columns
    if any(len(g[GROUP_COLUMNS][1][1]) != columns for g in shape.groups):
        raise ParquetBlockError("row groups of different columns")
    none = np.zeros(len(values), np.int64)
    number = lambda *path: values[:, shape.numbers[path]] if path in shape.numbers else none
    chunk = lambda g, c, f: number(FILE_GROUPS, g, GROUP_COLUMNS, c, CHUNK_META, f)
    grid = lambda f: np.stack([np.stack([chunk(g, c, f) for c in range(columns)], axis=1) for g in range(groups)], axis=1) if groups and columns else np.zeros((len(values), groups, columns), np.int64)
    page, dictionary = grid(META_DATA_PAGE), grid(META_DICTIONARY_PAGE)
    start = np.where((dictionary > 0) & (dictionary < page), dictionary, page)
    compressed, uncompressed, n = grid(META_COMPRESSED), grid(META_UNCOMPRESSED), grid(META_VALUES)
    rows = number(FILE_ROWS)
    group_rows = np.stack([number(FILE_GROUPS, g, GROUP_ROWS) for g in range(groups)], axis=1) if groups else np.zeros((len(values), 0), np.int64)
    inside = ((start >= 4) & (compressed >= 0) & (start + compressed <= lengths[which][:, None, None] - 8) | (group_rows == 0)[:, :, None]).all(axis=(1, 2))
    counted = group_rows.sum(axis=1) == rows
    for i, ok, same, *own in zip(which.tolist(), inside.tolist(), counted.tolist(), rows.tolist(), group_rows.tolist(), start.tolist(), compressed.tolist(), uncompressed.tolist(), n.tolist(), strict=True):
        if not ok:
            out[i] = ParquetBlockError("column data outside the file")
        elif not same:
            out[i] = ParquetBlockError("row counts of footer and row groups differ")
        else:
            out[i] = FileBlocks(shape, *own)


def page_locations(index: bytes) -> np.ndarray:
    """An offset index as rows of (first byte, bytes with the header, first row) of each page."""
    if index[:1] != b"\x19" or index[1] & 15 != STRUCT:
        raise ParquetBlockError("no offset index")
    size, at = index[1] >> 4, 2
    if size == 15:
        size, at = _varint(index, 2)
    data = np.frombuffer(index, np.uint8)[at:]
    # Every header and every number ends with a byte below 128: seven of them a page.
    ends = np.flatnonzero(data < 0x80)[: 7 * size]
    if len(ends) < 7 * size:
        raise ParquetBlockError("offset index cut short")
    starts = np.concatenate(([0], ends[:-1] + 1))
    values = np.zeros(len(ends), np.int64)
    for i in range(int((ends - starts).max(initial=0)) + 1):
        there = starts + i <= ends
        values[there] |= (data[starts[there] + i] & 0x7F).astype(np.int64) << (7 * i)
    table = values.reshape(size, 7)
    if (table[:, [0, 2, 4, 6]] != (1 << 4 | I64, 1 << 4 | I32, 1 << 4 | I64, 0)).any():
        raise ParquetBlockError("an offset index of another shape")
    return table[:, [1, 3, 5]] >> 1


def cut_pages(blob: memoryview, spans: np.ndarray, shape: Shape) -> list[bytes]:
    """Files of a page per column: ``spans`` has, by file and column, a page's first byte and length.

    ``shape`` is that of such a file; pages are not compressed, so that their
    lengths are the same either way.
    """
    sizes = spans[:, :, 1]
    at = 4 + np.cumsum(sizes, axis=1) - sizes
    values = np.repeat(np.array([shape.first], np.int64), len(spans), axis=0)
    for path, column in shape.numbers.items():
        if len(path) == 6 and path[4] == CHUNK_META:
            own = {META_DATA_PAGE: at[:, path[3]], META_COMPRESSED: sizes[:, path[3]], META_UNCOMPRESSED: sizes[:, path[3]]}.get(path[5])
        elif path[2:3] == (GROUP_COLUMNS,):
            own = at[:, path[3]] if path[4:] == (CHUNK_OFFSET,) and shape.first[column] else None
        else:
            own = {(GROUP_SIZE,): sizes.sum(axis=1), (GROUP_COMPRESSED,): sizes.sum(axis=1), (GROUP_OFFSET,): np.full(len(spans), 4)}.get(path[2:])
        if own is not None:
            values[:, column] = own
    footers = shape.write(values)
    return [b"".join((b"PAR1", *[blob[a : a + n] for a, n in pages], f, len(f).to_bytes(4, "little"), b"PAR1")) for pages, f in zip(spans.tolist(), footers, strict=True)]
