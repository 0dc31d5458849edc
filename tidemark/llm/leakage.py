"""Evaluation texts leaking into training text, found by spaced-seed hashing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import words

#: A passage has at least this many consecutive words of the item ...
LEAST_WORDS = 28
#: ... and at most one edit (a word replaced, dropped or inserted) for this many words.
WORDS_PER_EDIT = 10
# The masks; 0 ignores a word. With one edit in ten words, a passage
# of 28 words or more has 7 words in a row without one, so a mask of that length always hits.
MASKS = ("1110111", "11011011")
#: Words on either side of a hit that are compared; any longer passage holds a shorter one around some hit.
REACH = 120
#: Up to so many bytes of item texts are indexed on the driver and sent to all tasks; beyond, seeds are joined.
INDEX_BYTES = 16 << 20
#: The seeds of more items are known to the documents' side by a bitmap of 2**BITMAP_BITS bits.
BITMAP_BITS = 28
#: Words whose hashes a worker keeps.
KEPT_WORDS = 500_000
_ODD = [np.uint64(xxhash.xxh64_intdigest(f"offset {i}") | 1) for i in range(16)]
_SIFT_BITS = 20


class _Hashes(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        return np.array([self[w] for w in words(text)], np.uint64)


def seeds(hashes: np.ndarray, sizes: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Seed of the mask at each place where it lies within one text: (place, seed)."""
    span = len(mask)
    if len(hashes) < span:
        return np.array([], np.int64), np.array([], np.uint64)
    value = np.full(len(hashes) - span + 1, xxhash.xxh64_intdigest(mask), np.uint64)
    for i, used in enumerate(mask):
        if used == "1":
            value += hashes[i : len(hashes) - span + 1 + i] * _ODD[i]
    ends = np.repeat(np.cumsum(sizes), sizes)
    inside = np.arange(len(value)) + span <= ends[: len(value)]
    place = np.flatnonzero(inside)
    return place, value[place]


def all_seeds(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds of all masks: (text, place in it, seed)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.concatenate(texts) if texts else np.array([], np.uint64)
    owner, start = np.repeat(np.arange(len(texts)), sizes), np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = [seeds(flat, sizes, mask) for mask in MASKS]
    place = np.concatenate([p for p, _ in found])
    return owner[place], place - start[place], np.concatenate([v for _, v in found])


def _too_short(tokens: np.ndarray) -> bool:
    return len(tokens) < LEAST_WORDS - LEAST_WORDS // WORDS_PER_EDIT


@dataclass
class SeedIndex:
    """Items by their seeds, sorted for binary search."""

    item_ids: list[int]
    tokens: list[np.ndarray]
    table: tuple[np.ndarray, np.ndarray, np.ndarray]  # seed, item, place in item
    sift: np.ndarray  # whether any seed begins with these bits

    @classmethod
    def of(cls, items: list[tuple[int, str | None]]) -> SeedIndex:
        known = _Hashes()
        texts = [(i, t) for i, t in ((i, known.of(t)) for i, t in items) if not _too_short(t)]
        item, at, value = all_seeds([t for _, t in texts])
        order = np.argsort(value, kind="stable")
        sift = np.zeros(1 << _SIFT_BITS, bool)
        sift[value >> np.uint64(64 - _SIFT_BITS)] = True
        return cls([i for i, _ in texts], [t for _, t in texts], (value[order], item[order], at[order]), sift)

    def hits(self, texts: list[np.ndarray]) -> np.ndarray:
        """Seed matches as rows (text, item, place in text, place in item), one for each diagonal and stretch of the item."""
        text, place, value = all_seeds(texts)
        some = self.sift[value >> np.uint64(64 - _SIFT_BITS)]
        text, place, value = text[some], place[some], value[some]
        seed, item, at = self.table
        left, right = np.searchsorted(seed, value, "left"), np.searchsorted(seed, value, "right")
        n = right - left
        which = np.repeat(left - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return one_a_stretch(np.stack([np.repeat(text, n), item[which], np.repeat(place, n), at[which]], axis=1))


def one_a_stretch(hits: np.ndarray) -> np.ndarray:
    """Of hits (text, item, place, at) the first on each diagonal and stretch of REACH // 4 words.

    Others lie so near that their surroundings tell nothing more: what is
    compared around a hit reaches farther by far than the passages looked for.
    """
    keys = np.stack([hits[:, 0], hits[:, 1], hits[:, 2] - hits[:, 3], hits[:, 3] // (REACH // 4)])
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    return hits[order[np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))]] if len(hits) else hits


def likely(hits: np.ndarray, texts: list[np.ndarray], items: list[np.ndarray], at_once: int = 10_000) -> np.ndarray:
    """Which hits have, near by, LEAST_WORDS words of the item that mostly occur near the hit's diagonal in the text.

    A passage of fewer than 2 * LEAST_WORDS words has ``edits`` at most, each
    moves the diagonal by one at most, and the hit that stands for its stretch
    lies within a stretch of it.
    """
    edits = (2 * LEAST_WORDS - 1) // WORDS_PER_EDIT
    wide = LEAST_WORDS + REACH // 4
    keep = np.zeros(len(hits), bool)
    sizes = np.array([len(i) for i in items], np.int64)
    item_starts, item_flat = np.cumsum(sizes) - sizes, np.concatenate([*items, np.zeros(1, np.uint64)])
    text_sizes = np.array([len(t) for t in texts], np.int64)
    text_starts, text_flat = np.cumsum(text_sizes) - text_sizes, np.concatenate([*texts, np.zeros(1, np.uint64)])
    for start in range(0, len(hits), at_once):
        text, item, place, at = hits[start : start + at_once].T
        where = at[:, None] + np.arange(-wide, wide + 1)
        inside = (where >= 0) & (where < sizes[item][:, None])
        own = item_flat[np.where(inside, item_starts[item][:, None] + where, -1)]
        there = where + (place - at)[:, None]
        near = np.zeros(where.shape, bool)
        for shift in range(-edits, edits + 1):
            ok = inside & (there + shift >= 0) & (there + shift < text_sizes[text][:, None])
            near |= ok & (own == text_flat[np.where(ok, text_starts[text][:, None] + there + shift, -1)])
        total = np.concatenate([np.zeros((len(text), 1), np.int64), np.cumsum(near, axis=1)], axis=1)
        most = (total[:, LEAST_WORDS:] - total[:, :-LEAST_WORDS]).max(axis=1)
        keep[start : start + at_once] = most >= np.minimum(LEAST_WORDS, sizes[item]) - edits
    return keep


def longest_passage(item: np.ndarray, text: np.ndarray, diagonal: int) -> bool:
    """Whether the text has a passage of the item around the diagonal.

    Runs of equal words are chained; between two runs the longer of the gaps in
    item and text counts as edits. Per run and number of edits the earliest
    start is kept. At either end edited words may count to the passage.
    """
    most = len(item) // WORDS_PER_EDIT + 1
    runs = _runs(item, text, diagonal, most)
    best: list[list[int]] = []
    for q, (a, b, n) in enumerate(runs):
        own = [a, *[len(item)] * most]
        for p in range(q):
            pa_, pb, pn = runs[p]
            overlap = max(0, pa_ + pn - a, pb + pn - b)
            if overlap >= n or pa_ >= a + overlap or pb >= b + overlap:
                continue
            gap = max(a + overlap - pa_ - pn, b + overlap - pb - pn)
            if gap > most:
                continue
            for e, start in enumerate(best[p][: most + 1 - gap]):
                if start < own[e + gap]:
                    own[e + gap] = start
        best.append(own)
        for e, start in enumerate(own):
            size = a + n - start
            extra = max(0, LEAST_WORDS - size)
            if start < len(item) and extra <= len(item) - size and (e + extra) * WORDS_PER_EDIT <= size + extra:
                return True
    return False


def _runs(item: np.ndarray, text: np.ndarray, diagonal: int, most: int) -> list[tuple[int, int, int]]:
    """Maximal runs of equal words within ``most`` of the diagonal: (place in item, in text, words), diagonal by diagonal."""
    runs = []
    for d in range(diagonal - most, diagonal + most + 1):
        low, high = max(0, -d), min(len(item), len(text) - d)
        if low >= high:
            continue
        same = np.concatenate(([0], item[low:high] == text[low + d : high + d], [0])).astype(np.int8)
        edge = np.flatnonzero(np.diff(same))
        runs += [(low + a, low + a + d, e - a) for a, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
    return sorted(runs)


def reproduces(item: np.ndarray, text: np.ndarray, place: int, at: int) -> bool:
    """Whether a passage of the item lies around a hit, ``place`` in the text and ``at`` in the item.

    REACH words on either side are compared, however long the two are. A longer
    passage with its share of edits can be cut into shorter ones of which one,
    too, has no more than its share, and that one has a hit of its own.
    """
    low, text_low = max(0, at - REACH), max(0, place - REACH - REACH // WORDS_PER_EDIT)
    own = item[low : at + REACH]
    part = text[text_low : place + REACH + REACH // WORDS_PER_EDIT]
    diagonal = (place - text_low) - (at - low)
    return longest_passage(own, part, diagonal)


def leaked_items(df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", index_bytes: int | None = None) -> DataFrame:
    """Each document with each item of which it reproduces a passage: doc_id, item_id.

    Typography, spacing and markup are taken off both sides. Hashes of the words
    that each mask uses are matched between documents and items; around each hit
    the words are compared with room for edits. Up to ``index_bytes`` of item
    texts (INDEX_BYTES if not given) the items' index has a known size and is
    sent to the tasks that read the documents, which are not shuffled. Beyond,
    both sides' seeds are joined (``joined_hits``).

    Cases: null or empty texts match nothing; null ids are left out. Items with
    fewer words than a passage needs can't leak. Repeated rows give repeated
    results, which are made distinct at the end. Whole texts are searched,
    however long.
    """
    documents = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    tests = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > (INDEX_BYTES if index_bytes is None else index_bytes):
        return joined_hits(documents, tests).distinct()
    index = df.sparkSession.sparkContext.broadcast(SeedIndex.of(sorted(tuple(r) for r in tests.collect())))
    shape = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, item_id {tests.schema['item_id'].dataType.simpleString()}"
    return documents.mapInArrow(_searcher(index), shape).distinct()


def _searcher(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        idx: SeedIndex = index.value
        ids = pa.array(idx.item_ids) if idx.item_ids else pa.array([], pa.int64())
        for batch in batches:
            tokens = [known.of(t) for t in batch.column(1).to_pylist()]
            if not len(ids):
                continue
            found: set[tuple[int, int]] = set()
            hits = idx.hits(tokens)
            for doc, item, place, at in hits[likely(hits, tokens, idx.tokens)].tolist():
                if (doc, item) not in found and reproduces(idx.tokens[item], tokens[doc], place, at):
                    found.add((doc, item))
            docs, items = pa.array([d for d, _ in found], pa.int64()), pa.array([i for _, i in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(docs), ids.take(items)], names=["doc_id", "item_id"])

    return run


def _seed_rows(sift):
    """(id, text) to (seed, id, place), where ``sift`` (a broadcast bitmap) is given only seeds in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        bitmap = None if sift is None else np.frombuffer(sift.value, np.uint8)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                own, place, value = all_seeds([known.of(t) for t in batch.column(1).slice(start, 1000).to_pylist()])
                if bitmap is not None:
                    bit = value & np.uint64((len(bitmap) << 3) - 1)
                    some = (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    own, place, value = own[some], place[some], value[some]
                ids = batch.column(0).slice(start, 1000).take(pa.array(own))
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), ids, pa.array(place)], names=["seed", "id", "place"])

    return run


def _bitmap(seeds_: DataFrame) -> bytes:
    """The low bits of all seeds as one bitmap of a fixed size."""
    bit = F.col("seed").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)) + 1
    parts = seeds_.select(F.bitmap_bucket_number(bit).alias("part"), F.bitmap_bit_position(bit).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    size = len(parts[0].bits) if parts else 0
    out = bytearray(1 << (BITMAP_BITS - 3))
    for row in parts:
        out[(row.part - 1) * size : row.part * size] = row.bits
    return bytes(out)


def joined_hits(documents: DataFrame, tests: DataFrame) -> DataFrame:
    """As ``leaked_items`` by a join of seeds, for items of any size: (doc_id, text) and (item_id, text) to (doc_id, item_id).

    Documents give up only seeds that a bitmap of fixed size knows. Seeds that
    items or documents have by the thousands are a skewed join, which adaptive
    execution splits; of the matches of a pair one is kept per diagonal and
    stretch. Then both texts are joined to the matches and compared.
    """
    kind, item_kind = (f.schema[c].dataType.simpleString() for f, c in ((documents, "doc_id"), (tests, "item_id")))
    of_items = tests.mapInArrow(_seed_rows(None), f"seed bigint, id {item_kind}, place bigint")
    sift = documents.sparkSession.sparkContext.broadcast(_bitmap(of_items))
    of_docs = documents.mapInArrow(_seed_rows(sift), f"seed bigint, id {kind}, place bigint")
    matches = of_docs.select("seed", F.col("id").alias("doc_id"), "place").join(of_items.select("seed", F.col("id").alias("item_id"), F.col("place").alias("at")), "seed")
    spots = matches.groupBy("doc_id", "item_id", (F.col("place") - F.col("at")).alias("diagonal"), F.expr(f"at div {REACH // 4}").alias("stretch")).agg(F.min("at").alias("at"))
    pairs = spots.join(documents, "doc_id").join(tests.withColumnRenamed("text", "item_text"), "item_id").select("doc_id", "item_id", "text", "item_text", (F.col("at") + F.col("diagonal")).alias("place"), "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            last: tuple[str, str] = ("", "")
            sides: dict[str, np.ndarray] = {}
            keep = []
            for text, item, place, at in zip(*[batch.column(c).to_pylist() for c in ("text", "item_text", "place", "at")], strict=True):
                if (text, item) != last:
                    last, sides = (text, item), {t: sides[t] if t in sides else known.of(t) for t in (text, item)}
                own = sides[item]
                keep.append(not _too_short(own) and at < len(own) and reproduces(own, sides[text], place, at))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("doc_id", "item_id")], names=["doc_id", "item_id"])

    return pairs.mapInArrow(run, f"doc_id {kind}, item_id {item_kind}")

