"""Byte-level BPE over a whole corpus by batched numpy merge rounds."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Where the public vocabularies lie; a parameter of every call.
TOKENIZERS_DIR = "/opt/tokenizers"
# Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words whose ids a worker keeps between batches; beyond that it forgets them all and goes on.
KEPT_WORDS = 200_000
#: Words longer than this many bytes are not kept.
KEPT_BYTES = 64
NEVER = np.iinfo(np.int64).max


class ByteBPE:
    """The merges of a rank file as sorted pair keys.

    A pair of ids (a, b) that merges has key a << 32 | b; the ids of merged
    tokens are their ranks, so the pair with the lowest resulting id goes first.
    """

    def __init__(self, path: str):
        import regex

        self.split = regex.compile(PATTERN).findall
        ranks = {}
        for line in Path(path).read_bytes().splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, results = self._merges(ranks)
        order = np.argsort(keys)
        self.keys, self.results = keys[order], results[order]
        self.known: dict[str, np.ndarray] = {}

    @staticmethod
    def _merges(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Every pair of tokens whose concatenation is a token, with that token's id."""
        keys, results = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    results.append(rank)
        return np.array(keys, np.int64), np.array(results, np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id each pair merges to, or NEVER."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.results[at], NEVER)

    def merge_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word. All words are merged together, round by round.

        In a round each word merges every occurrence of its lowest-ranked pair,
        from left to right; words without a pair leave the flat array.
        """
        out: list[np.ndarray] = [None] * len(words)  # type: ignore[list-item]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        for empty in np.flatnonzero(lengths == 0):
            out[empty] = symbols[:0]
        while len(symbols):
            same = owner[1:] == owner[:-1]
            rank = np.full(len(symbols), NEVER)
            rank[:-1][same] = self._rank(symbols[:-1][same], symbols[1:][same])
            starts = np.flatnonzero(np.concatenate(([True], ~same)))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            done = best == NEVER
            if done.any():
                for i, at, size in zip(owner[starts[done]].tolist(), starts[done].tolist(), sizes[done].tolist(), strict=True):
                    out[i] = symbols[at : at + size]
                stay = np.repeat(~done, sizes)
                symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
                best, sizes = best[~done], sizes[~done]
                if not len(symbols):
                    break
            hit = np.flatnonzero((rank == np.repeat(best, sizes)) & (rank != NEVER))
            # Of overlapping hits (a a a) each run keeps its 1st, 3rd, ...; a run ends where hits aren't neighbours.
            gap = np.concatenate(([True], np.diff(hit) != 1))
            run_start = np.maximum.accumulate(np.where(gap, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
            symbols[hit] = rank[hit]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return out

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, as ordinary text throughout; null and empty give no ids."""
        split = [self.split(t) if t else [] for t in texts]
        new = list({w for words in split for w in words if w not in self.known})
        fresh: dict[str, np.ndarray] = {}
        if new:
            fresh = dict(zip(new, self.merge_words([w.encode("utf-8", "replace") for w in new]), strict=True))
        lookup = self.known
        out = []
        for words in split:
            parts = [fresh[w] if w in fresh else lookup[w] for w in words]
            out.append(np.concatenate(parts) if parts else np.array([], np.int64))
        if len(self.known) + len(fresh) > KEPT_WORDS:
            self.known = {}
        self.known |= {w: ids.copy() for w, ids in fresh.items() if len(w) <= KEPT_BYTES}
        return out


_loaded: dict[str, ByteBPE] = {}


def tokenizer(path: str) -> ByteBPE:
    """The tokenizer of a rank file, once for each worker."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def encode_corpus(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rank_file: str = f"{TOKENIZERS_DIR}/byte_bpe_50k.tiktoken", batch_chars: int = 4_000_000) -> DataFrame:
    """Token ids of every text: columns doc_id and ids (list of int).

    A row in, a row out, without a shuffle. Cases: null and empty texts give an
    empty list; white space is text; strings that look like special tokens are
    ordinary text; a very long text is encoded whole. Repeated rows are encoded
    each; other columns are not read. The rank file must lie at the same path on
    every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(rank_file)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < batch_chars):
                    size += len(texts[end] or "")
                    end += 1
                encoded = bpe.encode_batch(texts[at:end])
                offsets = np.concatenate(([0], np.cumsum([len(e) for e in encoded])))
                values = np.concatenate(encoded).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([ids.slice(at, end - at), lists], names=["doc_id", "ids"])
                at = end

    kind = df.schema[doc_id].dataType.simpleString()
    return df.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, ids array<int>")
