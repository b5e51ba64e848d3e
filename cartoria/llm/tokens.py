"""Problem 8: encoding texts with a public byte-level BPE vocabulary.

The merges are found on a contiguous array of part boundaries with the rank of each adjacent pair:
scan for the smallest rank, delete the boundary between the two parts, refresh the two ranks beside it.
That is quadratic in a word's length, so words over ``LONG`` bytes use the same steps with a heap in place of the scan.
"""

from __future__ import annotations

import base64
import heapq
import os
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartoria.sources.tables import table

#: Folder of the vocabulary files.
TOKENIZERS = os.environ.get("CARTORIA_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the pattern that cuts a text into words before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 200
#: Words remembered by one Python worker; beyond it the memory starts anew, which costs time only.
REMEMBERED = 300_000
NONE = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, which is the token's id."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word by repeated scans of the rank array."""
    get = ranks.get
    bounds = list(range(len(word) + 1))
    near = [get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    while near:
        least = min(near)
        if least == NONE:
            break
        i = near.index(least)
        del bounds[i + 1], near[i]
        if i < len(near):
            near[i] = get(word[bounds[i] : bounds[i + 2]], NONE)
        if i:
            near[i - 1] = get(word[bounds[i - 1] : bounds[i + 1]], NONE)
    return [ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids with a heap of ranks: n log n for words of any length."""
    get, n = ranks.get, len(word)
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    end = array("l", range(1, n + 1))
    heap = [(r, i) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\1" * n)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or get(word[i : end[j]]) != rank:
            continue
        alive[j] = 0
        end[i] = end[j]
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
            if (r := get(word[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i))
        if (k := before[i]) >= 0 and (r := get(word[k : end[i]])) is not None:
            heapq.heappush(heap, (r, k))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


class Encoder:
    """Encodes texts; remembers the ids of words it has met."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self.split = regex.compile(PATTERN).findall
        self.words: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        whole = self.ranks.get(raw)
        if whole is not None:
            ids = [whole]
        else:
            ids = merge_short(raw, self.ranks) if len(raw) <= LONG else merge_long(raw, self.ranks)
        if len(raw) <= LONG:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of a text; strings that look like special tokens are ordinary text; [] for ''."""
        known, new, out = self.words.get, self.word, []
        for w in self.split(text):
            out += known(w) or new(w)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process for a vocabulary file, which ``encode`` ships to every executor."""
    if path not in _encoders:
        shipped = SparkFiles.get(os.path.basename(path))
        _encoders[path] = Encoder(shipped if os.path.exists(shipped) else path)
    return _encoders[path]


def encode(df: DataFrame, id: str, text: str, path: str, counts_only: bool = False) -> DataFrame:
    """``id`` and ``ids`` (array<int>), or ``n_tokens`` with ``counts_only``; one row for each row of ``df``.

    Null and empty texts give an empty list. Whole texts are encoded, whatever their length. The ids stay in
    Arrow buffers: one flat array and its offsets for each batch.
    """
    df.sparkSession.sparkContext.addFile(path)
    kind = df.schema[id].dataType.simpleString()
    wanted = "n_tokens bigint" if counts_only else "ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_one = encoder(path).encode
        for batch in batches:
            flat, offsets = array("i"), array("i", [0])
            parts = []
            for t in batch.column(1).to_pylist():
                ids = encode_one(t) if t else []
                if counts_only:
                    offsets.append(len(ids))
                    continue
                if len(flat) + len(ids) > 16_000_000:
                    parts.append((flat, offsets))
                    flat, offsets = array("i"), array("i", [0])
                flat.extend(ids)
                offsets.append(len(flat))
            if counts_only:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(offsets[1:], pa.int64())], [id, "n_tokens"])
                continue
            at = 0
            for flat, offsets in [*parts, (flat, offsets)]:
                n = len(offsets) - 1
                lists = pa.ListArray.from_arrays(pa.Array.from_buffers(pa.int32(), n + 1, [None, pa.py_buffer(offsets)]), pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), lists], [id, "ids"])
                at += n

    return df.select(id, F.col(text).cast("string")).mapInArrow(run, f"`{id}` {kind}, {wanted}")


def p8_ids(spark: SparkSession, directory: str) -> DataFrame:
    """The token ids of each document."""
    return encode(table(spark, directory, "documents"), "doc_id", "text", f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


QUERIES = {"p8_ids": p8_ids}
SQL: dict[str, str] = {}
