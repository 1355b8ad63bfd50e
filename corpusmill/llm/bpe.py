"""Problem 8: token ids of every text under a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# The split pattern that belongs to the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_DIR = "/opt/tokenizers"
#: Pieces remembered by a task; beyond it the memory is emptied, results stay the same.
REMEMBER = 200_000
_NONE = 1 << 62


def read_ranks(name: str = "byte_bpe_50k", directory: str | None = None) -> dict[bytes, int]:
    """Token bytes to id, from a file of base64 token and rank per line. A vocabulary file has a fixed size (about 1 MB)."""
    with open(os.path.join(directory or DEFAULT_DIR, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merge the leftmost pair of least rank until none can be merged.

    A segment tree holds for each position the rank of the pair that begins there; its root yields the least rank and
    of equal ones the leftmost, and each merge updates three leaves: O(n log n) for a piece of n bytes.
    """
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    get = ranks.get
    stop = list(range(1, n + 1))  # where the token that begins at i ends
    before = list(range(-1, n - 1))  # where the token before it begins
    size = 1 << (n - 1).bit_length()
    # A key holds rank and position, so that the least key is the leftmost pair of least rank.
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            tree[size + i] = r * n + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a <= b else b

    def update(leaf: int, key: int) -> None:
        i = size + leaf
        tree[i] = key
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            least = a if a <= b else b
            if tree[i] == least:
                return
            tree[i] = least
            i >>= 1

    while tree[1] != _NONE:
        i = tree[1] % n
        j = stop[i]
        end = stop[i] = stop[j]
        update(j, _NONE)
        r = get(piece[i : stop[end]]) if end < n else None
        update(i, _NONE if r is None else r * n + i)
        if end < n:
            before[end] = i
        if (h := before[i]) >= 0:
            r = get(piece[h:end])
            update(h, _NONE if r is None else r * n + h)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : stop[i]]])
        i = stop[i]
    return ids


class Encoder:
    """Encodes texts with one vocabulary; remembers the ids of pieces seen."""

    def __init__(self, ranks: dict[bytes, int]):
        import regex

        self.ranks, self.split, self.known = ranks, regex.compile(PATTERN).findall, {}

    def encode(self, text: str) -> list[int]:
        known, out = self.known, []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= REMEMBER:
                    known.clear()
                ids = merge(piece.encode(), self.ranks)
                if len(piece) < 64:
                    known[piece] = ids
            out += ids
        return out


def token_ids(documents: DataFrame, vocabulary: str = "byte_bpe_50k", directory: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) of every row; rows in, rows out.

    A null and an empty text give an empty array. What looks like a special token is plain text. A narrow map: no
    shuffle; the ranks (fixed size) go to the executors as a broadcast variable.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(vocabulary, directory))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, ends = array("i"), [0]
                for t in part.column(1).to_pylist():
                    if t:
                        ids.extend(encoder.encode(t))
                    ends.append(len(ids))
                values = pa.array(np.frombuffer(ids, np.int32) if len(ids) else np.zeros(0, np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=[key, "ids"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(encode, f"`{key}` {kind}, ids array<int>")
