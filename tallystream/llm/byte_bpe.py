"""Byte-level BPE encoding and decoding with a given table of ranks.

A text is cut into words by the tokenizer's pattern. Each distinct word is folded once: from its single bytes
on, the neighbouring pair whose joined bytes have the lowest rank is merged, the leftmost of equal ones first,
until no pair has a rank. Words met before are looked up; the table of words is emptied when it holds
``most_words``, so memory is bounded and results do not depend on it. Decoding concatenates the byte pieces of
the ids. Both are maps without a shuffle: a lost task is run again by itself.

The ranks are read where the job is started and broadcast; their number is fixed by the vocabulary file.

A null text counts as empty and has no ids; a null id is kept. Very long words are folded with a heap, in
n log n. Repeated rows come out as often as they came in; empty tables give no rows. Other columns are neither
read nor returned.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG_WORD, BYTES_AT_ONCE, IDS_AT_ONCE = 48, 8 << 20, 1 << 16
NO_RANK = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a base64 piece and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_WORD:
        return _fold_long(word, ranks)
    get = ranks.get
    parts = [word[k:k + 1] for k in range(len(word))]
    rank = [get(word[k:k + 2], NO_RANK) for k in range(len(word) - 1)]
    while rank:
        least = min(rank)
        if least == NO_RANK:
            break
        at = rank.index(least)
        parts[at] += parts.pop(at + 1)
        del rank[at]
        if at < len(rank):
            rank[at] = get(parts[at] + parts[at + 1], NO_RANK)
        if at:
            rank[at - 1] = get(parts[at - 1] + parts[at], NO_RANK)
    return [ranks[part] for part in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs; a pair that has changed since is recognised by its end."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(word[k:k + 2])) is not None]
    heapify(heap)
    alive = bytearray(b"\1") * n

    def offer(k: int) -> None:
        if k >= 0 and end[k] < n:
            stop = end[end[k]]
            rank = ranks.get(word[k:stop])
            if rank is not None:
                heappush(heap, (rank, k, stop))

    while heap:
        _, k, stop = heappop(heap)
        if not alive[k] or end[k] >= n or end[end[k]] != stop or end[k] == stop:
            continue
        alive[end[k]] = 0
        end[k] = stop
        if stop < n:
            before[stop] = k
        offer(k)
        offer(before[k])
    ids, k = [], 0
    while k < n:
        ids.append(ranks[word[k:end[k]]])
        k = end[k]
    return ids


class _Words(dict):
    """Ids of words as little-endian bytes, worked out on first use."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = b"".join([k.to_bytes(4, "little") for k in fold(word.encode(), self.ranks)])
        return ids


class _Pieces:
    """The pieces of all ids as one run of bytes, to join those of many ids at once."""

    def __init__(self, ranks: dict[bytes, int]):
        size = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
        for piece, rank in ranks.items():
            size[rank] = len(piece)
        self.size, self.start = size, np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
        self.data = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def joined(self, ids: bytes) -> bytes:
        codes, out = np.frombuffer(ids, "<u4"), []
        for k in range(0, len(codes), IDS_AT_ONCE):
            some = codes[k:k + IDS_AT_ONCE]
            size = self.size[some]
            if (size < 0).any():
                raise IndexError("an id is not in the table")
            shift = self.start[some] - (np.cumsum(size) - size)
            out.append(self.data[np.repeat(shift, size) + np.arange(size.sum())].tobytes())
        return b"".join(out)


def _batches(ids: list, values: list, names: list[str]):
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.binary())], names)


def _mapped(of, names: list[str]):
    """A function on (id, value) batches that applies ``of`` to each value and bounds the batches it returns."""
    def run(batches):
        for batch in batches:
            ids, values, held = [], [], 0
            for id_, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(id_)
                values.append(of(value.as_py()))
                held += len(values[-1])
                if held >= BYTES_AT_ONCE:
                    yield _batches(ids, values, names)
                    ids, values, held = [], [], 0
            yield _batches(ids, values, names)
    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
           most_words: int = 400_000) -> DataFrame:
    """(id, ids): the ids of each whole text as little-endian unsigned 32-bit integers. No special tokens."""
    known = docs.sparkSession.sparkContext.broadcast(ranks)

    def start(batches):
        words, find = _Words(known.value), regex.compile(pattern).findall

        def of(text):
            if len(words) > most_words:
                words.clear()
            return b"".join([words[word] for word in find(text or "")])

        yield from _mapped(of, ["id", "ids"])(batches)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(start, "id long, ids binary")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(id, ids, decoded): the bytes that the ids stand for; an id outside the table fails the job."""
    known = encoded.sparkSession.sparkContext.broadcast(ranks)

    def start(batches):
        pieces = _Pieces(known.value)

        def of(ids):
            return pieces.joined(ids or b"")

        for batch in batches:
            at = 0
            for done in _mapped(of, ["id", "decoded"])([batch]):
                yield pa.RecordBatch.from_arrays(
                    [done.column(0), batch.column(1).slice(at, len(done)), done.column(1)], ["id", "ids", "decoded"])
                at += len(done)

    return encoded.select("id", "ids").mapInArrow(start, "id long, ids binary, decoded binary")
