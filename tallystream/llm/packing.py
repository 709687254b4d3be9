"""Best-fit packing into sequences of several permitted lengths.

A document of more tokens than the largest length is cut into pieces of that length and a rest. Pieces are
packed longest first. A piece goes to the open sequence that it leaves with the least room; if none has room, a
new one is opened. For each permitted length the pieces still to be placed tell how far it can be filled (the longest
that fits, again and again), and the length that costs least for each token in it is opened; a sequence costs its
length and ``overhead`` tokens more. In the end each sequence is downsized to the smallest permitted length that holds
its contents. The same is done with the largest length alone, and a shard keeps the plan that costs less.

Only ids and lengths are shuffled, never texts. Pieces are dealt by the hash of (id, row, piece) to shards of
about ``shard_rows`` pieces, which are packed independently, so that a task's size is bounded whatever ids or
lengths repeat; shards come out within one sequence of each other's padding.

A null text counts as empty; a text without tokens has one piece of length 0, which takes no room. A null id
is kept. Repeated rows are packed each. Empty tables give no rows. Other columns are not returned.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.common import settle


def word_count(text: Column) -> Column:
    """Words of a text, as a stand-in for its tokens where none are given."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\s]+")), F.lit(0))


class _Ahead:
    """The lengths that are still to be placed, with their numbers."""

    def __init__(self, lengths: np.ndarray):
        values, counts = np.unique(lengths[lengths > 0], return_counts=True)
        self.values, self.counts = values.tolist(), dict(zip(values.tolist(), counts.tolist()))

    def take(self, length: int) -> None:
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length]
            self.values.pop(bisect_left(self.values, length))

    def fill(self, room: int) -> int:
        """How many tokens go into this room if the longest that fits is placed again and again."""
        filled, at = 0, bisect_right(self.values, room)
        while at and room:
            length = self.values[at - 1]
            times = min(room // length, self.counts[length])
            filled, room = filled + times * length, room - times * length
            at = min(at - 1, bisect_right(self.values, room))
        return filled


def _fitted(used: list[int], capacities: tuple[int, ...]) -> np.ndarray:
    """The smallest permitted size of each bin for what it holds."""
    return np.array(capacities, np.int64)[np.searchsorted(capacities, np.array(used, np.int64))]


def _placed(lengths: np.ndarray, capacities: tuple[int, ...], overhead: int, single: bool):
    order = np.argsort(-lengths, kind="stable")
    ahead = _Ahead(lengths)
    bins, offsets, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    rooms: list[tuple[int, int]] = []
    for k in order.tolist():
        need = int(lengths[k])
        if need:
            ahead.take(need)
        at = bisect_left(rooms, (need, -1))
        if at < len(rooms):
            room, where = rooms.pop(at)
        else:
            room = capacities[-1] if single else min(
                (c for c in capacities if c >= need),
                key=lambda c: ((c + overhead) / max(1, need + ahead.fill(c - need)), -c))
            where = len(used)
            used.append(0)
        bins[k], offsets[k] = where, used[where]
        used[where] += need
        insort(rooms, (room - need, where))
    return bins, offsets, _fitted(used, capacities)


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...], overhead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, capacity of the bin) for each length, none of which exceeds the largest capacity.

    Two plans are made: one that opens each bin at the size that costs least a token for what it can be filled with,
    and one that opens the largest size only. The one whose bins, downsized, cost less together is taken.
    """
    plans = [_placed(lengths, capacities, overhead, single) for single in ((False, True) if len(capacities) > 1 else (True,))]
    bins, offsets, sizes = min(plans, key=lambda plan: int((plan[2] + overhead).sum()))
    return bins, offsets, sizes[bins]


def _pack(capacities: tuple[int, ...], overhead: int):
    def of(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.lexsort([table.column(c).to_numpy() for c in ("piece", "row", "order")])
        table = table.take(pa.array(order))
        bins, offsets, capacity = best_fit(table.column("n_tokens").to_numpy(), capacities, overhead)
        shard = pa.array(np.full(len(table), key[0].as_py(), np.int64))
        return pa.table([table.column("id"), table.column("piece"), table.column("start"), table.column("n_tokens"), shard,
                         pa.array(bins), pa.array(offsets), pa.array(capacity)], names=PACKED)
    return of


RUN = 1 << 16
PACKED = ["id", "piece", "start", "n_tokens", "shard", "bin", "bin_offset", "capacity"]


def pack(docs: DataFrame, id_col: str = "doc_id", tokens: Column | None = None,
         capacities: tuple[int, ...] = (512, 1024, 2048, 4096), overhead: int = 8, shard_rows: int = 50_000) -> DataFrame:
    """One row per piece: id, piece (from 0), start (first token), n_tokens, shard, bin, bin_offset, capacity.

    ``tokens`` gives a row's number of tokens (by default the words of ``text``). (shard, bin) names a sequence.
    """
    if not capacities or min(capacities) < 1:
        raise ValueError("capacities must be positive")
    capacities = tuple(sorted(set(capacities)))
    longest = capacities[-1]
    n = tokens if tokens is not None else word_count(F.col("text"))
    rows = settle(docs.select(F.col(id_col).cast("long").alias("id"), n.cast("long").alias("n")), "lengths")
    # A pair of id and length may repeat as often as there are rows, so its rows are numbered in runs of bounded size.
    runs = rows.groupBy("id", "n").count().select(
        "id", "n", "count", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(RUN).cast("long"))).alias("first"))
    pieces = runs.select(
        "id", "n", F.explode(F.sequence("first", F.least(F.col("first") + RUN, F.col("count")) - 1)).alias("row")).select(
        "id", "n", "row", F.explode(F.sequence(
            F.lit(0).cast("long"), F.greatest(F.lit(0), F.expr(f"(n - 1) div {longest}")).cast("long"))).alias("piece"))
    total = rows.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("n") / longest)))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_rows))
    start = F.col("piece") * longest
    dealt = pieces.select(
        "id", "piece", "row", start.alias("start"), F.least(F.lit(longest), F.col("n") - start).cast("long").alias("n_tokens"),
        F.xxhash64("id").alias("order"), F.pmod(F.xxhash64("id", "row", "piece"), F.lit(shards)).alias("shard"))
    schema = "id long, " + ", ".join(f"{name} long" for name in PACKED[1:])
    return dealt.groupBy("shard").applyInArrow(_pack(capacities, overhead), schema)
