"""Cross-tokenizer alignment: the groups of tokens in which two tokenizers cut the same bytes.

Tokenizer A is a byte-level BPE (a tokenizer file), B a piece model with byte fallback, which puts a space before a
text; A gets that space with the text. Both cut the same bytes into intervals. All tokens are lexsorted by start and
the ends accumulated by maximum; where a start reaches the running maximum, a group of overlapping tokens ends. Each
token of A in a group is linked with each token of B in it. Within a group equal ids are taken together first, and
links are expanded in runs of bounded size.

A link's count is the number of documents in the whole table that link its two ids. Documents are encoded once and
written with their distinct id pairs. The counts of the most frequent pairs, ``head_pairs`` at most, are sent to all
tasks and looked up there; all other pairs are joined with the table of counts. So no key of that join is hot: more
than ``head_pairs`` pairs are at least half as frequent as it can be.

A null or empty text, or one whose tokens do not give back its bytes (say, with U+2581 in it), has no tokens: all its
numbers are zero and its groups empty. Every row is judged by itself: repeated rows and repeated or null ids come out
as they came in, and count as documents of their own. Empty tables give no rows. Texts are encoded whole. Other
columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.common import settle
from tallystream.llm.winnowing import slices

LINKS_AT_ONCE = 1 << 20
#: Texts that only the tokenizer of the file itself encodes: with letters that classes of characters could hold in one
#: version of Unicode and not in another, or with very long pieces.
UNUSUAL = re.compile(r"[^\x00-\u024f]|\S{1000}|\s{1000}")
#: How byte-level BPE cuts a text before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it is seen, else the next from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    unseen = [byte for byte in range(256) if byte not in set(seen)]
    return {chr(byte): byte for byte in seen} | {chr(256 + k): byte for k, byte in enumerate(unseen)}


class Tokenizers:
    """Both tokenizers, with the bytes of each id; made in the task from the contents of their files."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_file)
        letters, model = _byte_letters(), json.loads(a_file)["model"]
        vocabulary = model["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, id_ in vocabulary.items():
            self.a_bytes[id_] = bytes(letters[x] for x in piece) if all(x in letters for x in piece) else piece.encode()
        self.quick = self._by_rank(model)
        self.b_bytes = [
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(id_) else piece.replace("▁", " ").encode()
            for id_, piece in ((k, self.b.id_to_piece(k)) for k in range(self.b.get_piece_size()))]

    def _by_rank(self, model: dict):
        """The same encoding by ranks, several times as fast, if ids rise in the order of the merges; else None."""
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        merged = [model["vocab"].get("".join(x), -1) for x in merges]
        if merged != sorted(set(merged)) or not merged or merged[0] < 0:
            return None
        from tiktoken import Encoding

        ranks = {self.a_bytes[k]: k for k in merged} | {x: k for k, x in enumerate(self.a_bytes) if len(x) == 1}
        return Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == len(
            merged) + 256 else None

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        found = [None if self.quick is None or UNUSUAL.search(x) else self.quick.encode_ordinary(x) for x in texts]
        rest = [k for k, ids in enumerate(found) if ids is None]
        for k, made in zip(rest, self.a.encode_batch([texts[k] for k in rest], add_special_tokens=False)):
            found[k] = made.ids
        return found

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B for each text; none where either does not give back the bytes."""
        asked = [" " + text for text in texts]
        a = self.encode_a(asked)
        b = self.b.encode(texts, num_threads=1)
        for k, text in enumerate(asked):
            raw = text.encode()
            if (not texts[k] or b"".join(map(self.a_bytes.__getitem__, a[k])) != raw
                    or b"".join(map(self.b_bytes.__getitem__, b[k])) != raw):
                a[k] = b[k] = []
        return a, b


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, given their sizes in bytes; both cover the same bytes."""
    ends = np.concatenate([np.cumsum(a_sizes), np.cumsum(b_sizes)])
    starts = ends - np.concatenate([a_sizes, b_sizes])
    side = np.repeat([0, 1], [len(a_sizes), len(b_sizes)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(np.r_[False, starts[order][1:] >= reach[:-1]])[:len(order)]
    return group[:len(a_sizes)], group[len(a_sizes):]


def _counted(major: np.ndarray, minor: np.ndarray, minors: int, weights: np.ndarray | None = None):
    """Distinct (major, minor), sorted, and the sum of their weights; minor is below ``minors``."""
    keys = major * minors + minor
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    if weights is None:
        total = np.diff(np.r_[at, len(keys)])
    else:
        total = np.add.reduceat(weights[order], at) if len(at) else weights
    return *np.divmod(keys[at], minors), total


def linked_pairs(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, text_of: np.ndarray,
                 a_ids: int, b_ids: int):
    """Texts, id pairs (A's id in the upper half) and how many links each has; text_of names each group's text."""
    ga, ia, na = _counted(a_group, a, a_ids)
    gb, ib, nb = _counted(b_group, b, b_ids)
    first = np.searchsorted(gb, ga)
    size = np.searchsorted(gb, ga, "right") - first
    cuts, parts, k = np.cumsum(size), [], 0
    while k < len(ga):
        end = max(k + 1, int(np.searchsorted(cuts, (cuts[k - 1] if k else 0) + LINKS_AT_ONCE, "right")))
        left = np.repeat(np.arange(k, end), size[k:end])
        nth = np.arange(len(left)) - np.repeat(np.cumsum(size[k:end]) - size[k:end], size[k:end])
        right = first[left] + nth
        parts.append(_counted(text_of[ga[left]], ia[left] * b_ids + ib[right], a_ids * b_ids, na[left] * nb[right]))
        k = end
    if not parts:
        return (np.empty(0, np.int64),) * 3
    text, pair, links = parts[0]
    if len(parts) > 1:
        text, pair, links = (np.concatenate(x) for x in zip(*parts))
        text, pair, links = _counted(text, pair, a_ids * b_ids, links)
    return text, pair // b_ids << 32 | pair % b_ids, links


class Groups:
    """Writes groups as text: ids of A, then ids of B, in order."""

    def __init__(self, a_ids: int, b_ids: int):
        self.a_ids, self.b_ids = a_ids, b_ids
        self.pieces = [f"{mark}{k}" for n, marks in ((a_ids, ";,"), (b_ids, "|,")) for mark in marks for k in range(n)]

    def write(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, tokens: np.ndarray) -> list[str]:
        """One text for each of the runs of tokens (A and B together)."""
        group = np.concatenate([a_group, b_group])
        order = np.argsort(group, kind="stable")
        inner = np.ones(len(group), bool)
        inner[:len(a)] = np.r_[False, a_group[1:] == a_group[:-1]][:len(a)]
        inner[len(a):] = np.r_[False, b_group[1:] == b_group[:-1]][:len(b)]
        piece = np.concatenate([a + inner[:len(a)] * self.a_ids, b + 2 * self.a_ids + inner[len(a):] * self.b_ids])
        all_ = list(map(self.pieces.__getitem__, piece[order].tolist()))
        ends = np.cumsum(tokens).tolist()
        return ["".join(all_[i:j])[1:] for i, j in zip([0, *ends], ends)]


def _encoded(a_file: bytes, b_file: bytes, with_groups: bool):
    def of(batches):
        both = Tokenizers(a_file, b_file)
        a_size, b_size = (np.array([len(x) for x in table]) for table in (both.a_bytes, both.b_bytes))
        groups = Groups(len(a_size), len(b_size))
        for batch in batches:
            for rows, texts in slices(batch, 1):
                yield one(rows, texts, both, a_size, b_size, groups)

    def one(rows, texts, both, a_size, b_size, groups):
        a_ids, b_ids = both.encode(texts.cast(pa.large_string()).to_pylist())
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = (np.array(list(chain.from_iterable(ids)), np.int64) for ids in (a_ids, b_ids))
        a_group, b_group = coalesce(a_size[a], b_size[b])
        text = np.repeat(np.arange(len(rows)), n_a)
        first = np.flatnonzero(np.r_[True, a_group[1:] != a_group[:-1]][:len(a)])
        text_of = text[first]
        many = np.bincount(a_group) * np.bincount(b_group) if len(a) else np.empty(0, np.int64)
        n_links = np.zeros(len(rows), np.int64)
        np.add.at(n_links, text_of, many)
        at, pair, links = linked_pairs(a, b, a_group, b_group, text_of, len(a_size), len(b_size))
        offsets = pa.array(np.r_[0, np.cumsum(np.bincount(at, minlength=len(rows)))].astype(np.int32))
        told = groups.write(a, b, a_group, b_group, n_a + n_b)
        digest = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in told]
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(n_a), pa.array(n_b), pa.array(np.bincount(text_of, minlength=len(rows))), pa.array(n_links),
             pa.array(digest, pa.string()), pa.array(told if with_groups else [None] * len(told), pa.string()),
             pa.ListArray.from_arrays(offsets, pa.array(pair)), pa.ListArray.from_arrays(offsets, pa.array(links))],
            ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "pairs", "links"])
    return of


def _looked_up(pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """Sums over the links whose pair is in the sorted head; the others are handed on."""
    def of(batches):
        for batch in batches:
            if batch.num_rows:
                yield one(batch)

    def one(batch):
        at, links = batch.column(1), batch.column(2)
        ends = np.r_[0, np.cumsum(pc.list_value_length(at).to_numpy(zero_copy_only=False))].astype(np.int64)
        pair, many = at.flatten().to_numpy(), links.flatten().to_numpy()
        place = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
        known = pairs[place] == pair if len(pairs) else np.zeros(len(pair), bool)

        def sums(values):
            total = np.r_[0, np.cumsum(values)]
            return total[ends[1:]] - total[ends[:-1]]

        row = np.where(known, 0, 1)
        rest = pa.array(np.r_[0, np.cumsum(row)][ends].astype(np.int32))
        in_head = np.where(known, place, 0)
        n = counts[in_head] * known if len(pairs) else np.zeros(len(pair), np.int64)
        top = best[in_head] & known if len(pairs) else known
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sums(many * top)), pa.array(sums(many * n)),
             pa.ListArray.from_arrays(rest, pa.array(pair[~known])), pa.ListArray.from_arrays(rest, pa.array(many[~known]))],
            ["row", "n_best", "count_sum", "pairs", "links"])
    return of


def _head(counts: DataFrame, head_pairs: int) -> pa.Table:
    """The pairs from the least power of two on at which there are no more than head_pairs."""
    level = F.floor(F.log2("n") + 1e-9).cast("int")
    sizes = sorted(((r["level"], r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, total = None, 0
    for at, n in sizes:
        total += n
        if total > head_pairs:
            break
        least = at
    wanted = F.lit(False) if least is None else level >= least
    return counts.where(wanted).select("pair", "n", "best").orderBy("pair").toArrow()


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, n, best): documents that link a pair, and whether none of its A id's pairs has more."""
    counts = pairs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.withColumn("best", F.col("n") == most)


def align(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text",
          with_groups: bool = True, head_pairs: int = 1 << 18) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups, groups_sha256) for each document.

    groups is like ``a1,a2|b1;a3|b2,b3``; without ``with_groups`` it is null and only its digest is written.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    encoded = rows.mapInArrow(
        _encoded(read_file(a_file), read_file(b_file), with_groups),
        f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
        "pairs array<long>, links array<long>")
    encoded = settle(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded")
    counts = settle(pair_counts(encoded), "counts")
    head = _head(counts, head_pairs)
    known = [head.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in range(3)]
    told = settle(encoded.select("row", "pairs", "links").mapInArrow(
        _looked_up(known[0].astype(np.int64), known[1].astype(np.int64), known[2].astype(bool)),
        "row long, n_best long, count_sum long, pairs array<long>, links array<long>"), "told")
    others = told.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select(
        "row", "p.pairs", "p.links").join(counts, F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        F.sum(F.col("links") * F.col("n")).alias("more_sum"))
    sums = told.select("row", "n_best", "count_sum").join(others, "row", "left")
    return encoded.drop("pairs", "links").join(sums, "row").select(
        "id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups", "groups_sha256")
