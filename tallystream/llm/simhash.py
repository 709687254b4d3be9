"""SimHash near-dedup over a hierarchical index in Gray order.

A fingerprint has 64 bits; two texts link if theirs differ in at most ``max_bits`` bits. Equal fingerprints
are put together first. Bits are cut into ``max_bits + 1`` runs: two linked fingerprints agree wholly in one
of them at least. The upper nodes of the index are the masked bit patterns that fingerprints share: one run at
first; where a node is large, its free bits are cut into ``max_bits + 1`` runs again, and it is replaced by the
nodes below it (its pattern and one more run), up to ``levels`` deep, if these send fewer rows to tasks. Below the upper
nodes fingerprints are sorted by Gray rank, so that neighbours share most of their bits, and every run of
neighbours becomes a node that holds the bits its members share. Pairs of nodes are followed from the top; a pair
whose shared bits already differ in more than ``max_bits`` places is dropped with all below it.

An upper node that still has many fingerprints is split into parts of ``part_rows``, and pairs of parts go to
separate tasks. Tasks return a spanning set of the links they find, never all pairs.

Nulls: a null text counts as empty, hence as fingerprint zero; a null id keeps its row and takes the smallest
id of its group, if any has one. Repeated rows come out as often as they came in. Empty tables give no rows.
Other columns are neither read nor returned.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tallystream.llm.common import components, merge_labels, settle

SEED, FAN, HASHES_AT_ONCE, PAIRS_AT_ONCE, ROWS_AT_ONCE = 42, 8, 1 << 16, 1 << 20, 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends][: max(1, len(words) - shingle + 1)]
    ends = ends[min(shingle, len(words)) - 1:]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(starts), HASHES_AT_ONCE):
        hashes = np.array(
            [digest(joined[i:j - 1], SEED)
             for i, j in zip(starts[k:k + HASHES_AT_ONCE], ends[k:k + HASHES_AT_ONCE])], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, mark: Column | None = None) -> DataFrame:
    """(id, fp, mark) for each row; the mark is a long that the caller wants to find the row by."""
    def of(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([fingerprint(x.as_py() or b"", shingle) for x in texts], pa.int64()), batch.column(2)],
                ["id", "fp", "mark"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       (F.lit(0).cast("long") if mark is None else mark).alias("mark"))
    return rows.mapInArrow(of, "id long, fp long, mark long")


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit code in the Gray sequence."""
    for bits in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, bits))
    return code


def index_pairs(codes: np.ndarray, groups: np.ndarray, max_bits: int):
    """Positions (i, j) of codes of one group that differ in at most max_bits bits; rows by group and Gray rank."""
    same, varying, below, group = codes, np.zeros_like(codes), [], groups
    levels = [(same, varying)]
    while len(group) > len(np.unique(group)):
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
        start = np.flatnonzero(place % FAN == 0)
        ones = np.bitwise_or.reduceat(same | varying, start)
        same = np.bitwise_and.reduceat(same & ~varying, start)
        varying = same ^ ones
        below.append((start, np.r_[start[1:], len(group)]))
        group = group[start]
        levels.append((same, varying))
    top = np.arange(len(group))
    todo = [(len(levels) - 1, top, top)]
    while todo:
        level, u, v = todo.pop()
        if level == 0:
            other = u != v
            yield u[other], v[other]
            continue
        start, end = below[level - 1]
        wide = end[v] - start[v]
        size = (end[u] - start[u]) * wide
        if size.sum() > PAIRS_AT_ONCE and len(u) > 1:
            half = len(u) // 2
            todo += [(level, u[:half], v[:half]), (level, u[half:], v[half:])]
            continue
        pair = np.repeat(np.arange(len(u)), size)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        low, high = start[u][pair] + nth // wide[pair], start[v][pair] + nth % wide[pair]
        same, varying = levels[level - 1]
        near = np.bitwise_count((same[low] ^ same[high]) & ~(varying[low] | varying[high])) <= max_bits
        near &= (u[pair] != v[pair]) | (low <= high)
        todo.append((level - 1, low[near], high[near]))


def _links_of_sorted(max_bits: int):
    """Spanning links of a partition that is sorted by node and Gray rank; whole nodes are taken up together."""
    def of(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS_AT_ONCE:
                table = pa.Table.from_batches(held).combine_chunks()
                node = table.column(0).to_numpy()
                cut = int(np.searchsorted(node, node[-1]))
                if cut:
                    yield from links(table.slice(0, cut))
                held, rows = table.slice(cut).to_batches(), table.num_rows - cut
        if rows:
            yield from links(pa.Table.from_batches(held))

    def links(table):
        node, code = (table.column(k).to_numpy() for k in range(2))
        groups = np.cumsum(np.r_[0, node[1:] != node[:-1]])
        labels = np.arange(len(code))
        for i, j in index_pairs(code.view(np.uint64), groups, max_bits):
            labels = merge_labels(labels, i, j)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        yield pa.RecordBatch.from_arrays([pa.array(code[linked]), pa.array(code[labels[linked]])], ["a", "b"])

    return of


def masks_below(mask: int, runs: int) -> list[int]:
    """The mask with one more run of bits each: its free bits, from the highest on, are cut into this many runs."""
    free = [bit for bit in range(63, -1, -1) if not mask >> bit & 1]
    cuts = [len(free) * k // runs for k in range(runs + 1)]
    return [mask | sum(1 << bit for bit in free[i:j]) for i, j in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _rows_sent(n: Column, part_rows: int) -> Column:
    """How many rows go to tasks for a node of n rows: each of them once for every part of the node."""
    return n * F.ceil(n / part_rows)


def upper_nodes(codes: DataFrame, max_bits: int, part_rows: int, levels: int) -> DataFrame:
    """(code, mask, parts): the upper nodes (mask, code & mask) that each code is in, and their numbers of parts.

    Two codes that link share one upper node at least. A node of more than ``part_rows`` codes for each run of
    its free bits is replaced by the nodes below it where these send fewer rows to tasks, as counted.
    """
    spark, runs = codes.sparkSession, max_bits + 1
    pattern = F.col("code").bitwiseAND(F.col("mask")).alias("pattern")
    masks = masks_below(0, runs)
    rows = codes.select("code", F.explode(F.lit([_signed(m) for m in masks])).alias("mask"))
    sizes = settle(rows.groupBy("mask", pattern).agg(F.count("*").alias("n")).where(F.col("n") > part_rows), "nodes")
    closed = []
    for _ in range(1, levels):
        wide = sizes.where(F.col("n") > part_rows * runs)
        if wide.limit(1).count() == 0:
            break
        steps = {m: masks_below(m, runs) for m in masks}
        masks = sorted({below for found in steps.values() for below in found})
        # As many rows as there are masks of this level, whatever the codes.
        table = F.broadcast(spark.createDataFrame(
            [(_signed(m), _signed(below)) for m, found in steps.items() for below in found], "mask long, below long"))
        placed = rows.select("code", "mask", pattern)
        under = F.col("code").bitwiseAND(F.col("below")).alias("under")
        finer = settle(placed.join(wide, ["mask", "pattern"]).join(table, "mask").groupBy(
            "mask", "pattern", "n", "below", under).agg(F.count("*").alias("m")), "nodes")
        better = settle(finer.groupBy("mask", "pattern", "n").agg(F.sum(_rows_sent(F.col("m"), part_rows)).alias("sent")).where(
            F.col("sent") < _rows_sent(F.col("n"), part_rows)).select("mask", "pattern"), "nodes")
        closed.append(_with_parts(placed.join(better, ["mask", "pattern"], "left_anti"), sizes, part_rows))
        rows = settle(placed.join(better, ["mask", "pattern"], "left_semi").join(table, "mask").select(
            "code", F.col("below").alias("mask")), "rows")
        sizes = settle(finer.where(F.col("m") > part_rows).join(better, ["mask", "pattern"], "left_semi").groupBy(
            F.col("below").alias("mask"), F.col("under").alias("pattern")).agg(F.max("m").alias("n")), "nodes")
    out = _with_parts(rows.select("code", "mask", pattern), sizes, part_rows)
    for more in closed:
        out = out.unionAll(more)
    return out


def _with_parts(placed: DataFrame, sizes: DataFrame, part_rows: int) -> DataFrame:
    parts = F.coalesce(F.ceil(F.col("n") / part_rows).cast("int"), F.lit(1))
    return placed.join(sizes, ["mask", "pattern"], "left").select("code", "mask", parts.alias("parts"))


def fingerprint_links(codes: DataFrame, max_bits: int, part_rows: int = 4096, levels: int = 3) -> DataFrame:
    """Spanning links (a, b) among distinct codes (code); a and b are codes."""
    if not 0 <= max_bits < 63:
        raise ValueError("max_bits must be between 0 and 62")
    part = F.pmod(F.xxhash64("code"), F.col("parts")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda k: F.struct(F.least(k, F.col("part")).alias("i"), F.greatest(k, F.col("part")).alias("j")))
    nodes = upper_nodes(codes, max_bits, part_rows, levels).withColumn("part", part)
    tasks = nodes.select("code", "mask", F.explode(meets).alias("m")).select(
        F.xxhash64("mask", F.col("code").bitwiseAND(F.col("mask")), "m.i", "m.j").alias("node"), "code",
        gray_rank(F.col("code")).alias("rank"))
    placed = tasks.repartition("node").sortWithinPartitions("node", "rank").select("node", "code")
    return placed.mapInArrow(_links_of_sorted(max_bits), "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """(id, fp, root, component, code_rows) for each row; root names its group."""
    prints = settle(fingerprints(docs, id_col, text_col, shingle).select("id", "fp"), "prints")
    codes = settle(prints.groupBy(F.col("fp").alias("code")).agg(
        F.min("id").alias("least"), F.count("*").alias("code_rows")), "codes")
    roots = components(fingerprint_links(codes.select("code"), max_bits))
    placed = codes.join(roots.select(F.col("id").alias("code"), "root"), "code", "left").withColumn(
        "root", F.coalesce("root", "code"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = placed.join(smallest, "root").select(F.col("code").alias("fp"), "root", "component", "code_rows")
    return prints.join(named, "fp").select("id", "fp", "root", "component", "code_rows")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                   max_bits: int = 4) -> DataFrame:
    """(id, fp, component, code_rows) for each row: code_rows rows share its fingerprint."""
    return _grouped(docs, id_col, text_col, shingle, max_bits).select("id", "fp", "component", "code_rows")


def _holds_map(kind: DataType) -> bool:
    inner = [f.dataType for f in kind.fields] if isinstance(kind, StructType) else (
        [kind.elementType] if isinstance(kind, ArrayType) else [])
    return isinstance(kind, MapType) or any(map(_holds_map, inner))


def row_mark(rows: DataFrame) -> Column:
    """A hash over all columns of a row; maps, which have none, are hashed as text."""
    columns = [rows["`" + f.name.replace("`", "``") + "`"] for f in rows.schema]
    return F.xxhash64(*(c.cast("string") if _holds_map(f.dataType) else c for c, f in zip(columns, rows.schema)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
             max_bits: int = 4) -> DataFrame:
    """The documents with one row of each group: that of the smallest id; all its columns are kept.

    Of a group's rows that repeat this id, the one of the least hash over all columns stays, and one of rows that are
    equal in all columns; rows of an id with texts of several groups are judged in each. Rows without an id all stay,
    as nothing tells them apart; they take no part in the groups.

    Each text is fingerprinted once. What stays is decided on ids, fingerprints and row hashes; the documents then go
    through one semi-join with the rows that stay, of the same kind at every size.
    """
    known = docs.where(F.col(id_col).isNotNull())
    prints = settle(fingerprints(known, id_col, text_col, shingle, row_mark(known)), "prints")
    rows = prints.groupBy("fp", "id", "mark").agg(F.count("*").alias("copies"))
    codes = settle(rows.groupBy(F.col("fp").alias("code")).agg(F.min(F.struct("id", "mark", "copies")).alias("least")), "codes")
    roots = components(fingerprint_links(codes.select("code"), max_bits)).withColumnRenamed("id", "code")
    heads = codes.join(roots, "code", "left").groupBy(F.coalesce("root", "code").alias("root")).agg(F.min("least").alias("least"))
    chosen = settle(heads.select("least.*"), "chosen")

    def found(some: DataFrame) -> DataFrame:
        return known.join(some.hint("shuffle_hash"), (known[id_col].cast("long") == some["id"]) & (row_mark(known) == some["mark"]),
                          "left_semi")

    stay = found(chosen.where("copies = 1"))
    several = chosen.where("copies > 1")
    if several.limit(1).count():
        again = found(several)
        stay = stay.unionByName(again.groupBy(again[id_col].alias("id"), row_mark(again).alias("mark")).agg(
            F.any_value(F.struct(*again.columns)).alias("row")).select("row.*"))
    return stay.unionByName(docs.where(F.col(id_col).isNull()))
