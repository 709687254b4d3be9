"""Embedding near-dedup: an exact range join in the metric space of angles.

Two vectors link if their cosine is at least ``cosine``, that is, if their angle is at most r. Pivots cut the
vectors into cells: a vector's home is the cell of its nearest pivot. By the triangle inequality a vector can
have a partner at home in cell i only if its angle to pivot i is at most that cell's radius plus r, and at most
its angle to its own pivot plus 2 r; it is copied to the cells where both hold. Each cell is then joined by
itself, in blocks: its home vectors are split into parts and so are the vectors copied to it, as many in a part as fit
a task well, and every task compares one part of each. Two vectors of different cells are compared in
the lower of the two only and counted for both, so copies go to lower cells alone. Tasks return counts per vector
and a spanning set of links, never pairs.

Equal vectors are put together first and compared once. The number of pivots grows with the rows: one for each part's
worth of rows, and no more than the root of their number, beyond which cells are split into parts. Where pivots exclude
nothing, each vector is sent once for every part of the others; large parts keep that low.

Vectors that are null or zero, or hold null or non-finite components, link with nothing; so do vectors of
different length, and rows with a null id. Repeated rows are compared like any others. Rows that repeat an id with
different vectors each have the links of their own vector, and their groups are not put together by the id. Empty
tables give no rows. Other columns are neither read nor returned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.common import components, merge_labels, settle

#: Added to the bounds of the triangle inequality, far above the rounding of an angle in double precision.
SLACK = 1e-6
#: Angles between rows and pivots that a task holds at once, and numbers in the vectors of one part.
ANGLES_AT_ONCE, PART_NUMBERS = 1 << 22, 1 << 20


def is_number_vector(vector: Column) -> Column:
    """Whether an array is there and all its components are finite numbers."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows of length one, in double precision."""
    rows = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, width)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivots.T, -1.0, 1.0))


def _bounded(batches, pivots: np.ndarray):
    """The batches in slices whose angles to all pivots are few enough to be held."""
    most = max(1, ANGLES_AT_ONCE // len(pivots))
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def _homes(pivots: np.ndarray):
    def of(batches):
        for batch in _bounded(batches, pivots):
            if batch.num_rows:
                angles = _angles(unit_rows(batch.column("v"), pivots.shape[1]), pivots)
                home = angles.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(home.astype(np.int32)), pa.array(angles[np.arange(len(home)), home])],
                    ["id", "copies", "v", "home", "angle"])
    return of


def _cells(pivots: np.ndarray, radius: np.ndarray, reach: float):
    def of(batches):
        for batch in _bounded(batches, pivots):
            if batch.num_rows:
                angles = _angles(unit_rows(batch.column("v"), pivots.shape[1]), pivots)
                own = batch.column("angle").to_numpy()[:, None]
                inside = (angles <= radius + reach + SLACK) & (angles <= own + 2 * reach + SLACK)
                inside &= np.arange(len(pivots)) <= batch.column("home").to_numpy()[:, None]
                cells = pa.ListArray.from_arrays(
                    np.r_[0, np.cumsum(inside.sum(axis=1))].astype(np.int32), np.nonzero(inside)[1].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in ("id", "copies", "v", "home")), cells],
                    ["id", "copies", "v", "home", "cells"])
    return of


def _compare(width: int, cosine: float, at_once: int):
    """One part of a cell's home vectors against one part of its members."""
    def of(table: pa.Table) -> pa.Table:
        at_home, foreign = table.column("at_home").to_numpy(), table.column("foreign").to_numpy()
        id_, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        rows = unit_rows(table.column("v").combine_chunks(), width)
        own, other = np.flatnonzero(at_home), np.flatnonzero(~at_home)
        labels, linked = np.arange(len(id_)), np.zeros(len(id_), np.int64)
        for k in range(0, len(own), at_once):
            mine = own[k:k + at_once]
            a, b = np.nonzero(rows[mine] @ rows[other].T >= cosine)
            linked[mine] += np.bincount(a, weights=copies[other[b]], minlength=len(mine)).astype(np.int64)
            # A copy from the cell itself is counted where it is at home.
            linked[other] += np.bincount(b, weights=copies[mine[a]], minlength=len(other)).astype(np.int64) * foreign[other]
            labels = merge_labels(labels, mine[a], other[b])
        told = np.flatnonzero(at_home | (linked > 0) | (labels != np.arange(len(labels))))
        return pa.table({"a": id_[told], "b": id_[labels[told]], "linked": linked[told]})
    return of


def _join_of_width(copies: DataFrame, width: int, n: int, cosine: float, home_rows: int | None, member_rows: int | None,
                   most_pivots: int | None) -> DataFrame:
    reach, part_rows = math.acos(cosine), max(512, PART_NUMBERS // width)
    home_rows, member_rows = home_rows or part_rows, member_rows or part_rows
    count = max(1, min(most_pivots or math.ceil(math.sqrt(n)), math.ceil(n / home_rows)))
    drawn = copies.orderBy(F.xxhash64("id")).limit(count).select("v").toArrow()
    pivots = unit_rows(drawn.column("v").combine_chunks(), width)
    kind = copies.schema["v"].dataType.simpleString()
    homes = settle(copies.mapInArrow(_homes(pivots), f"id long, copies long, v {kind}, home int, angle double"), "homes")
    radius, own = np.full(count, -np.inf), np.zeros(count, int)
    for row in homes.groupBy("home").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect():
        radius[row["home"]], own[row["home"]] = row["radius"], row["n"]
    cells = settle(
        homes.mapInArrow(_cells(pivots, radius, reach), f"id long, copies long, v {kind}, home int, cells array<int>"), "cells")
    member = np.zeros(count, int)
    for row in cells.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect():
        member[row["cell"]] = row["count"]
    home_parts = F.lit(np.maximum(1, -(-own // home_rows)).tolist())
    member_parts = F.lit(np.maximum(1, -(-member // member_rows)).tolist())

    def part(parts: Column, cell: Column) -> Column:
        return F.pmod(F.xxhash64("id"), F.get(parts, cell)).cast("int")

    at_home = cells.select(
        "id", "copies", "v", F.lit(True).alias("at_home"), F.lit(False).alias("foreign"), F.col("home").alias("cell"), part(home_parts, F.col("home")).alias("i"),
        F.explode(F.sequence(F.lit(0), F.get(member_parts, F.col("home")).cast("int") - 1)).alias("j"))
    members = cells.select("id", "copies", "v", "home", F.explode("cells").alias("cell")).select(
        "id", "copies", "v", F.lit(False).alias("at_home"), (F.col("home") != F.col("cell")).alias("foreign"), "cell",
        F.explode(F.sequence(F.lit(0), F.get(home_parts, F.col("cell")).cast("int") - 1)).alias("i"),
        part(member_parts, F.col("cell")).alias("j"))
    return at_home.unionAll(members).groupBy("cell", "i", "j").applyInArrow(
        _compare(width, cosine, max(1, (1 << 23) // member_rows)), "a long, b long, linked long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.95,
                 home_rows: int | None = None, member_rows: int | None = None, most_pivots: int | None = None) -> DataFrame:
    """(id, n_links, component) for each row: links to other rows, and the smallest id reachable by links.

    ``home_rows`` and ``member_rows`` are the rows of a part; by default as many as ``PART_NUMBERS`` allow.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    usable = F.col("id").isNotNull() & is_number_vector(F.col("v")) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    known = rows.where(usable)
    # A vector is known by a number of its own, since rows of one id can hold different vectors.
    copies = settle(known.groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("copies")).select(
        F.monotonically_increasing_id().alias("id"), "least", "copies", "v"), "vectors")
    widths = copies.groupBy(F.size("v").alias("width")).count().collect()
    found = [
        _join_of_width(copies.where(F.size("v") == w["width"]).drop("least"), w["width"], w["count"], cosine, home_rows, member_rows,
                       most_pivots) for w in widths]
    if not found:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    told = found[0]
    for more in found[1:]:
        told = told.unionAll(more)
    told = settle(told, "told")
    roots = components(told.select("a", "b"))
    links = told.groupBy(F.col("a").alias("id")).agg(F.sum("linked").alias("linked"))
    placed = copies.select("id", "least").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    components_ = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = copies.join(links, "id").join(placed.select("id", "root"), "id").join(components_, "root").select(
        "v", (F.col("linked") - 1).alias("n_links"), "component")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return known.join(named, "v").select("id", "n_links", "component").unionAll(alone)
