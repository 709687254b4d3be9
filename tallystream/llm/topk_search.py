"""Exact top-k search by inner product, with bounds from segment statistics at several resolutions.

A vector is cut into 1, then 4, then 16 segments (``resolutions``). Segment means m and deviations s bound the
squared distance of two vectors from below by the sum over segments of length * ((m - m')^2 + (s - s')^2),
hence the inner product (|q|^2 + |x|^2 - distance) / 2 from above. A query's threshold is the k-th best exact
score among the candidates whose bound is best at the resolution before the finest. Candidates whose bound is below it are dropped at each
resolution, and exact scores are computed for the survivors only.

Queries and candidates are cut into blocks of bounded size, and each task compares one block of either; its k
best per query go on to a ranking per query. Components are turned into whole numbers, floor(scale * x), so
scores are exact. Ties go to the smaller id. A component or a score beyond the range of a long counts as its bound.

Vectors that are null, or hold null or non-finite components, take no part, nor do rows with a null id. A query
meets candidates of its own length only, and never rows of its own id. A repeated query id is one query, with
the least of its vectors; repeated candidates are ranked each. Empty tables give no rows. Other columns are
neither read nor returned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.common import settle
from tallystream.llm.embedding_join import is_number_vector
from tallystream.session import shuffle_tasks

EXACT, QUERIES_AT_ONCE = 1 << 53, 64
#: Numbers in the vectors of one block, or of one set of queries. Every candidate is sent once for each set.
BLOCK_NUMBERS = 1 << 21
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _features(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, each times the root of the segment's length."""
    parts = np.array_split(rows, min(segments, rows.shape[1]), axis=1)
    columns = [f(part, axis=1) * math.sqrt(part.shape[1]) for part in parts for f in (np.mean, np.std)]
    return np.stack(columns, axis=1)


def _integers(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int,
                  resolutions: tuple[int, ...]):
    """For each query (its id, ids, scores) of the k best rows of the block, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    most = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (queries, rows)]
    small = most[0] * most[1] * rows.shape[1] < EXACT
    exact_q, exact_x = (x.astype(np.float64 if small else object) for x in (queries, rows))  # Python integers: no overflow.
    real_q, real_x = queries.astype(np.float64), rows.astype(np.float64)
    half = (real_q ** 2).sum(axis=1) / 2, (real_x ** 2).sum(axis=1) / 2
    features = [(_features(real_q, r), _features(real_x, r)) for r in resolutions]
    squares = [(x * x).sum(axis=1) for _, x in features]
    slack = 1e-9 * (half[0].max(initial=0) + half[1].max(initial=0)) + 1e-6

    def bound(level: int, some: slice | int, at) -> np.ndarray:
        """From above, the scores of some queries (or one) with the rows at these places."""
        mine, theirs = features[level][0][some], features[level][1][at]
        return (half[0][some] - (mine * mine).sum(axis=-1) / 2)[..., None] + (half[1][at] - squares[level][at] / 2) + mine @ theirs.T

    for start in range(0, len(queries), QUERIES_AT_ONCE):
        some = slice(start, min(start + QUERIES_AT_ONCE, len(queries)))
        coarse = [bound(level, some, slice(None)) + slack for level in range(max(1, len(features) - 1))]
        for q in range(some.start, some.stop):
            at = np.flatnonzero(ids != query_ids[q])
            if len(at) > k:
                best = coarse[-1][q - start][at]
                first = at[np.argpartition(-best, k - 1)[:k]]
                least = float((exact_x[first] @ exact_q[q]).min())
                for level in coarse:
                    at = at[level[q - start][at] >= least]
                for level in range(len(coarse), len(features)):
                    at = at[bound(level, q, at) + slack >= least]
            scores = exact_x[at] @ exact_q[q]
            top = np.argsort(-scores, kind="stable")[:k]
            yield query_ids[q], ids[at[top]], scores[top]


def _as_long(scores: np.ndarray) -> np.ndarray:
    """Whole numbers as longs; one beyond the range of a long becomes its bound."""
    return np.clip(scores, LEAST, MOST).astype(np.int64) if scores.dtype == object else scores.astype(np.int64)


def _search(k: int, resolutions: tuple[int, ...]):
    def of(table: pa.Table) -> pa.Table:
        asked = table.column("asked").to_numpy()
        width = table.column("width")[0].as_py()
        id_, rows = table.column("id").to_numpy(), _integers(table.column("v"), width)
        found = list(best_of_block(rows[asked], id_[asked], rows[~asked], id_[~asked], k, resolutions))
        return pa.table({
            "query_id": np.repeat([q for q, _, _ in found], [len(x) for _, x, _ in found]).astype(np.int64),
            "vec_id": np.concatenate([np.empty(0, np.int64), *[x for _, x, _ in found]]),
            "score": np.concatenate([np.empty(0, np.int64), *[_as_long(x) for _, _, x in found]])})
    return of


def top_matches(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64,
                k: int = 20, resolutions: tuple[int, ...] = (1, 4, 16), query_rows: int | None = None,
                block_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query; is_query is a condition on ``vectors``.

    ``query_rows`` and ``block_rows`` are the rows of a set of queries and of a block of candidates; by default as many
    as ``BLOCK_NUMBERS`` allow, and fewer candidates where there would be fewer blocks than the session has tasks.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("raw"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & is_number_vector(F.col("raw"))).select(
        "id", "asked", F.transform("raw", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
    rows = settle(rows.where(F.size("v") > 0).withColumn("width", F.size("v")), "integers")
    queries = rows.where("asked").groupBy("id").agg(F.min("v").alias("v")).withColumn("width", F.size("v"))
    n, asked, widest = rows.agg(F.count("*"), F.count(F.when(F.col("asked"), 1)), F.max("width")).first()
    most = max(512, BLOCK_NUMBERS // (widest or 1))
    blocks = math.ceil(n / (block_rows or most))
    if block_rows is None:
        blocks = max(blocks, min(shuffle_tasks(rows.sparkSession), math.ceil(n / 4096)))
    blocks, sets = max(1, blocks), max(1, math.ceil(asked / (query_rows or most)))

    def spread(df: DataFrame, asked: bool) -> DataFrame:
        own = F.pmod(F.xxhash64("id"), F.lit(sets if asked else blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit((blocks if asked else sets) - 1)))
        names = ("part", "block") if asked else ("block", "part")
        return df.select("id", "v", "width", own.alias(names[0]), every.alias(names[1])).select(
            "id", "v", "width", "block", "part", F.lit(asked).alias("asked"))

    found = spread(rows, False).unionAll(spread(queries, True)).groupBy("width", "block", "part").applyInArrow(
        _search(k, resolutions), "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
