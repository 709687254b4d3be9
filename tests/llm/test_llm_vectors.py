"""Near vectors and top matches against plain versions, with split cells, hot copies and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystream.llm import embedding_join
from tallystream.llm.embedding_join import near_vectors
from tallystream.llm.topk_search import top_matches
from test_llm_queries import plain_components

ODD = [(900, None), (901, [0.0] * 8), (902, [float("nan")] + [1.0] * 7), (903, [None] + [1.0] * 7),
       (904, [float("inf")] + [1.0] * 7), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (907, []), (None, [1.0] * 8)]


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 8))
    rows = [base[k % 40] + rng.normal(size=8) * 0.12 for k in range(200)] + [base[0]] * 60
    return [(k, [float(x) for x in np.float32(row)]) for k, row in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, id int, v string, copies int").repartition(3)


@pytest.mark.parametrize("sizes", [(None, None, None), (16, 24, 6), (50, 1000, 1), (8, 24, None)])
def test_near_vectors(spark, monkeypatch, sizes):
    home, member, pivots = sizes
    monkeypatch.setattr(embedding_join, "ANGLES_AT_ONCE", 40)
    rows = vectors()
    got = {r["id"]: r for r in near_vectors(frame(spark, rows + ODD), cosine=0.95, home_rows=home, member_rows=member,
                                            most_pivots=pivots).collect()}
    x = np.array([v for _, v in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    roots = plain_components([i for i, _ in rows], np.argwhere(near).tolist())
    for k, (i, _) in enumerate(rows):
        assert (got[i]["n_links"], got[i]["component"]) == (near[k].sum() - 1, roots[k])
    assert (got[905]["n_links"], got[906]["component"]) == (1, 905)
    for i in (900, 901, 902, 903, 904, 907):
        assert (got[i]["n_links"], got[i]["component"]) == (0, i)
    assert got[None]["n_links"] == 0 and got[None]["component"] is None
    assert len(got) == len(rows) + len(ODD)


def test_no_vectors(spark):
    assert near_vectors(frame(spark, [])).count() == 0
    assert near_vectors(frame(spark, [(1, None)])).collect()[0][:] == (1, 0, 1)
    assert top_matches(frame(spark, []), F.lit(True)).count() == 0
    assert top_matches(frame(spark, [(1, [1.0])]), F.lit(True)).count() == 0


@pytest.mark.parametrize("blocks", [(None, None), (5, 37)])
def test_top_matches(spark, blocks):
    rows = vectors()
    found = top_matches(frame(spark, rows + ODD), F.col("vec_id") % 20 == 0, query_rows=blocks[0], block_rows=blocks[1], k=7)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    usable = rows + [(901, [0.0] * 8)]
    ints = {i: np.floor(64 * np.array(v, dtype=np.float64)).astype(int) for i, v in usable}
    assert set(got) == {i for i in ints if i % 20 == 0}
    for q in got:
        want = sorted(((int(ints[q] @ ints[i]), i) for i in ints if i != q), key=lambda s: (-s[0], s[1]))[:7]
        assert [got[q][k + 1] for k in range(7)] == [(i, s) for s, i in want]


def test_top_matches_of_huge_components(spark):
    rows = [(0, [1e12, 1.0]), (1, [3.0, 1.0]), (2, [3.0, 2.0])]
    got = top_matches(frame(spark, rows), F.col("vec_id") == 0, scale=1).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 3 * int(np.float32(1e12)) + 2), (1, 3 * int(np.float32(1e12)) + 1)]


def test_vectors_of_repeated_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (3, [0.01, 1.0]), (4, [-1.0, 0.0])]
    got = sorted((r["id"], r["n_links"], r["component"]) for r in near_vectors(frame(spark, rows)).collect())
    assert got == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (3, 2, 1), (4, 0, 4)]
    apart = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 0.01]), (4, [0.01, 1.0])]
    got = sorted((r["id"], r["n_links"], r["component"]) for r in near_vectors(frame(spark, apart)).collect())
    assert got == [(4, 1, 4), (5, 1, 4), (5, 1, 5), (6, 1, 5)]


def test_top_matches_of_repeated_ids_and_extremes(spark):
    rows = [(0, [2.0, 1.0]), (0, [1.0, 5.0]), (1, [3.0, 1.0]), (1, [4.0, 0.0]), (2, [1e30, 1e30]), (3, [-1e30, 1.0]), (4, [1e17, 0.0])]
    got = top_matches(frame(spark, rows), F.col("vec_id") == 0, scale=1, k=9).orderBy("rank").collect()
    most = (1 << 63) - 1
    # The least vector of the repeated query id asks, and its own rows are no candidates.
    assert [(r["vec_id"], r["score"]) for r in got][:1] == [(2, most)] and len(got) == 5
    assert [(r["vec_id"], r["score"]) for r in got][2:4] == [(1, 8), (1, 4)] or [r["vec_id"] for r in got][2:4] == [1, 1]
    assert got[-1]["vec_id"] == 3 and got[-1]["score"] < -most // 2
