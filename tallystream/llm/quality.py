"""Quality classifier by co-training of two views.

The content view sees numbers measured on the text; the metadata view sees hashed categories of the other
columns and the size class. Each is a logistic regression. Both start from labelled rows. In each round each
view labels the rows of an unlabelled pool that it is sure of, at most the share ``per_round`` of the pool in the
proportion of the classes, and hands them to the other view's training rows. A view that is sure of nothing hands over
nothing.
At last each view is calibrated on held-out labelled rows (Platt), a third regression weighs the two calibrated
views there, and the combination scores every document.

The labelled rows are a bounded sample chosen by hash (``labelled_rows``). The pool covers all categories that the
metadata columns have, however rare: their combinations are hashed to ``STRATA`` strata, which are counted over all
rows, and each stratum gives all its rows or about ``pool_each`` of them by hash. Only these rows' numbers reach the driver. Of rows that
repeat an id the least by label and numbers is learnt from. All documents are scored, in one map without a shuffle.

A null or empty text has all measures 0. Null categories are a category of their own. Labels other than 0 and 1
are left out, as are documents with contradicting labels. Without labels of both classes nothing can be learnt:
every score is 0.5 and everything is kept. Repeated rows are scored each; empty tables give no rows. All columns
of the documents stay; ``judge`` adds its own under the given prefix, in place of any that have these names already.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CATEGORIES, SIZES = 256, 32
#: Classes of combinations of metadata that the unlabelled pool is drawn from, each by itself.
STRATA = 256
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_UPPER, _DIGITS = bytes(range(65, 91)), b"0123456789"
_MARKS = bytes(b for b in range(33, 127) if bytes([b]) not in b".,;:'\"()-!?" and not bytes([b]).isalnum())
_ENDS = b".,;:'\"()-!?"
MEASURES = 16


def measures(text: str | None) -> list[float]:
    """Numbers that describe a text's content, each between 0 and a few units."""
    data = text.encode() if text else b""
    words = data.split()
    if not words:
        return [0.0] * MEASURES
    size, n = len(data), len(words)
    without = lambda some: (size - len(data.translate(None, some))) / size
    counts = Counter(words)
    lines = [line for line in data.split(b"\n") if line]
    ended = sum(word[-1] in _MARKS for word in words)
    lengths = [len(word) for word in words]
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    return [
        1.0, without(_LETTERS), without(_UPPER), without(_DIGITS), 10 * without(_MARKS), 10 * without(_ENDS),
        10 * without(b"|"), 10 * without(b"!"), len(counts) / n, max(counts.values()) / n, repeated / n,
        ended / n, sum(lengths) / n / 10, np.log1p(n) / 10, len(set(lines)) / max(1, len(lines)),
        sum(word.isupper() for word in words) / n]


def metadata(columns: list[Column], size: Column) -> Column:
    """Positions of the metadata view's categories that a row has."""
    found = [F.pmod(F.xxhash64(c.cast("string"), F.lit(k)), F.lit(CATEGORIES)).cast("int") + k * CATEGORIES
             for k, c in enumerate(columns)]
    log = F.least(F.lit(SIZES - 1), F.floor(2 * F.log2(1 + F.greatest(F.coalesce(size.cast("double"), F.lit(0.0)), F.lit(0.0)))).cast("int"))
    return F.array(*found, log + len(columns) * CATEGORIES)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a ridge-regularised logistic regression, by Newton steps."""
    w, eye = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + eye, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def one_hot(places: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(places), width + 1))
    out[:, width] = 1.0
    if places:
        out[np.arange(len(places))[:, None], np.array(places)] = 1.0
    return out


@dataclass
class Model:
    content: np.ndarray
    metadata: np.ndarray
    #: Slope and offset of each view, then the weights of the two calibrated views and the offset.
    calibration: np.ndarray
    weights: np.ndarray

    def score(self, content: np.ndarray, meta: np.ndarray) -> np.ndarray:
        views = np.stack([content @ self.content, meta @ self.metadata], axis=1)
        calibrated = views * self.calibration[:, 0] + self.calibration[:, 1]
        logit = calibrated @ self.weights[:2] + self.weights[2]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def cotrain(content: np.ndarray, meta: np.ndarray, label: np.ndarray, rounds: int, per_round: int, sure: float) -> Model | None:
    """The model from rows of both views; label is 0, 1, or -1 for the pool. None if a class is missing."""
    known = np.flatnonzero(label >= 0)
    held, train, pool = known[::4], np.setdiff1d(known, known[::4]), np.flatnonzero(label < 0)
    if len(set(label[train])) < 2 or len(set(label[held])) < 2:
        return None
    views, given = (content, meta), [{}, {}]
    fits: list[np.ndarray] = []
    for turn in range(rounds + 1):
        fits = []
        for view, extra in zip(views, given):
            rows = np.r_[train, np.fromiter(extra, int, len(extra))]
            fits.append(fit_logistic(view[rows], np.r_[label[train], np.fromiter(extra.values(), int, len(extra))].astype(float)))
        if turn == rounds or not len(pool):
            break
        share, more = label[train].mean(), False
        for k in (0, 1):
            free = np.array([r for r in pool if r not in given[1 - k]], int)
            p = 1 / (1 + np.exp(-np.clip(views[k][free] @ fits[k], -30, 30)))
            for value, at, most in ((1, p, share), (0, 1 - p, 1 - share)):
                best = np.argsort(-at, kind="stable")[:max(1, int(per_round * most))]
                chosen = free[best[at[best] >= sure]]
                given[1 - k].update(dict.fromkeys(chosen.tolist(), value))
                more |= bool(len(chosen))
        if not more:
            break
    raw, y = [view[held] @ w for view, w in zip(views, fits)], label[held].astype(float)
    platt = [fit_logistic(np.stack([r, np.ones(len(r))], axis=1), y, 1e-2) for r in raw]
    calibrated = np.stack([r * a + b for r, (a, b) in zip(raw, platt)] + [np.ones(len(y))], axis=1)
    return Model(fits[0], fits[1], np.array(platt), fit_logistic(calibrated, y, 1e-2))


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, columns: list[Column], size: Column,
          label_col: str = "quality", label_id: str = "doc_id", labelled_rows: int = 8000, pool_each: int = 50,
          rounds: int = 5, per_round: float = 0.1, sure: float = 0.97) -> Model | None:
    """A model from a bounded sample of labelled rows and a pool of other rows from all strata."""
    marked = labels.select(F.col(label_id).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label")).where(
        "_id is not null and _label in (0, 1)").groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most"))
    marked = marked.where("_label = _most").select("_id", "_label").orderBy(F.xxhash64("_id")).limit(labelled_rows)
    stratum = F.pmod(F.xxhash64(*[c.cast("string") for c in columns], F.lit(1)), F.lit(STRATA)).cast("int")
    sizes = {r["s"]: r["count"] for r in docs.groupBy(stratum.alias("s")).count().collect()}
    drawn = F.lit([int(min(1.0, pool_each / sizes.get(s, 1)) * (1 << 30)) for s in range(STRATA)])
    in_pool = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit(1)), F.lit(1 << 30)) < F.get(drawn, stratum)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"),
                       metadata(columns, size).alias("_meta"), in_pool.alias("_pool"))
    rows = rows.join(F.broadcast(marked), "_id", "left").where("_label is not null or _pool").select(
        "_id", measured(F.col("_text")).alias("_content"), "_meta", F.coalesce("_label", F.lit(-1)).alias("_label"))
    rows = rows.groupBy("_id").agg(F.min(F.struct("_label", "_content", "_meta")).alias("_row")).select("_id", "_row.*")
    sample = rows.toPandas()
    if sample.empty:
        return None
    sample = sample.sort_values(["_id", "_label"], kind="stable")
    meta = one_hot([list(x) for x in sample["_meta"]], len(columns) * CATEGORIES + SIZES)
    label = sample["_label"].to_numpy()
    each_round = max(1, int(per_round * (label < 0).sum()))
    return cotrain(np.array(sample["_content"].tolist()), meta, label, rounds, each_round, sure)


def measured(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([measures(x) for x in texts])
    return of(text)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          columns: tuple[str, ...] = ("lang", "source"), size_col: str = "n_chars", least: float = 0.5,
          prefix: str = "quality_", **training) -> DataFrame:
    """The rows with score and kept added, named with the prefix; kept means a score of ``least`` or more."""
    places, size = [F.col(c) for c in columns], F.col(size_col)
    model = train(docs, labels, id_col, text_col, places, size, **training)
    if model is None:
        score = F.lit(0.5)
    else:
        width = len(columns) * CATEGORIES + SIZES

        @F.pandas_udf("double")
        def scored(texts: pd.Series, meta: pd.Series) -> pd.Series:
            if not len(texts):
                return pd.Series([], dtype=float)
            return pd.Series(model.score(np.array([measures(x) for x in texts]), one_hot([list(m) for m in meta], width)))

        score = scored(F.col(text_col).cast("string"), metadata(places, size))
    return docs.withColumn(f"{prefix}score", score).withColumn(f"{prefix}kept", (F.col(f"{prefix}score") >= least) | F.lit(model is None))
