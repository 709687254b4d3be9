"""Helpers shared by the operators: written intermediate tables, linked components, merging of labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.session import scratch


def settle(df: DataFrame, label: str, session: SparkSession | None = None) -> DataFrame:
    """Write a table to the shared folder and read it again: later steps survive lost executors and start there.

    With ``session`` it is read in that one, whose settings then hold for what is made from it.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path)


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Connected components of links (a, b) by alternating large-star and small-star rounds.

    Returns (id, root) for each id that has a link, root being the smallest id that it reaches. Rows with
    a null end and links of an id with itself count for nothing. Each round is a grouping and a join on the
    linked ids and is written to the shared folder; only two totals of it reach the driver. A hub's links
    are summed within tasks before the shuffle, and its join can be split by adaptive execution.
    """
    links = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(most_rounds):
        marks = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if marks == before or not marks[0]:
            return links.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
                links.select("v", "v").distinct())
        before = marks
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = settle(small.union(least.select("u", "m")).distinct(), "links")
    raise RuntimeError(f"links were not resolved in {most_rounds} rounds")


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (positions, each pointing at its root) after the linked positions a and b are put together."""
    while True:
        left, right = labels[a], labels[b]
        open_ = left != right
        if not open_.any():
            return labels
        a, b = left[open_], right[open_]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels = labels[labels]
