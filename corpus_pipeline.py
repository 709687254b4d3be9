"""The corpus pipeline: documents through language ID, quality, near-dedup and packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all that the stage
before kept. All but the last return the columns of ``documents``, and any others that the rows have, whatever their
names: each stage draws names of its own that are not taken.

In every stage rows with a null id are judged like others and none is lost for it; a null text counts as empty; rows
that repeat an id are judged each by its own text; an empty table gives an empty table. What a stage does with these
beyond that, and how it settles ties, stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm import language_id, packing, quality, simhash
from tallystream.llm.common import settle
from tallystream.sources.tables import read_table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the declared language and the source are evidence beside the text.

    Null, empty or letterless texts have no language and go. A null language or source is no evidence. Of languages
    that are equally likely the first by name counts. Equal rows get equal verdicts, so all of them stay or none.
    """
    judged = language_id.judge(docs, declared=F.col("lang"), host=F.col("source"))
    return judged.where("lid_kept").select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier scores as good.

    A score of exactly the threshold is good. A null language, source or size is a category of its own. Without labels
    of both classes, or without a table of rows to learn from, all documents stay.
    """
    judged = quality.judge(docs, read_table(spark, sf_dir, "labels"))
    return judged.where("quality_kept").select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within 4 bits, by 4-word shingles.

    The smallest id stays; where rows repeat it, the one with the least hash over all columns, and one of rows that
    are equal in all. Null and empty texts, if they come here, are one group. Rows with a null id all stay.
    """
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences that the documents' tokens go to; a row for each piece of a document.

    A text without tokens has one piece of length 0. Repeated rows are packed each. Pieces of equal length go by the
    hash of their id, then by row and piece.
    """
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_stage),
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: Trained models and packing have no SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed documents; each stage's result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
