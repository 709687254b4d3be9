"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is a window of consecutive words, whatever line ends lie between them; for a template of n words it has
n / ``containment`` words. A template matches a block if the share of the template's distinct words that the block
holds is at least ``containment`` and the words that name the license, where a template has such, are all among them.
Template words are ordered by the number of documents that hold them, rarest first, counted over all documents. A
document with a matching block must hold one of a template's first |T| - ceil(c |T|) + 1 words (prefix filter), have at
least ceil(c |T|) of the templates' words (length filter), and the first word found must leave enough words behind it
in the template and in the document (positional filter). For what passes, all blocks are counted exactly in one sweep:
a word that stands at place p is in the blocks that start behind its place before and at most a block's length before
p, so a running sum over starts and ends of these stretches gives every block's number of distinct words.

Texts are read once and reduced, within each row, to their phrase places and to the template words that they hold, with
places only where a template can match at all; only those are written, counted and joined. The templates' words are
the one broadcast table; its size is that of the template list.

A null text counts as empty. A null id is kept. Every row is judged by itself, also where rows repeat an id. Empty
tables give no rows. Texts are read whole, however long. Other columns are neither read nor returned. DataFrame
functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.common import settle
from tallystream.llm.license_texts import TEMPLATES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
Templates = tuple[tuple[str, str, str], ...]


def _places(words: Column, joined: Column, phrase: str) -> Column:
    """Where the words of a phrase begin; looked for only in texts that hold it."""
    parts = phrase.split(" ")

    def here(k: Column) -> Column:
        same = F.get(words, k) == parts[0]
        for n, part in enumerate(parts[1:], 1):
            same = same & (F.get(words, k + n) == part)
        return same

    found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))


def needed(words: int, containment: float) -> int:
    """How many of a template's distinct words a block must hold."""
    return max(1, math.ceil(containment * words - 1e-9))


def window(text: str, containment: float) -> int:
    """How many consecutive words make a block for a template."""
    return math.ceil(len(text.split(" ")) / containment - 1e-9)


def _can_match(held: Column, templates: Templates, containment: float) -> Column:
    """Whether the words held are enough for any template."""
    found = F.lit(False)
    for _, must, text in templates:
        words = sorted(set(text.split(" ")))
        enough = F.size(F.array_intersect(held, F.lit(words))) >= needed(len(words), containment)
        for word in must.split():
            enough = F.array_contains(held, word) & enough
        found = found | enough
    return found


def reduced(docs: DataFrame, id_col: str, text_col: str, phrases: dict[str, str], templates: Templates,
            containment: float) -> DataFrame:
    """One row per text: phrase places, the distinct template words held, and their places where a template can match."""
    vocabulary = F.lit(sorted({word for _, _, text in templates for word in text.split(" ")}))
    lowered = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.trim(F.regexp_replace(lowered, NO_WORD, " ")).alias("joined"))
    words = F.when(F.col("joined") == "", F.array().cast("array<string>")).otherwise(F.split("joined", " "))
    rows = rows.select("id", "joined", words.alias("words"))
    padded = F.concat(F.lit(" "), F.col("joined"), F.lit(" "))
    rows = rows.select(
        "id", "words", F.size("words").cast("long").alias("n_words"),
        F.array(*[F.struct(F.lit(label).alias("label"), _places(F.col("words"), padded, phrase).alias("at"))
                  for phrase, label in phrases.items()]).alias("found"),
        F.array_intersect("words", vocabulary).alias("held"))
    at = F.filter(F.transform("words", lambda w, k: F.struct(k.alias("at"), w.alias("word"))),
                  lambda e: F.array_contains(F.col("held"), e["word"]))
    return rows.select("id", "n_words", "found", "held", F.when(_can_match(F.col("held"), templates, containment), at).alias("places"))


def _candidates(texts: DataFrame, templates: Templates, containment: float) -> DataFrame:
    """(row, template, label, words, must, need, wide, places) for each text and template that pass the filters."""
    spark = texts.sparkSession
    counts = {r["word"]: r["count"] for r in texts.select(F.explode("held").alias("word")).groupBy("word").count().collect()}
    order = sorted({word for _, _, text in templates for word in text.split(" ")}, key=lambda w: (counts.get(w, 0), w))
    rank = {word: k for k, word in enumerate(order)}
    heads = []
    for k, (label, must, text) in enumerate(templates):
        words = sorted(set(text.split(" ")), key=rank.get)
        need, wide = needed(len(words), containment), window(text, containment)
        heads += [(word, place, k, label, words, must.split(), need, wide) for place, word in enumerate(words[:len(words) - need + 1])]
    prefix = spark.createDataFrame(heads, "word string, place int, template int, label string, words array<string>, "
                                          "must array<string>, need int, wide int")
    ranked = F.transform(F.array_sort(F.transform(
        "held", lambda w: F.struct(F.array_position(F.lit(order), w).alias("r"), w.alias("w")))), lambda s: s["w"])
    met = texts.where("places IS NOT NULL").select("row", "places", ranked.alias("held")).select(
        "row", "places", "held", F.posexplode("held").alias("after", "word")).join(F.broadcast(prefix), "word")
    fits = (F.size("words") - F.col("place") >= F.col("need")) & (F.size("held") - F.col("after") >= F.col("need"))
    shared = (F.size(F.array_intersect("held", "words")) >= F.col("need")) & (F.size(F.array_except("must", "held")) == 0)
    # A text meets a template at several prefix words; the first of them by rank stands for all.
    return met.where(fits & shared).groupBy("row", "template").agg(
        *[F.any_value(c).alias(c) for c in ("label", "words", "must", "need", "wide", "places")])


def _matches(candidates: DataFrame) -> DataFrame:
    """(row, label, share) of each text and template with a matching block: the largest share over its blocks."""
    named = ("row", "template", "label", "must", "need", "wide")
    own = candidates.select(*named, F.size("words").alias("size"), F.explode(F.filter(
        "places", lambda e: F.array_contains(F.col("words"), e["word"]))).alias("e")).select(*named, "size", "e.*")
    before = F.lag("at").over(Window.partitionBy("row", "template", "word").orderBy("at"))
    own = own.withColumn("first", F.greatest(F.coalesce(before + 1, F.lit(-(1 << 31) // 2)), F.col("at") - F.col("wide") + 1))
    names = F.array_contains("must", F.col("word")).cast("int")
    steps = own.select(*named, "size", F.explode(F.array(
        F.struct(F.col("first").alias("start"), F.lit(1).alias("d"), names.alias("m")),
        F.struct((F.col("at") + 1).alias("start"), F.lit(-1).alias("d"), (-names).alias("m")))).alias("s"))
    steps = steps.groupBy("row", "template", "label", "need", "size", F.size("must").alias("named"), "s.start").agg(
        F.sum("s.d").alias("d"), F.sum("s.m").alias("m"))
    run = Window.partitionBy("row", "template").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    blocks = steps.select("row", "label", "template", "need", "size", "named", F.sum("d").over(run).alias("d"), F.sum("m").over(run).alias("m"))
    return blocks.where((F.col("d") >= F.col("need")) & (F.col("m") == F.col("named"))).groupBy("row", "label", "template").agg(
        F.max(F.col("d") / F.col("size")).alias("share"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES,
         templates: Templates = TEMPLATES, containment: float = 0.8) -> DataFrame:
    """One row per text: id, n_words, places (of all phrases), base_labels, labels (arrays, sorted), score.

    ``places`` are the word numbers, from 0, where a phrase starts, once per phrase. ``score`` is the largest
    share of a template found in a block where it reaches the threshold, else 0. A template is a label, the words that
    a match must hold (none: empty), and its words.
    """
    if not 0 < containment <= 1:
        raise ValueError("containment must be above 0 and at most 1")
    texts = reduced(docs, id_col, text_col, phrases, templates, containment)
    texts = settle(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
    best = _matches(_candidates(texts, templates, containment)).groupBy("row").agg(
        F.collect_set("label").alias("labels"), F.max("share").alias("score"))
    own = F.transform(F.filter("found", lambda f: F.size(f["at"]) > 0), lambda f: f["label"])
    rows = texts.select("id", "row", "n_words", F.flatten(F.transform("found", lambda f: f["at"])).alias("places"), own.alias("base_labels"))
    return rows.join(best, "row", "left").select(
        "id", "n_words", "places", F.array_sort(F.array_distinct("base_labels")).alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("labels", F.array().cast("array<string>"))))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
