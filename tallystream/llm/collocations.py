"""Phrase collocation mining over weighted acyclic automata of n-grams.

Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at spaces and
tabs. Each task sorts the n-grams of up to ``shard_words`` words and builds a count transducer for each language from
them: the path of a phrase of one or two words leads to a state and has the number of its occurrences as weight; the
arcs of the state are the third words with theirs. Equal states are one. A transducer is cut by the prefix (the first
two words) into equal ranges of its hash, so neither a language nor a word with a third of all words makes a range
large; the number of ranges grows with the bytes of text. Transducers of one language and range are united in one
task, which sums their weights and tells the phrases that reach ``least``.

The parts of a phrase are at least as frequent as the phrase, so all counts that a score needs are among those told.
Candidates are composed with the counts, that is, joined by language and part; single words, which many candidates
ask for, are dealt to ``salts`` tasks each. Scores are worked out in decimals of 38 digits.

A null text counts as empty and a null language as ``und``. Repeated rows count each; ids are not read, nor are other
columns. Empty texts have no words; a language without a phrase that reaches ``least`` has no rows. Ties go by count,
then by phrase in the order of its bytes. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.common import settle
from tallystream.session import shuffle_tasks

#: Bytes as they are read: A-Z lower-cased, breaks between pieces as full stops.
READ = bytes(ord(".") if chr(x) in ".,;:!?\n\x0b\x0c\r" else x + 32 if 65 <= x <= 90 else x for x in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)

BLOCK = ("lang string, range int, words long, symbols array<string>, first array<int>, second array<int>, "
         "weight array<int>, state array<int>, arcs array<int>, third array<int>, count array<int>")
COUNTS = "lang string, size int, first string, second string, third string, n long"

#: 1000000 a a / (l r), rounded down, without overflow for counts up to 10^15.
SCORE = "(CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) * 1000000BD) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, with a full stop at each break between pieces."""
    return text.translate(READ).replace(b".", b" . ").split()


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their weights."""
    if weights is None:
        keys = np.sort(keys)
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
        return keys[at], np.diff(np.r_[at, len(keys)])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[at], np.add.reduceat(weights[order], at) if len(at) else weights


def _range_of(hashes: np.ndarray, first: np.ndarray, second: np.ndarray, ranges: int) -> np.ndarray:
    mixed = (hashes[first] * _ODD) ^ (hashes[second] + (hashes[first] >> np.uint64(17)))
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _ODD
    return ((mixed >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def transducers(words: list[bytes], ids: np.ndarray, ranges: int):
    """The count transducer of word ids, cut by ranges of prefixes: one dict of arrays for each range.

    Id k stands for words[k]; id 0 is a break. The sorted n-grams give the paths and arcs in order.
    """
    n = len(words)
    hashes = np.array([0, *(xxhash.xxh64_intdigest(x) for x in words[1:])], np.uint64)
    one, one_n = _counted(ids[ids > 0])
    inside = (ids[:-1] > 0) & (ids[1:] > 0)
    two_keys = ids[:-1] * n + ids[1:]
    two, two_n = _counted(two_keys[inside])
    three, three_n = _counted(two_keys[:-1][inside[:-1] & inside[1:]] * n + ids[2:][inside[:-1] & inside[1:]])
    # Prefixes: single words (no second word), then pairs; arcs hang on pairs.
    first, second = np.r_[one, two // n], np.r_[np.zeros(len(one), np.int64), two % n]
    weight = np.r_[one_n, two_n]
    parent = np.searchsorted(two, three // n) + len(one)
    arcs = np.bincount(parent, minlength=len(first))
    begin = np.cumsum(arcs) - arcs
    where = _range_of(hashes, first, second, ranges)
    order = np.argsort(where, kind="stable")
    cuts = np.searchsorted(where[order], np.arange(ranges + 1))
    for k in range(ranges):
        mine = order[cuts[k]:cuts[k + 1]]
        if len(mine):
            own = np.repeat(begin[mine], arcs[mine]) + _within(arcs[mine])
            yield k, _block(words, first[mine], second[mine], weight[mine], arcs[mine], three[own] % n, three_n[own])


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _block(words, first, second, weight, arcs, third, count) -> dict:
    """Arrays of a transducer with its own symbols; states with one equal arc, or without arcs, are one state.

    Words of prefixes are told by their distance to the prefix before, and a state as 0 where it is a new one, else as
    one more than its number, so that most entries are small.
    """
    begin = np.cumsum(arcs) - arcs
    key = np.full(len(arcs), -1, np.int64)
    single = arcs == 1
    key[single] = third[begin[single]] << 32 | count[begin[single]]
    several = np.flatnonzero(arcs > 1)
    key[several] = -2 - several
    _, kept, state = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(kept)
    number = np.empty(len(kept), np.int64)
    number[order], kept = np.arange(len(kept)), kept[order]
    state = number[state] + 1
    state[kept] = 0
    at = np.repeat(begin[kept], arcs[kept]) + _within(arcs[kept])
    third, count = third[at], count[at]
    used = np.unique(np.r_[0, first, second, third])
    return {"symbols": ["", *(words[k].decode() for k in used[1:].tolist())],
            "first": np.diff(np.searchsorted(used, first), prepend=0),
            "second": np.diff(np.searchsorted(used, second), prepend=0), "weight": weight, "state": state,
            "arcs": arcs[kept], "third": np.searchsorted(used, third), "count": count}


class _Shard:
    """Word ids of one language, and the words they stand for; a break is id 0."""

    def __init__(self):
        self.ids, self.parts = defaultdict(), []
        self.ids.default_factory = self.ids.__len__
        self.ids[b"."]

    def add(self, words: list[bytes]):
        self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words)))
        self.parts.append(np.zeros(1, np.int64))

    def blocks(self, lang: str, ranges: int):
        words = sorted(self.ids)
        words.remove(b".")
        words.insert(0, b".")
        place = np.empty(len(words), np.int64)
        place[[self.ids[x] for x in words]] = np.arange(len(words))
        ids = place[np.concatenate(self.parts)]
        total = int((ids > 0).sum())
        for k, block in transducers(words, ids, ranges):
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang]), "range": pa.array([k], pa.int32()), "words": pa.array([total], pa.int64())}
                | {name: pa.array([values], pa.list_(pa.string() if name == "symbols" else pa.int32()))
                   for name, values in block.items()})
            total = 0


def _sharded(shard_words: int, ranges: int):
    def of(batches):
        shards, held = defaultdict(_Shard), 0
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
            for lang, text in zip(langs, texts):
                words = words_of(text.as_py() or b"")
                shards[lang].add(words)
                held += len(words) + 1
                if held >= shard_words:
                    for name, shard in shards.items():
                        yield from shard.blocks(name, ranges)
                    shards, held = defaultdict(_Shard), 0
        for name, shard in shards.items():
            yield from shard.blocks(name, ranges)
    return of


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the length of each list."""
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64), pc.list_value_length(whole).to_numpy(
        zero_copy_only=False).astype(np.int64)


def _running(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums from the start of each block of values on."""
    sums, ends = np.cumsum(values), np.cumsum(sizes)
    return sums - np.repeat(np.r_[0, sums[ends[:-1] - 1]], sizes)


def _united(least: int):
    def of(table: pa.Table) -> pa.Table:
        names = table.column("symbols").combine_chunks()
        coded = names.flatten().dictionary_encode()
        symbol, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        base = np.r_[0, np.cumsum(pc.list_value_length(names).to_numpy(zero_copy_only=False))][:-1].astype(np.int64)
        n = len(known)
        (first, paths), (second, _), (weight, _), (state, _) = (
            _flat(table.column(x)) for x in ("first", "second", "weight", "state"))
        (arcs, states), (third, ends), (count, _) = (_flat(table.column(x)) for x in ("arcs", "third", "count"))
        first, second = _running(first, paths), _running(second, paths)
        state = np.where(state == 0, _running(state == 0, paths), state) - 1
        at = np.repeat(base, paths)
        prefix = symbol[first + at] * n + symbol[second + at]
        third = symbol[third + np.repeat(base, ends)]
        # The arcs of each path's state, spelled out.
        state = state + np.repeat(np.cumsum(states) - states, paths)
        begin, many = (np.cumsum(arcs) - arcs)[state], arcs[state]
        arc = np.repeat(begin, many) + _within(many)
        keys, total = _counted(prefix, weight)
        path = np.repeat(np.searchsorted(keys, prefix), many)
        longer, longer_total = _counted(path * n + third[arc], count[arc])
        long_, short = longer_total >= least, total >= least
        keys_of = np.r_[keys[short], keys[longer[long_] // n]]
        last = np.r_[np.full(int(short.sum()), -1), longer[long_] % n]
        two = pc.take(known, pa.array(keys_of % n))
        words = int(pc.sum(table.column("words")).as_py())
        lang = table.column("lang")[0].as_py()
        size = np.where(last >= 0, 3, np.where(pc.equal(two, "").to_numpy(zero_copy_only=False), 1, 2))
        told = pa.table({
            "lang": pa.repeat(pa.scalar(lang), len(last)), "size": pa.array(size.astype(np.int32)),
            "first": pc.take(known, pa.array(keys_of // n)), "second": two,
            "third": pc.take(known, pa.array(last, mask=last < 0)), "n": pa.array(np.r_[total[short], longer_total[long_]])})
        # Of all words of the language, those whose shards begin with this range.
        return pa.concat_tables([told, pa.table({
            "lang": [lang], "size": pa.array([0], pa.int32()), "first": [""], "second": [""],
            "third": pa.array([None], pa.string()), "n": [words]}).cast(told.schema)])
    return of


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10,
                  shard_words: int = 1_000_000, range_bytes: int = 1 << 24) -> DataFrame:
    """(lang, size, first, second, third, n): phrases of one to three words with at least ``least`` occurrences.

    Rows of size 0 add up to the number of words of the language.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(size / range_bytes))
    blocks = rows.mapInArrow(_sharded(shard_words, ranges), BLOCK)
    # A task holds one group at a time; more tasks than ranges, so that few get several of a language.
    if 4 * ranges > shuffle_tasks(docs.sparkSession):
        blocks = blocks.repartition(4 * ranges, "lang", "range")
    return blocks.groupBy("lang", "range").applyInArrow(_united(least), COUNTS)


def _phrase(*words: str) -> Column:
    return F.concat_ws(" ", *(F.col(x) for x in words))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, share: int = 50,
                 top: int = 2000, salts: int = 16, shard_words: int = 1_000_000, range_bytes: int = 1 << 24) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of two or three words of each language.

    A phrase inside a longer candidate that has at least ``share`` percent of its occurrences is left out.
    """
    if least < 1:
        raise ValueError("least must be at least 1")
    counts = settle(phrase_counts(docs, text_col, lang_col, least, shard_words, range_bytes), "phrases")
    threes = counts.where("size = 3").select("lang", F.col("n").alias("a"), "first", "second", "third")
    twos = counts.where("size = 2").select("lang", F.col("n").alias("a"), "first", "second")
    inside = threes.select("lang", "a", F.explode(F.array(
        F.struct("first", "second"), F.struct(F.col("second").alias("first"), F.col("third").alias("second")))).alias("w"))
    inside = inside.groupBy("lang", "w.first", "w.second").agg(F.max("a").alias("longer"))
    alone = twos.join(inside, ["lang", "first", "second"], "left").where(
        F.coalesce(F.col("longer") * 100 < F.col("a") * share, F.lit(True)))

    def cut(number: int, left: tuple[str, ...], right: tuple[str, ...]) -> list[Column]:
        return [F.struct(F.lit(number).alias("cut"), F.lit(side).alias("side"), F.lit(len(part)).alias("size"),
                         _phrase(*part).alias("part")) for side, part in (("l", left), ("r", right))]

    asked = alone.select("lang", _phrase("first", "second").alias("phrase"), "a", F.explode(F.array(
        *cut(1, ("first",), ("second",)))).alias("p")).unionAll(threes.select(
            "lang", _phrase("first", "second", "third").alias("phrase"), "a", F.explode(F.array(
                *cut(1, ("first",), ("second", "third")), *cut(2, ("first", "second"), ("third",)))).alias("p")))
    asked = asked.select("lang", "phrase", "a", "p.*").withColumn(
        "salt", F.when(F.col("size") == 1, F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int")).otherwise(0))
    held = counts.where("size IN (1, 2)").select(
        "lang", F.when(F.col("size") == 1, F.col("first")).otherwise(_phrase("first", "second")).alias("part"), "n",
        F.explode(F.sequence(F.lit(0), F.when(F.col("size") == 1, salts - 1).otherwise(0))).alias("salt"))
    found = asked.join(held, ["lang", "part", "salt"]).groupBy("lang", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("side") == "l", F.col("n"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("n"))).alias("r"))
    best = found.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    # First in parts of a language, so that only the first rows of each come together.
    part = F.pmod(F.xxhash64("phrase"), F.lit(max(salts, shuffle_tasks(docs.sparkSession))))
    within = Window.partitionBy("lang", "part").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = best.withColumn("part", part).withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counts.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
