"""Benchmark decontamination by winnowed fingerprints.

A window is ``window`` consecutive words of a benchmark item; an item of fewer words, but not none, is one window.
Words of a document that lie inside any occurrence of a window are hit. To find all occurrences without sending
documents through a shuffle, texts are winnowed: of the hashes of the k-grams in a span of n words the smallest is
kept (the last one on ties), with k = (n + 1) // 2. Two equal spans keep equal hashes at equal places, so every
occurrence of a window has a fingerprint that the item has as well. Documents are winnowed for the span length
``window`` and for the lengths of shorter items that there are.

A map of ``1 << filter_bits`` bits (the one thing that is sent to all tasks; its size does not depend on the data)
drops document fingerprints that no item can have. The others are joined with the items' by hash, and each hit is
extended to the windows that kept it, which are compared word by word. Keys are salted, so a passage that a third of
the documents hold is dealt to many tasks; windows of equal items share one signature, so documents are never
multiplied with the items that hold the same passage.

Null and empty texts have no words. Every row is judged by itself, so repeated rows and repeated or null document ids
come out as they came in. A null item id marks words, but is not listed or counted; items that repeat an id are
listed once. An empty benchmark leaves all documents clean; an empty table gives no rows. Texts are read whole,
however long. Other columns are neither read nor returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.common import settle

#: Bytes of text that are worked on at once; a longer text is worked on by itself.
BYTES_AT_ONCE = 1 << 20
_ODD, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _lower_and_class() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.zeros(256, bool)
    inside[48:58] = inside[97:123] = inside[128:] = True
    return lower, inside


LOWER, INSIDE = _lower_and_class()


def _mixed(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(32))) * np.uint64(_MIX)
    return codes ^ (codes >> np.uint64(29))


def slices(batch: pa.RecordBatch, column: int):
    """The batch in runs of rows with a bounded size of text, each with the text as binary without nulls."""
    texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    ends = np.cumsum(np.diff(np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + BYTES_AT_ONCE, "right")))
        yield batch.slice(start, end - start), texts.slice(start, end - start)
        start = end


def words_of(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of the words in them, and the text that each word is in."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    data = LOWER[raw]
    inside = INSIDE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # A word ends where its text does.
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return data, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word: differences of one running sum over all bytes, moved to the word's start."""
    inverse = pow(_ODD, -1, 1 << 64)
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(data), _ODD, np.uint64)])
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(data), inverse, np.uint64)])
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])]
    return _mixed((sums[ends] - sums[starts]) * back[starts])


def winnow(hashes: np.ndarray, text: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each span of this many words: its start, and place and hash of the k-gram that it keeps."""
    gram = (span + 1) // 2
    n = len(hashes) - span + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = np.zeros(len(hashes) - gram + 1, np.uint64)
    for k in range(gram):
        grams = grams * np.uint64(_ODD) + hashes[k:k + len(grams)]
    grams = _mixed(grams)
    least, place = grams[:n].copy(), np.arange(n)
    for k in range(1, span - gram + 1):
        after = grams[k:k + n]
        better = after <= least
        least[better] = after[better]
        place[better] = np.flatnonzero(better) + k
    start = np.flatnonzero(text[:n] == text[span - 1:span - 1 + n])
    return start, place[start], least[start]


def _fingerprints(spans: tuple[int, ...], bits: np.ndarray | None, filter_bits: int):
    shift, longest = np.uint64(64 - filter_bits), max(spans)

    def of(batches):
        known = None if bits is None else np.unpackbits(bits, bitorder="little").view(bool)
        for batch in batches:
            for rows, texts in slices(batch, 1):
                yield records(rows, texts, known)

    def records(rows, texts, known):
        data, starts, ends, text = words_of(texts)
        hashes, parts = _word_hashes(data, starts, ends), []
        of_text = np.bincount(text, minlength=len(rows))
        for span in spans:
            start, place, least = winnow(hashes, text, span)
            if known is None:
                wanted = np.minimum(of_text[text[start]], longest) == span
            else:
                wanted = known[(least >> shift).astype(np.int64)]
            start, place, least = start[wanted], place[wanted], least[wanted]
            # Neighbouring spans that keep the same k-gram make one record.
            new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)][:len(start)])
            count = np.diff(np.r_[new, len(start)])
            parts.append((np.full(len(new), span), start[new], count, least[new]))
        span, start, count, least = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(text[start], kind="stable")
        span, start, count, least = span[order], start[order], count[order], least[order]
        plain, end = data.tobytes(), start + count - 1 + span
        words = [b" ".join([plain[i:j] for i, j in zip(starts[a:b].tolist(), ends[a:b].tolist())]).decode()
                 for a, b in zip(start.tolist(), end.tolist())]
        first = np.cumsum(of_text) - of_text
        found = pa.StructArray.from_arrays(
            [pa.array(span.astype(np.int32)), pa.array((start - first[text[start]]).astype(np.int32)),
             pa.array(count.astype(np.int32)), pa.array(least.view(np.int64)), pa.array(words, pa.string())],
            ["span", "start", "count", "code", "words"])
        ends_of = np.cumsum(np.bincount(text[start], minlength=len(rows)))
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(of_text.astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(np.r_[0, ends_of].astype(np.int32)), found)],
            ["id", "n_words", "found"])
    return of


def fingerprints(texts: DataFrame, id_col: str, text_col: str, spans: tuple[int, ...], bits: np.ndarray | None = None,
                 filter_bits: int = 24) -> DataFrame:
    """(id, n_words, found) for each row; found lists the kept fingerprints, each with the words of its spans.

    With a map of bits only fingerprints in it are told, else each text's spans of its own length or the longest.
    """
    rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        _fingerprints(spans, bits, filter_bits),
        f"id {kind}, n_words long, found array<struct<span: int, start: int, count: int, code: long, words: string>>")


def _extended(rows: DataFrame, *keep: str) -> DataFrame:
    """One row for each span that kept a fingerprint, with its own words."""
    one = rows.select(*keep, F.explode("found").alias("f")).select(
        *keep, "f.span", "f.start", "f.code", F.split("f.words", " ").alias("all"),
        F.explode(F.sequence(F.lit(0), F.col("f.count") - 1)).alias("nth"))
    return one.select(
        *keep, "span", (F.col("start") + F.col("nth")).alias("start"), "code",
        F.array_join(F.slice("all", F.col("nth") + 1, F.col("span")), " ").alias("words"))


def _bit_map(codes: DataFrame, filter_bits: int) -> np.ndarray:
    """The places of the codes in a map of fixed size, packed into bytes."""
    place = F.shiftrightunsigned("code", 64 - filter_bits)
    cells = codes.select(place.alias("place")).groupBy(F.expr("place DIV 32").alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place % 32 AS int)))").alias("bits"))
    found = cells.toArrow()
    words = np.zeros(max(1, (1 << filter_bits) // 32), np.uint32)
    words[found.column("cell").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return words.view(np.uint8)


def _signature(item: Column) -> Column:
    """A name for a set of items: equal for equal sets, in whatever order they are added up."""
    return F.concat_ws(
        ":", F.count(item), F.bit_xor(F.xxhash64(item)),
        F.sum(F.xxhash64(item, F.lit(1)).cast("decimal(38,0)")).cast("string"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10, filter_bits: int = 24,
                  salts: int = 16) -> DataFrame:
    """(id, n_words, n_hit, spans, items, items_sha256) for each document.

    spans are the runs of hit words (first, end) and items the item ids with a window in the text, as sorted
    strings; items_sha256 is the digest of these, joined by commas.
    """
    if window < 1 or not 5 <= filter_bits <= 30:
        raise ValueError("window must be at least 1 and filter_bits between 5 and 30")
    items = fingerprints(benchmark, item_col, item_text_col, tuple(range(1, window + 1)), None, filter_bits)
    items = items.select(F.col("id").cast("string").alias("item"), "found")
    held = settle(_extended(items, "item").select("item", "span", "code", "words").distinct(), "windows")
    spans = tuple(sorted(row["span"] for row in held.select("span").distinct().collect()))
    bits = _bit_map(held, filter_bits)
    known = settle(held.groupBy("code", "words").agg(_signature(F.col("item")).alias("sign")), "signatures")

    rows = fingerprints(docs, id_col, text_col, spans or (window,), bits, filter_bits)
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    seen = _extended(rows.where(F.size("found") > 0), "row").withColumn(
        "salt", F.pmod(F.xxhash64("row", "start"), F.lit(salts)).cast("int"))
    hits = settle(seen.join(salted, ["code", "words", "salt"]).select(
        "row", "start", (F.col("start") + F.col("span")).alias("end"), "sign"), "hits")

    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int")
    runs = hits.withColumn("apart", apart).withColumn("run", F.sum("apart").over(upto)).groupBy("row", "run").agg(
        F.min("start").alias("first"), F.max("end").alias("end"), F.collect_set("sign").alias("signs"))
    marked = runs.groupBy("row").agg(
        F.sum(F.col("end") - F.col("first")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("signs")))).alias("signs"))
    marked = settle(marked.withColumn("key", F.sha2(F.array_join("signs", ","), 256)), "marked")

    # The items are listed once for each set of signatures, not for each document.
    one = known.groupBy("sign").agg(F.min(F.struct("code", "words")).alias("w")).select("sign", "w.*")
    members = one.join(held, ["code", "words"]).where("item IS NOT NULL").select("sign", "item")
    sets = marked.select("key", "signs").distinct().select("key", F.explode("signs").alias("sign"))
    lists = sets.join(members, "sign").groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    told = marked.join(lists, "key", "left").select("row", "n_hit", "spans", F.coalesce("items", none).alias("items"))
    told = told.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
    no_spans = F.array().cast(told.schema["spans"].dataType)
    out = rows.select("id", "n_words", "row").join(told, "row", "left")
    return out.select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("spans", no_spans).alias("spans"),
        F.coalesce("items", none).alias("items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"))
