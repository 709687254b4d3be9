"""Registered queries against their SQL or a plain version, over whole small tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from comparing import TYPE_NAMES, canonical, oracle_rows
from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from tallystream.llm import byte_bpe, packing, quality
from tallystream.llm.queries import ORACLES, QUERIES, VOCABULARY


def rows_of(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()


def plain_fingerprint(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for k in range(64):
            counts[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(shingles))


def plain_components(ids, near):
    """The smallest id that each id reaches; near: pairs of positions."""
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a, b in near:
        root[find(a)] = find(b)
    least = defaultdict(list)
    for k in range(len(ids)):
        least[find(k)].append(ids[k])
    return [min(least[find(k)]) for k in range(len(ids))]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    names, types, want = oracle_rows(SF_DIR, ORACLES[name])
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, want)
    assert {f.name: TYPE_NAMES[f.dataType.simpleString()] for f in df.schema} == types


def test_simhash_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_simhash_near_dedup"](spark, SF_DIR).collect()}
    docs = rows_of(spark, "documents")
    prints = [plain_fingerprint(d["text"] or "") for d in docs]
    codes = np.array(prints, dtype=np.uint64)
    near = np.argwhere(np.bitwise_count(codes[:, None] ^ codes[None]) <= 4)
    want = plain_components([d["doc_id"] for d in docs], near.tolist())
    assert len(got) == len(docs)
    for doc, code, root in zip(docs, prints, want):
        assert (got[doc["doc_id"]]["fingerprint"], got[doc["doc_id"]]["component_id"]) == (f"{code:016x}", root)


def test_bpe_query(spark):
    ranks = byte_bpe.read_ranks(VOCABULARY)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in QUERIES["op5_byte_bpe"](spark, SF_DIR).collect()}
    docs = rows_of(spark, "documents")
    assert len(got) == len(docs)
    for doc in docs:
        ids, row = plain.encode_ordinary(doc["text"] or ""), got[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((doc["text"] or "").encode()).hexdigest()


def test_url_query(spark):
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    got = {r["page_id"]: r for r in QUERIES["op4_url_filter"](spark, SF_DIR).collect()}
    pages = rows_of(spark, "pages")
    assert len(got) == len(pages)
    for page in pages:
        rest = (page["url"] or "").partition("://")[2]
        host = regex.split(r"[/?#]", rest)[0]
        path = regex.split(r"[?#]", rest[len(host):])[0]
        host = host.lower()
        fits = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and path.startswith("/" + r.split("/", 1)[1])]
        rule, row = max(fits, key=len, default=None), got[page["page_id"]]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (rules[rule] if rule else "block" if row["distrust"] > row["trust"] else "allow")


def test_quality_on_held_out_labels(spark):
    at = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{at}/{name}.parquet") for name in ("documents", "labels"))
    judged = quality.judge(docs, labels.where("doc_id % 2 = 0"))
    got = {r["doc_id"]: r["quality_kept"] for r in judged.select("doc_id", "quality_kept").collect()}
    held = [(r["doc_id"], r["quality"]) for r in labels.where("doc_id % 2 = 1").collect() if r["doc_id"] in got]
    assert len(held) > 100 and len({q for _, q in held}) == 2
    assert np.mean([got[i] == bool(q) for i, q in held]) > 0.97
    assert np.mean([got[i] for i, q in held if q]) > 0.98


def test_quality_query(spark):
    got = {r["doc_id"]: r["kept"] for r in QUERIES["op3_quality_classifier"](spark, SF_DIR).collect()}
    labels = [(r["doc_id"], r["quality"]) for r in rows_of(spark, "labels") if r["doc_id"] in got]
    assert len(got) == len(rows_of(spark, "documents"))
    assert np.mean([got[i] == bool(q) for i, q in labels]) > 0.97
    assert np.mean([got[i] for i, q in labels if q]) > 0.98


def test_language_query_against_declared(spark):
    got = {r["doc_id"]: r for r in QUERIES["op7_language_id"](spark, SF_DIR).collect()}
    docs = rows_of(spark, "documents")
    assert len(got) == len(docs)
    assert np.mean([got[d["doc_id"]]["language"] == d["lang"] for d in docs]) > 0.98
    assert all(got[d["doc_id"]]["kept"] for d in docs if regex.search(r"\p{L}{3}", d["text"] or ""))


def test_languages_of_pages(spark):
    at = "/root/testdata/sf0.01"
    got = {r["page_id"]: r for r in QUERIES["op7_language_id_of_pages"](spark, at).collect()}
    pages = spark.read.parquet(f"{at}/pages.parquet").collect()
    assert len(got) == len(pages)
    declared = {p["page_id"]: regex.search(r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2})", p["html"] or "") for p in pages}
    told = [(got[k]["language"], m.group(1).lower()) for k, m in declared.items() if m]
    assert len(told) > len(pages) / 2 and np.mean([a == b for a, b in told]) > 0.9


def check_packed(packed, tokens, capacities):
    """Every token of each document once, in sequences that hold no more than their size."""
    fill, pieces = defaultdict(list), defaultdict(list)
    for r in packed:
        fill[r["shard"], r["bin"], r["capacity"]].append((r["bin_offset"], r["n_tokens"]))
        pieces[r["id"]].append((r["start"], r["n_tokens"]))
    assert len({k[:2] for k in fill}) == len(fill)
    for (_, _, capacity), parts in fill.items():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= capacity and capacity in capacities
        assert not [c for c in capacities if end <= c < capacity]
    assert {k: sorted(v) for k, v in pieces.items()} == {
        k: [(s, min(capacities[-1], n - s)) for s in range(0, max(1, n), capacities[-1])] for k, n in tokens.items()}


def test_packing_query(spark):
    packed = QUERIES["op10_best_fit_packing"](spark, SF_DIR).withColumnRenamed("doc_id", "id").collect()
    tokens = {d["doc_id"]: len(regex.findall(r"[^\t\n\x0b\f\r ]+", d["text"] or "")) for d in rows_of(spark, "documents")}
    check_packed(packed, tokens, (512, 1024, 2048, 4096))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in rows_of(spark, "labels")}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        rows = docs.collect()
        after = {r["doc_id"] for r in rows}
        assert len(rows) == len(after) and after <= before
        gone = before - after
        if name == "language_id":
            assert not gone
        if name == "quality_classifier":
            assert np.mean([not labels[i] for i in gone if i in labels]) > 0.9
            assert sum(labels[i] for i in gone if i in labels) <= 0.02 * sum(labels.values())
        if name == "simhash_near_dedup":
            codes = np.array([plain_fingerprint(r["text"]) for r in rows], dtype=np.uint64)
            apart = np.bitwise_count(codes[:, None] ^ codes[None])
            assert (apart > 4).sum() == len(codes) * (len(codes) - 1)
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).withColumnRenamed("doc_id", "id").collect()
    check_packed(packed, {r["doc_id"]: len(r["text"].split()) for r in docs.collect()}, (512, 1024, 2048, 4096))
    assert Counter(r["id"] for r in corpus_pipeline.run(spark, SF_DIR).withColumnRenamed("doc_id", "id").collect()) == Counter(
        r["id"] for r in packed)


def test_pipeline_of_odd_rows(spark, folder):
    """Nulls in all columns, empty and very long texts, repeated ids and rows, ties and columns with the stages' own names."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60")
    odd = spark.createDataFrame([
        (None, None, None, None, None), (1001, None, "en", "src1", 0), (1002, "", None, None, None), (1003, "word " * 60000, "en", None, 300000),
        (1004, "%%% $$ ###", "xx", "src1", -5), (1005, "Is and the of with by that", None, "src2", None)], docs.schema)
    first = docs.where("doc_id < 10")
    rows = docs.unionByName(odd).unionByName(first).unionByName(first.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars"))
    rows = rows.withColumns({"lid__e": F.lit(1), "quality_x": F.lit("q"), "mark": F.lit(2), "fp": F.lit(None).cast("int"), "_meta": F.lit("m"),
                             "root": F.create_map(F.lit("a"), F.lit(1))})
    kept = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.settle(stage(spark, kept, SF_DIR), name)
        assert kept.columns == rows.columns
        ids = Counter(r["doc_id"] for r in kept.select("doc_id").collect())
        if name == "language_id":
            assert ids[0] == rows.where("doc_id = 0").count() and ids[1003] == 1 and not ids[1001] + ids[1002] + ids[1004]
        if name == "simhash_near_dedup":
            assert ids[None] and set(Counter({i: n for i, n in ids.items() if i is not None}).values()) == {1}
    assert corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).count() >= kept.count()
    empty = rows.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.settle(stage(spark, empty, SF_DIR), name)
        assert out.count() == 0 and (name == "best_fit_packing" or out.columns == rows.columns)


def cost(packed, overhead):
    bins, _, sizes = packed
    return sum(size + overhead for size in dict(zip(bins.tolist(), sizes.tolist())).values())


def least_cost(lengths, capacities, overhead):
    """The least cost of any packing, found by trying all."""
    best = [float("inf")]

    def place(k, used):
        if k == len(lengths):
            best[0] = min(best[0], sum(min(c for c in capacities if c >= u) + overhead for u in used))
            return
        for at in range(len(used)):
            if used[at] + lengths[k] <= capacities[-1]:
                place(k + 1, [*used[:at], used[at] + lengths[k], *used[at + 1:]])
        place(k + 1, [*used, lengths[k]])

    place(0, [])
    return best[0]


def single_size_cost(lengths, capacities, overhead):
    """Best fit into the largest size alone, downsized."""
    used = []
    for n in sorted(lengths, reverse=True):
        at = [k for k in range(len(used)) if used[k] + n <= capacities[-1]]
        if at:
            used[max(at, key=lambda k: used[k])] += n
        else:
            used.append(n)
    return sum(min(c for c in capacities if c >= u) + overhead for u in used)


def test_packing_against_all_packings():
    rng = np.random.default_rng(4)
    excess, equal = [], 0
    for _ in range(120):
        capacities = tuple(sorted(rng.choice(range(4, 24), 3, replace=False).tolist()))
        lengths = rng.integers(1, capacities[-1] + 1, rng.integers(1, 8))
        got = cost(packing.best_fit(lengths, capacities, 1), 1)
        want = least_cost(lengths.tolist(), capacities, 1)
        assert want <= got <= single_size_cost(lengths.tolist(), capacities, 1)
        excess.append(got / want)
        equal += got == want
    assert equal >= 90 and np.mean(excess) < 1.03 and max(excess) < 1.5


def test_sizes_are_chosen_by_what_fills_them():
    bins, _, sizes = packing.best_fit(np.full(400, 1000), (1000, 4096), 8)
    assert set(sizes.tolist()) == {1000} and len(set(bins.tolist())) == 400
    bins, _, sizes = packing.best_fit(np.array([1000] * 40 + [96] * 10), (1000, 4096), 8)
    assert Counter(dict(zip(bins.tolist(), sizes.tolist())).values()) == {4096: 10}
    lengths = np.random.default_rng(5).choice([300, 700, 1500, 2600], 500)
    packed = packing.best_fit(lengths, (768, 1536, 2600, 4096), 8)
    assert len(set(packed[2].tolist())) > 1
    assert cost(packed, 8) <= single_size_cost(lengths.tolist(), (768, 1536, 2600, 4096), 8)
