"""Collocations, token alignment and decontamination against plain versions, with odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from tokenizers import Tokenizer

from tallystream.llm import alignment, collocations, winnowing
from tallystream.llm.queries import A_FILE, B_FILE, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(rows, least=10, share=50, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts[lang].update(tuple(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= share * f[q]}
        scored = []
        for p, a in found.items():
            if p not in inside:
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, at + 1, p.decode(), -a, l, r, total[lang], -s)
                for at, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def odd_phrases():
    draw = random.Random(5)
    words, weights = ["a", "B", "cé", "the", "\x1f", "\x00z", "x-y", " ", "漢"], [9, 5, 3, 8, 1, 1, 1, 1, 1]
    ends = [" ", "  ", "\t", " ", ". ", "\n", ",", " "]
    rows = []
    for _ in range(150):
        text = "".join(draw.choices(words, weights)[0] + draw.choice(ends) for _ in range(draw.randrange(60)))
        rows.append((draw.choice([None, "", " "]) if draw.random() < 0.05 else text, draw.choice([None, "en", "und"])))
    return rows + [("the end " * 5000, "en")]


@pytest.mark.parametrize("shard_words, range_bytes, top", [(1_000_000, 1 << 24, 2000), (500, 5000, 20), (9, 1 << 24, 2000)])
def test_collocations_of_any_shards_and_ranges(spark, shard_words, range_bytes, top):
    rows = odd_phrases()
    docs = spark.createDataFrame(rows, "text string, lang string").selectExpr("*", "'x' AS first", "1 AS n").repartition(5)
    got = collocations.collocations(docs, shard_words=shard_words, range_bytes=range_bytes, top=top).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, top=top)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), ("", "en")], empty.schema)).count() == 0


def test_collocation_scores_past_64_bits(spark):
    # Counts of a corpus of 10^15 words: their products have 36 digits.
    for a, l, r in ((10 ** 15 - 1, 10 ** 15 + 7, 10 ** 15 + 11), (999_999_999, 10 ** 15, 10 ** 9), (10, 10, 10)):
        row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").selectExpr(collocations.SCORE + " AS s").first()
        assert row["s"] == 1000000 * a * a // (l * r)


def plain_alignment(rows):
    both, told, count = alignment.Tokenizers(*map(alignment.read_file, (A_FILE, B_FILE))), [], Counter()
    exact = Tokenizer.from_file(A_FILE)
    exact.encode_special_tokens = True
    for id_, text in rows:
        (a,), (b,) = both.encode([text or ""])
        assert a == (exact.encode(" " + text, add_special_tokens=False).ids if a else [])
        ends = [[], []]
        for side, ids, table in ((0, a, both.a_bytes), (1, b, both.b_bytes)):
            for k in ids:
                ends[side].append((ends[side] or [0])[-1] + len(table[k]))
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            of_a = [k for k, e in zip(a[i:], ends[0][i:]) if e <= cut]
            of_b = [k for k, e in zip(b[j:], ends[1][j:]) if e <= cut]
            i, j = i + len(of_a), j + len(of_b)
            groups.append((of_a, of_b))
        links = [(x, y) for of_a, of_b in groups for x in of_a for y in of_b]
        count.update(set(links))
        told.append((id_, a, b, groups, links))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for id_, a, b, groups, links in told:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((id_, len(a), len(b), len(groups), len(links), sum(count[x] == most[x[0]] for x in links),
                    sum(count[x] for x in links), text, hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr)


def odd_texts():
    draw = random.Random(5)
    texts = [None, "", "Hello world  two\n\nthree", "été 你好 🙂🙂 a▁b", "你好,世界! 🙂 naïve <|endoftext|> </s> <0x41>", "a" * 500,
             "ab" * 333 + "é", "\x00\x01 x\r\n\ty", "  lead", "the cat sat on the mat. the end", " ", "x" * 1500]
    return [(draw.choice([1, 2, None, 4]), draw.choice(texts)) for _ in range(60)] + [(9, "word " * 500)]


@pytest.mark.parametrize("head_pairs", [0, 3, 1 << 18])
def test_alignment_of_odd_texts(spark, head_pairs):
    rows = odd_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS pairs", "1 AS row", "2 AS id").repartition(5)
    got = alignment.align(docs, A_FILE, B_FILE, head_pairs=head_pairs)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_alignment(rows)
    assert alignment.align(docs.limit(0), A_FILE, B_FILE).count() == 0


def test_links_in_bounded_runs(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 4, 60), rng.integers(0, 5, 80)
    a_group, b_group = np.sort(rng.integers(0, 6, 60)), np.sort(rng.integers(0, 6, 80))
    text_of = np.array([0, 0, 1, 1, 1, 2])
    whole = alignment.linked_pairs(a, b, a_group, b_group, text_of, 4, 5)
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 7)
    parts = alignment.linked_pairs(a, b, a_group, b_group, text_of, 4, 5)
    want = Counter((text_of[g], x << 32 | y) for g, x in zip(a_group, a.tolist()) for h, y in zip(b_group, b.tolist()) if g == h)
    for got in (whole, parts):
        assert {(t, p): n for t, p, n in zip(*(x.tolist() for x in got))} == {(int(t), p): n for (t, p), n in want.items()}


def test_quick_and_exact_encoding_agree():
    both = alignment.Tokenizers(*map(alignment.read_file, (A_FILE, B_FILE)))
    assert both.quick is not None
    chars = [chr(k) for k in range(0x250)]
    texts = [c + "a" + c + c + " " + c + "1" + c for c in chars] + [
        " " + c + d for c in chars for d in "\t\n \x85\xa0'A1\xb2"]
    exact = [x.ids for x in both.a.encode_batch(texts, add_special_tokens=False)]
    assert [both.quick.encode_ordinary(x) for x in texts] == exact


def test_alignment_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op12_token_alignment"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == [x[:7] + x[8:] for x in plain_alignment(docs)]
    assert public_tokenizers.path("byte_bpe_50k.json") == A_FILE


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_contamination(docs, items, window=10):
    def words(text):
        return WORD.findall((text or "").translate(LOWER))

    held = [(None if i is None else str(i), words(text)) for i, text in items]
    out = []
    for id_, text in docs:
        own, hit, found = words(text), set(), set()
        for item, body in held:
            m = min(window, len(body))
            spans = {tuple(body[k:k + m]) for k in range(len(body) - m + 1)} if m else ()
            for k in range(len(own) - m + 1 if m else 0):
                if tuple(own[k:k + m]) in spans:
                    hit.update(range(k, k + m))
                    found.add(item)
        listed = sorted(found - {None})
        out.append((id_, len(own), len(hit), listed, hashlib.sha256(",".join(listed).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("filter_bits", [5, 24])
def test_contamination_of_odd_texts(spark, filter_bits):
    draw = random.Random(3)
    some = ["a", "b", "c", "é", "Zz", "9"]

    def text(n):
        return draw.choice([" ", "-", "\n"]).join(draw.choice(some) for _ in range(draw.randrange(n)))

    docs = [(draw.choice([1, 2, 3, None]), None if draw.random() < 0.05 else text(50)) for _ in range(120)]
    docs += [(99, " ".join(some * 3000)), (98, ""), (97, "...")]
    items = [(draw.choice([1, 11, 12, None]), None if draw.random() < 0.1 else text(16)) for _ in range(25)]
    items += [(77, " ".join(some * 3)), (78, " ".join(some * 3)), (79, "É")]
    left = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS words", "1 AS row", "2 AS id").repartition(4)
    right = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS row", "4 AS sign")
    got = winnowing.contamination(left, right, filter_bits=filter_bits)
    assert sorted([(r["id"], r["n_words"], r["n_hit"], r["items"], r["items_sha256"]) for r in got.collect()], key=repr) == (
        plain_contamination(docs, items))
    for r in got.where("n_hit > 0").collect():
        ends = [(s["first"], s["end"]) for s in r["spans"]]
        assert sum(b - a for a, b in ends) == r["n_hit"] and all(x[1] < y[0] for x, y in zip(ends, ends[1:]))


def test_contamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two"), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[2:5] for r in winnowing.contamination(docs, items).collect()] == [(0, [], [])] * 2
    assert winnowing.contamination(docs.limit(0), items).count() == 0


def test_a_kept_fingerprint_in_each_shared_span():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 1 << 62, 10).astype(np.uint64)
    for span in range(1, 11):
        kept = set()
        for _ in range(20):
            around = rng.integers(0, 1 << 62, (2, 30)).astype(np.uint64)
            whole = np.r_[around[0], shared[:span], around[1]]
            start, place, least = winnowing.winnow(whole, np.zeros(len(whole), int), span)
            at = int(np.flatnonzero(start == 30)[0])
            kept.add((int(place[at]) - 30, int(least[at])))
        assert len(kept) == 1
