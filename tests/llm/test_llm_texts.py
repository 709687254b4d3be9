"""Operators on texts with odd rows: nulls, empty and long texts, repeated rows, clashing columns, empty tables."""

import os
import subprocess
import sys
import textwrap

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_DIR
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallystream.llm import byte_bpe, language_id, license_scan, license_texts, packing, quality, simhash, url_filter
from tallystream.llm.common import components
from tallystream.llm.queries import VOCABULARY
from test_llm_queries import check_packed, plain_components, plain_fingerprint

MIT = f"{license_texts.MIT_GRANT} {license_texts.MIT_NOTICE} {license_texts.MIT_WARRANTY}"
LONG = "a long text of several words, " * 8000
TEXTS = [(1, "One two three four five six"), (2, "one TWO three four five six"), (3, None), (4, ""), (5, " \t\n"),
         (6, "x"), (7, LONG), (8, LONG), (9, "é è ñ"), (9, "é è ñ"), (None, "one two three four five six"), (10, "z" * 30000)]
SCHEMA = "doc_id long, text string, id int, fp int, node int, lang string, source string, n_chars long"


def docs(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, 0, 0, 0, "en", "s", 5) for i, t in rows], SCHEMA)


def test_simhash_of_odd_rows(spark):
    got = simhash.simhash_groups(docs(spark)).collect()
    assert len(got) == len(TEXTS)
    by = {r["id"]: r for r in got}
    for i, text in TEXTS:
        assert by[i]["fp"] & (1 << 64) - 1 == plain_fingerprint(text or "")
    assert {by[i]["component"] for i in (3, 4, 5)} == {3}
    assert by[1]["component"] == by[2]["component"] == by[None]["component"] == 1
    assert by[8]["component"] == 7 and by[9]["component"] == 9
    assert simhash.simhash_groups(docs(spark, [])).count() == 0


def test_one_row_of_each_group_stays(spark):
    stay = simhash.keep_one(docs(spark))
    assert stay.columns == docs(spark).columns
    assert sorted(r["doc_id"] or 0 for r in stay.collect()) == [0, 1, 3, 6, 7, 9, 10]
    named = docs(spark).withColumnsRenamed({"id": "_kept", "fp": "count", "node": "_row"})
    assert sorted(r["doc_id"] or 0 for r in simhash.keep_one(named).collect()) == [0, 1, 3, 6, 7, 9, 10]


def test_repeated_ids_with_different_texts(spark):
    texts = [" ".join(f"{word}{k}" for k in range(12)) for word in ("a", "b", "c", "d")]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (3, texts[2]), (3, texts[3]), (3, texts[3]), (4, texts[0])]
    assert sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(docs(spark, rows)).collect()) == [
        (1, texts[0]), (1, texts[1]), (2, texts[2]), (3, texts[3])]


def test_rows_that_are_equal_or_hold_maps(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "u v w x y z"), (3, "u v w x y z")]
    frame = docs(spark, rows).withColumn("m", F.create_map(F.lit("k"), F.lit(1))).withColumn(
        "s", F.struct(F.create_map(F.lit("k"), F.col("doc_id")).alias("m"))).withColumn("mark", F.lit(1)).withColumn("copies", F.lit(2))
    stay = simhash.keep_one(frame)
    assert stay.columns == frame.columns
    assert sorted((r["doc_id"], r["m"]["k"], r["s"]["m"]["k"]) for r in stay.collect()) == [(1, 1, 1), (3, 1, 3)]
    assert simhash.keep_one(frame.limit(0)).count() == 0


def test_texts_are_fingerprinted_once_and_shuffled_once(spark):
    frame = docs(spark, [(k, f"{k} b c d {k} f") for k in range(50)])
    plan = simhash.keep_one(frame)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert "Python" not in plan and "InArrow" not in plan
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning" in x]) == 2


@pytest.mark.parametrize("max_bits", [0, 3, 4])
def test_links_of_split_nodes(spark, max_bits):
    rng = np.random.default_rng(1)
    codes = {int(c) for c in rng.integers(0, 1 << 63, 60)}
    for c in list(codes)[:20]:
        for _ in range(15):
            codes.add(c ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(1, 6), replace=False)))
    codes |= {(5 << 50) + k for k in range(300)}
    codes = sorted(codes)
    links = simhash.fingerprint_links(spark.createDataFrame([(c,) for c in codes], "code long"), max_bits, part_rows=16)
    roots = {r["id"]: r["root"] for r in components(links).collect()}
    x = np.array(codes, dtype=np.uint64)
    near = np.argwhere(np.bitwise_count(x[:, None] ^ x[None]) <= max_bits)
    assert [roots.get(c, c) for c in codes] == plain_components(codes, near.tolist())


def test_large_nodes_are_refined_where_that_sends_fewer_rows(spark):
    rng = np.random.default_rng(2)
    spread = {int(c) for c in rng.integers(-(1 << 63), (1 << 63) - 1, 300)}
    wide = {-(1 << 62) + int(c) for c in rng.integers(0, 1 << 50, 400)}
    wide |= {c ^ sum(1 << int(k) for k in rng.choice(62, 3, replace=False)) for c in list(wide)[:100]}
    tight = {(7 << 44) ^ sum(1 << int(k) for k in rng.choice(20, 2, replace=False)) for _ in range(300)}
    codes = sorted(spread | wide | tight)
    df = spark.createDataFrame([(c,) for c in codes], "code long")
    x = np.array(codes, dtype=np.int64).view(np.uint64)
    want = plain_components(codes, np.argwhere(np.bitwise_count(x[:, None] ^ x[None]) <= 4).tolist())
    sent = {}
    for levels in (1, 2, 3):
        roots = {r["id"]: r["root"] for r in components(simhash.fingerprint_links(df, 4, 8, levels)).collect()}
        assert [roots.get(c, c) for c in codes] == want
        sent[levels] = simhash.upper_nodes(df, 4, 8, levels).agg(F.sum("parts")).first()[0]
    assert sent[3] <= sent[2] < sent[1] / 2


def test_masks_below_cut_the_free_bits():
    for mask in (0, 0xFFF0000000000000, 0x00FF00FF00FF00FF, (1 << 64) - 1):
        below = simhash.masks_below(mask, 5)
        assert all(m & mask == mask for m in below)
        assert sum(m ^ mask for m in below) == (1 << 64) - 1 - mask


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (300, 200)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 61)}, **{k: 100 for k in range(100, 160)}, 200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bpe_of_odd_rows(spark):
    ranks = byte_bpe.read_ranks(VOCABULARY)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    more = [(20, "it's  we'll　x  ١٢ ½ 漢字 👍🏽\x85\x1c<|endoftext|>"), (21, "ab" * 2000), (22, "\n\n  \n x")]
    got = byte_bpe.decode(byte_bpe.encode(docs(spark, TEXTS + more), ranks, public_tokenizers.PATTERN, most_words=3), ranks)
    rows = got.collect()
    assert sorted((r["id"] or 0, bytes(r["ids"]), bytes(r["decoded"])) for r in rows) == sorted(
        (i or 0, np.array(plain.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in TEXTS + more)
    assert byte_bpe.decode(byte_bpe.encode(docs(spark, []), ranks, public_tokenizers.PATTERN), ranks).count() == 0


def test_words_are_folded_alike_by_heap_and_by_list():
    ranks = byte_bpe.read_ranks(VOCABULARY)
    rng = np.random.default_rng(5)
    for n in range(1, 47):
        word = bytes(rng.choice(list(b"thereandionis\xc3\xa9"), n).tolist())
        if word not in ranks:
            assert byte_bpe.fold(word, ranks) == byte_bpe._fold_long(word, ranks)


def plain_scan(text, containment=0.8):
    import regex
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    find = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    words, places, base = find(lower), [], set()
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        at = [k for k in range(len(words)) if words[k:k + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    labels, score = set(base), 0.0
    for label, must, body in license_scan.TEMPLATES:
        wanted, wide = set(body.split()), license_scan.window(body, containment)
        for k in range(len(words)):
            block = set(words[k:k + wide])
            share = len(block & wanted) / len(wanted)
            if share >= containment - 1e-12 and set(must.split()) <= block:
                labels.add(label)
                score = max(score, share)
    return len(words), sorted(places), sorted(base), sorted(labels), score


def test_license_scan(spark):
    rows = TEXTS + [
        (30, "Licensed under CC BY-NC 4.0.\nall RIGHTS\nreserved cc by cc by"), (31, "the Apache License, version 2 licensed under 0"),
        (32, "General-Public\nLicense\rversion 3 this work is under the GNU general public license"), (33, "ccé by cc by"),
        (34, "permission is hereby granted to any person obtaining a copy of this software and associated files, free of charge"),
        (35, "released under mit license"), (36, "mit license mit license"), (36, "Released under the MIT License."),
        (37, "This book is released under the BSD license."), (38, "It was released to the press under a cover; no license had the"),
        (39, "released " + "word " * 700 + "under " + "word " * 700 + "the license of MIT"), (40, MIT), (41, MIT.replace(" ", "\n")),
        (42, f"{MIT} {MIT} x " * 20), (43, "x " * 5000 + MIT), (44, MIT.replace("software", "work").replace("copyright", "name"))]
    got = license_scan.scan(docs(spark, rows)).collect()
    tell = lambda r: (r["id"] or 0, r["n_words"], sorted(r["places"]), r["base_labels"], r["labels"], r["score"])
    assert sorted(map(tell, got)) == sorted((i or 0, *plain_scan(t)) for i, t in rows)
    assert license_scan.scan(docs(spark, [])).count() == 0


def test_words_that_name_a_license(spark):
    rows = [(1, "This book is released under the BSD license."), (2, "Released by the state under a license of others."),
            (3, "released " + "word " * 700 + "under the license"), (4, "Released under the MIT terms; the license"), (5, MIT[:300])]
    got = {r["id"]: r["labels"] for r in license_scan.scan(docs(spark, rows)).collect()}
    assert got == {1: [], 2: [], 3: [], 4: ["mit"], 5: ["mit"]}


def test_license_sentences_wrapped_over_lines(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including the rights to use")
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met")
    before = "Words that stand before the sentence, some of them long enough to move it. " * 3
    wrapped = lambda text, mark="": "\n".join(textwrap.wrap(text, 72, initial_indent=mark, subsequent_indent=mark))
    short = wrapped(mit).replace("granted", "given").replace("documentation", "paper")
    apart = "\n".join(word + " x" * 9 for word in bsd.split())
    rows = [(1, wrapped(mit)), (2, wrapped(bsd)), (3, before + wrapped(mit)), (4, wrapped(before + bsd, "# ")), (5, short), (6, apart),
            (7, "\r\n".join(mit.split())), (8, wrapped(bsd) + "\n\n" + wrapped(mit)), (9, "under the\nlicense of others")]
    got = {r["id"]: (r["labels"], r["score"]) for r in license_scan.scan(docs(spark, rows)).collect()}
    assert got[1] == got[3] == got[7] == (["mit"], 1.0) and got[2] == got[4] == (["bsd"], 1.0)
    assert got[5] == (["mit"], 17 / 19) and got[6] == got[9] == ([], 0.0) and got[8] == (["bsd", "mit"], 1.0)


def test_language_of_odd_rows(spark):
    many = [(k, t, 0, 0, 0, lang, f"www.{lang}.org", 5) for lang, t in (("en", "the cat and the dog of the house"), (
        "fr", "le chat et le chien de la maison")) for k in range(100, 130)]
    rows = many + [
        (1, None, 0, 0, 0, "en", "www.en.org", 5), (2, "", 0, 0, 0, "fr", None, 5), (3, "12 34", 0, 0, 0, None, None, 5),
        (4, "le chat et le chien de la maison", 0, 0, 0, None, None, 5), (5, "le chien", 0, 0, 0, "en", "new.org", 5),
        (6, "on", 0, 0, 0, "", "a.www.fr.org", 5), (7, LONG, 0, 0, 0, "en", "www.en.org", 5)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("lid_kept", F.lit("other")).withColumn("post", F.lit(1))
    judged = language_id.judge(frame, declared=F.col("lang"), host=F.col("source"), suffix=F.col("source"))
    got = {r["doc_id"]: r for r in judged.collect()}
    assert judged.count() == len(rows) and set(judged.columns) == {*frame.columns, "lid_language", "lid_posterior", "lid_text_language"}
    assert [got[k]["lid_language"] for k in (1, 2, 3)] == ["und"] * 3 and not any(got[k]["lid_kept"] for k in (1, 2, 3))
    assert got[4]["lid_language"] == "fr" and got[100]["lid_kept"] and got[6]["lid_language"] in language_id.LANGUAGES
    empty = language_id.judge(docs(spark, []), declared=F.col("lang"), host=F.col("source"))
    assert empty.count() == 0


FOREIGN = ("我们昨天晚上在城里的一家小饭馆吃了晚饭。", "Вчера вечером мы ужинали в маленьком ресторане в центре города.",
           "Wczoraj wieczorem jedliśmy kolację w małej restauracji w centrum miasta.",
           "Söimme eilen illalla päivällistä pienessä ravintolassa kaupungin keskustassa.",
           "تناولنا العشاء مساء أمس في مطعم صغير وسط المدينة.", "xq zvkw jpbd qqgx fwzk vbnm kjhq zxcv wpqr tgbd hjkl")


def test_texts_that_fit_no_language_are_rejected(spark):
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source")
    more = [(-k, text * n, None, None) for k, (text, n) in enumerate([(t, n) for t in FOREIGN for n in (1, 30)], 1)]
    judged = language_id.judge(frame.unionByName(spark.createDataFrame(more, frame.schema)), declared=F.col("lang"), host=F.col("source"))
    got = {r["doc_id"]: r for r in judged.where("doc_id < 0").collect()}
    assert len(got) == len(more)
    assert {(r["lid_language"], r["lid_text_language"], r["lid_kept"]) for r in got.values()} == {("other", "other", False)}


def test_languages_come_from_the_declared_values(spark):
    texts = {"en": "the cat and the dog of the house", "pl": FOREIGN[2], "fi": FOREIGN[3]}
    rows = [(100 * k + n, t, 0, 0, 0, {"pl": "PL-pl"}.get(lang, lang), None, 5)
            for k, (lang, t) in enumerate(texts.items()) for n in range((60, 12, 30)[k])]
    rows += [(900 + n, "the cat", 0, 0, 0, ("unknown", "und", "sv")[n], None, 5) for n in range(3)]
    got = {r["doc_id"]: r for r in language_id.judge(spark.createDataFrame(rows, SCHEMA), declared=F.col("lang")).collect()}
    assert [(got[k]["lid_language"], got[k]["lid_kept"]) for k in (0, 100, 200, 902)] == [("en", True), ("pl", True), ("fi", True), ("en", True)]


def test_host_prior_decides_where_the_text_is_silent(spark):
    rows = [(k, "le chat et le chien de la maison", 0, 0, 0, "fr", "a.fr.org", 5) for k in range(40)]
    rows += [(100 + k, "the cat and the dog of the house", 0, 0, 0, "en", "b.org", 5) for k in range(40)]
    rows += [(500, "e", 0, 0, 0, None, "a.fr.org", 5), (501, "e", 0, 0, 0, None, "b.org", 5), (502, "e", 0, 0, 0, None, "c.fr.org", 5)]
    got = {r["doc_id"]: r["lid_language"] for r in language_id.judge(
        spark.createDataFrame(rows, SCHEMA), declared=F.col("lang"), host=F.col("source")).collect()}
    assert (got[500], got[501], got[502]) == ("fr", "en", "fr")


def plain_fusion(rows, model, languages, effective=60, smoothing=20.0):
    """Posteriors of rows (text, declared, suffix, host) by the same evidence, one row after the other."""
    def text_logs(text):
        codes = np.concatenate([np.empty(0, np.uint32), *language_id.grams(text.encode())])
        total = model[codes].sum(axis=0, dtype=np.float64) * min(1.0, effective / max(len(codes), 1))
        return total - total.max()

    def softmax(x):
        return np.exp(x - x.max()) / np.exp(x - x.max()).sum()

    def parent(host):
        return host.split(".", 1)[1] if host and host.count(".") >= 2 else None

    logs = [text_logs(r[0]) for r in rows]
    post = [softmax(x) for x in logs]
    mass = sum(post) + 1.0
    overall = mass / mass.sum()

    def sums(key):
        table = {}
        for k, p in zip(map(key, rows), post):
            if k is not None:
                n, s = table.get(k, (0, 0))
                table[k] = n + 1, s + p
        return table

    def likelihood(key):
        table = sums(key)
        return {k: np.log((s + 1.0) / (mass + len(table))) for k, (_, s) in table.items()}

    declared, suffix = likelihood(lambda r: r[1]), likelihood(lambda r: r[2])
    parents = {k: (s + smoothing * overall) / (n + smoothing) for k, (n, s) in sums(lambda r: parent(r[3])).items()}
    hosts = {k: np.log((s + smoothing * parents.get(parent(k), overall)) / (n + smoothing)) for k, (n, s) in sums(lambda r: r[3]).items()}
    return [softmax(x + declared.get(r[1], 0) + suffix.get(r[2], 0) + hosts.get(r[3], np.log(overall))) for r, x in zip(rows, logs)]


def test_evidence_is_fused_as_in_a_plain_version(spark):
    texts = {"en": "the cat and the dog of the house", "fr": "le chat et le chien de la maison", "es": "el gato y el perro de la casa"}
    suffixes = {"en": "org", "fr": "fr", "es": "es"}
    rows = [(k * 100 + n, text, lang if n % 3 else None, suffixes[lang] if n % 2 else "com", f"h{n % 4}.site{k}.{suffixes[lang]}")
            for k, (lang, text) in enumerate(texts.items()) for n in range(30)]
    # Texts that say next to nothing: the suffix, the host, or the hosts beside it decide.
    silent = [(900, "e", None, "fr", None), (901, "e", None, None, "h1.site2.es"), (902, "a", None, None, "new.site1.fr"), (903, "o", "es", None, None)]
    frame = spark.createDataFrame(rows + silent, "doc_id long, text string, lang string, suffix string, host string")
    asked = {"declared": F.col("lang"), "suffix": F.col("suffix"), "host": F.col("host")}
    clashing = frame.withColumns({"lid__e": F.lit("mine"), "LID___key_host": F.lit(1), "key": F.lit(2), "a.b": F.lit(3)})
    judged = language_id.judge(clashing, **asked).collect()
    declaring = language_id.declared_rows(frame, F.col("lang"), 10, 256)
    languages = (*declaring, language_id.OTHER)
    want = plain_fusion([r[1:] for r in rows + silent], language_id.train(frame, F.col("text"), F.col("lang"), declaring), languages)
    place = {r[0]: k for k, r in enumerate(rows + silent)}
    for r in judged:
        p = want[place[r["doc_id"]]]
        assert r["lid_language"] == languages[int(p.argmax())] and abs(r["lid_posterior"] - p.max()) < 1e-6
        assert (r["lid__e"], r["LID___key_host"], r["key"], r["a.b"]) == ("mine", 1, 2, 3)
    got = {r["doc_id"]: r["lid_language"] for r in judged}
    assert (got[900], got[901], got[902], got[903]) == ("fr", "es", "fr", "es")


def test_the_number_of_languages_is_bounded(spark):
    rows = [(k, "the cat and the dog of the house", 0, 0, 0, f"{chr(97 + k % 20)}q", None, 5) for k in range(400)]
    rows += [(1000 + k, "le chat et le chien de la maison", 0, 0, 0, "fr", None, 5) for k in range(50)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert language_id.declared_rows(frame, F.col("lang"), 10, 3) == {"aq": 20, "bq": 20, "fr": 50}
    judged = language_id.judge(frame, declared=F.col("lang"), most_languages=3)
    assert judged.where("doc_id >= 1000 and lid_language = 'fr'").count() == 50


def test_quality_of_odd_rows(spark):
    good = [(k, "a fine sentence about some quiet things, and more of them.") for k in range(60)]
    bad = [(100 + k, "%%% buy$$ now### |||| @@@ buy$$ now###") for k in range(60)]
    frame = docs(spark, good + bad + TEXTS).withColumn("quality_kept", F.lit("other"))
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, _ in good[:40]] + [(i, 0, 0) for i, _ in bad[:40]] + [(None, 1, 0), (150, None, 0), (151, 7, 0), (50, 0, 0), (50, 1, 0)],
        "doc_id long, quality int, toxic int")
    judged = quality.judge(frame, labels)
    got = {}
    for r in judged.collect():
        got.setdefault(r["doc_id"], r["quality_kept"])
    assert judged.count() == len(good + bad + TEXTS)
    assert all(got[i] for i, _ in good if i not in dict(TEXTS)) and not any(got[i] for i, _ in bad)
    often = quality.judge(frame.unionAll(frame.where("doc_id = 0").withColumn("doc_id", F.explode(F.array_repeat("doc_id", 30_000)))), labels)
    assert {r["quality_kept"] for r in often.where("doc_id between 100 and 139").collect()} == {False}
    nothing = quality.judge(frame, labels.limit(0))
    assert {(r["quality_score"], r["quality_kept"]) for r in nothing.collect()} == {(0.5, True)}
    assert quality.judge(frame.limit(0), labels).count() == 0


def plain_scores(rows, labels, rounds, per_round, sure):
    """Scores of rows (id, text, categories) by co-training written out: dictionaries of rows and plain loops."""
    def fit(x, y, ridge):
        w = np.zeros(x.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-x @ w))
            w = w + np.linalg.inv(x.T @ np.diag(p * (1 - p)) @ x + ridge * np.eye(len(w))) @ (x.T @ (y - p) - ridge * w)
        return w

    views = [{i: np.array(quality.measures(t)) for i, t, _ in rows}, {}]
    for i, _, places in rows:
        views[1][i] = np.zeros(2 * quality.CATEGORIES + quality.SIZES + 1)
        views[1][i][[*places, -1]] = 1
    known = sorted(labels)
    held, train, pool = known[::4], [i for k, i in enumerate(known) if k % 4], sorted(i for i, _, _ in rows if i not in labels)
    given = [{}, {}]
    share = np.mean([labels[i] for i in train])
    for turn in range(rounds + 1):
        fits = [fit(np.array([view[i] for i in [*train, *own]]), np.array([{**labels, **own}[i] for i in [*train, *own]]), 1.0)
                for view, own in zip(views, given)]
        if turn == rounds:
            break
        for k in (0, 1):
            free = [i for i in pool if i not in given[1 - k]]
            p = {i: 1 / (1 + np.exp(-views[k][i] @ fits[k])) for i in free}
            for value, least in ((1, share), (0, 1 - share)):
                order = sorted(free, key=lambda i: -p[i] if value else p[i])[:max(1, int(per_round * least))]
                given[1 - k].update({i: value for i in order if (p[i] if value else 1 - p[i]) >= sure})
    y = np.array([labels[i] for i in held], float)
    lines = [fit(np.array([[view[i] @ w, 1] for i in held]), y, 1e-2) for view, w in zip(views, fits)]
    both = lambda i: [view[i] @ w * a + b for view, w, (a, b) in zip(views, fits, lines)] + [1]
    last = fit(np.array([both(i) for i in held]), y, 1e-2)
    return {i: 1 / (1 + np.exp(-(np.array(both(i)) @ last))) for i, _, _ in rows}


def test_scores_are_those_of_a_plain_version(spark):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(240):
        words = rng.choice(["the", "house", "and", "river", "Tree", "4", "$$", "###", "buy!!", "|"], rng.integers(3, 40),
                           p=[.2, .2, .2, .15, .15, .02, .02, .02, .02, .02] if k % 3 else [.05, .05, .05, .05, .05, .05, .2, .2, .2, .1])
        rows.append((k, " ".join(words), 0, 0, 0, "en" if k % 2 else "fr", f"s{k % 5 + (0 if k % 3 else 3)}", len(words)))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = {k: int(k % 3 > 0) for k in range(0, 240, 4)}
    judged = quality.judge(frame, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"), per_round=0.1, rounds=4, sure=0.9)
    places = {r["doc_id"]: r["m"] for r in frame.select("doc_id", quality.metadata([F.col("lang"), F.col("source")], F.col("n_chars")).alias("m")).collect()}
    want = plain_scores([(r[0], r[1], places[r[0]]) for r in rows], labels, 4, int(0.1 * 180), 0.9)
    for r in judged.collect():
        assert abs(r["quality_score"] - want[r["doc_id"]]) < 1e-6


def test_the_pool_covers_rare_categories(spark, monkeypatch):
    rows = [(k, f"text {k}", 0, 0, 0, "en", "big" if k < 3000 else f"rare{k}", 5) for k in range(3040)]
    frame = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "cotrain", lambda content, meta, label, *more: seen.append((meta, label, more)))
    quality.judge(frame, labels, pool_each=40)
    meta, label, more = seen[0]
    sources = {tuple(np.flatnonzero(m[quality.CATEGORIES:2 * quality.CATEGORIES])) for m in meta}
    assert len(sources) > 30 and 60 <= (label < 0).sum() <= 200 and more[1] == max(1, int(0.1 * (label < 0).sum()))


def test_views_teach_each_other():
    """A view that knows most rows lets the other learn what its own few labels leave open."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 3000)
    a = np.c_[np.ones(3000), y + rng.normal(size=3000) * 0.1]
    b = np.c_[np.ones(3000), rng.normal(size=(3000, 40)) + y[:, None] * 0.5]
    label = np.where(np.arange(3000) < 40, y, -1)
    alone, taught = (quality.cotrain(a, b, label, rounds, 400, 0.9) for rounds in (0, 5))
    right = lambda m: ((b @ m.metadata > 0) == y).mean()
    assert right(taught) > right(alone)
    assert quality.cotrain(a, b, np.where(label == 1, -1, label), 3, 10, 0.9) is None


def test_packing_of_odd_rows(spark):
    rows = [(k, "w " * n) for k, n in enumerate([0, 1, 7, 8, 9, 16, 17, 40, 3, 3, 3, 5])] + [(90, None)]
    packed = packing.pack(docs(spark, rows), capacities=(4, 8, 16), shard_rows=5, overhead=1).collect()
    check_packed(packed, {i: len((t or "").split()) for i, t in rows}, (4, 8, 16))
    again = packing.pack(docs(spark, [(1, "a b"), (1, "a b"), (None, "a"), (1, "a b c")]), capacities=(4, 8)).collect()
    assert sorted((r["id"] or 0, r["n_tokens"]) for r in again) == [(0, 1), (1, 2), (1, 2), (1, 3)]
    assert packing.pack(docs(spark, [])).count() == 0


def test_rows_of_a_repeated_id_and_length_are_packed_each(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 4)
    for n in (1, 4, 5, 13):
        packed = packing.pack(docs(spark, [(1, "a b c")] * n + [(None, "a")] * n), capacities=(4, 8), shard_rows=6).collect()
        assert sorted((r["id"] or 0, r["n_tokens"]) for r in packed) == [(0, 1)] * n + [(1, 3)] * n


def test_url_filter_against_plain_pagerank(spark):
    link = '<a href="{0}">x</a><img src="//{0}/i.png">'.format
    pages = [
        (1, "http://Good.example.com/en?x#y", link("https://friend.org") + '<a href="/own">'), (2, "https://friend.org/a", link("HTTP://far.org/z")),
        (3, "http://bad.example.net/es/1", link("good.example.com")), (4, "https://fan.org", link("http://bad.example.net/es/")),
        (5, None, None), (6, "nothing", "<a href='http://x.org'>"), (7, "http://lone.org?q=/en/", None), (8, "ftp://www.example.com/en/", ""),
        (None, "http://bad.example.net/fr/", None), (2, "https://friend.org/a", link("HTTP://far.org/z")), (9, "http://a.net/fr", None)]
    frame = spark.createDataFrame([(i, u, h, 1, "t") for i, u, h in pages], "page_id long, url string, html string, host int, trust string")
    rows = url_filter.filter_urls(frame).collect()
    assert len(rows) == len(pages)
    got = {r["id"]: r for r in rows}
    edges = {("good.example.com", "friend.org"): 1, ("friend.org", "far.org"): 2, ("fan.org", "bad.example.net"): 1,
             ("bad.example.net", "good.example.com"): 1}
    # The images' addresses begin with // and a scheme, which is taken for a host.
    edges |= {("good.example.com", "https:"): 1, ("friend.org", "http:"): 2, ("fan.org", "http:"): 1}
    for host in ("good.example.com", "bad.example.net", "www.example.com"):
        owner = host.split(".", 1)[1]
        edges[(host, owner)] = edges[(owner, host)] = 1
    trust = plain_rank(edges, {"good.example.com": 1.0, "www.example.com": 1.0}, 300)
    for host in ("good.example.com", "friend.org"):
        assert got[{"good.example.com": 1, "friend.org": 2}[host]]["trust"] == pytest.approx(trust[host])
    assert got[2]["verdict"] == "allow" and got[4]["verdict"] == "block" and got[7]["verdict"] == "allow"
    assert got[4]["distrust"] > 0 and got[2]["trust"] > 0
    assert (got[1]["host"], got[1]["path"], got[1]["rule"]) == ("good.example.com", "/en", "com/")
    assert (got[7]["host"], got[7]["path"]) == ("lone.org", "") and (got[6]["host"], got[5]["path"]) == ("", "")
    assert got[3]["rule"] == "net/es/" and got[8]["rule"] == "www.example.com/en/" and got[9]["rule"] is None
    assert abs(sum(trust.values()) - 1) < 1e-9
    assert url_filter.filter_urls(frame.limit(0)).count() == 0


def plain_rank(edges, seeds, rounds, damping=0.85):
    out = {}
    for (a, _), w in edges.items():
        out[a] = out.get(a, 0) + w
    total = sum(seeds.values())
    seeds = {k: v / total for k, v in seeds.items()}
    rank = dict(seeds)
    for _ in range(rounds):
        new = {}
        for (a, b), w in edges.items():
            new[b] = new.get(b, 0) + rank.get(a, 0) * w / out[a]
        rest = 1 - damping * sum(new.values())
        rank = {k: damping * new.get(k, 0) + rest * seeds.get(k, 0) for k in {*new, *seeds}}
    return rank


@pytest.mark.parametrize("edges_per_task", [500_000, 2])
def test_propagation_is_personalised_pagerank(spark, edges_per_task):
    edges = {("a", "b"): 2, ("b", "c"): 1, ("b", "a"): 1, ("c", "a"): 3, ("a", "d"): 1}
    out, into = {}, {}
    for (a, b), w in edges.items():
        out[a], into[b] = out.get(a, 0) + w, into.get(b, 0) + w
    frame = spark.createDataFrame([(a, b, w / out[a], w / into[b]) for (a, b), w in edges.items()],
                                  "src string, dst string, forward double, backward double")
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("d", 0.0, 0.5), ("e", 0.5, 0.5)], "host string, good double, bad double")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.propagate(
        frame, seeds, 0.85, tolerance=1e-11 if edges_per_task > 2 else 1e-5, edges_per_task=edges_per_task).collect()}
    trust = plain_rank(edges, {"a": 1.0, "e": 0.5}, 300)
    distrust = plain_rank({(b, a): w for (a, b), w in edges.items()}, {"d": 0.5, "e": 0.5}, 300)
    for host in "abcde":
        assert got[host] == pytest.approx((trust.get(host, 0), distrust.get(host, 0)), abs=1e-9 if edges_per_task > 2 else 1e-4)


@pytest.mark.parametrize("edges_per_task", [500_000, 20])
def test_ranks_converge_along_chains(spark, edges_per_task):
    chain = [f"h{k}.org" for k in range(26)]
    edges = {(a, b): 1 for a, b in zip(chain, chain[1:])} | {("h3.org", "h1.org"): 2, ("h25.org", "far.net"): 1, ("far.net", "far2.net"): 1}
    frame = spark.createDataFrame(
        [(k, f"http://{a}/", f'<a href="//{b}">' * (w > 0)) for k, ((a, b), w) in enumerate(edges.items()) for _ in range(w)]
        + [(100, "http://far.net/es/", None), (101, "http://seed.com/", '<a href="//h5.org">'), (102, "http://far.net/es/", None)],
        "page_id long, url string, html string")
    edges[("seed.com", "h5.org")] = 1
    got = {r["id"]: r for r in url_filter.filter_urls(frame, edges_per_task=edges_per_task).collect()}
    by = {r["host"]: (r["trust"], r["distrust"]) for r in got.values()}
    trust = plain_rank(edges, {"seed.com": 1.0}, 400)
    into = {(b, a): w for (a, b), w in edges.items()}
    distrust = plain_rank(into, {"far.net": 1.0}, 400)
    assert sum(abs(by[h][0] - trust.get(h, 0)) + abs(by[h][1] - distrust.get(h, 0)) for h in by) < 1e-7
    assert by["h0.org"][1] > 0 and got[0]["verdict"] == "block" and by["h25.org"][0] > 0
    with pytest.raises(RuntimeError):
        url_filter.propagate(spark.createDataFrame([("a", "b", 1.0, 1.0), ("b", "a", 1.0, 1.0)], "src string, dst string, forward double, backward double"),
                             spark.createDataFrame([("a", 1.0, 1.0)], "host string, good double, bad double"), 0.85, most_rounds=16)


def test_the_last_host_of_a_long_chain_is_reached(spark):
    """Three hundred hosts, more than one run of rounds; the rank at the end is tiny, and decides."""
    chain = [f"h{k:03}.org" for k in range(300)]
    rows = [(k, f"http://{a}/", f'<a href="//{b}">') for k, (a, b) in enumerate(zip(chain, chain[1:]))]
    rows += [(900, "http://bad.net/es/", ""), (901, f"http://{chain[-1]}/", '<a href="//bad.net">'), (902, "http://alone.org", "")]
    got = {r["id"]: r["verdict"] for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == got[150] == got[901] == "block" and got[902] == "allow"


def test_a_very_long_page_gives_all_its_links(spark):
    page = "".join(f'<p>{"x" * 200}</p><a href="https://h{k % 50}.org/{k}">' for k in range(8000))
    rows = [(1, "http://seed.com/", page), (2, "http://h49.org/", None), (3, "http://h50.org/", "")]
    got = {r["id"]: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2]["trust"] > 0 == got[3]["trust"] and got[1]["verdict"] == "allow"


def test_functions_travel_with_the_job(tmp_path):
    """A task on a machine without the package can call what it is sent."""
    call = "import pickle, sys; print(pickle.load(sys.stdin.buffer)(b'aab', {b'a': 0, b'b': 1, b'ab': 2}))"
    environment = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", call], input=cloudpickle.dumps(byte_bpe.fold), cwd=tmp_path,
                          env=environment, capture_output=True, check=True)
    assert done.stdout.split() == [b"[0,", b"2]"]
