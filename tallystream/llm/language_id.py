"""Language ID by Bayesian fusion of evidence.

Four kinds of evidence are multiplied: the likelihood of the text's byte trigrams, the declared markup language,
the address suffix, and the host's prior. The trigram model is trained on about ``sample_rows`` rows, as
many of each language as far as there are, chosen by the hash of the whole row so that copies of a text are not chosen
together, with their declared language as a noisy label. The languages are those that ``least_rows`` rows or more
declare, counted over all rows; of a tag like en-US the first part counts. A trigram that a language has not shown is
as likely in each. Beside them stands the class ``other``, to which all trigrams are equally likely: it is the
best for texts that fit none of the languages. Declared languages and suffixes are counted over all rows
against what the texts say, which gives P(declared | language); host priors are counted likewise and smoothed
towards the host's parent domain, and that towards all rows. Counts are added up within tasks, so a hot host
is one row per task after it; the tables are joined back by key, and adaptive execution broadcasts small ones.

Rows without any letter have language ``und``. A row is rejected if it is ``und`` or ``other`` or if the best language's
posterior is below ``least``. Null or empty texts have no letters. Null declared languages, suffixes and hosts
are no evidence. Null ids and repeated rows come out as they came in. Empty tables give no rows. All other
columns stay; ``judge`` adds its columns under the given prefix, in place of any that have these names already.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.common import settle

#: Taken where no row declares a language.
LANGUAGES = ("de", "en", "es", "fr")
OTHER, NO_LANGUAGE = "other", ("mis", "mul", "und", "xx", "zxx")
#: The least share of a language's trigrams that are taken to be ones it has not shown.
UNSEEN = 0.01
BUCKETS, BYTES_AT_ONCE = 1 << 15, 1 << 20
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SPACES = bytes(range(65)) + bytes(range(91, 97)) + bytes(range(123, 128))


def grams(text: bytes):
    """Hashed byte trigrams of a text in bounded pieces; letters are lowered, all else is a space."""
    folded = np.frombuffer(text.translate(_FOLD), np.uint8)
    for k in range(0, max(0, len(folded) - 2), BYTES_AT_ONCE):
        part = folded[k:k + BYTES_AT_ONCE + 2].astype(np.uint32)
        code = part[:-2] << 16 | part[1:-1] << 8 | part[2:]
        code = code[code != 0x202020]
        yield (code * np.uint32(2654435761)) >> np.uint32(17)


def letters(text: bytes) -> int:
    return len(text.translate(None, _SPACES))


def tag_of(declared: Column) -> Column:
    """The language of a declared value, null if it names none."""
    tag = F.nullif(F.regexp_extract(declared.cast("string"), r"^\s*([a-z]{2,3})(?:[-_].*)?\s*$", 1), F.lit(""))
    return F.when(~tag.isin(*NO_LANGUAGE), tag)


def declared_rows(docs: DataFrame, declared: Column, least_rows: int, most_languages: int) -> dict[str, int]:
    """The languages that enough rows declare, in order, with their numbers of rows; of very many the most declared."""
    counted = docs.select(tag_of(declared).alias("tag")).where("tag is not null").groupBy("tag").count()
    first = counted.where(F.col("count") >= least_rows).orderBy(F.col("count").desc(), "tag").limit(most_languages)
    return {r["tag"]: r["count"] for r in sorted(first.collect())}


def train(docs: DataFrame, text: Column, declared: Column, declaring: dict[str, int], sample_rows: int = 20_000) -> np.ndarray:
    """Log-likelihoods (bucket, language) of trigrams from rows that declare a language; the last column is ``other``."""
    languages = tuple(declaring)
    whole = [docs[f"`{name}`"] for name, kind in docs.dtypes if not any(k in kind for k in ("map<", "variant"))]
    labelled = docs.select(text.cast("string").alias("text"), tag_of(declared).alias("declared"), F.xxhash64(*whole).alias("mark")).where(
        F.col("declared").isin(*languages) & F.col("text").isNotNull())
    each = sample_rows / max(1, len(languages))
    most = F.create_map(*[F.lit(x) for name, n in declaring.items() for x in (name, int(min(1.0, each / max(n, 1)) * (1 << 30)))])
    share = F.pmod(F.col("mark"), F.lit(1 << 30)) < most[F.col("declared")]

    def count(batches):
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            for value, language in zip(batch["text"], batch["declared"]):
                for codes in grams(value.encode()):
                    counts[languages.index(language)] += np.bincount(codes, minlength=BUCKETS)
        at = np.nonzero(counts)
        yield pd.DataFrame({"language": at[0], "bucket": at[1], "n": counts[at]})

    counted = labelled.where(share).select("text", "declared").mapInPandas(count, "language int, bucket int, n long")
    rows = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BUCKETS, len(languages)))
    counts[rows["bucket"], rows["language"]] += rows["n"]
    # The share of trigrams seen once tells how many are still to come (Good-Turing).
    unseen = max(UNSEEN, (counts == 1).sum() / max(1.0, counts.sum()))
    shown = (1 - unseen) * counts / np.maximum(1.0, counts.sum(axis=0)) + unseen / BUCKETS
    return np.log(np.c_[shown, np.full(BUCKETS, 1 / BUCKETS)]).astype(np.float32)


def text_evidence(model: np.ndarray, effective: int):
    """A function on texts: letters, then the log-likelihood of each language.

    Neighbouring trigrams are not independent, so a text counts as ``effective`` trigrams at most.
    """
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for value in texts:
            data = value.encode() if value else b""
            total, n = np.zeros(model.shape[1]), 0
            for codes in grams(data):
                total += model[codes].sum(axis=0, dtype=np.float64)
                n += len(codes)
            total *= min(1.0, effective / max(n, 1))
            out.append([float(letters(data)), *(total - total.max())])
        return pd.Series(out)
    return of


def _log_table(rows: DataFrame, key: str, languages: tuple[str, ...]) -> DataFrame:
    """(key, n, sums): posterior mass of each language over the rows of a key."""
    sums = [F.sum(F.get("post", F.lit(k))).alias(f"s{k}") for k in range(len(languages))]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), *sums).select(
        F.col(key).alias("key"), "n", F.array(*[f"s{k}" for k in range(len(languages))]).alias("sums"))


def _softmax(logs: Column) -> Column:
    powers = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def parent_of(host: Column) -> Column:
    """The host without its first label, where two labels are left at least."""
    found = F.regexp_extract(host, r"^[^.]+\.([^.]+\..+)$", 1)
    return F.when(found != "", found)


def judge(docs: DataFrame, text_col: str = "text", declared: Column | None = None, suffix: Column | None = None,
          host: Column | None = None, languages: tuple[str, ...] | None = None, least: float = 0.5, effective: int = 60,
          smoothing: float = 20.0, prefix: str = "lid_", least_rows: int = 10, most_languages: int = 256) -> DataFrame:
    """The rows with language, posterior, text_language and kept added, named with the prefix.

    ``languages`` names the languages, where not all that the rows declare are wanted. ``most_languages`` bounds the
    model, which each task holds whole: junk in place of languages cannot make it grow. Texts in languages beyond that
    fit none of the others and come out as ``other``. Columns of the caller with the names of those added are
    replaced; all others stay as they are, whatever their names.
    The texts are read twice, for the counts and for the result, and never shuffled unless a table of hosts is
    too large to broadcast.
    """
    none = F.lit(None).cast("string")
    parts = {"declared": declared, "suffix": suffix, "host": host}
    parts = {k: F.nullif(F.lower(v.cast("string")), F.lit("")) if v is not None else none for k, v in parts.items()}
    declaring = declared_rows(docs, parts["declared"], 1 if languages else least_rows, most_languages)
    if languages or not declaring:
        declaring = {name: declaring.get(name, 0) for name in languages or LANGUAGES}
    model = train(docs, F.col(text_col), parts["declared"], declaring)
    languages = (*declaring, OTHER)
    evidence = text_evidence(model, effective)(F.col(text_col).cast("string"))
    # Written before it is filtered: a filter on the evidence would have it worked out twice.
    scored = settle(docs.select(evidence.alias("e"), *[v.alias(k) for k, v in parts.items()]), "evidence")
    scored = scored.where(F.get("e", F.lit(0)) > 0).select(
        "declared", "suffix", "host", parent_of(F.col("host")).alias("parent"), _softmax(F.slice("e", 2, len(languages))).alias("post"))
    total = scored.agg(*[F.sum(F.get("post", F.lit(k))) for k in range(len(languages))]).first()
    mass = [(x or 0.0) + 1.0 for x in total]
    overall = F.lit([x / sum(mass) for x in mass])

    def likelihood(key: str) -> DataFrame:
        table = _log_table(scored, key, languages)
        kinds = max(1, table.count())
        return table.select("key", F.transform("sums", lambda x, k: F.log((x + 1.0) / (F.get(F.lit(mass), k) + kinds))).alias("logs"))

    def pulled(table: DataFrame, towards: Column) -> Column:
        return F.transform("sums", lambda x, k: (x + smoothing * F.get(towards, k)) / (F.col("n") + smoothing))

    parents = _log_table(scored, "parent", languages)
    parents = parents.select(F.col("key").alias("parent"), pulled(parents, overall).alias("p"))
    hosts = _log_table(scored, "host", languages).withColumn("parent", parent_of(F.col("key"))).join(parents, "parent", "left")
    hosts = hosts.select("key", F.transform(pulled(hosts, F.coalesce("p", overall)), lambda x: F.log(x)).alias("logs"))
    names = {"declared": likelihood("declared"), "suffix": likelihood("suffix"), "host": hosts}
    flat = F.array_repeat(F.lit(0.0), len(languages))
    added = ("language", "posterior", "text_language", "kept")
    kept_columns = [c for c in docs.columns if c not in {f"{prefix}{name}" for name in added}]
    inner = f"{prefix}_"
    while any(c.lower().startswith(inner.lower()) for c in docs.columns):
        inner += "_"
    rows = docs.withColumns({f"{inner}e": evidence, **{f"{inner}{k}": v for k, v in parts.items()}})
    for k, table in names.items():
        table = settle(table.select(F.col("key").alias(f"{inner}key_{k}"), F.col("logs").alias(f"{inner}logs_{k}")), k)
        rows = rows.join(table, F.col(f"{inner}{k}") == F.col(f"{inner}key_{k}"), "left")
    prior = F.coalesce(F.col(f"{inner}logs_host"), F.transform(overall, lambda x: F.log(x)))
    logs = F.slice(f"{inner}e", 2, len(languages))
    for more in (F.coalesce(f"{inner}logs_declared", flat), F.coalesce(f"{inner}logs_suffix", flat), prior):
        logs = F.zip_with(logs, more, lambda a, b: a + b)
    rows = rows.withColumn(f"{inner}post", _softmax(logs))

    def best(of: Column) -> Column:
        return F.get(F.lit(list(languages)), F.array_position(of, F.array_max(of)).cast("int") - 1)

    known = F.get(f"{inner}e", F.lit(0)) > 0
    posterior = F.when(known, F.array_max(f"{inner}post")).otherwise(F.lit(0.0))
    language = F.when(known, best(F.col(f"{inner}post"))).otherwise("und")
    return rows.select(
        *[F.col("`" + c.replace("`", "``") + "`") for c in kept_columns],
        language.alias(f"{prefix}language"),
        posterior.alias(f"{prefix}posterior"),
        F.when(known, best(F.slice(f"{inner}e", 2, len(languages)))).otherwise("und").alias(f"{prefix}text_language"),
        ((posterior >= least) & (language != OTHER)).alias(f"{prefix}kept"))
