"""Clean-up and policy check over a table of SQL text that a program wrote. Nothing is executed.

Input ``(request_id, text)``, one row per request. All steps are expressions on a row: no shuffle, and
a request is judged without bringing its statements together again.

The check does what its rules say and no more: a ``;`` inside a quoted text splits, a line comment
swallows the statement after it, and a mention of the allowed procedure lets a statement pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream import fixed_values as fixed
from tallystream.functions.text import replace_literal, strip, strip_part

KEPT, BLOCKED = "kept", "blocked"


@dataclass(frozen=True)
class GuardRules:
    """Texts to remove, texts to rewrite (in this order), and the procedures to block or let pass."""

    fences: list[str] = field(default_factory=lambda: list(fixed.FENCES))
    rewrites: list[tuple[str, str]] = field(default_factory=lambda: list(fixed.REWRITES))
    system_prefix: str = fixed.SYSTEM_PREFIX
    allowed_procedure: str = fixed.ALLOWED_PROCEDURE


DEFAULT_RULES = GuardRules()


def cleaned(text: Column, rules: GuardRules = DEFAULT_RULES) -> Column:
    """Text without fences and outer white space, on one line, with the rewrites made."""
    for fence in rules.fences:
        text = replace_literal(text, fence, "")
    text = replace_literal(strip(text), "\n", " ")
    for search, replacement in rules.rewrites:
        text = replace_literal(text, search, replacement)
    return text


def is_blocked(statement: Column, rules: GuardRules = DEFAULT_RULES) -> Column:
    lowered = F.lower(statement)
    return lowered.contains(rules.system_prefix) & ~lowered.contains(rules.allowed_procedure)


def clean(requests: DataFrame, rules: GuardRules = DEFAULT_RULES) -> DataFrame:
    return requests.select("request_id", cleaned(F.col("text"), rules).alias("text"))


def split(requests: DataFrame, rules: GuardRules = DEFAULT_RULES) -> DataFrame:
    """One row per statement that is not blank; ``pos`` counts the parts of the text from 0."""
    parts = clean(requests, rules).select("request_id", F.posexplode(F.split("text", ";")).alias("pos", "part"))
    return parts.select("request_id", "pos", strip(F.col("part")).alias("statement")).where(F.col("statement") != "")


def guard(requests: DataFrame, rules: GuardRules = DEFAULT_RULES) -> DataFrame:
    """Statements with the verdict on each."""
    verdict = F.when(is_blocked(F.col("statement"), rules), F.lit(BLOCKED)).otherwise(F.lit(KEPT))
    return split(requests, rules).withColumn("verdict", verdict)


def outcome(requests: DataFrame, rules: GuardRules = DEFAULT_RULES) -> DataFrame:
    """Per request, the statements kept and blocked, and whether anything is left to run."""
    statements = F.filter(F.transform(F.split("text", ";"), strip_part), lambda s: s != "")
    judged = F.transform(statements, lambda s: is_blocked(s, rules))
    # Two uses of the cleaned text keep the clean-up a step of its own, which Spark then compiles;
    # inside the array functions it would be interpreted, piece by piece.
    counted = (clean(requests, rules)
               .select("request_id", F.when(F.col("text").isNotNull(), judged).otherwise(F.array()).alias("judged"))
               .select("request_id", F.size("judged").alias("n"),
                       F.size(F.filter("judged", lambda blocked: blocked)).alias("n_blocked")))
    return counted.select(
        "request_id",
        (F.col("n") - F.col("n_blocked")).alias("n_kept"), "n_blocked",
        F.when(F.col("n") == F.col("n_blocked"), F.lit("no_valid")).otherwise(F.lit("runnable")).alias("outcome"))
