"""URL filters: rules for hosts and paths, and trust spread over the links between hosts.

Edges are hyperlinks between hosts (absolute or protocol-relative ``href`` and ``src``), weighted by the number
of pages that hold them, and both ways between a host and the next shorter domain, which belong to one owner.
Personalised PageRank carries trust from the hosts whose pages a rule allows along the edges; distrust goes from
the hosts whose pages a rule blocks against them. Rank that reaches a host without edges returns to the seeds.
Rounds go on until the last ``STEP`` of them raised the total of either rank by a share of ``tolerance`` at most
and reached no further host; what is missing then is less than that. An error is raised after ``most_rounds``.
A page without a rule is blocked if its host's distrust exceeds ``ratio`` times its trust by more than rounding
can, so that the order of a sum decides nothing; a host that neither reaches is allowed.

Edges and ranks stay in tables keyed by host and are summed within tasks before a shuffle; only totals reach the
driver. A graph that fits a task has all its rounds there. For a larger one, every few rounds the ranks are written to
the shared folder; rounds run in as many tasks as the number of edges asks for, and the edges of a host that has very
many are dealt to several of them.

A null url, or one without ``://``, has empty host and path and takes part in no edge; a null html has no links.
Null ids and repeated rows come out as they came in; a rule has no null part. Empty tables give no rows. Other
columns are neither read nor returned. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystream.llm.common import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block"))
ROUNDING = 1e-9
#: Rounds between two tests of convergence, and the change between these at which the ranks have converged.
STEP, TOLERANCE = 8, 1e-11
#: Edges that one task works on.
EDGES_PER_TASK = 500_000
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'<>\s]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule (host and path prefix, verdict) that fits, as a struct, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        domain, start = rule.split("/", 1)
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(f"/{start}"))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, forward, backward): the share of src's edges, and of dst's, that an edge has. Needs host and html."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1))).alias("dst"))
    links = links.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    hosts = pages.select("host").distinct()
    owner = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    owned = hosts.select("host", owner.alias("owner")).where("owner <> ''")
    both = owned.select(F.explode(F.array(F.struct(F.col("host").alias("src"), F.col("owner").alias("dst")),
                                          F.struct(F.col("owner").alias("src"), F.col("host").alias("dst")))).alias("e")).select("e.*")
    edges = links.where("src <> '' and dst <> '' and src <> dst").unionAll(both).groupBy("src", "dst").agg(F.count("*").alias("w"))
    edges = settle(edges, "edges")
    out = edges.groupBy("src").agg(F.sum("w").alias("out"))
    into = edges.groupBy("dst").agg(F.sum("w").alias("into"))
    return settle(edges.join(out, "src").join(into, "dst").select(
        "src", "dst", (F.col("w") / F.col("out")).alias("forward"), (F.col("w") / F.col("into")).alias("backward")), "edges")


def _small_steps(spark: SparkSession, tasks: int) -> SparkSession:
    """A session for many equal rounds: planned once a step, with joins of one kind and a fixed number of tasks."""
    own = spark.newSession()
    for name, value in (("adaptive.enabled", "false"), ("autoBroadcastJoinThreshold", "-1"), ("shuffle.partitions", str(tasks))):
        own.conf.set(f"spark.sql.{name}", value)
    return own


def _totals(ranks: DataFrame) -> list[float]:
    return [x or 0 for x in ranks.agg(
        F.sum("trust"), F.sum("distrust"), F.count_if(F.col("trust") > 0), F.count_if(F.col("distrust") > 0)).first()]


def _scaled(ranks: DataFrame, totals: list[float]) -> DataFrame:
    trust, distrust = (F.col(name) / (total or 1.0) for name, total in zip(("trust", "distrust"), totals))
    return ranks.select("host", trust.alias("trust"), distrust.alias("distrust"))


def _in_a_task(base: DataFrame, moves: DataFrame, damping: float, tolerance: float, most_rounds: int) -> DataFrame:
    """Ranks of a graph that fits one task: all rounds in one expression over arrays of its hosts.

    What is missing after k rounds is at most damping^(k + 1) / (1 - damping) of the seeds' rank, which gives the
    rounds; they are run again while the last one reached further hosts.
    """
    rounds = max(1, math.ceil(math.log(tolerance * (1 - damping)) / math.log(damping))) if damping else 1
    hosts = base.withColumn("i", F.row_number().over(Window.orderBy("host")) - 1)
    into = moves.join(hosts.select(F.col("host").alias("at"), "i"), "at").groupBy(F.col("to").alias("host")).agg(
        F.sort_array(F.collect_list(F.struct(
            "i", (damping * F.col("forward")).alias("f"), (damping * F.col("backward")).alias("b")))).alias("into"))
    state = hosts.join(into, "host", "left").select(
        "i", "host", F.col("trust").alias("good"), F.col("distrust").alias("bad"),
        F.coalesce("into", F.array().cast(into.schema["into"].dataType)).alias("into"), "trust", "distrust")

    def step(ranks: Column) -> Column:
        def got(host: Column, weight: str, rank: str) -> Column:
            return F.aggregate(host["into"], F.lit(0.0), lambda a, e: a + e[weight] * F.get(ranks, e["i"])[rank])

        return F.transform("g", lambda h: F.struct(
            (h["good"] + got(h, "f", "trust")).alias("trust"), (h["bad"] + got(h, "b", "distrust")).alias("distrust")))

    for _ in range(rounds, most_rounds + 1, rounds):
        whole = state.agg(F.sort_array(F.collect_list(F.struct("i", "host", "good", "bad", "into", "trust", "distrust"))).alias("g"))
        run = F.aggregate(
            F.sequence(F.lit(1), F.lit(rounds)), F.transform("g", lambda h: F.struct(h["trust"], h["distrust"])),
            lambda ranks, _: step(ranks), lambda ranks: F.struct(ranks.alias("ranks"), step(ranks).alias("more")))
        done = whole.withColumn("run", run).select(F.inline(F.transform("g", lambda h, k: F.struct(
            h["i"].alias("i"), h["host"].alias("host"), h["good"].alias("good"), h["bad"].alias("bad"), h["into"].alias("into"),
            F.get("run.ranks", k)["trust"].alias("trust"), F.get("run.ranks", k)["distrust"].alias("distrust"),
            F.get("run.more", k)["trust"].alias("trust_after"), F.get("run.more", k)["distrust"].alias("distrust_after")))))
        state = settle(done, "ranks")
        totals = _totals(state)
        if totals[2:] == _totals(state.select(F.col("trust_after").alias("trust"), F.col("distrust_after").alias("distrust")))[2:]:
            return _scaled(state, totals)
    raise RuntimeError(f"ranks have not converged in {most_rounds} rounds")


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, tolerance: float = TOLERANCE, most_rounds: int = 10_000,
              edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(host, trust, distrust) of personalised PageRank from seeds (host, good, bad), converged.

    A graph of up to ``edges_per_task`` edges, both ways counted, has all its rounds in one task. Else each round is a join
    and a grouping; the edges of a host that has more than that are dealt to several tasks, and its rank is sent to each of
    these.
    """
    if not 0 <= damping < 1:
        raise ValueError("damping must be at least 0 and below 1")
    spark, none = edges.sparkSession, F.lit(0.0)
    nodes = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct().join(seeds, "host", "full_outer")
    sums = seeds.agg(F.sum("good"), F.sum("bad")).first()
    good, bad = ((F.coalesce(name, F.lit(0.0)) / (total or 1.0)) for name, total in zip(("good", "bad"), sums))
    both = edges.select(F.col("src").alias("at"), F.col("dst").alias("to"), "forward", none.alias("backward")).unionAll(
        edges.select("dst", "src", none, "backward"))
    total = 2 * edges.count()
    if total + seeds.count() <= edges_per_task:
        return _in_a_task(nodes.select("host", good.alias("trust"), bad.alias("distrust")), both, damping, tolerance, most_rounds)
    hubs = settle(both.groupBy("at").agg(F.count("*").alias("n")).where(F.col("n") > edges_per_task).select(
        F.col("at").alias("host"), F.ceil(F.col("n") / edges_per_task).cast("int").alias("parts")), "hubs")
    tasks = max(1, math.ceil(total / edges_per_task))
    own = _small_steps(spark, tasks)
    parts = F.coalesce("parts", F.lit(1)).alias("parts")
    # As many files as tasks: they are read in every round.
    base = settle(nodes.join(hubs, "host", "left").select("host", good.alias("trust"), bad.alias("distrust"), parts).repartition(
        tasks, "host"), "seeds", own)
    part = F.pmod(F.xxhash64("to"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    moves = settle(both.join(hubs.withColumnRenamed("host", "at"), "at", "left").select(
        "at", "to", "forward", "backward", part).repartition(tasks, "at", "part"), "moves", own)

    def moved(ranks: DataFrame) -> DataFrame:
        sent = ranks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return sent.hint("shuffle_hash").join(moves, (F.col("host") == F.col("at")) & (sent["part"] == moves["part"])).select(
            F.col("to").alias("host"), (damping * F.col("trust") * F.col("forward")).alias("trust"),
            (damping * F.col("distrust") * F.col("backward")).alias("distrust"), F.lit(1).alias("parts"))

    def added(ranks: DataFrame) -> DataFrame:
        return ranks.groupBy("host").agg(
            F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"), F.max("parts").alias("parts"))

    # What returns to the seeds only scales the converged ranks, so they are summed up without it and scaled to 1 at last.
    ranks, before = base, _totals(base)
    for _ in range(0, most_rounds, STEP):
        for _ in range(STEP):
            ranks = added(moved(ranks).unionAll(base))
        ranks = settle(ranks, "ranks")
        now = _totals(ranks)
        if now[2:] == before[2:] and all(x - y <= tolerance * x for x, y in zip(now[:2], before[:2])):
            return settle(_scaled(ranks, now), "ranks", spark)
        before = now
    raise RuntimeError(f"ranks have not converged in {most_rounds} rounds")


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                rules: tuple[tuple[str, str], ...] = RULES, damping: float = 0.85, ratio: float = 1.0,
                edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, trust and distrust of the host."""
    url = F.col(url_col).cast("string")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
        F.col(html_col).cast("string").alias("html"))
    ruled = rows.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    seeds = ruled.where("host <> ''").groupBy("host").agg(
        F.avg(F.col("fit.verdict").eqNullSafe("allow").cast("double")).alias("good"),
        F.avg(F.col("fit.verdict").eqNullSafe("block").cast("double")).alias("bad"))
    seeds = settle(seeds, "seeds")
    ranks = propagate(host_edges(rows), seeds, damping, edges_per_task=edges_per_task)
    judged = F.when(
        F.coalesce("distrust", F.lit(0.0)) > ratio * (1 + ROUNDING) * F.coalesce("trust", F.lit(0.0)), "block").otherwise("allow")
    return ruled.drop("html").join(ranks, "host", "left").select(
        "id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", judged).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
