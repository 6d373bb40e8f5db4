"""URL filter by trust and distrust over the host link graph.

Rules judge a url by its host and path, the longest fitting rule wins.  Where no rule fits, the host's place in the
link graph decides: trust is personalised PageRank from the hosts of allowed pages along the links, distrust is
personalised PageRank from the hosts of blocked pages against the links (who links to blocked hosts
inherits).  Both are compared with what a host of its place has anyway: the same propagation from all hosts with pages
alike, however many they have.  A host's
relative distrust is its share of all distrust over its share of that usual score, likewise its relative trust.  With
the usual as a third part, suspicion is relative distrust / (1 + relative trust + relative distrust): a trace of
distrust is little suspicion even where there is no trust.  A host above ``threshold`` is blocked.

The threshold is calibrated on hosts with rule pages: a fifth of the hosts (by hash) lends no seeds to a second pair
of scores, and the threshold is taken that tells their blocked from their allowed pages best (the mean of the two
shares recovered; nearest to a third if several do; a third, which is half the usual distrust and no trust, if the held-out
hosts lack one kind).

Host edges: the links of a host's pages to other hosts (a host's links to itself, as all relative ones, say nothing of
its standing), and, as tables may hold few links between hosts, a weak edge between a host and its parent domain, up
to the name below the top level.  Link targets and parent domains without pages are nodes too (seed 0, no verdict), so
that siblings meet at their parent.  A top-level domain joins unrelated sites: it is a parent only if it has pages
itself; numeric addresses have no parent.

Definitions: a null url or one without ``://`` has empty host and path and no part in the graph, and is allowed
unless a rule fits; null html has no links; repeated rows count each; pages without rule on hosts that
distrust reaches less than usual are allowed; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow.llm.common import written

#: (action, host, path) rules that op7 judges by.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Scores: their seeds' column and whether they run along the links.
SIDES = {"trust": ("trusted", True), "distrust": ("blocked", False)}
ALL_SIDES = SIDES | {"usual_along": ("site", True), "usual_against": ("site", False), "trust_held": ("trusted_kept", True), "distrust_held": ("blocked_kept", False)}
#: Rounds in one written table, one host of how many is held out, thresholds tried (in hundredths).
STEPS, HELD_OUT, GRID = 5, 5, range(5, 100, 5)
UNCALIBRATED = 1 / 3
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def host_of(url):
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule (like ``net/``, null if none fits) and action.

    The rules are few and known when the plan is built: they become one ordered CASE, longest first.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    host, path = F.col("host"), F.col("path")
    rule = action = None
    for verdict, h, p in ordered:
        fits = (host != "") & ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.lit(h + p)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        action = F.when(fits, F.lit(verdict)) if action is None else action.when(fits, F.lit(verdict))
    none = F.lit(None).cast("string")
    out = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return out.withColumn("rule", none if rule is None else rule).withColumn("action", none if action is None else action)


def family_edges(names: DataFrame, known: DataFrame) -> DataFrame:
    """(child, parent) for each host of ``names`` and each of its parent domains; both have a column host."""
    parts = F.split("host", r"\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    pairs = (names.filter(~F.col("host").rlike(r"(^|\.)[0-9]+(:[0-9]*)?$")).select(chain.alias("c"))
             .select(F.explode(F.expr("transform(sequence(1, size(c)), i -> struct(c[i - 1] AS child, get(c, i) AS parent))")).alias("x"))
             .select("x.child", "x.parent").filter("child <> '' and parent <> ''").distinct())
    ends = known.select(F.col("host").alias("v"), F.lit(True).alias("has_pages"))
    return (pairs.join(ends, F.col("parent") == F.col("v"), "left")
            .filter(F.col("parent").rlike(r"[^.]\.[^.]") | F.col("has_pages")).select("child", "parent"))


def host_edges(pages: DataFrame, family_weight: float = 0.1) -> DataFrame:
    """(u, v, w) between hosts, with or without pages; w counts links.  ``pages`` has host and html."""
    links = (pages.filter("host <> ''").select("host", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), F.lit(1))).alias("to"))
             .select("host", F.when(F.col("to").contains("://"), host_of(F.col("to")))
                     .when(F.col("to").startswith("//"), host_of(F.concat(F.lit("x:"), F.col("to"))))
                     .otherwise("").alias("to"))
             .filter("to <> '' and to <> host").groupBy(F.col("host").alias("u"), F.col("to").alias("v")).agg(F.count(F.lit(1)).cast("double").alias("w")))
    links = written(links, "host-links")
    known = pages.filter("host <> ''").select("host").distinct()
    family = family_edges(known.union(links.select("v")).distinct(), known)
    weak = F.lit(family_weight)
    return links.union(family.select(F.col("child").alias("u"), F.col("parent").alias("v"), weak.alias("w"))) \
        .union(family.select(F.col("parent").alias("u"), F.col("child").alias("v"), weak.alias("w"))) \
        .groupBy("u", "v").agg(F.sum("w").alias("w"))


def propagate(hosts: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-3, sides: dict = SIDES) -> DataFrame:
    """host and a score for each side: personalised PageRanks, all in one pass per round.

    ``sides`` names for each score the column of ``hosts`` with its seeds' weights and whether it runs along the edges
    or against them; an edge appears once in each direction, with the share of its start's weight.  Mass at hosts
    without edges of that direction goes back to the seeds: that only scales a side, so it is left out in the rounds and
    each side is scaled to its seeds' total at the end.  A round's share of the result falls by ``damping``, so the number
    of rounds follows from ``tolerance``; STEPS of them make one written table.
    """
    forward = edges.select(F.lit(True).alias("along"), "u", "v", "w")
    backward = edges.select(F.lit(False).alias("along"), F.col("v").alias("u"), F.col("u").alias("v"), "w")
    both = forward.union(backward)
    out = both.groupBy("along", "u").agg(F.sum("w").alias("total")).select(F.col("along").alias("a2"), F.col("u").alias("u2"), "total")
    arcs = written(both.join(out, (F.col("along") == F.col("a2")) & (F.col("u") == F.col("u2")))
                   .select("along", "u", "v", (F.col("w") / F.col("total")).alias("share")), "trust-arcs")
    cells = F.explode(F.array(*[F.struct(F.lit(name).alias("side"), F.lit(along).alias("along"), F.col(column).cast("double").alias("seed"))
                                for name, (column, along) in sides.items()]))
    state = written(hosts.select("host", cells.alias("x")).select("host", "x.*").withColumn("score", (1 - damping) * F.col("seed")), "trust-round")
    rounds = max(1, math.ceil(math.log(tolerance) / math.log(damping)))
    for done in range(0, rounds, STEPS):
        for _ in range(min(STEPS, rounds - done)):
            came = (state.filter("score > 0").select("along", "side", F.col("host").alias("u"), "score").join(arcs, ["along", "u"])
                    .groupBy("side", F.col("v").alias("host")).agg(F.sum(F.col("score") * F.col("share")).alias("came")))
            fresh = (1 - damping) * F.col("seed") + damping * F.coalesce("came", F.lit(0.0))
            state = state.join(came, ["side", "host"], "left").select("host", "side", "along", "seed", fresh.alias("score"))
        state = written(state, "trust-round")
    totals = state.groupBy("side").agg((F.sum("seed") / F.nullif(F.sum("score"), F.lit(0.0))).alias("scale"))  # one row for each side
    scaled = state.join(F.broadcast(totals), "side")
    return scaled.groupBy("host").agg(*[F.coalesce(F.sum(F.when(F.col("side") == name, F.col("score") * F.col("scale"))), F.lit(0.0)).alias(name) for name in sides])


def _suspicion(trust: str, distrust: str, totals: dict):
    """Suspicion of a host, from 0 to below 1; sides without seeds count as none."""
    def relative(side, usual):
        part = F.col(side) / F.lit(totals[side] or 1.0)
        return F.coalesce(part / F.nullif(F.col(usual) / F.lit(totals[usual] or 1.0), F.lit(0.0)), F.lit(0.0))
    good, bad = relative(trust, "usual_along"), relative(distrust, "usual_against")
    return bad / (1.0 + good + bad)


def calibrated(scores: DataFrame, totals: dict) -> tuple[float, float | None]:
    """(threshold, share of held-out rule pages told right at it, mean of both kinds) from the second pair of scores."""
    held_out = scores.filter("held").select("trusted", "blocked", _suspicion("trust_held", "distrust_held", totals).alias("x"))
    row = held_out.agg(F.sum("trusted").alias("t"), F.sum("blocked").alias("b"),
                       *[F.sum(F.when(F.col("x") > g / 100, F.col("blocked")).otherwise(0)).alias(f"b{g}") for g in GRID],
                       *[F.sum(F.when(F.col("x") <= g / 100, F.col("trusted")).otherwise(0)).alias(f"t{g}") for g in GRID]).first()
    if not row["t"] or not row["b"]:
        return UNCALIBRATED, None
    right = {g: (row[f"b{g}"] / row["b"] + row[f"t{g}"] / row["t"]) / 2 for g in GRID}
    best = max(GRID, key=lambda g: (right[g], -abs(g / 100 - UNCALIBRATED), -g))
    return best / 100, right[best]


def host_scores(pages: DataFrame, rules=RULES, damping: float = 0.85, tolerance: float = 1e-2) -> tuple[DataFrame, dict]:
    """(written table of the graph's hosts with seeds and scores, totals of each side's seeds); ``pages`` is ``judged``."""
    counts = [F.count_if(F.col("action") == "allow").alias("trusted"), F.count_if(F.col("action") == "block").alias("blocked"), F.count(F.lit(1)).alias("pages")]
    hosts = written(pages.filter("host <> ''").groupBy("host").agg(*counts), "hosts")
    edges = written(host_edges(pages), "host-edges")
    zero = F.lit(0).cast("long")
    ends = edges.select(F.explode(F.array("u", "v")).alias("host"), zero.alias("trusted"), zero.alias("blocked"), zero.alias("pages"))
    held_out = F.crc32(F.encode("host", "UTF-8")) % HELD_OUT == 0
    nodes = written(hosts.union(ends).groupBy("host").agg(F.sum("trusted").alias("trusted"), F.sum("blocked").alias("blocked"), F.sum("pages").alias("pages"))
                    .withColumn("site", (F.col("pages") > 0).cast("int")).withColumn("held", held_out).withColumn("trusted_kept", F.when(held_out, 0).otherwise(F.col("trusted")))
                    .withColumn("blocked_kept", F.when(held_out, 0).otherwise(F.col("blocked"))), "host-nodes")
    columns = {c for c, _ in ALL_SIDES.values()}
    sums = nodes.agg(*[F.sum(c).alias(c) for c in columns]).first()
    totals = {name: float(sums[c] or 0) for name, (c, _) in ALL_SIDES.items()}
    return written(nodes.join(propagate(nodes, edges, damping, tolerance, ALL_SIDES), "host"), "host-scores"), totals


def filter_urls(pages: DataFrame, rules=RULES, threshold: float | None = None, damping: float = 0.85, tolerance: float = 1e-2) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust, suspicion for every page; ``threshold`` None is calibrated."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    marked = judged(rows, rules)
    scores, totals = host_scores(marked, rules, damping, tolerance)
    if threshold is None:
        threshold, _ = calibrated(scores, totals)
    suspicion = _suspicion("trust", "distrust", totals)
    verdicts = scores.filter("pages > 0").select(F.col("host").alias("h"), "trust", "distrust", suspicion.alias("suspicion"),
                                                 (suspicion > threshold).alias("bad"))
    out = marked.select("page_id", "host", "path", "rule", "action").join(verdicts, F.col("host") == F.col("h"), "left")
    graph = F.when(F.coalesce("bad", F.lit(False)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("action", graph).alias("verdict"), "trust", "distrust", "suspicion")
