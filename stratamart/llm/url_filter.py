"""URL filter by rules and by link-graph propagation.

A url's host and path are judged by the longest rule that fits. Hosts of pages that rules
allow are trusted seeds, hosts of pages they block are blocked seeds, each by the share of
its pages. Trust spreads by personalised PageRank along links between hosts, distrust along
reversed links: a host that links to distrusted hosts is distrusted itself. Pages without a
rule get their host's verdict: blocked where its own blocked pages exceed its allowed ones by
the threshold, or where the distrust that came by links is at least the threshold's share of
it and the host's trust. That share does not depend on how many hosts link to a blocked one.

Values are scaled so that a host all of whose pages are seeds has 1 before any link. A host
without seeds and links has 0 and is allowed. Links are absolute ``href`` targets; relative
ones stay on their host and carry nothing.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path:
from there to ``?``, ``#`` or the end. A null url, or one without ``://``, has an empty
host and path, no rule, and is allowed. Null html has no links. Repeated rows are judged
alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import hot_keys, spread_join, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_HREF = r"(?i)href\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s>]+)"
DAMPING = 0.85
CLOSE = 1e-6
THRESHOLD = 0.5


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, group), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; both null where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):
        of, _, rest = rule.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith("/" + rest)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, action).otherwise(verdict)
    return text, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): pages of one host that link to another host."""
    targets = F.array_distinct(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1)))
    links = pages.select("host", F.explode(F.transform(targets, lambda t: F.translate(t, UPPER, LOWER))).alias("dst"))
    links = links.where((F.col("host") != "") & (F.col("host") != F.col("dst")))
    return links.groupBy(F.col("host").alias("src"), "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, *, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) from edges (src, dst, n) and seeds (host, good, bad).

    One table of both walks: a step's share is its links over all links of where it
    starts. A host passes distrust on only as far as it is not trusted itself (one minus its
    good share), so that links to a trusted host spoil nothing. Rounds end when no value moves by more than ``CLOSE``; ``damping`` makes every
    round's moves smaller.
    """
    forward = edges.select(F.concat(F.lit("t:"), "src").alias("at"), F.concat(F.lit("t:"), "dst").alias("to"), "n")
    back = edges.select(F.concat(F.lit("d:"), "dst").alias("at"), F.concat(F.lit("d:"), "src").alias("to"), "n")
    steps = forward.unionByName(back)
    counted = steps.groupBy("at").agg(F.sum("n").alias("all"), F.count("*").alias("rows"))
    passes = seeds.select(F.concat(F.lit("d:"), "host").alias("at"), (1.0 - F.col("good")).alias("passes"))
    starts = stage(counted.join(passes, "at", "left").select(
        "at", "rows", "all", F.coalesce("passes", F.lit(1.0)).alias("passes")), "starts")
    hot = hot_keys(starts, "at", "rows")
    steps = stage(
        spread_join(steps, starts.drop("rows"), "at", hot, F.col("to"))
        .select("at", "to", (F.col("passes") * F.col("n") / F.col("all")).alias("share")), "steps")
    source = stage(
        seeds.select(F.concat(F.lit("t:"), "host").alias("at"), F.col("good").alias("seed"))
        .unionByName(seeds.select(F.concat(F.lit("d:"), "host").alias("at"), F.col("bad").alias("seed")))
        .where("seed > 0"), "seeds")
    ranks = source.withColumnRenamed("seed", "rank")
    while not steps.isEmpty():
        moved = spread_join(steps, ranks, "at", hot, F.col("to")).select(
            F.col("to").alias("at"), (F.col("share") * F.col("rank") * damping).alias("rank"))
        new = moved.unionByName(source.select("at", F.col("seed").alias("rank")))
        new = stage(new.groupBy("at").agg(F.sum("rank").alias("rank")), "ranks")
        change = new.join(ranks.withColumnRenamed("rank", "old"), "at", "left").agg(
            F.max(F.abs(F.col("rank") - F.coalesce("old", F.lit(0.0))))).first()[0]
        ranks = new
        if change is None or change <= CLOSE:
            break
    kind = F.substring("at", 1, 1)
    return ranks.groupBy(F.substring("at", 3, 1 << 30).alias("host")).agg(
        F.sum(F.when(kind == "t", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(kind == "d", F.col("rank")).otherwise(0.0)).alias("distrust"))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], *, threshold: float = THRESHOLD
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, trust, distrust.

    ``rules`` are (allow or block, host/path prefix).
    """
    base = pages.select("page_id", F.col("url").alias("url"), "html").withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = stage(base.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled")), "judged")
    hosts = stage(
        judged.where("host <> ''").groupBy("host").agg(
            F.count("*").alias("n"),
            F.avg(F.when(F.col("ruled") == "allow", 1.0).otherwise(0.0)).alias("good"),
            F.avg(F.when(F.col("ruled") == "block", 1.0).otherwise(0.0)).alias("bad")), "hosts")
    edges = stage(host_edges(base), "host-edges")
    ranks = propagate(edges, hosts)
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    linked = distrust - F.col("bad")
    spoilt = (F.col("bad") - F.col("good") >= threshold) | (
        (linked > 0) & (linked >= threshold * (trust + linked)))
    verdicts = stage(hosts.join(ranks, "host", "left").select(
        "host", trust.alias("trust"), distrust.alias("distrust"), spoilt.alias("spoilt")), "verdicts")
    spread = spread_join(
        judged, verdicts, "host", hot_keys(hosts, "host"), F.struct("page_id", "path"), "left")
    bad = F.coalesce("spoilt", F.lit(False))
    return spread.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
