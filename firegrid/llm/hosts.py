"""URL filter: rules first, then trust and distrust propagated over the link graph of hosts.

Hosts are linked by the absolute links of their pages.  Trust starts at hosts whose pages the rules
allow and follows links; distrust starts at hosts whose pages the rules block and follows links
backwards, to those who link there.  Both are personalised PageRanks, left unnormalised: a host whose
pages are all blocked and that nobody links to keeps ``1 - DAMPING`` of distrust, whatever the size
of the graph, and a host is blocked when its distrust exceeds its trust by ``THRESHOLD`` of that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firegrid.operators.joins import hot_lookup
from firegrid.session import cut, cut_counted

DAMPING = 0.85
ROUNDS = 20
THRESHOLD = 0.5
# (action, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s<>]+)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; '' without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """Struct (rule, action) of the longest rule that fits, or null."""
    out = None
    for action, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,action:string>")


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, counted on the pages of ``src``."""
    links = pages.select(
        host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("dst"))
    named = links.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).where("src <> '' AND src <> dst")
    return named.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, rank): PageRank with restart at ``seeds`` (kind, host, seed) along ``edges`` (kind, src, dst, share)."""
    restart = cut(seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("rank")))
    ranks = restart
    edges, n = cut_counted(edges)
    for _ in range(rounds if n else 0):
        moved = (
            ranks.join(edges.withColumnRenamed("src", "host"), ["kind", "host"])
            .select("kind", F.col("dst").alias("host"), (damping * F.col("rank") * F.col("share")).alias("rank"))
        )
        ranks = cut(restart.unionByName(moved).groupBy("kind", "host").agg(F.sum("rank").alias("rank")))
    return ranks


def judge_hosts(pages: DataFrame, rules=RULES, damping: float = DAMPING, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """(host, n_pages, trust, distrust, verdict) of every host that has a page."""
    ruled = pages.select(host_of(F.col("url")).alias("host"), rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)["action"].alias("action"))
    hosts = cut(ruled.groupBy("host").agg(
        F.count("*").alias("n_pages"), F.count(F.when(F.col("action") == "allow", 1)).alias("n_allow"), F.count(F.when(F.col("action") == "block", 1)).alias("n_block")))
    seeds = hosts.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), (F.col("n_allow") / F.col("n_pages")).alias("seed")),
        F.struct(F.lit("distrust").alias("kind"), (F.col("n_block") / F.col("n_pages")).alias("seed")),
    )).alias("s")).select("s.kind", "host", "s.seed").where("seed > 0")
    links = cut(host_links(pages))
    out_n = links.groupBy("src").agg(F.sum("n").alias("total"))
    in_n = links.groupBy("dst").agg(F.sum("n").alias("total"))
    forward = links.join(out_n, "src").select(F.lit("trust").alias("kind"), "src", "dst", (F.col("n") / F.col("total")).alias("share"))
    backward = links.join(in_n, "dst").select(
        F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("n") / F.col("total")).alias("share"))
    ranks = propagate(forward.unionByName(backward), seeds, damping, rounds)
    wide = ranks.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust"))
    scored = hosts.join(wide, "host", "left").select(
        "host", "n_pages", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    bad = F.col("distrust") - F.col("trust") > threshold * (1 - damping)
    return scored.withColumn("verdict", F.when(bad, "block").otherwise("allow"))


def judge(pages: DataFrame, rules=RULES, damping: float = DAMPING, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust): one row per row of ``pages``.

    The longest fitting rule decides; without one, the host's verdict.  A null url or one without
    ``://`` has empty host and path, fits no rule and is allowed.  Null html has no links.  Repeated
    rows stay repeated and count as pages; other columns are ignored; an empty table gives an empty
    result.
    """
    hosts = cut(judge_hosts(pages, rules, damping, rounds, threshold))
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = named.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    found = hot_lookup(ruled, hosts, ["host"], "n_pages", "page_id")
    return found.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.action", "verdict").alias("verdict"), "trust", "distrust")


def _oracle() -> str:
    """The same rounds as common tables, one after another."""
    rules = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, rules))
    action = " ".join(f"WHEN {f} THEN '{a}'" for f, (a, _, _) in zip(fits, rules))
    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"
    link = r"""(?i)\bhref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)"""
    parts = [
        f"named AS (SELECT page_id, html, {lower.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,"
        " regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages)",
        f"ruled AS (SELECT *, CASE {rule} END AS rule, CASE {action} END AS action FROM named)",
        "hosts AS (SELECT host, count(*) AS n_pages, count(*) FILTER (action = 'allow') AS n_allow, count(*) FILTER (action = 'block') AS n_block FROM ruled GROUP BY host)",
        "seeds AS (SELECT 'trust' AS kind, host, n_allow / n_pages AS seed FROM hosts WHERE n_allow > 0"
        " UNION ALL SELECT 'distrust', host, n_block / n_pages FROM hosts WHERE n_block > 0)",
        f"found AS (SELECT host AS src, {lower.format('d')} AS dst FROM (SELECT host, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) AS d FROM named) WHERE host <> '')",
        "links AS (SELECT src, dst, count(*) AS n FROM found WHERE src <> dst GROUP BY src, dst)",
        "edges AS (SELECT 'trust' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM links"
        " UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM links)",
        f"r0 AS MATERIALIZED (SELECT kind, host, {1 - DAMPING!r} * seed AS rank FROM seeds)",
    ]
    for i in range(ROUNDS):
        parts.append(
            f"r{i + 1} AS MATERIALIZED (SELECT kind, host, sum(rank) AS rank FROM (SELECT * FROM r0 UNION ALL"
            f" SELECT e.kind, e.dst, {DAMPING} * r.rank * e.share FROM r{i} r JOIN edges e ON r.kind = e.kind AND r.host = e.src) GROUP BY kind, host)")
    parts.append(
        f"judged AS (SELECT host, sum(CASE WHEN kind = 'distrust' THEN rank ELSE -rank END) > {THRESHOLD} * {1 - DAMPING!r} AS bad FROM r{ROUNDS} GROUP BY host)")
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT r.page_id, r.host, r.path, r.rule,"
        " coalesce(r.action, CASE WHEN j.bad THEN 'block' ELSE 'allow' END) AS verdict FROM ruled r LEFT JOIN judged j USING (host)"
    )


ORACLE = _oracle()
