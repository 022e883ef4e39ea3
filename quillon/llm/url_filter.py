"""URL filters: allow and block rules, and trust that spreads over links between hosts.

Rules decide the urls that they fit. For the others, hosts with allowed urls are trusted
seeds and hosts with blocked urls distrusted seeds (each weighed by its number
of such urls). Personalised PageRank carries trust along host edges and distrust
against them; a host is blocked if distrust holds more than ``DISTRUST`` of its
two scores, in sums that have
settled: rounds go on until no score grows by more than ``TOLERANCE`` of itself. The columns
``trust`` and ``distrust`` show the sums after ``ROUNDS`` rounds, to 12 decimals, as the SQL has them. Edges: links to other hosts in a page's html, and both ways between a host
and its parent domain if that has pages too. All of it is DataFrame operations.

Nulls and repeats: a null url, or one without ``://``, has empty host and path, fits
no rule and is allowed; null html has no links; repeated rows count as often as they stand.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.shared import share
from quillon.session import Step

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
ROUNDS = 8
TOLERANCE = 1e-7
DISTRUST = 0.5
#: Scores that differ by less than this share are equal: sums of doubles depend on the order of rows.
TIE = 1e-6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def judged(pages: DataFrame, id_col: str, url_col: str, rules) -> DataFrame:
    rest = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("u")).select("id", after_scheme(F.col("u")).alias("rest"))
    split = rest.select("id", host_of(F.col("rest")).alias("host"), path_of(F.col("rest")).alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return split.withColumn("rule", rule).withColumn("by_rule", verdict)


def host_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """Links between different hosts: (src, dst, weight)."""
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.coalesce(F.col(url_col), F.lit(""))
    links = pages.select(
        url.alias("u"),
        F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"), F.lit(1))).alias("to"),
    ).where(F.size("to") > 0)
    return (
        links.select(host_of(after_scheme(F.col("u"))).alias("src"), F.explode("to").alias("dst"))
        .withColumn("dst", F.translate("dst", _UPPER, _LOWER))
        .where("src != '' AND dst != '' AND src != dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def _family(hosts: DataFrame) -> DataFrame:
    """Both ways between a host and its parent domain, where both have pages."""
    own = hosts.select("host", F.expr("substring_index(host, '.', -1)").alias("tld"), F.expr("substring(host, instr(host, '.') + 1)").alias("parent"))
    pairs = own.where("instr(host, '.') > 0 AND parent != tld").select(F.col("host").alias("child"), "parent")
    pairs = pairs.join(hosts.select(F.col("host").alias("parent")), "parent", "left_semi")
    up = pairs.select(F.col("child").alias("src"), F.col("parent").alias("dst"), F.lit(1.0).alias("weight"))
    return up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))


def _rounds(edges: DataFrame, seeds: DataFrame, damping: float) -> Iterator[Step]:
    """(kind, host, score, before) after 0, 1, 2... rounds; it ends where there is nothing to hand on."""
    forth = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
    back = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    both = forth.unionByName(back)
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    steps = share(both.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("all")).alias("part"))).df
    total = seeds.groupBy("kind").agg(F.sum("seed").alias("all"))
    none = F.lit(0.0)
    first = seeds.join(F.broadcast(total), "kind").select("kind", "host", ((1 - damping) * F.col("seed") / F.col("all")).alias("score"), none.alias("before"))
    start = score = share(first)
    yield start
    if steps.isEmpty():
        return
    while True:
        moved = score.df.join(steps, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (damping * F.col("score") * F.col("part")).alias("score"), none.alias("before"))
        known = score.df.select("kind", "host", none.alias("score"), F.col("score").alias("before"))
        parts = start.df.unionByName(moved).unionByName(known)
        score = share(parts.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("before").alias("before")))
        yield score


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, score): personalised PageRank of each kind from its seeds (kind, host, seed), after some rounds.

    Kind ``trust`` follows the edges and ``distrust`` goes against them. The mass of
    hosts without edges on the way is not handed on.
    """
    return list(islice(_rounds(edges, seeds, damping), rounds + 1))[-1].df.drop("before")


def settled(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The scores of ``propagated`` after ``rounds`` rounds, and those that further rounds no longer change.

    Scores only grow. Once none grows by more than a share ``TOLERANCE`` in a round, none does in a later
    one, and a host that is reached for the first time grows by all of its score. So
    there are as many rounds as the longest way from a seed, until scores are too small for a double.
    """
    shown = last = None
    for k, score in enumerate(_rounds(edges, seeds, damping)):
        if last is not None and last is not shown and k > 1:
            last.drop()
        last = score
        if k <= rounds:
            shown = score
        if k >= rounds and k % 4 == 0:
            growth = score.df.where("score > 0").agg(F.max((F.col("score") - F.col("before")) / F.col("score"))).first()[0]
            if growth is None or growth <= TOLERANCE:
                break
    return shown.df.drop("before"), last.df.drop("before")


def filter_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    rules: Sequence[tuple[str, str, str]] = RULES, distrust: float = DISTRUST,
) -> DataFrame:
    """One row a page: id, host, path, rule, verdict, trust and distrust of its host."""
    split = judged(pages, id_col, url_col, rules)
    counts = share(
        split.where("host != ''").groupBy("host").agg(
            F.count_if(F.col("by_rule") == "allow").cast("double").alias("trust"),
            F.count_if(F.col("by_rule") == "block").cast("double").alias("distrust"),
        )
    ).df
    seeds = counts.selectExpr("host", "stack(2, 'trust', trust, 'distrust', distrust) AS (kind, seed)").where("seed > 0")
    links = host_edges(pages, url_col, html_col).unionByName(_family(counts.select("host")))
    edges = links.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    shown, last = settled(edges, seeds)

    def of(kind: str, which: str) -> Column:
        return F.sum(F.when((F.col("kind") == kind) & (F.col("which") == which), F.col("score")).otherwise(0.0))

    score = shown.withColumn("which", F.lit("shown")).unionByName(last.withColumn("which", F.lit("last")))
    by_host = score.groupBy("host").agg(
        F.round(of("trust", "shown"), 12).alias("trust"), F.round(of("distrust", "shown"), 12).alias("distrust"),
        (of("distrust", "last") > distrust * (1 + TIE) * (of("trust", "last") + of("distrust", "last"))).alias("bad"),
    )
    joined = split.join(by_host.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left")
    by_method = F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def _sql() -> str:
    step = []
    for k in range(1, ROUNDS + 1):
        step.append(
            f"r{k} AS (SELECT kind, host, sum(score) AS score FROM (SELECT kind, host, score FROM r0 UNION ALL "
            f"SELECT s.kind, s.dst, {DAMPING}::DOUBLE * r.score * s.part FROM r{k - 1} r JOIN steps s ON r.kind = s.kind AND r.host = s.host) GROUP BY kind, host)"
        )
    rules = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = "".join(f" WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{{{i}}}'" for i, (_, h, p) in enumerate(rules))
    rule = "CASE" + fits.format(*[h + p for _, h, p in rules]) + " END"
    verdict = "CASE" + fits.format(*[v for v, _, _ in rules]) + " END"
    return f"""
WITH u AS (SELECT page_id, html, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS (SELECT *, {rule} AS rule, {verdict} AS by_rule FROM h),
c AS (SELECT host, (count(*) FILTER (by_rule = 'allow'))::DOUBLE AS trust, (count(*) FILTER (by_rule = 'block'))::DOUBLE AS distrust FROM j WHERE host != '' GROUP BY host),
links AS (
  SELECT host AS src, translate(unnest(list_distinct(regexp_extract_all(coalesce(html, ''), '(?i)\\bhref\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s>]+)', 1))), '{_UPPER}', '{_LOWER}') AS dst FROM j),
par AS (SELECT host AS child, substr(host, instr(host, '.') + 1) AS parent FROM c WHERE instr(host, '.') > 0 AND substr(host, instr(host, '.') + 1) != split_part(host, '.', -1)),
fam AS (SELECT child, parent FROM par WHERE parent IN (SELECT host FROM c)),
e AS (SELECT src, dst, sum(weight) AS weight FROM (
  SELECT src, dst, count(*)::DOUBLE AS weight FROM links WHERE src != '' AND dst != '' AND src != dst GROUP BY src, dst
  UNION ALL SELECT child, parent, 1.0 FROM fam UNION ALL SELECT parent, child, 1.0 FROM fam) GROUP BY src, dst),
b AS (SELECT 'trust' AS kind, src AS host, dst, weight FROM e UNION ALL SELECT 'distrust', dst, src, weight FROM e),
steps AS (SELECT kind, host, dst, weight / sum(weight) OVER (PARTITION BY kind, host) AS part FROM b),
seeds AS (SELECT 'trust' AS kind, host, trust AS seed FROM c WHERE trust > 0 UNION ALL SELECT 'distrust', host, distrust FROM c WHERE distrust > 0),
r0 AS (SELECT kind, host, {1 - DAMPING}::DOUBLE * seed / sum(seed) OVER (PARTITION BY kind) AS score FROM seeds),
{", ".join(step)},
s AS (SELECT host, round(sum(CASE WHEN kind = 'trust' THEN score ELSE 0 END), 12) AS trust, round(sum(CASE WHEN kind = 'distrust' THEN score ELSE 0 END), 12) AS distrust FROM r{ROUNDS} GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(by_rule, CASE WHEN coalesce(s.distrust, 0) > {DISTRUST} * (coalesce(s.trust, 0) + coalesce(s.distrust, 0)) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(s.trust, 0) AS trust, coalesce(s.distrust, 0) AS distrust
FROM j LEFT JOIN s ON j.host = s.host
"""


OP5_SQL = _sql()
