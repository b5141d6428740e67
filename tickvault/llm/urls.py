"""URL filter: fixed host/path rules first, then a path-template tree learnt from labelled URLs.

The tree is grown level by level over distinct (host, path shape) rows, never over pages:

1. digits inside a segment become ``#``, so ``/en/25`` and ``/en/474`` share one shape;
2. at each level the branches of one parent are compared. A parent with many, mostly rare branches
   is variable: all its branches become the wildcard ``*``. Otherwise a branch keeps its own node
   only if its labelled bad rate is above its siblings' by a two-proportion z test; the branches that
   are below theirs are merged into one node ``*-``, and those that are alike into ``*`` (segments
   below ``MAX_DEPTH`` stay joined as one last branch, so no part of a path is ignored);
3. each template's bad rate is smoothed towards its host's, the host's towards the global rate, and
   templates at or over ``threshold`` are blocked.

DataFrame functions only. Null URLs, and URLs without ``://``, have an empty host and path and are
judged by the tree like any other (host ``''``). Repeated rows are judged alike, each returned.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import drop_stages, stage

#: (verdict, rule): the rule's host, then its path prefix.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
LEVELS = 3                                # levels between two staged tables
VARIABLE_MIN, VARIABLE_MEAN = 20, 3.0    # at least so many branches, with at most so many pages each
Z_APART, PRIOR_WEIGHT, THRESHOLD = 2.58, 8.0, 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/ ? #``, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*+)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``? #`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*+([^?#]*+)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits; null if none does. A rule fits its host
    and all subdomains if the path starts with the rule's path."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):     # the longest is tested first
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def path_shape(path: Column) -> Column:
    return F.regexp_replace(path, "[0-9]+", "#")


def _level(shapes: DataFrame, d: int) -> DataFrame:
    """One level of the tree: decide which branches keep a node, and extend the templates."""
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    branch = shapes.groupBy("host", "template", F.get("segments", F.lit(d)).alias("segment")).agg(*sums)
    parent = branch.groupBy("host", "template").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("p_n"), F.sum("labelled").alias("p_labelled"), F.sum("bad").alias("p_bad"))
    rest, rest_bad = F.col("p_labelled") - F.col("labelled"), F.col("p_bad") - F.col("bad")
    pooled = F.col("p_bad") / F.greatest(F.col("p_labelled"), F.lit(1))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.greatest(F.col("labelled"), F.lit(1)) + 1 / F.greatest(rest, F.lit(1))))
    gap = F.abs(F.col("bad") / F.greatest(F.col("labelled"), F.lit(1)) - rest_bad / F.greatest(rest, F.lit(1)))
    apart = (F.col("labelled") > 0) & (rest > 0) & (gap > Z_APART * spread)
    variable = (F.col("k") >= VARIABLE_MIN) & (F.col("p_n") <= VARIABLE_MEAN * F.col("k"))
    worse = F.col("bad") * F.greatest(rest, F.lit(1)) > rest_bad * F.col("labelled")
    node = (F.when(F.col("segment").isNull(), F.lit("$"))            # the path ends here
            .when((F.col("k") == 1) | (apart & worse & ~variable), F.col("segment"))
            .when(apart & ~variable, F.lit("*-")).otherwise(F.lit("*")))
    decided = (branch.join(parent, ["host", "template"])
               .select("host", "template", "segment", F.concat_ws("/", "template", node).alias("__next")))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"d.{c}")) for c in ("host", "template")]
    same.append(F.get("s.segments", F.lit(d)).eqNullSafe(F.col("d.segment")))
    return (shapes.alias("s").join(decided.alias("d"), reduce(lambda a, b: a & b, same))
            .select("s.host", "s.shape", "s.segments", F.col("d.__next").alias("template"), "s.n", "s.labelled", "s.bad"))


def _grown(tree: DataFrame, spent: list[str]) -> DataFrame:
    """All shapes with their templates. A shape leaves the loop when its path has ended or no other shape is in its
    node, so the rounds follow the depth that paths share, and later rounds only hold what is still open."""
    settled, d = [], 0
    while True:
        for d in range(d, d + LEVELS):
            tree = _level(tree, d)
        d += 1
        tree = stage(tree, "url-levels", spent)
        alone = tree.groupBy("host", "template").agg((F.count(F.lit(1)) == 1).alias("alone"))
        tree = stage(tree.join(alone, ["host", "template"]).withColumn("settled", F.col("alone") | (F.size("segments") <= d)), "url-open", spent)
        rest = F.when(F.size("segments") > d, F.slice("segments", F.lit(d + 1), F.greatest(F.size("segments") - d, F.lit(1))))
        columns = ["host", "shape", "segments", "template", "n", "labelled", "bad"]
        settled.append(tree.filter("settled").withColumn("template", F.concat_ws("/", F.col("template"), rest)).select(*columns))
        tree = tree.filter("NOT settled").select(*columns)
        if tree.isEmpty():
            return reduce(DataFrame.union, settled)


def template_verdicts(urls: DataFrame, labelled: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(host, shape, template, bad_rate, verdict) for every shape in ``urls`` (host, path).

    ``labelled``: (host, path, bad 0/1), any number of rows per URL; null labels are ignored."""
    seen = urls.select("host", path_shape(F.col("path")).alias("shape"), F.lit(1).alias("n"), F.lit(0).alias("labelled"), F.lit(0).alias("bad"))
    marks = labelled.filter("bad IS NOT NULL").select("host", path_shape(F.col("path")).alias("shape"), F.lit(0), F.lit(1), F.col("bad").cast("int"))
    shapes = seen.union(marks).groupBy("host", "shape").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")])
    spent: list[str] = []
    parts = F.split(F.regexp_replace("shape", "^/", ""), "/", -1)
    tree = stage(shapes.withColumn("segments", F.when(F.col("shape") == "", F.expr("CAST(array() AS array<string>)")).otherwise(parts))
                 .withColumn("template", F.lit("")), "url-shapes", spent)
    tree = stage(_grown(tree, spent), "url-templates", spent)
    total = tree.agg((F.sum("bad") / F.greatest(F.sum("labelled"), F.lit(1))).alias("global_rate"))
    rate = lambda bad, n, prior: (F.sum(bad) + PRIOR_WEIGHT * prior) / (F.sum(n) + PRIOR_WEIGHT)
    g = float(total.first()[0] or 0.0)                                 # one number; no labels, no block
    hosts = tree.groupBy("host").agg(rate("bad", "labelled", F.lit(g)).alias("host_rate"))
    templates = (tree.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).join(hosts, "host")
                 .withColumn("bad_rate", (F.col("bad") + PRIOR_WEIGHT * F.col("host_rate")) / (F.col("labelled") + PRIOR_WEIGHT)))
    out = (tree.select("host", "shape", "template").join(templates.select("host", "template", "bad_rate"), ["host", "template"])
           .withColumn("verdict", F.when(F.col("bad_rate") >= threshold, "block").otherwise("allow")))
    out = stage(out, "url-verdicts")
    drop_stages(urls.sparkSession, spent)
    return out


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, threshold: float = THRESHOLD, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, template, bad_rate and verdict (the rule's, else the tree's).
    Columns of ``pages`` with these names are replaced."""
    added = ("host", "path", "rule", "template", "bad_rate", "verdict")
    at = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in added or c == url],
                      url_host(F.col(url)).alias("__host"), url_path(F.col(url)).alias("__path"))
    known = labelled.select(url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "bad")
    tree = template_verdicts(at.select(F.col("__host").alias("host"), F.col("__path").alias("path")), known, threshold)
    tree = tree.select(F.col("host").alias("__host"), F.col("shape").alias("__shape"), "template", "bad_rate", F.col("verdict").alias("__tree"))
    return (at.withColumn("__shape", path_shape(F.col("__path"))).withColumn("__rule", rule_of(F.col("__host"), F.col("__path"), rules))
            .join(tree, ["__host", "__shape"], "left")
            .withColumns({"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__rule.rule"),
                          "verdict": F.coalesce(F.col("__rule.verdict"), F.col("__tree"), F.lit("allow"))})
            .drop("__host", "__path", "__shape", "__rule", "__tree"))
