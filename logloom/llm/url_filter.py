"""URL filters by a path-template tree.

Fixed rules (host and path beginning, allow or block) decide first; the longest that fits wins.
Their verdicts also label the urls that they fit. All other urls are judged by their template:

1. A path's segments are read down a tree per host. A segment is a wildcard if it is a number
   or an id, or if its place under one parent has more values than `WIDE`; what is left names
   the branches. Below DEPTH segments, or one more than the longest rule has, the rest is one
   wildcard: labels come from rules, so branches that differ only below carry equal labels.
2. From the host down, each branch's share of blocked labels is smoothed towards its parent's, with
   the weight of STRENGTH labels; the host's towards the prior. A branch without labels has its parent's.
3. Branches whose labelled share does not differ from the parent's by more than `ALIKE`
   standard errors are merged: they have the parent's share.
4. A template is rejected when its share is above `REJECT`. Hosts without labels have the prior, which allows.

Urls reduce to distinct (host, path) with counts before the tree is built, so a host that holds
most pages is as many rows as it has paths; each level is one aggregation with map-side
sums and a join that adaptive execution can split. Only built-in functions are used.

Edge cases: a null url, or one without `://`, has an empty host and path and the prior's
verdict; urls of any length are read whole; repeated rows get equal verdicts; a share equal to
`REJECT` allows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common

#: The rules, as (verdict, host and path beginning).
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
#: Levels of the tree; values under one parent from which the place is a wildcard.
DEPTH, WIDE = 4, 20
ALIKE = 1.96
#: Prior share of blocked labels and its weight in labels; share from which a template is rejected.
PRIOR, STRENGTH, REJECT = 1 / 3, 3.0, 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, begin = text.partition("/")
        fits = ((host_ == name) | host_.endswith(f".{name}")) & path_.startswith(f"/{begin}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _shape(segment: Column) -> Column:
    """Numbers and ids as wildcards; an extension stays."""
    return F.when(segment.rlike(r"^[0-9]+(\.\w+)?$|^[0-9a-fA-F]{8}[0-9a-fA-F-]*$|.*[0-9].*[0-9].*[0-9]"),
                  F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z]\w*)$", 1))).otherwise(segment)


def depth_of(rules) -> int:
    """Levels that tell all labels apart: one below the longest rule."""
    return max([DEPTH, *(text.count("/") + 1 for _, text in rules)])


def templates(paths: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Add `template` to distinct paths(host, path, n, blocked, allowed)."""
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    tree = paths.withColumn("_parts", F.transform(parts, _shape)).withColumn("template", F.lit(""))
    for level in range(depth):
        tree = tree.withColumn("_segment", F.when(F.size("_parts") > level, F.get("_parts", F.lit(level))))
        values = tree.where("_segment is not null").select("host", "template", "_segment").distinct()
        wide = values.groupBy("host", "template").agg((F.count(F.lit(1)) > WIDE).alias("_wide"))
        tree = tree.join(wide, ["host", "template"], "left").withColumn("template", F.when(
            F.col("_segment").isNull(), F.col("template")).otherwise(
            F.concat("template", F.lit("/"), F.when(F.col("_wide"), F.lit("*")).otherwise(F.col("_segment"))))).drop("_wide", "_segment")
    deeper = F.when(F.size("_parts") > depth, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return tree.withColumn("template", deeper).drop("_parts")


def purities(tree: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(host, template, blocked_share): smoothed from the host down, alike branches merged."""
    steps = F.split("template", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    nodes = common.cut(
        tree.groupBy("host", "template").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
        .select("host", "b", "a", F.explode(above).alias("node"))
        .groupBy("host", "node").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
        .withColumn("level", F.size(F.split("node", "/")) - 1)
    )
    labels = F.col("b") + F.col("a")
    shares = nodes.where("level = 0").select(
        "host", "node", "b", "a", ((F.col("b") + PRIOR * STRENGTH) / (labels + STRENGTH)).alias("share"))
    found = shares
    for level in range(1, depth + 2):
        parents = shares.select("host", F.col("node").alias("parent"), F.col("b").alias("pb"),
                                (F.col("b") + F.col("a")).alias("p_labels"), F.col("share").alias("p_share"))
        below = nodes.where(F.col("level") == level).withColumn("parent", F.regexp_replace("node", r"/[^/]*$", ""))
        rate = F.try_divide("pb", F.col("p_labels"))
        error = F.sqrt(F.try_divide(rate * (1 - rate), labels))
        alike = (labels == 0) | (F.abs(F.try_divide("b", labels) - rate) <= ALIKE * error)
        own = (F.col("b") + F.col("p_share") * STRENGTH) / (labels + STRENGTH)
        shares = below.join(parents, ["host", "parent"]).select(
            "host", "node", "b", "a", F.when(alike, F.col("p_share")).otherwise(own).alias("share"))
        found = found.unionByName(shares)
    return found.select("host", F.col("node").alias("template"), F.col("share").alias("blocked_share"))


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages(page_id, url) as (page_id, host, path, rule, verdict, template, blocked_share)."""
    split = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, said = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = split.withColumn("rule", rule).withColumn("_said", said)
    paths = ruled.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_said") == "block", 1)).alias("blocked"),
        F.count(F.when(F.col("_said") == "allow", 1)).alias("allowed"))
    depth = depth_of(rules)
    tree = common.cut(templates(paths, depth))
    known = tree.select("host", "path", "template").join(purities(tree, depth), ["host", "template"])
    learned = F.when(F.col("blocked_share") > REJECT, "block").otherwise("allow")
    return (
        ruled.join(known, ["host", "path"], "left")
        .select("page_id", "host", "path", "rule", F.coalesce("_said", learned).alias("verdict"), "template", "blocked_share")
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")
