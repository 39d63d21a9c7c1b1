"""URL filter by a path-template tree (operator 7).

Fixed rules decide first (the longest that fits). They also label the urls they decide. For the other urls,
each host has a tree of path templates: variable segments become ``*``; level by level, a branch whose share
of blocked urls does not differ significantly from its siblings' (two-proportion test) is merged with them,
together with all below it. A template is rejected if its share, smoothed towards its parent's share, up to the
host's and the whole table's, reaches ``REJECT``.

All of it is DataFrame expressions: pages are counted by (host, template) with map-side combining, the tree is
built from those counts, and a page joins the one row of its template, so AQE can split a hot host. The tree
grows while any branch holds several templates with a further segment; a template alone in its branch is complete
at once, since nothing below it can differ from it. Templates that are complete leave the loop as files.

Defined results: a null url, or one without ``://``, has an empty host and path; paths may be of any depth; with no
labelled url at all every template is allowed; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve.llm.common import ascii_lower, shared_path
from fluxsieve.session import cut

#: (verdict, host, path) of the contract.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
SMOOTHING, REJECT, Z = 4.0, 0.5, 1.96
#: Segments that vary: numbers, with or without a file ending; three digits or more; long hex; very long.
VARIABLE = r"^\d+(\.[A-Za-z]+)?$|\d{3,}|^[0-9A-Fa-f]{8,}$|^.{25,}$"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, own + start).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def template(path: Column) -> Column:
    """Array of the path's segments, variable ones generalised."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(segments, lambda s: F.when(s.rlike(VARIABLE), "*").otherwise(s))


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, template, rule, ruling of every page."""
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, ruling = ruled(F.col("host"), F.col("path"), rules)
    return split.select("*", template(F.col("path")).alias("template"), rule.alias("rule"), ruling.alias("ruling"))


def _totals(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("labelled").alias("labelled_in"), F.sum("blocked").alias("blocked_in"))


def _smoothed(blocked: Column, labelled: Column, towards: Column) -> Column:
    return (blocked + SMOOTHING * towards) / (labelled + SMOOTHING)


def templates(found: DataFrame) -> DataFrame:
    """host, template, merged template and smoothed share of blocked urls of every template."""
    spark, done, level = found.sparkSession, shared_path(found.sparkSession, "url-tree"), 0
    leaves = cut(found.groupBy("host", "template").agg(
        F.count("ruling").alias("labelled"), F.count(F.when(F.col("ruling") == "block", 1)).alias("blocked")))
    whole = leaves.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("n")).first()
    prior = (whole["b"] or 0) / whole["n"] if whole["n"] else 0.0
    hosts = _totals(leaves, "host")
    tree = cut(leaves.join(hosts, "host").select(
        "host", "template", "labelled", "blocked", F.array().cast("array<string>").alias("merged"),
        F.col("template").alias("rest"),  # the segments that are not in the tree yet
        _smoothed(F.col("blocked_in"), F.col("labelled_in"), F.lit(prior)).alias("share")))
    while True:
        complete = tree.where(F.size("rest") == 0).select("host", "template", "merged", "share")
        complete.write.parquet(f"{done}/level={level}")
        tree, level = tree.where(F.size("rest") > 0), level + 1
        if tree.isEmpty():
            return spark.read.schema(complete.schema).option("recursiveFileLookup", "true").parquet(done)
        at = tree.withColumn("segment", F.get("rest", F.lit(0)))
        branches = _totals(at, "host", "merged", "segment")
        parents = branches.groupBy("host", "merged").agg(
            F.sum("labelled_in").alias("n"), F.sum("blocked_in").alias("b"), F.count(F.lit(1)).alias("branches"))
        both = branches.join(parents, ["host", "merged"])
        n, b, n_rest = F.col("labelled_in"), F.col("blocked_in"), F.col("n") - F.col("labelled_in")
        pooled = F.try_divide("b", "n")
        spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), n) + F.try_divide(F.lit(1), n_rest)))
        apart = F.abs(F.try_divide(b, n) - F.try_divide(F.col("b") - b, n_rest)) > Z * spread  # null: no labels
        name = F.when(F.coalesce(apart, F.lit(False)) | (F.col("branches") == 1), F.col("segment")).otherwise("*")
        named = both.select("host", "merged", "segment", "n", "b", name.alias("branch"))
        grown = at.join(named, ["host", "merged", "segment"]).withColumn(
            "merged", F.concat("merged", F.array("branch"))).withColumn(
            "rest", F.slice("rest", F.lit(2), F.greatest(F.size("rest") - 1, F.lit(0))))
        sums = grown.groupBy("host", "merged").agg(
            F.sum("labelled").alias("labelled_in"), F.sum("blocked").alias("blocked_in"),
            F.count(F.when(F.size("rest") > 0, 1)).alias("further"))
        same = (F.col("labelled_in") == F.col("n")) & (F.col("blocked_in") == F.col("b"))  # no evidence of its own
        share = F.when(same, F.col("share")).otherwise(
            _smoothed(F.col("blocked_in"), F.col("labelled_in"), F.col("share")))
        tree = cut(grown.join(sums, ["host", "merged"]).withColumn("alone", F.col("further") == 1).select(
            "host", "template", "labelled", "blocked",
            F.when(F.col("alone"), F.concat("merged", "rest")).otherwise(F.col("merged")).alias("merged"),
            F.when(F.col("alone"), F.array().cast("array<string>")).otherwise(F.col("rest")).alias("rest"),
            share.alias("share")))


def verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, share of every page."""
    found = judged(pages, rules)
    tree = templates(found)
    by_tree = F.when(F.col("share") >= REJECT, "block").otherwise("allow")
    return found.join(tree, ["host", "template"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruling", by_tree).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("merged", "/")).alias("template"), "share")
