"""Run-level reports: coverage, effects, mixes, gaps and table digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.plans.signals import coverage_long


def signal_coverage(signals: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Observed and unobserved flowgates per signal, with what the gap does to the ranking."""
    weights = weights or fixed.DEFAULT_WEIGHTS
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    counted = coverage_long(signals).groupBy("signal").agg(
        F.count_if(F.col("coverage") == "observed").alias("observed"),
        F.count_if(F.col("coverage") == "unobserved").alias("unobserved"))
    n = F.col("observed") + F.col("unobserved")
    everywhere = F.concat(F.lit("unobserved for all "), n.cast("string"), F.lit(
        " flowgates: contributes 0 to every composite and cannot change the order"))
    partly = F.concat(F.lit("unobserved for "), F.col("unobserved").cast("string"), F.lit(" of "), n.cast("string"),
                      F.lit(" flowgates: those are compared without it, so they are biased low on this signal"))
    return counted.withColumn("weight", F.coalesce(table[F.col("signal")], F.lit(0.0))).withColumn(
        "effect", F.when(F.col("observed") == 0, everywhere).when(F.col("unobserved") > 0, partly))


def unobserved_weight(coverage: DataFrame) -> DataFrame:
    """Configured weight no flowgate has a value for."""
    return coverage.agg(F.bround(F.coalesce(F.sum(F.when(
        (F.col("observed") == 0), F.col("weight"))), F.lit(0.0)), 6).alias("unobserved_weight"))


def gap_list(tables: DataFrame, coverage: DataFrame) -> DataFrame:
    """Text lines on what the run could not see. ``tables``: table, coverage, note."""
    rows = tables.where("coverage <> 'observed'").select(
        F.concat("table", F.lit(": "), "coverage", F.lit(" — "), "note").alias("gap"))
    affected = coverage.agg(F.sum("unobserved")).scalar() > 0
    weight = F.col("unobserved_weight")
    share = unobserved_weight(coverage).where(affected).select(F.concat(
        F.lit("composite: "), F.format_string("%.2f", weight),
        F.lit(" of the configured weight is unobserved for every flowgate; the ranking rests on the remaining "),
        F.format_string("%.2f", 1 - weight), F.lit(".")).alias("gap"))
    return rows.unionByName(share)


def mixes(ranked: DataFrame) -> DataFrame:
    """Counts by recommended remedy, open remedy set, screen status and value-layer choice."""
    kinds = [("recommended_get", F.col("recommended_get")), ("get_set", F.array_join("remedies", ";")),
             ("screen_status", F.col("status"))]
    if "ev_get" in ranked.columns:
        kinds.append(("ev_recommended_get", F.col("ev_get")))
    entries = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("name")) for k, v in kinds]))
    return ranked.select(entries.alias("e")).where("e.name is not null").groupBy("e.kind", "e.name").agg(
        F.count(F.lit(1)).alias("n"))


def table_digest(df: DataFrame, buckets: int = 4096) -> DataFrame:
    """One digest of a table that does not depend on row order or partitioning.

    Each row is hashed; the words of the hashes are summed per hash-prefix bucket, which
    commutes and combines map-side, and the bucket sums are hashed in bucket order. Round
    doubles before calling.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]),
                           {"ignoreNullFields": "false"}), 256)
    width = max(1, (buckets - 1).bit_length() // 4)
    counted = df.select(row.alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    words = [F.conv(F.substring("h", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)") for i in range(5)]
    per_bucket = counted.groupBy(F.substring("h", 1, width).alias("b")).agg(
        *[F.sum(w * F.col("c").cast("decimal(18,0)")).alias(f"s{i}") for i, w in enumerate(words)],
        F.sum("c").alias("n"))
    packed = per_bucket.select("b", F.concat_ws("|", F.col("n").cast("string"), *[
        F.col(f"s{i}").cast("string") for i in range(5)]).alias("d"))
    # at most 16^width buckets reach this last aggregation
    return packed.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "d"))),
                                                      lambda x: F.concat(x["b"], F.lit(":"), x["d"])), ","), 256
                             ).alias("digest"))


def fingerprint(ranked: DataFrame) -> DataFrame:
    """What two runs of the same inputs and settings must agree on, to six decimals."""
    return ranked.select("rank", "constraint_id", *[
        F.bround(c, 6).alias(c) for c in ("p_top_k", "composite_lo", "composite_expected", "composite_hi")],
        "recommended_get")
