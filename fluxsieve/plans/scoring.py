"""Normalization references, composite draws, rank stability and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fluxsieve import fixed
from fluxsieve.functions import numeric, sampling
from fluxsieve.operators.ranking import exact_percentiles, ordered_position
from fluxsieve.session import cut


def derive_references(congestion: DataFrame, quantile: float = 0.99,
                      recurring_rent: bool = True) -> DataFrame:
    """References (name, value, n): a percentile of each raw signal where it is observed,
    four significant figures.

    ``congestion``: rent_musd, max_month_cost_musd, hours_binding (null = unobserved).
    """
    coi = (F.greatest(F.col("rent_musd") - F.col("max_month_cost_musd"), F.lit(0.0)) if recurring_rent
           else F.col("rent_musd") * F.col("hours_binding") / fixed.HOURS_PER_YEAR)
    if recurring_rent:
        coi = F.when(F.col("rent_musd").isNotNull() & F.col("max_month_cost_musd").isNotNull(), coi)
    populations = F.explode(F.array(
        F.struct(F.lit("rent_ref_musd").alias("name"), F.col("rent_musd").alias("x")),
        F.struct(F.lit("persist_ref_hours").alias("name"), F.col("hours_binding").cast("double").alias("x")),
        F.struct(F.lit("coi_ref_musd").alias("name"), coi.alias("x"))))
    long = congestion.select(populations.alias("e")).select("e.*").where("x is not null")
    return exact_percentiles(long, "x", [quantile], ["name"]).select(
        "name", numeric.significant(F.col("x"), 4).alias("value"), "n")


def spread_for_draws(flowgates: DataFrame) -> DataFrame:
    """Flowgates hashed over a fixed number of partitions before draws multiply their rows.

    The count is explicit because AQE would fold these few rows into one partition, and each
    of them is about to become thousands. It is not the shuffles' own count, or rows that a join has left hashed by
    the id would stay where they are, and be folded. A later aggregation per flowgate needs no exchange.
    """
    parts = 2 * max(int(flowgates.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                    flowgates.sparkSession.sparkContext.defaultParallelism)
    return flowgates.repartition(parts, "constraint_id")


def composite_draws(signals: DataFrame, *, weights: dict[str, float] | None = None, draws: int,
                    seed: int, portable: bool = False) -> DataFrame:
    """(constraint_id, draw, composite): every draw of every flowgate, one expression each.

    Uniforms are keyed by (seed, draw, flowgate, signal), so nothing is joined and any row can
    be recomputed alone. ``portable`` uses md5, which other engines share; the default is the
    faster 64-bit hash.
    """
    weights = weights or fixed.DEFAULT_WEIGHTS
    names = list(weights)
    rows = spread_for_draws(signals.select("constraint_id", *[f"sig_{n}" for n in names]))
    blocks = (len(names) + sampling.PER_DIGEST - 1) // sampling.PER_DIGEST
    if portable:
        rows = rows.withColumn("_first", F.explode(sampling.chunk_starts(draws)))
        rows = rows.withColumn("_u", sampling.portable_uniforms(seed, draws, blocks, F.col("_first"), F.col("constraint_id")))
        rows = rows.withColumn("draw", F.explode(sampling.chunk_draws(F.col("_first"), draws)))
        # one number a signal, so that no expression is worked out again in each branch of its distribution
        rows = rows.select("constraint_id", "draw", *[f"sig_{n}" for n in names], *[
            sampling.uniform_at(F.col("_u"), blocks, F.col("draw"), F.col("_first"), i).alias(f"_u{i}") for i in range(len(names))])
    else:
        rows = rows.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))

    def u(i, name):
        if portable:
            return F.col(f"_u{i}")
        return sampling.uniform(F.lit(seed), F.col("draw"), F.col("constraint_id"), F.lit(name))

    total = None
    for i, name in enumerate(names):
        r = F.col(f"sig_{name}")
        term = F.lit(float(weights[name])) * sampling.triangular(u(i, name), r["lo"], r["expected"], r["hi"])
        total = term if total is None else total + term
    return rows.select("constraint_id", "draw", total.alias("composite"))


def _linear(sorted_values: Column, total: int, p: float) -> Column:
    at = p * (total - 1)
    low, share = int(at), at - int(at)
    a = F.get(sorted_values, F.lit(low))
    return a if share == 0 else a + (F.get(sorted_values, F.lit(low + 1)) - a) * F.lit(share)


#: Where the classes around the shortlist's threshold begin, as multiples of the shortlist's share of all rows.
CLASS_SHARES = (3.0, 2.0, 1.5, 1.25, 1.1, 1.0, 0.9, 0.75, 0.5)


def band_and_share(draws: DataFrame, value: str, k: int, total: int, positive_only: bool = False) -> DataFrame:
    """p5, p50, p95 of each flowgate's draws, and the share of draws in which it is among the k largest.

    ``draws``: constraint_id, draw (1 to ``total``), ``value``; made once, and kept as one array per flowgate.
    Values fall into a few classes around the threshold (their edges only steer the work). Counting classes per
    draw, combined on the map side, tells which class holds rank k: what lies above it is a hit where it stands,
    and only that class is shuffled by draw to settle its order. Ties go to the smaller id.
    """
    listed = draws.groupBy("constraint_id").agg(F.array_sort(F.collect_list(F.struct("draw", value))).alias("_v"))
    held = cut(listed.select("constraint_id", F.transform("_v", lambda x: x[value]).alias("v")))
    shares = [max(0.0, 1.0 - s * k / max(held.count(), 1)) for s in CLASS_SHARES]
    edges = held.agg(F.percentile_approx(F.get("v", F.lit(0)), shares)).first()[0] or []
    each = held.select("constraint_id", F.posexplode("v").alias("draw", "x"))
    level = F.lit(0)
    for i, edge in enumerate(sorted(set(edges))):
        level = F.when(F.col("x") >= edge, i + 1).otherwise(level)
    each = each.withColumn("class", level)
    counts = each.groupBy("draw", "class").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("draw").orderBy(F.col("class").desc())  # at most one row per class in a draw
    reached = counts.withColumn("up_to", F.sum("n").over(down)).where(F.col("up_to") >= k)
    last = reached.groupBy("draw").agg(F.max_by(F.struct("class", (k - F.col("up_to") + F.col("n")).alias("room")), "class").alias("c"))
    # one small struct per draw: the settings bound the array
    limits = cut(last.agg(F.transform(F.array_sort(F.collect_list(F.struct("draw", "c"))), lambda x: x["c"]).alias("limits")))
    judged = each.withColumn("limit", F.get(limits.scalar(), F.col("draw")))
    counted = judged.where(F.col("x") > 0) if positive_only else judged
    sure = counted.where(F.col("class") > F.col("limit.class")).groupBy("constraint_id").agg(F.count(F.lit(1)).alias("hits"))
    order = Window.partitionBy("draw").orderBy(F.col("x").desc(), "constraint_id")
    settled = judged.where(F.col("class") == F.col("limit.class")).withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= F.col("limit.room"))
    if positive_only:
        settled = settled.where(F.col("x") > 0)
    hits = sure.unionByName(settled.groupBy("constraint_id").agg(F.count(F.lit(1)).alias("hits"))).groupBy(
        "constraint_id").agg(F.sum("hits").alias("hits"))
    band = held.select("constraint_id", F.sort_array("v").alias("v")).select("constraint_id", *[
        _linear(F.col("v"), total, p).alias(n) for n, p in (("lo", 0.05), ("expected", 0.5), ("hi", 0.95))])
    return band.join(hits, "constraint_id", "left").select(
        "constraint_id", "lo", "expected", "hi",
        (F.coalesce("hits", F.lit(0)) / F.lit(float(total))).alias("p_top_k"))


def rank_stability(signals: DataFrame, *, weights: dict[str, float] | None = None,
                   draws: int = fixed.DEFAULT_DRAWS, top_fraction: float = fixed.DEFAULT_TOP_FRACTION,
                   seed: int = fixed.DEFAULT_SEED, portable: bool = False) -> DataFrame:
    """P(in the top k) and the composite's p5, p50, p95 for every flowgate."""
    weights = weights or fixed.DEFAULT_WEIGHTS
    kept = cut(signals.select("constraint_id", *[f"sig_{n}" for n in weights]))
    k = top_k(kept.count(), top_fraction)
    found = band_and_share(
        composite_draws(kept, weights=weights, draws=draws, seed=seed, portable=portable), "composite", k, draws)
    return found.select(
        "constraint_id", "p_top_k", F.col("lo").alias("composite_lo"), F.col("expected").alias("composite_expected"),
        F.col("hi").alias("composite_hi"))


def top_k(n: int, fraction: float) -> int:
    """Shortlist size, half-even rounded and never below one."""
    return max(1, round(n * fraction))


def rank_order(by_value: bool) -> list[Column]:
    """The total order of a ranking: expected value first when it ranks, else stability."""
    keys = ([F.col("ev_mean").desc_nulls_last()] if by_value else []) + [
        F.col("p_top_k").desc_nulls_last(), F.col("composite_expected").desc_nulls_last()]
    return keys + [F.col("ord")]


def with_rank(scores: DataFrame, by_value: bool = False) -> DataFrame:
    """Add ``rank``; equal keys keep input order (``ord``)."""
    return ordered_position(scores, rank_order(by_value), name="rank")
