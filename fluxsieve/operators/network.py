"""DC network tables: impedances, ratings, injections, and the N-1 loading screen.

Flows rest on a given table of sensitivities (line_id, bus_id, ptdf): the flow on a line per unit injected at a
bus and withdrawn at the slack; absent rows are zeros. Only the pairs that constraints name are computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.functions import numeric
from fluxsieve.session import cut

ISLANDING = 1e-9


def reactance(length_mi: Column, kv: Column) -> Column:
    """Per-unit series reactance estimated from length and voltage."""
    return F.lit(fixed.OHM_PER_MILE) * length_mi / (kv * kv / fixed.MVA_BASE)


def with_reactance(lines: DataFrame) -> DataFrame:
    x = reactance(F.col("length_mi"), F.col("kv"))
    return lines.withColumn("reactance", numeric.band(x, *fixed.REACTANCE_BAND))


def typical_rating(kv: Column) -> Column:
    """Rating of the nearest nominal voltage; a tie goes to the lower one."""
    table = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(mw).alias("mw"))
                      for v, mw in fixed.TYPICAL_RATING_MW])
    near = F.array_min(F.transform(table, lambda r: F.struct(
        F.abs(r["v"] - kv).alias("d"), r["v"].alias("v"), r["mw"].alias("mw"))))
    return near["mw"]


def with_rating(lines: DataFrame) -> DataFrame:
    """Thermal limit, estimated (and flagged imputed) where none is reported."""
    return lines.withColumn("imputed", F.col("thermal_limit_mw").isNull()).withColumn(
        "thermal_limit_mw", F.coalesce("thermal_limit_mw", typical_rating(F.col("kv"))))


def snapshot_load(load: DataFrame) -> DataFrame:
    return load.groupBy("snapshot").agg(
        F.sum(F.col("load_mw").cast("decimal(24,6)")).cast("double").alias("load_mw"))


def injections(buses: DataFrame, load: DataFrame) -> DataFrame:
    """Balanced injection per (snapshot, bus): load spread by weight over load buses, equal
    generation over generator buses, mean removed."""
    def weight(role):
        total = buses.where(F.col("role") == role).agg(F.sum("weight")).scalar()
        return F.coalesce(F.nullif(total, F.lit(0.0)), F.lit(1.0))

    share = (F.when(F.col("role") == "load", -F.col("weight") / weight("load"))
             .when(F.col("role") == "gen", F.col("weight") / weight("gen")).otherwise(F.lit(0.0)))
    shares = buses.select("bus_id", share.alias("share"))
    centred = shares.withColumn("share", F.col("share") - shares.agg(F.avg("share")).scalar())
    # a load profile has a handful of named snapshots, so the map is small
    totals = snapshot_load(load).agg(F.map_from_entries(F.collect_list(
        F.struct("snapshot", "load_mw")))).scalar()
    return centred.select("bus_id", "share", F.explode(totals).alias("snapshot", "load_mw")).select(
        "snapshot", "bus_id", (F.col("load_mw") * F.col("share")).alias("mw"))


def base_flows(ptdf: DataFrame, inject: DataFrame) -> DataFrame:
    """Base flows per (snapshot, line_id) as a join and a sum."""
    return ptdf.join(inject, "bus_id").groupBy("snapshot", "line_id").agg(
        F.sum(F.col("ptdf") * F.col("mw")).alias("flow"))


def transfers(ptdf: DataFrame, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """Flow on line m per unit sent from one end of line k to the other: (m, k, h) for each given pair."""
    ends = F.explode(F.array(F.struct(F.col("from_bus").alias("bus_id"), F.lit(1.0).alias("sign")),
                             F.struct(F.col("to_bus").alias("bus_id"), F.lit(-1.0).alias("sign")))).alias("e")
    sent = pairs.distinct().join(lines.select(F.col("line_id").alias("k"), ends).select("k", "e.*"), "k")
    at = ptdf.select(F.col("line_id").alias("m"), "bus_id", "ptdf")
    return sent.join(at, ["m", "bus_id"], "left").groupBy("m", "k").agg(
        F.sum(F.col("sign") * F.coalesce("ptdf", F.lit(0.0))).alias("h"))


def screen(constraints: DataFrame, lines: DataFrame, inject: DataFrame, ptdf: DataFrame) -> DataFrame:
    """Loading range and screen status of every flowgate, none dropped.

    ``constraints``: constraint_id, monitored_line, contingency_line (null = none).
    ``lines``: line_id, from_bus, to_bus, thermal_limit_mw (null = unknown).
    ``ptdf``: line_id, bus_id, ptdf. A monitored line without sensitivities has no base flows, a contingency
    line without them counts as unmapped.
    Result: constraint_id, status, loading (lo = min, expected = mean, hi = max).
    """
    known = ptdf.select("line_id").distinct()
    rated = lines.select(F.col("line_id").alias("monitored_line"), "thermal_limit_mw", F.lit(True).alias("placed"))
    placeable = lines.join(known, "line_id", "left_semi").select(
        F.col("line_id").alias("contingency_line"), F.lit(True).alias("ctg_placed"))
    base = constraints.join(rated, "monitored_line", "left").join(placeable, "contingency_line", "left")
    base = cut(base)
    both = base.where("placed and ctg_placed").select(
        F.col("monitored_line").alias("m"), F.col("contingency_line").alias("k")).distinct()
    moved = cut(transfers(ptdf, lines, both.unionByName(both.select(F.col("k").alias("m"), "k"))))
    own = moved.where("m = k").select(F.col("k").alias("contingency_line"), F.col("h").alias("h_kk"))
    cross = moved.select(F.col("k").alias("contingency_line"), F.col("m").alias("monitored_line"), F.col("h").alias("h_mk"))
    watched = base.where("placed").select(F.col("monitored_line").alias("line_id")).unionByName(
        both.select(F.col("k").alias("line_id"))).distinct()
    snap = cut(base_flows(ptdf.join(watched, "line_id", "left_semi"), inject))
    paired = (
        base.join(own, "contingency_line", "left")
        .join(cross, ["contingency_line", "monitored_line"], "left")
        .join(snap.select(F.col("line_id").alias("monitored_line"), "snapshot",
                          F.col("flow").alias("f_m")), "monitored_line", "left")
        .join(snap.select(F.col("line_id").alias("contingency_line"), "snapshot",
                          F.col("flow").alias("f_k")), ["contingency_line", "snapshot"], "left"))
    islands = F.abs(1 - F.col("h_kk")) < ISLANDING
    lodf = F.try_divide(F.col("h_mk"), 1 - F.col("h_kk"))
    after = F.when(F.col("monitored_line") == F.col("contingency_line"), F.lit(0.0)).otherwise(
        F.col("f_m") + lodf * F.col("f_k"))
    ratio = F.when(F.col("thermal_limit_mw") > 0, F.lit(1.0) / F.col("thermal_limit_mw"))
    # one row per snapshot and flowgate reaches the aggregation: a handful per group
    seen = paired.groupBy("constraint_id").agg(
        F.first("placed").alias("placed"), F.first("thermal_limit_mw").alias("thermal"),
        F.first("contingency_line").alias("contingency_line"), F.first("ctg_placed").alias("ctg_placed"),
        F.max(islands).alias("islands"), F.count("f_m").alias("snapshots"),
        *[g(F.abs("f_m") * ratio).alias(f"base_{n}") for n, g in (("lo", F.min), ("mid", F.avg), ("hi", F.max))],
        *[g(F.when(~islands, F.abs(after) * ratio)).alias(f"n1_{n}")
          for n, g in (("lo", F.min), ("mid", F.avg), ("hi", F.max))])
    named = F.col("contingency_line").isNotNull()
    status = (
        F.when(F.col("placed").isNull(), "unmapped_monitored")
        .when(F.coalesce("thermal", F.lit(0.0)) == 0, "no_thermal_limit")
        .when(F.col("snapshots") == 0, "no_base_flows")
        .when(named & F.col("ctg_placed").isNull(), "contingency_unmapped")
        .when(named & F.col("islands"), "n1_disconnect").otherwise("ok"))
    zero, one, two = F.lit(0.0), F.lit(1.0), F.lit(2.0)
    indeterminate = F.col("status").isin("no_thermal_limit", "no_base_flows")
    widened = F.col("status").isin("contingency_unmapped", "n1_disconnect")
    chosen = F.when(named, numeric.range_of(F.col("n1_lo"), F.col("n1_mid"), F.col("n1_hi"))).otherwise(
        numeric.range_of(F.col("base_lo"), F.col("base_mid"), F.col("base_hi")))
    loading = (
        F.when(F.col("status") == "unmapped_monitored", numeric.range_of(zero, zero, zero))
        .when(indeterminate, numeric.range_of(zero, one, two))
        .when(widened, numeric.range_of(F.col("base_lo") * 0.8, F.col("base_mid"), F.col("base_hi") * 1.5))
        .otherwise(chosen))
    return seen.withColumn("status", status).select("constraint_id", "status", loading.alias("loading"))


def over_limit(loading: Column) -> Column:
    return F.when(loading["hi"] > 1.0, F.lit("binds_under_n1"))
