"""The ranking run: checked tables in, ranked flowgates and corridors out."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.functions import text
from fluxsieve.operators import graph, lineage, network, quality, remedies
from fluxsieve.operators.validation import (
    Refused, calibration_mismatch, duplicate_keys, negative_recurring_rent, require_none)
from fluxsieve.plans import corridors, decision, report, scoring, signals
from fluxsieve.session import cut


@dataclass
class Settings:
    """Scoring settings of a run; the defaults rank by composite stability."""

    weights: dict = field(default_factory=lambda: dict(fixed.DEFAULT_WEIGHTS))
    references: dict = field(default_factory=lambda: dict(fixed.DEFAULT_REFERENCES))
    draws: int = fixed.DEFAULT_DRAWS
    top_fraction: float = fixed.DEFAULT_TOP_FRACTION
    seed: int = fixed.DEFAULT_SEED
    by_value: bool = False
    recurring_rent: bool = False
    priors: dict | None = None
    forward: dict | None = None
    #: What references or forward rent were derived from: table name to recorded digest (None: by hand).
    derived_from: dict | None = None

    def __post_init__(self):
        if abs(sum(self.weights.values()) - 1.0) > 1e-6:
            raise ValueError("weights must sum to 1")
        if self.by_value and not self.priors:
            raise ValueError("ranking by value needs priors")
        if self.priors is not None:
            decision.check_priors(self.priors)


def _numbers(df: DataFrame, names: list[str]) -> DataFrame:
    present = [n for n in names if n in df.columns]
    return df.select(*[c for c in df.columns if c not in present],
                     *[text.number(F.col(n)).alias(n) for n in present])


def observed_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """Lines of the skeleton with cross-checked voltage, rating, cost and impedance."""
    skeleton = quality.keep_last(tables["hifld_lines"], ["line_id"], "ord")
    readings = quality.line_readings(tables["hifld_lines"], tables["eia_lines"], tables["ferc1_lines"])
    filed = tables["ferc1_lines"].where(text.blank_to_null(F.col("line_id")).isNotNull())
    attributes = quality.keep_last(
        filed.select("line_id", text.blank_to_null(F.col("conductor")).alias("conductor"),
                     text.number(F.col("thermal_limit_mw")).alias("thermal_limit_mw"),
                     text.number(F.col("cost_usd")).alias("cost_usd"), "ord"), ["line_id"], "ord").drop("ord")
    voltage = quality.triangulate(readings).select("line_id", "kv", "confidence", "flags")
    lines = skeleton.select("line_id", "from_bus", "to_bus", text.number(F.col("length_mi")).alias("length_mi")
                            ).join(voltage, "line_id").join(attributes, "line_id", "left")
    return network.with_rating(network.with_reactance(lines))


#: Key column of each table whose cells become facts, and the tables each signal rests on.
FACT_KEYS = {"constraints": "constraint_id", "congestion": "constraint_id", "planning": "constraint_id",
             "hifld_lines": "line_id", "eia_lines": "line_id", "ferc1_lines": "line_id", "queue": "request_id"}
SIGNAL_TABLES = {"rent": ("congestion",), "persistence": ("congestion",), "cost_of_inaction": ("congestion", "planning"),
                 "planning": ("planning",), "loading": ("hifld_lines", "eia_lines", "ferc1_lines"),
                 "demand_pressure": ("queue",)}


def run_facts(tables: dict[str, DataFrame], stamps: DataFrame) -> DataFrame:
    """Every non-blank cell of the input tables as a fact with its source: lineage_id, table, key, field, source."""
    parts = []
    for name, key in FACT_KEYS.items():
        fields = [c for c in tables[name].columns if c not in (key, "ord")]
        parts.append(lineage.cell_facts(tables[name], name, key, fields, stamps).select(
            "lineage_id", "table", F.col("key").cast("string").alias("key"), "field", "source"))
    return reduce(DataFrame.unionByName, parts)


def run_lineage(tables: dict[str, DataFrame], constraints: DataFrame, lines: DataFrame,
                stamps: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts, nodes, edges): a signal cites the facts of its flowgate in each of its tables; a table that holds
    none for the flowgate is cited itself, with its own stamps. Queue facts are cited through their bus."""
    facts = cut(run_facts(tables, stamps))
    cells = facts.select("table", "key", F.col("lineage_id").alias("parent"))
    ids = constraints.select("constraint_id", "monitored_line")
    uses = F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), F.lit(t).alias("table"))
                               for s, own in SIGNAL_TABLES.items() for t in own])).alias("u")
    wanted = ids.select("constraint_id", "monitored_line", uses).select(
        F.concat(F.lit("signal:"), "u.signal", F.lit(":"), "constraint_id").alias("child"), "u.table",
        F.when(F.col("u.table").isin("congestion", "planning"), F.col("constraint_id"))
        .otherwise(F.col("monitored_line")).alias("key"))
    direct = wanted.where("table <> 'queue'").join(cells, ["table", "key"]).select("child", "table", "parent")
    at_bus = tables["queue"].select(F.col("request_id").alias("key"), F.concat(F.lit("bus:"), "near_bus").alias("bus")).where(
        "bus IS NOT NULL").join(cells.where("table = 'queue'"), "key").select(F.col("bus").alias("child"), "parent")
    ends = lines.select(F.col("line_id").alias("key"), F.explode(F.array("from_bus", "to_bus")).alias("bus"))
    near = wanted.where("table = 'queue'").join(ends, "key").select(
        "child", "table", F.concat(F.lit("bus:"), "bus").alias("parent")).join(
        at_bus.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi").select("child", "table", "parent")
    cited = cut(direct.unionByName(near))
    bare = wanted.select("child", "table").join(cited.select("child", "table").distinct(), ["child", "table"], "left_anti")
    whole = stamps.where("role in ('table', 'contributor')").select(
        "table", F.concat(F.lit("table:"), "table", F.lit(":"), "source").alias("id"), "source").distinct()
    edges = cited.select("child", "parent").unionByName(
        bare.join(whole, "table").select("child", F.col("id").alias("parent"))).unionByName(at_bus).distinct()
    nodes = facts.select(F.col("lineage_id").alias("id"), "source").unionByName(whole.select("id", "source")).unionByName(
        wanted.select(F.col("child").alias("id"), F.lit("signal").alias("source")).distinct()).unionByName(
        at_bus.select(F.col("child").alias("id"), F.lit("bus").alias("source")).distinct())
    return facts, cut(nodes), cut(edges)


def rank_region(tables: dict[str, DataFrame], settings: Settings | None = None,
                table_coverage: dict[str, str] | None = None, stamps: DataFrame | None = None,
                digests: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Rank the flowgates of a region.

    ``tables``: the nine normalized text tables, each with an input ordinal ``ord``, and ``sensitivity``
    (line_id, bus_id, ptdf); flowgates on lines without sensitivities say so in their status.
    ``stamps``: table, role, column, source, source_version, retrieved_at of the tables; with them every score
    says which sources it rests on, and facts, nodes and edges of the lineage are returned too.
    ``digests``: digest of each input table; settings derived from other inputs are refused.
    Returns flowgates (ranked, with every intermediate column), rows (export form),
    corridors and members.
    """
    cfg = settings or Settings()
    for name in cfg.derived_from or {}:
        mismatch = calibration_mismatch(cfg.derived_from, (digests or {}).get(name), name)
        if mismatch:
            raise Refused(f"settings do not belong to this {name}: {mismatch}")
    for name, key in (("constraints", "constraint_id"), ("congestion", "constraint_id"),
                      ("queue", "request_id")):
        require_none(duplicate_keys(tables[name], [key]), f"duplicate {key} in {name}")
    lines = cut(observed_lines(tables))
    buses = _numbers(tables["buses"], ["lat", "lon", "weight", "gen_mw"])
    congestion_rows = _numbers(tables["congestion"], [
        "monthly_cost_musd", "hours_binding", "rent_musd", "max_month_cost_musd", "breached_hours",
        "months_binding", "shadow_price_sum_usd_per_mw"])
    if "shadow_price_sum_usd_per_mw" in congestion_rows.columns:
        congestion_rows = congestion_rows.withColumnRenamed("shadow_price_sum_usd_per_mw", "shadow_price_sum")
    if {"rent_musd", "max_month_cost_musd"} <= set(congestion_rows.columns):
        require_none(negative_recurring_rent(congestion_rows), "largest month exceeds the year")
    constraints = signals.resolve_lines(tables["constraints"], lines).join(
        tables["constraints"].select("constraint_id", "ord"), "constraint_id")
    load = _numbers(tables["load_930"], ["load_mw"])
    screened = network.screen(constraints, lines, network.injections(buses, load),
                              _numbers(tables["sensitivity"], ["ptdf"]).select("line_id", "bus_id", "ptdf"))
    near = graph.queue_near(lines.select("line_id", "from_bus", "to_bus"), _numbers(tables["queue"], ["mw"]))
    plan = signals.planning_items(_numbers(tables["planning"], ["assigned_cost_musd"]))
    built = cut(signals.build_signals(
        constraints, signals.congestion_ranges(congestion_rows), screened, near, plan,
        references=cfg.references, table_coverage=table_coverage, recurring_rent=cfg.recurring_rent))
    radial = graph.radial_lines(lines.select("line_id", "from_bus", "to_bus")).select(
        F.col("line_id").alias("monitored_line"), "radial")
    judged = evidence(built.join(radial, "monitored_line", "left"))
    stable = scoring.rank_stability(built, weights=cfg.weights, draws=cfg.draws,
                                    top_fraction=cfg.top_fraction, seed=cfg.seed)
    scored = cut(judged.join(stable, "constraint_id"))
    if cfg.priors:
        scored = cut(with_value(scored, cfg))
    graph_tables = {}
    if stamps is not None:
        facts, nodes, edges = run_lineage(tables, constraints, lines, stamps)
        trail = source_trail(scored, lineage.source_closure(nodes, edges))
        scored = cut(scored.drop("provenance").join(trail, "constraint_id"))
        graph_tables = {"facts": facts, "nodes": nodes, "edges": edges}
    ranked = cut(scoring.with_rank(scored, cfg.by_value))
    return graph_tables | {"flowgates": ranked, "rows": corridors.export_rows(ranked),
            "corridors": corridors.corridor_rollup(ranked.withColumn(
                "get_shown", remedies.remedy_label(F.col("remedies")))),
            "members": corridors.corridor_members(ranked), "lines": lines, "buses": buses}


def evidence(built: DataFrame) -> DataFrame:
    """Corridor, evidence class, recommended remedy, open set and explanation per flowgate."""
    base = remedies.base_case(F.col("contingency_name"), F.col("contingency_facility"), F.col("contingency_line"))
    df = built.withColumn("base_case", base)
    df = df.withColumn("branch_outage", remedies.branch_outage(
        F.col("base_case"), F.col("contingency_facility"), F.col("contingency_line")))
    seen = F.col("cov_loading") == "observed"
    pick = remedies.recommend(
        F.col("ctype"), F.col("radial"), F.col("sig_persistence.expected"), F.col("sig_loading.expected"), seen,
        F.col("breached_hours"), F.col("base_case"), F.col("branch_outage"))
    rent = F.when(F.col("rent").isNotNull(), "spp_binding_constraints").when(
        F.col("hours").isNotNull(), "unobserved").otherwise("none")
    none = F.array().cast("array<string>")
    return (
        df.withColumn("recommended_get", pick)
        .withColumn("corridor", remedies.corridor(
            F.col("monitored_line"), F.col("monitored_facility"), F.col("constraint_id")))
        .withColumn("evidence", remedies.evidence_class(
            F.col("ctype"), F.col("base_case"), F.col("radial"), F.col("months_binding")))
        .withColumn("remedies", remedies.open_remedies(F.col("ctype"), F.col("radial"), seen, F.col("recommended_get")))
        .withColumn("get_basis", remedies.basis_text(
            F.col("ctype"), F.col("radial"), seen, F.col("breached_hours"), F.col("base_case"),
            F.col("branch_outage"), F.col("recommended_get"), F.col("monitored_facility")))
        .withColumn("provenance", lineage.provenance_line(none, none, rent, F.col("status"), F.col("plan"))))


def with_value(scored: DataFrame, cfg: Settings) -> DataFrame:
    """Attach the value layer; when it ranks, it also sets the stability column."""
    valued = decision.decide(scored.select(
        "constraint_id", F.col("corridor").alias("element"), "evidence", "rent", "months_binding"),
        cfg.priors, cfg.forward)
    band = decision.realized_band(valued, cfg.priors, draws=cfg.draws, top_fraction=cfg.top_fraction,
                                  seed=cfg.seed + 1, forward=cfg.forward).withColumnRenamed("p_top_k", "ev_p_top_k")
    kept = valued.drop("element", "evidence", "rent", "months_binding", "q0", "q1", "q2")
    joined = scored.join(kept, "constraint_id", "left").join(band, "constraint_id", "left")
    if not cfg.by_value:
        return joined.drop("ev_p_top_k")
    return joined.withColumn("p_top_k_composite", F.col("p_top_k")).withColumn(
        "p_top_k", F.coalesce("ev_p_top_k", F.lit(0.0))).drop("ev_p_top_k")


def source_trail(flowgates: DataFrame, closure: DataFrame) -> DataFrame:
    """Provenance per flowgate from the sources its observed and unobserved signals reach.

    ``closure``: node ('signal:<name>:<constraint>'), source. Source sets are as short as the
    registry.
    """
    parts = F.split("node", ":", 3)
    reached = closure.where(F.col("node").startswith("signal:")).select(
        parts[1].alias("signal"), parts[2].alias("constraint_id"), "source")
    status = signals.coverage_long(flowgates)
    sets = reached.join(status, ["constraint_id", "signal"]).groupBy("constraint_id").agg(
        F.collect_set(F.when(F.col("coverage") == "observed", F.col("source"))).alias("used"),
        F.collect_set(F.when(F.col("coverage") == "unobserved", F.col("source"))).alias("asked"))
    rent = F.when(F.col("rent").isNotNull(), "spp_binding_constraints").when(
        F.col("hours").isNotNull(), "unobserved").otherwise("none")
    none = F.array().cast("array<string>")
    return flowgates.join(sets, "constraint_id", "left").select("constraint_id", lineage.provenance_line(
        F.coalesce("used", none), F.coalesce("asked", none), rent, F.col("status"), F.col("plan")).alias("provenance"))


def recompute(recorded: DataFrame, tables: dict[str, DataFrame], settings: Settings, **inputs) -> DataFrame:
    """Run again from recorded inputs and settings: flowgates whose rank, label or band differs from the record.

    ``recorded``: the record's ``report.fingerprint``. Result: constraint_id, recorded and found (structs, null
    where one side lacks the flowgate); empty if the run is reproduced.
    """
    again = report.fingerprint(rank_region(tables, settings, **inputs)["flowgates"])
    return fingerprint_changes(recorded, again)


def fingerprint_changes(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """Flowgates on which two fingerprints differ."""
    def side(df, name):
        return df.select("constraint_id", F.struct(*[c for c in sorted(df.columns) if c != "constraint_id"]).alias(name))

    return side(recorded, "recorded").join(side(found, "found"), "constraint_id", "full").where(
        ~F.col("recorded").eqNullSafe(F.col("found")))
