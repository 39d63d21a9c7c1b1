"""Congestion ranges, planning items and the six signals of a flowgate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.functions import numeric, text
from fluxsieve.operators.quality import keep_last

RANGE = "struct<lo:double,expected:double,hi:double>"


def congestion_ranges(rows: DataFrame) -> DataFrame:
    """Rent, hours and recurring rent ranges per flowgate.

    ``rows``: constraint_id, hours_binding and any of monthly_cost_musd, rent_musd,
    max_month_cost_musd, shadow_price_sum, breached_hours, months_binding (doubles). A
    monthly cost is annualized; else observed rent is used; a blank rent is unobserved where
    the column exists, and only a table without the column falls back to assumed ratings.
    """
    have = set(rows.columns)

    def col(name):
        return F.col(name).cast("double") if name in have else F.lit(None).cast("double")

    observed, monthly, largest = col("rent_musd"), col("monthly_cost_musd"), col("max_month_cost_musd")
    lo, hi = fixed.FORWARD_BAND
    signed = numeric.range_of(F.least(observed * lo, observed * hi), observed,
                              F.greatest(observed * lo, observed * hi))
    rent = F.when(monthly.isNotNull(), numeric.band(monthly * 12.0, lo, hi)).when(
        observed.isNotNull(), signed)
    if "rent_musd" not in have:
        low_mw, mid_mw, high_mw = fixed.RATING_MW_UNOBSERVED
        price = col("shadow_price_sum")
        rent = rent.otherwise(numeric.range_of(
            price * (lo * low_mw / 1e6), price * (mid_mw / 1e6), price * (hi * high_mw / 1e6)))
    # greatest() skips nulls, so a missing month must be tested before it
    recurring = F.when(observed.isNotNull() & largest.isNotNull(), F.greatest(observed - largest, F.lit(0.0)))
    return rows.select(
        "constraint_id", rent.cast(RANGE).alias("rent"),
        numeric.band(col("hours_binding"), *fixed.HOURS_BAND).alias("hours"),
        F.when(recurring.isNotNull(), numeric.band(recurring, lo, hi)).alias("recurring"),
        col("breached_hours").alias("breached_hours"), col("months_binding").cast("int").alias("months_binding"),
        col("shadow_price_sum").alias("shadow_price_sum"))


def planning_items(rows: DataFrame) -> DataFrame:
    """Last plan item per flowgate with a cost range. ``rows``: constraint_id, plan,
    proposed_fix, assigned_cost_musd, ord."""
    last = keep_last(rows, ["constraint_id"], "ord")
    providers = F.create_map(*[F.lit(x) for kv in fixed.PLAN_PROVIDER.items() for x in kv])
    return last.select(
        "constraint_id", "plan", "proposed_fix",
        F.coalesce(providers[F.col("plan")], F.lit("spp_itp")).alias("provider"),
        numeric.band(F.col("assigned_cost_musd").cast("double"), *fixed.PLAN_COST_BAND).alias("plan_cost"))


def resolve_lines(constraints: DataFrame, lines: DataFrame) -> DataFrame:
    """Constraints with their monitored line where the network knows it, else null and
    coverage 'unobserved'; nothing is dropped."""
    known = lines.select(F.col("line_id").alias("_line"))
    wanted = text.blank_to_null(F.col("monitored_line"))
    joined = constraints.withColumn("_want", wanted).join(known, F.col("_want") == F.col("_line"), "left")

    def optional(name):
        return text.blank_to_null(F.col(name)) if name in constraints.columns else F.lit(None).cast("string")

    return joined.select(
        "constraint_id", "ctype", F.col("_line").alias("monitored_line"),
        optional("contingency_line").alias("contingency_line"),
        F.coalesce(optional("monitored_facility"), F.col("_want")).alias("monitored_facility"),
        optional("contingency_facility").alias("contingency_facility"),
        optional("contingency_name").alias("contingency_name"),
        F.when(F.col("_line").isNotNull(), "observed").otherwise("unobserved").alias("coverage"))


def build_signals(constraints: DataFrame, congestion: DataFrame, loading: DataFrame,
                  near: DataFrame, planning: DataFrame, *, references: dict | None = None,
                  table_coverage: dict[str, str] | None = None,
                  recurring_rent: bool = False) -> DataFrame:
    """Six normalized signals per flowgate with coverage, from plain key joins.

    ``near``: line_id, mw. Adds sig_<name> (range), cov_<name> and why_<name>. An
    unobserved signal is a zero range that says so; a flowgate missing from a covered table
    is an observed zero with a small band. Lines are joined first, while rows are narrow; all other
    joins share one key.
    """
    refs = {**fixed.DEFAULT_REFERENCES, **(references or {})}
    coverage = table_coverage or {}
    joined = (
        constraints
        .join(near.select(F.col("line_id").alias("monitored_line"), F.col("mw").alias("queue_mw")),
              "monitored_line", "left")
        .join(congestion.withColumn("has_congestion", F.lit(True)), "constraint_id", "left")
        .join(loading, "constraint_id", "left")
        .join(planning.select("constraint_id", "plan", "plan_cost"), "constraint_id", "left"))
    last = ["queue_mw", "plan", "plan_cost"]
    joined = joined.select(*[c for c in joined.columns if c not in last], *last)
    has = F.coalesce("has_congestion", F.lit(False))
    nothing = numeric.range_of(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    absent = numeric.spread(F.lit(0.0))

    def missing(table):
        return coverage.get(table) == "unobserved"

    def off_table(table: str, reason: str) -> tuple[Column, Column]:
        """Range and reason for a flowgate the table does not list."""
        if missing(table):
            return nothing, F.lit(fixed.UNOBSERVED_TEXT[reason])
        return absent, F.lit(None).cast("string")

    def pick(cases: list[tuple[Column, Column, Column]], last: tuple[Column, Column]):
        value, why = last
        for cond, v, w in reversed(cases):
            value, why = F.when(cond, v).otherwise(value), F.when(cond, w).otherwise(why)
        return value, why

    seen = F.lit(None).cast("string")
    out: dict[str, tuple[Column, Column]] = {}
    gone = off_table("congestion", "congestion")
    no_rent = F.lit(fixed.UNOBSERVED_TEXT["rent"])
    rent, hours = F.col("rent"), F.col("hours")
    out["rent"] = pick([
        (has & rent.isNotNull(), numeric.scaled(rent, refs["rent_ref_musd"]), seen),
        (has, nothing, no_rent)], gone)
    out["persistence"] = pick([(has, numeric.scaled(hours, refs["persist_ref_hours"]), seen)], gone)
    out["loading"] = pick(
        [(F.col("status") == "unmapped_monitored", nothing, F.lit(fixed.UNOBSERVED_TEXT["loading"]))],
        (numeric.scaled(F.col("loading"), refs.get("loading_ref", 1.0)), seen))
    out["demand_pressure"] = pick(
        [(F.col("monitored_line").isNull(), nothing, F.lit(fixed.UNOBSERVED_TEXT["location"])),
         (F.lit(missing("queue")), nothing, F.lit(fixed.UNOBSERVED_TEXT["queue"]))],
        (numeric.spread(F.coalesce("queue_mw", F.lit(0.0)) / refs["demand_ref_mw"]), seen))
    level = F.least(F.lit(1.0), F.col("plan_cost.expected") / refs["planning_cost_ref_musd"])
    named = numeric.range_of(F.lit(0.7), F.greatest(F.lit(0.7), 0.5 + 0.5 * level), F.lit(1.0))
    out["planning"] = pick([(F.col("plan_cost").isNotNull(), named, seen)], off_table("planning", "planning"))
    d = F.lit(float(refs["coi_ref_musd"]))
    if recurring_rent:
        coi_cases = [(has & F.col("recurring").isNotNull(),
                      numeric.scaled(F.col("recurring"), refs["coi_ref_musd"]), seen),
                     (has, nothing, F.lit(fixed.UNOBSERVED_TEXT["recurring"]))]
    else:
        product = numeric.range_of(*[
            rent[k] * (hours[k] / fixed.HOURS_PER_YEAR) / d for k in ("lo", "expected", "hi")])
        coi_cases = [(has & rent.isNotNull(), product, seen), (has, nothing, no_rent)]
    out["cost_of_inaction"] = pick(coi_cases, gone)
    columns = []
    for name in fixed.SIGNALS:
        value, why = out[name]
        columns += [value.cast(RANGE).alias(f"sig_{name}"),
                    F.when(why.isNull(), "observed").otherwise("unobserved").alias(f"cov_{name}"),
                    why.alias(f"why_{name}")]
    return joined.select("*", *columns).drop("has_congestion")


def coverage_long(signals: DataFrame) -> DataFrame:
    """(constraint_id, signal, coverage) rows."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(n).alias("signal"), F.col(f"cov_{n}").alias("coverage")) for n in fixed.SIGNALS]))
    return signals.select("constraint_id", entries.alias("e")).select("constraint_id", "e.*")
