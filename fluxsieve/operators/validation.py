"""Checks that return the rows breaking a rule; a caller refuses when any comes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from fluxsieve import fixed
from fluxsieve.functions import numeric
from fluxsieve.session import cut


class Refused(ValueError):
    """Input broke a rule that must hold before anything is derived from it."""


def require_none(violations: DataFrame, what: str, show: int = 5) -> None:
    """Raise with a few examples when ``violations`` is not empty."""
    found = violations.limit(show).collect()
    if found:
        raise Refused(f"{what}: " + "; ".join(str(r.asDict()) for r in found))


def settled(df: DataFrame, rules: dict[str, Column], what: str) -> DataFrame:
    """``df`` written to the shared folder, its broken rules counted in the same pass; refused if any row breaks one.

    A null verdict is a pass, as in ``broken_rules``. A recomputed task may count a row twice, which changes the number in
    the message but never whether there is one.
    """
    counts = Observation()
    out = cut(df.observe(counts, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(broken).alias(name) for name, broken in rules.items()]))
    broken = {name: n for name, n in counts.get.items() if name != "rows" and n}
    if broken:
        raise Refused(f"{what}: of {counts.get['rows']} rows " + ", ".join(f"{n} break {name}" for name, n in sorted(broken.items())))
    return out


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def broken_rules(df: DataFrame, id_columns: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule: id columns and the rule's name. A null verdict is a pass."""
    names = F.array_compact(F.array(*[F.when(broken, F.lit(n)) for n, broken in rules.items()]))
    return df.select(*id_columns, F.explode(names).alias("rule"))


def bad_number(c: Column, required: bool) -> Column:
    empty = F.coalesce(c, F.lit("")) == ""
    wrong = ~empty & (~c.rlike(fixed.NUMBER_PATTERN) | F.isnan(c.try_cast("double"))
                      | (F.abs(c.try_cast("double")) == float("inf")))
    return (wrong | empty) if required else wrong


def history_rules() -> dict[str, Column]:
    """Rules of a row of the monthly history table (all columns text)."""
    n = {c: F.col(c).try_cast("double") for c in
         ("hours_binding", "shadow_price_max", "shadow_price_mean", "congestion_cost_usd")}
    cid = F.coalesce("constraint_id", F.lit(""))
    return {
        "constraint_id": (cid == "") | (cid != F.trim(cid)),
        "market": ~F.coalesce("market", F.lit("")).isin(*fixed.MARKETS),
        "period": ~F.coalesce("period", F.lit("")).rlike(fixed.PERIOD_PATTERN),
        "hours_binding": bad_number(F.col("hours_binding"), True) | (n["hours_binding"] <= 0),
        "shadow_price_max": bad_number(F.col("shadow_price_max"), False) | (n["shadow_price_max"] < 0),
        "shadow_price_mean": bad_number(F.col("shadow_price_mean"), False) | (n["shadow_price_mean"] < 0),
        "mean_exceeds_max": n["shadow_price_mean"] > n["shadow_price_max"],
        "congestion_cost_usd": bad_number(F.col("congestion_cost_usd"), False),
    }


def history_violations(history: DataFrame) -> DataFrame:
    """Contract of the monthly history table (all columns text)."""
    keys = ["constraint_id", "market", "period"]
    repeated = duplicate_keys(history, keys).select(*keys, F.lit("repeated").alias("rule"))
    return broken_rules(history, keys, history_rules()).unionByName(repeated)


def coverage_rules() -> dict[str, Column]:
    """Rules of a row of the monthly coverage table (all columns text)."""
    expected, covered = (F.col(c).try_cast("int") for c in ("days_expected", "days_covered"))
    refs = F.when(F.coalesce("raw_refs", F.lit("")) != "", F.split("raw_refs", ";")).otherwise(
        F.array().cast("array<string>"))
    start = numeric.month_start(F.col("period"))
    return {
        "market": ~F.coalesce("market", F.lit("")).isin(*fixed.MARKETS),
        "period": start.isNull(),
        "days_expected": ~F.coalesce("days_expected", F.lit("")).rlike(fixed.COUNT_PATTERN)
        | (expected != numeric.days_in_month(start)),
        "days_covered": ~F.coalesce("days_covered", F.lit("")).rlike(fixed.COUNT_PATTERN)
        | (covered > expected),
        "raw_refs": F.exists(refs, lambda r: (r == "") | (r != F.trim(r)))
        | (F.size(F.array_distinct(refs)) != F.size(refs)),
        "uncited": (covered > 0) & (F.size(refs) <= 0),
    }


def coverage_violations(coverage: DataFrame) -> DataFrame:
    """Contract of the monthly coverage table (all columns text)."""
    keys = ["market", "period"]
    repeated = duplicate_keys(coverage, keys).select(*keys, F.lit("repeated").alias("rule"))
    return broken_rules(coverage, keys, coverage_rules()).unionByName(repeated)


def consistency_violations(history: DataFrame, coverage: DataFrame) -> DataFrame:
    """Binding months outside covered days, or with more hours than those days hold.

    Typed inputs: history (constraint_id, market, period, hours_binding), coverage (market,
    period, days_covered).
    """
    joined = history.join(coverage.select("market", "period", "days_covered"), ["market", "period"], "left")
    days = F.coalesce("days_covered", F.lit(0))
    return broken_rules(joined, ["constraint_id", "market", "period"], {
        "no_covered_days": days == 0,
        "too_many_hours": (days > 0) & (F.col("hours_binding") > 24 * days + fixed.DST_EXTRA_HOURS)})


def footprint_violations(footprint: DataFrame) -> DataFrame:
    """Contract of a footprint (trimmed text columns, blank = missing)."""
    f = {c: F.coalesce(F.trim(F.col(c)), F.lit("")) for c in fixed.FOOTPRINT_COLUMNS}
    verified = f["match_status"] == "verified"
    lacks = F.lit(False)
    for c in ("constraint_id", "evidence", "reviewed_by", "reviewed_on"):
        lacks = lacks | (f[c] == "")
    day = f["reviewed_on"].try_cast("date")
    rules = {
        "element_id": f["element_id"] == "",
        "element_kind": ~f["element_kind"].isin(*fixed.ELEMENT_KINDS),
        "match_status": ~f["match_status"].isin(*fixed.MATCH_STATUSES),
        "verified_without_evidence": verified & lacks,
        "reviewed_on": verified & (f["reviewed_on"] != "") & (
            day.isNull() | (F.date_format(day, "yyyy-MM-dd") != f["reviewed_on"])),
        "uncertain_without_evidence": (f["match_status"] == "uncertain") & (f["evidence"] == ""),
        "unmatched_with_constraint": (f["match_status"] == "unmatched") & (f["constraint_id"] != ""),
    }
    keys = ["element_kind", "element_id", "constraint_id"]
    clean = footprint.select(*[f[c].alias(c) for c in fixed.FOOTPRINT_COLUMNS])
    repeated = duplicate_keys(clean, keys).select(*keys, F.lit("repeated").alias("rule"))
    torn = clean.where("match_status = 'verified' and corridor_id <> ''").groupBy("constraint_id").agg(
        F.min("corridor_id").alias("a"), F.max("corridor_id").alias("b")).where("a <> b").select(
        F.lit("").alias("element_kind"), F.lit("").alias("element_id"), "constraint_id",
        F.lit("several_corridors").alias("rule"))
    return broken_rules(clean, keys, rules).unionByName(repeated).unionByName(torn)


def stamp_violations(stamps: DataFrame) -> DataFrame:
    """Stamps with an empty source or version, or a retrieval time without a zone."""
    when = F.coalesce("retrieved_at_text", F.lit(""))
    zoned = when.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & when.try_cast("timestamp").isNotNull()
    return broken_rules(stamps, ["table", "role", "source"], {
        "source": F.coalesce(F.trim("source"), F.lit("")) == "",
        "source_version": F.coalesce(F.trim("source_version"), F.lit("")) == "",
        "retrieved_at": ~zoned})


def raw_entry_violations(raw: DataFrame) -> DataFrame:
    """Raw inputs without a url, a zoned retrieval time, a digest or a path inside the snapshot."""
    when, path = F.coalesce("retrieved_at", F.lit("")), F.coalesce("path", F.lit(""))
    return broken_rules(raw, ["key"], {
        "url": F.coalesce(F.trim("url"), F.lit("")) == "",
        "retrieved_at": ~(when.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & when.try_cast("timestamp").isNotNull()),
        "sha256": ~F.coalesce("sha256", F.lit("")).rlike("^[0-9a-f]{64}$"),
        "path": (path == "") | path.startswith("/") | path.rlike(r"(^|/)\.\.(/|$)")})


def negative_recurring_rent(congestion: DataFrame) -> DataFrame:
    """Flowgates whose largest month exceeds the year."""
    return congestion.where(F.col("rent_musd") - F.col("max_month_cost_musd") < -1e-9).select(
        "constraint_id", (F.col("rent_musd") - F.col("max_month_cost_musd")).alias("recurring_musd"))


def disordered_ranges(df: DataFrame, column: str, id_column: str) -> DataFrame:
    return df.where(~numeric.ordered_range(F.col(column))).select(id_column, column)


def uncited_refs(coverage: DataFrame, declared: DataFrame) -> DataFrame:
    """Raw inputs a coverage row cites that its table's manifest entry does not declare: market, period, ref.

    ``declared``: table, key (the raw inputs each table is derived from).
    """
    refs = F.filter(F.split("raw_refs", ";"), lambda r: r != "")
    own = declared.where("table = 'constraint_coverage'").select(F.col("key").alias("ref")).distinct()
    return coverage.select("market", "period", F.explode(refs).alias("ref")).join(own, "ref", "left_anti").select(
        "market", "period", "ref")


def uncovered_inputs(declared: DataFrame) -> DataFrame:
    """Raw inputs the history is derived from that the coverage is not: key."""
    own = declared.where("table = 'constraint_history'").select("key").distinct()
    return own.join(declared.where("table = 'constraint_coverage'").select("key"), "key", "left_anti")


def digest_mismatches(recorded: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Artifacts whose recorded digest differs from the one found, or that one side lacks."""
    a = recorded.select(key, F.col("sha256").alias("recorded"))
    b = found.select(key, F.col("sha256").alias("found"))
    return a.join(b, key, "full").where(~F.col("recorded").eqNullSafe(F.col("found")))


def calibration_mismatch(rule: dict | None, digest: str | None, key: str) -> str | None:
    """Why settings derived from one table must not be used with another, or None."""
    if rule is None:
        return None
    want = rule.get(key)
    if not want:
        return f"no {key} is recorded, so the settings cannot be tied to an input"
    return None if want == digest else f"derived from {want[:12]}, this input is {str(digest)[:12]}"
