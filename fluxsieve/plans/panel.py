"""Monthly binding history of a footprint's constraints, with explicit coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.functions import numeric
from fluxsieve.operators.validation import require_none, uncited_refs, uncovered_inputs

VALUES = ("hours_binding", "shadow_price_max", "shadow_price_mean", "congestion_cost_usd")
OPTIONAL = VALUES[1:]
STAGE = "panel.aggregate"


def coverage_class(covered: Column, expected: Column) -> Column:
    return F.when(F.coalesce(covered, F.lit(0)) == 0, "none").when(
        covered == expected, "full").otherwise("partial")


def typed_history(history: DataFrame) -> DataFrame:
    """History text columns as typed values; ``period`` becomes the first of the month."""
    return history.select(
        "constraint_id", "market", numeric.month_start(F.col("period")).alias("period"),
        *[F.nullif(F.col(c), F.lit("")).try_cast("double").alias(c) for c in VALUES],
        "monitored_facility", "contingent_facility",
        *([] if "ord" not in history.columns else ["ord"]))


def typed_coverage(coverage: DataFrame) -> DataFrame:
    return coverage.select(
        "market", numeric.month_start(F.col("period")).alias("period"),
        F.col("days_expected").try_cast("int").alias("days_expected"),
        F.col("days_covered").try_cast("int").alias("days_covered"),
        F.coalesce("raw_refs", F.lit("")).alias("raw_refs"))


def verified(footprint: DataFrame) -> DataFrame:
    return footprint.where("match_status = 'verified'")


def unresolved(footprint: DataFrame) -> DataFrame:
    return footprint.where("match_status <> 'verified'").select(
        "element_id", "element_kind", "constraint_id", "corridor_id", "match_status", "evidence",
        "evidence_refs")


def window_months(coverage: DataFrame, start=None, end=None) -> Column:
    """Every month of the window as an array; by default the covered range."""
    first = F.lit(start).cast("date") if start else F.col("lo")
    last = F.lit(end).cast("date") if end else F.col("hi")
    return coverage.agg(F.min("period").alias("lo"), F.max("period").alias("hi")).select(
        numeric.months_between(first, last)).scalar()


def _markets(coverage: DataFrame) -> Column:
    return coverage.agg(F.array_sort(F.collect_set("market"))).scalar()  # two values at most


def panel_cells(footprint: DataFrame, history: DataFrame, coverage: DataFrame, start=None,
                end=None) -> DataFrame:
    """One row per verified constraint, market and month of the window.

    The dense grid comes from exploding the month and market arrays next to each
    constraint. A covered month without a history row is a derived zero; an uncovered month
    stays unknown.
    """
    grid = (
        verified(footprint).groupBy("constraint_id").agg(F.lit(1).alias("_one")).drop("_one")
        .withColumn("market", F.explode(_markets(coverage)))
        .withColumn("period", F.explode(window_months(coverage, start, end))))
    covered = coverage.select("market", "period", "days_covered", "days_expected", "raw_refs")
    seen = history.select("constraint_id", "market", "period", *VALUES, F.lit(True).alias("listed"))
    joined = grid.join(covered, ["market", "period"], "left").join(
        seen, ["constraint_id", "market", "period"], "left")
    status = coverage_class(F.col("days_covered"), F.col("days_expected"))
    none, listed = F.col("coverage") == "none", F.col("listed").isNotNull()
    unpublished = F.concat_ws("; ", *[
        F.when(F.col(c).isNull(), F.lit(f"{c} not published")) for c in OPTIONAL])
    base = F.concat_ws(":", F.lit("panel"), "market", numeric.month_text(F.col("period")), "constraint_id",
                       F.lit("hours_binding"))
    zero_label = F.concat_ws(":", F.lit("panel.cell"), "market", numeric.month_text(F.col("period")),
                             "constraint_id", F.lit("hours_binding"))
    zero_input = F.array(F.concat_ws(":", F.lit("panel:coverage"), "market", numeric.month_text(F.col("period"))))
    return joined.withColumn("coverage", status).select(
        "constraint_id", "market", "period", "coverage",
        F.coalesce("days_covered", F.lit(0)).alias("days_covered"),
        F.coalesce("days_expected", F.lit(0)).alias("days_expected"),
        F.when(~none, listed).alias("binding"),
        F.when(~none, F.coalesce("hours_binding", F.lit(0.0))).alias("hours_binding"),
        *[F.when(~none, F.col(c)).alias(c) for c in OPTIONAL],
        F.when(none, "no source coverage for this month").when(listed, unpublished).otherwise("").alias("missing"),
        F.when(F.col("coverage") == "partial", "partial_coverage").otherwise("").alias("flags"),
        F.when(F.col("coverage") == "partial", "medium").when(~none, "high").alias("confidence"),
        F.coalesce("raw_refs", F.lit("")).alias("raw_refs"),
        F.when(none, "").when(listed, base).otherwise(numeric.derived_id(zero_label, zero_input)
                                                      ).alias("hours_lineage_id"))


def reported_facilities(history: DataFrame) -> DataFrame:
    """Distinct facility texts per constraint, first seen first. ``history`` carries ord."""
    both = F.concat_ws(" / ", F.nullif("monitored_facility", F.lit("")), F.nullif("contingent_facility", F.lit("")))
    texts = history.withColumn("_t", both).where("_t <> ''").groupBy("constraint_id", "_t").agg(
        F.min("ord").alias("ord"))
    return texts.groupBy("constraint_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("ord", "_t"))), lambda x: x["_t"]), " | ").alias("reported_facilities"))


def footprint_elements(footprint: DataFrame) -> DataFrame:
    """Corridors and elements of each verified constraint."""
    def listed(c):
        return F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit("")))), ";")

    return verified(footprint).groupBy("constraint_id").agg(
        listed("corridor_id").alias("corridor_ids"), listed("element_id").alias("footprint_elements"))


def panel_summary(cells: DataFrame, footprint: DataFrame, history: DataFrame) -> DataFrame:
    """One row per constraint and market. A value appears only when every binding month
    published it. A group holds the months of the window, so its lists are short."""
    text = numeric.month_text(F.col("period"))
    is_none, binds = F.col("coverage") == "none", F.coalesce("binding", F.lit(False))
    hour_ids = F.filter(F.collect_list(F.when(~is_none, F.col("hours_lineage_id"))), lambda x: x != "")
    rolled = cells.groupBy("constraint_id", "market").agg(
        F.min("period").alias("window_start"), F.max("period").alias("window_end"),
        F.count(F.lit(1)).alias("months"), F.count_if(F.col("coverage") == "full").alias("months_full"),
        F.count_if(F.col("coverage") == "partial").alias("months_partial"),
        F.array_join(F.array_sort(F.collect_list(F.when(is_none, text))), ";").alias("months_not_covered"),
        F.count_if(binds).alias("months_binding"),
        F.min(F.when(binds, F.col("period"))).alias("first_binding"),
        F.max(F.when(binds, F.col("period"))).alias("last_binding"),
        F.sum(F.when(~is_none, F.col("hours_binding").cast("decimal(20,6)"))).cast("double").alias("_hours"),
        F.max(F.when(binds, F.col("shadow_price_max"))).alias("_max"),
        F.sum(F.when(binds, F.col("shadow_price_mean") * F.col("hours_binding"))).alias("_weighted"),
        F.sum(F.when(binds, F.col("hours_binding"))).alias("_bound"),
        F.sum(F.when(binds, F.col("congestion_cost_usd").cast("decimal(24,4)"))).cast("double").alias("_cost"),
        *[F.count(F.when(binds, F.col(c))).alias(f"_n_{c}") for c in OPTIONAL], hour_ids.alias("_ids"))
    seen = history.groupBy("constraint_id").agg(F.lit(True).alias("seen"))
    joined = (rolled.join(seen, "constraint_id", "left").join(footprint_elements(footprint), "constraint_id", "left")
              .join(reported_facilities(history), "constraint_id", "left"))
    n = F.col("months_binding")

    def whole(c, value):
        return F.when((n > 0) & (F.col(f"_n_{c}") == n), value).alias(c)

    def gap(c):
        return F.when((n > 0) & (F.col(f"_n_{c}") < n), F.concat(
            F.lit(f"{c}: not published for "), (n - F.col(f"_n_{c}")).cast("string"), F.lit(" of "),
            n.cast("string"), F.lit(" binding months")))

    flags = F.array_compact(F.array(
        F.when(F.col("months_partial") > 0, F.lit("partial_coverage")),
        F.when(F.col("months_not_covered") != "", F.lit("months_not_covered")),
        F.when(F.col("seen").isNull(), F.lit("not_seen_in_source"))))
    confidence = F.when(F.col("seen").isNull(), "low").when(F.size(flags) > 0, "medium").otherwise("high")
    label = F.concat_ws(":", F.lit("panel.summary"), numeric.month_text(F.col("window_start")),
                        numeric.month_text(F.col("window_end")), "market", "constraint_id", F.lit("hours_binding"))
    return joined.select(
        "constraint_id", "market", "corridor_ids", "footprint_elements", "window_start", "window_end",
        "months", "months_full", "months_partial", "months_not_covered", "months_binding",
        "first_binding", "last_binding", F.col("_hours").alias("hours_binding"),
        whole("shadow_price_max", F.col("_max")), whole("shadow_price_mean", F.col("_weighted") / F.col("_bound")),
        whole("congestion_cost_usd", F.col("_cost")),
        F.when(F.col("seen").isNotNull(), "yes").otherwise("no").alias("seen_in_source"),
        confidence.alias("confidence"), F.array_join(flags, ";").alias("flags"),
        F.concat_ws("; ", F.when(F.col("_hours").isNull(), F.lit("hours_binding: no covered months in window")),
                    *[gap(c) for c in OPTIONAL]).alias("missing"),
        F.coalesce("reported_facilities", F.lit("")).alias("reported_facilities"),
        F.when(F.size("_ids") > 0, numeric.derived_id(label, F.col("_ids"))).otherwise("").alias("hours_lineage_id"))


def panel_order(summary: DataFrame) -> DataFrame:
    """Panel order: market, unknown last, hours descending, constraint."""
    return summary.orderBy("market", F.col("hours_binding").isNull(), F.col("hours_binding").desc(), "constraint_id")


def monthly_rows(cells: DataFrame) -> DataFrame:
    """Cells in their export form."""
    return cells.select(
        "constraint_id", "market", numeric.month_text(F.col("period")).alias("period"), "coverage",
        "days_covered", "days_expected",
        F.when(F.col("binding"), "yes").when(~F.col("binding"), "no").otherwise("unknown").alias("binding"),
        *VALUES, "missing", "flags", "raw_refs", "hours_lineage_id")


def coverage_rows(coverage: DataFrame, start=None, end=None) -> DataFrame:
    """Coverage of every market and month of the window, months without a row included."""
    dense = coverage.groupBy("market").agg(F.lit(1).alias("_one")).drop("_one").withColumn(
        "period", F.explode(window_months(coverage, start, end)))
    joined = dense.join(coverage, ["market", "period"], "left")
    return joined.select(
        "market", numeric.month_text(F.col("period")).alias("period"),
        coverage_class(F.col("days_covered"), F.col("days_expected")).alias("coverage"),
        F.coalesce("days_covered", F.lit(0)).alias("days_covered"),
        F.coalesce("days_expected", F.lit(0)).alias("days_expected"),
        F.coalesce("raw_refs", F.lit("")).alias("raw_refs"))


def panel_facts(history: DataFrame, coverage: DataFrame, history_stamp: dict, coverage_stamp: dict) -> DataFrame:
    """Cited facts behind a panel: covered days per month and published values per cell.

    Typed inputs; stamps hold source, source_version and retrieved_at.
    """
    def stamped(stamp):
        return [F.lit(stamp["source"]).alias("source"), F.lit(stamp["source_version"]).alias("source_version"),
                F.lit(stamp["retrieved_at"]).cast("timestamp").alias("retrieved_at")]

    month = numeric.month_text(F.col("period"))
    status = coverage_class(F.col("days_covered"), F.col("days_expected"))
    none = F.array().cast("array<string>")
    days = coverage.select(
        F.concat_ws(":", F.lit("panel:coverage"), "market", month).alias("lineage_id"),
        F.col("days_covered").cast("double").alias("value"), F.lit("days").alias("unit"),
        F.lit("high").alias("confidence"),
        F.when(status == "full", none).otherwise(F.array(F.concat(F.lit("coverage_"), status))).alias("flags"),
        *stamped(coverage_stamp))
    units = {"hours_binding": "h", "shadow_price_max": "USD/MWh", "shadow_price_mean": "USD/MWh",
             "congestion_cost_usd": "USD"}
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).alias("value"), F.lit(u).alias("unit"))
        for c, u in units.items()]))
    partial = F.col("_status") == "partial"
    values = (
        history.join(coverage.select("market", "period", status.alias("_status")),
                     ["market", "period"], "left")
        .select("constraint_id", "market", "period", "_status", cells.alias("c")).where("c.value is not null")
        .select(F.concat_ws(":", F.lit("panel"), "market", month, "constraint_id", "c.field").alias("lineage_id"),
                F.col("c.value").alias("value"), F.col("c.unit").alias("unit"),
                F.when(partial, "medium").otherwise("high").alias("confidence"),
                F.when(partial, F.array(F.lit("partial_coverage"))).otherwise(none).alias("flags"),
                *stamped(history_stamp)))
    return days.unionByName(values)


def check_citations(coverage: DataFrame, declared: DataFrame) -> None:
    """Refuse a panel whose history or coverage rests on raw inputs nothing declares."""
    require_none(uncovered_inputs(declared), "history inputs the coverage does not have")
    require_none(uncited_refs(coverage, declared), "raw inputs missing from the manifest entry")


def source_citations(stamps: DataFrame, declared: DataFrame, raw: DataFrame, registry: DataFrame) -> DataFrame:
    """What a brief cites, one row each: every table's stamp with the raw inputs behind it, and every raw input.

    ``stamps``: table, source, source_version, retrieved_at, sha256. ``declared``: table, key. ``raw``: key, url,
    retrieved_at, sha256. ``registry``: source, publishable, basis; an unregistered source is never publishable.
    Result: kind (table, raw), name, derived_from (null for raw inputs; a row for each), source, source_version,
    url, retrieved_at, sha256, publishable, basis.
    """
    none = F.lit(None).cast("string")
    tables = stamps.join(registry.select("source", "publishable", "basis"), "source", "left").join(
        declared.select("table", F.col("key").alias("derived_from")).distinct(), "table", "left").select(
        F.lit("table").alias("kind"), F.col("table").alias("name"), "derived_from", "source", "source_version",
        none.alias("url"), "retrieved_at", "sha256", F.coalesce("publishable", F.lit(False)).alias("publishable"),
        F.coalesce("basis", F.lit("unregistered source")).alias("basis"))
    used = raw.join(declared.select("key").distinct(), "key", "left_semi").select(
        F.lit("raw").alias("kind"), F.col("key").alias("name"), none.alias("derived_from"), none.alias("source"),
        none.alias("source_version"), "url", "retrieved_at", "sha256", F.lit(None).cast("boolean").alias("publishable"),
        none.alias("basis"))
    return tables.unionByName(used)
