"""Ranked flowgates as export rows, corridors and map rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.operators.ranking import ordered_position
from fluxsieve.operators.remedies import remedy_label, same_station


def corridor_rollup(ranked: DataFrame) -> DataFrame:
    """One row per corridor: its best-ranked flowgate, member count and sums.

    The members themselves are in ``corridor_members``: a corridor may own any share of all
    flowgates, so its list is rows, not an array. ``ranked``: rank, constraint_id, corridor,
    p_top_k, composite_lo/_expected/_hi, recommended_get, provenance and optional ev_* columns.
    """
    extra = [c for c in ("ev_mean", "ev_lo", "ev_expected", "ev_hi", "ev_get", "get_set", "get_shown",
                         "get_resolved") if c in ranked.columns]
    champion = F.struct("constraint_id", "p_top_k", "composite_lo", "composite_expected", "composite_hi",
                        "recommended_get", "provenance", *extra)

    def total(c):
        return F.sum(F.col(c).cast("decimal(28,12)")).cast("double")

    sums = [F.count(F.lit(1)).alias("n_flowgates"), F.min("rank").alias("_best"),
            F.min_by(champion, "rank").alias("c"), total("p_top_k").alias("expected_topk_slots")]
    sums += [total(f"composite_{x}").alias(f"sum_composite_{x}") for x in ("lo", "expected", "hi")]
    sums += [total(c).alias(f"sum_{c}") for c in ("ev_mean", "ev_expected") if c in ranked.columns]
    rolled = ranked.groupBy(F.col("corridor").alias("physical_corridor")).agg(*sums)
    placed = ordered_position(rolled, [F.col("_best")], name="corridor_rank")
    return placed.select(
        "corridor_rank", "physical_corridor", F.col("c.constraint_id").alias("representative_flowgate"),
        "n_flowgates", "c.p_top_k", "c.composite_lo", "c.composite_expected", "c.composite_hi",
        "expected_topk_slots", "sum_composite_lo", "sum_composite_expected", "sum_composite_hi",
        "c.recommended_get", "c.provenance", *[f"c.{c}" for c in extra],
        *[f"sum_{c}" for c in ("ev_mean", "ev_expected") if c in ranked.columns])


def corridor_members(ranked: DataFrame) -> DataFrame:
    """(physical_corridor, position, constraint_id) of every flowgate, best rank first."""
    placed = ordered_position(ranked.select(F.col("corridor").alias("physical_corridor"), "rank", "constraint_id"),
                              [F.col("rank")], ["physical_corridor"])
    return placed.select("physical_corridor", "position", "constraint_id")


def remedy_columns(remedies: Column) -> list[Column]:
    return [remedy_label(remedies).alias("get_shown"), (F.size(remedies) == 1).alias("get_resolved"),
            F.array_join(remedies, ";").alias("get_set")]


def export_rows(ranked: DataFrame) -> DataFrame:
    """The flat export row of every flowgate: rounded values, signals, coverage and the split.

    A missing number stays null, never a blank or a zero.
    """
    have = set(ranked.columns)

    def rnd(name, places, alias=None):
        value = F.bround(F.col(name).cast("double"), places) if name in have else F.lit(None).cast("double")
        return value.alias(alias or name)

    def as_is(name, alias=None, kind="string"):
        value = F.col(name) if name in have else F.lit(None).cast(kind)
        return value.alias(alias or name)

    columns = [
        F.col("rank"), F.col("constraint_id"), F.col("corridor").alias("physical_corridor"),
        rnd("p_top_k", 4), rnd("composite_lo", 4), rnd("composite_expected", 4), rnd("composite_hi", 4),
        F.col("recommended_get"), *remedy_columns(F.col("remedies")), as_is("status", "screen_status"),
        F.coalesce(as_is("monitored_facility"), F.lit("")).alias("monitored_facility"),
        F.coalesce(as_is("contingency_facility"), F.lit("")).alias("contingency_facility"),
        as_is("get_basis"), as_is("provenance")]
    columns += [F.bround(F.col(f"sig_{n}.expected"), 4).alias(f"sig_{n}") for n in fixed.SIGNALS]
    columns += [F.col(f"cov_{n}") for n in fixed.SIGNALS]
    columns += [
        F.bround("rent.expected", 6).alias("rent_musd"), rnd("shadow_price_sum", 2, "value_of_1mw_relief_usd"),
        F.bround("hours.expected", 1).alias("hours_binding"), rnd("breached_hours", 1),
        as_is("months_binding", kind="int"), rnd("ev_mean", 6, "ev_mean_musd"), rnd("ev_lo", 6, "ev_lo_musd"),
        rnd("ev_expected", 6, "ev_expected_musd"), rnd("ev_hi", 6, "ev_hi_musd"), rnd("p_top_k_composite", 4),
        as_is("ev_get", "ev_recommended_get"), F.col("recommended_get").alias("evidence_rule_get"),
        F.when(same_station(F.col("monitored_facility")), "same_station_ends").otherwise("").alias("caution"),
        as_is("evidence", "get_evidence")]
    columns += [rnd(f"p_best_{s}", 4) for s in fixed.REMEDY_SLUG.values()]
    columns += [rnd(f"ev_from_{s}", 6, f"ev_from_{s}_musd")
                for r, s in fixed.REMEDY_SLUG.items() if r != fixed.NO_REMEDY]
    return ranked.select(*columns)


def top_flowgates(rows: DataFrame, n: int) -> DataFrame:
    """The first n ranks, the report's feature."""
    return rows.orderBy("rank").limit(n)


def filter_rows(rows: DataFrame, *, remedy: str | None = None, min_p: float = 0.0, search: str = "",
                worth: str | None = None, sort: str = "rank", descending: bool = False) -> DataFrame:
    """Interactive filters: remedy set, stability, free text, worth deploying; sort key then rank."""
    kept = rows.where(F.col("p_top_k") >= min_p)
    if remedy:
        kept = kept.where(F.array_contains(F.split("get_set", ";"), remedy))
    if search:
        hay = F.lower(F.concat_ws(" ", "constraint_id", "physical_corridor", "monitored_facility"))
        kept = kept.where(hay.contains(search.lower()))
    if worth is not None:
        pays = F.coalesce(F.col("ev_mean_musd") > 0, F.lit(False))
        kept = kept.where(pays if worth == "yes" else ~pays)
    key = F.col(sort).desc_nulls_last() if descending else F.col(sort).asc_nulls_last()
    return kept.orderBy(key, "rank")


def corridor_segments(corridors: DataFrame, lines: DataFrame, buses: DataFrame) -> DataFrame:
    """Corridor rows with the ends of their line; rows without geometry are kept."""
    def place(prefix, key):
        return buses.select(F.col("bus_id").alias(key), F.col("lat").alias(f"{prefix}_lat"),
                            F.col("lon").alias(f"{prefix}_lon"))

    wires = lines.select(F.col("line_id").alias("physical_corridor"), "from_bus", "to_bus")
    joined = (corridors.join(wires, "physical_corridor", "left").join(place("from", "from_bus"), "from_bus", "left")
              .join(place("to", "to_bus"), "to_bus", "left"))
    both = F.col("from_lat").isNotNull() & F.col("to_lat").isNotNull()
    ends = ("from_lat", "from_lon", "to_lat", "to_lon")
    return joined.select(*corridors.columns, *[F.when(both, F.col(c)).alias(c) for c in ends],
                         both.alias("has_geometry"))


def corridor_detail(corridors: DataFrame, rows: DataFrame) -> DataFrame:
    """Signals and decision split of each corridor's best flowgate in long form:
    (physical_corridor, representative_flowgate, kind, name, value, coverage)."""
    joined = corridors.select("physical_corridor", "representative_flowgate").join(
        rows.withColumnRenamed("constraint_id", "representative_flowgate").drop("physical_corridor"),
        "representative_flowgate")

    def item(kind, name, value, coverage=None):
        return F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), value.cast("double").alias("value"),
                        (coverage if coverage is not None else F.lit(None).cast("string")).alias("coverage"))

    items = [item("signal", n, F.col(f"sig_{n}"), F.col(f"cov_{n}")) for n in fixed.SIGNALS]
    for option, slug in fixed.REMEDY_SLUG.items():
        items.append(item("p_best", option, F.col(f"p_best_{slug}")))
        if option != fixed.NO_REMEDY:
            items.append(item("ev_from_musd", option, F.col(f"ev_from_{slug}_musd")))
    return joined.select("physical_corridor", "representative_flowgate", F.explode(F.array(*items)).alias("i")).select(
        "physical_corridor", "representative_flowgate", "i.*").where("value is not null or kind = 'signal'")


def bus_map_rows(buses: DataFrame, queue: DataFrame) -> DataFrame:
    """Map rows per bus: generation and queued megawatts."""
    waiting = queue.where("near_bus is not null and near_bus <> ''").groupBy(F.col("near_bus").alias("bus_id")).agg(
        F.sum(F.col("mw").cast("decimal(20,6)")).cast("double").alias("queue_mw"), F.count(F.lit(1)).alias("requests"))
    return buses.join(waiting, "bus_id", "left").select(
        "bus_id", "lat", "lon", "gen_mw", F.coalesce("queue_mw", F.lit(0.0)).alias("queue_mw"),
        F.coalesce("requests", F.lit(0)).cast("bigint").alias("requests")
    ).where("gen_mw > 0 or queue_mw > 0")


def map_centre(buses: DataFrame) -> DataFrame:
    return buses.agg(F.coalesce(F.avg("lat"), F.lit(0.0)).alias("lat"),
                     F.coalesce(F.avg("lon"), F.lit(0.0)).alias("lon"))


def page_rows(rows: DataFrame, k: int) -> DataFrame:
    """Compact top-k rows for a page, one JSON text each."""
    return rows.where(F.col("rank") <= k).select(
        "rank", F.to_json(F.struct(
            "rank", "constraint_id", "physical_corridor", F.bround("p_top_k", 3).alias("p_top_k"),
            F.bround("composite_expected", 3).alias("composite_expected"),
            F.bround("rent_musd", 2).alias("rent_musd"), "get_shown",
            F.bround("ev_mean_musd", 3).alias("ev_mean_musd"))).alias("row_json"))


