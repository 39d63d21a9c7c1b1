"""Hourly binding rows and monthly dollars rolled up to flowgates.

Rows are laid out by flowgate once, and no step shuffles them again. Those of a flowgate that is too
large for one task are aggregated map-side before every shuffle; no aggregate buffers a group, so a
flowgate that owns a third of all rows costs one partial row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve import fixed
from fluxsieve.functions import numeric, text
from fluxsieve.session import shelve

MONEY = "decimal(20,4)"
FLOWGATE = ["name", "contingency"]
HOUR_KEY = ["utc", "name", "monitored", "contingency"]
HOUR_FIELDS = [*HOUR_KEY, "price", "state", "contingent", "kind", "month", "ord"]
#: Hash classes in which the rows of flowgates are counted, and the rows of a class that are never too many for one task.
CLASSES, FEW = 1 << 16, 100_000


def by_flowgate(rows: DataFrame) -> list[DataFrame]:
    """``rows`` in parts that share no flowgate, the first laid out by flowgate.

    Groupings whose keys hold the flowgate find the first part's rows in place. Where one task would get more rows of
    a flowgate than a whole partition should have, they are in a second part, which lies as ``rows`` did: there
    every grouping combines rows before it shuffles them. ``rows`` are read twice.
    """
    number = F.pmod(F.xxhash64(*FLOWGATE), F.lit(CLASSES))
    share = rows.count() // int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(number.alias("class")).agg(F.count(F.lit(1)).alias("n"))
    # each holds more than a partition's share of the rows, so there are fewer of them than partitions
    crowded = [r["class"] for r in counts.where(F.col("n") > max(FEW, share)).collect()]
    if not crowded:
        return [rows.repartition(*FLOWGATE)]
    return [rows.where(~number.isin(crowded)).repartition(*FLOWGATE), rows.where(number.isin(crowded))]


def united(parts: list[DataFrame]) -> DataFrame:
    """Parts that share no flowgate as one."""
    return reduce(DataFrame.unionByName, parts)


def keep_first_hours(hours: DataFrame) -> DataFrame:
    """One row per (hour, name, monitored, contingency): the one with the lowest ordinal.

    ``hours``: name, contingency, monitored, contingent, kind, state, price, utc, month, ord.
    """
    payload = ["price", "state", "contingent", "kind", "month", "ord"]
    first = F.min_by(F.struct(*payload), F.col("ord")).alias("_r")
    # a leading hash makes the aggregation's sort compare one long instead of four texts
    return hours.groupBy(F.xxhash64(*HOUR_KEY).alias("_h"), *HOUR_KEY).agg(first).select(*HOUR_KEY, "_r.*")


def duplicate_hours(hours: DataFrame) -> DataFrame:
    """How many rows repeat a key, and how many of those carry another payload than the first."""
    payload = ["price", "state", "contingent"]
    alike = hours.groupBy(*HOUR_KEY, *payload).agg(
        F.count(F.lit(1)).alias("c"), F.min("ord").alias("ord"))
    per_key = alike.groupBy(*HOUR_KEY).agg(
        F.sum("c").alias("n"), F.min_by("c", "ord").alias("same"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
        F.coalesce(F.sum(F.col("n") - F.col("same")), F.lit(0)).cast("bigint").alias("conflicting"))


def flowgate_hours(kept: DataFrame) -> DataFrame:
    """Distinct hours, breached hours, months, and price totals per flowgate."""
    size = F.abs("price").cast(MONEY)
    per_hour = kept.groupBy("name", "contingency", "utc").agg(
        F.max((F.col("state") == "BREACHED").cast("int")).alias("breached"),
        F.sum(size).alias("total"), F.max(size).alias("largest"), F.max("month").alias("month"))
    return (
        per_hour.groupBy("name", "contingency")
        .agg(F.count(F.lit(1)).alias("hours_binding"),
             F.sum("breached").cast("bigint").alias("breached_hours"),
             F.countDistinct("month").alias("months_binding"),
             F.sum("total").cast("double").alias("shadow_price_sum"),
             F.max("largest").cast("double").alias("max_abs_shadow_price"))
        .withColumn("constraint_id", numeric.constraint_id(F.col("name"), F.col("contingency")))
    )


def flowgate_texts(kept: DataFrame) -> DataFrame:
    """Most frequent monitored element, contingent facility and constraint type per flowgate."""
    keys = ["name", "contingency"]
    fields = ["monitored", "contingent", "kind"]
    spelled = F.explode(F.array(*[
        F.struct(F.lit(i).alias("field"), F.col(c).alias("value")) for i, c in enumerate(fields)]))
    counts = (
        kept.groupBy(*keys, *fields).agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_n", spelled.alias("s")).groupBy(*keys, "s.field", "s.value")
        .agg(F.sum("_n").alias("_n")))
    best = F.struct((-F.col("_n")).alias("c"), F.col("value").alias("v"))
    return counts.groupBy(*keys).agg(
        *[F.min(F.when(F.col("field") == i, best)).alias(f"_{c}") for i, c in enumerate(fields)],
        *[F.count_if(F.col("field") == i).alias(f"n_{c}") for i, c in enumerate(fields)]
    ).select(*keys, *[F.col(f"_{c}.v").alias(c) for c in fields], *[f"n_{c}" for c in fields])


def constraint_type(element: Column) -> Column:
    return (F.when(element == "ln", "thermal").when(element == "xfmr", "transformer")
            .otherwise("interface"))


def exclusion_reason(element: Column, name: Column) -> Column:
    """Why a flowgate is left out: unknown element, or a phase shifter's own limit."""
    return (F.when(element == "other", "other")
            .when((element == "blank") & name.contains(fixed.PHASE_SHIFTER_MARK), "phase_shifter"))


def flowgates(hours: DataFrame) -> DataFrame:
    """All flowgates with roll-up, element class, corridor key and exclusion reason."""
    parts = by_flowgate(shelve(hours.select(*HOUR_FIELDS)))
    return united([flowgates_of(keep_first_hours(p)) for p in parts])


def flowgates_of(kept: DataFrame) -> DataFrame:
    """The same from hours already deduplicated by ``keep_first_hours``."""
    both = flowgate_hours(kept).join(flowgate_texts(kept), ["name", "contingency"])
    element = text.element_class(F.col("monitored"))
    return (
        both.withColumn("element", element)
        .withColumn("excluded", exclusion_reason(F.col("element"), F.col("name")))
        .withColumn("ctype", constraint_type(F.col("element")))
        .withColumn("monitored_facility", text.facility_key(
            F.col("element"), F.col("monitored"), F.col("name")))
        .withColumn("contingency_to", text.contingency_owner(F.col("contingent")))
        .withColumn("contingency_kv", text.contingency_kv(F.col("contingent")))
    )


def exclusion_summary(rolled: DataFrame) -> DataFrame:
    """Flowgates, hours and share of absolute price by exclusion reason ('kept' otherwise)."""
    by_reason = (
        rolled.groupBy(F.coalesce("excluded", F.lit("kept")).alias("reason"))
        .agg(F.count(F.lit(1)).alias("flowgates"), F.sum("hours_binding").alias("hours"),
             F.sum(F.col("shadow_price_sum").cast("decimal(28,4)")).alias("abs_price"))
    )
    total = by_reason.agg(F.sum("abs_price")).scalar()
    return by_reason.select(
        "reason", "flowgates", "hours", F.col("abs_price").cast("double").alias("abs_price"),
        (F.col("abs_price").cast("double") / total.cast("double")).alias("share"))


def spellings(kept: DataFrame) -> DataFrame:
    """Every monitored spelling of each flowgate once, with its count ``_n``."""
    return kept.groupBy("name", "contingency", "monitored").agg(F.count(F.lit(1)).alias("_n"))


def spelling_summary(kept: DataFrame) -> DataFrame:
    """Flowgates with several monitored spellings, those that differ only in endpoint order,
    and those whose spellings fall in several element classes."""
    spelled = (
        spellings(kept)
        .withColumn("element", text.element_class(F.col("monitored")))
        .withColumn("key", text.element_key(F.col("monitored")))
    )
    per = spelled.groupBy("name", "contingency").agg(
        F.count(F.lit(1)).alias("spellings"),
        (F.min("key") == F.max("key")).alias("same_line"),
        (F.min("element") != F.max("element")).alias("mixed"))
    return per.agg(
        F.count_if(F.col("spellings") > 1).alias("several_spellings"),
        F.count_if((F.col("spellings") > 1) & F.col("same_line")).alias("reversed_only"),
        F.count_if("mixed").alias("mixed_elements"))


# --- dollars --------------------------------------------------------------------------

DOLLAR_KEY = ["month", "name", "contingency"]


def dollar_duplicates(dollars: DataFrame) -> DataFrame:
    """Keys that occur more than once, with whether their values disagree."""
    return (
        dollars.groupBy(*DOLLAR_KEY)
        .agg(F.count(F.lit(1)).alias("copies"), (F.min("amount") != F.max("amount")).alias("conflict"))
        .where("copies > 1")
    )


def unique_dollars(dollars: DataFrame) -> DataFrame:
    """One row per (month, name, contingency); run ``dollar_duplicates`` first to refuse conflicts.

    ``dollars``: month, name, contingency, monitored, amount (posted negative), ord.
    """
    # one struct, so that all uses of the result shuffle the same columns, and share one shuffle
    first = F.min_by(F.struct("monitored", "amount"), F.col("ord")).alias("_r")
    return dollars.groupBy(*DOLLAR_KEY).agg(first).select(*DOLLAR_KEY, "_r.*").withColumn(
        "usd", -F.col("amount").cast(MONEY))


def flowgate_dollars(unique: DataFrame) -> DataFrame:
    """Annual rent, largest month and count of negative months; negative months never net."""
    kept = F.when(F.col("usd") >= 0, F.col("usd"))
    return (
        unique.groupBy("name", "contingency")
        .agg(F.sum(kept).cast("double").alias("rent_usd"),
             F.max(kept).cast("double").alias("max_month_usd"),
             F.count(kept).alias("months_paid"),
             F.count_if(F.col("usd") < 0).alias("negative_months"))
        .withColumn("constraint_id", numeric.constraint_id(F.col("name"), F.col("contingency")))
    )


def reconcile_months(unique: DataFrame, settled: DataFrame, joined_share: Column | float) -> DataFrame:
    """Violations of the monthly dollar checks; empty when the dollars can be trusted.

    ``settled``: month, collected. One row per finding: (check, month, detail value).
    """
    paid = unique.where("usd >= 0").groupBy("month").agg(F.sum("usd").cast("double").alias("cbc"))
    due = settled.groupBy("month").agg(F.sum(F.col("collected").cast(MONEY)).cast("double").alias("tcr"))
    months = paid.join(due, "month", "full").select(
        "month", F.coalesce("cbc", F.lit(0.0)).alias("cbc"), F.coalesce("tcr", F.lit(0.0)).alias("tcr"))
    usable = (F.col("cbc") > 0) & (F.col("tcr") > 0)
    rated = months.withColumn("ratio", F.when(usable, F.col("cbc") / F.col("tcr")))
    # the list holds one ratio per calendar month, so its size is bounded by the period
    ratios = F.array_sort(F.collect_list("ratio"))
    median = rated.agg(F.get(ratios, F.floor(F.size(ratios) / 2).cast("int"))).scalar()
    lo, hi = fixed.MONTH_RATIO_BAND
    mlo, mhi = fixed.MONTH_RATIO_VS_MEDIAN
    inside = F.col("ratio").between(lo, hi)
    checked = rated.withColumn("median", median).withColumn(
        "check",
        F.when(F.col("ratio").isNull(), "no_dollars")
        .when(~inside, "ratio_outside_band")
        .when(~F.col("ratio").between(F.lit(mlo) * F.col("median"), F.lit(mhi) * F.col("median")),
              "ratio_far_from_median"))
    by_month = checked.where("check is not null").select(
        "check", F.col("month"), F.col("ratio").alias("value"))
    share = joined_share if isinstance(joined_share, Column) else F.lit(float(joined_share))
    floor = months.limit(1).select(
        F.lit("joined_share_below_floor").alias("check"),
        F.lit(None).cast(unique.schema["month"].dataType).alias("month"), share.alias("value")
    ).where(F.col("value") < fixed.JOIN_SHARE_FLOOR)
    return by_month.unionByName(floor)


def join_dollars(rolled: DataFrame, kept: DataFrame, unique: DataFrame) -> DataFrame:
    """Attach dollars to flowgates by name and contingency, refused where the monitored
    element differs (a recycled id).

    Of ``kept`` only name, contingency and monitored are used, once each, so its ``spellings`` do as well.
    """
    keys = ["name", "contingency"]

    def elements(df):
        return df.groupBy(*keys, text.element_key(F.col("monitored")).alias("element_key")).agg(
            F.lit(1).alias("_one"))

    same = (elements(unique).join(elements(kept), [*keys, "element_key"], "left_semi")
            .groupBy(*keys).agg(F.lit(True).alias("same_element")))
    money = flowgate_dollars(unique).drop("constraint_id").join(same, keys, "left")
    known = F.col("negative_months").isNotNull()
    mismatch = known & F.col("same_element").isNull()
    joined = known & F.col("same_element").isNotNull() & (F.col("months_paid") > 0)
    negative = F.when(F.col("negative_months") > 0, F.concat(
        F.lit("cbc_negative_rent_months="), F.col("negative_months").cast("string")))
    return (
        rolled.join(money, keys, "left")
        .withColumn("rent_musd", F.when(joined, F.bround(F.col("rent_usd") / 1e6, 6)))
        .withColumn("max_month_cost_musd", F.when(joined, F.bround(F.col("max_month_usd") / 1e6, 6)))
        .withColumn("rent_basis", F.when(joined, F.lit("spp_congestion_by_constraint")))
        .withColumn("flags", F.concat_ws(
            ";", F.when(mismatch, F.lit("cbc_monitored_mismatch")), negative))
        .drop("rent_usd", "max_month_usd", "months_paid", "negative_months", "same_element")
    )


def joined_price_share(joined: DataFrame) -> Column:
    """Share of kept absolute price whose flowgates found a dollar row."""
    kept = joined.where("excluded is null")
    return kept.agg(
        F.coalesce(F.sum(F.when(F.col("rent_musd").isNotNull(), F.col("shadow_price_sum")))
                   / F.nullif(F.sum("shadow_price_sum"), F.lit(0.0)), F.lit(0.0))).scalar()


# --- balancing-authority hours ----------------------------------------------------------

def first_number(df: DataFrame, names: tuple[str, ...]) -> tuple[Column, Column, Column]:
    """Value, text as reported and column name of the first column that holds a number."""
    present = [n for n in names if n in df.columns]
    value = text_ = column = F.lit(None)
    for n in reversed(present):
        raw = text.blank_to_null(F.regexp_replace(F.col(f"`{n}`"), ",", ""))
        parsed = text.number(F.col(f"`{n}`"))
        ok = raw.isNotNull() & parsed.isNotNull()
        value, text_, column = (F.when(ok, parsed).otherwise(value), F.when(ok, raw).otherwise(text_),
                                F.when(ok, F.lit(n)).otherwise(column))
    return value.cast("double"), text_.cast("string"), column.cast("string")


def wind_output(df: DataFrame, groups=fixed.WIND_COLUMN_GROUPS) -> Column:
    """Wind output from the first column group that holds anything; parts add up."""
    out = F.lit(None).cast("double")
    for group in reversed([g for g in groups if all(n in df.columns for n in g)]):
        parts = [text.blank_to_null(F.col(f"`{n}`")) for n in group]
        values = [text.number(F.col(f"`{n}`")) for n in group]
        unreadable = F.lit(False)
        for p, v in zip(parts, values):
            unreadable = unreadable | (p.isNotNull() & v.isNull())
        total = sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0))
        any_value = F.coalesce(*parts).isNotNull()
        out = F.when(any_value, F.when(~unreadable, total)).otherwise(out)
    return out


def authority_hours(rows: DataFrame) -> DataFrame:
    """Demand (adjusted, else raw) and wind share of net generation per hour.

    ``rows`` has ba, utc and the published demand, generation and wind columns.
    """
    demand, reported, column = first_number(rows, fixed.DEMAND_COLUMNS)
    netgen, _, _ = first_number(rows, fixed.NET_GENERATION_COLUMNS)
    return (
        rows.select("ba", "utc", demand.alias("demand"), reported.alias("demand_text"),
                    column.alias("demand_column"), netgen.alias("netgen"),
                    wind_output(rows).alias("wind"))
        .withColumn("wind_share", F.when(F.col("netgen") > 0, F.col("wind") / F.col("netgen")))
        .drop("netgen", "wind")
    )


def representative_hours(hours: DataFrame) -> DataFrame:
    """Peak, off-peak, lower-median and windiest hour per authority, with fixed tie rules.

    ``hours`` has one row per (ba, utc), so a group is bounded by the calendar.
    """
    from pyspark.sql import Window

    known = hours.where("demand is not null")
    by_demand = Window.partitionBy("ba").orderBy("demand", "utc")
    whole = Window.partitionBy("ba")
    ranked = known.withColumn("_r", F.row_number().over(by_demand)).withColumn(
        "_n", F.count(F.lit(1)).over(whole))
    row = F.struct("utc", "demand", "demand_text", "demand_column", "wind_share")
    early = -F.unix_micros(F.col("utc").cast("timestamp"))
    picks = ranked.groupBy("ba").agg(
        F.max_by(row, F.struct(F.col("demand"), early)).alias("peak"),
        F.min_by(row, F.struct("demand", "utc")).alias("offpeak"),
        F.max_by(row, (F.col("_r") == F.floor((F.col("_n") + 1) / 2)).cast("int")).alias("shoulder"),
        F.max_by(row, F.when(F.col("wind_share").isNotNull(), F.struct(
            F.col("wind_share"), early.alias("early")))).alias("windhigh"))
    why = {"peak": "max demand hour", "offpeak": "min demand hour",
           "shoulder": "median demand hour (lower median)",
           "windhigh": "max wind share of net generation"}
    entries = F.explode(F.array(*[
        F.struct(F.lit(k).alias("snapshot"), F.lit(v).alias("why"), F.col(k).alias("pick"))
        for k, v in why.items()]))
    return (
        picks.select("ba", entries.alias("e")).where("e.pick is not null")
        .select("ba", "e.snapshot", F.col("e.pick.demand").alias("load_mw"),
                F.col("e.pick.utc").alias("utc_hour"),
                F.concat_ws("; ", "e.why", "e.pick.demand_column").alias("basis"),
                F.bround("e.pick.wind_share", 4).alias("wind_share"))
    )


