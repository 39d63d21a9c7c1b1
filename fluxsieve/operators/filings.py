"""Line filings, mapped lines and queue requests: classification and name joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fluxsieve import fixed
from fluxsieve.functions import geo, text

SHOWN_IDS = 5


def fixed_kv(kv: Column) -> Column:
    """Volts become kilovolts only where that lands on a nominal system voltage."""
    small = F.bround(kv / 1000, 3)
    return F.when((kv >= 1000) & small.isin(*fixed.NOMINAL_SYSTEM_KV), small).otherwise(kv)


def kv_flag(kv: Column) -> Column:
    repaired = F.bround(kv / 1000, 3).isin(*fixed.NOMINAL_SYSTEM_KV)
    return F.when(kv >= 1000, F.when(repaired, "kv_in_volts").otherwise("voltage_implausible"))


def same_endpoints(start: Column, end: Column) -> Column:
    return F.upper(F.trim(start)) == F.upper(F.trim(end))


def aggregate_name(start: Column, end: Column) -> Column:
    up = [F.upper(F.trim(c)) for c in (start, end)]
    return up[0].rlike(fixed.AGGREGATE_NAME) | up[1].rlike(fixed.AGGREGATE_NAME)


def total_length(standalone: Column, aggregated: Column) -> Column:
    both = F.coalesce(standalone, F.lit(0.0)) + F.coalesce(aggregated, F.lit(0.0))
    return F.when(standalone.isNotNull() | aggregated.isNotNull(), F.bround(both, 6))


def classify_filings(filings: DataFrame) -> DataFrame:
    """Drop reason (first failing check), repaired voltage, length, cost and flags per filing.

    ``filings``: record_id, utility_id, kv, standalone_mi, aggregated_mi, start_point,
    end_point, capex (doubles, null = missing).
    """
    start, end = F.trim(F.coalesce("start_point", F.lit(""))), F.trim(F.coalesce("end_point", F.lit("")))
    sa, ag = F.col("standalone_mi"), F.col("aggregated_mi")
    length = total_length(sa, ag)
    reason = (
        F.when(F.col("kv").isNull() | (F.col("kv") <= 0), "no_voltage")
        .when(length.isNull() | (length <= 0), "no_length")
        .when((start == "") | (end == ""), "missing_endpoint"))
    zero = F.lit(0.0)
    marks = F.array(
        kv_flag(F.col("kv")),
        F.when(same_endpoints(start, end), "same_endpoints"),
        F.when(aggregate_name(start, end), "aggregate_name"),
        F.when((F.coalesce(sa, zero) > 0) & (F.coalesce(ag, zero) > 0), "both_length_columns"),
        F.when((F.coalesce(sa, zero) < 0) | (F.coalesce(ag, zero) < 0), "negative_length_part"),
        F.when(F.col("capex") == 0, "capex_zero"))
    return filings.select(
        *[c for c in filings.columns if c not in ("start_point", "end_point")],
        start.alias("start_point"), end.alias("end_point"), reason.alias("drop_reason"),
        fixed_kv(F.col("kv")).alias("voltage_kv"), length.alias("length_mi"),
        F.when(F.col("capex") != 0, F.col("capex")).alias("cost_usd"),
        F.array_compact(marks).alias("flags"))


def _name_pair(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b), F.greatest(a, b)


def line_name_index(lines: DataFrame) -> DataFrame:
    """Mapped lines per (name pair, kV): count, the smallest ids and their text.

    ``lines``: line_id, voltage_kv, sub_1, sub_2.
    """
    keyed = lines.where(
        F.col("voltage_kv").isNotNull() & ~text.is_placeholder(F.col("sub_1"))
        & ~text.is_placeholder(F.col("sub_2"))
    ).select("line_id", F.bround("voltage_kv", 1).alias("kv_key"),
             text.endpoint_key(F.col("sub_1")).alias("a"), text.endpoint_key(F.col("sub_2")).alias("b")
             ).where("a <> '' and b <> ''")
    lo, hi = _name_pair(F.col("a"), F.col("b"))
    keyed = keyed.select("line_id", "kv_key", lo.alias("name_lo"), hi.alias("name_hi"))
    keys = ["name_lo", "name_hi", "kv_key"]
    counts = keyed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("candidates"), F.min("line_id").alias("only_line"))
    # a rank limit of five prunes on the map side, so a common name costs five rows per task
    few = keyed.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("line_id"))
                           ).where(F.col("_r") <= SHOWN_IDS).groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list("line_id")), " ").alias("shown"))
    return counts.join(few, keys)


def match_filings(kept: DataFrame, lines: DataFrame) -> DataFrame:
    """Join filings to mapped lines on both endpoint names and voltage.

    Exact only when one line carries the name and one filing claims it; otherwise ambiguous,
    with the cause. Adds line_id, match, cause and match_evidence.
    """
    index = line_name_index(lines)
    a, b = text.endpoint_name(F.col("start_point")), text.endpoint_name(F.col("end_point"))
    named = kept.withColumn("_a", a).withColumn("_b", b).withColumn(
        "kv_key", F.bround("voltage_kv", 1))
    lo, hi = _name_pair(F.replace("_a", F.lit(" "), F.lit("")), F.replace("_b", F.lit(" "), F.lit("")))
    summary = F.arrays_overlap("flags", F.array(*[F.lit(x) for x in fixed.AGGREGATE_FLAGS]))
    empty = (F.col("_a") == "") | (F.col("_b") == "")
    named = named.withColumn("_summary", F.coalesce(summary, F.lit(False))).withColumn("_empty", empty)
    # rows that can have no partner never enter a join: a null key would put all of them into one partition
    joinable = ~F.col("_summary") & ~F.col("_empty") & F.col("kv_key").isNotNull()
    met = named.where(joinable).withColumn("name_lo", lo).withColumn("name_hi", hi).join(
        index, ["name_lo", "name_hi", "kv_key"], "left").drop("name_lo", "name_hi")
    one = met.where("candidates = 1")
    claims = one.groupBy("only_line").agg(F.count(F.lit(1)).alias("claims"))
    hit = one.join(claims, "only_line").unionByName(
        met.where("candidates IS NULL OR candidates <> 1"), allowMissingColumns=True).unionByName(
        named.where(~F.coalesce(joinable, F.lit(False))), allowMissingColumns=True)
    key = F.concat("_a", F.lit("|"), "_b", F.lit(" @ "), text.number_text(F.col("kv_key")), F.lit(" kV"))
    many = F.col("candidates") > 1
    shared = F.col("claims") > 1
    exact = F.col("claims") == 1
    rest = F.col("candidates") - SHOWN_IDS
    listed = F.concat(
        F.col("candidates").cast("string"), F.lit(" HIFLD lines "), key, F.lit(": "), F.col("shown"),
        F.when(rest > 0, F.concat(F.lit(" +"), rest.cast("string"), F.lit(" more"))).otherwise(""))
    evidence = (
        F.when(F.col("_summary"), "aggregate row; not joined")
        .when(F.col("_empty"), "endpoint name empty after normalization")
        .when(F.col("candidates").isNull(), F.concat(F.lit("no HIFLD line "), key))
        .when(many, listed)
        .when(shared, F.concat("only_line", F.lit(" claimed by "), F.col("claims").cast("string"),
                               F.lit(" FERC rows ("), key, F.lit(")")))
        .otherwise(key))
    return hit.select(
        *kept.columns, F.when(exact, F.col("only_line")).alias("line_id"),
        F.when(exact, "exact").when(many | shared, "ambiguous").otherwise("none").alias("match"),
        F.when(many, "multiple_hifld_lines").when(shared, "shared_hifld_line").alias("cause"),
        evidence.alias("match_evidence"))


def filing_statistics(classified: DataFrame) -> DataFrame:
    """Rows and miles kept per respondent, with its filed rows."""
    kept = F.col("drop_reason").isNull()
    miles = F.when(kept, F.col("length_mi")).cast("decimal(20,6)")
    return classified.groupBy("utility_id").agg(
        F.count(F.lit(1)).alias("filed"), F.count_if(kept).alias("kept"),
        F.coalesce(F.sum(miles).cast("double"), F.lit(0.0)).alias("miles"))


def filing_flag_counts(classified: DataFrame) -> DataFrame:
    return classified.where("drop_reason is null").select(F.explode("flags").alias("flag")).groupBy(
        "flag").agg(F.count(F.lit(1)).alias("n"))


def respondents_without_rows(respondents: DataFrame, classified: DataFrame) -> DataFrame:
    """Configured respondents that filed nothing, or nothing usable."""
    stats = filing_statistics(classified)
    return respondents.join(stats, "utility_id", "left").where("kept is null or kept = 0").select(
        "utility_id", F.when(F.col("filed").isNull(), "no rows").otherwise("no usable rows").alias("status"))


# --- release metrics -----------------------------------------------------------------

def latest_year(filings: DataFrame) -> DataFrame:
    """Filings of the newest report year only (a scalar subquery, so the year is pushed down)."""
    return filings.where(F.col("report_year") == filings.agg(F.max("report_year")).scalar())


def respondent_filings(filings: DataFrame, respondents: list[int]) -> DataFrame:
    return latest_year(filings).where(F.col("utility_id").isin(*respondents))


def release_metrics(filings: DataFrame, corrected: bool) -> DataFrame:
    """Lines, miles, utilities and large corridors of the latest year, as published or with
    voltage, length and endpoint corrections."""
    kv = fixed_kv(F.col("kv")) if corrected else F.col("kv")
    sa, ag = F.col("standalone_mi"), F.col("aggregated_mi")
    miles = (F.when(sa.isNotNull() | ag.isNotNull(), F.coalesce(sa, F.lit(0.0)) + F.coalesce(ag, F.lit(0.0)))
             if corrected else ag)
    ends = [text.blank_to_null(F.col(c)) if corrected else F.col(c) for c in ("start_point", "end_point")]
    clean = latest_year(filings).withColumn("kv_m", kv).withColumn("mi_m", miles).where(
        (F.col("kv_m") > 0) & (F.col("mi_m") > 0) & ends[0].isNotNull() & ends[1].isNotNull())
    large = large_corridor(clean)

    def exact(col, when=None):
        v = F.col(col).cast("decimal(20,6)")
        return F.coalesce(F.sum(v if when is None else F.when(when, v)).cast("double"), F.lit(0.0))

    return clean.agg(
        F.max("report_year").alias("report_year"), F.count(F.lit(1)).alias("lines"),
        F.bround(exact("mi_m"), 1).alias("miles"),
        F.bround(exact("standalone_mi"), 1).alias("standalone_mi"),
        F.bround(exact("aggregated_mi"), 1).alias("aggregated_mi"),
        F.countDistinct("utility_id").alias("utilities"),
        F.count_if(large).alias("corridors"),
        F.bround(exact("mi_m", large), 1).alias("corridor_miles"))


def large_corridor(clean: DataFrame) -> Column:
    return (
        F.col("kv_m").between(345, 1000) & (F.col("capex") / F.col("mi_m") > 0)
        & (F.col("mi_m") >= 10) & (F.col("start_point") != F.col("end_point")))


def volts_reported(filings: DataFrame) -> DataFrame:
    """Rows at or above 1000 'kV', and how many of those read as volts."""
    return filings.where("kv >= 1000").agg(
        F.count(F.lit(1)).alias("kv_ge_1000"),
        F.count_if(F.bround(F.col("kv") / 1000, 3).isin(*fixed.NOMINAL_SYSTEM_KV)).alias("read_as_volts"))


def deployments_in_filings(deployments: DataFrame, filings: DataFrame) -> DataFrame:
    """Listed deployments joined to the latest filings by utility name, endpoints and kV.

    ``deployments``: utility, from_point, to_point, kv.
    """
    names = filings.groupBy(F.col("utility_name").alias("utility"), "utility_id").agg(
        F.lit(1).alias("_one")).drop("_one")

    def clean(col):
        return F.upper(F.trim(F.col(col)))

    latest = latest_year(filings).select(
        "utility_id", clean("start_point").alias("_s"), clean("end_point").alias("_e"), "kv",
        "standalone_mi", "aggregated_mi")
    wanted = deployments.join(names, "utility").withColumn("_s", clean("from_point")).withColumn(
        "_e", clean("to_point"))
    hits = latest.groupBy("utility_id", "_s", "_e", "kv").agg(
        F.count(F.lit(1)).alias("filed_rows"),
        F.sum(F.col("standalone_mi").cast("decimal(20,6)")).cast("double").alias("standalone_mi"),
        F.sum(F.col("aggregated_mi").cast("decimal(20,6)")).cast("double").alias("aggregated_mi"))
    return wanted.join(hits, ["utility_id", "_s", "_e", "kv"], "left").select(
        "utility", "from_point", "to_point", "kv", "utility_id",
        F.coalesce("filed_rows", F.lit(0)).cast("bigint").alias("filed_rows"),
        "standalone_mi", "aggregated_mi")


# --- mapped line features --------------------------------------------------------------

def whole_parts(parts: Column) -> Column:
    """Parts of two or more points that are longer than a digitizing stub."""
    return F.filter(parts, lambda p: (F.size(p) >= 2) & (geo.path_m(p) >= fixed.STUB_METRES))


def classify_features(features: DataFrame, min_kv: float) -> DataFrame:
    """Exclusion reason per line feature; an id counts as a duplicate only behind a kept row.

    ``features``: ord, hid, kv, status, kind, parts (array of point arrays, null = malformed).
    """
    status, kind = F.upper(text.collapse(F.col("status"))), F.upper(text.collapse(F.col("kind")))
    hid = text.collapse(F.col("hid"))
    kept_parts = F.when(F.col("parts").isNotNull(), whole_parts(F.col("parts")))
    own = F.when(kind.startswith("DC"), "dc")
    for value, reason in fixed.EXCLUDED_STATUS.items():
        own = own.when(status == value, reason)
    own = (own.when(F.col("kv").isNull() | (F.col("kv") < 0), "unknown_kv")
           .when(F.col("kv") < min_kv, "below_min_kv")
           .when(F.coalesce(F.size("whole"), F.lit(0)) <= 0, "bad_geometry"))
    base = features.withColumn("hid", hid).withColumn("whole", kept_parts).withColumn("own", own)
    first = base.where("hid <> '' and own is null").groupBy("hid").agg(F.min("ord").alias("kept_at"))
    reason = (F.when(F.col("hid") == "", "bad_id")
              .when(F.col("ord") > F.col("kept_at"), "duplicate_id").otherwise(F.col("own")))
    length = F.aggregate(F.transform("whole", geo.path_m), F.lit(0.0), lambda t, x: t + x)
    return base.join(first, "hid", "left").withColumn("reason", reason).withColumn(
        "length_m", F.when(F.col("reason").isNull(), length)).withColumn(
        "stub_parts", F.when(F.col("own").isNull() | (F.col("own") == "bad_geometry"),
                             F.coalesce(F.size("parts") - F.size("whole"), F.lit(0)))
    ).drop("own", "kept_at")


def feature_reasons(classified: DataFrame) -> DataFrame:
    return classified.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))


def chain_parts(features: DataFrame) -> DataFrame:
    """Chain ends and widest gap of every kept feature: adds head, tail, gap_m.

    A single part is its own chain and stays in built-in expressions; features with several
    parts go through ``mapInPandas`` one by one, in parallel over features.
    """
    single = features.where(F.size("whole") <= 1).select(
        "ord", F.get(F.get("whole", F.lit(0)), F.lit(0)).alias("head"),
        F.element_at(F.get("whole", F.lit(0)), -1).alias("tail"), F.lit(0.0).alias("gap_m"))
    ends = F.transform("whole", lambda p: F.struct(F.get(p, F.lit(0)).alias("first"),
                                                   F.element_at(p, -1).alias("last")))
    point = "struct<lat:double,lon:double>"
    several = features.where(F.size("whole") > 1).select("ord", ends.alias("ends")).mapInPandas(
        _chain_batches, f"ord {features.schema['ord'].dataType.simpleString()}, "
                        f"head {point}, tail {point}, gap_m double")
    return features.join(single.unionByName(several), "ord", "left")


def _chain_batches(batches):
    import math

    import pandas as pd

    def gap(p, q):
        a, b = math.radians(p["lat"]), math.radians(q["lat"])
        h = (math.sin((b - a) / 2) ** 2
             + math.cos(a) * math.cos(b) * math.sin(math.radians(q["lon"] - p["lon"]) / 2) ** 2)
        return 2 * fixed.EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))

    def chain(ends):
        head, tail, widest = ends[0]["first"], ends[0]["last"], 0.0
        waiting = dict(enumerate(ends[1:]))
        while waiting:
            # a part may be laid either way round, behind the tail or in front of the head
            laid = [(i, turn, e["first"], e["last"]) if not turn else (i, turn, e["last"], e["first"])
                    for i, e in waiting.items() for turn in (0, 1)]
            options = [(gap(tail, a), i, turn, 0, b) for i, turn, a, b in laid]
            options += [(gap(b, head), i, turn, 1, a) for i, turn, a, b in laid]
            width, i, _, in_front, free_end = min(options, key=lambda o: o[:4])
            head, tail = (free_end, tail) if in_front else (head, free_end)
            widest = max(widest, width)
            del waiting[i]
        return head, tail, widest

    for frame in batches:
        done = [chain(list(e)) for e in frame["ends"]]
        yield pd.DataFrame({
            "ord": frame["ord"], "head": [d[0] for d in done], "tail": [d[1] for d in done],
            "gap_m": [d[2] for d in done]})


def owner_counts(lines: DataFrame, top: int = 12) -> DataFrame:
    """Line count of the most frequent owners by membership."""
    counts = lines.groupBy("membership", text.collapse(F.col("owner")).alias("owner")).agg(
        F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("membership").orderBy(F.col("n").desc(), "owner")
    return counts.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= top).drop("_r")


def voltage_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy(text.number_text(F.col("kv")).alias("kv")).agg(
        F.count(F.lit(1)).alias("n"), F.bround(
            F.sum(F.col("length_m").cast("decimal(24,6)")).cast("double") / fixed.METRES_PER_MILE, 1
        ).alias("miles"))


# --- queue ------------------------------------------------------------------------------

def is_active(status: Column, withdrawn: Column) -> Column:
    s = F.upper(F.coalesce(status, F.lit("")))
    return ~(s.contains("COMMERCIAL OPERATION") | s.contains("WITHDRAW")
             | (F.coalesce(withdrawn, F.lit("")) != ""))


def bus_name_index(buses: DataFrame) -> DataFrame:
    """Buses per normalized name: (poi_key, buses, bus_id of the only one)."""
    return buses.select(text.poi_key(F.col("name")).alias("poi_key"), "bus_id").where(
        "poi_key <> ''").groupBy("poi_key").agg(
        F.count(F.lit(1)).alias("buses"), F.min("bus_id").alias("bus_id"))


def place_requests(requests: DataFrame, buses: DataFrame) -> DataFrame:
    """Put each request on the one bus that carries its normalized name.

    ``requests``: request_id, poi, mw, ...; adds near_bus and match.
    """
    keyed = requests.withColumn("poi_key", F.nullif(text.poi_key(F.col("poi")), F.lit("")))
    # requests without a name never enter the join: a null key would put all of them into one partition
    hit = keyed.where("poi_key IS NOT NULL").join(bus_name_index(buses), "poi_key", "left").unionByName(
        keyed.where("poi_key IS NULL"), allowMissingColumns=True)
    return hit.select(
        *requests.columns, F.when(F.col("buses") == 1, F.col("bus_id")).alias("near_bus"),
        F.when(F.col("buses") == 1, "exact").when(F.col("buses") > 1, "ambiguous")
        .otherwise("none").alias("match"))


def queue_requests(rows: DataFrame) -> DataFrame:
    """Active requests with capacity, from published columns. Unreadable capacity is skipped."""
    c = {n: F.col(f"`{n}`") for n in fixed.QUEUE_COLUMNS}
    fuel = F.coalesce(text.blank_to_null(c["Fuel Type"]), text.blank_to_null(c["Generation Type"]), F.lit(""))
    return rows.where(is_active(c["Status"], F.trim(c["Date Withdrawn"]))).select(
        F.trim(c["Generation Interconnection Number"]).alias("request_id"),
        text.number(c["Capacity"]).alias("mw"), fuel.alias("fuel"),
        text.collapse(c["Substation or Line"]).alias("poi"), F.trim(c["State"]).alias("state"),
        F.trim(c["TO at POI"]).alias("to_at_poi"), F.trim(c["Status"]).alias("status"),
    ).where("mw is not null")


def queue_statistics(placed: DataFrame) -> DataFrame:
    """Requests and megawatts by status and by match class."""
    kinds = F.explode(F.array(
        F.struct(F.lit("status").alias("kind"), F.coalesce("status", F.lit("")).alias("value")),
        F.struct(F.lit("match").alias("kind"), F.col("match").alias("value"))))
    return placed.select("mw", kinds.alias("k")).groupBy("k.kind", "k.value").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("mw").cast("decimal(20,6)")).cast("double").alias("mw"))


