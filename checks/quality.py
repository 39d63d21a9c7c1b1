"""Provider readings, names, filings, queue and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import duck, view
from fluxsieve.session import shared_folder
from fluxsieve.sinks.exports import write_table
from fluxsieve.sources.tables import read_text_table
from fluxsieve import fixed
from fluxsieve.functions import numeric, text
from fluxsieve.operators import filings, quality, validation
from fluxsieve.plans.panel import coverage_class

PROVIDERS = ["v_first", "v_second", "v_third"]
NOMINAL = "69, 115, 138, 161, 230, 345, 500, 765"
SYSTEM_KV = ", ".join(str(v) for v in fixed.NOMINAL_SYSTEM_KV)

OBS = """, obs AS (
  SELECT line_id, 'hifld' AS provider, 0 AS position, voltage_kv AS as_reported, CAST(voltage_kv AS DOUBLE) AS kv FROM v_first
  UNION ALL SELECT line_id, 'eia', 1, voltage_kv, CAST(voltage_kv AS DOUBLE) FROM (
    SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY ord DESC) AS rn FROM v_second WHERE line_id <> '')
    WHERE rn = 1 AND voltage_kv <> ''
  UNION ALL SELECT line_id, 'ferc1', 2, voltage_kv, CAST(voltage_kv AS DOUBLE) FROM v_third), votes AS (
  SELECT line_id, kv, COUNT(*) AS n, MIN(position) AS pos FROM obs GROUP BY 1, 2), tri AS (
  SELECT line_id, kv, COUNT(*) OVER (PARTITION BY line_id) AS d, SUM(n) OVER (PARTITION BY line_id) AS total,
         row_number() OVER (PARTITION BY line_id ORDER BY n DESC, pos) AS rn FROM votes), best AS (
  SELECT line_id, kv, CAST(total AS BIGINT) AS n_readings,
         CASE WHEN d > 1 THEN 'low' WHEN total >= 3 THEN 'high' ELSE 'medium' END AS confidence,
         CASE WHEN d > 1 THEN 'source_divergence' ELSE '' END AS flags FROM tri WHERE rn = 1)"""


def _readings(spark, folder):
    return quality.line_readings(*[view(spark, folder, v) for v in PROVIDERS])


def _attributes(spark, folder):
    return view(spark, folder, "v_third").select("line_id", F.trim("conductor").alias("conductor"),
                                                 "thermal_limit_mw", "cost_usd")


def provider_readings(spark, folder):
    return _readings(spark, folder)


READINGS = duck(PROVIDERS, OBS + " SELECT line_id, provider, position, as_reported, kv FROM obs")


def provider_join(spark, folder):
    first, second, third = (view(spark, folder, v) for v in PROVIDERS)
    return quality.provider_join(first, second.where("line_id <> ''"), third).select(
        "line_id", "kv_first", "kv_second", "kv_third", "conductor", "thermal_limit_mw", "cost_usd")


PROVIDER_JOIN = duck(PROVIDERS, """
SELECT a.line_id, a.voltage_kv AS kv_first, b.voltage_kv AS kv_second, c.voltage_kv AS kv_third, c.conductor,
       c.thermal_limit_mw, c.cost_usd
FROM v_first a LEFT JOIN (SELECT line_id, last(voltage_kv ORDER BY ord) AS voltage_kv FROM v_second
                          WHERE line_id <> '' GROUP BY 1) b ON a.line_id = b.line_id
LEFT JOIN v_third c ON a.line_id = c.line_id""")


def triangulate(spark, folder):
    return quality.triangulate(_readings(spark, folder)).withColumn("flags", F.array_join("flags", ";"))


TRIANGULATE = duck(PROVIDERS, OBS + """
SELECT b.line_id, b.kv, b.n_readings, b.confidence, b.flags, r.as_reported FROM best b JOIN (
  SELECT line_id, string_agg(provider || '=' || as_reported, '; ' ORDER BY position) AS as_reported FROM obs GROUP BY 1) r
ON b.line_id = r.line_id""")


def line_facts(spark, folder):
    return quality.line_facts(_readings(spark, folder), _attributes(spark, folder)).select(
        "line_id", "field", "confidence", F.array_join(F.array_sort("flags"), ";").alias("flags"))


FACTS = OBS + f""", facts AS (
  SELECT b.line_id, 'voltage_kv' AS field, b.confidence AS prior,
         list_sort(list_filter([CASE WHEN b.flags <> '' THEN b.flags END,
           CASE WHEN b.kv NOT IN ({NOMINAL}) THEN 'voltage_implausible' END,
           CASE WHEN b.kv >= 500 AND trim(c.conductor) = '4/0' THEN 'conductor_voltage_mismatch' END],
           lambda x: x IS NOT NULL)) AS flags
  FROM best b LEFT JOIN v_third c ON b.line_id = c.line_id
  UNION ALL SELECT b.line_id, 'conductor', 'medium', list_filter([CASE WHEN b.kv >= 500 AND trim(c.conductor) = '4/0'
         THEN 'conductor_voltage_mismatch' END], lambda x: x IS NOT NULL)
  FROM best b JOIN v_third c ON b.line_id = c.line_id WHERE c.conductor IS NOT NULL
  UNION ALL SELECT line_id, 'thermal_limit_mw', 'medium', [] FROM v_third WHERE thermal_limit_mw IS NOT NULL
  UNION ALL SELECT line_id, 'cost_usd', 'high', [] FROM v_third WHERE cost_usd IS NOT NULL), rated AS (
  SELECT line_id, field, flags,
         (['low', 'medium', 'high'])[greatest(1, CASE prior WHEN 'low' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END - len(flags))]
           AS confidence FROM facts)"""

LINE_FACTS = duck(PROVIDERS, FACTS + """
SELECT line_id, field, confidence, array_to_string(flags, ';') AS flags FROM rated""")


def flag_report(spark, folder):
    readings = _readings(spark, folder)
    facts = quality.line_facts(readings, _attributes(spark, folder)).select("field", "confidence", "flags").unionByName(
        quality.reading_facts(readings).select("field", "confidence", "flags"))
    return quality.flag_report(facts)


FLAG_REPORT = duck(PROVIDERS, FACTS + f""", every AS (
  SELECT field, confidence, flags FROM rated
  UNION ALL SELECT 'voltage_kv_raw', 'medium', CASE WHEN kv NOT IN ({NOMINAL}) THEN ['voltage_implausible'] ELSE [] END FROM obs)
SELECT field, 'confidence' AS kind, confidence AS name, COUNT(*) AS n FROM every GROUP BY 1, 3
UNION ALL SELECT field, 'flag', name, COUNT(*) FROM (SELECT field, unnest(flags) AS name FROM every) GROUP BY 1, 3""")


def invariant_violations(spark, folder):
    return quality.invariant_violations(_readings(spark, folder), _attributes(spark, folder)).select(
        "invariant", "line_id", "field")


INVARIANTS = duck(PROVIDERS, OBS + f"""
SELECT 'voltage_in_set' AS invariant, line_id, 'voltage_kv' AS field FROM obs WHERE kv NOT IN ({NOMINAL})
UNION ALL SELECT 'conductor_matches_voltage', b.line_id, 'conductor' FROM best b JOIN v_third c ON b.line_id = c.line_id
WHERE b.kv >= 500 AND trim(c.conductor) = '4/0'""")


# --- names -----------------------------------------------------------------------------

def name_keys(spark, folder):
    t = F.col("text")
    return view(spark, folder, "v_names").select(
        "id", text.poi_key(t).alias("poi_key"), text.endpoint_name(t).alias("endpoint"),
        text.endpoint_key(t).alias("endpoint_key"), text.is_placeholder(t).alias("placeholder"),
        F.coalesce(text.name_token(F.trim(t)), F.lit("")).alias("token"),
        text.is_numbered_placeholder(F.trim(t)).alias("numbered"))


def endpoint_sql(c: str) -> str:
    up = f"trim(regexp_replace(upper(coalesce({c}, '')), '\\([^)]*\\)?', ' ', 'g'))"
    bare = f"regexp_replace({up}, '^(?:TL[0-9-]+[A-Z]?|[0-9]+[A-Z]?)(?:\\s+|-([A-Z]))', '\\1')"
    s = f"CASE WHEN trim({bare}) <> '' THEN {bare} ELSE {up} END"
    for pattern in (r"\b(?:LINE|LN|CKT|CIRCUIT)\s*#?\s*\d+[A-Z]?\b", r"[^A-Z0-9 ]+", r"\b\d+(?:\.\d+)?\s*KV\b",
                    r"\b(?:POWER PLANT|POWER STATION|SUBSTATION|SUB|SWITCHING|SWITCHYARD|SWYD|STATION|STA|SW|PLANT)\b"):
        s = f"regexp_replace({s}, '{pattern}', ' ', 'g')"
    words = (f"list_transform(list_filter(regexp_split_to_array({s}, '\\s+'), lambda w: w <> ''), lambda w: CASE w "
             + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.NAME_ABBREVIATIONS.items()) + " ELSE w END)")
    return f"regexp_replace(array_to_string({words}, ' '), '\\s(69|115|138|161|230|345|500|765)$', '')"


def poi_sql(c: str) -> str:
    s = f"regexp_replace(upper(coalesce({c}, '')), '\\([^)]*\\)', ' ', 'g')"
    s = f"regexp_replace({s}, '(\\d)(KV|LINE|SUBSTATION|SWITCHING|STATION|SUB|BUS)\\b', '\\1 \\2', 'g')"
    s = f"regexp_replace({s}, '[^A-Z0-9.]+', ' ', 'g')"
    s = f"regexp_replace({s}, '\\b\\d+(?:\\.\\d+)?\\s*KV\\b', ' ', 'g')"
    stop = ", ".join(f"'{w}'" for w in fixed.POI_STOPWORDS)
    return (f"array_to_string(list_filter(list_transform(string_split({s}, ' '), lambda w: trim(w, '.')), "
            f"lambda w: w <> '' AND w NOT IN ({stop}) AND NOT regexp_full_match(w, '\\d+(\\.\\d+)?')), ' ')")



NAME_KEYS = duck(["v_names"], f"""
SELECT id, {poi_sql('text')} AS poi_key, endpoint, REPLACE(endpoint, ' ', '') AS endpoint_key,
       regexp_full_match(trim(regexp_replace(upper(text), '\\s+', ' ', 'g')), '((TAP|UNKNOWN)\\s*\\d*|NOT AVAILABLE|NONE|N/?A|)') AS placeholder,
       CASE WHEN upper(trim(text)) IN ('', 'TAP', 'UNKNOWN', 'RISER', 'DEADEND', 'NOT AVAILABLE', 'NONE') THEN ''
            ELSE trim(text) END AS token,
       regexp_full_match(upper(trim(text)), '(TAP|UNKNOWN|RISER|DEADEND)\\d+') AS numbered
FROM (SELECT *, {endpoint_sql('text')} AS endpoint FROM v_names)""")


# --- filings ---------------------------------------------------------------------------

CLASSED = f""", classed AS (
  SELECT *, CASE WHEN kv IS NULL OR kv <= 0 THEN 'no_voltage'
                 WHEN (standalone_mi IS NULL AND aggregated_mi IS NULL)
                      OR COALESCE(standalone_mi, 0) + COALESCE(aggregated_mi, 0) <= 0 THEN 'no_length'
                 WHEN trim(start_point) = '' OR trim(end_point) = '' THEN 'missing_endpoint' END AS drop_reason,
         CASE WHEN kv >= 1000 AND ROUND(kv / 1000, 3) IN ({SYSTEM_KV}) THEN ROUND(kv / 1000, 3) ELSE kv END AS voltage_kv,
         CASE WHEN standalone_mi IS NOT NULL OR aggregated_mi IS NOT NULL
              THEN ROUND(COALESCE(standalone_mi, 0) + COALESCE(aggregated_mi, 0), 6) END AS length_mi,
         array_to_string(list_filter([
           CASE WHEN kv >= 1000 THEN CASE WHEN ROUND(kv / 1000, 3) IN ({SYSTEM_KV}) THEN 'kv_in_volts' ELSE 'voltage_implausible' END END,
           CASE WHEN upper(trim(start_point)) = upper(trim(end_point)) THEN 'same_endpoints' END,
           CASE WHEN regexp_matches(upper(trim(start_point)), '^(SUB ?TOTAL|TOTAL|SUMMARY|GROUPED|LESS THAN|LESS |VARIOUS|ALL \\d|ROUNDING)|\\bKV (LINES|SYSTEM)\\b')
                  OR regexp_matches(upper(trim(end_point)), '^(SUB ?TOTAL|TOTAL|SUMMARY|GROUPED|LESS THAN|LESS |VARIOUS|ALL \\d|ROUNDING)|\\bKV (LINES|SYSTEM)\\b')
                THEN 'aggregate_name' END,
           CASE WHEN standalone_mi > 0 AND aggregated_mi > 0 THEN 'both_length_columns' END,
           CASE WHEN standalone_mi < 0 OR aggregated_mi < 0 THEN 'negative_length_part' END,
           CASE WHEN capex = 0 THEN 'capex_zero' END], lambda x: x IS NOT NULL), ';') AS flags FROM v_filings)"""


def classify_filings(spark, folder):
    return filings.classify_filings(view(spark, folder, "v_filings")).select(
        "record_id", "drop_reason", "voltage_kv", "length_mi", "cost_usd", F.array_join("flags", ";").alias("flags"))


CLASSIFY = duck(["v_filings"], CLASSED + """
SELECT record_id, drop_reason, voltage_kv, length_mi, CASE WHEN capex <> 0 THEN capex END AS cost_usd, flags FROM classed""")


def match_filings(spark, folder):
    kept = filings.classify_filings(view(spark, folder, "v_filings")).where("drop_reason is null")
    return filings.match_filings(kept, view(spark, folder, "v_mapped")).select(
        "record_id", "line_id", "match", "cause", "match_evidence")


def _shown(x: str) -> str:
    return f"(CASE WHEN {x} = FLOOR({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END)"


MATCH = duck(["v_filings", "v_mapped"], CLASSED + f""", named AS (
  SELECT record_id, flags, ROUND(voltage_kv, 1) AS kv_key, {endpoint_sql('start_point')} AS a, {endpoint_sql('end_point')} AS b
  FROM classed WHERE drop_reason IS NULL), f AS (
  SELECT *, flags LIKE '%same_endpoints%' OR flags LIKE '%aggregate_name%' AS summary, a = '' OR b = '' AS blank,
         least(REPLACE(a, ' ', ''), REPLACE(b, ' ', '')) AS lo, greatest(REPLACE(a, ' ', ''), REPLACE(b, ' ', '')) AS hi
  FROM named), m AS (
  SELECT line_id, ROUND(voltage_kv, 1) AS kv_key, REPLACE({endpoint_sql('sub_1')}, ' ', '') AS a, REPLACE({endpoint_sql('sub_2')}, ' ', '') AS b
  FROM v_mapped WHERE NOT regexp_full_match(upper(sub_1), '(TAP|UNKNOWN)\\s*\\d*|NOT AVAILABLE|NONE|N/?A|')), idx AS (
  SELECT least(a, b) AS lo, greatest(a, b) AS hi, kv_key, COUNT(*) AS n, MIN(line_id) AS one,
         array_to_string(list_sort(list(line_id))[1:5], ' ') AS shown
  FROM m WHERE a <> '' AND b <> '' GROUP BY 1, 2, 3), hit AS (
  SELECT f.*, i.n, i.one, i.shown, COUNT(*) OVER (PARTITION BY CASE WHEN i.n = 1 THEN i.one ELSE 'row' || record_id END) AS claims,
         f.a || '|' || f.b || ' @ ' || {_shown('f.kv_key')} || ' kV' AS key
  FROM f LEFT JOIN idx i ON NOT f.summary AND NOT f.blank AND f.lo = i.lo AND f.hi = i.hi AND f.kv_key = i.kv_key)
SELECT record_id, CASE WHEN n = 1 AND claims = 1 THEN one END AS line_id,
       CASE WHEN n = 1 AND claims = 1 THEN 'exact' WHEN n >= 1 THEN 'ambiguous' ELSE 'none' END AS match,
       CASE WHEN n > 1 THEN 'multiple_hifld_lines' WHEN n = 1 AND claims > 1 THEN 'shared_hifld_line' END AS cause,
       CASE WHEN summary THEN 'aggregate row; not joined' WHEN blank THEN 'endpoint name empty after normalization'
            WHEN n IS NULL THEN 'no HIFLD line ' || key
            WHEN n > 1 THEN n || ' HIFLD lines ' || key || ': ' || shown || CASE WHEN n > 5 THEN ' +' || (n - 5) || ' more' ELSE '' END
            WHEN claims > 1 THEN one || ' claimed by ' || claims || ' FERC rows (' || key || ')' ELSE key END AS match_evidence
FROM hit""")


def filing_statistics(spark, folder):
    return filings.filing_statistics(filings.classify_filings(view(spark, folder, "v_filings")))


FILING_STATS = duck(["v_filings"], CLASSED + """
SELECT utility_id, COUNT(*) AS filed, COUNT(*) FILTER (WHERE drop_reason IS NULL) AS kept,
       COALESCE(CAST(SUM(CAST(length_mi AS DECIMAL(20, 6))) FILTER (WHERE drop_reason IS NULL) AS DOUBLE), 0) AS miles
FROM classed GROUP BY 1""")


def filing_flags(spark, folder):
    return filings.filing_flag_counts(filings.classify_filings(view(spark, folder, "v_filings")))


FILING_FLAGS = duck(["v_filings"], CLASSED + """
SELECT flag, COUNT(*) AS n FROM (SELECT unnest(string_split(flags, ';')) AS flag FROM classed WHERE drop_reason IS NULL)
WHERE flag <> '' GROUP BY 1""")


def respondents_without_rows(spark, folder):
    wanted = view(spark, folder, "v_cov").select(F.pmod("doc_id", F.lit(40)).cast("int").alias("utility_id")).distinct()
    return filings.respondents_without_rows(
        wanted, filings.classify_filings(view(spark, folder, "v_filings")))


NO_ROWS = duck(["v_filings", "v_cov"], CLASSED + """
SELECT w.utility_id, CASE WHEN f.utility_id IS NULL THEN 'no rows' ELSE 'no usable rows' END AS status
FROM (SELECT DISTINCT CAST(doc_id % 40 AS INT) AS utility_id FROM v_cov) w LEFT JOIN (
  SELECT utility_id, COUNT(*) FILTER (WHERE drop_reason IS NULL) AS kept FROM classed GROUP BY 1) f ON w.utility_id = f.utility_id
WHERE COALESCE(f.kept, 0) = 0""")


def _metrics_sql(corrected: bool) -> str:
    kv = (f"CASE WHEN kv >= 1000 AND ROUND(kv / 1000, 3) IN ({SYSTEM_KV}) THEN ROUND(kv / 1000, 3) ELSE kv END"
          if corrected else "kv")
    mi = ("CASE WHEN standalone_mi IS NULL AND aggregated_mi IS NULL THEN NULL "
          "ELSE COALESCE(standalone_mi, 0) + COALESCE(aggregated_mi, 0) END" if corrected else "aggregated_mi")
    ends = ("NULLIF(trim(start_point), '') IS NOT NULL AND NULLIF(trim(end_point), '') IS NOT NULL" if corrected
            else "start_point IS NOT NULL AND end_point IS NOT NULL")
    big = "kv_m >= 345 AND capex / mi_m > 0 AND mi_m >= 10 AND kv_m <= 1000 AND start_point <> end_point"
    return f"""
SELECT {str(corrected).upper()} AS corrected, MAX(report_year) AS report_year, COUNT(*) AS lines, ROUND(SUM(mi_m), 1) AS miles,
       ROUND(SUM(standalone_mi), 1) AS standalone_mi, ROUND(SUM(aggregated_mi), 1) AS aggregated_mi,
       COUNT(DISTINCT utility_id) AS utilities, COUNT(*) FILTER (WHERE {big}) AS corridors,
       ROUND(COALESCE(SUM(mi_m) FILTER (WHERE {big}), 0), 1) AS corridor_miles
FROM (SELECT *, {kv} AS kv_m, {mi} AS mi_m FROM v_filings WHERE report_year = (SELECT MAX(report_year) FROM v_filings))
WHERE kv_m > 0 AND mi_m > 0 AND {ends}"""


def release_metrics(spark, folder):
    rows = view(spark, folder, "v_filings")
    parts = [filings.release_metrics(rows, c).select(F.lit(c).alias("corrected"), "*") for c in (True, False)]
    return parts[0].unionByName(parts[1])


RELEASE = duck(["v_filings"], _metrics_sql(True) + " UNION ALL " + _metrics_sql(False))


def volts_reported(spark, folder):
    return filings.volts_reported(view(spark, folder, "v_filings"))


VOLTS = duck(["v_filings"], f"""
SELECT COUNT(*) AS kv_ge_1000, COUNT(*) FILTER (WHERE ROUND(kv / 1000, 3) IN ({SYSTEM_KV})) AS read_as_volts
FROM v_filings WHERE kv >= 1000""")


def deployments(spark, folder):
    rows = view(spark, folder, "v_filings")
    wanted = rows.select(F.col("utility_name").alias("utility"), F.lower("start_point").alias("from_point"),
                         F.concat(F.lit(" "), "end_point").alias("to_point"), "kv").where("kv is not null").distinct()
    return filings.deployments_in_filings(wanted, rows)


DEPLOYMENTS = duck(["v_filings"], """, wanted AS (
  SELECT DISTINCT utility_name AS utility, lower(start_point) AS from_point, ' ' || end_point AS to_point, kv
  FROM v_filings WHERE kv IS NOT NULL), names AS (SELECT DISTINCT utility_name, utility_id FROM v_filings), latest AS (
  SELECT * FROM v_filings WHERE report_year = (SELECT MAX(report_year) FROM v_filings))
SELECT w.utility, w.from_point, w.to_point, w.kv, n.utility_id, COUNT(l.record_id) AS filed_rows,
       SUM(l.standalone_mi) AS standalone_mi, SUM(l.aggregated_mi) AS aggregated_mi
FROM wanted w JOIN names n ON w.utility = n.utility_name
LEFT JOIN latest l ON l.utility_id = n.utility_id AND upper(trim(l.start_point)) = upper(trim(w.from_point))
     AND upper(trim(l.end_point)) = upper(trim(w.to_point)) AND l.kv = w.kv
GROUP BY 1, 2, 3, 4, 5""")


# --- queue -----------------------------------------------------------------------------

ACTIVE = """NOT (upper(status) LIKE '%COMMERCIAL OPERATION%' OR upper(status) LIKE '%WITHDRAW%' OR withdrawn <> '')"""


def _active(spark, folder):
    return view(spark, folder, "v_poi").where(filings.is_active(F.col("status"), F.col("withdrawn")))


def place_requests(spark, folder):
    return filings.place_requests(_active(spark, folder), view(spark, folder, "v_poi_buses")).select(
        "request_id", "mw", "near_bus", "match")


PLACED = f""", idx AS (
  SELECT k, COUNT(*) AS n, MIN(bus_id) AS bus_id FROM (SELECT bus_id, {poi_sql('name')} AS k FROM v_poi_buses) WHERE k <> '' GROUP BY 1),
placed AS (
  SELECT r.request_id, r.mw, r.status, CASE WHEN i.n = 1 THEN i.bus_id END AS near_bus,
         CASE WHEN i.n = 1 THEN 'exact' WHEN i.n > 1 THEN 'ambiguous' ELSE 'none' END AS match
  FROM (SELECT *, {poi_sql('poi')} AS k FROM v_poi WHERE {ACTIVE}) r LEFT JOIN idx i ON r.k = i.k AND r.k <> '')"""
PLACE = duck(["v_poi", "v_poi_buses"], PLACED + " SELECT request_id, mw, near_bus, match FROM placed")


def queue_statistics(spark, folder):
    return filings.queue_statistics(
        filings.place_requests(_active(spark, folder), view(spark, folder, "v_poi_buses")))


QUEUE_STATS = duck(["v_poi", "v_poi_buses"], PLACED + """
SELECT 'status' AS kind, status AS value, COUNT(*) AS n, CAST(SUM(CAST(mw AS DECIMAL(20, 6))) AS DOUBLE) AS mw FROM placed GROUP BY 2
UNION ALL SELECT 'match', match, COUNT(*), CAST(SUM(CAST(mw AS DECIMAL(20, 6))) AS DOUBLE) FROM placed GROUP BY 2""")


# --- coverage and validation -------------------------------------------------------------

def coverage_test(spark, folder):
    """Present, absent from a covered source, or unobserved because the source has no labels."""
    docs = view(spark, folder, "v_cov")
    table = docs.groupBy("source").agg(F.count("quality").alias("labelled"))
    present, covered = F.col("quality").isNotNull(), F.col("labelled") > 0
    status = F.when(present, "observed").when(covered, "absent").otherwise("unobserved")
    return docs.join(table, "source").groupBy("lang", status.alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("quality", F.lit(0))).alias("quality"))


COVERAGE_TEST = duck(["v_cov"], """
SELECT lang, CASE WHEN quality IS NOT NULL THEN 'observed' WHEN labelled > 0 THEN 'absent' ELSE 'unobserved' END AS status,
       COUNT(*) AS n, CAST(SUM(COALESCE(quality, 0)) AS BIGINT) AS quality
FROM (SELECT *, COUNT(quality) OVER (PARTITION BY source) AS labelled FROM v_cov) GROUP BY 1, 2""")


def month_coverage(spark, folder):
    c = view(spark, folder, "v_coverage")
    return c.select("market", numeric.month_text(F.col("period")).alias("period"),
                    coverage_class(F.col("days_covered"), F.col("days_expected")).alias("coverage"),
                    numeric.days_in_month(F.col("period")).alias("days"))


MONTH_COVERAGE = duck(["v_coverage"], """
SELECT market, strftime(period, '%Y-%m') AS period,
       CASE WHEN days_covered = 0 THEN 'none' WHEN days_covered = days_expected THEN 'full' ELSE 'partial' END AS coverage,
       CAST(EXTRACT(DAY FROM last_day(period)) AS INT) AS days FROM v_coverage""")


def duplicate_keys(spark, folder):
    return validation.duplicate_keys(view(spark, folder, "v_second"), ["line_id"])


DUPLICATE_KEYS = duck(["v_second"], "SELECT line_id, COUNT(*) AS copies FROM v_second GROUP BY 1 HAVING COUNT(*) > 1")


def _text_history(spark, folder):
    h = view(spark, folder, "v_history")
    broken = F.when(F.pmod("ord", F.lit(50)) == 1, "0").when(F.pmod("ord", F.lit(50)) == 2, "x").otherwise(
        F.col("hours_binding").cast("string"))
    return h.select(
        "constraint_id", F.when(F.pmod("ord", F.lit(40)) == 3, "FTR").otherwise(F.col("market")).alias("market"),
        F.when(F.pmod("ord", F.lit(60)) == 4, "2025-13").otherwise(numeric.month_text(F.col("period"))).alias("period"),
        broken.alias("hours_binding"), F.coalesce(F.col("shadow_price_max").cast("string"), F.lit("")).alias("shadow_price_max"),
        F.when(F.pmod("ord", F.lit(70)) == 5, "1e9").otherwise(
            F.coalesce(F.col("shadow_price_mean").cast("string"), F.lit(""))).alias("shadow_price_mean"),
        F.when(F.pmod("ord", F.lit(80)) == 6, "1,000").otherwise("").alias("congestion_cost_usd"))


def history_contract(spark, folder):
    return validation.history_violations(_text_history(spark, folder)).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


HISTORY_CONTRACT = duck(["v_history"], """, t AS (
  SELECT constraint_id, CASE WHEN ord % 40 = 3 THEN 'FTR' ELSE market END AS market,
         CASE WHEN ord % 60 = 4 THEN '2025-13' ELSE strftime(period, '%Y-%m') END AS period, ord, hours_binding,
         shadow_price_max, CASE WHEN ord % 70 = 5 THEN 1e9 ELSE shadow_price_mean END AS mean FROM v_history)
SELECT 'market' AS rule, COUNT(*) AS n FROM t WHERE ord % 40 = 3 HAVING COUNT(*) > 0
UNION ALL SELECT 'period', COUNT(*) FROM t WHERE ord % 60 = 4 HAVING COUNT(*) > 0
UNION ALL SELECT 'hours_binding', COUNT(*) FROM t WHERE ord % 50 IN (1, 2) HAVING COUNT(*) > 0
UNION ALL SELECT 'mean_exceeds_max', COUNT(*) FROM t WHERE mean > shadow_price_max HAVING COUNT(*) > 0
UNION ALL SELECT 'congestion_cost_usd', COUNT(*) FROM t WHERE ord % 80 = 6 HAVING COUNT(*) > 0
UNION ALL SELECT 'repeated', COUNT(*) FROM (SELECT 1 FROM t GROUP BY constraint_id, market, period HAVING COUNT(*) > 1)
  HAVING COUNT(*) > 0""")


def coverage_contract(spark, folder):
    c = view(spark, folder, "v_coverage")
    m = F.month("period")
    rows = c.select(
        "market", numeric.month_text(F.col("period")).alias("period"),
        F.when(m == 2, "30").otherwise(F.col("days_expected").cast("string")).alias("days_expected"),
        F.when(m == 3, "32").otherwise(F.col("days_covered").cast("string")).alias("days_covered"),
        F.when(m == 4, "raw:a;raw:a").when(m == 5, "").otherwise(F.col("raw_refs")).alias("raw_refs"))
    return validation.coverage_violations(rows).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


COVERAGE_CONTRACT = duck(["v_coverage"], """, t AS (SELECT *, EXTRACT(MONTH FROM period) AS m FROM v_coverage)
SELECT 'days_expected' AS rule, COUNT(*) AS n FROM t WHERE m = 2 HAVING COUNT(*) > 0
UNION ALL SELECT 'days_covered', COUNT(*) FROM t WHERE m = 3 HAVING COUNT(*) > 0
UNION ALL SELECT 'raw_refs', COUNT(*) FROM t WHERE m = 4 HAVING COUNT(*) > 0
UNION ALL SELECT 'uncited', COUNT(*) FROM t WHERE (m = 5 AND days_covered > 0) OR (m = 3 AND raw_refs = '') HAVING COUNT(*) > 0""")


def consistency(spark, folder):
    return validation.consistency_violations(
        view(spark, folder, "v_history"), view(spark, folder, "v_coverage")).withColumn(
        "period", F.col("period").cast("string"))


CONSISTENCY = duck(["v_history", "v_coverage"], """
SELECT h.constraint_id, h.market, CAST(h.period AS VARCHAR) AS period,
       CASE WHEN COALESCE(days_covered, 0) = 0 THEN 'no_covered_days' ELSE 'too_many_hours' END AS rule
FROM v_history h LEFT JOIN v_coverage c ON h.market = c.market AND h.period = c.period
WHERE COALESCE(days_covered, 0) = 0 OR hours_binding > 24 * days_covered + 1""")


def footprint_contract(spark, folder):
    f = view(spark, folder, "v_footprint")
    n = F.substring("element_id", 6, 20).cast("bigint")
    planted = (
        f.withColumn("evidence", F.when(F.pmod(n, F.lit(7)) == 1, " ").otherwise(F.col("evidence")))
        .withColumn("reviewed_on", F.when((F.col("reviewed_on") != "") & (F.pmod(n, F.lit(11)) == 2), "2025-3-4")
                    .otherwise(F.col("reviewed_on")))
        .withColumn("corridor_id", F.when((F.col("corridor_id") != "") & (F.pmod(n, F.lit(13)) == 3), "OTHER")
                    .otherwise(F.col("corridor_id")))
        .withColumn("element_kind", F.when(F.pmod(n, F.lit(17)) == 4, "planet").otherwise(F.col("element_kind"))))
    return validation.footprint_violations(planted).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


FOOTPRINT_CONTRACT = duck(["v_footprint"], """, raw AS (
  SELECT *, CAST(substr(element_id, 6) AS BIGINT) AS k FROM v_footprint), f AS (
  SELECT k, element_kind, constraint_id, match_status, reviewed_by, reviewed_on, k % 7 = 1 AS no_evidence,
         CASE WHEN corridor_id <> '' AND k % 13 = 3 THEN 'OTHER' ELSE corridor_id END AS corridor_id FROM raw)
SELECT 'several_corridors' AS rule, COUNT(*) AS n FROM (
  SELECT constraint_id FROM f WHERE match_status = 'verified' AND corridor_id <> ''
  GROUP BY 1 HAVING COUNT(DISTINCT corridor_id) > 1) HAVING COUNT(*) > 0
UNION ALL SELECT 'element_kind', COUNT(*) FROM f WHERE k % 17 = 4 HAVING COUNT(*) > 0
UNION ALL SELECT 'reviewed_on', COUNT(*) FROM f WHERE match_status = 'verified' AND k % 11 = 2 HAVING COUNT(*) > 0
UNION ALL SELECT 'uncertain_without_evidence', COUNT(*) FROM f WHERE match_status = 'uncertain' AND no_evidence HAVING COUNT(*) > 0
UNION ALL SELECT 'verified_without_evidence', COUNT(*) FROM f WHERE match_status = 'verified' AND no_evidence HAVING COUNT(*) > 0""")

def table_round_trip(spark, folder):
    """Names with quotes, commas and line breaks, written as a table and read back, with the manifest's row count."""
    root = shared_folder(spark)
    cells = view(spark, folder, "v_names").select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit('a "'), "text", F.lit('", b\n\\c')).alias("text"))
    write_table(cells, root, "names", ["id"], {"source": "s", "source_version": "v", "retrieved_at": "2026-01-01T00:00:00Z"})
    rows = spark.read.json(f"{root}/manifest").select("rows")
    return read_text_table(spark, f"{root}/normalized/names").join(rows)


ROUND_TRIP = duck(["v_names"], """
SELECT CAST(id AS VARCHAR) AS id, 'a "' || text || '", b' || chr(10) || chr(92) || 'c' AS text, (SELECT COUNT(*) FROM v_names) AS rows FROM v_names""")


QUERIES = {
    "table_round_trip": (table_round_trip, ROUND_TRIP),
    "provider_readings": (provider_readings, READINGS),
    "provider_join": (provider_join, PROVIDER_JOIN),
    "triangulate_voltage": (triangulate, TRIANGULATE),
    "line_facts": (line_facts, LINE_FACTS),
    "flag_report": (flag_report, FLAG_REPORT),
    "invariant_violations": (invariant_violations, INVARIANTS),
    "name_keys": (name_keys, NAME_KEYS),
    "classify_filings": (classify_filings, CLASSIFY),
    "match_filings": (match_filings, MATCH),
    "filing_statistics": (filing_statistics, FILING_STATS),
    "filing_flags": (filing_flags, FILING_FLAGS),
    "respondents_without_rows": (respondents_without_rows, NO_ROWS),
    "release_metrics": (release_metrics, RELEASE),
    "volts_reported": (volts_reported, VOLTS),
    "deployments_in_filings": (deployments, DEPLOYMENTS),
    "place_requests": (place_requests, PLACE),
    "queue_statistics": (queue_statistics, QUEUE_STATS),
    "coverage_test": (coverage_test, COVERAGE_TEST),
    "month_coverage": (month_coverage, MONTH_COVERAGE),
    "duplicate_keys": (duplicate_keys, DUPLICATE_KEYS),
    "history_contract": (history_contract, HISTORY_CONTRACT),
    "coverage_contract": (coverage_contract, COVERAGE_CONTRACT),
    "consistency": (consistency, CONSISTENCY),
    "footprint_contract": (footprint_contract, FOOTPRINT_CONTRACT),
}
