"""Hourly rows, dollars and authority hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import duck, view
from fluxsieve import fixed
from fluxsieve.functions import numeric, text
from fluxsieve.operators import rollups
from fluxsieve.session import shelve, shelved
from fluxsieve.sources.market import binding_hours, dollar_fields, month_violations, operating_plants, settled_fields

KEPT = """, kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY utc, name, monitored, contingency ORDER BY ord) AS rn
                 FROM v_hours) WHERE rn = 1)"""


def ends_sql(m: str) -> str:
    return (f"array_to_string(list_sort(list_transform(string_split(regexp_replace({m}, '^[^ ]* ', ''), ' - '), "
            f"lambda e: trim(e))), ' - ')")


def element_key_sql(m: str) -> str:
    return f"CASE WHEN {m} LIKE 'LN %' THEN 'LN ' || {ends_sql(m)} ELSE {m} END"


ELEMENT = """CASE WHEN monitored = '' THEN 'blank' WHEN monitored = 'Multi-Element Constraint' THEN 'multi'
  WHEN split_part(monitored, ' ', 1) = 'LN' THEN 'ln' WHEN split_part(monitored, ' ', 1) = 'XFMR' THEN 'xfmr'
  ELSE 'other' END"""


def _mode_sql(column: str) -> str:
    return f""", mode_{column} AS (
  SELECT name, contingency, {column}, n FROM (
    SELECT name, contingency, {column}, COUNT(*) OVER (PARTITION BY name, contingency) AS n,
           row_number() OVER (PARTITION BY name, contingency ORDER BY c DESC, {column}) AS rn
    FROM (SELECT name, contingency, {column}, COUNT(*) AS c FROM kept GROUP BY 1, 2, 3)) WHERE rn = 1)"""


ROLLED = KEPT + _mode_sql("monitored") + _mode_sql("contingent") + _mode_sql("kind") + f""", rolled AS (
  SELECT h.*, m.monitored, m.n AS n_monitored, c.contingent, k.kind, {ELEMENT.replace('monitored', 'm.monitored')} AS element
  FROM (SELECT name, contingency, COUNT(DISTINCT utc) AS hours_binding,
               COUNT(DISTINCT CASE WHEN state = 'BREACHED' THEN utc END) AS breached_hours,
               COUNT(DISTINCT month) AS months_binding,
               CAST(SUM(CAST(ABS(price) AS DECIMAL(20, 4))) AS DOUBLE) AS shadow_price_sum,
               CAST(MAX(CAST(ABS(price) AS DECIMAL(20, 4))) AS DOUBLE) AS max_abs_shadow_price
        FROM kept GROUP BY 1, 2) h
  JOIN mode_monitored m USING (name, contingency) JOIN mode_contingent c USING (name, contingency)
  JOIN mode_kind k USING (name, contingency)), flow AS (
  SELECT *, CASE WHEN element = 'other' THEN 'other'
                 WHEN element = 'blank' AND name LIKE '%PHSHFT%' THEN 'phase_shifter' END AS excluded FROM rolled)"""

HOURS = ["v_hours"]


def flowgate_rollup(spark, folder):
    return rollups.flowgates(view(spark, folder, "v_hours")).select(
        "constraint_id", "hours_binding", "breached_hours", "months_binding",
        "shadow_price_sum", "max_abs_shadow_price", "monitored", "n_monitored", "contingent", "kind", "element",
        "excluded", "ctype", "monitored_facility", "contingency_to", "contingency_kv")


FLOWGATE_ROLLUP = duck(HOURS, ROLLED + f"""
SELECT name || '|' || contingency AS constraint_id, hours_binding, breached_hours, months_binding,
       shadow_price_sum, max_abs_shadow_price, monitored, n_monitored, contingent, kind, element, excluded,
       CASE WHEN element = 'ln' THEN 'thermal' WHEN element = 'xfmr' THEN 'transformer' ELSE 'interface' END AS ctype,
       CASE WHEN element = 'ln' THEN 'LN ' || {ends_sql('monitored')}
            WHEN element = 'multi' THEN monitored || ' ' || name ELSE monitored END AS monitored_facility,
       CASE WHEN contingent <> 'BASE' AND contingent LIKE '%:%'
                 AND regexp_full_match(trim(split_part(contingent, ':', 1)), '[A-Z][A-Z0-9&_]*( [A-Z][A-Z0-9&_]*)*')
            THEN trim(split_part(contingent, ':', 1)) ELSE '' END AS contingency_to,
       CASE WHEN contingent <> 'BASE' AND regexp_full_match(trim(split_part(contingent, ':', 3)), '\\d+(\\.\\d+)?')
            THEN trim(split_part(contingent, ':', 3)) ELSE '' END AS contingency_kv
FROM flow""")


def keep_first_hours(spark, folder):
    kept = rollups.keep_first_hours(view(spark, folder, "v_hours"))
    return kept.select(F.col("utc").cast("string").alias("utc"), "name", "monitored", "contingency", "contingent",
                       "kind", "state", "price", F.col("month").cast("string").alias("month"))


KEEP_FIRST = duck(HOURS, KEPT + """
SELECT CAST(utc AS VARCHAR) AS utc, name, monitored, contingency, contingent, kind, state, price,
       CAST(month AS VARCHAR) AS month FROM kept""")


def duplicate_hours(spark, folder):
    return rollups.duplicate_hours(view(spark, folder, "v_hours"))


DUPLICATE_HOURS = duck(HOURS, """, marked AS (
  SELECT row_number() OVER w AS rn, price IS DISTINCT FROM first_value(price) OVER w
         OR state IS DISTINCT FROM first_value(state) OVER w
         OR contingent IS DISTINCT FROM first_value(contingent) OVER w AS other
  FROM v_hours WINDOW w AS (PARTITION BY utc, name, monitored, contingency ORDER BY ord))
SELECT COUNT(*) FILTER (WHERE rn > 1) AS duplicates, COUNT(*) FILTER (WHERE rn > 1 AND other) AS conflicting
FROM marked""")


def exclusion_summary(spark, folder):
    s = rollups.exclusion_summary(rollups.flowgates(view(spark, folder, "v_hours")))
    return s.withColumn("share", F.round("share", 9))


EXCLUSION = duck(HOURS, ROLLED + """
SELECT COALESCE(excluded, 'kept') AS reason, COUNT(*) AS flowgates, CAST(SUM(hours_binding) AS BIGINT) AS hours,
       CAST(SUM(CAST(shadow_price_sum AS DECIMAL(28, 4))) AS DOUBLE) AS abs_price,
       ROUND(CAST(SUM(CAST(shadow_price_sum AS DECIMAL(28, 4))) AS DOUBLE)
             / (SELECT CAST(SUM(CAST(shadow_price_sum AS DECIMAL(28, 4))) AS DOUBLE) FROM flow), 9) AS share
FROM flow GROUP BY 1""")


def spelling_summary(spark, folder):
    return rollups.spelling_summary(rollups.keep_first_hours(view(spark, folder, "v_hours")))


SPELLING = duck(HOURS, KEPT + f""", s AS (
  SELECT DISTINCT name, contingency, monitored, {ELEMENT} AS element, {element_key_sql('monitored')} AS key FROM kept)
SELECT COUNT(*) FILTER (WHERE n > 1) AS several_spellings, COUNT(*) FILTER (WHERE n > 1 AND k = 1) AS reversed_only,
       COUNT(*) FILTER (WHERE e > 1) AS mixed_elements
FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT key) AS k, COUNT(DISTINCT element) AS e FROM s GROUP BY name, contingency)""")


def contingency_parts(spark, folder):
    texts = view(spark, folder, "v_hours").groupBy("contingent").agg(F.count(F.lit(1)).alias("n"))
    return texts.select("contingent", "n", text.contingency_owner(F.col("contingent")).alias("owner"),
                        text.contingency_kv(F.col("contingent")).alias("kv"))


CONTINGENCY_PARTS = duck(HOURS, """
SELECT contingent, COUNT(*) AS n,
       CASE WHEN contingent <> 'BASE' AND strpos(contingent, ':') > 0
                 AND regexp_full_match(split_part(contingent, ':', 1), '[A-Z][A-Z0-9&_]*( [A-Z][A-Z0-9&_]*)*')
            THEN split_part(contingent, ':', 1) ELSE '' END AS owner,
       CASE WHEN regexp_full_match(split_part(contingent, ':', 3), '[0-9]+') THEN split_part(contingent, ':', 3)
            ELSE '' END AS kv
FROM v_hours GROUP BY contingent""")


def hour_months(spark, folder):
    """Rows filed under another month than their hour: every hour is filed under its calendar month here, so
    those that end at the first midnight of a month are wrong."""
    rows = view(spark, folder, "v_hours").select(
        F.date_format(F.date_trunc("day", "utc"), fixed.MARKET_TIME).alias("Interval"), F.trunc("utc", "month").alias("file_month"))
    return month_violations(rows).groupBy(F.col("file_month").cast("string").alias("file_month")).agg(
        F.count(F.lit(1)).alias("n"))


HOUR_MONTHS = duck(HOURS, """
SELECT CAST(CAST(date_trunc('month', utc) AS DATE) AS VARCHAR) AS file_month, COUNT(*) AS n FROM v_hours
WHERE EXTRACT(DAY FROM utc) = 1 GROUP BY 1""")


def _hour_text(spark, folder):
    """The hourly rows as their published text columns."""
    stamp = F.date_format("utc", fixed.MARKET_TIME)
    return view(spark, folder, "v_hours").where(numeric.usable_constraint_name(F.col("name"), F.col("contingency"))).select(
        stamp.alias("Interval"), stamp.alias("GMTIntervalEnd"), F.col("name").alias("Constraint Name"),
        F.col("kind").alias("Constraint Type"), F.col("state").alias("State"), F.col("price").cast("string").alias("Shadow Price"),
        F.col("monitored").alias("Monitored Facility"), F.col("contingent").alias("Contingent Facility"),
        F.col("contingency").alias("Contingency Name"), F.col("month").alias("file_month"))


def binding_text(spark, folder):
    """Published hourly text parsed into binding rows."""
    return binding_hours(_hour_text(spark, folder)).groupBy("name", "contingency", "month").agg(
        F.count(F.lit(1)).alias("n"), F.min("utc").alias("first"), F.max("utc").alias("last"),
        F.sum(F.col("price").cast("decimal(20,4)")).cast("double").alias("price"), F.max("monitored").alias("monitored"),
        F.max("contingent").alias("contingent"), F.max("kind").alias("kind"), F.max("state").alias("state"))


BINDING_TEXT = duck(HOURS, """
SELECT name, contingency, month, COUNT(*) AS n, MIN(utc) AS first, MAX(utc) AS last, CAST(SUM(CAST(price AS DECIMAL(20, 4))) AS DOUBLE) AS price,
       MAX(monitored) AS monitored, MAX(contingent) AS contingent, MAX(kind) AS kind, MAX(state) AS state FROM v_hours GROUP BY 1, 2, 3""")


def dollar_text(spark, folder):
    """Published monthly dollars parsed from text."""
    text_rows = view(spark, folder, "v_dollars").select(
        F.date_format("month", "yyyyMM").alias("Date"), F.col("name").alias("Constraint Name"),
        F.col("contingency").alias("Contingency Name"), F.col("monitored").alias("Monitored Facility"),
        F.col("amount").cast("string").alias("Sum"))
    return dollar_fields(text_rows).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(20,4)")).cast("double").alias("usd"),
        F.count_distinct("name").alias("names"))


def settled_text(spark, folder):
    """Settled collections parsed from text."""
    text_rows = view(spark, folder, "v_settled").select(
        F.date_format("month", "MM/yyyy").alias("Month"), F.col("collected").cast("string").alias("DA Collected"))
    return settled_fields(text_rows).groupBy("month").agg(
        F.sum(F.col("collected").cast("decimal(20,4)")).cast("double").alias("collected"))


def plants(spark, folder):
    """Operating plants of a year: generators from line items, plants from orders."""
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    generators = items.select(
        F.col("l_orderkey").alias("plant_id_eia"), F.make_date(F.lit(2000) + F.pmod("l_orderkey", F.lit(2)).cast("int"), F.lit(1), F.lit(1)).alias("report_date"),
        F.when(F.col("l_returnflag") == "N", "OP").otherwise("RE").alias("operational_status_code"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("capacity_mw"))
    places = orders.where("o_orderkey % 5 <> 0").select(
        F.col("o_orderkey").alias("plant_id_eia"), F.make_date(F.lit(2000) + F.pmod("o_orderkey", F.lit(2)).cast("int"), F.lit(1), F.lit(1)).alias("report_date"),
        F.concat(F.lit("P "), "o_orderstatus").alias("plant_name_eia"), F.lit("38.5").alias("latitude"), F.lit("-97.25").alias("longitude"),
        F.when(F.pmod("o_orderkey", F.lit(3)) == 0, " ").otherwise(F.col("o_orderpriority")).alias("balancing_authority_code_eia"))
    return operating_plants(generators, places, 2000)


PLANTS = """
WITH g AS (SELECT l_orderkey AS plant_id_eia, CAST(SUM(CAST(l_quantity AS DECIMAL(20, 6))) AS DOUBLE) AS mw, COUNT(*) AS n_generators FROM lineitem
  WHERE l_orderkey % 2 = 0 AND l_returnflag = 'N' AND l_linenumber <> 3 GROUP BY 1 HAVING SUM(l_quantity) > 0)
SELECT g.plant_id_eia, 'P ' || o_orderstatus AS plant_name, CASE WHEN o_orderkey IS NOT NULL THEN 38.5 END AS lat, CASE WHEN o_orderkey IS NOT NULL THEN -97.25 END AS lon,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS ba, round_even(mw, 3) AS capacity_mw, n_generators
FROM g LEFT JOIN orders ON o_orderkey = g.plant_id_eia AND o_orderkey % 5 <> 0"""


# --- dollars ---------------------------------------------------------------------------

DOLLARS = ["v_dollars"]
ONCE = """, once AS (
  SELECT month, name, contingency, first(monitored ORDER BY ord) AS monitored,
         -CAST(first(amount ORDER BY ord) AS DECIMAL(20, 4)) AS usd FROM v_dollars GROUP BY 1, 2, 3)"""


def dollar_duplicates(spark, folder):
    return rollups.dollar_duplicates(view(spark, folder, "v_dollars")).withColumn(
        "month", F.col("month").cast("string"))


DOLLAR_DUPLICATES = duck(DOLLARS, """
SELECT CAST(month AS VARCHAR) AS month, name, contingency, COUNT(*) AS copies, COUNT(DISTINCT amount) > 1 AS conflict
FROM v_dollars GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""")


def flowgate_dollars(spark, folder):
    return rollups.flowgate_dollars(rollups.unique_dollars(view(spark, folder, "v_dollars"))).select(
        "constraint_id", "rent_usd", "max_month_usd", "months_paid", "negative_months")


FLOWGATE_DOLLARS = duck(DOLLARS, ONCE + """
SELECT name || '|' || contingency AS constraint_id,
       CAST(SUM(CASE WHEN usd >= 0 THEN usd END) AS DOUBLE) AS rent_usd,
       CAST(MAX(CASE WHEN usd >= 0 THEN usd END) AS DOUBLE) AS max_month_usd,
       COUNT(CASE WHEN usd >= 0 THEN 1 END) AS months_paid, COUNT(CASE WHEN usd < 0 THEN 1 END) AS negative_months
FROM once GROUP BY name, contingency""")


def reconcile_months(spark, folder):
    unique = rollups.unique_dollars(view(spark, folder, "v_dollars"))
    found = rollups.reconcile_months(unique, view(spark, folder, "v_settled"), 0.9)
    return found.select("check", F.col("month").cast("string").alias("month"), F.round("value", 6).alias("value"))


RECONCILE = duck(["v_dollars", "v_settled"], ONCE + """, m AS (
  SELECT COALESCE(a.month, b.month) AS month, COALESCE(cbc, 0) AS cbc, COALESCE(tcr, 0) AS tcr
  FROM (SELECT month, CAST(SUM(usd) AS DOUBLE) AS cbc FROM once WHERE usd >= 0 GROUP BY 1) a
  FULL JOIN (SELECT month, CAST(SUM(CAST(collected AS DECIMAL(20, 4))) AS DOUBLE) AS tcr FROM v_settled GROUP BY 1) b
  ON a.month = b.month), r AS (
  SELECT *, CASE WHEN cbc > 0 AND tcr > 0 THEN cbc / tcr END AS ratio FROM m), med AS (
  SELECT ratio AS median FROM (SELECT ratio, row_number() OVER (ORDER BY ratio) AS rn, COUNT(*) OVER () AS n
                               FROM r WHERE ratio IS NOT NULL) WHERE rn = n // 2 + 1)
SELECT check_name AS "check", CAST(month AS VARCHAR) AS month, ROUND(ratio, 6) AS value FROM (
  SELECT month, ratio, CASE WHEN ratio IS NULL THEN 'no_dollars' WHEN ratio < 0.8 OR ratio > 2.0 THEN 'ratio_outside_band'
     WHEN ratio < 0.8 * (SELECT median FROM med) OR ratio > 1.5 * (SELECT median FROM med) THEN 'ratio_far_from_median'
     END AS check_name FROM r) WHERE check_name IS NOT NULL
UNION ALL SELECT 'joined_share_below_floor', NULL, 0.9""")


def join_dollars(spark, folder):
    with shelved(view(spark, folder, "v_hours").select(*rollups.HOUR_FIELDS)) as hours:  # gone before dollars are made
        kept = [rollups.keep_first_hours(p) for p in rollups.by_flowgate(hours)]
        rolled = shelve(rollups.united([rollups.flowgates_of(k) for k in kept]).select("name", "contingency", "constraint_id"))
        spelled = shelve(rollups.united([rollups.spellings(k) for k in kept]))
    dollars = shelve(view(spark, folder, "v_dollars"))
    unique = rollups.united([rollups.unique_dollars(p) for p in rollups.by_flowgate(dollars)])
    return rollups.join_dollars(rolled, spelled, unique).select(
        "constraint_id", "rent_musd", "max_month_cost_musd", "rent_basis", "flags")


JOIN_DOLLARS = duck(["v_hours", "v_dollars"], KEPT + ONCE + f""", money AS (
  SELECT name, contingency, SUM(CASE WHEN usd >= 0 THEN usd END) AS rent, MAX(CASE WHEN usd >= 0 THEN usd END) AS top,
         COUNT(CASE WHEN usd < 0 THEN 1 END) AS neg FROM once GROUP BY 1, 2), alike AS (
  SELECT DISTINCT a.name, a.contingency FROM
    (SELECT DISTINCT name, contingency, {element_key_sql('monitored')} AS k FROM once) a JOIN
    (SELECT DISTINCT name, contingency, {element_key_sql('monitored')} AS k FROM kept) b
    ON a.name = b.name AND a.contingency = b.contingency AND a.k = b.k)
SELECT f.name || '|' || f.contingency AS constraint_id,
       CASE WHEN s.name IS NOT NULL AND rent IS NOT NULL THEN round_even(CAST(rent AS DOUBLE), 0) / 1e6 END AS rent_musd,
       CASE WHEN s.name IS NOT NULL AND rent IS NOT NULL THEN round_even(CAST(top AS DOUBLE), 0) / 1e6 END AS max_month_cost_musd,
       CASE WHEN s.name IS NOT NULL AND rent IS NOT NULL THEN 'spp_congestion_by_constraint' END AS rent_basis,
       concat_ws(';', CASE WHEN m.name IS NOT NULL AND s.name IS NULL THEN 'cbc_monitored_mismatch' END,
                 CASE WHEN neg > 0 THEN 'cbc_negative_rent_months=' || neg END) AS flags
FROM (SELECT DISTINCT name, contingency FROM kept) f
LEFT JOIN money m ON f.name = m.name AND f.contingency = m.contingency
LEFT JOIN alike s ON f.name = s.name AND f.contingency = s.contingency""")


# --- authority hours -------------------------------------------------------------------

def _published(spark, folder):
    v = view(spark, folder, "v_ba_text")
    return v.select("ba", "utc", F.col("adjusted").alias("Demand (MW) (Adjusted)"), F.col("raw").alias("Demand (MW)"),
                    F.col("netgen").alias("Net Generation (MW) (Adjusted)"),
                    F.col("wind_a").alias("Net Generation (MW) from Wind without Integrated Battery Storage"),
                    F.col("wind_b").alias("Net Generation (MW) from Wind with Integrated Battery Storage"))


def authority_hours(spark, folder):
    return rollups.authority_hours(_published(spark, folder)).withColumn(
        "utc", F.col("utc").cast("string")).withColumn("wind_share", F.round("wind_share", 9))


HOURLY = """, hourly AS (
  SELECT ba, utc,
         COALESCE(TRY_CAST(NULLIF(REPLACE(adjusted, ',', ''), '') AS DOUBLE), TRY_CAST(raw AS DOUBLE)) AS demand,
         CASE WHEN TRY_CAST(REPLACE(adjusted, ',', '') AS DOUBLE) IS NOT NULL THEN REPLACE(adjusted, ',', '') ELSE raw END AS demand_text,
         CASE WHEN TRY_CAST(REPLACE(adjusted, ',', '') AS DOUBLE) IS NOT NULL THEN 'Demand (MW) (Adjusted)'
              WHEN raw IS NOT NULL THEN 'Demand (MW)' END AS demand_column,
         CASE WHEN CAST(netgen AS DOUBLE) > 0 AND (wind_a <> '' OR wind_b <> '')
              THEN (COALESCE(TRY_CAST(NULLIF(wind_a, '') AS DOUBLE), 0) + COALESCE(TRY_CAST(NULLIF(wind_b, '') AS DOUBLE), 0))
                   / CAST(netgen AS DOUBLE) END AS wind_share
  FROM v_ba_text)"""

AUTHORITY = duck(["v_ba_text"], HOURLY + """
SELECT ba, CAST(utc AS VARCHAR) AS utc, demand, demand_text, demand_column, ROUND(wind_share, 9) AS wind_share FROM hourly""")


def representative_hours(spark, folder):
    return rollups.representative_hours(rollups.authority_hours(_published(spark, folder))).withColumn(
        "utc_hour", F.col("utc_hour").cast("string"))


REPRESENTATIVE = duck(["v_ba_text"], HOURLY + """, d AS (
  SELECT *, row_number() OVER (PARTITION BY ba ORDER BY demand DESC, utc) AS hi,
         row_number() OVER (PARTITION BY ba ORDER BY demand, utc) AS lo,
         row_number() OVER (PARTITION BY ba ORDER BY wind_share DESC NULLS LAST, utc) AS wi,
         COUNT(*) OVER (PARTITION BY ba) AS n FROM hourly WHERE demand IS NOT NULL), picked AS (
  SELECT 'peak' AS snapshot, 'max demand hour' AS why, * FROM d WHERE hi = 1
  UNION ALL SELECT 'offpeak', 'min demand hour', * FROM d WHERE lo = 1
  UNION ALL SELECT 'shoulder', 'median demand hour (lower median)', * FROM d WHERE lo = (n - 1) // 2 + 1
  UNION ALL SELECT 'windhigh', 'max wind share of net generation', * FROM d WHERE wi = 1 AND wind_share IS NOT NULL)
SELECT ba, snapshot, demand AS load_mw, CAST(utc AS VARCHAR) AS utc_hour, why || '; ' || demand_column AS basis,
       ROUND(wind_share, 4) AS wind_share FROM picked""")


QUERIES = {
    "flowgate_rollup": (flowgate_rollup, FLOWGATE_ROLLUP),
    "keep_first_hours": (keep_first_hours, KEEP_FIRST),
    "duplicate_hours": (duplicate_hours, DUPLICATE_HOURS),
    "exclusion_summary": (exclusion_summary, EXCLUSION),
    "spelling_summary": (spelling_summary, SPELLING),
    "contingency_parts": (contingency_parts, CONTINGENCY_PARTS),
    "hour_ending_months": (hour_months, HOUR_MONTHS),
    "binding_text": (binding_text, BINDING_TEXT),
    "dollar_text": (dollar_text, duck(["v_dollars"], """
SELECT month, COUNT(*) AS n, CAST(SUM(CAST(amount AS DECIMAL(20, 4))) AS DOUBLE) AS usd, COUNT(DISTINCT name) AS names FROM v_dollars GROUP BY 1""")),
    "settled_text": (settled_text, duck(["v_settled"], """
SELECT month, CAST(SUM(CAST(collected AS DECIMAL(20, 4))) AS DOUBLE) AS collected FROM v_settled GROUP BY 1""")),
    "operating_plants": (plants, PLANTS),
    "dollar_duplicates": (dollar_duplicates, DOLLAR_DUPLICATES),
    "flowgate_dollars": (flowgate_dollars, FLOWGATE_DOLLARS),
    "reconcile_months": (reconcile_months, RECONCILE),
    "join_dollars": (join_dollars, JOIN_DOLLARS),
    "authority_hours": (authority_hours, AUTHORITY),
    "representative_hours": (representative_hours, REPRESENTATIVE),
}
