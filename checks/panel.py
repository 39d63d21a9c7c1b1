"""Footprint panels, lineage, reports and small functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import duck, view
from fluxsieve.functions import numeric, text
from fluxsieve.operators import lineage, validation
from fluxsieve.plans import panel, report

PANEL = ["v_footprint", "v_history", "v_coverage"]
CELLS = """, months AS (SELECT CAST(unnest(generate_series(CAST((SELECT MIN(period) FROM v_coverage) AS TIMESTAMP),
    CAST((SELECT MAX(period) FROM v_coverage) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS period), grid AS (
  SELECT c.constraint_id, m.market, p.period FROM (SELECT DISTINCT constraint_id FROM v_footprint WHERE match_status = 'verified') c
  CROSS JOIN (SELECT DISTINCT market FROM v_coverage) m CROSS JOIN months p), cells AS (
  SELECT g.*, COALESCE(v.days_covered, 0) AS days_covered, COALESCE(v.days_expected, 0) AS days_expected,
         COALESCE(v.raw_refs, '') AS raw_refs,
         CASE WHEN COALESCE(v.days_covered, 0) = 0 THEN 'none' WHEN v.days_covered = v.days_expected THEN 'full' ELSE 'partial' END AS coverage,
         h.hours_binding AS h, h.shadow_price_max AS mx, h.shadow_price_mean AS mn, h.congestion_cost_usd AS cost
  FROM grid g LEFT JOIN v_coverage v ON g.market = v.market AND g.period = v.period
  LEFT JOIN v_history h ON g.constraint_id = h.constraint_id AND g.market = h.market AND g.period = h.period)"""
ZERO_ID = """'drv:' || substr(sha256(CAST('panel.cell:' || market || ':' || ym || ':' || constraint_id || ':hours_binding' || chr(0)
   || 'panel:coverage:' || market || ':' || ym AS BLOB)), 1, 16)"""


def _inputs(spark, folder):
    return [view(spark, folder, v) for v in PANEL]


def panel_monthly(spark, folder):
    return panel.monthly_rows(panel.panel_cells(*_inputs(spark, folder)))


MONTHLY = duck(PANEL, CELLS + f"""
SELECT constraint_id, market, ym AS period, coverage, days_covered, days_expected,
       CASE WHEN coverage = 'none' THEN 'unknown' WHEN h IS NOT NULL THEN 'yes' ELSE 'no' END AS binding,
       CASE WHEN coverage <> 'none' THEN COALESCE(h, 0) END AS hours_binding,
       CASE WHEN coverage <> 'none' THEN mx END AS shadow_price_max, CASE WHEN coverage <> 'none' THEN mn END AS shadow_price_mean,
       CASE WHEN coverage <> 'none' THEN cost END AS congestion_cost_usd,
       CASE WHEN coverage = 'none' THEN 'no source coverage for this month' WHEN h IS NULL THEN ''
            ELSE concat_ws('; ', CASE WHEN mx IS NULL THEN 'shadow_price_max not published' END,
                           CASE WHEN mn IS NULL THEN 'shadow_price_mean not published' END,
                           CASE WHEN cost IS NULL THEN 'congestion_cost_usd not published' END) END AS missing,
       CASE WHEN coverage = 'partial' THEN 'partial_coverage' ELSE '' END AS flags, raw_refs,
       CASE WHEN coverage = 'none' THEN '' WHEN h IS NOT NULL THEN 'panel:' || market || ':' || ym || ':' || constraint_id || ':hours_binding'
            ELSE {ZERO_ID} END AS hours_lineage_id
FROM (SELECT *, strftime(period, '%Y-%m') AS ym FROM cells)""")


def panel_summary(spark, folder):
    footprint, history, coverage = _inputs(spark, folder)
    cells = panel.panel_cells(footprint, history, coverage)
    s = panel.panel_order(panel.panel_summary(cells, footprint, history))
    dates = {c: F.col(c).cast("string") for c in ("window_start", "window_end", "first_binding", "last_binding")}
    return s.withColumns({**dates, "shadow_price_mean": F.round("shadow_price_mean", 6)})


def _gap(c: str, name: str) -> str:
    return (f"CASE WHEN nb > 0 AND n_{c} < nb THEN '{name}: not published for ' || (nb - n_{c}) || ' of ' || nb "
            "|| ' binding months' END")


SUMMARY = duck(PANEL, CELLS + f""", ided AS (
  SELECT *, CASE WHEN coverage = 'none' THEN NULL WHEN h IS NOT NULL THEN 'panel:' || market || ':' || ym || ':' || constraint_id || ':hours_binding'
            ELSE {ZERO_ID} END AS fact FROM (SELECT *, strftime(period, '%Y-%m') AS ym FROM cells)), r AS (
  SELECT constraint_id, market, MIN(period) AS ws, MAX(period) AS we, COUNT(*) AS months,
         COUNT(*) FILTER (WHERE coverage = 'full') AS mf, COUNT(*) FILTER (WHERE coverage = 'partial') AS mp,
         COALESCE(string_agg(CASE WHEN coverage = 'none' THEN ym END, ';' ORDER BY ym), '') AS gaps,
         COUNT(*) FILTER (WHERE b) AS nb, MIN(CASE WHEN b THEN period END) AS f, MAX(CASE WHEN b THEN period END) AS l,
         CAST(SUM(CASE WHEN coverage <> 'none' THEN COALESCE(h, 0) END) AS DOUBLE) AS hours, MAX(CASE WHEN b THEN mx END) AS mx,
         SUM(CASE WHEN b THEN mn * h END) / SUM(CASE WHEN b THEN h END) AS mn,
         CAST(SUM(CASE WHEN b THEN CAST(cost AS DECIMAL(24, 4)) END) AS DOUBLE) AS cost,
         COUNT(CASE WHEN b THEN mx END) AS n_mx, COUNT(CASE WHEN b THEN mn END) AS n_mn, COUNT(CASE WHEN b THEN cost END) AS n_cost,
         string_agg(chr(0) || fact, '' ORDER BY fact) AS facts
  FROM (SELECT *, coverage <> 'none' AND h IS NOT NULL AS b FROM ided) GROUP BY 1, 2), seen AS (SELECT DISTINCT constraint_id FROM v_history),
el AS (SELECT constraint_id, COALESCE(string_agg(DISTINCT NULLIF(corridor_id, ''), ';' ORDER BY NULLIF(corridor_id, '')), '') AS c,
         string_agg(DISTINCT element_id, ';' ORDER BY element_id) AS e FROM v_footprint WHERE match_status = 'verified' GROUP BY 1),
fac AS (SELECT constraint_id, string_agg(t, ' | ' ORDER BY o, t) AS t FROM (
    SELECT constraint_id, monitored_facility || ' / ' || contingent_facility AS t, MIN(ord) AS o FROM v_history GROUP BY 1, 2) GROUP BY 1)
SELECT r.constraint_id, r.market, el.c AS corridor_ids, el.e AS footprint_elements, CAST(ws AS VARCHAR) AS window_start, CAST(we AS VARCHAR) AS window_end,
       months, mf AS months_full, mp AS months_partial, gaps AS months_not_covered, nb AS months_binding,
       CAST(f AS VARCHAR) AS first_binding, CAST(l AS VARCHAR) AS last_binding, hours AS hours_binding,
       CASE WHEN nb > 0 AND n_mx = nb THEN mx END AS shadow_price_max,
       CASE WHEN nb > 0 AND n_mn = nb THEN ROUND(mn, 6) END AS shadow_price_mean,
       CASE WHEN nb > 0 AND n_cost = nb THEN cost END AS congestion_cost_usd,
       CASE WHEN seen.constraint_id IS NULL THEN 'no' ELSE 'yes' END AS seen_in_source,
       CASE WHEN seen.constraint_id IS NULL THEN 'low' WHEN mp > 0 OR gaps <> '' THEN 'medium' ELSE 'high' END AS confidence,
       concat_ws(';', CASE WHEN mp > 0 THEN 'partial_coverage' END, CASE WHEN gaps <> '' THEN 'months_not_covered' END,
                 CASE WHEN seen.constraint_id IS NULL THEN 'not_seen_in_source' END) AS flags,
       concat_ws('; ', CASE WHEN hours IS NULL THEN 'hours_binding: no covered months in window' END,
                 {_gap('mx', 'shadow_price_max')}, {_gap('mn', 'shadow_price_mean')}, {_gap('cost', 'congestion_cost_usd')}) AS missing,
       COALESCE(fac.t, '') AS reported_facilities,
       CASE WHEN facts IS NULL THEN '' ELSE 'drv:' || substr(sha256(CAST('panel.summary:' || strftime(ws, '%Y-%m') || ':' || strftime(we, '%Y-%m') || ':'
         || r.market || ':' || r.constraint_id || ':hours_binding' || facts AS BLOB)), 1, 16) END AS hours_lineage_id
FROM r LEFT JOIN seen ON r.constraint_id = seen.constraint_id LEFT JOIN el ON r.constraint_id = el.constraint_id
LEFT JOIN fac ON r.constraint_id = fac.constraint_id""")


def panel_coverage(spark, folder):
    return panel.coverage_rows(view(spark, folder, "v_coverage"))


PANEL_COVERAGE = duck(["v_coverage"], """, months AS (SELECT CAST(unnest(generate_series(CAST((SELECT MIN(period) FROM v_coverage) AS TIMESTAMP),
    CAST((SELECT MAX(period) FROM v_coverage) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS period)
SELECT m.market, strftime(p.period, '%Y-%m') AS period, CASE WHEN COALESCE(days_covered, 0) = 0 THEN 'none'
       WHEN days_covered = days_expected THEN 'full' ELSE 'partial' END AS coverage, COALESCE(days_covered, 0) AS days_covered,
       COALESCE(days_expected, 0) AS days_expected, COALESCE(raw_refs, '') AS raw_refs
FROM (SELECT DISTINCT market FROM v_coverage) m CROSS JOIN months p
LEFT JOIN v_coverage v ON v.market = m.market AND v.period = p.period""")


def panel_unresolved(spark, folder):
    return panel.unresolved(view(spark, folder, "v_footprint"))


STAMP = {"source": "orders", "source_version": "v1", "retrieved_at": "2026-01-02 00:00:00"}


def panel_facts(spark, folder):
    facts = panel.panel_facts(view(spark, folder, "v_history"), view(spark, folder, "v_coverage"), STAMP, STAMP)
    return facts.select("lineage_id", "value", "unit", "confidence", F.array_join("flags", ";").alias("flags"))


FACTS = duck(["v_history", "v_coverage"], """, c AS (
  SELECT *, strftime(period, '%Y-%m') AS ym, CASE WHEN days_covered = 0 THEN 'none' WHEN days_covered = days_expected THEN 'full' ELSE 'partial' END AS st
  FROM v_coverage), h AS (
  SELECT 'panel:' || h.market || ':' || strftime(h.period, '%Y-%m') || ':' || constraint_id AS base, h.*, COALESCE(c.st, '') AS st
  FROM v_history h LEFT JOIN c ON h.market = c.market AND h.period = c.period), v AS (
  SELECT base || ':hours_binding' AS id, hours_binding AS value, 'h' AS unit, st FROM h
  UNION ALL SELECT base || ':shadow_price_max', shadow_price_max, 'USD/MWh', st FROM h
  UNION ALL SELECT base || ':shadow_price_mean', shadow_price_mean, 'USD/MWh', st FROM h
  UNION ALL SELECT base || ':congestion_cost_usd', congestion_cost_usd, 'USD', st FROM h)
SELECT 'panel:coverage:' || market || ':' || ym AS lineage_id, CAST(days_covered AS DOUBLE) AS value, 'days' AS unit, 'high' AS confidence,
       CASE WHEN st = 'full' THEN '' ELSE 'coverage_' || st END AS flags FROM c
UNION ALL SELECT id, value, unit, CASE WHEN st = 'partial' THEN 'medium' ELSE 'high' END, CASE WHEN st = 'partial' THEN 'partial_coverage' ELSE '' END
FROM v WHERE value IS NOT NULL""")


# --- lineage -----------------------------------------------------------------------------

NODES = """, edges AS (SELECT 'N' || doc_id AS child, 'N' || (doc_id // 2) AS parent FROM v_cov WHERE doc_id % 2 = 1 AND doc_id > 1
  UNION ALL SELECT 'N' || doc_id, 'N' || (doc_id // 3) FROM v_cov WHERE doc_id % 2 = 1 AND doc_id > 2
  UNION ALL SELECT 'N' || doc_id, 'GONE' FROM v_cov WHERE doc_id % 97 = 0 AND doc_id % 2 = 1), nodes AS (
  SELECT 'N' || doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN 'ghost' ELSE source END AS source FROM v_cov),
reach AS (WITH RECURSIVE r(node, other) AS (SELECT id, id FROM nodes UNION SELECT r.node, e.parent FROM r JOIN edges e ON r.other = e.child)
  SELECT * FROM r), closure AS (
  SELECT DISTINCT node, COALESCE(n.source, '__unknown_node__:' || other) AS source FROM reach LEFT JOIN nodes n ON reach.other = n.id
  WHERE other NOT IN (SELECT child FROM edges))"""


def _graph(spark, folder):
    docs = view(spark, folder, "v_cov")
    odd = docs.where("doc_id % 2 = 1")

    def tag(c):
        return F.concat(F.lit("N"), c.cast("string"))

    child = tag(F.col("doc_id"))
    edges = (odd.where("doc_id > 1").select(child.alias("child"), tag(F.floor(F.col("doc_id") / 2)).alias("parent"))
             .unionByName(odd.where("doc_id > 2").select(child.alias("child"), tag(F.floor(F.col("doc_id") / 3)).alias("parent")))
             .unionByName(odd.where("doc_id % 97 = 0").select(child.alias("child"), F.lit("GONE").alias("parent"))))
    nodes = docs.select(child.alias("id"), F.when(F.pmod("doc_id", F.lit(7)) == 0, "ghost").otherwise(F.col("source")).alias("source"))
    return nodes, edges


def source_closure(spark, folder):
    return lineage.source_closure(*_graph(spark, folder))


def _registry(spark, folder):
    docs = view(spark, folder, "v_cov")
    return docs.groupBy("source").agg(F.lit(1).alias("_one")).select(
        "source", F.lit("v1").alias("source_version"), (F.col("source") < "n").alias("publishable"))


def blocked_values(spark, folder):
    nodes, edges = _graph(spark, folder)
    return lineage.blocked_values(lineage.source_closure(nodes, edges), _registry(spark, folder))


BLOCKED = duck(["v_cov"], NODES + """
SELECT DISTINCT node, source FROM closure WHERE NOT (source IN (SELECT source FROM v_cov) AND source < 'n')""")


def store_gate(spark, folder):
    """Everything that keeps a whole store from being shared, by kind."""
    nodes, edges = _graph(spark, folder)
    registry = _registry(spark, folder)
    parts = [
        lineage.blocked_sources(lineage.source_closure(nodes, edges), registry).select(F.lit("source").alias("kind"), F.col("source").alias("name")),
        lineage.hidden_stamps(nodes, edges, registry).select(F.lit("hidden").alias("kind"), F.col("source").alias("name")),
        lineage.dangling_inputs(nodes, edges).select(F.lit("dangling").alias("kind"), F.col("id").alias("name"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


STORE_GATE = duck(["v_cov"], NODES + """
SELECT 'source' AS kind, source AS name FROM (SELECT DISTINCT source FROM closure) WHERE NOT (source IN (SELECT source FROM v_cov) AND source < 'n')
UNION ALL SELECT DISTINCT 'hidden', source FROM nodes WHERE id IN (SELECT child FROM edges) AND source IN (SELECT source FROM v_cov) AND source >= 'n'
UNION ALL SELECT DISTINCT 'dangling', parent FROM edges WHERE parent NOT IN (SELECT id FROM nodes)""")


def lineage_leaves(spark, folder):
    return lineage.leaves(*_graph(spark, folder)).select("id", "source")


def _stamps(spark, folder):
    docs = view(spark, folder, "v_cov")
    base = docs.groupBy("lang", "source").agg(F.min("doc_id").alias("k"))
    role = F.when(F.pmod("k", F.lit(3)) == 0, "table").when(F.pmod("k", F.lit(3)) == 1, "contributor").otherwise("column")
    return base.select(
        F.when(F.pmod("k", F.lit(2)) == 0, "congestion").otherwise(F.concat(F.lit("t_"), "lang")).alias("table"), role.alias("role"),
        F.when(role == "column", "rent_musd").alias("column"), "source",
        F.when(F.pmod("k", F.lit(5)) == 0, "v2").otherwise("v1").alias("source_version"),
        F.lit("2026-01-02").cast("timestamp").alias("retrieved_at"), F.col("lang"))


STAMPS = """, stamps AS (SELECT CASE WHEN k % 2 = 0 THEN 'congestion' ELSE 't_' || lang END AS "table",
  CASE k % 3 WHEN 0 THEN 'table' WHEN 1 THEN 'contributor' ELSE 'column' END AS role, source, lang,
  CASE WHEN k % 5 = 0 THEN 'v2' ELSE 'v1' END AS source_version FROM (SELECT lang, source, MIN(doc_id) AS k FROM v_cov GROUP BY 1, 2))"""


def unregistered_stamps(spark, folder):
    return lineage.unregistered_stamps(_stamps(spark, folder), _registry(spark, folder).where("publishable"))


UNREGISTERED = duck(["v_cov"], STAMPS + """
SELECT s."table", s.source, s.source_version, CASE WHEN s.source < 'n' THEN 'v1' END AS pinned FROM stamps s
WHERE s.source >= 'n' OR s.source_version <> 'v1'""")


def undeclared_columns(spark, folder):
    return lineage.undeclared_column_sources(_stamps(spark, folder))


UNDECLARED = duck(["v_cov"], STAMPS + """
SELECT s."table", 'rent_musd' AS "column", 'source is not a stamp of the table' AS why FROM stamps s WHERE role = 'column' AND NOT EXISTS (
  SELECT 1 FROM stamps t WHERE t.role <> 'column' AND t."table" = s."table" AND t.source = s.source AND t.source_version = s.source_version)
UNION ALL SELECT "table", 'rent_musd', 'column takes no stamp of its own' FROM stamps WHERE role = 'column' AND "table" <> 'congestion'""")


def attribution(spark, folder):
    cover = view(spark, folder, "v_cov").groupBy(F.concat(F.lit("t_"), "lang").alias("table")).agg(
        F.when(F.count("quality") > F.count(F.lit(1)) * 0.39, "observed").otherwise("unobserved").alias("coverage"))
    stamps = _stamps(spark, folder).withColumn("table", F.concat(F.lit("t_"), "lang"))
    return lineage.attribution(stamps, cover)


ATTRIBUTION = duck(["v_cov"], STAMPS + """, cover AS (
  SELECT 't_' || lang AS t, CASE WHEN COUNT(quality) > COUNT(*) * 0.39 THEN 'observed' ELSE 'unobserved' END AS coverage FROM v_cov GROUP BY 1)
SELECT CASE WHEN COUNT(*) FILTER (WHERE coverage <> 'unobserved') > 0 THEN 'used' ELSE 'nothing_obtained' END AS status, source, source_version,
  CASE WHEN COUNT(*) FILTER (WHERE coverage <> 'unobserved') > 0
       THEN string_agg(DISTINCT CASE WHEN coverage <> 'unobserved' THEN t END, ';' ORDER BY CASE WHEN coverage <> 'unobserved' THEN t END)
       ELSE string_agg(DISTINCT t, ';' ORDER BY t) END AS tables
FROM (SELECT DISTINCT source, source_version, 't_' || lang AS t FROM stamps) JOIN cover USING (t) GROUP BY source, source_version""")


def cell_facts(spark, folder):
    rows = view(spark, folder, "v_flowgates").select(
        "constraint_id", F.col("hours_binding").cast("string"), F.col("rent_musd").cast("string"), "contingency_facility")
    stamps = spark.createDataFrame(
        [("congestion", "table", None, "hourly", "v1"), ("congestion", "column", "rent_musd", "dollars", "v1")],
        "table string, role string, column string, source string, source_version string").withColumn(
        "retrieved_at", F.lit("2026-01-02").cast("timestamp"))
    facts = lineage.cell_facts(rows, "congestion", "constraint_id", ["hours_binding", "rent_musd", "contingency_facility"], stamps)
    return facts.select("lineage_id", "value_num", "source", "source_version")


CELL_FACTS = duck(["v_flowgates"], """
SELECT 'obs:congestion:' || constraint_id || ':hours_binding' AS lineage_id, hours_binding AS value_num, 'hourly' AS source, 'v1' AS source_version FROM v_flowgates
UNION ALL SELECT 'obs:congestion:' || constraint_id || ':rent_musd', rent_musd, 'dollars', 'v1' FROM v_flowgates WHERE rent_musd IS NOT NULL
UNION ALL SELECT 'obs:congestion:' || constraint_id || ':contingency_facility', NULL, 'hourly', 'v1' FROM v_flowgates""")


def derived_values(spark, folder):
    rows = view(spark, folder, "v_flowgates").select(
        "constraint_id", F.array(F.concat(F.lit("obs:"), "constraint_id"), F.lit("table:congestion"), F.lit(""),
                                 F.lit("table:congestion")).alias("given"))
    made = lineage.derived_values(rows, F.concat(F.lit("rent:"), "constraint_id"), "given", "reconstruct")
    return made.select("constraint_id", "lineage_id", F.size("inputs").cast("bigint").alias("n_inputs"), "source")


DERIVED = duck(["v_flowgates"], """
SELECT constraint_id, 'drv:' || substr(sha256(CAST('rent:' || constraint_id || chr(0) || 'obs:' || constraint_id || chr(0) || 'table:congestion' AS BLOB)), 1, 16) AS lineage_id,
       CAST(2 AS BIGINT) AS n_inputs, 'reconstruct' AS source FROM v_flowgates""")


def json_values(spark, folder):
    v = view(spark, folder, "v_props")
    digest = numeric.canonical_digest(F.struct(F.col("event_type").alias("event"), "k"))
    return v.select("event_id", "k", digest.alias("digest"))


JSON_VALUES = duck(["v_props"], """
SELECT event_id, k, sha256(CAST('{{"event":"' || event_type || '","k":' || k || '}}' AS BLOB)) AS digest FROM v_props""")


def number_functions(spark, folder):
    v = view(spark, folder, "v_history")
    x = F.col("shadow_price_mean")
    return v.select(
        "constraint_id", "market", numeric.month_text(F.col("period")).alias("period"),
        F.round(numeric.significant(x, 4), 6).alias("sig4"), F.round(numeric.significant(x / 1e9, 3), 9).alias("sig3"),
        numeric.top_count(F.col("hours_binding"), 0.05).cast("bigint").alias("k"),
        numeric.forward_share("months_binding_share", F.col("hours_binding")).alias("share"),
        F.round(numeric.interpolate(F.col("hours_binding") / 30, [(0.0, 0.0), (0.25, 0.2), (0.5, 0.8), (1.0, 4.0)]), 9).alias("ratio"),
        text.number_text(F.col("hours_binding")).alias("shown"), text.sheet_safe(F.concat(F.lit("="), "market")).alias("safe"),
        F.size(numeric.months_between(F.trunc("period", "year"), F.col("period"))).cast("bigint").alias("month_no"))


NUMBERS = duck(["v_history"], """
SELECT constraint_id, market, strftime(period, '%Y-%m') AS period,
       ROUND(round_even(shadow_price_mean / p4, 0) * p4, 6) AS sig4, ROUND(round_even(shadow_price_mean / p3, 0) * p3 / 1e9, 9) AS sig3,
       greatest(1, CAST(round_even(hours_binding * 0.05, 0) AS BIGINT)) AS k, least(hours_binding, 12) / 12 AS share,
       ROUND(CASE WHEN hours_binding >= 30 THEN 4.0 WHEN hours_binding >= 15 THEN 0.8 + (hours_binding / 30 - 0.5) * 6.4
                  WHEN hours_binding >= 7.5 THEN 0.2 + (hours_binding / 30 - 0.25) * 2.4 ELSE hours_binding / 30 * 0.8 END, 9) AS ratio,
       CAST(CAST(hours_binding AS BIGINT) AS VARCHAR) AS shown, '''=' || market AS safe, CAST(EXTRACT(MONTH FROM period) AS BIGINT) AS month_no
FROM (SELECT *, pow(10.0, FLOOR(log10(shadow_price_mean)) - 3) AS p4, pow(10.0, FLOOR(log10(shadow_price_mean)) - 2) AS p3 FROM v_history)""")


MONTHLY_REFS = "raw_refs || CASE WHEN raw_refs = '' THEN '' ELSE ';' END || 'raw:M' || CAST(EXTRACT(MONTH FROM period) AS {text})"


def _declared(spark, folder):
    """Raw inputs by month: coverage lacks each fourth, history has those that leave 0 or 1."""
    months = view(spark, folder, "v_coverage").select(F.month("period").alias("m"), F.concat(F.lit("raw:"), "market").alias("k")).distinct()
    month = F.concat(F.lit("raw:M"), F.col("m").cast("string"))
    return months.where("m % 4 <> 0").select(F.lit("constraint_coverage").alias("table"), month.alias("key")).unionByName(
        months.select(F.lit("constraint_coverage").alias("table"), F.col("k").alias("key"))).unionByName(
        months.where("m % 4 < 2").select(F.lit("constraint_history").alias("table"), month.alias("key"))).distinct()


DECLARED = """, declared AS (
  SELECT 'constraint_coverage' AS tab, 'raw:M' || EXTRACT(MONTH FROM period) AS key FROM v_coverage WHERE EXTRACT(MONTH FROM period) % 4 <> 0
  UNION SELECT 'constraint_coverage', 'raw:' || market FROM v_coverage
  UNION SELECT 'constraint_history', 'raw:M' || EXTRACT(MONTH FROM period) FROM v_coverage WHERE EXTRACT(MONTH FROM period) % 4 < 2)"""


def citation_faults(spark, folder):
    """Citations nothing declares: of coverage rows, and of the history as a whole."""
    coverage = view(spark, folder, "v_coverage").withColumn("raw_refs", F.expr(MONTHLY_REFS.format(text="STRING")))
    declared = _declared(spark, folder)
    faults = validation.uncited_refs(coverage, declared).select("market", numeric.month_text(F.col("period")).alias("period"), "ref")
    return faults.unionByName(validation.uncovered_inputs(declared).select(
        F.lit(None).cast("string").alias("market"), F.lit(None).cast("string").alias("period"), F.col("key").alias("ref")))


CITATION_FAULTS = duck(["v_coverage"], DECLARED + f"""
SELECT market, strftime(period, '%Y-%m') AS period, ref FROM (SELECT market, period, unnest(string_split({MONTHLY_REFS.format(text="VARCHAR")}, ';')) AS ref
  FROM v_coverage) WHERE ref NOT IN (SELECT key FROM declared WHERE tab = 'constraint_coverage')
UNION ALL SELECT NULL, NULL, key FROM declared WHERE tab = 'constraint_history' AND key NOT IN (SELECT key FROM declared WHERE tab = 'constraint_coverage')""")


def citations(spark, folder):
    """Stamps and raw inputs a brief cites: one input table per document source."""
    docs = view(spark, folder, "v_cov")
    sources = docs.groupBy("source").agg(F.min("doc_id").alias("n"))
    digest = F.sha2(F.col("source").cast("binary"), 256)
    stamps = sources.select(F.concat(F.lit("t_"), "source").alias("table"), "source", F.lit("v1").alias("source_version"),
                            F.concat(F.lit("2026-01-"), F.lpad((F.col("n") % 28 + 1).cast("string"), 2, "0")).alias("retrieved_at"),
                            digest.alias("sha256"))
    declared = docs.select(F.concat(F.lit("t_"), "source").alias("table"), F.concat(F.lit("raw:"), "lang").alias("key"))
    raw = docs.select("lang").distinct().unionByName(docs.limit(0).select("lang")).select(
        F.concat(F.lit("raw:"), "lang").alias("key"), F.concat(F.lit("x:"), "lang").alias("url"), F.lit("2026-01-02").alias("retrieved_at"),
        F.sha2(F.col("lang").cast("binary"), 256).alias("sha256"))
    registry = sources.where("source <> 'src3'").select("source", (F.col("source") < "src5").alias("publishable"), F.lit("terms").alias("basis"))
    return panel.source_citations(stamps, declared, raw, registry)


CITATIONS = duck(["v_cov"], """, s AS (SELECT source, MIN(doc_id) AS n FROM v_cov GROUP BY 1)
SELECT 'table' AS kind, 't_' || s.source AS name, d.derived_from, s.source, 'v1' AS source_version, NULL AS url,
       '2026-01-' || lpad(CAST(n % 28 + 1 AS VARCHAR), 2, '0') AS retrieved_at, sha256(s.source) AS sha256,
       s.source <> 'src3' AND s.source < 'src5' AS publishable, CASE WHEN s.source = 'src3' THEN 'unregistered source' ELSE 'terms' END AS basis
FROM s LEFT JOIN (SELECT DISTINCT source, 'raw:' || lang AS derived_from FROM v_cov) d ON d.source = s.source
UNION ALL SELECT DISTINCT 'raw', 'raw:' || lang, NULL, NULL, NULL, 'x:' || lang, '2026-01-02', sha256(lang), NULL, NULL FROM v_cov""")


def table_digest(spark, folder):
    return report.table_digest(view(spark, folder, "v_history").drop("period"))


QUERIES = {
    "citation_faults": (citation_faults, CITATION_FAULTS),
    "source_citations": (citations, CITATIONS),
    "panel_monthly": (panel_monthly, MONTHLY),
    "panel_summary": (panel_summary, SUMMARY),
    "panel_coverage": (panel_coverage, PANEL_COVERAGE),
    "panel_unresolved": (panel_unresolved, duck(["v_footprint"], """
SELECT element_id, element_kind, constraint_id, corridor_id, match_status, evidence, evidence_refs FROM v_footprint
WHERE match_status <> 'verified'""")),
    "panel_facts": (panel_facts, FACTS),
    "source_closure": (source_closure, duck(["v_cov"], NODES + " SELECT node, source FROM closure")),
    "blocked_values": (blocked_values, BLOCKED),
    "store_gate": (store_gate, STORE_GATE),
    "lineage_leaves": (lineage_leaves, duck(["v_cov"], NODES + " SELECT id, source FROM nodes WHERE id NOT IN (SELECT child FROM edges)")),
    "unregistered_stamps": (unregistered_stamps, UNREGISTERED),
    "undeclared_columns": (undeclared_columns, UNDECLARED),
    "attribution": (attribution, ATTRIBUTION),
    "cell_facts": (cell_facts, CELL_FACTS),
    "derived_values": (derived_values, DERIVED),
    "json_values": (json_values, JSON_VALUES),
    "number_functions": (number_functions, NUMBERS),
    "table_digest": (table_digest, None),
}
