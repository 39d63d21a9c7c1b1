"""Input views over the driver's tables, written once in SQL both engines read.

Every view reads a whole table, so the work of each query grows with the data. Only the
inputs are shared; each query's operator and its comparison SQL are written separately.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "labels")


class Dialect:
    """The few spellings that differ between the two engines."""

    def __init__(self, spark: bool):
        self.spark = spark

    def plus_hours(self, ts: str, n: str) -> str:
        return f"({ts} + make_interval(0, 0, 0, 0, {n}, 0, 0))" if self.spark else f"({ts} + to_hours({n}))"

    def item(self, array: str, i: int) -> str:
        return f"element_at({array}, {i})" if self.spark else f"{array}[{i}]"

    def month(self, ts: str) -> str:
        return f"CAST(date_trunc('month', {ts}) AS DATE)"

    def json_text(self, column: str, key: str) -> str:
        return (f"get_json_object({column}, '$.{key}')" if self.spark
                else f"json_extract_string({column}, '$.{key}')")


SPARK, DUCK = Dialect(True), Dialect(False)


def _whole(x: str) -> str:
    return f"CAST(FLOOR({x}) AS BIGINT)"


def definitions(d: Dialect) -> dict[str, tuple[tuple[str, ...], str]]:
    """name -> (views it needs, SQL)."""
    utc = d.plus_hours("l_shipdate", "l_linenumber")
    brand = "UPPER(REPLACE(p_brand, '#', ''))"
    hours = f"""'C' || CAST(l_partkey AS STRING)
                     || CASE WHEN l_partkey % 37 = 0 THEN 'PHSHFT' ELSE '' END AS name,
                   CASE WHEN l_suppkey % 5 = 0 THEN 'BASE'
                        ELSE 'K' || CAST(l_suppkey % 3 AS STRING) END AS contingency,
                   CASE WHEN l_linenumber = 7 THEN 'LN ZETA - ' || {brand}
                        WHEN p_size % 6 = 0 THEN 'XFMR ' || {brand} || ' - ' || {brand}
                        WHEN p_size % 6 = 1 THEN 'Multi-Element Constraint'
                        WHEN p_size % 6 = 2 THEN ''
                        WHEN p_size % 17 = 3 THEN 'ZONE ' || {brand}
                        WHEN l_linenumber % 2 = 0 THEN 'LN ' || p_type || ' - ' || {brand}
                        ELSE 'LN ' || {brand} || ' - ' || p_type END AS monitored,
                   CASE WHEN l_suppkey % 5 = 0 THEN 'BASE'
                        WHEN l_quantity > 45 THEN 'LN OTHER WORDING'
                        ELSE p_type || ':' || {brand} || ' ' || p_type || ':' || CAST(69 + 46 * (l_suppkey % 3) AS STRING)
                        END AS contingent,
                   CASE WHEN l_returnflag = 'R' THEN 'MANUAL' ELSE 'FLOWGATE' END AS kind,
                   CASE WHEN l_linestatus = 'F' AND l_tax > 0.05 THEN 'BREACHED' ELSE 'BINDING' END AS state,
                   CASE WHEN l_returnflag = 'A' THEN -l_extendedprice ELSE l_extendedprice END AS price,
                   {utc} AS utc, {d.month(d.plus_hours(utc, '-1'))} AS month,
                   ((l_orderkey * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT)) * 1000
                     + CAST(ROUND(l_tax * 100) AS BIGINT) * 10 + l_linenumber AS ord
            FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey"""
    return {
        # hourly binding rows: a part is a constraint, its supplier decides the contingency
        "v_hours": ((), f"""
            SELECT {hours}"""),
        # monthly dollars, posted negative; some months positive, a third of the months repeated
        "v_dollars_once": (("v_hours",), """
            SELECT month, name, contingency, MIN(monitored) AS monitored,
                   CAST(SUM(CAST(price AS DECIMAL(20, 4))) AS DOUBLE) * -1 AS amount, MIN(ord) AS ord
            FROM v_hours GROUP BY month, name, contingency"""),
        "v_part_dollars_once": (("v_part_hours",), """
            SELECT month, name, contingency, monitored, CAST(total AS DOUBLE) * -1 AS amount, ord
            FROM (SELECT part, month, contingency, MIN(name) AS name, MIN(monitored) AS monitored,
                         SUM(CAST(price AS DECIMAL(20, 4))) AS total, MIN(ord) AS ord
                  FROM v_part_hours GROUP BY part, month, contingency)"""),
        "v_dollars": (("v_dollars_once",), """
            SELECT month, name, contingency,
                   CASE WHEN ord % 11 = 0 THEN 'LN RECYCLED - ID' ELSE monitored END AS monitored, amount, ord
            FROM v_dollars_once
            UNION ALL
            SELECT month, name, contingency, monitored, amount, ord + 1 FROM v_dollars_once
            WHERE EXTRACT(MONTH FROM month) % 3 = 0"""),
        "v_each_dollars": (("v_dollars_once",), """
            SELECT month, name, contingency,
                   CASE WHEN again = 0 AND ord % 11 = 0 THEN 'LN RECYCLED - ID' ELSE monitored END AS monitored, amount, ord + again AS ord
            FROM v_dollars_once
            LATERAL VIEW EXPLODE(CASE WHEN EXTRACT(MONTH FROM month) % 3 = 0 THEN ARRAY(0, 1) ELSE ARRAY(0) END) t AS again"""),
        "v_settled": ((), f"""
            SELECT {d.month('o_orderdate')} AS month, o_totalprice * 0.2 AS collected FROM {{orders}}"""),
        # monthly rent of one flowgate and calendar month, for the backtest
        "v_monthly": (("v_dollars_once",), """
            SELECT name || '|' || contingency AS constraint_id, CAST(EXTRACT(MONTH FROM month) AS INT) AS month,
                   CAST(SUM(CAST(CASE WHEN amount < 0 THEN -amount ELSE 0 END AS DECIMAL(20, 4))) AS DOUBLE) AS usd
            FROM v_dollars_once GROUP BY 1, 2"""),
        # three providers' readings of a line voltage
        "v_first": ((), """
            SELECT 'L' || CAST(p_partkey AS STRING) AS line_id,
                   CASE WHEN p_size % 9 = 0 THEN '350' WHEN p_size % 4 = 0 THEN '345'
                        WHEN p_size % 4 = 1 THEN '230' WHEN p_size % 4 = 2 THEN '500' ELSE '138' END AS voltage_kv,
                   p_partkey AS ord FROM {part}"""),
        "v_second": ((), """
            SELECT CASE WHEN p_partkey % 13 = 0 THEN '' ELSE 'L' || CAST(p_partkey AS STRING) END AS line_id,
                   CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size % 4 = 0 THEN '345'
                        WHEN p_size % 4 = 1 THEN '230' WHEN p_size % 4 = 2 THEN '500' ELSE '161' END AS voltage_kv,
                   p_partkey AS ord FROM {part} WHERE p_partkey % 3 <> 0
            UNION ALL
            SELECT 'L' || CAST(p_partkey AS STRING), '115', 1000000000 + p_partkey FROM {part}
            WHERE p_partkey % 15 = 1"""),
        "v_third": ((), """
            SELECT 'L' || CAST(p_partkey AS STRING) AS line_id,
                   CASE WHEN p_size % 5 = 0 THEN '350' WHEN p_size % 4 = 0 THEN '345'
                        WHEN p_size % 4 = 1 THEN '230' WHEN p_size % 4 = 2 THEN '500' ELSE '138' END AS voltage_kv,
                   CASE WHEN p_size % 10 = 6 THEN ' 4/0' WHEN p_size % 10 = 7 THEN NULL
                        ELSE 'ACSR ' || p_type END AS conductor,
                   CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size * 20 AS DOUBLE) END AS thermal_limit_mw,
                   p_retailprice AS cost_usd, p_partkey AS ord
            FROM {part} WHERE p_partkey % 4 <> 0"""),
        # a forest of lines: every part points at a smaller one, each fifth starts a new tree
        "v_lines": ((), f"""
            SELECT 'L' || CAST(p_partkey AS STRING) AS line_id, p_partkey AS from_bus,
                   CASE WHEN p_partkey % 5 = 0 THEN p_partkey ELSE {_whole('p_partkey / 2.0')} END AS to_bus,
                   CASE WHEN p_size % 4 = 0 THEN 345.0E0 WHEN p_size % 4 = 1 THEN 230.0E0
                        WHEN p_size % 4 = 2 THEN 500.0E0 ELSE 138.0E0 END AS kv,
                   CAST(p_size AS DOUBLE) AS length_mi, p_brand AS owner,
                   CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size * 20 AS DOUBLE) END AS thermal_limit_mw
            FROM {{part}}"""),
        "v_nodes": ((), "SELECT p_partkey AS node, p_partkey AS ord FROM {part}"),
        # a ring with chords over suppliers: one connected network with parallel paths
        "v_ring": ((), """
            SELECT 'R' || CAST(s_suppkey AS STRING) AS line_id, CAST(s_suppkey AS STRING) AS from_bus,
                   CAST((s_suppkey + 1) % (SELECT COUNT(*) FROM {supplier}) AS STRING) AS to_bus,
                   CAST(10 + s_nationkey AS DOUBLE) AS length_mi, 345.0E0 AS kv, 500.0E0 + s_suppkey AS thermal_limit_mw
            FROM {supplier}
            UNION ALL
            SELECT 'X' || CAST(s_suppkey AS STRING), CAST(s_suppkey AS STRING),
                   CAST((s_suppkey + 7) % (SELECT COUNT(*) FROM {supplier}) AS STRING), CAST(20 + s_nationkey AS DOUBLE), 230.0E0, 300.0E0 + s_suppkey
            FROM {supplier} WHERE s_suppkey % 5 = 0"""),
        # sensitivities of ring lines at the buses near them; every ninth supplier's lines have none
        "v_ptdf": (("v_ring",), """
            SELECT line_id, CAST((f + o) % (SELECT COUNT(*) FROM {supplier}) AS STRING) AS bus_id,
                   CASE WHEN o = 0 AND line_id LIKE 'X%' AND f % 10 = 0 THEN 1.0E0
                        ELSE CAST((f * 7 + o * 13) % 21 - 10 AS DOUBLE) / 27.0E0 END AS ptdf
            FROM (SELECT line_id, CAST(from_bus AS BIGINT) AS f FROM v_ring) CROSS JOIN (VALUES (0), (1), (2), (3)) AS near(o)
            WHERE f % 9 <> 4"""),
        "v_buses": ((), """
            SELECT CAST(s_suppkey AS STRING) AS bus_id, CASE WHEN s_suppkey % 4 = 0 THEN 'gen' ELSE 'load' END AS role,
                   1.0E0 + s_nationkey AS weight, 30.0E0 + s_nationkey AS lat, -100.0E0 + s_suppkey % 11 AS lon,
                   CASE WHEN s_suppkey % 4 = 0 THEN 1.0E0 + s_nationkey ELSE 0.0E0 END AS gen_mw
            FROM {supplier}"""),
        "v_load": ((), """
            SELECT event_type AS snapshot, CAST(user_id % 3 AS STRING) AS ba, ABS(value) AS load_mw FROM {events}"""),
        # places on a map
        "v_points": ((), f"""
            SELECT vec_id AS id, ROUND(38 + 4 * CAST({d.item('embedding', 1)} AS DOUBLE), 3) AS lat,
                   ROUND(-98 + 4 * CAST({d.item('embedding', 2)} AS DOUBLE), 3) AS lon, label FROM {{embeddings}}"""),
        "v_targets": ((), f"""
            SELECT vec_id AS idx, ROUND(38 + 5 * CAST({d.item('embedding', 3)} AS DOUBLE), 2) AS lat,
                   ROUND(-98 + 5 * CAST({d.item('embedding', 4)} AS DOUBLE), 2) AS lon FROM {{embeddings}}"""),
        # published authority hours as text columns
        "v_ba_hours": ((), """
            SELECT event_type AS ba, date_trunc('hour', ts) AS utc, COUNT(*) AS n,
                   SUM(CAST(value AS DECIMAL(18, 2))) AS total, MAX(CAST(value AS DECIMAL(18, 2))) AS top
            FROM {events} GROUP BY 1, 2"""),
        "v_ba_text": (("v_ba_hours",), """
            SELECT ba, utc, CASE WHEN n % 3 = 0 THEN '' WHEN n % 7 = 0 THEN 'n/a'
                                 ELSE '1,' || CAST(CAST(total AS STRING) AS STRING) END AS adjusted,
                   CASE WHEN n % 5 = 0 THEN NULL ELSE CAST(total AS STRING) END AS raw,
                   CAST(total + 100 AS STRING) AS netgen,
                   CASE WHEN n % 4 = 0 THEN '' ELSE CAST(top AS STRING) END AS wind_a,
                   CASE WHEN n % 4 = 1 THEN '' ELSE CAST(n AS STRING) END AS wind_b
            FROM v_ba_hours"""),
        # coverage: a labelled document is covered, an unlabelled one unobserved
        "v_cov": ((), """
            SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
            FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id"""),
        # names with facility words, voltages, designators and placeholders
        "v_names": ((), """
            SELECT p_partkey AS id,
                   CASE p_partkey % 8
                     WHEN 0 THEN UPPER(p_name) || ' SUBSTATION 345KV'
                     WHEN 1 THEN 'TL90-902 ' || p_name || ' (WERE)'
                     WHEN 2 THEN p_name || ' Sub. 115 kV LINE 2'
                     WHEN 3 THEN '31-' || UPPER(p_name) || ' SW STA'
                     WHEN 4 THEN 'TAP' || CAST(p_partkey AS STRING)
                     WHEN 5 THEN 'NW ' || p_name || ' CO 345'
                     WHEN 6 THEN p_name || ' JCT CKT #3 (unfinished'
                     ELSE ' ' || p_name || ' 69KV switching station ' END AS text
            FROM {part}"""),
        # line filings and mapped lines
        "v_filings": ((), """
            SELECT p_partkey AS record_id, CAST(p_size % 12 AS INT) AS utility_id, 'Utility ' || p_type AS utility_name,
                   2020 + CAST(p_partkey % 3 AS INT) AS report_year,
                   CASE WHEN p_size % 13 = 0 THEN NULL WHEN p_size % 6 = 0 THEN 345000.0E0
                        WHEN p_size % 6 = 1 THEN 345.0E0 WHEN p_size % 6 = 2 THEN 1234.0E0
                        WHEN p_size % 6 = 3 THEN 230.0E0 ELSE 69.0E0 END AS kv,
                   CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN -1.0E0
                        ELSE CAST(p_size AS DOUBLE) END AS standalone_mi,
                   CASE WHEN p_partkey % 5 < 2 THEN NULL ELSE CAST(p_size AS DOUBLE) / 2 END AS aggregated_mi,
                   CASE WHEN p_partkey % 23 = 0 THEN 'TOTAL 345 KV LINES' WHEN p_partkey % 17 = 0 THEN ' '
                        ELSE p_name || ' SUBSTATION' END AS start_point,
                   CASE WHEN p_partkey % 29 = 0 THEN p_name || ' SUBSTATION' ELSE p_type || ' STA' END AS end_point,
                   CASE WHEN p_partkey % 3 = 0 THEN 0.0E0 ELSE p_retailprice END AS capex
            FROM {part}"""),
        "v_mapped": ((), """
            SELECT 'H' || CAST(p_partkey AS STRING) AS line_id,
                   CASE WHEN p_size % 6 = 0 THEN 345.0E0 WHEN p_size % 6 = 1 THEN 345.0E0
                        WHEN p_size % 6 = 3 THEN 230.0E0 ELSE 69.0E0 END AS voltage_kv,
                   CASE WHEN p_partkey % 9 = 0 THEN 'TAP' || CAST(p_partkey AS STRING) ELSE p_type END AS sub_1,
                   CASE WHEN p_size % 2 = 0 THEN UPPER(p_name) ELSE UPPER(p_name) || ' ' || CAST(p_size AS STRING) END AS sub_2
            FROM {part}"""),
        # queue requests and named buses
        "v_poi": ((), """
            SELECT 'Q' || CAST(o_orderkey AS STRING) AS request_id,
                   CASE WHEN o_custkey % 4 = 0 THEN 'Unit n' || CAST(o_custkey AS STRING) || ' Substation (new) 345 kV'
                        WHEN o_custkey % 4 = 1 THEN 'Unit N' || CAST(o_custkey AS STRING) || '-345KV'
                        ELSE 'Tap on ' || CAST(o_custkey AS STRING) END AS poi,
                   o_totalprice / 1000 AS mw,
                   CASE WHEN o_orderstatus = 'F' THEN 'IA FULLY EXECUTED/COMMERCIAL OPERATION'
                        WHEN o_orderstatus = 'P' THEN 'DISIS STAGE' ELSE 'IA PENDING' END AS status,
                   CASE WHEN o_orderkey % 50 = 0 THEN '1/1/2020' ELSE '' END AS withdrawn
            FROM {orders}"""),
        "v_poi_buses": ((), """
            SELECT 'B' || CAST(c_custkey AS STRING) AS bus_id,
                   'UNIT N' || CAST(CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END AS STRING) AS name
            FROM {customer}"""),
        # footprint, history and coverage of a monthly panel
        "v_footprint": ((), """
            SELECT 'SITE_' || CAST(c_custkey AS STRING) AS element_id,
                   CASE WHEN c_custkey % 4 = 0 THEN 'corridor' ELSE 'site' END AS element_kind,
                   CASE WHEN c_custkey % 5 = 4 THEN '' ELSE 'P' || CAST(c_custkey % 997 AS STRING) END AS constraint_id,
                   CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'COR_' || CAST((c_custkey % 997) % 40 AS STRING) END AS corridor_id,
                   CASE WHEN c_custkey % 5 = 4 THEN 'unmatched' WHEN c_custkey % 5 = 3 THEN 'uncertain' ELSE 'verified' END AS match_status,
                   'seen in ' || c_mktsegment AS evidence, 'note-' || CAST(c_custkey AS STRING) AS evidence_refs,
                   CASE WHEN c_custkey % 5 > 2 THEN '' ELSE 'reviewer' END AS reviewed_by,
                   CASE WHEN c_custkey % 5 > 2 THEN '' ELSE '2025-03-04' END AS reviewed_on
            FROM {customer}"""),
        "v_history": ((), f"""
            SELECT 'P' || CAST(o_custkey % 997 AS STRING) AS constraint_id,
                   CASE WHEN o_orderkey % 2 = 0 THEN 'DA' ELSE 'RT' END AS market, {d.month('o_orderdate')} AS period,
                   CAST(COUNT(*) * 3 AS DOUBLE) AS hours_binding,
                   CASE WHEN COUNT(*) % 4 = 3 THEN NULL ELSE MAX(o_totalprice) END AS shadow_price_max,
                   CASE WHEN MIN(o_orderkey) % 11 = 0 THEN NULL ELSE MIN(o_totalprice) END AS shadow_price_mean,
                   CASE WHEN o_orderkey % 2 = 1 THEN NULL
                        ELSE CAST(SUM(CAST(o_totalprice AS DECIMAL(20, 2))) AS DOUBLE) END AS congestion_cost_usd,
                   MIN(o_orderpriority) AS monitored_facility, MIN(o_orderstatus) AS contingent_facility,
                   MIN(o_orderkey) AS ord
            FROM {{orders}} GROUP BY o_custkey % 997, o_orderkey % 2, {d.month('o_orderdate')}"""),
        "v_coverage": ((), f"""
            SELECT market, period, days_expected,
                   CASE WHEN n % 9 = 0 THEN 0 WHEN n % 5 = 0 THEN 20 ELSE days_expected END AS days_covered,
                   CASE WHEN n % 9 = 0 THEN '' ELSE 'raw:' || market END AS raw_refs
            FROM (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'DA' ELSE 'RT' END AS market, {d.month('o_orderdate')} AS period,
                         CAST(EXTRACT(DAY FROM last_day(MIN(o_orderdate))) AS INT) AS days_expected, COUNT(*) AS n
                  FROM {{orders}} GROUP BY o_orderkey % 2, {d.month('o_orderdate')}) t"""),
        # flowgates with ranges, for signals, draws and decisions
        "v_flowgates": (("v_hours",), """
            SELECT name || '|' || contingency AS constraint_id, name, contingency,
                   CASE WHEN MIN(monitored) LIKE 'LN %' THEN 'thermal' WHEN MIN(monitored) LIKE 'XFMR%' THEN 'transformer'
                        WHEN MIN(monitored) LIKE 'ZONE%' THEN 'loopflow' ELSE 'interface' END AS ctype,
                   MIN(monitored) AS monitored_facility, MIN(contingent) AS contingency_facility,
                   CAST(COUNT(DISTINCT utc) AS DOUBLE) AS hours_binding,
                   CAST(SUM(CASE WHEN state = 'BREACHED' THEN 1 ELSE 0 END) AS DOUBLE) AS breached_hours,
                   CAST(COUNT(DISTINCT EXTRACT(MONTH FROM month)) AS INT) AS months_binding,
                   CASE WHEN MIN(ord) % 10 = 0 THEN NULL
                        ELSE CAST(FLOOR(SUM(CAST(ABS(price) AS DECIMAL(20, 4)))) AS DOUBLE) / 100000 END AS rent_musd,
                   CASE WHEN MIN(ord) % 10 < 2 THEN NULL
                        ELSE CAST(FLOOR(MAX(CAST(ABS(price) AS DECIMAL(20, 4)))) AS DOUBLE) / 100000 END AS max_month_cost_musd,
                   CASE WHEN MIN(ord) % 7 = 0 THEN TRUE WHEN MIN(ord) % 7 = 1 THEN NULL ELSE FALSE END AS radial,
                   MIN(ord) AS ord
            FROM v_hours GROUP BY name, contingency"""),
        # the same rows for Spark: a name belongs to one part, so rows are grouped where the join has put them, and each
        # hour of a flowgate is met once, so that neither distinct count expands rows
        "v_part_hours": ((), f"SELECT l_partkey AS part, {hours}"),
        "v_part_flowgates": (("v_part_hours",), """
            SELECT name || '|' || contingency AS constraint_id, name, contingency,
                   CASE WHEN monitored LIKE 'LN %' THEN 'thermal' WHEN monitored LIKE 'XFMR%' THEN 'transformer'
                        WHEN monitored LIKE 'ZONE%' THEN 'loopflow' ELSE 'interface' END AS ctype,
                   monitored AS monitored_facility, contingent AS contingency_facility, CAST(hours AS DOUBLE) AS hours_binding,
                   CAST(breached AS DOUBLE) AS breached_hours, CAST(BIT_COUNT(months) AS INT) AS months_binding,
                   CASE WHEN ord % 10 = 0 THEN NULL ELSE CAST(FLOOR(total) AS DOUBLE) / 100000 END AS rent_musd,
                   CASE WHEN ord % 10 < 2 THEN NULL ELSE CAST(FLOOR(top) AS DOUBLE) / 100000 END AS max_month_cost_musd,
                   CASE WHEN ord % 7 = 0 THEN TRUE WHEN ord % 7 = 1 THEN NULL ELSE FALSE END AS radial, ord
            FROM (SELECT part, contingency, MIN(name) AS name, MIN(monitored) AS monitored, MIN(contingent) AS contingent,
                         COUNT(utc) AS hours, SUM(breached) AS breached, BIT_OR(COALESCE(SHIFTLEFT(1, CAST(EXTRACT(MONTH FROM month) AS INT)), 0)) AS months,
                         SUM(total) AS total, MAX(top) AS top, MIN(ord) AS ord
                  FROM (SELECT part, contingency, utc, month, MIN(name) AS name, MIN(monitored) AS monitored, MIN(contingent) AS contingent,
                               SUM(CASE WHEN state = 'BREACHED' THEN 1 ELSE 0 END) AS breached,
                               SUM(CAST(ABS(price) AS DECIMAL(20, 4))) AS total, MAX(CAST(ABS(price) AS DECIMAL(20, 4))) AS top, MIN(ord) AS ord
                        FROM v_part_hours GROUP BY part, contingency, utc, month) GROUP BY part, contingency)"""),
        "v_props": ((), f"""
            SELECT event_id, event_type, CAST({d.json_text('props', 'k')} AS BIGINT) AS k, value FROM {{events}}"""),
    }


def _order(names, table) -> list[str]:
    out: list[str] = []

    def visit(n):
        for need in table[n][0]:
            visit(need)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


#: Views that Spark groups by part, where the join has put the rows: the same rows with fewer shuffles.
BY_PART = {"v_flowgates": "v_part_flowgates", "v_dollars_once": "v_part_dollars_once", "v_dollars": "v_each_dollars"}


def with_views(names, d: Dialect = DUCK, instead=()) -> str:
    """``WITH`` clause that defines the named views and what they need; ``instead`` names other definitions for some."""
    table = definitions(d)
    table |= {name: table[other] for name, other in dict(instead).items()}
    return "WITH " + ",\n".join(f"{n} AS ({table[n][1]})" for n in _order(names, table))


def duck(names, rest: str) -> str:
    """Comparison SQL: views, then ``rest`` (further CTEs after a comma, or a SELECT)."""
    text = with_views(names) + ("\n" if not rest.lstrip().startswith(",") else "") + rest
    return text.format(**{t: t for t in TABLES})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view as a DataFrame over the parquet tables of ``folder``."""
    text = with_views([name], SPARK, BY_PART) + f" SELECT * FROM {name}"
    used = {t: table(spark, folder, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)
