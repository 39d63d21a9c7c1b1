"""Graphs, places, line features and the DC network."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import duck, view
from fluxsieve import fixed
from fluxsieve.functions import geo
from fluxsieve.operators import filings, graph, network, spatial
from fluxsieve.operators.ranking import ordered_position
from fluxsieve.plans import assembly, corridors
from fluxsieve.sources.market import parse_geometry

HAVERSINE = """(2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2)
  + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2)))))"""


def hav(a: str, b: str) -> str:
    return HAVERSINE.replace("{a}", a).replace("{b}", b)


LINES = ["v_lines"]
DEGREE = """, ends AS (SELECT line_id, from_bus AS bus, to_bus AS far FROM v_lines
  UNION ALL SELECT line_id, to_bus, from_bus FROM v_lines), degree AS (SELECT bus, COUNT(*) AS degree FROM ends GROUP BY 1)"""


def bus_degree(spark, folder):
    return graph.bus_degree(view(spark, folder, "v_lines"))


def radial_lines(spark, folder):
    return graph.radial_lines(view(spark, folder, "v_lines")).select("line_id", "radial")


RADIAL = duck(LINES, DEGREE + """
SELECT l.line_id, a.degree <= 1 OR b.degree <= 1 AS radial FROM v_lines l JOIN degree a ON l.from_bus = a.bus
JOIN degree b ON l.to_bus = b.bus""")


def adjacency(spark, folder):
    return graph.adjacency(view(spark, folder, "v_lines"))


def without_loops(spark, folder):
    return graph.without_loops(view(spark, folder, "v_lines")).select("line_id", "from_bus", "to_bus")


def queue_near(spark, folder):
    queue = view(spark, folder, "v_poi").select(
        F.pmod(F.substring("request_id", 2, 20).cast("bigint"), F.lit(1000)).alias("near_bus"), "mw")
    return graph.queue_near(view(spark, folder, "v_lines"), queue)


QUEUE_NEAR = duck(["v_lines", "v_poi"], DEGREE + """, reach AS (
  SELECT line_id, bus FROM ends UNION SELECT e.line_id, n.far FROM ends e JOIN ends n ON e.bus = n.bus), q AS (
  SELECT CAST(substr(request_id, 2) AS BIGINT) % 1000 AS bus, SUM(CAST(mw AS DECIMAL(20, 6))) AS mw, COUNT(*) AS n FROM v_poi GROUP BY 1)
SELECT l.line_id, COALESCE(CAST(SUM(q.mw) AS DOUBLE), 0) AS mw, CAST(COALESCE(SUM(q.n), 0) AS BIGINT) AS requests
FROM v_lines l LEFT JOIN reach r ON l.line_id = r.line_id LEFT JOIN q ON r.bus = q.bus GROUP BY 1""")


def components(spark, folder):
    edges = view(spark, folder, "v_lines").select(F.col("from_bus").alias("a"), F.col("to_bus").alias("b"))
    return graph.components(edges, view(spark, folder, "v_nodes"))


COMPONENTS = duck(["v_lines", "v_nodes"], """, e AS (
  SELECT from_bus AS a, to_bus AS b FROM v_lines WHERE from_bus <> to_bus
  UNION SELECT to_bus, from_bus FROM v_lines WHERE from_bus <> to_bus), reach AS (
  WITH RECURSIVE r(node, other) AS (SELECT node, node FROM v_nodes UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a)
  SELECT * FROM r), label AS (SELECT node, MIN(other) AS label FROM reach GROUP BY 1), groups AS (
  SELECT label, COUNT(*) AS size, row_number() OVER (ORDER BY COUNT(*) DESC, MIN(node)) AS rank FROM label GROUP BY 1)
SELECT node, l.label, size, rank FROM label l JOIN groups g ON l.label = g.label""")


def name_buses(spark, folder):
    # six lines meet per bus in this view, and neighbours often carry the same word
    lines = view(spark, folder, "v_ring").join(
        view(spark, folder, "v_names").select(F.col("id").cast("string").alias("from_bus"), F.col("text").alias("x")),
        "from_bus").select(
        F.col("line_id").alias("line"), F.col("from_bus").cast("bigint").alias("a"),
        F.col("to_bus").cast("bigint").alias("b"), F.concat(F.lit("S"), F.floor(F.col("from_bus").cast("int") / 2)).alias("x"),
        F.concat(F.lit("S"), F.floor(F.col("to_bus").cast("int") / 2)).alias("y"))
    return graph.name_buses(lines)


# --- places ----------------------------------------------------------------------------

def nearest(spark, folder):
    found = spatial.nearest(view(spark, folder, "v_points").select(F.col("id").alias("src_id"), "lat", "lon"),
                            view(spark, folder, "v_targets"))
    return found.withColumn("metres", F.round("metres", 3))


NEAREST = duck(["v_points", "v_targets"], f"""
SELECT src_id, idx, ROUND(m, 3) AS metres FROM (
  SELECT p.id AS src_id, t.idx, {hav('p', 't')} AS m,
         row_number() OVER (PARTITION BY p.id ORDER BY {hav('p', 't')}, t.idx) AS rn
  FROM v_points p CROSS JOIN v_targets t) WHERE rn = 1""")

SNAP_METRES = 4000.0
CLUSTERS = f""", e AS (SELECT a.id AS a, b.id AS b FROM v_points a JOIN v_points b ON a.id <> b.id AND {hav('a', 'b')} <= {SNAP_METRES}),
reach AS (WITH RECURSIVE r(id, other) AS (SELECT id, id FROM v_points UNION SELECT r.id, e.b FROM r JOIN e ON r.other = e.a)
  SELECT * FROM r), label AS (SELECT id, MIN(other) AS cluster FROM reach GROUP BY 1)"""


def snap(spark, folder):
    return spatial.snap(view(spark, folder, "v_points").select("id", "lat", "lon"), SNAP_METRES)


def cluster_centres(spark, folder):
    points = view(spark, folder, "v_points").select("id", "lat", "lon")
    centres = spatial.cluster_centres(points, spatial.snap(points, SNAP_METRES))
    return centres.select("cluster", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "members",
                          F.round("radius_m", 3).alias("radius_m"))


CENTRES = duck(["v_points"], CLUSTERS + f""", m AS (SELECT p.*, cluster FROM v_points p JOIN label USING (id)), c AS (
  SELECT cluster, AVG(lat) AS lat, AVG(lon) AS lon, COUNT(*) AS members FROM m GROUP BY 1)
SELECT c.cluster, ROUND(c.lat, 6) AS lat, ROUND(c.lon, 6) AS lon, members, ROUND(MAX({hav('c', 'm')}), 3) AS radius_m
FROM c JOIN m ON c.cluster = m.cluster GROUP BY c.cluster, c.lat, c.lon, members""")


def attach_generation(spark, folder):
    plants = view(spark, folder, "v_points").select(F.col("id").alias("plant_id"), "lat", "lon",
                                                    (F.col("label") + 1.0).alias("capacity_mw"))
    buses = view(spark, folder, "v_targets").withColumn("bus_id", F.concat(F.lit("B"), F.col("idx")))
    return spatial.attach_generation(plants, buses, 8000.0)


ATTACH = duck(["v_points", "v_targets"], f""", near AS (
  SELECT p.id, p.label, t.idx, {hav('p', 't')} AS m, row_number() OVER (PARTITION BY p.id ORDER BY {hav('p', 't')}, t.idx) AS rn
  FROM v_points p CROSS JOIN v_targets t)
SELECT CASE WHEN m <= 8000 THEN 'B' || idx END AS bus_id, CAST(SUM(label + 1) AS DOUBLE) AS gen_mw, COUNT(*) AS n_plants
FROM near WHERE rn = 1 GROUP BY 1""")


def endpoint_footprint(spark, folder):
    labels = view(spark, folder, "v_nodes").select(
        F.col("node").alias("bus"), F.when(F.pmod("node", F.lit(3)) == 0, "OUT").otherwise("HOME").alias("area"))
    return spatial.endpoint_footprint(view(spark, folder, "v_lines"), labels, "HOME").select("line_id", "membership")


MEMBER = """CASE WHEN (from_bus % 3 <> 0)::INT + (to_bus % 3 <> 0)::INT = 2 THEN 'kept'
  WHEN (from_bus % 3 <> 0)::INT + (to_bus % 3 <> 0)::INT = 1 THEN 'seam' ELSE 'foreign' END"""


PLACED = ["v_lines", "v_targets"]
WHERE_BUS = ("ROUND(35 + (node * 37 % 1000) / 100.0E0, 2)", "ROUND(-101 + (node * 61 % 1000) / 125.0E0, 2)")


def _assembly(spark, folder):
    lines = view(spark, folder, "v_lines").select("line_id", "from_bus", "to_bus", "length_mi")
    lat, lon = WHERE_BUS
    buses = lines.select(F.explode(F.array("from_bus", "to_bus")).alias("node")).distinct().selectExpr(
        "node AS bus", f"{lat} AS lat", f"{lon} AS lon")
    plants = view(spark, folder, "v_targets").withColumn("area", F.when(F.pmod("idx", F.lit(5)) == 0, "OUT").when(
        F.pmod("idx", F.lit(7)) != 0, "HOME"))
    return assembly.assemble(lines, buses, plants, "HOME")


def assembled_lines(spark, folder):
    return _assembly(spark, folder).lines.select("line_id", "state")


def assembled_buses(spark, folder):
    return _assembly(spark, folder).buses.select("bus", "bus_id", "area", F.round("metres", 3).alias("metres"))


def assembly_counts(spark, folder):
    return _assembly(spark, folder).counts


ASSEMBLY = f""", ends AS (SELECT DISTINCT unnest([from_bus, to_bus]) AS node FROM v_lines),
bus AS (SELECT node, {WHERE_BUS[0]} AS lat, {WHERE_BUS[1]} AS lon FROM ends),
pool AS (SELECT *, CASE WHEN idx % 5 = 0 THEN 'OUT' ELSE 'HOME' END AS area FROM v_targets WHERE idx % 5 = 0 OR idx % 7 <> 0),
label AS (SELECT node, area, m FROM (SELECT b.node, area, {hav('b', 't')} AS m, row_number() OVER (PARTITION BY b.node ORDER BY {hav('b', 't')}, t.idx) AS rn
  FROM bus b CROSS JOIN pool t) WHERE rn = 1),
placed AS (SELECT l.*, (a.area = 'HOME')::INT + (b.area = 'HOME')::INT AS n FROM v_lines l JOIN label a ON a.node = from_bus JOIN label b ON b.node = to_bus
  WHERE from_bus <> to_bus),
e AS (SELECT from_bus AS a, to_bus AS b FROM placed WHERE n = 2 UNION SELECT to_bus, from_bus FROM placed WHERE n = 2),
reach AS (WITH RECURSIVE r(node, other) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a) SELECT * FROM r),
piece AS (SELECT node, MIN(other) AS piece FROM reach GROUP BY 1),
main AS (SELECT piece FROM piece GROUP BY 1 ORDER BY COUNT(*) DESC, piece LIMIT 1),
stated AS (SELECT line_id, length_mi, CASE n WHEN 2 THEN CASE WHEN piece = (SELECT piece FROM main) THEN 'kept' ELSE 'island' END
  WHEN 1 THEN 'seam' ELSE 'foreign' END AS state FROM placed LEFT JOIN piece ON node = from_bus)"""
ASSEMBLED_BUSES = duck(PLACED, ASSEMBLY + """
SELECT b.node AS bus, 'B' || row_number() OVER (ORDER BY ROUND(lat, 6), ROUND(lon, 6), b.node) AS bus_id, area, ROUND(m, 3) AS metres
FROM bus b JOIN piece p ON p.node = b.node AND piece = (SELECT piece FROM main) JOIN label l ON l.node = b.node""")
ASSEMBLY_COUNTS = duck(PLACED, ASSEMBLY + """, n AS (
  SELECT CASE WHEN piece = (SELECT piece FROM main) THEN 'kept' ELSE 'island' END AS state, COUNT(*) AS buses FROM piece GROUP BY 1)
SELECT s.state, COUNT(*) AS lines, COALESCE(ANY_VALUE(buses), 0) AS buses, ROUND(CAST(SUM(CAST(length_mi AS DECIMAL(24, 6))) AS DOUBLE), 1) AS miles
FROM stated s LEFT JOIN n ON n.state = s.state GROUP BY 1""")


def owner_counts(spark, folder):
    labels = view(spark, folder, "v_nodes").select(
        F.col("node").alias("bus"), F.when(F.pmod("node", F.lit(3)) == 0, "OUT").otherwise("HOME").alias("area"))
    return filings.owner_counts(spatial.endpoint_footprint(view(spark, folder, "v_lines"), labels, "HOME"))


OWNERS = duck(LINES, f"""
SELECT membership, owner, n FROM (
  SELECT membership, owner, COUNT(*) AS n, row_number() OVER (PARTITION BY membership ORDER BY COUNT(*) DESC, owner) AS rn
  FROM (SELECT owner, {MEMBER} AS membership FROM v_lines) GROUP BY 1, 2) WHERE rn <= 12""")


def voltage_counts(spark, folder):
    return filings.voltage_counts(view(spark, folder, "v_lines").withColumn(
        "length_m", F.col("length_mi") * fixed.METRES_PER_MILE))


def sequential_ids(spark, folder):
    points = view(spark, folder, "v_points")
    placed = ordered_position(points, [F.col("lat"), F.col("lon"), F.col("id")])
    return placed.select("id", F.concat(F.lit("B"), F.col("position").cast("string")).alias("bus_id"))


def _features(spark, folder):
    """GeoJSON-like features: every third has two parts, some are malformed or repeated."""
    p = view(spark, folder, "v_points")
    a = F.concat(F.lit("["), F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit("]"))
    b = F.concat(F.lit("["), (F.col("lon") + 0.01).cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit("]"))
    c = F.concat(F.lit("["), (F.col("lon") + 0.02).cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit("]"))
    single = F.concat(F.lit("["), a, F.lit(","), b, F.lit("]"))
    stub = F.concat(F.lit("["), a, F.lit(","), a, F.lit("]"))
    second = F.concat(F.lit("["), c, F.lit(","), b, F.lit("]"))
    k = F.pmod("id", F.lit(9))
    return parse_geometry(p.select(
        F.col("id").alias("ord"),
        F.when(F.pmod("id", F.lit(31)) == 0, " ").when(F.pmod("id", F.lit(10)) == 9, F.concat(F.lit("F"), (F.col("id") - 1).cast("string")))
        .otherwise(F.concat(F.lit("F"), F.col("id").cast("string"))).alias("hid"),
        F.when(F.pmod("id", F.lit(12)) == 5, F.lit(-999999.0)).when(F.pmod("id", F.lit(12)) == 6, 12.5).otherwise(345.0).alias("kv"),
        F.when(F.pmod("id", F.lit(14)) == 3, "inactive").when(F.pmod("id", F.lit(14)) == 4, "UNDER  CONSTRUCTION")
        .otherwise("IN SERVICE").alias("status"),
        F.when(F.pmod("id", F.lit(16)) == 7, "DC; OVERHEAD").otherwise("AC").alias("kind"),
        F.when(F.pmod("id", F.lit(3)) == 0, "MultiLineString").when(k == 1, "Point").otherwise("LineString").alias("shape"),
        F.when(F.pmod("id", F.lit(3)) == 0, F.concat(F.lit("["), single, F.lit(","), second, F.lit(","), stub, F.lit("]")))
        .when(k == 1, a).when(k == 4, stub).otherwise(single).alias("coordinates"), "lat", "lon"))


def classify_features(spark, folder):
    done = filings.classify_features(_features(spark, folder), 69.0)
    return done.select("ord", "hid", "reason", F.round("length_m", 3).alias("length_m"))


LEG = """2 * 6371008.8 * asin(sqrt(pow(cos(radians(lat)) * sin(radians({w}) / 2), 2)))"""
FEATURES = f""", f AS (
  SELECT id AS ord, CASE WHEN id % 31 = 0 THEN '' WHEN id % 10 = 9 THEN 'F' || (id - 1) ELSE 'F' || id END AS hid,
    CASE WHEN id % 16 = 7 THEN 'dc' WHEN id % 14 = 3 THEN 'inactive' WHEN id % 14 = 4 THEN 'under_construction'
         WHEN id % 12 = 5 THEN 'unknown_kv' WHEN id % 12 = 6 THEN 'below_min_kv'
         WHEN id % 3 <> 0 AND id % 9 IN (1, 4) THEN 'bad_geometry' END AS own,
    CASE WHEN id % 3 = 0 THEN {LEG.replace('{w}', '0.01')} + {LEG.replace('{w}', '0.01')} ELSE {LEG.replace('{w}', '0.01')} END AS len
  FROM v_points), first AS (SELECT hid, MIN(ord) AS kept_at FROM f WHERE hid <> '' AND own IS NULL GROUP BY 1), c AS (
  SELECT f.ord, f.hid, len, CASE WHEN f.hid = '' THEN 'bad_id' WHEN f.ord > kept_at THEN 'duplicate_id' ELSE own END AS reason
  FROM f LEFT JOIN first ON f.hid = first.hid)"""
CLASSIFY_FEATURES = duck(["v_points"], FEATURES + """
SELECT ord, hid, reason, CASE WHEN reason IS NULL THEN ROUND(len, 3) END AS length_m FROM c""")


def feature_reasons(spark, folder):
    return filings.feature_reasons(filings.classify_features(_features(spark, folder), 69.0))


def chain_parts(spark, folder):
    kept = filings.classify_features(_features(spark, folder), 69.0).where("reason is null")
    return filings.chain_parts(kept).select(
        "ord", F.round("head.lon", 6).alias("head_lon"), F.round("tail.lon", 6).alias("tail_lon"),
        F.round("gap_m", 3).alias("gap_m"))


def pair_distances(spark, folder):
    p, t = view(spark, folder, "v_points"), view(spark, folder, "v_targets")
    joined = p.join(t, p["id"] == t["idx"]).select(
        "id", geo.haversine_m(p["lat"], p["lon"], t["lat"], t["lon"]).alias("m"),
        geo.path_m(F.array(F.struct(p["lat"], p["lon"]), F.struct(t["lat"], t["lon"]),
                           F.struct(p["lat"], p["lon"]))).alias("path"))
    return joined.select("id", F.round("m", 3).alias("metres"), F.round("path", 3).alias("path_m"))


PAIRS = duck(["v_points", "v_targets"], f"""
SELECT p.id, ROUND({hav('p', 't')}, 3) AS metres, ROUND(2 * {hav('p', 't')}, 3) AS path_m
FROM v_points p JOIN v_targets t ON p.id = t.idx""")


# --- network ---------------------------------------------------------------------------

def impedance(spark, folder):
    lines = network.with_rating(network.with_reactance(view(spark, folder, "v_lines")))
    return lines.select("line_id", F.round("reactance.lo", 9).alias("lo"), F.round("reactance.expected", 9).alias("expected"),
                        F.round("reactance.hi", 9).alias("hi"), "thermal_limit_mw", "imputed")


RATINGS = ", ".join(f"({v}, {mw})" for v, mw in fixed.TYPICAL_RATING_MW)
IMPEDANCE = duck(LINES, f"""
SELECT line_id, ROUND(0.7 * x, 9) AS lo, ROUND(x, 9) AS expected, ROUND(1.3 * x, 9) AS hi,
       COALESCE(thermal_limit_mw, (SELECT first(mw ORDER BY abs(v - kv), v) FROM (VALUES {RATINGS}) r(v, mw))) AS thermal_limit_mw,
       thermal_limit_mw IS NULL AS imputed
FROM (SELECT *, 0.8 * length_mi / (kv * kv / 100) AS x FROM v_lines)""")


def injections(spark, folder):
    inj = network.injections(view(spark, folder, "v_buses"), view(spark, folder, "v_load"))
    return inj.withColumn("mw", F.round("mw", 6))


INJECT = """, s AS (SELECT snapshot, CAST(SUM(CAST(load_mw AS DECIMAL(24, 6))) AS DOUBLE) AS total FROM v_load GROUP BY 1), w AS (
  SELECT bus_id, CASE role WHEN 'load' THEN -weight / (SELECT SUM(weight) FROM v_buses WHERE role = 'load')
                           ELSE weight / (SELECT SUM(weight) FROM v_buses WHERE role = 'gen') END AS share FROM v_buses)"""
INJECTIONS = duck(["v_buses", "v_load"], INJECT + """
SELECT snapshot, bus_id, ROUND(total * (share - (SELECT AVG(share) FROM w)), 6) AS mw FROM s CROSS JOIN w""")


SCREENED = """, lines AS (SELECT *, CAST(substr(line_id, 2) AS BIGINT) AS n FROM v_ring), c AS (
  SELECT 'F_' || line_id AS constraint_id, CASE WHEN n % 6 = 5 THEN NULL ELSE line_id END AS m,
         CASE WHEN n % 6 = 0 THEN NULL WHEN n % 6 = 1 THEN 'NOWHERE' WHEN n % 6 = 2 THEN line_id
              ELSE 'X' || (n - n % 5) END AS k FROM lines), limits AS (
  SELECT line_id, from_bus, to_bus, CASE WHEN n % 11 = 3 THEN NULL ELSE thermal_limit_mw END AS thermal FROM lines)"""


def _screened(spark, folder):
    """Ring lines, some without a limit, and one flowgate per line."""
    n = F.substring("line_id", 2, 20).cast("bigint")
    k = F.pmod(n, F.lit(6))
    ring = view(spark, folder, "v_ring")
    constraints = ring.select(
        F.concat(F.lit("F_"), "line_id").alias("constraint_id"), F.when(k != 5, F.col("line_id")).alias("monitored_line"),
        F.when(k == 1, "NOWHERE").when(k == 2, F.col("line_id"))
        .when(k != 0, F.concat(F.lit("X"), (n - F.pmod(n, F.lit(5))).cast("string"))).alias("contingency_line"))
    return constraints, ring.withColumn("thermal_limit_mw", F.when(F.pmod(n, F.lit(11)) != 3, F.col("thermal_limit_mw")))


def loading_screen(spark, folder):
    constraints, lines = _screened(spark, folder)
    inject = network.injections(view(spark, folder, "v_buses"), view(spark, folder, "v_load"))
    return network.screen(constraints, lines, inject, view(spark, folder, "v_ptdf")).select(
        "constraint_id", "status", F.round("loading.lo", 6).alias("lo"), F.round("loading.expected", 6).alias("expected"),
        F.round("loading.hi", 6).alias("hi"), network.over_limit(F.col("loading")).alias("flag"))


def base_flows(spark, folder):
    inject = network.injections(view(spark, folder, "v_buses"), view(spark, folder, "v_load"))
    return network.base_flows(view(spark, folder, "v_ptdf"), inject).withColumn("flow", F.round("flow", 6))


FLOWS = INJECT + """, inj AS (SELECT snapshot, bus_id, total * (share - (SELECT AVG(share) FROM w)) AS mw FROM s CROSS JOIN w),
flow AS (SELECT snapshot, line_id, SUM(ptdf * mw) AS flow FROM v_ptdf JOIN inj USING (bus_id) GROUP BY 1, 2)"""
BASE_FLOWS = duck(["v_buses", "v_load", "v_ptdf"], FLOWS + " SELECT snapshot, line_id, ROUND(flow, 6) AS flow FROM flow")
LOADING_SCREEN = duck(["v_buses", "v_load", "v_ptdf"], FLOWS + SCREENED + """, r AS (
  SELECT c.*, l.line_id IS NOT NULL AS placed, l.thermal, kl.line_id IS NOT NULL AND EXISTS (SELECT 1 FROM v_ptdf p WHERE p.line_id = c.k) AS ctg,
         kl.from_bus AS kf, kl.to_bus AS kt FROM c LEFT JOIN limits l ON c.m = l.line_id LEFT JOIN limits kl ON c.k = kl.line_id), h AS (
  SELECT r.*, COALESCE(mf.ptdf, 0) - COALESCE(mt.ptdf, 0) AS h_mk, COALESCE(of.ptdf, 0) - COALESCE(ot.ptdf, 0) AS h_kk FROM r
  LEFT JOIN v_ptdf mf ON mf.line_id = m AND mf.bus_id = kf LEFT JOIN v_ptdf mt ON mt.line_id = m AND mt.bus_id = kt
  LEFT JOIN v_ptdf of ON of.line_id = k AND of.bus_id = kf LEFT JOIN v_ptdf ot ON ot.line_id = k AND ot.bus_id = kt), x AS (
  SELECT h.*, a.flow AS f_m, ctg AND abs(1 - h_kk) < 1e-9 AS island,
         CASE WHEN NOT (ctg AND abs(1 - h_kk) < 1e-9) THEN
           CASE WHEN m = k THEN 0 ELSE a.flow + h_mk / (1 - h_kk) * b.flow END END AS after
  FROM h LEFT JOIN flow a ON a.line_id = m LEFT JOIN flow b ON b.line_id = k AND b.snapshot = a.snapshot AND ctg), g AS (
  SELECT constraint_id, any_value(k) AS k, bool_or(placed) AS placed, any_value(thermal) AS thermal, bool_or(ctg) AS ctg,
         bool_or(island) AS island, COUNT(f_m) AS n, MIN(abs(f_m)) / any_value(thermal) AS b0, AVG(abs(f_m)) / any_value(thermal) AS b1,
         MAX(abs(f_m)) / any_value(thermal) AS b2, MIN(abs(after)) / any_value(thermal) AS n0, AVG(abs(after)) / any_value(thermal) AS n1,
         MAX(abs(after)) / any_value(thermal) AS n2 FROM x GROUP BY 1), s2 AS (
  SELECT *, CASE WHEN NOT placed THEN 'unmapped_monitored' WHEN COALESCE(thermal, 0) = 0 THEN 'no_thermal_limit'
    WHEN n = 0 THEN 'no_base_flows' WHEN k IS NOT NULL AND NOT ctg THEN 'contingency_unmapped'
    WHEN k IS NOT NULL AND island THEN 'n1_disconnect' ELSE 'ok' END AS status FROM g), o AS (
  SELECT constraint_id, status,
    CASE WHEN status = 'unmapped_monitored' THEN 0 WHEN status IN ('no_thermal_limit', 'no_base_flows') THEN 0
         WHEN status IN ('contingency_unmapped', 'n1_disconnect') THEN b0 * 0.8 WHEN k IS NULL THEN b0 ELSE n0 END AS lo,
    CASE WHEN status = 'unmapped_monitored' THEN 0 WHEN status IN ('no_thermal_limit', 'no_base_flows') THEN 1
         WHEN status IN ('contingency_unmapped', 'n1_disconnect') THEN b1 WHEN k IS NULL THEN b1 ELSE n1 END AS expected,
    CASE WHEN status = 'unmapped_monitored' THEN 0 WHEN status IN ('no_thermal_limit', 'no_base_flows') THEN 2
         WHEN status IN ('contingency_unmapped', 'n1_disconnect') THEN b2 * 1.5 WHEN k IS NULL THEN b2 ELSE n2 END AS hi FROM s2)
SELECT constraint_id, status, ROUND(lo, 6) AS lo, ROUND(expected, 6) AS expected, ROUND(hi, 6) AS hi,
       CASE WHEN hi > 1 THEN 'binds_under_n1' END AS flag FROM o""")


def bus_map(spark, folder):
    queue = view(spark, folder, "v_poi").select(
        F.pmod(F.substring("request_id", 2, 20).cast("bigint"), F.lit(60)).cast("string").alias("near_bus"), "mw")
    return corridors.bus_map_rows(view(spark, folder, "v_buses"), queue)


BUS_MAP = duck(["v_buses", "v_poi"], """
SELECT b.bus_id, lat, lon, gen_mw, COALESCE(q.mw, 0) AS queue_mw, COALESCE(q.n, 0) AS requests
FROM v_buses b LEFT JOIN (SELECT CAST(CAST(substr(request_id, 2) AS BIGINT) % 60 AS VARCHAR) AS bus, CAST(SUM(CAST(mw AS DECIMAL(20, 6))) AS DOUBLE) AS mw,
  COUNT(*) AS n FROM v_poi GROUP BY 1) q ON b.bus_id = q.bus WHERE gen_mw > 0 OR q.mw > 0""")


def map_centre(spark, folder):
    c = corridors.map_centre(view(spark, folder, "v_points"))
    return c.select(F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


QUERIES = {
    "bus_degree": (bus_degree, duck(LINES, DEGREE + " SELECT bus, degree FROM degree")),
    "radial_lines": (radial_lines, RADIAL),
    "adjacency": (adjacency, duck(LINES, DEGREE + " SELECT DISTINCT bus, far AS neighbour FROM ends")),
    "without_loops": (without_loops, duck(LINES, " SELECT line_id, from_bus, to_bus FROM v_lines WHERE from_bus <> to_bus")),
    "queue_near": (queue_near, QUEUE_NEAR),
    "components": (components, COMPONENTS),
    "name_buses": (name_buses, None),
    "nearest": (nearest, NEAREST),
    "snap_clusters": (snap, duck(["v_points"], CLUSTERS + " SELECT id, cluster FROM label")),
    "cluster_centres": (cluster_centres, CENTRES),
    "attach_generation": (attach_generation, ATTACH),
    "assembled_lines": (assembled_lines, duck(PLACED, ASSEMBLY + " SELECT line_id, state FROM stated")),
    "assembled_buses": (assembled_buses, ASSEMBLED_BUSES),
    "assembly_counts": (assembly_counts, ASSEMBLY_COUNTS),
    "endpoint_footprint": (endpoint_footprint, duck(LINES, f" SELECT line_id, {MEMBER} AS membership FROM v_lines")),
    "owner_counts": (owner_counts, OWNERS),
    "voltage_counts": (voltage_counts, duck(LINES, """
SELECT CAST(CAST(kv AS BIGINT) AS VARCHAR) AS kv, COUNT(*) AS n, ROUND(SUM(length_mi), 1) AS miles FROM v_lines GROUP BY 1""")),
    "sequential_ids": (sequential_ids, duck(["v_points"], """
SELECT id, 'B' || row_number() OVER (ORDER BY lat, lon, id) AS bus_id FROM v_points""")),
    "classify_features": (classify_features, CLASSIFY_FEATURES),
    "feature_reasons": (feature_reasons, duck(["v_points"], FEATURES + """
SELECT COALESCE(reason, 'kept') AS reason, COUNT(*) AS n FROM c GROUP BY 1""")),
    "chain_parts": (chain_parts, duck(["v_points"], FEATURES + """
SELECT c.ord, ROUND(lon, 6) AS head_lon, ROUND(lon + CASE WHEN c.ord % 3 = 0 THEN 0.02 ELSE 0.01 END, 6) AS tail_lon,
       0.0 AS gap_m FROM c JOIN v_points p ON c.ord = p.id WHERE reason IS NULL""")),
    "pair_distances": (pair_distances, PAIRS),
    "impedance": (impedance, IMPEDANCE),
    "injections": (injections, INJECTIONS),
    "loading_screen": (loading_screen, LOADING_SCREEN),
    "base_flows": (base_flows, BASE_FLOWS),
    "bus_map": (bus_map, BUS_MAP),
    "map_centre": (map_centre, duck(["v_points"], " SELECT ROUND(AVG(lat), 9) AS lat, ROUND(AVG(lon), 9) AS lon FROM v_points")),
}
