"""Scans and sinks: files that the queries write from the driver tables, read back through the sources."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from checks import hours, network, panel as panel_checks, quality, scoring
from checks.views import duck, table, view
from fluxsieve import fixed
from fluxsieve.functions import numeric
from fluxsieve.operators import filings, lineage, rollups, validation
from fluxsieve.plans import corridors
from fluxsieve.session import cut, shared_folder, shelve
from fluxsieve.sinks import exports
from fluxsieve.sources import market, records, tables
from fluxsieve.sources.digests import folder_digests

STAMP = {"source": "s", "source_version": "v", "retrieved_at": "2026-01-01T00:00:00Z"}


def _csv(df, path, *by):
    """Published files: every cell quoted where it must be, headers as given."""
    writer = df.write.options(**exports.CSV)
    (writer.partitionBy(*by) if by else writer).csv(path)


# --- text tables -------------------------------------------------------------------------

def split_records(spark, folder):
    """Order comments with line breaks, quotes and commas in two layouts of columns, read in one scan."""
    root = shared_folder(spark)
    o = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"), F.concat(
            "o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, F.lit(' "quoted", ')).otherwise(""),
            F.when(F.col("o_orderkey") % 5 == 0, F.lit('\n\n"\nnext')).otherwise("")).alias("note"), F.col("o_orderstatus").alias("state"))
    _csv(o.where("state <> 'F'").select("key", "note", "state"), f"{root}/a")
    _csv(o.where("state = 'F'").select(F.col("state").alias(" state"), F.lit("x").alias("extra"), "note", "key"), f"{root}/b")
    return records.read_split(spark, [f"{root}/a", f"{root}/b"], ("key", "state", "note"), "orders").select("key", "state", "note")


SPLIT_RECORDS = """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS state, o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN ' "quoted", ' ELSE '' END
       || CASE WHEN o_orderkey % 5 = 0 THEN chr(10) || chr(10) || '"' || chr(10) || 'next' ELSE '' END AS note FROM orders"""


def footprint_scan(spark, folder):
    """The footprint file: exactly its columns, in another order, trimmed."""
    root = shared_folder(spark)
    f = view(spark, folder, "v_footprint")
    _csv(f.select(*[F.concat(F.lit(" "), F.col(c)).alias(c) for c in reversed(fixed.FOOTPRINT_COLUMNS)]), root)
    return tables.read_footprint(spark, root)


FOOTPRINT_SCAN = duck(["v_footprint"], f" SELECT {', '.join(fixed.FOOTPRINT_COLUMNS)} FROM v_footprint")


# --- market and authority files ------------------------------------------------------------

def binding_scan(spark, folder):
    """Hourly rows as one file per month, read, checked against their file's month and parsed."""
    root = shared_folder(spark)
    rows = hours._hour_text(spark, folder)
    stamped = rows.withColumn("file", F.concat(F.lit("B-"), F.date_format("file_month", "yyyyMM"), F.lit(".csv"))).drop("file_month")
    ends = F.date_format(F.to_timestamp("Interval", fixed.MARKET_TIME) + F.expr("interval 1 second"), fixed.MARKET_TIME)
    _csv(stamped.withColumn("Interval", ends).withColumnRenamed("Contingency Name", " Contingency Name"), root, "file")
    found = market.binding_hours(market.binding_rows(spark, root))
    return found.groupBy("name", "contingency", "month").agg(
        F.count(F.lit(1)).alias("n"), F.min("utc").alias("first"), F.max("utc").alias("last"),
        F.sum(F.col("price").cast("decimal(20,4)")).cast("double").alias("price"), F.max("monitored").alias("monitored"),
        F.max("contingent").alias("contingent"), F.max("kind").alias("kind"), F.max("state").alias("state"))


def dollar_scan(spark, folder):
    """Monthly dollars as one file per month."""
    root = shared_folder(spark)
    d = view(spark, folder, "v_dollars")
    _csv(d.select(F.date_format("month", "yyyyMM").alias("Date"), F.col("name").alias(" Constraint Name"),
                  F.col("monitored").alias("Monitored Facility"), F.lit("x").alias("Contingent Facility"),
                  F.col("contingency").alias("Contingency Name"), F.col("amount").cast("string").alias("Sum"),
                  F.concat(F.lit("cbc_"), F.date_format("month", "yyyyMM"), F.lit(".csv")).alias("file")), root, "file")
    return market.dollar_rows(spark, root).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(20,4)")).cast("double").alias("usd"),
        F.count_distinct("name").alias("names"))


def settled_scan(spark, folder):
    """Settled collections read from their files."""
    root = shared_folder(spark)
    _csv(view(spark, folder, "v_settled").select(
        F.lit("C").alias("Constraint Name"), F.col("collected").cast("string").alias("DA Collected"), F.lit("1").alias("Funding"),
        F.date_format("month", "MM/yyyy").alias("Month")), root)
    return market.settled_rows(spark, root).groupBy("month").agg(
        F.sum(F.col("collected").cast("decimal(20,4)")).cast("double").alias("collected"))


WIND = [c for group in fixed.WIND_COLUMN_GROUPS for c in group]


def authority_scan(spark, folder):
    """Hours of all authorities as half-year files with differing columns; those of one authority and its first year are taken."""
    root = shared_folder(spark)
    rows = hours._published(spark, folder)
    stamp = F.date_format("utc", fixed.HOURLY_TIME)
    named = rows.select(
        F.col("ba").alias("Balancing Authority"), F.date_format("utc", "MM/dd/yyyy").alias("Data Date"),
        stamp.alias("UTC Time at End of Hour"), *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns if c not in ("ba", "utc")],
        (F.month("utc") <= 6).alias("first"))
    _csv(named.where("first").drop("first", *[c for c in WIND if c in named.columns]).withColumn("Note", F.lit("two\nlines")), f"{root}/a")
    _csv(named.where("NOT first").drop("first").select(*reversed([c for c in named.columns if c != "first"])), f"{root}/b")
    pick = rows.agg(F.min("ba").alias("ba"), F.min(F.year("utc")).alias("year")).first()
    taken = market.authority_rows(spark, [f"{root}/a", f"{root}/b"], pick["ba"] or "", pick["year"] or 0)
    return rollups.authority_hours(taken).withColumn("utc", F.col("utc").cast("string")).withColumn("wind_share", F.round("wind_share", 9))


AUTHORITY_SCAN = duck(["v_ba_text"], hours.HOURLY + """
SELECT ba, CAST(utc AS VARCHAR) AS utc, demand, demand_text, demand_column,
       CASE WHEN EXTRACT(MONTH FROM utc) > 6 THEN ROUND(wind_share, 9) END AS wind_share FROM hourly
WHERE ba = (SELECT MIN(ba) FROM v_ba_text) AND EXTRACT(YEAR FROM utc) = (SELECT MIN(EXTRACT(YEAR FROM utc)) FROM v_ba_text)""")


def queue_scan(spark, folder):
    """Requests as queue files, each with preamble, header and cells that hold line breaks."""
    root = shared_folder(spark)
    v = view(spark, folder, "v_poi")
    cells = {"Generation Interconnection Number": F.col("request_id"), "Capacity": F.col("mw").cast("string"),
             "Fuel Type": F.lit("Wind"), "Substation or Line": F.regexp_replace("poi", " ", "\n "), "Status": F.col("status"),
             "Date Withdrawn": F.col("withdrawn"), "State": F.lit("KS"), "TO at POI": F.lit('the "TO", x'), "Generation Type": F.lit("")}
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in cells.values()]
    head = ['"Last Updated On",3/4/2026,', ",".join(f'"{c}"' for c in cells)]

    def topped(batches):
        yield pa.RecordBatch.from_arrays([pa.array(head)], ["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])

    v.select(F.concat_ws(",", *quoted).alias("value")).mapInArrow(topped, "value string").write.text(root)
    version, active = market.queue_file(spark, root)
    return active.select("request_id", F.round("mw", 6).alias("mw"), "fuel", "poi", "to_at_poi", "status", F.lit(version).alias("version"))


QUEUE_SCAN = duck(["v_poi"], f"""
SELECT request_id, round(mw, 6) AS mw, 'Wind' AS fuel, poi, 'the "TO", x' AS to_at_poi, status, 'spp_giq_2026-03-04' AS version
FROM v_poi WHERE {quality.ACTIVE}""")


def feature_scan(spark, folder):
    """Line features written as a collection's text, one scan cut at every feature; broken geometry stays countable."""
    root = shared_folder(spark)
    p = network._features(spark, folder)
    text = F.concat(
        F.lit('{"type":"Feature","properties":{"ID":"'), F.col("hid"), F.lit('","VOLTAGE":'), F.col("kv").cast("string"),
        F.lit(',"STATUS":"'), F.col("status"), F.lit('","TYPE":"'), F.col("kind"), F.lit('"},"geometry":{"type":"'), F.col("shape"),
        F.lit('","coordinates":'), F.col("coordinates"), F.lit("}}"))

    def collection(batches):
        yield pa.RecordBatch.from_arrays([pa.array(['{"type":"FeatureCollection","features":['])], ["value"])
        first = True
        for batch in batches:
            values = batch.column(0).to_pylist()
            for value in values:
                yield pa.RecordBatch.from_arrays([pa.array([value if first else "," + value])], ["value"])
                first = False
        yield pa.RecordBatch.from_arrays([pa.array(["]}"])], ["value"])

    p.select(text.alias("value")).mapInArrow(collection, "value string").write.text(root)
    found = market.line_features(spark, root, '{"type":"Feature",')
    length = lambda parts: F.aggregate(F.transform(parts, lambda x: F.size(x)), F.lit(0), lambda a, b: a + b)
    return found.groupBy("hid", "kv", "status", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.count("parts").alias("sound"), F.sum(length(F.coalesce("parts", F.array()))).alias("points"))


FEATURE_SCAN = duck(["v_points"], """
SELECT CASE WHEN id % 31 = 0 THEN ' ' WHEN id % 10 = 9 THEN 'F' || (id - 1) ELSE 'F' || id END AS hid,
       CASE WHEN id % 12 = 5 THEN -999999.0 WHEN id % 12 = 6 THEN 12.5 ELSE 345.0 END AS kv,
       CASE WHEN id % 14 = 3 THEN 'inactive' WHEN id % 14 = 4 THEN 'UNDER  CONSTRUCTION' ELSE 'IN SERVICE' END AS status,
       CASE WHEN id % 16 = 7 THEN 'DC; OVERHEAD' ELSE 'AC' END AS kind, COUNT(*) AS n,
       COUNT(*) FILTER (id % 3 = 0 OR id % 9 <> 1) AS sound,
       SUM(CASE WHEN id % 3 = 0 THEN 6 WHEN id % 9 = 1 THEN 0 ELSE 2 END) AS points FROM v_points GROUP BY 1, 2, 3, 4""")


# --- manifests, digests and stamps ----------------------------------------------------------

def manifest_fields(spark, folder):
    """One manifest per customer, some with fields the schema does not know."""
    k = F.col("c_custkey")
    stamp = '"source":"s","source_version":"v","retrieved_at":"2026-01-01T00:00:00Z"'
    lines = table(spark, folder, "customer").select(k.cast("string").alias("manifest"), F.concat(
        F.lit('{"schema_version":1,"tables":{"buses":{"path":"p","rows":1,' + stamp + ',"contributors":[{' + stamp),
        F.when(k % 3 == 0, F.concat(F.lit(',"license":"L'), k.cast("string"), F.lit('"'))).otherwise(""),
        F.lit('}],"column_sources":{"kv":{' + stamp), F.when(k % 4 == 0, ',"unit":"kV"').otherwise(""), F.lit("}}"),
        F.when(k % 5 == 0, F.concat(F.lit(',"checked":'), k.cast("string"))).otherwise(""),
        F.when(k % 7 == 0, F.lit("}}")).otherwise("}}}")).alias("value"))
    root = shared_folder(spark)
    lines.write.json(root)
    return tables.manifest_fields(spark.read.schema("manifest string, value string").json(root))


MANIFEST_FIELDS = """
WITH k AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS manifest FROM customer WHERE c_custkey % 7 <> 0)
SELECT manifest, 'buses' AS "table", 'contributor' AS role, CAST(NULL AS VARCHAR) AS "column", 'license' AS field, '"L' || k || '"' AS value FROM k WHERE k % 3 = 0
UNION ALL SELECT manifest, 'buses', 'column', 'kv', 'unit', '"kV"' FROM k WHERE k % 4 = 0
UNION ALL SELECT manifest, 'buses', 'table', NULL, 'checked', manifest FROM k WHERE k % 5 = 0"""


def _month_lines(spark, folder, root):
    """Orders' lines as one sorted file per month."""
    o = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("month"), F.format_string("%012d %s", "o_orderkey", "o_orderpriority").alias("value"))
    o.repartition("month").sortWithinPartitions("month", "value").write.partitionBy("month").text(root)


def file_digests(spark, folder):
    """Bytes and SHA-256 of files hashed in chunks, one task a file."""
    root = shared_folder(spark)
    _month_lines(spark, folder, root)
    return folder_digests(spark, root).select(
        F.regexp_extract("relative", r"month=(\d{6})/", 1).alias("month"), "bytes", "sha256")


FILE_DIGESTS = """
SELECT strftime(o_orderdate, '%Y%m') AS month, SUM(strlen(v) + 1)::BIGINT AS bytes, sha256(string_agg(v || chr(10), '' ORDER BY v)) AS sha256
FROM (SELECT o_orderdate, lpad(o_orderkey::VARCHAR, 12, '0') || ' ' || o_orderpriority AS v FROM orders) GROUP BY 1"""


def verified_entries(spark, folder):
    """Manifest entries against the files: recorded digests are those of the file but for planted ones, and some files are gone."""
    root = shared_folder(spark)
    _month_lines(spark, folder, root)
    real = cut(folder_digests(spark, root).withColumn("month", F.regexp_extract("relative", r"month=(\d{6})/", 1)))
    n = F.col("month").cast("int") % 100
    entries = real.select(
        "month", F.when(n == 2, F.concat("relative", F.lit(".gone"))).otherwise(F.col("relative")).alias("path"),
        F.when(n == 3, F.repeat(F.lit("0"), 64)).otherwise(F.col("sha256")).alias("sha256"))
    return tables.digest_failures(spark, root, entries, "month").select("month", F.col("found").isNull().alias("missing"))


VERIFIED = """SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS month, EXTRACT(MONTH FROM o_orderdate) = 2 AS missing
FROM orders WHERE EXTRACT(MONTH FROM o_orderdate) IN (2, 3)"""


def stamp_faults(spark, folder):
    """Broken rules of source stamps."""
    k = F.col("p_partkey")
    return validation.stamp_violations(table(spark, folder, "part").select(
        k.cast("string").alias("table"), F.lit("table").alias("role"), F.when(k % 3 == 0, " ").otherwise("s").alias("source"),
        F.when(k % 5 == 0, F.lit(None)).otherwise("v").alias("source_version"),
        F.when(k % 7 == 0, "2026-01-01T00:00:00").when(k % 7 == 1, "soonZ").otherwise("2026-01-01T00:00:00+01:00").alias("retrieved_at_text")))


STAMP_FAULTS = """
WITH p AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS "table", 'table' AS role, CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE 's' END AS source FROM part)
SELECT "table", role, source, 'source' AS rule FROM p WHERE k % 3 = 0 UNION ALL SELECT "table", role, source, 'source_version' FROM p WHERE k % 5 = 0
UNION ALL SELECT "table", role, source, 'retrieved_at' FROM p WHERE k % 7 IN (0, 1)"""


def raw_entries(spark, folder):
    """Broken rules of raw inputs."""
    k = F.col("p_partkey")
    return validation.raw_entry_violations(table(spark, folder, "part").select(
        k.cast("string").alias("key"), F.when(k % 4 == 0, "").otherwise("u").alias("url"),
        F.lit("2026-01-01T00:00:00Z").alias("retrieved_at"), F.when(k % 6 == 0, "XYZ").otherwise(F.sha2(k.cast("string"), 256)).alias("sha256"),
        F.when(k % 9 == 0, "raw/../x").when(k % 9 == 1, "/x").otherwise("raw/x..y").alias("path")))


RAW_ENTRIES = """
SELECT CAST(p_partkey AS VARCHAR) AS key, unnest(list_filter([CASE WHEN p_partkey % 4 = 0 THEN 'url' END, CASE WHEN p_partkey % 6 = 0 THEN 'sha256' END,
       CASE WHEN p_partkey % 9 IN (0, 1) THEN 'path' END], lambda x: x IS NOT NULL)) AS rule FROM part"""


# --- filings release -------------------------------------------------------------------------

def respondent_filings(spark, folder):
    """A release laid out by report year, typed, its latest year and some respondents: the scan prunes the other years."""
    root = shared_folder(spark)
    f = view(spark, folder, "v_filings")
    f.select(F.col("record_id").cast("string").alias("record_id"), F.col("utility_id").alias("utility_id_ferc1"),
             F.col("utility_name").alias("utility_name_ferc1"), "report_year", "start_point", "end_point",
             F.col("kv").cast("string").alias("operating_voltage_kv"), F.col("standalone_mi").cast("float").alias("transmission_line_length_miles"),
             F.col("aggregated_mi").alias("transmission_line_and_structures_length_miles"), F.col("capex").alias("capex_total")
             ).write.partitionBy("report_year").parquet(root)
    kept = filings.respondent_filings(tables.release_table(spark, root), [1, 3, 5, 7])
    return kept.select("record_id", "utility_id", "utility_name", "report_year", "start_point", "kv", "standalone_mi", "aggregated_mi")


RESPONDENTS = duck(["v_filings"], """
SELECT CAST(record_id AS VARCHAR) AS record_id, utility_id, utility_name, report_year, start_point, kv, standalone_mi, aggregated_mi FROM v_filings
WHERE report_year = (SELECT MAX(report_year) FROM v_filings) AND utility_id IN (1, 3, 5, 7)""")


# --- outputs read back --------------------------------------------------------------------------

def _exported(spark, folder, root):
    rows = scoring._export(spark, folder).select(
        "rank", F.concat(F.lit("="), "constraint_id").alias("constraint_id"), "physical_corridor", "p_top_k", "ev_mean_musd", "monitored_facility")
    line = shelve(rows)
    owned = line.groupBy("physical_corridor").agg(F.min("rank").alias("corridor_rank"))
    members = line.select("physical_corridor", F.col("rank").alias("position"), "constraint_id")
    exports.export_scores(line, owned, members, root)
    registry = table(spark, folder, "region").select(
        F.col("r_name").alias("source"), F.lit("v1").alias("source_version"), F.lit(True).alias("publishable"))
    exports.write_run_manifest(registry, root, ["scores.json", "scores.csv", "scores.parquet", "shortlist.json"],
                               run_label="t", region="x", mode="internal", generated_at="2026-01-01", scoring={"seed": 1})
    return line


def run_exports(spark, folder):
    """A run's outputs written once, verified against its manifest and read back: JSON, CSV and Parquet, rows to columns again."""
    root = f"{shared_folder(spark)}/run"
    line = _exported(spark, folder, root)
    run = tables.read_run(spark, root)
    exports.json_rows_to_parquet(spark, f"{root}/scores.json", line.schema, f"{root}/again.parquet")
    text = spark.read.options(header=True, escape='"').csv(f"{root}/scores.csv")
    same = ["rank", "constraint_id", "physical_corridor"]
    cast = lambda df, name: df.select(F.lit(name).alias("output"), F.col("rank").cast("long").alias("rank"), *same[1:])
    out = cast(run["scores"], "run").unionByName(cast(text, "csv")).unionByName(cast(spark.read.parquet(f"{root}/again.parquet"), "parquet"))
    short = run["shortlist"].select(F.lit("shortlist").alias("output"), F.col("corridor_rank").cast("long").alias("rank"),
                                    F.lit("").alias("constraint_id"), "physical_corridor")
    return out.unionByName(short)


RUN_EXPORTS = f"""
WITH e AS (SELECT CAST(rank AS BIGINT) AS rank, constraint_id, physical_corridor FROM ({scoring.EXPORT}))
SELECT output, rank, CASE WHEN output = 'csv' THEN chr(39) ELSE '' END || '=' || constraint_id AS constraint_id, physical_corridor
FROM e, (VALUES ('run'), ('csv'), ('parquet')) o(output)
UNION ALL SELECT 'shortlist', MIN(rank), '', physical_corridor FROM e GROUP BY 4"""


def run_catalogue(spark, folder):
    """Finished runs under a folder."""
    root = shared_folder(spark)
    _exported(spark, folder, f"{root}/first")
    return tables.run_catalogue(spark, root)


def page_export(spark, folder):
    """The page's rows written and read back."""
    root = shared_folder(spark)
    exports.export_page(scoring._export(spark, folder), 30, root)
    return spark.read.text(root).select(F.from_json("value", scoring.PAGE_FIELDS).alias("r")).select("r.*")


def panel_export(spark, folder):
    """A panel's monthly table written with its other outputs from one evaluation, read back by its own types."""
    root = shared_folder(spark)
    inputs = panel_checks._inputs(spark, folder)
    exports.export_panel(*inputs, root)
    kind = panel_checks.panel_monthly(spark, folder).schema
    back = spark.read.schema(kind).options(header=True, escape='"', multiLine=True).csv(f"{root}/monthly.csv")
    return back.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)
                         for f in kind.fields])


def panel_export_others(spark, folder):
    """Rows of a panel's other outputs, and cells that a sheet would take for a formula."""
    root = shared_folder(spark)
    exports.export_panel(*panel_checks._inputs(spark, folder), root)
    read = lambda name: spark.read.options(header=True, escape='"', multiLine=True).csv(f"{root}/{name}.csv")
    parts = [read(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("output"), "n") for n in ("summary", "coverage", "unresolved")]
    js = spark.read.json(f"{root}/summary.json").agg(F.count(F.lit(1)).alias("n")).select(F.lit("summary.json").alias("output"), "n")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(js)


PANEL_OTHERS = f"""
SELECT 'summary' AS output, COUNT(*) AS n FROM ({panel_checks.SUMMARY}) UNION ALL SELECT 'summary.json', COUNT(*) FROM ({panel_checks.SUMMARY})
UNION ALL SELECT 'coverage', COUNT(*) FROM ({panel_checks.PANEL_COVERAGE})
UNION ALL SELECT 'unresolved', COUNT(*) FROM ({duck(["v_footprint"], " SELECT * FROM v_footprint WHERE match_status <> 'verified'")})"""


def panel_table(spark, folder):
    """Coverage written through the panel sink, which checks it in the same pass, and read back with its manifest row."""
    root = shared_folder(spark)
    c = view(spark, folder, "v_coverage").select(
        "market", F.date_format("period", "yyyy-MM").alias("period"), F.col("days_expected").cast("string").alias("days_expected"),
        F.col("days_covered").cast("string").alias("days_covered"), "raw_refs")
    exports.write_panel_table(c, root, "constraint_coverage", STAMP, ["raw:DA", "raw:RT"])
    back = tables.read_exact_table(spark, f"{root}/normalized/constraint_coverage", fixed.COVERAGE_COLUMNS, "coverage")
    return back.join(spark.read.json(f"{root}/manifest").select("rows", "coverage", "note"))


PANEL_TABLE = duck(["v_coverage"], """
SELECT market, strftime(period, '%Y-%m') AS period, CAST(days_expected AS VARCHAR) AS days_expected, CAST(days_covered AS VARCHAR) AS days_covered,
       raw_refs, (SELECT COUNT(*) FROM v_coverage) AS rows, 'observed' AS coverage, 'raw:DA;raw:RT' AS note FROM v_coverage""")


def fresh_values(spark, folder):
    """When a derived value was last fed, and the map layer's version of that time."""
    o = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), *[
        F.max(F.when(F.col("o_orderstatus") == s, F.col("o_orderdate").cast("timestamp"))).alias(s) for s in ("F", "O", "P")])
    last = lineage.freshness(F.array("F", "O", "P"))
    return o.select("o_custkey", "n", numeric.layer_version(F.unix_millis(last)).alias("layer"),
                    numeric.hourly_time(F.date_format(last, fixed.HOURLY_TIME)).cast("string").alias("last"))


FRESH = """
SELECT o_custkey, COUNT(*) AS n, 'hifld_open_' || strftime(MAX(o_orderdate), '%Y-%m-%d') AS layer,
       strftime(MAX(o_orderdate), '%Y-%m-%d 00:00:00') AS last FROM orders GROUP BY 1"""


QUERIES = {
    "split_records": (split_records, SPLIT_RECORDS),
    "footprint_scan": (footprint_scan, FOOTPRINT_SCAN),
    "binding_scan": (binding_scan, hours.BINDING_TEXT),
    "dollar_scan": (dollar_scan, hours.QUERIES["dollar_text"][1]),
    "settled_scan": (settled_scan, hours.QUERIES["settled_text"][1]),
    "authority_scan": (authority_scan, AUTHORITY_SCAN),
    "queue_scan": (queue_scan, QUEUE_SCAN),
    "feature_scan": (feature_scan, FEATURE_SCAN),
    "manifest_fields": (manifest_fields, MANIFEST_FIELDS),
    "file_digests": (file_digests, FILE_DIGESTS),
    "verified_entries": (verified_entries, VERIFIED),
    "stamp_faults": (stamp_faults, STAMP_FAULTS),
    "raw_entries": (raw_entries, RAW_ENTRIES),
    "respondent_filings": (respondent_filings, RESPONDENTS),
    "run_exports": (run_exports, RUN_EXPORTS),
    "run_catalogue": (run_catalogue, "SELECT 'first' AS directory, 't' AS run_label, 'x' AS region, 'internal' AS mode, '2026-01-01' AS generated_at"),
    "page_export": (page_export, scoring.PAGE_ROWS),
    "panel_export": (panel_export, panel_checks.MONTHLY),
    "panel_export_others": (panel_export_others, PANEL_OTHERS),
    "panel_table": (panel_table, PANEL_TABLE),
    "fresh_values": (fresh_values, FRESH),
}
