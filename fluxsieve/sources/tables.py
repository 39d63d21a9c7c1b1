"""Table and manifest scans with digest and contract checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fluxsieve import fixed
from fluxsieve.operators.validation import Refused, require_none
from fluxsieve.sources.digests import folder_digests
from fluxsieve.sources.records import MARK, read_split

STAMP = "source string, source_version string, retrieved_at string"
STAMP_FIELDS = ("source", "source_version", "retrieved_at")
TABLE_FIELDS = ("path", "sha256", "rows", "coverage", "note", "derived_from", "contributors", "column_sources")
MANIFEST_SCHEMA = (
    "schema_version int, revision int, "
    f"tables map<string, struct<{STAMP.replace(' string', ':string')}, path:string, sha256:string, "
    "rows:bigint, coverage:string, note:string, derived_from:array<string>, "
    "contributors:array<struct<source:string,source_version:string,retrieved_at:string>>, "
    "column_sources:map<string,struct<source:string,source_version:string,retrieved_at:string>>>>, "
    "raw map<string, struct<url:string,path:string,sha256:string,retrieved_at:string,bytes:bigint>>")


def read_text_table(spark: SparkSession, path: str | list[str], line_breaks: bool = True) -> DataFrame:
    """CSV with a header, every cell text, a blank cell is null.

    ``line_breaks``: cells may hold quoted line breaks; without them large files are split between tasks.
    """
    return spark.read.options(header=True, multiLine=line_breaks, escape='"', nullValue="\x00",
                              emptyValue="", inferSchema=False).csv(path)


def trimmed_headers(df: DataFrame) -> DataFrame:
    """Column names without byte-order mark and surrounding blanks."""
    return df.toDF(*[c.lstrip(MARK).strip() for c in df.columns])


def require_columns(df: DataFrame, names, what: str) -> DataFrame:
    lacking = [n for n in names if n not in df.columns]
    if lacking:
        raise Refused(f"{what} lacks columns {lacking}")
    return df


def read_exact_table(spark: SparkSession, path: str, names: tuple[str, ...], what: str) -> DataFrame:
    """CSV that must hold exactly these columns, in any order, on every row; files are split whatever their cells hold."""
    return read_split(spark, path, names, what, exactly=True).select(*names)


def read_footprint(spark: SparkSession, path: str) -> DataFrame:
    """Footprint CSV, trimmed; a byte-order mark on the first header is dropped."""
    df = read_exact_table(spark, path, fixed.FOOTPRINT_COLUMNS, "footprint")
    return df.select(*[F.trim(F.col(c)).alias(c) for c in df.columns])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot manifest as one row of maps; other schema versions are refused."""
    manifest = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
    bad = manifest.where((F.coalesce("schema_version", F.lit(0)) != 1) | F.col("tables").isNull()
                         | (F.col("revision") < 2))
    require_none(bad.select("schema_version", "revision"), f"manifest {path}")
    return manifest


def manifest_tables(manifest: DataFrame) -> DataFrame:
    """One row per table: path, digest, rows, coverage, note, raw inputs."""
    return manifest.select(F.explode("tables").alias("table", "t")).select(
        "table", "t.path", "t.sha256", "t.rows", F.coalesce("t.coverage", F.lit("observed")).alias("coverage"),
        F.coalesce("t.note", F.lit("")).alias("note"), "t.derived_from")


def manifest_stamps(manifest: DataFrame) -> DataFrame:
    """Every source stamp: (table, role, column, source, source_version, retrieved_at)."""
    t = manifest.select(F.explode("tables").alias("table", "t"))
    none = F.lit(None).cast("string").alias("column")
    whole = t.select("table", F.lit("table").alias("role"), none, "t.source", "t.source_version", "t.retrieved_at")
    extra = t.select("table", F.explode("t.contributors").alias("c")).select(
        "table", F.lit("contributor").alias("role"), none, "c.source", "c.source_version", "c.retrieved_at")
    column = t.select("table", F.explode("t.column_sources").alias("column", "c")).select(
        "table", F.lit("column").alias("role"), "column", "c.source", "c.source_version", "c.retrieved_at")
    return whole.unionByName(extra).unionByName(column).withColumnRenamed(
        "retrieved_at", "retrieved_at_text").withColumn(
        "retrieved_at", F.col("retrieved_at_text").try_cast("timestamp"))


def manifest_fields(manifests: DataFrame) -> DataFrame:
    """Fields of manifests that the fixed schema does not know: (manifest, table, role, column, field, value).

    ``manifests``: manifest, value (JSON text). Table entries, their contributors' stamps and their columns' stamps are
    taken apart as they are, so nothing is dropped because no schema names it. Texts that are no JSON have no fields.
    """
    known = ", ".join(f"'{n}'" for n in TABLE_FIELDS)
    stamp = ", ".join(f"'{n}'" for n in STAMP_FIELDS)
    return manifests.sparkSession.sql(f"""
        WITH m AS (SELECT manifest, try_parse_json(value) AS v FROM {{manifests}}),
        t AS (SELECT manifest, e.key AS table, e.value AS entry
              FROM m, LATERAL variant_explode_outer(try_variant_get(v, '$.tables', 'variant')) AS e WHERE e.key IS NOT NULL),
        part AS (SELECT manifest, table, 'table' AS role, CAST(NULL AS STRING) AS column, entry AS held FROM t
                 UNION ALL SELECT manifest, table, 'contributor', CAST(NULL AS STRING), c.value
                 FROM t, LATERAL variant_explode_outer(try_variant_get(entry, '$.contributors', 'variant')) AS c WHERE c.pos IS NOT NULL
                 UNION ALL SELECT manifest, table, 'column', c.key, c.value
                 FROM t, LATERAL variant_explode_outer(try_variant_get(entry, '$.column_sources', 'variant')) AS c WHERE c.key IS NOT NULL)
        SELECT manifest, table, role, column, f.key AS field, to_json(f.value) AS value
        FROM part, LATERAL variant_explode_outer(held) AS f
        WHERE f.key IS NOT NULL AND NOT (f.key IN ({stamp}) OR (role = 'table' AND f.key IN ({known})))""", manifests=manifests)


def manifest_raw(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.explode("raw").alias("key", "r")).select("key", "r.*")


def bad_coverage(tables: DataFrame) -> DataFrame:
    return tables.where(~F.col("coverage").isin(*fixed.COVERAGE_LEVELS)).select("table", "coverage")


def missing_tables(tables: DataFrame, required=fixed.SNAPSHOT_TABLES) -> DataFrame:
    """Required tables the manifest does not list."""
    wanted = tables.sparkSession.createDataFrame([(t,) for t in required], "table string")
    return wanted.join(tables.select("table"), "table", "left_anti")


def digest_failures(spark: SparkSession, root: str, entries: DataFrame, key: str) -> DataFrame:
    """Manifest entries whose file is missing (found is null) or does not hash to the recorded digest.

    ``entries``: key column, path (relative to root), sha256. Entries meet files by their whole relative path.
    """
    wanted = entries.select(key, F.col("path").alias("relative"), "sha256")
    found = folder_digests(spark, root).select("relative", F.col("sha256").alias("found"))
    return wanted.join(found, "relative", "left").where(
        ~F.col("sha256").eqNullSafe(F.col("found"))).select(key, "relative", "sha256", "found")


def read_verified(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """Text tables of a snapshot, read only after every digest matched the manifest."""
    tables = manifest_tables(read_manifest(spark, f"{root}/snapshot_manifest.json"))
    require_none(missing_tables(tables, names), "tables without a manifest entry")
    mine = tables.where(F.col("table").isin(*names))
    require_none(digest_failures(spark, root, mine, "table"), "snapshot digest")
    return {r["table"]: read_text_table(spark, f"{root}/{r['path']}")
            for r in mine.select("table", "path").collect()}


def run_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """Finished runs under a folder: (directory, run_label, region, mode, generated_at)."""
    schema = "run_label string, region string, mode string, generated_at string, outputs map<string,string>"
    found = spark.read.schema(schema).option("multiLine", True).json(f"{root}/*/run_manifest.json")
    return found.select(
        F.regexp_extract("_metadata.file_path", r"([^/]+)/run_manifest\.json$", 1).alias("directory"),
        "run_label", "region", "mode", "generated_at")


def read_run(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """A finished run's row sets, after each recorded output's digest was checked."""
    schema = "run_label string, mode string, outputs map<string,string>"
    manifest = spark.read.schema(schema).option("multiLine", True).json(f"{folder}/run_manifest.json")
    outputs = manifest.select(F.explode("outputs").alias("path", "sha256"))
    named = outputs.select(F.col("path").alias("output"), "path", "sha256")
    require_none(digest_failures(spark, folder, named, "output"), "run output digest")
    names = {r["path"].split("/")[0] for r in outputs.select("path").collect()}
    out = {}
    for name in sorted(names):
        stem, _, kind = name.rpartition(".")
        if kind in ("json", "parquet"):
            out.setdefault(stem, getattr(spark.read, kind)(f"{folder}/{name}"))
    for required in ("scores", "shortlist"):
        if required not in out:
            raise Refused(f"run {folder} has no {required}")
    return out


def release_table(spark: SparkSession, path: str) -> DataFrame:
    """Line filings of a published release, typed and with short names."""
    require_columns(spark.read.parquet(path), (
        "record_id", "utility_id_ferc1", "utility_name_ferc1", "report_year", "start_point", "end_point",
        "operating_voltage_kv", "transmission_line_length_miles",
        "transmission_line_and_structures_length_miles", "capex_total"), "release")

    def num(name, alias):
        return F.col(name).cast("double").alias(alias)

    return spark.read.parquet(path).select(
        "record_id", F.col("utility_id_ferc1").alias("utility_id"), F.col("utility_name_ferc1").alias("utility_name"),
        "report_year", "start_point", "end_point", num("operating_voltage_kv", "kv"),
        num("transmission_line_length_miles", "standalone_mi"),
        num("transmission_line_and_structures_length_miles", "aggregated_mi"), num("capex_total", "capex"))

