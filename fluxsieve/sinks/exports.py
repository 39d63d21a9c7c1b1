"""Table, run and panel sinks. Every sink checks first and writes through Spark writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from fluxsieve import fixed
from fluxsieve.functions import text
from fluxsieve.operators import validation
from fluxsieve.plans import panel
from fluxsieve.session import cut
from fluxsieve.sources.digests import folder_digests

#: A quote inside a cell is doubled, so cells with quotes, commas and line breaks read back as they were.
CSV = {"header": True, "escape": '"', "quoteAll": False, "emptyValue": "", "nullValue": "",
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def sheet_safe_rows(df: DataFrame) -> DataFrame:
    """Text columns with formula-like cells quoted; other types unchanged."""
    return df.select(*[
        text.sheet_safe(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.simpleString() == "string"
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_table(df: DataFrame, root: str, name: str, order: list[str], stamp: dict, *,
                coverage: str = "observed", note: str = "", contributors: list[dict] | None = None,
                column_sources: dict | None = None, files: int | None = None) -> None:
    """Write a normalized table in key order and append its manifest row.

    ``files`` fixes the file count for small tables; large ones keep one file per sorted range.
    Rows are counted while they are written.
    """
    if coverage not in fixed.COVERAGE_LEVELS:
        raise validation.Refused(f"coverage must be one of {fixed.COVERAGE_LEVELS}")
    spark = df.sparkSession
    target = f"{root}/normalized/{name}"
    laid, counted = df.orderBy(*order), Observation()
    (laid.coalesce(files) if files else laid).observe(counted, F.count(F.lit(1)).alias("rows")).write.mode(
        "overwrite").options(**CSV).csv(target)
    rows = counted.get["rows"]
    if rows == 0 and coverage == "observed":
        coverage = "unobserved"
    append_manifest(spark, root, name, stamp, rows, coverage, note, contributors or [], column_sources or {})


def append_manifest(spark: SparkSession, root: str, name: str, stamp: dict, rows: int, coverage: str, note: str,
                    contributors: list[dict], column_sources: dict) -> None:
    stamp_type = "struct<source:string,source_version:string,retrieved_at:string>"
    entry = spark.createDataFrame(
        [(name, stamp["source"], stamp["source_version"], stamp["retrieved_at"], rows, coverage, note,
          [(c["source"], c["source_version"], c["retrieved_at"]) for c in contributors],
          {k: (c["source"], c["source_version"], c["retrieved_at"]) for k, c in column_sources.items()})],
        "table string, source string, source_version string, retrieved_at string, rows bigint, coverage string, "
        f"note string, contributors array<{stamp_type}>, column_sources map<string,{stamp_type}>")
    entry.write.mode("append").json(f"{root}/manifest")


def write_panel_table(df: DataFrame, root: str, name: str, stamp: dict, derived_from: list[str]) -> None:
    """Panel table sink: the contract is checked before anything is written to its place, in one pass over the input."""
    checks = {"constraint_history": (validation.history_rules, ["constraint_id", "market", "period"]),
              "constraint_coverage": (validation.coverage_rules, ["market", "period"])}
    if name not in checks or not derived_from:
        raise validation.Refused(f"{name} is not a panel table or names no raw inputs")
    rules, order = checks[name]
    held = validation.settled(df, rules(), name)
    validation.require_none(validation.duplicate_keys(held, order), f"{name}, repeated keys")
    write_table(held, root, name, order, {**stamp}, note=";".join(derived_from))


def export_scores(rows: DataFrame, corridors: DataFrame, members: DataFrame, folder: str) -> None:
    """Ranked flowgates as JSON, CSV and Parquet; corridors and their members as JSON."""
    ordered = cut(rows.orderBy("rank"))  # worked out once for all outputs
    ordered.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/scores.json")
    sheet_safe_rows(ordered).write.mode("overwrite").options(**CSV).csv(f"{folder}/scores.csv")
    ordered.write.mode("overwrite").parquet(f"{folder}/scores.parquet")
    corridors.orderBy("corridor_rank").write.mode("overwrite").option("ignoreNullFields", False).json(
        f"{folder}/shortlist.json")
    members.write.mode("overwrite").json(f"{folder}/members.json")


def json_rows_to_parquet(spark: SparkSession, source: str, schema, target: str) -> None:
    """JSON lines to columns with a declared schema, so nothing is inferred."""
    spark.read.schema(schema).json(source).write.mode("overwrite").parquet(target)


def output_digests(spark: SparkSession, folder: str, outputs: list[str]) -> DataFrame:
    """(path relative to the folder, sha256) of every part file of the named outputs."""
    of = F.split("relative", "/")
    return folder_digests(spark, folder).where((F.size(of) == 2) & of[0].isin(*outputs) & of[1].startswith("part-")).select(
        F.col("relative").alias("path"), "sha256")


def write_run_manifest(registry: DataFrame, folder: str, outputs: list[str], *, run_label: str, region: str,
                       mode: str, generated_at: str, scoring: dict) -> None:
    """One JSON row: settings, source pins and a digest per written file."""
    import json

    spark = registry.sparkSession
    # a registry is a short list and a run writes a bounded number of part files
    pins = registry.agg(F.map_from_entries(F.collect_list(F.struct("source", F.struct(
        "source_version", "publishable"))))).scalar()
    digests = output_digests(spark, folder, outputs).agg(
        F.map_from_entries(F.collect_list(F.struct("path", "sha256")))).scalar()
    row = spark.range(1).select(
        F.lit(1).alias("schema_version"), F.lit(run_label).alias("run_label"), F.lit(region).alias("region"),
        F.lit(mode).alias("mode"), F.lit(generated_at).alias("generated_at"),
        F.lit(json.dumps(scoring, sort_keys=True)).alias("scoring"), pins.alias("sources"), digests.alias("outputs"))
    text_row = row.select(F.to_json(F.struct("*")).alias("value"))
    _write_single_text(text_row, f"{folder}/run_manifest.json")


def _write_single_text(df: DataFrame, path: str) -> None:
    """Write one text row to exactly ``path`` through the session's file system."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(df.first()["value"].encode("utf-8")))
    stream.close()


def export_page(rows: DataFrame, k: int, folder: str) -> None:
    from fluxsieve.plans.corridors import page_rows

    page_rows(rows, k).orderBy("rank").select(F.col("row_json").alias("value")).write.mode("overwrite").text(folder)


def export_panel(footprint: DataFrame, history: DataFrame, coverage: DataFrame, folder: str,
                 start=None, end=None) -> None:
    """Summary, monthly, coverage and unresolved tables as CSV, the summary as JSON too."""
    cells = cut(panel.panel_cells(footprint, history, coverage, start, end))  # worked out once for all outputs
    summary = cut(panel.panel_order(panel.panel_summary(cells, footprint, history)))
    parts = {"summary": summary, "monthly": panel.monthly_rows(cells).orderBy("constraint_id", "market", "period"),
             "coverage": panel.coverage_rows(coverage, start, end).orderBy("market", "period"),
             "unresolved": panel.unresolved(footprint)}
    for name, df in parts.items():
        sheet_safe_rows(df).write.mode("overwrite").options(**CSV).csv(f"{folder}/{name}.csv")
    summary.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/summary.json")


def refuse_blocked(blocked: DataFrame, what: str) -> None:
    """A shareable export stops here when any value rests on a source that may not be shared."""
    validation.require_none(blocked, f"{what} may not be shared")
