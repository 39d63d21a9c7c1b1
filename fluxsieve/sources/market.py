"""Scans of published market, authority, plant and map files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fluxsieve import fixed
from fluxsieve.functions import numeric, text
from fluxsieve.operators.filings import queue_requests
from fluxsieve.operators.validation import Refused, require_none, settled
from fluxsieve.session import cut
from fluxsieve.sources.records import MARK, read_split


def _trimmed(df: DataFrame) -> DataFrame:
    """Trimmed cells; a blank cell is the empty text, so that blanks group and join as equals."""
    return df.select(*[F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in df.columns])


def _by_header(spark: SparkSession, paths: str | list[str], columns, what: str) -> DataFrame:
    """The named columns of all files in one scan, trimmed, with each row's ``_file`` and place ``_at`` in it.

    Files may order their columns differently.
    """
    found = read_split(spark, paths, columns, what)
    return found.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in columns], "_file", "_at")


def binding_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Hourly binding rows of monthly files (or folders of part files) named ...yyyyMM.csv, with their file's month.

    Headers are trimmed, and files may order their columns differently.
    """
    stamp = F.regexp_extract("_file", r"(\d{6})\.csv(/[^/]*)?$", 1)
    month = F.to_date(F.concat(stamp, F.lit("01")), "yyyyMMdd")
    return _by_header(spark, paths, fixed.BINDING_COLUMNS, "binding rows").withColumn("file_month", month)


def other_month() -> Column:
    """Whether a row's hour-ending interval belongs to another month than its file."""
    return ~numeric.hour_month(numeric.market_time(F.col("Interval"))).eqNullSafe(F.col("file_month"))


def month_violations(rows: DataFrame) -> DataFrame:
    """Rows whose hour-ending interval belongs to another month than their file."""
    return rows.where(other_month()).select("Interval", "file_month")


def binding_hours(rows: DataFrame) -> DataFrame:
    """Binding rows in the shape of ``operators.rollups``, refused when a rule is broken; one pass does both."""
    usable = numeric.usable_constraint_name(F.col("Constraint Name"), F.col("Contingency Name"))
    held = settled(rows, {"interval in another month": other_month(), "unusable constraint name": ~usable}, "binding rows")
    place = F.col("_at") if "_at" in held.columns else F.monotonically_increasing_id()
    return held.select(
        F.col("Constraint Name").alias("name"), F.col("Contingency Name").alias("contingency"),
        F.col("Monitored Facility").alias("monitored"), F.col("Contingent Facility").alias("contingent"),
        F.col("Constraint Type").alias("kind"), F.col("State").alias("state"),
        F.col("Shadow Price").cast("double").alias("price"),
        numeric.market_time(F.col("GMTIntervalEnd")).alias("utc"), F.col("file_month").alias("month"),
        # file order inside a month; rows that come without a place are numbered as they are met
        F.struct(F.col("file_month"), place.alias("row")).alias("ord"))


def dollar_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Monthly congestion dollars; a row of another month than its file is refused."""
    rows = _by_header(spark, paths, fixed.DOLLAR_COLUMNS, "dollars")
    stamp = F.regexp_extract("_file", r"(\d{6})(?:_sample)?\.csv(/[^/]*)?$", 1)
    return dollar_fields(settled(rows, {"another month than the file's": F.col("Date") != stamp}, "dollars"))


def dollar_fields(rows: DataFrame) -> DataFrame:
    """Typed dollars from text columns."""
    return rows.select(
        F.to_date(F.concat("Date", F.lit("01")), "yyyyMMdd").alias("month"),
        F.col("Constraint Name").alias("name"), F.col("Contingency Name").alias("contingency"),
        F.col("Monitored Facility").alias("monitored"), F.col("Sum").cast("double").alias("amount"),
        (F.struct("_file", "_at") if "_at" in rows.columns else F.monotonically_increasing_id()).alias("ord"))


def settled_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Settled monthly collections: month, collected."""
    return settled_fields(_by_header(spark, paths, fixed.SETTLED_COLUMNS, "settled collections"))


def settled_fields(rows: DataFrame) -> DataFrame:
    """Typed collections from text columns."""
    return rows.select(
        F.to_date(F.concat(F.lit("01/"), "Month"), "dd/MM/yyyy").alias("month"),
        F.col("DA Collected").cast("double").alias("collected"))


def queue_file(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """Version date of a queue file's preamble line and its active requests.

    The preamble is the first line, the header the second. A folder of part files has both in every file, and the
    same date in all of them.
    """
    head = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", MARK, "").alias("value"),
        F.monotonically_increasing_id().alias("row")).groupBy("file").agg(F.min_by("value", "row").alias("value"))
    day = F.regexp_extract("value", r'^"?Last Updated On"?\s*,\s*"?([0-9/]+)', 1)
    days = [r["day"] for r in head.select(day.alias("day")).distinct().limit(2).collect()]
    if len(days) != 1 or not days[0]:
        raise Refused(f"{path} does not start with one 'Last Updated On' line")
    rows = read_split(spark, path, fixed.QUEUE_COLUMNS, path, skip=1)
    active = cut(queue_requests(_trimmed(rows.select(*fixed.QUEUE_COLUMNS))))
    doubled = active.groupBy("request_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or request_id = ''")
    require_none(doubled, "blank or repeated request id")
    month, of_month, year = (int(x) for x in days[0].split("/"))
    return f"spp_giq_{year:04d}-{month:02d}-{of_month:02d}", active


def authority_rows(spark: SparkSession, paths: str | list[str], authority: str, year: int) -> DataFrame:
    """Hourly rows of one authority and year over half-year files whose columns differ, in one scan."""
    needed = ("Balancing Authority", "UTC Time at End of Hour", "Data Date", "Demand (MW)")
    return authority_year(read_split(spark, paths, needed, "authority hours", others=True).drop("_file", "_at"), authority, year)


def authority_year(rows: DataFrame, authority: str, year: int) -> DataFrame:
    """Hours of one authority and year from published text columns; a repeated hour is refused. The input is read once."""
    rows = rows.where(
        (F.trim("Balancing Authority") == authority)
        & (F.year(F.to_date(F.trim("Data Date"), "MM/dd/yyyy")) == year))
    hours = cut(rows.withColumn("ba", F.lit(authority)).withColumn(
        "utc", numeric.hourly_time(F.trim("UTC Time at End of Hour"))))
    doubled = hours.groupBy("utc").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    require_none(doubled, f"duplicate hours of {authority}")
    return hours


def operating_plants(generators: DataFrame, plants: DataFrame, year: int) -> DataFrame:
    """Plants with operating capacity in a report year; location and area may be missing."""
    on = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    capacity = generators.where(
        (F.col("report_date") == on) & F.col("operational_status_code").isin(*fixed.OPERATING_CODES)
        & F.col("capacity_mw").isNotNull()
    ).groupBy("plant_id_eia").agg(
        F.sum(F.col("capacity_mw").cast("decimal(20,6)")).cast("double").alias("mw"),
        F.count(F.lit(1)).alias("n_generators")).where("mw > 0")
    places = plants.where(F.col("report_date") == on).select(
        "plant_id_eia", F.col("plant_name_eia").alias("plant_name"), F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
        text.blank_to_null(F.col("balancing_authority_code_eia")).alias("ba"))
    return capacity.join(places, "plant_id_eia", "left").select(
        "plant_id_eia", "plant_name", "lat", "lon", "ba", F.bround("mw", 3).alias("capacity_mw"), "n_generators")


def line_features(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Features of a GeoJSON collection in the shape of ``operators.filings``.

    Coordinates are parsed tolerantly: a malformed geometry gives null parts, which the
    classification counts as bad geometry.

    ``separator``: the text every feature begins with as the file writes it, such as ``{"type":"Feature",``. Then a file is
    cut into features by many tasks and no task holds a collection; otherwise a collection is one row. What does not parse
    as a feature is no feature.
    """
    if separator is None:
        schema = ("features array<struct<properties:map<string,string>, "
                  "geometry:struct<type:string,coordinates:string>>>")
        raw = spark.read.schema(schema).option("multiLine", True).json(path)
        each = raw.select(F.posexplode("features").alias("ord", "f")).select(
            "ord", F.col("f.properties").alias("p"), F.col("f.geometry.type").alias("shape"),
            F.col("f.geometry.coordinates").alias("coordinates"))
        wanted = lambda name: F.col("p")[name]
    else:
        cut_off = F.regexp_replace("value", r"(,\s*|\s*\][^\]}]*\}?\s*)$", "")  # what stands between features, or after the last
        each = spark.read.option("lineSep", separator).text(path).select(
            F.monotonically_increasing_id().alias("ord"),
            F.try_parse_json(F.concat(F.lit("{" + separator[separator.index("{") + 1:]), cut_off)).alias("f")).where(
            F.try_variant_get("f", "$.properties", "variant").isNotNull()).select(
            "ord", "f", F.try_variant_get("f", "$.geometry.type", "string").alias("shape"),
            F.try_variant_get("f", "$.geometry.coordinates", "string").alias("coordinates"))
        wanted = lambda name: F.try_variant_get("f", f"$.properties.{name}", "string")
    return parse_geometry(each).select(
        "ord", wanted("ID").alias("hid"), wanted("VOLTAGE").try_cast("double").alias("kv"),
        wanted("STATUS").alias("status"), wanted("TYPE").alias("kind"), wanted("OWNER").alias("owner"),
        wanted("SUB_1").alias("sub_1"), wanted("SUB_2").alias("sub_2"), wanted("INFERRED").alias("inferred"), "parts")


def parse_geometry(df: DataFrame) -> DataFrame:
    """Add ``parts`` (arrays of lat/lon points) from columns shape and coordinates (JSON text)."""
    line = F.from_json("coordinates", "array<array<double>>")
    many = F.from_json("coordinates", "array<array<array<double>>>")
    parts = F.when(F.col("shape") == "LineString", F.array(line)).when(F.col("shape") == "MultiLineString", many)

    def good(xy):
        return F.coalesce((F.size(xy) >= 2) & (F.abs(xy[0]) <= 180) & (F.abs(xy[1]) <= 90), F.lit(False))

    sound = F.forall(parts, lambda p: p.isNotNull() & F.forall(p, good))
    points = F.transform(parts, lambda p: F.transform(
        p, lambda xy: F.struct(xy[1].alias("lat"), xy[0].alias("lon"))))
    return df.withColumn("parts", F.when(F.coalesce(sound, F.lit(False)), points))
