"""Network assembly: labels from the nearest plant, footprint, the largest connected piece, bus ids and counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from fluxsieve.operators import graph, spatial
from fluxsieve.operators.ranking import ordered_position
from fluxsieve.session import cut


@dataclass
class Assembly:
    lines: DataFrame   # every line that is no loop, with state: kept, island, seam or foreign
    buses: DataFrame   # buses of the kept network: bus, bus_id, area, metres
    counts: DataFrame  # state, lines, buses, miles


def label_buses(buses: DataFrame, plants: DataFrame) -> DataFrame:
    """Area of each bus: that of its nearest plant with an area, with the distance in metres.

    ``buses``: bus, lat, lon. ``plants``: idx, lat, lon, area (null: not used).
    """
    pool = plants.where("area IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
    near = spatial.nearest(buses.select(F.col("bus").alias("src_id"), "lat", "lon"), pool.select("idx", "lat", "lon"))
    return near.join(pool.select("idx", "area"), "idx").select(F.col("src_id").alias("bus"), "area", "metres")


def assemble(lines: DataFrame, buses: DataFrame, plants: DataFrame, home: str) -> Assembly:
    """Keep the largest connected piece of the lines with both ends at home, and account for all others.

    ``lines``: line_id, from_bus, to_bus, length_mi. Pieces of one size rank by their smallest bus; bus ids run
    by latitude, longitude and bus.
    """
    labels = cut(label_buses(buses, plants))
    placed = cut(spatial.endpoint_footprint(graph.without_loops(lines), labels.select("bus", "area"), home))
    inside = placed.where("membership = 'kept'")
    ends = F.explode(F.array("from_bus", "to_bus")).alias("node")
    nodes = inside.select(ends).distinct().select("node", F.col("node").alias("ord"))
    pieces = cut(graph.components(inside.select(F.col("from_bus").alias("a"), F.col("to_bus").alias("b")), nodes))
    piece = pieces.select(F.col("node").alias("from_bus"), (F.col("rank") == 1).alias("_main"))
    state = F.when(F.col("membership") != "kept", F.col("membership")).when(F.col("_main"), "kept").otherwise("island")
    outside = placed.where("membership <> 'kept'").withColumn("_main", F.lit(False))
    stated = cut(inside.join(piece, "from_bus").unionByName(outside).withColumn("state", state).drop("_main", "membership"))
    used = pieces.where("rank = 1").select(F.col("node").alias("bus")).join(buses, "bus")
    ordered = ordered_position(used, [F.round("lat", 6), F.round("lon", 6), F.col("bus")], name="n")
    numbered = ordered.select("bus", F.concat(F.lit("B"), F.col("n").cast("string")).alias("bus_id")).join(labels, "bus")
    own = F.when(F.col("rank") == 1, "kept").otherwise("island")
    bus_counts = pieces.groupBy(own.alias("state")).agg(F.count(F.lit(1)).alias("buses"))
    counts = stated.groupBy("state").agg(
        F.count(F.lit(1)).alias("lines"),
        F.round(F.sum(F.col("length_mi").cast("decimal(24,6)")).cast("double"), 1).alias("miles")).join(
        bus_counts, "state", "left").select("state", "lines", F.coalesce("buses", F.lit(0)).alias("buses"), "miles")
    return Assembly(stated, numbered, counts)
