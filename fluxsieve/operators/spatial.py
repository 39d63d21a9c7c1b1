"""Nearest-point and within-distance joins that stay linear under dense cells.

Both operators work on distinct locations and on a grid that is refined only where points
are dense, so neither many copies of one point nor a crowded cell produces all pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from fluxsieve import fixed
from fluxsieve.functions import geo
from fluxsieve.operators.graph import component_labels
from fluxsieve.session import cut

LEVELS = 14          # quartering a side 14 times leaves cells below 15 cm
LEAF_POINTS = 16     # a cell with no more points than this is not split further
SLACK = 1e-9         # relative slack when a bound, not a distance, decides
MOST_LEVELS = 52  # halvings of a cell before its side is below the spacing of doubles


def _box() -> Column:
    return F.struct(F.min("lat").alias("lat_lo"), F.max("lat").alias("lat_hi"),
                    F.min("lon").alias("lon_lo"), F.max("lon").alias("lon_hi"))


def _deep_cell(df: DataFrame) -> DataFrame:
    side = float(4 ** LEVELS)

    def index(share):
        return F.least(F.floor(share * F.lit(side)), F.lit(int(side) - 1)).cast("bigint")

    return df.withColumn("cx", index((F.col("lat") + 90) / 180)).withColumn(
        "cy", index((F.col("lon") + 180) / 360))


def _at(level: Column, deep: str) -> Column:
    return F.floor(F.col(deep) / F.pow(F.lit(4.0), F.lit(LEVELS) - level)).cast("bigint")


def _cell_tree(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links from each cell to its occupied children, and the points of every leaf cell.

    A cell whose parent holds at most LEAF_POINTS locations is not needed; a leaf links to
    itself so that candidates found early wait unchanged while others descend.
    """
    spread = points.withColumn("lvl", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    keyed = spread.select(
        "lvl", _at(F.col("lvl"), "cx").alias("x"), _at(F.col("lvl"), "cy").alias("y"),
        "lat", "lon")
    cells = cut(keyed.groupBy("lvl", "x", "y").agg(F.count(F.lit(1)).alias("n"), _box().alias("box")))
    leaf = (F.col("n") <= LEAF_POINTS) | (F.col("lvl") == LEVELS)
    parents = cells.where(~leaf).select(
        (F.col("lvl") + 1).alias("lvl"), F.col("x").alias("px"), F.col("y").alias("py"))
    children = cells.withColumn("px", F.floor(F.col("x") / 4).cast("bigint")).withColumn(
        "py", F.floor(F.col("y") / 4).cast("bigint")).join(parents, ["lvl", "px", "py"], "left_semi")
    alive = children.unionByName(cells.where("lvl = 0").withColumn("px", F.col("x")).withColumn(
        "py", F.col("y")))
    down = children.select(
        (F.col("lvl") - 1).alias("plvl"), "px", "py", "lvl", "x", "y", "box")
    stay = alive.where(leaf).select(
        F.col("lvl").alias("plvl"), F.col("x").alias("px"), F.col("y").alias("py"),
        "lvl", "x", "y", "box")
    links = down.unionByName(stay)
    leaves = alive.where(leaf).select("lvl", "x", "y")
    members = spread.select(
        "lvl", _at(F.col("lvl"), "cx").alias("x"), _at(F.col("lvl"), "cy").alias("y"),
        "lat", "lon", "idx").join(leaves, ["lvl", "x", "y"], "left_semi")
    return cut(links), members


def nearest(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Nearest ``dst`` (idx, lat, lon) for every ``src`` (src_id, lat, lon), by haversine.

    Candidate cells descend the grid level by level. A cell is dropped for a source when its
    lower distance bound exceeds the smallest upper bound found for that source, so the
    search is exact at any distance. Ties go to the lower idx.
    Result: src_id, idx, metres.
    """
    places = _deep_cell(dst.groupBy("lat", "lon").agg(F.min("idx").alias("idx")))
    links, members = _cell_tree(places)
    depth = links.agg(F.max("lvl")).first()[0]
    if depth is None:
        return src.select("src_id", F.lit(None).cast(dst.schema["idx"].dataType).alias("idx"),
                          F.lit(None).cast("double").alias("metres"))
    seekers = src.groupBy(F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon")).agg(
        F.lit(1).alias("_one")).drop("_one")
    found = seekers.withColumn("lvl", F.lit(0)).withColumn(
        "x", F.lit(0).cast("bigint")).withColumn("y", F.lit(0).cast("bigint"))
    # candidates of one location: a bounded handful of cells survive every level
    own = Window.partitionBy("s_lat", "s_lon")
    for level in range(max(int(depth), 1)):
        moved = found.select("s_lat", "s_lon", F.col("lvl").alias("plvl"), F.col("x").alias("px"),
                             F.col("y").alias("py")).join(links, ["plvl", "px", "py"])
        low, high = geo.box_bounds(F.col("s_lat"), F.col("s_lon"), F.col("box"))
        bounded = moved.withColumn("low", low).withColumn("high", high)
        found = (
            bounded.withColumn("best", F.min("high").over(own))
            .where(F.col("low") <= F.col("best") * (1 + SLACK) + 1e-24)
            .select("s_lat", "s_lon", "lvl", "x", "y")
        )
        if level % 4 == 3:
            found = cut(found)
    h = geo.half_chord(F.col("s_lat"), F.col("s_lon"), F.col("lat"), F.col("lon"))
    best = (
        found.join(members, ["lvl", "x", "y"]).withColumn("h", h)
        .groupBy("s_lat", "s_lon").agg(F.min(F.struct("h", "idx")).alias("m"))
    )
    hit = (F.col("src.lat") == F.col("b.s_lat")) & (F.col("src.lon") == F.col("b.s_lon"))
    return src.alias("src").join(best.alias("b"), hit).select(
        "src.src_id", F.col("b.m.idx").alias("idx"), geo.chord_metres(F.col("b.m.h")).alias("metres"))


def _box_pair_bounds(a: Column, b: Column) -> tuple[Column, Column]:
    def clear(lo, hi):
        return F.greatest(F.lit(0.0), b[lo] - a[hi], a[lo] - b[hi])

    def reach(lo, hi):
        return F.greatest(F.abs(b[hi] - a[lo]), F.abs(a[hi] - b[lo]))

    def cosines(box):
        lo, hi = F.cos(F.radians(box["lat_lo"])), F.cos(F.radians(box["lat_hi"]))
        top = F.when((box["lat_lo"] <= 0) & (box["lat_hi"] >= 0), F.lit(1.0)).otherwise(
            F.greatest(lo, hi))
        return F.least(lo, hi), top

    def square(deg):
        return F.pow(F.sin(F.radians(deg) / 2), 2)

    (a_lo, a_hi), (b_lo, b_hi) = cosines(a), cosines(b)
    lower = square(clear("lat_lo", "lat_hi")) + a_lo * b_lo * square(clear("lon_lo", "lon_hi"))
    upper = square(reach("lat_lo", "lat_hi")) + a_hi * b_hi * square(
        F.least(F.lit(180.0), reach("lon_lo", "lon_hi")))
    return lower, upper


def within_links(points: DataFrame, metres: float) -> DataFrame:
    """Edges (a, b) whose connected components are the single-linkage clusters of ``points``
    (id, lat, lon) at the given distance.

    Grid cells have a diagonal below the distance, so points of one cell link to the cell's
    smallest id. Two neighbouring cells need one link at most: their boxes are compared, and
    only undecided pairs are split further, down to single points if need be.
    """
    places = points.groupBy("lat", "lon").agg(F.min("id").alias("id"))
    size = math.degrees(metres / fixed.EARTH_RADIUS_M) / math.sqrt(2) * (1 - 1e-6)
    top = places.agg(F.max(F.abs(F.col("lat")))).first()[0]
    if top is None:
        return points.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    reach = math.ceil(math.sqrt(2) / math.cos(math.radians(min(top + 2 * size, 89.0)))) + 1

    def cells(level):
        step = size / 2 ** level
        return places.groupBy(
            F.floor(F.col("lat") / F.lit(step)).alias("x"), F.floor(F.col("lon") / F.lit(step)).alias("y")
        ).agg(_box().alias("box"), F.count(F.lit(1)).alias("n"), F.min("id").alias("rep"))

    ground = cut(cells(0))
    offsets = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
        for i in range(0, 3) for j in range(-reach, reach + 1) if i > 0 or j > 0])
    left = ground.select(
        F.col("rep").alias("a0"), F.col("x").alias("ax"), F.col("y").alias("ay"),
        F.col("box").alias("abox"), F.col("n").alias("an"), F.explode(offsets).alias("o")
    ).withColumn("bx", F.col("ax") + F.col("o.i")).withColumn("by", F.col("ay") + F.col("o.j"))
    right = ground.select(
        F.col("rep").alias("b0"), F.col("x").alias("bx"), F.col("y").alias("by"),
        F.col("box").alias("bbox"), F.col("n").alias("bn"))
    open_pairs = left.drop("o").join(right, ["bx", "by"])
    limit = math.sin(metres / (2 * fixed.EARTH_RADIUS_M)) ** 2
    decided = []
    for level in range(1, MOST_LEVELS):
        low, high = _box_pair_bounds(F.col("abox"), F.col("bbox"))
        single = (F.col("an") == 1) & (F.col("bn") == 1)
        exact = geo.haversine_m(F.col("abox.lat_lo"), F.col("abox.lon_lo"),
                                F.col("bbox.lat_lo"), F.col("bbox.lon_lo")) <= metres
        verdict = F.when(single, exact).when(high <= limit * (1 - SLACK), True).when(
            low > limit * (1 + SLACK), False)
        judged = cut(open_pairs.withColumn("near", verdict).where("near is null or near"))
        linked = judged.where("near").select("a0", "b0").distinct()
        decided.append(linked)
        waiting = judged.where("near is null").join(linked, ["a0", "b0"], "left_anti")
        if waiting.isEmpty():
            break
        if level == MOST_LEVELS - 1:
            raise RuntimeError("places closer than doubles can tell apart at this distance; none is decided silently")
        fine = cells(level)

        def child(prefix):
            return fine.select(
                F.floor(F.col("x") / 2).alias(f"{prefix}x"), F.floor(F.col("y") / 2).alias(f"{prefix}y"),
                F.col("x").alias(f"{prefix}x2"), F.col("y").alias(f"{prefix}y2"),
                F.col("box").alias(f"{prefix}box"), F.col("n").alias(f"{prefix}n"))

        open_pairs = (
            waiting.select("a0", "b0", "ax", "ay", "bx", "by")
            .join(child("a"), ["ax", "ay"]).join(child("b"), ["bx", "by"])
            .select("a0", "b0", F.col("ax2").alias("ax"), F.col("ay2").alias("ay"), "abox", "an",
                    F.col("bx2").alias("bx"), F.col("by2").alias("by"), "bbox", "bn"))
    between = decided[0]
    for more in decided[1:]:
        between = between.unionByName(more)
    step = F.lit(size)
    inside = points.select(
        "id", F.floor(F.col("lat") / step).alias("x"), F.floor(F.col("lon") / step).alias("y")
    ).join(ground.select("x", "y", "rep"), ["x", "y"]).where("id <> rep").select(
        F.col("id").alias("a"), F.col("rep").alias("b"))
    return inside.unionByName(between.select(F.col("a0").alias("a"), F.col("b0").alias("b")))


def snap(points: DataFrame, metres: float) -> DataFrame:
    """Cluster of each point (id, lat, lon): the smallest id it is chained to within the
    distance. Result: id, cluster."""
    labels = component_labels(within_links(points, metres))
    return points.select("id").join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("label", "id").alias("cluster"))


def cluster_centres(points: DataFrame, clusters: DataFrame) -> DataFrame:
    """Centroid, member count and widest member offset in metres per cluster."""
    member = points.join(clusters, "id")
    centre = member.groupBy("cluster").agg(
        F.avg("lat").alias("c_lat"), F.avg("lon").alias("c_lon"), F.count(F.lit(1)).alias("members"))
    offset = geo.haversine_m(F.col("c_lat"), F.col("c_lon"), F.col("lat"), F.col("lon"))
    radius = member.join(centre, "cluster").groupBy("cluster").agg(F.max(offset).alias("radius_m"))
    return centre.join(radius, "cluster").select(
        "cluster", F.col("c_lat").alias("lat"), F.col("c_lon").alias("lon"), "members", "radius_m")


def attach_generation(plants: DataFrame, buses: DataFrame, max_metres: float) -> DataFrame:
    """Capacity and plant count per bus from plants whose nearest bus is close enough.

    ``plants``: plant_id, lat, lon, capacity_mw. ``buses``: bus_id, idx, lat, lon.
    The row with a null bus_id holds what could not be attached.
    """
    near = nearest(plants.select(F.col("plant_id").alias("src_id"), "lat", "lon"),
                   buses.select("idx", "lat", "lon"))
    return (
        plants.join(near.withColumnRenamed("src_id", "plant_id"), "plant_id")
        .withColumn("idx", F.when(F.col("metres") <= max_metres, F.col("idx")))
        .groupBy("idx").agg(F.sum(F.col("capacity_mw").cast("decimal(20,6)")).cast("double").alias("gen_mw"),
                            F.count(F.lit(1)).alias("n_plants"))
        .join(buses.select("idx", "bus_id"), "idx", "left").select("bus_id", "gen_mw", "n_plants")
    )


def endpoint_footprint(lines: DataFrame, labels: DataFrame, home: str) -> DataFrame:
    """Whether both, one or neither end of a line carries the home label.

    ``labels``: bus, area.
    """
    flag = (F.col("area") == home).cast("int")
    a = labels.select(F.col("bus").alias("from_bus"), flag.alias("_a"))
    b = labels.select(F.col("bus").alias("to_bus"), flag.alias("_b"))
    inside = F.coalesce("_a", F.lit(0)) + F.coalesce("_b", F.lit(0))
    return lines.join(a, "from_bus", "left").join(b, "to_bus", "left").withColumn(
        "membership", F.when(inside == 2, "kept").when(inside == 1, "seam").otherwise("foreign")
    ).drop("_a", "_b")
