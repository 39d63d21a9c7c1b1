"""Connected components, neighbourhoods and node naming on edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from fluxsieve.operators.ranking import ordered_position
from fluxsieve.session import cut


#: Up to so many edges are contracted in one partition, and nothing is shuffled in any round; more are dealt out by their nodes.
FEW_EDGES = 1 << 16


def _held(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges`` (u, v) materialized, few of them in one partition, and a mark of the set, taken while it is written."""
    seen = Observation()
    held = cut(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
    mark = seen.get
    return held.coalesce(1) if mark["n"] <= FEW_EDGES else held, (mark["n"], mark["h"])


def _with_least(rows: DataFrame, key: str, value: str, few: bool) -> DataFrame:
    """``rows`` with ``m``, the smallest value of their key; a few rows stay where they are, as their minima are broadcast."""
    least = rows.groupBy(key).agg(F.min(value).alias("m"))
    return rows.join(F.broadcast(least) if few else least, key)


def component_labels(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node that has an edge: (node, label).

    Alternates the two star contractions of Kiveris et al. (2014) until nothing changes.
    A node with very many edges is only ever the key of a join against one row per node or
    of a min(), so a hub is split by AQE or combined before the shuffle. A contraction makes
    at most two edges of one, so edges are made distinct once a round.
    """
    pair = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars, mark = _held(pair.where("u <> v").distinct())
    while True:
        few = mark[0] <= FEW_EDGES
        both = stars.select(F.explode(F.array(
            F.struct(F.col("u").alias("x"), F.col("v").alias("y")),
            F.struct(F.col("v").alias("x"), F.col("u").alias("y")))).alias("e")).select("e.*")
        large = _with_least(both, "x", "y", few).where("y > x").select(F.col("y").alias("u"), F.least("m", "x").alias("v"))
        small = _with_least(large, "u", "v", few).select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select(
            "e.*").where("u <> v").distinct()
        before = mark
        stars, mark = _held(small)
        if mark == before:
            break
    roots = stars.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Component of every node, ranked by size; ties by the first node in input order.

    ``edges``: a, b. ``nodes``: node, ord. Result: node, label, size, rank.
    """
    labels = nodes.join(component_labels(edges), "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    groups = labels.groupBy("label").agg(
        F.count(F.lit(1)).alias("size"), F.min("ord").alias("first"))
    ranked = ordered_position(groups, [F.col("size").desc(), F.col("first")], name="rank")
    return labels.join(ranked, "label").select("node", "label", "size", "rank")


def without_loops(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("from_bus") != F.col("to_bus"))


def bus_degree(lines: DataFrame) -> DataFrame:
    """Number of line ends at each bus."""
    ends = F.explode(F.array("from_bus", "to_bus")).alias("bus")
    return lines.select(ends).groupBy("bus").agg(F.count(F.lit(1)).alias("degree"))


def radial_lines(lines: DataFrame) -> DataFrame:
    """Lines with a flag for a stub at either end."""
    degree = bus_degree(lines)
    a = degree.select(F.col("bus").alias("from_bus"), F.col("degree").alias("_a"))
    b = degree.select(F.col("bus").alias("to_bus"), F.col("degree").alias("_b"))
    return lines.join(a, "from_bus").join(b, "to_bus").withColumn(
        "radial", (F.col("_a") <= 1) | (F.col("_b") <= 1)).drop("_a", "_b")


def adjacency(lines: DataFrame) -> DataFrame:
    """Distinct directed neighbour pairs (bus, neighbour)."""
    pairs = F.explode(F.array(
        F.struct(F.col("from_bus").alias("bus"), F.col("to_bus").alias("neighbour")),
        F.struct(F.col("to_bus").alias("bus"), F.col("from_bus").alias("neighbour")))).alias("p")
    return lines.select(pairs).select("p.*").distinct()


def queue_near(lines: DataFrame, queue: DataFrame) -> DataFrame:
    """Queue megawatts at each line's ends and their direct neighbours: (line_id, mw, requests).

    Requests are summed per bus first, so a bus with very many requests is one row.
    """
    ends = lines.select("line_id", F.explode(F.array("from_bus", "to_bus")).alias("bus"))
    next_door = ends.join(adjacency(lines), "bus").select("line_id", F.col("neighbour").alias("bus"))
    reach = ends.unionByName(next_door).distinct()
    at_bus = queue.groupBy(F.col("near_bus").alias("bus")).agg(
        F.sum(F.col("mw").cast("decimal(20,6)")).alias("mw"), F.count(F.lit(1)).alias("requests"))
    return lines.select("line_id").join(
        reach.join(at_bus, "bus").groupBy("line_id").agg(
            F.sum("mw").cast("double").alias("mw"), F.sum("requests").alias("requests")),
        "line_id", "left").select(
        "line_id", F.coalesce("mw", F.lit(0.0)).alias("mw"),
        F.coalesce("requests", F.lit(0)).cast("bigint").alias("requests"))


# --- node names ---------------------------------------------------------------------

def _half_lines(lines: DataFrame) -> DataFrame:
    """Each line seen from each of its ends: line, bus, far, x, y."""
    return lines.select("line", F.col("a").alias("bus"), F.col("b").alias("far"), "x", "y").unionByName(
        lines.select("line", F.col("b").alias("bus"), F.col("a").alias("far"), "x", "y"))


def _offers(halves: DataFrame, oriented_only: bool) -> DataFrame:
    """Tokens each bus is offered and the number of distinct neighbours offering them.

    ``halves`` carries ``oriented`` (bool) and ``given`` (token for this end, may be null).
    """
    free = F.array() if oriented_only else F.array_distinct(F.array("x", "y"))
    tokens = F.when(F.col("oriented"), F.array("given")).otherwise(free.cast("array<string>"))
    return (
        halves.select("bus", "far", F.explode(tokens).alias("token")).where("token is not null")
        .groupBy("bus", "token").agg(F.countDistinct("far").alias("support"))
    )


def _shared(halves: DataFrame) -> DataFrame:
    """Buses whose best token has at least two neighbours and no rival: (bus, token, support)."""
    best = _offers(halves, False).groupBy("bus").agg(
        F.max(F.struct("support", "token")).alias("m"), F.max("support").alias("top"))
    ties = _offers(halves, False).join(best.select("bus", "top"), "bus").where(
        F.col("support") == F.col("top")).groupBy("bus").agg(F.count(F.lit(1)).alias("winners"))
    return best.join(ties, "bus").where("winners = 1 and top >= 2").select(
        "bus", F.col("m.token").alias("token"), F.col("top").alias("support"))


def _orient(halves: DataFrame, named: DataFrame) -> DataFrame:
    """Fix the tokens of lines that meet a newly named bus and carry its name."""
    hit = (
        halves.join(named.select(F.col("bus").alias("bus"), F.col("token").alias("name")), "bus")
        .where((~F.col("oriented")) & ((F.col("name").eqNullSafe(F.col("x")))
                                       | (F.col("name").eqNullSafe(F.col("y")))))
        .select("line", F.col("bus").alias("from_end"), F.col("name"),
                F.when(F.col("name").eqNullSafe(F.col("x")), F.col("y")).otherwise(F.col("x")).alias("other"))
    )
    return halves.join(hit, "line", "left").select(
        "line", "bus", "far", "x", "y",
        (F.col("oriented") | F.col("from_end").isNotNull()).alias("oriented"),
        F.when(F.col("oriented") | F.col("from_end").isNull(), F.col("given"))
        .when(F.col("bus") == F.col("from_end"), F.col("name")).otherwise(F.col("other")).alias("given"))


def _unblocked(pending: DataFrame, halves: DataFrame, priority: Column) -> DataFrame:
    """Pending buses with no pending neighbour of higher priority (smaller ``pri``)."""
    p = pending.withColumn("pri", priority)
    rivals = (
        halves.select("bus", "far").distinct()
        .join(p.select("bus", "pri"), "bus")
        .join(p.select(F.col("bus").alias("far"), F.col("pri").alias("far_pri")), "far")
        .where("far_pri < pri").select("bus").distinct()
    )
    return p.join(rivals, "bus", "left_anti").select("bus")


def name_buses(lines: DataFrame) -> DataFrame:
    """Bus names agreed by neighbours: (bus, token, basis).

    ``lines``: line, a, b (bus ids), x, y (name tokens, may be null; which end a token
    belongs to is unknown). A bus is named once a token comes from two distinct neighbours
    without a rival ('shared'); naming orients its lines, so each leaves its other token to
    the far end, and a bus whose oriented lines offer one single token takes it
    ('elimination').

    The order of naming matters, but a naming only changes what direct neighbours are
    offered. Each round therefore names every candidate that has no stronger candidate next
    to it, which gives the outcome of going through all candidates one by one.
    """
    halves = cut(_half_lines(lines).withColumn("oriented", F.lit(False)).withColumn(
        "given", F.lit(None).cast("string")))
    named: DataFrame | None = None

    def unnamed(df):
        return df if named is None else df.join(named.select("bus"), "bus", "left_anti")

    changed = True
    while changed:
        changed = False
        # strongest support first, then the smaller bus
        pending = cut(unnamed(_shared(halves)).select("bus", "support"))
        while not pending.isEmpty():
            turn = cut(_unblocked(pending, halves, F.struct((-F.col("support")).alias("s"), F.col("bus"))))
            fresh = cut(_shared(halves).join(turn, "bus").select("bus", "token", F.lit("shared").alias("basis")))
            if not fresh.isEmpty():
                changed = True
                halves = cut(_orient(halves, fresh))
                named = fresh if named is None else cut(named.unionByName(fresh))
            pending = cut(pending.join(turn, "bus", "left_anti"))
        # elimination in bus order; a bus with two offers can never take a name any more
        passed: DataFrame | None = None
        while True:
            counts = _offers(halves, True).groupBy("bus").agg(
                F.count(F.lit(1)).alias("n"), F.min("token").alias("token"))
            open_buses = unnamed(halves.select("bus").distinct())
            if passed is not None:
                open_buses = open_buses.join(passed, "bus", "left_anti")
            open_buses = cut(open_buses.join(counts, "bus", "left").where("n is null or n = 1"))
            single = open_buses.where("n = 1").select("bus", "token")
            if single.isEmpty():
                break
            waiting = _downstream(single.select("bus"), open_buses.select("bus"), halves)
            fresh = cut(single.join(waiting, "bus", "left_anti").select(
                "bus", "token", F.lit("elimination").alias("basis")))
            changed = True
            # an open line of a bus named now gives its smaller end an offer after its turn
            late = (halves.where(~F.col("oriented")).join(fresh.select("bus", "token"), "bus")
                    .where((F.col("token").eqNullSafe(F.col("x")) | F.col("token").eqNullSafe(F.col("y")))
                           & (F.col("far") < F.col("bus")))
                    .select(F.col("far").alias("bus")).distinct())
            passed = cut(late if passed is None else late.unionByName(passed).distinct())
            halves = cut(_orient(halves, fresh))
            named = fresh if named is None else cut(named.unionByName(fresh))
    if named is None:
        return lines.limit(0).select(F.col("a").alias("bus"), F.col("x").alias("token"),
                                     F.lit("").alias("basis"))
    return named


def _downstream(start: DataFrame, allowed: DataFrame, halves: DataFrame) -> DataFrame:
    """Buses that a naming at ``start`` could still reach later in the same pass: along open
    lines towards larger buses, through buses that may still be named."""
    steps = halves.where((~F.col("oriented")) & (F.col("far") > F.col("bus"))).select("bus", "far").distinct()
    steps = cut(steps.join(allowed.select(F.col("bus").alias("far")), "far", "left_semi"))
    reached = start.limit(0)
    frontier = start
    while True:
        more = cut(frontier.join(steps, "bus").select(F.col("far").alias("bus")).distinct()
                   .join(reached, "bus", "left_anti"))
        if more.isEmpty():
            return reached
        reached, frontier = reached.unionByName(more), more
