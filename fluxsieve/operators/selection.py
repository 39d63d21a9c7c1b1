"""The k-th row of each group in a descending order, found by counting instead of sorting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fluxsieve.operators.ranking import ordered_position
from fluxsieve.session import cut

#: Classes of one counting round, and the rows that are few enough to be put in order.
CLASSES, FEW = 1024, 10_000


def kth_rows(df: DataFrame, value: str, tie: str, wanted: DataFrame, group: list[str]) -> DataFrame:
    """group, k, value, tie of the row at place k in the order (value descending, tie ascending) of its group.

    ``wanted`` has the group's columns and k, a few rows a group and few groups (settings bound them, so ranges are
    broadcast and the rows stay where they are); where a group has fewer than k rows its last row is
    returned, and groups without rows are left out. Null values take no part. Each round divides the range
    that holds place k into ``CLASSES`` equal classes and counts rows per class; counts are combined on the
    map side, so no round shuffles rows. A round puts the least and the greatest value of a range into
    different classes, so ranges shrink until they hold one value or ``FEW`` rows. Only those rows are put in order,
    over range partitions; where all of them are wanted, their last row is an aggregate.
    """
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"), F.col(tie).alias("_t"))
    whole = rows.groupBy(*group).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    state = cut(wanted.select(*group, "k").distinct().join(whole, group).select(
        *group, "k", "_lo", "_hi", F.lit(0).cast("long").alias("_above"), "_n"))
    spot = [*group, "k"]
    before = Window.partitionBy(*spot).orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    place = F.least(F.col("k"), F.col("_all"))
    sized = cut(state.select(*spot, F.col("_n").alias("_all")))
    wide = (F.col("_hi") > F.col("_lo")) & (F.col("_n") > FEW)
    while not (open_ := state.where(wide)).isEmpty():
        # halves, so that the width of a range never overflows
        share = (F.col("_hi") / 2 - F.col("_v") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        number = F.least(F.floor(share * CLASSES), F.lit(CLASSES - 1))
        # places whose ranges are still the same are counted once
        span = [*group, "_lo", "_hi"]
        counted = within(rows, open_.select(*span).distinct(), group).groupBy(*span, number.alias("_class")).agg(
            F.min("_v").alias("_least"), F.max("_v").alias("_most"), F.count(F.lit(1)).alias("_many"))
        # at most CLASSES rows share a spot here
        split = open_.join(counted, span).select(
            *spot, "_above", "_class", F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), F.col("_many").alias("_n"))
        placed = split.withColumn("_above", F.col("_above") + F.coalesce(F.sum("_n").over(before), F.lit(0)))
        holds = placed.join(sized, spot).where((F.col("_above") < place) & (place <= F.col("_above") + F.col("_n")))
        state = cut(state.where(~wide).unionByName(holds.select(*state.columns)))
    left = state.join(sized, spot).withColumn("_place", place - F.col("_above"))
    last = within(rows, left.where(F.col("_place") == F.col("_n")), group).groupBy(*spot).agg(
        F.max(F.struct((-F.col("_v")).alias("v"), F.col("_t").alias("t"))).alias("_last")).select(
        *spot, (-F.col("_last.v")).alias(value), F.col("_last.t").alias(tie))
    some = within(rows, left.where(F.col("_place") < F.col("_n")), group).select(*spot, "_v", "_t", "_place")
    found = ordered_position(some, [F.col("_v").desc(), F.col("_t")], spot, "_own").where(
        F.col("_own") == F.col("_place")).select(*spot, F.col("_v").alias(value), F.col("_t").alias(tie))
    return last.unionByName(found)


def within(rows: DataFrame, ranges: DataFrame, group: list[str]) -> DataFrame:
    """The rows whose value lies in a range of their group; a row may lie in the ranges of several places."""
    return rows.join(F.broadcast(ranges), group).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def leads(value: Column, tie: Column, last_value: Column, last_tie: Column) -> Column:
    """Whether a row stands at or before the given last row in the order (value descending, tie ascending)."""
    return (value > last_value) | ((value == last_value) & (tie <= last_tie))
