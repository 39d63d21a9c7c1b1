"""Exact ranks and percentiles that never sort a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fluxsieve.session import shelve


def ordered_position(df: DataFrame, order: list[Column], group: list[str] = (),
                     name: str = "position", weight: str | None = None) -> DataFrame:
    """1-based position of each row in ``order`` within ``group``, over range partitions.

    Rows are range-partitioned on (group, order), so a group of any size is spread over as
    many partitions as it needs. Each partition numbers its own rows; the rows a group has in
    earlier partitions are added from a table with one row per (partition, group). With
    ``weight`` the position becomes the running total of that column, the row included.
    ``order`` has to be total for the result to be reproducible.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = list(group)
    keys = [F.col(g) for g in group] + list(order)
    laid = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # the upper bits of this id are the partition, the lower 33 its row number in order
    laid = shelve(laid.withColumn("_seq", F.monotonically_increasing_id()))
    laid = laid.withColumn("_part", F.shiftright("_seq", 33))
    size = F.sum(weight) if weight else F.count(F.lit(1))
    blocks = laid.groupBy("_part", *group).agg(size.alias("_n"), F.min("_seq").alias("_first"))
    # one row per partition and group: at most `parts` rows share a group here
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_part", *[F.col(g).alias(f"_g_{g}") for g in group], "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    match = F.col("l._part") == F.col("r._part")
    for g in group:
        match = match & F.col(f"l.{g}").eqNullSafe(F.col(f"r._g_{g}"))
    joined = laid.alias("l").join(offsets.alias("r"), match)
    if weight:
        run = Window.partitionBy("l._part", *[f"l.{g}" for g in group]).orderBy("_seq")
        position = F.col("_before") + F.sum(weight).over(run)
    else:
        position = F.col("_before") + F.col("_seq") - F.col("_first") + 1
    return joined.select(*[F.col(f"l.`{c}`") for c in df.columns], position.alias(name))


def exact_percentiles(df: DataFrame, value: str, points: list[float],
                      group: list[str] = ()) -> DataFrame:
    """Linear-interpolated percentiles of a column of any size.

    Equal values are counted first, then ranked with ``ordered_position``; each requested
    point reads the two values around rank p * (n - 1). One row per group and point:
    (group..., p, n, value).
    """
    group = list(group)
    counted = (df.where(F.col(value).isNotNull()).groupBy(*group, value)
               .agg(F.count(F.lit(1)).alias("_c")))
    ranked = ordered_position(counted, [F.col(value)], group, "_upto", weight="_c")
    total = ranked.groupBy(*group).agg(F.max("_upto").alias("n"))
    if group:
        sized = ranked.join(total, group)
    else:
        sized = ranked.withColumn("n", total.scalar())
    spots = sized.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in points])))
    target = F.col("p") * (F.col("n") - 1)
    low, high = F.floor(target) + 1, F.ceil(target) + 1

    def holds(rank):
        return (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_c") < rank)

    picked = (spots.where(holds(low) | holds(high)).groupBy(*group, "p", "n")
              .agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")))
    share = F.col("p") * (F.col("n") - 1) - F.floor(F.col("p") * (F.col("n") - 1))
    return picked.select(
        *group, "p", "n", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share).alias(value))


def most_frequent(df: DataFrame, keys: list[str], value: str, name: str | None = None) -> DataFrame:
    """Most frequent value per key, ties to the smallest; two-level counts, no per-key buffer."""
    return (
        df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
        .groupBy(*keys)
        .agg(F.min(F.struct((-F.col("_c")).alias("c"), F.col(value).alias("v"))).alias("_m"),
             F.count(F.lit(1)).alias(f"n_{name or value}"))
        .select(*keys, F.col("_m.v").alias(name or value), f"n_{name or value}")
    )
