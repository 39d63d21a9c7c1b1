"""Exact dedup by heavy-hitter split (operator 1).

A Misra-Gries summary per partition finds the digests that hold a large share of all rows. Summaries are
merged by adding counters; of ``counters`` + 1 equal parts of the input, at most ``counters`` digests can
exceed one part, which bounds the broadcast, and every digest that holds more than two parts is among them.
Their exact winners (smallest id and count, combined on the map side) are broadcast and settle their rows
where they stand. All other digests, none of which holds more than two parts, meet in an ordinary shuffle: counted on the
map side, then joined, so that AQE can split what is still large.

Defined results: null text counts as empty; null ids rank last; a null id never beats another; rows repeated
with the same id and text all say ``kept`` in ``decisions`` and come out once in ``survivors``; an empty table
gives an empty result; columns of the input may have any names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fluxsieve.llm.common import WHITE, identity, only
from fluxsieve.session import cut

COUNTERS = 1000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def digests(docs: DataFrame) -> DataFrame:
    """id, text_key, digest (lower-case hex SHA-256 of the normalised text) of every row."""
    return docs.select(*identity(), F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256).alias("digest"))


def summary(keys: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Misra-Gries summaries of column ``digest``, added up over the partitions: digest, at_least."""

    def count(batches):
        held: dict[str, int] = {}
        for batch in batches:
            for pair in batch.column(0).value_counts():
                key, n = pair["values"].as_py(), pair["counts"].as_py()
                held[key] = held.get(key, 0) + n
            if len(held) > counters:
                floor = sorted(held.values(), reverse=True)[counters]
                held = {key: n - floor for key, n in held.items() if n > floor}
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(list(held), pa.string()), "at_least": pa.array(list(held.values()), pa.int64())})

    parts = keys.select("digest").mapInArrow(count, "digest string, at_least long")
    return parts.groupBy("digest").agg(F.sum("at_least").alias("at_least"))


def heavy(keys: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests with their exact winner: digest, keep_id, group_size."""
    part = keys.count() / (counters + 1)
    candidates = summary(keys, counters).where(F.col("at_least") > part).select("digest")
    return cut(keys.join(F.broadcast(candidates), "digest").groupBy("digest").agg(
        F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))


def decisions(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """id, text_key, digest, keep_id, group_size, kept of every row of ``docs``."""
    keys = cut(digests(docs))
    winners = heavy(keys, counters)
    marked = keys.join(F.broadcast(winners), "digest", "left")
    alone = marked.where(F.col("group_size").isNull()).select("id", "text_key", "digest")
    rest = alone.join(alone.groupBy("digest").agg(
        F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "digest").select(
        "id", "text_key", "digest", "keep_id", "group_size")
    hot = marked.where(F.col("group_size").isNotNull()).select(rest.columns)
    return hot.unionByName(rest).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def survivors(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, one for each digest, with all their columns."""
    kept = decisions(docs, counters).where("kept").groupBy("digest", "id", "text_key").agg(
        F.count(F.lit(1)).alias("copies"))
    one = kept.groupBy("digest").agg(F.min(F.struct("text_key", "id", "copies")).alias("k"))
    return only(docs, one.select("k.id", "k.text_key", "k.copies"))
