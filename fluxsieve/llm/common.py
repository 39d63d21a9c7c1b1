"""Helpers the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fluxsieve.session import prepare

#: White space of the contracts: space and the five controls from tab to carriage return.
WHITE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows and bytes of one Arrow batch: a task holds a few batches at most, whatever the texts' lengths.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20


def session(spark: SparkSession) -> SparkSession:
    """Runtime settings of the library, plus Arrow batches small enough for very long texts."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share.

    Only a local session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="fluxsieve-llm-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: later plans start from the files."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def as_row(df: DataFrame, *more: Column) -> DataFrame:
    """The whole input row as one column ``row``, so that no column of the input can clash with ours."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *more)


def identity() -> list[Column]:
    """What tells rows apart where ids may be null or repeated: the id and a hash of the text."""
    return [F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key")]


def only(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (id, text_key) is in ``keepers``, one each.

    ``keepers``: id, text_key, copies (rows of ``docs`` with that identity), one row per identity, so a
    hot id is split by AQE. Rows repeated with the same id and text come out once.
    """
    rows = as_row(docs, *identity()).alias("r")
    k = keepers.alias("k")
    found = rows.join(k, F.col("r.id").eqNullSafe(F.col("k.id")) & (F.col("r.text_key") == F.col("k.text_key"))).select(
        "r.row", "r.id", "r.text_key", "k.copies")
    once = found.where("copies = 1").select("row")
    again = found.where("copies > 1").groupBy("id", "text_key").agg(F.first("row").alias("row")).select("row")
    return once.unionByName(again).select("row.*")
