"""Session settings, reliable lineage cuts and size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE split a hot join key even where that costs another exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # files of a finished execution go at once, not when the driver's heap is next collected; results are cut or written
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; cluster sizing stays the caller's."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below spark.checkpoint.dir, which the driver and all executors reach."""
    _ensure_checkpoint_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="fluxsieve-checkpoint-")
    context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the reliable checkpoint folder and drop its lineage.

    The result survives the loss of any executor, and plans built in a loop stay short.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shelve(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Like ``cut``, for rows that are many or wide: files are compressed, later plans read only the columns they use and
    know the true size. Neither partitioning nor order is kept.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def shelved(df: DataFrame) -> Iterator[DataFrame]:
    """``shelve`` for the length of a block: the files go at its end, so what is made from them has to be kept by then."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, reading no more than that many plus one."""
    return df.limit(rows + 1).count() <= rows
