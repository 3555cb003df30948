"""Where jobs put what must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, also set as Spark's checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    and Spark runs on one machine, as in tests, is a temporary folder made.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not folder:
        current = context.getCheckpointDir()
        alone = context.master.startswith("local") and not context.master.startswith("local-cluster")
        if current and (alone or not current.startswith(("file:", "/"))):
            return current
        if not alone:
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="firmscope-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Bytes of rows that go to Python at once where rows are wide.
BATCH_BYTES = 1 << 23


def small_batches(spark: SparkSession) -> None:
    """Have the session hand wide rows to Python in Arrow batches of about ``BATCH_BYTES``, unless its user chose a size.

    Outside the heap every task holds its batch and the bytes that are sent, in
    buffers of up to twice their size: of Spark's 64 MB that is a quarter of a GB.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))


def pin(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    Needed where a value depends on how rows were split (partition numbers):
    a lost executor then rereads the same rows instead of splitting anew.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them from there, with their size known."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
