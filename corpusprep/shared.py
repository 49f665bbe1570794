"""Tables that steps of a job settle in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset: in local mode one of our own, on a cluster an error, for no
    temporary folder is seen by all executors."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="corpusprep-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """``df`` written and read again: what it was made with (partition ids, samples) stays as it is, and lost executors cost no rework."""
    path = f"{shared_dir(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch of whole texts; a batch holds one row at least.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes, so that a task holds few whole texts at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared one, once all that was made of it is written itself."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
