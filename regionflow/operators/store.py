"""Tables that are computed once and kept in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. A session without the setting gets a local folder if it runs in one process, as
    tests do; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="regionflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """df, computed into the shared folder, so that every later use sees the same rows in the same partitions, whatever
    executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def filed(df: DataFrame, what: str) -> str:
    """The folder of Parquet files, in the shared folder, into which df is computed; they are not removed."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def spread(df: DataFrame) -> DataFrame:
    """df in a given number of partitions: for work that costs far more than its bytes tell, by which files are split and
    shuffled partitions merged. Rows are dealt in turn; by a key that they are already parted by, Spark would leave it out."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
