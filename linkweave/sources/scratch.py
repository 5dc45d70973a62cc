"""Tables written in the folder that all executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset a temporary folder if all tasks run in the driver's process, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="linkweave-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _home(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/linkweave-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again; ``forget`` removes what a session wrote."""
    spark = df.sparkSession
    path = f"{_home(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Removes all that ``written`` left for this application; results that read it must have been written or collected before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_home(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
