"""Tables in the folder that the driver and every executor see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session without that setting (tests)
    gets a temporary folder; elsewhere a missing setting is an error, because a machine-local folder
    would be invisible to the other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="chainframe-")
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/chainframe/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: computed once, lineage cut,
    and nothing is lost with an executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
