"""Intermediate tables in a folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the context's checkpoint folder; where neither is
    set, a folder in the warehouse, which is shared as well and is cleared when
    the driver ends. Never a folder of one machine's own."""
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{context.applicationId}"
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the
    lineage, survives lost executors and gives later plans real sizes."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
