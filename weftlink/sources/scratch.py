"""Tables written to the folder that all executors share, to cut lineage for good."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a temporary folder locally and the warehouse on a cluster."""
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # driver and executors are one process
        base = f"file://{tempfile.mkdtemp(prefix='weftlink-')}"
    else:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_weftlink_scratch"
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def written(df: DataFrame) -> DataFrame:
    """``df``, written once and read back."""
    path = f"{shared_folder(df.sparkSession)}/weftlink-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    return df.sparkSession.read.schema(schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
