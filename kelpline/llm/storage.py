"""Intermediate tables in the shared folder that the session names.

Executors can be lost at any time and share no local folder, so anything that is read twice is
written as Parquet below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kelpline.sources.workspace import shared_dir

_WRITTEN: list[str] = []
_TABLES: list[str] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of the written table: recovery re-reads it, it never recomputes."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kelpline/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """As ``materialise``, bucketed by ``key`` so that joins on it read the table where it lies."""
    spark = df.sparkSession
    table = f"kelpline_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/kelpline/{table}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(table)
    _WRITTEN.append(path)
    _TABLES.append(table)
    return spark.table(table)


def release(spark: SparkSession) -> None:
    """Delete every table that this session has written; results that still read them become invalid."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)
