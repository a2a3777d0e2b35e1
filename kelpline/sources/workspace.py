"""Where intermediate tables go: the folder that the session names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. A session that runs in one process may leave it unset and gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="kelpline-")
    return _LOCAL[app]


def written(df: DataFrame, path: str, *partition_by: str, lookups: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a Parquet table at ``path``, read back; columns of ``lookups`` get bloom filters, by which row groups are skipped."""
    writer = df.write.partitionBy(*partition_by)
    for c in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
