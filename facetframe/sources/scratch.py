"""Where intermediate tables and checkpoints go."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_written: dict[tuple[str, str], list[str]] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else one below the session's warehouse.

    Both are places that every executor reaches on a cluster; nothing goes to a temporary folder of
    one machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path through the file system that Spark itself uses for it."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(location, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table.

    The output before the previous one of the same name in this session is removed, so repeated
    calls do not fill the folder; the previous one stays for DataFrames that still read it.
    """
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/facetframe-{uuid4().hex}"
    kept = _written.setdefault((spark.sparkContext.applicationId, name), [])
    while len(kept) > 1:
        remove_path(spark, kept.pop(0))
    kept.append(root)
    return f"{root}/{name}"


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows written as Parquet in the shared folder and read back: the lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
