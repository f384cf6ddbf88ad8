"""Scratch tables: steps written to the shared folder, so that what follows doesn't compute them again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which every executor shares; a local one only in local mode where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="lexforge-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/lexforge/{uuid.uuid4().hex}"


#: Tables made since each finish() that is still going on began.
_MADE: list[list[DataFrame]] = []


def cut(df: DataFrame) -> DataFrame:
    """Write df to a table in the shared folder and read it back: later stages no longer depend on its lineage."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    if _MADE:
        _MADE[-1].append(out)
    return out


def finish(build: Callable[[], DataFrame]) -> DataFrame:
    """cut(build()); the tables that were made on the way, which nothing needs any more, go."""
    _MADE.append([])
    try:
        out = cut(build())
    finally:
        made = _MADE.pop()
    for table_ in made:
        if table_ is not out:
            drop_table(table_)
    if _MADE:
        _MADE[-1].append(out)
    free_shuffles(out.sparkSession)
    return out


def drop_table(df: DataFrame) -> None:
    """Remove a table made by cut() once nothing reads it any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of stages whose results are already in tables."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
