"""Statistics of a whole frame beside its rows, running sums, and intermediate results that are kept."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """df with the columns of row, a frame of one row, as a scalar subquery: rows aren't joined."""
    return df.withColumn("__row", row.select(F.struct(*row.columns).alias("r")).scalar()).select("*", "__row.*").drop("__row")


@functools.cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="strandline-")


def shared_root(spark: SparkSession) -> str:
    """This application's folder under spark.checkpoint.dir, which all executors share. Where that is unset, a folder of
    this machine serves a session whose executors run on it too; any other session is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(base or _own_folder()).rstrip('/')}/strandline-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder for an intermediate table."""
    return f"{shared_root(spark)}/{uuid.uuid4().hex}"


def remove_shared(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application; frames that read them can't be used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def kept(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: computed once, however often it is used."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt to several tasks for each core, for rows that cost far more to work on than to read: a small file is one task."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def running_sums(df: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """df with, for each new name, the sum of a column over all rows before in `order`. Rows are dealt by ranges of the order,
    summed within, and on top of the sums of the ranges before, a row for each range."""
    parts = kept(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = parts.groupBy("__part").agg(*(F.sum(c).alias(f"__{n}") for n, c in sums.items()))
    base = ranges.select("__part", *(before(Window.orderBy("__part"), f"__{n}").alias(f"__{n}") for n in sums))
    inner = Window.partitionBy("__part").orderBy(*order)
    out = parts.join(F.broadcast(base), "__part").withColumns({n: before(inner, c) + F.col(f"__{n}") for n, c in sums.items()})
    return out.drop("__part", *(f"__{n}" for n in sums))
