"""Sinks (SNK-1..3): per-country partition replace, match log append, text-safe decimals."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shelfmatch.session import materialize


def decimals_as_text(df: DataFrame) -> DataFrame:
    """SNK-2: every DECIMAL column cast to STRING, found from the schema."""
    return df.withColumns({f.name: F.col(f.name).cast("string")
                           for f in df.schema.fields if isinstance(f.dataType, DecimalType)})


def replace_partition(df: DataFrame, path: str, partition: Sequence[str] = ("COUNTRY",),
                      fmt: str = "parquet", processed: Iterable[str] | None = None) -> None:
    """SNK-1: replace the partitions present in ``df``; other countries stay.

    Dynamic partition overwrite is set on the writer, so the job is
    idempotent under task retries and a re-run of one country rewrites
    exactly that country's folder. ``processed`` names every value of the first
    partition column that the job handled: those without rows in ``df`` are
    cleared too, so that no rows of an earlier run are left.
    """
    out = materialize(decimals_as_text(df))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition).format(fmt).save(path))
    if processed is not None:
        written = {r[0] for r in out.select(partition[0]).distinct().collect()}  # one value per country
        clear_partitions(df.sparkSession, path, partition[0], set(processed) - written)


def clear_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> None:
    """Remove the folders of the given partition values through the path's own file system."""
    values = {str(v) for v in values}
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name, _, value = status.getPath().getName().partition("=")
        if name == column and unquote(value) in values:
            fs.delete(status.getPath(), True)


def append_log(df: DataFrame, path: str, run_id: str | None = None, partition: Sequence[str] = ("COUNTRY",),
               fmt: str = "parquet") -> None:
    """SNK-3: append the match log (one folder per country).

    With a ``run_id`` the log is also partitioned by ``RUN_ID``, and writing the
    same run again replaces its rows instead of doubling them.
    """
    if run_id is None:
        df.write.mode("append").partitionBy(*partition).format(fmt).save(path)
    else:
        (df.withColumn("RUN_ID", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("RUN_ID", *partition).format(fmt).save(path))
