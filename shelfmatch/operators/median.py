"""Exact, skew-safe median per group (AGG-5, AGG-6).

Spark's built-in exact ``median`` merges every distinct value of a group in
one task, so a group holding a third of all rows would have to fit in one
executor. Here the work is spread the way a distributed sort spreads it:

1. distinct (group, value) pairs with their counts (map-side partial agg);
2. range-partitioned on (group, value): a hot group spans many partitions;
3. inside each partition, running counts per group in value order (the
   window is keyed by (partition, group), so a window task holds at most one
   range partition);
4. per-(group, partition) totals and their running offsets across
   partitions (at most #partitions rows per group);
5. each value row knows its global rank span; the rows covering ranks
   ⌊(n-1)/2⌋ and ⌊n/2⌋ give the median (mean of the two middle values for
   even n, as pandas and SQL MEDIAN do). NULLs are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.session import materialize


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """``(keys..., out)`` with the exact median of ``value`` per group."""
    keys = list(keys)
    out = out or value
    vals = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    vc = vals.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = vc.repartitionByRange(n, *[F.col(k) for k in keys], F.col("_v")) \
        .withColumn("_pid", F.spark_partition_id())
    local = Window.partitionBy("_pid", *keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    # Both uses below must see the same range bounds, so the ranges are made once.
    ranged = materialize(ranged.withColumn("_cum", F.sum("_c").over(local)))
    chunks = ranged.groupBy("_pid", *keys).agg(F.max("_cum").alias("_chunk"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (chunks.withColumn("_off", F.coalesce(F.sum("_chunk").over(before), F.lit(0)))
              .withColumn("_n", F.sum("_chunk").over(Window.partitionBy(*keys))))
    chunks = chunks.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_pid").alias("_k_pid"), "_off", "_n")
    same = [F.col("_pid") == F.col("_k_pid"), *[F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]]
    j = ranged.join(chunks, on=same)
    end = F.col("_off") + F.col("_cum")            # exclusive end rank of this value
    start = end - F.col("_c")
    lo, hi = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    j = j.where(((start <= lo) & (lo < end)) | ((start <= hi) & (hi < end)))
    return j.groupBy(*keys).agg(
        ((F.max(F.when((start <= lo) & (lo < end), F.col("_v")))
          + F.max(F.when((start <= hi) & (hi < end), F.col("_v")))) / 2).alias(out))


def with_medians(agg: DataFrame, src: DataFrame, keys: Sequence[str], medians: dict[str, str]) -> DataFrame:
    """Attach exact medians of ``src`` columns to the per-group frame ``agg``.

    ``medians`` maps output name → source column. All medians are computed in
    one pass: the columns are stacked as (metric, value) rows and the metric
    becomes one more group key. The join back is NULL-safe on the group keys
    (a NULL key is a group of its own); a group whose values are all NULL
    gets a NULL median.
    """
    keys = list(keys)
    names = list(medians)
    stacked = src.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(n).alias("_metric"), F.col(c).cast("double").alias("_val")) for n, c in medians.items()
    ])).alias("_s")).select(*keys, "_s._metric", "_s._val")
    m = exact_median(stacked, [*keys, "_metric"], "_val", "_med")
    m = m.groupBy(*keys).agg(*[F.max(F.when(F.col("_metric") == n, F.col("_med"))).alias(n) for n in names])
    m = m.select(*[F.col(k).alias(f"_m_{k}") for k in keys], *names)
    cond = [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys]
    return agg.join(m, on=cond, how="left").drop(*[f"_m_{k}" for k in keys])
