"""Best-per-key, running totals and the budget prefix (WIN-1..5, SRT-1, MAT-6, MAT-7, R3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from shelfmatch.session import materialize

RANK_DIGITS = 10


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def best_per_key(df: DataFrame, key: str | Sequence[str], score: str, tie: str,
                 digits: int = RANK_DIGITS) -> DataFrame:
    """WIN-1: per key the row with the highest score, ties to the lowest ``tie``.

    Written as ``max`` over one struct (score, -tie, every other column), so
    it is a hash aggregate with a map-side partial step: a key holding a third
    of all rows is reduced in every task before the shuffle instead of being
    sorted in one. The remaining columns complete the order, so even exact
    ties pick the same row in every run and every task retry; the unrounded
    score comes last, so float summation noise never outranks a real column.
    """
    keys = _keys(key)
    payload = [c for c in df.columns if c not in keys]
    if isinstance(df.schema[tie].dataType, NumericType):
        rest = [c for c in payload if c != score] + ([score] if score in payload else [])
        best = df.groupBy(*keys).agg(F.max(F.struct(
            F.round(F.col(score), digits).alias("_s"), (-F.col(tie)).alias("_t"),
            *[F.col(c) for c in rest])).alias("_best"))
        return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload])
    w = Window.partitionBy(*keys).orderBy(F.round(F.col(score), digits).desc(), F.col(tie).asc(),
                                          *[F.col(c).desc() for c in payload if c not in (score, tie)])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def best_matches(scored: DataFrame, key: str | Sequence[str], score: str = "similarity",
                 tie: str = "master_product_id_sot", floor: float = 0.5) -> DataFrame:
    """MAT-6: best match per key, then the similarity floor (FLT-8)."""
    best = best_per_key(scored, key, score, tie)
    return best.where(F.round(F.col(score), RANK_DIGITS) >= F.lit(floor))


def share_of_total(df: DataFrame, value: str, out: str, partition: Sequence[str] = ("COUNTRY",),
                   total: DataFrame | None = None) -> DataFrame:
    """WIN-5 / AGG-8: ``100 * value / Σ value`` per partition.

    The denominator is an aggregate joined back (one row per partition key),
    not a window: a window would sort a whole country in one task. ``total``
    lets the caller take the denominator from a different frame (the
    reference divides by the GMV of *all* master products).
    """
    parts = list(partition)
    src = df if total is None else total
    tot = src.groupBy(*parts).agg(F.sum(value).alias("_total"))
    if not parts:
        return df.withColumn(out, F.lit(100.0) * F.col(value) / tot.select("_total").scalar())
    return (df.join(tot, on=parts, how="left")
            .withColumn(out, F.try_divide(F.col(value) * 100.0, F.col("_total"))).drop("_total"))


def running_total(df: DataFrame, order: Sequence[Column], amount: str, out: str,
                  partition: Sequence[str]) -> DataFrame:
    """WIN-3: running sum of ``amount`` per partition key, in ``order``.

    Rows are range-partitioned on (key, order), so a key holding a third of all
    rows spans many tasks; sums run inside each range and are shifted by the
    totals of the key's earlier ranges. The ranges are materialised because
    both steps must see the same bounds. NULL amounts add nothing.
    """
    parts = list(partition)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(p) for p in parts], *order).withColumn("_pid", F.spark_partition_id())
    local = Window.partitionBy("_pid", *parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = materialize(ranged.withColumn("_cum", F.coalesce(F.sum(amount).over(local), F.lit(0))))
    keys = [F.col(p).alias(f"_k_{p}") for p in parts]
    chunks = ranged.groupBy(*parts, "_pid").agg(F.coalesce(F.sum(amount), F.lit(0)).alias("_sum"))
    before = Window.partitionBy(*parts).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(*keys, F.col("_pid").alias("_k_pid"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    same = [F.col("_pid") == F.col("_k_pid"), *[F.col(p).eqNullSafe(F.col(f"_k_{p}")) for p in parts]]
    return (ranged.join(chunks, on=same).withColumn(out, F.col("_off") + F.col("_cum"))
            .select(*df.columns, out))


def budget_prefix(df: DataFrame, rank_by: str, amount: str, budget: float, tie: str | Sequence[str],
                  partition: Sequence[str] = ("COUNTRY",), running: str = "cumulative_retailers") -> DataFrame:
    """WIN-3/WIN-4: rows in ``rank_by`` descending order (nulls last) while the
    running total of ``amount`` stays within ``budget``, plus the row that
    crosses it. One predicate does both: ``running - amount <= budget``. Rows
    with a NULL amount are not kept and use up nothing.

    R3: only where one aggregate proves that every amount is at least 1 can no
    more than ``budget + 1`` rows qualify; then a ``row_number`` limit (a partial
    ``WindowGroupLimit`` in every task) leaves the window that many rows.
    Otherwise the running total is made over range partitions.
    """
    parts = list(partition)
    order = [F.col(rank_by).desc_nulls_last(), *[F.col(t).asc() for t in _keys(tie)]]
    df = materialize(df)
    proof = df.agg(F.min(amount).alias("low"), F.count_if(F.col(amount).isNull()).alias("nulls")).first()
    if proof["low"] is not None and proof["low"] >= 1 and not proof["nulls"]:
        w = Window.partitionBy(*parts).orderBy(*order)
        out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= int(budget) + 1).drop("_rn")
        out = out.withColumn(running, F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    else:
        out = running_total(df, order, amount, running, parts)
    return out.where(F.col(running) - F.col(amount) <= F.lit(budget))


def prioritise(matches: DataFrame, rollup: DataFrame, budget: float = 500,
               partition: Sequence[str] = ("COUNTRY",), mp_col: str = "master_product_id",
               tie: Sequence[str] = ("master_product_id", "master_product_id_sot", "NAME", "CAT1_NAME",
                                     "CAT2_NAME", "CAT3_NAME", "MAKER", "TRADEMARK")) -> DataFrame:
    """MAT-7: best matches ⋈ MP roll-up, GMV share, budget prefix of retailer products.

    JN-10 is a left join on the opportunity MP id (it fans out when an MP
    has several roll-up rows, as in the reference). The GMV denominator is
    the whole roll-up of the partition.
    """
    parts = list(partition)
    # Both sides descend from the same roll-up, so join on renamed keys by
    # name (column handles of a self-join are ambiguous). Spark resolves
    # names case-insensitively: roll-up columns whose name equals a match
    # column up to case (SIMILARITY vs similarity) get an ``MP_`` prefix, and
    # the roll-up's MASTER_PRODUCT_ID (equal to the join key) is dropped.
    taken = {c.lower() for c in matches.columns}
    extra = [F.col(c).alias(f"MP_{c}" if c.lower() in taken else c) for c in rollup.columns
             if c not in parts and c != "MASTER_PRODUCT_ID"]
    r = rollup.select(*[F.col(p).alias(f"_r_{p}") for p in parts], F.col("MASTER_PRODUCT_ID").alias("_r_mp"), *extra)
    cond = [F.col(mp_col) == F.col("_r_mp")] + [F.col(p) == F.col(f"_r_{p}") for p in parts]
    j = matches.join(r, on=cond, how="left").drop("_r_mp", *[f"_r_{p}" for p in parts])
    j = share_of_total(j, "GMV_T", "gmv_coverage", parts, total=rollup)
    j = j.withColumn("_rank_by", F.round("gmv_coverage", RANK_DIGITS))
    out = budget_prefix(j, rank_by="_rank_by", amount="N_ASSOCIATED_RETAILERS", budget=budget,
                        tie=list(tie), partition=parts)
    return out.drop("_rank_by")
