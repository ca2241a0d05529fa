"""Sharding by vector bin packing, law ``bytes``.

Groups of equal texts are vectors (bytes, tokens, rows). In each partition of
groups, a group goes to the bundle whose residual capacity has the largest dot
product with it, heaviest groups first; a partition has one bundle per shard.
Bundles (partitions x shards of them, whatever the data) are placed on shards by
the same rule. A group above a fixed share of a shard in any dimension is split
into pieces by a hash of its ids, so no group or shard is gathered in one task.

Null texts have size 1 and crc32 0, like empty ones, and are in their group. Repeated
rows stay separate rows; order in a shard is by id. An empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shelfmatch.llm import textcols as T
from shelfmatch.session import materialize

SHARDS, PIECES_PER_SHARD, GROUPS = 16, 32, 50_000
DIMS = ("bytes", "tokens", "rows")


def place(vectors: np.ndarray, bins: int) -> np.ndarray:
    """Bin of each vector: heaviest first, into the largest dot product with the residual."""
    total = np.maximum(vectors.sum(0), 1e-12)
    v = vectors / total * bins           # a bin's even share is 1 in each dimension
    left = np.ones((bins, v.shape[1]))
    out = np.zeros(len(v), dtype=np.int64)
    weight = np.array([16.0] + [1.0] * (v.shape[1] - 1))  # bytes is the law
    for i in np.lexsort((np.arange(len(v)), -v[:, 0])):
        j = int(np.argmax(left @ (v[i] * weight) / max((v[i] * weight).sum(), 1e-300)))
        out[i] = j
        left[j] -= v[i]
    return out


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    spark = docs.sparkSession
    tasks = T.shuffle_tasks(spark)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"), F.unhex(F.md5(raw)).alias("g"),
                       F.size(F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+")).cast("long").alias("tokens"))
    rows = materialize(rows)
    sums = (F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    groups = materialize(rows.groupBy("g").agg(*sums))
    total = groups.agg(F.count("*").alias("n"), *(F.sum(d).alias(d) for d in DIMS)).first()
    parts_n = max(1, -(-total["n"] // GROUPS))
    limit = {d: max((total[d] or 0) / (shards * PIECES_PER_SHARD), 1) for d in DIMS}
    parts = F.greatest(*(F.ceil(F.col(d) / F.lit(limit[d])) for d in DIMS)).cast("int")
    # At most 3 * shards * PIECES_PER_SHARD groups pass a limit: safe to broadcast.
    hot = groups.select("g", parts.alias("n")).where("n > 1")
    piece = F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("n"))).cast("int")
    rows = rows.join(F.broadcast(hot), "g", "left").select("doc_id", "size", "text_crc32", "g", "tokens", piece.alias("piece"))
    pieces = (rows.groupBy("g", "piece").agg(*(F.sum(c).cast("double").alias(d) for c, d in (
                  ("size", "bytes"), ("tokens", "tokens"), (F.lit(1), "rows"))))
              .withColumn("part", F.pmod(F.xxhash64("g", "piece"), F.lit(parts_n)).cast("int")))

    def bundles(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["g", "piece"]).reset_index(drop=True)
        return pdf.assign(bundle=place(pdf[list(DIMS)].to_numpy(float), shards).astype("int32"))

    placed = materialize(pieces.groupBy("part").applyInPandas(
        bundles, "g binary, piece int, bytes double, tokens double, rows double, part int, bundle int"))
    loads = (placed.groupBy("part", "bundle").agg(*(F.sum(d).alias(d) for d in DIMS))
             .orderBy("part", "bundle").collect())   # parts_n * shards rows
    shard = place(np.array([[r[d] for d in DIMS] for r in loads]).reshape(-1, 3), shards)
    plan = spark.createDataFrame([(r["part"], r["bundle"], int(s)) for r, s in zip(loads, shard)],
                                 "part int, bundle int, shard int")
    where = placed.join(F.broadcast(plan), ["part", "bundle"]).select("g", "piece", "shard")
    # Slots: an id-ordered number within hash buckets of a shard, plus the sizes of earlier buckets.
    out = materialize(rows.join(where, ["g", "piece"]).select(
        "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "size"), F.lit(tasks)).cast("int").alias("b"),
        F.xxhash64("g", "doc_id").alias("tie")))
    counts = out.groupBy("shard", "b").count()       # tasks * shards rows
    earlier = counts.select("shard", "b", (F.sum("count").over(Window.partitionBy("shard").orderBy("b"))
                                           - F.col("count")).alias("before"))
    n = F.row_number().over(Window.partitionBy("shard", "b").orderBy("doc_id", "text_crc32", "tie"))
    return (out.withColumn("n", n).join(F.broadcast(earlier), ["shard", "b"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("n") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def op10_sharding(spark, sf_dir):
    return assign_shards(T.documents(spark, sf_dir))
