"""Exact top-k inner products by norm-bucketed retrieval.

Rows are range-partitioned by length, so a batch of a task is a bucket of similar
lengths, longest first. A query with threshold t (its k-th best score so far) needs
from a bucket of greatest length l a cosine of t / (|q| l): above 1 the bucket is
skipped (length pruning); for a high threshold, products over the bucket's largest
coordinates plus a Cauchy-Schwarz bound on the rest leave only rows that can qualify
(coordinate pruning); otherwise all products are made. Products are exact integers.
Thresholds start from the longest rows and only drop rows that cannot enter the top k.

Queries are taken in blocks of at most QUERY_BLOCK rows (the broadcast's bound).
Vectors that are null, or hold a null or non-finite component, take no part; missing
trailing components count as 0. Ties go to the smaller id. Repeated ids are separate
candidates; a query never meets rows of its own id. A vector whose squared length is 2^63
or more takes no part either: its products may pass the 64 bits of a score, and those of
any two others cannot (Cauchy-Schwarz). An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfmatch.llm import textcols as T
from shelfmatch.session import materialize

SCALE, K, QUERY_BLOCK, FOCUS, HIGH = 256, 5, 8192, 12, 0.7
#: Just under 2^63, as the sum is rounded.
LONGEST = 2.0 ** 63 * (1 - 1e-9)
OUT = "query_id long, vec_id long, score long"


def quantised(table: DataFrame, scale: int = SCALE) -> DataFrame:
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return (table.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ok)
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
            .where(F.col("norm") * F.col("norm") < LONGEST))


def matrix(vectors: list, dim: int) -> np.ndarray:
    """Rows padded to ``dim``; Python integers where doubles could not hold a product exactly."""
    m = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    if m.size and float(np.abs(m).max()) ** 2 * dim >= 2.0 ** 52:
        m = np.zeros((len(vectors), dim), dtype=object)
        for i, v in enumerate(vectors):
            m[i, :len(v)] = [int(x) for x in v]
    return m


class Best:
    """The k best (score, id) of every query so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.q, self.k = ids, vectors, k
        self.norm = np.sqrt((vectors.astype(float) ** 2).sum(1))
        self.top: list[list] = [[] for _ in ids]
        self.bar = np.full(len(ids), -np.inf) if floor is None else floor.astype(float)

    def bucket(self, ids: np.ndarray, rows: np.ndarray) -> None:
        length = np.sqrt((rows.astype(float) ** 2).sum(1))
        longest = float(length.max()) if len(length) else 0.0
        reach = self.norm * longest
        # A hair of slack: lengths are rounded, products are not.
        live = np.flatnonzero(reach * (1 + 1e-9) + 1e-6 >= self.bar)
        if not len(live):
            return
        cosine = np.where(reach[live] > 0, self.bar[live] / np.maximum(reach[live], 1e-300), 0)
        high = cosine > HIGH
        self._verify(live[~high], ids, rows)
        hard = live[high]
        if len(hard) and rows.dtype != object:
            focus = np.argsort(-np.abs(rows).sum(0), kind="stable")[:FOCUS]
            rest = np.sqrt(np.maximum(length ** 2 - (rows[:, focus] ** 2).sum(1), 0))
            q = self.q[hard].astype(float)
            qrest = np.sqrt(np.maximum(self.norm[hard] ** 2 - (q[:, focus] ** 2).sum(1), 0))
            bound = q[:, focus] @ rows[:, focus].T + np.outer(qrest, rest)
            can = (bound * (1 + 1e-9) + 1e-6 >= self.bar[hard][:, None]).any(0)
            self._verify(hard, ids[can], rows[can])
        elif len(hard):
            self._verify(hard, ids, rows)

    def _verify(self, which: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(which) or not len(ids):
            return
        scores = self.q[which] @ rows.T
        for i, s in zip(which, scores):
            hit = np.flatnonzero((s >= self.bar[i]) & (ids != self.ids[i]))
            if len(hit):
                if len(hit) > 4 * self.k and s.dtype != object:
                    cut = np.partition(s[hit], len(hit) - self.k)[len(hit) - self.k]
                    hit = hit[s[hit] >= cut]
                found = self.top[i] + [(-int(s[j]), int(ids[j])) for j in hit]
                found.sort()
                self.top[i] = found[:self.k]
                if len(self.top[i]) == self.k:
                    self.bar[i] = max(self.bar[i], -self.top[i][-1][0])

    def batch(self) -> pa.RecordBatch:
        rows = [(int(q), v, -s) for q, top in zip(self.ids, self.top) for s, v in top]
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])


def top_k(table: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows of the table."""
    spark = table.sparkSession
    rows = materialize(quantised(table, scale))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    tasks = T.shuffle_tasks(spark)
    longest = rows.orderBy(F.desc("norm"), "vec_id").limit(1024).collect()  # sets first thresholds
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))  # one query per id
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-queries.count() * 2 // QUERY_BLOCK)))))
    blocks = [r[0] for r in queries.select("block").distinct().orderBy("block").collect()]
    buckets = materialize(rows.repartitionByRange(tasks, F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id"))
    found = None
    for block in blocks:
        mine = queries.where(F.col("block") == block).orderBy("vec_id").collect()
        ids, vecs = np.array([r["vec_id"] for r in mine], dtype=np.int64), matrix([r["v"] for r in mine], dim)
        first = Best(ids, vecs, k)
        first.bucket(np.array([r["vec_id"] for r in longest]), matrix([r["v"] for r in longest], dim))
        shared = spark.sparkContext.broadcast((ids, vecs, first.bar))

        def run(batches, shared=shared):
            ids, vecs, bar = shared.value
            best = Best(ids, vecs, k, bar.copy())
            for b in batches:
                for a in range(0, b.num_rows, 1024):
                    part = b.slice(a, 1024)
                    best.bucket(np.array(part.column("vec_id")), matrix(part.column("v").to_pylist(), dim))
            yield best.batch()

        got = buckets.select("vec_id", "v").mapInArrow(run, OUT)
        found = got if found is None else found.unionByName(got)
    if found is None:
        found = spark.createDataFrame([], OUT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_topk_search(spark, sf_dir):
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored) WHERE rank <= {K}
"""
