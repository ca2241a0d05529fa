"""Refresh of the MP roll-up from a stream of feed rows (EXT-1).

Feed files arrive; every micro-batch keeps its rows under its own batch id and then makes
the roll-up anew for the MPs that it touches, and for no others:

    batch rows --> (country, SKU) --> touched (country, MP) --> all their RPs and feed rows
        --> snapshot, enrichment, roll-up --> rows of the touched MPs

The roll-up is a published table with a key of hash buckets of (country, MP): a batch
rewrites the buckets of its MPs and publishes them in one version, so readers see a batch
whole or not at all. A batch that is run again after a failure, even after it was
published, overwrites its own rows and publishes the same result.

The metrics and the curated ids are inputs of the refresh, as is the clock: when these
change, the batch job is run instead. State is the feed rows and the table, both in files;
nothing is kept in a task or on the driver between batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators import catalog as C
from shelfmatch.operators import metrics as M
from shelfmatch.operators.prefilter import may_match
from shelfmatch.session import stored
from shelfmatch.sources.published import Published, listed

MP = ["COUNTRY", "MASTER_PRODUCT_ID"]


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*MP), F.lit(buckets)).cast("string")


@dataclass
class RollupRefresh:
    """``base`` is the catalog before metrics; ``fill``, ``defects`` and ``sot_ids`` are as in the batch job."""
    path: str
    base: DataFrame
    fill: DataFrame
    defects: DataFrame
    sot_ids: DataFrame
    as_of: object
    feed_days: int = 15
    buckets: int = 64

    def table(self, spark: SparkSession) -> Published:
        return Published(spark, f"{self.path}/rollup", keys=("bucket",))

    def rows(self, spark: SparkSession) -> DataFrame:
        """The roll-up as last published."""
        return self.table(spark).read().drop("bucket")

    def batches(self, spark: SparkSession) -> list[str]:
        """Names of the batches kept so far."""
        return [n for n in listed(spark, f"{self.path}/feed") if n.startswith("batch=")]

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark, log = batch.sparkSession, f"{self.path}/feed"
        batch = stored(batch, "batch")       # a batch run again may read the folder that it replaces
        batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        new, every = spark.read.parquet(f"{log}/batch={batch_id}"), spark.read.parquet(log).drop("batch")
        skus = new.select("COUNTRY", F.col("RETAIL_ID").alias("SKU")).distinct()
        # Each of these is read several times below: made once. A batch's share of the base and of the feed is small:
        # the rest is left out before the joins shuffle it.
        own = may_match(self.base, new, {"SKU": "RETAIL_ID"})
        touched = stored(own.join(skus, ["COUNTRY", "SKU"], "left_semi").select(*MP).distinct(), "touched")
        own = stored(may_match(self.base, touched, dict(zip(MP, MP))).join(touched, MP, "left_semi"), "own")
        feed = may_match(every, own, {"RETAIL_ID": "SKU"}).join(own.select("COUNTRY", F.col("SKU").alias("RETAIL_ID")), ["COUNTRY", "RETAIL_ID"], "left_semi")
        on = [*(["COUNTRY"] if "COUNTRY" in self.sot_ids.columns else []), "MASTER_PRODUCT_ID"]
        snapshot = stored(M.feed_snapshot(feed, self.as_of, self.feed_days), "snapshot")
        fed = may_match(own, snapshot, {"SKU": "RETAIL_ID"})     # enrichment keeps no others
        rps = stored(C.enrich_retailer_products(C.assemble_catalog(fed, self.fill, self.defects, snapshot, self.sot_ids, on)), "rps")
        made = C.rollup_products(rps).withColumn("bucket", bucket(self.buckets))
        table = self.table(spark)
        at = [r[0] for r in touched.select(bucket(self.buckets)).distinct().collect()]      # at most ``buckets``
        if table.latest is not None:
            kept = table.read().where(F.col("bucket").isin(at)).join(touched, MP, "left_anti")
            made = made.unionByName(kept.select(made.columns))
        table.replace(made, handled=at, note=f"batch {batch_id}")

    def run(self, feed: DataFrame, checkpoint: str) -> None:
        """Process all that a streaming ``feed`` has now, batch by batch, from where ``checkpoint`` stands."""
        query = feed.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
