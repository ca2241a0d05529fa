"""Sources, sinks and refresh on the stand-ins (SRC-1, SRC-3, PRJ-8, SNK-1..3, EXT-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators import metrics as M
from shelfmatch.plans import catalog_queries as CQ
from shelfmatch.plans import sqlfrag as Q
from shelfmatch.plans import standins as S
from shelfmatch.plans.registry import query
from shelfmatch.session import scratch, stored
from shelfmatch.sources.published import Published
from shelfmatch.sources.tables import country_scan, country_table, read_source, table
from shelfmatch.streaming.refresh import RollupRefresh


def country_names(spark: SparkSession, sf: str) -> list[str]:
    return sorted(r[0] for r in table(spark, sf, "nation").select("n_name").distinct().collect())


def order_tables(spark: SparkSession, sf: str) -> str:
    """A view per country over its own order lines, without a country column; returns the views' template."""
    path = scratch(spark, "orders")
    lines = S.order_lines(spark, sf)
    lines.write.partitionBy("COUNTRY").parquet(path)
    fields = lines.drop("COUNTRY").schema
    held = {r[0] for r in spark.read.parquet(path).select("COUNTRY").distinct().collect()}
    for c in country_names(spark, sf):
        own = spark.read.schema(fields).parquet(f"{path}/COUNTRY={c}") if c in held else spark.createDataFrame([], fields)
        own.createOrReplaceTempView(f"{c}_order_lines")
    return "{country}_order_lines"


@query("country_scan", oracle="WITH " + S.ORDER_LINES_SQL + "," + Q.FILL_RATE + """
SELECT fr.COUNTRY, PRODUCT_ID, CAST(TOTAL_PRODUCTS AS BIGINT) AS TOTAL_PRODUCTS, round(FR, 8) AS FR, CAST(1 + n_nationkey % 3 AS INTEGER) AS MIN_TOTAL
FROM fr JOIN nation ON n_name = fr.COUNTRY WHERE n_regionkey IN (1, 3) AND TOTAL_PRODUCTS >= 1 + n_nationkey % 3""")
def country_orders(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1, SRC-3, PRJ-8: per-country tables read by templated name into one partitioned table, scanned for the
    countries of a parameter frame (dynamic partition pruning) with a threshold of each."""
    orders = country_table(spark, order_tables(spark, sf), country_names(spark, sf), scratch(spark, "by-country"))
    table(spark, sf, "nation").createOrReplaceTempView("nation_parameters")
    params = read_source(spark, "SELECT n_name AS COUNTRY, CAST(1 + n_nationkey % 3 AS INT) AS MIN_TOTAL FROM IDENTIFIER(:t) WHERE n_regionkey IN (1, 3)",
                         {"t": "nation_parameters"})
    lines = country_scan(orders, params)
    fill = M.fill_rate(lines, S.AS_OF, keys=("COUNTRY", "PRODUCT_ID", "MIN_TOTAL"), with_orders=False)
    return fill.where(F.col("TOTAL_PRODUCTS") >= F.col("MIN_TOTAL")).select("COUNTRY", "PRODUCT_ID", "TOTAL_PRODUCTS", F.round("FR", 8).alias("FR"), "MIN_TOTAL")


@query("sheet_replace", oracle="WITH " + S.ORDER_LINES_SQL + "," + Q.FILL_RATE + """
SELECT fr.COUNTRY, PRODUCT_ID, CAST(CAST(COUNT_FOUND AS DECIMAL(12, 2)) AS VARCHAR) AS FOUND,
       CASE WHEN n_regionkey = 3 THEN 'second' ELSE 'first' END AS RUN
FROM fr JOIN nation ON n_name = fr.COUNTRY
WHERE n_regionkey <> 3 OR (PRODUCT_ID % 2 = 0 AND n_name <> (SELECT min(n_name) FROM nation WHERE n_regionkey = 3))""")
def sheet_replace(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1, SNK-2: all countries are published, then one region anew with fewer rows and one of its countries empty,
    then that run again; read back from the published table."""
    fill = stored(M.fill_rate(S.order_lines(spark, sf), S.AS_OF, with_orders=False), "fill")
    rows = fill.select("COUNTRY", "PRODUCT_ID", F.col("COUNT_FOUND").cast("decimal(12,2)").alias("FOUND"))
    nation = table(spark, sf, "nation")
    region = nation.where("n_regionkey = 3").select(F.col("n_name").alias("COUNTRY"))
    handled = sorted(r[0] for r in region.collect())
    sheet = Published(spark, scratch(spark, "sheet"))
    sheet.replace(rows.withColumn("RUN", F.lit("first")), country_names(spark, sf), note="first")
    again = rows.where("PRODUCT_ID % 2 = 0").join(region, "COUNTRY", "left_semi").where(F.col("COUNTRY") != handled[0]) if handled else rows.limit(0)
    for _ in range(2):
        sheet.replace(again.withColumn("RUN", F.lit("second")), handled, note="second")
    return sheet.read()


@query("match_log", oracle="WITH " + S.ORDER_LINES_SQL + "," + Q.FILL_RATE + """
SELECT COUNTRY, PRODUCT_ID, CAST(TOTAL_PRODUCTS AS BIGINT) AS TOTAL_PRODUCTS, r AS RUN_ID
FROM fr, (VALUES ('a'), ('b')) v(r) WHERE r = 'a' OR PRODUCT_ID % 3 = 0""")
def log_of_runs(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3: the log of two runs, the second written twice; each run's rows are there once."""
    fill = stored(M.fill_rate(S.order_lines(spark, sf), S.AS_OF, with_orders=False), "fill").select("COUNTRY", "PRODUCT_ID", "TOTAL_PRODUCTS")
    log = Published(spark, scratch(spark, "log"), keys=("RUN_ID",))
    log.replace(fill.withColumn("RUN_ID", F.lit("a")), ["a"])
    log.replace(fill.withColumn("RUN_ID", F.lit("b")), ["b"])
    log.replace(fill.where("PRODUCT_ID % 3 = 0").withColumn("RUN_ID", F.lit("b")), ["b"])
    return log.read()


@query("fill_rate_weekly", oracle="WITH " + S.ORDER_LINES_SQL + "," + Q.FILL_RATE + """
SELECT COUNTRY, PRODUCT_ID, CAST(COUNT_FOUND AS BIGINT) AS COUNT_FOUND, CAST(COUNT_REPLACED AS BIGINT) AS COUNT_REPLACED,
       CAST(COUNT_REFUNDED AS BIGINT) AS COUNT_REFUNDED, CAST(TOTAL_PRODUCTS AS BIGINT) AS TOTAL_PRODUCTS, round(FR, 8) AS FR, round(GMV_TOTAL, 4) AS GMV_TOTAL
FROM fr""")
def fill_rate_weekly(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-1..3 from weekly partials in a published table: the history is reduced once, the last two weeks come
    later and replace only their own; the window then reads partials alone."""
    weeks = Published(spark, scratch(spark, "weeks"), keys=("WEEK",))
    lines = S.order_lines(spark, sf)
    recent = F.col("CREATED_AT_ORDER") >= F.lit(M.week_window_start(S.AS_OF, 1))
    weeks.replace(M.weekly_partials(lines.where(~recent)), note="history")
    weeks.replace(M.weekly_partials(lines.where(recent)), note="last weeks")
    out = M.fill_rate_of_weeks(weeks.read(), S.AS_OF)
    return out.select("COUNTRY", "PRODUCT_ID", "COUNT_FOUND", "COUNT_REPLACED", "COUNT_REFUNDED", "TOTAL_PRODUCTS", F.round("FR", 8).alias("FR"),
                      F.round("GMV_TOTAL", 4).alias("GMV_TOTAL"))


def refresh_inputs(spark: SparkSession, sf: str) -> RollupRefresh:
    fill, defects = (stored(rows, name) for rows, name in zip(CQ.metric_inputs(spark, sf), ("fill", "defects")))
    base = stored(CQ.assembled_base(spark, sf), "base")
    return RollupRefresh(scratch(spark, "refresh"), base, fill, defects, S.sot(spark, sf), S.AS_OF, buckets=16)


def feed_files(spark: SparkSession, sf: str, files: int) -> str:
    """The feed's recent rows as that many files; rows of one product come in several."""
    path = scratch(spark, "feed")
    recent = S.feed(spark, sf).where(M.on_or_after("EXECUTION_DATE", M.week_window_start(S.AS_OF, 4)))
    recent.repartition(files, F.pmod(F.xxhash64("PRICE", "EXECUTION_DATE"), F.lit(files))).write.parquet(path)
    return path


@query("feed_refresh", oracle="WITH " + Q.ALL_INPUTS + "," + Q.CATALOG_RP + "," + Q.ROLLUP + CQ.ROLLUP_SELECT)
def feed_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """EXT-1: the roll-up kept by micro-batches over the feed's files, the last one run twice; equal to the batch roll-up."""
    refresh, files = refresh_inputs(spark, sf), feed_files(spark, sf, 2)
    schema = spark.read.parquet(files).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(files)
    refresh.run(stream, scratch(spark, "refresh-checkpoint"))
    last = max(int(p.rsplit("=", 1)[1]) for p in refresh.batches(spark))
    refresh.process(spark.read.schema(schema).parquet(f"{refresh.path}/feed/batch={last}"), last)
    return CQ.rollup_columns(refresh.rows(spark))
