"""Metric queries over the stand-in tables (AGG-1..5, JN-1, FLT-1/2/6/9, SC-2..4, PIP-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators import metrics as M
from shelfmatch.plans import standins as S
from shelfmatch.plans.registry import query
from shelfmatch.sources.tables import table


@query("fill_rate", oracle="WITH " + S.ORDER_LINES_SQL + f"""
SELECT COUNTRY, PRODUCT_ID,
       CAST(sum(CASE WHEN STOCKOUT = 0 THEN 1 ELSE 0 END) AS BIGINT) AS COUNT_FOUND,
       CAST(sum(CASE WHEN SUBSTITUTED = 1 THEN 1 ELSE 0 END) AS BIGINT) AS COUNT_REPLACED,
       CAST(sum(CASE WHEN STOCKOUT = 1 AND SUBSTITUTED = 0 THEN 1 ELSE 0 END) AS BIGINT) AS COUNT_REFUNDED,
       CAST(COUNT_FOUND + COUNT_REPLACED + COUNT_REFUNDED AS BIGINT) AS TOTAL_PRODUCTS,
       round(CASE WHEN TOTAL_PRODUCTS = 0 THEN NULL ELSE COUNT_FOUND / TOTAL_PRODUCTS END, 8) AS FR,
       round(sum(coalesce(TOTAL_PRICE, 0)), 6) AS GMV_TOTAL,
       CAST(count(DISTINCT ORDER_ID) AS BIGINT) AS N_ORDERS
FROM order_lines
WHERE CAST(CREATED_AT_ORDER AS DATE) >= date_trunc('week', {S.AS_OF_SQL}) - INTERVAL 12 WEEK
GROUP BY 1, 2
""")
def fill_rate(spark: SparkSession, sf: str) -> DataFrame:
    out = M.fill_rate(S.order_lines(spark, sf), S.AS_OF)
    return out.select("COUNTRY", "PRODUCT_ID", "COUNT_FOUND", "COUNT_REPLACED", "COUNT_REFUNDED",
                      "TOTAL_PRODUCTS", F.round("FR", 8).alias("FR"), F.round("GMV_TOTAL", 6).alias("GMV_TOTAL"),
                      "N_ORDERS")


@query("defect_rate", oracle="WITH " + S.ORDER_LINES_SQL + f"""
SELECT a.COUNTRY, a.PRODUCT_ID AS PID, CAST(count(1) AS BIGINT) AS QTY_REQUESTED,
       CAST(count(b.event_id) AS BIGINT) AS QTY_DEFECTIVE,
       round(count(b.event_id) / count(1), 4) AS PRODUCT_DR
FROM order_lines a LEFT JOIN events b
  ON a.ORDER_ID = b.event_id AND b.event_type IN ('error')
WHERE a.CREATED_AT_ORDER >= {S.AS_OF_SQL} - INTERVAL 30 DAY
GROUP BY 1, 2
HAVING round(count(b.event_id) / count(1), 4) > 0
""")
def defect_rate(spark: SparkSession, sf: str) -> DataFrame:
    out = M.defect_rate(S.order_products(spark, sf), S.tickets(spark, sf), S.AS_OF,
                        reasons=S.TICKET_REASONS, join_keys=("ORDER_ID",), group_keys=("COUNTRY", "PID"))
    return out.select("COUNTRY", "PID", "QTY_REQUESTED", "QTY_DEFECTIVE", "PRODUCT_DR")


@query("feed_snapshot", oracle="WITH " + S.FEED_SQL + f"""
SELECT COUNTRY, RETAIL_ID, max(NAME) AS NAME, max(DESCRIPTION) AS DESCRIPTION, max(TRADEMARK) AS TRADEMARK,
       round(median(PRICE), 6) AS MEDIAN_PRICE, max(IMAGE_URL) AS IMAGE_URL, max(QUANTITY) AS QUANTITY,
       max(UNIT_TYPE) AS UNIT_TYPE, max(MIN_QUANTITY_IN_GRAMS) AS MIN_QUANTITY_IN_GRAMS,
       max(STEP_QUANTITY_IN_GRAMS) AS STEP_QUANTITY_IN_GRAMS
FROM feed
WHERE NAME IS NOT NULL AND CAST(EXECUTION_DATE AS DATE) > {S.AS_OF_SQL} - INTERVAL 15 DAY
GROUP BY 1, 2
""")
def feed_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    out = M.feed_snapshot(S.feed(spark, sf), S.AS_OF)
    return out.withColumn("MEDIAN_PRICE", F.round("MEDIAN_PRICE", 6))


@query("owner_list", oracle="""
SELECT DISTINCT n.n_name AS COUNTRY_CODE, s.s_suppkey AS CP_RETAILER_ID, s.s_name AS TAM
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE s.s_name IS NOT NULL AND s.s_suppkey IS NOT NULL AND s.s_name NOT IN ('Supplier#000000001')
""")
def owner_list(spark: SparkSession, sf: str) -> DataFrame:
    return M.owner_list(S.store_links(spark, sf), exclude=("Supplier#000000001",))


# Fixed default "master" JSON the event properties fall back to.
DEFAULT_PROPS = '{"k": -1, "type": "U", "unitType": "un"}'


@query("json_coalesce", oracle=f"""
SELECT event_id,
       coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE),
                TRY_CAST(json_extract_string('{DEFAULT_PROPS}', '$.k') AS DOUBLE)) AS MAX_QUANT,
       coalesce(json_extract_string(props, '$.type'), json_extract_string('{DEFAULT_PROPS}', '$.type')) AS SELL_TYPE,
       coalesce(json_extract_string(props, '$.unitType'),
                json_extract_string('{DEFAULT_PROPS}', '$.unitType')) AS UNITY_P
FROM events
""")
def json_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "props")
    mp = F.lit(DEFAULT_PROPS)
    return ev.select("event_id",
                     M.json_coalesce(F.col("props"), mp, "$.k", "double").alias("MAX_QUANT"),
                     M.json_coalesce(F.col("props"), mp, "$.type").alias("SELL_TYPE"),
                     M.json_coalesce(F.col("props"), mp, "$.unitType").alias("UNITY_P"))
