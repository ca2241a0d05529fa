"""Catalog queries: membership, windowed distinct count, roll-up, uniformity,
budget prefix (PIP-1..3, PIP-6, JN-5..7, FLT-5, FLT-7, AGG-6..9, WIN-3..5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators import catalog as C
from shelfmatch.operators import metrics as M
from shelfmatch.operators import rank as R
from shelfmatch.plans import sqlfrag as Q
from shelfmatch.plans import standins as S
from shelfmatch.plans.registry import query
from shelfmatch.session import materialize, stored
from shelfmatch.sources.tables import table

BUDGET = 500


@query("membership_split", oracle="WITH " + S.CATALOG_BASE_SQL + "," + S.SOT_SQL + """
SELECT b.COUNTRY, sot.MASTER_PRODUCT_ID IS NOT NULL AS IN_SOT, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT b.MASTER_PRODUCT_ID) AS BIGINT) AS n_mps
FROM catalog_base b LEFT JOIN sot ON sot.MASTER_PRODUCT_ID = b.MASTER_PRODUCT_ID
WHERE b.SELL_TYPE NOT IN ('U') OR sot.MASTER_PRODUCT_ID IS NOT NULL
GROUP BY 1, 2""")
def membership_split(spark: SparkSession, sf: str) -> DataFrame:
    base = C.with_membership(S.catalog_base(spark, sf), S.sot(spark, sf))
    return C.membership_counts(C.keep_sellable(base))


@query("distinct_over", oracle="WITH " + S.CATALOG_BASE_SQL + """
SELECT COUNTRY, PRODUCT_ID, MASTER_PRODUCT_ID,
       CAST(count(DISTINCT PRODUCT_ID) OVER (PARTITION BY COUNTRY, MASTER_PRODUCT_ID) AS BIGINT)
         AS N_ASSOCIATED_RETAILERS
FROM catalog_base""")
def distinct_over(spark: SparkSession, sf: str) -> DataFrame:
    base = S.catalog_base(spark, sf).select("COUNTRY", "PRODUCT_ID", "MASTER_PRODUCT_ID")
    return C.with_group_nunique(base, ["COUNTRY", "MASTER_PRODUCT_ID"], "PRODUCT_ID", "N_ASSOCIATED_RETAILERS")


@query("uniformity_check", oracle="WITH " + S.CATALOG_BASE_SQL + "," + S.SOT_SQL + """,
b AS (SELECT c.*, sot.MASTER_PRODUCT_ID IS NOT NULL AS IN_SOT FROM catalog_base c
      LEFT JOIN sot ON sot.MASTER_PRODUCT_ID = c.MASTER_PRODUCT_ID)
SELECT COUNTRY, MASTER_PRODUCT_ID,
       CAST(count(DISTINCT coalesce(NAME, 'NULL_VALUE')) AS BIGINT) AS n_NAME,
       CAST(count(DISTINCT coalesce(CAT1_NAME, 'NULL_VALUE')) AS BIGINT) AS n_CAT1_NAME,
       CAST(count(DISTINCT coalesce(CAT2_NAME, 'NULL_VALUE')) AS BIGINT) AS n_CAT2_NAME,
       CAST(count(DISTINCT coalesce(CAT3_NAME, 'NULL_VALUE')) AS BIGINT) AS n_CAT3_NAME,
       CAST(count(DISTINCT coalesce(MAKER, 'NULL_VALUE')) AS BIGINT) AS n_MAKER,
       CAST(count(DISTINCT coalesce(TRADEMARK, 'NULL_VALUE')) AS BIGINT) AS n_TRADEMARK,
       CAST(count(DISTINCT CAST(IN_SOT AS VARCHAR)) AS BIGINT) AS n_IN_SOT
FROM b GROUP BY 1, 2
HAVING n_NAME > 1 OR n_CAT1_NAME > 1 OR n_CAT2_NAME > 1 OR n_CAT3_NAME > 1 OR n_MAKER > 1
    OR n_TRADEMARK > 1 OR n_IN_SOT > 1""")
def uniformity_check(spark: SparkSession, sf: str) -> DataFrame:
    base = C.with_membership(S.catalog_base(spark, sf), S.sot(spark, sf))
    return C.uniformity(base)


def assembled_base(spark: SparkSession, sf: str, feed: DataFrame | None = None) -> DataFrame:
    """The catalog before metrics, from the raw tables (JN-2, JN-3, FLT-3, FLT-4)."""
    rp, mp, rp_side, mp_side = (make(spark, sf) for make in (S.retailer_products, S.master_products, S.rp_analytics, S.mp_analytics))
    if feed is not None:
        return C.feed_base(rp, mp, rp_side, mp_side, feed)
    return C.catalog_base(C.sell_and_presentation(rp, mp), rp_side, mp_side)


@query("catalog_assembly", oracle="WITH " + S.ASSEMBLED_SQL + """
SELECT RETAILER_ID, NAME, CAT1_NAME, CAT2_NAME, CAT3_NAME, MAKER, TRADEMARK, EAN, QUALITY_LABEL, PRIORITY, COUNTRY, SKU, PRODUCT_ID,
       MASTER_PRODUCT_ID, MAX_QUANT, MIN_QUANT, STEP_QUANT, SELL_TYPE, PRESENTATION, QUANTITY_RP, UNITY_P,
       CAST(ASSOCIATED_RETAILERS AS BIGINT) AS ASSOCIATED_RETAILERS, MP_PHOTO_URL
FROM catalog_base""")
def catalog_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-1 up to the metrics: every live RP with a name and a photo, its variant paths and both analytics sides."""
    return assembled_base(spark, sf)


def metric_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Fill and defect rates from one scan: the lines of the longer window (fill rate) are kept, both read these."""
    lines = stored(S.order_lines(spark, sf).where(M.on_or_after("CREATED_AT_ORDER", M.week_window_start(S.AS_OF, 12))), "lines")
    return (M.fill_rate(lines, S.AS_OF, with_orders=False),
            M.defect_rate(S.order_products(spark, sf, lines), S.tickets(spark, sf), S.AS_OF, reasons=S.TICKET_REASONS, join_keys=("ORDER_ID",)))


def catalog_rps(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-1 + PIP-2 on the stand-ins: the enriched RP catalog."""
    fill, defects = metric_inputs(spark, sf)
    feed = stored(M.feed_snapshot(S.feed(spark, sf), S.AS_OF), "snapshot")
    cat = C.assemble_catalog(assembled_base(spark, sf, feed), fill, defects, feed, S.sot(spark, sf))
    return C.enrich_retailer_products(cat)


@query("catalog_enriched", oracle="WITH " + Q.ALL_INPUTS + "," + Q.CATALOG_RP + """
SELECT COUNTRY, PRODUCT_ID, MASTER_PRODUCT_ID, NAME, NAME_INT, IN_SOT, round(FR, 8) AS FR,
       CAST(TOTAL_PRODUCTS AS BIGINT) AS TOTAL_PRODUCTS, round(GMV_TOTAL, 6) AS GMV_TOTAL, PRODUCT_DR,
       round(MEDIAN_PRICE, 6) AS MEDIAN_PRICE, CAST(N_ASSOCIATED_RETAILERS AS BIGINT) AS N_ASSOCIATED_RETAILERS,
       round(SIMILARITY, 8) AS SIMILARITY, SUGGESTED_QUANTITY, SUGGESTED_UNITYPE, PRICE_PER_KG
FROM rp""")
def catalog_enriched(spark: SparkSession, sf: str) -> DataFrame:
    rp = catalog_rps(spark, sf)
    return rp.select("COUNTRY", "PRODUCT_ID", "MASTER_PRODUCT_ID", "NAME", "NAME_INT", "IN_SOT",
                     F.round("FR", 8).alias("FR"), "TOTAL_PRODUCTS", F.round("GMV_TOTAL", 6).alias("GMV_TOTAL"),
                     "PRODUCT_DR", F.round("MEDIAN_PRICE", 6).alias("MEDIAN_PRICE"), "N_ASSOCIATED_RETAILERS",
                     F.round("SIMILARITY", 8).alias("SIMILARITY"), "SUGGESTED_QUANTITY", "SUGGESTED_UNITYPE",
                     "PRICE_PER_KG")


@query("owned_catalog", oracle="WITH " + Q.ALL_INPUTS + "," + Q.CATALOG_RP.split("rp0 AS")[0] + """
links AS (SELECT DISTINCT n_name AS COUNTRY_CODE, s_suppkey AS CP_RETAILER_ID FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 <> 0)
SELECT COUNTRY, PRODUCT_ID, RETAILER_ID, QUALITY_LABEL, NAME_INT, IN_SOT
FROM cat WHERE EXISTS (SELECT 1 FROM links WHERE COUNTRY_CODE = COUNTRY AND CP_RETAILER_ID = RETAILER_ID)""")
def owned_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """JN-14: assembly with the optional join that keeps retailers with an owner only (all RPs, with a feed name or not)."""
    fill, defects = metric_inputs(spark, sf)
    owners = M.owner_list(S.store_links(spark, sf).where("CP_RETAILER_ID % 3 <> 0"))
    cat = C.assemble_catalog(assembled_base(spark, sf), fill, defects, M.feed_snapshot(S.feed(spark, sf), S.AS_OF), S.sot(spark, sf), owners=owners)
    return cat.select("COUNTRY", "PRODUCT_ID", "RETAILER_ID", "QUALITY_LABEL", "NAME_INT", "IN_SOT")


def rollup(spark: SparkSession, sf: str) -> DataFrame:
    # The enriched rows feed the sums and the medians: compute them once (R7).
    return C.rollup_products(C.fill_keys(materialize(catalog_rps(spark, sf))))


ROLLUP_SELECT = """
SELECT COUNTRY, NAME, MASTER_PRODUCT_ID, CAT1_NAME, CAT2_NAME, CAT3_NAME, MAKER, TRADEMARK, IN_SOT,
       round(M_FR, 8) AS M_FR, round(PRODUCT_DR, 8) AS PRODUCT_DR, CAST(TOTAL_PRODUCTS AS BIGINT) AS TOTAL_PRODUCTS,
       CAST(COUNT_REPLACED AS BIGINT) AS COUNT_REPLACED, round(GMV_T, 6) AS GMV_T,
       CAST(N_ASSOCIATED_RETAILERS AS BIGINT) AS N_ASSOCIATED_RETAILERS, round(SIMILARITY, 8) AS SIMILARITY,
       round(MEDIAN_PRICE, 6) AS MEDIAN_PRICE
FROM mps"""


@query("mp_rollup", oracle="WITH " + Q.ALL_INPUTS + "," + Q.CATALOG_RP + "," + Q.ROLLUP + ROLLUP_SELECT)
def mp_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rollup_columns(rollup(spark, sf))


def rollup_columns(m: DataFrame) -> DataFrame:
    return m.select(*C.ROLLUP_KEYS, F.round("M_FR", 8).alias("M_FR"), F.round("PRODUCT_DR", 8).alias("PRODUCT_DR"),
                    F.col("TOTAL_PRODUCTS").cast("bigint").alias("TOTAL_PRODUCTS"),
                    F.col("COUNT_REPLACED").cast("bigint").alias("COUNT_REPLACED"),
                    F.round("GMV_T", 6).alias("GMV_T"), "N_ASSOCIATED_RETAILERS",
                    F.round("SIMILARITY", 8).alias("SIMILARITY"), F.round("MEDIAN_PRICE", 6).alias("MEDIAN_PRICE"))


@query("budget_prefix", oracle=f"""
WITH g AS (SELECT n.n_name AS COUNTRY, l.l_partkey AS MASTER_PRODUCT_ID, sum(l.l_extendedprice) AS GMV_T,
                  count(DISTINCT (l.l_partkey << 32) + l.l_suppkey) AS N_ASSOCIATED_RETAILERS
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
           GROUP BY 1, 2),
c AS (SELECT *, 100 * GMV_T / sum(GMV_T) OVER (PARTITION BY COUNTRY) AS gmv_coverage FROM g),
r AS (SELECT *, sum(N_ASSOCIATED_RETAILERS) OVER (PARTITION BY COUNTRY ORDER BY round(gmv_coverage, 10) DESC,
                 MASTER_PRODUCT_ID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_retailers FROM c)
SELECT COUNTRY, MASTER_PRODUCT_ID, round(GMV_T, 6) AS GMV_T, CAST(N_ASSOCIATED_RETAILERS AS BIGINT) AS N_ASSOCIATED_RETAILERS,
       round(gmv_coverage, 8) AS gmv_coverage, CAST(cumulative_retailers AS BIGINT) AS cumulative_retailers
FROM r WHERE cumulative_retailers - N_ASSOCIATED_RETAILERS <= {BUDGET}""")
def budget_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-3..5 with R3 on whole lineitem: per nation, parts by GMV share
    while the running count of retailer products stays within the budget."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")
    c = S._country(spark, sf).select("s_suppkey", "COUNTRY")
    j = li.join(c, li.l_suppkey == c.s_suppkey)
    g = j.groupBy("COUNTRY", F.col("l_partkey").alias("MASTER_PRODUCT_ID")).agg(
        F.sum("l_extendedprice").alias("GMV_T"),
        F.count_distinct(S.rp_id(F.col("l_partkey"), F.col("l_suppkey"))).alias("N_ASSOCIATED_RETAILERS"))
    g = R.share_of_total(g, "GMV_T", "gmv_coverage", ["COUNTRY"])
    g = g.withColumn("_rank_by", F.round("gmv_coverage", 10))
    out = R.budget_prefix(g, rank_by="_rank_by", amount="N_ASSOCIATED_RETAILERS", budget=BUDGET,
                          tie="MASTER_PRODUCT_ID", partition=["COUNTRY"])
    return out.select("COUNTRY", "MASTER_PRODUCT_ID", F.round("GMV_T", 6).alias("GMV_T"), "N_ASSOCIATED_RETAILERS",
                      F.round("gmv_coverage", 8).alias("gmv_coverage"),
                      F.col("cumulative_retailers").cast("bigint").alias("cumulative_retailers"))
