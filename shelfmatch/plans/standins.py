"""The reference's input tables, derived from the test tables (FIXTURES.md part B).

Every builder returns a lazy DataFrame over the whole test tables; the same
definition is given as SQL text (``*_SQL``) for the DuckDB oracles, so both
sides start from identical inputs.

Roles: country = supplier's nation name; master product (MP) = part;
retailer product (RP) = distinct (l_partkey, l_suppkey) with id
``(l_partkey << 32) + l_suppkey``; order line = lineitem ⋈ orders with
STOCKOUT = returnflag 'R' and SUBSTITUTED = linestatus 'F'; ticket = event
(``event_id`` as order id, ``event_type`` as reason); feed row = lineitem
line with a retailer-style name (part name, size and a unit); curated set
(SOT) = parts of type PROMO.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.session import spread
from shelfmatch.sources.tables import table

# One clock for every stage, as CURRENT_DATE is one clock in the reference:
# the last order date of the test data.
AS_OF = dt.date(2001, 8, 1)
AS_OF_SQL = "DATE '2001-08-01'"
# Ticket reasons that count as defects in the stand-in.
TICKET_REASONS = ("error",)
# Fixed unit per part type for feed names (exercises SC-19/SC-20 variants).
UNIT_BY_TYPE = {"STANDARD": " ml", "MEDIUM": "G", "ECONOMY": " kg", "LARGE": "L",
                "SMALL": " Unidades", "PROMO": "kg"}


def _unit_expr():
    e = F.lit("")
    for k, v in UNIT_BY_TYPE.items():
        e = F.when(F.col("p_type") == k, F.lit(v)).otherwise(e)
    return e


def _unit_sql() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in UNIT_BY_TYPE.items())
    return f"CASE p.p_type {whens} ELSE '' END"


def rp_id(partkey, suppkey):
    return F.shiftleft(partkey.cast("bigint"), 32) + suppkey.cast("bigint")


#: Suppliers that are broadcast to their lines at most (some 80 bytes each); more are joined by a shuffle.
BROADCAST_SUPPLIERS = 1_000_000


def _country(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    out = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey"), F.col("s_name"), F.col("n_name").alias("COUNTRY"))
    # Spark takes a joined table for too large to broadcast, and would shuffle every line for it: counted instead.
    return F.broadcast(out) if s.count() <= BROADCAST_SUPPLIERS else out


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                             "l_returnflag", "l_linestatus", "l_extendedprice")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    c = _country(spark, sf)
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, li.l_suppkey == c.s_suppkey)
    return j.select(
        "COUNTRY", rp_id(F.col("l_partkey"), F.col("l_suppkey")).alias("PRODUCT_ID"),
        F.col("l_orderkey").alias("ORDER_ID"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("STOCKOUT"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("SUBSTITUTED"),
        F.col("l_extendedprice").alias("TOTAL_PRICE"), F.col("o_orderdate").alias("CREATED_AT_ORDER"))


ORDER_LINES_SQL = """
order_lines AS (
  SELECT n.n_name AS COUNTRY, (l.l_partkey << 32) + l.l_suppkey AS PRODUCT_ID, l.l_orderkey AS ORDER_ID,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS STOCKOUT,
         CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS SUBSTITUTED,
         l.l_extendedprice AS TOTAL_PRICE, o.o_orderdate AS CREATED_AT_ORDER
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


def order_products(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """Products of orders, from ``lines`` where the order lines are at hand already."""
    ol = order_lines(spark, sf) if lines is None else lines
    return ol.select("COUNTRY", F.col("PRODUCT_ID").alias("PID"), "ORDER_ID",
                     F.col("CREATED_AT_ORDER").alias("DT_REF"))


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return ev.select(F.col("event_id").alias("ORDER_ID"), F.col("event_type").alias("LEVEL_2"))


def feed(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                             "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    c = _country(spark, sf)
    j = li.join(p, li.l_partkey == p.p_partkey).join(c, li.l_suppkey == c.s_suppkey)
    return j.select(
        "COUNTRY", rp_id(F.col("l_partkey"), F.col("l_suppkey")).cast("string").alias("RETAIL_ID"),
        F.concat_ws(" ", "p_name", F.concat(F.col("p_size").cast("string"), _unit_expr())).alias("NAME"),
        F.col("p_type").alias("DESCRIPTION"), F.col("p_brand").alias("TRADEMARK"),
        F.col("l_extendedprice").alias("PRICE"),
        F.concat(F.lit("img/"), F.col("p_partkey").cast("string")).alias("IMAGE_URL"),
        F.col("l_quantity").alias("QUANTITY"), F.col("l_returnflag").alias("UNIT_TYPE"),
        F.col("l_discount").alias("MIN_QUANTITY_IN_GRAMS"), F.col("l_tax").alias("STEP_QUANTITY_IN_GRAMS"),
        F.col("l_shipdate").alias("EXECUTION_DATE"))


FEED_SQL = f"""
feed AS (
  SELECT n.n_name AS COUNTRY, CAST((l.l_partkey << 32) + l.l_suppkey AS VARCHAR) AS RETAIL_ID,
         p.p_name || ' ' || CAST(p.p_size AS VARCHAR) || {_unit_sql()} AS NAME,
         p.p_type AS DESCRIPTION, p.p_brand AS TRADEMARK, l.l_extendedprice AS PRICE,
         'img/' || CAST(p.p_partkey AS VARCHAR) AS IMAGE_URL, l.l_quantity AS QUANTITY,
         l.l_returnflag AS UNIT_TYPE, l.l_discount AS MIN_QUANTITY_IN_GRAMS, l.l_tax AS STEP_QUANTITY_IN_GRAMS,
         l.l_shipdate AS EXECUTION_DATE
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


def catalog_base(spark: SparkSession, sf: str) -> DataFrame:
    """CATALOG_COUNTRY stand-in: one row per RP with its MP attributes."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    c = _country(spark, sf)
    j = li.join(p, li.l_partkey == p.p_partkey).join(c, li.l_suppkey == c.s_suppkey)
    return j.select(
        F.col("l_suppkey").alias("RETAILER_ID"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("NAME"),
        F.col("p_type").alias("CAT1_NAME"),
        F.when(F.col("p_size") < 25, "S").otherwise("L").alias("CAT2_NAME"),
        F.when(F.col("l_suppkey") % 7 == 0, "special").otherwise(F.col("p_size").cast("string")).alias("CAT3_NAME"),
        F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_brand")).alias("MAKER"),
        F.col("p_brand").alias("TRADEMARK"),
        "COUNTRY",
        rp_id(F.col("l_partkey"), F.col("l_suppkey")).cast("string").alias("SKU"),
        rp_id(F.col("l_partkey"), F.col("l_suppkey")).alias("PRODUCT_ID"),
        F.col("l_partkey").alias("MASTER_PRODUCT_ID"),
        F.when(F.col("p_size") < 10, "U").otherwise("W").alias("SELL_TYPE"),
        F.concat(F.lit("photo/"), F.col("p_partkey").cast("string")).alias("MP_PHOTO_URL"),
        F.col("p_partkey").cast("string").alias("EAN"),
        (F.col("p_size") * 2).cast("double").alias("MAX_QUANT"),
        F.lit(1.0).alias("MIN_QUANT"),
        F.when(F.col("p_size") < 10, 1.0).otherwise(0.5).alias("STEP_QUANT"),
        F.col("p_type").alias("PRESENTATION"),
        F.col("p_size").cast("double").alias("QUANTITY_RP"),
        F.when(F.col("p_size") < 10, "un").otherwise("kg").alias("UNITY_P"))


CATALOG_BASE_SQL = """
catalog_base AS (
  SELECT l.l_suppkey AS RETAILER_ID, p.p_name || ' ' || p.p_type || ' ' || p.p_brand AS NAME,
         p.p_type AS CAT1_NAME, CASE WHEN p.p_size < 25 THEN 'S' ELSE 'L' END AS CAT2_NAME,
         CASE WHEN l.l_suppkey % 7 = 0 THEN 'special' ELSE CAST(p.p_size AS VARCHAR) END AS CAT3_NAME,
         CASE WHEN p.p_size > 45 THEN NULL ELSE p.p_brand END AS MAKER, p.p_brand AS TRADEMARK,
         n.n_name AS COUNTRY, CAST((l.l_partkey << 32) + l.l_suppkey AS VARCHAR) AS SKU,
         (l.l_partkey << 32) + l.l_suppkey AS PRODUCT_ID, l.l_partkey AS MASTER_PRODUCT_ID,
         CASE WHEN p.p_size < 10 THEN 'U' ELSE 'W' END AS SELL_TYPE,
         'photo/' || CAST(p.p_partkey AS VARCHAR) AS MP_PHOTO_URL,
         CAST(p.p_partkey AS VARCHAR) AS EAN, CAST(p.p_size * 2 AS DOUBLE) AS MAX_QUANT, CAST(1.0 AS DOUBLE) AS MIN_QUANT,
         CAST(CASE WHEN p.p_size < 10 THEN 1.0 ELSE 0.5 END AS DOUBLE) AS STEP_QUANT, p.p_type AS PRESENTATION,
         CAST(p.p_size AS DOUBLE) AS QUANTITY_RP, CASE WHEN p.p_size < 10 THEN 'un' ELSE 'kg' END AS UNITY_P
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


# The semi-structured columns as SQL text that both engines read alike. An RP has all paths, none (no value), or a
# JSON null, a number as text and a missing type, so that the MP's value comes through path by path.
_RP_SELL_TYPE = """CASE WHEN l_partkey % 5 = 0 THEN CAST(NULL AS STRING)
     WHEN l_suppkey % 11 = 0 THEN concat('{"maxQuantity": null, "stepQuantity": "', CASE WHEN p_size < 10 THEN '1.0' ELSE '0.25' END, '"}')
     ELSE concat('{"type": "', CASE WHEN p_size < 10 THEN 'U' ELSE 'W' END, '", "maxQuantity": ', CAST(p_size * 2 + l_suppkey % 3 AS STRING),
                 ', "minQuantity": 1, "stepQuantity": ', CASE WHEN p_size < 10 THEN '1.0' ELSE '0.5' END, '}') END"""
_MP_SELL_TYPE = """CASE WHEN p_partkey % 19 = 0 THEN '{"type": null}'
     ELSE concat('{"type": "', CASE WHEN p_size < 10 THEN 'U' ELSE 'W' END, '", "maxQuantity": ', CAST(p_size * 2 AS STRING), ', "minQuantity": 1.5}') END"""
_RP_PRESENTATION = """CASE WHEN (l_partkey + l_suppkey) % 3 = 0 THEN CAST(NULL AS STRING)
     ELSE concat('{"description": "', p_type, ' ', CAST(p_size AS STRING), '", "quantity": ', CAST(p_size AS STRING), '}') END"""
_MP_PRESENTATION = """concat('{"description": "', p_type, '", "quantity": ', CAST(p_size + 1 AS STRING), ', "unitType": "',
     CASE WHEN p_size < 10 THEN 'un' ELSE 'kg' END, '"}')"""
_RP_STATUS = "CASE WHEN (l_partkey + l_suppkey) % 23 = 0 THEN 'draft' ELSE 'published' END"
_MP_STATUS = "CASE WHEN p_partkey % 31 = 0 THEN 'draft' ELSE 'published' END"
_RP_DELETED = "(l_partkey * 3 + l_suppkey) % 29 = 0"
_MP_DELETED = "CASE WHEN p_partkey % 41 = 0 THEN CAST(NULL AS BOOLEAN) ELSE p_partkey % 37 = 0 END"
_CAT2 = "CASE WHEN p_size < 25 THEN 'S' ELSE 'L' END"
_CAT3 = "CASE WHEN l_suppkey % 7 = 0 THEN 'special' ELSE CAST(p_size AS STRING) END"
_MAKER = "CASE WHEN p_size > 45 THEN NULL ELSE p_brand END"
_MP_NAME = "CASE WHEN (l_partkey + l_suppkey) % 43 = 0 THEN CAST(NULL AS STRING) ELSE concat(p_name, ' ', p_type, ' ', p_brand) END"
_MP_PHOTO = "CASE WHEN l_partkey % 17 = 5 THEN CAST(NULL AS STRING) ELSE concat('photo/', CAST(p_partkey AS STRING)) END"
_QUALITY = "CASE WHEN l_partkey % 3 = 0 THEN 'gold' ELSE 'plain' END"


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (part, supplier) with the supplier's country, hashed by part: the part's own columns and
    the distinct parts of a country then need no other shuffle."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").repartition("l_partkey").distinct()
    c = _country(spark, sf).select("s_suppkey", "COUNTRY")
    return li.join(c, li.l_suppkey == c.s_suppkey).drop("s_suppkey")


def _with_part(pairs: DataFrame, spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", *cols)
    return pairs.join(p, pairs.l_partkey == p.p_partkey)


def retailer_products(spark: SparkSession, sf: str) -> DataFrame:
    """Retailer products with VARIANT columns; drafts and deleted rows among them."""
    rp = rp_id(F.col("l_partkey"), F.col("l_suppkey"))
    return _with_part(_pairs(spark, sf), spark, sf, "p_type", "p_size").select(
        "COUNTRY", rp.alias("ID"), F.col("l_partkey").alias("PRODUCT_ID"), rp.cast("string").alias("SKU"),
        F.parse_json(F.expr(_RP_SELL_TYPE)).alias("SELL_TYPE"), F.parse_json(F.expr(_RP_PRESENTATION)).alias("PRESENTATION"),
        F.expr(_RP_STATUS).alias("STATUS"), F.expr(_RP_DELETED).alias("IS_DELETED"))


def master_products(spark: SparkSession, sf: str) -> DataFrame:
    """Master products of each country, with VARIANT columns; drafts, deleted rows and unknown flags among them."""
    own = _pairs(spark, sf).select("COUNTRY", "l_partkey").distinct()
    return _with_part(own, spark, sf, "p_type", "p_size").select(
        "COUNTRY", F.col("p_partkey").alias("ID"), F.parse_json(F.expr(_MP_SELL_TYPE)).alias("SELL_TYPE"),
        F.parse_json(F.expr(_MP_PRESENTATION)).alias("PRESENTATION"), F.expr(_MP_STATUS).alias("STATUS"), F.expr(_MP_DELETED).alias("IS_DELETED"))


def rp_analytics(spark: SparkSession, sf: str, cat3: str = _CAT3) -> DataFrame:
    """Names, categories and photos by retailer product; some names and photos are null."""
    cols = {"RETAILER_ID": "l_suppkey", "MP_NAME": _MP_NAME, "CAT1_NAME": "p_type", "CAT2_NAME": _CAT2, "CAT3_NAME": cat3, "MAKER": _MAKER,
            "TRADEMARK": "p_brand", "EAN": "CAST(p_partkey AS STRING)", "MP_PHOTO_URL": _MP_PHOTO}
    j = _with_part(_pairs(spark, sf), spark, sf, "p_name", "p_brand", "p_type", "p_size")
    return j.select("COUNTRY", rp_id(F.col("l_partkey"), F.col("l_suppkey")).alias("RETAILER_PRODUCT_ID"), *[F.expr(e).alias(n) for n, e in cols.items()])


def mp_analytics(spark: SparkSession, sf: str) -> DataFrame:
    """Label, priority and retailers by master product of a country; some products have no row."""
    own = _pairs(spark, sf).where("l_partkey % 13 <> 0").groupBy("COUNTRY", "l_partkey").agg(F.count(F.lit(1)).alias("ASSOCIATED_RETAILERS"))
    return own.select("COUNTRY", F.col("l_partkey").alias("MASTER_PRODUCT_ID"), F.expr(_QUALITY).alias("QUALITY_LABEL"),
                      F.expr("l_partkey % 4").alias("PRIORITY"), "ASSOCIATED_RETAILERS")


def _path(column: str, path: str, number: bool = False) -> str:
    got = ", ".join(f"{side}.{column} ->> '$.{path}'" for side in ("rp", "mp"))
    if number:
        got = ", ".join(f"TRY_CAST({side}.{column} ->> '$.{path}' AS DOUBLE)" for side in ("rp", "mp"))
    return f"coalesce({got})"


_LIVE_SQL = """FROM retailer_product rp LEFT JOIN master_product mp ON mp.ID = rp.PRODUCT_ID AND mp.COUNTRY = rp.COUNTRY
  WHERE rp.STATUS = 'published' AND mp.STATUS = 'published' AND rp.IS_DELETED = FALSE AND mp.IS_DELETED = FALSE"""

# Assembly as two separate scans of RP x MP joined on three keys, each DISTINCT: the plain reading of the step.
ASSEMBLED_SQL = f"""
own AS (SELECT l.l_partkey, l.l_suppkey, n.n_name AS COUNTRY, (l.l_partkey << 32) + l.l_suppkey AS rp_id, p.*
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey),
retailer_product AS (SELECT COUNTRY, rp_id AS ID, l_partkey AS PRODUCT_ID, CAST(rp_id AS VARCHAR) AS SKU, {_RP_SELL_TYPE} AS SELL_TYPE,
  {_RP_PRESENTATION} AS PRESENTATION, {_RP_STATUS} AS STATUS, {_RP_DELETED} AS IS_DELETED FROM own),
master_product AS (SELECT DISTINCT COUNTRY, p_partkey AS ID, {_MP_SELL_TYPE} AS SELL_TYPE, {_MP_PRESENTATION} AS PRESENTATION,
  {_MP_STATUS} AS STATUS, {_MP_DELETED} AS IS_DELETED FROM own),
analytics_rp AS (SELECT COUNTRY, rp_id AS RETAILER_PRODUCT_ID, l_suppkey AS RETAILER_ID, {_MP_NAME} AS MP_NAME, p_type AS CAT1_NAME, {_CAT2} AS CAT2_NAME,
  {_CAT3} AS CAT3_NAME, {_MAKER} AS MAKER, p_brand AS TRADEMARK, CAST(p_partkey AS VARCHAR) AS EAN, {_MP_PHOTO} AS MP_PHOTO_URL FROM own),
analytics_mp AS (SELECT COUNTRY, l_partkey AS MASTER_PRODUCT_ID, {_QUALITY} AS QUALITY_LABEL, l_partkey % 4 AS PRIORITY, count(*) AS ASSOCIATED_RETAILERS
  FROM own WHERE l_partkey % 13 <> 0 GROUP BY COUNTRY, l_partkey),
live_st AS (SELECT DISTINCT mp.COUNTRY, rp.SKU, rp.ID AS PRODUCT_ID, rp.PRODUCT_ID AS MASTER_PRODUCT_ID, {_path('SELL_TYPE', 'maxQuantity', True)} AS MAX_QUANT,
  {_path('SELL_TYPE', 'minQuantity', True)} AS MIN_QUANT, {_path('SELL_TYPE', 'stepQuantity', True)} AS STEP_QUANT, {_path('SELL_TYPE', 'type')} AS SELL_TYPE
  {_LIVE_SQL}),
live_pr AS (SELECT DISTINCT mp.COUNTRY, rp.SKU, rp.ID AS PRODUCT_ID, rp.PRODUCT_ID AS MASTER_PRODUCT_ID, {_path('PRESENTATION', 'description')} AS PRESENTATION,
  {_path('PRESENTATION', 'quantity', True)} AS QUANTITY, {_path('PRESENTATION', 'unitType')} AS UNITY_P {_LIVE_SQL}),
catalog_base AS (SELECT DISTINCT cp.RETAILER_ID, cp.MP_NAME AS NAME, cp.CAT1_NAME, cp.CAT2_NAME, cp.CAT3_NAME, cp.MAKER, cp.TRADEMARK, cp.EAN,
    m.QUALITY_LABEL, m.PRIORITY, st.*, pr.PRESENTATION, pr.QUANTITY AS QUANTITY_RP, pr.UNITY_P, m.ASSOCIATED_RETAILERS, cp.MP_PHOTO_URL
  FROM live_st st LEFT JOIN live_pr pr ON st.COUNTRY = pr.COUNTRY AND st.PRODUCT_ID = pr.PRODUCT_ID AND st.MASTER_PRODUCT_ID = pr.MASTER_PRODUCT_ID
  LEFT JOIN analytics_rp cp ON st.PRODUCT_ID = cp.RETAILER_PRODUCT_ID AND st.COUNTRY = cp.COUNTRY
  LEFT JOIN analytics_mp m ON m.COUNTRY = st.COUNTRY AND m.MASTER_PRODUCT_ID = st.MASTER_PRODUCT_ID
  WHERE cp.MP_PHOTO_URL IS NOT NULL AND cp.MP_NAME IS NOT NULL)"""


# Third categories that retailers of one MP give differently in some countries only (for the gate).
CAT3_SOME = "CASE WHEN l_suppkey % 2 = 0 AND COUNTRY < 'NATION_16' THEN 'special' ELSE CAST(p_size AS STRING) END"
ASSEMBLED_SOME_SQL = ASSEMBLED_SQL.replace(_CAT3, CAT3_SOME)
_CURATED = "(p_type = 'PROMO' AND l_partkey % 3 <> 0) OR (p_type IN ('ECONOMY', 'SMALL') AND length(COUNTRY) % 2 = 0)"
_CURATED_DELETED = "CASE WHEN l_partkey % 11 = 0 THEN CAST(NULL AS BOOLEAN) ELSE l_partkey % 7 = 0 END"


def curated(spark: SparkSession, sf: str) -> DataFrame:
    """Curated MPs of each country: an id may be curated in one and not in another; some entries are deleted."""
    own = _with_part(_pairs(spark, sf).select("COUNTRY", "l_partkey").distinct(), spark, sf, "p_type")
    return own.where(_CURATED).select("COUNTRY", F.col("l_partkey").alias("MASTER_PRODUCT"), F.expr(_CURATED_DELETED).alias("IS_DELETED"))


CURATED_SQL = f"""
curated AS (SELECT DISTINCT COUNTRY, l_partkey AS MASTER_PRODUCT, {_CURATED_DELETED} AS IS_DELETED FROM own WHERE {_CURATED}),
sot AS (SELECT DISTINCT COUNTRY, MASTER_PRODUCT AS MASTER_PRODUCT_ID FROM curated WHERE IS_DELETED = FALSE)"""


def sot(spark: SparkSession, sf: str) -> DataFrame:
    """Curated MPs: distinct part keys of type PROMO (not deleted)."""
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return p.where(F.col("p_type") == "PROMO").select(F.col("p_partkey").alias("MASTER_PRODUCT_ID")).distinct()


SOT_SQL = """
sot AS (SELECT DISTINCT p_partkey AS MASTER_PRODUCT_ID FROM part WHERE p_type = 'PROMO')"""


def store_links(spark: SparkSession, sf: str) -> DataFrame:
    c = _country(spark, sf)
    return c.select(F.col("COUNTRY").alias("COUNTRY_CODE"), F.col("s_suppkey").alias("CP_RETAILER_ID"),
                    F.col("s_name").alias("TAM"))


def conversation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Adjacent turns of each conversation as (a, b) text pairs, whole texts.

    Written as an equi-join on (conv_id, turn + 1) rather than ``lead`` over
    a conversation window, so a very long conversation is spread by the
    join's hash on both keys instead of landing in one task.
    """
    cv = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    a = spread(cv.select("conv_id", "turn", F.col("text").alias("text_a")), "conv_id", "turn")
    b = spread(cv.select(F.col("conv_id").alias("_c"), (F.col("turn") - 1).alias("_t"), F.col("text").alias("text_b")),
               "_c", "_t")
    return a.join(b, (a.conv_id == b._c) & (a.turn == b._t)).select("conv_id", "turn", "text_a", "text_b")


PAIRS_SQL = """
pairs AS (SELECT a.conv_id, a.turn, a.text AS text_a, b.text AS text_b
          FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Master product table (the export's info lookup): one row per part."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return p.select(F.col("p_partkey").alias("MASTER_PRODUCT_ID"),
                    F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("NAME"),
                    F.col("p_type").alias("LONG_DESCRIPTION"),
                    F.when(F.col("p_size") < 10, "U").otherwise("W").alias("SALE_TYPE"),
                    F.when(F.col("p_size") < 10, "un").otherwise("kg").alias("UNIT_TYPE"),
                    F.col("p_size").cast("double").alias("QUANTITY"),
                    F.when(F.col("p_size") < 10, 1.0).otherwise(0.5).alias("STEP_QUANT"))
