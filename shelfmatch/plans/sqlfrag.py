"""DuckDB SQL fragments mirroring the Spark column functions (oracle side only)."""

from __future__ import annotations

from shelfmatch.functions import text as T
from shelfmatch.plans import standins as S

STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in T.stop_words("portuguese")) + "]"
TOK = r"'[\p{L}\p{N}_]{2,}'"
# DuckDB's levenshtein counts bytes; the accented letters of the data are
# mapped one-to-one onto control characters (absent from cleaned text) so
# the distance is counted in characters, as Spark does.
ACCENTED = "äçèéêíñóöüß"
CTRL = " || ".join(f"chr({i + 1})" for i in range(len(ACCENTED)))


def clean_words(c: str) -> str:
    return (r"list_filter(string_split_regex(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}\s]', '', 'g'), '\s+'), "
            r"lambda w: w <> '' AND NOT list_contains({stop}, w))").format(c=c, stop=STOP)


def fold(c: str) -> str:
    return r"""regexp_replace(regexp_replace(strip_accents(lower({c})), '[^\x00-\x7F]', '', 'g'), '[,"&]', '', 'g')""".format(c=c)


def charwise(c: str) -> str:
    return f"translate({c}, '{ACCENTED}', {CTRL})"


def _tf(lst: str, t: str) -> str:
    return f"len(list_filter({lst}, lambda x: x = {t}))"


def pair_scores(src: str, keys: str, a: str, b: str, p: str = "ps") -> str:
    """CTEs ``{p}_c .. {p}_m`` over ``src``: keys + jaccard, edit_similarity,
    cosine, name_agreement and the raw token lists ra/rb."""
    return """
{p}_c AS (SELECT {keys}, {a} AS text_a, {b} AS text_b, {wa} AS wa, {wb} AS wb FROM {src}),
{p}_s AS (SELECT *, array_to_string(wa, ' ') AS ca, array_to_string(wb, ' ') AS cb,
             list_distinct(wa) AS sa, list_distinct(wb) AS sb FROM {p}_c),
{p}_t AS (SELECT *, regexp_extract_all(ca, {tok}) AS ta, regexp_extract_all(cb, {tok}) AS tb FROM {p}_s),
{p}_u AS (SELECT {keys},
        CASE WHEN len(sa) + len(sb) - len(list_intersect(sa, sb)) > 0
             THEN len(list_intersect(sa, sb)) / (len(sa) + len(sb) - len(list_intersect(sa, sb))) END AS jaccard,
        CASE WHEN greatest(length(ca), length(cb)) > 0
             THEN 1 - levenshtein({ca2}, {cb2}) / greatest(length(ca), length(cb)) END AS edit_similarity,
        CASE WHEN len(ta) = 0 AND len(tb) = 0 THEN NULL
             WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0
             ELSE coalesce(list_sum(list_transform(list_intersect(list_distinct(ta), list_distinct(tb)),
                                                   lambda u: {tfa} * {tfb})), 0)
                  / sqrt(list_sum(list_transform(list_distinct(ta), lambda u: power({tfa} *
                           CASE WHEN list_contains(tb, u) THEN 1.0 ELSE ln(1.5) + 1 END, 2)))
                       * list_sum(list_transform(list_distinct(tb), lambda u: power({tfb} *
                           CASE WHEN list_contains(ta, u) THEN 1.0 ELSE ln(1.5) + 1 END, 2)))) END AS cosine,
        regexp_extract_all(lower(text_a), {tok}) AS ra, regexp_extract_all(lower(text_b), {tok}) AS rb
      FROM {p}_t),
{p}_m AS (SELECT *, list_aggregate(list_filter([jaccard, edit_similarity, cosine], lambda x: x IS NOT NULL),
                                   'median') AS name_agreement FROM {p}_u)""".format(
        p=p, src=src, keys=keys, a=a, b=b, wa=clean_words("text_a"), wb=clean_words("text_b"), tok=TOK,
        ca2=charwise("ca"), cb2=charwise("cb"), tfa=_tf("ta", "u"), tfb=_tf("tb", "u"))


FILL_RATE = f"""
fr AS (SELECT COUNTRY, PRODUCT_ID,
       sum(CASE WHEN STOCKOUT = 0 THEN 1 ELSE 0 END) AS COUNT_FOUND,
       sum(CASE WHEN SUBSTITUTED = 1 THEN 1 ELSE 0 END) AS COUNT_REPLACED,
       sum(CASE WHEN STOCKOUT = 1 AND SUBSTITUTED = 0 THEN 1 ELSE 0 END) AS COUNT_REFUNDED,
       COUNT_FOUND + COUNT_REPLACED + COUNT_REFUNDED AS TOTAL_PRODUCTS,
       CASE WHEN TOTAL_PRODUCTS = 0 THEN NULL ELSE COUNT_FOUND / TOTAL_PRODUCTS END AS FR,
       sum(coalesce(TOTAL_PRICE, 0)) AS GMV_TOTAL
  FROM order_lines
  WHERE CAST(CREATED_AT_ORDER AS DATE) >= date_trunc('week', {S.AS_OF_SQL}) - INTERVAL 12 WEEK
  GROUP BY 1, 2)"""

DEFECT_RATE = f"""
dr AS (SELECT a.COUNTRY, a.PRODUCT_ID AS PID, round(count(b.event_id) / count(1), 4) AS PRODUCT_DR
  FROM order_lines a LEFT JOIN events b ON a.ORDER_ID = b.event_id AND b.event_type IN ('error')
  WHERE a.CREATED_AT_ORDER >= {S.AS_OF_SQL} - INTERVAL 30 DAY
  GROUP BY 1, 2 HAVING round(count(b.event_id) / count(1), 4) > 0)"""

FEED_SNAPSHOT = f"""
fd AS (SELECT COUNTRY, RETAIL_ID, max(NAME) AS NAME, max(DESCRIPTION) AS DESCRIPTION, max(TRADEMARK) AS TRADEMARK,
       median(PRICE) AS MEDIAN_PRICE, max(IMAGE_URL) AS IMAGE_URL, max(QUANTITY) AS QUANTITY,
       max(UNIT_TYPE) AS UNIT_TYPE, max(MIN_QUANTITY_IN_GRAMS) AS MIN_QUANTITY_IN_GRAMS,
       max(STEP_QUANTITY_IN_GRAMS) AS STEP_QUANTITY_IN_GRAMS
  FROM feed WHERE NAME IS NOT NULL AND CAST(EXECUTION_DATE AS DATE) > {S.AS_OF_SQL} - INTERVAL 15 DAY
  GROUP BY 1, 2)"""

# RP catalog after assembly (PIP-1) and the feed-name filter, with enrichment (PIP-2).
CATALOG_RP = """
cat AS (SELECT b.*, dr.PRODUCT_DR, fr.FR, fr.TOTAL_PRODUCTS, fr.COUNT_REPLACED, fr.GMV_TOTAL,
               fd.NAME AS NAME_INT, fd.DESCRIPTION, fd.TRADEMARK AS TRADEMARK_INT, fd.MEDIAN_PRICE, fd.IMAGE_URL,
               fd.QUANTITY AS QUANTITY_INT, fd.UNIT_TYPE, fd.MIN_QUANTITY_IN_GRAMS, fd.STEP_QUANTITY_IN_GRAMS,
               sot.MASTER_PRODUCT_ID IS NOT NULL AS IN_SOT
        FROM catalog_base b
        LEFT JOIN dr ON dr.COUNTRY = b.COUNTRY AND dr.PID = b.PRODUCT_ID
        LEFT JOIN fr ON fr.COUNTRY = b.COUNTRY AND fr.PRODUCT_ID = b.PRODUCT_ID
        LEFT JOIN fd ON fd.COUNTRY = b.COUNTRY AND fd.RETAIL_ID = b.SKU
        LEFT JOIN sot ON sot.MASTER_PRODUCT_ID = b.MASTER_PRODUCT_ID
        WHERE b.SELL_TYPE NOT IN ('U') OR sot.MASTER_PRODUCT_ID IS NOT NULL),
rp0 AS (SELECT * FROM cat WHERE NAME_INT IS NOT NULL),
""" + pair_scores("rp0", "COUNTRY, PRODUCT_ID", "NAME", "NAME_INT", p="na") + r""",
rp AS (SELECT rp0.*, na_m.name_agreement AS SIMILARITY,
              count(DISTINCT rp0.PRODUCT_ID) OVER (PARTITION BY rp0.COUNTRY, rp0.MASTER_PRODUCT_ID) AS N_ASSOCIATED_RETAILERS,
              nullif(regexp_extract(rp0.NAME_INT, '(?i)(\d+\.?\d*)\s*(ML|G|KG|L|Unid.|Unid)', 1), '') AS SUGGESTED_QUANTITY,
              nullif(regexp_extract(rp0.NAME_INT, '(?i)(\d+\.?\d*)\s*(ML|G|KG|L|Unid.|Unid)', 2), '') AS SUGGESTED_UNITYPE,
              coalesce(regexp_matches(rp0.NAME_INT, '(?i)\bkg\b'), false) AS PRICE_PER_KG
       FROM rp0 JOIN na_m ON na_m.COUNTRY = rp0.COUNTRY AND na_m.PRODUCT_ID = rp0.PRODUCT_ID)"""

ROLLUP = """
mps AS (SELECT COUNTRY, coalesce(NAME, 'NULL_VALUE') AS NAME, MASTER_PRODUCT_ID,
        coalesce(CAT1_NAME, 'NULL_VALUE') AS CAT1_NAME, coalesce(CAT2_NAME, 'NULL_VALUE') AS CAT2_NAME,
        coalesce(CAT3_NAME, 'NULL_VALUE') AS CAT3_NAME, coalesce(MAKER, 'NULL_VALUE') AS MAKER,
        coalesce(TRADEMARK, 'NULL_VALUE') AS TRADEMARK, IN_SOT,
        avg(FR) AS M_FR, avg(PRODUCT_DR) AS PRODUCT_DR,
        coalesce(sum(TOTAL_PRODUCTS), 0) AS TOTAL_PRODUCTS, coalesce(sum(COUNT_REPLACED), 0) AS COUNT_REPLACED,
        coalesce(sum(GMV_TOTAL), 0) AS GMV_T, count(DISTINCT PRODUCT_ID) AS N_ASSOCIATED_RETAILERS,
        median(SIMILARITY) AS SIMILARITY, median(MEDIAN_PRICE) AS MEDIAN_PRICE
  FROM rp GROUP BY ALL)"""

ALL_INPUTS = ",".join([S.ORDER_LINES_SQL, S.FEED_SQL, S.ASSEMBLED_SQL, S.SOT_SQL, FILL_RATE, DEFECT_RATE,
                       FEED_SNAPSHOT])

# The same job with curated ids by country, and third categories that differ in some countries.
COUNTRY_INPUTS = ",".join([S.ORDER_LINES_SQL, S.FEED_SQL, S.ASSEMBLED_SOME_SQL, S.CURATED_SQL, FILL_RATE, DEFECT_RATE, FEED_SNAPSHOT])
COUNTRY_CATALOG_RP = CATALOG_RP.replace("sot.MASTER_PRODUCT_ID = b.MASTER_PRODUCT_ID", "sot.MASTER_PRODUCT_ID = b.MASTER_PRODUCT_ID AND sot.COUNTRY = b.COUNTRY")
_ATTRS = ("NAME", "CAT1_NAME", "CAT2_NAME", "CAT3_NAME", "MAKER", "TRADEMARK", "IN_SOT")
GATE = """
spread AS (SELECT COUNTRY, MASTER_PRODUCT_ID, """ + ", ".join(
    f"count(DISTINCT coalesce(CAST({a} AS VARCHAR), 'NULL_VALUE')) AS n_{a}" for a in _ATTRS) + """
  FROM rp WHERE IN_SOT GROUP BY 1, 2),
gate AS (SELECT c.COUNTRY, count(s.MASTER_PRODUCT_ID) AS n_curated,
    count(s.MASTER_PRODUCT_ID) FILTER (greatest(""" + ", ".join(f"n_{a}" for a in _ATTRS) + """) > 1) AS n_disagreeing, """ + ", ".join(
    f"count(s.MASTER_PRODUCT_ID) FILTER (n_{a} > 1) AS n_{a}" for a in _ATTRS) + """
  FROM (SELECT DISTINCT COUNTRY FROM rp) c LEFT JOIN spread s ON s.COUNTRY = c.COUNTRY GROUP BY 1)"""
