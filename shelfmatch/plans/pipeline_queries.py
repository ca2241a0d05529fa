"""Queries over the composed job on the stand-in tables (MAT-5..7, PIP-4, PIP-5, PIP-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators import catalog as C
from shelfmatch.operators import matching
from shelfmatch.plans import pipeline as PL
from shelfmatch.plans import sqlfrag as Q
from shelfmatch.plans import standins as S
from shelfmatch.plans.registry import ORACLES, query
from shelfmatch.sources.tables import curated_ids


def _run(spark: SparkSession, sf: str, **kw) -> PL.Result:
    return PL.run(PL.tables_from_testdata(spark, sf), PL.Params(as_of=S.AS_OF, defect_join_keys=("ORDER_ID",),
                                                                 reasons=S.TICKET_REASONS, **kw))


@query("match_score")
def match_score(spark: SparkSession, sf: str) -> DataFrame:
    """MAT-5 (SIM-7..13): scored top-10 pairs per curated MP, per country, with all secondary scores and the confidence."""
    r = _run(spark, sf, push_floor_below_topk=False)
    return r.scored.withColumn("similarity", F.round("similarity", 8)) \
        .withColumn("final_weighted_confidence", F.round("final_weighted_confidence", 8))


@query("prioritised_matches")
def prioritised_matches(spark: SparkSession, sf: str) -> DataFrame:
    """MAT-6 + MAT-7: best match per opportunity MP (floor 0.5, R1), GMV-ranked budget prefix."""
    r = _run(spark, sf)
    return r.prioritised.select("COUNTRY", "master_cp", "master_sot", "master_product_id", "master_product_id_sot",
                                F.round("price_similarity", 8).alias("price_similarity"),
                                F.round("similarity", 8).alias("similarity"),
                                F.round("config_similarity", 8).alias("config_similarity"),
                                F.round("gmv_coverage", 8).alias("gmv_coverage"), "cumulative_retailers")


@query("export_enriched")
def export_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-5: the 28 sheet columns per country for the prioritised matches."""
    return _run(spark, sf).sheet


@query("catalog_pipeline")
def catalog_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: the whole job end to end; the match log rows (PIP-1..7)."""
    return _run(spark, sf).log


def _gated(spark: SparkSession, sf: str):
    """Extract with curated ids by country and the gate on."""
    t = PL.tables_from_testdata(spark, sf)._replace(rp_analytics=S.rp_analytics(spark, sf, S.CAT3_SOME), sot_ids=curated_ids(S.curated(spark, sf)))
    return PL.extract(t, PL.Params(as_of=S.AS_OF, defect_join_keys=("ORDER_ID",), reasons=S.TICKET_REASONS, hold_back_disagreeing=True))


@query("gate_report", oracle="WITH " + Q.COUNTRY_INPUTS + "," + Q.COUNTRY_CATALOG_RP + "," + Q.GATE + """
SELECT *, n_disagreeing > 0 AS held_back FROM gate""")
def gate_report(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-6: every country's curated MPs, those that disagree on a roll-up key, and whether the country is held back."""
    return _gated(spark, sf).gate


@query("gated_split", oracle="WITH " + Q.COUNTRY_INPUTS + "," + Q.COUNTRY_CATALOG_RP + "," + Q.GATE + "," + Q.ROLLUP + """
SELECT m.COUNTRY, m.NAME, m.MASTER_PRODUCT_ID, m.CAT3_NAME, m.IN_SOT, round(GMV_T, 6) AS GMV_T,
       CAST(N_ASSOCIATED_RETAILERS AS BIGINT) AS N_ASSOCIATED_RETAILERS,
       CASE WHEN sot.MASTER_PRODUCT_ID IS NULL THEN 'opportunity' ELSE 'curated' END AS side
FROM mps m LEFT JOIN sot ON sot.MASTER_PRODUCT_ID = m.MASTER_PRODUCT_ID AND sot.COUNTRY = m.COUNTRY
WHERE m.COUNTRY NOT IN (SELECT COUNTRY FROM gate WHERE n_disagreeing > 0)""")
def gated_split(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-5, JN-6, JN-7, PIP-6, PIP-7: the roll-up of the countries that pass, split by their own curated sets."""
    cat = _gated(spark, sf)
    cols = ["COUNTRY", "NAME", "MASTER_PRODUCT_ID", "CAT3_NAME", "IN_SOT", F.round("GMV_T", 6).alias("GMV_T"), "N_ASSOCIATED_RETAILERS"]
    return (cat.sot_mps.select(*cols, F.lit("curated").alias("side"))
            .unionByName(cat.opportunity_mps.select(*cols, F.lit("opportunity").alias("side"))))


_RID = "concat_ws(chr(1), COUNTRY, NAME, CAST(MASTER_PRODUCT_ID AS VARCHAR), CAT1_NAME, CAT2_NAME, CAT3_NAME, " \
       "MAKER, TRADEMARK, CAST(IN_SOT AS VARCHAR))"
_NGRAM = r"regexp_replace({f}, '^\$[a-zA-Z0-9_]+\$|[,\-./]|\sBD', '', 'g')"


def _side_sql(name: str, src: str) -> str:
    fold = Q.fold("NAME")
    return f"""
{name} AS (SELECT COUNTRY, {_RID} AS rid, {fold} AS fname, MEDIAN_PRICE, SIMILARITY, MASTER_PRODUCT_ID FROM {src}),
{name}_tf AS (SELECT COUNTRY, rid, substr(s, i, 3) AS term, count(*) AS tf
   FROM (SELECT COUNTRY, rid, s, unnest(generate_series(1, length(s) - 2)) AS i
         FROM (SELECT COUNTRY, rid, {_NGRAM.format(f="fname")} AS s FROM {name}) WHERE length(s) >= 3)
   GROUP BY 1, 2, 3)"""


_MATCH_BASE = "WITH " + Q.ALL_INPUTS + "," + Q.CATALOG_RP + "," + Q.ROLLUP + """,
sm AS (SELECT * FROM mps WHERE MASTER_PRODUCT_ID IN (SELECT MASTER_PRODUCT_ID FROM sot)),
om AS (SELECT * FROM mps WHERE MASTER_PRODUCT_ID NOT IN (SELECT MASTER_PRODUCT_ID FROM sot)),""" + \
    _side_sql("o", "om") + "," + _side_sql("s", "sm") + """,
idf AS (SELECT o_tf.COUNTRY, term, ln((1 + n.n) / (1 + count(*))) + 1 AS idf FROM o_tf
        JOIN (SELECT COUNTRY, count(*) AS n FROM om GROUP BY 1) n ON n.COUNTRY = o_tf.COUNTRY GROUP BY 1, 2, n.n),
ow AS (SELECT COUNTRY, rid, term, tf * idf AS w FROM o_tf JOIN idf USING (COUNTRY, term)),
onorm AS (SELECT COUNTRY, rid, sqrt(sum(w * w)) AS norm FROM ow GROUP BY 1, 2),
sw AS (SELECT COUNTRY, rid, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY COUNTRY, rid)) AS w
       FROM s_tf JOIN idf USING (COUNTRY, term)),
dots AS (SELECT sw.COUNTRY, sw.rid AS sid, ow.rid AS oid, sum(sw.w * ow.w) AS dot
         FROM sw JOIN ow ON sw.COUNTRY = ow.COUNTRY AND sw.term = ow.term GROUP BY 1, 2, 3),
pairs AS (SELECT d.COUNTRY, sid, oid, dot / onorm.norm AS sim FROM dots d
          JOIN onorm ON onorm.COUNTRY = d.COUNTRY AND onorm.rid = d.oid),
ranked AS (SELECT *, row_number() OVER (PARTITION BY COUNTRY, sid ORDER BY round(sim, 10) DESC, oid) AS rnk
           FROM pairs WHERE sim > 0),
top AS (SELECT r.COUNTRY, r.sim, regexp_replace(o.fname, '~+$', '') AS master_products,
               regexp_replace(s.fname, '~+$', '') AS integration, s.MEDIAN_PRICE AS sp, o.MEDIAN_PRICE AS op,
               s.SIMILARITY AS config_similarity, o.MASTER_PRODUCT_ID AS master_product_id,
               s.MASTER_PRODUCT_ID AS master_product_id_sot
        FROM ranked r JOIN o ON o.COUNTRY = r.COUNTRY AND o.rid = r.oid
        JOIN s ON s.COUNTRY = r.COUNTRY AND s.rid = r.sid WHERE rnk <= 10)"""

_MATCH_SQL = _MATCH_BASE + """
SELECT COUNTRY, round(sim, 8) AS similarity, master_products, integration,
       CAST(damerau_levenshtein(integration, master_products) AS BIGINT) AS damerau_levenshtein,
       round(1 - exp(-15 * exp(-0.16 * damerau_levenshtein(integration, master_products))), 8)
         AS damerau_levenshtein_normalized,
       round(CASE WHEN sp IS NOT NULL AND op IS NOT NULL AND greatest(sp, op) <> 0
                  THEN 1 - abs(sp - op) / greatest(sp, op) END, 8) AS price_similarity,
       round(config_similarity, 8) AS config_similarity, master_product_id, master_product_id_sot
FROM top"""


# Token ratios in SQL: the longest common subsequence by its bit column in a HUGEINT, one character a step, so for
# strings of up to 120 characters (names are shorter).
_TOKENS = r"list_sort(regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]+'))"
_RATIO_SQL = """,
numbered AS (SELECT *, row_number() OVER () AS pair FROM top),
tokens AS (SELECT pair, """ + _TOKENS.format(c="integration") + " AS ta, " + _TOKENS.format(c="master_products") + """ AS tb FROM numbered),
shared AS (SELECT *, list_sort(list_intersect(list_distinct(ta), list_distinct(tb))) AS common FROM tokens),
strings AS (
  SELECT pair, array_to_string(ta, ' ') AS sa, array_to_string(tb, ' ') AS sb, array_to_string(common, ' ') AS s0,
    array_to_string(common || list_sort(list_filter(list_distinct(ta), lambda x: NOT list_contains(tb, x))), ' ') AS s1,
    array_to_string(common || list_sort(list_filter(list_distinct(tb), lambda x: NOT list_contains(ta, x))), ' ') AS s2 FROM shared),
todo AS (SELECT DISTINCT a, b FROM (SELECT sa AS a, sb AS b FROM strings UNION ALL SELECT s1, s2 FROM strings)),
lcs_at AS (
  SELECT a, b, 0 AS i, (1::HUGEINT << length(a)) - 1 AS v FROM todo
  UNION ALL
  SELECT a, b, i + 1, ((v + (v & m)) | (v - (v & m))) & ((1::HUGEINT << length(a)) - 1) FROM (
    SELECT a, b, i, v, list_sum([CASE WHEN a[k + 1] = b[i + 1] THEN 1::HUGEINT << k ELSE 0 END FOR k IN range(length(a))])::HUGEINT AS m
    FROM lcs_at WHERE i < length(b) AND length(a) > 0)),
lcs AS (SELECT a, b, length(a) - bit_count(v) AS n FROM lcs_at WHERE i = CASE WHEN length(a) = 0 THEN 0 ELSE length(b) END),
ratios AS (
  SELECT pair, {sort} AS sort_ratio, CASE WHEN s1 = '' OR s2 = '' THEN 0.0 ELSE greatest({r0a}, {r0b}, {set}) END AS set_ratio
  FROM strings JOIN lcs x ON x.a = sa AND x.b = sb JOIN lcs y ON y.a = s1 AND y.b = s2)
SELECT COUNTRY, round(sim, 8) AS similarity, master_products, integration, CAST(dl AS BIGINT) AS damerau_levenshtein,
       sort_ratio AS fuzz_token_sort_ratio, set_ratio AS fuzz_token_set_ratio, dln AS damerau_levenshtein_normalized, price_similarity, config_similarity,
       master_product_id, master_product_id_sot,
       round((sim * 5.0 + dln * 1.0 + sort_ratio * 2.0 + set_ratio * 0.5 + price_similarity * 1.0 + config_similarity * 3.0) / 12.5, 8) AS final_weighted_confidence
FROM (SELECT *, damerau_levenshtein(integration, master_products) AS dl,
        round(1 - exp(-15 * exp(-0.16 * damerau_levenshtein(integration, master_products))), 8) AS dln,
        CASE WHEN sp IS NOT NULL AND op IS NOT NULL AND greatest(sp, op) <> 0 THEN 1 - abs(sp - op) / greatest(sp, op) END AS price_similarity
      FROM numbered) JOIN ratios USING (pair)"""


def _share(a: str, b: str, n: str) -> str:
    return (f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 0.0 "
            f"ELSE round_even(100.0::DOUBLE * ((2.0::DOUBLE * {n}) / (length({a}) + length({b}))), 0) / 100.0 END")


_SCORE_SQL = _MATCH_BASE.replace("WITH ", "WITH RECURSIVE ", 1) + _RATIO_SQL.replace("{sort}", _share("sa", "sb", "x.n")).replace(
    "{r0a}", _share("s0", "s1", "length(s0)")).replace("{r0b}", _share("s0", "s2", "length(s0)")).replace("{set}", _share("s1", "s2", "y.n"))
ORACLES["match_score"] = _SCORE_SQL


@query("match_pairs", oracle=_MATCH_SQL)
def match_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """MAT-4/5 without the two token ratios: top-10 trigram-cosine pairs per
    curated MP and country, with Damerau, distance curve, price and config
    similarity (SQL-checked; ``match_score`` adds the ratios and confidence)."""
    t = PL.tables_from_testdata(spark, sf)
    p = PL.Params(as_of=S.AS_OF, defect_join_keys=("ORDER_ID",), reasons=S.TICKET_REASONS)
    cat = PL.extract(t, p)
    sc = matching.score_matches(cat.opportunity_mps, cat.sot_mps, keys=("COUNTRY",), row_cols=C.ROLLUP_KEYS)
    return sc.select("COUNTRY", F.round("similarity", 8).alias("similarity"), "master_products", "integration",
                     "damerau_levenshtein", "damerau_levenshtein_normalized",
                     F.round("price_similarity", 8).alias("price_similarity"),
                     F.round("config_similarity", 8).alias("config_similarity"),
                     "master_product_id", "master_product_id_sot")


_FIRST_OF_NAME = """
{n} AS (SELECT COUNTRY, {fold} AS fname, MEDIAN_PRICE, SIMILARITY, MASTER_PRODUCT_ID FROM {src}
  QUALIFY row_number() OVER (PARTITION BY COUNTRY, {fold} ORDER BY NAME, MASTER_PRODUCT_ID, CAT1_NAME, CAT2_NAME, CAT3_NAME, MAKER, TRADEMARK, IN_SOT) = 1)"""


@query("match_first_row", oracle=_MATCH_BASE + "," + _FIRST_OF_NAME.format(n="o1", src="om", fold=Q.fold("NAME")) + ","
       + _FIRST_OF_NAME.format(n="s1", src="sm", fold=Q.fold("NAME")) + """,
named AS (SELECT r.COUNTRY, r.sim, r.sid, r.rnk, o.fname AS oname, s.fname AS sname FROM ranked r JOIN o ON o.COUNTRY = r.COUNTRY AND o.rid = r.oid
  JOIN s ON s.COUNTRY = r.COUNTRY AND s.rid = r.sid WHERE rnk <= 10 ORDER BY r.COUNTRY, r.sid, rnk LIMIT 2000)
SELECT n.COUNTRY, round(sim, 8) AS similarity, regexp_replace(oname, '~+$', '') AS master_products, regexp_replace(sname, '~+$', '') AS integration,
       round(CASE WHEN s1.MEDIAN_PRICE IS NOT NULL AND o1.MEDIAN_PRICE IS NOT NULL AND greatest(s1.MEDIAN_PRICE, o1.MEDIAN_PRICE) <> 0
             THEN 1 - abs(s1.MEDIAN_PRICE - o1.MEDIAN_PRICE) / greatest(s1.MEDIAN_PRICE, o1.MEDIAN_PRICE) END, 8) AS price_similarity,
       round(s1.SIMILARITY, 8) AS config_similarity, o1.MASTER_PRODUCT_ID AS master_product_id, s1.MASTER_PRODUCT_ID AS master_product_id_sot
FROM named n JOIN o1 ON o1.COUNTRY = n.COUNTRY AND o1.fname = n.oname JOIN s1 ON s1.COUNTRY = n.COUNTRY AND s1.fname = n.sname""")
def match_first_row(spark: SparkSession, sf: str) -> DataFrame:
    """JN-9 as the strict mode has it (attributes of the first row with the same normalised name), with the match limit LIM-1."""
    cat = PL.extract(PL.tables_from_testdata(spark, sf), PL.Params(as_of=S.AS_OF, defect_join_keys=("ORDER_ID",), reasons=S.TICKET_REASONS))
    sc = matching.score_matches(cat.opportunity_mps, cat.sot_mps, keys=("COUNTRY",), row_cols=C.ROLLUP_KEYS, strict_compat=True, top=2000)
    return sc.select("COUNTRY", F.round("similarity", 8).alias("similarity"), "master_products", "integration",
                     F.round("price_similarity", 8).alias("price_similarity"), F.round("config_similarity", 8).alias("config_similarity"),
                     "master_product_id", "master_product_id_sot")


# Best match per opportunity MP (the struct order of ``best_per_key``), floor,
# prioritisation (GMV share, tie columns, bounded running total).
_PRIO_BASE = _MATCH_BASE + """,
scored AS (SELECT *, damerau_levenshtein(integration, master_products) AS dl,
                  round(1 - exp(-15 * exp(-0.16 * damerau_levenshtein(integration, master_products))), 8) AS dln,
                  CASE WHEN sp IS NOT NULL AND op IS NOT NULL AND greatest(sp, op) <> 0
                       THEN 1 - abs(sp - op) / greatest(sp, op) END AS price_similarity FROM top),
best AS (SELECT * FROM (
           SELECT *, row_number() OVER (PARTITION BY COUNTRY, master_product_id
             ORDER BY round(sim, 10) DESC, master_product_id_sot ASC, master_products DESC,
                      integration DESC, dl DESC, dln DESC, price_similarity DESC NULLS LAST,
                      config_similarity DESC NULLS LAST) AS pick FROM scored)
         WHERE pick = 1 AND round(sim, 10) >= 0.5),
pj AS (SELECT b.COUNTRY, b.master_products AS master_cp, b.integration AS master_sot, b.master_product_id,
              b.master_product_id_sot, b.price_similarity, b.sim AS similarity, b.config_similarity,
              m.NAME, m.CAT1_NAME, m.CAT2_NAME, m.CAT3_NAME, m.MAKER, m.TRADEMARK, m.GMV_T, m.N_ASSOCIATED_RETAILERS
       FROM best b LEFT JOIN mps m ON m.COUNTRY = b.COUNTRY AND m.MASTER_PRODUCT_ID = b.master_product_id),
tot AS (SELECT COUNTRY, sum(GMV_T) AS total FROM mps GROUP BY 1),
pc AS (SELECT pj.*, CASE WHEN tot.total = 0 THEN NULL ELSE pj.GMV_T * 100.0 / tot.total END AS gmv_coverage
       FROM pj LEFT JOIN tot ON tot.COUNTRY = pj.COUNTRY),
pr AS (SELECT *, sum(N_ASSOCIATED_RETAILERS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_retailers
       FROM pc WINDOW w AS (PARTITION BY COUNTRY ORDER BY round(gmv_coverage, 10) DESC NULLS LAST, master_product_id,
                            master_product_id_sot, NAME, CAT1_NAME, CAT2_NAME, CAT3_NAME, MAKER, TRADEMARK)),
prio AS (SELECT * FROM pr WHERE cumulative_retailers - N_ASSOCIATED_RETAILERS <= 500)"""

_PRIO_SQL = _PRIO_BASE + """
SELECT COUNTRY, master_cp, master_sot, master_product_id, master_product_id_sot,
       round(price_similarity, 8) AS price_similarity, round(similarity, 8) AS similarity,
       round(config_similarity, 8) AS config_similarity, round(gmv_coverage, 8) AS gmv_coverage,
       CAST(cumulative_retailers AS BIGINT) AS cumulative_retailers
FROM prio"""

_PRODUCTS_SQL = """
products AS (SELECT p_partkey AS MASTER_PRODUCT_ID, p_name || ' ' || p_type || ' ' || p_brand AS NAME,
                    p_type AS LONG_DESCRIPTION, CASE WHEN p_size < 10 THEN 'U' ELSE 'W' END AS SALE_TYPE,
                    CASE WHEN p_size < 10 THEN 'un' ELSE 'kg' END AS UNIT_TYPE, CAST(p_size AS DOUBLE) AS QUANTITY,
                    CAST(CASE WHEN p_size < 10 THEN 1.0 ELSE 0.5 END AS DOUBLE) AS STEP_QUANT FROM part)"""

_EXPORT_SQL = _PRIO_BASE + "," + _PRODUCTS_SQL + """,
ids AS (SELECT DISTINCT master_product_id_sot AS MASTER_PRODUCT_ID FROM prio),
info AS (SELECT DISTINCT * FROM products WHERE MASTER_PRODUCT_ID IN (SELECT MASTER_PRODUCT_ID FROM ids)),
photos AS (SELECT DISTINCT COUNTRY, MASTER_PRODUCT_ID, MP_PHOTO_URL FROM rp),
prices AS (SELECT DISTINCT COUNTRY, MEDIAN_PRICE, MASTER_PRODUCT_ID, TRADEMARK FROM sm),
infos AS (SELECT DISTINCT ph.COUNTRY, i.MASTER_PRODUCT_ID AS MASTER_PRODUCT_ID_SOT, i.NAME AS NAME_SOT,
                 i.LONG_DESCRIPTION AS LONG_DESCRIPTION_SOT, i.SALE_TYPE AS SALE_TYPE_SOT, i.UNIT_TYPE AS UNIT_TYPE_SOT,
                 i.QUANTITY AS QUANTITY_SOT, i.STEP_QUANT AS STEP_QUANT_SOT, ph.MP_PHOTO_URL AS MP_PHOTO_URL_SOT,
                 pz.MEDIAN_PRICE AS MEDIAN_PRICE_SOT, pz.TRADEMARK AS TRADEMARK_SOT
          FROM info i JOIN photos ph ON ph.MASTER_PRODUCT_ID = i.MASTER_PRODUCT_ID
          JOIN prices pz ON pz.COUNTRY = ph.COUNTRY AND pz.MASTER_PRODUCT_ID = i.MASTER_PRODUCT_ID),
orp AS (SELECT * FROM rp WHERE MASTER_PRODUCT_ID NOT IN (SELECT MASTER_PRODUCT_ID FROM sot)),
lg AS (SELECT o.*, p.master_product_id_sot FROM orp o
       JOIN prio p ON p.COUNTRY = o.COUNTRY AND p.master_product_id = o.MASTER_PRODUCT_ID),
lj AS (SELECT lg.*, infos.* EXCLUDE (COUNTRY) FROM lg LEFT JOIN infos
       ON infos.COUNTRY = lg.COUNTRY AND infos.MASTER_PRODUCT_ID_SOT = lg.master_product_id_sot)
SELECT DISTINCT COUNTRY, PRODUCT_ID, SKU, CAST(MASTER_PRODUCT_ID AS VARCHAR) AS MASTER_PRODUCT_ID, MP_PHOTO_URL,
       IMAGE_URL, NAME, NAME_INT, coalesce(TRADEMARK, 'None') AS TRADEMARK, coalesce(TRADEMARK_INT, 'None') AS TRADEMARK_INT,
       MEDIAN_PRICE, MEDIAN_PRICE_SOT, PRICE_PER_KG, STEP_QUANT, SELL_TYPE, UNITY_P,
       CAST(QUANTITY_RP AS DOUBLE) AS QUANTITY_RP,
       CASE WHEN STEP_QUANTITY_IN_GRAMS IS NULL OR STEP_QUANTITY_IN_GRAMS = 0 THEN SUGGESTED_QUANTITY
            ELSE CAST(STEP_QUANTITY_IN_GRAMS AS VARCHAR) END AS STEP_QUANTITY_IN_GRAMS,
       CASE WHEN QUANTITY_INT IS NULL OR QUANTITY_INT = 0 THEN SUGGESTED_QUANTITY
            ELSE CAST(CAST(QUANTITY_INT AS DOUBLE) AS VARCHAR) END AS QUANTITY_INT,
       CASE WHEN UNIT_TYPE IS NULL THEN SUGGESTED_UNITYPE ELSE UNIT_TYPE END AS UNIT_TYPE,
       MP_PHOTO_URL_SOT, NAME_SOT, LONG_DESCRIPTION_SOT, TRADEMARK_SOT, SALE_TYPE_SOT, STEP_QUANT_SOT, QUANTITY_SOT,
       UNIT_TYPE_SOT, CAST(MASTER_PRODUCT_ID_SOT AS VARCHAR) AS MASTER_PRODUCT_ID_SOT
FROM lj"""

ORACLES_EXTRA = {"prioritised_matches": _PRIO_SQL, "export_enriched": _EXPORT_SQL}

ORACLES.update(ORACLES_EXTRA)
