"""Text and pair-similarity queries on whole texts (SIM-1..10, SC-9..20, AGG-12).

Pairs are adjacent turns of ``conversations``; names for the quantity/kg
parsers are the stand-in feed names built from ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.functions import pairsim as P
from shelfmatch.functions import text as T
from shelfmatch.functions import udfs as U
from shelfmatch.plans import sqlfrag as Q
from shelfmatch.plans import standins as S
from shelfmatch.operators.matching import with_token_ratios
from shelfmatch.plans.registry import query
from shelfmatch.sources.tables import table

_PAIR_SQL_BASE = "WITH " + S.PAIRS_SQL + "," + Q.pair_scores("pairs", "conv_id, turn", "text_a", "text_b", p="ps") + """,
m AS (SELECT * FROM ps_m)
"""


def _pairs(spark, sf):
    return S.conversation_pairs(spark, sf)


def _scored(spark, sf, score):
    p = P.with_pair_scores(_pairs(spark, sf), "text_a", "text_b", scores=(score,))
    return p.select("conv_id", "turn", F.round(score, 8).alias(score))


@query("pair_jaccard", oracle=_PAIR_SQL_BASE + "SELECT conv_id, turn, round(jaccard, 8) AS jaccard FROM m")
def pair_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "jaccard")


@query("pair_edit", oracle=_PAIR_SQL_BASE + "SELECT conv_id, turn, round(edit_similarity, 8) AS edit_similarity FROM m")
def pair_edit(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "edit_similarity")


@query("pair_cosine", oracle=_PAIR_SQL_BASE + "SELECT conv_id, turn, round(cosine, 8) AS cosine FROM m")
def pair_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "cosine")


@query("pair_containment", oracle=_PAIR_SQL_BASE + """
SELECT conv_id, turn,
       round(CASE WHEN len(ra) > 0 THEN
         coalesce(list_sum(list_transform(list_distinct(ra),
           lambda u: least(len(list_filter(ra, lambda x: x = u)), len(list_filter(rb, lambda x: x = u))))), 0)
         / len(ra) END, 8) AS containment
FROM m""")
def pair_containment(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "containment")


@query("name_agreement", oracle=_PAIR_SQL_BASE + """
SELECT conv_id, turn,
       round(list_aggregate(list_filter([jaccard, edit_similarity, cosine], lambda x: x IS NOT NULL), 'median'), 8)
         AS name_agreement
FROM m""")
def name_agreement(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, "name_agreement")


_FOLD_PAIRS_SQL = "WITH " + S.PAIRS_SQL + """,
f AS (SELECT conv_id, turn, regexp_replace({fa}, '~+$', '') AS fa, regexp_replace({fb}, '~+$', '') AS fb FROM pairs)
""".format(fa=Q.fold("text_a"), fb=Q.fold("text_b"))


def _folded_pairs(spark, sf):
    p = _pairs(spark, sf)
    return p.select("conv_id", "turn",
                    T.strip_trailing_tildes(T.fold_name(F.col("text_a"))).alias("fa"),
                    T.strip_trailing_tildes(T.fold_name(F.col("text_b"))).alias("fb"))


@query("damerau", oracle=_FOLD_PAIRS_SQL + """
SELECT conv_id, turn, CAST(damerau_levenshtein(fa, fb) AS BIGINT) AS damerau_levenshtein,
       round(1 - exp(-15 * exp(-0.16 * damerau_levenshtein(fa, fb))), 8) AS damerau_levenshtein_normalized
FROM f""")
def damerau(spark: SparkSession, sf: str) -> DataFrame:
    """SIM-7 + SIM-8 on the folded names (Arrow UDF on the pair rows only)."""
    f = _folded_pairs(spark, sf)
    d = f.select("conv_id", "turn", U.damerau(F.col("fa"), F.col("fb")).alias("damerau_levenshtein"))
    return d.withColumn("damerau_levenshtein_normalized", P.distance_score(F.col("damerau_levenshtein")))


@query("distance_curve", oracle="""
SELECT CAST(d AS BIGINT) AS d, round(1 - exp(-15 * exp(-0.16 * d)), 8) AS score
FROM (SELECT DISTINCT length(text) % 64 AS d FROM conversations)""")
def distance_curve(spark: SparkSession, sf: str) -> DataFrame:
    """SIM-8 alone over a spread of integer distances taken from the data."""
    cv = table(spark, sf, "conversations").select((F.length("text") % 64).cast("bigint").alias("d")).distinct()
    return cv.select("d", P.distance_score(F.col("d")).alias("score"))


@query("token_strings", oracle=_FOLD_PAIRS_SQL + """,
t AS (SELECT conv_id, turn, list_sort(regexp_extract_all(lower(fa), '[\\p{L}\\p{N}_]+')) AS ta,
             list_sort(regexp_extract_all(lower(fb), '[\\p{L}\\p{N}_]+')) AS tb FROM f),
u AS (SELECT *, list_sort(list_intersect(list_distinct(ta), list_distinct(tb))) AS common FROM t)
SELECT conv_id, turn, array_to_string(ta, ' ') AS sorted_a, array_to_string(tb, ' ') AS sorted_b, array_to_string(common, ' ') AS shared,
       array_to_string(common || list_sort(list_filter(list_distinct(ta), lambda x: NOT list_contains(tb, x))), ' ') AS shared_a,
       array_to_string(common || list_sort(list_filter(list_distinct(tb), lambda x: NOT list_contains(ta, x))), ' ') AS shared_b
FROM u""")
def token_strings(spark: SparkSession, sf: str) -> DataFrame:
    """The strings that SIM-9 and SIM-10 compare."""
    f = _folded_pairs(spark, sf)
    names = ("sorted_a", "sorted_b", "shared", "shared_a", "shared_b")
    strings = (*P.token_sort_strings(F.col("fa"), F.col("fb")), *P.token_set_strings(F.col("fa"), F.col("fb")))
    return f.select("conv_id", "turn", *[c.alias(n) for c, n in zip(strings, names)])


@query("token_ratios")
def token_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """SIM-9 and SIM-10 on whole turns: rows-only (``token_strings`` checks the strings, ``match_score`` the ratios)."""
    return with_token_ratios(_folded_pairs(spark, sf), "fa", "fb").select("conv_id", "turn", "fuzz_token_sort_ratio", "fuzz_token_set_ratio")


@query("clean_text", oracle="""
SELECT doc_id, array_to_string({w}, ' ') AS clean_text FROM documents""".format(w=Q.clean_words("text")))
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", T.clean_text(F.col("text")).alias("clean_text"))


@query("word_bigrams", oracle="""
WITH c AS (SELECT doc_id, {w} AS w FROM documents)
SELECT doc_id, array_to_string([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))], '|') AS bigrams FROM c""".format(w=Q.clean_words("text")))
def word_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    """SC-18 with n = 2 over cleaned whole texts."""
    d = table(spark, sf, "documents").select("doc_id", T.clean_words(F.col("text")).alias("words"))
    return d.select("doc_id", F.array_join(T.joined_runs(F.col("words"), 2), "|").alias("bigrams"))


@query("fold_text", oracle="""
SELECT doc_id, {f} AS name_norm,
       regexp_replace({f}, '^\\$[a-zA-Z0-9_]+\\$|[,\\-./]|\\sBD', '', 'g') AS ngram_src,
       regexp_replace({f}, '~+$', '') AS matched_name
FROM documents""".format(f=Q.fold("text")))
def fold_text(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "text")
    n = T.fold_name(F.col("text"))
    return d.select("doc_id", n.alias("name_norm"), T.ngram_source(n).alias("ngram_src"),
                    T.strip_trailing_tildes(n).alias("matched_name"))


_NAMES_SQL = f"""
names AS (SELECT p.p_partkey, p.p_name || ' ' || CAST(p.p_size AS VARCHAR) || {S._unit_sql()} AS NAME_INT
          FROM part p)"""


def _names(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_type")
    return p.select("p_partkey", F.concat_ws(" ", "p_name", F.concat(F.col("p_size").cast("string"),
                                                                      S._unit_expr())).alias("NAME_INT"))


@query("quantity_unit", oracle="WITH " + _NAMES_SQL + r"""
SELECT p_partkey, NAME_INT,
       nullif(regexp_extract(NAME_INT, '(?i)(\d+\.?\d*)\s*(ML|G|KG|L|Unid.|Unid)', 1), '') AS SUGGESTED_QUANTITY,
       nullif(regexp_extract(NAME_INT, '(?i)(\d+\.?\d*)\s*(ML|G|KG|L|Unid.|Unid)', 2), '') AS SUGGESTED_UNITYPE
FROM names""")
def quantity_unit(spark: SparkSession, sf: str) -> DataFrame:
    n = _names(spark, sf)
    q, u = T.quantity_unit(F.col("NAME_INT"))
    return n.select("p_partkey", "NAME_INT", q.alias("SUGGESTED_QUANTITY"), u.alias("SUGGESTED_UNITYPE"))


@query("price_per_kg", oracle="WITH " + _NAMES_SQL + r"""
SELECT p_partkey, NAME_INT, coalesce(regexp_matches(NAME_INT, '(?i)\bkg\b'), false) AS PRICE_PER_KG FROM names""")
def price_per_kg(spark: SparkSession, sf: str) -> DataFrame:
    n = _names(spark, sf)
    return n.select("p_partkey", "NAME_INT", T.is_per_kg(F.col("NAME_INT")).alias("PRICE_PER_KG"))
