"""Match scoring (MAT-4, MAT-5, JN-9, SIM-7..13, SC-12, R6).

Opportunities (non-curated MPs) form the corpus the trigram idf is fitted
on; curated MPs are the queries; each curated row keeps its ``k`` best
opportunities. Secondary scores, including the Arrow UDFs, run only on the
kept pairs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions import pairsim as P
from shelfmatch.functions import text as T
from shelfmatch.functions import udfs as U
from shelfmatch.operators import tfidf
from shelfmatch.session import spread

SCORED_COLUMNS = ("similarity", "master_products", "integration", "damerau_levenshtein",
                  "fuzz_token_sort_ratio", "fuzz_token_set_ratio", "damerau_levenshtein_normalized",
                  "price_similarity", "config_similarity", "master_product_id", "master_product_id_sot",
                  "final_weighted_confidence")


# Separator of the row-id fields (a control character absent from names).
ROW_KEY_SEP = "\x01"


def row_key(cols: Sequence[str]):
    """Deterministic row id from the columns that make a roll-up row unique.

    A plain string (fields joined by a control character, NULLs skipped), so
    the tie order it gives the top-k is the same in any SQL engine.
    """
    return F.concat_ws(ROW_KEY_SEP, *[F.col(c).cast("string") for c in cols])


def with_token_ratios(df: DataFrame, a: str, b: str, sort: str = "fuzz_token_sort_ratio", both: str = "fuzz_token_set_ratio") -> DataFrame:
    """SIM-9 and SIM-10 of two text columns. Tokens and their strings are Spark columns, made once;
    only the length of the longest common subsequence is taken in Python."""
    own = df.columns
    sa, sb = P.token_sort_strings(F.col(a), F.col(b))
    shared, ca, cb = P.token_set_strings(F.col(a), F.col(b))
    out = df.select(*own, sa.alias("_sa"), sb.alias("_sb"), shared.alias("_shared"), ca.alias("_ca"), cb.alias("_cb"))
    out = out.select("*", U.common_subsequence("_sa", "_sb").alias("_sl"), U.common_subsequence("_ca", "_cb").alias("_cl"))
    return out.select(*own, P.token_sort_ratio(F.col("_sa"), F.col("_sb"), F.col("_sl")).alias(sort),
                      P.token_set_ratio(F.col("_shared"), F.col("_ca"), F.col("_cb"), F.col("_cl")).alias(both))


def score_matches(opps: DataFrame, sot: DataFrame, keys: Sequence[str] = ("COUNTRY",),
                  row_cols: Sequence[str] | None = None, k: int = 10,
                  weights: Mapping[str, float] = P.CONFIDENCE_WEIGHTS,
                  name: str = "NAME", price: str = "MEDIAN_PRICE", config: str = "SIMILARITY",
                  mp: str = "MASTER_PRODUCT_ID", min_similarity: float | None = None,
                  strict_compat: bool = False, top: int | None = None) -> DataFrame:
    """MAT-5: top-k trigram cosine pairs with secondary scores and confidence.

    Attributes of both sides are joined back by row id (a hash of
    ``row_cols``). With ``strict_compat`` they are taken, as the reference
    does, from the *first* row carrying the same normalised name (ordered by
    the row columns), so duplicate names share one id and price (JN-9).
    ``min_similarity`` pushes a final floor below the top-k (R1). ``top``
    (LIM-1) keeps only the first ``top`` pairs in (keys, curated id, rank)
    order; the default, as the reference calls it, keeps every pair.
    """
    keys = list(keys)
    row_cols = list(row_cols or opps.columns)

    def side(df, pre):
        out = df.select(*keys, row_key(row_cols).alias(f"_{pre}id"),
                        T.fold_name(F.col(name)).alias(f"_{pre}name"),
                        F.col(price).alias(f"_{pre}price"), F.col(config).alias(f"_{pre}config"),
                        F.col(mp).alias(f"_{pre}mp"), *[F.col(c).alias(f"_{pre}o_{c}") for c in row_cols
                                                        if c not in keys])
        if strict_compat:
            first = out.groupBy(*keys, f"_{pre}name").agg(F.min_by(
                F.struct(f"_{pre}price", f"_{pre}config", f"_{pre}mp"),
                F.struct(*[f"_{pre}o_{c}" for c in row_cols if c not in keys])).alias("_first"))
            out = out.drop(f"_{pre}price", f"_{pre}config", f"_{pre}mp").join(
                first.select(*keys, f"_{pre}name", "_first.*"), on=[*keys, f"_{pre}name"])
        return out.drop(*[f"_{pre}o_{c}" for c in row_cols if c not in keys])

    top_n = top
    o, s = side(opps, "o"), side(sot, "s")
    top = tfidf.corpus_match(s, o, "_sid", "_oid", "_sname", "_oname", tuple(keys),
                             tfidf.TopK(k=k, min_similarity=min_similarity))
    ranked = top_pairs = top.select(*keys, "_sid", "_oid", "similarity", "rank")
    if top_n is not None:
        ranked = top_pairs.orderBy(*keys, "_sid", "rank").limit(top_n)
    pairs = ranked.drop("rank").join(o, on=[*keys, "_oid"]).join(s, on=[*keys, "_sid"])
    pairs = pairs.select(
        *keys, "similarity",
        T.strip_trailing_tildes(F.col("_oname")).alias("master_products"),
        T.strip_trailing_tildes(F.col("_sname")).alias("integration"),
        F.col("_sprice").alias("_sp"), F.col("_oprice").alias("_op"),
        F.col("_sconfig").alias("config_similarity"),
        F.col("_omp").alias("master_product_id"), F.col("_smp").alias("master_product_id_sot"))
    # The Arrow UDFs are the CPU-heavy part: give them every task slot rather
    # than the few partitions AQE would coalesce a small pair set into.
    pairs = spread(pairs, *keys, "master_product_id_sot")
    scored = with_token_ratios(pairs.withColumn("damerau_levenshtein", U.damerau(F.col("integration"), F.col("master_products"))),
                               "integration", "master_products")
    scored = scored.withColumns({
        "damerau_levenshtein_normalized": P.distance_score(F.col("damerau_levenshtein")),
        "price_similarity": P.price_similarity(F.col("_sp"), F.col("_op")),
    })
    conf = P.confidence({"similarity": F.col("similarity"),
                         "distance_score": F.col("damerau_levenshtein_normalized"),
                         "token_sort_ratio": F.col("fuzz_token_sort_ratio"),
                         "token_set_ratio": F.col("fuzz_token_set_ratio"),
                         "price_similarity": F.col("price_similarity"),
                         "config_similarity": F.col("config_similarity")}, weights)
    return scored.withColumn("final_weighted_confidence", conf).select(*keys, *SCORED_COLUMNS)
