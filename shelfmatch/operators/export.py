"""Export enrichment (PIP-5, JN-11..13, SC-21..24, PRJ-1..5, AGG-10, SRC-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.sources.tables import lookup_by_ids

# The column lists of the match log and of the sheet (30).
# Spark resolves names case-insensitively, so where the reference carries
# both ``SIMILARITY`` (RP name agreement) and ``similarity`` (match cosine)
# the RP one is ``RP_SIMILARITY``; ``master_product_id`` equals
# ``MASTER_PRODUCT_ID`` by the join and is not repeated (36 log columns).
LOG_COLUMNS = ("COUNTRY", "RETAILER_ID", "PRODUCT_ID", "SKU", "MASTER_PRODUCT_ID", "MP_PHOTO_URL", "IMAGE_URL",
               "NAME", "NAME_INT", "TRADEMARK", "TRADEMARK_INT", "MEDIAN_PRICE", "MIN_QUANT", "STEP_QUANT",
               "SELL_TYPE", "PRESENTATION", "QUANTITY_RP", "UNITY_P", "UNIT_TYPE", "MIN_QUANTITY_IN_GRAMS",
               "QUANTITY_INT", "STEP_QUANTITY_IN_GRAMS", "FR", "PRODUCT_DR", "N_ASSOCIATED_RETAILERS",
               "RP_SIMILARITY", "SUGGESTED_QUANTITY", "SUGGESTED_UNITYPE", "PRICE_PER_KG", "master_cp", "master_sot",
               "master_product_id_sot", "price_similarity", "similarity",
               "config_similarity", "final_weighted_confidence")
SHEET_COLUMNS = ("PRODUCT_ID", "SKU", "MASTER_PRODUCT_ID", "MP_PHOTO_URL", "IMAGE_URL", "NAME", "NAME_INT",
                 "TRADEMARK", "TRADEMARK_INT", "MEDIAN_PRICE", "MEDIAN_PRICE_SOT", "PRICE_PER_KG", "STEP_QUANT",
                 "SELL_TYPE", "UNITY_P", "QUANTITY_RP", "STEP_QUANTITY_IN_GRAMS", "QUANTITY_INT", "UNIT_TYPE",
                 "MP_PHOTO_URL_SOT", "NAME_SOT", "LONG_DESCRIPTION_SOT", "TRADEMARK_SOT", "SALE_TYPE_SOT",
                 "STEP_QUANT_SOT", "QUANTITY_SOT", "UNIT_TYPE_SOT", "MASTER_PRODUCT_ID_SOT", "SUGGESTED_QUANTITY",
                 "SUGGESTED_UNITYPE")
PRODUCT_INFO_COLUMNS = ("MASTER_PRODUCT_ID", "NAME", "LONG_DESCRIPTION", "SALE_TYPE", "UNIT_TYPE", "QUANTITY",
                        "STEP_QUANT")


def null_or_zero_fallback(c: Column, fallback: Column, numeric: bool) -> Column:
    """SC-21: ``fallback`` when ``c`` is NULL (or 0 for numbers), else ``c`` (as text)."""
    empty = c.isNull() | (c == 0) if numeric else c.isNull()
    return F.when(empty, fallback.cast("string")).otherwise(c.cast("string"))


def sot_infos(ids: DataFrame, products: DataFrame, rps: DataFrame, sot_mps: DataFrame,
              keys: Sequence[str] = ("COUNTRY",)) -> DataFrame:
    """Curated-side attributes with a ``_SOT`` suffix (SRC-4, JN-11, PRJ-4, AGG-10).

    The photo side is reduced to distinct (key, MP, photo) before the join:
    the reference joins every RP row and deduplicates afterwards, which
    gives the same rows but shuffles the fan-out.
    """
    keys = list(keys)
    # Ids are only unique within a country: products that name theirs are joined on it.
    on = [*[k for k in keys if k in products.columns and k in ids.columns], "MASTER_PRODUCT_ID"]
    info = lookup_by_ids(products.select(*on[:-1], *PRODUCT_INFO_COLUMNS), ids, on).distinct()
    photos = rps.select(*keys, "MASTER_PRODUCT_ID", "MP_PHOTO_URL").distinct()
    prices = sot_mps.select(*keys, "MEDIAN_PRICE", "MASTER_PRODUCT_ID", "TRADEMARK").distinct()
    j = info.join(photos, on=on).join(prices, on=[*keys, "MASTER_PRODUCT_ID"])
    return j.select(*keys, *[F.col(c).alias(f"{c}_SOT") for c in j.columns if c not in keys]).distinct()


def enrich_export(prioritised: DataFrame, opp_rps: DataFrame, products: DataFrame, sot_mps: DataFrame,
                  all_rps: DataFrame, keys: Sequence[str] = ("COUNTRY",), strict_compat: bool = False):
    """PIP-5: (sheet rows, match log) for the prioritised matches.

    ``strict_compat`` reproduces the reference overwriting the sheet's
    TRADEMARK with the feed trademark; by default TRADEMARK keeps its own
    value with NULL shown as ``None``.
    """
    keys = list(keys)
    ids = prioritised.select(*keys, F.col("master_product_id_sot").alias("MASTER_PRODUCT_ID")).distinct()
    infos = sot_infos(ids, products, all_rps, sot_mps, keys)
    pr = prioritised.select(*keys, "master_cp", "master_sot", "master_product_id", "master_product_id_sot",
                            "price_similarity", "similarity", "config_similarity", "final_weighted_confidence")
    pr = pr.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col("master_product_id").alias("_p_mp"),
                   *[c for c in pr.columns if c not in keys and c != "master_product_id"])
    rps = opp_rps.withColumnRenamed("SIMILARITY", "RP_SIMILARITY")
    cond = [*[F.col(k) == F.col(f"_p_{k}") for k in keys], F.col("MASTER_PRODUCT_ID") == F.col("_p_mp")]
    log = rps.join(pr, on=cond, how="inner").select(*LOG_COLUMNS)
    inf = infos.select(*[F.col(k).alias(f"_i_{k}") for k in keys], F.col("MASTER_PRODUCT_ID_SOT").alias("_i_mp"),
                       *[c for c in infos.columns if c not in keys and c != "MASTER_PRODUCT_ID_SOT"])
    cond = [*[F.col(k) == F.col(f"_i_{k}") for k in keys], F.col("master_product_id_sot") == F.col("_i_mp")]
    log = log.join(inf, on=cond, how="left").drop(*[f"_i_{k}" for k in keys])
    sheet = log.drop("master_product_id_sot").withColumn("MASTER_PRODUCT_ID_SOT", F.col("_i_mp"))
    log = log.drop("_i_mp")
    sheet = sheet.select(*keys, *SHEET_COLUMNS)
    trademark_src = F.col("TRADEMARK_INT") if strict_compat else F.col("TRADEMARK")
    sheet = sheet.withColumns({
        "UNIT_TYPE": null_or_zero_fallback(F.col("UNIT_TYPE"), F.col("SUGGESTED_UNITYPE"), numeric=False),
        "QUANTITY_RP": F.col("QUANTITY_RP").cast("double"),
        "QUANTITY_INT": null_or_zero_fallback(F.col("QUANTITY_INT").cast("double"), F.col("SUGGESTED_QUANTITY"),
                                              numeric=True),
        "STEP_QUANTITY_IN_GRAMS": null_or_zero_fallback(F.col("STEP_QUANTITY_IN_GRAMS"),
                                                        F.col("SUGGESTED_QUANTITY"), numeric=True),
        "MASTER_PRODUCT_ID": F.col("MASTER_PRODUCT_ID").cast("string"),
        "MASTER_PRODUCT_ID_SOT": F.col("MASTER_PRODUCT_ID_SOT").cast("string"),
        "TRADEMARK": F.coalesce(trademark_src, F.lit("None")),
        "TRADEMARK_INT": F.coalesce(F.col("TRADEMARK_INT"), F.lit("None")),
    })
    sheet = sheet.drop("SUGGESTED_QUANTITY", "SUGGESTED_UNITYPE").distinct()
    return sheet, log
