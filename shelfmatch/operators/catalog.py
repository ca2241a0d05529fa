"""Catalog assembly, RP enrichment, MP roll-up and the SOT split
(PIP-1..3, JN-2..7, AGG-6, AGG-7, AGG-9, AGG-10, FLT-3..5, FLT-7, SC-2..4, SC-22, PIP-6)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from shelfmatch.functions import pairsim as P
from shelfmatch.functions import text as T
from shelfmatch.operators.median import with_medians
from shelfmatch.operators.metrics import json_path
from shelfmatch.operators.prefilter import may_match
from shelfmatch.session import materialize, stored

# The nine roll-up keys and the null placeholder (AGG-6, SC-22).
ROLLUP_KEYS = ("COUNTRY", "NAME", "MASTER_PRODUCT_ID", "CAT1_NAME", "CAT2_NAME", "CAT3_NAME",
               "MAKER", "TRADEMARK", "IN_SOT")
NULL_VALUE = "NULL_VALUE"


# What is read of the two semi-structured columns.
VARIANT_PATHS = {"MAX_QUANT": ("SELL_TYPE", "$.maxQuantity", "double"), "MIN_QUANT": ("SELL_TYPE", "$.minQuantity", "double"),
                 "STEP_QUANT": ("SELL_TYPE", "$.stepQuantity", "double"), "SELL_TYPE": ("SELL_TYPE", "$.type", "string"),
                 "PRESENTATION": ("PRESENTATION", "$.description", "string"), "QUANTITY_RP": ("PRESENTATION", "$.quantity", "double"),
                 "UNITY_P": ("PRESENTATION", "$.unitType", "string")}


def sell_and_presentation(rp: DataFrame, mp: DataFrame, country: str = "COUNTRY") -> DataFrame:
    """R4: sell-type and presentation attributes from ONE scan of RP ⋈ MP.

    RP values win over MP values path by path (SC-2); both sides must be
    published and not deleted (FLT-3), which makes the left join inner. The
    semi-structured columns may be JSON text or VARIANT. Typed extraction
    happens before DISTINCT (a raw variant cannot be deduplicated).
    """
    variant = isinstance(rp.schema["SELL_TYPE"].dataType, VariantType)

    def typed(side: DataFrame, *cols: str) -> DataFrame:
        """The paths as typed columns: less to shuffle than whole semi-structured values."""
        return side.select(*[c for c in cols if c in side.columns], "STATUS", "IS_DELETED", *[
            json_path(F.col(c), path, to, variant).alias(out) for out, (c, path, to) in VARIANT_PATHS.items()])

    r, m = typed(rp, country, "ID", "PRODUCT_ID", "SKU").alias("rp"), typed(mp, country, "ID").alias("mp")
    live = ((F.col("rp.STATUS") == "published") & (F.col("mp.STATUS") == "published")
            & (F.col("rp.IS_DELETED") == F.lit(False)) & (F.col("mp.IS_DELETED") == F.lit(False)))
    same = F.col("mp.ID") == F.col("rp.PRODUCT_ID")
    if country in rp.columns:  # ids are only unique within a country
        same = same & (F.col(f"rp.{country}") == F.col(f"mp.{country}"))
    # The RP's country is the MP's where it has one; taken from the side of the MP id, the rows stay hashed by both for DISTINCT.
    own = F.col(f"rp.{country}" if country in rp.columns else f"mp.{country}")
    return r.join(m, same, "left").where(live).select(
        own.alias("COUNTRY"), F.col("rp.SKU").alias("SKU"),
        F.col("rp.ID").alias("PRODUCT_ID"), F.col("rp.PRODUCT_ID").alias("MASTER_PRODUCT_ID"),
        *[F.coalesce(f"rp.{out}", f"mp.{out}").alias(out) for out in VARIANT_PATHS]).distinct()


def with_feed(rp: DataFrame, feed: DataFrame) -> DataFrame:
    """FLT-4 pushed to the source: RPs whose SKU is in the feed snapshot.

    Enrichment drops all others at its end; dropping them first keeps their variant
    columns, joins and DISTINCT out of the job (a semi join on the snapshot's keys). Most of them
    are dropped where the SKU is read, before any shuffle. ``feed`` is read at once and should be stored.
    """
    keys = feed.select("COUNTRY", F.col("RETAIL_ID").alias("SKU"))
    return may_match(rp, keys, {"SKU": "SKU"}).join(keys, ["COUNTRY", "SKU"], "left_semi")


def feed_base(rp: DataFrame, mp: DataFrame, rp_analytics: DataFrame, mp_analytics: DataFrame, feed: DataFrame) -> DataFrame:
    """:func:`catalog_base` of the RPs in the feed snapshot: these are stored, and of the RP analytics only their rows are shuffled."""
    live = stored(sell_and_presentation(with_feed(rp, feed), mp), "live")
    return catalog_base(live, may_match(rp_analytics, live, {"RETAILER_PRODUCT_ID": "PRODUCT_ID"}), mp_analytics)


# What the two analytics tables add to a retailer product.
RP_ANALYTICS_COLUMNS = ("RETAILER_ID", "CAT1_NAME", "CAT2_NAME", "CAT3_NAME", "MAKER", "TRADEMARK", "EAN", "MP_PHOTO_URL")
MP_ANALYTICS_COLUMNS = ("QUALITY_LABEL", "PRIORITY", "ASSOCIATED_RETAILERS")


def catalog_base(live: DataFrame, rp_analytics: DataFrame, mp_analytics: DataFrame) -> DataFrame:
    """The catalog before metrics (JN-2, FLT-4): live RPs with both analytics sides.

    ``live`` is :func:`sell_and_presentation`. An RP stays only with an analytics
    row that has a photo and a name: the guards turn that left join into an inner
    one and reach its scan as filters. The MP side only adds columns, so it is joined
    first: ``live`` comes hashed by MP from its own join, and is shuffled once, by RP.
    """
    guarded = rp_analytics.where(F.col("MP_PHOTO_URL").isNotNull() & F.col("MP_NAME").isNotNull())
    guarded = guarded.select("COUNTRY", F.col("RETAILER_PRODUCT_ID").alias("PRODUCT_ID"), F.col("MP_NAME").alias("NAME"),
                             *RP_ANALYTICS_COLUMNS)
    labels = mp_analytics.select("COUNTRY", "MASTER_PRODUCT_ID", *MP_ANALYTICS_COLUMNS)
    out = live.join(labels, ["COUNTRY", "MASTER_PRODUCT_ID"], "left").join(guarded, ["COUNTRY", "PRODUCT_ID"])
    keys = ["COUNTRY", "MASTER_PRODUCT_ID", "PRODUCT_ID"]
    return out.select(*keys, *[c for c in live.columns if c not in keys], "NAME", *RP_ANALYTICS_COLUMNS, *MP_ANALYTICS_COLUMNS)


def with_membership(df: DataFrame, sot_ids: DataFrame, on: Sequence[str] = ("MASTER_PRODUCT_ID",),
                    out: str = "IN_SOT") -> DataFrame:
    """JN-5: boolean flag, via a left join to the *distinct* curated keys (no fan-out)."""
    keys = list(on)
    flag = sot_ids.select(*keys).distinct().withColumn("_in", F.lit(True))
    return df.join(flag, on=keys, how="left").withColumn(out, F.coalesce(F.col("_in"), F.lit(False))).drop("_in")


def keep_sellable(df: DataFrame, sell_type: str = "SELL_TYPE", in_sot: str = "IN_SOT") -> DataFrame:
    """FLT-5: not sold by unit, or curated. NULL sell type is dropped unless curated."""
    return df.where(~F.col(sell_type).isin("U") | F.col(in_sot))


def assemble_catalog(base: DataFrame, fill: DataFrame, defects: DataFrame, feed: DataFrame,
                     sot_ids: DataFrame, sot_on: Sequence[str] = ("MASTER_PRODUCT_ID",),
                     dedupe: bool = False, owners: DataFrame | None = None) -> DataFrame:
    """PIP-1: RP rows with FR, DR, feed snapshot and the SOT flag attached.

    All metric sides are aggregates keyed by (country, product) and the SOT
    side is distinct, so no join fans out and the reference's final DISTINCT
    is a no-op on a base with one row per RP; ``dedupe`` keeps it for bases
    that are not unique. Join strategy is left to AQE (broadcast when a
    metric side turns out small at run time, sort-merge otherwise).
    ``owners`` (the PIP-8 owner list) enables the optional JN-14 inner join
    that keeps only retailers with an owner; the reference has it commented
    out, so it is off by default.
    """
    fr = fill.select("COUNTRY", "PRODUCT_ID", "FR", "TOTAL_PRODUCTS", "COUNT_REPLACED", "GMV_TOTAL")
    dr = defects.select("COUNTRY", F.col("PID").alias("PRODUCT_ID"), "PRODUCT_DR")
    fd = feed.select("COUNTRY", F.col("RETAIL_ID").alias("SKU"), F.col("NAME").alias("NAME_INT"), "DESCRIPTION",
                     F.col("TRADEMARK").alias("TRADEMARK_INT"), "MEDIAN_PRICE", "IMAGE_URL",
                     F.col("QUANTITY").alias("QUANTITY_INT"), "UNIT_TYPE", "MIN_QUANTITY_IN_GRAMS",
                     "STEP_QUANTITY_IN_GRAMS")
    out = (base.join(dr, on=["COUNTRY", "PRODUCT_ID"], how="left")
           .join(fr, on=["COUNTRY", "PRODUCT_ID"], how="left")
           .join(fd, on=["COUNTRY", "SKU"], how="left"))
    out = keep_sellable(with_membership(out, sot_ids, sot_on))
    if owners is not None:
        o = owners.select(F.col("COUNTRY_CODE").alias("COUNTRY"), F.col("CP_RETAILER_ID").alias("RETAILER_ID"))
        out = out.join(o.distinct(), on=["COUNTRY", "RETAILER_ID"], how="left_semi")
    return out.distinct() if dedupe else out


def with_group_nunique(df: DataFrame, key: Sequence[str], value: str, out: str) -> DataFrame:
    """AGG-7 / R5: distinct count of ``value`` per key, attached to every row.

    Aggregate + join back instead of ``size(collect_set) OVER``: the
    aggregate is partial (map-side) and a hot key never has to be buffered
    in one window task. Rows with a NULL key get NULL, like pandas.
    """
    keys = list(key)
    counts = df.groupBy(*keys).agg(F.count_distinct(value).alias(out))
    nonnull = F.lit(True)
    for k in keys:
        nonnull = nonnull & F.col(k).isNotNull()
    return df.join(counts.where(nonnull), on=keys, how="left")


def enrich_retailer_products(rp: DataFrame, country_keys: Sequence[str] = ("COUNTRY",)) -> DataFrame:
    """PIP-2: rows with a feed name, distinct RPs per MP, name agreement,
    suggested quantity/unit and the per-kg flag."""
    out = rp.where(F.col("NAME_INT").isNotNull())
    out = with_group_nunique(out, [*country_keys, "MASTER_PRODUCT_ID"], "PRODUCT_ID", "N_ASSOCIATED_RETAILERS")
    out = P.with_pair_scores(out, "NAME", "NAME_INT", scores=("name_agreement",)) \
        .withColumnRenamed("name_agreement", "SIMILARITY")
    q, u = T.quantity_unit(F.col("NAME_INT"))
    return out.withColumns({"SUGGESTED_QUANTITY": q, "SUGGESTED_UNITYPE": u,
                            "PRICE_PER_KG": T.is_per_kg(F.col("NAME_INT"))})


def fill_keys(df: DataFrame, keys: Sequence[str] = ROLLUP_KEYS, value: str = NULL_VALUE) -> DataFrame:
    """SC-22: NULL string keys become the placeholder (other types keep NULL groups)."""
    strings = [k for k in keys if dict(df.dtypes)[k] == "string"]
    return df.na.fill(value, subset=strings) if strings else df


def rollup_products(rp: DataFrame, keys: Sequence[str] = ROLLUP_KEYS) -> DataFrame:
    """AGG-6: MP roll-up of RP rows by the nine keys.

    Means skip NULLs; sums of all-NULL groups are 0 (pandas), not NULL;
    distinct RPs; exact medians of name similarity and feed price (skew-safe,
    joined back on the keys, see ``operators.median``).
    """
    filled = fill_keys(rp, keys)
    agg = filled.groupBy(*keys).agg(
        F.avg("FR").alias("M_FR"), F.avg("PRODUCT_DR").alias("PRODUCT_DR"),
        F.coalesce(F.sum("TOTAL_PRODUCTS"), F.lit(0)).alias("TOTAL_PRODUCTS"),
        F.coalesce(F.sum("COUNT_REPLACED"), F.lit(0)).alias("COUNT_REPLACED"),
        F.coalesce(F.sum("GMV_TOTAL"), F.lit(0.0)).alias("GMV_T"),
        F.count_distinct("PRODUCT_ID").alias("N_ASSOCIATED_RETAILERS"))
    return with_medians(agg, filled, keys, {"SIMILARITY": "SIMILARITY", "MEDIAN_PRICE": "MEDIAN_PRICE"})


def split_by_membership(df: DataFrame, ids: DataFrame, on: Sequence[str] = ("MASTER_PRODUCT_ID",)):
    """JN-6 / JN-7 / SET-2: (rows in the curated set, rows not in it).

    Semi and anti joins on the distinct ids: NULL-safe, unlike ``NOT IN``.
    """
    keys = list(on)
    d = ids.select(*keys).distinct()
    return df.join(d, on=keys, how="left_semi"), df.join(d, on=keys, how="left_anti")


def membership_counts(df: DataFrame, by: Sequence[str] = ("COUNTRY",), flag: str = "IN_SOT",
                      mp: str = "MASTER_PRODUCT_ID") -> DataFrame:
    """FLT-7: rows and distinct MPs with / without the flag, one aggregate."""
    return df.groupBy(*by, flag).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(mp).alias("n_mps"))


def uniformity(df: DataFrame, key: Sequence[str] = ("COUNTRY", "MASTER_PRODUCT_ID"),
               attrs: Sequence[str] = ("NAME", "CAT1_NAME", "CAT2_NAME", "CAT3_NAME", "MAKER",
                                       "TRADEMARK", "IN_SOT")) -> DataFrame:
    """PIP-6: MPs whose RPs disagree on any other roll-up key, as rows with the
    number of distinct values per key.

    A clean catalog returns no rows. NULL keys are filled first, as before
    the roll-up, so NULL counts as its own value. An MP disagrees on a key
    exactly when min != max over its rows, which one plain (partial) aggregate
    finds; the distinct counts, whose plan expands every row once per key, are
    then taken only over the rows of the disagreeing MPs.
    """
    keys = list(key)
    vals = {a: F.coalesce(F.col(a).cast("string"), F.lit(NULL_VALUE)) for a in attrs}
    filled = fill_keys(df, [*keys, *attrs]).select(*keys, *[v.alias(a) for a, v in vals.items()])
    spans = filled.groupBy(*keys).agg(*[(F.min(a) != F.max(a)).alias(f"_d_{a}") for a in attrs])
    bad = F.lit(False)
    for a in attrs:
        bad = bad | F.col(f"_d_{a}")
    flagged = spans.where(bad).select(*keys)
    rows = filled.join(flagged, on=keys, how="left_semi")
    return rows.groupBy(*keys).agg(*[F.count_distinct(a).alias(f"n_{a}") for a in attrs])


def uniformity_gate(rps: DataFrame, by: Sequence[str] = ("COUNTRY",), flag: str = "IN_SOT",
                    mp: str = "MASTER_PRODUCT_ID") -> tuple[DataFrame, DataFrame]:
    """PIP-6 with PIP-7 keys: (rows of the groups that may go on, report by group).

    A group (a country) is held back when any of its curated MPs disagrees on a
    roll-up key. The report has a row for every group: curated MPs, how many of
    them disagree, on which keys, and whether the group is held back. All groups
    are decided in one job; a NULL group is one of them.
    """
    attrs = [k for k in ROLLUP_KEYS if k not in (*by, mp)]
    named = fill_keys(rps, by)
    bad = uniformity(named.where(flag), [*by, mp], attrs)
    wrong = bad.groupBy(*by).agg(F.count(F.lit(1)).alias("n_disagreeing"), *[F.count_if(F.col(f"n_{a}") > 1).alias(f"n_{a}") for a in attrs])
    report = named.groupBy(*by).agg(F.count_distinct(F.when(F.col(flag), F.col(mp))).alias("n_curated")).join(wrong, list(by), "left")
    report = report.na.fill(0, subset=["n_disagreeing", *[f"n_{a}" for a in attrs]]).withColumn("held_back", F.col("n_disagreeing") > 0)
    held = report.where("held_back").select(*[F.col(k).alias(f"_h_{k}") for k in by])
    same = [F.coalesce(F.col(k), F.lit(NULL_VALUE)) == F.col(f"_h_{k}") for k in by]
    return rps.join(held, same, "left_anti"), report


class CatalogFrames(NamedTuple):
    """The five frames of the extract step (SOT MPs, all RPs, non-SOT MPs, non-SOT RPs, all MPs)."""
    sot_mps: DataFrame
    rps: DataFrame
    opportunity_mps: DataFrame
    opportunity_rps: DataFrame
    mps: DataFrame
    gate: DataFrame | None = None      # report of the uniformity gate, where it is on


def extract_catalog(base: DataFrame, fill: DataFrame, defects: DataFrame, feed: DataFrame,
                    sot_ids: DataFrame, sot_on: Sequence[str] = ("MASTER_PRODUCT_ID",),
                    uniform_only: bool = False) -> CatalogFrames:
    """PIP-1..3 composed: assemble, enrich, roll up and split by the SOT.

    ``uniform_only`` holds back every country in which curated MPs disagree on a
    roll-up key (PIP-6): none of its rows goes on.
    """
    rps = materialize(enrich_retailer_products(assemble_catalog(base, fill, defects, feed, sot_ids, sot_on)))
    gate = None
    if uniform_only:
        rps, gate = uniformity_gate(rps)
        rps = materialize(rps)
    # The roll-up feeds the SOT split, the opportunity split, the GMV total
    # and the export: compute it (and its medians) once.
    mps = materialize(rollup_products(rps))
    sot_mps, opp_mps = split_by_membership(mps, sot_ids, sot_on)
    _, opp_rps = split_by_membership(rps, sot_ids, sot_on)
    return CatalogFrames(sot_mps, fill_keys(rps), opp_mps, opp_rps, mps, gate)
