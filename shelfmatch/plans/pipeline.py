"""The composed job (PIP-4, PIP-7): all countries in one lazy plan.

extract (assemble → enrich → roll up → split) → match (trigram TF-IDF top-k
per country + secondary scores) → best match per opportunity (floor) →
prioritise (GMV share, budget prefix) → export (sheet rows + match log).
Countries are a key of every join, aggregate and window instead of a loop,
so the plan is the same for 1 or 100 countries and the only action is the
sink write.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.functions.pairsim import CONFIDENCE_WEIGHTS
from shelfmatch.operators import catalog as C
from shelfmatch.operators import export as X
from shelfmatch.operators import matching
from shelfmatch.operators import metrics as M
from shelfmatch.operators import rank as R
from shelfmatch.session import materialize, stored
from shelfmatch.sources.published import Published


@dataclass(frozen=True)
class Params:
    """Effective parameters of the job (the reference's per-country
    threshold table is never read, so it is not modelled)."""
    as_of: object
    floor: float = 0.5
    budget: int = 500
    k: int = 10
    weights: dict = field(default_factory=lambda: dict(CONFIDENCE_WEIGHTS))
    fill_weeks: int = 12
    defect_days: int = 30
    feed_days: int = 15
    reasons: tuple = M.DEFECT_REASONS
    defect_join_keys: tuple = ("COUNTRY", "ORDER_ID", "CONVERSATION_ID")
    strict_compat: bool = False
    push_floor_below_topk: bool = True
    hold_back_disagreeing: bool = False


class Tables(NamedTuple):
    """Inputs in the reference's roles (see FIXTURES.md part A)."""
    retailer_products: DataFrame
    master_products: DataFrame
    rp_analytics: DataFrame
    mp_analytics: DataFrame
    order_lines: DataFrame
    order_products: DataFrame
    tickets: DataFrame
    feed: DataFrame
    sot_ids: DataFrame
    products: DataFrame


class Result(NamedTuple):
    catalog: C.CatalogFrames
    scored: DataFrame
    best: DataFrame
    prioritised: DataFrame
    sheet: DataFrame
    log: DataFrame


def extract(t: Tables, p: Params) -> C.CatalogFrames:
    """PIP-1..3 from the raw tables. Curated ids with a COUNTRY hold for that country only."""
    fill = M.fill_rate(t.order_lines, p.as_of, p.fill_weeks, with_orders=False)
    defects = M.defect_rate(t.order_products, t.tickets, p.as_of, p.defect_days, p.reasons,
                            join_keys=p.defect_join_keys)
    # Read for its keys and for its columns. As files its size is known (a small one is broadcast), and its
    # partitioning is not, so that a snapshot of one partition does not draw the catalog into one.
    feed = stored(M.feed_snapshot(t.feed, p.as_of, p.feed_days), "snapshot")
    base = C.feed_base(t.retailer_products, t.master_products, t.rp_analytics, t.mp_analytics, feed)
    sot_on = [*(["COUNTRY"] if "COUNTRY" in t.sot_ids.columns else []), "MASTER_PRODUCT_ID"]
    return C.extract_catalog(base, fill, defects, feed, t.sot_ids, sot_on, uniform_only=p.hold_back_disagreeing)


def run(t: Tables, p: Params) -> Result:
    cat = extract(t, p)
    scored = matching.score_matches(
        cat.opportunity_mps, cat.sot_mps, keys=("COUNTRY",), row_cols=C.ROLLUP_KEYS, k=p.k,
        weights=p.weights, min_similarity=p.floor if p.push_floor_below_topk else None,
        strict_compat=p.strict_compat)
    # Read by the best-match pick and, through it, twice by the export: score once (R7).
    scored = materialize(scored)
    best = R.best_matches(scored, key=["COUNTRY", "master_product_id"], score="similarity",
                          tie="master_product_id_sot", floor=p.floor)
    best = best.withColumnsRenamed({"integration": "master_sot", "master_products": "master_cp"})
    prio = R.prioritise(best, cat.mps, budget=p.budget)
    sheet, log = X.enrich_export(prio, cat.opportunity_rps, t.products, cat.sot_mps, cat.rps,
                                 strict_compat=p.strict_compat)
    return Result(cat, scored, best, prio, sheet, log)


def pipeline(t: Tables, p: Params, sheet_path: str | None = None, log_path: str | None = None,
             run_id: str | None = None) -> Result:
    """Run the job and, when paths are given, publish its outputs (SNK-1..3).

    The sheet replaces every country of the catalog in one version; the log gets the rows
    of this run, ``run_id`` (by default its clock), which replace those of the same run.
    Both are read through :class:`~shelfmatch.sources.published.Published`.
    """
    r = run(t, p)
    spark = r.sheet.sparkSession
    if sheet_path:
        countries = [c[0] for c in t.retailer_products.select("COUNTRY").distinct().collect()]      # one row per country
        Published(spark, sheet_path).replace(r.sheet, countries, note=str(p.as_of))
    if log_path:
        run_id = run_id or str(p.as_of)
        Published(spark, log_path, keys=("RUN_ID",)).replace(r.log.withColumn("RUN_ID", F.lit(run_id)), [run_id])
    return r


def tables_from_testdata(spark: SparkSession, sf: str) -> Tables:
    from shelfmatch.plans import standins as S
    return Tables(S.retailer_products(spark, sf), S.master_products(spark, sf), S.rp_analytics(spark, sf),
                  S.mp_analytics(spark, sf), S.order_lines(spark, sf), S.order_products(spark, sf), S.tickets(spark, sf), S.feed(spark, sf), S.sot(spark, sf),
                  S.products(spark, sf))
