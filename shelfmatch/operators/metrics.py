"""Per-product metrics: fill rate, defect rate, feed snapshot, owner list
(AGG-1..5, FLT-1, FLT-2, FLT-6, FLT-9, JN-1, PIP-8, SC-1..7).

Date windows are turned into a literal lower bound on the raw timestamp
column, so the predicate reaches the Parquet scan as a pushed filter instead
of a per-row ``to_date`` on the column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.operators.median import with_medians

# Ticket reasons that count as a defect (FLT-6).
DEFECT_REASONS = ("Different product", "Missing product", "Disagree with charge",
                  "Double charged", "Cost of products", "Product in poor condition")


def _as_date(as_of) -> dt.date:
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    if isinstance(as_of, dt.date):
        return as_of
    return dt.date.fromisoformat(str(as_of))


def week_window_start(as_of, weeks: int) -> dt.datetime:
    """FLT-1: Monday of ``as_of``'s week minus ``weeks`` weeks, at midnight."""
    d = _as_date(as_of)
    monday = d - dt.timedelta(days=d.weekday())
    return dt.datetime.combine(monday - dt.timedelta(weeks=weeks), dt.time())


def on_or_after(c: str, day: dt.date | dt.datetime) -> Column:
    """``to_date(c) >= day`` written as ``c >= day 00:00`` (pushdown-friendly)."""
    if not isinstance(day, dt.datetime):
        day = dt.datetime.combine(day, dt.time())
    return F.col(c) >= F.lit(day)


def flag(cond: Column) -> Column:
    """IFF(cond, 1, 0): NULL conditions count as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def fill_rate(order_lines: DataFrame, as_of, weeks: int = 12,
              keys: Sequence[str] = ("COUNTRY", "PRODUCT_ID"), with_orders: bool = True) -> DataFrame:
    """AGG-1..3: found / replaced / refunded counts, fill rate and GMV per product.

    A line with STOCKOUT=0 and SUBSTITUTED=1 counts as found *and* replaced.
    FR is NULL when the total is 0 (``try_divide``).
    """
    lines = order_lines.where(on_or_after("CREATED_AT_ORDER", week_window_start(as_of, weeks)))
    aggs = [F.sum(flag(F.col("STOCKOUT") == 0)).alias("COUNT_FOUND"),
            F.sum(flag(F.col("SUBSTITUTED") == 1)).alias("COUNT_REPLACED"),
            F.sum(flag((F.col("STOCKOUT") == 1) & (F.col("SUBSTITUTED") == 0))).alias("COUNT_REFUNDED"),
            F.sum(F.coalesce(F.col("TOTAL_PRICE"), F.lit(0))).alias("GMV_TOTAL")]
    if with_orders:
        aggs.append(F.count_distinct("ORDER_ID").alias("N_ORDERS"))
    out = lines.groupBy(*keys).agg(*aggs)
    total = F.col("COUNT_FOUND") + F.col("COUNT_REPLACED") + F.col("COUNT_REFUNDED")
    return (out.withColumn("TOTAL_PRODUCTS", total)
            .withColumn("FR", F.try_divide(F.col("COUNT_FOUND").cast("double"), F.col("TOTAL_PRODUCTS"))))


#: log2 of the sketch's registers: about 1.6 % standard error of a distinct count (small counts are exact).
SKETCH_LG_K = 12


def weekly_partials(order_lines: DataFrame, keys: Sequence[str] = ("COUNTRY", "PRODUCT_ID"), lg_k: int = SKETCH_LG_K) -> DataFrame:
    """AGG-1..3 as mergeable partials: the fill-rate sums of each key and week (from Monday), and a
    distinct-count sketch of its orders. Sums add up and sketches merge, so any window of whole weeks is
    made from these rows without its lines; a week's rows depend on that week's lines only."""
    week = F.date_format(F.date_trunc("WEEK", "CREATED_AT_ORDER"), "yyyy-MM-dd")
    return order_lines.groupBy(*keys, week.alias("WEEK")).agg(
        F.sum(flag(F.col("STOCKOUT") == 0)).alias("COUNT_FOUND"), F.sum(flag(F.col("SUBSTITUTED") == 1)).alias("COUNT_REPLACED"),
        F.sum(flag((F.col("STOCKOUT") == 1) & (F.col("SUBSTITUTED") == 0))).alias("COUNT_REFUNDED"),
        F.sum(F.coalesce(F.col("TOTAL_PRICE"), F.lit(0))).alias("GMV_TOTAL"), F.hll_sketch_agg("ORDER_ID", lg_k).alias("ORDERS"))


def fill_rate_of_weeks(partials: DataFrame, as_of, weeks: int = 12, keys: Sequence[str] = ("COUNTRY", "PRODUCT_ID")) -> DataFrame:
    """:func:`fill_rate` from :func:`weekly_partials`: the same sums; N_ORDERS is the merged sketch's estimate.

    The window opens on a Monday, so it is whole weeks; a filter on WEEK is a partition filter of a
    table that is kept by week."""
    rows = partials.where(F.col("WEEK") >= F.lit(week_window_start(as_of, weeks).date().isoformat()))
    counts = ("COUNT_FOUND", "COUNT_REPLACED", "COUNT_REFUNDED")
    out = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts], F.sum("GMV_TOTAL").alias("GMV_TOTAL"),
                                  F.hll_sketch_estimate(F.hll_union_agg("ORDERS")).alias("N_ORDERS"))
    out = out.withColumn("TOTAL_PRODUCTS", sum((F.col(c) for c in counts[1:]), F.col(counts[0])))
    return out.withColumn("FR", F.try_divide(F.col("COUNT_FOUND").cast("double"), F.col("TOTAL_PRODUCTS")))


def defect_rate(order_products: DataFrame, tickets: DataFrame, as_of, days: int = 30,
                reasons: Sequence[str] = DEFECT_REASONS,
                join_keys: Sequence[str] = ("COUNTRY", "ORDER_ID", "CONVERSATION_ID"),
                group_keys: Sequence[str] = ("COUNTRY", "PID"), reason_col: str = "LEVEL_2") -> DataFrame:
    """AGG-4 / JN-1: requested and defective counts, DR rounded to 4 places, DR > 0.

    The reason list sits in the join condition (left join), which is the
    same as filtering the ticket side first. An order with several matching
    tickets fans out and counts several times, as written in the reference.
    Rows with NULL join keys cannot match; AQE's skew handling splits a hot
    (including NULL) key partition of the left side.
    """
    since = _as_date(as_of) - dt.timedelta(days=days)
    a = order_products.where(on_or_after("DT_REF", since)).alias("a")
    b = (tickets.where(F.col(reason_col).isin(list(reasons)))
         .select(*[F.col(k).alias(f"_t_{k}") for k in join_keys]))
    cond = [F.col(f"a.{k}") == F.col(f"_t_{k}") for k in join_keys]
    j = a.join(b, on=cond, how="left")
    out = j.groupBy(*[F.col(f"a.{k}") for k in group_keys]).agg(
        F.count(F.lit(1)).alias("QTY_REQUESTED"),
        F.count(F.col(f"_t_{join_keys[0]}")).alias("QTY_DEFECTIVE"))
    out = out.withColumn("PRODUCT_DR", F.round(F.col("QTY_DEFECTIVE") / F.col("QTY_REQUESTED"), 4))
    return out.where(F.col("PRODUCT_DR") > 0)


FEED_MAX_COLS = ("NAME", "DESCRIPTION", "TRADEMARK", "IMAGE_URL", "QUANTITY", "UNIT_TYPE",
                 "MIN_QUANTITY_IN_GRAMS", "STEP_QUANTITY_IN_GRAMS")


def feed_snapshot(feed: DataFrame, as_of, days: int = 15, key: str = "RETAIL_ID",
                  country: str = "COUNTRY", max_cols: Sequence[str] = FEED_MAX_COLS,
                  price: str = "PRICE") -> DataFrame:
    """AGG-5: per (country, retail id) the MAX of each attribute independently
    (values may come from different rows) and the exact median price, over
    feed rows with a name executed in the last ``days`` days (exclusive).
    The median is the skew-safe one (``operators.median``)."""
    since = _as_date(as_of) - dt.timedelta(days=days - 1)
    rows = feed.where(F.col("NAME").isNotNull() & on_or_after("EXECUTION_DATE", since))
    out = rows.groupBy(country, key).agg(*[F.max(c).alias(c) for c in max_cols])
    out = with_medians(out, rows, [country, key], {"MEDIAN_PRICE": price})
    cols = list(max_cols)
    cols.insert(3, "MEDIAN_PRICE")
    return out.select(country, key, *cols)


def owner_list(links: DataFrame, exclude: Sequence[str] = (),
               cols: Sequence[str] = ("COUNTRY_CODE", "CP_RETAILER_ID", "TAM")) -> DataFrame:
    """PIP-8: distinct (country, retailer, owner), owner and retailer non-null,
    owners in ``exclude`` removed."""
    country, retailer, owner = cols
    out = links.where(F.col(owner).isNotNull() & F.col(retailer).isNotNull())
    if exclude:
        out = out.where(~F.col(owner).isin(list(exclude)))
    return out.select(country, retailer, owner).distinct()


def json_path(c: Column, path: str, to: str = "string", variant: bool = False) -> Column:
    """SC-3: typed value at a JSON path of a JSON text column, or of a VARIANT
    column with ``variant=True`` (``try_variant_get``).

    A JSON null, a missing path or an uncastable value all give SQL NULL, so
    a surrounding COALESCE falls through to the next argument.
    """
    if variant:
        return F.try_variant_get(c, path, to)
    return F.get_json_object(c, path).try_cast(to)


def json_coalesce(primary: Column, fallback: Column, path: str, to: str = "string",
                  variant: bool = False) -> Column:
    """SC-2: the RP value at ``path`` if present, else the MP value."""
    return F.coalesce(json_path(primary, path, to, variant), json_path(fallback, path, to, variant))
