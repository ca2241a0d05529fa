"""Plan shape and end-to-end smoke tests on the given tables."""

import pytest

import __spark_entry__ as E
from shelfmatch.plans import registry
from shelfmatch.sources.published import Published
from tests.conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_oracle_or_is_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    # The training-data queries are checked by tests of their own.
    rows_only = set(registry.QUERIES) - set(registry.ORACLES)
    assert rows_only == {"token_ratios", "catalog_pipeline"}


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs_on_smallest_scale(spark, name):
    df = E.queries()[name](spark, SF001)
    df.limit(5).collect()


def test_topk_uses_partial_group_limit(spark):
    df = E.queries()["topk_cosine"](spark, SF001)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p


def test_pipeline_has_no_single_partition_exchange_or_row_udf(spark):
    df = E.queries()["catalog_pipeline"](spark, SF001)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    lines = p.split("\n")
    # One task may merge Spark's own run-time join filters, which are of fixed size; it gets nothing else.
    alone = [lines[i + 1] for i, line in enumerate(lines) if "SinglePartition" in line]
    assert all("partial_bloom_filter_agg" in line for line in alone)
    assert "BatchEvalPython" not in p


def test_date_window_reaches_parquet_scan(spark):
    df = E.queries()["fill_rate"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_pipeline_writes_sinks(spark, tmp_out):
    import os
    from shelfmatch.plans import pipeline as PL
    from shelfmatch.plans import standins as S
    t = PL.tables_from_testdata(spark, SF001)
    p = PL.Params(as_of=S.AS_OF, defect_join_keys=("ORDER_ID",), reasons=S.TICKET_REASONS)
    sheet_path, log_path = os.path.join(tmp_out, "sheet"), os.path.join(tmp_out, "log")
    r = PL.pipeline(t, p, sheet_path, log_path)
    sheet, log = Published(spark, sheet_path), Published(spark, log_path, keys=("RUN_ID",))
    n = r.sheet.count()
    assert sheet.read().count() == n and len(sheet.read().columns) == 29      # 28 sheet columns + COUNTRY
    assert log.read().count() == r.log.count()
    PL.pipeline(t, p, sheet_path, log_path)                                    # the same run again
    assert sheet.latest == 2 and sheet.read().count() == n and log.read().count() == r.log.count()


def test_strict_compat_first_row_lookup(spark):
    from shelfmatch.operators import matching
    cols = "COUNTRY string, NAME string, MASTER_PRODUCT_ID long, MEDIAN_PRICE double, SIMILARITY double"
    opps = spark.createDataFrame([("BR", "arroz branco", 1, 10.0, 0.5), ("BR", "arroz branco", 2, 20.0, 0.6),
                                  ("BR", "feijao preto", 3, 5.0, 0.7)], cols)
    sot = spark.createDataFrame([("BR", "arroz branco tipo 1", 9, 12.0, 0.9)], cols)
    by_row = matching.score_matches(opps, sot, row_cols=["COUNTRY", "NAME", "MASTER_PRODUCT_ID"])
    first = matching.score_matches(opps, sot, row_cols=["COUNTRY", "NAME", "MASTER_PRODUCT_ID"], strict_compat=True)
    assert sorted(r.master_product_id for r in by_row.collect() if r.master_products == "arroz branco") == [1, 2]
    # first-row lookup: both duplicate-name rows resolve to the first row's id and price
    assert {(r.master_product_id, r.price_similarity) for r in first.collect()
            if r.master_products == "arroz branco"} == {(1, 1 - 2 / 12)}


def test_assembly_shuffles_each_side_once(spark):
    from shelfmatch.operators import catalog as C
    variant = "parse_json('{}') AS SELL_TYPE, parse_json('{}') AS PRESENTATION, 'published' AS STATUS, false AS IS_DELETED"
    rp = spark.range(9).selectExpr("'A' || (id % 2) AS COUNTRY", "id AS ID", "id % 3 AS PRODUCT_ID", "'s' || id AS SKU", *variant.split(", "))
    mp = spark.range(6).selectExpr("'A' || (id % 2) AS COUNTRY", "id DIV 2 AS ID", *variant.split(", "))
    labels = mp.selectExpr("COUNTRY", "ID AS MASTER_PRODUCT_ID", "'g' AS QUALITY_LABEL", "1 AS PRIORITY", "2 AS ASSOCIATED_RETAILERS")
    names = rp.selectExpr("COUNTRY", "ID AS RETAILER_PRODUCT_ID", "'n' AS MP_NAME", *[f"'x' AS {c}" for c in C.RP_ANALYTICS_COLUMNS])
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(before, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        live = C.sell_and_presentation(rp, mp)
        out = C.catalog_base(live, names, labels)
        exchanges = [d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for d in (live, out)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert exchanges == [2, 5]      # DISTINCT and the MP side keep the hashing of the first join
    assert out.count() == 9 and out.columns[:3] == ["COUNTRY", "MASTER_PRODUCT_ID", "PRODUCT_ID"]


def test_both_rates_read_the_order_lines_once(spark):
    from shelfmatch.plans import catalog_queries as CQ
    for rate in CQ.metric_inputs(spark, SF001):
        assert not [f for f in rate.inputFiles() if "lineitem" in f] and rate.inputFiles()


def test_refresh_makes_the_enriched_rows_of_a_batch_once(spark, monkeypatch):
    from shelfmatch.operators import catalog as C
    from shelfmatch.plans import standins as S
    from shelfmatch.plans import table_queries as TQ
    seen, made = [], C.rollup_products
    monkeypatch.setattr(C, "rollup_products", lambda rps: (seen.append(plan(rps)), made(rps))[1])
    TQ.refresh_inputs(spark, SF001).process(S.feed(spark, SF001).limit(50), 0)
    assert len(seen) == 1 and "Join" not in seen[0]     # read by the sums and by the medians
