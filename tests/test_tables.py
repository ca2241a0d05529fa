"""Published tables, per-country tables and the refresh."""

import os

import pytest
from pyspark.sql import functions as F

from shelfmatch.sources.published import Published
from shelfmatch.sources.tables import country_scan, country_table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, ddl="COUNTRY string, v long, price decimal(8,2)"):
    return spark.createDataFrame(data, ddl)


def test_replace_keeps_other_countries_and_empties_handled_ones(spark, tmp_out):
    from decimal import Decimal as D
    t = Published(spark, f"{tmp_out}/t")
    assert t.latest is None and t.versions() == []
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.replace(frame(spark, [("BR", 1, D("1.50")), ("CO", 2, None), ("01", 3, None), (None, 4, None)])) == 1
    first = rows(t.read())
    assert first == rows(frame(spark, [("BR", 1, "1.50"), ("CO", 2, None), ("01", 3, None), (None, 4, None)], "COUNTRY string, v long, price string"))
    assert t.replace(frame(spark, [("BR", 9, None)]), handled=["BR", "CO"], note="second") == 2
    assert [r[:2] for r in rows(t.read())] == [("01", 3), ("BR", 9), (None, 4)]
    assert rows(t.read(1)) == first                                     # an earlier version still reads whole
    assert {m["COUNTRY"]: m["run"] is None for m in t.manifest()} == {"BR": False, "CO": True, "01": False, None: False}
    t.replace(frame(spark, []), handled=["BR", "01"])
    assert [r[:2] for r in rows(t.read())] == [(None, 4)]
    t.replace(frame(spark, [(None, 5, None)]))
    assert [r[:2] for r in rows(t.read())] == [(None, 5)]


def test_readers_never_see_an_unfinished_replace(spark, tmp_out, monkeypatch):
    t = Published(spark, f"{tmp_out}/t")
    t.replace(frame(spark, [("BR", 1, None), ("CO", 2, None)]))
    before = rows(t.read())
    with monkeypatch.context() as m:                                    # the writer dies after staging its rows
        m.setattr(Published, "manifest", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            t.replace(frame(spark, [("BR", 7, None)]))
    assert rows(t.read()) == before and len(os.listdir(f"{tmp_out}/t/data")) >= 2
    os.makedirs(f"{tmp_out}/t/manifest/version=2")                      # or before the manifest is committed
    assert t.latest == 1 and rows(t.read()) == before
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):         # a second writer of that version is refused
        t.replace(frame(spark, [("BR", 7, None)]))
    assert rows(t.read()) == before


def test_columns_may_be_added_and_clash_with_nothing(spark, tmp_out):
    t = Published(spark, f"{tmp_out}/t", keys=("RUN_ID", "k"))
    t.replace(spark.createDataFrame([("a", 1, 5)], "RUN_ID string, k int, run long"))
    t.replace(spark.createDataFrame([("b", 2, 6, "x")], "RUN_ID string, k int, run long, note string"))
    got = t.read()
    assert got.columns == ["RUN_ID", "k", "run", "note"] and rows(got) == [("a", 1, 5, None), ("b", 2, 6, "x")]
    plan = got.where("RUN_ID = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_key_RUN_ID" in plan.split("PartitionFilters: [")[1]


def test_country_table_and_pruned_scan(spark, tmp_out):
    for i, c in enumerate(("BR", "CO", "MX", "A-B")):
        df = spark.range(i * 10, i * 10 + 3)
        (df.withColumn("extra", F.lit(i)) if c == "MX" else df).createOrReplaceTempView(f"`{c}_t`")
    t = country_table(spark, "{country}_t", ["BR", "CO", "MX", "A-B"], f"{tmp_out}/t")
    assert t.count() == 12 and t.where("COUNTRY = 'MX'").select("extra").distinct().collect()[0][0] == 2
    params = spark.createDataFrame([("BR", 5), ("A-B", 6), ("ZZ", 7), (None, 8)], "COUNTRY string, floor int")
    got = country_scan(t, params)
    assert rows(got.select("id", "COUNTRY", "floor")) == sorted([(i, "BR", 5) for i in range(3)] + [(i, "A-B", 6) for i in range(30, 33)], key=repr)
    done = got.select("id", "COUNTRY", "floor")
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    country_table(spark, "{country}_t", ["BR"], f"{tmp_out}/t")        # a run of one country leaves the others
    assert spark.read.parquet(f"{tmp_out}/t").count() == 12
    with pytest.raises(ValueError):
        country_scan(t, params.unionByName(params))
    with pytest.raises(ValueError):
        country_table(spark, "{country}_t", [], f"{tmp_out}/t")


def test_refresh_touches_only_the_buckets_of_its_products(spark, tmp_out):
    from shelfmatch.plans import table_queries as Q
    from shelfmatch.plans.catalog_queries import mp_rollup, rollup_columns
    sf = "/root/testdata/sf0.001"
    refresh, files = Q.refresh_inputs(spark, sf), Q.feed_files(spark, sf, 2)
    feed = spark.read.parquet(files)
    one = feed.where(F.pmod(F.xxhash64("PRICE"), F.lit(2)) == 0)
    refresh.process(one, 0)
    first = {m["bucket"]: m["run"] for m in refresh.table(spark).manifest()}
    rest = feed.exceptAll(one).limit(1)
    refresh.process(rest, 1)
    second = {m["bucket"]: m["run"] for m in refresh.table(spark).manifest()}
    assert sum(first.get(b) != r for b, r in second.items()) <= 1      # one row touches one product
    refresh.process(feed.exceptAll(one).exceptAll(rest), 2)
    want = rows(mp_rollup(spark, sf))
    assert rows(rollup_columns(refresh.rows(spark))) == want
    refresh.process(spark.read.schema(feed.schema).parquet(f"{refresh.path}/feed/batch=2"), 2)
    assert rows(rollup_columns(refresh.rows(spark))) == want
    refresh.process(feed.limit(0), 3)                                   # an empty batch changes nothing
    assert rows(rollup_columns(refresh.rows(spark))) == want


def test_gate_holds_back_whole_countries(spark):
    from shelfmatch.operators import catalog as C
    cols = "COUNTRY string, NAME string, MASTER_PRODUCT_ID long, CAT1_NAME string, CAT2_NAME string, CAT3_NAME string, MAKER string, TRADEMARK string, IN_SOT boolean"
    row = lambda c, mp, cat3, sot: (c, "n", mp, "a", "b", cat3, "m", "t", sot)
    rps = spark.createDataFrame([row("BR", 1, "x", True), row("BR", 1, "y", True), row("BR", 2, "x", False), row("CL", 1, "x", True), row("CL", 1, "x", True),
                                 row("CO", 3, "x", False), row("CO", 3, "y", False), row(None, 4, None, True), row(None, 4, "z", True)], cols)
    kept, report = C.uniformity_gate(rps)
    assert {r.COUNTRY for r in kept.collect()} == {"CL", "CO"}          # CO disagrees on a product that is not curated
    assert {(r.COUNTRY, r.n_curated, r.n_disagreeing, r.n_CAT3_NAME, r.held_back) for r in report.collect()} == {
        ("BR", 1, 1, 1, True), ("CL", 1, 0, 0, False), ("CO", 0, 0, 0, False), ("NULL_VALUE", 1, 1, 1, True)}


def test_weekly_partials_add_up_and_sketches_stay_within_their_error(spark, tmp_out):
    import datetime as dt
    from shelfmatch.operators import metrics as M
    lines = spark.range(60000).select(
        F.element_at(F.array(F.lit("BR"), F.lit("CO"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("COUNTRY"), (F.col("id") % 5).alias("PRODUCT_ID"),
        F.pmod(F.xxhash64("id"), F.lit(9000)).alias("ORDER_ID"), (F.col("id") % 2).cast("int").alias("STOCKOUT"), F.when(F.col("id") % 7 > 0, F.col("id") % 4 % 2).cast("int").alias("SUBSTITUTED"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 0.25).alias("TOTAL_PRICE"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 190).alias("CREATED_AT_ORDER"))
    t = Published(spark, f"{tmp_out}/weeks", keys=("WEEK",))
    cut = F.col("CREATED_AT_ORDER") < F.lit(dt.datetime(2024, 4, 1))
    t.replace(M.weekly_partials(lines.where(cut)))
    t.replace(M.weekly_partials(lines.where(~cut)))
    sums = ["COUNTRY", "PRODUCT_ID", "COUNT_FOUND", "COUNT_REPLACED", "COUNT_REFUNDED", "TOTAL_PRODUCTS", "FR", "GMV_TOTAL"]
    for as_of, weeks in ((dt.date(2024, 4, 10), 12), (dt.date(2024, 4, 17), 3), (dt.date(2030, 1, 1), 2)):
        want = M.fill_rate(lines, as_of, weeks)
        got = M.fill_rate_of_weeks(t.read(), as_of, weeks)
        assert rows(got.select(*sums)) == rows(want.select(*sums))
        exact = {(r.COUNTRY, r.PRODUCT_ID): r.N_ORDERS for r in want.collect()}
        # four standard errors of a sketch of 2 ** 12 registers
        assert all(abs(r.N_ORDERS - exact[r.COUNTRY, r.PRODUCT_ID]) <= 4 * 1.04 / 64 * exact[r.COUNTRY, r.PRODUCT_ID] for r in got.collect())
    plan = M.fill_rate_of_weeks(t.read(), dt.date(2024, 4, 10))._jdf.queryExecution().executedPlan().toString()
    assert "_key_WEEK" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
