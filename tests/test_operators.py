"""Metrics, catalog, ranking and sink operators on hand-made rows (FIXTURES.md part C)."""

import datetime as dt
import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfmatch.operators import catalog as C
from shelfmatch.operators import metrics as M
from shelfmatch.operators import rank as R
from shelfmatch.operators import tfidf, trigrams
from shelfmatch.sources import sinks
from shelfmatch.sources.tables import lookup_by_ids

AS_OF = dt.date(2024, 3, 6)   # a Wednesday
TS = dt.datetime(2024, 3, 1)


def test_week_window_start():
    assert M.week_window_start(AS_OF, 12) == dt.datetime(2023, 12, 11)


def test_fill_rate_overlap_and_zero_total(spark):
    rows = [("BR", 1, 10, 0, 1, 5.0, TS), ("BR", 1, 11, 1, 0, None, TS),
            ("BR", 2, 12, None, None, 3.0, TS), ("BR", 3, 13, 0, 0, 1.0, dt.datetime(2020, 1, 1))]
    df = spark.createDataFrame(rows, "COUNTRY string, PRODUCT_ID long, ORDER_ID long, STOCKOUT int, "
                                     "SUBSTITUTED int, TOTAL_PRICE double, CREATED_AT_ORDER timestamp")
    got = {r["PRODUCT_ID"]: r for r in M.fill_rate(df, AS_OF).collect()}
    assert set(got) == {1, 2}                      # product 3 is outside the 12-week window
    p1 = got[1]
    assert (p1.COUNT_FOUND, p1.COUNT_REPLACED, p1.COUNT_REFUNDED, p1.TOTAL_PRODUCTS) == (1, 1, 1, 3)
    assert abs(p1.FR - 1 / 3) < 1e-12 and p1.GMV_TOTAL == 5.0 and p1.N_ORDERS == 2
    assert got[2].TOTAL_PRODUCTS == 0 and got[2].FR is None


def test_defect_rate_fanout_and_rounding(spark):
    op = spark.createDataFrame([("BR", 1, 100, "c1", TS)] + [("BR", 2, 200 + i, "c", TS) for i in range(30000)],
                               "COUNTRY string, PID long, ORDER_ID long, CONVERSATION_ID string, DT_REF timestamp")
    tk = spark.createDataFrame([("BR", 100, "c1", "Missing product"), ("BR", 100, "c1", "Double charged"),
                                ("BR", 100, "c1", "Other"), ("BR", 200, "c", "Missing product")],
                               "COUNTRY string, ORDER_ID long, CONVERSATION_ID string, LEVEL_2 string")
    got = {r.PID: r for r in M.defect_rate(op, tk, AS_OF).collect()}
    assert set(got) == {1}                         # 1 defect in 30,000 rounds to 0.0000 and is dropped
    assert (got[1].QTY_REQUESTED, got[1].QTY_DEFECTIVE, got[1].PRODUCT_DR) == (2, 2, 1.0)


def test_feed_snapshot_independent_max_and_median(spark):
    rows = [("BR", "r1", "a", "z", 1.0, TS), ("BR", "r1", "b", "y", 3.0, TS), ("BR", "r1", None, "x", 100.0, TS),
            ("BR", "r1", "c", "w", 2.0, dt.datetime(2020, 1, 1))]
    df = spark.createDataFrame(rows, "COUNTRY string, RETAIL_ID string, NAME string, DESCRIPTION string, "
                                     "PRICE double, EXECUTION_DATE timestamp")
    out = M.feed_snapshot(df, AS_OF, max_cols=("NAME", "DESCRIPTION")).first()
    assert (out.NAME, out.DESCRIPTION, out.MEDIAN_PRICE) == ("b", "z", 2.0)


def test_json_coalesce_fallback(spark):
    df = spark.createDataFrame([('{"a": 1}', '{"a": 2, "b": "x"}'), ('{"a": null}', '{"a": 5}'), (None, '{"a": 7}')],
                               "rp string, mp string")
    got = df.select(M.json_coalesce(F.col("rp"), F.col("mp"), "$.a", "double"),
                    M.json_coalesce(F.col("rp"), F.col("mp"), "$.b")).collect()
    assert [tuple(r) for r in got] == [(1.0, "x"), (5.0, None), (7.0, None)]


def test_sell_and_presentation_one_scan(spark):
    rp = spark.createDataFrame([(1, 10, "s1", '{"type": "U"}', '{"quantity": 2}', "published", False),
                                (2, 11, "s2", None, None, "published", False),
                                (3, 10, "s3", None, None, "draft", False)],
                               "ID long, PRODUCT_ID long, SKU string, SELL_TYPE string, PRESENTATION string, "
                               "STATUS string, IS_DELETED boolean")
    mp = spark.createDataFrame([(10, "BR", '{"type": "W", "stepQuantity": 0.5}', '{"unitType": "kg"}', "published", False),
                                (11, "BR", '{"type": "W"}', '{"quantity": 9}', "published", False)],
                               "ID long, COUNTRY string, SELL_TYPE string, PRESENTATION string, STATUS string, "
                               "IS_DELETED boolean")
    got = {r.PRODUCT_ID: r for r in C.sell_and_presentation(rp, mp).collect()}
    assert set(got) == {1, 2}
    assert (got[1].SELL_TYPE, got[1].STEP_QUANT, got[1].QUANTITY_RP, got[1].UNITY_P) == ("U", 0.5, 2.0, "kg")
    assert (got[2].SELL_TYPE, got[2].QUANTITY_RP) == ("W", 9.0)


def test_sellable_filter_null_sell_type(spark):
    df = spark.createDataFrame([(1, None, False), (2, None, True), (3, "U", False), (4, "W", False)],
                               "id int, SELL_TYPE string, IN_SOT boolean")
    assert sorted(r.id for r in C.keep_sellable(df).collect()) == [2, 4]


def test_rollup_null_keys_and_all_null_sums(spark):
    cols = "COUNTRY string, NAME string, MASTER_PRODUCT_ID long, CAT1_NAME string, CAT2_NAME string, " \
           "CAT3_NAME string, MAKER string, TRADEMARK string, IN_SOT boolean, FR double, PRODUCT_DR double, " \
           "TOTAL_PRODUCTS long, COUNT_REPLACED long, GMV_TOTAL double, PRODUCT_ID long, SIMILARITY double, " \
           "MEDIAN_PRICE double"
    rows = [("BR", "n", 1, "a", "b", "c", None, "t", False, 0.5, None, None, None, None, 10, 0.2, 1.0),
            ("BR", "n", 1, "a", "b", "c", None, "t", False, None, None, None, None, None, 11, 0.4, 3.0)]
    out = C.rollup_products(spark.createDataFrame(rows, cols)).first()
    assert out.MAKER == "NULL_VALUE" and out.TOTAL_PRODUCTS == 0 and out.GMV_T == 0.0
    assert out.M_FR == 0.5 and out.PRODUCT_DR is None and out.N_ASSOCIATED_RETAILERS == 2
    assert abs(out.SIMILARITY - 0.3) < 1e-12 and out.MEDIAN_PRICE == 2.0


def test_group_nunique_null_key(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (None, 12)], "mp long, rp long")
    got = sorted(((r.mp, r.rp, r.n) for r in C.with_group_nunique(df, ["mp"], "rp", "n").collect()),
                 key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    assert got == [(None, 12, None), (1, 10, 2), (1, 11, 2), (1, 11, 2)]


def test_uniformity_flags_disagreeing_mps(spark):
    df = spark.createDataFrame([("BR", 1, "a"), ("BR", 1, "b"), ("BR", 2, "a"), ("BR", 2, None), ("BR", 3, "x")],
                               "COUNTRY string, MASTER_PRODUCT_ID long, NAME string")
    got = sorted(r.MASTER_PRODUCT_ID for r in C.uniformity(df, attrs=("NAME",)).collect())
    assert got == [1, 2]


def test_lookup_by_ids_zero_and_one(spark):
    products = spark.createDataFrame([(1, "a"), (2, "b")], "MASTER_PRODUCT_ID long, NAME string")
    none = spark.createDataFrame([], "MASTER_PRODUCT_ID long")
    one = spark.createDataFrame([(2,)], "MASTER_PRODUCT_ID long")
    assert lookup_by_ids(products, none, "MASTER_PRODUCT_ID").count() == 0
    assert [r.NAME for r in lookup_by_ids(products, one, "MASTER_PRODUCT_ID").collect()] == ["b"]


def _procedural_prefix(amounts, budget):
    cum, kept = 0, []
    for i, a in enumerate(amounts):
        cum += a
        if cum <= budget:
            kept.append(i)
    if len(kept) < len(amounts):
        kept.append(len(kept))
    return kept


def test_budget_prefix_example(spark):
    df = spark.createDataFrame([("BR", i, 100.0 - i, a) for i, a in enumerate([300, 150, 100, 10])],
                               "COUNTRY string, id long, cov double, n long")
    got = sorted(r.id for r in R.budget_prefix(df, "cov", "n", 500, "id").collect())
    assert got == [0, 1, 2]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=60), min_size=1, max_size=40),
       st.integers(min_value=0, max_value=300))
def test_budget_prefix_equals_procedural_rule(spark, amounts, budget):
    df = spark.createDataFrame([("BR", i, float(len(amounts) - i), a) for i, a in enumerate(amounts)],
                               "COUNTRY string, id long, cov double, n long")
    got = sorted(r.id for r in R.budget_prefix(df, "cov", "n", budget, "id").collect())
    assert got == _procedural_prefix(amounts, budget)


def test_budget_prefix_keeps_zero_amounts_and_leaves_out_nulls(spark):
    rows = [("BR", i, 100.0 - i, 0) for i in range(20)] + [(None, 1, 5.0, 9), (None, 2, 4.0, 9)]
    df = spark.createDataFrame(rows + [("CO", 1, 9.0, None), ("CO", 2, 8.0, 3), ("CO", 3, 7.0, 3), ("CO", 4, 6.0, 1)],
                               "COUNTRY string, id long, cov double, n long")
    got = sorted((r.COUNTRY or "", r.id) for r in R.budget_prefix(df, "cov", "n", 5, "id").collect())
    assert got == [("", 1)] + [("BR", i) for i in range(20)] + [("CO", 2), ("CO", 3)]


def test_medians_without_exchange_reuse_and_with_null_keys(spark):
    from shelfmatch.operators.median import exact_median
    df = spark.range(2_000_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("g"),
                                       (F.xxhash64("id") % 100_003).alias("v"))
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert {r.g: r.v for r in exact_median(df, ["g"], "v").collect()} == want and None in want
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_best_per_key_tie_goes_to_lower_id(spark):
    df = spark.createDataFrame([(1, 7, 0.9), (1, 3, 0.9), (1, 5, 0.8), (2, 9, 0.4)], "opp long, sot long, sim double")
    got = sorted((r.opp, r.sot) for r in R.best_per_key(df, ["opp"], "sim", "sot").collect())
    assert got == [(1, 3), (2, 9)]
    assert [(r.opp, r.sot) for r in R.best_matches(df, ["opp"], "sim", "sot", 0.5).collect()] == [(1, 3)]


def _dense_topk(queries, corpus, k):
    """numpy reference: char-trigram tf-idf fit on corpus, cosine, top k per query."""
    grams = lambda s: [s[i:i + 3] for i in range(len(s) - 2)]
    vocab = sorted({g for s in corpus for g in grams(s)})
    ix = {g: i for i, g in enumerate(vocab)}

    def tf(s):
        v = np.zeros(len(vocab))
        for g in grams(s):
            if g in ix:
                v[ix[g]] += 1
        return v
    C_ = np.array([tf(s) for s in corpus])
    df = (C_ > 0).sum(0)
    idf = np.log((1 + len(corpus)) / (1 + df)) + 1
    def norm(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        n[n == 0] = 1
        return m / n
    Cw, Qw = norm(C_ * idf), norm(np.array([tf(s) for s in queries]) * idf)
    sims = Qw @ Cw.T
    out = {}
    for qi in range(len(queries)):
        order = sorted([j for j in range(len(corpus)) if sims[qi, j] > 0], key=lambda j: (-round(sims[qi, j], 10), j))
        out[qi] = [(j, sims[qi, j]) for j in order[:k]]
    return out


def test_topk_cosine_equals_dense_product(spark):
    rnd = random.Random(3)
    words = ["arroz", "feijao", "preto", "branco", "tipo", "leite", "integral", "cafe", "po", "500g"]
    corpus = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4))) for _ in range(50)]
    queries = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 3))) for _ in range(12)] + ["zz"]
    c = spark.createDataFrame(list(enumerate(corpus)), "cid long, name string")
    q = spark.createDataFrame(list(enumerate(queries)), "qid long, name string")
    got = tfidf.corpus_match(q, c, "qid", "cid", "name", "name", opts=tfidf.TopK(k=5)).collect()
    want = _dense_topk(queries, corpus, 5)
    by_q = {}
    for r in got:
        by_q.setdefault(r.qid, []).append((r["rank"], r.cid, r.similarity))
    for qi, lst in want.items():
        mine = sorted(by_q.get(qi, []))
        assert [cid for _, cid, _ in mine] == [j for j, _ in lst]
        for (_, _, s), (_, w) in zip(mine, lst):
            assert math.isclose(s, w, abs_tol=1e-9)


def test_floor_below_topk_gives_same_best_rows(spark):
    rnd = random.Random(11)
    words = ["ab", "abc", "abcd", "xyz", "xy", "abx", "cab"]
    corpus = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 3))) for _ in range(60)]
    queries = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 3))) for _ in range(15)]
    c = spark.createDataFrame(list(enumerate(corpus)), "cid long, name string")
    q = spark.createDataFrame(list(enumerate(queries)), "qid long, name string")
    res = []
    for floor in (None, 0.5):
        m = tfidf.corpus_match(q, c, "qid", "cid", "name", "name", opts=tfidf.TopK(k=3, min_similarity=floor))
        b = R.best_matches(m, ["cid"], "similarity", "qid", 0.5)
        res.append(sorted((r.cid, r.qid, round(r.similarity, 9)) for r in b.collect()))
    assert res[0] == res[1]


def test_replace_partition_keeps_other_countries(spark, tmp_out):
    path = os.path.join(tmp_out, "sheet")
    spark.createDataFrame([("BR", 1), ("CO", 2)], "COUNTRY string, v long").write.partitionBy("COUNTRY").parquet(path)
    sinks.replace_partition(spark.createDataFrame([("BR", 9)], "COUNTRY string, v long"), path)
    got = sorted((r.COUNTRY, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("BR", 9), ("CO", 2)]
    sinks.replace_partition(spark.createDataFrame([("BR", 7)], "COUNTRY string, v long"), path, processed=["BR", "CO"])
    assert [(r.COUNTRY, r.v) for r in spark.read.parquet(path).collect()] == [("BR", 7)]


def test_decimals_as_text(spark):
    df = spark.createDataFrame([(1,)], "x int").select(F.lit(1.50).cast("decimal(10,2)").alias("d"), "x")
    out = sinks.decimals_as_text(df)
    assert dict(out.dtypes)["d"] == "string" and out.first().d == "1.50"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=80))
def test_exact_median_equals_numpy(spark, rows):
    from shelfmatch.operators.median import exact_median
    # one hot group holding most rows, as well as small ones
    rows = rows + [(0, i % 7) for i in range(50)]
    df = spark.createDataFrame(rows, "g int, v int")
    got = {r.g: r.v for r in exact_median(df, ["g"], "v").collect()}
    want = {}
    for g in {g for g, _ in rows}:
        vals = [v for gg, v in rows if gg == g and v is not None]
        if vals:
            want[g] = float(np.median(vals))
    assert got == want


def test_country_union_and_curated_ids(spark):
    from shelfmatch.sources.tables import country_union, curated_ids
    spark.createDataFrame([(1,)], "ID long").createOrReplaceTempView("br_rp")
    spark.createDataFrame([(2,)], "ID long").createOrReplaceTempView("co_rp")
    u = country_union(spark, "{country}_rp", ["br", "co"])
    assert sorted((r.COUNTRY, r.ID) for r in u.collect()) == [("br", 1), ("co", 2)]
    sot = spark.createDataFrame([("BR", 5, False), ("BR", 5, False), ("BR", 6, True), ("CO", 5, None)],
                                "COUNTRY string, MASTER_PRODUCT long, IS_DELETED boolean")
    # a NULL deleted flag fails "= FALSE" and drops the row, as in SQL
    assert sorted(tuple(r) for r in curated_ids(sot).collect()) == [("BR", 5)]


def test_append_log(spark, tmp_out):
    path = os.path.join(tmp_out, "log")
    df = spark.createDataFrame([("BR", 1)], "COUNTRY string, v long")
    sinks.append_log(df, path, "run-1")
    sinks.append_log(df, path, "run-1")
    sinks.append_log(df, path, "run-2")
    assert spark.read.parquet(path).count() == 2


def _names(seed, n, words=("arroz", "feijao", "preto", "branco", "tipo", "leite", "integral", "cafe", "Pão", "a", "")):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4))) for _ in range(n)]


@pytest.mark.parametrize("floor", [None, 0.5, 0.8])
@pytest.mark.parametrize("keyed", [False, True])
def test_kernel_equals_postings_join(spark, monkeypatch, floor, keyed):
    monkeypatch.setattr("shelfmatch.operators.trigrams.SLICE", 200)     # many slices, so that bars rise between them
    key = lambda i: ("BR", "CL", None)[i % 3]
    c = spark.createDataFrame([(key(i), f"c{i:03}", None if i == 7 else n) for i, n in enumerate(_names(5, 150) + ["leite po"] * 30)],
                              "k string, cid string, name string")
    q = spark.createDataFrame([(key(i), i, n) for i, n in enumerate(_names(6, 25) + ["zz", "leite po"])], "k string, qid long, name string")
    keys, res = ("k",) if keyed else (), []
    formed = spark.sparkContext.accumulator(0)
    # a bound of 0 postings sends everything through the join
    for opts in (tfidf.TopK(k=5, min_similarity=floor), tfidf.TopK(k=5, min_similarity=floor, max_broadcast=0)):
        m = tfidf.corpus_match(q, c, "qid", "cid", "name", "name", keys, opts, formed)
        res.append(sorted((r.qid, r["rank"], r.cid, round(r.similarity, 9)) for r in m.collect()))
    assert res[0] == res[1] and res[0]
    assert len(res[0]) <= formed.value <= 27 * 180


@pytest.mark.parametrize("floor", [None, 0.5])
@pytest.mark.parametrize("keyed", [False, True])
def test_blocks_equal_the_broadcast_kernel(spark, monkeypatch, floor, keyed):
    key = lambda i: ("BR", "CL", None)[i % 3]
    c = spark.createDataFrame([(key(i), f"c{i:03}", None if i == 7 else n) for i, n in enumerate(_names(5, 150) + ["leite po"] * 30)],
                              "k string, cid string, name string")
    q = spark.createDataFrame([(key(i), i, n) for i, n in enumerate(_names(6, 40) + ["zz", "leite po", "leite po", "leite po", "leite po"])],
                              "k string, qid long, name string")
    keys, res = ("k",) if keyed else (), []
    # ids that repeat, with equal and with other names, are told by the row as in the kernel
    q = q.unionByName(q.where("qid % 5 = 0")).unionByName(q.where("qid % 7 = 0").withColumn("name", F.lit("arroz branco")))
    c = c.unionByName(c.where("cid < 'c010'"))
    for name, bound in (("QUERIES", 5), ("ROWS", 20), ("SLICE", 200)):
        monkeypatch.setattr(f"shelfmatch.operators.trigrams.{name}", bound)
    for most in (10**6, 250):
        m = tfidf.corpus_match(q, c, "qid", "cid", "name", "name", keys, tfidf.TopK(k=5, min_similarity=floor, max_broadcast=most))
        res.append(sorted((r.qid, r["rank"], r.cid, round(r.similarity, 9)) for r in m.collect()))
        # queries beyond the bound must not form every pair that shares a term
        monkeypatch.setattr(tfidf, "postings_match", None)
        monkeypatch.setattr("shelfmatch.operators.trigrams.best_pairs", None)
    assert res[0] == res[1] and res[0]


def test_bags_of_long_texts_are_made_a_few_at_a_time():
    texts = ["x" * 400] * 9 + [None, "", "y" * 3000, "z"]
    got = list(trigrams.short_batches([pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])], "t", 1000))
    assert [t for b in got for t in b.column("t").to_pylist()] == texts
    assert all(b.num_rows and sum(len(t or "") for t in b.column("t").to_pylist()[:-1]) < 1000 for b in got)
    lists = [[1, 2, 3], [], [4] * 9, [5]]
    got = list(trigrams.short_batches([pa.RecordBatch.from_arrays([pa.array(lists)], ["t"])], "t", 4))
    assert [t for b in got for t in b.column("t").to_pylist()] == lists and len(got) == 2


def test_trigram_idf_merges_rows_of_one_id(spark, tmp_path):
    from shelfmatch.plans import corpus
    rows = [(1, "abcd"), (1, "abcd"), (1, "bcde"), (2, "abc\u00e9"), (None, "abc"), (3, None), (4, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "q")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus.trigram_idf(spark, str(tmp_path))
    assert {r.term: r.df for r in out.collect()} == {"abc": 3, "bcd": 1, "cde": 1, "bce": 1}
    assert "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()      # no string per trigram of a text


def test_bounds_leave_pairs_unformed_and_floor_more(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    texts = [" ".join(word() for _ in range(6)) for _ in range(800)]
    c = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "cid long, name string").coalesce(1)
    q = spark.createDataFrame([(i, texts[i * 7] + " " + word()) for i in range(40)], "qid long, name string")
    counts = []
    for floor in (None, 0.6):
        formed = spark.sparkContext.accumulator(0)
        assert tfidf.corpus_match(q, c, "qid", "cid", "name", "name", opts=tfidf.TopK(k=2, min_similarity=floor), formed=formed).count() >= 40
        counts.append(formed.value)
    assert counts[1] < counts[0] and counts[1] < 40 * 800 / 4


def test_match_of_empty_sides(spark):
    c, q = (spark.createDataFrame([], f"{i} long, name string") for i in ("cid", "qid"))
    some = spark.createDataFrame([(1, "arroz")], "cid long, name string")
    assert tfidf.corpus_match(q, c, "qid", "cid", "name", "name").count() == 0
    assert tfidf.corpus_match(q, some, "qid", "cid", "name", "name").count() == 0
    assert tfidf.corpus_match(some.withColumnRenamed("cid", "qid"), c, "qid", "cid", "name", "name").count() == 0


def test_salted_join_equals_broadcast_join(spark):
    rnd = random.Random(9)
    words = ["arroz", "feijao", "preto", "branco", "tipo", "leite"]
    corpus = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4))) for _ in range(40)]
    queries = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 3))) for _ in range(8)]
    c = spark.createDataFrame(list(enumerate(corpus)), "cid long, name string")
    q = spark.createDataFrame(list(enumerate(queries)), "qid long, name string")
    cp = tfidf.name_postings(c, "cid", "name")
    idf = tfidf.fit_idf(cp, c, "cid")
    cw = tfidf.tfidf_vectors(cp, idf, "cid")
    qw = tfidf.tfidf_vectors(tfidf.name_postings(q, "qid", "name", cluster=False), idf, "qid", by_window=False)
    got = []
    for small in (True, False):        # False forces the salted shuffle join
        pairs = tfidf.cosine_pairs(qw, cw, "qid", "cid", salt=4, small=small)
        got.append(sorted((r.qid, r.cid, round(r.similarity, 9)) for r in pairs.collect()))
    assert got[0] == got[1] and got[0]


def test_assemble_catalog_owner_join_and_membership(spark):
    base = spark.createDataFrame([("BR", 1, "s1", 10, 7, "W"), ("BR", 2, "s2", 11, 8, "U"), ("BR", 3, "s3", 12, 9, None)],
                                 "COUNTRY string, PRODUCT_ID long, SKU string, MASTER_PRODUCT_ID long, "
                                 "RETAILER_ID long, SELL_TYPE string")
    fill = spark.createDataFrame([("BR", 1, 0.5, 2, 1, 9.0)], "COUNTRY string, PRODUCT_ID long, FR double, "
                                 "TOTAL_PRODUCTS long, COUNT_REPLACED long, GMV_TOTAL double")
    defects = spark.createDataFrame([("BR", 1, 0.25)], "COUNTRY string, PID long, PRODUCT_DR double")
    feed = spark.createDataFrame([("BR", "s1", "n", "d", "t", 1.0, "i", 2.0, "u", 0.1, 0.2)],
                                 "COUNTRY string, RETAIL_ID string, NAME string, DESCRIPTION string, TRADEMARK string, "
                                 "MEDIAN_PRICE double, IMAGE_URL string, QUANTITY double, UNIT_TYPE string, "
                                 "MIN_QUANTITY_IN_GRAMS double, STEP_QUANTITY_IN_GRAMS double")
    sot = spark.createDataFrame([(12,), (12,)], "MASTER_PRODUCT_ID long")
    owners = spark.createDataFrame([("BR", 7, "a"), ("BR", 9, "b")], "COUNTRY_CODE string, CP_RETAILER_ID long, TAM string")
    out = {r.PRODUCT_ID: r for r in C.assemble_catalog(base, fill, defects, feed, sot).collect()}
    # product 2 is sold by unit and not curated (dropped); 3 has no sell type but is curated (kept)
    assert set(out) == {1, 3} and out[3].IN_SOT and not out[1].IN_SOT
    assert (out[1].FR, out[1].PRODUCT_DR, out[1].NAME_INT) == (0.5, 0.25, "n")
    owned = C.assemble_catalog(base, fill, defects, feed, sot, owners=owners)
    assert sorted(r.PRODUCT_ID for r in owned.collect()) == [1, 3]
    owned_one = C.assemble_catalog(base, fill, defects, feed, sot, owners=owners.where("CP_RETAILER_ID = 7"))
    assert [r.PRODUCT_ID for r in owned_one.collect()] == [1]


def test_score_matches_top_limit(spark):
    from shelfmatch.operators import matching
    cols = "COUNTRY string, NAME string, MASTER_PRODUCT_ID long, MEDIAN_PRICE double, SIMILARITY double"
    opps = spark.createDataFrame([("BR", n, i, 1.0, 0.5) for i, n in
                                  enumerate(["arroz branco", "arroz preto", "arroz tipo 1", "feijao"])], cols)
    sot = spark.createDataFrame([("BR", "arroz branco tipo 1", 9, 1.0, 0.9)], cols)
    rc = ["COUNTRY", "NAME", "MASTER_PRODUCT_ID"]
    assert matching.score_matches(opps, sot, row_cols=rc).count() >= 3
    assert matching.score_matches(opps, sot, row_cols=rc, top=2).count() == 2


def test_json_coalesce_on_variant(spark):
    df = spark.createDataFrame([('{"a": 1, "t": "U"}', '{"a": 2, "t": "W"}'), ('{"a": null}', '{"a": 5, "t": "W"}')],
                               "rp string, mp string")
    v = df.select(F.parse_json("rp").alias("rp"), F.parse_json("mp").alias("mp"))
    got = v.select(M.json_coalesce(F.col("rp"), F.col("mp"), "$.a", "double", variant=True),
                   M.json_coalesce(F.col("rp"), F.col("mp"), "$.t", variant=True)).collect()
    assert [tuple(r) for r in got] == [(1.0, "U"), (5.0, "W")]


def test_catalog_base_guards_and_countries(spark):
    sell = "ID long, COUNTRY string, PRODUCT_ID long, SKU string, SELL_TYPE string, PRESENTATION string, STATUS string, IS_DELETED boolean"
    on = ("published", False)
    rp = spark.createDataFrame([(1, "BR", 10, "s1", '{"type": "U", "maxQuantity": "7"}', None, *on), (1, "CL", 10, "s1", None, None, *on),
                                (2, "BR", 10, "s2", '{"type": null, "maxQuantity": null}', '{"quantity": "x"}', *on), (3, "BR", 10, "s3", None, None, *on),
                                (4, "BR", 11, "s4", None, None, *on), (5, "BR", 10, "s5", None, None, "published", None),
                                (6, "BR", 12, "s6", None, None, *on), (7, "BR", None, "s7", None, None, *on)], sell)
    mp = spark.createDataFrame([(10, "BR", '{"type": "W", "maxQuantity": 9}', '{"quantity": 2, "description": "box"}', *on),
                                (10, "CL", '{"type": "K"}', None, *on), (11, "BR", None, None, *on), (12, "BR", None, None, "draft", False)],
                               "ID long, COUNTRY string, SELL_TYPE string, PRESENTATION string, STATUS string, IS_DELETED boolean")
    info = ("c1", "c2", "c3", "m", "t", "e")
    ra = spark.createDataFrame([("BR", 1, 70, "rice", *info, "photo"), ("BR", 2, 71, "rice", *info, None), ("CL", 1, 72, "arroz", *info, "foto"),
                                ("BR", 4, 73, None, *info, "photo"), ("BR", 5, 74, "x", *info, "p"), ("BR", 6, 75, "x", *info, "p"), ("BR", 7, 76, "x", *info, "p")],
                               "COUNTRY string, RETAILER_PRODUCT_ID long, RETAILER_ID long, MP_NAME string, CAT1_NAME string, CAT2_NAME string, "
                               "CAT3_NAME string, MAKER string, TRADEMARK string, EAN string, MP_PHOTO_URL string")
    ma = spark.createDataFrame([("BR", 10, "gold", 1, 4)], "COUNTRY string, MASTER_PRODUCT_ID long, QUALITY_LABEL string, PRIORITY int, ASSOCIATED_RETAILERS long")
    for as_variant in (False, True):
        r, m = rp, mp
        if as_variant:
            r, m = (d.withColumns({c: F.parse_json(c) for c in ("SELL_TYPE", "PRESENTATION")}) for d in (rp, mp))
        live = C.sell_and_presentation(r, m)
        assert {(x.COUNTRY, x.PRODUCT_ID): (x.SELL_TYPE, x.MAX_QUANT, x.QUANTITY_RP) for x in live.collect()} == {
            ("BR", 1): ("U", 7.0, 2.0), ("CL", 1): ("K", None, None), ("BR", 2): ("W", 9.0, 2.0), ("BR", 3): ("W", 9.0, 2.0), ("BR", 4): (None, None, None)}
        got = {(x.COUNTRY, x.PRODUCT_ID): x for x in C.catalog_base(live, ra, ma).collect()}
        # no photo (2), no analytics row (3), no name (4): dropped; a master product without analytics stays with nulls
        assert set(got) == {("BR", 1), ("CL", 1)}
        assert (got["BR", 1].NAME, got["BR", 1].QUALITY_LABEL, got["BR", 1].ASSOCIATED_RETAILERS) == ("rice", "gold", 4)
        assert (got["CL", 1].NAME, got["CL", 1].RETAILER_ID, got["CL", 1].QUALITY_LABEL, got["CL", 1].PRIORITY) == ("arroz", 72, None, None)


def test_assembly_guards_reach_the_scan(spark, tmp_out):
    cols = ", ".join(f"{c} string" for c in ("MP_NAME", *C.RP_ANALYTICS_COLUMNS[1:]))
    spark.createDataFrame([], f"COUNTRY string, RETAILER_PRODUCT_ID long, RETAILER_ID long, {cols}").write.parquet(f"{tmp_out}/ra")
    live = spark.createDataFrame([], "COUNTRY string, PRODUCT_ID long, MASTER_PRODUCT_ID long")
    ma = spark.createDataFrame([], "COUNTRY string, MASTER_PRODUCT_ID long, QUALITY_LABEL string, PRIORITY int, ASSOCIATED_RETAILERS long")
    plan = C.catalog_base(live.withColumn("x", F.rand()), spark.read.parquet(f"{tmp_out}/ra"), ma)._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(MP_PHOTO_URL" in plan and "isnotnull(MP_NAME" in plan


def test_prefilter_keeps_every_match_and_few_others(spark):
    from shelfmatch.operators.prefilter import may_match
    keys = spark.range(0, 500).selectExpr("concat('k', id) AS k", "id * 7 AS n").unionByName(spark.createDataFrame([(None, None)], "k string, n long"))
    rows = spark.range(0, 20_000).selectExpr("concat('k', id) AS a", "id * 7 AS b", "CAST(id AS INT) AS c")
    for on in ({"a": "k"}, {"a": "k", "b": "n"}):
        cut = may_match(rows, keys, on)
        same = [rows[x] == keys[y] for x, y in on.items()]
        assert rows.join(keys, same, "left_semi").subtract(cut).isEmpty()
        assert 500 <= cut.count() < 1_500
    assert may_match(rows, keys.limit(0), {"a": "k"}).isEmpty()
    assert may_match(rows, keys, {"c": "n"}) is rows            # an INT hashes otherwise than a BIGINT
    floats = spark.createDataFrame([(0.0,)], "x double")
    assert may_match(floats, floats, {"x": "x"}) is floats      # 0.0 equals -0.0


def test_prefilter_gives_way_to_too_many_keys(spark, monkeypatch):
    from shelfmatch.operators import prefilter
    monkeypatch.setattr(prefilter, "BITS", 1 << 10)
    rows = spark.range(2_000)
    assert prefilter.may_match(rows, rows, {"id": "id"}) is rows
    assert prefilter.may_match(rows, rows.where("id < 200"), {"id": "id"}).where("id < 200").count() == 200


def test_feed_cut_goes_below_the_joins_of_a_wide_side(spark, tmp_out):
    """The filter on the snapshot's keys stands on the scan, below the join and the shuffles that make the retailer products."""
    spark.range(0, 300).selectExpr("id AS ID", "id % 10 AS part").write.parquet(f"{tmp_out}/rp")
    part = spark.range(0, 10).selectExpr("id AS part", "concat('{\"type\": \"', id, '\"}') AS SELL_TYPE")
    rp = spark.read.parquet(f"{tmp_out}/rp").repartition("part").distinct().join(part.hint("merge"), "part").selectExpr(
        "'A' AS COUNTRY", "ID", "CAST(ID AS STRING) AS SKU", "concat(SELL_TYPE, ID) AS wide")
    feed = spark.createDataFrame([("A", "7"), ("A", "150"), ("B", "8")], "COUNTRY string, RETAIL_ID string")
    got = C.with_feed(rp, feed)
    assert sorted(r.SKU for r in got.collect()) == ["150", "7"]
    lines = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = {what: next(len(x) - len(x.lstrip(" :+-")) for x in lines if what in x) for what in ("held(", "Join Inner", "RepartitionByExpression")}
    assert depth["held("] > depth["RepartitionByExpression"] > depth["Join Inner"]
