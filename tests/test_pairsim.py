"""SIM-2..13: hand-computed values, traps, and properties."""

import math
from collections import Counter
import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfmatch.functions import pairsim as P
from shelfmatch.functions import udfs as U


def scores(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    return P.with_pair_scores(df, "a", "b").first().asDict()


def test_pair_cosine_worked_example(spark):
    s = scores(spark, "arroz branco tipo arroz", "arroz tipo integral")
    assert abs(s["cosine"] - 0.5697077) < 1e-6


def test_empty_after_cleaning_is_null(spark):
    s = scores(spark, "!!!", "de")
    assert s["jaccard"] is None and s["edit_similarity"] is None and s["cosine"] is None
    assert s["name_agreement"] is None


def test_identity_and_ranges(spark):
    s = scores(spark, "Feijão preto 1kg", "Feijão preto 1kg")
    assert s["jaccard"] == 1.0 and s["edit_similarity"] == 1.0 and abs(s["cosine"] - 1.0) < 1e-12
    assert s["containment"] == 1.0


def test_jaccard_and_edit_values(spark):
    s = scores(spark, "arroz branco", "arroz preto")
    assert abs(s["jaccard"] - 1 / 3) < 1e-12
    # "arroz branco" vs "arroz preto": 4 edits over 12 characters
    assert abs(s["edit_similarity"] - (1 - 4 / 12)) < 1e-12


def test_containment(spark):
    s = scores(spark, "a bb bb cc", "bb cc cc")
    assert abs(s["containment"] - 2 / 3) < 1e-12


def test_row_median(spark):
    df = spark.createDataFrame([(1.0, 3.0, 2.0), (1.0, None, 4.0), (None, None, 5.0), (None, None, None)],
                               "a double, b double, c double")
    got = [r[0] for r in df.select(P.row_median(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [2.0, 2.5, 5.0, None]


def test_distance_curve(spark):
    df = spark.createDataFrame([(0,), (3,)], "d int")
    got = [r[0] for r in df.select(P.distance_score(F.col("d"))).collect()]
    assert got == [0.99999969, 0.99990689]


def test_price_similarity(spark):
    df = spark.createDataFrame([(10.0, 8.0), (None, 8.0), (0.0, 0.0)], "a double, b double")
    got = [r[0] for r in df.select(P.price_similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 0.8 and got[1] is None and got[2] is None


def test_confidence_weights(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    c = P.confidence({k: F.col("x") for k in P.CONFIDENCE_WEIGHTS})
    assert abs(df.select(c).first()[0] - 1.0) < 1e-12
    assert sum(P.CONFIDENCE_WEIGHTS.values()) == 12.5


def _dl_brute(a, b):
    """Unrestricted Damerau-Levenshtein, textbook form (test oracle)."""
    da = {}
    maxdist = len(a) + len(b)
    d = [[0] * (len(b) + 2) for _ in range(len(a) + 2)]
    d[0][0] = maxdist
    for i in range(len(a) + 1):
        d[i + 1][0] = maxdist
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[0][j + 1] = maxdist
        d[1][j + 1] = j
    for i in range(1, len(a) + 1):
        db = 0
        for j in range(1, len(b) + 1):
            k = da.get(b[j - 1], 0)
            l = db
            cost = 1
            if a[i - 1] == b[j - 1]:
                cost = 0
                db = j
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1,
                                  d[k][l] + (i - k - 1) + 1 + (j - l - 1))
        da[a[i - 1]] = i
    return d[len(a) + 1][len(b) + 1]


def test_damerau_known():
    assert U.damerau_levenshtein_distance("ca", "abc") == 2
    assert U.damerau_levenshtein_distance("", "abc") == 3
    assert U.damerau_levenshtein_distance("abcdef", "abcdef") == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcd ", max_size=12), st.text(alphabet="abcd ", max_size=12))
def test_damerau_matches_brute_force(a, b):
    assert U.damerau_levenshtein_distance(a, b) == _dl_brute(a, b)


def test_damerau_of_long_texts_is_linear_in_memory():
    import tracemalloc
    rnd = random.Random(4)
    a = "".join(rnd.choice("abcdefgh é中") for _ in range(20000))
    swaps = list(range(10, 19000, 950))
    b = list(a)
    for i in swaps:
        b[i], b[i + 1] = b[i + 1], b[i]
    changed = sum(a[i] != a[i + 1] for i in swaps)
    tracemalloc.start()
    got = U.damerau_many([a, a[:3000]], ["".join(b), a[5:3005]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] == changed and got[1] <= 10 and peak < 200e6


def test_damerau_batches_are_linear_in_memory():
    import tracemalloc
    rnd = random.Random(5)
    a = ["".join(rnd.choice("abcdefgh é中") for _ in range(rnd.randint(200, 300))) for _ in range(400)]
    b = [t[3:90] + t[91:180] + t[181:179:-1] + t[182:] + "xy" for t in a]
    tracemalloc.start()
    got = U.damerau_many(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10e6        # no table of a batch
    assert got[::40] == [U.damerau_levenshtein_distance(x, y) for x, y in zip(a[::40], b[::40])]
    long = "".join(rnd.choice("abc") for _ in range(4000))       # beyond 16-bit cells
    assert U.damerau_many([long, "ab"], [long[1:] + "c", "ba"]) == [U.damerau_levenshtein_distance(long, long[1:] + "c"), 1]


def test_damerau_forms_agree():
    rnd = random.Random(8)
    text = lambda: "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 14)))
    pairs = [(text(), text()) for _ in range(400)]
    one = [U.damerau_levenshtein_distance(a, b) for a, b in pairs]
    assert one == [_dl_brute(a, b) for a, b in pairs] == U.damerau_many([a for a, _ in pairs], [b for _, b in pairs])


def test_damerau_udf(spark):
    df = spark.createDataFrame([("ca", "abc"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(U.damerau(F.col("a"), F.col("b"))).collect()] == [2, None]


def _lcs_brute(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequences_equal_the_plain_programme():
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice("abcdé 中\U0001F600") for _ in range(n))
    pairs = [(text(rnd.randint(0, 200)), text(rnd.randint(0, 300))) for _ in range(120)] + [("a" * 64, "a" * 64), ("a" * 65, "ba" * 70), ("a" * 192, "a" * 500)]
    pairs += [("", "abc"), ("", ""), ("ab" * 100, "ba" * 100)]
    got = U.common_subsequences([a for a, _ in pairs] + [None], [b for _, b in pairs] + ["x"])
    assert got == [_lcs_brute(a, b) for a, b in pairs] + [None]


def test_token_ratios(spark):
    from shelfmatch.operators.matching import with_token_ratios
    rnd = random.Random(7)
    words = ["arroz", "feijao", "tipo", "1kg", "branco", "Preto,", "integral!", "a_b", "é"]
    pairs = [(" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5))), " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5)))) for _ in range(80)]
    pairs += [("!!!", "abc"), ("", ""), ("x", "x"), (None, "a"), ("new york mets", "new york mets vs braves")]

    def tokens(s):
        s = "".join(c for c in s if not 128 <= ord(c) < 256)
        return sorted("".join(c if c.isalnum() or c == "_" else " " for c in s).lower().split())

    def ratio(a, b):
        return 100 if a == b else 0 if not a or not b else round(100 * (2 * _lcs_brute(a, b) / (len(a) + len(b))))

    got = with_token_ratios(spark.createDataFrame(pairs, "a string, b string"), "a", "b").collect()
    for (a, b), r in zip(pairs, got):
        if a is None:
            assert r.fuzz_token_sort_ratio is None and r.fuzz_token_set_ratio is None
            continue
        ta, tb = tokens(a), tokens(b)
        both = sorted(set(ta) & set(tb))
        s0, s1, s2 = " ".join(both), " ".join(both + sorted(set(ta) - set(tb))), " ".join(both + sorted(set(tb) - set(ta)))
        assert r.fuzz_token_sort_ratio == ratio(" ".join(ta), " ".join(tb)) / 100
        assert r.fuzz_token_set_ratio == (max(ratio(s0, s1), ratio(s0, s2), ratio(s1, s2)) / 100 if ta and tb else 0.0)
    assert got[-1].fuzz_token_set_ratio == 1.0


def test_pair_scores_of_20000_tokens(spark):
    import time
    rnd = random.Random(3)
    a, b = (" ".join(f"w{rnd.randrange(9000)}" for _ in range(20000)) for _ in range(2))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    t0 = time.time()
    got = P.with_pair_scores(df, "a", "b", scores=("cosine", "containment"), language=None).collect()[0]
    assert time.time() - t0 < 60
    ca, cb = Counter(a.split()), Counter(b.split())
    assert got.containment == sum(min(n, cb[t]) for t, n in ca.items()) / 20000
    idf = lambda t: 1.0 if ca[t] and cb[t] else math.log(1.5) + 1
    dot = sum(n * cb[t] for t, n in ca.items())
    norm = [math.sqrt(sum((n * idf(t)) ** 2 for t, n in c.items())) for c in (ca, cb)]
    assert math.isclose(got.cosine, dot / norm[0] / norm[1], rel_tol=1e-9)



@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="abc xyz", max_size=20), st.text(alphabet="abc xyz", max_size=20))
def test_scores_bounded_and_symmetric(spark, a, b):
    s1, s2 = scores(spark, a, b), scores(spark, b, a)
    for k in ("jaccard", "edit_similarity", "cosine"):
        if s1[k] is not None:
            assert -1e-12 <= s1[k] <= 1 + 1e-12
            assert math.isclose(s1[k], s2[k], abs_tol=1e-12)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abcd", max_size=9), st.text(alphabet="abcd", max_size=9)),
                min_size=1, max_size=20))
def test_damerau_batch_matches_brute_force(pairs):
    got = U.damerau_levenshtein_batch([p[0] for p in pairs], [p[1] for p in pairs])
    assert [int(x) for x in got] == [_dl_brute(a, b) for a, b in pairs]


def test_damerau_many_mixes_short_long_and_null():
    a = ["ca", None, "x" * 100 + "ab", "abc", "y" * 300 + "abcd"]
    b = ["abc", "z", "x" * 100 + "ba", "", "y" * 290 + "bacd"]
    assert U.damerau_many(a, b) == [2, None, 1, 3, 11]
