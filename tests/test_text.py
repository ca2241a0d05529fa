"""SC-9..20 and SIM-1 on hand-made rows (FIXTURES.md part C)."""

import unicodedata

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfmatch.functions import text as T
from shelfmatch.functions import udfs as U


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_fold_examples(spark):
    assert one(spark, T.fold_name(F.col("s")), 'Maçã, "Ñ" & Co') == "maca n  co"
    assert one(spark, T.fold_name(F.col("s")), "½ ﬁ Straße") == "12 fi strae"


def test_fold_matches_unicodedata(spark):
    samples = ["Ação", "naïve café", "ǅemal", "Ĳssel ¼", "x́y", "日本", "ℌello", "ﬀ", "Å", ""]
    got = spark.createDataFrame([(s,) for s in samples], "s string") \
        .select("s", T.fold_ascii(F.col("s")).alias("f")).collect()
    for r in got:
        want = unicodedata.normalize("NFKD", r["s"]).encode("ascii", "ignore").decode("ascii")
        assert r["f"] == want, r["s"]


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FFF, blacklist_categories=("Cs",)), max_size=30))
def test_fold_property(spark, s):
    want = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")
    assert one(spark, T.fold_ascii(F.col("s")), s) == want


def test_trigrams(spark):
    assert one(spark, T.char_ngrams(F.col("s")), "ab") == []
    assert one(spark, T.char_ngrams(F.col("s")), "abc") == ["abc"]
    assert one(spark, T.char_ngrams(F.col("s")), "abcde") == ["abc", "bcd", "cde"]
    assert one(spark, T.char_ngrams(F.col("s")), "a\nbcd") == ["a\nb", "\nbc", "bcd"]


def test_ngram_source(spark):
    assert one(spark, T.ngram_source(F.col("s")), "$ab$x-y.z/w,v BD") == "xyzwv"
    # lower-cased text never holds "BD", so the third branch does not fire
    assert one(spark, T.ngram_source(F.col("s")), "x bd") == "x bd"


def test_clean_text(spark):
    assert one(spark, T.clean_text(F.col("s")), "Arroz, de  Coca-Cola 1,5 e o") == "arroz cocacola 15"
    assert one(spark, T.clean_text(F.col("s")), "!!!") == ""


def test_quantity_unit(spark):
    rows = [("Arroz 5kg",), ("Leite 1,5 L",), ("ovos 12 Unidades",), ("2 Leites",), ("nada",)]
    q, u = T.quantity_unit(F.col("s"))
    got = [(r[0], r[1]) for r in spark.createDataFrame(rows, "s string").select(q, u).collect()]
    assert got == [("5", "kg"), ("5", "L"), ("12", "Unida"), ("2", "L"), (None, None)]


def test_per_kg(spark):
    rows = [("Arroz 5kg",), ("Arroz 5 kg",), ("Kg.",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(T.is_per_kg(F.col("s"))).collect()]
    assert got == [False, True, True, False]


def test_stop_words_list():
    words = T.stop_words("portuguese")
    assert len(words) == 203 and "de" in words


def test_exact_fold_udf(spark):
    got = spark.createDataFrame([("Ação ½",)], "s string").select(U.fold_exact(F.col("s"))).first()[0]
    assert got == "Acao 12"


def test_word_ngrams_make_the_words_once(spark):
    rows = [("a b c",), ("one",), ("",), (None,), (" x  y ",)]
    df = spark.createDataFrame(rows, "s string")
    for n in (1, 2, 3):
        want = [[" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] for w in ((r[0] or "").split() for r in rows)]
        assert [r[0] for r in df.select(F.coalesce(T.word_ngrams(F.col("s"), n), F.array())).collect()] == want
    plan = df.select(T.word_ngrams(F.col("s"), 2).alias("g"))._jdf.queryExecution().optimizedPlan().toString()
    # inside a lambda the words would be made anew for every position of the text
    assert "split" in plan and not any("split" in p.split("lambda", 1)[0] for p in plan.split("lambdafunction(array_join(")[1:])
