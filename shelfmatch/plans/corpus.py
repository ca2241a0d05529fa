"""Corpus matching queries: ``benchmark`` items are the curated side, whole
``documents`` are the opportunities (MAT-1..3, MAT-6, SC-17, R1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators import rank as R
from shelfmatch.operators import tfidf, trigrams
from shelfmatch.plans.registry import query
from shelfmatch.session import spread
from shelfmatch.sources.tables import table

K = 10
FLOOR = 0.5


def _corpus(spark: SparkSession, sf_dir: str):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return docs, items


# SQL pieces shared by the oracles. The fold is lower → strip accents → drop
# non-ASCII → drop , " & → n-gram pre-clean, as on the Spark side.
_FOLD_SQL = r"""regexp_replace(regexp_replace(regexp_replace(strip_accents(lower({c})),
      '[^\x00-\x7F]', '', 'g'), '[,"&]', '', 'g'), '^\$[a-zA-Z0-9_]+\$|[,\-./]|\sBD', '', 'g')"""

_TFIDF_SQL = r"""
d AS (SELECT doc_id, {fold_d} AS s FROM documents),
dtf AS (SELECT doc_id, substr(s, i, 3) AS term, count(*) AS tf
        FROM (SELECT doc_id, s, unnest(generate_series(1, length(s) - 2)) AS i FROM d WHERE length(s) >= 3)
        GROUP BY 1, 2),
idf AS (SELECT term, count(*) AS df,
               ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
        FROM dtf GROUP BY term),
dw AS (SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS w
       FROM dtf JOIN idf USING (term)),
q AS (SELECT item_id, {fold_q} AS s FROM benchmark),
qtf AS (SELECT item_id, substr(s, i, 3) AS term, count(*) AS tf
        FROM (SELECT item_id, s, unnest(generate_series(1, length(s) - 2)) AS i FROM q WHERE length(s) >= 3)
        GROUP BY 1, 2),
qw AS (SELECT item_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY item_id)) AS w
       FROM qtf JOIN idf USING (term)),
pairs AS (SELECT item_id, doc_id, sum(qw.w * dw.w) AS sim FROM qw JOIN dw USING (term) GROUP BY 1, 2)
""".format(fold_d=_FOLD_SQL.format(c="text"), fold_q=_FOLD_SQL.format(c="text"))


def _match(spark, sf_dir, floor=None):
    docs, items = _corpus(spark, sf_dir)
    return tfidf.corpus_match(items, docs, "item_id", "doc_id", "text", "text",
                              opts=tfidf.TopK(k=K, min_similarity=floor))


@query("trigram_idf", oracle="WITH " + _TFIDF_SQL + r"""
SELECT term, CAST(df AS BIGINT) AS df, round(idf, 10) AS idf FROM idf
""")
def trigram_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAT-1 / AGG-13: document frequency and smooth idf of every trigram."""
    docs, _ = _corpus(spark, sf_dir)
    # Rows of one id are one document, so its trigrams are merged: on coded bags dealt by id, without another exchange.
    bags = spread(trigrams.bags(docs, "doc_id", "text").select("doc_id", "terms"), "doc_id")
    post = bags.select("doc_id", F.explode("terms").alias("term")).distinct()
    idf = tfidf.fit_idf(post, docs, "doc_id")
    return idf.select(trigrams.spelled(F.col("term")).alias("term"), F.col("df").cast("bigint").alias("df"),
                      F.round("idf", 10).alias("idf"))


@query("topk_cosine", oracle="WITH " + _TFIDF_SQL + r""",
ranked AS (SELECT item_id, doc_id, sim,
                  row_number() OVER (PARTITION BY item_id ORDER BY round(sim, 10) DESC, doc_id) AS rank
           FROM pairs WHERE sim > 0)
SELECT item_id, doc_id, CAST(rank AS BIGINT) AS rank, round(sim, 8) AS similarity
FROM ranked WHERE rank <= 10
""")
def topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAT-3: ten most similar documents per benchmark item (cosine > 0)."""
    m = _match(spark, sf_dir)
    return m.select("item_id", "doc_id", F.col("rank").cast("bigint").alias("rank"),
                    F.round("similarity", 8).alias("similarity"))


_BEST_SQL = "WITH " + _TFIDF_SQL + r""",
ranked AS (SELECT item_id, doc_id, sim,
                  row_number() OVER (PARTITION BY item_id ORDER BY round(sim, 10) DESC, doc_id) AS rank
           FROM pairs WHERE sim > 0),
best AS (SELECT doc_id, item_id, sim,
                row_number() OVER (PARTITION BY doc_id ORDER BY round(sim, 10) DESC, item_id) AS pick
         FROM ranked WHERE rank <= 10)
SELECT doc_id, item_id, round(sim, 8) AS similarity FROM best
WHERE pick = 1 AND round(sim, 10) >= 0.5
"""


@query("best_match", oracle=_BEST_SQL)
def best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAT-6 with R1: floor pushed below the top-k, then best item per document."""
    m = _match(spark, sf_dir, floor=FLOOR)
    best = R.best_per_key(m, key=["doc_id"], score="similarity", tie="item_id")
    return best.select("doc_id", "item_id", F.round("similarity", 8).alias("similarity"))


@query("best_match_unpruned", oracle=_BEST_SQL)
def best_match_unpruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAT-6 without R1: top-k over all pairs, then best per document, then the floor."""
    m = _match(spark, sf_dir)
    best = R.best_matches(m, key=["doc_id"], score="similarity", tie="item_id", floor=FLOOR)
    return best.select("doc_id", "item_id", F.round("similarity", 8).alias("similarity"))
