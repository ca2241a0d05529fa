"""Corpus TF-IDF over character trigrams and the top-k cosine join (MAT-1..4).

Terms are trigrams of the ASCII-folded text, so the vocabulary is bounded by 128^3
whatever the data size. :func:`corpus_match` turns every row into one bag of coded
trigrams, takes the document frequencies from the bags (partial aggregate, small
shuffle) and scores the bags against the queries with a block kernel
(:mod:`shelfmatch.operators.trigrams`):

    corpus text --repartition(id)--> fold --> bags (written once) --> df per term --> idf
    bags --> kernel with the query block and the idf (checked broadcasts)
         --> at most k pairs a query and task --> exchange on query --> top-k

Only text and k pairs a query are ever shuffled. Queries beyond the broadcast bound are
dealt into blocks that meet blocks of the corpus (:func:`block_match`): the same kernel,
with bags instead of joined postings in the shuffle. Only keyed vocabularies beyond the
bound take the long-format postings ``(keys..., id, term, tf)``, joined on the term with
the corpus side salted, so that a trigram held by most rows spreads over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.functions import text as T
from shelfmatch.operators import trigrams
from shelfmatch.session import spread, stored

# Largest number of query-side postings we broadcast (~24 bytes a row).
MAX_BROADCAST_POSTINGS = 2_000_000
# Rounding used to order scores: float noise below 1e-10 must not decide ties.
RANK_DIGITS = 10


def name_postings(df: DataFrame, id_col: str, text_col: str, keys: tuple[str, ...] = (),
                  normalise: bool = True, cluster: bool = True) -> DataFrame:
    """Trigram term frequencies ``(keys..., id, term, tf)`` of a name/text column.

    ``normalise`` applies the name fold (lower, NFKD to ASCII, drop ``, " &``)
    and then the n-gram pre-clean, exactly as the match step does.
    ``cluster`` hash-partitions the rows by id first so that every later
    per-id aggregate runs without another exchange.
    """
    src = df.select(*keys, F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    if cluster:
        src = spread(src, *[F.col(k) for k in keys], F.col("_id"))
    s = T.ngram_source(T.fold_name(F.col("_t"))) if normalise else F.col("_t")
    exploded = src.select(*keys, "_id", F.explode(T.char_ngrams(s, 3)).alias("term"))
    return (exploded.groupBy(*keys, "_id", "term").agg(F.count(F.lit(1)).alias("tf"))
            .withColumnRenamed("_id", id_col))


def fit_idf(postings: DataFrame, corpus: DataFrame, id_col: str,
            keys: tuple[str, ...] = ()) -> DataFrame:
    """MAT-1: smooth idf = ln((1+N)/(1+df)) + 1 per (keys..., term).

    ``N`` counts every corpus row, including rows without any trigram (as the
    vectoriser does); ``df`` counts rows containing the term.
    """
    dfreq = postings.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("df"))
    if keys:
        n = corpus.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_docs"))
        dfreq = dfreq.join(n, on=list(keys), how="inner")
        n_col = F.col("n_docs")
    else:
        n_col = corpus.select(F.count(F.lit(1))).scalar()
    return dfreq.select(*keys, "term", "df",
                        (F.log((n_col + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def tfidf_vectors(postings: DataFrame, idf: DataFrame, id_col: str,
                  keys: tuple[str, ...] = (), by_window: bool = True, idf_small: bool = False) -> DataFrame:
    """MAT-2: L2-normalised tf·idf weights ``(keys..., id, term, w)``.

    Terms missing from ``idf`` are dropped before the norm (unseen terms do
    not count). See :func:`idf_side` for when the idf table is broadcast.
    """
    j = postings.join(idf_side(idf, keys, idf_small), on=[*keys, "term"], how="inner")
    w = F.col("tf") * F.col("idf")
    j = j.select(*keys, id_col, "term", w.alias("w_raw"))
    if by_window:
        norm = F.sqrt(F.sum(F.col("w_raw") * F.col("w_raw")).over(Window.partitionBy(*keys, id_col)))
        return j.select(*keys, id_col, "term", (F.col("w_raw") / norm).alias("w"))
    norms = j.groupBy(*keys, id_col).agg(F.sqrt(F.sum(F.col("w_raw") * F.col("w_raw"))).alias("_norm"))
    return j.join(norms, on=[*keys, id_col]).select(*keys, id_col, "term",
                                                     (F.col("w_raw") / F.col("_norm")).alias("w"))


@dataclass(frozen=True)
class TopK:
    k: int = 10
    lower_bound: float = 0.0       # keep cosine strictly above this
    min_similarity: float | None = None   # R1: also require cosine >= this before top-k
    salt: int = 16                 # salt buckets when the query side is too big to broadcast
    max_broadcast: int = MAX_BROADCAST_POSTINGS   # rows of query postings, and of keyed idf, sent to tasks


def fits_broadcast(bound: DataFrame, max_rows: int = MAX_BROADCAST_POSTINGS) -> bool:
    """True when a row count proves ``bound`` (a superset of the side to
    broadcast) has at most ``max_rows`` rows."""
    return bound.count() <= max_rows


def cosine_pairs(query_w: DataFrame, corpus_w: DataFrame, query_id: str, corpus_id: str,
                 keys: tuple[str, ...] = (), salt: int = 16, small: bool | None = None,
                 max_broadcast: int = MAX_BROADCAST_POSTINGS) -> DataFrame:
    """Σ w_q·w_c over shared terms → ``(keys..., query_id, corpus_id, similarity)``.

    ``small`` is the caller's proof that the query side fits a broadcast
    (see :func:`fits_broadcast`); without it the query side is counted here.
    """
    q = query_w.select(*keys, F.col(query_id), "term", F.col("w").alias("wq"))
    c = corpus_w.select(*keys, F.col(corpus_id), "term", F.col("w").alias("wc"))
    if small is None:
        small = fits_broadcast(q, max_broadcast)
    if small:
        q = F.broadcast(q)
    on = [*keys, "term"]
    if not small:
        # Too large to broadcast: salt the corpus side and replicate the query
        # side, so a trigram held by most documents spreads over `salt` tasks.
        c = c.withColumn("_salt", F.pmod(F.xxhash64(F.col(corpus_id)), F.lit(salt)))
        q = q.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        on = on + ["_salt"]
    prod = c.join(q, on=on, how="inner")
    return (prod.groupBy(*keys, query_id, corpus_id)
            .agg(F.sum(F.col("wq") * F.col("wc")).alias("similarity")))


def rank_score(c: Column) -> Column:
    return F.round(c, RANK_DIGITS)


def top_k(pairs: DataFrame, query_id: str, corpus_id: str, keys: tuple[str, ...] = (),
          opts: TopK = TopK()) -> DataFrame:
    """WIN-2: keep the ``k`` best corpus rows per query row (cosine > lower bound).

    Ties are broken by corpus id ascending; scores are compared rounded to
    1e-10 so float summation order never decides a tie. Spark plans the
    ``row_number`` filter as a partial ``WindowGroupLimit`` before the
    exchange, so each task ships at most ``k`` rows per query.
    """
    pairs = pairs.where(F.col("similarity") > F.lit(opts.lower_bound))
    if opts.min_similarity is not None:
        pairs = pairs.where(rank_score(F.col("similarity")) >= F.lit(opts.min_similarity))
    w = Window.partitionBy(*keys, query_id).orderBy(rank_score(F.col("similarity")).desc(),
                                                   F.col(corpus_id).asc())
    return (pairs.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= opts.k))


def topk_cosine(query_w: DataFrame, corpus_w: DataFrame, query_id: str, corpus_id: str,
                keys: tuple[str, ...] = (), opts: TopK = TopK()) -> DataFrame:
    """MAT-3 (JN-8 + WIN-2) on two sets of L2-normalised weights."""
    return top_k(cosine_pairs(query_w, corpus_w, query_id, corpus_id, keys, opts.salt),
                 query_id, corpus_id, keys, opts)


def idf_side(idf: DataFrame, keys: tuple[str, ...] = (), proven_small: bool = False) -> DataFrame:
    """The idf table as the build side of a join.

    Without group keys its size is proven: at most 128^3 ASCII trigrams
    whatever the data size, so it is broadcast. With keys (one vocabulary per
    country, say) the bound grows with the number of keys, so it is broadcast
    only when the caller has counted it (``proven_small``); otherwise AQE
    decides from runtime sizes and shuffles on (keys, term) with skew splitting.
    """
    side = idf.select(*keys, "term", "idf")
    return F.broadcast(side) if (not keys or proven_small) else side


def corpus_weights(postings: DataFrame, idf: DataFrame, id_col: str,
                   keys: tuple[str, ...] = (), idf_small: bool = False) -> tuple[DataFrame, DataFrame]:
    """Un-normalised tf·idf weights ``(keys..., id, term, w)`` and the L2 norm
    per id ``(keys..., id, _norm)``; both keep the postings' id clustering."""
    w = (postings.join(idf_side(idf, keys, idf_small), on=[*keys, "term"], how="inner")
         .select(*keys, id_col, "term", (F.col("tf") * F.col("idf")).alias("w")))
    norms = w.groupBy(*keys, id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    return w, norms


def corpus_match(queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str,
                 query_text: str, corpus_text: str, keys: tuple[str, ...] = (),
                 opts: TopK = TopK(), formed=None) -> DataFrame:
    """MAT-1..3 end to end: fit on the corpus, transform the queries, top-k join.

    Ids are unique on either side (within ``keys``); rows with a NULL key match nothing.
    The bounds of :mod:`trigrams` always apply, and a floor (``opts.min_similarity``)
    raises them from the start; the rows are those of :func:`postings_match`, which
    serves when the keyed vocabularies, counted here, are too many to broadcast, and of
    :func:`block_match`, which serves when the query postings are. ``formed``, an
    accumulator, counts the pairs scored in full against broadcast queries.
    """
    bags = stored(trigrams.bags(spread(corpus.select(*dict.fromkeys([*keys, corpus_id, corpus_text])), *keys, corpus_id),
                                corpus_id, corpus_text, keys), "bags")
    asked = trigrams.bags(queries, query_id, query_text, keys)
    asked = asked.where(F.size("terms") > 0)
    for c in keys:
        asked = asked.where(F.col(c).isNotNull())
    asked = stored(asked, "queries")
    postings = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    # Without keys the vocabulary is bounded by 128^3; with keys it is read up to the bound.
    frequency = bags.select(*keys, F.explode("terms").alias("_term")).groupBy(*keys, "_term").agg(F.count(F.lit(1)).alias("_df"))
    most = opts.max_broadcast
    table = (frequency.limit(most + 1) if keys else frequency).toArrow()
    if keys and table.num_rows > most:
        return postings_match(queries, corpus, query_id, corpus_id, query_text, corpus_text, keys, opts)
    n_docs = {tuple(r)[:-1]: r[-1] for r in bags.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).collect()} if keys else {(): bags.count()}
    known = trigrams.by_key(table, keys, ["_term", "_df"])
    if postings > most:
        return block_match(asked, bags, known, n_docs, query_id, corpus_id, keys, opts)
    wanted = trigrams.by_key(asked.select(*keys, F.col(query_id).alias("_id"), "terms", "tfs").toArrow(), keys, ["_id", "terms", "tfs"])
    blocks = {}
    for key, (ids, terms, tfs) in wanted.items():
        if key in known:
            term, df = (np.array(c, dtype=np.int64) for c in known[key])
            order = np.argsort(term)
            blocks[key] = trigrams.Block(ids, list(zip(terms, tfs)), term[order], df[order], n_docs[key])
    pairs = trigrams.best_pairs(bags, blocks, keys, queries.schema[query_id], query_id, corpus_id, opts.k, opts.lower_bound,
                                opts.min_similarity, formed)
    return top_k(pairs, query_id, corpus_id, keys, opts)


def block_match(asked: DataFrame, bags: DataFrame, known: dict, n_docs: dict, query_id: str, corpus_id: str,
                keys: tuple[str, ...], opts: TopK) -> DataFrame:
    """The rows of :func:`corpus_match` for any number of queries (:func:`trigrams.block_pairs`).

    Equal bags have equal scores: queries of one bag are asked once and share the answer, and
    of a key's corpus rows with one bag only the k smallest ids can be among the k best.
    """
    vocabulary = {}
    for key, (terms, dfs) in known.items():
        term, df = np.array(terms, dtype=np.int32), np.array(dfs, dtype=np.int64)
        order = np.argsort(term)
        vocabulary[key] = term[order].astype(np.int64), df[order], n_docs[key]
    w = Window.partitionBy(*keys, "terms", "tfs").orderBy(corpus_id)
    rows = stored(bags.where(F.size("terms") > 0).withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= opts.k).drop("_nth"), "rows")
    # Bags are numbered, so that ids that repeat do not mix them; stored, the numbers are the same for every reader.
    bag = stored(asked.select(*keys, "terms", "tfs").distinct().withColumn("_bag", F.monotonically_increasing_id()), "bag")
    found = trigrams.block_pairs(bag, rows, vocabulary, keys, "_bag", corpus_id, opts.k, opts.lower_bound, opts.min_similarity)
    found = top_k(found, "_bag", corpus_id, keys, opts).drop("rank")
    members = asked.join(bag, [*keys, "terms", "tfs"]).select(*keys, "_bag", query_id)
    pairs = found.join(members, [*keys, "_bag"]).select(*keys, query_id, corpus_id, "similarity")
    return top_k(pairs, query_id, corpus_id, keys, opts)


def postings_match(queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str,
                   query_text: str, corpus_text: str, keys: tuple[str, ...] = (),
                   opts: TopK = TopK()) -> DataFrame:
    """The rows of :func:`corpus_match` by joining long-format postings on the term.

    Every pair sharing a term is formed; neither side has to fit anywhere.
    """
    cp = stored(name_postings(corpus, corpus_id, corpus_text, keys), "postings")
    idf = fit_idf(cp, corpus, corpus_id, keys)
    cw, norms = corpus_weights(cp, idf, corpus_id, keys)
    qw = tfidf_vectors(name_postings(queries, query_id, query_text, keys), idf, query_id, keys, by_window=False)
    dots = cosine_pairs(qw, cw, query_id, corpus_id, keys, opts.salt, small=False)
    pairs = (dots.join(norms, on=[*keys, corpus_id])
             .select(*keys, query_id, corpus_id, (F.col("similarity") / F.col("_norm")).alias("similarity")))
    return top_k(pairs, query_id, corpus_id, keys, opts)
