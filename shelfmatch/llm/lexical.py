"""Ranked lexical search by bag deduplication.

Documents are cut down to the vocabulary of the items (a bag of term and count), and
those with equal bags and an equal length factor m form a class: rows are grouped by
a hash with the whole bag and m beside it, so a class holds equal bags only. A class
is scored once, in one pass over the classes for a whole block of items, and then
stands for its members by ascending doc_id.

No more than the KEEP smallest ids of a class can ever be listed, so every task cuts
a class to that many before the shuffle and a class of a third of all rows costs as
much as any other. In the same way a task hands on at most KEEP documents an item.

Items are taken in blocks, by running count of their (item, term) rows in id order:
a block has at most BLOCK_TERMS of them and one item more, which bounds what is sent
to every task. Each block is a job of its own with its rows written to the shared
folder, so plans do not grow with the number of items.

Null texts have no terms but are documents without any; a null doc_id sorts first and
is given back as null; repeated doc_ids are documents of their own; item rows with one
item_id (nulls too) are one item; items without a known term, and empty tables, give no
rows. Other columns are not read. A long text is read in pieces of about CHUNK bytes,
beside its counts by term.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfmatch.llm import textcols as T
from shelfmatch.operators.rank import running_total

#: Fixed value: what a term is made of.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

KEEP, BLOCK_TERMS, CHUNK, CELLS = 50, 1 << 16, 1 << 20, 1 << 21
FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def term_counts(text: str, vocabulary: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """(number of terms with repeats, counts of those in ``vocabulary``) of a text."""
    data = text.encode().translate(FOLD)
    total, counts, at = 0, Counter(), 0
    while at < len(data):
        cut = data.find(b" ", at + CHUNK)
        cut = len(data) if cut < 0 else cut
        words = data[at:cut].split()
        total += len(words)
        counts.update(map(vocabulary.get, words))
        at = cut
    counts.pop(None, None)
    return total, counts


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) of the items."""
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.array_distinct(terms)).alias("term")).distinct()


def bags(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """id, n and the bag (``terms`` ascending, ``tfs`` beside them) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast({t.encode(): k for k, t in enumerate(vocabulary)})

    def run(batches):
        known = shared.value
        for b in T.small_batches(batches):
            n, terms, tfs = [], [], []
            for text in b.column("text").to_pylist():
                total, counts = term_counts(text or "", known)
                order = sorted(counts)
                n.append(total)
                terms.append(order)
                tfs.append([counts[t] for t in order])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], ["id", "n", "terms", "tfs"])

    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(T.NULL_ID)).alias("id")
    return docs.select(ids, F.col("text").cast("string").alias("text")).mapInArrow(run, "id long, n long, terms array<int>, tfs array<long>")


def classes(bagged: DataFrame, n_docs: int, n_terms: int, keep: int) -> DataFrame:
    """One row per class of equal bag and m, with its ``keep`` smallest ids in order."""
    # Decimals: 50 * n * N may pass 64 bits.
    m = F.expr(f"50 + (cast(50 as decimal(2,0)) * cast(n as decimal(17,0)) * cast({n_docs} as decimal(17,0))) div cast({n_terms} as decimal(38,0))")
    rows = bagged.where(F.size("terms") > 0).select("id", "terms", "tfs", m.alias("m"))
    key = ["h", "m", "terms", "tfs"]
    rows = rows.withColumn("h", F.xxhash64("m", "terms", "tfs"))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("id"))
    return rows.withColumn("at", rank).where(F.col("at") <= keep).groupBy(*key).agg(F.sort_array(F.collect_list("id")).alias("ids"))


class Best:
    """The ``keep`` best (score, smallest id) classes of every item so far."""

    def __init__(self, items: int, keep: int):
        self.keep, self.members = keep, []
        self.bar, self.bar_id = np.zeros(items, dtype=np.int64), np.full(items, T.NULL_ID)
        self.item = self.score = self.first = self.at = np.zeros(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: list) -> None:
        """``scores`` by class and item; ``ids`` of each class. The bars are the last places so far."""
        first = np.array([x[0] for x in ids], dtype=np.int64)
        c, i = np.nonzero(scores >= np.maximum(self.bar, 1))
        s = scores[c, i]
        new = (s > self.bar[i]) | (first[c] < self.bar_id[i])
        c, i, s = c[new], i[new], s[new]
        used, back = np.unique(c, return_inverse=True)
        self.at = np.r_[self.at, back + len(self.members)]
        self.members += [ids[k] for k in used]
        self.item, self.score, self.first = np.r_[self.item, i], np.r_[self.score, s], np.r_[self.first, first[c]]
        if len(self.item) > 4 * self.keep * len(self.bar):
            self.prune()

    def prune(self) -> None:
        order = np.lexsort((self.first, -self.score, self.item))
        item = self.item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.keep]
        self.item, self.score, self.first, self.at = self.item[order], self.score[order], self.first[order], self.at[order]
        last = np.flatnonzero(place == self.keep - 1)
        last = np.searchsorted(self.item, item[last], side="right") - 1
        self.bar[self.item[last]], self.bar_id[self.item[last]] = self.score[last], self.first[last]
        used, self.at = np.unique(self.at, return_inverse=True)
        self.members = [self.members[k] for k in used]

    def documents(self):
        """(item, document, score): classes expanded by ascending id, ``keep`` documents an item."""
        self.prune()
        for i in np.unique(self.item):
            own = np.flatnonzero(self.item == i)
            listed = sorted((-int(self.score[k]), d) for k in own for d in self.members[self.at[k]])
            yield from ((i, d, -s) for s, d in listed[:self.keep])


def score_classes(rows: DataFrame, item_ids: list, pairs: np.ndarray, weights: np.ndarray, keep: int) -> DataFrame:
    """item_id, doc_id and score of the best documents that each task has for each item.

    ``pairs`` are the block's (term, item) rows, by term. The scores of a slice of
    classes are one weighted count over (class, item) cells."""
    bounds = np.searchsorted(pairs[:, 0], np.arange(len(weights) + 1))
    shared = rows.sparkSession.sparkContext.broadcast((item_ids, pairs[:, 1].copy(), bounds, weights))

    def run(batches):
        item_ids, items, bounds, weights = shared.value
        best, degree = Best(len(item_ids), keep), np.diff(bounds)
        # Sums stay exact in doubles below 2^53; beyond that integers are added one by one.
        exact = len(items) and int(weights.max()) * 10**6 * int(np.bincount(items).max()) < 2**53
        for b in batches:
            terms, tfs = b.column("terms"), b.column("tfs")
            size = np.array(terms.value_lengths(), dtype=np.int64)
            term, tf = np.array(terms.flatten(), dtype=np.int64), np.array(tfs.flatten(), dtype=np.int64)
            m, ids = np.array(b.column("m"), dtype=np.int64), b.column("ids").to_pylist()
            row = np.repeat(np.arange(len(size)), size)
            part = weights[term] * ((10**9 * tf) // (1000 * tf + 20 * m[row]))
            cells = np.bincount(row, weights=degree[term], minlength=len(size)) + len(item_ids)
            cut = (np.cumsum(cells) // CELLS).astype(np.int64)
            for a, z in T.spans(cut):
                lo, hi = np.searchsorted(row, [a, z])
                deg, total = degree[term[lo:hi]], int(degree[term[lo:hi]].sum())
                own = np.repeat(np.arange(lo, hi), deg)
                item = items[np.arange(total) - np.repeat(np.cumsum(deg) - deg, deg) + np.repeat(bounds[term[lo:hi]], deg)]
                cell, width = (row[own] - a) * len(item_ids) + item, (z - a) * len(item_ids)
                if exact:
                    scores = np.bincount(cell, weights=part[own], minlength=width).astype(np.int64)
                else:
                    np.add.at(scores := np.zeros(width, dtype=np.int64), cell, part[own])
                best.add(scores.reshape(z - a, -1), ids[a:z])
        found = [(item_ids[i], None if d == T.NULL_ID else d, s) for i, d, s in best.documents()]
        cols = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item_id", "doc_id", "score"])

    return rows.select("m", "terms", "tfs", "ids").mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, keep: int = KEEP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``keep`` best documents."""
    spark = docs.sparkSession
    folder = T.scratch(spark, "lexical")
    sizes = item_terms(items).groupBy("item_id").agg(F.count(F.lit(1)).alias("c")).withColumn("all", F.lit(0))
    blocks = running_total(sizes, [F.col("item_id").asc()], "c", "upto", ["all"])
    blocks = blocks.select(F.col("item_id").alias("own"), F.expr(f"(upto - c) div {int(block_terms)}").alias("block"))
    item_terms(items).join(blocks, F.col("item_id").eqNullSafe(F.col("own"))).select("block", "item_id", "term").write.parquet(f"{folder}/items")
    wanted = spark.read.parquet(f"{folder}/items")
    n_docs = n_terms = None
    for block in range((wanted.agg(F.max("block")).first()[0] or 0) + 1):
        listed = wanted.where(F.col("block") == block).collect()
        vocabulary, item_ids = sorted({r["term"] for r in listed}), sorted({r["item_id"] for r in listed}, key=lambda x: (x is not None, x))
        number, place = {t: k for k, t in enumerate(vocabulary)}, {x: k for k, x in enumerate(item_ids)}
        pairs = np.array(sorted((number[r["term"]], place[r["item_id"]]) for r in listed), dtype=np.int64).reshape(-1, 2)
        bags(docs, vocabulary).write.parquet(f"{folder}/bags-{block}")
        bagged = spark.read.parquet(f"{folder}/bags-{block}")
        if n_docs is None:
            n_docs, n_terms = bagged.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = dict(bagged.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = np.array([np.floor(1000 * np.log((2 * n_docs + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(vocabulary))], dtype=np.int64)
        best = score_classes(classes(bagged, n_docs, max(n_terms, 1), keep), item_ids, pairs, weights, keep)
        rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id")))
        best.withColumn("rank", rank).where(F.col("rank") <= keep).write.parquet(f"{folder}/best/of={block}")
    return spark.read.parquet(f"{folder}/best").select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark, sf_dir):
    return search(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS t FROM documents),
totals AS (SELECT count(*) FILTER (len(t) > 0) AS docs, sum(len(t))::BIGINT AS terms FROM words),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
tf AS (
  SELECT doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM words)
  WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM wanted JOIN tf USING (term) JOIN w USING (term), totals GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= {KEEP}
"""
