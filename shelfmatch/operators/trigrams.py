"""Trigram bags and a block kernel for the top-k cosine join (MAT-1..3, JN-8, WIN-2, R1).

A folded text becomes one row ``(keys..., id, terms, tfs)``: its distinct trigrams as
21-bit codes (three 7-bit characters) in ascending order, and their counts. Such a row
is about a tenth of the exploded postings. A task reads bags once and scores them
against a whole block of queries that it holds (a checked broadcast):

1. the products over the query terms most frequent in the corpus, where nearly all of
   the work of an inverted index lies, are one dense matrix product;
2. a pair goes on only if that sum plus ``|q_rest| * |d_rest|`` (Cauchy-Schwarz over the
   rarer terms) and plus the largest products that the batch can add reaches the
   query's bar: the floor, or the k-th best score that the task has found;
3. the rarer terms are added for the rows of such pairs by their inverted lists.

Bounds only leave out pairs that cannot be among the task's k best, so results equal
those of the plain join. At most k pairs a query leave a task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from shelfmatch.functions import text as T

#: Cells of a dense block (queries x frequent terms, rows x queries) and postings of a slice.
CELLS, SLICE, SLACK, DIGITS = 1 << 22, 1 << 21, 1e-9, 10
#: Rows and postings that a block of queries and a block of the corpus hold at most (about, by a hash).
QUERIES, QUERY_POSTINGS, ROWS, ROW_POSTINGS = 1 << 12, 1 << 19, 1 << 14, 1 << 21


def short_batches(batches, column: str, limit: int = 1 << 20):
    """The batches cut so that a text or list column holds about ``limit`` bytes or items (a longer row stays whole)."""
    for b in batches:
        if b.num_rows:
            values = b.column(column)
            length = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
            size = np.array(pc.fill_null(length, 0), dtype=np.int64)
            cuts = np.r_[0, np.flatnonzero(np.diff((np.cumsum(size) - size) // limit)) + 1, b.num_rows]
            for a, z in zip(cuts[:-1], cuts[1:]):
                yield b.slice(int(a), int(z - a))


def bags(df: DataFrame, id_col: str, text_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., id, terms, tfs)``; a NULL text, or one under three characters, has an empty bag."""
    src = df.select(*keys, id_col, T.ngram_source(T.fold_name(F.col(text_col))).alias("_folded"))
    names = [*keys, id_col]

    def run(batches):
        for b in short_batches(batches, "_folded"):
            folded = b.column("_folded").fill_null("")
            raw = "".join(folded.to_pylist()).encode("ascii")
            data = np.frombuffer(raw, dtype=np.uint8).astype(np.int64)
            ends = np.cumsum(np.array(pc.binary_length(folded), dtype=np.int64))
            row = np.repeat(np.arange(b.num_rows), np.diff(np.r_[0, ends]))
            code = (data[:-2] << 14) | (data[1:-1] << 7) | data[2:] if len(data) > 2 else np.zeros(0, dtype=np.int64)
            inside = row[:-2] == row[2:] if len(data) > 2 else np.zeros(0, dtype=bool)
            found, count = np.unique((row[:-2][inside] << 21) | code[inside], return_counts=True) if len(code) else (code, code)
            cuts = pa.array(np.searchsorted(found, np.arange(b.num_rows + 1) << 21), pa.int32())
            terms = pa.ListArray.from_arrays(cuts, pa.array(found & ((1 << 21) - 1), pa.int32()))
            tfs = pa.ListArray.from_arrays(cuts, pa.array(count, pa.int32()))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], terms, tfs], [*names, "terms", "tfs"])

    lists = [StructField(n, ArrayType(IntegerType())) for n in ("terms", "tfs")]
    return src.mapInArrow(run, StructType([*[src.schema[n] for n in names], *lists]))


def spelled(code):
    """The trigram of a code, as a string column."""
    return F.concat(*[F.char(F.shiftrightunsigned(code, k).bitwiseAND(F.lit(127))) for k in (14, 7, 0)])


def by_key(table: pa.Table, keys: Sequence[str], columns: Sequence[str]) -> dict[tuple, list[list]]:
    """The named columns as lists, for each key tuple."""
    data = [table.column(c).to_pylist() for c in columns]
    if not keys:
        return {(): data} if table.num_rows else {}
    out: dict[tuple, list[list]] = {}
    for key, *row in zip(zip(*[table.column(c).to_pylist() for c in keys]), *data):
        for column, value in zip(out.setdefault(key, [[] for _ in columns]), row):
            column.append(value)
    return out


class Block:
    """The queries of one key: unit weights, split into frequent and rarer terms."""

    def __init__(self, ids: list, vectors: list, idf_terms: np.ndarray, df: np.ndarray, n_docs: int):
        self.ids, self.idf_terms = ids, idf_terms
        self.idf = np.log((n_docs + 1) / (df + 1)) + 1
        row = np.repeat(np.arange(len(ids)), [len(t) for t, _ in vectors])
        term = np.concatenate([np.asarray(t, dtype=np.int64) for t, _ in vectors] or [np.zeros(0, dtype=np.int64)])
        tf = np.concatenate([np.asarray(c, dtype=float) for _, c in vectors] or [np.zeros(0)])
        at, known = place(idf_terms, term)                       # unseen terms count nowhere, nor in the norm
        row, term, at, w = row[known], term[known], at[known], (tf[known] * self.idf[at[known]])
        w = w / np.sqrt(np.bincount(row, w * w, minlength=len(ids)))[row]
        used = np.unique(at)
        often = used[np.argsort(-df[used], kind="stable")[:max(1, min(1024, CELLS // max(1, len(ids))))]]
        self.often = np.sort(idf_terms[often])
        col, dense = place(self.often, term)
        self.dense = np.zeros((len(self.often), len(ids)))
        self.dense[col[dense], row[dense]] = w[dense]
        row, term, w = row[~dense], term[~dense], w[~dense]
        order = np.argsort(term, kind="stable")
        self.rare, self.starts = np.unique(term[order], return_index=True)
        self.starts = np.r_[self.starts, len(order)]
        self.row, self.w = row[order], w[order]
        self.rest = np.sqrt(np.bincount(row, w * w, minlength=len(ids)))


def place(known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of each value in the sorted ``known``, whether it is there)."""
    if not len(known):
        return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return at, known[at] == values


class Best:
    """Each query's best (score to DIGITS places, then id) pairs so far."""

    def __init__(self, block: Block, k: int, lower: float, floor: float | None):
        self.block, self.k, self.lower, self.floor, self.formed = block, k, lower, floor, 0
        self.bar = np.full(len(block.ids), -np.inf if floor is None else floor)
        self.ids: list = []
        self.query = self.at = np.zeros(0, dtype=np.int64)
        self.score = self.exact = np.zeros(0)

    def add(self, ids: list, size: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Score the bags of some rows (``size`` terms each)."""
        q, n = self.block, len(ids)
        row = np.repeat(np.arange(n), size)
        at, known = place(q.idf_terms, term)
        row, term, w = row[known], term[known], tf[known] * q.idf[at[known]]
        norm = np.sqrt(np.bincount(row, w * w, minlength=n))
        w = w / norm[row]
        col, dense = place(q.often, term)
        frequent = np.zeros((n, len(q.often)))
        frequent[row[dense], col[dense]] = w[dense]
        scores = frequent @ q.dense
        col, rare = place(q.rare, term)
        row, col, w = row[rare], col[rare], w[rare]
        rest = np.sqrt(np.bincount(row, w * w, minlength=n))
        most = np.zeros(len(q.rare))
        np.maximum.at(most, col, w)
        most = np.bincount(q.row, q.w * np.repeat(most, np.diff(q.starts)), minlength=len(q.ids)) if len(q.row) else 0.0
        alive = scores + np.minimum(np.outer(rest, q.rest), most) >= self.bar - SLACK
        self.formed += int(alive.sum())
        go = alive.any(1)[row]
        row, col, w = row[go], col[go], w[go]
        length = np.diff(q.starts)[col]
        own = np.repeat(np.arange(len(row)), length)
        entry = np.arange(len(own)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(q.starts[col], length)
        if len(own):
            cell = row[own] * len(q.ids) + q.row[entry]
            scores += np.bincount(cell, w[own] * q.w[entry], minlength=scores.size).reshape(scores.shape)
        rounded = np.round(scores, DIGITS)
        r, i = np.nonzero(alive & (scores > self.lower) & (rounded >= self.bar))
        used, back = np.unique(r, return_inverse=True)
        self.query, self.score, self.exact = np.r_[self.query, i], np.r_[self.score, rounded[r, i]], np.r_[self.exact, scores[r, i]]
        self.at = np.r_[self.at, back + len(self.ids)]
        self.ids += [ids[x] for x in used]
        if len(self.query) > 4 * self.k * len(q.ids):
            self.prune()

    def prune(self) -> None:
        if not len(self.query):
            return
        values = np.empty(len(self.ids), dtype=object)
        values[:] = self.ids
        order = np.argsort(values, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        order = np.lexsort((rank[self.at], -self.score, self.query))
        query = self.query[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        order = order[nth < self.k]
        used, at = np.unique(self.at[order], return_inverse=True)
        self.query, self.score, self.exact, self.at = self.query[order], self.score[order], self.exact[order], at
        self.ids = [self.ids[x] for x in used]
        last = np.flatnonzero(nth[nth < self.k] == self.k - 1)
        self.bar[self.query[last]] = np.maximum(self.bar[self.query[last]], self.score[last])

    def pairs(self) -> list[tuple]:
        self.prune()
        return [(self.block.ids[i], self.ids[a], float(s)) for i, a, s in zip(self.query, self.at, self.exact)]


def best_pairs(corpus: DataFrame, blocks: dict, keys: Sequence[str], query_field: StructField, query_id: str, corpus_id: str, k: int,
               lower: float, floor: float | None, formed=None) -> DataFrame:
    """``(keys..., query_id, corpus_id, similarity)``: at most k pairs a query from every task.

    ``blocks`` holds a :class:`Block` per key tuple. ``formed``, an accumulator, is given
    the number of pairs that the bounds let through."""
    shared = corpus.sparkSession.sparkContext.broadcast(blocks)
    fields = [corpus.schema[c] for c in keys]
    out = StructType([*fields, StructField(query_id, query_field.dataType), StructField(corpus_id, corpus.schema[corpus_id].dataType),
                      StructField("similarity", DoubleType())])
    types = [(f.name, f.dataType) for f in out.fields]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        known, best = shared.value, {}
        for b in short_batches(batches, "terms", SLICE):
            own = list(zip(*[b.column(c).to_pylist() for c in keys])) if keys else [()] * b.num_rows
            ids, terms, tfs = b.column(corpus_id).to_pylist(), b.column("terms"), b.column("tfs")
            size = np.array(terms.value_lengths(), dtype=np.int64)
            term, tf = np.array(terms.flatten(), dtype=np.int64), np.array(tfs.flatten(), dtype=float)
            starts = np.r_[0, np.cumsum(size)]
            rows_of: dict = {}
            for r, key in enumerate(own):
                if key in known and size[r]:
                    rows_of.setdefault(key, []).append(r)
            for key, rows in rows_of.items():
                block = known[key]
                if key not in best:
                    best[key] = Best(block, k, lower, floor)
                rows = np.array(rows)
                part = np.cumsum(size[rows] + len(block.often) + len(block.ids)) // SLICE
                for x in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
                    take = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in x])
                    best[key].add([ids[r] for r in x], size[x], term[take], tf[take])
        for key, found in best.items():
            rows = [(*key, *p) for p in found.pairs()]
            if formed is not None:
                formed.add(found.formed)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, to_arrow_type(t)) for c, (_, t) in zip(zip(*rows), types)], [n for n, _ in types])

    return corpus.select(*keys, corpus_id, "terms", "tfs").mapInArrow(run, out)


def block_pairs(asked: DataFrame, corpus: DataFrame, vocabulary: dict, keys: Sequence[str], query_id: str, corpus_id: str, k: int,
                lower: float, floor: float | None) -> DataFrame:
    """The pairs of :func:`best_pairs` where the queries are too many to broadcast.

    Queries and corpus rows of a key are dealt into blocks by a hash of their id; every block of
    queries meets every block of the corpus in a task that holds just these two. So a task's
    memory is bounded whatever the size of a key, and no pair leaves it but a query's k best.
    ``vocabulary`` maps a key tuple to (sorted terms, document frequencies, number of documents).
    """
    shared = corpus.sparkSession.sparkContext.broadcast(vocabulary)
    asked, corpus = asked.where(F.size("terms") > 0), corpus.where(F.size("terms") > 0)

    def blocks(bags, rows, postings, name):
        n, held = F.count(F.lit(1)), F.sum(F.size("terms"))
        return bags.groupBy(*keys).agg(F.ceil(F.greatest(n / rows, held / postings, F.lit(1.0))).alias(name))

    sizes = [blocks(asked, QUERIES, QUERY_POSTINGS, "_nq"), blocks(corpus, ROWS, ROW_POSTINGS, "_nc")]
    grid = F.broadcast(sizes[0].join(sizes[1], list(keys)) if keys else sizes[0].crossJoin(sizes[1]))

    def placed(bags, id_col, own, many, other, others):
        bags = bags.join(grid, list(keys)) if keys else bags.crossJoin(grid)
        return bags.select(*keys, id_col, "terms", "tfs", F.pmod(F.xxhash64(id_col), F.col(many)).alias(own),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)).alias(other)).groupBy(*keys, "_q", "_c")

    out = StructType([*[corpus.schema[c] for c in keys], StructField(query_id, asked.schema[query_id].dataType),
                      StructField(corpus_id, corpus.schema[corpus_id].dataType), StructField("similarity", DoubleType())])

    def run(key, queries, rows):
        from pyspark.sql.pandas.types import to_arrow_schema
        key = tuple(x.as_py() for x in key)[:len(keys)]
        found = []
        if queries.num_rows and rows.num_rows:
            terms, df, n_docs = shared.value[key]
            vectors = list(zip(queries.column("terms").to_pylist(), queries.column("tfs").to_pylist()))
            block = Block(queries.column(query_id).to_pylist(), vectors, terms, df, n_docs)
            best = Best(block, k, lower, floor)
            for b in rows.to_batches():
                size = np.array(b.column("terms").value_lengths(), dtype=np.int64)
                starts = np.r_[0, np.cumsum(size)]
                term, tf, ids = b.column("terms").flatten(), b.column("tfs").flatten(), b.column(corpus_id).to_pylist()
                part = np.cumsum(size + len(block.often) + len(block.ids)) // SLICE
                cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(size)]
                for a, z in zip(cuts[:-1], cuts[1:]):
                    at, n = int(starts[a]), int(starts[z] - starts[a])
                    best.add(ids[a:z], size[a:z], np.array(term.slice(at, n), dtype=np.int64), np.array(tf.slice(at, n), dtype=float))
            found = [(*key, *p) for p in best.pairs()]
        schema = to_arrow_schema(out)
        columns = zip(*found) if found else [[] for _ in out.fields]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    left = placed(asked, query_id, "_q", "_nq", "_c", "_nc")
    return left.cogroup(placed(corpus, corpus_id, "_c", "_nc", "_q", "_nq")).applyInArrow(run, out)
