"""Substring dedup by recompression.

Every document's words are rewritten in rounds: maximal runs of a symbol become one
symbol, then adjacent pairs whose first symbol is on the left side of the alphabet and
whose second is on the right become one symbol. Names and sides are hashes of content,
so they are the same in all documents and tasks without exchange. With each symbol goes
the range of words that decided it (its context). Equal passages therefore agree on
every symbol whose context lies inside them.

Every window of the text picks one high-level symbol whose context it holds, the least by
name, so equal windows pick alike. Windows in a row that pick the same occurrence are a
run, about one in five words; it is sent under the name of its symbol (the words of the
context) with a hash of all its words and of the symbol's place among them. A symbol that
no other run has proves that none of its windows occurs elsewhere. Of equal runs the first
(smallest id, then start) stays and the others go as they are. Only where runs of a symbol
differ, which is at the ends of repeated passages, are the windows of the first of each
kind compared one by one, by 96-bit names of all their words: of each name the first
window stays and the words of the later ones go. Repeats within one text are
found in the same way.

Rows are named by their id and 15 bits of a hash of the text, so rows that share an id, or
have none, are judged each by its own text; among them the smaller start comes first, then
the smaller hash. Equal rows of one id have one name: none of them starts before another.
Null and empty texts have no words; texts shorter than a window lose nothing. Null ids
order first and come back null. An empty table gives an empty result; ``deduplicated``
keeps extra columns, whatever their names, and the type of ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from shelfmatch.llm import textcols as T

WINDOW, ROUNDS = 20, 3
FAR = 1 << 40
#: Inner columns; those of the input travel in a struct beside them.
MARKS, FIRSTS = "marks", "firsts"
#: Bits of a text's hash that tell rows of one id apart; words from which a symbol rarely repeats by chance.
TIE, WIDE = 15, 7


def parse(name: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Context ranges (lo, hi) of the symbols after ``rounds`` rounds; ranges over an edge are huge."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    lo, hi = np.arange(len(name)), np.arange(1, len(name) + 1)
    for r in range(rounds):
        if not len(name):
            break
        # Runs: a symbol's run depends on the symbol before it and the one after it.
        opens = np.r_[True, (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])]
        at = np.flatnonzero(opens)
        last = np.r_[at[1:], len(name)] - 1
        prev, nxt = np.maximum(at - 1, 0), np.minimum(last + 1, len(name) - 1)
        has_prev = (at > 0) & (doc[prev] == doc[at])
        has_next = (last + 1 < len(name)) & (doc[nxt] == doc[last])
        new_lo = np.minimum(np.where(has_prev, np.minimum(lo[prev], lo[at]), -FAR), np.where(has_next, lo[nxt], FAR))
        new_hi = np.maximum(np.where(has_next, np.maximum(hi[nxt], hi[last]), FAR), np.where(has_prev, hi[prev], -FAR))
        length = (last - at + 1).astype(np.uint64)
        name = np.where(length > 1, T.mix(name[at] ^ T.mix(length, 100 + r), 200 + r), name[at])
        lo, hi, doc = new_lo, new_hi, doc[at]
        # Pairs: left-side symbol followed by a right-side one.
        right = (T.mix(name, 300 + r) >> T.U64(33)) & T.U64(1) == 1
        same = np.r_[doc[1:] == doc[:-1], False]
        joins = ~right & np.r_[right[1:], False] & same
        joined = np.r_[False, joins[:-1]]
        # A left-side symbol asks the next symbol, a right-side one the symbol before.
        next_lo, next_hi = np.where(same, np.r_[lo[1:], FAR], FAR), np.where(same, np.r_[hi[1:], FAR], FAR)
        after = np.r_[False, same[:-1]]
        prev_lo, prev_hi = np.where(after, np.r_[-FAR, lo[:-1]], -FAR), np.where(after, np.r_[-FAR, hi[:-1]], -FAR)
        pair = T.mix(T.mix(name, 400 + r) + np.r_[name[1:], name[:1]], 500 + r)
        new_lo = np.minimum(lo, np.where(right, prev_lo, next_lo))
        new_hi = np.maximum(hi, np.where(right, prev_hi, next_hi))
        keep = ~joined
        name, lo, hi, doc = np.where(joins, pair, name)[keep], new_lo[keep], new_hi[keep], doc[keep]
    return lo, hi


def names_of(w: T.Words) -> tuple[np.ndarray, np.ndarray]:
    return T.range_hash(w.data, w.start, w.end, 71), T.range_hash(w.data, w.start, w.end, 81)


def _ids(b: pa.RecordBatch) -> np.ndarray:
    return np.array(pc.fill_null(b.column("doc_id").cast(pa.int64()), T.NULL_ID))


def picked(n1: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, name) of the symbols of at most a window, and which of them each window picks (-1: it holds none).

    Of symbols that open at one word the narrowest of WIDE words or more counts, and a window picks such a one where it can:
    shorter ones repeat by chance."""
    lo, hi = parse(n1, first)
    ok = hi - lo <= window
    narrow = hi[ok] - lo[ok] < WIDE
    order = np.lexsort((hi[ok], narrow, lo[ok]))
    lo, hi = lo[ok][order], hi[ok][order]
    lead = np.r_[True, lo[1:] != lo[:-1]][:len(lo)]
    lo, hi = lo[lead], hi[lead]
    name = T.range_hash(n1, lo, hi, 91)
    _, at = T.windows(first, window)
    none = np.uint64(2**64 - 1)
    rank, width, which = np.full(len(n1), none), np.zeros(len(n1), dtype=np.int8), np.zeros(len(n1), dtype=np.int32)
    rank[lo] = T.mix(name, 92) >> np.uint64(1) | (np.uint64(1 << 63) * (hi - lo < WIDE).astype(np.uint64))
    width[lo], which[lo] = hi - lo, np.arange(len(lo))
    least, pick = np.full(len(at), none), np.full(len(at), -1, dtype=np.int32)
    for j in range(window if len(at) else 0):
        better = np.flatnonzero((rank[at + j] < least) & (width[at + j] <= window - j))
        least[better], pick[better] = rank[at[better] + j], which[at[better] + j]
    return lo, hi, name, pick


def runs(docs: DataFrame, window: int) -> DataFrame:
    """(name, words, doc_id, at): stretches of windows that pick one symbol, by its name and a hash of all their words.

    at = (32 * first window + number of windows - 1) << TIE | tie. A window without a symbol is a run under its own name."""
    def run(batches):
        for b in T.small_batches(batches):
            w = T.split_words(b.column("text"))
            n1, n2 = names_of(w)
            lo, _, name, pick = picked(n1, w.first, window)
            doc, start = T.windows(w.first, window)
            new = (pick[1:] != pick[:-1]) | (doc[1:] != doc[:-1]) | (pick[1:] < 0)
            opens = np.flatnonzero(np.r_[True, new][:len(pick)])
            count = np.diff(np.r_[opens, len(pick)])
            first, pick = start[opens], pick[opens]
            inner = T.range_hash(n2, first, first + count + window - 1, 98)
            alone = T.range_hash(n1, first, first + window, 95)
            place = np.where(pick >= 0, (lo[pick] if len(lo) else 0) - first, 0).astype(np.uint64)
            inner = T.mix(inner ^ T.mix(place, 99), 94)
            of = np.where(pick >= 0, name[pick] if len(name) else alone, alone)
            at = ((first - w.first[doc[opens]]) * 32 + count - 1) << TIE | np.array(b.column("tie"))[doc[opens]]
            yield pa.RecordBatch.from_arrays([pa.array(of.view(np.int64)), pa.array(inner.view(np.int64)), pa.array(_ids(b)[doc[opens]], pa.int64()),
                                              pa.array(at, pa.int64())], ["name", "words", "doc_id", "at"])
    return docs.select("doc_id", "tie", "text").mapInArrow(run, "name long, words long, doc_id long, at long")


def told(sent: DataFrame) -> DataFrame:
    """(doc_id, tie, own) of the runs, sorted by name, words and place, that go or differ; ``own`` as in ``window_state``.

    A run equal to one before it goes. The first of its kind differs if its name has runs of another kind: the first
    kind's first run is kept in hand until the next kind or name shows."""
    def run(batches):
        last = hand = None
        for b in batches:
            if not b.num_rows:
                continue
            name, words, doc, at = (np.array(b.column(c)) for c in ("name", "words", "doc_id", "at"))
            new_name = np.r_[last is None or last[0] != name[0], name[1:] != name[:-1]]
            new_kind = new_name | np.r_[last is None or last[1] != words[0], words[1:] != words[:-1]]
            # Equal rows of one id name the same run: it stands once.
            again = np.r_[last is not None and last[2:] == (doc[0], at[0]), (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])]
            gone = ~new_kind & ~again
            last = name[-1], words[-1], doc[-1], at[-1]
            kinds = np.flatnonzero(new_kind)
            other = ~new_name[kinds]                                  # a second or later kind of its name
            differs = kinds[other | np.r_[other[1:], False]] if len(kinds) else kinds
            out = [(doc[gone], at[gone], 0), (doc[differs], at[differs], 1)]
            if len(kinds):
                if hand is not None and other[0]:
                    out.append((*hand, 1))
                k = kinds[-1:]
                hand = None if other[-1] else (doc[k], at[k])
            own = np.concatenate([(a >> TIE) * 2 + kind for _, a, kind in out])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([d for d, _, _ in out])), pa.array(np.concatenate([a & ((1 << TIE) - 1) for _, a, _ in out])),
                                              pa.array(own)], ["doc_id", "tie", "own"])
    return sent.mapInArrow(run, "doc_id long, tie long, own long")


def window_state(w: T.Words, marks: list, window: int):
    """Windows (text, start), whether each goes with its run, and whether it is to be compared.

    ``marks`` are a text's runs that go (even) or differ (odd): 2 * (32 * first window + number of windows - 1) + 0 or 1."""
    doc, at = T.windows(w.first, window)
    edge = np.zeros((2, len(w.start) + 1), dtype=np.int64)
    for i, own in enumerate(marks):
        if own is not None and len(own):
            own, kind = np.asarray(own, dtype=np.int64) >> 1, np.asarray(own, dtype=np.int64) & 1
            here = own // 32 + own % 32 < w.first[i + 1] - w.first[i]          # two rows of one name, at worst
            own, kind = own[here], kind[here]
            np.add.at(edge, (kind, own // 32 + w.first[i]), 1)
            np.add.at(edge, (kind, own // 32 + own % 32 + 1 + w.first[i]), -1)
    gone, open_ = (np.cumsum(e)[at] > 0 if len(at) else np.zeros(0, dtype=bool) for e in edge)
    return doc, at, gone, open_ & ~gone


def open_windows(marked: DataFrame, window: int) -> DataFrame:
    """(h1, h2, doc_id, at) of the windows to be compared; at = start << TIE | tie."""
    def run(batches):
        for b in T.small_batches(batches):
            w = T.split_words(b.column("text"))
            doc, at, _, open_ = window_state(w, b.column(MARKS).to_pylist(), window)
            doc, at = doc[open_], at[open_]
            n1, n2 = names_of(w)
            h1, h2 = T.range_hash(n1, at, at + window, 95), T.range_hash(n2, at, at + window, 97)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1.view(np.int64)), pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(_ids(b)[doc], pa.int64()),
                 pa.array((at - w.first[doc] << TIE) | np.array(b.column("tie"))[doc], pa.int64())], ["h1", "h2", "doc_id", "at"])
    return marked.select("doc_id", "tie", "text", MARKS).mapInArrow(run, "h1 long, h2 int, doc_id long, at long")


def covered(w: T.Words, marks: list, firsts: list, window: int) -> np.ndarray:
    """True for each word in a window whose words start earlier somewhere."""
    _, at, gone, open_ = window_state(w, marks, window)
    is_first = np.zeros(len(w.start), dtype=bool)
    for i, own in enumerate(firsts):
        if own is not None and len(own):
            own = np.asarray(own, dtype=np.int64) + w.first[i]
            is_first[own[own < w.first[i + 1]]] = True
    gone = gone | (open_ & ~is_first[at])
    edge = np.zeros(len(w.start) + 1, dtype=np.int64)
    np.add.at(edge, at[gone], 1)
    np.add.at(edge, at[gone] + window, -1)
    return np.cumsum(edge)[:-1] > 0


def judged(docs: DataFrame, window: int = WINDOW, carry: tuple = ()) -> DataFrame:
    """doc_id, text, the columns of ``carry`` as a struct, marks (runs that go or differ) and firsts (starts of first windows)."""
    if window > 32:
        raise ValueError("windows of more than 32 words do not fit the packed symbols")
    text = F.col("text").cast("string")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(T.NULL_ID))
    row = F.struct(*carry).alias("row") if carry else F.lit(None).cast("boolean").alias("row")
    tie = F.pmod(F.xxhash64(text), F.lit(1 << TIE))
    keyed = docs.select(own.alias("doc_id"), text.alias("text"), tie.alias("tie"), row)
    # A frequent name is a stream in its task: sorted on disk if need be, and never held.
    sent = runs(keyed, window).repartition(T.shuffle_tasks(docs.sparkSession), "name")
    marks = told(sent.sortWithinPartitions("name", "words", "doc_id", "at")).groupBy("doc_id", "tie").agg(F.collect_list("own").alias(MARKS))
    marked = keyed.join(marks, ["doc_id", "tie"], "left")
    first = open_windows(marked, window).groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "at")).alias("f")).select("f.*")
    firsts = first.groupBy("doc_id", F.col("at").bitwiseAND(F.lit((1 << TIE) - 1)).alias("tie")).agg(
        F.collect_list(F.shiftright("at", TIE)).alias(FIRSTS))
    return marked.join(firsts, ["doc_id", "tie"], "left")


def _real_id(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == T.NULL_ID)


def _kept_texts(w: T.Words, gone: np.ndarray) -> list[str]:
    raw = w.data.tobytes()
    s, e = w.start.tolist(), w.end.tolist()
    stay = (~gone).tolist()
    return [b" ".join(raw[s[k]:e[k]] for k in range(a, z) if stay[k]).decode()
            for a, z in zip(w.first[:-1].tolist(), w.first[1:].tolist())]


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the words that stay."""
    def run(batches):
        for b in T.small_batches(batches):
            w = T.split_words(b.column("text"))
            gone = covered(w, b.column(MARKS).to_pylist(), b.column(FIRSTS).to_pylist(), window)
            sha = [hashlib.sha256(t.encode()).hexdigest() for t in _kept_texts(w, gone)]
            yield pa.RecordBatch.from_arrays(
                [_real_id(_ids(b)), pa.array(np.diff(w.first), pa.int64()), pa.array(T.per_doc(gone, w.first), pa.int64()),
                 pa.array(sha)], ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return judged(docs, window).select("doc_id", "text", MARKS, FIRSTS).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without repeated passages: a text that loses words becomes its other words
    joined by spaces, one that loses none is unchanged, one that loses all is dropped."""
    schema = docs.schema

    def run(batches):
        for b in T.small_batches(batches):
            w = T.split_words(b.column("text"))
            gone = covered(w, b.column(MARKS).to_pylist(), b.column(FIRSTS).to_pylist(), window)
            lost, had = T.per_doc(gone, w.first), np.diff(w.first)
            row = pa.RecordBatch.from_struct_array(b.column("row"))
            new = pa.array([t if n else o for t, n, o in zip(_kept_texts(w, gone), lost, b.column("text").to_pylist())], pa.string())
            cols = {"text": new.cast(row.schema.field("text").type)}
            if "n_chars" in row.schema.names:
                cols["n_chars"] = pc.if_else(pa.array(lost > 0), pc.utf8_length(new).cast(row.column("n_chars").type), row.column("n_chars"))
            out = pa.RecordBatch.from_arrays([cols.get(n, row.column(n)) for n in schema.names], schema.names)
            yield out.filter(pa.array(~((lost == had) & (had > 0))))

    return judged(docs, window, tuple(schema.names)).select("text", "row", MARKS, FIRSTS).mapInArrow(run, schema)


def op1_substring_dedup(spark, sf_dir):
    return report(T.documents(spark, sf_dir))


SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM d),
later AS (
  SELECT doc_id, i FROM starts
  QUALIFY row_number() OVER (PARTITION BY array_to_string(words[i:i + {WINDOW - 1}], ' ') ORDER BY doc_id, i) > 1),
told AS (
  SELECT w.doc_id, w.i, word, count(later.i) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS {WINDOW - 1} PRECEDING) > 0 AS gone
  FROM w LEFT JOIN later ON later.doc_id = w.doc_id AND later.i = w.i),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS text FROM told GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
