"""Ranked lexical search against a plain reading of its definition."""
import math
import random
import re
from collections import Counter

import pytest

from shelfmatch.llm import lexical

LOWER = str.maketrans(lexical.UPPER, lexical.LOWER)
DOCS, ITEMS = "doc_id long, text string, id long, terms string", "item_id long, text string, block string"


def words(text):
    return re.findall(lexical.TERM, (text or "").translate(LOWER))


def brute(docs, items, keep=50):
    bags = [(i, Counter(words(t))) for i, t in docs]
    length = {k: sum(b.values()) for k, (_, b) in enumerate(bags)}
    n, total = sum(1 for x in length.values() if x), sum(length.values())
    df = Counter(t for _, b in bags for t in b)
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(words(t))
    out = []
    for item, wanted in terms.items():
        scores = []
        for k, (doc, bag) in enumerate(bags):
            m = 50 + (50 * length[k] * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                    for t in wanted if bag[t])
            if s > 0:
                scores.append((-s, doc is not None, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:keep])]
    return out


def rows(spark, docs, items):
    return (spark.createDataFrame([(i, t, 7, "x") for i, t in docs], DOCS), spark.createDataFrame([(i, t, "b") for i, t in items], ITEMS))


def table(seed=4):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)] + ["É", "ß9", "中文", "Été"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "\n", ", ", "_", "\x00", "-"]) for _ in range(n))
    docs = [(k * 2, text(rng.randrange(1, 60))) for k in range(150)]
    docs += [(1000 + k, "W1 w2 w3 same bag") for k in range(90)] + [(900 - k, "bag same w3 w2 w1") for k in range(80)]    # one class
    docs += [(5, None), (7, ""), (9, " ,;"), (None, "w1 w2"), (None, "w1 w2"), (4, "w9 w9"), (4, docs[2][1]), (11, "w5 " * 20000)]
    items = [(k, text(8)) for k in range(12)] + [(20, None), (21, ""), (22, "unseen"), (None, "w1 same"), (3, "w7 w7 bag")]
    return docs, items


@pytest.mark.parametrize("block_terms", [lexical.BLOCK_TERMS, 10])
def test_equals_brute_force(spark, block_terms):
    docs, items = table()
    got = [tuple(r) for r in lexical.search(*rows(spark, docs, items), block_terms=block_terms).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)


def test_one_class_is_expanded_by_ascending_id(spark):
    docs = [(i, "alpha beta" if i % 2 else "beta ALPHA") for i in range(300, 0, -1)] + [(0, "gamma " * 5)]
    got = lexical.search(*rows(spark, docs, [(1, "alpha")])).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(1, 51)) and len({r["score"] for r in got}) == 1


def test_many_ties_and_pruning(monkeypatch, spark):
    monkeypatch.setattr(lexical, "CELLS", 8)
    docs = [(i, f"alpha pad{i}") for i in range(400, 0, -1)] + [(500 + i, "alpha " * (1 + i % 3)) for i in range(60)]
    items = [(1, "alpha pad7 pad9"), (2, "pad3")]
    got = [tuple(r) for r in lexical.search(*rows(spark, docs, items), keep=6).collect()]
    assert sorted(got) == sorted(brute(docs, items, 6))


def test_scores_beyond_doubles_add_up_as_integers():
    import numpy as np
    best = lexical.Best(1, 2)
    best.add(np.array([[2**53 + 1], [2**53], [0]], dtype=np.int64), [[1], [2], [3]])
    assert list(best.documents()) == [(0, 1, 2**53 + 1), (0, 2, 2**53)]


def test_empty_tables(spark):
    docs, items = rows(spark, *table())
    none_docs, none_items = rows(spark, [], [])
    for d, i in ((none_docs, items), (docs, none_items), (none_docs, none_items)):
        assert lexical.search(d, i).count() == 0


def test_long_text_is_read_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK", 16)
    text = " ".join(f"w{k % 13}" for k in range(5000)) + "x" * 100
    whole = Counter(words(text))
    assert lexical.term_counts(text, {b"w3": 0, b"w4": 1}) == (5000, {0: whole["w3"], 1: whole["w4"]})
