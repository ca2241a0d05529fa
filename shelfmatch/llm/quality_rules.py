"""Quality rules as a short-circuit cascade.

Every rule is a test on a text; a document is kept if no rule rejects it. On a
bounded sample each rule's cost (seconds per document) and selectivity (share
rejected) are measured, and rules run in descending rejection per cost. A rule
sees only the documents that all earlier rules passed, so the order changes the
work but never the verdict.

Null or empty texts have no words and are rejected by the base rule. Equal rows
get equal verdicts; an empty table gives an empty result. Columns of the input
other than the id and the text are ignored by ``measure`` and kept by ``filter_documents``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmatch.llm import textcols as T

SAMPLE_ROWS = 500
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
SYMBOL_PERCENT, DUP_LINE_PERCENT, MAX_MEAN_WORD = 10, 30, 40
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class TextFacts:
    """Counts of the texts of one batch, each computed when first asked for."""

    def __init__(self, texts: pa.Array):
        self.texts, self._words, self._known = texts, None, {}

    @property
    def words(self) -> T.Words:
        if self._words is None:
            self._words = T.split_words(self.texts)
        return self._words

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self._known:
            self._known[name] = getattr(self, "_" + name)()
        return self._known[name]

    def _n_words(self):
        return np.diff(self.words.first)

    def _bytes_sum(self, flags):
        total = np.r_[0, np.cumsum(flags)]
        return total[self.words.offsets[1:]] - total[self.words.offsets[:-1]]

    def _word_chars(self):
        d = self.words.data
        point = (d & 0xC0) != 0x80
        return self._bytes_sum(point & ~((d == 32) | ((d >= 9) & (d <= 13))))

    def _n_symbols(self):
        return self._bytes_sum(np.isin(self.words.data, np.frombuffer(SYMBOLS, dtype=np.uint8)))

    def _n_lines(self):
        return self._bytes_sum(self.words.data == 10) + 1

    def _n_dup_lines(self):
        out = []
        for t in self.texts.to_pylist():
            seen: set[str] = set()
            dup = 0
            for line in (t or "").split("\n"):
                if line.strip(" \t\n\v\f\r"):
                    dup += line in seen
                    seen.add(line)
            out.append(dup)
        return np.array(out, dtype=np.int64)

    def _n_repeat_words(self):
        w = self.words
        doc, at = T.windows(w.first, REPEAT_WINDOW)
        if not len(at):
            return np.zeros(len(self.texts), dtype=np.int64)
        name = T.range_hash(w.data, w.start, w.end, 1)
        span = np.arange(len(name))
        span = T.range_hash(name, span[at], span[at] + REPEAT_WINDOW, 3)
        key = T.mix(span ^ T.mix(doc.astype(np.uint64), 5), 6)
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = at[count[back] > 1]
        edge = np.zeros(len(name) + 1, dtype=np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + REPEAT_WINDOW, -1)
        return T.per_doc(np.cumsum(edge)[:-1] > 0, w.first)


#: A rule maps facts to True where the text is rejected.
RULES: dict[str, Callable[[TextFacts], np.ndarray]] = {
    "few_words": lambda f: f["n_words"] < MIN_WORDS,
    "repeated_windows": lambda f: 100 * f["n_repeat_words"] > REPEAT_PERCENT * f["n_words"],
    "symbols": lambda f: 100 * f["n_symbols"] > SYMBOL_PERCENT * f["word_chars"],
    "repeated_lines": lambda f: 100 * f["n_dup_lines"] > DUP_LINE_PERCENT * f["n_lines"],
    "long_words": lambda f: f["word_chars"] > MAX_MEAN_WORD * f["n_words"],
}


def rule_order(sample: pa.Array, rules: dict | None = None) -> list[str]:
    """Rules by measured rejections per second, best first (ties: by name)."""
    rules = rules or RULES
    rate = {}
    for name, rule in rules.items():
        began = time.perf_counter()
        rejected = int(np.sum(rule(TextFacts(sample)))) if len(sample) else 0
        rate[name] = rejected / max(time.perf_counter() - began, 1e-9)
    return sorted(rules, key=lambda n: (-rate[n], n))


def cascade(texts: pa.Array, order: list[str], rules: dict | None = None) -> np.ndarray:
    """True where every rule passes; each rule runs on the survivors only."""
    rules = rules or RULES
    alive = np.arange(len(texts))
    for name in order:
        if not len(alive):
            break
        alive = alive[~rules[name](TextFacts(texts.take(pa.array(alive))))]
    kept = np.zeros(len(texts), dtype=bool)
    kept[alive] = True
    return kept


def sampled_order(docs: DataFrame, rules: dict | None = None) -> list[str]:
    """Rule order from at most SAMPLE_ROWS texts (it sets the order of work only)."""
    rows = docs.select("text").limit(SAMPLE_ROWS).collect()
    return rule_order(pa.array([r[0] for r in rows], pa.string()), rules)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed and the cascade's verdict ``kept``."""
    order = sampled_order(docs)

    def run(batches):
        for b in T.small_batches(batches):
            texts = b.column("text")
            kept = cascade(texts, order)
            f = TextFacts(texts)
            base = RULES["few_words"](f) | RULES["repeated_windows"](f)
            cols = [pa.array(f[n], pa.int64()) for n in FIELDS]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), *cols, pa.array(base), pa.array(kept & ~base)],
                ["doc_id", *FIELDS, "base_failed", "kept"])

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in FIELDS) + ", base_failed boolean, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the cascade keeps, with all their columns."""
    order = sampled_order(docs)

    def run(batches):
        for b in T.small_batches(batches):
            yield b.filter(pa.array(cascade(b.column("text"), order)))

    return docs.mapInArrow(run, docs.schema)


def op6_quality_rules(spark, sf_dir):
    return measure(T.documents(spark, sf_dir))
