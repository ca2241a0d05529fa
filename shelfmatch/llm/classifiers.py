"""Toxicity and quality classifiers, fitted in numpy and scored in Spark.

Features are hashes of bytes of the text alone. Fitting uses at most ``rows``
labelled texts of at most ``chars`` characters each (documented bounds, chosen
by a hash of the id); every text is scored whole.

* Toxicity: a logistic model over distinct word and word-beginning features with
  a counterfactual term: identity words in each labelled text are swapped for
  others of their list and the squared change of the score is penalised. An L1
  step keeps the model to the features that carry the label, so a long neutral
  text collects no score from its length.
* Quality: hashed word and character n-gram embeddings, averaged per text, with
  a softmax output, trained by stochastic gradient descent.

Null and empty texts have no features and get the score of the bias (toxicity)
or of the zero vector (quality). Labels that are null are not learnt from; of
several labels of one id the largest counts. With no labels of one class the score
is the share of the other. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmatch.llm import textcols as T

TOXIC_ROWS, QUALITY_ROWS, FIT_CHARS = 5_000, 5_000, 20_000
BUCKETS = 1 << 20
MIN_TEXTS, MIN_SHARE = 3, 0.001
GRAM_BUCKETS, DIM = 1 << 18, 8

# Identity terms swapped for one another, per language.
IDENTITY = (
    ("women", "men", "girls", "boys", "muslims", "christians", "jews", "hindus", "immigrants", "natives",
     "gay", "straight", "black", "white", "asian", "latino", "disabled", "elderly", "young"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "noirs", "blancs", "vieux", "jeunes"),
    ("frauen", "männer", "muslime", "christen", "juden", "einwanderer", "schwarze", "weiße", "alte", "junge"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "negros", "blancos", "viejos", "jóvenes"),
)
_SWAP = {w: (group, i) for group in IDENTITY for i, w in enumerate(group)}
_IDENTITY_RE = re.compile(r"\b(?:" + "|".join(sorted(_SWAP, key=len, reverse=True)) + r")\b", re.IGNORECASE)


def counterfactual(text: str, shift: int) -> str:
    """The text with each identity term moved ``shift`` places on in its list."""
    def swap(m):
        group, i = _SWAP[m.group().lower()]
        return group[(i + shift) % len(group)]
    return _IDENTITY_RE.sub(swap, text)


# ---------------------------------------------------------------- features
def toxic_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, distinct: words and their first 4 and 5 bytes, A-Z lower-cased."""
    w = T.split_words(texts, lower=True)
    doc, keys = [], []
    for seed, cut in ((11, None), (12, 4), (13, 5)):
        long_enough = slice(None) if cut is None else (w.end - w.start >= cut)
        s = w.start[long_enough]
        e = w.end[long_enough] if cut is None else s + cut
        doc.append(w.doc[long_enough])
        keys.append(T.range_hash(w.data, s, e, seed) % T.U64(BUCKETS))
    pair = np.unique(np.concatenate(doc).astype(np.int64) * BUCKETS + np.concatenate(keys).astype(np.int64))
    return pair // BUCKETS, pair % BUCKETS


def quality_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket), one per word, word beginning and byte 3- and 4-gram; ordered by text."""
    w = T.split_words(texts)
    doc, keys = [w.doc], [T.range_hash(w.data, w.start, w.end, 21)]
    byte_doc = np.repeat(np.arange(len(texts)), np.diff(w.offsets))
    for n in (3, 4):
        if len(w.data) < n:
            continue
        code = np.zeros(len(w.data) - n + 1, dtype=np.uint64)
        for k in range(n):
            code = code * T.U64(256) + w.data[k:len(w.data) - n + 1 + k]
        own = byte_doc[n - 1:] == byte_doc[:len(byte_doc) - n + 1]
        doc.append(byte_doc[n - 1:][own])
        keys.append(T.mix(code[own], 21 + n))
    doc = np.concatenate(doc)
    keys = (np.concatenate(keys) % T.U64(GRAM_BUCKETS)).astype(np.int64)
    order = np.argsort(doc, kind="stable")
    return doc[order], keys[order]


# ---------------------------------------------------------------- fitting
def fit_toxic(texts: list[str], labels: np.ndarray, swaps: int = 1, strength: float = 1.0,
              l1: float = 8e-4, steps: int = 80, rate: float = 0.4) -> tuple[np.ndarray, float]:
    """Weights and bias: log loss + strength * (score change under swaps)^2 + L1."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    weights, bias = np.zeros(BUCKETS), float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return weights, bias
    doc, key = _features_of(texts, toxic_features)
    named = [i for i, t in enumerate(texts) if _IDENTITY_RE.search(t or "")]
    twins = [counterfactual(texts[i], 1 + s) for s in range(swaps) for i in named]
    origin = np.array(named * swaps, dtype=np.int64)
    tdoc, tkey = _features_of(twins, toxic_features)
    # A feature of fewer labelled texts than MIN_TEXTS or MIN_SHARE of them is not learnt from.
    common = np.bincount(key, minlength=BUCKETS) >= max(MIN_TEXTS, MIN_SHARE * len(texts))
    doc, key, tdoc, tkey = doc[common[key]], key[common[key]], tdoc[common[tkey]], tkey[common[tkey]]
    used, key = np.unique(np.concatenate([key, tkey]), return_inverse=True)
    key, tkey = key[:len(doc)], key[len(doc):]
    w, m, v = np.zeros(len(used)), np.zeros(len(used)), 1e-8
    balance = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    n = len(texts)
    for _ in range(steps):
        p = _sigmoid(np.bincount(doc, w[key], n) + bias)
        err = balance * (p - labels) / n
        g = np.bincount(key, err[doc], len(used))
        if len(origin):
            q = _sigmoid(np.bincount(tdoc, w[tkey], len(origin)) + bias)
            gap = 2 * strength * (p[origin] - q) / len(origin)
            slope = np.bincount(origin, gap * p[origin] * (1 - p[origin]), n)
            g += np.bincount(key, slope[doc], len(used))
            g -= np.bincount(tkey, (gap * q * (1 - q))[tdoc], len(used))
        m += g * g
        step = rate / np.sqrt(m + v)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        bias -= rate * float(err.sum())
    weights[used] = w
    return weights, bias


def fit_quality(texts: list[str], labels: np.ndarray, epochs: int = 8, rate: float = 1.0,
                seed: int = 7) -> np.ndarray:
    """Per-bucket log-odds: the trained embeddings times the softmax output weights.

    The average of embeddings and the output layer are linear, so their product
    per bucket gives the same score as keeping both tables.
    """
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return np.r_[np.zeros(GRAM_BUCKETS), np.log(share / (1 - share))]
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-0.5 / DIM, 0.5 / DIM, (GRAM_BUCKETS, DIM))
    out, bias = np.zeros((DIM, 2)), np.zeros(2)
    bags = []
    for t in texts:
        _, k = quality_features(pa.array([t]))
        idx, count = np.unique(k, return_counts=True)
        bags.append((idx, (count / max(len(k), 1))[:, None]))
    total = epochs * len(texts)
    done = 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            idx, share = bags[i]
            lr = rate * (1 - done / total)
            done += 1
            h = (emb[idx] * share).sum(0)
            z = h @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= lr * np.outer(h, p)
            bias -= lr * 0.1 * p
            emb[idx] -= lr * GRAM_STEP * share * back
    return np.r_[emb @ (out[:, 1] - out[:, 0]), bias[1] - bias[0]]


GRAM_STEP = 20.0


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _features_of(texts: list[str], make) -> tuple[np.ndarray, np.ndarray]:
    docs, keys, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while at < len(texts):
        doc, key = make(pa.array(texts[at:at + 500], pa.string()))
        docs.append(doc + at)
        keys.append(key)
        at += 500
    return np.concatenate(docs), np.concatenate(keys)


def toxic_scores(texts: pa.Array, model) -> np.ndarray:
    doc, key = toxic_features(texts)
    return _sigmoid(np.bincount(doc, model[0][key], len(texts)) + model[1])


def quality_scores(texts: pa.Array, model) -> np.ndarray:
    doc, key = quality_features(texts)
    n = np.bincount(doc, minlength=len(texts))
    return _sigmoid(np.bincount(doc, model[key], len(texts)) / np.maximum(n, 1) + model[-1])


# ---------------------------------------------------------------- Spark
def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, out_fold: int,
                  rows: int, chars: int = FIT_CHARS) -> tuple[list[str], np.ndarray]:
    """At most ``rows`` labelled texts of at most ``chars`` characters, outside the held-out fold."""
    usable = (labels.groupBy("doc_id").agg(F.max(label).alias("y"))
              .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (T.crc_of_id(F.col("doc_id")) % folds != out_fold)))
    # A few more ids than needed (bounded): some have no text or a longer one.
    ids = usable.select("doc_id", "y", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(2 * rows)
    got = (docs.select("doc_id", "text").where(F.length("text") <= chars)
           .join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y", "h")
           .orderBy("h", "doc_id", "text").limit(rows).collect())
    return [r["text"] for r in got], np.array([r["y"] for r in got], dtype=np.int64)


def _score(docs: DataFrame, model, scores, keep_if=None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: the bucket count

    def run(batches):
        for b in T.small_batches(batches):
            s = scores(b.column("text"), shared.value)
            if keep_if is not None:
                yield b.filter(pa.array(keep_if(s)))
            else:
                yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(s)], ["doc_id", "score"])

    if keep_if is not None:
        return docs.mapInArrow(run, docs.schema)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def toxic_model(docs: DataFrame, labels: DataFrame):
    return fit_toxic(*training_rows(docs, labels, "toxic", 3, 1, TOXIC_ROWS))


def quality_model(docs: DataFrame, labels: DataFrame):
    return fit_quality(*training_rows(docs, labels, "quality", 5, 0, QUALITY_ROWS))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents that score under ``threshold``, with all their columns."""
    return _score(docs, toxic_model(docs, labels), toxic_scores, lambda s: s < threshold)


def _digest(scored: DataFrame, folds: int, out_fold: int, threshold: float) -> DataFrame:
    return scored.select("doc_id", (T.crc_of_id(F.col("doc_id")) % folds == out_fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_toxicity(spark, sf_dir):
    docs, labels = T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _digest(_score(docs, toxic_model(docs, labels), toxic_scores), 3, 1, 0.7)


def op8_quality_classifier(spark, sf_dir):
    docs, labels = T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _digest(_score(docs, quality_model(docs, labels), quality_scores), 5, 0, 0.3)
