"""Best-fit packing with bound-certified repacking.

Documents are tokenised (each unit of text that a byte-level BPE encodes on its own once
in a worker), cut where longer than a sequence and packed by best-fit decreasing inside
hash partitions. Dual feasible functions over the lengths give a
lower bound on each partition's number of sequences. A partition that meets its bound
is certified and final. One with a gap keeps its fullest sequences and gives up the
emptiest ones; the documents in those are exchanged into as many partitions of about
``GROUP`` pieces as they fill and packed again, round by round, until all is certified, one
partition is left or a round saves no sequence. What is left then stays as it was packed,
with its gap to the bounds in the log.

Null texts are empty (the end id alone). Repeated rows are packed separately. An
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import json
import logging
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmatch.llm import textcols as T
from shelfmatch.session import materialize

LENGTH, END_ID = 1024, 2
GROUP, RELEASE = 50_000, 8
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECE + ", part int, sequence_id long, offset long, final boolean, gap long"

SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u01ba"
#: Parts that the byte-level pattern (contractions, letters, digits, others, white space) never reaches across: its matches end
#: where white space begins, less one space before a word, and where letters are followed by an ASCII character that is none.
UNIT = re.compile(rf" ?[{LETTERS}]++(?=[\x00-@\[-`{{-\x7f]|\Z)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter."""
    head = n % length
    return ([(0, head)] if head else []) + [(s, length) for s in range(head, n, length)]


@lru_cache(maxsize=2)
def id_encoder(path: str):
    """text -> its ids as little-endian 32-bit numbers, by the tokenizer at ``path``."""
    import os

    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(path)
    made = json.loads(tok.to_str())
    kind, model = made["pre_tokenizer"] or {}, made["model"]
    added = [t["content"] for t in made["added_tokens"]]
    whole = lambda text: np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()
    if made["normalizer"] or made["truncation"] or made["padding"] or kind.get("type") != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"] \
            or model["type"] != "BPE" or model["dropout"]:
        return whole
    split, tokens = tok.pre_tokenizer.pre_tokenize_str, tok.model.tokenize

    def encode(unit: str) -> list[int]:
        word = unit.removeprefix(" ")
        if word.isascii() and word.isalpha():       # one part; the byte-level alphabet has letters as they are and the space as Ġ
            return [t.id for t in tokens(unit.replace(" ", "Ġ"))]
        return [t.id for part, _ in split(unit) for t in tokens(part)]
    units = T.UnitIds(encode)
    return lambda text: whole(text) if any(t in text for t in added) else units.joined(UNIT.findall(text))


def token_pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document: position, length and crc32 of its ids."""
    def run(batches):
        encode, end = id_encoder(path), np.array([end_id], dtype="<u4").tobytes()
        for b in T.small_batches(batches):
            rows = []
            for doc, text in zip(b.column("doc_id").cast(pa.int64()).to_pylist(), b.column("text").to_pylist()):
                ids = encode(text or "") + end
                rows += [(doc, i, s, n, zlib.crc32(ids[4 * s:4 * (s + n)])) for i, (s, n) in enumerate(cut(len(ids) // 4, length))]
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return docs.select("doc_id", "text").mapInArrow(run, PIECE)


def best_fit(lengths: np.ndarray, size: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin, offset) of each length and the fill of each bin.

    Bins are kept in one stack per residual; a bit set names the stacks in use,
    so the tightest bin that fits is the lowest set bit from the length up.
    """
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    used, fill = 0, []
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        above = used >> n
        if above:
            left = n + (above & -above).bit_length() - 1
            b = stacks[left].pop()
            if not stacks[left]:
                used &= ~(1 << left)
        else:
            b, left = len(fill), size
            fill.append(0)
        where[i], offset[i] = b, fill[b]
        fill[b] += n
        left -= n
        if left:
            stacks[left].append(b)
            used |= 1 << left
    return where, offset, np.array(fill, dtype=np.int64)


def lower_bound(lengths: np.ndarray, size: int = LENGTH) -> int:
    """Best bound of the threshold family of dual feasible functions.

    For a threshold k: lengths over size - k count as a whole bin, lengths under k as
    nothing, and the small rest must go beside the middle ones or into more bins.
    """
    hist = np.bincount(lengths, minlength=size + 1)
    count, total = np.r_[0, np.cumsum(hist)], np.r_[0, np.cumsum(hist * np.arange(size + 1))]
    k = np.arange(0, size // 2 + 1)
    big = count[size + 1] - count[size - k + 1]
    mid = count[size - k + 1] - count[size // 2 + 1]
    mid_sum = total[size - k + 1] - total[size // 2 + 1]
    small = total[size // 2 + 1] - total[np.minimum(k, size // 2 + 1)]
    more = np.maximum(0, -(-(small - (mid * size - mid_sum)) // size))
    return int((big + mid + more).max())


def packer(step: int, last: bool, size: int):
    """Packs one partition; marks as final the sequences that it keeps."""
    def repack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True]).reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        where, offset, fill = best_fit(lengths, size)
        gap = len(fill) - lower_bound(lengths, size)
        keep = np.ones(len(fill), dtype=bool)
        if gap and not last:
            keep[np.argsort(fill, kind="stable")[:max(RELEASE, 4 * gap)]] = False
        seq = (np.int64(step) << np.int64(56)) + (pdf["part"].to_numpy().astype(np.int64) << np.int64(36)) + where
        return pdf.assign(sequence_id=seq, offset=offset, final=keep[where], gap=gap)
    return repack


def pack(pieces: DataFrame, size: int = LENGTH) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    left, done, step, rounds, open_, before = pieces, None, 0, None, None, None
    while True:
        tasks = max(1, -(-left.count() // GROUP))
        rounds = rounds or tasks.bit_length()
        salted = left.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", F.lit(step)), F.lit(tasks)).cast("int"))
        placed = materialize(salted.groupBy("part").applyInPandas(packer(step, tasks == 1, size), PLACED))
        if before is not None and placed.select("sequence_id").distinct().count() >= before:
            return done.unionByName(as_is(open_))   # nothing saved: the round is not used
        kept = placed.where("final").drop("final", "part", "gap")
        done = kept if done is None else done.unionByName(kept)
        open_, step = placed.where(~F.col("final")), step + 1
        before = open_.select("sequence_id").distinct().count()
        if not before:
            return done
        if step == rounds:
            return done.unionByName(as_is(open_))
        left = open_.select(*pieces.columns)


def as_is(open_: DataFrame) -> DataFrame:
    """Sequences of uncertified partitions, final as they are; their gap is logged."""
    gap = open_.groupBy("part").agg(F.max("gap").alias("gap")).agg(F.sum("gap"), F.count("*")).first()
    logging.getLogger(__name__).warning("packing: %d sequences above the lower bounds of %d partitions", *gap)
    return open_.drop("final", "part", "gap")


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    return pack(materialize(token_pieces(docs, path or tokenizer_path())))


def op3_best_fit_packing(spark, sf_dir):
    return pack_documents(T.documents(spark, sf_dir))
