"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model file's protobuf is read field by field and rebuilt as a tokenizer: the
normaliser (character map, white space), the metaspace marker, the scores (unigram
scores, or the merge order of a BPE model) and byte fallback. Where no piece spans words,
a worker encodes each word once. ``encode`` returns the ids of every text and ``decode`` the text of
every row of ids; ``encode_documents`` keeps both, derives counts and checksums from
them and compares them with the ``sentencepiece`` library on every text.

Null and empty texts have no ids; no ids and null ids decode to the empty text. Repeated
rows are encoded separately; an empty table gives no rows; ``encode`` does not read extra
columns and ``decode`` keeps them.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from shelfmatch.llm import textcols as T

MARK = "▁"
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
THREADS = 2
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
BYTE_PIECE = re.compile("<0x([0-9A-Fa-f]{2})>")


def fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message; nested messages stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = buf[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, buf[at:at + n]
            at += n
        else:
            n = {1: 8, 5: 4}[kind]
            yield tag >> 3, struct.unpack("<d" if n == 8 else "<f", buf[at:at + n])[0]
            at += n


def read_model(buf: bytes) -> dict:
    """Pieces (text, score, type), model type and normaliser settings."""
    out = {"pieces": [], "bpe": False, "byte_fallback": False, "charsmap": b"",
           "dummy_prefix": True, "collapse": True, "escape": True}
    for number, value in fields(buf):
        if number == 1:
            p = dict(fields(value))
            out["pieces"].append((p.get(1, b"").decode(), p.get(2, 0.0), p.get(3, NORMAL)))
        elif number == 2:
            t = dict(fields(value))
            out["bpe"], out["byte_fallback"] = t.get(3, 1) == 2, bool(t.get(35, 0))
        elif number == 3:
            n = dict(fields(value))
            out["charsmap"] = n.get(2, b"")
            out["dummy_prefix"], out["collapse"], out["escape"] = (bool(n.get(k, 1)) for k in (3, 4, 5))
    return out


def merge_order(pieces) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best resulting score first."""
    ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
    found = []
    for p, score, kind in pieces:
        if kind == NORMAL:
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    found.append((-score, a, b, p[:k], p[k:]))
    return [(a, b) for *_, a, b in sorted(found)]


def build(path: str):
    """A ``tokenizers.Tokenizer`` equal to the model at ``path``."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers
    with open(path, "rb") as f:
        m = read_model(f.read())
    pieces = m["pieces"]
    unk = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
    if m["bpe"]:
        tok = Tokenizer(models.BPE({p: i for i, (p, _, _) in enumerate(pieces)}, merge_order(pieces), unk_token=pieces[unk][0],
                                   fuse_unk=True, byte_fallback=m["byte_fallback"]))
    else:
        tok = Tokenizer(models.Unigram([(p, s) for p, s, _ in pieces], unk, m["byte_fallback"]))
    steps = [normalizers.Precompiled(m["charsmap"])] if m["charsmap"] else []
    if m["collapse"]:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if m["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    if m["dummy_prefix"]:
        steps.append(normalizers.Prepend(MARK if m["escape"] else " "))
    tok.normalizer = normalizers.Sequence(steps)
    # No piece holds the marker after another character: words never share a piece and can be cached.
    if not any(MARK in p.lstrip(MARK) for p, _, kind in pieces if kind == NORMAL):
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(WORD.pattern), "isolated")
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tok.decoder = decoders.Sequence(back + ([decoders.Strip(" ", 1, 0)] if m["dummy_prefix"] else []))
    tok.add_tokens([AddedToken(p, normalized=False) for p, _, kind in pieces if kind == USER])
    return tok


@lru_cache(maxsize=2)
def _tokenizer(path: str, threads: int):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    return build(path)


def _id_lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a list column, and where each row's begin and end (null: none)."""
    return col.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False))]


@lru_cache(maxsize=2)
def _id_encoder(path: str, threads: int):
    """texts -> the ids of each as little-endian 32-bit numbers."""
    tok = _tokenizer(path, threads)
    if not tok.pre_tokenizer or tok.get_added_tokens_decoder():
        return lambda texts: [np.array(e.ids, dtype="<u4").tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    with open(path, "rb") as f:
        m = read_model(f.read())
    tokens, normal = tok.model.tokenize, tok.normalizer.normalize_str
    if not (m["escape"] and m["dummy_prefix"]) or m["charsmap"] or m["collapse"]:
        words = T.UnitIds(lambda word: [t.id for t in tokens(word)])
        return lambda texts: [words.joined(WORD.findall(normal(t))) for t in texts]
    # Every word begins with a marker, left out here. With single spaces and no marker, words are what stands between the spaces.
    words = T.UnitIds(lambda word: [t.id for t in tokens(MARK + word)])

    def split(t: str) -> list[str]:
        if t.startswith(" ") or "  " in t or MARK in t:
            return [w[1:] for w in WORD.findall(MARK + t.replace(" ", MARK))]
        return t.split(" ") if t else []
    return lambda texts: [words.joined(split(t)) for t in texts]


@lru_cache(maxsize=2)
def _spelling(path: str, threads: int) -> tuple[list[bytes], str]:
    """The bytes that each id stands for, and what is taken off a text's beginning."""
    tok = _tokenizer(path, threads)
    names = [tok.id_to_token(i) or "" for i in range(tok.get_vocab_size())]
    with open(path, "rb") as f:
        lead = " " if read_model(f.read())["dummy_prefix"] else ""
    return [bytes.fromhex(m[1]) if (m := BYTE_PIECE.fullmatch(p)) else p.replace(MARK, " ").encode() for p in names], lead


@lru_cache(maxsize=2)
def _id_decoder(path: str, threads: int):
    """ids -> their text; where bytes are no UTF-8 or ids are unknown, as the tokenizer has it."""
    tok, (spelt, lead) = _tokenizer(path, threads), _spelling(path, threads)

    def text(ids: np.ndarray) -> str:
        if len(ids) and 0 <= ids.min() and ids.max() < len(spelt):
            try:
                return b"".join(map(spelt.__getitem__, ids.tolist())).decode().removeprefix(lead)
            except UnicodeDecodeError:
                pass
        return tok.decode(ids.tolist(), skip_special_tokens=False)
    return text


@lru_cache(maxsize=2)
def _rows_decoder(path: str, threads: int):
    """(ids of all rows, where the rows begin and end) -> the rows' texts, spelt at once where the ids of all are known and make UTF-8."""
    one, (spelt, lead) = _id_decoder(path, threads), _spelling(path, threads)
    table = pa.array(spelt, pa.large_binary())

    def texts(ids: np.ndarray, ends: np.ndarray) -> list[str]:
        if len(ids) and 0 <= ids.min() and ids.max() < len(spelt):
            out = table.take(pa.array(ids))
            at, data = np.frombuffer(out.buffers()[1], np.int64)[ends].tolist(), memoryview(out.buffers()[2] or b"")
            try:
                return [str(data[a:z], "utf-8").removeprefix(lead) for a, z in zip(at[:-1], at[1:])]
            except UnicodeDecodeError:
                pass
        return [one(ids[a:z]) for a, z in zip(ends[:-1], ends[1:])]
    return texts


def _encoded(batches, path: str, threads: int) -> Iterator[pa.RecordBatch]:
    encode = _id_encoder(path, threads)
    for b in T.small_batches(batches):
        ids = encode([t or "" for t in b.column("text").to_pylist()])
        ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").cast(pa.int64()), b.column("text").cast(pa.string()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))], ["doc_id", "text", "ids"])


def _decoded(batches, path: str, threads: int) -> Iterator[pa.RecordBatch]:
    texts = _rows_decoder(path, threads)
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts(*_id_lists(b.column("ids"))), pa.string())], [*b.schema.names, "decoded"])


def _compared(batches, path: str, threads: int) -> Iterator[pa.RecordBatch]:
    import sentencepiece
    check = sentencepiece.SentencePieceProcessor(model_file=path)
    for b in batches:
        flat, ends = _id_lists(b.column("ids"))
        raw = flat.astype("<u4").tobytes()
        ids = [raw[4 * a:4 * z] for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]
        want = check.encode([t or "" for t in b.column("text").to_pylist()], num_threads=threads)
        want_back = check.decode(want, num_threads=threads)
        crc = [zlib.crc32(i) for i in ids]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64()),
             pa.array([i == array("I", w).tobytes() for i, w in zip(ids, want)], pa.bool_()),
             pa.array([a == w for a, w in zip(b.column("decoded").to_pylist(), want_back)]),
             b.column("ids"), b.column("decoded")],
            ["doc_id", "n_tokens", "ids_crc32", "ids_agree", "decoded_agrees", "ids", "decoded"])


def encode(docs: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """doc_id, text and the text's ids (array<int>) of every row."""
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _encoded(batches, path, threads), "doc_id long, text string, ids array<int>")


def decode(ids: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """The rows of ``ids`` with the text that their ids (array<int>) stand for, in the column ``decoded``."""
    rest = ids.drop("decoded")
    return rest.mapInArrow(lambda batches: _decoded(batches, path, threads),
                           StructType([*rest.schema.fields, StructField("decoded", StringType())]))


def encode_documents(docs: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """doc_id, the counts, checksum and parity derived from ids and decoded text, and both of these.

    ``encode``, ``decode`` and the comparison in one pass, so a task holds one tokenizer.
    """
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _compared(_decoded(_encoded(batches, path, threads), path, threads), path, threads),
        "doc_id long, n_tokens long, ids_crc32 long, ids_agree boolean, decoded_agrees boolean, ids array<int>, decoded string")


def op4_sentencepiece(spark, sf_dir):
    import public_tokenizers
    return encode_documents(T.documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
