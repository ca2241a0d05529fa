"""Whole Arrow text columns as flat numpy arrays: words, word hashes, helpers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Texts are
handled a few megabytes at a time; nothing is done per word in Python.
"""

from __future__ import annotations

import struct
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

SLICE_BYTES = 2 << 20
UNIT_BYTES = 128 << 20   # ids of units that a worker keeps, about
NULL_ID = -(1 << 63)
U64 = np.uint64


@dataclass
class Words:
    data: np.ndarray      # bytes of all texts of the slice, end to end
    offsets: np.ndarray   # text i is data[offsets[i]:offsets[i + 1]]
    start: np.ndarray     # byte range of each word
    end: np.ndarray
    first: np.ndarray     # words of text i are first[i]:first[i + 1]

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of the 64-bit integers (shift-xor-multiply rounds)."""
    x = x + U64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def small_batches(batches, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that their texts have about ``limit`` bytes (a longer text stays whole)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.array(pc.fill_null(pc.binary_length(b.column(text)), 0), dtype=np.int64)
        part = (np.cumsum(size) - size) // limit
        cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, b.num_rows]
        for a, z in zip(cuts[:-1], cuts[1:]):
            yield b.slice(int(a), int(z - a))


class UnitIds(dict):
    """Ids of units of text, as little-endian 32-bit numbers, each unit encoded once.

    A unit is a part that a tokenizer encodes on its own, whatever stands beside it. What is
    kept is bounded: at ``limit`` bytes the units are forgotten and encoded anew.
    """

    def __init__(self, encode: Callable[[str], list[int]], limit: int = UNIT_BYTES):
        super().__init__()
        self.encode, self.limit, self.held = encode, limit, 0

    def __missing__(self, unit: str) -> bytes:
        ids = self.encode(unit)
        out = struct.pack(f"<{len(ids)}I", *ids)
        self.held += 150 + 4 * len(unit) + len(out)
        if self.held > self.limit:
            self.clear()
            self.held = 0
        else:
            self[unit] = out
        return out

    def joined(self, units: Iterable[str]) -> bytes:
        return b"".join(map(self.__getitem__, units))


def split_words(col: pa.Array, lower: bool = False) -> Words:
    """Words of a string column (null: no words); ``lower`` maps A-Z only."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    lens = np.array(pc.binary_length(col), dtype=np.int64)
    offsets = np.r_[0, np.cumsum(lens)]
    data = np.frombuffer("".join(col.to_pylist()).encode(), dtype=np.uint8)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    opens, closes = inside.copy(), inside.copy()
    if len(data):
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        cut = offsets[(offsets > 0) & (offsets < len(data))]
        opens[cut] = inside[cut]
        closes[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(opens)
    return Words(data, offsets, start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets))


def _odd(seed: int) -> int:
    return int(mix(np.array([seed], dtype=U64), 77)[0]) | 1


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of each range of bytes (or of 64-bit names), by prefix sums."""
    base = _odd(seed)
    inv = pow(base, -1, 2**64)
    n = len(data)
    powers, back = np.full(n + 1, base, dtype=U64), np.full(n + 1, inv, dtype=U64)
    powers[0] = back[0] = 1
    powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(mix(data.astype(U64), seed) * powers[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(U64), seed + 1)


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, index of its first word) of every ``size``-word window."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[doc]
    return doc, at


def per_doc(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` (one value per word) within each text."""
    total = np.r_[0, np.cumsum(flags)]
    return total[first[1:]] - total[first[:-1]]


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_tasks(spark) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def crc_of_id(col):
    """crc32 of an id written as text (null id: of the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def spans(label: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of each stretch of equal values."""
    cuts = np.flatnonzero(np.diff(label)) + 1
    return list(zip(np.r_[0, cuts], np.r_[cuts, len(label)])) if len(label) else []


def scratch(spark, name: str) -> str:
    """A new folder for written tables, in the shared folder that the cluster names.

    Without one, a local session gets a temporary folder and a cluster is refused."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="shelfmatch-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
