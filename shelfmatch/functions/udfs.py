"""Arrow (pandas) UDFs for the scores Spark has no expression for (SIM-7, SIM-9, SIM-10, exact SC-10).

They run on Arrow batches of already-pruned candidate pairs (R6), never on
the full cross product. Per-row work is a small helper each.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType


def damerau_levenshtein_distance(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance (adjacent swaps may be edited again).

    One row of the table at a time, as numpy vectors over the shorter text: memory is
    linear in it. A swap of cost one on one side needs, per column, either the cell
    before the last row that held the column's character (``before_match``), or the row
    two above at the last match in this row; swaps with edits on both sides never beat
    these. The insertion chain is a prefix minimum (``min_j' (T[j'] - j') + j``).
    """
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    ac, bc = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.int32) for t in (a, b))
    n, far = len(b), 1 << 29
    col = np.arange(1, n + 1, dtype=np.int32)
    two_up, up = np.full(n + 1, far, dtype=np.int32), np.arange(n + 1, dtype=np.int32)
    before_match, last_row = np.full(n, far, dtype=np.int32), np.full(n, -far, dtype=np.int32)
    for i, x in enumerate(ac, 1):
        same = bc == x
        cost = np.minimum(up[:-1] + ~same, up[1:] + 1)
        match = np.maximum.accumulate(np.where(same, col, 0))
        match = np.r_[np.int32(0), match[:-1]]                      # last matching column before this one
        beside = ~same & (match == col - 1) & (match > 0)
        cost = np.where(beside, np.minimum(cost, before_match + (i - last_row)), cost)
        above = ~same & (last_row == i - 1) & (match > 0)
        cost = np.where(above, np.minimum(cost, two_up[np.maximum(match - 1, 0)] + (col - match)), cost)
        row = np.minimum.accumulate(np.r_[np.int32(i), cost - col])
        row[1:] += col
        before_match = np.where(same, np.r_[np.int32(far), up[:-2]] if n > 1 else np.int32(far), before_match)
        last_row[same] = i
        two_up, up = up, row
    return int(up[-1])


#: Table cells (pairs x padded shorter length) that one step of the batch kernel handles: its arrays stay in the processor's cache.
STEP_CELLS = 1 << 15
#: Up to this joint length the terms of a cell fit into 16 bits.
FAR16 = 6500


def damerau_levenshtein_batch(a: list[str], b: list[str]) -> np.ndarray:
    """Unrestricted Damerau-Levenshtein of many pairs at once.

    Same recurrence as :func:`damerau_levenshtein_distance`, one anti-diagonal d = i + j of all pairs at a time: cells of one
    diagonal depend on the three before it only. Row i keeps twice the sum i + l of its last match in column l and the value
    two up and one left of it, less the sum; column j so its last match in row k and the value one up and two left. A swap
    with edits on one side costs such a value and the steps to here if the other match is right beside or above; if that is
    s steps off, 2 s more are added, which is no less than the swap with edits on both sides, as neighbouring cells
    differ by at most one. Rows and columns are padded with codes that match nothing, which cannot change a pair's own
    cell (len a, len b). Memory is linear in the padded lengths.
    """
    count = len(a)
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    total = np.array([len(x) + len(y) for x, y in pairs], dtype=np.int64)
    order = np.argsort(-total, kind="stable")          # pairs that are done leave from the end
    total, pairs = total[order], [pairs[i] for i in order]
    short = np.array([len(x) for x, _ in pairs], dtype=np.int64)
    m, n = int(short.max(initial=0)), max((len(y) for _, y in pairs), default=0)
    far = m + n + 2                                    # above any distance; terms stay below five times this
    kind = np.int16 if far <= FAR16 else np.int32
    x, y = (_codes([p[side] for p in pairs], width, fill) for side, width, fill in ((0, m, -1), (1, n, -2)))
    known, flat = np.unique(np.concatenate((x.ravel(), y.ravel())), return_inverse=True)
    flat = flat.astype(np.uint16 if len(known) < 1 << 16 else np.int32)
    rows = np.ascontiguousarray(flat[:x.size].reshape(x.shape).T)                      # row i at i - 1
    columns = np.ascontiguousarray(flat[x.size:].reshape(y.shape)[:, ::-1].T)          # column j at n - j
    now, one, two, three = (np.full((m + 2, count), far, dtype=kind) for _ in range(4))      # H[i] at i + 1
    one[1] = 0
    row_at, row_cost = np.full((m, count), -far, dtype=kind), np.full((m, count), far, dtype=kind)
    col_at, col_cost = np.full((n, count), -far, dtype=kind), np.full((n, count), far, dtype=kind)
    equal, match, other = (np.empty((m, count), dtype=t) for t in (bool, kind, kind))
    out = np.zeros(count, dtype=np.int64)
    live = int(np.count_nonzero(total))
    for d in range(1, int(total.max(initial=0)) + 1):
        lo, hi = max(1, d - n), min(m, d - 1)
        if d <= n:
            now[1] = d
        if d <= m:
            now[d + 1] = d
        if d < m:
            now[d + 2] = far
        if lo <= hi:
            size = hi - lo + 1
            r, c = slice(lo - 1, hi), slice(n - d + lo, n - d + hi + 1)
            h, same, o = now[lo + 1:hi + 2, :live], match[:size, :live], other[:size, :live]
            at_r, cost_r, at_c, cost_c = row_at[r, :live], row_cost[r, :live], col_at[c, :live], col_cost[c, :live]
            np.multiply(np.equal(rows[r, :live], columns[c, :live], out=equal[:size, :live]), kind(-1), out=same)      # all bits where the texts match
            np.minimum(one[lo:hi + 1, :live], one[lo + 1:hi + 2, :live], out=h)
            np.minimum(h, np.add(two[lo:hi + 1, :live], same, out=o), out=h)
            h += kind(1)
            for at, value in ((at_r, cost_c), (at_c, cost_r)):
                np.subtract(value, at, out=o)
                o += kind(3 * d - 2)
                np.minimum(h, o, out=h)
            for state, value in ((at_r, None), (at_c, None), (cost_r, three[lo - 1:hi, :live]), (cost_c, three[lo:hi + 1, :live])):
                if value is None:
                    np.bitwise_xor(state, kind(2 * d), out=o)
                else:
                    np.bitwise_xor(state, np.subtract(value, kind(d), out=o), out=o)
                o &= same
                state ^= o
        ended = int(np.searchsorted(-total, -d))
        if ended < live:
            out[order[ended:live]] = now[short[ended:live] + 1, np.arange(ended, live)]
            live = ended
        now, one, two, three = three, now, one, two
    return out


def damerau_many(a: list, b: list) -> list:
    """Distances for a list of pairs (None where either side is None).

    Pairs are sorted by length so a batch pads little, and cut into batches
    of at most ``STEP_CELLS`` cells of a diagonal.
    """
    out: list = [None] * len(a)
    todo = [(min(len(x), len(y)), max(len(x), len(y)), i) for i, (x, y) in enumerate(zip(a, b)) if x is not None and y is not None]
    todo.sort(key=lambda p: (p[0].bit_length(), p[0] * 8 >> p[0].bit_length(), p[1]))
    start = 0
    while start < len(todo):
        end, widest = start, 1
        while end < len(todo):
            widest = max(widest, todo[end][0])
            if end > start and (end - start + 1) * widest > STEP_CELLS:
                break
            end += 1
        part = [i for _, _, i in todo[start:end]]
        for i, d in zip(part, damerau_levenshtein_batch([a[i] for i in part], [b[i] for i in part])):
            out[i] = int(d)
        start = end
    return out


#: Cells (pairs x padded length) that one block of the subsequence kernel compares at a step.
LCS_CELLS = 1 << 20
FULL = np.uint64(2**64 - 1)


def common_subsequences(a: list[str | None], b: list[str | None]) -> list[int | None]:
    """Length of the longest common subsequence of each pair (None if a side is None).

    Bit-parallel over blocks of pairs of similar length: a pair's column of the
    dynamic programme is a row of 64-bit words, a 0 bit where it grows; a character of
    the other side updates all pairs at once, with the carry handed from word to word.
    """
    out: list[int | None] = [None] * len(a)
    pairs = [(x, y, i) if len(x) <= len(y) else (y, x, i) for i, (x, y) in enumerate(zip(a, b)) if x is not None and y is not None]
    for x, y, i in pairs:
        out[i] = 0
    pairs = sorted((p for p in pairs if p[0]), key=lambda p: (-(-len(p[0]) // 64), len(p[1])))
    start = 0
    while start < len(pairs):
        words = -(-len(pairs[start][0]) // 64)
        room = max(1, LCS_CELLS // (words * 64))
        end = start + 1
        while end < min(len(pairs), start + room) and -(-len(pairs[end][0]) // 64) == words and len(pairs[end][1]) <= 2 * len(pairs[start][1]) + 64:
            end += 1
        block = pairs[start:end]
        for (_, _, i), n in zip(block, _lcs_block([x for x, _, _ in block], [y for _, y, _ in block], words)):
            out[i] = int(n)
        start = end
    return out


def _codes(texts: list[str], width: int, fill: int) -> np.ndarray:
    out = np.full((len(texts), width), fill, dtype=np.int32)
    for row, t in zip(out, texts):
        row[:len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.int32)
    return out


def _lcs_block(short: list[str], long: list[str], words: int) -> np.ndarray:
    x, y = _codes(short, words * 64, -1), _codes(long, max(map(len, long)), -2)
    v = np.full((len(short), words), FULL)
    for column in y.T:
        match = np.packbits(x == column[:, None], axis=1, bitorder="little").view(np.uint64)
        used = v & match
        total = v + used
        over = total < v
        carry = over[:, 0]
        for w in range(1, words):
            full = total[:, w] == FULL
            total[:, w] += carry
            carry = over[:, w] | (full & carry)
        v = total | (v & ~match)
    # Positions beyond a text never match, so their bits stay 1.
    return words * 64 - np.bitwise_count(v).sum(axis=1).astype(np.int64)


@F.pandas_udf(LongType())
def damerau(a: pd.Series, b: pd.Series) -> pd.Series:
    """SIM-7 on Arrow batches: short pairs vectorised across the batch."""
    return pd.Series(damerau_many(a.tolist(), b.tolist()), dtype="Int64")


@F.pandas_udf(LongType())
def common_subsequence(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence (SIM-9, SIM-10), across the pairs of an Arrow batch."""
    return pd.Series(common_subsequences(a.tolist(), b.tolist()), dtype="Int64")


@F.pandas_udf(StringType())
def fold_exact(s: pd.Series) -> pd.Series:
    """Exact SC-10 reference path: NFKD, then drop non-ASCII (no lower-casing)."""
    return s.map(lambda x: None if x is None else
                 unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode("ascii"))
