"""Conversation structure repair by a run-length dynamic programme.

A conversation is well formed if its roles start with s?(ua)+ (system, then user and
assistant in turn) or if it is empty. Each row may be kept, get the role user or
assistant, or be deleted, and empty rows may be put in anywhere; blank rows and
duplicates have to go. Of the cheapest edits those are taken whose letters in order are
least (D < I < K < R).

The programme. A row matters only by its symbol (first letter of the role, fault), and a
symbol is a 4 x 4 min-plus matrix over the states of the pattern. Equal symbols in a row
are a run, and a run of n is passed by the binary powers of its matrix, which are cached.
Costs to go at the ends of runs come from these, and then choices are unrolled forward
within each run, from a cached table of (symbol, costs to go).

In Spark. Equal rows of one turn are one row with a count, and seen-before is an
aggregate joined back, so neither needs a conversation in one task. The rows are then
ranged by (conversation, turn, role, text), so that a conversation of any size spans
many tasks and a task holds at most its own range. The product of the matrices of a
range's first and last conversation is all that the driver gets (two rows a range); it
sends back the costs to go at the end of each range and then the state at its start.

Nulls are read as one space, but a null conv_id is a conversation of its own and null
turns come first. Rows of one turn stand by role and by SHA-256 of the text, copies side
by side. Roles other than the three cannot be kept. Repeated rows, empty and very long
texts are rows like others; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmatch.llm import textcols as T
from shelfmatch.session import materialize

#: Costs of the edits, and of keeping a truncated row.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLANK, DUPLICATE, CUT, FINE = "blank", "duplicate", "truncated", ""

#: States: nothing yet, after s, after u, after a. The next letter, and the state after it.
START, S, U, A = range(4)
ROLE = ("user", "user", "assistant", "user")
AFTER = (U, U, A, U)
INF = 1 << 60
END = (0, 2 * INSERT, INSERT, 0)
GONE = ("", "gone")


def moves(symbol: tuple, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) of a row in the order of the letters, insertion apart."""
    letter, fault = symbol
    yield "D", DELETE, state
    if symbol != GONE:
        more = TRUNCATED if fault == CUT else 0
        if letter == ROLE[state][0]:
            yield "K", more, AFTER[state]
        elif letter == "s" and state == START:
            yield "K", more, S
        yield "R", REROLE + more, AFTER[state]


def with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs to go when rows may first be put in (two do: a third comes back to a state)."""
    for _ in range(2):
        costs = [min(costs[q], INSERT + costs[AFTER[q]]) for q in range(4)]
    return tuple(costs)


@lru_cache(maxsize=4096)
def choices(symbol: tuple, after: tuple) -> tuple[tuple[int, ...], tuple]:
    """Costs before a row from those after it, and (letters, state) to take from each state."""
    before = with_inserts([min(c + after[p] for _, c, p in moves(symbol, q)) for q in range(4)])
    table = []
    for q in range(4):
        letters, state = "", q
        while True:
            options = [(e, p) for e, c, p in moves(symbol, state) if c + after[p] == before[state]]
            if INSERT + before[AFTER[state]] == before[state]:
                options.append(("I", AFTER[state]))
            edit, state = min(options)
            letters += edit
            if edit != "I":
                break
        table.append((letters, state))
    return before, tuple(table)


def product(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def applied(a: tuple, costs: tuple) -> tuple[int, ...]:
    return tuple(min(a[q][p] + costs[p] for p in range(4)) for q in range(4))


@lru_cache(maxsize=4096)
def power(symbol: tuple, bit: int) -> tuple:
    """The symbol's matrix to the power 2 ** bit (insertions stand before a row)."""
    if bit:
        half = power(symbol, bit - 1)
        return product(half, half)
    columns = [with_inserts([min((c for _, c, p in moves(symbol, q) if p == goal), default=INF) for q in range(4)]) for goal in range(4)]
    return tuple(tuple(min(columns[j][i], INF) for j in range(4)) for i in range(4))


def powers(symbol: tuple, n: int) -> Iterator[tuple]:
    for bit in range(n.bit_length()):
        if n >> bit & 1:
            yield power(symbol, bit)


def symbols(rows: Iterable[dict]) -> Iterator[tuple]:
    """(symbol, count) of counted rows: further copies of a row are duplicates or blank."""
    for r in rows:
        letter = r["role"][:1]
        first = GONE if r["fault"] in (BLANK, DUPLICATE) else (letter if letter in ("s", "u", "a") else "", r["fault"])
        if first == GONE:
            yield GONE, r["n"]
        else:
            yield first, 1
            if r["n"] > 1:
                yield GONE, r["n"] - 1


def runs(rows: Iterable[dict]) -> list[tuple]:
    return [(s, sum(n for _, n in group)) for s, group in groupby(symbols(rows), key=lambda x: x[0])]


def matrix(of: list[tuple]) -> tuple:
    out = tuple(tuple(0 if i == j else INF for j in range(4)) for i in range(4))
    for symbol, n in of:
        for p in powers(symbol, n):
            out = tuple(tuple(min(x, INF) for x in line) for line in product(out, p))
    return out


def unrolled(of: list[tuple], end: tuple, state: int) -> Iterator[tuple[str, int]]:
    """(letters, state after) for each row that need not go, from costs to go at the end.

    A row that has to go is D at once: D is the least letter, and what is put in before it
    may as well be put in after it."""
    ends = []
    for symbol, n in reversed(of):
        ends.append(end)
        for p in powers(symbol, n):
            end = applied(p, end)
    for symbol, n in of:
        costs = ends.pop()
        if symbol == GONE:
            continue
        tables = []
        for _ in range(n):
            low = min(costs)
            before, table = choices(symbol, tuple(c - low for c in costs))
            costs = tuple(c + low for c in before)
            tables.append(table)
        for table in reversed(tables):
            letters, state = table[state]
            yield letters, state


EDITS = "conv_id long, part int, at long, turn long, role string, text string, fault string, edit string, repaired_role string, times long"


def edits(rows: list[dict], end: tuple, state: int, last: bool) -> Iterator[tuple]:
    """The rows of EDITS but for conv_id, part and at: what becomes of each row, in order.

    ``role`` is null for a row put in and ``repaired_role`` for one deleted; ``times`` counts equal rows."""
    steps = unrolled(runs(rows), end, state)
    for r in rows:
        more = r["n"]
        if r["fault"] not in (BLANK, DUPLICATE):
            letters, after = next(steps)
            for edit in letters:
                if edit == "I":
                    yield None, None, "", FINE, "I", ROLE[state], 1
                    state = AFTER[state]
                else:
                    new = {"D": None, "K": r["role"], "R": ROLE[state]}[edit]
                    yield r["turn"], r["role"], r["text"], r["fault"], edit, new, 1
            state, more = after, more - 1
        if more:
            yield r["turn"], r["role"], r["text"], BLANK if r["fault"] == BLANK else DUPLICATE, "D", None, more
    while last and END[state]:
        yield None, None, "", FINE, "I", ROLE[state], 1
        state = AFTER[state]


class Digest:
    """Counts, audit and hash of one conversation from the rows of EDITS in order."""

    def __init__(self):
        self.faults = dict.fromkeys((BLANK, DUPLICATE, CUT, FINE), 0)
        self.low = self.turn = self.role = None
        self.turns = self.illegal = self.cost = 0
        self.audit, self.hash, self.begun = [], hashlib.sha256(), False

    def add(self, turn, role, text, fault, edit, repaired_role, times) -> None:
        self.audit.append(edit * times)
        if role is not None:
            self.faults[fault] += times
            if self.role is not None and self.role[:1] + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.illegal += times - 1
            self.role = role
            if turn is not None and turn != self.turn:
                self.turns, self.turn = self.turns + 1, turn
                self.low = turn if self.low is None else self.low
        self.cost += times * {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit] + (TRUNCATED if edit in "KR" and fault == CUT else 0)
        if edit != "D":
            self.hash.update(f"{chr(10) if self.begun else ''}{repaired_role}:{text}".encode())
            self.begun = True

    def row(self) -> tuple:
        gaps = self.turn - self.low + 1 - self.turns if self.turns else 0
        return (gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


DIGESTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _chunks(batches) -> Iterator[tuple]:
    """(conv_id, part, rows) of each conversation's rows in a range."""
    rows = (r for b in batches for r in b.to_pylist())
    for key, group in groupby(rows, key=lambda r: (r["conv_id"], r["part"])):
        yield *key, list(group)


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in ddl.split(", ")])


def counted(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """The rows in ranges: conv_id, turn, role, text, n (equal rows), fault, part; nulls read as one space.

    ``copies`` names a column that says how often each row stands there."""
    space = F.lit(" ")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
                       (F.col(copies) if copies else F.lit(1)).cast("long").alias("n"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("name", F.sha2("text", 256))
    first = rows.groupBy("conv_id", "role", "name").agg(F.min(F.struct("turn")).alias("first"))
    first = first.select(F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("name").alias("named"), "first")
    rows = rows.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("name") == F.col("named")))
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.struct("turn") > F.col("first"), DUPLICATE)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(FINE))
    order = ["conv_id", "turn", "role", "name"]
    rows = rows.select(*order, "text", "n", fault.alias("fault")).repartitionByRange(T.shuffle_tasks(rows.sparkSession), *order)
    return materialize(rows.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).drop("name"))


def boundaries(ranged: DataFrame) -> dict[int, tuple]:
    """part -> (state at its start, costs to go at its end, whether its first and its last conversation go on over the border)."""
    def ends(batches):
        first = last = None
        n = 0
        for conv, part, rows in _chunks(batches):
            n, last = n + 1, (conv, part, runs(rows))
            first = first or last
        if n:
            found = [(first[1], n, first[0], last[0], [x for m in matrix(first[2]) for x in m], [x for m in matrix(last[2]) for x in m])]
            yield from _batches(found, schema)

    ddl = "part int, convs long, first long, last long, opening array<long>, closing array<long>"
    schema = _schema(ddl)
    parts = sorted(ranged.mapInArrow(ends, ddl).collect(), key=lambda r: r["part"])     # two conversations a range
    goes_on = [a["last"] == b["first"] for a, b in zip(parts, parts[1:])] + [False]
    to_go: dict[int, tuple] = {}
    ahead = END
    for r, on in zip(reversed(parts), reversed(goes_on)):
        to_go[r["part"]] = ahead if on else END
        opening = tuple(tuple(r["opening"][4 * i:4 * i + 4]) for i in range(4))
        ahead = applied(opening, to_go[r["part"]] if r["convs"] == 1 else END)

    open_parts = {r["part"]: to_go[r["part"]] for r, on in zip(parts, goes_on) if on}

    def states(batches):
        last = None
        for _, part, rows in _chunks(batches):
            last = (part, rows)
        if last:
            of = runs(last[1])
            out = [(list(unrolled(of, open_parts[last[0]], q)) or [("", q)])[-1][1] for q in range(4)]
            yield from _batches([(last[0], out)], _schema("part int, after array<long>"))

    crossing = ranged.where(F.col("part").isin(list(open_parts))) if open_parts else None
    after = {r["part"]: r["after"] for r in crossing.mapInArrow(states, "part int, after array<long>").collect()} if open_parts else {}
    out, state, came = {}, START, False
    for r, on in zip(parts, goes_on):
        out[r["part"]] = (state, to_go[r["part"]], came, on)
        state, came = (after[r["part"]][state if r["convs"] == 1 else START], True) if on else (START, False)
    return out


def _edited(batches, known: dict) -> Iterator[tuple]:
    """(conv_id, part, whether the conversation is whole in the range, its edits) by conversation."""
    chunks = _chunks(batches)
    held, opening = next(chunks, None), True
    while held:
        following = next(chunks, None)
        conv, part, rows = held
        state, to_go, came, on = known[part]
        came, on = came and opening, on and following is None
        yield conv, part, not (came or on), edits(rows, to_go if on else END, state if came else START, not on)
        held, opening = following, False


def repair(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """The rows of EDITS: every row with its fault and edit, and the rows put in, ordered by (part, at) in a conversation."""
    ranged = counted(rows, copies)
    return _repaired(ranged, boundaries(ranged), crossing_only=False)


def _repaired(ranged: DataFrame, known: dict, crossing_only: bool) -> DataFrame:
    shared = ranged.sparkSession.sparkContext.broadcast(known)     # one entry a range

    def run(batches):
        found = ((conv, part, k, *e) for conv, part, whole, own in _edited(batches, shared.value) if not (crossing_only and whole)
                 for k, e in enumerate(own))
        yield from _batches(found, _schema(EDITS), 512)

    return ranged.mapInArrow(run, EDITS)


def digests(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """The rows of DIGESTS: one per conversation that has rows.

    A conversation within a range is read there; one over several goes to one task, in order and row by row, as its
    hash is one sequence."""
    ranged = counted(rows, copies)
    known, spark = boundaries(ranged), ranged.sparkSession
    shared = spark.sparkContext.broadcast(known)

    def within(batches):
        def found():
            for conv, _, whole, own in _edited(batches, shared.value):
                if whole:
                    digest = Digest()
                    for e in own:
                        digest.add(*e)
                    yield conv, *digest.row()
        yield from _batches(found(), _schema(DIGESTS), 512)

    def across(batches):
        def found():
            for conv, own in groupby((r for b in batches for r in b.to_pylist()), key=lambda r: r["conv_id"]):
                digest = Digest()
                for r in own:
                    digest.add(*list(r.values())[3:])
                yield conv, *digest.row()
        yield from _batches(found(), _schema(DIGESTS), 512)

    out = ranged.mapInArrow(within, DIGESTS)
    if any(came or on for _, _, came, on in known.values()):
        over = _repaired(ranged, known, crossing_only=True).repartition(T.shuffle_tasks(spark), "conv_id")
        out = out.unionByName(over.sortWithinPartitions("conv_id", "part", "at").mapInArrow(across, DIGESTS))
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of a table with one in twenty each dropped, emptied, cut short, repeated (``copies``) or said by the user."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.when(F.col("fate") == 3, 2).otherwise(1).alias("copies"))


def op13_structure_repair(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = digests(damaged(conversations), "copies").withColumnRenamed("conv_id", "of")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


SQL = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM range(256) r(i))),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS name FROM conversations),
fated AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i, 1))::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c // 256)), 4294967295) % 20 AS fate FROM named, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM fated WHERE fate <> 0),
lined AS (
  SELECT *, row_number() OVER o AS i, lag(role) OVER o AS prior,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
  FROM hurt WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
judged AS (
  SELECT *, substr(role, 1, 1) AS letter, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM lined),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (prior IS NOT NULL AND substr(prior, 1, 1) || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
following(q, next, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
put_in(q, p, cost, letters, rows) AS (VALUES
  (0, 0, 0, '', []::VARCHAR[]), (0, 2, {INSERT}, 'I', ['user:']), (0, 3, {2 * INSERT}, 'II', ['user:', 'assistant:']), (1, 1, 0, '', []),
  (1, 2, {INSERT}, 'I', ['user:']), (1, 3, {2 * INSERT}, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []), (2, 3, {INSERT}, 'I', ['assistant:']),
  (3, 3, 0, '', []), (3, 2, {INSERT}, 'I', ['user:'])),
taken AS (
  SELECT j.conv_id, j.i, q, q AS p, {DELETE} AS cost, 'D' AS letter, []::VARCHAR[] AS rows FROM judged j, following
  UNION ALL
  SELECT j.conv_id, j.i, q, CASE WHEN j.letter = 's' THEN 1 ELSE next END, CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END, 'K', [j.role || ':' || text]
  FROM judged j, following f WHERE fault NOT IN ('blank', 'duplicate') AND (j.letter = f.role[1] OR j.letter = 's' AND q = 0)
  UNION ALL
  SELECT j.conv_id, j.i, q, next, {REROLE} + CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END, 'R', [f.role || ':' || text]
  FROM judged j, following f WHERE fault NOT IN ('blank', 'duplicate')),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS rows FROM facts
  UNION ALL
  SELECT conv_id, i, q, cost, audit, rows FROM (
    SELECT b.conv_id, b.i + 1 AS i, t.p AS q, b.cost + x.cost + t.cost AS cost, b.audit || x.letters || t.letter AS audit, b.rows || x.rows || t.rows AS rows
    FROM best b JOIN put_in x ON x.q = b.q JOIN taken t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.i = b.i + 1 AND t.q = x.p)
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
done AS (
  SELECT b.conv_id, b.cost + x.cost AS cost, b.audit || x.letters AS audit, b.rows || x.rows AS rows
  FROM best b JOIN facts f ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.i = f.n JOIN put_in x ON x.q = b.q AND x.p IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + x.cost, b.audit || x.letters) = 1)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(rows, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN facts f ON e.conv_id IS NOT DISTINCT FROM f.conv_id
  LEFT JOIN done d ON e.conv_id IS NOT DISTINCT FROM d.conv_id
"""
