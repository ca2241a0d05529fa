"""Mixing sources to target weights by Sainte-Laguë apportionment of word blocks.

Targets. Sources weigh 5, 2, 1, 5, ... by code point (null last) and share the words of
all documents; a target stops at REPEATS times its source and the excess goes to the
others by weight, until none is above.

Blocks. The words of a source, its documents in a seeded order end to end, are cut into
blocks of about BLOCK_WORDS words, equal within a source to one word.

Quotas. Seats go to sources one by one, to the highest quotient v / (2 i + 1) of a source
with v = its target in blocks and i seats so far; as many seats are given as the divisor 1
gives. Each shard takes an equal run of the seats (one more or less), so its integer quotas
follow the targets too. The seats are never listed: up to the end of a shard, the counts of
S sources lie between two divisors and leave about 2 S seats open, which one sort settles.

Blocks to seats. Seat i of a source holds block number ``order^-1(i mod blocks)``, where
``order`` is a seeded permutation (multiplier prime to the number of blocks, and offset),
so every block is taken once before one is taken again, and none more than REPEATS times.
Which words a document gives is arithmetic on its place in the source, found by running
totals over ranges of (source, seeded order): a source of any size spans many tasks.
The only table in one task is that of the sources, one row each.

Null texts have no words, a null source is a source, ids may be null or repeat (equal
rows are told apart by their place in the input), documents without words give none and
an empty table gives no rows. Other columns are not read but for those to be carried.
Equal input files give equal rows; a long text is a sum over its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfmatch.llm import textcols as T
from shelfmatch.operators.rank import running_total

WEIGHTS, REPEATS = (5, 2, 1), 3
BLOCK_WORDS, SHARDS, SEED = 32, 16, 7
#: Primes for the seeded order; the first that does not divide the number of blocks serves.
PRIMES = (1000003, 1000033, 1000037, 1000039)


def seeded(seed: int, value: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit(""))))


def sized(docs: DataFrame, seed: int, carry: Sequence[str] = ()) -> DataFrame:
    """source, doc_id, size, ``carried`` columns and the seeded order (``draw``, ``size``, ``text_name``, ``row``)."""
    text = F.col("text").cast("string")
    carried = F.struct(*carry) if carry else F.lit(None).cast("boolean")
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("text_name"), carried.alias("carried"), text.alias("text"))

    def count_words(batches):
        for b in T.small_batches(batches):
            size = np.diff(T.split_words(b.column("text")).first)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(size, pa.int64())], [*b.schema.names[:4], "size"])

    rows = rows.mapInArrow(count_words, StructType([*rows.schema.fields[:4], StructField("size", LongType())]))
    return rows.withColumn("draw", seeded(seed, F.col("doc_id"))).withColumn("row", F.monotonically_increasing_id())


def targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, place (in code point order), source_size, weight, target: one row per source."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = s.withColumn("place", place).withColumn("weight", weight).withColumn("cap", F.col("source_size") * repeats)
    every, filling = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("weight"), "place")
    s = (s.withColumn("at", F.row_number().over(filling)).withColumn("all", F.sum("source_size").over(every))
         .withColumn("left", F.col("all") - F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap"))
         .withColumn("sharing", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))))
    full = F.col("cap") * F.col("sharing") < F.col("weight") * F.col("left")
    s = s.withColumn("level", F.min(F.when(~full, F.struct("at", "left", "sharing"))).over(every))
    even = F.col("weight") * F.col("level.left") / F.col("level.sharing")
    return s.select("source", "place", "source_size", "weight", F.when(full, F.col("cap").cast("double")).otherwise(even).alias("target"))


def quotas(wanted: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The targets with ``blocks``, ``quota`` (seats), ``upto`` (seats up to each shard's end), and the seeded order."""
    size, blocks = F.col("source_size"), F.col("blocks")
    s = wanted.withColumn("blocks", F.when(size > 0, F.greatest(F.lit(1), F.expr(f"(2 * source_size + {block_words}) div {2 * block_words}"))).otherwise(F.lit(0)))
    s = s.withColumn("v", F.when(size > 0, F.col("target") * blocks / size).otherwise(F.lit(0.0)))
    s = s.withColumn("quota", F.floor(F.col("v") + 0.5).cast("long"))
    every, shard = Window.partitionBy(), Window.partitionBy("shard")
    s = (s.withColumn("seats", F.sum("quota").over(every)).withColumn("total", F.sum("v").over(every)).withColumn("n", F.count(F.lit(1)).over(every))
         .withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards)))))
    s = s.withColumn("due", F.expr(f"(seats * shard) div {shards}"))

    def bound(half: float, spare: int) -> Column:
        seats = F.floor(F.col("v") * (F.col("due") + half * F.col("n")) / F.col("total") + 0.5).cast("long") + spare
        return F.when(F.col("total") > 0, F.greatest(F.lit(0), F.least(seats, F.col("quota")))).otherwise(F.lit(0))

    s = s.withColumn("low", bound(-0.5, -1)).withColumn("high", bound(0.5, 1)).withColumn("open", F.col("due") - F.sum("low").over(shard))
    seat = F.when(F.col("high") > F.col("low"), F.sequence(F.col("low"), F.col("high") - 1))
    s = s.withColumn("seat", F.explode_outer(seat))
    best = shard.orderBy((F.col("v") / (2 * F.col("seat") + 1)).desc_nulls_last(), "place", "seat")
    won = F.col("seat").isNotNull() & (F.row_number().over(best) <= F.col("open"))
    s = s.withColumn("won", won.cast("long")).groupBy("source", "place", "source_size", "weight", "target", "blocks", "quota", "low", "shard").agg(F.sum("won").alias("won"))
    ends = F.sort_array(F.collect_list(F.struct("shard", (F.col("low") + F.col("won")).alias("end"))))
    s = s.groupBy("source", "place", "source_size", "weight", "target", "blocks", "quota").agg(ends.alias("ends"))
    step = F.coalesce(*[F.when(blocks % p != 0, F.lit(p)) for p in PRIMES])
    turn = F.conv(F.substring(seeded(seed, F.col("source")), 1, 8), 16, 10).cast("long")
    return s.select("source", "place", "source_size", "weight", "target", "blocks", "quota", F.col("ends.end").alias("upto"),
                    F.when(blocks > 0, step % blocks).alias("step"), F.when(blocks > 0, turn % blocks).alias("turn"))


#: Within a source's words: blocks of ``wide`` = size div blocks words, the first ``more`` one longer.
_WIDE, _MORE = "(source_size div blocks)", "(source_size % blocks)"


def _block_of(word: str) -> str:
    return (f"if({word} < {_MORE} * ({_WIDE} + 1), {word} div ({_WIDE} + 1), "
            f"{_MORE} + ({word} - {_MORE} * ({_WIDE} + 1)) div {_WIDE})")


def _from(block: str) -> str:
    return f"({block} * {_WIDE} + least({block}, {_MORE}))"


_SHARED = f"(least({_from('(k + 1)')}, upto_here) - greatest({_from('k')}, upto_here - size))"
_FIRST_SEAT = "((step * k + turn) % blocks)"
_COPIES = f"(quota div blocks + if({_FIRST_SEAT} < quota % blocks, 1, 0))"


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """Every document with its source's target and its own part of the mix.

    doc_id, source, size, source_size, target, taken, ``carried`` (a struct of the columns
    named in ``carry``) and ``pieces``: for each block that it has words in, the block, the
    first of its words there (from 0), how many, the block's words before them, and the
    (shard, seat) pairs that hold the block, none or more."""
    folder = T.scratch(docs.sparkSession, "mixing")
    sized(docs, seed, carry).write.parquet(f"{folder}/sizes")
    rows = docs.sparkSession.read.parquet(f"{folder}/sizes")
    plan = quotas(targets(rows), block_words, shards, seed)
    plan = plan.select(F.col("source").alias("of"), "source_size", "target", "blocks", "quota", "upto", "step", "turn")
    order = [F.col(c).asc() for c in ("draw", "size", "text_name", "row")]
    rows = running_total(rows, order, "size", "upto_here", ["source"])
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    held = f"if(size > 0, sequence({_block_of('(upto_here - size)')}, {_block_of('(upto_here - 1)')}), cast(array() as array<bigint>))"
    rows = rows.withColumn("held", F.expr(held))
    taken = F.expr(f"aggregate(held, 0L, (sum, k) -> sum + {_SHARED} * {_COPIES})")
    seats = (f"transform(if({_COPIES} > 0, sequence(0L, {_COPIES} - 1), cast(array() as array<bigint>)), "
             f"e -> struct(size(filter(upto, x -> x <= e * blocks + {_FIRST_SEAT})) as shard, e * blocks + {_FIRST_SEAT} as seat))")
    pieces = F.expr(f"transform(held, k -> struct(k as block, greatest({_from('k')} - (upto_here - size), 0L) as start, {_SHARED} as words, "
                    f"greatest(upto_here - size - {_from('k')}, 0L) as before, {seats} as seats))")
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "carried", pieces.alias("pieces"))


def mixed_texts(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: shard, source, seat, block, before, doc_id, start, words and text (words joined by one space).

    A seat holds one block: its rows by ``before`` are the documents that the block runs over."""
    rows = mix(docs, carry=("text",), **how).where(F.col("taken") > 0)
    words = F.regexp_extract_all("carried.text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = rows.select("source", "doc_id", words.alias("all"), F.explode("pieces").alias("p"))
    rows = rows.select("source", "doc_id", "all", "p", F.explode("p.seats").alias("s"))
    piece = F.array_join(F.slice("all", (F.col("p.start") + 1).cast("int"), F.col("p.words").cast("int")), " ")
    return rows.select("s.shard", "source", "s.seat", "p.block", "p.before", "doc_id", "p.start", "p.words", piece.alias("text"))


def op11_source_mixing(spark, sf_dir):
    return mix(T.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS cap, [5, 2, 1][place % 3 + 1]::BIGINT AS weight FROM s),
f AS (
  SELECT *, row_number() OVER o AS pos, (sum(source_size) OVER () - sum(cap) OVER o + cap)::BIGINT AS rest,
    sum(weight) OVER (ORDER BY cap / weight DESC, place DESC)::BIGINT AS sharing FROM w WINDOW o AS (ORDER BY cap / weight, place)),
g AS (SELECT *, cap * sharing < weight * rest AS is_full FROM f),
lvl AS (SELECT rest, sharing FROM g WHERE NOT is_full ORDER BY pos LIMIT 1),
t AS (
  SELECT source, place, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE weight * lvl.rest / lvl.sharing END AS target,
    CASE WHEN source_size > 0 THEN greatest(1, (2 * source_size + {BLOCK_WORDS}) // {2 * BLOCK_WORDS}) ELSE 0 END AS blocks
  FROM g, lvl),
q AS (
  SELECT *, floor(target * blocks / source_size + 0.5)::BIGINT AS quota, source_size // blocks AS wide, source_size % blocks AS more,
    CASE {' '.join(f'WHEN blocks % {p} <> 0 THEN {p}' for p in PRIMES)} END % blocks AS step,
    ('0x' || substr(md5(concat('{SEED}:', coalesce(source, ''))), 1, 8))::BIGINT % blocks AS turn FROM t WHERE source_size > 0),
r AS (
  SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY md5(concat('{SEED}:', coalesce(doc_id::VARCHAR, ''))), size
    ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM d),
a AS (SELECT *, upto - size AS lo, row_number() OVER () AS rid FROM r WHERE size > 0),
b AS (
  SELECT rid, lo, upto, quota, blocks, wide, more, step, turn, unnest(generate_series(
    CASE WHEN lo < more * (wide + 1) THEN lo // (wide + 1) ELSE more + (lo - more * (wide + 1)) // wide END,
    CASE WHEN upto - 1 < more * (wide + 1) THEN (upto - 1) // (wide + 1) ELSE more + (upto - 1 - more * (wide + 1)) // wide END)) AS k
  FROM a JOIN q ON a.source IS NOT DISTINCT FROM q.source),
taken AS (
  SELECT rid, sum((least((k + 1) * wide + least(k + 1, more), upto) - greatest(k * wide + least(k, more), lo))
    * (quota // blocks + CASE WHEN (step * k + turn) % blocks < quota % blocks THEN 1 ELSE 0 END))::BIGINT AS taken FROM b GROUP BY rid)
SELECT a.doc_id, size, source_size, target, taken FROM a JOIN taken USING (rid) JOIN t ON a.source IS NOT DISTINCT FROM t.source
UNION ALL
SELECT r.doc_id, size, source_size, target, 0::BIGINT FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source WHERE size = 0
"""
