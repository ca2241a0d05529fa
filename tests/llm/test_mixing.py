"""Source mixing against seats dealt one by one and blocks taken word by word."""
import random
import re
from collections import Counter, defaultdict

import pytest

from shelfmatch.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size long, target string, row int, held string"   # names that clash


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", 2, "y") for i, t, s in rows], SCHEMA)


def brute_targets(sizes):
    """By the words of the definition: cap, reshare the excess, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, total, fixed = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, sum(sizes.values()), {}
    while True:
        left, free = total - sum(fixed.values()), [s for s in order if s not in fixed]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: float(3 * sizes[s]) for s in over}


def brute_seats(values, order, seats):
    """Sources of the seats, highest quotient first."""
    have, out = Counter(), []
    for _ in range(seats):
        best = max(order, key=lambda s: (values[s] / (2 * have[s] + 1), -order.index(s)))
        out.append(best)
        have[best] += 1
    return out


def rows(seed=3):
    rng = random.Random(seed)
    text = lambda n: "".join(f"t{rng.randrange(50)}" + rng.choice([" ", "\n", "\t", "  "]) for _ in range(n))
    out = [(k, text(rng.randrange(0, 80)), rng.choice(["a", "a", "a", "a", "b", "B", "é", "c", None])) for k in range(260)]
    out += [(1000, text(4000), "a"), (1001, None, "a"), (1002, "", "b"), (1003, "\n \t", None), (None, "w1 w2 w3", "a"), (None, "w1 w2 w3", "a"),
            (None, "other words", "c"), (7, "again " * 40, "z"), (7, "again " * 40, "z"), (8, None, "empty")]
    return out


@pytest.mark.parametrize("block_words, shards", [(32, 16), (8, 3), (100000, 2)])
def test_targets_quotas_and_words(spark, block_words, shards):
    data = rows()
    docs = table(spark, data)
    sizes = Counter()
    for _, t, s in data:
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    plan = {r["source"]: r for r in mixing.quotas(mixing.targets(mixing.sized(docs, 7)), block_words, shards).collect()}
    assert {s: r["source_size"] for s, r in plan.items()} == dict(sizes)
    assert all(abs(plan[s]["target"] - want[s]) < 1e-6 for s in want)
    order = sorted(plan, key=lambda s: plan[s]["place"])
    values = {s: plan[s]["target"] * plan[s]["blocks"] / plan[s]["source_size"] if sizes[s] else 0.0 for s in order}
    seats = brute_seats(values, order, sum(r["quota"] for r in plan.values()))
    for j in range(shards):
        upto = Counter(seats[:len(seats) * (j + 1) // shards])
        assert {s: plan[s]["upto"][j] for s in order} == {s: upto[s] for s in order}
    got = mixing.mix(docs, block_words, shards).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((i, s, len(WORD.findall(t or ""))) for i, t, s in data)
    taken, blocks = Counter(), defaultdict(list)
    for r in got:
        assert r["taken"] == sum(p["words"] * len(p["seats"]) for p in r["pieces"]) <= 3 * r["size"]
        assert sum(p["words"] for p in r["pieces"]) == r["size"]
        taken[r["source"]] += r["taken"]
        for p in r["pieces"]:
            blocks[r["source"], p["block"]].append((p["before"], p["words"], tuple((s["shard"], s["seat"]) for s in p["seats"])))
    for (s, _), parts in blocks.items():                     # documents meet end to end, and share the block's seats
        parts.sort()
        assert len({x[2] for x in parts}) == 1 and [x[0] for x in parts] == [sum(x[1] for x in parts[:k]) for k in range(len(parts))]
        assert abs(sum(x[1] for x in parts) - sizes[s] / plan[s]["blocks"]) < 1
    held = Counter((s, seat) for (s, _), parts in blocks.items() for seat in parts[0][2])
    assert set(held.values()) <= {1} and {(s, x[1]) for s, x in held} == {(s, i) for s in order for i in range(plan[s]["quota"])}
    assert all(shard == sum(u <= seat for u in plan[s]["upto"]) for s, (shard, seat) in held)
    for s in order:                                          # half a block, and its cut to whole words
        assert abs(taken[s] - want[s]) <= 0.5 * sizes[s] / max(plan[s]["blocks"], 1) + 3 * max(plan[s]["blocks"], 1) ** 0.5 + 3


def test_texts_are_the_words_of_the_pieces(spark):
    data = rows()
    docs = table(spark, data)
    words = Counter()
    for r in mixing.mixed_texts(docs, block_words=16).collect():
        assert len(r["text"].split(" ")) == r["words"]
        words[r["source"], r["doc_id"]] += r["words"]
    taken = Counter()
    for r in mixing.mix(docs, block_words=16).collect():
        taken[r["source"], r["doc_id"]] += r["taken"]
    assert +words == +taken
    whole = {i: " ".join(WORD.findall(t or "")) for i, t, _ in data if i == 1000}[1000]
    assert all(r["text"] in whole for r in mixing.mixed_texts(docs).where("doc_id = 1000").collect())


def test_reruns_agree(spark):
    docs = table(spark, rows())
    once, again = (sorted(map(repr, mixing.mix(d, 8).drop("carried").collect())) for d in (docs, docs.repartition(5)))
    taken = lambda rs: Counter(x.split("pieces=")[0] for x in rs)
    assert taken(once) == taken(again)


def test_one_source_and_empty_tables(spark):
    assert mixing.mix(table(spark, [])).count() == 0
    assert mixing.mixed_texts(table(spark, [])).count() == 0
    got = mixing.mix(table(spark, [(1, None, None), (2, "", None)])).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in got] == [(0, 0, 0.0, 0)] * 2
    got = mixing.mix(table(spark, [(k, "a b c", None) for k in range(9)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(3, 27.0, 3)] * 9
