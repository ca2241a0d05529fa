"""Structure repair against plain readings of its definition."""
import hashlib
import itertools
import random
import re
import zlib

import pytest

from shelfmatch.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, copies int, part string, n int, fault string"     # names that clash
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def table(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", 5, "y") for r in rows], SCHEMA)


def damage(rows):
    """The contract's damage, by (conv, turn, role, text)."""
    out = []
    for c, t, r, x in rows:
        one = lambda v: " " if v is None else str(v)
        fate = zlib.crc32(f"{one(c)}:{one(t)}".encode()) % 20
        r, x = one(r), one(x)
        x = "" if fate == 1 else re.sub("[.!?]", "", x) if fate == 2 else x
        out += [(c, t, "user" if fate == 4 else r, x)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired lines) by a forward table over single rows and states of the pattern, least letters first."""
    after, role = {0: 2, 1: 2, 2: 3, 3: 2}, {0: "user", 1: "user", 2: "assistant", 3: "user"}
    table = {0: (0, "", ())}
    for r, x, fault in rows:
        new = {}

        def offer(q, cost, audit, lines):
            if q not in new or (cost, audit) < new[q][:2]:
                new[q] = (cost, audit, lines)

        for q, (cost, audit, lines) in table.items():
            for extra in range(4):
                p, c, a, out = q, cost, audit, lines
                for _ in range(extra):
                    c, a, out, p = c + 5, a + "I", (*out, role[p] + ":"), after[p]
                offer(p, c + 2, a + "D", out)
                if fault in ("blank", "duplicate"):
                    continue
                late = 5 if fault == "truncated" else 0
                if r[:1] == role[p][0] or (r[:1] == "s" and p == 0):
                    offer(1 if r[:1] == "s" else after[p], c + late, a + "K", (*out, f"{r}:{x}"))
                offer(after[p], c + late + 1, a + "R", (*out, f"{role[p]}:{x}"))
        table = new
    ends = []
    for q, (cost, audit, lines) in table.items():
        while q in (1, 2):
            cost, audit, lines, q = cost + 5, audit + "I", (*lines, role[q] + ":"), after[q]
        ends.append((cost, audit, lines))
    return min(ends)


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r, hashlib.sha256(x.encode()).hexdigest(), x))
    out = {}
    for c, own in convs.items():
        own.sort()
        seen, judged, faults = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, _, r, _, x in own:
            seen_text = x.rstrip(" \t\n\v\f\r")
            fault = "blank" if not BLANK.search(x) else "duplicate" if (r, x) in seen else "truncated" if seen_text[-1] not in ".!?" else ""
            seen.add((r, x))
            judged.append((r, x, fault))
            if fault:
                faults[fault] += 1
        turns = [t for has, t, *_ in own if has]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, lines = cheapest(judged)
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults.values(), illegal, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(seed=2, n=120):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(0, 14)):
            rows.append((c, t + rng.choice([0, 0, 0, 3]), rng.choice(["user", "assistant"] * 5 + ["system", "tool", None, "", "usher"]),
                         rng.choice(["Yes.", "no", "why?", " ", "", None, f"text {t}.", f"text {t}", "é!\n\t", "end. "])))
    rows += [(500, None, "user", "hi."), (500, None, "assistant", "ho."), (500, 4, "user", "hi."), (None, 1, "user", "a."), (None, None, None, None), (None, 1, "user", "a.")]
    rows += [(600, 0, "system", "s."), (601, 0, "system", None), (602, 0, "user", "word " * 30000 + "."), (602, 1, "assistant", "word " * 30000)]
    return rows


def test_equals_brute_force(spark):
    rows = conversations()
    got = {r[0]: tuple(r[1:]) for r in repair.digests(table(spark, rows)).collect()}
    assert got == brute([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])


def test_query_after_damage(spark, tmp_out):
    rows = conversations(seed=8, n=300) + [(700, t, "user", None) for t in range(3)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_out}/conversations.parquet")
    got = {r[0]: tuple(r[1:]) for r in repair.op13_structure_repair(spark, tmp_out).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = brute(damage(rows))
    assert got == {c: want.get(c, nothing) for c in {r[0] for r in rows}} and nothing in got.values()


def test_one_conversation_over_many_ranges(spark):
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "tool"]), f"t{t}" + rng.choice([".", "", "?"])) for t in range(900)]
    rows += [(0, 0, "user", "a."), (2, 0, "assistant", "b."), (2, 1, "user", "c.")] + [(1, t, "user", "same.") for t in range(300, 500)]
    rows += [(1, 450, "user", "copy.")] * 400 + [(1, None, "system", "first.")]
    df = table(spark, rows)
    ranged = repair.counted(df)
    assert sum(x[2] for x in repair.boundaries(ranged).values()) > 2
    assert {r[0]: tuple(r[1:]) for r in repair.digests(df).collect()} == brute(rows)


def test_repair_rows_tell_the_repaired_conversation(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "assistant", "b."), (1, 3, "user", ""), (2, 0, "user", "q."), (2, 0, "user", "q.")]
    got = repair.repair(table(spark, rows)).orderBy("conv_id", "part", "at").collect()
    assert [(r["conv_id"], r["edit"], r["repaired_role"], r["text"], r["times"]) for r in got] == [
        (1, "K", "system", "s.", 1), (1, "R", "user", "a.", 1), (1, "K", "assistant", "b.", 1), (1, "D", None, "", 1), (2, "D", None, "q.", 1), (2, "D", None, "q.", 1)]
    assert [r["fault"] for r in got] == ["", "", "", "blank", "", "duplicate"]


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_every_short_sequence(length):
    kinds = [("system", ""), ("user", ""), ("assistant", ""), ("tool", ""), ("user", "truncated"), ("assistant", "truncated"), ("system", "blank")]
    for own in itertools.product(kinds, repeat=length):
        rows = [{"role": r, "text": str(k), "turn": k, "n": 1, "fault": f} for k, (r, f) in enumerate(own)]
        digest, want = repair.Digest(), cheapest([(r, str(k), f) for k, (r, f) in enumerate(own)])
        for e in repair.edits(rows, repair.END, repair.START, True):
            digest.add(*e)
        assert (digest.cost, "".join(digest.audit)) == want[:2]
        assert digest.hash.hexdigest() == hashlib.sha256("\n".join(want[2]).encode()).hexdigest()
        assert min(a + b for a, b in zip(repair.matrix(repair.runs(rows))[0], repair.END)) == want[0]


def test_long_runs_by_powers():
    for n in (1, 7, 1000, 123457):
        of = [(("u", ""), n), (repair.GONE, n), (("a", "truncated"), n % 50)]
        end = repair.END
        for symbol, k in reversed(of):
            for p in repair.powers(symbol, k):
                end = repair.applied(p, end)
        assert end == repair.applied(repair.matrix(of), repair.END)
        if n <= 1000:
            want = cheapest([("user", "", "")] * n + [("x", "", "blank")] * n + [("assistant", "", "truncated")] * (n % 50))
            assert want[0] == end[repair.START]


def test_empty_table(spark):
    assert repair.digests(table(spark, [])).count() == 0
    assert repair.repair(table(spark, [])).count() == 0
