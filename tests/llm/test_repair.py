import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING
from tideline.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
FAULTY = {"blank", "duplicate"}


def search(rows):
    """Least (cost, audit, outcome) over all edits of (role, text, fault) rows, up to four insertions in all."""
    best = None
    options = []
    for role, text, fault in rows:
        extra = 3 if fault == "truncated" else 0
        some = [(4, "D", None)]
        if fault not in FAULTY:
            some += [(extra, "K", (role, text)), (3 + extra, "R", ("user", text)), (3 + extra, "R", ("assistant", text))]
        options.append(some)
    inserts = [(3, "I", ("user", "")), (3, "I", ("assistant", ""))]
    gaps = [()] + [(x,) for x in inserts] + [(x, y) for x in inserts for y in inserts if x != y]
    slots = [[*gaps]] + [[*gaps] for _ in rows]
    for chosen in itertools.product(*slots):
        if sum(map(len, chosen)) > 4:
            continue
        for edits in itertools.product(*options):
            steps = list(chosen[0])
            for edit, gap in zip(edits, chosen[1:]):
                steps += [edit, *gap]
            left = [x[2] for x in steps if x[2] is not None]
            if GRAMMAR.match("".join(role[:1] if role[:1] in ("s", "u", "a") else "o" for role, _ in left)):
                found = (sum(x[0] for x in steps), "".join(x[1] for x in steps), tuple(left))
                best = min(best or found, found)
    return best


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        filled = text.strip(" \t\n\v\f\r")
        if not filled:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if filled[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def expected(conv_id, rows):
    """What repaired() gives for the (turn, role, text) rows of a conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    plain = [(r, x) for _, r, x in rows]
    faults = faults_of(plain)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for r, _ in plain]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, left = search([(r, x, f) for (r, x), f in zip(plain, faults)])
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in left).encode()).hexdigest()
    counts = tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
    return (conv_id, gaps, *counts, illegal, cost, audit, len(left), digest)


def found(df, present=None):
    rows = R.repaired(df, present).select("conv_id", *R.COUNTS, "cost", "audit", "lines", "repaired_sha256").collect()
    return sorted((tuple(r) for r in rows), key=str)


def signature(rows):
    out = ""
    for role, _, fault in rows:
        c = role[:1] if role[:1] in ("s", "u", "a") else "o"
        out += "x" if fault in FAULTY else c.upper() if fault else c
    return out


def test_audits_of_all_short_signatures():
    kinds = [(r, "t", f) for r in ("system", "user", "assistant", "tool") for f in ("", "truncated")] + [("user", "", "blank")]
    automaton = R.Automaton()
    cases = [rows for n in range(4) for rows in itertools.product(kinds, repeat=n)]
    cases.sort(key=lambda rows: signature(rows)[::-1])
    for rows in cases[::3]:
        assert automaton.repair(signature(rows)[::-1]) == search(rows)[:2], signature(rows)


def test_each_ending_is_worked_out_once():
    rng = random.Random(4)
    signatures = {"".join(rng.choice("suaUAx") for _ in range(rng.randrange(9))) for _ in range(300)}
    automaton = R.Automaton()
    for ending in sorted(s[::-1] for s in signatures):
        automaton.repair(ending)
    assert automaton.made == len({s[i:] for s in signatures for i in range(len(s) + 1)} | {""})


def random_turns(rng):
    texts = ("Yes.", "No", "Ok!", " ", "", None, "Wie?\t", "cut off \n")
    roles = ("user", "assistant", "user", "assistant", "system", "tool", None, "")
    return sorted(
        ((rng.choice((None, 0, 1, 2, 2, 5)), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(1, 5))),
        key=lambda t: (t[0] is not None, t[0] or 0),
    )


def test_conversations_against_search(spark):
    rng = random.Random(11)
    rows = {}
    for conv_id in [None, *range(-3, 60)]:
        # Rows of one turn have an order of their own, so here turns differ.
        turns = {t[0]: t for t in random_turns(rng)}
        rows[conv_id] = list(turns.values())
    df = spark.createDataFrame([(c, *t) for c, turns in rows.items() for t in turns], SCHEMA).repartition(3)
    df = df.withColumns({c: F.lit("clash") for c in CLASHING})
    assert found(df) == sorted((expected(c, turns) for c, turns in rows.items()), key=str)


def test_ties_repeats_and_absent_rows(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."),
        (2, None, "user", "A."), (2, None, "assistant", "B."),
        (3, 0, "user", "gone"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r[0]: r for r in found(df, F.col("conv_id") != 3)}
    assert out[1] == expected(1, [r[1:] for r in rows[:3]]) and out[1][7] == "KDK"
    # Null turns tie: the assistant's row comes first by its role.
    assert out[2] == expected(2, [(None, "assistant", "B."), (None, "user", "A.")])
    assert out[3] == (3, 0, 0, 0, 0, 0, 0, "", 0, hashlib.sha256(b"").hexdigest())
    assert found(df.limit(0)) == []


def test_long_and_common_conversations(spark):
    n = 4000
    long = spark.range(n).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("text "), F.col("id"), F.when(F.col("id") == 100, "").otherwise(".")).alias("text"),
    )
    same = spark.range(1000).select(
        (F.col("id") + 100).alias("conv_id"), F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("turn")
    ).select("conv_id", "turn", F.when(F.col("turn") == 0, "user").otherwise("assistant").alias("role"), F.lit("Ok.").alias("text"))
    out = R.repaired(long.unionByName(same)).collect()
    assert len(out) == 1001
    (hot,) = (r for r in out if r.conv_id == 7)
    assert hot.audit == "K" * n and hot.cost == 3 and hot.truncated == 1 and hot.lines == n
    assert {(r.audit, r.cost) for r in out if r.conv_id != 7} == {("KK", 0)}
    # The common signature is worked out once per range partition at most.
    assert sum(r.nodes for r in out) <= n + 3 * 4 + 4


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(12) for t in [None, *range(6)]]
    import zlib

    want = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        if fault:
            text = {1: "", 2: "One Two"}.get(fault, text)
            want += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = R.damaged(spark.createDataFrame(rows, SCHEMA))
    kept = out.filter("present").select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(str, kept)) == sorted(str(R_) for R_ in spark.createDataFrame(want, SCHEMA).collect())
    assert out.select("conv_id").distinct().count() == 12
