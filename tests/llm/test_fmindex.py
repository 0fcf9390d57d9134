import random

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, docs_of
from tideline.llm import fmindex as M


def brute(text, items):
    words = M.words_of(text)
    hit, found = set(), set()
    for item, t in items:
        w = M.words_of(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            for p in range(len(words) - len(w[k : k + 10]) + 1):
                if words[p : p + len(w[k : k + 10])] == w[k : k + 10]:
                    hit |= set(range(p, p + len(w[k : k + 10])))
                    found.add("" if item is None else str(item))
    return len(words), sorted(hit), sorted(found)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def check(spark, rows, items, **kw):
    got = M.contamination(docs_of(spark, rows, clash=True), items_of(spark, items), **kw).collect()
    flat = [((r["keys"].doc_id, r.text), (r.n_words, [w for a, b in r.spans for w in range(a, b)], r.items)) for r in got]
    docs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
    want = [((d[0], d[1] or ""), brute(d[1], items)) for d in docs]
    assert sorted(map(str, flat)) == sorted(map(str, want))


def test_against_brute_force(spark):
    rng = random.Random(1)
    draw = lambda k: " ".join(rng.choice(["a", "B", "c1", "é-x", "the"]) for _ in range(k))
    items = [(i, draw(rng.choice([0, 1, 4, 9, 10, 11, 25]))) for i in range(12)] + [(3, "a a a"), (3, None), (None, "B B the")]
    rows = [draw(rng.randrange(0, 80)) for _ in range(40)]
    rows += [f"start, {t.upper()}! end" for _, t in items if t]
    check(spark, rows, items)
    check(spark, rows, items, shard_words=50)
    check(spark, rows, items, block_bytes=60)


def test_awkward_and_empty(spark):
    check(spark, awkward(40), [(1, "und mehr wörter " * 4), (2, "the"), (3, ""), (4, None)])
    docs, items = docs_of(spark, ["a b c"]), items_of(spark, [(1, "a b")])
    assert M.contamination(docs.limit(0), items).count() == 0
    assert M.contamination(docs, items.limit(0)).first().spans == []


def test_wide_alphabets_take_the_other_sort():
    import numpy as np

    rng = np.random.default_rng(1)
    symbols = np.concatenate([rng.integers(2, 4, 200), [1 << 40], rng.integers(2, 4, 200), [0]])
    rank = M.suffix_order(symbols)
    order = sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
    assert [order[r] for r in rank] == list(range(len(symbols)))


def test_passages_are_cut_and_whole_passages_go(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(0, f"Before, {item.title()}. after 😀", "en", "s"), (1, item, "en", "s"), (2, "clean text", "en", "s"), (3, "", "en", "s")]
    docs = docs_of(spark, rows, clash=True)
    left = M.decontaminated(docs, items_of(spark, [(1, item)]))
    assert left.dtypes == docs.dtypes
    got = {r.doc_id: r for r in left.collect()}
    assert {i: r.text for i, r in got.items()} == {0: "Before, . after 😀", 2: "clean text", 3: ""}
    assert got[0].n_chars == len(got[0].text) and got[0].row == "clash"
    assert left.filter(F.col("doc_id") == 2).first().n_chars == 10
