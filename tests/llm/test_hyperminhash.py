import random

import numpy as np
import pyarrow as pa

from tests.llm.helpers import awkward, docs_of
from tideline.llm import common
from tideline.llm import hyperminhash as H
from tideline.llm.graph import components
from tideline.llm.textbytes import shingle_sets


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    name = list(range(len(sets)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, (_, s) in enumerate(sets):
        for b, (_, t) in enumerate(sets[:a]):
            both = len(s & t)
            if both and 100 * both >= 75 * (len(s) + len(t) - both):
                name[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def near_copies(seed, groups=12, each=6, extra=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 6, 8, 30, 120]))]
        for _ in range(rng.randrange(1, each)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(copy) // 12)):
                copy[rng.randrange(len(copy))] = word()
            base = copy if rng.random() < 0.4 else base  # chains too
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy))
    texts += [" ".join(word() for _ in range(rng.randrange(1, 50))) for _ in range(extra)]
    rng.shuffle(texts)
    return texts


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in H.near_duplicates(df).collect()), key=str)


def test_components_against_brute_force(spark):
    for seed in (1, 2):
        texts = near_copies(seed)
        assert result(docs_of(spark, texts, clash=True)) == brute(list(enumerate(texts)))


def test_a_large_group_of_near_copies_and_bridges(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(150):
        copy = list(base)
        for at in rng.sample(range(200), 6):
            copy[at] = f"x{i}{at}"
        texts.append(" ".join(copy))
    # Two stretches that only the middle one links.
    texts += [" ".join(f"b{j}" for j in range(a, a + 100)) for a in (0, 13, 26)]
    assert result(docs_of(spark, texts)) == brute(list(enumerate(texts)))


def test_awkward(spark):
    rows = awkward(30)
    assert result(docs_of(spark, rows, clash=True)) == brute([(i, t) for i, t, _, _ in rows])
    assert H.near_duplicates(docs_of(spark, rows).limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d e f", "en", "s"), (2, "A B C D E F", "de", "t"), (2, "A B C D E F", "de", "t"), (9, "", None, None),
            (9, "", None, None), (None, "a b c d e f", "en", "s"), (None, "lone words here", "en", "s"), (4, "other words here", "en", "s")]
    left = H.without_duplicates(docs_of(spark, rows, clash=True))
    assert left.columns == docs_of(spark, rows, clash=True).columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == [
        ("2", "A B C D E F"), ("4", "other words here"), ("9", ""), ("9", ""), ("None", "lone words here")]


def test_estimates_follow_the_true_similarity():
    rng = np.random.default_rng(3)
    for n, share in ((50, 0.8), (400, 0.75), (5000, 0.6), (2000, 0.0)):
        common = rng.integers(0, 1 << 63, int(n * share)).astype(np.uint64) * np.uint64(2)
        sets = [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, n - len(common)).astype(np.uint64) * np.uint64(2)])) for _ in range(2)]
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        regs = H.registers(sets)
        got = H.estimate(regs[:1], regs[1:], np.array([n]), np.array([n]))[0]
        assert abs(got - true) < 0.12


def test_shingles_are_words_not_bytes():
    sets = shingle_sets([b"A b\tC\x0bd e", b"a B c d  e\n", b"a b c d e f", b"ab c d e", "a b c d é".encode(), b"", b" \n"])
    assert (sets[0] == sets[1]).all() and len(sets[2]) == 2 and sets[0][0] in sets[2]
    assert [len(s) for s in sets] == [1, 1, 2, 1, 1, 0, 0]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 300), (300, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 300: 200}


def test_small_sets_are_verified_whatever_their_estimate(spark):
    texts = []
    for i in (257, 623, 1414, 3055, 5758):
        words = [f"w{i}x{j}" for j in range(8)]
        texts += [" ".join(words), " ".join(words[:7])]
    sets = shingle_sets([t.encode() for t in texts])
    regs = H.registers(sets)
    sizes = np.array([len(s) for s in sets])
    assert (H.estimate(regs[0::2], regs[1::2], sizes[0::2], sizes[1::2]) < H.PERCENT / 100 - H.MARGIN).all()
    assert result(docs_of(spark, texts)) == brute(list(enumerate(texts)))


def test_copies_of_copies_of_long_texts(spark):
    """Sets of 300 to 2000 shingles around the threshold, so that registers rule out and bands decide."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for length, each in ((320, 40), (700, 25), (2000, 10)):
        group = [[word() for _ in range(length)]]
        for _ in range(each):
            copy = list(rng.choice(group[:1] if rng.random() < 0.5 else group))
            for _ in range(rng.randrange(0, length // 16)):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice(([word()], [], [word(), copy[at]]))
            group.append(copy)
        texts += [" ".join(t) for t in group]
    rng.shuffle(texts)
    want = brute(list(enumerate(texts)))
    assert 3 < len({c for _, _, c in want}) < len(texts)
    assert result(docs_of(spark, texts)) == want


def test_workers_drop_what_an_earlier_stage_kept():
    """In the pipeline the caches of the quality rules stayed in the workers all along."""
    texts = pa.RecordBatch.from_pydict({"id": [1], "doc_id": [1], "text_key": [1], "text": ["one two three four five six"]})
    sketch = H._sketch(iter([texts]))
    sets = H._packed_sets(iter([texts]))
    for run in (sketch, sets):
        common._held["earlier"] = ["a model"]
        assert next(run).num_rows == 1
        assert not common._held


def test_workers_get_few_rows_at_once(spark, monkeypatch):
    """A task's texts went to its worker in one batch."""
    docs = docs_of(spark, [f"text {i} of some words" for i in range(3000)]).coalesce(1)
    seen, before = [], spark.conf.get(common.BATCH_KEY)
    real = H.Nodes.__init__

    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows]})

    def init(self, docs):
        seen.extend(r.rows for r in docs.mapInArrow(count, "rows long").collect())
        real(self, docs)

    monkeypatch.setattr(H.Nodes, "__init__", init)
    assert H.near_duplicates(docs).count() == 3000
    assert sum(seen) == 3000 and max(seen) <= 1000
    assert spark.conf.get(common.BATCH_KEY) == before
