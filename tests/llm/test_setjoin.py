import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, docs_of
from tideline.llm import setjoin as S
from tideline.llm.textbytes import shingle_sets


def shingles(text, size=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, percent=90):
    """(doc_id, set size, component_id) of (doc_id, text) rows by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    name = list(range(len(sets)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, (_, s) in enumerate(sets):
        for b, (_, t) in enumerate(sets[:a]):
            both = len(s & t) if len(s) and len(t) and 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)) else 0
            if both and 100 * both >= percent * (len(s) + len(t) - both):
                name[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def found(docs, **options):
    rows = S.linked_documents(docs, **options).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in rows), key=str)


def copies(seed, lengths, each, extra):
    """Groups of copies of copies, with edits near the threshold, and a passage that many texts share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts = []
    for length in lengths:
        group = [[word() for _ in range(length)]]
        for _ in range(each):
            copy = list(rng.choice(group))
            for _ in range(rng.randrange(0, 3 + length // 40)):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice(([word()], [], [word(), copy[at]]))
            group.append(copy)
        texts += group
    texts += [[word() for _ in range(rng.randrange(0, 40))] + passage for _ in range(extra)]
    rng.shuffle(texts)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("seed, lengths, each, extra", [(1, [2, 6, 9, 12, 13, 20, 25, 40, 60], 9, 30), (2, [150, 300, 700, 2000], 25, 60)])
def test_components_against_brute_force(spark, seed, lengths, each, extra):
    texts = copies(seed, lengths, each, extra)
    want = brute(list(enumerate(texts)))
    assert len({c for _, _, c in want}) < len(texts)
    assert found(docs_of(spark, texts)) == want


def test_all_light_all_heavy_and_between(spark, monkeypatch):
    texts = copies(5, [12, 30, 60, 100, 130, 260], 12, 20)
    want = brute(list(enumerate(texts)))
    for first_heavy in (0, S.class_of(58), 1 << 20):
        monkeypatch.setattr(S, "boundary", lambda costs, at=first_heavy: min(at, S.class_of(5000)))
        assert found(docs_of(spark, texts)) == want, first_heavy


def test_a_large_group_without_its_original(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(300)]
    texts = []
    for _ in range(200):
        copy = list(base)
        for at in rng.sample(range(300), rng.choice((2, 4, 6, 9))):
            copy[at] = word()
        texts.append(" ".join(copy))
    assert found(docs_of(spark, texts)) == brute(list(enumerate(texts)))


def test_awkward_rows(spark):
    rows = awkward(900) + [(20, "The the THE", None, None), (21, " ".join(f"w{i}" for i in range(200)), "en", "a"),
                          (22, " ".join(f"w{i}" for i in range(199)), "en", "a"), (None, " ".join(f"w{i}" for i in range(201)), "en", "a")]
    assert found(docs_of(spark, rows, clash=True)) == brute([r[:2] for r in rows])
    assert found(docs_of(spark, rows).limit(0)) == []


def test_bounds():
    for percent in (60, 75, 90):
        for n in range(1, 400):
            for m in range(S.least_partner(n, percent), n + 1):
                o = S.needed(n, m, percent)
                assert 100 * o >= percent * (n + m - o) and 100 * (o - 1) < percent * (n + m - o + 1)
                assert any(c == S.class_of(m) and o >= least for c, least in S.scanned(n, percent))
                assert S.needed(m, m, percent) <= o
                both = {c: p for c, p in S.part_classes(n, percent)}.items() & {c: p for c, p in S.part_classes(m, percent)}.items()
                if n > 1:
                    assert any(p > n + m - 2 * o for _, p in both), (n, m)
    for number in range(1, 700):
        assert S.class_of(S.least_of(number)) >= number > S.class_of(max(S.least_of(number) - 1, 0)) or number == 0


def test_linked_sets_have_an_equal_part():
    rng = np.random.default_rng(3)
    for n in (9, 10, 19, 40, 300, 1500):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            o = S.needed(len(a), len(a), 90)
            b = np.unique(np.concatenate([a[: o], rng.integers(0, 1 << 62, len(a) - o).astype(np.uint64)]))
            assert np.isin(S.part_names(a, 90), S.part_names(b, 90)).any()


def test_boundary_by_cost():
    assert S.boundary([]) == 0
    assert S.boundary([(5, 1.0, 10.0), (9, 4.0, 10.0), (30, 500.0, 20.0)]) == 10
    assert S.boundary([(5, 50.0, 10.0)]) == 5


def test_only_shared_beginnings_meet(spark):
    """Copies too far from each other name nothing in common, however many there are."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base)]
    for k in range(300):
        copy = list(base)
        for at in rng.sample(range(0, 400, 4), 12):
            copy[at] = f"own{k}x{at}"
        texts.append(" ".join(copy))
    docs = docs_of(spark, texts)
    assert found(docs) == brute(list(enumerate(texts)))
    assert len(shingle_sets([texts[0].encode()], 3)[0]) == 398
    assert docs.select(F.count("*")).first()[0] == 301


def test_listing_takes_little_more_than_the_batch():
    """Objects per element took 30 times the batch; two workers of an executor do this at once."""
    sets, size = 2000, 200
    element = pa.struct([("sets", pa.int64()), ("element", pa.int64())])
    values = pa.StructArray.from_arrays([pa.array(np.full(sets * size, 2)), pa.array(np.arange(sets * size))], fields=list(element))
    shared = pa.ListArray.from_arrays(pa.array(np.arange(sets + 1) * size, pa.int32()), values)
    columns = [pa.array(np.arange(sets)), pa.array([4 * size] * sets), pa.array([0] * sets), shared]
    batch = pa.RecordBatch.from_arrays(columns, ["id", "n", "alone", "shared"])
    run = S.listed(0, 75, 1)
    want = sum(b.num_rows for b in run(iter([batch.slice(sets // 2, 1)])))
    tracemalloc.start()
    rows = sum(b.num_rows for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert want > size and rows == sets * want
    assert peak < 3 * batch.nbytes
