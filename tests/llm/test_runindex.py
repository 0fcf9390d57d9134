import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tests.llm.helpers import awkward, docs_of
from tideline.llm import runindex as R
from tideline.llm.textbytes import powers


def brute(rows):
    """By the contract: rows in the order of doc_id; equal (doc_id, text) is one document."""
    seen, out = {}, []
    order = sorted({(i is None, i or 0, t or "") for i, t in rows})
    for doc in order:
        data = doc[2].encode()
        covered = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                covered[s : s + 100] = b"\1" * 100
            else:
                seen[data[s : s + 100]] = doc
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(1 for k, c in enumerate(covered) if c and not (k and covered[k - 1]))
        out.append((doc, (len(data), sum(covered), spans, kept)))
    return dict(out)


def result(df, **kw):
    return [
        (r["keys"].doc_id, (len(r.kept) + sum(b - a for a, b in r.spans), sum(b - a for a, b in r.spans), len(r.spans), bytes(r.kept)))
        for r in R.remove_repeats(df, **kw).collect()
    ]


def check(spark, rows, **kw):
    want = brute([(i, t) for i, t, _, _ in rows])
    expected = sorted(str((i, want[(i is None, i or 0, t or "")])) for i, t, _, _ in rows)
    assert sorted(map(str, result(docs_of(spark, rows, clash=True), **kw))) == expected


def corpus(seed, n=60):
    rng = random.Random(seed)
    draw = lambda k, of="abcdefgh é": "".join(rng.choice(of) for _ in range(k))
    passages = [draw(rng.choice([60, 99, 100, 130, 400])) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [draw(rng.randrange(0, 150))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            if rng.random() < 0.4:
                k = rng.randrange(len(p))
                p = p[:k] + "#" + p[k + 1 :]
            parts += [p, draw(rng.randrange(0, 60))]
        rows.append((rng.randrange(10 * n) * n + i, "".join(parts), "en", "s"))
    return rows


def test_against_brute_force(spark):
    for seed in (1, 2):
        check(spark, corpus(seed))


def test_periodic_texts_and_copies(spark):
    rows = [(1, "a" * 500, "en", "s"), (2, "ab" * 300, "en", "s"), (3, "a" * 120, "en", "s"), (4, "abc" * 33, "en", "s")]
    rows += [(10 + i, "same passage in every document, " * 5 + str(i), "en", "s") for i in range(20)]
    check(spark, rows)


def test_hot_anchors_are_dealt_string_by_string(spark):
    rows = corpus(3) + [(100_000 + i, f"{i}" * 40 + " one very common line that stands everywhere in this corpus " + f"{i}!" * 40, "en", "s") for i in range(40)]
    check(spark, rows, hot=2)


def test_awkward_and_empty(spark):
    rows = [(i, (t or "x")[:1000] * 3 if t else t, a, b) for i, t, a, b in awkward(60)]
    check(spark, rows + [(3, "y" * 150, "en", "s"), (3, "y" * 150, "en", "s")])
    assert R.remove_repeats(docs_of(spark, ["a"]).limit(0)).count() == 0


def test_texts_longer_than_a_place_are_cut_into_pieces(monkeypatch):
    monkeypatch.setattr(R, "PLACE_BITS", 9)
    text = bytes(random.Random(1).choices(b"abcd", k=3000))
    number, first, last, hashes = R.anchors([text, text])
    starts = [(n, s) for n, a, b in zip(number, first, last) for s in range(a, b + 1)]
    assert sorted(starts) == [(n, s) for n in (0, 1) for s in range(2901)]
    assert len(powers(10)[0]) == 10


def test_digest_of_kept_bytes(spark):
    got = result(docs_of(spark, ["z" * 10]))
    assert hashlib.sha256(got[0][1][3]).hexdigest() == hashlib.sha256(b"z" * 10).hexdigest()


def test_matching_statistics_are_those_of_the_row_above():
    rng = random.Random(4)
    base = bytes(rng.choices(b"ab\0\xff", k=400))
    contexts = []
    for _ in range(40):
        at = rng.randrange(200)
        c = bytearray(base[at : at + rng.randrange(100, 180)])
        c[rng.randrange(len(c))] = rng.choice(b"ab\0\xff")
        contexts.append(bytes(c))
    index = R.RunIndex(contexts)
    assert len(index.starts) < sum(map(len, contexts)) / 2  # runs are fewer than rows
    got = {}
    for which, offset, rows, matched in index.stream():
        got |= {r: (contexts[c][o:], m) for c, o, r, m in zip(which.tolist(), offset.tolist(), rows.tolist(), matched.tolist())}
    ordered = [got[r] for r in sorted(got)]
    for (above, _), (own, matched) in zip(ordered, ordered[1:]):
        shared = next((k for k, (x, y) in enumerate(zip(above, own)) if x != y), min(len(above), len(own)))
        assert (matched >= 100) == (shared >= 100)


def test_zero_bytes_and_many_differing_contexts(spark):
    rng = random.Random(9)
    line = "".join(rng.choices("abcdefgh", k=130))
    rows = [(i, f"{chr(97 + i % 20) * rng.randrange(3, 40)}\0{line}{chr(97 + i % 7)}\0{line[::-1]}", "en", "s") for i in range(120)]
    check(spark, rows)
    check(spark, rows, hot=50)


def test_memory_of_a_long_text_is_bounded():
    text = np.random.default_rng(1).integers(97, 123, 16 << 20).astype(np.uint8).tobytes()
    tracemalloc.start()
    R.anchors([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20


def test_a_task_holds_one_deal_at_a_time(monkeypatch):
    sizes = []
    settled = R._settled
    monkeypatch.setattr(R, "_settled", lambda held: sizes.append(sum(len(h[0]) + 1 for h in held)) or settled(held))
    monkeypatch.setattr(R, "INDEX_BYTES", 2000)
    rng = random.Random(2)
    batches = []
    for deal in range(50):
        shared = bytes(rng.choices(b"abc", k=100))
        cut = sorted(bytes(rng.choices(b"abc", k=20)) + shared + bytes(rng.choices(b"abc", k=20)) for _ in range(5))
        rows = {"deal": [deal] * 5, "context": cut, "doc_id": list(range(5)), "text_key": [0] * 5, "start": [1000 * deal] * 5, "end": [1000 * deal + 140] * 5}
        batches.append(pa.RecordBatch.from_arrays([pa.array(rows[c], pa.binary() if c == "context" else pa.int64()) for c in rows], list(rows)))
    found = [r for b in R._mark(iter(batches)) for r in b.to_pylist()]
    assert len(sizes) > 15 and max(sizes) <= 2000
    # Of each deal's five contexts the first document's keeps the passage.
    assert len(found) == 200 and {r["doc_id"] for r in found} == {1, 2, 3, 4}
