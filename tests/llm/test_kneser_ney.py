import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, docs_of
from tideline.llm import arrays, kneser_ney


def tokens(text):
    return (text or "").encode().lower().split() + ["</s>"]


def brute(train):
    count = collections.Counter(w for d in train for w in d)
    pairs = collections.Counter(p for d in train for p in zip(["<s>"] + d[:-1], d))
    follow, cont = collections.defaultdict(lambda: [0, 0, 0, 0]), collections.Counter()
    for (a, b), n in pairs.items():
        follow[a][0] += n
        follow[a][min(n, 3)] += 1
        cont[b] += 1
    of = lambda c: kneser_ney.discounts(*(sum(v == k for v in c.values()) for k in range(1, 5)))
    d1, d2, total, kinds = of(cont), of(pairs), len(pairs), len(count)
    mass = sum(d1[min(v, 3) - 1] for v in cont.values()) / total if total else 1.0

    def word(w):
        a = cont.get(w, 0)
        return (max(a - d1[min(a, 3) - 1], 0) / total if a else 0) + mass / (kinds + 1)

    def p(before, w):
        if before not in follow:
            return word(w)
        f, n = follow[before], pairs.get((before, w), 0)
        return (max(n - d2[min(n, 3) - 1], 0) / f[0] if n else 0) + sum(d2[k] * f[k + 1] for k in range(3)) / f[0] * word(w)

    return count, p


def compare(spark, rows):
    train = [tokens(t) for i, t, _, _ in rows if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1]
    count, p = brute(train)
    n, v = sum(count.values()), len(count)
    found, model = kneser_ney.held_out(docs_of(spark, rows, clash=True))
    assert (model.total, model.words) == (n, v)
    want = []
    for i, t, _, _ in rows:
        d = tokens(t)
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in d)
        score = sum(math.log10(p(a, b)) for a, b in zip(["<s>"] + d[:-1], d))
        want.append((str(i), len(d), sum(w in count for w in d), base, score))
    got = [(str(r["keys"].doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in found.collect()]
    assert [x[:3] for x in sorted(got)] == [x[:3] for x in sorted(want)]
    for a, b in zip(sorted(got), sorted(want)):
        assert a[3:] == pytest.approx(b[3:], rel=1e-9, abs=1e-9)
    if count:
        assert sum(p("<s>", w) for w in count) + p("<s>", "unknown") == pytest.approx(1)
    return found


def test_against_brute_force(spark):
    rng = random.Random(6)
    words = [f"W{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40))), "en", "s") for i in range(300)]
    compare(spark, rows)


def test_awkward(spark):
    compare(spark, awkward(300))
    compare(spark, [(1, None, None, None)])


def test_empty_table(spark):
    found, model = kneser_ney.held_out(docs_of(spark, ["a"]).limit(0))
    assert found.count() == 0 and model.total == 0
    assert kneser_ney.scored(docs_of(spark, ["a b"]), model).first().score == 0


def test_the_model_beats_single_words_on_held_out_text(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["the big dog", "a small cat", "one red bird"]) for _ in range(20)), "en", "s") for i in range(100)]
    got = kneser_ney.held_out(docs_of(spark, rows))[0].filter("keys.held_out").collect()
    assert sum(r.score for r in got) > 0.8 * sum(r.base_score for r in got)


def test_arrays_pack_and_mix_exactly():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (arrays.unmix(arrays.mix(x)) == x).all()
    assert (arrays.unpacked(arrays.packed(np.sort(x))) == np.sort(x)).all()
    assert (arrays.unpacked(arrays.packed(x)) == x).all()
    assert len(arrays.unpacked(arrays.packed(x[:0]))) == 0


def test_a_task_holds_one_shard(spark):
    blobs = spark.range(980).select((F.col("id") % 49).cast("int").alias("shard"), "id")
    tasks = kneser_ney.by_shard(blobs, 49).withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.collect_set("shard").alias("shards"))
    assert [len(r.shards) for r in tasks.collect()] == [1] * 49
