import zlib

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, docs_of
from tideline.llm import kdtree


def check_slots(got, leaves):
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(leaves))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_even_bytes_with_a_hot_source(spark):
    rows = [(i, "x" * (i * 37 % 400), "en" if i % 3 else None, "hot" if i % 3 else f"s{i}") for i in range(800)]
    got = kdtree.document_shards(docs_of(spark, rows, clash=True), leaves=8).collect()
    assert len(got) == 800
    check_slots(got, 8)
    sums = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert max(sums) - min(sums) <= 3 * 401
    assert all(r.row.text_crc32 == zlib.crc32(rows[r.row.doc_id][1].encode()) for r in got)


def test_leaf_counts_that_are_no_power_of_two_and_target_bytes(spark):
    df = docs_of(spark, ["y" * 99] * 60)
    for kw, leaves in (({"leaves": 5}, 5), ({"leaves": 1}, 1), ({"leaves": None, "target_bytes": 1000}, 6)):
        got = kdtree.document_shards(df, **kw).collect()
        check_slots(got, leaves)
        sums = [sum(r.size for r in got if r.shard == s) for s in range(leaves)]
        assert max(sums) - min(sums) <= 200


def test_the_widest_dimension_is_cut(spark):
    rows = spark.createDataFrame([(float(x), float(y)) for x in (0, 1) for y in range(50)], "x double, y double")
    got = kdtree.kd_shards(rows, [F.col("x") / 1000, F.col("y")], F.lit(1), [F.col("x")], leaves=2).collect()
    # Both are as wide as the table at the root; the first one wins.
    assert {(r.row.x, r.shard) for r in got} == {(0.0, 0), (1.0, 1)}


def test_awkward_and_empty(spark):
    df = docs_of(spark, awkward(50), clash=True)
    got = kdtree.document_shards(df, leaves=8).collect()
    assert len(got) == len(awkward())
    check_slots(got, 8)
    assert {r.size for r in got if r.row.doc_id == 1} == {1}
    assert kdtree.document_shards(df.limit(0), leaves=8).count() == 0
