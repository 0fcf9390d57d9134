"""The pipeline on a small table, each stage against what it must do, and all queries on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from tests.llm.test_fertility import base
from tests.llm.test_fmindex import brute
from tests.llm.test_hyperminhash import shingles
from tests.llm.test_ownership import base as secrets
from tideline.llm import tree_bpe
from tideline.llm.common import table
from tideline.session import stored

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


def test_stages_on_the_smallest_table(spark):
    docs = table(spark, ROOT, "documents")
    columns = docs.columns
    items = [tuple(r) for r in table(spark, ROOT, "benchmark").collect()]
    seen = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ROOT), name)
        seen.append(docs.collect())
        if name != "encoding":
            assert docs.columns == columns
    start, rules, copies, items_gone, secrets_gone, encoded = seen
    assert not any(base(r.text)[5] for r in rules) and {r.doc_id for r in rules} <= {r.doc_id for r in start}
    assert len(rules) >= 0.97 * sum(not base(r.text)[5] for r in start)
    sets = [shingles(r.text) for r in copies]
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            assert not both or 100 * both < 75 * (len(sets[a]) + len(sets[b]) - both)
    assert all(not brute(r.text, items)[1] for r in items_gone)
    clean = {r.doc_id: r for r in copies if not brute(r.text, items)[1]}
    after = {r.doc_id: r for r in items_gone}
    assert all(after[i] == r for i, r in clean.items()) and len(clean) < len(copies)
    masked = {r.doc_id: r for r in secrets_gone}
    assert set(masked) == set(after)
    for i, r in after.items():
        assert not secrets(masked[i].text)
        assert secrets(r.text) or masked[i] == r or "SECRET>" in masked[i].text
    tok = tree_bpe.tokenizer(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    for r in encoded:
        assert r.n_tokens == len(tok.encode(masked[r.doc_id].text, add_special_tokens=False).ids) == len(r.ids) // 4


@pytest.mark.parametrize("name", sorted(k for k in entry_module.queries() if k.startswith("op") and k[2].isdigit()))
def test_queries_cover_their_whole_table(spark, name):
    df = entry_module.queries()[name](spark, ROOT)
    source = "conversations" if name.startswith("op7_") else "documents"
    key = "conv_id" if name.startswith("op7_") else "doc_id"
    want = {r[0] for r in table(spark, ROOT, source).select(key).collect()} | ({-7} if key == "conv_id" else set())
    assert sorted(r[0] for r in df.select(key).collect()) == sorted(want)


@pytest.mark.parametrize("name", sorted(entry_module.corpus.ORACLE))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(ROOT):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{ROOT}/{file}'")
    got, want = entry_module.queries()[name](spark, ROOT).toPandas(), con.execute(entry_module.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    key = lambda d: sorted(map(str, d[columns].itertuples(index=False, name=None)))
    assert key(got) == key(want)
