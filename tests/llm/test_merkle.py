import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, docs_of
from tideline.llm import merkle
from tideline.llm.queries import op12_merkle_manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source):
    n = None if text is None else len(text)
    fields = (doc_id, source, lang, n, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels_of(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def siblings(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        first = at // fanout * fanout
        run = level[first : first + fanout]
        out.append(("".join(run[: at - first]), "".join(run[at - first + 1 :])))
        at //= fanout
    return out


def brute(rows, fanout):
    """(doc_id, source, rank, leaf, subroot, root, proof) of (doc_id, text, lang, source) rows."""
    sources = {}
    for doc_id, text, lang, source in rows:
        sources.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf(doc_id, text, lang, source)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(sources[s])], fanout) for s in names}
    top = levels_of([trees[s][-1][0] for s in names], fanout)
    out = []
    for place, s in enumerate(names):
        for rank, (has_id, doc_id, node) in enumerate(sorted(sources[s])):
            proof = siblings(trees[s], rank, fanout) + siblings(top, place, fanout)
            out.append((doc_id if has_id else None, s, rank, node, trees[s][-1][0], top[-1][0], proof))
    return sorted(out, key=str)


def found(docs, **options):
    rows = merkle.manifest(docs, **options).collect()
    return sorted(
        ((r.doc_id, r.source, r.rank, r.leaf, r.subroot, r.root, [tuple(p) for p in r.proof]) for r in rows), key=str
    )


def corpus(seed, n, sources):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # The first source holds most rows, others a few or one.
        source = "src0" if rng.random() < 0.6 else f"src{rng.randrange(sources)}"
        rows.append((i, f"Text {rng.randrange(n)} ü", rng.choice(["en", None]), source))
    return rows


def test_exchange_against_brute_force(spark):
    for n, sources, fanout, depth in ((150, 12, 2, 1), (200, 30, 4, 2), (1000, 3, 16, 1)):
        rows = corpus(n, n, sources)
        assert found(docs_of(spark, rows), fanout=fanout, depth=depth) == brute(rows, fanout), (n, fanout, depth)


def test_every_size_of_a_tree(spark):
    rows = [(i, "x", "en", f"s{n:02}") for n in range(1, 18) for i in range(n)]
    assert found(docs_of(spark, rows), fanout=2, depth=1) == brute(rows, 2)


def test_awkward_rows(spark):
    rows = awkward(50) + [(9, "t", "en", "")]
    assert found(docs_of(spark, rows, clash=True), fanout=2, depth=1) == brute(rows, 2)
    assert merkle.manifest(docs_of(spark, rows).limit(0)).collect() == []


def test_changed_texts_give_another_root(spark):
    rows = corpus(5, 60, 4)
    changed = F.when(F.col("doc_id") % 7 == 0, F.lit("other")).otherwise(F.col("text"))
    out = merkle.manifest(docs_of(spark, rows), changed, fanout=4, depth=1)
    out = out.withColumn("back", merkle.folded(F.col("changed_leaf"), F.col("proof"))).collect()
    assert len(out) == 60 and all((r.back == r.root) == (r.doc_id % 7 != 0) for r in out)


def test_query_on_whole_texts(spark, folder):
    rows = corpus(9, 400, 20) + [(None, "NO ID", "en", None), (-5, None, None, None), (1000, "ABC " * 30000, "en", "src1")]
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    out = {r.doc_id: r for r in op12_merkle_manifest(spark, folder).collect()}
    want = {r[0]: r for r in brute(rows, 16)}
    texts = {r[0]: r for r in rows}
    assert len(out) == len(rows)
    for doc_id, r in out.items():
        _, _, _, node, subroot, root, proof = want[doc_id]
        assert (r.leaf, r.subroot, r.root) == (node, subroot, root)
        assert r.proof_sha256 == h("".join(a + b for a, b in proof))
        _, text, lang, source = texts[doc_id]
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text:
            node = leaf(doc_id, text.lower(), lang, source)
        for left, right in proof:
            node = h(left + node + right)
        assert (r.folded_root, r.verified) == (node, node == root)
    assert {r.verified for r in out.values()} == {True, False}
