import random

import numpy as np
import public_tokenizers
import pytest

from tests.llm.helpers import awkward, docs_of
from tideline.llm import tree_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TOK = tree_bpe.tokenizer(PATH)


def library(text):
    ids = TOK.encode(text, add_special_tokens=False).ids
    return ids, TOK.decode(ids, skip_special_tokens=False)


def compare(df, texts):
    got = tree_bpe.encode(df, PATH, piece_chars=64).collect()
    assert len(got) == len(texts)
    for r in got:
        ids, decoded = library(texts[r["keys"].doc_id] or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == decoded


def unsplit(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_long_unsplit_words_come_out_as_from_the_library(spark):
    rng = random.Random(5)
    alphabets = ["ab", "the", "a", "0123456789", "!?'s", "don't've", "éàß", "日本語の", "éö", "İΣς", "😀👍🏽", "a b "]
    texts = [unsplit(rng, a, n) for a in alphabets for n in (63, 65, 500, 2000)]
    texts += ["<|endoftext|>" * 40, "x" * 60 + "<|startoftext|>" + "y" * 200 + " z <|endoftext|>"]
    texts += ["word " * 5 + unsplit(rng, "abcdefghij", 700) + " tail " + unsplit(rng, "the of", 300)]
    compare(docs_of(spark, texts, clash=True), texts)


def test_many_random_joins_without_spark():
    rng = random.Random(9)
    for _ in range(300):
        text = unsplit(rng, rng.choice(["ab", "thein", "a!'s1", "aéÀ́", "ing"]), rng.randrange(20, 400))
        parts = [(p, tree_bpe.encoded_at(p, TOK)) for p in tree_bpe.pieces(text, 20)]
        assert tree_bpe.concatenate(parts, TOK)[:, 0].tolist() == library(text)[0]


def test_awkward_rows(spark):
    rows = awkward(300)
    got = tree_bpe.encode(docs_of(spark, rows, clash=True), PATH).collect()
    want = sorted(str((r[0], library(r[1] or ""))) for r in rows)
    assert sorted(str((r["keys"].doc_id, (np.frombuffer(r.ids, "<u4").tolist(), r.decoded))) for r in got) == want
    assert tree_bpe.encode(docs_of(spark, rows).limit(0), PATH).count() == 0


def test_a_full_cache_changes_nothing(spark, monkeypatch):
    texts = [f"word{i} other{i % 7}" for i in range(50)]
    monkeypatch.setattr(tree_bpe, "CACHE_WORDS", 0)
    batch = tree_bpe.pa.RecordBatch.from_pydict({"keys": list(range(50)), "text": texts})
    run = tree_bpe._encode_short(PATH)
    for _ in range(2):
        out = next(run(iter([batch])))
        assert out.column("decoded").to_pylist() == [library(t)[1] for t in texts]


def test_tokenizers_that_keep_space_are_refused(spark):
    with pytest.raises(ValueError):
        tree_bpe.encode(docs_of(spark, ["a"]), public_tokenizers.path("byte_bpe_50k.json"))
