import random
import re

from tests.llm.helpers import awkward, docs_of
from tideline.llm import fertility

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), n < 20 or 100 * len(hit) > 30 * n)


def figures(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_base_figures_against_python(spark):
    rng = random.Random(2)
    texts = ["a b c d e f g h " * 5, "x y z \x1c\x85 é😀", "one\n\none\n one\none", "#*$%&|<> a|b\r\n\x0b\x0c"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) + "\n" * rng.randrange(3) + "tail" for _ in range(60)]
    texts += [" ".join(rng.choice("abcdefgh") + rng.choice("\n ") for _ in range(300)) for _ in range(10)]
    got = fertility.judged(docs_of(spark, texts, clash=True)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert figures(r) == base(texts[r["keys"].doc_id])


def test_awkward(spark):
    rows = awkward(400)
    got = fertility.judged(docs_of(spark, rows, clash=True)).collect()
    assert sorted(map(str, (figures(r) for r in got))) == sorted(str(base(t)) for _, t, _, _ in rows)
    assert fertility.judged(docs_of(spark, rows).limit(0)).count() == 0


def prose(rng, n=120):
    words = "the of house stands with many open windows near green garden while people walk along quiet streets today".split()
    return " ".join(rng.choice(words) for _ in range(n))


def test_bands_reject_odd_tokens_and_keep_clean_text(spark):
    rng = random.Random(3)
    docs = [(i, prose(rng), "en" if i % 2 else None, "s") for i in range(300)]
    odd = {1000: " ".join("".join(rng.choice("qxzjkvw0123456789") for _ in range(12)) for _ in range(60)),
           1001: " ".join(chr(0x13000 + rng.randrange(900)) * 3 for _ in range(80))}
    docs += [(i, t, "en", "s") for i, t in odd.items()]
    got = {r["keys"].doc_id: r for r in fertility.judged(docs_of(spark, docs)).collect()}
    assert not got[1000].kept and not got[1001].kept and got[1001].n_bytes[0] > 100
    assert all(got[i].kept for i in range(300))
    assert {got[i].group for i in range(300)} == {"en", "script:latin"}
    assert {r.doc_id for r in fertility.accepted(docs_of(spark, docs)).collect()} == set(range(300))


def noise(rng, n=60):
    return " ".join("".join(rng.choice("qxzjkvw0123456789") for _ in range(12)) for _ in range(n))


def test_bands_hold_where_a_source_has_texts_of_another_kind(spark):
    rng = random.Random(4)
    docs = [(i, prose(rng), "en", "s") for i in range(200)]
    docs += [(1000 + i, " ".join(f"x[{rng.randrange(10)}]=f(y{rng.randrange(10)});" for _ in range(100)), "en", "hot") for i in range(100)]
    docs += [(2000 + i, noise(rng, 22), "en", "s") for i in range(3)]
    got = {r["keys"].doc_id: r for r in fertility.judged(docs_of(spark, docs)).collect()}
    assert all(got[i].kept for i in range(200))
    assert not any(got[2000 + i].kept or got[2000 + i].base_failed for i in range(3))


def test_a_lone_length_is_compared_with_its_neighbours(spark):
    rng = random.Random(5)
    docs = [(i, prose(rng, rng.randrange(60, 120)), "en", "s") for i in range(100)]
    # Six words in random order: as usual in characters per token, low in entropy.
    dull = (1000, " ".join(rng.choice("house stands green many walk streets".split()) for _ in range(3000)), "en", "s")
    got = {r["keys"].doc_id: r for r in fertility.judged(docs_of(spark, [*docs, dull, (1001, prose(rng, 3000), "en", "s")])).collect()}
    assert all(got[i].kept for i in range(100)) and got[1001].kept
    assert not got[1000].kept and not got[1000].base_failed


def test_length_pools(spark):
    counts = [("a", 5, 10), ("a", 6, 45), ("a", 7, 60), ("a", 9, 30), ("a", 12, 1), ("b", 3, 2), ("b", 8, 1)]
    got = fertility.length_pools(spark.createDataFrame(counts, "group string, bits int, count long"), 50).collect()
    assert sorted(map(tuple, got)) == [("a", 5, 5), ("a", 6, 5), ("a", 7, 7), ("a", 9, 7), ("a", 12, 7), ("b", 3, 3), ("b", 8, 3)]


def test_a_full_cache_changes_nothing(monkeypatch):
    texts = [f"word{i} other{i % 7} again" for i in range(40)]
    paths = [fertility.public_tokenizers.path(v) for v in fertility.VOCABULARIES]
    want = [c.to_pylist() for c in fertility._measured(texts, [None] * 40, fertility.Measure(paths))]
    monkeypatch.setattr(fertility, "CACHE_WORDS", 5)
    measure = fertility.Measure(paths)
    for _ in range(3):
        assert [c.to_pylist() for c in fertility._measured(texts, [None] * 40, measure)] == want
    assert len(measure.words) == 121 - 33 or len(measure.words) > 5
