import random

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, docs_of
from tideline.llm import langid

WORDS = {"en": "the house stands with many open windows", "de": "das haus steht mit vielen offenen fenstern über",
         "fr": "la maison se dresse avec beaucoup de fenêtres ouvertes"}


def corpus(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choices(WORDS[lang].split(), k=rng.randrange(2, 30))), lang, "s"))
    return out


def test_held_out_accuracy_and_no_peeking(spark):
    docs = corpus(400)
    got = {r["keys"].doc_id: r for r in langid.held_out(docs_of(spark, docs, clash=True)).collect()}
    assert len(got) == 400
    fold = [r for r in got.values() if r["keys"].held_out]
    assert 50 < len(fold) < 150
    assert sum(got[i].lang_pred == lang for i, _, lang, _ in docs) / 400 > 0.97
    # The languages of the held-out fold have no effect.
    other = [(i, t, "xx" if got[i]["keys"].held_out else lang, "s") for i, t, lang, _ in docs]
    again = {r["keys"].doc_id: (r.lang_pred, r.score) for r in langid.held_out(docs_of(spark, other)).collect()}
    assert again == {i: (r.lang_pred, r.score) for i, r in got.items()}


def test_filter_returns_all_languages_of_an_ngram(spark):
    model = langid.fit(docs_of(spark, corpus(300)))
    the = langid.grams(["mit"])[0][1:2]
    mask = model.bits[langid.slots(the)[0], 0] & model.bits[langid.slots(the)[1], 0] & model.bits[langid.slots(the)[2], 0]
    assert model.languages == ["de", "en", "fr"] and int(mask[0]) == 1
    crowded = langid.fit(docs_of(spark, corpus(300)), size=256)
    assert (crowded.false > 0.0001).any()
    names, scores = crowded.predict(["das haus steht", "the house stands"])
    assert names == ["de", "en"] and all(0 <= s <= 1 for s in scores)


def test_awkward(spark):
    rows = awkward(200)
    got = langid.identify(docs_of(spark, rows, clash=True), langid.fit(docs_of(spark, rows))).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got if r["keys"].doc_id in (1, 2, 5)} == {"und"}
    assert all(r.lang_pred in ("en", "de") for r in got if r["keys"].doc_id in (3, 4, 6, 7))
    empty = docs_of(spark, rows).limit(0)
    nothing = langid.fit(empty)
    assert langid.identify(empty, nothing).count() == 0
    assert {r.lang_pred for r in langid.identify(docs_of(spark, ["abc"]), nothing).collect()} == {"und"}


def test_more_than_64_languages(spark):
    docs = [(i, " ".join([chr(0x4E00 + 50 * (i % 70) + k) * 3 for k in range(5)]), f"l{i % 70:02}", "s") for i in range(210)]
    got = langid.held_out(docs_of(spark, docs)).withColumn("want", F.concat(F.lit("l"), F.lpad((F.col("keys.doc_id") % 70).cast("string"), 2, "0")))
    assert got.filter("lang_pred = want").count() == 210


def test_predictions_hold_as_distinct_ngrams_grow(spark):
    rng = random.Random(5)
    zh = [(1000 + i, "".join(chr(0x4E00 + rng.randrange(20000)) for _ in range(6000)), "zh", "s") for i in range(200)]
    model = langid.fit(docs_of(spark, corpus(300) + zh))
    assert isinstance(model.bits, langid.MappedBits) and len(model.bits) > 1 << 24
    assert model.false.max() < 0.01
    texts = ["the hause stamds opem", "das hius stehd offenem", "la maisom dressu avec", zh[0][1][:9]]
    assert model.predict(texts)[0] == ["en", "de", "fr", "zh"]
    got = langid.identify(docs_of(spark, [(i, t, None, "s") for i, t in enumerate(texts)]), model).collect()
    assert {r["keys"].doc_id: r.lang_pred for r in got} == dict(enumerate(["en", "de", "fr", "zh"]))


def test_mapped_and_collected_filters_agree(spark, monkeypatch):
    docs = [(i, t, f"{lang}{i % 25}", "s") for i, t, lang, _ in corpus(300)]
    texts = [t for _, t, _, _ in docs[:50]]
    want = langid.fit(docs_of(spark, docs))
    assert len(want.languages) > 64
    monkeypatch.setattr(langid, "COLLECTED", 0)
    monkeypatch.setattr(langid, "SHARD_BYTES", 5 << 20)
    got = langid.fit(docs_of(spark, docs))
    assert isinstance(got.bits, langid.MappedBits) and (got.false == want.false).all()
    assert got.predict(texts) == want.predict(texts)


VOCABULARY = "the house stands with many open windows and old doors near river where people walk every day".split()


def sentences(n, words, lang, first, seed=3):
    rng = random.Random(seed)
    return [(first + i, " ".join(rng.choices(words, k=12)), lang, "s") for i in range(n)]


def test_labels_of_a_few_lines_take_nothing_from_a_large_language(spark):
    texts = [t for _, t, _, _ in sentences(200, VOCABULARY, "en", 0, seed=8)]
    lines = [(5000 + k, " ".join(VOCABULARY[3 * k : 3 * k + 3]), f"x{k}", "s") for k in range(6)]
    train = sentences(300, VOCABULARY, "en", 0) + lines
    assert sum(n != "en" for n in langid.fit(docs_of(spark, train)).predict(texts)[0]) < 5
    # Without text unseen such labels win nearly everywhere.
    assert sum(n != "en" for n in langid.fit(docs_of(spark, train), unseen=0).predict(texts)[0]) > 100


def test_a_rare_language_of_its_own_words_is_still_found(spark):
    rare = WORDS["de"].split()
    model = langid.fit(docs_of(spark, sentences(2000, VOCABULARY, "en", 0) + sentences(3, rare, "de", 9000)))
    texts = [t for _, t, _, _ in sentences(50, rare, "de", 0, seed=9)]
    assert model.predict(texts)[0] == ["de"] * 50


def test_wrong_labels(spark):
    for share in (0.01, 0.05):
        rng = random.Random(6)
        docs = corpus(600)
        noisy = [(i, t, rng.choice(list(WORDS)) if rng.random() < share else lang, s) for i, t, lang, s in docs]
        got = {r["keys"].doc_id: r.lang_pred for r in langid.held_out(docs_of(spark, noisy)).collect()}
        assert sum(got[i] == lang for i, _, lang, _ in docs) / 600 > 0.97


def test_ties_go_to_the_larger_language(spark):
    model = langid.fit(docs_of(spark, [(1, "same words here", "aa", "s")] + [(2 + i, "same words here", "zz", "s") for i in range(2)]), unseen=0)
    assert model.predict(["same words"])[0] == ["zz"]
