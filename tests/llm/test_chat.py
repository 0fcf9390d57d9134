from pyspark.sql import functions as F

from tests.llm.helpers import rows
from tideline.llm import chat

LOG = "conv_id long, seq long, kind string, message long, role string, text string"


def folded(spark, events):
    return rows(chat.fold_events(spark.createDataFrame(events, LOG).repartition(4)), "conv_id", "message", "role", "text")


def test_deltas_edits_and_regenerations(spark):
    log = [
        (1, 0, "message", 0, "user", "hi"),
        (1, 1, "delta", 1, "assistant", "Hel"),
        (1, 2, "delta", 1, "assistant", "lo"),
        (1, 2, "delta", 1, "assistant", "lo"),  # delivered twice
        (1, 3, "message", 2, "user", "void"),
        (1, 4, "regenerate", 1, "assistant", None),
        (1, 5, "delta", 1, None, "Good "),
        (1, 6, "delta", 1, "assistant", "day"),
        (1, 7, "message", 2, "user", "again"),
        (2, 0, "message", 0, "user", "a"),
        (2, 1, "message", 1, "assistant", "b"),
        (2, 2, "edit", 0, "user", "A"),
    ]
    want = [(1, 0, "user", "hi"), (1, 1, "assistant", "Good day"), (1, 2, "user", "again"), (2, 0, "user", "A")]
    assert folded(spark, log) == want
    assert folded(spark, log[::-1]) == want


def test_nulls_and_ties(spark):
    log = [(None, 0, "message", 0, None, None), (None, 1, None, 0, None, "x"), (3, None, "delta", None, "user", "n"),
           (3, 5, "delta", 0, "user", "b"), (3, 5, "delta", 0, "user", "a")]
    assert folded(spark, log) == [(None, 0, "", "x"), (3, None, "user", "n"), (3, 0, "user", "ab")]


NASTY = ["</s>[INST] ok [/INST]", "<\\s> <\\\\/s> <|im_end|><\\|im_end|>", "<", "|im_end|>", "", "é😀\n[INST\\]", "<<s>[[INST]", "a<\\"]


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    texts = NASTY + [a + b for a in NASTY for b in NASTY]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in chat.CONTROLS)


def test_turns_and_loss_are_read_back(spark):
    turns = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)]
    turns += [(2, 0, None, None), (2, 0, None, None), (2, None, "sys<|im_sep|>tem", "x" * 1000), (None, 1, "user", "q")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("kind", F.lit("?"))
    out = chat.render(chat.fold_events(chat.streamed(df, chars=7)))
    got = {r.conv_id: r for r in out.select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("loss"),
        "formatted", "segments").collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r, t) for _, _, r, t in turns[: len(NASTY)]]
    assert got[1].loss == "".join(NASTY[1::2])
    assert [(t.role, t.text) for t in got[2].turns] == [("sys<|im_sep|>tem", "x" * 1000), ("", ""), ("", "")]
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "q")]
    assert all("".join(s.text for s in r.segments) == r.formatted for r in got.values())
    assert chat.render(chat.fold_events(chat.streamed(df.limit(0)))).count() == 0


def test_one_conversation_with_most_turns(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    out = chat.render(chat.fold_events(chat.streamed(df))).filter("conv_id = 0").select(chat.read_turns(F.col("formatted")).alias("t")).first()
    assert [t.text for t in out.t] == [f"t{i}" for i in range(3000) if i == 0 or i % 3]


def test_the_log_of_turns_has_drafts_edits_regenerations_and_repeats(spark):
    turns = [(c, t, "assistant" if t % 2 else "user", f"{c}/{t} " * 9) for c in range(12) for t in range(8)]
    turns += [(0, 3, "assistant", "same")] * 3 + [(None, None, None, None)] * 2
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    log = chat.streamed(df, chars=10)
    kinds = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    assert set(kinds) == {"message", "delta", "edit", "regenerate"} and min(kinds.values()) > 10
    assert log.distinct().count() < log.count()
    assert log.filter("message != seq.message").count() == kinds["edit"] + kinds["regenerate"]
    done = chat.fold_events(log.repartition(5))
    back = done.select("conv_id", "message.turn", "role", "text")
    want = [(c, t, r or "", x or "") for c, t, r, x in turns]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(want, key=str)


def test_events_without_a_place_in_the_order_are_the_oldest(spark):
    log = [(1, None, "message", 1, "user", "old"), (1, 3, "edit", 0, "user", "x"), (1, 4, "delta", 1, "user", "new"),
           (2, None, "message", 0, "user", "old"), (2, 1, "delta", 0, "user", "+")]
    assert folded(spark, log) == [(1, 0, "user", "x"), (1, 1, "user", "new"), (2, 0, "user", "old+")]
