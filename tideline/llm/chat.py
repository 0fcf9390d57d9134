"""Chat formatting from event logs.

A log has rows (conv_id, seq, kind, message, role, text). ``message`` is the place of a
message in its conversation and ``seq`` the order of events; both are of any type that
can be ordered. Kinds: ``message`` sets a text, ``delta`` appends to it, ``edit`` replaces
it, ``regenerate`` starts it anew; after an edit or regeneration the conversation goes on
from there, so what later messages had gathered until then is void.

Everything is DataFrame expressions. Deltas are folded per message, so a conversation with
most of the events spreads over its messages; only its finished messages meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that mark turns in this format or in others; none of them survives inside a text.
CONTROLS = (START, MIDDLE, END, "<|startoftext|>", "<|endoftext|>", "<s>", "</s>", "<unk>", "[INST]", "[/INST]")
_RESTS = "|".join(c[1:].replace("|", r"\|").replace("]", r"\]") for c in CONTROLS)


def escape(text: Column) -> Column:
    """Put a backslash after the first character of each control string.

    One that has backslashes there already gets one more, which makes it reversible.
    """
    return F.regexp_replace(text, rf"([<\[])(\\*)({_RESTS})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_RESTS})", "$1$2$3")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log.

    Events of equal seq are taken in the order of kind, role and text; events equal in
    every column are one event delivered twice. Null text is empty, the last role that
    isn't null counts (none: empty); null ids form a conversation or message of their own,
    which comes first; an unknown kind is read as ``delta``. An event without seq is older than
    all others, so it is void behind any edit or regeneration. Columns beyond those named
    are not read.
    """
    event = F.struct("seq", "kind", F.col("role"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = F.col("kind").isin("edit", "regenerate")
    gathered = events.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_set(event)).alias("events"), F.max(F.when(cuts, F.col("seq"))).alias("cut")
    )
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    valid = gathered.withColumn("cut", F.max("cut").over(earlier)).withColumn(
        "events", F.filter("events", lambda e: F.col("cut").isNull() | (e["seq"] > F.col("cut")))
    )
    resets = F.transform("events", lambda e, i: F.when(e["kind"].isin("message", "edit", "regenerate"), i))
    body = F.slice("events", F.coalesce(F.array_max(resets), F.lit(0)) + 1, F.greatest(F.size("events"), F.lit(1)))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return valid.filter(F.size("events") > 0).select(
        "conv_id",
        "message",
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform(body, lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, and segments (text, loss) that make it up.

    Texts of the role ``learn`` are under the loss mask, all else is not.
    """
    block = F.struct(
        "message",
        F.concat(F.lit(START), escape(F.col("role")), F.lit(MIDDLE)).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == learn).alias("loss"),
        "role",
    )
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(block)).alias("turns"))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    segments = F.flatten(
        F.transform("turns", lambda t: F.array(piece(t["head"], no), piece(t["body"], t["loss"]), piece(F.lit(END), no)))
    )
    return turns.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column) -> Column:
    """Roles and texts read back from a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"\Q" + END + r"\E", -1), lambda b: b != "")

    def turn(block):
        parts = F.split(block, r"\Q" + MIDDLE + r"\E", -1)
        role = F.substring(parts[0], len(START) + 1, F.length(parts[0]))
        return F.struct(unescape(role).alias("role"), unescape(parts[1]).alias("text"))

    return F.transform(blocks, turn)


def learned_text(segments: Column) -> Column:
    """What stands under the loss mask, unescaped, without anything between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def streamed(turns: DataFrame, chars: int = 256) -> DataFrame:
    """The event log of a table of turns (conv_id, turn, role, text): texts arrive in deltas.

    Turns of one number are ordered by role and text; equal rows are turns of their own. A
    hash of the turn's place decides how it came about. A quarter each: a wrong draft with
    an answer to it, then an edit from which the text starts anew; a broken-off beginning, then a
    regeneration; every event delivered twice; straight on. Events of a turn come last one first.
    """
    text = F.coalesce("text", F.lit(""))
    copies = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    numbered = turns.select("conv_id", "turn", "role", text.alias("text")).withColumn("copy", F.row_number().over(copies))
    deltas = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{chars}}}"), F.lit(0))

    def event(kind: str, text: Column, ahead: int = 0) -> Column:
        """An event of the turn itself, or of the message ``ahead`` places behind it."""
        return F.struct(F.lit(kind).alias("kind"), F.lit(ahead).alias("ahead"), text.cast("string").alias("text"))

    rest = F.transform(deltas, lambda d: event("delta", d))
    draft = F.concat(F.substring("text", 1, 64), F.lit(END))
    void = event("message", F.lit(f"answer to a draft{START}"), 1)
    edited = F.array(event("message", draft), void, event("delta", draft), event("edit", F.lit("")))
    again = F.array(event("message", F.lit("")), event("delta", draft), void, event("regenerate", F.lit(None)))
    story = F.pmod(F.xxhash64("conv_id", "turn", "copy"), F.lit(4))
    begun = F.when(story == 0, edited).when(story == 1, again).otherwise(F.array(event("message", F.lit(""))))
    placed = F.transform(F.concat(begun, rest), lambda e, i: F.struct(i.alias("n"), e.alias("event")))
    sent = F.reverse(F.when(story == 2, F.concat(placed, placed)).otherwise(placed))
    message = lambda copy: F.struct("turn", copy.alias("copy"))
    return numbered.select("conv_id", "turn", "copy", "role", F.explode(sent).alias("sent")).select(
        "conv_id",
        F.struct(message(F.col("copy")).alias("message"), F.col("sent.n").alias("n")).alias("seq"),
        "sent.event.kind",
        message(F.col("copy") + F.col("sent.event.ahead")).alias("message"),
        "role",
        "sent.event.text",
    )
