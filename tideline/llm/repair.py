"""Conversation structure repair with a suffix-shared automaton.

A conversation's rows become a signature, one symbol per row: its role's initial and whether it
must go or was cut off. The cheapest repair of what is left depends on the rest of the signature
and on the state of the grammar ``(s?(ua)+)?`` alone, so equal endings are one node of an
automaton. Signatures are sorted by their endings: each shares the nodes of its longest
common ending with the one before, which are at hand, and a node that sorting leaves behind
is never needed again. So a node's costs are worked out once for all conversations (once
more where a range partition begins), and a worker keeps one signature's path.

A node holds, for each state, the cost-to-go and the first edit of the best audit. The edits
that a node allows begin with different letters, so equal costs are decided by that letter
alone, and the audit of a signature is read off by walking its path.

A conversation may hold any share of the rows: its rows are streamed in order through one
task, which keeps one symbol per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import shuffle_parts
from tideline.session import stored

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
#: What a row that was cut off adds where it stays.
TRUNCATED = 3
#: Adjacent initials that the grammar allows.
LEGAL = {"su", "ua", "au"}
#: States: nothing yet, after system, after user, after assistant. Where a symbol leads from each; None: nowhere.
STEPS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None,) * 4}
#: The role that the grammar wants next, with an insertion or another role, and where it leads.
NEXT = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
ROLES = {"u": "user", "a": "assistant"}
#: Costs of ending in a state; INFINITE can't end there.
INFINITE = 1 << 60
#: ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"
#: Symbols of rows that must go whatever their role.
GONE = "x"


def with_insertions(plain: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Each state's best (cost, first letter) if rows may be inserted before the next edit.

    ``plain`` has the best without. Two insertions in a row lead back to where one was, so
    from the two states that alternate one insertion at most is of use.
    """
    more = lambda there: (there[0] + COSTS[INSERT], INSERT)
    user = min(plain[2], more(plain[3]))
    assistant = min(plain[3], more(plain[2]))
    return [min(plain[0], more(user)), min(plain[1], more(user)), user, assistant]


END = with_insertions([(0, ""), (INFINITE, ""), (INFINITE, ""), (0, "")])


def before(symbol: str, node: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The node of a symbol followed by what ``node`` stands for.

    Small letters are whole rows of that initial, capitals rows that were cut off.
    """
    plain = []
    extra = TRUNCATED if symbol.isupper() else 0
    for state in range(4):
        edits = [(node[state][0] + COSTS[DELETE], DELETE)]
        if symbol != GONE:
            kept = STEPS[symbol.lower()][state]
            if kept is not None:
                edits.append((node[kept][0] + COSTS[KEEP] + extra, KEEP))
            edits.append((node[NEXT[state][1]][0] + COSTS[REROLE] + extra, REROLE))
        plain.append(min(edits))
    return with_insertions(plain)


class Automaton:
    """The path of the last signature; signatures come sorted by their reversed text."""

    def __init__(self):
        self.ending, self.path, self.made = "", [END], 1

    def repair(self, ending: str) -> tuple[int, str]:
        """The least cost and the best audit of a signature, given reversed."""
        common, most = 0, min(len(ending), len(self.ending))
        while common < most and ending[common] == self.ending[common]:
            common += 1
        del self.path[common + 1 :]
        for symbol in ending[common:]:
            self.path.append(before(symbol, self.path[-1]))
        self.made += len(ending) - common
        self.ending = ending
        state, audit = 0, []
        for at in range(len(ending), -1, -1):
            node = self.path[at]
            while node[state][1] == INSERT:
                audit.append(INSERT)
                state = NEXT[state][1]
            edit = node[state][1]
            if at:
                audit.append(edit)
                if edit == KEEP:
                    state = STEPS[ending[at - 1].lower()][state]
                elif edit == REROLE:
                    state = NEXT[state][1]
        return self.path[-1][0][0], "".join(audit)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton, last, found = Automaton(), None, None
    for batch in batches:
        costs, audits, made = [], [], []
        for ending in batch.column("ending").to_pylist():
            had = automaton.made
            if ending != last:
                found, last = automaton.repair(ending), ending
            costs.append(found[0])
            audits.append(found[1])
            made.append(automaton.made - had)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", *COUNTS)), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(made, pa.int64())],
            ["conv_id", *COUNTS, "cost", "audit", "nodes"],
        )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


class _Signature:
    """Symbols and counts of one conversation, row by row."""

    def __init__(self, conv_id):
        self.conv_id, self.symbols, self.counts = conv_id, [], dict.fromkeys(COUNTS, 0)
        self.first = self.last = self.initial = None
        self.turns = 0

    def add(self, turn, initial: str, fault: str) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.initial = initial
        self.symbols.append(GONE if fault in ("blank", "duplicate") else initial.upper() if fault else initial)

    def row(self) -> tuple:
        if self.turns:
            self.counts["gaps"] = self.last - self.first + 1 - self.turns
        return (self.conv_id, *self.counts.values(), "".join(reversed(self.symbols)))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, counts, ending) of rows that come by conversation and in order."""

    def out(rows):
        columns = list(zip(*rows))
        kinds = [pa.int64()] * 6 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", *COUNTS, "ending"])

    current = None
    for batch in batches:
        done = []
        for conv_id, turn, there, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "there", "initial", "fault"))):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Signature(conv_id)
            if there:
                current.add(turn, initial, fault)
        if done:
            yield out(done)
    if current is not None:
        yield out([current.row()])


class _Repaired:
    """The repaired text of one conversation, hashed as its rows come by."""

    def __init__(self, conv_id, audit: str):
        self.conv_id, self.audit, self.at, self.state = conv_id, audit, 0, 0
        self.hash, self.lines = hashlib.sha256(), 0

    def write(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == INSERT:
            wanted, self.state = NEXT[self.state]
            self.write(ROLES[wanted], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self.state = STEPS[role[0]][self.state]
            self.write(role, text)
        elif edit == REROLE:
            wanted, self.state = NEXT[self.state]
            self.write(ROLES[wanted], text)

    def done(self) -> tuple:
        self.insertions()
        return self.conv_id, self.lines, self.hash.hexdigest()


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, lines, repaired_sha256): an audit comes first, then its conversation's rows."""

    def out(rows):
        ids, lines, digests = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(lines, pa.int64()), pa.array(digests, pa.string())], ["conv_id", "lines", "repaired_sha256"]
        )

    current = None
    for batch in batches:
        done = []
        for conv_id, head, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "head", "role", "text"))):
            if head:
                if current is not None:
                    done.append(current.done())
                current = _Repaired(conv_id, text)
            else:
                current.row(role, text)
        if done:
            yield out(done)
    if current is not None:
        yield out([current.done()])


def repaired(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conv_id: counts, cost, audit, nodes, lines and repaired_sha256.

    ``rows`` has conv_id and turn (integers), role and text; other columns are not read. Where
    ``present`` is false a row only names its conversation. Null role and text are one
    space; null turns come first and count in no gap; null conv_id is a conversation of its own.
    Rows of one turn are ordered by role and the digest of role and text; equal rows
    lie side by side. A conversation without rows has zeros, an empty audit and the
    digest of nothing; an empty table gives no rows. ``nodes`` is how many nodes of the
    automaton were made for a row, ``lines`` how many rows the repaired conversation has.
    """
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    plain = rows.select("conv_id", "turn", there.alias("there"), role.alias("role"), text.alias("text"))
    # Lengths keep role and text apart.
    same = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    plain = plain.withColumn("same", same)
    order = ("turn", "role", "same")
    filled = F.rtrim("text", F.lit(BLANKS))
    last = F.right(filled, F.lit(1))
    initial = F.substring("role", 1, 1)
    slim = plain.select(
        "conv_id", "turn", "there", "same", "role",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        F.when(filled == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("").alias("own_fault"),
    )
    # The rows of a conversation are already together, so only a sort comes in between.
    copies = F.row_number().over(Window.partitionBy("conv_id", "there", "same").orderBy("turn"))
    dealt = slim.repartition(shuffle_parts(rows.sparkSession), "conv_id").withColumn("copy", copies)
    fault = F.when((F.col("own_fault") != "blank") & (F.col("copy") > 1), "duplicate").otherwise(F.col("own_fault"))
    signatures = (
        dealt.withColumn("fault", fault).sortWithinPartitions("conv_id", *order)
        .select("conv_id", "turn", "there", "initial", "fault")
        .mapInArrow(_signed, f"conv_id long, {', '.join(f'{c} long' for c in COUNTS)}, ending string")
    )
    signatures = stored(signatures, "signatures")
    # Equal signatures are spread by their conversations' hashes, so a common one fills several ranges.
    spread = F.xxhash64("conv_id")
    by_ending = signatures.repartitionByRange(shuffle_parts(rows.sparkSession), "ending", spread).sortWithinPartitions("ending")
    audits = stored(
        by_ending.mapInArrow(_audited, f"conv_id long, {', '.join(f'{c} long' for c in COUNTS)}, cost long, audit string, nodes long"),
        "audits",
    )
    empty = F.lit("")
    heads = audits.select(
        "conv_id", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), empty.alias("role"), F.col("audit").alias("text"), empty.alias("same")
    )
    bodies = plain.filter("there").select("conv_id", F.lit(False).alias("head"), F.col("turn").cast("long").alias("turn"), "role", "text", "same")
    texts = heads.unionByName(bodies).repartition(shuffle_parts(rows.sparkSession), "conv_id")
    texts = texts.sortWithinPartitions("conv_id", F.col("head").desc(), *order).select("conv_id", "head", "role", "text")
    written = texts.mapInArrow(_written, "conv_id long, lines long, repaired_sha256 string")
    same_id = audits["conv_id"].eqNullSafe(written["conv_id"])
    return audits.join(written, same_id).drop(written["conv_id"])


def damaged(turns: DataFrame, share: int = 20) -> DataFrame:
    """Faults for tests of a repair, by crc32 of ``conv_id:turn`` modulo ``share``.

    0 drops the row, 1 empties its text, 2 takes its sentence ends out, 3 repeats it, 4 makes
    its role user. Returns conv_id, turn, role, text and ``present``: dropped rows stay
    to name their conversation. Nulls are one space, but for conv_id and turn as such.
    """
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    chosen = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")) % share
    rows = turns.select("conv_id", "turn", written("role").alias("role"), written("text").alias("text"), chosen.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    present = (F.col("fault") != 0).alias("present")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), present, F.explode(times).alias("_copy")).drop("_copy")
