"""Benchmark decontamination with an FM-index per shard of training documents.

Each task gathers its documents into shards of about ``SHARD_WORDS`` words and indexes
one at a time. A word that no test item has ends a match, so what is indexed are the
stretches between such words that are as long as the shortest window. Suffixes of the
word sequence are sorted, the Burrows-Wheeler transform goes into a wavelet matrix, and
every 32nd place is sampled. All windows of the test items are searched backwards at
once, a word at a time; the occurrences left are located by walking to sampled places,
and their words are merged into spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import slices, text_of

WINDOW = 10
SHARD_WORDS = 1 << 19
SAMPLE = 32
#: Bytes of test items searched in one pass; more items mean more passes, not a larger one.
BLOCK_BYTES = 32 << 20
#: A word: anything but ASCII other than digits and letters, after lower-casing A-Z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes, by doubling; each round sorts only what is still tied.

    The last symbol of each document must be different from all others.
    """
    n = len(symbols)
    bits = int(max(n, symbols.max(initial=0)) + 1).bit_length()
    rank = np.concatenate([symbols.astype(np.uint64), np.zeros(1, np.uint64)])
    active = np.arange(n, dtype=np.uint64)
    step, first = 1, True
    while len(active):
        follow = rank[np.minimum(active + np.uint64(step), np.uint64(n))]
        if 3 * bits <= 64:
            packed = (rank[active] << np.uint64(2 * bits)) | (follow << np.uint64(bits)) | active
            packed.sort()
            active = packed & np.uint64((1 << bits) - 1)
            key = packed >> np.uint64(bits)
            group = key >> np.uint64(bits)
            changed = np.concatenate([[True], key[1:] != key[:-1]])
        else:
            order = np.lexsort((follow, rank[active]))
            active, follow = active[order], follow[order]
            group = rank[active]
            changed = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        place = np.arange(len(active))
        start = np.maximum.accumulate(np.where(changed, place, 0))
        if first:
            new = start
        else:
            fresh = np.concatenate([[True], group[1:] != group[:-1]])
            new = group.astype(np.int64) + start - np.maximum.accumulate(np.where(fresh, place, 0))
        rank[active] = new.astype(np.uint64)
        single = changed & np.concatenate([changed[1:], [True]])
        active = active[~single]
        step, first = 2 * step, False
    return rank[:-1].astype(np.int64)


class Wavelet:
    """Ranks of symbols in a sequence, a bit level at a time from the highest."""

    def __init__(self, symbols: np.ndarray, highest: int):
        self.levels = max(1, highest.bit_length())
        self.ones, self.zeros = [], []
        s = symbols.astype(np.int32)
        for level in range(self.levels - 1, -1, -1):
            bit = (s >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(s) - int(self.ones[-1][-1]))
            up = bit.astype(bool)
            s = np.concatenate([s[~up], s[up]])

    def rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """Occurrences of each symbol before each of its places."""
        at = np.stack([np.zeros_like(symbol), *places])
        for i in range(self.levels):
            ones = self.ones[i][at]
            up = ((symbol >> (self.levels - 1 - i)) & 1).astype(bool)
            at = np.where(up, self.zeros[i] + ones, at - ones)
        return [a - at[0] for a in at[1:]]


class Index:
    """An FM-index over stretches of word numbers (1 to ``highest``); 0 ends each."""

    def __init__(self, docs: list[np.ndarray], highest: int):
        lengths = np.array([len(d) for d in docs], np.int64) + 1
        text = np.concatenate([np.concatenate([d, [0]]) for d in docs]).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        ends = np.cumsum(lengths) - 1
        symbols = text + len(docs) - 1
        symbols[ends] = np.arange(len(docs))
        rank = suffix_order(symbols)
        self.size = len(text)
        places = np.empty(self.size, np.int64)
        places[rank] = np.arange(self.size)
        self.bwt = text[places - 1]
        self.wavelet = Wavelet(self.bwt, highest)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=highest + 1))])
        sampled = places % SAMPLE == 0
        sampled[rank[self.starts]] = True
        self.marks = np.concatenate([[0], np.cumsum(sampled, dtype=np.int32)])
        self.samples = places[sampled]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the windows that occur, and their ranges of suffixes."""
        alive = np.arange(len(windows))
        last = windows[:, -1]
        low, high = self.before[last], self.before[last + 1]
        for column in range(windows.shape[1] - 2, -1, -1):
            keep = low < high
            alive, low, high = alive[keep], low[keep], high[keep]
            if not len(alive):
                break
            word = windows[alive, column]
            low, high = (self.before[word] + r for r in self.wavelet.rank(word, low, high))
        keep = low < high
        return alive[keep], low[keep], high[keep]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of suffixes: steps back to the next sampled one are counted."""
        out, steps = np.zeros(len(rows), np.int64), 0
        left, at = np.arange(len(rows)), rows
        while len(left):
            known = self.marks[at + 1] > self.marks[at]
            out[left[known]] = self.samples[self.marks[at[known]]] + steps
            left, at = left[~known], at[~known]
            word = self.bwt[at]
            if len(at):
                at = self.before[word] + self.wavelet.rank(word, at)[0]
            steps += 1
        return out


class Phrases:
    """The distinct windows of a block of test items as word numbers, and the items of each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        by_window: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                by_window.setdefault(tuple(words[i : i + window]), set()).add(item)
        self.items = [sorted(s) for s in by_window.values()]
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, tuple[list, list]] = {}
        for w, words in enumerate(by_window):
            which, numbers = by_length.setdefault(len(words), ([], []))
            which.append(w)
            numbers.append([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words])
        #: Per window length: which windows, and their words.
        self.windows = [(np.array(a), np.array(b, np.int64)) for a, b in by_length.values()]
        self.shortest = min(by_length, default=0)


def search_shard(texts: list[list[bytes]], phrases: Phrases, most: int = 1 << 20) -> tuple[list, list]:
    """Per document: merged spans of hit words, and the items found."""
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    number = phrases.vocabulary.get
    lengths = np.array([len(t) for t in texts], np.int64) + 1
    starts = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.zeros(int(starts[-1]) + 1, np.int64)
    for a, words in zip(starts, texts):
        flat[a : a + len(words)] = [number(w, 0) for w in words]
    turns = np.flatnonzero(np.diff(np.concatenate([[False], flat > 0])))
    begin, end = turns[::2], turns[1::2]
    long = end - begin >= max(1, phrases.shortest)
    begin, end = begin[long], end[long]
    if not len(begin) or not phrases.windows:
        return spans, items
    index = Index([flat[a:b] for a, b in zip(begin, end)], len(phrases.vocabulary))
    edges = np.zeros(len(flat) + 1, np.int64)
    for which, windows in phrases.windows:
        alive, low, high = index.search(windows)
        counts = high - low
        ends = np.cumsum(counts)
        for first in range(0, int(ends[-1]) if len(ends) else 0, most):
            row = np.arange(first, min(first + most, int(ends[-1])))
            of = np.searchsorted(ends, row, "right")
            places = index.locate(low[of] + row - (ends[of] - counts[of]))
            stretch = np.searchsorted(index.starts, places, "right") - 1
            places = places - index.starts[stretch] + begin[stretch]
            np.add.at(edges, places, 1)
            np.add.at(edges, places + windows.shape[1], -1)
            doc = np.searchsorted(starts, places, "right") - 1
            for d, w in np.unique(np.column_stack([doc, which[alive[of]]]), axis=0).tolist():
                items[d].update(phrases.items[w])
    hit = np.cumsum(edges[:-1]) > 0
    turns = np.flatnonzero(np.diff(np.concatenate([[False], hit])))
    for a, b in turns.reshape(-1, 2).tolist():
        d = int(np.searchsorted(starts, a, "right")) - 1
        spans[d].append([a - int(starts[d]), b - int(starts[d])])
    return spans, items


def merge_spans(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _search_pass(shared, shard_words: int, cut: bool):
    """Rows (keys, text, n_words, spans, items) with what this block's items add.

    With ``cut`` the text is given without the words of all spans.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        held: list[pa.RecordBatch] = []
        words: list[list[bytes]] = []
        total = 0

        def shard():
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            spans, items = search_shard(words, phrases)
            old_spans, old_items = rows.column("spans").to_pylist(), rows.column("items").to_pylist()
            spans = [merge_spans(a + b) for a, b in zip(old_spans, spans)]
            texts = rows.column("text")
            if cut:
                texts = pa.array([cut_words(t, s) for t, s in zip(texts.to_pylist(), spans)], pa.string())
            return pa.RecordBatch.from_arrays(
                [
                    rows.column("keys"), texts, pa.array([len(w) for w in words], pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array([sorted(b.union(a)) for a, b in zip(old_items, items)], pa.list_(pa.string())),
                ],
                ["keys", "text", "n_words", "spans", "items"],
            )

        for batch in slices(batches, most=1 << 20):
            held.append(batch)
            new = [words_of(t) for t in batch.column("text").to_pylist()]
            words += new
            total += sum(map(len, new)) + len(new)
            if total >= shard_words:
                yield shard()
                held, words, total = [], [], 0
        if held:
            yield shard()

    return run


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str | None]]]:
    """The test items (id as text, null as empty) in blocks of about ``most`` bytes."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_of().alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 1)).first()[0] or 0
    count = max(1, -(-int(size) // most))
    for k in range(count):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).collect()]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
    cut: bool = False,
) -> DataFrame:
    """Search all windows of ``benchmark`` (item_id, text) in the column ``text`` of ``docs``.

    Returns keys (struct of the other columns), text, n_words, spans (merged pairs of
    word numbers, end exclusive) and items (ids found, as text, sorted). An item of fewer
    words than ``window`` is one window, one without words none. Null text has no words;
    a null item id reads as empty; items that repeat count once; repeated documents are
    rows of their own. Nothing is shuffled. Test items go to the workers in blocks of a
    fixed size, each a pass over the documents in the same stage. With ``cut`` the text is
    given without the words of the spans and what stands between them.
    """
    spark = docs.sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*others).alias("keys"), text_of().alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.lit([]).cast("array<array<bigint>>").alias("spans"), F.lit([]).cast("array<string>").alias("items"),
    )
    schema = f"keys {rows.schema['keys'].dataType.simpleString()}, text string, n_words long, spans array<array<long>>, items array<string>"
    shared = [spark.sparkContext.broadcast(Phrases(b, window)) for b in blocks(benchmark, block_bytes)]
    last = shared[-1]
    return reduce(lambda df, b: df.mapInArrow(_search_pass(b, shard_words, cut and b is last), schema), shared, rows)


def cut_words(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    if not spans:
        return text
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join([*out, text[at:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without the words of test items; those with no other words go.

    n_chars is counted anew where a text changed.
    """
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    whole = docs.select(others.alias("row"), F.col("text").isNotNull().alias("has_text"), "text")
    found = contamination(whole, benchmark, cut=True)
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    left = found.filter((hits == 0) | (hits < F.col("n_words")))

    def column(name):
        if name == "text":
            return F.when(F.col("keys.has_text"), F.col("text")).alias("text")
        old = F.col(f"keys.row.`{name}`")
        new = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema[name].dataType)).otherwise(old)
        return (new if name == "n_chars" else old).alias(name)

    return left.select(*map(column, docs.columns))
