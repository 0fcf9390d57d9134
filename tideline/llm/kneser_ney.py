"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Counting is three shuffles of packed blobs: word counts by word hash, bigram counts by
bigram hash, and what follows from the bigrams per word (continuations, followers). A
task adds up its own part first, so a common word is one entry per task. Each shard ends
as sorted hash arrays in the shared folder; workers map them into memory to score texts,
so the model's size is bound by the shared folder and not by a worker's memory.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrays import Sharded, added, mix, packed, save, shard_of, shared_folder, unmix, unpacked
from tideline.llm.common import fold_of, shuffle_parts, slices, text_of, worker_state

#: The token after the last word; no word contains white space.
END = b"\n"
#: Words a worker remembers the numbers of, at about 150 bytes each.
CACHE_WORDS = 1_000_000
#: Entries a task adds up before it passes them on.
HELD = 1 << 22
BLOBS = "shard int, kind string, keys binary, counts binary"


def tokens(text: str) -> list[bytes]:
    words = text.encode().lower().split()
    words.append(END)
    return words


def hashes_of(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def blobs(kind: str, keys: np.ndarray, values: list[np.ndarray], where: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted keys and their values, a row per shard; ``where`` are their shards, in order."""
    edges = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1], [True]])) if len(keys) else []
    for a, b in zip(edges, edges[1:]):
        counts = b"".join([len(p := packed(v[a:b])).to_bytes(8, "little") + p for v in values])
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(where[a])], pa.int32()), pa.array([kind]), pa.array([packed(keys[a:b])], pa.binary()), pa.array([counts], pa.binary())],
            ["shard", "kind", "keys", "counts"],
        )


def unblob(counts: bytes) -> list[np.ndarray]:
    out = []
    while counts:
        size = int.from_bytes(counts[:8], "little")
        out.append(unpacked(counts[8 : 8 + size]).astype(np.int64))
        counts = counts[8 + size :]
    return out


def gathered(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, str], tuple[np.ndarray, ...]]:
    """The blobs of a partition, added up per shard and kind."""
    held: dict[tuple[int, str], list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault((row["shard"], row["kind"]), []).append((unpacked(row["keys"]), *unblob(row["counts"])))
    return {k: added(*map(np.concatenate, zip(*parts))) for k, parts in held.items()}


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; where a count is lacking, half of the count itself."""
    y = ones / (ones + 2 * twos) if ones else 0.0
    out = []
    for k, (a, b) in enumerate(((ones, twos), (twos, threes), (threes, fours)), 1):
        d = k - (k + 1) * y * b / a if a and y else k / 2
        out.append(min(max(d, 0.0), float(k)))
    return tuple(out)


def discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


class Lexicon:
    """Numbers of words, from the mapped hashes and a bounded cache."""

    def __init__(self, folder: str, shards: int):
        self.table = Sharded(folder, "word", shards)
        self.cache: dict[bytes, int] = {}

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.cache.get
        found = [get(w, -2) for w in words]
        new = list({w for w, n in zip(words, found) if n == -2})
        if new:
            fresh = dict(zip(new, self.table.find(hashes_of(new)).tolist()))
            if len(self.cache) < CACHE_WORDS:
                self.cache.update(fresh)
            found = [fresh[w] if n == -2 else n for w, n in zip(words, found)]
        return np.array(found, np.int64)


class Mapped:
    """What scoring needs: words with their cache, and bigrams once they are written."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards
        self.words = Lexicon(folder, shards)

    @cached_property
    def bigrams(self) -> Sharded:
        return Sharded(self.folder, "bigram", self.shards)


def mapped(folder: str, shards: int) -> Mapped:
    return worker_state(("kneser-ney", folder), lambda: Mapped(folder, shards))


def numbered(texts: list[str], words: Lexicon, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: the number of the word before (``start`` at the start), its own, and its text."""
    split = [tokens(t) for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(s) for s in split])
    own = words.numbers([w for s in split for w in s])
    before = np.concatenate([[start], own[:-1]])
    before[np.concatenate([[True], doc[1:] != doc[:-1]])] = start
    return before, own, doc


def bigram_hash(before: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Word numbers are below 2**32, so different bigrams have different hashes."""
    return mix(before.astype(np.uint64) << np.uint64(32) | own.astype(np.uint64))


def _count_words(shards: int):
    def run(batches):
        held, size = [], 0

        def flush():
            keys, counts = added(*map(np.concatenate, zip(*held)))
            yield from blobs("word", keys, [counts], shard_of(keys, shards))

        for batch in slices(batches, most=8 << 20):
            counts: Counter = Counter()
            for text in batch.column("text").to_pylist():
                counts.update(tokens(text))
            held.append((hashes_of(list(counts)), np.fromiter(counts.values(), np.int64, len(counts))))
            size += len(counts)
            if size > HELD:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


def _write_words(folder: str):
    def run(batches):
        for (shard, _), (keys, counts) in gathered(batches).items():
            save(folder, f"word.{shard}", keys)
            save(folder, f"count.{shard}", counts)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(keys)]), pa.array([int(counts.sum())])], ["shard", "n", "total"])

    return run


def _count_bigrams(folder: str, shards: int, start: int):
    def run(batches):
        held, size = [], 0

        def flush():
            keys, counts = added(*map(np.concatenate, zip(*held)))
            yield from blobs("bigram", keys, [counts], shard_of(keys, shards))

        for batch in slices(batches):
            before, own, _ = numbered(batch.column("text").to_pylist(), mapped(folder, shards).words, start)
            pairs = np.sort(bigram_hash(before, own))
            first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            held.append((pairs[first], np.diff(np.concatenate([first, [len(pairs)]]))))
            size += len(first)
            if size > HELD:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


#: Keys of the sums that go along with the arrays: bigrams that occur 1 to 4 times, all
#: distinct bigrams, the start's followers (total, once, twice, more), continuations 1 to 4.
ONCE, DISTINCT, START, CONT, CONT_MORE = 1, 5, 10, 21, 25


def _write_bigrams(folder: str, base: list[int]):
    """Save the bigrams of a shard; pass on per word its followers and continuations."""
    words = base[-1]

    def run(batches):
        for (shard, _), (keys, counts) in gathered(batches).items():
            save(folder, f"bigram.{shard}", keys)
            save(folder, f"bicount.{shard}", counts.astype(np.uint32 if counts.max() < 1 << 32 else np.int64))
            pair = unmix(keys)
            before, own = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
            one, two, more = ((counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts > 2).astype(np.int64))
            first = before == words
            sums = np.array([*((counts == k).sum() for k in range(1, 5)), len(keys), *(v[first].sum() for v in (counts, one, two, more))])
            names = np.array([*range(ONCE, ONCE + 4), DISTINCT, *range(START, START + 4)], np.uint64)
            yield from blobs("sum", names, [sums], np.zeros(len(names), np.int64))
            for kind, of, values in (("follow", before[~first], [v[~first] for v in (counts, one, two, more)]), ("cont", own, [np.ones(len(own), np.int64)])):
                found, *totals = added(of.astype(np.uint64), *values)
                where = np.searchsorted(np.array(base), found.astype(np.int64), "right") - 1
                yield from blobs(kind, found, totals, where)

    return run


def _write_sums(folder: str, base: list[int]):
    """Save followers and continuations of the words of a shard; return the sums."""
    def run(batches):
        for (shard, kind), (keys, *values) in gathered(batches).items():
            if kind == "sum":
                sums = dict(zip(keys.tolist(), values[0].tolist()))
            else:
                names = ["cont"] if kind == "cont" else ["ctx_total", "ctx_1", "ctx_2", "ctx_3"]
                for name, v in zip(names, values):
                    dense = np.zeros(base[shard + 1] - base[shard], np.int64)
                    dense[keys.astype(np.int64) - base[shard]] = v
                    save(folder, f"{name}.{shard}", dense)
                sums = {CONT + k - 1: int((values[0] == k).sum()) for k in range(1, 5)} if kind == "cont" else {}
                if kind == "cont":
                    sums[CONT_MORE] = int((values[0] > 2).sum())
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.int64())], ["name", "value"])

    return run


@dataclass(frozen=True)
class Model:
    folder: str
    shards: int
    words: int  # distinct training tokens
    total: int  # training tokens
    bigrams: int  # distinct bigrams
    word_discounts: tuple[float, float, float]
    bigram_discounts: tuple[float, float, float]
    word_mass: float  # discounted from the words
    start: tuple[int, int, int, int]  # followers of the start: total, once, twice, more

    def score(self, texts: list[str]) -> list[np.ndarray]:
        """Per text: tokens, known tokens, base score, score."""
        arrays = mapped(self.folder, self.shards)
        lex = arrays.words
        before, own, doc = numbered(texts, lex, self.words)
        known = own >= 0
        count, cont = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        count[known] = lex.table.take("count", own[known])
        cont[known] = lex.table.take("cont", own[known])
        base = np.log10((count + 0.5) / (self.total + 0.5 * (self.words + 1)))
        mass = self.word_mass if self.bigrams else 1.0
        p = np.maximum(cont - discount(cont, self.word_discounts), 0) / max(1, self.bigrams) + mass / (self.words + 1)
        followers = np.zeros((4, len(own)), np.int64)
        inner = (before >= 0) & (before < self.words)
        for row, name in zip(followers, ("ctx_total", "ctx_1", "ctx_2", "ctx_3")):
            row[inner] = lex.table.take(name, before[inner])
        followers[:, before == self.words] = np.array(self.start)[:, None]
        seen = followers[0] > 0
        both = seen & known
        pairs = arrays.bigrams
        at = pairs.find(bigram_hash(before[both], own[both]))
        c = np.zeros(len(own), np.int64)
        c[np.flatnonzero(both)[at >= 0]] = pairs.take("bicount", at[at >= 0])
        gamma = np.array(self.bigram_discounts) @ followers[1:]
        total = np.maximum(followers[0], 1)
        p = np.where(seen, np.maximum(c - discount(c, self.bigram_discounts), 0) / total + gamma / total * p, p)
        n = len(texts)
        return [
            np.bincount(doc, minlength=n).astype(np.int64),
            np.bincount(doc, known, minlength=n).astype(np.int64),
            np.bincount(doc, base, minlength=n),
            np.bincount(doc, np.log10(p), minlength=n),
        ]


def by_shard(blobs: DataFrame, shards: int) -> DataFrame:
    """One shard per task: shards are dealt by their number, where a hash of it may put several together."""
    return blobs.repartitionById(shards, F.col("shard"))


def fit(docs: DataFrame, shards: int | None = None) -> Model:
    """Count the column ``text`` of all ``docs``; a null text is an empty one.

    ``shards`` (default: the session's shuffle partitions) should grow with the corpus;
    a task holds one shard. The driver gets a few numbers per shard.
    """
    spark = docs.sparkSession
    shards = shards or shuffle_parts(spark)
    folder = shared_folder(spark, "kneser-ney")
    texts = docs.select(text_of().alias("text"))
    dealt = by_shard(texts.mapInArrow(_count_words(shards), BLOBS), shards)
    sizes = {r.shard: r for r in dealt.mapInArrow(_write_words(folder), "shard int, n long, total long").collect()}
    counts = [sizes[s].n if s in sizes else 0 for s in range(shards)]
    base = [0, *np.cumsum(counts).tolist()]
    pairs = by_shard(texts.mapInArrow(_count_bigrams(folder, shards, base[-1]), BLOBS), shards)
    passed = by_shard(pairs.mapInArrow(_write_bigrams(folder, base), BLOBS), shards)
    sums: Counter = Counter()
    for name, value in passed.mapInArrow(_write_sums(folder, base), "name int, value long").collect():
        sums[name] += value
    word_d = discounts(*(sums[CONT + k] for k in range(4)))
    mass = word_d[0] * sums[CONT] + word_d[1] * sums[CONT + 1] + word_d[2] * sums[CONT_MORE]
    return Model(
        folder, shards, base[-1], sum(r.total for r in sizes.values()), sums[DISTINCT], word_d,
        discounts(*(sums[ONCE + k] for k in range(4))), mass / max(1, sums[DISTINCT]),
        tuple(sums[START + k] for k in range(4)),
    )


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Score the column ``text``; the others stay as the struct ``keys``.

    Returns keys, n_tokens, n_known, base_score and score (log10). A null or empty text
    is its end alone. A word not learned gets the share of one word of the discounted
    mass. With nothing learned every token has probability 1. Repeated rows are rows of
    their own; an empty table gives no rows.
    """
    def run(batches):
        for batch in slices(batches):
            found = model.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("keys"), *map(pa.array, found)], ["keys", "n_tokens", "n_known", "base_score", "score"])

    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("keys"), text_of().alias("text"))
    return rows.mapInArrow(
        run, f"keys {rows.schema['keys'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double"
    )


def held_out(docs: DataFrame) -> tuple[DataFrame, Model]:
    """Learn from four fifths of the documents by doc_id and score all of them."""
    fold = fold_of("doc_id", 5)
    model = fit(docs.filter(fold != 1))
    return scored(docs.select("doc_id", (fold == 1).alias("held_out"), "text"), model), model
