"""Language identification with a bit-sliced Bloom filter of n-grams.

Each slot of the filter holds one bit per language. Looking up an n-gram takes the AND of
its slots: the bits left are all languages that have it. A text's n-grams vote; each
language's count is corrected for the false positives that its share of set bits lets
through. n-grams are letter trigrams with word ends, and belong to the languages in which
they are about as frequent as where they are most frequent. Shares are taken as if each
language had some text more, without the n-gram: in a few lines any n-gram is a large
share, so a rare or wrong label can't claim what a large language is sure of.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrays import save, shared_folder
from tideline.llm.common import fold_of, slices, text_of
from tideline.session import stored

#: Fewest slots of the filter. It has more where a language has many n-grams.
SLOTS = 1 << 20
#: Slots for each n-gram of the language that has most: at three hashes, one in 200 is found by chance.
SLOTS_PER_GRAM = 16
HASHES = 3
#: Filters of at most so many words come to the driver and go to workers by broadcast; larger ones are mapped.
COLLECTED = 1 << 22
#: Bytes of a mapped file of slots.
SHARD_BYTES = 32 << 20
#: An n-gram belongs to a language if its share there is this part of its largest share.
MARGIN = 0.25
#: n-grams of text that each language is taken to have beside what was learned.
UNSEEN = 20_000
_BLANK = 32


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case where that is one letter, and whether it is a letter."""
    points = range(0x110000)
    lower = np.fromiter((ord(c) if len(c := chr(p).lower()) == 1 else p for p in points), np.uint32, len(points))
    letter = np.fromiter((chr(p).isalpha() for p in points), bool, len(points))
    return lower, letter


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of all texts as integers, and the number of the text of each.

    Whatever isn't a letter is one blank; the middle of a trigram is a letter.
    """
    joined = "\n" + "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    doc = np.concatenate([[0], doc])
    lower, letter = _letters()
    is_letter = letter[points]
    keep = is_letter.copy()
    keep[0] = True
    keep[1:] |= is_letter[:-1]
    chars = np.where(is_letter, lower[points], _BLANK)[keep].astype(np.int64)
    middle = np.flatnonzero(is_letter[keep][1:-1]) + 1
    return chars[middle - 1] << 42 | chars[middle] << 21 | chars[middle + 1], doc[keep][middle]


def slots(found: np.ndarray, hashes: int = HASHES, size: int = SLOTS) -> list[np.ndarray]:
    x = found.astype(np.uint64)
    out = []
    for i in range(1, hashes + 1):
        h = (x + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        out.append(((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64))
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams per language, added up over the partition as far as memory allows."""
    def flush(sums):
        for lang, (g, n) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], ["lang", "gram", "n"])

    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in slices(batches):
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").to_pylist()
        for lang in set(langs):
            g, n = np.unique(grams([t for t, x in zip(texts, langs) if x == lang])[0], return_counts=True)
            if lang in sums:
                both = np.concatenate([sums[lang][0], g])
                g, at = np.unique(both, return_inverse=True)
                n = np.bincount(at, np.concatenate([sums[lang][1], n])).astype(np.int64)
            sums[lang] = (g, n.astype(np.int64))
        if sum(len(g) for g, _ in sums.values()) > 1 << 21:
            yield from flush(sums)
            sums = {}
    yield from flush(sums)


def _kind(languages: int) -> str:
    """The narrowest number with a bit for each language, or words of 64."""
    return next((f"u{b}" for b in (1, 2, 4) if languages <= 8 * b), "u8")


class MappedBits:
    """Slots in files of the shared folder, mapped where they are looked up; the pickle has their folder only."""

    def __init__(self, folder: str, size: int, per_shard: int):
        self.folder, self.size, self.per_shard = folder, size, per_shard
        self.shards: list[np.ndarray] = []

    def __getstate__(self):
        return self.__dict__ | {"shards": []}

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        if not self.shards:
            self.shards = [np.load(f"{self.folder}/bits.{s}.npy", mmap_mode="r") for s in range(-(-self.size // self.per_shard))]
        shard = at // self.per_shard
        order = np.argsort(shard.astype(np.int32), kind="stable")
        edges = np.searchsorted(shard[order], np.arange(len(self.shards) + 1))
        out = np.zeros((len(at), self.shards[0].shape[1]), self.shards[0].dtype)
        for s, bits in enumerate(self.shards):
            here = order[edges[s] : edges[s + 1]]
            out[here] = bits[at[here] - s * self.per_shard]
        return out


def _write_bits(folder: str, size: int, per_shard: int, width: int, languages: int):
    """Per shard, its file, and how many of its slots each language has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def written(shard, bits):
            save(folder, f"bits.{shard}", bits)
            n = [int(((bits[:, k // 64] >> (k % 64)) & 1).sum(dtype=np.int64)) for k in range(languages)]
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([n], pa.list_(pa.int64()))], ["shard", "n"])

        now, bits = None, None
        for batch in batches:
            shards, slot, word = (np.asarray(batch.column(c)) for c in ("shard", "slot", "word"))
            masks = np.asarray(batch.column("mask")).view(np.uint64)
            for s in np.unique(shards).tolist():
                if s != now:
                    if now is not None:
                        yield written(now, bits)
                    now, bits = s, np.zeros((min(per_shard, size - s * per_shard), width), _kind(languages))
                here = (shards == s) & (slot >= 0)
                bits[slot[here] - s * per_shard, word[here]] = masks[here].astype(bits.dtype)
        if now is not None:
            yield written(now, bits)

    return run


@dataclass(frozen=True)
class Model:
    languages: list[str]
    bits: np.ndarray | MappedBits  # slots x words of 64 languages, or one narrower word
    false: np.ndarray  # per language, the chance that an n-gram it lacks is found
    by_size: np.ndarray  # the languages' numbers, that with most n-grams learned first

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        found, doc = grams(texts)
        total = np.bincount(doc, minlength=len(texts))
        masks = [self.bits[s] for s in slots(found, size=len(self.bits))]
        both = masks[0] & masks[1] & masks[2]
        share = np.zeros((len(self.languages), len(texts)))
        for k in range(len(self.languages)):
            hit = (both[:, k // 64] >> (k % 64)) & 1
            rate = np.bincount(doc, hit.astype(np.float64), minlength=len(texts)) / np.maximum(total, 1)
            share[k] = (rate - self.false[k]) / max(1e-9, 1 - self.false[k])
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        best = self.by_size[share[self.by_size].argmax(axis=0)]
        names = [self.languages[b] if n else "und" for b, n in zip(best, total)]
        scores = np.where(total > 0, np.clip(share[best, np.arange(len(texts))], 0, 1), 0.0)
        return names, scores.tolist()


def fit(docs: DataFrame, size: int | None = None, margin: float = MARGIN, unseen: int = UNSEEN) -> Model:
    """Learn from all documents that have both text and lang.

    An n-gram's share of a language is its count by all counts there plus ``unseen``; so
    of two languages with as much text neither gains, and one with little owns what is
    rare elsewhere. A language takes a bit of each slot and its name comes to the driver.

    Counting is one shuffle of n-gram counts added up per task. The filter has ``size``
    slots, by default as many as the language with most n-grams needs for few false
    positives. It comes to the driver if small; otherwise tasks write its slots to the
    shared folder and only the list of languages comes to the driver.
    """
    labelled = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    counts = labelled.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stored(counts, "gram-counts")
    totals = stored(counts.groupBy("lang").agg(F.sum("n").alias("total")), "gram-totals")
    learned = {r.lang: r.total for r in totals.collect()}
    languages = sorted(r.lang for r in labelled.select("lang").distinct().collect())
    by_size = np.argsort([-learned.get(lang, 0) for lang in languages], kind="stable")
    number = {lang: i for i, lang in enumerate(languages)}
    width = max(1, -(-len(languages) // 64))
    shares = counts.join(totals, "lang").withColumn("share", F.col("n") / (F.col("total") + unseen))
    best = shares.groupBy("gram").agg(F.max("share").alias("best"), F.collect_list(F.struct("lang", "share")).alias("all"))
    owned = best.select("gram", F.transform(F.filter("all", lambda a: a["share"] >= margin * F.col("best")), lambda a: a["lang"]).alias("langs"))
    if size is None:
        owned = stored(owned, "grams")
        most = owned.select(F.explode("langs").alias("lang")).groupBy("lang").count().agg(F.max("count")).first()[0]
        size = max(SLOTS, SLOTS_PER_GRAM * (most or 0))

    def to_slots(batches):
        for batch in batches:
            found = np.asarray(batch.column("gram"))
            masks = np.zeros((len(found), width), np.uint64)
            for i, langs in enumerate(batch.column("langs").to_pylist()):
                for lang in langs:
                    k = number[lang]
                    masks[i, k // 64] |= np.uint64(1) << np.uint64(k % 64)
            for at in slots(found, size=size):
                for w in range(width):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at), pa.array(np.full(len(at), w)), pa.array(masks[:, w].view(np.int64))], ["slot", "word", "mask"]
                    )

    filled = owned.mapInArrow(to_slots, "slot long, word long, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
    kind = np.dtype(_kind(len(languages)))
    if size * width <= COLLECTED:
        rows = filled.toArrow()
        bits = np.zeros((size, width), kind)
        bits[np.asarray(rows["slot"]), np.asarray(rows["word"])] = np.asarray(rows["mask"]).view(np.uint64).astype(kind)
        set_bits = np.array([((bits[:, k // 64] >> (k % 64)) & 1).mean() for k in range(len(languages))])
    else:
        spark = docs.sparkSession
        per_shard = max(1, SHARD_BYTES // (width * kind.itemsize))
        shards = -(-size // per_shard)
        folder = shared_folder(spark, "language-bits")
        # A row without a slot for each shard, so that shards without n-grams are written too.
        bare = spark.range(shards).select(F.lit(-1).cast("long").alias("slot"), F.lit(0).cast("long").alias("word"), F.lit(0).cast("long").alias("mask"), F.col("id").alias("shard"))
        dealt = filled.withColumn("shard", F.expr(f"slot div {per_shard}")).unionByName(bare).repartition(shards, "shard").sortWithinPartitions("shard")
        done = dealt.mapInArrow(_write_bits(folder, size, per_shard, width, len(languages)), "shard long, n array<long>").collect()
        set_bits = np.array([r.n for r in done]).reshape(shards, len(languages)).sum(axis=0) / size
        bits = MappedBits(folder, size, per_shard)
    return Model(languages, bits, set_bits**HASHES, by_size)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Add lang_pred and score; the other columns stay, as the struct ``keys``.

    Only the text is used. Null texts and texts without a letter are ``und`` with score
    0, as is every text where nothing was learned; ties go to the language with most
    n-grams learned, then to the first in order. Repeated rows are rows of their own; an empty table gives no rows. A small
    filter goes to the workers with the model, a large one is mapped by them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            names, scores = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("keys"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["keys", "lang_pred", "score"])

    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("keys"), text_of().alias("text"))
    return rows.mapInArrow(run, f"keys {rows.schema['keys'].dataType.simpleString()}, lang_pred string, score double")


def held_out(docs: DataFrame) -> DataFrame:
    """Fit on three quarters of the documents by doc_id and predict all of them."""
    fold = fold_of("doc_id", 4)
    model = fit(docs.filter(fold != 2))
    return identify(docs.select("doc_id", (fold == 2).alias("held_out"), "text"), model)
