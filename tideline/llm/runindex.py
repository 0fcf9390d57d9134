"""Removal of repeated byte strings with a run-length index.

Every 100-byte string selects one of its 32-byte grams by least hash, so equal strings
select equal grams, the anchors. Three passes over the texts, none of which shuffles them:

1. Anchors are counted over the corpus; those that occur twice are saved as sorted hash
   arrays in the shared folder.
2. Around each repeated anchor a context is cut out: all strings that select it. Equal
   contexts are merged, in a task before the shuffle and after it by anchor; all but the
   first are repeats. Contexts that differ are indexed: a run-length compressed
   Burrows-Wheeler transform with the places of its run ends. Streaming a context through
   it from its end gives, per place, its row among the sorted suffixes and how many bytes
   match the row above: one more with each byte read inside a run, and at a run's first
   row what the places sampled there say. Rows that match in 100 bytes are one string,
   and all but its earliest place are repeats.
3. Texts are read once more and cut by the spans found, which workers map into memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrays import Sharded, added, load, mix, packed, save, shard_of, shared_folder, unpacked
from tideline.llm.common import give_back, shuffle_parts, slices, text_of, worker_state
from tideline.llm.textbytes import powers

LENGTH, GRAM = 100, 32
#: Texts are searched for anchors in pieces of less than 2 to this many bytes.
PLACE_BITS = 20
#: Bytes of texts hashed at once: as much as stays in a processor's cache.
GROUP_BYTES = 1 << 17
#: Bytes of contexts indexed at once, unless one anchor has more.
INDEX_BYTES = 1 << 20
#: Anchors with more occurrences are dealt out string by string instead of by anchor.
HOT = 1 << 13
#: Entries a task adds up before it passes them on.
HELD = 1 << 21
_VALUES = mix(np.arange(1000, 1256, dtype=np.uint64))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings that select one anchor: text number, first and last start, hash.

    Of grams whose hashes share the first 44 bits the leftmost wins, so the choice
    depends on the string alone.
    """
    found = []
    piece = (1 << PLACE_BITS) - 1
    group, size = [], 0
    for n, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), piece - LENGTH + 1):
            part = text[at : at + piece]
            if size + len(part) > GROUP_BYTES and group:
                found.append(_anchors(group))
                group, size = [], 0
            if len(part) >= LENGTH:
                group.append((n, at, part))
                size += len(part)
    if group:
        found.append(_anchors(group))
    if not found:
        return tuple(np.zeros(0, t) for t in ("i8", "i8", "i8", "u8"))
    return tuple(map(np.concatenate, zip(*found)))


def _anchors(parts: list[tuple[int, int, bytes]]):
    data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    sizes = np.array([len(p) for _, _, p in parts])
    n = len(data)
    up, down = powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:n], out=prefix[1:])
    grams = mix((prefix[GRAM:] - prefix[: n - GRAM + 1]) * down[: n - GRAM + 1])
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    width, wanted = 1, LENGTH - GRAM + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes)[: len(least)] - np.arange(len(least))
    starts = np.flatnonzero(left >= LENGTH)
    chosen = (least[starts] & mask).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    part = np.searchsorted(ends, starts[first], "right")
    shift = np.array([at for _, at, _ in parts]) - (ends - sizes)
    text = np.array([t for t, _, _ in parts])[part]
    return text, starts[first] + shift[part], starts[last] + shift[part], grams[chosen[first]]


def _count_anchors(shards: int):
    def run(batches):
        held, size = [], 0

        def flush():
            keys, counts = added(*map(np.concatenate, zip(*held)))
            edges = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
            for s in range(shards):
                a, b = edges[s], edges[s + 1]
                if a < b:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s], pa.int32()), pa.array([packed(keys[a:b])], pa.binary()), pa.array([packed(counts[a:b])], pa.binary())],
                        ["shard", "keys", "counts"],
                    )

        for batch in slices(batches, most=4 << 20):
            hashes = np.sort(anchors(batch.column("text").cast(pa.binary()).to_pylist())[3])
            if len(hashes):
                first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
                held.append((hashes[first], np.diff(np.concatenate([first, [len(hashes)]]))))
                size += len(first)
            if size > HELD:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
        held.clear()
        give_back()

    return run


def _write_repeated(folder: str):
    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["shard"], []).append((unpacked(row["keys"]), unpacked(row["counts"]).astype(np.int64)))
        for shard, parts in held.items():
            keys, counts = added(*map(np.concatenate, zip(*parts)))
            twice = counts > 1
            save(folder, f"anchor.{shard}", keys[twice])
            save(folder, f"often.{shard}", np.minimum(counts[twice], 1 << 31).astype(np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([int(twice.sum())])], ["shard", "n"])

    return run


def repeated(folder: str, shards: int) -> Sharded:
    return worker_state(("anchors", folder), lambda: Sharded(folder, "anchor", shards))


CONTEXTS = "deal long, context binary, doc_id long, text_key long, start long, end long"


def document_order(ids: np.ndarray, absent: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The order of places in the corpus: by doc_id, null last; texts that share it by key."""
    return np.lexsort((starts, keys, ids, absent))


def _contexts(folder: str, shards: int, hot: int):
    """Contexts of repeated anchors. One equal to an earlier one of these texts comes without its bytes."""
    def run(batches):
        table = repeated(folder, shards)
        for batch in slices(batches, most=4 << 20):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            number, first, last, hashes = anchors(texts)
            at = table.find(hashes)
            known = at >= 0
            number, first, last, deal = number[known], first[known], last[known], hashes[known].view(np.int64)
            often = table.take("often", at[known]) > hot
            if often.any():
                spread = last[often] - first[often] + 1
                offset = np.arange(int(spread.sum())) - np.repeat(np.cumsum(spread) - spread, spread)
                single, of = np.repeat(first[often], spread) + offset, np.repeat(number[often], spread)
                strings = [texts[t][x : x + LENGTH] for t, x in zip(of.tolist(), single.tolist())]
                named = np.fromiter(map(xxhash.xxh3_64_intdigest, strings), np.uint64, len(strings)).view(np.int64)
                number, deal = np.concatenate([number[~often], of]), np.concatenate([deal[~often], named])
                first, last = np.concatenate([first[~often], single]), np.concatenate([last[~often], single])
            ids = batch.column("doc_id")
            absent, ids = np.asarray(ids.is_null())[number], np.asarray(ids.fill_null(0))[number]
            keys = np.asarray(batch.column("text_key"))[number]
            order = document_order(ids, absent, keys, first)
            places = list(zip(absent.tolist(), ids.tolist(), keys.tolist(), first.tolist()))
            cut = [texts[t][x : y + LENGTH] for t, x, y in zip(number.tolist(), first.tolist(), last.tolist())]
            seen: dict = {}
            use = np.ones(len(cut), bool)
            for i, key in zip(order.tolist(), deal[order].tolist()):
                earlier = seen.setdefault((key, cut[i]), i)
                if earlier != i:
                    use[i] = places[earlier] != places[i]
                    cut[i], deal[i] = None, keys[i]  # nothing to compare, so any task will do
            stop = last + LENGTH
            bare = np.flatnonzero(use & np.fromiter((c is None for c in cut), bool, len(cut)))
            bare = bare[np.lexsort((first[bare], number[bare]))]
            if len(bare):
                # Those that touch each other in a text go on as one.
                new = np.flatnonzero(np.concatenate([[True], (number[bare[1:]] != number[bare[:-1]]) | (first[bare[1:]] > stop[bare[:-1]])]))
                stop[bare[new]] = stop[bare[np.concatenate([new[1:], [len(bare)]]) - 1]]
                use[bare] = False
                use[bare[new]] = True
            for some in np.array_split(np.flatnonzero(use), len(cut) // 20_000 + 1):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(deal[some]), pa.array([cut[i] for i in some.tolist()], pa.binary()),
                        pa.array(ids[some], mask=absent[some]), pa.array(keys[some]), pa.array(first[some]), pa.array(stop[some]),
                    ],
                    ["deal", "context", "doc_id", "text_key", "start", "end"],
                )

    return run


def suffix_ranks(data: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes of numbers from 0 to 256.

    The first sort takes five of them, each later one doubles that; only what is still
    tied is sorted again. Beyond the end stands something less than all.
    """
    n = len(data)
    bits = int(n + 2).bit_length()
    padded = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(5, np.uint64)])
    key = np.zeros(n, np.uint64)
    for i in range(5):
        key = key * np.uint64(258) + padded[i : i + n]
    active = np.argsort(key, kind="stable")
    key = key[active]
    changed = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.zeros(n + 1, np.int64)  # ranks from 1; 0 is the end
    rank[active] = np.maximum.accumulate(np.where(changed, np.arange(n), 0)) + 1
    step = 5
    while True:
        single = changed & np.concatenate([changed[1:], [True]])
        active = active[~single]
        if not len(active):
            return rank[:n] - 1
        own, follow = rank[active], rank[np.minimum(active + step, n)]
        if 3 * bits <= 64:
            key = (own.astype(np.uint64) << np.uint64(2 * bits)) | (follow.astype(np.uint64) << np.uint64(bits)) | active.astype(np.uint64)
            key.sort()
            active = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
            key >>= np.uint64(bits)
            own = (key >> np.uint64(bits)).astype(np.int64)
            changed = np.concatenate([[True], key[1:] != key[:-1]])
        else:
            order = np.lexsort((follow, own))
            active, own, follow = active[order], own[order], follow[order]
            changed = np.concatenate([[True], (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])])
        place = np.arange(len(active))
        fresh = np.concatenate([[True], own[1:] != own[:-1]])
        start = np.maximum.accumulate(np.where(changed, place, 0))
        rank[active] = own + start - np.maximum.accumulate(np.where(fresh, place, 0))
        step *= 2


class RunIndex:
    """Run-length compressed transform of contexts, with the places of its run ends.

    Rows are sorted suffixes of the contexts, each closed by a number that is no byte.
    """

    def __init__(self, contexts: list[bytes]):
        self.bytes = np.frombuffer(b"\0".join([*contexts, b""]), np.uint8)
        self.lengths = np.array([len(c) for c in contexts])
        ends = np.cumsum(self.lengths + 1) - 1
        data = self.bytes.astype(np.uint16)
        data[ends] = 256
        n = len(data)
        rank = suffix_ranks(data)
        places = np.empty(n, np.int64)
        places[rank] = np.arange(n)
        self.end_rows = rank[ends]
        before = data[places - 1]
        first = places == 0  # the place before the first byte is the end of all
        heads = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | first[1:] | first[:-1]]))
        tails = np.concatenate([heads[1:], [n]]) - 1
        self.starts, self.chars = heads, before[heads]
        self.first_places, self.last_places = places[heads], places[tails]
        # A run maps to consecutive rows: after smaller numbers, and equal ones of earlier
        # runs. Of those that close a context the end of all comes first.
        order = np.lexsort((heads, ~first[heads], self.chars))
        lengths = tails - heads + 1
        self.to = np.empty(len(heads), np.int64)
        self.to[order] = np.cumsum(lengths[order]) - lengths[order]
        # Above the row that a run's first row leads to stands the one that the last row
        # of the run before it in this order leads to: both places are sampled.
        self.match = np.zeros(len(heads), np.int64)
        same = np.flatnonzero((self.chars[order[1:]] == self.chars[order[:-1]]) & (self.chars[order[1:]] < 256))
        run, above = order[same + 1], order[same]
        self.match[run] = 1 + self.common(self.first_places[run], self.last_places[above], ends)

    def common(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many bytes the contexts at both places share from there on, up to LENGTH."""
        padded = np.concatenate([self.bytes, np.zeros(LENGTH + 16, np.uint8)])
        words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        shared = np.full(len(a), LENGTH)
        open_ = np.arange(len(a))
        for k in range(0, LENGTH, 8):
            differ = words[a[open_] + k] ^ words[b[open_] + k]
            found = differ != 0
            lowest = differ[found] & (~differ[found] + np.uint64(1))
            shared[open_[found]] = k + np.log2(lowest.astype(np.float64)).astype(np.int64) // 8
            open_ = open_[~found]
            if not len(open_):
                break
        left = [ends[np.searchsorted(ends, x)] - x for x in (a, b)]
        return np.minimum(np.minimum(shared, LENGTH), np.minimum(*left))

    def stream(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Matching statistics of the places that begin a string of LENGTH bytes.

        Gives contexts, offsets in them, rows, and how many bytes match the row above.
        """
        alive, rows, read = np.arange(len(self.lengths)), self.end_rows, 0
        matched = np.zeros(len(alive), np.int64)
        while len(alive):
            run = np.searchsorted(self.starts, rows, "right") - 1
            inside = rows - self.starts[run]
            rows, read = self.to[run] + inside, read + 1
            matched = np.where(inside > 0, matched + 1, self.match[run])
            if read >= LENGTH:
                yield alive, self.lengths[alive] - read, rows, matched
            keep = self.lengths[alive] > read
            alive, rows, matched = alive[keep], rows[keep], matched[keep]


def later_strings(contexts: list[bytes], order: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (context, first, last) of string starts that occur in an earlier context.

    ``order`` numbers the documents of the contexts, ``starts`` are their places in them.
    """
    which, offset, rows, matched = map(np.concatenate, zip(*RunIndex(contexts).stream()))
    by = np.argsort(rows)
    which, offset, matched = which[by], offset[by], matched[by]
    place = order[which] << 40 | (starts[which] + offset)
    new = np.flatnonzero(matched < LENGTH)  # others are the string of the row above
    earliest = np.minimum.reduceat(place, new)
    late = place > np.repeat(earliest, np.diff(np.concatenate([new, [len(place)]])))
    which, offset = which[late], offset[late]
    by = np.lexsort((offset, which))
    which, offset = which[by], offset[by]
    if not len(which):
        return []
    new = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (offset[1:] != offset[:-1] + 1)]))
    last = np.concatenate([new[1:], [len(which)]]) - 1
    return list(zip(which[new].tolist(), offset[new].tolist(), offset[last].tolist()))


def _settled(held: list[tuple]) -> Iterator[tuple]:
    """Spans of strings that repeat something earlier, of contexts (context, absent, doc_id, text_key, start)."""
    absent, ids, keys, starts = (np.array(c) for c in list(zip(*held))[1:])
    order = document_order(ids, absent, keys, starts)
    columns = np.column_stack([ids, absent, keys])[order]
    document = np.empty(len(order), np.int64)
    document[order] = np.cumsum(np.concatenate([[False], (columns[1:] != columns[:-1]).any(axis=1)]))
    for i, a, b in later_strings([h[0] for h in held], document, starts):
        _, gone, doc, key, start = held[i]
        yield None if gone else doc, key, start + a, start + b + LENGTH


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (doc_id, text_key, start, end) that repeat something earlier.

    Rows come by deal and context, equal ones by their place in the corpus. One deal's
    distinct contexts are held at a time, or as many small deals as fill an index.
    """
    held: list[tuple] = []  # contexts of deals that have several
    group: list[tuple] = []  # those of the deal at hand
    size = more = 0
    now = None

    def close() -> Iterator[tuple]:
        nonlocal held, group, size, more
        if len(group) > 1:  # what one context has repeats nothing
            if held and size + more > INDEX_BYTES:
                yield from _settled(held)
                held, size = [], 0
            held += group
            size += more
        group, more = [], 0

    def spans(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["doc_id", "text_key", "start", "end"])

    for batch in batches:
        absent, ids = batch.column("doc_id").is_null().to_pylist(), batch.column("doc_id").fill_null(0).to_pylist()
        rest = (batch.column(c).to_pylist() for c in ("deal", "context", "text_key", "start", "end"))
        found: list[tuple] = []
        for gone, doc, deal, context, key, start, end in zip(absent, ids, *rest):
            if context is None:
                found.append((None if gone else doc, key, start, end))
                continue
            if deal != now:
                found += close()
                now = deal
            place = (gone, doc, key, start)
            if not group or group[-1][0] != context:
                group.append((context, *place))
                more += len(context) + 1
            elif group[-1][1:] != place:
                found.append((None if gone else doc, key, start, end))
        if found:
            yield spans(found)
    found = list(close())
    if held:
        found += _settled(held)
    if found:
        yield spans(found)
    held, group = [], []
    give_back()


def document_key(ids: np.ndarray, absent: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return mix(mix(ids.astype(np.int64).view(np.uint64)) ^ keys.view(np.uint64) ^ absent.astype(np.uint64))


def _write_spans(folder: str, shards: int):
    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for s in np.unique(np.asarray(batch.column("shard"))).tolist():
                mine = np.flatnonzero(np.asarray(batch.column("shard")) == s)
                held.setdefault(s, []).append([np.asarray(batch.column(c))[mine] for c in ("key", "start", "end")])
        for shard, parts in held.items():
            key, start, end = map(np.concatenate, zip(*parts))
            key = key.view(np.uint64)
            order = np.lexsort((start, key))
            for name, column in (("doc", key), ("start", start), ("end", end)):
                save(folder, f"{name}.{shard}", column[order])
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(key)])], ["shard", "n"])

    return run


def _keyed(shards: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("doc_id")
                key = document_key(np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(batch.column("text_key")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard_of(key, shards), pa.int32()), pa.array(key.view(np.int64)), batch.column("start"), batch.column("end")],
                    ["shard", "key", "start", "end"],
                )

    return run


def merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered; spans come by start."""
    out: list[list[int]] = []
    for a, b in zip(start.tolist(), end.tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(s) for s in out]


def _cut(folder: str, shards: int):
    def run(batches):
        arrays: dict[int, tuple] = {}
        for batch in slices(batches):
            ids = batch.column("doc_id")
            key = document_key(np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(batch.column("text_key")))
            where = shard_of(key, shards)
            spans, kept = [], []
            for s, k, text in zip(where.tolist(), key, batch.column("text").cast(pa.binary()).to_pylist()):
                if s not in arrays:
                    arrays[s] = tuple(load(folder, f"{c}.{s}", t) for c, t in (("doc", "u8"), ("start", "i8"), ("end", "i8")))
                doc, start, end = arrays[s]
                a, b = np.searchsorted(doc, k), np.searchsorted(doc, k, "right")
                cut = merged(start[a:b], end[a:b])
                parts, at = [], 0
                for x, y in cut:
                    parts.append(text[at:x])
                    at = y
                kept.append(b"".join([*parts, text[at:]]))
                spans.append([list(x) for x in cut])
            yield pa.RecordBatch.from_arrays(
                [batch.column("keys"), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())], ["keys", "spans", "kept"]
            )

    return run


def remove_repeats(docs: DataFrame, shards: int | None = None, hot: int = HOT) -> DataFrame:
    """Cut all bytes covered by 100-byte strings that also start earlier in the corpus.

    ``docs`` has doc_id and text. Returns keys (struct of all columns but text), spans
    (pairs of byte places, maximal and in order) and kept (the bytes left). Strings are
    judged on the input. Earlier is a smaller doc_id, or in one document a smaller place;
    a null doc_id comes after all others, and different texts of one doc_id in the order
    of their hashes. Rows that repeat both doc_id and text are one document, so all get
    the same result. Null text is empty; an empty table gives no rows. Result columns
    follow ``keys``, so other columns may have any name.
    """
    spark = docs.sparkSession
    shards = shards or shuffle_parts(spark)
    folder = shared_folder(spark, "run-index")
    text = text_of()
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"))
    counted = rows.select("text").mapInArrow(_count_anchors(shards), "shard int, keys binary, counts binary")
    counted.repartitionById(shards, F.col("shard")).mapInArrow(_write_repeated(folder), "shard int, n long").collect()
    contexts = rows.mapInArrow(_contexts(folder, shards, hot), CONTEXTS)
    dealt = contexts.repartition(shards, "deal").sortWithinPartitions(
        "deal", "context", F.col("doc_id").asc_nulls_last(), "text_key", "start"
    )
    marked = dealt.mapInArrow(_mark, "doc_id long, text_key long, start long, end long")
    spans = marked.mapInArrow(_keyed(shards), "shard int, key long, start long, end long").repartitionById(shards, F.col("shard"))
    spans.mapInArrow(_write_spans(folder, shards), "shard int, n long").collect()
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    whole = docs.select(F.struct(*others).alias("keys"), "doc_id", F.xxhash64(text).alias("text_key"), text.alias("text"))
    return whole.mapInArrow(
        _cut(folder, shards), f"keys {whole.schema['keys'].dataType.simpleString()}, spans array<array<long>>, kept binary"
    )

