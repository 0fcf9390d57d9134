"""Jaccard self-join of shingle sets, size-aware: subsets for light sets, inverted lists for heavy ones.

Two sets of n >= m elements are linked if they share o(n, m) of them. With all elements in one
order, rarest first, the ``SUBSET`` first elements they share lie among the first
n - o + SUBSET of one and m - o + SUBSET of the other. A light set therefore names all subsets
of ``SUBSET`` elements of such a beginning, and linked light sets name a common one. A heavy
set would have too many of them: it scans the inverted lists of the single elements of its
beginning (the same with one instead of ``SUBSET``). Where light ends is chosen by cost:
subsets named against lengths of the lists scanned, summed per size over all sets.

Beginnings depend on both sizes, so names carry the smaller set's size class. A set is
listed under its own class and scans the lists of all classes that a smaller partner may have.
In a group of copies with edits of their own those edits come first in the order, so what is
too far from the rest of its group names nothing in common with it.

Sets that agree with no other in a part of their elements are left out first: two linked sets
of a size class differ in fewer elements than the class has parts, so one part is equal.

Pairs of a list aren't all looked at. Equal sets are one node. Each node is compared with one
centre, the node of its lists with most company there, then with the centres of its other
lists; links make components, and only pairs of a list in different components are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.arrays import mix, packed, unpacked
from tideline.llm.common import drop_state, join_keys, slices, text_key, text_of
from tideline.llm.graph import components
from tideline.llm.textbytes import shingle_sets
from tideline.session import stored

WORDS, PERCENT, SUBSET = 3, 90, 2
#: Sizes below are classes of their own; above, so many classes to a doubling.
EXACT, STEPS = 128, 64
#: Rows of lists that a worker hands on at once, the last set's whole.
LISTED = 1 << 17


def needed(n, m, percent: int):
    """How many elements linked sets of these sizes share at least."""
    return -(-percent * (n + m) // (100 + percent))


def class_of(n: int) -> int:
    return n if n < EXACT else EXACT + int(log2(n / EXACT) * STEPS)


def least_of(number: int) -> int:
    """The least size of a class; a class without sizes gives the least of those beyond."""
    if number < EXACT:
        return number
    n = int(EXACT * 2 ** ((number - EXACT) / STEPS))
    while class_of(n) < number:
        n += 1
    while n > EXACT and class_of(n - 1) >= number:
        n -= 1
    return n


def least_partner(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def part_classes(n: int, percent: int) -> list[tuple[int, int]]:
    """(class, parts) that a set of n elements is cut by: its own class of sizes and the next one.

    Linked sets are of one class or of neighbouring ones. Of all their elements, counted in
    both, no more than (100 - percent) of 100 + percent are in one alone; there are more parts.
    """
    own = int(log2(n) / -log2(percent / 100) + 1e-9)
    most = lambda number: 2 * (int((percent / 100) ** -(number + 1)) + 1)
    return [(number, most(number) * (100 - percent) // (100 + percent) + 1) for number in (own, own + 1)]


def part_names(hashes: np.ndarray, percent: int) -> np.ndarray:
    """A number for the content of each part of a set, for both classes."""
    spread, names = mix(hashes), []
    for number, parts in part_classes(len(hashes), percent):
        part = (spread >> np.uint64(32)).astype(np.int64) % parts
        order = np.argsort(part, kind="stable")
        present, first = np.unique(part[order], return_index=True)
        sums = np.zeros(parts, np.uint64)
        sums[present] = np.add.reduceat(mix(spread[order] ^ np.uint64(0x5BD1E995)), first)
        names.append(mix(sums + mix(np.arange(parts, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(number))))
    return np.concatenate(names)


def _sketched(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 19):
            sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                ],
                ["doc_id", "text_key", "n", "digest"],
            )
    return run


def _parts(words: int, percent: int):
    """Rows (name, id, met): the parts of all sets; sets that meet within a batch are said to, and send one row for a part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), words)
            nodes = np.asarray(batch.column("id"))
            names = [part_names(s, percent) for s in sets]
            ids = np.repeat(nodes, [len(x) for x in names])
            names = np.concatenate(names)
            order = np.lexsort((ids, names))
            names, ids = names[order], ids[order]
            first = np.concatenate([[True], names[1:] != names[:-1]])
            group = np.cumsum(first) - 1
            several = ids[first][group] != ids
            met = np.unique(ids[np.isin(group, group[several])])
            # A set that has met another is reported under a name that nothing else has.
            rows = np.concatenate([names[first], mix(mix(met.astype(np.uint64)))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows.view(np.int64)), pa.array(np.concatenate([ids[first], met])), pa.array(np.arange(len(rows)) >= first.sum())],
                ["name", "id", "met"],
            )
    return run


def _packed(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 19):
            sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), words)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([packed(s) for s in sets], pa.binary())], ["id", "elements"])
    return run


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "elements", 1 << 20):
        sets = [unpacked(s) for s in batch.column("elements").to_pylist()]
        ids = np.repeat(np.asarray(batch.column("id")), [len(s) for s in sets])
        if len(ids):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), pa.array(ids)], ["element", "id"])


def scanned(n: int, percent: int) -> list[tuple[int, int]]:
    """(class, o) for each class that a partner of at most n elements may have."""
    least = least_partner(n, percent)
    return [(c, needed(n, max(least, least_of(c)), percent)) for c in range(class_of(least), class_of(n) + 1)]


def light_cost(n: int, alone: int, subset: int, percent: int) -> int:
    """Subsets that a set names, ``alone`` of its elements being in no other set."""
    begins = [n - needed(n, n, percent), *(n - o for _, o in scanned(n, percent))]
    return sum(comb(max(0, b + subset - alone), subset) for b in begins)


def _costs(percent: int, subset: int):
    """Rows (class, light, heavy): what each set costs either way."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, light, heavy = [], [], []
            for n, alone, begin in zip(*(batch.column(c).to_pylist() for c in ("n", "alone", "shared"))):
                lists = np.cumsum([0] + [e["sets"] for e in begin])
                classes.append(class_of(n))
                light.append(float(light_cost(n, alone, subset, percent)))
                heavy.append(float(sum(lists[max(0, n - o + 1 - alone)] for _, o in scanned(n, percent))))
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(light), pa.array(heavy)], ["class", "light", "heavy"])
    return run


def boundary(costs: list[tuple[int, float, float]]) -> int:
    """The first class of heavy sets: where light sets below and heavy ones from there on cost least."""
    costs = sorted(costs)
    total = best = sum(heavy for _, _, heavy in costs)
    at = costs[0][0] if costs else 0
    for number, light, heavy in costs:
        total += light - heavy
        if total < best:
            best, at = total, number + 1
    return at


#: Names of subsets and of single elements never meet.
_KINDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))


def _names(elements: np.ndarray, number: int, subset: int) -> np.ndarray:
    """Numbers for all subsets of elements in order, for one size class; ``subset`` 1 are single ones."""
    if len(elements) < subset:
        return np.zeros(0, np.uint64)
    name = np.full(comb(len(elements), subset), mix(np.array([number], np.uint64) ^ _KINDS[subset > 1])[0])
    picks = np.array(list(combinations(range(len(elements)), subset))).reshape(-1, subset)
    for column in picks.T:
        name = mix(name ^ elements[column])
    return name


def listed(first_heavy: int, percent: int, subset: int):
    """Rows (name, id, n, scans): the lists that a set stands in, and those that it scans."""
    light_end = least_partner(least_of(first_heavy), percent)

    def of_set(n: int, alone: int, elements: np.ndarray) -> Iterator[tuple[bool, np.ndarray]]:
        own = class_of(n)

        def names(o, number, size):
            return _names(elements[: max(0, n - o + size - alone)], number, size)

        stands, light = needed(n, n, percent), own < first_heavy
        if light:
            yield False, names(stands, own, subset)
        if not light or n >= light_end:
            yield False, names(stands, own, 1)
        for number, o in scanned(n, percent):
            yield True, names(o, number, subset if light else 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_state()
        for batch in batches:
            # As arrays: an object per element would take some 30 times their memory.
            begins = batch.column("shared")
            ends, elements = np.asarray(begins.offsets), np.asarray(begins.values.field("element")).view(np.uint64)
            rows, held = [], 0
            for i, (node, n, alone) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("id", "n", "alone")))):
                for scans, names in of_set(n, alone, elements[ends[i] : ends[i + 1]]):
                    rows.append((names, node, n, scans))
                    held += len(names)
                if held > LISTED or len(rows) > 1 << 12:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)

    def out(rows: list) -> pa.RecordBatch:
        names, *others = zip(*rows)
        counts = [len(x) for x in names]
        columns = [np.concatenate(names).view(np.int64), *(np.repeat(np.array(x), counts) for x in others)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["name", "id", "n", "scans"])

    return run


def _compared(percent: int):
    """Rows (a, b) of the pairs whose whole sets are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "elements_a", 1 << 20):
            links = []
            for a, b in zip(batch.column("elements_a").to_pylist(), batch.column("elements_b").to_pylist()):
                a, b = unpacked(a), unpacked(b)
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                both = int((a[at] == b).sum())
                links.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))
    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """Stored rows (a, b) of those pairs that are links, by their whole sets."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("elements").alias(f"elements_{side}")), side)
    return stored(pairs.mapInArrow(_compared(percent), "a long, b long"), name)


def _beginnings(nodes: DataFrame, texts: DataFrame, words: int, percent: int, subset: int) -> tuple[DataFrame, DataFrame]:
    """Stored rows (id, n, alone, shared) of sets that may be linked, and (id, elements) of those in question.

    ``alone`` is how many elements no other of these sets has; they come first in the order.
    ``shared`` has those after them, as far as any partner asks for.
    """
    # A set of few elements is linked with equal ones only.
    some = stored(nodes.filter(F.expr(f"{percent} * (n + 1) <= 100 * n")).select("id", "doc_id", "text_key"), "wanted")
    parts = join_keys(texts, some, "inner").select("id", "text").mapInArrow(_parts(words, percent), "name long, id long, met boolean")
    beside = Window.partitionBy("name").orderBy("id")
    other = (F.lag("id").over(beside) != F.col("id")) | (F.lead("id").over(beside) != F.col("id"))
    open_ = parts.withColumn("other", other).filter("met OR other").select("id").distinct()
    open_ = stored(some.join(open_, "id", "left_semi"), "open")
    sets = join_keys(texts, open_, "inner").select("id", "text").mapInArrow(_packed(words), "id long, elements binary")
    sets = stored(sets.dropDuplicates(["id"]), "sets")
    elements = sets.mapInArrow(_elements, "element long, id long")
    counts = stored(elements.groupBy("element").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1"), "counts")
    shared = elements.join(counts, "element").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("sets", "element"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    longest = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + subset - F.col("alone")
    begins = shared.join(nodes.select("id", "n"), "id").filter(100 * F.size("shared") >= percent * F.col("n")).withColumn("alone", alone)
    begins = begins.withColumn("shared", F.slice("shared", F.lit(1), F.greatest(longest, F.lit(0)).cast("int")))
    return stored(begins.select("id", "n", "alone", "shared"), "begins"), sets


def links(nodes: DataFrame, texts: DataFrame, words: int = WORDS, percent: int = PERCENT, subset: int = SUBSET) -> DataFrame:
    """Names (node, component) of nodes that are linked; ``nodes`` has id, n and a row (doc_id, text_key) of ``texts`` each."""
    begins, sets = _beginnings(nodes, texts, words, percent, subset)
    costs = begins.mapInArrow(_costs(percent, subset), "class long, light double, heavy double")
    # One row per size class: about STEPS for each doubling of the largest set.
    per_class = costs.groupBy("class").agg(F.sum("light").alias("light"), F.sum("heavy").alias("heavy")).collect()
    first_heavy = boundary([tuple(r) for r in per_class])
    rows = stored(begins.mapInArrow(listed(first_heavy, percent, subset), "name long, id long, n long, scans boolean"), "listed")
    company = rows.groupBy("name").agg(
        F.count(F.lit(1)).alias("members"), F.min("id").alias("least"), F.max("id").alias("most"), F.bool_and("scans").alias("only_scans")
    ).filter("least < most AND NOT only_scans")
    crowded = stored(rows.join(company.select("name", "members"), "name"), "crowded")

    # The node of each list with most company is its centre; a node tries the centre of most of its lists.
    weight = crowded.groupBy("id").agg(F.sum("members").alias("weight"))
    centres = crowded.join(weight, "id").groupBy("name").agg(F.max(F.struct("weight", "id")).alias("centre"))
    shared = crowded.select("name", "id").join(centres.select("name", F.col("centre.id").alias("centre"), F.col("centre.weight").alias("weight")), "name")
    shared = stored(shared.filter("id != centre").groupBy("id", "centre", "weight").agg(F.count(F.lit(1)).alias("times")), "centres")
    best = shared.groupBy("id").agg(F.max(F.struct("times", "weight", "centre")).alias("best"))
    stars = best.select(F.col("best.centre").alias("a"), F.col("id").alias("b"))
    found = _linked(stars, sets, percent, "stars")
    names = components(found)

    def apart(pairs: DataFrame) -> DataFrame:
        """Pairs of different components."""
        for side in "ab":
            own = names.select(F.col("node").alias(side), F.col("component").alias(f"name_{side}"))
            pairs = pairs.join(own, side, "left")
        return pairs.filter(F.coalesce("name_a", "a") != F.coalesce("name_b", "b")).select("a", "b")

    others = shared.select(F.col("centre").alias("a"), F.col("id").alias("b")).join(stars, ["a", "b"], "left_anti")
    found = stored(found.unionByName(_linked(stored(apart(others), "others"), sets, percent, "other-links")), "links")
    names = components(found)

    # Where a list still holds several components, all its pairs of a standing and a scanning set are due.
    members = crowded.join(names, F.col("id") == names["node"], "left")
    members = stored(members.select("name", "id", "n", "scans", F.coalesce("component", "id").alias("component")), "members")
    mixed = members.groupBy("name").agg((F.min("component") != F.max("component")).alias("mixed")).filter("mixed").select("name")
    open_ = stored(members.join(mixed, "name", "left_semi"), "mixed")
    x, y = open_.filter("NOT scans").alias("x"), open_.filter("scans").alias("y")
    due = x.join(y, (F.col("x.name") == F.col("y.name")) & (F.col("x.component") != F.col("y.component")) & (F.col("x.n") <= F.col("y.n")))
    due = due.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    tried = stars.unionByName(others)
    due = due.join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    more = _linked(stored(due, "due"), sets, percent, "more-links")
    return components(found.unionByName(more)) if more.limit(1).count() else names


def linked_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, subset: int = SUBSET) -> DataFrame:
    """Rows (doc_id, text_key, n_shingles, component_id), one per document.

    A document's set has its distinct shingles of ``words`` words (A-Z lower-cased); a text of
    fewer words has one. Two are linked if 100 times the common ones are at least ``percent``
    times all of theirs; component_id is the least doc_id that links lead to, its own included. Null and
    empty texts and those without words have no shingles and are linked with nothing. Rows
    of equal sets are linked, also where they share a doc_id; a row without doc_id takes
    part but names no component. Other columns are not read; an empty table gives no rows.
    """
    texts = docs.select("doc_id", text_key().alias("text_key"), text_of().alias("text"))
    sketches = stored(texts.mapInArrow(_sketched(words), "doc_id long, text_key long, n long, digest binary"), "sketches")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    named = sketches.filter("n > 0").groupBy("digest").agg(F.min(place).alias("first"), F.first("n").alias("n"))
    nodes = stored(
        named.select(F.monotonically_increasing_id().alias("id"), "digest", "n", "first.doc_id", "first.text_key"), "nodes"
    )
    names = links(nodes, texts, words, percent, subset)
    joined = names.join(nodes.select(F.col("id").alias("node"), "doc_id"), "node")
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = stored(names.join(least, "component").select(F.col("node").alias("id"), "component_id"), "components")
    of_digest = nodes.join(of_node, "id", "left").select("digest", F.coalesce("component_id", "doc_id").alias("component_id"))
    has = sketches.filter("n > 0").join(of_digest, "digest").select("doc_id", "text_key", "n", "component_id")
    lone = sketches.filter("n = 0").select("doc_id", "text_key", "n", F.col("doc_id").alias("component_id"))
    return has.unionByName(lone).withColumnRenamed("n", "n_shingles")
