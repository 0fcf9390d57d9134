"""Near-duplicate removal with HyperMinHash registers.

A document's shingles fall into buckets by the first bits of their hashes. Each bucket's
register keeps the least hash as a count of leading zeros and a few mantissa bits, two
bytes together; empty buckets borrow from others in a fixed random order. Bands of
registers deal candidates into buckets. Registers give a Jaccard estimate, corrected for
registers that are equal by chance, before a pair is verified on its full sets. Sets
smaller than the number of registers share buckets unevenly and are verified at once.

Pairs within a bucket are not listed. Texts with equal sets are one node. First each node
is checked against one centre: the node of a bucket they share that has most company in all
its buckets, as the original of many copies has; links found make components. What remains
are nodes of buckets with several components: only those can still join anything. They are
compared where they share one of their rarest shingles, as far as the bound of a link goes.
Copies with too many edits of their own have nothing else among their rarest shingles and
meet nobody, so the work doesn't grow with the square of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.arrays import packed, unpacked
from tideline.llm.common import drop_state, join_keys, keyed, slices, small_batches, text_key, text_of
from tideline.llm.graph import components
from tideline.llm.setjoin import listed
from tideline.llm.textbytes import shingle_sets
from tideline.session import stored

REGISTERS, MANTISSA = 256, 10
#: 48 bands of 4 registers miss a pair of similarity 0.75 with a chance of 1e-8.
ROWS, BANDS = 4, 48
PERCENT = 75
#: Five standard deviations of an estimate from 256 registers at 0.75 (3e-7 beyond).
MARGIN = 0.136


@cache
def _borrow_order() -> np.ndarray:
    rng = np.random.default_rng(20240301)
    return np.stack([rng.permutation(REGISTERS) for _ in range(REGISTERS)])


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers per set of sorted hashes; an empty set has zeros."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    shift = np.uint64(64 - (REGISTERS.bit_length() - 1))
    for row, hashes in zip(out, sets):
        bucket = (hashes >> shift).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        rest = hashes[first] << np.uint64(REGISTERS.bit_length() - 1)
        zeros = 64 - np.frexp(rest.astype(np.float64))[1]
        zeros = np.clip(np.where(rest == 0, 56, zeros), 0, 62)
        mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
        row[bucket[first]] = ((zeros + 1) << MANTISSA) | mantissa.astype(np.int64)
    filled = out.copy()
    order = _borrow_order()
    row, column = np.nonzero((out == 0) & out.any(axis=1)[:, None])
    for step in range(REGISTERS):
        if not len(row):
            break
        lent = out[row, order[column, step]]
        got = lent > 0
        filled[row[got], column[got]] = lent[got]
        row, column = row[~got], column[~got]
    return filled


@cache
def _chance(load_a: float, load_b: float) -> float:
    """How often registers of unlike sets with so many hashes a bucket are equal."""
    zeros = 2.0 ** -np.arange(1, 63)[:, None]
    low = zeros * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA))
    high = low + zeros / (1 << MANTISSA)

    def cell(load):
        return (1 - low) ** load - (1 - high) ** load

    return float((cell(load_a) * cell(load_b)).sum())


def estimate(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of pairs of register rows, without the equalities of chance."""
    equal = (a == b).mean(axis=1)
    load = lambda n: 2.0 ** (np.round(np.log2(np.maximum(n / REGISTERS, 1)) * 2) / 2)
    chance = np.array([_chance(x, y) for x, y in zip(load(sizes_a).tolist(), load(sizes_b).tolist())])
    return (equal - chance) / (1 - chance)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop_state()
    for batch in slices(batches, most=1 << 19):
        sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist())
        regs = registers(sets)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([r.tobytes() for r in regs], pa.binary()),
            ],
            ["doc_id", "text_key", "n", "digest", "registers"],
        )


def _register_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (band, id): the key of a bucket, and the node in it."""
    drop_state()
    digest = xxhash.xxh3_64_intdigest
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            batch = whole.slice(start, 2000)
            bands = _register_rows(batch.column("registers"))[:, : ROWS * BANDS].copy().view(f"V{2 * ROWS}")
            keys = [digest(v.tobytes(), k) for row in bands for k, v in enumerate(row)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(np.repeat(np.asarray(batch.column("id")), BANDS))],
                ["band", "id"],
            )


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop_state()
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            batch = whole.slice(start, 2000)
            n_a, n_b = np.asarray(batch.column("n_a")), np.asarray(batch.column("n_b"))
            near = np.minimum(n_a, n_b) < REGISTERS
            near &= 100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b)
            large = np.flatnonzero(np.minimum(n_a, n_b) >= REGISTERS)
            sides = batch.take(pa.array(large))
            found = estimate(
                _register_rows(sides.column("registers_a")), _register_rows(sides.column("registers_b")), n_a[large], n_b[large]
            )
            near[large] = found >= PERCENT / 100 - MARGIN
            yield batch.select(["a", "b"]).filter(pa.array(near))


def _packed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop_state()
    for batch in slices(batches, most=1 << 19):
        sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([packed(s) for s in sets], pa.binary())], ["id", "shingles"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, both, link): how many shingles are in both, and whether that makes a link."""
    drop_state()
    for batch in slices(batches, "shingles_a", 1 << 20):
        common, links = [], []
        for a, b in zip(batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist()):
            a, b = unpacked(a), unpacked(b)
            at = np.minimum(np.searchsorted(a, b), len(a) - 1)
            both = int((a[at] == b).sum())
            common.append(both)
            links.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(links, pa.bool_())], ["a", "b", "both", "link"]
        )


class Nodes:
    """Distinct shingle sets with their registers, and how to get at the sets again."""

    def __init__(self, docs: DataFrame):
        self.texts = docs.select("doc_id", text_key().alias("text_key"), text_of().alias("text"))
        self.sketches = stored(
            self.texts.mapInArrow(_sketch, "doc_id long, text_key long, n long, digest binary, registers binary"), "sketches"
        )
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
        named = self.sketches.filter("n > 0").groupBy("digest").agg(
            first, F.first("n").alias("n"), F.first("registers").alias("registers")
        )
        self.table = stored(
            named.select(
                F.monotonically_increasing_id().alias("id"), "digest", "n", "registers",
                F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("text_key"),
            ),
            "nodes",
        )

    def sets(self, ids: DataFrame) -> DataFrame:
        """Stored rows (id, shingles) of these nodes, from their texts."""
        wanted = stored(self.table.join(ids, "id", "left_semi").select("id", "doc_id", "text_key"), "wanted")
        texts = join_keys(self.texts, wanted, "inner").select("id", "text")
        return stored(texts.mapInArrow(_packed_sets, "id long, shingles binary").dropDuplicates(["id"]), "sets")


def _sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """Columns of both nodes of a pair."""
    for side in "ab":
        own = table.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        pairs = pairs.join(own, side)
    return pairs


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop_state()
    for batch in slices(batches, "shingles", 1 << 20):
        sets = [unpacked(s) for s in batch.column("shingles").to_pylist()]
        ids = np.repeat(np.asarray(batch.column("id")), [len(s) for s in sets])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), pa.array(ids)], ["shingle", "id"])


def _lists(sets: DataFrame, sizes: DataFrame) -> DataFrame:
    """Stored rows (name, id, n, scans): inverted lists of the rarest shingles, by size class of the smaller set.

    Shingles are ordered by how many of these sets have them, rarest first. Linked sets of n and m
    shingles share one among their first n - o + 1 and m - o + 1, where o is the least overlap of a
    link, so of any such pair the smaller set stands in a list that the larger one scans.
    """
    rows = sets.mapInArrow(_shingle_rows, "shingle long, id long")
    counts = stored(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1"), "open-counts")
    place = F.struct("sets", F.col("shingle").alias("element"))
    shared = rows.join(counts, "shingle").groupBy("id").agg(F.array_sort(F.collect_list(place)).alias("shared"))
    begins = shared.join(sizes, "id").filter(100 * F.size("shared") >= PERCENT * F.col("n"))
    alone = F.col("n") - F.size("shared")
    longest = F.col("n") - F.ceil(F.lit(PERCENT) * F.col("n") / 100) + 1 - F.col("alone")
    begins = begins.withColumn("alone", alone).withColumn("shared", F.slice("shared", F.lit(1), F.greatest(longest, F.lit(0)).cast("int")))
    lists = begins.select("id", "n", "alone", "shared").mapInArrow(listed(0, PERCENT, 1), "name long, id long, n long, scans boolean")
    return stored(lists, "open-lists")


def _compared(pairs: DataFrame, nodes: Nodes, name: str, sets: DataFrame | None = None) -> DataFrame:
    """Stored rows (a, b, both, link) of the pairs that the estimate or, of small sets, their sizes don't rule out."""
    likely = stored(_sides(pairs, nodes.table, "registers", "n").mapInArrow(_estimated, "a long, b long"), f"{name}-likely")
    if sets is None:
        ids = likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).distinct()
        sets = nodes.sets(ids)
    return stored(_sides(likely, sets, "shingles").mapInArrow(_verified, "a long, b long, both long, link boolean"), f"{name}-compared")


def _linked(docs: DataFrame) -> tuple[Nodes, DataFrame, Callable[[str], Column]]:
    """The nodes, rows (node, component) of those with links, and the name of a node where these are joined."""
    nodes = Nodes(docs)
    bands = stored(nodes.table.select("id", "registers").mapInArrow(_banded, "band long, id long"), "bands")
    buckets = bands.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    crowded = stored(bands.join(buckets, "band"), "crowded")

    # The node of each bucket with most company is its centre; a node tries the centre of
    # most of its buckets.
    company = crowded.groupBy("id").agg(F.sum("members").alias("company"))
    centres = crowded.join(company, "id").groupBy("band").agg(F.max(F.struct("company", "id")).alias("centre"))
    shared = stored(
        crowded.join(centres, "band").filter("id != centre.id")
        .groupBy("id", "centre").agg(F.count(F.lit(1)).alias("times")),
        "centres",
    )
    best = shared.groupBy("id").agg(F.max(F.struct("times", "centre")).alias("best"))
    stars = best.select(F.col("best.centre.id").alias("a"), F.col("id").alias("b"))
    starred = _compared(stars, nodes, "star")
    links = starred.filter("link").select("a", "b")
    names = components(links)

    def name_of(node: str) -> Column:
        return F.coalesce(F.col("component"), F.col(node))

    # Where that didn't join them, a node tries its other centres, at most one a band.
    named_a = names.select(F.col("node").alias("a"), F.col("component").alias("name_a"))
    named_b = names.select(F.col("node").alias("b"), F.col("component").alias("name_b"))
    others = shared.select(F.col("centre.id").alias("a"), F.col("id").alias("b")).join(stars, ["a", "b"], "left_anti")
    apart = F.coalesce("name_a", "a") != F.coalesce("name_b", "b")
    others = stored(others.join(named_a, "a", "left").join(named_b, "b", "left").filter(apart).select("a", "b"), "others")
    links = stored(links.unionByName(_compared(others, nodes, "other").filter("link").select("a", "b")), "links")
    names = components(links)

    members = crowded.select("band", "id").join(names, F.col("id") == names["node"], "left")
    members = stored(members.select("band", "id", name_of("id").alias("name")), "members")
    mixed = members.groupBy("band").agg((F.min("name") != F.max("name")).alias("mixed")).filter("mixed")
    open_ = stored(members.join(mixed.select("band"), "band", "left_semi").select("id", "name").distinct(), "open")
    open_sets = nodes.sets(open_.select("id"))
    # Sets of different components that share one of their rarest shingles, the smaller one standing in its list.
    lists = _lists(open_sets, nodes.table.select("id", "n")).withColumnRenamed("name", "list").join(open_, "id")
    several = lists.groupBy("list").agg((F.min("name") != F.max("name")).alias("several")).filter("several").select("list")
    lists = stored(lists.join(several, "list", "left_semi"), "lists")
    x, y = lists.filter("NOT scans").alias("x"), lists.filter("scans").alias("y")
    due = x.join(y, (F.col("x.list") == F.col("y.list")) & (F.col("x.name") != F.col("y.name")) & (F.col("x.n") <= F.col("y.n")))
    rest = due.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    tried = stars.unionByName(others)
    tried = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = _compared(stored(rest.join(tried, ["a", "b"], "left_anti"), "rest"), nodes, "rest", open_sets)
    more = more.filter("link").select("a", "b")
    if more.limit(1).count():
        names = components(links.unionByName(more))
    return nodes, names, name_of


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, n_shingles, component, component_id, kept), one per document.

    Two documents are linked if 100 times the common shingles are at least 75 times all
    of theirs. component_id is the least doc_id that can be reached. Null and empty texts
    and those without words have no shingles and are linked with nothing. Rows with equal
    text are always of one component, also where they share a doc_id; a row without
    doc_id takes part but names no component, and is kept only where no row of its
    component has an id. ``component`` is a number of the component, null where there are no
    shingles; text_key is the hash of the text. Other columns are not read; an empty
    table gives no rows.
    """
    with small_batches(docs.sparkSession):
        nodes, names, name_of = _linked(docs)
    named = nodes.table.join(names, nodes.table["id"] == names["node"], "left").withColumn("name", name_of("id"))
    least = named.groupBy("name").agg(F.min("doc_id").alias("component_id"))
    by_digest = stored(named.join(least, "name").select("digest", F.col("name").alias("component"), "component_id"), "components")
    has = nodes.sketches.filter("n > 0").join(by_digest, "digest").select("doc_id", "text_key", "n", "component", "component_id")
    lone = nodes.sketches.filter("n = 0").select(
        "doc_id", "text_key", "n", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id")
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return has.unionByName(lone).select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), "component", "component_id", kept.alias("kept")
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The documents with one of each component left: that of the least doc_id, then text hash.

    Of rows that repeat one document one is left. Documents without shingles all stay.
    """
    found = stored(near_duplicates(docs).select("doc_id", "text_key", "component"), "duplicates")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    groups = found.filter("component IS NOT NULL")
    first = groups.groupBy("component").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    crowd = stored(groups.join(first, "component").select("doc_id", "text_key", (place == F.col("first")).alias("stays")).distinct(), "crowd")
    rows = keyed(docs)
    alone = join_keys(rows, crowd.select("doc_id", "text_key"), "left_anti")
    left = join_keys(rows, crowd.filter("stays").select("doc_id", "text_key"), "inner").dropDuplicates(["doc_id", "text_key"])
    return alone.unionByName(left).select("row.*")
