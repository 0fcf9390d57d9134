"""Merkle manifest of a dataset by butterfly exchange.

Each row is a leaf, each source a tree, the roots of the trees are the leaves of one more
tree above. Leaves of a tree lie in aligned blocks of ``FANOUT`` ** ``DEPTH``; a block hashes
its own levels. Then blocks swap digests round by round: in round r, those whose
numbers differ in digit r alone (base ``FANOUT``) meet in one small group, hash their common
parent and keep what the others brought as siblings. Every block of a group does so for
itself, so after the last round each one holds the root and all upper siblings, and no pass
leads down again. A group never has more than ``FANOUT`` rows, whatever the tree's size.

The last node of a level may cover fewer blocks than the others. Its blocks then stand in
for those that are absent and send their digest to several groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import numbered_parts
from tideline.session import stored

FANOUT, DEPTH = 16, 2


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    """The digest of a document, with ``text`` as its text."""
    return digest(F.concat(*(field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")), field(text)))


def _ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Leaves with ``rank`` (from 0) and ``leaves`` (how many) in their tree, by range partitions."""
    placed = numbered_parts(leaves, ["tree"], order)
    per = placed.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("here"))
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(
        "tree", "_part", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("start"),
        F.sum("here").over(Window.partitionBy("tree")).alias("leaves"),
    )
    within = F.row_number().over(Window.partitionBy("tree", "_part").orderBy(*order)) - 1
    # One row per tree and partition: a tree that fills many partitions has many rows here too.
    return placed.withColumn("_within", within).join(starts, ["tree", "_part"]).select(
        *leaves.columns, (F.col("start") + F.col("_within")).alias("rank"), "leaves"
    )


def _parents(nodes: Column, fanout: int) -> Column:
    """Digests of every ``fanout`` consecutive nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * fanout + 1, F.lit(fanout)), "")))


def _siblings(nodes: Column, place: Column, fanout: int) -> Column:
    """The other nodes of the run that ``place`` lies in: those to its left and to its right, as text."""
    first = F.floor(place / fanout).cast("int") * fanout
    inside = place - first
    run = F.slice(nodes, first + 1, F.lit(fanout))
    return F.struct(
        F.array_join(F.slice(run, F.lit(1), inside), "").alias("left"),
        F.array_join(F.slice(run, inside + 2, F.lit(fanout)), "").alias("right"),
    )


def _levels(leaves: Column, fanout: int) -> Column:
    """How often ``leaves`` nodes are hashed by ``fanout`` until one remains."""
    steps = F.sequence(F.lit(1), F.lit(64))
    reach = F.aggregate(steps, F.struct(leaves.alias("n"), F.lit(0).alias("levels")), lambda s, _: F.when(
        s["n"] > 1, F.struct(F.ceil(s["n"] / fanout).alias("n"), (s["levels"] + 1).alias("levels"))).otherwise(s))
    return reach["levels"]


def _swapped(blocks: DataFrame, step: int, fanout: int) -> DataFrame:
    """One round: every block that isn't done gets its parent's digest and one more pair of siblings."""
    span = fanout ** step
    node, lane = F.floor(F.col("block") / span), F.col("block") % span
    covered = F.least(F.lit(span), F.col("blocks") - node * span)
    # A node with fewer blocks than lanes serves the lanes beyond by the same blocks again.
    lanes = F.when(node % fanout == 0, F.array(lane)).otherwise(F.sequence(lane, F.lit(span - 1).cast("long"), covered))
    sent = blocks.select("*", node.alias("_node"), lane.alias("_own"), F.explode(lanes).alias("_lane"))
    message = F.struct(
        (F.col("_node") % fanout).cast("int").alias("digit"), "digest",
        F.when(F.col("_lane") == F.col("_own"), F.struct("block", "upper")).alias("receiver"),
    )
    met = sent.groupBy("tree", "levels", "blocks", F.floor(F.col("_node") / fanout).alias("_group"), "_lane").agg(
        F.array_sort(F.collect_list(message)).alias("met")
    )
    digests = F.transform("met", lambda m: m["digest"])
    met = met.select("tree", "levels", "blocks", "met", digests.alias("digests")).withColumn("parent", digest(F.array_join("digests", "")))
    kept = met.select("*", F.explode(F.filter("met", lambda m: m["receiver"].isNotNull())).alias("own"))
    return kept.select(
        "tree", "levels", "blocks", F.col("own.receiver.block").alias("block"), F.col("parent").alias("digest"),
        F.concat("own.receiver.upper", F.array(_siblings(F.col("digests"), F.col("own.digit"), fanout))).alias("upper"),
    )


def forest(leaves: DataFrame, order: list[str], fanout: int = FANOUT, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """Blocks of all trees with their leaves and hashed levels, and what the exchange gave them.

    ``leaves`` has columns tree (not null), leaf and others. Returns stored rows
    (tree, block, nodes, inner): the block's rows in order and its inner levels; and
    rows (tree, block, digest, upper): the tree's root and the block's upper siblings.
    """
    ranked = _ranked(leaves, order)
    size = fanout ** depth
    row = F.struct("rank", *[c for c in leaves.columns if c != "tree"])
    grouped = ranked.groupBy("tree", "leaves", F.floor(F.col("rank") / size).alias("block")).agg(
        F.sort_array(F.collect_list(row)).alias("nodes")
    )
    grouped = grouped.withColumn("levels", _levels(F.col("leaves"), fanout))
    inner = F.array(F.transform("nodes", lambda n: n["leaf"]))
    for step in range(depth):
        above = F.element_at("inner", -1)
        grouped = grouped.withColumn("inner", inner) if not step else grouped
        grouped = grouped.withColumn(
            "inner", F.when(F.col("levels") > step, F.concat("inner", F.array(_parents(above, fanout)))).otherwise(F.col("inner"))
        )
    blocks = stored(grouped, "blocks")
    state = blocks.select(
        "tree", "levels", F.ceil(F.col("leaves") / size).alias("blocks"), "block",
        F.element_at("inner", -1)[0].alias("digest"), F.array().cast("array<struct<left string, right string>>").alias("upper"),
    )
    rounds = blocks.agg(F.max("levels")).first()[0] or 0
    done = []
    for step in range(rounds - depth):
        done.append(state.filter(F.col("levels") <= depth + step).select("tree", "block", "digest", "upper"))
        state = stored(_swapped(state.filter(F.col("levels") > depth + step), step, fanout), "swapped")
    found = state.select("tree", "block", "digest", "upper")
    for rows in done:
        found = found.unionByName(rows)
    return blocks.select("tree", "block", "nodes", "inner"), found


def _proven(blocks: DataFrame, found: DataFrame, columns: list[str], fanout: int) -> DataFrame:
    """One row per leaf: its columns, tree, rank, and what its block found; ``proof`` leads from the leaf to the end of ``upper``."""
    place = F.col("at")
    # The last inner level of a block is its root; the levels below it have the siblings.
    below = F.transform(F.expr("slice(inner, 1, size(inner) - 1)"), lambda nodes, k: F.struct(nodes.alias("nodes"), k.alias("k")))
    lower = F.transform(below, lambda b: _siblings(
        b["nodes"], F.floor(place / F.pow(F.lit(fanout), b["k"])).cast("int"), fanout))
    rows = blocks.join(found, ["tree", "block"]).select("*", F.posexplode("nodes").alias("at", "node"))
    return rows.select(
        *(F.col(f"node.{c}").alias(c) for c in columns), F.col("node.rank").alias("rank"),
        *(c for c in found.columns if c not in ("block", "upper")), F.concat(lower, F.col("upper")).alias("proof"),
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda node, level: digest(F.concat(level["left"], node, level["right"])))


def proof_text(proof: Column) -> Column:
    """All siblings, level by level, from left to right."""
    return F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), "")


def manifest(docs: DataFrame, changed: Column | None = None, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """Rows (doc_id, source, rank, leaf, changed_leaf, subroot, root, proof), one per document.

    ``docs`` has doc_id, source, lang, n_chars and text; others are not read. A source's leaves
    ascend by doc_id, nulls first, rows of one doc_id by their leaf; equal rows are
    leaves of their own. Null is a source of its own, which comes first. ``proof`` has
    the siblings per level from the leaf up to the root, as texts left and right of the path.
    ``changed`` is another text for the document (null: the text's own null); changed_leaf is its leaf.
    An empty table gives no rows. Texts are hashed where they lie and never moved.
    """
    text = F.col("text")
    leaf = leaf_of(text)
    other = leaf if changed is None else F.when(changed.eqNullSafe(text), leaf).otherwise(leaf_of(changed))
    # A source's name with a mark before it: null sorts first and differs from an empty name.
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    leaves = docs.select(tree.alias("tree"), "doc_id", leaf.alias("leaf"), other.alias("changed_leaf"))
    blocks, found = forest(leaves, ["doc_id", "leaf", "changed_leaf"], fanout, depth)
    found = stored(found.withColumnRenamed("digest", "subroot"), "proofs")
    tops = found.filter("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("leaf"))
    top_blocks, top_found = forest(tops, ["name"], fanout, depth)
    top = _proven(top_blocks, top_found.withColumnRenamed("digest", "root"), ["name"], fanout)
    top = stored(top.select(F.col("name").alias("tree"), "root", F.col("proof").alias("top")), "tops")
    # Blocks, not leaves, take up what their source has above it.
    whole = found.join(top, "tree").select("tree", "block", "subroot", "root", F.concat("upper", "top").alias("upper"))
    source = F.when(F.col("tree") != "", F.expr("substring(tree, 2)"))
    return _proven(blocks, whole, ["doc_id", "leaf", "changed_leaf"], fanout).select(
        "doc_id", source.alias("source"), "rank", "leaf", "changed_leaf", "subroot", "root", "proof"
    )
