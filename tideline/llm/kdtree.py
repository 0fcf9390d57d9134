"""Sharding by a k-d tree over metadata, with leaves of nearly equal bytes.

Every node cuts its rows at the weighted median of its widest dimension. The median is
exact and found without bringing a node into one task: rows are range-partitioned by
(node, coordinate), and running sums of bytes tell each row its side. One level of the
tree is one such pass over slim rows; texts are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import running_total, text_of
from tideline.session import stored


def code(column: str) -> Column:
    """A place in [0, 1) for a value without order; equal values share it, null is -1."""
    spread = F.crc32(F.col(column).cast("string").cast("binary")) / F.lit(2.0**32)
    return F.when(F.col(column).isNull(), F.lit(-1.0)).otherwise(spread)


def number(column: str) -> Column:
    """A numeric dimension; null lies below all values."""
    return F.coalesce(F.col(column).cast("double"), F.lit(-1e308 / 2))


def _widest(rows: DataFrame, count: int, ranges: list[float]) -> DataFrame:
    """Per node: total bytes, and its widest dimension in shares of the whole table's width."""
    widths = F.array(
        *(
            ((F.max(F.col("dims")[i]) - F.min(F.col("dims")[i])) / F.lit(ranges[i] or 1.0))
            for i in range(count)
        )
    )
    nodes = rows.groupBy("node", "leaves").agg(F.sum("size").alias("total"), widths.alias("widths"))
    widest = F.array_position("widths", F.array_max("widths")).cast("int")
    return nodes.select("node", "leaves", "total", widest.alias("dim"))


def kd_shards(
    rows: DataFrame,
    dims: Sequence[Column],
    size: Column,
    tie: Sequence[Column],
    leaves: int | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """Give every row a leaf of the tree; ``rows`` keeps its columns as ``row``.

    Give the number of ``leaves``, or ``target_bytes`` for one leaf per so many bytes.
    A node for k leaves sends the share floor(k/2)/k of its bytes to the left, so any
    number of leaves comes out even; for k = 2, 4, 8 the cut is the weighted median.
    Rows of one coordinate are cut in the order of ``tie``, then of an id of the row:
    a value that fills a third of the table doesn't unbalance the leaves.

    Returns row (struct), shard (from 0), slot (from 0 without gaps in each shard, in
    the order of ``tie``) and size. Null dimensions lie below others; an empty table
    gives no rows; repeated rows are rows of their own. Shards can stay empty only
    where there are fewer rows than leaves.
    """
    points = stored(
        rows.select(
            F.struct("*").alias("row"),
            F.array(*dims).alias("dims"),
            size.cast("long").alias("size"),
            F.struct(*(c.alias(f"t{i}") for i, c in enumerate(tie))).alias("tie"),
            F.monotonically_increasing_id().alias("id"),
        ),
        "points",
    )
    count = len(dims)
    whole = points.agg(
        F.sum("size"), *(F.max(F.col("dims")[i]) - F.min(F.col("dims")[i]) for i in range(count))
    ).first()
    if leaves is None:
        leaves = max(1, math.ceil((whole[0] or 0) / target_bytes))
    ranges = [float(w or 0.0) for w in whole[1:]]
    placed = points.withColumns({"node": F.lit(0).cast("long"), "leaves": F.lit(leaves)})
    for _ in range(math.ceil(math.log2(leaves)) if leaves > 1 else 0):
        placed = _cut(placed, count, ranges)
    # Leaves come out in the order of the tree; a node's number is its first leaf.
    slots = running_total(placed, ["node"], ["tie", "id"], F.lit(1).cast("long"), "slot")
    return slots.select("row", F.col("node").cast("int").alias("shard"), "slot", "size")


def _cut(placed: DataFrame, count: int, ranges: list[float]) -> DataFrame:
    """One level: nodes for several leaves are cut in two, others stay as they are."""
    nodes = _widest(placed, count, ranges)
    wide = placed.join(nodes.drop("leaves"), "node")
    at = wide.withColumn("at", F.element_at("dims", F.col("dim")))
    summed = running_total(at, ["node"], ["at", "tie", "id"], F.col("size"), "before")
    left = F.floor(F.col("leaves") / 2).cast("int")
    goes_left = (F.col("before") + F.col("size") / 2) * F.col("leaves") <= F.col("total") * left
    grown = summed.withColumns(
        {
            "node": F.when((F.col("leaves") == 1) | goes_left, F.col("node")).otherwise(F.col("node") + left),
            "leaves": F.when(F.col("leaves") == 1, F.col("leaves"))
            .when(goes_left, left)
            .otherwise(F.col("leaves") - left),
        }
    )
    return stored(grown.select("row", "dims", "size", "tie", "id", "node", "leaves"), "level")


def document_shards(docs: DataFrame, leaves: int = 8, target_bytes: int | None = None) -> DataFrame:
    """Shards of documents by language, source, size and id; size is UTF-8 bytes plus 1."""
    size = F.octet_length(text_of()) + 1
    slim = docs.select(
        "doc_id", "lang", "source", size.cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    return kd_shards(
        slim,
        [code("lang"), code("source"), number("size"), number("doc_id")],
        F.col("size"),
        [F.col("doc_id"), F.col("text_crc32")],
        leaves,
        target_bytes,
    )
