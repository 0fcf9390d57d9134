"""Key checks of an append without regrouping history: a Bloom filter per time chunk.

A key lies in one block of the filter by a first hash, and sets a few bits there by others. A
filter is a table of bitmaps (chunk, block, bits), a few kilobytes each, to which an append only
adds rows. New keys meet the bitmaps of their blocks; most meet no bitmap that has all their
bits, and only chunks in which some may be are opened for the exact check.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.buckets import shift, time_bucket
from tideline.session import stored
from tideline.sources.store import CHUNK, ChunkTable, remove_dir

#: Bits of a block, as Spark's bitmap functions have them.
BLOCK_BITS = 32_768
#: Bits that a key sets. With BITS_PER_KEY bits a key, about one new key in 400 passes a chunk by chance.
HASHES = 4
BITS_PER_KEY = 16


def blocks_for(keys: int) -> int:
    """Blocks that a chunk of so many keys should have."""
    return max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS))


@dataclass(frozen=True)
class KeyFilter:
    """Filters over the key of a chunked table, stored beside it.

    ``blocks`` is the same for all chunks (``blocks_for`` of a usual one). With more keys than that
    more of them pass by chance; results stay exact. Keys with a NULL are keys like others,
    and NULLs equal each other. Deleted rows stay in the filter, which costs openings only.
    """

    table: ChunkTable
    key: tuple[str, ...]
    blocks: int

    @property
    def path(self) -> str:
        return f"{self.table.path.rstrip('/')}__keys"

    def _hash(self, n: int) -> Column:
        # A NULL is skipped by the hash, so its place is hashed in its stead.
        parts = [F.struct(F.col(f"`{k}`").isNull(), F.col(f"`{k}`")) for k in self.key]
        return F.xxhash64(F.lit(n), *parts)

    def _chunk(self) -> Column:
        return time_bucket(self.table.chunk_interval, self.table.time_col).cast("date")

    def _block(self) -> Column:
        return F.pmod(self._hash(0), F.lit(self.blocks)).cast("int")

    def _bits(self) -> list[Column]:
        return [F.pmod(self._hash(i), F.lit(BLOCK_BITS)).cast("int") for i in range(1, HASHES + 1)]

    def add(self, rows: DataFrame) -> None:
        """Note the keys of rows, which are those of the table or are being appended to it."""
        places = rows.select(self._chunk().alias(CHUNK), self._block().alias("block"), F.explode(F.array(*self._bits())).alias("_bit"))
        # Bits of a chunk are added up on the map side, a bitmap per task and block.
        bitmaps = places.groupBy(CHUNK, "block").agg(F.bitmap_construct_agg(F.col("_bit").cast("long")).alias("bits"))
        bitmaps.write.mode("append").parquet(self.path)

    def bitmaps(self) -> DataFrame:
        return self.table.spark.read.schema(f"{CHUNK} DATE, block INT, bits BINARY").parquet(self.path)

    def candidates(self, rows: DataFrame) -> DataFrame:
        """Distinct keys of rows with the chunks (start dates) that may hold them.

        A key that has the time meets the bitmaps of its own chunk, another those of all chunks.
        """
        names = [f"_{i}" for i in range(HASHES)]
        keys = rows.select(*self.key).distinct()
        timed = self.table.time_col in self.key
        own = [self._chunk().alias(CHUNK)] if timed else []
        asked = keys.select(*self.key, *own, self._block().alias("block"), *(b.alias(n) for b, n in zip(self._bits(), names)))
        met = asked.join(self.bitmaps(), [CHUNK, "block"] if timed else ["block"])

        def is_set(name: str) -> Column:
            byte = F.expr(f"substring(bits, `{name}` div 8 + 1, 1)")
            return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.expr(f"`{name}` % 8")) == 1

        return met.filter(reduce(lambda a, b: a & b, map(is_set, names))).select(*self.key, CHUNK).distinct()

    def _open(self, chunks: Sequence[date]) -> DataFrame:
        """Stored rows of the chunks, under the wider ones that may hold them by now."""
        starts = [datetime.combine(c, datetime.min.time()) for c in sorted(chunks)]
        touched = self.table.touched([(s, shift(s, self.table.chunk_interval)) for s in starts])
        return self.table.read(chunks=touched)

    def check(self, rows: DataFrame) -> DataFrame:
        """Keys of rows that break uniqueness: (key, copies among the rows, stored before)."""
        found = stored(self.candidates(rows), "key-candidates")
        chunks = [r[CHUNK] for r in found.select(CHUNK).distinct().collect()]
        suspects = found.select(*self.key).distinct()
        same = [F.col(f"h.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in self.key]
        history = self._open(chunks).select(*self.key).alias("h")
        known = suspects.alias("s").join(history, reduce(lambda a, b: a & b, same), "left_semi").withColumn("_stored", F.lit(True))
        copies = rows.groupBy(*self.key).agg(F.count(F.lit(1)).alias("copies"))
        match = [F.col(f"n.`{k}`").eqNullSafe(F.col(f"k.`{k}`")) for k in self.key]
        out = copies.alias("n").join(known.alias("k"), reduce(lambda a, b: a & b, match), "left")
        return out.select(
            *(F.col(f"n.`{k}`") for k in self.key), "copies", F.coalesce("_stored", F.lit(False)).alias("stored")
        ).filter((F.col("copies") > 1) | F.col("stored"))

    def append(self, rows: DataFrame) -> None:
        """Append rows to the table, whose keys are noted first."""
        self.add(rows)
        self.table.append(rows)

    def drop(self) -> None:
        remove_dir(self.table.spark, self.path)
