"""Shards of near equal size by best-fit-decreasing bin packing.

Rows with equal texts form a group that stays in one shard. Groups are the items; small ones
(below a set fraction of a shard) are first bundled by hash, so the number of items has a bound
that does not depend on the input, and only their sizes reach the driver. Each item, largest
first, enters the bin with the tightest remaining capacity that still holds it; bins are kept in
a balanced search tree by remaining capacity.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents, prefix_sum, stored

#: Parts of a shard: a group of at least 1/FINE of a shard's size is an item of its own.
FINE = 250


class _Tree:
    """A treap of (remaining capacity, bin): find the least that is not below a size, add, remove."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]
        self.draw = random.Random(5)

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, key: tuple[int, int]) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self.draw.random(), None, None]), right)

    def remove(self, key: tuple[int, int]) -> None:
        left, right = self._split(self.root, key)
        _, right = self._split(right, (key[0], key[1] + 1))
        self.root = self._merge(left, right)

    def tightest(self, size: int) -> tuple[int, int] | None:
        node, best = self.root, None
        while node is not None:
            if node[0] >= (size, -1):
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each item (``sizes`` must fall); new bins open as needed, or None beyond ``most``."""
    tree, bins, out = _Tree(), 0, []
    for size in sizes:
        got = tree.tightest(size)
        if got is None:
            if size > capacity or bins == most:
                return None
            got = (capacity, bins)
            bins += 1
        else:
            tree.remove(got)
        tree.add((got[0] - size, got[1]))
        out.append(got[1])
    return out


def level_bins(sizes: list[int], bins: int) -> list[int]:
    """Bins of near equal load: the least capacity at which best-fit-decreasing needs ``bins`` bins.

    ``sizes`` must fall. An item above its fair share takes a bin alone, and the rest is levelled
    over the other bins.
    """
    alone, total = 0, sum(sizes)
    while alone < bins - 1 and alone < len(sizes) and sizes[alone] * (bins - alone) > total:
        total -= sizes[alone]
        alone += 1
    rest, free = sizes[alone:], bins - alone
    low = max(rest[0] if rest else 0, -(-total // free))
    got, high = None, low
    while got is None:
        got = best_fit_decreasing(rest, high, free)
        if got is None:
            low, high = high + 1, high + max(1, high // 1000)
    while low < high:
        middle = (low + high) // 2
        tried = best_fit_decreasing(rest, middle, free)
        if tried is None:
            low = middle + 1
        else:
            got, high = tried, middle
    return [*range(alone), *(alone + b for b in got)]


def shard_rows(docs: DataFrame, shards: int = 24, fine: int = FINE) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    Size is the text's UTF-8 bytes plus 8 (NULL text: 8). Rows with equal texts share a shard
    (NULL texts are one group, empty texts another). Slots number a shard's rows from 0 without
    gaps. A group larger than a shard's share takes a shard alone. NULL doc_ids and repeated rows
    are placed like any other row; an empty table gives no rows; other columns are not read.
    """
    text = F.col("text")
    rows = stored(docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text)).alias("_group"),
        F.monotonically_increasing_id().alias("_row")), "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = stored(rows.groupBy("_group").agg(F.sum("size").alias("_bytes")), "shard-groups")
    # at most shards * fine groups reach this size, and there are as many bundles
    large = F.col("_bytes") * (shards * fine) >= total
    bundle = F.pmod(F.xxhash64("_group"), F.lit(shards * fine))
    items = (groups.select(F.when(large, F.col("_group")).alias("_group"),
                           F.when(~large, bundle).alias("_bundle"), "_bytes")
             .groupBy("_group", "_bundle").agg(F.sum("_bytes").alias("_bytes")).collect())
    items.sort(key=lambda r: (-r["_bytes"], r["_group"] is None, r["_group"] or 0, r["_bundle"] or 0))
    bins = level_bins([r["_bytes"] for r in items], shards) if items else []
    spark = docs.sparkSession
    own = spark.createDataFrame([(r["_group"], b) for r, b in zip(items, bins) if r["_group"] is not None],
                                "_group long, _own int")
    bundled = spark.createDataFrame([(r["_bundle"], b) for r, b in zip(items, bins) if r["_group"] is None],
                                    "_bundle long, _bundled int")
    # both tables have at most shards * fine rows
    placed = (rows.withColumn("_bundle", bundle)
              .join(F.broadcast(own), "_group", "left").join(F.broadcast(bundled), "_bundle", "left")
              .withColumn("shard", F.coalesce("_own", "_bundled")))
    return prefix_sum(placed, ["shard"], ["doc_id", "_row"], F.lit(1), "slot") \
        .select("doc_id", "size", "text_crc32", "shard", "slot")


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    return shard_rows(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
