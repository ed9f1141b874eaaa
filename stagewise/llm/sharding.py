"""Longest-processing-time sharding of groups that must stay together.

Groups of rows, sorted by size, go one by one to the least-loaded shard, which a
heap names.  Only sizes matter for that, so one task streams the distinct group
sizes from the largest down with the heap of shard loads as its whole state: a
size that few groups have takes one heap step a group; of a size with more groups
than shards, a level is found below which every step must end, and only the last
steps, at most one a shard, go through the heap.  Both give what the heap alone
would.  There are at most sqrt(2 * all bytes) distinct sizes, whatever the rows.

Groups of one size are told apart by their place in a global order: range
partitions, sorted, with the counts of the partitions before.  No group, size or
shard is ever gathered in a task.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stagewise.llm.common import attach, cut, plus

ROW_BYTES = 16


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``place`` (long): the row's place, from 0, in the order of ``order`` over the whole table.

    Rows equal in all of ``order`` share a range partition, so it should tell them apart.
    """
    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            places = np.arange(at, at + b.num_rows, dtype=np.int64)
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int64)), pa.array(places)], names=[*b.schema.names, "_part", "_at"])
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = cut(parts.mapInArrow(run, plus(df.schema, "_part long, _at long")), name)
    counts = table.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return table.join(starts, "_part").withColumn("place", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


class Loads:
    """The shards' loads and the heap over them; equal loads go by shard."""

    def __init__(self, shards: int):
        self.load = [0] * shards
        self.heap = [(0, s) for s in range(shards)]

    def level(self, size: int, n: int) -> int:
        """The largest level such that at most ``n`` steps of ``size`` begin below it."""
        low, high = min(self.load), max(self.load) + size * n + 1
        while high - low > 1:
            mid = (low + high) // 2
            steps = sum(-((x - mid) // size) for x in self.load if x < mid)
            low, high = (mid, high) if steps <= n else (low, mid)
        return low

    def place(self, size: int, n: int) -> list[int]:
        """How many of ``n`` groups of ``size`` each shard gets."""
        got = [0] * len(self.load)
        if n > len(got):
            level = self.level(size, n)
            got = [max(0, -((x - level) // size)) for x in self.load]
            self.load = [x + size * k for x, k in zip(self.load, got)]
            self.heap = [(x, s) for s, x in enumerate(self.load)]
            heapq.heapify(self.heap)
        for _ in range(n - sum(got)):
            load, s = self.heap[0]
            heapq.heapreplace(self.heap, (load + size, s))
            self.load[s] = load + size
            got[s] += 1
        return got


def plan(sizes: DataFrame, shards: int) -> DataFrame:
    """(size, ends, shards) of every row of ``sizes`` (size, n): among the size's groups, those with a
    place below ``ends[i]`` and not below the end before go to ``shards[i]``."""
    def run(batches):
        loads = Loads(shards)
        for b in batches:
            ends, into = [], []
            for size, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = loads.place(size, n)
                hit = [s for s in range(shards) if got[s]]
                into.append(hit)
                ends.append(np.cumsum([got[s] for s in hit]).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ends, pa.list_(pa.int64())), pa.array(into, pa.list_(pa.int32()))], names=["size", "ends", "shards"])
    one = sizes.select("size", "n").repartition(1).sortWithinPartitions(F.desc("size"))
    return one.mapInArrow(run, "size long, ends array<long>, shards array<int>")


def assign(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` (key, size > 0, ...) with ``shard``; groups of one size are told apart by (first, key)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    table = numbered(groups, [F.desc("size"), F.asc_nulls_last("first"), F.asc("key")], "groups")
    table = cut(table, "groups-placed")
    sizes = cut(table.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("start")), "sizes")
    planned = sizes.join(plan(sizes, shards), "size")
    # a size that many groups have is a hot key: its row is broadcast, at most 256 of them
    total = max(1, table.count())
    out = attach(table, planned, "size", "n", total, ["start", "ends", "shards"])
    return out.withColumn("shard", F.expr("shards[cast(size(filter(ends, e -> e <= place - start)) as int)]")).drop("place", "start", "ends", "shards")


def shard(docs: DataFrame, shards: int = 40, row_bytes: int = ROW_BYTES, together: Column | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text, ...).

    ``size`` is the UTF-8 bytes of the text plus ``row_bytes`` (at least 1); a
    null text is empty.  Rows equal in ``together`` (the text, unless another
    column is given; null is empty) go to one shard; so do groups whose 64-bit hashes meet, which
    breaks no promise.  Shard loads are those of the longest-processing-time
    rule: at most 4/3 - 1/(3 * shards) times the best possible largest load.
    A group above that load makes its shard larger.  ``slot`` numbers a shard's
    rows from 0 in the order of doc_id (null last), then of the group; repeated
    rows each have a slot.  The result depends on the rows alone, not on their
    partitioning.  An empty table gives no rows; other columns are not read.
    """
    if row_bytes < 1:
        raise ValueError("row_bytes must be at least 1")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.xxhash64(text if together is None else F.coalesce(together.cast("string"), F.lit("")))
    rows = docs.select("doc_id", (F.octet_length(text) + row_bytes).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("key"))
    rows = cut(rows, "rows")
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    placed = cut(assign(groups, shards), "placed")
    total = max(1, rows.count())
    out = attach(rows, placed.select("key", "n", "shard"), "key", "n", total, ["shard"])
    # the last column only spreads repeated rows, which are alike
    out = cut(out.withColumn("_any", F.monotonically_increasing_id()), "sharded")
    out = numbered(out, [F.asc("shard"), F.asc_nulls_last("doc_id"), F.asc("key"), F.asc("_any")], "slots")
    counts = out.groupBy("shard").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    starts = counts.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    out = out.join(F.broadcast(starts), "shard")  # a row for each shard
    return out.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("place") - F.col("_start")).cast("long").alias("slot"))
