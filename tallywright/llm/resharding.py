"""Resharding by a minimum-cost flow: from old shard sizes and new capacities to block transfers that move the fewest bytes.

An old shard is a set of files. Its documents form a line, file by file and block by block (a block is one hash bucket of one file, about
a megabyte). The flow between old and new shards says how many bytes of each line stay and how many go to each other shard;
laid along the line, these amounts are intervals. A block inside one interval goes where the interval goes; only the few blocks that an
interval ends in are looked at document by document. Files whose documents all stay are kept as they are; the others are rewritten.

Law kept: `bytes`. Every new shard ends within one document of its capacity for each transfer that touches it.

Defined cases: a null text has no bytes and size 1; null ids sort first; repeated rows are documents of their own; an empty table gives an
empty layout; a document longer than a capacity is placed whole, in the interval that holds its middle byte.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.llm.common import cut, fresh_folder, query, read

BLOCK_BYTES = 1 << 20


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def cheapest_flow(supply: list[int], room: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Amounts old -> new that use all supply within the rooms at least cost: successive shortest paths with potentials.

    The network has one node per shard, never one per document; its size is the number of shards squared.
    """
    n, m = len(supply), len(room)
    flow = [[0] * m for _ in range(n)]
    left, free = list(supply), list(room)
    high = [0] * (n + m)  # potentials: old shards, then new ones
    while any(left):
        dist, back = [float("inf")] * (n + m), [-1] * (n + m)
        heap = [(0, i) for i in range(n) if left[i]]
        for _, i in heap:
            dist[i] = 0
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            reach = ((n + j, cost[u][j]) for j in range(m)) if u < n else ((i, -cost[i][u - n]) for i in range(n) if flow[i][u - n])
            for v, c in reach:
                if (new := d + c + high[u] - high[v]) < dist[v]:
                    dist[v], back[v] = new, u
                    heapq.heappush(heap, (new, v))
        ends = [n + j for j in range(m) if free[j] and dist[n + j] < float("inf")]
        if not ends:
            raise ValueError("the new capacities do not hold all bytes")
        end = min(ends, key=lambda v: (dist[v] + high[v], v))
        path = [end]
        while back[path[-1]] != -1:
            path.append(back[path[-1]])
        path.reverse()
        amount = min([left[path[0]], free[end - n], *(flow[b][a - n] for a, b in zip(path, path[1:], strict=False) if a >= n)])
        for a, b in zip(path, path[1:], strict=False):
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        free[end - n] -= amount
        bound = dist[end]
        high = [h + min(d, bound) for h, d in zip(high, dist, strict=True)]
    return flow


@dataclass(frozen=True)
class Transfer:
    """Bytes low..high-1 of an old shard's line belong to new shard `to`."""

    old: int
    low: int
    high: int
    to: int


def transfers(old_sizes: list[int], new_shards: int, move_cost: int = 1) -> list[Transfer]:
    """Equal capacities; staying is free, a moved byte costs `move_cost`. What stays comes first on each line."""
    total = sum(old_sizes)
    room = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    cost = [[0 if i == j else move_cost for j in range(new_shards)] for i in range(len(old_sizes))]
    out = []
    for i, row in enumerate(cheapest_flow(old_sizes, room, cost)):
        at = 0
        for j in sorted(range(new_shards), key=lambda j: (j != i, j)):
            if row[j]:
                out.append(Transfer(i, at, at + row[j], j))
                at += row[j]
    return out


def target(plan: list[Transfer], old: Column, middle: Column) -> Column:
    """The new shard of a byte of an old shard's line. The plan has at most old + new shards - 1 entries beyond those that stay."""
    by_old: dict[int, list[Transfer]] = {}
    for t in plan:
        by_old.setdefault(t.old, []).append(t)
    out = F.lit(None).cast("int")
    for i, row in by_old.items():
        here = F.lit(row[-1].to)
        for t in reversed(row[:-1]):
            here = F.when(middle < t.high, t.to).otherwise(here)
        out = F.when(old == i, here).otherwise(out)
    return out


KEY = ["old_shard", "file", "bucket"]


def bucketed(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds size and bucket; the number of buckets of a file follows from the mean size of files."""
    size = size_of(F.col("text"))
    told = docs.select(size.alias("size"), "file").agg(F.sum("size"), F.approx_count_distinct("file")).first()
    buckets = max(1, -(-(told[0] or 0) // (block_bytes * max(1, told[1] or 1))))
    return docs.withColumn("size", size).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))


def plan_blocks(docs: DataFrame, old_shards: int, new_shards: int) -> tuple[list[Transfer], DataFrame]:
    """The transfers, and per block: n, begin (bytes before it on its line), whole (its new shard, null if an interval ends in it), stays."""
    blocks = cut(docs.groupBy(*KEY).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")))
    sizes = {r[0]: r[1] for r in blocks.groupBy("old_shard").agg(F.sum("bytes")).collect()}
    plan = transfers([sizes.get(i, 0) for i in range(old_shards)], new_shards)
    line = W.partitionBy("old_shard").orderBy("file", "bucket")
    blocks = blocks.withColumn("begin", F.sum("bytes").over(line) - F.col("bytes"))
    low, high = target(plan, F.col("old_shard"), F.col("begin")), target(plan, F.col("old_shard"), F.col("begin") + F.col("bytes") - 1)
    blocks = blocks.withColumn("whole", F.when(low == high, low))
    stays = F.coalesce(F.col("whole") == F.col("old_shard"), F.lit(False))
    blocks = blocks.withColumn("stays", F.min(stays).over(W.partitionBy("old_shard", "file")))
    return plan, cut(blocks.select(*KEY, "n", "begin", "whole", "stays"))


def placed_rows(docs: DataFrame, blocks: DataFrame, plan: list[Transfer]) -> DataFrame:
    """Rows of the given blocks with nth (place in their block) and shard.

    The one exchange of the texts is by block; it serves the join, the places within blocks and the writing.
    """
    inside = W.partitionBy(*KEY).orderBy("doc_id", "size")
    rows = docs.join(blocks, KEY).withColumn("nth", (F.row_number().over(inside) - 1).cast("int"))
    until = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0))
    middle = F.col("begin") + until - F.floor((F.col("size") + 1) / 2)
    return rows.withColumn("middle", middle).withColumn("shard", F.coalesce(F.col("whole"), target(plan, F.col("old_shard"), F.col("middle"))))


def rewrite(docs: DataFrame, old_shards: int = 8, new_shards: int = 8, block_bytes: int = BLOCK_BYTES, into: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Carry the plan out: returns (placed rows, files).

    docs needs doc_id, text, `old_shard` (0 to old_shards - 1) and `file`. placed: doc_id, text, shard, slot, file, moved. Rows of files
    that stay are read from where they are, all others from files written below `into`, one folder for each new shard. files: file, stays.
    """
    spark = docs.sparkSession
    out = into or fresh_folder(spark, "shards")
    docs = bucketed(docs, block_bytes)
    plan, blocks = plan_blocks(docs, old_shards, new_shards)
    columns = ["doc_id", "text", *KEY, "nth", "shard"]
    placed_rows(docs, blocks.where("NOT stays"), plan).select(*columns).write.partitionBy("shard").parquet(out)
    written = spark.read.schema("doc_id long, text string, old_shard int, file string, bucket int, nth int, shard int").parquet(out)
    # slots are gapless within a shard: documents of the blocks before, then the order inside the block
    part = ["shard", *KEY]
    counts = (written.groupBy(*part).agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
              .unionByName(blocks.where("stays").select(F.col("whole").alias("shard"), *KEY, "n", F.lit(0).alias("first"))))
    run = W.partitionBy("shard").orderBy(*KEY)
    counts = cut(counts.select(*part, "first", (F.sum("n").over(run) - F.col("n")).alias("before")))
    rows = written.select(*columns).unionByName(placed_rows(docs, blocks.where("stays"), plan).select(*columns))
    placed = rows.join(counts, part).select("doc_id", "text", "shard", (F.col("before") + F.col("nth") - F.col("first")).cast("long").alias("slot"), "file",
                                            (F.col("shard") != F.col("old_shard")).alias("moved"))
    return placed, blocks.groupBy("file").agg(F.min("stays").alias("stays"))


def by_file(docs: DataFrame, shards: int) -> DataFrame:
    """The layout that a table has now: whole files, dealt to shards by a hash of their names."""
    return docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file")).withColumn("old_shard", F.pmod(F.xxhash64("file"), F.lit(shards)).cast("int"))


@query("op7_flow_resharding")
def flow_resharding(spark, sf_dir):
    placed, _ = rewrite(by_file(read(spark, sf_dir, "documents"), 8))
    return placed.select("doc_id", size_of(F.col("text")).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
                         F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
