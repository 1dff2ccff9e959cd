"""Hierarchical residual packing of token pieces into sequences.

Every task packs the pieces of its own documents by best fit, largest first, and emits the bins that are nearly full. Bins left
underfull become items of their filled length for the next round: groups of tasks are merged as a tree, each merge packs the items
of its children by best fit again and emits what is now nearly full, up to one root, which emits the rest.

Items of one length are interchangeable, so a merge is planned on counts of lengths (at most `capacity` of them per child) and its
plan is a short list of segments `the i-th to j-th item of this length go to bins b, b+1, ... at this offset`. Items look up
their segment with one join per round. No list of items ever meets in one place.

Defined cases: a null text is an empty one and gives the end id only; an empty table gives no rows; documents with equal ids are packed
apart; a document of up to `capacity` tokens stays whole, a longer one is cut into full pieces behind a first piece that may be shorter.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import cut, query, read
from tallywright.llm.tokens import default_tokenizer, encoded

CAPACITY = 1024
#: a bin with no more room than this is emitted at once
NEARLY = 8
#: children of a merge
FAN = 64
#: bit width of a bin's number within its task or merge, and of the level
LEVEL_BITS = 3

SEGMENT = "child long, size int, low long, high long, parent long, total int, first long, offset int, done boolean"
PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"
STATE = "node long, size int, nth long, offset int, done boolean"


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Best fit, largest first, on item counts by size.

    Returns kinds of bins: (how many, [(size, nth item of that size in the first of these bins, offset)]); bin k of a kind holds the
    (nth + k)-th item of each part. Equal bins are handled together, so the work follows the number of sizes, not of items.
    """
    open_bins: dict[int, list[tuple[int, list]]] = defaultdict(list)
    for size in np.flatnonzero(counts)[::-1].tolist():
        left, nth = int(counts[size]), 0
        while left:
            room = min((r for r, kinds in open_bins.items() if r >= size and kinds), default=None)
            if room is None:
                many, parts, room = left, [], capacity
            else:
                many, parts = open_bins[room].pop()
            each = min(room // size, left)
            use = min(many, left // each)
            if use < many and parts:
                open_bins[room].append((many - use, [(s, n + use, o) for s, n, o in parts]))
            grown = parts + [(size, nth + i * use, capacity - room + i * size) for i in range(each)]
            open_bins[room - each * size].append((use, grown))
            left -= use * each
            nth += use * each
    return [kind for kinds in open_bins.values() for kind in kinds]


def segments(counts: np.ndarray, capacity: int, nearly: int, last: bool) -> list[tuple]:
    """(size, low, high, total, first, offset, done): items low..high-1 of a size go to bins first, first+1, ...

    Finished bins are numbered from 0; others are numbered from 0 within each total, as items of the next round.
    """
    out, numbers = [], defaultdict(int)
    for many, parts in best_fit(counts, capacity):
        total = sum(s for s, _, _ in parts)
        done = last or capacity - total <= nearly
        first = numbers["done" if done else total]
        numbers["done" if done else total] += many
        out += [(s, n, n + many, total, first, o, done) for s, n, o in parts]
    return out


def pack_pieces(lengths: np.ndarray, capacity: int, nearly: int, last: bool = False) -> dict[str, np.ndarray]:
    """Best fit within one task: size (of the bin), nth, offset and done of each piece."""
    order = np.argsort(lengths, kind="stable")
    counts = np.bincount(lengths, minlength=capacity + 1)
    begin = np.cumsum(counts) - counts
    out = {k: np.zeros(len(lengths), t) for k, t in (("size", np.int32), ("nth", np.int64), ("offset", np.int32), ("done", bool))}
    for size, low, high, total, first, offset, done in segments(counts, capacity, nearly, last):
        at = order[begin[size] + low : begin[size] + high]
        out["size"][at], out["offset"][at], out["done"][at] = total, offset, done
        out["nth"][at] = first + np.arange(high - low)
    return out


def tokenised_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, nearly: int) -> DataFrame:
    """Pieces of every document, packed by best fit within the task that encoded them (`node` is the task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, piece, start, length, crc = [], [], [], [], []
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, tokens in zip(names, encoded((t.as_py() for t in batch.column(1)), tokenizer), strict=True):
                tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                at, k = 0, 0
                size = len(tokens) if len(tokens) <= capacity else (len(tokens) - 1) % capacity + 1
                while at < len(tokens):
                    ids.append(name)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(tokens[at : at + size].tobytes()))
                    at, k, size = at + size, k + 1, capacity
        if not ids:
            return
        sizes = np.array(length, np.int64)
        packed = pack_pieces(sizes, capacity, nearly)
        node = np.full(len(ids), TaskContext.get().partitionId(), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64()),
             pa.array(node), pa.array(packed["size"]), pa.array(packed["nth"]), pa.array(packed["offset"]), pa.array(packed["done"])],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "node", "size", "nth", "offset", "done"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"{PIECE}, {STATE}")


def merged(items: DataFrame, last: bool, capacity: int, nearly: int, fan: int) -> DataFrame:
    """The segments of one round of merges over the items left."""

    def plan(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "node"], kind="stable")
        counts = np.zeros(capacity + 1, np.int64)
        np.add.at(counts, pdf["size"].to_numpy(), pdf["n"].to_numpy())
        by_size = {s: (g["node"].to_numpy(), np.cumsum(g["n"].to_numpy())) for s, g in pdf.groupby("size")}
        rows = []
        for size, low, high, total, first, offset, done in segments(counts, capacity, nearly, last):
            nodes, ends = by_size[size]
            i = int(np.searchsorted(ends, low, side="right"))
            while low < high:
                begin, stop = int(ends[i - 1]) if i else 0, min(high, int(ends[i]))
                rows.append((int(nodes[i]), size, low - begin, stop - begin, key[0], total, first, offset, done))
                first, low, i = first + stop - low, stop, i + 1
        return pd.DataFrame(rows, columns=["child", "size", "low", "high", "parent", "total", "first", "offset", "done"])

    sums = items.groupBy("node", "size").agg((F.max("nth") + 1).alias("n"))
    return sums.groupBy(F.floor(F.col("node") / fan).alias("parent")).applyInPandas(plan, SEGMENT)


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, capacity: int = CAPACITY, nearly: int = NEARLY, fan: int = FAN) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document (doc_id, text)."""
    state = cut(tokenised_pieces(docs, tokenizer or default_tokenizer(), end_id, capacity, nearly))
    top = state.agg(F.max("node")).first()[0]
    sequence = lambda node, nth, level: ((node * F.lit(1 << 34) + nth) * F.lit(1 << LEVEL_BITS) + level).alias("sequence_id")
    result = ["doc_id", "piece", "start", "length", "ids_crc32"]
    placed = [state.where("done").select(*result, sequence(F.col("node"), F.col("nth"), F.lit(0)), "offset")]
    left, level, nodes = state.where("NOT done"), 1, (top or 0) + 1
    while True:
        nodes = -(-nodes // fan)
        plan = cut(merged(left, nodes == 1, capacity, nearly, fan)).withColumnsRenamed({"size": "plan_size", "offset": "shift", "done": "over"})
        here = (F.col("node") == F.col("child")) & (F.col("size") == F.col("plan_size")) & (F.col("nth") >= F.col("low")) & (F.col("nth") < F.col("high"))
        moved = cut(left.join(plan, here).select(
            *result, F.col("parent").alias("node"), F.col("total").alias("size"), (F.col("first") + F.col("nth") - F.col("low")).alias("nth"),
            (F.col("offset") + F.col("shift")).alias("offset"), F.col("over").alias("done")))
        placed.append(moved.where("done").select(*result, sequence(F.col("node"), F.col("nth"), F.lit(level)), "offset"))
        if nodes == 1:
            break
        left, level = moved.where("NOT done"), level + 1
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


@query("op8_sequence_packing")
def sequence_packing(spark, sf_dir):
    rows = pack(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id",
                       F.col("offset").cast("long").alias("offset"))
