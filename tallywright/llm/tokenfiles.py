"""Token id files compressed by Re-Pair grammars, decodable at any document.

Documents are dealt to tasks by ranges of doc_id and sorted, so files follow ascending doc_id. Within a file, each row is a shard: a run
of whole documents of about `SHARD_TOKENS` ids. In a shard the most frequent pairs of neighbouring ids are replaced by new
symbols (nonterminals), round by round, until no pair is frequent; pairs of one round are chosen so that their occurrences
cannot overlap, and a pair never spans two documents. The row stores, all little-endian:

    rules       uint32 pairs; rule k is the symbol FIRST_RULE + k and may use earlier rules
    lengths     uint32 per rule, ids that it expands to
    symbols     uint32, the compressed ids of all documents of the shard
    doc_symbol  uint32, first symbol of each document, and the end
    doc_token   uint64, ids of the file before each document, and the end
    doc_ids     list of the documents' ids

Lengths let a reader skip symbols without expanding them (`tokens_between`).

Defined cases: a null text is an empty one and holds the end id only; null ids come first; documents with equal ids stay neighbours; a
document longer than a shard is a shard of its own; an empty table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.llm.common import cut, fresh_folder, query, read
from tallywright.llm.tokens import default_tokenizer, encoded

SHARD_TOKENS = 1 << 19
#: symbols from here on are rules; below are ids of the tokenizer
FIRST_RULE = 1 << 24
#: a pair is frequent from this many places on: a rule takes 12 bytes and saves 4 at each place, so with fewer nothing is saved
LEAST_COUNT = 4
_TABLE_BITS = 18

SCHEMA = ("part int, shard int, n_docs int, n_tokens long, doc_ids array<long>, rules binary, lengths binary, symbols binary, "
          "doc_symbol binary, doc_token binary")


def frequent_pairs(key: np.ndarray, least: int, wide: int, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent ones of the pairs left * wide + right, of symbols below room, most frequent first, none able to overlap another; which places may be
    frequent."""
    slot = ((key * key.dtype.type(0x9E3779B1)) & key.dtype.type(0xFFFFFFFF)) >> key.dtype.type(32 - _TABLE_BITS)
    counts = np.bincount(slot, minlength=1 << _TABLE_BITS)
    likely = (counts >= least)[slot]
    key = key[likely]  # only what may be frequent is sorted
    key.sort()
    start = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    n = np.diff(np.append(start, len(key)))
    key, n = key[start][n >= least], n[n >= least]
    key = key[np.lexsort((key, -n))]
    left, right = key // key.dtype.type(wide), key % key.dtype.type(wide)
    apart = np.flatnonzero(left != right)
    lefts, rights = bytearray(room), bytearray(room)
    chosen = []
    for i, a, b in zip(apart.tolist(), left[apart].tolist(), right[apart].tolist(), strict=True):
        if not (rights[a] or lefts[b]):
            lefts[a] = rights[b] = 1
            chosen.append(i)
    return key[chosen], likely


def compress(tokens: np.ndarray, doc_ends: np.ndarray) -> dict[str, np.ndarray]:
    """rules (k, 2), lengths, symbols and doc_symbol of one shard. doc_ends: ends of its documents within tokens."""
    # the ids in use are numbered densely, rules follow them: pairs mostly fit 32 bits
    used = np.zeros(int(tokens.max(initial=0)) + 1, bool)
    used[tokens] = True
    alphabet = np.flatnonzero(used).astype(np.uint32)
    dense = np.zeros(len(used), np.uint32)
    dense[alphabet] = np.arange(len(alphabet))
    seq = dense[tokens]
    last = np.zeros(len(seq), bool)
    last[doc_ends - 1] = True
    rules, lengths = np.zeros((0, 2), np.uint32), np.ones(len(alphabet), np.uint32)
    # A pair of two older symbols never comes more often than before. So a round looks only at places that may have been
    # frequent in the last one, and at those beside a symbol that is new since.
    places = np.flatnonzero(~last[:-1])
    while len(places):
        room = len(alphabet) + len(rules)
        wide = 1 << 16 if room <= 1 << 16 else 1 << 31
        kind = np.uint32 if wide == 1 << 16 else np.uint64
        first, second = seq[places], seq[places + 1]
        key = first.astype(kind) * kind(wide) + second.astype(kind)
        chosen, frequent = frequent_pairs(key, LEAST_COUNT, wide, room)
        if not len(chosen):
            break
        # a pair is looked up by its two sides: each symbol is only ever on one
        left, right = chosen // kind(wide), chosen % kind(wide)
        order = np.argsort(chosen)
        table = chosen[order]
        is_left = np.zeros(room, bool)
        is_left[left] = True
        is_right = np.zeros(room, bool)
        is_right[right] = True
        likely = np.flatnonzero(is_left[first] & is_right[second] & frequent)
        at = np.minimum(np.searchsorted(table, key[likely]), len(table) - 1)
        sure = table[at] == key[likely]
        hit = places[likely[sure]]
        seq[hit], last[hit] = room + order[at[sure]], last[hit + 1]
        look = np.zeros(len(seq), bool)
        look[places[frequent]] = look[hit] = look[np.maximum(hit - 1, 0)] = True
        keep = np.ones(len(seq), bool)
        keep[hit + 1] = False
        seq, last, look = seq[keep], last[keep], look[keep]
        places = np.flatnonzero(look[:-1] & ~last[:-1])
        rules = np.concatenate([rules, np.stack([left, right], 1).astype(np.uint32)])
        lengths = np.concatenate([lengths, lengths[left] + lengths[right]])
    names = np.concatenate([alphabet, np.arange(FIRST_RULE, FIRST_RULE + len(rules), dtype=np.uint32)])
    ends = np.flatnonzero(last) + 1
    return {"rules": names[rules], "lengths": lengths[len(alphabet):], "symbols": names[seq], "doc_symbol": np.concatenate([[0], ends]).astype(np.uint32)}


def expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """All ids that a run of symbols stands for."""
    while len(at := np.flatnonzero(symbols >= FIRST_RULE)):
        pair = rules[symbols[at] - FIRST_RULE]
        wide = np.ones(len(symbols), np.int64)
        wide[at] = 2
        place = np.cumsum(wide) - wide
        out = np.repeat(symbols, wide)
        out[place[at]], out[place[at] + 1] = pair[:, 0], pair[:, 1]
        symbols = out
    return symbols


def unpack(row: dict) -> dict[str, np.ndarray]:
    out = {k: np.frombuffer(row[k], "<u4") for k in ("rules", "lengths", "symbols", "doc_symbol")}
    return out | {"rules": out["rules"].reshape(-1, 2), "doc_token": np.frombuffer(row["doc_token"], "<u8")}


def tokens_between(row: dict, doc: int, start: int, stop: int) -> np.ndarray:
    """Ids start..stop-1 of the doc-th document of a shard row; only symbols that reach into the range are expanded."""
    s = unpack(row)
    symbols = s["symbols"][s["doc_symbol"][doc] : s["doc_symbol"][doc + 1]]
    wide = np.ones(len(symbols), np.int64)
    rule = symbols >= FIRST_RULE
    wide[rule] = s["lengths"][symbols[rule] - FIRST_RULE]
    ends = np.cumsum(wide)
    first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
    before = int(ends[first - 1]) if first else 0
    return expand(symbols[first:last], s["rules"])[start - before : stop - before]


def write(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, into: str | None = None, shard_tokens: int = SHARD_TOKENS) -> str:
    """Encode (doc_id, text), write the files, return their folder."""
    tokenizer = tokenizer or default_tokenizer()

    def shard(part: int, nth: int, ids: list, tokens: list[np.ndarray], before: int) -> pa.RecordBatch:
        ends = np.cumsum([len(t) for t in tokens])
        made = compress(np.concatenate(tokens), ends)
        starts = before + np.concatenate([[0], ends])
        columns = [[part], [nth], [len(ids)], [int(ends[-1])], [ids], *([made[k].astype("<u4").tobytes()] for k in ("rules", "lengths", "symbols", "doc_symbol")),
                   [starts.astype("<u8").tobytes()]]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, before = TaskContext.get().partitionId(), 0, 0
        ids, held, size = [], [], 0
        for batch in batches:
            for name, tokens in zip(batch.column(0).to_pylist(), encoded((t.as_py() for t in batch.column(1)), tokenizer), strict=True):
                if held and size + len(tokens) >= shard_tokens:
                    yield shard(part, nth, ids, held, before)
                    nth, before, ids, held, size = nth + 1, before + size, [], [], 0
                ids.append(name)
                held.append(np.append(tokens, np.uint32(end_id)))
                size += len(tokens) + 1
        if held:
            yield shard(part, nth, ids, held, before)

    out = into or fresh_folder(docs.sparkSession, "tokens")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, SCHEMA).write.parquet(out)
    return out


def file_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """part, ids in all files before it (one row per file)."""
    sums = spark.read.schema(SCHEMA).parquet(folder).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return sums.select("part", F.coalesce(before, F.lit(0)).alias("before"))


def decode(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = unpack(row)
                ids, begins = expand(s["symbols"], s["rules"]), s["doc_token"].astype(np.int64)
                local = begins - begins[0]
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(local[:-1].tolist(), local[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(begins[:-1] + row["before"]), pa.array(np.diff(begins)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = spark.read.schema(SCHEMA).parquet(folder).join(cut(file_offsets(spark, folder)), "part")
    columns = ["doc_ids", "rules", "lengths", "symbols", "doc_symbol", "doc_token", "before"]
    return shards.select(*columns).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op5_repair_files")
def repair_files(spark, sf_dir):
    return decode(spark, write(read(spark, sf_dir, "documents")))
