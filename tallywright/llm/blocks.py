"""Word blocks and key tallies: corpus-wide counts of n-grams for which no n-gram is a row of its own.

A block is about a million words of some documents, kept as a small vocabulary of word hashes and one index a word (`word_blocks`); it is
written once, so its members never change. A tally (`tally`) sends the sorted distinct keys of every block, cut into hash ranges and stored as
differences, to the tasks that own the ranges; these sum them over all blocks and answer each block with the keys that matter to it
(`answered` brings block and answers together). A key costs one entry in each block that holds it, however many documents hold it, so a
frequent n-gram is no hot key, and each step holds one block or one range in memory.

The number of ranges follows the number of words. Null texts read as empty; a table without rows has no blocks.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import fresh_folder
from tallywright.llm.textscan import SPACE, Scan, chunks, combine

#: words of a block, and keys summed together in one group
BLOCK_WORDS, RANGE_KEYS = 1 << 20, 1 << 20

BLOCK_SCHEMA = ("block long, n long, doc_ids array<long>, tags array<string>, sizes binary, vocabulary binary, words binary, breaks binary, spelled binary, "
                "measures binary")
REQUEST_SCHEMA = "range long, block long, tag long, keys binary, counts binary"


def bucketed(df: DataFrame) -> DataFrame:
    """The rows written once as a table in the shared folder, dealt by their column `block`: what is told to blocks then meets them without
    the blocks being shuffled again."""
    spark = df.sparkSession
    path, name = fresh_folder(spark, "blocks"), f"blocks_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, "block").option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted uint64 values as differences of equal width."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=np.uint64(0))
    steps[0] = 0
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + int(keys[0]).to_bytes(8, "little") + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    width = raw[0]
    flat = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(flat), 8), np.uint8)
    wide[:, :width] = flat
    steps = wide.view("<u8").ravel().astype(np.uint64)
    steps[0] = int.from_bytes(raw[1:9], "little")
    return np.cumsum(steps, dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    """Unsigned integers in the narrowest of 1, 2, 4 and 8 bytes that holds all; the first byte tells which."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack_small(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1)


class Block:
    """One block read back: documents, their sizes in words, and the word hashes."""

    def __init__(self, table: pa.Table, row: int = 0):
        self.id = table.column("block")[row].as_py()
        self.doc_ids = table.column("doc_ids")[row].as_py()
        self.tags = table.column("tags")[row].as_py()
        self.sizes = unpack_small(table.column("sizes")[row].as_py()).astype(np.int64)
        self.vocabulary = unpack_sorted(table.column("vocabulary")[row].as_py())
        self.words = unpack_small(table.column("words")[row].as_py()).astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        n = len(self.words)
        raw = table.column("breaks")[row].as_py()
        self.breaks = np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool) if raw is not None else None
        raw = table.column("measures")[row].as_py()
        self.measures = unpack_small(raw).astype(np.int64).reshape(len(self.sizes), -1) if raw and len(self.sizes) else None
        raw = table.column("spelled")[row].as_py()
        self.spelled = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True).split(b"\n") if raw else None

    def starts(self, width: int) -> np.ndarray:
        """Where runs of `width` words of one document start."""
        return np.flatnonzero(np.arange(len(self.words)) + width <= (self.first + self.sizes)[self.doc])

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash) of the distinct word shingles of each document, ordered by both.

        A document of fewer words has its whole sequence as its only shingle; one without words has none.
        """
        hashed = self.vocabulary[self.words]
        at = self.starts(width)
        docs, values = [self.doc[at]], [combine(*(hashed[at + i] for i in range(width)))]
        for length in range(1, width):
            short = np.flatnonzero(self.sizes == length)
            docs.append(short)
            values.append(combine(np.full(len(short), length, np.uint64), *(hashed[self.first[short] + i] for i in range(length))))
        doc, value = np.concatenate(docs), np.concatenate(values)
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        return doc[new], value[new]


def word_blocks(docs: DataFrame, tag: str | None = None, space: np.ndarray = SPACE, breaking: np.ndarray | None = None,
                of_words: Callable[[np.ndarray, list, np.ndarray], np.ndarray] | None = None, spelled: bool = False, lower: bool = True,
                of_docs: Callable[[Scan, list[bytes]], np.ndarray] | None = None) -> DataFrame:
    """Blocks of the (lower-cased) words of docs (doc_id, text), written once.

    tag: a string column carried for each document. space: which bytes part words. breaking: bytes after which a word starts a new piece.
    of_words(hashes, tags of some documents, document of each word) may change the word hashes.
    spelled: keep the vocabulary as text too. of_docs(scan, encoded texts) gives whole numbers to keep of each document, a row each.
    """
    limit = BLOCK_WORDS
    chosen = [F.col("doc_id").cast("long").alias("doc_id"), F.col(tag).cast("string").alias("tag") if tag else F.lit(None).cast("string").alias("tag"), "text"]

    def made(ids: list, tags: list, sizes: list, hashes: list, breaks: list, texts: dict, measures: list) -> pa.RecordBatch:
        hashed = np.concatenate(hashes)
        vocabulary, words = np.unique(hashed, return_inverse=True)
        joined = b"\n".join(texts[h] for h in vocabulary.tolist()) if spelled else b""
        row = [int.from_bytes(os.urandom(8), "little", signed=True), len(hashed), ids, tags, pack_small(np.concatenate(sizes)), pack_sorted(vocabulary), pack_small(words),
               np.packbits(np.concatenate(breaks)).tobytes() if breaking is not None else None,
               len(joined).to_bytes(8, "little") + pa.compress(joined, codec="zstd", asbytes=True) if spelled else None,
               pack_small(np.concatenate(measures).ravel()) if of_docs else None]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                                          names=["block", "n", "doc_ids", "tags", "sizes", "vocabulary", "words", "breaks", "spelled", "measures"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [[], [], [], [], [], {}, []]
        n = 0
        for batch in batches:
            ids, tags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, raws in chunks(t.as_py() for t in batch.column(2)):
                scan = Scan(raws, lower=lower, space=space)
                hashed = scan.word_hashes()
                mine = tags[first : first + len(raws)]
                held[0] += ids[first : first + len(raws)]
                held[1] += mine
                held[2].append(scan.n_words)
                held[3].append(of_words(hashed, mine, scan.doc) if of_words else hashed)
                if breaking is not None:
                    piece = np.cumsum(breaking[scan.buf])[scan.starts] if len(scan.starts) else np.zeros(0, np.int64)
                    held[4].append(np.diff(piece, prepend=-1) != 0)
                if spelled:
                    of, at = np.unique(held[3][-1], return_index=True)
                    raw, known = scan.buf.tobytes(), held[5]
                    for h, a, b in zip(of.tolist(), scan.starts[at].tolist(), scan.stops[at].tolist(), strict=True):
                        if h not in known:
                            known[h] = raw[a:b]
                if of_docs:
                    held[6].append(of_docs(scan, raws))
                n += len(hashed)
                if n >= limit:
                    yield made(*held)
                    held, n = [[], [], [], [], [], {}, []], 0
        if held[0]:
            yield made(*held)

    return bucketed(docs.select(*chosen).mapInArrow(run, BLOCK_SCHEMA))


def n_words(blocks: DataFrame) -> int:
    """The words of all blocks."""
    return blocks.agg(F.sum("n")).first()[0] or 0


def tally(blocks: DataFrame, n_keys: int, requests: Callable[..., Iterator[tuple[int, int, np.ndarray, np.ndarray]]],
          answer: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple], bits: int = 64,
          together: int = 0, told: DataFrame | None = None) -> DataFrame:
    """range, block, keys, values: what each block is told about its keys.

    requests(table of one row of `blocks`), with `told` also (keys, values) of what the block was told before, gives (block, tag, sorted distinct keys below 2^bits, counts: one a key, or a row a key). answer(keys, counts, tags, origin) sees all
    entries of one range, sorted by key and then by origin (a number for each request), and gives (which entries are told, their values).
    n_keys bounds the number of all entries; it sets the number of ranges. Keys that differ only in their `together` lowest bits share a range.
    """
    n_ranges = max(1, math.ceil(n_keys / RANGE_KEYS))
    scale = np.uint64(min(-(-(1 << (bits - together)) // n_ranges) << together, (1 << 64) - 1))

    def split(found: Iterator[tuple]) -> Iterator[pa.Table]:
        for block, tag, keys, counts in found:
            where = (keys // scale).astype(np.int64) if n_ranges > 1 else np.zeros(len(keys), np.int64)
            cuts = np.flatnonzero(np.diff(where, prepend=-1))
            ends = np.append(cuts[1:], len(keys))[: len(cuts)]
            yield pa.table({"range": where[cuts], "block": np.full(len(cuts), block, np.int64), "tag": np.full(len(cuts), tag, np.int64),
                            "keys": pa.array([pack_sorted(keys[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary()),
                            "counts": pa.array([pack_small(counts[a:b].ravel()) for a, b in zip(cuts, ends, strict=True)], pa.binary())})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for row in range(table.num_rows):
                for made in split(requests(table.slice(row, 1))):
                    yield from made.to_batches()

    def summed(table: pa.Table) -> pa.Table:
        keys = [unpack_sorted(k.as_py()) for k in table.column("keys")]
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        origin = np.repeat(np.arange(len(keys)), sizes)
        key = np.concatenate(keys)
        count = np.concatenate([_rows(unpack_small(c.as_py()).astype(np.int64), n) for c, n in zip(table.column("counts"), sizes.tolist(), strict=True)])
        tag = np.repeat(table.column("tag").to_numpy(), sizes)
        order = np.argsort(key, kind="stable")
        key, count, origin, tag = key[order], count[order], origin[order], tag[order]
        chosen, value = answer(key, count, tag, origin)
        key, value, origin = key[chosen], value[chosen], origin[chosen]
        back = np.argsort(origin, kind="stable")
        key, value, origin = key[back], value[back], origin[back]
        ends = np.searchsorted(origin, np.arange(len(keys) + 1))
        some = np.flatnonzero(np.diff(ends))
        return pa.table({"range": table.column("range").take(pa.array(some)), "block": table.column("block").take(pa.array(some)),
                         "keys": pa.array([pack_sorted(key[ends[i] : ends[i + 1]]) for i in some], pa.binary()),
                         "values": pa.array([pack_small(value[ends[i] : ends[i + 1]].ravel()) for i in some], pa.binary())})

    if told is None:
        sent = blocks.mapInArrow(send, REQUEST_SCHEMA)
    else:
        sent = answered(blocks, told, lambda *block: pa.concat_tables(split(requests(*block))), REQUEST_SCHEMA)
    return sent.groupBy("range").applyInArrow(summed, "range long, block long, keys binary, values binary")


def _rows(flat: np.ndarray, n: int) -> np.ndarray:
    """Numbers of n keys: one each, or a row each."""
    return flat if len(flat) == n else flat.reshape(n, -1)


def totals(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the distinct key of each entry, sum of each distinct key) of sorted keys; counts may be rows."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.cumsum(new) - 1, np.add.reduceat(count, np.flatnonzero(new), axis=0)


def told_of(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their values (a row each where there are several) of what one block was told."""
    keys = [unpack_sorted(k.as_py()) for k in answers.column("keys")]
    values = [_rows(unpack_small(v.as_py()).astype(np.int64), len(k)) for v, k in zip(answers.column("values"), keys, strict=True)]
    keys, values = np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(values or [np.zeros(0, np.int64)])
    order = np.argsort(keys, kind="stable")
    return keys[order], values[order]


def answered(blocks: DataFrame, answers: DataFrame, fn: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """fn(block row, sorted keys, their values) of every block with what it was told."""

    def meet(block: pa.Table, told: pa.Table) -> pa.Table:
        return fn(block, *told_of(told))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(meet, schema)
