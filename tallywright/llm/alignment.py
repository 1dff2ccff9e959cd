"""Links between the tokens of two tokenizers over the same texts, found by lockstep merging.

All documents of a batch advance together: one state vector holds a pointer into the A tokens and one into the B tokens of each. Every step links
the two tokens at the pointers, moves past the one that ends first, past both and with a cut where they end together, and drops documents that
are finished. A long document is entered in several places at once, each behind an end that a few tokens about there have in common.

Corpus-wide counts: a block keeps its distinct groups (tokens between two cuts) with their id pairs, and each document as numbers of groups, compressed.
`blocks.tally` sums in how many documents each pair is linked and tells each block the counts of its pairs and which are the highest of
their A id; all pairs of an A id are in one range. Neither texts nor links are shuffled.

Defined cases: null and empty texts, and texts whose tokens of A or B do not spell the text behind a space (as where U+2581 stands in it), have no tokens:
zeros and an empty digest. Strings of special tokens are plain text. Rows that repeat an id are documents of their own; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.blocks import answered, bucketed, pack_small, pack_sorted, tally, totals, unpack_small, unpack_sorted
from tallywright.llm.common import query, read
from tallywright.llm.textscan import mix
from tallywright.llm.tokens import encoded

#: characters aligned together, groups of a block
GROUP_CHARS, BLOCK_GROUPS = 1 << 20, 1 << 20
#: A tokens between the places at which a long document is entered, and tokens searched there for an end in common
LANE_TOKENS, LANE_SEARCH = 512, 64
#: ids are below 2^24; an A id is scrambled so that ranges get equal shares
ID_BITS = 24
_SCRAMBLE = np.uint64(0x9E3779)

BLOCK_SCHEMA = ("block long, doc_ids array<long>, n_a binary, n_b binary, n_groups binary, sha array<string>, groups binary, spans binary, members binary, "
                "pairs binary, holders binary")
RESULT_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Side:
    """One tokenizer with the bytes of its entries."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            self.pieces = SentencePieceProcessor(model_file=path)
            self.entries = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
                            for i, p in ((i, self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size()))]
            self.encode = lambda texts: (np.asarray(ids, np.int64) for ids in self.pieces.encode(texts, num_threads=1))
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            # a byte-level vocabulary writes printable bytes as themselves and the others, in order, from U+0100 on
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
            self.entries = [b""] * library.get_vocab_size()
            for entry, i in library.get_vocab().items():
                self.entries[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
            self.encode = lambda texts: encoded(texts, path, lead=True, plain_specials=True)
        self.size = np.fromiter(map(len, self.entries), np.int64, len(self.entries))

    def spelled(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.entries.__getitem__, np.asarray(ids).tolist()))


@lru_cache(maxsize=4)
def side(path: str) -> Side:
    return Side(path)


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def entrances(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray) -> np.ndarray:
    """A tokens with which lanes end: the last of each document, and in long documents some that end where a B token ends."""
    far = np.arange(LANE_TOKENS, len(ends_a), LANE_TOKENS)
    near = (far[:, None] + np.arange(LANE_SEARCH)).clip(max=len(ends_a) - 1)
    at = np.searchsorted(ends_b, ends_a[near]).clip(max=len(ends_b) - 1)
    common = ends_b[at] == ends_a[near]
    chosen = near[np.arange(len(far)), common.argmax(axis=1)][common.any(axis=1)]
    return np.union1d(last_a, chosen)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A and B token of each link, A and B token that end each group) of documents laid end to end.

    ends: byte offsets at which tokens end, over all documents; last_a: the last A token of each document, where a B token ends too.
    """
    stop_a = entrances(ends_a, ends_b, last_a)
    stop_b = np.searchsorted(ends_b, ends_a[stop_a])
    a, b = np.append(0, stop_a[:-1] + 1), np.append(0, stop_b[:-1] + 1)
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        left, right = ends_a[a], ends_b[b]
        past_a, past_b = left <= right, right <= left
        both = past_a & past_b
        cuts_a.append(a[both])
        cuts_b.append(b[both])
        going = ~(both & (a == stop_a))
        a, b = a + past_a, b + past_b
        if not going.all():
            a, b, stop_a = a[going], b[going], stop_a[going]
    return tuple(map(np.concatenate, (links_a, links_b, cuts_a, cuts_b)))


class Aligned:
    """Some texts by both tokenizers: tokens, links and groups of those that both spell."""

    def __init__(self, texts: list[str | None], path_a: str, path_b: str):
        left, right = side(path_a), side(path_b)
        some = [i for i, t in enumerate(texts) if t]
        full = [texts[i] for i in some]
        self.n_a, self.n_b, self.n_groups = (np.zeros(len(texts), np.int64) for _ in range(3))
        kept_a, kept_b, self.docs = [], [], []
        for i, text, a, b in zip(some, full, left.encode(full), right.encode(full), strict=True):
            raw = (" " + text).encode()
            if left.spelled(a) == raw == right.spelled(b):
                kept_a.append(a.astype(np.int64))
                kept_b.append(b)
                self.docs.append(i)
                self.n_a[i], self.n_b[i] = len(a), len(b)
        none = [np.zeros(0, np.int64)]
        self.a, self.b = np.concatenate(kept_a or none), np.concatenate(kept_b or none)
        self.ends_a, self.ends_b = np.cumsum(left.size[self.a]), np.cumsum(right.size[self.b])
        if self.docs:
            last_a = np.cumsum(self.n_a[self.docs]) - 1
            self.link_a, self.link_b, cuts_a, cuts_b = lockstep(self.ends_a, self.ends_b, last_a)
            self.cuts_a, self.cuts_b = np.sort(cuts_a), np.sort(cuts_b)
            per_doc = np.diff(np.searchsorted(self.cuts_a, last_a, side="right"), prepend=0)
            self.n_groups[self.docs] = per_doc
        else:
            self.link_a = self.link_b = self.cuts_a = self.cuts_b = none[0]

    def of_groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First A and B token of each group, and one past the last."""
        return np.append(0, self.cuts_a[:-1] + 1), self.cuts_a + 1, np.append(0, self.cuts_b[:-1] + 1), self.cuts_b + 1

    def names(self) -> np.ndarray:
        """A 64-bit name of the tokens of each group."""
        total = np.zeros(len(self.cuts_a), np.uint64)
        first_a, _, first_b, _ = self.of_groups()
        for ids, cuts, first, salt in ((self.a, self.cuts_a, first_a, 1), (self.b, self.cuts_b, first_b, 2)):
            group = np.searchsorted(cuts, np.arange(len(ids)))
            place = np.arange(len(ids)) - first[group]
            total += np.add.reduceat(mix(mix(ids.astype(np.uint64) * np.uint64(4) + np.uint64(salt)) + place.astype(np.uint64)), first)
        return mix(total)


def _pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    scrambled = (a.astype(np.uint64) * _SCRAMBLE) & np.uint64((1 << ID_BITS) - 1)
    return (scrambled << np.uint64(ID_BITS)) | b.astype(np.uint64)


class _Builder:
    """A block in the making: its distinct groups, and the documents as numbers of groups."""

    def __init__(self):
        self.number: dict[int, int] = {}
        self.texts: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.columns: list[list] = [[], [], [], [], [], []]
        self.size = 0

    def add(self, ids: list, found: Aligned) -> None:
        kept_ids, n_a, n_b, n_groups, sha, groups = self.columns
        kept_ids += ids
        for column, values in zip((n_a, n_b, n_groups), (found.n_a, found.n_b, found.n_groups), strict=True):
            column.append(values)
        digests = [""] * len(ids)
        if len(found.cuts_a):
            names, place, inverse = np.unique(found.names(), return_index=True, return_inverse=True)
            names = names.tolist()
            new = [i for i, name in enumerate(names) if name not in self.number]
            self._learn(found, [names[i] for i in new], place[new])
            numbers = np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))[inverse]
            ends = np.cumsum(found.n_groups)
            for i in found.docs:
                mine = numbers[ends[i] - found.n_groups[i] : ends[i]].tolist()
                digests[i] = hashlib.sha256(";".join(map(self.texts.__getitem__, mine)).encode()).hexdigest()
            groups.append(numbers)
            self.size += len(numbers)
        sha += digests

    def _learn(self, found: Aligned, names: list[int], place: np.ndarray) -> None:
        begin_a, end_a, begin_b, end_b = (x[place].tolist() for x in found.of_groups())
        group = np.searchsorted(found.cuts_a, found.link_a)
        wanted = np.zeros(len(found.cuts_a), bool)
        wanted[place] = True
        chosen = np.flatnonzero(wanted[group])
        order = chosen[np.argsort(group[chosen], kind="stable")]
        keys, of = _pair_keys(found.a[found.link_a[order]], found.b[found.link_b[order]]), group[order]
        low, high = np.searchsorted(of, place).tolist(), np.searchsorted(of, place, side="right").tolist()
        for i, name in enumerate(names):
            self.number[name] = len(self.texts)
            self.texts.append(",".join(map(str, found.a[begin_a[i] : end_a[i]].tolist())) + "|" + ",".join(map(str, found.b[begin_b[i] : end_b[i]].tolist())))
            self.pairs.append(keys[low[i] : high[i]])

    def batch(self) -> pa.RecordBatch:
        ids, n_a, n_b, n_groups, sha, groups = self.columns
        sizes, none = np.concatenate(n_groups), np.zeros(0, np.int64)
        numbers = np.concatenate(groups) if groups else none
        spans = np.fromiter(map(len, self.pairs), np.int64, len(self.pairs))
        vocabulary, members = np.unique(np.concatenate(self.pairs), return_inverse=True) if self.pairs else (np.zeros(0, np.uint64), none)
        # documents that hold each pair: distinct groups of a document, then distinct pairs
        doc = np.repeat(np.arange(len(sizes)), sizes)
        held = np.unique(doc * max(1, len(spans)) + numbers)
        doc, number = held // max(1, len(spans)), held % max(1, len(spans))
        wide = spans[number] if len(spans) else none
        at = np.repeat((np.cumsum(spans) - spans)[number] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum()) if len(spans) else none
        held = np.unique(np.repeat(doc, wide) * max(1, len(vocabulary)) + members[at])
        holders = np.bincount(held % max(1, len(vocabulary)), minlength=len(vocabulary))
        squeezed = pa.compress(pack_small(numbers), codec="zstd", asbytes=True)
        row = [int.from_bytes(os.urandom(8), "little", signed=True), ids, pack_small(np.concatenate(n_a)), pack_small(np.concatenate(n_b)), pack_small(sizes), sha,
               pack_small(np.array([len(pack_small(numbers))])) + squeezed, pack_small(spans), pack_small(members), pack_sorted(vocabulary), pack_small(holders)]
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 3, pa.list_(pa.string()), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                                          names=["block", "doc_ids", "n_a", "n_b", "n_groups", "sha", "groups", "spans", "members", "pairs", "holders"])


def _in_groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """(ids, texts) of about GROUP_CHARS characters each."""
    ids, texts, size = [], [], 0
    for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        ids.append(i)
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size >= GROUP_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _chosen(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    limit = BLOCK_GROUPS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Builder()
        for batch in batches:
            for ids, texts in _in_groups(batch):
                held.add(ids, Aligned(texts, path_a, path_b))
                if held.size >= limit:
                    yield held.batch()
                    held = _Builder()
        if held.columns[0]:
            yield held.batch()

    return bucketed(_chosen(docs).mapInArrow(run, BLOCK_SCHEMA))


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of docs (doc_id, text)."""
    blocks = aligned_blocks(docs, path_a, path_b)
    n_keys = blocks.agg(F.sum(F.length("pairs"))).first()[0] or 0

    def requests(table: pa.Table) -> Iterator[tuple]:
        yield (table.column("block")[0].as_py(), 0, unpack_sorted(table.column("pairs")[0].as_py()), unpack_small(table.column("holders")[0].as_py()))

    def answer(key: np.ndarray, count: np.ndarray, tag: np.ndarray, origin: np.ndarray) -> tuple:
        at, total = totals(key, count)
        a = key >> np.uint64(ID_BITS)
        begin = np.flatnonzero(np.diff(a, prepend=a[0] ^ np.uint64(1)))
        highest = np.repeat(np.maximum.reduceat(total[at], begin), np.diff(np.append(begin, len(key))))
        return np.ones(len(key), bool), total[at] * 2 + (total[at] == highest)

    def meet(table: pa.Table, keys: np.ndarray, values: np.ndarray) -> pa.Table:
        n_a, n_b, sizes, spans = (unpack_small(table.column(c)[0].as_py()).astype(np.int64) for c in ("n_a", "n_b", "n_groups", "spans"))
        members = unpack_small(table.column("members")[0].as_py())
        raw = table.column("groups")[0].as_py()
        head = 1 + raw[0]
        numbers = unpack_small(pa.decompress(raw[head:], int(unpack_small(raw[:head])[0]), codec="zstd", asbytes=True))
        ends = np.cumsum(sizes)
        columns = {}
        for name, of_pair in (("n_links", np.ones(len(keys), np.int64)), ("n_best", values & 1), ("count_sum", values >> 1)):
            running = np.append(0, np.cumsum(of_pair[members]))
            stop = np.cumsum(spans)
            of_group = running[stop] - running[stop - spans]
            running = np.append(0, np.cumsum(of_group[numbers]))
            columns[name] = pa.array(running[ends] - running[ends - sizes])
        return pa.table({"doc_id": pa.array(table.column("doc_ids")[0].as_py(), pa.int64()), "n_a": n_a, "n_b": n_b, "n_groups": sizes, **columns,
                         "groups_sha256": pa.array(table.column("sha")[0].as_py(), pa.string())})

    # all pairs of an A id belong to one range
    return answered(blocks, tally(blocks, n_keys, requests, answer, 2 * ID_BITS, ID_BITS), meet, RESULT_SCHEMA)


def aligned_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, group (from 0), start and stop (bytes of the text behind a space), a_ids, b_ids of every group of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _in_groups(batch):
                found = Aligned(texts, path_a, path_b)
                if not found.docs:
                    continue
                per_doc = found.n_groups[found.docs]
                doc = np.repeat(np.arange(len(per_doc)), per_doc)
                first = np.cumsum(per_doc) - per_doc
                stop = found.ends_a[found.cuts_a]
                start = np.append(0, stop[:-1])
                base = start[first][doc]
                _, end_a, _, end_b = found.of_groups()
                lists = [pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(x)) for x, ends in ((found.a, end_a), (found.b, end_b))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[found.docs[d]] for d in doc], pa.int64()), pa.array(np.arange(len(doc)) - first[doc]), pa.array(start - base), pa.array(stop - base), *lists],
                    names=["doc_id", "group", "start", "stop", "a_ids", "b_ids"])

    return _chosen(docs).mapInArrow(run, "doc_id long, group long, start long, stop long, a_ids array<long>, b_ids array<long>")


@query("op13_token_alignment")
def token_alignment_query(spark, sf_dir):
    return alignment(read(spark, sf_dir, "documents"), *default_tokenizers())
