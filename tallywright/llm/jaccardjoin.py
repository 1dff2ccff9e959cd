"""N-gram Jaccard join by rare-first prefix filtering.

1. Corpus-wide counts of all shingles (`blocks.tally`) give one total order: rare first, then by hash. Counts above 127 are ordered by steps of
   an eighth of a power of two, which is still one order for all documents. A shingle that one text alone has can link nothing.
2. A document of n shingles must share at least ceil(s n) of them with any partner, so one of its first n - ceil(s n) + 1 shingles in
   that order, its prefix, is in the partner's prefix too. A document whose prefix holds only shingles of its own leaves here; the ordered sets of the
   others are written once.
3. Documents meet on prefix shingles that at least two of them hold. A meeting survives if the sizes can reach the similarity (length filter), if
   what follows both places can still bring enough shared shingles (positional filter), and if the numbers of later shingles in 64
   fixed parts of the hash space do not differ by more than the similarity allows (suffix filter).
4. Each surviving pair is verified once, on whole sets. Texts with the same set are one class, represented by the smallest id.

Links are found in steps, so that a group of near copies does not become all its pairs: first every holder of a shingle meets a pivot, twice with
another pivot; then, where holders still belong to several components, those outside the largest one meet all others in blocks of bounded
size, which first give the pairs that tie components together and at last every pair of two components not verified before. Pairs inside one component
can no longer change it. After the last step no pair of two components is unverified, so components are exact.

Defined cases: null, empty and wordless texts have no set and are components of their own; a text with fewer words than a shingle has its
whole sequence as its only shingle; rows that repeat an id are one document to the join; rows without an id have a component only if a row with
an id has the same set; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.blocks import Block, answered, n_words, tally, totals, word_blocks
from tallywright.llm.common import components_sql, cut, query, read
from tallywright.llm.components import smallest_reachable
from tallywright.llm.textscan import mix

#: parts of the hash space whose shingles the suffix filter counts
CELLS = 64
#: holders of a shingle compared with as many others in one block, and partners verified under one document in one group
BLOCK = 2048
PARTNERS = 256
PIVOT_STEPS = 2

SETS_SCHEMA = "id long, n long, k1 long, k2 long, lead long, tokens binary"


def least_shared(n: np.ndarray, pct: int) -> np.ndarray:
    """Shingles that a set of n must share with any partner."""
    return (pct * n + 99) // 100


def rarity(count: np.ndarray) -> np.ndarray:
    """One byte that never falls as the count rises."""
    far = 128 + np.floor(8 * np.log2(np.maximum(count, 128) / 128)).astype(np.int64)
    return np.where(count < 128, count, np.minimum(far, 255))


def _names(doc: np.ndarray, value: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each document's set, and two hashes that name it."""
    n = np.bincount(doc, minlength=n_docs)
    ends, names = np.cumsum(n), []
    for salt in (0x51ED270B, 0x2545F491):
        total = np.zeros(len(doc) + 1, np.uint64)
        np.cumsum(mix(value + np.uint64(salt)), out=total[1:])
        names.append(total[ends] - total[ends - n])
    return n, *names


def ordered_sets(blocks: DataFrame, width: int, pct: int) -> DataFrame:
    """id, n, k1, k2 of every document, and where a partner is possible the number of leading shingles of its own and its shingles, rare first."""
    n_keys = n_words(blocks)
    bits = min(64, max(32, n_keys.bit_length() + 10))
    shift = np.uint64(64 - bits)

    def requests(table: pa.Table) -> Iterator[tuple]:
        block = Block(table)
        doc, value = block.shingles(width)
        n, k1, _ = _names(doc, value, len(block.sizes))
        one = np.zeros(len(n), bool)
        one[np.unique(k1, return_index=True)[1]] = True  # equal sets count once
        keys, counts = np.unique(value[one[doc]] >> shift, return_counts=True)
        yield block.id, 0, keys, counts

    def answer(key: np.ndarray, count: np.ndarray, tag: np.ndarray, origin: np.ndarray) -> tuple:
        at, total = totals(key, count)
        return total[at] > 1, rarity(total)[at]

    def meet(table: pa.Table, keys: np.ndarray, values: np.ndarray) -> pa.Table:
        block = Block(table)
        doc, value = block.shingles(width)
        n, k1, k2 = _names(doc, value, len(block.sizes))
        short = value >> shift
        at = np.minimum(np.searchsorted(keys, short), max(len(keys) - 1, 0))
        code = np.where(keys[at] == short, values[at], 1) if len(keys) else np.ones(len(value), np.int64)
        lead = np.bincount(doc[code == 1], minlength=len(n))
        possible = (n > 0) & (lead < n - least_shared(n, pct) + 1)
        wanted = possible[doc]
        order = np.lexsort((value[wanted], code[wanted], doc[wanted]))
        ordered, ends = value[wanted][order], np.cumsum(np.where(possible, n, 0))
        none = n == 0
        return pa.table({
            "id": pa.array(block.doc_ids, pa.int64()), "n": pa.array(n), "k1": pa.array(k1.view(np.int64), mask=none), "k2": pa.array(k2.view(np.int64), mask=none),
            "lead": pa.array(lead), "tokens": pa.array([ordered[e - m : e].tobytes() if p else None for e, m, p in zip(ends, n, possible, strict=True)], pa.binary())})

    return cut(answered(blocks, tally(blocks, n_keys, requests, answer, bits), meet, SETS_SCHEMA))


def prefix_entries(sets: DataFrame, pct: int) -> DataFrame:
    """token, id, n, place, cells of every shared prefix shingle; cells: numbers of later shingles in each part of the hash space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for i, n, lead, raw in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "lead", "tokens")), strict=True):
                tokens = np.frombuffer(raw, np.uint64)
                places = np.arange(lead, n - int(least_shared(np.int64(n), pct)) + 1)
                part = (tokens >> np.uint64(58)).astype(np.int64)
                later = np.bincount(part[lead:], minlength=CELLS)
                seen = np.cumsum(np.eye(CELLS, dtype=np.int64)[part[places]], axis=0)
                cells = np.minimum(later - seen, 255).astype(np.uint8)  # capped counts differ by no more than whole ones
                for values, more in zip(out, (tokens[places].view(np.int64), np.full(len(places), i), np.full(len(places), n), places, cells), strict=True):
                    values.append(more)
            if out[0]:
                token, ids, n, place, cells = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(ids), pa.array(n), pa.array(place), pa.array([c.tobytes() for c in cells], pa.binary())],
                                                 names=["token", "id", "n", "place", "cells"])

    return sets.select("id", "n", "lead", "tokens").mapInArrow(run, "token long, id long, n long, place long, cells binary")


def survives(n: np.ndarray, m: np.ndarray, i: np.ndarray, j: np.ndarray, left: np.ndarray, right: np.ndarray, pct: int) -> np.ndarray:
    """Length, positional and suffix filters of meetings at places i and j of sets of n and m; left, right: cells of what follows."""
    needed = -((-pct * (n + m)) // (100 + pct))
    rest, other = n - i - 1, m - j - 1
    ok = (100 * np.minimum(n, m) >= pct * np.maximum(n, m)) & (1 + np.minimum(rest, other) >= needed)
    differ = np.abs(left.astype(np.int32) - right.astype(np.int32)).sum(axis=-1)
    return ok & (differ <= rest + other - 2 * (needed - 1))


def _cells(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, CELLS)


def pivot_pairs(rows: DataFrame, step: int, pct: int) -> DataFrame:
    """a, b: pivots of shingles with the surviving other holders of another component; rows: token, id, n, place, cells, component."""
    pivot = F.min_by(F.struct(F.col("id").alias("a"), F.col("n").alias("m"), F.col("place").alias("other"), F.col("cells").alias("theirs"), F.col("component").alias("c")),
                     F.struct(F.xxhash64("id", F.lit(step)), "id", "place"))
    heads = rows.groupBy("token").agg(pivot.alias("p")).select("token", "p.*")
    met = rows.join(heads, "token").where("component <> c").select("a", "id", "m", "n", "other", "place", "theirs", "cells")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, m, n, i, j = (batch.column(c).to_numpy() for c in ("a", "id", "m", "n", "other", "place"))
                ok = survives(m, n, i, j, _cells(batch.column("theirs")), _cells(batch.column("cells")), pct)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[ok]), pa.array(np.maximum(a, b)[ok])], names=["a", "b"])

    return met.mapInArrow(keep, "a long, b long").distinct()


def block_pairs(rows: DataFrame, pct: int, every: bool) -> DataFrame:
    """a, b: surviving pairs of two components among the holders of a shingle; every: all of them, else those that tie components together."""
    sizes = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
    heads = sizes.groupBy("token").agg(F.sum("k").alias("size"), F.max_by("component", F.struct("k", "component")).alias("main"), F.max("k").alias("k"), F.count(F.lit(1)).alias("parts"))
    heads = cut(heads.where("parts > 1").select("token", "main", F.ceil(F.col("size") / BLOCK).alias("rights"), F.ceil((F.col("size") - F.col("k")) / BLOCK).alias("lefts")))
    members = rows.join(heads, "token")
    columns = ["token", "i", "j", "outside", "id", "n", "place", "cells", "component", "main"]
    everyone = members.withColumn("j", F.pmod(F.xxhash64("id"), F.col("rights"))).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1)))
    outside = members.where("component <> main").withColumn("i", F.pmod(F.xxhash64("id"), F.col("lefts"))).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1)))
    dealt = everyone.withColumn("outside", F.lit(False)).select(*columns).unionByName(outside.withColumn("outside", F.lit(True)).select(*columns))

    def compare(table: pa.Table) -> pa.Table:
        ids, n, place, component = (table.column(c).to_numpy() for c in ("id", "n", "place", "component"))
        cells, left = _cells(table.column("cells")), table.column("outside").to_numpy(zero_copy_only=False)
        main = table.column("main")[0].as_py()
        right = np.flatnonzero(~left)
        found, top = [], {}

        def find(x: int) -> int:
            while (up := top.get(x, x)) != x:
                x = up
            return x

        for x in np.flatnonzero(left):
            at = right[(component[right] != component[x]) & ((component[right] == main) | (ids[right] > ids[x]))]
            at = at[survives(n[x], n[at], place[x], place[at], cells[x], cells[at], pct)]
            if not every:
                for y in at:
                    a, b = find(int(component[x])), find(int(component[y]))
                    if a != b:
                        top[a] = b
                        found.append((ids[x], ids[y]))
            elif len(at):
                found += zip([ids[x]] * len(at), ids[at], strict=True)
        pairs = np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1)
        return pa.table({"a": pairs[:, 0].copy(), "b": pairs[:, 1].copy()})

    return dealt.groupBy("token", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """a, b of the pairs whose whole sets are similar enough; a document with many partners is dealt to several tasks."""
    pairs = cut(pairs)
    load = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("parts"))
    tokens = sets.select("id", "tokens")
    partners = pairs.join(load, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), F.lit(1).alias("role"), F.col("b").alias("id"))
    heads = load.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("a").alias("id"))
    rows = partners.unionByName(heads).join(tokens, "id").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bases = None, []
        for batch in batches:
            found = []
            for a, part, role, b, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "role", "id")), batch.column("tokens"), strict=True):
                if group != (a, part):
                    group, bases = (a, part), []
                mine = np.frombuffer(raw.as_buffer(), np.uint64)
                if role == 0:
                    bases.append(np.sort(mine))
                    continue
                for base in bases:
                    both = int((base[np.minimum(np.searchsorted(base, mine), len(base) - 1)] == mine).sum())
                    if 100 * both >= pct * (len(base) + len(mine) - both):
                        found.append((a, b))
                        break
            rows = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy())], names=["a", "b"])

    return rows.select("a", "part", "role", "id", "tokens").mapInArrow(compare, "a long, b long").distinct()


def jaccard_join(docs: DataFrame, width: int = 3, similarity_pct: int = 90) -> tuple[DataFrame, DataFrame]:
    """(id, n, rep of its class or null) of every row of docs (doc_id, text); links (a, b) between representatives that make up all components."""
    made = ordered_sets(word_blocks(docs), width, similarity_pct)
    classes = cut(made.where("n > 0 AND id IS NOT NULL").groupBy("k1", "k2").agg(F.min("id").alias("rep")))
    members = cut(made.select("id", "n", "k1", "k2").join(classes, ["k1", "k2"], "left").select("id", "n", "rep", "k1", "k2"))
    copies = members.where("id <> rep").select("id", "k1", "k2")
    sets = cut(made.where("tokens IS NOT NULL AND id IS NOT NULL").join(copies, ["id", "k1", "k2"], "left_anti").dropDuplicates(["id", "k1", "k2"]).select("id", "n", "lead", "tokens"))
    entries = prefix_entries(sets, similarity_pct)
    shared = entries.groupBy("token").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("token")
    entries = cut(entries.join(shared, "token"))
    looked = links = components = None
    for step in range(PIVOT_STEPS + 2):
        if components is None:
            rows = entries.withColumn("component", F.col("id"))
        else:
            of = components.select(F.col("node").alias("id"), F.col("component").alias("c"))
            rows = cut(entries.join(of, "id", "left").withColumn("component", F.coalesce("c", "id")).drop("c"))
        pairs = pivot_pairs(rows, step, similarity_pct) if step < PIVOT_STEPS else block_pairs(rows, similarity_pct, step > PIVOT_STEPS)
        fresh = cut(pairs if looked is None else pairs.join(looked, ["a", "b"], "left_anti"))
        found = cut(verified(fresh, sets, similarity_pct))
        looked = fresh if looked is None else looked.unionByName(fresh)
        links = found if links is None else links.unionByName(found)
        if components is None or not found.isEmpty():
            components = cut(smallest_reachable(links))
    return members.select("id", "n", "rep"), links


def linked_components(docs: DataFrame, width: int = 3, similarity_pct: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs."""
    members, links = jaccard_join(docs, width, similarity_pct)
    of = smallest_reachable(links).select(F.col("node").alias("rep"), "component")
    return members.join(of, "rep", "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "id").alias("component_id"))


@query("op12_jaccard_join", f"SELECT doc_id, n_shingles, component_id FROM ({components_sql(3, 90)})")
def jaccard_join_query(spark, sf_dir):
    return linked_components(read(spark, sf_dir, "documents"))
