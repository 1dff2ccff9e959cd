"""MinHash near-duplicates: banded candidates, odd sketches to sift them, exact sets to confirm them.

1. One pass over the texts makes, per document, its number of distinct word shingles, a 128-bit name of the shingle set, band keys
   of some MinHash values each (`layout`), and an odd sketch: every MinHash sample (its position and value) flips one bit of a
   bitmap, so bits on which two sketches differ count the samples on which they differ, and the number of differing bits
   estimates the similarity; the nearer to 1, the more precisely.
2. Documents of one set are one class, whoever many; only the smallest id of each goes on.
3. Classes that share a band key are candidates. First, in every bucket of a band the smallest id is a pivot and meets all others. Then a
   bucket that still holds several components has another pivot, a member of its largest component by a hash, which meets the members outside
   of that component only. In buckets that are open even then, the members outside the largest component of the bucket meet all others, in blocks of bounded size inside
   the tasks: every pair of two components that has not been looked at before. Only pairs that pass the sketch leave any of these steps, and the last one
   only those whose sets of 24-bit hashes are similar enough too: they never hide a shared shingle, and a group of texts just below the
   similarity would otherwise give pairs by its square.
4. After each step its pairs are confirmed on full shingle sets, streamed past one of the two with a bounded number of partners, and
   components are formed from what is confirmed. The sets of all candidates are set apart once. Nothing is left to look at after the last step.

A pair at the wanted similarity shares no band with probability `MISS` at most, and its sketch fails with `MISS` at most: bands and the
limit of differing bits are computed from that rate. At 0.85 these are 40 bands of 8 rows, at 0.8 they are 55 of 7.

Defined cases: null, empty and wordless texts have no set, link with nothing and are components of their own; a text with fewer words than
a shingle has its whole sequence as its only shingle; rows that repeat an id count as one document when links are confirmed; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import components_sql, cut, query, read
from tallywright.llm.components import smallest_reachable
from tallywright.llm.textscan import Scan, chunks, mix, shingles

#: highest probability of a pair at the wanted similarity to share no band, and of its sketch to fail
MISS = 3e-6
#: most MinHash values in a band key, and of a document
MOST_ROWS, MOST_SAMPLES = 8, 400
SKETCH_BITS = 1024
WORDS64 = SKETCH_BITS // 64
#: members of a bucket compared with as many others in one block, and partners confirmed under one document in one group
BLOCK, PARTNERS = 1024, 256
#: steps in which every open bucket has a pivot by a hash
PIVOT_STEPS = 1

_seeds = mix(np.arange(1, 2 * MOST_SAMPLES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
MULTIPLIERS = (_seeds[:MOST_SAMPLES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
ADDENDS = (_seeds[MOST_SAMPLES:] >> np.uint64(32)).astype(np.uint32)


def layout(similarity: float) -> tuple[int, int]:
    """(bands, rows of each): the most rows with which few enough samples miss a pair at the similarity with probability MISS at most."""
    for rows in range(MOST_ROWS, 0, -1):
        bands = max(1, math.ceil(math.log(MISS) / math.log1p(-min(similarity, 0.999) ** rows)))
        if bands * rows <= MOST_SAMPLES:
            return bands, rows
    raise ValueError(f"no bands of {MOST_SAMPLES} samples find pairs at similarity {similarity}")


def minhashes(doc: np.ndarray, value: np.ndarray, n_docs: int, n_samples: int) -> np.ndarray:
    """(n_docs, n_samples) minima of linear hashes over each document's shingles; all ones where there are none."""
    out = np.full((n_docs, n_samples), 0xFFFFFFFF, np.uint32)
    if len(doc):
        begin = np.flatnonzero(np.diff(doc, prepend=-1))
        x = (value >> np.uint64(32)).astype(np.uint32)
        hashed = np.empty_like(x)
        rows = doc[begin]
        for k in range(n_samples):
            np.multiply(x, MULTIPLIERS[k], out=hashed)
            hashed += ADDENDS[k]
            out[rows, k] = np.minimum.reduceat(hashed, begin)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """(n, WORDS64) parity bitmaps of the samples (k, value)."""
    place = mix(samples.astype(np.uint64) * np.uint64(1 << 9) + np.arange(samples.shape[1], dtype=np.uint64)) % np.uint64(SKETCH_BITS)
    flat = (place + np.arange(len(samples), dtype=np.uint64)[:, None] * np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(flat.ravel(), minlength=len(samples) * SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(samples), SKETCH_BITS), axis=1, bitorder="little").view(np.uint64)


@cache
def most_bits(similarity: float, n_samples: int) -> int:
    """The fewest differing bits that sketches of a pair at the similarity exceed with probability MISS at most."""
    differ, same = 1 - similarity, similarity
    chance = [math.exp(math.lgamma(n_samples + 1) - math.lgamma(k + 1) - math.lgamma(n_samples - k + 1)) * differ**k * same ** (n_samples - k)
              for k in range(n_samples + 1)]
    bits = np.arange(SKETCH_BITS + 1)
    odd, total = (bits == 0).astype(float), np.zeros(SKETCH_BITS + 1)
    for k in range(n_samples + 1):
        total += chance[k] * odd
        for _ in range(2):  # a sample that differs flips a bit of either sketch
            flipped = np.zeros(SKETCH_BITS + 1)
            flipped[1:] += (odd * (1 - bits / SKETCH_BITS))[:-1]
            flipped[:-1] += (odd * bits / SKETCH_BITS)[1:]
            odd = flipped
    above = np.append(np.cumsum(total[::-1])[::-1][1:], 0.0)
    return int(np.flatnonzero(above <= MISS)[0])


def signatures(docs: DataFrame, width: int, n_bands: int, n_rows: int) -> DataFrame:
    """doc_id, n (shingles), k1, k2 (the set's name, null without shingles), bands, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, raws in chunks(t.as_py() for t in batch.column(1)):
                doc, value = shingles(Scan(raws, lower=True), width)
                n = np.bincount(doc, minlength=len(raws))
                names = []
                for salt in (0x1234567, 0x89ABCDEF):
                    total = np.zeros(len(doc) + 1, np.uint64)
                    np.cumsum(mix(value + np.uint64(salt)), out=total[1:])
                    ends = np.cumsum(n)
                    names.append((total[ends] - total[ends - n]).view(np.int64))
                samples = minhashes(doc, value, len(raws), n_bands * n_rows)
                keys = np.zeros((len(raws), n_bands), np.uint64)
                for r in range(n_rows):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + samples[:, r::n_rows] + np.uint64(r))
                none = n == 0
                flat = lambda x, wide: pa.ListArray.from_arrays(np.arange(0, len(raws) * wide + 1, wide, dtype=np.int32), pa.array(x.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(raws)), pa.array(n), pa.array(names[0], mask=none), pa.array(names[1], mask=none), flat(keys, n_bands),
                     flat(np.ascontiguousarray(odd_sketches(samples)), WORDS64)], names=["doc_id", "n", "k1", "k2", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, k1 long, k2 long, bands array<long>, sketch array<long>")


def _with_components(entries: DataFrame, components: DataFrame) -> DataFrame:
    """Adds `component` to (bucket, band, id): the id itself where nothing is linked yet."""
    of = components.select(F.col("node").alias("id"), F.col("component").alias("c"))
    return entries.join(of, "id", "left").select("bucket", "band", "id", F.coalesce("c", "id").alias("component"))


def _sifted(pairs: DataFrame, sketches: DataFrame, bits: int, pct: int) -> DataFrame:
    """Pairs (a, b) of sets near enough in size whose sketches differ in few enough bits."""
    left = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("s"), F.col("n").alias("m"))
    right = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("t"), "n")
    differ = F.aggregate(F.zip_with("s", "t", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    return pairs.join(left, "a").join(right, "b").where((100 * F.least("m", "n") >= pct * F.greatest("m", "n")) & (differ <= bits)).select("a", "b")


def _open(rows: DataFrame, step: int = 0) -> DataFrame:
    """bucket, main (its largest component), a (a member of it by a hash), size, outside (members outside of it) of the buckets of
    (bucket, id, component) with several components."""
    sums = rows.groupBy("bucket", "component").agg(
        F.count(F.lit(1)).alias("k"), F.min_by("id", F.struct(F.xxhash64("id", "bucket", F.lit(step)), "id")).alias("a")).groupBy("bucket").agg(
        F.sum("k").alias("size"), F.max("k").alias("most"), F.max_by(F.struct("component", "a"), F.struct("k", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    return sums.where("parts > 1").select("bucket", F.col("main.component").alias("main"), "main.a", "size", (F.col("size") - F.col("most")).alias("outside"))


def _first_pairs(rows: DataFrame) -> DataFrame:
    """The smallest id of each bucket of (bucket, id) with all others."""
    pivots = cut(rows.groupBy("bucket").agg(F.min("id").alias("a")))
    return rows.join(pivots, "bucket").where("a <> id").select("a", F.col("id").alias("b")).distinct()


def _pivot_pairs(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """The pivot of each open bucket, a member of its largest component, with the members outside of that component."""
    met = rows.join(heads.select("bucket", "main", "a"), "bucket").where("component <> main")
    return met.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()


def _block_pairs(rows: DataFrame, heads: DataFrame, sketches: DataFrame, sets: DataFrame, bits: int, pct: int) -> DataFrame:
    """Pairs of two components in the same bucket that pass the sketch: members outside the main component with all, over blocks of BLOCK of each.

    A pair comes from the first band that it shares and from no other: that bucket is open too, as it holds both.
    """
    heads = heads.select("bucket", "main", F.ceil(F.col("size") / BLOCK).cast("int").alias("rights"), F.ceil(F.col("outside") / BLOCK).cast("int").alias("lefts"))
    # a sketch is attached once to an id, which has at most one bucket of each band
    mine = rows.join(heads, "bucket").groupBy("id").agg(F.collect_list(F.struct("bucket", "band", "component", "main", "rights", "lefts")).alias("places"))
    narrow = sketches.select("id", "n", "sketch", F.transform("bands", lambda b: b.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")).alias("bands")).join(sets.select("id", "short"), "id")
    members = mine.join(narrow, "id").select("id", "n", "sketch", "bands", "short", F.explode("places").alias("at")).select("id", "n", "sketch", "bands", "short", "at.*")
    spread = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")
    upto = lambda parts: F.sequence(F.lit(0), F.col(parts) - 1)
    right = F.transform(upto("lefts"), lambda x: F.struct(x.alias("i"), spread("rights").alias("j"), F.lit(False).alias("outside")))
    left = F.transform(upto("rights"), lambda x: F.struct(spread("lefts").alias("i"), x.alias("j"), F.lit(True).alias("outside")))
    dealt = members.withColumn("to", F.explode(F.when(F.col("component") != F.col("main"), F.concat(right, left)).otherwise(right)))
    dealt = dealt.select("bucket", "to.i", "to.j", "band", "to.outside", "id", "component", "main", "n", "sketch", "bands", "short")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches):
            bucket, i, j, left, ids, comp, main, n, band = (t.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "i", "j", "outside", "id", "component", "main", "n", "band"))
            sketch = np.asarray(t.column("sketch").flatten()).view(np.uint64).reshape(len(ids), WORDS64)
            bands = np.asarray(t.column("bands").flatten()).reshape(len(ids), -1)
            new = np.ones(len(ids), bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            begin = np.flatnonzero(new)
            made = [np.zeros((0, 2), np.int64)]
            for a, b in zip(begin.tolist(), np.append(begin[1:], len(ids)).tolist(), strict=True):
                near = _passing(left[a:b], ids[a:b], comp[a:b], main[a], n[a:b], sketch[a:b], bands[a:b], band[a], bits, pct)
                if len(near):
                    short = [np.frombuffer(raw, np.uint32) for raw in t.column("short").slice(a, b - a).to_pylist()]
                    near = near[[_may_share(short[x], short[y], n[a + x], n[a + y], pct) for x, y in near.tolist()]]
                made.append(ids[a:b][near])
            found = np.sort(np.concatenate(made), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], names=["a", "b"])

    keys = ["bucket", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows cut anew, so that no group of (bucket, i, j) is split; a group is a block and so of bounded size."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("bucket", "i", "j")]
        same = np.ones(batch.num_rows, bool)
        for c, v in zip(("bucket", "i", "j"), last, strict=True):
            same &= batch.column(c).to_numpy(zero_copy_only=False) == v
        cut_at = int(np.flatnonzero(same)[0])
        if cut_at:
            yield batch.slice(0, cut_at)
        held = batch.slice(cut_at)
    if held is not None and held.num_rows:
        yield held


def _passing(left: np.ndarray, ids: np.ndarray, comp: np.ndarray, main: int, n: np.ndarray, sketch: np.ndarray, bands: np.ndarray, band: int, bits: int,
             pct: int) -> np.ndarray:
    """Places of pairs of one block that belong to two components, are near enough in size, share no earlier band and pass the sketch."""
    right, found = np.flatnonzero(~left), [np.zeros((0, 2), np.int64)]
    for x in np.flatnonzero(left):
        at = right[(comp[right] != comp[x]) & ((comp[right] == main) | (ids[right] > ids[x])) & (100 * np.minimum(n[right], n[x]) >= pct * np.maximum(n[right], n[x]))]
        at = at[np.bitwise_count(sketch[at] ^ sketch[x]).sum(axis=1) <= bits]
        at = at[(bands[at, :band] != bands[x, :band]).all(axis=1)]
        found.append(np.stack([np.full(len(at), x), at], 1))
    return np.concatenate(found)


def _may_share(a: np.ndarray, b: np.ndarray, n: int, m: int, pct: int) -> bool:
    """Whether sets of n and m shingles with these sorted short hashes can be similar enough; hashes that fall together inside a set count as shared."""
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum()) + min(n - len(a), m - len(b))
    return 100 * both >= pct * (n + m - both)


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """id, tokens (sorted hashes of all shingles), short (sorted distinct 24-bit parts of them) of texts (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raws in chunks(t.as_py() for t in batch.column(1)):
                doc, value = shingles(Scan(raws, lower=True), width)
                ends = np.searchsorted(doc, np.arange(len(raws) + 1))
                tokens = [value[a:b] for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(raws)), pa.array([x.tobytes() for x in tokens], pa.binary()),
                                                  pa.array([np.unique((x >> np.uint64(40)).astype(np.uint32)).tobytes() for x in tokens], pa.binary())], names=["id", "tokens", "short"])

    return texts.select("id", "text").mapInArrow(run, "id long, tokens binary, short binary")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity_pct: int) -> DataFrame:
    """a, b of pairs whose full sets have 100 * intersection >= similarity_pct * union; sets: id, tokens of all of them.

    The partners of a stream past it in groups of PARTNERS at most, one set at a time.
    """
    load = cut(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("cuts")))
    member = pairs.join(load, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), F.col("cuts")).cast("int").alias("part"), F.lit(1).alias("role"))
    heads = load.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("part"), F.lit(0).alias("role"))
    rows = member.unionByName(heads).join(sets.select("id", "tokens"), "id").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bases = None, []
        for batch in batches:
            found = []
            for a, part, role, other, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "role", "id")), batch.column("tokens"), strict=True):
                mine = np.frombuffer(raw.as_buffer(), np.uint64)
                if group != (a, part):
                    group, bases = (a, part), []
                if role == 0:
                    bases.append(mine.copy())  # an id that comes with several texts has several sets
                    continue
                for base in bases:
                    if len(base) and len(mine):
                        both = int((base[np.minimum(np.searchsorted(base, mine), len(base) - 1)] == mine).sum())
                        if both and 100 * both >= similarity_pct * (len(base) + len(mine) - both):
                            found.append((a, other))
                            break
            made = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(made[:, 0].copy()), pa.array(made[:, 1].copy())], names=["a", "b"])

    return rows.select("a", "part", "role", "id", "tokens").mapInArrow(compare, "a long, b long").distinct()


def classes_and_links(docs: DataFrame, width: int = 3, similarity_pct: int = 85) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, representative of its class or null) of every row, and component labels (node, component) of linked classes."""
    bands, per_band = layout(similarity_pct / 100)
    made = cut(signatures(docs, width, bands, per_band))
    named = made.where("n > 0")
    classes = cut(named.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")))
    members = cut(made.select("doc_id", "n", "k1", "k2").join(classes, ["k1", "k2"], "left").select("doc_id", "n", "rep"))
    lone = made.where("n > 0").join(classes.select(F.col("rep").alias("doc_id"), F.col("k1").alias("c1"), F.col("k2").alias("c2")), "doc_id")
    lone = cut(lone.where((F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))).dropDuplicates(["doc_id"])
               .select(F.col("doc_id").alias("id"), "n", "bands", "sketch"))
    sketches = lone.select("id", "n", "sketch", "bands")
    # the position is part of the key, so that bands do not mix
    exploded = lone.select("id", F.posexplode("bands").alias("band", "key")).select(F.xxhash64("band", "key").alias("bucket"), "band", "id")
    shared = cut(exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"))
    entries = cut(exploded.join(shared, "bucket"))
    bits = most_bits(similarity_pct / 100, bands * per_band)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(entries.select("id").distinct(), "id", "left_semi")
    sets = cut(full_sets(texts, width))
    looked = links = components = None
    for step in range(PIVOT_STEPS + 2):
        if step == 0:
            pairs = _sifted(_first_pairs(entries), sketches, bits, similarity_pct)
        else:
            rows = _with_components(entries, components)
            heads = cut(_open(rows, step))
            if step <= PIVOT_STEPS:
                pairs = _sifted(_pivot_pairs(rows, heads), sketches, bits, similarity_pct)
            else:
                pairs = _block_pairs(rows, heads, sketches, sets, bits, similarity_pct)
        fresh = cut(pairs if looked is None else pairs.join(looked, ["a", "b"], "left_anti"))
        found = cut(confirmed(fresh, sets, similarity_pct))
        looked = fresh if looked is None else looked.unionByName(fresh)
        links = found if links is None else links.unionByName(found)
        if components is None or not found.isEmpty():
            components = cut(smallest_reachable(links))
    return members, components


def near_duplicates(docs: DataFrame, width: int = 3, similarity_pct: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text)."""
    members, components = classes_and_links(docs, width, similarity_pct)
    of = components.select(F.col("node").alias("rep"), "component")
    return members.join(of, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"),
        (F.col("doc_id") == F.coalesce("component", "rep", "doc_id")).alias("kept"))


@query("op9_near_duplicates", components_sql(3, 85))
def near_duplicates_query(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))
