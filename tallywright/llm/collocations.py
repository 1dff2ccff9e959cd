"""Phrase collocations by SON partitioning, level by level.

Documents lie in blocks, and blocks in a few shards. For words, then pairs, then longer phrases:

1. Every shard is mined completely at a local support in proportion to its share of all words. The supports, less one, add up to less than the
   global support, so a phrase that is frequent anywhere is locally frequent in some shard.
2. The union of what is locally frequent in any shard is counted exactly over all blocks.

A phrase of k words is only asked for where both of its phrases of k - 1 words were in that union, which loses none: each occurrence of a phrase is one of
its parts. `blocks.tally` sums a shard in as many tasks as it needs; the range of a phrase sees its counts of all shards, so mining, union and
counting of one level share one shuffle. Blocks are told exact counts, with which one block of those that hold a phrase scores its cuts.

Counts are per language; words are hashed together with it. Scores are exact whole numbers of any size.

Defined cases: null texts read as empty, a null language as `und`; rows that repeat an id count each; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.blocks import Block, answered, n_words, tally, totals, word_blocks
from tallywright.llm.common import cut, query, read
from tallywright.llm.textscan import combine

#: shards; below the support, so that local supports stay above one occurrence
SHARDS = 4
#: first-stage groups of a language when its best phrases are ranked
SALTS = 64

BREAKING = np.zeros(256, bool)
BREAKING[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
PARTING = BREAKING.copy()
PARTING[[0x20, 0x09]] = True

FOUND_SCHEMA = "lang string, size int, words array<long>, a long, cut int, l long, r long, score long, word long, spelled string"


def local_supports(shares: list[int], support: int) -> np.ndarray:
    """Occurrences that make a phrase locally frequent in each shard, from the words of the shards."""
    total = max(1, sum(shares))
    return np.array([(support - 1) * share // total + 1 for share in shares], np.int64)


def best_cut(a: int, parts: list[tuple[int, int]]) -> tuple[int, int, int, int]:
    """(k, l, r, score) of the lowest-scoring cut; parts: counts of the first k words and of the rest."""
    scored = [(1_000_000 * a * a // (left * right), k, left, right) for k, (left, right) in enumerate(parts, 1)]
    score, k, left, right = min(scored)
    return k, left, right, score


class _Phrases:
    """The phrases of a block with what is known of their counts."""

    def __init__(self, table: pa.Table, keys: np.ndarray, values: np.ndarray):
        self.block, self.keys, self.values = Block(table), keys, values
        self.counts: list[np.ndarray] = []

    def value(self, key: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], 0)

    def level(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(where phrases of so many words start whose shorter parts are all known, their hashes); call for 1, 2, ... in turn."""
        block = self.block
        hashed = block.vocabulary[block.words]
        if size == 1:
            return np.arange(len(hashed)), hashed
        at = block.starts(size)
        shorter = self.counts[-1]
        at = at[(shorter[at] > 0) & (shorter[at + 1] > 0)]
        for i in range(1, size):
            at = at[~block.breaks[at + i]]
        return at, combine(np.full(len(at), size, np.uint64), *(hashed[at + i] for i in range(size)))

    def know(self, at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Told values of a level, whose counts are kept by place."""
        value = self.value(key)
        count = np.zeros(len(self.block.words) + 1, np.int64)
        count[at] = value >> 1
        self.counts.append(count)
        return value


def candidates(docs: DataFrame, longest: int, support: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, sizes) of docs (text, lang).

    phrases: lang, size, words (hashes), a, cut, l, r, score of every phrase of 2 to `longest` words found `support` times; words: word, spelled;
    sizes: lang, n.
    """
    language = lambda tag: int.from_bytes(hashlib.blake2b(tag.encode(), digest_size=8).digest(), "little")

    def of_words(hashes: np.ndarray, tags: list, doc: np.ndarray) -> np.ndarray:
        known = {t: language(t) for t in set(tags)}
        return combine(np.array([known[t] for t in tags], np.uint64)[doc], hashes)

    docs = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    blocks = word_blocks(docs, "lang", PARTING, BREAKING, of_words, spelled=True)
    shard = F.pmod("block", F.lit(SHARDS))
    shares = {r["shard"]: r["n"] for r in blocks.groupBy(shard.alias("shard")).agg(F.sum("n").alias("n")).collect()}
    supports = local_supports([shares.get(s, 0) for s in range(SHARDS)], support)

    def requests(size: int):
        def ask(table: pa.Table, keys: np.ndarray = np.zeros(0, np.uint64), values: np.ndarray = np.zeros(0, np.int64)) -> Iterator[tuple]:
            phrases = _Phrases(table, keys, values)
            for shorter in range(1, size):
                phrases.know(*phrases.level(shorter))
            key, count = np.unique(phrases.level(size)[1], return_counts=True)
            yield phrases.block.id, phrases.block.id % SHARDS, key, count
        return ask

    def answer(key: np.ndarray, count: np.ndarray, tag: np.ndarray, origin: np.ndarray) -> tuple:
        at, total = totals(key, count)
        local = np.bincount(at * SHARDS + tag, weights=count, minlength=len(total) * SHARDS).reshape(-1, SHARDS)
        union = (local >= supports).any(axis=1) & (total >= support)
        first = np.append(True, key[1:] != key[:-1])  # one block that holds the phrase reports it
        return union[at], total[at] * 2 + first

    told = None
    for size in range(1, longest + 1):
        fresh = cut(tally(blocks, n_words(blocks), requests(size), answer, told=told))
        told = fresh if told is None else told.unionByName(fresh)

    def report(table: pa.Table, keys: np.ndarray, values: np.ndarray) -> pa.Table:
        phrases = _Phrases(table, keys, values)
        block = phrases.block
        rows = []
        for size in range(1, longest + 1):
            at, key = phrases.level(size)
            value = phrases.know(at, key)
            mine = np.flatnonzero(value & 1)
            mine = mine[np.unique(key[mine], return_index=True)[1]]
            for i in at[mine].tolist():
                words = block.words[i : i + size]
                if size == 1:
                    rows.append((None, 1, None, None, None, None, None, None, int(block.vocabulary[words[0]].view(np.int64)), block.spelled[words[0]].decode()))
                else:
                    a = int(phrases.counts[-1][i])
                    parts = [(int(phrases.counts[k - 1][i]), int(phrases.counts[size - k - 1][i + k])) for k in range(1, size)]
                    k, left, right, score = best_cut(a, parts)
                    rows.append((block.tags[block.doc[i]], size, block.vocabulary[words].view(np.int64).tolist(), a, k, left, right, score, None, None))
        names = ["lang", "size", "words", "a", "cut", "l", "r", "score", "word", "spelled"]
        kinds = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string()]
        return pa.table({name: pa.array([r[c] for r in rows], kind) for c, (name, kind) in enumerate(zip(names, kinds, strict=True))})

    found = cut(answered(blocks, told, report, FOUND_SCHEMA))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for row in range(table.num_rows):
                block = Block(table, row)
                yield pa.RecordBatch.from_arrays([pa.array(block.tags, pa.string()), pa.array(block.sizes)], names=["lang", "n"])

    sizes = blocks.mapInArrow(count, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    phrases = found.where("word IS NULL").select("lang", "size", "words", "a", "cut", "l", "r", "score")
    return phrases, found.where("word IS NOT NULL").select("word", "spelled"), sizes


def uncovered(phrases: DataFrame, longest: int, covered_pct: int) -> DataFrame:
    """Phrases that lie in no longer phrase with at least so many per cent of their count."""
    def inner(size: int) -> DataFrame:
        places = F.sequence(F.lit(1), F.col("size") - size + 1)
        runs = F.transform(places, lambda i: F.slice("words", i, size))
        return phrases.where(F.col("size") > size).select("lang", F.explode(runs).alias("words"), F.col("a").alias("b"))

    insides = [inner(size) for size in range(2, longest)]
    if not insides:
        return phrases
    inside = insides[0]
    for more in insides[1:]:
        inside = inside.unionByName(more)
    most = inside.groupBy("lang", "words").agg(F.max("b").alias("b"))
    return phrases.join(most, ["lang", "words"], "left").where(F.col("b").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("b") < F.lit(covered_pct).cast("decimal(20,0)") * F.col("a"))).drop("b")


def collocations(docs: DataFrame, longest: int = 3, support: int = 10, covered_pct: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases; see the contract of the query for the measures."""
    phrases, words, sizes = candidates(docs, longest, support)
    kept = cut(uncovered(phrases, longest, covered_pct))
    pieces = kept.select("lang", "words", "a", "l", "r", "score", F.posexplode("words").alias("place", "word")).join(words, "word")
    text = F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("place", "spelled"))), lambda x: x["spelled"]))
    spelled = pieces.groupBy("lang", "words", "a", "l", "r", "score").agg(text.alias("phrase"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = spelled.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts)),
f AS (SELECT lang, k, array_to_string(list_slice(words, i, i + k - 1), ' ') AS phrase, count(*) AS a
      FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS sizes(k)) GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
cuts AS (SELECT c.lang, c.k, c.phrase, c.a, j, l.a AS l, r.a AS r, ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
         FROM (SELECT *, unnest(range(1, k)) AS j FROM c) AS c
         JOIN f AS l ON l.lang = c.lang AND l.k = j AND l.phrase = array_to_string(list_slice(w, 1, j), ' ')
         JOIN f AS r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(list_slice(w, j + 1, c.k), ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
cover AS (SELECT lang, phrase, max(a) AS b FROM (SELECT lang, a, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN cover USING (lang, phrase) WHERE b IS NULL OR 100 * b < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


@query("op11_collocations", ORACLE)
def collocations_query(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents"))
