"""Quality rules: base counts and perplexity bands of an interpolated modified Kneser-Ney model of word pairs.

Counts. Texts lie in blocks (`blocks.word_blocks`); words are hashed together with their language. A first tally counts every word pair over all blocks,
in tables of sorted hash arrays that hash ranges of the pairs own; no pair is left out, so they grow with the corpus. Blocks that share a pair are told its count;
exactly one block of those that hold a pair then reports it to a second tally, of words: how often a word comes before others, how many followers
come once, twice or more often (for the three discounts of its order), and after how many different words it comes (its continuation
count). Nothing of this is gathered anywhere but a row of discounts.

Model. A pair has its discounted count over that of its first word; what the discounts free goes to the continuation probability of the second word, and what its
discounts free goes to the spelling of the word: a second modified Kneser-Ney model, of order 4 over 64 character classes, whose 4-grams are their own 24-bit
hashes, counted by Spark and broadcast as sorted arrays of 2^24 entries at most.

A text is judged by the other texts: what it added itself is taken off all counts, numbers of followers and continuation counts, or else its own
words, in whatever order, would be what the model knows best.

A document is kept if its log-perplexity per character is inside the band of its language: the median of the language's documents that pass the base rule, plus and minus a
multiple of their spread on each side (distance from the median to the quartile), and wider for short texts.

Defined cases: null, empty and wordless texts have zero counts and no perplexity and fail the base rule; documents without a language form
one language of their own; a language without a document that passes the base rule rejects nothing; a text whose words no other has is spelled; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.blocks import Block, n_words, tally, told_of, totals, unpack_small, unpack_sorted, word_blocks
from tallywright.llm.common import cut, query, read
from tallywright.llm.textscan import Scan, chunks, combine, mix

ORDER, BITS = 4, 6
#: half-widths of a band, in spreads (distance from the median to the quartile of that side)
BELOW, ABOVE = 12.0, 8.0
#: short texts scatter more: a band is wider on both sides by this over the root of the text's word characters
SHORT = 0.9
MIN_WORDS, MAX_REPEAT_PCT = 50, 50

_SYMBOLS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    """Byte to class: white space, letters, digits, punctuation, symbols; bytes of other characters by remainder; 255 is skipped."""
    out = np.full(256, 55, np.uint8)
    out[:33] = 1
    out[32] = 0
    out[97:123] = np.arange(2, 28)
    out[65:91] = np.arange(28, 54)
    out[48:58] = 54
    out[list(b".,;:!?")] = 56
    out[list(_SYMBOLS)] = 57
    out[list(b"'\"()-")] = 58
    out[128:192] = 59 + np.arange(64) % 5
    out[192:] = 255
    return out


CLASSES = _classes()
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(_SYMBOLS)] = True


def grams(scan: Scan) -> tuple[np.ndarray, np.ndarray]:
    """(4-gram of each character, text it is in); a text begins after three line ends."""
    classes = CLASSES[scan.buf]
    classes[scan.ends] = 1  # the line end between two texts
    keep = classes != 255
    doc = np.repeat(np.arange(len(scan.ends)), scan.ends - scan.begins + 1)[keep]
    c = classes[keep].astype(np.uint32)
    first = np.searchsorted(doc, np.arange(len(scan.ends)))
    out = c.copy()
    for back in range(1, ORDER):
        past = np.ones(len(c), np.uint32)
        past[back:] = c[:-back]
        for i in range(back):  # before a text there are only line ends
            at = first + i
            past[at[at < len(past)]] = 1
        out |= past << np.uint32(BITS * back)
    real = np.ones(len(c), bool)
    real[np.append(first[1:], len(c)) - 1] = False  # the added line ends are no characters
    return out[real], doc[real]


def count_grams(docs: DataFrame) -> DataFrame:
    """gram, n over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            for _, raws in chunks(t.as_py() for t in batch.column(0)):
                if counts is None:
                    counts = np.zeros(1 << (ORDER * BITS), np.int64)
                key, n = np.unique(grams(Scan(raws))[0], return_counts=True)
                counts[key] += n
        if counts is not None:
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Per order: sorted hashes and log-probabilities; sorted contexts and log back-off weights."""

    hashes: list[np.ndarray]
    log_p: list[np.ndarray]
    contexts: list[np.ndarray]
    log_gamma: list[np.ndarray]

    def table(self) -> np.ndarray:
        """log p of every 4-gram, looked up in the sorted arrays from the lowest order up."""
        full = np.full(1 << BITS, -np.log(1 << BITS), np.float32)
        for order in range(ORDER):
            size = 1 << (BITS * (order + 1))
            if order:
                gamma = np.zeros(size >> BITS, np.float32)
                gamma[self.contexts[order]] = self.log_gamma[order]
                lower = full
                full = (gamma[:, None] + np.tile(lower.reshape(-1, 1 << BITS), (size >> BITS) // (len(lower) >> BITS)).reshape(-1, 1 << BITS)
                        if order == 1 else gamma[:, None] + np.tile(lower, size // len(lower)).reshape(-1, 1 << BITS)).reshape(-1)
            elif len(self.contexts[0]):
                full = full + np.float32(self.log_gamma[0][0])
            full[self.hashes[order]] = self.log_p[order]
        return full


def fit(docs: DataFrame) -> Model:
    """The modified Kneser-Ney model of all texts."""
    levels = [cut(count_grams(docs))]
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << (BITS * order)) - 1)
        levels.insert(0, cut(levels[0].groupBy(suffix.alias("gram")).agg(F.count(F.lit(1)).alias("n"))))
    lower = None
    model = Model([], [], [], [])
    for order, level in enumerate(levels):
        n = [level.where(F.col("n") == i).count() for i in range(1, 5)]
        d = discounts(n)[1:].tolist()
        discount = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        rows = level.withColumn("context", F.shiftright("gram", BITS))
        sums = cut(rows.groupBy("context").agg(F.sum("n").alias("total"), (F.sum(discount) / F.sum("n")).alias("gamma")))
        rows = rows.join(sums, "context").withColumn("own", (F.col("n") - discount) / F.col("total"))
        if lower is None:
            rows = rows.withColumn("p", F.col("own") + F.col("gamma") / (1 << BITS))
        else:
            below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND((1 << (BITS * order)) - 1)).join(below, "suffix")
            rows = rows.withColumn("p", F.col("own") + F.col("gamma") * F.col("q"))
        lower = cut(rows.select("gram", "p"))
        # at most 2^24 rows each: every gram is a number of that many bits
        made, weights = lower.toPandas().sort_values("gram"), sums.select("context", "gamma").toPandas().sort_values("context")
        with np.errstate(divide="ignore"):
            model.hashes.append(made["gram"].to_numpy(np.int64))
            model.log_p.append(np.log(made["p"].to_numpy(float)).astype(np.float32))
            model.contexts.append(weights["context"].to_numpy(np.int64))
            model.log_gamma.append(np.maximum(np.log(weights["gamma"].to_numpy(float)), -50).astype(np.float32))
    return model


def base_counts(scan: Scan, raws: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    def per_text(flag: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flag) + 1, np.int64)
        np.cumsum(flag, out=total[1:])
        return total[scan.ends] - total[scan.begins]

    in_word = np.zeros(len(scan.buf) + 1, np.int8)
    in_word[scan.starts] = 1
    in_word[scan.stops] -= 1
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    repeated = []
    for raw in raws:
        lines = raw.split(b"\n")
        n = 0
        if len(set(lines)) < len(lines):
            seen = set()
            for line in lines:
                if line in seen:
                    n += bool(line.strip(b" \t\n\r\x0b\x0c"))
                else:
                    seen.add(line)
        repeated.append(n)
    words, n = scan.word_hashes(), scan.n_words
    at = np.flatnonzero(np.arange(len(words)) + 3 <= (scan.first_word + n)[scan.doc])
    key = combine(words[at], words[at + 1], words[at + 2]) + mix(scan.doc[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    twice = at[order[same[:-1] | same[1:]]]
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[twice + i] = True
    return {"n_words": n.astype(np.int64), "word_chars": per_text(in_word & ((scan.buf & 0xC0) != 0x80)), "n_symbols": per_text(IS_SYMBOL[scan.buf]),
            "n_dup_lines": np.array(repeated, np.int64), "n_repeat_words": np.bincount(scan.doc[covered], minlength=len(raws)).astype(np.int64)}


#: stands before the first word of a text
START = np.uint64(1)
#: columns of the tally of words: times before others, followers that come once, twice and more often, different words before it
TOTAL, ONCE, TWICE, MORE, BEFORE = range(5)
#: base counts
COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2, 3 and more from the numbers of entries with counts 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return np.array([0.0] + [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.0), float(i)) if n[i - 1] else 0.0 for i in (1, 2, 3)])


def kind(count: np.ndarray) -> np.ndarray:
    return np.minimum(count, 3)


class _Pairs:
    """The distinct word pairs of a block and of its texts, with what the block was told."""

    def __init__(self, table: pa.Table, keys: np.ndarray, values: np.ndarray, bits: int):
        self.block = block = Block(table)
        second = block.words
        first = np.append(-1, second[:-1])
        first[block.first[block.sizes > 0]] = -1  # the mark before a text
        n = len(block.vocabulary)
        pair = (first + 1) * max(1, n) + second
        self.pair, self.of_word, count = np.unique(pair, return_inverse=True, return_counts=True)
        self.first, self.second = self.pair // max(1, n) - 1, self.pair % max(1, n)
        hashes = np.append(block.vocabulary, START)  # -1 is the mark
        shift = np.uint64(64 - bits)
        self.keys = combine(hashes[self.first], hashes[self.second]) >> shift
        self.count, self.mine = count, np.ones(len(count), bool)
        if len(keys) and len(self.keys):
            at = np.minimum(np.searchsorted(keys, self.keys), len(keys) - 1)
            told = keys[at] == self.keys
            self.count = np.where(told, values[at] >> 1, count)
            self.mine = ~told | (values[at] & 1 == 1)


def spelled(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """Log-probability of spelling each word and the space behind it, as the first of a line."""
    if not words:
        return np.zeros(0)
    scan = Scan([b" " + w + b" " for w in words])
    gram, doc = grams(scan)
    cost = table[gram].astype(float)
    begin = np.searchsorted(doc, np.arange(len(words)))
    return np.bincount(doc, weights=cost, minlength=len(words)) - cost[begin]


def judged(pairs: _Pairs, word: np.ndarray, spelling: np.ndarray, order2: np.ndarray, order1: np.ndarray, levels: np.ndarray, n_pairs: int) -> np.ndarray:
    """Log-probability of every word of a block by the texts other than its own.

    word: the five counts of each vocabulary entry, and of the mark in the last row. levels: words with continuation counts of 0, 1, 2, 3 and more.
    """
    block = pairs.block
    # distinct pairs of each text, ordered by text and first word
    held, of_word, own = np.unique(block.doc * max(1, len(pairs.pair)) + pairs.of_word, return_inverse=True, return_counts=True)
    doc, pair = held // max(1, len(pairs.pair)), held % max(1, len(pairs.pair))
    count, first, second = pairs.count[pair], pairs.first[pair], pairs.second[pair]
    others = count - own
    n_docs, wide = len(block.sizes), len(block.vocabulary) + 1

    def taken(side: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights over the pairs of the same text with the same word on a side, for each pair."""
        _, at = np.unique(doc * wide + side + 1, return_inverse=True)
        return np.bincount(at, weights=weights)[at]

    gone = others == 0
    total = word[first, TOTAL] - taken(first, own)
    followers = [word[first, k] - taken(first, kind(count) == k) + taken(first, kind(others) == k) for k in (ONCE, TWICE, MORE)]
    before = word[second, BEFORE]
    left = before - taken(second, gone)
    # continuation counts of the words of a text move to lower levels
    _, once = np.unique(doc * wide + second, return_index=True)
    moved = np.stack([levels[k] - np.bincount(doc[once], weights=kind(before[once]) == k, minlength=n_docs) + np.bincount(doc[once], weights=kind(left[once]) == k, minlength=n_docs)
                      for k in (1, 2, 3)])
    all_pairs = n_pairs - np.bincount(doc, weights=gone, minlength=n_docs)
    spell = np.exp(np.maximum(spelling[second], -600.0))
    some = np.maximum(all_pairs, 1)[doc]
    freed = np.where(all_pairs[doc] > 0, (order1[1:] @ moved)[doc] / some, 1.0)
    p = np.maximum(left - order1[kind(left.astype(np.int64))], 0) / some + freed * spell
    known = total > 0
    base = np.maximum(total, 1)
    p = np.where(known, np.maximum(others - order2[kind(others)], 0) / base + sum(d * f for d, f in zip(order2[1:], followers, strict=True)) / base * p, p)
    return np.log(np.maximum(p, 1e-300))[of_word]


def verdicts(docs: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """doc_id, the base counts, base_failed, perplexity (per character), the band of its language, kept; docs: doc_id, text, lang."""
    model, spelling = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(fit(docs))
    docs = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))

    def of_words(hashes: np.ndarray, tags: list, doc: np.ndarray) -> np.ndarray:
        known = {t: int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "little") for t in set(tags)}
        return combine(np.array([known[t] for t in tags], np.uint64)[doc], hashes)

    def of_docs(scan: Scan, raws: list[bytes]) -> np.ndarray:
        counts = base_counts(scan, raws)
        return np.stack([counts[c] for c in COUNTED], axis=1)

    blocks = word_blocks(docs, "lang", of_words=of_words, spelled=True, lower=False, of_docs=of_docs)
    n = n_words(blocks)
    bits = min(63, n.bit_length() + 20)
    nobody = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def pairs_of(table: pa.Table) -> Iterator[tuple]:
        pairs = _Pairs(table, *nobody, bits)
        order = np.argsort(pairs.keys)
        key, begin = np.unique(pairs.keys[order], return_index=True)
        yield pairs.block.id, 0, key, np.add.reduceat(pairs.count[order], begin) if len(key) else begin

    def count_pairs(key: np.ndarray, count: np.ndarray, tag: np.ndarray, origin: np.ndarray) -> tuple:
        at, total = totals(key, count)
        first = np.append(True, key[1:] != key[:-1])
        return np.bincount(at)[at] > 1, total[at] * 2 + first  # what one block alone has it knows

    of_pairs = cut(tally(blocks, n, pairs_of, count_pairs, bits))
    mark = np.uint64((1 << bits) - 1)

    def words_of(table: pa.Table, keys: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
        """Counts of the words of a block from the pairs that it reports; the last key has the numbers of pairs with counts 1 to 4, and of all."""
        pairs = _Pairs(table, keys, values, bits)
        mine, size = pairs.mine, len(pairs.block.vocabulary)
        first, count = pairs.first[mine], pairs.count[mine]
        rows = np.zeros((size + 2, 5), np.int64)
        rows[:, TOTAL] = np.bincount(first + 1, weights=count, minlength=size + 2)
        for k in (ONCE, TWICE, MORE):
            rows[:, k] = np.bincount(first + 1, weights=kind(count) == k, minlength=size + 2)
        rows[1:, BEFORE] = np.bincount(pairs.second[mine], minlength=size + 1)
        rows[size + 1] = [*(int((count == i).sum()) for i in (1, 2, 3, 4)), len(count)]
        key = np.concatenate([[START], pairs.block.vocabulary, [mark]]) >> np.uint64(0)
        key[:-1] = mix(key[:-1]) >> np.uint64(64 - bits)
        order = np.argsort(key, kind="stable")
        key, rows = key[order], rows[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        yield pairs.block.id, 0, key[begin], np.add.reduceat(rows, begin, axis=0)

    def count_words(key: np.ndarray, count: np.ndarray, tag: np.ndarray, origin: np.ndarray) -> tuple:
        at, total = totals(key, count)
        first = np.append(True, key[1:] != key[:-1])
        return np.ones(len(key), bool), np.column_stack([total[at], first])

    of_words_told = cut(tally(blocks, n, words_of, count_words, bits, told=of_pairs))

    def levels_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, four, seen = np.zeros(5, np.int64), np.zeros(5, np.int64), 0
            for raw, values in zip(batch.column(0), batch.column(1), strict=True):
                keys = unpack_sorted(raw.as_py())
                rows = unpack_small(values.as_py()).astype(np.int64).reshape(len(keys), 6)
                rows, keys = rows[rows[:, 5] == 1], keys[rows[:, 5] == 1]
                four += rows[keys == mark, :5].sum(axis=0)
                before = rows[keys != mark, BEFORE]
                level += np.bincount(np.minimum(before, 4), minlength=5)
                seen += int((before > 4).sum())
            level[4] -= seen
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*level[1:], seen, *four)], names=LEVELS)

    sums = of_words_told.select("keys", "values").mapInArrow(levels_of, ", ".join(f"{c} long" for c in LEVELS)).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in LEVELS)).first()
    order1, order2 = discounts([sums[f"c{i}"] for i in (1, 2, 3, 4)]), discounts([sums[f"n{i}"] for i in (1, 2, 3, 4)])
    levels, n_pairs = np.array([0, sums["c1"], sums["c2"], sums["c3"] + sums["c4"] + sums["more"]]), sums["pairs"]
    # what a block was told of pairs and of words, one after the other
    told = of_pairs.withColumn("kind", F.lit(0)).unionByName(of_words_told.withColumn("kind", F.lit(1)))

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        by_kind = [told_of(answers.filter(pa.compute.equal(answers.column("kind"), k))) for k in (0, 1)]
        pairs = _Pairs(table, *by_kind[0], bits)
        block, (keys, values) = pairs.block, by_kind[1]
        size = len(block.vocabulary)
        at = np.searchsorted(keys, mix(np.append(block.vocabulary, START)) >> np.uint64(64 - bits))
        table_of = _table(model, spelling)
        log_p = judged(pairs, values[at][:, :5], spelled(block.spelled[:size] if size else [], table_of), order2, order1, levels, n_pairs)
        chars = np.fromiter((len(w.decode("utf-8", "replace")) + 1 for w in (block.spelled[:size] if size else [])), np.int64, size)
        cost = -np.bincount(block.doc, weights=log_p, minlength=len(block.sizes))
        length = np.bincount(block.doc, weights=chars[block.words], minlength=len(block.sizes))
        return pa.table({"doc_id": pa.array(block.doc_ids, pa.int64()), "lang": pa.array(block.tags, pa.string()),
                         **{c: block.measures[:, i] for i, c in enumerate(COUNTED)}, "log_ppl": pa.array(cost / np.maximum(length, 1), mask=block.sizes == 0)})

    rows = cut(blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, SCORES))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    bands = rows.where("NOT base_failed").groupBy("lang").agg(F.percentile_approx("log_ppl", [0.25, 0.5, 0.75], 10_000).alias("q"))
    q = [F.col("q")[i] for i in range(3)]
    bands = cut(bands.select("lang", (q[1] - below * (q[1] - q[0])).alias("low"), (q[1] + above * (q[2] - q[1])).alias("high")))
    slack = SHORT / F.sqrt(F.greatest("word_chars", F.lit(1)))
    inside = F.coalesce((F.col("log_ppl") >= F.col("low") - slack) & (F.col("log_ppl") <= F.col("high") + slack), F.lit(True))
    # one row of bands per language
    return rows.join(bands, "lang", "left").select(
        "doc_id", *COUNTED, "base_failed", (~F.col("base_failed") & inside).alias("kept"),
        F.exp("log_ppl").alias("perplexity"), F.exp("low").alias("lower_band"), F.exp("high").alias("upper_band"))


LEVELS = ["c1", "c2", "c3", "c4", "more", "n1", "n2", "n3", "n4", "pairs"]
SCORES = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_ppl double"
_tables: dict[str, np.ndarray] = {}


def _table(name: str, shared) -> np.ndarray:
    """The spelling table of a broadcast model of that name, made once in a worker."""
    if name not in _tables:
        _tables.clear()
        _tables[name] = shared.value.table()
    return _tables[name]


@query("op1_perplexity_bands")
def perplexity_bands(spark, sf_dir):
    return verdicts(read(spark, sf_dir, "documents"))
