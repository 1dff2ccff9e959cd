"""Quality classifier: a generalised additive model with pairwise interactions.

Measures of whole texts are cut into bins. Boosting goes round the features in turn; each step fits a shallow tree (at most four
leaves) to the gradient over one feature's bins and adds a fraction of it to that feature's lookup table. Then the pairs of features
whose bins explain most of what is left get tables of their own in the same way. A score is the sum of one entry of each
table, taken for all rows at once, through the logistic function.

The fit uses at most about `SAMPLE_ROWS` labelled rows, those with a small hash of their id; measures and scores cover every row.

Defined cases: null, empty and wordless texts have all measures 0 and are scored like any other; null labels teach nothing; a document
labelled more than once has the highest label; without labelled rows of both kinds every score is the share of label 1, or 0.5; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import crc_of_id, cut, query, read
from tallywright.llm.quality_rules import base_counts
from tallywright.llm.textscan import Scan, chunks, mix

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS = 32, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 300, 120, 10
RATE = 0.1
#: least sum of second derivatives in a leaf, and their ridge
LEAST_WEIGHT, RIDGE = 2.0, 1.0
THRESHOLD = 0.3

FEATURES = ("log_words", "word_length", "symbol_share", "upper_share", "digit_share", "stop_share", "mark_share", "bar_share", "far_share",
            "repeat_share", "same_lines", "distinct_words", "top_word", "words_per_line", "bare_words", "log_chars")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def measures(raws: list[bytes]) -> np.ndarray:
    """(texts, FEATURES) of whole texts."""
    scan = Scan(raws)
    base = base_counts(scan, raws)
    n, chars = base["n_words"], base["word_chars"]

    def count(flag: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flag) + 1, np.int64)
        np.cumsum(flag, out=total[1:])
        return total[scan.ends] - total[scan.begins]

    def share(part, whole) -> np.ndarray:
        return part / np.maximum(whole, 1)

    buf = scan.buf
    letters, lines = count(_LETTER[buf]), count(buf == 10) + (n > 0)
    letter_sum = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_LETTER[buf], out=letter_sum[1:])
    bare = np.bincount(scan.doc[letter_sum[scan.stops] == letter_sum[scan.starts]], minlength=len(raws))
    # occurrences of each distinct word of each text
    key = np.sort(mix(scan.word_hashes() ^ mix(scan.doc.astype(np.uint64) + np.uint64(1))) >> np.uint64(24) | (scan.doc.astype(np.uint64) << np.uint64(40)))
    start = np.flatnonzero(np.diff(key, prepend=key[:1] + np.uint64(1))) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(start, len(key)))
    owner = (key[start] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(len(raws), np.int64)
    np.maximum.at(top, owner, times)
    distinct = np.bincount(owner, minlength=len(raws))
    columns = [np.log1p(n), share(chars, n), share(base["n_symbols"], chars), share(count(_UPPER[buf]), letters), share(count(_DIGIT[buf]), chars),
               share(count((buf == 46) | (buf == 44) | (buf == 59)), n), share(count((buf == 33) | (buf == 63)), n), share(count(buf == 124), n),
               share(count(buf >= 0xC2), chars), share(base["n_repeat_words"], n), share(base["n_dup_lines"], lines), share(distinct, n), share(top, n),
               np.log1p(share(n, lines)), share(bare, n), np.log1p(chars)]
    out = np.stack(columns, 1).astype(float)
    out[n == 0] = 0
    return out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and one double per feature, of every document (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raws in chunks(t.as_py() for t in batch.column(1)):
                made = measures(raws)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(raws)), *(pa.array(made[:, i].copy()) for i in range(len(FEATURES)))],
                                                 names=["doc_id", *FEATURES])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


@dataclass
class Model:
    """edges, pair_edges: inner limits of the bins per feature; tables: one per feature; pairs: (i, j, table)."""

    intercept: float
    edges: list[np.ndarray]
    pair_edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for i, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[i], x[:, i], side="right")]
        for i, j, table in self.pairs:
            total += table[np.searchsorted(self.pair_edges[i], x[:, i], side="right"), np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> int:
    """Bins left of the best cut of a run of bins; 0 if no cut gains."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = _gain(left_g, left_h) + _gain(right_g, right_h) - _gain(g.sum(), h.sum())
    gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = -1
    return int(gain.argmax()) + 1 if len(gain) and gain.max() > 0 else 0


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Value of each bin under a tree of depth two."""
    limits = [0, len(g)]
    for _ in range(2):
        limits = sorted({*limits, *(a + c for a, b in zip(limits, limits[1:], strict=False) if (c := _best_cut(g[a:b], h[a:b])))})
    out = np.zeros(len(g))
    for a, b in zip(limits, limits[1:], strict=False):
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """(gain, rows above, columns left) of the best cut of a table into four."""
    G, H = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, ha = G[:-1, :-1], H[:-1, :-1]
    b, hb = G[:-1, -1:] - a, H[:-1, -1:] - ha
    c, hc = G[-1:, :-1] - a, H[-1:, :-1] - ha
    d, hd = G[-1, -1] - a - b - c, H[-1, -1] - ha - hb - hc
    gain = _gain(a, ha) + _gain(b, hb) + _gain(c, hc) + _gain(d, hd) - _gain(G[-1, -1], H[-1, -1])
    at = np.unravel_index(gain.argmax(), gain.shape)
    return float(gain[at]), int(at[0]) + 1, int(at[1]) + 1


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS, pair_rounds: int = PAIR_ROUNDS, rate: float = RATE) -> Model:
    """Cyclic boosting on rows x (features) and labels y (0 or 1)."""
    n, width = x.shape
    mean = y.mean() if n else 0.5
    limits = lambda bins: [np.unique(np.quantile(x[:, i], np.arange(1, bins) / bins)) if n else np.zeros(0) for i in range(width)]
    edges, pair_edges = limits(BINS), limits(PAIR_BINS)
    model = Model(0.0, edges, pair_edges, [np.zeros(len(e) + 1) for e in edges])
    if not 0 < mean < 1:
        model.intercept = 40.0 if mean == 1 else -40.0
        return model
    model.intercept = float(np.log(mean / (1 - mean)))
    at = [np.searchsorted(edges[i], x[:, i], side="right") for i in range(width)]
    total = np.full(n, model.intercept)

    def derivatives() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            g, h = derivatives()
            step = rate * shallow_tree(np.bincount(at[i], g, len(table)), np.bincount(at[i], h, len(table)))
            table += step
            total += step[at[i]]
    coarse = [np.searchsorted(pair_edges[i], x[:, i], side="right") for i in range(width)]
    shape = [len(e) + 1 for e in pair_edges]

    def sums(i: int, j: int, value: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[i] * shape[j] + coarse[j], value, shape[i] * shape[j]).reshape(shape[i], shape[j])

    g, h = derivatives()
    ranked = sorted(((-_quarters(sums(i, j, g), sums(i, j, h))[0], i, j) for i, j in combinations(range(width), 2) if shape[i] > 1 and shape[j] > 1))
    model.pairs = [(i, j, np.zeros((shape[i], shape[j]))) for _, i, j in ranked[:pairs]]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            g, h = derivatives()
            sg, sh = sums(i, j, g), sums(i, j, h)
            _, r, c = _quarters(sg, sh)
            step = np.zeros_like(table)
            for rows in (slice(0, r), slice(r, None)):
                for columns in (slice(0, c), slice(c, None)):
                    step[rows, columns] = -rate * sg[rows, columns].sum() / (sh[rows, columns].sum() + RIDGE)
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def fit_sample(features: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample of labelled rows. labels: doc_id, quality."""
    marked = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    rows = features.join(marked, "doc_id")
    known = rows.count()
    if known > sample_rows:
        # a share of the ids by hash, a little below the bound so that chance does not exceed it
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * 0.95 * sample_rows / known))
    rows = rows.toPandas().sort_values("doc_id", kind="stable")
    model = fit(rows[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)), rows["quality"].to_numpy(float))
    if not len(rows):
        model.intercept = 0.0
    return model


def scored(features: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row of features."""
    shared = features.sparkSession.sparkContext.broadcast(model)  # tables of a fixed number of bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(FEATURES))], 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], names=["doc_id", "score"])

    return features.select("doc_id", *FEATURES).mapInArrow(run, "doc_id long, score double")


def held_out(doc_id) -> Column:
    return F.coalesce(crc_of_id(doc_id) % 5 == 0, F.lit(False))


@query("op6_additive_quality")
def additive_quality(spark, sf_dir):
    features = cut(measured(read(spark, sf_dir, "documents")))
    labels = read(spark, sf_dir, "labels")
    model = fit_sample(features, labels.where(~held_out(F.col("doc_id"))))
    rows = scored(features, model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
