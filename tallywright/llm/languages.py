"""Language identification: scripts narrow the candidates, a Viterbi pass with a switching penalty labels spans of words.

Spark counts, per language, hashed byte trigrams of words and letters by script over the training rows. A word's score for a language is
the sum of its trigrams' log-probabilities; only languages that are written in the word's script are candidates. The best
path through the words of a text, where every change of language costs `SWITCH`, labels its spans; the prediction is the language
of most letters, and the score the share of letters it has.

Defined cases: null texts and texts without a letter are `und` with score 0; words without letters take the language around them; letters of
a script that no language of the training uses narrow nothing; ties go to the language first by name; without training rows
every text is `und`; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import crc_of_id, query, read
from tallywright.llm.textscan import Scan, chunks

SLOT_BITS = 16
SWITCH = 12.0
#: the most that one word can speak against a language
WORD_LIMIT = 6.0
#: a language uses a script that holds this share of its letters
SCRIPT_SHARE = 0.01
CHUNK = 4 << 20

# first code point of each script range; ranges run to the next one (fixed values of the Unicode blocks)
RANGES = ((0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"),
          (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"), (0x0B80, "tamil"), (0x0C00, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
          (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
          (0x3100, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"))
SCRIPTS = tuple(dict.fromkeys(name for _, name in RANGES))
_STARTS = np.array([start for start, _ in RANGES])
_SCRIPT = np.array([SCRIPTS.index(name) for _, name in RANGES])

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def slots(scan: Scan) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigram, word it is in) of every letter byte, and of the place behind each run of letters."""
    s = _LETTER[scan.buf]
    p1 = np.empty_like(s)
    p1[0], p1[1:] = 0x20, s[:-1]
    p2 = np.empty_like(s)
    p2[:2], p2[2:] = 0x20, s[:-2]
    p2[p1 == 0x20] = 0x20
    at = np.flatnonzero((s != 0x20) | (p1 != 0x20))
    code = (p2[at].astype(np.uint32) << np.uint32(16)) | (p1[at].astype(np.uint32) << np.uint32(8)) | s[at]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)
    word = np.searchsorted(scan.starts, at, side="right") - 1 if len(scan.starts) else at
    return code, word


def word_scripts(scan: Scan) -> np.ndarray:
    """Script of each word's first non-ASCII character beyond Latin, else Latin; -1 for words without letters."""
    s = _LETTER[scan.buf]
    has = np.add.reduceat(s != 0x20, scan.starts, dtype=np.int64) > 0 if len(scan.starts) else np.zeros(0, bool)
    out = np.where(has, 0, -1)
    lead = np.flatnonzero(scan.buf >= 0xC2)
    b = np.append(scan.buf, np.zeros(3, np.uint8)).astype(np.int64)
    x = b[lead]
    cp = np.where(x < 0xE0, (x & 0x1F) << 6 | b[lead + 1] & 0x3F,
                  np.where(x < 0xF0, (x & 0xF) << 12 | (b[lead + 1] & 0x3F) << 6 | b[lead + 2] & 0x3F,
                           (x & 7) << 18 | (b[lead + 1] & 0x3F) << 12 | (b[lead + 2] & 0x3F) << 6 | b[lead + 3] & 0x3F))
    script = _SCRIPT[np.searchsorted(_STARTS, cp, side="right") - 1]
    far = (script != 0) & (script != SCRIPTS.index("other"))
    word = np.searchsorted(scan.starts, lead[far], side="right") - 1
    out[word[::-1]] = script[far][::-1]
    return out


@dataclass
class Model:
    """names: languages by name; log_p: (languages, slots); written: (scripts, languages) that are candidates."""

    names: list[str]
    log_p: np.ndarray
    written: np.ndarray


def fit(training: DataFrame) -> Model:
    """training: text and non-null lang. What comes to the driver is bounded by languages times slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            sums: dict[str, np.ndarray] = {}
            for first, raws in chunks((t.as_py() for t in batch.column(0)), CHUNK):
                scan = Scan(raws)
                code, word = slots(scan)
                script = word_scripts(scan)
                for lang in np.unique(langs[first : first + len(raws)]):
                    here = langs[first : first + len(raws)] == lang
                    words = here[scan.doc]
                    n = sums.setdefault(lang, np.zeros((1 << SLOT_BITS) + len(SCRIPTS), np.int64))
                    n[: 1 << SLOT_BITS] += np.bincount(code[words[word]], minlength=1 << SLOT_BITS)
                    n[1 << SLOT_BITS :] += np.bincount(script[words & (script >= 0)], minlength=len(SCRIPTS))
            for lang, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "slot", "n"])

    counts = training.select("text", "lang").mapInArrow(run, "lang string, slot int, n long")
    rows = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows["lang"].unique())
    table = np.zeros((len(names), (1 << SLOT_BITS) + len(SCRIPTS)))
    table[rows["lang"].map({name: i for i, name in enumerate(names)}).to_numpy(int), rows["slot"].to_numpy(int)] = rows["n"].to_numpy()
    grams, scripts = table[:, : 1 << SLOT_BITS], table[:, 1 << SLOT_BITS :]
    log_p = np.log((grams + 0.5) / (grams.sum(1, keepdims=True) + 0.5 * (1 << SLOT_BITS)))
    written = (scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)).T
    written[~written.any(1)] = True
    return Model(names, log_p.astype(np.float32), written)


def best_paths(score: np.ndarray, first: np.ndarray, n: np.ndarray, switch: float) -> np.ndarray:
    """The language of each word on the best path of its text; score: (words, languages). All texts advance together."""
    label = np.zeros(len(score), np.int16)
    if not len(score):
        return label
    order = np.argsort(-n, kind="stable")
    begin, length = first[order], n[order]
    stay = np.zeros(score.shape, bool)
    came = np.zeros(len(score), np.int16)
    live = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
    value = score[begin[: live[0]]].copy()
    ends = np.zeros(len(n), np.int16)
    for t in range(1, length[0]):
        m = live[t]
        if m < len(value):
            ends[m : len(value)] = value[m:].argmax(1)
            value = value[:m]
        top = value.argmax(1)
        value -= value[np.arange(m), top][:, None]
        at = begin[:m] + t
        stay[at] = value >= -switch
        came[at] = top
        np.maximum(value, -switch, out=value)
        value += score[at]
    ends[: len(value)] = value.argmax(1)
    now = ends[:0]
    for t in range(length[0] - 1, -1, -1):
        m = live[t]
        if m > len(now):
            now = np.concatenate([now, ends[len(now) : m]])
        at = begin[:m] + t
        label[at] = now
        if t:
            now = np.where(stay[at, now], now, came[at])
    return label


def labelled(docs: DataFrame, model: Model, switch: float = SWITCH, carry: list[str] | None = None) -> DataFrame:
    """row, lang_pred, score, spans (first word, word behind the last, lang) of every document.

    row: struct of the columns in `carry` (doc_id by default), as they came.
    """
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry or ["doc_id"])).alias("row"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages times slots
    span = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        names = np.array(m.names, object)
        for batch in batches:
            for begin, raws in chunks((t.as_py() for t in batch.column(1)), CHUNK):
                scan = Scan(raws)
                code, word = slots(scan)
                script = word_scripts(scan)
                pred, share, spans = ["und"] * len(raws), np.zeros(len(raws)), [[] for _ in raws]
                if len(names) and len(word):
                    score = np.stack([np.bincount(word, weights=p[code], minlength=len(scan.starts)) for p in m.log_p], 1)
                    allowed = m.written[np.maximum(script, 0)] | (script < 0)[:, None]
                    score[~allowed] = -np.inf
                    score = np.maximum(score - score.max(1, keepdims=True), -WORD_LIMIT).astype(np.float32)
                    label = best_paths(score, scan.first_word, scan.n_words, switch)
                    letters = np.bincount(word, minlength=len(scan.starts))
                    held = np.bincount(scan.doc * len(names) + label, weights=letters, minlength=len(raws) * len(names)).reshape(len(raws), -1)
                    total, best = held.sum(1), held.argmax(1)
                    turn = np.flatnonzero((np.diff(label, prepend=-1) != 0) | (np.diff(scan.doc, prepend=-1) != 0))
                    for a, b in zip(turn.tolist(), np.append(turn[1:], len(label)).tolist(), strict=True):
                        d = int(scan.doc[a])
                        spans[d].append({"first": a - int(scan.first_word[d]), "end": b - int(scan.first_word[d]), "lang": m.names[label[a]]})
                    ascii_letter = np.add.reduceat((_LETTER[scan.buf] != 0x20) & (scan.buf < 0x80), scan.begins, dtype=np.int64) > 0
                    for d in np.flatnonzero(total):
                        if ascii_letter[d] or any(c.isalpha() for c in raws[d].decode()):
                            pred[d], share[d] = names[best[d]], held[d, best[d]] / total[d]
                        else:
                            spans[d] = []
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(raws)), pa.array(pred, pa.string()), pa.array(share), pa.array(spans, pa.list_(span))],
                    names=["row", "lang_pred", "score", "spans"])

    kind = docs.schema["row"].dataType.simpleString()
    return docs.mapInArrow(run, f"row {kind}, lang_pred string, score double, spans array<struct<first:int,end:int,lang:string>>")


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: two thirds by crc32 of the id, with a language."""
    return docs.where((crc_of_id(F.col("doc_id")) % 3 != 1) & F.col("lang").isNotNull())


@query("op3_language_spans")
def language_spans(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    rows = labelled(docs, fit(training_rows(docs)))
    held = F.coalesce(crc_of_id(F.col("doc_id")) % 3 == 1, F.lit(False))
    return rows.select("row.doc_id", "lang_pred", "score").select("doc_id", held.alias("held_out"), "lang_pred", "score")
