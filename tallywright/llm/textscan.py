"""Vectorised reading of many texts at once: word limits, word hashes, shingles.

Words are `[^\\x20\\x09-\\x0D]+`. Texts are read in chunks of a few megabytes, so memory does not follow the size of a batch;
one text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CHUNK_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _powers[i] = np.multiply.accumulate(row)
    return _powers[0][:n], _powers[1][:n]


def chunks(texts: Iterable[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, encoded texts) with about `limit` bytes each; null reads as empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = b"" if text is None else text.encode("utf-8", "replace")
        if held and size + len(raw) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, held


class Scan:
    """The words of some encoded texts: byte limits, the text each is in, and the words of each text."""

    def __init__(self, raws: list[bytes], lower: bool = False, space: np.ndarray = SPACE):
        joined = b"\n".join(raws) + b"\n"
        self.buf = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        sizes = np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws))
        self.ends = np.cumsum(sizes) - 1
        self.begins = self.ends - sizes + 1
        edge = np.flatnonzero(np.diff(space[self.buf], prepend=True))
        self.starts, self.stops = edge[::2], edge[1::2]
        self.doc = np.searchsorted(self.ends, self.starts, side="left")
        self.n_words = np.bincount(self.doc, minlength=len(raws))
        self.first_word = np.cumsum(self.n_words) - self.n_words

    def word_hashes(self) -> np.ndarray:
        power, inverse = powers(len(self.buf) + 1)
        total = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum(BYTE_CODES[self.buf] * power[:-1], out=total[1:])
        return mix((total[self.stops] - total[self.starts]) * inverse[self.starts])


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of aligned hashes, dependent on their order."""
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + p + np.uint64(0x632BE59BD9B4E019))
    return out


def shingles(scan: Scan, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of the distinct word shingles of each text, ordered by both.

    A text of fewer words than `width` has its whole sequence as its only shingle; one without words has none.
    """
    words, n = scan.word_hashes(), scan.n_words
    at = np.flatnonzero(np.arange(len(words)) + width <= (scan.first_word + n)[scan.doc])
    value = combine(*(words[at + i] for i in range(width)))
    count = np.maximum(n - width + 1, 0)
    last = np.cumsum(count)
    for a, b in zip((last - count)[count > 1], last[count > 1], strict=True):
        value[a:b].sort()
    doc = np.repeat(np.arange(len(n)), count)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    docs, hashes = [doc[new]], [value[new]]
    for length in range(1, width):
        short = np.flatnonzero(n == length)
        docs.append(short)
        hashes.append(combine(np.full(len(short), length, np.uint64), *(words[scan.first_word[short] + i] for i in range(length))))
    doc, value = np.concatenate(docs), np.concatenate(hashes)
    order = np.argsort(doc, kind="stable")
    return doc[order], value[order]
