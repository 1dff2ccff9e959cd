"""Token ids of texts by a public tokenizer file, with bounded memory and every distinct word encoded about once.

A byte-level vocabulary cuts each text into words before it looks at ids, and it always cuts before a single space and around a single
line feed that stand between other characters. So a text whose words are parted by single spaces and line feeds is the
concatenation of units, a word with what stands before it. Units are told apart by 64-bit hashes, the ids of several hundred thousand
are kept as bytes, and ids of whole groups of texts are gathered at once. Every other text goes through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

from tallywright.llm.textscan import Scan, mix

#: texts handled together, in characters
GROUP_CHARS = 1 << 20
#: units whose ids are kept in a Python worker
KEPT_UNITS = 1_000_000
#: units joined to one text for the library, and such texts in one call
CALL_UNITS, CALL_TEXTS = 50, 400
#: a text for the library is given in parts of about this many characters
PART_CHARS = 1 << 20

START, SPACE, FEED = 0, 1, 2
#: white space beyond that which parts words
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """lead: every text stands behind a space. plain_specials: strings of special tokens in a text are plain text."""

    def __init__(self, path: str, lead: bool = False, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # units are distinct, so the library's own memory of words only costs time on them
        self.for_units = Tokenizer.from_file(path)
        if hasattr(self.for_units.model, "_resize_cache"):
            self.for_units.model._resize_cache(0)
        self.lead = " " * lead
        self.tokenizer.encode_special_tokens = self.for_units.encode_special_tokens = plain_specials
        told = json.loads(self.tokenizer.to_str())
        before = told.get("pre_tokenizer") or {}
        self.by_units = (told.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
                         and before.get("use_regex", True))
        self.kept: dict[int, bytes] = {}
        # a byte-level vocabulary writes each byte as one character
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
        self.width[list(vocabulary.values())] = [len(token) for token in vocabulary]
        for at, token in self.tokenizer.get_added_tokens_decoder().items():
            self.width[at] = len(token.content.encode())

    def ids(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def whole(self, text: str) -> bytes:
        return b"".join(map(self.ids, self.parts(text)))

    def parts(self, text: str) -> list[str]:
        """A part ends before a space that stands between two ASCII letters."""
        out, begin = [], 0
        while self.by_units and len(text) - begin > PART_CHARS:
            at = text.find(" ", begin + PART_CHARS)
            while at != -1 and not ((around := text[at - 1 : at + 2 : 2]).isascii() and len(around) == 2 and around.isalpha()):
                at = text.find(" ", at + 1)
            if at == -1:
                break
            out.append(text[begin:at])
            begin = at
        return [*out, text[begin:]]

    def of_words(self, words: list[bytes], gap: bytes) -> list[bytes]:
        """Ids of each word behind a space, or of words on lines of their own; many are encoded in one text.

        The ids of a joined text are told apart by the bytes they stand for.
        """
        out: list[bytes] = []
        groups = [words[i : i + CALL_UNITS] for i in range(0, len(words), CALL_UNITS)]
        lead = int(gap == b" ")  # a space belongs to its word, a line feed to none
        for i in range(0, len(groups), CALL_TEXTS):
            now = groups[i : i + CALL_TEXTS]
            texts = [(gap * lead + gap.join(g)).decode() for g in now]
            for group, e in zip(now, self.for_units.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.asarray(e.ids, "<u4")
                starts = np.cumsum(self.width[ids]) - self.width[ids]
                sizes = np.fromiter(map(len, group), np.int64, len(group)) + lead
                ends = np.cumsum(sizes + (1 - lead)) - (1 - lead)
                low, high = np.searchsorted(starts, ends - sizes).tolist(), np.searchsorted(starts, ends).tolist()
                raw = ids.tobytes()
                out += [raw[4 * a : 4 * b] for a, b in zip(low, high, strict=True)]
        return out

    def learn(self, words: list[bytes], kinds: list[int]) -> list[bytes]:
        """Ids of units: words and what stands before each."""
        spaced = iter(self.of_words([w for w, k in zip(words, kinds, strict=True) if k == SPACE], b" "))
        bare = iter(self.of_words([w for w, k in zip(words, kinds, strict=True) if k != SPACE], b"\n"))
        feed = self.ids("\n")
        return [next(spaced) if k == SPACE else (feed if k == FEED else b"") + next(bare) for k in kinds]

    def group(self, texts: list[str]) -> Iterator[bytes]:
        if not self.by_units:
            yield from (self.whole(self.lead + t) if t else b"" for t in texts)
            return
        raws = [t.encode() for t in texts]
        scan = Scan(raws)
        n = len(raws)
        before = scan.buf[scan.starts - 1]
        first = np.zeros(len(scan.starts), bool)
        first[scan.first_word[scan.n_words > 0]] = True
        parted = np.ones(len(scan.starts), bool)
        parted[1:] = (scan.starts[1:] - scan.stops[:-1] == 1) & ((before[1:] == 32) | (before[1:] == 10))
        sound = (scan.n_words > 0) & (np.bincount(scan.doc[~parted & ~first], minlength=n) == 0)
        some = np.flatnonzero(scan.n_words > 0)
        head, tail = scan.first_word[some], scan.first_word[some] + scan.n_words[some] - 1
        sound[some] &= (scan.starts[head] == scan.begins[some]) & (scan.stops[tail] == scan.ends[some])
        sound &= np.fromiter((_ODD_SPACE.search(t) is None for t in texts), bool, n)
        at = np.flatnonzero(sound[scan.doc])
        kind = np.where(first, SPACE if self.lead else START, np.where(before == 32, SPACE, FEED))[at]
        key, place, unit = np.unique(mix(scan.word_hashes()[at] + kind.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_index=True, return_inverse=True)
        names = key.tolist()
        found = list(map(self.kept.get, names))
        if missing := [i for i, f in enumerate(found) if f is None]:
            which = place[missing]
            joined = scan.buf.tobytes()
            words = [joined[a:b] for a, b in zip(scan.starts[at[which]].tolist(), scan.stops[at[which]].tolist(), strict=True)]
            if len(self.kept) + len(missing) > KEPT_UNITS:
                self.kept.clear()
            for i, ids in zip(missing, self.learn(words, kind[which].tolist()), strict=True):
                self.kept[names[i]] = found[i] = ids
        # the ids of all units, laid out word by word
        ids = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        wide = size[unit]
        end = np.cumsum(wide)
        out = ids[np.repeat((np.cumsum(size) - size)[unit] - (end - wide), wide) + np.arange(end[-1] if len(end) else 0)]
        count = np.bincount(scan.doc[at], weights=wide, minlength=n).astype(np.int64)
        stop = np.cumsum(count)
        for i, text in enumerate(texts):
            yield out[stop[i] - count[i] : stop[i]].tobytes() if sound[i] else self.whole(self.lead + text) if text else b""


@lru_cache(maxsize=2)
def load(path: str, lead: bool = False, plain_specials: bool = False) -> Encoder:
    return Encoder(path, lead, plain_specials)


def encoded(texts: Iterable[str | None], path: str, lead: bool = False, plain_specials: bool = False) -> Iterator[np.ndarray]:
    """uint32 ids of each text in order; null reads as empty, and an empty text has no ids."""
    encoder, group, size = load(path, lead, plain_specials), [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= GROUP_CHARS:
            yield from (np.frombuffer(b, "<u4") for b in encoder.group(group))
            group, size = [], 0
    yield from (np.frombuffer(b, "<u4") for b in encoder.group(group))
