"""Operators that count n-grams of the whole corpus through word blocks."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallywright.llm import blocks, collocations, jaccardjoin


def word_sets(rows, width):
    out = []
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append((doc_id, {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()))
    return out


def plain_components(rows, width, pct):
    """doc_id -> (set size, smallest id reachable), by comparing everything with everything."""
    sets = word_sets(rows, width)
    top = {d: d for d, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    holders = defaultdict(set)
    for i, (_, s) in enumerate(sets):
        for g in s:
            holders[g].add(i)
    for i, (d, s) in enumerate(sets):
        for j in set().union(*(holders[g] for g in s)) if s else ():
            if j < i:
                e, t = sets[j]
                if 100 * len(s & t) >= pct * len(s | t):
                    a, b = find(d), find(e)
                    top[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets}


def family(seed=3):
    """Copies, a chain, near copies of one text, texts that share a passage, and short texts."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i + 1, " ".join(words)))
    for i in range(40):  # each is near its neighbours alone
        rows.append((100 + i, " ".join(f"c{j}" for j in range(i * 2, i * 2 + 100))))
    shared = " ".join(f"p{i}" for i in range(60))
    rows += [(200 + i, f"{shared} " + " ".join(f"q{i}_{j}" for j in range(20))) for i in range(10)]
    rows += [(300, "Aa bB"), (301, "aA Bb"), (302, "aa"), (303, "aa bb cc"), (304, ""), (305, None), (306, " \t "), (20, None)]
    rows += [(400 + i, rows[0][1]) for i in range(5)]
    return [r for r in rows if r != (20, None)]


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(1)
    for top in (1, 200, 1 << 20, 1 << 63):
        keys = np.unique(rng.integers(0, top, 500, dtype=np.uint64))
        assert np.array_equal(blocks.unpack_sorted(blocks.pack_sorted(keys)), keys)
        assert np.array_equal(blocks.unpack_small(blocks.pack_small(keys)), keys)
    assert len(blocks.unpack_sorted(blocks.pack_sorted(np.zeros(0, np.uint64)))) == 0 == len(blocks.unpack_small(blocks.pack_small(np.zeros(0, np.uint64))))


@pytest.mark.parametrize(("width", "pct"), [(3, 90), (5, 80), (2, 100)])
def test_jaccard_join_matches_brute_force(spark, width, pct, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_WORDS", 700)
    monkeypatch.setattr(blocks, "RANGE_KEYS", 500)
    monkeypatch.setattr(jaccardjoin, "BLOCK", 8)
    monkeypatch.setattr(jaccardjoin, "PARTNERS", 4)
    rows = family()
    got = jaccardjoin.linked_components(spark.createDataFrame(rows, "doc_id long, text string"), width, pct)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == plain_components(rows, width, pct)


def test_jaccard_join_of_given_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccardjoin.linked_components(documents).collect()}
    assert got == plain_components(rows, 3, 90)


def test_jaccard_join_of_odd_rows(odd, nothing):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccardjoin.linked_components(odd).collect()]
    assert len(got) == odd.count()
    assert {(d, c) for d, _, c in got if d in (1, 2, 3, 4, 5, 9, 11, 12)} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (9, 9), (11, 11), (12, 11)}
    assert jaccardjoin.linked_components(nothing).count() == 0


def plain_collocations(rows, longest, support, pct, top):
    """(lang, rank) -> columns, by counting every phrase of every piece."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    chosen = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= support}
    rows = defaultdict(list)
    for (lang, w), a in chosen.items():
        inside = max((b for (other, v), b in chosen.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))), default=0)
        if inside and 100 * inside >= pct * a:
            continue
        score, k = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        rows[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, rank): (p.decode(), -a, left, right, n[lang], -s) for lang, found in rows.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


@pytest.mark.parametrize(("longest", "support", "top"), [(3, 10, 2000), (4, 3, 7)])
def test_collocations_match_plain_counts(spark, odd, longest, support, top, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_WORDS", 400)
    monkeypatch.setattr(blocks, "RANGE_KEYS", 300)
    rng = random.Random(5)
    rows = []
    for i in range(150):
        words = [rng.choice("Über alpha BETA gamma delta e é 日本 f g".split()) for _ in range(30)]
        marks = [rng.choice(["", "", "", ".", ",", "!", "\n", "\t", " \x0b"]) for _ in range(30)]
        rows.append((rng.choice(["en", "de", None, "und", ""]), " ".join(w + m for w, m in zip(words, marks, strict=True))))
    rows += [("en", "x x x x x x x x x x x x")] * 4 + [("en", None), (None, ""), ("de", " ,. ;")]
    got = collocations.collocations(spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string"), longest, support, 50, top)
    assert {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got.collect()} == plain_collocations(rows, longest, support, 50, top)


def test_local_supports_lose_nothing():
    for shares in ([1, 1, 1, 1], [100, 0, 3, 7], [0, 0, 0, 0], [5]):
        assert (collocations.local_supports(shares, 10) - 1).sum() <= 9


def test_scores_pass_64_bits():
    assert collocations.best_cut(10**12, [(10**13, 10**12), (10**12, 10**13)]) == (1, 10**13, 10**12, 100_000)


def test_collocations_of_odd_rows(odd, nothing):
    assert collocations.collocations(odd, support=2).where("lang = 'de' AND phrase = 'wörter über straßen' AND a = 2").count() == 1
    assert collocations.collocations(nothing).count() == 0


def test_cells_take_a_byte_and_long_sets_still_meet(spark):
    rng = np.random.default_rng(23)
    base = np.unique(rng.integers(0, 1 << 60, 9000).astype(np.uint64))  # many in few parts of the hash space: counts pass a byte
    made = [base, np.delete(base, np.arange(100, 500))]
    sets = spark.createDataFrame([(i, len(x), 0, bytearray(x.tobytes())) for i, x in enumerate(made)], "id long, n long, lead long, tokens binary")
    rows = jaccardjoin.prefix_entries(sets, 90).collect()
    assert {len(r.cells) for r in rows} == {jaccardjoin.CELLS}
    a, b = (next(r for r in rows if r.id == i and r.place == 0) for i in (0, 1))
    cells = [np.frombuffer(r.cells, np.uint8)[None] for r in (a, b)]
    assert a.token == b.token and max(c.max() for c in cells) == 255
    n, m, at = np.array([a.n]), np.array([b.n]), np.zeros(1, np.int64)
    assert jaccardjoin.survives(n, m, at, at, *cells, 90).all()
