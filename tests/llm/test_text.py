"""Operators that read texts in batches: rules, languages, classifier, near-duplicates, tokens, packing."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywright.llm import blocks, classifier, languages, neardup, packing, quality_rules, textscan, tokenfiles, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD_TEXTS = ["", "\n", " a", "a ", "a  b", "\na", "a\n", "a\n\nb", "a \n b", "x  y", "x  y", "don't 's it's. we'll, O'", "a\0b c", "é\n è! ü.",
             "1 2\n3", "<|endoftext|> a<|endoftext|>b", "a\r\nb", "tab\tb \tc", "Wow!! ok?! (x) .y z.", "漢字 かな. 😀 😀"]


def test_scan_finds_words_and_shingles():
    texts = ["a b c d a b c", "", "  x ", "two words", None, "\x0bq\x0cr\x1cs\n"]
    raws = next(textscan.chunks(texts))[1]
    scan = textscan.Scan(raws)
    got = [bytes(scan.buf[a:b]).decode() for a, b in zip(scan.starts, scan.stops, strict=True)]
    assert got == [w for t in texts for w in WORD.findall(t or "")]
    assert scan.n_words.tolist() == [len(WORD.findall(t or "")) for t in texts]
    doc, _ = textscan.shingles(scan, 3)
    assert np.bincount(doc, minlength=6).tolist() == [4, 0, 1, 1, 0, 1]
    hashes = scan.word_hashes()
    assert hashes[0] == hashes[4] and hashes[0] != hashes[1]


def plain_counts(text):
    words, lines, seen, dup = WORD.findall(text or ""), (text or "").split("\n"), set(), 0
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))


def test_rules_on_odd_rows(odd, nothing, documents):
    for docs in (odd, documents):
        rows = {r.doc_id: r for r in quality_rules.verdicts(docs).collect()}
        for d in docs.collect():
            r = rows[d.doc_id]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(d.text)
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept is not None and not (r.base_failed and r.kept)
    assert quality_rules.verdicts(nothing).count() == 0


def test_model_is_a_distribution_and_counts_everything(documents):
    table = quality_rules.fit(documents).table()
    mass = np.exp(table.reshape(-1, 1 << quality_rules.BITS).astype(float)).sum(1)
    assert mass == pytest.approx(np.ones(len(mass)), abs=2e-3)
    raws = [t.text.encode() for t in documents.collect()]
    n = sum(r.n for r in quality_rules.count_grams(documents).collect())
    assert n == sum(sum(b < 192 for b in raw) for raw in raws)


def test_word_order_counts_and_the_model_grows(spark):
    rng = np.random.default_rng(23)
    after = rng.integers(0, 400, (400, 3))  # three words may follow each word
    texts = []
    for _ in range(300):
        at, words = int(rng.integers(400)), []
        for _ in range(150):
            words.append(f"w{at}")
            at = int(after[at, rng.integers(3)])
        texts.append(words)
    mixed = [list(rng.permutation(t)) for t in texts[:12]]
    again = [(t[:40] + texts[50 + i][:70] + t[:40]) for i, t in enumerate(texts[20:32])]  # less than half are repeated: the base rule passes
    rows = [(i, " ".join(t), "en") for i, t in enumerate(texts + mixed + again)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality_rules.verdicts(docs).collect()}
    plain = sum(got[i].kept for i in range(300))
    assert plain >= 290 and not any(got[i].kept for i in range(300, 312))
    assert max(got[i].perplexity for i in range(312, 324)) < min(got[i].perplexity for i in range(300, 312))


def plain_log_ppl(rows, table):
    """Log-perplexity per character of each text by a modified Kneser-Ney pair model of the other texts, counted by plain loops."""
    texts = [[(lang or "und", w) for w in WORD.findall(text or "")] for _, text, lang in rows]
    pairs = [Counter(zip([("", "")] + t, t, strict=False)) for t in texts]
    spell = {}
    for w in {w for t in texts for _, w in t}:
        scan = textscan.Scan([b" " + w.encode() + b" "])
        spell[w] = math.exp(max(float(table[quality_rules.grams(scan)[0]].astype(float)[1:].sum()), -600.0))

    def tables(counts):
        total, follow, before = Counter(), defaultdict(Counter), Counter()
        for (a, b), c in counts.items():
            total[a] += c
            follow[a][min(c, 3)] += 1
            before[b] += 1
        return total, follow, before

    everything = sum(pairs, Counter())
    _, _, before = tables(everything)
    of = lambda values: quality_rules.discounts([sum(v == i for v in values) for i in (1, 2, 3, 4)])
    d2, d1 = of(list(everything.values())), of(list(before.values()))
    out = {}
    for (doc_id, _, _), words, own in zip(rows, texts, pairs, strict=True):
        if not words:
            out[doc_id] = None
            continue
        others = everything - own
        total, follow, before = tables(others)
        freed1 = sum(d1[k] * sum(min(v, 3) == k for v in before.values()) for k in (1, 2, 3)) / max(1, len(others)) if others else 1.0
        cost = 0.0
        for a, b in zip([("", "")] + words, words, strict=False):
            p = max(before[b] - d1[min(before[b], 3)], 0) / max(1, len(others)) + freed1 * spell[b[1]]
            if total[a]:
                c = others[a, b]
                p = max(c - d2[min(c, 3)], 0) / total[a] + sum(d2[k] * follow[a][k] for k in (1, 2, 3)) / total[a] * p
            cost -= math.log(p)
        out[doc_id] = cost / sum(len(w) + 1 for _, w in words)
    return out


def test_perplexity_is_modified_kneser_ney_by_the_other_texts(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_WORDS", 150)
    monkeypatch.setattr(blocks, "RANGE_KEYS", 200)
    rng = random.Random(31)
    words = "alpha Beta gamma delta é 日本 x y z of the".split()
    rows = [(i, " ".join(rng.choices(words, [9, 7, 5, 4, 3, 3, 2, 1, 1, 8, 9], k=rng.randrange(1, 60))), rng.choice(["en", "de", None])) for i in range(60)]
    rows += [(100, rows[0][1], rows[0][2]), (101, "quite unknown words", "en"), (102, "", "en"), (103, None, None), (104, "alone", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = plain_log_ppl(rows, quality_rules.fit(docs).table())
    got = {r.doc_id: r.perplexity for r in quality_rules.verdicts(docs).collect()}
    assert got.keys() == want.keys()
    for i, p in got.items():
        assert p is None if want[i] is None else math.log(p) == pytest.approx(want[i], rel=1e-6)


def test_languages_on_held_out_and_odd_rows(documents, odd, nothing):
    model = languages.fit(languages.training_rows(documents))
    rows = languages.labelled(documents, model, carry=["doc_id", "lang"]).select("row.*", "lang_pred", "score").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    got = languages.labelled(odd, model, carry=odd.columns).collect()
    assert len(got) == odd.count() and got[0].row.asDict().keys() == set(odd.columns)
    und = {r.row.doc_id for r in got if r.lang_pred == "und"}
    assert und == {1, 2, 3, 8} and all((r.score == 0) == (r.lang_pred == "und") and 0 <= r.score <= 1 for r in got)
    assert languages.labelled(nothing, model).count() == 0
    none = languages.fit(languages.training_rows(nothing))
    assert {r.lang_pred for r in languages.labelled(odd, none).collect()} == {"und"}


def test_mixed_text_has_spans(spark):
    en, ru = "the cat sat on the mat and looked at the moon", "кошка сидела на окне и смотрела на луну"
    train = spark.createDataFrame([(i, t, lang) for i in range(8) for t, lang in ((en, "en"), (ru, "ru"))], "doc_id long, text string, lang string")
    r = languages.labelled(spark.createDataFrame([(1, f"{en} {ru}")], "doc_id long, text string"), languages.fit(train)).first()
    assert [(s[0], s[1], s[2]) for s in r.spans] == [(0, 11, "en"), (11, 19, "ru")]


def test_best_paths_are_best():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = rng.integers(0, 6, 5)
        score, first = rng.normal(size=(n.sum(), 3)).astype("f4") * 3, np.cumsum(n) - n
        label = languages.best_paths(score, first, n, 2.0)
        for a, k in zip(first, n, strict=True):
            def value(path, a=a):
                return sum(score[a + i, x] for i, x in enumerate(path)) - 2 * sum(x != y for x, y in itertools.pairwise(path))
            if k:
                assert value(label[a : a + k]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=int(k)))), abs=1e-4)


def test_classifier_ranks_held_out_rows(spark, sf, odd, nothing):
    base = sf.replace("sf0.001", "sf0.01")
    features = classifier.measured(spark.read.parquet(f"{base}/documents.parquet"))
    labels = spark.read.parquet(f"{base}/labels.parquet")
    model = classifier.fit_sample(features, labels.where(~classifier.held_out(labels["doc_id"])))
    got = {r.doc_id: r.score for r in classifier.scored(features, model).collect()}
    held = [(got[r.doc_id], r.quality) for r in labels.where(classifier.held_out(labels["doc_id"])).collect() if r.quality is not None]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    scores = [r.score for r in classifier.scored(classifier.measured(odd), model).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert classifier.scored(classifier.measured(nothing), model).count() == 0
    unlabelled = classifier.fit_sample(classifier.measured(odd), labels.where("false"))
    assert {r.score for r in classifier.scored(classifier.measured(odd), unlabelled).collect()} == {0.5}


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = classifier.fit(x, y, rounds=30, pairs=2, pair_rounds=60)
    assert (0, 1) in [(i, j) for i, j, _ in model.pairs]
    assert ((model.score(x) > 0.5) == y).mean() > 0.97


def plain_groups(rows, width=3, pct=85):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(low))
        sets[i] = frozenset(zip(*(w[k:] for k in range(width)), strict=False)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates_match_brute_force(spark, documents, odd, nothing, monkeypatch):
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in rng.integers(0, 5000, 300)]
    made = []
    for i in range(40):  # a family whose members are near their neighbours, not all near each other
        words = list(base)
        for at in range(7 * i, 7 * i + 7):
            words[at % 300] = f"x{i}y{at}"
        base = words if i % 2 else base
        made.append((10_000 + i, " ".join(words)))
    shared = " ".join(f"p{i}" for i in range(200))  # a passage common to texts that are not near
    made += [(20_000 + i, shared + " " + " ".join(f"q{i}r{j}" for j in range(60 + i))) for i in range(40)]
    rows = [(r.doc_id, r.text) for r in documents.collect()] + made + [(r.doc_id + 30_000, r.text) for r in odd.where("doc_id is not null and doc_id <> 9").collect()]
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "PARTNERS", 8)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == plain_groups(rows)
    assert neardup.near_duplicates(odd).count() == odd.count()
    assert neardup.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_sketches_of_near_pairs_pass(similarity):
    bands, rows = neardup.layout(similarity)
    assert (1 - similarity**rows) ** bands <= 3e-6
    rng = np.random.default_rng(17)
    most, lost = neardup.most_bits(similarity, bands * rows), 0
    for _ in range(40):  # 200,000 pairs at the similarity
        flips = 2 * rng.binomial(bands * rows, 1 - similarity, 5000)
        pair = np.repeat(np.arange(5000), flips)
        odd = np.bincount(pair * neardup.SKETCH_BITS + rng.integers(0, neardup.SKETCH_BITS, len(pair)), minlength=5000 * neardup.SKETCH_BITS) & 1
        lost += int((odd.reshape(5000, -1).sum(axis=1) > most).sum())
    assert lost <= 5


def test_block_pairs_find_every_near_pair(spark, monkeypatch):
    rng = np.random.default_rng(2)
    sketch = rng.integers(-(1 << 62), 1 << 62, (700, neardup.WORDS64))
    sketch[1::2] = sketch[::2]
    sketches = spark.createDataFrame([(i, 100 - 30 * (i // 2 % 3 == 0) * (i % 2), s.tolist(), [(5 if i // 2 % 5 == 0 else i) - (9 << 40), 7]) for i, s in enumerate(sketch)],
                                     "id long, n long, sketch array<long>, bands array<long>")
    entries = spark.createDataFrame([(7, 1, i, i) for i in range(700)], "bucket long, band int, id long, component long")
    short = [np.arange(100, dtype=np.uint32) + 50 * (i // 2 % 7 == 0) * (i % 2) for i in range(700)]
    sets = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(short)], "id long, short binary")
    near = lambda i: i // 2 % 3 and i // 2 % 5 and i // 2 % 7  # noqa: E731 the others differ in size or in their sets, or share an earlier band
    for block in (1024, 90):
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = {(r.a, r.b) for r in neardup._block_pairs(entries, neardup._open(entries), sketches, sets, 100, 85).collect()}
        assert got == {(i, i + 1) for i in range(0, 700, 2) if near(i)}
    joined = entries.withColumn("component", F.when(F.col("id") < 600, 0).otherwise(F.col("id")))
    got = {(r.a, r.b) for r in neardup._block_pairs(joined, neardup._open(joined), sketches, sets, 100, 85).collect()}
    assert got == {(i, i + 1) for i in range(600, 700, 2) if near(i)}


def test_a_pivot_meets_only_members_outside_the_largest_component(spark):
    rows = [(bucket, i, 0 if i < 50 else i) for bucket in range(40) for i in (*range(50), 90, 91)]
    entries = spark.createDataFrame([*rows, (99, 1, 0), (99, 2, 0)], "bucket long, id long, component long")
    heads = neardup._open(entries, 1)
    assert {(r.main, r.size, r.outside) for r in heads.collect()} == {(0, 52, 2)} and heads.count() == 40
    pairs = {(r.a, r.b) for r in neardup._pivot_pairs(entries, heads).collect()}
    assert pairs and all(a < 50 and b in (90, 91) for a, b in pairs) and {b for _, b in pairs} == {90, 91}


def test_settled_buckets_are_not_copied(spark, documents, monkeypatch):
    plans = []
    seen = neardup.cut
    monkeypatch.setattr(neardup, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or seen(df))
    neardup.near_duplicates(documents)
    assert not [p for p in plans if "LeftSemi, (bucket" in p]


def test_short_hashes_hide_no_shared_shingle():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n, m, both = rng.integers(1, 60, 3)
        both = min(n, m, both)
        a, b = np.unique(rng.integers(0, 40, n)).astype(np.uint32), None
        full = rng.permutation(400)[: n + m - both]
        left, right = full[:n], full[n - both :]
        a, b = np.unique(left % 40).astype(np.uint32), np.unique(right % 40).astype(np.uint32)
        if 100 * both >= 85 * (n + m - both):
            assert neardup._may_share(a, b, n, m, 85)


def test_units_encode_like_the_library(documents):
    path = tokens.default_tokenizer()
    plain = Tokenizer.from_file(path)
    texts = ODD_TEXTS + [r.text for r in documents.collect()]
    for some in (texts, texts[::-1]):
        for text, ids in zip(some, tokens.encoded(some, path), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text[:60]


def test_long_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(tokens, "PART_CHARS", 40)
    encoder = tokens.load(tokens.default_tokenizer())
    text = "some  words here, " * 30 + "x" * 100 + "  tail end"
    assert np.frombuffer(encoder.whole(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.parts(text)) > 5


def test_grammar_files_round_trip(spark, odd, documents, nothing):
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    for docs, size in ((documents, 20_000), (odd, tokenfiles.SHARD_TOKENS)):
        folder = tokenfiles.write(docs, shard_tokens=size)
        rows = sorted(((r.start, r.n_tokens, r.doc_id, r.ids_crc32) for r in tokenfiles.decode(spark, folder).collect()), key=lambda r: r[0])
        want, at = [], 0
        for d in sorted(docs.collect(), key=lambda d: (d.doc_id is not None, d.doc_id or 0)):
            ids = np.array(plain.encode(d.text or "", add_special_tokens=False).ids + [0], "<u4")
            want.append((at, len(ids), d.doc_id, zlib.crc32(ids.tobytes())))
            at += len(ids)
        assert rows == want
        for row in spark.read.schema(tokenfiles.SCHEMA).parquet(folder).limit(3).collect():
            row = row.asDict()
            text = docs.where(f"doc_id = {row['doc_ids'][-1]}").first().text
            ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
            assert tokenfiles.tokens_between(row, row["n_docs"] - 1, 1, 9).tolist() == ids[1:9]
    assert tokenfiles.decode(spark, tokenfiles.write(nothing)).count() == 0


def test_later_rounds_look_only_at_what_may_have_changed(monkeypatch):
    rng = np.random.default_rng(4)
    tokens_ = np.concatenate([np.tile(np.arange(40, dtype=np.uint32), 300), rng.integers(0, 60_000, 40_000).astype(np.uint32)])
    looked, plain = [], tokenfiles.frequent_pairs
    monkeypatch.setattr(tokenfiles, "frequent_pairs", lambda key, *rest: looked.append(len(key)) or plain(key, *rest))
    made = tokenfiles.compress(tokens_, np.array([len(tokens_)]))
    assert (tokenfiles.expand(made["symbols"], made["rules"]) == tokens_).all() and made["lengths"].max() >= 40
    assert looked[0] == len(tokens_) - 1 and max(looked[1:]) < 20_000  # single places of the random part are not counted again


def test_compression_replaces_what_repeats():
    tokens_ = np.array([5, 6, 7, 5, 6, 7, 9] * 500 + [0], np.uint32)
    made = tokenfiles.compress(tokens_, np.array([1750, len(tokens_)]))
    assert len(made["symbols"]) < len(tokens_) / 6 and tokenfiles.expand(made["symbols"], made["rules"]).tolist() == tokens_.tolist()
    wide = (np.arange(200_000, dtype=np.uint32) % 90_000)
    made = tokenfiles.compress(wide, np.array([200_000]))
    assert tokenfiles.expand(made["symbols"], made["rules"]).tolist() == wide.tolist()


def test_every_pair_that_saves_is_replaced():
    rng = np.random.default_rng(8)
    tokens_ = rng.integers(0, 3000, 60_000).astype(np.uint32)
    tokens_[1000::7000], tokens_[1001::7000] = 5000, 5001  # nine places of 60,000
    made = tokenfiles.compress(tokens_, np.array([30_000, 60_000]))
    s, ends = made["symbols"], made["doc_symbol"][1:-1]
    pairs = np.delete(np.stack([s[:-1], s[1:]], 1), ends - 1, 0)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    assert [5000, 5001] in made["rules"].tolist() and np.unique(pairs, axis=0, return_counts=True)[1].max() < tokenfiles.LEAST_COUNT
    assert tokenfiles.expand(s, made["rules"]).tolist() == tokens_.tolist()


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(4)
    for _ in range(30):
        sizes = rng.integers(1, 60, rng.integers(1, 80))
        kinds = packing.best_fit(np.bincount(sizes, minlength=101), 100)
        bins = [tuple(sorted(s for s, _, _ in parts)) for many, parts in kinds for _ in range(many)]
        plain: list[list[int]] = []
        for s in sorted(sizes.tolist(), reverse=True):
            fit = [b for b in plain if sum(b) + s <= 100]
            max(fit, key=sum).append(s) if fit else plain.append([s])
        assert sorted(sum(bins, ())) == sorted(sizes.tolist()) and len(bins) == len(plain)


def test_packing_places_every_piece(spark, documents, odd, nothing):
    for docs, fan, loss in ((documents.repartition(9), 2, 0.06), (documents, 64, 0.01), (odd, 64, 0.01)):
        rows = packing.pack(docs, fan=fan).toPandas()
        assert rows.groupby("sequence_id")["length"].sum().max() <= packing.CAPACITY
        rows = rows.sort_values(["sequence_id", "offset"])
        assert (rows.groupby("sequence_id")["length"].cumsum() - rows["length"] == rows["offset"]).all()
        n = Tokenizer.from_file(tokens.default_tokenizer()).encode_batch([r.text or "" for r in docs.collect()], add_special_tokens=False)
        total = sum(len(e.ids) + 1 for e in n)
        assert rows["length"].sum() == total
        assert rows["sequence_id"].nunique() <= (1 + loss) * total / packing.CAPACITY + 2
    assert packing.pack(nothing).count() == 0
