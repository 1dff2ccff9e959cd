"""Cross-tokenizer alignment against a plain computation."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tallywright.llm import alignment, blocks

A, B = alignment.default_tokenizers()


def plain(rows):
    """doc_id -> contract columns, token by token."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    left, right = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    import base64
    ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    made, holders = [], Counter()
    for doc_id, text in rows:
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        of_b = [bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, right.id_to_piece(i)) for i in b)]
        of_a = [ranks[i] for i in a]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(of_a) != raw or b"".join(of_b) != raw:
            made.append((doc_id, None))
            continue
        ends_a, ends_b = np.cumsum([len(t) for t in of_a]).tolist(), np.cumsum([len(t) for t in of_b]).tolist()
        links, j = [], 0
        for i, e in enumerate(ends_a):
            begin = e - len(of_a[i])
            while ends_b[j] <= begin:
                j += 1
            k = j
            while k < len(b) and ends_b[k] - len(of_b[k]) < e:
                links.append((a[i], b[k]))
                k += 1
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, x, y = [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while x < len(a) and ends_a[x] <= c:
                ga.append(a[x])
                x += 1
            while y < len(b) and ends_b[y] <= c:
                gb.append(b[y])
                y += 1
            groups.append((ga, gb))
        made.append((doc_id, (a, b, groups, links)))
        holders.update(set(links))
    best = defaultdict(int)
    for (x, _), c in holders.items():
        best[x] = max(best[x], c)
    out = []
    for doc_id, m in made:
        if m is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = m
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(holders[p] == best[p[0]] for p in links), sum(holders[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


HARD = [(1, "Hello  world\n\nnew\tline"), (2, "<|endoftext|> and </s> <s> <unk> <0x41>"), (3, "ein▁strich"), (4, "日本語のテキスト и русский"), (5, ""), (6, None), (7, " lead and trail "),
        (8, "\r\n);\r\n"), (9, "a\x00b\x01 ﬁ é \U0001f600\U0001f468‍\U0001f469"), (10, " "), (10, "Hello  world\n\nnew\tline"), (None, "no id"), (11, "x" * 3000), (12, "é" * 2000 + " end"),
        (13, "word " * 4000)]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_matches_plain(spark, documents, small, monkeypatch):
    rows = HARD + [(r.doc_id, r.text) for r in documents.limit(150).collect()]
    if small:  # many blocks and ranges, short lanes
        monkeypatch.setattr(alignment, "BLOCK_GROUPS", 3000)
        monkeypatch.setattr(blocks, "RANGE_KEYS", 500)
    got = alignment.alignment(spark.createDataFrame(rows, "doc_id long, text string"), A, B)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(plain(rows), key=str)


def test_lockstep_enters_long_documents_at_common_ends(monkeypatch):
    monkeypatch.setattr(alignment, "LANE_TOKENS", 7)
    monkeypatch.setattr(alignment, "LANE_SEARCH", 3)
    rng = np.random.default_rng(2)
    whole = [np.unique(np.append(rng.integers(1, 400, 150), 400)) for _ in range(8)]
    ends_a = np.concatenate([w + 400 * i for i, w in enumerate(whole[:4])])
    ends_b = np.concatenate([w + 400 * i for i, w in enumerate(whole[4:])])
    last = np.searchsorted(ends_a, 400 * np.arange(1, 5))
    la, lb, ca, cb = alignment.lockstep(ends_a, ends_b, last)
    begin = lambda ends: np.append(0, ends[:-1])
    want = [(i, j) for i in range(len(ends_a)) for j in range(len(ends_b)) if begin(ends_a)[i] < ends_b[j] and begin(ends_b)[j] < ends_a[i]]
    assert sorted(zip(la.tolist(), lb.tolist(), strict=True)) == want
    assert sorted(ends_a[ca].tolist()) == sorted(ends_b[cb].tolist()) == np.intersect1d(ends_a, ends_b).tolist()


def test_groups_spell_their_bytes(spark, odd, nothing):
    texts = {i: t for i, t in HARD if t and i not in (3, 10, None)}
    rows = alignment.aligned_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), A, B).orderBy("doc_id", "group").collect()
    left, right = alignment.side(A), alignment.side(B)
    for r in rows:
        raw = (" " + texts[r.doc_id]).encode()[r.start : r.stop]
        assert left.spelled(r.a_ids) == raw == right.spelled(r.b_ids)
    assert {r.doc_id for r in rows} == set(texts)
    assert alignment.alignment(odd, A, B).count() == odd.count()
    assert alignment.alignment(nothing, A, B).count() == 0 == alignment.aligned_groups(nothing, A, B).count()
