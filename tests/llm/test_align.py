"""Alignment against shared ends found by set intersection."""

from __future__ import annotations

import bisect
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rallymart.llm import align, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models():
    return align.ByteLevel(queries.BYTES), align.Pieces(queries.PIECES)


@pytest.fixture
def tokenizers(models):
    return align.Tokenizers(*models)


@pytest.mark.parametrize("steps", [1, align.STEPS])
def test_cuts_are_all_shared_ends(monkeypatch, steps):
    monkeypatch.setattr(align, "STEPS", steps)
    r = random.Random(2)
    for _ in range(300):
        size = r.randint(1, 200)
        a, b = (np.array(sorted({*r.sample(range(1, size + 1), r.randint(0, size)), size})) for _ in "ab")
        shared = sorted({*a.tolist()} & {*b.tolist()})
        stops = np.array(sorted({*r.sample(shared, r.randint(0, len(shared))), size}))
        got_a, got_b = align.shared_cuts(a, b, stops)
        assert got_a.tolist() == [bisect.bisect(a.tolist(), x) for x in shared]
        assert got_b.tolist() == [bisect.bisect(b.tolist(), x) for x in shared]
    none = np.zeros(0, "int64")
    assert [x.tolist() for x in align.shared_cuts(none, none, none)] == [[], []]


def test_long_interval_without_cuts():
    a, b = np.arange(2, 100_001, 2), np.append(np.arange(1, 100_000, 2), 100_000)
    got = align.shared_cuts(a, b, a[-1:])
    assert [x.tolist() for x in got] == [[50_000], [50_001]]


@pytest.mark.parametrize("most", [align.MOST_REMEMBERED, 20])
def test_chunks_change_no_ids(models, tokenizers, monkeypatch, most):
    monkeypatch.setattr(align, "MOST_REMEMBERED", most)
    r = random.Random(6)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", ".", ",", "!", "'s", "7", "é", "\x1c", "\x85", "\xa0", "　", "漢", "🙂", "<|endoftext|>", "_", "▁"]
    said = ["".join(r.choices(parts, k=r.randint(0, 12))) for _ in range(6000)]
    for at in range(0, len(said), 500):
        made = tokenizers.encode(said[at : at + 500])
        for text, ids in zip(said[at : at + 500], made, strict=True):
            assert tuple(x.tolist() for x in ids) == _tokens(text, models)
    tokenizers.both[1].separable = False
    try:
        assert [x.tolist() for x in tokenizers.encode(["a b"])[0]] == list(_tokens("a b", models))
    finally:
        tokenizers.both[1].separable = True


class _Counting:
    """A model that notes what it is asked to encode."""

    def __init__(self, model):
        self.model, self.asked = model, []

    def __getattr__(self, name):
        return getattr(self.model, name)

    def encode(self, chunks):
        self.asked += chunks
        return self.model.encode(chunks)


def test_new_chunks_are_encoded_together(models):
    """Many chunks make one text to encode, with one that is not spelt and one that ends in white space too."""
    both = [_Counting(m) for m in models]
    tokenizers = align.Tokenizers(*both)
    said = [" ".join(f"{x}{i}y" for i in range(500)) for x in "abcdefgh"]
    for texts in (said, said[::-1], ["new a ▁b words", "an end\t", *said]):
        for text, ids in zip(texts, tokenizers.encode(texts), strict=True):
            assert tuple(x.tolist() for x in ids) == _tokens(text, models)
    assert all(len(m.asked) < 20 for m in both)


def test_frequent_chunks_stay_known(models, monkeypatch):
    monkeypatch.setattr(align, "MOST_REMEMBERED", 40)
    both = [_Counting(m) for m in models]
    tokenizers = align.Tokenizers(*both)
    for i in range(30):
        tokenizers.encode(["often often"] + [f"rare{i}x{j}" for j in range(30)])
    assert all(sum("often" in text for text in m.asked) == 1 for m in both)
    assert len(tokenizers.known) <= 40 + 31


def test_long_chunks_are_not_remembered(models, tokenizers):
    long = "x" * (align.LONG_CHUNK + 1)
    said = [f"one {long} two", f"two{long} three", "three one"]
    for _ in range(2):
        for text, ids in zip(said, tokenizers.encode(said), strict=True):
            assert tuple(x.tolist() for x in ids) == _tokens(text, models)
    assert list(tokenizers.known.items()) == [(" one", 0), (" two", 1), (" three", 2)]
    assert [len(x) for x in tokenizers.ids] == [starts[-1] for starts in tokenizers.starts]


def _tokens(text: str | None, models) -> tuple[list[int], list[int]]:
    """By the libraries themselves; none if they do not spell the text."""
    whole = Tokenizer.from_file(queries.BYTES) if not hasattr(_tokens, "a") else _tokens.a
    whole.encode_special_tokens = True
    _tokens.a = whole
    if not hasattr(_tokens, "b"):
        _tokens.b = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    if not text:
        return [], []
    a, b = whole.encode(" " + text, add_special_tokens=False).ids, _tokens.b.encode(text)
    spelt = [b"".join(m.bytes[i] for i in ids) for m, ids in zip(models, (a, b), strict=True)]
    return (a, b) if spelt == [(" " + text).encode()] * 2 else ([], [])


def _groups(a, b, models):
    ends = [np.cumsum([len(m.bytes[i]) for i in ids]).tolist() for m, ids in zip(models, (a, b), strict=True)]
    x = y = 0
    for end in sorted({*ends[0]} & {*ends[1]}):
        i, j = bisect.bisect(ends[0], end), bisect.bisect(ends[1], end)
        yield a[x:i], b[y:j]
        x, y = i, j


def _expected(rows, models):
    docs, count = [], Counter()
    for r in rows:
        a, b = _tokens(r.text, models)
        groups = list(_groups(a, b, models))
        links = Counter((i, j) for x, y in groups for i in x for j in y)
        count.update(links.keys())
        docs.append((r.doc_id, a, b, groups, links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    for doc_id, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_best = sum(n for p, n in links.items() if count[p] == best[p[0]])
        total = sum(n * count[p] for p, n in links.items())
        yield doc_id, len(a), len(b), len(groups), links.total(), n_best, total, digest


def _as_told(result):
    names = align.SUMMARY.replace(" long", "").replace(" string", "").split(", ")
    return Counter(tuple(r[n] for n in names) for r in result.collect())


def test_all_documents(spark, models):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    expected = Counter(_expected(rows, models))
    assert _as_told(queries.op11_bisected_alignment(spark, SF_DIR)) == expected


@pytest.mark.parametrize("block_bytes", [align.BLOCK_BYTES, 100])
def test_odd_documents(spark, models, odd_docs, block_bytes):
    more = ["▁", "a ▁b", "<s> <0x41> <|endoftext|> </s>", "abab" * 300, "  \t", "\x00q", "漢字 ｶﾅ ﬁ", "x\x1c!\x1c", " lead", "ÿ" * 700]
    docs = odd_docs.select("doc_id", "text", "part").union(spark.createDataFrame([(100 + i, t, 1) for i, t in enumerate(more)], "a long, b string, c int"))
    expected = Counter(_expected(docs.collect(), models))
    assert _as_told(align.alignment(docs, queries.BYTES, queries.PIECES, block_bytes)) == expected
    assert any(e[1] == 0 for e in expected)


def test_links_within_large_groups(spark, models, monkeypatch):
    """Every group counts as large, so its ids are reduced before they are paired."""
    block, plain = align.Block(60_000), align.Block(60_000)
    said = ["abab" * 50 + " unbelievably odd é漢字", "abab abc"]
    plain.add([1, 2], said, align.Aligned(said, align.Tokenizers(*models)))
    whole = plain.row(0)
    monkeypatch.setattr(align, "LARGE_GROUP", 0)
    block.add([1, 2], said, align.Aligned(said, align.Tokenizers(*models)))
    assert str(block.row(0)) == str(whole)


def test_groups_and_counts(spark, models, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        expected, count = Counter(), Counter()
        for r in docs.collect():
            a, b = _tokens(r.text, models)
            groups = list(_groups(a, b, models))
            ends = [np.cumsum([len(g[k]) for g in groups], dtype=int).tolist() for k in (0, 1)]
            expected[r.doc_id, tuple(a), tuple(b), tuple(ends[0]), tuple(ends[1])] += 1
            count.update({(i, j) for x, y in groups for i in x for j in y})
        rows = align.align(docs, queries.BYTES, queries.PIECES).collect()
        assert Counter((r.doc_id, tuple(r.a), tuple(r.b), tuple(r.a_ends), tuple(r.b_ends)) for r in rows) == expected
        counted = align.link_counts(docs, queries.BYTES, queries.PIECES).collect()
        assert {(r.a, r.b): r.documents for r in counted} == dict(count)
    assert align.alignment(no_docs, queries.BYTES, queries.PIECES).count() == 0
