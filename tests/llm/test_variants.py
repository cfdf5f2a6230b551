"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rallymart.llm import queries, variants

SF_DIR = "/root/testdata/sf0.001"


def _near(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def _words(rows) -> dict[str, int]:
    counts = Counter()
    for r in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def _expected(n: dict[str, int]):
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    forms, near = {}, {}
    for w in n:
        near[w] = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, ()) if _near(w, v)]
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= 10 * n[w] else None
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        yield w, forms[w], root, n[w], len(near[w]), None if forms[w] is None else n[forms[w]]


def _as_told(result):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in result.collect())


def test_all_words_of_the_documents(spark):
    n = _words(spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    expected = Counter(_expected(n))
    assert _as_told(queries.op13_sorted_list_edits(spark, SF_DIR)) == expected
    assert sum(e[4] > 0 for e in expected) > 5 and any(e[1] for e in expected)


@pytest.fixture
def crowded(spark):
    """Few letters, so that most words have near ones; chains of forms, ties, and odd rows."""
    r = random.Random(3)
    words = ["".join(r.choices("abÿÀ×", k=r.randint(6, 10))) for _ in range(600)]
    words += ["Abcdefgh"] * 900 + ["abcdefgx"] * 80 + ["abcdefxx"] * 7 + ["abcdefyy"] * 7 + ["abcdeyyy"]
    words += ["z" * 3000, "z" * 3000, "z" * 3001, "z" * 3001]
    r.shuffle(words)
    rows = [(i % 90 if i % 7 else None, " ".join(words[i : i + 9]), "w", 1) for i in range(0, len(words), 3)]
    rows += [(1, None, "w", 1), (2, "", "w", 1), (None, None, None, None), rows[0], rows[0]]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n int")


@pytest.mark.parametrize("most", [variants.MOST_IN_LIST, 5])
def test_crowded_lists(crowded, most):
    expected = Counter(_expected(_words(crowded.collect())))
    assert _as_told(variants.group_variants(crowded, most)) == expected
    assert any(root not in (word, form) for word, form, root, *_ in expected)


def test_runs_are_whole_and_only_ascii_is_lowered(spark):
    docs = spark.createDataFrame([(1, "ÀBCDEFGH1abcdefgÄ_short éÉÿÀ×÷ßx")], "doc_id long, text string")
    kept = docs.select("doc_id", "text")
    assert sorted(r.word for r in variants.occurrences(kept).collect()) == sorted(["Àbcdefgh", "abcdefgÄ", "éÉÿÀ×÷ßx"])


def test_no_documents(spark, no_docs, odd_docs):
    assert variants.group_variants(no_docs).count() == 0
    assert _as_told(variants.group_variants(odd_docs)) == Counter(_expected(_words(odd_docs.collect())))
    assert variants.near_words(spark.range(0).select(F.lit("w").alias("word"), "id", F.col("id").alias("n"))).count() == 0
