"""Runs that the pages of a host share, however the pages are dealt to tasks."""

from __future__ import annotations

import random

import numpy as np
import pytest

from rallymart.llm import extract

SCHEMA = "page_id long, url string, html string"


def _texts(spark, rows, partitions):
    pages = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return sorted(tuple(r) for r in extract.main_texts(pages).select("page_id", "text").collect())


def _expected(rows):
    """Brute force: a token goes if it lies in eight tokens that three different pages of its host hold."""
    cut = [(p, (u or "").split("/")[2] if u else "", extract.blocks(h or "")) for p, u, h in rows]
    holders = {}
    for number, (_, host, page) in enumerate(cut):
        whole = next(i for i, other in enumerate(cut) if other[1:] == (host, page))
        tokens = [t for block, _ in page for t in block.split(" ")]
        for i in range(len(tokens) - extract.RUN + 1):
            holders.setdefault((host, tuple(tokens[i : i + extract.RUN])), set()).add(whole)
    out = []
    for page_id, host, page in cut:
        tokens = [t for block, _ in page for t in block.split(" ")]
        gone = set()
        for i in range(len(tokens) - extract.RUN + 1):
            if len(holders[host, tuple(tokens[i : i + extract.RUN])]) >= extract.SHARED_BY:
                gone.update(range(i, i + extract.RUN))
        out.append((page_id, " ".join(t for i, t in enumerate(tokens) if i not in gone)))
    return sorted(out)


@pytest.fixture(scope="module")
def unmarked():
    """Pages that mark no article: one large host, one small, passages on two, three and many pages."""
    draw = random.Random(5)
    passages = [" ".join(f"p{i}w{j}" for j in range(draw.randint(8, 30))) for i in range(6)]
    rows = []
    for number in range(160):
        host = "big.example" if number < 140 else "small.example"
        parts = [" ".join(f"x{draw.randrange(50)}" for _ in range(draw.randint(1, 12))) for _ in range(4)]
        for i, passage in enumerate(passages):
            if number % (2, 5, 40, 53, 70, 7)[i] == 0:
                parts.insert(draw.randrange(len(parts)), passage)
        rows.append((number, f"http://{host}/{number}", "".join(f"<p>{p}</p>" for p in parts)))
    return rows + rows[:30] + [(500 + i, rows[2][1], rows[2][2]) for i in range(5)]


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_the_same_runs_however_pages_are_dealt(spark, unmarked, partitions):
    assert _texts(spark, unmarked, partitions) == _expected(unmarked)


@pytest.mark.parametrize("tokens", [1, 100])
def test_the_same_runs_in_small_arrays(spark, unmarked, tokens, monkeypatch):
    monkeypatch.setattr(extract, "ARRAY_TOKENS", tokens)
    assert _texts(spark, unmarked, 3) == _expected(unmarked)


def test_a_notice_on_few_pages_of_a_large_host(spark):
    notice = "our office is closed on the first of may"
    rows = [(i, "http://a.b/", f"<p>story{i} told{i}</p>" + (f"<p>{notice}</p>" if i % 100 == 0 else "")) for i in range(500)]
    assert _texts(spark, rows, 9) == [(i, f"story{i} told{i}") for i in range(500)]


def test_furniture_of_marked_pages_counts_and_their_articles_do_not(spark):
    menu, quote = ("to the start page the news the weather map", "a sentence of at least eight words is quoted")
    rows = [(i, "http://a.b/", f"<nav>{menu}</nav><article>{quote} by{i}</article>") for i in range(4)]
    rows.append((9, "http://a.b/", f"<div>{menu}</div><p>they wrote: {quote}</p>"))
    found = dict(_texts(spark, rows, 3))
    assert found == {i: f"{quote} by{i}" for i in range(4)} | {9: f"they wrote: {quote}"}


def test_copies_count_as_one_page_and_null_ids_do_not_meet(spark):
    text = "all of these words are on every copy of it"
    rows = [(None if i % 2 else i, None, f"<p>{text}</p>") for i in range(8)]
    assert {t for _, t in extract.main_texts(spark.createDataFrame(rows, SCHEMA)).select("page_id", "text").collect()} == {text}
    rows = [(None, None, f"<p>{text}</p><p>own{i}</p>") for i in range(4)]
    found = sorted(r.text for r in extract.main_texts(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == [f"own{i}" for i in range(4)]


def test_counted_runs_by_brute_force():
    draw = random.Random(3)
    pages = [(draw.choice("ab"), [[draw.choice("xy") for _ in range(draw.randint(0, 30))] for _ in range(2)]) for _ in range(40)]
    holders = {}
    for number, (host, parts) in enumerate(pages):
        for tokens in parts:
            names = extract.run_names(tokens, host, {}) if len(tokens) >= extract.RUN else []
            for name in np.array(names).tolist():
                holders.setdefault(name, set()).add(number)
    names, counts = extract.counted_runs(pages)
    assert dict(zip(names.tolist(), counts.tolist(), strict=True)) == {n: len(h) for n, h in holders.items()}
    assert len(set(names.tolist())) == len(names)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article data-x='{'v' * 9000}'>x y</article><p>z</p>", "x y"),
        (f"<nav title=\"{'v > ' * 4000}\">m</nav><article>x</article>", "x"),
        (f"<article>a<p title=\"{'>' * 20000}\">b</p></article>", "a b"),
        ("<article>a<p class=it's>b</p><p class=it's>c</p></article>", "a b c"),
        ("<article>a<b title = '>'>b</b></article>", "ab"),
    ],
)
def test_attributes_of_any_length(page, text):
    assert " ".join(b for b, z in extract.blocks(page) if z == extract.ARTICLE) == text
