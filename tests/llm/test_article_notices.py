"""What the arrays say of the articles of a host: notices without a mark, quotations, versions of one text."""

from __future__ import annotations

import numpy as np
import pytest

from rallymart.llm import extract

SCHEMA = "page_id long, url string, html string"
NOTICE = "all of our readers may write to the editor of this paper on any day"


def _story(number: int, words: int = 40) -> str:
    return " ".join(f"s{number}w{j}" for j in range(words))


def _texts(spark, rows, partitions=3):
    pages = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return {r.page_id: r.text for r in extract.main_texts(pages).collect()}


def _page(*blocks: str) -> str:
    return f"<nav>m</nav><article>{''.join(f'<p>{b}</p>' for b in blocks)}</article>"


@pytest.mark.parametrize("partitions", [1, 7, 30])
@pytest.mark.parametrize("tokens", [1, 2**19])
def test_a_notice_in_most_articles_goes(spark, partitions, tokens, monkeypatch):
    monkeypatch.setattr(extract, "ARRAY_TOKENS", tokens)
    rows = [(i, "http://a.b/x", _page(_story(i), NOTICE) if i % 3 else _page(_story(i))) for i in range(24)]
    # Another host says it once, and there it stays.
    rows.append((99, "http://c.d/x", _page(_story(99), NOTICE)))
    expected = {i: _story(i) for i in range(24)} | {99: f"{_story(99)} {NOTICE}"}
    assert _texts(spark, rows, partitions) == expected


def test_what_half_of_the_articles_share_stays(spark):
    rows = [(i, "http://a.b/x", _page(_story(i), NOTICE) if i % 2 else _page(_story(i))) for i in range(24)]
    expected = {i: f"{_story(i)} {NOTICE}" if i % 2 else _story(i) for i in range(24)}
    assert _texts(spark, rows) == expected


def test_few_articles_and_copies_of_pages_make_no_notice(spark):
    rows = [(i, "http://a.b/x", _page(_story(i), NOTICE)) for i in range(extract.NOTICE_ON - 1)]
    copies = [(100 + i, *rows[0][1:]) for i in range(30)]
    expected = {i: f"{_story(i)} {NOTICE}" for i in range(len(rows))}
    assert _texts(spark, rows + copies) == expected | {100 + i: expected[0] for i in range(30)}


def test_versions_of_one_text_stay_whole(spark):
    rows = [(i, "http://a.b/x", _page(_story(0), f"version {i}")) for i in range(20)]
    assert _texts(spark, rows) == {i: f"{_story(0)} version {i}" for i in range(20)}


def test_a_block_with_words_of_its_own_stays(spark):
    rows = [(i, "http://a.b/x", _page(_story(i, 90), f"{NOTICE} number{i} {NOTICE}")) for i in range(20)]
    assert _texts(spark, rows) == {i: f"{_story(i, 90)} {NOTICE} number{i} {NOTICE}" for i in range(20)}


def test_headings_below_a_run_stay(spark):
    rows = [(i, "http://a.b/x", _page("what we know so far", _story(i))) for i in range(20)]
    assert _texts(spark, rows) == {i: f"what we know so far {_story(i)}" for i in range(20)}


def test_sparse_runs_cover_a_block():
    for size in range(extract.RUN, 60):
        starts = extract.sparse_starts(size)
        assert len(set(starts.tolist())) == len(starts)
        assert {s + i for s in starts.tolist() for i in range(extract.RUN)} == set(range(size))


def test_sparse_arrays_count_as_a_dictionary_does():
    blocks = [_story(i % 4, 8 + i % 5 * 7).split(" ") for i in range(30)]
    pages = [("/ab"[: 1 + i % 2 * 2], [blocks[i], blocks[-1 - i]]) for i in range(30)]
    holders = {}
    for number, (space, parts) in enumerate(pages):
        for tokens in parts:
            for at in extract.sparse_starts(len(tokens)):
                holders.setdefault((space, *tokens[at : at + extract.RUN]), set()).add(number)
    names, counts, owner = extract.owned_runs(pages, sparse=True)
    assert sorted(counts.tolist()) == sorted(len(h) for h in holders.values())
    known = {int(extract.run_names(list(run), space, {})[0]): h for (space, *run), h in holders.items()}
    assert all(o in known[n] for n, o in zip(names.tolist(), owner.tolist(), strict=True))
    assert isinstance(owner, np.ndarray)
