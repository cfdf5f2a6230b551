"""The pipeline against a brute-force version, and each stage on odd tables."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from rallymart.llm import language, packing, pii, queries, simhash

SF_DIR = "/root/testdata/sf0.001"


def test_run_equals_the_steps_by_hand(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model, made = language.learn(docs), pii.Surrogates(pii.key_of(spark))
    kept = {r.doc_id: r for r in docs.collect() if not model.classify(r.text or "")[2]}
    prints = {d: simhash.fingerprint(r.text or "") for d, r in kept.items()}
    first: list[int] = []
    groups: dict[int, int] = {}
    for d in sorted(prints):
        near = {groups[o] for o in groups if (prints[o] ^ prints[d]).bit_count() <= 2}
        groups[d] = min(near, default=d)
        for o in [o for o in groups if groups[o] in near]:
            groups[o] = groups[d]
    first = sorted({groups[d] for d in groups})
    ids, expected = packing.WordIds(queries.WORDS), Counter()
    for d in first:
        whole = ids.of(pii.replaced(kept[d].text, made)[0]) + packing.SEPARATOR
        for at in range(0, len(whole), 4 * 2048):
            expected[d, at // 4, len(whole[at : at + 4 * 2048]) // 4] += 1
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.start, r.length) for r in rows) == expected
    counts = np.bincount([r.length for r in rows], minlength=2049)
    assert len({r.sequence_id for r in rows}) <= packing.lower_bound(counts) + 1


@pytest.mark.parametrize("frame", ["odd_docs", "no_docs"])
def test_stages_take_odd_tables(spark, frame, request):
    docs = request.getfixturevalue(frame)
    for name, step in corpus_pipeline.STAGES:
        after = step(spark, docs, SF_DIR)
        assert after.count() <= max(docs.count(), 100)
        if name != "best_fit_packing":
            assert after.columns == list(corpus_pipeline.COLUMNS)


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "private_data", "best_fit_packing"]
