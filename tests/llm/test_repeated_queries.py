"""A query row that is repeated more often than k, far from all others."""

from __future__ import annotations

import math
import random

from rallymart.llm import knn

FAR_ID = 199650


def test_far_query_repeated_ten_times(spark):
    r = random.Random(7)
    rows = [(i, [r.uniform(0, 1) for _ in range(4)]) for i in range(1, 7000)]
    # This vec_id has a low hash, so it is among the rows that pivots are chosen from.
    rows += [(FAR_ID, [-40.0, -35.0, -50.0, -45.0])] * 10
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(256 * v) for v in x] for i, x in rows}
    assert sum(i % 50 == 0 for i in whole) > knn.QUERIES_PER_PIVOT
    expected = []
    for q, x in whole.items():
        if q % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(x, y, strict=True)), d) for d, y in whole.items() if d != q]
            # The repeated row is a data row ten times for the others.
            scores = [s for s in scores for _ in range(10 if s[1] == FAR_ID else 1)]
            expected += [(q, n, d, -s) for n, (s, d) in enumerate(sorted(scores)[:5], 1)]
    assert sorted(tuple(x) for x in knn.top_k(frame).collect()) == sorted(expected)
