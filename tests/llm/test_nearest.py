"""Neighbours against brute force, with ties, repeats and unusable vectors."""

import numpy as np
import pytest

from postpulse.llm import nearest

rng = np.random.default_rng(3)


def brute(rows, k, is_query):
    """Sums from the first component on, as the operator states."""
    good = [
        (i, v) for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for n, (q, a) in enumerate(good):
        if is_query(q):
            found = []
            for m, (c, b) in enumerate(good):
                if m != n and len(a) == len(b):
                    s = 0.0
                    for x, y in zip(a, b):
                        s += x * y
                    found.append((-s, c))
            out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("query_block, candidate_block", [(8192, 32768), (7, 40)])
def test_all_neighbours(spark, query_block, candidate_block):
    vectors = rng.normal(size=(300, 8)).astype(np.float32).astype(float)
    vectors[50:120] = vectors[40]  # many equal vectors: ties
    vectors[130] = 1e30 * vectors[130] / np.abs(vectors[130]).max()
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1, rows[1][1]), (2, rows[9][1]), (None, rows[3][1]), (500, None), (501, [0.0] * 8),
             (505, [1.0, None] + [0.0] * 6), (510, [float("nan")] + [1.0] * 7),
             (515, [float("inf")] + [1.0] * 7), (520, [1.0, 2.0]), (525, [3.0, 4.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<double>, rank int")
    found = nearest.nearest(frame.filter("vec_id % 5 = 0"), frame, 6,
                            query_block=query_block, candidate_block=candidate_block)
    assert sorted(map(tuple, found.collect())) == brute(rows, 6, lambda q: q % 5 == 0)


def test_repeated_ids(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (21, [1.0, 1.0]), (40, [2.0, 2.0])]
    rows += [(40, [2.0, 2.0])] * 3 + [(41, [3.0, 1.0])] * 9
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = nearest.nearest(frame.filter("vec_id % 20 = 0"), frame, 6, query_block=2, candidate_block=3)
    assert sorted(map(tuple, found.collect())) == brute(rows, 6, lambda q: q % 20 == 0)


def test_no_rows(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert nearest.nearest(frame, frame, 3).count() == 0


def test_error_bounds_hold():
    q, c = rng.normal(size=(40, 16)), 100 * rng.normal(size=(500, 16)) ** 3
    i, j = nearest.survivors(nearest.quantised(q), nearest.quantised(c), np.zeros((40, 500), bool), 5)
    kept = set(zip(i.tolist(), j.tolist()))
    top = np.argsort(-(q @ c.T), axis=1)[:, :5]
    assert all((n, m) in kept for n, row in enumerate(top.tolist()) for m in row)
    assert len(kept) < 40 * 500 / 4
