import math

import numpy as np

from credscope.llm import op06_ann as op

SCHEMA = "vec_id long, embedding array<float>, score double, label int"


def brute(rows, every=100, k=10):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in good:
        if q % every == 0:
            d = sorted((math.sqrt(((good[q] - v) ** 2).sum()), i) for i, v in good.items() if i != q)
            out[q] = [(i, s) for s, i in d[:k]]
    return out


def rows_of(n, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(8, 16))
    return [(i, (centers[i % 8] + 0.7 * rng.normal(size=16)).tolist(), None, 1) for i in range(n)]


def recall(got, want):
    found = {q: set() for q in want}
    for r in got:
        found[r.query_id].add(r.vec_id)
    return np.mean([len(found[q] & {i for i, _ in w}) / max(1, len(w)) for q, w in want.items()])


def test_recall_and_exact_scores(spark):
    rows = rows_of(6000)
    got = op.search(spark.createDataFrame(rows, SCHEMA), sample=2000, trees=6, leaves=60, every=50).collect()
    want = brute(rows, 50)
    assert recall(got, want) >= 0.9
    assert {r.query_id for r in got} == set(want) and all(len([r for r in got if r.query_id == q]) == 10 for q in list(want)[:5])
    exact = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows}
    for r in got:
        assert abs(r.score - math.sqrt(((exact[r.query_id] - exact[r.vec_id]) ** 2).sum())) < 1e-12


def test_odd_rows_ties_and_a_hot_leaf(spark):
    same = [1.0] * 16
    rows = rows_of(120, 1) + [(1000 + i, same, None, None) for i in range(300)]
    rows += [(2000, None, None, 1), (2100, [], None, 1), (2200, [0.0] * 16, None, 1), (2300, [None] * 16, None, 1), (2400, [float("nan")] * 16, None, 1), (2500, [float("inf")] * 16, None, 1), (2600, [1.0, 2.0], None, 1), (None, same, None, 1), (1001, same, None, 1)]
    got = op.search(spark.createDataFrame(rows, SCHEMA), block=50).orderBy("query_id", "rank").collect()
    want = brute(rows)
    assert {q: [(r.vec_id, round(r.score, 9)) for r in got if r.query_id == q] for q in want} == {q: [(i, round(s, 9)) for i, s in w] for q, w in want.items()}


def test_a_near_id_stored_often(spark):
    rows = rows_of(90, 2)
    near = rows[0][1]
    rows += [(1, [x + 1e-3 * c for x in near], None, None) for c in range(1, 21)] + [(2, near, None, None)] * 20
    got = op.search(spark.createDataFrame(rows, SCHEMA)).orderBy("rank").collect()
    exact = {}
    for i, v, *_ in rows:
        d = math.sqrt(((np.array(v, np.float32).astype(float) - np.array(near, np.float32).astype(float)) ** 2).sum())
        exact[i] = min(d, exact.get(i, d))
    want = sorted((s, i) for i, s in exact.items() if i != 0)[:10]
    assert [r.vec_id for r in got] == [i for _, i in want] and [round(r.score, 9) for r in got] == [round(s, 9) for s, _ in want]


def test_few_rows(spark):
    assert op.search(spark.createDataFrame([], SCHEMA)).collect() == []
    got = op.search(spark.createDataFrame([(0, [1.0, 0.0], None, 1), (7, [0.0, 1.0], None, 1)], SCHEMA)).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 7)]
