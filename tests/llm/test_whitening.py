from fractions import Fraction

import numpy as np
import pytest

from credscope.llm import op11_whitening as op

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n long"


def by_hand(vectors):
    """n, sums and the covariance in whole numbers and fractions."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, dim = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(dim)]
    d = np.array([[n * r[j] - sums[j] for j in range(dim)] for r in x], dtype=object)
    exact = d.T @ d
    v = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in exact])
    return x, n, sums, d, v


def run(spark, tmp_path, rows, partitions=4):
    spark.createDataFrame([(i, v, 0, 5, 9) for i, v in rows], SCHEMA).repartition(partitions).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = op.query(spark, str(tmp_path))
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    return got.collect()


def compare(got, ids, vectors):
    x, n, sums, d, v = by_hand(vectors)
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(32, len(v))
    assert len(got) == len(x) * k
    z = np.zeros((len(x), k))
    place = {i: p for p, i in enumerate(ids)}
    for r in got:
        p = place[r["vec_id"]]
        z[p, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == sum(int(c) ** 2 for c in d[p])
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(v), rel=1e-4)
        assert r["identity_error"] < 1e-8
    assert np.abs(z.T @ z / n - np.eye(k)).max() < 1e-8
    # the whitened columns are the centred vectors on unit eigenvectors
    centred = d.astype(float) / n
    for j in range(k):
        w = np.linalg.lstsq(centred, z[:, j] * np.sqrt(values[j]), rcond=None)[0]
        assert np.linalg.norm(w) == pytest.approx(1, abs=1e-7)
        assert np.abs(v @ w - values[j] * w).max() < 1e-9 * values[0]


def test_query_matches_brute_force(spark, tmp_path):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(500, 40)) @ rng.normal(size=(40, 40))).astype(np.float32).tolist()
    odd = [(1000, None), (1001, [None] + vectors[0][1:]), (1002, [float("nan")] + vectors[0][1:]), (1003, [float("inf")] + vectors[0][1:]), (1004, []), (1005, vectors[0][:7]), (1006, [3e38] + vectors[0][1:])]
    compare(run(spark, tmp_path, list(enumerate(vectors)) + odd), range(500), vectors)


def test_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(op.query(spark, "/root/testdata/sf0.01").collect(), [r[0] for r in rows], [r[1] for r in rows])


def test_repeated_rows_and_few_components(spark, tmp_path):
    vectors = [[float(i % 5), float(i % 3)] for i in range(30)]
    got = run(spark, tmp_path, [(7, v) for v in vectors] + [(None, vectors[0])])
    assert len(got) == 62 and {r["component"] for r in got} == {1, 2} and {r["n"] for r in got} == {31}


def test_no_variance_and_empty(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir(), (tmp_path / "c").mkdir()
    assert run(spark, tmp_path / "a", [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert run(spark, tmp_path / "b", []) == []
    line = run(spark, tmp_path / "c", [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])
    assert {r["component"] for r in line} == {1} and len(line) == 9


def test_clustered_eigenvalues():
    rng = np.random.default_rng(2)
    for values in ([1, 1 + 1e-9, 1 + 2e-9, 5, 5, 1e-3], [1 + i * 1e-8 for i in range(20)], [1] * 8, [1e6, 1, 1 + 1e-12, 1e-6]):
        q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0].astype(np.longdouble)
        v = (q * np.array(values, dtype=np.longdouble)) @ q.T
        v = (v + v.T) / 2
        e, x = op.eigenvectors(v)
        top = max(values)
        assert np.allclose(e, sorted(values, reverse=True), rtol=0, atol=1e-14 * top)
        assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-14
        assert np.abs(v.astype(float) @ x - x * e).max() < 1e-14 * top


def test_refinement_beats_its_start():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(60, 200))
    v = a @ a.T / 200
    start = np.linalg.eigh(v.astype(np.float32))[1].astype(float)
    e, x = op.eigenvectors(v)
    wrong = lambda x: np.abs(x.T @ v @ x - np.diag(np.diag(x.T @ v @ x))).max()
    assert wrong(start) > 1e-8 and wrong(x) < 1e-13


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for top in (9, 10**6, 10**7, 10**12):
        rows = rng.integers(-top, top, size=(300, 5))
        exact = rows.astype(object)
        assert (sum(p.astype(object) for p in op._cross(rows)) == exact.T @ exact).all()
