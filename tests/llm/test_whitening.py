import numpy as np
import pytest

from etlkit.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n int, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA).repartition(3)


def result(spark, rows, **options):
    out = W.whitened(frame(spark, rows), **options)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return out.collect()


def check(got, rows, components=32):
    """Against numpy's eigenvectors of the covariance in double precision, up to each component's sign."""
    x = np.floor(64 * np.array([np.float32(v) for _, v in rows], dtype=np.float64)).astype(np.int64) + 1_000_000
    n, d = x.shape
    centred = x - x.mean(axis=0)
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    kept = min(components, d)
    want = {i: centred[k] @ v[:, :kept] / np.sqrt(e[:kept]) for k, (i, _) in enumerate(rows)}
    sums = [int(s) for s in x.sum(axis=0)]
    deviation = {i: sum((n * int(a) - s) ** 2 for a, s in zip(x[k], sums)) for k, (i, _) in enumerate(rows)}
    table = {i: np.full(kept, np.nan) for i in want}
    for r in got:
        table[r.vec_id][r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
    ids = sorted(want)
    a, b = np.array([table[i] for i in ids]), np.array([want[i] for i in ids])
    signs = np.sign((a * b).sum(axis=0))
    assert np.allclose(a, b * signs, atol=1e-6) and len(got) == n * kept


def test_matches_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(1)
    mix = rng.standard_normal((40, 40)) * np.linspace(4, 0.5, 40)
    rows = [(i, (rng.standard_normal(40) @ mix).tolist()) for i in range(600)]
    check(result(spark, rows), rows)
    check(result(spark, rows, components=3), rows, 3)


def test_far_from_orthogonal_columns(spark):
    rng = np.random.default_rng(2)
    scales = np.array([1e4, 3e3, 1e3, 100.0, 10.0, 1.0])
    rows = [(i, (rng.standard_normal(6) * scales).tolist()) for i in range(900)]
    check(result(spark, rows), rows)


def test_dependent_entries_have_no_component(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(80):
        a, b = rng.integers(-50, 50, 2).tolist()
        rows.append((i, [float(a), float(b), float(a + b), 5.0]))
    got = result(spark, rows)
    assert len(got) == 4 * 80 and {r.component for r in got if r.whitened is None} == {3, 4}
    assert max(r.identity_error for r in got) < 1e-9
    assert sum(r.explained for r in got if r.vec_id == 0) == pytest.approx(1)


def test_rows_left_out_and_odd_tables(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(20)]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]), (54, [float("inf"), 0.0, 0.0]), (55, [1.0, 2.0]), (56, [1e30, 0.0, 0.0])]
    check(result(spark, good + bad), good)
    repeated = result(spark, [(None, [1.0, 2.0])] * 3 + [(4, [3.0, 1.0])] * 2)
    assert len(repeated) == 10 and {r.vec_id for r in repeated} == {None, 4} and {r.n for r in repeated} == {5}
    assert all(r.whitened is None for r in repeated if r.component == 2)
    single = result(spark, [(1, [1.0, 2.0])])
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in single] == [(1, 0, None, 0.0, 0.0)] * 2
    assert result(spark, []) == [] and result(spark, bad[:5]) == []


def test_exact_beyond_64_bits():
    x = np.array([[2**45, 3], [5, 7]], dtype=np.int64)
    n, sums = 2**20, (11, 13)
    d = W.deviations(x, n, sums)
    assert d.tolist() == [[n * int(v) - s for v, s in zip(row, sums)] for row in x]
    assert W.squares(d) == [None, sum((n * v - s) ** 2 for v, s in zip((5, 7), sums))]


def test_triangular_solve():
    rng = np.random.default_rng(5)
    r = np.triu(rng.standard_normal((70, 70))) + 20 * np.eye(70)
    x = rng.standard_normal((9, 70))
    assert np.allclose(W.triangular_solve(x, r) @ r, x)
