import numpy as np
import pytest

from etlkit.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id int"


def make(seed=0):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            base = rng.normal(size=16)
            for _ in range(4):
                rows.append((n, (base + rng.normal(size=16) * 0.12).tolist(), label, "x", 7))
                n += 1
    rows += [(n, rows[0][1], 0, "x", 7), (n + 1, rows[0][1], 1, "x", 7), (n + 2, [0.0] * 16, 0, "x", 7), (n + 3, None, 0, "x", 7),
             (n + 4, [float("nan")] + [1.0] * 15, 0, "x", 7), (n + 5, [float("inf")] + [1.0] * 15, 0, "x", 7), (n + 6, [None] + [1.0] * 15, 0, "x", 7),
             (n + 7, [], 0, "x", 7), (None, rows[0][1], 0, "x", 7), (n + 8, rows[5][1][:8], 0, "x", 7), (n + 9, [2 * v for v in rows[5][1]], 0, "x", 7)]
    return rows


def brute(rows, cosine):
    ok = [(i, np.array(v, dtype=np.float32).astype(float), l) for i, v, l, *_ in rows
          if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    links, parent = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a, l in ok:
        for j, b, m in ok:
            if i != j and l == m and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return links, {i: find(i) for i in parent}


@pytest.mark.parametrize("block", [4096, 7])
def test_matches_brute_force(spark, block):
    rows = make()
    links, parts = brute(rows, 0.93)
    got = vectors.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), recall=0.999, lines=32, block=block).collect()
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got)
    assert 0.98 * sum(links.values()) <= found <= sum(links.values())
    wrong = [r for r in got if r.vec_id is not None and r.component_id != parts[r.vec_id]]
    assert len(wrong) <= 2
    none = next(r for r in got if r.vec_id is None)
    assert (none.n_links, none.component_id, none.kept) == (0, None, False)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_recall_is_calibrated_at_the_threshold():
    rng = np.random.default_rng(4)
    pairs = []
    for _ in range(400):
        a, b = rng.normal(size=64), rng.normal(size=64)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        pairs += [a, 0.9301 * a + np.sqrt(1 - 0.9301**2) * b]
    least = vectors.needed_collisions(24, 0.98)
    hit = 0
    for k in range(0, len(pairs), 2):
        ids, _, _ = vectors.block_links(np.array([1, 2]), np.ones(2), np.zeros(2, int), np.array(pairs[k : k + 2]), 0.93, 24, least, k)
        hit += len(ids) == 2
    assert hit / 400 >= 0.95


def test_empty_and_repeated(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], 3) for i in range(5)], "vec_id long, embedding array<double>, label int")
    assert {(r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(same).collect()} == {(i, 4, 0) for i in range(5)}
