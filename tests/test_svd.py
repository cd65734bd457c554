"""The range finder against numpy's SVD."""

import warnings

import numpy as np
import pytest

from listenlens.operators import factors


def play_matrix(seed, n_users, n_items):
    rng = np.random.default_rng(seed)
    m = np.where(rng.random((n_users, n_items)) < 0.3, rng.integers(1, 20, (n_users, n_items)), 0).astype(float)
    m += np.outer(rng.integers(0, 3, n_users), rng.integers(0, 4, n_items))  # some structure
    return m


def frame(spark, m):
    rows = [(f"u{i:03d}", f"s{j:03d}", float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows, "user_id string, song_id string, play_count double")


@pytest.mark.parametrize("shape,k,oversample", [((60, 40), 5, 5), ((30, 90), 4, 20), ((12, 9), 3, 40)])
def test_singular_values_and_reconstruction(spark, shape, k, oversample):
    m = play_matrix(sum(shape), *shape)
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    users, items, singular = factors.svd_vectors(frame(spark, m), k, oversample)
    assert np.allclose(singular, s[:k], rtol=1e-6)
    left, right = np.zeros((shape[0], k)), np.zeros((shape[1], k))
    for r in users.collect():
        left[int(r.user_id[1:])] = r.v
    for r in items.collect():
        right[int(r.song_id[1:])] = r.v
    assert np.allclose(left @ right.T, (u[:, :k] * s[:k]) @ vt[:k], atol=1e-2 * s[0] / s[k - 1])
    assert np.allclose(right.T @ right, np.eye(k), atol=1e-8)


def test_scores_of_pairs_and_lists(spark):
    m = play_matrix(5, 25, 20)
    df = frame(spark, m)
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    low = (u[:, :6] * s[:6]) @ vt[:6]
    pairs = spark.createDataFrame([("u003", "s004"), ("u010", "s011"), ("nobody", "s001")], "user_id string, song_id string")
    got = {(r.user_id, r.song_id): r.score for r in factors.svd_scores(df, pairs, 6).collect()}
    assert abs(got["u003", "s004"] - low[3, 4]) < 1e-3 and got["nobody", "s001"] == 0.0
    recs = factors.svd_recommend(df, df, 6, 3).collect()
    for i in range(25):
        mine = [r.song_id for r in sorted((r for r in recs if r.user_id == f"u{i:03d}"), key=lambda r: r["rank"])]
        free = [j for j in range(20) if m[i, j] == 0]
        best = sorted(free, key=lambda j: (-round(low[i, j], 3), j))[:3]
        assert len(mine) == len(best)
        assert all(abs(low[i, int(a[1:])] - low[i, b]) < 1e-2 for a, b in zip(mine, best))


def test_no_unconverged_vectors(spark):
    df = frame(spark, play_matrix(7, 40, 36))
    with pytest.raises(ArithmeticError, match="not converged after 1 rounds: residual"):
        factors.svd_vectors(df, 2, 2, rounds=1, tolerance=1e-9)
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        factors.svd_vectors(df, 2, 2, rounds=1, tolerance=1.0)


def test_narrow_row_space_takes_one_round(spark):
    m = play_matrix(3, 30, 8)
    users, items, singular = factors.svd_vectors(frame(spark, m), 3, 20, rounds=1, tolerance=1e-12)
    assert np.allclose(singular, np.linalg.svd(m, compute_uv=False)[:3], rtol=1e-12)


def test_triangle_is_reduced_over_a_tree(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(500, 6)) * [1, 1e-3, 1e-6, 1, 1e-8, 1]  # squared, the least would drown
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id long, v array<double>").repartition(9)
    for fan_in in (2, 64):
        r = factors._triangle(df, 6, fan_in)
        assert np.allclose(np.linalg.svd(r, compute_uv=False), np.linalg.svd(m, compute_uv=False), rtol=1e-9, atol=1e-14)
    basis, width = factors._orthonormal(df, "id", 6)
    q = np.array([r["v"] for r in basis.collect()])
    assert width == 6 and np.allclose(q.T @ q, np.eye(6), atol=1e-13)
