"""Dense clusters, audits and unequal vectors in the near-duplicate search, with the shipped settings."""

from __future__ import annotations

import numpy as np

from querytrail.llm import vectors


def clusters(n, dims=32, spread=0.03, seed=1):
    """Half of the vectors lie in one cluster, the others by themselves or in pairs."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dims))
    rows[:n // 2] = rows[0] + spread * rng.normal(size=(n // 2, dims)) * np.linalg.norm(rows[0])
    rows[n // 2 + 1::4] = rows[n // 2::4][:len(rows[n // 2 + 1::4])] * rng.uniform(0.9, 1.1, (len(rows[n // 2 + 1::4]), 1)) + 0.01
    order = rng.permutation(n)
    return vectors._unit(rows[order].tolist())


def test_clusters_of_two_thousand_are_found_without_wide_beams():
    for spread in (0.001, 0.03, 0.045):
        rows = clusters(4000, spread=spread)
        true = rows @ rows.T >= 0.93
        found, measured, beam = vectors.audited_links(vectors.Graph(rows), rows, 0.93)
        hits = sum(int(true[i, f].sum()) for i, f in enumerate(found))
        assert hits >= 0.99 * true.sum() and sum(map(len, found)) == hits
        assert measured >= 0.99 and beam <= 96


def test_counts_and_roots_from_either_end():
    rng = np.random.default_rng(3)
    n = 700
    near = rng.random((n, n)) < 0.002
    sizes = rng.integers(1, 4, n)
    weights, roots = vectors._counted([np.flatnonzero(row) for row in near], sizes)
    both = near | near.T | np.eye(n, dtype=bool)
    assert (weights == both @ sizes - 1).all()
    reach = np.arange(n)
    for _ in range(n):
        lower = np.where(both, reach[None, :], n).min(axis=1)
        if (lower == reach).all():
            break
        reach = lower
    assert (roots == reach).all()


def test_a_dense_label_over_several_shards(spark):
    rows = clusters(600, dims=8)
    frame = spark.createDataFrame(
        [(i, [float(x) for x in row], "l") for i, row in enumerate(rows)], "vec_id long, embedding array<double>, label string")
    true = rows @ rows.T >= 0.93
    for shard_rows in (8192, 200):
        got = {r.vec_id: r for r in vectors.near_duplicate_vectors(frame, shard_rows=shard_rows, block_rows=64).collect()}
        assert sum(r.n_links for r in got.values()) >= 0.99 * (true.sum() - len(rows))
        assert all(r.n_links <= true[i].sum() - 1 and r.recall >= 0.99 for i, r in got.items())


def test_vectors_of_unequal_length_are_not_linked(spark):
    rows = [(1, [1.0, 0.0], "l"), (2, [1.0, 0.0, 0.0], "l"), (3, [2.0, 0.0], "l"), (4, [], "l"), (5, [1.0, 0.0], None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicate_vectors(frame).collect()}
    assert got == {1: (1, 1, True), 2: (0, 2, True), 3: (1, 1, False), 4: (0, 4, True), 5: (0, 5, True)}
