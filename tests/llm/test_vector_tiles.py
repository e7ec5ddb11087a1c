"""Near-equal vectors against all cosines."""

from __future__ import annotations

import numpy as np
import pytest

from millrace.llm import queries
from millrace.llm import vector_tiles as V

SCHEMA = "vec_id long, embedding array<float>, label int, size string"


def brute(rows, threshold=0.95):
    kept = {i: np.array(v, dtype=np.float64) for i, v in rows if i is not None and v is not None and None not in v and len(v)}
    kept = {i: v for i, v in kept.items() if np.isfinite(v).all() and v.any()}
    ids = [i for i, _ in rows if i is not None]
    links = {i: 0 for i in ids}
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    listed = sorted(kept)
    for n, i in enumerate(listed):
        for j in listed[n + 1 :]:
            a, b = kept[i], kept[j]
            if len(a) == len(b) and np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: (links[i], root(i), root(i) == i) for i in ids}


def found(frame):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in V.near_vectors(frame).collect()}


@pytest.mark.parametrize("dims", [3, 64])
def test_clusters_against_all_cosines(spark, monkeypatch, dims):
    rng = np.random.default_rng(dims)
    centres = rng.standard_normal((12, dims))
    rows = []
    for n in range(500):
        v = centres[rng.integers(12)] + rng.standard_normal(dims) * rng.choice([0.0, 0.12, 0.2, 0.4])
        rows.append((5_000 - n, (v * rng.uniform(0.01, 90)).astype(np.float32).tolist()))
    rows += [(9_000 + n, rows[n % 7][1]) for n in range(40)]
    monkeypatch.setattr(V, "TILE", 150)
    monkeypatch.setattr(V, "PATCH", 64)
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    assert found(frame) == brute(rows)


def test_bounds_are_never_broken():
    rng = np.random.default_rng(3)
    for dims in (2, 64, 1500):
        x = rng.standard_normal((200, dims)) * rng.choice([1e-3, 1, 50], dims)
        x /= np.linalg.norm(x, axis=1)[:, None]
        codes, scales, lost = V.quantise(x)
        near = V.products(codes, codes) * scales[:, None] * scales[None, :]
        assert (np.abs(near - x @ x.T) <= lost[:, None] + lost[None, :] + lost[:, None] * lost[None, :] + 1e-9).all()


def test_edge_cases(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [1.0, 0.0]), (6, [2.0, -0.0]), (7, [2.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [float("inf"), 1.0]), (10, [])]
    frame = spark.createDataFrame([(i, v, None, "y") for i, v in [*rows, rows[4], (None, [1.0, 0.0])]], SCHEMA)
    got = [tuple(r) for r in V.near_vectors(frame).collect()]
    assert {r[0]: r[1:] for r in got if r[0] is not None} == brute(rows)
    assert len(got) == 11 and [r for r in got if r[0] is None] == [(None, 0, None, True)]
    assert V.near_vectors(frame.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in queries.op10_vector_tiles(spark, sf).collect()}
    assert got == brute(rows)
