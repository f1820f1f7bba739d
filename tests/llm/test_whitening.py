"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
import pytest

from newsloom.llm import whitening
from newsloom.llm.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def expected(vectors, components=32):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    values, found = np.linalg.eigh(y.T @ y / n)
    values, found = values[::-1], found[:, ::-1]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    keep = min(components, int((values > 1e-9 * values[0]).sum()))
    return deviation, np.abs(y @ found[:, :keep] / np.sqrt(values[:keep])), values[:keep] / values.sum()


def check(rows, ids, vectors, components=32):
    deviation, white, explained = expected(vectors, components)
    assert len(rows) == white.size
    at = {v: i for i, v in enumerate(ids)}
    for r in rows:
        i, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == len(vectors) and r["deviation"] == deviation[i]
        assert abs(abs(r["whitened"]) - white[i, c]) < 1e-7 and abs(r["explained"] / explained[c] - 1) < 1e-9
        assert r["identity_error"] < 1e-9


@pytest.mark.parametrize("kind", ["full", "graded", "scalar", "rank one", "two values", "wide", "zero", "block"])
@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_eigenvectors(kind, size):
    chosen = np.random.default_rng(size)
    q, _ = np.linalg.qr(chosen.normal(size=(size, size)))
    a = chosen.normal(size=(size, size))
    matrix = {
        "full": a @ a.T,
        "graded": np.diag(10.0 ** -np.arange(size) / 3),
        "scalar": 3 * np.eye(size),
        "rank one": a[:, :1] @ a[:, :1].T,
        "two values": q @ np.diag(np.where(np.arange(size) < size // 2, 1.0, 2.0)) @ q.T,
        "wide": q @ np.diag(10.0 ** chosen.uniform(-8, 3, size)) @ q.T,
        "zero": np.zeros((size, size)),
        "block": np.kron(np.eye(size), np.array([[2.0, 1.0], [1.0, 2.0]])),
    }[kind]
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.eigen(matrix)
    scale = max(1e-300, np.abs(matrix).max())
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1]).max() <= 1e-13 * scale * len(matrix)
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * scale * len(matrix)
    assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() < 1e-13


def test_polar_factor_is_the_sign():
    chosen = np.random.default_rng(5)
    q, _ = np.linalg.qr(chosen.normal(size=(30, 30)))
    sign = np.where(np.arange(30) < 11, 1.0, -1.0)
    found = whitening.qdwh_sign(q @ np.diag(sign * 10.0 ** chosen.uniform(-6, 2, 30)) @ q.T)
    assert np.abs(found - q @ np.diag(sign) @ q.T).max() < 1e-9


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    check(QUERIES["op12_whitening"](spark, SF_DIR).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_unusable_rows_go(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    good = [[0.5, -0.25, 1.0], [0.25, 2.0, -1.0], [1.5, 0.0, 0.125], [-3.0, 0.5, 0.7], [0.1, 0.2, 0.3]]
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]
    data = [(i, v, None, i) for i, v in enumerate(good + odd)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, whitened string, component int").repartition(7)
    check(whitening.whitened(frame).collect(), range(len(good)), np.array(good, dtype=np.float32), 3)
    twice = frame.where("vec_id < 5").unionByName(frame.where("vec_id < 5"))
    found = whitening.whitened(twice).collect()
    assert len(found) == 30 and {r["n"] for r in found} == {10}
    assert whitening.whitened(frame.where("false")).collect() == []
    assert whitening.whitened(frame.where("vec_id = 1")).collect() == []  # one vector has no variance
    assert {r["vec_id"] for r in whitening.whitened(frame.where("vec_id < 4").withColumn("vec_id", whitening.F.lit(None).cast("long"))).collect()} == {None}


def test_deviations_beyond_64_bits_are_null():
    model = whitening.Whitening(3, [0, 0], np.eye(2), np.ones(2), np.ones(2))
    x = np.array([[1 << 50, 0], [1, 2], [1 << 29, 0]], dtype=np.int64)
    assert whitening.deviations(x, model) == [None, 45, 9 << 58]
