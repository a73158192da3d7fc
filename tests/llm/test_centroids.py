"""Centroid clustering against plain integer arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hestia.llm import centroids as C


def plain(rows, clusters=8, rounds=10):
    """(id, cluster, distance, cluster inertia, inertia, centroid) of Lloyd's rounds on Python integers."""
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(fine, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in fine]
        for k in range(len(cents)):
            own = [v for (_, v), j in zip(fine, of) if j == k]
            if own:
                cents[k] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *near(v)) for i, v in fine]
    total = sum(d for _, d, _ in found)
    return sorted(
        ((i, k, d, sum(e for _, e, j in found if j == k), total, ",".join(map(str, cents[k]))) for i, d, k in found), key=repr
    )


def found(df, **kw):
    out = C.cluster(df, **kw).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid").collect()
    return sorted((tuple(r) for r in out), key=repr)


def test_planes_give_exact_products():
    r = np.random.default_rng(1)
    u = r.integers(0, 3000, (50, 64))
    c = r.integers(0, 3000, (5, 64))
    v, w = C.planes_of(u, 12), C.planes_of(c, 12)
    assert (C.dots(v, w) == u @ c.T).all()
    assert (C.distances(v, w) == ((u[:, None] - c[None]) ** 2).sum(axis=2)).all()
    assert (C.bit_counts(v) * (1 << np.arange(12))[:, None]).sum(axis=0).tolist() == u.sum(axis=0).tolist()


def test_like_plain_arithmetic(spark):
    rand = random.Random(3)
    rows = [(i, [rand.gauss(i % 5, 0.4) for _ in range(64)]) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[9][1])]
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)) == plain(rows)


def test_given_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    assert found(df, rounds=3) == plain(rows, rounds=3)


def test_odd_rows(spark):
    fine = [0.5] * 64
    rows = [(1, fine), (2, None), (3, []), (4, [0.1] * 63), (5, [0.1] * 65), (6, [None, *fine[1:]]), (7, [float("nan"), *fine[1:]]), (8, [float("inf"), *fine[1:]]), (9, [-0.25] * 64), (9, [-0.25] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({n: F.lit(1) for n in ("cluster", "distance", "k", "plane", "n", "__x")})
    assert found(df) == plain(rows)
    assert [r[0] for r in found(df)] == [1, 9, 9]
    assert C.cluster(df.limit(0)).count() == 0
    assert C.cluster(df.where("vec_id = 2")).columns == C.cluster(df).columns


@pytest.mark.parametrize("size", [1e7, 3e12, 1e30, 1e300])
def test_large_components(spark, size):
    """Clusters are exact at any size; a distance beyond a long is null."""
    rand = random.Random(5)
    rows = [(i, [rand.uniform(-size, size) if i % 3 else rand.uniform(-1, 1) for _ in range(64)]) for i in range(9)]
    exact = lambda x: int(math.floor(1024 * x)) if abs(x) < 2**52 else int(x) * 1024
    assert C.floored(1e300, 1024) == int(1e300) * 1024
    got = {r.vec_id: r for r in C.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), clusters=3, rounds=2).collect()}
    ints = {i: [exact(x) for x in v] for i, v in rows}
    for i, r in got.items():
        d = sum((a - int(b)) ** 2 for a, b in zip(ints[i], r.centroid.split(",")))
        assert r.distance == (d if d < 1 << 63 else None)
