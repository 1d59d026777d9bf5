"""Centroid clustering against plain Lloyd rounds in integers."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vertexrank.llm import clustering


def brute(rows, k=8, rounds=10, dim=64):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    x = [[int(np.floor(1024 * float(c))) for c in v] for _, v in kept]
    named = [n for n, (i, _) in enumerate(kept) if i is not None]
    first = sorted(named, key=lambda n: (hashlib.sha256(f"3:{kept[n][0]}".encode()).hexdigest(), x[n]))[:k]
    centres = [x[n] for n in first]

    def assign():
        d = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres] for v in x]
        return [min((e, j) for j, e in enumerate(row)) for row in d]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centres)):
            members = [v for v, (_, o) in zip(x, own, strict=True) if o == j]
            if members:
                centres[j] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    own = assign()
    inertia = Counter()
    for d, j in own:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, d, inertia[j], inertia.total(), digest[j]) for (i, _), (d, j) in zip(kept, own, strict=True))


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumns({c: F.lit("x") for c in ("v", "p", "cluster", "a.b")})


def vectors(seed, n, dim=64):
    rng = np.random.default_rng(seed)
    return np.float32(rng.normal(size=(n, dim)) * rng.uniform(0.1, 2, dim)).tolist()


def test_clusters_equal_brute_force(spark):
    made = vectors(1, 150)
    rows = list(enumerate(made)) + [(7, made[7]), (900, made[7]), (901, [0.0] * 64), (902, [-0.0] * 64), (None, made[3])]
    rows += [(903, None), (904, []), (905, made[0][:63]), (906, [None] + made[0][1:]), (907, [float("nan")] + made[0][1:]), (908, [float("inf")] + made[0][1:])]
    got = clustering.cluster(frame(spark, rows))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_copies_few_vectors_and_none(spark):
    made = vectors(2, 3)
    same = [(i, made[0]) for i in range(20)] + [(50, made[1])]  # equal first centroids: the smaller number takes all
    for rows in (same, list(enumerate(made))):
        assert Counter(map(tuple, clustering.cluster(frame(spark, rows)).collect())) == brute(rows)
    lone = clustering.cluster(frame(spark, [(None, made[0])])).collect()
    assert len(lone) == 1 and lone[0]["cluster"] is None and lone[0]["centroid_sha256"] is None
    assert clustering.cluster(frame(spark, [(1, None)])).count() == 0


def test_large_components(spark):
    big = np.float32(np.array(vectors(3, 40)) * 10_000).tolist()
    rows = list(enumerate(big))
    assert Counter(map(tuple, clustering.cluster(frame(spark, rows)).collect())) == brute(rows)
    with pytest.raises(Exception, match="a component is beyond"):
        clustering.cluster(frame(spark, [(1, [1e30] * 64)]))


@pytest.mark.parametrize("leading", [1, 4, 63, 64])
def test_filter_changes_nothing_and_spares_distances(leading):
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (8, 64))
    x = centres[rng.integers(0, 8, 3000)] + rng.integers(-40, 40, (3000, 64))
    x[:200] = (centres[0] + centres[1]) // 2  # nearly or exactly tied
    axes = np.linalg.eigh(np.cov(x.T.astype(float)))[1][:, ::-1][:, :leading].copy()
    own, least, spent = clustering.nearest(x, *clustering.rotated(x, axes), centres, axes)
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (own == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    assert spent < 8 * len(x) and (leading < 4 or spent < 2 * len(x))
