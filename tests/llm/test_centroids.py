"""Centroid clustering against plain numpy: nulls, ties, repeated rows, few vectors, empty tables, clashing columns."""

import hashlib
import math

import numpy as np
import pytest

from gazetta.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, ids string, v string"


def brute(rows, k, rounds, components, scale=256):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == components and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, tuple(math.floor(float(np.float32(x)) * scale) for x in vector)))

    def start(row):
        hashed = None if row[0] is None else hashlib.sha256(f"2:{row[0]}".encode()).hexdigest()
        return (hashed is None, hashed or "", row[1])

    means = [v for _, v in sorted(kept, key=start)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, vs in groups.items():
            means[c] = tuple(sum(x) // len(vs) for x in zip(*vs, strict=True))
    found = [(vec_id, *nearest(v)) for vec_id, v in kept]
    per = {}
    for _, distance, c in found:
        per[c] = per.get(c, 0) + distance
    digests = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return [(i, c, d, per[c], sum(per.values()), digests[c]) for i, d, c in found]


def same(spark, rows, k=3, rounds=4, components=4, chunk_rows=5):
    df = spark.createDataFrame([(i, v, None, "x", "y", "z", "w") for i, v in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in centroids.cluster(df, k, rounds, components, chunk_rows=chunk_rows).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=order) == sorted(brute(rows, k, rounds, components), key=order)
    return got


def test_random_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 4)]) for i in range(60)]
    assert len(same(spark, rows)) == 60


def test_odd_rows_take_no_part(spark):
    good = [(i, [0.1 * i, -0.2, 0.3, 0.0]) for i in range(8)]
    odd = [(20, None), (21, []), (22, [0.1, 0.2, 0.3]), (23, [0.1, None, 0.2, 0.3]), (24, [float("nan"), 0.0, 0.0, 0.0]), (25, [float("inf"), 0.0, 0.0, 0.0])]
    assert {r[0] for r in same(spark, good + odd)} == set(range(8))


def test_repeated_ids_rows_and_ties(spark):
    rows = [(1, [1.0, 0.0, 0.0, 0.0])] * 5 + [(2, [-1.0, 0.0, 0.0, 0.0])] * 5 + [(3, [0.0, 0.0, 0.0, 0.0]), (None, [0.5, 0.5, 0.5, 0.5]), (1, [0.0, 1.0, 0.0, 0.0])]
    same(spark, rows, k=4)


def test_fewer_vectors_than_centroids_and_none(spark):
    same(spark, [(7, [0.1, 0.2, 0.3, 0.4]), (8, [0.1, 0.2, 0.3, 0.5])], k=40)
    got = centroids.cluster(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroids.cluster(spark.createDataFrame([(1, None, 0, "", "", "", "")], SCHEMA)).count() == 0


def test_empty_clusters_stay(spark):
    # all vectors equal: every centroid starts at the same place, the first takes all
    got = same(spark, [(i, [0.25, 0.25, 0.25, 0.25]) for i in range(9)], k=3)
    assert {r[1] for r in got} == {0} and {r[2] for r in got} == {0}


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0, 0.0, 0.0], 0, "", "", "", "")], SCHEMA)
    with pytest.raises(Exception, match="2\\^27"):
        centroids.cluster(df, 2, 1, 4).collect()


@pytest.mark.parametrize("copies", [1, 50])
def test_encoding_loses_nothing_and_copies_share_an_entry(copies):
    rng = np.random.default_rng(5)
    matrix = np.repeat(rng.integers(-300, 300, (40, 16)), copies, axis=0)
    blocks = centroids.encode(matrix)
    assert (centroids.decode(blocks) == matrix).all()
    assert sum(b.entries.shape[1] for b in blocks) == 16
    if copies == 50:
        assert len(blocks) == 1 and len(blocks[0].entries) == 40
    means = rng.integers(-300, 300, (7, 16))
    assert (centroids.distances(blocks, means) == ((matrix[:, None] - means) ** 2).sum(2)).all()
