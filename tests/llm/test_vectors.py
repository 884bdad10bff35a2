"""Neighbour search and centroid clustering against brute force."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import centroids, neighbours, queries

ODD = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, -float("inf")]]


def frame(spark, rows, kind="double"):
    """Vectors from (vec_id, vector); three more columns have names that operators use too."""
    made = [(i, v, 1, "t", 2) for i, v in rows]
    return spark.createDataFrame(made, f"vec_id long, embedding array<{kind}>, t int, v string, cluster int")


# Nearest neighbours


def ranking(rows, query_id, vector, k):
    """The exact answer for one query."""
    found = set()
    for i, v in rows:
        usable = v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == len(vector)
        if usable and i != query_id:
            total = 0.0
            for x, y in zip(vector, v, strict=True):
                total += x * y
            found.add((-total, i is None, i or 0, tuple(v)))
    return [(None if none else i, -score) for score, none, i, _ in sorted(found)[:k]]


def clustered(n, dims, seed, groups=8, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return [(k, [float(np.float32(x)) for x in centres[k % groups] + spread * rng.normal(size=dims)]) for k in range(n)]


def by_query(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize(("seed", "spread", "scale"), [(1, 0.3, 1.0), (2, 3.0, 1.0), (3, 0.5, 1e150)])
def test_recall_against_brute_force(spark, monkeypatch, seed, spread, scale):
    monkeypatch.setattr(neighbours, "GROUP_VECTORS", 64)
    monkeypatch.setattr(neighbours, "GROUP_QUERIES", 8)
    monkeypatch.setattr(neighbours, "BUCKET_VECTORS", 16)
    rows = [(i, [x * scale * (1 + i % 3) for x in v]) for i, v in clustered(600, 12, seed, spread=spread)]
    got = by_query(neighbours.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0, k=10))
    hits = 0
    for i, v in rows[::20]:
        want = ranking(rows, i, v, 10)
        assert len(got[i]) == 10 and got[i] == sorted(got[i], key=lambda x: (-x[1], x[0]))
        whole = dict(ranking(rows, i, v, len(rows)))
        assert all(whole[j] == score for j, score in got[i])
        hits += len({j for j, _ in got[i]} & {j for j, _ in want})
    assert set(got) == {i for i, _ in rows[::20]} and hits >= 0.9 * 10 * len(got)


def test_recall_on_the_test_table(spark, sf_dir):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = by_query(queries.queries()["op11_nearest_neighbours"](spark, sf_dir))
    hits = total = 0
    for i, v in rows:
        if i % 20 == 0:
            want = {j for j, _ in ranking(rows, i, v, 20)}
            hits, total = hits + len(want & {j for j, _ in got[i]}), total + len(want)
            assert len(got[i]) == len(want)
    assert hits >= 0.9 * total > 0


def test_neighbours_of_odd_rows(spark):
    """Nulls, zero, repeated rows, ids with two vectors, null ids, ties and two lengths: few rows, so all candidates come."""
    rows = [(k, v) for k, v in enumerate(ODD, 100)] + [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (2, [2.0, 1.0]), (3, [2.0, 1.0]), (4, [-1.0, 0.5]), (4, [0.5, 0.5])]
    rows += [(None, [2.0, 1.0]), (None, None), (5, [1.0, 1.0, 1.0]), (6, [1.0, 0.0, 0.0])]
    got = by_query(neighbours.nearest_neighbours(frame(spark, rows), F.lit(True), k=20))
    assert None not in got and set(got) == {1, 2, 3, 4, 5, 6}
    for i, v in [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [2.0, 1.0]), (5, [1.0, 1.0, 1.0]), (6, [1.0, 0.0, 0.0])]:
        assert got[i] == ranking(rows, i, v, 20)
    both = ranking(rows, 4, [-1.0, 0.5], 20) + ranking(rows, 4, [0.5, 0.5], 20)
    assert sorted(got[4], key=str) == sorted(both, key=str)


def test_neighbours_among_many_copies(spark, monkeypatch):
    """A third of the rows are copies of one vector: they are split, and ties go to the smaller ids."""
    monkeypatch.setattr(neighbours, "GROUP_VECTORS", 32)
    rows = clustered(200, 8, 5) + [(k, [1.0] * 8) for k in range(1000, 1100)] + [(2000, [1.0] * 8)] * 50
    got = by_query(neighbours.nearest_neighbours(frame(spark, rows, "float"), F.col("vec_id").isin(1040, 2000), k=20))
    assert got[1040][:20] == ranking(rows, 1040, [1.0] * 8, 20) and got[2000] == ranking(rows, 2000, [1.0] * 8, 20)


def test_neighbours_of_empty_tables_and_without_queries(spark):
    none = neighbours.nearest_neighbours(frame(spark, [(1, [1.0])]).where(F.lit(False)), F.lit(True))
    assert none.collect() == [] and none.columns == ["query_id", "rank", "vec_id", "score"]
    assert neighbours.nearest_neighbours(frame(spark, [(1, [1.0]), (2, None)]), F.lit(True)).collect() == []
    assert neighbours.nearest_neighbours(frame(spark, clustered(30, 4, 1)), F.lit(False)).collect() == []


def test_buckets_are_visited_by_falling_chance():
    hashing = neighbours.Hashing(3, 5, 2, 2.0, 1.0, 1.0, 7)
    rng = np.random.default_rng(1)
    q = rng.normal(size=(4, 10))
    few, many = (hashing.visits(q, np.full(4, 0.7), s, 4096) for s in (0.5, 0.95))
    for t in range(3):
        for a, b in zip(few[t], many[t], strict=True):
            assert set(a) <= set(b) and len(a) < len(b)
    own = hashing.buckets(q / np.sqrt((q**2).sum(axis=1))[:, None])
    near = hashing.visits(q, np.full(4, 0.99), 0.999, 4096)
    assert all(own[t, i] in near[t][i] for t in range(3) for i in range(4))


# Centroid clustering


def clusters(rows, k, rounds, dims, seed=1):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(((i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept), key=lambda x: (x[0], "" if x[0] else x[1], x[2]))
    at = [v for *_, v in start[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), n) for n, c in enumerate(at))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        at = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(at)]
    found = [(i, nearest(v)) for i, v in kept]
    inertia = defaultdict(int)
    for _, (d, c) in found:
        inertia[c] += d
    return sorted(((i or -1, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, at[c])).encode()).hexdigest()) for i, (d, c) in found))


def got_clusters(df):
    return sorted((r["vec_id"] or -1, *r[1:]) for r in df.collect())


@pytest.mark.parametrize(("n", "dims", "k", "block"), [(300, 6, 7, 16), (40, 3, 16, 5), (3, 2, 16, 256)])
def test_clusters_equal_brute_force(spark, n, dims, k, block):
    rows = clustered(n, dims, n, spread=1.0) + [(5000, [0.25] * dims)] * 40 + [(5001, [-0.25] * dims), (None, [0.5] * dims), (7, [1e4] * dims)]
    rows += list(enumerate(ODD, 9000)) + [(9100, [1.0] * (dims + 1))]
    got = centroids.cluster_vectors(frame(spark, rows), k=k, rounds=3, dims=dims, block=block)
    assert got_clusters(got) == clusters(rows, k, 3, dims)


def test_clusters_of_huge_components_and_empty_tables(spark):
    rows = [(1, [1e300, -1e300]), (2, [1e300, 0.0]), (3, [0.0, 0.0])]
    found = {r["vec_id"]: r for r in centroids.cluster_vectors(frame(spark, rows), k=2, rounds=2, dims=2).collect()}
    assert set(found) == {1, 2, 3} and all(0 <= r["distance"] < 2**63 for r in found.values())
    none = centroids.cluster_vectors(frame(spark, rows).where(F.lit(False)), dims=2)
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_hilbert_curve_goes_from_cell_to_cell():
    for dims, bits in ((2, 4), (3, 3)):
        side = np.arange(1 << bits)
        cells = np.stack([x.ravel() for x in np.meshgrid(*[side] * dims)], axis=1)
        keys = centroids.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        along = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_box_bounds_leave_out_only_what_cannot_be_nearest():
    rng = random.Random(3)
    for _ in range(50):
        v = np.array([[rng.randrange(-50, 50) for _ in range(3)] for _ in range(9)])
        c = np.array([[rng.randrange(-60, 60) for _ in range(3)] for _ in range(6)])
        cluster, distance = centroids.nearest(v, v.min(axis=0), v.max(axis=0), c)
        every = ((v[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
