"""Clustering, whitening and nearest neighbours against brute force, and on odd rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import centroids, nearest, whitening

NAN, INF = float("nan"), float("inf")


def vectors(seed, n, dim=64, clusters=0, spread=0.2):
    rng = np.random.default_rng(seed)
    if not clusters:
        return rng.standard_normal((n, dim)).round(3)
    return (rng.standard_normal((clusters, dim))[rng.integers(0, clusters, n)] + spread * rng.standard_normal((n, dim))).round(3)


def frame(spark, rows, parts=3):
    """With further columns, named like the operators' own."""
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    return df.select("*", *[F.lit(j).alias(c) for j, c in enumerate(["id", "v", "x", "node", "dim", "cluster", "rank", "score", "label", "path"])]).repartition(parts)


def odd_rows(seed=1, dim=64):
    base = [(i, v) for i, v in enumerate(vectors(seed, 150, dim).tolist())]
    v = base[3][1]
    return base + [
        (200, None), (220, []), (240, v[:-1]), (260, [NAN, *v[1:]]), (280, [INF, *v[1:]]), (300, [None, *v[1:]]), (None, v), (None, None), (None, base[5][1]),
        (40, v), (40, v), (3, v), (320, v), (340, v), (360, [0.0] * dim), (380, [-x for x in v]),
    ]


def fine(rows, dim=None):
    return [(i, v) for i, v in rows if v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and (dim is None or len(v) == dim)]


# --- clustering --------------------------------------------------------------


def clustered(rows, clusters=8, rounds=10, dim=64):
    """All distances, by Python's integers."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in fine(rows, dim)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    at = [x for _, x in sorted(kept, key=key)[:clusters]]
    for number in range(rounds + 1):
        all_of = [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in at] for _, x in kept]
        own = [min(range(len(at)), key=lambda j: (d[j], j)) for d in all_of]
        if number < rounds:
            for j in range(len(at)):
                mine = [x for (_, x), o in zip(kept, own) if o == j]
                if mine:
                    at[j] = [sum(c) // len(mine) for c in zip(*mine)]
    inertia = [sum(d[o] for d, o in zip(all_of, own) if o == j) for j in range(len(at))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted((str(i), o, d[o], inertia[o], sum(inertia), sha[o]) for (i, _), o, d in zip(kept, own, all_of))


COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def got_clusters(df):
    return sorted((str(r[0]), *r[1:]) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("clusters,rounds,seed", [(8, 10, 1), (3, 4, 2), (12, 6, 3)])
def test_clusters_are_those_of_all_distances(spark, clusters, rounds, seed):
    rows = odd_rows(seed)
    assert got_clusters(centroids.cluster(frame(spark, rows), clusters, rounds)) == clustered(rows, clusters, rounds)


def test_ties_and_equal_starts(spark):
    rows = [(i, [float(i % 3)] * 4) for i in range(60)] + [(100 + i, [0.5] * 4) for i in range(5)]
    assert got_clusters(centroids.cluster(frame(spark, rows), 8, 5, dim=4)) == clustered(rows, 8, 5, 4)


def test_hot_vector_few_vectors_and_none(spark):
    hot = [(i, [0.25, -0.5]) for i in range(400)] + [(1000 + i, v) for i, v in enumerate(vectors(4, 50, 2).tolist())]
    assert got_clusters(centroids.cluster(frame(spark, hot), 5, 6, dim=2)) == clustered(hot, 5, 6, 2)
    few = hot[398:402]
    assert got_clusters(centroids.cluster(frame(spark, few), 8, 3, dim=2)) == clustered(few, 8, 3, 2)
    assert centroids.cluster(frame(spark, [(1, None), (2, [1.0])]), dim=2).collect() == []
    assert centroids.cluster(frame(spark, []), dim=2).columns[0] == "vec_id"


def test_bounds_save_distances(spark):
    rows = [(i, v) for i, v in enumerate(vectors(5, 2000, 16, clusters=12).tolist())]
    found = centroids.cluster(frame(spark, rows), 12, 10, dim=16)
    assert got_clusters(found) == clustered(rows, 12, 10, 16)
    assert found.agg(F.sum("scans")).first()[0] < 0.4 * 2000 * 12 * 11


def test_filters_never_pass_a_tie_or_a_nearer_centroid():
    rng = np.random.default_rng(6)
    for trial in range(60):
        dim, k = int(rng.integers(1, 4)), int(rng.integers(1, 9))
        x, at = rng.integers(-4, 5, (80, dim)), rng.integers(-4, 5, (k, dim))
        groups = centroids.grouped(at, int(rng.integers(1, k + 1)))
        cluster, upper, lower, _ = centroids.first(x, at, groups)
        for _ in range(6):
            new = at + rng.integers(-1, 2, (k, dim)) * (rng.random((k, 1)) < 0.5)
            moved = np.sqrt(((new - at) ** 2).sum(axis=1)) * (1 + centroids.SLACK)
            at = new
            cluster, upper, lower, _ = centroids.again(x, cluster, upper, lower, at, moved, groups)
            assert (cluster == ((x[:, None] - at[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


# --- whitening ---------------------------------------------------------------


def check_whitened(rows, found, count=8, exact=1e-8):
    kept = fine(rows)
    dims = [len(v) for _, v in kept]
    dim = max(set(dims), key=lambda d: (dims.count(d), d))
    kept = [(i, v) for i, v in kept if len(v) == dim]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(count, dim)
    want = centred @ axes[:, :count] / np.sqrt(np.maximum(values[:count], 1e-300))
    assert found.count() == n * count
    got = found.collect()
    key = lambda i, d: (str(i), d)
    for j in range(count):
        mine = sorted((r for r in got if r.component == j + 1), key=lambda r: (key(r.vec_id, r.deviation), r.whitened is None or abs(r.whitened)))
        if values[j] <= 1e-12 * values[0]:
            assert all(r.whitened is None and r.explained == 0 for r in mine)
            continue
        ours = np.array([r.whitened for r in mine])
        theirs = [w for _, w in sorted(zip([key(i, d) for (i, _), d in zip(kept, dev)], want[:, j]), key=lambda r: (r[0], abs(r[1])))]
        sign = 1 if np.dot(ours, theirs) >= 0 else -1
        gap = min(abs(values[j] - values[o]) for o in range(dim) if o != j) / values[0] if dim > 1 else 1
        assert np.abs(ours - sign * np.array(theirs)).max() < exact / gap
        assert all(abs(r.explained - values[j] / np.trace(cov)) < 1e-9 for r in mine)
    assert {(r.n, r.identity_error < 1e-9) for r in got} == {(n, True)}
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(dev)


@pytest.mark.parametrize("dim,seed", [(64, 1), (20, 2), (9, 3), (3, 4)])
def test_whitened_values_are_those_of_the_full_covariance(spark, dim, seed):
    rows = odd_rows(seed, dim)
    check_whitened(rows, whitening.whiten(frame(spark, rows)))


def test_no_variance_one_vector_and_none(spark):
    flat = [(i, [float(i % 5), 1.0, 2.0 * (i % 5), 7.0]) for i in range(40)]
    check_whitened(flat, whitening.whiten(frame(spark, flat)))
    one = whitening.whiten(frame(spark, [(7, [1.0, 2.0])])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(7, 1, 1, 0, None, 0.0, 0.0), (7, 2, 1, 0, None, 0.0, 0.0)]
    assert whitening.whiten(frame(spark, [(1, None), (2, [NAN])])).collect() == []
    assert whitening.fit(frame(spark, [])) is None


def test_lanczos_stops_early_and_starts_again():
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    values = np.concatenate([[50, 40, 30, 20], np.linspace(1, 0, 296)])
    full = (q * values) @ q.T
    got, axes, passes = whitening.lanczos(lambda b: full @ b, 300, 4)
    assert np.allclose(got, values[:4], rtol=1e-12) and passes < 30
    assert np.abs(np.abs((axes * q[:, :4]).sum(axis=0)) - 1).max() < 1e-12
    few = np.zeros((40, 40))
    few[:3, :3] = np.diag([3.0, 3.0, 3.0])  # the first block already spans all that has variance
    got, axes, _ = whitening.lanczos(lambda b: few @ b, 40, 8)
    assert np.allclose(got, [3, 3, 3, 0, 0, 0, 0, 0], atol=1e-12) and np.allclose(axes.T @ axes, np.eye(8), atol=1e-12)
    got, axes, _ = whitening.lanczos(lambda b: 0 * b, 5, 8)
    assert np.allclose(got, 0) and axes.shape == (5, 5)


def test_deviations_beyond_a_long():
    x = np.array([[1 << 45, 0], [0, 1 << 20], [5, 7]], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    assert list(whitening.deviations(x, 3, sums)) == [sum((3 * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]


def test_large_entries(spark):
    rows = [(i, [2.0**37 * (i % 3), float(i), 1.5]) for i in range(20)] + [(50, [2.0**39, 0.0, 0.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.n for r in got} == {20} and any(r.deviation is None for r in got)


# --- nearest neighbours ------------------------------------------------------


def nearest_of(rows, k=20, of=lambda i: i is not None and i % 20 == 0):
    rows = {(i, tuple(v)) for i, v in fine(rows) if any(v)}
    out = []
    for q, v in rows:
        if of(q):
            near = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for i, w in rows if len(w) == len(v) and i != q]
            out += [(q, rank, r[3], -r[0]) for rank, r in enumerate(sorted(near, key=lambda r: r[:3])[:k], 1)]
    return out


def got_near(df):
    return [(r.query_id, r.rank, r.vec_id, r.score) for r in df.select("query_id", "rank", "vec_id", "score").collect()]


def equal(got, want):
    strip = lambda rows: sorted(((q, r, str(i), round(s, 9)) for q, r, i, s in rows))
    assert strip(got) == strip(want)


def test_small_tables_are_searched_whole(spark):
    rows = odd_rows(8, 24)
    df = frame(spark, rows)
    equal(got_near(nearest.search(df.filter("vec_id % 20 = 0"), df)), nearest_of(rows))
    equal(got_near(nearest.search(df.filter("vec_id % 20 = 0"), df, k=3)), nearest_of(rows, 3))
    assert nearest.search(df.filter("vec_id < 0"), df).collect() == []
    assert nearest.search(df, df.limit(0)).collect() == []
    alone = frame(spark, [(20, [1.0, 2.0]), (40, [1.0]), (60, None)])
    assert nearest.search(alone, alone).collect() == []


def test_ties_and_a_hot_vector(spark):
    rows = [(i, [1.0, 0.0]) for i in range(90)] + [(100 + i, [0.0, 1.0 + i % 2]) for i in range(90)] + [(200, [1.0, 1.0])]
    df = frame(spark, rows)
    equal(got_near(nearest.search(df.filter("vec_id % 20 = 0"), df)), nearest_of(rows))


@pytest.fixture
def small_leaves(monkeypatch):
    monkeypatch.setattr(nearest, "LEAF", 64)
    monkeypatch.setattr(nearest, "VISITS", 16)
    monkeypatch.setattr(nearest, "SCAN", 8)


def recall(got, want):
    found = {(q, i) for q, _, i, _ in got}
    return sum((q, i) in found for q, _, i, _ in want) / len(want)


@pytest.mark.parametrize("clusters,dim,length", [(0, 16, 1), (30, 32, 1), (0, 12, 5), (0, 6, 1)])
def test_recall_in_many_leaves(spark, small_leaves, clusters, dim, length):
    """Even and clustered vectors, and such of very different lengths."""
    v = vectors(9, 3000, dim, clusters)
    v = v * np.random.default_rng(10).uniform(1, length, (3000, 1))
    rows = [(i, r) for i, r in enumerate(v.tolist())]
    df = frame(spark, rows)
    got = got_near(nearest.search(df.filter("vec_id % 20 = 0"), df))
    want = nearest_of(rows)
    assert recall(got, want) >= 0.9
    assert len(got) == len(want) and len({g[:2] for g in got}) == len(got)
    by = dict(rows)
    assert all(abs(s - np.dot(by[q], by[i])) < 1e-9 for q, _, i, s in got)
    for q in {g[0] for g in got}:
        mine = [(-s, i) for a, _, i, s in sorted(got, key=lambda g: g[1]) if a == q]
        assert mine == sorted(mine)


def test_queries_whose_leaves_hold_too_little_are_compared_with_all(spark, small_leaves, monkeypatch):
    monkeypatch.setattr(nearest, "_fitted", lambda *a: (1, 16))
    monkeypatch.setattr(nearest, "LEAF", 12)
    rows = [(i, r) for i, r in enumerate(vectors(11, 800, 16).tolist())]
    df = frame(spark, rows)
    equal(got_near(nearest.search(df.filter("vec_id % 20 = 0"), df)), nearest_of(rows))


def test_near_copies_beyond_a_leaf_are_met_in_blocks(spark, small_leaves):
    """More vectors than a leaf holds share their whole strings; those with the same query too."""
    rng = np.random.default_rng(12)
    base = vectors(12, 1, 16)[0]
    rows = [(i, (base + 1e-9 * rng.standard_normal(16)).tolist()) for i in range(400)] + [(1000 + i, v) for i, v in enumerate(vectors(13, 300, 16).tolist())]
    df = frame(spark, rows)
    got = got_near(nearest.search(df.filter("vec_id % 20 = 0"), df))
    assert recall(got, nearest_of(rows)) >= 0.9


def test_several_lengths_of_vectors(spark, small_leaves):
    rows = [(i, r) for i, r in enumerate(vectors(14, 400, 8).tolist())] + [(1000 + i, r) for i, r in enumerate(vectors(15, 40, 5).tolist())]
    df = frame(spark, rows)
    got, want = got_near(nearest.search(df.filter("vec_id % 20 = 0"), df)), nearest_of(rows)
    assert recall(got, want) >= 0.9
    equal([g for g in got if g[0] >= 1000], [w for w in want if w[0] >= 1000])


def test_the_queries_over_a_table(spark, tmp_path, monkeypatch):
    """The registered queries, as they are, on floats, against brute force."""
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in odd_rows(16)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int")
    df.repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    from millrace.llm import registry

    run = lambda n: next(f for k, f in registry.QUERIES.items() if k.startswith(n))(spark, str(tmp_path))
    assert got_clusters(run("op11_")) == clustered(rows)
    whitened = run("op12_")
    assert whitened.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    check_whitened(rows, whitened)
    near = run("op13_")
    assert near.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    equal(got_near(near), nearest_of(rows))
