"""Centroid clustering with Yinyang bounds.

Centroids are put into groups once.  Each vector keeps its cluster, an upper
bound of the distance to its centroid, and for each group a lower bound of the
distance to the group's other centroids.  After centroids have moved, bounds
move by as much.  A vector whose upper bound is under all its lower bounds stays
(global filter); else its own distance is computed and compared again; then
only groups whose lower bound is not above it are looked at (group filter), and
in these the centroids that their own movement may have brought near enough,
with exact distances.  Vectors and centroids are integers, so distances are
exact; bounds are rounded outwards, and a tie never passes a filter.

The state of a round is a table in the shared folder, which the next round reads
and then deletes, so a lost executor costs no earlier round.  Only vectors that
changed their cluster are added up: Spark sums their components, and the driver
holds the centroids and their sums alone.

Defined results: vectors that are null, of another length, or hold null or
non-finite components or one beyond 2^16 (whose squared distances might not fit
a long) are not kept.  Repeated rows count as often as they are there.  Rows
with null ids are clustered, but start no centroid before others do; equal ids
start in the order of their vectors.  Fewer vectors than centroids give fewer
centroids; none give no rows.  A cluster without vectors keeps its centroid.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.shared import forget, written

SCALE = 1024
LARGEST = float(1 << 16)
#: By this share bounds are rounded outwards.
SLACK = 1e-9


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` components, all of them numbers in range."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))
    return F.coalesce(fine & (F.size(vector) == dim), F.lit(False))


# --- inside Arrow-batched functions -----------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32) if width else np.zeros(rows + 1, np.int32)), pa.array(matrix.ravel()))


def _squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = x - centroid
    return (apart * apart).sum(axis=1)


def first(x: np.ndarray, centroids: np.ndarray, groups: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cluster, upper bound, lower bounds and number of distances, with all distances computed."""
    all_of = np.stack([_squared(x, c) for c in centroids], axis=1)
    cluster = all_of.argmin(axis=1)
    far = np.sqrt(all_of.astype(float))
    upper = far[np.arange(len(x)), cluster] * (1 + SLACK)
    far[np.arange(len(x)), cluster] = np.inf
    lower = np.stack([far[:, g].min(axis=1) for g in groups], axis=1) * (1 - SLACK)
    return cluster, upper, lower, np.full(len(x), len(centroids))


def again(
    x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, moved: np.ndarray, groups: list[list[int]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same after centroids moved by ``moved``, with the distances alone that the bounds don't settle."""
    group_of = {j: g for g, members in enumerate(groups) for j in members}
    own_group = np.array([group_of[j] for j in range(len(centroids))])
    before = lower
    lower = lower - np.array([moved[g].max() for g in groups])
    upper = upper + moved[cluster]
    cluster, scans = cluster.copy(), np.zeros(len(x), np.int64)
    open_rows = np.flatnonzero(upper >= lower.min(axis=1))  # global filter
    best = np.zeros(len(x), np.int64)
    for j in range(len(centroids)):
        rows = open_rows[cluster[open_rows] == j]
        best[rows] = _squared(x[rows], centroids[j])
    scans[open_rows] += 1
    upper[open_rows] = np.sqrt(best[open_rows].astype(float)) * (1 + SLACK)
    open_rows = open_rows[upper[open_rows] >= lower[open_rows].min(axis=1)]
    start, start_best = cluster.copy(), best.copy()  # the bounds so far leave these out
    for g, members in enumerate(groups):
        rows = open_rows[upper[open_rows] >= lower[open_rows, g]]  # group filter
        if not len(rows):
            continue
        near = np.empty((len(rows), len(members)))  # bounds of distances to each member, exact ones where computed
        for m, j in enumerate(members):
            near[:, m] = before[rows, g] - moved[j]
            mine = start[rows] == j
            look = np.flatnonzero(~mine & (near[:, m] <= upper[rows]))  # surviving centroids
            at = rows[look]
            apart = _squared(x[at], centroids[j])
            scans[at] += 1
            near[look, m] = np.sqrt(apart.astype(float)) * (1 - SLACK)
            near[mine, m] = np.sqrt(start_best[rows[mine]].astype(float)) * (1 - SLACK)
            wins = (apart < best[at]) | ((apart == best[at]) & (j < cluster[at]))
            won = at[wins]
            other = own_group[cluster[won]] != g  # the one left behind, in a group that this loop doesn't set
            left = won[other]
            lower[left, own_group[cluster[left]]] = np.minimum(lower[left, own_group[cluster[left]]], np.sqrt(best[left].astype(float)) * (1 - SLACK))
            cluster[won], best[won] = j, apart[wins]
            upper[won] = np.sqrt(best[won].astype(float)) * (1 + SLACK)
        near[np.equal.outer(cluster[rows], np.array(members))] = np.inf
        lower[rows, g] = near.min(axis=1)
    return cluster, upper, lower, scans


# --- rounds ------------------------------------------------------------------


def grouped(centroids: np.ndarray, count: int) -> list[list[int]]:
    """The centroids in ``count`` groups at most, by a few rounds of clustering among themselves."""
    middles = centroids[np.linspace(0, len(centroids) - 1, count).astype(int)].astype(float)
    for _ in range(5):
        at = ((centroids[:, None, :] - middles[None]) ** 2).sum(axis=2).argmin(axis=1)
        middles = np.array([centroids[at == g].mean(axis=0) if (at == g).any() else middles[g] for g in range(count)])
    return [list(map(int, np.flatnonzero(at == g))) for g in range(count) if (at == g).any()]


def _round(state: DataFrame, centroids: np.ndarray, moved: np.ndarray | None, groups: list[list[int]], last: bool) -> DataFrame:
    """The table after one assignment; the first one, where ``moved`` is None, makes the bounds."""
    dim, id_kind = centroids.shape[1], state.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if moved is None:
                x = np.floor(_matrix(batch.column("v"), dim).astype(np.float64) * SCALE).astype(np.int64)
                was, scans = np.full(len(x), -1), 0
                cluster, upper, lower, more = first(x, centroids, groups)
            else:
                x = _matrix(batch.column("x"), dim).astype(np.int64)
                was, scans = batch.column("cluster").to_numpy().astype(np.int64), batch.column("scans").to_numpy()
                upper, lower = batch.column("upper").to_numpy().copy(), _matrix(batch.column("lower"), len(groups))
                cluster, upper, lower, more = again(x, was, upper, lower, centroids, moved, groups)
            distance = np.zeros(len(x), np.int64)
            if last:
                for j in range(len(centroids)):
                    distance[cluster == j] = _squared(x[cluster == j], centroids[j])
            yield pa.record_batch({
                "id": batch.column("id"), "x": _lists(x.astype(np.int32)), "cluster": cluster.astype(np.int32), "was": was.astype(np.int32), "changed": cluster != was,
                "upper": upper, "lower": _lists(lower), "scans": scans + more, "distance": distance,
            })

    return state.mapInArrow(assign, f"id {id_kind}, x array<int>, cluster int, was int, changed boolean, upper double, lower array<double>, scans long, distance long")


def _changes(state: DataFrame, clusters: int, dim: int) -> tuple[list[int], list[list[int]]]:
    """By how much the counts and the sums of the clusters' vectors have changed."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((clusters, dim + 1), np.int64)
        for batch in batches:
            x = np.column_stack([_matrix(batch.column("x"), dim).astype(np.int64), np.ones(batch.num_rows, np.int64)])
            for name, sign in (("cluster", 1), ("was", -1)):
                at = batch.column(name).to_numpy()
                for j in np.unique(at[at >= 0]):
                    total[j] += sign * x[at == j].sum(axis=0)
        full = np.argwhere(total)
        yield pa.record_batch({"j": full[:, 0].astype(np.int32), "i": full[:, 1].astype(np.int32), "part": total[full[:, 0], full[:, 1]]})

    parts = state.filter("changed").select("x", "cluster", "was").mapInArrow(add, "j int, i int, part long")
    counts, sums = [0] * clusters, [[0] * dim for _ in range(clusters)]
    for r in parts.groupBy("j", "i").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():  # clusters * (dim + 1) at most
        if r.i == dim:
            counts[r.j] = int(r.total)
        else:
            sums[r.j][r.i] = int(r.total)
    return counts, sums


def cluster(
    rows: DataFrame, clusters: int = 8, rounds: int = 10, dim: int = 64, groups: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding", seed: str = "3:"
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and scans (the distances computed over all rounds)."""
    kept = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(usable(F.col("v"), dim))
    key = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    start = kept.orderBy(key.asc_nulls_last(), "v").limit(clusters).collect()
    kind = kept.schema["id"].dataType.simpleString()
    if not start:
        return rows.sparkSession.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, scans long")
    centroids = np.array([[math.floor(SCALE * float(c)) for c in r.v] for r in start], np.int64)
    parts = grouped(centroids, min(len(centroids), groups or -(-len(centroids) // 4)))
    counts, sums, state, moved = [0] * len(centroids), [[0] * dim for _ in centroids], kept, None
    for number in range(rounds + 1):
        made = written(_round(state, centroids, moved, parts, number == rounds), f"clusters-{number}")
        if moved is not None:
            forget(state)
        state = made
        if number == rounds:
            break
        more, further = _changes(state, len(centroids), dim)
        counts = [a + b for a, b in zip(counts, more)]
        sums = [[a + b for a, b in zip(*pair)] for pair in zip(sums, further)]
        new = np.array([[s // n for s in total] if n else list(old) for n, total, old in zip(counts, sums, centroids.tolist())], np.int64)
        moved = np.sqrt(((new - centroids) ** 2).sum(axis=1).astype(float)) * (1 + SLACK)
        centroids = new
    found = state.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row a cluster
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = [(r.cluster, r.cluster_inertia, sum(x.cluster_inertia for x in found), hashes[r.cluster]) for r in found]
    about = rows.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = state.join(F.broadcast(about), "cluster")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scans")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all embeddings after ten rounds."""
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("scans")


def _sql(clusters: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """All distances in each round."""
    steps = [f"""k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS j, x AS c
  FROM (SELECT x, sha256('3:' || vec_id) AS h FROM k ORDER BY h NULLS LAST, x LIMIT {clusters}))"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min(struct_pack(d := d, j := j)) AS b
  FROM (SELECT r, vec_id, x, j, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM k, c{n})
  GROUP BY r)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c{n}.j, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN (
    SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
      SELECT b.j AS j, i, sum(x[i]) AS s, count(*) AS n FROM a{n}, range(1, {dim + 1}) t(i) GROUP BY b.j, i) GROUP BY j) m USING (j))""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, a.b.j AS cluster, a.b.d AS distance, CAST(sum(a.b.d) OVER (PARTITION BY a.b.j) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.b.j = c.j"""


OP11_SQL = _sql()
