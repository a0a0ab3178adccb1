"""Approximate nearest neighbours: a forest of sorted hash strings.

Each of ``TREES`` trees gives each vector a string of symbols.  A symbol says
which of eight random orthogonal directions, or their opposites, the vector
points to most, so near vectors share long prefixes.  The strings of a tree in
order are its sorted array, cut into leaves: the shortest prefixes that at most
``LEAF`` vectors share, so that prefixes are long where vectors are dense; a
prefix that the next symbol hardly parts is one leaf too, in blocks of ``LEAF``.

A query descends to the leaf of its longest matching prefix and then ascends in
all trees at once: the next leaf is always the one, of any tree, whose prefix
the query's own directions miss by the least.  Its vectors are compared
exactly, leaf by leaf, as one matrix product; no pair leaves a task but a
leaf's best.

How many leaves a query visits is fitted: ``FIT_QUERIES`` queries, those of the
least hashes, are compared with every vector, and the ascent goes on until it
would have met ``TARGET`` of their true neighbours.  Everything else, leaves
and their counts included, covers all vectors.  Where no ascent meets the
target, queries are compared with all vectors, a block of them at a time.

For the largest inner product, vectors get one coordinate more, which makes
them equally long, and queries get a zero there.

Defined results: vectors that are null, empty or all zero, or that hold null or
non-finite components, take no part.  Vectors are compared with those of their
own length.  Rows with the query's own id are its own.  Rows that agree in id
and vector count once; null ids come last among ties and are never queries'.
A query without any other row has no result.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.shared import written

TREES = 3
#: Directions of a symbol; with their opposites, 16 symbols of 4 bits.
WIDTH, BITS = 8, 4
#: Symbols of a string.
SYMBOLS = 15
#: Vectors of a leaf, and visits of it, that meet in one group.
LEAF, VISITS = 4096, 4096
#: The sample that the ascent is fitted to, and the share of its true neighbours to meet.
FIT_QUERIES, TARGET = 128, 0.95
#: Nearest prefixes of each length that a query asks for in a tree; twice as many, and again, where the sample's target isn't met.
FRONTIER, WIDEST = 64, 4096
#: A prefix is not parted further if the next symbol leaves more than this share of its vectors together.
TOGETHER = 0.75
#: Queries of an exact scan that go out at once.
SCAN = 1024


def usable(vector: Column) -> Column:
    """Whether all components are finite numbers, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


# --- inside Arrow-batched functions -----------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            yield int(dim), batch if (dims == dim).all() else batch.take(pa.array(np.flatnonzero(dims == dim)))


@lru_cache(maxsize=32)
def _directions(dim: int, tree: int) -> np.ndarray:
    """Random directions, as columns; those of a symbol are orthogonal, and so are those of as many symbols as fit."""
    rng = np.random.default_rng([17, dim, tree])
    size, need = max(WIDTH, dim + 1), SYMBOLS * WIDTH
    each = min(size // WIDTH * WIDTH, need)
    parts = [np.linalg.qr(rng.standard_normal((size, each)))[0] for _ in range(-(-need // each))]
    return np.concatenate(parts, axis=1)[:, :need]


def _strings(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The string of each vector in each tree, as an integer."""
    n, dim = vectors.shape
    whole = np.zeros((n, max(WIDTH, dim + 1)))
    whole[:, :dim] = vectors / longest
    whole[:, dim] = np.sqrt(np.maximum(0, 1 - (whole * whole).sum(axis=1)))
    out = np.zeros((n, TREES), np.int64)
    for tree in range(TREES):
        parts = (whole @ _directions(dim, tree)).reshape(n, SYMBOLS, WIDTH)
        most = np.abs(parts).argmax(axis=2)
        signs = np.take_along_axis(parts, most[:, :, None], axis=2)[:, :, 0] > 0
        for symbol in range(SYMBOLS):
            out[:, tree] = (out[:, tree] << BITS) | (2 * most[:, symbol] + signs[:, symbol])
    return out


def _ascent(vectors: np.ndarray, tree: int, low: int, high: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each prefix length from low to high the ``most`` prefixes nearest each query, and what the query misses them by."""
    n, dim = vectors.shape
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    parts = (unit @ _directions(dim, tree)[:dim]).reshape(n, SYMBOLS, WIDTH)
    paths, misses = np.ones((n, 1), np.int64), np.zeros((n, 1))
    if low == 0:
        yield paths, misses
    for level in range(1, high + 1):
        both = np.stack([-parts[:, level - 1], parts[:, level - 1]], axis=2).reshape(n, 2 * WIDTH)
        miss = both.max(axis=1, keepdims=True) - both
        misses = (misses[:, :, None] + miss[:, None, :]).reshape(n, -1)
        paths = ((paths << BITS)[:, :, None] | np.arange(2 * WIDTH)[None, None, :]).reshape(n, -1)
        if misses.shape[1] > most:
            best = np.argpartition(misses, most - 1, axis=1)[:, :most]
            misses, paths = np.take_along_axis(misses, best, axis=1), np.take_along_axis(paths, best, axis=1)
        if level >= low:
            yield paths, misses


def inner(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of equal rows, added from the first component to the last: the same for a pair wherever it is met."""
    total = np.zeros(len(left))
    for k in range(left.shape[1]):
        total += left[:, k] * right[:, k]
    return total


def _best(queries: np.ndarray, vectors: np.ndarray, nodes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the vectors of largest inner product, ties to the smaller node: numbers of both, scores."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    lengths = np.sqrt((vectors * vectors).sum(axis=1)).max(initial=0)
    for start in range(0, len(queries), 256):
        block = queries[start : start + 256]
        scores = block @ vectors.T
        if len(vectors) > most:
            least = np.partition(scores, len(vectors) - most, axis=1)[:, len(vectors) - most]
            least = least - 8 * block.shape[1] * np.finfo(float).eps * lengths * np.sqrt((block * block).sum(axis=1))
            q, v = np.nonzero(~(scores < least[:, None]))
        else:
            q, v = (x.ravel() for x in np.indices(scores.shape))
        exact = inner(block[q], vectors[v])
        order = np.lexsort((nodes[v], -exact, q))
        q, v, exact = q[order], v[order], exact[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < most
        found.append((q[keep] + start, v[keep], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


# --- the index ---------------------------------------------------------------


def _nodes(rows: DataFrame, most: int) -> DataFrame:
    """One row for equal vectors with their ``most`` least ids: no query needs more of them."""
    v = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    few = rows.withColumn("place", F.dense_rank().over(v)).filter(F.col("place") <= most)
    ids = F.array_sort(F.collect_set(F.struct(F.col("id").isNull().alias("no_id"), "id")))
    nodes = few.groupBy("v").agg(ids.alias("ids")).orderBy("ids")
    # numbers in the order of ids, so that ties of scores go by them
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), F.size("v").alias("dim"), "v", "ids")
    return written(nodes, "nearest-nodes")


def _indexed(nodes: DataFrame, longest: dict[int, float]) -> DataFrame:
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, batch in _by_dim(batches):
            of = _strings(_matrix(batch.column("v"), dim), longest[dim])
            yield pa.record_batch({"node": batch.column("node"), "dim": batch.column("dim"), "strings": pa.array(list(of), pa.list_(pa.int64()))})

    return written(nodes.select("node", "dim", "v").mapInArrow(strings, "node long, dim int, strings array<long>"), "nearest-strings")


def _path(string: Column, level: Column) -> Column:
    """The prefix of a length, behind a one so that lengths differ."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (level * BITS).cast("int")).bitwiseOR(
        F.call_function("shiftright", string, ((F.lit(SYMBOLS) - level) * BITS).cast("int")))


def _leaves(strings: DataFrame, totals: dict[int, int]) -> tuple[DataFrame, int, int]:
    """The prefixes that make up each tree: (dim, tree, path, blocks), and their least and greatest length."""
    spark = strings.sparkSession
    small = [(dim, 0, 1, 1) for dim, n in totals.items() if n <= LEAF]
    parts = [spark.createDataFrame(small, "dim int, tree int, path long, blocks int")]
    wide, low, level = [dim for dim, n in totals.items() if n > LEAF], 0 if small else None, 0
    key, above = ["dim", "tree", "path"], F.call_function("shiftright", "path", F.lit(BITS))
    over = spark.createDataFrame([(dim, tree, 1, totals[dim]) for dim in wide for tree in range(TREES)], "dim int, tree int, path long, count long")
    at = strings.select("dim", F.posexplode("strings").alias("tree", "string"))
    while wide:
        level += 1
        counts = at.groupBy("dim", "tree", _path(F.col("string"), F.lit(level)).alias("path")).count()
        counts = written(counts.withColumn("above", above).join(over.select("dim", "tree", F.col("path").alias("above")), ["dim", "tree", "above"], "left_semi"), "nearest-counts")
        most = counts.groupBy("dim", "tree", F.col("above").alias("path")).agg(F.max("count").alias("most"))
        over = written(over.join(most, key).withColumn("whole", F.col("most") > TOGETHER * F.col("count")), "nearest-over")
        whole = over.filter("whole").select(*key, F.ceil(F.col("count") / LEAF).cast("int").alias("blocks"))
        counts = counts.join(over.filter("whole").select("dim", "tree", F.col("path").alias("above")), ["dim", "tree", "above"], "left_anti")
        done = counts if level == SYMBOLS else counts.filter(F.col("count") <= LEAF)
        parts += [whole, done.select(*key, F.ceil(F.col("count") / LEAF).cast("int").alias("blocks"))]
        over = counts.filter(F.col("count") > LEAF).select(*key, "count")
        if low is None and not whole.isEmpty():
            low = level - 1
        if low is None and not done.isEmpty():
            low = level
        if level == SYMBOLS or over.isEmpty():
            break
    leaves = parts[0]
    for part in parts[1:]:
        leaves = leaves.unionByName(part)
    return written(leaves, "nearest-leaves"), low or 0, level


def _placed(strings: DataFrame, leaves: DataFrame, low: int, high: int) -> DataFrame:
    """The leaf of each row in each tree."""
    at = strings.select("*", F.posexplode("strings").alias("tree", "string")).drop("strings")
    at = at.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("level"))
    return at.withColumn("path", _path(F.col("string"), F.col("level"))).drop("string", "level").join(leaves, ["dim", "tree", "path"])


def _frontier(asked: DataFrame, leaves: DataFrame, low: int, high: int, most: int) -> DataFrame:
    """The leaves in the order in which each query comes to them (place, from 1)."""

    def ascent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, batch in _by_dim(batches):
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                vectors, own = _matrix(part.column("v"), dim), part.column("asked").to_numpy()
                for tree in range(TREES):
                    for paths, misses in _ascent(vectors, tree, low, high, most):
                        each, n = np.repeat(own, paths.shape[1]), paths.size
                        yield pa.record_batch({"asked": each, "dim": np.full(n, dim, np.int32), "tree": np.full(n, tree, np.int32), "path": paths.ravel(), "miss": misses.ravel()})

    at = asked.select("asked", "dim", "v").mapInArrow(ascent, "asked long, dim int, tree int, path long, miss double")
    order = Window.partitionBy("asked").orderBy("miss", "tree", "path")
    return at.join(leaves, ["dim", "tree", "path"]).withColumn("place", F.row_number().over(order))


# --- the search --------------------------------------------------------------


def _scanned(nodes: DataFrame, queries: list, most: int) -> DataFrame:
    """(asked, node, score): the best of all nodes for a few queries, found by comparing with every one."""
    by: dict[int, list] = {}
    for q in queries:
        by.setdefault(q.dim, []).append(q)
    sent = {dim: (np.array([q.asked for q in some]), np.array([q.v for q in some], float)) for dim, some in by.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, batch in _by_dim(batches):
            if dim in sent:
                own, vectors = sent[dim]
                number = batch.column("node").to_numpy()
                q, v, score = _best(vectors, _matrix(batch.column("v"), dim), number, most)
                yield pa.record_batch({"asked": own[q], "node": number[v], "score": score})

    found = nodes.select("node", "dim", "v").mapInArrow(scan, "asked long, node long, score double")
    order = Window.partitionBy("asked").orderBy(F.col("score").desc(), "node")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def _fitted(asked: DataFrame, nodes: DataFrame, strings: DataFrame, leaves: DataFrame, low: int, high: int, k: int) -> tuple[int, int]:
    """The leaves to visit, and the prefixes to ask for, so that the sample meets ``TARGET`` of its true neighbours; zeros if none do."""
    if high == 0:
        return 1, 1
    sample = asked.orderBy(F.xxhash64("v"), "asked").limit(FIT_QUERIES).collect()
    few = asked.sparkSession.createDataFrame([(q.asked, q.dim, list(q.v)) for q in sample], "asked long, dim int, v array<double>")
    true = _scanned(nodes, sample, k + 1).join(nodes.select("node", F.col("v").cast("array<double>").alias("w")), "node")
    true = true.join(few.select("asked", "v"), "asked").filter(F.col("v") != F.col("w")).select("asked", "node")
    true = written(_placed(true.join(strings, "node"), leaves, low, high).select("asked", "node", "dim", "tree", "path"), "nearest-true")
    wide = FRONTIER
    while True:
        order = _frontier(few, leaves, low, high, wide).select("asked", "dim", "tree", "path", "place")
        met = true.join(order, ["asked", "dim", "tree", "path"], "left").groupBy("asked", "node").agg(F.min("place").alias("place"))
        places = sorted(r.place or 1 << 31 for r in met.select("place").collect())  # FIT_QUERIES * (k + 1) at most
        if not places:
            return 1, wide
        need = places[max(0, int(np.ceil(TARGET * len(places))) - 1)]
        if need < 1 << 31:
            return need, wide
        if wide >= min(WIDEST, (2 * WIDTH) ** high):
            return 0, 0
        wide *= 2


def _met(asked: DataFrame, nodes: DataFrame, strings: DataFrame, leaves: DataFrame, low: int, high: int, visits: int, wide: int, most: int) -> DataFrame:
    """(asked, node, score): the best of each leaf that a query visits."""
    key = ["dim", "tree", "path"]
    order = _frontier(asked, leaves, low, high, wide).filter(F.col("place") <= visits)
    order = written(order.select("asked", *key, "blocks"), "nearest-visits")
    load = order.groupBy(*key).agg(F.ceil(F.count("*") / VISITS).cast("int").alias("parts"))
    number = lambda name, of: F.pmod(F.xxhash64(name), F.col(of)).cast("int")
    # places of vectors first, without the vectors
    places = _placed(strings, leaves, low, high).join(load, key).withColumn("block", number("node", "blocks"))
    places = places.groupBy("node").agg(F.collect_list(F.struct("tree", "path", "block", "parts")).alias("at"))  # one for each tree at most
    left = nodes.select("node", "dim", "v").join(places, "node").select("node", "dim", "v", F.explode("at").alias("at"))
    left = left.select("node", "dim", "v", "at.tree", "at.path", "at.block", F.explode(F.sequence(F.lit(0), F.col("at.parts") - 1)).alias("part"))
    right = order.join(load, key).withColumn("part", number("asked", "parts"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "parts")
    right = right.join(asked.select("asked", "v"), "asked")
    group = [*key, "block", "part"]

    def compare(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not (len(vectors) and len(queries)):
            return pa.table({"asked": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        dim = vectors.column("dim")[0].as_py()
        number, own = vectors.column("node").to_numpy(), queries.column("asked").to_numpy()
        q, v, score = _best(_matrix(queries.column("v"), dim), _matrix(vectors.column("v"), dim), number, most)
        return pa.table({"asked": own[q], "node": number[v], "score": score})

    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(compare, "asked long, node long, score double")
    best = Window.partitionBy("asked").orderBy(F.col("score").desc(), "node")  # a node met in several trees has one rank
    return found.withColumn("place", F.dense_rank().over(best)).filter(F.col("place") <= most).drop("place").distinct()


def search(queries: DataFrame, rows: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest inner product for each query, found by the forest: query_id, rank, ``id_col``, score."""
    of = lambda df: df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(usable(F.col("v")))
    spark, most = rows.sparkSession, k + 1  # one may be the query's own
    wanted = of(queries).distinct()
    asked = written(wanted.select("v").distinct().select(F.monotonically_increasing_id().alias("asked"), F.size("v").alias("dim"), "v"), "nearest-asked")
    nodes = _nodes(of(rows), most)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    about = nodes.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("rows"), F.max(length).alias("longest")).collect()  # one row for each length of vectors
    strings = _indexed(nodes, {r.dim: r.longest for r in about})
    leaves, low, high = _leaves(strings, {r.dim: r.n for r in about})
    visits, wide = _fitted(asked, nodes, strings, leaves, low, high, k)
    if visits:
        hits = written(_met(asked, nodes, strings, leaves, low, high, visits, wide, most), "nearest-hits")
    else:
        hits = spark.createDataFrame([], "asked long, node long, score double")
    found = _with_ids(hits, nodes, most)
    # those whose leaves hold too few rows are compared with all
    enough = F.create_map(*[F.lit(x) for r in about for x in (r.dim, min(most, r.rows))]) if about else F.create_map(F.lit(0), F.lit(0))
    short = asked.join(found, "asked", "left").filter(F.coalesce(F.size("near"), F.lit(0)) < F.coalesce(enough[F.col("dim")], F.lit(0))).select("asked", "dim", "v")
    short = written(short, "nearest-short")
    if not short.isEmpty():
        found = found.join(short, "asked", "left_anti").unionByName(_all_scanned(short, nodes, most))
    near = wanted.join(asked, "v").join(found, "asked")
    near = near.select(F.col("id").alias("query_id"), F.slice(F.filter("near", lambda x: ~x.id.eqNullSafe(F.col("id"))), 1, k).alias("near"))
    near = near.select("query_id", F.posexplode("near").alias("place", "hit"))
    return near.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias(id_col), (-F.col("hit.less")).alias("score"))


def _with_ids(hits: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """The rows that a query's nodes stand for, nearest first."""
    at = hits.join(nodes.select("node", "ids"), "node")
    each = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("less"), i.no_id, i.id))
    return at.groupBy("asked").agg(F.slice(F.array_sort(F.flatten(F.collect_list(each))), 1, most).alias("near"))


def _all_scanned(short: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """Exact results of few queries, in blocks of queries against all nodes."""
    blocks = short.count() // SCAN + 1
    found = None
    for block in range(blocks):
        some = short.filter(F.pmod(F.xxhash64("asked"), F.lit(blocks)) == block).collect()  # about SCAN
        if some:
            part = written(_with_ids(_scanned(nodes, some, most), nodes, most), "nearest-scanned")
            found = part if found is None else found.unionByName(part)
    return found


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings for each whose id is divisible by 20."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = search(rows.filter(F.col("vec_id") % 20 == 0), rows)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


#: All pairs of queries and rows.  Equal where every query visits all leaves, as on small tables.
OP13_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v, len(embedding) AS dim FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, e.vec_id, list_inner_product(q.v, e.v) AS score
  FROM e q JOIN e ON q.dim = e.dim AND q.vec_id IS DISTINCT FROM e.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 20
"""
