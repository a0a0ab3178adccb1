"""Connected components by contraction of the graph.

In each round every vertex joins its neighbour of the least hash, itself
included, and the graph of what has joined is the next one: each round leaves
half of the vertices at most, and fewer where many have one neighbour alone.
Once no more than ``SMALL`` links are left, one task finishes them; a graph that
is small from the start takes one job.  Vertices then learn their component
from round to round back.

Neighbours are never gathered, and a vertex of any degree spreads over many
tasks: its least neighbour comes from partial aggregates, and the joins are of
written tables with a row for each vertex, so that Spark can split them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.shared import forget, written

#: Links that one task finishes.
SMALL = 500_000


def least_in_component(u: np.ndarray, v: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` vertices the least one of its component."""
    parent = np.arange(count)
    while len(u):
        a, b = parent[u], parent[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart = low < high
        u, v = low[apart], high[apart]
        np.minimum.at(parent, v, u)
        while not np.array_equal(further := parent[parent], parent):
            parent = further
    return parent


def _solved(links: DataFrame) -> DataFrame:
    """(node, component) of few links, in one task."""
    kind = links.schema["u"].dataType.simpleString()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(b.num_rows for b in parts):
            return
        table = pa.Table.from_batches(parts)
        ends = pa.chunked_array([*table.column("u").chunks, *table.column("v").chunks]).combine_chunks().dictionary_encode()
        names = ends.dictionary
        order = pc.sort_indices(names).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[ends.indices.to_numpy()]
        least = least_in_component(at[: len(table)], at[len(table) :], len(order))
        for start in range(0, len(order), 50_000):
            some = slice(start, start + 50_000)
            yield pa.record_batch({"node": names.take(pa.array(order[some])), "component": names.take(pa.array(order[least[some]]))})

    return links.select("u", "v").coalesce(1).mapInArrow(solve, f"node {kind}, component {kind}")


def _joining(links: DataFrame) -> DataFrame:
    """(node, into): each vertex and its neighbour of the least hash, itself included."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    key = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("x"))
    return both.groupBy(F.col("u").alias("node")).agg(F.least(F.min(key("v")), F.min(key("u")))["x"].alias("into"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each vertex that has a link, with the least vertex of its component.

    Links go both ways; loops and repeated links don't matter, and links with a
    null end are left out.  Vertices without links are not in the result.
    """
    ends = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    links = written(ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    rounds: list[tuple[DataFrame, DataFrame]] = []  # who joined whom, and the least vertex of those who joined
    while links.count() > SMALL:
        joined = written(_joining(links), "joined")
        least = joined.select("into", F.col("node").alias("x"))
        if rounds:
            least = joined.join(rounds[-1][1].select(F.col("into").alias("node"), "x"), "node").select("into", "x")
        least = written(least.groupBy("into").agg(F.min("x").alias("x")), "least")
        rounds.append((joined, least))
        one, two = (joined.select(F.col("node").alias(c), F.col("into").alias(f"{c}_into")) for c in "uv")
        left = links.join(one, "u").join(two, "v").select(F.greatest("u_into", "v_into").alias("u"), F.least("u_into", "v_into").alias("v"))
        last, links = links, written(left.filter("u <> v").distinct(), "links")
        forget(last)
    found = written(_solved(links), "components")
    if not rounds:
        return found
    # What is left has the least vertex of those who joined into it; one that lost all its links is a component.
    of = found.join(rounds[-1][1].select(F.col("into").alias("node"), "x"), "node")
    known = of.join(of.groupBy("component").agg(F.min("x").alias("least")), "component").select("node", F.col("least").alias("component"))
    for joined, least in reversed(rounds):
        by = least.join(known.withColumnRenamed("node", "into"), "into", "left").select("into", F.coalesce("component", "x").alias("component"))
        known = written(joined.join(by, "into").select("node", "component"), "known")
    return known
