"""Islands: connected components of a relation's two-sided graph.

Sources and targets are vertices of their own, even where both have one type.
Only edges between known nodes count, so island sizes add up to all nodes.
Nodes without edges are islands of one; they aren't iterated over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import relations
from millrace.operators.components import connected_components
from millrace.shared import written


def components(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(relation, side, uuid, island): ``island`` is the least tagged id of the component."""
    members = members.select("relation", "side", "uuid").distinct()
    tagged = lambda side, c: F.concat_ws("\x1f", "relation", F.lit(side), c)
    known = members.select(F.concat_ws("\x1f", "relation", "side", "uuid").alias("known"))
    ends = pairs.select(tagged("s", "s").alias("a"), tagged("t", "t").alias("b"))
    ends = ends.join(known, F.col("a") == F.col("known"), "left_semi").join(known, F.col("b") == F.col("known"), "left_semi")
    found = connected_components(ends)
    tag = F.concat_ws("\x1f", "relation", "side", "uuid")
    return members.join(found, tag == F.col("node"), "left").select(
        "relation", "side", "uuid", F.coalesce("component", tag).alias("island")
    )


def _members_of(links: DataFrame, roles: DataFrame, linked: bool = False) -> DataFrame:
    """(relation, side, uuid, degree, component) of all members, by numbers of ``relations.numbered_links`` or ``numbered_pairs``;
    if ``linked``, of those with an edge to a member alone.

    Every node of the side that has more of them joins its least neighbour at once, which leaves no links of stars; the
    links from these least ones to other neighbours connect what is left, nodes of the smaller side.
    """
    t_less = relations.role_totals(roles).groupBy("relation").agg(
        (F.sum(F.when(F.col("side") == "t", F.col("total_nodes")).otherwise(-F.col("total_nodes"))) < 0).alias("t_less")
    )
    known = links.join(F.broadcast(t_less), "relation")
    end = lambda v, other, low: F.struct(F.col(v).alias("v"), F.col(other).isNotNull().alias("met"), F.expr(low).alias("low"))
    ends = F.array(end("sv", "tv", "if(t_less, tv, null)"), end("tv", "sv", "if(t_less, null, sv)"))
    each = known.select("n", F.explode(ends).alias("x")).filter("x.v IS NOT NULL")
    found = each.groupBy("x.v").agg(F.sum("n").alias("degree"), F.min("x.low").alias("least"), F.max("x.low").alias("most"), F.max("x.met").alias("met"))
    nodes = written(found, "nodes")
    high = nodes.filter("least < most").select(F.col("v").alias("high"), "least")
    both = known.filter("sv IS NOT NULL AND tv IS NOT NULL").select(F.expr("if(t_less, tv, sv)").alias("low"), F.expr("if(t_less, sv, tv)").alias("high"))
    found = connected_components(both.join(high, "high").filter("low <> least").select("low", "least"), "low", "least")
    of = relations.vertices(roles)
    rows = of.join(nodes.filter("met"), "v") if linked else of.join(nodes, "v", "left")
    rows = rows.withColumn("root", F.coalesce("least", "v"))
    rows = rows.join(found, F.col("root") == F.col("node"), "left")
    return rows.select("relation", "side", "uuid", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("component", "root").alias("component"))


def components_of(links: DataFrame, roles: DataFrame) -> DataFrame:
    """``components`` of ``relations.numbered_links``."""
    rows = written(_members_of(links, roles).drop("degree"), "members")
    names = rows.groupBy("component").agg(F.min(F.concat_ws("\x1f", "relation", "side", "uuid")).alias("island"))
    return rows.join(names, "component").select("relation", "side", "uuid", "island")


def counts_of(links: DataFrame, roles: DataFrame) -> DataFrame:
    """(relation, size_total, size_source, size_target) of each island of ``relations.numbered_links``, without its name."""
    return _members_of(links, roles).groupBy("component", "relation").agg(*_counts()).drop("component")


def _counts() -> list[Column]:
    each = {"total": F.count("*"), "source": F.count_if(F.col("side") == "s"), "target": F.count_if(F.col("side") == "t")}
    return [c.alias(f"size_{name}") for name, c in each.items()]


def sizes(islands: DataFrame, degree_rows: DataFrame) -> DataFrame:
    """Per (relation, island): size_total, size_source, size_target and the top node of either side,
    by degree, then id; no top node where a side has none."""
    rows = islands.join(degree_rows, ["relation", "side", "uuid"], "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    return _sizes(rows, ["relation", "island"])


def sizes_of(links: DataFrame, roles: DataFrame) -> DataFrame:
    """``sizes`` of ``relations.numbered_links``."""
    return _named(_members_of(links, roles))


def linked_sizes_of(links: DataFrame, roles: DataFrame) -> DataFrame:
    """``sizes_of`` without islands of one; ``relations.role_totals`` tell how many nodes these leave out."""
    return _named(_members_of(links, roles, linked=True))


def _named(rows: DataFrame) -> DataFrame:
    tag = F.concat_ws("\x1f", "relation", "side", "uuid")
    return _sizes(rows, ["component", "relation"], F.min(tag).alias("island"))


def _sizes(rows: DataFrame, by: list[str], *names: Column) -> DataFrame:
    best = lambda side: F.min(
        F.when(F.col("side") == side, F.struct((-F.col("degree")).alias("d"), F.col("uuid")))
    )
    found = rows.groupBy(*by).agg(*names, *_counts(), best("s").alias("bs"), best("t").alias("bt"))
    return found.select(
        "relation", "island", "size_total", "size_source", "size_target",
        F.col("bs.uuid").alias("top_source_uuid"), (-F.col("bs.d")).alias("top_source_degree"),
        F.col("bt.uuid").alias("top_target_uuid"), (-F.col("bt.d")).alias("top_target_degree"),
    )


def _with_single(counts: DataFrame, by: list[str], totals: DataFrame) -> DataFrame:
    """The counts of ``linked_sizes_of`` with the nodes of ``totals`` (by, total_nodes) that are in none: islands of one."""
    own = totals.groupBy(*by).agg(F.sum("total_nodes").cast("bigint").alias("all")).join(counts, by, "left")
    known = lambda c: F.coalesce(c, F.lit(0))
    single = F.col("all") - known("total_nodes")
    return own.select(
        *by, F.col("all").alias("total_nodes"), (known("total_islands") + single).alias("total_islands"),
        (known("singleton_islands") + single).alias("singleton_islands"),
    )


def summary(island_sizes: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Per relation: total_nodes, total_islands, singleton_islands of the whole graph.

    With ``totals``, the ``relations.role_totals``, the sizes may be those of ``linked_sizes_of``; so in the functions below.
    """
    counts = island_sizes.groupBy("relation").agg(
        F.sum("size_total").cast("bigint").alias("total_nodes"),
        F.count("*").alias("total_islands"),
        F.count_if(F.col("size_total") == 1).alias("singleton_islands"),
    )
    return counts if totals is None else _with_single(counts, ["relation"], totals)


def multi_islands(island_sizes: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Islands of several nodes, with fraction_total, the share of the relation's nodes."""
    totals = summary(island_sizes, totals).select("relation", "total_nodes")
    return island_sizes.filter("size_total > 1").join(totals, "relation").withColumn(
        "fraction_total", F.col("size_total") / F.col("total_nodes")
    )


def side_islands(island_sizes: DataFrame) -> DataFrame:
    """(relation, side, island, size, size_total, top_uuid, top_degree) of each island that has nodes on the side."""
    sides = F.array(
        *[
            F.struct(
                F.lit(tag).alias("side"), F.col(f"size_{name}").alias("size"),
                F.col(f"top_{name}_uuid").alias("top_uuid"), F.col(f"top_{name}_degree").alias("top_degree"),
            )
            for tag, name in (("s", "source"), ("t", "target"))
        ]
    )
    return (
        island_sizes.select("relation", "island", "size_total", F.explode(sides).alias("x"))
        .select("relation", "x.side", "island", "x.size", "size_total", "x.top_uuid", "x.top_degree")
        .filter("size > 0")
    )


def side_summary(of_side: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Per (relation, side): total_nodes, total_islands, singleton_islands."""
    counts = of_side.groupBy("relation", "side").agg(
        F.sum("size").cast("bigint").alias("total_nodes"),
        F.count("*").alias("total_islands"),
        F.count_if(F.col("size") == 1).alias("singleton_islands"),
    )
    return counts if totals is None else _with_single(counts, ["relation", "side"], totals)


def both_summaries(counts: DataFrame) -> DataFrame:
    """``side_summary`` from the sizes of islands on both sides."""
    own = counts.groupBy("relation").agg(
        *[
            F.struct(
                F.lit(tag).alias("side"), F.sum(f"size_{name}").cast("bigint").alias("total_nodes"),
                F.count_if(F.col(f"size_{name}") > 0).alias("total_islands"), F.count_if(F.col(f"size_{name}") == 1).alias("singleton_islands"),
            ).alias(tag)
            for tag, name in (("s", "source"), ("t", "target"))
        ]
    )
    return own.select("relation", F.explode(F.array("s", "t")).alias("x")).select("relation", "x.*").filter("total_islands > 0")


def side_multi(of_side: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Islands with several nodes of the side, with their share of its nodes."""
    totals = side_summary(of_side, totals).select("relation", "side", "total_nodes")
    return of_side.filter("size > 1").join(totals, ["relation", "side"]).withColumn(
        "fraction", F.col("size") / F.col("total_nodes")
    )
