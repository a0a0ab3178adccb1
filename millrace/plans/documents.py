"""The full document of each relation: metadata, statistics, degrees, top nodes, islands and attributes.

Lists in a document are for reading: they hold the first ``most`` islands and
parallel pairs.  ``relation_lists`` has them whole, as tables of ranked entries,
in the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import islands, relations
from millrace.operators.ranks import ranked
from millrace.shared import written


def _listed(rows: DataFrame, by: list[str], order: list[Column], entry: Column, name: str, most: int) -> DataFrame:
    """(by, name): of each group the first ``most`` entries, in order."""
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("nth") <= most)
    lists = first.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("nth", entry.alias("entry")))).alias(name))
    return lists.withColumn(name, F.transform(name, lambda x: x["entry"]))


def _by_side(rows: DataFrame, columns: list[str], names: dict[str, str]) -> DataFrame:
    """A column for each side of each of ``columns``; ``names`` are their prefixes."""
    return rows.groupBy("relation").agg(
        *[F.first(F.when(F.col("side") == s, F.col(c)), ignorenulls=True).alias(f"{p}_{c}") for s, p in names.items() for c in columns]
    )


def relation_lists(edge_rows: DataFrame, members: DataFrame) -> dict[str, DataFrame]:
    """The whole lists of all relations, an entry a row, with its ``rank`` from 1 in its list: ``multi_islands`` (by
    relation), ``side_islands`` (by relation and side) and ``parallel_pairs`` (by relation)."""
    roles = relations.numbered_roles(members)
    pairs = written(relations.bare(relations.numbered_pairs(edge_rows, roles), several=True), "pairs")
    found = written(islands.linked_sizes_of(pairs, roles), "islands")
    totals = written(relations.role_totals(roles), "totals")
    return {
        "multi_islands": ranked(islands.multi_islands(found, totals).drop("total_nodes"), ["relation"], [F.desc("size_total"), F.asc("island")]),
        "side_islands": ranked(islands.side_multi(islands.side_islands(found), totals).drop("total_nodes"), ["relation", "side"], [F.desc("size"), F.asc("island")]),
        "parallel_pairs": relations.parallel_pairs(pairs),
    }


def relation_profiles(
    edge_rows: DataFrame, members: DataFrame, entries: DataFrame, names: DataFrame | None = None,
    attributes: DataFrame | None = None, *, k: int = 10, most: int = 1000,
) -> DataFrame:
    """One nested row for each of ``entries`` (as ``sources.catalogue.relation_index`` gives them).

    ``names`` has (uuid, name, code) of nodes, ``attributes`` is the relation types' ``attribute_rows``.
    Degrees are null without edges; lists are empty where there is nothing to list.
    """
    kinds = entries.select(F.col("technicalName").alias("relation"), "source_type", "target_type")
    roles = relations.numbered_roles(members)
    pairs = written(relations.bare(relations.numbered_pairs(edge_rows, roles), several=True), "pairs")
    degree_rows = written(relations.numbered_degrees(pairs), "degrees")
    stats = relations.pair_stats(pairs, relations.role_totals(roles), kinds, degree_rows)
    more = relations.edge_summary(pairs).select("relation", "parallel_edges", "parallel_max")

    d = relations.degree_distribution(degree_rows)
    degree = F.struct(*[F.col(f"degree_{c}").alias(c) for c in ("min", "max", "avg", "median", "p90", "p99")])
    d = _by_side(d.withColumn("degree", degree), ["degree"], {"s": "source", "t": "target"})

    if names is None:
        names = degree_rows.select("uuid", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("code")).limit(0)
    ids = relations.vertices(roles).select("v", F.col("uuid").alias("id"))
    named = degree_rows.join(ids, "v", "left").select("relation", "side", F.coalesce("uuid", "id").alias("uuid"), "degree")
    top = relations.top_nodes(named, names, k)
    top = _listed(top, ["relation", "side"], [F.col("rank")], F.struct("uuid", "degree", "name", "code"), "top", k)
    top = _by_side(top, ["top"], {"s": "source", "t": "target"})

    found = written(islands.linked_sizes_of(pairs, roles), "islands")
    totals = written(relations.role_totals(roles), "totals")
    size, fraction = F.col("size_total"), F.col("fraction_total")
    entry = F.struct(size, "size_source", "size_target", fraction, "top_source_uuid", "top_source_degree", "top_target_uuid", "top_target_degree")
    multi = _listed(islands.multi_islands(found, totals), ["relation"], [F.desc("size_total"), F.col("island")], entry, "multi_islands", most)
    of_side = islands.side_islands(found)
    entry = F.struct("size", "fraction", "size_total", "top_uuid", "top_degree")
    side_multi = _listed(islands.side_multi(of_side, totals), ["relation", "side"], [F.desc("size"), F.col("island")], entry, "multi", most)
    side = islands.side_summary(of_side, totals).join(side_multi, ["relation", "side"], "left")
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    side_kind = "array<struct<size:bigint,fraction:double,size_total:bigint,top_uuid:string,top_degree:bigint>>"
    counts = ["total_nodes", "total_islands", "singleton_islands"]
    side = side.withColumn("islands", F.struct(*counts, none(F.col("multi"), side_kind).alias("multi_islands")))
    side = _by_side(side, ["islands"], {"s": "source", "t": "target"})

    detail = relations.parallel_pairs(pairs)
    detail = _listed(detail, ["relation"], [F.col("rank")], F.struct(F.col("s").alias("source"), F.col("t").alias("target"), F.col("n").alias("count")), "parallel_pairs_detail", most)

    j = stats.join(more, "relation", "left").join(d, "relation", "left").join(top, "relation", "left")
    j = j.join(islands.summary(found, totals), "relation", "left").join(multi, "relation", "left").join(side, "relation", "left")
    j = j.join(detail, "relation", "left")
    m = entries.select(F.col("technicalName").alias("m"), "name", "description", "engDescription", "type", "source_name", "target_name", "sourceCardinality", "targetCardinality")
    j = j.join(m, F.col("relation") == F.col("m"))
    a_kind = "array<struct<technicalName:string,name:string,description:string,mandatory:string,attributeTypeEnum:string>>"
    if attributes is None:
        j = j.withColumn("attributes", F.array().cast(a_kind))
    else:
        own = attributes.groupBy(F.col("type").alias("of")).agg(
            F.array_sort(F.collect_list(F.struct("at", F.col("name").alias("technicalName"), F.col("attribute_name").alias("name"), "description", "mandatory", "attributeTypeEnum"))).alias("a")
        ).withColumn("a", F.transform("a", lambda x: x.dropFields("at")))
        j = j.join(own, F.col("relation") == F.col("of"), "left").withColumn("attributes", none(F.col("a"), a_kind))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    top_kind = "array<struct<uuid:string,degree:bigint,name:string,code:string>>"
    multi_kind = (
        "array<struct<size_total:bigint,size_source:bigint,size_target:bigint,fraction_total:double,top_source_uuid:string,"
        "top_source_degree:bigint,top_target_uuid:string,top_target_degree:bigint>>"
    )
    document = F.struct(
        F.col("total_edges").alias("edges_total"), "unique_pairs", "duplicate_edges", "pairs_with_duplicates",
        zero("parallel_edges").alias("parallel_edges"), zero("parallel_max").alias("parallel_max"),
        F.col("source_total_nodes").alias("source_total"), F.col("target_total_nodes").alias("target_total"),
        F.col("source_connected_nodes").alias("source_connected"), F.col("target_connected_nodes").alias("target_connected"),
        "cardinality", "ambiguous_pairs",
        F.col("source_degree").alias("degree_source"), F.col("target_degree").alias("degree_target"),
        none(F.col("source_top"), top_kind).alias("top_source"), none(F.col("target_top"), top_kind).alias("top_target"),
        F.struct(*[zero(c).alias(c) for c in counts], none(F.col("multi_islands"), multi_kind).alias("multi_islands"),
                 F.col("source_islands").alias("source"), F.col("target_islands").alias("target")).alias("islands"),
        none(F.col("parallel_pairs_detail"), "array<struct<source:string,target:string,count:bigint>>").alias("parallel_pairs_detail"),
    )
    return j.select(
        F.col("relation").alias("relation_name"), "name", "description", "engDescription", "type", "source_type", "source_name",
        "target_type", "target_name", "sourceCardinality", "targetCardinality", document.alias("stats"), "attributes",
    )
