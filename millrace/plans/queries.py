"""The queries over the test tables, and their SQL.

Node types are supplier, part, customer, orders, nation and region.  Some edges
are turned, and some suppliers left out of the node set, so that orientation
and ambiguity have work to do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import islands, profiles, relations
from millrace.plans import documents, jobs, views
from millrace.shared import shared_folder, written
from millrace.sources import catalogue

# --- the test tables as typed nodes and relations -------------------------------

RELATIONS = (
    ("supplier_part", "supplier", "part"),
    ("customer_orders", "customer", "orders"),
    ("nation_customer", "nation", "customer"),
    ("region_nation", "region", "nation"),
    ("orders_region", "orders", "region"),
)
_KEYS = {
    "supplier": ("S", "s_suppkey"), "part": ("P", "p_partkey"), "customer": ("C", "c_custkey"),
    "orders": ("O", "o_orderkey"), "nation": ("N", "n_nationkey"), "region": ("R", "r_regionkey"),
}
_PROFILED = {
    "customer": ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "nation": ["n_name", "n_regionkey"],
}


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _id(kind: str, column: str | None = None):
    letter, key = _KEYS[kind]
    return F.concat(F.lit(letter), F.col(column or key).cast("string"))


def _relations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RELATIONS), "relation string, source_type string, target_type string")


def _members(spark: SparkSession, sf: str, only: tuple[str, ...] = ()) -> DataFrame:
    found = None
    for relation, *ends in RELATIONS:
        for side, kind in zip("st", ends, strict=True):
            if only and relation not in only:
                continue
            nodes = _table(spark, sf, kind)
            if kind == "supplier":
                nodes = nodes.filter("s_suppkey % 10 <> 0")
            rows = nodes.select(_id(kind).alias("uuid")).filter("uuid <> ''").select(F.lit(relation).alias("relation"), F.lit(side).alias("side"), "uuid")
            found = rows if found is None else found.unionByName(rows)
    return found


def _edges(spark: SparkSession, sf: str, only: tuple[str, ...] = ()) -> DataFrame:
    def rows(relation: str, table: str, one, two, turned="false") -> DataFrame:
        u = _table(spark, sf, table)
        turn = F.expr(turned)
        return u.select(
            F.lit(relation).alias("relation"), F.when(turn, two).otherwise(one).alias("u0"),
            F.when(turn, F.concat(F.lit(" "), one)).otherwise(F.concat(F.lit(" "), two)).alias("u1"),
        )

    every = {
        "supplier_part": lambda: rows("supplier_part", "lineitem", _id("supplier", "l_suppkey"), _id("part", "l_partkey"), "l_linenumber % 3 = 0"),
        "customer_orders": lambda: rows("customer_orders", "orders", _id("customer", "o_custkey"), _id("orders")),
        "nation_customer": lambda: rows("nation_customer", "customer", _id("nation", "c_nationkey"), _id("customer")),
        "region_nation": lambda: rows("region_nation", "nation", _id("region", "n_regionkey"), _id("nation")),
    }
    found = None
    for name, make in every.items():
        if not only or name in only:
            found = make() if found is None else found.unionByName(make())
    return relations.edges(found)


_SP = ("supplier_part",)


def _pairs(spark: SparkSession, sf: str, only=_SP) -> DataFrame:
    return relations.pair_counts(_edges(spark, sf, only), _members(spark, sf, only))


def rel_stats_v1_supplier_part(spark: SparkSession, sf: str) -> DataFrame:
    only = _relations(spark).filter("relation = 'supplier_part'")
    return relations.relation_stats(_edges(spark, sf, _SP), _members(spark, sf, _SP), only)


def rel_stats_all(spark: SparkSession, sf: str) -> DataFrame:
    return relations.relation_stats(_edges(spark, sf), _members(spark, sf), _relations(spark))


def rel_orientation(spark: SparkSession, sf: str) -> DataFrame:
    return relations.orient(_edges(spark, sf, _SP), _members(spark, sf, _SP))


def rel_edge_summary(spark: SparkSession, sf: str) -> DataFrame:
    return relations.edge_summary(_pairs(spark, sf, ()))


def rel_side_summary(spark: SparkSession, sf: str) -> DataFrame:
    sides = relations.member_totals(_members(spark, sf))
    return relations.side_summary(relations.degrees(_pairs(spark, sf, ())), sides)


def rel_cardinality_all(spark: SparkSession, sf: str) -> DataFrame:
    return relations.cardinality(relations.degrees(_pairs(spark, sf, ())), _relations(spark))


def rel_degree_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return relations.degree_distribution(relations.degrees(_pairs(spark, sf, ())))


def rel_parallel_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return relations.parallel_pairs(_pairs(spark, sf))


def rel_top_nodes(spark: SparkSession, sf: str) -> DataFrame:
    names = _table(spark, sf, "supplier").select(_id("supplier").alias("uuid"), F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("code"))
    names = names.unionByName(_table(spark, sf, "part").select(_id("part").alias("uuid"), F.lit("").alias("name"), F.col("p_partkey").cast("string").alias("code")))
    return relations.top_nodes(relations.degrees(_pairs(spark, sf)), names)


def rel_coverage_pie(spark: SparkSession, sf: str) -> DataFrame:
    return views.coverage(rel_stats_all(spark, sf)).select(
        "relation", "side", "total", "connected", "coverage_text", *[F.round(c, 9).alias(c) for c in ("connected_share", "parallel_share", "connected_arc", "parallel_arc")]
    )


def rel_degree_view(spark: SparkSession, sf: str) -> DataFrame:
    return views.degree_view(rel_degree_distribution(spark, sf))


_REL_TYPES = (
    ("supplier_part", "Supplies", "  What a supplier has,\n" + "z" * 80, "Supplier", "supplier", None, "part"),
    ("customer_orders", "", None, "Customer", "customer", "Order", "orders"),
    ("nation_customer", "Has", " customers of a nation ", "", "nation", "Customer", None),
    ("orders_region", None, "", None, None, "Region", "region"),
)


def _relation_meta(spark: SparkSession) -> DataFrame:
    schema = "technicalName string, name string, description string, source_name string, source_type string, target_name string, target_type string"
    return spark.createDataFrame(list(_REL_TYPES), schema)


def rel_view(spark: SparkSession, sf: str) -> DataFrame:
    """The page of each relation; one has no metadata."""
    return views.relation_view(rel_stats_all(spark, sf), _relation_meta(spark))


def rel_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Some fields of each relation's full document, lists by their first entries."""
    none = F.lit(None).cast("string")
    limits = F.struct(F.lit(0).cast("bigint").alias("min"), F.lit(None).cast("bigint").alias("max"))
    entries = _relation_meta(spark).select(
        "technicalName", "name", "description", none.alias("engDescription"), none.alias("type"), "source_type", "source_name", "target_type",
        "target_name", limits.alias("sourceCardinality"), limits.alias("targetCardinality"),
    )
    attributes = spark.createDataFrame(
        [("supplier_part", "z", 0, "Zed", None, "critical", "STRING"), ("supplier_part", "a", 1, "Ay", "d", None, "LONG")],
        "type string, name string, at int, attribute_name string, description string, mandatory string, attributeTypeEnum string",
    )
    d = documents.relation_profiles(_edges(spark, sf), _members(spark, sf), entries, attributes=attributes)
    x, i = "stats.", "stats.islands."
    first = lambda c, field: F.get(c, F.lit(0))[field]
    return d.select(
        "relation_name", "name", "source_type", "target_name", f"{x}edges_total", f"{x}unique_pairs", f"{x}parallel_edges", f"{x}parallel_max",
        f"{x}source_total", f"{x}target_connected", f"{x}cardinality", F.col(f"{x}degree_source.p90").alias("source_p90"),
        F.col(f"{x}degree_target.median").alias("target_median"), first(f"{x}top_source", "uuid").alias("top_source"),
        first(f"{x}top_target", "degree").alias("top_target_degree"), F.col(f"{i}total_islands").alias("islands"),
        F.col(f"{i}singleton_islands").alias("singletons"), first(f"{i}multi_islands", "size_total").alias("largest"),
        first(f"{i}multi_islands", "top_source_uuid").alias("largest_top"), F.col(f"{i}target.total_islands").alias("target_islands"),
        first(f"{i}target.multi_islands", "size").alias("target_largest"), first(f"{x}parallel_pairs_detail", "count").alias("most_parallel"),
        F.array_join(F.transform("attributes", lambda a: a["technicalName"]), ",").alias("attributes"),
        F.col("sourceCardinality.min").alias("source_min"), F.col("sourceCardinality.max").alias("source_max"),
    )


def rel_profile_lists(spark: SparkSession, sf: str) -> DataFrame:
    """All entries of all lists of the relations' documents, in their order."""
    lists = documents.relation_lists(_edges(spark, sf), _members(spark, sf))
    island, none = F.replace("island", F.lit("\x1f"), F.lit(":")), F.lit(None).cast("string")
    kinds = {
        "multi_islands": (none, island, F.col("size_total"), F.col("fraction_total"), F.col("top_source_uuid"), F.col("top_target_degree")),
        "side_islands": (F.col("side"), island, F.col("size"), F.col("fraction"), F.col("top_uuid"), F.col("top_degree")),
        "parallel_pairs": (none, F.concat("s", F.lit(">"), "t"), F.col("n"), F.lit(None).cast("double"), none, F.lit(None).cast("bigint")),
    }
    found = None
    for kind, columns in kinds.items():
        names = ("side", "entry", "amount", "fraction", "top_uuid", "top_degree")
        rows = lists[kind].select(F.lit(kind).alias("list"), "relation", "rank", *[c.alias(n) for c, n in zip(columns, names)])
        found = rows if found is None else found.unionByName(rows)
    return found


# --- islands, over all edges of all relations ----------------------------------


def _links(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The written links of all relations, and the roles that they are numbered by."""
    roles = relations.numbered_roles(_members(spark, sf))
    return written(relations.numbered_links(_edges(spark, sf), roles), "links"), roles


def islands_components(spark: SparkSession, sf: str) -> DataFrame:
    found = islands.components_of(*_links(spark, sf))
    return found.withColumn("island", F.replace("island", F.lit("\x1f"), F.lit(":")))


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    found = islands.sizes_of(*_links(spark, sf))
    return found.withColumn("island", F.replace("island", F.lit("\x1f"), F.lit(":")))


def islands_summary(spark: SparkSession, sf: str) -> DataFrame:
    return islands.summary(islands.counts_of(*_links(spark, sf)))


def islands_multi(spark: SparkSession, sf: str) -> DataFrame:
    return islands.multi_islands(written(_sizes(spark, sf), "islands")).drop("total_nodes")


def islands_side(spark: SparkSession, sf: str) -> DataFrame:
    return islands.both_summaries(islands.counts_of(*_links(spark, sf)))


def islands_side_multi(spark: SparkSession, sf: str) -> DataFrame:
    return islands.side_multi(islands.side_islands(written(_sizes(spark, sf), "islands"))).drop("total_nodes")


def islands_pie_layout(spark: SparkSession, sf: str) -> DataFrame:
    parts = islands.side_multi(islands.side_islands(written(_sizes(spark, sf), "islands")))
    return views.pie_layout(parts, "size").select("relation", "side", "island", "idx", "r", "g", "b", "part", "start")


# --- profiles ----------------------------------------------------------------


def _objects(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """With gaps: the test tables have neither nulls nor empty texts."""
    t = _table(spark, sf, kind)
    if kind == "customer":
        t = t.withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(0))).withColumn(
            "c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_mktsegment"))
        )
    return t


def _profile(spark: SparkSession, sf: str, kinds: list[str]) -> tuple[DataFrame, DataFrame]:
    tables = {k: _objects(spark, sf, k) for k in kinds}
    values = None
    for kind, t in tables.items():
        own = profiles.filled_values(t, kind, _PROFILED[kind])
        values = own if values is None else values.unionByName(own)
    counts = profiles.type_counts(tables)
    return profiles.profile(values, counts), counts


def attr_profile_customer(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf, ["customer"])[0]


def attr_profile_all_types(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf, list(_PROFILED))[0]


def attr_profile_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes of long and of few values: whole documents and pages."""
    tables = {"documents": _table(spark, sf, "documents"), "pages": _table(spark, sf, "pages")}
    values = profiles.filled_values(tables["documents"], "documents", ["text", "lang", "source"]).unionByName(profiles.filled_values(tables["pages"], "pages", ["url", "html"]))
    return profiles.profile(values, profiles.type_counts(tables))


def attr_profile_json_props(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events")
    props = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("kind"), F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type"))))
    values = profiles.filled_map_values(events.select(props.alias("p")), "events", "p")
    return profiles.profile(values, profiles.type_counts({"events": events}))


def attr_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return attr_profile_all_types(spark, sf).select("type", "name", text.tier(F.col("pct")).alias("tier"))


def attr_search_limit(spark: SparkSession, sf: str) -> DataFrame:
    return views.searched(attr_profile_all_types(spark, sf), " NA", 2).select("type", "name", "rank", "count")


_ATTR_META = (
    ("customer", "c_name", "Name", "The customer's name", "critical"),
    ("customer", "c_acctbal", "Balance", "  ", None),
    ("supplier", "s_name", None, "x" * 101, None),
    ("part", "p_size", "Size", "y" * 100, "optional"),
)


def attr_metadata_join(spark: SparkSession, sf: str) -> DataFrame:
    meta = spark.createDataFrame(list(_ATTR_META), "type string, name string, attribute_name string, description string, mandatory string")
    view = views.attribute_view(attr_profile_all_types(spark, sf), meta)
    return view.select("type", "name", "display_name", "subtitle", "unique_cell", "tier", "pct_text", "bar", "unique_bar")


def attr_summary_text(spark: SparkSession, sf: str) -> DataFrame:
    return views.type_summary(_profile(spark, sf, list(_PROFILED))[1])


_FILTERS = (
    ("application", views.TypeFilter()), ("codelist", views.TypeFilter(application=False, codelist=True)), ("system", views.TypeFilter(application=False, system=True)),
    ("none", views.TypeFilter(application=False)), ("curated", views.TypeFilter(curated=("T3", "BUILDING", "AFRICA", "1-URGENT", "absent"))),
)


def _indexes(spark: SparkSession, sf: str, root: str) -> list[tuple[str, DataFrame | None]]:
    """The index document of nations as node types, or of regions as relation types, read from its file; and what is read
    where it is missing, and where it is broken."""
    path = f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    jobs.metadata(spark, _fetched_nations(spark, sf), _fetched_regions(spark, sf), path)
    _table(spark, sf, "nation").agg(F.concat(F.lit('{"types": {"'), F.max("n_name")).alias("value")).write.text(f"{path}/broken")
    place = {"there": f"{path}/{'node' if root == 'types' else 'relation'}_index", "missing": f"{path}/missing", "broken": f"{path}/broken"}
    return [(name, catalogue.read_index(spark, at, root).rows) for name, at in place.items()]


def type_kind_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Nations and market segments as node types of a snapshot, of which the latter have no metadata."""
    segments = _table(spark, sf, "customer").select(F.col("c_mktsegment").alias("type")).distinct()
    types = _table(spark, sf, "nation").select(F.concat(F.lit("T"), "n_nationkey").alias("type")).unionByName(segments)
    found = None
    for metadata, index in _indexes(spark, sf, "types"):
        for name, chosen in _FILTERS:
            rows = views.type_kind_filter(types, index, chosen).select(F.lit(metadata).alias("metadata"), F.lit(name).alias("filter"), "type", "label")
            found = rows if found is None else found.unionByName(rows)
    return found


def relation_kind_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Regions and priorities of orders as relations of a snapshot, of which the latter have no metadata."""
    priorities = _table(spark, sf, "orders").select(F.col("o_orderpriority").alias("relation")).distinct()
    names = _table(spark, sf, "region").select(F.col("r_name").alias("relation")).unionByName(priorities)
    filters = [f for f in _FILTERS if f[0] != "codelist"] + [("both", views.TypeFilter(system=True))]
    found = None
    for metadata, index in _indexes(spark, sf, "relations"):
        for name, chosen in filters:
            rows = views.relation_kind_filter(names, index, chosen).select(F.lit(metadata).alias("metadata"), F.lit(name).alias("filter"), "relation", "label", "rank")
            found = rows if found is None else found.unionByName(rows)
    return found


def default_selection(spark: SparkSession, sf: str) -> DataFrame:
    """What is chosen among the nations' names: the current one if it is there, else the first, else none."""
    nation = _table(spark, sf, "nation").withColumnRenamed("n_name", "name")
    third = nation.filter("n_nationkey = 3").first()["name"]
    cases = (("kept", "n_regionkey >= 0", third), ("gone", "n_regionkey < 0", third), ("first", "n_nationkey > 4", third), ("none", "n_nationkey > 4", None))
    found = None
    for case, which, current in cases:
        one = views.selected(nation.filter(which), "name", current).select(F.lit(case).alias("situation"), "chosen")
        found = one if found is None else found.unionByName(one)
    return found


def type_icon_kind(spark: SparkSession, sf: str) -> DataFrame:
    """Of nations as node types, by their index document."""
    return views.icon_kind(_indexes(spark, sf, "types")[0][1])


# --- metadata, snapshots, tables, texts ------------------------------------------


def _json_text(**fields) -> F.Column:
    return F.to_json(F.struct(*[(v if isinstance(v, F.Column) else F.lit(v)).alias(k) for k, v in fields.items()]))


def _fetched_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Regions as relation types, as the REST source gives them: sources are their nations, of which the first counts."""
    nation, region = _table(spark, sf, "nation"), _table(spark, sf, "region")
    ends = nation.filter("n_regionkey <> 0").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("ends"))
    sources = F.transform("ends", lambda e: F.struct(F.concat(F.lit("N"), e["n_nationkey"].cast("string")).alias("technicalName"), e["n_name"].alias("name"), F.lit("application").alias("type")))
    listed = F.when(F.col("r_regionkey") == 0, _json_text(name="", type="system")).when(F.col("r_regionkey") == 1, F.concat(F.lit('"'), "r_name", F.lit('"'))).otherwise(
        _json_text(name=F.concat(F.lit("listed "), "r_name"), description="of the list", type="system")
    )
    detail = _json_text(name=F.when(F.col("r_regionkey") % 2 == 0, F.col("r_name")).otherwise(""), type=F.when(F.col("r_regionkey") == 3, "application"), sources=sources)
    return region.join(ends, F.col("r_regionkey") == F.col("n_regionkey"), "left").select(F.col("r_name").alias("name"), listed.alias("listed"), detail.alias("detail"))


def metadata_first_endpoint(spark: SparkSession, sf: str) -> DataFrame:
    types = catalogue.fetched_types(_fetched_regions(spark, sf), catalogue.RELATION_TYPE)
    return catalogue.relation_entries(types).select("technicalName", "source_name")


def metadata_relation_entries(spark: SparkSession, sf: str) -> DataFrame:
    """All of the entries, from raw documents written and read again as they came."""
    path = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    fetched = _fetched_regions(spark, sf)
    catalogue.write_raw(fetched, path)
    raw = spark.read.schema("value string, stem string").text(path, wholetext=True)
    again = fetched.select("name", "listed").join(raw, F.col("name") == F.col("stem")).select("name", "listed", F.col("value").alias("detail"))
    entries = catalogue.relation_entries(catalogue.fetched_types(again, catalogue.RELATION_TYPE))
    return entries.select("technicalName", "name", "description", "type", "source_type", "source_name", "source_kind", F.size("source_labels").alias("n_labels"), "target_type")


def _fetched_nations(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as node types, with labels in the list, the details, both or neither, and attributes of which names repeat."""
    n = F.col("n_nationkey")
    label = lambda x, which: F.array(F.when(which, "codelist").otherwise("other"), F.lit(x))
    listed = _json_text(name=F.concat(F.lit("listed "), "n_name"), type="system", labels=F.when(n % 4 == 0, label("l", n % 3 == 0)).when(n % 4 == 1, F.array().cast("array<string>")))
    attribute = lambda k, v: F.struct(k.alias("technicalName"), v.alias("name"), (n % 2 == 0).alias("opendata"), (n % 3 == 0).alias("invisible"), F.struct(F.lit("optional").alias("type")).alias("mandatory"))
    attributes = F.array(
        attribute(F.lit("z"), F.col("n_name")), attribute(F.lit(""), F.lit("unnamed")), attribute(F.lit("a"), F.lit("Ay")),
        attribute(F.lit("z"), F.concat(F.col("n_name"), F.lit("!"))),
    )
    detail = _json_text(
        name=F.when(n % 2 == 0, F.col("n_name")).otherwise(""), type=F.when(n % 5 < 3, "application"),
        labels=F.when(n % 3 == 0, label("d", n % 2 == 0)), attributes=F.when(n % 7 != 6, attributes),
    )
    return _table(spark, sf, "nation").select(F.concat(F.lit("T"), n.cast("string")).alias("name"), listed.alias("listed"), detail.alias("detail"))


def metadata_node_entries(spark: SparkSession, sf: str) -> DataFrame:
    entries = catalogue.node_entries(catalogue.fetched_types(_fetched_nations(spark, sf), catalogue.NODE_TYPE))
    return entries.withColumn("labels", F.array_join("labels", ",")).drop("description")


def metadata_index_document(spark: SparkSession, sf: str) -> DataFrame:
    """The document of all node types, written as one file and read again: its attributes by type and name."""
    path = f"{shared_folder(spark)}/metadata-{uuid.uuid4().hex}"
    jobs.metadata(spark, _fetched_nations(spark, sf), _fetched_regions(spark, sf), path)
    attribute = "struct<name: string, description: string, mandatory: string, opendata: boolean, attributeTypeEnum: string, readOnly: boolean, invisible: boolean>"
    entry = f"struct<technicalName: string, typeKind: string, isCodelist: boolean, attributes: map<string, {attribute}>>"
    doc = spark.read.text(f"{path}/node_index", wholetext=True).select(F.from_json("value", f"types map<string, {entry}>").alias("d"))
    types = doc.select(F.explode("d.types").alias("type", "e"))
    return types.select("type", "e.typeKind", "e.isCodelist", F.explode_outer("e.attributes").alias("name", "a")).select(
        "type", "typeKind", "isCodelist", "name", F.col("a.name").alias("attribute_name"), "a.mandatory", "a.opendata", "a.invisible"
    )


def metadata_attr_map(spark: SparkSession, sf: str) -> DataFrame:
    """Of attributes of equal names the last counts; ones without a name go."""
    nation = _table(spark, sf, "nation")
    name = F.when(F.col("n_nationkey") % 7 == 0, "").otherwise(F.concat(F.lit("a"), (F.col("n_nationkey") % 4).cast("string")))
    attr = F.struct(F.col("n_nationkey").alias("k"), name.alias("technicalName"), F.col("n_name").alias("name"))
    types = nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(attr)).alias("attrs")).select(
        F.col("n_regionkey").cast("string").alias("technicalName"),
        F.transform("attrs", lambda a: F.struct(
            a["technicalName"].alias("technicalName"), a["name"].alias("name"), F.lit(None).cast("string").alias("description"),
            F.struct(F.lit("optional").alias("type")).alias("mandatory"), F.lit("STRING").alias("attributeTypeEnum"),
            F.lit(False).alias("readOnly"), F.lit(True).alias("opendata"), F.lit(False).alias("invisible"))).alias("attributes"),
    )
    return catalogue.attribute_rows(types).select("type", "name", "attribute_name", "mandatory", "opendata", "invisible", "readOnly")


def _snapshot_files(spark: SparkSession, sf: str) -> DataFrame:
    """Days of orders as snapshots, of which some have no files."""
    o = _table(spark, sf, "orders")
    date = F.concat_ws("-", F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"), F.dayofmonth("o_orderdate").cast("string"))
    kind = F.when(F.col("o_orderkey") % 5 == 0, "holistic").when(F.col("o_orderkey") % 2 == 0, "attributes").otherwise("relation_attributes")
    return o.select(date.alias("date"), kind.alias("kind"), F.col("o_orderpriority").alias("stem"))


def snapshot_index(spark: SparkSession, sf: str) -> DataFrame:
    found = catalogue.snapshot_index(_snapshot_files(spark, sf))
    return found.select("date", F.array_join("node_types", "|").alias("node_types"), F.array_join("relations", "|").alias("relations"))


def snapshot_latest(spark: SparkSession, sf: str) -> DataFrame:
    index = catalogue.snapshot_index(_snapshot_files(spark, sf))
    modes = [catalogue.latest_snapshot(index, m).select(F.lit(m).alias("mode"), "date") for m in ("lexicographic", "chronological")]
    return modes[0].unionByName(modes[1])


def snapshot_folders(spark: SparkSession, sf: str) -> DataFrame:
    """The index document's rows, after documents of a snapshot each year were written and their folders scanned."""
    path = f"{shared_folder(spark)}/snapshots-{uuid.uuid4().hex}"
    days = _snapshot_files(spark, sf).filter("kind <> 'holistic'").withColumn("date", F.concat(F.substring("date", 1, 4), F.lit("-1-1")))
    files = days.groupBy(F.col("date").alias("snapshot"), "kind", "stem").agg(F.count("*").alias("n"))
    catalogue.write_documents(files, path, ["snapshot", "kind", "stem"])
    jobs.index_snapshots(spark, path, f"{path}-index")
    kind = "snapshots array<struct<date: string, node_types: array<string>, relations: array<string>>>"
    doc = spark.read.text(f"{path}-index", wholetext=True).select(F.from_json("value", kind).alias("d"))
    x = doc.select(F.explode("d.snapshots").alias("s")).select("s.*")
    return x.select("date", F.array_join("node_types", "|").alias("node_types"), F.array_join("relations", "|").alias("relations"))


def snapshot_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute profiles written by snapshot and type; one is looked up, another isn't there."""
    path = f"{shared_folder(spark)}/profiles-{uuid.uuid4().hex}"
    profiled, counts = _profile(spark, sf, list(_PROFILED))
    docs = profiles.profile_documents(profiled, counts).select(F.lit("2025-11-3").alias("snapshot"), F.col("type").alias("stem"), "type", "count", "attributes")
    catalogue.write_documents(docs, path, ["snapshot", "stem"])
    there = catalogue.read_snapshot(spark, path, catalogue.PROFILE, "2025-11-3", "customer")
    absent = catalogue.read_snapshot(spark, path, catalogue.PROFILE, "2025-11-13", "customer")
    no_root = catalogue.read_snapshot(spark, f"{path}-none", catalogue.PROFILE, "2025-11-3", "part")
    found = there.unionByName(absent).unionByName(no_root)
    return found.select("type", F.col("count").alias("type_count"), F.explode("attributes").alias("a")).select("type", "type_count", "a.*")


def _command_files(spark: SparkSession, sf: str) -> str:
    """Node dumps of nations and regions, with ids that don't count, and edge tables of two relations, with rows that don't."""
    path = f"{shared_folder(spark)}/input-{uuid.uuid4().hex}"
    nation, region = _table(spark, sf, "nation"), _table(spark, sf, "region")
    dumps = region.select(F.lit("region").alias("stem"), _id("region").alias("uuid")).unionByName(
        nation.select(F.lit("nation").alias("stem"), F.when(F.col("n_nationkey") == 3, "").when(F.col("n_nationkey") != 4, _id("nation")).alias("uuid"))
    )
    lists = dumps.groupBy("stem").agg(F.collect_list(F.struct("uuid")).alias("result"))
    catalogue.write_documents(lists, f"{path}/nodes", ["stem"])
    row = lambda *values: F.struct(F.array(*values).alias("values"))
    n, r = _id("nation"), _id("region", "n_regionkey")
    given = nation.select(
        F.lit("region_nation").alias("stem"),
        F.when(F.col("n_nationkey") % 5 == 1, row(n, F.concat(F.lit(" "), r), F.lit("more"))).when(F.col("n_nationkey") == 7, row(r))
        .when(F.col("n_nationkey") == 8, row(r, F.lit(None).cast("string"))).when(F.col("n_nationkey") == 9, row(F.lit(" "), n)).otherwise(row(r, n)).alias("row"),
    )
    given = given.unionByName(nation.select(F.lit("nation_nation").alias("stem"), F.explode(F.array(row(n, n), row(n, n))).alias("row")))
    result = F.struct(F.array(*[F.struct(F.lit(h).alias("name")) for h in ("from", "to", "note")]).alias("headers"), F.col("rows").alias("rows"))
    tables = given.groupBy("stem").agg(F.collect_list("row").alias("rows")).select("stem", F.lit("TABLE").alias("type"), result.alias("result"))
    catalogue.write_documents(tables, f"{path}/relations", ["stem"])
    for folder in ("nodes", "relations"):  # what isn't .json isn't read
        nation.select(F.concat(F.lit('{"'), "n_name").alias("value")).write.text(f"{path}/{folder}/stem=notes")
    return path


def edge_table_files(spark: SparkSession, sf: str) -> DataFrame:
    return relations.edges(catalogue.edge_tables(spark, f"{_command_files(spark, sf)}/relations"))


def node_dump_files(spark: SparkSession, sf: str) -> DataFrame:
    dumps = catalogue.node_dumps(spark, f"{_command_files(spark, sf)}/nodes")
    return dumps.filter("uuid <> ''").distinct()


#: Lines of a file of a large document: no task sorts many more.
LINES = 500_000


def _large_documents(spark: SparkSession, sf: str) -> str:
    """All orders as rows of one table, all customers as objects of one dump, and all suppliers as a bare list: a document each,
    written in files that follow each other."""
    path = f"{shared_folder(spark)}/large-{uuid.uuid4().hex}"
    o, c = _table(spark, sf, "orders"), _table(spark, sf, "customer")
    cells = F.array(_id("customer", "o_custkey"), F.concat(F.lit(" "), _id("orders")), F.concat(F.lit('}{"'), "o_orderpriority"))
    rows = o.select("o_orderkey", F.to_json(F.struct(cells.alias("values"))).alias("value"))
    head = _json_text(type="TABLE", result=F.struct(F.array(*[F.struct(F.lit(h).alias("name")) for h in ("from", "to", "note")]).alias("headers")))
    head = F.concat(F.substr(head, F.lit(1), F.length(head) - 2), F.lit(',"rows":['))
    catalogue.write_document(catalogue.in_parts(rows, ["o_orderkey"], head, "]}}"), f"{path}/relations/stem=customer_orders", 1 + o.count() // LINES)
    items = c.select("c_custkey", F.to_json(F.struct(_id("customer").alias("uuid"), F.struct(F.col("c_name").alias("rows")).alias("result"))).alias("value"))
    catalogue.write_document(catalogue.in_parts(items, ["c_custkey"], F.lit('{"took": {"result": [1]}, "result": ['), "]}"), f"{path}/nodes/stem=customer", 1 + c.count() // LINES)
    bare = _table(spark, sf, "supplier").select("s_suppkey", F.to_json(F.struct(F.col("s_name").alias("name"), _id("supplier").alias("uuid"))).alias("value"))
    catalogue.write_document(catalogue.in_parts(bare, ["s_suppkey"], F.lit("["), "]"), f"{path}/nodes/stem=supplier", 1 + bare.count() // LINES)
    return path


def edge_table_large(spark: SparkSession, sf: str) -> DataFrame:
    """The edges of one large table, read in byte ranges."""
    return relations.edges(catalogue.edge_tables(spark, f"{_large_documents(spark, sf)}/relations", "*.txt", folders=True))


def table_rows_large(spark: SparkSession, sf: str) -> DataFrame:
    """The same table's rows with their numbers."""
    rows = catalogue.tables(spark, f"{_large_documents(spark, sf)}/relations", "*.txt", folders=True)
    return rows.select("stem", "row", F.array_join("headers", "|").alias("headers"), F.array_join("values", "|").alias("row_values"))


def node_dump_large(spark: SparkSession, sf: str) -> DataFrame:
    """The objects of two large dumps, read in byte ranges."""
    return catalogue.node_dumps(spark, f"{_large_documents(spark, sf)}/nodes", pattern="*.txt", folders=True)


def metadata_listed_details(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of listed nations, some listed twice, with the documents of their details, which some don't have."""
    path = f"{shared_folder(spark)}/details-{uuid.uuid4().hex}"
    nation, n = _table(spark, sf, "nation"), F.col("n_nationkey")
    name = F.concat(F.lit("T"), n.cast("string"))
    detail = nation.filter(n % 4 != 3).select(
        name.alias("stem"), name.alias("technicalName"), F.when(n % 2 == 0, F.col("n_name")).otherwise("").alias("name"),
        F.when(n % 5 < 3, "application").alias("type"), F.array(F.when(n % 3 == 0, "codelist").otherwise("other")).alias("labels"),
    )
    catalogue.write_documents(detail, path, ["stem"])
    details = catalogue.read_documents(spark, path, catalogue.NODE_TYPE).drop("stem")
    twice = F.explode(F.when(n % 6 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("at")
    listing = nation.select("*", twice).select(name.alias("technicalName"), F.concat(F.lit("listed "), F.col("at").cast("string"), F.lit(" "), "n_name").alias("name"), F.lit("system").alias("type"), "at")
    entries = catalogue.node_index(listing, details)
    return entries.select("technicalName", "name", "type", F.array_join("labels", ",").alias("labels"), "is_application", "is_system", "is_codelist")


def rest_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The nations' names out of the answers of a service, one for each region, in four forms."""
    names = _table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    region = _table(spark, sf, "region").join(names, F.col("r_regionkey") == F.col("n_regionkey"))
    under = lambda key: _json_text(total=F.size("names"), **{key: F.col("names")})
    keys = F.to_json(F.map_from_arrays("names", F.transform("names", lambda x: F.length(x))))
    form = F.col("r_regionkey") % 5
    answer = F.when(form == 0, F.to_json("names")).when(form == 1, under("items")).when(form == 2, under("found")).when(form == 3, keys).otherwise(
        _json_text(found=F.array(F.lit("no")), result=F.col("names")))
    return region.select("r_name", F.explode(catalogue.listed(answer)).alias("listed"))


def relation_stats_command(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of two relations from their files, written by snapshot and read again."""
    path = _command_files(spark, sf)
    wanted = [("region_nation", "region", "nation"), ("nation_nation", "nation", "nation")]
    jobs.relation_stats(spark, path, f"{path}/stats", "2025-11-3", wanted)
    side = "struct<type: string, total_nodes: bigint, connected_nodes: bigint, degree_min: bigint, degree_max: bigint, degree_avg: double>"
    edge = "struct<total_edges: bigint, unique_pairs: bigint, duplicate_edges: bigint, pairs_with_duplicates: bigint, ambiguous_pairs: bigint>"
    schema = f"relation_name string, source_type string, target_type string, edges {edge}, source {side}, target {side}, cardinality string"
    d = catalogue.read_snapshot(spark, f"{path}/stats", schema, "2025-11-3")
    ends = [F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in ("source", "target") for c in ("total_nodes", "connected_nodes", "degree_max")]
    return d.select("snapshot", "relation_name", "source_type", "target_type", "edges.*", *ends, "cardinality")


def _report(spark: SparkSession, sf: str) -> DataFrame:
    """A report of the regions, written as a TABLE document and read again."""
    path = f"{shared_folder(spark)}/reports-{uuid.uuid4().hex}"
    r = _table(spark, sf, "region").select(F.struct(F.array(F.col("r_regionkey").cast("string"), F.concat(F.col("r_name"), F.lit(' "x";')), F.lit(None).cast("string")).alias("values")).alias("row"))
    headers = F.array(*[F.struct(F.lit(h).alias("name")) for h in ("key", "name", "note")])
    doc = r.agg(F.struct(headers.alias("headers"), F.array_sort(F.collect_list("row")).alias("rows")).alias("result"))
    catalogue.write_documents(doc.select(F.lit("region").alias("stem"), F.lit("TABLE").alias("type"), "result"), path, ["stem"])
    return catalogue.tables(spark, path)


def table_flatten(spark: SparkSession, sf: str) -> DataFrame:
    cells = _report(spark, sf).select("stem", "row", F.posexplode(F.arrays_zip("headers", "values")).alias("col", "x"))
    return cells.select("stem", "row", "col", F.col("x.headers").alias("header"), F.col("x.values").alias("value"))


def table_csv_lines(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.csv_lines(_report(spark, sf))


def table_csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the CSV files that a report is converted to."""
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    catalogue.write_csv(catalogue.csv_lines(_report(spark, sf)), path)
    text_of = spark.read.schema("value string, stem string").text(path, wholetext=True)
    return text_of.select("stem", F.posexplode(F.split("value", "\r\n")).alias("row", "line")).filter("line <> ''")


def text_truncate(spark: SparkSession, sf: str) -> DataFrame:
    d = _table(spark, sf, "documents")
    return d.select("doc_id", text.truncated(F.col("text"), 100).alias("short"), text.short_description(F.col("text")).alias("shorter"))


def text_escape(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "pages").select("page_id", text.escaped(F.col("html")).alias("escaped"))


def pct_format(spark: SparkSession, sf: str) -> DataFrame:
    """Percentages of all sizes, none among them."""
    size = F.col("p_size").cast("double")
    pct = F.when(F.col("p_partkey") % 8 == 0, 0.0).when(F.col("p_partkey") % 8 == 7, None).otherwise(size / F.pow(F.lit(10.0), (F.col("p_partkey") % 8 - 1)) / 3.0)
    p = _table(spark, sf, "part").select("p_partkey", pct.alias("pct"))
    return p.select("p_partkey", text.percent(F.col("pct"), 3, 8).alias("pct_text"))


def text_url(spark: SparkSession, sf: str) -> DataFrame:
    """Names of pages' addresses as parts of a path, with signs that are escaped and ones that aren't."""
    p = _table(spark, sf, "pages")
    return p.select("page_id", text.url_component(F.concat(F.col("url"), F.lit(" č(1)!'*~+"))).alias("escaped"))


def text_rgba(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    shown = F.when(F.col("p_partkey") % 4 == 0, "red").when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("rgb("), size, F.lit(", 2,3)"))).otherwise(
        F.concat(F.lit("rgba(1,"), size, F.lit(",255, 0.25)"))
    )
    p = _table(spark, sf, "part").select("p_partkey", text.rgba(shown).alias("x"))
    return p.select("p_partkey", *[F.col("x")[k].alias(c) for k, c in enumerate("rgba")])


QUERIES = {
    f.__name__: f
    for f in (
        rel_stats_v1_supplier_part, rel_stats_all, rel_orientation, rel_edge_summary, rel_side_summary, rel_cardinality_all,
        rel_degree_distribution, rel_parallel_pairs, rel_top_nodes, rel_coverage_pie, rel_degree_view, rel_view, rel_profiles, rel_profile_lists,
        islands_components,
        islands_summary, islands_multi, islands_side, islands_side_multi, islands_pie_layout, attr_profile_customer,
        attr_profile_all_types, attr_profile_texts, attr_profile_json_props, attr_tiers, attr_search_limit, attr_metadata_join, attr_summary_text,
        type_kind_filter, relation_kind_filter, default_selection, type_icon_kind, metadata_first_endpoint, metadata_relation_entries,
        metadata_node_entries, metadata_index_document, metadata_attr_map, snapshot_index, snapshot_latest, snapshot_folders,
        snapshot_lookup, edge_table_files, node_dump_files, edge_table_large, table_rows_large, node_dump_large, metadata_listed_details,
        rest_lists, relation_stats_command, table_flatten, table_csv_lines, table_csv_files,
        text_truncate, text_escape, text_url, text_rgba, pct_format,
    )
}
