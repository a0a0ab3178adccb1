"""Statistics of relations, that is of edges between typed nodes.

Edges are (relation, u0, u1) rows, repeats included; members are (relation,
side, uuid) rows, side being 's' or 't'.  Every operator works on all relations
at once, so that one shuffle serves them all, whatever their sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import strip
from millrace.operators.ranks import ranked
from millrace.shared import written


def edges(raw: DataFrame, relation: str = "relation", u0: str = "u0", u1: str = "u1") -> DataFrame:
    """(relation, u0, u1): ends are stripped; a null end is the text 'None'; rows with an empty end go."""
    end = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    row = F.struct(F.col(relation).alias("relation"), strip(end(u0)).alias("u0"), strip(end(u1)).alias("u1"))
    # The generator keeps the filter behind it, which else computes both ends once more.
    return raw.select(F.inline(F.array(row))).filter("u0 <> '' AND u1 <> ''")


def node_ids(nodes: DataFrame, uuid: str = "uuid") -> DataFrame:
    """(uuid): the distinct ids that aren't null or empty; they aren't stripped."""
    return nodes.select(F.col(uuid).cast("string").alias("uuid")).filter("uuid <> ''").distinct()


#: Members' roles that are sent to all tasks (some 100 bytes each); of more, the hubs' alone are.
SENT = 500_000
#: An end of this share of all edges is a hub, 2 / HUB at most.
HUB = 0.001
#: Ranges of hashes that the edges of either end are counted by to find hubs; of both ends these are 2^16, as many groups as
#: Spark's generated aggregation holds in its fast map.
BUCKETS = 32_768
#: Parts that a hub's edges are dealt out in.
DEALT = 4096
#: Roles that a task holds at a time in a join with edges, about, and edges that it counts.
HELD = 500_000
COUNTED = 1_500_000


def numbered_roles(members: DataFrame) -> DataFrame:
    """(r, uuid, is_s, is_t, num), written: on which sides a relation knows a node, and a number of its own."""
    side = lambda x: F.bool_or(F.col("side") == x)
    found = members.groupBy(F.col("relation").alias("r"), "uuid").agg(side("s").alias("is_s"), side("t").alias("is_t"))
    return written(found.withColumn("num", F.monotonically_increasing_id()), "roles")


_roles = numbered_roles


def _vertex(num: str, side: str) -> Column:
    """The number of a node on a side."""
    return F.shiftleft(F.col(num), 1) + (1 if side == "t" else 0)


def vertices(roles: DataFrame) -> DataFrame:
    """(relation, side, uuid, v): each member once, with its number as ``numbered_pairs`` has it."""
    own = [F.when(F.col(f"is_{x}"), F.struct(F.lit(x).alias("side"), _vertex("num", x).alias("v"))) for x in "st"]
    each = roles.select(F.col("r").alias("relation"), "uuid", F.explode(F.array(*own)).alias("x"))
    return each.filter("x IS NOT NULL").select("relation", "x.side", "uuid", "x.v")


def hubs(edge_rows: DataFrame) -> DataFrame:
    """(hr, hub): the ends of ``HUB`` of all edges or more.

    Edges are counted by ranges of a hash of either end; ends are counted themselves only in ranges that have that many.
    """
    return _hubs(edge_rows)[0]


def _hubs(edge_rows: DataFrame) -> tuple[DataFrame, int]:
    """``hubs``, and how many edges there are."""
    at = {"u0": 0, "u1": BUCKETS}
    bucket = lambda c: F.pmod(F.xxhash64("relation", c), F.lit(BUCKETS)) + at[c]
    counts = edge_rows.select(F.explode(F.array(bucket("u0"), bucket("u1"))).alias("b")).groupBy("b").agg(F.count("*").alias("n")).collect()
    total = sum(r.n for r in counts) // 2
    least = HUB * total
    found = edge_rows.sparkSession.range(0).select(F.lit("").alias("hr"), F.lit("").alias("hub"))
    for c, first in at.items():
        if heavy := [r.b for r in counts if r.n >= least and first <= r.b < first + BUCKETS]:
            own = edge_rows.filter(bucket(c).isin(heavy)).groupBy(F.col("relation").alias("hr"), F.col(c).alias("hub")).count()
            found = found.union(own.filter(F.col("count") >= least).select("hr", "hub"))
    return found.distinct(), total


def with_role(rows: DataFrame, roles: DataFrame, end: str, few: DataFrame | None) -> DataFrame:
    """The rows with ``<end>_s`` and ``<end>_t``: whether their end is a source or a target; null for unknown nodes.

    ``few`` has the roles of ``hubs``: their edges meet these in a broadcast and are dealt out at random in the join with
    all others, so that no task gets more than its share.  None sends all roles.
    """
    if few is None:
        return rows.join(F.broadcast(_of_end(roles, end)), (F.col(end) == F.col("id")) & (F.col("relation") == F.col("r")), "left").drop("r", "id")
    # Ids come first: sorting compares the first bytes of the first key, and relations are few.
    return _met(_keyed(rows, end, few).join(_of_end(roles, end), (F.col("join_key") == F.col("id")) & (F.col("relation") == F.col("r")), "left"), end)


_OF_ROLE = ("s", "t", "num")


def _of_end(roles: DataFrame, end: str) -> DataFrame:
    return roles.select("r", F.col("uuid").alias("id"), F.col("is_s").alias(f"{end}_s"), F.col("is_t").alias(f"{end}_t"), F.col("num").alias(f"{end}_num"))


def _keyed(rows: DataFrame, end: str, few: DataFrame) -> DataFrame:
    """The rows with the roles of hubs and ``join_key``: the end, or a random part for hubs."""
    known = rows.join(F.broadcast(few), (F.col("relation") == F.col("hr")) & (F.col(end) == F.col("hub")), "left").drop("hr")
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("u0", "u1"), F.lit(DEALT)).cast("string"))
    return known.withColumn("join_key", F.when(F.col("hub").isNotNull(), spread).otherwise(F.col(end)))


def _met(joined: DataFrame, end: str) -> DataFrame:
    """Hubs take the roles that were sent, in rows that ``_keyed`` made and that are joined with the others."""
    taken = {f"{end}_{x}": F.when(F.col("hub").isNotNull(), F.col(f"hub_{x}")).otherwise(F.col(f"{end}_{x}")) for x in _OF_ROLE}
    return joined.withColumns(taken).drop("r", "id", "hub", *[f"hub_{x}" for x in _OF_ROLE], "join_key")


def _oriented(edge_rows: DataFrame, roles: DataFrame, few: DataFrame | None) -> DataFrame:
    known = with_role(with_role(edge_rows, roles, "u0", few), roles, "u1", few)
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    kept, turned = yes("u0_s") & yes("u1_t"), yes("u0_t") & yes("u1_s")
    swap = ~kept & turned
    return known.select(
        "relation",
        F.when(swap, F.col("u1")).otherwise(F.col("u0")).alias("s"),
        F.when(swap, F.col("u0")).otherwise(F.col("u1")).alias("t"),
        (~kept & ~turned).alias("ambiguous"),
        *[c for c in edge_rows.columns if c not in ("relation", "u0", "u1")],
    )


def _few(edge_rows: DataFrame, roles: DataFrame) -> DataFrame | None:
    """The roles of hubs; None if all roles are few enough to be sent."""
    return None if roles.count() <= SENT else _hub_roles(hubs(edge_rows), roles)


def _hub_roles(found: DataFrame, roles: DataFrame) -> DataFrame:
    own = roles.join(F.broadcast(found), (F.col("r") == F.col("hr")) & (F.col("uuid") == F.col("hub"))).select("hr", "hub", F.col("is_s").alias("hub_s"), F.col("is_t").alias("hub_t"), F.col("num").alias("hub_num"))
    return written(found.join(own, ["hr", "hub"], "left"), "hubs")


def orient(edge_rows: DataFrame, members: DataFrame) -> DataFrame:
    """(relation, s, t, ambiguous, further columns): each edge from its source to its target.

    An edge as given is kept if its ends are a source and a target; else it is
    turned if that fits; else it is kept as given and ambiguous.
    """
    roles = _roles(members)
    return _oriented(edge_rows, roles, _few(edge_rows, roles))


def pair_counts(edge_rows: DataFrame, members: DataFrame) -> DataFrame:
    """(relation, s, t, n, ambiguous): how many edges each oriented pair has, and how many of them are ambiguous."""
    return numbered_pairs(edge_rows, numbered_roles(members)).drop("sv", "tv")


def numbered_pairs(edge_rows: DataFrame, roles: DataFrame) -> DataFrame:
    """``pair_counts`` with ``sv`` and ``tv``, the numbers of source and target (``vertices``); null for an end that the
    relation doesn't know on that side.

    Edges of both directions between two ends are counted in one row before they are oriented.
    """
    known, first, ambiguous = _known(edge_rows, roles, True)
    none = F.lit(0).cast("bigint")
    pair = lambda s, t, n: F.struct(
        F.col(s).alias("s"), F.col(t).alias("t"), n.alias("n"), F.when(ambiguous, n).otherwise(none).alias("ambiguous"),
        _number(s, "s").alias("sv"), _number(t, "t").alias("tv"),
    )
    both = known.withColumn("first", first).select(
        "relation", F.explode(F.array(pair("u0", "u1", F.col("first")), pair("u1", "u0", F.col("along") + F.col("back") - F.col("first")))).alias("x")
    )
    return both.filter("x.n > 0").select("relation", "x.*")


def numbered_links(edge_rows: DataFrame, roles: DataFrame) -> DataFrame:
    """(relation, n, sv, tv): ``numbered_pairs`` without ids, where a pair may have several rows; it isn't grouped."""
    known, first, _ = _known(edge_rows, roles, False)
    end = lambda u, w, side: F.when(F.col("given"), _number(u, side)).otherwise(_number(w, side))
    known = known.withColumn("given", first > 0)
    return known.select("relation", (F.col("along") + F.col("back")).alias("n"), end("u0", "u1", "s").alias("sv"), end("u1", "u0", "t").alias("tv"))


def _number(end: str, side: str) -> Column:
    return F.when(F.col(f"{end}_{side}"), _vertex(f"{end}_num", side))


def _known(edge_rows: DataFrame, roles: DataFrame, grouped: bool) -> tuple[DataFrame, Column, Column]:
    """(relation, u0, u1, along, back) with the roles of both ends: u0 is the lesser end, ``along`` counts the edges from it
    and ``back`` those to it.  Then how many of these have u0 for their source, and whether they are ambiguous.

    Where roles aren't sent, that takes a shuffle by the first end, whose roles it meets there, and one by the second.
    Where there are hubs and each edge is there twice or more by an estimate, equal ones are counted before these.
    """
    all_roles = roles.count()
    few, has_hubs, all_edges = None, False, 0
    if all_roles > SENT:
        found, all_edges = _hubs(edge_rows)
        found = written(found, "hubs")
        if has_hubs := not found.isEmpty():
            few = _hub_roles(found, roles)
    given = edge_rows.withColumn("n", F.lit(1).cast("bigint"))
    if has_hubs:
        about = edge_rows.agg(F.count("*").alias("all"), F.approx_count_distinct(F.xxhash64("relation", "u0", "u1")).alias("kinds")).first()
        if about["all"] >= 2 * about["kinds"]:
            given = edge_rows.groupBy("relation", "u0", "u1").agg(F.count("*").alias("n"))
    back, none = F.col("u0") > F.col("u1"), F.lit(0).cast("bigint")
    known = given.select(
        "relation", F.least("u0", "u1").alias("u0"), F.greatest("u0", "u1").alias("u1"),
        F.when(back, none).otherwise(F.col("n")).alias("along"), F.when(back, F.col("n")).otherwise(none).alias("back"),
    )
    count = lambda x: x.groupBy(*[c for c in x.columns if c not in ("along", "back")]).agg(F.sum("along").alias("along"), F.sum("back").alias("back"))
    if all_roles <= SENT:
        known = with_role(with_role(count(known) if grouped else known, roles, "u0", None), roles, "u1", None)
    else:
        # A task's hash tables cost the same for few rows, so there are no more tasks than the rows ask for.
        parts = max(4 * roles.sparkSession.sparkContext.defaultParallelism, -(-all_roles // HELD), -(-all_edges // COUNTED))
        own = roles.repartition(parts, "r", "uuid")
        for end in ("u0", "u1"):
            key = "join_key" if has_hubs else end
            keyed = (_keyed(known, end, few) if has_hubs else known).repartition(parts, "relation", key)
            keyed = count(keyed) if grouped and end == "u0" else keyed
            on = (F.col("relation") == F.col("r")) & (F.col(key) == F.col("id"))
            joined = keyed.join(_of_end(own, end).hint("shuffle_hash"), on, "left")
            known = _met(joined, end) if has_hubs else joined.drop("r", "id")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    fits, turned = yes("u0_s") & yes("u1_t"), yes("u1_s") & yes("u0_t")
    first = F.when(fits & ~turned, F.col("along") + F.col("back")).when(turned & ~fits, none).otherwise(F.col("along"))
    return known, first, ~(fits | turned)


def bare(pairs: DataFrame, several: bool = False) -> DataFrame:
    """``numbered_pairs`` with the ids of ends without a number alone and, if ``several``, of pairs of several edges."""
    return pairs.withColumns({c: F.when(F.col(f"{c}v").isNull() | (F.lit(several) & (F.col("n") > 1)), F.col(c)) for c in "st"})


def edge_summary(pairs: DataFrame) -> DataFrame:
    """Per relation with edges: total_edges, unique_pairs, duplicate_edges, pairs_with_duplicates,
    parallel_edges, parallel_max, ambiguous_pairs."""
    return pairs.groupBy("relation").agg(
        F.sum("n").cast("bigint").alias("total_edges"),
        F.count("*").alias("unique_pairs"),
        F.sum(F.col("n") - 1).cast("bigint").alias("duplicate_edges"),
        F.count_if(F.col("n") > 1).alias("pairs_with_duplicates"),
        F.sum(F.col("n") - 1).cast("bigint").alias("parallel_edges"),
        F.max("n").alias("parallel_max"),
        F.sum("ambiguous").cast("bigint").alias("ambiguous_pairs"),
    )


def degrees(pairs: DataFrame) -> DataFrame:
    """(relation, side, uuid, degree): edges at each node, repeats counted."""
    ends = F.array(
        F.struct(F.lit("s").alias("side"), F.col("s").alias("uuid")), F.struct(F.lit("t").alias("side"), F.col("t").alias("uuid"))
    )
    return (
        pairs.select("relation", "n", F.explode(ends).alias("end"))
        .groupBy("relation", "end.side", "end.uuid")
        .agg(F.sum("n").cast("bigint").alias("degree"))
    )


def numbered_degrees(pairs: DataFrame) -> DataFrame:
    """(relation, side, v, uuid, degree): ``degrees`` of ``numbered_pairs`` or ``bare`` ones; ``uuid`` is of nodes without a number alone."""
    ends = F.array(
        *[F.struct(F.lit(c).alias("side"), F.col(f"{c}v").alias("v"), F.when(F.col(f"{c}v").isNull(), F.col(c)).alias("uuid")) for c in "st"]
    )
    return (
        pairs.select("relation", "n", F.explode(ends).alias("end"))
        .groupBy("relation", "end.side", "end.v", "end.uuid")
        .agg(F.sum("n").cast("bigint").alias("degree"))
    )


def member_totals(members: DataFrame) -> DataFrame:
    """(relation, side, total_nodes)."""
    return members.distinct().groupBy("relation", "side").agg(F.count("*").alias("total_nodes"))


def role_totals(roles: DataFrame) -> DataFrame:
    """``member_totals`` from the roles, for sides that have members."""
    own = roles.groupBy(F.col("r").alias("relation")).agg(F.count_if("is_s").alias("s"), F.count_if("is_t").alias("t"))
    each = F.array(*[F.struct(F.lit(x).alias("side"), F.col(x).alias("total_nodes")) for x in "st"])
    return own.select("relation", F.explode(each).alias("x")).select("relation", "x.*").filter("total_nodes > 0")


def side_summary(degree_rows: DataFrame, sides: DataFrame) -> DataFrame:
    """Per (relation, side) of ``sides`` (with total_nodes): connected_nodes, degree_min, degree_max, degree_avg.

    Averages are over connected nodes, which may lie outside the node set; all are 0 without edges.
    """
    own = degree_rows.groupBy("relation", "side").agg(
        F.count("*").alias("connected_nodes"),
        F.min("degree").alias("degree_min"),
        F.max("degree").alias("degree_max"),
        F.avg("degree").alias("degree_avg"),
    )
    return sides.join(own, ["relation", "side"], "left").na.fill(
        0, ["connected_nodes", "degree_min", "degree_max", "degree_avg", "total_nodes"]
    )


def cardinality(degree_rows: DataFrame, relations: DataFrame) -> DataFrame:
    """(relation, cardinality) for each of ``relations``, by the largest degree of either side."""
    most = degree_rows.groupBy("relation").agg(
        F.max(F.when(F.col("side") == "s", F.col("degree"))).alias("s"),
        F.max(F.when(F.col("side") == "t", F.col("degree"))).alias("t"),
    )
    return relations.select("relation").distinct().join(most, "relation", "left").select("relation", _kind(F.col("s"), F.col("t")).alias("cardinality"))


def _kind(s: Column, t: Column) -> Column:
    """Cardinality by the largest degree of either side; null or 0 without edges."""
    return (
        F.when(F.coalesce(s, F.lit(0)) == 0, "empty")
        .when((s <= 1) & (t <= 1), "one-to-one")
        .when(t <= 1, "one-to-many")
        .when(s <= 1, "many-to-one")
        .otherwise("many-to-many")
    )


#: Bits of a value that one round of ``selected_ranks`` decides.
DIGIT = 12


def selected_ranks(counts: DataFrame, wanted: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """``wanted`` (by, name, place) with the ``value`` at that place, from 1, of each group's values in order.

    ``counts`` has (by, value, n), n being how often the value, a whole number from 0, is there.  Values are told apart a
    digit of ``DIGIT`` bits at a time, the highest first: a histogram of the digit, 4,096 rows at most, shows which one
    holds the place.  So no group's values are ever put in order, however many there are.
    """
    top = counts.agg(F.max(value).alias("m")).first().m or 0
    rounds = max(1, -(-int(top).bit_length() // DIGIT))
    key = [*by, "name"]
    found = wanted.select(*key, F.col("place").cast("bigint").alias("place"), F.lit(0).cast("bigint").alias("prefix"))
    for shift in range(DIGIT * (rounds - 1), -1, -DIGIT):
        own = counts.join(found, by).filter(F.expr(f"shiftright({value}, {shift + DIGIT})") == F.col("prefix"))
        digits = own.groupBy(*key, "place", F.expr(f"shiftright({value}, {shift})").alias("digits")).agg(F.sum("n").alias("n"))
        up_to = F.sum("n").over(Window.partitionBy(*key).orderBy("digits").rowsBetween(Window.unboundedPreceding, 0))
        held = digits.withColumn("up_to", up_to).filter((F.col("up_to") >= F.col("place")) & (F.col("up_to") - F.col("n") < F.col("place")))
        found = held.select(*key, (F.col("place") - (F.col("up_to") - F.col("n"))).alias("place"), F.col("digits").alias("prefix"))
    return found.select(*key, F.col("prefix").alias(value))


def degree_distribution(degree_rows: DataFrame) -> DataFrame:
    """Per (relation, side) with edges: min, max, avg, median, p90, p99 of degrees.

    The percentiles are values that occur, selected among the counts of equal degrees.
    """
    by = ["relation", "side"]
    counts = written(degree_rows.groupBy(*by, "degree").agg(F.count("*").alias("n")), "degree-counts")
    about = counts.groupBy(*by).agg(
        F.sum("n").alias("all"), F.min("degree").alias("degree_min"), F.max("degree").alias("degree_max"),
        (F.sum(F.col("degree") * F.col("n")) / F.sum("n")).alias("degree_avg"),
    )
    places = {"low": F.floor((F.col("all") + 1) / 2), "high": F.floor((F.col("all") + 2) / 2), "p90": F.ceil(0.9 * F.col("all")), "p99": F.ceil(0.99 * F.col("all"))}
    each = F.array(*[F.struct(F.lit(name).alias("name"), place.cast("bigint").alias("place")) for name, place in places.items()])
    wanted = about.select(*by, F.explode(each).alias("x")).select(*by, "x.*")
    at = lambda name: F.max(F.when(F.col("name") == name, F.col("degree")))
    found = selected_ranks(counts, wanted, by, "degree").groupBy(*by).agg(
        ((at("low") + at("high")) / 2).alias("degree_median"), at("p90").alias("degree_p90"), at("p99").alias("degree_p99")
    )
    return about.drop("all").join(found, by)


def parallel_pairs(pairs: DataFrame) -> DataFrame:
    """(relation, s, t, n, rank): pairs of several edges; rank 1 has the most, ties by ids."""
    several = pairs.filter("n > 1").select("relation", "s", "t", "n")
    return ranked(several, ["relation"], [F.desc("n"), F.asc("s"), F.asc("t")])


def top_nodes(degree_rows: DataFrame, names: DataFrame | None = None, k: int = 10) -> DataFrame:
    """(relation, side, uuid, degree, rank[, name, code]): the ``k`` nodes of most edges on either side.

    ``names`` has (uuid, name, code); a node without a name is '(unnamed)'.
    """
    order = Window.partitionBy("relation", "side").orderBy(F.desc("degree"), "uuid")
    top = degree_rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    if names is None:
        return top
    return top.join(names, "uuid", "left").withColumn("name", F.coalesce(F.nullif("name", F.lit("")), F.lit("(unnamed)")))


def relation_stats(edge_rows: DataFrame, members: DataFrame, relations: DataFrame) -> DataFrame:
    """The flat document of each of ``relations`` (relation, source_type, target_type): edges, both sides, cardinality."""
    roles = numbered_roles(members)
    pairs = written(bare(numbered_pairs(edge_rows, roles)), "pairs")
    return pair_stats(pairs, role_totals(roles), relations, numbered_degrees(pairs))


def pair_stats(pairs: DataFrame, totals: DataFrame, relations: DataFrame, degree_rows: DataFrame | None = None) -> DataFrame:
    """``relation_stats`` from the pair counts and ``member_totals``, and their degrees if these are there."""
    degree_rows = degrees(pairs) if degree_rows is None else degree_rows
    sides = relations.select("relation", F.explode(F.array(F.lit("s"), F.lit("t"))).alias("side")).join(totals, ["relation", "side"], "left")
    summary = side_summary(degree_rows, sides)
    wide = summary.groupBy("relation").agg(
        *[
            F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{name}_{c}")
            for side, name in (("s", "source"), ("t", "target"))
            for c in ("total_nodes", "connected_nodes", "degree_min", "degree_max", "degree_avg")
        ]
    )
    counts = ["total_edges", "unique_pairs", "duplicate_edges", "pairs_with_duplicates", "ambiguous_pairs"]
    return (
        relations.join(edge_summary(pairs).select("relation", *counts), "relation", "left")
        .na.fill(0, counts)
        .join(wide, "relation")
        .withColumn("cardinality", _kind(F.col("source_degree_max"), F.col("target_degree_max")))
    )


def relation_document(stats: DataFrame) -> DataFrame:
    """The flat document nested as it is written: edges, source, target, cardinality."""
    edge = F.struct("total_edges", "unique_pairs", "duplicate_edges", "pairs_with_duplicates", "ambiguous_pairs")
    side = lambda x: F.struct(
        F.col(f"{x}_type").alias("type"),
        *[F.col(f"{x}_{c}").alias(c) for c in ("total_nodes", "connected_nodes", "degree_min", "degree_max", "degree_avg")],
    )
    return stats.select(
        F.col("relation").alias("relation_name"), "source_type", "target_type", edge.alias("edges"),
        side("source").alias("source"), side("target").alias("target"), "cardinality",
    )
