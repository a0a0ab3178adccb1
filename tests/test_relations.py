"""Relations, islands and profiles on hand-made and random inputs."""

import random
import re
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import shared
from millrace.operators import islands, profiles, ranks, relations
from millrace.operators.components import connected_components
from millrace.plans import documents, views

MEMBER = "relation string, side string, uuid string"


def edges(spark, rows):
    return relations.edges(spark.createDataFrame([("r", *x) for x in rows], "relation string, u0 string, u1 string"))


def members(spark, s, t):
    return spark.createDataFrame([("r", "s", x) for x in s] + [("r", "t", x) for x in t], MEMBER)


def stats(spark, rows, s, t):
    rel = spark.createDataFrame([("r", "A", "B")], "relation string, source_type string, target_type string")
    return relations.relation_stats(edges(spark, rows), members(spark, s, t), rel).first()


def test_edges_are_stripped_and_null_is_a_text(spark):
    got = edges(spark, [(" a\t", "\n b"), ("a", None), ("", "b"), ("  ", "b"), ("\xa0", "b")]).collect()
    assert sorted((r.u0, r.u1) for r in got) == [("a", "None"), ("a", "b")]


def test_orientation(spark):
    rows = [("a", "x"), ("x", "a"), ("a", "q"), ("q", "a"), ("a", "b")]
    got = relations.orient(edges(spark, rows), members(spark, ["a", "b"], ["x", "b"])).collect()
    assert sorted((r.s, r.t, r.ambiguous) for r in got) == [
        ("a", "b", False), ("a", "q", True), ("a", "x", False), ("a", "x", False), ("q", "a", True),
    ]


def test_pairs_that_fit_both_ways_stay_as_given(spark):
    got = relations.orient(edges(spark, [("a", "b"), ("b", "a")]), members(spark, ["a", "b"], ["a", "b"])).collect()
    assert sorted((r.s, r.t, r.ambiguous) for r in got) == [("a", "b", False), ("b", "a", False)]


def test_repeats_count_in_degrees_and_cardinality(spark):
    r = stats(spark, [("a", "x"), ("a", "x")], ["a", "b"], ["x"])
    assert (r.total_edges, r.unique_pairs, r.duplicate_edges, r.pairs_with_duplicates) == (2, 1, 1, 1)
    assert (r.cardinality, r.source_degree_max, r.source_total_nodes, r.source_connected_nodes) == ("many-to-many", 2, 2, 1)


def test_no_edges(spark):
    r = stats(spark, [], ["a"], [])
    assert (r.total_edges, r.cardinality, r.source_total_nodes, r.target_total_nodes, r.source_degree_avg) == (0, "empty", 1, 0, 0.0)


def test_connected_may_exceed_the_node_set(spark):
    r = stats(spark, [("a", "x"), ("b", "x")], [], ["x"])
    assert (r.source_total_nodes, r.source_connected_nodes, r.ambiguous_pairs, r.cardinality) == (0, 2, 2, "many-to-one")


def test_document_shape(spark):
    rel = spark.createDataFrame([("r", "A", "B")], "relation string, source_type string, target_type string")
    found = relations.relation_stats(edges(spark, [("a", "x")]), members(spark, ["a"], ["x"]), rel)
    doc = relations.relation_document(found).first().asDict(recursive=True)
    assert doc["relation_name"] == "r" and doc["edges"]["total_edges"] == 1 and doc["source"]["type"] == "A"


@pytest.mark.parametrize("values", [[5], [1, 2], [1, 1, 2, 9], list(range(1, 101))])
def test_percentiles_are_values(spark, values):
    rows = spark.createDataFrame([("r", "s", str(i), v) for i, v in enumerate(values)], "relation string, side string, uuid string, degree long")
    r = relations.degree_distribution(rows).first()
    v = sorted(values)
    at = lambda p: next(x for i, x in enumerate(v, 1) if i >= p * len(v))
    middle = (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2
    assert (r.degree_median, r.degree_p90, r.degree_p99, r.degree_avg) == (middle, at(0.9), at(0.99), sum(v) / len(v))


def test_two_edges_of_one_source(spark):
    """One source with two targets among 16 nodes on either side: an island of three and 29 of one."""
    ids = [f"{i:02}" for i in range(16)]
    pairs = relations.pair_counts(edges(spark, [("03", "07"), ("03", "11")]), members(spark, ids, ids))
    deg = relations.degrees(pairs)
    found = islands.sizes(islands.components(pairs, members(spark, ids, ids)), deg).cache()
    s = islands.summary(found).first()
    assert (s.total_nodes, s.total_islands, s.singleton_islands) == (32, 30, 29)
    m = islands.multi_islands(found).first()
    assert (m.size_total, m.size_source, m.size_target, m.fraction_total) == (3, 1, 2, 3 / 32)
    assert (m.top_source_uuid, m.top_source_degree, m.top_target_uuid, m.top_target_degree) == ("03", 2, "07", 1)
    side = islands.side_islands(found)
    got = {r.side: (r.total_nodes, r.total_islands, r.singleton_islands) for r in islands.side_summary(side).collect()}
    assert got == {"s": (16, 16, 16), "t": (16, 15, 14)}
    only = islands.side_multi(side).collect()
    assert [(r.side, r.size, r.fraction, r.size_total) for r in only] == [("t", 2, 0.125, 3)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components_are_those_of_union_find(spark, links):
    parent = list(range(31))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a int, b int")).collect()}
    ends = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in ends}


def test_components_of_a_chain_and_null_ends(spark):
    links = [(i, i + 1) for i in range(60)] + [(None, 3), (5, 5)]
    got = connected_components(spark.createDataFrame(links, "a int, b int")).collect()
    assert {r.component for r in got} == {0} and len(got) == 61


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("xyz")), max_size=20))
def test_degree_sums(spark, rows):
    pairs = relations.pair_counts(edges(spark, rows), members(spark, "abc", "xyz"))
    sums = {r.side: r.n for r in relations.degrees(pairs).groupBy("side").agg(F.sum("degree").alias("n")).collect()}
    counts = Counter(rows)
    assert sums == ({"s": len(rows), "t": len(rows)} if rows else {})
    e = relations.edge_summary(pairs).first()
    assert not rows or (e.duplicate_edges, e.parallel_max) == (len(rows) - len(counts), max(counts.values()))


def test_profile(spark):
    t = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, "b", None)], "k int, v string, w string")
    values = profiles.filled_values(t, "T", ["k", "v", "w"])
    counts = profiles.type_counts({"T": t, "E": t.limit(0)})
    got = [(r.name, r["count"], r.pct, r.unique_count, r.unique_pct, r["rank"]) for r in profiles.profile(values, counts).orderBy("rank").collect()]
    assert got == [("k", 3, 100.0, 3, 100.0, 1), ("v", 3, 100.0, 2, 2 / 3 * 100, 2)]


def test_profile_documents(spark):
    counts = spark.createDataFrame([("T", 2), ("E", 0)], "type string, type_count long")
    values = spark.createDataFrame([("T", "a", "1")], "type string, name string, v string")
    docs = {r.type: r for r in profiles.profile_documents(profiles.profile(values, counts), counts).collect()}
    assert docs["E"].attributes == [] and docs["T"].attributes[0].asDict() == {
        "name": "a", "count": 1, "pct": 50.0, "unique_count": 1, "unique_pct": 100.0,
    }


def test_full_document(spark):
    """Two edges of one source; a relation without edges; nodes with and without names."""
    ids = [f"{i:02}" for i in range(16)]
    rows = [("r", "03", "07"), ("r", "03", "11"), ("q", "zz", "yy")]
    edge_rows = relations.edges(spark.createDataFrame(rows, "relation string, u0 string, u1 string"))
    mem = [(r, s, x) for r in ("r", "e") for s in "st" for x in ids]
    entries = spark.createDataFrame(
        [(r, "N", "d", None, "application", "A", "a", "B", "b", None, None) for r in ("r", "e", "q")],
        "technicalName string, name string, description string, engDescription string, type string, source_type string, source_name string, "
        "target_type string, target_name string, sourceCardinality struct<min:bigint,max:bigint>, targetCardinality struct<min:bigint,max:bigint>",
    )
    names = spark.createDataFrame([("03", "Three", "c3")], "uuid string, name string, code string")
    attrs = spark.createDataFrame([("r", "k", 0, "K", None, "critical", "STRING")], "type string, name string, at int, attribute_name string, description string, mandatory string, attributeTypeEnum string")
    got = {x.relation_name: x.asDict(recursive=True) for x in documents.relation_profiles(edge_rows, spark.createDataFrame(mem, MEMBER), entries, names, attrs).collect()}
    r, e, q = got["r"]["stats"], got["e"]["stats"], got["q"]["stats"]
    assert (r["edges_total"], r["parallel_max"], r["source_connected"], r["target_connected"], r["cardinality"]) == (2, 1, 1, 2, "one-to-many")
    assert r["degree_source"] == {"min": 2, "max": 2, "avg": 2.0, "median": 2.0, "p90": 2, "p99": 2}
    assert r["top_source"] == [{"uuid": "03", "degree": 2, "name": "Three", "code": "c3"}]
    assert [x["name"] for x in r["top_target"]] == ["(unnamed)"] * 2
    assert r["islands"]["multi_islands"] == [{"size_total": 3, "size_source": 1, "size_target": 2, "fraction_total": 3 / 32, "top_source_uuid": "03", "top_source_degree": 2, "top_target_uuid": "07", "top_target_degree": 1}]
    assert r["islands"]["source"] == {"total_nodes": 16, "total_islands": 16, "singleton_islands": 16, "multi_islands": []}
    assert r["islands"]["target"]["multi_islands"] == [{"size": 2, "fraction": 0.125, "size_total": 3, "top_uuid": "07", "top_degree": 1}]
    assert got["r"]["attributes"] == [{"technicalName": "k", "name": "K", "description": None, "mandatory": "critical", "attributeTypeEnum": "STRING"}]
    assert (e["cardinality"], e["degree_source"], e["top_source"], e["parallel_max"], e["islands"]["singleton_islands"]) == ("empty", None, [], 0, 32)
    assert (q["ambiguous_pairs"], q["source_total"], q["source_connected"], q["islands"]["total_nodes"]) == (1, 0, 1, 0)


def test_ranks_in_groups_of_any_size(spark):
    rows = [("a", i, float(i % 7)) for i in range(500)] + [("b", 1, 2.0)]
    df = spark.createDataFrame(rows, "g string, i int, x double").repartition(5)
    got = ranks.ranked(df, ["g"], [F.desc("i")], total="x").collect()
    want, total = {}, 0.0
    for k, (_, i, x) in enumerate(reversed(rows[:500]), 1):
        want["a", i], total = (k, total), total + x
    assert {(r.g, r.i): (r["rank"], r.before) for r in got} == want | {("b", 1): (1, 0.0)}


def test_relations_without_metadata_have_a_message_alone(spark):
    stats = spark.createDataFrame([("r", 2, 1, 1, "many-to-many"), ("q", 1, 1, 0, "one-to-one")], "relation string, total_edges long, unique_pairs long, duplicate_edges long, cardinality string")
    meta = spark.createDataFrame([("r", "Name", " x ", "A", "a", None, "b")], "technicalName string, name string, description string, source_name string, source_type string, target_name string, target_type string")
    got = {x.relation: x for x in views.relation_view(stats, meta).collect()}
    r, q = got["r"], got["q"]
    assert (r.message, r.source_label, r.target_label, r.description, r.parallel_text, r.parallel_alert) == (None, "A (a)", "b", "x", "1 parallel edge", True)
    assert q.message == "No metadata for this relation." and q.edges_text is None and q.title is None
    names = spark.createDataFrame([("b",), ("a",)], "n string")
    assert [views.selected(names, "n", c).first().chosen for c in ("b", "z", None)] == ["b", "a", "a"] and views.selected(names.limit(0), "n", "b").first().chosen is None


def test_a_hub_and_repeats_are_counted_before_they_are_oriented(spark):
    rows = [("h", f"x{i}") for i in range(50)] * 3 + [(f"x{i}", "h") for i in range(10)]
    pairs = relations.pair_counts(edges(spark, rows), members(spark, ["h"], [f"x{i}" for i in range(49)])).collect()
    got = {(r.s, r.t): (r.n, r.ambiguous) for r in pairs}
    assert got == {("h", f"x{i}"): ((4 if i < 10 else 3), 3 if i == 49 else 0) for i in range(50)}


def test_temporary_tables_go(spark):
    folder = Path(shared.shared_folder(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    with shared.temporary_tables(spark):
        one, two = shared.written(spark.range(3), "one"), shared.written(spark.range(4), "two")
        with shared.temporary_tables(spark):
            shared.written(spark.range(5), "three")
        shared.forget(one)
        (left,) = (x.name for f in set(folder.iterdir()) - before for x in f.iterdir())
        assert left.startswith("two") and two.count() == 4
    assert set(folder.iterdir()) == before


@pytest.fixture
def many_roles(monkeypatch):
    """Roles count as too many to be sent, whatever their number."""
    monkeypatch.setattr(relations, "SENT", 0)


def test_hubs_are_found_and_orient_alike(spark, many_roles, monkeypatch):
    rng = random.Random(5)
    sources, targets = [f"s{i}" for i in range(60)], [f"t{i}" for i in range(60)] + ["s1", '"q\u0001']
    rows = [(rng.choice(["s0", *sources]), rng.choice(["t0", *targets, "?"])) for _ in range(1500)] + [("s0", rng.choice(targets)) for _ in range(900)] + [('"q\u0001', "s2")] * 300
    rows = [(b, a) if rng.random() < 0.3 else (a, b) for a, b in rows]
    df, known = edges(spark, rows), members(spark, sources, targets)
    monkeypatch.setattr(relations, "HUB", 0.05)
    found = {r.hub for r in relations.hubs(df).collect()}
    assert {"s0", '"q\u0001'} <= found and len(found) <= 40
    by_hubs = sorted(map(tuple, relations.orient(df, known).collect()))
    counts = sorted(map(tuple, relations.pair_counts(df, known).collect()))
    monkeypatch.setattr(relations, "SENT", 10**6)
    assert by_hubs == sorted(map(tuple, relations.orient(df, known).collect()))
    assert counts == sorted(map(tuple, relations.pair_counts(df, known).collect()))


@pytest.mark.parametrize("end", ["u0", "u1"])
def test_no_task_gets_a_hub(spark, many_roles, end):
    """A third of all edges have one end in common."""
    n = 60_000
    other = F.concat(F.lit("x"), (F.col("id") % 20_011).cast("string"))
    hub = F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("h"), (F.col("id") % 9_001).cast("string")))
    df = spark.range(n).select(F.lit("R").alias("relation"), *((hub.alias("u0"), other.alias("u1")) if end == "u0" else (other.alias("u0"), hub.alias("u1"))))
    ids = df.select(F.col("relation"), F.lit("s").alias("side"), F.col(end).alias("uuid")).distinct()
    roles = relations._roles(ids)
    for k, v in {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        spark.conf.set(k, v)
    try:
        joined = relations.with_role(df, roles, end, relations._few(df, roles))
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert joined.filter(f"{end}_s").count() == n
    finally:
        for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == n and len(sizes) == 16 and sizes[-1] < 2 * sizes[8]


@pytest.mark.parametrize("shape", ["chain", "star", "even", "clusters", "pairs"])
def test_components_of_many_links_are_contracted(spark, monkeypatch, shape):
    monkeypatch.setattr("millrace.operators.components.SMALL", 20)
    rng = random.Random(7)
    n = 300
    links = {
        "chain": [(i, i + 1) for i in range(n)], "star": [(0, i + 1) for i in range(n)] + [(400, 401)], "even": [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)],
        "clusters": [(30 * c + rng.randrange(30), 30 * c + rng.randrange(30)) for c in range(10) for _ in range(80)], "pairs": [(2 * i, 2 * i + 1) for i in range(n)],
    }[shape]
    links = [(f"{a:05}", f"{b:05}") for a, b in links]
    top = {x: x for e in links for x in e}
    for a, b in links:
        a, b = top[a], top[b]
        if a != b:
            top = {k: min(a, b) if v in (a, b) else v for k, v in top.items()}
    got = [tuple(r) for r in connected_components(spark.createDataFrame(links, "a string, b string")).collect()]
    assert sorted(got) == sorted((k, v) for k, v in top.items() if any(k in e and e[0] != e[1] for e in links))


@pytest.mark.parametrize("top", [5, 4095, 4096, 10**6, 1 << 40])
def test_places_are_selected_digit_by_digit(spark, top):
    rng = random.Random(top)
    values = {(g, s): [rng.randrange(top) if rng.random() < 0.7 else rng.randrange(min(top, 9)) for _ in range(rng.randrange(1, 200))] + [top] for g in "ab" for s in "st"}
    counts = spark.createDataFrame([(*k, v, n) for k, x in values.items() for v, n in Counter(x).items()], "relation string, side string, degree long, n long")
    places = {k: {f"p{i}": i for i in {1, 2, len(x) // 2 + 1, len(x) - 1 or 1, len(x)}} for k, x in values.items()}
    wanted = spark.createDataFrame([(*k, name, i) for k, p in places.items() for name, i in p.items()], "relation string, side string, name string, place long")
    got = {(r.relation, r.side, r.name): r.degree for r in relations.selected_ranks(counts, wanted, ["relation", "side"], "degree").collect()}
    assert got == {(*k, name): sorted(values[k])[i - 1] for k, p in places.items() for name, i in p.items()}


def test_distinct_values_are_counted_by_digests(spark):
    """Texts of 14 to 17 bytes, long ones that differ at the end, and one that is another one's digest."""
    import hashlib

    long = "é" * 5000
    texts = ["a" * n for n in range(1, 40)] * 3 + [long + str(i % 7) for i in range(50)] + ["x" * 15, "x" * 15 + "é", hashlib.md5(long.encode()).hexdigest(), long]
    values = spark.createDataFrame([("T", "k", t) for t in texts] + [("T", "l", "a")], "type string, name string, v string")
    found = profiles.profile(values, spark.createDataFrame([("T", 1000)], "type string, type_count long"))
    got = {r.name: (r["count"], r.unique_count) for r in found.collect()}
    assert got == {"k": (len(texts), len(set(texts))), "l": (1, 1)}
    shuffled = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(type" in x and "d#" in x]
    assert shuffled and not any(" v#" in x for x in shuffled)


def test_hubs_have_a_share_of_all_edges(spark):
    rows = [("r", f"h{i % 2}", f"x{i}") for i in range(40)] + [("r", f"y{i}", f"z{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "relation string, u0 string, u1 string")
    assert sorted(map(tuple, relations.hubs(df).collect())) == [("r", "h0"), ("r", "h1")]


@pytest.mark.parametrize("sent, hub", [(10**6, 0.001), (0, 0.9), (0, 0.02)])
def test_islands_by_numbers_are_those_by_ids(spark, monkeypatch, sent, hub):
    """Roles sent, shuffled without hubs, and with them; loops, repeats, both directions and unknown ends."""
    monkeypatch.setattr(relations, "SENT", sent)
    monkeypatch.setattr(relations, "HUB", hub)
    rng = random.Random(3)
    ids = [f"{i:02}" for i in range(60)]
    rows = [(r, rng.choice(ids), rng.choice(["00", *ids, "?"])) for r in "pq" for _ in range(45)] + [("q", "00", x) for x in ids[30:50]] + [("q", "05", "05")] * 3
    df = relations.edges(spark.createDataFrame(rows + rows[:30], "relation string, u0 string, u1 string"))
    known = spark.createDataFrame([(r, s, x) for r in "pqz" for s in "st" for x in ids if s == "s" or r != "p" or x < "40"], MEMBER).cache()
    roles = relations.numbered_roles(known)
    pairs = relations.numbered_pairs(df, roles).cache()
    own = {(r.relation, r.side, r.uuid): r.v for r in relations.vertices(roles).collect()}
    oriented = Counter((r.relation, r.s, r.t) for r in relations.orient(df, known).collect())
    assert {(r.relation, r.s, r.t): r.n for r in pairs.collect()} == oriented
    assert all((r.sv, r.tv) == (own.get((r.relation, "s", r.s)), own.get((r.relation, "t", r.t))) for r in pairs.collect())
    links = relations.numbered_links(df, roles).cache()
    assert links.groupBy("relation", "sv", "tv").agg(F.sum("n")).exceptAll(pairs.groupBy("relation", "sv", "tv").agg(F.sum("n"))).count() == 0
    tagged = islands.components(pairs, known).cache()
    want = sorted(map(tuple, islands.sizes(tagged, relations.degrees(pairs)).collect()), key=str)
    for given in (links, pairs):
        assert sorted(map(tuple, islands.components_of(given, roles).collect())) == sorted(map(tuple, tagged.collect()))
        assert sorted((tuple(r[c] for c in ("relation", "island")) + tuple(r[2:]) for r in islands.sizes_of(given, roles).collect()), key=str) == want
        counts = islands.counts_of(given, roles)
        sides = islands.side_summary(islands.side_islands(islands.sizes_of(given, roles)))
        assert sorted(map(tuple, islands.both_summaries(counts).collect())) == sorted(map(tuple, sides.collect()))


def test_stars_leave_no_links(spark, monkeypatch):
    """Their leaves join at once, on whichever side they are; only links of other shapes are contracted."""
    seen = []
    monkeypatch.setattr(islands, "connected_components", lambda links, *ends: seen.append(links.count()) or connected_components(links, *ends))
    rows = [("p", f"c{i % 5}", f"o{i}") for i in range(60)] + [("q", f"o{i}", f"c{i % 5}") for i in range(60)]
    df = spark.createDataFrame(rows, "relation string, u0 string, u1 string")
    mem = [(r, s, x) for r, kinds in (("p", "co"), ("q", "oc")) for s, k in zip("st", kinds) for x in {e for row in rows for e in row[1:] if e[0] == k}]
    roles = relations.numbered_roles(spark.createDataFrame(mem, MEMBER))
    found = islands.sizes_of(relations.numbered_links(df, roles), roles).collect()
    assert seen == [0] and sorted(r.size_total for r in found) == [13] * 10


def test_edges_are_shuffled_once_for_each_end(spark, many_roles):
    """Links without hubs: two shuffles of the edges, no sort of ids."""
    df, known = edges(spark, [(f"s{i}", f"t{i % 7}") for i in range(20_000)]), members(spark, [f"s{i}" for i in range(20_000)], [f"t{i}" for i in range(2000)])
    links = relations.numbered_links(df, relations.numbered_roles(known))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") <= 4 and "SortMergeJoin" not in plan


def test_ends_of_edges_are_made_once(spark):
    """The filter on empty ends comes after the ends are stripped, and doesn't make them from the raw columns again."""
    rows = [(" a\u2003", "\u3000"), (None, " b "), ("\t", "c"), ("", "d"), (" e", "f\n")]
    raw = spark.createDataFrame([("R", *r) for r in rows], "relation string, u0 string, u1 string")
    found = relations.edges(raw)
    assert sorted(map(tuple, found.collect())) == [("R", "None", "b"), ("R", "e", "f")]
    filters = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in x]
    assert filters and not any("trim" in x for x in filters)


def test_tasks_of_pair_counts_follow_the_rows(spark, many_roles, monkeypatch):
    """Not the setting, as a task's hash tables cost the same for few rows; more roles or edges have more tasks."""
    df, known = edges(spark, [(f"s{i}", f"t{i % 7}") for i in range(500)]), members(spark, [f"s{i}" for i in range(500)], [f"t{i}" for i in range(7)])
    roles = relations.numbered_roles(known)
    monkeypatch.setattr(relations, "HUB", 0.9)
    parts = lambda: {int(n) for n in re.findall(r"hashpartitioning\(relation[^)]*, (\d+)\), REPARTITION", relations.numbered_pairs(df, roles)._jdf.queryExecution().executedPlan().toString())}
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        assert parts() == {16}
        monkeypatch.setattr(relations, "HELD", 10)
        assert parts() == {51}
        monkeypatch.setattr(relations, "COUNTED", 5)
        assert parts() == {100}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_islands_of_one_are_counted_from_totals(spark):
    """Nodes without links have no row, in relations with edges, with edges to unknown ends alone, and without edges."""
    df = spark.createDataFrame([("p", "a", "x"), ("p", "b", "x"), ("p", "c", "?"), ("p", "a", "x"), ("q", "a", "?")], "relation string, u0 string, u1 string")
    known = spark.createDataFrame([(r, s, x) for r in "pqz" for s, ids in (("s", "abcd"), ("t", "xyz")) for x in ids if (r, s) != ("z", "t")], MEMBER)
    roles = relations.numbered_roles(known)
    pairs = relations.bare(relations.numbered_pairs(df, roles), several=True).cache()
    assert {(r.s, r.t) for r in pairs.filter("relation = 'p'").collect()} == {("a", "x"), (None, None), (None, "?")}
    every, linked, totals = islands.sizes_of(pairs, roles).cache(), islands.linked_sizes_of(pairs, roles).cache(), relations.role_totals(roles)
    assert linked.count() == 1 and every.count() == 16
    rows = lambda x: sorted(map(tuple, x.collect()))
    side, of = islands.side_islands(every), islands.side_islands(linked)
    assert rows(islands.summary(linked, totals)) == rows(islands.summary(every))
    assert rows(islands.side_summary(of, totals)) == rows(islands.side_summary(side))
    assert rows(islands.multi_islands(linked, totals)) == rows(islands.multi_islands(every))
    assert rows(islands.side_multi(of, totals)) == rows(islands.side_multi(side))
