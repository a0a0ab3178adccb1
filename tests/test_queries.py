"""Queries over the test tables against plain versions in Python, on small tables."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.plans import queries


@pytest.fixture(scope="module")
def catalogue(spark, tmp_path_factory):
    """Tables with several islands in each relation; no line has the quantity or discount that is out of the usual."""
    sf = str(tmp_path_factory.mktemp("catalogue"))
    lines = [(1, 10, 1), (2, 10, 2), (2, 11, 3), (3, 12, 1), (4, 13, 3), (4, 13, 1), (10, 14, 1), (10, 12, 3)]
    tables = {
        "supplier": ("s_suppkey long", [(i,) for i in (1, 2, 3, 4, 5, 10)]),
        "part": ("p_partkey long", [(i,) for i in range(10, 16)]),
        "lineitem": ("l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double", [(*x, 7.0, 0.02) for x in lines]),
        "customer": ("c_custkey long, c_nationkey long", [(1, 1), (2, 1), (3, 2)]),
        "orders": ("o_orderkey long, o_custkey long", [(1, 1), (2, 1), (3, 2)]),
        "nation": ("n_nationkey long, n_regionkey long", [(1, 0), (2, 0), (3, 1)]),
        "region": ("r_regionkey long", [(0,), (1,), (2,)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{sf}/{name}.parquet")
    links = {
        "supplier_part": [(f"S{s}", f"P{p}") for s, p, _ in lines if s % 10], "customer_orders": [("C1", "O1"), ("C1", "O2"), ("C2", "O3")],
        "nation_customer": [("N1", "C1"), ("N1", "C2"), ("N2", "C3")], "region_nation": [("R0", "N1"), ("R0", "N2"), ("R1", "N3")], "orders_region": [],
    }
    top = {}
    for relation, *kinds in queries.RELATIONS:
        for side, kind in zip("st", kinds, strict=True):
            ids = [f"{kind[0].upper()}{r[0]}" for r in tables[kind][1] if kind != "supplier" or r[0] % 10]
            top |= {k: k for k in ((relation, side, x) for x in ids)}
    for relation, found in links.items():
        for s, t in found:
            a, b = top[relation, "s", s], top[relation, "t", t]
            top = {k: min(a, b) if v in (a, b) else v for k, v in top.items()}
    return sf, {k: ":".join(v) for k, v in top.items()}


def test_islands_are_of_all_edges_of_all_relations(spark, catalogue):
    sf, want = catalogue
    got = {(r.relation, r.side, r.uuid): r.island for r in queries.islands_components(spark, sf).collect()}
    assert got == want


def test_island_queries_count_the_islands_of_all_edges(spark, catalogue):
    sf, want = catalogue
    size, of_side, sides = Counter(want.values()), Counter((k[:2], v) for k, v in want.items()), defaultdict(list)
    for (side, _), n in of_side.items():
        sides[side].append(n)
    multi = {r.island: r.size_total for r in queries.islands_multi(spark, sf).collect()}
    assert multi == {k: n for k, n in size.items() if n > 1} and len(multi) > 5
    relations = {k.split(":")[0] for k in size}
    got = {r.relation: (r.total_nodes, r.total_islands, r.singleton_islands) for r in queries.islands_summary(spark, sf).collect()}
    each = {x: [n for k, n in size.items() if k.split(":")[0] == x] for x in relations}
    assert got == {x: (sum(n), len(n), n.count(1)) for x, n in each.items()}
    got = {(r.relation, r.side): (r.total_nodes, r.total_islands, r.singleton_islands) for r in queries.islands_side(spark, sf).collect()}
    assert got == {k: (sum(n), len(n), n.count(1)) for k, n in sides.items()}
    several = {(k, v): n for (k, v), n in of_side.items() if n > 1}
    side_multi = queries.islands_side_multi(spark, sf).collect()
    assert {((r.relation, r.side), r.island): r["size"] for r in side_multi} == several
    pie = queries.islands_pie_layout(spark, sf)
    assert pie.count() == len(several) and pie.groupBy("relation", "side").agg(F.sum("part").alias("x")).filter("abs(x - 1) > 1e-6").count() == 0


def test_escape_takes_whole_pages(spark, tmp_path):
    """Signs behind the 500th character, and a page without text."""
    pages = {1: "a" * 600 + "<b class=\"x\">&amp;</b>'", 2: "<" * 1200, 3: "", 4: None}
    spark.createDataFrame(list(pages.items()), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.escaped for r in queries.text_escape(spark, str(tmp_path)).collect()}
    swap = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;"}
    assert got == {i: "".join(swap.get(c, c) for c in t or "") for i, t in pages.items()}
