"""Files, metadata, snapshots and texts."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.plans import views
from millrace.sources import catalogue


def put(folder, name, value, raw=False):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(value if raw else json.dumps(value), encoding="utf-8")


def document(parts):
    return json.loads("\n".join(r.value for r in parts.orderBy("part", "place").collect()))


def table(headers, rows, kind="TABLE"):
    return {"type": kind, "result": {"headers": [{"name": h} for h in headers], "rows": [{"values": r} for r in rows]}}


def test_edge_tables(spark, tmp_path):
    put(tmp_path, "R.json", table(["a", "b", "c"], [["u", "v", "w"], ["u"], ["u", None], ["u", "v"]]))
    put(tmp_path, "notes.txt", "no", raw=True)
    got = catalogue.edge_tables(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("R", "u", "v"), ("R", "u", None), ("R", "u", "v")]


@pytest.mark.parametrize("doc", [table(["a"], [["u", "v"]]), table(["a", "b"], [["u", "v"]], "LIST")])
def test_what_is_no_edge_table_fails(spark, tmp_path, doc):
    put(tmp_path, "R.json", doc)
    with pytest.raises(Exception, match="not a table"):
        catalogue.edge_tables(spark, str(tmp_path)).collect()


def test_node_dumps(spark, tmp_path):
    put(tmp_path, "A.json", {"result": [{"uuid": "1"}, {"uuid": None}]})
    put(tmp_path, "B.json", [{"uuid": "2"}, {"other": 1}])
    got = sorted((r.type, r.uuid) for r in catalogue.node_dumps(spark, str(tmp_path)).filter("uuid is not null").collect())
    assert got == [("A", "1"), ("B", "2")]
    put(tmp_path, "C.json", {"x": 1})
    with pytest.raises(Exception, match="no list"):
        catalogue.node_dumps(spark, str(tmp_path)).collect()


def test_listed(spark):
    rows = ["[1, 2]", '{"items": ["a"], "result": "no"}', '{"x": 3, "y": ["b"]}', '{"k": 1, "l": 2}', "{}", '{"name": "[x]", "other": [1, {"a": "b"}]}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    got = [r.x for r in df.select("i", catalogue.listed(F.col("v")).alias("x")).orderBy("i").collect()]
    assert got == [["1", "2"], ["a"], ["b"], ["k", "l"], [], ["1", '{"a":"b"}']]


def test_csv_is_what_the_csv_module_writes(spark, tmp_path):
    rows = [["1", 'say "hi"', None], ["2", "a;b\nč", ""]]
    put(tmp_path / "in", "T.json", table(["k", "v", "ž"], rows))
    catalogue.write_csv(catalogue.csv_lines(catalogue.tables(spark, str(tmp_path / "in"))), str(tmp_path / "out"))
    (part,) = (tmp_path / "out" / "stem=T").glob("*.txt")
    want = io.StringIO(newline="")
    w = csv.writer(want, delimiter=";", quoting=csv.QUOTE_ALL)
    w.writerows([["k", "v", "ž"], *[["" if x is None else x for x in r] for r in rows]])
    assert part.read_bytes() == want.getvalue().encode("utf-8-sig")


def test_snapshots(spark, tmp_path):
    for date, kind, stem in (("2025-11-3", "attributes", "KS"), ("2025-11-13", "relation_attributes", "R"), ("2025-11-13", "attributes", "A"), ("2025-11-20", "holistic", "X")):
        put(tmp_path / date / kind, f"{stem}.json", {})
    index = catalogue.snapshot_index(catalogue.snapshot_files(spark, str(tmp_path)))
    got = {r.date: (r.node_types, r.relations) for r in index.collect()}
    assert got == {"2025-11-3": (["KS"], []), "2025-11-13": (["A"], ["R"])}
    assert catalogue.latest_snapshot(index).first().date == "2025-11-3"
    assert catalogue.latest_snapshot(index, "chronological").first().date == "2025-11-13"


def test_documents_keep_nulls_and_replace_only_their_folder(spark, tmp_path):
    a = spark.createDataFrame([("s1", "R", None)], "snapshot string, relation string, x int")
    catalogue.write_documents(a, str(tmp_path / "o"), ["snapshot"])
    catalogue.write_documents(spark.createDataFrame([("s2", "R", 1)], a.schema), str(tmp_path / "o"), ["snapshot"])
    (part,) = (tmp_path / "o" / "snapshot=s1").glob("*.json")
    assert json.loads(part.read_text()) == {"relation": "R", "x": None}


def attr(name, technical, mandatory=None):
    return {"name": name, "technicalName": technical, "mandatory": mandatory and {"type": mandatory}}


def test_metadata(spark, tmp_path):
    put(tmp_path / "n", "A.json", {"technicalName": "A", "name": "", "type": "application", "labels": ["x"], "attributes": [attr("one", "k"), attr("two", "k", "critical"), attr("no", "")]})
    put(tmp_path / "n", "B.json", {"technicalName": "B", "name": "Bee", "type": "system"})
    details = catalogue.read_documents(spark, str(tmp_path / "n"), catalogue.NODE_TYPE)
    listing = spark.createDataFrame([("A", "Ay", "d", None, ["codelist"]), ("C", "Cee", None, None, None)], "technicalName string, name string, description string, type string, labels array<string>")
    (entry,) = catalogue.node_index(listing, details.drop("stem")).collect()
    assert (entry.name, entry.description, entry.labels, entry.is_codelist, entry.is_system) == ("Ay", "d", ["codelist"], True, False)
    attrs = catalogue.attribute_rows(details)
    assert [(r.type, r.name, r.attribute_name, r.mandatory) for r in attrs.collect()] == [("A", "k", "two", "critical")]
    doc = document(catalogue.index_document(catalogue.node_index(listing, details.drop("stem")), attrs, "types"))
    assert list(doc["types"]) == ["A"] and doc["types"]["A"] == {
        "technicalName": "A", "name": "Ay", "description": "d", "typeKind": "application", "labels": ["codelist"], "isApplication": True, "isSystem": False,
        "isCodelist": True, "attributes": {"k": {"name": "two", "description": None, "mandatory": "critical", "opendata": None, "attributeTypeEnum": None, "readOnly": None, "invisible": None}},
    }


def test_relation_metadata_without_ends(spark, tmp_path):
    put(tmp_path, "R.json", {"technicalName": "R", "sources": [], "targets": [{"technicalName": "T"}], "targetCardinality": {"min": 0, "max": None}})
    r = catalogue.relation_index(catalogue.read_documents(spark, str(tmp_path), catalogue.RELATION_TYPE)).first()
    assert (r.source_type, r.source_labels, r.target_type, r.targetCardinality.max) == (None, [], "T", None)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("pct", "want"),
    [(0.0, "0%"), (None, "0%"), (float("nan"), "0%"), (1e-5, "0.00001%"), (0.005, "0.005%"), (0.0099, "0.0099%"), (0.01, "0.010%"), (100.0, "100.000%"), (1e-12, "0%"), (12.0625, "12.063%"), (1.0005, "1.000%")],
)
def test_percent(spark, pct, want):
    assert one(spark, text.percent(F.lit(pct).cast("double"), 3, 8)) == want


@pytest.mark.parametrize(("x", "want"), [(None, ""), ("", ""), ("a" * 100, "a" * 100), ("a" * 101, "a" * 99 + "…")])
def test_truncated(spark, x, want):
    assert one(spark, text.truncated(F.lit(x).cast("string"), 100)) == want


@pytest.mark.parametrize(("x", "want"), [(None, "(missing description)"), (" \t", "(missing description)"), ("b" * 80, "b" * 80), ("b" * 81, "b" * 77 + "…")])
def test_short_description(spark, x, want):
    assert one(spark, text.short_description(F.lit(x).cast("string"))) == want


@pytest.mark.parametrize(("pct", "want"), [(9.99, "rare"), (10.0, "common"), (99.99, "common"), (100.0, "required")])
def test_tier(spark, pct, want):
    assert one(spark, text.tier(F.lit(pct))) == want


def test_small_texts(spark):
    assert one(spark, text.escaped(F.lit("<a & \"b\" 'c'>"))) == "&lt;a &amp; &quot;b&quot; 'c'&gt;"
    assert one(spark, text.escaped(F.lit(None).cast("string"))) == ""
    assert one(spark, text.rgba(F.lit("rgba(55, 65, 81, 0.8)"))) == [55, 65, 81, 0.8]
    assert one(spark, text.rgba(F.lit("rgb(1,2,3)"))) == [1, 2, 3, 1] and one(spark, text.rgba(F.lit("red"))) == [0, 0, 0, 1]
    assert one(spark, text.url_component(F.lit("a b/č(1)!"))) == "a%20b%2F%C4%8D(1)!"
    assert one(spark, text.label(F.lit(""), F.lit("T"))) == "T" and one(spark, text.label(F.lit("N"), F.lit("T"))) == "N (T)"


def test_attribute_view(spark):
    p = spark.createDataFrame([("T", "a", 10, 10, 100.0, 10, 100.0, 1), ("T", "b", 10, 1, 2.0, 1, 1.0, 2)], "type string, name string, type_count long, count long, pct double, unique_count long, unique_pct double, rank int")
    m = spark.createDataFrame([("T", "a", "Name", None, "critical")], "type string, name string, attribute_name string, description string, mandatory string")
    a, b = views.attribute_view(p, m).orderBy("rank").collect()
    assert (a.display_name, a.subtitle, a.bar, a.unique_bar, a.tier) == ("Name (a) *", "(missing attribute description)", "100.00%", "calc(100.00% - 2 * 3px)", "required")
    assert (b.display_name, b.bar, b.unique_bar, b.tier, b.pct_text) == ("b", "12px", "6px", "rare", "2.000%")
    assert views.searched(p, " A ").count() == 1 and views.searched(p, "_").count() == 0 and views.searched(p, "", 0).count() == 2


def test_pie(spark):
    f = spark.createDataFrame([("r", "s", "i", 0.3), ("r", "s", "j", 0.1), ("r", "s", "k", 0.0)], "relation string, side string, island string, fraction double")
    got = views.pie_layout(f).orderBy("idx").collect()
    assert [(r.island, round(r.part, 9), round(r.start, 9), r.idx, r.r) for r in got] == [("i", 0.75, 0.0, 0, 235), ("j", 0.25, 0.75, 1, 220)]


def test_pie_has_equal_bits_under_any_partitioning(spark):
    rng = random.Random(2)
    rows = [("r", "s", f"i{k}", rng.random() ** 9, rng.randrange(1, 10**6)) for k in range(700)] + [("r", "t", "x", float("nan"), 0), ("r", "t", "y", 0.1, 7)]
    df = spark.createDataFrame(rows, "relation string, side string, island string, fraction double, size long")
    for weight in ("fraction", "size"):
        found = []
        for n in (1, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            found.append(sorted(map(tuple, views.pie_layout(df.repartition(n), weight).collect())))
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert found[0] == found[1] and len(found[0]) == 701
        starts = sorted((r[4], r[3]) for r in found[0] if r[1] == "s")
        assert starts[0][0] == 0 and abs(sum(starts[-1]) - 1) < 1e-12
        total = sum(r[4] for r in rows if r[1] == "s")
        if weight == "size":
            before = 0
            for (_, _, _, _, size), (start, part) in zip(sorted((r for r in rows if r[1] == "s"), key=lambda r: (-r[4], r[2])), starts):
                assert (start, part) == (before / total, size / total)
                before += size


def test_snapshots_are_read_by_folder(spark, tmp_path):
    rows = [("2025-11-3", "A", 1), ("2025-11-13", "A", 2), ("2025-11-13", "B", 3)]
    catalogue.write_documents(spark.createDataFrame(rows, "snapshot string, stem string, count long"), str(tmp_path / "p"), ["snapshot", "stem"])
    read = lambda *a: catalogue.read_snapshot(spark, str(tmp_path / "p"), "count bigint", *a)
    assert [r["count"] for r in read("2025-11-13", "A").collect()] == [2] and read("2025-11-4", "A").count() == 0
    assert "PartitionFilters: [isnotnull(snapshot" in read("2025-11-3", "A")._jdf.queryExecution().toString()


def test_missing_metadata_is_not_there_and_a_missing_index_fails(spark, tmp_path):
    read = catalogue.read_metadata(spark, str(tmp_path / "no"), catalogue.NODE_TYPE)
    assert read.rows is None and read.rejected.count() == 0
    (tmp_path / "empty").mkdir()
    assert catalogue.read_metadata(spark, str(tmp_path / "empty"), catalogue.NODE_TYPE).rows is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        catalogue.read_documents(spark, str(tmp_path / "no"), catalogue.NODE_TYPE)


def test_values_are_written_as_texts(spark, tmp_path):
    put(tmp_path, "T.json", table(["a"] * 8, [["t", True, 1.0, 2.5, 3, None, 12345678901234567890, False]]))
    assert catalogue.tables(spark, str(tmp_path)).first()["values"] == ["t", "True", "1.0", "2.5", "3", None, "12345678901234567890", "False"]
    put(tmp_path, "T.json", table(["a", "b"], [[True, 1.0], [None, " x"]]))
    assert [(r.u0, r.u1) for r in catalogue.edge_tables(spark, str(tmp_path)).collect()] == [("True", "1.0"), (None, " x")]


def test_names_of_files_and_folders(spark):
    paths = ["file:/a/b.c.json", "file:/a/x%20y%2Bz+w.json", "file:/a/stem=T%2525/part-0.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r.x for r in df.select(catalogue.stem(F.col("p")).alias("x")).collect()] == ["b.c", "x y+z+w", "T%"]


def test_fetched_types(spark):
    """Filled labels count, whichever they are; attributes keep the array's order."""
    node = {"name": "Bee", "type": "application", "labels": ["codelist"], "attributes": [attr("z", "z"), {"name": "a", "technicalName": "a", "opendata": True, "invisible": False, "readOnly": True}, attr("zz", "z")]}
    rows = [("B", json.dumps({"technicalName": "B", "labels": []}), json.dumps(node)), ("C", '"C"', json.dumps({"labels": "no list", "type": "system"}))]
    fetched = spark.createDataFrame(rows, "name string, listed string, detail string")
    types = catalogue.fetched_types(fetched, catalogue.NODE_TYPE)
    got = {r.technicalName: r for r in catalogue.node_entries(types).collect()}
    assert (got["B"].labels, got["B"].is_codelist, got["C"].labels, got["C"].is_system, got["C"].name) == (["codelist"], True, [], True, None)
    attrs = catalogue.attribute_rows(types.select("technicalName", "d.attributes"))
    doc = document(catalogue.index_document(catalogue.node_entries(types), attrs, "types"))
    assert list(doc["types"]) == ["B", "C"] and list(doc["types"]["B"]["attributes"]) == ["z", "a"] and doc["types"]["C"]["attributes"] == {}
    assert doc["types"]["B"]["attributes"]["a"] == {"name": "a", "description": None, "mandatory": None, "opendata": True, "attributeTypeEnum": None, "readOnly": True, "invisible": False}
    assert doc["types"]["B"]["attributes"]["z"]["name"] == "zz"


def test_relation_entries_take_the_details_first(spark):
    d = {"name": "", "type": "system", "sources": [{"technicalName": "S", "name": "s", "type": "application", "labels": ["l"]}, {"technicalName": "X"}], "targets": []}
    rows = [("R", json.dumps({"name": "listed", "type": "application", "description": "d"}), json.dumps(d))]
    types = catalogue.fetched_types(spark.createDataFrame(rows, "name string, listed string, detail string"), catalogue.RELATION_TYPE)
    entries = catalogue.relation_entries(types)
    none = catalogue.attribute_rows(types.select("technicalName", "d.attributes"))
    doc = document(catalogue.index_document(entries, none, "relations"))["relations"]["R"]
    assert (doc["name"], doc["description"], doc["type"]) == ("listed", "d", "system") and "labels" not in doc
    assert doc["source"] == {"technicalName": "S", "name": "s", "type": "application", "labels": ["l"]} and doc["target"]["labels"] == []


def test_of_equal_listed_names_the_last_counts(spark):
    listing = spark.createDataFrame([("A", "one", 0), ("A", "two", 1)], "technicalName string, name string, at int")
    details = spark.createDataFrame([("A",)], "technicalName string").withColumns({c: F.lit(None).cast(k) for c, k in (("name", "string"), ("description", "string"), ("type", "string"), ("labels", "array<string>"))})
    assert [r.name for r in catalogue.node_index(listing, details).collect()] == ["two"]


def test_metadata_that_cannot_be_parsed_is_no_metadata(spark, tmp_path):
    put(tmp_path, "A.json", "{not json", raw=True)
    put(tmp_path, "B.json", {"technicalName": "B"})
    read = catalogue.read_metadata(spark, str(tmp_path), "technicalName string")
    assert [r.stem for r in read.rows.collect()] == ["B"] and [r.stem for r in read.rejected.collect()] == ["A"]
    alone = catalogue.read_metadata(spark, str(tmp_path / "A.json"), "technicalName string")
    assert alone.rows is None and [r.stem for r in alone.rejected.collect()] == ["A"]
    assert catalogue.read_snapshot(spark, str(tmp_path / "no"), "x int", "2025-11-3", "A").count() == 0


def test_written_documents_are_found_by_snapshot_and_stem(spark, tmp_path):
    rows = [("2025-11-3", "attributes", "A b", 1), ("2025-11-13", "relation_attributes", "R", 2)]
    catalogue.write_documents(spark.createDataFrame(rows, "snapshot string, kind string, stem string, x int"), str(tmp_path / "s"), ["snapshot", "kind", "stem"])
    index = catalogue.snapshot_index(catalogue.snapshot_files(spark, str(tmp_path / "s")))
    assert {r.date: (r.node_types, r.relations) for r in index.collect()} == {"2025-11-3": (["A b"], []), "2025-11-13": ([], ["R"])}
    assert document(catalogue.snapshot_document(index))["snapshots"][0] == {"date": "2025-11-13", "node_types": [], "relations": ["R"]}


def test_documents_of_several_lines(spark, tmp_path):
    put(tmp_path, "A.json", '﻿ {\n  "result": [\n    {"uuid": "1"},\n    {"uuid": "2"}\n  ]\n}\n', raw=True)
    put(tmp_path, "B.json", "[\n {\"uuid\": \"3\"}\n]", raw=True)
    assert sorted((r.type, r.uuid) for r in catalogue.node_dumps(spark, str(tmp_path)).collect()) == [("A", "1"), ("A", "2"), ("B", "3")]


def test_an_absent_index_shows_all_types_and_an_empty_one_none(spark, tmp_path):
    put(tmp_path / "i", "node_index.json", {"types": {"A": {"name": "Ay", "isApplication": True, "isCodelist": False, "isSystem": False}}})
    put(tmp_path / "e", "node_index.json", {"types": {}})
    put(tmp_path / "x", "node_index.json", {"other": 1})
    put(tmp_path / "b", "node_index.json", '{"types": {"A"', raw=True)
    types = spark.createDataFrame([("A",), ("B",)], "type string")
    shown = lambda at, chosen=views.TypeFilter(): sorted(r.type for r in views.type_kind_filter(types, catalogue.read_index(spark, str(tmp_path / at), "types").rows, chosen).collect())  # noqa: E731, B008
    assert shown("i") == ["A"] and shown("e") == [] and shown("x") == shown("b") == shown("none") == ["A", "B"]
    assert shown("b", views.TypeFilter(curated=("B",))) == ["B"]
    names = types.withColumnRenamed("type", "relation")
    put(tmp_path / "r", "relation_index.json", {"relations": {"B": {"name": "Bee", "type": "system"}}})
    of = lambda at, chosen: [(r.relation, r.label, r["rank"]) for r in views.relation_kind_filter(names, catalogue.read_index(spark, str(tmp_path / at), "relations").rows, chosen).orderBy("rank").collect()]
    assert of("r", views.TypeFilter(system=True)) == [("B", "Bee (B)", 1)] and of("none", views.TypeFilter()) == []
    assert of("none", views.TypeFilter(application=False)) == [("A", "A", 1), ("B", "B", 2)]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_documents_are_written_in_parts(spark, tmp_path, n):
    """One file or several, one after the other, are the same document; no row gathers the entries."""
    rows = spark.createDataFrame([(f"k{i:04}", json.dumps({"date": f"k{i:04}", "x": "a\n" * (i % 3)})) for i in range(n)], "date string, value string").repartition(5)
    parts = catalogue.in_parts(rows, ["date"], F.lit('{"snapshots":['), "]}")
    assert "collect_list" not in parts._jdf.queryExecution().toString()
    want = {"snapshots": [json.loads(json.dumps({"date": f"k{i:04}", "x": "a\n" * (i % 3)})) for i in range(n)]}
    found = {}
    for files in (1, 4):
        catalogue.write_document(parts, str(tmp_path / f"d{files}"), files)
        names = sorted((tmp_path / f"d{files}").glob("part-*.txt"))
        assert (len(names) == 1) if files == 1 else (len(names) > 2 or n < 500)
        found[files] = b"".join(x.read_bytes() for x in names)
        assert json.loads(found[files]) == want
    assert found[1] == found[4]


def test_a_failed_job_leaves_the_snapshot_as_it_was(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    def rows(*r): return spark.createDataFrame(list(r), "stem string, x long")  # noqa: E704
    def read(*stem): return sorted(r.x for r in catalogue.read_snapshot(spark, root, "x bigint", "2025-11-3", *stem).collect())  # noqa: E704
    assert read() == []
    catalogue.write_snapshot(rows(("A", 1), ("A", 2), ("B b/č", 3)), root, "2025-11-3")
    catalogue.write_snapshot(rows(("A", 7)), root, "2025-11-4")
    assert read() == [1, 2, 3] and read("A") == [1, 2] and read("B b/č") == [3] and read("C") == []
    failing = rows(("A", 4), ("B b/č", 5)).repartition(2).withColumn("x", F.when(F.col("stem") == "A", F.raise_error(F.lit("no"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="no"):
        catalogue.write_snapshot(failing, root, "2025-11-3")
    assert read() == [1, 2, 3]
    with monkeypatch.context() as m:  # all documents are written, the manifest isn't
        m.setattr(catalogue, "_name_versions", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            catalogue.write_snapshot(rows(("A", 4)), root, "2025-11-3")
    assert read() == [1, 2, 3]
    folder = tmp_path / "s" / "_manifests" / "2025-11-3" / "00000002"  # half a manifest
    folder.mkdir()
    (folder / "part-0.json").write_text('{"stem": "A", "version": "?"}')
    assert read() == [1, 2, 3]
    catalogue.write_snapshot(rows(("A", 4), ("C", 6)), root, "2025-11-3")
    assert read() == [3, 4, 6] and read("A") == [4]
    catalogue.clean_snapshot(spark, root, "2025-11-3")
    assert read() == [3, 4, 6] and len(list((tmp_path / "s").glob("snapshot=2025-11-3/*/version=*"))) == 3
    assert sorted(r.x for r in catalogue.read_snapshot(spark, root, "x bigint", "2025-11-4").collect()) == [7]
    with monkeypatch.context() as m:  # two writers at once
        m.setattr(catalogue, "names_in", lambda *a: ["00000001"] if a[1].endswith("2025-11-3") else ["_SUCCESS"])
        with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
            m.setattr(catalogue, "_manifest", lambda *a: {})
            (tmp_path / "s" / "_manifests" / "2025-11-3" / "00000002").exists() and catalogue.write_snapshot(rows(("A", 9)), root, "2025-11-3")
    assert read() == [3, 4, 6]
