"""JSON arrays in byte ranges, against Python's reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.sources import catalogue
from millrace.sources.elements import _applied, _Cutter, _Text, read_elements

ODD = ['"', "\\", "{", "}", "[", "]", ",", ":", "é", "a", " ", "\n", "\\}", '\\"', "rows", '"result":[{', " ", "😀"]


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    text = lambda: "".join(rng.choice(ODD) for _ in range(rng.randrange(6)))
    if kind < 3:
        return [text(), rng.randrange(-5, 99), rng.choice([True, False, None, 1.5])][kind]
    if kind < 5:
        return text()
    if kind == 5:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["rows", "result", "x}y", 'q"', text()]): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def document(rng, rows):
    more = {f"k{i}": value(rng) for i in range(rng.randrange(3))}
    inner = {**({"headers": [{"name": "a"}, {"name": "b"}]} if rng.random() < 0.7 else {}), "rows": rows, **({"rest": value(rng)} if rng.random() < 0.5 else {})}
    return {**({"type": "TABLE"} if rng.random() < 0.5 else {}), **more, "result": inner, **({"z": value(rng)} if rng.random() < 0.5 else {})}


def cut(raw: bytes, places: list[int], paths):
    """Elements and outline, from ranges that end at the given braces."""
    ends = sorted({0, len(raw), *places})
    texts = [raw[a:b] for a, b in zip(ends, ends[1:])]
    within, levels, found, around, open_part = False, [], [], b"", None
    for n, text in enumerate(texts):
        cutter = _Cutter(n, within, json.loads(json.dumps(levels)), paths)
        for k, piece in enumerate(text.split(b"}") if n % 2 else [text]):  # batches of a range end at braces too
            cutter.feed(b"}" * (k > 0) + piece)
        for kind, _, _, closes, part in cutter.finish():
            if kind == "around":
                around += part
            elif kind == "element":
                found.append(part)
            else:
                open_part = (open_part or b"") + part
                if closes:
                    found.append(open_part)
                    open_part = None
        both = [_Text(text, w) for w in (False, True)]
        levels = _applied(levels, both[within].effect())
        within = both[within].ends_within
    assert levels == [] and not within and open_part is None
    return [json.loads(x) for x in found if x.strip()], json.loads(around)


@pytest.mark.parametrize("seed", range(60))
def test_any_cut_gives_the_elements(seed):
    rng = random.Random(seed)
    rows = [value(rng) for _ in range(rng.randrange(8))]
    doc = document(rng, rows)
    raw = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])).encode()
    braces = [i for i in range(len(raw)) if raw[i : i + 1] == b"}"]
    places = [i for i in braces if rng.random() < 0.4]
    found, around = cut(raw, places, [("result", "rows")])
    assert found == rows and around == {**doc, "result": {**doc["result"], "rows": []}}
    found, around = cut(json.dumps(rows).encode(), [], [(), ("result",)])
    assert found == rows and around == []


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("sent", [100_000, 0])
def test_many_tasks_read_one_file(spark, small_ranges, tmp_path, monkeypatch, sent):
    monkeypatch.setattr("millrace.sources.elements.SENT", sent)
    rng = random.Random(3)
    wide = {"values": ["w" * 9000 + "}" * 3, "{"]}  # an element of many ranges
    docs = {n: document(rng, [{"values": [value(rng), value(rng)]} for _ in range(rows)] + [wide] * (rows > 400)) for n, rows in (("large", 700), ("small", 3), ("none", 0))}
    for n, d in docs.items():
        (tmp_path / f"{n}.json").write_text(json.dumps(d, ensure_ascii=False, indent=1 if n == "small" else None) + ("\n" if n == "none" else ""), encoding="utf-8-sig" if n == "small" else "utf-8")
    (tmp_path / "other.txt").write_text("{")
    found, outlines = read_elements(spark, str(tmp_path), [("result", "rows")], numbered=True)
    got = {}
    for r in found.select(catalogue.stem(F.col("file")).alias("stem"), "row", "text").collect():
        got.setdefault(r.stem, {})[r.row] = json.loads(r.text)
    for n, d in docs.items():
        assert [got.get(n, {}).get(i) for i in range(len(d["result"]["rows"]))] == d["result"]["rows"] and len(got.get(n, {})) == len(d["result"]["rows"])
    assert {r.stem: json.loads(r.outline) for r in outlines.select(catalogue.stem(F.col("file")).alias("stem"), "outline").collect()} == {n: {**d, "result": {**d["result"], "rows": []}} for n, d in docs.items()}
    # the same tasks as the file has ranges
    read = spark.read.option("lineSep", "}").option("pathGlobFilter", "large.json").text(str(tmp_path))
    assert read.rdd.getNumPartitions() > 20


@pytest.mark.parametrize("text", ['{"result": {"rows": [{"values": [1]}]', '{"result": {"rows": ["a}', '{"a": 1}}', '[{"a": 1}', '{"result": [1]}]'])
def test_broken_documents_fail(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="not a JSON document"):
        read_elements(spark, str(tmp_path), [("result", "rows")])


def test_node_dumps_in_ranges(spark, small_ranges, tmp_path):
    rng = random.Random(4)
    items = [{"uuid": f"u{i}", "more": value(rng)} for i in range(400)] + [{"more": 1}, None]
    (tmp_path / "A.json").write_text(json.dumps(items))
    (tmp_path / "B.json").write_text(json.dumps({"n": {"result": [{"uuid": "no"}]}, "result": items[:50], "x": value(rng)}, indent=2))
    got = sorted(map(str, catalogue.node_dumps(spark, str(tmp_path)).collect()))
    from pyspark.sql import Row

    want = [Row(type="A", uuid=(x or {}).get("uuid")) for x in items] + [Row(type="B", uuid=x["uuid"]) for x in items[:50]]
    assert got == sorted(map(str, want))
    (tmp_path / "C.json").write_text('{"result": {"uuid": "a"}}')
    with pytest.raises(ValueError, match="no list of objects: C"):
        catalogue.node_dumps(spark, str(tmp_path))


def test_edge_tables_in_ranges(spark, small_ranges, tmp_path):
    rows = [{"values": [f"a{i}", " b}{", '}{"']} for i in range(400)]
    (tmp_path / "r.json").write_text(json.dumps({"type": "TABLE", "result": {"headers": [{"name": "x"}, {"name": "y"}], "rows": rows}}))
    found = catalogue.edge_tables(spark, str(tmp_path))  # its filter parses the rows
    assert sorted((r.relation, r.u0, r.u1) for r in found.collect()) == sorted(("r", f"a{i}", " b}{") for i in range(400))
    assert found.filter("u0 <> '' AND u1 <> ''").count() == 400


def test_documents_of_several_files(spark, small_ranges, tmp_path):
    rows = spark.range(900).select("id", F.concat(F.lit('{"values":["a'), "id", F.lit('","}{"]}')).alias("value"))
    head = F.lit('{"type":"TABLE","result":{"headers":[{"name":"x"},{"name":"y"}],"rows":[')
    catalogue.write_document(catalogue.in_parts(rows, ["id"], head, "]}}"), str(tmp_path / "stem=r"), 5)
    assert len(list((tmp_path / "stem=r").glob("*.txt"))) > 1
    found = catalogue.tables(spark, str(tmp_path), "*.txt", folders=True).collect()
    assert sorted((r.stem, r.row, *r["values"]) for r in found) == [("r", i, f"a{i}", "}{") for i in range(900)]
    with pytest.raises(Exception, match="not a JSON document"):
        catalogue.tables(spark, str(tmp_path), "*.txt").collect()
