"""The commands, from files to files."""

import json

import pytest

from millrace.plans import jobs
from tests.test_catalogue import put, table


def test_relation_stats(spark, tmp_path):
    put(tmp_path / "relations", "R.json", table(["a", "b"], [["1", "x"], ["x", "1"], ["1", None]]))
    put(tmp_path / "relations", "other.json", table(["a", "b"], [["1", "x"]]))
    put(tmp_path / "nodes", "A.json", {"result": [{"uuid": "1"}, {"uuid": "2"}, {"uuid": None}]})
    put(tmp_path / "nodes", "B.json", [{"uuid": "x"}, {"uuid": ""}])
    jobs.relation_stats(spark, str(tmp_path), str(tmp_path / "out"), "2025-11-3", [("R", "A", "B")])
    (part,) = (tmp_path / "out" / "snapshot=2025-11-3" / "stem=R").glob("version=*/*.json")
    doc = json.loads(part.read_text())
    assert doc["edges"] == {"total_edges": 3, "unique_pairs": 2, "duplicate_edges": 1, "pairs_with_duplicates": 1, "ambiguous_pairs": 1}
    assert doc["source"]["total_nodes"] == 2 and doc["target"]["connected_nodes"] == 2 and doc["cardinality"] == "many-to-many"
    with pytest.raises(FileNotFoundError, match="Q"):
        jobs.relation_stats(spark, str(tmp_path), str(tmp_path / "out"), "s", [("Q", "A", "B")])
    with pytest.raises(FileNotFoundError, match="C"):
        jobs.relation_stats(spark, str(tmp_path), str(tmp_path / "out"), "s", [("R", "A", "C")])


def test_metadata(spark, tmp_path):
    nodes = spark.createDataFrame([("A b", '"A b"', '{"name": "é", "type": "system"}')], "name string, listed string, detail string")
    jobs.metadata(spark, nodes, nodes.limit(0), str(tmp_path / "m"))
    (raw,) = (tmp_path / "m" / "nodes" / "stem=A b").glob("*.txt")
    assert raw.read_text().strip() == '{"name": "é", "type": "system"}'
    (index,) = (tmp_path / "m" / "node_index").glob("*.txt")
    assert json.loads(index.read_text())["types"]["A b"]["isSystem"] is True
    (index,) = (tmp_path / "m" / "relation_index").glob("*.txt")
    assert json.loads(index.read_text()) == {"relations": {}}


def test_snapshots_and_tables(spark, tmp_path):
    put(tmp_path / "stats" / "2025-11-3" / "attributes", "A.json", {})
    jobs.index_snapshots(spark, str(tmp_path / "stats"), str(tmp_path / "index"))
    (index,) = (tmp_path / "index").glob("*.txt")
    assert json.loads(index.read_text()) == {"snapshots": [{"date": "2025-11-3", "node_types": ["A"], "relations": []}]}
    put(tmp_path / "in", "T.json", table(["k"], [[True]]))
    jobs.convert(spark, str(tmp_path / "in"), str(tmp_path / "csv"))
    (part,) = (tmp_path / "csv" / "stem=T").glob("*.txt")
    assert part.read_bytes() == '﻿"k"\r\n"True"\r\n'.encode()
