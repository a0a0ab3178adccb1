"""The catalogue's commands as jobs from files to files.

    python -m millrace.plans.jobs relation-stats INPUT OUTPUT SNAPSHOT RELATION SOURCE_TYPE TARGET_TYPE
    python -m millrace.plans.jobs metadata LIST_URL DETAIL_URL RELATION_LIST_URL RELATION_DETAIL_URL OUTPUT
    python -m millrace.plans.jobs index-snapshots ROOT OUTPUT
    python -m millrace.plans.jobs convert INPUT OUTPUT
    python -m millrace.plans.jobs fetch-reports DETAIL_URL OUTPUT NAME=ID...
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import relations
from millrace.shared import temporary_tables
from millrace.sources import catalogue
from millrace.sources.rest import RestCatalogue


def relation_stats(spark: SparkSession, root: str, out: str, snapshot: str, wanted: list[tuple[str, str, str]]) -> None:
    """Statistics of the (relation, source type, target type) rows, from ``root``/relations and ``root``/nodes,
    written by snapshot and relation.  A relation or type that has no file fails the job."""
    kinds = spark.createDataFrame(wanted, "relation string, source_type string, target_type string")
    names = {"relations": {w[0] for w in wanted}, "nodes": {t for w in wanted for t in w[1:]}}
    for folder, asked in names.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(f"{root}/{folder}")
        there = {r.stem for r in files.select(catalogue.stem(F.col("path")).alias("stem")).filter(F.col("stem").isin(*asked)).distinct().collect()}
        if asked - there:
            raise FileNotFoundError(f"no file in {root}/{folder}: {', '.join(sorted(asked - there))}")
    edges = relations.edges(catalogue.edge_tables(spark, f"{root}/relations")).join(kinds.select("relation"), "relation", "left_semi")
    nodes = catalogue.node_dumps(spark, f"{root}/nodes").filter("uuid <> ''")
    ends = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("of")) for s, c in (("s", "source_type"), ("t", "target_type"))]))
    sides = kinds.select("relation", ends.alias("x")).select("relation", "x.*")
    members = nodes.join(sides, F.col("type") == F.col("of")).select("relation", "side", "uuid").distinct()
    document = relations.relation_document(relations.relation_stats(edges, members, kinds))
    catalogue.write_snapshot(document.select(F.col("relation_name").alias("stem"), "*"), out, snapshot)


def metadata(spark: SparkSession, nodes: DataFrame, relation_types: DataFrame, out: str) -> None:
    """The raw documents and the index documents of (name, listed, detail) rows, as the REST source gives them."""
    for fetched, schema, entries, root, folder in (
        (nodes, catalogue.NODE_TYPE, catalogue.node_entries, "types", "node"),
        (relation_types, catalogue.RELATION_TYPE, catalogue.relation_entries, "relations", "relation"),
    ):
        catalogue.write_raw(fetched, f"{out}/{folder}s")
        types = catalogue.fetched_types(fetched, schema)
        attributes = catalogue.attribute_rows(types.select("technicalName", "d.attributes"))
        catalogue.write_document(catalogue.index_document(entries(types), attributes, root), f"{out}/{folder}_index")


def index_snapshots(spark: SparkSession, root: str, out: str) -> None:
    """The index document of the snapshots below ``root``."""
    catalogue.write_document(catalogue.snapshot_document(catalogue.snapshot_index(catalogue.snapshot_files(spark, root))), out)


def convert(spark: SparkSession, root: str, out: str) -> None:
    """Report tables as CSV files."""
    catalogue.write_csv(catalogue.csv_lines(catalogue.tables(spark, root)), out)


def fetched(spark: SparkSession, listing: str, detail: str) -> DataFrame:
    spark.dataSource.register(RestCatalogue)
    return spark.read.format("rest_catalogue").option("list", listing).option("detail", detail).load()


def fetch_reports(spark: SparkSession, detail: str, out: str, ids: dict[str, str]) -> None:
    """Reports posted for by id, as they came: a folder stem=<name> for each."""
    spark.dataSource.register(RestCatalogue)
    body = '{"parameters": {"inclApplication": "true"}}'
    read = spark.read.format("rest_catalogue").option("names", ",".join(ids.values())).option("detail", detail).option("post", body)
    names = spark.createDataFrame(list(ids.items()), "stem string, id string")
    found = read.load().join(names, F.col("name") == F.col("id")).select(F.col("stem").alias("name"), "detail")
    catalogue.write_raw(found, out)


def main(arguments: list[str]) -> None:
    spark = SparkSession.builder.getOrCreate()
    with temporary_tables(spark):
        run(spark, *arguments)


def run(spark: SparkSession, command: str, *rest: str) -> None:
    if command == "relation-stats":
        root, out, snapshot, *wanted = rest
        relation_stats(spark, root, out, snapshot, [tuple(wanted)])
    elif command == "metadata":
        metadata(spark, fetched(spark, *rest[:2]), fetched(spark, *rest[2:4]), rest[4])
    elif command == "index-snapshots":
        index_snapshots(spark, *rest)
    elif command == "convert":
        convert(spark, *rest)
    elif command == "fetch-reports":
        fetch_reports(spark, rest[0], rest[1], dict(x.split("=", 1) for x in rest[2:]))
    else:
        raise SystemExit(__doc__)


if __name__ == "__main__":
    main(sys.argv[1:])
