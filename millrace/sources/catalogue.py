"""Catalogue files: report tables, node dumps, type metadata, snapshots, and what is written from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import filled
from millrace.shared import delete, names_in, written
from millrace.sources.elements import read_elements

TABLE = "type string, result struct<headers: array<struct<name: string>>, rows: array<struct<values: array<variant>>>>"
_CARDINALITY = "struct<min: bigint, max: bigint>"
ATTRIBUTE = (
    "struct<id: bigint, name: string, description: string, technicalName: string, type: string, units: string, "
    "valid: boolean, readOnly: boolean, invisible: boolean, opendata: boolean, mandatory: struct<type: string>, "
    "attributeTypeEnum: string, engName: string>"
)
NODE_TYPE = (
    f"id bigint, name string, technicalName string, description string, type string, valid boolean, engName string, "
    f"attributes array<{ATTRIBUTE}>, labels array<string>"
)
_ENDPOINT = "struct<id: bigint, name: string, technicalName: string, type: string, labels: array<string>>"
RELATION_TYPE = (
    f"id bigint, name string, technicalName string, description string, engDescription string, type string, valid boolean, "
    f"category string, attributes array<{ATTRIBUTE}>, sourceCardinality {_CARDINALITY}, targetCardinality {_CARDINALITY}, "
    f"sources array<{_ENDPOINT}>, targets array<{_ENDPOINT}>"
)
PROFILE = (
    "type string, count bigint, attributes array<struct<name: string, count: bigint, pct: double, "
    "unique_count: bigint, unique_pct: double>>"
)


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def stem(path: Column) -> Column:
    """A file's name without folder and extension; or, of a file in a folder stem=<name>, that name."""
    plain = _decoded(path)
    folder = _decoded(F.regexp_extract(plain, r"/stem=([^/]+)/[^/]+$", 1))
    return F.when(folder != "", folder).otherwise(F.regexp_extract(plain, r"([^/]+)\.[^./]+$", 1))


def cell(value: Column) -> Column:
    """The text of a table's value: True and False with capitals, numbers as written (1.0 isn't 1), lists as JSON; null stays."""
    kind, text = F.schema_of_variant(value), value.cast("string")
    return F.when(kind == "BOOLEAN", F.initcap(text)).when(kind.rlike(r"^DECIMAL\(([0-9]|1[0-8]),0\)$"), F.concat(text, F.lit(".0"))).otherwise(text)


# --- sources -----------------------------------------------------------------


def read_documents(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST") -> DataFrame:
    """JSON files of one document each, with the file's ``stem``; one that can't be parsed fails the job."""
    files = spark.read.schema(schema).option("multiLine", True).option("mode", mode).option("pathGlobFilter", "*.json")
    return files.json(path).withColumn("stem", stem(F.col("_metadata.file_path")))


_ROW = "struct<values: array<variant>>"


def _checked(outlines: DataFrame, fits: Column, message: str) -> DataFrame:
    """The outlines, of which all must fit; the job fails with the first that doesn't."""
    odd = outlines.filter(~F.coalesce(fits, F.lit(False))).select(stem(F.col("file")).alias("stem")).first()
    if odd:
        raise ValueError(f"{message}: {odd.stem}")
    return outlines


def tables(spark: SparkSession, path: str, pattern: str = "*.json", folders: bool = False) -> DataFrame:
    """(stem, row, headers, values): the rows of report tables; row 0 is the first.  Tasks read ranges of large ones."""
    rows, outlines = read_elements(spark, path, [("result", "rows")], pattern, numbered=True, folders=folders)
    read = F.from_json("outline", TABLE, {"mode": "FAILFAST"})
    heads = outlines.select("file", F.transform(read["result"]["headers"], lambda h: h["name"]).alias("headers"))
    values = F.from_json("text", _ROW, {"mode": "FAILFAST"})["values"]
    return rows.join(heads, "file").select(stem(F.col("file")).alias("stem"), "row", "headers", F.transform(values, cell).alias("values"))


def edge_tables(spark: SparkSession, path: str, pattern: str = "*.json", folders: bool = False) -> DataFrame:
    """(relation, u0, u1): the first two values of each row that has two, of tables that have two headers.

    What isn't a TABLE, or has fewer headers, fails the job.  The stem is the relation.
    """
    rows, outlines = read_elements(spark, path, [("result", "rows")], pattern, folders=folders)
    read = F.from_json("outline", TABLE, {"mode": "FAILFAST"})
    _checked(outlines, (read["type"] == "TABLE") & (F.size(read["result"]["headers"]) >= 2), "not a table of two columns")
    values = rows.select("file", F.from_json("text", _ROW, {"mode": "FAILFAST"})["values"].alias("v")).filter(F.size("v") >= 2)
    return values.select(stem(F.col("file")).alias("relation"), cell(F.get("v", F.lit(0))).alias("u0"), cell(F.get("v", F.lit(1))).alias("u1"))


def node_dumps(spark: SparkSession, path: str, item: str = "uuid string", pattern: str = "*.json", folders: bool = False) -> DataFrame:
    """(type, item columns): the objects of node dumps, which are lists or have one under ``result``.

    Any other document fails the job.
    """
    items, outlines = read_elements(spark, path, [(), ("result",)], pattern, folders=folders)
    under = F.schema_of_variant(F.variant_get(F.try_parse_json("outline"), "$.result", "variant")).startswith("ARRAY")
    _checked(outlines, F.try_parse_json("outline").isNotNull() & (F.col("outline").startswith("[") | under), "no list of objects")
    text, x = F.btrim("text", F.lit(" \t\r\n")), F.from_json("text", f"struct<{_fields(item)}>")
    objects = F.when(text.startswith("{"), x).otherwise(F.raise_error(F.concat(F.lit("no list of objects: "), stem(F.col("file")))))
    return items.select(stem(F.col("file")).alias("type"), F.when(text != "null", objects).alias("x")).select("type", "x.*")


def _fields(ddl: str) -> str:
    return ", ".join(": ".join(x.strip().split(" ", 1)) for x in ddl.split(","))


def listed(raw: Column, keys: tuple[str, ...] = ("result", "items", "types", "data")) -> Column:
    """The list of a REST answer, a JSON text: itself, or the first of ``keys`` that holds a list,
    or the first list of any key, or the keys themselves, as JSON texts; anything else fails the job."""
    raw = strip_json(raw)
    fields = F.from_json(raw, "map<string,variant>")
    is_list = lambda v: F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    lists = [F.when(is_list(fields[k]), fields[k].cast("array<string>")) for k in keys]
    any_list = F.get(F.filter(F.map_values(fields), is_list), F.lit(0)).cast("array<string>")
    by_key = F.coalesce(*lists, any_list, F.map_keys(fields))
    return F.when(raw.startswith("["), F.from_json(raw, "array<string>")).when(raw.startswith("{"), by_key).otherwise(
        F.raise_error(F.lit("neither a list nor an object"))
    )


def strip_json(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\r\n\ufeff"))


def snapshot_files(spark: SparkSession, root: str) -> DataFrame:
    """(date, kind, stem) of the files ``root``/<date>/<attributes or relation_attributes>/<stem>.json, or of
    snapshot=<date>/kind=<kind>/stem=<stem>/ as Spark writes them; contents aren't read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root).select("path")
    )
    place = r"/(?:snapshot=)?([^/]+)/(?:kind=)?(attributes|relation_attributes)/(?:stem=[^/]+/)?[^/]+\.json$"
    part = lambda n: F.regexp_extract("path", place, n)
    return files.select(part(1).alias("date"), part(2).alias("kind"), stem(F.col("path")).alias("stem")).filter("kind <> ''")


def _or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Metadata:
    """What was read of metadata that views do without: ``rows`` is None where nothing is there that can be read,
    which is not the same as no rows; ``rejected`` (stem) names the documents that couldn't be parsed."""

    rows: DataFrame | None
    rejected: DataFrame


def read_metadata(spark: SparkSession, path: str, schema: str) -> Metadata:
    """Documents with their ``stem``.  What isn't there, holds no document, or holds broken ones alone isn't there."""
    full = f"{schema}, broken string"

    def read() -> DataFrame:
        files = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "broken")
        return files.json(path).withColumn("stem", stem(F.col("_metadata.file_path")))

    found = written(_or_empty(spark, read, f"{full}, stem string"), "metadata")
    rows = found.filter("broken IS NULL").drop("broken")
    return Metadata(None if rows.isEmpty() else rows, found.filter("broken IS NOT NULL").select("stem").distinct())


#: What views need of an index document's entries, for node types and for relation types.
_INDEXED = {
    "types": "struct<name: string, typeKind: string, isApplication: boolean, isSystem: boolean, isCodelist: boolean>",
    "relations": "struct<name: string, type: string>",
}


def read_index(spark: SparkSession, path: str, root: str) -> Metadata:
    """The entries of an index document, by technicalName; a document without ``root`` isn't there."""
    read = read_metadata(spark, path, f"{root} map<string, {_INDEXED[root]}>")
    held = None if read.rows is None else read.rows.filter(F.col(root).isNotNull())
    if held is None or held.isEmpty():
        return Metadata(None, read.rejected)
    rows = held.select(F.explode(root).alias("technicalName", "e")).select("technicalName", "e.*")
    names = {v: k for k, v in NODE_NAMES.items()} if root == "types" else {}
    return Metadata(rows.withColumnsRenamed({c: names[c] for c in rows.columns if c in names}), read.rejected)


def read_snapshot(spark: SparkSession, root: str, schema: str, snapshot: str, stem: str | None = None) -> DataFrame:
    """Documents that ``write_snapshot`` or ``write_documents`` wrote by snapshot, and by stem if that is given; other
    folders aren't read.  Of a snapshot with a manifest, what its last whole manifest names.

    The folders' names stay texts, as dates of days without a 0 aren't all dates to Spark.  A root, snapshot or stem that
    isn't there has no rows.
    """
    manifest = _manifest(spark, root, snapshot)
    by = ["snapshot", *(["stem"] if stem is not None or manifest else []), *(["version"] if manifest else [])]
    full = ", ".join([schema, *(f"{c} string" for c in by)])
    found = _or_empty(spark, lambda: spark.read.schema(full).json(root), full).filter(F.col("snapshot") == snapshot)
    if manifest:
        named = spark.createDataFrame(list(manifest.items()), "stem string, version string")
        found = found.join(F.broadcast(named), ["stem", "version"], "left_semi").drop("version")  # a row a stem
        found = found if stem is not None else found.drop("stem")
    return found if stem is None else found.filter(F.col("stem") == stem)


def _manifests(root: str, snapshot: str) -> str:
    return f"{root}/_manifests/{quote(snapshot, safe='')}"


def _manifest(spark: SparkSession, root: str, snapshot: str) -> dict[str, str]:
    """The version of each stem by the snapshot's last whole manifest; empty where there is none."""
    folder = _manifests(root, snapshot)
    for number in reversed(names_in(spark, folder)):
        if "_SUCCESS" in names_in(spark, f"{folder}/{number}"):
            return {r.stem: r.version for r in spark.read.schema("stem string, version string").json(f"{folder}/{number}").collect()}
    return {}


def write_snapshot(df: DataFrame, root: str, snapshot: str) -> None:
    """JSON with nulls, a folder for each ``stem`` of the snapshot; other stems stay as they are.

    All or nothing: documents go to folders of a new version, and count once a manifest that names these is whole.  What
    fails before leaves the snapshot as it was; of two writers at once one fails.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    before, folder = _manifest(spark, root, snapshot), _manifests(root, snapshot)
    number = max([int(n) for n in names_in(spark, folder)], default=0) + 1
    named = df.withColumns({"snapshot": F.lit(snapshot), "version": F.lit(version)})
    named.write.mode("append").option("ignoreNullFields", False).partitionBy("snapshot", "stem", "version").json(root)
    new = spark.read.schema("snapshot string, stem string, version string").json(root).filter((F.col("snapshot") == snapshot) & (F.col("version") == version))
    stems = {r.stem for r in new.select("stem").distinct().collect()}
    rows = sorted((before | dict.fromkeys(stems, version)).items())
    _name_versions(spark.createDataFrame(rows, "stem string, version string"), f"{folder}/{number:08}")


def _name_versions(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("error").json(path)


def clean_snapshot(spark: SparkSession, root: str, snapshot: str) -> None:
    """Deletes what the snapshot's last whole manifest doesn't name: earlier versions, and what failed jobs left.

    Not while others read or write it.
    """
    kept = _manifest(spark, root, snapshot)
    if not kept:
        return
    rows = spark.read.schema("snapshot string, stem string, version string").json(root).filter(F.col("snapshot") == snapshot)
    for r in rows.select(F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]+$", 1).alias("folder"), "stem", "version").distinct().collect():
        if r.version is not None and kept.get(r.stem) != r.version:
            delete(spark, unquote(r.folder))


# --- metadata ----------------------------------------------------------------


def _either(first: Column, second: Column) -> Column:
    return F.coalesce(filled(first), filled(second))


def attribute_rows(types: DataFrame) -> DataFrame:
    """(type, name, at, entry columns): each type's own attributes by technical name; of equal names the last
    counts, at the place ``at`` of the first.  Attributes without a technical name go."""
    each = types.select(F.col("technicalName").alias("of"), F.posexplode("attributes").alias("at", "a")).filter(
        "a.technicalName <> ''"
    )
    last = each.groupBy("of", F.col("a.technicalName").alias("technicalName")).agg(F.max_by("a", "at").alias("a"), F.min("at").alias("at"))
    return last.select(
        F.col("of").alias("type"), F.col("technicalName").alias("name"), "at", F.col("a.name").alias("attribute_name"), "a.description",
        F.col("a.mandatory.type").alias("mandatory"), "a.opendata", "a.attributeTypeEnum", "a.readOnly", "a.invisible",
    )


def flags(kind: Column, labels: Column) -> list[Column]:
    application = F.coalesce(kind == "application", F.lit(False))
    code = F.coalesce(F.array_contains(labels, "codelist"), F.lit(False))
    return [
        application.alias("is_application"),
        F.coalesce(kind == "system", F.lit(False)).alias("is_system"),
        (application & code).alias("is_codelist"),
    ]


LISTED = "name string, description string, type string, labels array<string>"


def fetched_types(fetched: DataFrame, schema: str) -> DataFrame:
    """(technicalName, base, d) of the REST source's (name, listed, detail): what the list says, null where that is a
    name alone, and the detail document; fields of another kind than the schema's are null."""
    return fetched.select(F.col("name").alias("technicalName"), F.from_json("listed", LISTED).alias("base"), F.from_json("detail", schema).alias("d"))


def _joined(listing: DataFrame, details: DataFrame) -> DataFrame:
    """``fetched_types`` of a listing and its details; with a column ``at``, the last of equal listed names counts."""
    if "at" in listing.columns:
        rest = [c for c in listing.columns if c not in ("technicalName", "at")]
        listing = listing.groupBy("technicalName").agg(F.max_by(F.struct(*rest), "at").alias("b")).select("technicalName", "b.*")
    fields = [x.split()[0] for x in LISTED.split(", ")]
    kinds = dict(x.split() for x in LISTED.split(", "))
    base = F.struct(*[(F.col(c) if c in listing.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in fields])
    d = details.select(F.struct("*").alias("d"))
    return listing.select("technicalName", base.alias("base")).join(d, F.col("technicalName") == F.col("d.technicalName"))


def node_entries(types: DataFrame) -> DataFrame:
    """An entry for each of ``fetched_types``: name, description and type by the details first, labels by the
    list first, whichever is filled, and what kind of type it is."""
    labels = F.coalesce(*[F.when(F.size(x) > 0, F.col(x)) for x in ("base.labels", "d.labels")], F.array().cast("array<string>"))
    kind = _either(F.col("d.type"), F.col("base.type"))
    return types.select(
        "technicalName",
        _either(F.col("d.name"), F.col("base.name")).alias("name"),
        _either(F.col("d.description"), F.col("base.description")).alias("description"),
        kind.alias("type"),
        labels.alias("labels"),
        *flags(kind, labels),
    )


def relation_entries(types: DataFrame) -> DataFrame:
    """An entry for each of ``fetched_types``, with its first source and target, if it has any."""
    none = F.array().cast("array<string>")

    def end(name: str) -> list[Column]:
        first = F.get(f"d.{name}s", F.lit(0))
        return [
            first["technicalName"].alias(f"{name}_type"), first["name"].alias(f"{name}_name"), first["type"].alias(f"{name}_kind"),
            F.coalesce(first["labels"], none).alias(f"{name}_labels"),
        ]

    return types.select(
        "technicalName",
        *[_either(F.col(f"d.{c}"), F.col(f"base.{c}")).alias(c) for c in ("name", "description")],
        "d.engDescription",
        _either(F.col("d.type"), F.col("base.type")).alias("type"),
        "d.category", *end("source"), *end("target"), "d.sourceCardinality", "d.targetCardinality",
    )


def node_index(listing: DataFrame, details: DataFrame) -> DataFrame:
    """``node_entries`` of the listed types whose details are there."""
    return node_entries(_joined(listing, details))


def relation_index(details: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """``relation_entries`` of the listed relation types whose details are there; of all details without a listing."""
    return relation_entries(_joined(details.select("technicalName") if listing is None else listing, details))


#: The documents' names of an entry's columns, where they differ.
NODE_NAMES = {"type": "typeKind", "is_application": "isApplication", "is_system": "isSystem", "is_codelist": "isCodelist"}


def index_document(entries: DataFrame, attributes: DataFrame, root: str) -> DataFrame:
    """The parts of {root: {technical name: entry with its attributes by name}}, as ``in_parts`` gives them.

    Entries of relations have their ends nested, under source and target.
    """
    fields = ("description", "mandatory", "opendata", "attributeTypeEnum", "readOnly", "invisible")
    own = attributes.groupBy(F.col("type").alias("of")).agg(
        F.array_sort(F.collect_list(F.struct("at", F.col("name").alias("k"), F.struct(F.col("attribute_name").alias("name"), *fields).alias("v")))).alias("own")
    )
    joined = entries.join(own, F.col("technicalName") == F.col("of"), "left").drop("of")
    columns = [c for c in entries.columns if not c.startswith(("source_", "target_"))]
    names = NODE_NAMES if "labels" in columns else {}
    ends = [
        F.struct(F.col(f"{x}_type").alias("technicalName"), F.col(f"{x}_name").alias("name"), F.col(f"{x}_kind").alias("type"), F.col(f"{x}_labels").alias("labels")).alias(x)
        for x in ("source", "target") if f"{x}_type" in entries.columns
    ]
    by_name = F.map_from_entries(F.transform("own", lambda a: F.struct(a["k"], a["v"])))
    kind = joined.select(by_name.alias("m")).schema["m"].dataType
    body = F.struct(*[F.col(c).alias(names.get(c, c)) for c in columns], *ends, F.coalesce(by_name, F.create_map().cast(kind)).alias("attributes"))
    entry = F.to_json(F.create_map(F.col("technicalName"), body), {"ignoreNullFields": "false"})
    entries_of = joined.select("technicalName", F.substr(entry, F.lit(2), F.length(entry) - 2).alias("value"))
    return in_parts(entries_of, ["technicalName"], F.lit(f'{{"{root}":{{'), "}}")


def in_parts(rows: DataFrame, by: list[str], head: Column, tail: str) -> DataFrame:
    """(part, place, value): a JSON document as lines that follow each other: its head (part 0), a line for each of the
    rows' ``value`` in the order of ``by`` (part 1), which leaves no ties, and its tail (part 2).

    No task holds more than a line; ``write_document`` puts them in order.
    """
    first = rows.select(F.min(F.struct(*by)).alias("k")).first().k
    if first is None:
        comma = F.lit("")
    else:
        same = [F.col(c).eqNullSafe(F.lit(first[c])) for c in by]
        is_first = same[0]
        for x in same[1:]:
            is_first = is_first & x
        comma = F.when(is_first, "").otherwise(",")
    place = F.struct(*by)
    kind = rows.select(place.alias("p")).schema["p"].dataType
    lines = rows.select(F.lit(1).alias("part"), place.alias("place"), F.concat(comma, "value").alias("value"))
    ends = rows.sparkSession.range(1).select(F.explode(F.array(F.struct(F.lit(0).alias("part"), head.alias("value")), F.struct(F.lit(2).alias("part"), F.lit(tail).alias("value")))).alias("e"))
    return lines.unionByName(ends.select("e.part", F.lit(None).cast(kind).alias("place"), "e.value"))


# --- snapshots ---------------------------------------------------------------


def snapshot_index(files: DataFrame) -> DataFrame:
    """(date, node_types, relations): the sorted stems of each date that has any."""
    of = lambda kind: F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("stem"))))
    return files.groupBy("date").agg(of("attributes").alias("node_types"), of("relation_attributes").alias("relations")).filter(
        (F.size("node_types") > 0) | (F.size("relations") > 0)
    )


def snapshot_document(index: DataFrame) -> DataFrame:
    """The parts of {"snapshots": [the index's rows by date]}, as ``in_parts`` gives them."""
    rows = index.select("date", F.to_json(F.struct("date", "node_types", "relations")).alias("value"))
    return in_parts(rows, ["date"], F.lit('{"snapshots":['), "]}")


def latest_snapshot(index: DataFrame, mode: str = "lexicographic") -> DataFrame:
    """(date): the last by text, as the catalogue's views have it, or by calendar; days may lack a 0."""
    if mode == "lexicographic":
        return index.agg(F.max("date").alias("date"))
    if mode != "chronological":
        raise ValueError(mode)
    return index.agg(F.max_by("date", F.to_date("date", "yyyy-M-d")).alias("date"))


# --- sinks -------------------------------------------------------------------


def csv_line(values: Column) -> Column:
    """Every cell quoted, null empty, semicolons between."""
    cell = lambda v: F.concat(F.lit('"'), F.replace(F.coalesce(v, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    return F.array_join(F.transform(values, cell), ";")


def csv_lines(rows: DataFrame) -> DataFrame:
    """(stem, row, line) of ``tables``' rows; row -1 is the header, with a byte-order mark."""
    head = rows.groupBy("stem").agg(F.first("headers").alias("headers")).select(
        "stem", F.lit(-1).alias("row"), F.concat(F.lit("﻿"), csv_line(F.col("headers"))).alias("line")
    )
    return head.unionByName(rows.select("stem", "row", csv_line(F.col("values")).alias("line")))


def write_csv(lines: DataFrame, path: str) -> None:
    """A folder stem=<stem> for each table, of one file with CRLF ends; rows in order."""
    ordered = lines.repartition("stem").sortWithinPartitions("stem", "row").select("stem", "line")
    ordered.write.mode("overwrite").partitionBy("stem").option("lineSep", "\r\n").text(path)


def write_document(parts: DataFrame, path: str, files: int = 1) -> None:
    """A document's parts in the folder ``path``: as one file, which one task writes from sorted runs, line by line; or as
    several that many tasks write, and that make up the document one after the other."""
    dealt = parts.repartition(1) if files == 1 else parts.repartitionByRange(files, "part", "place")
    dealt.sortWithinPartitions("part", "place").select("value").write.mode("overwrite").text(path)


def write_raw(fetched: DataFrame, path: str) -> None:
    """The detail documents as they came: a folder stem=<name> for each type."""
    fetched.select(F.col("name").alias("stem"), "detail").write.mode("overwrite").partitionBy("stem").text(path)


def write_documents(df: DataFrame, path: str, by: list[str]) -> None:
    """JSON with nulls, a folder for each value of ``by``; only folders that are written again are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False).partitionBy(*by).json(path)
