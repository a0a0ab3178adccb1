"""Attribute coverage and uniqueness of typed objects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filled_values(objects: DataFrame, type_name: str, columns: list[str]) -> DataFrame:
    """(type, name, v): the values, as text, of the columns that are filled: not null and not empty."""
    texts = objects.select(*[F.col(c).cast("string").alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("v")) for c in columns])
    return texts.select(F.lit(type_name).alias("type"), F.explode(pairs).alias("x")).select("type", "x.*").filter("v <> ''")


def filled_map_values(objects: DataFrame, type_name: str, attributes: str) -> DataFrame:
    """The same for objects whose attributes are a map."""
    return objects.select(F.lit(type_name).alias("type"), F.explode(attributes).alias("name", "v")).filter("v <> ''")


def type_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(type, type_count)."""
    counted = [t.select(F.lit(k).alias("type")).groupBy("type").agg(F.count("*").alias("type_count")) for k, t in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def digest(value: Column) -> Column:
    """What tells texts apart in 16 bytes at most: a short one itself, the 128-bit digest of another; their lengths differ."""
    return F.when(F.octet_length(value) < 16, F.encode(value, "UTF-8")).otherwise(F.unhex(F.md5(value)))


def profile(values: DataFrame, counts: DataFrame) -> DataFrame:
    """(type, name, type_count, count, pct, unique_count, unique_pct, rank) of each attribute that is filled at all.

    Equal values are counted first, so that neither a hot value nor an
    attribute of many values meets in one task.  Their digests are shuffled
    instead of the texts.
    """
    each = values.select("type", "name", digest(F.col("v")).alias("d")).groupBy("type", "name", "d").agg(F.count("*").alias("n"))
    found = each.groupBy("type", "name").agg(F.sum("n").cast("bigint").alias("count"), F.count("*").alias("unique_count"))
    order = Window.partitionBy("type").orderBy(F.desc("count"), "name")
    return found.join(counts, "type").select(
        "type",
        "name",
        "type_count",
        "count",
        (F.col("count") / F.col("type_count") * 100).alias("pct"),
        "unique_count",
        (F.col("unique_count") / F.col("count") * 100).alias("unique_pct"),
        F.row_number().over(order).alias("rank"),
    )


def profile_documents(profiled: DataFrame, counts: DataFrame) -> DataFrame:
    """(type, count, attributes): a document for each type; without attributes where none is filled."""
    entry = F.struct("rank", "name", "count", "pct", "unique_count", "unique_pct")
    lists = profiled.groupBy("type").agg(F.array_sort(F.collect_list(entry)).alias("a"))
    return counts.join(lists, "type", "left").select(
        "type",
        F.col("type_count").alias("count"),
        F.coalesce(F.transform("a", lambda x: x.dropFields("rank")), F.expr("array()")).alias("attributes"),
    )
