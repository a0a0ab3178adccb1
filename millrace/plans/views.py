"""The catalogue's two interactive views as DataFrames: each number and text that is shown is a column."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import escaped, filled, label, percent, short_description, tier, to_fixed, truncated
from millrace.operators.ranks import ranked

#: Circumference of a pie, its colours in turn, and the colour of what is left.
CIRCUMFERENCE = 2 * math.pi * 24
COLOURS = ((235, 10, 10), (220, 120, 0), (15, 170, 0), (0, 150, 220), (160, 60, 255), (255, 0, 170))
REST = (55, 65, 81)


@dataclass(frozen=True)
class TypeFilter:
    """Which types are shown; ``curated`` names are shown alone, if given."""

    application: bool = True
    codelist: bool = False
    system: bool = False
    curated: tuple[str, ...] = ()


def type_kind_filter(types: DataFrame, metadata: DataFrame | None, chosen: TypeFilter) -> DataFrame:
    """(type, label): a type without metadata goes, unless no kind is asked for or there is no metadata at all."""
    if metadata is None:
        kept = types.filter(F.col("type").isin(*chosen.curated)) if chosen.curated else types
        return kept.select("type", F.col("type").alias("label"))
    m = metadata.select(F.col("technicalName").alias("m"), "name", "is_application", "is_codelist", "is_system")
    joined = types.join(m, F.col("type") == F.col("m"), "left")
    if chosen.curated:
        joined = joined.filter(F.col("type").isin(*chosen.curated))
    elif chosen.application or chosen.codelist or chosen.system:
        joined = joined.filter(
            (F.lit(chosen.codelist) & F.col("is_codelist"))
            | (F.lit(chosen.application) & F.col("is_application") & ~F.col("is_codelist"))
            | (F.lit(chosen.system) & F.col("is_system"))
        )
    return joined.select("type", label(F.col("name"), F.col("type")).alias("label"))


def relation_kind_filter(relations: DataFrame, metadata: DataFrame | None, chosen: TypeFilter) -> DataFrame:
    """(relation, label, rank) by the kind of the relation type; ``rank`` orders them by name.

    Without any metadata a kind that is asked for has no relations, unlike types.  A catalogue has few relation types, so
    one window orders them.
    """
    joined = relations.select("relation")
    if metadata is None:
        joined = joined.select("relation", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("kind"))
    else:
        m = metadata.select(F.col("technicalName").alias("m"), "name", F.col("type").alias("kind"))
        joined = joined.join(m, F.col("relation") == F.col("m"), "left")
    kinds = [k for k, on in (("application", chosen.application), ("system", chosen.system)) if on]
    if chosen.curated:
        joined = joined.filter(F.col("relation").isin(*chosen.curated))
    elif kinds:
        joined = joined.filter(F.col("kind").isin(*kinds))
    order = Window.partitionBy(F.lit(0)).orderBy("relation")
    return joined.select("relation", label(F.col("name"), F.col("relation")).alias("label"), F.row_number().over(order).alias("rank"))


def selected(names: DataFrame, column: str, current: str | None) -> DataFrame:
    """(chosen): the current name if it is among the names, else the first of them, else null."""
    is_there = F.max(F.when(F.col(column) == F.lit(current), F.col(column)))
    return names.agg(F.coalesce(is_there, F.min(column)).alias("chosen"))


def icon_kind(metadata: DataFrame) -> DataFrame:
    """(technicalName, kind): which icon stands in for a type without one."""
    kind = F.when(F.col("is_application") & ~F.col("is_codelist"), "application").when(F.col("is_system"), "system")
    return metadata.select("technicalName", kind.when(F.col("is_codelist"), "codelist").otherwise("generic").alias("kind"))


def searched(profiled: DataFrame, needle: str = "", limit: int = 50) -> DataFrame:
    """Attributes whose name holds the needle, whatever the case; then the first ``limit`` of each type (0: all)."""
    needle = needle.strip().lower()
    if needle:
        profiled = profiled.filter(F.contains(F.lower("name"), F.lit(needle)))
    if limit > 0:
        order = Window.partitionBy("type").orderBy("rank")
        profiled = profiled.withColumn("shown", F.row_number().over(order)).filter(F.col("shown") <= limit).drop("shown")
    return profiled


def attribute_view(profiled: DataFrame, metadata: DataFrame, needle: str = "", limit: int = 50) -> DataFrame:
    """The attribute chart and table of each type: texts, tier, widths of bars."""
    rows = searched(profiled, needle, limit)
    m = metadata.select(F.col("type").alias("mt"), F.col("name").alias("mn"), "attribute_name", "description", "mandatory")
    joined = rows.join(m, (F.col("type") == F.col("mt")) & (F.col("name") == F.col("mn")), "left")
    pct = F.coalesce("pct", F.lit(0.0))
    clamped = F.least(F.lit(100.0), F.greatest(F.lit(0.0), pct))
    unique_width = pct * (F.col("unique_pct") / 100)
    described = F.when(F.length(F.trim(F.coalesce("description", F.lit("")))) > 0, F.col("description"))
    description = F.coalesce(described, F.lit("(missing attribute description)"))
    shown = label(F.col("attribute_name"), F.col("name"))
    return joined.select(
        "type", "name", "rank", "count", "pct", "unique_count", "unique_pct",
        F.concat(shown, F.when(F.col("mandatory") == "critical", " *").otherwise("")).alias("display_name"),
        truncated(description, 100).alias("subtitle"),
        F.coalesce(F.col("unique_count").cast("string"), F.lit("–")).alias("unique_cell"),
        percent(pct, 3, 8).alias("pct_text"),
        tier(pct).alias("tier"),
        F.when(clamped <= 0, "0").when(clamped < 3, "12px").otherwise(F.concat(to_fixed(clamped, F.lit(2)), F.lit("%"))).alias("bar"),
        F.when(F.col("unique_pct").isNull() | (F.col("count") <= 0), None)
        .when(unique_width < 5, "6px")
        .otherwise(F.concat(F.lit("calc("), to_fixed(unique_width, F.lit(2)), F.lit("% - 2 * 3px)"))).alias("unique_bar"),
    )


def type_summary(counts: DataFrame) -> DataFrame:
    """(type, type_count, summary)."""
    text = F.when(
        F.col("type_count") > 0,
        F.concat(F.col("type_count").cast("string"), F.lit(" objects in "), F.col("type"), F.lit(". Showing attribute coverage.")),
    ).otherwise(F.concat(F.lit("No objects for "), F.col("type"), F.lit(".")))
    return counts.select("type", "type_count", text.alias("summary"))


def coverage(stats: DataFrame) -> DataFrame:
    """Per (relation, side): coverage_text, and of the coverage pie the share connected, the share of
    parallel edges and their arcs; null where there is no data."""
    sides = F.array(
        *[F.struct(F.lit(tag).alias("side"), F.col(f"{n}_total_nodes").alias("total"), F.col(f"{n}_connected_nodes").alias("connected")) for tag, n in (("s", "source"), ("t", "target"))]
    )
    each = stats.select("relation", "total_edges", "duplicate_edges", F.explode(sides).alias("x")).select(
        "relation", "total_edges", F.col("duplicate_edges").alias("parallels"), "x.*"
    )
    known = (F.col("total") > 0) & (F.col("total_edges") != 0)
    clamp = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    share = F.when(known, clamp(F.col("connected") / F.col("total")))
    parallel = F.when(known, clamp(F.col("parallels") / F.col("total_edges")))
    pct = F.col("connected") / F.col("total") * 100
    return each.select(
        "relation", "side", "total", "connected",
        F.when(F.col("total") > 0, F.concat(to_fixed(pct, F.lit(1)), F.lit("%"))).otherwise("n/a").alias("coverage_text"),
        share.alias("connected_share"), parallel.alias("parallel_share"),
        (share * CIRCUMFERENCE).alias("connected_arc"), (parallel * CIRCUMFERENCE).alias("parallel_arc"),
    )


def relation_view(stats: DataFrame, metadata: DataFrame) -> DataFrame:
    """The header and the pills of each relation; one without metadata has a message alone."""
    m = metadata.select(
        F.col("technicalName").alias("m"), F.col("name").alias("mname"), "description", F.col("source_name").alias("sn"),
        F.col("source_type").alias("st"), F.col("target_name").alias("tn"), F.col("target_type").alias("tt"),
    )
    j = stats.join(m, F.col("relation") == F.col("m"), "left")
    end = lambda name, kind: F.coalesce(
        F.when(filled(F.col(kind)).isNotNull(), label(F.col(name), F.col(kind))), F.lit("?")
    )
    n = F.col("duplicate_edges")
    shown = {
        "source_label": end("sn", "st"),
        "target_label": end("tn", "tt"),
        "title": F.coalesce(filled(F.col("mname")), F.col("relation")),
        "description": short_description(F.col("description")),
        "edges_text": F.concat(F.col("total_edges").cast("string"), F.lit(" edges")),
        "pairs_text": F.concat(F.col("unique_pairs").cast("string"), F.lit(" unique pairs")),
        "parallel_text": F.when(n == 1, "1 parallel edge").otherwise(F.concat(n.cast("string"), F.lit(" parallel edges"))),
        "parallel_alert": n > 0,
        "cardinality_text": F.concat(F.lit("cardinality: "), escaped(F.coalesce("cardinality", F.lit("?")))),
    }
    known = F.col("m").isNotNull()
    return j.select(
        "relation",
        F.when(~known, "No metadata for this relation.").alias("message"),
        *[F.when(known, v).alias(k) for k, v in shown.items()],
    )


def degree_view(distribution: DataFrame) -> DataFrame:
    """Degrees as they are shown."""
    # A median of .0 is shown without it.
    text = lambda c: F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"\.0$", ""), F.lit("?"))
    return distribution.select(
        "relation", "side", text("degree_min").alias("min_text"), text("degree_max").alias("max_text"),
        F.coalesce(to_fixed(F.col("degree_avg"), F.lit(3)), F.lit("?")).alias("avg_text"), text("degree_median").alias("median_text"),
        text("degree_p90").alias("p90_text"), text("degree_p99").alias("p99_text"),
    )


#: Units of a fraction: sums of them are whole numbers, and so exact in any order.
UNITS = 2.0**62


def pie_layout(rows: DataFrame, weight: str = "fraction") -> DataFrame:
    """(relation, side, island, part, start, idx, r, g, b) of rows with a size or fraction, the column ``weight``.

    Weights over 0 fill the circle, the largest first; colours take turns and
    fade as parts get small.  Sums are over whole numbers, fractions counted in
    ``UNITS``, and are divided once at the end, so each number is the same
    however the rows are partitioned.
    """
    w = F.col(weight)
    whole = w.cast("bigint") if rows.schema[weight].dataType.typeName() in ("byte", "short", "integer", "long") else F.round(w * UNITS).cast("decimal(38,0)")
    some = rows.filter((w > 0) & ~F.isnan(w.cast("double"))).select("relation", "side", "island", whole.alias("amount"))
    totals = some.groupBy("relation", "side").agg(F.sum("amount").cast("double").alias("total"))
    placed = ranked(some, ["relation", "side"], [F.desc("amount"), F.asc("island")], total="amount").join(F.broadcast(totals), ["relation", "side"])
    share = lambda c: F.col(c).cast("double") / F.col("total")
    placed = placed.select(
        "relation", "side", "island", share("amount").alias("part"), share("before").alias("start"), ((F.col("rank") - 1) % len(COLOURS)).alias("idx")
    )
    t = F.when(F.col("part") > 0.05, 1.0).otherwise((F.col("part") / 0.05) * (F.col("part") / 0.05))
    vivid = lambda k: F.element_at(F.array(*[F.lit(c[k]) for c in COLOURS]), F.col("idx") + 1)
    shade = lambda k: F.floor(REST[k] + t * (vivid(k) - REST[k]) + 0.5).cast("int")
    return placed.select("*", shade(0).alias("r"), shade(1).alias("g"), shade(2).alias("b"))
