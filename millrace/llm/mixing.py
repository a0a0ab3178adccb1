"""Mixing sources to target weights.

Each document gets a hash-random key.  Keys are dealt into ranges, so that a
source of any size spreads over many tasks; sums of the ranges, and of groups
of them, give each range's offset, a running sum within the range gives each
document's, and the cut falls at the source's exact budget.

The key is of the id and the text, so that neither a hot id nor a hot text is
one range; documents that agree in both are one row until the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import space_words, text_key, written
from millrace.operators.ranks import ranked

#: Documents in a range of keys, about.
RANGE_ROWS = 500
#: Ranges are summed in groups that share all but so many hexadecimal digits of the key.
GROUP_DIGITS = 3
#: Copies of a document are dealt out in lots of so many.
LOT = 1000


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Sources by code point, null last, weigh ``weights``, repeating, and share
    ``share`` times all sizes; a target stops at ``most`` times the source's
    size, and the excess is shared anew by weight.  So target = least(cap,
    weight * level) with one level for all; sorted by cap / weight, the level
    follows from running sums.
    """
    each = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1
    ).cast("bigint")
    each = each.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    fills = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    each = each.withColumn(
        "level",
        (share * F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / (F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
    )
    # The level is that of the first source, in this order, whose cap isn't below its share.
    level = F.min(F.when(F.col("cap") >= F.col("weight") * F.col("level"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(total)["level"]
    return each.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * level, F.col("cap").cast("double"))).alias("target"),
    )


def mix(
    documents: DataFrame,
    *,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Per document: doc_id, text_key, source, size, source_size, target, taken.

    ``taken`` counts the words that the mix takes from the document: all of
    them for each whole epoch of its source, and once more if the document is
    within the rest of the source's budget; the document at the cut is taken
    in part, so each source gives floor(target) words.

    A null text has size 0 and takes 0.  A null source is a source.  Repeated
    rows are documents of their own, taken one after the other.  Ties of the
    key are broken by id, size and text, so reruns agree.  An empty table gives
    no rows.
    """
    grouped = mix_groups(
        documents, weights=weights, share=share, most=most, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, range_rows=range_rows
    )
    lots = grouped.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / LOT).cast("int"))))
    numbers = F.sequence(F.col("lot") * LOT, F.least((F.col("lot") + 1) * LOT, F.col("copies")) - 1)
    each = lots.withColumn("nth", F.explode(numbers))
    start = F.col("before") + F.col("nth") * F.col("size")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    return each.select(
        "doc_id", "text_key", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken")
    )


def mix_groups(
    documents: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix",
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """(doc_id, text_key, source, size, copies, before, source_size, target, epochs, rest): a row for all documents
    that agree in id, text and source.

    The source is taken whole ``epochs`` times, and ``rest`` words of it once more, in the order of keys;
    ``before`` words of it come before the first copy.
    """
    same = ["doc_id", "text_key", "source", "size", "key"]
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), digest))
    slim = written(
        documents.select(
            F.col(id_col).alias("doc_id"),
            text_key(F.col(text_col)).alias("text_key"),
            F.col(source_col).alias("source"),
            F.size(space_words(F.col(text_col))).cast("bigint").alias("size"),
            key.alias("key"),
        ),
        "sizes",
    )
    targets = source_targets(slim, weights, share, most)
    most_rows = slim.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    digits = 1
    while 16**digits * range_rows < most_rows and digits < 16:
        digits += 1
    slim = slim.groupBy(*same).agg(F.count("*").alias("copies"))
    slim = slim.withColumn("range", F.substring("key", 1, digits)).withColumn("words", F.col("size") * F.col("copies"))
    # Ranges are summed, offset and joined with their targets; there are few of them.
    sums = slim.groupBy("source", "range").agg(F.sum("words").alias("range_size"))
    sums = sums.withColumn("group", F.substring("range", 1, max(0, digits - GROUP_DIGITS)))
    groups = sums.groupBy("source", "group").agg(F.sum("range_size").alias("group_size"))
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    groups = groups.select(
        F.col("source").alias("g_source"), F.col("group").alias("g"), so_far("group_size", earlier("source").orderBy("group")).alias("group_offset")
    )
    placed = sums.join(groups, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("group") == F.col("g")))
    offset = F.col("group_offset") + so_far("range_size", earlier("source", "group").orderBy("range"))
    t = targets.withColumnRenamed("source", "of")
    offsets = placed.withColumn("offset", offset).join(t, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("of"), F.col("range").alias("of_range"), "offset", "source_size", "target"
    )
    joined = slim.join(
        offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("of_range"))
    ).drop("of", "of_range")
    before = F.col("offset") + so_far("words", earlier("source", "range").orderBy("key", "doc_id", "size", "text_key"))
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    return joined.select(
        "doc_id", "text_key", "source", "size", "copies", before.cast("bigint").alias("before"), "source_size", "target",
        epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("rest"),
    )


def mixture(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = None, **options
) -> DataFrame:
    """The mix itself: a row for each time that a document is taken, with its columns and epoch, size, source_size,
    target and taken, the words of this row.

    Whole documents are as they are; of the one at a source's cut the first ``taken`` words stay, joined by a space, and
    ``length_col`` gets the new length.  Documents that aren't taken, or have no words, go.  Columns of the documents
    named like the five give way to them.  Of rows that agree in id, text and source those of the least hash are taken first.
    """
    groups = mix_groups(documents, id_col=id_col, text_col=text_col, source_col=source_col, **options).filter("size > 0")
    groups = groups.select(
        F.col("doc_id").alias("i"), F.col("text_key").alias("k"), F.col("source").alias("s"), "size", "copies", "before", "source_size", "target", "epochs", "rest"
    )
    packed = documents.select(F.struct("*").alias("row"))
    row = F.col("row")
    same = row[id_col].eqNullSafe(F.col("i")) & (text_key(row[text_col]) == F.col("k")) & row[source_col].eqNullSafe(F.col("s"))
    joined = packed.join(groups, same)
    # Copies: equal rows are counted, and numbered in the order of their hashes.
    of_group = ["i", "k", "s", "size", "copies", "before", "source_size", "target", "epochs", "rest"]
    hashed = joined.filter("copies > 1").withColumn("digest", F.xxhash64(F.to_json("row", {"ignoreNullFields": "false"})))
    hashed = hashed.withColumn("of", F.xxhash64("i", "k", "s")).groupBy(*of_group, "of", "digest").agg(F.first("row").alias("row"), F.count("*").alias("n"))
    hashed = written(hashed, "copies")
    places = ranked(hashed.select("of", "digest", "n"), ["of"], [F.asc("digest")], total="n").select("of", "digest", F.col("before").alias("earlier"))
    lots = hashed.join(places, ["of", "digest"]).withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / LOT).cast("int"))))
    numbers = F.sequence(F.col("lot") * LOT, F.least((F.col("lot") + 1) * LOT, F.col("n")) - 1)
    copies = lots.withColumn("number", F.explode(numbers)).withColumn("nth", (F.col("number") + F.col("earlier")).cast("bigint"))
    each = joined.filter("copies = 1").withColumn("nth", F.lit(0).cast("bigint"))
    each = each.select("row", *of_group, "nth").unionByName(copies.select("row", *of_group, "nth"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before") - F.col("nth") * F.col("size"))).cast("bigint")
    each = each.withColumn("part", part).withColumn("times", F.col("epochs") + (F.col("part") > 0).cast("int")).filter("times > 0")
    each = each.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    taken = F.when(F.col("epoch") <= F.col("epochs"), F.col("size")).otherwise(F.col("part"))
    each = each.withColumn("taken", taken)
    is_cut = F.col("taken") < F.col("size")
    text = F.when(is_cut, F.array_join(F.slice(space_words(row[text_col]), 1, F.col("taken").cast("int")), " ")).otherwise(row[text_col])
    changed = {text_col: text} | ({length_col: F.when(is_cut, F.length(text).cast(documents.schema[length_col].dataType)).otherwise(row[length_col])} if length_col else {})
    own = ["epoch", "size", "source_size", "target", "taken"]
    return each.select(*[changed.get(c, row[c]).alias(c) for c in documents.columns if c not in own], *own)


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
    2 * source_size AS cap FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM r)::DOUBLE
      - coalesce(sum(cap) OVER o, 0)::DOUBLE)
    / ((SELECT sum(weight) FROM r) - coalesce(sum(weight) OVER o, 0))::DOUBLE AS level
  FROM r WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT level FROM l WHERE cap >= weight * level ORDER BY cap / weight, level LIMIT 1),
t AS (SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT level FROM v)) AS target FROM l),
x AS (
  SELECT d.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM x)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM e
"""
