"""Line dedup by overlapping three-line windows.

Consecutive lines are hashed, repeated windows are found over all documents,
and the lines of every occurrence but the first are removed; the stretches
that overlapping windows cover merge by themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_key, written


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _filled(lines: Column) -> Column:
    """Places, from 0, of the lines that hold more than white space."""
    return F.filter(
        F.transform(lines, lambda x, i: F.when(F.length(F.trim(F.translate(x, "\t\x0b\x0c\r", "    "))) > 0, i)),
        lambda i: i.isNotNull(),
    )


def repeated_lines(
    documents: DataFrame, *, window: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_key, places): the lines to remove of each document that has any.

    Windows are ``window`` consecutive lines, blank lines left out; lines are
    compared as they are.  The first occurrence, by doc_id (null first), text
    hash and place, stays; each line in a later one goes.  Of rows that agree
    in id and text this is for the first.
    """
    lines = documents.select(
        F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), _lines(F.col(text_col)).alias("lines")
    ).withColumn("filled", _filled(F.col("lines")))
    # Two hashes, the second of marked lines' hashes: 128 bits tell windows apart.
    at = lambda i: [F.get(F.col("filled"), i + F.lit(k)) for k in range(window)]
    line = lambda k: F.get(F.col("lines"), k)
    starts = F.when(
        F.size("filled") >= window,
        F.transform(
            F.sequence(F.lit(0), F.size("filled") - F.lit(window)),
            lambda i: F.struct(
                F.xxhash64(*[line(k) for k in at(i)]).alias("a"),
                F.xxhash64(F.lit("b"), *[F.xxhash64(F.lit("b"), line(k)) for k in at(i)]).alias("b"),
                F.array(*at(i)).alias("places"),
            ),
        ),
    )
    windows = (
        lines.select("doc_id", "text_key", starts.alias("starts"))
        .select("doc_id", "text_key", F.explode_outer("starts").alias("x"))
        .filter(F.col("x").isNotNull())
        .select("doc_id", "text_key", "x.a", "x.b", "x.places")
    )
    windows = written(windows, "line-windows")
    place = F.struct("doc_id", "text_key", F.col("places")[0].alias("at"))
    # Written, so that Spark can split the join of a hot window with its rows.
    first = written(
        windows.groupBy("a", "b")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select(F.col("a").alias("ra"), F.col("b").alias("rb"), "first"),
        "first-windows",
    )
    later = windows.join(first, (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb"))).filter(
        ~place.eqNullSafe(F.col("first"))
    )
    return later.groupBy("doc_id", "text_key").agg(
        F.array_distinct(F.flatten(F.collect_set("places"))).alias("places")
    )


def dedup_lines(
    documents: DataFrame, *, window: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(row, n_lines, n_removed, kept): each input row as a struct, and its text without later occurrences.

    A null text has no lines and stays null; an empty one is one blank line.
    Texts of fewer than ``window`` lines stay as they are.  Of rows that agree
    in id and text, null ids too, the first by the hash of the whole row is
    the first occurrence, and the others lose each line that is in a window.
    Columns of any name pass through in ``row``.  An empty table gives no rows.
    """
    found = repeated_lines(documents, window=window, id_col=id_col, text_col=text_col)
    told = documents.select(F.col(id_col).alias("i"), text_key(F.col(text_col)).alias("k"))
    copies = told.groupBy("i", "k").agg(F.count("*").alias("copies")).filter("copies > 1")
    both = (F.col("doc_id").eqNullSafe(F.col("i"))) & (F.col("text_key") == F.col("k"))
    found = found.join(copies, both, "full").select(
        F.coalesce("doc_id", "i").alias("doc_id"), F.coalesce("text_key", "k").alias("text_key"), "places", F.col("copies").isNotNull().alias("copied")
    )
    packed = documents.select(F.struct("*").alias("row"))
    row = F.col("row")
    joined = packed.join(
        found,
        row[id_col].eqNullSafe(F.col("doc_id")) & (text_key(row[text_col]) == F.col("text_key")),
        "left",
    )
    text = row[text_col]
    places = F.array_sort(F.coalesce("places", F.array().cast("array<int>")))

    def cut(rows: DataFrame, gone: Column) -> DataFrame:
        """Without the lines at the places ``gone``, in order: what is between them is put together."""
        rows = rows.select("row", _lines(text).alias("lines"), gone.alias("gone"))
        after = lambda i: F.when(i == 0, 0).otherwise(F.get(F.col("gone"), i - 1) + 1)
        runs = F.transform(F.concat("gone", F.array(F.size("lines"))), lambda end, i: F.slice(F.col("lines"), after(i) + 1, end - after(i)))
        return rows.select(
            "row",
            F.when(text.isNull(), 0).otherwise(F.size("lines")).cast("bigint").alias("n_lines"),
            F.size("gone").cast("bigint").alias("n_removed"),
            F.when(F.size("gone") == 0, text).otherwise(F.array_join(F.flatten(runs), "\n")).alias("kept"),
        )

    single = cut(joined.filter(~F.coalesce("copied", F.lit(False))), places)
    # Copies: equal rows are counted, and one row of each group stays as the first.
    hashed = joined.filter("copied").withColumn("digest", F.xxhash64(F.to_json("row", {"ignoreNullFields": "false"})))
    groups = written(
        hashed.groupBy("doc_id", "text_key", "digest").agg(F.first("row").alias("row"), F.first("places").alias("places"), F.count("*").alias("n")), "copies"
    )
    least = written(groups.groupBy(F.col("doc_id").alias("i"), F.col("text_key").alias("k")).agg(F.min("digest").alias("least")), "first-copies")
    groups = groups.join(least, both).withColumn("is_first", F.col("digest") == F.col("least"))
    others = groups.withColumn("n", F.col("n") - F.col("is_first").cast("int")).filter("n > 0")
    others = others.select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")).drop("copy")
    every = F.when(F.size(_filled(_lines(text))) >= window, _filled(_lines(text))).otherwise(F.array().cast("array<int>"))
    return single.unionByName(cut(groups.filter("is_first"), places)).unionByName(cut(others, every))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    found = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "row.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256")
    )


OP4_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, place, line FROM (
    SELECT doc_id, unnest(range(0, len(lines))) AS place, unnest(lines) AS line FROM d)),
f AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i FROM l
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (
  SELECT a.doc_id, a.i, [a.place, b.place, c.place] AS places,
    a.line || chr(10) || b.line || chr(10) || c.line AS body
  FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.i = a.i + 1 JOIN f c ON a.doc_id = c.doc_id AND c.i = a.i + 2),
k AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS nth FROM w),
g AS (SELECT DISTINCT doc_id, unnest(places) AS place FROM k WHERE nth > 1),
r AS (
  SELECT l.doc_id, count(g.place) AS n_removed,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.place) FILTER (WHERE g.place IS NULL), '') AS kept
  FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.place = g.place GROUP BY l.doc_id)
SELECT d.doc_id, CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(d.lines) END AS BIGINT) AS n_lines,
  CAST(n_removed AS BIGINT) AS n_removed, sha256(kept) AS kept_sha256
FROM d JOIN r USING (doc_id)
"""
