"""From raw documents to a training mix, in five stages.

Each stage works on all that the one before it kept.  All but the last return
the columns of ``documents``.  For all stages: null ids and repeated rows are
documents like others, further columns stay as they are, texts may be of any
length, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_rules
from millrace.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go; null and empty texts are among them."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go, and documents of which no line is left.

    Null and empty texts lose nothing and stay.  Of rows that agree in id and text one counts as the first.  A column
    ``n_chars`` gets the new length.
    """
    found = line_dedup.dedup_lines(docs)
    left = found.filter((F.col("n_removed") == 0) | (F.length(F.trim(F.translate("kept", "\t\n\x0b\x0c\r", "     "))) > 0))
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    return left.select([changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the least id stays, null ids last; texts without words all stay."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go; null and empty texts hold none."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time that a document is taken, the one at a source's cut with its first words alone.

    Documents that aren't taken, or have no words, go; a null source is a source.  Further columns: epoch, size,
    source_size, target, taken, in place of any of these names.
    """
    return mixing.mixture(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each returns is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage-{number}")
    return docs


def _over(sql: str, table: str) -> str:
    return "(" + sql.replace("FROM documents", f"FROM {table}") + ")"


_KEPT = line_dedup.OP4_SQL.replace("sha256(kept) AS kept_sha256", "CASE WHEN d.text IS NULL THEN NULL ELSE kept END AS kept")
_PARTS = mixing.OP9_SQL.replace(
    "SELECT doc_id, size, source_size, target,",
    "SELECT doc_id, size, source_size, target, epochs, greatest(0, least(size, budget - epochs * source_size - before)) AS part,",
)

ORACLE_SQL = rf"""
WITH s1 AS MATERIALIZED (
  SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM {_over(quality_rules.OP7_SQL, "documents")} WHERE kept)),
s2 AS MATERIALIZED (
  SELECT s1.doc_id, k.kept AS text, s1.lang, s1.source, CAST(length(k.kept) AS BIGINT) AS n_chars
  FROM s1 JOIN {_over(_KEPT, "s1")} k USING (doc_id)
  WHERE n_removed = 0 OR regexp_matches(k.kept, '[^\x20\x09-\x0D]')),
s3 AS MATERIALIZED (
  SELECT * FROM s2 WHERE doc_id IN (SELECT component_id FROM {_over(jaccard_join.OP6_SQL, "s2")})),
s4 AS MATERIALIZED (
  SELECT * FROM s3 WHERE doc_id NOT IN (SELECT doc_id FROM {_over(decontaminate.OP1_SQL, "s3")} WHERE contaminated)),
m AS (
  SELECT s4.*, p.size, p.source_size, p.target, p.epochs, p.part, unnest(range(1, p.epochs + 2)) AS nth,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM s4 JOIN {_over(_PARTS, "s4")} p USING (doc_id) WHERE p.size > 0),
t AS (SELECT *, CASE WHEN nth <= epochs THEN size ELSE part END AS taken FROM m),
c AS (SELECT *, CASE WHEN taken < size THEN array_to_string(w[1:taken], ' ') ELSE text END AS cut FROM t WHERE taken > 0)
SELECT doc_id, cut AS text, lang, source, CASE WHEN taken < size THEN CAST(length(cut) AS BIGINT) ELSE n_chars END AS n_chars,
  CAST(nth AS INTEGER) AS epoch, size, source_size, target, CAST(taken AS BIGINT) AS taken FROM c
"""
