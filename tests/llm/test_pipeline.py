"""The pipeline against its SQL, and on odd documents."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import common, mixing
from tests.llm import oracle

SF = "/root/testdata/sf0.001"


def test_against_sql(spark):
    assert oracle.compare(spark, "pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL, SF) == ""


def test_stages_keep_columns_and_take_odd_documents(spark, docs, empty):
    for found in (docs, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, found, SF)
            assert out.columns == docs.columns and out.count() <= found.count()
        mixed = corpus_pipeline.mixture(spark, found, SF)
        assert set(docs.columns) <= set(mixed.columns) and mixed.filter("taken = 0").count() == 0


def test_the_mix_has_what_is_taken(spark, docs):
    """Words of each source, epochs, copies and the document at the cut, against the operator's numbers."""
    want = {(r.source, r.doc_id, r.text_key): r.n for r in mixing.mix(docs).groupBy("source", "doc_id", "text_key").agg(F.sum("taken").alias("n")).collect() if r.n}
    mixed = corpus_pipeline.mixture(spark, docs, SF).drop("text_key").withColumnRenamed("text", "now")
    full = docs.select("doc_id", "source", "text", common.text_key(F.col("text")).alias("text_key")).distinct()
    rows = mixed.withColumn("n_words", F.size(common.space_words(F.col("now")))).collect()
    assert all(r.n_words == r.taken > 0 and (r.taken == r.size or len(r.now) == r.n_chars) for r in rows)
    cut = [r for r in rows if r.taken < r.size]
    assert len({r.source for r in cut}) == len(cut) <= 5
    texts = full.collect()
    got = Counter()
    for r in rows:
        fits = [t for t in texts if t.doc_id == r.doc_id and t.source == r.source and (t.text == r.now if r.taken == r.size else (t.text or "").split()[: r.taken] == r.now.split())]
        got[r.source, r.doc_id, fits[0].text_key] += r.taken
    assert got == want


def test_copies_are_taken_one_after_the_other(spark):
    rows = [(None, "a b c", "s", 1)] * 7 + [(None, "a b c", "s", 2)] * 4 + [(1, "d " * 10, "t", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    got = mixing.mixture(df, length_col="n_chars").collect()
    of = {s: sum(r.taken for r in got if r.source == s) for s in "st"}
    assert of == {r.source: int(r.target) for r in got} and sum(r.taken < r.size for r in got) <= 2
    assert max(Counter((r.source, r.n_chars, r.epoch) for r in got if r.taken == r.size and r.source == "s").values()) <= 7


def test_of_each_group_one_stays(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(3, text, "en", "a", 1), (2, text + " end", "en", "a", 1), (9, text.replace("w", "v"), "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()) == [2, 9]
