"""Ids that are texts, very long texts and words, for all operators."""

import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard_join, licenses, line_dedup, lm_score, mixing, quality_rules, secret_scan, substring_dedup, token_counts
from tests.llm.test_operators import TOKENIZER, grouped, without_repeats


@pytest.fixture(scope="module")
def odd(spark):
    """A text of 300,000 words, one of 40,000 lines, a word of two megabytes, and their copies."""
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(300_000))
    rows = [("a", long), ("b", "\n".join(f"l{i} x y" for i in range(40_000))), ("c", "q" * 2_000_000), ("d", long[:50_000]), ("a", "k1" * 700_000 + " x"), (None, "one two")]
    return rows, spark.createDataFrame([(*r, "s") for r in rows], "doc_id string, text string, source string").repartition(3).cache()


def test_texts_as_ids_and_very_long_texts(spark, odd, tmp_path):
    rows, df = odd
    bench = spark.createDataFrame([("i", rows[0][1][:200])], "item_id string, text string")
    ids = sorted(str(r[0]) for r in rows)
    for found in (
        decontaminate.contamination(df, bench), lm_score.score(df, rounds=2), line_dedup.dedup_lines(df).select("row.*", "n_removed"),
        token_counts.count_tokens(df, TOKENIZER), quality_rules.judge(df, share=0.5), mixing.mix(df), licenses.license_labels(df),
    ):
        assert sorted(str(r.doc_id) for r in found.select("doc_id").collect()) == ids
    got = substring_dedup.dedup_substrings(df).select("doc_id", "n_words", "n_removed", F.length("kept").alias("n")).collect()
    want = [(d, n, gone, len(kept)) for d, n, gone, kept in without_repeats(rows, 35)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    got = jaccard_join.similar_documents(df).select("doc_id", "n_shingles", "component_id", "n_links").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, grouped(rows)))
    assert {r.doc_id for r in secret_scan.candidates(df).select("doc_id").collect()} == {"a"}
