"""Rows, and not ids, are what one of stays."""

from millrace.llm import jaccard_join


def test_one_row_of_each_component_stays(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(60))
    rows = [(5, text("a"))] * 4 + [(5, text("a") + " end"), (None, text("a"))]
    rows += [(None, text("b"))] * 3 + [(None, text("b") + " end"), (None, text("c")), (5, text("d")), (None, None), (None, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in jaccard_join.one_of_each(df).collect()]
    assert sorted((str(d), (t or "")[:1]) for d, t in kept) == [("5", "a"), ("5", "d"), ("7", ""), ("None", ""), ("None", ""), ("None", "b"), ("None", "c")]
