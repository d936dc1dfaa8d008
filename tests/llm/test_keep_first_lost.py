"""The rows that exact dedup keeps, with all their columns."""

from gripe.llm import exact_dedup as ED


def test_keep_first_shuffles_no_text(spark, monkeypatch):
    rows = [(1, "a  b", "x"), (2, "a b", "y"), (2, "a\tb", "z"), (2, "c", "x"), (3, "c", "y"), (3, "c", "y"), (None, "a b", "n"),
            (None, "d", "n"), (None, "d", "o"), (4, None, "x"), (5, "", "x"), (6, "e", "x"), (6, "e", "y"), (1, "f", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    want = [(1, "a b"), (1, "f"), (2, "c"), (4, ""), (6, "e"), (None, "d")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, join in ((ED.MAX_SENT, "BroadcastHashJoin"), (0, "SortMergeJoin")):
            monkeypatch.setattr(ED, "MAX_SENT", most)
            kept = ED.keep_first(docs)
            got = [(r.doc_id, " ".join((r.text or "").split())) for r in kept.collect()]
            assert sorted(got, key=str) == sorted(want, key=str)
            assert join in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
