"""Plan-shape guards for every registered query: no Python UDF, no cross or
nested-loop join, partial aggregation before shuffles, pruned scans."""

import pytest

from gripe.plans.queries import QUERIES

from .conftest import SF001

# model queries fit LDA / forests when called; their plans are MLlib's
MODEL = {"lda_topic_share", "lda_company_crosstab", "topic_terms", "rf_risk_summary", "rf_metrics",
         "rf_quality_metrics"}
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(fn(spark, SF001)) for n, fn in QUERIES.items() if n not in MODEL}


def test_no_python_udf_or_cross_join(plans):
    for name, p in plans.items():
        for bad in FORBIDDEN:
            assert bad not in p, f"{name} has {bad}"


def test_dedup_pre_aggregates_before_shuffle(plans):
    p = plans["dedup_texts"]
    assert "partial_min" in p and "Exchange hashpartitioning" in p


def test_top_k_per_company_limits_before_shuffle(plans):
    for name in ("cloud_words", "tfidf_top5"):
        p = plans[name]
        assert "WindowGroupLimit" in p, name
    assert "Partial" in plans["cloud_words"]


def test_scan_reads_only_needed_columns(plans):
    p = plans["sentiment_by_company"]
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in p
    assert "n_chars" not in p and "lang" not in p


def test_term_counts_aggregate_map_side(plans):
    for name in ("tfidf_top5", "vocab_top1000", "bigram_top15", "cloud_words", "company_volume"):
        assert "partial_count" in plans[name] or "partial_sum" in plans[name], name


def test_hot_key_third_of_rows(spark):
    """One text repeated in a third of all rows and one company holding a third of them."""
    from pyspark.sql import functions as F

    from gripe.operators import dedup as DD
    from gripe.operators import report as RP
    from gripe.operators import terms as TM

    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string")))
        .alias("company"),
        F.when(F.col("id") < n / 3, F.lit("aynı metin tekrar")).otherwise(
            F.concat(F.lit("metin "), F.col("id").cast("string"))).alias("cleaned")).repartition(8)
    d = DD.dedup_text(df)
    assert d.count() == n - n // 3 + 1
    assert d.filter(F.col("cleaned") == "aynı metin tekrar").first().doc_id == 0
    vol = {r.company: r.n for r in RP.company_volume(df).collect()}
    assert vol["HOT"] == n // 3 and sum(vol.values()) == n
    top = TM.cloud_words(df, "cleaned", [], 2).filter(F.col("company") == "HOT").orderBy("rank").collect()
    assert [(r.word, r.n) for r in top] == [("metin", 1000), ("aynı", 334)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_per_company_do_not_ship_the_text(spark):
    """The dedup aggregate carries only what its caller asked for."""
    from gripe.plans import queries as Q

    text = _plan(Q.q_company_volume(spark, SF001))
    made = [line.split(" AS _r#")[0].rsplit("struct(", 1)[1] for line in text.splitlines() if " AS _r#" in line]
    assert made and all("company" in x and "cleaned, cleaned" not in x and "content, " not in x for x in made)


def test_formatted_volume_has_no_window_and_reports_no_coalesce(spark):
    from gripe.operators import sinks as SK
    from gripe.plans import queries as Q

    assert "Window" not in _plan(Q.q_formatted_volume(spark, SF001))
    import inspect

    assert "coalesce(1)" not in inspect.getsource(SK.write_report)


def test_risk_share_compiles(spark):
    """The aggregate over the rows groups by the score, so its generated code stays small."""
    from gripe.plans import queries as Q

    text = _plan(Q.q_risk_share(spark, SF001))
    assert "keys=[rule_risk" in text


def test_round_summary_joins_pre_aggregated_links(spark):
    from gripe.operators import links as LK

    links = spark.createDataFrame([(1, "a", True)], "page_id long, link string, admitted boolean")
    text = _plan(LK.round_summary(links, spark.createDataFrame([("a",)], "link string")))
    assert text.count("partial_count(1)") == 1 and "Join" in text


def test_lda_makes_ten_passes_by_default():
    import inspect

    from gripe.operators import topics as TP
    from gripe.plans import analysis as AN

    fit = inspect.signature(TP.fit_topics).parameters
    job = inspect.signature(AN.run_analysis).parameters
    assert fit["passes"].default == job["lda_passes"].default == 10
    assert min(1.0, fit["passes"].default / fit["updates"].default) * fit["updates"].default >= 10


def test_model_queries_read_the_documents_once(spark, monkeypatch):
    """The store is written before the model's passes; every later scan is of that table."""
    from gripe.plans import analysis as AN
    from gripe.plans import queries as Q

    written = []
    real = AN.materialize
    monkeypatch.setattr(AN, "materialize", lambda df, name: written.append(name) or real(df, name))
    out = Q.q_rf_metrics(spark, SF001)
    assert written == ["model-store", "topics"]
    assert "documents.parquet" not in _plan(out)


def test_rows_are_scored_before_the_dedup_shuffle(spark, tmp_path):
    """No text is in the rows that the de-duplication of scored rows moves and sorts; the results are those of the store."""
    from gripe.operators import churn as CH
    from gripe.plans import queries as Q

    rows = [(3, "attion erble nicht", "b"), (1, "ATTION erble  nicht", "a"), (2, "x", "a"), (4, None, "c"),
            (1, "attion erble nicht", None)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{sf}/documents.parquet")
    for fn in (Q.q_high_risk_rows, Q.q_rule_risk_rows, Q.q_confusion_metrics, Q.q_churn_features, Q.q_sentiment_by_company):
        assert ", cleaned, " not in _plan(fn(spark, sf)), fn
    got = Q.q_rule_risk_rows(spark, sf).orderBy("doc_id").collect()
    full = CH.rule_risk_table(Q.store(spark, sf), Q.LEX).select(*got[0].asDict()).orderBy("doc_id").collect()
    assert got == full and [(r.doc_id, r.company) for r in got] == [(1, None), (2, "a")]
