"""End-to-end batch plans, remaining sinks and a brute-force cross-check of cleaning + sentiment."""

import os
import re
import tempfile

from pyspark.sql import functions as F

from gripe import lexicons as L
from gripe.functions import scoring as SC
from gripe.operators import sinks as SK
from gripe.plans import analysis as AN
from gripe.plans import queries as Q
from gripe.sources import complaints as CP
from gripe.streaming import pipeline as PL

from .conftest import SF001


def _py_clean(text, stop):
    """Plain-Python statement of the cleaning rules, for a cross-check on small data."""
    if text is None:
        return None
    t = re.sub(r"[^a-zğüşıöç \t\n\x0b\f\r]", " ", text.lower())
    t = re.sub(r"[ \t\n\x0b\f\r]+", " ", t)
    stop_l = {w.lower() for w in stop}
    return " ".join(w for w in t.split(" ") if w.lower() not in stop_l)


def _py_sentiment(text, lex):
    if not text:
        return "NOTR"
    m = text.lower()
    score = sum(-2 for w in lex.negative if w in m) + sum(2 for w in lex.positive if w in m)
    if any(w in m for w in lex.request) and -4 < score < 4:
        return "NOTR (TALEP)"
    return "NEGATIF" if score <= -2 else "POZITIF" if score >= 2 else "NOTR"


def test_clean_and_sentiment_match_brute_force(spark):
    for lex in (L.FIXTURE, L.REFERENCE):
        e = Q.enriched(spark, SF001, lex).select("doc_id", "content", "cleaned", "sentiment").collect()
        assert len(e) > 100
        for r in e:
            c = _py_clean(r.content, lex.stream_stop)
            assert r.cleaned == c
            assert r.sentiment == _py_sentiment(c, lex)


def test_analysis_and_chart_plans(spark):
    store = AN.prepare_store(Q.enriched(spark, SF001, L.FIXTURE))
    res = AN.run_analysis(spark, store, L.FIXTURE, lda_passes=2, lda_updates=5, load_seconds=1.0)
    assert res["n_rows"] == store.count() and res["throughput"] > 0
    rows = AN.report_rows({k: v for k, v in res.items() if k not in ("n_rows", "lda_seconds", "throughput")})
    assert len(rows["tfidf_top5"]) <= 5 * store.select("company").distinct().count()
    for r in rows["topic_crosstab"]:
        assert abs(r["topic_1"] + r["topic_2"] + r["topic_3"] - 100) < 0.02
    m = rows["metrics"][0]
    assert 0 <= m["accuracy"] <= 1
    charts = AN.report_rows(AN.chart_tables(store, L.FIXTURE, topics=res["_topics"]))
    assert len(charts["bigram_top15"]) == 15
    assert abs(sum(r["pct"] for r in charts["risk_share"]) - 100) < 0.02
    assert abs(sum(r["pct"] for r in charts["topic_share"]) - 100) < 0.02
    out = SK.write_report({"company_volume": AN.chart_tables(store, L.FIXTURE)["company_volume"]},
                          tempfile.mkdtemp(prefix="gripe-report-"))
    assert spark.read.parquet(out["company_volume"]).count() == len(charts["company_volume"])


def test_debug_sink_and_watermark_dedup(spark):
    src = tempfile.mkdtemp(prefix="gripe-dbg-")
    with open(os.path.join(src, "a.json"), "w", encoding="utf-8") as f:
        f.write('{"company":"A","link":"l1","content":"iptal","crawl_timestamp":10}\n')
        f.write('{"company":"A","link":"l1","content":"iptal","crawl_timestamp":11}\n')
        f.write('{"company":"B","link":"l2","content":"harika","crawl_timestamp":12}\n')
    s = PL.dedup_stream(PL.process(PL.read_json_files(spark, src), L.REFERENCE), "link", "crawled_at", "1 hour")
    q = PL.debug_sink(s, fmt="memory", name="dbg_out")
    q.processAllAvailable()
    q.stop()
    got = sorted((r.company, r.sentiment) for r in spark.sql("SELECT * FROM dbg_out").collect())
    assert got == [("A", "NEGATIF"), ("B", "POZITIF")]


def test_formats_and_record(spark):
    df = spark.createDataFrame([(1234567.891,)], "x double")
    r = df.select(SC.fmt_pct("x").alias("p"), SC.fmt_int("x").alias("i")).first()
    assert r.p == "1,234,567.89%" and r.i == "1,234,568"
    rec = CP.make_record(spark.range(1), F.lit("A"), F.lit("d"), F.lit("l"), F.lit("c")).first()
    assert rec.company == "A" and rec.crawl_timestamp > 1.6e9
    assert CP.load_complaints(spark, _empty_store(spark)) is None


def _empty_store(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="gripe-empty-"), "s")
    spark.createDataFrame([], "company string, cleaned string").write.parquet(p)
    return p


def test_stream_job_then_analysis_job(spark):
    base = tempfile.mkdtemp(prefix="gripe-job-")
    src = os.path.join(base, "src")
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    rec = d.select(F.col("source").alias("company"), F.lit(None).cast("string").alias("date"),
                   F.col("doc_id").cast("string").alias("link"), F.col("text").alias("content"),
                   F.col("doc_id").cast("double").alias("crawl_timestamp"))
    rec.write.json(src)
    PL.main(["--store", base + "/store", "--checkpoint", base + "/ck", "--files", src,
             "--lexicon", "fixture", "--available-now"])
    assert SK.read_store(spark, base + "/store").count() == d.count()
    res = AN.run_job(spark, base + "/store", base + "/out", L.FIXTURE)
    n_distinct = Q.enriched(spark, SF001).select("cleaned").distinct().count()
    assert res["n_rows"] == n_distinct
    assert {"tfidf_top5", "topic_crosstab", "risk_summary", "metrics", "alarm_count", "bigram_top15",
            "word_edges", "word_nodes", "cloud_words", "risk_heatmap", "company_volume", "risk_share",
            "topic_share"} <= set(os.listdir(base + "/out"))


def test_job_counts_a_link_crawled_on_two_days_once(spark):
    rows = [("A", "l1", "fatura iptal", "2024-01-02 10:00:00"), ("A", "l1", "harika", "2024-01-01 10:00:00"),
            ("A", "l1", "edited", None), ("A", None, "no link", "2024-01-01 10:00:00"), ("B", None, "also no link", None)]
    raw = spark.createDataFrame(rows, "company string, link string, cleaned string, t string")
    raw = raw.withColumn("crawled_at", F.to_timestamp("t")).drop("t")
    assert sorted(r.cleaned for r in AN.first_per_link(raw).collect()) == ["also no link", "harika", "no link"]
    base = tempfile.mkdtemp(prefix="gripe-days-")
    docs = [(f"c{i % 3}", "", f"l{i}", f"fatura word{i} word{i % 5} iptal", "NOTR", day) for i in range(60) for day in (1, 2)]
    store = spark.createDataFrame(docs, "company string, date string, link string, cleaned string, sentiment string, day int")
    store.select(*[c for c in store.columns if c not in ("cleaned", "day")], F.concat("cleaned", F.lit(" day"), "day").alias("cleaned"),
                 F.timestamp_seconds(F.col("day") * 86400).alias("crawled_at")).write.parquet(base + "/store")
    assert AN.run_job(spark, base + "/store", base + "/out", L.FIXTURE)["n_rows"] == 60


def test_native_sentiment_equals_pandas_udf_cross_check(spark):
    """The original row-at-a-time UDF, kept only as an Arrow-batched cross-check."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    lex = L.FIXTURE

    @pandas_udf("string")
    def udf_sentiment(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _py_sentiment(t, lex))

    e = Q.enriched(spark, SF001, lex)
    bad = e.filter(~F.col("sentiment").eqNullSafe(udf_sentiment("cleaned"))).count()
    assert bad == 0 and e.count() > 100
