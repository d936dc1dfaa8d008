"""The periodic batch jobs as Spark plans (T8): the analysis report and the
chart tables, computed from the complaint store.

The de-duplicated store is written once to the shared checkpoint folder and
read back, so every later step (TF-IDF, topic model, churn model, charts)
starts from a short lineage that survives lost executors.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as L
from ..operators import churn as CH
from ..operators import dedup as DD
from ..operators import report as RP
from ..operators import terms as TM
from ..operators import topics as TP
from ..operators.sinks import first_per_key
from ..session import materialize


_COLUMNS = ("doc_id", "company", "date", "link", "crawled_at", "cleaned", "sentiment")


def first_per_link(stored: DataFrame) -> DataFrame:
    """The earliest crawl of each link: the stream stores a link once per crawl day.  Rows without a link all stay."""
    rows = stored.select(*[c for c in _COLUMNS if c in stored.columns])
    return first_per_key(rows.filter("link IS NOT NULL"), "link", "crawled_at").unionByName(rows.filter("link IS NULL"))


def prepare_store(enriched: DataFrame) -> DataFrame:
    """Null texts dropped, one row per cleaned text (A1, P3), materialised.

    Keeper: the smallest ``doc_id`` when there is one, else the earliest
    crawl and then the smallest link (records that came through the stream).
    """
    cols = [c for c in _COLUMNS if c in enriched.columns]
    order = "doc_id" if "doc_id" in cols else [c for c in ("crawled_at", "link") if c in cols]
    return materialize(DD.dedup_text(enriched.select(*cols), "cleaned", order), "store")


def run_analysis(spark: SparkSession, store: DataFrame, lexicon: L.Lexicon = L.REFERENCE,
                 lda_passes: int = 10, lda_updates: int = 20, load_seconds: float = 0.0) -> dict:
    """Stages A-E of the report: TF-IDF top terms, topic crosstab, churn model,
    risk summary, alarm count and the throughput figure.  Returns DataFrames
    (small, bounded result tables) and timings."""
    out: dict = {}
    n_rows = store.count()
    out["n_rows"] = n_rows
    out["tfidf_top5"] = TM.tfidf_by_company(store, "cleaned", lexicon.analysis_stop, 30, 5)

    t0 = time.time()
    vocab, cv, model = TP.fit_topics(store, "cleaned", lexicon.analysis_stop, passes=lda_passes,
                                     updates=lda_updates)
    lda_s = time.time() - t0
    topics = materialize(TP.assign_topics(store, cv, model, "cleaned", lexicon.analysis_stop)
                         .drop("topic_dist"), "topics")
    out["topic_crosstab"] = RP.crosstab_pct(topics, "company", "topic", [1, 2, 3],
                                            names=["topic_1", "topic_2", "topic_3"], digits=2)
    out["topic_terms"] = TP.topic_terms(model, vocab, 10)

    feats = CH.churn_features(topics, lexicon, topic="topic")
    train, test = CH.hash_split(feats, "link", 20)
    rf = CH.fit_forest(train)
    out["metrics"] = CH.binary_metrics(rf.transform(test), "churn_label", "prediction")
    # per-complaint scores, written once: both summaries and any later reader use this table
    scored = materialize(CH.score_risk(rf, feats).drop("prediction"), "scored")
    out["risk_summary"] = RP.risk_summary(scored, "churn_risk")
    out["alarm_count"] = RP.alarm_count(scored, "churn_risk", 75)
    out["lda_seconds"] = lda_s
    out["_topics"] = topics  # the topic column, for the chart tables (no second LDA fit)
    out["_scored"] = scored
    out["throughput"] = n_rows / max(load_seconds + lda_s, 1e-9)
    return out


def chart_tables(store: DataFrame, lexicon: L.Lexicon = L.REFERENCE, topics: DataFrame | None = None) -> dict:
    """Data behind the seven charts (V1-V7)."""
    risk = CH.rule_risk_table(store, lexicon)
    big = TM.top_bigrams(store, "cleaned", 15)
    edges = TM.word_edges(big)
    t = {
        "bigram_top15": big,
        "word_edges": edges,
        "word_nodes": TM.word_nodes(edges),
        "cloud_words": TM.cloud_words(store, "cleaned", lexicon.analysis_stop, 60),
        "risk_heatmap": RP.crosstab_pct(risk, "company", "risk_group", L.RISK_LABELS,
                                        names=["low", "mid", "critical"], digits=2),
        "company_volume": RP.company_volume(store),
        "risk_share": RP.share_of_total(RP.category_counts(risk, "risk_group", L.RISK_LABELS), digits=2),
    }
    if topics is not None:
        named = topics.withColumn("topic_name", TP.name_topics("topic"))
        t["topic_share"] = RP.share_of_total(RP.value_counts(named, "topic_name"), digits=2)
    return t


def report_rows(tables: dict, max_rows: int = 10_000) -> dict:
    """Result tables as rows for display: at most ``max_rows`` of each (tables per company can be large; the whole
    tables are written by ``write_report``).

    Keys starting with ``_`` are full-size tables and are left out.
    """
    return {k: [r.asDict() for r in v.take(max_rows)] if isinstance(v, DataFrame) else v for k, v in tables.items()
            if not k.startswith("_")}


def run_job(spark: SparkSession, store_path: str, out_dir: str, lexicon: L.Lexicon = L.REFERENCE,
            fmt: str = "parquet", since: str | None = None) -> dict:
    """The periodic batch job (T8): store scan → first crawl per link → dedup → report + chart tables → one output per table.

    ``since`` limits the scan to complaints crawled on that day (``yyyy-MM-dd``) or later.

    Returns the scalar figures (row count, LDA seconds, throughput).
    """
    from ..operators.sinks import write_report
    from ..sources.complaints import load_complaints

    t0 = time.time()
    raw = load_complaints(spark, store_path, since=since)
    if raw is None:
        return {"n_rows": 0}
    store = prepare_store(first_per_link(raw))
    load_s = time.time() - t0
    res = run_analysis(spark, store, lexicon, load_seconds=load_s)
    tables = {k: v for k, v in res.items() if isinstance(v, DataFrame) and not k.startswith("_")}
    tables.update(chart_tables(store, lexicon, res["_topics"]))
    tables["scored"] = res["_scored"]
    write_report(tables, out_dir, fmt)
    return {k: v for k, v in res.items() if not isinstance(v, DataFrame)}


def main(argv: list[str] | None = None) -> None:
    import argparse
    import json

    from ..session import get_spark, size_session

    p = argparse.ArgumentParser(description="complaint analysis job")
    p.add_argument("--store", required=True, help="Parquet complaint store (stream output)")
    p.add_argument("--out", required=True, help="output folder, one table per report section")
    p.add_argument("--lexicon", default="reference", help="'reference', 'fixture' or a JSON file")
    p.add_argument("--format", default="parquet")
    p.add_argument("--since", help="first crawl day to read, yyyy-MM-dd")
    a = p.parse_args(argv)
    lex = L.profile(a.lexicon) if a.lexicon in L.PROFILES else L.Lexicon.load(a.lexicon)
    spark = get_spark("gripe-analysis")
    size_session(spark, a.store)  # shuffle partitions from the store's size
    print(json.dumps(run_job(spark, a.store, a.out, lex, a.format, a.since)))


if __name__ == "__main__":
    main()
