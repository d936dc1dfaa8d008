"""Streaming = batch, idempotent sink under replay, quarantine; model invariants; driver contract."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gripe import lexicons as L
from gripe.functions import scoring as SC
from gripe.operators import churn as CH
from gripe.operators import sinks as SK
from gripe.operators import topics as TP
from gripe.sources import complaints as CP
from gripe.streaming import pipeline as PL

from .conftest import SF001

RECORDS = [
    {"company": "VODAFONE", "date": "5 Mayıs 10:30", "link": "https://x.com/1", "content": "Fatura iptal edildi!",
     "crawl_timestamp": 1.0},
    {"company": "TURKCELL", "date": "6 Mayıs 11:00", "link": "https://x.com/2", "content": "Harika, güzel hizmet",
     "crawl_timestamp": 2.0},
    {"company": "TURKCELL", "date": "7 Mayıs 12:00", "link": "https://x.com/3", "content": "zam var ama neden",
     "crawl_timestamp": 3.0, "extra": "ignored"},
]


def _write(dirpath, name, lines, mtime):
    p = os.path.join(dirpath, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(p, (mtime, mtime))  # distinct mtimes give a defined micro-batch order


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="gripe-stream-")
    src, target, ckpt, quar = (os.path.join(base, n) for n in ("src", "store", "ckpt", "quarantine"))
    os.makedirs(src)
    lines = [json.dumps(r, ensure_ascii=False) for r in RECORDS]
    _write(src, "a.json", lines[:2] + ["{not json"], 1_000_000)
    _write(src, "b.json", lines, 1_000_100)  # replay of the first two + a new one
    raw = PL.read_json_files(spark, src, max_files_per_trigger=1)
    q = PL.start_pipeline(PL.process(raw, L.REFERENCE), target, ckpt, quarantine=quar,
                          trigger={"availableNow": True})
    q.awaitTermination()
    stored = SK.read_store(spark, target)
    assert stored.count() == 3
    got = {r.link: (r.cleaned, r.sentiment) for r in stored.collect()}
    batch = CP.enrich(spark.createDataFrame([(r["link"], r["content"]) for r in RECORDS], "link string, content string"),
                      L.REFERENCE)
    want = {r.link: (r.cleaned, r.sentiment) for r in batch.collect()}
    assert got == want
    assert got["https://x.com/1"][1] == "NEGATIF" and got["https://x.com/2"][1] == "POZITIF"
    assert spark.read.parquet(quar).first().raw_value == "{not json"
    # restart on the same checkpoint: nothing new, nothing twice
    q2 = PL.start_pipeline(PL.process(PL.read_json_files(spark, src), L.REFERENCE), target, ckpt,
                           quarantine=quar, trigger={"availableNow": True})
    q2.awaitTermination()
    assert SK.read_store(spark, target).count() == 3


def test_one_query_feeds_two_sinks(spark):
    """One read of the source; the persisted batch feeds the store and a second sink."""
    base = tempfile.mkdtemp(prefix="gripe-t1-")
    src, target, ckpt, side = (os.path.join(base, n) for n in ("src", "store", "ckpt", "side"))
    os.makedirs(src)
    _write(src, "a.json", [json.dumps(r, ensure_ascii=False) for r in RECORDS], 1_000_000)

    def side_sink(df, batch_id):
        df.select("company", "sentiment", "cleaned", "processed_at").write.mode("append").parquet(side)

    q = PL.start_pipeline(PL.process(PL.read_json_files(spark, src), L.REFERENCE), target, ckpt,
                          extra_sinks=[side_sink], trigger={"availableNow": True})
    q.awaitTermination()
    a = {(r.cleaned, r.processed_at) for r in SK.read_store(spark, target).collect()}
    b = {(r.cleaned, r.processed_at) for r in spark.read.parquet(side).collect()}
    assert a == b and len(a) == 3  # same rows and the same processing timestamps
    assert PL.throughput(q) >= 0.0 and isinstance(q.recentProgress, list)


def test_error_policy(spark):
    base = tempfile.mkdtemp(prefix="gripe-err-")
    src = os.path.join(base, "src")
    os.makedirs(src)
    _write(src, "a.json", [json.dumps(RECORDS[0])], 1_000_000)

    def failing(df, batch_id):
        raise RuntimeError("sink down")

    def run(policy, name):
        q = PL.start_pipeline(PL.process(PL.read_json_files(spark, src), L.REFERENCE), os.path.join(base, name),
                              os.path.join(base, name + "-ck"), extra_sinks=[failing], on_error=policy,
                              trigger={"availableNow": True})
        q.awaitTermination()

    run("skip", "skip")  # the stream goes on; the batch is in the quarantine
    assert SK.read_store(spark, os.path.join(base, "skip")).count() == 1
    put = spark.read.parquet(os.path.join(base, "skip_quarantine")).collect()
    assert [json.loads(r.raw_value)["link"] for r in put] == [RECORDS[0]["link"]] and "RuntimeError" in put[0].reason
    with pytest.raises(Exception):
        run("raise", "raise")


def test_every_row_is_stored_duplicate_or_quarantined(spark):
    """Records without a link, undecodable lines, versions of one link in a batch, widely spread crawl times, a replay."""
    base = tempfile.mkdtemp(prefix="gripe-lossless-")
    src, target, ckpt = (os.path.join(base, n) for n in ("src", "store", "ckpt"))
    os.makedirs(src)
    rec = [{"company": "C", "date": "d", "link": f"l{i}", "content": f"metin {i}", "crawl_timestamp": 1.7e9 + 86_400.0 * 40 * i}
           for i in range(5)]
    rec.append({"company": "C", "date": "d", "content": "no link", "crawl_timestamp": 1.7e9})
    rec.append(dict(rec[0], content="later version", crawl_timestamp=1.7e9 + 60))
    rec.append({"company": "C", "date": "d", "link": "l9", "content": "no time"})
    lines = [json.dumps(r) for r in rec] + ["{broken"]
    _write(src, "a.json", lines, 1_000_000)
    _write(src, "b.json", lines, 1_000_100)  # a second delivery of everything
    raw = PL.read_json_files(spark, src, max_files_per_trigger=1)
    PL.start_pipeline(PL.process(raw, L.REFERENCE), target, ckpt, trigger={"availableNow": True}).awaitTermination()
    stored = sorted((r.link, r.content) for r in SK.read_store(spark, target).collect())
    assert stored == sorted([(f"l{i}", f"metin {i}") for i in range(5)] + [("l9", "no time")])
    rejected = spark.read.parquet(target + "_quarantine").collect()
    assert len(rejected) == 4 and sorted({r.batch_id for r in rejected}) == [0, 1]
    duplicates = 2 * len(lines) - len(stored) - len(rejected)
    assert duplicates == 8  # l0..l4 and l9 again, and the later version of l0 twice


def test_retried_batch_writes_nothing_twice(spark):
    base = tempfile.mkdtemp(prefix="gripe-retry-")
    lines = [json.dumps(r) for r in RECORDS] + ["{broken", json.dumps({"content": "no link"})]
    batch = PL.process(spark.createDataFrame([(x,) for x in lines], "value string"), L.REFERENCE)
    write = PL.idempotent_batch(base + "/s")
    for _ in range(2):  # the same batch id again: as after a failure behind the writes
        write(batch, 7)
    assert SK.read_store(spark, base + "/s").count() == len(RECORDS)
    assert spark.read.parquet(base + "/s_quarantine").count() == 2


def test_insert_reads_only_the_parts_it_needs(spark, monkeypatch):
    """The second micro-batch touches one day of three; the folders of the others are not opened."""
    base = tempfile.mkdtemp(prefix="gripe-parts-")
    rows = [(f"l{i}", f"2024-01-0{1 + i % 3} 10:00:00") for i in range(30)]
    df = spark.createDataFrame(rows, "link string, t string").withColumn("crawled_at", F.to_timestamp("t")).drop("t")
    SK.upsert_new(df, base + "/s", "link", order_col="crawled_at", part=SK.day_part("crawled_at"))
    seen = []
    exists = SK.path_exists
    monkeypatch.setattr(SK, "path_exists", lambda s, p: seen.append(p) or exists(s, p))
    for day in (1, 3):  # unreadable folders would fail a scan of the store
        bad = f"{base}/s/part=2024-01-0{day}/part-bad.parquet"
        with open(bad, "w") as f:
            f.write("no parquet")
    second = df.filter(F.dayofmonth("crawled_at") == 2).union(
        spark.createDataFrame([("new", "2024-01-02 11:00:00")], "link string, t string").select("link", F.to_timestamp("t")))
    SK.upsert_new(second, base + "/s", "link", order_col="crawled_at", part=SK.day_part("crawled_at"))
    assert seen == [f"{base}/s/part=2024-01-02"]
    got = spark.read.parquet(f"{base}/s/part=2024-01-02").select("link").collect()
    assert sorted(r.link for r in got) == sorted([x for x, t in rows if "01-02" in t] + ["new"])


def test_job_scan_prunes_days(spark):
    base = tempfile.mkdtemp(prefix="gripe-since-")
    rows = [(f"l{i}", f"2024-01-0{1 + i % 3} 10:00:00") for i in range(9)] + [("u", None)]
    df = spark.createDataFrame(rows, "link string, t string").withColumn("crawled_at", F.to_timestamp("t")).drop("t")
    SK.upsert_new(df, base + "/s", "link", order_col="crawled_at", part=SK.day_part("crawled_at"))
    got = CP.load_complaints(spark, base + "/s", since="2024-01-02")
    assert sorted(r.link for r in got.collect()) == sorted([x for x, t in rows if t is None or t >= "2024-01-02"])
    assert "PartitionFilters: [isnotnull(part" in got._jdf.queryExecution().toString().replace("\n", " ")
    assert CP.load_complaints(spark, base + "/s").count() == 10


def test_null_order_column_keeps_the_row(spark):
    target = tempfile.mkdtemp(prefix="gripe-nullorder-") + "/s"
    df = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 2, "z"), (None, 1, "w")], "link string, o long, v string")
    SK.upsert_new(df, target, "link", order_col="o")
    assert sorted((r.link, r.v) for r in SK.read_store(spark, target).collect()) == [("a", "x"), ("b", "z")]


def test_compaction_and_versions_on_read(spark):
    base = tempfile.mkdtemp(prefix="gripe-compact-")
    for k in range(3):
        df = spark.createDataFrame([(f"l{i}", f"2024-01-0{1 + k} 10:00:00", f"v{k}") for i in range(4)],
                                   "link string, t string, v string").withColumn("crawled_at", F.to_timestamp("t")).drop("t")
        SK.upsert_new(df, base + "/s", "link", order_col="crawled_at", part=SK.day_part("crawled_at"))
        more = df.withColumn("link", F.concat("link", F.lit("b")))
        SK.upsert_new(more, base + "/s", "link", order_col="crawled_at", part=SK.day_part("crawled_at"))
    SK.compact(spark, base + "/s", "2024-01-02")
    files = [f for f in os.listdir(base + "/s/part=2024-01-02") if f.endswith(".parquet")]
    assert len(files) == 1
    assert SK.read_store(spark, base + "/s").count() == 24
    first = SK.read_store(spark, base + "/s", key="link", order_col="crawled_at").collect()
    assert len(first) == 8 and {r.v for r in first} == {"v0"}


def test_upsert_new_retry_inserts_nothing_twice(spark):
    target = os.path.join(tempfile.mkdtemp(prefix="gripe-upsert-"), "t")
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "doc_id long, link string, cleaned string")
    SK.upsert_new(df, target, "cleaned", order_col="doc_id", hashed_key=True)
    SK.upsert_new(df, target, "cleaned", order_col="doc_id", hashed_key=True)
    got = sorted((r.doc_id, r.cleaned) for r in SK.read_store(spark, target).collect())
    assert got == [(1, "x"), (3, "y")]


def test_lda_invariants(spark):
    docs = CP.documents_as_complaints(spark, SF001)
    st = CP.enrich(docs, L.FIXTURE).select("doc_id", "company", "link", "cleaned", "sentiment")
    vocab, cv, model = TP.fit_topics(st, "cleaned", L.FIXTURE.analysis_stop, passes=2, updates=5)
    t = TP.assign_topics(st, cv, model, "cleaned", L.FIXTURE.analysis_stop)
    r = t.select(F.min("topic").alias("lo"), F.max("topic").alias("hi"),
                 F.max(F.abs(F.aggregate("topic_dist", F.lit(0.0), lambda a, x: a + x) - 1)).alias("err")).first()
    assert 1 <= r.lo and r.hi <= 3 and r.err < 1e-6
    terms = TP.topic_terms(model, vocab, 5)
    assert terms.select("topic").distinct().count() == 3
    named = t.select(TP.name_topics("topic").alias("n")).distinct().collect()
    assert {x.n for x in named} <= set(L.TOPIC_NAMES.values())


def test_forest_scores_and_single_class(spark):
    rows = [(i % 3, i % 2, float(i % 4), (i // 3) % 2, (i // 5) % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "crit_hits int, mid_hits int, sentiment_weight double, is_billing int, is_infra int")
    df = df.withColumn("churn_label", SC.churn_label("crit_hits", "sentiment_weight"))
    rf = CH.fit_forest(df, trees=10)
    s = CH.score_risk(rf, df).select(F.min("churn_risk").alias("lo"), F.max("churn_risk").alias("hi")).first()
    assert 0 <= s.lo <= s.hi <= 100
    only0 = df.withColumn("churn_label", F.lit(0))
    rf0 = CH.fit_forest(only0, trees=5)
    assert CH.score_risk(rf0, only0).agg(F.max("churn_risk")).first()[0] == 0.0


def test_driver_contract(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert out.columns == ["company", "sentiment", "n"] and out.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def _planted(spark):
    groups = {"billing": ["fatura", "ucret", "odeme", "borc"], "network": ["sinyal", "baglanti", "hiz", "kesinti"],
              "tariff": ["paket", "tarife", "dakika", "kampanya"]}
    docs = []
    for g, words in groups.items():
        for i in range(60):
            docs.append((len(docs), g, " ".join(words[(i + j) % 4] for j in range(12))))
    return groups, spark.createDataFrame(docs, "doc_id long, company string, cleaned string")


def test_planted_topics_are_recovered_and_named(spark):
    groups, df = _planted(spark)
    # best of several seeded fits by log-likelihood (a single fit may merge two topics)
    vocab, cv, model = TP.fit_topics(df, "cleaned", [], k=3, min_df=5, passes=15, updates=30, restarts=8)
    t = TP.assign_topics(df, cv, model, "cleaned")
    # each planted group maps to one topic, and the three groups to three topics
    per_group = {g: {r.topic for r in t.filter(F.col("company") == g).select("topic").distinct().collect()}
                 for g in groups}
    assert all(len(v) == 1 for v in per_group.values())
    assert len(set().union(*per_group.values())) == 3
    names = {r.topic: r.name for r in TP.name_topics_by_seeds(model, vocab, groups, n=6).collect()}
    assert {names[next(iter(per_group[g]))] for g in groups} == set(groups)
    assert all(names[next(iter(per_group[g]))] == g for g in groups)


def test_lda_same_seed_same_result(spark):
    _, df = _planted(spark)
    runs = []
    for _ in range(2):
        vocab, cv, model = TP.fit_topics(df, "cleaned", [], k=3, passes=2, updates=5)
        runs.append(sorted((r.doc_id, r.topic) for r in TP.assign_topics(df, cv, model, "cleaned").collect()))
    assert runs[0] == runs[1]


def test_binary_queue_value_decodes(spark):
    """Queue values arrive as bytes (Kafka ``value``); the same decode + enrich applies."""
    raw = spark.createDataFrame([(bytearray(json.dumps(r, ensure_ascii=False).encode("utf-8")),) for r in RECORDS]
                                + [(bytearray(b"\xff\xfe not json"),)], "value binary")
    out = PL.process(raw, L.REFERENCE).collect()
    good = {r.link: r.sentiment for r in out if r.decoded}
    assert good == {"https://x.com/1": "NEGATIF", "https://x.com/2": "POZITIF", "https://x.com/3": "NOTR (TALEP)"}
    assert sum(1 for r in out if not r.decoded) == 1


def test_store_write_layout(spark):
    """One file per part from a small insert; no quarantine output without bad records."""
    import glob

    base = tempfile.mkdtemp(prefix="gripe-layout-")
    target = os.path.join(base, "t")
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("link")).repartition(8)
    SK.upsert_new(df, target, "link", buckets=16)
    buckets = glob.glob(target + "/part=*")
    assert len(buckets) == 16
    assert all(len(glob.glob(b + "/*.parquet")) == 1 for b in buckets)

    src, quar = os.path.join(base, "src"), os.path.join(base, "quar")
    os.makedirs(src)
    _write(src, "a.json", [json.dumps(RECORDS[0])], 1_000_000)
    q = PL.start_pipeline(PL.process(PL.read_json_files(spark, src), L.REFERENCE), os.path.join(base, "s"),
                          os.path.join(base, "ck"), quarantine=quar, trigger={"availableNow": True})
    q.awaitTermination()
    assert not os.path.exists(quar)


def test_copies_are_dropped_before_texts_are_enriched(spark, monkeypatch):
    """With a lexicon the insert moves short rows; the store holds the same as with enriched batches."""
    import json
    import tempfile

    from gripe.operators import sinks as SK

    base = tempfile.mkdtemp(prefix="short-rows-")
    rec = [("a", "X Fatura, 2024! iptal", 5.0), ("a", "zam", 5.0), ("a", "later", 6.0), ("b", None, None), ("c", "", 1.0),
           (None, "no link", 2.0)]
    lines = [json.dumps({"company": "K", "date": "d", "link": k, "content": c, "crawl_timestamp": t}) for k, c, t in rec] + ["{broken"]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    moved, plain = [], SK.first_per_key
    monkeypatch.setattr(SK, "first_per_key", lambda df, *a: (moved.append(set(df.columns)), plain(df, *a))[1])
    for _ in range(2):
        PL.idempotent_batch(base + "/short", lexicon=L.REFERENCE)(PL.records(raw), 0)
    assert moved and not any({"tokens", "filtered_tokens", "cleaned", "sentiment"} & m for m in moved)
    PL.idempotent_batch(base + "/long")(PL.process(raw, L.REFERENCE), 0)
    a, b = (SK.read_store(spark, f"{base}/{x}").drop("processed_at") for x in ("short", "long"))
    assert a.columns == b.columns and a.count() == 3
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {r.raw_value for r in spark.read.parquet(base + "/short_quarantine").collect()} == set(lines[-2:])
