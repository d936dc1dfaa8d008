"""Rule risk (F14, F16), labels (P5), split (M9), metrics (A14), report tables."""

from pyspark.sql import functions as F

from gripe import lexicons as L
from gripe.functions import scoring as SC
from gripe.operators import churn as CH
from gripe.operators import report as RP

LOW, MID, CRIT = L.RISK_LABELS


def test_rule_risk_and_bins(spark):
    rows = [(0, "NOTR (TALEP)", 40, LOW), (0, "NEGATIF", 60, MID), (1, "??", 50, MID),
            (1, "NEGATIF", 90, CRIT), (2, "NEGATIF", 100, CRIT), (0, "POZITIF", 0, LOW), (1, "NOTR", 50, MID)]
    df = spark.createDataFrame([(c, s) for c, s, _, _ in rows], "crit int, s string")
    from gripe.functions.sentiment import sentiment_weight
    out = df.select(SC.rule_risk("crit", sentiment_weight("s")).alias("r"))
    out = out.select("r", SC.risk_bin("r").alias("g")).collect()
    assert [(r.r, r.g) for r in out] == [(e, g) for _, _, e, g in rows]


def test_bin_edges_right_closed(spark):
    df = spark.createDataFrame([(40,), (41,), (75,), (76,), (101,), (-1,), (102,)], "x int")
    got = [r.g for r in df.select(SC.risk_bin("x").alias("g")).collect()]
    assert got == [LOW, MID, MID, CRIT, CRIT, None, None]


def test_rule_risk_table_phrases(spark):
    df = spark.createDataFrame([("tüketici hakem iptal", "NEGATIF"), ("taşınması", "NEGATIF")],
                               "cleaned string, sentiment string")
    got = CH.rule_risk_table(df, L.REFERENCE).select("rule_crit_hits", "rule_risk").collect()
    assert [(r.rule_crit_hits, r.rule_risk) for r in got] == [(2, 100), (0, 60)]


def test_churn_label_and_features(spark):
    df = spark.createDataFrame([("iptal", "NEGATIF", 2), ("iptal", "POZITIF", 3), ("rezalet", "NOTR", None),
                                ("taşınması", "NOTR (TALEP)", 1)],
                               "cleaned string, sentiment string, topic int")
    got = CH.churn_features(df, L.REFERENCE).collect()
    assert [r.churn_label for r in got] == [1, 0, 0, 1]
    assert [(r.is_billing, r.is_infra) for r in got] == [(1, 0), (0, 1), (0, 0), (0, 0)]
    assert [r.mid_hits for r in got] == [0, 0, 1, 0]


def test_dominant_topic_first_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.3],), ([0.4, 0.4, 0.2],), ([0.0, 0.0, 0.0],)], "d array<double>")
    assert [r.t for r in df.select(SC.dominant_topic("d").alias("t")).collect()] == [2, 1, 1]


def test_hash_split_repeatable_and_complete(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("link"))
    tr, te = CH.hash_split(df, "link", 20)
    n_tr, n_te = tr.count(), te.count()
    assert n_tr + n_te == 2000 and 300 < n_te < 500
    tr2, te2 = CH.hash_split(df, "link", 20)
    assert sorted(r.link for r in te.collect()) == sorted(r.link for r in te2.collect())


def test_binary_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "y int, p int")
    m = CH.binary_metrics(df, "y", "p").first()
    assert (m.tp, m.fp, m.tn, m.fn) == (1, 1, 2, 1)
    assert abs(m.accuracy - 0.6) < 1e-9 and abs(m.precision - 0.5) < 1e-9 and abs(m.recall - 0.5) < 1e-9
    none = CH.binary_metrics(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p").first()
    assert none.precision == 0.0 and none.recall == 0.0 and none.f1 == 0.0


def test_crosstab_rows_sum_to_100_and_keep_empty_columns(spark):
    df = spark.createDataFrame([("A", LOW), ("A", CRIT), ("B", LOW), (None, LOW), ("B", None)],
                               "company string, g string")
    t = RP.crosstab_pct(df, "company", "g", L.RISK_LABELS, names=["low", "mid", "critical"]).orderBy("company")
    got = [(r.company, r.low, r.mid, r.critical) for r in t.collect()]
    assert got == [("A", 50.0, 0.0, 50.0), ("B", 100.0, 0.0, 0.0)]


def test_category_counts_show_zero(spark):
    df = spark.createDataFrame([(LOW,), (LOW,), (CRIT,)], "g string")
    c = RP.share_of_total(RP.category_counts(df, "g", L.RISK_LABELS)).collect()
    assert [(r.g, r.n) for r in c] == [(LOW, 2), (MID, 0), (CRIT, 1)]
    assert abs(sum(r.pct for r in c) - 100) < 1e-9


def test_risk_summary_and_alarm(spark):
    df = spark.createDataFrame([("A", 75.0), ("A", 74.99), ("B", 100.0), (None, 90.0)], "company string, s double")
    s = {r.company: (r.mean_risk, r.max_risk, r.n) for r in RP.risk_summary(df, "s").collect()}
    assert s == {"A": (75.0, 75.0, 2), "B": (100.0, 100.0, 1)}
    assert RP.alarm_count(df, "s", 75).first().n_alarm == 3


def test_company_volume_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "company string")
    assert [(r.company, r.n) for r in RP.company_volume(df).collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_global_max_and_value_counts(spark):
    df = spark.createDataFrame([("a", 3), ("b", 7), ("c", 7)], "k string, v int")
    assert {r.max_value for r in RP.global_max(df, "v").collect()} == {7}
    vc = RP.value_counts(spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "t string"), "t").collect()
    assert [(r.t, r.n) for r in vc] == [("y", 2), ("x", 1)]


def test_cluster_conf_sizing():
    from gripe.session import cluster_conf

    c = cluster_conf(100 * 10**12)
    assert 90_000 < int(c["spark.sql.shuffle.partitions"]) < 95_000
    assert c["spark.sql.files.maxPartitionBytes"] == "128m"
    assert cluster_conf(10**6)["spark.sql.shuffle.partitions"] == "200"


def test_input_bytes(spark):
    from gripe.session import input_bytes

    assert input_bytes(spark, "/root/testdata/sf0.001/documents.parquet") > 0
