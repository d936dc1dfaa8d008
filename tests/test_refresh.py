"""The incremental report equals a full run, reads new days only, and survives failures."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gripe import lexicons as L
from gripe.operators import churn as CH
from gripe.operators import dedup as DD
from gripe.operators import report as RP
from gripe.operators import sinks as SK
from gripe.operators import terms as TM
from gripe.plans import refresh as RF
from gripe.session import list_names
from gripe.sources import complaints as CP

from .conftest import SF001

LEX = L.FIXTURE


@pytest.fixture(scope="module")
def records(spark):
    """The documents as records of four days, every text again on a later day, some without company or time."""
    e = CP.enrich(CP.documents_as_complaints(spark, SF001), LEX).select("doc_id", "company", "date", "link", "cleaned", "sentiment")
    day = F.pmod("doc_id", F.lit(4))
    at = F.timestamp_seconds(F.lit(1_704_067_200) + day * 86_400 + F.col("doc_id"))
    first = e.withColumn("crawled_at", F.when(F.col("doc_id") % 50 != 7, at)).withColumn(
        "company", F.when(F.col("doc_id") % 60 != 9, F.col("company")))
    again = first.withColumn("link", F.concat("link", F.lit("-again"))).withColumn("company", F.lit("later")).withColumn(
        "crawled_at", F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod("doc_id", F.lit(3)) * 86_400 + 50_000))
    return first.unionByName(again).drop("doc_id").withColumn("day", SK.day_part("crawled_at")).cache()


def _insert(records, store, days):
    SK.insert_unique(records.filter(F.col("day").isin(days)).drop("day"), store, "link", order_col="crawled_at",
                     part=SK.day_part("crawled_at"))


def _full(spark, store):
    rows = spark.read.parquet(store).select("company", "link", "cleaned", "sentiment", "crawled_at")
    rows = rows.withColumn("day", SK.day_part("crawled_at"))
    rows = DD.dedup_text(rows, "cleaned", ["day", "crawled_at", "link"])
    risk = CH.rule_risk_table(rows, LEX)
    return {"tfidf_top5": TM.tfidf_by_company(rows, "cleaned", LEX.analysis_stop, 30, 5),
            "cloud_words": TM.cloud_words(rows, "cleaned", LEX.analysis_stop, 60), "bigram_top15": TM.top_bigrams(rows, "cleaned", 15),
            "company_volume": RP.company_volume(rows),
            "risk_heatmap": RP.crosstab_pct(risk, "company", "risk_group", L.RISK_LABELS, names=["low", "mid", "critical"], digits=2),
            "risk_share": RP.share_of_total(RP.category_counts(risk, "risk_group", L.RISK_LABELS), digits=2)}


def _same(spark, store, state):
    got = RF.tables(spark, state, LEX)
    for name, want in _full(spark, store).items():
        a = sorted(map(repr, [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in got[name].select(*want.columns).collect()]))
        b = sorted(map(repr, [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in want.collect()]))
        assert a == b and a, name


@pytest.fixture()
def place():
    base = tempfile.mkdtemp(prefix="gripe-refresh-")
    return base + "/store", base + "/state"


D = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "undated"]


def test_day_by_day_equals_the_full_run_and_old_days_are_not_read(spark, records, place):
    store, state = place
    for k, days in enumerate(([D[0]], [D[1], D[2]], [D[3]])):
        _insert(records, store, days)
        for old in sum(([D[0]], [D[1], D[2]])[:k], []):  # reading a day that is done would fail
            name = next(n for n, _ in list_names(spark, f"{store}/part={old}") if n.endswith(".parquet"))
            os.rename(f"{store}/part={old}/{name}", f"{store}/hidden-{old}")
            with open(f"{store}/part={old}/{name}", "wb") as f:
                f.write(b"x" * os.path.getsize(f"{store}/hidden-{old}"))
        assert RF.update(spark, store, state, LEX) == days
        for old in sum(([D[0]], [D[1], D[2]])[:k], []):
            name = next(n for n, _ in list_names(spark, f"{store}/part={old}") if n.endswith(".parquet"))
            os.rename(f"{store}/hidden-{old}", f"{store}/part={old}/{name}")
            crc = f"{store}/part={old}/.{name}.crc"
            assert os.path.exists(crc)
    _same(spark, store, state)
    assert RF.update(spark, store, state, LEX) == []  # nothing new: nothing read


def test_late_days_changed_days_and_folding(spark, records, place):
    store, state = place
    _insert(records, store, [D[1], D[3]])
    RF.update(spark, store, state, LEX)
    _insert(records, store, [D[4]])  # undated records sort behind every day
    assert RF.update(spark, store, state, LEX) == [D[4]]
    _insert(records, store, [D[2]])  # a late day: it and all behind it
    assert RF.update(spark, store, state, LEX) == [D[2], D[3], D[4]]
    _same(spark, store, state)
    RF.fold(spark, state, D[3])
    assert len(list_names(spark, state + "/runs")) == 2
    _same(spark, store, state)
    _insert(records, store, [D[0]])  # before the folded days: their sum cannot be taken apart
    assert RF.update(spark, store, state, LEX) == D
    _same(spark, store, state)
    more = records.filter("day = '2024-01-04'").limit(5).withColumn("link", F.concat("link", F.lit("-x"))).withColumn(
        "cleaned", F.concat("cleaned", F.lit(" yeni")))
    _insert(more, store, [D[3]])
    assert RF.update(spark, store, state, LEX) == [D[3], D[4]]
    _same(spark, store, state)


@pytest.mark.parametrize("point", ["add", "_save", "commit"])
def test_a_failed_run_is_made_good_by_the_next(spark, records, place, monkeypatch, point):
    store, state = place
    _insert(records, store, [D[0], D[1]])
    RF.update(spark, store, state, LEX)
    _insert(records, store, [D[2]])
    owner = RF if point == "_save" else RF.KeyIndex
    old = getattr(owner, point)

    def stop(*a, **k):
        if point == "add":
            old(*a, **k)
        raise RuntimeError("stopped")

    monkeypatch.setattr(owner, point, stop)
    with pytest.raises(RuntimeError):
        RF.update(spark, store, state, LEX)
    monkeypatch.undo()
    RF.update(spark, store, state, LEX)
    _same(spark, store, state)
    assert RF.update(spark, store, state, LEX) == []


def test_other_word_lists_start_anew_and_the_job_writes_tables(spark, records, place):
    store, state = place
    _insert(records, store, [D[0]])
    RF.update(spark, store, state, L.REFERENCE)
    out = state + "-out"
    res = RF.run_refresh(spark, store, state, out, LEX)
    assert res["days_read"] == [D[0]] and "tfidf_top5" in res["tables"]
    _same(spark, store, state)
    assert spark.read.parquet(out + "/company_volume").count() > 0
    assert RF.tables(spark, state + "-none", LEX) == {} and RF.update(spark, state + "-none", state + "-s", LEX) == []
