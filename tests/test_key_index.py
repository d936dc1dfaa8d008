"""The store-wide unique key: look-ups, failures at every point of an insert, compaction of runs and parts."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gripe.operators import key_index as KI
from gripe.operators import sinks as SK
from gripe.session import list_names, read_text, remove, write_text


def _rows(spark, rows):
    df = spark.createDataFrame(rows, "link string, t string, v string")
    return df.withColumn("crawled_at", F.to_timestamp("t")).drop("t")


def _insert(df, target, **more):
    SK.insert_unique(df, target, "link", order_col="crawled_at", part=SK.day_part("crawled_at"), **more)


def _stored(spark, target):
    return sorted((r.link, r.v) for r in SK.read_store(spark, target).collect())


@pytest.fixture()
def target():
    return tempfile.mkdtemp(prefix="gripe-index-") + "/s"


def test_a_link_of_three_days_is_stored_once_and_other_days_are_not_read(spark, target):
    for day in (1, 2, 3):
        _insert(_rows(spark, [(f"l{i}", f"2024-01-0{day} 10:00:00", f"v{day}") for i in range(20)] +
                      [(f"only{day}", f"2024-01-0{day} 11:00:00", "x")]), target)
        bad = f"{target}/part=2024-01-0{day}/part-bad.parquet"
        with open(bad, "w") as f:  # a scan of an older day would fail
            f.write("no parquet")
    for day in (1, 2, 3):
        remove(spark, f"{target}/part=2024-01-0{day}/part-bad.parquet")
    assert _stored(spark, target) == sorted([(f"l{i}", "v1") for i in range(20)] + [(f"only{d}", "x") for d in (1, 2, 3)])
    before = sorted(os.listdir(target))
    _insert(_rows(spark, [("l3", "2024-01-09 10:00:00", "late"), ("l4", "2024-01-02 10:00:00", "again")]), target)
    assert sorted(os.listdir(target)) == before  # nothing new: nothing written


def test_only_runs_whose_filter_hits_are_opened(spark, target):
    for k in range(3):
        _insert(_rows(spark, [(f"k{k}-{i}", "2024-01-01 10:00:00", "v") for i in range(300)]), target, buckets=8)
    index = SK.store_index(spark, target)
    live = index.runs()
    assert len(live) == 3
    known = spark.createDataFrame([("k1-7",)], "_key string")
    assert len(index.places(known)) == 1  # one bucket of one run
    fresh = spark.createDataFrame([(f"other-{i}",) for i in range(2000)], "_key string")
    assert len(index.places(fresh)) <= 3  # false hits are rare
    assert index.unseen(fresh).count() == 2000 and index.unseen(known).count() == 0
    plan = index.unseen(known)._jdf.queryExecution().toString()
    assert plan.count("bucket=") <= 3 and "part=" not in plan


class Broken(RuntimeError):
    pass


@pytest.mark.parametrize("point", ["after the keys", "in the store", "after the store"])
def test_a_failure_at_any_point_loses_and_doubles_nothing(spark, target, monkeypatch, point):
    _insert(_rows(spark, [("a", "2024-01-01 10:00:00", "1"), ("b", "2024-01-02 10:00:00", "1")]), target)
    batch = _rows(spark, [("b", "2024-01-03 10:00:00", "2"), ("c", "2024-01-03 10:00:00", "2"), ("d", "2024-01-04 10:00:00", "2")])
    if point == "after the store":
        monkeypatch.setattr(KI.KeyIndex, "commit", lambda *a, **k: (_ for _ in ()).throw(Broken()))
    else:
        add = KI.KeyIndex.add

        def stop(self, keys, run=None):
            made = add(self, keys, run)
            if point == "in the store":  # one of two parts arrived
                c = batch.filter("link = 'c'").withColumn("_key", F.col("link")).withColumn("part", SK.day_part("crawled_at"))
                c.write.mode("append").partitionBy("part").parquet(target)
            raise Broken()

        monkeypatch.setattr(KI.KeyIndex, "add", stop)
    with pytest.raises(Broken):
        _insert(batch, target)
    monkeypatch.undo()
    assert len(SK.store_index(spark, target).pending()) == 1
    _insert(batch, target)  # the retry
    want = sorted([("a", "1"), ("b", "1"), ("c", "2"), ("d", "2")])
    assert _stored(spark, target) == want and SK.store_index(spark, target).pending() == []
    _insert(batch, target)
    assert _stored(spark, target) == want


def test_runs_are_merged_and_stay_exact(spark, target):
    for k in range(9):
        _insert(_rows(spark, [(f"l{i}", "2024-01-01 10:00:00", f"v{k}") for i in range(k * 5, k * 5 + 10)]), target, fanout=3)
    index = SK.store_index(spark, target, fanout=3)
    levels = sorted(m["level"] for m in index.runs().values())
    assert len(levels) < 5 and max(levels) == 2
    assert sum(m["keys"] for m in index.runs().values()) == 50
    assert [k for k, _ in _stored(spark, target)] == sorted(f"l{i}" for i in range(50))
    left = {n for n, _ in list_names(spark, target + "_index")}
    assert left == set(index.runs())


def test_index_is_built_for_a_store_without_one(spark, target):
    df = _rows(spark, [("a", "2024-01-01 10:00:00", "1"), ("b", "2024-01-02 10:00:00", "1")])
    SK.upsert_new(df, target, "link", order_col="crawled_at", part=SK.day_part("crawled_at"))
    _insert(_rows(spark, [("a", "2024-01-05 10:00:00", "2"), ("c", "2024-01-05 10:00:00", "2")]), target)
    assert _stored(spark, target) == [("a", "1"), ("b", "1"), ("c", "2")]


def test_nulls_repeats_binary_keys_and_empty_batches(spark, target):
    rows = _rows(spark, [("a", None, "x"), ("a", "2024-01-01 10:00:00", "y"), (None, "2024-01-01 10:00:00", "z"), ("", None, "e")])
    _insert(rows.limit(0), target)
    _insert(rows, target)
    assert _stored(spark, target) == [("", "e"), ("a", "y")]  # an empty key is a key; a dated row before an undated one
    SK.insert_unique(rows, target + "2", "link", hashed_key=True)
    SK.insert_unique(rows, target + "2", "link", hashed_key=True)
    assert SK.read_store(spark, target + "2").count() == 2


def test_a_failed_compaction_of_a_part_loses_nothing(spark, target, monkeypatch):
    for k in range(3):
        _insert(_rows(spark, [(f"l{k}{i}", "2024-01-02 10:00:00", "v") for i in range(4)]), target)
    want = _stored(spark, target)
    calls = []

    def failing(s, path):
        calls.append(path)
        if len(calls) == 3:  # the folder of the last attempt, one old file, and then the failure
            raise Broken()
        remove(s, path)

    monkeypatch.setattr(SK, "remove", failing)
    with pytest.raises(Broken):
        SK.compact(spark, target, "2024-01-02")
    monkeypatch.undo()
    assert set(_stored(spark, target)) == set(want)
    SK.finish_compaction(spark, target)
    assert _stored(spark, target) == want
    assert len([f for f in os.listdir(target + "/part=2024-01-02") if f.endswith(".parquet")]) == 1
    # a failure before the note: the copy is dropped, the part stays as it was
    remove(spark, f"{target}/_compact")
    spark.read.parquet(f"{target}/part=2024-01-02").write.parquet(f"{target}/_compact/2024-01-02/files")
    SK.finish_compaction(spark, target)
    assert _stored(spark, target) == want


def test_small_files_appear_whole(spark, target):
    write_text(spark, target + "/x/note", "içerik")
    write_text(spark, target + "/x/note", "yeni")
    assert read_text(spark, target + "/x/note") == "yeni" and [n for n, _ in list_names(spark, target + "/x")] == ["note"]
    assert list_names(spark, target + "/none") == []
