"""Shard files: whole results, bounds that hold, and files that are pruned."""

import random

import pytest

from gripe.llm import shard_files as SF


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    out = [(rnd.choice([None, i, i // 3]), rnd.choice([None, "", "x" * rnd.randint(0, 300), "copy"]),
            rnd.choice(["a", "a", "a", "b", "c", "d", None]), rnd.choice(["en", "tr", "de", None]), i % 5) for i in range(600)]
    return out + [(7, "é" * 20_000, "d", "tr", 0)]


COLUMNS = "doc_id long, text string, source string, lang string, Run int"


def test_written_shards_hold_every_row_once(spark, rows, tmp_path):
    docs, path = spark.createDataFrame(rows, COLUMNS), str(tmp_path / "s")
    bounds = SF.write_shards(docs, path, shards=5, rows_per_file=20)
    files, (shard, run) = SF._files(spark, path)
    assert (shard, run) == ("shard", "_run") and files.columns == [*docs.columns, shard, run]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(files.drop(shard, run).collect(), key=key) == sorted(docs.collect(), key=key)
    for s in range(5):
        assert abs(SF.read_shard(spark, path, s).count() - len(rows) / 5) < 1
    got = {}
    for r in files.collect():
        got.setdefault((r.shard, r._run), []).append(r)
    stored = list((tmp_path / "s" / "rows").rglob("*.parquet"))
    assert len(stored) == len(got) == bounds.count()
    for b in bounds.collect():
        group = got[b.shard, b._run]
        sizes = [len((r.text or "").encode()) + 1 for r in group]
        assert (b.n_rows, b.size_min, b.size_max) == (len(group), min(sizes), max(sizes)) and b.n_rows <= 20
        for d in ("source", "lang"):
            values = [r[d] for r in group if r[d] is not None]
            assert (b[f"{d}_min"], b[f"{d}_max"], b[f"{d}_nulls"]) == (
                min(values, default=None), max(values, default=None), len(group) - len(values))


def test_ranges_read_few_files(spark, rows, tmp_path):
    docs, path = spark.createDataFrame(rows, COLUMNS), str(tmp_path / "s")
    bounds = SF.write_shards(docs, path, rows_per_file=10)
    for dim, low, high in (("source", "c", "c"), ("lang", "tr", "zz"), ("source", "x", "z")):
        got = SF.read_range(spark, path, dim, low, high)
        assert got.columns == docs.columns and got.count() == docs.filter(f"{dim} BETWEEN '{low}' AND '{high}'").count()
        assert "dynamicpruning" in got._jdf.queryExecution().toString()
        touched = bounds.filter(f"{dim}_min <= '{high}' AND {dim}_max >= '{low}'").count()
        assert touched <= bounds.count() * 0.6


def test_empty_table(spark, tmp_path):
    docs, path = spark.createDataFrame([], COLUMNS), str(tmp_path / "s")
    assert SF.write_shards(docs, path).count() == 0
    assert SF._files(spark, path)[0].count() == 0 == SF.read_range(spark, path, "lang", "a", "z").count()
