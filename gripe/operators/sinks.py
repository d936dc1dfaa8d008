"""Idempotent "skip duplicates" inserts and report sinks.

The store is a Parquet table in parts: a crawl day of a streamed record, or a
hash bucket of the key for batch inserts without a time.

:func:`insert_unique` keeps a key unique in the whole store.  A key index beside
the store (:mod:`key_index`) says which keys are there, so no part of the store is
read, whatever day a record was crawled on before.  The order of an insert is:
keys to the index (not visible yet), rows to the store, marker to the index.  A
failure in between is settled by the next insert, so a retried batch inserts
nothing twice and loses nothing.

:func:`upsert_new` keeps a key unique in its part only and needs no index: it reads the
keys of the parts its rows fall into and of no others.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import list_names, move, path_exists, read_text, remove, write_text
from .dedup import content_key
from .key_index import KeyIndex

PART = "part"
BUCKETS = 64


def key_column(df: DataFrame, key: "str | Column", hashed: bool = False) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return content_key(c) if hashed else c


def day_part(time: "str | Column") -> Column:
    """Part of a record by the day of its (crawl) time."""
    t = F.col(time) if isinstance(time, str) else time
    return F.coalesce(F.date_format(t, "yyyy-MM-dd"), F.lit("undated"))


def first_per_key(df: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """One row per ``key``: the smallest ``order_col``, a null after every value, ties by the other columns.

    A partial aggregate per task, so a key with many copies is collapsed before the shuffle."""
    rest = [c for c in df.columns if c not in (key, order_col)]
    order = [F.col(order_col).isNull().alias("_none"), F.col(order_col)] if order_col else []
    best = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return best.select(*[F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns])


def upsert_new(batch: DataFrame, target: str, key: str, order_col: str | None = None, hashed_key: bool = False,
               part: Column | None = None, buckets: int = BUCKETS, cache: bool = True) -> None:
    """Append the rows of ``batch`` whose key is not yet in their part of ``target``.

    ``hashed_key`` stores SHA-256 of the key (for long text keys).  Within the
    batch the smallest ``order_col`` stays per key.  Rows without a key have no
    place in a store with unique keys: the caller deals with them first (the
    stream quarantines them).  ``cache=False`` when the caller already keeps
    ``batch`` (``foreachBatch``).  The write is one Spark job with an atomic commit.
    """
    spark = batch.sparkSession
    b = batch.withColumn("_key", key_column(batch, key, hashed_key)).filter(F.col("_key").isNotNull())
    place = part if part is not None else F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("string")
    b = first_per_key(b.withColumn(PART, place), "_key", order_col)
    # the batch is read up to three times below; keep it (recomputed from lineage if an executor is lost)
    b = b.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = b
        # days or buckets of one batch: a bounded collect
        touched = [f"{target}/{PART}={r[0]}" for r in b.select(PART).distinct().collect()]
        there = [p for p in touched if path_exists(spark, p)]
        if there:
            kind = b.schema["_key"].dataType.simpleString()
            stored = (spark.read.schema(f"_key {kind}, {PART} string").option("basePath", target).parquet(*there)
                      .join(b.select(PART, "_key"), on=[PART, "_key"], how="left_semi"))
            out = b.join(stored, on=[PART, "_key"], how="left_anti")
        # rebalance by part: AQE merges small and splits large partitions, so a
        # micro-batch writes few files per part and a bulk load still spreads out
        out.hint("rebalance", PART).write.mode("append").partitionBy(PART).parquet(target)
    finally:
        b.unpersist()


def store_index(spark, target: str, **options) -> KeyIndex:
    return KeyIndex(spark, target.rstrip("/") + "_index", **options)


def _rows_in_store(spark, target: str, keys: DataFrame) -> DataFrame:
    """Those rows of ``keys`` (``_key``, ``part``) that the store has; reads the named parts only."""
    parts = [r["part"] for r in keys.select("part").distinct().collect()]  # the parts of one insert
    there = [p for p in (f"{target}/{PART}={x}" for x in parts) if path_exists(spark, p)]
    if not there:
        return keys.limit(0)
    stored = (spark.read.schema(f"_key {keys.schema['_key'].dataType.simpleString()}, {PART} string")
              .option("basePath", target).parquet(*there))
    return keys.join(stored, ["_key", "part"], "left_semi")


def open_index(spark, target: str, key_type: str, **options) -> KeyIndex:
    """The store's key index, after what a failure left was settled; built from the store where there is none yet."""
    index = store_index(spark, target, **options)
    if index.exists():
        index.recover(lambda keys: _rows_in_store(spark, target, keys))
    elif list_names(spark, target):
        rows = spark.read.schema(f"_key {key_type}, {PART} string").option("basePath", target).parquet(target)
        run = index.add(rows.groupBy("_key").agg(F.min(PART).alias("part")))
        if run:
            index.commit(run)
    return index


def insert_unique(batch: DataFrame, target: str, key: str, order_col: str | None = None, hashed_key: bool = False,
                  part: Column | None = None, buckets: int = BUCKETS, run: str | None = None,
                  finish: Callable[[DataFrame], DataFrame] | None = None, **index_options) -> None:
    """Append the rows of ``batch`` whose key is nowhere in ``target``.

    Within the batch the smallest ``order_col`` stays per key; a key that is stored stays as it is, as with a
    unique index.  Rows without a key are the caller's business.  ``run`` names the insert in the index.  ``finish``
    adds columns to the rows that are written, after the shuffles; it must keep every row and column."""
    spark = batch.sparkSession
    b = batch.withColumn("_key", key_column(batch, key, hashed_key)).filter(F.col("_key").isNotNull())
    place = part if part is not None else F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("string")
    b = first_per_key(b.withColumn(PART, place), "_key", order_col).persist(StorageLevel.MEMORY_AND_DISK)
    index = open_index(spark, target, b.schema["_key"].dataType.simpleString(), **index_options)
    new = index.unseen(b).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        made = index.add(new.select("_key", F.col(PART).alias("part")), run)
        if made:
            out = new.hint("rebalance", PART)
            out = finish(out) if finish else out
            out.write.mode("append").option("compression", "zstd").partitionBy(PART).parquet(target)
            index.commit(made)
            index.compact()
    finally:
        new.unpersist()
        b.unpersist()


def compact(spark, target: str, part: str, files: int = 1) -> None:
    """Rewrite one part (a day that is over) into ``files`` files.

    The new files are written below the store first.  A note then names the old
    files; the new ones are moved in before the old ones go, one by one.  After a failure
    at any point the next call (or :func:`finish_compaction`) goes on from the note,
    so no row is lost; until then a reader may meet rows of that part twice."""
    finish_compaction(spark, target)
    here, work = f"{target}/{PART}={part}", f"{target}/_compact/{part}"
    old = [n for n, _ in list_names(spark, here) if not n.startswith(("_", "."))]
    remove(spark, work)
    spark.read.parquet(here).repartition(files).write.parquet(f"{work}/files")
    write_text(spark, f"{work}/note", json.dumps({"part": part, "old": old}))
    finish_compaction(spark, target)


def finish_compaction(spark, target: str) -> None:
    for name, _ in list_names(spark, f"{target}/_compact"):
        work = f"{target}/_compact/{name}"
        if path_exists(spark, f"{work}/note"):
            note = json.loads(read_text(spark, f"{work}/note"))
            here = f"{target}/{PART}={note['part']}"
            for n, _ in list_names(spark, f"{work}/files"):
                if not n.startswith(("_", ".")):
                    move(spark, f"{work}/files/{n}", f"{here}/{n}")
            for n in note["old"]:
                remove(spark, f"{here}/{n}")
        remove(spark, work)


def read_store(spark, target: str, key: str | None = None, order_col: str | None = None) -> DataFrame:
    """The store without its bookkeeping columns; with ``key``, one row per key over all parts."""
    df = spark.read.option("basePath", target).parquet(target)
    if key:
        df = first_per_key(df.drop(PART), "_key", order_col)
    return df.drop("_key", PART)


def write_report(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """One output per report section.

    The files of a section are few because AQE merges the small partitions of
    its last exchange (``rebalance``); no stage is forced into one task."""
    paths = {}
    for name, df in tables.items():
        p = os.path.join(out_dir, name)
        out = df if name == "scored" else df.hint("rebalance")
        if fmt == "csv":
            out = out.select(*[c for c, t in out.dtypes if not t.startswith(("array", "struct", "map"))])
        out.write.mode("overwrite").format(fmt).option("header", True).save(p)
        paths[name] = p
    return paths
