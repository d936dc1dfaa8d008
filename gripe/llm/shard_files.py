"""Shards of :mod:`.hilbert` as Parquet files, with the bounds of every file for pruning.

``write_shards`` writes three tables below its folder: ``rows`` (all columns of
the input, one file per shard and run of ``rows_per_file`` rows in curve order),
``bounds`` (per file the row count, and per dimension and size the smallest and
largest value and the number of nulls) and ``schema`` (no rows).  ``read_range``
joins the bounds to the files, so Spark prunes files before it reads them.

Rows are placed under a number of their own, so neither null nor repeated ids
nor equal texts meet in one group.

Defined cases: null text has size 1, null metadata is counted in
``<dim>_nulls`` and in no bound; columns of the input that are called ``shard`` or
``run`` keep their names, and the folders' names get underscores in front; an
empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import discard, fresh, stage_path
from .hilbert import hilbert_shards

ROWS_PER_FILE = 1_000_000


def write_shards(docs: DataFrame, path: str, shards: int = 8, text_col: str = "text", dims: tuple = ("source", "lang"),
                 rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write the shards of ``docs`` to the new folder ``path``; the bounds of their files."""
    spark = docs.sparkSession
    shard, run, slot, key, size = fresh(docs, "shard", "run", "slot", "row_key", "row_size")
    rows, rows_at = stage_path(docs.withColumn(key, F.monotonically_increasing_id()), "shard-input")  # keys are fixed by writing
    placed, placed_at = stage_path(
        hilbert_shards(rows, shards, id_col=key, text_col=text_col, dims=dims).select(
            F.col("doc_id").alias(key), F.col("shard").alias(shard),
            F.floor(F.col("slot") / rows_per_file).cast("int").alias(run), F.col("slot").alias(slot),
            F.col("size").alias(size)), "shard-places")
    (rows.join(placed.drop(size), key).repartition(shard, run).sortWithinPartitions(shard, run, slot)
     .select(*docs.columns, shard, run).write.partitionBy(shard, run).parquet(f"{path}/rows"))
    docs.limit(0).write.parquet(f"{path}/schema")
    bounds = rows.select(key, *dict.fromkeys(dims)).join(placed, key).groupBy(shard, run).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(size).alias("size_min"), F.max(size).alias("size_max"),
        *[b for d in dims for b in (F.min(d).alias(f"{d}_min"), F.max(d).alias(f"{d}_max"),
                                    F.count_if(F.col(d).isNull()).alias(f"{d}_nulls"))])
    bounds.write.parquet(f"{path}/bounds")
    for done in (rows_at, placed_at):
        discard(spark, done)
    return read_bounds(spark, path)


def read_bounds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/bounds")


def _files(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    empty = spark.read.parquet(f"{path}/schema")
    names = fresh(empty, "shard", "run")
    schema = empty.schema
    for n in names:
        schema = schema.add(n, IntegerType())
    return spark.read.schema(schema).parquet(f"{path}/rows"), names


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """The rows of one shard; the others' folders are not listed for reading."""
    rows, (s, r) = _files(spark, path)
    return rows.filter(F.col(s) == shard).drop(s, r)


def read_range(spark: SparkSession, path: str, dim: str, low, high) -> DataFrame:
    """The rows with ``low <= dim <= high``, from the files whose bounds meet that range.

    The bounds are one row per file; Spark decides by their size whether they are broadcast, and with it whether files are
    pruned before the scan or by the join."""
    rows, names = _files(spark, path)
    meets: Column = (F.col(f"{dim}_min") <= F.lit(high)) & (F.col(f"{dim}_max") >= F.lit(low))
    kept = read_bounds(spark, path).filter(meets).select(*names)
    return rows.join(kept, names, "left_semi").filter(F.col(dim).between(F.lit(low), F.lit(high))).drop(*names)
