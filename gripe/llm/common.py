"""Shared helpers: table access, scratch tables in the shared folder, Arrow text batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship

#: ASCII white space of the contracts: space and 0x09-0x0D.
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_path(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back; also the folder, for :func:`discard`.

    Cuts the lineage: a lost executor costs the re-read of a file, not a
    recomputation.  The folder is shared, so every executor can read it."""
    spark = df.sparkSession
    ship(spark)
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    return stage_path(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def null_key(c: Column) -> Column:
    """A non-null join key that keeps null apart from every string and keeps the byte order (null last)."""
    return F.when(c.isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), c.cast("string")))


def text_or_empty(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(""))


def utf8_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its rows (nulls: empty), without copying a row."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
        if isinstance(arr, pa.ChunkedArray):
            arr = pa.concat_arrays(arr.chunks)
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64 if wide else np.int32)
    offs = offs[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(arr.buffers()[2] or b"", dtype=np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]
