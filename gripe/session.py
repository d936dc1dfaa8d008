"""Spark session defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # text rows carry long strings and token arrays: build cached column batches
    # of 1,000 rows (default 10,000) so a cached batch fits in a task's memory
    "spark.sql.inMemoryColumnarStorage.batchSize": "1000",
}

CACHE_BATCH_ROWS = 1000


def get_spark(app: str = "gripe", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, shuffle_partition_bytes: int = 1 << 30, split_bytes: int = 128 << 20,
                 min_partitions: int = 200) -> dict:
    """Shuffle and split sizing for a cluster run over ``input_bytes`` of input.

    The full-corpus shuffles (dedup, term counts) move about as much data as
    is read, so the initial shuffle partition count is sized for about
    ``shuffle_partition_bytes`` each (spill-safe, and few enough for the
    map-output bookkeeping of very wide shuffles); AQE then coalesces small
    partitions toward the advisory size and splits skewed ones.  Example:
    100 TB → about 93,000 initial shuffle partitions and 128 MB scan splits.
    """
    parts = max(min_partitions, -(-int(input_bytes) // shuffle_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{max(split_bytes, 256 << 20) >> 20}m",
        "spark.sql.files.maxPartitionBytes": f"{split_bytes >> 20}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.inMemoryColumnarStorage.batchSize": str(CACHE_BATCH_ROWS),
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (file-system metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def read_table(spark: SparkSession, path: str, *cols: str):
    """A Parquet table; a small one is dealt out over the cores.

    A table of less than one split per core (judged by its size on disk) may be
    one row group, and the CPU-heavy text work on it would run in one task.
    Larger tables have splits enough and are read as they are."""
    df = spark.read.parquet(path)
    if cols:
        df = df.select(*cols)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes", "134217728b")
    cores = spark.sparkContext.defaultParallelism
    size = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split))
    return df.repartition(cores) if input_bytes(spark, path) < cores * size else df


def size_session(spark: SparkSession, path: str) -> dict:
    """Apply :func:`cluster_conf` for the input at ``path`` to a running session (SQL settings only)."""
    conf = cluster_conf(input_bytes(spark, path))
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


_SHIPPED: set[str] = set()  # applications whose Python workers know this package


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (Spark's file server hands it out), once per application.

    Rows with whole documents travel in Arrow batches of 1,000 (Spark's
    default is 10,000), unless the session says otherwise, so that a batch of
    long texts fits beside others in an executor."""
    sc = spark.sparkContext
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":
        spark.conf.set(ARROW_ROWS, "1000")
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="gripe-"), "gripe_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system (any that Spark reads) has ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only a local master may do without (tests): a
    folder under the system temp dir is then created and registered.  On a
    cluster a machine-local folder would lose data, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="gripe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint root (for written tables)."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str, compression: str = "snappy"):
    """Write to a fresh table under the shared checkpoint folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Name and length of everything directly below a folder, sorted; nothing where the folder is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), int(s.getLen())) for s in fs.listStatus(p))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file (a marker or a manifest) that appears whole: written beside its place, then renamed."""
    fs, p = _fs(spark, path)
    _, beside = _fs(spark, path + ".new")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(beside, p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reads; nothing happens where it is missing."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, src: str, dst: str) -> None:
    fs, a = _fs(spark, src)
    _, b = _fs(spark, dst)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {src} to {dst}")
