"""Structured Streaming cleaner: decode → clean → sentiment → one idempotent
``foreachBatch`` that feeds every sink (S2-S6, T1-T7).

One query reads the source once: the batch is persisted inside
``foreachBatch`` and written to the store (skip-duplicates insert) and,
optionally, to a debug sink, so both see the same rows and timestamps.
Records whose value does not decode go to a quarantine table with the raw
text.  Errors are raised, so the checkpoint does not advance past a batch
that was not written; a retried batch inserts nothing twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import lexicons as L
from .. import schemas
from ..functions import jsonio as JS
from ..operators import sinks as SK
from ..session import CACHE_BATCH_ROWS, write_text
from ..sources import complaints as CP


def read_json_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File source of JSON lines, read as text so decoding follows :func:`decode_json`."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def _decoded(raw: DataFrame) -> DataFrame:
    d = JS.decode_frame(raw, "value", schemas.STREAM_INPUT, keep_raw=True)
    return d.withColumn("decoded", F.col("company").isNotNull() | F.col("content").isNotNull()
                        | F.col("link").isNotNull() | F.col("date").isNotNull())


def process(raw: DataFrame, lexicon: L.Lexicon = L.REFERENCE, keep_arrays: bool = True) -> DataFrame:
    """Decode the queue value and enrich: the stream output schema plus ``raw_value`` / ``decoded``."""
    out = CP.enrich(_decoded(raw), lexicon, content="content", keep_arrays=keep_arrays, stamp=True)
    return out.withColumn("crawled_at", F.timestamp_seconds("crawl_timestamp"))


def records(raw: DataFrame) -> DataFrame:
    """Decode the queue value and stamp it, without the columns that follow from the text: for a pipeline with a
    ``lexicon``, which makes them when it writes a row, so that copies of a row are dropped while rows are short."""
    return _decoded(raw).withColumns({"processed_at": F.current_timestamp(),
                                      "crawled_at": F.timestamp_seconds("crawl_timestamp")})


def dedup_stream(df: DataFrame, key: str = "link", event_time: str = "crawled_at", delay: str = "1 hour") -> DataFrame:
    """Optional in-stream de-duplication within a watermark (T6); exact dedup stays in the sink."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


STORE_COLUMNS = ["company", "date", "link", "content", "cleaned", "tokens", "filtered_tokens", "sentiment",
                 "processed_at", "crawled_at"]


def idempotent_batch(target: str, key: str = "link", quarantine: str | None = None,
                     extra_sinks: list[Callable[[DataFrame, int], None]] | None = None,
                     hashed_key: bool = False, on_error: str = "raise",
                     lexicon: L.Lexicon | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: quarantine, skip-duplicates insert, extra sinks.

    Every row of a batch ends in the store, is a duplicate of a stored row, or
    is in the quarantine: records that do not decode and records without a key
    go there with their raw text (``<target>_quarantine`` by default).  The
    quarantine of a batch is its own folder and is overwritten on a retry.

    ``on_error="raise"`` (default) fails the query so the checkpoint does not
    advance and the batch is retried; ``"skip"`` puts the whole batch into the
    quarantine and lets the stream go on (S5).

    ``lexicon``: the batch has the rows of :func:`records`; new ones are enriched on their way to the sinks.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be 'raise' or 'skip'")
    rejects = quarantine or target.rstrip("/") + "_quarantine"

    def put_aside(rows: DataFrame, batch_id: int, reason: str) -> None:
        rows.select("raw_value", F.lit(reason).alias("reason")).write.mode("overwrite").parquet(
            f"{rejects}/batch_id={batch_id}")

    def finish(rows: DataFrame) -> DataFrame:
        out = CP.enrich(rows, lexicon, content="content", keep_arrays=True) if lexicon else rows
        first = [c for c in STORE_COLUMNS if c in out.columns]
        return out.select(*first, *[c for c in out.columns if c not in first])

    def write(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        key_ = "spark.sql.inMemoryColumnarStorage.batchSize"
        if int(conf.get(key_, "10000")) > CACHE_BATCH_ROWS:
            # a batch of long texts with token arrays: small cached column batches
            conf.set(key_, str(CACHE_BATCH_ROWS))
        usable = F.col("decoded") & F.col(key).isNotNull()
        kept = batch
        if on_error == "raise":  # only rows that may be put aside need their raw text
            kept = batch.withColumn("raw_value", F.when(usable, F.lit(None)).otherwise(F.col("raw_value")))
        b = kept.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bad = b.filter(~usable)
            if not bad.isEmpty():  # no empty files per micro-batch in the quarantine table
                put_aside(bad, batch_id, "no record or no key")
            good = b.filter(usable).select(*[c for c in STORE_COLUMNS if c in b.columns])
            SK.insert_unique(good, target, key, order_col="crawled_at", hashed_key=hashed_key,
                             part=SK.day_part("crawled_at"), finish=finish)
            for sink in extra_sinks or []:
                sink(finish(good), batch_id)
        except Exception as e:  # noqa: BLE001
            if on_error == "raise":
                raise
            put_aside(b, batch_id, f"batch failed: {type(e).__name__}")
        finally:
            b.unpersist()

    return write


def start_pipeline(stream: DataFrame, target: str, checkpoint: str, key: str = "link",
                   quarantine: str | None = None, trigger: dict | None = None,
                   extra_sinks: list[Callable[[DataFrame, int], None]] | None = None,
                   query_name: str | None = None, on_error: str = "raise", lexicon: L.Lexicon | None = None):
    """Start the single streaming query in append mode."""
    w = (stream.writeStream.outputMode("append")
         .foreachBatch(idempotent_batch(target, key, quarantine, extra_sinks, on_error=on_error, lexicon=lexicon))
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "30 seconds"}))
    return w.start()


def debug_sink(df: DataFrame, cols=("company", "sentiment", "cleaned"), fmt: str = "console", name: str = "debug"):
    """A separate console (or memory) sink of three columns (S6), mainly for tests."""
    w = df.select(*cols).writeStream.outputMode("append").format(fmt)
    if fmt == "memory":
        w = w.queryName(name)
    else:
        w = w.option("truncate", "true")
    return w.start()


def await_all(spark: SparkSession, timeout: float | None = None):
    """Block until any streaming query ends (T5)."""
    return spark.streams.awaitAnyTermination(timeout)


def throughput(query) -> float:
    """Rows per second over the query's recent micro-batches (A15, streaming)."""
    rates = [p.get("processedRowsPerSecond") or 0.0 for p in (query.recentProgress or [])]
    rates = [r for r in rates if r]
    return sum(rates) / len(rates) if rates else 0.0


PROGRESS = ("query string, run string, batch_id long, at string, rows_in long, seconds double, rows_per_second double")


class ProgressLog(StreamingQueryListener):
    """One small JSON file per micro-batch below ``path`` (A15): a table of what every query read and how fast.

    A batch that is run again overwrites its file.  Use :func:`log_progress` to add it to a session."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        took = (p.durationMs or {}).get("triggerExecution", 0) / 1000.0
        row = {"query": str(p.id), "run": str(p.runId), "batch_id": p.batchId, "at": p.timestamp, "rows_in": p.numInputRows,
               "seconds": took, "rows_per_second": p.numInputRows / took if took else 0.0}
        write_text(self.spark, f"{self.path}/{p.id}-{p.batchId}.json", json.dumps(row) + "\n")

    def onQueryTerminated(self, event) -> None:
        pass


def log_progress(spark: SparkSession, path: str) -> ProgressLog:
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    return log


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The progress table: query, run, batch_id, at, rows_in, seconds, rows_per_second."""
    return spark.read.schema(PROGRESS).option("pathGlobFilter", "*.json").json(path)


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m gripe.streaming.pipeline --store ... --checkpoint ... (--kafka host:port --topic t | --files dir)``"""
    import argparse

    from ..session import get_spark
    from ..sources.kafka import read_complaint_stream

    p = argparse.ArgumentParser(description="streaming complaint cleaner")
    p.add_argument("--store", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--quarantine")
    p.add_argument("--kafka")
    p.add_argument("--topic", default="complaints")
    p.add_argument("--files")
    p.add_argument("--lexicon", default="reference")
    p.add_argument("--available-now", action="store_true")
    a = p.parse_args(argv)
    spark = get_spark("gripe-stream")
    lex = L.profile(a.lexicon) if a.lexicon in L.PROFILES else L.Lexicon.load(a.lexicon)
    raw = read_complaint_stream(spark, a.kafka, a.topic) if a.kafka else read_json_files(spark, a.files)
    trigger = {"availableNow": True} if a.available_now else None
    q = start_pipeline(records(raw), a.store, a.checkpoint, quarantine=a.quarantine, trigger=trigger, lexicon=lex)
    q.awaitTermination()


if __name__ == "__main__":
    main()
