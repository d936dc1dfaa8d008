"""Queue source and sink.

Needs the ``spark-sql-kafka`` connector on the classpath of the cluster; the
functions only declare the reads and writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .complaints import append_history, read_history


def read_complaint_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                          max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the topic; ``value`` holds the JSON bytes."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select("value", "topic", "partition", "offset", "timestamp")


def publish(df: DataFrame, servers: str, topic: str, acks: str = "all", retries: int = 5,
            history: str | None = None, send=None) -> bool:
    """Write every row as a UTF-8 JSON value without key.

    With ``history`` the records are first appended to the JSONL history, so a
    broker that is down loses nothing: the failure is reported as False and
    :func:`replay` can resend them.  Without it the error is raised.  ``send``
    replaces the writer (tests)."""
    cols = [f.name for f in schemas.CRAWL_RECORD.fields if f.name in df.columns]
    if history:
        append_history(df, history)
    values = df.select(F.to_json(F.struct(*cols)).alias("value"))
    try:
        if send is not None:
            send(values)
        else:
            (values.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
             .option("kafka.acks", acks).option("kafka.retries", str(retries)).save())
    except Exception:  # noqa: BLE001
        if not history:
            raise
        return False
    return True


def replay(spark: SparkSession, history_path: str, servers: str, topic: str) -> DataFrame:
    """Resend the whole history log (S11); returns the seen-link set it implies."""
    h = read_history(spark, history_path)
    publish(h, servers, topic)
    return h.select("link").dropDuplicates(["link"])
