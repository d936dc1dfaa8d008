"""Declared schemas of every stage (no inference anywhere)."""

from pyspark.sql import types as T

# A crawled record: the JSON value on the queue and the line in the history log.
CRAWL_RECORD = T.StructType([
    T.StructField("company", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("crawl_timestamp", T.DoubleType()),
])

# What the stream cleaner decodes (crawl_timestamp kept so the stream can
# de-duplicate within a watermark; the original dropped it).
STREAM_INPUT = T.StructType([
    T.StructField("company", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("crawl_timestamp", T.DoubleType()),
])

# What the analysis reads of a stored complaint (after cleaning + sentiment).
STORE = T.StructType([
    T.StructField("company", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("cleaned", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("crawled_at", T.TimestampType()),
])

# CSV dataset of complaints (header row).
COMPLAINT_CSV = T.StructType([
    T.StructField("company", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("content", T.StringType()),
])
