"""Batch sources and sinks of complaint records (S7-S9, S12, P12, M1+M2 enrichment)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import lexicons as L
from .. import schemas
from ..functions import sentiment as S
from ..functions import text as TX
from ..session import read_table


def documents_as_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map the ``documents`` table onto the complaint record model.

    company := source, content := text, link := doc_id as text, date := null.
    Only the four needed columns are read (column pruning reaches the scan).
    """
    d = read_table(spark, f"{sf_dir}/documents.parquet", "doc_id", "source", "text")
    return d.select(
        F.col("doc_id"),
        F.col("source").alias("company"),
        F.lit(None).cast("string").alias("date"),
        F.col("doc_id").cast("string").alias("link"),
        F.col("text").alias("content"),
    )


def conversations_as_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second, short-text corpus: one record per (conversation, turn), company := role."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"),
        F.col("role").alias("company"),
        F.lit(None).cast("string").alias("date"),
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("link"),
        F.col("text").alias("content"),
    )


def enrich(df: DataFrame, lexicon: L.Lexicon = L.REFERENCE, content: str = "content",
           turkish_case: bool = False, keep_arrays: bool = False,
           stamp: bool = False) -> DataFrame:
    """Stream-cleaner enrichment as one projection: cleaned text (+ arrays) and sentiment.

    ``cleaned`` is the stop-word-free text the analysis jobs read; the
    sentiment is computed on it, as in the original cleaner.
    """
    cols: list[Column] = [F.col(c) for c in df.columns]
    if keep_arrays:
        # the token array feeds three outputs: build it once in its own projection
        words = df.select(*cols, TX.letter_tokens(TX.fold_case(F.col(content), turkish_case)).alias("tokens"))
        words = words.withColumn("filtered_tokens", TX.remove_stop("tokens", lexicon.stream_stop, lowered=True))
        out = words.withColumn("cleaned", TX.join_tokens("filtered_tokens"))
    else:
        out = df.select(*cols, TX.clean_text(F.col(content), lexicon.stream_stop, turkish_case).alias("cleaned"))
    out = S.with_sentiment(out, "cleaned", lexicon, lowered=True)
    if stamp:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def load_complaints(spark: SparkSession, path: str, fmt: str = "parquet",
                    schema: T.StructType = schemas.STORE, since: str | None = None) -> DataFrame | None:
    """Scan of the complaint store with the declared columns, no others (S7); ``None`` when it is empty.

    ``since`` (``yyyy-MM-dd``) reads the parts of that crawl day and later, and the undated one: the periodic job
    does not open older days."""
    read = spark.read.format(fmt)
    if since:
        days = read.schema(T.StructType([*schema.fields, T.StructField("part", T.StringType())])).load(path)
        df = days.filter(F.col("part") >= since).drop("part")  # "undated" sorts after every day
    else:
        df = read.schema(schema).option("recursiveFileLookup", "true").load(path)
    return None if df.isEmpty() else df


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """JSONL crawl history, bad lines dropped, ``link`` required."""
    return (spark.read.schema(schemas.CRAWL_RECORD).option("mode", "DROPMALFORMED")
            .json(path).filter(F.col("link").isNotNull()))


def append_history(df: DataFrame, path: str) -> None:
    """Append records as UTF-8 JSON lines."""
    df.select([f.name for f in schemas.CRAWL_RECORD.fields]).write.mode("append").json(path)


#: Backslashes, line breaks, carriage returns and NULs of a text are written as a backslash and a
#: letter of their own, so a record is one line, CSV files can be split, and a backslash in a file always
#: begins such a pair: the pairs are read back one kind after the other, the backslash's last.
_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\0"))
_CSV = {"header": True, "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": ""}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV dataset with a header row."""
    def one_line(c: Column) -> Column:
        for plain, pair in _ESCAPES:
            c = F.replace(c, F.lit(plain), F.lit(pair))
        return c

    cols = [f.name for f in schemas.COMPLAINT_CSV.fields]
    df.select(*[one_line(F.col(c)).alias(c) for c in cols]).write.options(
        **_CSV, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_csv(spark: SparkSession, path: str, escaped: bool = True) -> DataFrame:
    """CSV dataset with a header row and the declared schema.

    ``escaped=False`` reads files of other writers whose quoted fields span
    lines (such files cannot be split)."""
    df = spark.read.options(**_CSV, multiLine=not escaped).schema(schemas.COMPLAINT_CSV).csv(path)
    if not escaped:
        return df

    def text(c: str) -> Column:
        out = F.col(c)
        for plain, pair in reversed(_ESCAPES):
            out = F.replace(out, F.lit(pair), F.lit(plain))
        return out

    return df.select(*[text(c).alias(c) for c in df.columns])


def make_record(df: DataFrame, company: "Column | str", date: "Column | str",
                link: "Column | str", content: "Column | str", now: "Column | None" = None) -> DataFrame:
    """Record constructor with the crawl time (default: the current time) in epoch seconds."""
    at = now if now is not None else F.current_timestamp()
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return df.select(c(company).alias("company"), c(date).alias("date"), c(link).alias("link"),
                     c(content).alias("content"),
                     (F.unix_micros(at) / F.lit(1e6)).alias("crawl_timestamp"))
