"""JSON encode / decode of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def encode(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One JSON text per row in ``value`` (field order = column order)."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def decode_json(value: "Column | str", schema: T.StructType = schemas.STREAM_INPUT) -> Column:
    """Decode a JSON text with a fixed schema.

    Unknown fields are dropped; a malformed text, ``null`` or an array gives a
    struct of nulls (never a failure); a number in a string field gives its
    text, an object gives its JSON text.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v.cast("string"), schema, {"mode": "PERMISSIVE"})


def decode_frame(df: DataFrame, value: str = "value", schema: T.StructType = schemas.STREAM_INPUT,
                 keep_raw: bool = False) -> DataFrame:
    """``value`` bytes/text → one column per schema field (``data.*``)."""
    out = df.select(decode_json(value, schema).alias("data"), F.col(value).cast("string").alias("_raw"))
    sel = [F.col(f"data.{f.name}").alias(f.name) for f in schema.fields]
    if keep_raw:
        sel.append(F.col("_raw").alias("raw_value"))
    return out.select(*sel)
