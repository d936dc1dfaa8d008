"""Text de-duplication and counts.

Keeper rule: among rows with equal cleaned text the smallest ``order_col``
wins (the original kept "first in store order", which is undefined).

Plan: one pass.  A 256-bit content key (SHA-256) is computed per row and
the row is grouped by it, keeping ``min(struct(order_col, ...))``.  The
partial (map-side) aggregate keeps one row per key per task, so even a text
repeated in a third of all rows is collapsed before the shuffle; the
shuffle then moves each distinct text once per task, keyed by 32 bytes
instead of the whole text.  The struct buffer makes this a sort-based
aggregate, which spills rather than failing on a large partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_key(c: "Column | str") -> Column:
    """SHA-256 of the text as 32 bytes (null stays null)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.unhex(F.sha2(col, 256))


def dedup_text(df: DataFrame, col: str = "cleaned", order_col: "str | list[str]" = "doc_id",
               carry: "list[str] | None" = None) -> DataFrame:
    """Null texts dropped (P3; the empty string stays), then one row per distinct text: the smallest ``order_col`` (A1).

    ``order_col`` may be a list (e.g. ``["crawled_at", "link"]``: earliest
    crawl, then smallest link); the remaining columns break any tie.
    ``carry`` names the columns to return (default all): only they travel
    through the shuffle, so a count per company does not move the texts.

    One pass: rows are grouped by the 32-byte content key and the row with
    the smallest ``order_col`` is kept as ``min(struct(order_col, ...))``.
    The partial (map-side) aggregate keeps one row per key per task, so a
    text repeated in a third of all rows is collapsed before the shuffle.
    The null-text group is removed after the aggregate through a flag in the
    kept row: a filter on the key would be pushed into the scan and evaluate
    the cleaning expression a second time.
    """
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    out = df.columns if carry is None else carry
    others = [c for c in out if c not in order]
    k = df.select(content_key(col).alias("_k"), F.struct(*order, *others, F.col(col).isNull().alias("_null")).alias("_r"))
    best = k.groupBy("_k").agg(F.min("_r").alias("_r"))
    return best.filter("NOT _r._null").select(*[F.col(f"_r.{c}").alias(c) for c in out])


def row_counts(df: DataFrame, distinct_col: str = "cleaned") -> DataFrame:
    """Total rows and distinct non-null texts in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct(content_key(distinct_col)).alias("n_distinct"))
