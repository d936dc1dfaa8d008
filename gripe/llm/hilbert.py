"""Sharding along a Hilbert curve over quantised metadata.

Native DataFrame operations only.  Each metadata dimension is quantised to
2^bits codes of near-equal row counts that keep the order of its values, the
codes give a cell on the Hilbert curve, and the rows in curve order are cut
into runs.  Neighbours on the curve are neighbours in every dimension, so each
shard covers a compact box and files can be pruned on any of the columns.

No global sort: rows are counted per cell, prefix sums over the (at most
4,096) cells give each cell its first rank, and rows are numbered inside
(cell, id-hash bucket), so a cell that holds a third of all rows is split.

Law ``rows``: the shards' row counts differ by at most one.

Defined cases: null text has no bytes (size 1); null metadata is a value of
its own, last; rows equal in every column are interchangeable; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import null_key, stage_table, text_or_empty

BITS = 4
ROWS_PER_BUCKET = 500_000


def curve_index(point: tuple[int, ...], bits: int) -> int:
    """Distance along the Hilbert curve (Skilling 2004: undo the excess work, Gray-encode, interleave)."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    d = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            d = (d << 1) | ((v >> b) & 1)
    return d


def _grid(dims: int, bits: int) -> list[int]:
    side = 1 << bits
    cells = [()]
    for _ in range(dims):
        cells = [c + (v,) for c in cells for v in range(side)]
    return [curve_index(c, bits) for c in cells]


def _codes(rows: DataFrame, dim: str, n: int, bits: int) -> DataFrame:
    """``dim, <dim>_code``: equal-depth codes in value order.  The window runs over one row per distinct value."""
    ahead = Window.orderBy(dim).rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy(dim).agg(F.count(F.lit(1)).alias("c"))
    code = F.floor(F.coalesce(F.sum("c").over(ahead), F.lit(0)) * (1 << bits) / n).cast("int")
    return per.select(dim, code.alias(f"{dim}_code"))


def size_class(size: Column) -> Column:
    """Bits of the size as two digits, so that the text order is the size order."""
    return F.lpad(F.length(F.bin(size)).cast("string"), 2, "0")


def hilbert_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   dims: tuple = ("source", "lang"), bits: int = BITS,
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, cell`` for every row.

    The dimensions are the columns ``dims`` and the size class of the text."""
    t = text_or_empty(text_col)
    size = (F.octet_length(t) + 1).cast("long")
    names = [f"k{i}" for i in range(len(dims) + 1)]
    rows = stage_table(docs.select(
        F.col(id_col).alias("doc_id"), size.alias("size"), F.crc32(t).alias("text_crc32"),
        *[null_key(F.col(c)).alias(k) for c, k in zip(dims, names)], size_class(size).alias(names[-1])), "shard-rows")
    n = rows.count()
    coded = rows
    for k in names:
        coded = coded.join(_codes(rows, k, max(n, 1), bits), k)
    at = F.lit(0)
    for k in names:
        at = at * (1 << bits) + F.col(f"{k}_code")
    grid = F.array(*[F.lit(v) for v in _grid(len(names), bits)])
    buckets = max(8, -(-n // rows_per_bucket))
    h = F.xxhash64("doc_id")
    coded = stage_table(coded.select(
        "doc_id", "size", "text_crc32", F.element_at(grid, (at + 1).cast("int")).alias("cell"),
        F.pmod(h, F.lit(buckets)).cast("int").alias("bucket")), "shard-cells")

    per = coded.groupBy("cell", "bucket").agg(F.count(F.lit(1)).alias("c"))
    cells = per.groupBy("cell").agg(F.sum("c").alias("c"))
    first = cells.select("cell", F.coalesce(F.sum("c").over(
        Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inner = per.select("cell", "bucket", F.coalesce(F.sum("c").over(
        Window.partitionBy("cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    start = inner.join(first, "cell").select("cell", "bucket", (F.col("first") + F.col("ahead")).alias("start"))
    own = F.row_number().over(Window.partitionBy("cell", "bucket").orderBy("doc_id", "text_crc32", "size")) - 1
    ranked = coded.withColumn("own", own).join(start, ["cell", "bucket"]).withColumn("rank", F.col("start") + F.col("own"))
    # shard s holds the ranks from ceil(s n / shards); counts differ by one at most
    shard = F.expr(f"(rank * {shards}) div {max(n, 1)}")
    lowest = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return (ranked.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - lowest).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "cell"))
