"""Exact dedup: 128-bit content hash, smallest id stays, bytes compared inside the groups.

Native DataFrame operations only.  One aggregation groups by (hash, text): the
text is part of the grouping key, so two texts that share a hash are compared
byte by byte and stay apart.  Its map-side part collapses a text that a third
of all rows share to one row per task before anything is shuffled.  The rows
then find their group by the 16-byte hash alone; only hashes that really hold
more than one text are matched by (hash, text).

Defined cases: a null text counts as empty; a null id sorts after every other
id; of rows with the same id and the same text exactly one is kept; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stage_table, text_or_empty

#: Equal to replacing each ``[\x20\x09-\x0D]+`` by one space, but a lone space is left alone.
_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalise(text: str | Column) -> Column:
    """White-space runs become one space; null becomes the empty text."""
    return F.regexp_replace(text_or_empty(text), _RUN, " ")


def content_hash(text: Column) -> Column:
    """128 bits as 16 bytes."""
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``hash_fn`` exists so that tests can force collisions."""
    t = docs.select(F.col(id_col).alias("doc_id"), normalise(text_col).alias("norm"))
    t = t.select("doc_id", "norm", hash_fn(F.col("norm")).alias("h"))
    by_text = (t.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .select("h", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"))
    groups = stage_table(by_text, "exact-groups")
    collided = groups.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h")

    # equal rows (same id, same hash) collapse before the shuffle and are dealt out again below
    ids = t.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("m"))
    if collided.isEmpty():
        rows = ids.join(groups, "h")
    else:
        # t's aggregation above kept such texts apart; match their rows by the text itself
        both = t.join(F.broadcast(collided) if collided.count() < 10_000 else collided, "h", "left_semi")
        own = both.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        rows = (both.groupBy("doc_id", "h", "norm").agg(F.count(F.lit(1)).alias("m")).join(own, ["h", "norm"])
                .withColumn("text_sha256", F.sha2("norm", 256)).drop("norm")
                .unionByName(ids.join(collided, "h", "left_anti").join(groups, "h")))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("copy")
    return rows.select("doc_id", "keep_id", "group_size", "text_sha256", copy).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


#: So many (id, hash) pairs of dropped rows are sent to every executor, about 15 MB; more of them are joined by a shuffle.
MAX_SENT = 200_000


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are matched to the decision by id and text hash: those go whose id is not the one that stays.  While the
    dropped ones are few, no text is shuffled for it.  Only when an id really repeats with the same text are those rows
    reduced to one."""
    sha, lost_id, lost_sha, m = fresh(docs, "sha", "lost_id", "lost_sha", "m")
    lost = (exact_dedup(docs, id_col, text_col).filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .select(F.col("doc_id").alias(lost_id), F.unhex("text_sha256").alias(lost_sha)))
    lost = stage_table(lost.distinct(), "exact-lost")
    if lost.count() <= MAX_SENT:
        lost = F.broadcast(lost)
    rows = docs.withColumn(sha, F.unhex(F.sha2(normalise(text_col), 256)))
    kept = rows.join(lost, F.col(id_col).eqNullSafe(F.col(lost_id)) & (F.col(sha) == F.col(lost_sha)), "left_anti")
    repeats = rows.groupBy(id_col, sha).agg(F.count(F.lit(1)).alias(m)).filter(F.col(m) > 1)
    if not repeats.isEmpty():
        kept = kept.dropDuplicates([id_col, sha])
    return kept.drop(sha)


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
