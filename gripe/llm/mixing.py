"""Mixing sources to target weights by hash-threshold histograms.

The words of each source are summed per hash bucket; the prefix sums name the
one bucket in which the budget ends, only that bucket is summed again with
finer buckets, and so on until it holds one hash value.  The mix is then a
plain filter ``hash < threshold``: nothing is sorted, and what crosses the
network per level is at most 4,096 sums per source and task, however many rows
one source has.

Budgets are nested: a larger target of the same source takes a superset.

Defined cases: null text has size 0; a null source is a source of its own and
comes last; the hash is of id and text, so rows that share an id (or have none) are
dealt with one by one unless their texts are equal, too: those are taken or left together;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_RE, fresh, null_key, stage_table, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
HASH_BITS = 60
LEVEL_BITS = 12


def word_count(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_RE)).cast("long")


def row_hash(doc_id: str, text: str) -> Column:
    """60 bits of the md5 of the id and the text's md5."""
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"), F.md5(text_or_empty(text)))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, k, source_size, target``: one row per source.

    All words are shared by weight; a share above ``max_repeats`` times its
    source stops there and the excess is shared again.  In the order of
    ``cap / weight`` the sources that stop come first, so the final level is
    the largest of the levels ``(total - caps before) / (weights from here)``.
    The windows without partition run over one row per source."""
    s = sizes.groupBy("source", "k").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("k")) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights)).cast("int") + 1)
    s = s.withColumn("w", w).withColumn("cap", F.col("source_size") * float(max_repeats))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("w"), "k").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    s = s.withColumn("level", level)
    return s.withColumn("target", F.least("cap", F.col("w") * F.max("level").over(every))).drop("w", "cap", "level")


def _thresholds(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """``k, full, thr``: whole passes over the source, and the hash below which a document is taken once more."""
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = goal.withColumn("full", full).select(
        "k", "full", (F.col("target") - F.col("full") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    done = state.filter("budget <= 0").select("k", "full", F.lit(0).cast("long").alias("thr"))
    parts = [stage_table(done, "mix-thr")]
    state = stage_table(state.filter("budget > 0"), "mix-state")
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        if state.isEmpty():
            break
        inside = sizes.withColumn("prefix", F.shiftright("hash", shift + LEVEL_BITS))
        hist = (inside.join(state.select("k", "prefix"), ["k", "prefix"], "left_semi")
                .groupBy("k", F.shiftright("hash", shift).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("hash").alias("lo"), F.max("hash").alias("hi")))
        upto = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("ahead", F.coalesce(F.sum("words").over(upto), F.lit(0)))
        edge = (hist.join(state, "k").withColumn("below", F.col("below") + F.col("ahead"))
                .filter("below <= budget AND below + words > budget"))
        edge = stage_table(edge.select("k", "full", "budget", "bucket", "below", "words", "lo", "hi"), "mix-edge")
        last = (F.col("lo") == F.col("hi")) | F.lit(shift == 0)
        take = F.col("below") + F.col("words") - F.col("budget") < F.col("budget") - F.col("below")
        parts.append(edge.filter(last).select(
            "k", "full", F.when(take, F.col("hi") + 1).otherwise(F.col("lo")).alias("thr")))
        state = edge.filter(~last).select("k", "full", "budget", F.col("bucket").alias("prefix"), "below")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple,
                max_repeats: int) -> tuple[DataFrame, DataFrame]:
    """The sizes of all documents, and ``k, source_size, target, full, thr`` of every source (written tables)."""
    sizes = stage_table(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        null_key(F.col(source_col)).alias("k"), word_count(text_col).alias("size"), row_hash(id_col, text_col).alias("hash")),
        "mix-sizes")
    goal = stage_table(targets(sizes, weights, max_repeats), "mix-goal")
    return sizes, stage_table(goal.drop("source").join(_thresholds(sizes, goal), "k"), "mix-plan")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, repeats, taken``.

    ``repeats`` is how often the mix takes the document, ``taken`` = size * repeats."""
    sizes, per_source = source_plan(docs, id_col, text_col, source_col, weights, max_repeats)
    repeats = F.col("full") + (F.col("hash") < F.col("thr")).cast("long")
    return (sizes.join(per_source, "k").withColumn("repeats", repeats)
            .select("doc_id", "source", "size", "source_size", "target", "repeats",
                    (F.col("size") * F.col("repeats")).alias("taken")))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    The thresholds hold for a source's ids, so the rows are filtered in one scan
    against one row per source; no text is shuffled by document."""
    k, h, full, thr, n, copy = fresh(docs, "k", "hash", "full", "thr", "n", "copy")
    per_source = source_plan(docs, id_col, text_col, source_col, weights, max_repeats)[1]
    rows = docs.withColumn(k, null_key(F.col(source_col))).withColumn(h, row_hash(id_col, text_col))
    taken = rows.join(per_source.select(F.col("k").alias(k), F.col("full").alias(full), F.col("thr").alias(thr)), k)
    taken = taken.withColumn(n, F.col(full) + (F.col(h) < F.col(thr)).cast("long")).filter(F.col(n) > 0)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))).alias(copy)).select(*docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS hash
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
c AS (SELECT *, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, ((SELECT sum(source_size)::DOUBLE FROM c)
             - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / ((SELECT sum(w) FROM c)
             - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM c),
g AS (SELECT source, source_size, least(cap, w * (SELECT max(level) FROM l)) AS target FROM l),
p AS (
  SELECT d.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END::BIGINT AS fullp,
         sum(size) OVER (PARTITION BY d.source ORDER BY hash RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY d.source, hash) AS own
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (SELECT *, target - fullp * source_size AS budget FROM p)
SELECT doc_id, size, source_size, target,
       (size * (fullp + CASE WHEN budget > 0 AND (upto <= budget
                  OR (upto - own <= budget AND upto - budget < budget - (upto - own))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM q
"""
