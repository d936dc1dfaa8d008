"""Summary tables behind the report and the charts.

Per-company tables drop a null company, as a pandas ``groupby`` /
``crosstab`` / ``value_counts`` would.  Category tables list every fixed
category, with 0 for a category no row has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scoring import round2


def _categories(spark: SparkSession, col: str, labels: Sequence, dtype: T.DataType) -> DataFrame:
    """A small fixed table of categories with their display order (bounded by ``labels``)."""
    schema = T.StructType([T.StructField(col, dtype), T.StructField("_ord", T.IntegerType())])
    return spark.createDataFrame([(v, i + 1) for i, v in enumerate(labels)], schema)


def company_volume(df: DataFrame, by: str = "company", n: str | None = None) -> DataFrame:
    """Row count per company, largest first, name as tie-break (A4).  ``n``: a column of counts, as below."""
    return (df.filter(F.col(by).isNotNull()).groupBy(by).agg((F.sum(n) if n else F.count(F.lit(1))).alias("n"))
            .orderBy(F.desc("n"), F.asc(by)))


def category_counts(df: DataFrame, col: str, labels: Sequence, dtype: T.DataType = T.StringType(),
                    n: str | None = None) -> DataFrame:
    """Counts in the fixed category order; a missing category shows 0.

    ``n``: a column of counts when ``df`` is already aggregated.

    The category table has ``len(labels)`` rows, so broadcasting it is safe.
    """
    spark = df.sparkSession
    counts = df.groupBy(col).agg((F.sum(n) if n else F.count(F.lit(1))).alias("n"))
    cats = _categories(spark, col, labels, dtype)
    return (F.broadcast(cats).join(counts, on=col, how="left")
            .select(col, F.coalesce("n", F.lit(0)).cast("long").alias("n"), "_ord")
            .orderBy("_ord").drop("_ord"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts of the non-null values, largest first (A5)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)))


def share_of_total(counts: DataFrame, count_col: str = "n", digits: int | None = None) -> DataFrame:
    """Percent of the total per row.

    Meant for category tables (a handful of rows): the un-partitioned window
    moves them to one task, which is bounded by the number of categories."""
    pct = F.col(count_col) * 100.0 / F.sum(count_col).over(Window.partitionBy())
    return counts.withColumn("pct", round2(pct, digits) if digits is not None else pct)


def share_of_rows(counts: DataFrame, count_col: str = "n", digits: int | None = None) -> DataFrame:
    """The same for tables with a row per company: the total is a one-row aggregate (a scalar subquery), so the
    rows stay where they are."""
    pct = F.col(count_col) * 100.0 / counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn("pct", round2(pct, digits) if digits is not None else pct)


def crosstab_pct(df: DataFrame, row: str, col: str, values: Sequence, names: Sequence[str] | None = None,
                 digits: int | None = None, n: str | None = None) -> DataFrame:
    """Row-normalised crosstab ×100 with one column per listed value.

    ``n``: a column of counts when ``df`` is already aggregated.

    One aggregate of conditional counts per row key (partial aggregation,
    one shuffle; no pivot job).  A value no row has still gets a column (0).
    Rows with a null ``row`` or ``col`` are left out, as a crosstab does.
    """
    names = list(names or [str(v) for v in values])
    r, c = F.col(row), F.col(col)
    one = F.col(n) if n else F.lit(1)
    counts = [F.coalesce(F.sum(F.when(c == F.lit(v), one)), F.lit(0)).alias(f"_n{i}") for i, v in enumerate(values)]
    total = F.coalesce(F.sum(F.when(c.isNotNull(), one)), F.lit(0)).alias("_total")
    agg = df.filter(r.isNotNull()).groupBy(row).agg(*counts, total)
    out = [F.col(row)]
    for i, name in enumerate(names):
        pct = F.col(f"_n{i}") * 100.0 / F.col("_total")
        out.append((round2(pct, digits) if digits is not None else pct).alias(name))
    return agg.filter(F.col("_total") > 0).select(*out)


def risk_summary(df: DataFrame, score: str, by: str = "company", digits: int | None = 2) -> DataFrame:
    """Mean, max and count of a score per company (A3)."""
    agg = (df.filter(F.col(by).isNotNull()).groupBy(by)
           .agg(F.avg(score).alias("mean_risk"), F.max(score).alias("max_risk"),
                F.count(score).alias("n")))
    if digits is not None:
        agg = agg.select(by, round2("mean_risk", digits).alias("mean_risk"),
                         round2("max_risk", digits).alias("max_risk"), "n")
    return agg


def high_risk(df: DataFrame, score: str, threshold: float = 75) -> DataFrame:
    """Rows with score ≥ threshold, inclusive."""
    return df.filter(F.col(score) >= threshold)


def alarm_count(df: DataFrame, score: str, threshold: float = 75) -> DataFrame:
    """Number of rows at or above the threshold."""
    return high_risk(df, score, threshold).agg(F.count(F.lit(1)).alias("n_alarm"))


def global_max(df: DataFrame, col: str, alias: str = "max_value") -> DataFrame:
    """Adds the maximum of ``col`` over a small table."""
    return df.withColumn(alias, F.max(col).over(Window.partitionBy()))
