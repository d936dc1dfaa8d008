"""Churn features, labels, the rule score, the forest model and its metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import lexicons as L
from ..functions import scoring as SC
from ..functions import sentiment as S
from ..session import materialize

FEATURES = ["crit_hits", "mid_hits", "sentiment_weight", "is_billing", "is_infra"]


def churn_features(df: DataFrame, lexicon: L.Lexicon = L.REFERENCE, text: str = "cleaned",
                   sentiment: str = "sentiment", topic: str | None = "topic") -> DataFrame:
    """Critical and medium phrase hits, sentiment weight, topic flags and the label (M7, M8)."""
    billing, infra = SC.topic_flags(F.col(topic) if topic else F.lit(None).cast("int"))
    out = df.select(
        "*",
        S.count_hits(text, lexicon.churn_critical_model).alias("crit_hits"),
        S.count_hits(text, lexicon.churn_medium).alias("mid_hits"),
        S.sentiment_weight(sentiment).cast("double").alias("sentiment_weight"),
        billing.alias("is_billing"), infra.alias("is_infra"),
    )
    return out.withColumn("churn_label", SC.churn_label("crit_hits", "sentiment_weight"))


def rule_risk_table(df: DataFrame, lexicon: L.Lexicon = L.REFERENCE, text: str = "cleaned",
                    sentiment: str = "sentiment") -> DataFrame:
    """Rule score clip(30·crit + 20·weight, 0, 100) and its risk group."""
    crit = S.count_hits(text, lexicon.churn_critical_rule)
    weight = S.sentiment_weight(sentiment)
    out = df.select("*", crit.alias("rule_crit_hits"), weight.alias("rule_weight"))
    out = out.withColumn("rule_risk", SC.rule_risk("rule_crit_hits", "rule_weight").cast("int"))
    return out.withColumn("risk_group", SC.risk_bin("rule_risk"))


def split_bucket(key: str = "link"):
    """0..99 bucket from the first 32 bits of md5(key) (M9)."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 100).cast("int")


def hash_split(df: DataFrame, key: str = "link", test_pct: int = 20) -> tuple[DataFrame, DataFrame]:
    """Repeatable ~80/20 split on a hash of the key; no shuffle, no single partition."""
    b = df.withColumn("_bucket", split_bucket(key))
    return (b.filter(F.col("_bucket") >= test_pct).drop("_bucket"),
            b.filter(F.col("_bucket") < test_pct).drop("_bucket"))


def _kth(df: DataFrame, col: str, k: int, bits: int = 60, digit: int = 12) -> tuple[int, int, int]:
    """The ``k``-th smallest value of a non-negative number below 2^bits, the rows below it, and the rows equal to it.

    Nested histograms: each pass counts the rows of one bucket of the pass before by their next ``digit`` bits, so at
    most 2^digit counts reach the driver, whatever the number of rows."""
    prefix, left = 0, k
    rows = df
    for shift in range(bits - digit, -1, -digit):
        cell = F.shiftright(F.col(col), shift)
        if shift + digit < bits:
            rows = df.filter(F.shiftright(F.col(col), shift + digit) == prefix)
        counts = sorted((r["cell"], r["count"]) for r in rows.groupBy(cell.alias("cell")).count().collect())
        for prefix, n in counts:
            if left <= n:
                break
            left -= n
        else:
            raise ValueError("k exceeds the number of rows")
    return prefix, k - left, n


def _hash60(c):
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("long")


def exact_split(df: DataFrame, key: str = "link", test_share: float = 0.2) -> DataFrame:
    """``df`` with ``is_test``: true for exactly ceil(test_share x rows), those with the smallest hash of the key (M9).

    Rows whose keys have one hash are taken by a hash of the whole row, and rows that are equal in every column by
    number, so the count is exact whatever repeats.  A null key counts as empty.  The rows are written once; thresholds
    come from nested histograms of their hashes, nothing is sorted."""
    names = [f"c{i}" for i in range(len(df.columns))]
    src = df.toDF(*names)
    whole = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    rows = materialize(src.select(*names, _hash60(F.coalesce(F.col(names[df.columns.index(key)]).cast("string"), F.lit(""))).alias("h1"),
                                  _hash60(whole).alias("h2"), F.monotonically_increasing_id().alias("h3")), "split")
    total = rows.count()
    need, same, is_test = -(-total * round(test_share * 10 ** 9) // 10 ** 9), rows, F.lit(False)
    for h, bits in (("h1", 60), ("h2", 60), ("h3", 63)):
        if need <= 0:
            break
        bits = bits + (-bits) % 12
        value, below, equal = _kth(same, h, need, bits)
        tied = F.lit(True) if same is rows else met  # noqa: F821 - the rows equal in the hashes before
        is_test = is_test | (tied & (F.col(h) < value))
        need -= below
        if need == equal:
            is_test = is_test | (tied & (F.col(h) == value))
            break
        met = tied & (F.col(h) == value)
        same = rows.filter(met)
    return rows.select(*names, is_test.alias("is_test")).toDF(*df.columns, "is_test")


def binary_metrics(df: DataFrame, label: str = "churn_label", pred: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 in one pass; 0 when undefined."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    c = df.agg(F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
               F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
               F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
               F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"))
    tp, fp, tn, fn = (F.coalesce(F.col(x), F.lit(0)) for x in ("tp", "fp", "tn", "fn"))
    prec = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp.cast("double"), tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    acc = F.coalesce(F.try_divide((tp + tn).cast("double"), tp + fp + tn + fn), F.lit(0.0))
    return c.select(tp.alias("tp"), fp.alias("fp"), tn.alias("tn"), fn.alias("fn"),
                    acc.alias("accuracy"), prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def fit_forest(train: DataFrame, features=FEATURES, label: str = "churn_label", trees: int = 100,
               depth: int = 6, seed: int = 42):
    """Random forest: 100 trees, depth 6, sqrt features, gini, bootstrap."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    asm = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    rf = RandomForestClassifier(featuresCol="_features", labelCol=label, numTrees=trees, maxDepth=depth,
                                featureSubsetStrategy="sqrt", impurity="gini", bootstrap=True, seed=seed,
                                predictionCol="prediction", probabilityCol="_prob",
                                rawPredictionCol="_raw")
    return Pipeline(stages=[asm, rf]).fit(train.withColumn(label, F.col(label).cast("double")))


def score_risk(model, df: DataFrame, digits: int = 2) -> DataFrame:
    """P(class 1) × 100, rounded, for every row.

    The probability vector has length 1 when training saw only class 0, so
    index 1 is read with a null-safe lookup that falls back to 0.
    """
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    p1 = F.coalesce(F.try_element_at(vector_to_array("_prob"), F.lit(2)), F.lit(0.0))
    return out.withColumn("churn_risk", SC.round2(p1 * 100, digits)).drop("_features", "_prob", "_raw")
