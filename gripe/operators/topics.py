"""Topic model: bag of words, online LDA, dominant topic, topic names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicons as L
from ..functions.scoring import dominant_topic
from ..functions.sentiment import map_default
from .terms import analysis_tokens, lda_vocabulary


def fit_topics(df: DataFrame, text: str = "cleaned", stop: Sequence[str] = (), k: int = 3, seed: int = 42,
               min_df: int = 5, vocab_size: int = 1000, passes: int = 10, updates: int = 20,
               restarts: int = 1):
    """Online variational LDA over the bounded vocabulary (M5).

    Priors 1/k, learning decay 0.7, offset 10 and ten ``passes`` over the corpus
    as in the original.  The passes are made in ``updates`` mini-batches (each
    a sample of passes / updates of the corpus), one Spark job each.  The
    count vectors are persisted for the iterations (recomputed from lineage
    if an executor is lost).  ``restarts`` > 1 fits with seeds ``seed``,
    ``seed + 1``, ... and keeps the model with the highest log-likelihood on
    the corpus, since variational fits can stop in a local optimum that
    merges topics.  Returns ``(vocab_terms, cv_model, lda_model)``.
    """
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizerModel

    # at most ``vocab_size`` terms reach the driver: a bounded collect
    terms = [r.term for r in lda_vocabulary(df, text, stop, min_df, vocab_size).collect()]
    cv = CountVectorizerModel.from_vocabulary(terms or ["_"], inputCol="_tokens", outputCol="_counts")
    vec = cv.transform(df.select(analysis_tokens(text, stop).alias("_tokens"))).select("_counts")
    vec = vec.persist(StorageLevel.MEMORY_AND_DISK)
    best, best_ll = None, None
    for s in range(seed, seed + max(1, restarts)):
        lda = LDA(k=k, seed=s, optimizer="online", maxIter=updates, featuresCol="_counts",
                  docConcentration=[1.0 / k] * k, topicConcentration=1.0 / k, learningDecay=0.7,
                  learningOffset=10.0, optimizeDocConcentration=False, subsamplingRate=min(1.0, passes / updates),
                  topicDistributionCol="_dist")
        model = lda.fit(vec)
        if restarts <= 1:
            best = model
            break
        ll = model.logLikelihood(vec)
        if best_ll is None or ll > best_ll:
            best, best_ll = model, ll
    vec.unpersist()
    return terms, cv, best


def assign_topics(df: DataFrame, cv, model, text: str = "cleaned", stop: Sequence[str] = ()) -> DataFrame:
    """Adds ``topic`` (1-based argmax of the topic distribution) and ``topic_dist``."""
    from pyspark.ml.functions import vector_to_array

    withv = cv.transform(df.withColumn("_tokens", analysis_tokens(text, stop)))
    out = model.transform(withv).withColumn("_arr", vector_to_array("_dist"))
    # a document without vocabulary terms gets an all-zero vector; its
    # posterior is the symmetric prior, i.e. uniform (argmax: topic 1)
    k = model.getK()
    total = F.aggregate("_arr", F.lit(0.0), lambda a, x: a + x)
    dist = F.when(total > 0, F.col("_arr")).otherwise(F.array_repeat(F.lit(1.0 / k), k))
    return (out.withColumn("topic_dist", dist).withColumn("topic", dominant_topic("topic_dist"))
            .drop("_tokens", "_counts", "_dist", "_arr"))


def topic_terms(model, vocab: Sequence[str], n: int = 10) -> DataFrame:
    """Top terms of each topic with their weights (1-based topic number)."""
    t = model.describeTopics(n)
    arr = F.array(*[F.lit(w) for w in vocab]) if vocab else F.array().cast("array<string>")
    e = t.select((F.col("topic") + 1).alias("topic"),
                 F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "z"))
    return e.select("topic", (F.col("rank") + 1).alias("rank"),
                    F.element_at(arr, F.col("z.termIndices") + 1).alias("term"),
                    F.col("z.termWeights").alias("weight"))


def name_topics(topic: str = "topic", names: Mapping[int, str] = L.TOPIC_NAMES):
    """Topic number → fixed name; a number without a name gives null."""
    return map_default(topic, names, None)


def assign_names(scores: DataFrame, topics: Sequence[int], names: Sequence[str]) -> DataFrame:
    """(topic, name, margin): the assignment of names to topics with the largest total score (M6).

    ``scores`` has (topic, name, score); a missing pair scores 0.  All assignments are compared, so the number of topics
    and of names is at most 7; the smaller side is filled up with topics or names that stand for none.  ``margin`` is
    the lead over the best assignment that gives the topic another name; ties go to the first in the order given.
    A topic whose score for its name is 0 has no name.  One join and aggregates; nothing is collected."""
    k = max(len(topics), len(names))
    if k > 7:
        raise ValueError("at most 7 topics and names: all assignments are compared")
    spark = scores.sparkSession
    t = [*topics, *[None] * (k - len(topics))]
    rows = [(p, topic, name) for p, order in enumerate(permutations([*names, *[None] * (k - len(names))]))
            for topic, name in zip(t, order) if topic is not None]
    every = spark.createDataFrame(rows, "p int, topic int, name string")  # at most 7! x 7 rows
    s = scores.groupBy(F.col("topic").cast("int").alias("topic"), "name").agg(F.sum("score").alias("score"))
    ways = every.join(s, ["topic", "name"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    total = ways.groupBy("p").agg(F.sum("score").alias("total"))
    # at most 7! totals in one window
    total = total.withColumn("b", F.max(F.struct("total", (-F.col("p")).alias("p"))).over(Window.partitionBy()))
    full = ways.join(total, "p")
    mine = full.filter(F.col("p") == -F.col("b.p")).select("topic", F.col("name").alias("chosen"), F.col("score").alias("own"))
    other = (full.join(F.broadcast(mine), "topic").groupBy("topic", "chosen", "own").agg(
        F.max("b.total").alias("top"), F.max(F.when(~F.col("name").eqNullSafe(F.col("chosen")), F.col("total"))).alias("next")))
    return other.select("topic", F.when(F.col("own") > 0, F.col("chosen")).alias("name"),
                        F.when(F.col("own") > 0, F.col("top") - F.col("next")).alias("margin"))


def seed_scores(terms: DataFrame, seeds: Mapping[str, Sequence[str]]) -> DataFrame:
    """(topic, name, score): the summed weight of each name's seed terms in (topic, term, weight)."""
    rows = [(name, w) for name, words in seeds.items() for w in sorted(set(words))]
    listed = terms.sparkSession.createDataFrame(rows, "name string, term string")  # the seed lists
    return terms.join(F.broadcast(listed), "term").groupBy("topic", "name").agg(F.sum("weight").alias("score"))


def name_topics_by_seeds(model, vocab: Sequence[str], seeds: Mapping[str, Sequence[str]], n: int = 20) -> DataFrame:
    """(topic, name, margin) by seed terms, so names survive any order of the topics (M6).

    Each pair scores the summed weight of the name's seed terms among the topic's top ``n`` terms; the names are
    given so that the total is largest (:func:`assign_names`)."""
    terms = topic_terms(model, vocab, n)
    return assign_names(seed_scores(terms, seeds), range(1, model.getK() + 1), list(seeds))
