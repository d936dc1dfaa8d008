"""Topic model by mini-batch variational Bayes with averaged shards (M5 at the original's number of updates).

The rows are dealt to ``shards`` by a seeded hash and each shard to ``rounds`` slices.  A round is one Spark job: every
shard walks through one of its slices in batches of 128 rows, updating its own copy of the topic matrix after each; the
copies are then averaged by rows, and the average goes out again.  A pass is ``rounds`` rounds in a seeded random order.
Thus 10 passes over 9,294 rows make about 730 updates of 128 rows, whatever the number of shards.

Tasks hold one batch (``batch`` x terms counts).  A round sends one topic matrix from each shard; the averages are summed
as decimals, so the order of the shards does not matter and the same seed, shards and rows give the same model.
The driver holds one matrix: k x ``vocab_size`` numbers.

Defined cases: a row with null text or without a term of the vocabulary takes no part in the fit and gets equal shares of
all topics (topic 1); repeated rows count as often as they occur, and are dealt out by ``key`` and text together; of an
empty table the model is its random start and the perplexity null.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import dominant_topic
from ..session import ship
from .terms import analysis_tokens, lda_vocabulary

DECAY, OFFSET = 0.7, 10.0
E_STEPS, E_TOLERANCE = 100, 1e-3
#: Share of the rows, in thousandths, that only measures the perplexity.
HELD_OUT = 50


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the log gamma function for x > 0: six steps of the recurrence, then the asymptotic series."""
    back = sum(1 / (x + i) for i in range(6))
    x = x + 6
    f = 1 / (x * x)
    return np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132)))) - back


def e_log(weights: np.ndarray) -> np.ndarray:
    """exp of the expected log of Dirichlet rows."""
    return np.exp(digamma(weights) - digamma(weights.sum(axis=1, keepdims=True)))


def posterior(starts: np.ndarray, cols: np.ndarray, n: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Dirichlet parameters of the topics of each bag (its terms begin at ``starts``, none is empty); bags converge one
    by one, so a bag's result does not depend on the others."""
    k, size = len(beta), np.diff(np.append(starts, len(cols)))
    gamma, open_, word = np.ones((len(starts), k)), np.arange(len(starts)), beta.T[cols]
    for _ in range(E_STEPS):
        theta = e_log(gamma[open_])
        share = n / (np.einsum("ij,ij->i", np.repeat(theta, size, axis=0), word) + 1e-100)
        new = 1 / k + theta * np.add.reduceat(word * share[:, None], starts, axis=0)
        moved = np.abs(new - gamma[open_]).mean(axis=1) >= E_TOLERANCE
        gamma[open_] = new
        if not moved.any():
            break
        if not moved.all():
            keep = np.repeat(moved, size)
            open_, size, n, word = open_[moved], size[moved], n[keep], word[keep]
            starts = np.cumsum(size) - size
    return gamma


def flat(b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, term numbers and counts of the bags of a table."""
    ids, n = b.column("ids").combine_chunks(), b.column("n").combine_chunks()
    size = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
    return (np.cumsum(size) - size, ids.flatten().to_numpy(zero_copy_only=False),
            n.flatten().to_numpy(zero_copy_only=False).astype(np.float64))


def slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows in tables of ``size``, the last one shorter; a table is held at a time."""
    held, n = [], 0
    for b in batches:
        while n + b.num_rows >= size:
            cut = size - n
            yield pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks()
            held, n, b = [], 0, b.slice(cut)
        if b.num_rows:
            held.append(b)
            n += b.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _bag_arrays(words: pa.Array, known: pa.Array) -> tuple[np.ndarray, ...]:
    """Of the rows with a known term: their places, where their terms begin, how many they are; all terms' numbers and counts."""
    words = words.fill_null(pa.scalar([], words.type))
    row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    at = pc.index_in(words.flatten().cast(pa.string()), value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
    cell, n = np.unique(row[at >= 0] * len(known) + at[at >= 0], return_counts=True)
    rows, starts = np.unique(cell // len(known), return_index=True)
    return rows, starts, np.diff(np.append(starts, len(cell))), cell % len(known), n


def bags(tokens: DataFrame, vocab: Sequence[str]) -> DataFrame:
    """(h, ids, n): the terms of each row by number, rising, with their counts; rows without one are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocab, pa.string())
        for b in batches:
            rows, starts, _, cols, n = _bag_arrays(b.column(1), known)
            ends = pa.array(np.append(starts, len(cols)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(rows)), pa.ListArray.from_arrays(ends, pa.array(cols, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(n, pa.int32()))], ["h", "ids", "n"])

    ship(tokens.sparkSession)
    return tokens.mapInArrow(run, "h long, ids array<int>, n array<int>")


@dataclass
class TopicModel:
    vocab: list[str]
    weights: np.ndarray  # k x terms, Dirichlet parameters of the topics' words
    history: list[tuple[int, int, float | None]] = field(default_factory=list)  # pass, updates so far, perplexity

    @property
    def k(self) -> int:
        return len(self.weights)

    def assign(self, df: DataFrame, text: str = "cleaned", stop: Sequence[str] = ()) -> DataFrame:
        """Adds ``topic_dist`` and ``topic`` (1-based, of equal shares the first)."""
        vocab, beta, k = self.vocab, e_log(self.weights), self.k
        base = df.drop("topic_dist")
        names = [f"c{i}" for i in range(len(base.columns))]  # no name of ``df`` meets ours

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = pa.array(vocab, pa.string())
            for b in batches:
                gamma = np.ones((b.num_rows, k))
                row, _, size, cols, n = _bag_arrays(b.column(len(names)), known)
                if len(row):
                    gamma[row] = posterior(np.cumsum(size) - size, cols, n.astype(np.float64), beta)
                share = gamma / gamma.sum(axis=1, keepdims=True)
                ends = pa.array(np.arange(b.num_rows + 1) * k, pa.int32())
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(share.ravel()))],
                                                 [*names, "dist"])

        ship(df.sparkSession)
        rows = base.toDF(*names).select(*names, analysis_tokens(names[base.columns.index(text)], stop).alias("tokens"))
        kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes[:-1])
        out = rows.mapInArrow(run, f"{kinds}, dist array<double>").toDF(*base.columns, "topic_dist")
        if len(base.columns) < len(df.columns):  # an earlier assignment is replaced in its place
            out = out.select(*df.columns)
        return out.withColumn("topic", dominant_topic("topic_dist"))

    def terms(self, spark, n: int = 10) -> DataFrame:
        """(topic, rank, term, weight): the ``n`` top words of each topic; of equal weights the first term."""
        share = self.weights / self.weights.sum(axis=1, keepdims=True)
        rows = [(t + 1, r + 1, self.vocab[w], float(share[t, w])) for t in range(self.k)
                for r, w in enumerate(sorted(range(len(self.vocab)), key=lambda w: (-share[t, w], self.vocab[w]))[:n])]
        return spark.createDataFrame(rows, "topic int, rank int, term string, weight double")


def shard_step(weights: np.ndarray, rows: int, done: int, batch: int):
    """One shard's walk over its slice of ``rows`` rows in all: ``pos, value`` of its matrix times its rows, then its
    rows at place -1 and its updates at -2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, t = weights.copy(), 0, 0
        k, size = own.shape
        for b in slices(batches, batch):
            starts, cols, n = flat(b)
            beta = e_log(own)
            theta = np.repeat(e_log(posterior(starts, cols, n, beta)), np.diff(np.append(starts, len(cols))), axis=0)
            part = theta * (n / (np.einsum("ij,ij->i", theta, beta.T[cols]) + 1e-100))[:, None]
            stats = beta * np.array([np.bincount(cols, part[:, i], size) for i in range(k)])
            rate = (OFFSET + done + t) ** -DECAY
            own = (1 - rate) * own + rate * (1 / k + stats * (rows / b.num_rows))
            seen, t = seen + b.num_rows, t + 1
        if seen:
            value = np.concatenate([own.ravel() * seen, [seen, t]])
            pos = np.concatenate([np.arange(own.size), [-1, -2]])
            yield pa.RecordBatch.from_arrays([pa.array(pos, pa.int32()), pa.array(value)], ["pos", "value"])

    return run


def perplexity(held: DataFrame, weights: np.ndarray, batch: int = 128) -> float | None:
    """Per-word perplexity by document completion: topics from the terms at even places of a bag, scored on the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta, share = e_log(weights), weights / weights.sum(axis=1, keepdims=True)
        for b in slices(batches, batch):
            starts, cols, n = flat(b)
            row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(cols))))
            odd = (np.arange(len(cols)) - starts[row]) % 2 == 1
            size = np.bincount(row[~odd], minlength=len(starts))
            gamma = posterior(np.cumsum(size) - size, cols[~odd], n[~odd], beta)
            theta = (gamma / gamma.sum(axis=1, keepdims=True))[row[odd]]
            ll = n[odd] * np.log(np.einsum("ij,ij->i", theta, share.T[cols[odd]]))
            yield pa.RecordBatch.from_arrays([pa.array([float(ll.sum())]), pa.array([float(n[odd].sum())])],
                                             ["ll", "words"])

    r = held.mapInArrow(run, "ll double, words double").agg(F.sum("ll").alias("ll"), F.sum("words").alias("words")).first()
    return float(np.exp(-r.ll / r.words)) if r.words else None


def fit_minibatch(df: DataFrame, text: str = "cleaned", stop: Sequence[str] = (), k: int = 3, seed: int = 42,
                  min_df: int = 5, vocab_size: int = 1000, passes: int = 10, shards: int = 8, rounds: int = 2,
                  batch: int = 128, key: str | None = None) -> TopicModel:
    """Fit over the bounded vocabulary with priors 1/k, learning decay 0.7 and offset 10; the perplexity of the held-out
    rows (``HELD_OUT`` in a thousand) is kept per pass.

    ``shards`` is the number of parallel walks (about the cores of the cluster) and, like the seed, part of the result.
    ``key`` names a column that tells rows of equal text apart when they are dealt out.  The bags are made once and
    persisted, sorted within each shard; a lost partition is made again in the same order."""
    # at most ``vocab_size`` terms and k x ``vocab_size`` numbers reach the driver
    vocab = [r.term for r in lda_vocabulary(df, text, stop, min_df, vocab_size).collect()] or ["_"]
    h = F.xxhash64(F.lit(seed), F.col(text), *([F.col(key).cast("string")] if key else []))
    bag = bags(df.select(h.alias("h"), analysis_tokens(text, stop).alias("tokens")), vocab)
    dealt = F.shiftright("h", 10)
    bag = bag.select("h", "ids", "n", (F.pmod("h", F.lit(1000)) < HELD_OUT).alias("held"),
                     F.pmod(dealt, F.lit(rounds)).cast("int").alias("slice"),
                     F.pmod(F.shiftright("h", 30), F.lit(shards)).cast("int").alias("shard"))
    bag = bag.repartitionById(shards, F.col("shard")).sortWithinPartitions("held", "slice", "h", "ids", "n")
    bag = bag.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, held = bag.filter(~F.col("held")).select("slice", "ids", "n"), bag.filter("held").select("ids", "n")
        rows = train.count()
        weights = np.random.default_rng(seed).gamma(100.0, 0.01, (k, len(vocab)))
        model, done, updates = TopicModel(vocab, weights), 0, 0
        for p in range(passes if rows else 0):
            for s in np.random.default_rng([seed, p]).permutation(rounds):
                part = train.filter(F.col("slice") == int(s)).mapInArrow(
                    shard_step(model.weights, rows, done, batch), "pos int, value double")
                total = part.groupBy("pos").agg(F.sum(F.col("value").cast("decimal(38,8)")).cast("double").alias("value"),
                                                F.max("value").alias("most"))
                got = {r.pos: r for r in total.collect()}
                if got:
                    model.weights = np.array([got[i].value for i in range(weights.size)]).reshape(weights.shape) / got[-1].value
                    done, updates = done + int(got[-2].most), updates + int(got[-2].value)
            model.history.append((p + 1, updates, perplexity(held, model.weights)))
        return model
    finally:
        bag.unpersist()
