"""Document quality by supervised subword embeddings.

Every word (a run without ASCII white space) and every n-gram of 3 to 5 code
points of ``<word>`` has a learned vector, found by a hash.  A word that repeats
the one before it counts as the ditto mark, so that runs of one word look alike
whatever the word.  A document is the
mean of the vectors of all its words and their n-grams; a softmax layer turns it
into the probability of label 1.  Vectors and layer are trained on the driver by
numpy stochastic gradient descent.

Learning uses about ``train_docs`` documents of each label, drawn by a hash of the
id, so reruns agree; of them only texts of at most ``train_chars`` characters,
and each comes to the driver as the counts of its hashed features.  The class
shares of the draw are undone by the prior of the labels.  Scoring
is one scan of the whole texts without a shuffle: the softmax of a mean is
linear in the vectors, so a task needs one number per hashed feature, and the
sum over a word's features is computed once per distinct word of a slice.

Defined cases: a null text counts as empty; an empty text gets the prior; label
rows with a null id or a value other than 0 and 1, and ids whose label rows
disagree, are not learned from; of documents that share an id the one with the
smallest text is; with one label only every score is that label, with none 0.5;
a null id is held out.  Repeated rows get equal results, an empty table an empty
one, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language_id import held_out

TRAIN_DOCS = 1500
TRAIN_CHARS = 1 << 15
ORDERS = (3, 4, 5)
WORD_BITS, GRAM_BITS = 16, 17
#: Rows of the vector table: words first, then n-grams.
FEATURES = (1 << WORD_BITS) + (1 << GRAM_BITS)
#: Words that a task remembers with their score before it starts afresh.
REMEMBERED = 400_000
DITTO = "\u3003".encode()
_SLICE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio, the usual multiplicative hash


def _bucket(key: np.ndarray, bits: int) -> np.ndarray:
    key = (key ^ (key >> np.uint64(29))) * _MIX
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The feature ids of all words, one word after the other, and where each word's begin."""
    texts = [f"<{w.decode('utf-8', 'replace')}>" for w in words]
    size = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    start = np.concatenate([[0], np.cumsum(size)])
    word = np.repeat(np.arange(len(words)), size)
    left = start[word + 1] - np.arange(len(points))  # code points from here to the end of the word
    key = np.zeros(len(points), dtype=np.uint64)
    ids, owner = [], []
    for k in range(max(ORDERS)):
        m = len(points) - k
        if m <= 0:
            break
        key[:m] = (key[:m] + points[k:]) * _MIX
        if k + 1 in ORDERS:
            at = np.flatnonzero(left > k)
            ids.append((1 << WORD_BITS) + _bucket(key[at] + np.uint64(k), GRAM_BITS))
            owner.append(word[at])
    weights = np.full(int(size.max(initial=0)), _MIX)
    powers = np.multiply.accumulate(weights) if len(weights) else weights
    place = np.arange(len(points)) - start[word]
    mixed = (points * powers[place]) ^ ((points * powers[place]) >> np.uint64(31))
    whole = np.add.reduceat(mixed, start[:-1]) if len(words) else np.zeros(0, dtype=np.uint64)
    ids.append(_bucket(whole, WORD_BITS))
    owner.append(np.arange(len(words)))
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])


@dataclass
class Model:
    """Vectors of all features, the softmax layer, and the odds by which the prior differs from the draw."""

    vectors: np.ndarray  # features x dimensions
    layer: np.ndarray  # dimensions x 2
    prior: float = 0.0
    constant: float | None = None
    weights: np.ndarray = field(init=False)

    def __post_init__(self):
        self.weights = (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float64)


class Scorer:
    """Scores texts with the one number per feature; remembers the words it has met."""

    def __init__(self, weights: np.ndarray, prior: float, constant: float | None):
        self.weights, self.prior, self.constant = weights, prior, constant
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.total, self.count = np.zeros(0), np.zeros(0)
        self.learn({DITTO})

    def learn(self, words: set[bytes]) -> None:
        new = sorted(words)
        lo = 0
        while lo < len(new):  # about a slice of bytes at a time
            hi, size = lo, 0
            while hi < len(new) and (hi == lo or size + len(new[hi]) <= _SLICE):
                size += len(new[hi])
                hi += 1
            part = new[lo:hi]
            ids, start = word_features(part)
            self.place.update(zip(part, range(len(self.total), len(self.total) + len(part))))
            self.total = np.concatenate([self.total, np.add.reduceat(self.weights[ids], start[:-1])])
            self.count = np.concatenate([self.count, np.diff(start)])
            lo = hi

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        odds = np.full(len(texts), self.prior)
        lo = 0
        while lo < len(texts):
            part, size = [], 0
            while lo + len(part) < len(texts) and (not part or size < _SLICE):
                part.append((texts[lo + len(part)] or "").encode("utf-8", "surrogatepass").split())  # at ASCII white space
                size += sum(map(len, part[-1]))
            new = set().union(*part).difference(self.place)
            if len(self.place) + len(new) > REMEMBERED:
                self.forget()
                new = set().union(*part).difference(self.place)
            self.learn(new)
            for k, words in enumerate(part):
                if words:
                    at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                    at[1:][at[1:] == at[:-1]] = self.place[DITTO]
                    odds[lo + k] += self.total[at].sum() / self.count[at].sum()
            lo += len(part)
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -700, 700)))


def document_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature ids of a text, ascending, and how often each occurs."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    distinct, at = np.unique(np.array([DITTO, *words], dtype=object), return_inverse=True)
    ditto, at = at[0], at[1:]
    at[1:] = np.where(at[1:] == at[:-1], ditto, at[1:])
    times = np.bincount(at, minlength=len(distinct))
    ids, start = word_features(list(distinct))
    total = np.bincount(ids, weights=np.repeat(times, np.diff(start)), minlength=FEATURES)
    at = np.flatnonzero(total)
    return at, total[at].astype(np.int64)


def sgd(docs: list[tuple[int, np.ndarray, np.ndarray]], dims: int = 12, epochs: int = 8, rate: float = 2.0,
        seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and softmax layer from (label, feature ids, counts): one step a document, the rate falls to nothing."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / dims, 1.0 / dims, (FEATURES, dims)).astype(np.float32)
    layer = np.zeros((dims, 2), dtype=np.float32)
    docs = [(y, i, (c / c.sum()).astype(np.float32)) for y, i, c in docs if len(i)]
    steps, done = epochs * max(1, len(docs)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            y, ids, share = docs[k]
            step = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[ids]
            out = hidden @ layer
            out = np.exp(out - out.max())
            out /= out.sum()
            out[y] -= 1
            back = layer @ out
            layer -= step * np.outer(hidden, out)
            # the mean's gradient, scaled as if each document had sqrt(features) of them: long texts must not stall
            vectors[ids] -= (step * np.sqrt(len(ids))) * share[:, None] * back[None, :]
    return vectors, layer


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> Model:
    """Learn from label rows that are not held out, about ``train_docs`` documents of each label."""
    y = F.col(label_col).cast("int")
    agreed = (labels.filter(F.col(id_col).isNotNull() & y.isin(0, 1) & ~held_out(id_col)).groupBy(F.col(id_col).alias("id"))
              .agg(F.min(y).alias("y"), F.max(y).alias("high")).filter(F.col("y") == F.col("high")).select("id", "y"))
    sizes = {r["y"]: r["count"] for r in agreed.groupBy("y").count().collect()}
    none = np.zeros((FEATURES, 1), dtype=np.float32), np.zeros((1, 2), dtype=np.float32)
    if len(sizes) < 2:
        return Model(*none, constant=float(next(iter(sizes), 0.5)))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("y") == 1, min(1.0, train_docs / sizes[1])).otherwise(min(1.0, train_docs / sizes[0]))
    drawn = F.broadcast(agreed.filter(draw < share))  # about 2 x train_docs rows
    text = F.col(text_col)
    known = (docs.filter(text.isNotNull() & (F.length(text) <= train_chars)).select(F.col(id_col).alias("id"), text.alias("text"))
             .join(drawn, "id").groupBy("id", "y").agg(F.min("text").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [document_counts(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a.astype(np.int32) for a, _ in pairs], pa.list_(pa.int32())),
                 pa.array([c.astype(np.int32) for _, c in pairs], pa.list_(pa.int32()))], ["id", "y", "ids", "counts"])

    rows = (known.mapInArrow(run, f"id {known.dtypes[0][1]}, y int, ids array<int>, counts array<int>")
            .orderBy(F.xxhash64(F.col("id").cast("string")), "id").toArrow())
    ids, counts = rows.column("ids").combine_chunks(), rows.column("counts").combine_chunks()
    label = rows.column("y").to_pylist()
    data = [(label[k], ids[k].values.to_numpy(), counts[k].values.to_numpy()) for k in range(len(label))]
    met = [sum(1 for d in data if d[0] == c) for c in (0, 1)]
    if not all(met):
        return Model(*none, prior=float(np.log(sizes[1] / sizes[0])))
    return Model(*sgd(data), prior=float(np.log(sizes[1] / sizes[0]) - np.log(met[1] / met[0])))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weights, model.prior, model.constant))  # one number per feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.scores(batch.column(1).to_pylist()))], ["id", "score"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = src.mapInArrow(run, f"id {src.dtypes[0][1]}, score double")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
