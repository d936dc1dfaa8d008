"""Language identification with error-correcting output codes.

Each language has a codeword of bits.  One binary classifier per bit (naive
Bayes over hashed byte n-grams) votes on it, and the language whose codeword
has the smallest weighted loss against the votes wins.  The weight of a bit for
a language is the margin its classifier has on that language's own n-grams.
Close decisions are flagged as ambiguous.

Training counts n-grams per language with Spark over about ``train_rows``
labelled documents of each language, chosen by a hash of the id inside the
scan, so no text is shuffled.  Only the count table (languages x buckets) goes
to the driver.  Prediction is one scan without a shuffle.

Defined cases: ``und`` for a null text, a text without a letter, and when
nothing could be learned; rows whose label or id is null are not learned from;
equal rows get equal results; an empty table gives an empty result; other
columns are not read, and ``lang``, ``source`` and the id are no inputs of a
prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, utf8_buffer

TRAIN_ROWS = 4000
ORDERS = (2, 3, 4)
BUCKET_BITS = 14
#: Languages whose losses differ by less than this are an ambiguous decision.
AMBIGUOUS = 0.01
_SLICE = 1 << 19

#: Bytes that are no letters of a lower-cased text count as a blank.
_FOLD = np.full(256, 0x20, dtype=np.uint32)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def ngram_buckets(data: np.ndarray, offs: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte; the bucket after the last one where it leaves its text or is blank."""
    none = 1 << BUCKET_BITS
    out = np.full(len(data), none, dtype=np.int32)
    n = len(data) - order + 1
    if n <= 0:
        return out
    b = _FOLD[data]
    key = b[:n].copy()
    blank = b[:n] == 0x20
    for k in range(1, order):
        key = (key << np.uint32(8)) | b[k:n + k]
        blank &= b[k:n + k] == 0x20
    key *= np.uint32(2654435761)  # Knuth's multiplicative hash
    out[:n] = key >> np.uint32(32 - BUCKET_BITS)
    out[:n][blank] = none
    for k in range(1, order):  # the last order - 1 bytes of each text start no n-gram
        at = offs[1:] - k
        out[at[at >= offs[:-1]]] = none
    return out


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """``n`` rows of +1/-1: the exhaustive code up to 7 languages, else random bits with the best minimum distance."""
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 7:
        cols = [[1 if i == 0 else (1 if (c >> (i - 1)) & 1 else -1) for i in range(n)] for c in range(2 ** (n - 1) - 1)]
        return np.array(cols, dtype=np.int8).T
    rng, bits = np.random.default_rng(seed), 15 * int(np.ceil(np.log2(n)))
    best, far = None, -1
    for _ in range(50):
        m = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
        d = (bits - m.astype(np.int32) @ m.T.astype(np.int32)) // 2
        d[np.diag_indices(n)] = bits
        if d.min() > far and (np.abs(m.sum(axis=0)) < n).all():
            best, far = m, d.min()
    return best if best is not None else m


@dataclass
class Model:
    langs: list[str]
    words: np.ndarray  # languages x bits, +1/-1
    odds: np.ndarray  # bits x (orders x buckets + 1 each), log odds of a set bit
    weights: np.ndarray  # languages x bits, rows sum to 1

    def losses(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Weighted loss of every language for every text (rows)."""
        texts, bits = len(offs) - 1, self.words.shape[1]
        total, seen = np.zeros((bits, texts)), np.zeros(texts)
        size = (1 << BUCKET_BITS) + 1
        full = np.flatnonzero(np.diff(offs) > 0)
        if len(full):
            for o, order in enumerate(ORDERS):
                idx = ngram_buckets(data, offs, order)
                seen[full] += np.add.reduceat((idx < size - 1).astype(np.float32), offs[full], dtype=np.float64)
                for b in range(bits):
                    total[b, full] += np.add.reduceat(self.odds[b, o * size:(o + 1) * size][idx], offs[full], dtype=np.float64)
        vote = total / np.sqrt(np.maximum(seen, 1.0))
        out = np.empty((texts, len(self.langs)))
        for k in range(len(self.langs)):
            out[:, k] = (self.weights[k][:, None] * np.logaddexp(0.0, -self.words[k][:, None] * vote)).sum(axis=0)
        return out

    def decide(self, losses: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its share of exp(-loss), and the lead over the next one."""
        best = losses.argmin(axis=1)
        low = losses[np.arange(len(losses)), best]
        share = 1.0 / np.exp(low[:, None] - losses).sum(axis=1)
        if losses.shape[1] == 1:
            return best, share, np.full(len(losses), np.inf)
        return best, share, np.partition(losses, 1, axis=1)[:, 1] - low


def fit(counts: dict[str, np.ndarray], smooth: float = 0.5) -> Model:
    """Model from the n-gram counts of each language (orders x buckets)."""
    langs = sorted(k for k, v in counts.items() if v.sum() > 0)
    words = codewords(len(langs))
    if not langs:
        return Model([], words, np.zeros((1, 0), dtype=np.float32), words.astype(float))
    n = 1 << BUCKET_BITS
    c = np.stack([counts[k] for k in langs]).reshape(len(langs), len(ORDERS), n).astype(np.float64) + smooth
    p = c / c.sum(axis=2, keepdims=True)
    odds, margin = [], np.zeros(words.shape)
    for b in range(words.shape[1]):
        on = words[:, b] > 0
        w = np.log(p[on].mean(axis=0) / p[~on].mean(axis=0)) if on.any() and not on.all() else np.zeros(p.shape[1:])
        margin[:, b] = words[:, b] * (p * w[None]).sum(axis=(1, 2))
        odds.append(np.concatenate([w, np.zeros((len(ORDERS), 1))], axis=1).ravel())
    margin = np.maximum(margin, 1e-6)
    return Model(langs, words, np.stack(odds).astype(np.float32), margin / margin.sum(axis=1, keepdims=True))


def _slices(offs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``_SLICE`` bytes (one longer text is a run of its own)."""
    lo = 0
    while lo < len(offs) - 1:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + _SLICE, "right")) - 1)
        yield lo, hi
        lo = hi


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from about ``train_rows`` rows of ``docs`` for each language."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(F.col(lang_col)).agg(F.count(F.lit(1))).collect()}  # one per language
    if not sizes:
        return fit({})
    langs = sorted(sizes)
    share = F.create_map(*[F.lit(v) for k in langs for v in (k, min(1.0, train_rows / sizes[k]))])
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(draw < F.element_at(share, F.col(lang_col)))
    number = {k: i for i, k in enumerate(langs)}
    n = 1 << BUCKET_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), len(ORDERS), n), dtype=np.int64)
        for batch in batches:
            data, offs = utf8_buffer(batch.column(1))
            label = np.array([number[k] for k in batch.column(0).to_pylist()], dtype=np.int64)
            for lo, hi in _slices(offs):
                part, at = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                each = np.repeat(label[lo:hi], np.diff(at))
                for o, order in enumerate(ORDERS):
                    idx = ngram_buckets(part, at, order)
                    ok = idx < n
                    total[:, o] += np.bincount(each[ok] * n + idx[ok], minlength=len(langs) * n).reshape(-1, n)
        flat = total.reshape(len(langs), -1)
        lang, bucket = np.nonzero(flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(flat[lang, bucket])],
            ["lang", "bucket", "n"])

    rows = (sample.select(F.col(lang_col).alias("lang"), F.lower(text_col).alias("text"))
            .mapInArrow(run, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    flat = np.zeros((len(langs), len(ORDERS) * n))
    flat[rows["lang"].to_numpy(dtype=np.int64), rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy()
    return fit(dict(zip(langs, flat)))


def held_out(id_col: str) -> Column:
    """crc32 of the id's text, modulo 3, is 1.  A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             ambiguous: float = AMBIGUOUS, keep: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row.

    ``keep`` returns the three behind the columns of ``docs``; a name that
    ``docs`` has already gets an underscore in front."""
    lang_, score_, close_ = fresh(docs, "lang_pred", "score", "ambiguous") if keep else ("lang_pred", "score", "ambiguous")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8_buffer(batch.column(batch.num_columns - 1))
            lang, score, close = [], [], []
            for lo, hi in _slices(offs):
                if not model.langs:
                    lang += ["und"] * (hi - lo)
                    score += [0.0] * (hi - lo)
                    close += [True] * (hi - lo)
                    continue
                best, share, lead = model.decide(model.losses(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]))
                lang += [model.langs[i] for i in best]
                score += share.tolist()
                close += (lead < ambiguous).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(close, pa.bool_())], [*batch.schema.names[:-1], "lang_pred", "score", "ambiguous"])

    carried = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)] if keep else [F.col(id_col).alias("doc_id")]
    # a text without a letter is judged as empty
    known = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    src = docs.select(*carried, known.alias("_known"), F.when(known, F.lower(text_col)).otherwise("").alias("_lower"))
    schema = ", ".join(f"`{c}` {t}" for c, t in src.dtypes[:-1]) + ", lang_pred string, score double, ambiguous boolean"
    out = src.mapInArrow(run, schema)
    first = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)] if keep else [F.col("doc_id")]
    return out.select(*first, F.when(F.col("_known"), F.col("lang_pred")).otherwise("und").alias(lang_),
                      F.when(F.col("_known"), F.col("score")).otherwise(0.0).alias(score_),
                      (F.col("_known") & F.col("ambiguous")).alias(close_))
