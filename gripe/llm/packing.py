"""Best-fit packing by length patterns and non-negative least squares.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
Only the histogram of piece lengths (at most ``capacity`` counts) goes to the
driver.  There, few-document patterns that fill a sequence exactly are
enumerated, their repeat counts are fitted to the histogram by non-negative
least squares and rounded down, and the residual is packed best-fit decreasing,
many equal pieces at a time.  The result is a table of patterns, not of
documents: a piece finds its sequence from its length and its rank among the
pieces of that length.  Ranks come from counts per (length, id-hash bucket), so
a length that a third of all pieces share is split.

Defined cases: null text is empty and becomes the single end token; rows with
equal ids are separate documents; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage_table

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
MAX_CACHED_WORDS = 550_000
ROWS_PER_BUCKET = 500_000

# --- tokens -------------------------------------------------------------------

#: The tokenizer's own split pattern, written out for lower-cased Latin-1 text.
_LETTERS = "a-zªµºß-öø-ÿ"
_DIGITS = "0-9²³¹¼½¾"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\\s{_LETTERS}{_DIGITS}]+")
def _plain(text: str) -> bool:
    """Whether the word pattern holds for ``text``: Latin-1 without odd white space and special-token strings."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        if "\x85" in text:
            return False
    return not any(c in text for c in ("<|", "\x1c", "\x1d", "\x1e", "\x1f"))


class WordTokenizer:
    """Token ids as little-endian 32-bit bytes.

    The tokenizer encodes each word of its split pattern on its own, so words
    are encoded once and remembered (``MAX_CACHED_WORDS`` at most)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.words = Tokenizer(self.full.model)  # the same model, not a second copy
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.full.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Encode words that are not remembered, and remember them."""
        found: dict[str, bytes] = {}
        lines = [" ".join(words[i:i + 500]) for i in range(0, len(words), 500)]
        for at, e in enumerate(self.words.encode_batch_fast(lines, add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            raw, start = ids.tobytes(), 0
            for w, stop in zip(words[at * 500:(at + 1) * 500], cuts.tolist()):
                found[w] = raw[start:stop]
                start = stop
        if len(self.known) + len(found) > MAX_CACHED_WORDS:
            self.known.clear()
        self.known.update(found)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [_WORDS.findall(t.lower()) if _plain(t) else None for t in texts]
        seen: set[str] = set()
        for ws in split:
            seen.update(ws or ())
        # one look into the large table for each distinct word; the words of the texts use the small one
        words = list(seen)
        here = dict(zip(words, map(self.known.get, words)))
        new = [w for w, ids in here.items() if ids is None]
        if new:
            here.update(self._learn(new))
        at = here.__getitem__
        out = [b"".join(map(at, ws)) if ws is not None else b"" for ws in split]
        for i, ws in enumerate(split):
            if ws is None:
                out[i] = np.array(self.full.encode(texts[i], add_special_tokens=False).ids, dtype="<u4").tobytes()
        return out


_TOKENIZERS: dict[str, WordTokenizer] = {}  # one per Python worker


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenize_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                    tokenizer: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit) for every piece of every document."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    end = np.array([END_ID], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                docs_, pieces, starts, lengths, ids = [], [], [], [], []
                for doc, raw in zip(part.column(0).to_pylist(), tok.encode([t or "" for t in part.column(1).to_pylist()])):
                    raw += end
                    for k, lo in enumerate(range(0, len(raw), 4 * capacity)):
                        cut = raw[lo:lo + 4 * capacity]
                        docs_.append(doc)
                        pieces.append(k)
                        starts.append(lo // 4)
                        lengths.append(len(cut) // 4)
                        ids.append(cut)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs_, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())], names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


# --- patterns -----------------------------------------------------------------

def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (a, b, c) of present lengths, a >= b >= c, that fill a sequence exactly; pairs have c = 0."""
    have = np.zeros(capacity + 1, dtype=bool)
    have[lengths] = True
    have[0] = True  # a missing third document
    out = []
    for b in lengths[lengths < capacity]:
        c = np.arange(0, min(b, capacity - b) + 1)
        a = capacity - b - c
        ok = have[c] & have[np.clip(a, 0, capacity)] & (a >= b)
        out.append(np.stack([a[ok], np.full(ok.sum(), b), c[ok]], axis=1))
    return np.concatenate(out).astype(np.int64) if out else np.zeros((0, 3), dtype=np.int64)


def nnls_counts(patterns: np.ndarray, hist: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Non-negative repeat counts x that fit ``sum of x over patterns holding L`` to ``hist[L]``.

    Multiplicative updates (Lee and Seung 2001) keep x non-negative and never raise the squared error."""
    weight = (patterns > 0).astype(np.float64)
    h = hist.astype(np.float64)
    h[0] = 0.0
    gain = (h[patterns] * weight).sum(axis=1)
    x = gain / np.maximum(np.bincount(patterns.ravel(), weight.ravel(), len(hist))[patterns].max(axis=1), 1.0) / 3.0
    for _ in range(rounds):
        made = np.bincount(patterns.ravel(), (weight * x[:, None]).ravel(), len(hist))
        x *= gain / np.maximum((made[patterns] * weight).sum(axis=1), 1e-9)
    return x


def best_fit(hist: np.ndarray, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit decreasing over a histogram: ``(((length, times), ...), sequences)``; equal pieces move together."""
    free: dict[int, list] = {}  # free space -> [(pattern, sequences)]
    for length in np.flatnonzero(hist)[::-1].tolist():
        n = int(hist[length])
        while n:
            space = min((s for s in free if s >= length), default=None)
            if space is None:
                each = min(capacity // length, n)
                whole, rest = divmod(n, each)
                free.setdefault(capacity - each * length, []).append((((length, each),), whole))
                if rest:
                    free.setdefault(capacity - rest * length, []).append((((length, rest),), 1))
                break
            pattern, count = free[space].pop()
            if not free[space]:
                del free[space]
            each = min(space // length, n)
            used = min(count, n // each)
            free.setdefault(space - each * length, []).append((pattern + ((length, each),), used))
            if count > used:
                free.setdefault(space, []).append((pattern, count - used))
            n -= used * each
    return [p for group in free.values() for p in group]


def plan(hist: np.ndarray, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ``(((length, times), ...), sequences)`` that place every piece of the histogram."""
    left = hist.astype(np.int64).copy()
    out = []
    if left[capacity]:
        out.append((((capacity, 1),), int(left[capacity])))
        left[capacity] = 0
    patterns = exact_patterns(np.flatnonzero(left), capacity)
    if len(patterns):
        x = nnls_counts(patterns, left)
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 1:
                break
            runs: dict[int, int] = {}
            for v in patterns[k].tolist():
                if v:
                    runs[v] = runs.get(v, 0) + 1
            n = min([int(x[k])] + [int(left[v]) // m for v, m in runs.items()])
            if n:
                out.append((tuple(runs.items()), n))
                for v, m in runs.items():
                    left[v] -= n * m
    return out + best_fit(left, capacity)


def slots(patterns: list, capacity: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset, times): where the pieces of a length go, by rank."""
    rank = [0] * (capacity + 1)
    seq, rows = 0, []
    for runs, n in patterns:
        offset = 0
        for length, times in runs:
            rows.append((length, rank[length], seq, offset, times))
            rank[length] += n * times
            offset += length * times
        seq += n
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def place(pieces: DataFrame, capacity: int = CAPACITY, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``pieces`` (doc_id, piece, length, any others) with ``sequence_id, offset``.  ``pieces`` should be a written table."""
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    hist = np.zeros(capacity + 1, dtype=np.int64)
    for r in counts:
        hist[r["length"]] = r["n"]
    table = slots(plan(hist, capacity), capacity)

    buckets = max(8, -(-int(hist.sum()) // rows_per_bucket))
    keyed = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    ahead = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = keyed.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("c")).select(
        "length", "_b", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("_first"))
    rest = [c for c in pieces.columns if c not in ("length", "doc_id", "piece")]
    own = F.row_number().over(Window.partitionBy("length", "_b").orderBy("doc_id", "piece", *rest)) - 1
    ranked = (keyed.withColumn("_own", own).join(first, ["length", "_b"])
              .withColumn("_rank", F.col("_first") + F.col("_own")).select(*pieces.columns, "_rank"))
    names = pieces.columns
    at_len, at_rank = names.index("length"), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo = np.searchsorted(table[:, 0], np.arange(capacity + 2))
        for b in batches:
            length, rank = b.column(at_len).to_numpy(), b.column(at_rank).to_numpy()
            row = np.empty(len(length), dtype=np.int64)
            for v in np.unique(length):
                mine = length == v
                row[mine] = lo[v] + np.searchsorted(table[lo[v]:lo[v + 1], 1], rank[mine], "right") - 1
            t = table[row]
            nth = rank - t[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:at_rank], pa.array(t[:, 2] + nth // t[:, 4]), pa.array(t[:, 3] + nth % t[:, 4] * length)],
                [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         tokenizer: str | None = None, digest: bool = False) -> DataFrame:
    """Tokenise, cut and place ``docs``: ``doc_id, piece, start, length, ids, sequence_id, offset``.

    ``digest=True`` carries ``ids_crc32`` in place of the ids."""
    pieces = tokenize_pieces(docs, id_col, text_col, capacity, tokenizer)
    if digest:
        pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return place(stage_table(pieces, "pack-pieces"), capacity)
