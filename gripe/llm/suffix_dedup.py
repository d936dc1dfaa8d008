"""Removal of repeated byte strings with suffix arrays built by the difference-cover algorithm.

Every byte that lies in a string of ``length`` bytes which also starts earlier
(in a document with a smaller id, or before in the same document) is removed.
A *window* is such a string at one start.

Equal windows must meet in one suffix array, but no array can span the corpus.
So the windows are dealt out by content:

1. Anchors.  Of the 16-byte grams inside a window, the one with the smallest
   hash is its anchor (winnowing, Schleimer et al. 2003).  Equal windows have
   equal anchors, whatever lies around them.
2. Copies.  Documents are cut into units at content-defined places.  Units with
   equal bytes (128-bit hash, the 99 bytes behind a unit included) have equal
   windows one by one, so all but the first are removed at once and only the
   first goes on: a passage with a million copies costs one.
3. Anchors that occur once cannot have an equal window and go no further.
4. The windows of each remaining anchor, with their bytes, are shuffled by the
   anchor.  Tasks join whole anchors into shares of bounded size and build each
   share's suffix array (equal contexts once) with the difference-cover algorithm modulo 3: sort and
   name the sampled triples, recurse on the names until they cover a window,
   sort the remaining suffixes by (symbol, rank of the next), merge.  Adjacent
   suffixes are compared over ``length`` bytes; of equal windows the earliest
   stays.
5. An anchor with more than ``SHARE_ANCHORS`` occurrences does not fit into a
   share.  Equal contexts of it are collapsed first.  The others are split by a longer
   key: up to 16 neighbouring windows (counted from the anchor) share a core of at
   least 85 bytes, and equal windows have equal cores.  Cores that occur once are
   dropped, cores that fit go to shares as above, and the rest is
   collapsed and split again with blocks of 8, 4, 2 and 1 windows, until a core is the window
   itself.  A context has at most six rows in the first round, and only blocks across the
   edge of a common passage go on, so nowhere is there a row per window.

Defined cases: null text is empty; documents shorter than a window keep all
bytes; a null id counts as the last; rows with equal id and text are one
document and get equal results; of different texts with one id the one with
the smaller hash counts as earlier; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, stage_path, stage_table, text_or_empty, utf8_buffer

LENGTH = 100
GRAM = 16
UNIT = 512  # mean distance of content-defined cuts
UNIT_MAX = 4096  # a cut at the latest
PIECE = 1 << 19  # bytes handled at once; longer texts go in overlapping pieces
SHARE_ANCHORS = 2048
SHARE_BYTES = 1_000_000
BLOCK = 16  # windows of a block of a hot anchor in the first round
_LAST = (1 << 63) - 1

_rng = np.random.default_rng(5)
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS:
        n = PIECE + 4 * UNIT_MAX
        for name, v in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n, v, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes from each position (polynomial modulo 2^64, then mixed)."""
    up, down = _powers()
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_CODE[data] * up[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[:n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of ``width`` values (van Herk: prefix and suffix minima of blocks)."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    full[:len(x)] = x
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def cut(data: np.ndarray, offs: np.ndarray, length: int = LENGTH):
    """Units and runs of the texts ``data[offs[k]:offs[k+1]]`` laid side by side.

    Returns (unit starts, unit counts of windows, first run of each unit, run
    starts, run hashes).  The windows of a run have the same anchor; units end
    where runs end."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    h = gram_hashes(data)
    place = np.arange(len(h), dtype=np.uint64)
    low = np.uint64((1 << 21) - 1)
    anchor = (sliding_min((h & ~low) | place, length - GRAM + 1) & low).astype(np.int64)
    has = np.diff(offs) >= length
    first, stop = offs[:-1][has], offs[1:][has] - (length - 1)  # window starts of each text
    if not len(first):
        return none, none, none, none, none.astype(np.uint64)
    inside = np.zeros(len(anchor) + 1, dtype=np.int8)
    np.add.at(inside, first, 1)
    np.add.at(inside, stop, -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = np.empty(len(anchor), dtype=bool)
    new[0] = True
    np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
    new[first] = True
    runs = np.flatnonzero(new & inside)
    # a unit begins at the first run behind a content-defined cut, at each text, and after UNIT_MAX bytes
    cuts = np.flatnonzero((h >> np.uint64(20)) % np.uint64(UNIT) == 0) + GRAM
    begin = np.zeros(len(runs) + 1, dtype=bool)
    begin[np.searchsorted(runs, cuts)] = True
    begin[np.searchsorted(runs, first)] = True
    begin = np.flatnonzero(begin[:-1])
    gap = np.diff(np.append(runs[begin], len(data)))
    wide = np.flatnonzero(gap > UNIT_MAX)
    if len(wide):
        more = [np.searchsorted(runs, np.arange(runs[begin[k]] + UNIT_MAX, runs[begin[k]] + gap[k], UNIT_MAX)) for k in wide]
        begin = np.unique(np.concatenate([begin, *more]))
        begin = begin[begin < len(runs)]
    ends = stop[np.searchsorted(first, runs[begin], "right") - 1]  # the last unit of a text ends with its windows
    units = runs[begin]
    counts = np.minimum(np.append(units[1:], len(data)), ends) - units
    return units, counts, begin, runs, h[anchor[runs]]


def _pieces(data: np.ndarray, offs: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, offsets of the rows' texts, their begins): short texts together, long ones in overlapping pieces."""
    lo = 0
    while lo < len(offs) - 1:
        hi = int(np.searchsorted(offs, offs[lo] + PIECE, "right")) - 1
        if hi > lo:
            yield lo, hi, offs[lo:hi + 1], np.zeros(hi - lo, dtype=np.int64)
            lo = hi
            continue
        size = int(offs[lo + 1] - offs[lo])
        for at in range(0, size - length + 1, PIECE - length):
            end = min(size, at + PIECE - 1)
            yield lo, lo + 1, offs[lo] + np.array([at, end]), np.array([at])
        lo += 1


def _units(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = utf8_buffer(b.column(2))
            key, tie = b.column(0).to_numpy(), b.column(1).to_numpy()
            for lo, hi, at, begins in _pieces(data, offs, length):
                part = data[at[0]:at[-1]]
                units, counts, first, runs, fps = cut(part, at - at[0], length)
                if not len(units):
                    continue
                raw = part.tobytes()
                digest = [hashlib.blake2b(raw[u:u + c + length - 1], digest_size=16).digest()
                          for u, c in zip(units.tolist(), counts.tolist())]
                row = np.searchsorted(at - at[0], units, "right") - 1
                listed = np.append(first, len(runs)).astype(np.int32)
                within = (runs - np.repeat(units, np.diff(listed))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest, pa.binary()), pa.array(key[lo + row]), pa.array(tie[lo + row]),
                     pa.array(units - (at - at[0])[row] + begins[row]), pa.array(counts),
                     pa.ListArray.from_arrays(pa.array(listed), pa.array(within)),
                     pa.ListArray.from_arrays(pa.array(listed), pa.array(fps.view(np.int64)))],
                    ["unit", "key", "tie", "start", "windows", "runs", "fps"])

    return run


# --- the difference-cover algorithm ---------------------------------------------

def suffix_order(text: np.ndarray, reach: int) -> np.ndarray:
    """Positions of ``text`` (non-negative symbols) sorted by their suffixes, at least as far as ``reach`` symbols.

    Symbols behind the end count as 0.  Difference cover {1, 2} modulo 3.
    Three symbols must fit into 63 bits, so texts are shorter than 2^20."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), dtype=np.int64)
    t = np.concatenate([text.astype(np.int64), np.zeros(6, dtype=np.int64)])
    base = int(t.max()) + 1
    m0, m1, m2 = -(-n // 3), (n + 2) // 3, (n + 1) // 3  # positions 0, 3, ..; 1, 4, ..; 2, 5, .. up to n

    def every(x: np.ndarray, at: int, m: int) -> np.ndarray:
        return x[at:at + 3 * m:3]

    # sampled triples; position n belongs to the sample, so that an end marker divides the two halves
    triple = np.concatenate([(every(t, k, m) * base + every(t, k + 1, m)) * base + every(t, k + 2, m) for k, m in ((1, m1), (2, m2))])
    order = np.argsort(triple)  # equal triples share a name, so their order is free
    ordered = triple[order]
    name = np.empty(len(triple), dtype=np.int64)
    name[order] = np.cumsum(np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
    if int(name.max()) < len(name) and reach > 3:
        order = suffix_order(name, -(-reach // 3))
    place = np.empty(len(name), dtype=np.int64)
    place[order] = np.arange(1, len(name) + 1)
    rank = np.zeros(n + 9, dtype=np.int64)
    rank[1:1 + 3 * m1:3], rank[2:2 + 3 * m2:3] = place[:m1], place[m1:]

    # the remaining suffixes, sorted by symbol and by the rank of the sampled suffix behind it
    many = len(name) + 1
    pair = every(t, 0, m0) * many + every(rank, 1, m0)
    by = np.argsort(pair)
    # merge: against class 1 one symbol and a rank decide, against class 2 two symbols and a rank
    k1, k2 = (n + 1) // 3, n // 3  # without position n
    c1 = np.searchsorted(np.sort(every(t, 1, k1) * many + every(rank, 2, k1)), pair[by], "left")
    long = ((every(t, 0, m0) * base + every(t, 1, m0)) * many + every(rank, 2, m0))[by]
    c2 = np.searchsorted(np.sort((every(t, 2, k2) * base + every(t, 3, k2)) * many + every(rank, 4, k2)), long, "left")
    at = np.arange(m0) + np.maximum.accumulate(c1 + c2)
    free = np.ones(n, dtype=bool)
    free[at] = False
    out = np.empty(n, dtype=np.int64)
    out[at] = 3 * by
    picked = np.where(order < m1, 3 * order + 1, 3 * (order - m1) + 2)
    out[free] = picked[picked < n]
    return out


def equal_classes(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions ``starts`` in suffix order, and where a new class of equal windows begins."""
    wanted = np.zeros(len(text), dtype=bool)
    wanted[starts] = True
    order = suffix_order(text.astype(np.int64) + 1, length)
    order = order[wanted[order]]
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    new = np.ones(len(order), dtype=bool)
    for lo in range(0, len(order) - 1, 1 << 16):  # compare adjacent prefixes
        hi = min(len(order) - 1, lo + (1 << 16))
        here = windows[order[lo:hi + 1]]
        new[lo + 1:hi + 1] = (here[1:] != here[:-1]).any(axis=1)
    return order, new


def repeats_of(contexts: list[bytes], counts: np.ndarray, key: np.ndarray, tie: np.ndarray, at: np.ndarray, length: int):
    """Runs (context, first, last) of windows that are not the earliest of their class.

    Context k holds ``counts[k]`` windows; its first starts at ``at[k]`` of document (key, tie)[k]."""
    order = np.lexsort((at, tie, key))  # contexts in reading order
    first: dict[bytes, int] = {}  # of equal contexts all but the first are repeats throughout
    copy = np.array([first.setdefault(contexts[k], k) != k for k in order.tolist()], dtype=bool)
    copies, order = order[copy], order[~copy]
    text = np.frombuffer(b"".join(contexts[k] for k in order), dtype=np.uint8)
    sizes = np.array([len(contexts[k]) for k in order])
    begin = np.cumsum(sizes) - sizes
    many = counts[order]
    starts = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
    sa, new = equal_classes(text, starts, length)
    klass = np.cumsum(new) - 1
    earliest = np.minimum.reduceat(sa, np.flatnonzero(new))  # positions are in reading order
    late = np.sort(sa[sa != earliest[klass]])
    ctx = np.searchsorted(begin, late, "right") - 1
    new = np.ones(len(late), dtype=bool)
    new[1:] = (np.diff(late) != 1) | (np.diff(ctx) != 0)
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(late))[:len(lo)] - 1
    at = begin[ctx[lo]]
    return (np.concatenate([copies, order[ctx[lo]]]), np.concatenate([np.zeros(len(copies), np.int64), late[lo] - at]),
            np.concatenate([counts[copies] - 1, late[hi] - at]))


_SPAN = ["key", "tie", "start", "stop"]


def _shares(length: int):
    """Windows of whole anchors (rows sorted by anchor) → spans of windows that are repeats."""
    def solve(rows: list) -> pa.RecordBatch:
        key, tie, at, n = (np.array([r[c] for r in rows], dtype=np.int64) for c in range(4))
        ctx, lo, hi = repeats_of([r[4] for r in rows], n, key, tie, at, length)
        return pa.RecordBatch.from_arrays([pa.array(key[ctx]), pa.array(tie[ctx]), pa.array(at[ctx] + lo),
                                           pa.array(at[ctx] + hi + length)], _SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, size, group, group_size, last = [], 0, [], 0, None
        for b in batches:
            fps = b.column(0).to_pylist()
            for fp, row in zip(fps, zip(*(b.column(c).to_pylist() for c in range(1, 6)))):
                if fp != last:
                    if size + group_size > SHARE_BYTES and share:
                        yield solve(share)
                        share, size = [], 0
                    share += group
                    size += group_size
                    group, group_size, last = [], 0, fp
                group.append(row)
                group_size += len(row[4])
        if size + group_size > SHARE_BYTES and share:
            yield solve(share)
            share = []
        if share or group:
            yield solve(share + group)

    return run


def _contexts(length: int):
    """Documents with the lists of their remaining anchors → one row per anchor with the bytes of its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(0, b.num_rows, 64):
                part = b.slice(r, 64)
                sizes = np.array([len(x) for x in part.column(3)])
                starts, counts = (part.column(c).flatten().to_numpy() for c in (4, 5))
                ctx: list[bytes] = []
                at = 0
                for text, m in zip(part.column(2), sizes.tolist()):
                    raw = text.as_buffer().to_pybytes()
                    lo = starts[at:at + m]
                    ctx += [raw[i:j] for i, j in zip(lo.tolist(), (lo + counts[at:at + m] + (length - 1)).tolist())]
                    at += m
                yield pa.RecordBatch.from_arrays(
                    [part.column(3).flatten(), pa.array(np.repeat(part.column(0).to_numpy(), sizes)),
                     pa.array(np.repeat(part.column(1).to_numpy(), sizes)), pa.array(starts), pa.array(counts),
                     pa.array(ctx, pa.binary())], ["fp", "key", "tie", "at", "n", "ctx"])

    return run


def anchor_of(ctx: np.ndarray, length: int, gram: int = GRAM) -> int:
    """Where the anchor of the windows of a context lies: the leftmost gram of smallest hash in its first window."""
    h = gram_hashes(ctx[:length], gram) & ~np.uint64((1 << 21) - 1)
    return int(np.argmin(h))


def blocks_of(ctx: bytes, n: int, width: int, length: int) -> list[tuple[int, int, int]]:
    """The ``n`` windows of a context in blocks of at most ``width``: (key of the core, first window, number of windows).

    Blocks are counted from the anchor, and their core is that of a whole block, so equal windows of two contexts are in
    blocks of one key."""
    a = anchor_of(np.frombuffer(ctx, dtype=np.uint8), length)
    out, s = [], 0
    while s < n:
        b = (a - s) // width
        low = a - (b + 1) * width + 1  # first window of the whole block, perhaps outside the context
        stop = min(n, low + width)
        core = ctx[low + width - 1:low + length]
        key = hashlib.blake2b(core, digest_size=8, salt=(b * 256 + width).to_bytes(8, "little")).digest()
        out.append((int.from_bytes(key, "little", signed=True), s, stop - s))
        s = stop
    return out


def _blocks(length: int, width: int):
    """Contexts → one row per block of their windows, keyed by the block's core."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(0, b.num_rows, 256):
                part = b.slice(r, 256)
                rows = [(fp, key, tie, at + s, m, ctx[s:s + m + length - 1])
                        for key, tie, at, n, ctx in zip(*(part.column(c).to_pylist() for c in range(5)))
                        for fp, s, m in blocks_of(ctx, n, width, length)]
                kinds = (pa.int64(),) * 5 + (pa.binary(),)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["fp", "key", "tie", "at", "n", "ctx"])

    return run


def _collapsed(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The first of equal contexts, and the spans of the others, whose windows are repeats throughout."""
    kept = stage_table(rows.withColumn("c", F.unhex(F.md5("ctx"))), "repeat-hot")
    # written, so that the adaptive join can split a context that occurs very often
    lead = stage_table(kept.groupBy("fp", "c").agg(F.min(F.struct("key", "tie", "at")).alias("lead")), "repeat-hot-lead")
    led = stage_table(kept.join(lead, ["fp", "c"]).withColumn("again", F.struct("key", "tie", "at") != F.col("lead")).drop("lead", "c"),
                      "repeat-hot-led")
    spans = led.filter("again").select("key", "tie", F.col("at").alias("start"), (F.col("at") + F.col("n") + length - 1).alias("stop"))
    return led.filter("NOT again").drop("again"), spans


def _often(keys: DataFrame, share_anchors: int) -> DataFrame:
    """Keys ``fp`` that occur more than once; ``many``: too often for a share.  Written, as joins with it may be skewed."""
    return stage_table(keys.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
                       .select("fp", (F.col("c") > share_anchors).alias("many")), "repeat-often")


def _in_shares(rows: DataFrame, length: int) -> DataFrame:
    return (rows.select("fp", "key", "tie", "at", "n", "ctx").repartition("fp").sortWithinPartitions("fp")
            .mapInArrow(_shares(length), "key long, tie long, start long, stop long"))


def merge_spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return start[first], reach[np.append(first[1:], len(start)) - 1]


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        total, removed, spans, sha, kept_spans = [], [], [], [], []
        for text, lo, hi in zip(b.column(2), b.column(3), b.column(4)):
            raw = memoryview(text.as_buffer())
            digest, n = hashlib.sha256(), len(raw)
            gone, at, runs = 0, 0, []
            if lo.is_valid and len(lo):
                a, z = merge_spans(lo.values.to_numpy(), hi.values.to_numpy())
                runs = list(zip(a.tolist(), z.tolist()))
                for x, y in runs:
                    digest.update(raw[at:x])
                    gone += y - x
                    at = y
            digest.update(raw[at:])
            total.append(n)
            removed.append(gone)
            spans.append(len(runs))
            kept_spans.append([{"start": x, "stop": y} for x, y in runs])
            sha.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(sha, pa.string()),
             pa.array(kept_spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
            ["key", "copies", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 share_anchors: int = SHARE_ANCHORS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` (spans start..stop of removed bytes) per document."""
    if max(SHARE_BYTES, share_anchors * 2 * length) >= 1 << 20:
        raise ValueError("the contexts of share_anchors anchors must stay below 2^20 bytes")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(_LAST)))
    if rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty():
        texts = rows.select("key", F.lit(0).cast("long").alias("tie"), F.lit(1).cast("long").alias("copies"), "text")
    else:  # ids that repeat: equal rows are one document, others are told apart
        once = rows.groupBy("key", "text").agg(F.count(F.lit(1)).alias("copies"))
        tie = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("text"), "text")).cast("long") - 1
        texts = stage_table(once.select("key", tie.alias("tie"), "copies", "text"), "repeat-texts")
    raw = texts.select("key", "tie", F.encode("text", "UTF-8").alias("raw"), "copies")

    spark = docs.sparkSession
    units, all_units = stage_path(texts.select("key", "tie", "text").mapInArrow(
        _units(length), "unit binary, key long, tie long, start long, windows long, runs array<int>, fps array<long>"),
        "repeat-units")
    # the first of equal units goes on; the windows of the others are repeats throughout
    first = units.groupBy("unit").agg(F.min(F.struct("key", "tie", "start", "windows", "runs", "fps")).alias("u"))
    first, first_units = stage_path(first.select("unit", "u.*"), "repeat-first")
    lead = first.select("unit", F.struct("key", "tie", "start").alias("lead"))
    copies = (units.select("unit", "key", "tie", "start", "windows").join(lead, "unit")
              .filter(F.struct("key", "tie", "start") != F.col("lead"))
              .select("key", "tie", "start", (F.col("start") + F.col("windows") + length - 1).alias("stop")))
    copies = stage_table(copies, "repeat-copies")
    discard(spark, all_units)

    # anchors that occur more than once
    ahead = F.expr("concat(slice(runs, 2, size(runs)), array(cast(windows as int)))")
    marks = first.select("key", "tie", "start", F.explode(F.arrays_zip("runs", ahead.alias("ends"), "fps")).alias("r")).select(
        F.col("r.fps").alias("fp"), "key", "tie", (F.col("start") + F.col("r.runs")).alias("at"),
        (F.col("r.ends") - F.col("r.runs")).cast("long").alias("n"))
    often = _often(first.select(F.explode("fps").alias("fp")), share_anchors)
    left = stage_table(marks.join(often, "fp"), "repeat-marks")
    discard(spark, first_units)

    def with_bytes(some: DataFrame) -> DataFrame:
        listed = some.groupBy("key", "tie").agg(F.collect_list(F.struct("fp", "at", "n")).alias("i")).select(
            "key", "tie", F.col("i.fp").alias("fps"), F.col("i.at").alias("ats"), F.col("i.n").alias("ns"))
        return raw.join(listed, ["key", "tie"]).select("key", "tie", "raw", "fps", "ats", "ns").mapInArrow(
            _contexts(length), "fp long, key long, tie long, at long, n long, ctx binary")

    # documents are shuffled by their key here and once more at the end, in one plan: the exchange is reused
    spans = copies.unionByName(_in_shares(with_bytes(left.filter("NOT many")), length))
    width, hot = BLOCK, left.filter("many")
    if not hot.isEmpty():
        rest, again = _collapsed(with_bytes(hot), length)
        spans = spans.unionByName(again)
        while True:
            kept = stage_table(rest.select("key", "tie", "at", "n", "ctx").mapInArrow(
                _blocks(length, width), "fp long, key long, tie long, at long, n long, ctx binary"), "repeat-blocks")
            met = stage_table(kept.join(_often(kept.select("fp"), share_anchors), "fp"), "repeat-blocks-met")
            if width > 1:
                spans = spans.unionByName(_in_shares(met.filter("NOT many"), length))
                met = met.filter("many")
            if met.isEmpty():
                break
            rest, again = _collapsed(met.drop("many"), length)
            spans = spans.unionByName(again)
            if width == 1:  # a core is the window itself: what is left has no equal
                break
            width //= 2

    per = spans.groupBy("key", "tie").agg(F.collect_list("start").alias("lo"), F.collect_list("stop").alias("hi"))
    done = (raw.join(per, ["key", "tie"], "left").select("key", "copies", "raw", "lo", "hi")
            .mapInArrow(_finish, "key long, copies long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                 "removed array<struct<start: long, stop: long>>"))
    out = done.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
    return out.select(F.when(F.col("key") == _LAST, F.lit(None)).otherwise(F.col("key")).cast("long").alias("doc_id"),
                      "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")
