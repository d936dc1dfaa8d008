"""Containment of large phrase lists (J4): how many of 100,000 and more phrases occur in each text, in one scan.

``sentiment.count_hits`` writes one ``contains`` per phrase into the plan, which is
right for the lists of a lexicon.  Here the list is data.  Two ways, chosen by the caller:

* :func:`count_phrases` builds an Aho-Corasick automaton once per Python worker from a broadcast
  list and walks each text once, over Arrow batches.  The list must fit: at most ``MAX_BYTES``.
* :func:`count_phrases_joined` has no such limit: phrases are joined by their first ``gram`` bytes with the distinct
  grams of each text, then compared in full.  A bitmap of the listed grams, of one size for lists of any length, keeps
  the grams that no phrase begins with out of the join.

Both count as ``count_hits`` does: presence, not occurrences; a phrase that is listed
twice counts twice; null text gives 0; the empty phrase is in every text; case matters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

MAX_BYTES = 64 << 20
SLOT_BITS = 22  # a bitmap of 512 KB for each length of grams, at most eight
BLOCK = 1 << 18  # bytes of text that are turned into grams at a time
_AUTOMATA: dict = {}  # per Python worker: broadcast id → (automaton, hits of the empty phrase)


def _automaton(shared):
    import ahocorasick

    found = _AUTOMATA.get(shared[0])
    if found is None:
        times: dict[str, int] = {}
        for p in shared[1].value:
            times[p] = times.get(p, 0) + 1
        empty = times.pop("", 0)
        a = ahocorasick.Automaton()
        for k, (p, n) in enumerate(sorted(times.items())):
            a.add_word(p, (k, n))
        if times:
            a.make_automaton()
        _AUTOMATA.clear()  # one list at a time stays in a worker's memory
        found = _AUTOMATA[shared[0]] = (a if times else None, empty)
    return found


def count_phrases(df: DataFrame, phrases: Sequence[str], text: str = "cleaned", out: str = "hits") -> DataFrame:
    """``df`` with the number of listed phrases in ``text`` (automaton)."""
    size = sum(len(p.encode("utf-8")) for p in phrases)
    if size > MAX_BYTES:
        raise ValueError(f"{size} bytes of phrases: use count_phrases_joined")
    spark = df.sparkSession
    ship(spark)
    b = spark.sparkContext.broadcast(list(phrases))
    shared = (f"{spark.sparkContext.applicationId}-{b._jbroadcast.id()}", b)
    at = df.columns.index(text)
    names = [f"c{i}" for i in range(len(df.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, empty = _automaton(shared)
        for batch in batches:
            hits = []
            for t in batch.column(at).to_pylist():
                if t is None:
                    hits.append(empty)
                elif automaton is None:
                    hits.append(empty)
                else:
                    hits.append(empty + sum(n for _, n in {v for _, v in automaton.iter(t)}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, pa.int32())], [*names, "hits"])

    src = df.toDF(*names)
    schema = ", ".join(f"{n} {t}" for n, t in src.dtypes) + ", hits int"
    return src.mapInArrow(run, schema).toDF(*df.columns, out)


def _bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls and the offsets of its rows."""
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    offs = np.frombuffer(arr.buffers()[1], kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64) if len(arr) else np.zeros(1, np.int64)
    return np.frombuffer(arr.buffers()[2] or b"", np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def _windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each byte, as a number; zeros follow the end."""
    padded = np.zeros(len(data) + 15, np.uint8)
    padded[:len(data)] = data
    out = np.empty((len(data) + 7) // 8 * 8, np.uint64)
    for k in range(8):
        out[k::8] = np.frombuffer(padded, "<u8", len(out) // 8, offset=k)
    return out[:len(data)]


def _cut(windows: np.ndarray, length: int) -> np.ndarray:
    return windows & np.uint64((1 << (8 * length)) - 1)


def _slots(grams: np.ndarray) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _with_gram(listed: DataFrame, gram: int) -> DataFrame:
    """``p, times``, the length in bytes of the phrase's gram, the gram as a number and its slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = _bytes(batch.column(0))
            size = np.minimum(np.diff(offs), gram)
            first = np.append(_windows(data), np.uint64(0))[offs[:-1]]  # the empty phrase may begin at the end
            g = np.zeros(len(size), np.uint64)
            for n in range(1, gram + 1):
                g[size == n] = _cut(first[size == n], n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(size, pa.int32()), pa.array(g.view(np.int64)), pa.array(_slots(g))],
                ["p", "times", "n", "g", "slot"])

    return listed.select("p", "times").mapInArrow(run, "p string, times long, n int, g long, slot long")


def _text_grams(docs: DataFrame, maps, empty: bool) -> DataFrame:
    """``k, t`` and the distinct grams of the text that the bitmaps know (length -> bitmap, broadcast)."""
    def hits(data: np.ndarray, offs: np.ndarray, known: dict) -> tuple[np.ndarray, np.ndarray]:
        rows, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for at in range(0, len(data), BLOCK):
            w = _windows(data[at:at + BLOCK + 7])[:BLOCK]
            for n, bits in known.items():
                g = _cut(w, n)
                pos = np.flatnonzero(bits[_slots(g)])
                row = np.searchsorted(offs, pos + at, "right") - 1
                inside = pos + at + n <= offs[row + 1]  # no gram reaches into the next text
                row, g = row[inside], g[pos[inside]]
                order = np.lexsort((g, row))
                row, g = row[order], g[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (g[1:] != g[:-1])
                rows.append(row[new])
                grams.append(g[new])
        return np.concatenate(rows), np.concatenate(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n: np.unpackbits(b.view(np.uint8), bitorder="little").astype(bool) for n, b in maps.value.items()}
        for batch in batches:
            data, offs = _bytes(batch.column(1))
            row, g = hits(data, offs, known)
            if empty:
                row, g = np.append(row, np.arange(batch.num_rows)), np.append(g, np.zeros(batch.num_rows, np.uint64))
            order = np.lexsort((g, row))
            row, g = row[order], g[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (g[1:] != g[:-1])
            row, g = row[new], g[new]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(g.view(np.int64)))], ["k", "t", "grams"])

    return docs.mapInArrow(run, f"k {dict(docs.dtypes)['k']}, t string, grams array<long>")


def count_phrases_joined(df: DataFrame, phrases: DataFrame, key: str, text: str = "cleaned", phrase: str = "phrase",
                         out: str = "hits", gram: int = 4) -> DataFrame:
    """``key`` and the number of listed phrases in ``text`` (join); ``key`` must be unique, ``phrases`` is a table.

    A text meets only phrases that begin with one of its grams of ``gram`` bytes (at most 8); phrases shorter than that
    have their own length's grams.  A gram that many phrases share is split by the adaptive join."""
    spark, gram = df.sparkSession, max(0, min(gram, 8))
    ship(spark)
    listed = phrases.filter(F.col(phrase).isNotNull()).groupBy(F.col(phrase).alias("p")).agg(F.count(F.lit(1)).alias("times"))
    listed = _with_gram(listed, gram)
    words = listed.groupBy("n", F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))
    maps: dict[int, np.ndarray] = {}
    for r in words.collect():  # at most 65,536 words for each of ``gram`` lengths
        maps.setdefault(r["n"], np.zeros((1 << SLOT_BITS) // 64, np.int64))[r["word"]] = r["bits"]
    empty = maps.pop(0, None) is not None
    docs = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    grams = _text_grams(docs, spark.sparkContext.broadcast(maps), empty)
    met = grams.select("k", "t", F.explode("grams").alias("g")).join(listed.select("p", "times", "g"), "g")
    hits = met.filter(F.col("t").contains(F.col("p"))).groupBy("k").agg(F.sum("times").alias("h"))
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # no name of ``df`` meets ours
    at = plain[f"c{df.columns.index(key)}"]
    joined = plain.join(hits, at.eqNullSafe(hits["k"]), "left")
    return joined.select(*plain.columns, F.coalesce("h", F.lit(0)).cast("int")).toDF(*df.columns, out)
