"""SimHash near-dedup by tiled exact comparison.

Distinct fingerprints are dealt into tiles by the population counts of their
four 16-bit words.  Two fingerprints within ``radius`` bits have counts that
differ by at most ``radius`` in total, so only such tile pairs are compared,
each with numpy exclusive-or and bit counts over whole blocks.  A tile with
many fingerprints is split into blocks of bounded size.  A block pair passes on
a spanning forest of its links, so a large group of near copies costs one link
per member and block pair rather than all pairs, and loses no member.

Defined cases: null and empty texts have fingerprint zero and link like any
other; copies share one fingerprint; a null id is never the smallest of a
group (a group with null ids only has a null component); an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table, text_or_empty
from .components import components, forest

SHINGLE = 3
RADIUS = 2
BLOCK = 2048
_SLICE = 1 << 16


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = 42) -> int:
    """64-bit SimHash of the lower-cased words: a bit is set if more than half the shingle hashes have it."""
    words = data.lower().split()  # bytes: A-Z only, white space 0x20 and 0x09-0x0D
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = list(zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(spans), _SLICE):
        part = [digest(joined[a:b], seed) for a, b in spans[at:at + _SLICE]]
        h = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(h, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(spans), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` (the fingerprint as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(np.array(fp, dtype=np.uint64).view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])

    text = text_or_empty(text_col)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                      F.encode(text, "UTF-8").alias("text"))
    return src.mapInArrow(run, "doc_id long, text_hash long, fp long")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with all their columns.

    A row is found again by its id and the hash of its text.  Rows whose id is
    null stay when no row of their component has an id."""
    found = simhash_near_dedup(docs, id_col, text_col, shingle, radius)
    go = stage_table(found.filter("NOT kept").select("doc_id", "text_hash").distinct(), "simhash-go")
    same = docs[id_col].eqNullSafe(go["doc_id"]) & (F.xxhash64(text_or_empty(docs[text_col])) == go["text_hash"])
    return docs.join(go, same, "left_anti")


def _near_tiles(radius: int) -> list[tuple[int, ...]]:
    """Count differences of one half of the tile pairs within the radius (a pair is met from one side only)."""
    steps = product(range(-radius, radius + 1), repeat=4)
    return [d for d in steps if sum(map(abs, d)) <= radius and d >= (0, 0, 0, 0)]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_a, out_b = [], []
            left, right, same = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            for k in range(batch.num_rows):
                a = left[k].values.to_numpy().view(np.uint64)
                b = right[k].values.to_numpy().view(np.uint64)
                i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
                if same[k]:
                    i, j = i[i < j], j[i < j]
                    nodes = a
                else:
                    j = j + len(a)
                    nodes = np.concatenate((a, b))
                if not len(i):
                    continue
                root = forest(i, j, len(nodes))
                hung = np.flatnonzero(root != np.arange(len(nodes)))
                out_a.append(nodes[hung].view(np.int64))
                out_b.append(nodes[root[hung]].view(np.int64))
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))],
                                                 ["a", "b"])

    return run


def near_links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that connect exactly the fingerprints ``fp`` within ``radius`` bits of each other."""
    words = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(4)]
    tiles = distinct.select("fp", *[w.alias(f"p{k}") for k, w in enumerate(words)])
    p = ["p0", "p1", "p2", "p3"]
    # at most 17^4 tiles, whatever the input
    sizes = tiles.groupBy(*p).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    blocks = (tiles.join(sizes, p).withColumn("blk", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
              .groupBy(*p, "blk").agg(F.array_sort(F.collect_list("fp")).alias("fps")))
    code = F.concat_ws("-", *p, "blk")
    blocks = stage_table(blocks.withColumn("id", code), "simhash-blocks")
    # the block pairs of all tile pairs are dealt out as short rows first; then each side's array is fetched by its id, so
    # the pairs of one full tile spread over many tasks
    names = blocks.select("id", *p, "blk")
    steps = F.explode(F.array(*[F.struct(*[F.lit(v).alias(f"d{k}") for k, v in enumerate(d)])
                                for d in _near_tiles(radius)])).alias("d")
    left = names.select("*", steps).select(
        F.col("id").alias("lid"), F.col("blk").alias("lblk"),
        (F.abs("d.d0") + F.abs("d.d1") + F.abs("d.d2") + F.abs("d.d3") == 0).alias("home"),
        *[(F.col(f"p{k}") + F.col(f"d.d{k}")).alias(f"p{k}") for k in range(4)])
    pairs = (left.join(names, p).filter("NOT home OR lblk <= blk")
             .select("lid", F.col("id").alias("rid"), F.expr("home AND lblk = blk").alias("same")))
    pairs = stage_table(pairs.repartition("lid", "rid"), "simhash-pairs")
    dealt = (pairs.join(blocks.select(F.col("id").alias("lid"), F.col("fps").alias("left")), "lid")
             .join(blocks.select(F.col("id").alias("rid"), F.col("fps").alias("right")), "rid")
             .select("left", "right", "same"))
    return dealt.mapInArrow(_compare(radius), "a long, b long")


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``doc_id, fingerprint, component_id, kept, text_hash`` for every row of ``docs``."""
    fps = stage_table(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    nodes = stage_table(nodes, "simhash-nodes")
    linked = components(stage_table(near_links(nodes.select("fp"), radius, block), "simhash-links"))
    at = nodes.join(linked, nodes["fp"] == linked["node"], "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component"))
    first = at.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = stage_table(at.join(first, "component").select("fp", "component_id"), "simhash-classes")
    return fps.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")
