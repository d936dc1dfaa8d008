"""Embedding near-dedup with an inverted multi-index.

Two codebooks, one per half of the vector, form a product grid of cells.  Each
vector traverses the cells in the multi-sequence order (increasing sum of its
two squared half distances) and stops once the sum exceeds its nearest cell's
by a slack that is calibrated for the target recall: on the fitting sample,
vectors are turned to exactly the threshold angle in random directions and the
slack is the quantile of what the traversal needed to meet them.  The size of
the codebooks is the one that costs least on the sample: cells visited (vectors
moved) against vectors compared.  All visited candidates are then verified by
cosine in double precision, block by block.

Only the codebooks are fitted on a bounded sample (``fit_rows``); every vector
is indexed and is a query.  Copies of a vector are one node with a multiplicity.
Visits are short rows without vectors.  Cells and the queries that visit them
are split into blocks of bounded size, block pairs are dealt out before their
vectors are fetched, and a block pair returns link counts and a spanning forest, never its pairs.

Defined cases: vectors that are null, empty, zero, or hold null, NaN or
infinite components link with nothing and are their own component; vectors of
another length than the most common one are compared within their length; a
null id is never the smallest of a group; rows that share an id but not the vector are
vectors of their own, each with its own links; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table
from .components import components, forest

THRESHOLD = 0.9
TARGET_RECALL = 0.97
FIT_ROWS = 20_000
BLOCK = 1024
MIN_CODES = 4
MAX_CODES = 1024
#: What moving a vector to one more cell costs, in comparisons of two vectors.
ROUTE_COST = 500.0


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision (by the largest component first, so nothing overflows)."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        vecs = []
        for v in b.column(1):
            ok = v.is_valid and len(v) > 0 and v.values.null_count == 0
            if ok:
                a = v.values.to_numpy(zero_copy_only=False)
                ok = bool(np.isfinite(a).all() and a.any())
            vecs.append(a.astype("<f8").tobytes() if ok and a.dtype != np.float32 else a.tobytes() if ok else None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(vecs, pa.binary())], ["vec_id", "vec"])


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1)[None, :] - 2.0 * (x @ c.T), axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def half_distances(x: np.ndarray, books: tuple) -> tuple[np.ndarray, np.ndarray]:
    h = x.shape[1] // 2
    out = []
    for part, c in ((x[:, :h], books[0]), (x[:, h:], books[1])):
        out.append(np.maximum((part * part).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2.0 * (part @ c.T), 0.0))
    return out[0], out[1]


def fit_index(sample: np.ndarray, codes: int, threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
              seed: int = 7) -> tuple[tuple, float]:
    """Codebooks of both halves, and the slack of the traversal for the target recall at the threshold angle."""
    rng = np.random.default_rng(seed)
    x = unit(sample)
    h = x.shape[1] // 2
    books = (_kmeans(x[:, :h], codes, rng), _kmeans(x[:, h:], codes, rng))
    probe = x[rng.integers(0, len(x), size=4000)]
    turn = rng.standard_normal(probe.shape)
    turn -= (turn * probe).sum(1, keepdims=True) * probe
    size = np.sqrt((turn * turn).sum(1, keepdims=True))
    turn = np.divide(turn, size, out=np.zeros_like(turn), where=size > 0)
    other = threshold * probe + np.sqrt(1 - threshold * threshold) * turn
    d1, d2 = half_distances(probe, books)
    e1, e2 = half_distances(other, books)
    at = np.arange(len(probe))
    need = d1[at, e1.argmin(1)] + d2[at, e2.argmin(1)] - d1.min(1) - d2.min(1)
    return books, float(np.quantile(need, recall))


def visited(d1: np.ndarray, d2: np.ndarray, slack: float) -> list[np.ndarray]:
    """Per row, the cells ``i * len(d2) + j`` that the multi-sequence traversal meets within the slack, nearest first.

    With both lists sorted, the cells below a bound form a staircase: for each
    code of the first half a prefix of the second half's codes."""
    o1, o2 = np.argsort(d1, axis=1), np.argsort(d2, axis=1)
    k2, out = d2.shape[1], []
    for r in range(len(d1)):
        a, b = d1[r, o1[r]], d2[r, o2[r]]
        bound = a[0] + b[0] + slack
        steps = np.searchsorted(b, bound - a[:max(1, np.searchsorted(a, bound - b[0], "right"))], "right")
        steps[0] = max(1, steps[0])  # the nearest cell, also where rounding would leave it out
        rows = np.repeat(np.arange(len(steps)), steps)
        cols = np.arange(len(rows)) - np.repeat(np.cumsum(steps) - steps, steps)
        order = np.argsort(a[rows] + b[cols], kind="stable")
        out.append((o1[r][rows] * k2 + o2[r][cols])[order])
    return out


def plan_index(sample: np.ndarray, n: int, threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
               route_cost: float = ROUTE_COST, probes: int = 1000) -> tuple[tuple, float]:
    """Codebooks and slack of the size that costs least for ``n`` vectors.

    Small codebooks give large cells (more vectors compared), large ones many visited cells (more vectors moved).
    Both are measured on the sample for doubling sizes: a vector costs its visited cells times ``route_cost`` plus
    the vectors in them.  Sizes are tried until the cost rises."""
    best, codes = None, MIN_CODES
    while codes <= min(MAX_CODES, max(MIN_CODES, len(sample))):
        books, slack = fit_index(sample, codes, threshold, recall)
        d1, d2 = half_distances(unit(sample), books)
        k = d2.shape[1]
        held = np.bincount(d1.argmin(1) * k + d2.argmin(1), minlength=d1.shape[1] * k) * (n / len(sample))
        met = [c[c >= c[0]] for c in visited(d1[:probes], d2[:probes], slack)]
        cost = np.mean([len(c) * route_cost + held[c].sum() for c in met])
        if best and cost >= best[0]:
            break
        best, codes = (cost, books, slack), codes * 2
    return best[1], best[2]


def _route(dim_bytes: int, width: int, books: tuple, slack: float):
    """Own cell and visited cells; of two cells that visit each other only the smaller number visits the larger."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.float32 if width == 4 else np.float64
        for b in batches:
            raw = b.column(1).to_pylist()
            own, cells = np.full(len(raw), -1, dtype=np.int64), [None] * len(raw)
            fit = [i for i, v in enumerate(raw) if len(v) == dim_bytes and books is not None]
            for at in range(0, len(fit), 2048):
                part = fit[at:at + 2048]
                d1, d2 = half_distances(unit(np.stack([np.frombuffer(raw[i], kind) for i in part])), books)
                for i, c in zip(part, visited(d1, d2, slack)):
                    own[i] = c[0]
                    cells[i] = c[c >= c[0]]
            for i, v in enumerate(raw):
                if cells[i] is None:  # other lengths: one cell per length, below the grid
                    own[i] = -1 - len(v)
                    cells[i] = np.array([own[i]])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own), pa.array(cells, pa.list_(pa.int64()))],
                                             ["node", "own", "cells"])

    return run


def _verify(threshold: float, width: int):
    kind = np.float32 if width == 4 else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                qn, qv, qm, qo, mn, mv, mm = (batch.column(c)[row].values for c in range(7))
                q, m = (unit(np.stack([np.frombuffer(v, kind) for v in x.to_pylist()])) for x in (qv, mv))
                qn, qm, mn, mm = (x.to_numpy() for x in (qn, qm, mn, mm))
                own = qo.to_numpy(zero_copy_only=False).astype(bool)
                hit = (q @ m.T >= threshold) & (qn[:, None] != mn[None, :])
                if not hit.any():
                    continue
                i, j = np.nonzero(hit)
                to_q = hit @ mm  # rows of the same cell meet twice, once from either side
                to_m = qm @ (hit & ~own[:, None])
                nodes = np.concatenate((qn, mn))
                root = forest(i, j + len(qn), len(nodes))
                links = np.concatenate((to_q, to_m))
                use = (links > 0) | (root != np.arange(len(nodes)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[use]), pa.array(links[use].astype(np.int64)), pa.array(nodes[root[use]])],
                    ["node", "links", "hook"])

    return run


def _blocks(rows: DataFrame, blk: str, prefix: str) -> DataFrame:
    """The vectors of each (cell, block) side by side."""
    return rows.groupBy("cell", blk).agg(F.collect_list(F.struct("node", "vec", "n", "home")).alias("r")).select(
        "cell", blk, *[F.col(f"r.{c}").alias(prefix + c) for c in ("node", "vec", "n", "home")])


def _block_pairs(routed: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """The block pairs to compare, each with the vectors of both sides.

    Cells, visits and block pairs are dealt out as short rows without vectors; a visit to a cell that holds no other
    vector ends there.  Vectors are fetched by node for the visits that are left."""
    visits = routed.select("node", F.explode("cells").alias("cell"), "own").select(
        "node", "cell", (F.col("cell") == F.col("own")).alias("home"))
    sizes = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("q"), F.sum(F.col("home").cast("long")).alias("m"))
    sizes = stage_table(sizes.filter("m > 0 AND q > 1").select(
        "cell", "m", F.ceil(F.col("q") / block).cast("int").alias("q_parts"),
        F.ceil(F.col("m") / block).cast("int").alias("m_parts")), "emb-cells")
    h = F.xxhash64("node")
    placed = visits.join(sizes, "cell").select(
        "node", "cell", "home", "m", F.pmod(h, F.col("q_parts")).cast("int").alias("q_blk"),
        F.pmod(h, F.col("m_parts")).cast("int").alias("m_blk"))
    full = stage_table(placed.join(nodes.select("node", "vec", "n"), "node"), "emb-visits")
    queries = _blocks(full.filter("NOT home OR m > 1"), "q_blk", "q_")
    members = _blocks(full.filter("home"), "m_blk", "m_")
    pairs = sizes.select("cell", "m_parts", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q_blk"))
    pairs = pairs.repartition("cell", "q_blk").select(
        "cell", "q_blk", F.explode(F.sequence(F.lit(0), F.col("m_parts") - 1)).alias("m_blk"))
    # members first: the queries, many times as many, stay where their blocks were built
    return pairs.join(members, ["cell", "m_blk"]).join(queries, ["cell", "q_blk"]).select(
        "q_node", "q_vec", "q_n", "q_home", "m_node", "m_vec", "m_n")


def embedding_near_dedup(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                         threshold: float = THRESHOLD, recall: float = TARGET_RECALL, fit_rows: int = FIT_ROWS,
                         block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``table``."""
    width = 4 if table.schema[vec_col].dataType.elementType.typeName() == "float" else 8
    rows = stage_table(table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
                       .mapInArrow(_prepare, "vec_id long, vec binary"), "emb-rows")
    found = stage_table(rows.filter("vec IS NOT NULL").groupBy("vec")
                        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n")), "emb-vectors")
    # a vector is known by the smallest id of its copies; where other vectors have that id, too, by its hash
    shared = found.groupBy("least").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("least").alias("s"))
    known = found.join(shared, F.col("least") == F.col("s"), "left")
    nodes = stage_table(known.select(F.when(F.col("s").isNull() & F.col("least").isNotNull(), F.col("least"))
                                     .otherwise(F.xxhash64("vec")).alias("node"), "vec", "n", "least"), "emb-nodes")

    common = nodes.groupBy(F.length("vec").alias("b")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "b").first()
    books, slack, size = None, 0.0, 0
    if common and common["b"] >= 2 * width:
        size = common["b"]
        sample = (nodes.filter(F.length("vec") == size).orderBy(F.xxhash64("vec")).limit(fit_rows)
                  .select("vec").collect())  # bounded by fit_rows
        kind = np.float32 if width == 4 else np.float64
        books, slack = plan_index(np.stack([np.frombuffer(r["vec"], kind) for r in sample]), common["c"], threshold, recall)

    routed = stage_table(nodes.select("node", "vec").mapInArrow(
        _route(size, width, books, slack), "node long, own long, cells array<long>"), "emb-routed")
    pairs = _block_pairs(routed, nodes, block)
    met = stage_table(pairs.mapInArrow(_verify(threshold, width), "node long, links long, hook long"), "emb-links")

    linked = components(met.select(F.col("node").alias("a"), F.col("hook").alias("b")))
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    at = (nodes.join(linked, "node", "left").join(counts, "node", "left")
          .select("vec", "least", F.col("n") - 1 + F.coalesce("links", F.lit(0)),
                  F.coalesce("component", "node")).toDF("vec", "least", "n_links", "component"))
    first = at.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = stage_table(at.join(first, "component").select("vec", "n_links", "component_id"), "emb-classes")
    good = rows.filter("vec IS NOT NULL").join(classes, "vec").select("vec_id", "n_links", "component_id")
    alone = rows.filter("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                              F.col("vec_id").alias("component_id"))
    return good.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: Exact all-pairs cosine; the tables of the correctness check are small enough for it.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links,
       (SELECT min(b) FROM r WHERE r.a = e.vec_id) AS component_id,
       e.vec_id = (SELECT min(b) FROM r WHERE r.a = e.vec_id) AS kept
FROM embeddings e
"""
