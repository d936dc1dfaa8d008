"""Connected components of a link table by alternating large-star and small-star steps (Kiveris et al. 2014).

Every step is an aggregation (minimum neighbour, partial per task) and a join
on the node, so a node with a third of all links is split by the skew join.
Each round is written to the shared folder; links never reach the driver, only
their count and a checksum do.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table

MAX_ROUNDS = 60


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of long ids → ``node, component`` (smallest id reachable) for every id that has a link."""
    e = (links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stage_table(e, "cc-0")
    last = _state(e)
    for k in range(1, MAX_ROUNDS + 1):
        if not last[0]:
            break
        # large star: the larger neighbours of v are linked to the smallest of v and its neighbours
        near = (e.select(F.col("v").alias("x"), F.col("v").alias("y")).union(e.select(F.col("u").alias("x"), "v"))
                .groupBy("x").agg(F.min("y").alias("m")))
        big = e.join(near, e["v"] == near["x"]).select("u", F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are linked to the smallest of these
        low = big.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        small = (big.join(low, big["u"] == low["x"])
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        e = stage_table(small, f"cc-{k}")
        now = _state(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest local index reachable from each of ``n`` nodes over the links (i, j).

    A block that holds many links passes on at most one link per node; what is
    reachable stays the same."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while True:
            hop = new[new]
            if (hop == new).all():
                break
            new = hop
        new = new[label]
        if (new == label).all():
            break
        label = new
    return label
