"""Index of the keys of a store: which keys are there already, without reading the store.

The index is a set of runs.  A run is the sorted keys of one insert, as Parquet
in buckets by hash, with a blocked Bloom filter beside it: a table of 512-bit
blocks, where a key has one bit in each of the eight words of one block.  A look-up joins the
keys of a batch with the filter rows of all runs (an equi-join on run and block)
and opens only the buckets of runs that may hold one of the keys; these decide
exactly.  When ``fanout`` runs of a level exist, they are merged to one run of
the next, so the number of runs grows with the logarithm of the inserts.

A run becomes visible by its marker file, written after the store has the rows.
A run without a marker is what a failure left: :func:`recover` keeps those of
its keys that reached the store and forgets the rest, reading only the parts of the
store that the run names.  One writer at a time, as with one streaming query.
"""

from __future__ import annotations

import json
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_names, path_exists, read_text, remove, write_text

WORDS = 8
BITS_PER_KEY = 32
MARKER = "COMMITTED"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int")


def _block(blocks: "Column | int") -> Column:
    return F.pmod(F.xxhash64("_key", F.lit("block")), F.lit(blocks) if isinstance(blocks, int) else blocks)


def _bit_hash() -> Column:
    return F.xxhash64("_key", F.lit("bits")).alias("_h")


def _bits() -> list[Column]:
    """The bit of the key in each word of its block, from the column ``_h``."""
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_h, {6 * i}) & 63 as int))").alias(f"m{i}") for i in range(WORDS)]


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, fanout: int = 8, bits_per_key: int = BITS_PER_KEY):
        self.spark, self.path, self.buckets, self.fanout = spark, path.rstrip("/"), buckets, fanout
        self.keys_per_block = max(1, WORDS * 64 // bits_per_key)

    # ---- runs

    def _run(self, run: str) -> str:
        return f"{self.path}/{run}"

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def runs(self) -> dict[str, dict]:
        """The live runs with their marker's content: committed, and not replaced by a committed run."""
        marked = {}
        for run, _ in list_names(self.spark, self.path):
            if path_exists(self.spark, f"{self._run(run)}/{MARKER}"):
                marked[run] = json.loads(read_text(self.spark, f"{self._run(run)}/{MARKER}"))
        gone = {r for m in marked.values() for r in m["replaces"]}
        return {r: m for r, m in marked.items() if r not in gone}

    def pending(self) -> list[str]:
        return [run for run, _ in list_names(self.spark, self.path) if not path_exists(self.spark, f"{self._run(run)}/{MARKER}")]

    def add(self, keys: DataFrame, run: str | None = None) -> str | None:
        """Write ``keys`` (``_key``, ``part``, each key once) as a run that is not visible yet; ``None`` where there is no key."""
        run = run or f"run-{uuid.uuid4().hex[:16]}"
        at = self._run(run)
        remove(self.spark, at)
        (keys.select("_key", "part", _bucket(self.buckets).alias("bucket")).repartition(self.buckets, "bucket")
         .sortWithinPartitions("bucket", "_key").write.partitionBy("bucket").parquet(f"{at}/keys"))
        n = self._keys(run, keys.schema["_key"].dataType.simpleString()).count()
        if not n:
            remove(self.spark, at)
            return None
        blocks = -(-n // self.keys_per_block)
        kept = self._keys(run, keys.schema["_key"].dataType.simpleString()).select(_block(blocks).alias("block"), _bit_hash())
        (kept.select("block", *_bits()).groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])
         .withColumn("run", F.lit(run)).sortWithinPartitions("block").write.parquet(f"{at}/filter"))
        write_text(self.spark, f"{at}/SHAPE", json.dumps({"keys": n, "blocks": blocks}))
        return run

    def commit(self, run: str, replaces: tuple = (), level: int = 0) -> None:
        shape = json.loads(read_text(self.spark, f"{self._run(run)}/SHAPE"))
        write_text(self.spark, f"{self._run(run)}/{MARKER}", json.dumps({**shape, "replaces": list(replaces), "level": level}))
        for old in replaces:
            remove(self.spark, self._run(old))

    def _keys(self, run: str, kind: str) -> DataFrame:
        return (self.spark.read.schema(f"_key {kind}, part string, bucket int").option("basePath", f"{self._run(run)}/keys")
                .parquet(f"{self._run(run)}/keys"))

    # ---- look-up

    def places(self, keys: DataFrame) -> list[tuple[str, int]]:
        """The (run, bucket) pairs that may hold one of ``keys``: at most runs x buckets of them."""
        live = self.runs()
        if not live:
            return []
        filters = self.spark.read.parquet(*[f"{self._run(r)}/filter" for r in live])
        # one small literal per run; the number of runs is bounded by fanout x levels
        shapes = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(m["blocks"]).cast("long").alias("blocks")) for r, m in live.items()])
        probe = (keys.select("_key", _bit_hash(), F.explode(shapes).alias("s"))
                 .select(_bucket(self.buckets).alias("bucket"), F.col("s.run").alias("run"), _block(F.col("s.blocks")).alias("block"),
                         *_bits()))
        hit = probe.join(filters, ["run", "block"])
        for i in range(WORDS):
            hit = hit.filter(F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) != 0)
        return sorted((r["run"], r["bucket"]) for r in hit.select("run", "bucket").distinct().collect())

    def stored(self, keys: DataFrame, before: str | None = None) -> DataFrame | None:
        """Those of ``keys`` (a column ``_key``) that the index holds, or None where no filter hits.

        ``before`` counts only entries whose part is smaller."""
        found = self.places(keys)
        paths = [f"{self._run(r)}/keys/bucket={b}" for r, b in found]
        paths = [p for p in paths if path_exists(self.spark, p)]
        if not paths:
            return None
        there = self.spark.read.schema(f"_key {keys.schema['_key'].dataType.simpleString()}, part string").parquet(*paths)
        if before is not None:
            there = there.filter(F.col("part") < before)
        return there.select("_key").join(keys.select("_key"), "_key", "left_semi").distinct()

    def unseen(self, rows: DataFrame, before: str | None = None) -> DataFrame:
        """The rows whose ``_key`` is not in the index."""
        known = self.stored(rows.select("_key"), before)
        return rows if known is None else rows.join(known, "_key", "left_anti")

    # ---- upkeep

    def compact(self) -> None:
        """Merge the runs of every level that has ``fanout`` of them."""
        while True:
            levels: dict[int, list[str]] = {}
            for r, m in self.runs().items():
                levels.setdefault(m["level"], []).append(r)
            full = sorted(k for k, v in levels.items() if len(v) >= self.fanout)
            if not full:
                return
            old = sorted(levels[full[0]])
            self.merge(old, full[0] + 1)

    def merge(self, old: list[str], level: int, keep: Column | None = None) -> None:
        """Replace runs by one; ``keep`` drops entries (a rebuild from an earlier day on)."""
        kind = self.spark.read.parquet(f"{self._run(old[0])}/keys").schema["_key"].dataType.simpleString()
        rows = self._keys(old[0], kind)
        for r in old[1:]:
            rows = rows.unionByName(self._keys(r, kind))
        rows = rows.select("_key", "part") if keep is None else rows.filter(keep).select("_key", "part")
        run = self.add(rows)
        if run:
            self.commit(run, tuple(old), level)
        else:
            for r in old:
                remove(self.spark, self._run(r))

    def sweep(self) -> None:
        """Remove runs that a merge replaced before it could remove them."""
        live, waiting = set(self.runs()), set(self.pending())
        for run, _ in list_names(self.spark, self.path):
            if run not in live and run not in waiting:
                remove(self.spark, self._run(run))

    def recover(self, present) -> None:
        """Settle the runs that a failure left: ``present(keys)`` returns those rows of a run that reached the store."""
        self.sweep()
        for run in self.pending():
            if not path_exists(self.spark, f"{self._run(run)}/SHAPE"):
                remove(self.spark, self._run(run))  # the failure came before the store was written
                continue
            kind = self.spark.read.parquet(f"{self._run(run)}/keys").schema["_key"].dataType.simpleString()
            keys = self._keys(run, kind).select("_key", "part")
            there = present(keys).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                n, all_n = there.count(), keys.count()
                if n == all_n:
                    self.commit(run)
                    continue
                kept = self.add(there) if n else None
                if kept:
                    self.commit(kept, (run,))
                else:
                    remove(self.spark, self._run(run))
            finally:
                there.unpersist()
