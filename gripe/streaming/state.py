"""Crawl bookkeeping as keyed stream state.

Both operators are stateful processors on the RocksDB state store: the state of a
key lives in the checkpoint, survives a restart and is not bounded by memory.

:func:`first_sightings` is the seen set of the crawl: one row per key when it is met first.
:func:`stop_pages` counts, per site, the listing pages in a row that brought nothing new,
and emits the page where the crawl of the site stops, once.

Each processor gets the rows of a key in chunks and keeps a few numbers, so a key
with a third of all rows is a long stream of one task, not a group in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ship

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB state store; call before the query starts."""
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class SeenKeys(StatefulProcessor):
    """Per key: the earliest crawl time so far.  Emits the key's earliest row of the batch that brings it first."""

    def __init__(self, key: str, order: str, columns: list[str], ttl_ms: int | None):
        self.key, self.order, self.columns, self.ttl_ms = key, order, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "at double", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timer) -> Iterator[pd.DataFrame]:
        known = self.first.get()[0] if self.first.exists() else None
        new, at, best = not self.first.exists(), known, None
        for chunk in rows:
            # earliest first, a missing time last, ties by the other columns
            low = chunk.sort_values([self.order, *[c for c in self.columns if c not in (self.key, self.order)]],
                                    na_position="last", kind="stable").iloc[:1]
            t = low[self.order].iloc[0]
            t = None if pd.isna(t) else float(t)
            if best is None or (t is not None and (at is None or t < at)):
                best = low
            if t is not None and (at is None or t < at):
                at = t
        if new or at != known:
            self.first.update((at,))
        if new and best is not None:
            yield best[self.columns]

    def handleInitialState(self, key, initial, timer) -> None:
        t = initial[self.order].min()
        self.first.update((None if pd.isna(t) else float(t),))

    def close(self) -> None:
        pass


def first_sightings(stream: DataFrame, key: str = "link", order: str = "crawl_timestamp", ttl_days: float | None = None,
                    seen: DataFrame | None = None) -> DataFrame:
    """Rows of keys that were never seen before, one per key: the earliest of the micro-batch that brings the key.

    ``seen`` (``key``, ``order``) starts the state with a history, as the crawler does.  ``ttl_days`` forgets a
    key that long after its state was last written; such a query runs on without new rows, so it needs a timed trigger.  ``order`` is a number (epoch seconds).  Rows without a key are
    left out, as they can be no seen link."""
    use_rocksdb(stream.sparkSession)
    rows = stream.filter(F.col(key).isNotNull())
    initial = None
    if seen is not None:
        one = seen.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.col(order).cast("double")).alias(order))
        initial = one.groupBy(key)
    ttl = None if ttl_days is None else int(ttl_days * 86_400_000)
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=SeenKeys(key, order, rows.columns, ttl), outputStructType=rows.schema, outputMode="Update",
        timeMode="None" if ttl is None else "ProcessingTime", initialState=initial)


class EmptyRuns(StatefulProcessor):
    """Per site: last page, pages crawled, empty pages in a row, whether the stop was told."""

    def __init__(self, site: str, page: str, new: str, after: int, run: int):
        self.site, self.page, self.new, self.after, self.run = site, page, new, after, run

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", "last long, pages long, empty long, stopped boolean")

    def handleInputRows(self, key, rows, timer) -> Iterator[Row]:
        last, pages, empty, stopped = self.state.get() or (None, 0, 0, False)  # one call to the store, none to ask whether
        if stopped:
            return
        found: dict = {}  # pages of a site: bounded by the crawl
        for r in rows:
            page, new = r[self.page], r[self.new]
            if page is not None and page == page:  # neither null nor NaN
                most = found.get(page)
                found[page] = new if most is None else most if new is None else max(most, new)
        for page in sorted(found):
            if last is not None and page <= last:
                continue
            last, pages = int(page), pages + 1
            empty = empty + 1 if not found[page] else 0
            if empty >= self.run and page > self.after:
                stopped = True
                break
        self.state.update((last, pages, empty, stopped))
        if stopped:
            yield Row(**{self.site: key[0], "n_pages": pages, "stop_page": last})

    def close(self) -> None:
        pass


def stop_pages(log: DataFrame, site: str = "site", page: str = "page_no", new: str = "n_new", after: int = 10,
               run: int = 10) -> DataFrame:
    """(site, n_pages crawled until then, stop_page), once per site: the streaming form of ``links.low_yield_stop``.

    ``log`` is a stream of (site, page, new links) in crawl order: a page that does not lie behind the site's last
    one was counted already and is ignored.  A null count is an empty page, a null page number no page.  Rows after the
    stop change nothing."""
    use_rocksdb(log.sparkSession)
    rows = log.filter(F.col(site).isNotNull()).select(site, page, F.col(new).cast("long").alias(new))
    kind = dict(rows.dtypes)[site]
    # rows, not frames: a site has a few rows in a batch, and a frame for each site costs more than its pages
    return rows.groupBy(site).transformWithState(
        statefulProcessor=EmptyRuns(site, page, new, after, run),
        outputStructType=f"{site} {kind}, n_pages long, stop_page long", outputMode="Update", timeMode="None")
