"""Keyed stream state: the seen set and the low-yield stop equal their batch forms, across restarts."""

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from gripe.operators import links as LK
from gripe.streaming import state as ST

SCHEMA = "link string, company string, crawl_timestamp double"


def _write(dirpath, name, rows, mtime):
    p = os.path.join(dirpath, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n")
    os.utime(p, (mtime, mtime))


def _run(df, out, ckpt):
    def put(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    df.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()


def test_seen_set_over_rounds_and_a_restart(spark):
    base = tempfile.mkdtemp(prefix="gripe-seen-")
    src, out, ckpt = (os.path.join(base, n) for n in ("src", "out", "ckpt"))
    os.makedirs(src)
    rounds = [
        [{"link": f"l{i}", "company": "r0", "crawl_timestamp": 100.0 + i} for i in range(6)] + [{"company": "r0"}],
        [{"link": f"l{i}", "company": "r1", "crawl_timestamp": 50.0 + i} for i in range(4, 9)] * 2 + [{"link": "none", "company": "r1"}],
        [{"link": f"l{i}", "company": "r2", "crawl_timestamp": 300.0 + i} for i in range(12)] + [{"link": "h1", "company": "r2"}],
    ]
    history = spark.createDataFrame([("h1", 1.0), ("h2", 2.0), ("l5", 3.0), (None, 4.0)], "link string, crawl_timestamp double")
    want, seen = {}, history.select("link")
    for k, rows in enumerate(rounds):
        _write(src, f"{k}.json", rows, 1_000_000 + 100 * k)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
        _run(ST.first_sightings(stream, seen=history), out, ckpt)  # a restart for every round
        found = spark.createDataFrame([(r.get("link"), r["company"], r.get("crawl_timestamp")) for r in rows], SCHEMA)
        found = found.filter("link IS NOT NULL")
        new = LK.new_links(found, seen)
        want.update({r.link: k for r in new.collect()})
        seen = LK.add_seen(seen, new)
    got = spark.read.parquet(out).collect()
    assert {r.link: r.batch for r in got} == want and len(got) == len(want)
    by = {r.link: r for r in got}
    assert by["l7"].crawl_timestamp == 57.0 and by["none"].crawl_timestamp is None and by["l11"].company == "r2"


def test_a_key_with_many_rows_keeps_the_earliest(spark):
    base = tempfile.mkdtemp(prefix="gripe-seen-hot-")
    src = os.path.join(base, "src")
    os.makedirs(src)
    _write(src, "a.json", [{"link": "hot", "company": f"c{i}", "crawl_timestamp": float((i * 7919) % 25_000)} for i in range(25_000)], 1_000_000)
    out = os.path.join(base, "out")
    _run(ST.first_sightings(spark.readStream.schema(SCHEMA).json(src)), out, os.path.join(base, "ckpt"))
    assert [(r.link, r.crawl_timestamp, r.company) for r in spark.read.parquet(out).collect()] == [("hot", 0.0, "c0")]


def test_a_forgotten_key_is_new_again(spark):
    """With a time to live the query keeps running empty batches, so it needs a timed trigger."""
    base = tempfile.mkdtemp(prefix="gripe-seen-ttl-")
    src = os.path.join(base, "src")
    os.makedirs(src)
    got = []
    stream = ST.first_sightings(spark.readStream.schema(SCHEMA).json(src), ttl_days=1.0 / 86_400)
    q = (stream.writeStream.outputMode("update").foreachBatch(lambda b, i: got.extend(r.crawl_timestamp for r in b.collect()))
         .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(processingTime="0 seconds").start())
    try:
        for k in (1, 2):
            _write(src, f"{k}.json", [{"link": "a", "company": "c", "crawl_timestamp": float(k)}], 1_000_000 + k)
            end = time.time() + 40
            while len(got) < k and time.time() < end:
                time.sleep(0.2)
            time.sleep(2)  # longer than the key is remembered
    finally:
        q.stop()
    assert got == [1.0, 2.0]


def test_stop_pages_equal_the_batch_form(spark):
    import random

    rnd = random.Random(5)
    log = [(f"s{s}", p, 0 if rnd.random() < 0.75 + 0.02 * s else rnd.randint(1, 5)) for s in range(12) for p in range(1, 70)
           if rnd.random() < 0.9]
    log += [("early", p, 0) for p in range(1, 30)] + [("never", p, 1) for p in range(1, 30)]
    df = spark.createDataFrame(log, "site string, page_no int, n_new long")
    want = {r.site: r.stop_page for r in LK.low_yield_stop(df).collect() if r.stop_page is not None}
    assert want["early"] == 11 and "never" not in want and len(want) > 4
    base = tempfile.mkdtemp(prefix="gripe-stop-")
    src, out, ckpt = (os.path.join(base, n) for n in ("src", "out", "ckpt"))
    os.makedirs(src)
    for k, (lo, hi) in enumerate([(0, 8), (8, 9), (9, 25), (20, 40), (40, 99)]):  # pages 20 to 24 come twice
        rows = [{"site": s, "page_no": p, "n_new": n} for s, p, n in log if lo <= p < hi]
        rnd.shuffle(rows)
        _write(src, f"{k}.json", rows + [{"site": None, "page_no": 1}, {"site": "s1"}], 1_000_000 + 100 * k)
        if k in (1, 4):  # several micro-batches a run, and a restart in between
            stream = spark.readStream.schema("site string, page_no int, n_new long").option("maxFilesPerTrigger", 1).json(src)
            _run(ST.stop_pages(stream), out, ckpt)
    got = spark.read.parquet(out).collect()
    assert {r.site: r.stop_page for r in got} == want and len(got) == len(want)
    crawled = {r.site: r.n_pages for r in got}
    assert all(crawled[s] == sum(1 for x, p, _ in log if x == s and p <= want[s]) for s in want)


def test_stop_pages_takes_rows_one_by_one():
    """A site's rows are walked as they come, without a frame for each site: pages out of order and repeated, null counts
    (empty pages), null pages (none), pages behind the last one, and nothing after the stop."""
    from pyspark.sql import Row

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    runs = ST.EmptyRuns("site", "page_no", "n_new", 3, 2)
    runs.state = State()

    def feed(*pages):
        return list(runs.handleInputRows((7,), iter([Row(site=7, page_no=p, n_new=n) for p, n in pages]), None))

    assert feed((2, 0), (1, None), (2, 5), (None, 9), (3, 0)) == [] and runs.state.value == (3, 3, 1, False)
    assert feed((1, 0), (3, 0)) == [] and runs.state.value == (3, 3, 1, False)
    assert feed((6, None), (5, 1), (6, None), (9, 0), (8, 0), (7, 4)) == [Row(site=7, n_pages=8, stop_page=9)]
    assert feed((10, 0)) == [] and runs.state.value == (9, 8, 2, True)
