"""Mini-batch topic model against a plain one-row-at-a-time version and against MLlib's fit."""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gripe.operators import topics as TP
from gripe.operators import topics_minibatch as TB

GROUPS = {"bills": ["bill", "price", "fee", "pay", "charge", "cost"], "net": ["line", "speed", "modem", "signal", "drop", "slow"],
          "shop": ["store", "queue", "clerk", "branch", "visit", "wait"]}


def planted(spark, n=600):
    rng = np.random.default_rng(7)
    names = list(GROUPS)
    rows = [(i, f"l{i}", names[i % 3], " ".join(rng.choice(GROUPS[names[i % 3]], 12))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, link string, company string, cleaned string")


def plain_posterior(counts, beta):
    k = len(beta)
    gamma = np.ones(k)
    for _ in range(TB.E_STEPS):
        theta = TB.e_log(gamma[None])[0]
        new = np.array([1 / k + theta[t] * sum(c * beta[t, w] / sum(theta[u] * beta[u, w] for u in range(k))
                                               for w, c in counts.items()) for t in range(k)])
        done = np.abs(new - gamma).mean() < TB.E_TOLERANCE
        gamma = new
        if done:
            break
    return gamma


def test_digamma_known_values():
    known = {1.0: -0.5772156649015329, 0.5: -1.9635100260214235, 2.0: 0.42278433509846714, 10.0: 2.251752589066721}
    assert np.allclose(TB.digamma(np.array(list(known))), list(known.values()), atol=1e-9)


def test_bags_match_counting(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "x"]), (2, []), (3, None), (4, ["x"]), (5, ["c", "a", None])],
                               "h long, tokens array<string>")
    got = {r.h: (r.ids, r.n) for r in TB.bags(df, ["a", "b", "c"]).collect()}
    assert got == {1: ([0, 1], [2, 1]), 5: ([0, 2], [1, 1])}


def test_shard_walk_is_the_sequential_update():
    rng = np.random.default_rng(3)
    docs = [{int(w): int(rng.integers(1, 4)) for w in sorted(rng.choice(20, rng.integers(1, 9), replace=False))} for _ in range(23)]
    start = rng.gamma(100.0, 0.01, (3, 20))
    own, t = start.copy(), 0
    for at in range(0, len(docs), 8):
        part, beta = docs[at:at + 8], TB.e_log(own)
        stats = np.zeros_like(own)
        for d in part:
            theta = TB.e_log(plain_posterior(d, beta)[None])[0]
            for w, c in d.items():
                stats[:, w] += c * theta * beta[:, w] / (theta @ beta[:, w])
        rate = (TB.OFFSET + 40 + t) ** -TB.DECAY
        own, t = (1 - rate) * own + rate * (1 / 3 + stats * 500 / len(part)), t + 1
    table = pa.table({"ids": pa.array([list(d) for d in docs], pa.list_(pa.int32())),
                      "n": pa.array([list(d.values()) for d in docs], pa.list_(pa.int32()))})
    for size in (5, 8, 100):  # batches of any size arrive
        got, = TB.shard_step(start, 500, 40, 8)(iter(table.to_batches(max_chunksize=size)))
        value = dict(zip(got.column("pos").to_pylist(), got.column("value").to_pylist()))
        assert (value[-1], value[-2]) == (23, 3)
        assert np.allclose([value[i] / 23 for i in range(60)], own.ravel(), rtol=1e-9)


def test_topics_recovered_and_repeatable(spark):
    df = planted(spark)
    runs = [TB.fit_minibatch(df, passes=6, shards=3, batch=32, key="link") for _ in range(2)]
    assert runs[0].history == runs[1].history and (runs[0].weights == runs[1].weights).all()
    again = TB.fit_minibatch(df.repartition(7), passes=6, shards=3, batch=32, key="link")  # the layout does not matter
    assert (again.weights == runs[0].weights).all()
    m = runs[0]
    updates = [u for _, u, _ in m.history]
    assert updates[0] >= 600 * 0.9 / 32 and updates == [updates[0] * (i + 1) for i in range(6)]
    got = m.assign(df).groupBy("company").agg(F.collect_set("topic").alias("t")).collect()
    assert sorted(t for r in got for t in r.t) == [1, 2, 3]
    top = {r.topic: set() for r in got for r in m.terms(spark, 6).collect()}
    for r in m.terms(spark, 6).collect():
        top[r.topic].add(r.term)
    assert sorted(map(sorted, top.values())) == sorted(map(sorted, GROUPS.values()))


def test_perplexity_not_worse_than_mllib_at_equal_passes(spark):
    df = planted(spark)
    vocab, _, other = TP.fit_topics(df, passes=5, updates=10)
    mine = TB.fit_minibatch(df, passes=5, shards=2, batch=32, key="link")
    assert mine.vocab == vocab
    every = TB.bags(df.select(F.col("doc_id").alias("h"), F.split("cleaned", " ").alias("tokens")), vocab)
    a, b = TB.perplexity(every, mine.weights), TB.perplexity(every, np.array(other.topicsMatrix().toArray()).T)
    assert a <= b * 1.01 and a < 8  # six words are equally likely in each group


def test_hard_rows_and_empty_table(spark):
    df = planted(spark).union(spark.createDataFrame(
        [(-1, None, None, None), (-2, "x", "c", ""), (-3, "y", "c", "unheard words"), (-4, "z", "c", "bill " * 20000)],
        "doc_id long, link string, company string, cleaned string"))
    df = df.withColumn("topic_dist", F.lit("clash")).withColumn("h", F.lit(1)).withColumn("shard", F.lit(2))
    m = TB.fit_minibatch(df, passes=2, shards=2)  # without a key: copies share a place
    got = {r.doc_id: r for r in m.assign(df).filter("doc_id < 0").collect()}
    assert all(np.allclose(got[i].topic_dist, 1 / 3) and got[i].topic == 1 for i in (-1, -2, -3))
    assert max(got[-4].topic_dist) > 0.99
    empty = TB.fit_minibatch(df.limit(0), passes=2)
    assert empty.history == [] and empty.assign(df.limit(0)).count() == 0


def test_assign_goes_through_arrow_batches(spark):
    """Rows are assigned in batches, without a Python function per column; each gets what it gets alone."""
    import numpy as np

    m = TB.TopicModel(["ab", "cd", "ef"], np.array([[9.0, 1.0, 1.0], [1.0, 9.0, 2.0]]))
    texts = ["ab ab cd", None, "", "zz", "cd ef ef", "ab"]
    df = spark.createDataFrame(list(enumerate(texts)), "topic_id int, cleaned string").coalesce(1)
    out = m.assign(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    got = {r.topic_id: (r.topic, list(r.topic_dist)) for r in out.collect()}
    assert out.columns == ["topic_id", "cleaned", "topic_dist", "topic"]
    for i, t in enumerate(texts):
        one = m.assign(df.filter(F.col("topic_id") == i)).first()
        assert got[i] == (one.topic, list(one.topic_dist))
    assert got[1] == got[2] == got[3] == (1, [0.5, 0.5]) and got[0][0] == got[5][0] == 1 and got[4][0] == 2
