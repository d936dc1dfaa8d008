"""Top-k over many distinct values and containment of large phrase lists equal the plain forms."""

import random

from pyspark.sql import functions as F

from gripe.functions import phrases as PH
from gripe.functions import sentiment as S
from gripe.operators import terms as TM
from gripe.plans import queries as Q

from .conftest import SF01


def _items(spark, seed=1):
    rnd = random.Random(seed)
    rows = [f"hot{k}" for k in range(30) for _ in range(400 - 10 * (k // 3))]  # ties among the frequent ones
    rows += [f"rare{rnd.randrange(40_000)}" for _ in range(20_000)] + [None, None, ""]
    rnd.shuffle(rows)
    return spark.createDataFrame([(r,) for r in rows], "v string").repartition(6)


def test_heavy_hitters_equal_the_full_count(spark):
    items = _items(spark)
    plain = items.filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "v")
    for n, options in ((7, {}), (20, {"width": 512}), (20, {"sample": 1e-9}), (31, {"trial": 5, "depth": 1, "width": 16})):
        want = [tuple(r) for r in plain.limit(n).collect()]
        got = [tuple(r) for r in TM.heavy_hitters(items, "v", n, **options).orderBy(F.desc("n"), "v").collect()]
        assert got == want, (n, options)
    assert TM.heavy_hitters(items.limit(0), "v", 5).collect() == []


def test_candidates_of_the_second_pass_are_few(spark):
    items = _items(spark).cache()
    counted = []
    vocabulary = TM.vocabulary
    try:
        TM.vocabulary = lambda df, *a, **k: counted.append(df.count()) or vocabulary(df, *a, **k)
        TM.heavy_hitters(items, "v", 10).collect()
    finally:
        TM.vocabulary = vocabulary
    assert counted[0] < 60 < items.distinct().count() / 100


def test_sketched_bigrams_equal_top_bigrams(spark):
    docs = Q.store(spark, SF01).select("cleaned").cache()
    assert [tuple(r) for r in TM.top_bigrams_sketched(docs).collect()] == [tuple(r) for r in TM.top_bigrams(docs).collect()]


def _texts(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcçğ") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 25))) for _ in range(150)]
    phrases = [rnd.choice(words) + rnd.choice(["", " " + rnd.choice(words)]) for _ in range(250)]
    phrases += ["", "", phrases[0], "a", "ab", "abc", "😀", "çğ"]
    rows = [(i, t, "x") for i, t in enumerate([*texts, None, "", "😀 abc", "a" * 50_000])] + [(None, "abc", "y")]
    return spark.createDataFrame(rows, "id long, cleaned string, h string"), phrases


def test_both_ways_equal_count_hits(spark):
    df, phrases = _texts(spark)
    want = {r.id: r.n for r in df.select("id", S.count_hits("cleaned", phrases).alias("n")).collect()}
    a = PH.count_phrases(df, phrases)
    assert a.columns == ["id", "cleaned", "h", "hits"] and {r.id: r.hits for r in a.collect()} == want
    table = spark.createDataFrame([(p,) for p in [*phrases, None]], "phrase string")
    for gram in (1, 4):
        b = PH.count_phrases_joined(df, table, "id", out="n_hits", gram=gram)
        assert {r.id: r.n_hits for r in b.collect()} == want
    assert {r.hits for r in PH.count_phrases(df, []).collect()} == {0} == {r.hits for r in PH.count_phrases_joined(df, table.limit(0), "id").collect()}


def test_100000_phrases_in_one_scan(spark):
    docs = Q.enriched(spark, SF01).select("doc_id", "cleaned")
    rnd = random.Random(9)
    words = [r.w for r in docs.select(F.explode(F.split("cleaned", " ")).alias("w")).distinct().orderBy("w").collect()]
    phrases = [rnd.choice(words) + " " + rnd.choice(words) for _ in range(99_000)] + words[:1000]
    got = PH.count_phrases(docs, phrases)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "contains(" not in plan
    some = {r.doc_id: r.hits for r in got.filter("doc_id % 97 = 3").collect()}
    texts = {r.doc_id: r.cleaned for r in docs.filter("doc_id % 97 = 3").collect()}
    for i, t in texts.items():
        assert some[i] == sum(p in t for p in phrases)
    joined = PH.count_phrases_joined(docs.filter("doc_id % 97 = 3"), spark.createDataFrame([(p,) for p in phrases], "phrase string"), "doc_id", gram=6)
    assert "NestedLoop" not in joined._jdf.queryExecution().toString()
    assert {r.doc_id: r.hits for r in joined.collect()} == some


def test_joined_grams_by_bytes(spark, monkeypatch):
    """Only grams that a phrase begins with leave the text; texts, phrases and blocks end anywhere, also inside a character."""
    monkeypatch.setattr(PH, "BLOCK", 16)
    texts = ["", None, "a", "ab", "çığ şu", "x" * 40 + "iptal et", "iptal e", "tiptal", "a\x00\x00", "abcdefgh", "abcdefghi abcdefgz", "şşşşşşşş"]
    texts += ["ğü" * i + "the end" + "ı" * i for i in range(9)]
    phrases = ["", "", "a", "a\x00", "a\x00\x00", "ab", "ığ", "ş", "şşşşş", "iptal et", "tip", "abcdefgh", "abcdefghi", "abcdefgz", "the end", "endı", "end", "zz", "zz"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, cleaned string")
    table = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    want = {i: sum(p in (t or "") for p in phrases) for i, t in enumerate(texts)}
    for gram in (0, 1, 3, 8, 20):
        assert {r.id: r.hits for r in PH.count_phrases_joined(df, table, "id", gram=gram).collect()} == want
    plan = PH.count_phrases_joined(df, table, "id", gram=8)._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan and "MapInArrow" in plan
