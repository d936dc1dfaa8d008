"""Reference resolution, exact splits, folded words, topic names, CSV escapes and the progress table on hand-made rows."""

import itertools
import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gripe import lexicons as L
from gripe.operators import churn as CH
from gripe.operators import terms as TM
from gripe.operators import topics as TP
from gripe.sources import complaints as CP
from gripe.sources import pages as PG
from gripe.streaming import pipeline as PL

#: Reference and result for the base http://a/b/c/d;p?q (RFC 3986, 5.4); fixed values.
RFC_EXAMPLES = [
    ("g:h", "g:h"), ("g", "http://a/b/c/g"), ("./g", "http://a/b/c/g"), ("g/", "http://a/b/c/g/"), ("/g", "http://a/g"),
    ("?y", "http://a/b/c/d;p?y"), ("g?y", "http://a/b/c/g?y"), ("#s", "http://a/b/c/d;p?q#s"), ("g#s", "http://a/b/c/g#s"),
    ("g?y#s", "http://a/b/c/g?y#s"), (";x", "http://a/b/c/;x"), ("g;x", "http://a/b/c/g;x"), ("g;x?y#s", "http://a/b/c/g;x?y#s"),
    ("", "http://a/b/c/d;p?q"), (".", "http://a/b/c/"), ("./", "http://a/b/c/"), ("..", "http://a/b/"), ("../", "http://a/b/"),
    ("../g", "http://a/b/g"), ("../..", "http://a/"), ("../../", "http://a/"), ("../../g", "http://a/g"),
    ("../../../g", "http://a/g"), ("../../../../g", "http://a/g"), ("/./g", "http://a/g"), ("/../g", "http://a/g"),
    ("g.", "http://a/b/c/g."), (".g", "http://a/b/c/.g"), ("g..", "http://a/b/c/g.."), ("..g", "http://a/b/c/..g"),
    ("./../g", "http://a/b/g"), ("./g/.", "http://a/b/c/g/"), ("g/./h", "http://a/b/c/g/h"), ("g/../h", "http://a/b/c/h"),
    ("g;x=1/./y", "http://a/b/c/g;x=1/y"), ("g;x=1/../y", "http://a/b/c/y"), ("g?y/./x", "http://a/b/c/g?y/./x"),
    ("g?y/../x", "http://a/b/c/g?y/../x"), ("g#s/./x", "http://a/b/c/g#s/./x"), ("g#s/../x", "http://a/b/c/g#s/../x"),
]


def test_references_resolve_as_the_standard_lists(spark):
    df = spark.createDataFrame(RFC_EXAMPLES, "href string, want string")
    got = df.select("href", "want", PG.resolve_href("href", F.lit("http://a/b/c/d;p?q")).alias("got")).collect()
    assert [(r.href, r.got) for r in got] == RFC_EXAMPLES
    odd = [("../x", "https://h", "https://h/x"), ("//o/a/../b", "https://h/z", "https://o/b"), ("mailto:a/../b", "http://h/", "mailto:a/../b"),
           ("http://h/../../a//../b", "http://h/", "http://h/a/b"), (None, "http://h/", None), ("a", "http://h/p#x/y", "http://h/a")]
    rows = spark.createDataFrame(odd, "href string, base string, want string")
    assert [r.got for r in rows.select(PG.resolve_href("href", "base").alias("got")).collect()] == [w for *_, w in odd]


@pytest.mark.parametrize("n,share", [(1, 0.2), (7, 0.2), (1000, 0.2), (1000, 0.333), (64, 1.0), (64, 0.0), (0, 0.5)])
def test_exact_split_has_the_exact_size(spark, n, share):
    df = spark.range(n).select(F.col("id").cast("string").alias("link"), F.col("id").alias("h1"), F.lit(None).cast("int").alias("is"))
    out = CH.exact_split(df, "link", share)
    assert out.columns == ["link", "h1", "is", "is_test"]
    assert out.filter("is_test").count() == math.ceil(round(share * n, 9)) and out.count() == n


def test_exact_split_resolves_ties(spark):
    rows = [("same", i % 40) for i in range(400)] + [(None, 1)] * 300 + [("x", 1), ("y", 2)]
    df = spark.createDataFrame(rows, "link string, v int").repartition(5)
    for share in (0.1, 0.5, 0.77):
        out = CH.exact_split(df, "link", share)
        got = out.groupBy("is_test").count().collect()
        assert {r["is_test"]: r["count"] for r in got}[True] == math.ceil(round(share * len(rows), 9))
        assert sorted(map(repr, [(r.link, r.v) for r in out.collect()])) == sorted(map(repr, rows))
    a, b = (sorted(map(repr, [tuple(r) for r in CH.exact_split(df, "link", 0.3).collect()])) for _ in range(2))
    assert a == b


def test_case_forms_and_plurals_are_folded(spark):
    rows = [("A", w, n) for w, n in [("Fatura", 3), ("fatura", 5), ("FATURA", 5), ("lines", 4), ("Line", 2), ("line", 1), ("class", 6),
                                     ("bus", 7), ("boss", 2), ("bos", 1), ("Lines", 1), ("s", 3), ("ss", 2)]] + [("B", "lines", 9)]
    got = {(r.company, r.word): r.n for r in TM.fold_forms(spark.createDataFrame(rows, "company string, word string, n long")).collect()}
    assert got == {("A", "FATURA"): 13, ("A", "line"): 8, ("A", "class"): 6, ("A", "bus"): 7, ("A", "boss"): 2, ("A", "bos"): 1,
                   ("A", "s"): 3, ("A", "ss"): 2, ("B", "lines"): 9}


def test_names_survive_a_permutation_of_topics_and_beat_the_greedy_choice(spark):
    score = {(1, "a"): 9.0, (1, "b"): 8.0, (2, "a"): 8.5, (2, "b"): 1.0, (3, "c"): 0.5}  # greedy gives 1-a, 2-b: 10.5 against 17
    for order in itertools.permutations([1, 2, 3]):
        rows = [(order[t - 1], n, s) for (t, n), s in score.items()]
        got = TP.assign_names(spark.createDataFrame(rows, "topic int, name string, score double"), [1, 2, 3], ["a", "b", "c"]).collect()
        assert {r.topic: r.name for r in got} == {order[0]: "b", order[1]: "a", order[2]: "c"}
        total = {p: sum(score.get((t, n), 0.0) for t, n in zip([1, 2, 3], p)) for p in itertools.permutations("abc")}
        lead = {t: 17.0 - max(v for p, v in total.items() if p[t - 1] != "bac"[t - 1]) for t in (1, 2, 3)}
        assert {r.topic: round(r.margin, 9) for r in got} == {order[t - 1]: round(v, 9) for t, v in lead.items()}
    few = TP.assign_names(spark.createDataFrame([(1, "a", 1.0)], "topic int, name string, score double"), [1, 2], ["a", "b", "c"]).collect()
    assert {r.topic: r.name for r in few} == {1: "a", 2: None}
    with pytest.raises(ValueError):
        TP.assign_names(spark.createDataFrame([(1, "a", 1.0)], "topic int, name string, score double"), range(8), ["a"])


def test_csv_keeps_every_character(spark):
    texts = ["a\x00b", "\\0", "\\\\0", "\\n", "\n", "\\\n", "\r\n\\r", '"', '""\\"', ",", "", " ", "\\N", "\\b", "\\\\b\x00\\", None]
    df = spark.createDataFrame([("c", None, str(i), t) for i, t in enumerate(texts)], "company string, date string, link string, content string")
    path = tempfile.mkdtemp(prefix="gripe-csv-") + "/x"
    CP.write_csv(df, path)
    assert [r.content for r in CP.read_csv(spark, path).orderBy(F.col("link").cast("int")).collect()] == texts


def test_progress_has_one_row_per_batch(spark):
    base = tempfile.mkdtemp(prefix="gripe-progress-")
    src = base + "/src"
    os.makedirs(src)
    for k in range(3):
        with open(f"{src}/{k}.json", "w") as f:
            f.write("\n".join(json.dumps({"link": f"l{k}-{i}", "company": "c", "content": "metin", "crawl_timestamp": 1.7e9}) for i in range(k + 1)))
        os.utime(f"{src}/{k}.json", (1_000_000 + k, 1_000_000 + k))
    log = PL.log_progress(spark, base + "/progress")
    try:
        q = PL.start_pipeline(PL.process(PL.read_json_files(spark, src, 1), L.REFERENCE), base + "/s", base + "/ck", trigger={"availableNow": True})
        q.awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(log)
    rows = [r for r in PL.read_progress(spark, base + "/progress").orderBy("batch_id").collect()]
    assert [(r.batch_id, r.rows_in) for r in rows if r.rows_in] == [(0, 1), (1, 2), (2, 3)]
    assert all(r.query == str(q.id) and r.seconds > 0 for r in rows if r.rows_in)
