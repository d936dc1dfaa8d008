"""Prefix trie, whitening and quality classifier against brute force, exact sums and held-out labels."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gripe.llm import prefix_trie, quality, whitening
from gripe.llm import queries as Q
from tests.conftest import SF001


# ---- prefix trie -------------------------------------------------------------------------------------------------

def brute_trie(rows, share=True):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        seqs[c] = own.get(base, [])[:h] + v[h:] if share else v
    members, ends = {}, {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
        ends.setdefault(tuple(s), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(m) - 1) * len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                  for p, m in members.items())


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def same(df, want):
    assert df.columns == COLS
    assert sorted(tuple(r) for r in df.collect()) == want


def hard_conversations():
    rng = np.random.default_rng(3)
    rows = [(None, 0, "user", "no conversation"), (7, None, None, None), (7, None, "user", "tie b"), (7, None, "user", "tie a"),
            (7, 2, "user", ""), (7, 2, "user", ""), (-250, 0, "user", "below zero"), (-250, 1, "bot", "x"),
            (-200, 0, "user", "base below zero"), (-200, 3, "bot", "y"), (901, 0, "user", "base is absent"),
            (11, 0, "user", "😀é " * 30_000)]
    rows += [(300, t, "user", f"turn {t}") for t in range(700)]  # one conversation holds many of the rows
    rows += [(301 + k, t, "user", f"turn {t}") for k in range(40) for t in range(3 + k % 11)]  # copies and prefixes of it
    rows += [(c, t, ["user", "bot"][t % 2], "ab"[int(rng.integers(2))] * 3) for c in range(400, 560) for t in range(int(rng.integers(1, 9)))]
    return rows


@pytest.mark.parametrize("share", [True, False])
def test_trie_of_hard_rows(spark, share):
    rows = hard_conversations()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, a int")
    same(prefix_trie.conversation_trie(df, share_heads=share), brute_trie(rows, share))


def test_trie_does_not_depend_on_the_block(spark):
    rows = hard_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for block in (1, 3, 1000):
        same(prefix_trie.conversation_trie(df, block=block), brute_trie(rows))


def test_a_long_conversation_spans_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = [(5, t, "user", f"turn {t % 50}") for t in range(1500)] + [(c, t, "user", f"turn {t}") for c in (4, 6, 7) for t in range(20)]
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        turns, _ = prefix_trie.ordered(df)
        assert [r.pos for r in turns.filter("conv = 5").orderBy("pos").collect()] == list(range(1500))
        same(prefix_trie.conversation_trie(df), brute_trie(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def test_trie_query_and_empty_table(spark):
    table = spark.read.parquet(f"{SF001}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    same(Q.op13_conversation_trie(spark, SF001), brute_trie(rows))
    same(prefix_trie.conversation_trie(table.limit(0)), [])


# ---- whitening ---------------------------------------------------------------------------------------------------

def check_whitening(rows, ids, vectors, exact=True):
    """Rows of the operator against exact sums and numpy's covariance."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(dims)]
    dev = [sum((n * r[i] - sums[i]) ** 2 for i in range(dims)) for r in x]
    d = np.array([[float(Fraction(n * r[i] - sums[i], n)) for i in range(dims)] for r in x])
    cov = np.array([[float(Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x), n ** 3)) for j in range(dims)]
                    for i in range(dims)])
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    k = sum(1 for v in values[:8] if v > 1e-12 * values[0])
    want = d @ vecs[:, :k] / np.sqrt(values[:k])
    assert len(rows) == n * k
    got = {}
    for r in rows:
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
    seen = sorted((i, c) for i, c in got)
    assert seen == sorted({(i, c) for i in ids for c in range(1, k + 1)})
    for at, i in enumerate(ids):
        for c in range(k):
            (r,) = got[i, c + 1]
            assert r["n"] == n and int(r["deviation"]) == dev[at]
            assert r["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9) and r["identity_error"] < 1e-6
    w = np.array([[got[i, c + 1][0]["whitened"] for c in range(k)] for i in ids])
    for c in range(k):  # either sign
        assert min(np.abs(w[:, c] - want[:, c]).max(), np.abs(w[:, c] + want[:, c]).max()) < 1e-6


def test_whitening_query(spark):
    rows = Q.op12_embedding_whitening(spark, SF001).collect()
    table = spark.read.parquet(f"{SF001}/embeddings.parquet").limit(500).collect()
    check_whitening(rows, [r.vec_id for r in table], [r.embedding for r in table])
    assert {type(rows[0]["deviation"]), type(rows[0]["component"])} == {int}


def test_whitening_of_hard_rows(spark):
    rng = np.random.default_rng(1)
    good = [(k, [float(v) for v in rng.normal(size=3) * (1, 5, 0.01)]) for k in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0]), (104, []),
           (105, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 3, 4) for i, v in good + bad], "vec_id long, embedding array<double>, n int, component int")
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(out.collect(), [i for i, _ in good], [v for _, v in good])


def test_whitening_stays_exact_for_huge_entries(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(v) for v in rng.normal(size=2) * 2.0 ** 44]) for k in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_whitening(whitening.whiten(df).collect(), [i for i, _ in rows], [v for _, v in rows])
    far = spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<float>")
    assert len(whitening.whiten(far).collect()) in (3, 6)  # held within 2^62, no overflow


def test_whitening_without_variance_or_rows(spark):
    flat = spark.createDataFrame([(1, [1.0, 2.0])] * 3 + [(None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(flat).collect() == [] and whitening.whiten(flat.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.5])], "vec_id long, embedding array<double>")
    got = whitening.whiten(twice).collect()  # one direction varies; repeated and null ids count
    assert [(r.vec_id, r.component, r.n) for r in sorted(got, key=lambda r: (r.vec_id is None))] == [(1, 1, 3), (1, 1, 3), (None, 1, 3)]


def test_polarisation_gives_the_covariance_and_limbs_round_trip():
    rng = np.random.default_rng(4)
    x = rng.integers(-10 ** 6, 10 ** 6, size=(50, 4))
    sums = x.sum(axis=0)
    centre = sums // 50
    cov = whitening.covariance(50, [int(s - 50 * m) for s, m in zip(sums, centre)], [int(v) for v in whitening.pair_squares(x, centre)])
    want = [[sum((50 * int(r[i]) - int(sums[i])) * (50 * int(r[j]) - int(sums[j])) for r in x) // 50 for j in range(4)] for i in range(4)]
    assert cov == want
    values = [0, -1, 2 ** 31, -2 ** 31, 2 ** 63, -3 ** 60, 7 ** 80]
    back = [0] * len(values)
    for at, j, limb in zip(*whitening.limbs(values)):
        assert -2 ** 31 <= limb < 2 ** 32
        back[at] += limb << (32 * j)
    assert back == values


# ---- quality -----------------------------------------------------------------------------------------------------

def test_quality_held_out(spark):
    rows = Q.op11_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows) and len(rows) == 1000
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.97
    low, high = ([r.score for r in held if labels[r.doc_id] == y] for y in (0, 1))
    assert sum(a < b for a in low for b in high) / (len(low) * len(high)) > 0.99


def test_quality_hard_rows(spark):
    docs = [(i, f"good plain words number {i} of a text") for i in range(60)] + [(i, f"&&& ### %%% !!{i}") for i in range(60, 120)]
    docs += [(200, None), (201, ""), (202, " \t\n"), (None, "no id"), (None, "no id"), (3, "same id, other text"), (203, "Word " * 200_000),
             (204, "x" * 300_000), (205, "😀 wörter"), (206, "nul \x00 character")]
    labels = [(i, int(i < 60)) for i in range(120)] + [(None, 1), (200, None), (205, 7), (5, 0), (5, 0)]
    d = spark.createDataFrame([(i, t, 1, "q") for i, t in docs], "doc_id long, text string, score int, y string")
    y = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(d, y)
    rows = quality.score(d, model).collect()
    assert rows[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"} and len(rows) == len(docs)
    by = {r.doc_id: r for r in rows}
    assert sum(by[i].predicted == 1 for i in range(60) if i != 3) > 55 and sum(by[i].predicted == 0 for i in range(60, 120)) > 55
    assert by[200].score == by[201].score == by[202].score and by[None].held_out
    assert len({r.score for r in rows if r.doc_id is None}) == 1
    again = quality.train(d, y)
    assert (model.vectors == again.vectors).all() and model.prior == again.prior
    assert quality.score(d.limit(0), model).collect() == []


def test_quality_with_one_label_or_none(spark):
    d = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string")
    one = spark.createDataFrame([(i, 0) for i in range(9)], "doc_id long, quality int")
    assert {r.score for r in quality.score(d, quality.train(d, one)).collect()} == {0.0}
    assert {(r.score, r.predicted) for r in quality.score(d, quality.train(d, one.limit(0))).collect()} == {(0.5, 1)}


def test_a_slice_score_equals_the_mean_of_the_vectors():
    rng = np.random.default_rng(0)
    model = quality.Model(rng.normal(size=(quality.FEATURES, 3)).astype(np.float32), rng.normal(size=(3, 2)).astype(np.float32), 0.25)
    texts = ["one two two two three", "é " * 50, "", None, "one"]
    got = quality.Scorer(model.weights, model.prior, None).scores(texts)
    for t, s in zip(texts, got):
        ids, counts = quality.document_counts(t or "")
        out = (counts / counts.sum()) @ model.vectors[ids].astype(float) @ model.layer.astype(float) if len(ids) else np.zeros(2)
        out = out + [0, model.prior]
        assert s == pytest.approx(np.exp(out[1]) / np.exp(out).sum(), rel=1e-5)


def test_features_of_a_word():
    ids, start = quality.word_features([b"ab", "é".encode()])
    assert np.diff(start).tolist() == [2 + 1 + 1, 1 + 1]  # <ab> has two 3-grams and one 4-gram; <é> one 3-gram; the word itself
    one, _ = quality.word_features([b"ab"])
    assert sorted(one) == sorted(ids[:4]) and sum(i < 1 << quality.WORD_BITS for i in ids) == 2
