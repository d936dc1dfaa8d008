"""The pipeline's stages and its result against a brute-force version."""

import math
import re
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gripe.llm import language_id, mixing
from gripe.llm.common import stage_table
from tests.conftest import SF001

from .conftest import HARD
from .test_dedup_ops import _norm, brute_components, brute_fp


def stages(spark, docs):
    out = [docs]
    for _, f in corpus_pipeline.STAGES:
        out.append(stage_table(f(spark, out[-1], SF001), "stage"))
    return out


def key(r):
    return (r.doc_id is None, r.doc_id or 0, r.text or "")


def check(spark, docs):
    start, lang, exact, near, mixed, packed = stages(spark, docs)
    for d in (lang, exact, near, mixed):
        assert d.columns == docs.columns
    # language ID: exactly the documents the operator calls und or ambiguous go
    model = language_id.train(docs.filter(~language_id.held_out("doc_id")))
    judged = language_id.identify(docs, model, keep=True).collect()
    rows = sorted((r for r in judged if r.lang_pred != "und" and not r.ambiguous), key=key)
    assert [key(r) for r in rows] == sorted(map(key, lang.collect()))
    # exact dedup: one row for each text, with the smallest id
    first = {}
    for r in rows:
        first.setdefault(_norm(r.text), r)
    rows = sorted(first.values(), key=key)
    assert [key(r) for r in rows] == sorted(map(key, exact.collect()))
    # near dedup: one row for each component
    label = brute_components([brute_fp(r.text) for r in rows])
    first = {}
    for k, r in enumerate(rows):
        first.setdefault(label[k], r)
    rows = sorted(first.values(), key=key)
    assert [key(r) for r in rows] == sorted(map(key, near.collect()))
    # mixing: every document as often as taken, each source near its target
    repeats = mixing.mix(near).collect()
    assert mixed.count() == sum(r.repeats for r in repeats)
    by_source = {}
    for r in repeats:
        t = by_source.setdefault(r.source, [r.target, 0, 0])
        t[1] += r.taken
        t[2] = max(t[2], r.size)
    assert all(abs(t - got) <= big for t, got, big in by_source.values())
    # packing: the tokens of every row of the mix, cut and placed without gaps
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for r in mixed.collect():
        n = len(tok.encode(r.text, add_special_tokens=False).ids) + 1
        for k in range(0, n, 2048):
            p = (r.doc_id, k // 2048, k, min(2048, n - k))
            want[p] = want.get(p, 0) + 1
    have, seqs = {}, {}
    for r in packed.collect():
        p = (r.doc_id, r.piece, r.start, r.length)
        have[p] = have.get(p, 0) + 1
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert have == want
    for parts in seqs.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    assert len(seqs) <= math.ceil(1.02 * sum(r[3] * c for r, c in want.items()) / 2048) + 1
    return have


def test_pipeline_whole_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    have = check(spark, docs)
    got = {}
    for r in corpus_pipeline.run(spark, SF001).collect():
        p = (r.doc_id, r.piece, r.start, r.length)
        got[p] = got.get(p, 0) + 1
    assert got == have


def test_pipeline_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.language(spark, docs, "")
    lost = docs.join(kept.select("doc_id"), "doc_id", "left_anti").collect()
    assert not [r for r in lost if re.search(r"[a-z]{3}", r.text)]


def test_pipeline_keeps_close_decisions(spark, make):
    """Two languages with the same texts are equally near; their documents have a language all the same."""
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1][:40]  # all are learned from
    docs = make([(i, "the cat sat on the mat", ("en", "de")[k % 2], "a") for k, i in enumerate(ids)] + [(100, "12 --", "en", "a")])
    judged = language_id.identify(docs, language_id.train(docs.filter(~language_id.held_out("doc_id"))))
    assert judged.filter("ambiguous").count() == 40
    assert corpus_pipeline.language(spark, docs, "").count() == 40


def test_pipeline_hard_rows(spark, make):
    check(spark, make(HARD))


def test_pipeline_with_clashing_columns(spark, make):
    docs = make(HARD)
    for c in ("sha", "won_id", "won_sha", "m", "K", "hash", "full", "thr", "n", "copy", "lang_pred", "Score", "ambiguous", "kept",
              "c0", "text_hash", "component_id", "c"):
        if c.lower() not in {x.lower() for x in docs.columns}:
            docs = docs.withColumn(c, F.lit(5))
    plain = stages(spark, make(HARD))
    for a, b in zip(stages(spark, docs)[:5], plain[:5]):
        assert a.columns == docs.columns and sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_pipeline_empty(spark, make):
    assert [d.count() for d in stages(spark, make([]))] == [0] * 6


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
