"""Exact dedup, SimHash, embedding and suffix dedup against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gripe.llm import components, embedding_dedup, exact_dedup, simhash, suffix_dedup
from tests.conftest import SF001

from .conftest import HARD


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def _order(i):
    return (i is None, i or 0)


def brute_exact(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(_norm(t), []).append(i)
    out, done = [], set()
    for i, t, *_ in sorted(rows, key=lambda r: _order(r[0])):
        ids = sorted(groups[_norm(t)], key=_order)
        out.append((i, ids[0], len(ids), _norm(t) not in done, hashlib.sha256(_norm(t).encode()).hexdigest()))
        done.add(_norm(t))
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(make, weak):
    fn = (lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 3), 32, "0"))) if weak else exact_dedup.content_hash
    got = exact_dedup.exact_dedup(make(HARD), hash_fn=fn)
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == brute_exact(HARD)


def test_exact_keep_first_keeps_one_row_per_text_with_its_columns(make):
    docs = make(HARD)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(_norm(r.text) for r in rows) == sorted({_norm(r[1]) for r in HARD})


def brute_fp(text, k=3):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    sh = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, radius=2):
    label = dict(enumerate(range(len(fps))))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = label[i], label[j]
                if a != b:
                    label = {k: (b if v == a else v) for k, v in label.items()}
    return label


def check_simhash(rows, got):
    fps = [brute_fp(t) for _, t, *_ in rows]
    label = brute_components(fps)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[label[k]] = min(i, least.get(label[k], i))
    want = sorted(((i, f"{fps[k]:016x}", least.get(label[k])) for k, (i, *_) in enumerate(rows)), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=repr) == want


def test_simhash_hard_rows(make):
    check_simhash(HARD, simhash.simhash_near_dedup(make(HARD)))


def test_simhash_hash_is_sparks_xxhash64(spark):
    r = spark.sql("SELECT xxhash64('the cat sat') AS h").first()
    assert simhash.fingerprint(b"The CAT\nsat") == r.h % (1 << 64)


def test_simhash_whole_table_and_small_blocks(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    near = docs.filter("doc_id % 3 = 0").select((F.col("doc_id") + 100_000).alias("doc_id"),
                                                F.concat("text", F.lit(" tail")).alias("text"))
    both = docs.select("doc_id", "text").unionByName(near)
    rows = [(r.doc_id, r.text) for r in both.collect()]
    check_simhash(rows, simhash.simhash_near_dedup(both, block=2))


def test_near_links_over_every_distance(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        for _ in range(20):
            flips = rng.choice(64, size=int(rng.integers(1, 5)), replace=False)
            fps.add(int(b) ^ sum(1 << int(f) for f in flips))
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    found = {r.node: r.component for r in components.components(simhash.near_links(df, block=3)).collect()}
    label = brute_components(fps)
    for i in range(len(fps)):
        for j in range(i):
            a, b = (int(np.uint64(fps[k]).view(np.int64)) for k in (i, j))
            assert (found.get(a, a) == found.get(b, b)) == (label[i] == label[j])


def test_components_of_a_path_a_star_and_a_loop(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(7, 7), (9, 8)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[k] for k in range(500, 560)} == {500}
    assert got[9] == got[8] == 8 and 7 not in got


def test_embedding_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    far = rng.standard_normal((300, 16))
    near = far[:120] + 0.1 * rng.standard_normal((120, 16))
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(np.concatenate([far, near]))]
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1001, rows[0][1]), (1002, None), (1003, [0.0] * 16), (1004, []),
             (1005, [float("nan")] * 16), (1006, [1.0, None] + [0.0] * 14), (1007, [float("inf")] + [0.0] * 15),
             (1008, [3.0, 4.0]), (1009, [6.0, 8.1]), (None, rows[5][1])]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("node", T.IntegerType())])
    df = spark.createDataFrame([(*r, 0) for r in rows], schema)
    got = embedding_dedup.embedding_near_dedup(df, block=16).collect()

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array([np.float32(x) for x in v], dtype=np.float64)
        return a / np.linalg.norm(a)

    u = [unit(v) for _, v in rows]
    links = [[j for j in range(len(rows)) if j != i and u[i] is not None and u[j] is not None
              and len(u[i]) == len(u[j]) and u[i] @ u[j] >= 0.9] for i in range(len(rows))]
    want_links = sum(map(len, links))
    assert sum(r.n_links for r in got) >= 0.9 * want_links and want_links > 200
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i]] + [label[j] for j in links[i]]) for i in range(len(rows))]
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[label[k]] = min(i, least.get(label[k], i))
    want = sorted(((i, len(links[k]), least.get(label[k])) for k, (i, _) in enumerate(rows)), key=repr)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == want


def test_rows_that_share_an_id_have_links_of_their_own(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    near_a, near_b = [1.0, 0.1, 0.0, 0.0], [0.0, 1.0, 0.1, 0.0]
    rows = [(1, a), (1, b), (2, near_a), (3, near_b), (4, near_b), (None, [0.0, 0.0, 0.0, 1.0]), (None, [0.0, 0.0, 1.0, 0.0])]
    got = embedding_dedup.embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id) == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 2, 1)]
    assert [(r.n_links, r.component_id) for r in got if r.vec_id is None] == [(0, None)] * 2


@pytest.mark.parametrize("dims", [64, 16])
def test_recall_on_planted_pairs_near_the_threshold(spark, dims):
    """Pairs at cosine 0.90 to 0.93: at least 95 % are found, and nothing below 0.9."""
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(1500, dims))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    turn = rng.normal(size=base.shape)
    turn -= (turn * base).sum(1, keepdims=True) * base
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    c = rng.uniform(0.9, 0.93, size=(len(base), 1))
    x = np.concatenate([base, c * base + np.sqrt(1 - c * c) * turn])
    links = (x @ x.T >= 0.9).sum(1) - 1
    got = embedding_dedup.embedding_near_dedup(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    found = np.array([r.n_links for r in sorted(got, key=lambda r: r.vec_id)])
    assert (found <= links).all() and found.sum() >= 0.95 * links.sum() and links.sum() >= 3000


def test_visits_stay_few_as_the_table_grows():
    rng = np.random.default_rng(11)
    x = rng.standard_normal((6000, 16))
    visits = []
    for n in (6_000, 6_000 * 64):
        books, slack = embedding_dedup.plan_index(x, n)
        d1, d2 = embedding_dedup.half_distances(embedding_dedup.unit(x[:300]), books)
        visits.append(np.mean([len(c[c >= c[0]]) for c in embedding_dedup.visited(d1, d2, slack)]))
    assert visits[1] < 8 * visits[0]  # 64 times the vectors


def test_the_nearest_cell_is_always_visited():
    x = np.ones((50, 8)) * 0.1
    books, slack = embedding_dedup.plan_index(x, 50)
    for c in embedding_dedup.visited(*embedding_dedup.half_distances(embedding_dedup.unit(x), books), slack - 1e-9):
        assert len(c) >= 1


def test_traversal_order_and_recall():
    rng = np.random.default_rng(2)
    d1, d2 = rng.random((20, 9)), rng.random((20, 9))
    for r, cells in enumerate(embedding_dedup.visited(d1, d2, 0.4)):
        cost = (d1[r][:, None] + d2[r][None, :]).ravel()
        want = [c for c in np.argsort(cost, kind="stable") if cost[c] <= cost.min() + 0.4]
        assert sorted(cells.tolist()) == sorted(want) and (np.diff(cost[cells]) >= 0).all()


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    order = sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (_order(r[0]), r[1]))
    for i, t in order:
        b = t.encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = True
            seen.add(w)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[(i, t)] = (i, len(b), int(gone.sum()), spans,
                       hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return sorted((out[(r[0], r[1] or "")] for r in rows), key=repr)


def _repeat_rows():
    rng = np.random.default_rng(4)
    words = ["wort%d" % k for k in range(300)]
    passage = " ".join(rng.choice(words, 60))
    rows = [(k, " ".join(rng.choice(words, 40)) + f" {k} " + passage[k % 7:] + " " + " ".join(rng.choice(words, 30)))
            for k in range(40)]
    rows += [(100, "ab" * 400), (101, "x" * 5000), (102, passage), (103, rows[3][1]), (None, passage), (104, None), (105, ""),
             (106, "ä" * 60), (106, "ä" * 60), (107, passage[:99]), (108, passage[5:105])]
    return [(i, t, None, None) for i, t in rows]


def _hot_rows():
    """Short documents around one common line, longer and shorter than a window, with edges that are shared by some."""
    rng = np.random.default_rng(8)
    words = ["w%d" % k for k in range(4000)]
    line = " ".join(rng.choice(words, 18))
    ends = [" ".join(rng.choice(words, 12)) for _ in range(5)]
    rows = []
    for k in range(120):
        part = [line, line[:95], line[3:92], line[:99], line[10:]][k % 5]
        tail = ends[k % 5][:5 + k % 23] if k % 3 else ""
        rows.append((k, " ".join(rng.choice(words, 15)) + " " * (k % 4) + part + tail + " ".join(rng.choice(words, 9)), None, None))
    return rows


@pytest.mark.parametrize("share", [2048, 3, 1])
def test_suffix_dedup_splits_hot_anchors(make, share):
    rows = _hot_rows()
    got = suffix_dedup.suffix_dedup(make(rows), share_anchors=share).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == brute_repeats(rows)


def test_equal_windows_have_equal_block_keys():
    rng = np.random.default_rng(2)
    for _ in range(60):
        core = rng.integers(97, 101, 140, dtype=np.uint8).tobytes()
        texts = [rng.integers(97, 101, 60, dtype=np.uint8).tobytes() + core + rng.integers(97, 101, 60, dtype=np.uint8).tobytes() for _ in range(2)]
        for width in (16, 8, 4, 2, 1):
            keys = []
            for t in texts:
                data = np.frombuffer(t, np.uint8)
                units, counts, first, runs, fps = suffix_dedup.cut(data, np.array([0, len(t)]))
                ends = np.append(runs[1:], len(t) - 99)
                of = {}
                for lo, hi in zip(runs.tolist(), ends.tolist()):
                    blocks = suffix_dedup.blocks_of(t[lo:hi + 99], hi - lo, width, 100)
                    assert sum(m for *_, m in blocks) == hi - lo and all(0 < m <= width for *_, m in blocks)
                    for key, s, m in blocks:
                        of.update({t[w:w + 100]: key for w in range(lo + s, lo + s + m)})
                keys.append(of)
            both = keys[0].keys() & keys[1].keys()
            assert len(both) >= 41 and all(keys[0][w] == keys[1][w] for w in both)


def test_a_share_stays_within_the_suffix_array(make):
    with pytest.raises(ValueError):
        suffix_dedup.suffix_dedup(make(HARD), share_anchors=6000)


@pytest.mark.parametrize("share", [2048, 1])
def test_suffix_dedup_matches_brute_force(make, share):
    rows = _repeat_rows()
    got = suffix_dedup.suffix_dedup(make(rows), share_anchors=share).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == brute_repeats(rows)


def test_suffix_dedup_hard_rows_and_long_pieces(make, monkeypatch):
    rows = [r for r in HARD if r[0] != 7] + [(20, "long " * 3000, None, None)]
    got = suffix_dedup.suffix_dedup(make(rows)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == brute_repeats(rows)


def test_suffix_order_is_the_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(200):
        t = rng.integers(1, rng.integers(2, 5) + 1, int(rng.integers(0, 60)))
        want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
        assert suffix_dedup.suffix_order(t, 10 ** 6).tolist() == want


@pytest.mark.parametrize("op", [exact_dedup.exact_dedup, simhash.simhash_near_dedup, suffix_dedup.suffix_dedup])
def test_empty_documents(make, op):
    assert op(make([])).count() == 0


def test_empty_embeddings(spark):
    assert embedding_dedup.embedding_near_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_share_solver_finds_every_late_window():
    rng = np.random.default_rng(0)
    length = 6
    for turn in range(200):
        k = int(rng.integers(1, 6))
        counts = rng.integers(1, 8, k)
        ctx = [bytes(rng.integers(97, 99 + int(rng.integers(0, 20)), m + length - 1).astype(np.uint8)) for m in counts]
        if turn % 3 == 0 and k > 1:
            ctx[1], counts[1] = ctx[0], counts[0]
        key, at = rng.integers(0, 3, k), np.arange(k) * 100
        got = {(int(c), o) for c, lo, hi in zip(*suffix_dedup.repeats_of(ctx, counts, key, np.zeros(k, np.int64), at, length))
               for o in range(lo, hi + 1)}
        seen, want = set(), set()
        for j in sorted(range(k), key=lambda j: (key[j], at[j])):
            for o in range(counts[j]):
                w = ctx[j][o:o + length]
                if w in seen:
                    want.add((j, o))
                seen.add(w)
        assert got == want


def test_units_cover_every_window_once():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 5, 99, 100, 101, 700, 20_000)] + [b"x" * 9000]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.cumsum([0] + [len(t) for t in texts])
    units, counts, first, runs, fps = suffix_dedup.cut(data, offs)
    covered = np.zeros(len(data), dtype=int)
    for u, c in zip(units, counts):
        covered[u:u + c] += 1
    want = np.zeros(len(data), dtype=int)
    for a, z in zip(offs[:-1], offs[1:]):
        want[a:max(a, z - 99)] = 1
    assert (covered == want).all() and len(first) == len(units) and len(fps) == len(runs)
    assert (runs[first] == units).all() and counts.max() <= 2 * suffix_dedup.UNIT_MAX
