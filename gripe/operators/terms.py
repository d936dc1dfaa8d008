"""Term statistics: frequencies, vocabularies, TF-IDF by company, bigrams,
the word graph and word-cloud counts (A2, A10, A11, K1, M3, M4, M15-M17, W1, W5, W6).

Nothing here concatenates the text of a company: a company "document" is
represented by its ``(company, term) → tf`` table, which Spark builds with
map-side partial aggregation, so a company holding a third of all rows costs
no more than any other key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as TX
from ..session import materialize, ship


def analysis_tokens(text: "Column | str", stop: Sequence[str]) -> Column:
    """Word tokens (F9) minus the stop list (exact match, J5)."""
    stop_s = sorted(set(stop))
    toks = TX.word_tokens(text)
    return F.filter(toks, lambda x: ~x.isin(stop_s)) if stop_s else toks


def _not_stop(c: Column, stop: Sequence[str]) -> Column:
    stop_s = sorted(set(stop))
    return ~c.isin(stop_s) if stop_s else F.lit(True)


def term_stats(df: DataFrame, tokens: "Column | str", stop: Sequence[str] = ()) -> DataFrame:
    """Corpus term frequency and document frequency per term (A10, A11): (term, tf, df).

    Tokens are sorted inside the row (n log n), so equal terms sit side by
    side and a term is new to its document where it differs from its
    predecessor: one explode gives both counts, and the map-side partial
    aggregate collapses frequent terms before the shuffle.  The sorted array
    is materialised in its own projection so it is built once per row.
    """
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    s = df.select(F.sort_array(t).alias("_s"))  # array_sort calls a comparison lambda for each pair of tokens
    prev = F.slice(F.concat(F.array(F.lit(None).cast("string")), F.col("_s")), 1, F.size("_s"))
    e = s.select(F.inline(F.arrays_zip(F.col("_s").alias("term"), prev.alias("prev"))))
    # stop words are dropped after the explode (a codegen'd predicate rather than
    # an array lambda); equal terms stay adjacent, so the first-flags are unchanged
    e = e.filter(_not_stop(F.col("term"), stop))
    first = (F.col("prev").isNull() | (F.col("prev") != F.col("term"))).cast("long")
    return e.groupBy("term").agg(F.count(F.lit(1)).alias("tf"), F.sum(first).alias("df"))


def term_df(df: DataFrame, text: str = "cleaned", stop: Sequence[str] = (), min_df: int = 5) -> DataFrame:
    """Terms whose document frequency is at least ``min_df``."""
    return term_stats(df, TX.word_tokens(text), stop).filter(F.col("df") >= min_df)


def vocabulary(stats: DataFrame, size: int, freq: str = "tf", term: str = "term") -> DataFrame:
    """The ``size`` most frequent terms; ties by term (K1).  Bounded by ``size``."""
    return stats.orderBy(F.desc(freq), F.asc(term)).limit(size)


def lda_vocabulary(df: DataFrame, text: str = "cleaned", stop: Sequence[str] = (), min_df: int = 5,
                   size: int = 1000) -> DataFrame:
    """Bag-of-words vocabulary for the topic model: df ≥ min_df, then top ``size`` by tf (M4)."""
    return vocabulary(term_df(df, text, stop, min_df), size)


def company_term_tf(df: DataFrame, text: str = "cleaned", stop: Sequence[str] = (),
                    by: str = "company") -> DataFrame:
    """(company, term) → tf: the term counts of each company's concatenated text (A2)."""
    e = df.filter(F.col(by).isNotNull()).select(by, F.explode(TX.word_tokens(text)).alias("term"))
    return e.filter(_not_stop(F.col("term"), stop)).groupBy(by, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_by_company(df: DataFrame, text: str = "cleaned", stop: Sequence[str] = (), size: int = 30,
                     top: int | None = 5, by: str = "company") -> DataFrame:
    """Smoothed, L2-normalised TF-IDF of company documents over the ``size``
    most frequent terms; optionally the ``top`` terms per company (M3, W1, W3).

    idf = ln((1 + N) / (1 + df)) + 1 with N companies and df the number of
    companies using the term; the norm runs over the vocabulary terms only.
    """
    return tfidf_from_counts(company_terms(df, text, stop, by), size, top, by)


def company_terms(df: DataFrame, text: str = "cleaned", stop: Sequence[str] = (), by: str = "company", *more: str) -> DataFrame:
    """(company, term) → tf, with one null term per row; ``more`` are further grouping columns.

    Every company is a document, also one whose text has no term left: each row adds one null term, so the companies
    are counted from the same pass over the input."""
    tokens = F.array_append(F.coalesce(TX.word_tokens(text), F.array().cast("array<string>")), F.lit(None).cast("string"))
    e = df.filter(F.col(by).isNotNull()).select(*more, by, F.explode(tokens).alias("term"))
    return (e.filter(F.col("term").isNull() | _not_stop(F.col("term"), stop))
            .groupBy(*more, by, "term").agg(F.count(F.lit(1)).alias("tf")))


def tfidf_from_counts(every: DataFrame, size: int = 30, top: int | None = 5, by: str = "company") -> DataFrame:
    """TF-IDF from the counts of :func:`company_terms`."""
    n_docs = every.filter(F.col("term").isNull()).agg(F.count(F.lit(1))).scalar()
    tf = every.filter(F.col("term").isNotNull())
    stats = tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    vocab = vocabulary(stats, size, freq="total")
    # vocab has at most ``size`` rows: a bounded broadcast
    w = (tf.join(F.broadcast(vocab.select("term", "df")), "term")
         .withColumn("w", F.col("tf") * (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1)))
    # one partition per company holds at most ``size`` rows
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(by)))
    out = w.select(by, "term", (F.col("w") / norm).alias("tfidf"))
    if top is None:
        return out
    rn = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("tfidf"), F.asc("term")))
    return out.withColumn("rank", rn).filter(F.col("rank") <= top)


def top_bigrams_sketched(df: DataFrame, text: str = "cleaned", n: int = 15, **options) -> DataFrame:
    """The same as :func:`top_bigrams` for corpora whose distinct pairs are too many to shuffle: ``df`` should be a stored
    table, because it is read twice and a sample of its texts once more (:func:`heavy_hitters`)."""
    def pairs(rows: DataFrame) -> DataFrame:
        return _bigram_rows(rows, text)

    return heavy_hitters(pairs(df), "bigram", n, draw=lambda share: pairs(df.sample(fraction=share, seed=7)), **options)


def top_bigrams(df: DataFrame, text: str = "cleaned", n: int = 15) -> DataFrame:
    """The ``n`` most frequent adjacent word pairs of the corpus, no stop list."""
    return vocabulary(bigram_counts(df, text), n, freq="n", term="bigram")


def heavy_hitters(items: DataFrame, item: str, n: int, sample: float = 0.01, depth: int = 3, width: int = 1 << 16,
                  trial: int = 1000, draw: Callable[[float], DataFrame] | None = None) -> DataFrame:
    """The ``n`` most frequent values of ``item`` with their exact counts ``n``, ties by value, without a shuffle of every
    distinct value (M15, K1).

    1. The counts of the ``trial`` values that are most frequent in a hash sample are taken over all rows; the n-th
       largest of these true counts is a lower bound on the n-th largest of all.
    2. In the same pass every row adds to one of ``width`` cells in each of ``depth`` rows of a count-min sketch.  A value can
       reach the bound only if each of its cells does.
    3. A second pass counts exactly the values all of whose cells reach the bound.

    The sample decides how many values the second pass counts, not which come out.  A task sends at most
    depth x width cells and ``trial`` counts, and in the second pass only candidates; the broadcast tables hold the trial values and
    the cells that reach the bound.  ``items`` is read three times; with ``draw``, which gives the items of a share of
    the input rows, the sample is taken before items are made, and they are read twice.  Null values are left out."""
    rows = items.filter(F.col(item).isNotNull()).select(F.col(item).alias("item"))
    some = draw(sample).filter(F.col(item).isNotNull()).select(F.col(item).alias("item")) if draw else (
        rows.sample(fraction=sample, seed=7))
    drawn = some.groupBy("item").agg(F.count(F.lit(1)).alias("c"))
    # at most ``trial`` values are broadcast, and at most ``n`` counts reach the driver; a trial value is counted under a
    # negative number, so that the sketch is grouped by one number; one hash of the value gives its cell in every row
    likely = drawn.orderBy(F.desc("c"), F.asc("item")).limit(trial).select(
        "item", (F.row_number().over(Window.orderBy("item")) - 1).cast("long").alias("_likely"))
    likely = F.broadcast(materialize(likely, "topk-trial"))
    low, high = F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("_h", 32)
    cells = [F.pmod(low + high * F.lit(d), F.lit(width)) + F.lit(d * width) for d in range(depth)]
    told = rows.join(likely, "item", "left").select("_likely", F.xxhash64("item").alias("_h"))
    own = -F.col("_likely") - 1
    marks = told.select(F.explode(F.when(F.col("_likely").isNotNull(), F.array(own, *cells)).otherwise(F.array(*cells))).alias("m"))
    counts = materialize(marks.groupBy("m").agg(F.count(F.lit(1)).alias("c")), "topk-sketch")
    best = [r["c"] for r in counts.filter("m < 0").orderBy(F.desc("c")).limit(n).collect()]
    bound = best[-1] if len(best) == n else 1
    heavy = counts.filter((F.col("m") >= 0) & (F.col("c") >= bound)).select("m")
    kept = rows.withColumn("_h", F.xxhash64("item"))
    for d in range(depth):  # at most ``width`` cells each
        mine = heavy.filter((F.col("m") >= d * width) & (F.col("m") < (d + 1) * width)).select(F.col("m").alias(f"c{d}"))
        kept = kept.join(F.broadcast(mine), cells[d] == F.col(f"c{d}"), "left_semi")
    exact = kept.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary(exact, n, freq="n", term="item").select(F.col("item").alias(item), "n")


def _bigram_rows(df: DataFrame, text: str, *more: str) -> DataFrame:
    """One row per adjacent word pair (W6).  Words are joined after they became rows: generated code, where a lambda over
    the pairs of an array is interpreted."""
    toks = df.select(*more, TX.word_tokens(text).alias("_t"))  # built once, read 4 times below
    last = F.greatest(F.size("_t") - 1, F.lit(0))
    e = toks.select(*more, F.inline(F.arrays_zip(F.slice("_t", 1, last).alias("_a"), F.slice("_t", 2, last).alias("_b"))))
    return e.select(*more, F.concat_ws(" ", "_a", "_b").alias("bigram"))


def bigram_counts(df: DataFrame, text: str = "cleaned", *more: str) -> DataFrame:
    """Every adjacent word pair with its count; ``more`` are further grouping columns."""
    e = _bigram_rows(df, text, *more)
    return e.groupBy(*more, "bigram").agg(F.count(F.lit(1)).alias("n"))


def word_edges(bigram_counts: DataFrame, k: float = 4.0) -> DataFrame:
    """Undirected edges of the top bigrams.

    ``a b`` and ``b a`` are one edge; its weight is the last one written in
    descending-count order, i.e. the smaller count.  width = weight / max × k.
    """
    parts = F.split("bigram", " ")
    a, b = F.element_at(parts, 1), F.element_at(parts, 2)
    e = (bigram_counts.select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"), "n")
         .groupBy("src", "dst").agg(F.min("n").alias("weight")))
    mx = F.max("weight").over(Window.partitionBy())  # at most n rows
    return e.withColumn("width", F.col("weight") / F.coalesce(mx, F.lit(1)) * k)


def word_nodes(edges: DataFrame) -> DataFrame:
    """Distinct words of the graph with their degree (a self-loop counts twice)."""
    return (edges.select(F.explode(F.array("src", "dst")).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("degree")))


def _dunning(c12: Column, c1: Column, c2: Column, n: Column) -> Column:
    """Dunning's (1993) log-likelihood ratio of a word pair from its counts:
    pair c12, first word c1, second word c2, all words n.  0 when a word
    makes up the whole text."""
    def ll(k, m, x):
        return (F.log(F.greatest(x, F.lit(1e-10))) * k
                + F.log(F.greatest(1 - x, F.lit(1e-10))) * (m - k))
    p = c2 / n
    p1 = c12 / c1
    p2 = (c2 - c12) / (n - c1)
    s = ll(c12, c1, p) + ll(c2 - c12, n - c1, p) - ll(c12, c1, p1) - ll(c2 - c12, n - c1, p2)
    return F.when((n <= c1) | (n <= c2), F.lit(0.0)).otherwise(-2 * s)


def cloud_words(df: DataFrame, text: str = "cleaned", stop: Sequence[str] = (), n: int = 60,
                min_len: int = 3, min_chars: int = 11, by: str = "company",
                collocations: bool = False, threshold: float = 30.0, fold: bool = False) -> DataFrame:
    """Per-company word frequencies for the word cloud.

    Words are whitespace tokens not in the stop list with at least
    ``min_len`` characters.  When a company's kept text (words joined by a
    blank) is shorter than ``min_chars``, all of its words are used instead.
    Top ``n`` per company by count (ties by word) and the size relative to
    the company's top word.

    ``collocations=True`` also merges word pairs: adjacent kept words of a
    document whose log-likelihood score exceeds ``threshold`` become one
    entry ``"a b"`` with the pair count, and each of the two words loses that
    count (a word left with no count is dropped).  Pairs do not span
    documents.

    ``fold=True`` merges case forms and plurals (:func:`fold_forms`); it is for texts that keep their case.
    """
    if collocations:  # read for the words and for the pairs: the rows are made once
        df = materialize(df.filter(F.col(by).isNotNull()).select(by, text), "cloud-texts", "zstd")
    counts = company_words(df, text, by)
    return cloud_from_counts(counts, stop, n, min_len, min_chars, by, df if collocations else None, text, threshold, fold)


def company_words(df: DataFrame, text: str = "cleaned", by: str = "company", *more: str) -> DataFrame:
    """(company, word) → n over white-space tokens; ``more`` are further grouping columns."""
    e = df.filter(F.col(by).isNotNull()).select(*more, by, F.explode(F.split(text, f"[{TX.WS_CLASS}]+")).alias("word"))
    return e.filter(F.col("word") != "").groupBy(*more, by, "word").agg(F.count(F.lit(1)).alias("n"))


def cloud_from_counts(counts: DataFrame, stop: Sequence[str] = (), n: int = 60, min_len: int = 3, min_chars: int = 11,
                      by: str = "company", texts: DataFrame | None = None, text: str = "cleaned",
                      threshold: float = 30.0, fold: bool = False) -> DataFrame:
    """The cloud from the counts of :func:`company_words`; with ``texts`` also word pairs, which need the rows."""
    stop_s, df, collocations = sorted(set(stop)), texts, texts is not None
    counts = counts.withColumn("kept", (F.char_length("word") >= min_len) & ~F.col("word").isin(stop_s))
    if collocations:  # read many times below: written once, one narrow row per (company, word)
        counts = materialize(counts, "cloud-words")
    # per-company size of the kept text; one row per company, joined back
    # (AQE turns this into a broadcast when the measured side is small)
    stats = counts.groupBy(by).agg(
        (F.sum(F.when(F.col("kept"), F.col("n") * F.char_length("word")).otherwise(0))
         + F.sum(F.when(F.col("kept"), F.col("n")).otherwise(0)) - 1).alias("_kept_len"),
        F.sum(F.when(F.col("kept"), F.col("n")).otherwise(0)).alias("_n_kept"))
    if collocations:  # one row per company
        stats = materialize(stats, "cloud-sizes")
    chosen = (counts.join(stats, by)
              .filter(F.col("kept") | (F.col("_kept_len") < min_chars)))
    if collocations:
        chosen = _merge_collocations(df, chosen, stop_s, min_len, min_chars, by, text, threshold)
    if fold:
        chosen = fold_forms(chosen, by)
    rn = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), F.asc("word")))
    top = chosen.withColumn("rank", rn).filter(F.col("rank") <= n)
    rel = F.col("n") / F.max("n").over(Window.partitionBy(by))
    return top.select(by, "word", "n", "rank", rel.alias("rel"))


def fold_forms(counts: DataFrame, by: str = "company") -> DataFrame:
    """(by, word, n) with one row for all forms of a word.

    A word ending in one ``s`` counts for the word without it where the company uses that one too (compared
    without case).  Case forms are merged to the commonest of them, ties to the smallest.  Aggregates and one join
    over the distinct words of the companies."""
    low = F.lower("word")
    plural = low.endswith("s") & ~low.endswith("ss") & (F.char_length("word") > 1)
    base = F.when(plural, F.substr(low, F.lit(1), F.char_length(low) - 1))
    forms = counts.select(by, "word", "n", low.alias("_low"), base.alias("_base"))
    used = forms.select(by, F.col("_low").alias("_base")).distinct().withColumn("_used", F.lit(True))
    folded = forms.join(used, [by, "_base"], "left")
    one = F.coalesce("_used", F.lit(False))
    form = F.when(one, F.substr("word", F.lit(1), F.char_length("word") - 1)).otherwise(F.col("word"))
    each = folded.groupBy(by, F.when(one, F.col("_base")).otherwise(F.col("_low")).alias("_word"), form.alias("word")).agg(
        F.sum("n").alias("n"))
    best = each.groupBy(by, "_word").agg(F.min(F.struct((-F.col("n")).alias("most"), "word")).alias("_top"), F.sum("n").alias("n"))
    return best.select(by, F.col("_top.word").alias("word"), "n")


def _word_ids(counts: DataFrame, by: str) -> tuple[DataFrame, int]:
    """``counts`` with a number ``_id`` for each (``by``, word), a 64-bit hash under the returned seed.

    Numbers are compared instead of words below, so they must differ: they are counted, and where two words share one
    the next seed is taken."""
    for seed in range(100):
        ids = counts.withColumn("_id", F.xxhash64(F.lit(seed), by, "word"))
        n = ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_id").alias("distinct")).first()
        if n["n"] == n["distinct"]:
            return ids, seed
    raise RuntimeError("no seed gives every word a number of its own")


def _common_from(sizes: dict[int, int], rows: int) -> int:
    """The smallest k for which at most ``rows`` words are used 2^k times or more; ``sizes``: words by floor(log2(uses))."""
    least, total = max(sizes, default=0) + 1, 0
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > rows:
            break
        least = k
    return least


def _may_exceed(threshold: float, most: int, low: int, high: int):
    """Drops the pairs whose score cannot exceed ``threshold``, with a margin of 1 for rounding; the rest is scored later.

    An unknown count lies between the pair's and ``most``, an unknown number of words between ``low`` and ``high``."""
    def xlogx(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1.0))

    def score(k, c1, c2, n) -> np.ndarray:
        return 2 * (xlogx(k) + xlogx(c1 - k) + xlogx(c2 - k) + xlogx(n - c1 - c2 + k) + xlogx(n)
                    - xlogx(c1) - xlogx(n - c1) - xlogx(c2) - xlogx(n - c2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def known(at: int, other) -> np.ndarray:
                c = batch.column(at)
                return np.where(c.is_null().to_numpy(zero_copy_only=False), other, c.fill_null(0).to_numpy()).astype(np.float64)

            k = known(2, 0)
            more1, more2, least_n = known(3, np.maximum(k, most)), known(4, np.maximum(k, most)), known(5, low)
            may = ((more1 + more2 - k > least_n) | (score(k, known(3, k), known(4, k), known(5, high)) > threshold - 1)
                   | (score(k, more1, more2, least_n) > threshold - 1))
            yield batch.filter(pa.array(may))

    return run


def _merge_collocations(df: DataFrame, chosen: DataFrame, stop_s: list, min_len: int, min_chars: int,
                        by: str, text: str, threshold: float, common: int = 500_000) -> DataFrame:
    """Collocation step of :func:`cloud_words` for companies that use their kept words.

    Pairs are counted as two numbers, so the one shuffle of all pairs moves no word.  The counts of the ``common``
    commonest words are broadcast (two numbers and a size each), and a pair of such words is scored where it was counted.
    The count of a rarer word lies between the pair's and the smallest count broadcast; of a pair that attracts, the score
    is largest where the words are rarest and the company is largest, of one that repels, at the other ends.  A pair that reaches the
    threshold at neither is left out too, and the rest is joined by shuffles."""
    chosen, seed = _word_ids(chosen, by)
    kept = df.filter(F.col(by).isNotNull()).select(by, TX.keep_words(F.split(text, f"[{TX.WS_CLASS}]+"), stop_s, min_len).alias("_k"))
    kept = kept.select(F.transform("_k", lambda w: F.xxhash64(F.lit(seed), F.col(by), w)).alias("_k"))
    last = F.greatest(F.size("_k") - 1, F.lit(0))
    pairs = kept.select(F.inline(F.arrays_zip(F.slice("_k", 1, last).alias("id1"), F.slice("_k", 2, last).alias("id2"))))
    pc = pairs.groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("c12"))
    uses = chosen.filter(F.col("kept") & (F.col("_kept_len") >= min_chars)).select("_id", "n", F.col("_n_kept").alias("nw"))

    def first(u: DataFrame) -> DataFrame:
        return u.select(F.col("_id").alias("id1"), F.col("n").alias("c1"), "nw")

    def second(u: DataFrame) -> DataFrame:
        return u.select(F.col("_id").alias("id2"), F.col("n").alias("c2"))

    def exceeds(rows: DataFrame) -> DataFrame:
        return rows.filter(_dunning(*[F.col(c).cast("double") for c in ("c12", "c1", "c2", "nw")]) > threshold)

    size = F.floor(F.log2("n")).cast("int")
    held = uses.groupBy(size.alias("k")).agg(F.count(F.lit(1)).alias("words"), F.min("nw").alias("low"), F.max("nw").alias("high")).collect()
    least = _common_from({r["k"]: r["words"] for r in held}, common)  # at most 64 rows
    low, high = min((r["low"] for r in held), default=0), max((r["high"] for r in held), default=0)
    top = uses.filter(size >= least)
    met = pc.join(F.broadcast(first(top)), "id1", "left").join(F.broadcast(second(top)), "id2", "left")
    ship(df.sparkSession)
    met = met.select("id1", "id2", "c12", "c1", "c2", "nw").mapInArrow(
        _may_exceed(threshold, (1 << least) - 1, low, high), "id1 long, id2 long, c12 long, c1 long, c2 long, nw long")
    told = F.col("c1").isNotNull() & F.col("c2").isNotNull()
    met = materialize(met, "cloud-pairs")
    rare = met.filter(~told).select("id1", "id2", "c12").join(first(uses), "id1").join(second(uses), "id2")
    both = exceeds(met.filter(told)).select("id1", "id2", "c12").unionByName(exceeds(rare).select("id1", "id2", "c12"))
    col = materialize(both, "cloud-collocations")
    red = (col.select(F.explode(F.array("id1", "id2")).alias("_id"), "c12")
           .groupBy("_id").agg(F.sum("c12").alias("_red")))
    left = (chosen.join(red, "_id", "left")
            .withColumn("n", F.col("n") - F.coalesce(F.col("_red"), F.lit(0))).filter(F.col("n") > 0)
            .select(by, "word", "n"))
    words = chosen.select("_id", by, "word")
    merged = (col.join(words.select(F.col("_id").alias("id1"), by, F.col("word").alias("w1")), "id1")
              .join(words.select(F.col("_id").alias("id2"), F.col("word").alias("w2")), "id2")
              .select(by, F.concat_ws(" ", "w1", "w2").alias("word"), F.col("c12").alias("n")))
    return left.unionByName(merged)
