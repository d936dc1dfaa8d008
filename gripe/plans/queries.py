"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the given tables (or data Spark derives from them) in
full.  Lexicon-dependent queries use the ``fixture`` profile, because the
synthetic corpus has no Turkish text; the ``*_reference_lexicon`` queries run
the original Turkish lists on the same data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as L
from ..functions import scoring as SC
from ..functions import sentiment as S
from ..functions import text as TX
from ..functions import dates as DT
from ..functions import phrases as PH
from ..functions import jsonio as JS
from ..operators import churn as CH
from ..operators import links as LK
from ..operators import topics as TP
from ..operators import topics_minibatch as TB
from ..operators import dedup as DD
from ..operators import report as RP
from ..operators import terms as TM
from ..session import materialize, read_table
from ..sources import complaints as CP
from ..sources import pages as PG
from . import analysis as AN

LEX = L.FIXTURE
R6 = 6  # float results are compared at 6 decimals


def enriched(spark: SparkSession, sf_dir: str, lexicon: L.Lexicon = LEX) -> DataFrame:
    """documents → complaint records → cleaned text + sentiment (every row)."""
    return CP.enrich(CP.documents_as_complaints(spark, sf_dir), lexicon)


def store(spark: SparkSession, sf_dir: str, lexicon: L.Lexicon = LEX, carry: "list[str] | None" = None) -> DataFrame:
    """The analysis input: cleaned records, null texts dropped, one row per cleaned
    text, then the sentiment (a function of the text, so it is scored once per text).
    ``carry``: only these columns, without text and sentiment."""
    d = CP.documents_as_complaints(spark, sf_dir)
    c = d.select("doc_id", "company", "date", "link",
                 TX.clean_text("content", lexicon.stream_stop).alias("cleaned"))
    if carry is not None:
        return DD.dedup_text(c, "cleaned", "doc_id", carry)
    return S.with_sentiment(DD.dedup_text(c, "cleaned", "doc_id"), "cleaned", lexicon, lowered=True)


def scored_store(spark: SparkSession, sf_dir: str, score: Callable[[DataFrame], DataFrame] = lambda df: df,
                 lexicon: L.Lexicon = LEX) -> DataFrame:
    """The rows of the store with sentiment and the columns that ``score`` adds, without the text.

    All of these are functions of the cleaned text, so rows are scored where they are read, and ids and scores alone go
    through the shuffle of the de-duplication."""
    d = CP.documents_as_complaints(spark, sf_dir).select(
        "doc_id", "company", TX.clean_text("content", lexicon.stream_stop).alias("cleaned"))
    r = score(S.with_sentiment(d, "cleaned", lexicon, lowered=True))
    return DD.dedup_text(r, "cleaned", "doc_id", [c for c in r.columns if c != "cleaned"])


def risk_store(spark: SparkSession, sf_dir: str, lexicon: L.Lexicon = LEX) -> DataFrame:
    return scored_store(spark, sf_dir, lambda df: CH.rule_risk_table(df, lexicon), lexicon)


def churn_store(spark: SparkSession, sf_dir: str, lexicon: L.Lexicon = LEX) -> DataFrame:
    return scored_store(spark, sf_dir, lambda df: CH.churn_features(df, lexicon, topic=None), lexicon)


# --- cleaning, dedup, sentiment -------------------------------------------

def q_clean_text(spark, sf):
    d = CP.documents_as_complaints(spark, sf)
    return d.select("doc_id", TX.clean_text("content", LEX.stream_stop).alias("cleaned"))


def q_clean_text_reference_lexicon(spark, sf):
    d = CP.documents_as_complaints(spark, sf)
    return d.select("doc_id", TX.clean_text("content", L.REFERENCE.stream_stop).alias("cleaned"))


def q_dedup_texts(spark, sf):
    return store(spark, sf).select("doc_id", "company", "cleaned")


def q_row_counts(spark, sf):
    return DD.row_counts(enriched(spark, sf), "cleaned")


def q_sentiment_rows(spark, sf):
    return enriched(spark, sf).select("doc_id", "company", "sentiment")


def q_sentiment_by_company(spark, sf):
    return scored_store(spark, sf).groupBy("company", "sentiment").agg(F.count(F.lit(1)).alias("n"))


def q_sentiment_reference_lexicon(spark, sf):
    e = enriched(spark, sf, L.REFERENCE)
    return e.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))


def q_lexicon_hits(spark, sf):
    e = enriched(spark, sf)
    return e.select(
        "doc_id",
        S.count_hits("cleaned", LEX.negative).alias("neg_hits"),
        S.count_hits("cleaned", LEX.positive).alias("pos_hits"),
        S.any_hit("cleaned", LEX.request).cast("int").alias("req_hit"),
        S.count_hits("cleaned", LEX.churn_critical_model).alias("crit_hits"),
        S.count_hits("cleaned", LEX.churn_medium).alias("mid_hits"),
        S.count_hits("cleaned", LEX.churn_critical_rule).alias("rule_crit_hits"),
    )


def q_sentiment_weight_lookup(spark, sf):
    s = scored_store(spark, sf)
    return (s.select("sentiment", S.sentiment_weight("sentiment").alias("sentiment_weight"))
            .groupBy("sentiment", "sentiment_weight").agg(F.count(F.lit(1)).alias("n")))


# --- rule risk and report tables --------------------------------------------

def q_rule_risk_rows(spark, sf):
    return risk_store(spark, sf).select("doc_id", "company", "rule_crit_hits", "rule_weight", "rule_risk",
                                        "risk_group")


def q_risk_share(spark, sf):
    # at most 101 scores: binning them keeps the aggregate over the rows small enough to compile
    scores = risk_store(spark, sf).groupBy("rule_risk").agg(F.count(F.lit(1)).alias("n"))
    counts = RP.category_counts(scores.withColumn("risk_group", SC.risk_bin("rule_risk")), "risk_group", L.RISK_LABELS, n="n")
    return RP.share_of_total(counts).select("risk_group", "n", F.round("pct", R6).alias("pct"))


def q_risk_heatmap(spark, sf):
    r = risk_store(spark, sf)
    t = RP.crosstab_pct(r, "company", "risk_group", L.RISK_LABELS, names=["low", "mid", "critical"])
    return t.select("company", *[F.round(c, R6).alias(c) for c in ("low", "mid", "critical")])


def q_company_volume(spark, sf):
    return RP.company_volume(store(spark, sf, carry=["company"]))


def q_high_risk_rows(spark, sf):
    return RP.high_risk(risk_store(spark, sf), "rule_risk", 75).select("doc_id", "company", "rule_risk")


def q_rule_risk_summary(spark, sf):
    s = RP.risk_summary(risk_store(spark, sf), "rule_risk", digits=None)
    return s.select("company", F.round("mean_risk", R6).alias("mean_risk"),
                    F.col("max_risk").cast("double").alias("max_risk"), "n")


def q_alarm_count(spark, sf):
    return RP.alarm_count(risk_store(spark, sf), "rule_risk", 75)


# --- churn features, label, split, metrics ----------------------------------

def q_churn_features(spark, sf):
    f = churn_store(spark, sf)
    return f.select("doc_id", "crit_hits", "mid_hits", "sentiment_weight", "churn_label")


def q_churn_label_rate(spark, sf):
    f = churn_store(spark, sf)
    return (f.groupBy("company").agg(F.sum("churn_label").cast("long").alias("n_churn"),
                                     F.count(F.lit(1)).alias("n"))
            .withColumn("rate", F.round(F.col("n_churn") / F.col("n"), R6)))


def q_split_buckets(spark, sf):
    s = store(spark, sf, carry=["doc_id", "link"])
    b = CH.split_bucket("link")
    return s.select("doc_id", b.alias("bucket"), (b < 20).alias("is_test"))


def q_split_exact(spark, sf):
    """A test set of exactly a fifth of the rows (M9)."""
    return CH.exact_split(store(spark, sf, carry=["doc_id", "link"]), "link", 0.2).select("doc_id", "is_test")


def q_confusion_metrics(spark, sf):
    """Metrics of the rule prediction (rule_risk ≥ 75) against the churn label."""
    r = scored_store(spark, sf, lambda df: CH.churn_features(CH.rule_risk_table(df, LEX), LEX, topic=None))
    r = r.withColumn("prediction", (F.col("rule_risk") >= 75).cast("int"))
    m = CH.binary_metrics(r, "churn_label", "prediction")
    return m.select("tp", "fp", "tn", "fn",
                    *[F.round(c, R6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


# --- term statistics ---------------------------------------------------------

def q_term_df_min5(spark, sf):
    return TM.term_df(store(spark, sf), "cleaned", LEX.analysis_stop, 5).select("term", "df")


def q_vocab_top1000(spark, sf):
    return TM.lda_vocabulary(store(spark, sf), "cleaned", LEX.analysis_stop, 5, 1000).select("term", "tf", "df")


def q_tfidf_top5(spark, sf):
    t = TM.tfidf_by_company(store(spark, sf), "cleaned", LEX.analysis_stop, 30, 5)
    return t.select("company", "term", "rank", F.round("tfidf", R6).alias("tfidf"))


def q_bigram_top15(spark, sf):
    return TM.top_bigrams(store(spark, sf), "cleaned", 15)


def q_bigram_top15_sketched(spark, sf):
    """The same word pairs without a shuffle of every distinct pair: a sketch bounds the candidates, a second pass counts
    them exactly (M15, K1)."""
    st = AN.materialize(store(spark, sf, carry=["cleaned"]), "sketch-store")
    return TM.top_bigrams_sketched(st, "cleaned", 15)


def _benchmark_pairs(spark, sf) -> DataFrame:
    """A phrase list that comes from data: the distinct adjacent word pairs of the benchmark texts."""
    words = F.split(F.lower(F.col("text")), " ")
    b = spark.read.parquet(f"{sf}/benchmark.parquet").select(words.alias("w"))
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))),
                        lambda i: F.concat_ws(" ", F.slice("w", i, F.lit(2))))
    return b.select(F.explode(pairs).alias("phrase")).distinct()


def q_phrase_hits_automaton(spark, sf):
    """How many listed phrases occur in each text: one walk of a broadcast automaton per text."""
    listed = [r["phrase"] for r in _benchmark_pairs(spark, sf).collect()]  # refused beyond MAX_BYTES
    d = CP.documents_as_complaints(spark, sf).select("doc_id", F.lower("content").alias("t"))
    return PH.count_phrases(d, listed, "t").select("doc_id", "hits")


def q_phrase_hits_joined(spark, sf):
    """The same with a phrase table of any size, joined by the phrases' first characters."""
    d = CP.documents_as_complaints(spark, sf).select("doc_id", F.lower("content").alias("t"))
    return PH.count_phrases_joined(d, _benchmark_pairs(spark, sf), "doc_id", "t", gram=8).select("doc_id", "hits")


def q_word_edges(spark, sf):
    e = TM.word_edges(TM.top_bigrams(store(spark, sf), "cleaned", 15))
    return e.select("src", "dst", "weight", F.round("width", R6).alias("width"))


def q_word_nodes(spark, sf):
    return TM.word_nodes(TM.word_edges(TM.top_bigrams(store(spark, sf), "cleaned", 15)))


def q_cloud_words(spark, sf):
    c = TM.cloud_words(store(spark, sf), "cleaned", LEX.analysis_stop, 60)
    return c.select("company", "word", "n", "rank", F.round("rel", R6).alias("rel"))


def q_cloud_words_folded(spark, sf):
    """The cloud of the uncleaned texts with case forms and plurals merged."""
    t = TM.cloud_words(CP.documents_as_complaints(spark, sf), "content", LEX.analysis_stop, 60, fold=True)
    return t.select("company", "word", "n", "rank", F.round("rel", R6).alias("rel"))


def q_cloud_words_collocations(spark, sf):
    c = TM.cloud_words(store(spark, sf), "cleaned", LEX.analysis_stop, 60, collocations=True)
    return c.select("company", "word", "n", "rank", F.round("rel", R6).alias("rel"))


# --- pages and links ---------------------------------------------------------

TEST_DOMAIN = "example.com"  # the synthetic pages live under *.example.{com,net,org}


def _pages(spark, sf):
    return read_table(spark, f"{sf}/pages.parquet")


def _page_links(spark, sf):
    return PG.page_links(_pages(spark, sf), PG.PLAIN_PAGES)


def _links(spark, sf):
    c = F.col("link")
    admitted = c.isNotNull() & c.contains(TEST_DOMAIN) & ~F.trim(c).endswith(L.BAD_LINK_SUFFIX)
    return _page_links(spark, sf).withColumn("admitted", admitted)


def q_page_main_text(spark, sf):
    return PG.read_pages(_pages(spark, sf), PG.PLAIN_PAGES).select("page_id", PG.main_text(PG.PLAIN_PAGES).alias("content"))


def q_page_paragraphs(spark, sf):
    return PG.read_pages(_pages(spark, sf), PG.PLAIN_PAGES).select("page_id", PG.paragraphs().alias("paragraphs"))


def q_page_links(spark, sf):
    return _page_links(spark, sf)


def q_page_links_dotted(spark, sf):
    """Each link's reference written in other ways (from the parent folder, with dot segments, with a query that holds
    dots, without scheme), then resolved as a browser does (X5)."""
    e = _page_links(spark, sf).join(_pages(spark, sf).select("page_id", "url"), "page_id")
    way = F.pmod(F.col("pos") + F.col("page_id"), F.lit(5))
    rest = F.substr("href", F.lit(2))
    href = (F.when(way == 0, F.concat(F.lit("../"), rest)).when(way == 1, F.concat(F.lit("./a/.././"), rest))
            .when(way == 2, F.concat(F.lit("/x/../../y/."), F.col("href"))).when(way == 3, F.concat(F.lit("?back=../"), rest))
            .otherwise(F.concat(F.lit("//www.example.com"), F.col("href"), F.lit("/..#a/../b"))))
    return e.select("page_id", "pos", href.alias("href"), PG.resolve_href(href, "url").alias("link"))


def q_page_text_marked(spark, sf):
    """The pages as the company site marks them up: the article's text moved into a marked block, the date into
    the header, a corporate reply on every third page; extracted with the site's own selectors (X1, X2, X4, P9, P10)."""
    third = F.when(F.col("page_id") % 3 == 0, F.lit("<p>De&#287;erli M\u00fc\u015fterimiz, yan\u0131t.</p>")).otherwise("")
    inner = F.regexp_extract("html", r"(?s)<article>(.*?)</article>", 1)
    body = F.regexp_replace(F.regexp_replace(inner, r"</?b>|<br>", ""), r"(?s)<h1>.*?</h1>", "")
    marked = F.regexp_replace(body, "<p>", "<p class='x wrap-anywhere'>")
    day = F.concat((F.col("page_id") % 28 + 1).cast("string"), F.lit("  May&nbsp;10:30"))
    html = F.concat(F.lit("<html><body><article><header><h2>Title that is long enough to be a text of its own</h2><span "
                          "data-base-ui-click-trigger aria-label='"), day, F.lit("'>yesterday</span></header>"
                    "<div class='a selection-share'>"), third, marked, F.lit("</div></article></body></html>"))
    pages = _pages(spark, sf).select("page_id", "url", html.alias("html"))
    read = PG.read_pages(pages, PG.CATEGORY_PAGES)
    return read.select("page_id", PG.main_text(PG.CATEGORY_PAGES).alias("content"), PG.page_date().alias("date"))


def q_link_admission(spark, sf):
    return LK.admit_links(_page_links(spark, sf), TEST_DOMAIN).select("page_id", "pos", "link")


def q_new_links_antijoin(spark, sf):
    """Admitted links not among the already crawled pages (the seen set)."""
    found = LK.admit_links(_page_links(spark, sf), TEST_DOMAIN).select("link")
    seen = _pages(spark, sf).select(F.col("url").alias("link"))
    return LK.new_links(found, seen)


def q_crawl_round_summary(spark, sf):
    seen = _pages(spark, sf).select(F.col("url").alias("link"))
    return LK.round_summary(_links(spark, sf), seen)


def q_page_records(spark, sf):
    """Pages → crawl records; the date falls back to a fixed crawl time (pages carry no date)."""
    now = F.lit("2024-05-05 10:30:00").cast("timestamp")
    r = PG.extract_records(_pages(spark, sf), now=now, sel=PG.PLAIN_PAGES)
    return r.select("link", "company", "date", "content", "crawl_timestamp")


def _crawl_log(spark, sf):
    """A crawl log from ``events``: site := user, listing page := hour since the start of 2024 (hours without
    events are pages never crawled), new links := purchases in that hour."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    hour = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / F.lit(3_600_000_000)) + 1
    return e.groupBy(F.col("user_id").alias("site"), hour.cast("int").alias("page_no")).agg(
        F.sum((F.col("event_type") == "purchase").cast("long")).alias("n_new"))


def q_crawl_low_yield_stop(spark, sf):
    """The page where the crawl of each site stops."""
    return LK.low_yield_stop(_crawl_log(spark, sf), "site", "page_no", "n_new")


def q_stream_watermark_dedup(spark, sf):
    """Records delivered twice, one file per micro-batch, into a plain append sink: only the
    stateful in-stream de-duplication (watermark on the crawl time) keeps one row per link (T6)."""
    from ..session import scratch_path
    from ..streaming import pipeline as PL
    src = _records_json(spark, sf, copies=2)
    out, ckpt = scratch_path(spark, "wm-out"), scratch_path(spark, "wm-ckpt")
    s = PL.dedup_stream(PL.process(PL.read_json_files(spark, f"{src}/*", 4), LEX), "link", "crawled_at", "1 hour")
    q = (s.select("link", "company", "sentiment").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def q_seen_set_union(spark, sf):
    """The seen set after a round: crawled pages ∪ newly admitted links."""
    seen = _pages(spark, sf).select(F.col("url").alias("link"))
    found = LK.admit_links(_page_links(spark, sf), TEST_DOMAIN).select("link")
    return LK.add_seen(seen, LK.new_links(found, seen))


def q_formatted_volume(spark, sf):
    """Company volume with display text: thousands separator and percent of all rows."""
    v = RP.share_of_rows(RP.company_volume(store(spark, sf, carry=["company"])))
    return v.select("company", SC.fmt_int("n").alias("n_text"), SC.fmt_pct("pct").alias("pct_text"))


# --- dates and JSON ----------------------------------------------------------

def q_month_standardise(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    en = F.date_format("ts", "d MMMM HH:mm")
    return e.select("event_id", en.alias("date_en"), DT.month_to_tr(en).alias("date_tr"))


def q_json_roundtrip(spark, sf):
    """documents → JSON records → decoded with the fixed schema."""
    d = CP.documents_as_complaints(spark, sf)
    enc = d.select("doc_id", F.to_json(F.struct("company", "date", "link", "content")).alias("value"))
    dec = enc.select("doc_id", JS.decode_json("value").alias("r"))
    return dec.select("doc_id", "r.company", "r.date", "r.link", "r.content")


def q_json_event_props(spark, sf):
    from pyspark.sql import types as T
    e = spark.read.parquet(f"{sf}/events.parquet")
    sch = T.StructType([T.StructField("k", T.IntegerType())])
    return e.select("event_id", JS.decode_json("props", sch).alias("p")).select("event_id", "p.k")


# --- topic model and forest (model results: rows-only checks) ---------------

def _topics(spark, sf):
    """The store written once (every pass of the model reads that table), and the fitted topics."""
    st = AN.materialize(store(spark, sf).select("doc_id", "company", "link", "cleaned", "sentiment"), "model-store")
    vocab, cv, model = TP.fit_topics(st, "cleaned", LEX.analysis_stop)
    return st, vocab, cv, model


def _with_topics(df, cv, model, name):
    """Rows with their topic, written once for the passes that follow."""
    return AN.materialize(TP.assign_topics(df, cv, model, "cleaned", LEX.analysis_stop).drop("topic_dist"), name)


def q_lda_topic_share(spark, sf):
    st, vocab, cv, model = _topics(spark, sf)
    named = _with_topics(st, cv, model, "topics").withColumn("topic_name", TP.name_topics("topic"))
    return RP.share_of_total(RP.value_counts(named, "topic_name"))


def q_lda_company_crosstab(spark, sf):
    st, vocab, cv, model = _topics(spark, sf)
    t = _with_topics(st, cv, model, "topics")
    return RP.crosstab_pct(t, "company", "topic", [1, 2, 3], names=["topic_1", "topic_2", "topic_3"], digits=2)


def q_topic_terms(spark, sf):
    st, vocab, cv, model = _topics(spark, sf)
    return TP.topic_terms(model, vocab, 10)


def _minibatch(spark, sf):
    st = AN.materialize(store(spark, sf).select("doc_id", "link", "cleaned"), "minibatch-store")
    return st, TB.fit_minibatch(st, "cleaned", LEX.analysis_stop, key="link")


def q_lda_minibatch_perplexity(spark, sf):
    """Updates made and held-out perplexity after each pass of the mini-batch topic model (M5)."""
    st, model = _minibatch(spark, sf)
    return spark.createDataFrame(model.history, "pass int, updates long, perplexity double")


def q_lda_minibatch_topics(spark, sf):
    """Each text with its dominant topic by the mini-batch topic model."""
    st, model = _minibatch(spark, sf)
    return model.assign(st.select("doc_id", "cleaned"), "cleaned", LEX.analysis_stop).select("doc_id", "topic", "topic_dist")


def _forest(spark, sf):
    st, vocab, cv, model = _topics(spark, sf)
    f = CH.churn_features(_with_topics(st, cv, model, "topics"), LEX, topic="topic")
    train, test = CH.hash_split(f, "link", 20)
    rf = CH.fit_forest(train)
    return f, test, rf


def q_rf_risk_summary(spark, sf):
    f, test, rf = _forest(spark, sf)
    return RP.risk_summary(CH.score_risk(rf, f), "churn_risk")


def q_rf_metrics(spark, sf):
    f, test, rf = _forest(spark, sf)
    return CH.binary_metrics(rf.transform(test), "churn_label", "prediction")


def q_rf_quality_metrics(spark, sf):
    """The same forest features against a given label: the ``quality`` flag of ``labels``, joined on doc_id before
    any de-duplication, so every labelled document counts."""
    st, vocab, cv, model = _topics(spark, sf)
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("quality_label"))
    every = enriched(spark, sf).select("doc_id", "company", "link", "cleaned", "sentiment").join(lab, "doc_id")
    f = CH.churn_features(_with_topics(every, cv, model, "labelled"), LEX, topic="topic")
    train, test = CH.hash_split(f, "link", 20)
    rf = CH.fit_forest(train, label="quality_label")
    return CH.binary_metrics(rf.transform(test), "quality_label", "prediction")


# --- the same operators on a topic that needs no model ------------------------

def _ruled_topics(spark, sf):
    """Topic := argmax of (negative, positive, churn-phrase) hits, first on ties."""
    s = store(spark, sf)
    dist = F.array(S.count_hits("cleaned", LEX.negative), S.count_hits("cleaned", LEX.positive),
                   S.count_hits("cleaned", LEX.churn_critical_model)).cast("array<double>")
    return s.withColumn("topic", SC.dominant_topic(dist))


def q_topic_argmax(spark, sf):
    """Dominant topic and its fixed name."""
    t = _ruled_topics(spark, sf)
    return t.select("doc_id", "topic", TP.name_topics("topic").alias("topic_name"))


def q_topic_share(spark, sf):
    """Counts and shares of the named topics, half-even rounding."""
    named = _ruled_topics(spark, sf).withColumn("topic_name", TP.name_topics("topic"))
    return RP.share_of_total(RP.value_counts(named, "topic_name"), digits=2)


def q_topic_company_crosstab(spark, sf):
    """Topic shares per company."""
    return RP.crosstab_pct(_ruled_topics(spark, sf), "company", "topic", [1, 2, 3],
                           names=["topic_1", "topic_2", "topic_3"], digits=2)


#: Seed terms of the names of the ruled topics.
TOPIC_SEEDS = {"complaint": LEX.negative, "praise": LEX.positive, "leaving": LEX.churn_critical_model}


def q_topic_names_seeded(spark, sf):
    """Names of the ruled topics by their seed terms: the best assignment and its margin (M6)."""
    words = _ruled_topics(spark, sf).select("topic", F.explode(TX.word_tokens("cleaned")).alias("term"))
    n = words.groupBy("topic", "term").agg(F.count(F.lit(1)).alias("n"))
    size = n.groupBy("topic").agg(F.sum("n").alias("size"))
    terms = n.join(size, "topic").select("topic", "term", (F.col("n") / F.col("size")).alias("weight"))
    named = TP.assign_names(TP.seed_scores(terms, TOPIC_SEEDS), [1, 2, 3], list(TOPIC_SEEDS))
    return named.select("topic", "name", F.round("margin", R6).alias("margin"))


def q_churn_features_topic(spark, sf):
    """Churn features with the topic flags."""
    f = CH.churn_features(_ruled_topics(spark, sf), LEX, topic="topic")
    return f.select("doc_id", "topic", "is_billing", "is_infra", "churn_label")


def q_report_readback(spark, sf):
    """Report sections written as CSV and Parquet, then read back."""
    from ..operators.sinks import write_report
    from ..session import scratch_path
    volume = RP.company_volume(store(spark, sf, carry=["company"]))
    a = write_report({"volume": volume}, scratch_path(spark, "report"), "csv")
    b = write_report({"volume": volume}, scratch_path(spark, "report"), "parquet")
    csv = spark.read.option("header", True).schema("company string, n long").csv(a["volume"])
    return csv.join(spark.read.parquet(b["volume"]).withColumnRenamed("n", "n_parquet"), "company")


#: Frequent words of the test texts → words of the original lists.
TO_TURKISH = (("the", "fatura"), ("and", "iptal"), ("of", "harika"), ("to", "istiyorum"), ("for", "zam"), ("la", "ve"),
              ("der", "te\u015fekk\u00fcr"), ("is", "g\u00fczel"), ("in", "bir"))


def q_turkish_clean_sentiment(spark, sf):
    """The original lists on texts whose frequent words were exchanged for listed ones (M1, M2)."""
    d = CP.documents_as_complaints(spark, sf)
    c = F.col("content")
    for word, tr in TO_TURKISH:
        c = F.replace(c, F.lit(f" {word} "), F.lit(f" {tr} "))
    e = CP.enrich(d.withColumn("content", c), L.REFERENCE)
    return e.select("doc_id", "cleaned", "sentiment")


# --- sinks and streaming -----------------------------------------------------

def _records_json(spark, sf, copies: int = 1, days: int = 1) -> str:
    """documents → crawl records as JSON lines in a fresh shared folder
    (``copies`` > 1 writes the same records again as a replay).  Crawl times
    lie within 50 minutes whatever the number of records, less than the
    watermark delay of one hour, so no first delivery is ever late.  ``days`` > 1
    spreads them over that many days, and of each replay every second record
    was crawled again a day later."""
    from ..session import scratch_path
    d = CP.documents_as_complaints(spark, sf)
    rec = d.select("company", "date", "link", "content",
                   (F.lit(1.7e9) + F.pmod("doc_id", F.lit(3_000_000)) / 1000.0).alias("crawl_timestamp"))
    path = scratch_path(spark, "records-json")
    rec = rec.persist(StorageLevel.MEMORY_AND_DISK) if copies > 1 else rec  # the table is read and dealt out once
    for i in range(copies):
        if days > 1:
            day = F.pmod(F.xxhash64("link"), F.lit(2 * days))
            late = F.floor(day / 2) + F.when(day % 2 == 1, F.lit(i)).otherwise(0)
            rec.withColumn("crawl_timestamp", F.col("crawl_timestamp") + late * 86400.0).write.mode("append").json(f"{path}/round={i}")
        else:
            rec.write.mode("append").json(f"{path}/round={i}")
    rec.unpersist()
    return path


def _run_stream(spark, src: str, key: str = "link", files_per_trigger: int | None = None) -> str:
    from ..session import scratch_path
    from ..streaming import pipeline as PL
    target, ckpt, quar = (scratch_path(spark, n) for n in ("stream-store", "stream-ckpt", "stream-quarantine"))
    raw = PL.read_json_files(spark, f"{src}/*", files_per_trigger)
    q = PL.start_pipeline(PL.records(raw), target, ckpt, key=key, quarantine=quar,
                          trigger={"availableNow": True}, lexicon=LEX)
    q.awaitTermination()
    return target


def q_stream_clean_sentiment(spark, sf):
    """documents as JSON records → streaming clean + sentiment → idempotent store."""
    from ..operators.sinks import read_store
    target = _run_stream(spark, _records_json(spark, sf))
    return read_store(spark, target).select("link", "company", "cleaned", "sentiment")


def q_stream_idempotent_sink(spark, sf):
    """The same records over three crawl days delivered twice, half of them crawled again a day later, a few files per
    micro-batch: a link is stored once in the whole store, whatever day it was crawled on."""
    from ..operators.sinks import read_store
    target = _run_stream(spark, _records_json(spark, sf, copies=2, days=3), files_per_trigger=4)
    return read_store(spark, target).select("link", "company", "sentiment")


def _stream_rounds(spark, df, round_col: str, rounds: int, stream_of, per_trigger: int) -> DataFrame:
    """``df`` written round by round (files in that order of time), read as a stream of several micro-batches through a
    stateful operator; the rows it emitted."""
    from ..session import scratch_path
    src, out, ckpt = (scratch_path(spark, n) for n in ("rounds", "rounds-out", "rounds-ckpt"))
    for k in range(rounds):
        df.filter(F.col(round_col) == k).drop(round_col).write.mode("append").parquet(src)
    rows = spark.readStream.schema(df.drop(round_col).schema).option("maxFilesPerTrigger", per_trigger).parquet(src)
    found = stream_of(rows)

    def put(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (found.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{out}/*")


def q_stream_seen_links(spark, sf):
    """The seen set as keyed stream state: admitted links in three crawl rounds, the crawled pages as history; each new
    link is emitted once (U2, J1, T6)."""
    from ..streaming import state as ST
    found = LK.admit_links(_page_links(spark, sf), TEST_DOMAIN).select(
        "link", F.col("page_id").cast("double").alias("crawl_timestamp"), F.pmod("page_id", F.lit(3)).alias("round"))
    seen = _pages(spark, sf).select(F.col("url").alias("link"), F.lit(0.0).alias("crawl_timestamp"))
    got = _stream_rounds(spark, found, "round", 3, lambda s: ST.first_sightings(s, seen=seen), 4)
    return got.select("link")


def q_stream_low_yield_stop(spark, sf):
    """The low-yield stop as keyed stream state over the crawl log in four ranges of pages: each site's stop once."""
    from ..streaming import state as ST
    log = materialize(_crawl_log(spark, sf), "crawl-log")  # read for the last page and in every round
    top = log.agg(F.max("page_no")).scalar() + 1
    # the rows of a site in one range of pages are in one file, so its pages arrive in order
    log = log.withColumn("round", F.floor(F.col("page_no") * 4 / top)).repartition("site")
    got = _stream_rounds(spark, log, "round", 4, lambda s: ST.stop_pages(s, "site", "page_no", "n_new"), 6)
    return got.select("site", "n_pages", "stop_page")


def q_skip_duplicate_insert(spark, sf):
    """Batch insert into a store with a unique cleaned-text key, run twice: one row per text,
    the smallest doc_id kept."""
    from ..operators.sinks import read_store, upsert_new
    from ..session import scratch_path
    target = scratch_path(spark, "skipdup-store")
    batch = enriched(spark, sf).select("doc_id", "company", "link", "cleaned", "sentiment")
    for _ in range(2):
        upsert_new(batch, target, "cleaned", order_col="doc_id", hashed_key=True)
    return read_store(spark, target).select("doc_id", "company", "cleaned")


def _refreshed(spark, sf) -> dict[str, DataFrame]:
    """documents as records of three crawl days, written to a store day by day; the incremental report runs after each day
    and reads that day only.  Crawl times follow doc_id, so the first copy of a text is that with the smallest id."""
    from ..operators.sinks import day_part
    from ..session import scratch_path
    from . import refresh as RF
    store_path, state = scratch_path(spark, "refresh-store"), scratch_path(spark, "refresh-state")
    e = enriched(spark, sf).select("doc_id", "company", "date", "link", "cleaned", "sentiment")
    top = (spark.read.parquet(f"{sf}/documents.parquet").agg(F.max("doc_id")).first()[0] or 0) + 1
    day = F.floor(F.col("doc_id") * 3 / F.lit(top))
    at = F.timestamp_micros(F.lit(1_704_067_200_000_000) + day * 86_400_000_000 + F.col("doc_id"))
    for k in range(3):
        (e.filter(day == k).withColumn("crawled_at", at).drop("doc_id").withColumn("part", day_part("crawled_at"))
         .write.mode("append").partitionBy("part").parquet(store_path))
        RF.update(spark, store_path, state, LEX)
    return RF.tables(spark, state, LEX)


def q_refresh_tfidf(spark, sf):
    """TF-IDF top terms of the incremental report: equal to the full run."""
    return _refreshed(spark, sf)["tfidf_top5"].select("company", "term", "rank", F.round("tfidf", R6).alias("tfidf"))


def q_refresh_volume_risk(spark, sf):
    """Volumes and risk groups of the incremental report: equal to the full run."""
    t = _refreshed(spark, sf)
    return t["company_volume"].join(t["risk_heatmap"], "company")


# --- more sources ------------------------------------------------------------

def q_csv_roundtrip(spark, sf):
    """documents as records → CSV with header → read back with the declared schema."""
    from ..session import scratch_path
    path = scratch_path(spark, "records-csv")
    CP.write_csv(CP.documents_as_complaints(spark, sf), path)
    return CP.read_csv(spark, path)


def q_csv_roundtrip_escapes(spark, sf):
    """The same with line breaks, backslashes, quotes and NULs in the texts."""
    from ..session import scratch_path
    path = scratch_path(spark, "records-csv")
    c = F.col("content")
    for word, put in AWKWARD:
        c = F.replace(c, F.lit(word), F.lit(put))
    CP.write_csv(CP.documents_as_complaints(spark, sf).withColumn("content", c), path)
    return CP.read_csv(spark, path)


#: Frequent pieces of the test texts → characters that a line of CSV cannot hold as they are.
AWKWARD = ((" the ", "a\x00b"), (" of ", "\\n\n"), (" in ", "\r\\"), (" and ", '\",\"\\0'))


def q_stream_progress(spark, sf):
    """The progress table of a stream in several micro-batches: batches counted once, rows in as the source has."""
    from ..session import scratch_path
    from ..streaming import pipeline as PL
    path = scratch_path(spark, "progress")
    log = PL.log_progress(spark, path)
    try:
        _run_stream(spark, _records_json(spark, sf, copies=2), files_per_trigger=6)
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(log)
    p = PL.read_progress(spark, path)
    return p.agg(F.sum("rows_in").alias("rows_in"), (F.count(F.lit(1)) == F.count_distinct("batch_id")).alias("once"))


def q_history_roundtrip(spark, sf):
    """documents as crawl records → JSONL history appended twice → read back (S8, S9),
    then the seen-link set (U2) as the crawler rebuilds it on start."""
    from ..session import scratch_path
    path = scratch_path(spark, "history-jsonl")
    rec = CP.documents_as_complaints(spark, sf).select(
        "company", "date", "link", "content", F.col("doc_id").cast("double").alias("crawl_timestamp"))
    CP.append_history(rec, path)
    CP.append_history(rec, path)
    h = CP.read_history(spark, path)
    return h.groupBy("link").agg(F.count(F.lit(1)).alias("n_copies"), F.min("company").alias("company"))


def q_store_scan(spark, sf):
    """The store written as Parquet and scanned back with the declared columns."""
    from ..session import scratch_path
    path = scratch_path(spark, "store-parquet")
    store(spark, sf).withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    return CP.load_complaints(spark, path).select("link", "company", "cleaned", "sentiment")


def q_conversation_sentiment(spark, sf):
    """The second, short-text corpus: conversation turns, company := role."""
    e = CP.enrich(CP.conversations_as_complaints(spark, sf), LEX)
    return e.groupBy("company", "sentiment").agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_text": q_clean_text,
    "clean_text_reference_lexicon": q_clean_text_reference_lexicon,
    "dedup_texts": q_dedup_texts,
    "row_counts": q_row_counts,
    "sentiment_rows": q_sentiment_rows,
    "sentiment_by_company": q_sentiment_by_company,
    "sentiment_reference_lexicon": q_sentiment_reference_lexicon,
    "lexicon_hits": q_lexicon_hits,
    "sentiment_weight_lookup": q_sentiment_weight_lookup,
    "rule_risk_rows": q_rule_risk_rows,
    "risk_share": q_risk_share,
    "risk_heatmap": q_risk_heatmap,
    "company_volume": q_company_volume,
    "high_risk_rows": q_high_risk_rows,
    "rule_risk_summary": q_rule_risk_summary,
    "alarm_count": q_alarm_count,
    "churn_features": q_churn_features,
    "churn_label_rate": q_churn_label_rate,
    "split_buckets": q_split_buckets,
    "split_exact": q_split_exact,
    "confusion_metrics": q_confusion_metrics,
    "term_df_min5": q_term_df_min5,
    "vocab_top1000": q_vocab_top1000,
    "tfidf_top5": q_tfidf_top5,
    "bigram_top15": q_bigram_top15,
    "bigram_top15_sketched": q_bigram_top15_sketched,
    "phrase_hits_automaton": q_phrase_hits_automaton,
    "phrase_hits_joined": q_phrase_hits_joined,
    "word_edges": q_word_edges,
    "word_nodes": q_word_nodes,
    "cloud_words": q_cloud_words,
    "cloud_words_folded": q_cloud_words_folded,
    "cloud_words_collocations": q_cloud_words_collocations,
    "formatted_volume": q_formatted_volume,
    "page_main_text": q_page_main_text,
    "page_paragraphs": q_page_paragraphs,
    "page_text_marked": q_page_text_marked,
    "page_links": q_page_links,
    "page_links_dotted": q_page_links_dotted,
    "link_admission": q_link_admission,
    "new_links_antijoin": q_new_links_antijoin,
    "crawl_round_summary": q_crawl_round_summary,
    "crawl_low_yield_stop": q_crawl_low_yield_stop,
    "seen_set_union": q_seen_set_union,
    "page_records": q_page_records,
    "month_standardise": q_month_standardise,
    "json_roundtrip": q_json_roundtrip,
    "json_event_props": q_json_event_props,
    "lda_topic_share": q_lda_topic_share,
    "lda_company_crosstab": q_lda_company_crosstab,
    "topic_terms": q_topic_terms,
    "lda_minibatch_perplexity": q_lda_minibatch_perplexity,
    "lda_minibatch_topics": q_lda_minibatch_topics,
    "rf_risk_summary": q_rf_risk_summary,
    "rf_metrics": q_rf_metrics,
    "rf_quality_metrics": q_rf_quality_metrics,
    "topic_argmax": q_topic_argmax,
    "topic_names_seeded": q_topic_names_seeded,
    "topic_share": q_topic_share,
    "topic_company_crosstab": q_topic_company_crosstab,
    "churn_features_topic": q_churn_features_topic,
    "report_readback": q_report_readback,
    "turkish_clean_sentiment": q_turkish_clean_sentiment,
    "stream_clean_sentiment": q_stream_clean_sentiment,
    "stream_idempotent_sink": q_stream_idempotent_sink,
    "stream_watermark_dedup": q_stream_watermark_dedup,
    "stream_seen_links": q_stream_seen_links,
    "stream_low_yield_stop": q_stream_low_yield_stop,
    "skip_duplicate_insert": q_skip_duplicate_insert,
    "refresh_tfidf": q_refresh_tfidf,
    "refresh_volume_risk": q_refresh_volume_risk,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_roundtrip_escapes": q_csv_roundtrip_escapes,
    "stream_progress": q_stream_progress,
    "history_roundtrip": q_history_roundtrip,
    "store_scan": q_store_scan,
    "conversation_sentiment": q_conversation_sentiment,
}
