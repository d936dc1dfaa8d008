"""Terms (A10, A11, K1, M3, M15-M17), pages (X1-X6), links (P7, J1, U2, X7, T9), dates and JSON."""

import math

import pytest
from pyspark.sql import functions as F

from gripe.functions import dates as DT
from gripe.functions import jsonio as JS
from gripe.operators import dedup as DD
from gripe.operators import links as LK
from gripe.operators import terms as TM
from gripe.sources import complaints as CP
from gripe.sources import pages as PG


def test_term_stats_tf_df(spark):
    df = spark.createDataFrame([("aa bb aa",), ("bb cc",), ("x aa",)], "cleaned string")
    st = {r.term: (r.tf, r.df) for r in TM.term_stats(df, TM.analysis_tokens("cleaned", [])).collect()}
    assert st == {"aa": (3, 2), "bb": (2, 2), "cc": (1, 1)}


def test_vocabulary_ties_by_term(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "term string, tf long")
    assert [r.term for r in TM.vocabulary(df, 3).collect()] == ["c", "a", "b"]


def test_tfidf_matches_formula(spark):
    docs = [("A", "aa bb bb"), ("A", "cc"), ("B", "aa dd"), ("C", "dd dd ee")]
    df = spark.createDataFrame(docs, "company string, cleaned string")
    got = {(r.company, r.term): r.tfidf for r in TM.tfidf_by_company(df, "cleaned", [], size=30, top=None).collect()}
    # brute force: company documents, smoothed idf, L2 norm
    tf = {"A": {"aa": 1, "bb": 2, "cc": 1}, "B": {"aa": 1, "dd": 1}, "C": {"dd": 2, "ee": 1}}
    n = 3
    dfreq = {}
    for c in tf:
        for t in tf[c]:
            dfreq[t] = dfreq.get(t, 0) + 1
    for c, terms in tf.items():
        w = {t: v * (math.log((1 + n) / (1 + dfreq[t])) + 1) for t, v in terms.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t, x in w.items():
            assert abs(got[(c, t)] - x / norm) < 1e-12


def test_bigrams_and_undirected_graph(spark):
    # one-letter words vanish before pairs are formed: "aa x bb" gives "aa bb"
    df = spark.createDataFrame([("aa bb aa bb",), ("bb aa",), ("cc cc",), ("dd x ee",)], "cleaned string")
    big = {r.bigram: r.n for r in TM.top_bigrams(df, "cleaned", 15).collect()}
    assert big == {"aa bb": 2, "bb aa": 2, "cc cc": 1, "dd ee": 1}
    edges = {(r.src, r.dst): (r.weight, r.width) for r in TM.word_edges(TM.top_bigrams(df, "cleaned", 15)).collect()}
    assert edges == {("aa", "bb"): (2, 4.0), ("cc", "cc"): (1, 2.0), ("dd", "ee"): (1, 2.0)}
    nodes = {r.word: r.degree for r in TM.word_nodes(TM.word_edges(TM.top_bigrams(df, "cleaned", 15))).collect()}
    assert nodes == {"aa": 1, "bb": 1, "cc": 2, "dd": 1, "ee": 1}


def test_reversed_pair_keeps_smaller_count(spark):
    e = TM.word_edges(spark.createDataFrame([("xx yy", 5), ("yy xx", 3)], "bigram string, n long")).first()
    assert (e.src, e.dst, e.weight) == ("xx", "yy", 3)


def test_cloud_words_fallback_and_top(spark):
    df = spark.createDataFrame([("A", "kedi kedi köpek ve"), ("A", "kedi"), ("B", "ve ab")],
                               "company string, cleaned string")
    got = {(r.company, r.word): (r.n, r.rank, r.rel) for r in TM.cloud_words(df, "cleaned", ["ve"], 60).collect()}
    assert got[("A", "kedi")] == (3, 1, 1.0)
    assert got[("A", "köpek")] == (1, 2, 1 / 3)
    assert ("A", "ve") not in got
    # B keeps nothing (ve is a stop word, ab too short): all its words are used
    assert got[("B", "ab")][0] == 1 and got[("B", "ve")][0] == 1


def test_dedup_keeps_smallest_id_and_drops_null(spark):
    df = spark.createDataFrame([(3, "x", "A"), (1, "x", "B"), (2, None, "C"), (4, "", "D"), (5, "", "E")],
                               "doc_id long, cleaned string, company string")
    got = sorted((r.doc_id, r.company) for r in DD.dedup_text(df).collect())
    assert got == [(1, "B"), (4, "D")]
    c = DD.row_counts(df).first()
    assert (c.n_rows, c.n_distinct) == (5, 2)


LONG = "Faturam iki kez kesildi ve iptal talebim hala yanitsiz kaldi"  # > 40 characters
NOW = "2024-05-05 10:30:00"


def _page(body, date='<span class="t" data-base-ui-click-trigger aria-label="5  May 10:30">x</span>'):
    return (f'<html><body><nav><a href="/a">a</a></nav><article><header>{date}<h1>A title that is longer than forty characters</h1>'
            f'</header>{body}</article></body></html>')


def _extract(spark, html, sel=None):
    sel = sel or PG.COMPANY_PAGES
    df = spark.createDataFrame([(1, "https://www.site.com/x", html)], "page_id long, url string, html string")
    return PG.read_pages(df, sel).select(PG.main_text(sel).alias("text"), PG.paragraphs().alias("paras"),
                                         PG.page_date(F.lit(NOW).cast("timestamp")).alias("date")).first()


def test_page_candidates_in_order(spark):
    share = f'<div class="b selection-share"><p class="x wrap-anywhere y">{LONG}</p><p>unmarked</p></div>'
    r = _extract(spark, _page(share + f'<div class="reply"><p class="wrap-anywhere">Reply {LONG}</p></div>'))
    assert r.text == LONG + "unmarked" and r.paras == LONG
    # no marked block: the third div of the article; a short one is passed over for the marked paragraph's parent
    r = _extract(spark, _page(f"<div>1</div><div>2</div><div>third {LONG}</div>"))
    assert r.text == "third " + LONG
    r = _extract(spark, _page(f'<div>1</div><div>2</div><div>short</div><div><p class="wrap-anywhere">{LONG}</p> end</div>'))
    assert r.text == LONG + " end"
    # category pages have no third-div candidate
    assert _extract(spark, _page(f"<div>1</div><div>2</div><div>third {LONG}</div>"), PG.CATEGORY_PAGES).text is None
    # nothing marked at all
    assert _extract(spark, _page(f"<div><p>{LONG}</p></div>")).text is None


def test_page_corporate_reply_keeps_marked_paragraphs(spark):
    body = (f'<div class="selection-share">De&#287;erli M&uuml;&#351;terimiz, <p class=wrap-anywhere>{LONG}</p>'
            f'<pre>not a paragraph</pre><p>unmarked</p><p class=\'wrap-anywhere\'> second&nbsp;one </p></div>')
    assert _extract(spark, _page(body)).text == LONG + " second one"


def test_page_text_gates(spark):
    def got(n):
        return _extract(spark, _page(f'<div class="selection-share"><p class="wrap-anywhere">{"x" * n}</p></div>')).text

    assert [got(n) for n in (34, 35, 40)] == [None, None, None] and got(41) == "x" * 41
    body = f'<div class="selection-share"><p class="wrap-anywhere">{LONG}... \n Devam\u0131n\u0131 oku</p></div>'
    assert _extract(spark, _page(body)).text == LONG


def test_page_dates(spark):
    block = f'<div class="selection-share"><p class="wrap-anywhere">{LONG}</p></div>'
    assert _extract(spark, _page(block)).date == "5 May\u0131s 10:30"  # label first, month mapped, white space squeezed
    text_only = "<span data-base-ui-click-trigger>\n 7 June 09:00 </span>"
    assert _extract(spark, _page(block, text_only)).date == "7 Haziran 09:00"
    assert _extract(spark, _page(block, "<span data-base-ui-click-trigger>yesterday</span>")).date == "05 May\u0131s 10:30"
    assert _extract(spark, _page(block, "")).date == "05 May\u0131s 10:30"
    outside = _page(block, "") .replace("</body>", text_only + "</body>")
    assert _extract(spark, outside).date == "7 Haziran 09:00"
    assert _extract(spark, outside, PG.CATEGORY_PAGES).date == "05 May\u0131s 10:30"
    toned = _page(block, "<span data-base-ui-click-trigger aria-label='1 May 1:00'></span>").replace(
        "</article>", "<span class='text-zinc-500 s' data-base-ui-click-trigger aria-label='2 May 2:00'></span></article>")
    assert _extract(spark, toned, PG.CATEGORY_PAGES).date == "2 May\u0131s 2:00"
    label = _page(block, "").replace("</body>", "<span id='base-ui-3' aria-label='3 May 3:00'></span></body>")
    assert _extract(spark, label, PG.CATEGORY_PAGES).date == "3 May\u0131s 3:00"


def test_extract_records(spark):
    good = _page(f'<div class="selection-share"><p class="wrap-anywhere">{LONG}</p></div>')
    df = spark.createDataFrame([(1, "https://www.sikayetvar.com/vodafone/x", good), (2, "https://a.b/c", "<p>no</p>"), (3, None, None)],
                               "page_id long, url string, html string")
    (r,) = PG.extract_records(df, now=F.lit(NOW).cast("timestamp")).collect()
    assert (r.company, r.date, r.link, r.content) == ("VODAFONE", "5 May\u0131s 10:30", "https://www.sikayetvar.com/vodafone/x", LONG)
    assert r.crawl_timestamp == 1714905000.0


def test_pick_candidate_rules(spark):
    df = spark.createDataFrame([(" " + "a" * 41 + " ", "para"), ("a" * 38, "p"), ("a" * 30, "p"),
                                ("Değerli Müşterimiz " + "b" * 30, "c" * 36)], "b string, p string")
    got = [r.x for r in df.select(PG.pick_candidate([(F.col("b"), F.col("p"))]).alias("x")).collect()]
    assert got == ["a" * 41, None, None, "c" * 36]


LISTING = ('<body><nav><a href="/menu">m</a></nav><article><a data-href="no" href="/a?x=1&amp;y=2">1</a><a href="/second">2</a></article>'
           "<article><h2>t</h2><div><a class=x href='https://other.org/x-video '>v</a></div></article><article>no link</article>"
           '<article><a>no href</a><a href="/late">l</a></article><article><a href=rel/b>b</a></article>'
           '<article><a href="//cdn.site.com/c">c</a></article></body>')


def test_page_links_first_anchor_of_each_card(spark):
    df = spark.createDataFrame([(1, "https://www.site.com/a/b?page=2", LISTING)], "page_id long, url string, html string")
    links = PG.page_links(df).orderBy("pos").collect()
    assert [r.link for r in links] == ["https://www.site.com/a?x=1&y=2", "https://other.org/x-video ",
                                       "https://www.site.com/a/rel/b", "https://cdn.site.com/c"]
    adm = [r.link for r in LK.admit_links(PG.page_links(df), "site.com").orderBy("pos").collect()]
    assert adm == ["https://www.site.com/a?x=1&y=2", "https://www.site.com/a/rel/b", "https://cdn.site.com/c"]


def test_round_summary_counts_repeats_on_every_page(spark):
    links = spark.createDataFrame([(1, "a", True), (1, "a", True), (1, "b", False), (2, "a", True), (2, "c", True), (3, "s", True)],
                                  "page_id long, link string, admitted boolean")
    seen = spark.createDataFrame([("s",), ("s",), (None,)], "link string")
    got = {r.page_id: (r.n_links, r.n_admitted, r.n_new) for r in LK.round_summary(links, seen).collect()}
    assert got == {1: (3, 2, 2), 2: (2, 2, 2), 3: (1, 1, 0)}


def test_new_links_and_seen_set(spark):
    found = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "link string")
    seen = spark.createDataFrame([("a",), (None,)], "link string")
    assert sorted(r.link for r in LK.new_links(found, seen).collect() if r.link) == ["b"]
    assert sorted(r.link for r in LK.add_seen(seen, found).collect() if r.link) == ["a", "b"]


def test_low_yield_stop(spark):
    log = [("s1", p, 1 if p <= 5 else 0) for p in range(1, 31)]  # stops at 15 (pages 6..15 empty)
    log += [("s2", p, 0) for p in range(1, 12)]  # page 11: pages 2..11 empty → stop 11
    log += [("s3", p, 1 if p % 3 == 0 else 0) for p in range(1, 40)]  # never 10 empty in a row
    df = spark.createDataFrame(log, "site string, page_no int, n_new int")
    got = {r.site: (r.n_pages, r.stop_page) for r in LK.low_yield_stop(df).collect()}
    assert got == {"s1": (30, 15), "s2": (11, 11), "s3": (39, None)}


def test_low_yield_stop_counts_crawled_pages_only(spark):
    log = [("gap", p, 0) for p in (1, 2, 11, 12)]  # four crawled pages are no run of ten
    log += [("gap2", p, 1 if p == 1 else 0) for p in (1, *range(3, 40, 3))]  # the tenth empty page is 30
    df = spark.createDataFrame(log, "site string, page_no int, n_new int")
    got = {r.site: (r.n_pages, r.stop_page) for r in LK.low_yield_stop(df).collect()}
    assert got == {"gap": (4, None), "gap2": (14, 30)}


def test_csv_round_trip_with_awkward_texts(spark):
    import tempfile

    texts = ["two\nlines", "quote \" and, comma", "back\\slash \\n \\", "\r\n", "", None, "  blanks  ", "\\N", "tab\t;"]
    df = spark.createDataFrame([("C", None, str(i), t) for i, t in enumerate(texts)],
                               "company string, date string, link string, content string")
    path = tempfile.mkdtemp(prefix="gripe-csv-") + "/c"
    CP.write_csv(df, path)
    got = {r.link: (r.company, r.date, r.content) for r in CP.read_csv(spark, path).collect()}
    assert got == {str(i): ("C", None, t) for i, t in enumerate(texts)}
    other = tempfile.mkdtemp(prefix="gripe-csv-") + "/o.csv"
    with open(other, "w") as f:
        f.write('company,date,link,content\nC,d,l1,"one\ntwo, ""three"""\nD,d,l2,plain\n')
    assert [(r.link, r.content) for r in CP.read_csv(spark, other, escaped=False).collect()] == [
        ("l1", 'one\ntwo, "three"'), ("l2", "plain")]


def test_publish_keeps_a_copy_when_the_broker_is_down(spark):
    import tempfile

    from gripe.sources import kafka as KF

    def down(values):
        raise RuntimeError("no broker")

    rec = spark.createDataFrame([("C", "d", "l", "x", 1.0)], "company string, date string, link string, content string, crawl_timestamp double")
    path = tempfile.mkdtemp(prefix="gripe-hist-") + "/h"
    assert KF.publish(rec, "b:1", "t", history=path, send=down) is False
    assert [r.link for r in CP.read_history(spark, path).collect()] == ["l"]
    with pytest.raises(RuntimeError):
        KF.publish(rec, "b:1", "t", send=down)
    sent = []
    assert KF.publish(rec, "b:1", "t", send=lambda v: sent.extend(v.collect())) and '"link":"l"' in sent[0].value


def test_month_standardise(spark):
    df = spark.createDataFrame([("5 May 10:00",), ("5 Mayıs 10:00",), ("1 January 09:00",), ("Mayday",)], "d string")
    assert [r.x for r in df.select(DT.month_to_tr("d").alias("x")).collect()] == [
        "5 Mayıs 10:00", "5 Mayıs 10:00", "1 Ocak 09:00", "Mayday"]


def test_date_or_now(spark):
    df = spark.createDataFrame([("Tarih Yok",), ("dün",), ("3 Mart 11:00",), (None,)], "d string")
    now = F.lit("2024-02-07 08:05:00").cast("timestamp")
    got = [r.x for r in df.select(DT.date_or_now("d", now).alias("x")).collect()]
    assert got == ["07 February 08:05", "07 February 08:05", "3 Mart 11:00", "07 February 08:05"]


def test_json_decode_rules(spark):
    vals = ['{"company":"A","date":"d","content":"c","link":"l","extra":1}',
            '{"company":5,"content":{"a":1}}', '{bad json', None, "[1,2]",
            '{"company":"B","crawl_timestamp":"x"}']
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    out = JS.decode_frame(df, keep_raw=True).collect()
    assert (out[0].company, out[0].link) == ("A", "l")
    assert out[1].company == "5" and out[1].content == '{"a":1}'
    assert all(out[i].company is None for i in (2, 3, 4))
    assert out[2].raw_value == "{bad json"


def _py_cloud_collocations(docs, stop, threshold=30.0, min_len=3):
    """Brute force of the collocation rule on one company's documents."""
    def ll(k, m, x):
        return math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (m - k)

    kept = [[w for w in d.split() if len(w) >= min_len and w not in stop] for d in docs]
    uni, big = {}, {}
    for ws in kept:
        for w in ws:
            uni[w] = uni.get(w, 0) + 1
        for a, b in zip(ws, ws[1:]):
            big[(a, b)] = big.get((a, b), 0) + 1
    n = sum(uni.values())
    out = dict(uni)
    for (a, b), c12 in big.items():
        c1, c2 = uni[a], uni[b]
        if n <= c1 or n <= c2:
            s = 0.0
        else:
            p, p1, p2 = c2 / n, c12 / c1, (c2 - c12) / (n - c1)
            s = -2 * (ll(c12, c1, p) + ll(c2 - c12, n - c1, p) - ll(c12, c1, p1) - ll(c2 - c12, n - c1, p2))
        if s > threshold:
            out[a] -= c12
            out[b] -= c12
            out[f"{a} {b}"] = c12
    return {w: c for w, c in out.items() if c > 0}


def test_cloud_collocations_match_brute_force(spark):
    docs = (["fatura iptal edildi sonra tekrar geldi"] * 12 + ["kart sorunu devam ediyor fatura"] * 5
            + [f"kelime{i} fatura iptal" for i in range(6)] + ["iptal fatura"] * 2)
    df = spark.createDataFrame([("A", d) for d in docs], "company string, cleaned string")
    got = {r.word: r.n for r in TM.cloud_words(df, "cleaned", ["sonra"], 200, collocations=True).collect()}
    want = _py_cloud_collocations(docs, {"sonra"})
    assert got == want
    assert any(" " in w for w in got)  # at least one pair was merged


def test_tag_company_and_category(spark):
    from gripe import lexicons as L

    urls = ["https://www.sikayetvar.com/vodafone/fatura-iptal-123", "https://www.sikayetvar.com/turk-telekom/x",
            "https://www.sikayetvar.com/turkcell/tarife-degisikligi/abc", "https://other.org/turkcell"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = df.select(PG.tag_company("url").alias("c"), PG.tag_company("url", L.CATEGORY_TARGETS).alias("c2"),
                    PG.tag_category("url").alias("k")).collect()
    assert [r.c for r in got] == ["VODAFONE", "TURKTELEKOM", "TURKCELL", None]
    assert [r.k for r in got] == [None, None, "tarife-degisikligi", None]
    assert [r.c2 for r in got] == [None, None, "TURKCELL", None]


def test_collocations_move_no_words_and_lose_no_pair(spark, monkeypatch):
    """Pairs are stored as numbers, and however few words are broadcast, the cloud is that of a plain count."""
    import math
    import random

    from gripe.operators import terms as TM

    rng = random.Random(3)
    words = [f"w{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(80)]
    texts = [("a", " ".join(rng.choices(words, [1 / (i + 1) for i in range(80)], k=rng.randint(0, 40)))) for _ in range(120)]
    texts += [("b", "new york is big new york"), ("b", None), (None, "new york"), ("c", "ab cd"), ("a", "rare pair " * 9), ("a", "odd couple")]
    df = spark.createDataFrame(texts, "company string, cleaned string")

    def plain(company):
        docs = [[w for w in (t or "").split() if len(w) >= 3 and w != "is"] for c, t in texts if c == company]
        n, pairs = {}, {}
        for d in docs:
            for w in d:
                n[w] = n.get(w, 0) + 1
            for p in zip(d, d[1:]):
                pairs[p] = pairs.get(p, 0) + 1
        total, out = sum(n.values()), dict(n)

        def ll(k, m, x):
            return math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (m - k)

        for (a, b), k in pairs.items():
            c1, c2 = n[a], n[b]
            if total <= c1 or total <= c2:
                continue
            p, p1, p2 = c2 / total, k / c1, (c2 - k) / (total - c1)
            if -2 * (ll(k, c1, p) + ll(c2 - k, total - c1, p) - ll(k, c1, p1) - ll(c2 - k, total - c1, p2)) > 5:
                out[f"{a} {b}"] = k
                out[a], out[b] = out[a] - k, out[b] - k
        return {w: k for w, k in out.items() if k > 0}

    kinds = {}
    real, smallest = TM.materialize, TM._common_from
    monkeypatch.setattr(TM, "materialize", lambda d, name, *a: kinds.update({name: dict(d.dtypes)}) or real(d, name, *a))
    for least in (None, 0, 3, 5, 30):
        if least is not None:
            monkeypatch.setattr(TM, "_common_from", lambda sizes, rows: least)
        got = TM.cloud_words(df, "cleaned", ["is"], 1000, collocations=True, threshold=5.0).collect()
        for company in "ab":
            assert {r.word: r.n for r in got if r.company == company} == plain(company), (least, company)
        assert {r.word: r.n for r in got if r.company == "c"} == {"ab": 1, "cd": 1}
    assert any(" " in r.word for r in got) and set(kinds["cloud-pairs"].values()) == {"bigint"}
    assert "cloud-texts" in kinds  # the texts are made once for both counts
    assert [smallest({0: 5, 1: 3, 4: 2}, k) for k in (0, 2, 4, 5, 9, 10)] == [5, 4, 4, 1, 1, 0] and smallest({}, 5) == 1


def test_bigrams_are_rows_before_they_are_joined(spark):
    """Pairs are made in generated code, not by a lambda over an array; short, empty and null texts have none."""
    from gripe.operators import terms as TM

    df = spark.createDataFrame([("d", "aa bb aa bb"), ("d", "aa"), ("d", ""), ("d", None), ("e", "x aa  bb"), (None, "bb aa")], "day string, cleaned string")
    counted = TM.bigram_counts(df, "cleaned", "day")
    assert "lambda" not in counted._jdf.queryExecution().executedPlan().toString()
    assert {(r.day, r.bigram): r.n for r in counted.collect()} == {
        ("d", "aa bb"): 2, ("d", "bb aa"): 1, ("e", "aa bb"): 1, (None, "bb aa"): 1}


def test_refresh_of_one_day_moves_its_counts_once(spark, tmp_path):
    """The counts of a single day are written where they were added up; several days are brought together first."""
    from gripe import lexicons as L
    from gripe.plans import refresh as RF

    def store(*days):
        rows = [(f"l{d}{i}", "a", None, f"aa bb {d} cc{i}", "NOTR", d) for d in days for i in range(3)]
        df = spark.createDataFrame(rows, "link string, company string, date string, cleaned string, sentiment string, part string")
        (df.selectExpr("*", "cast(part || ' 10:00:00' as timestamp) as crawled_at")
         .write.mode("append").partitionBy("part").parquet(f"{tmp_path}/store"))

    hints = []
    kind = type(spark.range(1))
    old = kind.hint
    kind.hint = lambda self, name, *a: hints.append(name) or old(self, name, *a)
    try:
        store("2024-01-01")
        assert RF.update(spark, f"{tmp_path}/store", f"{tmp_path}/state", L.FIXTURE) == ["2024-01-01"] and not hints
        store("2024-01-02", "2024-01-03")
        assert len(RF.update(spark, f"{tmp_path}/store", f"{tmp_path}/state", L.FIXTURE)) == 2 and hints.count("rebalance") == len(RF.PARTIALS)
    finally:
        kind.hint = old
    got = RF.tables(spark, f"{tmp_path}/state", L.FIXTURE)["company_volume"].collect()
    assert [(r.company, r.n) for r in got] == [("a", 9)]
