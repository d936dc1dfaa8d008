"""DuckDB SQL for the registered queries (the correctness oracle).

Written independently of the Spark plans: dedup uses a window, hit counts are
spelled out per list entry, term statistics use plain ``unnest`` + ``GROUP BY``.
The word lists come from the same lexicon profile.
"""

from __future__ import annotations

from collections.abc import Sequence

from .. import lexicons as L

LEX = L.FIXTURE
WS = " \\t\\n\\x0B\\f\\r"
WORD_RE = r"[\p{L}\p{N}\p{M}_]{2,}"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(words: Sequence[str]) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]::VARCHAR[]"


def clean(x: str, stop: Sequence[str]) -> str:
    stop_l = sorted({w.lower() for w in stop})
    squeezed = (f"regexp_replace(regexp_replace(lower({x}), '[^a-zğüşıöç{WS}]', ' ', 'g'), "
                f"'[{WS}]+', ' ', 'g')")
    kept = f"list_filter(string_split({squeezed}, ' '), lambda w: NOT list_contains({lst(stop_l)}, lower(w)))"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE coalesce(array_to_string({kept}, ' '), '') END"


def hits(x: str, words: Sequence[str]) -> str:
    if not words:
        return "0"
    return "(" + " + ".join(f"contains(coalesce({x}, ''), {q(w)})::INT" for w in words) + ")"


def any_hit(x: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains(coalesce({x}, ''), {q(w)})" for w in words) + ")"


def sentiment(x: str, lex: L.Lexicon) -> str:
    m = f"lower({x})"
    score = f"(2 * {hits(m, lex.positive)} - 2 * {hits(m, lex.negative)})"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'NOTR' "
            f"WHEN {any_hit(m, lex.request)} AND {score} > -4 AND {score} < 4 THEN 'NOTR (TALEP)' "
            f"WHEN {score} <= -2 THEN 'NEGATIF' WHEN {score} >= 2 THEN 'POZITIF' ELSE 'NOTR' END")


def weight(x: str) -> str:
    return (f"CASE {x} WHEN 'NEGATIF' THEN 3 WHEN 'NOTR (TALEP)' THEN 2 WHEN 'NOTR' THEN 1 "
            f"WHEN 'POZITIF' THEN 0 ELSE 1 END")


def tokens(x: str, stop: Sequence[str] = ()) -> str:
    t = f"regexp_extract_all(lower({x}), '{WORD_RE}')"
    if stop:
        t = f"list_filter({t}, lambda w: NOT list_contains({lst(sorted(set(stop)))}, w))"
    return t


def base_ctes(lex: L.Lexicon = LEX) -> str:
    """docs → enriched (every row) → store (one row per cleaned text, smallest doc_id)."""
    return f"""
docs AS (SELECT doc_id, source AS company, CAST(doc_id AS VARCHAR) AS link, text AS content FROM documents),
enr0 AS (SELECT *, {clean('content', lex.stream_stop)} AS cleaned FROM docs),
enr AS (SELECT *, {sentiment('cleaned', lex)} AS sentiment FROM enr0),
store AS (SELECT * FROM enr WHERE cleaned IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY cleaned ORDER BY doc_id) = 1),
risk0 AS (SELECT *, {hits('cleaned', lex.churn_critical_rule)} AS rule_crit_hits,
                 {weight('sentiment')} AS rule_weight FROM store),
risk1 AS (SELECT *, least(greatest(rule_crit_hits * 30 + rule_weight * 20, 0), 100) AS rule_risk FROM risk0),
risk AS (SELECT *, CASE WHEN rule_risk > -1 AND rule_risk <= 40 THEN {q(L.RISK_LABELS[0])}
                        WHEN rule_risk > 40 AND rule_risk <= 75 THEN {q(L.RISK_LABELS[1])}
                        WHEN rule_risk > 75 AND rule_risk <= 101 THEN {q(L.RISK_LABELS[2])} END AS risk_group
         FROM risk1),
feat AS (SELECT *, {hits('cleaned', lex.churn_critical_model)} AS crit_hits,
                {hits('cleaned', lex.churn_medium)} AS mid_hits,
                CAST({weight('sentiment')} AS DOUBLE) AS sentiment_weight FROM risk),
feat2 AS (SELECT *, CASE WHEN crit_hits >= 1 AND sentiment_weight >= 2 THEN 1 ELSE 0 END AS churn_label FROM feat)"""


def with_base(body: str, lex: L.Lexicon = LEX) -> str:
    return f"WITH {base_ctes(lex)}\n{body}"


RISK_ORDER = ", ".join(f"({q(lab)}, {i + 1})" for i, lab in enumerate(L.RISK_LABELS))

TERM_STATS = f"""
tok AS (SELECT doc_id, {tokens('cleaned', LEX.analysis_stop)} AS t FROM store),
ex AS (SELECT doc_id, unnest(t) AS term FROM tok),
stats AS (SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM ex GROUP BY term)"""

BIGRAMS = f"""
tk AS (SELECT doc_id, regexp_extract_all(lower(cleaned), '{WORD_RE}') AS t FROM store),
bg AS (SELECT t[i] || ' ' || t[i + 1] AS bigram FROM tk, range(1, len(t)) r(i)),
bc AS (SELECT bigram, count(*) AS n FROM bg GROUP BY bigram ORDER BY n DESC, bigram ASC LIMIT 15),
edges AS (SELECT least(split_part(bigram, ' ', 1), split_part(bigram, ' ', 2)) AS src,
                 greatest(split_part(bigram, ' ', 1), split_part(bigram, ' ', 2)) AS dst, min(n) AS weight
          FROM bc GROUP BY 1, 2)"""


def _sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["clean_text"] = f"SELECT doc_id, {clean('text', LEX.stream_stop)} AS cleaned FROM documents"
    s["clean_text_reference_lexicon"] = (
        f"SELECT doc_id, {clean('text', L.REFERENCE.stream_stop)} AS cleaned FROM documents")
    s["dedup_texts"] = with_base("SELECT doc_id, company, cleaned FROM store")
    s["row_counts"] = with_base("SELECT count(*) AS n_rows, count(DISTINCT cleaned) AS n_distinct FROM enr")
    s["sentiment_rows"] = with_base("SELECT doc_id, company, sentiment FROM enr")
    s["sentiment_by_company"] = with_base(
        "SELECT company, sentiment, count(*) AS n FROM store GROUP BY company, sentiment")
    s["sentiment_reference_lexicon"] = with_base(
        "SELECT sentiment, count(*) AS n FROM enr GROUP BY sentiment", L.REFERENCE)
    s["lexicon_hits"] = with_base(
        f"SELECT doc_id, {hits('cleaned', LEX.negative)} AS neg_hits, {hits('cleaned', LEX.positive)} AS pos_hits, "
        f"CAST({any_hit('cleaned', LEX.request)} AS INT) AS req_hit, "
        f"{hits('cleaned', LEX.churn_critical_model)} AS crit_hits, {hits('cleaned', LEX.churn_medium)} AS mid_hits, "
        f"{hits('cleaned', LEX.churn_critical_rule)} AS rule_crit_hits FROM enr")
    s["sentiment_weight_lookup"] = with_base(
        f"SELECT sentiment, {weight('sentiment')} AS sentiment_weight, count(*) AS n FROM store GROUP BY 1, 2")
    s["rule_risk_rows"] = with_base(
        "SELECT doc_id, company, rule_crit_hits, rule_weight, CAST(rule_risk AS INT) AS rule_risk, risk_group "
        "FROM risk")
    s["risk_share"] = with_base(
        f"SELECT c.risk_group, coalesce(k.n, 0) AS n, round(coalesce(k.n, 0) * 100.0 / sum(coalesce(k.n, 0)) OVER (), 6) AS pct "
        f"FROM (VALUES {RISK_ORDER}) c(risk_group, ord) "
        f"LEFT JOIN (SELECT risk_group, count(*) AS n FROM risk GROUP BY 1) k USING (risk_group)")
    low, mid, crit = (q(x) for x in L.RISK_LABELS)
    s["risk_heatmap"] = with_base(
        f"SELECT company, round(100.0 * count(*) FILTER (WHERE risk_group = {low}) / count(*), 6) AS low, "
        f"round(100.0 * count(*) FILTER (WHERE risk_group = {mid}) / count(*), 6) AS mid, "
        f"round(100.0 * count(*) FILTER (WHERE risk_group = {crit}) / count(*), 6) AS critical "
        f"FROM risk WHERE company IS NOT NULL AND risk_group IS NOT NULL GROUP BY company")
    s["company_volume"] = with_base(
        "SELECT company, count(*) AS n FROM store WHERE company IS NOT NULL GROUP BY company")
    s["refresh_volume_risk"] = with_base(
        "SELECT company, count(*) AS n, "
        + ", ".join(f"round_even(count(*) FILTER (WHERE risk_group = {g}) * 100.0::DOUBLE / count(*), 2) AS {c}"
                    for g, c in ((low, "low"), (mid, "mid"), (crit, "critical")))
        + " FROM risk WHERE company IS NOT NULL AND risk_group IS NOT NULL GROUP BY company")
    s["high_risk_rows"] = with_base(
        "SELECT doc_id, company, CAST(rule_risk AS INT) AS rule_risk FROM risk WHERE rule_risk >= 75")
    s["rule_risk_summary"] = with_base(
        "SELECT company, round(avg(rule_risk), 6) AS mean_risk, CAST(max(rule_risk) AS DOUBLE) AS max_risk, "
        "count(rule_risk) AS n FROM risk WHERE company IS NOT NULL GROUP BY company")
    s["alarm_count"] = with_base("SELECT count(*) AS n_alarm FROM risk WHERE rule_risk >= 75")
    s["churn_features"] = with_base(
        "SELECT doc_id, crit_hits, mid_hits, sentiment_weight, churn_label FROM feat2")
    s["churn_label_rate"] = with_base(
        "SELECT company, CAST(sum(churn_label) AS BIGINT) AS n_churn, count(*) AS n, "
        "round(sum(churn_label) / count(*), 6) AS rate FROM feat2 GROUP BY company")
    s["split_buckets"] = with_base(
        "SELECT doc_id, CAST(('0x' || substr(md5(link), 1, 8))::BIGINT % 100 AS INT) AS bucket, "
        "('0x' || substr(md5(link), 1, 8))::BIGINT % 100 < 20 AS is_test FROM store")
    s["split_exact"] = with_base(
        "SELECT doc_id, row_number() OVER (ORDER BY ('0x' || substr(md5(link), 1, 15))::BIGINT) <= ceil(0.2 * count(*) OVER ()) "
        "AS is_test FROM store")
    s["confusion_metrics"] = _confusion()
    s["term_df_min5"] = with_base(f",{TERM_STATS}\nSELECT term, df FROM stats WHERE df >= 5")
    s["vocab_top1000"] = with_base(
        f",{TERM_STATS}\nSELECT term, tf, df FROM stats WHERE df >= 5 ORDER BY tf DESC, term ASC LIMIT 1000")
    s["tfidf_top5"] = with_base(f""",
tok AS (SELECT company, {tokens('cleaned', LEX.analysis_stop)} AS t FROM store WHERE company IS NOT NULL),
tf AS (SELECT company, term, count(*) AS tf FROM (SELECT company, unnest(t) AS term FROM tok) GROUP BY 1, 2),
nd AS (SELECT count(DISTINCT company) AS n FROM store),
voc AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term ORDER BY total DESC, term ASC LIMIT 30),
w AS (SELECT tf.company, tf.term, tf.tf * (ln((1 + nd.n) / (1 + voc.df)) + 1) AS w FROM tf JOIN voc USING (term), nd),
x AS (SELECT company, term, w / sqrt(sum(w * w) OVER (PARTITION BY company)) AS tfidf FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY tfidf DESC, term ASC) AS rank FROM x)
SELECT company, term, CAST(rank AS INTEGER) AS rank, round(tfidf, 6) AS tfidf FROM r WHERE rank <= 5""")
    s["refresh_tfidf"] = s["tfidf_top5"]
    s["bigram_top15"] = with_base(f",{BIGRAMS}\nSELECT bigram, n FROM bc")
    s["bigram_top15_sketched"] = s["bigram_top15"]
    s["phrase_hits_automaton"] = s["phrase_hits_joined"] = (
        "WITH w AS (SELECT string_split(lower(text), ' ') AS w FROM benchmark), "
        "p AS (SELECT DISTINCT array_to_string(w[i:i + 1], ' ') AS phrase FROM w, range(1, greatest(len(w), 2)) r(i)) "
        "SELECT doc_id, CAST((SELECT count(*) FROM p WHERE contains(lower(coalesce(text, '')), phrase)) AS INT) AS hits FROM documents")
    s["word_edges"] = with_base(
        f",{BIGRAMS}\nSELECT src, dst, weight, round(weight * 4.0 / max(weight) OVER (), 6) AS width FROM edges")
    s["word_nodes"] = with_base(
        f",{BIGRAMS}\nSELECT word, count(*) AS degree FROM (SELECT src AS word FROM edges UNION ALL "
        f"SELECT dst FROM edges) GROUP BY word")
    stop_s = lst(sorted(set(LEX.analysis_stop)))
    s["cloud_words"] = with_base(f""",
ww AS (SELECT company, unnest(list_filter(regexp_split_to_array(cleaned, '[{WS}]+'), lambda x: x <> '')) AS word
       FROM store WHERE company IS NOT NULL),
cnt AS (SELECT company, word, count(*) AS n,
               length(word) >= 3 AND NOT list_contains({stop_s}, word) AS kept FROM ww GROUP BY 1, 2),
st AS (SELECT company, sum(CASE WHEN kept THEN n * length(word) ELSE 0 END)
                       + sum(CASE WHEN kept THEN n ELSE 0 END) - 1 AS kept_len FROM cnt GROUP BY company),
ch AS (SELECT cnt.* FROM cnt JOIN st USING (company) WHERE kept OR kept_len < 11),
r AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY n DESC, word ASC) AS rank FROM ch)
SELECT company, word, n, CAST(rank AS INTEGER) AS rank, round(n / max(n) OVER (PARTITION BY company), 6) AS rel FROM r WHERE rank <= 60""")
    s["cloud_words_folded"] = f"""WITH
ww AS (SELECT source AS company, unnest(list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda x: x <> '')) AS word
       FROM documents WHERE source IS NOT NULL),
cnt AS (SELECT company, word, count(*) AS n,
               length(word) >= 3 AND NOT list_contains({stop_s}, word) AS kept FROM ww GROUP BY 1, 2),
st AS (SELECT company, sum(CASE WHEN kept THEN n * length(word) ELSE 0 END)
                       + sum(CASE WHEN kept THEN n ELSE 0 END) - 1 AS kept_len FROM cnt GROUP BY company),
ch AS (SELECT cnt.*, lower(word) AS low FROM cnt JOIN st USING (company) WHERE kept OR kept_len < 11),
f AS (SELECT company, n, word, low, regexp_matches(low, '[^s]s$') AND EXISTS (
          SELECT 1 FROM ch b WHERE b.company = ch.company AND b.low = ch.low[:-2]) AS pl FROM ch),
g AS (SELECT company, CASE WHEN pl THEN low[:-2] ELSE low END AS base, CASE WHEN pl THEN word[:-2] ELSE word END AS form,
             sum(n) AS n FROM f GROUP BY 1, 2, 3),
k AS (SELECT company, base, sum(n) AS n, arg_min(form, (-n, form)) AS word FROM g GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY n DESC, word ASC) AS rank FROM k)
SELECT company, word, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank, round(n / max(n) OVER (PARTITION BY company), 6) AS rel
FROM r WHERE rank <= 60"""
    s["cloud_words_collocations"] = with_base(f""",
ww AS (SELECT company, list_filter(regexp_split_to_array(cleaned, '[{WS}]+'), lambda x: x <> '') AS w
       FROM store WHERE company IS NOT NULL),
cnt AS (SELECT company, word, count(*) AS n,
               length(word) >= 3 AND NOT list_contains({stop_s}, word) AS kept
        FROM (SELECT company, unnest(w) AS word FROM ww) GROUP BY 1, 2),
st AS (SELECT company, sum(CASE WHEN kept THEN n * length(word) ELSE 0 END)
                       + sum(CASE WHEN kept THEN n ELSE 0 END) - 1 AS kept_len,
              sum(CASE WHEN kept THEN n ELSE 0 END) AS n_kept FROM cnt GROUP BY company),
ch AS (SELECT cnt.*, st.kept_len, st.n_kept FROM cnt JOIN st USING (company) WHERE kept OR kept_len < 11),
kw AS (SELECT company, list_filter(w, lambda x: length(x) >= 3 AND NOT list_contains({stop_s}, x)) AS k FROM ww),
pr AS (SELECT company, k[i] AS w1, k[i + 1] AS w2 FROM kw, range(1, len(k)) r(i)),
pc AS (SELECT company, w1, w2, count(*) AS c12 FROM pr GROUP BY 1, 2, 3),
uses AS (SELECT * FROM ch WHERE kept AND kept_len >= 11),
s1 AS MATERIALIZED (SELECT pc.company, w1, w2, c12, u1.n AS c1, u1.n_kept AS nw
                   FROM pc JOIN uses u1 ON pc.company = u1.company AND pc.w1 = u1.word),
sc AS (SELECT s1.company, w1, w2, c12::DOUBLE AS c12, c1::DOUBLE AS c1, u2.n::DOUBLE AS c2, nw::DOUBLE AS nw
       FROM s1 JOIN uses u2 ON s1.company = u2.company AND s1.w2 = u2.word),
sc2 AS (SELECT *, CASE WHEN nw <= c1 OR nw <= c2 THEN 0.0 ELSE -2 * (
          {_ll('c12', 'c1', 'c2 / nw')} + {_ll('c2 - c12', 'nw - c1', 'c2 / nw')}
          - {_ll('c12', 'c1', 'c12 / c1')} - {_ll('c2 - c12', 'nw - c1', '(c2 - c12) / (nw - c1)')}) END AS score
        FROM sc),
col AS (SELECT company, w1, w2, CAST(c12 AS BIGINT) AS c12 FROM sc2 WHERE score > 30),
red AS (SELECT company, word, sum(c12) AS r FROM (SELECT company, w1 AS word, c12 FROM col UNION ALL
                                                 SELECT company, w2, c12 FROM col) GROUP BY 1, 2),
lft AS (SELECT ch.company, ch.word, ch.n - coalesce(red.r, 0) AS n FROM ch LEFT JOIN red USING (company, word)),
mg AS (SELECT company, word, CAST(n AS BIGINT) AS n FROM lft WHERE n > 0
       UNION ALL SELECT company, w1 || ' ' || w2, c12 FROM col),
r AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY n DESC, word ASC) AS rank FROM mg)
SELECT company, word, n, CAST(rank AS INTEGER) AS rank, round(n / max(n) OVER (PARTITION BY company), 6) AS rel
FROM r WHERE rank <= 60""")
    return s


def _ll(k: str, m: str, x: str) -> str:
    return f"(ln(greatest({x}, 1e-10)) * ({k}) + ln(greatest(1 - ({x}), 1e-10)) * (({m}) - ({k})))"


def _confusion() -> str:
    return with_base(""",
c AS (SELECT sum(CASE WHEN churn_label = 1 AND rule_risk >= 75 THEN 1 ELSE 0 END)::BIGINT AS tp,
             sum(CASE WHEN churn_label = 0 AND rule_risk >= 75 THEN 1 ELSE 0 END)::BIGINT AS fp,
             sum(CASE WHEN churn_label = 0 AND rule_risk < 75 THEN 1 ELSE 0 END)::BIGINT AS tn,
             sum(CASE WHEN churn_label = 1 AND rule_risk < 75 THEN 1 ELSE 0 END)::BIGINT AS fn FROM feat2),
m AS (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision,
             coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
             coalesce((tp + tn)::DOUBLE / nullif(tp + fp + tn + fn, 0), 0) AS accuracy FROM c)
SELECT tp, fp, tn, fn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall,
       round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1 FROM m""")


# --- pages -------------------------------------------------------------------
UWS = (r"\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
URL_RE = "^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)"


def unescape(x: str) -> str:
    for a, b in ENTITIES:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{UWS}]+|[{UWS}]+$', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{UWS}]+', ' ', 'g'))"


#: Text between tags: the page is split at every '<', and each part is read behind its first '>'.
def strip_tags(x: str) -> str:
    return unescape(f"array_to_string(list_transform(string_split('>' || {x}, '<'), lambda s: s[instr(s, '>') + 1:]), '')")


ARTICLE = "split_part(split_part(html, '<article>', 2), '</article>', 1)"


def junked(raw: str) -> str:
    for j in L.PAGE_JUNK:
        raw = f"replace({raw}, {q(j)}, '')"
    return squeeze(raw)


def main_text(html: str) -> str:
    block = py_strip(strip_tags(ARTICLE))
    markers = " OR ".join(f"contains({block}, {q(m)})" for m in L.CORPORATE_MARKERS)
    chosen = f"(CASE WHEN {markers} THEN {paragraphs()} ELSE {block} END)"
    return f"CASE WHEN length({block}) > {L.GOOD_TEXT_CHARS} AND length({chosen}) >= {L.REJECT_TEXT_CHARS} THEN {junked(chosen)} END"


def paragraphs() -> str:
    """Each part behind a '<p>' up to the tag that ends it."""
    ps = f"list_transform(string_split({ARTICLE}, '<p>')[2:], lambda p: {squeeze(strip_tags('split_part(p, chr(60) || chr(47) || chr(112) || chr(62), 1)'))})"
    return f"coalesce(trim(array_to_string({ps}, ' ')), '')"


def undot(u: str) -> str:
    """Dot segments out of the path: the segments are added one by one to a growing path."""
    shape = "'(?s)^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)(/[^?#]*)(.*)$'"
    segs = f"string_split(regexp_extract({u}, {shape}, 2), '/')[2:]"
    path = (f"list_reduce({segs}, lambda p, x: CASE x WHEN '.' THEN p WHEN '..' THEN regexp_replace(p, '/[^/]*$', '') "
            "ELSE p || '/' || x END, '')")
    tail = f"CASE WHEN {segs}[-1] IN ('.', '..') THEN {path} || '/' WHEN {path} = '' THEN '/' ELSE {path} END"
    return (f"CASE WHEN regexp_matches({u}, {shape}) THEN regexp_extract({u}, {shape}, 1) || ({tail}) || regexp_extract({u}, {shape}, 3) "
            f"ELSE {u} END")


def resolve(h: str, url: str) -> str:
    scheme = f"regexp_extract({url}, '{URL_RE}', 1)"
    host = f"regexp_extract({url}, '{URL_RE}', 2)"
    page = f"regexp_replace({url}, '#.*$', '')"
    file = f"split_part({page}, '?', 1)"
    folder = f"CASE WHEN contains(split_part({file}, '://', 2), '/') THEN regexp_replace({file}, '[^/]*$', '') ELSE {file} || '/' END"
    return (f"CASE WHEN {h} = '' OR starts_with({h}, '#') THEN {page} || {h} WHEN starts_with({h}, '?') THEN {file} || {h} ELSE "
            + undot(f"(CASE WHEN regexp_matches({h}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {h} "
                    f"WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h} "
                    f"WHEN starts_with({h}, '/') THEN {scheme} || '://' || {host} || {h} "
                    f"ELSE {folder} || {h} END)") + " END")


HREFS = """hr AS (SELECT page_id, url, list_transform(list_transform(string_split(html, '<li>')[2:],
    lambda c: split_part(split_part(c, 'href="', 2), '"', 1)), lambda h: """ + unescape("h") + """) AS l FROM pages),
ln0 AS (SELECT page_id, url, unnest(l) AS href, unnest(range(1, len(l) + 1)) AS pos FROM hr),
ln AS (SELECT page_id, pos, href, """ + resolve("href", "url") + """ AS link FROM ln0),
adm AS (SELECT *, link IS NOT NULL AND contains(link, 'example.com') AND NOT ends_with(trim(link), '-video') AS admitted FROM ln)"""


def _sql_more() -> dict[str, str]:
    s: dict[str, str] = {}
    s["page_main_text"] = f"SELECT page_id, {main_text('html')} AS content FROM pages"
    s["page_paragraphs"] = f"SELECT page_id, {paragraphs()} AS paragraphs FROM pages"
    body = f"regexp_replace(regexp_replace({ARTICLE}, '</?b>|<br>', '', 'g'), '<h1>.*?</h1>', '', 'gs')"
    reply = "De\u011ferli M\u00fc\u015fterimiz, yan\u0131t."
    texts = (f"list_transform(string_split({body}, '<p>')[2:], "
             f"lambda p: {squeeze(strip_tags('split_part(p, chr(60) || chr(47) || chr(112) || chr(62), 1)'))})")
    whole = f"CASE WHEN page_id % 3 = 0 THEN {q(reply)} ELSE '' END || {strip_tags(body)}"
    s["page_text_marked"] = f"""WITH b AS (SELECT page_id, {py_strip(whole)} AS block,
       coalesce(trim(array_to_string({texts}, ' ')), '') AS paras FROM pages),
c AS (SELECT page_id, CASE WHEN length(block) > 40 THEN CASE WHEN page_id % 3 = 0 THEN paras ELSE block END END AS t FROM b)
SELECT page_id, CASE WHEN length(t) >= 35 THEN {junked('t')} END AS content,
       CAST(page_id % 28 + 1 AS VARCHAR) || ' May\u0131s 10:30' AS date FROM c"""
    ways = ("CASE (pos + page_id) % 5 WHEN 0 THEN '../' || href[2:] WHEN 1 THEN './a/.././' || href[2:] WHEN 2 THEN '/x/../../y/.' || href "
            "WHEN 3 THEN '?back=../' || href[2:] ELSE '//www.example.com' || href || '/..#a/../b' END")
    s["page_links_dotted"] = (f"WITH {HREFS}, d AS (SELECT page_id, pos, {ways} AS href, url FROM ln JOIN pages USING (page_id)) "
                              f"SELECT page_id, CAST(pos AS INT) AS pos, href, {resolve('href', 'url')} AS link FROM d")
    s["page_links"] = f"WITH {HREFS} SELECT page_id, CAST(pos AS INT) AS pos, href, link FROM ln"
    s["link_admission"] = f"WITH {HREFS} SELECT page_id, CAST(pos AS INT) AS pos, link FROM adm WHERE admitted"
    s["new_links_antijoin"] = (f"WITH {HREFS} SELECT DISTINCT link FROM adm WHERE admitted "
                               f"AND link NOT IN (SELECT url FROM pages WHERE url IS NOT NULL)")
    s["crawl_round_summary"] = (
        f"WITH {HREFS}, seen AS (SELECT DISTINCT url AS link, true AS s FROM pages WHERE url IS NOT NULL) "
        f"SELECT page_id, count(*) AS n_links, CAST(sum(admitted::BIGINT) AS BIGINT) AS n_admitted, "
        f"CAST(sum((admitted AND seen.s IS NULL)::BIGINT) AS BIGINT) AS n_new FROM adm LEFT JOIN seen USING (link) "
        f"GROUP BY page_id")
    s["crawl_low_yield_stop"] = """WITH log AS (
  SELECT user_id AS site, CAST(floor(epoch_us(ts) / 3600000000.0) - floor(epoch_us(TIMESTAMP '2024-01-01') / 3600000000.0) + 1 AS INT) AS page_no,
         count(*) FILTER (WHERE event_type = 'purchase') AS n_new FROM events GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY page_no) AS k FROM log),
r AS (SELECT a.site, a.page_no, a.k - coalesce(max(b.k), 0) AS quiet FROM o a
      LEFT JOIN o b ON a.site = b.site AND b.k <= a.k AND b.n_new > 0 GROUP BY a.site, a.page_no, a.k)
SELECT site, count(*) AS n_pages, min(CASE WHEN page_no > 10 AND quiet >= 10 THEN page_no END) AS stop_page
FROM r GROUP BY site"""
    s["stream_low_yield_stop"] = (
        f"WITH stops AS ({s['crawl_low_yield_stop']}) SELECT site, (SELECT count(DISTINCT floor(epoch_us(ts) / 3600000000.0)) "
        "FROM events WHERE user_id = site AND floor(epoch_us(ts) / 3600000000.0) - floor(epoch_us(TIMESTAMP '2024-01-01') "
        "/ 3600000000.0) + 1 <= stop_page) AS n_pages, CAST(stop_page AS BIGINT) AS stop_page FROM stops WHERE stop_page IS NOT NULL")
    s["stream_seen_links"] = s["new_links_antijoin"]
    company = f"coalesce(CASE " + " ".join(
        f"WHEN starts_with(url, {q(p)}) THEN {q(n)}" for n, p in sorted(L.CRAWL_TARGETS, key=lambda t: -len(t[1]))
    ) + f" END, regexp_extract(url, '{URL_RE}', 2))"
    s["page_records"] = (
        f"WITH r AS (SELECT url AS link, {company} AS company, '05 Mayıs 10:30' AS date, {main_text('html')} AS content, "
        f"epoch(TIMESTAMP '2024-05-05 10:30:00') AS crawl_timestamp "
        f"FROM pages) SELECT * FROM r WHERE content IS NOT NULL AND content <> '' AND NOT starts_with(content, 'Hata:')")
    tr = "strftime(ts, '%-d %B %H:%M')"
    out = tr
    for en, t in L.MONTHS_EN_TR:
        out = f"regexp_replace({out}, '\\b{en}\\b', {q(t)}, 'g')"
    s["month_standardise"] = f"SELECT event_id, {tr} AS date_en, {out} AS date_tr FROM events"
    s["json_roundtrip"] = ("SELECT doc_id, source AS company, CAST(NULL AS VARCHAR) AS date, "
                           "CAST(doc_id AS VARCHAR) AS link, text AS content FROM documents")
    s["json_event_props"] = "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"
    s["stream_clean_sentiment"] = with_base("SELECT link, company, cleaned, sentiment FROM enr")
    s["stream_idempotent_sink"] = with_base("SELECT link, company, sentiment FROM enr")
    s["skip_duplicate_insert"] = with_base("SELECT doc_id, company, cleaned FROM store")
    s["stream_watermark_dedup"] = with_base("SELECT link, company, sentiment FROM enr")
    s["seen_set_union"] = (f"WITH {HREFS} SELECT DISTINCT link FROM (SELECT url AS link FROM pages UNION ALL "
                           f"SELECT link FROM adm WHERE admitted) WHERE link IS NOT NULL")
    s["formatted_volume"] = with_base(
        "SELECT company, format('{:,}', count(*)) AS n_text, "
        "format('{:,.2f}', count(*) * 100.0 / sum(count(*)) OVER ()) || '%' AS pct_text "
        "FROM store WHERE company IS NOT NULL GROUP BY company")
    s["csv_roundtrip"] = ("SELECT source AS company, CAST(NULL AS VARCHAR) AS date, CAST(doc_id AS VARCHAR) AS link, "
                          "text AS content FROM documents")
    from .queries import AWKWARD
    awkward = "text"
    for word, put in AWKWARD:
        awkward = f"replace({awkward}, {q(word)}, " + " || ".join("chr(%d)" % ord(c) for c in put) + ")"
    s["csv_roundtrip_escapes"] = ("SELECT source AS company, CAST(NULL AS VARCHAR) AS date, CAST(doc_id AS VARCHAR) AS link, "
                                  f"{awkward} AS content FROM documents")
    s["stream_progress"] = "SELECT CAST(2 * count(*) AS BIGINT) AS rows_in, true AS once FROM documents"
    counts = [hits("cleaned", w) for w in (LEX.negative, LEX.positive, LEX.churn_critical_model)]
    names = " ".join(f"WHEN {k} THEN {q(v)}" for k, v in L.TOPIC_NAMES.items())
    ruled = with_base(f""",
tp AS (SELECT *, CASE WHEN h1 >= h2 AND h1 >= h3 THEN 1 WHEN h2 >= h3 THEN 2 ELSE 3 END AS topic
       FROM (SELECT *, {counts[0]} AS h1, {counts[1]} AS h2, {counts[2]} AS h3 FROM feat2)),
tn AS (SELECT *, CASE topic {names} END AS topic_name FROM tp)""")
    s["topic_argmax"] = ruled + "SELECT doc_id, CAST(topic AS INT) AS topic, topic_name FROM tn"
    from .queries import TOPIC_SEEDS
    seeds = ", ".join(f"({q(name)}, {q(w)})" for name, words in TOPIC_SEEDS.items() for w in sorted(set(words)))
    labels = ", ".join(f"({k}, {q(name)})" for k, name in enumerate(TOPIC_SEEDS))
    s["topic_names_seeded"] = ruled + f""",
tw AS (SELECT topic, unnest({tokens('cleaned')}) AS term FROM tp),
tt AS (SELECT topic, term, count(*) AS n FROM tw GROUP BY 1, 2),
wt AS (SELECT topic, term, n / sum(n) OVER (PARTITION BY topic) AS weight FROM tt),
nm(o, name) AS (VALUES {labels}), sd(name, term) AS (VALUES {seeds}),
sc AS (SELECT t.topic, nm.name, nm.o, coalesce((SELECT sum(weight) FROM wt JOIN sd USING (term)
         WHERE wt.topic = t.topic AND sd.name = nm.name), 0) AS score FROM (VALUES (1), (2), (3)) t(topic), nm),
al AS (SELECT a.name AS n1, b.name AS n2, c.name AS n3, a.score AS s1, b.score AS s2, c.score AS s3, a.score + b.score + c.score AS total,
              a.o AS o1, b.o AS o2 FROM sc a, sc b, sc c
       WHERE a.topic = 1 AND b.topic = 2 AND c.topic = 3 AND a.name <> b.name AND a.name <> c.name AND b.name <> c.name),
be AS (SELECT * FROM al ORDER BY total DESC, o1, o2 LIMIT 1)
SELECT CAST(1 AS INT) AS topic, CASE WHEN s1 > 0 THEN n1 END AS name,
       CASE WHEN s1 > 0 THEN round(total - (SELECT max(total) FROM al WHERE al.n1 <> be.n1), 6) END AS margin FROM be
UNION ALL SELECT 2, CASE WHEN s2 > 0 THEN n2 END, CASE WHEN s2 > 0 THEN round(total - (SELECT max(total) FROM al WHERE al.n2 <> be.n2), 6) END FROM be
UNION ALL SELECT 3, CASE WHEN s3 > 0 THEN n3 END, CASE WHEN s3 > 0 THEN round(total - (SELECT max(total) FROM al WHERE al.n3 <> be.n3), 6) END FROM be"""
    s["topic_share"] = ruled + ("SELECT topic_name, count(*) AS n, round_even(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS pct "
                                "FROM tn WHERE topic_name IS NOT NULL GROUP BY topic_name")
    cols = ", ".join(f"round_even(count(*) FILTER (WHERE topic = {k}) * 100.0::DOUBLE / count(*), 2) AS topic_{k}" for k in (1, 2, 3))
    s["topic_company_crosstab"] = ruled + f"SELECT company, {cols} FROM tp WHERE company IS NOT NULL GROUP BY company"
    s["churn_features_topic"] = ruled + ("SELECT doc_id, CAST(topic AS INT) AS topic, CAST(topic = 2 AS INT) AS is_billing, "
                                         "CAST(topic = 3 AS INT) AS is_infra, churn_label FROM tp")
    s["report_readback"] = with_base("SELECT company, count(*) AS n, count(*) AS n_parquet FROM store "
                                     "WHERE company IS NOT NULL GROUP BY company")
    from .queries import TO_TURKISH
    text = "text"
    for word, tr in TO_TURKISH:
        text = f"replace({text}, ' {word} ', ' {tr} ')"
    s["turkish_clean_sentiment"] = (
        f"WITH t AS (SELECT doc_id, {text} AS content FROM documents), c AS (SELECT doc_id, "
        f"{clean('content', L.REFERENCE.stream_stop)} AS cleaned FROM t) SELECT doc_id, cleaned, {sentiment('cleaned', L.REFERENCE)} AS sentiment FROM c")
    s["history_roundtrip"] = ("SELECT CAST(doc_id AS VARCHAR) AS link, CAST(2 AS BIGINT) AS n_copies, "
                              "source AS company FROM documents")
    s["store_scan"] = with_base("SELECT link, company, cleaned, sentiment FROM store")
    s["conversation_sentiment"] = (
        f"WITH c0 AS (SELECT role AS company, {clean('text', LEX.stream_stop)} AS cleaned FROM conversations), "
        f"c1 AS (SELECT company, {sentiment('cleaned', LEX)} AS sentiment FROM c0) "
        f"SELECT company, sentiment, count(*) AS n FROM c1 GROUP BY 1, 2")
    return s


ORACLE_SQL: dict[str, str] = {**_sql(), **_sql_more()}
