"""URL filter: allow and block rules, then word segmentation and naive Bayes for what no rule decides.

Names such as ``cheapflights`` are split into words by a unigram Viterbi
search, and multinomial naive Bayes over the words of host and path gives the
verdict.  A word's probability is the mean of its share of a general word list
(the whole words of a tokenizer's vocabulary, whose order is that of frequency)
and its share of the text of all pages.  So a word that no page holds stays
whole.  The classifier learns from labelled URLs (``LABELLED`` or the caller's own).

Only a name that contains a word of the classifier can have a score.  The
distinct such names are joined with the page counts of all words they can be
cut into, split and scored in partitions, and the scores are joined back to the
pages; both joins back are salted, as one name or URL may fill a third of the
rows.  The driver holds the word list and the classifier, nothing of the pages
but their number of words.  :func:`judge` does the same with a dictionary that
fits in memory, in one scan.

What an unknown word costs, and the least probability of the classifier's words,
are fixed, so a table of more pages with the same shares gives the same verdicts.
Page words of more than ``MAX_WORD`` letters are not looked up in names; a
longer piece of a name is one unknown word or consists of others.

Defined cases: a null URL or one without ``://`` has empty host and path, fits
no rule and has no words, so the class prior decides (allow); equal rows get
equal verdicts; an empty table gives an empty result; a very long name is searched like any other.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage_table
from .html_extract import blocks

PRIOR_BLOCK = 0.2
MAX_WORD = 24
MAX_NAMES = 200_000
VOCABULARY = "word_bpe_49k.json"
SALTS = 16
SLICE = 50_000
#: Tenfold less probable with each letter: 10 ** -(UNKNOWN + letters) for an unknown word; a word of the classifier
#: has at least 10 ** -(1 + letters), letters counted as ``SHORT`` at least.
UNKNOWN = SHORT = 5

#: (verdict, host, path); a rule is written host + path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Labelled URLs: host and path words written apart, as a person would read them.
LABELLED = {
    "block": (
        "online casino / free spins bonus", "casino win / jackpot slots", "poker bets / win money", "free bets / odds bonus",
        "best sports betting / bet now", "cheap pills / buy online", "discount pharmacy / cheap meds no prescription",
        "buy viagra / pills sale", "adult x / videos", "hot adult cams / live sex", "xxx tube / porn video",
        "spam farm / links", "link farm / buy backlinks", "ads track / click", "ad server / banner click",
        "tracker pixel / ads redirect", "free prize winner / claim now", "lottery win / claim prize",
        "payday loans / cash fast", "cheap replica watches / sale", "work from home / earn money fast",
        "crypto double / free bitcoin", "warez crack / free download keygen", "diet pills / lose weight fast",
        "viagra shop / cheap viagra", "replica bags / replica handbags outlet", "replica rolex / replica watches",
        "live casino / roulette blackjack", "slots jackpot / roulette spins", "porn tube / porn free", "xxx cams / sex chat",
        "escort girls / sex dating", "betting tips / poker casino", "payday cash / instant loans", "torrent warez / cracked keygen",
        "adware popup / ads clicks", "lottery jackpot / lottery numbers win",
    ),
    "allow": (
        "city library / events reading", "daily news / world politics", "garden blog / plants soil",
        "history museum / exhibits ancient", "science journal / articles physics", "open source docs / manual install",
        "travel diary / mountains lake", "school board / lessons math", "weather service / forecast rain",
        "cooking recipes / bread soup", "university press / books review", "bird watch / field notes",
        "music archive / concert recordings", "city council / minutes meeting", "health clinic / patients care",
        "film review / cinema drama", "language course / grammar words", "railway timetable / trains stations",
        "local football club / team results", "poetry society / poems authors", "law report / court cases",
        "photo gallery / nature light", "chess club / games endgame", "data statistics / tables census",
        "click house / database docs", "cheap side / london street", "cheap flights / travel guide", "free dom / rights history",
        "free press / news reports", "free software / download manual", "money museum / coins history", "link index / library catalogue",
        "buy local / farm market", "work shop / wood tools", "clock maker / clocks repair", "online courses / university lessons",
        "double bass / concert music", "fast food / recipes review", "prize poems / winner society", "bonus track / album review",
        "sex education / health lessons", "cash flow / accounting lessons",
    ),
}

_LETTERS = re.compile(r"[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")
_LOG_10 = math.log(10)


def host_of(url: str | Column) -> Column:
    host = F.regexp_extract(F.col(url) if isinstance(url, str) else url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url) if isinstance(url, str) else url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (null: none)."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the longest ends up outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, v).otherwise(verdict)
    return rule, verdict


def page_words(page: str) -> list[str]:
    """The words of a page's text in lower case, inline tags and character references resolved."""
    return [w for b in blocks(page) for w in _WORD.findall(b.text.lower() if b.text.isascii() else normalize("NFC", b.text.lower()))]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``w, n``: words that can stand in a name, and all others as null."""
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["w", "n"])

    count: Counter[str | None] = Counter()
    for b in batches:
        for page in b.column(0).to_pylist():
            count.update(w if w.isascii() and len(w) <= MAX_WORD else None for w in page_words(page or ""))
            if len(count) >= SLICE:
                yield out()
                count.clear()
    if count:
        yield out()


def general_words(path: str | None = None) -> dict[str, float]:
    """Whole words of a tokenizer's vocabulary with their probability, which falls with the place (one over the place)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    whole = re.compile(r"(?:[ai]|[a-z]{2,})</w>")  # the other single letters are the alphabet, not words
    words = [w[:-4] for w in sorted(vocabulary, key=vocabulary.get) if whole.fullmatch(w)]
    scale = sum(1 / n for n in range(1, len(words) + 1))
    return {w: 1 / (n * scale) for n, w in enumerate(words, 1)}


def _known(bayes: Bayes) -> re.Pattern:
    return re.compile("|".join(sorted(bayes.odds))) if bayes.odds else re.compile("(?!)")


def scored_names(urls: DataFrame, bayes: Bayes) -> DataFrame:
    """``host, path, name`` for each name in (host, path) that contains a word of the classifier."""
    known = _known(bayes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(h, p, name) for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                   for name in names_of(h, p) if known.search(name)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in range(3)], ["host", "path", "name"])

    return urls.select("host", "path").mapInArrow(run, "host string, path string, name string")


def name_pieces(names: DataFrame) -> DataFrame:
    """``name, w``: the substrings, of ``MAX_WORD`` letters at most, of each row's name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array([name] * len(seen), pa.string()), pa.array(sorted(seen), pa.string())], ["name", "w"])
            seen.clear()
            return rows

        seen: set[str] = set()
        for b in batches:
            for name in b.column(0).to_pylist():
                for at in range(len(name)):
                    seen.update(name[at:end] for end in range(at + 1, min(len(name), at + MAX_WORD) + 1))
                    if len(seen) * len(name) >= 50 * SLICE:
                        yield out()
                if seen:
                    yield out()

    return names.select("name").mapInArrow(run, "name string, w string")


def page_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``w, n``: the words of the text of all pages; all that cannot stand in a name as null."""
    return pages.select(html_col).mapInArrow(_counts, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))


def url_parts(urls: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    return urls.select(F.col(id_col).cast("long").alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))


def word_counts(pages: DataFrame, bayes: Bayes, url_col: str = "url", html_col: str = "html") -> tuple[dict[str, int], int]:
    """Counts of the page words that the names can use, and the number of all words, for a dictionary in memory."""
    names = scored_names(url_parts(pages.withColumn("page_id", F.lit(0)), "page_id", url_col), bayes).select("name").distinct()
    count = page_counts(pages, html_col)
    parts = name_pieces(names).select("w").distinct().withColumn("used", F.lit(True))
    found = count.join(parts, "w", "left").groupBy(F.when(F.col("used"), F.col("w")).alias("w")).agg(F.sum("n").alias("n"))
    counts = {r["w"]: r["n"] for r in found.collect()}  # the words in names, and one sum of all others
    total = sum(counts.values())
    counts.pop(None, None)
    return counts, total


@dataclass
class Words:
    """Unigram model of words."""

    counts: dict[str, float]
    total: float = 0.0  # of all words, also those without an entry; 0: the sum of ``counts``
    general: dict[str, float] = field(default_factory=dict)  # probabilities of a general word list

    def __post_init__(self):
        self.total = float(self.total or sum(self.counts.values()) or 1)
        self.longest = max(map(len, [*self.counts, *self.general]), default=1)

    def cost(self, w: str) -> float:
        """-log probability; an unknown word costs more the longer it is, and a known one never more than if unknown."""
        p = self.counts.get(w, 0) / self.total
        if self.general:
            p = (p + self.general.get(w, 0.0)) / 2
        unknown = (UNKNOWN + len(w)) * _LOG_10
        return min(-math.log(p), unknown) if p else unknown

    def split(self, name: str) -> list[str]:
        """The cheapest split of a run of letters (Viterbi over end positions; of equal costs the longer last word).

        Known words have at most the letters of the longest one; unknown words may be of any length: as their cost
        grows evenly with the letters, one best start is kept for each end."""
        best, back, start = [0.0], [0], 0
        for end in range(1, len(name) + 1):
            if best[end - 1] - (end - 1) * _LOG_10 < best[start] - start * _LOG_10:
                start = end - 1
            cost, at = min((best[s] + self.cost(name[s:end]), s) for s in range(max(0, end - self.longest), end))
            cost, at = min((cost, at), (best[start] + (UNKNOWN + end - start) * _LOG_10, start))
            best.append(cost)
            back.append(at)
        out, end = [], len(name)
        while end:
            out.append(name[back[end]:end])
            end = back[end]
        return out[::-1]


@dataclass
class Bayes:
    """Multinomial naive Bayes: log odds of ``block`` per known word."""

    odds: dict[str, float]
    prior: float

    def score(self, words: list[str]) -> float:
        return self.prior + sum(self.odds.get(w, 0.0) for w in words)


def fit(labelled: dict[str, tuple] = LABELLED, prior_block: float = PRIOR_BLOCK, smooth: float = 0.5) -> Bayes:
    counts: dict[str, dict[str, int]] = {"block": {}, "allow": {}}
    for label, urls in labelled.items():
        for url in urls:
            for w in _LETTERS.findall(url.lower()):
                counts[label][w] = counts[label].get(w, 0) + 1
    vocabulary = counts["block"].keys() | counts["allow"].keys()
    size = {k: sum(c.values()) + smooth * len(vocabulary) for k, c in counts.items()}
    odds = {w: math.log((counts["block"].get(w, 0) + smooth) / size["block"])
            - math.log((counts["allow"].get(w, 0) + smooth) / size["allow"]) for w in vocabulary}
    return Bayes(odds, math.log(prior_block / (1 - prior_block)))


def dictionary(corpus: dict[str, int], bayes: Bayes, total: int = 0, general: dict[str, float] | None = None) -> Words:
    """Corpus counts (of ``total`` words), in which the classifier's words have a least share that no table's size changes."""
    total = total or sum(corpus.values()) or 1
    return Words(corpus | {w: max(corpus.get(w, 0), total * 10.0 ** -(1 + max(SHORT, len(w)))) for w in bayes.odds}, total, general or {})


def names_of(host: str, path: str) -> list[str]:
    """The runs of letters in the host's labels (without the last, the top-level domain) and in the path."""
    return _LETTERS.findall(host.rpartition(".")[0]) + _LETTERS.findall(path.lower())


def url_words(host: str, path: str, words: Words, memo: dict) -> list[str]:
    """Words of all names of a URL."""
    out = []
    for name in names_of(host, path):
        if name not in memo:
            if len(memo) >= MAX_NAMES:
                memo.clear()
            memo[name] = words.split(name)
        out += memo[name]
    return out


def verdicts(scored: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` from ``page_id, host, path, score``."""
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(
        verdict, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")


def judge(urls: DataFrame, words: Words, bayes: Bayes, id_col: str = "page_id", url_col: str = "url",
          rules: tuple = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row; ``score`` is the log odds of ``block``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, list[str]] = {}
        for b in batches:
            score = [bayes.score(url_words(h, p, words, memo)) for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score, pa.float64())], [*b.schema.names, "score"])

    return verdicts(url_parts(urls, id_col, url_col).mapInArrow(run, "page_id long, host string, path string, score double"), rules)


def url_filter(pages: DataFrame, bayes: Bayes | None = None, general: dict[str, float] | None = None, id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html", rules: tuple = RULES) -> DataFrame:
    """The rows of :func:`judge` with the counts of all page words, which are joined to the names and never collected.

    Scores are summed in whole millionths, so the order of the sums does not matter."""
    bayes = fit() if bayes is None else bayes
    general = general_words() if general is None else general
    counts = stage_table(page_counts(pages, html_col), "url-words")
    total = counts.agg(F.sum("n")).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = dictionary({}, bayes, total, general)
        floor, longest = base.counts, base.longest
        for b in batches:
            names, scores = b.column(0).to_pylist(), []
            for name, found in zip(names, b.column(1).to_pylist()):
                own = {f["w"]: f["n"] for f in found}
                base.counts = floor | {w: max(n, floor.get(w, 0)) for w, n in own.items()}
                base.longest = max(longest, max(map(len, own), default=1))
                scores.append(round(1e6 * (bayes.score(base.split(name)) - bayes.prior)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.int64())], ["name", "part"])

    parts = url_parts(pages, id_col, url_col)
    names = scored_names(parts.select("host", "path").distinct(), bayes)
    used = name_pieces(names.select("name").distinct()).join(counts.filter(F.col("w").isNotNull()), "w", "left")
    used = used.groupBy("name").agg(F.collect_set(F.when(F.col("n").isNotNull(), F.struct("w", "n"))).alias("found"))
    part = used.mapInArrow(run, "name string, part long").filter("part <> 0")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salt = F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int").alias("salt")
    score = names.select("*", salt).join(part.select("*", salts), ["name", "salt"]).groupBy("host", "path").agg(F.sum("part").alias("part"))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt")
    rows = parts.select("*", salt).join(score.select("*", salts), ["host", "path", "salt"], "left")
    return verdicts(rows.withColumn("score", F.coalesce("part", F.lit(0)) / 1e6 + bayes.prior), rules)
