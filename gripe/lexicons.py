"""Word lists, maps and labels used by the text operators.

Every operator takes a :class:`Lexicon` so the same code runs on the
Turkish complaint corpus (``REFERENCE``) and on the synthetic test corpus
(``FIXTURE``).  Lists keep their order and repeats: hit counts are sums over
list entries, as in the original pipeline.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace
from pathlib import Path

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the original pipeline's values for equal results.
# Stated as text, in their original order.
# ---------------------------------------------------------------------------

# Lexicon sentiment: negative words (34).
NEGATIVE_WORDS = [
    "cayma", "fahiş", "haksız", "icra", "borç", "pahalı", "zam", "yansıtılmış",
    "ücret", "aşım", "kesinti", "bedeli", "fatura", "soygun", "mağdur", "rezalet",
    "oyalıyor", "bekletildim", "iptal", "berbat", "pişman", "muhatap", "ilgisiz",
    "umursamaz", "çözülmedi", "erteleniyor", "nakil", "gecikme", "çekmiyor",
    "yavaş", "kopuyor", "sinyal", "arıza", "altyapı",
]

# Lexicon sentiment: positive words (14).
POSITIVE_WORDS = [
    "teşekkür", "memnun", "hızlı", "çözüldü", "uygun", "iyi", "başarılı",
    "harika", "güzel", "ilgili", "nazik", "kibar", "kaliteli", "çekiyor",
]

# Request markers: a hit with a score strictly between -4 and 4 gives NOTR (TALEP).
REQUEST_MARKERS = ["ama", "fakat", "istiyorum"]

# Stop words of the streaming cleaner (41, brand names included).
STREAM_STOP_WORDS = [
    "bir", "böyle", "kadar", "şu", "bu", "ve", "veya", "ile", "de", "da", "ki", "o", "bunu",
    "rağmen", "şekilde", "olarak", "tarafıma", "ancak", "yaklaşık", "en", "için", "ise", "mi",
    "ediyorum", "ederim", "büyük", "küçük", "gün", "saat", "ay", "yıl", "tane", "adet", "sonra",
    "turkcell", "vodafone", "turktelekom", "türk", "telekom", "şikayetvar", "merhaba",
]

# Stop words of the analysis and chart jobs (56 listed, "bana" twice).
ANALYSIS_STOP_WORDS = [
    "müşteri", "talep", "ilgili", "üzerinden", "bana", "hizmetlerini", "hizmetleri",
    "hiçbir", "herhangi", "tarafından", "böyle", "şöyle", "bizi", "bana", "beni", "bende",
    "biri", "bunun", "buna", "bunda", "onlar", "şunlar", "böylece", "edilmesini", "istiyorum",
    "hem", "daha", "ne", "her", "aynı", "bir", "kadar", "sonra", "bütün", "hattım",
    "gibi", "için", "olan", "olarak", "neyse", "değil", "yok", "var", "şey", "mi", "mu",
    "nedeniyle", "yoksa", "başka", "bunu", "benim", "şuan", "yine", "yani", "devam", "önce",
]

# Churn phrases of the model features: critical (8) and medium (6).
CHURN_CRITICAL_MODEL = [
    "iptal", "cayma", "kapatma", "geçeceğim", "bırakacağım", "tüketici hakem",
    "başka operatör", "taşınması",
]
CHURN_MEDIUM = ["pişmanlık", "rezalet", "bıktım", "şikayetçiyim", "muhatap", "haksızlık"]

# Churn phrases of the rule score (7, without "taşınması").
CHURN_CRITICAL_RULE = [
    "iptal", "cayma", "kapatma", "geçeceğim", "bırakacağım", "tüketici hakem", "başka operatör",
]

# Sentiment labels.
NEGATIVE = "NEGATIF"
POSITIVE = "POZITIF"
NEUTRAL = "NOTR"
REQUEST = "NOTR (TALEP)"
SENTIMENT_LABELS = [NEGATIVE, REQUEST, NEUTRAL, POSITIVE]

# Sentiment -> churn weight; any other value (or null) -> 1.
SENTIMENT_WEIGHT = {"NEGATIF": 3, "NOTR (TALEP)": 2, "NOTR": 1, "POZITIF": 0}
SENTIMENT_WEIGHT_DEFAULT = 1

# Rule-risk groups: right-closed bins (-1, 40], (40, 75], (75, 101].
RISK_BIN_EDGES = [-1, 40, 75, 101]
RISK_LABELS = ["Düşük Risk", "Orta Risk", "Kritik Risk"]

# Dominant LDA topic number -> name.
TOPIC_NAMES = {1: "Tarife/Paket Politikası", 2: "Fatura/İptal Krizleri", 3: "Altyapı/Arıza Sorunları"}

# English -> Turkish month names, in calendar order.
MONTHS_EN_TR = [
    ("January", "Ocak"), ("February", "Şubat"), ("March", "Mart"), ("April", "Nisan"),
    ("May", "Mayıs"), ("June", "Haziran"), ("July", "Temmuz"), ("August", "Ağustos"),
    ("September", "Eylül"), ("October", "Ekim"), ("November", "Kasım"), ("December", "Aralık"),
]

# Page-text junk removed before whitespace normalisation.
PAGE_JUNK = ["...", "Devamını oku", "Küçült", "Tümünü gör", "Daha az gör"]

# Corporate-reply markers: when present, only paragraph text is kept.
CORPORATE_MARKERS = ["Değerli Müşterimiz", "Vodafone Memnuniyet Merkezi"]

# Page marks the crawl looks for (fixed values).
PARAGRAPH_CLASS = "wrap-anywhere"
SHARE_CLASS = "selection-share"
DATE_ATTRIBUTE = "data-base-ui-click-trigger"
DATE_CLASS = "text-zinc-500"

# Crawl targets: company -> listing URL, and the category crawl.
CRAWL_TARGETS = [
    ("VODAFONE", "https://www.sikayetvar.com/vodafone"),
    ("TURKTELEKOM", "https://www.sikayetvar.com/turk-telekom"),
    ("TURKCELL", "https://www.sikayetvar.com/turkcell"),
]
CATEGORY_TARGETS = [
    ("VODAFONE", "tarife-degisikligi", "https://www.sikayetvar.com/vodafone/tarife-degisikligi"),
    ("TURKCELL", "tarife-degisikligi", "https://www.sikayetvar.com/turkcell/tarife-degisikligi"),
    ("TURKTELEKOM", "tarife-degisikligi", "https://www.sikayetvar.com/turk-telekom/tarife-degisikligi"),
]
CRAWL_DOMAIN = "sikayetvar.com"
BAD_LINK_SUFFIX = "-video"

# Content gates of page extraction: a candidate needs > 40 characters; a
# result under 35 characters is rejected; error texts start with "Hata:".
GOOD_TEXT_CHARS = 40
REJECT_TEXT_CHARS = 35
ERROR_PREFIX = "Hata:"

# ---------------------------------------------------------------------------
# Test profile for the synthetic multilingual corpus (no Turkish text).
# Chosen so that every sentiment and churn branch is reached.
# ---------------------------------------------------------------------------
FIXTURE_NEGATIVE = ["for", "avec", "nicht", "that", "mentoi", "für", "sch", "tionel"]
FIXTURE_POSITIVE = ["shand", "une", "mit", "est", "queai", "ndand"]
FIXTURE_REQUEST = ["dans", "with", "ist"]
FIXTURE_STREAM_STOP = ["the", "of", "de", "la"]
FIXTURE_ANALYSIS_STOP = [
    "the", "of", "and", "to", "a", "in", "is", "de", "la", "le", "et", "les", "des",
    "der", "die", "und", "das", "el", "en", "y", "que", "los",
]
FIXTURE_CRITICAL_RULE = ["attion", "erble", "onnt", "queai"]
FIXTURE_CRITICAL_MODEL = ["attion", "erble", "onnt", "queai", "tionel"]
FIXTURE_MEDIUM = ["ellement", "ierai", "ououen"]


@dataclass(frozen=True)
class Lexicon:
    negative: list[str] = field(default_factory=lambda: list(NEGATIVE_WORDS))
    positive: list[str] = field(default_factory=lambda: list(POSITIVE_WORDS))
    request: list[str] = field(default_factory=lambda: list(REQUEST_MARKERS))
    stream_stop: list[str] = field(default_factory=lambda: list(STREAM_STOP_WORDS))
    analysis_stop: list[str] = field(default_factory=lambda: list(ANALYSIS_STOP_WORDS))
    churn_critical_model: list[str] = field(default_factory=lambda: list(CHURN_CRITICAL_MODEL))
    churn_medium: list[str] = field(default_factory=lambda: list(CHURN_MEDIUM))
    churn_critical_rule: list[str] = field(default_factory=lambda: list(CHURN_CRITICAL_RULE))

    def with_(self, **kw) -> "Lexicon":
        return replace(self, **kw)

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False, indent=1)

    @staticmethod
    def from_json(text: str) -> "Lexicon":
        return Lexicon(**json.loads(text))

    @staticmethod
    def load(path: str | Path) -> "Lexicon":
        return Lexicon.from_json(Path(path).read_text(encoding="utf-8"))


REFERENCE = Lexicon()

FIXTURE = Lexicon(
    negative=list(FIXTURE_NEGATIVE),
    positive=list(FIXTURE_POSITIVE),
    request=list(FIXTURE_REQUEST),
    stream_stop=list(FIXTURE_STREAM_STOP),
    analysis_stop=list(FIXTURE_ANALYSIS_STOP),
    churn_critical_model=list(FIXTURE_CRITICAL_MODEL),
    churn_medium=list(FIXTURE_MEDIUM),
    churn_critical_rule=list(FIXTURE_CRITICAL_RULE),
)

PROFILES = {"reference": REFERENCE, "fixture": FIXTURE}


def profile(name_or_lexicon: "str | Lexicon") -> Lexicon:
    if isinstance(name_or_lexicon, Lexicon):
        return name_or_lexicon
    return PROFILES[name_or_lexicon]
