"""Cleaning (M1), sentiment (M2), hits (J4) and weights (J2) on hand-made rows."""

from pyspark.sql import functions as F

from gripe import lexicons as L
from gripe.functions import sentiment as S
from gripe.functions import text as TX

TURKISH_STOP = L.REFERENCE.stream_stop


def _clean(spark, texts, stop=TURKISH_STOP, turkish=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", TX.clean_text("t", stop, turkish).alias("c")).orderBy("i")
    return [r.c for r in out.collect()]


def test_cleaning_hand_rows(spark):
    texts = [None, "", "  baş boş  ", "bir ve de", "Fatura, 2024!  iptal-et", "İptal IŞIK"]
    assert _clean(spark, texts) == [None, "", " baş boş ", "", "fatura iptal et", "i ptal işik"]


def test_turkish_case_mode(spark):
    assert _clean(spark, ["İptal IŞIK"], turkish=True) == ["iptal ışık"]


def test_letter_tokens_equal_replace_squeeze_split(spark):
    texts = ["123", "a", "1", "x y\t\nz ", " ", "ÇAĞ ışık!", "ab--cd", " abc ", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    ref = TX.split_tokens(TX.squeeze_ws(TX.strip_nonletters(F.lower("t"))))
    got = df.select((TX.letter_tokens(F.lower("t")) == ref).alias("eq"), ref.isNull().alias("n")).collect()
    assert all(r.eq or r.n for r in got)


def test_cleaning_is_idempotent(spark):
    texts = ["  baş boş  ", "Fatura, 2024!  iptal-et", "bir ve de", "x"]
    once = _clean(spark, texts)
    assert _clean(spark, once) == once


def test_stop_word_removal_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(["b", "The", "a", "b", "the"],)], "t array<string>")
    out = df.select(TX.remove_stop("t", ["the"]).alias("x")).first().x
    assert out == ["b", "a", "b"]


def test_stop_word_removal_null_array(spark):
    df = spark.createDataFrame([(None,)], "t array<string>")
    assert df.select(TX.remove_stop("t", ["the"]).alias("x")).first().x is None


SENTIMENT_ROWS = [
    (None, "NOTR"), ("", "NOTR"),
    ("fatura iptal", "NEGATIF"),
    ("fatura istiyorum", "NOTR (TALEP)"),
    ("fatura iptal istiyorum", "NEGATIF"),
    ("harika güzel", "POZITIF"),
    ("fatura harika", "NOTR"),
    ("zaman", "NOTR (TALEP)"),
    ("zamir", "NEGATIF"),
    ("arama", "NOTR (TALEP)"),
    ("fatura fatura", "NEGATIF"),
]


def test_sentiment_branches(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SENTIMENT_ROWS)], "i int, t string")
    a = [r.s for r in df.select("i", S.sentiment("t").alias("s")).orderBy("i").collect()]
    b = [r.sentiment for r in S.with_sentiment(df, "t").orderBy("i").collect()]
    expected = [e for _, e in SENTIMENT_ROWS]
    assert a == expected
    assert b == expected


def test_count_hits_presence_not_occurrence(spark):
    df = spark.createDataFrame([("iptal iptal cayma",), (None,)], "t string")
    got = [r.n for r in df.select(S.count_hits("t", ["iptal", "cayma", "kapatma"]).alias("n")).collect()]
    assert got == [2, 0]


def test_sentiment_weight_default(spark):
    df = spark.createDataFrame([("NEGATIF",), ("NOTR (TALEP)",), ("NOTR",), ("POZITIF",), ("x",), (None,)],
                               "s string")
    got = [r.w for r in df.select(S.sentiment_weight("s").alias("w")).collect()]
    assert got == [3, 2, 1, 0, 1, 1]


def test_word_tokens_unicode(spark):
    df = spark.createDataFrame([("Şıkı a bc_d 12 ç",)], "t string")
    assert df.select(TX.word_tokens("t").alias("w")).first().w == ["şıkı", "bc_d", "12"]


def test_bigrams_guard(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r.b for r in df.select(TX.bigrams("t").alias("b")).collect()]
    assert got == [["a b", "b c"], [], []]


def test_whitespace_words_and_keep_words(spark):
    df = spark.createDataFrame([("  ab\tcde  bir üçüncü \n",)], "t string")
    r = df.select(TX.whitespace_words("t").alias("w"), TX.keep_words(TX.whitespace_words("t"), ["bir"]).alias("k")).first()
    assert r.w == ["ab", "cde", "bir", "üçüncü"]
    assert r.k == ["cde", "üçüncü"]
