"""Lexicon sentiment and lexicon containment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lexicons as L


def _col(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_hits(text: "Column | str", phrases: Sequence[str]) -> Column:
    """Number of list entries occurring as a substring (presence, not occurrences).

    Null text gives 0.  Entries are counted as listed (a repeated entry counts twice).
    """
    t = F.coalesce(_col(text), F.lit(""))
    if not phrases:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [t.contains(p).cast("int") for p in phrases])


def any_hit(text: "Column | str", phrases: Sequence[str]) -> Column:
    t = F.coalesce(_col(text), F.lit(""))
    if not phrases:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [t.contains(p) for p in phrases])


def lexicon_score(text: "Column | str", negative: Sequence[str], positive: Sequence[str], step: int = 2) -> Column:
    """Signed score: +step per positive entry present, -step per negative entry."""
    m = F.lower(_col(text))
    return F.lit(step) * (count_hits(m, positive) - count_hits(m, negative))


def sentiment_label(text: "Column | str", score: "Column | str", req: "Column | str") -> Column:
    """The label from a precomputed score and request flag (M2)."""
    t, score, req = _col(text), _col(score), _col(req)
    return (F.when(t.isNull() | (t == ""), F.lit(L.NEUTRAL))
            .when(req & (score > -4) & (score < 4), F.lit(L.REQUEST))
            .when(score <= -2, F.lit(L.NEGATIVE))
            .when(score >= 2, F.lit(L.POSITIVE))
            .otherwise(F.lit(L.NEUTRAL)))


def with_sentiment(df, text: str = "cleaned", lexicon: L.Lexicon = L.REFERENCE, out: str = "sentiment",
                   lowered: bool = False):
    """Adds the sentiment label, scoring each text once (M2).

    Score and request flag are projected first and the label reads them,
    so no lexicon scan is repeated per CASE branch.
    """
    m = _col(text) if lowered else F.lower(_col(text))
    scored = df.select("*", lexicon_score(m, lexicon.negative, lexicon.positive).alias("_score"),
                       any_hit(m, lexicon.request).alias("_req"))
    return scored.withColumn(out, sentiment_label(text, "_score", "_req")).drop("_score", "_req")


def sentiment(text: "Column | str", lexicon: L.Lexicon = L.REFERENCE) -> Column:
    """Lexicon sentiment label of already cleaned text (M2), as one column.

    null or empty → NOTR; a request marker with -4 < score < 4 → NOTR (TALEP);
    score <= -2 → NEGATIF; score >= 2 → POZITIF; else NOTR.
    """
    t = _col(text)
    m = F.lower(t)
    score = lexicon_score(m, lexicon.negative, lexicon.positive)
    req = any_hit(m, lexicon.request)
    return sentiment_label(t, score, req)


def map_default(c: "Column | str", mapping: Mapping, default=None) -> Column:
    """Dictionary lookup with a default for missing keys."""
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, _col(c))
    # a missing or null key gives null, so the default applies to both
    return v if default is None else F.coalesce(v, F.lit(default))


def sentiment_weight(c: "Column | str") -> Column:
    """NEGATIF 3, NOTR (TALEP) 2, NOTR 1, POZITIF 0; anything else 1."""
    return map_default(c, L.SENTIMENT_WEIGHT, L.SENTIMENT_WEIGHT_DEFAULT)
