"""Text column expressions (Column -> Column, all JVM-side, no UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's ``\s``: blank, tab, newline, vertical tab, form feed, carriage return.
# Spelled out so the same class can be written in any regex dialect.
WS_CLASS = " \\t\\n\\x0B\\f\\r"
# Letters kept by the cleaner (everything else becomes a blank).
KEEP_LETTERS = "a-zğüşıöç"
# Word pattern of the term extractor: runs of two or more word characters.
WORD_PATTERN = r"[\p{L}\p{N}\p{M}_]{2,}"


def _col(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_case(c: "Column | str", turkish: bool = False) -> Column:
    """Lower-case (F1).  ``turkish=True`` maps ``İ→i`` and ``I→ı`` first."""
    c = _col(c)
    if turkish:
        c = F.translate(c, "İI", "iı")
    return F.lower(c)


def strip_nonletters(c: "Column | str") -> Column:
    """Everything but the kept letters and whitespace becomes a blank (F2)."""
    return F.regexp_replace(_col(c), f"[^{KEEP_LETTERS}{WS_CLASS}]", " ")


def squeeze_ws(c: "Column | str", trim: bool = False) -> Column:
    """A whitespace run becomes one blank (F3); optional trim."""
    out = F.regexp_replace(_col(c), f"[{WS_CLASS}]+", " ")
    return F.trim(out) if trim else out


def split_tokens(c: "Column | str", drop_empty: bool = False) -> Column:
    """Split on one blank (F4); the empty tokens from edge blanks stay unless dropped."""
    arr = F.split(_col(c), " ")
    return F.filter(arr, lambda x: x != "") if drop_empty else arr


def remove_stop(tokens: "Column | str", stop: Sequence[str], lowered: bool = False) -> Column:
    """Case-insensitive stop-word removal keeping order and repeats.

    ``lowered=True`` skips lower-casing tokens that are already lower case.
    A null array stays null (no failure on a malformed record).
    """
    stop_l = sorted({w.lower() for w in stop})
    if not stop_l:
        return _col(tokens)
    if lowered:
        return F.filter(_col(tokens), lambda x: ~x.isin(stop_l))
    return F.filter(_col(tokens), lambda x: ~F.lower(x).isin(stop_l))


def join_tokens(tokens: "Column | str") -> Column:
    """Join tokens with one blank."""
    return F.array_join(_col(tokens), " ")


def letter_tokens(lowered: "Column | str") -> Column:
    """F2 → F3 → F4 in one pass: the tokens of ``split(squeeze(strip(text)), ' ')``.

    After F2 and F3 every run of non-letters is one blank, so the tokens are
    the letter runs, plus an empty token in front when the text starts with
    a non-letter and one at the end when it ends with one ("123" → ['', ''];
    "" → ['']).  Extracting letter runs is several times faster in Java than
    replacing the negated class, which contains non-ASCII letters.
    """
    t = _col(lowered)
    runs = F.regexp_extract_all(t, F.lit(f"[{KEEP_LETTERS}]+"), 0)
    letter = f"^[{KEEP_LETTERS}]$"
    empty = F.array(F.lit(""))
    none = F.array().cast("array<string>")
    lead = F.when(~F.substring(t, 1, 1).rlike(letter), empty).otherwise(none)
    trail = F.when(~F.substring(t, -1, 1).rlike(letter), empty).otherwise(none)
    return F.when(t == "", empty).otherwise(F.concat(lead, runs, trail))


def clean_stages(content: "Column | str", stop: Sequence[str], turkish_case: bool = False) -> dict[str, Column]:
    """The cleaning pipeline M1 as named stages.

    ``words``: tokens before stop-word removal; ``filtered``: after;
    ``cleaned``: the filtered tokens joined again.
    """
    words = letter_tokens(fold_case(content, turkish_case))
    filtered = remove_stop(words, stop, lowered=True)
    return {"words": words, "filtered": filtered, "cleaned": join_tokens(filtered)}


def clean_text(content: "Column | str", stop: Sequence[str], turkish_case: bool = False) -> Column:
    """M1 as one column: lower → letters only → squeeze → split → stop words → join."""
    return clean_stages(content, stop, turkish_case)["cleaned"]


def word_tokens(c: "Column | str") -> Column:
    """Word tokens of two or more word characters, lower-cased."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD_PATTERN), 0)


def keep_words(tokens: "Column | str", stop: Sequence[str], min_len: int = 3) -> Column:
    """Tokens not in the stop list and at least ``min_len`` characters long."""
    stop_s = sorted(set(stop))
    return F.filter(_col(tokens), lambda x: (F.char_length(x) >= min_len) & ~x.isin(stop_s))


def bigrams(tokens: "Column | str") -> Column:
    """Adjacent token pairs joined by a blank (W6); empty for < 2 tokens.

    ``arrays_zip`` of the array with itself shifted by one, so the token
    array is built once per row (a lambda indexing the outer array would
    re-evaluate it per element).
    """
    t = _col(tokens)
    n = F.size(t)
    pairs = F.arrays_zip(F.slice(t, 1, n - 1).alias("a"), F.slice(t, 2, n - 1).alias("b"))
    return F.when(n >= 2, F.transform(pairs, lambda p: F.concat_ws(" ", p["a"], p["b"]))
                  ).otherwise(F.array().cast("array<string>"))


def whitespace_words(c: "Column | str") -> Column:
    """``str.split()`` with no argument: whitespace runs, no empty tokens."""
    return F.filter(F.split(_col(c), f"[{WS_CLASS}]+"), lambda x: x != "")


def replace_all(c: "Column | str", needles: Sequence[str], by: str = "") -> Column:
    """Literal replacement of each needle in order (F7 ``replace`` chain)."""
    out = _col(c)
    for n in needles:
        out = F.replace(out, F.lit(n), F.lit(by))
    return out
