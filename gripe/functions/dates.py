"""Date text helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lexicons as L

# ``%d %B %H:%M`` of the crawler, in Spark's pattern letters (English month names).
CRAWL_DATE_FORMAT = "dd MMMM HH:mm"


def _col(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_or_now(c: "Column | str", now: "Column | str | None" = None, missing: str = "Tarih Yok") -> Column:
    """The date text, or ``now`` formatted ``dd MMMM HH:mm`` when it is null,
    the ``missing`` marker, or has no digit (F10)."""
    d = _col(c)
    ts = F.current_timestamp() if now is None else _col(now)
    bad = d.isNull() | (F.trim(d) == missing) | ~d.rlike(r"\d")
    return F.when(bad, F.date_format(ts, CRAWL_DATE_FORMAT)).otherwise(d)


def month_to_tr(c: "Column | str", months: Sequence[tuple[str, str]] = L.MONTHS_EN_TR) -> Column:
    """English month names → Turkish, whole words only.

    Word bounds keep an already Turkish ``Mayıs`` unchanged (plain string
    replacement would give ``Mayısıs``).
    """
    out = _col(c)
    for en, tr in months:
        out = F.regexp_replace(out, rf"\b{en}\b", tr)
    return out
