"""Numeric scores, flags, bins and formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lexicons as L


def _col(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def rule_risk(crit_hits: "Column | str", weight: "Column | str") -> Column:
    """clip(30·crit + 20·weight, 0, 100)."""
    raw = _col(crit_hits) * 30 + _col(weight) * 20
    return F.least(F.greatest(raw, F.lit(0)), F.lit(100))


def risk_bin(score: "Column | str", edges: Sequence[float] = L.RISK_BIN_EDGES,
             labels: Sequence[str] = L.RISK_LABELS) -> Column:
    """Right-closed bins (e0, e1], (e1, e2], ... → label; outside → null (F16)."""
    s = _col(score)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (s > lo) & (s <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def churn_label(crit_hits: "Column | str", weight: "Column | str") -> Column:
    """1 when crit ≥ 1 and weight ≥ 2, else 0 (P5)."""
    return F.when((_col(crit_hits) >= 1) & (_col(weight) >= 2), F.lit(1)).otherwise(F.lit(0))


def topic_flags(topic: "Column | str") -> tuple[Column, Column]:
    """(topic == 2, topic == 3) as 0/1."""
    t = _col(topic)
    return (F.coalesce((t == 2).cast("int"), F.lit(0)), F.coalesce((t == 3).cast("int"), F.lit(0)))


def dominant_topic(dist: "Column | str") -> Column:
    """1-based argmax of a probability array, first on ties."""
    d = _col(dist)
    return F.array_position(d, F.array_max(d)).cast("int")


def round2(c: "Column | str", digits: int = 2) -> Column:
    """Half-even rounding for display."""
    return F.bround(_col(c), digits)


def fmt_pct(c: "Column | str", digits: int = 2) -> Column:
    """'12.34%' text."""
    return F.concat(F.format_number(_col(c), digits), F.lit("%"))


def fmt_int(c: "Column | str") -> Column:
    """Thousands separator, no decimals."""
    return F.format_number(_col(c), 0)
