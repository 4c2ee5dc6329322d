"""Numeric scalar functions (floor division, modulo, rounding, binning).

All return Column expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, functions as F

Col = Column | str


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def intdiv(a: Col, b) -> Column:
    """``a %/% b``: floor division (Spark ``div`` truncates). Division by 0 -> NULL."""
    return F.floor(F.try_divide(_c(a), _c(b)))


def r_mod(a: Col, b) -> Column:
    """``a %% b``: the result takes the divisor's sign; NULL for a zero divisor.

    Spark's ``%`` takes the dividend's sign and ``pmod`` is only right for a
    positive divisor, so the remainder is shifted by ``b`` when the signs differ.
    """
    a, b = _c(a), _c(b)
    r = F.try_mod(a, b)
    return F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)


def hhmm_hours(t: Col) -> Column:
    """Packed clock ``HHMM`` -> fractional hours."""
    t = _c(t)
    return F.floor(t / 100) + F.pmod(t, F.lit(100)) / 60


def hhmm_minutes(t: Col) -> Column:
    """Packed clock ``HHMM`` -> minutes after midnight."""
    t = _c(t)
    return F.floor(t / 100) * 60 + F.pmod(t, F.lit(100))


def round_even(x: Col, digits: int = 0) -> Column:
    """R ``round``: half to even (``F.round`` is half up)."""
    return F.bround(_c(x), digits)


def round_multiple(x: Col, m: float) -> Column:
    """Round to the nearest multiple of ``m`` (half to even)."""
    return F.bround(_c(x) / m, 0) * m


def floor_to(x: Col, step: float) -> Column:
    """Floor to a multiple of ``step``."""
    return F.floor(_c(x) / step) * step


def r_log(x: Col, base: float | None = None) -> Column:
    """Logarithm with R's edge cases: log(0) = -Inf, log(<0) = NaN (Spark gives NULL)."""
    x = _c(x)
    val = F.ln(x) if base is None else (F.log10(x) if base == 10 else F.log(float(base), x))
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when(x == 0, F.lit(float("-inf")))
            .when(x < 0, F.lit(float("nan")))
            .otherwise(val))


def recycle(pos: Col, weights: Sequence[float]) -> Column:
    """Value of a short vector recycled along 1-based row positions ``pos``."""
    arr = F.array(*[F.lit(float(w)) for w in weights])
    return F.element_at(arr, (F.pmod(_c(pos) - 1, F.lit(len(weights))) + 1).cast("int"))


def cut_breaks(x: Col, breaks: Sequence[float], labels: Sequence[str] | None = None,
               right: bool = True, include_lowest: bool = False) -> Column:
    """R ``cut``: right-closed ``(a, b]`` bins; outside or NA -> NULL."""
    x = _c(x)
    if labels is None:
        labels = [f"({breaks[i]:g},{breaks[i + 1]:g}]" if right else f"[{breaks[i]:g},{breaks[i + 1]:g})"
                  for i in range(len(breaks) - 1)]
    expr = None
    for i in range(len(breaks) - 1):
        lo, hi = breaks[i], breaks[i + 1]
        if right:
            cond = (x > lo) & (x <= hi)
            if include_lowest and i == 0:
                cond = (x >= lo) & (x <= hi)
        else:
            cond = (x >= lo) & (x < hi)
            if include_lowest and i == len(breaks) - 2:
                cond = (x >= lo) & (x <= hi)
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr


def cut_width_bin(x: Col, width: float, boundary: float | None = None, lowest: Col | None = None) -> Column:
    """Bin centre of ``cut_width(x, width, boundary)``: right-closed bins of equal width.

    Bins are ``(boundary + (k-1) w, boundary + k w]``; the default boundary is
    ``w / 2`` so bins are centred on multiples of ``w``.  ``lowest`` is the smallest
    value of the data: the bin it opens is closed on the left too, so a value on
    that edge does not fall into a bin below the first.
    """
    b = width / 2 if boundary is None else boundary
    k = F.ceil((_c(x) - b) / width)
    if lowest is not None:
        k = F.greatest(k, F.floor((_c(lowest) - b) / width) + 1)
    return b + (k - 0.5) * width
