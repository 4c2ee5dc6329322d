"""Logical, missing-value and conditional functions with R semantics."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

Col = Column | str


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def r_in(x: Col, values: Iterable) -> Column:
    """``x %in% values``: never NA; NA matches NA only if NA is in ``values``."""
    vals = list(values)
    has_na = any(v is None for v in vals)
    vals = [v for v in vals if v is not None]
    x = _c(x)
    hit = F.coalesce(x.isin(vals), F.lit(False)) if vals else F.lit(False)
    return (hit | x.isNull()) if has_na else hit


def is_na(x: Col, dtype: T.DataType | None = None) -> Column:
    """``is.na``: TRUE for NULL and, on floating columns, for NaN."""
    x = _c(x)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def xor(a: Col, b: Col) -> Column:
    return _c(a) != _c(b)


def near(a: Col, b: Col, tol: float = 1.5e-8) -> Column:
    """``dplyr::near``: |a - b| < tol."""
    return F.abs(_c(a) - _c(b)) < tol


def _v(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def if_else(cond: Col, yes, no, missing=None) -> Column:
    """``if_else(cond, yes, no, missing)``: an NA condition gives ``missing`` (NULL by default).

    Plain ``when/otherwise`` would send an NA condition to ``otherwise``.
    ``yes``/``no``/``missing`` are values; pass ``F.col`` for columns.
    """
    cond = _c(cond)
    return F.when(cond.isNull(), _v(missing)).when(cond, _v(yes)).otherwise(_v(no))


def case_when(*arms: tuple, default=None) -> Column:
    """``case_when(c1 ~ v1, ...)``: first match wins; no match -> ``default`` (NULL)."""
    expr = None
    for cond, val in arms:
        expr = F.when(_c(cond), _c(val)) if expr is None else expr.when(_c(cond), _c(val))
    return expr.otherwise(_c(default)) if default is not None else expr


def check_branch_types(df: DataFrame, *branches: Column) -> None:
    """Raise if the branches of a conditional have incompatible types (R's if_else/case_when).

    Spark would silently cast a string/int pair and fail only when the bad
    branch runs; R rejects the expression up front.  Analysis only: no job runs.
    """
    types = [f.dataType for f in df.select(*[b.alias(f"_b{i}") for i, b in enumerate(branches)]).schema]
    kinds = set()
    for t in types:
        if isinstance(t, T.NullType):
            continue
        if isinstance(t, T.NumericType):
            kinds.add("numeric")
        else:
            kinds.add(t.typeName())
    if len(kinds) > 1:
        raise TypeError(f"conditional branches must share a type, got {sorted(kinds)}")


def all_na_rm(cond: Col) -> Column:
    """``all(cond, na.rm = TRUE)`` aggregate: TRUE over an empty set."""
    return F.coalesce(F.bool_and(_c(cond)), F.lit(True))


def any_na_rm(cond: Col) -> Column:
    """``any(cond, na.rm = TRUE)`` aggregate: FALSE over an empty set."""
    return F.coalesce(F.bool_or(_c(cond)), F.lit(False))


def mean_strict(x: Col) -> Column:
    """``mean(x)`` without ``na.rm``: any NA in the group poisons the mean."""
    x = _c(x)
    return F.when(F.count(F.lit(1)) == F.count(x), F.avg(x))


def sum_strict(x: Col) -> Column:
    """``sum(x)`` without ``na.rm``: NA if any NA; 0 on an empty group."""
    x = _c(x)
    return F.when(F.count(F.lit(1)) == F.count(x), F.coalesce(F.sum(x), F.lit(0)))


def sum_na_rm(x: Col) -> Column:
    """``sum(x, na.rm = TRUE)``: 0 on an empty group (Spark gives NULL)."""
    return F.coalesce(F.sum(_c(x)), F.lit(0))


def flags_any_null(cols: Sequence[str]) -> Column:
    """Row has any NA (``if_any(everything(), is.na)``)."""
    expr = F.lit(False)
    for c in cols:
        expr = expr | F.col(c).isNull()
    return expr


def r_divide(a: Col, b: Col) -> Column:
    """``a / b`` with IEEE results as in R: x/0 = +-Inf, 0/0 = NaN (Spark's ANSI mode raises)."""
    a, b = _c(a), _c(b)
    return (F.when(b == 0, F.when((a == 0) | F.isnan(a), F.lit(float("nan")))
                   .when(a > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
            .otherwise(a / b))
