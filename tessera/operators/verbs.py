"""Projection, mutation and row filters with the reference's semantics."""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tessera.functions.logic import is_na

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(f: T.StructField) -> bool:
    return isinstance(f.dataType, NUMERIC)


def is_character(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.StringType)


def select_range(df: DataFrame, first: str, last: str, negate: bool = False) -> DataFrame:
    """``select(first:last)`` / ``select(-(first:last))`` by column position."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    span = cols[min(i, j): max(i, j) + 1]
    return df.drop(*span) if negate else df.select(*span)


def select_where(df: DataFrame, pred: Callable[[T.StructField], bool]) -> DataFrame:
    """``select(where(pred))``: pick columns by a predicate on their schema field."""
    return df.select(*[f.name for f in df.schema.fields if pred(f)])


def columns_with_na(df: DataFrame) -> list[str]:
    """Names of columns holding at least one NA: one pass, one small row to the driver."""
    fields = df.schema.fields
    row = df.agg(*[F.max(is_na(f.name, f.dataType).cast("int")).alias(f.name) for f in fields]).first()
    return [f.name for f in fields if row[f.name] == 1]


def select_where_any_na(df: DataFrame) -> DataFrame:
    """``select(where(~ any(is.na(.))))``: a data-dependent projection."""
    return df.select(*columns_with_na(df))


def relocate_front(df: DataFrame, *first: str) -> DataFrame:
    """``select(a, everything())``."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def mutate(df: DataFrame, **exprs: Column) -> DataFrame:
    """``mutate(a = ..., b = f(a))``: later expressions see earlier ones; same name overwrites.

    Applied one by one (``withColumn``) because a single ``withColumns`` lets an
    existing column of the same name win over the new value.  Catalyst collapses
    the chain into one projection.
    """
    for name, e in exprs.items():
        df = df.withColumn(name, e)
    return df


def mutate_keep_used(df: DataFrame, used: Sequence[str], **exprs: Column) -> DataFrame:
    """``mutate(..., .keep = "used")``: keep only the inputs used and the outputs."""
    out = mutate(df, **exprs)
    keep = list(dict.fromkeys([c for c in used if c not in exprs] + list(exprs)))
    return out.select(*keep)


def across(df: DataFrame, pred: Callable[[T.StructField], bool], fn: Callable[[Column], Column]) -> DataFrame:
    """``mutate(across(where(pred), fn))``: apply ``fn`` to every matching column in place."""
    return df.select(*[fn(F.col(f.name)).alias(f.name) if pred(f) else F.col(f.name)
                       for f in df.schema.fields])


def filter_all(df: DataFrame, *conds: Column) -> DataFrame:
    """``filter(a, b)``: comma means AND; an NA predicate drops the row."""
    return df.filter(reduce(lambda a, b: a & b, conds))


def filter_if_any_na(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """``filter(if_any(everything(), is.na))``."""
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    return df.filter(reduce(lambda a, b: a | b, [is_na(f.name, f.dataType) for f in fields]))


def na_omit(df: DataFrame) -> DataFrame:
    """``na.omit``: drop rows with any NA (NaN counts as NA)."""
    fields = df.schema.fields
    keep = reduce(lambda a, b: a & b, [~is_na(f.name, f.dataType) for f in fields])
    return df.filter(keep)


def replace_outside(col: str, lo: float, hi: float) -> Column:
    """``if_else(y < lo | y > hi, NA, y)``: out of range -> NA (row kept)."""
    c = F.col(col)
    return F.when((c < lo) | (c > hi), F.lit(None)).otherwise(c)
