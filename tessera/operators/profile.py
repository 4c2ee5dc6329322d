"""Table profiles: glimpse, skim and summary as DataFrames.

Per-column statistics come from one aggregate over the table as it is, a few
expressions a column; only exact quantiles, which share one selection, and
counts of distinct values take the table unpivoted (column name as a key).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tessera.operators.sorting import top_k_per_group
from tessera.operators.verbs import NUMERIC
from tessera.plans.ordered import exact_quantiles


def glimpse(df: DataFrame, n_values: int = 5) -> DataFrame:
    """``glimpse``: one row per column with its type, the row count and the first values."""
    n = df.count()
    head = df.limit(n_values).collect()  # the preview is the feature: a bounded head
    rows = [(f.name, f.dataType.simpleString(), n, ", ".join("NA" if r[f.name] is None else str(r[f.name]) for r in head))
            for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, n_rows bigint, first_values string")


def _long(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    return df.select(*[F.col(c).cast(cast).alias(c) for c in cols]).unpivot([], list(cols), "skim_variable", "value")


def _wide(df: DataFrame, cols: Sequence[str], aggs) -> DataFrame:
    """One aggregate of the table as it is, ``aggs(column)`` for each column, laid out as a row a column."""
    cols = list(cols)
    if not cols:
        return df.limit(0).groupBy(F.lit("").alias("skim_variable")).agg(*aggs(F.lit(None)))
    one = df.agg(*[F.struct(F.lit(c).alias("skim_variable"), *aggs(F.col(c))).alias(f"_c{i}") for i, c in enumerate(cols)])
    return one.select(F.inline(F.array(*[f"_c{i}" for i in range(len(cols))])))


def _histogram(lo: Column, hi: Column, v: Column, bins: int) -> Column:
    width = (hi - lo) / bins
    at = F.when(width > 0, F.least(F.floor((v - lo) / width), F.lit(bins - 1))).otherwise(0)
    return F.concat_ws(",", *[F.count_if(at == k).cast("string") for k in range(bins)])


def skim_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``skim`` for numeric columns: missing, complete rate, mean, sd, p0 / p25 / p50 / p75 / p100."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    base = _wide(df, cols, lambda c: [
        F.count_if(c.isNull()).alias("n_missing"), (F.count(c) / F.count(F.lit(1))).alias("complete_rate"),
        F.avg(c.cast("double")).alias("mean"), F.stddev_samp(c.cast("double")).alias("sd")])
    q = exact_quantiles(_long(df, cols, "double"), "value", [0.0, 0.25, 0.5, 0.75, 1.0], by=["skim_variable"])
    q = q.select("skim_variable", *[F.col(f"q{i}").alias(n) for i, n in enumerate(["p0", "p25", "p50", "p75", "p100"])])
    return base.join(q, "skim_variable", "left").withColumn("skim_type", F.lit("numeric"))


def skim_character(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``skim`` for text columns: missing, complete rate, min / max length, empty, unique, whitespace."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lengths = _wide(df, cols, lambda c: [
        F.count_if(c.isNull()).alias("n_missing"), (F.count(c) / F.count(F.lit(1))).alias("complete_rate"),
        F.min(F.length(c)).cast("bigint").alias("min_len"), F.max(F.length(c)).cast("bigint").alias("max_len"),
        F.count_if(c == "").alias("empty"), F.count_if(c.rlike(r"^\s+$")).alias("whitespace")])
    # distinct values by two aggregates of one key, so that no task holds a column
    unique = (_long(df, cols, "string").where("value is not null").groupBy("skim_variable", "value").agg(F.lit(1).alias("one"))
              .groupBy("skim_variable").agg(F.count("one").alias("n_unique")))
    out = lengths.join(unique, "skim_variable", "left").withColumn("n_unique", F.coalesce("n_unique", F.lit(0)))
    return out.withColumn("skim_type", F.lit("character"))


def skim_histogram(df: DataFrame, cols: Sequence[str] | None = None, bins: int = 5) -> DataFrame:
    """The small histogram of ``skim``: counts in ``bins`` equal bins of each numeric column, joined by commas."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    if not cols:
        return _wide(df, [], lambda c: [F.lit("").alias("hist")])
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    ends = df.agg(*[F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias(c) for c, v in known.items()]).first()
    one = df.agg(*[F.struct(F.lit(c).alias("skim_variable"), _histogram(F.lit(ends[c]["lo"]).cast("double"), F.lit(ends[c]["hi"]).cast("double"), v, bins)
                            .alias("hist"), F.count(v).alias("_n")).alias(f"_c{i}") for i, (c, v) in enumerate(known.items())])
    return one.select(F.inline(F.array(*[f"_c{i}" for i in range(len(cols))]))).where("_n > 0").drop("_n")


def skim_top_counts(df: DataFrame, cols: Sequence[str] | None = None, top: int = 4) -> DataFrame:
    """The most frequent values of each text column, ``value: n`` joined by commas (a top-k report)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts = _long(df, cols, "string").where("value is not null").groupBy("skim_variable", "value").agg(F.count(F.lit(1)).alias("n"))
    first = top_k_per_group(counts, top, ["skim_variable"], [F.desc("n"), F.asc("value")])
    shown = F.transform(F.array_sort(F.collect_list(F.struct("_rn", F.concat("value", F.lit(": "), F.col("n").cast("string")).alias("s")))),
                        lambda x: x["s"])
    return first.groupBy("skim_variable").agg(F.concat_ws(", ", shown).alias("top_counts"))


def skim_date(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``skim`` for date columns: missing, complete rate, min, max, median, unique."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    long = _long(df, cols, "date") if cols else df.select(F.lit("").alias("skim_variable"), F.lit(None).cast("date").alias("value")).limit(0)
    base = long.groupBy("skim_variable").agg(
        F.count_if(F.col("value").isNull()).alias("n_missing"), (F.count("value") / F.count(F.lit(1))).alias("complete_rate"),
        F.min("value").cast("string").alias("date_min"), F.max("value").cast("string").alias("date_max"),
        F.count_distinct("value").alias("n_unique"))
    days = long.select("skim_variable", F.unix_date("value").alias("value"))
    q = exact_quantiles(days, "value", [0.5], by=["skim_variable"]).select(
        "skim_variable", F.date_from_unix_date(F.floor("q0").cast("int")).cast("string").alias("date_median"))
    return base.join(q, "skim_variable", "left").withColumn("skim_type", F.lit("Date"))


def skim(df: DataFrame) -> DataFrame:
    """``skim``: numeric, character and date summaries in one long table (NA where a statistic does not apply)."""
    numeric = skim_numeric(df).join(skim_histogram(df), "skim_variable", "left")
    text = skim_character(df).join(skim_top_counts(df), "skim_variable", "left")
    return numeric.unionByName(text, allowMissingColumns=True).unionByName(skim_date(df), allowMissingColumns=True)


def summary_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``summary()``: min, Q1, median, mean, Q3, max per column (exact quartiles)."""
    base = _wide(df, cols, lambda c: [F.min(c.cast("double")).alias("min"), F.avg(c.cast("double")).alias("mean"), F.max(c.cast("double")).alias("max")])
    q = exact_quantiles(_long(df, cols, "double"), "value", [0.25, 0.5, 0.75], by=["skim_variable"])
    out = base.join(q, "skim_variable", "left")
    return out.select(F.col("skim_variable").alias("variable"), "min", F.col("q0").alias("q1"),
                      F.col("q1").alias("median"), "mean", F.col("q2").alias("q3"), "max")
