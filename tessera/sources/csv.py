"""CSV sources with readr-like behaviour, and a staging helper for derived CSV files."""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tessera.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint directory, which is shared except on a local master."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-{name}-{uuid.uuid4().hex[:12]}"


def stage_csv(df: DataFrame, name: str, pad: bool = False) -> str:
    """Write ``df`` as headed CSV files in the shared folder; return the folder path.

    ``pad`` adds surrounding spaces to every field, as hand-typed CSV text has.
    """
    out = df
    if pad:
        out = df.select(*[F.concat(F.lit(" "), F.col(c).cast("string")).alias(c) for c in df.columns])
    path = scratch_path(df.sparkSession, name)
    out.write.option("header", True).csv(path)
    return path


#: text that is a missing value unless the caller says otherwise
MISSING = ("", "NA")
#: the types that a column may have, the narrowest first; one that nothing else fits is text
LATTICE = (T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType())


def _text(spark: SparkSession, path: str, na: Sequence[str]) -> DataFrame:
    """All columns as text, surrounding spaces trimmed, missing tokens as NA."""
    text = (spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .option("emptyValue", "").option("nullValue", "\0").csv(path))
    return text.select(*[F.when(~F.col(c).isin(list(na)), F.col(c)).alias(c) if na else F.col(c) for c in text.columns])


def read_csv(spark: SparkSession, path: str, na: Sequence[str] | str = MISSING, schema: T.StructType | str | None = None,
             levels: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """``read_csv``: header row, type inference, surrounding spaces trimmed.

    ``na`` lists the text read as NA in every column.  Without ``schema`` one pass over all rows finds the narrowest type that
    every value of a column has; a column without values is boolean.  With it the types are fixed up front, as a production job
    should; text that is not of its type is NA and is listed by :func:`csv_problems`.  ``levels`` restricts text columns to
    given values in the same way.
    """
    na = [na] if isinstance(na, str) else list(na)
    text = _text(spark, path, na)
    if schema is None:
        schema = T.StructType([T.StructField(c, k) for c, k in _kinds(text).items()])
    fields = schema.fields if isinstance(schema, T.StructType) else T._parse_datatype_string(schema).fields
    return text.select(*[_typed(c, f, levels).alias(f.name) for c, f in zip(text.columns, fields)])


def _typed(column: str, f: T.StructField, levels: dict[str, Sequence[str]] | None) -> Column:
    if levels and f.name in levels:
        return F.when(F.col(column).isin(list(levels[f.name])), F.col(column))
    return F.col(column).try_cast(f.dataType)


def _kinds(text: DataFrame) -> dict[str, T.DataType]:
    """The narrowest type that all values of each text column have, found in one pass."""
    def fits(c: str, k: T.DataType) -> Column:
        ok = F.col(c).try_cast(k).isNotNull()
        return ok & F.col(c).rlike(r"^\d+-\d+-\d+$") if isinstance(k, T.DateType) else ok  # a cast to a date would drop a time of day

    aggs = [F.count_if(F.col(c).isNotNull() & ~fits(c, k)).alias(f"{i}_{j}") for i, c in enumerate(text.columns) for j, k in enumerate(LATTICE)]
    row = text.agg(*aggs, *[F.count(c).alias(f"{i}_n") for i, c in enumerate(text.columns)]).first()
    return {c: T.BooleanType() if not row[f"{i}_n"] else next((k for j, k in enumerate(LATTICE) if row[f"{i}_{j}"] == 0), T.StringType())
            for i, c in enumerate(text.columns)}


def csv_problems(spark: SparkSession, path: str, schema: T.StructType | str, na: Sequence[str] | str = MISSING,
                 levels: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """``problems``: one row for every field that is neither missing nor of its type: ``file, row, col, expected, actual``.

    ``row`` is the number of the data row in its file.  Rows are numbered inside the stretches of a file that Spark reads
    at once; a small table of these stretches gives what lies before each.
    """
    na = [na] if isinstance(na, str) else list(na)
    fields = (schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)).fields
    raw = (spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
           .option("emptyValue", "").option("nullValue", "\0").csv(path))
    cols = raw.columns
    at = raw.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)], F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    blocks = at.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    begins = blocks.select(F.col("file").alias("_f"), F.col("block").alias("_b"), "first", before.alias("before"))
    bad = []
    for i, (name, f) in enumerate(zip(cols, fields)):
        text, typed = F.col(f"c{i}"), _typed(f"c{i}", T.StructField(name, f.dataType), {name: levels[f.name]} if levels and f.name in levels else None)
        given = text.isNotNull() & ~text.isin(na) if na else text.isNotNull()
        expected = "value in level set" if levels and f.name in levels else f.dataType.simpleString()
        bad.append(F.when(given & typed.isNull(), F.struct(F.lit(f.name).alias("col"), F.lit(expected).alias("expected"), text.alias("actual"))))
    found = at.select("file", "block", "id", F.explode(F.array_compact(F.array(*bad))).alias("p"))
    return (found.join(begins, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
            .select("file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("row"), "p.col", "p.expected", "p.actual"))
