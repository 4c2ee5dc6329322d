"""Feature recipes as Spark ML pipeline stages (fit on train, apply anywhere).

Each step is a ``pyspark.ml`` Estimator or Transformer whose transform is a
projection of built-in column expressions, so a fitted recipe compiles into
the scoring plan with no Python per row.  What a step learns on the training
data (level lists, zero-variance columns, means and sds) comes from one
aggregate whose result is small (one row, or one row per level).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.functions.dates import FEASTS, date_parts, with_holiday_flags
from tessera.operators.verbs import NUMERIC


def _one_pass(df: DataFrame, cols: Sequence[str], make) -> dict:
    """Aggregate all ``cols`` in one pass over the data: ``make(col)`` gives a column's aggregates."""
    aggs = [a for c in cols for a in make(c)]
    return df.agg(*aggs).first().asDict() if aggs else {}


class StepDate(Transformer):
    """``step_date(col, features)``: calendar parts as new columns."""

    def __init__(self, col: str, features: Sequence[str] = ("dow", "month", "year")):
        super().__init__()
        self.col, self.features = col, tuple(features)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select("*", *date_parts(self.col, self.features))


class StepHoliday(Transformer):
    """``step_holiday(col, holidays)``: one 0/1 column per holiday."""

    def __init__(self, col: str, holidays: Sequence[str] = FEASTS):
        super().__init__()
        self.col, self.holidays = col, tuple(holidays)

    def _transform(self, df: DataFrame) -> DataFrame:
        return with_holiday_flags(df, self.col, self.holidays)


class StepRm(Transformer):
    """``step_rm(cols)``."""

    def __init__(self, cols: Sequence[str]):
        super().__init__()
        self.cols = tuple(cols)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.cols)


def level_names(col: str, levels: Sequence[str]) -> dict[str, str]:
    """Column name of each level: letters and digits kept, anything else ``_``; names that clash get a number."""
    out, used = {}, set()
    for v in levels:
        base = name = col + "_" + "".join(ch if ch.isalnum() else "_" for ch in str(v))
        k = 2
        while name in used:
            name, k = f"{base}_{k}", k + 1
        used.add(name)
        out[v] = name
    return out


def nominal_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels of each column: distinct (column, level) pairs, found by Spark; they become model columns, so the driver holds them."""
    long = df.select(*cols).unpivot([], list(cols), "c", "level").where("level is not null").distinct()
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in long.orderBy("c", "level").toLocalIterator():
        out[r["c"]].append(r["level"])
    return out


class StepDummyModel(Model):
    def __init__(self, levels: dict[str, list[str]]):
        super().__init__()
        self.levels = levels
        self.names = {c: level_names(c, lv) for c, lv in levels.items()}

    def _transform(self, df: DataFrame) -> DataFrame:
        """k-1 indicator columns; the first level is the reference.  An unseen level is all zeros (see :meth:`unseen`)."""
        out = []
        for c, lv in self.levels.items():
            out += [(F.col(c) == F.lit(v)).cast("double").alias(self.names[c][v]) for v in lv[1:]]
        return df.select(*[x for x in df.columns if x not in self.levels], *out)

    def unseen(self, df: DataFrame) -> DataFrame:
        """Rows of new data whose level was not in the training data, per column."""
        aggs = [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(lv)).alias(c) for c, lv in self.levels.items()]
        return df.agg(*aggs).unpivot([], list(self.levels), "variable", "n_unseen")


class StepDummy(Estimator):
    """``step_dummy(all_nominal_predictors())``: levels fixed on the training data, sorted."""

    def __init__(self, cols: Sequence[str] | None = None, exclude: Sequence[str] = ()):
        super().__init__()
        self.cols, self.exclude = cols, tuple(exclude)

    def _fit(self, df: DataFrame) -> StepDummyModel:
        cols = self.cols or [f.name for f in df.schema.fields
                             if isinstance(f.dataType, T.StringType) and f.name not in self.exclude]
        return StepDummyModel(nominal_levels(df, cols) if cols else {})


class StepIndex(Estimator):
    """Native factors for tree models: every nominal column as level numbers with their names in the metadata."""

    def __init__(self, exclude: Sequence[str] = ()):
        super().__init__()
        self.exclude = tuple(exclude)

    def _fit(self, df: DataFrame):
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in self.exclude]
        if not cols:
            return StepRm(())
        return StringIndexer(inputCols=cols, outputCols=[f"{c}_ix" for c in cols], handleInvalid="keep", stringOrderType="alphabetAsc").fit(df)


class StepZv(Estimator):
    """``step_zv(all_predictors())``: drop single-valued columns, decided on the training data."""

    def __init__(self, exclude: Sequence[str] = ()):
        super().__init__()
        self.exclude = tuple(exclude)

    def _fit(self, df: DataFrame) -> StepRm:
        cols = [f.name for f in df.schema.fields if f.name not in self.exclude
                and isinstance(f.dataType, (*NUMERIC, T.StringType, T.BooleanType))]
        # min == max (or all NA) means a single value: one pass of plain min/max, no distinct counting
        row = _one_pass(df, cols, lambda c: [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")])
        return StepRm([c for c in cols if row[f"lo_{c}"] is None or row[f"lo_{c}"] == row[f"hi_{c}"]])


class StepNormalizeModel(Model):
    def __init__(self, stats: dict[str, tuple[float, float]]):
        super().__init__()
        self.stats = stats

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[((F.col(c) - self.stats[c][0]) / self.stats[c][1]).alias(c)
                           if c in self.stats else F.col(c) for c in df.columns])


class StepNormalize(Estimator):
    """``step_normalize(all_numeric_predictors())``: (x - mean) / sd (n - 1) from the training data."""

    def __init__(self, cols: Sequence[str] | None = None, exclude: Sequence[str] = ()):
        super().__init__()
        self.cols, self.exclude = cols, tuple(exclude)

    def _fit(self, df: DataFrame) -> StepNormalizeModel:
        cols = self.cols or [f.name for f in df.schema.fields
                             if isinstance(f.dataType, NUMERIC) and f.name not in self.exclude]
        row = _one_pass(df, cols, lambda c: [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")])
        return StepNormalizeModel({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols if row[f"s_{c}"]})


class StepLabel(Transformer):
    """Outcome as a 0/1 label: 1.0 for the event level (the first level, as in the metrics)."""

    def __init__(self, outcome: str, event: str, label: str = "label"):
        super().__init__()
        self.outcome, self.event, self.label = outcome, event, label

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.label, (F.col(self.outcome) == self.event).cast("double"))


class AssemblePredictors(Transformer):
    """All columns except outcome / label / ID roles become the ``features`` vector."""

    def __init__(self, exclude: Sequence[str], features: str = "features"):
        super().__init__()
        self.exclude, self.features = tuple(exclude), features
        self.columns: list[str] = []

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = [f.name for f in df.schema.fields if f.name not in self.exclude
                and isinstance(f.dataType, (*NUMERIC, T.BooleanType))]
        self.columns = cols
        x = df.select(*[F.col(c) if c not in cols or isinstance(df.schema[c].dataType, T.DoubleType)
                        else F.col(c).cast("double").alias(c) for c in df.columns])
        # the assembler takes a row's columns apart one by one, in code too large to be compiled when they are many: it is given
        # them as one vector, to compress, and what it would say about the columns is kept
        meta = VectorAssembler(inputCols=cols, outputCol=self.features).transform(x).schema[self.features].metadata
        missing = F.exists("_array", lambda v: v.isNull() | F.isnan(v))
        checked = F.when(missing, F.raise_error(F.lit("a predictor is missing (null or NaN)")).cast("array<double>")).otherwise(F.col("_array"))
        size = {"ml_attr": {"num_attrs": len(cols)}}
        out = x.withColumn("_array", F.array(*[F.col(c) for c in cols]).cast("array<double>"))
        out = out.withColumn("_dense", array_to_vector(checked).alias("_dense", metadata=size))
        out = VectorAssembler(inputCols=["_dense"], outputCol=self.features, handleInvalid="error").transform(out)
        return out.select(*x.columns, F.col(self.features).alias(self.features, metadata=meta))


def recipe(outcome: str, event: str, ids: Sequence[str] = (), date_col: str | None = None,
           date_features: Sequence[str] = ("dow", "month"), holidays: Sequence[str] | None = None,
           normalize: bool = False) -> list:
    """``recipe(y ~ .) |> update_role(ids, "ID") |> step_date |> step_holiday |> step_rm(date)
    |> step_dummy |> step_zv (|> step_normalize)`` as pipeline stages."""
    roles = [outcome, "label", *ids]
    stages: list = [StepLabel(outcome, event)]
    if date_col:
        stages.append(StepDate(date_col, date_features))
        if holidays:
            stages.append(StepHoliday(date_col, holidays))
        stages.append(StepRm([date_col]))
    stages += [StepDummy(exclude=roles), StepZv(exclude=roles)]
    if normalize:
        stages.append(StepNormalize(exclude=roles))
    stages.append(AssemblePredictors(exclude=roles))
    return stages


def workflow(stages: list, model) -> Pipeline:
    """``workflow() |> add_recipe() |> add_model()``."""
    return Pipeline(stages=[*stages, model])


def feature_names(pipeline_model) -> list[str]:
    for st in pipeline_model.stages:
        if isinstance(st, AssemblePredictors):
            return st.columns
    return []


#: rows that one task of an iterative fit goes through per pass; fewer cost more in scheduling than in work
ROWS_PER_TASK = 20_000


def in_few_parts(stored: DataFrame) -> DataFrame:
    """A persisted frame in as many partitions as its rows are worth, read from storage without a shuffle."""
    return stored.coalesce(max(1, -(-stored.count() // ROWS_PER_TASK)))


def fit_stored(estimator, df: DataFrame):
    """Fit on rows kept in storage while the fit runs."""
    from pyspark import StorageLevel
    x = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(in_few_parts(x))
    finally:
        x.unpersist()


def fit_workflow(stages: list, estimator, train: DataFrame, label: str = "label", features: str = "features"):
    """Fit the recipe, then the model on persisted (label, features) rows only.

    Iterative estimators (IRLS, L-BFGS, tree growing) pass over their input
    many times; persisting just the two model columns (spilling to disk when
    large) keeps each pass from re-running the joins and recipe upstream.
    """
    from pyspark.ml import PipelineModel

    prep = Pipeline(stages=stages).fit(train)
    model = fit_stored(estimator, prep.transform(train).select(label, features))
    return PipelineModel(stages=[*prep.stages, model])
