"""Model metrics as DataFrames: regression fit, confusion tables, ROC curve and AUC.

ROC and AUC aggregate by distinct score first (partial aggregation), then
take running sums over the score order with the distributed prefix scan, so
no step sorts all rows in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from tessera.plans.ordered import scan


def rsq(df: DataFrame, truth: str, estimate: str) -> DataFrame:
    """``rsq``: squared Pearson correlation of truth and estimate."""
    return df.agg(F.pow(F.corr(truth, estimate), 2).alias("rsq"))


def rmse(df: DataFrame, truth: str, estimate: str) -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(truth) - F.col(estimate), 2))).alias("rmse"))


def conf_mat(df: DataFrame, truth: str, estimate: str, levels: Sequence[str]) -> DataFrame:
    """2 x 2 (k x k) table of (prediction, truth) counts with empty cells as 0."""
    counts = df.groupBy(F.col(estimate).alias("prediction"), F.col(truth).alias("truth")).agg(
        F.count(F.lit(1)).alias("n"))
    cells = counts.sparkSession.createDataFrame([(p, t) for p in levels for t in levels], "prediction string, truth string")
    return cells.join(counts, ["prediction", "truth"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


def confusion_counts(df: DataFrame, truth: str, estimate: str, event: str) -> DataFrame:
    t, e = F.col(truth) == event, F.col(estimate) == event
    return df.agg(F.count_if(t & e).alias("tp"), F.count_if(~t & e).alias("fp"),
                  F.count_if(t & ~e).alias("fn"), F.count_if(~t & ~e).alias("tn"))


def conf_mat_summary(df: DataFrame, truth: str, estimate: str, event: str) -> DataFrame:
    """``summary(conf_mat)``: the usual two-class metrics, one row per metric."""
    c = confusion_counts(df, truth, estimate, event)
    tp, fp, fn, tn = [F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn")]
    d = F.try_divide  # an empty margin gives NA, not an ANSI division error
    n = tp + fp + fn + tn
    sens, spec = d(tp, tp + fn), d(tn, tn + fp)
    ppv, npv = d(tp, tp + fp), d(tn, tn + fn)
    acc = d(tp + tn, n)
    pe = d((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    mcc = d(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
    metrics = {
        "accuracy": acc, "kap": d(acc - pe, 1 - pe), "sens": sens, "spec": spec, "ppv": ppv, "npv": npv,
        "mcc": mcc, "j_index": sens + spec - 1, "bal_accuracy": (sens + spec) / 2,
        "detection_prevalence": d(tp + fp, n), "precision": ppv, "recall": sens,
        "f_meas": d(2 * ppv * sens, ppv + sens),
    }
    wide = c.select(*[v.alias(k) for k, v in metrics.items()])
    stack = ", ".join(f"'{k}', `{k}`" for k in metrics)
    return wide.selectExpr(f"stack({len(metrics)}, {stack}) AS (metric, estimate)")


def _score_counts(df: DataFrame, truth: str, score: str, event: str) -> DataFrame:
    return df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(truth) == event).alias("_e"), F.count_if(F.col(truth) != event).alias("_ne"))


def roc_curve(df: DataFrame, truth: str, score: str, event: str) -> DataFrame:
    """``roc_curve``: one row per distinct score plus the two end points.

    At threshold s: sensitivity = share of events scoring >= s, specificity =
    share of non-events scoring < s.
    """
    s = _score_counts(df, truth, score, event)
    s = scan(s, [], ["threshold"], sums=[("_e", "_ce"), ("_ne", "_cne")])
    # totals from the stored counts: the rows are read once
    tot = s.agg(F.coalesce(F.sum("_e"), F.lit(0)).alias("n1"), F.coalesce(F.sum("_ne"), F.lit(0)).alias("n0")).first()
    n1, n0 = float(tot["n1"]) or float("nan"), float(tot["n0"]) or float("nan")
    body = s.select(F.col("threshold").cast("double").alias("threshold"),
                    ((F.col("_cne") - F.col("_ne")) / n0).alias("specificity"),
                    (1 - (F.col("_ce") - F.col("_e")) / n1).alias("sensitivity"))
    ends = df.sparkSession.createDataFrame([(float("-inf"), 0.0, 1.0), (float("inf"), 1.0, 0.0)],
                                           "threshold double, specificity double, sensitivity double")
    return body.unionByName(ends)


def roc_auc(df: DataFrame, truth: str, score: str, event: str) -> DataFrame:
    """``roc_auc``: Mann-Whitney statistic with ties counted half (= trapezoid area)."""
    return roc_auc_by(df, [], truth, score, event)


def roc_auc_by(df: DataFrame, by: Sequence[str], truth: str, score: str, event: str) -> DataFrame:
    """One AUC per group (per tuning candidate, say), all groups in one scan of the distinct scores."""
    counts = df.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(truth) == event).alias("_e"), F.count_if(F.col(truth) != event).alias("_ne"))
    s = scan(counts, by, ["threshold"], sums=[("_ne", "_cne")])
    below = F.col("_cne") - F.col("_ne")
    return s.groupBy(*by).agg(F.try_divide(F.sum(F.col("_e") * (below + 0.5 * F.col("_ne"))),
                                           F.sum("_e") * F.sum("_ne")).cast("double").alias("roc_auc"))
