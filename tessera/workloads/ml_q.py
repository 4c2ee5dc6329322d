"""§2.15 recipes, §2.16 splits and models, §2.17 tuning, §2.18 evaluation, and the model analyses of §2.21.

Recipe steps, splits and metrics on a deterministic score are SQL arithmetic
and carry oracles; fitted models are checked by rows (and by planted-truth
tests in tests/).
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tessera.functions.dates import FEASTS, US_HOLIDAYS, holiday_flags
from tessera.functions.random import hash_uniform, hash_uniform_sql
from tessera.ml.distributions import norm_quantile
from tessera.ml import cart, diagnostics, forest, metrics, models, network, penalty, recipe, splits, tune
from tessera.operators import verbs
from tessera.operators.sorting import hash_key_sql
from tessera.session import stored
from tessera.sources.inline import expand_values
from tessera.sources.views import CUT_LEVELS
from tessera.workloads import query
from tessera.workloads.scalars_q import _holiday_sql

LK = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LK_SQL = ", ".join(LK)
EVENT, OTHER = "late", "on_time"
SCORE_SQL = "round(1 / (1 + exp(-(dep_delay - 30) / 200)), 6)"
SCORE2_SQL = "round(1 / (1 + exp(-(distance - 38000) / 20000)), 6)"


def _score(x: str, center: float, scale: float):
    return F.round(1 / (1 + F.exp(-(F.col(x) - center) / scale)), 6)


def _scored(t):
    """Late flights with a deterministic score: truth, pred_late, and the 0.5-threshold class."""
    d = t.deliveries.filter(F.col("arr_delay").isNotNull() & F.col("dep_delay").isNotNull())
    return d.select(*LK, F.when(F.col("arr_delay") >= 30, EVENT).otherwise(OTHER).alias("truth"),
                    _score("dep_delay", 30, 200).alias("pred_late"), _score("distance", 38000, 20000).alias("score2"))


SCORED_SQL = f"""(SELECT {LK_SQL}, CASE WHEN arr_delay >= 30 THEN 'late' ELSE 'on_time' END AS truth,
  {SCORE_SQL} AS pred_late, {SCORE2_SQL} AS score2 FROM deliveries WHERE arr_delay IS NOT NULL AND dep_delay IS NOT NULL)"""


def _r6(df, skip=()):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


# ------------------------------------------------------------------ §2.15 recipe steps

@query("label_binarise", section="2.15", sql="""
SELECT arr_delay, CAST(CASE WHEN arr_delay = 'late' THEN 1 ELSE 2 END AS BIGINT) AS ord, count(*) AS n
FROM (SELECT CASE WHEN arr_delay >= 30 THEN 'late' ELSE 'on_time' END AS arr_delay FROM deliveries WHERE arr_delay IS NOT NULL)
GROUP BY 1""")
def label_binarise(t):
    # alphabetical levels: "late" is the first level, the event for the metrics
    d = t.deliveries.filter(F.col("arr_delay").isNotNull()).select(
        F.when(F.col("arr_delay") >= 30, EVENT).otherwise(OTHER).alias("arr_delay"))
    return d.groupBy("arr_delay").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "ord", F.when(F.col("arr_delay") == EVENT, 1).otherwise(2).cast("bigint"))


@query("log_features", section="2.15", sql=f"""
SELECT {LK_SQL}, round(ln(price), 6) AS log_price, round(ln(carat), 6) AS log_carat FROM gems""")
def log_features(t):
    return t.gems.select(*LK, F.round(F.ln("price"), 6).alias("log_price"), F.round(F.ln("carat"), 6).alias("log_carat"))


@query("step_date", section="2.15", sql=f"""
SELECT {LK_SQL}, strftime(date, '%a') AS date_dow, strftime(date, '%b') AS date_month FROM deliveries""")
def step_date(t):
    d = t.deliveries.select(*LK, "date")
    d = recipe.StepDate("date", ("dow", "month")).transform(d)
    return recipe.StepRm(["date"]).transform(d)


@query("step_holiday", section="2.15", sql=f"SELECT {LK_SQL}, date, {_holiday_sql('date')} FROM deliveries")
def step_holiday(t):
    return recipe.StepHoliday("date", FEASTS).transform(t.deliveries.select(*LK, "date"))


@query("step_rm", section="2.15", sql="SELECT doc_id, label, lang, source, n_chars, toxic FROM doc_quality")
def step_rm(t):
    return recipe.StepRm(["arrival_date"]).transform(t.doc_quality)


TRAIN_SQL = f"""tr AS (SELECT * FROM doc_quality WHERE {hash_uniform_sql(222, 'doc_id')} < 0.75)"""


def _doc_split(t):
    return splits.initial_split(t.doc_quality, ["doc_id"], 0.75, seed=222)


@query("step_dummy", section="2.15", sql=f"""
WITH {TRAIN_SQL},
lv AS (SELECT 'lang' AS var, lang AS level, row_number() OVER (ORDER BY lang) AS k FROM (SELECT DISTINCT lang FROM tr)
       UNION ALL SELECT 'source', source, row_number() OVER (ORDER BY source) FROM (SELECT DISTINCT source FROM tr))
SELECT d.doc_id, lv.var || '_' || lv.level AS term,
  CAST(CASE WHEN (lv.var = 'lang' AND d.lang = lv.level) OR (lv.var = 'source' AND d.source = lv.level) THEN 1 ELSE 0 END AS DOUBLE) AS value
FROM doc_quality d, lv WHERE lv.k > 1""")
def step_dummy(t):
    # levels fixed on the training rows; first level is the reference; shown long (stable schema)
    s = _doc_split(t)
    model = recipe.StepDummy(["lang", "source"]).fit(s.filter(F.col("split") == "train"))
    wide = model.transform(s.select("doc_id", "lang", "source"))
    dummies = [c for c in wide.columns if c.startswith("lang_") or c.startswith("source_")]
    return wide.unpivot(["doc_id"], dummies, "term", "value")


ZV_COLS = ["lang", "source", "n_chars", "toxic", "const"]


@query("step_zv", section="2.15", sql=f"""
WITH {TRAIN_SQL}
SELECT 'lang' AS variable, count(DISTINCT lang) <= 1 AS zero_variance FROM tr UNION ALL
SELECT 'source', count(DISTINCT source) <= 1 FROM tr UNION ALL SELECT 'n_chars', count(DISTINCT n_chars) <= 1 FROM tr
UNION ALL SELECT 'toxic', count(DISTINCT toxic) <= 1 FROM tr UNION ALL SELECT 'const', true FROM tr LIMIT 5""")
def step_zv(t):
    s = _doc_split(t).withColumn("const", F.lit(1).cast("bigint"))
    rm = recipe.StepZv(exclude=["doc_id", "label", "arrival_date", "split"]).fit(s.filter(F.col("split") == "train"))
    return t.spark.createDataFrame([(c, c in rm.cols) for c in ZV_COLS], "variable string, zero_variance boolean")


@query("step_normalize", section="2.15", sql=f"""
WITH {TRAIN_SQL}
SELECT doc_id, round((n_chars - (SELECT avg(n_chars) FROM tr)) / (SELECT stddev_samp(n_chars) FROM tr), 6) AS n_chars FROM doc_quality""")
def step_normalize(t):
    s = _doc_split(t)
    m = recipe.StepNormalize(["n_chars"]).fit(s.filter(F.col("split") == "train"))
    return m.transform(s.select("doc_id", "n_chars")).select("doc_id", F.round("n_chars", 6).alias("n_chars"))


@query("recipe_spec", section="2.15")
def recipe_spec(t):
    # recipe(arr_delay ~ .): every other column is a predictor; the prepared variables and roles
    data = _flight_data(t)
    tr = splits.initial_split(data, LK, 0.75).filter(F.col("split") == "train").drop("split")
    stages = recipe.recipe("arr_delay", EVENT, ids=["flight", "time_hour", *LK], date_col="date",
                           holidays=US_HOLIDAYS)
    from pyspark.ml import Pipeline
    pm = Pipeline(stages=stages).fit(tr)
    preds = recipe.feature_names(pm)
    rows = [(c, "predictor") for c in preds] + [("arr_delay", "outcome")]
    return t.spark.createDataFrame(rows, "variable string, role string")


@query("update_role", section="2.15", sql=f"""
WITH d AS (SELECT {LK_SQL}, dep_time, flight, origin, dest, air_time, distance, carrier, date, time_hour FROM deliveries
           WHERE arr_delay IS NOT NULL AND dep_time IS NOT NULL AND air_time IS NOT NULL)
SELECT 'ID' AS role, count(DISTINCT (flight, time_hour, {LK_SQL})) AS n_distinct, count(*) AS n_rows FROM d
UNION ALL SELECT 'predictor', count(DISTINCT (air_time, carrier, date, dep_time, dest, distance, origin)), count(*) FROM d""")
def update_role(t):
    # update_role(flight, time_hour, new_role = "ID"): the columns of a role, carried through every row
    data = _flight_data(t)
    ids = ["flight", "time_hour", *LK]
    roles = {"ID": ids, "predictor": sorted(c for c in data.columns if c not in (*ids, "arr_delay"))}
    long = data.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("role"), F.md5(F.to_json(F.struct(*cols))).alias("value")) for r, cols in roles.items()])).alias("x"))
    return long.groupBy("x.role").agg(F.count_distinct("x.value").alias("n_distinct"), F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ §2.16 splits

@query("initial_split", section="2.16", sql=f"""
SELECT {LK_SQL}, CASE WHEN {hash_uniform_sql(222, *LK)} < 0.75 THEN 'train' ELSE 'test' END AS split FROM deliveries""")
def initial_split(t):
    return splits.initial_split(t.deliveries.select(*LK), LK, 0.75, seed=222)


STRATA_SQL = splits.split_sql("doc_quality", "doc_id, label", ["doc_id"], 0.75, 123, "label")


@query("initial_split_strata", section="2.16", sql=STRATA_SQL)
def initial_split_strata(t):
    return splits.initial_split(t.doc_quality.select("doc_id", "label"), ["doc_id"], 0.75, seed=123, strata=["label"])


@query("validation_split", section="2.16", sql=f"""
WITH s AS ({STRATA_SQL}), tr AS (SELECT doc_id, label FROM s WHERE split = 'train')
{splits.split_sql("tr", "doc_id, label", ["doc_id"], 0.8, 234, "label", ("train", "validation"), "val_split")}""")
def validation_split(t):
    s = splits.initial_split(t.doc_quality.select("doc_id", "label"), ["doc_id"], 0.75, seed=123, strata=["label"])
    tr = s.filter(F.col("split") == "train").drop("split")
    return splits.validation_split(tr, ["doc_id"], 0.8, seed=234, strata=["label"])


# ------------------------------------------------------------------ §2.16 linear model on gems

def _gems_log(t):
    return t.gems.select(*LK, "cut", F.ln("price").alias("log_price"), F.ln("carat").alias("log_carat"))


def _lm_one(t):
    from pyspark.ml.feature import VectorAssembler
    d = _gems_log(t)
    va = VectorAssembler(inputCols=["log_carat"], outputCol="features")
    m = models.linear_reg(labelCol="log_price").fit(va.transform(d))
    return d, m


@query("fit_lm", section="2.16", sql="""
SELECT '(Intercept)' AS term, round(regr_intercept(ln(price), ln(carat)), 6) AS estimate FROM gems
UNION ALL SELECT 'log_carat', round(regr_slope(ln(price), ln(carat)), 6) FROM gems""")
def fit_lm(t):
    d, m = _lm_one(t)
    return _r6(models.tidy_linear(t.spark, m, ["log_carat"]).select("term", "estimate"))


@query("residuals", section="2.16", sql=f"""
SELECT {LK_SQL}, round(ln(price) - (regr_intercept(ln(price), ln(carat)) OVER () + regr_slope(ln(price), ln(carat)) OVER ()
       * ln(carat)), 6) AS resid FROM gems""")
def residuals(t):
    d, m = _lm_one(t)
    fitted = F.lit(float(m.intercept)) + F.col("log_carat") * float(m.coefficients[0])
    return d.select(*LK, F.round(F.col("log_price") - fitted, 6).alias("resid"))


@query("rsq", section="2.18", sql="""
SELECT round(pow(corr(lp, fit), 2), 6) AS rsq FROM (SELECT ln(price) AS lp,
  regr_intercept(ln(price), ln(carat)) OVER () + regr_slope(ln(price), ln(carat)) OVER () * ln(carat) AS fit FROM gems)""")
def rsq(t):
    d, m = _lm_one(t)
    fitted = F.lit(float(m.intercept)) + F.col("log_carat") * float(m.coefficients[0])
    return _r6(metrics.rsq(d.withColumn("fit", fitted), "log_price", "fit"))


@query("rmse", section="2.18", sql="""
SELECT round(sqrt(avg(pow(lp - fit, 2))), 6) AS rmse FROM (SELECT ln(price) AS lp,
  regr_intercept(ln(price), ln(carat)) OVER () + regr_slope(ln(price), ln(carat)) OVER () * ln(carat) AS fit FROM gems)""")
def rmse(t):
    d, m = _lm_one(t)
    fitted = F.lit(float(m.intercept)) + F.col("log_carat") * float(m.coefficients[0])
    return _r6(metrics.rmse(d.withColumn("fit", fitted), "log_price", "fit"))


@query("check_vif", section="2.18", sql="""
SELECT 'carat' AS term, round(1 / (1 - pow(corr(carat, x), 2)), 6) AS vif FROM gems
UNION ALL SELECT 'x', round(1 / (1 - pow(corr(carat, x), 2)), 6) FROM gems""")
def check_vif(t):
    return _r6(diagnostics.vif(t.gems, ["carat", "x"]))


# ------------------------------------------------------------------ §2.18 classification metrics

@query("conf_mat", section="2.18", sql=f"""
SELECT p.prediction, p.truth, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (VALUES ('late', 'late'), ('late', 'on_time'), ('on_time', 'late'), ('on_time', 'on_time')) p(prediction, truth)
LEFT JOIN (SELECT CASE WHEN pred_late > 0.5 THEN 'late' ELSE 'on_time' END AS prediction, truth, count(*) AS n
           FROM {SCORED_SQL} GROUP BY 1, 2) c ON p.prediction = c.prediction AND p.truth = c.truth""")
def conf_mat(t):
    s = _scored(t).withColumn("estimate", F.when(F.col("pred_late") > 0.5, EVENT).otherwise(OTHER))
    return metrics.conf_mat(s, "truth", "estimate", [EVENT, OTHER])


def _summary_sql(th):
    return f"""
WITH c AS (SELECT CAST(count(*) FILTER (WHERE truth = 'late' AND est = 'late') AS DOUBLE) AS tp,
  CAST(count(*) FILTER (WHERE truth <> 'late' AND est = 'late') AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE truth = 'late' AND est <> 'late') AS DOUBLE) AS fn,
  CAST(count(*) FILTER (WHERE truth <> 'late' AND est <> 'late') AS DOUBLE) AS tn
  FROM (SELECT truth, CASE WHEN pred_late > {th} THEN 'late' ELSE 'on_time' END AS est FROM {SCORED_SQL})),
m AS (SELECT tp / (tp + fn) AS sens, tn / (tn + fp) AS spec, tp / (tp + fp) AS ppv, tn / (tn + fn) AS npv,
  (tp + tn) / (tp + fp + fn + tn) AS acc,
  ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) * (tp + fp + fn + tn)) AS pe,
  (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) AS mcc,
  (tp + fp) / (tp + fp + fn + tn) AS dp FROM c)
SELECT 'accuracy' AS metric, round(acc, 6) AS estimate FROM m UNION ALL SELECT 'kap', round((acc - pe) / (1 - pe), 6) FROM m
UNION ALL SELECT 'sens', round(sens, 6) FROM m UNION ALL SELECT 'spec', round(spec, 6) FROM m
UNION ALL SELECT 'ppv', round(ppv, 6) FROM m UNION ALL SELECT 'npv', round(npv, 6) FROM m
UNION ALL SELECT 'mcc', round(mcc, 6) FROM m UNION ALL SELECT 'j_index', round(sens + spec - 1, 6) FROM m
UNION ALL SELECT 'bal_accuracy', round((sens + spec) / 2, 6) FROM m UNION ALL SELECT 'detection_prevalence', round(dp, 6) FROM m
UNION ALL SELECT 'precision', round(ppv, 6) FROM m UNION ALL SELECT 'recall', round(sens, 6) FROM m
UNION ALL SELECT 'f_meas', round(2 * ppv * sens / (ppv + sens), 6) FROM m"""


@query("conf_mat_summary", section="2.18", sql=_summary_sql(0.5))
def conf_mat_summary(t):
    s = _scored(t).withColumn("estimate", F.when(F.col("pred_late") > 0.5, EVENT).otherwise(OTHER))
    return _r6(metrics.conf_mat_summary(s, "truth", "estimate", EVENT))


@query("threshold_shift", section="2.18", sql=f"""
SELECT th AS threshold, CASE WHEN pred_late > th THEN 'late' ELSE 'on_time' END AS prediction, truth, count(*) AS n
FROM {SCORED_SQL}, (VALUES (0.4), (0.6)) v(th) GROUP BY 1, 2, 3""".replace("(VALUES (0.4), (0.6)) v(th)",
                                                                            "(VALUES (0.4::DOUBLE), (0.6::DOUBLE)) v(th)"))
def threshold_shift(t):
    s = expand_values(_scored(t), "threshold", [0.4, 0.6])
    s = s.withColumn("prediction", F.when(F.col("pred_late") > F.col("threshold"), EVENT).otherwise(OTHER))
    return s.groupBy("threshold", "prediction", "truth").agg(F.count(F.lit(1)).alias("n"))


ROC_SQL = """
WITH s AS (SELECT {score} AS threshold, count(*) FILTER (WHERE truth = 'late') AS e, count(*) FILTER (WHERE truth <> 'late') AS ne
           FROM {scored} GROUP BY 1),
c AS (SELECT *, sum(e) OVER (ORDER BY threshold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ce,
             sum(ne) OVER (ORDER BY threshold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cne,
             sum(e) OVER () AS n1, sum(ne) OVER () AS n0 FROM s)
SELECT {label}threshold, round(coalesce(cne, 0) / n0, 6) AS specificity, round(1 - coalesce(ce, 0) / n1, 6) AS sensitivity FROM c
UNION ALL SELECT {label}'-Infinity'::DOUBLE, 0.0, 1.0 UNION ALL SELECT {label}'Infinity'::DOUBLE, 1.0, 0.0"""


@query("roc_curve", section="2.18", sql=ROC_SQL.format(score='pred_late', scored=SCORED_SQL, label=""))
def roc_curve(t):
    return _r6(metrics.roc_curve(_scored(t), "truth", "pred_late", EVENT), skip=("threshold",))


@query("roc_auc", section="2.18", sql=f"""
WITH s AS (SELECT pred_late AS th, count(*) FILTER (WHERE truth = 'late') AS e, count(*) FILTER (WHERE truth <> 'late') AS ne
           FROM {SCORED_SQL} GROUP BY 1),
c AS (SELECT *, coalesce(sum(ne) OVER (ORDER BY th ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT round(sum(e * (below + 0.5 * ne)) / (sum(e) * sum(ne)), 6) AS roc_auc FROM c""")
def roc_auc(t):
    return _r6(metrics.roc_auc(_scored(t), "truth", "pred_late", EVENT))


@query("roc_compare", section="2.18", sql=ROC_SQL.format(score='pred_late', scored=SCORED_SQL, label="'delay' AS model, ")
       + " UNION ALL " + ROC_SQL.format(score="score2", scored=SCORED_SQL, label="'distance' AS model, ").replace("WITH s AS", "(WITH s AS") + ")")
def roc_compare(t):
    s = _scored(t)
    a = metrics.roc_curve(s, "truth", "pred_late", EVENT).withColumn("model", F.lit("delay"))
    b = metrics.roc_curve(s, "truth", "score2", EVENT).withColumn("model", F.lit("distance"))
    return _r6(a.unionByName(b), skip=("threshold",))


# ------------------------------------------------------------------ late flights (glm workflow)

#: planted log-odds of a late arrival: intercept, per unit of departure time (hhmm), in December
LATE_ODDS = (-2.0, 0.0015, 0.8)


def _flight_data(t):
    """Complete flights with a late / on_time label of a known relation: later in the day and in December more are late."""
    d = t.deliveries.filter(F.col("arr_delay").isNotNull())
    a, per_time, december = LATE_ODDS
    odds = a + per_time * F.col("dep_time") + F.when(F.col("month") == 12, december).otherwise(0.0)
    late = hash_uniform(17, *LK) < 1 / (1 + F.exp(-odds))
    d = d.select(*LK, "dep_time", "flight", "origin", "dest", "air_time", "distance", "carrier", "date",
                 F.when(late, EVENT).otherwise(OTHER).alias("arr_delay"), "time_hour")
    return verbs.na_omit(d)


def _late_fit(t, extra=None, with_recipe=True, score=True):
    """Glm workflow fitted on 3/4 of the flights, the scored test rows (stored), and the term names."""
    data = _flight_data(t)
    if extra is not None:
        data = extra(data)
    # the model table is read by every recipe pass, the fit and the scoring: keep it while they run
    s = splits.initial_split(data, LK, 0.75, seed=222).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tr, te = s.filter(F.col("split") == "train").drop("split"), s.filter(F.col("split") == "test").drop("split")
        ids = ["flight", "time_hour", *LK]
        if with_recipe:
            stages = recipe.recipe("arr_delay", EVENT, ids=ids, date_col="date", holidays=US_HOLIDAYS)
        else:
            stages = [recipe.StepLabel("arr_delay", EVENT), recipe.StepRm(["date", "origin", "dest", "carrier"]),
                      recipe.AssemblePredictors(exclude=["arr_delay", "label", *ids])]
        pm = recipe.fit_workflow(stages, models.logistic_glm(), tr)
        scored = None
        if score:
            scored = models.augment(pm, te, EVENT, OTHER).select(*LK, "arr_delay", "pred_class", f"pred_{EVENT}").checkpoint(eager=True)
    finally:
        s.unpersist()
    return pm, scored, recipe.feature_names(pm)


@query("fit_glm_logit", section="2.16")
def fit_glm_logit(t):
    pm, _, names = _late_fit(t, score=False)
    return models.tidy_glm(t.spark, pm.stages[-1], names)


@query("workflow", section="2.16")
def workflow_q(t):
    pm, scored, _ = _late_fit(t)
    auc = metrics.roc_auc(scored, "arr_delay", f"pred_{EVENT}", EVENT)
    acc = scored.agg(F.avg((F.col("pred_class") == F.col("arr_delay")).cast("double")).alias("accuracy"))
    return auc.withColumn("accuracy", F.lit(acc.first()[0]))


@query("predict_augment", section="2.16")
def predict_augment(t):
    _, scored, _ = _late_fit(t)
    return scored.select(*LK, "arr_delay", "pred_class", f"pred_{EVENT}")


@query("tidy_terms", section="2.18")
def tidy_terms(t):
    pm, _, names = _late_fit(t, score=False)
    return models.tidy_glm(t.spark, pm.stages[-1], names, exponentiate=True)


@query("term_importance", section="2.18")
def term_importance(t):
    # rank terms by |statistic|, intercept dropped, top 20 (a top-k report)
    pm, _, names = _late_fit(t, score=False)
    td = models.tidy_glm(t.spark, pm.stages[-1], names).filter(F.col("term") != "(Intercept)")
    return td.orderBy(F.desc(F.abs("statistic")), "term").limit(20)


@query("late_flights", section="2.21")
def late_flights(t):
    _, scored, _ = _late_fit(t)
    auc = metrics.roc_auc(scored, "arr_delay", f"pred_{EVENT}", EVENT).first()[0]
    summ = metrics.conf_mat_summary(scored, "arr_delay", "pred_class", EVENT)
    return summ.unionByName(t.spark.createDataFrame([("roc_auc", float(auc))], "metric string, estimate double"))


def _with_weather(t):
    w = t.daily_events.select("origin", "day", "n_events", "mean_value", "max_value")

    def add(data):
        return data.withColumn("day", F.dayofmonth("date").cast("bigint")).join(w, ["origin", "day"]).drop("day")
    return add


@query("late_flights_weather", section="2.21")
def late_flights_weather(t):
    # after the weather join: with the full recipe vs with numeric predictors only
    rows = []
    for name, rec in (("with_recipe", True), ("without_recipe", False)):
        _, scored, _ = _late_fit(t, extra=_with_weather(t), with_recipe=rec)
        auc = metrics.roc_auc(scored, "arr_delay", f"pred_{EVENT}", EVENT).first()[0]
        c = metrics.confusion_counts(scored, "arr_delay", "pred_class", EVENT).first()
        sens = c["tp"] / max(c["tp"] + c["fn"], 1)
        spec = c["tn"] / max(c["tn"] + c["fp"], 1)
        rows.append((name, float(auc) if auc is not None else None, float(sens), float(spec)))
    return t.spark.createDataFrame(rows, "model string, roc_auc double, sens double, spec double")


# ------------------------------------------------------------------ lm on gems: price model

def _lm_price(t):
    from pyspark.ml import Pipeline
    d = _gems_log(t)
    stages = [recipe.StepDummy(["cut"]), recipe.AssemblePredictors(exclude=["log_price", *LK])]
    prep = Pipeline(stages=stages).fit(d)
    x = prep.transform(d)
    names = recipe.feature_names(prep)
    m = models.linear_reg(labelCol="log_price").fit(x)
    return d, prep, x, names, m


# the same fit in closed form: one slope pooled within the cuts, one level per cut
LM_SQL = """d AS (SELECT cut, ln(price) AS y, ln(carat) AS x FROM gems),
g AS (SELECT cut, count(*) AS n, avg(x) AS mx, avg(y) AS my, sum(x * x) - count(*) * avg(x) * avg(x) AS sxx,
             sum(x * y) - count(*) * avg(x) * avg(y) AS sxy FROM d GROUP BY cut),
b AS (SELECT sum(sxy) / sum(sxx) AS b, sum(sxx) AS sxx, sum(n) AS n, count(*) AS k FROM g),
lv AS (SELECT cut, g.n, mx, my - b.b * mx AS level, row_number() OVER (ORDER BY cut) AS i FROM g, b),
ref AS (SELECT level, n, mx FROM lv WHERE i = 1),
f AS (SELECT d.cut, d.x, d.y, lv.level + b.b * d.x AS pred, d.y - lv.level - b.b * d.x AS resid FROM d JOIN lv USING (cut), b),
s AS (SELECT sum(resid * resid) / (any_value(b.n) - any_value(b.k) - 1) AS s2, any_value(b.n) - any_value(b.k) - 1 AS df FROM f, b),
terms AS (SELECT '(Intercept)' AS term, ref.level AS estimate, 1.0 / ref.n + ref.mx * ref.mx / b.sxx AS v FROM ref, b
  UNION ALL SELECT 'log_carat', b.b, 1 / b.sxx FROM b
  UNION ALL SELECT 'cut_' || lv.cut, lv.level - ref.level, 1.0 / lv.n + 1.0 / ref.n + pow(lv.mx - ref.mx, 2) / b.sxx FROM lv, ref, b WHERE lv.i > 1)"""


def _t_sql(z: float) -> str:
    """Student quantile from the normal one, by its expansion in 1 / degrees of freedom."""
    return (f"({z} + ({z ** 3 + z}) / (4 * s.df) + ({5 * z ** 5 + 16 * z ** 3 + 3 * z}) / (96 * s.df * s.df))")


def _fitted_col(m, names):
    e = F.lit(float(m.intercept))
    for b, n in zip(m.coefficients, names):
        e = e + F.col(n) * float(b)
    return e


@query("lm_price", section="2.21", sql=f"""WITH {LM_SQL}
SELECT term, round(estimate, 6) AS estimate FROM terms UNION ALL SELECT 'rsq', round(corr(y, pred) ^ 2, 6) FROM f
UNION ALL SELECT 'rmse', round(sqrt(avg(resid * resid)), 6) FROM f""")
def lm_price(t):
    d, prep, x, names, m = _lm_price(t)
    td = models.tidy_linear(t.spark, m, names).select("term", "estimate")
    f = x.withColumn("pred", _fitted_col(m, names))
    r2 = metrics.rsq(f, "log_price", "pred").first()[0]
    e = metrics.rmse(f, "log_price", "pred").first()[0]
    extra = t.spark.createDataFrame([("rsq", float(r2)), ("rmse", float(e))], "term string, estimate double")
    return _r6(td.unionByName(extra))


def _grid(t, d, names):
    # new points: every cut level seen x log_carat = log(1:3); the level is kept beside its dummies
    g = expand_values(d.select("cut").distinct(), "log_carat", [math.log(1.0), math.log(2.0), math.log(3.0)])
    return g.withColumn("cut_level", F.col("cut"))


@query("predict_points", section="2.16", sql=f"""WITH {LM_SQL}
SELECT cut, round(x0, 6) AS log_carat, round(level + b.b * x0, 6) AS pred, round(exp(level + b.b * x0), 6) AS price
FROM lv, b, (VALUES (ln(1.0)), (ln(2.0)), (ln(3.0))) p(x0)""")
def predict_points(t):
    d, prep, x, names, m = _lm_price(t)
    g = prep.transform(_grid(t, d, names).withColumn("log_price", F.lit(0.0)).withColumn("l_orderkey", F.lit(0)))
    p = g.withColumn("pred", _fitted_col(m, names))
    return _r6(p.select(F.col("cut_level").alias("cut"), "log_carat", "pred", F.exp("pred").alias("price")))


@query("predict_conf_int", section="2.16", sql=f"""WITH {LM_SQL}
SELECT cut, round(x0, 6) AS log_carat, round(level + b.b * x0, 6) AS pred,
  round(level + b.b * x0 - {_t_sql(1.6448536269514722)} * sqrt(s.s2 * (1.0 / lv.n + pow(x0 - lv.mx, 2) / b.sxx)), 6) AS pred_lower,
  round(level + b.b * x0 + {_t_sql(1.6448536269514722)} * sqrt(s.s2 * (1.0 / lv.n + pow(x0 - lv.mx, 2) / b.sxx)), 6) AS pred_upper
FROM lv, b, s, (VALUES (ln(1.0)), (ln(2.0)), (ln(3.0))) p(x0)""")
def predict_conf_int(t):
    d, prep, x, names, m = _lm_price(t)
    g = prep.transform(_grid(t, d, names).withColumn("log_price", F.lit(0.0)))
    coefs = [float(m.intercept)] + [float(b) for b in m.coefficients]
    ci = diagnostics.mean_conf_int(x, names, "log_price", coefs, g, level=0.90)
    return _r6(ci.select(F.col("cut_level").alias("cut"), "log_carat", "pred", "pred_lower", "pred_upper"))


@query("fit_summary", section="2.18", sql=f"""WITH {LM_SQL},
v AS (SELECT 1 - sum(resid * resid) / (SELECT regr_syy(y, x) FROM d) AS r2, sum(resid * resid) AS rss, count(*) AS n FROM f)
SELECT round(r2, 6) AS r_squared, round(1 - (1 - r2) * (v.n - 1) / s.df, 6) AS adj_r_squared, round((r2 / (v.n - 1 - s.df)) / ((1 - r2) / s.df), 2) AS f_statistic,
  round(sqrt(s.s2), 6) AS sigma, v.n AS n, round(q[1], 6) AS resid_min, round(q[2], 6) AS resid_q1, round(q[3], 6) AS resid_median,
  round(q[4], 6) AS resid_q3, round(q[5], 6) AS resid_max FROM v, s, (SELECT quantile_cont(resid, [0, 0.25, 0.5, 0.75, 1]) AS q FROM f)""")
def fit_summary(t):
    d, prep, x, names, m = _lm_price(t)
    return _r6(models.fit_summary(t.spark, m, x.count(), len(names)).withColumn("f_statistic", F.round("f_statistic", 2)))


@query("coef_intervals", section="2.18", sql=f"""WITH {LM_SQL}
SELECT term, round(estimate, 6) AS estimate, round(estimate - {_t_sql(1.959963984540054)} * sqrt(s.s2 * v), 6) AS conf_low,
  round(estimate + {_t_sql(1.959963984540054)} * sqrt(s.s2 * v), 6) AS conf_high FROM terms, s""")
def coef_intervals(t):
    d, prep, x, names, m = _lm_price(t)
    n = x.count()
    return _r6(models.coef_intervals(models.tidy_linear(t.spark, m, names), n - len(names) - 1))


BINS_SQL = """r AS (SELECT min(pred) AS lo, (max(pred) - min(pred)) / 20 AS w FROM f)"""


@query("check_linearity", section="2.18", sql=f"""WITH {LM_SQL}, {BINS_SQL}
SELECT CAST(least(floor((pred - lo) / w), 19) AS BIGINT) AS bin, round(avg(pred), 6) AS fitted, round(avg(resid), 6) AS mean_resid, count(*) AS n
FROM f, r GROUP BY 1""")
def check_linearity(t):
    d, prep, x, names, m = _lm_price(t)
    f = x.withColumn("pred", _fitted_col(m, names)).withColumn("resid", F.col("log_price") - F.col("pred"))
    return _r6(diagnostics.residual_bins(f, "pred", "resid").withColumn("bin", F.col("bin").cast("bigint")))


def _residuals(t):
    d, prep, x, names, m = _lm_price(t)
    return x.withColumn("pred", _fitted_col(m, names)).withColumn("resid", F.col("log_price") - F.col("pred"))


@query("check_linearity_smooth", section="2.18")
def check_linearity_smooth(t):
    # the smooth line through the residuals that shows a bend the model lacks
    return diagnostics.residual_smooth(_residuals(t), "pred", "resid")


@query("check_homogeneity_smooth", section="2.18")
def check_homogeneity_smooth(t):
    # the smooth line through the size of the residuals
    return diagnostics.residual_smooth(_residuals(t), "pred", "resid", scale=True)


@query("check_gvif", section="2.18", sql=f"""WITH {LM_SQL},
v AS (SELECT 1 / (1 - (SELECT sum(g.n * pow(g.mx - m.mx, 2)) FROM g, (SELECT avg(x) AS mx FROM d) m) / (SELECT regr_sxx(y, x) FROM d)) AS gvif,
             (SELECT count(*) FROM g) - 1 AS k)
SELECT 'log_carat' AS term, round(gvif, 6) AS gvif, 1::BIGINT AS df, round(sqrt(gvif), 6) AS gvif_adj FROM v
UNION ALL SELECT 'cut', round(gvif, 6), k, round(pow(gvif, 1.0 / (2 * k)), 6) FROM v""")
def check_gvif(t):
    # VIF of the price model's terms: the factor's dummies count as one term
    d, prep, x, names, m = _lm_price(t)
    terms = {"log_carat": ["log_carat"], "cut": [n for n in names if n.startswith("cut_")]}
    return _r6(diagnostics.gvif(x, terms), skip=("df",))


@query("check_homogeneity", section="2.18", sql=f"""WITH {LM_SQL}, {BINS_SQL}
SELECT CAST(least(floor((pred - lo) / w), 19) AS BIGINT) AS bin, round(avg(pred), 6) AS fitted,
       round(avg(sqrt(abs(resid / (SELECT stddev_samp(resid) FROM f)))), 6) AS sqrt_abs_std_resid, count(*) AS n FROM f, r GROUP BY 1""")
def check_homogeneity(t):
    d, prep, x, names, m = _lm_price(t)
    f = x.withColumn("pred", _fitted_col(m, names)).withColumn("resid", F.col("log_price") - F.col("pred"))
    return _r6(diagnostics.homogeneity_bins(f, "pred", "resid").withColumn("bin", F.col("bin").cast("bigint")))


@query("check_qq", section="2.18", sql=f"""WITH {LM_SQL}, z AS (SELECT avg(resid) AS m, stddev_samp(resid) AS sd FROM f),
p(i, theoretical) AS (VALUES {", ".join(f"({i}, {norm_quantile((i - 0.5) / 99)!r})" for i in range(1, 100))})
SELECT round((i - 0.5) / 99, 6) AS p, round(CAST(theoretical AS DOUBLE), 6) AS theoretical, round((q[i] - z.m) / z.sd, 6) AS sample
FROM p, z, (SELECT quantile_cont(resid, [{", ".join(repr((i - 0.5) / 99) for i in range(1, 100))}]) AS q FROM f)""")
def check_qq(t):
    d, prep, x, names, m = _lm_price(t)
    f = x.withColumn("resid", F.col("log_price") - _fitted_col(m, names))
    return _r6(diagnostics.qq_points(f, "resid"))


@query("check_influence", section="2.18", sql=f"""WITH {LM_SQL},
d2 AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cut, ln(price) AS y, ln(carat) AS x FROM gems),
h AS (SELECT d2.*, d2.y - lv.level - b.b * d2.x AS e, 1.0 / lv.n + pow(d2.x - lv.mx, 2) / b.sxx AS h FROM d2 JOIN lv ON d2.cut = lv.cut, b)
SELECT {", ".join(LK)}, round(h, 9) AS leverage, round(e * e * h / ((b.k + 1) * s.s2 * (1 - h) * (1 - h)), 9) AS cooks_d FROM h, b, s""")
def check_influence(t):
    d, prep, x, names, m = _lm_price(t)
    coefs = [float(m.intercept)] + [float(b) for b in m.coefficients]
    inf = diagnostics.influence(x.drop("features"), names, "log_price", coefs)
    return inf.select(*LK, F.round("leverage", 9).alias("leverage"), F.round("cooks_d", 9).alias("cooks_d"))


@query("train_vs_new", section="2.18", sql=f"""
SELECT split, round(corr(ly, lx) ^ 2, 6) AS rsq, count(*) AS n FROM (
  SELECT ln(price) AS ly, ln(carat) AS lx, CASE WHEN {hash_uniform_sql(1984, *LK)} < 0.5 THEN 'train' ELSE 'test' END AS split FROM gems)
GROUP BY split""")
def train_vs_new(t):
    # the same model scored on its own rows and on rows it has not seen
    from pyspark.ml.feature import VectorAssembler
    d = _gems_log(t)
    s = splits.initial_split(d, LK, 0.5, seed=1984)
    va = VectorAssembler(inputCols=["log_carat"], outputCol="features")
    tr = va.transform(s.filter(F.col("split") == "train"))
    m = models.linear_reg(labelCol="log_price").fit(tr)
    sc = m.transform(va.transform(s))
    return sc.groupBy("split").agg(F.round(F.pow(F.corr("log_price", "prediction"), 2), 6).alias("rsq"),
                                   F.count(F.lit(1)).alias("n"))


@query("bind_cols", section="2.3", sql=f"""WITH {LM_SQL}, p AS (
  SELECT cut, x0, level + b.b * x0 AS pred, {_t_sql(1.959963984540054)} * sqrt(s.s2 * (1.0 / lv.n + pow(x0 - lv.mx, 2) / b.sxx)) AS half
  FROM lv, b, s, (VALUES (ln(1.0)), (ln(2.0)), (ln(3.0))) p(x0))
SELECT cut, round(x0, 6) AS log_carat, round(exp(pred), 6) AS mean_pred, round(exp(pred - half), 6) AS conf_lower, round(exp(pred + half), 6) AS conf_upper FROM p""")
def bind_cols(t):
    # never paste columns by position: the mean and the band are computed in one pass, born together
    d, prep, x, names, m = _lm_price(t)
    g = prep.transform(_grid(t, d, names).withColumn("log_price", F.lit(0.0)))
    coefs = [float(m.intercept)] + [float(b) for b in m.coefficients]
    ci = diagnostics.mean_conf_int(x, names, "log_price", coefs, g, level=0.95)
    return _r6(ci.select(F.col("cut_level").alias("cut"), "log_carat", F.exp("pred").alias("mean_pred"), F.exp("pred_lower").alias("conf_lower"),
                         F.exp("pred_upper").alias("conf_upper")))


def _poly(k: int) -> list[list[float]]:
    """Orthogonal polynomial contrasts of an ordered factor with ``k`` levels, a row per level."""
    import numpy as np
    v = np.vander(np.arange(1, k + 1, dtype=float), k, increasing=True)
    q, _ = np.linalg.qr(v)
    return (q[:, 1:] * np.sign(q[-1, 1:])).tolist()


@query("fct_unordered", section="2.11", sql=" UNION ALL ".join([f"""
SELECT 'ordered' AS scheme, 'cut{name}' AS term, round(sum(CASE cut {" ".join(f"WHEN '{c}' THEN CAST({row[j]!r} AS DOUBLE)" for c, row in zip(CUT_LEVELS, _poly(6)))} END), 6) AS total,
  count(*) AS n FROM gems""" for j, name in enumerate([".L", ".Q", ".C", "^4", "^5"])] + [f"""
SELECT 'unordered', 'cut_{c}', round(sum(CASE WHEN cut = '{c}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6), count(*) FROM gems""" for c in sorted(CUT_LEVELS)[1:]]))
def fct_unordered(t):
    # the model matrix of every row: an ordered factor gives polynomial columns, an unordered one dummies
    poly = _poly(len(CUT_LEVELS))
    cols = [("ordered", f"cut{name}", F.create_map(*[F.lit(x) for c, row in zip(CUT_LEVELS, poly) for x in (c, row[j])])[F.col("cut")])
            for j, name in enumerate([".L", ".Q", ".C", "^4", "^5"])]
    cols += [("unordered", f"cut_{c}", (F.col("cut") == c).cast("double")) for c in sorted(CUT_LEVELS)[1:]]
    rows = t.gems.select(F.explode(F.array(*[F.struct(F.lit(a).alias("scheme"), F.lit(b).alias("term"), c.alias("value"))
                                             for a, b, c in cols])).alias("x"))
    return rows.groupBy("x.scheme", "x.term").agg(F.round(F.sum("x.value"), 6).alias("total"), F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ doc quality: lasso, forest, network

def _doc_splits(t):
    """Rows of the stratified splits: ``train, validation, train + validation, test``."""
    # the view's few columns are stored: every step of the splits, recipes and fits reads them again
    s = splits.initial_split(stored(t.doc_quality), ["doc_id"], 0.75, seed=123, strata=["label"])
    other = s.filter(F.col("split") == "train").drop("split")
    test = s.filter(F.col("split") == "test").drop("split")
    v = splits.validation_split(other, ["doc_id"], 0.8, seed=234, strata=["label"])
    tr, va = v.filter(F.col("val_split") == "train").drop("val_split"), v.filter(F.col("val_split") == "validation").drop("val_split")
    return tr, va, other, test


def _doc_prepared(rows, fresh, forest=False):
    """The recipe learned on ``rows`` and applied to them and to ``fresh``: ``names, rows, fresh``."""
    from pyspark.ml import Pipeline
    roles = ["label", "doc_id"]
    stages = [recipe.StepLabel("label", "good"), recipe.StepDate("arrival_date", ("dow", "month", "year")),
              recipe.StepHoliday("arrival_date", FEASTS), recipe.StepRm(["arrival_date"])]
    # a forest takes factors as they are; the others take dummies, normalised
    stages += [recipe.StepIndex(exclude=roles)] if forest else [
        recipe.StepDummy(exclude=roles), recipe.StepZv(exclude=roles), recipe.StepNormalize(exclude=roles)]
    stages.append(recipe.AssemblePredictors(exclude=roles))
    prep = Pipeline(stages=stages).fit(rows)
    sets = [prep.transform(x).select("doc_id", "label", "features") for x in (rows, fresh)]
    return (recipe.feature_names(prep), *sets)


def _doc_sets(t, forest=False):
    """Prepared features for tuning: ``names, train, validation``."""
    return _doc_prepared(*_doc_splits(t)[:2], forest)


def _lasso_tuning(t, sets=None):
    names, tr, va = sets or _doc_sets(t)
    return tune.tune_penalties(t.spark, tr, va, tune.penalty_grid())


def _rf_grid(names):
    return tune.latin_hypercube({"mtry": (1, max(2, len(names))), "min_n": (2, 40)}, 10, seed=345, integer=["mtry", "min_n"])


def _rf_tuning(t, sets):
    names, tr, va = sets
    return tune.tune_forests(t.spark, tr, va, _rf_grid(names), TREES)


#: trees of every forest, tuning candidates too, as in the analyses re-expressed here
TREES = 1000


@query("fit_lasso_logit", section="2.16")
def fit_lasso_logit(t):
    names, tr, *_ = _doc_sets(t)
    return penalty.tidy(t.spark, penalty.fit_path(tr, [0.001])[0], names)


@query("tune_grid_list", section="2.17")
def tune_grid_list(t):
    return _lasso_tuning(t)[0]


@query("collect_metrics", section="2.17")
def collect_metrics(t):
    return _lasso_tuning(t)[0].select("penalty", "metric", "mean", "n")


@query("show_best", section="2.17")
def show_best(t):
    return tune.show_best(_lasso_tuning(t)[0], 5)


@query("select_best", section="2.17")
def select_best(t):
    return tune.select_best(_lasso_tuning(t)[0])


@query("collect_predictions", section="2.17")
def collect_predictions(t):
    metrics_df, predictions = _lasso_tuning(t)
    best = tune.select_best(metrics_df).first()["candidate"]
    return predictions.filter(F.col("candidate") == best).drop("candidate")


@query("tune_grid_auto", section="2.17")
def tune_grid_auto(t):
    return _rf_tuning(t, _doc_sets(t, forest=True))[0]


@query("fit_rf", section="2.16")
def fit_rf(t):
    names, tr, *_ = _doc_sets(t, forest=True)
    return models.importance_rows(t.spark, names, forest.fit(tr, [forest.Spec(3, 5, TREES)]).importance())


@query("vip_forest", section="2.18")
def vip_forest(t):
    names, tr, *_ = _doc_sets(t, forest=True)
    return models.importance_rows(t.spark, names, forest.fit(tr, [forest.Spec(3, 5, TREES)]).importance(), top=20)


def _rf_last_fit(best, other, test):
    """The best forest's workflow, recipe and trees, refitted on train + validation: the test rows it scores once."""
    names, other, test = _doc_prepared(other, test, forest=True)
    final = forest.fit_score(other, [forest.Spec(int(best["mtry"]), int(best["min_n"]), TREES)], test)
    return final.withColumn("_truth", F.when(F.col("label") == 1.0, "good").otherwise("poor")).checkpoint(eager=True)


@query("last_fit", section="2.17")
def last_fit(t):
    # best forest refit on train + validation, scored once on the test rows
    tr, va, other, test = _doc_splits(t)
    best = tune.select_best(_rf_tuning(t, _doc_prepared(tr, va, forest=True))[0]).first()
    p = _rf_last_fit(best, other, test)
    return metrics.roc_auc(p, "_truth", "pred_event", "good").withColumn("n_test", F.lit(p.count()).cast("bigint"))


@query("children_lasso_rf", section="2.21")
def children_lasso_rf(t):
    # both models tuned and compared on the validation rows; then the last fit, of the forest, scored on the test rows
    tr, va, other, test = _doc_splits(t)
    rows, best = [], {}
    for name, mt in (("lasso", _lasso_tuning(t, _doc_prepared(tr, va))[0]), ("forest", _rf_tuning(t, _doc_prepared(tr, va, forest=True))[0])):
        best[name] = tune.select_best(mt).first()
        rows.append((name, int(best[name]["candidate"]), best[name]["mean"]))
    last = metrics.roc_auc(_rf_last_fit(best["forest"], other, test), "_truth", "pred_event", "good").first()["roc_auc"]
    rows.append(("last_fit", int(best["forest"]["candidate"]), last))
    return t.spark.createDataFrame([(m, c, None if a is None else float(a)) for m, c, a in rows], "model string, candidate int, roc_auc double")


@query("fit_mlp", section="2.16")
def fit_mlp(t):
    # one hidden unit with weight decay: weights in the order out, out bias, hidden bias, inputs
    names, tr, *_ = _doc_sets(t)
    fit = network.fit_all(tr, [0.01])[0]
    terms = ["hidden -> out", "bias -> out", "bias -> hidden", *names]
    return t.spark.createDataFrame([(n, float(x), fit.converged) for n, x in zip(terms, fit.weights)], "term string, weight double, converged boolean")


@query("vip_mlp", section="2.18")
def vip_mlp(t):
    names, tr, *_ = _doc_sets(t)
    return network.importance(t.spark, network.fit_candidates(tr, [0.01])[0], names)


@query("children_mlp", section="2.21")
def children_mlp(t):
    # ten penalties fitted side by side, scored on the validation rows
    names, tr, va, *_ = _doc_sets(t)
    grid = [{"penalty": 10 ** (k / 3 - 3)} for k in range(10)]
    fits = network.fit_all(tr, [g["penalty"] for g in grid])
    scores = F.array(*[F.struct(F.lit(k).alias("candidate"), network.probability(f.weights).alias("pred_event")) for k, f in enumerate(fits)])
    predictions = va.select("label", F.explode(scores).alias("s")).select("s.candidate", "label", "s.pred_event").checkpoint(eager=True)
    flags = t.spark.createDataFrame([(k, f.converged) for k, f in enumerate(fits)], "candidate int, converged boolean")
    return tune.tuning_table(t.spark, predictions, grid).join(flags, "candidate")


# ------------------------------------------------------------------ planted trees and curves

def _sim_tree(t):
    """Three factors and a class with planted odds x1 - x2 - x3, one row a line item."""
    li = t.lineitem
    x1 = F.pmod("l_linenumber", F.lit(4)) + 1
    x2 = F.pmod("l_partkey", F.lit(2)) + 1
    x3 = F.pmod("l_suppkey", F.lit(2)) + 1
    p = 1 / (1 + F.exp(-(x1 - x2 - x3).cast("double")))
    y = (hash_uniform(11, "l_orderkey", "l_linenumber") < p).cast("int")
    return li.select("l_orderkey", "l_linenumber", *[x.cast("string").alias(f"x{i}") for i, x in enumerate((x1, x2, x3), 1)], y.alias("y"))


def _tree(t):
    return cart.fit(_sim_tree(t), ["x1", "x2", "x3"], "y", ["l_orderkey", "l_linenumber"], min_split=5)


@query("fit_tree", section="2.16")
def fit_tree(t):
    # the pruned tree, node by node
    return _tree(t).frame(t.spark)


@query("tree_leaf_table", section="2.16")
def tree_leaf_table(t):
    # class counts of each leaf
    leaves = _tree(t).frame(t.spark).where("leaf")
    return leaves.select(F.col("node").alias("leaf"), F.explode(F.array(*[
        F.struct(F.lit(k).alias("label"), F.col(f"n{k}").alias("n")) for k in (0, 1)])).alias("x")).select("leaf", "x.label", "x.n")


@query("tree_cp_table", section="2.16")
def tree_cp_table(t):
    # every pruning of the tree with its cross-validated error
    return _tree(t).cp_table(t.spark)


@query("stat_smooth_glm", section="2.13")
def stat_smooth_glm(t):
    # logistic curve: P(y) = logistic(-1.6 + .03 x) planted on line items, fitted, predicted on a grid
    from pyspark.ml.feature import VectorAssembler
    x = 18 + 42 * hash_uniform(1, "l_orderkey", "l_linenumber")
    d = t.lineitem.select(x.alias("x"), "l_orderkey", "l_linenumber")
    d = d.withColumn("label", (hash_uniform(5, "l_orderkey", "l_linenumber") < 1 / (1 + F.exp(1.6 - 0.03 * F.col("x"))))
                     .cast("double"))
    va = VectorAssembler(inputCols=["x"], outputCol="features")
    m = models.logistic_glm().fit(va.transform(d))
    grid = expand_values(d.agg(F.min("x").alias("lo"), F.max("x").alias("hi")), "i", list(range(50)))
    grid = grid.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / 49).alias("x"))
    return m.transform(va.transform(grid)).select("x", F.col("prediction").alias("pred"))


@query("metric_set", section="2.20", sql=f"""
WITH s AS (SELECT pred_late AS th, count(*) FILTER (WHERE truth = 'late') AS e, count(*) FILTER (WHERE truth <> 'late') AS ne
           FROM {SCORED_SQL} GROUP BY 1),
c AS (SELECT *, coalesce(sum(ne) OVER (ORDER BY th ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT 'roc_auc' AS metric, round(sum(e * (below + 0.5 * ne)) / (sum(e) * sum(ne)), 6) AS estimate FROM c
UNION ALL SELECT 'accuracy', round(avg(CASE WHEN (pred_late > 0.5) = (truth = 'late') THEN 1.0 ELSE 0.0 END), 6) FROM {SCORED_SQL}""")
def metric_set(t):
    # metric_set(roc_auc, accuracy): a bundle of metric functions applied to one scored frame
    s = _scored(t).withColumn("estimate_class", F.when(F.col("pred_late") > 0.5, EVENT).otherwise(OTHER))
    bundle = {
        "roc_auc": lambda d: metrics.roc_auc(d, "truth", "pred_late", EVENT).first()[0],
        "accuracy": lambda d: d.agg(F.avg((F.col("estimate_class") == F.col("truth")).cast("double"))).first()[0],
    }
    rows = [(name, round(float(fn(s)), 6)) for name, fn in bundle.items()]
    return t.spark.createDataFrame(rows, "metric string, estimate double")
