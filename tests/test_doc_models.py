"""Tuned models of document quality: splits, recipes learned where they should be, the last fit."""

import datetime
from types import SimpleNamespace

import numpy as np
import pytest

from tessera.ml import metrics
from tessera.workloads import ml_q

KIND = "doc_id bigint, label string, lang string, source string, n_chars double, toxic bigint, arrival_date date"


def docs(spark, source=lambda i: f"s{i % 3}"):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        n = float(rng.integers(10, 400))
        rows.append((i, "good" if rng.random() < 0.3 + n / 600 else "poor", f"l{i % 2}", source(i), n, int(rng.integers(0, 2)),
                     datetime.date(2017, 1, 1) + datetime.timedelta(days=i)))
    return spark.createDataFrame(rows, KIND)


def test_both_models_are_compared_and_the_forest_is_fitted_last(spark, monkeypatch):
    monkeypatch.setattr(ml_q, "TREES", 20)
    t = SimpleNamespace(spark=spark, doc_quality=docs(spark).cache())
    got = {r["model"]: r for r in ml_q.children_lasso_rf(t).collect()}
    assert list(got) == ["lasso", "forest", "last_fit"] and got["last_fit"]["candidate"] == got["forest"]["candidate"]
    alone = ml_q.last_fit(t).first()
    assert alone["n_test"] == 240 - sum(int(n * 0.75) for (n,) in t.doc_quality.groupBy("label").count().select("count").collect())
    assert got["last_fit"]["roc_auc"] == pytest.approx(alone["roc_auc"], abs=1e-3) and 0.5 < alone["roc_auc"] < 1


def test_the_last_fit_learns_its_recipe_from_training_and_validation_rows(spark, monkeypatch):
    tr, va, other, test = ml_q._doc_splits(SimpleNamespace(spark=spark, doc_quality=docs(spark)))
    some = va.orderBy("doc_id").first()["doc_id"]  # splits go by doc_id and label
    tr, va, other, test = ml_q._doc_splits(SimpleNamespace(spark=spark, doc_quality=docs(spark, lambda i: "only" if i == some else f"s{i % 3}")))
    assert va.where("source = 'only'").count() == 1

    def levels(d):
        return next(a["vals"] for a in d.schema["features"].metadata["ml_attr"]["attrs"]["nominal"] if a["name"] == "source_ix")

    assert "only" not in levels(ml_q._doc_prepared(tr, va, forest=True)[1])
    seen = {}
    plain = ml_q._doc_prepared
    monkeypatch.setattr(ml_q, "_doc_prepared", lambda *a, **k: seen.setdefault("sets", plain(*a, **k)))
    monkeypatch.setattr(ml_q, "TREES", 3)
    p = ml_q._rf_last_fit({"mtry": 3, "min_n": 5}, other, test)
    assert "only" in levels(seen["sets"][1]) and p.count() == test.count()
    assert metrics.roc_auc(p, "_truth", "pred_event", "good").first()[0] > 0
