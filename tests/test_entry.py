"""The driver contract: entry() runs, every oracle key has a query, and a sample of queries run at sf0.001."""

import importlib.util
import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = load_entry()
    df = mod.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"cut", "mean_lprice", "mean_carat"}


def test_oracle_keys_subset():
    mod = load_entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 200


@pytest.mark.parametrize("key", ["count_by", "min_rank", "complete_keys", "stat_boxplot", "roc_auc", "skim",
                                 "month_dest_heat", "fill_down"])
def test_sample_queries_run(spark, sf_dir, key):
    mod = load_entry()
    df = mod.queries()[key](spark, sf_dir)
    assert df.count() >= 0 and len(df.columns) > 0
