"""tessera: a Spark-native toolkit for the analyst's path over large tables.

Read and reshape tables, recode columns with exact missing-value and
categorical-level semantics, count / rank / window / join, compute the
statistics behind common plots, and fit, tune, evaluate and explain models.
Every operation takes and returns Spark DataFrames built from built-in
expressions so that Catalyst can optimise the whole plan.
"""

__version__ = "0.1.0"
