"""Parquet scans of the base tables.

A scan is lazy: Catalyst prunes columns and pushes filters into the Parquet
reader, so a view that touches three columns reads three columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def scan_parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full-table scan of one typed table (``scan_parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessors for the base tables and the derived views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            df = scan_parquet(self.spark, self.sf_dir, name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    # derived views (FIXTURES.md part C); see tessera.sources.views
    @cached_property
    def deliveries(self) -> DataFrame:
        from tessera.sources import views
        return views.deliveries(self)

    @cached_property
    def known_brands(self) -> DataFrame:
        from tessera.sources import views
        return views.known_brands(self)

    @cached_property
    def known_suppliers(self) -> DataFrame:
        from tessera.sources import views
        return views.known_suppliers(self)

    @cached_property
    def daily_events(self) -> DataFrame:
        from tessera.sources import views
        return views.daily_events(self)

    @cached_property
    def gems(self) -> DataFrame:
        from tessera.sources import views
        return views.gems(self)

    @cached_property
    def survey(self) -> DataFrame:
        from tessera.sources import views
        return views.survey(self)

    @cached_property
    def stocks_q(self) -> DataFrame:
        from tessera.sources import views
        return views.stocks_q(self)

    @cached_property
    def doc_quality(self) -> DataFrame:
        from tessera.sources import views
        return views.doc_quality(self)

    @cached_property
    def sessions_in(self) -> DataFrame:
        from tessera.sources import views
        return views.sessions_in(self)
