"""Named sources and model references.

A ``Catalog`` maps logical names to locations (a source) or to functions
building a DataFrame from other models (a model). ``ref`` resolves lazily;
Spark's plan is the dependency graph, so there is no scheduler here.
Resolved models are also registered as temp views for SQL users.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Catalog:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._sources: dict[str, Callable[[], DataFrame]] = {}
        self._models: dict[str, Callable[["Catalog"], DataFrame]] = {}
        self._cache: dict[str, DataFrame] = {}

    def add_source(self, name: str, path: str | None = None,
                   loader: Callable[[], DataFrame] | None = None) -> "Catalog":
        if loader is None:
            loader = lambda p=path: self.spark.read.parquet(p)
        self._sources[name] = loader
        return self

    def add_model(self, name: str, build: Callable[["Catalog"], DataFrame]) -> "Catalog":
        self._models[name] = build
        return self

    def source(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._sources[name]()
        return self._cache[name]

    def ref(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self._models[name](self) if name in self._models else self.source(name)
            df.createOrReplaceTempView(name)
            self._cache[name] = df
        return self._cache[name]
