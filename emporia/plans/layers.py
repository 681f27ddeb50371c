"""Lazy, memoised layer views over one input: ``layers.silver[...]`` or
``layers.gold[...]`` builds only the plans a query asks for."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from emporia.plans.gold import GOLD_BUILDERS
from emporia.plans.silver import SILVER_BUILDERS
from emporia.sources.driver_tables import DriverTables
from emporia.sources.schemas import SOURCE_TABLES


class _Lazy(Mapping):
    def __init__(self, builders: dict[str, Callable[[Mapping], DataFrame]], upstream: Mapping):
        self._builders, self._up, self._memo = builders, upstream, {}

    def __getitem__(self, k: str) -> DataFrame:
        if k not in self._memo:
            self._memo[k] = self._builders[k](self._up)
        return self._memo[k]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


class _Bronze(Mapping):
    def __init__(self, tables: DriverTables):
        self._t, self._memo = tables, {}
        self._names = SOURCE_TABLES

    def __getitem__(self, k: str) -> DataFrame:
        if k not in self._memo:
            self._memo[k] = getattr(self._t, k)()
        return self._memo[k]

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)


class Layers:
    """Bronze (adapter or given frames) -> Silver -> Gold, all lazy."""

    def __init__(self, bronze: Mapping):
        self.bronze = bronze
        self.silver = _Lazy(SILVER_BUILDERS, self.bronze)
        self.gold = _Lazy(GOLD_BUILDERS, self.silver)

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "Layers":
        return cls(_Bronze(DriverTables(spark, sf_dir)))
