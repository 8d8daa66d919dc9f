"""Collects the bound queries of every plan module and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

#: Modules of ``fieldspark.plans`` that bind operators to the tables.
MODULES: tuple[str, ...] = ("counting", "history", "spatial", "evaluation", "imputing", "archives", "stages", "shapes", "cleaning", "measures")


@dataclass
class Registry:
    """Query callables and oracle SQL of one plan module, filled by the ``bind`` decorator."""

    queries: dict[str, Query]
    oracle: dict[str, str]

    @classmethod
    def new(cls) -> Registry:
        return cls({}, {})

    def bind(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a query under ``name``, with the SQL that must give the same rows."""

        def add(func: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is bound twice")
            self.queries[name] = func
            if sql is not None:
                self.oracle[name] = sql
            return func

        return add


def _registries() -> list[Registry]:
    return [import_module(f"fieldspark.plans.{m}").REGISTRY for m in MODULES]


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for r in _registries():
        if twice := out.keys() & r.queries.keys():
            raise ValueError(f"bound in two modules: {sorted(twice)}")
        out.update(r.queries)
    return out


def oracle_sql() -> dict[str, str]:
    return {k: v for r in _registries() for k, v in r.oracle.items()}
