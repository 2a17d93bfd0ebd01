"""Registry of the runnable queries and the SQL that states each result independently."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sunledger.plans.oracle_views import with_views
from sunledger.plans.views import Tables

Runner = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Runner
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query. ``covers`` lists inventory ids; ``sql`` may use the oracle views by name."""

    def register(run: Runner) -> Runner:
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(name, tuple(covers.split()), run, with_views(sql) if sql else None)
        return run

    return register


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return CATALOG[name].run(Tables(spark, sf_dir))

    return call
