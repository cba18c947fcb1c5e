"""The model graph as named views of a session, for queries written in SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def register(models: Mapping[str, DataFrame], names: Iterable[str] | None = None, prefix: str = "") -> list[str]:
    """Makes each model a temporary view ``<prefix><model>`` of its session (replacing one of that
    name). A view is the model's plan, not its rows: Catalyst plans a query over it as a whole."""
    out = []
    for name in names if names is not None else models:
        models[name].createOrReplaceTempView(f"{prefix}{name}")
        out.append(f"{prefix}{name}")
    return out


def drop(spark: SparkSession, views: Iterable[str]) -> None:
    for name in views:
        spark.catalog.dropTempView(name)


def query(spark: SparkSession, models: Mapping[str, DataFrame], names: Iterable[str], sql: str) -> DataFrame:
    """``sql`` over the named models. Its views are the session's only while it is analysed, under
    the models' own names; an older view of such a name is put back."""
    names = list(names)
    before = {n: spark.table(n) for n in names if spark.catalog.tableExists(n)}
    views = register(models, names)
    try:
        return spark.sql(sql)
    finally:
        drop(spark, views)
        register(before)
