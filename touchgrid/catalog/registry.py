"""Registry of runnable queries: one Spark job plus, where possible, its SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchgrid.catalog import domain
from touchgrid.session import prepare

_QUERIES: dict[str, Callable[[domain.Domain], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_COVERS: dict[str, tuple[str, ...]] = {}


def portable(df: DataFrame) -> DataFrame:
    """Result types both engines print the same way."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("~"))), "|")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, covers: str, oracle: str | None = None, views: dict[str, str] | None = None):
    """Register `fn(domain) -> DataFrame` under `name`; `covers` lists inventory ids."""

    def wrap(fn: Callable[[domain.Domain], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        _COVERS[name] = tuple(covers.split())
        if oracle is not None:
            _ORACLES[name] = domain.ctes(oracle, views)
        return fn

    return wrap


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(domain.Domain(prepare(spark), sf_dir)))

        return run

    return {n: runner(f) for n, f in _QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


def coverage() -> dict[str, tuple[str, ...]]:
    return dict(_COVERS)
