"""Registered queries: each binds a job to the driver tables and carries the
equivalent DuckDB SQL (or none, for jobs checked against brute force)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numeric import round_fp
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    doc: str


REGISTRY: dict[str, Entry] = {}


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (oracle comparisons hash values)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_fp(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return finish(fn(spark, sf))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, run, sql, (fn.__doc__ or "").strip())
        return run
    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules registers their queries
    from tessera.plans import (  # noqa: F401
        q_alerts,
        q_corpus,
        q_lexicon,
        q_matching,
        q_metrics,
        q_profile,
        q_registry,
        q_sources,
        q_streaming,
    )
    return REGISTRY
