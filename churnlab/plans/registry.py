"""Query registry: one Spark builder and (where SQL can express it) one DuckDB
oracle per operator key of the survey. ``__spark_entry__`` only wires this."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None = None
    round_cols: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, round_cols: tuple[str, ...] = ()):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Query(name, fn, sql, tuple(round_cols))
        return fn
    return deco


def _rounded_spark(q: Query) -> Builder:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = q.build(spark, sf_dir)
        if q.round_cols:
            df = df.withColumns({c: F.round(F.col(c), 6) for c in q.round_cols})
        return df
    return run


def _rounded_sql(q: Query) -> str:
    if not q.round_cols:
        return q.sql
    repl = ", ".join(f"round({c}, 6) AS {c}" for c in q.round_cols)
    return f"SELECT * REPLACE ({repl}) FROM ({q.sql}) q"


def queries() -> dict[str, Builder]:
    _load_all()
    return {name: _rounded_spark(q) for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: _rounded_sql(q) for name, q in REGISTRY.items() if q.sql}


def _load_all() -> None:
    # Importing the query modules registers their entries.
    from churnlab.plans import queries_features  # noqa: F401
    from churnlab.plans import queries_prep  # noqa: F401
    from churnlab.plans import queries_eval  # noqa: F401
    from churnlab.plans import queries_quality  # noqa: F401
    from churnlab.plans import queries_models  # noqa: F401
    from churnlab.plans import queries_sources  # noqa: F401
