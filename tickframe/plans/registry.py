"""Query registry: one entry per SURVEY §2 inventory id.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` plus, where SQL can
express it, the equivalent DuckDB SQL over the same Parquet tables.  Column
names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Uniform result types: DATE columns as ISO strings and every integer
    column as BIGINT, so results hash the same way whatever client reads
    them (the oracles use ``CAST(d AS VARCHAR)`` and BIGINT integers)."""
    conv = {}
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "date":
            conv[f.name] = df[f.name].cast("string")
        elif t in ("integer", "short", "byte"):
            conv[f.name] = df[f.name].cast("long")
    return df.withColumns(conv) if conv else df


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query id {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def oracle(name: str) -> str:
    """The SQL of a query that is registered already."""
    return _SQL[name]


PLAN_MODULES = ("prices", "io_plans", "relational", "aggregates", "windowed", "scalars", "corpus",
                "ordered", "series", "strategies", "ml_plans", "streams", "many_symbols")


def _load_all() -> None:
    # importing the plan modules fills the registry
    import importlib
    for m in PLAN_MODULES:
        importlib.import_module(f"tickframe.plans.{m}")


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
