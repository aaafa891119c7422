"""Registry of queries: name -> (callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.ctes import with_ctes
from bindings.inputs import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SOURCE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Output types both engines share: decimals as DOUBLE, dates and times as text."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind == "decimal":
            c = c.cast("double")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Inputs`` with the SQL that gives the same rows."""

    def wrap(fn: Callable[[Inputs], DataFrame]):
        key = name or fn.__name__
        assert key not in QUERIES, key
        QUERIES[key] = lambda spark, sf_dir: plain(fn(Inputs(spark, sf_dir)))
        SOURCE[key] = fn.__module__
        if sql is not None:
            ORACLES[key] = with_ctes(sql)
        return fn

    return wrap


# SQL text for the shared output types.
def dbl(expr: str, name: str) -> str:
    return f"cast({expr} as double) AS {name}"


def txt(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name}"


def tms(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def big(expr: str, name: str) -> str:
    return f"cast({expr} as bigint) AS {name}"
