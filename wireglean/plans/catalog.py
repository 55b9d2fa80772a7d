"""The registry of checkable queries."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that gives the same rows where SQL can say it."""

    def keep(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


def r6(column: str | Column) -> Column:
    """Six digits, so that engines which add in another order agree."""
    name = F.col(column) if isinstance(column, str) else column
    return F.round(name, 6)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, small integers widened."""
    shown = []
    for name, dtype in df.dtypes:
        column = F.col(f"`{name}`")
        if dtype in ("double", "float"):
            column = F.round(column.cast("double"), digits)
        elif dtype in ("tinyint", "smallint", "int"):
            column = column.cast("bigint")
        shown.append(column.alias(name))
    return df.select(*shown)
