"""Numeric reading and rounding, as Spark SQL expressions.

Expressions of many rules are written as SQL text: Spark parses one text per column, where a
chain of Column calls would cross to the JVM for every rule. Column names are plain
identifiers here, as header normalisation gives them.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = "double('Infinity')"


def named(column: str) -> str:
    return f"`{column}`"


def case(rules: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    """``CASE`` over (condition, value) pairs."""
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {otherwise} END"


def lookup(table: dict, key: str) -> str:
    """The value of a key in a literal table, or null: one small call in the generated code,
    where a branch per key would soon outgrow what the JVM compiles."""
    entries = ", ".join(f"{k}, {v}" for k, v in table.items())
    return f"try_element_at(map({entries}), {key})"


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values) -> str:
    return ", ".join(text(v) for v in values)


def known_sql(column: str) -> str:
    return f"nanvl(try_cast({named(column)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def number_or_sql(columns, name: str, default: float = 0.0) -> str:
    return f"coalesce({known_sql(name)}, {default!r}D)" if name in columns else f"{default!r}D"


def finite_sql(column: str) -> str:
    # Spark orders NaN above infinity, so this test refuses both.
    value = f"try_cast({named(column)} AS DOUBLE)"
    return f"CASE WHEN abs({value}) < {INFINITY} THEN {value} END"


def is_infinite_sql(column: str) -> str:
    return f"coalesce(abs(try_cast({named(column)} AS DOUBLE)) = {INFINITY}, false)"


def as_double(column: str) -> Column:
    """The value as a double, null when it is no number (infinities and NaN stay)."""
    return F.expr(f"try_cast({named(column)} AS DOUBLE)")


def known(column: str) -> Column:
    """A double with NaN turned into null; infinities stay."""
    return F.expr(known_sql(column))


def finite(column: str) -> Column:
    """A double with NaN and both infinities turned into null."""
    return F.expr(finite_sql(column))


def number_or(columns, name: str, default: float = 0.0) -> Column:
    """Column ``name`` as a number; ``default`` where it is absent, missing or no number."""
    return F.expr(number_or_sql(columns, name, default))
