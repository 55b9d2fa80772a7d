"""Checking single flow records against the field bounds."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions.numbers import as_double


def _reason(flows: DataFrame, field: str) -> Column:
    """Why the field is refused, or null; the text never repeats the value."""
    required = field in tax.REQUIRED_FIELDS
    if field not in flows.columns:
        return F.lit("missing") if required else F.lit(None).cast("string")
    given, number = F.col(field), as_double(field)
    low, high = tax.FIELD_BOUNDS[field]
    reason = F.when(given.isNull(), F.lit("missing") if required else F.lit(None).cast("string"))
    reason = reason.when(number.isNull(), "not a number")
    reason = reason.when(F.isnan(number) | (F.abs(number) == float("inf")), "not finite")
    if field in tax.INTEGER_FIELDS:
        reason = reason.when(number != F.floor(number), "not a whole number")
    reason = reason.when(number < float(low), f"below {low:g}")
    return reason.when(number > float(high), f"above {high:g}")


def _fits(flows: DataFrame, field: str) -> Column:
    """Whether the field is accepted: the same rule as a plain comparison (NaN and infinities lie outside of all bounds)."""
    required = field in tax.REQUIRED_FIELDS
    if field not in flows.columns:
        return F.lit(not required)
    number, (low, high) = as_double(field), tax.FIELD_BOUNDS[field]
    inside = number.between(float(low), float(high)) & (F.abs(number) < float("inf"))
    if field in tax.INTEGER_FIELDS:
        inside &= number == F.floor(number)
    return F.when(F.col(field).isNull(), F.lit(not required)).otherwise(F.coalesce(inside, F.lit(False)))


def with_problems(flows: DataFrame) -> DataFrame:
    """Add ``problems``: one (field, reason) for each refused field."""
    # Each rule stands in the plan once: the array is made first and sifted afterwards.
    checks = [F.struct(F.lit(field).alias("field"), _reason(flows, field).alias("reason")) for field in tax.FIELD_BOUNDS]
    return flows.withColumn("problems", F.filter(F.array(*checks), lambda check: check["reason"].isNotNull()))


def valid_and_refused(flows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows without problems, and the others with theirs.

    Rows are told apart by one comparison a field, which stops at the first refusal; reasons are made for refused rows only.
    """
    fits = reduce(lambda a, b: a & b, [_fits(flows, field) for field in tax.FIELD_BOUNDS])
    return flows.where(fits), with_problems(flows.where(~fits))
