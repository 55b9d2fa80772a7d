"""Service buckets, protocol names and the derived rate features."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions.numbers import INFINITY, case, known_sql, lookup, number_or_sql, text


def port_category_sql(number: str) -> str:
    service = lookup({f"{p}D": text(name) for name, ports in tax.SERVICE_PORTS for p in ports}, number)
    rules = [(f"{number} BETWEEN {low}D AND {high}D", text(bucket)) for bucket, low, high in tax.PORT_RANGES]
    rules += [(f"{number} >= {tax.FIRST_EPHEMERAL_PORT}D", "'ephemeral'")]
    return f"coalesce({service}, {case(rules, text('unknown'))})"


def port_category(number: str) -> Column:
    """The service bucket of a column of port numbers; a missing or negative port is ``unknown``."""
    return F.expr(port_category_sql(number))


def protocol_name_sql(column: str, number: str) -> str:
    name = lookup({f"{value}D": text(name) for value, name in tax.PROTOCOL_NAMES.items()}, number)
    rules = [(f"{number} IS NOT NULL", "'other'"),
             (f"{column} IS NULL OR lower(CAST({column} AS STRING)) = 'nan'", "'unknown'")]
    return f"coalesce({name}, {case(rules, f'CAST({column} AS STRING)')})"


def protocol_name(column: str) -> Column:
    """Decided row by row, so a batch and a stream agree: a number becomes its name or
    ``other``, a missing value ``unknown``, and text stays as it is."""
    return F.expr(protocol_name_sql(column, known_sql(column)))


def readings(columns: list[str]) -> dict[str, Column]:
    """The raw counts the features are made of, read safely, under names of their own.

    They are columns first because each is used several times.
    """

    def count(name: str, default: float = 0.0) -> str:
        return number_or_sql(columns, name, default)

    found = {
        "_fwd": count("total_fwd_packets"),
        "_bwd": count("total_backward_packets"),
        "_fwd_bytes": count("total_length_of_fwd_packets"),
        "_bwd_bytes": count("total_length_of_bwd_packets"),
        "_seconds": f"abs({count('flow_duration')}) / 1e6D",
        "_flags": " + ".join(count(c) for c in tax.FLAG_COUNTS),
        "_port": count("destination_port", -1.0),
        "_protocol": known_sql("protocol") if "protocol" in columns else "CAST(NULL AS DOUBLE)",
    }
    return {name: F.expr(sql) for name, sql in found.items()}


def derived_columns(columns: list[str]) -> dict[str, Column]:
    """The derived features, as expressions over :func:`readings`; a division by zero gives null."""
    tiny = f"{tax.EPSILON!r}D"

    def capped(rate: str) -> str:
        return f"CASE WHEN abs({rate}) < {INFINITY} THEN least({rate}, {tax.RATE_CEILING!r}D) END"

    size = f"try_divide(_fwd_bytes + _bwd_bytes, _fwd + _bwd + {tiny})"
    found = {
        "duration_seconds": "_seconds",
        "packets_per_second": capped(f"try_divide(_fwd + _bwd, _seconds + {tiny})"),
        "bytes_per_second": capped(f"try_divide(_fwd_bytes + _bwd_bytes, _seconds + {tiny})"),
        "fwd_bwd_packet_ratio": capped("try_divide(_fwd, _bwd + 1D)"),
        "fwd_bwd_byte_ratio": capped("try_divide(_fwd_bytes, _bwd_bytes + 1D)"),
        "avg_packet_size_derived": size,
        "tcp_flag_density": f"try_divide(_flags, _fwd + _bwd + {tiny})",
        "bytes_per_packet": size,
        "is_ephemeral_port": f"CAST(_port >= {tax.FIRST_EPHEMERAL_PORT}D AS TINYINT)",
        "port_category": port_category_sql("_port"),
        "protocol": protocol_name_sql("protocol", "_protocol") if "protocol" in columns else "'unknown'",
    }
    return {name: F.expr(sql) for name, sql in found.items()}
