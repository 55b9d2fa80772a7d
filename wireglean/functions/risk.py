"""The 0-100 risk score and its parts.

The parts are read from columns the scoring operator adds step by step (``_pps``,
``_severity`` and so on), and every formula names such a column as few times as it can:
a filter on the result is moved to the scan with all formulas written out.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions.numbers import case, finite_sql, lookup, text


def limited(value: str, low: float, high: float) -> str:
    """Limit to [low, high]. For values that are never null: ``least`` and ``greatest`` skip nulls."""
    return f"greatest({low!r}D, least({high!r}D, {value}))"


READINGS = {
    "_pps": "packets_per_second", "_bps": "bytes_per_second", "_density": "tcp_flag_density",
    "_ratio": "fwd_bwd_packet_ratio", "_sent": "total_fwd_packets", "_answered": "total_backward_packets",
}


def readings(columns: list[str]) -> dict[str, Column]:
    """What the traffic rules look at; absent, missing and infinite values read as 0."""
    return {
        alias: F.expr(f"coalesce({finite_sql(name)}, 0D)" if name in columns else "0D")
        for alias, name in READINGS.items()
    }


def traffic_rules() -> list[tuple[str, float, str]]:
    """(condition, points, text) of each red flag read off the flow itself."""
    return [
        (f"_pps > {tax.PACKET_RATE_ALERT}D", 30.0,
         "concat('High packet rate (', format_number(_pps, 0), ' pkt/s)')"),
        (f"_bps > {tax.BYTE_RATE_ALERT}D", 25.0,
         "concat('High byte rate (', format_number(_bps / 1e6D, 1), ' MB/s)')"),
        (f"_density > {tax.FLAG_DENSITY_ALERT}D", 20.0,
         "'Control-flag-dominated flow (near-zero payload)'"),
        (f"_ratio > {tax.ASYMMETRY_ALERT}D", 15.0,
         "concat('Extreme directional asymmetry (', format_number(_ratio, 0), ':1 fwd/bwd)')"),
        ("_answered = 0D AND _sent > 2D", 15.0,
         "'No response traffic - probe or half-open connection'"),
    ]


def traffic_points() -> Column:
    points = [case([(condition, f"{p}D")], "0D") for condition, p, _ in traffic_rules()]
    return F.expr(f"least(100D, {' + '.join(points)})")


def indicators() -> Column:
    """The texts of the rules that hold, and of the detector's flag, in this order."""
    found = [case([(condition, shown)]) for condition, _, shown in traffic_rules()]
    found.append(case([("is_anomaly", "'Flagged as anomalous by unsupervised detector'")]))
    return F.expr(f"array_compact(array({', '.join(found)}))")


def severity_points() -> Column:
    points = lookup({text(family): f"{float(p)}D" for family, p in tax.SEVERITY.items()}, "prediction")
    return F.expr(f"coalesce({points}, {float(tax.UNKNOWN_SEVERITY)}D)")


def confidence_points() -> Column:
    """A sure BENIGN lowers the risk; an attack counts from half confidence upwards."""
    benign = f"(1D - {limited('confidence', 0.0, 1.0)}) * 100D"
    attack = f"{limited('(confidence - 0.5D) / 0.5D', 0.0, 1.0)} * 100D"
    return F.expr(case([(f"prediction = {text(tax.BENIGN)}", benign)], attack))


def anomaly_points() -> Column:
    return F.expr(f"{limited('anomaly_score', 0.0, 1.0)} * 100D")


def blended_score() -> Column:
    """The weighted blend of the part columns as an integer; halves round to the even neighbour."""
    blend = " + ".join(f"{weight!r}D * _{part}" for part, weight in tax.RISK_WEIGHTS.items())
    damped = f"({blend}) * " + case([(f"prediction = {text(tax.BENIGN)} AND NOT is_anomaly", "0.5D")], "1D")
    floor = case([("is_anomaly", f"{tax.ANOMALY_FLOOR}D")], "0D")
    return F.expr(f"CAST(bround(least(100D, greatest({floor}, {damped})), 0) AS INT)")


def risk_level(score: str = "risk_score") -> Column:
    """The band of a score, looked up so that the score is named once."""
    names, low = [], 0
    for top, name in tax.RISK_BANDS:
        names += [text(name)] * (top + 1 - low)
        low = top + 1
    at = f"CAST(bround({limited(f'CAST({score} AS DOUBLE)', 0.0, 100.0)}, 0) AS INT)"
    return F.expr(f"get(array({', '.join(names)}), {at})")


def anomaly_band(score: str = "anomaly_score") -> Column:
    rules = [(f"{score} IS NULL", "NULL")]
    rules += [(f"{score} < {limit!r}D", text(name)) for limit, name in tax.ANOMALY_BANDS]
    return F.expr(case(rules, text(tax.ANOMALY_TOP_BAND)))
