"""Scalar column expressions.

Everything here is a built-in Spark SQL expression, evaluated JVM-side inside
whole-stage codegen; no Python UDF anywhere. The wider expressions (CASE
chains, weighted sums) are written as SQL text and parsed once by the JVM
(``F.expr``), which keeps building a query cheap: composing them from Column
objects costs one Python-to-JVM round trip per node.

Arguments are column names. Two null families are kept apart on purpose:

* dashboard / ICU flags follow the pandas-style rule "a comparison with a
  missing value is False": :func:`flag_sql` wraps the predicate in
  ``coalesce(pred, false)`` and NaN is treated as missing;
* the traffic batch-job flag (``severe_event``) keeps Spark's three-valued logic.

NaN is also turned into NULL at ingestion (:func:`nan_to_null`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import schemas as S


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def dbl(x: float) -> str:
    """A double literal (same value as ``F.lit(float)``)."""
    return f"{float(x)!r}D"


def nan_to_null_sql(name: str) -> str:
    return f"nanvl({q(name)}, CAST(NULL AS DOUBLE))"


def nan_to_null(name: str) -> Column:
    """NaN -> NULL for a double column (other values unchanged)."""
    return F.expr(nan_to_null_sql(name))


def clean_doubles(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """NaN -> NULL in the double columns (or those of them in ``names``); one projection, no extra pass."""
    return df.select(
        *[
            nan_to_null(f.name).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and (names is None or f.name in names)
            else F.col(q(f.name))
            for f in df.schema.fields
        ]
    )


def flag_sql(predicate_sql: str) -> str:
    """A boolean that is False where the predicate is NULL (missing input)."""
    return f"coalesce({predicate_sql}, false)"


def clamp(col: Column | str, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (greatest/least would skip it)."""
    x = F.col(col) if isinstance(col, str) else col
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x))
    )


def clamp_sql(x_sql: str, lo: float, hi: float) -> str:
    return f"CASE WHEN ({x_sql}) IS NULL THEN CAST(NULL AS DOUBLE) ELSE greatest({dbl(lo)}, least({dbl(hi)}, {x_sql})) END"


def right_closed_band_sql(name: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    x = q(name)
    arms = " ".join(
        f"WHEN {x} > {dbl(lo)} AND {x} <= {dbl(hi)} THEN '{label}'"
        for lo, hi, label in zip(edges[:-1], edges[1:], labels)
    )
    return f"CASE {arms} ELSE CAST(NULL AS STRING) END"


def right_closed_band(name: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval (edges[i], edges[i+1]] holding the value.

    Values outside (edges[0], edges[-1]] and NULL get NULL.
    """
    return F.expr(right_closed_band_sql(name, edges, labels))


def congestion_band(density: str = "traffic_density") -> Column:
    """Congestion label of a density (right-closed bands)."""
    return right_closed_band(density, S.CONGESTION_BAND_EDGES, S.CONGESTION_BAND_LABELS)


def severity_band(risk: str = "mortality_risk") -> Column:
    """ICU severity label of a mortality risk (right-closed bands)."""
    return right_closed_band(risk, S.SEVERITY_BAND_EDGES, S.SEVERITY_BAND_LABELS)


def hour_floor_sql(ts: str) -> str:
    t = q(ts)
    return f"make_timestamp_ntz(year({t}), month({t}), day({t}), hour({t}), 0, 0)"


def hour_floor(ts: str) -> Column:
    """Truncate a timestamp_ntz to the hour, staying timestamp_ntz.

    ``date_trunc`` returns a zoned timestamp and would tie the result to the
    session time zone; building the value from its fields does not.
    """
    return F.expr(hour_floor_sql(ts))


def is_anomaly(score: str = "ai_anomaly_score") -> Column:
    """Anomaly flag: score at or above the threshold; missing or NaN is False."""
    return F.expr(flag_sql(f"{nan_to_null_sql(score)} >= {dbl(S.ANOMALY_THRESHOLD)}"))


def is_high_congestion(level: str = "congestion_level") -> Column:
    """High or Critical congestion level; missing is False."""
    levels = ", ".join(f"'{v}'" for v in S.HIGH_CONGESTION_LEVELS)
    return F.expr(flag_sql(f"{q(level)} IN ({levels})"))


def congestion_weight(level: str = "congestion_level") -> Column:
    """Ordinal congestion weight (Critical 4, High 3, Moderate 2, anything else 1)."""
    arms = " ".join(f"WHEN {q(level)} = '{label}' THEN {w}" for label, w in S.CONGESTION_WEIGHTS.items())
    return F.expr(f"CASE {arms} ELSE {S.DEFAULT_CONGESTION_WEIGHT} END")


def risk_index(
    density: str = "traffic_density",
    speed: str = "average_speed",
    wait: str = "signal_wait_time",
    accident: str = "accident_probability",
    anomaly: str = "ai_anomaly_score",
) -> Column:
    """Weighted risk index rounded to 4 dp (HALF_UP)."""
    w = S.RISK_INDEX_WEIGHTS
    raw = (
        f"((((({q(density)} / 100) * {dbl(w['density'])})"
        f" + (((110 - {q(speed)}) / 110) * {dbl(w['speed'])}))"
        f" + (({q(wait)} / 180) * {dbl(w['wait'])}))"
        f" + ({q(accident)} * {dbl(w['accident'])}))"
        f" + ({q(anomaly)} * {dbl(w['anomaly'])})"
    )
    return F.expr(f"round({raw}, 4)")


def severe_event(
    risk: str = "risk_index",
    anomaly: str = "ai_anomaly_score",
    speed: str = "average_speed",
    density: str = "traffic_density",
) -> Column:
    """Severe flag with Spark's three-valued OR (uses the rounded risk index)."""
    return F.expr(
        f"(({q(risk)} >= {dbl(S.SEVERE_RISK_THRESHOLD)}) OR ({q(anomaly)} >= {dbl(S.SEVERE_ANOMALY_THRESHOLD)}))"
        f" OR (({q(speed)} <= {dbl(S.SEVERE_MAX_SPEED)}) AND ({q(density)} >= {dbl(S.SEVERE_MIN_DENSITY)}))"
    )


def percentage(part: str, whole: str) -> Column:
    """part / whole * 100; NULL when whole is 0 (ANSI division would raise)."""
    return F.expr(f"try_divide({q(part)}, {q(whole)}) * 100")


def peak_multiplier_sql(hour_sql: str) -> str:
    cond = " OR ".join(f"({hour_sql} BETWEEN {lo} AND {hi})" for lo, hi in S.PEAK_HOUR_RANGES)
    return f"CASE WHEN {cond} THEN {dbl(S.PEAK_MULTIPLIER)} ELSE {dbl(S.OFF_PEAK_MULTIPLIER)} END"


def peak_multiplier(hour: str) -> Column:
    """Peak-hour multiplier of an hour-of-day column."""
    return F.expr(peak_multiplier_sql(q(hour)))


def accident_risk_score(density: str, wait: str, road_risk: str) -> Column:
    """Noise-free accident probability: .03 + d/260 + w/750 + road risk, clip 0..0.98, 4 dp."""
    raw = (
        f"((({dbl(S.ACCIDENT_SCORE_BASE)} + ({q(density)} / {S.ACCIDENT_SCORE_DENSITY_DIVISOR}))"
        f" + ({q(wait)} / {S.ACCIDENT_SCORE_WAIT_DIVISOR})) + {q(road_risk)})"
    )
    return F.expr(f"round({clamp_sql(raw, 0.0, S.ACCIDENT_PROB_MAX)}, 4)")


def anomaly_score(density: str, wait: str, speed: str, accident: str) -> Column:
    """Noise-free composite anomaly score, clip 0..1, 4 dp."""
    w = S.ANOMALY_SCORE_WEIGHTS
    raw = (
        f"((((({q(density)} / 100) * {dbl(w['density'])}) + (({q(wait)} / 180) * {dbl(w['wait'])}))"
        f" + ((1 - ({q(speed)} / 110)) * {dbl(w['speed'])})) + ({q(accident)} * {dbl(w['accident'])}))"
    )
    return F.expr(f"round({clamp_sql(raw, 0.0, 1.0)}, 4)")


def icu_severity_sql(
    heart_rate: str = "heart_rate",
    systolic_bp: str = "systolic_bp",
    spo2: str = "oxygen_saturation",
    lactate: str = "lactate_mmol_l",
    resp_rate: str = "respiratory_rate",
) -> str:
    w = S.ICU_SEVERITY_WEIGHTS
    raw = (
        f"((((((({q(heart_rate)} - 60) / 130) * {dbl(w['heart_rate'])})"
        f" + (((130 - {q(systolic_bp)}) / 90) * {dbl(w['systolic_bp'])}))"
        f" + (((100 - {q(spo2)}) / 45) * {dbl(w['spo2'])}))"
        f" + (({q(lactate)} / 14) * {dbl(w['lactate'])}))"
        f" + (({q(resp_rate)} / 48) * {dbl(w['resp_rate'])}))"
    )
    return clamp_sql(raw, 0.0, 1.0)


def icu_severity_score(**names: str) -> Column:
    """Noise-free ICU severity, clip 0..1, unrounded."""
    return F.expr(icu_severity_sql(**names))


def shock_index(heart_rate: str = "heart_rate", systolic_bp: str = "systolic_bp") -> Column:
    """heart_rate / systolic_bp; a 0 (or NULL) pressure gives NULL."""
    return F.expr(f"try_divide({q(heart_rate)}, {q(systolic_bp)})")


def batch_alert(
    shock: str = "shock_index",
    spo2: str = "oxygen_saturation",
    lactate: str = "lactate_mmol_l",
    critical: str = "critical_event",
) -> Column:
    """ICU alert: shock index, low SpO2, high lactate or a critical event; missing parts count as False."""
    return F.expr(
        f"{flag_sql(nan_to_null_sql(shock) + ' >= ' + dbl(S.SHOCK_INDEX_ALERT))}"
        f" OR {flag_sql(nan_to_null_sql(spo2) + ' <= ' + dbl(S.SPO2_ALERT_MAX))}"
        f" OR {flag_sql(nan_to_null_sql(lactate) + ' >= ' + dbl(S.LACTATE_ALERT))}"
        f" OR {flag_sql(q(critical))}"
    )
