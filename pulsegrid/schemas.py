"""Explicit schemas and the fixed domain values of the telemetry data model.

No schema is ever inferred: inference costs an extra pass over the input and a
single stray token (``nan``) silently turns a double column into a string.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source data model exactly (labels, band
# edges, thresholds, lookup weights); they are listed plainly, in their natural
# order, and are not derived from anything.
# ---------------------------------------------------------------------------
CITY_ZONES = [
    "Neon North",
    "Quantum Square",
    "Metro Central",
    "Skyline East",
    "Hyperloop West",
    "Aurora Industrial",
    "Solaris South",
    "Cyber Harbor",
]
VEHICLE_TYPES = ["Car", "Bus", "Truck", "Motorbike", "EV Shuttle", "Autonomous Cab"]
WEATHER_CONDITIONS = ["Clear", "Cloudy", "Rain", "Fog", "Storm", "Heatwave"]
ROAD_CONDITIONS = ["Smooth", "Wet", "Under Repair", "Potholes", "Low Visibility"]
CONGESTION_LEVELS = ["Low", "Moderate", "High", "Critical"]
HIGH_CONGESTION_LEVELS = ["High", "Critical"]

# Congestion bands over traffic density, right-closed: (-1,35] (35,60] (60,80] (80,101]
CONGESTION_BAND_EDGES = [-1.0, 35.0, 60.0, 80.0, 101.0]
CONGESTION_BAND_LABELS = ["Low", "Moderate", "High", "Critical"]

# Ordinal congestion weights; anything else (including NULL) weighs 1
CONGESTION_WEIGHTS = {"Critical": 4, "High": 3, "Moderate": 2}
DEFAULT_CONGESTION_WEIGHT = 1

ANOMALY_THRESHOLD = 0.78

# Risk index weights: density/100, (110-speed)/110, wait/180, accident prob, anomaly score
RISK_INDEX_WEIGHTS = {"density": 0.32, "speed": 0.22, "wait": 0.18, "accident": 0.18, "anomaly": 0.10}
SEVERE_RISK_THRESHOLD = 0.72
SEVERE_ANOMALY_THRESHOLD = 0.82
SEVERE_MAX_SPEED = 15.0
SEVERE_MIN_DENSITY = 80.0

# Peak hours 7-10 and 17-20 inclusive
PEAK_HOUR_RANGES = [(7, 10), (17, 20)]
PEAK_MULTIPLIER = 1.32
OFF_PEAK_MULTIPLIER = 0.9

# Lookup weights for the condition-pressure enrichment
ZONE_PRESSURE = {
    "Metro Central": 14,
    "Quantum Square": 11,
    "Cyber Harbor": 8,
    "Neon North": 7,
    "Hyperloop West": 6,
    "Skyline East": 5,
    "Aurora Industrial": 9,
    "Solaris South": 3,
}
WEATHER_PRESSURE = {"Storm": 18, "Rain": 11, "Fog": 9, "Heatwave": 6}
DEFAULT_WEATHER_PRESSURE = 0
ROAD_RISK = {"Smooth": 0.02, "Wet": 0.08, "Under Repair": 0.11, "Potholes": 0.13, "Low Visibility": 0.15}

# Value ranges (clip bounds) of the telemetry columns
SPEED_MIN, SPEED_MAX = 3.0, 110.0
ACCIDENT_PROB_MAX = 0.98
HISTOGRAM_MAX_BINS = 45

# Weights of the noise-free accident and anomaly scores
ACCIDENT_SCORE_BASE, ACCIDENT_SCORE_DENSITY_DIVISOR, ACCIDENT_SCORE_WAIT_DIVISOR = 0.03, 260, 750
ANOMALY_SCORE_WEIGHTS = {"density": 0.35, "wait": 0.25, "speed": 0.22, "accident": 0.18}

# Rolling zone window: the current event and the 5 before it
ROLLING_EVENTS = 6

# Forecast: 24 most recent hourly rows, 6-row mean and momentum, 12 hours ahead
FORECAST_RECENT_ROWS = 24
FORECAST_WINDOW = 6
FORECAST_PERIODS = 12
FORECAST_MIN, FORECAST_MAX = 0.0, 100.0

# Default top-k sizes
HOTSPOT_LIMIT = 8
TOP_ANOMALY_LIMIT = 20
TOP_ZONE_LIMIT = 8
PIPELINE_ANOMALY_LIMIT = 100

# ICU domain
ICU_UNITS = ["Cardiac ICU", "Neuro ICU", "Trauma ICU", "Pediatric ICU", "Medical ICU", "Surgical ICU"]
DIAGNOSES = ["Sepsis", "Respiratory Failure", "Stroke", "Cardiac Arrest", "Trauma", "Post Surgery"]
VENTILATION_STATUS = ["Room Air", "Oxygen Mask", "Non-invasive", "Ventilator"]
ICU_DEFAULT_SLICES = 8

# ICU severity bands over mortality risk, right-closed: (-0.01,.33] (.33,.66] (.66,1.01]
SEVERITY_BAND_EDGES = [-0.01, 0.33, 0.66, 1.01]
SEVERITY_BAND_LABELS = ["Stable", "Watchlist", "Critical"]

# Batch alert thresholds
SHOCK_INDEX_ALERT = 0.9
SPO2_ALERT_MAX = 88.0
LACTATE_ALERT = 4.0
CRITICAL_RISK_THRESHOLD = 0.72

# ICU severity score weights: (hr-60)/130, (130-bp)/90, (100-spo2)/45, lactate/14, rr/48
ICU_SEVERITY_WEIGHTS = {"heart_rate": 0.18, "systolic_bp": 0.22, "spo2": 0.26, "lactate": 0.22, "resp_rate": 0.12}

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
TRAFFIC_SCHEMA = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("city_zone", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("traffic_density", T.DoubleType()),
        T.StructField("average_speed", T.DoubleType()),
        T.StructField("weather_condition", T.StringType()),
        T.StructField("road_condition", T.StringType()),
        T.StructField("signal_wait_time", T.DoubleType()),
        T.StructField("accident_probability", T.DoubleType()),
        T.StructField("congestion_level", T.StringType()),
        T.StructField("ai_anomaly_score", T.DoubleType()),
    ]
)
TRAFFIC_COLUMNS = TRAFFIC_SCHEMA.fieldNames()

ICU_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("admission_timestamp", T.TimestampNTZType()),
        T.StructField("icu_unit", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("diagnosis", T.StringType()),
        T.StructField("heart_rate", T.DoubleType()),
        T.StructField("systolic_bp", T.DoubleType()),
        T.StructField("respiratory_rate", T.DoubleType()),
        T.StructField("oxygen_saturation", T.DoubleType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("glucose_mg_dl", T.DoubleType()),
        T.StructField("lactate_mmol_l", T.DoubleType()),
        T.StructField("ventilation_status", T.StringType()),
        T.StructField("length_of_stay_hours", T.DoubleType()),
        T.StructField("mortality_risk", T.DoubleType()),
        T.StructField("critical_event", T.BooleanType()),
    ]
)
ICU_COLUMNS = ICU_SCHEMA.fieldNames()

PREPARED_EXTRA = T.StructType(
    [
        T.StructField("hour", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("is_high_congestion", T.BooleanType()),
    ]
)
PREPARED_SCHEMA = T.StructType(TRAFFIC_SCHEMA.fields + PREPARED_EXTRA.fields)

CURATED_EXTRA = T.StructType(
    [
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("event_hour", T.IntegerType()),
        T.StructField("congestion_weight", T.IntegerType()),
        T.StructField("risk_index", T.DoubleType()),
        T.StructField("severe_event", T.BooleanType()),
        T.StructField("rolling_density_6_event", T.DoubleType()),
        T.StructField("speed_drop_from_zone_avg", T.DoubleType()),
    ]
)
CURATED_SCHEMA = T.StructType(TRAFFIC_SCHEMA.fields + CURATED_EXTRA.fields)

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("city_zone", T.StringType()),
        T.StructField("weather_condition", T.StringType()),
        T.StructField("congestion_level", T.StringType()),
        T.StructField("vehicle_events", T.LongType()),
        T.StructField("avg_density", T.DoubleType()),
        T.StructField("avg_speed", T.DoubleType()),
        T.StructField("avg_risk_index", T.DoubleType()),
        T.StructField("avg_ai_anomaly_score", T.DoubleType()),
        T.StructField("severe_events", T.LongType()),
        T.StructField("severe_event_rate", T.DoubleType()),
    ]
)

# The columns of the exports, in their order
PIPELINE_ANOMALY_COLUMNS = [
    "event_timestamp",
    "vehicle_id",
    "city_zone",
    "weather_condition",
    "congestion_level",
    "traffic_density",
    "average_speed",
    "signal_wait_time",
    "accident_probability",
    "ai_anomaly_score",
    "risk_index",
    "rolling_density_6_event",
    "speed_drop_from_zone_avg",
]
ANOMALIES_SCHEMA = T.StructType([CURATED_SCHEMA[c] for c in PIPELINE_ANOMALY_COLUMNS])

DASHBOARD_ANOMALY_COLUMNS = [
    "timestamp",
    "vehicle_id",
    "city_zone",
    "vehicle_type",
    "traffic_density",
    "average_speed",
    "accident_probability",
    "congestion_level",
    "ai_anomaly_score",
]

ICU_PREPROCESSED_EXTRA = T.StructType(
    [
        T.StructField("partition_id", T.IntegerType()),
        T.StructField("admission_hour", T.IntegerType()),
        T.StructField("shock_index", T.DoubleType()),
        T.StructField("oxygen_gap", T.DoubleType()),
        T.StructField("icu_severity_band", T.StringType()),
        T.StructField("batch_alert", T.BooleanType()),
    ]
)
ICU_PREPROCESSED_SCHEMA = T.StructType(ICU_SCHEMA.fields + ICU_PREPROCESSED_EXTRA.fields)
