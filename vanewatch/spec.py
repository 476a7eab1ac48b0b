"""Names and default settings of a telemetry series; operators take all of them as arguments."""

# --- fixed values -----------------------------------------------------------------------------
# Layout of the raw text files, the sensors that carry signal, and the limits of the risk model.
SENSORS = tuple(f"s{i}" for i in range(1, 22))
SETTINGS = ("os1", "os2", "os3")
RAW_COLUMNS = ("unit", "cycle", *SETTINGS, *SENSORS)
KEEP_SENSORS = ("s2", "s3", "s4", "s7", "s9", "s11", "s12", "s14", "s17", "s20", "s21")
DROP_COLUMNS = ("s1", "s5", "s6", "s8", "s10", "s13", "s15", "s16", "s18", "s19", "os3")

WINDOW = 30
CLIP = 125
CRITICAL_RUL = 30
TEST_SHARE = 0.2
SPLIT_SEED = 42
TTL_SECONDS = 3600
ENGINE_PREFIX = "ENG-"
STORE_SOURCE = "redis_stream"  # where an engine's features come from
BUFFER_SOURCE = "push_buffer"

RISK_LEVELS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")  # position = rank
RISK_FLOORS = {"CRITICAL": 0.8, "HIGH": 0.6, "MEDIUM": 0.3}
UNKNOWN_THRESHOLD_RANK = 2

RUL_BUCKETS = (
    (0, 30, "critical(0-30)"),
    (30, 60, "degrading(30-60)"),
    (60, 90, "mid(60-90)"),
    (90, 125, "healthy(90-125)"),
)

HISTOGRAM_BOUNDS = {
    "prediction_latency_seconds": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0),
    "predicted_rul_cycles": (0.0, 10.0, 20.0, 30.0, 50.0, 75.0, 100.0, 125.0),
    "failure_risk_score": (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0),
    "prediction_confidence": (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0),
}

GATE = {"rmse": 70.0, "penalty_score": 10000.0}
SCOREBOARD = (  # metric, comparison, target
    ("rmse", "<", 20.0),
    ("penalty_score", "<", 2000.0),
    ("precision_critical", ">", 0.8),
    ("recall_critical", ">", 0.75),
    ("f1_critical", ">", 0.8),
    ("accuracy", ">", 0.8),
    ("f1_weighted", ">", 0.8),
)

DRIFT_P = 0.05
DRIFT_WARNING_SHARE = 0.3
DRIFT_CRITICAL_SHARE = 0.5
DRIFT_MIN_ROWS = 100

# messages of rejected windows and readings
WRONG_SHAPE = "Expected shape ({window}, {width}), got "
WRONG_COUNT = "Expected {window} readings, got "
MISSING_KEYS = "Missing required sensor keys: "
# ----------------------------------------------------------------------------------------------

# A key with more rows than this is cut into several slices (see operators.ordering).
ROWS_PER_SLICE = 1_000_000
# Sliding windows multiply their rows, so one task gets fewer of them at a time.
ROWS_PER_CHUNK = 100_000
# Engines of a stream share keyed states of this number, so that Python is called per state and not per engine.
STATE_BUCKETS = 1024
# Feature windows in a stored file: what a task of a model fit holds as vectors.
ROWS_PER_FILE = 65_536
