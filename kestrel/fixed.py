"""Fixed values.

These must equal the values the original pipelines use for the results to match;
they are stated here once, in plain text, and imported where needed.
"""

# Fixed values — drift monitoring
DRIFT_THRESHOLD = 0.3                 # default per-feature threshold; drift when deviation > threshold
THRESHOLD_MIN, THRESHOLD_MAX = 0.0, 1.0   # accepted range: THRESHOLD_MIN <= t < THRESHOLD_MAX
TOP_VALUES = 3                        # most frequent values kept per feature and job
JOB_LIST_LIMIT = 10                   # jobs listed by default

# Fixed values — feature statistics
DAILY_STATS_LIMIT = 10                # newest dates in the daily statistics
BAR_GLYPH = "█"                       # one glyph per BAR_STEP percent
BAR_STEP = 5
TIME_TEXT_LENGTH = 19                 # time strings shown as their first 19 characters

# Fixed values — train / evaluate
SEED = 42
TEST_SPLIT_RATIO = 0.2
MAX_CLASSES = 20                      # classification when the target has fewer distinct values
N_ESTIMATORS = 100
MAX_DEPTH = 10
LOGREG_MAX_ITER = 200
IMPUTE_FILL = "unknown"
TOP_IMPORTANCES = 5
GRID = [{"n_estimators": 50, "max_depth": 3}, {"n_estimators": 100, "max_depth": 5},
        {"n_estimators": 100, "max_depth": 10}, {"n_estimators": 200, "max_depth": 5}]
RUN_NAME = "hp-search-{:03d}"

# Fixed values — sensor series and detector results
SENSOR_PREVIEW = 10                   # sensors shown in the summary
SAMPLE_POINTS = 5                     # points shown for the first timestamp
CSV_FOLDER = "timeseries_data"
CSV_STAMP = "yyyyMMdd_HHmmss"
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'.000Z'"
PLACEHOLDER_SECOND = 44
ENTITY_ID_FORMAT = "user_%04d"

# Fixed values — strings and paths
TAG_PREFIX = "Processed: "
TAG_AT = " at "
DEFAULT_EXTENSION = ".tmp"
