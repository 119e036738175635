"""Fixed values of the domain."""

#: Fewest shared periods that two series must have to be spliced, by frequency; others need the default.
MIN_OVERLAP_PERIODS = {"annual": 3, "quarterly": 6, "monthly": 12, "daily": 12}
DEFAULT_MIN_OVERLAP = 3
#: Months that one observation counts for, by frequency; others count the default.
MONTHS_PER_PERIOD = {"annual": 12, "quarterly": 3, "monthly": 1, "daily": 1}
DEFAULT_MONTHS = 12

#: Within-segment growth may move by so much through linking.
GROWTH_TOLERANCE = 0.01
#: Factors closer to each other than this are equal.
SCALE_EPSILON = 1e-12

#: Confidence: months for full marks, the least, and the weight of the ratios' variance.
FULL_OVERLAP_MONTHS = 36.0
CONFIDENCE_FLOOR = 0.2
VARIANCE_WEIGHT = 50.0

#: Level shifts: least absolute change, multiple of the typical change, fewest rows.
SHIFT_THRESHOLD = 0.20
JUMP_MULTIPLE = 4.0
MIN_ROWS_FOR_SHIFTS = 4

IQR_MULTIPLIER = 1.5
NULL_THRESHOLD = 5.0

DETECTED_BY_METADATA = "metadata"
DETECTED_BY_LEVEL_SHIFT = "level_shift"
METHOD_OVERLAP = "overlap"
METHOD_LEVEL_SHIFT = "level_shift"

STATUS_VALID = "valid"
STATUS_FLAGGED = "flagged"
OUTLIER_NOTE = "IQR outlier"

DERIVED_PREFIX = "WB"
DERIVED_SUFFIX = "YOY"
DERIVED_UNIT = "annual %"
DERIVED_METHOD = "year_over_year_percent_change"
DEFAULT_DOMAIN = "unclassified"

#: Years that a series should have observations in.
COVERAGE_YEARS = 50

MAX_PAGES = 100
MAX_UNIT_CHARS = 50
