"""Texts of reports."""

# What a report says, by check.
STRUCTURE_PASSED = "Data structure validation passed"
STRUCTURE_EMPTY = "DataFrame is None or empty"
STRUCTURE_MISSING = "Missing required columns: {}"
STRUCTURE_TYPE = "Invalid data type for {}: {}"

CONSISTENCY_PASSED = "Data consistency validation passed"
HIGH_BELOW_LOW = "High < Low"
HIGH_NOT_HIGHEST = "High not highest"
LOW_NOT_LOWEST = "Low not lowest"
BAD_VOLUME = "Invalid volume"

QUALITY_MISSING = "Too many missing values"
QUALITY_VARIANCE = "Low variance detected"
QUALITY_CONSISTENCY = "Data consistency issues found"

TIMEFRAME_UNKNOWN = "Invalid timeframe: "

TIMES_PASSED = "Timestamp validation passed"
TIMES_BACKWARD = "Timestamps are not monotonically increasing"
TIMES_DUPLICATE = "Found {} duplicate timestamps"
TIMES_FUTURE = "Found {} timestamps in the future"

DATASET_MISSING = "Missing required keys: {}"

SEQUENCES_PASSED = "Sequence validation passed"
SEQUENCES_SHORT = "Sequence length too short"
SEQUENCES_NAN = "Found NaN values in sequences or targets"
SEQUENCES_INF = "Found infinite values in sequences or targets"

TRAINING_PASSED = "Training data validation passed"
TRAINING_NAN = "Training data contains NaN values"
TRAINING_INF = "Training data contains infinite values"
TRAINING_X_RANGE = "Input features not properly normalized"
TRAINING_Y_RANGE = "Target values not properly normalized"
TRAINING_FEW = "Insufficient training samples"
TRAINING_X_FLAT = "Input features have near-zero variance"
TRAINING_Y_FLAT = "Target values have near-zero variance"
