"""Quality reports: one row per series, from one map-side combined aggregate."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from barworks.functions import messages as msg
from barworks.functions.schema import KEYS, VALUES, timeframe_seconds
from barworks.operators import positions
from barworks.operators.positions import attach, previous, with_facts
from barworks.operators.rows import issue_flags

NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)
# Types a price column may have.
PRICE_TYPES = ("double", "float", "bigint", "int")


def numeric_columns(df, keys=KEYS):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in keys]


def _ratio(c):
    return F.count_if(F.col(c).isNull()) / F.count(F.lit(1))


def _worst(columns):
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def null_ratio(df, columns=None, threshold=0.15, keys=KEYS):
    """A1."""
    columns = columns or [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(*[_ratio(c).alias(f"null_{c}") for c in columns])
    out = out.withColumn("max_ratio", _worst([F.col(f"null_{c}") for c in columns]))
    return out.withColumn("valid", F.col("max_ratio") <= F.lit(threshold))


def missing_ratio_max(df, columns=None, threshold=0.35, keys=KEYS):
    """A5."""
    return null_ratio(df, columns, threshold, keys).select(*keys, "max_ratio", "valid")


def low_variance(df, columns=None, threshold=1e-6, keys=KEYS):
    """A2: sample variance per numeric column; a series of one row has none and is not low."""
    columns = columns or numeric_columns(df, keys)
    out = df.groupBy(*keys).agg(*[F.var_samp(c).alias(f"var_{c}") for c in columns])
    low = [F.coalesce(F.col(f"var_{c}") < F.lit(threshold), F.lit(False)) for c in columns]
    return out.withColumn("valid", ~reduce(lambda a, b: a | b, low))


def outlier_counts(df, columns=None, z=3.0, keys=KEYS, bucket=None):
    """A3: values further than z sample deviations from the mean of their series."""
    columns = columns or numeric_columns(df, keys)
    moments = df.groupBy(*keys).agg(*[e for c in columns for e in (
        F.avg(c).alias(f"_m_{c}"), F.stddev_samp(c).alias(f"_s_{c}"))])
    rows = attach(df, moments, keys, bucket)
    return rows.groupBy(*keys).agg(*[F.count_if(_far(c, z)).alias(f"outliers_{c}") for c in columns])


def _far(c, z):
    return (F.col(f"_s_{c}") > 0) & (F.abs(F.col(c) - F.col(f"_m_{c}")) > F.lit(z) * F.col(f"_s_{c}"))


def quality_report(df, columns=None, null_columns=None, missing=0.15, variance=1e-6, z=3.0, keys=KEYS, bucket=None,
                   outliers=True, usable=None):
    """A4: missing values, then variance, then price consistency; the first failure names the error.

    `usable` maps a column to a flag column: where the flag is false the series lacks the column, and it is not judged.
    """
    usable = usable or {}
    columns = columns or numeric_columns(df, keys)
    null_columns = null_columns or [c for c in df.columns if c not in keys]
    wide = df.groupBy(*keys).agg(
        _worst([F.when(F.bool_and(usable[c]), _ratio(c)).otherwise(F.lit(0.0)) if c in usable else _ratio(c)
                for c in null_columns]).alias("max_null_ratio"),
        _least([F.when(F.bool_and(usable[c]), F.var_samp(c)) if c in usable else F.var_samp(c) for c in columns])
        .alias("min_variance"),
        *[F.count_if(hit).alias(f"n_{name}") for name, hit in issue_flags().items()])
    out = judged(wide, missing, variance)
    return out.join(outlier_counts(df, columns, z, keys, bucket), list(keys)) if outliers else out


def judged(wide, missing=0.15, variance=1e-6):
    """The first failure of a series names its error: missing values, then variance, then price consistency."""
    faults = reduce(lambda a, b: a + b, [F.col(f"n_{name}") for name in issue_flags()])
    error = (F.when(F.col("max_null_ratio") > F.lit(missing), F.lit(msg.QUALITY_MISSING))
             .when(F.col("min_variance") < F.lit(variance), F.lit(msg.QUALITY_VARIANCE))
             .when(faults > 0, F.lit(msg.QUALITY_CONSISTENCY)))
    return wide.withColumn("error", error).withColumn("valid", F.col("error").isNull())


def _least(columns):
    return F.least(*columns) if len(columns) > 1 else columns[0]


def nan_report(df, keys=KEYS, essential=VALUES, limit=0.10, warn=0.20):
    """Essential columns over `limit` fail (the first one is named), others over `warn` only warn."""
    others = [c for c in df.columns if c not in keys and c not in essential]
    out = df.groupBy(*keys).agg(*[_ratio(c).alias(f"_r_{c}") for c in (*essential, *others)])
    worst = reduce(lambda acc, c: acc.when(F.col(f"_r_{c}") > F.lit(limit), F.lit(c)), essential, F)
    warnings = F.filter(F.array(*[F.when(F.col(f"_r_{c}") > F.lit(warn), F.lit(c)) for c in others],
                                F.lit(None).cast("string")), lambda x: x.isNotNull())
    return out.select(*keys, worst.alias("failed_column"), worst.isNull().alias("valid"), warnings.alias("warnings"))


def min_length(df, minimum=50, keys=KEYS):
    """A7."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("valid", F.col("n_rows") >= minimum)


def all_numeric_complete(df, columns=None, keys=KEYS):
    """No NULL anywhere and only numeric columns (time and keys aside)."""
    columns = columns or [c for c in df.columns if c not in (*keys, "timestamp")]
    types_ok = all(isinstance(df.schema[c].dataType, NUMERIC) for c in columns)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (df.groupBy(*keys).agg(F.bool_and(complete).alias("complete"))
            .withColumn("numeric", F.lit(types_ok)).withColumn("valid", F.col("complete") & F.col("numeric")))


def structure_check(df):
    """Required columns and types, from the schema alone, then one row to see it is not empty."""
    types = dict(df.dtypes)
    missing = [c for c in ("timestamp", *VALUES) if c not in types]
    if missing:
        return False, msg.STRUCTURE_MISSING.format(missing)
    if types["timestamp"] not in ("timestamp", "timestamp_ntz"):
        return False, msg.STRUCTURE_TYPE.format("timestamp", types["timestamp"])
    for c in VALUES:
        if types[c] not in PRICE_TYPES:
            return False, msg.STRUCTURE_TYPE.format(c, types[c])
    if df.isEmpty():
        return False, msg.STRUCTURE_EMPTY
    return True, msg.STRUCTURE_PASSED


def _steps(df, keys=KEYS):
    """Seconds since the bar before; a series' first bar has none."""
    rows = previous(df, ["timestamp"], "timestamp", keys=keys)
    micros = F.unix_micros("timestamp") - F.unix_micros("prev_timestamp")
    return rows.withColumn("step", micros / F.lit(1e6)).withColumn("tf", timeframe_seconds())


def _arrival_buckets(df, arrival, keys):
    """Add `_a`: equal shares of the range of a series' arrival numbers, as many as its rows fill buckets.

    Arrival numbers may be far apart (a counter of the whole table, microseconds), so their values do not tell how many
    rows lie between them.
    """
    facts = {"_lo": (F.min(arrival), "min"), "_hi": (F.max(arrival), "max"), "_m": (F.count(F.lit(1)), "sum")}
    rows = with_facts(df.withColumn("_a", F.col(arrival).cast("double")), facts, keys)
    shares = F.ceil(F.col("_m") / F.lit(positions.SLOTS))
    width = (F.col("_hi").cast("double") - F.col("_lo").cast("double") + 1) / shares
    return rows.withColumn("_a", F.coalesce(F.floor((F.col("_a") - F.col("_lo")) / width), shares)).drop("_lo", "_hi", "_m")


def monotonic_check(df, arrival="ingest_seq", keys=KEYS):
    """Are timestamps non-decreasing in the order the bars arrived."""
    rows = previous(_arrival_buckets(df, arrival, keys), ["timestamp"], arrival, F.col("_a"), keys)
    back = F.col("timestamp") < F.col("prev_timestamp")
    return rows.groupBy(*keys).agg(F.count_if(back).alias("n_backward")).withColumn("valid", F.col("n_backward") == 0)


def gaps(df, factor=1.5, keys=KEYS):
    """Bars that come more than `factor` widths after the one before."""
    rows = _steps(df, keys).where(F.col("step") > F.lit(factor) * F.col("tf"))
    return rows.select(*keys, "timestamp", (F.col("step") / F.lit(60.0)).alias("gap_minutes"))


def duplicate_timestamps(df, keys=KEYS):
    """Repeats after the first, counted from per-timestamp counts."""
    per_time = df.groupBy(*keys, "timestamp").agg(F.count(F.lit(1)).alias("_c"))
    return (per_time.groupBy(*keys).agg((F.sum("_c") - F.count(F.lit(1))).alias("n_duplicates"))
            .withColumn("valid", F.col("n_duplicates") == 0))


def future_rows(df, as_of, keys=KEYS):
    """Bars after the clock that is passed in."""
    late = F.col("timestamp") > F.lit(as_of).cast("timestamp")
    return df.groupBy(*keys).agg(F.count_if(late).alias("n_future")).withColumn("valid", F.col("n_future") == 0)


def timestamp_report(df, as_of, arrival="ingest_seq", factor=1.5, keys=KEYS):
    """Order, then gaps (a warning), duplicates and future bars; the first failure is the message."""
    per_time = df.groupBy(*keys, "timestamp").agg(F.count(F.lit(1)).alias("_c"))
    wide = _steps(per_time, keys).groupBy(*keys).agg(
        F.count_if(F.col("step") > F.lit(factor) * F.col("tf")).alias("n_gaps"),
        (F.sum("_c") - F.count(F.lit(1))).alias("n_duplicates"),
        F.sum(F.when(F.col("timestamp") > F.lit(as_of).cast("timestamp"), F.col("_c")).otherwise(F.lit(0)))
        .alias("n_future"))
    out = monotonic_check(df, arrival, keys).drop("valid").join(wide, list(keys))
    message = (F.when(F.col("n_backward") > 0, F.lit(msg.TIMES_BACKWARD))
               .when(F.col("n_duplicates") > 0,
                     F.format_string(msg.TIMES_DUPLICATE.format("%d"), "n_duplicates"))
               .when(F.col("n_future") > 0,
                     F.format_string(msg.TIMES_FUTURE.format("%d"), "n_future")))
    return (out.withColumn("valid", message.isNull())
            .withColumn("message", F.coalesce(message, F.lit(msg.TIMES_PASSED))))


def interval_check(df, tolerance=0.01, keys=KEYS, timeframe="timeframe"):
    """Every step within 1 % of the bar width; a series' first bar is exempt. An unknown width is a failure."""
    off = F.abs(F.col("step") - F.col("tf")) > F.lit(tolerance) * F.col("tf")
    out = _steps(df, keys).groupBy(*keys).agg(F.count_if(off).alias("n_invalid"), F.max("tf").alias("_tf"),
                                              F.max(timeframe).alias("_name"))
    unknown = F.when(F.col("_tf").isNull(), F.concat(F.lit(msg.TIMEFRAME_UNKNOWN), F.col("_name")))
    return out.select(*keys, "n_invalid", (F.col("_tf").isNotNull() & (F.col("n_invalid") == 0)).alias("valid"),
                      F.coalesce(unknown, F.lit("")).alias("message"))
