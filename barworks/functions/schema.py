"""Types, names and column expressions shared by all operators."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("pair", "timeframe")
PRICES = ("open", "high", "low", "close")
VALUES = PRICES + ("volume",)

BARS = T.StructType(
    [T.StructField("pair", T.StringType()), T.StructField("timeframe", T.StringType()),
     T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in VALUES]
)

# The known bar widths, in seconds.
TIMEFRAME_SECONDS = {
    "1m": 60,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1h": 3600,
    "4h": 14400,
    "1d": 86400,
}

# Bars per year for the widths that are ingested.
BARS_PER_YEAR = {"1h": 8760, "4h": 2190, "1d": 365}

# The bar widths that are ingested unless others are named.
DEFAULT_TIMEFRAMES = ("1h", "4h", "1d")


def _lookup(column, table, otherwise):
    return reduce(lambda acc, kv: acc.when(column == kv[0], F.lit(kv[1])), list(table.items())[1:],
                  F.when(column == list(table)[0], F.lit(list(table.values())[0]))).otherwise(otherwise)


def timeframe_seconds(timeframe="timeframe", strict=False):
    """Width of a bar in seconds (P10); an unknown name has none (NULL), or is an error when strict."""
    column = F.col(timeframe) if isinstance(timeframe, str) else timeframe
    unknown = F.raise_error(F.concat(F.lit("unknown timeframe: "), column)) if strict else F.lit(None)
    return _lookup(column, TIMEFRAME_SECONDS, unknown.cast("bigint")).cast("bigint")


def bars_per_year(timeframe="timeframe"):
    return _lookup(F.col(timeframe), BARS_PER_YEAR, F.lit(None).cast("bigint")).cast("bigint")


def from_epoch_ms(column):
    """Epoch milliseconds to timestamp."""
    return F.timestamp_millis(F.col(column).cast("bigint") if isinstance(column, str) else column.cast("bigint"))


def missing_to_null(df, columns=None):
    """NaN becomes NULL in the floating columns: the one marker of a missing value. Infinities stay for the checks."""
    floating = [f.name for f in df.schema.fields if f.dataType in (T.DoubleType(), T.FloatType())
                and (columns is None or f.name in columns)]
    return df.select([F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns])


def is_finite(column):
    return ~(F.isnan(column) | column.isin(float("inf"), float("-inf")))


def series_file_key(pair="pair", timeframe="timeframe"):
    """`BTC/USDT`, `1h` -> `BTC_USDT_1h`."""
    return F.concat_ws("_", F.replace(F.col(pair), F.lit("/"), F.lit("_")), F.col(timeframe))


def day_key(currency="currency", date="date"):
    """`en`, 2024-01-05 -> `en_2024-01-05`."""
    return F.concat_ws("_", F.col(currency), F.date_format(F.col(date), "yyyy-MM-dd"))


def feature_row(columns):
    """All listed columns of a row, in order, as one vector."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def downcast_floats(df):
    """Every double column as float."""
    return df.select([F.col(f.name).cast("float").alias(f.name) if f.dataType == T.DoubleType()
                      else F.col(f.name) for f in df.schema.fields])


def downcast(df):
    """Doubles to float, and bigints to int where the observed range allows it.

    One aggregate pass finds the ranges; only 2 numbers per bigint column reach the driver.
    """
    longs = [f.name for f in df.schema.fields if f.dataType == T.LongType()]
    out = downcast_floats(df)
    if not longs:
        return out
    spans = df.agg(*[F.min(c).alias(f"lo_{c}") for c in longs], *[F.max(c).alias(f"hi_{c}") for c in longs]).first()
    fits = [c for c in longs if spans[f"lo_{c}"] is not None
            and spans[f"lo_{c}"] > -2147483648 and spans[f"hi_{c}"] < 2147483647]
    return out.select([F.col(c).cast("int").alias(c) if c in fits else F.col(c) for c in out.columns])
