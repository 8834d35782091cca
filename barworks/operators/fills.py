"""Gap filling (W7-W11) from the nearest observed neighbours of each row."""

from pyspark.sql import functions as F

from barworks.functions.schema import KEYS, VALUES
from barworks.operators.positions import locate, located_runs
from barworks.operators.rows import drop_incomplete


def _interpolated(c, limit):
    """Straight line by position, at most `limit` rows into a run; a trailing run repeats the last value."""
    slope = (F.col(f"nv_{c}") - F.col(f"pv_{c}")) / (F.col(f"nr_{c}") - F.col(f"pr_{c}"))
    return (F.when(F.col(c).isNotNull(), F.col(c))
            .when(F.col("rn") - F.col(f"pr_{c}") > limit, F.lit(None).cast("double"))
            .when(F.col(f"nr_{c}").isNull(), F.col(f"pv_{c}"))
            .otherwise(F.col(f"pv_{c}") + slope * (F.col("rn") - F.col(f"pr_{c}"))))


def _forward(c, limit):
    near = F.lit(True) if limit is None else F.col("rn") - F.col(f"pr_{c}") <= limit
    return F.coalesce(F.col(c), F.when(near, F.col(f"pv_{c}")))


def _backward(c, limit):
    near = F.lit(True) if limit is None else F.col(f"nr_{c}") - F.col("rn") <= limit
    return F.coalesce(F.col(c), F.when(near, F.col(f"nv_{c}")))


def _fill(df, columns, how, order):
    rows = locate(df, columns, order)
    return rows.select(*[how(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def interpolate_linear(df, columns=VALUES, limit=5, order=("timestamp",)):
    """W7."""
    return _fill(df, columns, lambda c: _interpolated(c, limit), order)


def ffill(df, columns=VALUES, limit=None, order=("timestamp",)):
    """W8, forward."""
    return _fill(df, columns, lambda c: _forward(c, limit), order)


def bfill(df, columns=VALUES, limit=None, order=("timestamp",)):
    """W8, backward."""
    return _fill(df, columns, lambda c: _backward(c, limit), order)


def null_run_length(df, columns=VALUES, order=("timestamp",), keys=KEYS):
    """The longest run of consecutive NULLs per series and column."""
    return located_runs(df, columns, order, keys)


def fill_gaps(df, columns=VALUES, max_gap=5, mode="documented", order=("timestamp",)):
    """W10. `documented`: a column whose longest run fits `max_gap` is interpolated, any other is carried
    forward then backward; `effective`: always interpolated (D8). Rows without any indicator go (P6).
    """
    def both(c):
        back = F.when(F.col(f"nr_{c}") - F.col("rn") <= max_gap, F.col(f"nv_{c}"))
        carried = F.coalesce(_forward(c, max_gap), back)
        return F.when(F.col(f"run_{c}") <= max_gap, _interpolated(c, max_gap)).otherwise(carried)

    def straight(c):
        return _interpolated(c, max_gap)
    return drop_no_indicator(_fill(df, columns, straight if mode == "effective" else both, order))


def fill_all(df, columns=VALUES, order=("timestamp",)):
    """Carry forward, then backward, then drop rows that still miss a value."""
    filled = _fill(df, columns, lambda c: F.coalesce(F.col(c), F.col(f"pv_{c}"), F.col(f"nv_{c}")), order)
    return drop_incomplete(filled)


def drop_no_indicator(df):
    """Drop rows whose indicator columns are all NULL; nothing happens when there are none."""
    names = [c for c in df.columns if any(mark in c for mark in ("RSI", "MACD", "SMA", "EMA"))]
    return df.na.drop("all", subset=names) if names else df


def carried_close(located, limit=5):
    """Add `_x`: the close interpolated `limit` rows into each gap, then carried on (used by W2 and W4)."""
    at = F.least(F.col("rn"), F.col("pr_close") + limit)
    slope = (F.col("nv_close") - F.col("pv_close")) / (F.col("nr_close") - F.col("pr_close"))
    x = (F.when(F.col("close").isNotNull(), F.col("close")).when(F.col("nr_close").isNull(), F.col("pv_close"))
         .otherwise(F.col("pv_close") + slope * (at - F.col("pr_close"))))
    return located.withColumn("_x", x).drop(*[f"{m}_close" for m in ("pr", "pv", "nr", "nv", "run")])
