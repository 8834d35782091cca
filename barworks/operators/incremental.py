"""Indicators of appended bars from saved state (W6, W23): a new bar costs itself, whatever the history of its series.

The state of a series is one row: how many bars it has, its last closes, and how far each exponential mean was behind at the
first of those. Exponential means are affine in what they start from, so the means of new bars follow from the state as
they would from all bars before; windows of fixed length need the last closes alone.
"""

from functools import reduce

from pyspark.sql import functions as F

from barworks.functions.schema import KEYS
from barworks.operators.indicators import Sma, column_names, compute, resolve, series_facts, with_first_null
from barworks.operators.positions import attach, number_rows
from barworks.session import settle

_COUNTS = ("n", "n_null", "n_odd")


def _names(chosen):
    """The exponential means of a set of indicators, as the scan names them."""
    names = []
    for i in chosen:
        if hasattr(i, "fast"):
            names += [f"_{side}" for side, span in (("fast", i.fast), ("slow", i.slow)) if span > 1]
        if i.spans() and (getattr(i, "signal", None) or i.spans()[0]) > 1:
            names.append(f"_lag_{i.columns[-1]}")
    return names


def _length(chosen):
    """Closes that a new bar looks back on: the change before the first one of a window counts too."""
    return max([i.lookback + 1 for i in chosen if not i.spans()], default=1)


def late_bars(bars, state, keys=KEYS):
    """Bars that are not after the last one of their series: `advance` leaves them out, their series need a full pass."""
    return attach(bars, state.select(*keys, F.col("last").alias("_last")), keys).where("timestamp <= _last OR timestamp IS NULL").drop("_last")


def advance(bars, state=None, config=None, keys=KEYS):
    """Indicator columns of bars that come after those of `state`, and the state after them: (rows, state).

    `rows` has the bars with raw values; `valid_only` blanks those of series that cannot have an indicator, which only
    the whole series tells. The closes must not be NULL, as in a sound series (`indicators(fill=False)`): a series that
    ever had one has no indicator but the SMA. Series without new bars keep their state, new series start one. Only the bars
    given and one row per series are read. Two indicators of one kind are not kept apart and are refused.
    """
    chosen = resolve(config)
    names, length = _names(chosen), _length(chosen)
    if len(set(names)) < len(names):
        raise ValueError("one indicator of a kind")
    new = bars.select("*", F.lit(True).alias("_new"))
    if state is not None:
        known = state.select(*keys, "last")
        new = attach(new, known.withColumnRenamed("last", "_last"), keys, how="left").where("_last IS NULL OR timestamp > _last").drop("_last")
        # the saved closes of the series that have new bars stand before them
        touched = state.join(new.select(*keys).distinct(), list(keys), "left_semi")
        tail = touched.select(*keys, F.explode("closes").alias("_c")).select(
            *keys, "_c.timestamp", "_c.close", F.lit(False).alias("_new"))
        new = new.unionByName(tail, allowMissingColumns=True)
    fresh = {name: (F.count_if(F.col("_new") & cond), "sum") for name, cond in (
        ("_fresh", F.lit(True)), ("_fresh_null", F.col("close").isNull()),
        ("_fresh_odd", F.coalesce(F.col("close").isin(float("inf"), float("-inf")) | F.isnan("close"), F.lit(False))))}
    rows = number_rows(new, facts={**series_facts(), **fresh}, keys=keys)
    rows = with_first_null(rows).drop("n_null", "n_odd").withColumn("_x", F.col("close"))
    # what is known of the series so far: its counts, and how far the means are behind at position 0
    if state is not None:
        facts = state.select(*keys, *[F.col(c).alias(f"_so_far_{c}") for c in _COUNTS], F.col("first_null").alias("_first_null"),
                             *[F.col(f"behind{n}").alias(f"_given_{n}") for n in names])
        rows = attach(rows, facts, keys, how="left")
        rows = rows.withColumns({f"_given_{n}": F.coalesce(f"_given_{n}", F.lit(0.0)) for n in names})
        rows = rows.withColumn("first_null", F.coalesce("_first_null", "first_null")).drop("_first_null")
    else:
        rows = rows.withColumns({f"_so_far_{c}": F.lit(0).cast("bigint") for c in _COUNTS})
    rows = rows.withColumn("_size", F.col("n")).withColumns({
        c: F.coalesce(f"_so_far_{c}", F.lit(0).cast("bigint")) + F.col(f) for c, f in zip(_COUNTS, fresh)})
    done, _ = compute(rows, chosen, kept=True)
    wanted = [*bars.columns, *column_names(chosen)]
    done = settle(done.where("_own").select(*wanted, "_new", "rn", "_size", *_COUNTS, "first_null", *[f"_kept_{n}" for n in names]))
    # at most `length` rows of a series are its last ones, so what is collected is bounded
    last = done.where(F.col("rn") >= F.col("_size") - length)
    after = last.groupBy(*keys).agg(
        F.max("timestamp").alias("last"), *[F.max(c).alias(c) for c in _COUNTS], F.bool_or("first_null").alias("first_null"),
        F.sort_array(F.collect_list(F.struct("timestamp", "close"))).alias("closes"), *[F.min_by(f"_kept_{n}", "rn").alias(f"behind{n}") for n in names])
    if state is not None:
        after = after.unionByName(state.join(after.select(*keys), list(keys), "left_anti"))
    return done.where("_new").select(*wanted), after


def valid_only(rows, state, config=None, keys=KEYS):
    """Blank the indicators that a series cannot have, by the counts of its state."""
    chosen = resolve(config)
    facts = state.select(*keys, *_COUNTS, "first_null")
    clean = F.col("n_null") == 0
    holds = {c: i.needs() if isinstance(i, Sma) else i.needs() & clean for i in chosen for c in i.columns}
    flags = reduce(lambda df, c: df.withColumn(f"_ok_{c}", holds[c]), holds, facts).select(*keys, *[f"_ok_{c}" for c in holds])
    both = attach(rows, flags, keys)
    return both.select(*[F.when(F.col(f"_ok_{c}"), F.col(c)).alias(c) if c in holds else F.col(c) for c in rows.columns])
