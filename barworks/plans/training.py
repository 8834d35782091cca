"""The two pipelines: the training set (W23) and processed series."""

from functools import reduce

from pyspark.sql import functions as F

from barworks.functions.schema import KEYS, VALUES, downcast_floats
from barworks.operators.features import SEQUENCE_LENGTH, cut, long_enough, sequences, split_columns
from barworks.operators.fills import interpolate_linear
from barworks.operators.indicators import (
    Sma, column_names, compute, indicators, resolve, series_facts, with_first_null)
from barworks.operators.positions import attach, buckets_of, number_rows
from barworks.operators.quality import quality_report
from barworks.session import settle
from barworks.sources.candles import bad_bar


def _sound_numbered(bars):
    """Numbered bars of the series without a NULL or a crossed bar, in one bucket pass."""
    facts = {**series_facts(), "_bad": (F.count_if(bad_bar(bars)), "sum")}
    rows = with_first_null(number_rows(bars, facts=facts)).where("_bad = 0").drop("_bad")
    return rows.withColumn("_x", F.col("close"))


def _warmup(chosen):
    """Leading rows that P5 drops: those without a value in a valid indicator."""
    drops = [F.when(i.needs(), F.lit(i.warmup)).otherwise(F.lit(0)) for i in chosen if isinstance(i, Sma)]
    return reduce(F.greatest, drops, F.lit(0)) if len(drops) < 2 else F.greatest(*drops)


def _gated(bars, config, extra=0):
    """Feature rows of sound series inside position blocks, with `extra` exact repeated rows.

    A sound series has no NULL, so what each indicator leaves NULL follows from its length alone:
    P5 is a filter on the position and the positions after it are known without counting again.
    """
    chosen = resolve(config)
    rows, scan = compute(_sound_numbered(bars), chosen, extra)
    rows = rows.select(*[c for c in rows.columns if c not in column_names(chosen)],
                       *[F.when(i.needs(), F.col(c)).alias(c) for i in chosen for c in i.columns],
                       _warmup(chosen).alias("_drop"))
    rows = rows.where(F.col("rn") >= F.col("_drop"))
    return rows, scan, [*VALUES, *column_names(chosen)]


def features(bars, config=None, gate=True, as_float=False, flags=False):
    """W-process: indicators, gap filling and complete rows for every series.

    `gate` applies S4, as ingest does, and needs no filling. Without it NULL prices are interpolated
    and rows that still miss a price or a valid indicator are dropped. `flags` adds `_ok_<column>`: is the indicator
    valid in this series.
    """
    chosen = resolve(config)
    marks = [F.col(f"_ok_{c}") for c in column_names(chosen)] if flags else []
    if gate:
        rows, _, columns = _gated(bars, config)
        rows = rows.withColumns({f"_ok_{c}": i.needs() for i in chosen for c in i.columns}) if flags and chosen else rows
        out = rows.where("_own").select(*KEYS, "timestamp", *columns, *marks)
    else:
        names = column_names(chosen)
        # P6 is part of the filter below: a row without any valid indicator misses one
        ready = interpolate_linear(indicators(bars, config, flags=True), columns=[*VALUES, *names])
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in VALUES]
                       + [~F.col(f"_ok_{c}") | F.col(c).isNotNull() for c in names])
        out = ready.where(whole).select(*KEYS, "timestamp", *VALUES, *names, *marks)
    return downcast_floats(out) if as_float else out


def training_set(bars, config=None, length=SEQUENCE_LENGTH, gate=True, as_float=False):
    """Process, split 80/10/10, cut sequences inside each split, keep series that fill all three.

    One shuffle numbers the bars, one places them in blocks; indicators and sequences share its sort.
    """
    if not gate:
        # dropped rows move all positions behind them: number again, from rows that are written
        out = sequences(settle(features(bars, config, gate=False)), length, whole_sets=True)
    else:
        rows, scan, columns = _gated(bars, config, extra=length)
        kept, at = F.col("n") - F.col("_drop"), F.col("rn") - F.col("_drop")
        rows = rows.where(long_enough(kept, length))
        name, split_at, _ = split_columns(kept, at)
        rows = rows.withColumn("split", name).withColumn("_at", split_at)
        out = cut(rows, scan.block, columns, length, 0, KEYS, F.col("_at"), ("split",))
    if as_float:
        out = out.withColumn("sequence", F.col("sequence").cast("array<array<float>>")).withColumn(
            "target", F.col("target").cast("float"))
    return out


def process_series(bars, config=None, gate=True):
    """Processed rows of the series that pass the quality report (A4); an indicator that a series cannot have is no gap."""
    ready = features(bars, config, gate, flags=True)
    if not gate:
        ready = settle(ready)
    names = column_names(resolve(config))
    columns = [c for c in ready.columns if c not in (*KEYS, *[f"_ok_{n}" for n in names])]
    valid = quality_report(ready, null_columns=columns, usable={n: f"_ok_{n}" for n in names}, outliers=False)
    return attach(ready.select(*KEYS, *columns), valid.where("valid").select(*KEYS), how="left_semi", buckets=buckets_of(bars))
