"""Row positions, blocks and carries for series of any length.

A series may hold a large share of all rows, so no operator sorts a whole series in one task.
Rows are bucketed by time (`SLOTS` bar widths per bucket), a small table with one row per bucket
carries counts and neighbouring values from bucket to bucket, and the rows join it on
(series, bucket): the same partitioning their windows use. Frames that look back a known number
of rows run on position blocks that repeat the last rows of the block before them.

A bucket holds at most `SLOTS` bars when a series has one bar per time, which `keep_first` and
`merge_bars` ensure without bringing copies together. Only the bucket table is ever ordered by
series: one row per `SLOTS` bars.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.functions.schema import KEYS, timeframe_seconds

SLOTS = 16384
BLOCK = 16384
_LAST = 9223372036854775807


# A bar of unknown width is bucketed like a daily one; checks report such a series.
DEFAULT_SECONDS = 86400
_TIMELESS = 4096  # buckets for bars without a time, which all sort last


def time_bucket(slots=None, timestamp="timestamp", timeframe="timeframe", spread=()):
    """Number of the time bucket of a bar; `slots` bar widths make one bucket. NULL times sort last.

    Bars without a time have no order among themselves: `spread` names columns that deal them to many buckets.
    """
    width = F.coalesce(timeframe_seconds(timeframe), F.lit(DEFAULT_SECONDS)) * F.lit(slots or SLOTS)
    last = F.lit(_LAST)
    if spread:
        last = last - F.pmod(F.xxhash64(*spread), F.lit(_TIMELESS).cast("bigint"))
    return F.coalesce(F.floor(F.unix_seconds(F.col(timestamp)) / width), last)


def _plain(df, besides):
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct", "variant")]
    return [c for c in plain if c not in besides and not c.startswith("_")]


def _time_bucket(df, keys=KEYS):
    return time_bucket(spread=_plain(df, (*keys, "timestamp")))


def number_bucket(column, size=None):
    """Bucket of a dense integer order column."""
    return F.coalesce(F.floor(F.col(column) / F.lit(size or SLOTS)), F.lit(_LAST))


def _total(df, order, keys):
    """The order as sort columns, with every other plain column behind it: a task that runs again after
    an executor was lost must number rows of equal time as before. Equal rows are interchangeable.
    """
    return [F.col(c).asc_nulls_last() for c in [*order, *_plain(df, (*keys, *order))]]


def number_rows(df, order=("timestamp",), bucket=None, keys=KEYS, facts=None, unique=False):
    """Add `rn` (0-based position in the series), `n` (rows in the series) and series facts.

    `facts` maps a name to (aggregate over rows, 'sum' | 'min' | 'max' to combine buckets).
    The bucket table is one column-pruned, map-side combined aggregate; the rows shuffle once.
    `unique` says that the order has no ties.
    """
    facts = facts or {}
    order = [F.col(c) for c in order] if unique else _total(df, order, keys)
    rows = df.withColumn("_b", bucket if bucket is not None else _time_bucket(df, keys))
    sizes = rows.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_m"),
                                          *[agg.alias(name) for name, (agg, _) in facts.items()])
    whole = Window.partitionBy(*keys)
    so_far = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    combine = {"sum": F.sum, "min": F.min, "max": F.max}
    offsets = sizes.select(
        *keys, "_b", (F.sum("_m").over(so_far) - F.col("_m")).alias("_off"), F.sum("_m").over(whole).alias("n"),
        *[combine[how](F.col(name)).over(whole).alias(name) for name, (_, how) in facts.items()])
    in_bucket = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order))
    return (rows.withColumn("_k", in_bucket).join(offsets, [*keys, "_b"])
            .withColumn("rn", F.col("_off") + F.col("_k") - F.lit(1)).drop("_k", "_off"))


def blocks(df, before, size=None, position="rn", keys=KEYS, shuffle=False):
    """Cut numbered rows into blocks and repeat the last `before` rows of each in the next one.

    Adds `_blk` and `_own`; rows with `_own` false only feed the frames of the block they visit.
    `shuffle` places the blocks at once, for when the first window is finer than a block and
    would otherwise place the rows by its own, finer keys.
    """
    size = max(size or BLOCK, 2 * before)
    home = F.floor(F.col(position) / F.lit(size))
    tail = F.col(position) % F.lit(size) >= F.lit(size - before)
    spread = F.when(tail & F.lit(before > 0), F.array(home, home + 1)).otherwise(F.array(home))
    out = (df.withColumn("_blk", F.explode(spread))
           .withColumn("_own", F.col("_blk") == F.floor(F.col(position) / F.lit(size))))
    return out.repartition(*keys, "_blk") if shuffle else out


def block_window(position="rn", keys=KEYS):
    return Window.partitionBy(*keys, "_blk").orderBy(position)


def previous(df, values, order, bucket=None, keys=KEYS):
    """Add `prev_<v>` for each value: the value of the row before, in the order of one column.

    Inside a bucket this is `lag`; the first row of a bucket takes the last row of the bucket before. Equal rows are
    ordered by the other columns, alike in both.
    """
    rows = df.withColumn("_b", bucket if bucket is not None else _time_bucket(df, keys))
    rest = _plain(df, (*keys, order))
    # NULL sorts last among rows, so it counts as largest here too
    largest = F.struct(*[e for c in (order, *rest) for e in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(f"v_{c}"))])
    ends = rows.groupBy(*keys, "_b").agg(*[F.max_by(v, largest).alias(f"_end_{v}") for v in values])
    step = Window.partitionBy(*keys).orderBy("_b")
    ends = ends.select(*keys, "_b", *[F.lag(f"_end_{v}").over(step).alias(f"_end_{v}") for v in values])
    w = Window.partitionBy(*keys, "_b").orderBy(*_total(df, [order], keys))
    first = F.row_number().over(w) == 1
    out = rows.join(ends, [*keys, "_b"]).select(
        *df.columns, first.alias("_first"), *[F.lag(v).over(w).alias(f"prev_{v}") for v in values],
        *[F.col(f"_end_{v}") for v in values])
    for v in values:
        out = out.withColumn(f"prev_{v}", F.when(F.col("_first"), F.col(f"_end_{v}")).otherwise(F.col(f"prev_{v}")))
    return out.drop("_first", *[f"_end_{v}" for v in values])


def locate(df, columns, order=("timestamp",), bucket=None, keys=KEYS, facts=None, unique=False):
    """`number_rows`, and per column the nearest non-null value at or before each row (`pv_`, at `pr_`),
    at or after it (`nv_`, at `nr_`), however far away, and the longest NULL run of the series (`run_`).

    Everything that crosses buckets goes through one table of buckets, read from one more pass.
    """
    facts = facts or {}
    order = [F.col(c) for c in order] if unique else _total(df, order, keys)
    here = Window.partitionBy(*keys, "_b")
    rows = df.withColumn("_b", bucket if bucket is not None else _time_bucket(df, keys))
    rows = rows.withColumn("_k", F.row_number().over(here.orderBy(*order)))
    first_to_here = (Window.unboundedPreceding, Window.currentRow)
    back = here.orderBy("_k").rowsBetween(*first_to_here)
    ahead = here.orderBy(F.col("_k").desc()).rowsBetween(*first_to_here)
    seen = {c: F.when(F.col(c).isNotNull(), F.col("_k")) for c in columns}
    for frame, side in ((back, "p"), (ahead, "n")):
        rows = rows.select("*", *[e for c in columns for e in (
            F.last(seen[c], ignorenulls=True).over(frame).alias(f"_{side}k_{c}"),
            F.last(c, ignorenulls=True).over(frame).alias(f"_{side}v_{c}"))])
    sizes = rows.groupBy(*keys, "_b").agg(
        F.count(F.lit(1)).alias("_m"), *[agg.alias(name) for name, (agg, _) in facts.items()],
        *[e for c in columns for e in (
            F.max(seen[c]).alias(f"_lk_{c}"), F.max_by(c, seen[c]).alias(f"_lv_{c}"),
            F.min(seen[c]).alias(f"_fk_{c}"), F.min_by(c, seen[c]).alias(f"_fv_{c}"),
            F.max(F.when(F.col(c).isNull(), F.col(f"_nk_{c}") - F.col(f"_pk_{c}") - 1)).alias(f"_in_{c}"))])
    whole = Window.partitionBy(*keys)
    up = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    down = whole.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    combine = {"sum": F.sum, "min": F.min, "max": F.max}
    table = sizes.withColumn("_off", F.coalesce(F.sum("_m").over(up), F.lit(0).cast("bigint")))
    table = table.select("*", F.sum("_m").over(whole).alias("n"), *[e for c in columns for e in (
        F.last(F.col("_off") + F.col(f"_lk_{c}") - 1, ignorenulls=True).over(up).alias(f"_cpr_{c}"),
        F.last(f"_lv_{c}", ignorenulls=True).over(up).alias(f"_cpv_{c}"),
        F.last(F.col("_off") + F.col(f"_fk_{c}") - 1, ignorenulls=True).over(down).alias(f"_cnr_{c}"),
        F.last(f"_fv_{c}", ignorenulls=True).over(down).alias(f"_cnv_{c}"))])

    def longest(c):
        opening = F.col("_off") + F.col(f"_fk_{c}") - 2 - F.coalesce(f"_cpr_{c}", F.lit(-1))
        closing = F.col("n") - 1 - F.coalesce(F.col("_off") + F.col(f"_lk_{c}") - 1, F.col(f"_cpr_{c}"), F.lit(-1))
        last_seen = F.col(f"_cnr_{c}").isNull()
        return F.max(F.greatest(F.lit(0).cast("bigint"), F.col(f"_in_{c}"), opening, F.when(last_seen, closing))).over(whole)
    carried = [f"_c{x}_{c}" for c in columns for x in ("pr", "pv", "nr", "nv")]
    table = table.select(*keys, "_b", "_off", "n", *carried, *[longest(c).alias(f"run_{c}") for c in columns],
                         *[combine[how](F.col(name)).over(whole).alias(name) for name, (_, how) in facts.items()])
    out = rows.join(table, [*keys, "_b"]).withColumn("rn", F.col("_off") + F.col("_k") - 1)
    near = [e for c in columns for e in (
        F.coalesce(F.col("_off") + F.col(f"_pk_{c}") - 1, f"_cpr_{c}").alias(f"pr_{c}"),
        F.coalesce(f"_pv_{c}", f"_cpv_{c}").alias(f"pv_{c}"),
        F.coalesce(F.col("_off") + F.col(f"_nk_{c}") - 1, f"_cnr_{c}").alias(f"nr_{c}"),
        F.coalesce(f"_nv_{c}", f"_cnv_{c}").alias(f"nv_{c}"))]
    return out.select(*df.columns, "rn", "n", *near, *[f"run_{c}" for c in columns], *facts)


def located_runs(df, columns, order=("timestamp",), keys=KEYS):
    """The longest NULL run per series and column."""
    rows = locate(df, columns, order, keys=keys)
    return rows.groupBy(*keys).agg(*[F.max(f"run_{c}").alias(f"run_{c}") for c in columns])


def buckets_of(df, keys=KEYS):
    """The time buckets of each series; a cheap stand-in for those of anything derived from `df`."""
    return df.select(*keys, time_bucket().alias("_s")).distinct()


def with_facts(df, facts, keys=KEYS, bucket=None):
    """Add facts of its series to every row: a name maps to (aggregate over rows, 'sum' | 'min' | 'max').

    One column-pruned, map-side combined pass makes the bucket table, whose windows combine the buckets; the rows join
    it on (series, bucket), so a series of any length stays spread.
    """
    rows = df.withColumn("_s", bucket if bucket is not None else _time_bucket(df, keys))
    combine = {"sum": F.sum, "min": F.min, "max": F.max}
    whole = Window.partitionBy(*keys)
    parts = rows.groupBy(*keys, "_s").agg(*[agg.alias(name) for name, (agg, _) in facts.items()])
    table = parts.select(*keys, "_s", *[combine[how](F.col(name)).over(whole).alias(name) for name, (_, how) in facts.items()])
    return rows.join(table, [*keys, "_s"]).drop("_s")


def attach(df, facts, keys=KEYS, bucket=None, how="inner", buckets=None):
    """Join one row of facts per series to all its rows without sending a series to one task.

    The facts first join the buckets of the series, then the rows join on (series, bucket).
    Spark broadcasts either join by itself when the measured side is below its size limit.
    `buckets` names the buckets when they are cheaper to get than from `df` itself.
    """
    here = time_bucket() if buckets is not None else _time_bucket(df, keys)
    rows = df.withColumn("_s", bucket if bucket is not None else here)
    known = buckets if buckets is not None else rows.select(*keys, "_s").distinct()
    spread = known.join(facts, list(keys))
    if how in ("left_semi", "left_anti"):
        spread = spread.select(*keys, "_s")
    return rows.join(spread, [*keys, "_s"], how).drop("_s")
