"""Scaling, splits, sequences, batches and their checks."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.functions import messages as msg
from barworks.functions.schema import KEYS, VALUES, feature_row
from barworks.operators.positions import attach, block_window, blocks, number_rows, with_facts

SEQUENCE_LENGTH = 50
BLOCK_SEQUENCES = 1024


def series_median(df, columns, keys=KEYS, accuracy=10000):
    """Exact `median_<c>` per series and column, without sorting a series.

    A mergeable sketch brackets the middle ranks; a second pass counts what lies below the bracket and
    keeps only the distinct values inside it (a few in `accuracy`) with their counts for ranking.
    """
    margin, by = 2.0 / accuracy, [*keys, "column"]
    cells = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns])).alias("cell"))
    cells = cells.select(*keys, "cell.column", "cell.v").where("v is not null")
    sketch = cells.groupBy(*by).agg(F.count(F.lit(1)).alias("m"), F.percentile_approx(
        "v", [0.5 - margin, 0.5 + margin], accuracy).alias("q"))
    sketch = sketch.select(*by, "m", F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))
    rows = attach(df.select(*keys, "timestamp", *columns), _wide(sketch, columns, keys, ("m", "lo", "hi")), keys)
    kept = rows.select(*keys, F.explode(F.filter(F.array(*[
        F.when(F.col(c) <= F.col(f"hi_{c}"), F.struct(
            F.lit(c).alias("column"), F.when(F.col(c) >= F.col(f"lo_{c}"), F.col(c)).alias("v"),
            F.col(f"m_{c}").alias("m"))) for c in columns]), lambda s: s.isNotNull())).alias("cell"))
    counted = kept.select(*keys, "cell.*").groupBy(*by, "v", "m").agg(F.count(F.lit(1)).alias("c"))
    # the NULL value stands for everything below the bracket and sorts first
    upto = Window.partitionBy(*by).orderBy(F.col("v").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("rank", F.sum("c").over(upto))
    first, second = F.floor((F.col("m") + 1) / 2), F.floor(F.col("m") / 2) + 1
    picked = ranked.groupBy(*by).agg(F.min(F.when(F.col("rank") >= first, F.col("v"))).alias("a"),
                                     F.min(F.when(F.col("rank") >= second, F.col("v"))).alias("b"))
    return _wide(picked.withColumn("median", (F.col("a") + F.col("b")) / 2), columns, keys, ("median",))


def _wide(long, columns, keys, names):
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("column") == c, F.col(n))).alias(f"{n}_{c}") for c in columns for n in names])


def minmax_scale(df, columns, keys=KEYS):
    """NULLs take the series median, then (x - min) / (max - min); a constant column becomes 0.

    A column that is all NULL in a series stays so. The median lies between min and max, so filling
    never moves them.
    """
    hole = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    gaps = {"_gaps": (F.count_if(hole), "sum")}
    # only series with a gap need a median, so only their rows are read for one
    holed = with_facts(df.select(*keys, "timestamp", *columns), gaps, keys).where("_gaps > 0").drop("_gaps")
    spread = df.groupBy(*keys).agg(
        *[e for c in columns for e in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))])
    rows = attach(df, spread.join(series_median(holed, columns, keys), list(keys), "left"), keys)

    def scaled(c):
        lo, hi = F.col(f"min_{c}"), F.col(f"max_{c}")
        x = F.coalesce(F.col(c), F.col(f"median_{c}"))
        return F.when(hi == lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo))
    return rows.select(*[scaled(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def split_columns(n="n", rn="rn"):
    """Split name, position inside the split and rows in it, from series position and length."""
    n, rn = F.col(n) if isinstance(n, str) else n, F.col(rn) if isinstance(rn, str) else rn
    train = F.floor(n.cast("double") * F.lit(0.8))
    val = F.floor(n.cast("double") * F.lit(0.1))
    name = F.when(rn < train, F.lit("train")).when(rn < train + val, F.lit("val")).otherwise(F.lit("test"))
    start = F.when(rn < train, F.lit(0)).when(rn < train + val, train).otherwise(train + val)
    size = F.when(rn < train, train).when(rn < train + val, val).otherwise(n - train - val)
    return name, (rn - start), size


def split_80_10_10(df, keys=KEYS):
    """W18."""
    name, at, _ = split_columns()
    return (number_rows(df, keys=keys).withColumn("split", name).withColumn("split_pos", at.cast("bigint"))
            .select(*df.columns, "split", "split_pos"))


def default_features(df, keys=KEYS):
    return [c for c in df.columns if c not in (*keys, "timestamp", "ingest_seq")]


def cut(rows, window, features, length, ahead, keys, at, keep=()):
    """Sequences that end `1 + ahead` rows before each target row `at` a known position of its split.

    `window` orders rows of one block; the frame only looks back, so blocks need no rows after them.
    """
    frame = window.rowsBetween(-(length + ahead), -(1 + ahead))
    out = rows.select("*", F.collect_list(feature_row(features)).over(frame).alias("sequence"))
    out = out.where(F.col("_own") & (at >= length + ahead))
    return out.select(*keys, *keep, (at - (length + ahead)).cast("bigint").alias("seq_no"), "sequence",
                      F.col("close").alias("target"))


def sequences(df, length=SEQUENCE_LENGTH, features=None, keys=KEYS, whole_sets=False):
    """`length` rows and the close of the row after them, stride 1, never across a split.

    `whole_sets` keeps only series whose three splits each give a sequence (W21). Rows must be complete.
    """
    features = features or default_features(df, keys)
    name, at, _ = split_columns()
    rows = number_rows(df.select(*keys, "timestamp", *dict.fromkeys([*features, "close"])), keys=keys)
    if whole_sets:
        rows = rows.where(long_enough(F.col("n"), length))
    rows = rows.withColumn("split", name).withColumn("_at", at)
    return cut(blocks(rows, length), block_window(keys=keys), features, length, 0, keys, F.col("_at"), ("split",))


def sequence_blocks(df, length=SEQUENCE_LENGTH, features=None, keys=KEYS, whole_sets=False, size=BLOCK_SEQUENCES):
    """The sequences of `sequences`, up to `size` of them as one block of rows that they share.

    A block has keys, split, `first_seq_no`, `rows` (feature rows in order) and `targets`: sequence i of the block is
    rows i to i + length - 1 with target i, a strided view for whoever reads it (`unfold` in Spark, a sliding window in an
    Arrow or numpy reader). So a row is written once, and the `length` rows between two blocks twice, instead of `length` times.
    """
    features, size = features or default_features(df, keys), max(size, length)
    name, at, _ = split_columns()
    rows = number_rows(df.select(*keys, "timestamp", *dict.fromkeys([*features, "close"])), keys=keys)
    if whole_sets:
        rows = rows.where(long_enough(F.col("n"), length))
    rows = rows.select(*keys, name.alias("split"), at.alias("_at"), feature_row(features).alias("x"), "close")
    # the first `length` rows of a block finish sequences of the block before
    home, into = F.floor(F.col("_at") / F.lit(size)), F.col("_at") % F.lit(size)
    both = F.when((into < length) & (home > 0), F.array(home - 1, home)).otherwise(F.array(home))
    packed = rows.withColumn("_blk", F.explode(both)).groupBy(*keys, "split", "_blk").agg(
        F.sort_array(F.collect_list(F.struct("_at", "x", "close"))).alias("_rows"))
    packed = packed.where(F.size("_rows") > length)
    return packed.select(*keys, "split", (F.col("_blk") * size).alias("first_seq_no"),
                         F.transform(F.slice("_rows", 1, F.size("_rows") - 1), lambda r: r["x"]).alias("rows"),
                         F.transform(F.slice("_rows", length + 1, size), lambda r: r["close"]).alias("targets"))


def unfold(blocks_, length=SEQUENCE_LENGTH):
    """The sequences of `sequence_blocks`, a row each, as `sequences` gives them."""
    rest = [c for c in blocks_.columns if c not in ("first_seq_no", "rows", "targets")]
    one = blocks_.select(*rest, "first_seq_no", "rows", F.posexplode("targets").alias("_i", "target"))
    return one.select(*rest, (F.col("first_seq_no") + F.col("_i")).alias("seq_no"), F.slice("rows", F.col("_i") + 1, length).alias("sequence"), "target")


def long_enough(n, length):
    """Do train, validation and test each hold more rows than one sequence."""
    train, val = F.floor(n.cast("double") * F.lit(0.8)), F.floor(n.cast("double") * F.lit(0.1))
    return F.least(train, val, n - train - val) > length


def series_ids(spark, pairs, timeframes):
    """The id of each pair and timeframe is its place in the list it is given in."""
    pair_ids = spark.createDataFrame([(p, i) for i, p in enumerate(pairs)], "pair string, pair_idx int")
    frame_ids = spark.createDataFrame([(t, i) for i, t in enumerate(timeframes)], "timeframe string, timeframe_idx int")
    return pair_ids, frame_ids


def with_ids(df, pair_ids, frame_ids, keys=KEYS):
    """Attach the ids to bars, before anything multiplies them."""
    facts = df.select(*keys).distinct().join(pair_ids, "pair").join(frame_ids, "timeframe")
    return attach(df, facts, keys)


def sequences_ext(df, pair_ids, frame_ids, length=SEQUENCE_LENGTH, features=None, keys=KEYS):
    """As W19 over the whole series, with the close one row later as target, ids and a weight of 1."""
    features = features or default_features(df, keys)
    rows = with_ids(df.select(*keys, "timestamp", *dict.fromkeys([*features, "close"])), pair_ids, frame_ids, keys)
    rows = number_rows(rows, keys=keys)
    out = cut(blocks(rows, length + 1), block_window(keys=keys), features, length, 1, keys, F.col("rn"),
              ("pair_idx", "timeframe_idx"))
    return out.withColumn("weight", F.lit(1.0))


def training_pairs(df, length=60, features=VALUES, minimum=100, keys=KEYS):
    """Whole-series sequences, the first 80 % for training and the rest for validation.

    A series that leaves fewer than `minimum` samples on a side gives none.
    """
    rows = number_rows(df.select(*keys, "timestamp", *dict.fromkeys([*features, "close"])), keys=keys)
    samples = F.col("n") - F.lit(length)
    train = F.floor(samples.cast("double") * F.lit(0.8))
    rows = rows.where((train >= minimum) & (samples - train >= minimum))
    rows = rows.withColumn("split", F.when(F.col("rn") - length < train, F.lit("train")).otherwise(F.lit("val")))
    return cut(blocks(rows, length), block_window(keys=keys), list(features), length, 0, keys, F.col("rn"), ("split",))


def batches(df, size=32, features=None, keys=KEYS):
    """Full batches of rows in series order, without any that holds a NULL or NaN."""
    features = features or default_features(df, keys)
    rows = number_rows(df.select(*keys, "timestamp", *dict.fromkeys([*features, "close"])), keys=keys)
    rows = rows.withColumn("batch_no", F.floor(F.col("rn") / F.lit(size)))
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.coalesce(F.isnan(c), F.lit(False))
                                      for c in dict.fromkeys([*features, "close"])])
    # a batch is at most `size` rows, so collecting it is bounded
    packed = rows.groupBy(*keys, "batch_no").agg(
        F.count(F.lit(1)).alias("_m"), F.bool_or(bad).alias("_bad"),
        F.sort_array(F.collect_list(F.struct("rn", feature_row(features).alias("x"),
                                             F.col("close").alias("y")))).alias("_rows"))
    return packed.where((F.col("_m") == size) & ~F.col("_bad")).select(
        *keys, "batch_no", F.transform("_rows", lambda r: r["x"]).alias("x"),
        F.transform("_rows", lambda r: r["y"]).alias("y"))


def split_summary(seqs, keys=()):
    """Sequences per split."""
    return seqs.groupBy(*keys, "split").agg(F.count(F.lit(1)).alias("n_sequences"))


def _cells():
    return F.flatten("sequence")


def sequence_check(seqs, minimum=50, by=("split",)):
    """Sequences exist, are long enough and hold no NaN or infinity, targets included."""
    nan = F.exists(_cells(), lambda x: x.isNull() | F.isnan(x)) | F.col("target").isNull() | F.isnan("target")
    inf = (F.exists(_cells(), lambda x: F.coalesce(x.isin(float("inf"), float("-inf")), F.lit(False)))
           | F.coalesce(F.col("target").isin(float("inf"), float("-inf")), F.lit(False)))
    out = seqs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_sequences"), F.min(F.size("sequence")).cast("bigint").alias("min_length"),
        F.count_if(F.coalesce(nan, F.lit(False))).alias("n_nan"), F.count_if(F.coalesce(inf, F.lit(False))).alias("n_inf"))
    message = (F.when(F.col("min_length") < minimum, F.lit(msg.SEQUENCES_SHORT))
               .when(F.col("n_nan") > 0, F.lit(msg.SEQUENCES_NAN))
               .when(F.col("n_inf") > 0, F.lit(msg.SEQUENCES_INF))
               .otherwise(F.lit(msg.SEQUENCES_PASSED)))
    return out.withColumn("message", message).withColumn("valid", message == msg.SEQUENCES_PASSED)


def dims_check(seqs, length, width, by=("split",)):
    """Every sequence has `length` rows of `width` cells."""
    fits = (F.size("sequence") == length) & F.forall("sequence", lambda r: F.size(r) == width)
    return (seqs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_sequences"), F.count_if(~fits).alias("n_misfit"))
            .withColumn("valid", F.col("n_misfit") == 0))


def dataset_check(seqs, by=("split",), optional=("pair_idx", "timeframe_idx", "weight")):
    """The needed columns exist, no split is empty, and every column has a value per sequence."""
    missing = [c for c in ("sequence", "target") if c not in seqs.columns]
    if missing:
        raise ValueError(msg.DATASET_MISSING.format(missing))
    present = [c for c in ("sequence", "target", *optional) if c in seqs.columns]
    short = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in present])
    return (seqs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_sequences"), F.count_if(short).alias("n_missing"))
            .withColumn("valid", (F.col("n_sequences") > 0) & (F.col("n_missing") == 0)))


def training_data_check(seqs, minimum=1000, spread=1e-6, by=("split",)):
    """NaN, infinity, range [-1, 1], sample count, spread of all cells and of targets, in this order."""
    def infinite(x):
        return F.coalesce(x.isin(float("inf"), float("-inf")), F.lit(False))

    def missing(x):
        return x.isNull() | F.isnan(x)
    # cells are counted and summed inside their row: no row is made of a cell
    kept = F.filter("_x", lambda x: ~missing(x) & ~infinite(x))
    target = F.col("target")
    rows = seqs.select(*by, "target", _cells().alias("_x"))
    rows = rows.select(
        *by, target, F.size(F.filter("_x", missing)).alias("_nan"), F.size(F.filter("_x", infinite)).alias("_inf"),
        F.size(F.filter("_x", lambda x: F.abs(x) > 1)).alias("_out"), kept.alias("_x"))
    rows = rows.withColumn("_m", F.size("_x")).withColumn("_s", F.aggregate("_x", F.lit(0.0), lambda a, x: a + x))
    mean = F.when(F.col("_m") > 0, F.col("_s") / F.col("_m"))
    # squares around the mean of each row, and of the rows' means around the mean of all
    rows = rows.withColumn("_q", F.aggregate(F.transform("_x", lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda a, x: a + x))
    spreads = rows.withColumn("_mean", mean).drop("_x")
    out = spreads.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"), (F.sum("_nan") + F.count_if(missing(target))).alias("n_nan"),
        (F.sum("_inf") + F.count_if(infinite(target))).alias("n_inf"),
        F.sum("_out").alias("n_x_out"), F.count_if(F.abs(target) > 1).alias("n_y_out"),
        F.sum("_m").alias("_cells"), F.sum("_s").alias("_sum"), F.sum("_q").alias("_inner"),
        F.sum(F.col("_m") * F.col("_mean") * F.col("_mean")).alias("_outer"), F.stddev_pop(target).alias("std_y"))
    overall = F.col("_sum") / F.col("_cells")
    variance = (F.col("_inner") + F.greatest(F.col("_outer") - F.col("_cells") * overall * overall, F.lit(0.0))) / F.col("_cells")
    out = out.withColumn("std_x", F.when(F.col("_cells") > 0, F.sqrt(variance))).select(
        *by, "n_samples", "n_nan", "n_inf", "n_x_out", "n_y_out", "std_x", "std_y")
    message = (F.when(F.col("n_nan") > 0, F.lit(msg.TRAINING_NAN))
               .when(F.col("n_inf") > 0, F.lit(msg.TRAINING_INF))
               .when(F.col("n_x_out") > 0, F.lit(msg.TRAINING_X_RANGE))
               .when(F.col("n_y_out") > 0, F.lit(msg.TRAINING_Y_RANGE))
               .when(F.col("n_samples") < minimum, F.lit(msg.TRAINING_FEW))
               .when(F.col("std_x") < F.lit(spread), F.lit(msg.TRAINING_X_FLAT))
               .when(F.col("std_y") < F.lit(spread), F.lit(msg.TRAINING_Y_FLAT))
               .otherwise(F.lit(msg.TRAINING_PASSED)))
    return out.withColumn("message", message).withColumn("valid", message == msg.TRAINING_PASSED)
