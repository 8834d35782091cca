"""Technical indicators (W1-W6, A15, A16): RSI, SMA, EMA, MACD on numbered position blocks.

An exponential mean is an affine map of the value before it, and maps compose: a run of rows is (decay, sum), whatever came
before. Rows are cut into tiles inside which all factors fit a double; the maps of the tiles before a row are folded in order
into what they carry. Tiles further back than `_VANISHED` hold nothing that a double can show, even of the largest price
beside the smallest, so a block repeats that many rows of the one before it.
"""

import math
import sys

from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.functions.schema import KEYS, is_finite
from barworks.operators import positions
from barworks.operators.fills import carried_close
from barworks.operators.positions import (
    block_window, blocks, locate, number_bucket, number_rows, previous)
from barworks.session import settle

_VANISHED = math.log(sys.float_info.max) - math.log(5e-324)  # from the largest double to the least
_DEPTH = 300.0  # decay of a tile: prices up to e^400 times its inverse are still doubles
_BACK = math.ceil(_VANISHED / _DEPTH) + 1
_SHARE = 8  # a block is at least so many times as long as what it repeats
_TILE = 512

# Default indicator set and its parameters.
DEFAULT_INDICATORS = {
    "RSI": {"period": 14},
    "MACD": {"fast_period": 12, "slow_period": 26, "signal_period": 9},
}


def _decay(span):
    return -math.log(1 - 2 / (span + 1))


def reach(span):
    """Rows of a tile of its own for a span."""
    return 1 if span <= 1 else max(1, math.floor(_DEPTH / _decay(span)))


def memory(span):
    """Rows before a row that its exponential mean is made of."""
    return 1 if span <= 1 else math.ceil(_VANISHED / _decay(span))


def _long(before):
    """Rows of a block that repeats `before` rows."""
    return max(positions.BLOCK, _SHARE * before)


def price_change(df, value="close"):
    """`close` minus the previous close."""
    return previous(df, [value], "timestamp").withColumn(
        "price_change", F.col(value) - F.col(f"prev_{value}")).drop(f"prev_{value}")


class Scan:
    """Expressions over one block: rows sorted by (`_sub`, `rn`), so all windows share one sort."""

    def __init__(self, spans, keys=KEYS, position="rn", kept=False):
        self.position, self.keys, self.kept = position, keys, kept
        # spans that forget at like rates share tiles, which the fastest of them sets; others get tiles and a sort of their own
        self.tile_of, tile = {}, None
        for span in sorted({s for s in spans if s > 1}, reverse=True):
            if tile is None or reach(span) < tile[0] / 4:
                tile = [reach(span)]
            tile.append(span)
            self.tile_of.update(dict.fromkeys(tile[1:], reach(span)))
        self.tile = max(self.tile_of.values(), default=_TILE)
        self.block = Window.partitionBy(*keys, "_blk").orderBy("_sub", position)

    def prepare(self, df):
        return df.withColumn("_sub", F.floor(F.col(self.position) / F.lit(self.tile)))

    def last(self, n):
        return self.block.rowsBetween(-(n - 1), Window.currentRow)

    def ema(self, df, named):
        """Add the exponential mean of each `name: (column, span)`."""
        out = self.behind(df, {f"_lag_{name}": given for name, given in named.items()})
        return out.select("*", *[(F.col(c) - F.col(f"_lag_{name}")).alias(name) for name, (c, _) in named.items()]).drop(
            *[f"_lag_{name}" for name in named])

    def behind(self, df, named):
        """Add how far each exponential mean of `name: (column, span)` is behind its column.

        That distance follows r * (distance + change), so it has the digits of the changes, where the mean has those of the
        prices. Inside a tile the recurrence is r^k * running sum of r * change * r^-k. The tiles before, each as its last
        running value, fold into what the tile before ends with.
        """
        live = {name: (c, s) for name, (c, s) in named.items() if s > 1}
        out = df.select("*", *[(F.col(c) - F.col(c)).alias(name) for name, (c, s) in named.items() if s <= 1])
        for tile in sorted({self.tile_of[s] for _, s in live.values()}):
            out = self._scan(out, tile, {n: (c, s) for n, (c, s) in live.items() if self.tile_of[s] == tile})
        return out

    def _scan(self, df, tile, live):
        at = F.col(self.position)
        k = (at % F.lit(tile)).cast("double")
        sub = "_sub" if tile == self.tile else "_sub_own"
        columns = {c: f"_change_{i}" for i, c in enumerate(dict.fromkeys(c for c, _ in live.values()))}
        # the first row of a block begins at its own mean: nothing is left of what was before it, or there was nothing
        df = df.select("*", *[F.coalesce(F.col(c) - F.lag(c).over(self.block), F.col(c) - F.col(c)).alias(d) for c, d in columns.items()])
        if sub not in df.columns:
            df = df.withColumn(sub, F.floor(at / F.lit(tile)))
        inner = (Window.partitionBy(*self.keys, "_blk", sub).orderBy(self.position)
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ratio = {name: 1 - 2 / (s + 1) for name, (_, s) in live.items()}

        def local(name):
            r = F.lit(ratio[name])
            return F.pow(r, k) * F.sum(r * F.col(columns[live[name][0]]) * F.pow(r, -k)).over(inner)

        out = df.select("*", *[local(name).alias(f"_p_{name}") for name in live]).drop(*columns.values())
        # one struct per finished tile holds the ends of all
        back = max(math.ceil(_VANISHED / (tile * _decay(s))) + 1 for _, s in live.values())
        before = Window.partitionBy(*self.keys, "_blk").orderBy(sub).rangeBetween(-back, -1)
        ends = F.when(at % F.lit(tile) == tile - 1, F.struct(*[F.col(f"_p_{name}").alias(name) for name in live]))
        out = out.select("*", F.collect_list(ends).over(before).alias("_ends"))

        def carried(name):
            whole = F.lit(ratio[name] ** tile)
            return F.aggregate("_ends", F.lit(0.0), lambda so_far, end: so_far * whole + end[name])

        def given(name):
            """What the distance at position 0 is said to be adds a share that fades."""
            return F.pow(F.lit(ratio[name]), at) * F.col(f"_given_{name}") if f"_given_{name}" in df.columns else F.lit(0.0)
        out = out.select("*", *[(F.col(f"_p_{name}") + F.pow(F.lit(ratio[name]), k + 1) * carried(name) + given(name)).alias(name) for name in live])
        out = out.drop("_ends", *[f"_p_{name}" for name in live])
        if self.kept:
            out = out.withColumns({f"_kept_{name}": F.col(name) for name in live})
        return out if sub == "_sub" else out.drop(sub)


class Indicator:
    """One entry of the indicator set: how far it looks back, what it adds, when it holds.

    `lookback` rows of context make its values exact, the first `warmup` rows of a series stay NULL,
    `needs` is the condition on series facts (`n`, `n_null`, `first_null`, `n_odd`) under which the
    column set is valid. Subclass it and add it to `REGISTRY` to extend the set.
    """

    warmup = 0

    def spans(self):
        return []


class Rsi(Indicator):
    def __init__(self, period=14):
        self.period, self.columns, self.lookback = period, [f"RSI_{period}"], period

    def needs(self):
        return F.col("n") >= self.period + 1

    def add(self, df, scan):
        change = F.col("_x") - F.lag("_x").over(scan.block)
        df = df.withColumn("_d", change)
        frame = scan.last(self.period)
        # a change that is no number is none; an infinite one is missing on its side
        gain, loss = (F.avg(F.when(F.coalesce(F.isnan("_d"), F.lit(True)), F.lit(0.0)).when(side != float("inf"), F.greatest(
            side, F.lit(0.0)))).over(frame) for side in (F.col("_d"), -F.col("_d")))
        df = df.select("*", gain.alias("_g"), loss.alias("_l"))
        rsi = (F.when(F.col("_g").isNull() | F.col("_l").isNull(), F.lit(50.0))
               .when((F.col("_l") == 0) & (F.col("_g") == 0), F.lit(50.0)).when(F.col("_l") == 0, F.lit(100.0))
               .otherwise(100.0 - 100.0 / (1.0 + F.try_divide("_g", "_l"))))
        return df.withColumn(self.columns[0], rsi).drop("_d", "_g", "_l")

    def check(self, c):
        """A16 for a whole series, as aggregates over the finished columns."""
        v = F.col(c(self.columns[0]))
        return ((F.count(F.lit(1)) - F.count(v) <= F.count(F.lit(1)) * F.lit(0.1).cast("double"))
                & F.coalesce(F.bool_and(v.between(0, 100)), F.lit(True)))


class Macd(Indicator):
    def __init__(self, fast_period=12, slow_period=26, signal_period=9):
        self.fast, self.slow, self.signal = fast_period, slow_period, signal_period
        tag = f"{fast_period}_{slow_period}_{signal_period}"
        self.columns = [f"MACD_{tag}", f"MACD_Signal_{tag}"]
        self.lookback = max(memory(fast_period), memory(slow_period)) + memory(signal_period)

    def spans(self):
        return [self.fast, self.slow, self.signal]

    def needs(self):
        return ~F.col("first_null") & (F.col("n_odd") == 0)

    def add(self, df, scan):
        df = scan.behind(df, {"_fast": ("_x", self.fast), "_slow": ("_x", self.slow)})
        df = df.withColumn(self.columns[0], F.col("_slow") - F.col("_fast")).drop("_fast", "_slow")
        return scan.ema(df, {self.columns[1]: (self.columns[0], self.signal)})

    def check(self, c):
        return F.bool_and(F.coalesce(is_finite(F.col(c(self.columns[0]))) & is_finite(F.col(c(self.columns[1]))),
                                     F.lit(False)))


class Sma(Indicator):
    def __init__(self, window=None, period=None):
        self.window = window or period or 20
        self.columns, self.lookback, self.warmup = [f"SMA_{self.window}"], self.window - 1, self.window - 1

    def needs(self):
        return (F.col("n") >= self.window) & (F.col("n_null") == 0) & (F.col("n_odd") == 0)

    def add(self, df, scan):
        frame = scan.last(self.window)
        close = F.when(is_finite(F.col("close")), F.col("close"))  # an infinite close counts as missing
        mean = F.when(F.count(close).over(frame) == self.window, F.avg(close).over(frame))
        return df.withColumn(self.columns[0], mean)

    def check(self, c):
        v, n = F.col(c(self.columns[0])), F.count(F.lit(1))
        return ((n - F.count(v) <= F.least(F.lit(self.window - 1), n))
                & F.coalesce(F.bool_and(is_finite(v)), F.lit(True)) & (n >= self.window))


class Ema(Indicator):
    def __init__(self, window=None, period=None):
        self.window = window or period or 20
        self.columns, self.lookback = [f"EMA_{self.window}"], memory(self.window)

    def spans(self):
        return [self.window]

    def needs(self):
        return ~F.col("first_null") & (F.col("n_odd") == 0)

    def add(self, df, scan):
        return scan.ema(df, {self.columns[0]: ("close", self.window)})

    def check(self, c):
        return F.bool_and(F.coalesce(is_finite(F.col(c(self.columns[0]))), F.lit(False)))


REGISTRY = {"RSI": Rsi, "MACD": Macd, "SMA": Sma, "EMA": Ema}


def resolve(config=None):
    """Indicator objects for a config of `name: parameters`; unknown names are skipped."""
    config = DEFAULT_INDICATORS if config is None else config
    return [REGISTRY[name](**params) for name, params in config.items() if name in REGISTRY]


def series_facts():
    """Facts about `close` that decide which indicators a series can have."""
    close = F.col("close")
    return {
        "n_null": (F.count_if(close.isNull()), "sum"),
        "n_odd": (F.count_if(~is_finite(close)), "sum"),
        "_t0": (F.min("timestamp"), "min"),
        "_t1": (F.min(F.when(close.isNotNull(), F.col("timestamp"))), "min"),
    }


def with_first_null(df):
    return df.withColumn("first_null", ~F.coalesce(F.col("_t0") == F.col("_t1"), F.lit(False))).drop("_t0", "_t1")


def compute(numbered, indicators, extra=0, kept=False):
    """Indicator columns for numbered rows that hold `close` and the filled `_x`.

    The result still carries the repeated rows (`_own` false): `extra` of them per block are exact. `kept` leaves how far
    each mean is behind as `_kept_<name>`; a column `_given_<name>` says how far it is behind at position 0.
    """
    scan = Scan([s for i in indicators for s in i.spans()], kept=kept)
    before = max([i.lookback for i in indicators], default=0) + extra
    ordered = sorted(indicators, key=lambda i: bool(i.spans()))
    out = scan.prepare(blocks(numbered, before, _long(before), shuffle=bool(ordered) and bool(ordered[0].spans())))
    for indicator in ordered:
        out = indicator.add(out, scan)
    return out, scan


def indicators(df, config=None, validate=True, fill=True, flags=False):
    """The configured indicator columns for all series.

    With `validate`, a set that fails its check is NULL for that series (A16, D2). `fill=False` skips
    the gap filling of the close for input that should hold no NULL: a series that holds one all the same has no
    indicator but the SMA. `flags` adds `_ok_<column>`.
    """
    chosen = resolve(config)
    plain = [i for i in chosen if not (fill and isinstance(i, Ema))]
    if fill:
        numbered = carried_close(with_first_null(locate(df, ["close"], facts=series_facts())))
    else:
        numbered = with_first_null(number_rows(df, facts=series_facts())).withColumn("_x", F.col("close"))
    out, _ = compute(numbered, plain)
    out = out.where("_own").drop("_blk", "_own", "_sub")
    for gap_aware in [i for i in chosen if i not in plain]:
        out = ema_gaps(out, gap_aware.window, alias=gap_aware.columns[0])

    def holds(i):
        return i.needs() if fill or isinstance(i, Sma) else i.needs() & (F.col("n_null") == 0)
    if validate:
        out = out.select(*[c for c in out.columns if c not in column_names(chosen)], *[
            F.when(holds(i), F.col(c)).alias(c) for i in chosen for c in i.columns])
    elif not fill:
        whole = [c for i in chosen if not isinstance(i, Sma) for c in i.columns]
        out = out.select(*[F.when(F.col("n_null") == 0, F.col(c)).alias(c) if c in whole else F.col(c) for c in out.columns])
    marks = [holds(i).alias(f"_ok_{c}") for i in chosen for c in i.columns] if flags else []
    return out.select(*df.columns, *column_names(chosen), *marks)


def column_names(chosen):
    return [c for i in chosen for c in i.columns]


def rsi(df, period=14, fill=True):
    """Simple-mean RSI (W2); NULL for a series of fewer than period + 1 rows."""
    return indicators(df, {"RSI": {"period": period}}, fill=fill)


def sma(df, window=20):
    """Simple moving mean, NULL until `window` non-null values."""
    return indicators(df, {"SMA": {"window": window}}, validate=False, fill=False)


def macd(df, fast=12, slow=26, signal=9, fill=True):
    """MACD line and signal."""
    return indicators(df, {"MACD": {"fast_period": fast, "slow_period": slow, "signal_period": signal}}, fill=fill)


def ema(df, window=20, gaps=True):
    """Exponential mean of `close` (W3). `gaps=False` is for series without a NULL close; one that holds any has none."""
    if not gaps:
        return indicators(df, {"EMA": {"window": window}}, validate=False, fill=False)
    numbered = number_rows(df)
    return ema_gaps(numbered, window, f"EMA_{window}").select(*df.columns, f"EMA_{window}")


def ema_gaps(numbered, window, alias, keys=KEYS):
    """Exponential mean with NULL closes: carried over a gap, whose length lowers the old weight.

    Observed rows get positions of their own; a tile spans a given decay, so factors stay in range however long the gaps
    are, and a tile is the map (decay, sum) that its last row has reached.
    """
    rest = [c for c in numbered.columns if c not in ("_b", "n", "rn")]
    seen = numbered.where(F.col("close").isNotNull()).drop("_b", "n")
    seen = number_rows(seen.withColumnRenamed("rn", "_at"), order=["_at"], bucket=number_bucket("_at"), unique=True)
    a, r = 2 / (window + 1), 1 - 2 / (window + 1)
    if window <= 1:
        scanned = seen.withColumn(alias, F.col("close"))
    else:
        before = memory(window) + 1
        rows = blocks(seen, before, _long(before))
        w = block_window()
        gap = (F.col("_at") - F.lag("_at").over(w)).cast("double")
        weight = F.pow(F.lit(r), gap)
        rows = rows.withColumn("_w", weight)
        decay = F.least(-F.log(F.col("_w") / (F.col("_w") + F.lit(a))), F.lit(_VANISHED))
        first = F.col("rn") == 0
        rows = rows.select(
            "*", F.when(F.col("_w").isNull(), F.lit(0.0)).when(F.col("_w") == 0, F.lit(_VANISHED)).otherwise(decay).alias("_q"),
            F.when(first, F.col("close")).otherwise(
                F.coalesce(F.lit(a) / (F.col("_w") + F.lit(a)), F.lit(1.0)) * F.col("close")).alias("_u"))
        total = F.sum("_q").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        rows = rows.withColumn("_sub", F.floor(total / F.lit(_DEPTH)))
        run = Window.partitionBy(*keys, "_blk", "_sub").orderBy("rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # decay since the tile before, and since the first row of this one
        rows = rows.withColumn("_lp", F.sum("_q").over(run)).withColumn("_lq", F.col("_lp") - F.first("_q").over(run))
        rows = rows.withColumn("_p", F.exp(-F.col("_lq")) * F.sum(F.col("_u") * F.exp("_lq")).over(run))
        block = Window.partitionBy(*keys, "_blk").orderBy("_sub", "rn")
        closes = F.coalesce(F.lead("_sub").over(block) != F.col("_sub"), F.lit(False))
        rows = rows.withColumn("_end", F.when(closes, F.struct(F.exp(-F.col("_lp")).alias("decay"), F.col("_p").alias("sum"))))
        tiles = F.collect_list("_end").over(Window.partitionBy(*keys, "_blk").orderBy("_sub").rangeBetween(-_BACK, -1))
        rows = rows.withColumn("_ends", tiles)
        carry = F.aggregate("_ends", F.lit(0.0), lambda so_far, end: so_far * end["decay"] + end["sum"])
        scanned = rows.withColumn(alias, F.col("_p") + F.exp(-F.col("_lp")) * carry).where("_own")
    blank = (numbered.where(F.col("close").isNull())
             .select(*rest, F.col("rn").alias("_at"), F.lit(None).cast("double").alias(alias)))
    # every row was read several times to get here: later passes start from what is written
    both = settle(scanned.select(*rest, "_at", alias).unionByName(blank))
    out = locate(both, [alias], order=["_at"], bucket=number_bucket("_at"), unique=True)
    out = out.withColumn(alias, F.col(f"pv_{alias}"))
    return out.drop(*[f"{s}_{alias}" for s in ("pr", "pv", "nr", "nv", "run")], "_at")


def indicator_check(df, config=None, keys=KEYS):
    """One row per series and indicator, from the finished columns."""
    chosen = resolve(config)
    ready = indicators(df, config, validate=False)
    # a series too short for an RSI never gets the column
    checks = [F.coalesce(i.check(lambda c: c) & (F.count(F.lit(1)) >= i.period + 1 if isinstance(i, Rsi)
                                                 else F.lit(True)), F.lit(False)) for i in chosen]
    wide = ready.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[
        c.alias(i.columns[0]) for c, i in zip(checks, chosen)])
    pairs = F.array(*[F.struct(F.lit(i.columns[0]).alias("indicator"), F.col(i.columns[0]).alias("valid"))
                      for i in chosen])
    return wide.select(*keys, "n_rows", F.explode(pairs).alias("c")).select(*keys, "n_rows", "c.indicator", "c.valid")


def input_check(df, keys=KEYS):
    """Is the close series usable at all; a report, nothing is dropped."""
    n, nulls = F.count(F.lit(1)), F.count_if(F.col("close").isNull())
    odd = F.count_if(F.col("close").isin(float("inf"), float("-inf")))
    out = df.groupBy(*keys).agg(n.alias("n_rows"), nulls.alias("n_null"), odd.alias("n_inf"))
    message = (F.when(F.col("n_null") / F.col("n_rows") > F.lit(0.5).cast("double"), F.lit("too many missing values"))
               .when(F.col("n_inf") > 0, F.lit("infinite values"))
               .when(F.col("n_rows") < 2, F.lit("not enough data points")).otherwise(F.lit("")))
    return out.withColumn("message", message).withColumn("valid", F.col("message") == "")
