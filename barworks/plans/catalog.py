"""Every registered query: a Spark plan over the given tables and, where SQL can say it, its oracle."""

from urllib.parse import unquote

from pyspark.sql import functions as F

from barworks.functions.schema import KEYS, VALUES, day_key, downcast, series_file_key, timeframe_seconds
from barworks.operators import features as ft
from barworks.operators import fills, incremental, indicators, quality, rows, sentiment, ttl
from barworks.operators.positions import number_rows
from barworks.plans import training
from barworks.plans.fixtures import oracle, table, view
from barworks.session import shared_folder
from barworks.sources import candles, store, texts
from barworks.streaming.pages import pages_to_store

QUERIES, ORACLES = {}, {}
AS_OF = "2024-01-30 00:00:00"
ARRIVAL = ("timestamp", "ingest_seq")
HOUR_PAIRS = ["click", "error", "purchase", "signup", "view"]


def register(name, views=(), sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(views, sql)
        return fn
    return keep


def rounded(df, places=6, only=None):
    """Doubles rounded for comparison; adding zero turns -0.0 into 0.0."""
    return df.select([(F.round(f.name, places) + F.lit(0.0)).alias(f.name)
                      if f.dataType.typeName() == "double" and (only is None or f.name in only) else F.col(f.name)
                      for f in df.schema.fields])


def r6(*columns, places=6):
    return ", ".join(f"round({c}, {places}) + 0.0 AS {c}" for c in columns)


def once(spark, sf):
    """`bars_dirty` without the copies that arrived late."""
    return rows.keep_first(view(spark, sf, "bars_dirty"), ["ingest_seq"]).drop("ingest_seq")


ONCE_SQL = """
bars_once AS (SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY pair, timeframe, timestamp ORDER BY ingest_seq) AS r FROM bars_dirty) WHERE r = 1)"""

BY = "PARTITION BY pair, timeframe"
BARS = "pair, timeframe, timestamp, open, high, low, close, volume"

# ---- indicators -------------------------------------------------------------------------------


def rsi_sql(t, x="close"):
    return f"""
d AS (SELECT *, {x} - lag({x}) OVER ({BY} ORDER BY timestamp) AS d FROM {t}),
gl AS (SELECT *, sum(greatest(coalesce(d, 0), 0)) OVER f AS g, sum(greatest(-coalesce(d, 0), 0)) OVER f AS l,
         count(*) OVER ({BY}) AS n
       FROM d WINDOW f AS ({BY} ORDER BY timestamp ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
rsi AS (SELECT *, CASE WHEN n < 15 THEN NULL WHEN g = 0 AND l = 0 THEN 50.0 WHEN l = 0 THEN 100.0
          ELSE 100.0 - 100.0 / (1.0 + g / l) END AS RSI_14 FROM gl)"""


def ema_sql(t, x="close"):
    """EMA 12, 26, 20 and the signal of their difference, one bar per step."""
    return f"""
o AS (SELECT pair, timeframe, timestamp, cast({x} AS DOUBLE) AS x, row_number() OVER ({BY} ORDER BY timestamp) AS k FROM {t}),
e(pair, timeframe, k, fast, slow, ema, sig) AS (
  SELECT pair, timeframe, k, x, x, x, cast(0 AS DOUBLE) FROM o WHERE k = 1
  UNION ALL
  SELECT pair, timeframe, k, fast, slow, ema, 0.2 * (fast - slow) + 0.8 * sig FROM (
    SELECT o.pair, o.timeframe, o.k, e.sig,
           cast(2 AS DOUBLE) / 13 * o.x + cast(11 AS DOUBLE) / 13 * e.fast AS fast,
           cast(2 AS DOUBLE) / 27 * o.x + cast(25 AS DOUBLE) / 27 * e.slow AS slow,
           cast(2 AS DOUBLE) / 21 * o.x + cast(19 AS DOUBLE) / 21 * e.ema AS ema
    FROM e JOIN o ON o.pair = e.pair AND o.timeframe = e.timeframe AND o.k = e.k + 1)),
macd AS (SELECT o.pair, o.timeframe, o.timestamp, e.fast - e.slow AS MACD_12_26_9, e.sig AS MACD_Signal_12_26_9, e.ema AS EMA_20
         FROM o JOIN e ON o.pair = e.pair AND o.timeframe = e.timeframe AND o.k = e.k)"""


def sma_sql(t):
    return f"""
sma AS (SELECT *, CASE WHEN count(close) OVER f = 20 THEN avg(close) OVER f END AS SMA_20 FROM {t}
        WINDOW f AS ({BY} ORDER BY timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""


KEYED = "pair, timeframe, timestamp"


@register("price_change", ["bars_hour"], f"""
SELECT {KEYED}, round(close - lag(close) OVER ({BY} ORDER BY timestamp), 6) + 0.0 AS price_change FROM bars_hour""")
def _(spark, sf):
    return rounded(indicators.price_change(view(spark, sf, "bars_hour")).select(*KEYS, "timestamp", "price_change"))


@register("rsi_14", ["bars_hour"], f"WITH {rsi_sql('bars_hour')}\nSELECT {KEYED}, {r6('RSI_14')} FROM rsi")
def _(spark, sf):
    return rounded(indicators.rsi(view(spark, sf, "bars_hour")).select(*KEYS, "timestamp", "RSI_14"))


@register("rsi_14_supplier", ["bars_supplier"],
          f"WITH {rsi_sql('bars_supplier')}\nSELECT {KEYED}, {r6('RSI_14')} FROM rsi")
def _(spark, sf):
    return rounded(indicators.rsi(view(spark, sf, "bars_supplier"), fill=False).select(*KEYS, "timestamp", "RSI_14"))


@register("sma_20", ["bars_day"], f"WITH {sma_sql('bars_day')}\nSELECT {KEYED}, {r6('SMA_20')} FROM sma")
def _(spark, sf):
    return rounded(indicators.sma(view(spark, sf, "bars_day")).select(*KEYS, "timestamp", "SMA_20"))


@register("ema_20", ["bars_hour"], f"WITH {ema_sql('bars_hour')}\nSELECT {KEYED}, {r6('EMA_20')} FROM macd")
def _(spark, sf):
    return rounded(indicators.ema(view(spark, sf, "bars_hour")).select(*KEYS, "timestamp", "EMA_20"))


MACD = ("MACD_12_26_9", "MACD_Signal_12_26_9")


@register("macd_12_26_9", ["bars_hour"], f"WITH {ema_sql('bars_hour')}\nSELECT {KEYED}, {r6(*MACD)} FROM macd")
def _(spark, sf):
    return rounded(indicators.macd(view(spark, sf, "bars_hour")).select(*KEYS, "timestamp", *MACD))


ALL_INDICATORS = {**indicators.DEFAULT_INDICATORS, "SMA": {"window": 20}, "EMA": {"period": 20}}
INDICATOR_COLUMNS = ("RSI_14", *MACD, "SMA_20", "EMA_20")


@register("indicators", ["bars_hour"], f"""
WITH {rsi_sql('bars_hour')}, {ema_sql('bars_hour')}, {sma_sql('bars_hour')}
SELECT {KEYED}, {r6(*INDICATOR_COLUMNS)} FROM rsi JOIN macd USING ({KEYED}) JOIN (SELECT {KEYED}, SMA_20 FROM sma) USING ({KEYED})""")
def _(spark, sf):
    df = indicators.indicators(view(spark, sf, "bars_hour"), ALL_INDICATORS, fill=False)
    return rounded(df.select(*KEYS, "timestamp", *INDICATOR_COLUMNS))


# the bars come in three pieces; each continues from the state that the one before left
@register("indicators_append", ["bars_hour"], f"""
WITH {rsi_sql('bars_hour')}, {ema_sql('bars_hour')}, {sma_sql('bars_hour')}
SELECT {KEYED}, {r6(*INDICATOR_COLUMNS)} FROM rsi JOIN macd USING ({KEYED}) JOIN (SELECT {KEYED}, SMA_20 FROM sma) USING ({KEYED})""")
def _(spark, sf):
    bars, out, state = view(spark, sf, "bars_hour"), [], None
    third = F.pmod(F.floor(F.unix_seconds("timestamp") / F.lit(3600 * 24 * 10)), F.lit(1 << 40))
    low, high = bars.agg(F.min(third), F.max(third)).first()
    for i in range(3):
        piece = F.least(F.floor((third - low) * 3 / (high - low + 1)), F.lit(2)) == i
        done, state = incremental.advance(bars.where(piece), state, ALL_INDICATORS)
        out.append(done)
    shown = incremental.valid_only(rows.union_all(*out), state, ALL_INDICATORS)
    return rounded(shown.select(*KEYS, "timestamp", *INDICATOR_COLUMNS))


# ---- fills ------------------------------------------------------------------------------------


def near_sql(columns=VALUES, t="bars_dirty"):
    def near(c, name, fn, frame):
        return (f"{fn}({c} IGNORE NULLS) OVER {frame} AS {name}v_{c}, "
                f"{fn}(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER {frame} AS {name}r_{c}")
    cells = ", ".join(near(c, "p", "last_value", "b") + ", " + near(c, "n", "first_value", "a") for c in columns)
    return f"""
p AS (SELECT *, row_number() OVER ({BY} ORDER BY timestamp, ingest_seq) AS rn, count(*) OVER ({BY}) AS n FROM {t}),
q AS (SELECT *, {cells} FROM p
      WINDOW b AS ({BY} ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             a AS ({BY} ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def line_sql(c, limit=5):
    return (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN rn - pr_{c} > {limit} THEN NULL WHEN nr_{c} IS NULL THEN pv_{c} "
            f"ELSE pv_{c} + (nv_{c} - pv_{c}) / (nr_{c} - pr_{c}) * (rn - pr_{c}) END")


def both_sql(c, limit=5):
    return (f"coalesce({c}, CASE WHEN rn - pr_{c} <= {limit} THEN pv_{c} END, "
            f"CASE WHEN nr_{c} - rn <= {limit} THEN nv_{c} END)")


def filled(expr):
    cells = ", ".join(f"round({expr(c)}, 6) + 0.0 AS {c}" for c in VALUES)
    return f"SELECT pair, timeframe, timestamp, ingest_seq, {cells}"


def run_sql(c):
    return f"coalesce(max(CASE WHEN {c} IS NULL THEN coalesce(nr_{c}, n + 1) - coalesce(pr_{c}, 0) - 1 END), 0)"


@register("interpolate_5", ["bars_dirty"], f"WITH {near_sql()}\n{filled(line_sql)} FROM q")
def _(spark, sf):
    return rounded(fills.interpolate_linear(view(spark, sf, "bars_dirty"), order=ARRIVAL))


@register("ffill_3", ["bars_dirty"], f"WITH {near_sql()}\n" + filled(
    lambda c: f"coalesce({c}, CASE WHEN rn - pr_{c} <= 3 THEN pv_{c} END)") + " FROM q")
def _(spark, sf):
    return rounded(fills.ffill(view(spark, sf, "bars_dirty"), limit=3, order=ARRIVAL))


@register("bfill_3", ["bars_dirty"], f"WITH {near_sql()}\n" + filled(
    lambda c: f"coalesce({c}, CASE WHEN nr_{c} - rn <= 3 THEN nv_{c} END)") + " FROM q")
def _(spark, sf):
    return rounded(fills.bfill(view(spark, sf, "bars_dirty"), limit=3, order=ARRIVAL))


@register("null_runs", ["bars_dirty"], f"""WITH {near_sql()}
SELECT pair, timeframe, {', '.join(f'cast({run_sql(c)} AS BIGINT) AS run_{c}' for c in VALUES)} FROM q GROUP BY pair, timeframe""")
def _(spark, sf):
    return fills.null_run_length(view(spark, sf, "bars_dirty"), order=ARRIVAL)


@register("fill_gaps", ["bars_dirty"], f"""WITH {near_sql()},
runs AS (SELECT pair, timeframe, {', '.join(f'{run_sql(c)} AS run_{c}' for c in VALUES)} FROM q GROUP BY pair, timeframe)
""" + filled(lambda c: f"CASE WHEN run_{c} <= 5 THEN {line_sql(c)} ELSE {both_sql(c)} END")
          + " FROM q JOIN runs USING (pair, timeframe)")
def _(spark, sf):
    return rounded(fills.fill_gaps(view(spark, sf, "bars_dirty"), order=ARRIVAL))


@register("fill_gaps_effective", ["bars_dirty"], f"WITH {near_sql()}\n{filled(line_sql)} FROM q")
def _(spark, sf):
    return rounded(fills.fill_gaps(view(spark, sf, "bars_dirty"), mode="effective", order=ARRIVAL))


@register("fill_all", ["bars_dirty"], f"""WITH {near_sql()},
z AS ({filled(lambda c: f'coalesce({c}, pv_{c}, nv_{c})')} FROM q)
SELECT * FROM z WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL""")
def _(spark, sf):
    return rounded(fills.fill_all(view(spark, sf, "bars_dirty"), order=ARRIVAL))


X_SQL = ("CASE WHEN close IS NOT NULL THEN close WHEN nr_close IS NULL THEN pv_close ELSE pv_close + "
         "(nv_close - pv_close) / (nr_close - pr_close) * (least(rn, pr_close + 5) - pr_close) END")


@register("rsi_14_gaps", ["bars_dirty"], f"""WITH {ONCE_SQL}, {near_sql(('close',), 'bars_once').replace(' AS n ', ' AS n_all ')},
x AS (SELECT pair, timeframe, timestamp, {X_SQL} AS x FROM q), {rsi_sql('x', 'x')}
SELECT {KEYED}, {r6('RSI_14')} FROM rsi""")
def _(spark, sf):
    return rounded(indicators.rsi(once(spark, sf)).select(*KEYS, "timestamp", "RSI_14"))


@register("rsi_inf", ["bars_hour"], f"""
WITH k AS (SELECT *, row_number() OVER ({BY} ORDER BY timestamp) AS rn FROM bars_hour),
t AS (SELECT pair, timeframe, timestamp, CASE WHEN rn % 40 = 0 THEN cast('Infinity' AS DOUBLE) WHEN rn % 97 = 0 THEN cast('-Infinity' AS DOUBLE) ELSE close END AS x FROM k),
d AS (SELECT *, x - lag(x) OVER ({BY} ORDER BY timestamp) AS d FROM t),
h AS (SELECT *, CASE WHEN d IS NULL OR isnan(d) THEN 0 WHEN d = 'Infinity' THEN NULL ELSE greatest(d, 0) END AS up,
        CASE WHEN d IS NULL OR isnan(d) THEN 0 WHEN d = '-Infinity' THEN NULL ELSE greatest(-d, 0) END AS down FROM d),
gl AS (SELECT *, avg(up) OVER f AS g, avg(down) OVER f AS l FROM h WINDOW f AS ({BY} ORDER BY timestamp ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT {KEYED}, round(CASE WHEN g IS NULL OR l IS NULL OR (g = 0 AND l = 0) THEN 50.0 WHEN l = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + g / l) END, 6) + 0.0 AS RSI_14 FROM gl""")
def _(spark, sf):
    bars = number_rows(view(spark, sf, "bars_hour"))
    close = (F.when((F.col("rn") + 1) % 40 == 0, float("inf")).when((F.col("rn") + 1) % 97 == 0, float("-inf"))
             .otherwise(F.col("close")))
    return rounded(indicators.rsi(bars.withColumn("close", close).drop("rn", "n", "_b")).select(*KEYS, "timestamp", "RSI_14"))


def spiked(spark, sf):
    """Daily bars with one close of 1e60 in each series."""
    bars = number_rows(view(spark, sf, "bars_day"))
    return bars.withColumn("close", F.when(F.col("rn") == 414, 1e60).otherwise(F.col("close"))).drop("rn", "n", "_b")


@register("ema_spike", ["bars_day"], f"""
WITH t AS (SELECT * REPLACE (CASE WHEN row_number() OVER ({BY} ORDER BY timestamp) = 415 THEN 1e60 ELSE close END AS close) FROM bars_day),
{ema_sql('t')}
SELECT {KEYED}, round(ln(EMA_20), 6) + 0.0 AS ln_ema FROM macd""")
def _(spark, sf):
    out = indicators.ema(spiked(spark, sf), gaps=False)
    return rounded(out.select(*KEYS, "timestamp", F.log("EMA_20").alias("ln_ema")))


@register("ema_20_gaps", ["bars_dirty"], f"""
WITH {ONCE_SQL}, p AS (SELECT pair, timeframe, timestamp, close, row_number() OVER ({BY} ORDER BY timestamp) AS rn FROM bars_once),
s AS (SELECT *, row_number() OVER ({BY} ORDER BY rn) AS k, rn - lag(rn) OVER ({BY} ORDER BY rn) AS g FROM p WHERE close IS NOT NULL),
e(pair, timeframe, k, rn, y) AS (
  SELECT pair, timeframe, k, rn, cast(close AS DOUBLE) FROM s WHERE k = 1
  UNION ALL
  SELECT s.pair, s.timeframe, s.k, s.rn,
         (pow(cast(19 AS DOUBLE) / 21, s.g) * e.y + cast(2 AS DOUBLE) / 21 * s.close) / (pow(cast(19 AS DOUBLE) / 21, s.g) + cast(2 AS DOUBLE) / 21)
  FROM e JOIN s ON s.pair = e.pair AND s.timeframe = e.timeframe AND s.k = e.k + 1)
SELECT p.pair, p.timeframe, p.timestamp,
       round(last_value(e.y IGNORE NULLS) OVER (PARTITION BY p.pair, p.timeframe ORDER BY p.rn), 6) + 0.0 AS EMA_20
FROM p LEFT JOIN e ON e.pair = p.pair AND e.timeframe = p.timeframe AND e.rn = p.rn""")
def _(spark, sf):
    return rounded(indicators.ema(once(spark, sf)).select(*KEYS, "timestamp", "EMA_20"))


GAP_EMA_SQL = f"""
s AS (SELECT *, row_number() OVER ({BY} ORDER BY rn) AS k, rn - lag(rn) OVER ({BY} ORDER BY rn) AS g FROM q WHERE close IS NOT NULL),
ge(pair, timeframe, k, rn, y) AS (
  SELECT pair, timeframe, k, rn, cast(close AS DOUBLE) FROM s WHERE k = 1
  UNION ALL
  SELECT s.pair, s.timeframe, s.k, s.rn,
         (pow(cast(19 AS DOUBLE) / 21, s.g) * ge.y + cast(2 AS DOUBLE) / 21 * s.close) / (pow(cast(19 AS DOUBLE) / 21, s.g) + cast(2 AS DOUBLE) / 21)
  FROM ge JOIN s ON s.pair = ge.pair AND s.timeframe = ge.timeframe AND s.k = ge.k + 1),
gema AS (SELECT q.pair, q.timeframe, q.timestamp,
           last_value(ge.y IGNORE NULLS) OVER (PARTITION BY q.pair, q.timeframe ORDER BY q.rn) AS GAP_EMA_20
         FROM q LEFT JOIN ge ON ge.pair = q.pair AND ge.timeframe = q.timeframe AND ge.rn = q.rn)"""


def opened(spark, sf):
    """`bars_dirty` once, every series starting with a close."""
    bars = rows.keep_first(view(spark, sf, "bars_dirty"), ["ingest_seq"])
    return bars.withColumn("close", F.when(F.col("ingest_seq") == 1, F.col("open")).otherwise(F.col("close"))).drop("ingest_seq")


OPENED_SQL = ONCE_SQL + ",\nbars_opened AS (SELECT * REPLACE (CASE WHEN ingest_seq = 1 THEN open ELSE close END AS close) FROM bars_once)"


@register("indicators_gaps", ["bars_dirty"], f"""WITH {OPENED_SQL}, {near_sql(('close',), 'bars_opened').replace(' AS n ', ' AS n_all ')},
x AS (SELECT pair, timeframe, timestamp, {X_SQL} AS x FROM q), {rsi_sql('x', 'x')}, {ema_sql('x', 'x')}, {GAP_EMA_SQL}
SELECT {KEYED}, {r6('RSI_14', *MACD)}, cast(NULL AS DOUBLE) AS SMA_20, round(GAP_EMA_20, 6) + 0.0 AS EMA_20
FROM rsi JOIN macd USING ({KEYED}) JOIN gema USING ({KEYED})""")
def _(spark, sf):
    df = indicators.indicators(opened(spark, sf), ALL_INDICATORS)
    return rounded(df.select(*KEYS, "timestamp", *INDICATOR_COLUMNS))


@register("indicator_check", ["bars_dirty"], f"""
WITH {ONCE_SQL}, c AS (SELECT pair, timeframe, count(*) AS n_rows, count(close) AS seen,
             arg_min(close, timestamp) IS NOT NULL AND min(timestamp) FILTER (close IS NOT NULL) = min(timestamp) AS starts
           FROM bars_once GROUP BY pair, timeframe)
SELECT pair, timeframe, n_rows, 'RSI_14' AS indicator, n_rows >= 15 AS valid FROM c
UNION ALL SELECT pair, timeframe, n_rows, 'MACD_12_26_9', starts FROM c
UNION ALL SELECT pair, timeframe, n_rows, 'SMA_20', n_rows >= 20 AND seen = n_rows FROM c
UNION ALL SELECT pair, timeframe, n_rows, 'EMA_20', starts FROM c""")
def _(spark, sf):
    return indicators.indicator_check(once(spark, sf), ALL_INDICATORS)


@register("input_check", ["bars_dirty"], """
WITH t AS (SELECT * REPLACE (CASE WHEN pair = 'click' AND ingest_seq % 50 = 10 THEN cast('Infinity' AS DOUBLE)
                                  WHEN pair = 'view' AND ingest_seq % 5 > 0 THEN NULL ELSE close END AS close) FROM bars_dirty),
c AS (SELECT pair, timeframe, count(*) AS n_rows, count(*) - count(close) AS n_null, count(*) FILTER (isinf(close)) AS n_inf FROM t GROUP BY pair, timeframe),
m AS (SELECT *, CASE WHEN n_null / n_rows > 0.5 THEN 'too many missing values' WHEN n_inf > 0 THEN 'infinite values'
                     WHEN n_rows < 2 THEN 'not enough data points' ELSE '' END AS message FROM c)
SELECT *, message = '' AS valid FROM m""")
def _(spark, sf):
    at = F.col("ingest_seq")
    close = (F.when((F.col("pair") == "click") & (at % 50 == 10), float("inf"))
             .when((F.col("pair") == "view") & (at % 5 > 0), F.lit(None)).otherwise(F.col("close")))
    return indicators.input_check(view(spark, sf, "bars_dirty").withColumn("close", close))


# ---- rows -------------------------------------------------------------------------------------

SOUND = " AND ".join(f"{c} >= 0" for c in VALUES) + " AND high >= low AND high >= open AND high >= close AND low <= open AND low <= close"


@register("clean_bars", ["bars_dirty"], f"SELECT DISTINCT {BARS} FROM bars_dirty WHERE {SOUND}")
def _(spark, sf):
    return rows.clean_bars(view(spark, sf, "bars_dirty").drop("ingest_seq"))


@register("distinct_rows", ["bars_dirty"], f"SELECT DISTINCT {BARS} FROM bars_dirty")
def _(spark, sf):
    return rows.distinct_rows(view(spark, sf, "bars_dirty").drop("ingest_seq"))


@register("drop_incomplete", ["bars_dirty"], f"SELECT {BARS}, ingest_seq FROM bars_dirty WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in VALUES))
def _(spark, sf):
    return rows.drop_incomplete(view(spark, sf, "bars_dirty"))


@register("drop_no_indicator", ["bars_day"], f"""WITH {sma_sql('bars_day')}
SELECT {KEYED}, {r6('SMA_20')} FROM sma WHERE SMA_20 IS NOT NULL""")
def _(spark, sf):
    df = indicators.sma(view(spark, sf, "bars_day")).select(*KEYS, "timestamp", "SMA_20")
    return rounded(fills.drop_no_indicator(df))


ISSUE_SQL = {
    "high_below_low": "high < low",
    "high_not_highest": "(coalesce(high < open, false) OR coalesce(high < close, false))",
    "low_not_lowest": "(coalesce(low > open, false) OR coalesce(low > close, false))",
    "bad_volume": "volume <= 0",
}
ISSUE_ROWS = " UNION ALL ".join(f"SELECT pair, timeframe, timestamp, ingest_seq, '{n}' AS issue, {i} AS no FROM bars_dirty WHERE {c}"
                                for i, (n, c) in enumerate(ISSUE_SQL.items()))
FIRST_SQL = f"""
t AS ({ISSUE_ROWS}),
first_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair, timeframe, issue ORDER BY timestamp, ingest_seq) AS rank FROM t) WHERE rank <= 5)"""


@register("first_5", ["bars_dirty"], f"WITH {FIRST_SQL}\nSELECT pair, timeframe, issue, rank, timestamp, ingest_seq FROM first_rows")
def _(spark, sf):
    return rows.first_offenders(view(spark, sf, "bars_dirty"), ARRIVAL)


@register("consistency", ["bars_dirty"], f"""WITH {FIRST_SQL},
m AS (SELECT pair, timeframe, no, CASE no WHEN 0 THEN 'High < Low' WHEN 1 THEN 'High not highest' WHEN 2 THEN 'Low not lowest' ELSE 'Invalid volume' END
        || ' at: ' || string_agg(strftime(timestamp, '%Y-%m-%d %H:%M:%S'), ', ' ORDER BY rank) AS line FROM first_rows GROUP BY pair, timeframe, no),
msg AS (SELECT pair, timeframe, string_agg(line, '; ' ORDER BY no) AS message FROM m GROUP BY pair, timeframe),
c AS (SELECT pair, timeframe, {', '.join(f'count(*) FILTER ({c}) AS n_{n}' for n, c in ISSUE_SQL.items())} FROM bars_dirty GROUP BY pair, timeframe)
SELECT c.*, message IS NULL AS valid, coalesce(message, 'Data consistency validation passed') AS message
FROM c LEFT JOIN msg USING (pair, timeframe)""")
def _(spark, sf):
    return rows.consistency_report(view(spark, sf, "bars_dirty"), ARRIVAL)


# ---- quality ----------------------------------------------------------------------------------

NULLS = {c: f"(count(*) - count({c})) / count(*)" for c in VALUES}
WORST = f"greatest({', '.join(NULLS.values())})"


@register("null_ratio", ["bars_dirty"], f"""
SELECT pair, timeframe, {', '.join(f'round({e}, 6) + 0.0 AS null_{c}' for c, e in NULLS.items())},
       round({WORST}, 6) + 0.0 AS max_ratio, {WORST} <= 0.15 AS valid FROM bars_dirty GROUP BY pair, timeframe""")
def _(spark, sf):
    return rounded(quality.null_ratio(view(spark, sf, "bars_dirty"), VALUES))


@register("missing_ratio_max", ["bars_dirty"], f"""
SELECT pair, timeframe, round({WORST}, 6) + 0.0 AS max_ratio, {WORST} <= 0.35 AS valid FROM bars_dirty GROUP BY pair, timeframe""")
def _(spark, sf):
    return rounded(quality.missing_ratio_max(view(spark, sf, "bars_dirty"), VALUES))


@register("nan_report", ["bars_dirty"], f"""
SELECT pair, timeframe, CASE {' '.join(f"WHEN {e} > 0.10 THEN '{c}'" for c, e in NULLS.items())} END AS failed_column,
       {WORST} <= 0.10 AS valid,
       cast(count(*) FILTER (ingest_seq % 3 = 0 AND pair < 'm') / count(*) > 0.20 AS BIGINT) AS n_warnings FROM bars_dirty GROUP BY pair, timeframe""")
def _(spark, sf):
    gone = (F.col("ingest_seq") % 3 == 0) & (F.col("pair") < "m")
    out = quality.nan_report(view(spark, sf, "bars_dirty").withColumn("RSI_14", F.when(~gone, F.lit(50.0))))
    return out.withColumn("n_warnings", F.size("warnings").cast("bigint")).drop("warnings")


@register("min_length", ["bars_hour"], """
SELECT pair, timeframe, count(*) AS n_rows, count(*) >= 50 AS valid FROM bars_hour GROUP BY pair, timeframe""")
def _(spark, sf):
    return quality.min_length(view(spark, sf, "bars_hour"))


@register("all_numeric_complete", ["bars_dirty"], f"""
SELECT pair, timeframe, {WORST} = 0 AS complete, true AS numeric, {WORST} = 0 AS valid FROM bars_dirty GROUP BY pair, timeframe""")
def _(spark, sf):
    return quality.all_numeric_complete(view(spark, sf, "bars_dirty"))


LOW = " AND ".join(f"coalesce(var_samp({c}) >= 1e-6, true)" for c in VALUES)


@register("low_variance", ["bars_day"], f"""
SELECT pair, timeframe, {', '.join(f'round(ln(var_samp({c})), 6) + 0.0 AS var_{c}' for c in VALUES)}, {LOW} AS valid
FROM bars_day GROUP BY pair, timeframe""")
def _(spark, sf):
    # variances of prices are large: their logarithm has as many places as a double can vouch for
    out = quality.low_variance(view(spark, sf, "bars_day"))
    return rounded(out.withColumns({f"var_{c}": F.log(f"var_{c}") for c in VALUES}))


MOMENTS = "m AS (SELECT pair, timeframe, " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in VALUES) + " FROM {t} GROUP BY pair, timeframe)"
OUTLIERS = ", ".join(f"count(*) FILTER (s_{c} > 0 AND abs({c} - m_{c}) > 3 * s_{c}) AS outliers_{c}" for c in VALUES)


@register("outliers", ["bars_day"], f"""
WITH {MOMENTS.format(t='bars_day')}
SELECT pair, timeframe, {OUTLIERS} FROM bars_day JOIN m USING (pair, timeframe) GROUP BY pair, timeframe""")
def _(spark, sf):
    return quality.outlier_counts(view(spark, sf, "bars_day"))


@register("quality_report", ["bars_dirty"], f"""
WITH {MOMENTS.format(t='bars_dirty')},
w AS (SELECT pair, timeframe, {WORST} AS max_null_ratio, least({', '.join(f'var_samp({c})' for c in VALUES)}) AS min_variance,
        {', '.join(f'count(*) FILTER ({c}) AS n_{n}' for n, c in ISSUE_SQL.items())}, {OUTLIERS}
      FROM bars_dirty JOIN m USING (pair, timeframe) GROUP BY pair, timeframe),
x AS (SELECT *, CASE WHEN max_null_ratio > 0.15 THEN 'Too many missing values' WHEN min_variance < 1e-6 THEN 'Low variance detected'
        WHEN {' + '.join(f'n_{n}' for n in ISSUE_SQL)} > 0 THEN 'Data consistency issues found' END AS error FROM w)
SELECT * REPLACE (round(max_null_ratio, 6) + 0.0 AS max_null_ratio, round(min_variance, 6) + 0.0 AS min_variance), error IS NULL AS valid FROM x""")
def _(spark, sf):
    return rounded(quality.quality_report(view(spark, sf, "bars_dirty"), VALUES, VALUES))


STEPS = "st AS (SELECT *, epoch_us(timestamp) / 1e6 - lag(epoch_us(timestamp) / 1e6) OVER ({by} ORDER BY timestamp) AS step FROM {t})"
PER_TIME = "u AS (SELECT pair, timeframe, timestamp, count(*) AS c FROM bars_dirty GROUP BY ALL)"
BACKWARD = f"""
a AS (SELECT *, lag(timestamp) OVER ({BY} ORDER BY ingest_seq) AS before FROM bars_dirty),
bw AS (SELECT pair, timeframe, count(*) FILTER (timestamp < before) AS n_backward FROM a GROUP BY pair, timeframe)"""


@register("monotonic", ["bars_dirty"], f"WITH {BACKWARD}\nSELECT *, n_backward = 0 AS valid FROM bw")
def _(spark, sf):
    return quality.monotonic_check(view(spark, sf, "bars_dirty"))


@register("monotonic_sparse", ["bars_dirty"], f"WITH {BACKWARD}\nSELECT *, n_backward = 0 AS valid FROM bw")
def _(spark, sf):
    # arrival numbers as a clock in microseconds would give them
    return quality.monotonic_check(view(spark, sf, "bars_dirty").withColumn("ingest_seq", F.col("ingest_seq") * 1000003))


@register("gaps", ["bars_hour"], f"""
WITH {STEPS.format(by=BY, t='bars_hour')}
SELECT {KEYED}, step / 60.0 AS gap_minutes FROM st WHERE step > 1.5 * 3600""")
def _(spark, sf):
    return quality.gaps(view(spark, sf, "bars_hour"))


@register("dup_ts", ["bars_dirty"], f"""
WITH {PER_TIME}
SELECT pair, timeframe, cast(sum(c) - count(*) AS BIGINT) AS n_duplicates, sum(c) = count(*) AS valid FROM u GROUP BY pair, timeframe""")
def _(spark, sf):
    return quality.duplicate_timestamps(view(spark, sf, "bars_dirty"))


@register("future_rows", ["bars_hour"], f"""
SELECT pair, timeframe, count(*) FILTER (timestamp > TIMESTAMP '{AS_OF}') AS n_future,
       count(*) FILTER (timestamp > TIMESTAMP '{AS_OF}') = 0 AS valid FROM bars_hour GROUP BY pair, timeframe""")
def _(spark, sf):
    return quality.future_rows(view(spark, sf, "bars_hour"), AS_OF)


@register("timestamp_report", ["bars_dirty"], f"""
WITH {BACKWARD}, {PER_TIME}, {STEPS.format(by=BY, t='u')},
w AS (SELECT pair, timeframe, count(*) FILTER (step > 5400) AS n_gaps, cast(sum(c) - count(*) AS BIGINT) AS n_duplicates,
        cast(coalesce(sum(c) FILTER (timestamp > TIMESTAMP '{AS_OF}'), 0) AS BIGINT) AS n_future FROM st GROUP BY pair, timeframe),
x AS (SELECT bw.*, n_gaps, n_duplicates, n_future,
        CASE WHEN n_backward > 0 THEN 'Timestamps are not monotonically increasing'
             WHEN n_duplicates > 0 THEN 'Found ' || n_duplicates || ' duplicate timestamps'
             WHEN n_future > 0 THEN 'Found ' || n_future || ' timestamps in the future' END AS failed
      FROM bw JOIN w USING (pair, timeframe))
SELECT * EXCLUDE (failed), failed IS NULL AS valid, coalesce(failed, 'Timestamp validation passed') AS message FROM x""")
def _(spark, sf):
    return quality.timestamp_report(view(spark, sf, "bars_dirty"), AS_OF)


@register("intervals", ["bars_day", "bars_dirty"], f"""
WITH {ONCE_SQL}, u AS (SELECT pair, timeframe, timestamp, 86400 AS tf FROM bars_day UNION ALL SELECT pair, '1w', timestamp, NULL FROM bars_day
           UNION ALL SELECT pair, timeframe, timestamp, 3600 FROM bars_once),
{STEPS.format(by=BY, t='u')},
c AS (SELECT pair, timeframe, count(*) FILTER (abs(step - tf) > tf / 100.0) AS n_invalid FROM st GROUP BY pair, timeframe)
SELECT *, timeframe <> '1w' AND n_invalid = 0 AS valid, CASE WHEN timeframe = '1w' THEN 'Invalid timeframe: 1w' ELSE '' END AS message FROM c""")
def _(spark, sf):
    days = view(spark, sf, "bars_day")
    weeks = days.withColumn("timeframe", F.lit("1w"))
    return quality.interval_check(rows.union_all(days, weeks, once(spark, sf)))


# ---- scaling, splits, sequences ---------------------------------------------------------------

SCALE = VALUES
SPREAD = "sp AS (SELECT pair, timeframe, " + ", ".join(
    f"median({c}) AS md_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in SCALE) + " FROM {t} GROUP BY pair, timeframe)"


def scaled_sql(c):
    return f"CASE WHEN hi_{c} = lo_{c} THEN 0.0 ELSE (coalesce({c}, md_{c}) - lo_{c}) / (hi_{c} - lo_{c}) END"


@register("minmax", ["bars_dirty"], f"""
WITH {SPREAD.format(t='bars_dirty')}
SELECT {KEYED}, ingest_seq, {', '.join(f'round({scaled_sql(c)}, 6) + 0.0 AS {c}' for c in SCALE)}
FROM bars_dirty JOIN sp USING (pair, timeframe)""")
def _(spark, sf):
    df = view(spark, sf, "bars_dirty").select(*KEYS, "timestamp", "ingest_seq", *SCALE)
    return rounded(ft.minmax_scale(df, SCALE))


@register("downcast", ["bars_day"], f"""
WITH k AS (SELECT *, row_number() OVER ({BY} ORDER BY timestamp) - 1 AS rn FROM bars_day)
SELECT {KEYED}, cast(rn AS INTEGER) AS rn, {', '.join(f'round(cast(cast({c} AS FLOAT) AS DOUBLE), 6) + 0.0 AS {c}' for c in VALUES)} FROM k""")
def _(spark, sf):
    df = downcast(number_rows(view(spark, sf, "bars_day")).select(*KEYS, "timestamp", "rn", *VALUES))
    return rounded(df.select(*KEYS, "timestamp", "rn", *[F.col(c).cast("double").alias(c) for c in VALUES]))


def split_sql(t):
    return f"""
pos AS (SELECT *, row_number() OVER ({BY} ORDER BY timestamp) - 1 AS rn, count(*) OVER ({BY}) AS n FROM {t}),
cutoff AS (SELECT *, cast(floor(n * cast(0.8 AS DOUBLE)) AS BIGINT) AS tr, cast(floor(n * cast(0.1 AS DOUBLE)) AS BIGINT) AS va FROM pos),
sp AS (SELECT *, CASE WHEN rn < tr THEN 'train' WHEN rn < tr + va THEN 'val' ELSE 'test' END AS split,
         CASE WHEN rn < tr THEN rn WHEN rn < tr + va THEN rn - tr ELSE rn - tr - va END AS split_pos FROM cutoff)"""


@register("split", ["bars_day"], f"WITH {split_sql('bars_day')}\nSELECT {BARS}, split, cast(split_pos AS BIGINT) AS split_pos FROM sp")
def _(spark, sf):
    return ft.split_80_10_10(view(spark, sf, "bars_day"))


def cell_order(columns=len(VALUES)):
    """A checksum of a sequence that tells every cell and its place: whole millionths times the place, added up."""
    cells = F.transform(F.flatten("sequence"), lambda x, i: F.round(x * 1000000, 0).cast("decimal(38,0)") * (i + 1))
    return F.aggregate(cells, F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)")).cast("string")


def order_sql(frame="f", columns=VALUES, at="rn"):
    """The same from rows numbered by `at`: a frame starts at its first number."""
    cells = [f"cast(round({c} * 1000000) AS HUGEINT)" for c in columns]
    own = " + ".join(f"{i + 1} * {c}" for i, c in enumerate(cells))
    every = " + ".join(cells)
    return (f"cast(sum({own}) OVER {frame} + {len(columns)} * (sum({at} * ({every})) OVER {frame} - min({at}) OVER {frame} * "
            f"sum({every}) OVER {frame}) AS VARCHAR)")


def shown(seqs, *keep):
    """A sequence as its length, its ends, a checksum over all cells in their order, and the target."""
    return seqs.select(*KEYS, *keep, "seq_no", F.size("sequence").cast("bigint").alias("n_rows"),
                       F.col("sequence")[0][3].alias("first_close"), F.element_at("sequence", -1)[3].alias("last_close"),
                       cell_order().alias("cells"), "target")


def seq_sql(t, length, by, ahead=0, at="split_pos", keep="split, ", where="true"):
    frame = f"ROWS BETWEEN {length + ahead} PRECEDING AND {1 + ahead} PRECEDING"
    return f"""
SELECT * FROM (
  SELECT pair, timeframe, {keep}cast({at} - {length + ahead} AS BIGINT) AS seq_no, count(*) OVER f AS n_rows,
         first_value(close) OVER f AS first_close, last_value(close) OVER f AS last_close,
         {order_sql()} AS cells, close AS target
  FROM {t} WHERE {where} WINDOW f AS (PARTITION BY pair, timeframe{by} ORDER BY timestamp {frame})) WHERE seq_no >= 0"""


@register("sequences_10", ["bars_hour"], f"WITH {split_sql('bars_hour')}" + seq_sql("sp", 10, ", split"))
def _(spark, sf):
    return shown(ft.sequences(view(spark, sf, "bars_hour"), 10), "split")


@register("sequences_50", ["bars_hour"], f"WITH {split_sql('bars_hour')}" + seq_sql("sp", 50, ", split"))
def _(spark, sf):
    return shown(ft.sequences(view(spark, sf, "bars_hour"), 50), "split")


# blocks of 64 sequences, each a view of the block's rows
@register("sequence_blocks_50", ["bars_hour"], f"WITH {split_sql('bars_hour')}" + seq_sql("sp", 50, ", split"))
def _(spark, sf):
    return shown(ft.unfold(ft.sequence_blocks(view(spark, sf, "bars_hour"), 50, size=64), 50), "split")


@register("datasets", ["bars_hour"], f"WITH {split_sql('bars_hour')}" + seq_sql(
    "sp", 50, ", split", where="least(tr, va, n - tr - va) > 50"))
def _(spark, sf):
    return shown(ft.sequences(view(spark, sf, "bars_hour"), 50, whole_sets=True), "split")


@register("split_summary", ["bars_day"], f"""WITH {split_sql('bars_day')}, sq AS ({seq_sql('sp', 50, ', split')})
SELECT split, count(*) AS n_sequences FROM sq GROUP BY split""")
def _(spark, sf):
    return ft.split_summary(ft.sequences(view(spark, sf, "bars_day"), 50))


ID_SQL = "ids AS (SELECT pair, cast(i - 1 AS INTEGER) AS pair_idx FROM (SELECT unnest({p}) AS pair, generate_subscripts({p}, 1) AS i))".format(
    p=str(HOUR_PAIRS))


@register("sequences_ext", ["bars_hour"], f"""
WITH {ID_SQL}, pos AS (SELECT b.*, pair_idx, cast(0 AS INTEGER) AS timeframe_idx, cast(1 AS DOUBLE) AS weight,
       row_number() OVER ({BY} ORDER BY timestamp) - 1 AS rn FROM bars_hour b JOIN ids USING (pair))
""" + seq_sql("pos", 50, "", 1, "rn", "pair_idx, timeframe_idx, weight, "))
def _(spark, sf):
    ids = ft.series_ids(spark, HOUR_PAIRS, ["1h", "4h", "1d"])
    return shown(ft.sequences_ext(view(spark, sf, "bars_hour"), *ids), "pair_idx", "timeframe_idx", "weight")


@register("split_80_20", ["bars_day"], f"""
WITH pos AS (SELECT *, row_number() OVER ({BY} ORDER BY timestamp) - 1 AS rn, count(*) OVER ({BY}) - 60 AS m FROM bars_day),
sp AS (SELECT *, cast(floor(m * cast(0.8 AS DOUBLE)) AS BIGINT) AS tr,
         CASE WHEN rn - 60 < floor(m * cast(0.8 AS DOUBLE)) THEN 'train' ELSE 'val' END AS split FROM pos)
""" + seq_sql("sp", 60, "", 0, "rn", "split, ", "tr >= 100 AND m - tr >= 100"))
def _(spark, sf):
    return shown(ft.training_pairs(view(spark, sf, "bars_day"), 60), "split")


@register("batches_32", ["bars_dirty"], f"""
WITH {ONCE_SQL}, pos AS (SELECT *, (row_number() OVER ({BY} ORDER BY timestamp) - 1) // 32 AS batch_no FROM bars_once)
SELECT pair, timeframe, batch_no, count(*) AS n_rows, round(sum(open + high + low + close + volume), 6) + 0.0 AS x_sum,
       arg_min(close, timestamp) AS first_y, arg_max(close, timestamp) AS last_y
FROM pos GROUP BY pair, timeframe, batch_no
HAVING count(*) = 32 AND count(open) = 32 AND count(high) = 32 AND count(low) = 32 AND count(close) = 32 AND count(volume) = 32""")
def _(spark, sf):
    out = ft.batches(once(spark, sf))
    x_sum = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, x: a + x)
    return out.select(*KEYS, "batch_no", F.size("x").cast("bigint").alias("n_rows"),
                      (F.round(x_sum, 6) + F.lit(0.0)).alias("x_sum"), F.col("y")[0].alias("first_y"),
                      F.element_at("y", -1).alias("last_y"))


def scaled_sequences(spark, sf):
    return ft.sequences(ft.minmax_scale(view(spark, sf, "bars_day").select(*KEYS, "timestamp", *SCALE), SCALE), 50)


SCALED_SQL = f"""
{SPREAD.format(t='bars_day').replace('sp AS', 'spread AS')},
scaled AS (SELECT {KEYED}, {', '.join(f'{scaled_sql(c)} AS {c}' for c in SCALE)} FROM bars_day JOIN spread USING (pair, timeframe)),
{split_sql('scaled')},
sq AS (SELECT *, cast(split_pos - 50 AS BIGINT) AS seq_no FROM (SELECT split, close AS target, list([{', '.join(VALUES)}]) OVER f AS sequence, split_pos FROM sp
       WINDOW f AS (PARTITION BY pair, timeframe, split ORDER BY timestamp ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)) WHERE split_pos >= 50)"""


# a share of the sequences is given a fault of each kind; the oracles count the same shares
FAULTY = {"short": ("train", 11), "nan": ("val", 7), "inf": ("test", 5), "out": ("train", 3)}


def faulty(seqs):
    """Sequences with planted faults: rows cut off, a missing target, an infinite target, a target out of range."""
    def hit(kind):
        split, every = FAULTY[kind]
        return (F.col("split") == split) & (F.col("seq_no") % every == 0)
    target = (F.when(hit("nan"), float("nan")).when(hit("inf"), float("inf")).when(hit("out"), F.lit(-7.0)).otherwise(F.col("target")))
    cut_off = F.when(hit("short"), F.slice("sequence", 1, 49)).otherwise(F.col("sequence"))
    return seqs.withColumn("target", target).withColumn("sequence", cut_off)


def hit_sql(kind):
    split, every = FAULTY[kind]
    return f"split = '{split}' AND seq_no % {every} = 0"


@register("training_checks", ["bars_day"], f"""WITH {SCALED_SQL},
y AS (SELECT split, count(*) AS n_samples, count(*) FILTER (abs(target) > 1) AS n_y_out, stddev_pop(target) AS std_y FROM sq GROUP BY split),
x AS (SELECT split, count(*) FILTER (abs(v) > 1) AS n_x_out, stddev_pop(v) AS std_x FROM (SELECT split, unnest(flatten(sequence)) AS v FROM sq) GROUP BY split),
z AS (SELECT split, n_samples, cast(0 AS BIGINT) AS n_nan, cast(0 AS BIGINT) AS n_inf, n_x_out, n_y_out, std_x, std_y,
  CASE WHEN n_x_out > 0 THEN 'Input features not properly normalized' WHEN n_y_out > 0 THEN 'Target values not properly normalized'
       WHEN n_samples < 1000 THEN 'Insufficient training samples' WHEN std_x < 1e-6 THEN 'Input features have near-zero variance'
       WHEN std_y < 1e-6 THEN 'Target values have near-zero variance' ELSE 'Training data validation passed' END AS message
  FROM x JOIN y USING (split))
SELECT * REPLACE (round(std_x, 6) + 0.0 AS std_x, round(std_y, 6) + 0.0 AS std_y), message = 'Training data validation passed' AS valid FROM z""")
def _(spark, sf):
    return rounded(ft.training_data_check(scaled_sequences(spark, sf)))


@register("training_checks_faulty", ["bars_day"], f"""WITH {SCALED_SQL},
f AS (SELECT split, seq_no, sequence, CASE WHEN {hit_sql('nan')} THEN 'nan' WHEN {hit_sql('inf')} THEN 'inf' WHEN {hit_sql('out')} THEN 'out' END AS fault,
        CASE WHEN {hit_sql('short')} THEN sequence[1:49] ELSE sequence END AS kept, target FROM sq),
x AS (SELECT split, round(stddev_pop(v), 6) + 0.0 AS std_x FROM (SELECT split, unnest(flatten(kept)) AS v FROM f) GROUP BY split),
c AS (SELECT split, count(*) AS n_samples, count(*) FILTER (fault = 'nan') AS n_nan, count(*) FILTER (fault = 'inf') AS n_inf,
        count(*) FILTER (fault IS NOT NULL) AS n_y_out FROM f GROUP BY split)
SELECT split, n_samples, n_nan, n_inf, n_y_out, std_x,
       CASE WHEN n_nan > 0 THEN 'Training data contains NaN values' WHEN n_inf > 0 THEN 'Training data contains infinite values'
            WHEN n_y_out > 0 THEN 'Target values not properly normalized' ELSE 'Training data validation passed' END AS message, false AS valid
FROM c JOIN x USING (split)""")
def _(spark, sf):
    # a NaN counts as larger than 1, as every number is smaller than NaN in Spark
    return rounded(ft.training_data_check(faulty(scaled_sequences(spark, sf))).drop("n_x_out", "std_y"))


def day_sequences(spark, sf):
    return faulty(ft.sequences(view(spark, sf, "bars_day"), 50))


@register("sequence_check", ["bars_day"], f"""WITH {split_sql('bars_day')}, sq AS ({seq_sql('sp', 50, ', split')}),
c AS (SELECT split, count(*) AS n_sequences, cast(min(CASE WHEN {hit_sql('short')} THEN 49 ELSE n_rows END) AS BIGINT) AS min_length,
        count(*) FILTER ({hit_sql('nan')}) AS n_nan, count(*) FILTER ({hit_sql('inf')}) AS n_inf FROM sq GROUP BY split)
SELECT *, CASE WHEN min_length < 50 THEN 'Sequence length too short' WHEN n_nan > 0 THEN 'Found NaN values in sequences or targets'
            WHEN n_inf > 0 THEN 'Found infinite values in sequences or targets' ELSE 'Sequence validation passed' END AS message,
       min_length >= 50 AND n_nan = 0 AND n_inf = 0 AS valid FROM c""")
def _(spark, sf):
    return ft.sequence_check(day_sequences(spark, sf))


@register("dims_check", ["bars_day"], f"""WITH {split_sql('bars_day')}, sq AS ({seq_sql('sp', 50, ', split')}),
c AS (SELECT split, count(*) AS n_sequences, count(*) FILTER ({hit_sql('short')}) AS n_misfit FROM sq GROUP BY split)
SELECT *, n_misfit = 0 AS valid FROM c""")
def _(spark, sf):
    return ft.dims_check(day_sequences(spark, sf), 50, 5)


@register("dataset_check", ["bars_day"], f"""WITH {split_sql('bars_day')}, sq AS ({seq_sql('sp', 50, ', split')}),
c AS (SELECT split, count(*) AS n_sequences, count(*) FILTER ({hit_sql('nan')}) AS n_missing FROM sq GROUP BY split)
SELECT *, n_missing = 0 AS valid FROM c""")
def _(spark, sf):
    return ft.dataset_check(day_sequences(spark, sf).withColumn("target", F.nullif("target", F.lit(float("nan")))))


# ---- pipelines --------------------------------------------------------------------------------

FEATURES_SQL = f"{rsi_sql('bars_day')}, {ema_sql('bars_day')},\nfeat AS (SELECT {BARS}, RSI_14, MACD_12_26_9, MACD_Signal_12_26_9 FROM rsi JOIN macd USING ({KEYED}))"


@register("training_set", ["bars_day"], f"""WITH {FEATURES_SQL}, {split_sql('feat')}
SELECT * FROM (
  SELECT pair, timeframe, split, cast(split_pos - 50 AS BIGINT) AS seq_no, count(*) OVER f AS n_rows, close AS target,
         first_value(close) OVER f AS first_close, last_value(volume) OVER f AS last_volume,
         round(sum(open + high + low + close + volume) OVER f, 3) + 0.0 AS price_sum,
         round(last_value(RSI_14) OVER f, 6) + 0.0 AS last_rsi, round(first_value(MACD_12_26_9) OVER f, 6) + 0.0 AS first_macd,
         round(last_value(MACD_Signal_12_26_9) OVER f, 6) + 0.0 AS last_signal
  FROM sp WHERE least(tr, va, n - tr - va) > 50
  WINDOW f AS (PARTITION BY pair, timeframe, split ORDER BY timestamp ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)) WHERE seq_no >= 0""")
def _(spark, sf):
    out = training.training_set(view(spark, sf, "bars_day"))
    prices = F.aggregate("sequence", F.lit(0.0), lambda a, r: a + r[0] + r[1] + r[2] + r[3] + r[4])
    first, last = F.col("sequence")[0], F.element_at("sequence", -1)
    return out.select(*KEYS, "split", "seq_no", F.size("sequence").cast("bigint").alias("n_rows"), "target",
                      first[3].alias("first_close"), last[4].alias("last_volume"),
                      (F.round(prices, 3) + F.lit(0.0)).alias("price_sum"),
                      (F.round(last[5], 6) + F.lit(0.0)).alias("last_rsi"),
                      (F.round(first[6], 6) + F.lit(0.0)).alias("first_macd"),
                      (F.round(last[7], 6) + F.lit(0.0)).alias("last_signal"))


FEATURE_COLUMNS = (*VALUES, "RSI_14", *MACD)


@register("process_series", ["bars_day"], f"""WITH {FEATURES_SQL},
ok AS (SELECT pair, timeframe FROM feat GROUP BY pair, timeframe
       HAVING least({', '.join(f'var_samp({c})' for c in FEATURE_COLUMNS)}) >= 1e-6
          AND count(*) FILTER ({' OR '.join(ISSUE_SQL.values())}) = 0)
SELECT {KEYED}, {r6(*FEATURE_COLUMNS)} FROM feat SEMI JOIN ok USING (pair, timeframe)""")
def _(spark, sf):
    return rounded(training.process_series(view(spark, sf, "bars_day")))


GAP_FEATURES_SQL = f"""{ONCE_SQL}, {near_sql(t='bars_once').replace(' AS n ', ' AS n_all ')},
x AS (SELECT pair, timeframe, timestamp, {X_SQL} AS x FROM q), {rsi_sql('x', 'x')},
line AS (SELECT {KEYED}, {', '.join(f'{line_sql(c)} AS {c}' for c in VALUES)} FROM q),
gfeat AS (SELECT {BARS}, RSI_14 FROM line JOIN rsi USING ({KEYED}) WHERE {' AND '.join(f'{c} IS NOT NULL' for c in VALUES)})"""


# every series of bars_once starts without a close, so it has no MACD; the RSI is there from the first bar on
@register("training_set_gaps", ["bars_dirty"], f"""WITH {GAP_FEATURES_SQL}, {split_sql('gfeat')}
SELECT * FROM (
  SELECT pair, timeframe, split, cast(split_pos - 50 AS BIGINT) AS seq_no, count(*) OVER f AS n_rows, round(close, 6) + 0.0 AS target,
         round(sum(open + high + low + close + volume) OVER f, 6) + 0.0 AS price_sum, round(first_value(close) OVER f, 6) + 0.0 AS first_close,
         round(sum(RSI_14) OVER f, 6) + 0.0 AS rsi_sum, round(last_value(RSI_14) OVER f, 6) + 0.0 AS last_rsi, cast(50 AS BIGINT) AS n_no_macd
  FROM sp WHERE least(tr, va, n - tr - va) > 50
  WINDOW f AS (PARTITION BY pair, timeframe, split ORDER BY timestamp ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)) WHERE seq_no >= 0""")
def _(spark, sf):
    out = training.training_set(once(spark, sf), gate=False)
    prices = F.aggregate("sequence", F.lit(0.0), lambda a, r: a + r[0] + r[1] + r[2] + r[3] + r[4])
    rsi = F.aggregate("sequence", F.lit(0.0), lambda a, r: a + r[5])
    return rounded(out.select(
        *KEYS, "split", "seq_no", F.size("sequence").cast("bigint").alias("n_rows"), "target", prices.alias("price_sum"),
        F.col("sequence")[0][3].alias("first_close"), rsi.alias("rsi_sum"), F.element_at("sequence", -1)[5].alias("last_rsi"),
        F.size(F.filter("sequence", lambda r: r[6].isNull() & r[7].isNull())).cast("bigint").alias("n_no_macd")))


PASSING = f"""HAVING least({', '.join(f'var_samp({c})' for c in FEATURE_COLUMNS)}) >= 1e-6
          AND count(*) FILTER ({' OR '.join(ISSUE_SQL.values())}) = 0"""


# interpolated closes leave the range of their bars, so the quality report refuses the series with gaps and keeps the others
@register("process_series_gaps", ["bars_day", "bars_dirty"], f"""WITH {FEATURES_SQL}, {GAP_FEATURES_SQL.replace(rsi_sql('x', 'x'), rsi_sql('x', 'x').replace('d AS', 'd2 AS').replace('FROM d W', 'FROM d2 W').replace('gl AS', 'gl2 AS').replace('FROM gl)', 'FROM gl2)').replace('rsi AS', 'rsi2 AS')).replace('JOIN rsi USING', 'JOIN rsi2 USING')},
u AS (SELECT {BARS}, RSI_14, MACD_12_26_9, MACD_Signal_12_26_9 FROM feat
      UNION ALL SELECT {BARS}, RSI_14, NULL, NULL FROM gfeat),
ok AS (SELECT pair, timeframe FROM u GROUP BY pair, timeframe {PASSING})
SELECT {KEYED}, {r6(*FEATURE_COLUMNS)} FROM u SEMI JOIN ok USING (pair, timeframe)""")
def _(spark, sf):
    bars = rows.union_all(view(spark, sf, "bars_day"), once(spark, sf))
    return rounded(training.process_series(bars, gate=False))


@register("process_series_short", ["bars_day"], f"""
WITH k AS (SELECT *, row_number() OVER ({BY} ORDER BY timestamp DESC) AS back FROM bars_day),
both_ends AS (SELECT {BARS} FROM k UNION ALL SELECT * REPLACE ('short/' || pair AS pair) FROM (SELECT {BARS} FROM k WHERE back <= 14)),
{rsi_sql('both_ends')}, {ema_sql('both_ends')},
feat AS (SELECT {BARS}, RSI_14, MACD_12_26_9, MACD_Signal_12_26_9 FROM rsi JOIN macd USING ({KEYED})),
ok AS (SELECT pair, timeframe FROM feat GROUP BY pair, timeframe {PASSING})
SELECT {KEYED}, {r6(*FEATURE_COLUMNS)} FROM feat SEMI JOIN ok USING (pair, timeframe)""")
def _(spark, sf):
    # 14 bars are too few for an RSI: the series has none and is judged by the rest
    bars = view(spark, sf, "bars_day")
    long = bars.select(*KEYS, "timestamp", *VALUES)
    short = number_rows(bars).where("n - rn <= 14").select(*KEYS, "timestamp", *VALUES).withColumn("pair", F.concat(F.lit("short/"), "pair"))
    return rounded(training.process_series(rows.union_all(long, short)))


# ---- ingest and store -------------------------------------------------------------------------


def candle_pages(spark, sf):
    """Hourly bars packed as JSON pages of 100, newest page first; every third page runs backwards."""
    bars = number_rows(view(spark, sf, "bars_hour")).withColumn("page", F.floor(F.col("rn") / F.lit(100)))
    ms = F.unix_millis("timestamp").cast("double")
    packed = bars.groupBy(*KEYS, "page", F.floor((F.col("n") - 1) / F.lit(100)).alias("last")).agg(
        F.sort_array(F.collect_list(F.array(ms, *[F.col(c) for c in VALUES]))).alias("rows"))
    rows_ = F.when(F.col("page") % 3 == 1, F.reverse("rows")).otherwise(F.col("rows"))
    return packed.select(*KEYS, (F.col("last") - F.col("page")).alias("page_no"), "page", F.to_json(rows_).alias("candles"))


PAGE_SQL = f"pos AS (SELECT *, row_number() OVER ({BY} ORDER BY timestamp) - 1 AS rn, count(*) OVER ({BY}) AS n FROM bars_hour)"


@register("read_candles", ["bars_hour"], f"SELECT {BARS} FROM bars_hour")
def _(spark, sf):
    return candles.read_candles(candle_pages(spark, sf)).select(*KEYS, "timestamp", *VALUES)


@register("page_order", ["bars_hour"], f"""WITH {PAGE_SQL}
SELECT pair, timeframe, (n - 1) // 100 - rn // 100 AS page_no, count(*) AS n_candles FROM pos
GROUP BY pair, timeframe, n, rn // 100 HAVING (rn // 100) % 3 <> 1 OR count(*) = 1""")
def _(spark, sf):
    good = candles.ordered_pages(candle_pages(spark, sf))
    return good.select(*KEYS, "page_no", F.size(F.from_json("candles", candles.CANDLES)).cast("bigint").alias("n_candles"))


def damaged_pages(spark, sf):
    """Pages of which every fifth is cut off and every seventh is missing."""
    candle = (F.when(F.col("page") % 7 == 6, F.lit(None)).when(F.col("page") % 5 == 4, F.left("candles", F.length("candles") - 3))
              .otherwise(F.col("candles")))
    return candle_pages(spark, sf).withColumn("candles", candle)


@register("refused_pages", ["bars_hour"], f"""WITH {PAGE_SQL}, g AS (
SELECT pair, timeframe, (n - 1) // 100 - rn // 100 AS page_no, rn // 100 AS page, count(*) AS m FROM pos GROUP BY pair, timeframe, n, rn // 100),
w AS (SELECT *, CASE WHEN page % 7 = 6 THEN 'missing' WHEN page % 5 = 4 THEN 'not readable' WHEN page % 3 = 1 AND m > 1 THEN 'out of order' END AS reason FROM g)
SELECT pair, timeframe, page_no, page, reason FROM w WHERE reason IS NOT NULL""")
def _(spark, sf):
    return candles.refused_pages(damaged_pages(spark, sf)).drop("last")


COMBINED_SQL = f"""WITH {PAGE_SQL},
g AS (SELECT *, count(*) OVER (PARTITION BY pair, timeframe, rn // 100) AS m FROM pos)
SELECT {BARS} FROM g WHERE (rn // 100) % 3 <> 1 OR m = 1"""


@register("combine_pages", ["bars_hour"], COMBINED_SQL)
def _(spark, sf):
    return candles.combine_pages(candle_pages(spark, sf)).select(*KEYS, "timestamp", *VALUES)


@register("reject_series", ["bars_hour", "bars_day", "bars_dirty"], f"""
WITH u AS (SELECT {BARS} FROM bars_hour UNION ALL SELECT {BARS} FROM bars_day
           UNION ALL SELECT * REPLACE ('dirty/' || pair AS pair) FROM (SELECT {BARS} FROM bars_dirty))
SELECT * FROM u SEMI JOIN (SELECT pair, timeframe FROM u GROUP BY pair, timeframe
  HAVING bool_and(open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL
                  AND coalesce(high >= low, false))) g USING (pair, timeframe)""")
def _(spark, sf):
    dirty = view(spark, sf, "bars_dirty").drop("ingest_seq").withColumn("pair", F.concat(F.lit("dirty/"), "pair"))
    return candles.reject_series(rows.union_all(view(spark, sf, "bars_hour"), view(spark, sf, "bars_day"), dirty))


@register("refused_series", ["bars_hour", "bars_dirty"], f"""
WITH u AS (SELECT {BARS} FROM bars_hour UNION ALL SELECT * REPLACE ('dirty/' || pair AS pair) FROM (SELECT {BARS} FROM bars_dirty)),
c AS (SELECT pair, timeframe, count(*) AS n_rows, count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in VALUES)}) AS n_incomplete,
        count(*) FILTER (high < low) AS n_crossed FROM u GROUP BY pair, timeframe)
SELECT * FROM c WHERE n_incomplete > 0 OR n_crossed > 0""")
def _(spark, sf):
    dirty = view(spark, sf, "bars_dirty").drop("ingest_seq").withColumn("pair", F.concat(F.lit("dirty/"), "pair"))
    return candles.refused_series(rows.union_all(view(spark, sf, "bars_hour"), dirty))


@register("pick_source", ["bars_hour"], f"""
WITH c AS (SELECT 'okx' AS exchange, {BARS} FROM bars_hour
  UNION ALL SELECT 'binance', pair, timeframe, timestamp, open, high * 2, low, close, volume FROM bars_hour WHERE pair IN ('click', 'view')
  UNION ALL SELECT 'binanceus', pair, timeframe, timestamp, open, high * 3, low, close, volume FROM bars_hour),
x(exchange, priority, enabled) AS (VALUES ('binance', 1, true), ('binanceus', 2, false), ('bybit', 3, true), ('okx', 4, true))
SELECT c.exchange, {BARS} FROM c JOIN (SELECT pair, timeframe, arg_min(exchange, priority) AS exchange FROM c JOIN x USING (exchange)
  WHERE enabled GROUP BY pair, timeframe) USING (pair, timeframe, exchange)""")
def _(spark, sf):
    bars = view(spark, sf, "bars_hour")
    some = bars.where(F.col("pair").isin("click", "view")).withColumn("high", F.col("high") * 2)
    offers = rows.union_all(bars.withColumn("exchange", F.lit("okx")), some.withColumn("exchange", F.lit("binance")),
                            bars.withColumn("high", F.col("high") * 3).withColumn("exchange", F.lit("binanceus")))
    exchanges = spark.createDataFrame([(e, p, e != "binanceus") for e, p in candles.EXCHANGE_PRIORITY.items()],
                                      "exchange string, priority int, enabled boolean")
    return candles.pick_source(offers, exchanges).select("exchange", *KEYS, "timestamp", *VALUES)


@register("plan_chunks", ["bars_hour", "bars_day"], """
WITH q AS (SELECT pair, timeframe, min(timestamp) AS s, max(timestamp) AS e, CASE timeframe WHEN '1h' THEN 3600 ELSE 86400 END AS w
           FROM (FROM bars_hour UNION ALL FROM bars_day) GROUP BY pair, timeframe),
c AS (SELECT *, unnest(range(cast(ceil((epoch(e) - epoch(s)) / (1000 * w)) AS BIGINT))) AS chunk_no FROM q),
d AS (SELECT *, e - to_seconds(chunk_no * 1000 * w) AS stop, greatest(s, e - to_seconds((chunk_no + 1) * 1000 * w)) AS begin FROM c)
SELECT pair, timeframe, chunk_no, begin AS chunk_start, stop AS chunk_end,
       cast(least(1000, floor((epoch(stop) - epoch(begin)) / w)) AS BIGINT) AS "limit" FROM d""")
def _(spark, sf):
    bars = rows.union_all(view(spark, sf, "bars_hour"), view(spark, sf, "bars_day"))
    return candles.plan_chunks(bars.groupBy(*KEYS).agg(F.min("timestamp").alias("start"), F.max("timestamp").alias("end")))


@register("expected_candles", ["bars_hour", "bars_day"], """
WITH q AS (SELECT DISTINCT pair, timeframe, CASE timeframe WHEN '1h' THEN 26280 ELSE 1095 END AS total FROM (FROM bars_hour UNION ALL FROM bars_day))
SELECT pair, timeframe, exchange, cast(total AS BIGINT) AS expected, cast(ceil(total / lim) AS BIGINT) AS chunks
FROM q, (VALUES ('okx', 100), ('binance', 1000)) AS x(exchange, lim)""")
def _(spark, sf):
    series = rows.union_all(view(spark, sf, "bars_hour"), view(spark, sf, "bars_day")).select(*KEYS).distinct()
    return candles.expected_candles(series.withColumn("exchange", F.explode(F.array(F.lit("okx"), F.lit("binance")))))


@register("coverage", ["bars_hour", "bars_day"], """
WITH q AS (SELECT pair, timeframe, count(*) AS actual, cast(CASE timeframe WHEN '1h' THEN 26280 ELSE 1095 END AS BIGINT) AS expected
           FROM (FROM bars_hour UNION ALL FROM bars_day) GROUP BY pair, timeframe)
SELECT *, round(actual / expected, 6) + 0.0 AS coverage FROM q""")
def _(spark, sf):
    return rounded(candles.coverage(rows.union_all(view(spark, sf, "bars_hour"), view(spark, sf, "bars_day"))))


GRID_SQL = "grid AS (SELECT DISTINCT pair, tf AS timeframe FROM bars_hour, (VALUES ('1h'), ('4h'), ('1d')) AS t(tf))"


def grid(spark, sf):
    return candles.series_grid(view(spark, sf, "bars_hour").select("pair").distinct())


@register("series_grid", ["bars_hour"], f"WITH {GRID_SQL}\nSELECT * FROM grid")
def _(spark, sf):
    return grid(spark, sf)


@register("missing_series", ["bars_hour"], f"WITH {GRID_SQL}\nSELECT * FROM grid ANTI JOIN bars_hour USING (pair, timeframe)")
def _(spark, sf):
    return store.missing_series(grid(spark, sf), view(spark, sf, "bars_hour"))


@register("read_through", ["bars_hour"], f"""
SELECT pair, timeframe, timestamp, open, high, low, CASE WHEN pair < 'm' THEN close ELSE close + 1 END AS close, volume
FROM bars_hour WHERE pair <> 'view'""")
def _(spark, sf):
    bars = view(spark, sf, "bars_hour")
    return store.read_through(bars.where("pair <> 'view'").select(*KEYS).distinct(), bars.where("pair < 'm'"),
                              bars.withColumn("close", F.col("close") + 1)).select(*KEYS, "timestamp", *VALUES)


@register("series_key", ["bars_day"], """
SELECT DISTINCT pair, timeframe, replace(pair, '/', '_') || '_' || timeframe AS series_key, cast(86400 AS BIGINT) AS seconds FROM bars_day""")
def _(spark, sf):
    series = view(spark, sf, "bars_day").select(*KEYS).distinct()
    return series.select(*KEYS, series_file_key().alias("series_key"), timeframe_seconds().alias("seconds"))


@register("id_lookup", ["bars_hour"], f"""
WITH {ID_SQL} SELECT DISTINCT pair, timeframe, pair_idx, cast(0 AS INTEGER) AS timeframe_idx FROM bars_hour JOIN ids USING (pair)""")
def _(spark, sf):
    return ft.with_ids(view(spark, sf, "bars_hour"), *ft.series_ids(spark, HOUR_PAIRS, ["1h", "4h", "1d"])).select(
        *KEYS, "pair_idx", "timeframe_idx").distinct()


def halves(spark, sf):
    numbered = number_rows(view(spark, sf, "bars_hour"))
    stored = numbered.where("rn % 2 = 0 or rn % 10 = 1")
    new = numbered.where("rn % 2 = 1").withColumn("close", F.col("close") + 1)
    return stored.select(*KEYS, "timestamp", *VALUES), new.select(*KEYS, "timestamp", *VALUES)


# a window of three days around each series, and one of a series that is not stored
@register("missing_ranges", ["bars_hour"], """
WITH w AS (SELECT pair, timeframe, date_trunc('day', min(timestamp)) - INTERVAL 3 DAY AS s, date_trunc('day', max(timestamp)) + INTERVAL 3 DAY AS e
           FROM bars_hour GROUP BY pair, timeframe UNION ALL SELECT 'none', '1h', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-03'),
g AS (SELECT pair, timeframe, unnest(generate_series(s, e - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS timestamp FROM w),
m AS (SELECT *, row_number() OVER (PARTITION BY pair, timeframe ORDER BY timestamp) AS k FROM g ANTI JOIN bars_hour USING (pair, timeframe, timestamp)),
i AS (SELECT *, timestamp - k * INTERVAL 1 HOUR AS island FROM m)
SELECT pair, timeframe, min(timestamp) AS start, max(timestamp) + INTERVAL 1 HOUR AS "end", count(*) AS n_bars FROM i GROUP BY pair, timeframe, island""")
def _(spark, sf):
    bars, days = view(spark, sf, "bars_hour"), F.expr("interval 3 days")
    windows = bars.groupBy(*KEYS).agg((F.date_trunc("day", F.min("timestamp")) - days).alias("start"), (F.date_trunc("day", F.max("timestamp")) + days).alias("end"))
    other = spark.sql("SELECT 'none' AS pair, '1h' AS timeframe, TIMESTAMP '2024-01-01' AS start, TIMESTAMP '2024-01-03' AS end")
    return store.missing_ranges(rows.union_all(windows, other), bars)


@register("merge_bars", ["bars_hour"], f"""WITH {PAGE_SQL}
SELECT pair, timeframe, timestamp, open, high, low, CASE WHEN rn % 2 = 0 OR rn % 10 = 1 THEN close ELSE close + 1 END AS close, volume FROM pos""")
def _(spark, sf):
    return store.merge_bars(*halves(spark, sf))


@register("write_read_bars", ["bars_hour"], f"""WITH {PAGE_SQL}
SELECT pair, timeframe, timestamp, open, high, low, CASE WHEN rn % 2 = 0 OR rn % 10 = 1 THEN close ELSE close + 1 END AS close, volume
FROM pos WHERE pair <> 'view'""")
def _(spark, sf):
    root = shared_folder(spark)
    for part in halves(spark, sf):
        store.write_bars(part, root)
    return store.read_bars(spark, root).where("pair <> 'view'")


@register("union_all", ["bars_hour"], f"""WITH {PAGE_SQL}
SELECT {BARS} FROM pos WHERE rn % 2 = 0 OR rn % 10 = 1
UNION ALL SELECT pair, timeframe, timestamp, open, high, low, close + 1, volume FROM pos WHERE rn % 2 = 1""")
def _(spark, sf):
    return rows.union_all(*halves(spark, sf))


def yearly_store(spark, sf, root):
    """Five writes of all daily bars: up to 1995, three years, from 1999 on."""
    year = F.least(F.greatest(F.year("timestamp"), F.lit(1995)), F.lit(1999))
    for part in range(1995, 2000):
        store.write_bars(view(spark, sf, "bars_day").where(year == part), root)
    return root


YEARS_SQL = "y AS (SELECT *, least(greatest(year(timestamp), 1995), 1999) AS part FROM bars_day), v AS (SELECT unnest([2, 3, 4, 5])::BIGINT AS version)"


@register("snapshots", ["bars_day"], f"""WITH {YEARS_SQL}
SELECT version, count(*) AS n_rows, count(DISTINCT (pair, timeframe)) AS n_series FROM v JOIN y ON part <= 1994 + version GROUP BY version""")
def _(spark, sf):
    root = yearly_store(spark, sf, shared_folder(spark))
    held = [store.read_bars(spark, root, version=n).withColumn("version", F.lit(n).cast("bigint")) for n in store.versions(spark, root)]
    return rows.union_all(*held).groupBy("version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(*KEYS).alias("n_series"))


# what the manifests say of each version, after a write that brings nothing new and a merge of everything
@register("storage_stats", ["bars_day"], f"""WITH {YEARS_SQL.replace('[2, 3, 4, 5]', '[5]')},
p AS (SELECT DISTINCT pair, timeframe, part FROM y),
s AS (SELECT version, count(*) AS n_layers, (SELECT count(*) FROM y WHERE part <= 1994 + version) AS n_rows,
             (SELECT min(timestamp) FROM y) AS first, (SELECT max(timestamp) FROM y WHERE part <= 1994 + version) AS last
      FROM v JOIN p ON part <= 1994 + version GROUP BY version)
SELECT version, n_layers, n_rows, first, last, 0::BIGINT AS n_gone, true AS has_bytes FROM s UNION ALL
SELECT 6, n.n_layers, s.n_rows, s.first, s.last, s.n_layers, true FROM s, (SELECT count(DISTINCT (pair, timeframe)) AS n_layers FROM y) n""")
def _(spark, sf):
    root = yearly_store(spark, sf, shared_folder(spark))
    out = [stored_figures(spark, root, 5)]
    store.merge_layers(spark, root, most=0, share=0, least_rows=0)
    out.append(stored_figures(spark, root, 6))
    return rows.union_all(*out)


def stored_figures(spark, root, version):
    files = store.manifest(spark, root, version)
    stats = store.storage_stats(spark, root).first()
    return files.agg(
        F.lit(version).cast("bigint").alias("version"), F.countDistinct(*KEYS, "write").alias("n_layers"), F.sum("rows").alias("n_rows"),
        F.min("first").alias("first"), F.max("last").alias("last"), F.lit(stats.backup_count).cast("bigint").alias("n_gone"),
        ((F.sum("bytes") == stats.total_bytes) & (F.count("*") == stats.file_count)).alias("has_bytes"))


@register("read_range", ["bars_day"], f"SELECT {BARS} FROM bars_day WHERE timestamp >= '1996-06-01' AND timestamp < '1998-02-01'")
def _(spark, sf):
    root = yearly_store(spark, sf, shared_folder(spark))
    return store.read_bars(spark, root, start="1996-06-01", end="1998-02-01").select(*KEYS, "timestamp", *VALUES)


# the last three days of every series come one by one; then all layers but the first become one
@register("append_days", ["bars_day"], f"SELECT {BARS} FROM bars_day")
def _(spark, sf):
    root, bars = shared_folder(spark), view(spark, sf, "bars_day")
    age = F.datediff(F.lit(bars.agg(F.max("timestamp")).first()[0]), "timestamp")
    for days in (age > 2, age == 2, age == 1, age < 1):
        store.write_bars(bars.where(days), root)
    store.merge_layers(spark, root, most=2)
    return store.read_bars(spark, root).select(*KEYS, "timestamp", *VALUES)


HOLED_SQL = """h AS (SELECT * REPLACE (CASE WHEN day(timestamp) % 9 = 0 OR (pair LIKE 'N/%' AND day(timestamp) % 3 = 0) THEN NULL ELSE volume END AS volume,
  CASE WHEN pair LIKE 'R/%' AND day(timestamp) = 13 THEN low - 1 ELSE high END AS high) FROM bars_day)"""


# holed bars in four layers; bars of pairs that begin with A come again with other prices, which changes nothing
@register("stored_quality", ["bars_day"], f"""
WITH {HOLED_SQL},
w AS (SELECT pair, timeframe, {WORST} AS max_null_ratio, least({', '.join(f'var_samp({c})' for c in VALUES)}) AS min_variance,
        {', '.join(f'count(*) FILTER ({c}) AS n_{n}' for n, c in ISSUE_SQL.items())} FROM h GROUP BY pair, timeframe),
x AS (SELECT *, CASE WHEN max_null_ratio > 0.15 THEN 'Too many missing values' WHEN min_variance < 1e-6 THEN 'Low variance detected'
        WHEN {' + '.join(f'n_{n}' for n in ISSUE_SQL)} > 0 THEN 'Data consistency issues found' END AS error FROM w)
SELECT * REPLACE (round(max_null_ratio, 6) + 0.0 AS max_null_ratio, round(ln(min_variance), 6) + 0.0 AS min_variance), error IS NULL AS valid FROM x""")
def _(spark, sf):
    root, day = shared_folder(spark), F.dayofmonth("timestamp")
    bars = view(spark, sf, "bars_day").withColumns({
        "volume": F.when(~((day % 9 == 0) | (F.col("pair").like("N/%") & (day % 3 == 0))), F.col("volume")),
        "high": F.when(F.col("pair").like("R/%") & (day == 13), F.col("low") - 1).otherwise(F.col("high"))})
    year = F.year("timestamp")
    for part in (year < 1995, (year >= 1995) & (year < 1998), year >= 1998):
        store.write_bars(bars.where(part), root)
    store.write_bars(bars.where(F.col("pair").like("A/%")).withColumn("close", F.col("close") + 5), root)
    return rounded(store.stored_quality(spark, root, VALUES).withColumn("min_variance", F.log("min_variance")))


# pages of even numbers land first, then all others; the second run starts where the first ended
@register("stream_pages", ["bars_hour"], COMBINED_SQL)
def _(spark, sf):
    folder, root = shared_folder(spark), shared_folder(spark)
    for drop in (0, 1):
        pages = candle_pages(spark, sf).where(F.col("page_no") % 2 == drop).select("pair", "timeframe", "page_no", "candles")
        pages.write.mode("append").parquet(f"{folder}/landing")
        pages_to_store(spark, f"{folder}/landing", root, f"{folder}/progress").awaitTermination()
    return store.read_bars(spark, root).select(*KEYS, "timestamp", *VALUES)


# many series, then one more bar for one of them with another set of columns, then one that is stored already
@register("store_columns", ["bars_day"], f"""
WITH m AS (SELECT pair, timeframe, max(timestamp) AS last FROM bars_day WHERE pair = 'A/F' GROUP BY pair, timeframe)
SELECT {BARS}, cast(NULL AS DOUBLE) AS RSI_14 FROM bars_day
UNION ALL SELECT pair, timeframe, last + INTERVAL 1 DAY, NULL, NULL, NULL, 5.0, NULL, 50.0 FROM m""")
def _(spark, sf):
    root, bars = shared_folder(spark), view(spark, sf, "bars_day")
    store.write_bars(bars, root)
    last = bars.where("pair = 'A/F'").groupBy(*KEYS).agg(F.max("timestamp").alias("timestamp"))
    later = last.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 day"))
    store.write_bars(rows.union_all(last, later).select("*", F.lit(5.0).alias("close"), F.lit(50.0).alias("RSI_14")), root)
    return store.read_bars(spark, root).select(*KEYS, "timestamp", *VALUES, "RSI_14")


@register("legacy_files", ["bars_hour"], f"SELECT {BARS} FROM bars_hour")
def _(spark, sf):
    root, bars = shared_folder(spark), view(spark, sf, "bars_hour")
    fs, _, path = store._fs(spark, root)
    bars.withColumn("name", F.col("pair")).drop(*KEYS).write.partitionBy("name").parquet(f"{root}/written")
    for folder in (s.getPath() for s in fs.listStatus(path(f"{root}/written")) if s.isDirectory()):
        pair = unquote(folder.getName().removeprefix("name="))
        # files of a pair have the same name, so each has a folder of its own
        for i, part in enumerate(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".parquet")):
            fs.mkdirs(path(f"{root}/files/{i}"))
            fs.rename(part, path(f"{root}/files/{i}/{pair}_USDT_1h.parquet"))
    found = store.read_legacy_files(spark, f"{root}/files/*")
    return found.withColumn("pair", F.replace("pair", F.lit("/USDT"), F.lit(""))).select(*KEYS, "timestamp", *VALUES)


@register("structure_check", ["bars_hour"], """
SELECT * FROM (VALUES ('as read', true, 'Data structure validation passed'), ('no volume', false, 'Missing required columns: [''volume'']'),
  ('text close', false, 'Invalid data type for close: string'), ('no rows', false, 'DataFrame is None or empty')) AS t(frame, valid, message)""")
def _(spark, sf):
    bars = view(spark, sf, "bars_hour")
    frames = {"as read": bars, "no volume": bars.drop("volume"), "text close": bars.withColumn("close", F.col("close").cast("string")),
              "no rows": bars.where("pair = 'none'")}
    return spark.createDataFrame([(name, *quality.structure_check(df)) for name, df in frames.items()],
                                 "frame string, valid boolean, message string")


# ---- texts, sentiment, cache ------------------------------------------------------------------


TITLE = "CASE WHEN doc_id % 3 = 0 THEN md5(text) ELSE concat(md5(text), md5(source)) END"


def search_results(spark, sf):
    """Documents packed as search payloads, one per language and 400 documents; titles of 32 or 64 characters."""
    docs = table(spark, sf, "documents")
    post = F.struct(F.struct(F.expr(TITLE).alias("title"), F.col("text").alias("selftext")).alias("data"))
    packed = docs.groupBy("lang", F.floor(F.col("doc_id") / F.lit(400)).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", post.alias("post")))).alias("p"))
    children = F.transform("p", lambda x: x["post"])
    return packed.select("lang", "page", F.to_json(F.struct(F.struct(children.alias("children")).alias("data"))).alias("payload"))


@register("reddit_texts", [], f"""
d AS (SELECT lang, doc_id // 400 AS page, doc_id, unnest([1, 2]) AS part, unnest([{TITLE}, text]) AS text FROM documents)
SELECT lang, page, cast(row_number() OVER (PARTITION BY lang, page ORDER BY doc_id, part) - 1 AS BIGINT) AS text_no, text FROM d WHERE length(text) > 50""")
def _(spark, sf):
    out = texts.reddit_texts(search_results(spark, sf))
    return out.withColumn("text_no", F.col("text_no").cast("bigint"))


@register("refused_payloads", [], """
p AS (SELECT DISTINCT lang, doc_id // 400 AS page FROM documents),
w AS (SELECT lang, page, CASE WHEN lang = 'fr' THEN 'missing' WHEN lang = 'de' THEN 'not readable' WHEN lang = 'es' THEN 'no posts' END AS reason FROM p)
SELECT * FROM w WHERE reason IS NOT NULL""")
def _(spark, sf):
    damaged = (F.when(F.col("lang") == "de", F.left("payload", F.length("payload") - 2)).when(F.col("lang") == "es", F.lit('{"data": {}}'))
               .when(F.col("lang") != "fr", F.col("payload")))
    return texts.refused_payloads(search_results(spark, sf).withColumn("payload", damaged))


# every fourth page counts as one of the source whose articles are taken whole
NEWS_SOURCE = "CASE WHEN page_id % 4 = 0 THEN 'cointelegraph.com' ELSE regexp_extract(url, 'https?://([^/]+)', 1) END"


@register("news_texts", [], rf"""
b AS (SELECT page_id, {NEWS_SOURCE} AS source,
        regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g') AS html FROM pages),
s AS (SELECT page_id, source, regexp_split_to_array(html, CASE WHEN source = 'cointelegraph.com' THEN '<(?:h1|h2)(?:\s[^>]*)?>' ELSE '<(?:h1|h2|h3|p)(?:\s[^>]*)?>' END) AS parts FROM b),
u AS (SELECT page_id, source, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM s),
c AS (SELECT page_id, source, i, regexp_replace(regexp_replace(part, '(?s)(</(?:p|h1|h2|h3|article)>|<(?:article|div|footer|nav|ul)[ >]).*$', ''), '<[^>]*>', '', 'g') AS t
      FROM u WHERE i > 0
      UNION ALL SELECT page_id, source, 0, regexp_replace(regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1), '<[^>]*>', '', 'g')
      FROM b WHERE source = 'cointelegraph.com'),
x AS (SELECT page_id, source, i, trim(regexp_replace(replace(t, '&quot;', '"'), '&amp;?', '&', 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS text FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS text_no FROM x WHERE length(text) > 50)
SELECT page_id, source, text_no, text FROM r""")
def _(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.expr(NEWS_SOURCE).alias("source"), "html")
    return texts.news_texts(pages).withColumn("text_no", F.col("text_no").cast("bigint"))


WORDS_SQL = """
w AS (SELECT currency, date, doc_id, unnest(regexp_split_to_array(lower(text), '[^\\pL\\pM'']+')) AS word FROM texts_day),
sc AS (SELECT currency, date, doc_id, coalesce(avg(polarity), 0.0) AS polarity, coalesce(avg(subjectivity), 0.0) AS subjectivity
       FROM w LEFT JOIN lexicon USING (word) GROUP BY currency, date, doc_id)"""
DAILY_SQL = WORDS_SQL + """,
daily AS (SELECT currency, date, avg(polarity) AS sentiment_mean, stddev_pop(polarity) AS sentiment_std,
            avg(subjectivity) AS subjectivity_mean, count(*) AS text_count FROM sc GROUP BY currency, date)"""
SPINE = ("2023-12-25", "2024-02-05")
SPINE_SQL = f"""
days AS (SELECT currency, cast(unnest(generate_series(DATE '{SPINE[0]}', DATE '{SPINE[1]}', INTERVAL 1 DAY)) AS DATE) AS date
         FROM (SELECT DISTINCT currency FROM texts_day))"""
MEASURE_SQL = ("round(coalesce(sentiment_mean, 0.0), 6) + 0.0 AS sentiment_mean, round(coalesce(sentiment_std, 0.0), 6) + 0.0 AS sentiment_std, "
               "round(coalesce(subjectivity_mean, 0.0), 6) + 0.0 AS subjectivity_mean, coalesce(text_count, 0) AS text_count")
TEXTS = ["texts_day", "lexicon"]


def scored(spark, sf):
    return sentiment.text_sentiment(view(spark, sf, "texts_day"), view(spark, sf, "lexicon"))


@register("text_sentiment", TEXTS, f"WITH {WORDS_SQL}\nSELECT currency, date, doc_id, {r6('polarity', 'subjectivity')} FROM sc")
def _(spark, sf):
    return rounded(scored(spark, sf))


@register("daily_sentiment", TEXTS, f"WITH {DAILY_SQL}\nSELECT currency, date, {MEASURE_SQL} FROM daily")
def _(spark, sf):
    return rounded(sentiment.daily_sentiment(scored(spark, sf)))


@register("date_spine", TEXTS, f"""WITH {DAILY_SQL}, {SPINE_SQL}
SELECT currency, date, {MEASURE_SQL} FROM days LEFT JOIN daily USING (currency, date)""")
def _(spark, sf):
    currencies = view(spark, sf, "texts_day").select("currency").distinct()
    return rounded(sentiment.date_spine(sentiment.daily_sentiment(scored(spark, sf)), currencies, *SPINE))


@register("sentiment_features", TEXTS, f"""WITH {DAILY_SQL}, {SPINE_SQL},
cached AS (SELECT currency, date, cast(0.25 AS DOUBLE) AS sentiment_mean, cast(0.5 AS DOUBLE) AS sentiment_std,
             cast(0.125 AS DOUBLE) AS subjectivity_mean, count(*) AS text_count
           FROM texts_day WHERE day(date) <= 10 GROUP BY currency, date),
mixed AS (SELECT * FROM cached UNION ALL SELECT daily.* FROM daily ANTI JOIN cached USING (currency, date))
SELECT currency, date, {MEASURE_SQL} FROM days LEFT JOIN mixed USING (currency, date)""")
def _(spark, sf):
    days = view(spark, sf, "texts_day")
    held = days.where("day(date) <= 20").groupBy("currency", "date").agg(F.count(F.lit(1)).alias("text_count")).select(
        "currency", "date", F.lit(0.25).alias("sentiment_mean"), F.lit(0.5).alias("sentiment_std"),
        F.lit(0.125).alias("subjectivity_mean"), "text_count")
    # days 1-10 were cached half an hour ago, days 11-20 so long ago that they have expired
    cache = sentiment.cache_days(held.where("day(date) <= 10"), "2024-01-29 23:30:00").unionByName(
        sentiment.cache_days(held.where("day(date) > 10"), "2024-01-29 20:00:00"))
    return rounded(sentiment.sentiment_features(days, view(spark, sf, "lexicon"), cache,
                                                days.select("currency").distinct(), *SPINE, AS_OF))


@register("day_key", ["texts_day"], """
SELECT DISTINCT currency, date, currency || '_' || strftime(date, '%Y-%m-%d') AS day_key FROM texts_day""")
def _(spark, sf):
    return view(spark, sf, "texts_day").select("currency", "date", day_key().alias("day_key")).distinct()


def cache_writes(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct("event_id")).alias("data"),
        F.col("ts").alias("written_at"), (F.col("ts") + F.expr("interval 1 hour")).alias("expires_at"))


TTL_SQL = """
writes AS (SELECT cast(user_id AS VARCHAR) AS key, '{"event_id":' || event_id || '}' AS data, ts AS written_at, ts + INTERVAL 1 HOUR AS expires_at FROM events),
latest AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY written_at DESC, expires_at DESC, data DESC) AS r FROM writes) WHERE r = 1)
"""


@register("ttl_latest", [], TTL_SQL + "SELECT * FROM latest")
def _(spark, sf):
    return ttl.ttl_latest(cache_writes(spark, sf))


@register("ttl_upsert", [], TTL_SQL + f"SELECT * FROM latest")
def _(spark, sf):
    writes = cache_writes(spark, sf)
    early = F.col("written_at") < F.lit("2024-01-15").cast("timestamp")
    return ttl.ttl_upsert(ttl.ttl_latest(writes.where(early)), writes.where(~early))


@register("ttl_get", [], TTL_SQL + f"SELECT * FROM latest WHERE expires_at > TIMESTAMP '{AS_OF}'")
def _(spark, sf):
    return ttl.ttl_get(cache_writes(spark, sf), AS_OF)


@register("ttl_cleanup", [], TTL_SQL + f"""SELECT * FROM latest WHERE expires_at >= TIMESTAMP '{AS_OF}'
  AND written_at >= TIMESTAMP '{AS_OF}' - INTERVAL 86400 SECOND""")
def _(spark, sf):
    return ttl.ttl_cleanup(cache_writes(spark, sf), AS_OF)
