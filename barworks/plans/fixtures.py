"""Views over the given tables, as one SQL text for Spark and for the oracle."""

from pyspark.sql import functions as F

from barworks.operators.positions import number_rows

SPARK = {"mn": "min_by", "mx": "max_by", "k1": "struct(ts, event_id)",
         "k2": "struct(l_orderkey, l_linenumber, l_extendedprice)", "str": "STRING"}
ORACLE = {"mn": "arg_min", "mx": "arg_max", "k1": "(ts, event_id)",
          "k2": "(l_orderkey, l_linenumber, l_extendedprice)", "str": "VARCHAR"}

VIEWS = {
    "bars_hour": """
SELECT event_type AS pair, '1h' AS timeframe, cast(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp,
       {mn}(value, {k1}) AS open, max(value) AS high, min(value) AS low,
       {mx}(value, {k1}) AS close, sum(value) AS volume
FROM events GROUP BY event_type, date_trunc('hour', ts)""",
    "bars_day": """
SELECT concat(l_returnflag, '/', l_linestatus) AS pair, '1d' AS timeframe, cast(l_shipdate AS TIMESTAMP) AS timestamp,
       {mn}(l_extendedprice, {k2}) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
       {mx}(l_extendedprice, {k2}) AS close, sum(l_quantity) AS volume
FROM lineitem GROUP BY l_returnflag, l_linestatus, l_shipdate""",
    "bars_supplier": """
SELECT cast(l_suppkey AS {str}) AS pair, '1d' AS timeframe, cast(l_shipdate AS TIMESTAMP) AS timestamp,
       {mn}(l_extendedprice, {k2}) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
       {mx}(l_extendedprice, {k2}) AS close, sum(l_quantity) AS volume
FROM lineitem GROUP BY l_suppkey, l_shipdate""",
    "texts_day": """
SELECT lang AS currency, cast(date_add(date '2024-01-01', cast(doc_id % 30 AS INTEGER)) AS DATE) AS date, doc_id, text
FROM documents""",
    "lexicon": """
SELECT word, cast(polarity AS DOUBLE) AS polarity, cast(subjectivity AS DOUBLE) AS subjectivity
FROM (VALUES ('the', 0.5, 0.25), ('and', -0.25, 0.5), ('of', 0.125, 1.0), ('la', -0.5, 0.75), ('le', 0.75, 0.5),
             ('è', 0.25, 0.125), ('ó', -0.125, 0.375), ('für', 0.0625, 0.25))
  AS t(word, polarity, subjectivity)""",
}

# A dense hourly grid with planted faults. The Spark plan numbers the rows with the library's own positions, so its SQL
# differs from the oracle's.
DIRTY_FAULTS = """
SELECT pair, '1h' AS timeframe, timestamp, rn, open,
       CASE WHEN rn % 97 = 0 THEN low - 1 ELSE high END AS high,
       CASE WHEN rn % 83 = 0 THEN high + 1 ELSE low END AS low,
       CASE WHEN rn <= 2 OR rn BETWEEN 100 AND 104 OR rn BETWEEN 200 AND 207 THEN NULL ELSE close END AS close,
       CASE WHEN rn % 89 = 0 THEN -volume ELSE volume END AS volume
FROM {j}"""

ORACLE_DIRTY = """
hours AS (SELECT pair, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp
          FROM bars_hour GROUP BY pair),
grid AS (SELECT pair, timestamp, row_number() OVER (PARTITION BY pair ORDER BY timestamp) AS rn FROM hours),
j AS (
  SELECT g.pair, g.timestamp, g.rn, b.open, b.high, b.low, b.close, b.volume
  FROM grid g LEFT JOIN bars_hour b ON b.pair = g.pair AND b.timestamp = g.timestamp),
f AS (""" + DIRTY_FAULTS.format(j="j") + """),
bars_dirty AS (
  SELECT pair, timeframe, timestamp, cast(rn AS BIGINT) AS ingest_seq, open, high, low, close, volume FROM f
  UNION ALL
  SELECT pair, timeframe, timestamp, cast(100000 + rn AS BIGINT) AS ingest_seq, open, high, low, close, volume
  FROM f WHERE rn % 101 = 0)"""


def table(spark, sf_dir, name):
    """One of the given tables; its zone-less times are read as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(field.name, df[field.name].cast("timestamp"))
    return df


def view(spark, sf_dir, name):
    """A fixture view as a DataFrame."""
    if name == "bars_dirty":
        return _bars_dirty(spark, sf_dir)
    sources = {t: table(spark, sf_dir, t) for t in ("events", "lineitem", "documents") if t in VIEWS[name]}
    text = VIEWS[name].format(**SPARK)
    for t in sources:
        text = text.replace(f"FROM {t}", "FROM {" + t + "}")
    return spark.sql(text, **sources)


def _bars_dirty(spark, sf_dir):
    bars = view(spark, sf_dir, "bars_hour")
    # every series gets every hour from its first to its last
    grid = spark.sql("""
SELECT pair, '1h' AS timeframe, explode(sequence(min(timestamp), max(timestamp), interval 1 hour)) AS timestamp
FROM {bars} GROUP BY pair""", bars=bars)
    joined = grid.join(bars, ["pair", "timeframe", "timestamp"], "left")
    numbered = number_rows(joined).withColumn("rn", F.col("rn") + 1).drop("_b", "n")
    faults = spark.sql(DIRTY_FAULTS.format(j="{j}"), j=numbered)
    on_time = faults.withColumn("ingest_seq", F.col("rn").cast("bigint"))
    late = faults.where("rn % 101 = 0").withColumn("ingest_seq", (F.lit(100000) + F.col("rn")).cast("bigint"))
    return on_time.unionByName(late).select("pair", "timeframe", "timestamp", "ingest_seq",
                                            "open", "high", "low", "close", "volume")


def oracle(names, query):
    """Oracle SQL: the named views as CTEs, then the query (which may start with more CTEs)."""
    parts = []
    wanted = list(names)
    if "bars_dirty" in wanted and "bars_hour" not in wanted:
        wanted.insert(0, "bars_hour")
    for name in wanted:
        parts.append(ORACLE_DIRTY.strip() if name == "bars_dirty"
                     else f"{name} AS ({VIEWS[name].format(**ORACLE)})")
    query = query.strip()
    head = "WITH RECURSIVE " + ",\n".join(parts)
    if not parts:
        return "WITH RECURSIVE " + (query[5:] if query.startswith("WITH ") else query)
    return head + (",\n" + query[5:].lstrip() if query.startswith("WITH ") else "\n" + query)
