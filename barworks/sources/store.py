"""The bar store: Parquet in layers, and versions that say which files hold what.

    <root>/writes/write=<n>/pair=<p>/timeframe=<t>/*.parquet   what write n brought
    <root>/manifests/<name>/*.parquet                          a row per file: keys, rows, times, bytes, digests
    <root>/states/<n>/*.parquet                                a row per file and series: statistics that merge
    <root>/commits/<n>.json                                    version n: its manifests, columns and layout

A write appends a layer of files with its own bars alone, so a daily load costs what it brings. Of bars that several layers
hold, the earliest layer's stays; readers settle that, and only for files whose times meet those of another layer. When a
partition has many layers, or layers that weigh much beside its oldest one, they are merged into one.

A version exists once its commit file is there, which appears complete or not at all and never over another. Of two writers
that want the same number one looks again and takes the next; appended layers never conflict, and a merge that finds its
files merged by another is dropped. With very many series, partition by timeframe alone: files are sorted by series and
time, so a key filter still skips files by their zones and row groups by their statistics.

Raw bars and feature frames live under different roots.
"""

import json
import re
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barworks.functions.schema import KEYS, missing_to_null, timeframe_seconds
from barworks.operators.positions import SLOTS, attach, number_bucket, previous
from barworks.operators.quality import judged, numeric_columns
from barworks.operators.rows import ISSUES, issue_flags, keep_first, union_all

KEEP_VERSIONS = 3
MOST_LAYERS = 8  # of a partition, before its later ones are merged
MERGE_SHARE = 0.25  # of the oldest layer's rows that later ones may hold, once they fill a row group
MERGE_ROWS = 100_000
FULL_EVERY = 16  # versions between two that list all files
WRITER = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "3",
    "parquet.page.size": "8192",
    # about 100,000 bars a row group
    "parquet.block.size": str(8 << 20),
}
_FILES = ("path string, pair string, timeframe string, write long, layer long, rows long, first timestamp, last timestamp, "
          "low string, high string, bytes long, digest_sum long, digest_xor long, gone boolean")
_NAMES = [f.split()[0] for f in _FILES.split(", ")]
_ISSUES = [f"n_{name}" for name in ISSUES]
_PER_COLUMN = "array<struct<column:string,n:bigint,mean:double,m2:double,low:double,high:double>>"


def _fs(spark, path):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target, jvm.org.apache.hadoop.fs.Path


@dataclass
class Commit:
    """One version: manifests that it adds, `full` if they list all files, and what holds for the whole store."""

    number: int
    manifests: list
    schema: str
    partition_by: list
    oldest: int
    full: bool = False
    removes: bool = False
    batches: dict = field(default_factory=dict)  # last batch of each stream

    def fields(self):
        return T.StructType.fromJson(json.loads(self.schema))


def _numbers(spark, root):
    fs, _, path = _fs(spark, root)
    folder = path(f"{root}/commits")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(m.group(1)) for m in (re.fullmatch(r"(\d+)\.json", n) for n in names) if m)


def _commit(spark, root, number):
    fs, _, path = _fs(spark, root)
    stream = fs.open(path(f"{root}/commits/{number}.json"))
    try:
        return Commit(**json.loads(bytes(stream.readAllBytes()).decode()))
    finally:
        stream.close()


def latest(spark, root):
    """The newest commit, or None where nothing is stored."""
    known = _numbers(spark, root)
    return _commit(spark, root, known[-1]) if known else None


def versions(spark, root):
    """Numbers of the versions that are kept, oldest first."""
    known = _numbers(spark, root)
    oldest = _commit(spark, root, known[-1]).oldest if known else 0
    return [n for n in known if n >= oldest]


def _publish(spark, root, commit):
    """Create the commit file in one step; False if the number is taken."""
    jvm, (fs, _, path) = spark.sparkContext._jvm, _fs(spark, root)
    draft, target = path(f"{root}/drafts/{uuid.uuid4().hex}"), path(f"{root}/commits/{commit.number}.json")
    out = fs.create(draft, False)
    out.write(json.dumps(asdict(commit)).encode())
    out.close()
    fs.mkdirs(target.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:  # a rename that does not replace
        context.rename(draft, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        if not fs.exists(target):
            raise error
        fs.delete(draft, False)
        return False
    return True


def _claimed(spark, root):
    """A write number of one's own."""
    fs, _, path = _fs(spark, root)
    folder = path(f"{root}/claims")
    taken = [int(s.getPath().getName()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
    number = max(taken, default=0) + 1
    while True:
        try:
            fs.create(path(f"{root}/claims/{number}"), False).close()
            return number
        except Py4JJavaError as error:
            if not fs.exists(path(f"{root}/claims/{number}")):
                raise error
            number += 1


def manifest(spark, root, version):
    """The files of a version: path below `writes`, partition, write, layer, rows, times, zone of pairs, bytes, digests."""
    chain = []
    for n in reversed([n for n in _numbers(spark, root) if n <= version]):
        chain.append(_commit(spark, root, n))
        if chain[-1].full:
            break
    layers = {name: c.number for c in chain for name in c.manifests}
    rows = spark.read.schema(_FILES).parquet(*[f"{root}/manifests/{name}" for name in layers])
    name = F.regexp_extract("_metadata.file_path", "/manifests/([^/]+)/", 1)
    own = F.create_map(*[F.lit(x) for pair in layers.items() for x in pair])[name]
    rows = rows.withColumn("layer", F.coalesce("layer", own.cast("long")))
    if any(c.removes for c in chain):
        rows = rows.where("NOT gone").join(rows.where("gone").select("path"), "path", "left_anti")
    return rows.select(*_NAMES).drop("gone")


def _scan(spark, root, paths, schema):
    """Bars of some files as they were written; partition values stay text: a pair named 007 is not the number 7."""
    fields = [T.StructField("write", T.LongType()), *[T.StructField(c, T.StringType()) for c in KEYS],
              *[f for f in schema.fields if f.name not in KEYS]]
    return spark.read.schema(T.StructType(fields)).option("basePath", f"{root}/writes").parquet(*[f"{root}/writes/{p}" for p in paths])


def _layered(files, partition_by):
    """Files with `mixed`: whether another layer of their partition has bars of the times that they span.

    Files in order of their first bar fall into islands of times; an island of one layer needs no settling.
    """
    by = Window.partitionBy(*partition_by)
    order = by.orderBy("first", "last", "path")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = files.withColumn("_new", F.when(F.col("first") <= reached, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(order))
    island = Window.partitionBy(*partition_by, "_island")
    return islands.withColumn("mixed", F.min("layer").over(island) < F.max("layer").over(island)).drop("_new", "_island")


def _bars(spark, root, files, schema, partition_by, wanted=lambda df: df):
    """Bars of some files, one per series and time: of layers that meet in time the earliest counts."""
    listed = _layered(files, partition_by).select("path", "write", "layer", "mixed").collect()
    clean, mixed = ([r.path for r in listed if r.mixed == m] for m in (False, True))
    columns = [*KEYS, *[f.name for f in schema.fields if f.name not in KEYS]]
    parts = []
    if clean or not mixed:
        found = _scan(spark, root, clean, schema) if clean else spark.createDataFrame([], schema)
        parts.append(wanted(found).select(*columns))
    if mixed:
        layers = spark.createDataFrame(sorted({(r.write, r.layer) for r in listed if r.mixed}), "write long, _layer long")
        met = wanted(_scan(spark, root, mixed, schema)).join(F.broadcast(layers), "write")
        parts.append(keep_first(met, ["_layer"]).select(*columns))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_bars(spark, root, pair=None, timeframe=None, version=None, start=None, end=None):
    """The newest (or given) version, or None when nothing is stored.

    Keys and times (`start` included, `end` not) prune the files that are opened, by their partition and their zones in the
    manifest; no folder is listed. Only the files that remain are named to Spark, on the driver, as any file scan holds them.
    """
    known = versions(spark, root)
    if not known:
        return None
    commit = _commit(spark, root, version or known[-1])
    files, conditions = manifest(spark, root, commit.number), []
    if pair is not None:
        files = files.where((F.col("low") <= F.lit(pair)) & (F.col("high") >= F.lit(pair)))
        conditions.append(F.col("pair") == pair)
    if timeframe is not None:
        files = files.where(F.col("timeframe").isNull() | (F.col("timeframe") == timeframe))
        conditions.append(F.col("timeframe") == timeframe)
    if start is not None:
        files = files.where(F.col("last") >= F.lit(start).cast("timestamp"))
        conditions.append(F.col("timestamp") >= F.lit(start).cast("timestamp"))
    if end is not None:
        files = files.where(F.col("first") < F.lit(end).cast("timestamp"))
        conditions.append(F.col("timestamp") < F.lit(end).cast("timestamp"))

    def wanted(df):
        for condition in conditions:
            df = df.where(condition)
        return df
    return missing_to_null(_bars(spark, root, files, commit.fields(), commit.partition_by, wanted))


def merge_bars(stored, new, keys=KEYS):
    """Stored rows and new rows, one per timestamp; what is stored wins. A column that one side lacks is NULL there."""
    both = stored.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    ties = [F.col(c) for c in both.columns if c not in (*keys, "timestamp", "_src")]
    return keep_first(both, [F.col("_src"), *ties], (*keys, "timestamp")).drop("_src")


def _joined(old, new):
    """The columns of both schemas; a column that both have must have one type."""
    types = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if types.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is stored as {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    order = [*KEYS, *[f.name for f in old.fields if f.name not in KEYS], *[f.name for f in new.fields if f.name not in KEYS]]
    return T.StructType([T.StructField(c, types[c]) for c in dict.fromkeys(order)])


def _digests(row):
    """Sum and xor of row hashes; both merge in any order, so they tell the same for files, writes and versions."""
    return [F.coalesce(F.sum(F.pmod(row, F.lit(1 << 32))), F.lit(0)).alias("digest_sum"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("digest_xor")]


def _measured(df):
    """Files and series of a scan as they are now: bytes, digests, and statistics that merge."""
    columns = sorted(c for c in df.columns if c != "write")
    path = F.regexp_extract(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), r".*/writes/(write=\d+/.+)$", 1)
    rows = df.select("*", path.alias("_path"), F.col("_metadata.file_size").alias("_bytes"), F.xxhash64(*columns).alias("_row"))
    rows = missing_to_null(rows)  # what readers see; the digest is of what is stored
    return rows.groupBy(F.col("_path").alias("path"), F.col("_bytes").alias("bytes"), *KEYS).agg(
        F.max("write").alias("write"), *_digests(F.col("_row")), *_statistics(rows, numeric_columns(df.drop("write"))))


def _statistics(df, numeric):
    """Aggregates: rows, times, hits of P8's conditions, and per numeric column what merges."""
    cells = [F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).cast("double").alias("mean"),
                      (F.var_pop(c) * F.count(c)).alias("m2"), F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high"))
             for c in numeric]
    return [F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
            *[F.count_if(hit).alias(f"n_{name}") for name, hit in _flags(df).items()], F.array(*cells).cast(_PER_COLUMN).alias("columns")]


def _flags(df):
    """P8's conditions, where the bars have the columns for them."""
    none = {name: F.lit(False) for name in ISSUES}
    return issue_flags() if {"open", "high", "low", "close", "volume"} <= set(df.columns) else none


def _described(spark, root, number):
    """Files of a write, from the states it left: path, rows, times, zone of pairs, bytes, digests."""
    return _of_files(spark.read.parquet(f"{root}/states/{number}"))


def _of_files(measured):
    """Files of a table of states, as `_described`."""
    return measured.groupBy("path", "bytes").agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.min("pair").alias("low"), F.max("pair").alias("high"), F.sum("digest_sum").alias("digest_sum"),
        F.bit_xor("digest_xor").alias("digest_xor"), *[F.max(c).alias(c) for c in (*KEYS, "write")])


def _written(df, root, partition_by, layer=None):
    """Write bars as a layer of files and describe what was written in a manifest: (write, manifest), or None for no bars.

    `df` is evaluated once. Files are filled to Spark's advised size: small partitions share tasks and a large one is split
    over many. What is read back must be what went out: rows, times and digests are observed in the writing stage itself,
    where a task that runs again is still counted once.
    """
    spark, number, name = df.sparkSession, _claimed(df.sparkSession, root), uuid.uuid4().hex
    path, seen = f"{root}/writes/write={number}", Observation()
    rest = [k for k in KEYS if k not in partition_by]
    spread = df.hint("rebalance", *KEYS).sortWithinPartitions(*partition_by, *rest, "timestamp")
    measures = [F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), *_digests(F.xxhash64(*sorted(df.columns)))]
    spread.observe(seen, *measures).write.options(**WRITER).partitionBy(*partition_by).mode("overwrite").parquet(path)
    observed = seen.get
    if not observed["rows"]:
        return None
    _measured(_scan(spark, root, [f"write={number}"], df.schema)).write.parquet(f"{root}/states/{number}")
    back = _described(spark, root, number)
    keys = [(F.col(k) if k in partition_by else F.lit(None).cast("string")).alias(k) for k in KEYS]
    back.select("path", *keys, "write", F.lit(layer).cast("long").alias("layer"), "rows", "first", "last", "low", "high", "bytes",
                "digest_sum", "digest_xor", F.lit(False).alias("gone")).write.parquet(f"{root}/manifests/{name}")
    if not verify_write(spark, root, name, {**observed, "schema": df.schema}):
        raise IOError(f"write {number} under {root} does not hold what was written")
    return number, name


def verify_write(spark, root, name, expected):
    """Compare what a manifest says of a write with types, row count, time range and digests that were observed."""
    files = spark.read.schema(_FILES).parquet(f"{root}/manifests/{name}")
    found = files.agg(F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("digest_sum").alias("digest_sum"),
                      F.bit_xor("digest_xor").alias("digest_xor"), F.first("write").alias("write"), F.first("path").alias("path")).first().asDict()
    write, path = found.pop("write"), found.pop("path")
    held = spark.read.option("basePath", f"{root}/writes/write={write}").parquet(f"{root}/writes/{path}").schema
    types = {f.name: f.dataType for f in held.fields if f.name not in KEYS}
    return types == {f.name: f.dataType for f in expected["schema"].fields if f.name not in KEYS} and found == {k: expected[k] for k in found}


def damaged_files(spark, root, version=None):
    """Files of a version that no longer hold what was written, by their rows and digests: (path, rows, found)."""
    known = versions(spark, root)
    if not known:
        return spark.createDataFrame([], "path string, rows long, found long")
    return _damaged(spark, root, manifest(spark, root, version or known[-1]))


def _damaged(spark, root, files):
    """A digest covers the columns of its write, so files are read again write by write: a write has columns of its own."""
    parts = [spark.createDataFrame([], "path string, rows long, found long")]
    by_write = {}
    for r in files.select("write", "path").collect():
        by_write.setdefault(r.write, []).append(r.path)
    for write, paths in by_write.items():
        held = spark.read.option("basePath", f"{root}/writes/write={write}").parquet(f"{root}/writes/{paths[0]}").schema
        now = _of_files(_measured(_scan(spark, root, paths, held))).select(
            "path", F.col("rows").alias("found"), F.col("digest_sum").alias("_sum"), F.col("digest_xor").alias("_xor"))
        both = files.where(F.col("write") == write).join(now, "path", "left")
        same = (F.col("rows") == F.col("found")) & (F.col("digest_sum") == F.col("_sum")) & (F.col("digest_xor") == F.col("_xor"))
        parts.append(both.where(~F.coalesce(same, F.lit(False))).select("path", "rows", "found"))
    return union_all(*parts)


def write_bars(df, root, partition_by=KEYS, batch=None):
    """Append bars as a layer, check it, name the new version, merge layers that have grown, drop old versions.

    Bars that are stored already, at any time of the same series, stay as they are. Returns the version written, or None
    for an empty frame. `batch` (stream, number) makes the write happen once: a batch that the store holds is None as well.
    """
    spark, partition_by = df.sparkSession, list(partition_by)
    before = latest(spark, root)
    _next(before, df.schema, partition_by)  # refuse before anything is written
    if _holds(before, batch):
        return None
    one = keep_first(df, [F.col(c) for c in df.columns if c not in (*KEYS, "timestamp")])
    written = _written(one, root, partition_by)
    if written is None:
        return None
    while True:
        before = latest(spark, root)
        if _holds(before, batch):
            return None
        commit = _next(before, df.schema, partition_by, [written[1]])
        if batch:
            commit.batches = {**commit.batches, batch[0]: batch[1]}
        if _publish(spark, root, _listed(spark, root, before, commit)):
            break
    merge_layers(spark, root)
    prune_versions(spark, root, before.oldest if before else 1)
    return commit.number


def _holds(before, batch):
    return bool(batch and before and before.batches.get(batch[0], -1) >= batch[1])


def _next(before, schema, partition_by, manifests=(), removes=False):
    """The commit that would follow, or an error if the bars do not fit what is stored."""
    if not set(partition_by) <= set(KEYS):
        raise ValueError(f"bars are partitioned by {' and '.join(KEYS)} or one of them, not {partition_by}")
    if before is None:
        return Commit(1, list(manifests), _joined(T.StructType([]), schema).json(), partition_by, 1, True)
    if set(before.partition_by) != set(partition_by):
        raise ValueError(f"the store is partitioned by {sorted(before.partition_by)}, not {sorted(partition_by)}")
    number = before.number + 1
    return Commit(number, list(manifests), _joined(before.fields(), schema).json(), before.partition_by,
                  max(before.oldest, number - KEEP_VERSIONS), removes=removes, batches=before.batches)


def _listed(spark, root, before, commit):
    """A commit that lists all files if the last such one is far back."""
    if before is None or commit.number % FULL_EVERY:
        return commit
    now, name = manifest(spark, root, before.number), uuid.uuid4().hex
    own = spark.read.schema(_FILES).parquet(*[f"{root}/manifests/{m}" for m in commit.manifests])
    own = own.withColumn("layer", F.coalesce("layer", F.lit(commit.number).cast("long")))
    kept = now.join(own.where("gone").select("path"), "path", "left_anti").withColumn("gone", F.lit(False))
    kept.unionByName(own.where("NOT gone")).select(*_NAMES).coalesce(1).write.parquet(f"{root}/manifests/{name}")
    return Commit(**{**asdict(commit), "manifests": [name], "full": True})


def merge_layers(spark, root, most=MOST_LAYERS, share=MERGE_SHARE, least_rows=MERGE_ROWS):
    """Merge the layers of partitions that have too many: the later ones into one, or all if those weigh much beside the oldest.

    Returns the version that holds the merged files, or None if nothing was due or another writer merged the same files.
    """
    before = latest(spark, root)
    by, files = before.partition_by, manifest(spark, root, before.number)
    part = Window.partitionBy(*by)
    sized = files.withColumn("_oldest", F.min("layer").over(part)).withColumn("_base", F.sum(F.when(F.col("layer") == F.col("_oldest"), F.col("rows"))).over(part))
    sized = (sized.withColumn("_later", F.sum("rows").over(part) - F.col("_base"))
             .withColumn("_layers", F.size(F.collect_set("layer").over(part))))
    heavy = (F.col("_later") > share * F.col("_base")) & (F.col("_later") >= least_rows)
    due = sized.where((F.col("_layers") > 1) & (heavy | ((F.col("_layers") > most) & (F.col("layer") > F.col("_oldest")))))
    due = due.select(*files.columns)
    paths = [r.path for r in due.select("path").collect()]
    if not paths:
        return None
    chosen = files.where(F.col("path").isin(paths)) if len(paths) < 100 else due
    broken = _damaged(spark, root, chosen).first()
    if broken:
        raise IOError(f"{broken.path} under {root} does not hold what was written")
    written = _written(_bars(spark, root, chosen, before.fields(), by), root, by, layer=before.number)
    gone = uuid.uuid4().hex
    chosen.withColumn("gone", F.lit(True)).select(*_NAMES).coalesce(1).write.parquet(f"{root}/manifests/{gone}")
    while True:
        now = latest(spark, root)
        if now.number > before.number:
            live = manifest(spark, root, now.number).join(chosen.select("path"), "path", "left_semi").count()
            if live < len(paths):
                return None
        commit = _next(now, now.fields(), by, [written[1], gone], removes=True)
        if _publish(spark, root, _listed(spark, root, now, commit)):
            return commit.number


def prune_versions(spark, root, since):
    """Every commit says which versions it keeps, itself and `KEEP_VERSIONS` older ones as backups. Files that only versions
    dropped after `since` (the oldest one kept before) refer to go, and commits that no kept version is read from."""
    oldest = latest(spark, root).oldest
    known = _numbers(spark, root)
    if oldest <= since:
        return
    fs, _, path = _fs(spark, root)
    if any(_commit(spark, root, n).removes for n in known if since < n <= oldest):
        dropped = union_all(*[manifest(spark, root, n).select("path") for n in range(since, oldest)]).distinct()
        for row in dropped.join(manifest(spark, root, oldest).select("path"), "path", "left_anti").toLocalIterator():
            fs.delete(path(f"{root}/writes/{row.path}"), False)
    for n in [n for n in known if n < oldest - oldest % FULL_EVERY]:
        for name in _commit(spark, root, n).manifests:
            fs.delete(path(f"{root}/manifests/{name}"), True)
        fs.delete(path(f"{root}/commits/{n}.json"), False)


def storage_stats(spark, root):
    """Files and bytes of the newest version, and of what only older versions refer to."""
    known = versions(spark, root)
    if not known:
        return spark.sql("SELECT 0L AS file_count, 0L AS total_bytes, 0L AS backup_count, 0L AS backup_bytes")
    files = [manifest(spark, root, n).select("path", "bytes", F.lit(n == known[-1]).alias("now")) for n in known]
    held = union_all(*files).groupBy("path").agg(F.max("bytes").alias("size"), F.bool_or("now").alias("now"))
    return held.agg(
        F.count_if("now").alias("file_count"), F.coalesce(F.sum(F.when(F.col("now"), F.col("size"))), F.lit(0)).alias("total_bytes"),
        F.count_if(~F.col("now")).alias("backup_count"),
        F.coalesce(F.sum(F.when(~F.col("now"), F.col("size"))), F.lit(0)).alias("backup_bytes"))


def series_statistics(spark, root, version=None):
    """What the stored bars of each series add up to, without reading them: keys, rows, n_<issue> counts, and
    `columns`, a map of column to (n, mean, m2, low, high): values present, mean, sum of squared deviations, least and
    largest.

    Each write leaves these per file and series; they merge in any order (means by weight, deviations by Chan's rule). Only
    bars in partitions whose layers meet in time are read, since there the stored rows are not all that a reader sees.
    """
    commit = _commit(spark, root, version or versions(spark, root)[-1])
    by, files = commit.partition_by, manifest(spark, root, commit.number)
    marked = _layered(files, by).groupBy(*by).agg(F.bool_or("mixed").alias("mixed"))
    clean = files.join(marked.where("NOT mixed").select(*by), by, "left_semi")
    writes = [r.write for r in clean.select("write").distinct().collect()]
    parts = []
    if writes:
        states = spark.read.parquet(*[f"{root}/states/{w}" for w in writes]).join(clean.select("path"), "path", "left_semi")
        parts.append(states.select(*KEYS, "rows", *_ISSUES, "columns"))
    met = files.join(marked.where("mixed").select(*by), by, "left_semi")
    if not writes or not met.isEmpty():
        bars = missing_to_null(_bars(spark, root, met, commit.fields(), by))
        parts.append(bars.groupBy(*KEYS).agg(*_statistics(bars, numeric_columns(bars))).select(*KEYS, "rows", *_ISSUES, "columns"))
    states = union_all(*parts)
    totals = states.groupBy(*KEYS).agg(F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in _ISSUES])
    cells = states.select(*KEYS, F.inline("columns")).where("n > 0")
    means = cells.groupBy(*KEYS, "column").agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    merged = cells.join(means, [*KEYS, "column"]).groupBy(*KEYS, "column", "_n", "_mean").agg(
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2).alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"))
    columns = F.map_from_entries(F.collect_list(F.struct("column", F.struct(F.col("_n").alias("n"), F.col("_mean").alias("mean"), "m2", "low", "high"))))
    return totals.join(merged.groupBy(*KEYS).agg(columns.alias("columns")), list(KEYS), "left")


def stored_quality(spark, root, columns, missing=0.15, variance=1e-6, version=None):
    """A4 from the statistics of the store: `quality_report` of some columns without its outliers."""
    of = {c: F.col("columns")[c] for c in columns}
    worst = [F.lit(1.0) - F.coalesce(of[c]["n"], F.lit(0)) / F.col("rows") for c in columns]
    spread = [F.when(of[c]["n"] > 1, of[c]["m2"] / (of[c]["n"] - 1)) for c in columns]
    wide = series_statistics(spark, root, version).select(
        *KEYS, (F.greatest(*worst) if len(worst) > 1 else worst[0]).alias("max_null_ratio"),
        (F.least(*spread) if len(spread) > 1 else spread[0]).alias("min_variance"), *_ISSUES)
    return judged(wide, missing, variance)


def read_legacy_files(spark, path):
    """One file per series, `{BASE}_{QUOTE}_{timeframe}.parquet`, keys only in the name.

    Nanosecond timestamps are read as integers. Where the files hold them, the session must have the setting
    spark.sql.legacy.parquet.nanosAsLong; it is the caller's session, so it is not changed here.
    """
    df = spark.read.parquet(path)
    name = F.col("_metadata.file_name")
    pattern = r"^(.+)_([^_]+)\.parquet$"
    stamp = F.col("timestamp")
    if dict(df.dtypes)["timestamp"] == "bigint":
        stamp = F.timestamp_micros(F.floor(F.col("timestamp") / F.lit(1000)))
    bars = df.select(F.regexp_replace(F.regexp_extract(name, pattern, 1), "_([^_]+)$", "/$1").alias("pair"),
                     F.regexp_extract(name, pattern, 2).alias("timeframe"), stamp.cast("timestamp").alias("timestamp"),
                     *[c for c in df.columns if c != "timestamp"])
    return missing_to_null(bars)


def missing_series(requested, stored, keys=KEYS):
    """Requested series that are not stored, as a work list."""
    return requested.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def read_through(requested, stored, fetched, keys=KEYS):
    """Stored bars of the requested series, and fetched bars of those that are not stored."""
    served = attach(stored, requested.select(*keys).distinct(), keys, how="left_semi")
    gaps = missing_series(requested, stored, keys).select(*keys).distinct()
    return served.unionByName(attach(fetched, gaps, keys, how="left_semi").select(*served.columns))


def missing_ranges(requested, stored, keys=KEYS):
    """Which bars of the requested windows are not stored, as ranges: pair, timeframe, start, end, n_bars.

    `requested` has keys, start and end (not included); bars are expected at whole multiples of their width. A range is as
    long as it can be within its window, and start and end make it a request of its own, so `plan_chunks` can take it.
    Holes come from each bar and the one before it; windows and holes meet by the stretches of time they span, so a
    series with many of either is spread. Windows of a series of unknown width, or without start or end, ask for nothing.
    """
    width = timeframe_seconds()
    held = stored.select(*keys, F.floor(F.unix_seconds("timestamp") / width).alias("slot")).where("slot IS NOT NULL").distinct()
    holes = (previous(held, ["slot"], "slot", number_bucket("slot"), keys).where("slot - prev_slot > 1")
             .select(*keys, (F.col("prev_slot") + 1).alias("_lo"), (F.col("slot") - 1).alias("_hi")))
    asked = requested.select(*keys, F.ceil(F.unix_seconds("start") / width).alias("lo"), (F.ceil(F.unix_seconds("end") / width) - 1).alias("hi"))
    asked = asked.where("lo <= hi").distinct()
    ends = held.groupBy(*keys).agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    around = asked.join(ends, list(keys), "left")
    # before the first stored bar, or the whole window of a series without any; after the last one
    before = around.select(*keys, "lo", F.least("hi", F.col("first") - 1).alias("hi"))
    after = around.where("last IS NOT NULL").select(*keys, F.greatest("lo", F.col("last") + 1).alias("lo"), "hi")

    def stretched(df, lo, hi):
        return df.withColumn("_s", F.explode(F.sequence(F.floor(F.col(lo) / F.lit(SLOTS)), F.floor(F.col(hi) / F.lit(SLOTS)))))
    within = stretched(asked, "lo", "hi").join(stretched(holes, "_lo", "_hi"), [*keys, "_s"])
    within = within.select(*keys, "_s", F.greatest("lo", "_lo").alias("lo"), F.least("hi", "_hi").alias("hi"))
    # a hole and a window that meet in several stretches count in the first
    within = within.where(F.floor(F.col("lo") / F.lit(SLOTS)) == F.col("_s")).drop("_s")
    found = union_all(before, after, within).where("lo <= hi")
    return found.select(*keys, F.timestamp_seconds(F.col("lo") * width).alias("start"), F.timestamp_seconds((F.col("hi") + 1) * width).alias("end"),
                        (F.col("hi") - F.col("lo") + 1).alias("n_bars"))
