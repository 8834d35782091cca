"""What several text operators share: rows with a number, keyed blocks of fingerprints, connected groups."""

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barworks.llm.sharing import PACKED, among, packed, shared, short, unpacked
from barworks.llm.words import mixed
from barworks.session import settle, shared_folder, shuffles_deleted

ITEMS_PER_BLOCK = 1 << 16
KEYS_PER_BLOCK = 3 << 20
KEYS_PER_BUCKET = 1 << 21


def table(spark, sf_dir, name):
    """One table of a folder, through Spark's reader alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df, name="_row"):
    """Number the rows of a stored table; repeated rows and ids get numbers of their own.

    The number follows from file and place in it, so a task that runs again gives the same one. Another scan may not: how
    Spark packs files into tasks follows the cores registered at that moment. Who reads the numbers twice has them `stored`.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def stored_table(df, by=None, **options):
    """Write a Parquet table into the shared folder, in folders `by` a column if given: its path. What was shuffled for it is
    deleted when it stands."""
    path = shared_folder(df.sparkSession)
    with shuffles_deleted(df.sparkSession):
        df.write.options(**options).parquet(path, partitionBy=by)
    return path


def stored(df, **options):
    """Cut lineage through a Parquet table in the shared folder: smaller than a checkpoint, and read by column."""
    return df.sparkSession.read.parquet(stored_table(df, **options))


def dropped(spark, path):
    """Delete a table of the shared folder that no later step reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def block_masks(max_diff, n_blocks):
    """Pigeonhole masks of a 64-bit fingerprint: the bits are cut into `n_blocks` blocks.

    Two fingerprints with at most `max_diff` differing bits agree in at least `n_blocks - max_diff` blocks, so they agree
    under the mask of some choice of that many blocks.
    """
    cuts = [64 * i // n_blocks for i in range(n_blocks + 1)]
    blocks = [sum(1 << b for b in range(cuts[i], cuts[i + 1])) for i in range(n_blocks)]
    return [sum(chosen) for chosen in combinations(blocks, n_blocks - max_diff)]


def _keys(prints, masks):
    """Key of each mask and fingerprint, a row per mask."""
    prints = np.asarray(prints, np.int64).view(np.uint64)
    return np.stack([mixed((prints & np.uint64(m)) ^ mixed(np.full(1, i + 1, np.uint64))) for i, m in enumerate(masks)])


def _members(items, n_keys, keys_of):
    """Items under each key that several items have: (key, id, fp, n). `keys_of` gives a row of keys per kind of key.

    Keys travel packed, a few bytes each, and only those that recur come back to their items.
    """
    count = items.count()
    blocks = max(1, -(-count // min(ITEMS_PER_BLOCK, max(1, KEYS_PER_BLOCK // n_keys))))
    n_buckets = max(1, -(-count * n_keys // KEYS_PER_BUCKET))
    items = items.select("*", F.pmod(F.xxhash64("id"), F.lit(blocks).cast("long")).alias("block"))

    def send(rows):
        keys, counts = np.unique(keys_of(rows), return_counts=True)
        return pa.table(packed(rows["block"][0].as_py(), np.concatenate((keys, keys[counts > 1])), n_buckets), ["bucket", "block", "keys"])

    def pick(rows, recurring):
        keys = keys_of(rows)
        mask, item = np.nonzero(among(short(keys, n_buckets), unpacked(recurring)))
        return pa.table([pa.array(keys[mask, item].view(np.int64)), *[rows[c].take(pa.array(item)) for c in ("id", "fp", "n")]],
                        ["key", "id", "fp", "n"])

    recurring = items.groupBy("block").applyInArrow(send, PACKED).groupBy("bucket").applyInArrow(shared, PACKED)
    return (items.groupBy("block").cogroup(recurring.groupBy("block"))
            .applyInArrow(pick, f"key long, id long, fp {items.schema['fp'].dataType.simpleString()}, n long"))


def hamming(a, b):
    return F.bit_count(a.bitwiseXOR(b))


EDGES_PER_LOT = 1 << 20
HOP_SALTS = 8
LINKS_PER_TASK = 1 << 17
_LINKS = "v long, p long"


def _lowest(v, p):
    """Links within the connected groups of these edges: each node but the smallest of its group, with that one."""
    nodes, at = np.unique(np.concatenate((v, p)), return_inverse=True)
    a, b = at[:len(v)], at[len(v):]
    top = np.arange(len(nodes))
    while True:
        x, y = top[a], top[b]
        if (x == y).all():
            break
        np.minimum.at(top, np.maximum(x, y), np.minimum(x, y))
        while (top[top] != top).any():
            top = top[top]
    below = np.flatnonzero(top != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[below]), pa.array(nodes[top[below]])], ["v", "p"])


def _lots_joined(batches):
    """Join the edges of a task in lots of bounded size; what a lot links stays linked."""
    v, p, size = [], [], 0
    for batch in batches:
        v.append(batch.column(0).to_numpy())
        p.append(batch.column(1).to_numpy())
        size += batch.num_rows
        if size >= EDGES_PER_LOT:
            yield _lowest(np.concatenate(v), np.concatenate(p))
            v, p, size = [], [], 0
    if size:
        yield _lowest(np.concatenate(v), np.concatenate(p))


def components(edges):
    """The smallest reachable node of every node that has an edge to another: (node, component).

    `edges` has two long columns a, b; nulls and edges of a node to itself link nothing. Every round each node takes its
    smallest known node as parent, its other ones are linked to that parent, and parents of parents are followed, so a chain
    halves each round in whatever order its nodes stand. Before a round is written, each task joins the edges it holds in
    lots, so a node has one link a lot however many edges it has, and a parent of many is met under `HOP_SALTS` salts. Few links
    are written by few tasks, however many partitions a shuffle has, so that more of them meet in a lot. Rounds go through Parquet
    in the shared folder (a checkpoint would hand its plan on to the next round), and a table goes once the next is written. The
    driver sees two counts a round.
    """
    spark = edges.sparkSession
    known = stored_table(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("p"))
                         .mapInArrow(_lots_joined, _LINKS))
    n_links = spark.read.parquet(known).count()
    while True:
        links = spark.read.parquet(known)
        up = links.groupBy("v").agg(F.min("p").alias("up"), F.count("*").alias("n"))
        salts = F.array(*[F.lit(i) for i in range(HOP_SALTS)])
        hops = up.select(F.col("v").alias("up"), F.col("up").alias("over"), F.explode(salts).alias("salt"))
        jumped = (up.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(HOP_SALTS)).cast("int")).join(hops, ["up", "salt"], "left")
                  .select("v", F.coalesce("over", "up").alias("p"), F.col("over").isNotNull().alias("moved")))
        several = up.where("n > 1").select("v", "up")
        sideways = (links.join(several, "v").where(F.col("p") > F.col("up"))
                    .select(F.col("p").alias("v"), F.col("up").alias("p"), F.lit(True).alias("moved")))
        seen = Observation()
        few = max(spark.sparkContext.defaultParallelism, n_links // LINKS_PER_TASK)
        following = stored_table(jumped.unionByName(sideways).coalesce(few).observe(seen, F.count_if("moved").alias("moved"), F.count("*").alias("n"))
                                 .select("v", "p").mapInArrow(_lots_joined, _LINKS))
        dropped(spark, known)
        known, n_links = following, seen.get["n"]
        if not seen.get["moved"]:
            break
    links = spark.read.parquet(known).distinct()
    return links.select(F.col("v").alias("node"), F.col("p").alias("component")).union(links.select("p", "p").distinct())


def near_groups(items, max_diff, n_blocks, verify=None):
    """Connected groups of distinct items whose fingerprints differ in few bits: (id, component) of linked items.

    `items` has id (long, distinct), fp (long) and n (how many rows it stands for), and is settled. `verify` takes pairs
    (a, b) of ids and keeps those that are links; without it the bits decide.
    """
    masks = block_masks(max_diff, n_blocks)
    close = hamming(F.col("fp"), F.col("fp2")) <= max_diff
    return keyed_groups(items, len(masks), lambda rows: _keys(rows["fp"].to_numpy(), masks), close, verify)


def keyed_groups(items, n_keys, keys_of, close, verify=None, done=None, lots=1, narrow=None):
    """Connected groups of items that share a key, are `close` (a Column of fp and fp2) and that `verify` keeps.

    fp may have any type that can be ordered. `keys_of` gives `n_keys` rows of 64-bit keys of a table of items, whose other columns it
    may read. Its attribute `turns`, if any, lists functions that give a share of these rows each; recurring keys are then sought for
    one share after the other.
    `narrow` takes pairs (a, b, fp, fp2) that are `close`, as often as they are met, and gives those (a, b) that `verify` is to see.
    `done` is called when `items` are not read any more. Keys take turns in `lots`, so that only a part of them is shuffled at a
    time. As `near_groups` else.

    No pair inside a group is needed once the group is known to be connected. So first every member of a key is compared
    with the member that stands for most rows. Then, in keys that still hold several groups, the members outside the
    largest of them are compared with all members of other groups. That finds every link between groups and leaves
    out the pairs within the largest, which is what a hot group of copies consists of.
    """
    verify = verify or (lambda pairs: pairs)
    spark, pair = items.sparkSession, [F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")]
    turns, keyed_paths, passing = getattr(keys_of, "turns", [keys_of]), [], []
    for keys in turns:
        members = _members(items, -(-n_keys // len(turns)), keys).withColumn("lot", F.pmod("key", F.lit(lots)).cast("int"))
        keyed_paths.append(stored_table(members, by="lot"))
    # the schema is given, as a table without rows has no files
    keyed = reduce(DataFrame.union, [spark.read.schema(members.schema).parquet(path) for path in keyed_paths])
    if done:
        done()

    def verified(pairs_of):
        made = []
        for i in range(lots):
            made.append(stored_table(pairs_of(keyed.where(F.col("lot") == i).drop("lot"))))
            while passing:
                dropped(spark, passing.pop())
        out = settle(verify(spark.read.parquet(*made).distinct()))
        for path in made:
            dropped(spark, path)
        return out

    def near(met):
        pairs = met.where(close).select(*pair, "fp", "fp2")
        return (narrow(pairs) if narrow else pairs.select("a", "b")).distinct()

    def with_first(keyed):
        first = (keyed.groupBy("key").agg(F.max(F.struct("n", "id", "fp")).alias("f"))
                 .select("key", F.col("f.id").alias("id2"), F.col("f.fp").alias("fp2")))
        return near(keyed.join(first, "key").where(F.col("id") != F.col("id2")))

    stars = verified(with_first)
    found = components(stars)
    known = found.withColumnRenamed("node", "id").withColumnRenamed("component", "g")

    def between_groups(keyed):
        grouped = keyed.join(known, "id", "left").withColumn("g", F.coalesce("g", "id"))
        sizes = grouped.groupBy("key", "g").agg(F.count("*").alias("m"))
        open_keys = (sizes.groupBy("key").agg(F.max(F.struct("m", "g")).alias("top"), F.count("*").alias("groups"))
                     .where("groups > 1").select("key", F.col("top.g").alias("top")))
        passing.append(stored_table(grouped.join(open_keys, "key").select("key", "id", "fp", "g", "top")))
        grouped = spark.read.parquet(passing[-1])
        left = grouped.where("g <> top").select("key", "id", "fp", "g")
        right = grouped.select("key", F.col("id").alias("id2"), F.col("fp").alias("fp2"), F.col("g").alias("g2"))
        return near(left.join(right, (left["key"] == right["key"]) & (F.col("g") != F.col("g2"))))

    rest = verified(between_groups)
    for path in keyed_paths:
        dropped(spark, path)
    if rest.isEmpty():
        return found
    return components(found.toDF("a", "b").union(rest))  # what the stars link is linked to the least of its group already
