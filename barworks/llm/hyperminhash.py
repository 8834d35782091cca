"""Near-duplicate documents by HyperMinHash: registers of leading zeros and a mantissa, bands of them as keys, a Jaccard
estimate that is corrected for chance collisions, and the full sets of shingles as the last word.

Sets that share a band are compared where they meet, block against block, and a block sends on only which of its sets hang
together. So no row is made for a pair, and a band that very many sets share is dealt over many tasks.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from barworks.llm.common import _lowest, _members, components, dropped, stored, stored_table, table
from barworks.llm.words import mixed

SHINGLE = 3  # words
PERCENT = 85  # least share of common shingles
BUCKETS = 128
MANTISSA = 11  # bits; the leading zeros take the other 5 of a register
BAND = 5  # registers; 25 bands miss a pair at the least share once in 2 million
SLACK = 0.19  # six standard deviations of an estimate from 128 registers at the least share
BLOCK_SETS = 1024  # sets of a band that meet in one task
BLOCK_HASHES = 1 << 21  # shingles of such sets
SETS_AT_ONCE = 16  # sets whose registers are compared with all of a block's at a time
SHINGLES_AT_ONCE = 1024
LINKS_AT_ONCE = 1 << 16
KNOWN_WORDS = 1 << 17  # words whose hash a worker remembers
FILTER_SIZE = 1 << 20  # numbers at most in the filter that goes to the tasks

_UPPER_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_N_BANDS = BUCKETS // BAND
_STEP = np.uint64(0x100000001B3)
_BITS_OF_BUCKET = np.uint64(7)
# where an empty bucket looks for a value: every bucket once, in an order of its own
_ORDERS = np.stack([np.random.default_rng(i).permutation(BUCKETS) for i in range(BUCKETS)])


class _Words(dict):
    """Hashes of words, computed once each."""

    def __missing__(self, word):
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, 42)
        return value


_WORDS = _Words()


def shingles(text, n_words=SHINGLE):
    """Hashes of the different runs of `n_words` words, in order; a shorter text is one run, one without words has none."""
    words = (text or "").encode("utf-8", "replace").translate(_UPPER_TO_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    single = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - n_words + 1)
    out = mixed(single[:n])
    for i in range(1, min(n_words, len(words))):
        out = mixed(out * _STEP + single[i:i + n])
    return np.unique(out)


def sketch(found):
    """Registers of a set of hashes: a bucket's least hash as leading zeros and the bits that follow the first one.

    The least hash of an empty bucket is that of the first bucket with one in the order of this bucket, the same for all sets.
    """
    bucket = (found >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    least = (found[first] << _BITS_OF_BUCKET) >> np.uint64(12)  # 52 bits: exact as a double
    _, length = np.frexp(least.astype(np.float64))
    below = np.maximum(length - 1 - MANTISSA, 0).astype(np.uint64)
    mantissa = (least >> below) & np.uint64((1 << MANTISSA) - 1)
    registers = np.zeros(BUCKETS, np.uint16)
    registers[bucket[first]] = (np.minimum(52 - length, 31) << MANTISSA).astype(np.uint16) | mantissa.astype(np.uint16)
    if len(first) < BUCKETS:
        filled = np.zeros(BUCKETS, bool)
        filled[bucket[first]] = True
        empty = np.flatnonzero(~filled)
        registers[empty] = registers[_ORDERS[empty, filled[_ORDERS[empty]].argmax(axis=1)]]
    return registers


def expected_collisions(n, m):
    """Share of the registers of two sets of n and m elements that agree by chance: both least hashes in one octave and,
    within it, in one of the cells of the mantissa."""
    edges = 2.0 ** -np.arange(32)
    in_octave = [np.exp(-np.outer(size / BUCKETS, edges[1:])) - np.exp(-np.outer(size / BUCKETS, edges[:-1])) for size in (n, m)]
    return (in_octave[0] * in_octave[1]).sum(axis=1) / (1 << MANTISSA)


def estimate(a, b, n, m):
    """Jaccard similarity from registers, a row a pair, less what agrees by chance."""
    chance = expected_collisions(n, m)
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def _sketched(n_words):
    def run(batches):
        for batch in batches:
            ids, sizes, registers = [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), n_words)
                sizes.append(len(found))
                ids.append(_set_id(found) if len(found) else None)
                registers.append(sketch(found).astype("<u2").tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(registers, pa.binary())],
                ["doc_id", "text_key", "id", "size", "registers"])
    return run


def _set_id(found):
    return xxhash.xxh64_intdigest(found.astype("<u8").tobytes()) - (1 << 63)


def _full_sets(n_words):
    """Registers and all hashes of the sets that share a band with another, from their texts."""
    def run(batches):
        for batch in batches:
            found = [shingles(text.as_py(), n_words) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_id(f) for f in found], pa.int64()), pa.array([sketch(f).astype("<u2").tobytes() for f in found], pa.binary()),
                 pa.array([f.astype("<u8").tobytes() for f in found], pa.binary())], ["id", "registers", "hashes"])
    return run


def _registers(column):
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, BUCKETS)


def _band_keys(rows):
    """A row of 64-bit keys per band."""
    registers = _registers(rows["registers"])
    keys = []
    for band in range(_N_BANDS):
        key = np.full(len(registers), band + 1, np.uint64)
        for register in registers[:, band * BAND:(band + 1) * BAND].T:
            key = mixed(key * _STEP + register.astype(np.uint64))
        keys.append(key)
    return np.stack(keys)


def common_shingles(sets, rows, columns):
    """How many elements each set of `rows` shares with each of `columns`: products of 0-1 matrices over the elements that
    several of the sets have, SHINGLES_AT_ONCE of them at a time."""
    which = np.unique(np.concatenate((rows, columns)))
    values = np.concatenate([sets[i] for i in which])
    owner = np.repeat(np.arange(len(which)), [len(sets[i]) for i in which])
    _, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    several = counts > 1
    number = np.cumsum(several) - 1
    keep = several[at]
    at, owner = number[at[keep]], owner[keep]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    r, c = np.searchsorted(which, rows), np.searchsorted(which, columns)
    out = np.zeros((len(rows), len(columns)), np.float32)
    for start in range(0, int(several.sum()), SHINGLES_AT_ONCE):
        i, j = np.searchsorted(at, (start, start + SHINGLES_AT_ONCE))
        held = np.zeros((len(which), SHINGLES_AT_ONCE), np.float32)
        held[owner[i:j], at[i:j] - start] = 1
        out += held[r] @ held[c].T
    return out.astype(np.int64)


def _hangs_together(percent):
    """Links of a block of sets, or between two blocks, as each set but the first of its group with that first one."""
    least = percent / 100 - SLACK

    def run(rows):
        block = rows["block"].to_numpy()
        one, other = np.flatnonzero(block == block.min()), np.flatnonzero(block == rows["far"][0].as_py())
        registers, ids = _registers(rows["registers"]), rows["id"].to_numpy()
        sets = [np.frombuffer(h, "<u8") for h in rows["hashes"].to_pylist()]
        sizes = np.array([len(x) for x in sets])
        a, b = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for start in range(0, len(one), SETS_AT_ONCE):
            mine = one[start:start + SETS_AT_ONCE]
            agree = (registers[mine][:, None] == registers[other][None]).mean(axis=2)
            chance = expected_collisions(np.repeat(sizes[mine], len(other)).astype(float), np.tile(sizes[other], len(mine)).astype(float))
            chance = chance.reshape(agree.shape)
            i, j = np.nonzero(((agree - chance) / (1 - chance) >= least) & (mine[:, None] != other[None]))
            a.append(mine[i].astype(np.int32))
            b.append(other[j].astype(np.int32))
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            r, c = np.unique(a), np.unique(b)
            shared = common_shingles(sets, r, c)[np.searchsorted(r, a), np.searchsorted(c, b)]
            linked = 100 * shared >= percent * (sizes[a] + sizes[b] - shared)
            a, b = a[linked], b[linked]
        lots = [_lowest(ids[a[i:i + LINKS_AT_ONCE]], ids[b[i:i + LINKS_AT_ONCE]]) for i in range(0, max(1, len(a)), LINKS_AT_ONCE)]
        together = pa.Table.from_batches(lots)
        return pa.Table.from_batches([_lowest(together["v"].to_numpy(), together["p"].to_numpy())])
    return run


def near_duplicates(docs, n_words=SHINGLE, percent=PERCENT):
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (it is that one).

    A document's set holds its different shingles of `n_words` words, A-Z in lower case, words split at ASCII blanks; fewer
    words are one shingle. Documents link when `percent` of the shingles of both together are in both. Equal sets are
    one item whatever their number; other pairs that agree in one of 25 bands of five registers and whose estimate
    is not too low are compared by their full sets. Pairs at exactly the least share meet in a band all but once in 2 million.

    A null text, or one without words, has an empty set and links with nothing: its component is its own doc_id. Repeated rows
    and ids give a row each. A null doc_id keeps its row and names a group only if no member has an id; it then counts as kept.
    Texts are read whole; other columns are not read. An empty table gives no rows. Shingles and sets are told apart by 64-bit hashes.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = texts.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    spark = docs.sparkSession
    # registers are most of what these tables hold; they are deleted as soon as the band keys are made
    wide = stored_table(keyed.mapInArrow(_sketched(n_words), "doc_id long, text_key long, id long, size long, registers binary"))
    wide_sets = stored_table(spark.read.parquet(wide).where("id IS NOT NULL").groupBy("id").agg(
        F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"), F.max("size").alias("size"), F.max("registers").alias("registers")))
    prints = stored(spark.read.parquet(wide).select("doc_id", "id", "size"))
    dropped(spark, wide)
    items = spark.read.parquet(wide_sets).select("id", F.col("size").alias("fp"), F.lit(1).cast("long").alias("n"), "registers")
    banded = stored(_members(items, _N_BANDS, _band_keys).select("key", "id", F.col("fp").alias("size")))
    sets = stored(spark.read.parquet(wide_sets).select("id", "first_id", "text_key"))
    dropped(spark, wide_sets)
    groups = components(_links(keyed, sets, banded, n_words, percent))
    named = sets.select("id", "first_id").join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").select("id", "component_id")
    component = F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return prints.join(named, "id", "left").select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links(keyed, sets, banded, n_words, percent):
    """Pairs (a, b) of sets of one group, enough to connect all sets that link, from the sets under each band key."""
    # near copies share many bands: of bands with the same sets one is enough
    same = banded.groupBy("key").agg(F.count("*").alias("m"), F.sum("size").alias("hashes"), F.bit_xor(F.xxhash64("id")).alias("x"),
                                     F.sum(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 32))).alias("s"))
    blocks = F.greatest(F.ceil(F.col("m") / F.lit(BLOCK_SETS)), F.ceil(F.col("hashes") / F.lit(BLOCK_HASHES))).cast("int")
    chosen = same.where("m > 1").groupBy("m", "hashes", "x", "s").agg(F.min("key").alias("key")).select("key", blocks.alias("blocks"))
    dealt = stored(banded.join(chosen, "key").select("key", "id", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")))
    wanted = stored(dealt.select("id").distinct().join(sets.select("id", "text_key"), "id").select("text_key").distinct())
    # most texts are not wanted and stay where they are: the tasks get the residues of the wanted keys, of which there are
    # at most FILTER_SIZE however many documents there are; the join after it decides
    residue = F.pmod("text_key", F.lit(FILTER_SIZE)).alias("_residue")
    maybe = keyed.withColumn("_residue", residue).join(F.broadcast(wanted.select(residue).distinct()), "_residue", "left_semi")
    full = stored(maybe.select("text_key", "text").join(wanted, "text_key").groupBy("text_key").agg(F.first("text").alias("text"))
                  .select("text").mapInArrow(_full_sets(n_words), "id long, registers binary, hashes binary"))
    met = dealt.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("key", "id", "block", F.least("block", "_with").alias("near"), F.greatest("block", "_with").alias("far"))
    # stored, as one task would otherwise hold two Python workers, this step's and that of what reads the links
    links = stored(met.join(full, "id").groupBy("key", "near", "far").applyInArrow(_hangs_together(percent), "v long, p long"))
    return links.select(F.col("v").alias("a"), F.col("p").alias("b"))


def op12_hyperminhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


_WORD = r"[^\x20\x09-\x0D]+"
OP12_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) END) AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= {PERCENT} * (min(a.n) + min(b.n) - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS node, doc_id AS reached FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON doc_id = node"""
