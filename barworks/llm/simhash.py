"""Near-duplicate documents by SimHash: fingerprints, pigeonhole blocks, Hamming distance, connected groups."""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from barworks.llm.common import hamming, keyed_groups, near_groups, numbered, stored, table
from barworks.llm.words import mixed
from barworks.session import settle

SHINGLE = 4
MAX_DIFF = 4
N_BLOCKS = 7
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
KEEP_SHINGLE = 5  # words, for `keep_one`
SIMILARITY = 0.8  # share of common shingles, for `keep_one`
BITS = 512  # of a fingerprint for `keep_one`
RADIUS = 116  # differing bits that `keep_one` still compares: 4.7 standard deviations over what the least share leads to
MISSED = 0.001  # share of the pairs with just the least share of shingles that agree in no choice of bits, at any number of texts
SPARE_BITS = 6  # bits of a choice beyond those that number the texts: a text meets an unlike one in about one choice of 2**6
MOST_BITS = 32
PAIRS_PER_COPY = 256
KEY_TURNS, CHOICES_PER_TURN = 4, 80  # shares of the choices of bits whose keys are shuffled at a time, at least so many, and their size at most
_WORDS = [f"w{i}" for i in range(BITS // 64)]
# 8 bytes each: a shingle's places on 256 random axes
_AXES = np.random.default_rng(5).integers(0, 1 << 63, BITS // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = _AXES[:BITS // 64]
_LOT = 1 << 12  # shingles whose places are added up at a time
_STEP = 1 << 18  # shingles hashed before their bits are added up


def fingerprint(text, words_per_shingle=SHINGLE):
    """64-bit SimHash of a text as a signed long; 0 for a text without words."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    joined = b" ".join(words)
    n = max(1, len(words) - words_per_shingle + 1)
    first, last = starts[:n].tolist(), (ends[len(words) - n:] - 1).tolist()
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        hashes = np.array([digest(joined[s:e], 42) for s, e in zip(first[at:at + _STEP], last[at:at + _STEP])], "<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches):
    for batch in batches:
        rows = batch.column(1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([fingerprint(x.as_py()) for x in rows], pa.int64())], ["doc_id", "fp"])


def near_duplicates(docs, max_diff=MAX_DIFF, n_blocks=N_BLOCKS):
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Documents link when their fingerprints differ in at most `max_diff` bits. Fingerprints are first made distinct, so
    a group of equal copies costs one row whatever its size; `near_groups` then links distinct ones.
    A null or blank text has fingerprint 0 and links like any other. Repeated rows and ids give a row each. A null doc_id
    keeps its row, and never becomes a component_id unless the whole group has no id. Other columns are not read. An
    empty table gives no rows. Larger corpora may take more blocks: keys grow more selective, rows per document more.
    """
    prints = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                    .mapInArrow(_fingerprints, "doc_id long, fp long"))
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")))
    items = distinct.select(F.col("fp").alias("id"), "fp", "n")
    groups = near_groups(items, max_diff, n_blocks)
    named = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingles(text, words_per_shingle):
    """Hashes of the different runs of words of a text, in order; none for a text without words."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - words_per_shingle + 1)
    digest = xxhash.xxh64_intdigest
    single = np.fromiter((digest(w, 42) for w in words), np.uint64, len(words))
    out = single[:n].copy()
    for i in range(1, min(words_per_shingle, len(words))):
        out = mixed(out * np.uint64(0x100000001B3) + single[i:i + n])
    return np.unique(mixed(out))


def wide_fingerprint(found):
    """SimHash of a set of shingles with BITS bits, as longs: on which side of so many random planes the sum of the shingles lies.

    A shingle has a byte from -128 to 127 per plane instead of a sign, so that sets of a few shingles, whose signs would often
    cancel out, differ in as many bits as large ones: two sets in about acos(cosine) / pi of them.
    """
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(found), _LOT):
        places = mixed(found[at:at + _LOT, None] * _AXES).view(np.int8)
        total += places.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * total + len(found) > 0, bitorder="little").view("<i8")  # a byte is -1/2 on average


def _wide_fingerprints(words_per_shingle):
    """Row, doc_id, hash of the shingles (0 for none), and their fingerprint."""
    def run(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, len(_WORDS)), np.int64)
            ids = np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column(2)):
                found = shingles(text.as_py(), words_per_shingle)
                if len(found):
                    ids[i] = xxhash.xxh64_intdigest(found.astype("<u8").tobytes()) - (1 << 63)
                    out[i] = wide_fingerprint(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids), *map(pa.array, out.T)],
                                             ["_row", "doc_id", "id", *_WORDS])
    return run


def _n_choices(n_bits, differ):
    """How many choices of `n_bits` it takes until only MISSED of the pairs whose bits differ with the share `differ` agree in none.

    Pairs differ in more bits or fewer than on average, and those that differ in more are most of the missed ones.
    """
    if not differ:
        return 1
    bits = np.arange(BITS + 1)
    logs = np.concatenate(([0], np.cumsum(np.log(np.arange(1, BITS + 1)))))
    share = np.exp(logs[BITS] - logs - logs[::-1] + bits * math.log(differ) + (BITS - bits) * math.log1p(-differ))
    other = 1 - np.prod(np.maximum(0, 1 - bits[:, None] / (BITS - np.arange(n_bits))), axis=1)  # a choice has one of the bits that differ
    low, high = 0, 1
    while share @ other ** high > MISSED:
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if share @ other ** middle > MISSED else (low, middle)
    return high


def bit_choices(count, similarity):
    """Masks of the bits that must agree, a row per choice, for `count` fingerprints.

    Sets that share `similarity` of their shingles have a cosine of 2s / (1 + s) if they are of one size, at least, so a bit
    agrees with the share 1 - acos / pi. A choice takes so many bits that unlike texts seldom agree, and there are so many
    choices that like ones agree in one of them.
    """
    differ = math.acos(min(1, 2 * similarity / (1 + similarity))) / math.pi
    n_bits = min(MOST_BITS, max(1, count).bit_length() + SPARE_BITS)
    masks = np.zeros((_n_choices(n_bits, differ), BITS), np.uint8)
    for i, mask in enumerate(masks):
        mask[np.random.default_rng(i).choice(BITS, n_bits, replace=False)] = 1
    return np.packbits(masks, axis=1, bitorder="little").view("<u8")


def _bit_keys(masks, first=0):
    """A row of keys per choice of bits; `first` is the number of the first one."""
    def keys(rows):
        words = [rows[c].to_numpy().view(np.uint64) for c in _WORDS]
        out = np.empty((len(masks), len(rows)), np.uint64)
        for i, mask in enumerate(masks):
            key = np.full(len(rows), first + i + 1, np.uint64)
            for word, m, factor in zip(words, mask, _FOLD):
                key = (key ^ (word & m)) * factor
                key ^= key >> np.uint64(32)
            out[i] = mixed(key)
        return out
    return keys


def _alike(words_per_shingle, similarity):
    """Keeps the pairs whose texts have a share of common shingles of at least `similarity`."""
    def run(batches):
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = shingles(x, words_per_shingle), shingles(y, words_per_shingle)
                common = len(np.intersect1d(x, y, assume_unique=True))
                near.append(common >= similarity * (len(x) + len(y) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(near, pa.bool_()))
    return run


def _with_texts(pairs, texts):
    """Pairs (a, b) with both texts; a text that many pairs ask for stands once per PAIRS_PER_COPY of them."""
    for c in "ab":
        asked = pairs.groupBy(c).agg(F.ceil(F.count("*") / F.lit(PAIRS_PER_COPY)).cast("int").alias("_copies"))
        copies = (asked.join(texts.select(F.col("id").alias(c), F.col("text").alias(f"t{c}")), c)
                  .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies"))
        dealt = pairs.join(asked, c).withColumn("_copy", F.pmod(F.xxhash64("a", "b"), F.col("_copies")).cast("int")).drop("_copies")
        pairs = dealt.join(copies, [c, "_copy"]).drop("_copy")
    return pairs


def keep_one(docs, words_per_shingle=KEEP_SHINGLE, similarity=SIMILARITY):
    """The documents without their near duplicates: of each group the row of the smallest doc_id stays.

    Candidates are texts whose SimHash fingerprints (of the different shingles of `words_per_shingle` words, 512 bits) agree in
    one of the choices of bits and differ in at most RADIUS of all. They link when the share of common shingles (Jaccard, of
    different ones) reaches `similarity`. Texts without words link with each other. Words are split at blanks, ASCII letters in
    lower case. Of repeated rows with that id the first one stored stays; if a group has no id at all, its first row. All
    columns of `docs` are kept.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]  # no column of the documents can clash
    at = {c.lower(): n for c, n in zip(docs.columns, names)}
    own = stored(numbered(docs.toDF(*names)))
    rows = own.select("_row", F.col(at["doc_id"]).cast("long").alias("doc_id"), F.col(at["text"]).cast("string").alias("text"))
    schema = ", ".join(f"{c} long" for c in ("_row", "doc_id", "id", *_WORDS))
    prints = rows.mapInArrow(_wide_fingerprints(words_per_shingle), schema)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")).alias("best")
    distinct = settle(prints.groupBy("id").agg(best, *[F.max(c).alias(c) for c in _WORDS], F.count("*").alias("n")))

    def verify(pairs):
        pairs = settle(pairs)
        wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        places = distinct.join(wanted, "id").select("id", F.col("best._row").alias("_row"))
        texts = settle(rows.select("_row", "text").join(places, "_row").select("id", "text"))
        return _with_texts(pairs, texts).select("a", "b", "ta", "tb").mapInArrow(_alike(words_per_shingle, similarity), "a long, b long")

    items = distinct.where("id <> 0").select("id", F.struct(*_WORDS).alias("fp"), "n", *_WORDS)
    differing = sum(hamming(F.col(f"fp.{c}"), F.col(f"fp2.{c}")) for c in _WORDS)
    masks = bit_choices(items.count(), similarity)
    keys, each = _bit_keys(masks), min(CHOICES_PER_TURN, -(-len(masks) // KEY_TURNS))
    keys.turns = [_bit_keys(masks[i:i + each], i) for i in range(0, len(masks), each)]
    groups = keyed_groups(items, len(masks), keys, differing <= RADIUS, verify)
    kept = (distinct.join(groups.withColumnRenamed("node", "id"), "id", "left")
            .groupBy(F.coalesce("component", "id").alias("component")).agg(F.min("best").alias("best"))
            .select(F.col("best._row").alias("_row")))
    return own.join(kept, "_row", "left_semi").drop("_row").toDF(*docs.columns)


def op1_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
