"""Benchmark decontamination: spaced seeds find hits, the words around a hit decide, tolerant of substitutions."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barworks.llm.common import table
from barworks.llm.words import mixed, packed, words

# Fixed masks: the positions that count of a window of words. For every overlap of 5 to 20 words with up to a fifth of
# them replaced, one of these finds four untouched words at its positions.
MASKS = ((0, 1, 2, 3), (0, 1, 2, 6), (0, 1, 3, 4), (0, 4, 5, 6), (0, 2, 3, 4), (0, 1, 2, 4))
WINDOW = 20  # words of an overlap; a shorter item must be met in all its length
SIMILARITY = 0.8
LEAST_WORDS = 5  # shorter items are no evidence
BLOCK_BYTES = 8 << 20  # benchmark text that is sent to the tasks at a time
LOT_BYTES = 1 << 20  # document text whose words are hashed at a time
_FILTER_BITS = 22


def _seed(hashes, mask, number):
    n = len(hashes) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.full(n, number + 1, np.uint64)
    for offset in mask:
        key = mixed(key * np.uint64(0x100000001B3) + hashes[offset:offset + n])
    return key


class Index:
    """Seeds of benchmark items, sorted, and the words of the items."""

    def __init__(self, items):
        self.ids, self.words, keys, numbers, places = [], [], [], [], []
        for item_id, text in items:
            _, _, hashes = words((text or "").lower().encode("utf-8", "replace"))
            if len(hashes) < LEAST_WORDS:
                continue
            for m, mask in enumerate(MASKS):
                key = _seed(hashes, mask, m)
                keys.append(key)
                numbers.append(np.full(len(key), len(self.ids)))
                places.append(np.arange(len(key)))
            self.ids.append(item_id)
            self.words.append(hashes)
        keys = np.concatenate([np.zeros(0, np.uint64), *keys])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.numbers = np.concatenate([np.zeros(0, np.int64), *numbers])[order]
        self.places = np.concatenate([np.zeros(0, np.int64), *places])[order]
        self.some = np.zeros(1 << _FILTER_BITS, bool)
        self.some[keys >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, hashes):
        """Each (item, offset of the item's first word among `hashes`) that shares a seed, once."""
        found = set()
        for m, mask in enumerate(MASKS):
            key = _seed(hashes, mask, m)
            at = np.flatnonzero(self.some[key >> np.uint64(64 - _FILTER_BITS)])
            low, high = (np.searchsorted(self.keys, key[at], side) for side in ("left", "right"))
            for p, a, b in zip(at[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                found.update(zip(self.numbers[a:b].tolist(), (p - self.places[a:b]).tolist()))
        return found

    def overlaps(self, hashes):
        """The best verified overlap with each item: {item number: (similarity, first word, words compared)}."""
        best = {}
        for number, offset in sorted(self.hits(hashes)):
            item = self.words[number]
            start, end = max(0, offset), min(len(hashes), offset + len(item))
            width = min(WINDOW, len(item))
            if end - start < width:
                continue
            same = np.concatenate(([0], np.cumsum(hashes[start:end] == item[start - offset:end - offset])))
            runs = same[width:] - same[:-width]
            place = int(np.argmax(runs))
            share = int(runs[place]) / width
            if share >= SIMILARITY and (number not in best or share > best[number][0]):
                best[number] = (share, start + place, width)
        return best


def _by_text(index, texts):
    """Overlaps of each text, words hashed for many texts at a time."""
    for numbers, lot in packed(texts, LOT_BYTES):
        starts, _, hashes = words(b"\n".join(lot))
        bounds = np.cumsum([0] + [len(x) + 1 for x in lot])
        at = np.searchsorted(starts, bounds)
        suspects = _suspects(index, hashes, at)  # one pass over the lot tells which texts need a closer look
        for i in range(len(lot)):
            yield numbers[i], index.overlaps(hashes[at[i]:at[i + 1]]) if suspects[i] else {}


def _suspects(index, hashes, at):
    """Which texts of a lot hold a seed of the index."""
    marked = np.zeros(len(hashes) + 1, np.int64)
    for m, mask in enumerate(MASKS):
        key = _seed(hashes, mask, m)
        near = np.flatnonzero(index.some[key >> np.uint64(64 - _FILTER_BITS)])
        if len(near) and len(index.keys):
            place = np.minimum(np.searchsorted(index.keys, key[near]), len(index.keys) - 1)
            marked[near[index.keys[place] == key[near]] + 1] = 1
    sums = np.cumsum(marked)
    return sums[at[1:]] > sums[at[:-1]]


def _indexes(spark, benchmark):
    """The benchmark in blocks of bounded size, each sent to the tasks on its own."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-size // BLOCK_BYTES))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield spark.sparkContext.broadcast(Index(sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r))))


def overlaps(docs, benchmark):
    """One row per document and benchmark item that overlap: doc_id, item_id, similarity, first_word, n_words.

    Words are runs of letters and digits in lower case. Spaced seeds of both sides are joined; around each hit, on its
    diagonal, the best window of WINDOW words (the whole item, if shorter) must agree in SIMILARITY of its words.
    The best window of an item is reported. Items with fewer than LEAST_WORDS words match nothing, nor do null or empty
    texts. Repeated documents give rows each; null ids are kept; equal items with several ids are all reported. Other
    columns are not read. Empty tables give no rows. Documents stay where they are: the benchmark goes to them in blocks
    of bounded size, whatever its own size.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for index in _indexes(docs.sparkSession, benchmark):
        def run(batches, index=index):
            for batch in batches:
                ids, out = batch.column(0), []
                for i, hits in _by_text(index.value, (t.as_py() for t in batch.column(1))):
                    out += [(ids[i].as_py(), index.value.ids[n], *hit) for n, hit in hits.items()]
                columns = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words"])
        part = texts.mapInArrow(run, "doc_id long, item_id long, similarity double, first_word long, n_words long")
        found = part if found is None else found.union(part)
    return found


def keep_clean(docs, benchmark):
    """The documents, all columns, that overlap with no benchmark item; see `overlaps`."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # no column of the documents can clash
    text = F.col(names[docs.columns.index("text")]).cast("string").alias("_text")
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema))
    out = docs.toDF(*names)
    for index in _indexes(docs.sparkSession, benchmark):
        def run(batches, index=index):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for i, hits in _by_text(index.value, (t.as_py() for t in batch.column(len(names)))):
                    clean[i] = not hits
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1]).filter(pa.array(clean))
        out = out.select(*names, text).mapInArrow(run, schema)
    return out.toDF(*docs.columns)


def op3_decontaminate(spark, sf_dir):
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
