"""Ranked lexical search: MaxScore over blocks of documents, with bounds of term pairs that are tighter than those of terms.

Documents are cut into blocks. For each block the index holds the postings of the terms that are asked for, each with its
highest impact, and for every pair of neighbouring terms of an item the list of documents that hold both, with their
highest joint impact. A pair adds to a document of that list at most the joint impact and to any other at most the
higher of the two single ones, where independent maxima would add both.
"""

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.llm.common import numbered, stored, table

TOP = 20
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 60_000  # places in a block are 16-bit numbers
PIECE = 1 << 20  # bytes of a text that are cut into terms at a time
ITEM_TERMS = 200_000  # terms of the items that meet a block at a time
SALTS = 16

# Fixed value: what a term is; only the signs A-Z have another case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SIGNS = bytes(b if b > 127 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 32
               for b in range(256))

_RAW = "block long, term string, docs long, words long, at binary, n binary, ids array<long>"
_INDEX = "block long, items int, a int, b int, best long, at binary, n binary, ids array<long>"


def _terms(text):
    """The terms of a text as bytes, in pieces."""
    data = (text or "").encode("utf-8", "replace").translate(_SIGNS)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _binary(values, starts):
    """One binary value for each run of `values` between two of the `starts`."""
    offsets = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _block_rows(block, ids, found, lengths, terms):
    """Rows of a block: one of its documents, under a name that no term can have, and one per term."""
    keys, tf = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)
    term, at = keys >> 32, (keys & 0xFFFFFFFF).astype("<u2")
    starts = np.append(np.flatnonzero(np.diff(term, prepend=-1)), len(term))
    n, lengths = len(starts) - 1, np.array(lengths, "<u4")
    own = [pa.array([block]), pa.array([f"#{block}"]), pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum(dtype=np.int64))]),
           pa.array([lengths.tobytes()], pa.binary()), pa.array([b""], pa.binary()), pa.array([ids], pa.list_(pa.int64()))]
    names = ["block", "term", "docs", "words", "at", "n", "ids"]
    yield pa.RecordBatch.from_arrays(own, names)
    listed = list(terms)
    rows = pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, block)), pa.array([listed[i].decode("utf-8", "replace") for i in term[starts[:-1]]], pa.string()),
         pa.array(np.diff(starts)), pa.array(np.zeros(n, np.int64)), _binary(at, starts), _binary(tf.astype("<u4"), starts),
         pa.nulls(n, pa.list_(pa.int64()))], names)
    for i in range(0, n, 10_000):
        yield rows.slice(i, 10_000)


def _blocks(batches):
    """Blocks of the documents of a task, with all their terms."""
    number, size = count(TaskContext.get().partitionId() << 24), 0
    ids, found, lengths, terms = [], [], [], defaultdict(count().__next__)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            at, length = len(ids), 0
            for piece in _terms(text):
                own = np.fromiter(map(terms.__getitem__, piece), np.int64, len(piece))
                found.append(own << 32 | at)
                length += len(piece)
            ids.append(doc_id)
            lengths.append(length)
            size += len(text or "")
            if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                yield from _block_rows(next(number), ids, found, lengths, terms)
                ids, found, lengths, terms, size = [], [], [], defaultdict(count().__next__), 0
    if ids:
        yield from _block_rows(next(number), ids, found, lengths, terms)


def _packed(rows):
    """Items that go together, as bytes: their terms in order."""
    out = pa.BufferOutputStream()
    rows = rows.sort_by([("q", "ascending"), ("pos", "ascending")]).select(["q", "term", "w", "least"])
    with pa.ipc.new_stream(out, rows.schema) as stream:
        stream.write_table(rows)
    return out.getvalue().to_pybytes()


class _Items:
    """Unpacked items: numbered terms with weights; for each item its terms, how often, and its pairs of terms."""

    def __init__(self, data):
        rows = pa.ipc.open_stream(data).read_all().to_pydict()
        self.names, self.weight, self.items, self.least = {}, [], [], []
        last, pairs = None, {}
        for q, term, w, least in zip(rows["q"], rows["term"], rows["w"], rows["least"]):
            t = self.names.setdefault(term, len(self.names))
            if t == len(self.weight):
                self.weight.append(w)
            if q != last:
                self.items.append((q, {}))
                self.least.append(least)
                last = q
            self.items[-1][1][t] = self.items[-1][1].get(t, 0) + 1
        # neighbours in pairs: first and second, third and fourth; a term that comes again makes no new pair
        self.units = []
        for _, times in self.items:
            terms = list(times)
            units = [tuple(sorted(terms[i:i + 2])) for i in range(0, len(terms), 2)]
            self.units.append(units)
            pairs.update(dict.fromkeys(u for u in units if len(u) == 2))
        self.pairs = list(pairs)


def _lists(rows):
    """Places and values of each list of a block, by number of the term or pair."""
    for a, b, best, at, n in zip(*(rows[c].to_pylist() for c in ("a", "b", "best", "at", "n"))):
        yield a, b, best, np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(n, "<u4").astype(np.int64)


def _middle(lengths, n_docs, n_words):
    """12 m of each document, from its length."""
    return 12 * (75 + 25 * lengths.astype(np.int64) * n_docs // n_words)


def _impact(w, tf, m12):
    return w * (1_000_000_000 * tf // (1000 * tf + m12))


def _indexer(n_docs, n_words):
    """Postings and pair lists of a block for some items."""
    def run(key, rows, asked):
        block, part = (k.as_py() for k in key)
        if not asked.num_rows:
            return pa.table([pa.array([], t) for t in _ARROW_INDEX.types], schema=_ARROW_INDEX)
        items = _Items(asked["data"][0].as_py())
        out, known, own = [], {}, None
        for term, at, n, ids in zip(*(rows[c].to_pylist() for c in ("term", "at", "n", "ids"))):
            if term.startswith("#"):
                own = np.frombuffer(at, "<u4")
                out.append((block, part, -1, -1, 0, at, b"", ids))
            elif term in items.names:
                known[items.names[term]] = at, n
        m12, impacts = _middle(own, n_docs, n_words), {}
        for t, (at, n) in known.items():
            places = np.frombuffer(at, "<u2").astype(np.int64)
            impacts[t] = places, _impact(items.weight[t], np.frombuffer(n, "<u4").astype(np.int64), m12[places])
            out.append((block, part, t, -1, int(impacts[t][1].max()), at, n, None))
        for a, b in items.pairs:
            if a in impacts and b in impacts:
                both, i, j = np.intersect1d(impacts[a][0], impacts[b][0], assume_unique=True, return_indices=True)
                if len(both):
                    out.append((block, part, a, b, int((impacts[a][1][i] + impacts[b][1][j]).max()), both.astype("<u2").tobytes(), b"", None))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), _ARROW_INDEX.types)], schema=_ARROW_INDEX)
    return run


_ARROW_INDEX = pa.schema([("block", pa.int64()), ("items", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("best", pa.int64()),
                          ("at", pa.binary()), ("n", pa.binary()), ("ids", pa.list_(pa.int64()))])


class _Block:
    """The lists of a block, and the search for one item in it."""

    def __init__(self, rows, items, n_docs, n_words, top):
        self.weight, self.top, self.postings, self.best, self.pairs, self.impacts = items.weight, top, {}, {}, {}, {}
        for a, b, best, at, n in _lists(rows.filter(pc.greater_equal(rows["a"], 0))):
            if b >= 0:
                self.pairs[a, b] = at, best
            else:
                self.postings[a], self.best[a] = (at, n), best
        own = rows.filter(pc.less(rows["a"], 0))
        self.ids = own["ids"][0].as_py()
        self.m12 = _middle(np.frombuffer(own["at"][0].as_py(), "<u4"), n_docs, n_words)

    def scores(self, t):
        """Places and impacts of a term, computed when first asked for."""
        if t not in self.impacts:
            at, tf = self.postings[t]
            self.impacts[t] = at, _impact(self.weight[t], tf, self.m12[at])
        return self.impacts[t]

    def unit_bounds(self, unit, times):
        """What a unit adds at most outside its pair list, and inside: (single, joint, places of the list)."""
        there = [t for t in unit if t in self.best]
        if not there:
            return None
        single = max(self.best[t] * times[t] for t in there)
        at, joint = self.pairs.get(unit, (None, 0))
        if at is None:
            return there, single, single, None
        # a term that the item repeats counts as often on its side of the pair
        extra = sum((times[t] - 1) * self.best[t] for t in there)
        return there, single, max(single, joint + extra), at

    def search(self, units, times, least):
        """Places and scores of the documents that may be among the best: all that reach `least` or the block's own k-th score."""
        bounds = [b for b in (self.unit_bounds(u, times) for u in units) if b]
        bounds.sort(key=lambda b: b[2])
        most = np.cumsum([b[2] for b in bounds]) if bounds else np.zeros(0, np.int64)
        least = max(least, 1)
        first = int(np.searchsorted(most, least))  # units before this one cannot lift a document to `least` alone
        if first == len(bounds):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        score = np.zeros(len(self.ids), np.int64)
        for there, *_ in bounds[first:]:
            for t in there:
                at, impact = self.scores(t)
                score[at] += impact * times[t]
        rest = np.zeros(len(self.ids), np.int64)  # what the other units can add to each document
        for _, single, joint, both in bounds[:first]:
            rest += single
            if both is not None:
                rest[both] += joint - single
        if len(score) > self.top:
            least = max(least, int(np.partition(score, -self.top)[-self.top]))
        places = np.flatnonzero((score > 0) & (score + rest >= least))
        score, rest = score[places], rest[places]
        for there, single, joint, both in reversed(bounds[:first]):
            if not len(places):
                break
            rest -= single
            if both is not None:
                rest[_within(places, both)[0]] -= joint - single
            for t in there:
                at, impact = self.scores(t)
                mine, theirs = _within(places, at)
                score[mine] += impact[theirs] * times[t]
            if len(score) > self.top:
                least = max(least, int(np.partition(score, -self.top)[-self.top]))
            stay = score + rest >= least
            places, score, rest = places[stay], score[stay], rest[stay]
        return places, score


def _within(places, listed):
    """Where the places stand that are in a list, and where in the list; both ascend."""
    at = np.minimum(np.searchsorted(listed, places), len(listed) - 1)
    mine = np.flatnonzero(listed[at] == places)
    return mine, at[mine]


def _searcher(n_docs, n_words, top):
    """The documents of a block that may be among the best of each item: (q, doc_id, score)."""
    def run(rows, asked):
        qs, ids, scores = [], [], []
        if rows.num_rows and asked.num_rows:
            items = _Items(asked["data"][0].as_py())
            block = _Block(rows, items, n_docs, n_words, top)
            for (q, times), units, least in zip(items.items, items.units, items.least):
                places, score = block.search(units, times, least)
                found = [block.ids[p] for p in places.tolist()]
                best = sorted(zip((-score).tolist(), [i is None for i in found], [i or 0 for i in found]))[:top]
                qs += [q] * len(best)
                ids += [None if missing else i for _, missing, i in best]
                scores += [-s for s, _, _ in best]
        return pa.table([pa.array(qs, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], ["q", "doc_id", "score"])
    return run


def search(self, units, times, least):
        """Places and scores of the documents that may be among the best: all that reach `least` or the block's own k-th score."""
        bounds = [b for b in (self.unit_bounds(u, times) for u in units) if b]
        bounds.sort(key=lambda b: b[2])
        most = np.cumsum([b[2] for b in bounds]) if bounds else np.zeros(0, np.int64)
        least = max(least, 1)
        first = int(np.searchsorted(most, least))  # units before this one cannot lift a document to `least` alone
        if first == len(bounds):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        score = np.zeros(len(self.ids), np.int64)
        for there, *_ in bounds[first:]:
            for t in there:
                at, impact = self.scores(t)
                score[at] += impact * times[t]
        rest = np.zeros(len(self.ids), np.int64)  # what the other units can add to each document
        for _, single, joint, both in bounds[:first]:
            rest += single
            if both is not None:
                rest[both] += joint - single
        if len(score) > self.top:
            least = max(least, int(np.partition(score, -self.top)[-self.top]))
        places = np.flatnonzero((score > 0) & (score + rest >= least))
        score, rest = score[places], rest[places]
        for there, single, joint, both in reversed(bounds[:first]):
            if not len(places):
                break
            rest -= single
            if both is not None:
                rest[_within(places, both)[0]] -= joint - single
            for t in there:
                at, impact = self.scores(t)
                mine, theirs = _within(places, at)
                score[mine] += impact[theirs] * times[t]
            if len(score) > self.top:
                least = max(least, int(np.partition(score, -self.top)[-self.top]))
            stay = score + rest >= least
            places, score, rest = places[stay], score[stay], rest[stay]
        return places, score


def _within(places, listed):
    """Where the places stand that are in a list, and where in the list; both ascend."""
    at = np.minimum(np.searchsorted(listed, places), len(listed) - 1)
    mine = np.flatnonzero(listed[at] == places)
    return mine, at[mine]


def _searcher(n_docs, n_words, top):
    """The documents of a block that may be among the best of each item: (q, doc_id, score)."""
    def run(rows, asked):
        qs, ids, scores = [], [], []
        if rows.num_rows and asked.num_rows:
            items = _Items(asked["data"][0].as_py())
            block = _Block(rows, items, n_docs, n_words, top)
            for (q, times), units, least in zip(items.items, items.units, items.least):
                places, score = block.search(units, times, least)
                found = [block.ids[p] for p in places.tolist()]
                best = sorted(zip((-score).tolist(), [i is None for i in found], [i or 0 for i in found]))[:top]
                qs += [q] * len(best)
                ids += [None if missing else i for _, missing, i in best]
                scores += [-s for s, _, _ in best]
        return pa.table([pa.array(qs, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], ["q", "doc_id", "score"])
    return run


def _by_block(terms, blocks):
    """Items as one row of packed terms per lot, for every block."""
    packed = terms.groupBy("items").applyInArrow(
        lambda key, rows: pa.table([pa.array([key[0].as_py()], pa.int32()), *_packed(rows)], ["items", "data"]), "items int, data binary")
    return packed, packed.join(F.broadcast(blocks), "items") if blocks is not None else packed


def search(docs, items, top=TOP):
    """The `top` documents of highest score for each item: item_id, rank (from 1), doc_id, score.

    Terms are the maximal runs of letters, digits and signs beyond ASCII, A-Z in lower case. A term weighs
    floor(1000 ln((2N + 2) / (2 df + 1))), N counting the documents with a term; a document adds for each term of the item,
    repeats included, its weight times (10^9 tf) div (1000 tf + 12 m), m = 75 + (25 n N) div L. Equal scores rank by doc_id.

    `docs` has doc_id and text, `items` item_id and text; other columns are not read. A null or empty text has no terms: such
    a document is never found, such an item finds nothing. A null doc_id is kept and ranks last among equal scores; a null
    item_id gives rows of its own. Repeated rows count and rank each by itself; every row of items is an item. Texts are
    read whole. Empty tables give no rows. A block's search skips what cannot reach the `top`-th highest of a pair's joint
    impacts over all blocks, which is a score that so many documents reach.
    """
    spark = docs.sparkSession
    own = stored(numbered(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")), "q"))
    words = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    asked = stored(own.select("q", F.posexplode(words).alias("pos", "term")))
    wanted = stored(asked.select("term").distinct().withColumn("hit", F.lit(True)))
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_blocks, _RAW)
    raw = stored(raw.join(wanted, "term", "left").where("hit OR startswith(term, '#')").drop("hit"))
    is_term = ~F.startswith("term", F.lit("#"))
    n_docs, n_words, n_blocks = raw.where(~is_term).agg(F.sum("docs"), F.sum("words"), F.count("*")).first()
    n_asked = asked.count()
    if not n_docs or not n_asked:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    weights = (raw.where(is_term).groupBy("term").agg(F.sum("docs").alias("df"))
               .select("term", F.floor(1000 * F.log((2.0 * F.lit(n_docs) + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("w")))
    lots = -(-n_asked // ITEM_TERMS)
    terms = stored(asked.join(weights, "term").select(
        "q", "pos", "term", "w", F.lit(0).cast("long").alias("least"), F.pmod(F.xxhash64("q"), F.lit(lots)).cast("int").alias("items")))
    every = F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("items")
    blocks = stored(raw.where(~is_term).select("block", every))
    lists = raw.select("*", every)
    index = stored(lists.groupBy("block", "items").cogroup(_dealt(terms, blocks))
                   .applyInArrow(_indexer(n_docs, n_words), _INDEX))

    # the numbers of terms and pairs follow from the terms of a lot alone, so they mean the same in every block
    ranked = index.where("a >= 0").select("items", "a", "b", "best", F.row_number().over(
        Window.partitionBy("items", "a", "b").orderBy(F.desc("best"))).alias("r"))
    reached = ranked.where(F.col("r") == top).select("items", "a", "b", "best")
    least = _least(terms, reached)
    terms = stored(terms.drop("least").join(least, "q", "left").withColumn("least", F.coalesce("least", F.lit(0).cast("long"))))
    found = (index.groupBy("block", "items").cogroup(_dealt(terms, blocks))
             .applyInArrow(_searcher(n_docs, n_words, top), "q long, doc_id long, score long"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(own.select("q", "item_id"), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _dealt(terms, blocks):
    """The items of each lot as one row of packed terms, for every block; copies of the row are dealt over salts."""
    packed = terms.groupBy("items").applyInArrow(
        lambda key, rows: pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([_packed(rows)], pa.binary())], ["items", "data"]),
        "items int, data binary").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = blocks.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int"))
    return salted.join(packed, ["items", "salt"]).drop("salt").groupBy("block", "items")


def _least(terms, reached):
    """The score that enough documents reach for each item: the best of its terms and pairs in the k-th best block."""
    def run(key, rows, known):
        qs, least = [], []
        if rows.num_rows:
            items = _Items(_packed(rows))
            best = dict(zip(zip(known["a"].to_pylist(), known["b"].to_pylist()), known["best"].to_pylist()))
            for (q, times), units in zip(items.items, items.units):
                qs.append(q)
                least.append(max([best.get(u, 0) for u in units] + [best.get((t, -1), 0) * n for t, n in times.items()], default=0))
        return pa.table([pa.array(qs, pa.int64()), pa.array(least, pa.int64())], ["q", "least"])
    return terms.groupBy("items").cogroup(reached.groupBy("items")).applyInArrow(run, "q long, least long")


def op13_ranked(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}') AS t FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}')) AS term FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_words FROM d WHERE len(t) > 0),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * max(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
i AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words))) AS impact
      FROM p JOIN w USING (term), s),
r AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY ALL),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= {TOP}"""
