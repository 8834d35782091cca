"""Repeated passages by prefix-free parsing: triggers cut texts into phrases, and only phrases that recur are compared.

A trigger is the 26-byte string of least rolling hash among those inside a judged 50-byte string, so it depends on that
string alone and equal strings have equal triggers at equal places. Neighbouring strings of one trigger form a phrase,
which reaches from the first byte of the first to the last byte of the last. Every judged string therefore lies whole
in one phrase, and the dictionary of phrases, sorted by the first 50 bytes of their suffixes, puts equal strings side by
side; the order of phrases in the parse is never needed.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barworks.llm.common import numbered, table
from barworks.llm.sharing import PACKED, among, by_bucket, packed, shared, short, unpacked
from barworks.llm.words import _SIGN, mixed, powers

LENGTH = 50  # bytes of a judged string
TRIGGER = 26
STRINGS = LENGTH - TRIGGER + 1  # triggers to choose from, and most strings of a phrase
LOT_BYTES = 1 << 20  # text parsed at a time
BLOCK_BYTES = 4 << 20  # text of a block of rows
BUCKET_BYTES = 4 << 20  # text whose phrases meet in a bucket
_PLACE_BITS = 22
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_NO_ID = 2**63 - 1


class _Parse:
    """Phrases of some bytes; `bounds` are the starts of the texts in them and the end."""

    def __init__(self, data, bounds):
        self.raw = raw = np.frombuffer(data, np.uint8)
        self.first = np.zeros(0, np.int64)
        n = len(raw) - LENGTH + 1
        if n <= 0:
            return
        up, self._down = powers(len(raw) + 1)
        self._sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SIGN[raw] * up[:len(raw)], dtype=np.uint64)))
        places = np.arange(len(raw) - TRIGGER + 1)
        hashes = self.hashes(places, places + TRIGGER)
        least, width = (hashes & ~_PLACE) | places.astype(np.uint64), 1
        while width < STRINGS:  # least of ever wider runs; equal hashes: the first
            step = min(width, STRINGS - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        trigger = (least & _PLACE).astype(np.int64)
        ends = np.asarray(bounds[1:])
        starts = np.arange(n)
        inside = starts + LENGTH <= ends[np.searchsorted(ends, starts, "right")]
        trigger[~inside] = -1
        cut = np.concatenate(([True], trigger[1:] != trigger[:-1]))
        # the text changes only where strings reach over a border, so a run never joins two texts
        first = np.flatnonzero(cut)
        last = np.concatenate((first[1:], [n])) - 1
        whole = trigger[first] >= 0
        self.first, self.last = first[whole], last[whole]
        self.keys = hashes[trigger[self.first]]

    def hashes(self, starts, ends):
        return mixed((self._sums[ends] - self._sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))


def _parsed(texts):
    """Parses of texts in lots: (numbers, bounds, offsets in the texts, parse, whether the text ends). A text longer than a lot
    comes in slices that overlap so that each judged string starts in exactly one."""
    def lot(pieces):
        bounds = np.cumsum([0] + [len(p[1]) for p in pieces])
        return [p[0] for p in pieces], bounds, [p[2] for p in pieces], _Parse(b"".join(p[1] for p in pieces), bounds)

    pieces, size = [], 0
    for i, data in enumerate(texts):
        if len(data) > LOT_BYTES:
            for at in range(0, len(data) - LENGTH + 1, LOT_BYTES):
                yield lot([(i, data[at:at + LOT_BYTES + LENGTH - 1], at)])
            continue
        pieces.append((i, data, 0))
        size += len(data)
        if size >= LOT_BYTES:
            yield lot(pieces)
            pieces, size = [], 0
    if pieces:
        yield lot(pieces)


def _bytes(column):
    return [(t.as_py() or "").encode("utf-8", "replace") for t in column]


def _ids(column):
    return np.array([_NO_ID if d is None else d for d in column.to_pylist()], np.int64)


def _triggers(n_buckets):
    """Per block and bucket one row: the triggers' lower halves, twice those that more than one document of the block has."""
    def send(block, keys, ids):
        if not keys:
            return
        keys, ids = np.concatenate(keys), np.concatenate(ids)
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        other = np.concatenate(([False], ids[1:] != ids[:-1])) & ~new
        runs = np.cumsum(new) - 1
        several = np.zeros(runs[-1] + 1, bool)
        several[runs[other]] = True
        keys = np.concatenate((keys[new], keys[new][several]))
        yield pa.RecordBatch.from_arrays(packed(block, keys, n_buckets), ["bucket", "block", "keys"])

    def run(batches):
        block, keys, ids = None, [], []
        for batch in batches:
            blocks, own = batch.column(0).to_numpy(), _ids(batch.column(1))
            for at in np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1]))).tolist() if len(blocks) else []:
                stop = int(np.searchsorted(blocks[at:], blocks[at], "right")) + at
                if blocks[at] != block:
                    yield from send(block, keys, ids)
                    block, keys, ids = int(blocks[at]), [], []
                for numbers, bounds, _, parse in _parsed(_bytes(batch.column(2)[at:stop])):
                    if len(parse.first):
                        place = np.searchsorted(bounds, parse.first, "right") - 1
                        keys.append(parse.keys)
                        ids.append(own[at:stop][np.array(numbers)[place]])
        yield from send(block, keys, ids)
    return run


def _phrases(n_buckets):
    """Per block and bucket one row: distinct phrases of shared triggers, each with the least id that has it in the block."""
    def run(texts, recurring):
        empty = pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())],
                         ["bucket", "block", "ids", "sizes", "phrases"])
        if not (texts.num_rows and recurring.num_rows):
            return empty
        wanted = unpacked(recurring)
        own = _ids(texts["doc_id"])
        keys, phrase_keys, ids, sizes, data = [], [], [], [], []
        for numbers, bounds, _, parse in _parsed(_bytes(texts["text"])):
            if not len(parse.first):
                continue
            at = np.flatnonzero(among(short(parse.keys, n_buckets), wanted))
            first, ends = parse.first[at], parse.last[at] + LENGTH
            text = np.array(numbers)[np.searchsorted(bounds, first, "right") - 1]
            keys.append(parse.keys[at])
            phrase_keys.append(parse.hashes(first, ends))
            ids.append(own[text])
            sizes.append(ends - first)
            raw = parse.raw.tobytes()
            data += [raw[a:b] for a, b in zip(first.tolist(), ends.tolist())]
        if not data:
            return empty
        keys, phrase_keys, ids, sizes = map(np.concatenate, (keys, phrase_keys, ids, sizes))
        order = np.lexsort((ids, phrase_keys))
        order = order[np.concatenate(([True], phrase_keys[order][1:] != phrase_keys[order][:-1]))]
        keys, ids, sizes = keys[order], ids[order], sizes[order].astype(np.uint8)
        inner, found, starts = by_bucket(keys, n_buckets)
        ids, sizes, order = ids[inner], sizes[inner], order[inner].tolist()
        cuts = list(zip(starts, starts[1:]))
        return pa.table([
            pa.array(found.astype(np.int32)), pa.array(np.full(len(found), texts["block"][0].as_py())),
            pa.array([ids[a:b].astype("<i8").tobytes() for a, b in cuts], pa.binary()),
            pa.array([sizes[a:b].tobytes() for a, b in cuts], pa.binary()),
            pa.array([b"".join([data[i] for i in order[a:b]]) for a, b in cuts], pa.binary())],
            ["bucket", "block", "ids", "sizes", "phrases"])
    return run


def _judge(rows):
    """Sort the judged strings of a bucket's phrases; a string goes where a smaller id has it too.

    Back to each block: phrase hashes, and for each the strings that go as bits.
    """
    data = b"".join(rows["phrases"].to_pylist())
    parse = np.frombuffer(data, np.uint8)
    lots = [np.frombuffer(s, np.uint8) for s in rows["sizes"].to_pylist()]
    sizes = np.concatenate(lots).astype(np.int64)
    ids = np.concatenate([np.frombuffer(i, "<i8") for i in rows["ids"].to_pylist()])
    up, down = powers(len(parse) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_SIGN[parse] * up[:len(parse)], dtype=np.uint64)))
    begins = np.cumsum(sizes) - sizes
    n = sizes - LENGTH + 1
    phrase = np.repeat(np.arange(len(sizes)), n)
    step = np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
    at = begins[phrase] + step
    strings = mixed((sums[at + LENGTH] - sums[at]) * down[at])
    order = np.argsort(strings, kind="stable")
    ranked = strings[order]
    new = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    least = np.minimum.reduceat(ids[phrase[order]], new)
    goes = np.empty(len(order), bool)
    goes[order] = np.repeat(least, np.diff(np.append(new, len(order)))) < ids[phrase[order]]
    bits = np.bitwise_or.reduceat(np.where(goes, np.uint32(1) << step.astype(np.uint32), np.uint32(0)), np.cumsum(n) - n)
    keys = mixed((sums[begins + sizes] - sums[begins]) * down[begins] + sizes.astype(np.uint64))
    cuts = np.cumsum([0] + [len(x) for x in lots])
    return pa.table([rows["block"], pa.array([keys[a:b].astype("<u8").tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                     pa.array([bits[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                    ["block", "keys", "bits"])


def _covered(texts, verdicts):
    """For every text of a block which of its bytes go, as a flag per byte: yields (number, bytes, flags)."""
    data, own = _bytes(texts["text"]), _ids(texts["doc_id"])
    keys = np.concatenate([np.zeros(0, "<u8"), *(np.frombuffer(k, "<u8") for k in verdicts["keys"].to_pylist())])
    bits = np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(b, "<u4") for b in verdicts["bits"].to_pylist())])
    order = np.argsort(keys, kind="stable")
    keys, bits = keys[order], bits[order]
    least = np.full(len(keys), _NO_ID)
    hits = []  # text, first string in the text, number of strings, place of the verdict
    if len(keys):
        for numbers, bounds, offsets, parse in _parsed(data):
            if not len(parse.first):
                continue
            found = parse.hashes(parse.first, parse.last + LENGTH)
            place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            at = np.flatnonzero(keys[place] == found)
            piece = np.searchsorted(bounds, parse.first[at], "right") - 1
            text, place = np.array(numbers)[piece], place[at]
            np.minimum.at(least, place, own[text])
            start = parse.first[at] - bounds[piece] + np.array(offsets)[piece]
            hits.append((text, start, parse.last[at] - parse.first[at] + 1, place))
    text, start, n, place = (np.concatenate(c) for c in zip(*hits)) if hits else [np.zeros(0, np.int64)] * 4
    # the least id of the block was judged; in its other documents all strings of the phrase go
    goes = np.where(own[text] > least[place], np.uint32(0xFFFFFFFF), bits[place])
    text, start, n, goes = (c[goes != 0] for c in (text, start, n, goes))
    order = np.argsort(text, kind="stable")
    text, start, n, goes = (c[order] for c in (text, start, n, goes))
    cuts = np.searchsorted(text, np.arange(len(data) + 1))
    for i, raw in enumerate(data):
        a, b = cuts[i], cuts[i + 1]
        change = np.zeros(len(raw) + 1, np.int32)
        if b > a:
            string = np.repeat(np.arange(a, b), n[a:b])
            step = np.arange(len(string)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])
            marked = goes[string] >> step.astype(np.uint32) & np.uint32(1) == 1
            begin = start[string[marked]] + step[marked]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + LENGTH, -1)
        yield i, raw, np.cumsum(change[:-1]) > 0


def _digest(texts, verdicts):
    out = [[], [], [], []]
    for _, raw, gone in _covered(texts, verdicts):
        edges = np.concatenate(([False], gone))
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        for column, value in zip(out, (len(raw), int(gone.sum()), int((edges[1:] & ~edges[:-1]).sum()),
                                       hashlib.sha256(kept).hexdigest())):
            column.append(value)
    return pa.table([texts["_row"], texts["doc_id"], *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.string())],
                    ["_row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _kept(texts, verdicts):
    rows = [np.frombuffer(raw, np.uint8)[~gone].tobytes() for _, raw, gone in _covered(texts, verdicts)]
    return pa.table([texts["_row"], texts["doc_id"], pa.array(rows, pa.binary())], ["_row", "doc_id", "kept"])


def _judged(docs, finish, schema):
    texts = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    rows = max(1, BLOCK_BYTES * size.n // max(size.b, 1))  # rows that hold about a block's bytes
    n_buckets = max(1, -(-size.b // BUCKET_BYTES))
    texts = texts.select("_row", "doc_id", "text", F.shiftright("_row", rows.bit_length() - 1).alias("block"))
    recurring = (texts.select("block", "doc_id", "text").mapInArrow(_triggers(n_buckets), PACKED)
                 .groupBy("bucket").applyInArrow(shared, PACKED))
    phrases = (texts.groupBy("block").cogroup(recurring.groupBy("block"))
               .applyInArrow(_phrases(n_buckets), "bucket int, block long, ids binary, sizes binary, phrases binary"))
    verdicts = phrases.groupBy("bucket").applyInArrow(_judge, "block long, keys binary, bits binary")
    return texts.groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(finish, schema)


def remove_repeats(docs):
    """doc_id and kept: the bytes of each text without those covered by a 50-byte string that also starts in a document with
    a smaller doc_id.

    Texts are UTF-8 bytes, whole; matches never cross documents, overlaps count, and strings are judged on the input. A
    null text counts as empty. Rows of equal doc_id are one document's and never remove from each other; a null doc_id counts
    as larger than every other and removes from nobody. Each row gives a row; an empty table gives none; other columns are
    not read. `docs` must come from a stored table, as its rows are numbered twice.

    Triggers meet in buckets of even size, sent once per block of rows however often they occur there; the phrases
    of triggers that occur again meet in the same buckets. Strings are equal if their 64-bit hashes and triggers are.
    """
    return _judged(docs, _kept, "_row long, doc_id long, kept binary").drop("_row")


def removal_digest(docs):
    """As `remove_repeats`, with counts and a hash instead of bytes: n_bytes, n_removed, n_spans, kept_sha256."""
    return _judged(docs, _digest, "_row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").drop("_row")


def op9_repeats(spark, sf_dir):
    return removal_digest(table(spark, sf_dir, "documents"))
