"""Token counts: pieces are counted once per distinct pre-token of a group of blocks, with the pre-token counts of its documents."""

import json
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from barworks.llm.bpe import bytes_of_signs
from barworks.llm.common import numbered, table

LIMIT = 2048
POSTING_BYTES = 16 << 20  # text of a block whose postings are made: some twenty bytes of arrays for each
BLOCK_CHUNKS = 600_000  # different chunks of a block
BLOCK_ROWS = 1 << 15
GROUP_BLOCKS = 16  # blocks whose postings meet
SLOTS = 32  # shares of the pre-tokens of such a group
SLOT_ROWS = 1 << 13  # postings of a slot that are unpacked at a time
SPECIAL = " "  # stands for a special string among pre-tokens, which hold no space
MOST = (1 << 15) - 1  # largest count of one entry
HELD = 1 << 20  # documents a task sums up before it sends the sums

#: A pattern that takes a run of letters whole, unless a sign that is none stands among them.
_LETTERS_WHOLE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Below this sign normal forms are the signs themselves and letters are the same in every Unicode version.
_PLAIN_END = "\u0250"


@lru_cache(maxsize=2)
def _tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _special(path):
    """A pattern of the special strings that stand for a token wherever a text holds them; None if there are none."""
    strings = sorted((t.content for t in _tokenizer(path).get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, strings))) if strings else None


@lru_cache(maxsize=2)
def _cutter(path):
    """Pre-tokens of a text without spaces: normal forms and pre-tokens never reach across a space.

    Where the file lower-cases composed text and cuts it by one pattern into byte-level words, and a chunk is plain Latin, the
    pattern is applied here; everything else goes through the library's own normaliser and cutter.
    """
    tok = _tokenizer(path)
    spec = json.loads(tok.to_str())
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    known = (steps == ["NFC", "Replace", "Lowercase"] and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
             and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and "Regex" in cuts[0]["pattern"]
             and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"])
    find = regex.compile(cuts[0]["pattern"]["Regex"]).findall if known else None
    whole = known and cuts[0]["pattern"]["Regex"] == _LETTERS_WHOLE
    signs = {b: s for s, b in bytes_of_signs().items()}

    def cut(chunk):
        if known and chunk and (chunk.isascii() or max(chunk) < _PLAIN_END) and chunk.isprintable():
            lower = chunk.lower()
            words = [lower] if whole and lower.isalpha() else find(lower)
            return words if chunk.isascii() else [w.encode().decode("latin-1").translate(signs) for w in words]
        normal = tok.normalizer.normalize_str(chunk) if tok.normalizer else chunk
        return [w for w, _ in tok.pre_tokenizer.pre_tokenize_str(normal)]

    return cut


def n_pieces(word, path):
    return 1 if word == SPECIAL else len(_tokenizer(path).model.tokenize(word))


def _split(text):
    return text.replace("\n", " ").replace("\t", " ").split(" ")


def _chunks(text, special):
    """Pieces between spaces, and the number of special strings."""
    parts = special.split(text) if special else [text]
    if len(parts) == 1:
        return _split(text), 0
    return [c for part in parts for c in _split(part)], len(parts) - 1


class _Names:
    """Different pre-tokens of the documents of a block."""

    def __init__(self, path):
        self.path, self.codes, self.specials, self.size = path, defaultdict(), [], 0
        self.codes.default_factory = self.codes.__len__

    def add(self, row, text):
        chunks, specials = _chunks(text, _special(self.path))
        codes = np.fromiter(map(self.codes.__getitem__, chunks), np.int64, len(chunks))
        self.specials.append(specials)
        self.size += len(text)
        return codes

    def cut(self):
        """Numbers of the pre-tokens of each chunk, one after the other, how many a chunk has, and the pre-tokens by number."""
        cut, names = _cutter(self.path), defaultdict()
        names.default_factory = names.__len__
        cuts = [cut(c) for c in self.codes]
        self.codes.clear()
        sizes = np.array([len(c) for c in cuts], np.int64)
        return np.fromiter((names[w] for c in cuts for w in c), np.int64, int(sizes.sum())), sizes, names

    def batches(self):
        names = self.cut()[2]
        if any(self.specials):
            names[SPECIAL]
        yield pa.RecordBatch.from_arrays([pa.array(list(names), pa.string())], ["word"])


class _Postings(_Names):
    """For each pre-token of a block the documents that hold it, and how often.

    An entry is the document's step from the block's first row; a negative number before it says how often, if not once.
    """

    def __init__(self, path):
        super().__init__(path)
        self.rows, self.docs = [], []

    def add(self, row, text):
        self.rows.append(row)
        self.docs.append(super().add(row, text) << 16 | (row - self.rows[0]))

    def full(self):
        return (self.size >= POSTING_BYTES or len(self.codes) >= BLOCK_CHUNKS or len(self.rows) >= BLOCK_ROWS
                or self.rows[-1] - self.rows[0] >= BLOCK_ROWS - 1)

    def batches(self):
        word, per_chunk, names = self.cut()
        chunk = np.repeat(np.arange(len(per_chunk)), per_chunk)
        pairs = np.concatenate(self.docs)
        self.docs = []
        pairs.sort()
        new = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
        pairs, n = pairs[new], np.diff(np.append(new, len(pairs)))
        at = np.searchsorted(pairs >> 16, np.arange(len(per_chunk) + 1))  # pairs of each chunk
        sizes = (at[1:] - at[:-1])[chunk]
        place = np.arange(sizes.sum()) + np.repeat(at[:-1][chunk] - (np.cumsum(sizes) - sizes), sizes)
        keys, counts = np.repeat(word, sizes) << 16 | pairs[place] & 0xFFFF, n[place]
        marked = np.flatnonzero(self.specials)
        if len(marked):
            keys = np.append(keys, names[SPECIAL] << 16 | (np.array(self.rows)[marked] - self.rows[0]))
            counts = np.append(counts, np.array(self.specials)[marked])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[:len(keys)])
        counts = np.add.reduceat(counts, new) if len(new) else counts
        keys = keys[new]
        often = -(-counts // MOST)  # a count too large for one entry takes several
        last = np.cumsum(often) - 1
        keys, single = np.repeat(keys, often), np.full(int(often.sum()), MOST)
        single[last] = counts - (often - 1) * MOST
        width = 1 + (single > 1)
        ends = np.cumsum(width)
        entries = np.empty(int(ends[-1]) if len(ends) else 0, "<i2")
        entries[ends - 1] = keys & 0xFFFF
        entries[(ends - 2)[single > 1]] = -single[single > 1]
        offsets = np.concatenate(([0], 2 * ends))[np.searchsorted(keys >> 16, np.arange(len(names) + 1))].astype("<i4")
        data = pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(offsets), pa.py_buffer(entries)])
        batch = pa.RecordBatch.from_arrays([pa.array(np.full(len(names), self.rows[0])), pa.array(list(names), pa.string()), data],
                                           ["block", "word", "docs"])
        for start in range(0, len(names), 1 << 15):
            yield batch.slice(start, 1 << 15)


def _postings(path):
    """Postings of all documents that a task reads, block after block, with the number of the block in its task."""
    def run(batches):
        block, turn = _Postings(path), 0

        def made():
            for batch in block.batches():
                yield batch.append_column("turn", pa.array(np.full(batch.num_rows, turn), pa.int64()))

        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(row, text.as_py() or "")
                if block.full():
                    yield from made()
                    block, turn = _Postings(path), turn + 1
        if block.rows:
            yield from made()
    return run


def _slot_sums(path):
    """Sums of the documents of each block over the postings of a slot; a pre-token that several blocks sent is counted once."""
    def run(rows):
        words = rows["word"].combine_chunks().dictionary_encode()
        pieces = np.array([n_pieces(w, path) for w in words.dictionary.to_pylist()], np.int32)[words.indices.to_numpy()]
        joined = rows.select(["block", "docs"]).append_column("pieces", pa.array(pieces))
        return pa.Table.from_batches(_sums(joined.to_batches(SLOT_ROWS)))
    return run


def _sums(batches):
    """Pieces times counts, summed per document of each block before the shuffle: one row per block and task."""
    held, size = {}, 0

    def flush():
        sums = [held[b] for b in held]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([s.tobytes() for s in sums], pa.binary())],
                                          ["block", "sums"])

    for batch in batches:
        blocks, offsets = batch.column(0).to_numpy(), np.frombuffer(batch.column(1).buffers()[1], "<i4")
        at = batch.column(1).offset
        offsets = offsets[at:at + batch.num_rows + 1] // 2
        entries = np.frombuffer(batch.column(1).buffers()[2], "<i2", int(offsets[-1])) if batch.num_rows else np.zeros(0, "<i2")
        entries = entries[offsets[0]:].astype(np.int64) if batch.num_rows else entries
        owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        step = np.flatnonzero(entries >= 0)
        counts = np.where((step > 0) & (entries[step - 1] < 0), -entries[step - 1], 1)
        weights = counts * batch.column(2).to_numpy()[owner[step]]
        own, where = np.unique(blocks, return_inverse=True)
        where = where[owner[step]]
        order = np.argsort(where, kind="stable")
        cuts = np.searchsorted(where[order], np.arange(len(own) + 1))
        for b, i, j in zip(own.tolist(), cuts, cuts[1:]):
            found = np.bincount(entries[step][order[i:j]], weights[order[i:j]]).astype("<i8")
            old = held.get(b, found[:0])
            if len(old) < len(found):
                size += len(found) - len(old)
                old = np.concatenate((old, np.zeros(len(found) - len(old), "<i8")))
            old[:len(found)] += found
            held[b] = old
        if size > HELD:
            yield flush()
            held, size = {}, 0
    if held:
        yield flush()


def _totals(rows):
    """The sums of a block's documents over all tasks."""
    parts = [np.frombuffer(s, "<i8") for s in rows["sums"].to_pylist()]
    total = np.zeros(max(map(len, parts)), np.int64)
    for part in parts:
        total[:len(part)] += part
    steps = np.flatnonzero(total)
    return pa.table([pa.array(rows["block"][0].as_py() + steps), pa.array(total[steps])], ["_row", "n_tokens"])


def token_counts(docs, path, limit=LIMIT):
    """One row per document: doc_id, n_bytes, n_tokens, over_limit, as the tokenizer file at `path` gives them.

    No begin, end or other special token is added; special strings inside a text count as their token. A null or empty
    text has no bytes and no tokens. Repeated rows and ids, and null ids, give a row each. Texts are taken whole.
    Other columns are not read; an empty table gives no rows.

    Blocks of documents send each distinct pre-token once, with the documents that hold it, so the commonest pre-token
    has a row per block, not per document. GROUP_BLOCKS blocks send theirs to the same SLOTS slots by hash, which nobody else
    uses, so a slot has a bounded number of documents to sum up, and a document gets a bounded number of sums, however many
    there are in all. No ids are made: a pre-token's pieces are counted once in its slot.
    """
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    texts = rows.select("_row", "text")
    postings = texts.mapInArrow(_postings(path), "block long, word string, docs binary, turn long")
    # blocks of neighbouring tasks that each task made at the same turn; the task's number is in the upper bits of the row's
    group = F.floor(F.shiftright("block", 33) / F.lit(GROUP_BLOCKS)).alias("group")
    slots = postings.select(group, "turn", F.pmod(F.xxhash64("word"), F.lit(SLOTS)).alias("slot"), "block", "word", "docs")
    summed = slots.groupBy("group", "turn", "slot").applyInArrow(_slot_sums(path), "block long, sums binary")
    sums = summed.groupBy("block").applyInArrow(_totals, "_row long, n_tokens long")
    sizes = rows.select("_row", "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return (sizes.join(sums, "_row", "left").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0).cast("long")))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))


def op6_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
