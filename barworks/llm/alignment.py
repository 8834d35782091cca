"""How two tokenizers cut the same texts: groups between common ends, links of overlapping tokens, counts of linked ids.

Equal texts are brought together by their full text and tokenised once; a pair of ids counts each text as often as documents
hold it. Texts are measured in blocks. A block asks once for the count of every pair that it holds, whatever the pair's
frequency. Its links travel as numbers of its pairs, so no text is tokenised again when the answers are there.
"""

import hashlib
import json
import re
from array import array
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from barworks.llm.bpe import PRE_TOKEN, bytes_of_signs
from barworks.llm.common import stored, table

BLOCK_BYTES = 8 << 20  # text that shares one list of pairs
SLICE = 1 << 18  # characters of a text that are tokenised at a time
CACHED = 500_000  # pieces of text whose ids a worker remembers
LONGEST_CACHED = 64  # characters of such a piece
KEY_BYTES = 32  # of a text's SHA-256
PER_BUCKET = 1 << 21  # pairs asked for in one task

_PLAIN = re.compile("[\t-\r -~\xa0-ɏ]*")  # signs that all versions of the letter tables know alike
_CHUNK = re.compile(" +[^ ]+| +|[^ ]+")
_CUT = re.compile("[!-~](?= [!-~])")  # both tokenizers always cut before such a blank
_MARK = "▁"  # Fixed value: the sign pieces have for a blank


class Tokenizers:
    """Both tokenizers of a pair of files: A, byte-level, for blank and text; B, pieces with a blank of their own in front."""

    def __init__(self, path_a, path_b):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        signs = bytes_of_signs()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(_MARK, " ").encode())
        if any(_MARK in self.b.id_to_piece(i).lstrip(_MARK) for i in range(self.b.get_piece_size())):
            raise ValueError(f"{path_b}: pieces reach over a blank")
        spec = json.loads(self.a.to_str())
        cutter = spec["pre_tokenizer"]
        if cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or not cutter.get("use_regex", True):
            raise ValueError(f"{path_a}: not byte-level, or adds a blank of its own")
        self.length_a, self.length_b = (np.array([len(t) for t in bytes_]) for bytes_ in (self.bytes_a, self.bytes_b))
        self.known_b = {}
        # ids that ascend with the merges are ranks: then the same vocabulary runs on a faster engine where both cut alike
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        self.fast = None
        if all(i < j for i, j in zip(merged, merged[1:])):
            special = {t["id"] for t in spec["added_tokens"]}
            ranks = {self.bytes_a[i]: i for i in vocab.values() if i not in special}
            self.fast = tiktoken.Encoding("a", pat_str=PRE_TOKEN.pattern, mergeable_ranks=ranks, special_tokens={})

    def _ids_a(self, part):
        if self.fast and _PLAIN.fullmatch(part):
            return array("I", self.fast.encode_ordinary(part)).tobytes()  # its tokens are byte strings, all of the part
        return self._spelt(self.a.encode(part, add_special_tokens=False).ids, self.bytes_a, part)

    def _ids_b(self, part):
        """Ids chunk by chunk, a blank and what follows; those of short chunks are remembered."""
        known, chunks = self.known_b, _CHUNK.findall(part)
        new = [c for c in dict.fromkeys(chunks) if c not in known]
        # B puts no blank in front of nothing
        ids = zip(new, self.b.encode([c[1:] for c in new], num_threads=1) if new else ())
        found = {c: self._spelt(i if len(c) > 1 else [self.b.piece_to_id(_MARK)], self.bytes_b, c) for c, i in ids}
        if len(known) > CACHED:
            found.update((c, known[c]) for c in set(chunks) if c in known)
            self.known_b = known = {}
        if any(len(c) > LONGEST_CACHED for c in found):
            out = [found[c] if c in found else known[c] for c in chunks]
            known.update((c, i) for c, i in found.items() if len(c) <= LONGEST_CACHED)
            return out
        known.update(found)
        return map(known.__getitem__, chunks)

    @staticmethod
    def _spelt(ids, spelling, piece):
        """Ids as 32-bit numbers; None where the tokens do not spell the piece."""
        same = b"".join(map(spelling.__getitem__, ids)) == piece.encode("utf-8", "replace")
        return array("I", ids).tobytes() if same else None

    def encode(self, text):
        """Ids of blank and text by A and by B, or None if either does not spell them. Long texts are encoded in parts, cut
        where no token can reach over, so the ids are those of the whole text."""
        full, start, found_a, found_b = " " + text, 0, [], []
        while start < len(full):
            cut = _CUT.search(full, start + SLICE) if len(full) - start > SLICE else None
            end = cut.end() if cut else len(full)
            found_a.append(self._ids_a(full[start:end]))
            found_b += self._ids_b(full[start:end])
            start = end
        try:
            return tuple(np.frombuffer(b"".join(found), np.uint32).astype(np.int64) for found in (found_a, found_b))
        except TypeError:  # a piece that is not spelt
            return None


_LOADED = {}


def _tokenizers(*paths):
    """Loaded once a worker."""
    if paths not in _LOADED:
        _LOADED[paths] = Tokenizers(*paths)
    return _LOADED[paths]


class Alignment:
    """Ends of the tokens, groups between common ends, and the links: the stretches between any two ends next to each other,
    each within one token of A and one of B."""

    def __init__(self, ids, tokenizers):
        self.a, self.b = ids
        self.ends_a, self.ends_b = np.cumsum(tokenizers.length_a[self.a]), np.cumsum(tokenizers.length_b[self.b])
        ends = np.zeros(self.ends_a[-1] + 1, np.int8)
        ends[self.ends_a] = 1
        ends[self.ends_b] += 2
        stretches = np.flatnonzero(ends)
        kinds = ends[stretches]
        self.common = stretches[kinds == 3]
        # a stretch lies in the token whose end is the next one: as many ended before it
        in_a, in_b = kinds & 1, kinds >> 1
        self.link_a, self.link_b = self.a[np.cumsum(in_a, dtype=np.int64) - in_a], self.b[np.cumsum(in_b, dtype=np.int64) - in_b]

    def groups(self):
        """How many tokens of A and of B stand before the end of each group."""
        return np.searchsorted(self.ends_a, self.common, "right"), np.searchsorted(self.ends_b, self.common, "right")

    def digest(self, signs):
        """Hex digest of `a1,a2|b1;a3|b2`: ids of A and of B, group by group. `signs` has the ids with each separator."""
        until_a, until_b = self.groups()
        group_a, group_b = (np.repeat(np.arange(len(u)), np.diff(u, prepend=0)) for u in (until_a, until_b))
        ids = np.concatenate((self.a, self.b))
        after = np.zeros(len(ids), np.int64)
        after[until_a - 1] = 1
        after[len(self.a) + until_b - 1] = 2
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        text = signs[(ids * 3 + after)[order]].tobytes().translate(None, b"\0")
        return hashlib.sha256(text[:-1]).hexdigest()


def _signs(tokenizers):
    """Each id with each separator, filled up with zero bytes."""
    n = max(len(tokenizers.bytes_a), len(tokenizers.bytes_b))
    return np.array([f"{i}{sep}" for i in range(n) for sep in ",|;"], "S")


_FIRST = "block long, key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pairs binary, weights binary"
_NAMES = [f.split()[0] for f in _FIRST.split(", ")]
_TYPES = [{"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[f.split()[1]] for f in _FIRST.split(", ")]


def _packed_links(keys, links):
    """Keys of texts and their links, numbers of pairs, as bytes: like bytes of all numbers side by side, which packs well."""
    sizes = np.array([len(x) for x in links], "<i8")
    planes = np.concatenate(links).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(b"".join([len(keys).to_bytes(8, "little"), *keys, sizes.tobytes(), planes.tobytes()]), 3)


def _unpacked_links(held):
    """Keys of texts, where the links of each end, and all links."""
    raw = zstandard.decompress(held)
    n = int.from_bytes(raw[:8], "little")
    keys = [raw[at:at + KEY_BYTES] for at in range(8, 8 + KEY_BYTES * n, KEY_BYTES)]
    at = 8 + KEY_BYTES * n
    planes = np.frombuffer(raw, np.uint8, offset=at + 8 * n).reshape(4, -1)
    return keys, np.cumsum(np.frombuffer(raw, "<i8", n, at)), np.ascontiguousarray(planes.T).view("<u4").ravel()


def _measured(paths):
    """Texts of a task, in blocks: a row per text with what it measures itself, then a row of the block with its links, its
    different pairs in order and how many documents of the block hold each."""
    def block_row(block, keys, pairs, links, weights):
        sizes = [len(p) for p in pairs]
        pairs, at = np.unique(np.concatenate(pairs), return_inverse=True)
        held = _packed_links(keys, [own[x] for own, x in zip(np.split(at.astype("<u4"), np.cumsum(sizes)[:-1]), links)])
        weights = np.bincount(at, np.repeat(weights, sizes)).astype("<i8")
        return [(block, None, None, None, None, None, None, held, pairs.astype("<i8").tobytes(), weights.tobytes())]

    def run(batches):
        both = _tokenizers(*paths)
        signs, n_b = _signs(both), len(both.bytes_b)
        number, size = count(TaskContext.get().partitionId() << 24), 0
        block, keys, pairs, links, weights = next(number), [], [], [], []
        for batch in batches:
            rows = []
            for key, text, copies in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py()
                ids = both.encode(text)
                if ids is None:
                    continue
                found = Alignment(ids, both)
                rows.append((block, key, len(found.a), len(found.b), len(found.common), len(found.link_a), found.digest(signs), None, None, None))
                own, at = np.unique(found.link_a * n_b + found.link_b, return_inverse=True)
                keys.append(key)
                pairs.append(own)
                links.append(at.astype(np.uint32))
                weights.append(copies)
                size += len(text)
                if size >= BLOCK_BYTES:
                    rows += block_row(block, keys, pairs, links, weights)
                    block, size, keys, pairs, links, weights = next(number), 0, [], [], [], []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block_row(block, keys, pairs, links, weights)), _TYPES)], _NAMES)
    return run


def _unpacked(batches):
    for batch in batches:
        for pairs, weights in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(pairs, "<i8")), pa.array(np.frombuffer(weights, "<i8"))], ["pair", "n"])


def _requests(n_buckets):
    """A row per block and bucket with the block's pairs of that bucket, in order."""
    def run(batches):
        for batch in batches:
            for block, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pairs = np.frombuffer(pairs, "<i8")
                bucket = pairs % n_buckets
                order = np.argsort(bucket, kind="stable")
                found, starts = np.unique(bucket[order], return_index=True)
                starts, pairs = np.append(starts, len(pairs)), pairs[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int32)), pa.array(np.full(len(found), block)),
                     pa.array([pairs[i:j].tobytes() for i, j in zip(starts, starts[1:])], pa.binary())], ["bucket", "block", "pairs"])
    return run


def _answers(asked, known):
    """Counts for the pairs each block asked for; below zero where the count is its A id's highest."""
    pairs, n = known["pair"].to_numpy(), known["n"].to_numpy()
    n = np.where(known["best"].to_numpy(), -n, n)
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    out = [n[np.searchsorted(pairs, np.frombuffer(p, "<i8"))].astype("<i8").tobytes() for p in asked["pairs"].to_pylist()]
    return pa.table([asked["bucket"], asked["block"], pa.array(out, pa.binary())], ["bucket", "block", "counts"])


def _summed(n_buckets):
    """Per text of a block the links whose count is the highest of their A id, and the sum of all counts."""
    def run(block, answers):
        keys, bests, sums = [], [], []
        if block.num_rows:
            pairs = np.frombuffer(block["pairs"][0].as_py(), "<i8")
            counts, bucket = np.zeros(len(pairs), np.int64), pairs % n_buckets
            for own, given in zip(answers["bucket"].to_pylist(), answers["counts"].to_pylist()):
                counts[bucket == own] = np.frombuffer(given, "<i8")
            keys, ends, links = _unpacked_links(block["links"][0].as_py())
            mine = counts[links]
            bests, sums = (np.diff(np.cumsum(x, dtype=np.int64)[ends - 1], prepend=0) for x in (mine < 0, np.abs(mine)))
        return pa.table([pa.array(keys, pa.binary()), pa.array(bests, pa.int64()), pa.array(sums, pa.int64())], ["key", "n_best", "count_sum"])
    return run


def distinct_texts(docs):
    """Each different text that is not empty, with a key and the number of documents that hold it."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    return texts.select(F.unhex(F.sha2("text", 256)).alias("key"), "text", "copies")


def groups(docs, path_a, path_b):
    """The alignment itself: text, copies, a and b, the ids of each group in order, a row per different text that both spell."""
    def run(batches):
        both = _tokenizers(path_a, path_b)
        for batch in batches:
            rows = []
            for text, copies in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = both.encode(text)
                if ids is not None:
                    found = Alignment(ids, both)
                    until_a, until_b = found.groups()
                    rows.append((text, copies, [x.tolist() for x in np.split(found.a, until_a[:-1])], [x.tolist() for x in np.split(found.b, until_b[:-1])]))
            if rows:
                kinds = (pa.string(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["text", "copies", "a", "b"])
    return distinct_texts(docs).mapInArrow(run, "text string, copies long, a array<array<int>>, b array<array<int>>")


def pair_counts(blocks, n_b):
    """How many documents hold each pair of ids linked: pair (A id times `n_b` plus B id), n, and whether it is its A id's highest."""
    pairs = blocks.select("pairs", "weights").mapInArrow(_unpacked, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = stored(pairs.withColumn("a", F.floor(F.col("pair") / F.lit(n_b)).cast("long")))
    most = pairs.groupBy("a").agg(F.max("n").alias("most"))
    return pairs.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def measures(docs, path_a, path_b):
    """One row per document: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a blank and the text, B the text, to which it adds the blank; special strings are plain text. Common ends of
    tokens, in bytes, cut both into groups. Every A and B token that overlap are a link; the count of a link is the number of
    documents that hold its pair of ids linked. n_best counts the links that have the highest count of their A id, ties
    included, count_sum adds up the counts of all links.

    A null or empty text, and one that the tokens do not spell byte by byte (as with the sign that stands for a blank), has zeros
    and an empty digest. Repeated rows and ids give a row each and count each. A null doc_id keeps its row. Texts are read
    whole, long ones a slice at a time; other columns are not read. An empty table gives no rows. Equal texts are found by the
    text itself; their measures go back to the documents by its SHA-256.
    """
    paths = path_a, path_b
    n_b = len(Tokenizers(*paths).bytes_b)
    first = stored(distinct_texts(docs).mapInArrow(_measured(paths), _FIRST))
    blocks, own = first.where("key IS NULL"), first.where("key IS NOT NULL")
    asked = blocks.agg(F.sum(F.length("pairs")) / F.lit(8)).first()[0] or 0
    n_buckets = max(1, -(-int(asked) // PER_BUCKET))
    counts = pair_counts(blocks, n_b).withColumn("bucket", F.pmod("pair", F.lit(n_buckets)).cast("int"))
    requests = blocks.select("block", "pairs").mapInArrow(_requests(n_buckets), "bucket int, block long, pairs binary")
    answers = (requests.groupBy("bucket").cogroup(counts.groupBy("bucket"))
               .applyInArrow(_answers, "bucket int, block long, counts binary"))
    sums = (blocks.select("block", "links", "pairs").groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_summed(n_buckets), "key binary, n_best long, count_sum long"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    known = own.select("key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "key")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.col("text").cast("string"), 256)).alias("key"))
    return ids.join(known, "key", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op11_alignment(spark, sf_dir):
    import public_tokenizers

    return measures(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
