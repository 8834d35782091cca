"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a byte-to-text state machine."""

import codecs
import hashlib
import json
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from barworks.llm.common import table

# Fixed value: how byte-level tokenizers cut a text into pre-tokens.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_CUT = regex.compile(r"\S(?= [^\s])")  # a pre-token always ends before a space between two signs
SLICE = 1 << 18  # characters of a text that are cut into pre-tokens at a time
STEP = 4096  # bytes of one pre-token between two looks for tokens that are stable
CACHED = 600_000  # short pre-tokens a worker remembers
_NEVER = 1 << 60


def bytes_of_signs():
    """The byte each printable sign of a byte-level vocabulary stands for: printable Latin-1 signs stand for themselves,
    the other bytes, in order, for the signs from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeList:
    """A vocabulary and its merges, by token id, with what the transducer needs to know of them."""

    def __init__(self, path):
        spec = json.load(open(path, encoding="utf-8"))
        signs, vocab = bytes_of_signs(), spec["model"]["vocab"]
        self.text = {i: bytes(map(signs.__getitem__, t)) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text.update({i: t.encode() for t, i in self.special.items()})
        self.birth, self.split, self.merge = {}, {}, {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            whole, parts = vocab[left + right], (vocab[left], vocab[right])
            if parts not in self.merge:
                self.merge[parts] = rank
            if whole not in self.birth:
                self.birth[whole], self.split[whole] = rank, parts
        self._spines, self._joins, self._joins_back = {}, {}, {}
        self.tokens, self.lookahead = {}, 1
        for t, i in sorted(vocab.items(), key=lambda x: self.birth.get(x[1], -1)):
            b = self.text[i]
            if self._whole(i):
                self.tokens[b] = i
                self.lookahead = max(self.lookahead, len(b))
        # every end of a token, with the token it is itself, if any
        self.endings = {b[j:]: None for b in self.tokens for j in range(len(b))} | self.tokens
        self.table = [self.text.get(i, b"") for i in range(max(self.text) + 1)]
        pattern = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.special_pattern = re.compile(f"({pattern})") if pattern else None
        self.packed = {}

    def _spine(self, token, side):
        """The parts of a token at one of its ends, smallest first: (part, rank of the merge that uses it up)."""
        found = self._spines.get((token, side))
        if found is None:
            parts, ends, at = [token], [_NEVER], token
            while at in self.split:
                ends.append(self.birth[at])
                at = self.split[at][side]
                parts.append(at)
            found = self._spines[token, side] = (parts[::-1], ends[::-1])
        return found

    def _crossed(self, left, right, until=_NEVER):
        """Whether a merge of lower rank than `until` crosses the border between two tokens while they are built."""
        (a, a_end), (b, b_end) = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            rank = self.merge.get((a[i], b[j]), _NEVER)
            # of equal merges the leftmost comes first
            if rank < until and rank < a_end[i] and rank <= b_end[j]:
                return True
            if a_end[i] == b_end[j] == _NEVER:
                return False
            if a_end[i] <= b_end[j]:
                i += 1
            else:
                j += 1

    def _whole(self, token):
        """Whether the merges turn the bytes of a token into that token alone."""
        if token not in self.split:
            return len(self.text[token]) == 1
        left, right = self.split[token]
        return (self.text[left] in self.tokens and self.text[right] in self.tokens
                and not self._crossed(left, right, self.birth[token]))

    def stays(self, left, right):
        """Whether two tokens stand side by side in an encoding of their bytes."""
        key = left << 32 | right
        found = self._joins.get(key)
        if found is None:
            if len(self._joins) >= 1 << 20:
                self._joins.clear()
            found = self._joins[key] = not self._crossed(left, right)
        return found


@lru_cache(maxsize=2)
def merge_list(path):
    return MergeList(path)


class Transducer:
    """Encodes the bytes of one pre-token from left to right.

    For every prefix it keeps the last token of the prefix's own encoding. A token that ends later starts at most
    `lookahead` bytes (the longest token) before the end of what was read, so the encoding of any longer text runs
    through one of the last `lookahead` prefixes; what the encodings of all of these begin with is stable and goes out.
    Memory is that window and the undecided tokens, not the text.
    """

    def __init__(self, merges):
        self.merges, self.bytes, self.last, self.before = merges, b"", [], None

    def feed(self, data):
        m, last, before = self.merges, self.last, self.before
        endings, joins, stays = m.endings, m._joins, m.stays
        at, held = len(last), self.bytes + data
        self.bytes = held
        for end in range(at + 1, len(held) + 1):
            fit = []
            for start in range(end - 1, -1, -1):
                token = endings.get(held[start:end], -1)
                if token is not None:
                    if token < 0:
                        break
                    fit.append((start, token))
            for start, token in reversed(fit):
                previous = last[start - 1][1] if start else before
                if previous is None:
                    break
                fits = joins.get(previous << 32 | token)
                if fits or fits is None and stays(previous, token):
                    break
            else:
                raise ValueError("bytes that the vocabulary lacks")
            last.append((start, token))

    def _path(self, end):
        out = []
        while end:
            end, token = self.last[end - 1]
            out.append(token)
        return out[::-1]

    def stable(self):
        """Tokens that no further byte can change; they leave the window."""
        n = len(self.last)
        ends = set(range(max(0, n - self.merges.lookahead), n + 1))
        while len(ends) > 1:
            end = max(ends)
            ends.remove(end)
            ends.add(self.last[end - 1][0])
        end = ends.pop()
        if not end:
            return []
        out = self._path(end)
        self.bytes, self.before = self.bytes[end:], out[-1]
        self.last = [(start - end, token) if start >= end else (0, token) for start, token in self.last[end:]]
        return out

    def finish(self):
        return self._path(len(self.last))


def encode_pre_token(data, merges):
    machine, out = Transducer(merges), []
    for at in range(0, len(data), STEP):
        machine.feed(data[at:at + STEP])
        if at + STEP < len(data):
            out += machine.stable()
    return out + machine.finish()


def _slices(text):
    at = 0
    while len(text) - at > SLICE:
        cut = _CUT.search(text, at + SLICE)
        if cut is None:
            break
        yield text[at:cut.end()]
        at = cut.end()
    yield text[at:]


def encode_stream(text, merges):
    """Ids of a text in order, as little-endian 32-bit blocks of bounded size."""
    known = merges.packed

    def ids(word):
        made = array("I", encode_pre_token(word.encode("utf-8", "replace"), merges))
        if made.itemsize != 4 or sys.byteorder != "little":
            made = np.array(made, "<u4")
        packed = made.tobytes()
        if len(word) <= 64:
            if len(known) >= CACHED:
                known.clear()
            known[word] = packed
        return packed

    get = known.get
    for part in merges.special_pattern.split(text) if merges.special_pattern else (text,):
        if part in merges.special:
            yield np.uint32(merges.special[part]).tobytes()
            continue
        for piece in _slices(part):
            words = PRE_TOKEN.findall(piece)
            packed = list(map(get, words))
            if None in packed:
                packed = [p or get(w) or ids(w) for p, w in zip(packed, words)]
            yield b"".join(packed)


def decode_stream(blocks, merges):
    """Text of a stream of id blocks: bytes go through a UTF-8 state machine that keeps what is not yet a whole sign."""
    machine, known = codecs.getincrementaldecoder("utf-8")("replace"), len(merges.table)
    for block in blocks:
        ids = np.frombuffer(block, "<u4")
        if len(ids) and ids.max() >= known:
            ids = ids[ids < known]
        yield machine.decode(b"".join(map(merges.table.__getitem__, ids.tolist())))
    yield machine.decode(b"", True)


def _round_trip(path):
    def run(batches):
        merges = merge_list(path)
        for batch in batches:
            n, ids, texts = [], [], []
            for text in batch.column(1):
                id_hash, text_hash, size = hashlib.sha256(), hashlib.sha256(), 0

                def seen(blocks):
                    nonlocal size
                    for block in blocks:
                        id_hash.update(block)
                        size += len(block) // 4
                        yield block

                for piece in decode_stream(seen(encode_stream(text.as_py() or "", merges)), merges):
                    text_hash.update(piece.encode("utf-8"))
                n.append(size)
                ids.append(id_hash.hexdigest())
                texts.append(text_hash.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _encoded(path):
    def run(batches):
        merges = merge_list(path)
        for batch in batches:
            made = [None if t.as_py() is None else np.frombuffer(b"".join(encode_stream(t.as_py(), merges)), "<u4").astype(np.int32)
                    for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return run


def _decoded(path):
    def run(batches):
        merges = merge_list(path)
        for batch in batches:
            made = [None if x.as_py() is None else "".join(decode_stream([np.array(x.as_py(), "<u4").tobytes()], merges))
                    for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["doc_id", "text"])
    return run


def _texts(docs):
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs, path):
    """doc_id and ids (array of int) of every document; a null text has null ids, an empty one none."""
    return _texts(docs).mapInArrow(_encoded(path), "doc_id long, ids array<int>")


def decode(encoded, path):
    """doc_id and text of rows with ids, special tokens included; ids that no token has give nothing."""
    return (encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
            .mapInArrow(_decoded(path), "doc_id long, text string"))


def round_trip(docs, path):
    """Encode and decode every document in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Special strings inside a text become their token. A null text counts as empty. Repeated rows and ids, and null ids,
    give a row each; other columns are not read; an empty table gives no rows. Texts are taken whole, however long:
    ids and text stream through the digests in blocks, and nothing moves between tasks.
    """
    return _texts(docs).mapInArrow(
        _round_trip(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark, sf_dir):
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
