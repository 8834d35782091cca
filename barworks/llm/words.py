"""Words of many texts at once: places and 64-bit hashes, with whole-array operations."""

import re
from functools import lru_cache

import numpy as np

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SIGN = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


@lru_cache(maxsize=1)
def _powers(n):
    up, down = np.full(n, _BASE), np.full(n, _BACK)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n):
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    return _powers(1 << max(16, int(n).bit_length()))


def mixed(h):
    """Spread every bit of 64-bit values over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans_hash(values, starts, ends):
    """Hash of each span values[start:end]: equal spans have equal hashes wherever they stand."""
    up, down = powers(len(values) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)], dtype=np.uint64)))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(data):
    """Starts, ends and hashes of the words of lower-cased UTF-8 bytes: runs of letters and digits; all signs beyond ASCII count
    as letters."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], _IN_WORD[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    return starts, ends, spans_hash(_SIGN[raw], starts, ends)


def normal(line):
    """A line in lower case with single spaces between words; a line without words is only trimmed."""
    found = WORD.findall(line.lower().encode("utf-8", "replace"))
    return b" ".join(found).decode("utf-8", "replace") if found else line.strip()


def packed(texts, limit):
    """Lower-cased texts as bytes, in lots of about `limit` bytes: (numbers of the texts, their byte strings)."""
    numbers, lot, size = [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").lower().encode("utf-8", "replace")
        numbers.append(i)
        lot.append(data)
        size += len(data)
        if size >= limit:
            yield numbers, lot
            numbers, lot, size = [], [], 0
    if lot:
        yield numbers, lot
