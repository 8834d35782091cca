"""Which 64-bit keys occur more than once: keys travel as packed halves, per block of rows and bucket of keys."""

import numpy as np
import pyarrow as pa

PACKED = "bucket int, block long, keys binary"


def short(keys, n_buckets):
    """The bucket of each key and its lower half, as one number."""
    return (keys >> np.uint64(32)) % np.uint64(n_buckets) << np.uint64(32) | keys & np.uint64(0xFFFFFFFF)


def by_bucket(keys, n_buckets):
    """Order of keys by bucket, the buckets that occur, and where each starts."""
    bucket = ((keys >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    return order, found, np.append(starts, len(order))


def packed(block, keys, n_buckets):
    """A row per bucket with the lower halves of a block's keys; a key that stands here twice counts as shared.

    A block sends a key once or twice however often it has it, so a hot key has few entries per block.
    """
    order, found, starts = by_bucket(keys, n_buckets)
    low = (keys[order] & np.uint64(0xFFFFFFFF)).astype("<u4")
    return [pa.array(found.astype(np.int32)), pa.array(np.full(len(found), block, np.int64)),
            pa.array([low[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary())]


def shared(rows):
    """Of the keys of a bucket those that occur more than once, back to each block that has them."""
    lots = [np.frombuffer(k, "<u4") for k in rows["keys"].to_pylist()]
    values, counts = np.unique(np.concatenate(lots), return_counts=True)
    values = values[counts > 1]
    blocks, out = [], []
    for block, lot in zip(rows["block"].to_pylist(), lots):
        own = np.unique(lot)
        own = own[among(own, values)]
        if len(own):
            blocks.append(block)
            out.append(own.tobytes())
    bucket = rows["bucket"][0].as_py()
    return pa.table([pa.array([bucket] * len(blocks), pa.int32()), pa.array(blocks, pa.int64()), pa.array(out, pa.binary())],
                    ["bucket", "block", "keys"])


def unpacked(rows):
    """All keys that came back to a block, as `short` numbers in order."""
    lots = [np.uint64(b) << np.uint64(32) | np.frombuffer(k, "<u4").astype(np.uint64)
            for b, k in zip(rows["bucket"].to_pylist(), rows["keys"].to_pylist())]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *lots]))


def among(values, known):
    """Which values stand in a sorted list."""
    if not len(known):
        return np.zeros(values.shape, bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values
