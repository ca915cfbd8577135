"""uid <-> (bucket, bit position) arithmetic of Spark's bitmap functions.

``bitmap_bucket_number`` / ``bitmap_bit_position`` split non-negative ids
into buckets of 32768: id 0 is bucket 0, position 0; for id > 0 the bucket
is ``(id - 1) div 32768 + 1`` and the position ``(id - 1) mod 32768``. One
bucket's bitmap is a fixed 4096-byte binary, bit ``p`` at byte ``p div 8``,
bit ``p mod 8`` counted from the least significant bit.

Ids are unsigned 64-bit numbers held as the BIGINT of the same bits, so ids from
2^63 on are negative there; the arithmetic above goes on into buckets from 2^48 on.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship this module's task-side helper by value: Python workers then need
# numpy and pyarrow only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKET_BITS = 32768
BITMAP_BYTES = BUCKET_BITS // 8


_MAX = (1 << 63) - 1  # all bits of a BIGINT but the sign
_HIGH_BUCKETS = 1 << 48  # buckets of the ids below 2^63 (the last one holds the id 2^63 too)


def bucket_number(uid: Column) -> Column:
    low = F.call_function("bitmap_bucket_number", uid.bitwiseAND(F.lit(_MAX)))
    return low + F.when(uid < 0, F.lit(_HIGH_BUCKETS)).otherwise(F.lit(0))


def bit_position(uid: Column) -> Column:
    low = F.call_function("bitmap_bit_position", uid.bitwiseAND(F.lit(_MAX)))
    # 2^63 itself, whose lower bits are all zero, ends a bucket.
    return F.when((uid < 0) & (uid.bitwiseAND(F.lit(_MAX)) == 0), F.lit(BUCKET_BITS - 1)).otherwise(low)


def unsigned(uid: Column) -> Column:
    """The id as DECIMAL(20,0)."""
    value = uid.cast("decimal(20,0)")
    return F.when(uid < 0, value + F.lit(str(1 << 64)).cast("decimal(20,0)")).otherwise(value).cast("decimal(20,0)")


def construct_agg(position: Column) -> Column:
    return F.call_function("bitmap_construct_agg", position)


# Bitmaps expanded per output batch: 64 x 32768 ids at most (16 MB of ids).
EXPAND_ROWS_PER_BATCH = 64


def expand_bitmap_batches(batches, key_names):
    """``mapInArrow`` body: (keys..., bucket, uids) -> (keys..., uid) rows.

    Vectorized with numpy over a few bitmaps at a time, so memory per
    yielded batch stays bounded whatever the Arrow input batch size.
    """
    import pyarrow as pa

    for batch in batches:
        for start in range(0, batch.num_rows, EXPAND_ROWS_PER_BATCH):
            chunk = batch.slice(start, EXPAND_ROWS_PER_BATCH)
            blobs = chunk.column("uids").to_pylist()
            if any(b is None or len(b) != BITMAP_BYTES for b in blobs):
                raise ValueError("bitmap column holds a value that is not a 4096-byte bitmap")
            bits = np.unpackbits(
                np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(len(blobs), BITMAP_BYTES),
                axis=1,
                bitorder="little",
            )
            rows, pos = np.nonzero(bits)
            bucket = np.asarray(chunk.column("bucket").to_numpy(zero_copy_only=False), dtype=np.int64)
            base = _base(bucket)
            take = pa.array(rows, type=pa.int64())
            cols = [chunk.column(name).take(take) for name in key_names]
            uid = pa.array(base[rows] + pos.astype(np.int64), type=pa.int64())
            yield pa.RecordBatch.from_arrays([*cols, uid], names=[*key_names, "uid"])


# Groups whose positions are sorted together hold about this many ids.
STORE_VALUES_PER_BATCH = 1 << 20


def _base(bucket):
    """Id of position 0 in a bucket, in wrapping 64-bit arithmetic."""
    return np.where(bucket == 0, 0, (bucket - 1) * BUCKET_BITS + 1)


def _row_blocks(lengths, limit):
    """Row ranges of about ``limit`` values; a row with more is alone."""
    ends = np.cumsum(lengths)
    a = 0
    while a < len(lengths):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - lengths[a] + limit, side="right")))
        yield a, b
        a = b


def _stored_form(bitmaps, given, positions, base, sparse_max):
    """(n, bitmap or None, list offsets, ids in the lists, whether listed) of some groups.

    ``bitmaps``: a matrix of 4096 bytes a row for the rows ``given``; ``positions``: (row, position) pairs
    in any order, repeats allowed. All groups are handled as one array; only those above ``sparse_max``
    have a bitmap made for them.
    """
    rows = len(base)
    row, pos = positions
    key = np.unique(row * BUCKET_BITS + pos)
    row, pos = key // BUCKET_BITS, key % BUCKET_BITS
    n = np.bincount(row, minlength=rows)
    has = np.zeros(rows, dtype=bool)
    has[given] = True
    blobs = {}
    if len(given):
        mixed = given[n[given] > 0]  # rows with both forms: their positions go into the bitmap
        if len(mixed):
            place = np.full(rows, -1)
            place[given] = np.arange(len(given))
            own = has[row]
            np.bitwise_or.at(bitmaps, (place[row[own]], pos[own] >> 3), (1 << (pos[own] & 7)).astype(np.uint8))
            row, pos = row[~own], pos[~own]
        n[given] = np.bitwise_count(bitmaps).sum(axis=1)
        few = n[given] <= sparse_max
        blobs = {int(r): bitmaps[i].tobytes() for i, r in enumerate(given) if not few[i]}
        found, at = np.nonzero(np.unpackbits(bitmaps[few], axis=1, bitorder="little"))
        row, pos = np.concatenate([row, given[few][found]]), np.concatenate([pos, at])
        order = np.argsort(row, kind="stable")
        row, pos = row[order], pos[order]
    listed = n <= sparse_max
    first = np.searchsorted(row, np.arange(rows + 1))
    for r in np.flatnonzero(~listed & ~has):
        bits = np.zeros(BUCKET_BITS, dtype=np.uint8)
        bits[pos[first[r] : first[r + 1]]] = 1
        blobs[int(r)] = np.packbits(bits, bitorder="little").tobytes()
    keep = listed[row]
    offsets = np.concatenate([[0], np.cumsum(np.where(listed, n, 0))])
    return n, [blobs.get(r) for r in range(rows)] if blobs else [None] * rows, offsets, base[row[keep]] + pos[keep], listed


def store_batches(batches, key_names, sparse_max, ids=False):
    """``mapInArrow`` body: (keys..., uids, positions) -> (keys..., n, uids, uid_list).

    A group of at most ``sparse_max`` ids becomes its sorted id list, a larger
    one its bitmap, whichever of the two forms (or both, then united) it came in. ``ids``: the
    list holds ids, not positions.
    """
    import pyarrow as pa

    for batch in batches:
        lists = batch.column("positions")
        lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        blob = batch.column("uids").is_valid().to_numpy(zero_copy_only=False)
        # So that at most EXPAND_ROWS_PER_BATCH bitmaps are in a block.
        for a, b in _row_blocks(lengths + blob * (STORE_VALUES_PER_BATCH // EXPAND_ROWS_PER_BATCH), STORE_VALUES_PER_BATCH):
            chunk = batch.slice(a, b - a)
            bucket = chunk.column("bucket").to_numpy(zero_copy_only=False).astype(np.int64)
            base = _base(bucket)
            row = np.repeat(np.arange(b - a), lengths[a:b])
            pos = chunk.column("positions").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if ids:
                pos = pos - base[row]
            given = np.flatnonzero(blob[a:b])
            raw = b"".join(chunk.column("uids").take(pa.array(given)).to_pylist())
            if len(raw) != len(given) * BITMAP_BYTES:
                raise ValueError("bitmap column holds a value that is not a 4096-byte bitmap")
            bitmaps = np.frombuffer(raw, dtype=np.uint8).reshape(len(given), BITMAP_BYTES).copy()
            n, blobs, offsets, found, listed = _stored_form(bitmaps, given, (row, pos), base, sparse_max)
            uid_list = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(found, pa.int64()), mask=pa.array(~listed)
            )
            yield pa.RecordBatch.from_arrays(
                [*[chunk.column(k) for k in key_names], pa.array(n, pa.int64()), pa.array(blobs, pa.binary()), uid_list],
                names=[*key_names, "n", "uids", "uid_list"],
            )
