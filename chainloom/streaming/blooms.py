"""Bloom filters of the keys of each batch, so that a key check opens only batches that can hold its keys.

A filter has 32 bits a key and sets eight of them, so a key that a batch does not have is taken for one of its keys
about six times in a million, and never the other way round. A large batch has a filter for each million of its
rows in a task, of at most 4 MB.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS, HASHES, PART = 32, 8, 1_000_000
BLOOM = T.StructType([T.StructField("bits", T.BinaryType())])
# A check of more keys than this reads every batch: it would open most of them anyway.
MOST_KEYS = 100_000


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).alias("h")


def _places():
    """A function to the bits of all keys, one of each key at a time; made here, so that tasks need no copy of this
    package."""
    count = HASHES

    def places(hashes, size: int) -> Iterator:
        import numpy as np

        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for i in range(count):
            yield ((hashes + np.uint64(i) * step) ^ (hashes >> np.uint64(29))) & np.uint64(size - 1)

    return places


def bloom_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The filters of the keys of `rows`: a row for every million of a task."""
    places, bits_each, part = _places(), BITS, PART

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def made(held: list) -> pa.RecordBatch:
            hashes = np.concatenate(held)
            size = 1 << max(6, int(len(hashes) * bits_each - 1).bit_length())
            bits = np.zeros(size, bool)
            for place in places(hashes, size):
                bits[place] = True
            return pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

        held, count = [], 0
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(hashes), part):
                if count and count + len(hashes[at : at + part]) > part:
                    yield made(held)
                    held, count = [], 0
                held.append(hashes[at : at + part])
                count += len(held[-1])
        if count:
            yield made(held)

    return rows.select(key_hash(keys)).mapInArrow(build, BLOOM)


def may_hold(blooms: DataFrame, hashes: Sequence[int]) -> list[int]:
    """The batches (batch, bits) of which a filter has one of the hashes."""
    places, wanted = _places(), list(hashes)

    def probe(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        keys = np.array(wanted, np.int64).view(np.uint64)
        for batch in batches:
            hits = []
            for number, bits in zip(*(c.to_pylist() for c in batch.columns)):
                raw = np.frombuffer(bits, np.uint8)
                found = np.ones(len(keys), bool)
                for place in places(keys, len(raw) * 8):
                    found &= (raw[place >> np.uint64(3)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1
                if found.any():
                    hits.append(number)
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.int64())], names=["batch"])

    return sorted(r[0] for r in blooms.select("batch", "bits").mapInArrow(probe, "batch long").distinct().collect())
