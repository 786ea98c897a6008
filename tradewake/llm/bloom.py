"""A Bloom filter of fixed size over long keys, built by Spark and sent to every task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm.words import mixed

BITS = 1 << 23
_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7))


def _places(keys: np.ndarray) -> list[np.ndarray]:
    return [mixed(keys.view(np.uint64) + seed) & np.uint64(BITS - 1) for seed in _SEEDS]


def build(keys: DataFrame) -> np.ndarray:
    """The filter (BITS bits, 1 MiB) of a frame's only column of longs; nulls are left out.

    Tasks turn keys into bit positions, Spark ors them by 64-bit word, and at most BITS / 64 words come to the driver:
    the size does not depend on the data. More keys only make more false positives, never a miss.
    """

    def words(batches):
        import pyarrow as pa

        for batch in batches:
            got = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(got):
                place = np.unique(np.concatenate(_places(got)))
                word = (place >> np.uint64(6)).astype(np.int64)
                bit = (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit)], names=["word", "bits"])

    rows = keys.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(BITS // 64, np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter."""
    found = np.ones(len(keys), bool)
    for place in _places(keys):
        found &= (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found
