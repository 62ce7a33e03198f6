"""A Bloom filter of fixed size: what a table of any length may send to all tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import partitions

FILTER_BITS = 1 << 27  # at most 16 MB, whatever the input; a full filter lets everything pass
BITS_PER_VALUE = 32
_LEAST_BITS = 1 << 10
_CHUNK_BITS = 1 << 19


class Filter:
    """One bit per value, a 64-bit hash; wrong hits only cost work."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 8 - 1)

    def holds(self, values: np.ndarray) -> np.ndarray:
        bits = values & self.mask
        return (self.words[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1

    @classmethod
    def of(cls, values: DataFrame, most: int = FILTER_BITS) -> Filter:
        """From the column h of ``values``: chunks of the filter are filled in tasks, ``most`` bits in all reach the driver."""
        bits = min(max(1 << (values.count() * BITS_PER_VALUE).bit_length(), _LEAST_BITS), most)
        size = min(bits, _CHUNK_BITS)

        def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            chunks: dict[int, np.ndarray] = {}
            for frame in frames:
                at = frame["h"].to_numpy().view(np.uint64) & np.uint64(bits - 1)
                chunk, inside = at // np.uint64(size), at % np.uint64(size)
                for c in np.unique(chunk).tolist():
                    own = inside[chunk == c]
                    words = chunks.setdefault(c, np.zeros(size // 8, dtype=np.uint8))
                    np.bitwise_or.at(words, own >> np.uint64(3), np.uint8(1) << (own & np.uint64(7)).astype(np.uint8))
            yield pd.DataFrame({"chunk": list(chunks), "words": [w.tobytes() for w in chunks.values()]})

        dealt = values.select("h").repartition(partitions(values), F.shiftright(F.col("h").bitwiseAND(bits - 1), size.bit_length() - 1))
        words = np.zeros(bits // 8, dtype=np.uint8)
        for chunk, part in dealt.mapInPandas(fill, "chunk long, words binary").collect():
            words[chunk * size // 8 : (chunk + 1) * size // 8] |= np.frombuffer(part, dtype=np.uint8)
        return cls(words)

    def column(self, value: str) -> Column:
        """Whether the filter may hold a long column."""

        @F.pandas_udf("boolean")
        def held(values: pd.Series) -> pd.Series:
            return pd.Series(self.holds(values.to_numpy().view(np.uint64)))

        return held(value)
