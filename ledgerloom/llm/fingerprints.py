"""Document fingerprints: the k smallest shingle hashes of a text.

Sketches of parts merge into the sketch of the whole, and two of them estimate resemblance, containment
and the number of distinct shingles.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import id_key, partitions, whole_text
from .hashing import lower_bytes, shingle_sets

SKETCH_SIZE = 128
SHINGLE_WORDS = 5


@dataclass(frozen=True)
class Sketch:
    """The ``size`` smallest of a set of 64-bit hashes, sorted; fewer hashes are the whole set."""

    hashes: np.ndarray
    size: int = SKETCH_SIZE

    @classmethod
    def of(cls, hashes: np.ndarray, size: int = SKETCH_SIZE) -> Sketch:
        return cls(hashes[:size], size)  # the hashes come sorted and distinct

    def merge(self, other: Sketch) -> Sketch:
        return Sketch(np.union1d(self.hashes, other.hashes)[: min(self.size, other.size)], min(self.size, other.size))

    @property
    def whole(self) -> bool:
        return len(self.hashes) < self.size

    def distinct(self) -> float:
        """Estimated number of distinct shingles."""
        return float(len(self.hashes)) if self.whole else (self.size - 1) / ((float(self.hashes[-1]) + 1.0) / 2.0**64)

    def resemblance(self, other: Sketch) -> float:
        """Estimated Jaccard similarity; two empty sets are alike."""
        union = self.merge(other).hashes
        if not len(union):
            return 1.0
        both = np.intersect1d(self.hashes, other.hashes, assume_unique=True)
        return float(np.count_nonzero(both <= union[-1])) / len(union)

    def containment(self, other: Sketch) -> float:
        """Estimated share of this set that is in the other one; an empty set is in any."""
        own = self.distinct()
        return min(self.resemblance(other) * self.merge(other).distinct() / own, 1.0) if own else 1.0

    def text(self) -> str:
        return base64.b64encode(self.hashes.astype(">u8").tobytes()).decode()

    @classmethod
    def parse(cls, text: str, size: int = SKETCH_SIZE) -> Sketch:
        return cls(np.frombuffer(base64.b64decode(text), dtype=">u8").astype(np.uint64), size)


def sketches(texts: list[str], size: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> list[Sketch]:
    """Sketches of the texts' shingles: words as in ``hashing.word_hashes``, A-Z in lower case.

    Equal texts have equal sketches; a text without words has an empty one.
    """
    return [Sketch.of(s.copy(), size) for s in shingle_sets(lower_bytes(texts), words)]


def fingerprint(docs: DataFrame, size: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint (base64 of the sorted hashes) and distinct_shingles of every row; a null text is empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = sketches(frame["text"].tolist(), size, words)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "fingerprint": [s.text() for s in found], "distinct_shingles": [s.distinct() for s in found]})

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text")).mapInPandas(
        run, "doc_id long, fingerprint string, distinct_shingles double"
    )


def _edited(text: str, following: str) -> str:
    tail = len(text) // 3
    return text[: len(text) - tail] + following[:tail]


def _compare(size: int, words: int, slice_rows: int = 256):
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "containment", "distinct_shingles"]

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """(row, the next row of the same range) in order."""
        before = None
        for frame in frames:
            for row in zip(frame["part"], frame["guest"], frame["doc_id"].astype("Int64"), frame["text"]):
                if before is not None and before[0] == row[0]:
                    yield before, row
                before = row

    def report(chunk: list[tuple]) -> pd.DataFrame:
        texts = [own[3] for own, _ in chunk] + [chunk[-1][1][3]]
        edited = [_edited(own[3], following[3]) for own, following in chunk]
        plain, changed = sketches(texts, size, words), sketches(edited, size, words)
        rows = []
        for i, (own, following) in enumerate(chunk):
            # inside a chunk the next row is the next pair's own row, but for a range's end
            after = plain[i + 1] if texts[i + 1] is following[3] else sketches([following[3]], size, words)[0]
            digest = hashlib.sha256(edited[i].encode()).hexdigest()
            rows.append((own[2], len(own[3]), digest, plain[i].text(), changed[i].text(), plain[i].resemblance(changed[i]), plain[i].resemblance(after), plain[i].containment(changed[i]), plain[i].distinct()))
        return pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk: list[tuple] = []
        for own, following in pairs(frames):
            if own[1] == 1:
                continue  # a guest has its own report in the range it comes from
            chunk.append((own, following))
            if len(chunk) == slice_rows:
                yield report(chunk)
                chunk = []
        if chunk:
            yield report(chunk)

    return run


def edit_report(docs: DataFrame, size: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last floor(n_chars / 3) code points replaced by as many first ones (or all) of
    the next document in descending doc_id, after the last one the first. near_edited compares the two,
    near_next the text with the next document's; containment is the estimated share of the text's shingles
    in the edited text. Rows with one doc_id follow each other by text, a null doc_id comes last, a null
    text is empty. A single row is its own next. An empty table gives no row.

    Rows are dealt to ranges of ids whose bounds are ids of the table; the first row of each range is also
    sent, as a guest, to the range before it. Only the bounds, one id per range, reach the driver.
    """
    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), id_key(docs).alias("key"), whole_text(docs).alias("text"))
    parts = partitions(docs)
    ids = keyed.select("key").repartitionByRange(parts, F.col("key").desc())
    tops = sorted({r[1] for r in ids.groupBy(F.spark_partition_id()).agg(F.max("key")).collect()}, reverse=True)
    bounds = np.array(tops[::-1], dtype=np.int64)  # ascending; range i holds ids up to tops[i], above tops[i + 1]

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series((len(bounds) - 1 - np.searchsorted(bounds, key.to_numpy(), side="left")).clip(min=0), dtype="int32")

    dealt = keyed.withColumn("part", part_of("key"))
    # rows with a bound's id: the first of them by text is the first row of its range
    top_rows = docs.sparkSession.createDataFrame([(int(t),) for t in tops], "key long")  # one per range
    firsts = keyed.join(F.broadcast(top_rows), "key", "left_semi")
    guests = firsts.groupBy("key").agg(F.min("text").alias("text"))
    home = part_of("key")
    before = F.when(home == 0, F.lit(max(len(tops) - 1, 0))).otherwise(home - 1)
    guests = guests.select(F.lit(None).cast("long").alias("doc_id"), "key", "text", before.cast("int").alias("part"), F.lit(1).alias("guest"))
    rows = dealt.withColumn("guest", F.lit(0)).select("doc_id", "key", "text", "part", "guest").union(guests)
    ordered = rows.repartitionById(parts, F.col("part")).sortWithinPartitions(F.col("part"), F.col("guest"), F.col("key").desc(), F.col("text"))
    return ordered.select("part", "guest", "doc_id", "text").mapInPandas(
        _compare(size, words),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, containment double, distinct_shingles double",
    )
