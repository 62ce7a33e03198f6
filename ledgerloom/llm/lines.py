"""Line dedup: decide which repeated lines of each document stay, as compressed bitmaps.

The hashes of the long lines are range-partitioned with document and position as secondary sort
order, so that even a line found in a third of all documents is spread over many partitions. Each
partition is streamed once: the first document met for a hash, the one with the largest id, keeps the
line. Only the first and the last hash of a partition can go on in another one; their rows wait for
totals that come from at most two rows per partition.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import as_row, id_key, partitions, whole_text, with_text

MIN_CHARS = 40
MIN_DOCUMENTS = 5
SPACES = " \t\n\x0b\x0c\r"

_LINES = "hi long, lo long, doc long, version long, position int"
_DECIDED = "kind int, hi long, lo long, doc long, version long, position long"
_DROP, _WAITING, _EDGE = 0, 1, 2


def line_key(line: str) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(SPACES).encode().lower()


def _long_lines(min_chars: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, doc, version, place = [], [], [], []
            for d, v, text in zip(frame["doc"], frame["version"], frame["text"]):
                for i, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(line.strip(SPACES)) >= min_chars:
                        keys.append(xxhash.xxh3_128_digest(line_key(line)))
                        doc.append(d)
                        version.append(v)
                        place.append(i)
            both = np.frombuffer(b"".join(keys), dtype=">i8").astype(np.int64).reshape(-1, 2)
            longs = {"hi": both[:, 0], "lo": both[:, 1], "doc": np.array(doc, np.int64), "version": np.array(version, np.int64)}
            yield pd.DataFrame({**longs, "position": np.array(place, np.int32)})

    return run


def _starts(frame: pd.DataFrame) -> np.ndarray:
    """Where each hash of a sorted frame begins."""
    hi, lo = frame["hi"].to_numpy(), frame["lo"].to_numpy()
    return np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))


def _rows(kind: int, frame: pd.DataFrame) -> pd.DataFrame:
    return frame.assign(kind=np.int32(kind), position=frame["position"].astype(np.int64))[["kind", "hi", "lo", "doc", "version", "position"]]


def _decide(min_documents: int):
    def edge(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """A hash at an end of the partition: its rows wait, its documents are reported."""
        yield _rows(_WAITING, frame)
        top = frame.iloc[:1].assign(position=frame["doc"].nunique())
        yield _rows(_EDGE, top)

    def inside(frame: pd.DataFrame) -> pd.DataFrame:
        starts, doc = _starts(frame), frame["doc"].to_numpy()
        fresh = np.ones(len(doc), dtype=bool)
        fresh[1:] = doc[1:] != doc[:-1]
        fresh[starts] = True
        documents = np.add.reduceat(fresh.astype(np.int64), starts)
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(doc))))
        return _rows(_DROP, frame[(documents[of] >= min_documents) & (doc != doc[starts][of])])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the last hash met so far
        begun = False  # the first hash is behind
        for frame in frames:
            if not len(frame):
                continue
            last = _starts(frame)[-1]
            if held and last == 0 and tuple(held[0].iloc[0][["hi", "lo"]]) == tuple(frame.iloc[0][["hi", "lo"]]):
                held.append(frame)
                continue
            ready = pd.concat([*held, frame.iloc[:last]], ignore_index=True)
            held = [frame.iloc[last:]]
            if len(ready) and not begun:
                cut = np.append(_starts(ready), len(ready))[1]
                yield from edge(ready.iloc[:cut])
                ready, begun = ready.iloc[cut:], True
            if len(ready):
                yield inside(ready)
        if held:
            yield from edge(pd.concat(held, ignore_index=True))

    return run


def _pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        maps = []
        for places in frame["places"]:
            keep = np.ones(max(places) // 8 * 8 + 8, dtype=np.uint8)
            keep[np.asarray(places)] = 0
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pd.DataFrame({"doc": frame["doc"], "version": frame["version"], "bitmap": maps})


def _versions(docs: DataFrame) -> DataFrame:
    keyed = docs.select(as_row(docs), id_key(docs).alias("doc"), whole_text(docs).alias("whole"))
    return keyed.withColumn("version", F.xxhash64("whole"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc, version, bitmap) of the documents that lose lines.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z in lower case. Keys of at
    least ``min_chars`` code points found in at least ``min_documents`` documents stay only in the
    largest doc_id holding them, there with all their lines. ``bitmap`` is zlib-compressed, one bit per
    line up to the byte of the last one dropped, 1 for keep. ``version`` (xxhash64 of the text) tells apart rows that
    share a doc_id: they count as one document, and exact repeats get the same bitmap. A null text is
    empty, a null doc_id is the smallest id. Other columns are not read; an empty table gives no row.
    """
    versions = _versions(docs).select("doc", "version", F.col("whole").alias("text")).filter(F.length("text") >= min_chars)
    lines = versions.mapInPandas(_long_lines(min_chars), _LINES)
    order = [F.col("hi"), F.col("lo"), F.col("doc").desc()]
    spread = lines.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order, "version", "position")
    decided = materialise(spread.mapInPandas(_decide(min_documents), _DECIDED), "lines")
    # at most two rows per partition
    totals = decided.filter(F.col("kind") == _EDGE).groupBy("hi", "lo").agg(F.sum("position").alias("documents"), F.max("doc").alias("top"))
    repeated = F.broadcast(totals.filter(F.col("documents") >= min_documents))
    late = decided.filter(F.col("kind") == _WAITING).join(repeated, ["hi", "lo"]).filter("doc <> top")
    drops = decided.filter(F.col("kind") == _DROP).select("doc", "version", "position").union(late.select("doc", "version", "position"))
    places = drops.groupBy("doc", "version").agg(F.collect_set(F.col("position").cast("int")).alias("places"))
    return places.mapInPandas(_pack, "doc long, version long, bitmap binary")


def dropped_lines(bitmap: bytes | None) -> set[int]:
    """Line numbers that a bitmap drops."""
    if bitmap is None:
        return set()
    return set(np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8)) == 0).tolist())


def _kept(text: str, bitmap: bytes | None) -> tuple[int, int, str]:
    """Lines before, lines dropped, what stays."""
    lines = text.split("\n")
    gone = dropped_lines(bitmap)
    return len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text


def _marked(docs: DataFrame, **limits: int) -> DataFrame:
    return _versions(docs).join(keep_bitmaps(docs, **limits), ["doc", "version"], "left")


def drop_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """``docs`` with the lines that ``keep_bitmaps`` keeps, joined by \\n; every row and column stays.

    ``n_chars``, where there is one, follows the text. A null text without dropped lines stays null.
    """

    @F.pandas_udf("string")
    def kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
        return pd.Series([_kept(t, b)[2] for t, b in zip(text, bitmap)], dtype=object)

    marked = _marked(docs, **limits)
    text = F.when(F.col("bitmap").isNull(), F.col("row.text")).otherwise(kept("whole", "bitmap"))
    renewed = marked.select("row", text.alias("kept"))
    return renewed.select(*with_text(F.col("row"), docs.columns, F.col("kept")))


def line_report(docs: DataFrame, **limits: int) -> DataFrame:
    """doc_id, n_lines before, n_dropped, kept_sha256 of every document (see ``keep_bitmaps``)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [_kept(t, b) for t, b in zip(frame["whole"], frame["bitmap"])]
            digests = [hashlib.sha256(x[2].encode()).hexdigest() for x in out]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_lines": [x[0] for x in out], "n_dropped": [x[1] for x in out], "kept_sha256": digests})

    marked = _marked(docs, **limits).select(F.col("row.doc_id").cast("long").alias("doc_id"), "whole", "bitmap")
    return marked.mapInPandas(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
