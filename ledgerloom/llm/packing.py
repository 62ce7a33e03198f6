"""Packing: token sequences of equal attention cost and little padding.

Documents are tokenised once and cut into pieces of at most one sequence. Pieces are dealt to groups of
about ``DOCUMENTS_PER_GROUP`` documents; inside a group, in descending order of length, a piece goes to
the sequence with the lowest estimated cost (linear plus quadratic in the lengths) that has room for it.
A piece that fits nowhere is cut over the roomiest sequences.
"""

from __future__ import annotations

import heapq
import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import whole_text

SEQUENCE_TOKENS = 2048
DOCUMENTS_PER_GROUP = 1024
END_ID = 1  # ends every document
QUADRATIC = 1.0 / 4096  # cost of a token pair within a piece, against 1 for a token
CACHED_CHUNKS = 300_000  # per worker; of a full cache only the chunks that come up again are kept
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks; the apostrophe begins pre-tokens of its own
# fixed: how the tokenizer splits texts
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# the byte-level step shows printable bytes as themselves, the others as the characters from 256 on
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_PACK = [struct.Struct(f"<{n}H").pack for n in range(32)]

_PIECES = "group long, doc_id long, row long, start long, tokens long, doc_tokens long, ids binary"
_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Chunks(dict):
    """Ids by chunk; those of a new one are learned when it is asked for."""

    def __init__(self, learn: Callable[[str], bytes]):
        self.learn = learn

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self.learn(chunk)
        return ids


class ChunkEncoder:
    """Token ids of texts as little-endian uint16, from a cache of chunks and of their words.

    The tokenizer drops white space and never joins over it, so ids of a text are the ids of its chunks
    between spaces and line ends. Nor does it join letters with marks: a chunk of letters with ASCII marks
    at its end has the ids of the word, then those of the marks. Words of Latin letters go to the
    tokenizer's model directly, in the form its byte-level step gives them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path) as file:
            made = json.load(file)
        steps = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
        split = [(p["type"], p.get("pattern")) for p in (made["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if steps != ["NFC", "Replace", "Lowercase"] or split != [("Split", {"Regex": SPLIT}), ("ByteLevel", None)]:
            raise ValueError("the tokenizer must lower-case, drop white space and split like the one this encoder is made for")
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit into 16 bits")
        self.model = self.tokenizer.model
        self.chunks = Chunks(self._learn)  # a chunk's word and marks stand here as chunks of their own
        self.older: dict[str, bytes] = {}  # the cache before, which filled up

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}H", *ids)

    def _encode(self, word: str) -> bytes:
        """Ids of a part of a chunk that is pre-tokens of its own."""
        plain = word.lower()
        if word.isascii() and word.isalpha():
            return self._packed([t.id for t in self.model.tokenize(plain)])
        if word.isalpha() and plain.isalpha() and max(word) < "\u0180":  # one pre-token, in lower case too
            shown = plain if plain.isascii() else plain.encode().decode("latin-1").translate(_SHOWN)
            return self._packed([t.id for t in self.model.tokenize(shown)])
        return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _learn(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is not None:
            return ids
        if chunk.isascii() and chunk.isalpha():
            word = chunk.lower()
            return self._encode(chunk) if word == chunk else self.chunks[word]
        stem = chunk.rstrip(MARKS)
        word = stem.lower()
        # letters that the tokenizer's first step takes apart end in a mark, which joins those after them
        if not (stem.isalpha() and word.isalpha() and (stem.isascii() or unicodedata.is_normalized("NFC", stem))):
            stem = word = chunk
        elif not stem.isascii():
            word = stem
        if word == chunk:
            return self._encode(chunk)
        ids = self.chunks[word]
        return ids + self.chunks[chunk[len(stem) :]] if len(stem) < len(chunk) else ids

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.chunks) > CACHED_CHUNKS:
            self.chunks, self.older = Chunks(self._learn), self.chunks
        known = self.chunks.__getitem__
        for text in texts:
            yield b"".join(map(known, text.replace("\n", " ").split(" ")))


_encoders: dict[str, ChunkEncoder] = {}  # of this Python worker, which runs many tasks


def encoder_of(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def _cut(path: str, sequence: int, groups: int):
    """Pieces of whole sequences and the remainder of every document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end, at = encoder_of(path), np.array([END_ID], dtype="<u2").tobytes(), 0
        for whole in frames:
            for first in range(0, len(whole), 256):
                frame, rows = whole.iloc[first : first + 256], []
                for key, doc, ids in zip(frame["key"], frame["doc_id"].astype("Int64"), encoder.encode(frame["text"].tolist())):
                    ids, at = ids + end, at + 1
                    tokens = len(ids) // 2
                    for start in range(0, tokens, sequence):
                        part = ids[2 * start : 2 * (start + sequence)]
                        # the running number spreads repeated rows; a task that runs again counts the same
                        rows.append(((key + at + start // sequence) % groups, doc, at, start, len(part) // 2, tokens, part))
                yield pd.DataFrame(rows, columns=["group", "doc_id", "row", "start", "tokens", "doc_tokens", "ids"])

    return run


def crc_of(ids: bytes) -> int:
    """CRC of little-endian uint16 ids written as uint32."""
    return zlib.crc32(np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes())


def place(lengths: list[int], sequence: int = SEQUENCE_TOKENS, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(piece, start within it, length, sequence, offset) for pieces in descending order of length.

    As many sequences are opened as the tokens need. Sequences wait in a heap by cost; those without
    room for a piece are passed over, and as pieces only get shorter they are looked at again.
    """
    count = -(-sum(lengths) // sequence)
    used, cost = [0] * count, [0.0] * count
    heap = [(0.0, s) for s in range(count)]
    out: list[tuple[int, int, int, int, int]] = []

    def put(piece: int, start: int, length: int, s: int) -> None:
        out.append((piece, start, length, s, used[s]))
        used[s] += length
        cost[s] += length + quadratic * length * length

    cutting: list[tuple[int, int]] = []
    for piece, length in enumerate(lengths):
        passed = []
        while heap and used[heap[0][1]] + length > sequence:
            passed.append(heapq.heappop(heap))
        if heap:
            s = heapq.heappop(heap)[1]
            put(piece, 0, length, s)
            if used[s] < sequence:
                heapq.heappush(heap, (cost[s], s))
        else:
            cutting.append((piece, length))
        for entry in passed:
            if used[entry[1]] < sequence:
                heapq.heappush(heap, entry)
    room = sorted((used[s], s) for s in range(count) if used[s] < sequence)
    for piece, length in cutting:
        start = 0
        while start < length:
            s = room[0][1]
            part = min(length - start, sequence - used[s])
            put(piece, start, part, s)
            start += part
            if used[s] == sequence:
                room.pop(0)
    return out


def _pack(sequence: int, quadratic: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # rows may arrive in any order; the content decides between rows of one id
        frame = frame.assign(crc=[zlib.crc32(ids) for ids in frame["ids"]])
        frame = frame.sort_values(["tokens", "doc_id", "start", "row", "crc"], ascending=[False, True, True, True, True], ignore_index=True)
        base = int(frame["group"].iloc[0]) << 32
        pieces = list(zip(frame["doc_id"].astype("Int64"), frame["start"], frame["doc_tokens"], frame["ids"]))
        rows = []
        for piece, start, length, s, offset in place(frame["tokens"].tolist(), sequence, quadratic):
            doc, at, tokens, ids = pieces[piece]
            rows.append((doc, at + start, length, crc_of(ids[2 * start : 2 * (start + length)]), tokens, base + s, offset))
        packed = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        return packed.astype({"doc_id": "Int64"})

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    sequence: int = SEQUENCE_TOKENS,
    documents_per_group: int = DOCUMENTS_PER_GROUP,
    quadratic: float = QUADRATIC,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document, with id 1 at its end, lies in exactly one chain of pieces; every sequence is filled
    from offset 0 without gaps, and in each group all but the last few are full. A null or empty text is
    the end id alone. Rows that share a doc_id, and rows without one, are separate documents. Other
    columns are not read; an empty table gives no row. ``tokenizer_path`` must exist on every executor.
    """
    groups = max(-(-docs.count() // documents_per_group), 1)
    text = whole_text(docs)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.pmod(F.xxhash64(docs["doc_id"], text), F.lit(1 << 40)).alias("key"))
    pieces = rows.mapInPandas(_cut(tokenizer_path, sequence, groups), _PIECES)
    return pieces.groupBy("group").applyInPandas(_pack(sequence, quadratic), _PACKED)
