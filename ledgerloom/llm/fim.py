"""Fill-in-middle: documents cut into prefix, middle and suffix at token places, and put together in another order.

A rolling hash cuts texts into chunks by content, so that shared passages give the same chunks. What a chunk
adds to the count of tokens is kept in a cache by the chunk's own bytes: how many runs of letters and how many
code points it holds, and whether it begins or ends inside a run. Adding these summaries up gives the number
of tokens of a text and the chunk that holds any cut; only that chunk is looked at again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import whole_text
from .hashing import mix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE = 50  # documents in a hundred that are cut
SPM = 80  # of these, in a hundred, those with the suffix first
SEED = 42

CHUNK_BITS = 9  # a chunk is about 2 ** CHUNK_BITS bytes beyond the least
LEAST_CHUNK, MOST_CHUNK = 128, 1 << 14
CACHED_BYTES = 1 << 25  # of chunks, per worker; a full cache is emptied

_SPACES = bytes([32, 9, 10, 11, 12, 13])
_INNER = bytes(range(0x80, 0xC0))  # bytes that begin no code point
_RUN = re.compile(rb"[^\x20\x09-\x0D]+")
_GEAR = mix(np.arange(256, dtype=np.uint64) + np.uint64(1)).astype(np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks of a text: where the hash of the 32 bytes before says so, at least and at most so far apart."""
    if len(data) <= LEAST_CHUNK:
        return [len(data)] if data else []
    rolling = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    for width in (1, 2, 4, 8, 16):  # sums over twice the width; what is older than 32 bytes is shifted out
        rolling[width:] += rolling[:-width] << np.uint32(width)
    marked = np.flatnonzero(rolling >> np.uint32(32 - CHUNK_BITS) == 0) + 1
    ends, last, n = [], 0, len(data)
    while n - last > LEAST_CHUNK:
        k = int(np.searchsorted(marked, last + LEAST_CHUNK))
        last = min(int(marked[k]) if k < len(marked) else n, last + MOST_CHUNK)
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


class Summary(NamedTuple):
    """What a piece of text adds to the counts of the text it lies in."""

    runs: int  # runs of characters other than white space
    chars: int
    open_start: bool  # begins inside a run, if the text before ends inside one
    open_end: bool
    any: bool = True  # false for the empty text alone

    def __add__(self, other: Summary) -> Summary:
        if not self.any or not other.any:
            return other if not self.any else self
        joined = self.open_end and other.open_start
        return Summary(self.runs + other.runs - joined, self.chars + other.chars, self.open_start, other.open_end)

    @property
    def tokens(self) -> int:
        """Tokens, were this the whole text: every run with the white space before it, and white space at the end."""
        return self.runs + (self.any and not self.open_end)


EMPTY = Summary(0, 0, False, False, False)


def summary(data: bytes) -> Summary:
    if not data:
        return EMPTY
    return Summary(len(data.split()), len(data.translate(None, _INNER)), data[0] not in _SPACES, data[-1] not in _SPACES)


class Counter:
    """Summaries of texts by way of their chunks."""

    def __init__(self, most: int = CACHED_BYTES):
        self.known: dict[bytes, Summary] = {}
        self.most, self.size, self.hits = most, 0, 0

    def of(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)  # equal bytes, not equal hashes alone
        if found is None:
            if self.size > self.most:
                self.known.clear()
                self.size = 0
            found = self.known[chunk] = summary(chunk)
            self.size += len(chunk)
        else:
            self.hits += 1
        return found

    def places(self, data: bytes, wanted) -> tuple[int, list[tuple[int, int]]]:
        """The number of tokens n, and (byte, code point) after each number of tokens in ``wanted(n)``, which rises."""
        starts, before, total, at = [], [], EMPTY, 0
        for end in chunk_ends(data):
            starts.append(at)
            before.append(total)
            total = total + self.of(data[at:end])
            at = end
        n, found, k = total.tokens, [], 0
        for units in wanted(n):
            if units == 0:
                found.append((0, 0))
            elif units >= n:
                found.append((len(data), total.chars))
            else:
                # the last chunk before whose end the run number ``units`` has begun
                while k + 1 < len(before) and before[k + 1].runs < units:
                    k += 1
                found.append(self._within(data, starts[k], before[k], units))
        return n, found

    @staticmethod
    def _within(data: bytes, start: int, before: Summary, units: int) -> tuple[int, int]:
        """Where the run number ``units``, which begins in the chunk at ``start``, ends; it may reach into later chunks."""
        left = units - before.runs
        for run in _RUN.finditer(data, start):
            left -= not (run.start() == start and before.open_end)
            if left == 0:
                return run.end(), before.chars + len(data[start : run.end()].translate(None, _INNER))
        raise AssertionError("summaries and text differ")


@dataclass(frozen=True)
class Rule:
    seed: int = SEED
    rate: int = RATE
    spm: int = SPM


class Cut(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def transform(text: str, doc_id: str, counter: Counter, rule: Rule = Rule()) -> Cut:
    """One document in its form: plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle)."""
    digest = hashlib.sha256(f"{rule.seed}:{doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    data = text.encode()
    plain = not data or h[2] % 100 >= rule.rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    n, cuts = counter.places(data, lambda n: [] if plain else sorted((h[0] % (n + 1), h[1] % (n + 1))))
    if plain:
        return Cut(n, "plain", None, None, text)
    (a, a_chars), (b, b_chars) = cuts
    prefix, middle, suffix = data[:a].decode(), data[a:b].decode(), data[b:].decode()
    if h[3] % 100 < rule.spm:
        return Cut(n, "spm", a_chars, b_chars - a_chars, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
    return Cut(n, "psm", a_chars, b_chars - a_chars, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")


_counter = Counter()  # of this Python worker, which runs many tasks


def _cuts(rule: Rule):
    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def cut(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in columns:
            frame = pd.DataFrame([transform(t, i, _counter, rule) for i, t in zip(ids, texts)], columns=list(Cut._fields))
            yield frame.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    return cut


def fill_in_middle(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The columns of ``docs`` in ``row``, and ``fim``: n, form, prefix_chars, middle_chars, output.

    Tokens are runs of characters other than ASCII white space, each with the white space before it, and white space at
    the end. A null text counts as empty; an empty text, and one that holds a mark, stays plain and has null
    for prefix_chars and middle_chars. What is done to a document depends on its id and text alone: repeated rows come
    out alike, a missing id counts as the empty string. An empty table gives no row.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    ids = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    return docs.select(row, _cuts(rule)(ids, whole_text(docs)).alias("fim"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of. The parts hold no mark, so the marks in an output are those put in."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, third = F.get(part, F.lit(1)), F.get(part, F.lit(2)), F.get(part, F.lit(3))
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, third, second)).otherwise(F.concat(second, third, first))


def report(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 (see ``fill_in_middle``)."""
    done = fill_in_middle(docs.select("doc_id", "text"), rule)
    output, form = F.col("fim.output"), F.col("fim.form")
    return done.select(
        F.col("row.doc_id").alias("doc_id"), "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2(output, 256).alias("output_sha256"), F.sha2(restore(output, form), 256).alias("restored_sha256"),
    )
