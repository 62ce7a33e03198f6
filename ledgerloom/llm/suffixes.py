"""Suffix-array dedup: every byte covered by a 200-byte string that starts somewhere else too is removed.

The suffix array is sparse. A window of ``LENGTH`` bytes is represented by its minimizer, the gram in it
with the smallest hash, so equal windows hold equal grams at equal offsets; only suffixes that start at
minimizers whose gram occurs twice are sorted. Each task sorts its suffixes into runs, front-codes them
and sends every range of them to one merging task, where a loser tree that keeps common-prefix lengths
combines the runs: known prefixes are never compared again.

Suffixes with equal surroundings form a class. A gram of one class settles its windows: they repeat.
Where a gram has several classes, the windows in question are compared by hash, one class for all its
members, and only as far as the neighbours in suffix order leave it open. Grams with very many suffixes
are dealt by class to many tasks; the windows that no task settles alone are counted by a grouped aggregate.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import as_row, id_key, partitions, whole_text, with_text
from .filters import Filter
from .hashing import BATCH_BYTES, Substrings, batches
from .jaccard import _groups

LENGTH = 200
GRAM = 24
HOT_SUFFIXES = 2_000  # a gram with more suffixes is dealt to many tasks
RUN_ROWS = 20_000  # suffixes sorted together
HOT_BITS = 1 << 23
TARGETS_PER_PARTITION = 6  # ranges merged one after the other in a task, so that it holds only one
SAMPLED_GRAMS = 20_000  # most grams the range bounds are taken from
SEGMENT = 1 << 22  # bytes of a long text that are hashed at a time

_SPAN = LENGTH - GRAM + 1  # grams of a window, and the most bytes before its minimizer plus one
_KEY = LENGTH + 9  # suffix, its length, hash of what stands before it


def minimizers(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, place, first window, last window) of the minimizers of texts laid end to end.

    ``ends`` are the texts' ends. A minimizer stands for a run of windows, given by their starts. Of equal
    hashes the leftmost counts, so the choice depends on a window's bytes alone.
    """
    none = np.zeros(0, dtype=np.int64)
    n = len(data) - GRAM + 1
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none, none
    at = np.arange(n)
    hashes = Substrings(data).hashes(at, at + GRAM)
    keyed = (hashes & ~np.uint64((1 << 24) - 1)) | at.astype(np.uint64)
    pad = -n % _SPAN
    grid = np.concatenate((keyed, np.full(pad, np.iinfo(np.uint64).max))).reshape(-1, _SPAN)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - LENGTH + 1
    place = (np.minimum(behind[:windows], ahead[_SPAN - 1 : _SPAN - 1 + windows]) & np.uint64((1 << 24) - 1)).astype(np.int64)
    start = np.arange(windows)
    own_end = ends[np.searchsorted(ends, start, side="right")]
    valid = start + LENGTH <= own_end
    start, place, own_end = start[valid], place[valid], own_end[valid]
    if not len(start):
        return none.astype(np.uint64), none, none, none
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (own_end[1:] != own_end[:-1])))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return hashes[place[first]], place[first], start[first], start[last]


def anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the text, gram hash, place, first and last window) of all minimizers, places within the texts."""
    for a, b in batches(texts):
        if b - a > 1 or len(texts[a]) <= SEGMENT:
            sizes = np.array([len(t) for t in texts[a:b]])
            ends = np.cumsum(sizes)
            hashes, *places = minimizers(np.frombuffer(b"".join(texts[a:b]), dtype=np.uint8), ends)
            of = np.searchsorted(ends, places[0], side="right")
            yield of + a, hashes, *[p - (ends - sizes)[of] for p in places]
            continue
        whole, found = np.frombuffer(texts[a], dtype=np.uint8), []
        for start in range(0, len(whole) - LENGTH + 1, SEGMENT):
            part = whole[start : start + SEGMENT + LENGTH - 1]
            hashes, *places = minimizers(part, np.array([len(part)]))
            found.append((hashes, *[p + start for p in places]))
        hashes, place, first, last = (np.concatenate(x) for x in zip(*found))
        # a run of windows cut by a segment's end is one run
        new = np.concatenate(([True], place[1:] != place[:-1]))
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(place)) - 1
        yield np.full(len(begin), a), hashes[begin], place[begin], first[begin], last[end]


def _grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Gram hashes of the minimizers; a gram in a thousand comes with its bytes."""
    for frame in frames:
        texts = [t.encode() for t in frame["text"]]
        for of, hashes, place, _, _ in anchors(texts):
            head = np.full(len(hashes), None, dtype=object)
            for i in np.flatnonzero(hashes & np.uint64(1023) == 0).tolist():
                head[i] = texts[of[i]][place[i] : place[i] + GRAM]
            yield pd.DataFrame({"h": hashes.view(np.int64), "head": head})


_RUN = "target int, shared binary, tails binary, before_sizes binary, before binary, counts binary, members binary"
_MEMBER = np.dtype([("doc", "<i8"), ("version", "<i8"), ("place", "<i8"), ("far", "<i2"), ("near", "<i2")])


def front_coded(classes: list[tuple[bytes, bytes, list[tuple]]]) -> dict[str, bytes]:
    """One sorted run of (key, bytes before, members), each key without what it shares with the key before."""
    keys = np.frombuffer(b"".join(k for k, _, _ in classes), dtype=np.uint8).reshape(-1, _KEY)
    shared = np.zeros(len(classes), dtype=np.uint8)
    shared[1:] = (keys[1:] != keys[:-1]).argmax(axis=1)
    members = [m for _, _, own in classes for m in own]
    return {
        "shared": shared.tobytes(),
        "tails": b"".join(k[s:] for (k, _, _), s in zip(classes, shared.tolist())),
        "before_sizes": np.array([len(b) for _, b, _ in classes], dtype=np.uint8).tobytes(),
        "before": b"".join(b for _, b, _ in classes),
        "counts": np.array([len(own) for _, _, own in classes], dtype="<u4").tobytes(),
        "members": np.array(members, dtype=_MEMBER).tobytes(),
    }


class Run:
    """A decoded run: keys, common prefixes with the key before, bytes before, members."""

    def __init__(self, shared: bytes, tails: bytes, before_sizes: bytes, before: bytes, counts: bytes, members: bytes):
        self.shared = np.frombuffer(shared, dtype=np.uint8).tolist()
        self.keys, key, at = [], b"", 0
        for common in self.shared:
            key = key[:common] + tails[at : at + _KEY - common]
            at += _KEY - common
            self.keys.append(key)
        stops = np.concatenate(([0], np.cumsum(np.frombuffer(before_sizes, dtype=np.uint8), dtype=np.int64))).tolist()
        self.before = [before[a:b] for a, b in zip(stops, stops[1:])]
        stops = np.concatenate(([0], np.cumsum(np.frombuffer(counts, dtype="<u4"), dtype=np.int64))).tolist()
        every = np.frombuffer(members, dtype=_MEMBER)
        self.members = [every[a:b] for a, b in zip(stops, stops[1:])]


def merged(keys: list[list[bytes]], shared: list[list[int]]) -> Iterator[tuple[int, int, int]]:
    """(run, index in it, prefix shared with the key put out before) in key order, by a loser tree.

    Each contender carries the prefix it shares with the last key put out. The longer prefix is the smaller
    key; only equal prefixes lead to a comparison, and that begins behind the prefix. A loser keeps the
    prefix it shares with the key that beat it, which is the last one put out when it plays again.
    """
    leaves = 1
    while leaves < len(keys):
        leaves *= 2
    at = [0] * leaves
    prefix = [0 if s < len(keys) and keys[s] else -1 for s in range(leaves)]  # -1: the run is at its end
    losers = [0] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two contenders."""
        common = prefix[a]
        if common != prefix[b]:
            return (a, b) if common > prefix[b] else (b, a)
        if common < 0:
            return a, b
        x, y = keys[a][at[a]][common:], keys[b][at[b]][common:]
        if x == y:
            prefix[b] = _KEY
            return a, b
        differing = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
        further = common + len(x) - (differing.bit_length() + 7) // 8
        if x < y:
            prefix[b] = further
            return a, b
        prefix[a] = further
        return b, a

    def first(node: int) -> int:
        if node >= leaves:
            return node - leaves
        winner, losers[node] = play(first(2 * node), first(2 * node + 1))
        return winner

    winner = first(1)
    while prefix[winner] >= 0:
        i = at[winner]
        yield winner, i, prefix[winner]
        at[winner] = i = i + 1
        prefix[winner] = shared[winner][i] if i < len(keys[winner]) else -1
        node = (winner + leaves) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def _sorted_runs(repeated: Filter, hot: Filter, bounds: list[bytes], spread: int):
    """Front-coded runs of the suffixes at repeated grams, one row per run and target."""

    def flush(entries: list[tuple]) -> pd.DataFrame:
        entries.sort(key=lambda e: e[0])
        by_target: dict[int, list[tuple[bytes, bytes, list]]] = {}
        last = None
        for key, is_hot, before, member in entries:
            if key == last:
                members.append(member)
                continue
            last, members = key, [member]
            target = len(bounds) + 1 + xxhash.xxh3_64_intdigest(key) % spread if is_hot else bisect_right(bounds, key[:GRAM])
            by_target.setdefault(target, []).append((key, before, members))
        return pd.DataFrame([{"target": t, **front_coded(own)} for t, own in by_target.items()])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        entries: list[tuple] = []
        for frame in frames:
            texts, docs, versions = [t.encode() for t in frame["text"]], frame["doc"].tolist(), frame["version"].tolist()
            for of, hashes, place, first, last in anchors(texts):
                kept = np.flatnonzero(repeated.holds(hashes))
                is_hot = hot.holds(hashes[kept]).tolist()
                for i, p, lo, hi, h in zip(of[kept].tolist(), place[kept].tolist(), first[kept].tolist(), last[kept].tolist(), is_hot):
                    suffix, before = texts[i][p : p + LENGTH], texts[i][max(p - _SPAN + 1, 0) : p]
                    key = suffix.ljust(LENGTH, b"\0") + bytes([len(suffix)]) + xxhash.xxh3_64_digest(before)
                    entries.append((key, h, before, (docs[i], versions[i], p, p - lo, p - hi)))
                if len(entries) >= RUN_ROWS:
                    yield flush(entries)
                    entries = []
        if entries:
            yield flush(entries)

    return run


_FOUND = "doc long, version long, first long, last long, edge boolean, windows array<long>"


def _window_hashes(classes: list[tuple[bytes, bytes]], far: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Hashes of the windows that start ``far`` to ``near`` bytes before the suffix, class by class."""
    out = []
    sizes = [len(b) + len(s) for b, s in classes]
    start = 0
    while start < len(classes):
        stop, total = start, 0
        while stop < len(classes) and (not total or total + sizes[stop] <= BATCH_BYTES):
            total += sizes[stop]
            stop += 1
        data = np.frombuffer(b"".join(b + s for b, s in classes[start:stop]), dtype=np.uint8)
        at = np.concatenate(([0], np.cumsum(sizes[start:stop])))[:-1] + np.array([len(b) for b, _ in classes[start:stop]])
        counts = far[start:stop] - near[start:stop] + 1
        steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        windows = np.repeat(at - far[start:stop], counts) + steps
        out.append(Substrings(data).hashes(windows, windows + LENGTH))
        start = stop
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _classes(rows: pd.DataFrame) -> Iterator[tuple[bytes, bytes, np.ndarray, int]]:
    """(key, bytes before, members, prefix shared with the class before) of one target, in key order."""
    runs = [Run(*r) for r in rows[_RUN_COLUMNS].itertuples(index=False)]
    key = None
    for run, i, common in merged([r.keys for r in runs], [r.shared for r in runs]):
        if common == _KEY:
            members.append(runs[run].members[i])
            continue
        if key is not None:
            yield key, before, np.concatenate(members), prefix
        key, before, members, prefix = runs[run].keys[i], runs[run].before[i], [runs[run].members[i]], common
    if key is not None:
        yield key, before, np.concatenate(members), prefix


_RUN_COLUMNS = ["shared", "tails", "before_sizes", "before", "counts", "members"]


def _settle(hot_from: int):
    """What the merged suffixes of each target tell: ranges of repeated windows, and windows of hot grams to count."""

    def ranges(members: np.ndarray) -> pd.DataFrame:
        last = members["place"] - members["near"]
        return pd.DataFrame({"doc": members["doc"], "version": members["version"], "first": members["place"] - members["far"], "last": last, "edge": False, "windows": None})

    def target(rows: pd.DataFrame, is_hot: bool) -> Iterator[pd.DataFrame]:
        repeated, probes, group = [], [], []

        def close() -> None:
            """The classes of one gram are complete."""
            for k, (key, before, members, prefix) in enumerate(group):
                if len(members) > 1:
                    repeated.append(members)
                if len(group) > 1 or is_hot:
                    reach = LENGTH if is_hot else min(max(prefix if k else 0, group[k + 1][3] if k + 1 < len(group) else 0), LENGTH)
                    near = max(int(members[0]["near"]), LENGTH - reach)
                    if near <= members[0]["far"]:
                        probes.append((key, before, members, near))
            group.clear()

        for entry in _classes(rows):
            if entry[3] < GRAM or is_hot:
                close()
            group.append(entry)
        close()
        if repeated:
            yield ranges(np.concatenate(repeated))
        if not probes:
            return
        first = np.array([m[0] for _, _, m, _ in probes], dtype=_MEMBER)
        far, near = first["far"].astype(np.int64), np.array([n for *_, n in probes], dtype=np.int64)
        single = np.array([len(m) == 1 for _, _, m, _ in probes])
        hashes = _window_hashes([(before, key[: key[LENGTH]]) for key, before, _, _ in probes], far, near)
        counts = far - near + 1
        of = np.repeat(np.arange(len(probes)), counts)
        distinct, inverse, times = np.unique(hashes, return_inverse=True, return_counts=True)
        start = (first["place"] - far)[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        twice = times[inverse] > 1

        def stretches(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Classes, first and last index of the runs of chosen windows of one class."""
            new = np.concatenate(([True], (np.diff(chosen) != 1) | (np.diff(of[chosen]) != 0)))
            begin = np.flatnonzero(new)
            return of[chosen[begin]], chosen[begin], chosen[np.append(begin[1:], len(chosen)) - 1]

        hit = np.flatnonzero(twice & single[of])
        if len(hit):
            own, begin, end = stretches(hit)
            yield pd.DataFrame({"doc": first["doc"][own], "version": first["version"][own], "first": start[begin], "last": start[end], "edge": False, "windows": None})
        if not is_hot:
            return
        # other tasks have suffixes of this gram too: what is not settled here is counted there, with one of each that is
        signed = hashes.view(np.int64)
        yield pd.DataFrame({"doc": [0], "version": [0], "first": [0], "last": [0], "edge": [False], "windows": [distinct[times > 1].view(np.int64)]})
        rest = np.flatnonzero(~twice)
        if len(rest):
            own, begin, end = stretches(rest)
            lists = [signed[a : b + 1] for a, b in zip(begin.tolist(), end.tolist())]
            yield pd.DataFrame({"doc": first["doc"][own], "version": first["version"][own], "first": start[begin], "last": start[end], "edge": single[own], "windows": lists})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, bounds in _groups(frames, ["target"]):
            for a, b in zip(bounds, bounds[1:]):
                rows = frame.iloc[a:b]
                yield from target(rows, rows["target"].iloc[0] >= hot_from)

    return run


def _bounds(grams: DataFrame, targets: int) -> list[bytes]:
    """Grams that cut the repeated suffixes into about equal ranges; taken from a bounded sample of the grams."""
    sample = grams.filter(F.col("head").isNotNull()).orderBy("h").limit(SAMPLED_GRAMS).select("head", "n").collect()
    sample = sorted((bytes(head), n) for head, n in sample)
    sums = np.cumsum([n for _, n in sample])
    if not len(sums):
        return []
    cuts = np.searchsorted(sums, sums[-1] * np.arange(1, targets) / targets)
    return sorted({sample[c][0] for c in cuts})


def repeated_windows(docs: DataFrame, hot_suffixes: int = HOT_SUFFIXES) -> DataFrame:
    """(doc, version, ranges) of the texts with repeated windows; ranges: array of (first, last) window starts.

    ``doc`` is the id (a missing one counts as the smallest), ``version`` the xxhash64 of the text. Rows with
    equal texts repeat each other, equal ids or not. Null texts and texts under ``LENGTH`` bytes have no window.
    """
    parts = partitions(docs)
    texts = docs.select(id_key(docs).alias("doc"), whole_text(docs).alias("text")).withColumn("version", F.xxhash64("text"))
    texts = texts.filter(F.octet_length("text") >= LENGTH)
    grams = texts.select("text").mapInPandas(_grams, "h long, head binary")
    counted = materialise(grams.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("head").alias("head")).filter("n > 1"), "grams")
    repeated, hot = Filter.of(counted), Filter.of(counted.filter(F.col("n") > hot_suffixes), HOT_BITS)
    targets = parts * TARGETS_PER_PARTITION
    bounds = _bounds(counted.filter(F.col("n") <= hot_suffixes), targets)

    runs = texts.select("doc", "version", "text").mapInPandas(_sorted_runs(repeated, hot, bounds, parts), _RUN)
    dealt = runs.repartition(parts, "target").sortWithinPartitions("target")
    found = materialise(dealt.mapInPandas(_settle(len(bounds) + 1), _FOUND), "found")

    ranges = found.filter("windows IS NULL").select("doc", "version", "first", "last")
    windows = found.filter("windows IS NOT NULL").select("doc", "version", "first", "edge", F.posexplode("windows").alias("at", "h"))
    twice = materialise(windows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "windows")
    at = F.col("first") + F.col("at")
    late = windows.filter("edge").join(twice, "h").select("doc", "version", at.alias("first"), at.alias("last"))
    return ranges.union(late).groupBy("doc", "version").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def without(data: bytes, ranges) -> tuple[bytes, int, int]:
    """What stays of a text, the number of bytes removed, and of maximal removed runs."""
    steps = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(steps, [r["first"] for r in ranges], 1)
    np.add.at(steps, [r["last"] + LENGTH for r in ranges], -1)
    gone = np.cumsum(steps)[:-1] > 0
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0]) if len(gone) else 0
    return np.frombuffer(data, dtype=np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def _marked(docs: DataFrame, hot_suffixes: int) -> DataFrame:
    rows = docs.select(as_row(docs), id_key(docs).alias("doc"), whole_text(docs).alias("whole")).withColumn("version", F.xxhash64("whole"))
    return rows.join(repeated_windows(docs, hot_suffixes), ["doc", "version"], "left")


def repeat_report(docs: DataFrame, hot_suffixes: int = HOT_SUFFIXES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``.

    Texts count as UTF-8 bytes, a null text is empty. A byte goes if a string of ``LENGTH`` bytes that covers it
    starts anywhere else too, in the same text or another; the strings are those of the input. Rows with
    equal texts of at least ``LENGTH`` bytes lose everything. Other columns are not read; an empty table gives no row.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, text, ranges in zip(frame["doc_id"].astype("Int64"), frame["whole"], frame["ranges"]):
                data = text.encode()
                kept, removed, spans = (data, 0, 0) if ranges is None else without(data, ranges)
                rows.append((doc, len(data), removed, spans, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]).astype({"doc_id": "Int64"})

    marked = _marked(docs.select("doc_id", "text"), hot_suffixes).select(F.col("row.doc_id").cast("long").alias("doc_id"), "whole", "ranges")
    return marked.mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame, hot_suffixes: int = HOT_SUFFIXES) -> DataFrame:
    """``docs`` with the remaining text, all columns kept; parts of characters left at a cut are dropped."""

    @F.pandas_udf("string")
    def kept(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([without(t.encode(), r)[0].decode(errors="ignore") for t, r in zip(texts, ranges)], dtype=object)

    marked = _marked(docs, hot_suffixes)
    text = F.when(F.col("ranges").isNull(), F.col("row.text")).otherwise(kept("whole", F.coalesce("ranges", F.array().cast("array<struct<first:long,last:long>>"))))
    renewed = marked.select("row", text.alias("kept"))
    return renewed.select(*with_text(F.col("row"), docs.columns, F.col("kept")))
