"""Alignment of two tokenizers: the shortest groups of tokens that cover the same bytes, and how often ids end together.

The alignment of a byte range is a fragment: the tokens before its first common end (open prefix), the groups closed
inside it, and the tokens after its last common end (open suffix). Fragments of neighbouring ranges compose
associatively, so a very long document is cut into chunks, which tasks align on their own, and a tree of
compositions over the cluster gives the whole. Neither tokenizer joins characters over a single space between
others, so texts are cut there, and what lies between two such spaces is encoded once and kept.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialise, setting
from .common import whole_text

CHUNK_CHARS = 1 << 15  # longer texts are cut into chunks of about this size, dealt to all tasks
FAN = 16  # fragments composed in one step of the tree
CACHED_WORDS = 120_000  # per worker; of a full cache only the words that come up again are kept
CACHED_CHARS = 64  # longer words are not kept
JOINT_WORDS = 4096  # words encoded together
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks; the apostrophe begins parts of its own

_SAFE = re.compile(r"(?<=\S) (?=\S)")  # neither tokenizer joins over such a space


class Fragment(NamedTuple):
    """Alignment of a byte range. Ids are decimal and comma-joined, groups ``a|b`` and joined by semicolons."""

    closes: bool = False  # some token of each side end together here; if not, all ids are in the heads
    head_a: str = ""  # ids up to and with the first common end
    head_b: str = ""
    closed: str = ""
    tail_a: str = ""  # ids after the last common end
    tail_b: str = ""
    n_a: int = 0
    n_b: int = 0
    links: bytes = b""  # the two ids at every common end, as little-endian uint32: a << 16 | b
    valid: bool = True  # the tokens of both sides spell the text


def _listed(left: str, right: str, mark: str = ",") -> str:
    return f"{left}{mark}{right}" if left and right else left or right


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative, with ``Fragment()`` as its neutral element."""
    counts = (left.n_a + right.n_a, left.n_b + right.n_b, left.links + right.links, left.valid and right.valid)
    if not left.closes:
        heads = _listed(left.head_a, right.head_a), _listed(left.head_b, right.head_b)
        return Fragment(right.closes, *heads, *right[3:6], *counts)
    if not right.closes:
        return Fragment(*left[:4], _listed(left.tail_a, right.head_a), _listed(left.tail_b, right.head_b), *counts)
    middle = f"{_listed(left.tail_a, right.head_a)}|{_listed(left.tail_b, right.head_b)}"
    return Fragment(True, left.head_a, left.head_b, _listed(_listed(left.closed, middle, ";"), right.closed, ";"), right.tail_a, right.tail_b, *counts)


def fragment(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int], valid: bool = True) -> Fragment:
    """The tokens that end in a byte range, with their ends; the range may begin and end inside tokens."""
    groups, links, i, j = [], [], 0, 0
    listed = lambda ids: ",".join(map(str, ids))
    for end in sorted(set(a_ends).intersection(b_ends)):
        i2, j2 = bisect_right(a_ends, end), bisect_right(b_ends, end)
        groups.append((listed(a[i:i2]), listed(b[j:j2])))
        links.append(a[i2 - 1] << 16 | b[j2 - 1])
        i, j = i2, j2
    rest, counts = (listed(a[i:]), listed(b[j:])), (len(a), len(b), np.array(links, dtype="<u4").tobytes(), valid)
    if not groups:
        return Fragment(False, *rest, "", "", "", *counts)
    return Fragment(True, *groups[0], ";".join(f"{x}|{y}" for x, y in groups[1:]), *rest, *counts)


#: n_a, n_b, groups, links of a word's fragment, which begins and ends with the word
Known = tuple[int, int, str, bytes]


class Sides:
    """The two tokenizers: ids and token bytes of words. A word stands for a space and itself."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        with open(path_a) as file:
            made = json.load(file)
        step = made["pre_tokenizer"] or {}
        if made["normalizer"] or step.get("type") != "ByteLevel" or not step.get("use_regex") or step.get("add_prefix_space"):
            raise ValueError("A must be a byte-level tokenizer without normaliser and added space")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a_bytes = {i: self._shown(t) for t, i in self.a.get_vocab().items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        model = sentencepiece_model_pb2.ModelProto.FromString(self.b.serialized_model_proto())
        rule = model.normalizer_spec
        pieces = [p.piece for p in model.pieces]
        if rule.name != "identity" or not rule.add_dummy_prefix or rule.remove_extra_whitespaces or any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("B must keep texts as they are, add a space and have no piece with a space after other characters")
        self.b_bytes = {i: bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}
        if max(*self.a_bytes, *self.b_bytes) >= 1 << 16:
            raise ValueError("ids must fit into 16 bits")
        self.a_sizes, self.b_sizes = (np.array([len(own.get(i, b"")) for i in range(max(own) + 1)]) for own in (self.a_bytes, self.b_bytes))

    # fixed: printable bytes stand for themselves, the others for the characters from 256 on
    _PRINTABLE = (*range(33, 127), *range(161, 173), *range(174, 256))

    @classmethod
    @functools.cache
    def _bytes_of(cls) -> dict[str, int]:
        others = [b for b in range(256) if b not in cls._PRINTABLE]
        return {chr(b): b for b in cls._PRINTABLE} | {chr(256 + k): b for k, b in enumerate(others)}

    @classmethod
    @functools.cache
    def _shows(cls) -> dict[int, str]:
        return {b: c for c, b in cls._bytes_of().items()}

    @classmethod
    def _shown(cls, token: str) -> bytes:
        table = cls._bytes_of()
        return bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()

    @property
    def pairs(self) -> int:
        """Pairs of ids that can end together at most: one spells the end of the other, or both the same."""
        spelled = {}
        for own in (self.a_bytes, self.b_bytes):
            for token in own.values():
                spelled[token] = spelled.get(token, 0) + 1
        return sum(spelled.get(t[k:], 0) for own in (self.a_bytes, self.b_bytes) for t in own.values() for k in range(len(t)))

    def _a_ids(self, words: list[str]) -> list[list[int]]:
        """Latin words, with ASCII marks or none after them, go to the model part by part: the split before it would cut there."""
        model, shown, found, others = self.a.model.tokenize, self._shows(), [], []
        space = shown[32]
        for at, word in enumerate(words):
            stem = word.rstrip(MARKS)
            if stem.isalpha() and (stem.isascii() or max(stem) < "\u0250"):
                ids = [t.id for t in model(space + stem if stem.isascii() else space + stem.encode().decode("latin-1").translate(shown))]
                if len(stem) < len(word):
                    ids += [t.id for t in model(word[len(stem) :])]
                found.append(ids)
            else:
                others.append(at)
                found.append([])
        encoded = self.a.encode_batch_fast([" " + words[at] for at in others], add_special_tokens=False)
        for at, one in zip(others, encoded):
            found[at] = one.ids
        return found

    def known(self, words: list[str]) -> list[Known | None]:
        """None for a word that the tokens do not spell."""
        a_ids, b_ids = self._a_ids(words), self.b.encode(words, num_threads=1)
        a, b = list(itertools.chain.from_iterable(a_ids)), list(itertools.chain.from_iterable(b_ids))
        a_spelled, b_spelled = (b"".join(map(own.__getitem__, ids)) for own, ids in ((self.a_bytes, a), (self.b_bytes, b)))
        if not words or not a_spelled == b_spelled == (" " + " ".join(words)).encode():
            if len(words) < 2:
                return [None] * len(words)
            half = len(words) // 2  # words that are not spelled are few
            return self.known(words[:half]) + self.known(words[half:])
        a_at, b_at = np.array(a), np.array(b)
        a_ends, b_ends = np.cumsum(self.a_sizes[a_at]), np.cumsum(self.b_sizes[b_at])
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_to, b_to = np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1
        links = (a_at[a_to - 1] << 16 | b_at[b_to - 1]).astype("<u4").tobytes()
        a_shown, b_shown, groups, i, j = list(map(str, a)), list(map(str, b)), [], 0, 0
        for i2, j2 in zip(a_to.tolist(), b_to.tolist()):
            groups.append(f"{a_shown[i] if i2 == i + 1 else ','.join(a_shown[i:i2])}|{b_shown[j] if j2 == j + 1 else ','.join(b_shown[j:j2])}")
            i, j = i2, j2
        # every word ends with tokens of both sides
        last, g, found = (np.searchsorted(a_to, np.cumsum([len(ids) for ids in a_ids])) + 1).tolist(), 0, []
        for g2, of_a, of_b in zip(last, a_ids, b_ids):
            found.append((len(of_a), len(of_b), ";".join(groups[g:g2]), links[4 * g : 4 * g2]))
            g = g2
        return found


def _uncut(word: str) -> bool:
    return not word or word[0].isspace() or word[-1].isspace()


class Aligner:
    """Fragments of texts from a cache of their words."""

    def __init__(self, sides: Sides, most: int = CACHED_WORDS):
        self.sides, self.most = sides, most
        self.words: dict[str, Known | None] = {}
        self.older: dict[str, Known | None] = {}  # the words before the cache was last full

    def _learn(self, wanted: set[str]) -> list[str]:
        """Makes ``wanted`` known; returns those that are not to be kept."""
        if len(self.words) > self.most:
            self.words, self.older = {}, self.words
        fresh = wanted.difference(self.words)
        held = fresh.intersection(self.older)
        self.words.update((w, self.older[w]) for w in held)
        fresh = list(fresh - held)
        for first in range(0, len(fresh), JOINT_WORDS):
            part = fresh[first : first + JOINT_WORDS]
            self.words.update(zip(part, self.sides.known(part)))
        return [w for w in fresh if len(w) > CACHED_CHARS or _uncut(w)]

    def fragments(self, texts: list[str]) -> list[Fragment]:
        """One for each text, which is not empty and stands for a space and itself."""
        split = [t.split(" ") for t in texts]
        wanted = set().union(*split)
        # what is known has no white space at an end; the space at such an end is no place to cut
        uncut = {w for w in wanted.difference(self.words) if _uncut(w)}
        if uncut:
            split = [words if uncut.isdisjoint(words) else _SAFE.split(text) for text, words in zip(texts, split)]
            wanted = set().union(*split)
        passing = self._learn(wanted)
        found = [self._whole(list(map(self.words.__getitem__, words))) for words in split]
        for word in passing:
            del self.words[word]
        return found

    @staticmethod
    def _whole(words: list[Known | None]) -> Fragment:
        if None in words:
            return Fragment(valid=False)
        n_a, n_b, groups, links = zip(*words)
        head, _, rest = groups[0].partition(";")
        head_a, _, head_b = head.partition("|")
        return Fragment(True, head_a, head_b, _listed(rest, ";".join(groups[1:]), ";"), "", "", sum(n_a), sum(n_b), b"".join(links))


_aligners: dict[tuple[str, str], Aligner] = {}  # of this Python worker, which runs many tasks


def aligner_of(paths: tuple[str, str]) -> Aligner:
    if paths not in _aligners:
        _aligners[paths] = Aligner(Sides(*paths))
    return _aligners[paths]


def chunks(text: str, size: int) -> list[str]:
    """Parts of about ``size`` characters between single spaces; joined by them they are the text."""
    parts, start = [], 0
    while found := _SAFE.search(text, start + size):
        parts.append(text[start : found.start()])
        start = found.end()
    return [*parts, text[start:]]


_FRAGMENT = "closes boolean, head_a string, head_b string, closed string, tail_a string, tail_b string, n_a long, n_b long, links binary, valid boolean"
_ALIGNED = "n_a long, n_b long, groups string, links binary"
_DIGESTED = "n_a long, n_b long, groups_sha256 string, links binary"
TEXTS = 64  # aligned together
BATCH_BYTES = "4m"  # of texts at a time: their groups and links are some times longer


def _finished(f: Fragment) -> tuple:
    if not f.valid or not f.closes:
        return 0, 0, None, b""
    return f.n_a, f.n_b, _listed(f"{f.head_a}|{f.head_b}", f.closed, ";"), f.links


def _digested(f: Fragment) -> tuple:
    n_a, n_b, groups, links = _finished(f)
    return n_a, n_b, "" if groups is None else hashlib.sha256(groups.encode()).hexdigest(), links


def _aligned(paths: tuple[str, str], schema: str, shown: Callable[[Fragment], tuple], none: Fragment = Fragment()):
    @F.pandas_udf(schema)
    def align(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, names = aligner_of(paths), [c.split()[0] for c in schema.split(", ")]
        for texts in series:
            rows = []
            for first in range(0, len(texts), TEXTS):
                part = texts.iloc[first : first + TEXTS].tolist()
                found = iter(own.fragments([t for t in part if t]))
                rows += [shown(next(found) if t else none) for t in part]
            yield pd.DataFrame(rows, columns=names)

    return align


def _composed(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("chunk")
    whole = functools.reduce(compose, (Fragment(*row) for row in frame[list(Fragment._fields)].itertuples(index=False)))
    return pd.DataFrame([(frame["key"].iloc[0], frame["chunk"].iloc[0] // FAN, *whole)], columns=["key", "chunk", *Fragment._fields])


def align_long(texts: DataFrame, paths: tuple[str, str], chunk_chars: int, digest: bool = False) -> DataFrame:
    """key, n_a, n_b, groups (with ``digest`` their digest), links of texts (key, text) by way of their chunks; equal keys mean equal texts."""

    @F.pandas_udf("array<string>")
    def cut(series: pd.Series) -> pd.Series:
        return series.map(lambda t: chunks(t, chunk_chars))

    parts = texts.select("key", F.posexplode(cut("text")).alias("chunk", "part"))
    parts = parts.groupBy("key", "chunk").agg(F.first("part").alias("part"))  # spreads the chunks, and copies go
    level = parts.select("key", "chunk", _aligned(paths, _FRAGMENT, tuple)("part").alias("f")).select("key", "chunk", "f.*")
    level = materialise(level, "fragments")
    most = level.agg(F.max("chunk")).first()[0] or 0
    while most > 0:
        level = level.withColumn("of", F.floor(F.col("chunk") / FAN)).groupBy("key", "of").applyInPandas(
            lambda frame: _composed(frame), f"key binary, chunk long, {_FRAGMENT}"
        )
        most //= FAN
    done = F.col("valid") & F.col("closes")
    groups = F.when(done, F.concat(F.concat_ws("|", "head_a", "head_b"), F.when(F.col("closed") != "", F.concat(F.lit(";"), "closed")).otherwise("")))
    if digest:
        groups = F.coalesce(F.sha2(groups, 256), F.lit(""))
    zero = lambda c: F.when(done, F.col(c)).otherwise(0).cast("long").alias(c)
    return level.select("key", zero("n_a"), zero("n_b"), groups.alias("groups"), F.when(done, F.col("links")).otherwise(F.lit(b"")).alias("links"))


def align(
    docs: DataFrame, path_a: str, path_b: str, chunk_chars: int = CHUNK_CHARS, keep: list[str] | None = None, digest: bool = False
) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, or all), n_a, n_b, groups (with ``digest`` groups_sha256) and links.

    A (``path_a``, byte-level) encodes a space and the text, B (``path_b``, sentencepiece) the text, to which it adds the space.
    ``groups`` are ``a1,a2|b1;a3|b2,b3``: ids of A and B between places where tokens of both end. ``links`` are the ids
    that end there, as little-endian uint32 a << 16 | b. A null or empty text, and one whose tokens do not spell
    it, has no tokens: zeros, null groups (an empty digest), empty links. Repeated rows get their own results, of very long texts one for all
    copies; ids and other columns are not read. An empty table gives no row. Both files must exist on every executor.
    """
    paths, text = (path_a, path_b), whole_text(docs)
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    held = docs.select(row, text.alias("text"))
    long = held.filter(F.length("text") > chunk_chars).withColumn("key", F.unhex(F.sha2("text", 256)))
    aligned = _aligned(paths, _DIGESTED, _digested) if digest else _aligned(paths, _ALIGNED, _finished)
    short = held.filter(F.length("text") <= chunk_chars).select("row", aligned("text").alias("f"))
    rows = long.select("row", "key")
    if keep is not None:  # few columns: written, their size is known, and what is aligned need not move to meet them
        rows = materialise(rows, "long")
    whole = rows.join(align_long(long.select("key", "text"), paths, chunk_chars, digest), "key")
    return short.select("row", "f.*").union(whole.select("row", "n_a", "n_b", "groups", "links"))


@dataclass
class Links:
    """The pairs of ids linked in a corpus: sorted codes a << 16 | b, their counts, and whether no pair of the same b has more."""

    codes: np.ndarray
    counts: np.ndarray
    best: np.ndarray

    @classmethod
    def of(cls, links: DataFrame) -> Links:
        """From the column links. The table is bounded by the vocabularies (``Sides.pairs``), not by the corpus."""

        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            codes, counts = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
            for frame in frames:
                fresh, n = np.unique(np.frombuffer(b"".join(frame["links"]), dtype="<u4"), return_counts=True)
                both, where = np.unique(np.concatenate((codes, fresh)), return_inverse=True)
                added = np.zeros(len(both), dtype=np.int64)
                np.add.at(added, where, np.concatenate((counts, n)))
                codes, counts = both, added
            yield pd.DataFrame({"code": codes.astype(np.int64), "n": counts})

        table = links.select("links").mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas().sort_values("code")
        codes, counts = table["code"].to_numpy(np.int64).astype("<u4"), table["n"].to_numpy(np.int64)
        most = np.zeros(1 << 16, dtype=np.int64)
        b = codes & np.uint32(0xFFFF)
        np.maximum.at(most, b, counts)
        return cls(codes, counts, counts == most[b])

    def scores(self):
        """Column function: n_best and count_sum of a document's links."""

        @F.pandas_udf("n_best long, count_sum long")
        def score(series: pd.Series) -> pd.DataFrame:
            rows = []
            for links in series:
                at = np.searchsorted(self.codes, np.frombuffer(links, dtype="<u4"))
                rows.append((int(self.best[at].sum()), int(self.counts[at].sum())))
            return pd.DataFrame(rows, columns=["n_best", "count_sum"])

        return score


def report(docs: DataFrame, path_a: str, path_b: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (see ``align``).

    ``n_best`` counts the links whose pair is the most frequent one of its id of B in all documents, ties included;
    ``count_sum`` adds up how often the pair of each link is linked in all documents.
    """
    found = align(docs, path_a, path_b, chunk_chars, keep=["doc_id"], digest=True)
    n = F.floor(F.octet_length("links") / 4).cast("long")
    found = found.select("row.doc_id", "n_a", "n_b", n.alias("n_groups"), n.alias("n_links"), "groups_sha256", "links")
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
        found = materialise(found, "links")
    scores = Links.of(found).scores()
    return found.withColumn("s", scores("links")).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "s.n_best", "s.count_sum", "groups_sha256")
