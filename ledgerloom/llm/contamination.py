"""Benchmark decontamination: documents that hold windows of benchmark items, found by a prefix-filtered set join.

A window's set is its shingles. A document that holds the window holds all of them, so the necessary prefix
of the set, ordered by rarity in the whole corpus, is one shingle: the rarest. Only these are joined with
the documents; windows with a shingle that the corpus lacks need not be looked for. The place of the shingle
in its window bounds where the window must lie, and the words there are compared one by one.

Only built-in functions: no Python worker takes part.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .common import as_row, whole_text

WINDOW = 10  # consecutive words of an item
SHINGLE = 3  # words of a shingle; a shorter window is one shingle
BROADCAST_ROWS = 500_000  # shingles, windows or candidates sent to all tasks at most; beyond, both sides are exchanged
FILTER_BITS = 1 << 20

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what separates words, before A-Z are lower-cased


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def lower(word: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(F.translate(word, _CAPITALS, _CAPITALS.lower()))


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(text, _BETWEEN), "")


def word_hashes(words: Column) -> Column:
    """Words that are equal with A-Z lower-cased have equal hashes; others may too, which costs a comparison, never a row."""
    return F.transform(words, lambda w: F.hash(F.lower(w)))


def shingles(hashes: Column, sizes: list[int], wanted: Callable[[Column], Column] | None = None) -> Column:
    """Array of (at, h): the shingles of each size that begin at each word, those alone that may be ``wanted``.

    At the end of the words larger shingles run short; they cost a comparison too.
    """

    def starting(hashes: Column, size: int) -> Column:
        of = lambda h, i: F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, size)])
        made = lambda h, i: F.struct(i.alias("at"), of(h, i).alias("h"))
        if wanted is None:
            return F.transform(hashes, made)
        return F.array_compact(F.transform(hashes, lambda h, i: F.when(wanted(of(h, i)), made(h, i))))

    return bound(hashes, lambda hashes: F.concat(*[starting(hashes, size) for size in sizes]))


def filter_of(values: DataFrame) -> Callable[[Column], Column]:
    """Whether a long may be in the column h of ``values``: ``FILTER_BITS`` bits, a constant of the plan.

    Wrong hits cost work only; a full filter lets everything pass to the join.
    """
    bit = F.col("h").bitwiseAND(FILTER_BITS - 1)
    words = values.groupBy(F.shiftright(bit, 6).cast("int").alias("place")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 AS int)))").alias("bits"))
    filled = dict(map(tuple, words.collect()))  # FILTER_BITS / 64 rows at most
    listed = ",".join(str(filled.get(i, 0)) for i in range(FILTER_BITS // 64))
    held = F.split(F.lit(listed), ",").cast("array<bigint>")
    place = lambda h: F.shiftright(h.bitwiseAND(FILTER_BITS - 1), 6).cast("int")
    return lambda h: F.getbit(F.get(held, place(h)), h.bitwiseAND(63).cast("int")) == 1


def text_key(text: Column) -> Column:
    """128 bits of SHA-256, so that equal texts are searched as one."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def near(small: DataFrame) -> DataFrame:
    """A written table, sent to all tasks if a count of its rows allows that."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


@dataclass
class Patterns:
    """``windows``: wid, window (array of words); ``owners``: wid, class; ``items``: class, item_id as a string."""

    windows: DataFrame
    owners: DataFrame
    items: DataFrame


def patterns(benchmark: DataFrame, window: int = WINDOW) -> Patterns:
    """Distinct windows of distinct word sequences, so that copies of an item are searched once."""
    items = benchmark.select(
        F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item_id"), F.transform(raw_words(whole_text(benchmark)), lower).alias("words")
    ).filter(F.size("words") > 0)
    items = items.withColumn("class", F.sha2(F.concat_ws(" ", "words"), 256))
    texts = items.dropDuplicates(["class"]).select("class", "words")
    last = F.greatest(F.size("words") - window, F.lit(0))
    cut = texts.select("class", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    cut = cut.select("class", F.slice("words", F.col("at") + 1, window).alias("window"))
    cut = materialise(cut.select("class", "window", text_key(F.concat_ws(" ", "window")).alias("wid")), "windows")
    return Patterns(
        materialise(cut.dropDuplicates(["wid"]).select("wid", "window"), "distinct_windows"),
        cut.select("wid", "class").distinct(),
        items.select("class", "item_id").distinct(),
    )


def rarest(windows: DataFrame, hashed: DataFrame) -> tuple[DataFrame, list[int]]:
    """The prefix of each window that can occur: h, at (its place in the window), wid, size; and the sizes of shingles."""
    size = F.least(F.size("window"), F.lit(SHINGLE))
    sizes = sorted(r[0] for r in windows.select(size).distinct().collect()) or [SHINGLE]  # SHINGLE values at most
    held = windows.select("wid", F.size("window").alias("size"), size.alias("shingle"), word_hashes(F.col("window")).alias("hashes"))
    own = None
    for s in sizes:
        whole = F.filter(shingles(F.col("hashes"), [s]), lambda x: x["at"] <= F.col("size") - s)
        part = held.filter(F.col("shingle") == s).select("wid", "size", (F.col("size") - s + 1).alias("shingles"), F.inline(whole))
        own = part if own is None else own.union(part)
    own = materialise(own, "window_shingles")
    asked = materialise(own.select("h").distinct(), "shingles")
    seen = hashed.select(F.inline(shingles(F.col("hashes"), sizes, filter_of(asked)))).join(near(asked), "h").groupBy("h").agg(F.count("*").alias("uses"))
    # a window with a shingle that the corpus lacks keeps fewer shingles than it has
    best = own.join(materialise(seen, "shingle_uses"), "h").groupBy("wid", "size", "shingles")
    best = best.agg(F.min(F.struct("uses", "at", "h")).alias("first"), F.count("*").alias("known")).filter(F.col("known") == F.col("shingles"))
    return materialise(best.select("first.h", "first.at", "wid", "size"), "prefixes"), sizes


def occurrences(texts: DataFrame, hashed: DataFrame, windows: DataFrame) -> DataFrame:
    """key, wid, first and end (words) of every place where a window lies in a text.

    ``texts``: key, text; ``hashed``: key, n_words, hashes. Texts are not read before their candidates are known.
    """
    prefixes, sizes = rarest(windows, hashed)
    placed = hashed.select("key", "n_words", F.inline(shingles(F.col("hashes"), sizes, filter_of(prefixes))).alias("pos", "h"))
    found = placed.join(near(prefixes), "h").select("key", "n_words", (F.col("pos") - F.col("at")).alias("first"), "size", "wid")
    found = found.filter((F.col("first") >= 0) & (F.col("first") + F.col("size") <= F.col("n_words")))
    found = materialise(found.select("key", "first", "size", "wid").distinct(), "candidates")
    asked = found.groupBy("key").agg(F.collect_list(F.struct("first", "size", "wid")).alias("asked"))
    asked = F.broadcast(asked) if found.count() <= BROADCAST_ROWS else asked
    at = lambda words, c: text_key(F.concat_ws(" ", F.transform(F.slice(words, c["first"] + 1, c["size"]), lower)))
    held = bound(raw_words(F.col("text")), lambda words: F.filter("asked", lambda c: at(words, c) == c["wid"]))
    found = texts.join(asked, "key").select("key", F.inline(held))
    return found.select("key", "wid", "first", (F.col("first") + F.col("size")).alias("end")).distinct()


def _covered(ranges: Column) -> Column:
    """Words in any of the ranges, which are sorted by their first word."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    step = lambda done, r: F.struct(
        (done["n"] + F.greatest(r["end"] - F.greatest(r["first"], done["to"]), F.lit(0))).alias("n"), F.greatest(r["end"], done["to"]).alias("to")
    )
    return F.aggregate(ranges, start, step, lambda done: done["n"])


def _hits(texts: DataFrame, hashed: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """key, ranges and items of the texts that hold a window."""
    own = patterns(benchmark, window)
    found = materialise(occurrences(texts, hashed, own.windows), "occurrences")
    ranges = found.select("key", "first", "end").distinct().groupBy("key").agg(F.array_sort(F.collect_list(F.struct("first", "end"))).alias("ranges"))
    classes = found.select("key", "wid").distinct().join(own.owners, "wid").select("key", "class").distinct()
    items = classes.join(own.items, "class").groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    return materialise(ranges.join(items, "key"), "hits")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_key(whole_text(docs)).alias("key"), whole_text(docs).alias("text"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, or all), n_words, n_hit, ranges (first, end of every window, in words) and items.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. A window is ``window``
    consecutive words of an item; an item of fewer words, but not none, is one window. ``items`` are the ids, as strings in
    order, of the items with a window in the text; a missing id counts as the empty string, and rows of one id as one item.
    Null and empty texts have no words and no hits; items without words are never found; every repeated row gets its own
    result; an empty table of documents gives no row, an empty benchmark no hit. Other columns are not read.
    """
    text = whole_text(docs)
    kept = docs.select(as_row(docs.select(keep or docs.columns)), text_key(text).alias("key"), raw_words(text).alias("words"))
    kept = materialise(kept.select("row", "key", F.size("words").alias("n_words"), word_hashes(F.col("words")).alias("hashes")), "word_hashes")
    hits = _hits(_texts(docs), kept.select("key", "n_words", "hashes"), benchmark, window)
    joined = kept.select("row", "key", F.col("n_words").cast("long")).join(hits, "key", "left")
    none = lambda name: F.coalesce(F.col(name), F.array().cast(hits.schema[name].dataType)).alias(name)
    return joined.select("row", "n_words", F.coalesce(_covered(F.col("ranges")), F.lit(0)).cast("long").alias("n_hit"), none("ranges"), none("items"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (see ``contamination``)."""
    found = contamination(docs, benchmark, window, keep=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    clean = contamination(docs, benchmark, window).filter(F.col("n_hit") == 0)
    return clean.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
