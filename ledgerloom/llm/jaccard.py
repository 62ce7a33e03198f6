"""Exact Jaccard self-join of documents on word shingles, by token-combination prefixes.

Shingles are 64-bit hashes in ascending order. Two sets that reach the threshold share at least l of the
shingles in their extended prefixes (the smallest n - overlap + l of them). So either they share a rare
shingle there, and the index of single rare shingles finds them; or all the l shared ones are frequent.
Only documents with that many frequent shingles in their prefix are indexed by combinations: the hash
range is cut into more cells than two linked sets can differ in, and the combination of all shingles in
a cell is one key. Some cell is then the same in both.

Candidates form clusters. A cluster of several blocks is mostly a chain of sets that share a common
passage each; it is split by the shingles that are rarest inside it, of which linked sets share one, so
that what is compared follows the near copies and not the square of the chain. The texts of a cluster
meet in blocks, where pairs not yet connected are verified; the members of a cluster of many blocks are
first thinned to those outside its largest component. No pair is emitted but the links of a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .common import partitions, whole_text
from .components import Forest, components
from .filters import Filter
from .hashing import lower_bytes, mix, shingle_sets

PERCENT = 90
SHINGLE_WORDS = 3
RARE_DOCUMENTS = 16  # a shingle in more prefixes is frequent
BLOCK = 128  # documents compared in one task
ROUNDS = 1  # of re-dealt blocks before the rest is compared with everything


def must_share(n: int, percent: int) -> int:
    """Fewest shingles a set of ``n`` shares with any set linked to it."""
    return -(-percent * n // 100)


def extension(n: int) -> int:
    """l: how many shared shingles the extended prefix guarantees. Never falls with n."""
    return 3 + n // 32


def prefix_length(n: int, percent: int) -> int:
    return min(n - must_share(n, percent) + extension(n), n)


def enough_frequent(n: int, percent: int) -> int:
    """Fewer frequent prefix shingles rule out a partner that shares no rare one: the smallest partner's l."""
    smallest = must_share(n, percent)
    return min(extension(smallest), max(smallest, 1))


def size_classes(largest: int, percent: int) -> list[int]:
    """First sizes of classes such that linked sets are in one class or in neighbouring ones."""
    firsts = [1]
    while firsts[-1] <= largest:
        firsts.append(max(firsts[-1] + 1, -(-firsts[-1] * 100 // percent) + 1))
    return firsts


def combinations(hashes: np.ndarray, percent: int) -> set[int]:
    """Index keys of a set: one for the shingles of each cell, for its size class and the next one.

    Sets of a class differ by at most E shingles, so with more than E cells one is equal in both. A set
    whose empty cells might hide it also takes the keys of its empty cells.
    """
    n, keys = len(hashes), set()
    firsts = size_classes(2 * n + 2, percent)
    own = int(np.searchsorted(firsts, n, side="right")) - 1
    for size_class in (own, own + 1):
        largest = firsts[size_class + 1] - 1
        differing = (100 - percent) * 2 * largest // (100 + percent)
        cells = differing + differing // 4 + 1
        cell = ((hashes >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        content = np.add.reduceat(mix(hashes ^ np.uint64(0x51F15EED)), starts)
        label = np.uint64(size_class * 0x9E3779B1) + cell[starts].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        keys.update(mix(content ^ mix(label)).tolist())
        if cells - differing <= cells - len(starts):
            for empty in set(range(cells)).difference(cell.tolist()):
                keys.add(xxhash.xxh3_64_intdigest(f"{size_class}:{empty}"))
    return {k - (1 << 64) if k >= 1 << 63 else k for k in keys}


def linked(a: frozenset, b: frozenset, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(a & b)
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _may_link(percent: int) -> Column:
    """Whether prefixes ``of_a`` and ``of_b`` with ``shared`` shingles leave sets of ``n_a`` and ``n_b`` enough to link.

    A prefix holds all shingles of its set up to its last one, so one of the other prefix up to there that it does not
    hold is missing in the whole set.
    """
    unsigned = lambda c: c.bitwiseXOR(F.lit(-(2**63)))  # noqa: E731  ascending as unsigned
    least = F.floor((percent * (F.col("n_a") + F.col("n_b")) + 99 + percent) / (100 + percent))

    def near(own: str, n: str, other: str) -> Column:
        last = unsigned(F.element_at(other, -1))
        missing = F.size(F.filter(own, lambda x: unsigned(x) <= last)) - F.col("shared")
        return missing <= F.col(n) - least

    return near("of_a", "n_a", "of_b") & near("of_b", "n_b", "of_a")


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _describe(words: int, percent: int):
    """doc_id, set signature, size and extended prefix of every document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first in range(0, len(frame), 512):
                part = frame.iloc[first : first + 512]
                sets = [s.copy() for s in shingle_sets(lower_bytes(part["text"]), words)]
                signs = [xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].astype("Int64").array,
                        "version": part["version"].array,
                        "sign": np.array(signs, dtype=np.uint64).view(np.int64),
                        "n": np.array([len(s) for s in sets], dtype=np.int64),
                        "prefix": [_signed(s[: prefix_length(len(s), percent)]) for s in sets],
                    }
                )

    return run


def _keys(words: int, percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first in range(0, len(frame), 256):
                part = frame.iloc[first : first + 256]
                sets = shingle_sets(lower_bytes(part["text"]), words)
                yield pd.DataFrame({"sign": part["sign"].array, "keys": [np.array(sorted(combinations(s, percent)), dtype=np.int64) for s in sets]})

    return run


def _sets(words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first in range(0, len(frame), 256):
                part = frame.iloc[first : first + 256]
                sets = [_signed(s).copy() for s in shingle_sets(lower_bytes(part["text"]), words)]
                yield pd.DataFrame({"cluster": part["cluster"].array, "sign": part["sign"].array, "shingles": sets})

    return run


def _groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, list[int]]]:
    """Frames of whole groups from a sorted stream, with the bounds of the groups."""
    held = None
    for frame in frames:
        if held is not None:
            frame = pd.concat([held, frame], ignore_index=True)
        if not len(frame):
            continue
        values = frame[keys].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], (values[1:] != values[:-1]).any(axis=1))))
        held = frame.iloc[starts[-1] :]
        if len(starts) > 1:
            yield frame.iloc[: starts[-1]], starts.tolist()
    if held is not None and len(held):
        yield held, [0, len(held)]


def _verify(keys: list[str], words: int, percent: int):
    """Links that join components inside one block, or between its two sides.

    ``side`` is 0 for a block compared with itself; rows of sides 1 and 2 are compared across. Members of
    one component are not compared again, and a set meets only those that share a prefix shingle.
    """

    def block(ids: list[int], labels: list[int], sides: list[int], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        as_sets, forest = [frozenset(s.tolist()) for s in sets], Forest()
        index: dict[int, list[int]] = {}
        for i in sorted(range(len(sets)), key=lambda i: (len(sets[i]), ids[i])):
            n = len(sets[i])
            own = sets[i][: n - must_share(n, percent) + 1].tolist()
            seen = {i}
            for token in own:
                for j in index.get(token, ()):
                    if j in seen or sides[i] == sides[j] != 0:
                        continue
                    seen.add(j)
                    if forest.find(labels[i]) != forest.find(labels[j]) and linked(as_sets[i], as_sets[j], percent):
                        forest.join(labels[i], labels[j])
                        yield ids[i], ids[j]
            for token in own:
                index.setdefault(token, []).append(i)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, bounds in _groups(frames, keys):
            ids, labels, sides = (frame[c].tolist() for c in ("sign", "label", "side"))
            texts, links = frame["text"].tolist(), []
            for a, b in zip(bounds, bounds[1:]):
                if b - a > 1:
                    sets = [s.copy() for s in shingle_sets(lower_bytes(texts[a:b]), words)]
                    links.extend(block(ids[a:b], labels[a:b], sides[a:b], sets))
            yield pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return run


def _stars(keyed: DataFrame, *keys: str) -> DataFrame:
    """(a, b): the sets of every group of ``keys`` with more than one, each linked to the smallest of the group."""
    heads = keyed.groupBy(*keys).agg(F.min("sign").alias("a"), F.max("sign").alias("z")).filter("a <> z").select(*keys, "a")
    return keyed.join(materialise(heads, "heads"), list(keys)).select("a", F.col("sign").alias("b")).distinct()


def _split(members: DataFrame, words: int, percent: int) -> DataFrame:
    """``members`` with clusters above BLOCK cut into smaller ones that still hold all links.

    In an order of the shingles of a cluster, two linked sets have the first one of those they share among all of
    their shared shingles but the last must_share - 1. So with the rarest first, sets that meet in one of the others
    hold every link. Sets that meet with none go.
    """
    large = members.filter(F.col("size") > BLOCK)
    sets = large.select("cluster", "sign", "text").mapInPandas(_sets(words), "cluster long, sign long, shingles array<long>")
    sets = materialise(sets, "sets")
    tokens = sets.select("cluster", "sign", F.size("shingles").alias("n"), F.explode("shingles").alias("token"))
    counts = tokens.groupBy("cluster", "token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = tokens.join(materialise(counts, "counts"), ["cluster", "token"]).groupBy("cluster", "sign", "n")
    # a set: repeated rows of a document are here too
    rarest_first = shared.agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("order"))
    beyond = F.floor((percent * F.col("n") + 99) / 100).cast("int") - 1  # must_share(n) - 1
    kept = rarest_first.withColumn("order", F.slice("order", F.lit(1), F.greatest(F.size("order") - beyond, F.lit(0))))
    kept = materialise(kept.select("cluster", "sign", F.explode("order.token").alias("token")), "rarest")
    parts = components(_stars(kept, "cluster", "token")).select(F.col("node").alias("sign"), F.col("component").alias("cluster"))
    sizes = parts.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    # ids only, so that the texts stay where they are while these can be broadcast
    parts = materialise(parts.join(sizes, "cluster"), "parts")
    found = materialise(large.drop("cluster", "size").join(parts, "sign").select(*members.columns), "members")
    return members.filter(F.col("size") <= BLOCK).union(found)


def _unite(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with ``label`` the smallest sign reached by ``links`` so far."""
    found = components(links).select(F.col("node").alias("sign"), F.col("component").alias("found"))
    joined = members.join(found, "sign", "left")
    return joined.withColumn("label", F.coalesce("found", "sign")).drop("found")


def _links(members: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links whose components are those of all links inside the clusters.

    ``members``: cluster, its size, sign, text, and the sign again as label.
    """
    parts = partitions(members)

    def compare(blocks: DataFrame, *keys: str) -> DataFrame:
        dealt = blocks.select(*keys, "sign", "text", "label", "side").repartition(parts, *keys).sortWithinPartitions(*keys)
        return dealt.mapInPandas(_verify(list(keys), words, percent), "a long, b long")

    def dealt(rows: DataFrame, salt: int) -> DataFrame:
        block = F.pmod(F.xxhash64("sign", F.lit(salt)), F.ceil(F.col("size") / BLOCK))
        return rows.withColumn("block", block).withColumn("side", F.lit(0))

    links = materialise(compare(dealt(members, 0), "cluster", "block"), "links")
    large = members.filter(F.col("size") > BLOCK)
    for salt in range(1, ROUNDS + 1):
        links = materialise(links.union(compare(dealt(_unite(large, links), salt), "cluster", "block")), "links")
    # members outside the largest component of their cluster meet every block of it
    now = materialise(_unite(large.select("cluster", "sign", "size", "label"), links), "labels")
    counted = now.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("of_label"))
    chosen = counted.groupBy("cluster").agg(
        F.max(F.struct("of_label", "label"))["label"].alias("main"), (F.sum("of_label") - F.max("of_label")).alias("strays")
    )
    state = materialise(now.join(chosen.filter("strays > 0"), "cluster"), "strays")
    rows = large.select("sign", "text").join(state, "sign")
    own, most = F.ceil(F.col("size") / BLOCK).cast("int"), F.ceil(F.col("strays") / BLOCK).cast("int")
    columns = ["cluster", "block", "half", "sign", "text", "label", "side"]
    half, block = F.pmod(F.xxhash64("sign", F.lit(-1)), most).cast("int"), F.pmod(F.xxhash64("sign", F.lit(-2)), own).cast("int")
    left = rows.filter("label <> main").withColumn("half", half).withColumn("block", F.explode(F.sequence(F.lit(0), own - 1)))
    right = rows.withColumn("block", block).withColumn("half", F.explode(F.sequence(F.lit(0), most - 1)))
    both = left.withColumn("side", F.lit(1)).select(*columns).union(right.withColumn("side", F.lit(2)).select(*columns))
    return materialise(links.union(compare(both, "cluster", "block", "half")), "links")


def join_documents(docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS, rare: int = RARE_DOCUMENTS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case. A set is the distinct shingles of ``words`` words,
    or all words as one shingle if there are fewer; a null text and one without words have none and link
    with nothing. Documents link when 100 * shared >= ``percent`` * union; the component is the smallest
    doc_id reachable. Equal sets are one class and linked. Rows that share a doc_id are one document with
    several sets. Rows without doc_id get no component and link nothing. An empty table gives no row.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    schema = "doc_id long, version long, sign long, n long, prefix array<long>"
    described = materialise(rows.mapInPandas(_describe(words, percent), schema), "described")
    usable = described.filter("n > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("sign").agg(F.min(F.struct("doc_id", "version")).alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    classes = materialise(classes.select("sign", "first.doc_id", "first.version", "n", "rows"), "classes")

    # one posting per class: the one of its first document; most classes have one row, which stays where it is
    several_rows = Filter.of(classes.filter("rows > 1").select(F.col("sign").alias("h"))).column("sign")
    chosen = usable.filter(several_rows).join(classes.drop("n", "rows"), ["sign", "doc_id", "version"], "left_semi")
    chosen = chosen.dropDuplicates(["sign", "doc_id", "version"]).select("sign", "n", "prefix")
    firsts = usable.filter(~several_rows).select("sign", "n", "prefix").union(materialise(chosen, "firsts"))
    postings = firsts.select("sign", F.col("n").cast("int").alias("n"), F.explode("prefix").alias("token"))
    counts = materialise(postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "counts")
    repeated = Filter.of(counts.select(F.col("token").alias("h")))  # most shingles stand in one document only
    shared = materialise(postings.filter(repeated.column("token")).join(counts, "token"), "postings")

    smallest = lambda n: F.floor((percent * n + 99) / 100)  # noqa: E731  must_share(n)
    guaranteed = lambda n: 3 + F.floor(n / 32)  # noqa: E731  extension(n)
    frequent = shared.filter(F.col("df") > rare).groupBy("sign").agg(F.count(F.lit(1)).alias("frequent"), F.max("n").alias("n"))
    frequent = materialise(frequent, "frequent")
    enough = F.least(guaranteed(smallest(F.col("n"))), F.greatest(smallest(F.col("n")), F.lit(1)))  # enough_frequent(n)
    combined = frequent.filter(F.col("frequent") >= enough).select("sign")

    rare_ones = shared.filter(F.col("df") <= rare).join(frequent.drop("n"), "sign", "left").na.fill(0, ["frequent"])
    lists = rare_ones.groupBy("token").agg(F.collect_list(F.struct("sign", "n", "frequent")).alias("list"))
    pairs = lists.select(F.explode("list").alias("x"), "list").select("x", F.explode("list").alias("y")).filter("x.sign < y.sign")
    low, high = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    pairs = pairs.filter(percent * high <= 100 * low).groupBy(F.col("x.sign").alias("a"), F.col("y.sign").alias("b")).agg(
        F.count(F.lit(1)).alias("rare"), F.max(F.least("x.frequent", "y.frequent")).alias("most"), F.max(F.least(guaranteed(low), smallest(high))).alias("least")
    )
    # shingles that both prefixes hold: the rare ones counted here, and no more frequent ones than either has
    likely = materialise(pairs.filter(F.col("rare") + F.col("most") >= F.col("least")).select("a", "b", "least"), "pairs")
    # and then counted in full
    known = Filter.of(likely.select(F.explode(F.array("a", "b")).alias("h")))
    prefixes = materialise(firsts.filter(known.column("sign")).select("sign", "n", "prefix"), "prefixes")
    both = likely.join(prefixes.toDF("a", "n_a", "of_a"), "a").join(prefixes.toDF("b", "n_b", "of_b"), "b")
    both = both.withColumn("shared", F.size(F.array_intersect("of_a", "of_b"))).filter(F.col("shared") >= F.col("least"))
    edges = materialise(both.filter(_may_link(percent)).select("a", "b"), "edges")

    def texts_of(signs: DataFrame, name: str) -> DataFrame:
        """``signs`` with the text of their class; only texts that a small filter lets through are exchanged."""
        heads = materialise(signs.join(classes.drop("n", "rows"), "sign"), "heads")
        needed = Filter.of(heads.select(F.col("version").alias("h")))
        found = rows.filter(needed.column("version")).join(heads.hint("merge"), ["doc_id", "version"])
        # repeated rows stand next to each other here, and change nothing later
        return materialise(found.select("text", *signs.columns), name)

    keyed = texts_of(combined, "texts").mapInPandas(_keys(words, percent), "sign long, keys array<long>")
    keyed = materialise(keyed.select("sign", F.explode("keys").alias("key")), "keys")
    clusters = components(edges.union(_stars(keyed, "key"))).select(F.col("node").alias("sign"), F.col("component").alias("cluster"))
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    members = _split(texts_of(clusters.join(sizes, "cluster"), "members"), words, percent)

    links = _links(members.withColumn("label", F.col("sign")), words, percent)
    # a document with several sets joins their classes
    several = usable.groupBy("doc_id").agg(F.min("sign").alias("a"), F.max("sign").alias("z")).filter("a <> z").select("doc_id", "a")
    several = usable.select("doc_id", F.col("sign").alias("b")).join(several, "doc_id").select("a", "b")
    united = classes.join(components(links.union(several)), F.col("sign") == F.col("node"), "left")
    united = united.select("sign", "doc_id", F.coalesce("component", "sign").alias("component"))
    lowest = united.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = materialise(united.join(lowest, "component").select("sign", "component_id"), "named")
    result = described.select("doc_id", "n", "sign").join(named, "sign", "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_per_group(docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is its component's, all columns; rows without words or id stay.

    Of rows that repeat one doc_id, those of the kept document stay too.
    """
    found = join_documents(docs, percent, words).filter("doc_id <> component_id").select("doc_id").distinct()
    # written first: as long as the ids that go can be broadcast, no row of docs is exchanged
    found = materialise(found, "dropped")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
