"""Mixing sources to target weights that change over the course of training.

Each source has a schedule of weights over training time 0..1, linear between its points. Integrated, the
schedules give every source's share; a source may be repeated up to ``MAX_REPEATS`` times, and what it
cannot give is shared among the others by weight. A document takes the place in its source's token count
that a seeded shuffle gives it; inverting the source's cumulative demand turns that place into a training
position, and a range sort by position is the training order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ordered import positions
from ..session import materialise
from .common import as_row, partitions

MAX_REPEATS = 3
ROWS_PER_BUCKET = 50_000
TRIED_SIZES, TRIED_SUMS, TRIED_COPIES = 200, 4096, 3  # looked at to make up for a source's cut document
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"

Schedule = Callable[[Column], Sequence[tuple[float, Column]]]


def rising_and_falling(rank: Column) -> list[tuple[float, Column]]:
    """Weights 1, 2, 3, repeating over the sources; odd sources start high and fall, even ones rise."""
    weight = ((rank - 1) % 3 + 1).cast("double")
    tilt = F.when(rank % 2 == 1, 0.25).otherwise(-0.25)
    return [(0.0, weight * (1 + tilt)), (0.5, weight), (1.0, weight * (1 - tilt))]


def word_count(text: Column) -> Column:
    """Words of a text; none in a null."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def integral(points: Sequence[tuple[float, Column]]) -> Column:
    """Area under a schedule that is linear between its points."""
    area = F.lit(0.0)
    for (t0, w0), (t1, w1) in zip(points, points[1:]):
        area = area + (w0 + w1) * F.lit((t1 - t0) / 2)
    return area


def inverse_demand(points: Sequence[tuple[float, Column]], share: Column) -> Column:
    """Training time at which the schedule has used up ``share`` (0..1) of its area."""
    wanted = share * integral(points)
    before, found = F.lit(0.0), F.lit(points[-1][0])
    pieces = []
    for (t0, w0), (t1, w1) in zip(points, points[1:]):
        span, area = t1 - t0, (w0 + w1) * F.lit((t1 - t0) / 2)
        need, slope = F.greatest(wanted - before, F.lit(0.0)), (w1 - w0) / F.lit(span)
        # w0 * s + slope * s**2 / 2 = need, in the form that is stable for a slope of 0
        root = F.sqrt(F.greatest(w0 * w0 + slope * need * 2, F.lit(0.0)))
        pieces.append((wanted <= before + area, F.least(F.lit(t0) + F.coalesce(F.try_divide(need * 2, w0 + root), F.lit(0.0)), F.lit(t1))))
        before = before + area
    for inside, at in reversed(pieces):
        found = F.when(inside, at).otherwise(found)
    return found


def source_key(source: Column) -> Column:
    """A key that sorts sources by code point with null last, and never is null."""
    return F.when(source.isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def targets(sizes: DataFrame, schedule: Schedule = rising_and_falling, budget: int | None = None, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sizes`` (source_key, source_size) with rank, weight and target in words.

    The sources share ``budget`` words (by default all there are) by the integrals of their schedules. No
    target exceeds ``max_repeats`` times the source's size; the excess goes to the others by weight until
    none is above. Every round fills at least one more source, and only three sums reach the driver.
    """
    ranked = positions(sizes, [F.col("source_key").asc()], name="rank")
    weighed = materialise(ranked.withColumn("weight", integral(schedule(F.col("rank")))), "sources")
    most = F.col("source_size").cast("double") * max_repeats
    level, full = 0.0, -1
    if budget is None:
        budget = weighed.agg(F.sum("source_size")).first()[0] or 0
    while True:  # level: words per unit of weight; a source at its limit is full
        above = most <= F.col("weight") * level
        sums = weighed.agg(F.count(F.when(above, 1)), F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight")))).first()
        if sums[0] == full or not sums[2]:
            break
        full, level = sums[0], max((budget - (sums[1] or 0.0)) / sums[2], level)
    return weighed.withColumn("target", F.least(most, F.col("weight") * level))


def mix(
    docs: DataFrame,
    keep: Sequence[str] | None = None,
    schedule: Schedule = rising_and_falling,
    budget: int | None = None,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``row`` (its columns, or those of ``keep``), size, source_size, target, rounds,
    place, taken, position.

    A source's documents stand in an order drawn from their content and ``seed``; ``place`` counts its words
    before the document. The source runs through that order again and again until its target, rounded to
    words, is reached: ``rounds`` whole times, then up to a document that may be cut. ``taken`` counts the
    words that the mix takes from the document, ``position`` is the training time 0..1 of its first use, null
    if it has none. A null text has size 0; null sources are one source; repeated rows are documents of their
    own. Reruns agree. An empty table gives no row.
    """
    text = docs["text"].cast("string")
    row = as_row(docs) if keep is None else as_row(docs.select(*keep))
    draw = F.xxhash64(F.lit(seed), docs["doc_id"], text)
    sized = docs.select(row, source_key(docs["source"]).alias("source_key"), word_count(text).alias("size"), draw.alias("draw"))
    # a bucket is a range of the drawn order, so even one huge source spreads over all buckets
    buckets = max(-(-docs.count() // ROWS_PER_BUCKET), partitions(docs))
    bucket = F.shiftright(F.shiftrightunsigned("draw", 32) * buckets, 32)
    sized = sized.withColumn("bucket", bucket)
    sums = materialise(sized.groupBy("source_key", "bucket").agg(F.sum("size").alias("words")), "buckets")
    chosen = targets(sums.groupBy("source_key").agg(F.sum("words").alias("source_size")), schedule, budget, max_repeats)
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    starts = starts.join(chosen, "source_key")

    inside = Window.partitionBy("source_key", "bucket").orderBy(F.shiftrightunsigned("draw", 32), "draw").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["source_key", "bucket"])
    place, wanted = F.col("start") + F.col("inside"), F.round("target").cast("long")
    rounds = F.coalesce(F.try_divide(wanted, F.col("source_size")), F.lit(0.0)).cast("long")
    rest = wanted - rounds * F.col("source_size")
    placed = placed.withColumn("place", place).withColumn("rounds", rounds)
    taken = F.col("rounds") * F.col("size") + F.greatest(F.least(rest - F.col("place"), F.col("size")), F.lit(0))
    placed = placed.withColumn("taken", taken.cast("long"))
    first = position_at(schedule, F.col("place"))
    return placed.select(
        "row", "size", "source_size", "target", "rank", "rounds", "place", "taken", F.when(F.col("taken") > 0, first).alias("position")
    )


def position_at(schedule: Schedule, words: Column) -> Column:
    """Training time at which a source has given ``words`` words."""
    return inverse_demand(schedule(F.col("rank")), F.coalesce(F.try_divide(words.cast("double"), F.col("target")), F.lit(0.0)))


def _made_up(sizes: pd.DataFrame) -> pd.DataFrame:
    """How many documents of each size (change 1: used once more, -1: once less, 0: the cut one, used whole) bring a source nearest to its target."""
    rank, gap = sizes["rank"].iloc[0], int(sizes["gap"].iloc[0])
    items, most = [(0, gap + int(sizes["over"].iloc[0]))], int(sizes["size"].max())
    for change in (1, -1):
        own = sorted(zip(sizes["size"][sizes["change"] == change].tolist(), sizes["count"][sizes["change"] == change].tolist()), reverse=True)
        step = -(-len(own) // TRIED_SIZES) or 1
        items += [(change, size) for size, count in own[::step] for _ in range(min(count, TRIED_COPIES))]
    reached: dict[int, tuple] = {0: ()}  # words added: the items that add them, as a chain
    for change, size in sorted(items, key=lambda item: -item[1]):
        words = size if change >= 0 else -size
        fresh = {at + words: ((change, size), chain) for at, chain in reached.items() if abs(at + words - gap) <= most and at + words not in reached}
        reached |= fresh
        if gap in reached:
            break
        if len(reached) > TRIED_SUMS:
            reached = {at: reached[at] for at in sorted(reached, key=lambda at: (abs(at - gap), at))[:TRIED_SUMS]}
    chain, uses = reached[min(reached, key=lambda at: (abs(at - gap), at))], {}
    while chain:
        item, chain = chain
        uses[item] = uses.get(item, 0) + 1
    return pd.DataFrame([(rank, size, change, n) for (change, size), n in uses.items()], columns=["rank", "size", "change", "uses"])


def whole_uses(mixed: DataFrame) -> DataFrame:
    """rank, place, change of the documents used once more (1) or once less (-1), so that no text is cut and targets are nearly met.

    Documents of a few sizes make up for the one that a source's target cuts; a source misses its target by half of that one at most.
    """
    rest, size = F.col("taken") - F.col("rounds") * F.col("size"), F.col("size")
    last = materialise(mixed.filter("size > 0").select("rank", "place", "size", rest.alias("rest")), "last")
    cut = last.filter("rest > 0 AND rest < size").select("rank", F.col("place").alias("at"), F.col("rest").alias("gap"), (size - F.col("rest")).alias("over"))
    cut = materialise(cut, "cut")
    change = F.when(F.col("place") == F.col("at"), 0).when(F.col("rest") > 0, -1).otherwise(1)
    near = last.join(cut, "rank").withColumn("change", change)
    counted = near.groupBy("rank", "size", "change", "gap", "over").count()
    uses = counted.groupBy("rank").applyInPandas(_made_up, "rank long, size long, change int, uses long")
    first = F.row_number().over(Window.partitionBy("rank", "size", "change").orderBy("place"))
    chosen = near.withColumn("nth", first).filter(F.col("nth") <= TRIED_COPIES).join(uses, ["rank", "size", "change"]).filter("nth <= uses")
    return materialise(chosen.select("rank", "place", F.when(F.col("change") == 0, 1).otherwise(F.col("change")).alias("change")), "changes")


def training_order(docs: DataFrame, schedule: Schedule = rising_and_falling, **options) -> DataFrame:
    """``docs`` as the training run reads them: one row per use of a document, range-sorted by position.

    Rows and columns are those of ``docs``, texts stay whole: the document in which a source reaches its target is used or not, and others
    make up for it (see ``whole_uses``), so a source misses its target by few words, and by half a document at most.
    Documents that the mix does not take are left out (see ``mix``); documents without words add nothing to any
    target and stay once, at their place.
    """
    mixed = mix(docs, schedule=schedule, **options)
    rest = F.col("taken") - F.col("rounds") * F.col("size")
    met = (F.col("m.rank") == F.col("c.rank")) & (F.col("m.place") == F.col("c.place")) & (F.col("m.size") > 0)
    mixed = mixed.alias("m").join(whole_uses(mixed).alias("c"), met, "left").select("m.*", "change")
    last = F.when(rest == F.col("size"), 1).otherwise(0) + F.coalesce("change", F.lit(0))
    uses = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("rounds") + last)
    use = mixed.withColumn("use", F.explode(F.filter(F.sequence(F.lit(0), uses.cast("int")), lambda i: i < uses)))
    at = position_at(schedule, F.col("place") + F.col("use") * F.col("source_size"))
    placed = use.select("row", at.alias("at"), F.xxhash64("row.doc_id", "row.text").alias("tie"))
    ordered = placed.repartitionByRange(partitions(docs), "at", "tie").sortWithinPartitions("at", "tie")
    return ordered.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
