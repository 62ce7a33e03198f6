"""Embedding near-duplicates: spherical k-means cells, blocked cosine products inside cells.

Every vector lives in its nearest cell and visits those cells before its own in which a linked vector
can live at all, so no link is lost. Inside a cell, residents are compared with residents and
visitors in blocks; a task returns counts per vector and the links of a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import partitions
from .components import components
from .jaccard import _groups

MIN_COSINE = 0.9
SAMPLE_ROWS = 20_000  # most vectors that fit the centres; all vectors are indexed
CELL_ROWS = 2_000  # vectors a cell is meant to hold
MAX_CELLS = 4_096
ITERATIONS = 8
SLACK = 1e-7  # more than products of unit vectors are off by
BLOCK = 1_024  # residents on one side of a product
VISITOR_BLOCK = 4_096


def unit_rows(vectors: list) -> np.ndarray:
    """The vectors as unit rows in double precision."""
    rows = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    scale = np.max(np.abs(rows), axis=1, keepdims=True)
    rows = rows / scale
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def spherical_kmeans(rows: np.ndarray, cells: int, iterations: int = ITERATIONS, seed: int = 11) -> np.ndarray:
    """Unit centres; an empty cell takes the row that fits its own centre worst."""
    rng = np.random.default_rng(seed)
    centres = rows[np.sort(rng.choice(len(rows), size=min(cells, len(rows)), replace=False))].copy()
    for _ in range(iterations):
        best, fit = np.empty(len(rows), dtype=np.int64), np.empty(len(rows))
        for a in range(0, len(rows), 1024):
            products = rows[a : a + 1024] @ centres.T
            best[a : a + 1024] = products.argmax(axis=1)
            fit[a : a + 1024] = products.max(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, best, rows)
        norms = np.linalg.norm(sums, axis=1)
        filled = norms > 1e-12
        centres[filled] = sums[filled] / norms[filled, None]
        worst = np.argsort(fit)[: np.count_nonzero(~filled)]
        centres[~filled] = rows[worst]
    return centres


def visited(products: np.ndarray, home: np.ndarray, centres: np.ndarray, min_cosine: float) -> np.ndarray:
    """Which cells can hold a vector linked with each row, from the row's products with the centres.

    Let h be the home centre of x and c that of y, both unit and with cosine t or more. y lies on the side
    of c of the plane through 0 between c and h, and x within the angle of t of y, so x is no farther than
    sqrt(1 - t**2) behind that plane: x.(h - c) <= sqrt(1 - t**2) * |h - c|. This holds for any vectors.
    """
    if min_cosine <= 0:
        return np.ones(products.shape, dtype=bool)
    apart = np.sqrt(np.maximum(2 - 2 * (centres[home] @ centres.T), 0))
    behind = products[np.arange(len(products)), home][:, None] - products
    return behind <= np.sqrt(max(1 - min_cosine**2, 0)) * apart + SLACK


def _dealt(centres: np.ndarray, min_cosine: float):
    """A row per vector and cell: its home, and the cells it visits. Of two cells the first one compares."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in range(0, len(frame), 1024):
                part = frame.iloc[a : a + 1024]
                products = unit_rows(part["embedding"].tolist()) @ centres.T
                home = products.argmax(axis=1)
                near = visited(products, home, centres, min_cosine) & (np.arange(len(centres)) <= home[:, None])
                at, cell = np.nonzero(near)
                yield pd.DataFrame({"cell": cell.astype(np.int32), "lives": home[at] == cell, "vec": part["vec"].to_numpy()[at], "embedding": part["embedding"].array[at]})

    return run


def _products(min_cosine: float):
    """Counts and spanning links of one pair of blocks: rows of side 0 among themselves, or side 1 with side 2."""

    def block(frame: pd.DataFrame) -> pd.DataFrame:
        ids, side, rows = frame["vec"].to_numpy(), frame["side"].to_numpy(), unit_rows(frame["embedding"].tolist())
        one, two = np.flatnonzero(side < 2), np.flatnonzero(side != 1)
        i, j = np.nonzero(rows[one] @ rows[two].T >= min_cosine)
        i, j = one[i], two[j]
        wanted = ((i < j) | (side[i] == 1)) & (ids[i] != ids[j])
        i, j = i[wanted], j[wanted]
        counts = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
        links = _spanning(ids, i, j) if len(i) else []
        counted = np.flatnonzero(counts)
        a = np.concatenate((ids[counted], np.array([x for x, _ in links], dtype=np.int64)))
        b = np.concatenate((counts[counted], np.array([y for _, y in links], dtype=np.int64)))
        return pd.DataFrame({"kind": np.repeat([0, 1], [len(counted), len(links)]).astype(np.int32), "a": a, "b": b})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, bounds in _groups(frames, ["cell", "one", "two"]):
            for a, b in zip(bounds, bounds[1:]):
                if b - a > 1:
                    yield block(frame.iloc[a:b])

    return run


def _spanning(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the given ones connect, at most one per vector: minimum labels, pushed along links."""
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[i], label[j])
        fresh = label.copy()
        np.minimum.at(fresh, i, low)
        np.minimum.at(fresh, j, low)
        fresh = fresh[fresh]
        if np.array_equal(fresh, label):
            break
        label = fresh
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return list(zip(ids[moved].tolist(), ids[label[moved]].tolist()))


def link_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, cell_rows: int = CELL_ROWS, block: int = BLOCK, visitor_block: int = VISITOR_BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept (vec_id = component_id) of every row.

    Links are pairs of vectors with cosine >= ``min_cosine`` in double precision. Vectors that are null,
    empty, zero, of another length than most, or hold null or non-finite components link with nothing, and
    so do rows without vec_id, which have no component. Rows that share a vec_id are not linked with
    each other, but each adds its links. Labels and other columns are not read. An empty table gives no row.

    All links are found, in any number of cells; see ``visited``. Cells only save products: vectors spread
    evenly over many directions can be linked across most cells, and then nearly all pairs are compared.
    """
    parts = partitions(vectors)
    kept = vectors["embedding"] if dict(vectors.dtypes)["embedding"] == "array<float>" else vectors["embedding"].cast("array<double>")
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec"), kept.alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    usable = rows.filter(F.col("vec").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False))).dropDuplicates(["vec", "embedding"])
    lengths = usable.groupBy(F.size("embedding").alias("length")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "length").limit(1).collect()
    found = rows.select(F.col("vec").alias("vec_id"))
    if not lengths:
        return found.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    length, count = lengths[0]
    usable = usable.filter(F.size("embedding") == length)
    cells = min(max(round(count / cell_rows), 1), MAX_CELLS)
    draw = usable.orderBy(F.xxhash64("vec", F.lit(5)), "vec").limit(SAMPLE_ROWS if cells > 1 else 1).select("embedding")
    sample = unit_rows([r[0] for r in draw.collect()])
    centres = spherical_kmeans(sample, cells)
    schema = f"cell int, lives boolean, vec long, embedding {dict(usable.dtypes)['embedding']}"
    dealt = materialise(usable.mapInPandas(_dealt(centres, min_cosine), schema), "cells")

    # the residents of a cell stand in blocks, and its visitors too; blocks of residents meet all blocks
    lives = F.col("lives")
    sizes = dealt.groupBy("cell").agg(F.count(F.when(lives, 1)).alias("residents"), F.count(F.when(~lives, 1)).alias("guests"))
    placed = dealt.join(F.broadcast(sizes), "cell")  # at most MAX_CELLS rows
    own, other = F.ceil(F.col("residents") / block).cast("int"), F.ceil(F.col("guests") / visitor_block).cast("int")
    draw = F.xxhash64("vec", F.lit(3))
    index = F.when(lives, F.pmod(draw, own)).otherwise(own + F.pmod(draw, other)).cast("int")
    meets = F.sequence(F.lit(0), F.when(lives, own + other).otherwise(own) - 1)
    pairs = placed.withColumn("index", index).withColumn("with", F.explode(F.when(own > 0, meets)))
    side = F.when(F.col("index") == F.col("with"), 0).when(F.col("index") < F.col("with"), 1).otherwise(2)
    pairs = pairs.select("cell", F.least("index", "with").alias("one"), F.greatest("index", "with").alias("two"), side.alias("side"), "vec", "embedding")
    ordered = pairs.repartition(parts, "cell", "one", "two").sortWithinPartitions("cell", "one", "two")
    seen = materialise(ordered.mapInPandas(_products(min_cosine), "kind int, a long, b long"), "links")

    counts = seen.filter("kind = 0").groupBy("a").agg(F.sum("b").alias("n_links"))
    groups = components(seen.filter("kind = 1").select("a", "b"))
    named = found.join(counts, F.col("vec_id") == F.col("a"), "left").join(groups, F.col("vec_id") == F.col("node"), "left")
    component = F.coalesce("component", "vec_id")
    return named.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def representatives(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """The rows of ``vectors`` that stand for their group, all columns; unusable vectors stay."""
    gone = link_vectors(vectors, min_cosine).filter("NOT kept AND vec_id IS NOT NULL").select("vec_id").distinct()
    return vectors.join(gone, "vec_id", "left_anti").select(*vectors.columns)
