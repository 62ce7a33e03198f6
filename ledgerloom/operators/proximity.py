"""Pairs of points within a radius, through grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import EARTH_RADIUS_MILES, KM_PER_MILE, haversine_distance
from ..session import materialise, scratch_dir

LEAST_REACH = 1e-6  # degrees
CELL = ["_band", "_cell"]

# A point is copied to every slice of the other side of its cell, so that a cell is cut into no more
# slices than this, unless they would have more points than SLICE_ROWS.
MOST_SLICES = 64
SLICE_ROWS = 20_000
FEW_SLICES, PAIRS_TO_MEET = 8, 100_000  # beyond so few slices of a side, two that meet have so many candidates
PAIRS_PER_SLICE = 5_000_000  # candidates of two slices that meet; both sides are cut further where it would be more
PAIRS_PER_TASK = 20_000_000


def _slices(n: Column, hot_rows: int) -> Column:
    """Slices of ``n`` points of a cell: of ``hot_rows``, but not more than MOST_SLICES while none is larger than SLICE_ROWS."""
    most = F.greatest(F.lit(MOST_SLICES), F.ceil(n / SLICE_ROWS))
    return F.least(F.ceil(n / hot_rows), most)


def _met_cells(a: DataFrame, b: DataFrame, hot_rows: int) -> DataFrame:
    """Cells with points of both sides: candidate pairs, and slices of each side."""
    counted = [side.groupBy(*CELL).agg(F.count(F.lit(1)).alias(n)) for side, n in ((a, "_na"), (b, "_nb"))]
    met = counted[0].join(counted[1], CELL).withColumn("_pairs", F.col("_na") * F.col("_nb"))
    # more slices would cost copies, which are exchanged, and spread work that is not there
    worth = F.greatest(F.lit(FEW_SLICES), F.floor(F.sqrt(F.col("_pairs") / PAIRS_TO_MEET)))
    cut = lambda n: F.least(_slices(n, hot_rows), F.greatest(worth, F.ceil(n / SLICE_ROWS)))
    met = met.withColumn("_sa", cut(F.col("_na"))).withColumn("_sb", cut(F.col("_nb")))
    # slices of about equal size on both sides, so that copies grow with the pairs and no faster
    work = F.col("_pairs") / PAIRS_PER_SLICE
    more = F.when(work > F.col("_sa") * F.col("_sb"), F.ceil(F.sqrt(work * F.col("_na") / F.col("_nb"))))
    met = met.withColumn("_sa", F.greatest(F.col("_sa"), F.least(F.col("_na"), F.coalesce(more, F.lit(1)))))
    met = met.withColumn("_sb", F.greatest(F.col("_sb"), F.least(F.col("_nb"), F.ceil(work / F.col("_sa")))))
    return met.select(*CELL, "_pairs", F.col("_sa").alias("_na"), F.col("_sb").alias("_nb"))


def _sliced(points: DataFrame, slices: DataFrame, own: str, own_count: str, key: str, other: str, other_count: str) -> DataFrame:
    """Put each point into one slice of its own side, once per slice of the other side."""
    one = F.lit(1).cast("bigint")
    joined = points.join(slices, CELL, "left")  # the planner sees the written table's size
    mine = F.pmod(F.xxhash64(key), F.coalesce(F.col(own_count), one))
    theirs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(other_count), one) - 1))
    return joined.withColumn(own, mine).withColumn(other, theirs).drop(own_count, other_count)


def proximity_pairs(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    unit: str = "km",
    lat: str = "lat",
    lon: str = "lon",
    left_id: str = "left_id",
    right_id: str = "right_id",
    hot_rows: int = 20_000,
) -> DataFrame:
    """All (left_id, right_id, distance) with distance <= ``radius``.

    Points meet in latitude bands and longitude cells about one radius wide.
    Cells of a band are sized for its end nearest to the pole, so one step
    sideways always covers the radius; bands where that is impossible, near the
    poles or for a radius of thousands of kilometres, have one cell, and all pairs of
    such a band are candidates. A cell with more than ``hot_rows`` points of a side is cut into slices
    of that size, or into MOST_SLICES larger ones, fewer still if the pairs of the cell are few, and each slice meets
    every slice of the other side once.
    The number of tasks follows the candidate pairs, not the bytes of the points.
    """
    scratch_dir(left.sparkSession)
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    miles = radius / (KM_PER_MILE if unit == "km" else 1)
    # a tenth of a metre at least, so that a radius of 0 has cells too
    reach = max(math.degrees(miles / EARTH_RADIUS_MILES), LEAST_REACH)
    band_height = reach * 1.000001

    def band(c: Column) -> Column:
        return F.floor((c + 90) / band_height)

    def cells_in(b: Column) -> Column:
        """Number of cells around the globe in a band, 1 near the poles."""
        low = b * band_height - 90
        # a neighbour in the next band lies up to one band nearer to the pole
        edge = F.greatest(F.abs(low - band_height), F.abs(low + 2 * band_height))
        half = math.sin(math.radians(min(reach, 180) / 2))
        ratio = F.lit(half) / F.cos(F.radians(F.least(edge, F.lit(89.999))))
        width = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * 2
        return F.when(
            (edge >= 89.0) | (ratio >= 1.0), F.lit(1).cast("bigint")
        ).otherwise(F.greatest(F.floor(F.lit(360.0) / (width * 1.000001)), F.lit(1).cast("bigint")))

    def cell(c: Column, n: Column) -> Column:
        turned = c + 180
        return F.floor((turned - F.floor(turned / 360) * 360) / 360 * n) % n

    a = left.select(F.col(left_id).alias("left_id"), F.col(lat).cast("double").alias("a_lat"), F.col(lon).cast("double").alias("a_lon"))
    a = a.filter(F.col("a_lat").isNotNull() & F.col("a_lon").isNotNull()).withColumn("_band", band(F.col("a_lat")))
    a = a.withColumn("_cell", cell(F.col("a_lon"), cells_in(F.col("_band"))))

    b = right.select(F.col(right_id).alias("right_id"), F.col(lat).cast("double").alias("b_lat"), F.col(lon).cast("double").alias("b_lon"))
    b = b.filter(F.col("b_lat").isNotNull() & F.col("b_lon").isNotNull()).withColumn("_own", band(F.col("b_lat")))
    b = b.withColumn("_band", F.explode(F.array(F.col("_own") - 1, F.col("_own"), F.col("_own") + 1)))
    b = b.withColumn("_cells", cells_in(F.col("_band"))).withColumn("_at", cell(F.col("b_lon"), F.col("_cells")))
    around = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(F.col("_at") + d, F.col("_cells"))))
    b = b.withColumn("_cell", F.explode(around))

    cells = materialise(_met_cells(a, b, hot_rows), "cells")
    copies = F.col("_na") + F.col("_nb")  # at least the copies of a point
    work = cells.agg(F.sum("_pairs").alias("pairs"), F.max(copies).alias("copies"), F.count(F.lit(1)).alias("cells")).first()
    if not work["cells"]:
        met = a.join(b, CELL)
    else:
        on, slices = list(CELL), cells.filter("_na > 1 OR _nb > 1").drop("_pairs")
        if work["copies"] > 2:
            a = _sliced(a, slices, "_sa", "_na", "left_id", "_sb", "_nb")
            b = _sliced(b, slices, "_sb", "_nb", "right_id", "_sa", "_na")
            on += ["_sa", "_sb"]
        tasks = math.ceil(work["pairs"] / PAIRS_PER_TASK)
        if tasks > 1:
            tasks = max(tasks, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            a, b = a.repartition(tasks, *on), b.repartition(tasks, *on).hint("merge")
        met = a.join(b, on)
    # the band's neighbours reach further than the radius
    met = met.filter(F.abs(F.col("a_lat") - F.col("b_lat")) <= band_height * 1.001)
    distance = haversine_distance("a_lat", "a_lon", "b_lat", "b_lon", unit)
    return met.select("left_id", "right_id", distance.alias("distance")).filter(F.col("distance") <= radius)
