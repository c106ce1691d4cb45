"""Correlations of many column pairs from blocked matrix products.

A row costs one product of its values with each block of columns, not one row per pair. A task keeps the sums of its own
rows for each pair of blocks and gives them out once, at its end; Spark adds them up by pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512  # columns of a block: the sums of a pair of blocks are 12 MB
BLOCKS_AT_ONCE = 12  # pairs of blocks that a task keeps; more are taken in further passes over their columns
ROWS_AT_ONCE = 2048  # rows of one product
FLAT = 1e-12  # a spread below this share of the squares summed is rounding only
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
PARTIAL = "at bigint, " + ", ".join(f"{s} double" for s in SUMS)


def _values(columns: Sequence[str]) -> Column:
    """The columns as one array of numbers, null where one is missing."""

    def finite(x: Column) -> Column:
        return F.when(F.abs(x) < float("inf"), x)

    return F.transform(F.array(*[F.col(c).cast("double") for c in columns]), finite)


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The six sums over the rows in which both of a pair are present, for all pairs of columns of two blocks."""
    has_x, has_y = np.isfinite(x), np.isfinite(y)
    x, y = np.where(has_x, x, 0.0), np.where(has_y, y, 0.0)
    mx, my = has_x.astype("float64"), has_y.astype("float64")
    return np.stack([mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y])


def _pass(df: DataFrame, columns: Sequence[str], means: Column, tiles: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """Partial sums of the pairs of some pairs of blocks. A tile maps to (pair number, row in it, column in it)."""
    where, used = {}, []
    for b in sorted({b for t in tiles for b in t}):
        own = range(b * BLOCK, min((b + 1) * BLOCK, len(columns)))
        where[b] = (len(used), len(used) + len(own))
        used += own
    width = len(used)
    shifts = F.transform(F.array(*[F.lit(k) for k in used]), lambda k: F.get("__m", k))
    values = df.select(_values([columns[k] for k in used]).alias("v"), means.alias("__m"))
    values = values.select(F.zip_with("v", shifts, lambda x, m: x - m).alias("v"))

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                rows = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                for tile in tiles:
                    x, y = (rows[:, where[b][0]:where[b][1]] for b in tile)
                    found = _products(x, y)
                    kept[tile] = kept[tile] + found if tile in kept else found
        for tile, sums in kept.items():
            at, i, j = tiles[tile]
            picked = sums[:, i, j]
            for first in range(0, len(at), 10000):
                piece = slice(first, first + 10000)
                yield pa.RecordBatch.from_arrays([pa.array(at[piece]), *[pa.array(s[piece]) for s in picked]], names=["at", *SUMS])

    return values.mapInArrow(partials, PARTIAL)


def correlations(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """(at, value, pairs) for each pair of column numbers: its place in the list, its correlation and its common rows.

    Null, NaN and infinite values are missing. A row counts for a pair in which both sides are present; a pair without such a
    row has no row here. Correlation with a column that is constant on those rows, or varies there by rounding only
    (``FLAT``), is null. Columns are shifted by their means first, so that large values with a small spread keep their digits.
    """
    single = df.select(F.posexplode(_values(columns)).alias("k", "x")).groupBy("k").agg(F.coalesce(F.avg("x"), F.lit(0.0)).alias("m"))
    means = single.agg(F.array_sort(F.collect_list(F.struct("k", "m")))["m"].alias("m")).scalar()
    i, j = np.array(pairs, dtype="int64").reshape(-1, 2).T
    tile_of = (i // BLOCK) * (len(columns) // BLOCK + 1) + j // BLOCK
    tiles = {}
    for t in np.unique(tile_of):
        at = np.flatnonzero(tile_of == t)
        tiles[int(i[at[0]] // BLOCK), int(j[at[0]] // BLOCK)] = (at, i[at] % BLOCK, j[at] % BLOCK)
    order = list(tiles)
    found = None
    for first in range(0, len(order), BLOCKS_AT_ONCE):
        part = _pass(df, columns, means, {t: tiles[t] for t in order[first:first + BLOCKS_AT_ONCE]})
        found = part if found is None else found.unionByName(part)
    total = found.groupBy("at").agg(*[F.sum(s).alias(s) for s in SUMS]).where("n > 0")
    return total.select("at", _correlation().alias("value"), F.col("n").cast("bigint").alias("pairs"))


def _correlation() -> Column:
    n, sx, sy, sxx, syy, sxy = (F.col(s) for s in SUMS)

    def spread(s: Column, squares: Column) -> Column:
        rest = squares - s * s / n
        return F.when(rest > FLAT * squares, rest)

    bound = F.least(F.lit(1.0), (sxy - sx * sy / n) / F.sqrt(spread(sx, sxx) * spread(sy, syy)))
    return F.when(spread(sx, sxx).isNotNull() & spread(sy, syy).isNotNull(), F.greatest(F.lit(-1.0), bound))
