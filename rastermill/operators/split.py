"""Assignment of windows to training, validation and test.

The validation share of an image depends on the splits of the images before it, through three possible ratios only
(the given one, raised, lowered). Cells are therefore chosen for all three in parallel, and the ordered fold on
the driver reads a few counts for each image, never windows or pixels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import CLASS_IDS, drifts

MIN_CELLS_PATCHES = 5
TARGET_TRAIN, TARGET_VAL, STEP = 0.8, 0.2, 0.05
LOWEST, HIGHEST = 0.1, 0.3
PRESENT = 0.01


def adjusted(ratio: float, train: float, val: float) -> float:
    """The validation ratio after shares train and val so far: changed only while training drifts from its target."""
    if abs(train - TARGET_TRAIN) <= 0.03:
        return ratio
    return max(LOWEST, ratio - STEP) if val > TARGET_VAL else min(HIGHEST, ratio + STEP)


def options(ratio: float) -> list[float]:
    """All values that `adjusted` can give."""
    return sorted({ratio, max(LOWEST, ratio - STEP), min(HIGHEST, ratio + STEP)})


def adjusted_column(ratio: float, train: Column, val: Column) -> Column:
    lower, higher = F.lit(max(LOWEST, ratio - STEP)), F.lit(min(HIGHEST, ratio + STEP))
    return F.when(~drifts(train), F.lit(ratio)).when(val > TARGET_VAL, lower).otherwise(higher)


def ratios_so_far(counts: DataFrame, ratio: float) -> DataFrame:
    """(prefix, pair_ord, ratio) of each image from the counts (n_trn, n_val, n_tst) of those before it."""
    before = Window.partitionBy("prefix").orderBy("pair_ord").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum(F.col("n_trn") + F.col("n_val") + F.col("n_tst")).over(before), F.lit(0))
    share = lambda c: F.when(total > 0, F.coalesce(F.sum(c).over(before), F.lit(0)) / total).otherwise(F.lit(0.0))
    return counts.select("prefix", "pair_ord", share("n_trn").alias("train"), share("n_val").alias("val")).select("prefix", "pair_ord", adjusted_column(ratio, F.col("train"), F.col("val")).alias("ratio"))


def choose_cells(shares: np.ndarray, target: np.ndarray, grid: int, total_patches: int, ratio: float, class_weight: float = 0.5, spatial_weight: float = 0.5) -> list[int]:
    """Numbers (gx * grid + gy) of the chosen cells, in order; shares is (grid * grid, classes).

    First cells that bring classes not covered yet, ten points for each; then by balance and distance. Ties go
    to the lowest number.
    """
    wanted = max(MIN_CELLS_PATCHES, int(total_patches * ratio))
    per_cell = total_patches / (grid * grid)
    gx, gy = np.divmod(np.arange(grid * grid), grid)
    score = np.zeros(len(shares))
    for k in range(shares.shape[1]):  # in class order, so that sums are the same everywhere
        score = score + np.abs(shares[:, k] - target[k])
    has = shares > PRESENT
    covered = np.zeros(shares.shape[1], bool)
    free = np.ones(len(shares), bool)
    nearest = np.full(len(shares), np.inf)
    chosen, expected = [], 0.0
    while expected < wanted and free.any():
        if chosen:
            far = -nearest
        else:
            m = np.maximum(gx, gy)
            far = np.where(m == 0, 0.0, -(np.abs(gx - m / 2) + np.abs(gy - m / 2)))
        new = (has & ~covered).sum(axis=1)
        pool = free & (new > 0)
        if pool.any():
            value = -10.0 * new + class_weight * score + spatial_weight * far
        else:
            pool = free
            value = class_weight * score + spatial_weight * far
        best = int(np.where(pool, value, np.inf).argmin())
        chosen.append(best)
        free[best] = False
        covered |= has[best]
        expected += per_cell
        nearest = np.minimum(nearest, np.abs(gx - gx[best]) + np.abs(gy - gy[best]))
    return chosen


def validation_cells(cells: DataFrame, target: dict[str, float], grid: int, ratios: list[float], class_ids: dict[str, int] = CLASS_IDS, class_weight: float = 0.5, spatial_weight: float = 0.5) -> DataFrame:
    """(image_id, ratio, gx, gy, cell_id, pick): the chosen cells of every image for each ratio, in order of choice.

    cells has (image_id, gx, gy, class_name, share, total_patches): grid * grid * classes rows an image.
    """
    names = list(class_ids)
    goal = np.array([target.get(n, 0.0) for n in names])

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        shares = np.zeros((grid * grid, len(names)))
        at = frame["class_name"].map({n: k for k, n in enumerate(names)})
        shares[frame["gx"] * grid + frame["gy"], at] = frame["share"]
        out = []
        for ratio in ratios:
            picks = choose_cells(shares, goal, grid, int(frame["total_patches"].iloc[0]), ratio, class_weight, spatial_weight)
            out += [(key[0], ratio, p // grid, p % grid, f"{p // grid}_{p % grid}", k) for k, p in enumerate(picks)]
        return pd.DataFrame(out, columns=["image_id", "ratio", "gx", "gy", "cell_id", "pick"])

    kind = dict(cells.dtypes)["image_id"]
    return cells.groupBy("image_id").applyInPandas(run, f"image_id {kind}, ratio double, gx int, gy int, cell_id string, pick int")


def random_cells(grid: int, ratio: float, seed: int | None) -> list[str]:
    """Cells drawn without replacement; the number is rounded half to even and at least 1."""
    ids = [f"{x}_{y}" for x in range(grid) for y in range(grid)]
    n = min(len(ids), max(1, round(len(ids) * ratio)))
    return [str(c) for c in np.random.default_rng(seed).choice(ids, size=n, replace=False)]


def assign(wins: DataFrame, chosen: DataFrame, test: bool = False) -> DataFrame:
    """wins (image_id, cell_id, ...) with split: validation in a chosen cell, else training; all test in test mode."""
    if test:
        return wins.withColumn("split", F.lit("tst"))
    marked = chosen.select("image_id", "cell_id").distinct().withColumn("_val", F.lit(True))
    return wins.join(marked, ["image_id", "cell_id"], "left").withColumn("split", F.when(F.col("_val"), "val").otherwise("trn")).drop("_val")


def fold(counts: list[tuple[str, dict[float, tuple[int, int]]]], ratio: float, so_far: tuple[int, int, int] = (0, 0, 0)) -> dict[str, float]:
    """The ratio of each image, in order, from its (training, validation) counts under each possible ratio."""
    trn, val, tst = so_far
    out = {}
    for image, by in counts:
        total = trn + val + tst
        out[image] = r = adjusted(ratio, trn / total if total else 0.0, val / total if total else 0.0)
        trn, val = trn + by[r][0], val + by[r][1]
    return out
