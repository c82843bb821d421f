"""Sums of products of columns, pairwise complete, in one pass of fixed plan size.

With x the columns (zero where missing) and m their masks (1 where present), every pairwise statistic
follows from the four matrices x'x, x'm, (x²)'m and m'm. A task adds up one set of them per group in
numpy, batch by batch; Spark sums the sets element by element. Any number of columns, with or without
missing values, has the same plan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Products:
    """k x k matrices over rows where both columns are present: [i, j] sums x_i x_j, x_i, x_i² and 1."""

    xx: np.ndarray
    x: np.ndarray
    x2: np.ndarray
    n: np.ndarray

    def __sub__(self, other: Products) -> Products:
        return Products(self.xx - other.xx, self.x - other.x, self.x2 - other.x2, self.n - other.n)

    def __add__(self, other: Products) -> Products:
        return Products(self.xx + other.xx, self.x + other.x, self.x2 + other.x2, self.n + other.n)

    def correlation(self) -> np.ndarray:
        """Pearson's r of every pair over its complete rows; NaN below two rows or without variance."""
        n = np.where(self.n > 1, self.n, np.nan)
        sxx = self.x2 - self.x * self.x / n
        sxy = self.xx - self.x * self.x.T / n
        # a variance below the rounding of its own sums is none
        sxx = np.where(sxx > 1e-12 * np.maximum(self.x2, 1e-300), sxx, np.nan)
        return sxy / np.sqrt(sxx * sxx.T)


def products(df: DataFrame, cols: list[str], group: str | None = None, shift: list[float] | None = None) -> dict[int | None, Products]:
    """Products per value of the integer column ``group`` (one set without it), of the columns less ``shift``.

    NaN is missing. k² numbers a group reach the driver."""
    k = len(cols)
    x = [F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in cols]
    of = F.col(f"`{group}`").cast("int") if group else F.lit(0)
    center = np.array(shift if shift is not None else [0.0] * k)

    def sums(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            cells = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[1:]])
            mask = (~np.isnan(cells)).astype(float)
            cells = np.where(mask > 0, cells - center, 0.0)
            groups = b.column(0).to_numpy(zero_copy_only=False)
            for g in np.unique(groups):
                v, m = cells[groups == g], mask[groups == g]
                here = np.concatenate([(v.T @ v).ravel(), (v.T @ m).ravel(), ((v * v).T @ m).ravel(), (m.T @ m).ravel()])
                held[int(g)] = held.get(int(g), 0) + here
        for g, s in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), g, np.int32)), pa.array(np.arange(len(s), dtype=np.int32)), pa.array(s)], ["grp", "at", "s"])

    parts = df.select(of.alias("grp"), *[c.alias(f"x{i}") for i, c in enumerate(x)]).where("grp IS NOT NULL")
    rows = parts.mapInArrow(sums, "grp int, at int, s double").groupBy("grp", "at").agg(F.sum("s").alias("s")).collect()
    flat: dict[int, np.ndarray] = {}
    for r in rows:
        flat.setdefault(r["grp"], np.zeros(4 * k * k))[r["at"]] = r["s"]
    return {g if group else None: Products(*s.reshape(4, k, k)) for g, s in flat.items()}


def means(df: DataFrame, cols: list[str]) -> list[float]:
    """The mean of every column, 0 for one without values: a shift that keeps sums of products small."""
    row = df.agg(*[F.avg(F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan")))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return [float(m or 0.0) for m in row]
