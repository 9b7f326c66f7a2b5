"""Exact k nearest neighbours among distinct weighted points, cell by cell.

A bounded sample cuts the space into boxes of similar size.  Each box finds the
neighbours of its own points; a point whose k-th neighbour is farther away than
the border of its box also asks the boxes its ball reaches.  Equal points are one
weighted point, so copies never fill a box.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlens.functions.hashing import uniform
from scanlens.limits import DRIVER_ROWS
from scanlens.session import written

CELL_POINTS = 500
_SAMPLE_PER_CELL = 20
_QUERIES_PER_TASK = 50_000
_BLOCK_NUMBERS = 4_000_000  # numbers per distance block (32 MB)

_FOUND = "point string, distance double, other string, weight long, vector array<double>"


@dataclass
class Cells:
    """Boxes of a binary space partition; leaves are the cells."""

    dimension: np.ndarray  # -1 marks a leaf
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def locate(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        while True:
            open_rows = rows[self.dimension[node] >= 0]
            if not len(open_rows):
                return node
            at = node[open_rows]
            goes_left = x[open_rows, self.dimension[at]] < self.value[at]
            node[open_rows] = np.where(goes_left, self.left[at], self.right[at])

    def touched(self, x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) pairs whose box lies within the radius of the row's point."""
        rows, nodes = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        found_rows, found_cells = [], []
        while len(rows):
            outside = np.maximum(np.maximum(self.low[nodes] - x[rows], x[rows] - self.high[nodes]), 0.0)
            near = (outside**2).sum(axis=1) <= radius[rows] ** 2
            rows, nodes = rows[near], nodes[near]
            leaf = self.dimension[nodes] < 0
            found_rows.append(rows[leaf])
            found_cells.append(nodes[leaf])
            rows, nodes = rows[~leaf], nodes[~leaf]
            rows, nodes = np.concatenate([rows, rows]), np.concatenate([self.left[nodes], self.right[nodes]])
        return np.concatenate(found_rows or [rows]), np.concatenate(found_cells or [nodes])


def cut_cells(sample: np.ndarray, leaf_rows: int) -> Cells:
    """Halve the sample along its widest dimension until a box holds ``leaf_rows`` of it."""
    width = sample.shape[1]
    dimension, value, left, right, low, high = [], [], [], [], [], []

    def add(lo, hi) -> int:
        for column, item in zip((dimension, value, left, right, low, high), (-1, 0.0, -1, -1, lo, hi)):
            column.append(item)
        return len(dimension) - 1

    root = add(np.full(width, -np.inf), np.full(width, np.inf))
    waiting = [(root, sample)]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) <= leaf_rows:
            continue
        spread = rows.max(axis=0) - rows.min(axis=0)
        d = int(spread.argmax())
        if not spread[d] > 0:
            continue
        cut = float(np.median(rows[:, d]))
        if cut == rows[:, d].min():
            cut = float(rows[rows[:, d] > cut, d].min())
        below = rows[:, d] < cut
        hi_left, lo_right = high[node].copy(), low[node].copy()
        hi_left[d], lo_right[d] = cut, cut
        dimension[node], value[node] = d, cut
        left[node], right[node] = add(low[node], hi_left), add(lo_right, high[node])
        waiting += [(left[node], rows[below]), (right[node], rows[~below])]
    return Cells(
        np.array(dimension), np.array(value), np.array(left), np.array(right), np.array(low), np.array(high)
    )


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(len(column), width)


def _search(asking: pd.DataFrame, points: pd.DataFrame, k: int, width: int) -> pd.DataFrame:
    """Up to k nearest other points per asking point, within its radius."""
    points = points.sort_values("point", kind="stable")
    q, p = _matrix(asking["vector"], width), _matrix(points["vector"], width)
    q_ids, p_ids = asking["point"].to_numpy(), points["point"].to_numpy()
    radius = asking["radius"].to_numpy() if "radius" in asking else np.full(len(q), np.inf)
    step = max(1, _BLOCK_NUMBERS // max(1, len(p) * width))
    pieces = []
    for start in range(0, len(q), step):
        block = slice(start, start + step)
        distance = np.zeros((len(q[block]), len(p)))
        for d in range(width):
            distance += (q[block, d, None] - p[None, :, d]) ** 2
        distance = np.sqrt(distance)
        distance[q_ids[block, None] == p_ids[None, :]] = np.inf  # not its own neighbour
        last = min(k, len(p)) - 1
        reach = np.minimum(np.partition(distance, last, axis=1)[:, last], radius[block])
        row, column = np.nonzero((distance <= reach[:, None]) & (distance < np.inf))
        near = distance[row, column]
        # Equal distances may give more than k: keep k per row, the smaller id first.
        order = np.lexsort((column, near, row))
        row, column, near = row[order], column[order], near[order]
        first = np.searchsorted(row, row)
        kept = np.arange(len(row)) - first < k
        pieces.append((row[kept] + start, column[kept], near[kept]))
    row, column, distance = (np.concatenate(part) for part in zip(*pieces))
    return pd.DataFrame(
        {
            "point": q_ids[row],
            "distance": distance,
            "other": p_ids[column],
            "weight": points["weight"].to_numpy()[column],
            "vector": pd.Series(list(p[column]), dtype=object),
        }
    )


def nearest_neighbours(points: DataFrame, k: int, width: int, cell_points: int = CELL_POINTS) -> DataFrame:
    """(point, distance, other, weight, vector): enough nearest others per point to fill k.

    ``points`` has point (unique text), vector (array of ``width`` doubles) and weight
    (copies).  Copies of the point itself count towards k, at distance 0.  The input
    is read several times; pass a written table.
    """
    total = points.count()
    cells = _cells_for(points, total, width, cell_points)

    def with_cell(batches):
        for batch in batches:
            yield batch.assign(cell=cells.locate(_matrix(batch["vector"], width)))

    placed = points.select("point", "vector", "weight").mapInPandas(
        with_cell, "point string, vector array<double>, weight long, cell long"
    )

    def in_cell(group: pd.DataFrame) -> pd.DataFrame:
        return _search(group, group, k, width)

    own = placed.groupBy("cell").applyInPandas(in_cell, _FOUND)
    if len(cells.dimension) == 1:
        return own
    own = written(own, "neighbours")  # read twice below

    # Distance at which own copies and found neighbours together reach k.
    filled = F.aggregate(
        F.array_sort(F.collect_list(F.struct("distance", "weight"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(float("inf")).alias("r")),
        lambda state, x: F.when(state["n"] >= F.col("missing"), state).otherwise(
            F.struct(
                (state["n"] + x["weight"]).alias("n"),
                F.when(state["n"] + x["weight"] >= F.col("missing"), x["distance"]).otherwise(F.lit(float("inf"))).alias("r"),
            )
        ),
    )
    missing = points.select("point", (F.lit(k) - (F.col("weight") - 1)).alias("missing")).where("missing > 0")
    reach = (
        missing.join(own, "point", "left")
        .groupBy("point", "missing")
        .agg(filled["r"].alias("radius"))
        .select("point", "radius")
    )

    def ask(batches):
        for batch in batches:
            x = _matrix(batch["vector"], width)
            home = cells.locate(x)
            row, cell = cells.touched(x, batch["radius"].to_numpy())
            away = cell != home[row]
            chosen = batch.iloc[row[away]]
            yield chosen.assign(cell=cell[away])[["point", "vector", "radius", "cell"]]

    asking = (
        points.join(reach, "point")
        .select("point", "vector", "radius")
        .mapInPandas(ask, "point string, vector array<double>, radius double, cell long")
    )
    # Cells asked by very many points are served by several tasks, each with a copy of the cell.
    load = asking.groupBy("cell").agg((F.floor(F.count(F.lit(1)) / _QUERIES_PER_TASK) + 1).alias("copies"))
    load = F.broadcast(load)  # at most one row per cell
    salted = asking.join(load, "cell").withColumn("salt", F.pmod(F.xxhash64("point"), F.col("copies"))).drop("copies")
    copied = placed.join(load, "cell").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")

    def across(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"point": [], "distance": [], "other": [], "weight": [], "vector": []})
        return _search(left, right, k, width)

    away = salted.groupBy("cell", "salt").cogroup(copied.groupBy("cell", "salt")).applyInPandas(across, _FOUND)
    return own.unionByName(away)


def _cells_for(points: DataFrame, total: int, width: int, cell_points: int) -> Cells:
    if total <= cell_points:
        return cut_cells(np.zeros((1, width)), 1)
    wanted = min(DRIVER_ROWS, _SAMPLE_PER_CELL * (total // cell_points + 1))
    share = min(1.0, wanted / total)
    rows = points.where(uniform(F.col("point"), "cells") < share).select("vector").limit(2 * DRIVER_ROWS).collect()
    sample = np.array([r["vector"] for r in rows], dtype=float).reshape(len(rows), width)
    return cut_cells(sample, max(2, int(cell_points * share)))
