"""Exact k nearest neighbours of every query row, as a pruned block join.

Training rows are placed in the cell of their closest pivot. A query searches the cell
closest to it first; of the others it can skip each that lies farther than its k-th distance
there, by the triangle inequality (Lu et al., "Efficient processing of k nearest neighbor
joins using MapReduce", PVLDB 2012) or by the box around the cell's rows. Neighbouring cells are packed into bins of bounded size, and a
query travels once to each bin with the list of cells it wants there; a hot cell is cut
into blocks on both sides, so it becomes many tasks. Each block pair emits only the k best
rows of each query. Distances come from one matrix product with an error bound; those that
may be among the k best are then taken from the differences themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from labelworks.operators.keep import keep
from labelworks.operators.split import bounded_sample
from labelworks.session import on_executors

PIVOTS = 64
BLOCK_ROWS = 4096
# Numbers that a worker holds at a time when it bounds distances.
BOUND_CELLS = 2_000_000
# Distances that a worker holds at a time.
BLOCK_CELLS = 1 << 20
# Dimensions up to which cells have boxes, and the share by which their distances may be off.
BOX_DIMS = 256
ROUNDING = 1e-12
# Places that distances are shown with (and the slack of the bounds), and those they
# rank by: sums of the same gaps in another order differ beyond them.
PLACES = 6
RANKED = 12


def pivot_count(rows: int) -> int:
    """Cells of about the square root of the rows each, at least PIVOTS and at most 4,096 of them."""
    return max(PIVOTS, min(BLOCK_ROWS, math.isqrt(rows)))


def _distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Distance of every row of ``a`` to every row of ``b``, in slices of bounded memory."""
    out = np.empty((len(a), len(b)))
    step = max(1, 2_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        gap = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = np.abs(gap).sum(axis=2) if p == 1 else np.sqrt((gap * gap).sum(axis=2))
    return out


def _approximate(a: np.ndarray, b: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Distance of every row of ``a`` to every row of ``b``, squared for ``p=2``, and for each
    row of ``a`` the most that it is off, places beyond RANKED included. Infinite where numbers are missing."""
    eps, dims = np.finfo(float).eps, a.shape[1]
    whole = np.isfinite(b).all(axis=1)
    with np.errstate(all="ignore"):
        if p == 1:
            out, gap = np.zeros((len(a), len(b))), np.empty((len(a), len(b)))
            for j in np.flatnonzero((b != b[:1]).any(axis=0) | (a != b[:1]).any(axis=0)):
                out += np.abs(np.subtract(a[:, j, None], b[None, :, j], out=gap), out=gap)
            most = np.abs(a).sum(axis=1) + np.abs(b[whole]).sum(axis=1).max(initial=0)
            off = 4 * (dims + 4) * eps * most + 2 * 10.0**-RANKED
        else:
            centre = b[whole].mean(axis=0) if whole.any() else np.zeros(dims)
            x, y = a - centre, b - centre
            xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
            out = x @ y.T
            out *= -2
            out += xx[:, None]
            out += yy
            far = np.sqrt(xx) + np.sqrt(yy[whole].max(initial=0))
            size = np.sqrt((a * a).sum(axis=1)) + np.sqrt((b[whole] ** 2).sum(axis=1).max(initial=0)) + np.sqrt((centre * centre).sum())
            moved = 4 * eps * size + 2 * 10.0**-RANKED
            off = 4 * (dims + 8) * eps * far * far + 2 * far * moved + moved * moved
    out[~np.isfinite(out)] = np.inf
    return out, off


def _bounds(a: np.ndarray, b: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distance of every row of ``a`` to every row of ``b``."""
    out, off = _approximate(a, b, p)
    low, high = np.maximum(out - off[:, None], 0), np.maximum(out + off[:, None], 0)
    if p == 2:
        low, high = np.sqrt(low), np.sqrt(high)
    odd = ~np.isfinite(out).all(axis=1) | ~np.isfinite(off)
    if odd.any():
        low[odd] = high[odd] = _distances(a[odd], b, p)
    return low, high


def _closest(a: np.ndarray, b: np.ndarray, k: int, p: int, places: int | None = RANKED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k closest rows of ``b`` to every row of ``a``: row, row of ``b`` and distance, by
    distance rounded to ``places``, ties to the earlier row of ``b``."""
    found = []
    step, pairs = max(1, BLOCK_CELLS // max(1, len(b))), max(1, BOUND_CELLS // max(1, b.shape[1]))
    for i in range(0, len(a), step):
        near, off = _approximate(a[i : i + step], b, p)
        most = np.partition(near, k - 1, axis=1)[:, k - 1] if len(b) > k else np.full(len(near), np.inf)
        r, c = np.nonzero(~(near > (most + 2 * off)[:, None]))
        r += i
        d = np.empty(len(r))
        for j in range(0, len(r), pairs):
            gap = a[r[j : j + pairs]] - b[c[j : j + pairs]]
            d[j : j + pairs] = np.abs(gap).sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1))
        if places is not None:
            d = np.round(d, places)
        order = np.lexsort((c, d, r))
        r, c, d = r[order], c[order], d[order]
        first = np.arange(len(r)) - np.searchsorted(r, r) < k
        found.append((r[first], c[first], d[first]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int), np.empty(0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _nearest_pivot(rows: DataFrame, pivots: np.ndarray, p: int) -> DataFrame:
    """Add ``_cell`` and ``_away``, the closest pivot and the distance to it."""

    @F.pandas_udf("cell int, away double")
    def place(points: pd.Series) -> pd.DataFrame:
        _, cell, away = _closest(_matrix(points), pivots, 1, p, None)
        return pd.DataFrame({"cell": cell.astype("int32"), "away": away})

    placed = rows.withColumn("_p", place("point"))
    return placed.select(*rows.columns, F.col("_p.cell").alias("_cell"), F.col("_p.away").alias("_away"))


def _cell_facts(placed: DataFrame, k: int) -> pd.DataFrame:
    """Size, radius and k smallest pivot distances of each cell: one row a pivot."""
    sizes = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_away").alias("radius"))
    nearest = Window.partitionBy("_cell").orderBy("_away")
    # A top-k window filter is applied before the shuffle as well as after it.
    close = placed.select("_cell", "_away").withColumn("_i", F.row_number().over(nearest)).where(F.col("_i") <= k)
    lists = close.groupBy("_cell").agg(F.sort_array(F.collect_list("_away")).alias("close"))
    return sizes.join(lists, "_cell").toPandas()


def _boxes(placed: DataFrame, cells: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest number of each cell's rows in each dimension; without bounds where there are more than BOX_DIMS."""
    low, high = np.full((len(cells), dims), -np.inf), np.full((len(cells), dims), np.inf)
    if dims <= BOX_DIMS:
        ends = [f(F.get("point", F.lit(j))).alias(f"{n}{j}") for n, f in (("l", F.min), ("h", F.max)) for j in range(dims)]
        found = placed.groupBy("_cell").agg(*ends).toPandas().set_index("_cell").loc[cells].to_numpy(float)
        low, high = found[:, :dims], found[:, dims:]
    return low, high


def _outside(points: np.ndarray, low: np.ndarray, high: np.ndarray, p: int) -> np.ndarray:
    """Distance of each point to a box, a row each; dimensions without finite numbers do not count."""
    with np.errstate(invalid="ignore"):
        gap = np.nan_to_num(np.maximum(np.maximum(low - points, points - high), 0), nan=0.0, posinf=0.0)
    return gap.sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1))


def neighbour_schema(queries: DataFrame, train: DataFrame, query_key: str, train_key: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query_key, queries.schema[query_key].dataType),
            T.StructField(train_key, train.schema[train_key].dataType),
            T.StructField("distance", T.DoubleType()),
            T.StructField("place", T.IntegerType()),
        ]
    )


def _first_copies(points: np.ndarray, k: int) -> np.ndarray:
    """The first k rows of each point: no others of it can be among the k closest of anything."""
    if not points.size:
        return np.arange(len(points))
    _, same = np.unique(np.ascontiguousarray(points + 0.0).view(f"V{points.shape[1] * 8}").ravel(), return_inverse=True)
    return np.flatnonzero(pd.Series(same).groupby(same).cumcount().to_numpy() < k)


def closest_rows(k: int, p: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """For a block of queries and one of training rows, the k closest of each query. Where the
    queries have ``_cells``, training rows of other cells cannot be among them and are left out,
    unless most pairs remain: one product of all is then faster, and finds the same."""

    def closest(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return pd.DataFrame({"_qk": [], "_tk": [], "distance": []})
        t = t.sort_values("_tk", kind="stable")
        tk, tm = t["_tk"].to_numpy(), _matrix(t["point"])
        qk, qm = q["_qk"].to_numpy(), _matrix(q["point"])
        few = _first_copies(tm, k)
        lists = q["_cells"].to_numpy() if "_cells" in q else None
        if lists is not None:
            asker, asked = np.repeat(np.arange(len(q)), [len(x) for x in lists]), np.concatenate(lists)
            cell = t["_cell"].to_numpy()[few]
            names, sizes = np.unique(cell, return_counts=True)
            left = (sizes * (np.searchsorted(np.sort(asked), names, "right") - np.searchsorted(np.sort(asked), names))).sum()
        if lists is None or 3 * left > len(q) * len(few):
            r, c, d = _closest(qm, tm[few], k, p)
            return pd.DataFrame({"_qk": qk[r], "_tk": tk[few[c]], "distance": d})
        parts = []
        for one in names:
            rows, own = asker[asked == one], few[cell == one]
            r, c, d = _closest(qm[rows], tm[own], k, p)
            parts.append((rows[r], own[c], d))
        r, c, d = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((c, d, r))
        r, c, d = r[order], c[order], d[order]
        first = np.arange(len(r)) - np.searchsorted(r, r) < k
        return pd.DataFrame({"_qk": qk[r[first]], "_tk": tk[c[first]], "distance": d[first]})

    return closest


def first_rows(k: int, p: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """For a block of queries and one of training rows, the k closest of each query in its own
    cell, a row a query: ``_bound``, the k-th distance (infinite where there are fewer), and, where
    the block has all rows of the cell, ``_own``, the cell (else -1), with keys and distances."""

    def first(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        bound, own, keys, distances = np.full(len(q), np.inf), np.full(len(q), -1), [[]] * len(q), [[]] * len(q)
        if not q.empty and not t.empty:
            t = t.sort_values("_tk", kind="stable")
            tk, tm, qm = t["_tk"].to_numpy(), _matrix(t["point"]), _matrix(q["point"])
            few, cell, whole = _first_copies(tm, k), q["_cell"].to_numpy(), q["_whole"].to_numpy(bool)
            held = t["_cell"].to_numpy()[few]
            for one in np.unique(cell):
                rows, mine = np.flatnonzero(cell == one), few[held == one]
                r, c, d = _closest(qm[rows], tm[mine], k, p) if len(mine) else ([], [], [])
                starts, ends = (np.searchsorted(r, np.arange(len(rows)), side) for side in ("left", "right"))
                for row, a, b in zip(rows, starts, ends):
                    if b - a == k and np.isfinite(d[b - 1]):
                        bound[row] = d[b - 1]
                    if whole[row] and b > a:
                        own[row], keys[row], distances[row] = one, tk[mine[c[a:b]]], d[a:b]
        return pd.DataFrame({"_qk": q["_qk"], "point": q["point"], "_own": own.astype("int32"), "_bound": bound, "_tks": pd.Series(keys, q.index, object), "_ds": pd.Series(distances, q.index, object)})

    return first


def _kth_bound(to_pivot: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """For each query a distance within which k training rows surely lie: the k-th smallest
    of its distance to a pivot plus those of the pivot's k closest rows. Queries are taken a
    few at a time, so that memory does not follow cells x k x batch."""
    k = reach.shape[1]
    out = np.empty(len(to_pivot))
    step = max(1, BOUND_CELLS // max(1, reach.size))
    for i in range(0, len(to_pivot), step):
        part = to_pivot[i : i + step]
        # The k smallest sums lie in the k cells whose smallest sums are smallest.
        some = np.argpartition(part + reach[:, 0], k - 1, axis=1)[:, :k] if k < len(reach) else np.broadcast_to(np.arange(len(reach)), part.shape)
        upper = (np.take_along_axis(part, some, axis=1)[:, :, None] + reach[some]).reshape(len(part), -1)
        out[i : i + step] = np.partition(upper, k - 1, axis=1)[:, k - 1]
    return out


def _bins(pivots: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A number for each cell, the same for near cells that together have at most BLOCK_ROWS
    rows; a cell with more has one of its own. Cells are taken along the axis that tells them apart best."""
    gap = np.nan_to_num(pivots - pivots.mean(axis=0), nan=0.0, posinf=0.0, neginf=0.0)
    along = gap @ np.linalg.eigh(gap.T @ gap)[1][:, -1] if gap.size else np.zeros(len(gap))
    out, held, number = np.empty(len(sizes), int), 0, 0
    for i in np.argsort(along, kind="stable"):
        if held and held + sizes[i] > BLOCK_ROWS:
            held, number = 0, number + 1
        out[i], held = number, held + sizes[i]
    return out


def neighbour_join(
    queries: DataFrame, train: DataFrame, query_key: str, train_key: str, features: str, k: int = 5, p: int = 2, probes: int | None = None
) -> DataFrame:
    """Rows ``query_key, train_key, distance, place`` with place 1..k.

    ``features`` is an array column of both tables. Distances (city block for
    ``p=1``, Euclidean for ``p=2``) rank by twelve places and are shown with six;
    ties go to the smaller training key. In many dimensions few cells can be ruled out:
    with ``probes`` each query looks into that many of the nearest cells only, and the
    neighbours are approximate.
    """
    if p not in (1, 2):
        raise ValueError("p must be 1 or 2")
    spark = train.sparkSession
    point = F.col(features).cast("array<double>").alias("point")
    base = train.select(F.col(train_key).alias("_tk"), point)
    asked = on_executors(queries).select(F.col(query_key).alias("_qk"), point)
    pivots = _matrix(bounded_sample(base, "_tk", pivot_count(base.count()), "pivots").toPandas()["point"])
    schema = neighbour_schema(queries, train, query_key, train_key)
    if not len(pivots):
        return spark.createDataFrame([], schema)
    placed = keep(_nearest_pivot(base, pivots, p))
    facts = _cell_facts(placed, k)
    cells = facts["_cell"].to_numpy()
    radius, sizes = facts["radius"].to_numpy(), facts["n"].to_numpy()
    reach = np.full((len(facts), k), np.inf)
    for i, close in enumerate(facts["close"]):
        reach[i, : len(close)] = close
    slack, centres, bins = 10.0**-PLACES, pivots[cells], _bins(pivots[cells], sizes)
    low_ends, high_ends = _boxes(placed, cells, pivots.shape[1])

    rows_in = np.bincount(bins, weights=sizes).astype(int)
    train_parts = np.maximum(1, -(-rows_in // BLOCK_ROWS))
    # by the number of a cell's pivot
    bin_of, finite = np.full(len(pivots), -1), np.zeros(len(pivots), int)
    bin_of[cells], finite[cells] = bins, np.isfinite(radius)

    @F.pandas_udf("array<struct<bin: int, cells: array<int>>>")
    def candidates(points: pd.Series, owns: pd.Series, bounds: pd.Series) -> pd.Series:
        out, step = [], max(1, BOUND_CELLS // len(cells))
        for i in range(0, len(points), step):
            m, own, kth = _matrix(points[i : i + step]), owns[i : i + step].to_numpy(), bounds[i : i + step].to_numpy(copy=True)
            low, high = _bounds(m, centres, p) if probes is None else [_distances(m, centres, p)] * 2
            unknown = ~np.isfinite(kth)
            if unknown.any():
                kth[unknown] = _kth_bound(high[unknown], reach)
            kth = kth * (1 + ROUNDING) + slack
            near = (low - radius[None, :] * (1 + ROUNDING) <= kth[:, None]) & (cells[None, :] != own[:, None])
            if probes is not None:
                near &= low.argsort(axis=1).argsort(axis=1) < probes
            else:
                # what the triangle inequality leaves, by the boxes
                r, c = np.nonzero(near)
                few = max(1, BOUND_CELLS // max(1, m.shape[1]))
                for j in range(0, len(r), few):
                    a, b = r[j : j + few], c[j : j + few]
                    near[a, b] = _outside(m[a], low_ends[b], high_ends[b], p) <= kth[a]
            for row, mine in zip(near, own):
                if mine >= 0 and (bins[row] == bin_of[mine]).any():
                    # its bin is searched once more, then with its own cell
                    row |= cells == mine
                at = np.flatnonzero(row)
                at = at[np.argsort(bins[at], kind="stable")]
                numbers, starts = np.unique(bins[at], return_index=True)
                out.append([{"bin": int(n), "cells": c.tolist()} for n, c in zip(numbers, np.split(cells[at], starts[1:]))])
        return pd.Series(out, dtype=object)

    def pick(values: np.ndarray, column: str) -> Column:
        return F.get(F.array(*[F.lit(int(x)) for x in values]), F.col(column))


    def query_parts(rows: DataFrame) -> np.ndarray:
        loads = {r["_bin"]: r["n"] for r in rows.groupBy("_bin").agg(F.count(F.lit(1)).alias("n")).collect()}
        return np.array([max(1, -(-loads.get(b, 0) // BLOCK_ROWS)) for b in range(len(train_parts))])

    def blocks(rows: DataFrame, key: str, own: Column, other: Column, own_name: str, other_name: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(key), own).cast("int")
        others = F.explode(F.sequence(F.lit(0), other - 1))
        return rows.withColumn(own_name, mine).withColumn(other_name, others)

    keys = ["_bin", "_t", "_q"]
    located = placed.drop("_away").withColumn("_bin", pick(bin_of, "_cell"))

    def train_blocks(parts: np.ndarray) -> DataFrame:
        return blocks(located, "_tk", pick(train_parts, "_bin"), pick(parts, "_bin"), "_t", "_q").groupBy(*keys)

    found, known = None, asked.withColumn("_own", F.lit(-1)).withColumn("_bound", F.lit(math.inf))
    if probes is None:
        # the closest cell first, all of it or, where it is in several blocks, one of them
        own = keep(_nearest_pivot(asked, centres, p).withColumn("_cell", pick(cells, "_cell")).withColumn("_bin", pick(bin_of, "_cell")))
        sure = (F.col("_away") < math.inf) & pick(finite, "_cell").cast("boolean")
        sent = own.where(sure).drop("_away").withColumn("_whole", pick(train_parts, "_bin") == 1)
        parts = query_parts(sent)
        left = sent.withColumn("_t", F.pmod(F.xxhash64("_qk", F.lit(1)), pick(train_parts, "_bin")).cast("int")).withColumn("_q", F.pmod(F.xxhash64("_qk"), pick(parts, "_bin")).cast("int"))
        kinds = [asked.schema["_qk"], asked.schema["point"], T.StructField("_own", T.IntegerType()), T.StructField("_bound", T.DoubleType())]
        kinds += [T.StructField("_tks", T.ArrayType(base.schema["_tk"].dataType)), T.StructField("_ds", T.ArrayType(T.DoubleType()))]
        first = left.groupBy(*keys).cogroup(train_blocks(parts)).applyInPandas(first_rows(k, p), T.StructType(kinds))
        nothing = [F.lit(v).cast(first.schema[c].dataType).alias(c) for c, v in (("_own", -1), ("_bound", math.inf), ("_tks", None), ("_ds", None))]
        known = first.unionByName(own.where(~F.coalesce(sure, F.lit(False))).select("_qk", "point", *nothing))
    known = keep(known.withColumn("_b", candidates("point", "_own", "_bound")))
    if probes is None:
        again = F.exists("_b", lambda b: b["bin"] == pick(bin_of, "_own"))
        rows = known.where((F.col("_own") >= 0) & ~again).select("_qk", F.explode(F.arrays_zip("_tks", "_ds")).alias("_n"))
        found = rows.select("_qk", F.col("_n._tks").alias("_tk"), F.col("_n._ds").alias("distance"))

    wanted = known.select("_qk", "point", F.explode("_b").alias("_b")).select("_qk", "point", F.col("_b.bin").alias("_bin"), F.col("_b.cells").alias("_cells"))
    parts = query_parts(wanted)
    left = blocks(wanted, "_qk", pick(parts, "_bin"), pick(train_parts, "_bin"), "_q", "_t")
    pair_schema = T.StructType(
        [
            T.StructField("_qk", asked.schema["_qk"].dataType),
            T.StructField("_tk", base.schema["_tk"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    pairs = left.groupBy(*keys).cogroup(train_blocks(parts)).applyInPandas(closest_rows(k, p), pair_schema)
    pairs = pairs if found is None else pairs.unionByName(found)
    order = Window.partitionBy("_qk").orderBy("distance", "_tk")
    ranked = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return ranked.select(F.col("_qk").alias(query_key), F.col("_tk").alias(train_key), F.round("distance", PLACES).alias("distance"), "place")


def neighbour_vote(neighbours: DataFrame, labels: DataFrame, query_key: str, train_key: str, label: str, weights: str = "uniform") -> DataFrame:
    """``query_key, score, pred``: share of class 1 among the neighbours; ties give class 0.

    With ``distance`` weights a neighbour counts 1/d; where some neighbours are
    at distance 0, only those count.
    """
    if weights not in ("uniform", "distance"):
        raise ValueError(f"unknown weights {weights!r}")
    labelled = neighbours.join(labels.select(train_key, F.col(label).cast("double").alias("_y")), train_key)
    w, y = F.lit(1.0), F.col("_y")
    if weights == "distance":
        far = F.when(F.col("distance") > 0, 1.0 / F.col("distance"))
        exact = F.when(F.col("distance") == 0, 1.0)
        score = F.coalesce(F.avg(F.when(exact.isNotNull(), y)), F.sum(far * y) / F.sum(far))
    else:
        score = F.sum(w * y) / F.sum(w)
    votes = labelled.groupBy(query_key).agg(F.round(score, 12).alias("score"))
    return votes.withColumn("pred", (F.col("score") > 0.5).cast("int"))
