"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integers, floor(1024 x). Candidates are dealt to the pivot nearest to them,
so that like vectors share a part, and a part is cut by medians of its widest components
into small blocks. A part and each of its blocks know the maximum and minimum of every
component (term). For a query the bound of a block is the sum, over components, of the
larger of weight x maximum and weight x minimum. Blocks are scored in the order of their
bounds through their own rows, until a bound falls below the k-th score.

Three steps share that score between the parts. A query first searches the part it lies in
itself, whose k-th score is a lower bound for all; then the parts' own bounds, without their
rows, tell which other parts could hold better ones; and only to those does it go.

How much is pruned depends on the vectors. In tight clusters nearly all parts and blocks
fall away. Vectors without any structure have no near ones to share a block with: the bound
of 64 of them in 64 dimensions lies above any score, and every block is scored.

At scale: what meets is bounded: one part of at most ``PART`` candidates (the hash parts of
a hot pivot) with at most ``ASKED`` queries, or ``PART`` part bounds with ``ASKED`` queries.
Candidates are copied only as often as more than ``ASKED`` queries want their part. A part
gives k rows a query. The pivots, at most ``PIVOTS`` vectors, go to every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelworks.operators.keep import keep
from labelworks.session import on_executors

PART, ASKED, BLOCK, AT_ONCE, PIVOTS = 4096, 4096, 64, 4, 1024
LONG = (1 << 63) - 1


def _valid(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def _integers(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(np.clip(flat, -1e300, 1e300) * 1024).reshape(-1, size) if size else np.zeros((len(column), 0))


def _product(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond the range of a long they stop at its ends."""
    if rows.shape[1] and float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * rows.shape[1] >= 2**53:
        whole = [sum(int(a) * int(b) for a, b in zip(row, query, strict=True)) for row in rows]
        return np.array([max(-LONG, min(LONG, x)) for x in whole], np.int64)
    return (rows @ query).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _blocks(rows: np.ndarray) -> list[np.ndarray]:
    """Row numbers in blocks of at most BLOCK: halves along the component that spreads most."""
    out, todo = [], [np.arange(len(rows))]
    while todo:
        at = todo.pop()
        if len(at) <= BLOCK:
            out.append(at)
            continue
        own = rows[at]
        widest = int((own.max(axis=0) - own.min(axis=0)).argmax()) if rows.shape[1] else 0
        order = at[np.argsort(own[:, widest], kind="stable")] if rows.shape[1] else at
        todo += [order[len(order) // 2 :], order[: len(order) // 2]]
    return out


def _bounds(asked: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """No row between ``low`` and ``high`` scores more: queries x blocks, above any rounding."""
    out = np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T
    return out + np.abs(out) * 1e-9


def scored_blocks(ids: np.ndarray, rows: np.ndarray, own: int, query: np.ndarray, least: float, k: int, cut: list[np.ndarray], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of the k best rows that score ``least`` or more, and how many blocks
    had to be scored."""
    ranked, done = np.argsort(-bounds, kind="stable"), 0
    best, found = np.empty(0, np.int64), np.empty(0, np.int64)
    for lo in range(0, len(ranked), AT_ONCE):
        chosen = ranked[lo : lo + AT_ONCE]
        full = len(best) == k and best[-1] < LONG
        if bounds[chosen[0]] < max(least, best[-1] if full else -math.inf):
            break
        done += len(chosen)
        at = np.concatenate([cut[b] for b in chosen])
        at = at[ids[at] != own]
        scores = np.concatenate([best, _product(rows[at], query)])
        at = np.concatenate([found, at])
        top = _best(scores, ids[at], k)
        best, found = scores[top], at[top]
    return found, best, done


_FOUND = "query_id long, mark long, vec_id long, score long"


def _search(k: int):
    """Best rows of one part for each of the queries that want it."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        size = key[0].as_py()
        ids, rows = left.column("vec_id").to_numpy(), _integers(left.column("vector"), size)
        names, marks, asked = right.column("vec_id").to_numpy(), right.column("mark").to_numpy(), _integers(right.column("vector"), size)
        least = right.column("least").to_pylist()
        out: list[tuple[np.ndarray, ...]] = []
        if len(rows) and len(asked):
            cut = _blocks(rows)
            bounds = _bounds(asked, *(np.stack([f(rows[at], axis=0) for at in cut]) for f in (np.max, np.min)))
            for q in range(len(asked)):
                found, best, _ = scored_blocks(ids, rows, names[q], asked[q], -math.inf if least[q] is None else least[q], k, cut, bounds[q])
                out.append((np.full(len(best), names[q]), np.full(len(best), marks[q]), ids[found], best))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "mark", "vec_id", "score"])

    return run


def _extremes(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
    """Maximum and minimum of every component of a part."""
    rows = _integers(part.column("vector"), key[0].as_py())
    sides = [pa.array([f(rows, axis=0).tolist()], pa.list_(pa.float64())) for f in (np.max, np.min)]
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), *sides], names=["size", "part", "high", "low"])


_WANTED = "vec_id long, mark long, vector array<double>, size int, least long, part long"


def _hopeful(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
    """Each query with the parts whose bound reaches the score it has already, but for its own part."""
    size = key[0].as_py()
    high, low = (np.array(left.column(c).to_pylist(), float).reshape(left.num_rows, size) for c in ("high", "low"))
    parts, asked = left.column("part").to_numpy(), _integers(right.column("vector"), size)
    least = np.array([-math.inf if x is None else x for x in right.column("least").to_pylist()])
    own = right.column("part").to_numpy()
    # a score at the end of a long may stand for a larger one
    good = (_bounds(asked, high, low) >= np.where(least >= LONG, -math.inf, least)[:, None]) & (own[:, None] != parts[None, :])
    q, p = np.nonzero(good)
    rows = right.select(["vec_id", "mark", "vector", "size", "least"]).take(pa.array(q))
    return rows.append_column("part", pa.array(parts[p], pa.int64()))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id long, rank int, vec_id long, score long`` from two tables with ``vec_id``
    and ``embedding``: the k highest scores of each query among all rows but those of its
    own id, ties to the smaller vec_id; fewer rows if there are fewer.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows
    without an id. Only vectors of one length are compared. A row repeated with the same id
    and vector counts once; an id with several vectors stands for each of them.
    """
    if k < 1:
        raise ValueError("k must be at least 1")

    def table(df: DataFrame) -> DataFrame:
        taken = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        taken = taken.where(F.col("vec_id").isNotNull() & _valid(F.col("vector"))).dropDuplicates()
        return taken.withColumns({"size": F.size("vector"), "mark": F.xxhash64("vector")})

    held, asked = _placed(keep(table(vectors)), keep(table(queries)))
    first = keep(_found(held, asked.withColumn("least", F.lit(None).cast("long")), k))
    rest = _found(held, wanted_parts(held, asked, first, k), k)
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    return first.unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _placed(held: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``part``: the nearest pivot of the vector's length, and for
    candidates one of the hash parts that the pivot's rows are cut into; a query gets the
    first part of its pivot."""
    count = max(1, min(PIVOTS, math.isqrt(held.count())))
    drawn = held.orderBy(F.xxhash64("vec_id", "mark"), "vec_id", "mark").limit(count).select("vector").collect()
    pivots: dict[int, np.ndarray] = {}
    for r in drawn:
        pivots.setdefault(len(r["vector"]), []).append(r["vector"])
    pivots = {n: np.array(v, float).reshape(len(v), n) for n, v in pivots.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, cells = batch.column(2).to_numpy(zero_copy_only=False), np.zeros(batch.num_rows, np.int64)
            for n in np.unique(sizes):
                if n and n in pivots:
                    at = np.flatnonzero(sizes == n)
                    rows = np.array(batch.column(1).take(pa.array(at)).to_pylist(), float)
                    with np.errstate(over="ignore", invalid="ignore"):
                        apart = (pivots[n] ** 2).sum(axis=1)[None, :] - 2 * rows @ pivots[n].T
                    cells[at] = np.nan_to_num(apart, nan=np.inf).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    fields = "vec_id long, vector array<double>, size int, mark long, cell long"
    celled = [keep(on_executors(t.select("vec_id", "vector", "size", "mark")).mapInArrow(place, fields)) for t in (held, asked)]
    loads = keep(celled[0].groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts")))
    piece = F.pmod(F.xxhash64("vec_id", "mark", F.lit(1)), F.col("parts"))
    part = F.col("cell") * F.lit(1 << 32) + piece
    rows = keep(celled[0].join(loads, ["size", "cell"]).select("vec_id", "vector", "size", "mark", part.alias("part")))
    return rows, celled[1].select("vec_id", "vector", "size", "mark", (F.col("cell") * F.lit(1 << 32)).alias("part"))


def _found(held: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Best rows of each wanted part; a part that more than ASKED queries want is copied."""
    wanted = keep(wanted.select("vec_id", "mark", "vector", "size", "least", "part"))
    copies = keep(wanted.groupBy("size", "part").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("copies")))
    copied = lambda name: copies.select("size", "part", F.col("copies").alias(name))
    rows = held.join(copied("n"), ["size", "part"]).select("size", "part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("asked"), "vec_id", "vector")
    group = F.pmod(F.xxhash64("vec_id", "mark", F.lit(2)), F.col("m")).cast("int")
    queries = wanted.join(copied("m"), ["size", "part"]).select("size", "part", group.alias("asked"), "vec_id", "mark", "vector", "least")
    by = ["size", "part", "asked"]
    return on_executors(rows).groupBy(*by).cogroup(queries.groupBy(*by)).applyInArrow(_search(k), _FOUND)


def wanted_parts(held: DataFrame, asked: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """The queries with the further parts that could better the k-th score of their own part."""
    # fewer than k rows bound nothing
    least = first.groupBy("query_id", "mark").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least")).withColumnRenamed("query_id", "vec_id")
    known = keep(asked.join(least, ["vec_id", "mark"], "left"))
    parts = keep(on_executors(held).groupBy("size", "part").applyInArrow(_extremes, "size int, part long, high array<double>, low array<double>"))
    chunks, groups = max(1, math.ceil(parts.count() / PART)), max(1, math.ceil(known.count() / ASKED))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = parts.withColumn("chunk", F.pmod(F.xxhash64("part"), F.lit(chunks)).cast("int")).withColumn("asked", every(groups))
    right = known.withColumn("asked", F.pmod(F.xxhash64("vec_id", "mark", F.lit(2)), F.lit(groups)).cast("int")).withColumn("chunk", every(chunks))
    by = ["size", "chunk", "asked"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_hopeful, _WANTED)
