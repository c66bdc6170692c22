"""Whitening of vectors by the leading eigenvectors of their covariance.

Jacobi-Davidson, matrix-free: the covariance is only ever applied. A product is one pass over
the distinct vectors, each centred before it is multiplied; a task sends one column of sums
for each vector applied. The wanted pairs are worked on together: Rayleigh-Ritz in the
subspace, then the correction equations (V - theta) t = -r, projected off the locked and the
present vectors, are solved by MINRES in step, so that an inner step is one pass for all.
Pairs whose residual is within rounding of the covariance are locked; at the end one
Rayleigh-Ritz over locked and other vectors shows whether a larger pair was missed.

Entries are whole numbers, so sums, means and deviations are exact: with S = q n + r a centred
entry is (x - q) - r / n. A constant added to all entries changes none of this and is left out.

At scale: one shuffle for the distinct vectors (copies meet on the map side), which are
written once; after that passes over narrow files, whose results are dimensions x components
numbers however many rows there are. Driver and tasks hold dimensions x 4 (components + 4)
numbers and one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelworks.operators.keep import keep
from labelworks.session import on_executors

#: Vectors beyond the wanted ones in the subspace, most inner steps, most outer ones.
EXTRA, INNER, OUTER = 4, 4, 100
LARGEST = (1 << 63) - 1


def whole_entries(column: str, scale: int) -> Column:
    """floor(scale * entry) of every entry, as long; null unless all entries are finite."""
    value = F.transform(F.col(column), lambda x: x.cast("double"))
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(good, F.transform(value, lambda x: F.floor(x * scale).cast("long")))


def rows_of(values: pa.Array) -> np.ndarray:
    """A list column of equally long lists as a matrix."""
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else np.empty((0, 0), np.int64)


def _sums(table: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all rows of what ``of`` gives for a batch of vectors, a fixed number of
    numbers: one row a task, added up by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = lost = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            part = of(rows_of(batch.column(0)))
            if total is None:
                total, lost = part, np.zeros_like(part)
                continue
            more = total + part  # what rounding loses is kept apart; whole numbers lose nothing
            lost += np.where(np.abs(total) >= np.abs(part), (total - more) + part, (part - more) + total)
            total = more
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total + lost], pa.list_(pa.float64() if kind == "double" else pa.int64()))], names=["sums"])

    parts = on_executors(table.select("x")).mapInArrow(run, f"sums array<{kind}>")
    rows = parts.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value")).collect()
    return np.array([r["value"] for r in sorted(rows, key=lambda r: r["at"])], object if kind == "long" else float)


@dataclass(frozen=True)
class Centre:
    """n vectors with sums S = quotient n + rest, per dimension."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        quotient = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - quotient).astype(float) - rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)**2 over the dimensions; None beyond a long."""
        quotient, rest = np.array([s // self.n for s in self.sums], np.int64), [s % self.n for s in self.sums]
        near = x - quotient
        widest = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if widest * widest * max(1, len(rest)) <= LARGEST:
            apart = near * np.int64(self.n) - np.array(rest, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        exact = [sum((self.n * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in near]
        return [e if e <= LARGEST else None for e in exact]


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Directions of the block that are new, orthonormal to ``against`` and each other."""
    out = against
    for v in block.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            v = v - out @ (out.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            out = np.column_stack([out, v])
    return out[:, against.shape[1] :]


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Columns x with apply(x) near rhs, all columns in step; ``apply`` takes all at once."""
    x, w, w_before = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    start = np.linalg.norm(rhs, axis=0)
    before, now = rhs.copy(), rhs.copy()
    beta, beta_before = start.copy(), np.ones_like(start)
    dbar, epsilon, cosine, sine, left = np.zeros_like(start), np.zeros_like(start), -np.ones_like(start), np.zeros_like(start), start.copy()
    for step in range(steps):
        going = (left > tol * start) & (beta > 1e-14 * start)
        if not going.any():
            break
        v = np.where(going, now / np.where(going, beta, 1), 0)
        y = apply(v)
        if step:
            y = y - np.where(going, beta / beta_before, 0) * before
        alpha = (v * y).sum(axis=0)
        y = y - np.where(going, alpha / np.where(going, beta, 1), 0) * now
        before, now = now, y
        beta_before, beta = np.where(going, beta, 1), np.linalg.norm(y, axis=0)
        old, delta, gbar = epsilon, cosine * dbar + sine * alpha, sine * dbar - cosine * alpha
        epsilon, dbar = sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(gbar, beta), 1e-300)
        cosine, sine = gbar / gamma, beta / gamma
        w_before, w, older = w, None, w_before
        w = np.where(going, (v - old * older - delta * w_before) / gamma, 0)
        x = x + np.where(going, cosine * left, 0) * w
        left = np.where(going, sine * left, left)
    return x


@dataclass(frozen=True)
class Pairs:
    """Eigenvalues, falling, and their unit vectors as columns; how often V was applied."""

    values: np.ndarray
    vectors: np.ndarray
    passes: int


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dims: int, k: int, seed: int = 42) -> Pairs:
    """The k largest eigenpairs of a symmetric matrix of ``dims`` rows that is only applied."""
    k, passes = min(k, dims), 0

    def applied(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return product(block)

    width = min(dims, k + EXTRA)
    most = 4 * width
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((dims, width)), np.empty((dims, 0)))
    image = applied(basis)
    locked = locked_image = np.empty((dims, 0))
    for outer in range(OUTER):
        # Rayleigh-Ritz over all that is not locked
        small = basis.T @ image
        values, turns = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        values, turns = values[order], turns[:, order]
        ritz, ritz_image = basis @ turns, image @ turns
        wanted = min(k - locked.shape[1], ritz.shape[1])
        residual = ritz_image[:, :wanted] - ritz[:, :wanted] * values[:wanted]
        norm = max(abs(values[0]) if len(values) else 0, *np.linalg.norm(locked_image, axis=0), 1e-300)
        tol = 2 * dims * np.finfo(float).eps * norm
        done = np.linalg.norm(residual, axis=0) <= tol
        locked, locked_image = np.column_stack([locked, ritz[:, :wanted][:, done]]), np.column_stack([locked_image, ritz_image[:, :wanted][:, done]])
        open_ = np.concatenate([~done, np.ones(ritz.shape[1] - wanted, bool)])
        if locked.shape[1] == k:
            # is one of the others larger than one that is locked?
            every, every_image = np.column_stack([locked, ritz[:, open_]]), np.column_stack([locked_image, ritz_image[:, open_]])
            small = every.T @ every_image
            values, turns = np.linalg.eigh((small + small.T) / 2)
            top = np.argsort(-values)[:k]
            vectors, image = every @ turns[:, top], every_image @ turns[:, top]
            if (np.linalg.norm(image - vectors * values[top], axis=0) <= 4 * tol).all():
                vectors = vectors / np.linalg.norm(vectors, axis=0)
                return Pairs(values[top], vectors, passes)
            basis, image = every, every_image
            locked = locked_image = np.empty((dims, 0))
            continue
        residual, theta = residual[:, ~done], values[:wanted][~done]
        off = np.column_stack([locked, ritz[:, :wanted]])

        def projected(block: np.ndarray) -> np.ndarray:
            block = block - off @ (off.T @ block)  # noqa: B023
            out = applied(block) - block * theta  # noqa: B023
            return out - off @ (off.T @ out)  # noqa: B023

        ritz, ritz_image = ritz[:, open_], ritz_image[:, open_]
        if most < min(dims, ritz.shape[1] + locked.shape[1] + residual.shape[1]):  # a space of few dimensions is filled instead
            ritz, ritz_image = ritz[:, : width - locked.shape[1]], ritz_image[:, : width - locked.shape[1]]
        room = dims - locked.shape[1] - ritz.shape[1]
        new = _orthonormal(minres(projected, -residual, INNER, 0.5 ** (outer + 3)), np.column_stack([locked, ritz]))[:, :room]
        if not new.shape[1]:  # nothing new from the corrections: any new direction
            drawn = np.random.default_rng(seed + outer + 1).standard_normal((dims, min(EXTRA, room)))
            new = _orthonormal(drawn, np.column_stack([locked, ritz]))
        basis, image = ritz, ritz_image
        if new.shape[1]:
            basis, image = np.column_stack([basis, new]), np.column_stack([image, applied(new)])
    raise RuntimeError(f"no {k} pairs to double precision in {OUTER} rounds")


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening; ``basis`` has a column a component, over the root of its value."""

    centre: Centre
    values: tuple[float, ...]
    basis: np.ndarray
    trace: float
    identity_error: float
    passes: int


def fit(vectors: DataFrame, k: int) -> Whitening | None:
    """Fit on the distinct rows of ``x array<long>``, all of one length; None without rows."""
    distinct = keep(vectors.select("x").distinct())
    totals = _sums(distinct, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), "long")
    if not len(totals):
        return None
    centre, dims = Centre(int(totals[0]), tuple(int(s) for s in totals[1:])), len(totals) - 1
    n = centre.n

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centre.centred(x)
            return (c.T @ (c @ block)).ravel()

        return _sums(distinct, part, "double").reshape(block.shape) / n

    trace = float(_sums(distinct, lambda x: np.array([np.square(centre.centred(x)).sum()]), "double")[0]) / n
    if not trace > 0:
        return Whitening(centre, (), np.empty((dims, 0)), 0.0, 0.0, 1)
    pairs = jacobi_davidson(product, dims, k)
    real = pairs.values > dims * np.finfo(float).eps * pairs.values[0] * 4
    values, basis = pairs.values[real], pairs.vectors[:, real] / np.sqrt(pairs.values[real])

    def again(x: np.ndarray) -> np.ndarray:
        w = centre.centred(x) @ basis
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    count = len(values)
    sums = _sums(distinct, again, "double") / n
    means = sums[count * count :]
    error = np.abs(sums[: count * count].reshape(count, count) - np.outer(means, means) - np.eye(count)).max()
    return Whitening(centre, tuple(values.tolist()), basis, trace, float(error), pairs.passes)


def whiten(table: DataFrame, k: int = 16, scale: int = 64, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id long, n long, deviation long, whitened array<double>, explained array<double>,
    identity_error double`` of every row whose vector takes part, entries in the order of the
    components; each entry of a vector counts as floor(scale * entry).

    Rows whose vector is null or holds null or non-finite entries are left out, and so are
    vectors shorter than the longest, which lack entries. Repeated vectors count once in the
    fit and are returned each; a null key is returned as null. There are at most k components,
    and none for an eigenvalue of zero within rounding: arrays are shorter then, and empty if
    all vectors are alike. ``deviation`` is null where it exceeds a long. An empty table
    gives none. Further columns are not read.
    """
    found = table.select(F.col(key).cast("long").alias("vec_id"), whole_entries(column, scale).alias("x")).where("x IS NOT NULL")
    fields = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    longest = found.agg(F.max(F.size("x"))).first()[0]
    if not longest:
        return table.sparkSession.createDataFrame([], fields)
    found = found.where(F.size("x") == longest)
    model = fit(found, k)
    explained = [v / model.trace for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x = batch.num_rows, rows_of(batch.column(1))
            if not n:
                continue
            white = model.centre.centred(x) @ model.basis
            columns = [
                batch.column(0),
                pa.array([model.centre.n] * n, pa.int64()),
                pa.array(model.centre.deviation(x), pa.int64()),
                pa.array(list(white), pa.list_(pa.float64())),
                pa.array([explained] * n, pa.list_(pa.float64())),
                pa.array([model.identity_error] * n, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return on_executors(found).mapInArrow(run, fields)


def component_rows(table: DataFrame, k: int = 16) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, one row for
    each row of the table that takes part and component, from 1."""
    entries = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "entry")
    rows = whiten(table, k).select("vec_id", "n", "deviation", "identity_error", entries)
    return rows.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "entry.whitened", "entry.explained", "identity_error")
