"""Sums of products of the entries of vectors, grouped."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.session import on_executors

# Rows whose products are summed at a time.
ROWS = 4096


def cross_products(df: DataFrame, by: Sequence[str], features: str = "features") -> dict[tuple, np.ndarray]:
    """For each group the matrix of sums of products of (1, features): its first row holds
    the number of rows and the sums.

    One scan: a task adds up its rows and sends one matrix for each group it has seen, so
    what is shuffled and what the driver gets are groups x features squared. The caller
    bounds the groups.
    """
    by = list(by)
    table = on_executors(df.select(*by, vector_to_array(features).alias("_v")))
    width = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                keys = np.array(list(zip(*[part.column(i).to_pylist() for i in range(width)], strict=True)) + [None], object)[:-1] if width else [()] * part.num_rows
                groups: dict[tuple, list[int]] = {}
                for i, key in enumerate(keys):
                    groups.setdefault(key, []).append(i)
                x = np.array(part.column(width).to_pylist(), float)
                x = np.column_stack([np.ones(len(x)), x])
                for key, rows in groups.items():
                    own = x[rows]
                    sums[key] = sums.get(key, 0) + own.T @ own
        if sums:
            columns = [pa.array([k[i] for k in sums], batch.schema.field(i).type) for i in range(width)]
            flat = pa.array([m.ravel() for m in sums.values()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*columns, flat], names=[*by, "_sums"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields[:width]]
    parts = table.mapInArrow(run, ", ".join([*fields, "_sums array<double>"]))
    rows = parts.select(*by, F.posexplode("_sums").alias("_at", "_s")).groupBy(*by, "_at").agg(F.sum("_s").alias("_s"))
    whole = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_at", "_s"))).alias("_s")).collect()
    out = {}
    for r in whole:
        flat = np.array([s["_s"] for s in r["_s"]])
        side = int(round(len(flat) ** 0.5))
        out[tuple(r[c] for c in by)] = flat.reshape(side, side)
    return out
