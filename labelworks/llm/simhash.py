"""Near-duplicate documents by SimHash fingerprints and pivot distance tables.

Documents with one fingerprint are one node, however many copies there are. Two
fingerprints that differ in at most ``max_bits`` bits agree in ``agree`` of
``agree + max_bits`` bit blocks, so nodes meet in buckets of agreeing blocks and no
link is lost. In a bucket, a table holds each node's Hamming distance to many reference
fingerprints; by the triangle inequality two nodes whose distances to any reference
differ by more than ``max_bits`` are no link, and only the others are compared bit by bit.

At scale: 15 bucket rows of 16 bytes a distinct fingerprint (two blocks of six). Large
buckets are cut into parts of ``PART`` nodes and each pair of parts is a task's group of
its own. Tasks give a spanning forest of the links they find, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.llm.columns import under_numbers
from labelworks.llm.graph import components
from labelworks.llm.words import mix
from labelworks.operators.keep import keep
from labelworks.session import on_executors

BITS, PART, PIVOTS, SEED, PAIRS = 64, 2048, 16, 42, 1 << 18


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # bytes: A-Z only; blanks are \x20 and \x09-\x0D
    if not words:
        return 0
    joined, size = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(begins[:size].tolist(), last.tolist(), strict=True)], np.uint64, size)
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, size, PAIRS):
        ones += np.unpackbits(hashes[lo : lo + PAIRS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > size, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            prints = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id long, print long`` (the fingerprint's 64 bits) of every row."""
    return on_executors(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(_fingerprints(shingle), "doc_id long, print long")


def _distances(prints: np.ndarray) -> np.ndarray:
    """The pivot table: a row for each reference fingerprint, its distance to each print."""
    pivots = mix(np.arange(1, PIVOTS + 1, dtype=np.uint64))
    return np.stack([np.bitwise_count(prints ^ p) for p in pivots]).astype(np.int8)


def _forest(prints: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each linked index, another one to which it leads; links of a component stay connected."""
    root = np.arange(len(prints))
    while True:
        a, b = root[left], root[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if not (differ := low != high).any():
            break
        np.minimum.at(root, high[differ], low[differ])
        while (root[root] != root).any():
            root = root[root]
    linked = np.flatnonzero(root != np.arange(len(prints)))
    return linked, root[linked]


def _links(max_bits: int):
    def near(group: np.ndarray, side: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((prints, _distances(prints)[0], group))
        group, side, prints = group[order], side[order], prints[order]
        table, step = _distances(prints), 1
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        size = 0
        live = np.arange(len(prints))
        while len(live := live[live + step < len(prints)]):
            to = live + step
            # sorted by the first pivot: beyond this, no later node of the bucket can be near
            open_ = (group[live] == group[to]) & (table[0][to] - table[0][live] <= max_bits)
            live, to = live[open_], to[open_]
            a, b = live[ask := (side[live] < 0) | (side[live] != side[to])], to[ask]
            for row in table[1:]:
                keep_ = np.abs(row[a] - row[b]) <= max_bits
                a, b = a[keep_], b[keep_]
            true = np.bitwise_count(prints[a] ^ prints[b]) <= max_bits
            found.append((a[true], b[true]))
            size += int(true.sum())
            if size > PAIRS:
                found = [_forest(prints, *(np.concatenate(x) for x in zip(*found, strict=True)))]
                size = 0
            step += 1
        linked, root = _forest(prints, *(np.concatenate(x) for x in zip(*found, strict=True)))
        return prints[linked], prints[root]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush(rows) -> pa.RecordBatch:
            a, b = near(np.cumsum(np.concatenate([[0], np.any(rows[:2, 1:] != rows[:2, :-1], axis=0)])), rows[2], rows[3].view(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            rows = np.stack([np.asarray(c) for c in batch.columns])
            if held:
                rows = np.concatenate([*held, rows], axis=1)
            last = np.flatnonzero(np.any(rows[:2] != rows[:2, -1:], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last bucket may go on in the next batch
            if cut:
                yield flush(rows[:, :cut])
            held = [rows[:, cut:]]
        if held and held[0].shape[1]:
            yield flush(held[0])

    return run


def links(prints: DataFrame, max_bits: int = 4, agree: int = 2) -> DataFrame:
    """``a, b``: links that connect exactly the prints reachable by steps of at most
    ``max_bits`` differing bits. ``prints`` has one long column of distinct values."""
    blocks = agree + max_bits
    if not 0 < blocks <= BITS:
        raise ValueError("too many bits for 64-bit fingerprints")
    edge = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in chosen) for chosen in combinations(range(blocks), agree)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    value = F.col("print")
    choices = F.array(*[F.struct(F.lit(i).alias("i"), value.bitwiseAND(F.lit(m).cast("long")).alias("bits")) for i, m in enumerate(signed)])
    rows = prints.select(value, F.explode(choices).alias("c")).select("print", (F.xxhash64("c.bits", "c.i")).alias("bucket"))
    sizes = keep(rows.groupBy("bucket").count().where(F.col("count") > PART).select("bucket", F.ceil(F.col("count") / PART).cast("int").alias("parts")))
    cut = rows.join(sizes, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("print", F.lit(1)), F.col("parts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    group = low.cast("long") * F.col("parts") + high
    cut = cut.select("bucket", group.alias("pair"), F.when(low == high, -1).otherwise(F.col("own")).cast("long").alias("side"), "print")
    single = cut.repartition(F.xxhash64("bucket", "pair")).sortWithinPartitions("bucket", "pair")
    return on_executors(single).mapInArrow(_links(max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id long, print long, component_id long`` for every row.

    component_id is the smallest doc_id among documents reachable by fingerprints that
    differ in at most ``max_bits`` bits, itself included. A text without words (null,
    empty, blank) has fingerprint zero and links like any other. Rows without an id are
    linked too but lend no id: alone, their component is null. Repeated rows stay.
    """
    table = keep(fingerprints(docs, shingle))
    nodes = keep(table.groupBy("print").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("print"), max_bits))
    labelled = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    labelled = keep(labelled)
    least = keep(labelled.groupBy("root").agg(F.min("least").alias("component_id")))
    named = keep(labelled.select("print", "root").join(least, "root").select("print", "component_id"))
    return table.join(named, "print").select("doc_id", "print", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each group: the one with the smallest doc_id; columns as they were.

    Of rows repeated under one doc_id one stays. Rows without an id stay: nothing names them.
    """
    docs, back = under_numbers(docs, ("doc_id", "text"))
    judged = near_duplicates(docs, shingle, max_bits).where(F.col("doc_id").isNotNull())
    names = keep(judged.groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__n"), F.min("component_id").alias("__least")))
    # What goes is less than what stays: the texts are shuffled only where the list of it is long.
    first = F.col("__id") == F.col("__least")
    losers, repeated = keep(names.where(~first).select("__id")), keep(names.where(first & (F.col("__n") > 1)).select("__id"))
    own = F.col("doc_id").cast("long") == F.col("__id")
    stay = docs.join(losers.unionByName(repeated), own, "left_anti")
    return back(stay.unionByName(docs.join(repeated, own, "left_semi").dropDuplicates(["doc_id"])))


def component_digest(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
