"""Benchmark decontamination: size-partitioned MinHash containment search.

A short test item is contained in a document if at least ``threshold`` of its distinct
five-word shingles stand in it; the words of a shorter item are one shingle, which stands
in it whole. Items are partitioned by their number of shingles; a
class keeps, of each item, the smallest shingle hashes, one more than the largest item of
the class may lack. A document that contains the item then holds at least one of them,
so the search misses nothing, however long the document. Every document that holds one is
verified with the shingles themselves, word for word.

Words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased.

At scale: documents are judged where they are read, without a shuffle. Items come in
blocks of at most ``BLOCK`` items and ``BLOCK_BYTES`` bytes of text (a longer item is a
block of its own), whose signatures go to the tasks; one scan of the documents for each
block. The driver holds one block's texts at a time.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelworks.llm.words import grams, slices, spans, word_hashes
from labelworks.session import on_executors

SHINGLE, THRESHOLD, BLOCK, FILTER_BITS = 5, 0.8, 20_000, 22
BLOCK_BYTES = 1 << 23
_ASCII = np.arange(256, dtype=np.uint8)
_ASCII[65:91] += 32
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def _hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes, word starts and ends, words before each row, and the hash of each word."""
    data = _ASCII[data]
    starts, ends, first = spans(data, offsets, _GAP)
    return data, starts, ends, first, word_hashes(data, starts, ends)


def _shingle_set(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> set[bytes]:
    raw = data.tobytes()
    words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


class Lookup:
    """Signature hashes of the items whose shingles have one size: hash -> items."""

    def __init__(self) -> None:
        self.by_hash: dict[int, list[int]] = defaultdict(list)

    def close(self) -> None:
        self.keys = np.array(sorted(self.by_hash), np.uint64)
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where a shingle's hash is that of an item."""
        at = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        return at[np.isin(hashes[at], self.keys)]


class Signatures:
    """The signatures of one block of items, by shingle size, and each item's shingles."""

    def __init__(self, items: list[tuple[int, str]], threshold: float):
        self.threshold, self.ids = threshold, []
        self.shingles: list[set[bytes]] = []
        self.sizes: list[int] = []
        self.lookups: dict[int, Lookup] = {}
        for item_id, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            data, starts, ends, _, words = _hashes(raw, np.array([0, len(raw)]))
            shingle = min(SHINGLE, len(starts))
            if not shingle:
                continue
            own = _shingle_set(data, starts, ends, shingle)
            largest = (1 << len(own).bit_length()) - 1  # of the item's size class: 1, 2-3, 4-7, 8-15, ...
            size = math.floor(largest * (1 - threshold) + 1e-9) + 1
            lookup = self.lookups.setdefault(shingle, Lookup())
            for h in np.unique(grams(words, shingle))[:size].tolist():
                lookup.by_hash[h].append(len(self.ids))
            self.ids.append(item_id)
            self.shingles.append(own)
            self.sizes.append(shingle)
        for lookup in self.lookups.values():
            lookup.close()

    def search(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, its shingles, those shared) of every contained item."""
        for lo, hi, raw, offsets in slices(texts):
            data, starts, ends, first, words = _hashes(raw, offsets)
            found: dict[int, set[int]] = defaultdict(set)
            for shingle, lookup in self.lookups.items():
                hashes = grams(words, shingle)
                at = lookup.places(hashes)
                row = np.searchsorted(first, at, "right") - 1
                inside = at + shingle <= first[row + 1]
                for r, h in set(zip(row[inside].tolist(), hashes[at[inside]].tolist(), strict=True)):
                    found[r].update(lookup.by_hash[h])
            for r in sorted(found):
                own = slice(first[r], first[r + 1])
                text, begin, end = data[offsets[r] : offsets[r + 1]], starts[own] - offsets[r], ends[own] - offsets[r]
                held = {size: _shingle_set(text, begin, end, size) for size in {self.sizes[i] for i in found[r]}}
                for item in sorted(found[r]):
                    shared = len(self.shingles[item] & held[self.sizes[item]])
                    if shared >= self.threshold * len(self.shingles[item]) - 1e-9:
                        yield lo + r, item, len(self.shingles[item]), shared


def _blocks(items: DataFrame, threshold: float) -> Iterator[Signatures]:
    """Blocks of at most BLOCK items and BLOCK_BYTES, one item at least, in the order of
    item_id and the texts' digests. Sizes are collected first, texts once a block is cut."""
    table = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text").distinct()
    keyed = table.select("item_id", "text", F.coalesce("item_id", F.lit(-(1 << 63))).alias("key"), F.sha2("text", 256).alias("digest"))
    sizes = keyed.select("key", "digest", F.octet_length("text").cast("long").alias("size"))
    last: tuple | None = None

    def after(row: tuple) -> Column:
        return (F.col("key") > row[0]) | ((F.col("key") == row[0]) & (F.col("digest") > row[1]))

    while True:
        rows = (sizes if last is None else sizes.where(after(last))).orderBy("key", "digest").limit(BLOCK).collect()
        if not rows:
            return
        n = max(1, int(np.searchsorted(np.cumsum([r["size"] for r in rows]), BLOCK_BYTES, "right")))
        end = (rows[n - 1]["key"], rows[n - 1]["digest"])
        block = keyed.where(~after(end)) if last is None else keyed.where(after(last) & ~after(end))
        yield Signatures([tuple(r) for r in block.select("item_id", "text").collect()], threshold)
        last = end


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared``: one row for each document row and item
    that is contained in it. Null texts and items without words match nothing, an item of
    fewer than five words is one shingle; repeated items count once, repeated documents each; a null id is returned as null."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "doc_id long, item_id long, n_shingles long, n_shared long")
    for block in _blocks(items, threshold):
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = list(held.value.search(batch.column(1)))
                ids, item_ids = batch.column(0).to_pylist(), held.value.ids
                columns = [[ids[r[0]] for r in rows], [item_ids[r[1]] for r in rows], [r[2] for r in rows], [r[3] for r in rows]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "n_shingles", "n_shared"])

        out = out.union(on_executors(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, out.schema))
    return out


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item; all columns as they were. Null texts stay."""
    at = docs.columns.index("text")
    for block in _blocks(items, threshold):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                good[[r[0] for r in held.value.search(batch.column(at))]] = False
                yield batch.filter(pa.array(good))

        docs = on_executors(docs).mapInArrow(run, docs.schema)
    return docs
