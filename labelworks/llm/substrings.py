"""Repeated passages by content-defined blocks and hashed window look-up.

They replace the greedy relative Lempel-Ziv parse: no factor is extended word by word.

The corpus is its own reference. Every document is parsed into blocks whose limits
depend on content alone: each window of ``window`` words belongs to its smallest
eight-word hash (its anchor), and consecutive windows with one anchor form a block.
Copies of a passage therefore fall into the same blocks wherever they stand.

* Index: every block of every document is looked up by its anchor. A block that
  stands earlier, with the same 64-bit hash of its words, is a factor.
* Boundaries: where an anchor is known but the words around it differ, a copied
  passage may begin or end inside the block; its windows are looked up one by one.
* Factors that touch or overlap are joined greedily into the longest duplicate spans.

The result is exact apart from hash collisions: a word is covered if and only if a window over it starts earlier
(smaller doc_id, or same document and earlier word).

At scale: each task sends at most one row for an anchor (copies and clashes inside
the task are settled there), so no anchor gathers rows however common its passage.
Windows are compared through a partial aggregate. Texts are shuffled by doc_id only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelworks.llm.columns import under_numbers
from labelworks.llm.words import grams, mix, run_hashes, slices, spans, word_hashes
from labelworks.operators.keep import keep
from labelworks.session import on_executors

ANCHOR = 8
HELD = 1_000_000
WHOLE, CLASH, PARTS, COPY = range(4)
_ROW = "k long, ph long, doc_id long, start int, n int, kind int"


def _blocks(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Row, first window (word in the row), number of windows, anchor and word hash of each block."""
    starts, ends, first = spans(data, offsets)
    n = len(starts) - window + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    words = word_hashes(data, starts, ends)
    anchors = grams(words, min(ANCHOR, window))
    best = np.lib.stride_tricks.sliding_window_view(anchors, window - min(ANCHOR, window) + 1).argmin(1) + np.arange(n)
    inside = row[:n] == row[window - 1 :]
    opens = inside & np.concatenate([[True], (best[1:] != best[:-1]) | ~inside[:-1]])
    begin = np.flatnonzero(opens)
    count = np.add.reduceat(inside.astype(np.int64), begin) if len(begin) else np.empty(0, np.int64)
    hashes = run_hashes(words, begin, begin + count - 1 + window)
    shift = (best[begin] - begin).astype(np.uint64)
    return row[begin], begin - first[row[begin]], count, anchors[best[begin]], mix(hashes + shift)


def _settle(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One row for each anchor, and what is already certain: copies, and anchors with differing words."""
    doc, start, n, anchor, ph = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((start, doc, ph, anchor))
    doc, start, n, anchor, ph = doc[order], start[order], n[order], anchor[order], ph[order]
    new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    new_block = new_anchor | np.concatenate([[True], ph[1:] != ph[:-1]])
    at = np.flatnonzero(new_block)[np.cumsum(new_block) - 1]
    later = (doc != doc[at]) | (start != start[at])  # a repeated row is the same place, not a copy
    blocks = np.add.reduceat(new_block.astype(np.int64), np.flatnonzero(new_anchor))
    clash = blocks[np.cumsum(new_anchor) - 1] > 1
    kind = np.where(later, COPY, np.where(clash, PARTS, WHOLE))
    take = later | new_block
    marker = np.flatnonzero(new_anchor & clash)
    spread = mix(doc.astype(np.uint64) * np.uint64(31) + start.astype(np.uint64))
    key = np.where(kind == WHOLE, anchor, spread)
    join = lambda x, y: np.concatenate([x[take], y])
    none = np.zeros(len(marker), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(join(key, anchor[marker]).view(np.int64)),
            pa.array(join(ph, none.view(np.uint64)).view(np.int64)),
            pa.array(join(doc, none)),
            pa.array(join(start, none).astype(np.int32)),
            pa.array(join(n, none).astype(np.int32)),
            pa.array(join(kind, none + CLASH).astype(np.int32)),
        ],
        names=["k", "ph", "doc_id", "start", "n", "kind"],
    )


def _block_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, hi, data, offsets in slices(batch.column(1)):
                row, *rest = _blocks(data, offsets, window)
                held.append((ids[lo:hi][row], *rest))
                size += len(row)
                if size >= HELD:
                    yield _settle(held)
                    held, size = [], 0
        if size:
            yield _settle(held)

    return run


def _window_rows(window: int):
    """(h1, h2, doc_id, start) of the first place, in each part of a task, of every window to be looked up."""

    def settle(parts) -> pa.RecordBatch:
        h1, h2, doc, start = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((start, doc, h2, h1))
        h1, h2, doc, start = h1[order], h2[order], doc[order], start[order]
        first = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        columns = [h1[first].view(np.int64), h2[first].view(np.int64), doc[first], start[first].astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h1", "h2", "doc_id", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids, blocks = (batch.column(batch.schema.get_field_index(name)) for name in ("__id", "__found"))
            ids = ids.to_numpy(zero_copy_only=False)  # without an id there are no blocks
            texts = batch.column(batch.schema.get_field_index("text"))
            list_at = np.asarray(blocks.offsets)
            inner = blocks.values
            b_start, b_n, b_kind = (np.asarray(inner.field(name)).astype(np.int64) for name in ("start", "n", "kind"))
            for lo, hi, data, offsets in slices(texts):
                span = slice(list_at[lo], list_at[hi])
                row = np.repeat(np.arange(hi - lo), np.diff(list_at[lo : hi + 1]))
                part = b_kind[span] == PARTS
                if not part.any():
                    continue
                starts, ends, first = spans(data, offsets)
                row, s, n = row[part], b_start[span][part], b_n[span][part]
                n = np.minimum(n, np.diff(first)[row] - window + 1 - s)  # of a repeated doc_id, its own words only
                row, s, n = row[n > 0], s[n > 0], n[n > 0]
                if not len(row):
                    continue
                words = word_hashes(data, starts, ends)
                at = np.repeat(s, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row = np.repeat(row, n)
                place = first[row] + at
                held.append((grams(words, window)[place], run_hashes(words, place, place + window), ids[lo:hi][row].astype(np.int64), at))
                size += len(at)
                if size >= HELD:
                    yield settle(held)
                    held, size = [], 0
        if size:
            yield settle(held)

    return run


def _joined(window: int):
    """Duplicate spans of each document from its blocks and the windows that stand first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, blocks, firsts = batch.column(0), batch.column(1), batch.column(2)
            at, inner = np.asarray(blocks.offsets), blocks.values
            start, n, kind = (np.asarray(inner.field(name)).astype(np.int64) for name in ("start", "n", "kind"))
            f_at, f_start = np.asarray(firsts.offsets), np.asarray(firsts.values).astype(np.int64)
            count, lows, highs = [], [], []
            for i in range(len(ids)):
                s, k, whole = start[at[i] : at[i + 1]], n[at[i] : at[i + 1]], kind[at[i] : at[i + 1]] == COPY
                parts = np.repeat(s[~whole], k[~whole]) + np.arange(k[~whole].sum()) - np.repeat(np.cumsum(k[~whole]) - k[~whole], k[~whole])
                parts = np.setdiff1d(parts, f_start[f_at[i] : f_at[i + 1]])
                low = np.concatenate([s[whole], parts])
                high = np.concatenate([s[whole] + k[whole] - 1 + window, parts + window])
                order = np.argsort(low, kind="stable")
                low, high = low[order], np.maximum.accumulate(high[order])
                new = np.concatenate([[True], low[1:] > high[:-1]]) if len(low) else np.empty(0, bool)
                lows.append(low[new])
                highs.append(high[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)] if len(low) else low)
                count.append(len(lows[-1]))
            pieces = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int32) if x else np.empty(0, np.int32)) for x in (lows, highs)], names=["low", "high"]
            )
            out = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pieces)
            yield pa.RecordBatch.from_arrays([ids, out], names=["doc_id", "spans"])

    return run


def _spans(docs: DataFrame, window: int) -> DataFrame:
    """``__doc_id, __found`` for a table with ``__id`` and ``text``, whatever else it has.

    All its columns go along to the window search: the search and the caller's join with
    the result then shuffle one and the same table, and Spark shuffles it once.
    """
    if window < 1:
        raise ValueError("window must be at least one word")
    known = docs.where(F.col("__id").isNotNull() & F.col("text").isNotNull()).select(F.col("__id").alias("doc_id"), "text")
    rows = on_executors(known).mapInArrow(_block_rows(window), _ROW)
    anchor = Window.partitionBy("k")
    place, clash = F.struct("doc_id", "start"), F.max(F.col("kind") == CLASH).over(anchor) | (F.min("ph").over(anchor) != F.max("ph").over(anchor))
    judged = (
        rows.withColumn("settled", F.col("kind") >= PARTS)
        .withColumn("verdict", F.when(F.col("settled"), F.col("kind")).when(clash, PARTS).when(place > F.min(place).over(anchor), COPY))
        .where(F.col("verdict").isNotNull() & (F.col("kind") != CLASH))
    )
    blocks = keep(judged.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", F.col("verdict").alias("kind"))).alias("blocks")))
    none = F.array().cast("array<struct<start:int,n:int,kind:int>>")
    asked = docs.join(blocks.select(F.col("doc_id").alias("__doc_id"), F.col("blocks").alias("__found")), F.col("__id") == F.col("__doc_id"), "left")
    asked = asked.select(*[f"`{c}`" for c in docs.columns], F.coalesce("__found", none).alias("__found"))
    looked = on_executors(asked).mapInArrow(_window_rows(window), "h1 long, h2 long, doc_id long, start int")
    firsts = looked.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start")).alias("at")).select("at.*")
    firsts = firsts.groupBy("doc_id").agg(F.collect_list("start").alias("firsts"))
    both = blocks.join(firsts, "doc_id", "left").select("doc_id", "blocks", F.coalesce("firsts", F.array().cast("array<int>")).alias("firsts"))
    found = on_executors(both).mapInArrow(_joined(window), "doc_id long, spans array<struct<low int, high int>>").where(F.size("spans") > 0)
    return found.select(F.col("doc_id").alias("__doc_id"), F.col("spans").alias("__found"))


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """``doc_id long, spans array<struct<low int, high int>>``: for each document with
    repeated passages, the half-open word ranges covered by windows of ``window`` words
    that start earlier. Spans are disjoint, ascending, and at least ``window`` words long.

    Null or empty texts, and texts shorter than the window, have no spans. Rows without
    an id take no part. Rows that share an id and a text are one document; of rows that
    share an id but not the text, each window counts at its own word offset.
    """
    found = _spans(docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("text")), window)
    return found.select(F.col("__doc_id").alias("doc_id"), F.col("__found").alias("spans"))


def _kept(text: bytes, low: np.ndarray, high: np.ndarray) -> list[bytes]:
    words, out, at = text.split(), [], 0
    for a, b in zip(low, high, strict=True):
        out += words[at:a]
        at = max(at, b)
    return out + words[at:]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, found = batch.column(1).cast(pa.large_binary()), batch.column(2)
        at, low, high = np.asarray(found.offsets), np.asarray(found.values.field("low")), np.asarray(found.values.field("high"))
        total, removed, digest = [], [], []
        for i in range(len(texts)):
            text = texts[i].as_py() or b""
            kept = _kept(text, low[at[i] : at[i + 1]].tolist(), high[at[i] : at[i + 1]].tolist())
            total.append(len(text.split()))
            removed.append(total[-1] - len(kept))
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts without the bytes from a span's first word to its last; the rest stays as it was."""
    for batch in batches:
        texts, found = batch.column(batch.schema.get_field_index("text")), batch.column(batch.schema.get_field_index("__spans"))
        at, low, high = np.asarray(found.offsets), np.asarray(found.values.field("low")), np.asarray(found.values.field("high"))
        out = []
        raw = texts.cast(pa.large_binary())
        for i in range(len(texts)):
            text = raw[i].as_py()
            if text is not None and at[i] < at[i + 1]:
                data = np.frombuffer(text, np.uint8)
                starts, ends, _ = spans(data, np.array([0, len(data)]))
                pieces, begin = [], 0
                for a, b in zip(low[at[i] : at[i + 1]], high[at[i] : at[i + 1]], strict=True):
                    if a < len(starts):
                        pieces.append(text[begin : starts[a]])
                        begin = int(ends[min(b, len(ends)) - 1])
                text = b"".join([*pieces, text[begin:]])
            out.append(text)
        columns = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name not in ("text", "__spans")]
        names = [name for name in batch.schema.names if name not in ("text", "__spans")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary()).cast(texts.type)], names=[*names, "text"])


def _with_spans(docs: DataFrame, window: int) -> DataFrame:
    base = docs.withColumn("__id", F.col("doc_id").cast("long"))
    none = F.array().cast("array<struct<low:int,high:int>>")
    joined = base.join(_spans(base, window), F.col("__id") == F.col("__doc_id"), "left")
    return joined.select(*[f"`{c}`" for c in base.columns], F.coalesce("__found", none).alias("__spans"))


def cut_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """The documents with every repeated passage cut out of ``text``; all columns and rows stay.

    Texts without repeats come back byte for byte; null stays null; a text that only
    repeats earlier ones becomes what stands between its words' ends (often empty).
    """
    docs, back = under_numbers(docs, ("doc_id", "text"))
    cut = _with_spans(docs, window)
    rest = [f for f in docs.schema.fields if f.name != "text"]
    shape = T.StructType([*rest, T.StructField("text", T.StringType())])
    return back(on_executors(cut.select(*[f"`{f.name}`" for f in rest], "text", "__spans")).mapInArrow(_cut, shape))


def kept_digest(docs: DataFrame, window: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document (null text: no words)."""
    marked = _with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), window)
    return on_executors(marked.select("__id", "text", "__spans", "doc_id")).mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
