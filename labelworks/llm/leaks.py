"""Secrets in texts: keyword hits, anchored expressions, embedded checksums.

One Aho-Corasick automaton over all keywords passes each text once. Only where a keyword
stands is that kind's expression tried, anchored at the keyword, so its cost follows the
hits and not the text. Kinds whose values carry a checksum of their own are kept only where
it agrees. Runs of hex digits have no keyword: of every 16th byte, two neighbours that are
hex digits take the keyword's place, since a run of 32 and more holds two of them.

At scale: one narrow pass, nothing is shuffled or gathered. Work goes on in slices of whole
texts; a slice takes about 14 bytes of memory for each byte, and 100 bytes for each hit.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelworks.llm.words import slices
from labelworks.session import on_executors

STRIDE = 16
HEX_DIGITS = 32
BASE = ("assign", "access", "hex")
_DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_HEX_RUN = re.compile(rb"[0-9a-f]+")


@dataclass(frozen=True)
class Kind:
    """``keywords`` in lower case, one of which begins every match of ``pattern``."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern[bytes]
    valid: Callable[[re.Match[bytes]], bool]


def checked(token: bytes) -> bool:
    """30 characters and then their CRC-32 as six digits to the base 62."""
    if len(token) != 36:
        return False
    rest, digits = zlib.crc32(token[:30]), []
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        digits.append(_DIGITS[digit])
    return bytes(reversed(digits)) == token[30:]


#: The base patterns and lengths, and the prefixes of tokens with a checksum.
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE),
        lambda m: len(m[2]) >= 8,
    ),
    Kind("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    Kind("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(rb"gh[pousr]_([0-9A-Za-z]+)"), lambda m: checked(m[1])),
    Kind("npm", ("npm_",), re.compile(rb"npm_([0-9A-Za-z]+)"), lambda m: checked(m[1])),
)
#: Order of kinds that begin at the same place.
ORDER = (*BASE, *[k.name for k in KINDS if k.name not in BASE])
_HEX_RANK = ORDER.index("hex")


class Scanner:
    """Finds the spans of all kinds in slices of texts."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for i, kind in enumerate(KINDS):
            for word in kind.keywords:
                self.automaton.add_word(word, (i, len(word)))
        self.automaton.make_automaton()
        self.rank = [ORDER.index(k.name) for k in KINDS]

    def hits(self, raw: bytes) -> list[tuple[int, int]]:
        """(start, kind) of every keyword, by start. Bytes are read as Latin-1, A-Z as a-z."""
        return sorted((end - size + 1, kind) for end, (kind, size) in self.automaton.iter(raw.lower().decode("latin-1")))

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(row, start, kind's place in ORDER, end) in bytes of the slice."""
        raw = data.tobytes()
        hits = self.hits(raw)
        rows = np.searchsorted(offsets, [h[0] for h in hits], "right") - 1
        done = [0] * len(KINDS)
        for (start, kind), row in zip(hits, rows.tolist(), strict=True):
            if start < done[kind]:
                continue
            # the row's end bounds the match, so a keyword across two rows matches nothing
            if (found := KINDS[kind].pattern.match(raw, start, int(offsets[row + 1]))) is not None:
                done[kind] = found.end()
                if KINDS[kind].valid(found):
                    yield row, start, self.rank[kind], found.end()
        yield from self._hex_runs(raw, data, offsets)

    def _hex_runs(self, raw: bytes, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        probe = _HEX[data[::STRIDE]]
        near = np.flatnonzero(probe[:-1] & probe[1:]) * STRIDE
        rows = np.searchsorted(offsets, near, "right") - 1
        done = 0
        for at, row in zip(near.tolist(), rows.tolist(), strict=True):
            if at < done:
                continue
            first, end = int(offsets[row]), int(offsets[row + 1])
            done = _HEX_RUN.match(raw, at, end).end()
            while at > first and _HEX[raw[at - 1]]:
                at -= 1
            if done - at >= HEX_DIGITS:
                yield row, at, _HEX_RANK, done


_scanner: list[Scanner] = []


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not _scanner:
        _scanner.append(Scanner())
    for batch in batches:
        counts, kinds, starts, ends = np.zeros(batch.num_rows + 1, np.int64), [], [], []
        for lo, _, data, offsets in slices(batch.column(1)):
            found = sorted(_scanner[0].spans(data, offsets))
            if not found:
                continue
            row, start, kind, end = np.array(found, np.int64).T
            before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before a byte
            np.add.at(counts, lo + row + 1, 1)
            kinds.append(kind)
            starts.append(before[start] - before[offsets[row]])
            ends.append(before[end] - before[offsets[row]])
        flat = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (kinds, starts, ends)]
        names = pa.DictionaryArray.from_arrays(pa.array(flat[0], pa.int32()), pa.array(ORDER)).cast(pa.string())
        items = pa.StructArray.from_arrays([names, pa.array(flat[1]), pa.array(flat[2])], ["kind", "start", "end"])
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), items)
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "spans"])


def find(docs: DataFrame) -> DataFrame:
    """``doc_id long, spans array<struct<kind string, start long, end long>>`` of each row.

    Positions are code points from 0, ends exclusive; spans are sorted by start, then in
    the order of ORDER. Matches of a kind do not overlap, those of two kinds may. Null and
    empty texts have no spans, a null doc_id is returned as null, repeated rows are judged
    each, an empty table gives none; other columns of the table are not read.
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return on_executors(table).mapInArrow(_scan, "doc_id long, spans array<struct<kind string, start long, end long>>")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``: the counts and the digest
    are of the base kinds, ``spans`` joins all kinds as ``kind:start:end``."""
    spans = F.col("spans")

    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return find(docs).select("doc_id", *counts, F.sha2(_joined(of(*BASE)), 256).alias("base_sha256"), _joined(spans).alias("spans"))
