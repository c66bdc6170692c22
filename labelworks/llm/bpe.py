"""Byte-level BPE by backtracking over longest matches.

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton over all
tokens finds the longest token at a place. A greedy parse may differ from the merges:
two neighbours stand in the true encoding only if no merge across their border would
have come first. That test depends on the two tokens alone and is memoised; where it
fails the parse falls back to the next shorter token, and a place found to lead nowhere
is never tried again, so the work is linear in the length of the text. The merges
themselves give the same ids, token for token.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from labelworks.session import on_executors

MEMO = 1 << 18  # entries of a memo before its older half is let go


def read_ranks(spark, path: str) -> list[bytes]:
    """The tokens of a rank file by rank, read through Spark, so that any store will do."""
    rows = spark.read.text(path if "://" in path else f"file://{path}").collect()
    pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (row.value.split() for row in rows if row.value.strip()))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must run from zero without gaps")
    if len({t for _, t in pairs if len(t) == 1}) != 256:
        raise ValueError("every byte must be a token")
    return [token for _, token in pairs]


class Encoder:
    """Encodes pieces of text; one for each Python worker."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = [t.decode("latin-1") for t in tokens]
        self.raw = tokens
        self.widest = max(map(len, self.tokens))
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        self.split = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self._halves: dict[int, tuple[int, int]] = {}
        self._shorter: dict[int, int] = {}
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def halves(self, own: int) -> tuple[int, int]:
        """The two tokens whose merge made this one; itself, twice, if no merge made it."""
        if (known := self._halves.get(own)) is None:
            parts = list(self.tokens[own])
            while len(parts) > 2:
                ranks = [self.rank.get(a + b, own) for a, b in zip(parts, parts[1:], strict=False)]
                if (least := min(ranks)) >= own:
                    break
                at = ranks.index(least)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self._halves[own] = (self.rank[parts[0]], self.rank[parts[1]]) if len(parts) == 2 else (own, own)
        return known

    def shorter(self, own: int) -> int:
        """The longest shorter token that this one begins with, or -1."""
        if (known := self._shorter.get(own)) is None:
            text = self.tokens[own]
            known = self._shorter[own] = next((self.rank[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.rank), -1)
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens may stand side by side: undone merge by merge, the latest
        first, no merge across the border comes before the ones that made them."""
        key = left * len(self.tokens) + right
        if (known := self.pairs.get(key)) is not None:
            return known
        if len(self.pairs) >= MEMO * 2:
            self.pairs.clear()
        a, b, limit, good = left, right, len(self.tokens), True
        while good:
            across = self.rank.get(self.tokens[a] + self.tokens[b])
            good = across is None or across >= limit
            inner, outer = self.halves(a)[1], self.halves(b)[0]
            if inner == a and outer == b:
                break
            if inner != a and (a > b or outer == b):
                a, limit = inner, a
            else:
                b, limit = outer, b + 1
        self.pairs[key] = good
        return good

    def _longest(self, text: str, at: int) -> int:
        return next(self.automaton.iter_long(text[at : at + self.widest]))[1]  # a slice: the automaton copies what it is given

    def encode_piece(self, text: str) -> list[int]:
        if (whole := self.rank.get(text)) is not None:
            return [whole]
        longest = [i for _, i in self.automaton.iter_long(text)]
        if all(map(self.fits, longest, longest[1:])):
            return longest
        out: list[int] = []
        at, dead = 0, set()
        token = self._longest(text, 0)
        while True:
            end = at + len(self.tokens[token])
            if end not in dead and (not out or self.fits(out[-1], token)):
                out.append(token)
                at = end
                if at == len(text):
                    return out
                token = self._longest(text, at)
                continue
            token = self.shorter(token)
            while token < 0:  # nothing shorter fits here: go back one token
                dead.add(at)
                token = out.pop()
                at -= len(self.tokens[token])
                token = self.shorter(token)

    def piece(self, text: str) -> tuple[int, str, bytes]:
        """Number of ids, the ids as text (each after a blank), and the bytes they decode to."""
        if (found := self.older.get(text)) is None:
            ids = self.encode_piece(text.encode().decode("latin-1"))
            found = len(ids), "".join([f" {i}" for i in ids]), b"".join([self.raw[i] for i in ids])
        if len(text) <= 64:
            if len(self.known) >= MEMO:
                self.older, self.known = self.known, {}
            self.known[text] = found
        return found

    def pieces(self, text: str) -> list[tuple[int, str, bytes]]:
        parts = self.split(text)
        found = list(map(self.known.get, parts))
        if None in found:
            known = self.known
            found = [known.get(p) or self.piece(p) if f is None else f for p, f in zip(parts, found, strict=True)]
        return found

    def encode(self, text: str) -> list[int]:
        return [int(i) for p in self.pieces(text) for i in p[1].split()]


_built: dict[str, Encoder] = {}  # a worker serves many tasks with one encoder


def _run(tokens, pattern: str, rows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hashlib.sha256(pattern.encode() + b"\n".join(tokens.value)).hexdigest()
        if key not in _built:
            _built.clear()
            _built[key] = Encoder(tokens.value, pattern)
        for batch in batches:
            yield rows(_built[key], batch)

    return run


def _digest(own: Encoder, batch: pa.RecordBatch) -> pa.RecordBatch:
    count, ids, decoded = [], [], []
    for text in batch.column(1):
        n, text_ids, raw = 0, hashlib.sha256(), hashlib.sha256()
        found = own.pieces(text.as_py() or "")
        if found:
            sizes, names, parts = zip(*found, strict=True)
            n = sum(sizes)
            text_ids.update("".join(names)[1:].encode())
            raw.update(b"".join(parts))
        count.append(n)
        ids.append(text_ids.hexdigest())
        decoded.append(raw.hexdigest())
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _ids(own: Encoder, batch: pa.RecordBatch) -> pa.RecordBatch:
    at, values, decoded = [0], [], []
    for text in batch.column(1):
        found = own.pieces(text.as_py() or "")
        part = np.array("".join([p[1] for p in found]).split(), np.int32)
        values.append(part)
        at.append(at[-1] + len(part))
        decoded.append(hashlib.sha256(b"".join([p[2] for p in found])).hexdigest())
    flat = pa.array(np.concatenate(values) if values else np.empty(0, np.int32), pa.int32())
    ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat)
    return pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(np.diff(at), pa.int64()), pa.array(decoded, pa.string())], names=["doc_id", "ids", "n_tokens", "decoded_sha256"])


def _encoder(docs: DataFrame, ranks_path: str, pattern: str):
    spark = docs.sparkSession
    # a vocabulary: fixed size, independent of the data
    return spark.sparkContext.broadcast(read_ranks(spark, ranks_path)), pattern


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id long, ids array<int>, n_tokens long, decoded_sha256 string`` of every row,
    the last of the bytes that the ids decode to; null and empty texts have no ids."""
    tokens, pattern = _encoder(docs, ranks_path, pattern)
    return on_executors(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(_run(tokens, pattern, _ids), "doc_id long, ids array<int>, n_tokens long, decoded_sha256 string")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id long, bytes binary`` from ids; no ids give no bytes, an unknown id fails."""
    tokens, _ = _encoder(encoded, ranks_path, "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [b"".join([tokens.value[i] for i in ids.as_py() or []]) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])

    return on_executors(encoded.select("doc_id", "ids")).mapInArrow(run, "doc_id long, bytes binary")


def round_trip_digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: ids as decimal
    numbers joined by one space, and the bytes that the ids decode to."""
    tokens, pattern = _encoder(docs, ranks_path, pattern)
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return on_executors(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(_run(tokens, pattern, _digest), fields)
