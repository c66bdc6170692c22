"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 drawn from its code point. An n-gram binds
its letters: the vectors, each rotated by its place, are multiplied. A text bundles its
n-grams by adding them, a language all its labelled texts. Prediction is the language
whose prototype has the highest cosine with the text's vector.

At scale: training adds partial sums of each task (one vector a language), prediction
judges rows alone. Only the prototypes, one vector a language, go to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelworks.llm.words import U, slices
from labelworks.session import on_executors

SIZE, GRAM, SEED, ROWS, MOST_LANGUAGES = 1024, 3, 7, 256, 2000
GRAMS = 8192  # distinct trigrams whose vectors are held at once
UNKNOWN = "und"


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it a letter, and its lower case if that is one code point."""
    points = range(0x110000)
    letter = np.fromiter((chr(p).isalpha() for p in points), bool, 0x110000)
    lower = np.arange(0x110000, dtype=np.uint32)
    for p in np.flatnonzero(letter):
        if len(small := chr(p).lower()) == 1:
            lower[p] = ord(small)
    return letter, lower


@lru_cache(1 << 16)  # 64 MB
def _vector(point: int, turn: int) -> np.ndarray:
    own = np.random.default_rng([SEED, point]).integers(0, 2, SIZE, dtype=np.int8) * 2 - 1
    return np.roll(own, turn).astype(np.int8)


def _bound(codes: np.ndarray) -> np.ndarray:
    """The vectors of n-grams given as code points of 21 bits each."""
    out = np.ones((len(codes), SIZE), np.int8)
    for place in range(GRAM):
        points, at = np.unique((codes >> U(21 * place)) & U(0x1FFFFF), return_inverse=True)
        out *= np.stack([_vector(int(p), place) for p in points])[at] if len(points) else 1
    return out


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and row of every n-gram; breaks between words are one blank (code point 0)."""
    letter, lower = _letters()
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    text = np.where(letter[points], lower[points], 0)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    text, row = np.insert(text, before, 0), np.insert(row, before, -1)  # every text begins and ends with a break
    word = text > 0
    kept = word | np.concatenate([[True], word[:-1]])
    text, row, word = text[kept].astype(np.uint64), row[kept], word[kept]
    middle = np.flatnonzero(word)
    codes = text[middle - 1] | text[middle] << U(21) | text[middle + 1] << U(42)
    return codes, row[middle]


def _bundle(own: np.ndarray, at: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """The sums of the vectors of n bundles: of each n-gram its bundle and its place in the
    ascending ``codes``. GRAMS codes at a time, so memory does not follow their number; the
    numbers are whole and exact in whatever order they are added."""
    out = np.zeros((n, SIZE))
    if len(codes) > GRAMS:
        order = np.argsort(at, kind="stable")
        own, at = own[order], at[order]
    for lo in range(0, len(codes), GRAMS):
        part = codes[lo : lo + GRAMS]
        span = slice(*np.searchsorted(at, [lo, lo + len(part)])) if len(codes) > GRAMS else slice(None)
        counts = np.bincount(own[span] * len(part) + at[span] - lo, minlength=n * len(part)).reshape(n, -1)
        # 32-bit floats are exact up to 2**24
        kind = np.float32 if counts.sum(1).max(initial=0) < 1 << 24 else np.float64
        out += counts.astype(kind) @ _bound(part).astype(kind)
    return out


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for lo, hi, data, offsets in slices(batch.column(0)):
            codes, row = _grams(data, offsets)
            names, own = np.unique(np.array(langs[lo:hi], dtype=object).astype(str), return_inverse=True)
            codes, at = np.unique(codes, return_inverse=True)
            if len(codes):
                for name, part in zip(names.tolist(), _bundle(own[row], at, codes, len(names)), strict=True):
                    total[name] = total.get(name, 0) + part
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["lang", "bundle"])


def train(docs: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes from all rows with a text and a ``lang``; other columns are not read."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    parts = on_executors(known).mapInArrow(_bundles, "lang string, bundle array<double>")
    sums = parts.select("lang", F.posexplode("bundle").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    whole = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"))
    rows = whole.select("lang", F.transform("v", lambda x: x["x"]).alias("v")).limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {r["lang"]: np.array(r["v"]) for r in sorted(rows, key=lambda r: r["lang"])}


def _predict(prototypes: dict[str, np.ndarray]):
    names = [name for name, v in prototypes.items() if v.any()]
    matrix = np.array([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names], np.float32).reshape(len(names), SIZE)

    def judged(column: pa.Array) -> tuple[list[str], list[float]]:
        langs: list[str] = []
        scores: list[float] = []
        for lo, hi, data, offsets in slices(column):
            codes, row = _grams(data, offsets)
            codes, at = np.unique(codes, return_inverse=True)
            bound = _bound(codes).astype(np.float32) if len(codes) <= GRAMS else None
            edges = np.searchsorted(row, np.arange(0, hi - lo + ROWS, ROWS))
            for i, first in enumerate(range(0, hi - lo, ROWS)):
                span, n = slice(edges[i], edges[i + 1]), min(ROWS, hi - lo - first)
                if bound is None:
                    here, place = np.unique(at[span], return_inverse=True)
                    texts = _bundle(row[span] - first, place, codes[here], n).astype(np.float32)
                else:
                    counts = np.bincount((row[span] - first) * len(codes) + at[span], minlength=n * len(codes)).reshape(n, -1)
                    texts = counts.astype(np.float32) @ bound if len(codes) else np.zeros((n, SIZE), np.float32)
                length = np.sqrt((texts.astype(np.float64) ** 2).sum(1))
                some = np.bincount(row[span] - first, minlength=n) > 0
                cosine = (texts @ matrix.T) / np.maximum(length, 1)[:, None] if names else np.zeros((n, 1))
                best = cosine.argmax(1)
                langs += [names[b] if ok and names else UNKNOWN for b, ok in zip(best, some, strict=True)]
                scores += [float(x) if ok else 0.0 for x, ok in zip(np.clip(cosine[np.arange(n), best], 0, 1), some, strict=True)]
        return langs, scores

    return judged


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; an id that is null is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """The table with ``lang_pred string, score double`` added (columns of these names are
    replaced): a learned language and the cosine, cut to 0..1; ``und`` and 0 for a null
    text or one without a letter, or if nothing was learned. Ties go to the first name."""
    rest = docs.drop("lang_pred", "score")
    judged, at = _predict(prototypes), rest.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = judged(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return on_executors(rest).mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def accepted(docs: DataFrame) -> DataFrame:
    """Documents in a language that was learned: rows whose text is null or has no letter
    go; all columns stay as they were. Prototypes come from the rows that are not held out."""
    judged = _predict(train(docs.where(~held_out(F.col("doc_id")))))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([lang != UNKNOWN for lang in judged(batch.column(at))[0]], pa.bool_()))

    return on_executors(docs).mapInArrow(run, docs.schema)


def language_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, learned from the others."""
    prototypes = train(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", "text"), prototypes).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
