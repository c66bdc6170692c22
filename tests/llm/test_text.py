"""BPE, language ID, decontamination and licence scan."""

import base64
import random
import re

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm.helpers import SF, contains, item_size, sha, shingles
from pyspark.sql import functions as F

from labelworks.llm import bpe, decontaminate, language, licences
from labelworks.llm.queries import SQL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " ", "\n\n  \t x", "a" * 5000, "ab" * 3000, "été été — 汉字🙂🙂 'll 'LL 12345 ...", "<|endoftext|>", "\u0000\u00ad\u200b", "don't  stop\r\n" * 50, "̀́" * 400]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def test_ids_are_those_of_the_merges(spark, reference):
    encoding, ranks = reference
    rng = random.Random(1)
    tokens = list(ranks)
    mixed = [b"".join(rng.choice(tokens) for _ in range(30)).decode("utf-8", "replace") for _ in range(80)]
    docs = list(enumerate(ODD + mixed + [ODD[5]]))
    table = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, ids string").repartition(3)
    got = {r.doc_id: r for r in bpe.encode(table, RANKS, public_tokenizers.PATTERN).collect()}
    decoded = {r.doc_id: bytes(r.bytes) for r in bpe.decode(bpe.encode(table, RANKS, public_tokenizers.PATTERN), RANKS).collect()}
    digest = {r.doc_id: tuple(r)[1:] for r in bpe.round_trip_digest(table, RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in docs:
        ids, raw = encoding.encode_ordinary(t or ""), (t or "").encode()
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and decoded[i] == raw and got[i].decoded_sha256 == sha(raw)
        assert digest[i] == (len(ids), sha(" ".join(map(str, ids))), sha(raw))
    assert bpe.encode(table.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_small_memos_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    encoding, ranks = reference
    own = bpe.Encoder(sorted(ranks, key=ranks.get), public_tokenizers.PATTERN)
    text = "The quick brown fox, überraschend schnell, jumped 12 times over elleouéau." * 3
    assert own.encode(text) == encoding.encode_ordinary(text)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.language_digest(docs).join(docs, "doc_id").where("held_out").collect()
    right = [r.lang == r.lang_pred for r in found]
    assert len(right) > 200 and sum(right) >= 0.99 * len(right)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_cases(spark):
    docs = [(i, "the cat and the dog ran to the house", "en", 1.5) for i in range(40)] + [(100 + i, "der hund und die katze im haus", "de", 2.5) for i in range(40)]
    odd = [(200, None, "en", 0.0), (201, "", "en", 0.0), (202, "12 34 !?", None, 0.0), (203, "x", None, 0.0), (204, "der Hund", None, 0.0), (None, "the dog", None, 0.0), (205, "THE " * 50000, None, 0.0)]
    table = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string, score double")
    found = {r.doc_id: r for r in language.language_digest(table).collect()}
    assert [found[i].lang_pred for i in (200, 201, 202, 204, None, 205)] == ["und", "und", "und", "de", "en", "en"]
    assert found[203].lang_pred in ("en", "de") and found[200].score == 0 and found[None].held_out is False
    kept = language.accepted(table)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in docs} | {203, 204, None, 205}
    assert {r.score for r in kept.collect()} == {0.0, 1.5, 2.5}  # the table's own column of that name
    nothing = language.language_digest(table.limit(0))
    assert nothing.count() == 0
    untaught = table.where("doc_id is null").withColumn("lang", F.lit(None).cast("string"))
    assert [r.lang_pred for r in language.language_digest(untaught).collect()] == ["und"]


def test_vectors_are_held_in_blocks(monkeypatch):
    rng, held, bound = random.Random(3), [], language._bound
    monkeypatch.setattr(language, "_bound", lambda codes: held.append(len(codes)) or bound(codes))
    texts = pa.array(["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n)) for n in (20000, 5, 3000)] + ["the dog", None])
    batch = pa.RecordBatch.from_arrays([texts, pa.array(["a", "b", "a", "b", "a"])], names=["text", "lang"])

    def learn():
        (out,) = language._bundles([batch])
        return {n: np.array(v) for n, v in zip(*(c.to_pylist() for c in out.columns), strict=True)}

    parts = learn()
    found = language._predict(parts)(texts)
    assert max(held) <= 8192 and sum(held) > 40000
    monkeypatch.setattr(language, "GRAMS", 1 << 30)
    whole = learn()
    assert all((parts[n] == whole[n]).all() for n in whole) and language._predict(whole)(texts) == found
    assert found[0][:4] == ["a", "b", "a", "b"] and found[0][4] == "und"


def test_contained_items_are_those_of_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 20, 60])))) for i in range(60)]
    items += [(3, items[3][1]), (70, None), (71, ""), (None, "one two three four five six")]
    docs = [(-1, None), (-2, ""), (-3, "one TWO, three four-five six")]
    for i in range(60):
        w = [word() for _ in range(rng.randint(0, 200))]
        own = rng.choice(items[:60])[1].split()
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = word()
        w[rng.randint(0, len(w)) :] += own
        docs.append((i, rng.choice([" ", "\n", ", "]).join(w).title()))
    docs.append(docs[10])
    monkeypatch.setattr(decontaminate, "BLOCK", 25)
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(x), str(i), len(shingles(t, item_size(t))), len(shingles(t, item_size(t)) & shingles(y, item_size(t)))) for x, y in docs for i, t in {*items} if t and contains(y, t))
    assert {item_size(t) for i, t in items if t} == {1, 2, 3, 4, 5} and any(len(t.split()) < 5 for i, t in items if t and any(contains(y, t) for _, y in docs))
    assert sorted((str(r[0]), str(r[1]), r[2], r[3]) for r in decontaminate.contained(d, b).collect()) == want and len(want) > 10
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": [x for x, _ in docs[:-1]], "text": [y for _, y in docs[:-1]]}))
    known = [r for r in {*items} if r[0] is not None and r[0] != 3]
    con.register("benchmark", pd.DataFrame({"item_id": [i for i, _ in known], "text": [t for _, t in known]}))
    told = sorted((str(r[0]), str(r[1]), r[2], r[3]) for r in con.execute(SQL["op2_benchmark_decontamination"]).fetchall())
    assert told == sorted({w for w in want if w[1] not in ("3", "None")})
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted(x for x, y in docs if not any(contains(y, t) for _, t in items))
    assert decontaminate.contained(d, b.limit(0)).count() == 0 and decontaminate.clean(d.limit(0), b).count() == 0
    assert decontaminate.clean(d, b.limit(0)).count() == len(docs)


def test_blocks_of_items_are_bounded_by_bytes(spark, monkeypatch):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(10 + i))) for i in range(20)] + [(3, "one two three four five six"), (None, "a b c d e f"), (None, "a b c d e g")]
    items += [(30, " ".join(f"long{j}" for j in range(400)))]
    b = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    d = spark.createDataFrame([(n, f"before {t} after") for n, (_, t) in enumerate(items)], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    with monkeypatch.context() as only:
        only.setattr(decontaminate, "Signatures", lambda rows, threshold: rows)
        blocks = list(decontaminate._blocks(b, 0.8))
    assert len(blocks) > 5 and sorted(map(str, sum(blocks, []))) == sorted(map(str, items))
    assert all(sum(len(t) for _, t in x) <= 600 or len(x) == 1 for x in blocks)
    found = decontaminate.contained(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in found} >= {(n, i) for n, (i, _) in enumerate(items)}
    assert decontaminate.clean(d, b).count() == 0


def places(text, phrase):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    p = phrase.split()
    return [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p], len(w)


def test_licence_places_are_those_of_brute_force(spark):
    rng = random.Random(8)
    vocabulary = "gnu general public license apache cc by nc sa mit version 2 0 3 all rights reserved the é".split()
    docs = [(i, rng.choice(["", " ", "("]) + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 400))) + rng.choice(["", ".", "\n"])) for i in range(80)]
    docs += [(i + 100, rng.choice(["GNU General  Public License, version 3", "CC BY-NC 4.0", "MIT license MIT License", "Apache-License", "All rights reserved.", "gnu general public", "ÉMIT license"])) for i in range(30)]
    docs += [(-1, None), (-2, ""), (-3, "..."), (-4, "mit license " * 20000), (5, docs[5][1])]
    table = spark.createDataFrame([(*d, "own") for d in docs], "doc_id long, text string, labels string").repartition(3)
    rows = licences.licence_digest(table).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for r in rows:
        base = [(i, t.label) for t in licences.BASE for i in places(texts[r.doc_id], t.phrase)[0]]
        every = {t.label for t in licences.BASE + licences.FURTHER if places(texts[r.doc_id], t.phrase)[0]}
        starts = [i for i, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (places(texts[r.doc_id], "x")[1], len(base), min(starts, default=None), max(starts, default=None)), r.doc_id
        assert r.base_labels == ",".join(sorted({x for _, x in base})) and r.labels == ",".join(sorted(every)) and 0 <= r.score <= 1 and (r.score > 0) == bool(every)
    assert licences.licence_digest(table.limit(0)).count() == 0


def opening_places(words, opening, weights):
    """Starts of an opening: enough rare words at their places, and the key phrase at its own."""
    text, key = opening.text.split(), opening.key.split()
    rare = sorted(set(text), key=lambda w: (-weights[w], text.index(w)))[: licences.RARE]
    at = next(i for i in range(len(text)) if text[i : i + len(key)] == key)
    stands = lambda start, w: 0 <= start + text.index(w) < len(words) and words[start + text.index(w)] == w
    return [s for s in range(-len(text), len(words)) if sum(stands(s, w) for w in rare) >= licences.AGREE and s + at >= 0 and words[s + at : s + at + len(key)] == key]


def test_licence_openings_are_those_of_brute_force(spark):
    rng = random.Random(12)
    filler = lambda n: " ".join(rng.choice(["lorem", "the", "software", "license", "of", "file"]) for _ in range(n))
    docs = []
    for n, o in enumerate(licences.OPENINGS):
        words = o.text.split()
        docs.append((10 * n, f"Copyright 2020 Jane Doe. {o.text.title()}, and so on"))
        docs.append((10 * n + 1, filler(rng.randint(0, 30)) + " " + " ".join(w if rng.random() < 0.9 else "changed" for w in words)))
        cut = rng.randrange(5, len(words) // 2)
        docs.append((10 * n + 2, " ".join(words[cut:])))  # begins in the middle
        docs.append((10 * n + 3, " ".join([*words[:cut], "inserted", *words[cut:]]) + " " + o.text))
        docs.append((10 * n + 4, o.text.replace(o.key, " ".join(["other"] * len(o.key.split())))))
        docs.append((10 * n + 5, o.key))
    docs += [(1000, None), (1001, ""), (1002, f"({licences.OPENINGS[0].text})" * 300), (1003, filler(200))]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    vocabulary = sorted({w for t in licences.BASE + licences.FURTHER for w in t.phrase.split()} | {w for o in licences.OPENINGS for w in o.text.split()})
    weights = licences.word_weights(table, vocabulary)
    hits = 0
    for r in licences.scan(table).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").lower())
        want = sorted((s, o.label) for o in licences.OPENINGS for s in opening_places(words, o, weights))
        phrases = sorted((i, t.label) for t in licences.BASE + licences.FURTHER for i in places(r.text, t.phrase)[0])
        assert sorted((p.start, p.label) for p in r.places) == sorted(want + phrases), r.doc_id
        hits += len(want)
        if r.doc_id % 10 == 0 and r.doc_id < 1000:
            assert any(label == licences.OPENINGS[r.doc_id // 10].label for _, label in want)
        if r.doc_id % 10 == 4 and r.doc_id < 1000:
            assert licences.OPENINGS[r.doc_id // 10].label not in {label for _, label in want}
    assert hits > 300
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    digest = licences.licence_digest(table).withColumn("score", F.round("score", 6))
    assert sorted(map(tuple, digest.collect())) == sorted(con.execute(SQL["op9_licence_scan"]).fetchall())


def test_weights_count_every_document(spark):
    weights = licences.word_weights(spark.read.parquet(f"{SF}/documents.parquet"), ["license", "zzz"])
    assert weights["zzz"] > weights["license"] > 1
