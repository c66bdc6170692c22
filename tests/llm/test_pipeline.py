"""The registered queries beside their SQL, and the pipeline beside brute force."""

import base64
import re

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from llm.helpers import SF, contains, covered, fingerprint, near, roots, sha, words
from oracle import compare, connect

import __spark_entry__ as entry
from labelworks.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    ok, note, _ = compare(spark, connect(SF), queries.QUERIES[name], queries.SQL[name], SF)
    assert ok, note


def test_ten_queries_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.SQL) <= set(entry.oracle_sql()) and [n for n, _ in corpus_pipeline.STAGES][1] == "SimHash near-dedup"


def brute_force(docs, items):
    """The stages by hand, for rows with distinct ids; every text of the tables has letters of a learned language."""
    kept = {d: t for d, t in docs if t and re.search(r"[^\W\d_]", t)}
    prints = {d: fingerprint(t) for d, t in kept.items()}
    root = roots(sorted(kept), lambda a, b: near(prints[a], prints[b]))
    kept = {d: t for d, t in kept.items() if root[d] == d}
    gone = covered(list(kept.items()), 20)

    def cut(text, flags):
        out, at, i, found = "", 0, 0, list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        while i < len(found):
            if flags[i]:
                j = i
                while j + 1 < len(found) and flags[j + 1]:
                    j += 1
                out, at, i = out + text[at : found[i].start()], found[j].end(), j
            i += 1
        return out + text[at:]

    kept = {d: cut(t, gone[d]) for d, t in kept.items()}
    return {d: t for d, t in kept.items() if not any(contains(t, x) for x in items)}


def test_pipeline_is_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = brute_force(docs, items)
    got = {r.doc_id: (r.ids, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(want) and len(want) < len(docs)
    for d, text in want.items():
        ids = encoding.encode_ordinary(text)
        assert got[d] == (ids, len(ids), sha(text.encode()))


def test_stages_stand_odd_rows(spark):
    passage, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"other{i}" for i in range(200))
    rows = [(1, passage, "en", None, 5), (1, passage, "en", None, 5), (2, None, None, "s", None), (3, "", "en", "s", 0), (None, "some words here", "en", "s", 1), (4, "12 !", "en", "s", 1), (5, f"{other} {passage} and more", "en", "s", 1)]
    rows += [(6, "long " * 30000 + "tail", "en", "s", 1)]
    for table in (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")):
        docs = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == table.columns, name
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert sorted(str(r.doc_id) for r in out) == (["1", "5", "6", "None"] if table.count() else [])
        texts = {r.doc_id: r for r in docs.collect()}
        if table.count():
            assert texts[5].text == f"{other}  and more" and texts[5].n_chars == len(texts[5].text)
            assert words(texts[1].text) == words(passage)
