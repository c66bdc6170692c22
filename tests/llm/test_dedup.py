"""Substring dedup, SimHash near-dedup and components against brute force."""

import random

import pytest
from llm.helpers import SF, covered, fingerprint, near, roots, sha, words

from labelworks.llm import graph, licences, simhash, substrings, urls


def texts(seed, n, vocabulary=4, longest=60):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        w = [rng.choice("abcdefgh"[:vocabulary]) for _ in range(rng.randint(0, longest))]
        if made and rng.random() < 0.5:
            other = words(rng.choice(made)[1])
            at = rng.randint(0, len(w))
            lo = rng.randint(0, len(other))
            w[at:at] = other[lo : lo + rng.randint(0, 40)]
        made.append((i * 3 - 7, rng.choice([" ", "\n", " \t "]).join(w)))
    rng.shuffle(made)
    return made


@pytest.mark.parametrize(("window", "vocabulary"), [(1, 8), (3, 8), (5, 3), (9, 2), (20, 8)])
def test_covered_words_are_those_of_brute_force(spark, window, vocabulary):
    docs = [*texts(window, 40, vocabulary), (-100, None), (-101, ""), (500, " \n"), (501, "x " * 300), (502, "x " * 40)]
    found = {r.doc_id: r.spans for r in substrings.duplicate_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), window=window).collect()}
    for d, gone in covered(docs, window).items():
        got = [False] * len(gone)
        for low, high in found.get(d, []):
            got[low:high] = [True] * (high - low)
        assert got == gone, d


def test_digest_and_cut_text(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = [(5, f"own\n\nstart  {passage} end", 1, "x"), (3, f"first {passage}\tlast", 2, "y"), (9, passage, None, None), (10, None, 0, ""), (11, "a  b\n", 4, "z"), (None, passage, 7, "q")]
    table = spark.createDataFrame(docs, "doc_id long, text string, spans int, found string")
    cut = {r.doc_id: r for r in substrings.cut_repeats(table).collect()}
    assert substrings.cut_repeats(table).columns == table.columns
    assert cut[5].text == "own\n\nstart   end" and cut[5].spans == 1 and cut[5].found == "x"
    assert cut[3].text == docs[1][1] and cut[9].text == "" and cut[10].text is None and cut[11].text == "a  b\n"
    assert cut[None].text == passage
    got = {r.doc_id: tuple(r)[1:] for r in substrings.kept_digest(table).collect()}
    assert got[5] == (33, 30, sha("own start end")) and got[10] == (0, 0, sha(""))


def test_repeated_rows_are_one_document_and_empty_tables_give_none(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    table = spark.createDataFrame([(1, passage), (1, passage), (2, passage)], "doc_id long, text string")
    assert sorted(tuple(r)[:3] for r in substrings.kept_digest(table).collect()) == [(1, 25, 0), (1, 25, 0), (2, 25, 25)]
    assert substrings.kept_digest(table.limit(0)).count() == 0 and substrings.cut_repeats(table.limit(0)).count() == 0


def test_many_settling_rounds_agree(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HELD", 10)
    docs = texts(77, 60)
    found = {r.doc_id: r.n_removed for r in substrings.kept_digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), 6).collect()}
    assert found == {d: sum(g) for d, g in covered(docs, 6).items()}


def test_components_of_random_links(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(100)] + [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 380)] + [(7, 7), (1, None), (1, None)]
    nodes = sorted({x for a, b in links if None not in (a, b) and a != b for x in (a, b)})
    pairs = {frozenset(x) for x in links}
    want = roots(nodes, lambda a, b: frozenset((a, b)) in pairs)
    assert {r.node: r.root for r in graph.components(spark.createDataFrame(links, "x long, y long")).collect()} == want
    assert graph.components(spark.createDataFrame([], "x long, y long")).count() == 0


@pytest.mark.parametrize("part", [simhash.PART, 7])
def test_linked_prints_have_the_components_of_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(part)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = {0, (1 << 64) - 1, *base}
    for p in base:
        for _ in range(12):
            q = p
            for b in rng.sample(range(64), rng.randint(1, 7)):
                q ^= 1 << b
            prints.add(q)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    table = spark.createDataFrame([(x,) for x in signed.values()], "print long")
    got = {r.node: r.root for r in graph.components(simhash.links(table)).collect()}
    nodes = sorted(prints)
    want = roots(nodes, near)
    same = lambda key: {frozenset(n for n in nodes if key(n) == key(m)) for m in nodes}
    assert same(lambda n: got.get(signed[n], signed[n])) == same(lambda n: want[n])


def test_near_duplicates_of_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(9000, docs[5][1]), (9001, docs[5][1].upper()), (9002, None), (9003, ""), (9004, " \t"), (9005, "two words"), (9006, "two  words")]
    rows = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.component_digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    prints = {d: fingerprint(t) for d, t in docs}
    assert {d: x[0] for d, x in rows.items()} == prints
    want = roots(sorted(prints), lambda a, b: near(prints[a], prints[b]))
    assert {d: x[1] for d, x in rows.items()} == want


def test_one_of_each_group_stays_with_all_columns(spark):
    docs = [(4, "a b c d e", 1), (2, "A b c d e", 2), (2, "A b c d e", 2), (7, None, 3), (8, "", 4), (None, "a b c d e", 5), (9, "quite another text with words", 6)]
    table = spark.createDataFrame(docs, "doc_id long, text string, component_id int")
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(r.component_id for r in kept.collect()) == [2, 3, 5, 6]
    assert simhash.keep_one(table.limit(0)).count() == 0 and simhash.component_digest(table.limit(0)).count() == 0


def test_columns_of_any_name_stay(spark):
    """Names that the operators use on the way are those of a table's own columns as well."""
    names = ["__id", "__spans", "__found", "__doc_id", "__n", "__least", "__words", "__lead", "__hits", "__grams", "__features", "__raw", "__probability", "__predicted", "row", "c0"]
    passage = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"first {passage} MIT license", *["a"] * len(names)), (2, f"second, then {passage} and more", *["b"] * len(names))], ["doc_id", "text", *names])
    cut = substrings.cut_repeats(docs).orderBy("doc_id").collect()
    assert cut[1].text == "second, then  and more" and [list(r[2:]) for r in cut] == [["a"] * len(names), ["b"] * len(names)]
    assert simhash.keep_one(docs).columns == docs.columns and simhash.keep_one(docs.unionByName(docs)).count() == 2
    found = licences.scan(docs).orderBy("doc_id").collect()
    assert found[0]["__words"] == "a" and found[1]["__hits"] == "b" and found[0].places[0].label == "mit"
    model = urls.train(spark.createDataFrame([("http://a.com/", 1.0), ("http://b.org/x", 0.0)], "url string, blocked double"))
    judged = urls.judge(docs.withColumn("url", docs.text), model).collect()
    assert {r["__raw"] for r in judged} == {"a", "b"} and judged[0].verdict in ("allow", "block")
