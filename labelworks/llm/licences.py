"""Licence scan with a positional index of rare words, in DataFrame functions only.

Words are weighed by inverse document frequency over all documents. A template is either a
short phrase that names a licence or the opening of a licence text. An opening is posted
under its ``RARE`` rarest words with their positions in it; a document's words among those
are looked up, and where at least ``AGREE`` of them say that the opening starts at one and
the same place, its mandatory key phrase is verified there, word for word. Other words may
differ (names, years, a changed clause). A phrase is posted in the same way under its rarest
word and is its own key phrase: all its places are found.

At scale: one pass that counts the few template words, one that scans; rows are judged
alone, without a shuffle or a join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelworks.llm.columns import under_numbers

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    phrase: str
    label: str
    base: bool = False


BASE = (
    Template("gnu general public license", "gpl", True),
    Template("apache license", "apache", True),
    Template("cc by", "cc-by", True),
    Template("mit license", "mit", True),
)
FURTHER = (
    Template("gnu general public license version 2", "gpl-2"),
    Template("gnu general public license version 3", "gpl-3"),
    Template("gnu lesser general public license", "lgpl"),
    Template("gnu affero general public license", "agpl"),
    Template("apache license version 2 0", "apache-2.0"),
    Template("cc by sa", "cc-by-sa"),
    Template("cc by nc", "cc-by-nc"),
    Template("cc by nd", "cc-by-nd"),
    Template("mozilla public license", "mpl"),
    Template("eclipse public license", "epl"),
    Template("redistribution and use in source and binary forms", "bsd"),
    Template("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    Template("all rights reserved", "all-rights-reserved"),
)


@dataclass(frozen=True)
class Opening:
    """The first words of a licence text, and the phrase in it without which it is not that licence."""

    label: str
    text: str
    key: str


#: Openings of public licence texts and notices, as words.
OPENINGS = (
    Opening(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
        "permission is hereby granted free of charge",
    ),
    Opening(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "you may not use this file except in compliance with the license",
    ),
    Opening(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
        "you can redistribute it and or modify it under the terms of the gnu general public license",
    ),
    Opening(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
        "under the terms of the gnu lesser general public license",
    ),
    Opening(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        "redistribution and use in source and binary forms",
    ),
    Opening(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
        "for any purpose with or without fee is hereby granted",
    ),
    Opening(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
        "subject to the terms of the mozilla public license",
    ),
    Opening(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        "free and unencumbered software released into the public domain",
    ),
)
# Words that an opening is posted under, and how many of them must agree on its start.
RARE, AGREE = 6, 4


def word_list(text: Column) -> Column:
    """Words of the lower-cased text; the first or last may be empty where a break stands there."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), F.lit(BREAK), -1)


def word_weights(docs: DataFrame, words: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency, over all documents, of a fixed list of words."""
    own = F.array_distinct(F.filter("words", lambda w: w.isin(list(words))))
    counts = docs.select(word_list(F.col("text")).alias("words")).select(F.explode(F.concat(F.array(F.lit("")), own)).alias("word")).groupBy("word").count()
    found = {row["word"]: row["count"] for row in counts.collect()}  # at most one row for each listed word
    total = found.get("", 0)
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) + 1 for w in words}


def _postings(templates: Sequence[Template], weights: dict[str, float], heaviest: float) -> dict[str, list[Column]]:
    """By rarest word: the template, where that word and the second rarest stand in it, and its weight."""
    mass = [sum(weights[w] for w in t.phrase.split()) for t in templates]
    out: dict[str, list[Column]] = {}
    for t, own in zip(templates, mass, strict=True):
        phrase = t.phrase.split()
        by_weight = sorted(range(len(phrase)), key=lambda i: (-weights[phrase[i]], i))
        key, second = by_weight[0], by_weight[min(1, len(phrase) - 1)]
        # a word that stands twice in the phrase is posted at its first place only: one candidate a place
        posting = F.struct(
            F.lit(phrase.index(phrase[key])).alias("at"), F.lit(second).alias("second"), F.lit(phrase[second]).alias("word"), F.array(*map(F.lit, phrase)).alias("phrase"),
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(own / heaviest).alias("weight"),
        )
        out.setdefault(phrase[key], []).append(posting)
    return out


def _rarest(opening: Opening, weights: dict[str, float]) -> list[tuple[str, int]]:
    """The rarest different words of an opening with their first places."""
    words = opening.text.split()
    first = {w: i for i, w in reversed(list(enumerate(words)))}
    return sorted(first.items(), key=lambda x: (-weights[x[0]], x[1]))[:RARE]


def _key_place(opening: Opening) -> int:
    words, key = opening.text.split(), opening.key.split()
    return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


def _openings(openings: Sequence[Opening], weights: dict[str, float], heaviest: float) -> tuple[list[Column], dict[str, list[tuple[int, int]]]]:
    """What is verified of each opening, and for each posted word (opening, place in it)."""
    facts, posted = [], {}
    for n, o in enumerate(openings):
        rare = _rarest(o, weights)
        for word, at in rare:
            posted.setdefault(word, []).append((n, at))
        facts.append(
            F.struct(
                F.array(*[F.struct(F.lit(w).alias("word"), F.lit(at).alias("at"), F.lit(weights[w] / heaviest).alias("weight")) for w, at in rare]).alias("rare"),
                F.array(*map(F.lit, o.key.split())).alias("key"),
                F.lit(_key_place(o)).alias("key_at"),
                F.lit(o.label).alias("label"),
            )
        )
    return facts, posted


def _masses(templates: Sequence[Template], openings: Sequence[Opening], weights: dict[str, float]) -> list[float]:
    return [*[sum(weights[w] for w in t.phrase.split()) for t in templates], *[sum(weights[w] for w, _ in _rarest(o, weights)) for o in openings]]


def scan(docs: DataFrame, templates: Sequence[Template] = BASE + FURTHER, openings: Sequence[Opening] = OPENINGS) -> DataFrame:
    """The table with ``n_words long, places array<struct<start int, label string, base
    boolean, weight double>>`` added: every place of every phrase and opening, words from
    zero; an opening whose first words are cut off starts before zero. Its weight is that of
    the rare words that agree. Null texts have no words and no places; columns of the added
    names are replaced, all others stay as they are."""
    docs, back = under_numbers(docs.drop("n_words", "places"), ("text",))
    vocabulary = sorted({w for t in templates for w in t.phrase.split()} | {w for o in openings for w in o.text.split()})
    weights = word_weights(docs, vocabulary)
    heaviest = max(_masses(templates, openings, weights))
    postings = _postings(templates, weights, heaviest)
    facts, posted = _openings(openings, weights, heaviest)
    index = F.create_map(*[x for word, found in postings.items() for x in (F.lit(word), F.array(*found))])
    split = docs.withColumn("__words", word_list(F.col("text")))
    lead = F.when(F.col("__words")[0] == "", 1).otherwise(0)
    tail = F.when(F.element_at("__words", -1) == "", 1).otherwise(0)
    counted = split.withColumn("__lead", lead).withColumn("n_words", F.greatest(F.size("__words") - lead - tail, F.lit(0)).cast("long"))
    marked = F.transform("__words", lambda w, i: F.when(w.isin(sorted({*postings, *posted})), F.struct(w.alias("word"), i.alias("i"))))
    hits = counted.withColumn("__hits", F.filter(marked, lambda h: h.isNotNull()))
    words, size = F.col("__words"), F.size("__words")

    def verified(hit: Column) -> Column:
        def place(p: Column) -> Column:
            start = hit["i"] - p["at"]
            inside = (start >= 0) & (start + F.size(p["phrase"]) <= size)
            agree = F.when(inside, F.get(words, start + p["second"]) == p["word"]).otherwise(False)
            whole = F.when(agree, F.slice(words, F.greatest(start, F.lit(0)) + 1, F.size(p["phrase"])) == p["phrase"]).otherwise(False)
            return F.when(whole, F.struct((start - F.col("__lead")).alias("start"), p["label"].alias("label"), p["base"].alias("base"), p["weight"].alias("weight")))

        none = F.array().cast("array<struct<start:int,label:string,base:boolean,weight:double>>")
        return F.coalesce(F.filter(F.transform(F.element_at(index, hit["word"]), place), lambda x: x.isNotNull()), none)

    phrases = F.flatten(F.transform("__hits", verified))
    if not openings:
        return back(hits.withColumn("places", phrases), "n_words", "places")
    pairs = F.create_map(*[x for word, found in posted.items() for x in (F.lit(word), F.array(*[F.struct(F.lit(n).alias("n"), F.lit(at).alias("at")) for n, at in found]))])
    known = F.array(*facts)

    def said(hit: Column) -> Column:
        """Where the openings would start that the word is posted for."""
        here = F.element_at(pairs, hit["word"])
        return F.coalesce(F.transform(here, lambda p: F.struct(p["n"].alias("n"), (hit["i"] - p["at"]).alias("start"))), F.array().cast("array<struct<n:int,start:int>>"))

    def opened(said: Column) -> Column:
        fact = F.get(known, said["n"])
        agreeing = F.filter(fact["rare"], lambda r: F.get(words, said["start"] + r["at"]) == r["word"])
        at = said["start"] + fact["key_at"]
        inside = (F.size(agreeing) >= AGREE) & (at >= 0) & (at + F.size(fact["key"]) <= size)
        whole = F.when(inside, F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(fact["key"])) == fact["key"]).otherwise(False)
        weight = F.aggregate(agreeing, F.lit(0.0), lambda t, r: t + r["weight"])
        return F.when(whole, F.struct((said["start"] - F.col("__lead")).alias("start"), fact["label"].alias("label"), F.lit(False).alias("base"), weight.alias("weight")))

    starts = F.array_distinct(F.flatten(F.transform("__hits", said)))
    texts = F.filter(F.transform(starts, opened), lambda x: x.isNotNull())
    return back(hits.withColumn("places", F.concat(phrases, texts)), "n_words", "places")


def licence_digest(docs: DataFrame, templates: Sequence[Template] = BASE + FURTHER, openings: Sequence[Opening] = OPENINGS) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``; the
    score is the weight of the heaviest template found, 1 for the heaviest of all, 0 for none."""
    found = scan(docs.select("doc_id", "text"), templates, openings)
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform("base", lambda p: p["start"])
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda p: p["label"]))), ",")
    weight = F.coalesce(F.array_max(F.transform("places", lambda p: p["weight"])), F.lit(0.0))
    return found.select("doc_id", "n_words", "places", base.alias("base")).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        names("base").alias("base_labels"), names("places").alias("labels"), weight.alias("score"),
    )
