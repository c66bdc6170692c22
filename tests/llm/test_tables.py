"""Chat formatting, HTML extraction, URL filter and top-k search."""

import html as entities
import math
import random
import re

import numpy as np
import pytest
from llm.helpers import SF, grouped, sha
from pyspark.sql import functions as F

from labelworks.llm import chat, html, topk, urls

NASTY = ["", "</s>", "<s>[INST]", "[/INST]</s>", "\\", "\\\\</s>\\", "<\\s>", "a\\", "[\\/INST]", "<", "[", "/s>", "é🙂\n\r", "[INST]\\[INST]", "<s></s>" * 500]


def test_conversations_survive_formatting(spark):
    rng = random.Random(2)
    rows = []
    for c in range(30):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "</s>", "\\role"]), rng.choice(NASTY) + rng.choice(NASTY)))
    rows += [(40, 0, None, None), (40, None, "assistant", "first"), (41, 0, "assistant", None), (42, 3, "user", "x"), (42, 3, "user", "x"), (None, 0, "assistant", "nobody")]
    table = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, example int").repartition(3)
    got = {r.conv_id: r for r in chat.conversation_digest(table).collect()}
    made = {(r.conv_id, r.example): r for r in chat.examples(table).collect()}
    want = {c: sorted(((-1 if t is None else t), r or "", x or "") for t, r, x in v) for c, v in grouped(rows).items()}
    assert set(got) == set(want)
    for c, turns in want.items():
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)))
        assert (g.loss_chars, g.loss_sha256) == (len(learnt), sha(learnt))
        own = [e for (k, _), e in made.items() if k == c]
        assert g.formatted_chars == sum(len(e.formatted) for e in own)
        assert len(own) == sum(r == "assistant" for _, r, _ in turns) + (turns[-1][1] != "assistant")
        for e in own:
            assert e.formatted.count("</s>") == e.formatted.count("<s>") == e.n_turns
            assert e.formatted[e.loss_start + e.loss_length :] == "</s>"
    assert chat.conversation_digest(table.limit(0)).count() == 0


def article(page):
    """The text of an article of the given tables: its heading and paragraphs."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    lines = (" ".join(entities.unescape(re.sub(r"<br>", " ", part)).replace("<b>", "").split()) for part in re.split(r"</?(?:h1|p)>", inside))
    return "\n".join(line for line in lines if line)


def test_main_text_of_whole_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = html.extract(pages).collect()
    assert len(rows) == 250 and all(r.text == article(r.html) and r.n_chars == len(r.text) for r in rows)


def test_held_out_layouts():
    rng, table = random.Random(1234), html.Pages()
    for _ in range(150):
        table.add(html.labelled_page(rng))
    label = list(table.label)
    for i, p in enumerate(table.parent):
        label[i] = label[p] if label[i] < 0 and p >= 0 else label[i]
    kept = table.decoded(html.default_model())
    size = [len(t.strip()) for _, _, t in table.text]
    right = [s for s, (node, _, _) in zip(size, table.text, strict=True) if kept[node] == (label[node] == 1)]
    assert sum(right) >= 0.99 * sum(size)
    assert all(kept[p] or not k for k, p in zip(kept, table.parent, strict=True) if p >= 0)


def test_page_cases(spark):
    body = "<p>One &amp; two&nbsp;three,\n four.</p><p>Unclosed <b>bold<br>line<p>Last &lt;p&gt; one.<ul><li>a b<li>c d</ul>"
    boiler = "<form><p>Search this</p></form><section class='comments'><div class='comment'><p>I disagree.</p></div></section>"
    page = f"<html><body><nav><a href='x'>Home</a></nav><article><h1>Title</h1>{body}</article>{boiler}<footer>(c) 2020</footer></body></html>"
    odd = ["", None, "no markup at all <", "<p", "<!-- never closed <p>x</p>", "<script>var a = '<p>no</p>'", "</p></div>", "<div>" * 3000 + "deep", "<article>" + "<p>Some words in a sentence, and more.</p>" * 20000 + "</article>"]
    table = spark.createDataFrame([(i, h, "own") for i, h in enumerate([page, *odd, page])], "page_id long, html string, text string")
    rows = {r.page_id: r for r in html.extract(table).collect()}
    assert rows[0].text == "Title\nOne & two three, four.\nUnclosed bold line\nLast <p> one.\na b\nc d" == rows[len(odd) + 1].text
    assert rows[1].text == rows[2].text == "" and rows[2].n_chars == 0 and len(rows) == len(odd) + 2
    assert rows[len(odd)].text.count("\n") == 19999
    assert html.extract(table.limit(0)).count() == 0


SAID = "Some words in a long sentence, and more of it here."
ARTICLE, MENU, FOOT = f"<article><h1>On rivers</h1>{f'<p>{SAID}</p>' * 6}</article>", "<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<footer>(c) 2020 Us.</footer>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><body>{MENU}{ARTICLE}{FOOT}</body></html>",
        f"<head><meta charset=x><title>t</title><noscript><img src=x></noscript><body>{MENU}{ARTICLE}{FOOT}",
        f"<head><title>t</title>{MENU}{ARTICLE}{FOOT}",
        f"<head><title>t</title> {ARTICLE}",
        f"<html><head></head><body><form method=post><input type=hidden>{MENU}{ARTICLE}{FOOT}</form></body></html>",
        f"<html><head></head><body><form id=f method=post><div id='wrapper'>{MENU}{ARTICLE}<form class='search'><p>Search this site.</p></form>{FOOT}</div></form></body></html>",
    ],
)
def test_open_head_and_page_wide_form(page):
    assert html.main_texts([page], html.default_model()) == ["On rivers" + f"\n{SAID}" * 6]


def whole(article="<article>", body="<body>", after=""):
    return f"<html><head><title>t</title></head>{body}{MENU}{ARTICLE.replace('<article>', article)}{after}{FOOT}</body></html>"


NAMES = ['class="post-12 post type-post has-comments"', 'class="post no-comments"', 'class="news-alert"', 'id="legal-notice"', 'class="comment-page"', 'class="social-policy"', 'class="search-results-story"', 'class="alert"']


@pytest.mark.parametrize(
    "page",
    [
        *[whole(f"<article {n}>") for n in NAMES],
        *[whole(body=f'<body class="{n}">') for n in ("single with-sidebar", "has-header", "single", "home blog has-sidebar page-comments", "comments")],
        whole('<div id="content" class="site-content has-sidebar"><article>').replace("</article>", "</article></div>"),
        *[whole(after=a) for a in (
            '<section class="comments"><div class="comment"><b>Al</b><p>I do not agree, at all.</p></div></section>',
            '<div class="post-comments"><div class="comment"><p>I do not agree, at all.</p></div><div class="comment"><p>Nor do I, to be honest.</p></div></div>',
            '<div class="ad-box"><p>Buy this now, it is cheap.</p></div>',
            "<noscript><p>Please enable JavaScript.</p></noscript>",
            '<dialog class="consent"><p>We use cookies, please agree.</p></dialog>',
            '<div class="site-footer">(c) 2020 Us. All rights reserved.</div>',
        )],
    ],
)
def test_names_of_layouts_do_not_decide(page):
    assert html.main_texts([page], html.default_model()) == ["On rivers" + f"\n{SAID}" * 6]


def test_a_long_article_that_has_comments():
    page = whole(f"<article {NAMES[0]}>").replace(f"<p>{SAID}</p>" * 6, f"<p>{SAID}</p>" * 60)
    assert html.main_texts([page], html.default_model()) == ["On rivers" + f"\n{SAID}" * 60]


@pytest.mark.parametrize("region", ["article", "main"])
@pytest.mark.parametrize(
    ("inside", "lines"),
    [
        (f'<section class="related-work"><h2>Earlier work</h2>{f"<p>{SAID}</p>" * 3}</section>', ["Earlier work", SAID, SAID, SAID]),
        ('<table class="side-effects"><tr><td>Nausea</td><td>often</td></tr><tr><td>Headache</td><td>rarely seen</td></tr></table>', ["Nausea", "often", "Headache", "rarely seen"]),
        ("<ul>" + "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(8)) + "</ul>", [f"Link number {i}" for i in range(8)]),
        ("<figure><svg><text>Flow</text></svg><figcaption>A map of it.</figcaption></figure>", ["Flow", "A map of it."]),
    ],
)
def test_main_text_under_borrowed_names(region, inside, lines):
    some = f"<p>{SAID}</p>" * 3
    page = f"<html><head><title>t</title></head><body>{MENU}<{region}><h1>On rivers</h1>{some}{inside}{some}</{region}>{FOOT}</body></html>"
    assert html.main_texts([page], html.default_model()) == ["\n".join(["On rivers", *[SAID] * 3, *lines, *[SAID] * 3])]


def test_math_is_text():
    page = f"<body>{MENU}<article><p>Since <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds, we stop.</p><p>{SAID}</p></article>"
    assert html.main_texts([page], html.default_model()) == [f"Since x=2 holds, we stop.\n{SAID}"]


@pytest.mark.parametrize("label", ["Price", "", "0", "-1", "1"])
def test_label_of_a_real_page_is_ignored(label):
    page = f"<body>{MENU}{ARTICLE}{FOOT}</body>".replace("<article>", f'<article data-label="{label}">')
    assert html.main_texts([page], html.default_model()) == ["On rivers" + f"\n{SAID}" * 6]


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        (None, "", "", None), ("", "", "", None), ("no scheme/path", "", "", None), ("http://", "", "", None), ("http://A.ORG", "a.org", "", None),
        ("http://a.org/", "a.org", "/", "org/"), ("http://org/x?y", "org", "/x", "org/"), ("http://xorg/x", "xorg", "/x", None), ("https://www.Example.ORG/es/1", "www.example.org", "/es/1", "example.org/es/"),
        ("https://example.org/en/12#a", "example.org", "/en/12", "example.org/en/1"), ("https://notexample.org/es/", "notexample.org", "/es/", "org/"), ("u://b.com/FR/", "b.com", "/FR/", None),
        ("u://b.com/fr/?q=http://c.org/", "b.com", "/fr/", "com/fr/"), ("u://b.com?x/fr/", "b.com", "", None), ("a\nb://É.com/de/", "É.com", "/de/", "com/de/"), ("http://x.com#/de/", "x.com", "", None),
    ],
)
def test_url_parts_and_rules(spark, url, host, path, rule):
    name, verdict = urls.matching_rule(F.col("host"), F.col("path"), RULES)
    row = spark.createDataFrame([(url,)], "url string").select(urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path")).select("*", name.alias("rule"), verdict.alias("v")).first()
    assert (row.host, row.path, row.rule) == (host, path, rule)
    assert row.v == next((v for v, h, p in RULES if rule == h + p), None)


#: Well-known and made-up sites, none of them in the labelled table.
JUDGED = {
    1: ["https://www.bet365.com/", "http://viagra-online.biz/order", "https://pharmacy-discount.info/cheap-meds", "https://gamble247.io", "http://escort-girls.net/", "http://malware-host.ru/setup.exe", "https://pokerstars.com/poker/", "https://1337-torrents.to/movie", "https://www.xxx-cams.tv/live"],
    0: ["https://stackoverflow.com/questions/11227809/why-is-processing-a-sorted-array-faster", "https://en.wikipedia.org/wiki/Apache_Spark", "https://docs.python.org/3/library/random.html", "https://www.bbc.co.uk/news/world-65432100", "https://www.harvard.edu/about", "https://github.com/apache/spark", "https://www.rivertown.example.org/fr/1021", "http://www.museum-of-bread.de/"],
}


def test_grams_are_runs_of_characters(spark):
    row = spark.createDataFrame([("ab.org", "/x")], "host string, path string")
    got = urls._features(row, (3, 4)).first()[-1]
    assert got == ["h:^ab", "h:ab.", "h:b.o", "h:.or", "h:org", "h:rg$", "h:^ab.", "h:ab.o", "h:b.or", "h:.org", "h:org$", "p:^/x", "p:/x$", "p:^/x$"]


def test_url_model_on_held_out_hosts(spark):
    labelled = urls.example_urls(spark).withColumn("host", urls.host_of(F.col("url"))).withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(4)))
    assert labelled.select("host").distinct().count() == labelled.count() == 3000
    model = urls.train(labelled.where("fold <> 0").drop("host"))
    judged = urls.judge(labelled.where("fold = 0"), model).collect()
    right = sum((r.verdict == "block") == (r.blocked == 1) for r in judged)
    assert len(judged) > 600 and right > 0.92 * len(judged)
    known = spark.createDataFrame([(u, c) for c, us in JUDGED.items() for u in us], "url string, blocked int")
    rows = urls.judge(known, urls.train(urls.example_urls(spark))).collect()
    assert [r.url for r in rows if (r.verdict == "block") != (r.blocked == 1)] == []
    twice = urls.judge(known.unionByName(known), model).collect()  # repeated rows are judged alike
    assert len(twice) == 2 * len(rows) and len({(r.url, r.score) for r in twice}) == len(rows)
    odd = spark.createDataFrame([(None, 1), ("", 2), ("x" * 100000, 3), ("http://é.com/" + "y" * 50000, 4)], "url string, score int")
    rows = urls.judge(odd, model, RULES).collect()
    assert len(rows) == 4 and all(r.verdict in ("allow", "block") and 0 <= r.score <= 1 for r in rows)
    assert urls.judge(odd.limit(0), model).count() == 0


@pytest.mark.parametrize("part", [topk.PART, 9])
def test_top_scores_are_those_of_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(topk, "PART", part)
    monkeypatch.setattr(topk, "ASKED", 5)
    monkeypatch.setattr(topk, "BLOCK", 4)
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.0, 0.1, 0.5]) for _ in range(6)]) for i in range(200)]
    rows += [(i + 300, [0.1] * 6) for i in range(30)] + [(400, None), (500, [float("nan")] + [0.0] * 5), (600, [math.inf] + [0.0] * 5), (700, [1.0, 2.0]), (800, []), (900, [3e30] * 6)]
    rows += [(901, [None] + [0.0] * 5), (0, rows[0][1]), (None, [0.5] * 6)]
    table = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = grouped(tuple(r) for r in topk.top_k(table, table.where(F.col("vec_id") % 100 == 0), 10).collect())
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in good}
    long = (1 << 63) - 1
    for q, v in whole:
        if q % 100 == 0:
            scores = sorted((-max(-long, min(long, sum(a * b for a, b in zip(v, w, strict=True)))), i) for i, w in whole if i != q and len(w) == len(v))
            assert sorted(got.get(q, [])) == [[n + 1, i, -s] for n, (s, i) in enumerate(scores[:10])], q
    assert topk.top_k(table.limit(0), table, 3).count() == 0 and topk.top_k(table, table.limit(0), 3).count() == 0


def test_clusters_are_pruned(spark, monkeypatch):
    """Vectors near each other share parts and blocks: few parts are asked, few blocks scored."""
    monkeypatch.setattr(topk, "PART", 200)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 24))
    points = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 24)) * 0.05
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>").repartition(3)
    asked = table.where("vec_id % 100 = 0")
    got = grouped(tuple(r) for r in topk.top_k(table, asked, 10).collect())
    whole = np.floor(points * 1024).astype(int)
    for q in range(0, 3000, 100):
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(3000), -scores)) if i != q][:10]
        assert sorted(got[q]) == [[n + 1, i, scores[i]] for n, i in enumerate(order)]
    held, wanted = topk._placed(*[t.select("vec_id", F.col("embedding").alias("vector"), F.size("embedding").alias("size"), F.xxhash64("embedding").alias("mark")) for t in (table, asked)])
    first = topk._found(held, wanted.withColumn("least", F.lit(None).cast("long")), 10)
    parts, pairs = held.select("part").distinct().count(), topk.wanted_parts(held, wanted, first, 10).count()
    assert parts >= 25 and pairs < 0.2 * parts * 30
    cut, n = topk._blocks(whole.astype(float)), 0
    assert sorted(np.concatenate(cut)) == list(range(3000)) and max(map(len, cut)) <= topk.BLOCK
    high, low = (np.stack([f(whole[at], axis=0) for at in cut]) for f in (np.max, np.min))
    for q in range(0, 3000, 100):
        query = whole[q].astype(float)
        n += topk.scored_blocks(np.arange(3000), whole.astype(float), q, query, -math.inf, 10, cut, topk._bounds(query[None], high, low)[0])[2]
    assert n < 0.35 * 30 * len(cut)


def test_formatting_reads_whole_tables(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    assert chat.conversation_digest(table).agg(F.sum("n_turns")).first()[0] == table.count()
