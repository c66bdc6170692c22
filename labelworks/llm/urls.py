"""URL filter: rules by host and path, and for the rest a logistic regression on hashed
character n-grams of host and path, trained from a small labelled URL table. Native
throughout: expressions and ``pyspark.ml`` stages, no shuffle of the judged table."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.llm.columns import under_numbers

Rule = tuple[str, str, str]  # allow or block, host, path
MOST_RULES = 1000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest rule that fits the host or a parent
    domain and begins the path; null if none does. Of equally long rules the first fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own, start in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        name, verdict = F.when(fits, own + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _runs(mark: str, framed: Column, n: int) -> Column:
    """Every run of n characters, with a mark before it; none in a shorter text."""
    starts = F.sequence(F.lit(1), F.length(framed) - n + 1)
    runs = F.transform(starts, lambda at: F.concat(F.lit(mark), F.substr(framed, at, F.lit(n))))
    return F.when(F.length(framed) >= n, runs).otherwise(F.array().cast("array<string>"))


def _grams(mark: str, text: Column, sizes: Sequence[int]) -> Column:
    framed = F.concat(F.lit("^"), text, F.lit("$"))
    return F.concat(*[_runs(mark, framed, n) for n in sizes])


def _features(table: DataFrame, sizes: Sequence[int]) -> DataFrame:
    return table.withColumn("__grams", F.concat(_grams("h:", F.col("host"), sizes), _grams("p:", F.col("path"), sizes)))


def train(labelled: DataFrame, sizes: Sequence[int] = (3, 4, 5), buckets: int = 1 << 18, penalty: float = 0.001) -> PipelineModel:
    """A model of ``url string, blocked double`` rows (1 blocked, 0 allowed); rows without label are left out.
    Grams are 0 or 1 and not scaled, so that rare ones weigh no more than common ones."""
    table = labelled.where(F.col("blocked").isNotNull()).select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("blocked").cast("double"))
    hashing = HashingTF(inputCol="__grams", outputCol="__features", numFeatures=buckets, binary=True)
    regression = LogisticRegression(featuresCol="__features", labelCol="blocked", regParam=penalty, standardization=False, rawPredictionCol="__raw", probabilityCol="__probability", predictionCol="__predicted")
    return PipelineModel([hashing, regression.fit(hashing.transform(_features(table, sizes)))])


def judge(urls: DataFrame, model: PipelineModel, rules: Sequence[Rule] = (), url_col: str = "url", sizes: Sequence[int] = (3, 4, 5), limit: float = 0.5) -> DataFrame:
    """The table with ``host, path, rule, verdict, score`` (probability of block) added;
    columns of these names are replaced. Null urls and urls without ``://`` have an empty
    host and path and are judged by the model like any other."""
    added = ("host", "path", "rule", "verdict", "score")
    rest = urls.drop(*[c for c in added if c != url_col])
    table, back = under_numbers(rest, ())
    url = F.col(table.columns[rest.columns.index(url_col)])
    parsed = table.withColumns({"host": host_of(url), "path": path_of(url)})
    rule, fixed = matching_rule(F.col("host"), F.col("path"), rules)
    scored = model.transform(_features(parsed, sizes)).withColumn("score", vector_to_array("__probability")[1])
    learnt = F.when(F.col("score") >= limit, "block").otherwise("allow")
    return back(scored.withColumns({"rule": rule, "verdict": F.coalesce(fixed, learnt)}), *[c for c in added if c != url_col])


#: Words of unwanted sites by topic, and of ordinary ones.
UNWANTED = (
    "casino poker slots slot bet betting gamble gambling bingo roulette jackpot blackjack lottery wager sportsbook",
    "viagra cialis pills pharmacy meds rx drugstore xanax tramadol",
    "porn xxx sex escort escorts nude cams webcam milf hentai adult hookup",
    "torrent torrents warez crack cracked keygen serials nulled pirate",
    "malware trojan phishing spyware exploit botnet stealer",
    "prize winner giveaway payday loans freecash crypto-doubler clickbank popunder adserver adclick traffic-exchange",
)
ORDINARY = (
    "news times herald daily gazette journal press tribune radio",
    "wiki encyclopedia library archive museum history books reading poetry",
    "university college school academy institute research science physics biology math",
    "docs developer code python java linux github overflow stack forum questions answers software",
    "garden recipes cooking travel weather music sport football health family kids art photo film",
    "city town council government court police transit rail airport hospital charity church",
    "shop store market bakery hotel cafe bank insurance engineering electric bikes",
)
#: Further words that both kinds of hosts are made of.
COMMON = "online best my the top free world web site club zone hub daily online24 plus pro home net group info city one first club365 life"
ENDS = "com org net info io co.uk de fr es ru biz tv edu gov eu"
PLAIN_PATHS = ("", "/", "/index.html", "/about", "/contact", "/en/", "/de/", "/fr/", "/es/", "/home", "/page/2", "/index.php")


def example_urls(spark: SparkSession, rows: int = 3000, seed: int = 6) -> DataFrame:
    """A small table ``url, blocked`` of ``rows`` urls, each with a host of its own: sites of
    unwanted and of ordinary topics, ordinary sites with an unwanted page, and sites whose
    name says nothing. Hosts and paths are put together from the word lists above and from
    drawn syllables, in the shapes that such urls have."""
    rng = random.Random(seed)
    unwanted, ordinary, common, ends = ([w for line in lines for w in line.split()] for lines in (UNWANTED, ORDINARY, (COMMON,), (ENDS,)))
    syllables = "an er in on re th es la de sch ung que ti to na mo ka li vo ar el".split()
    name = lambda: "".join(rng.choices(syllables, k=rng.randint(2, 4)))
    number = lambda: str(rng.choice([rng.randint(1, 99), rng.randint(100, 99999), 24, 247, 365, 777]))
    slug = lambda words: "-".join(rng.choice([rng.choice(words), rng.choice(common), name()]) for _ in range(rng.randint(1, 4)))

    def host(word: str) -> str:
        stem = rng.choice([word, f"{word}{number()}", f"{word}-{rng.choice(common)}", f"{rng.choice(common)}-{word}", f"{rng.choice(common)}{word}", f"{word}{rng.choice(common)}", f"{name()}{word}", f"{word}-{name()}", f"{name()}-{word}-{rng.choice(common)}"])
        return rng.choice(["", "", "www.", "www.", "m.", f"{rng.choice(['blog', 'en', 'shop', 'forum', 'news', name()])}."]) + f"{stem}.{rng.choice(ends)}"

    def plain_path() -> str:
        return rng.choice(
            [
                rng.choice(PLAIN_PATHS),
                f"/{rng.choice(['en', 'de', 'fr', 'es', 'it'])}/{number()}{rng.choice(['', '/', '.html'])}",
                f"/{rng.choice(['article', 'story', 'post', 'item', 'p', 'wiki', 'docs', 'questions', 'category', 'product'])}/{rng.choice([number(), slug(ordinary), name()])}",
                f"/20{rng.randint(10, 24)}/{rng.randint(1, 12):02d}/{slug(ordinary)}{rng.choice(['', '/', '.html'])}",
                f"/questions/{number()}/how-to-{slug(ordinary)}-in-{rng.choice(ordinary)}",
                f"/{name()}/{slug(ordinary)}",
            ]
        )

    def unwanted_path() -> str:
        word = rng.choice(unwanted)
        return rng.choice([f"/{word}", f"/{word}/{slug(unwanted)}", f"/{slug(unwanted)}-{word}", f"/cheap-{word}", f"/free-{word}-{name()}", f"/{word}/{name()}.{rng.choice(['exe', 'zip', 'html'])}", f"/buy-{word}-{rng.choice(common)}", f"/download/{word}-{number()}.exe"])

    made: dict[str, tuple[str, float]] = {}
    while len(made) < rows:
        kind = rng.random()
        if kind < 0.38:
            own, path, blocked = host(rng.choice(unwanted)), rng.choice([plain_path, unwanted_path])(), 1.0
        elif kind < 0.48:
            own, path, blocked = host(rng.choice([rng.choice(ordinary), name()])), unwanted_path(), 1.0
        elif kind < 0.8:
            own, path, blocked = host(rng.choice(ordinary)), plain_path(), 0.0
        else:
            own, path, blocked = rng.choice([host(name()), f"{rng.choice(['www', 'm', 'blog', name()])}.{name()}.example.{rng.choice(['com', 'org', 'net'])}"]), plain_path(), 0.0
        made.setdefault(own, (f"{rng.choice(['https', 'https', 'http'])}://{own}{path}", blocked))
    return spark.createDataFrame(list(made.values()), "url string, blocked double")
