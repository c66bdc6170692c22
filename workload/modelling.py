"""Feature preparation, training, search, explanation and stacking on the driver tables."""

from __future__ import annotations

from functools import partial
from math import prod
from uuid import uuid4

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.functions import scalar as S
from labelworks.operators import evaluate as L
from labelworks.operators import hashed_neighbours as A
from labelworks.operators import neighbours as D
from labelworks.operators import split as P
from labelworks.plans import explain as N
from labelworks.plans import prediction as R
from labelworks.plans import shapley as V
from labelworks.plans import stacking as K
from labelworks.plans import stages as J
from labelworks.plans import training as M
from labelworks.plans import trees as T
from labelworks.plans.classifiers import FourierFeatures, LandmarkFeatures, RidgeClassifier, kernel_error
from labelworks.plans.families import BASELINE_DRAWS, BASELINE_SPACE, FAMILIES, score_table
from labelworks.operators.keep import keep, releases, shared_folder
from labelworks.sources.ledger import Ledger
from labelworks.sources.models import discover_models as discover
from labelworks.sources.models import load_model, save_model
from labelworks.sources.scores import scan_oof as scan
from workload.registry import query
from workload.scoring import _seats
from workload.tables import MODELS, PARTS_SQL, PEOPLE_SQL, TITLE_SQL, WIDE_SQL, folds_sql, people, read, six, wide

# --- the training table: labelled documents in the shape of a passenger list ---

# Missing values follow the key: every seventh row lacks its word count, and every
# fiftieth has a title of its own without any, so that filling it needs the global median.
RIDERS_SQL = """riders AS (
  SELECT doc_id AS row_id, quality AS label, toxic + 1 AS grade,
    concat(source, ', ', CASE WHEN doc_id % 50 = 0 THEN 'xx' ELSE lang END, '. ', doc_id) AS full_name,
    CASE WHEN doc_id % 7 <> 0 AND doc_id % 50 <> 0 THEN CAST(len(string_split(text, ' ')) AS DOUBLE) END AS words,
    len(string_split(text, chr(10))) AS lines, n_chars / len(string_split(text, ' ')) AS density,
    CASE WHEN doc_id % 7 <> 1 THEN concat(upper(lang), '-', source) END AS code, source AS port
  FROM documents JOIN labels USING (doc_id))"""


def riders(spark, sf) -> DataFrame:
    documents, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    words, key = F.size(F.split("text", " ")), F.col("doc_id")
    title = F.when(key % 50 == 0, "xx").otherwise(F.col("lang"))
    return documents.join(labels, "doc_id").select(
        key.alias("row_id"),
        F.col("quality").alias("label"),
        (F.col("toxic") + 1).alias("grade"),
        F.concat("source", F.lit(", "), title, F.lit(". "), key.cast("string")).alias("full_name"),
        F.when((key % 7 != 0) & (key % 50 != 0), words.cast("double")).alias("words"),
        F.size(F.split("text", "\n")).alias("lines"),
        (F.col("n_chars") / words).alias("density"),
        F.when(key % 7 != 1, F.concat(F.upper("lang"), F.lit("-"), "source")).alias("code"),
        F.col("source").alias("port"),
    )


def title_stage() -> J.TitleFeatures:
    return J.TitleFeatures(nameCol="full_name", valueCol="words", codeCol="code", dropCols=["full_name", "code"])


RAW = ["grade", "full_name", "words", "lines", "density", "code", "port"]


def split_riders(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Holdout parts of the training table."""
    return M.holdout(riders(spark, sf))


def prepared(spark, sf) -> M.Prepared:
    return M.prepare(*split_riders(spark, sf), [title_stage()])


# --- what SQL can state about fitted models ---

RIDER_PARTS_SQL = PARTS_SQL.replace("FROM wide", "FROM riders")
RIDERS_WITH = f"WITH {RIDERS_SQL}, {RIDER_PARTS_SQL}"
#: Folds of the training part, as the benchmark makes them.
KNOWN_FOLDS_SQL = "known AS (SELECT row_id, label FROM parts WHERE part = 'train'), " + folds_sql(5).replace("class_counts", "known_counts").replace("wide", "known")
MODELS_SQL = "(VALUES " + ", ".join(f"('{n}')" for n in FAMILIES) + ") names(model)"
#: Families whose score is a decision value; the others give a probability or a share of votes.
MARGINS = ("ridge_classifier", "svc", "linear_svc")
#: Names of the encoded slots, and the sum of each over the training rows.
SLOTS_SQL = f"""coded AS (SELECT {TITLE_SQL} AS title, nullif(substring(code, 1, 1), '') AS cabin_name, port FROM parts WHERE part = 'train'),
slots AS (
  SELECT concat('num__', unnest(['grade', 'words', 'lines', 'density'])) AS feature, CAST(0 AS DOUBLE) AS total UNION ALL
  SELECT concat('cat__title_', title), CAST(count(*) AS DOUBLE) FROM coded GROUP BY title UNION ALL
  SELECT concat('cat__port_', port), CAST(count(*) AS DOUBLE) FROM coded GROUP BY port UNION ALL
  SELECT concat('cat__cabin_name_', initial), CAST(count(*) AS DOUBLE) FROM (SELECT coalesce(cabin_name,
    (SELECT cabin_name FROM coded WHERE cabin_name IS NOT NULL GROUP BY cabin_name ORDER BY count(*) DESC, cabin_name LIMIT 1)) AS initial FROM coded) GROUP BY initial)"""


def sound(scored: DataFrame, *keys: str) -> DataFrame:
    """``keys, model, sound``: the score lies in its range and the decision follows from it."""
    score, said = F.col("score"), F.col("pred") == 1
    share = score.between(0, 1) & ((score > 0.5) == said)
    return scored.select(*keys, "model", F.when(F.col("model").isin(*MARGINS), (score > 0) == said).otherwise(share).alias("sound"))


def benchmark(spark, sf) -> M.Benchmark:
    """All nine families with their defaults over five folds, fitted once until the
    session's kept tables, which it rests on, are released."""
    key = (spark.sparkContext.applicationId, sf, releases(spark))
    if key not in _benchmarks:
        _benchmarks.clear()
        _benchmarks[key] = M.benchmark_models(*split_riders(spark, sf), M.defaults(FAMILIES), [title_stage()])
    return _benchmarks[key]


_benchmarks: dict[tuple[str, str, int], M.Benchmark] = {}


# --- feature preparation ---


@query(
    "title_features",
    f"""WITH {RIDERS_SQL}, {RIDER_PARTS_SQL}, titled AS (SELECT *, {TITLE_SQL} AS title FROM parts),
known AS (SELECT * FROM titled WHERE part = 'train')
SELECT row_id, title, nullif(substring(code, 1, 1), '') AS cabin_name, lines, port,
  round(coalesce(words, (SELECT median(words) FROM known k WHERE k.title = titled.title), (SELECT median(words) FROM known)), 6) AS words
FROM titled WHERE part = 'test'""",
)
def title_features(spark, sf):
    train, test = split_riders(spark, sf)
    out = title_stage().fit(train).transform(test)
    return out.select("row_id", "title", "cabin_name", "lines", "port", six("words"))


@query(
    "impute_median",
    f"WITH {PEOPLE_SQL} SELECT c_custkey, round(coalesce(balance, (SELECT median(balance) FROM people)), 6) AS balance FROM people",
)
def impute_median(spark, sf):
    table = people(spark, sf).select("c_custkey", "balance")
    return J.MedianImputer(inputCols=["balance"]).fit(table).transform(table).select("c_custkey", six("balance"))


@query(
    "standardize",
    """SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders), 6)
AS num__o_totalprice FROM orders""",
)
def standardize(spark, sf):
    table = read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    out = J.PopulationScaler(inputCols=["o_totalprice"]).fit(table).transform(table)
    return out.select("o_orderkey", six("num__o_totalprice"))


@query(
    "impute_mode",
    f"""WITH {PEOPLE_SQL}
SELECT c_custkey, coalesce(code, (SELECT code FROM people WHERE code IS NOT NULL GROUP BY code ORDER BY count(*) DESC, code LIMIT 1)) AS code
FROM people""",
)
def impute_mode(spark, sf):
    table = people(spark, sf).select("c_custkey", "code")
    return J.ModeImputer(inputCols=["code"]).fit(table).transform(table)


def encoded_orders(spark, sf):
    table = read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return J.TabularEncoder(excludeCols=["o_orderkey"]).fit(table), table


ONE_HOT_SQL = ", ".join(f"""CASE WHEN o_orderstatus = '{s}' THEN CAST(1 AS DOUBLE) ELSE 0 END AS "cat__o_orderstatus_{s}" """ for s in "FOP")


@query("one_hot", f"SELECT o_orderkey, {ONE_HOT_SQL} FROM orders")
def one_hot(spark, sf):
    encoder, table = encoded_orders(spark, sf)
    out = J.transformed_frame(encoder, table, ["o_orderkey"])
    return out.drop("num__o_totalprice")


@query(
    "transformed_frame",
    f"""SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
/ (SELECT stddev_pop(o_totalprice) FROM orders), 6) AS num__o_totalprice, {ONE_HOT_SQL} FROM orders""",
)
def transformed_frame(spark, sf):
    encoder, table = encoded_orders(spark, sf)
    out = J.transformed_frame(encoder, table, ["o_orderkey"])
    return out.withColumn("num__o_totalprice", F.round("num__o_totalprice", 6))


@query(
    "assemble",
    """SELECT o_orderkey, 4 AS slots, round(1 + pow((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
/ (SELECT stddev_pop(o_totalprice) FROM orders), 2), 6) AS squared_norm FROM orders""",
)
def assemble(spark, sf):
    encoder, table = encoded_orders(spark, sf)
    values = vector_to_array("features")
    squares = F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)
    return encoder.transform(table).select("o_orderkey", F.size(values).alias("slots"), F.round(squares, 6).alias("squared_norm"))


@query("build_pipeline", f"{RIDERS_WITH} SELECT row_id, label, 'logistic_regression' AS model, TRUE AS sound FROM parts WHERE part = 'test'")
def build_pipeline(spark, sf):
    train, test = split_riders(spark, sf)
    family = FAMILIES["logistic_regression"]
    pipeline = J.build_pipeline(family.estimator({}, train.count()), title_stage(), M.NO_FEATURES)
    model = pipeline.fit(train)
    good = beats_chance(score_table(model, train, family.name, ["row_id", "label"]))
    return sound(score_table(model, test, family.name, ["row_id", "label"]), "row_id", "label").withColumn("sound", F.col("sound") & F.lit(good))


@query("feature_names", f"{RIDERS_WITH}, {SLOTS_SQL} SELECT feature, total FROM slots")
def feature_names(spark, sf):
    split = prepared(spark, sf)
    sums = split.train.select(F.posexplode(vector_to_array("features")).alias("slot", "value"))
    texts = F.array(*[F.lit(n) for n in J.feature_names(split.train)])
    named = sums.select(F.get(texts, F.col("slot")).alias("feature"), "value")
    return named.groupBy("feature").agg((F.round(F.sum("value"), 6) + F.lit(0.0)).alias("total"))


FIT_ROWS = 1000


@query(
    "fitting_sample",
    f"""WITH {WIDE_SQL}, classes AS (SELECT label, count(*) AS n, least(count(*), {FIT_ROWS} // (2 * count(*) OVER ())) AS alike FROM wide WHERE label IS NOT NULL GROUP BY label),
takes AS (SELECT label, n, alike + least(n - alike, CAST(floor((n - alike) * ({FIT_ROWS} - sum(alike) OVER ()) / sum(n - alike) OVER ()) AS BIGINT)) AS take FROM classes),
ordered AS (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat('42|', row_id)), row_id) AS place FROM wide)
SELECT row_id, label, round(n / take, 6) AS fit_weight FROM ordered JOIN takes USING (label) WHERE place <= take""",
)
def fitting_sample(spark, sf):
    return P.fitting_sample(wide(spark, sf), "label", "row_id", FIT_ROWS).select("row_id", "label", six("fit_weight"))


# --- neighbours ---


def embedded_parts(spark, sf):
    table = read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), "embedding", F.when(F.col("label") < 5, 1).otherwise(0).alias("label")
    )
    parts = keep(P.stratified_split(table, "label", "row_id"))
    return parts.where(F.col("part") == "test"), parts.where(F.col("part") == "train")


NEAR_SQL = f"""vectors AS (SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS embedding, CASE WHEN label < 5 THEN 1 ELSE 0 END AS label
  FROM embeddings), {PARTS_SQL.replace('FROM wide', 'FROM vectors')},
near AS (SELECT q.row_id AS query_id, t.row_id AS train_id, t.label, round(list_distance(q.embedding, t.embedding), 6) AS distance
  FROM parts q, parts t WHERE q.part = 'test' AND t.part = 'train'
  QUALIFY row_number() OVER (PARTITION BY q.row_id ORDER BY round(list_distance(q.embedding, t.embedding), 12), t.row_id) <= 5)"""


def near(spark, sf):
    test, train = embedded_parts(spark, sf)
    queries = test.withColumnRenamed("row_id", "query_id")
    labels = train.withColumnRenamed("row_id", "train_id")
    return D.neighbour_join(queries, labels, "query_id", "train_id", "embedding", k=5), labels


@query("neighbour_join", f"WITH {NEAR_SQL} SELECT query_id, train_id, distance FROM near")
def neighbour_join(spark, sf):
    return near(spark, sf)[0].select("query_id", "train_id", "distance")


@query("hashed_neighbours", f"WITH {NEAR_SQL} SELECT count(*) AS n_exact, TRUE AS enough, TRUE AS sound FROM near")
def hashed_neighbours(spark, sf):
    """Recall of the hash join at least 0.9, and every neighbour it gives at its true distance or farther than a missed one."""
    exact, _ = near(spark, sf)
    test, train = embedded_parts(spark, sf)
    found = keep(A.hashed_neighbour_join(test.withColumnRenamed("row_id", "query_id"), train.withColumnRenamed("row_id", "train_id"), "query_id", "train_id", "embedding", k=5))
    exact = keep(exact)
    worse = found.join(exact.select("query_id", "place", F.col("distance").alias("_best")), ["query_id", "place"]).agg(F.bool_and(F.col("distance") >= F.col("_best"))).scalar()
    return A.recall(found, exact, "query_id", "train_id").select("n_exact", (F.col("recall") >= 0.9).alias("enough")).withColumn("sound", worse)


@query(
    "knn_classifier",
    f"""WITH {NEAR_SQL} SELECT query_id, round(avg(label), 6) AS score, CASE WHEN avg(label) > 0.5 THEN 1 ELSE 0 END AS pred
FROM near GROUP BY query_id""",
)
def knn_classifier(spark, sf):
    found, labels = near(spark, sf)
    return D.neighbour_vote(found, labels, "query_id", "train_id", "label").select("query_id", six("score"), "pred")


@query(
    "knn_distance_weights",
    f"""WITH {NEAR_SQL}, voted AS (SELECT query_id, round(CASE WHEN min(distance) = 0 THEN avg(label) FILTER (distance = 0)
  ELSE sum(label / nullif(distance, 0)) / sum(1 / nullif(distance, 0)) END, 12) AS score FROM near GROUP BY query_id)
SELECT query_id, round(score, 6) AS score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM voted""",
)
def knn_distance_weights(spark, sf):
    found, labels = near(spark, sf)
    return D.neighbour_vote(found, labels, "query_id", "train_id", "label", "distance").select("query_id", six("score"), "pred")


# --- models ---


@query(
    "ridge_classifier",
    f"""WITH {WIDE_SQL}, s AS (SELECT avg(value) AS mx, avg(2 * label - 1) AS my, count(*) AS n FROM wide),
b AS (SELECT sum((value - mx) * (2 * label - 1 - my)) / (sum((value - mx) * (value - mx)) + 1000000) AS slope FROM wide, s)
SELECT row_id, round(my + slope * (value - mx), 4) AS margin, CASE WHEN my + slope * (value - mx) > 0 THEN 1 ELSE 0 END AS pred
FROM wide, s, b""",
)
def ridge_classifier(spark, sf):
    table = VectorAssembler(inputCols=["value"], outputCol="features").transform(wide(spark, sf))
    out = RidgeClassifier(alpha=1000000.0).fit(table).transform(table)
    # The solver agrees with the closed form to about 1e-9: four places compare it.
    return out.select("row_id", F.round("margin", 4).alias("margin"), F.col("prediction").cast("int").alias("pred"))


def beats_chance(scored: DataFrame) -> bool:
    """Whether the scores order rows with labels better than a constant or shuffled score could."""
    row = L.roc_auc(scored).first()
    return row is not None and row["roc_auc"] > 0.6


def orderly(facts: DataFrame, scored: DataFrame) -> DataFrame:
    """``sound`` of a model holds only if its scores order the labelled rows of ``scored``."""
    areas = keep(L.roc_auc(scored).select("model", (F.col("roc_auc") > 0.6).alias("_orders")))
    return facts.join(areas, "model", "left").withColumn("sound", F.col("sound") & F.coalesce("_orders", F.lit(False))).drop("_orders")


def table_agrees(model, encoded: DataFrame) -> bool:
    """Whether walking the node table gives the model's own scores, and the gains in it, each
    weighted by its rows, the model's importances."""
    trees = T.trees_of(encoded.sparkSession, model)
    own = score_table(model, encoded, "own", ["row_id"]).select("row_id", F.col("score").alias("_own"))
    apart = T.table_scores(trees, encoded, ["row_id"]).join(own, "row_id").agg(F.max(F.abs(F.col("score") - F.col("_own")))).first()[0]
    return apart < 1e-9 and abs(N.gain_shares(trees, model.numFeatures) - model.featureImportances.toArray()).max() < 1e-9


def _family_query(name: str, spark, sf) -> DataFrame:
    """Holdout rows of one family with its defaults. Its scores must order the fitting rows,
    the node table of a tree model must give the same scores and importances, and an
    unpenalised intercept makes the mean probability of the fitting rows their rate."""
    split = prepared(spark, sf)
    model = M.fit_all(split, M.defaults([name]))[name]
    known = keep(M.predictions({name: model}, split.train))
    good = beats_chance(known)
    if hasattr(model, "featureImportances"):
        good &= table_agrees(model, split.valid)
    if name == "logistic_regression":
        good &= abs(known.agg(F.avg("score") - F.avg("label")).first()[0]) < 1e-3
    return sound(M.predictions({name: model}, split.valid), "row_id", "label").withColumn("sound", F.col("sound") & F.lit(good))


for _name in ("random_forest", "extra_trees", "boosted_trees", "logistic_regression", "svc", "linear_svc", "decision_tree"):
    query(
        {"extra_trees": "forest_no_bootstrap", "svc": "kernel_svc"}.get(_name, _name),
        f"{RIDERS_WITH} SELECT row_id, label, '{_name}' AS model, TRUE AS sound FROM parts WHERE part = 'test'",
    )(partial(_family_query, _name))


@query("landmark_features", f"{RIDERS_WITH} SELECT row_id, label, 'svc' AS model, TRUE AS sound FROM parts WHERE part = 'test'")
def landmark_features(spark, sf):
    """A Gaussian SVC on landmarks, whose kernel error must be below that of as many random features."""
    split = prepared(spark, sf)
    sample = P.bounded_sample(split.valid, "row_id", 200)
    errors = [kernel_error(kind(dims=128).fit(split.train), sample) for kind in (LandmarkFeatures, FourierFeatures)]
    model = M.fit_family(FAMILIES["svc"], {"approximation": "landmarks"}, split.train, split.n)
    good = errors[0] < errors[1] and beats_chance(M.predictions({"svc": model}, split.train))
    return sound(M.predictions({"svc": model}, split.valid), "row_id", "label").withColumn("sound", F.col("sound") & F.lit(good))


@query("score_column", f"{RIDERS_WITH} SELECT row_id, label, model, TRUE AS sound FROM parts, {MODELS_SQL} WHERE part = 'test'")
def score_column(spark, sf):
    """Probability, margin and share scores side by side, one model of each family; each must
    order the rows it was fitted on."""
    bench = benchmark(spark, sf)
    return orderly(sound(bench.held, "row_id", "label"), M.predictions(bench.models, bench.split.train))


# --- training, search and selection ---


def baseline_result(spark, sf, k: int = 5) -> DataFrame:
    return M.baseline(*split_riders(spark, sf), [title_stage()], k).results


def within(table: DataFrame, columns: list[str]):
    """Whether every measure lies between 0 and 1."""
    good = F.lit(True)
    for c in columns:
        good = good & F.coalesce(F.col(c).between(0, 1), F.lit(False))
    return good.alias("sound")


MEASURES = ["cv_f1_mean", "cv_f1_std", "holdout_f1", "holdout_accuracy", "holdout_roc_auc"]


def benchmark_facts(bench: M.Benchmark) -> DataFrame:
    """``model, n_folds, n_oof, n_held, sound``: what was measured; the measures are those of the kept predictions."""
    oof = bench.oof.groupBy("model").agg(F.count_distinct("fold").alias("n_folds"), F.count(F.lit(1)).alias("n_oof"))
    held = bench.held.groupBy("model").agg(F.count(F.lit(1)).alias("n_held"), F.avg((F.col("label") == F.col("pred")).cast("double")).alias("_right"))
    again = F.abs(F.col("_right") - F.col("holdout_accuracy")) < 1e-9
    table = bench.results.join(oof, "model").join(held, "model")
    facts = table.select("model", "n_folds", "n_oof", "n_held", (within(table, MEASURES) & again).alias("sound"))
    return orderly(facts, M.predictions(bench.models, bench.split.train))


_COUNTS = "5 AS n_folds, count(*) FILTER (part = 'train') AS n_oof, count(*) FILTER (part = 'test') AS n_held, TRUE AS sound"


@query("baseline", f"{RIDERS_WITH} SELECT 'random_forest' AS model, {_COUNTS} FROM parts")
def baseline(spark, sf):
    return benchmark_facts(M.baseline(*split_riders(spark, sf), [title_stage()]))


@query("cross_validate", f"{RIDERS_WITH}, {KNOWN_FOLDS_SQL} SELECT row_id, label, fold, model, TRUE AS sound FROM folded, {MODELS_SQL}")
def cross_validate(spark, sf):
    bench = benchmark(spark, sf)
    return orderly(sound(bench.oof, "row_id", "label", "fold"), M.predictions(bench.models, bench.split.train))


@query("benchmark_models", f"{RIDERS_WITH} SELECT model, {_COUNTS} FROM parts, {MODELS_SQL} GROUP BY model")
def benchmark_models(spark, sf):
    return benchmark_facts(benchmark(spark, sf))


def _folds(spark, sf, k: int):
    train, test = split_riders(spark, sf)
    folds = M.prepare_folds(keep(P.stratified_kfold(train, "label", "row_id", k)), k, [title_stage()])
    return folds, M.prepare(train, test, [title_stage()])


def _drawn_sql() -> str:
    """Points of the baseline's search space in the order they are drawn."""
    values = {n: "(VALUES " + ", ".join(f"({i}, {'NULL' if v is None else v})" for i, v in enumerate(vs)) + f") {n}(i, v)" for n, vs in BASELINE_SPACE.items()}
    a, b, c = BASELINE_SPACE
    sizes = [len(v) for v in BASELINE_SPACE.values()]
    point = f"{a}.i * {sizes[1] * sizes[2]} + {b}.i * {sizes[2]} + {c}.i"
    return f"""SELECT CAST({a}.v AS INTEGER) AS {a}, CAST({b}.v AS INTEGER) AS {b}, CAST({c}.v AS INTEGER) AS {c},
  (SELECT count(DISTINCT quality) FROM documents JOIN labels USING (doc_id)) = 2 AS sound
FROM {', '.join(values.values())} ORDER BY md5(concat('42|', {point})), {point} LIMIT {BASELINE_DRAWS}"""


@query("random_search", _drawn_sql())
def random_search(spark, sf):
    done = M.search(*_folds(spark, sf, 5), FAMILIES["random_forest"], BASELINE_SPACE, BASELINE_DRAWS)
    table, measures = done.results, ["mean_test_score", "mean_train_score"]
    values = [F.get_json_object("params", f"$.{n}").cast("int").alias(n) for n in BASELINE_SPACE]
    ranked = F.col("rank_test_score").between(1, BASELINE_DRAWS) & (F.round("mean_test_score", 12) <= round(done.best_cv_f1, 12))
    return table.select(*values, (within(table, measures) & ranked).alias("sound"))


@query(
    "to_json",
    """SELECT model, concat('{"model": "', model, '", "settings": {"depth": ', coalesce(CAST(depth AS VARCHAR), 'null'), ', "trees": [', n, ', ', 2 * n, ']}}') AS text
FROM (SELECT DISTINCT concat(lang, ' ', source) AS model, CASE WHEN lang = 'en' THEN NULL ELSE len(lang) END AS depth, len(source) AS n FROM documents)""",
)
def to_json(spark, sf):
    """Settings of models named after the documents' languages and sources, as JSON text."""
    named = read(spark, sf, "documents").select("lang", "source").distinct().collect()
    rows = [(f"{r['lang']} {r['source']}", {"depth": None if r["lang"] == "en" else len(r["lang"]), "trees": (len(r["source"]), 2 * len(r["source"]))}) for r in named]
    return spark.createDataFrame([(m, S.to_json({"model": m, "settings": p})) for m, p in rows], "model string, text string")


SEARCHED = ["best_cv_f1", "holdout_f1", "holdout_accuracy", "holdout_roc_auc"]


def ledger(spark) -> Ledger:
    """What this application's searches have measured; one that was stopped goes on from here."""
    return Ledger(spark, f"{shared_folder(spark)}/ledger/{spark.sparkContext.applicationId}")


def _family_search(name: str, spark, sf) -> DataFrame:
    """One family over its whole space, with its own number of draws and three folds."""
    folds, split = _folds(spark, sf, 3)
    family = FAMILIES[name]
    done = M.search(folds, split, family, draws=family.draws, ledger=ledger(spark))
    row = M.family_result(done, split, family.search)
    good = beats_chance(score_table(done.model, split.train, name, ["row_id", "label"]))
    return row.select("model", "search_type", F.lit(done.results.count()).cast("long").alias("n_settings"), (within(row, SEARCHED) & F.lit(good)).alias("sound"))


def _n_settings(family) -> int:
    return min(prod(map(len, family.space.values())), family.draws or 10**9)


for _name, _family in FAMILIES.items():
    query(
        "family_search" if _name == "logistic_regression" else f"family_search_{_name}",
        f"{RIDERS_WITH} SELECT '{_name}' AS model, '{_family.search}' AS search_type, {_n_settings(_family)} AS n_settings, count(*) > 0 AS sound FROM parts WHERE part = 'test'",
    )(partial(_family_search, _name))


SEARCHES_SQL = "(VALUES " + ", ".join(f"('{n}', '{f.search}')" for n, f in FAMILIES.items()) + ") searches(model, search_type)"


@query("select_and_tune", f"{RIDERS_WITH} SELECT model, search_type, count(*) > 0 AS sound FROM parts, {SEARCHES_SQL} GROUP BY ALL")
def select_and_tune(spark, sf):
    """Every family searched over its whole space with its own number of draws."""
    train, test = split_riders(spark, sf)
    table = M.select_and_tune(train, test, M.defaults(FAMILIES), [title_stage()], bench=benchmark(spark, sf), ledger=ledger(spark)).results
    ranked = F.col("cv_rank").between(1, len(FAMILIES))
    return table.select("model", "search_type", (within(table, SEARCHED) & ranked).alias("sound"))


_EVENT_PARTS = f"WITH {WIDE_SQL}, {PARTS_SQL}"


@query("stack_fit", f"{_EVENT_PARTS}, {KNOWN_FOLDS_SQL} SELECT row_id, label, fold, 'stacking' AS model, TRUE AS sound FROM folded")
def stack_fit(spark, sf):
    """Out-of-fold scores, which must go with those of the model fitted on all rows."""
    table = wide(spark, sf)
    scores, labels = event_scores(table), table.select("row_id", "label")
    oof = keep(K.stack_oof(scores, labels, MODELS))
    whole = _linear_score(K.stack_model(scores, labels, MODELS))
    good = oof.join(scan(scores, MODELS, "oof"), "row_id").agg(F.corr("score", whole)).first()[0] > 0.5
    return sound(oof, "row_id", "label", "fold").withColumn("sound", F.col("sound") & F.lit(good))


def _linear_score(model):
    """Probability from the coefficients of a meta-model."""
    linear = sum((F.lit(float(w)) * F.col(m) for w, m in zip(model.coefficients, MODELS)), F.lit(float(model.intercept)))
    return 1 / (1 + F.exp(-linear))


@query("stack_predict", f"{_EVENT_PARTS} SELECT row_id, TRUE AS sound FROM parts WHERE part = 'test'")
def stack_predict(spark, sf):
    table = wide(spark, sf)
    scores = event_scores(table)
    model = K.stack_model(scores, table.select("row_id", "label"), MODELS)
    # What the model says, from its coefficients; and on the labelled rows the penalised loss
    # is flat in every coefficient, as at its minimum only.
    known = scan(scores, MODELS, "oof").join(table.select("row_id", "label"), "row_id")
    residual = _linear_score(model) - F.col("label")
    slopes = known.agg(F.count(F.lit(1)).alias("n"), F.avg(residual).alias("b"), *[F.avg(residual * F.col(m)).alias(m) for m in MODELS]).first()
    flat = abs(slopes["b"]) < 1e-4 and all(abs(slopes[m] + w / slopes["n"]) < 1e-4 for w, m in zip(model.coefficients, MODELS))
    test = scan(scores, MODELS, "test").withColumn("_told", _linear_score(model))
    told = K.stack_predict(model, scores, MODELS).join(test, "row_id")
    return told.select("row_id", ((F.abs(F.col("score") - F.col("_told")) < 1e-9) & F.lit(flat)).alias("sound"))


@query(
    "make_oof",
    f"""{RIDERS_WITH}, {KNOWN_FOLDS_SQL} SELECT row_id, 'oof' AS split, model, fold, TRUE AS sound FROM folded, {MODELS_SQL} UNION ALL
SELECT row_id, 'test', model, CAST(NULL AS INTEGER), TRUE FROM parts, {MODELS_SQL} WHERE part = 'test'""",
)
def make_oof(spark, sf):
    bench = benchmark(spark, sf)
    ranged = F.when(F.col("model").isin(*MARGINS), F.col("score").isNotNull()).otherwise(F.col("score").between(0, 1))
    return orderly(M.make_oof(bench).select("row_id", "split", "model", "fold", ranged.alias("sound")), M.predictions(bench.models, bench.split.train))


def event_scores(table: DataFrame) -> DataFrame:
    """Score table of the events: training part as out-of-fold rows, test part as test rows."""
    parts = P.stratified_split(table, "label", "row_id")
    side = F.when(F.col("part") == "train", "oof").otherwise("test").alias("split")
    long = parts.select("row_id", side, *MODELS).unpivot(["row_id", "split"], list(MODELS), "model", "score")
    return long


@query(
    "scan_oof",
    f"WITH {WIDE_SQL}, {PARTS_SQL} SELECT row_id, round(m1, 6) AS m1, round(m2, 6) AS m2, round(m3, 6) AS m3 FROM parts WHERE part = 'train'",
)
def scan_oof(spark, sf):
    return scan(event_scores(wide(spark, sf)), MODELS, "oof").select("row_id", *[six(m) for m in MODELS])


CATALOGUE_SQL = """catalogue AS (SELECT DISTINCT model, concat('/models/', model) AS model_path FROM (
  SELECT unnest([concat('family_search_', lang, '_final'), concat('family_search_', lang, '_fold_1'), 'best_family_search_final']) AS model
  FROM documents))"""


@query("discover_models", f"WITH {CATALOGUE_SQL} SELECT * FROM catalogue WHERE model LIKE 'family_search_%_final' ORDER BY model")
def discover_models(spark, sf):
    names = F.array(
        F.concat(F.lit("family_search_"), "lang", F.lit("_final")),
        F.concat(F.lit("family_search_"), "lang", F.lit("_fold_1")),
        F.lit("best_family_search_final"),
    )
    models = read(spark, sf, "documents").select(F.explode(names).alias("model")).distinct()
    return discover(models.withColumn("model_path", F.concat(F.lit("/models/"), "model")))


# --- explanation ---


def rule(df: DataFrame) -> DataFrame:
    """Fixed model on events: two columns matter, the third does not."""
    said = (F.col("value") >= 40) & (F.col("user_id") < 60)
    return df.withColumn("pred", F.when(said, 1).otherwise(0))


def _rule_sql(value: str = "value", user: str = "user_id") -> str:
    return f"CASE WHEN {value} >= 40 AND {user} < 60 THEN 1 ELSE 0 END"


_F1 = "2 * count(*) FILTER (label = 1 AND pred = 1) / (count(*) FILTER (label = 1) + count(*) FILTER (pred = 1))"


@query(
    "permutation_importance",
    f"""WITH {WIDE_SQL}, ev AS (SELECT row_id, label, value, user_id FROM wide),
{_seats('ev', 'row_id', 5, 'value AS value_there, user_id AS user_there')}, paired AS (SELECT * FROM here JOIN there USING (repeat, position)),
said AS (
  SELECT 'value' AS feature, repeat, label, {_rule_sql('value_there')} AS pred FROM paired UNION ALL
  SELECT 'user_id', repeat, label, {_rule_sql('value', 'user_there')} FROM paired UNION ALL
  SELECT 'm1', repeat, label, {_rule_sql()} FROM paired),
base AS (SELECT {_F1} AS f1 FROM (SELECT label, {_rule_sql()} AS pred FROM ev)),
drops AS (SELECT feature, repeat, (SELECT f1 FROM base) - {_F1} AS lost FROM said GROUP BY feature, repeat)
SELECT 'rule' AS model, feature, round(avg(lost), 6) AS importance_mean, round(stddev_pop(lost), 6) AS importance_std
FROM drops GROUP BY feature""",
)
def permutation_importance(spark, sf):
    out = N.permutation_importance("rule", rule, wide(spark, sf), ["value", "user_id", "m1"], 5)
    return out.select("model", "feature", six("importance_mean"), six("importance_std"))


#: Encoded slots that each raw column feeds.
FEEDS = {"full_name": ("cat__title_", "num__words"), "code": ("cat__cabin_name_",), "port": ("cat__port_",)}


def _explained_tree(spark, sf) -> tuple[M.Prepared, object, list[str], set[str]]:
    """A tree on the encoded rows, the slot names, and those of them it uses."""
    split = prepared(spark, sf)
    model = M.fit_family(FAMILIES["decision_tree"], {"max_depth": 5}, split.train, split.n)
    names = J.feature_names(split.train)
    return split, model, names, N.used_features(model, names)


def unused_costs_nothing(table: DataFrame, used: set[str], *measures: str) -> DataFrame:
    """``model, feature, sound``: a feature the model does not use has measures of exactly 0."""
    zero = F.lit(True)
    for m in measures:
        zero = zero & (F.col(m) == 0)
    return table.select("model", "feature", (F.col("feature").isin(*used) | zero).alias("sound"))


@query("permutation_importance_model", f"SELECT 'decision_tree' AS model, unnest({RAW!r}) AS feature, (SELECT count(*) FROM documents) > 0 AS sound")
def permutation_importance_model(spark, sf):
    """Raw columns through the whole pipeline of a tree."""
    split, model, _, used = _explained_tree(spark, sf)
    whole = M.PipelineModel([split.encoder, model])
    _, test = split_riders(spark, sf)
    found = N.permutation_importance("decision_tree", N.model_predict(whole), test, RAW, 5)
    raw = {c for c in RAW if any(u.startswith(p) for u in used for p in FEEDS.get(c, (f"num__{c}",)))}
    return unused_costs_nothing(found, raw, "importance_mean", "importance_std")


@query("permutation_importance_encoded", f"{RIDERS_WITH}, {SLOTS_SQL} SELECT 'decision_tree' AS model, feature, TRUE AS sound FROM slots")
def permutation_importance_encoded(spark, sf):
    split, model, names, used = _explained_tree(spark, sf)
    found = N.permutation_importance_encoded("decision_tree", N.model_predict(model), split.valid, names, 5)
    return unused_costs_nothing(found, used, "importance_mean", "importance_std")


@query("feature_importance", f"{RIDERS_WITH}, {SLOTS_SQL} SELECT 'random_forest' AS model, feature, TRUE AS sound, CAST(1 AS DOUBLE) AS total FROM slots")
def feature_importance(spark, sf):
    split = prepared(spark, sf)
    model = M.fit_family(FAMILIES["random_forest"], {}, split.train, split.n)
    found = N.feature_importance(spark, "random_forest", model, J.feature_names(split.train))
    total = found.agg(F.round(F.sum("importance"), 9)).scalar()
    shares = N.gain_shares(T.trees_of(spark, model), model.numFeatures).tolist()
    again = spark.createDataFrame(list(zip(J.feature_names(split.train), shares)), "feature string, again double")
    told = F.abs(F.col("importance") - F.col("again")) < 1e-9
    return found.join(again, "feature").select("model", "feature", told.alias("sound")).withColumn("total", total)


@query(
    "linear_shapley",
    f"""WITH {WIDE_SQL}, s AS (SELECT * FROM wide ORDER BY md5(concat('42|', row_id)), row_id LIMIT 200),
b AS (SELECT avg(value) AS mv, avg(user_id) AS mu FROM wide)
SELECT row_id, 'value' AS feature, round(0.02 * (value - mv), 6) AS value FROM s, b UNION ALL
SELECT row_id, 'user_id', round(-0.01 * (user_id - mu), 6) FROM s, b""",
)
def linear_shapley(spark, sf):
    table = wide(spark, sf).select("row_id", "value", "user_id")
    sample = P.bounded_sample(table, "row_id", 200)
    return N.linear_shapley(sample, table, {"value": 0.02, "user_id": -0.01}).select("row_id", "feature", six("value"))


@query("shapley_summary", f"{RIDERS_WITH}, {SLOTS_SQL} SELECT 'logistic_regression' AS model, feature, TRUE AS sound FROM slots")
def shapley_summary(spark, sf):
    split = prepared(spark, sf)
    model = M.fit_family(FAMILIES["logistic_regression"], {}, split.train, split.n)
    found = N.shapley_summary("logistic_regression", model, split.train, split.valid, J.feature_names(split.train))
    return found.select("model", "feature", (F.col("mean_abs_shap") >= 0).alias("sound"))


@query("sampled_shapley", f"{RIDERS_WITH}, {SLOTS_SQL} SELECT 'decision_tree' AS model, feature, TRUE AS sound FROM slots")
def sampled_shapley(spark, sf):
    split, model, names, used = _explained_tree(spark, sf)
    found = N.shapley_summary("decision_tree", model, split.train, split.valid, names, exact=False)
    return unused_costs_nothing(found, used, "mean_abs_shap")


@query("tree_shapley", f"{RIDERS_WITH}, s AS (SELECT row_id FROM parts WHERE part = 'test' ORDER BY md5(concat('42|', row_id)), row_id LIMIT 200) SELECT row_id, TRUE AS sound FROM s")
def tree_shapley(spark, sf):
    """Exact values of a forest: they sum to the score minus the mean score of the background."""
    split = prepared(spark, sf)
    model = M.fit_family(FAMILIES["random_forest"], {"n_estimators": 20}, split.train, split.n)
    background, rows = (keep(P.bounded_sample(t.select("row_id", "label", "features"), "row_id", 200)) for t in (split.train, split.valid))
    values = V.tree_shapley(T.trees_of(spark, model), rows, background, J.feature_names(split.train), "row_id")
    mean = M.predictions({"f": model}, background).agg(F.avg("score")).scalar()
    told = values.groupBy("row_id").agg(F.sum("value").alias("_sum"), F.max(F.abs("value")).alias("_most"))
    apart = F.abs(F.col("_sum") - (F.col("score") - F.col("_mean"))) < 1e-9
    return M.predictions({"f": model}, rows).withColumn("_mean", mean).join(told, "row_id").select("row_id", (apart & (F.col("_most") > 0)).alias("sound"))


def saved_tree(spark, sf) -> tuple[str, M.Prepared]:
    """A tree pipeline saved in the shared folder."""
    split, model, _, _ = _explained_tree(spark, sf)
    return save_model(M.PipelineModel([split.encoder, model]), f"{shared_folder(spark)}/models/{uuid4().hex}", "decision_tree"), split


@query("tree_nodes", f"{RIDERS_WITH} SELECT count(*) AS root_rows, TRUE AS sound FROM parts WHERE part = 'train'")
def tree_nodes(spark, sf):
    """Rows of the root, and whether the children of every node share its rows."""
    path, split = saved_tree(spark, sf)
    nodes = N.tree_nodes(spark, path, J.feature_names(split.train))
    below = nodes.select(F.col("node").alias("child"), F.col("n_rows").alias("_rows"))
    inner = nodes.where(F.col("left").isNotNull() & (F.col("depth") < 3)).select("node", "n_rows", F.explode(F.array("left", "right")).alias("child"))
    shared = inner.join(below, "child").groupBy("node", "n_rows").agg(F.sum("_rows").alias("_sum")).agg(F.bool_and(F.col("n_rows") == F.col("_sum")))
    root = nodes.where("depth = 0").select(F.col("n_rows").cast("long").alias("root_rows"))
    return root.withColumn("sound", F.coalesce(shared.scalar(), F.lit(True)))


@query("predict_batch", "SELECT doc_id AS row_id, TRUE AS sound FROM documents JOIN labels USING (doc_id)")
def predict_batch(spark, sf):
    path, split = saved_tree(spark, sf)
    rows = riders(spark, sf)
    out = R.predict_batch(load_model(spark, path), rows.drop("label"), "row_id", "quality")
    encoded = split.encoder.transform(rows)
    told = T.table_scores(T.trees_of(spark, load_model(spark, path).stages[-1]), encoded, ["row_id"])
    return out.join(told, "row_id").select("row_id", (F.col("quality") == (F.round("score", 12) > 0.5).cast("int")).alias("sound"))


@query("predict_ensemble", "SELECT doc_id AS row_id, TRUE AS sound FROM documents JOIN labels USING (doc_id)")
def predict_ensemble(spark, sf):
    """All nine families, weighted by their place in the list."""
    pipelines = benchmark(spark, sf).pipelines
    weights = [float(len(pipelines) - i) for i in range(len(pipelines))]
    rows = riders(spark, sf)
    votes, _ = R.predict_ensemble(pipelines, rows.drop("label"), "row_id", "weighted_soft_vote", weights)
    votes, score = keep(votes), F.col("ensemble_score")
    labelled = votes.join(rows.select("row_id", "label"), "row_id").select("row_id", "label", F.lit("ensemble").alias("model"), score.alias("score"))
    good = beats_chance(labelled)
    return votes.select("row_id", (score.between(0, 1) & ((score >= 0.5) == (F.col("ensemble_pred") == 1)) & F.lit(good)).alias("sound"))
