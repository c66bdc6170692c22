"""What a fitted model relies on: importances, permutation, Shapley values, tree nodes."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

import numpy as np
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelworks.functions.metrics import metric
from labelworks.functions.scalar import abs_mean, hash_order
from labelworks.operators.split import SEED, bounded_sample, donor_rows
from labelworks.plans.classifiers import FourierFeaturesModel, LandmarkFeaturesModel
from labelworks.plans.families import last_stage, score_column
from labelworks.plans.shapley import tree_shapley
from labelworks.plans.trees import TREE_MODELS, Trees, trees_of
from labelworks.sources.tables import path_exists

KEY, LABEL = "row_id", "label"
Predict = Callable[[DataFrame], DataFrame]


def _coefficients(model: Model) -> np.ndarray | None:
    """Linear coefficients over the named features, if the model has them."""
    if isinstance(model, PipelineModel) and isinstance(model.stages[0], (FourierFeaturesModel, LandmarkFeaturesModel)):
        return None
    last = last_stage(model)
    return np.array(last.coefficients.toArray()) if hasattr(last, "coefficients") else None


def feature_importance(spark: SparkSession, name: str, model: Model, names: Sequence[str]) -> DataFrame | None:
    """``model, feature, importance`` in falling order; None where the model has no such notion.

    One row per encoded feature, as many as the model itself holds on the driver.
    """
    last = last_stage(model)
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif (coefficients := _coefficients(model)) is not None:
        values = np.abs(coefficients)
    else:
        return None
    rows = [(name, f, float(v)) for f, v in zip(names, values)]
    return spark.createDataFrame(rows, "model string, feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def gain_shares(trees: Trees, n_features: int) -> np.ndarray:
    """Importances from the node tables: gains weighted by rows, as shares of each tree (not
    in a boosted model, whose later trees matter less), and their sum as shares."""
    total = np.zeros(n_features)
    for tree in trees.trees:
        inner = tree.left >= 0
        own = np.bincount(tree.feature[inner], tree.gain[inner] * tree.n_rows[inner], n_features)
        if own.sum() > 0:
            total += own if trees.boosted else own / own.sum()
    return total / total.sum() if total.sum() > 0 else total


def _drops(shuffled: DataFrame, base: DataFrame, name: str, scoring: str) -> DataFrame:
    """Mean and population deviation of the score lost in each repeat."""
    baseline = base.agg(metric(scoring, LABEL, "pred")).scalar()
    repeats = shuffled.groupBy("feature", "repeat").agg(metric(scoring, LABEL, "pred").alias("_score"))
    lost = repeats.withColumn("_base", baseline).withColumn("_drop", F.col("_base") - F.col("_score"))
    stats = lost.groupBy("feature").agg(
        F.avg("_drop").alias("importance_mean"), F.stddev_pop("_drop").alias("importance_std")
    )
    return stats.select(F.lit(name).alias("model"), "feature", "importance_mean", "importance_std").orderBy(
        F.col("importance_mean").desc(), "feature"
    )


def permutation_importance(
    name: str, predict: Predict, df: DataFrame, features: Sequence[str], repeats: int = 5, scoring: str = "f1", seed: int = SEED
) -> DataFrame:
    """Score lost when one column is shuffled.

    ``predict`` adds ``pred`` to a table with ``row_id``, ``label`` and the
    features. One permutation per repeat serves all features, so rows are
    shuffled ``repeats`` times and not features x repeats; the copies for each
    feature are made after the join and never cross the network before they are
    counted. All copies are predicted in one pass.
    """
    paired = donor_rows(df.select(KEY, LABEL, *features), KEY, features, repeats, seed)
    copies = paired.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    swapped = {f: F.when(F.col("feature") == f, F.col("donor")[f]).otherwise(F.col(f)) for f in features}
    unique = F.concat_ws("|", "repeat", "feature", F.col(KEY).cast("string"))
    shuffled = copies.select("repeat", "feature", unique.alias(KEY), LABEL, *[c.alias(f) for f, c in swapped.items()])
    return _drops(predict(shuffled), predict(df.select(KEY, LABEL, *features)), name, scoring)


def permutation_importance_encoded(
    name: str,
    predict: Predict,
    df: DataFrame,
    names: Sequence[str],
    repeats: int = 5,
    scoring: str = "f1",
    seed: int = SEED,
    used: Collection[str] | None = None,
) -> DataFrame:
    """The same on the slots of the encoded vector ``features``.

    A copy of a row carries its whole vector, so slots that the model does not look at,
    named by leaving them out of ``used``, are not tried: shuffling them costs exactly 0.
    """
    tried = [(i, n) for i, n in enumerate(names) if used is None or n in used]
    idle = df.sparkSession.createDataFrame(
        [(name, n, 0.0, 0.0) for n in names if used is not None and n not in used],
        "model string, feature string, importance_mean double, importance_std double",
    )
    if not tried:
        return idle.orderBy("feature")
    values = df.select(KEY, LABEL, vector_to_array("features").alias("_v"))
    paired = donor_rows(values, KEY, ["_v"], repeats, seed)
    slots = F.explode(F.array(*[F.struct(F.lit(i).alias("slot"), F.lit(n).alias("feature")) for i, n in tried])).alias("_s")
    copies = paired.select("*", slots).select("*", F.col("_s.slot").alias("_slot"), F.col("_s.feature").alias("feature"))
    swapped = F.transform("_v", lambda x, i: F.when(i == F.col("_slot"), F.get(F.col("donor._v"), i)).otherwise(x))
    unique = F.concat_ws("|", "repeat", "_slot", F.col(KEY).cast("string"))
    shuffled = copies.select("repeat", "feature", unique.alias(KEY), LABEL, array_to_vector(swapped).alias("features"))
    found = _drops(predict(shuffled), predict(df.select(KEY, LABEL, "features")), name, scoring)
    return found.unionByName(idle).orderBy(F.col("importance_mean").desc(), "feature")


def used_features(model: Model, names: Sequence[str]) -> set[str] | None:
    """Names of the slots a model looks at; None where it cannot tell."""
    last = last_stage(model)
    if hasattr(last, "featureImportances"):
        weights = last.featureImportances.toArray()
    elif (weights := _coefficients(model)) is None:
        return None
    return {n for n, w in zip(names, weights) if w != 0}


def model_predict(model: Model) -> Predict:
    return lambda df: model.transform(df).withColumn("pred", F.col("prediction").cast("int"))


def _summary(contributions: DataFrame, name: str) -> DataFrame:
    out = contributions.groupBy("feature").agg(abs_mean("value").alias("mean_abs_shap"))
    return out.select(F.lit(name).alias("model"), "feature", "mean_abs_shap").orderBy(F.col("mean_abs_shap").desc(), "feature")


def linear_shapley(df: DataFrame, background: DataFrame, coefficients: dict[str, float], key: str = KEY) -> DataFrame:
    """Exact values ``key, feature, value`` of a linear score: coefficient x (x - background mean)."""
    names = list(coefficients)
    means = background.agg(F.struct(*[F.avg(n).alias(n) for n in names]).alias("m")).scalar()
    with_means = df.select(key, *[F.col(n).cast("double").alias(n) for n in names]).withColumn("_m", means)
    parts = [(F.lit(float(coefficients[n])) * (F.col(n) - F.col("_m")[n])).alias(n) for n in names]
    return with_means.select(key, *parts).unpivot([key], names, "feature", "value")


def sampled_shapley(
    score: Callable[[DataFrame], DataFrame], df: DataFrame, background: DataFrame, names: Sequence[str], draws: int = 20, seed: int = SEED
) -> DataFrame:
    """Values of any model by sampled feature orders (Štrumbelj & Kononenko, 2014).

    For each row and draw, features move one by one, in random order, from a
    background row to the row; the change of the score belongs to the feature
    that moved. ``score`` adds a ``score`` column to a table with ``features``.
    The caller bounds rows; the expansion is rows x draws x (features + 1).
    """
    d = len(names)
    rows = df.select(KEY, vector_to_array("features").alias("_x"))
    pool = background.select(vector_to_array("features").alias("_z"), F.col(KEY).alias("_bg"))
    size = background.agg(F.count(F.lit(1))).scalar()
    # The background is a bounded sample; its numbering is a window of that size.
    seats = pool.withColumn("_seat", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("_bg")) - 1).drop("_bg")
    drawn = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("_draw")).withColumn("_size", size)
    tag = F.concat_ws("|", F.col(KEY).cast("string"), F.col("_draw"))
    drawn = drawn.withColumn("_seat", F.pmod(F.xxhash64(F.lit(seed), tag), F.col("_size")).cast("int"))
    order = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), F.lit(d - 1)),
            lambda i: F.struct(hash_order(F.concat_ws("|", F.col(KEY).cast("string"), F.col("_draw"), i), seed).alias("h"), i.alias("i")),
        )
    )
    paired = drawn.join(seats, "_seat").withColumn("_order", F.transform(order, lambda s: s["i"]))
    steps = paired.select("*", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("_step"))

    def moved(x: Column, i: Column) -> Column:
        return F.when(F.array_position(F.col("_order"), i) <= F.col("_step"), x).otherwise(F.get(F.col("_z"), i))

    unique = F.concat_ws("|", F.col(KEY).cast("string"), "_draw", "_step")
    chain = steps.select(
        F.col(KEY).alias("_row"),
        "_draw",
        "_step",
        F.get(F.col("_order"), F.col("_step") - 1).alias("_moved"),
        unique.alias(KEY),
        array_to_vector(F.transform("_x", moved)).alias("features"),
    )
    scored = score(chain).select("_row", "_draw", "_step", "_moved", "score")
    # Scored once: a chain of d + 1 steps meets in one window.
    chain_order = Window.partitionBy("_row", "_draw").orderBy("_step")
    gains = scored.withColumn("_before", F.lag("score").over(chain_order)).where(F.col("_step") > 0)
    values = gains.groupBy("_row", "_moved").agg(F.avg(F.col("score") - F.col("_before")).alias("value"))
    label = F.get(F.array(*[F.lit(n) for n in names]), F.col("_moved"))
    return values.select(F.col("_row").alias(KEY), label.alias("feature"), "value")


def shapley_summary(
    name: str,
    model: Model,
    train: DataFrame,
    test: DataFrame,
    names: Sequence[str],
    rows: int = 200,
    draws: int = 20,
    seed: int = SEED,
    exact: bool = True,
) -> DataFrame:
    """``model, feature, mean_abs_shap`` over at most ``rows`` background and evaluated rows.

    Linear models are explained exactly on their margin and tree models on their score
    (boosted ones on their margin), others, or tree models without ``exact``, by sampling
    the score of class 1.
    """
    background, evaluated = (bounded_sample(t.select(KEY, "features"), KEY, rows, seed) for t in (train, test))
    coefficients = _coefficients(model)
    if coefficients is not None:
        slots = [F.col("_v")[i].alias(n) for i, n in enumerate(names)]
        wide = [t.select(KEY, vector_to_array("features").alias("_v")).select(KEY, *slots) for t in (background, evaluated)]
        values = linear_shapley(wide[1], wide[0], dict(zip(names, coefficients)))
    elif exact and isinstance(last_stage(model), TREE_MODELS):
        values = tree_shapley(trees_of(train.sparkSession, last_stage(model)), evaluated, background, names, KEY)
    else:

        def score(df: DataFrame) -> DataFrame:
            predicted = model.transform(df)
            return predicted.withColumn("score", F.coalesce(score_column(predicted), F.col("prediction")))

        values = sampled_shapley(score, evaluated, background, names, draws, seed)
    return _summary(values, name)


def _saved_classifier(spark: SparkSession, path: str) -> str:
    """Folder of the classifier: the path itself, or the last stage of (nested) saved pipelines."""
    while path_exists(spark, f"{path}/stages"):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/stages")
        stages = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
        path = max((s.getPath().toString() for s in stages), key=lambda p: int(p.rsplit("/", 1)[-1].split("_")[0]))
    return path


def tree_nodes(spark: SparkSession, model_path: str, names: Sequence[str], max_depth: int = 3) -> DataFrame:
    """Nodes of the first tree of a saved tree model or pipeline ending in one, down to ``max_depth``.

    ``node, depth, feature, threshold, left_categories, n_categories, impurity,
    gain, prediction, n_rows, left, right``. The saved node table is read; each
    level is one join of the nodes found so far with their children.
    """
    data = spark.read.parquet(f"{_saved_classifier(spark, model_path)}/data")
    nodes = data.where(F.col("treeID") == 0).select("nodeData.*") if "treeID" in data.columns else data
    level = nodes.where(F.col("id") == 0).select(F.lit(0).alias("depth"), "*")
    found = level
    for depth in range(1, max_depth + 1):
        inner = level.where(F.col("leftChild") >= 0)
        children = inner.select(F.explode(F.array("leftChild", "rightChild")).alias("id"))
        level = nodes.join(children, "id").select(F.lit(depth).alias("depth"), *nodes.columns)
        found = found.unionByName(level)
    split = F.col("split")
    place = split["featureIndex"]
    name = F.when(place >= 0, F.get(F.array(*[F.lit(n) for n in names]), place))
    continuous = split["numCategories"] == -1
    values = split["leftCategoriesOrThreshold"]
    leaf = F.col("leftChild") < 0
    return found.select(
        F.col("id").alias("node"),
        "depth",
        F.when(~leaf, name).alias("feature"),
        F.when(~leaf & continuous, F.get(values, F.lit(0))).alias("threshold"),
        F.when(~leaf & ~continuous, values).alias("left_categories"),
        F.when(~leaf & ~continuous, split["numCategories"]).alias("n_categories"),
        "impurity",
        F.when(~leaf, F.col("gain")).alias("gain"),
        "prediction",
        F.col("rawCount").alias("n_rows"),
        F.when(~leaf, F.col("leftChild")).alias("left"),
        F.when(~leaf, F.col("rightChild")).alias("right"),
    ).orderBy("node")
