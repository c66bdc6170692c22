"""Feature preparation as ``pyspark.ml`` stages: fit on one table, apply to any.

What a stage learns is either a few numbers per column (kept as params) or a
lookup table (kept as a DataFrame and joined); no fitted state grows on the driver.
"""

from __future__ import annotations

from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.functions.scalar import coalesce_fill, extract_title, first_char
from labelworks.operators.profile import mode_value
from labelworks.operators.quantiles import exact_quantiles
from labelworks.operators.select import lookup_join, select_by_type
from labelworks.operators.keep import keep


NO_VALUE = "missing"


class _FrameWriter(MLWriter):
    def __init__(self, instance: "FrameModel") -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for name, frame in self.instance.frames.items():
            frame.write.parquet(f"{path}/frames/{name}")


class _FrameReader(MLReader):
    def __init__(self, kind: type) -> None:
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> "FrameModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.frames = {n: self.sparkSession.read.parquet(f"{path}/frames/{n}") for n in self.kind.FRAMES}
        return model


class FrameModel(Model, MLReadable, MLWritable):
    """Model whose state includes tables; saved as parquet beside the params."""

    FRAMES: tuple[str, ...] = ()
    frames: dict[str, DataFrame]

    def write(self) -> MLWriter:
        return _FrameWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FrameReader(cls)


class _TitleParams(Params):
    nameCol: Param[str] = Param(Params._dummy(), "nameCol", "text with a title", TypeConverters.toString)
    valueCol: Param[str] = Param(Params._dummy(), "valueCol", "numeric column to fill", TypeConverters.toString)
    codeCol: Param[str] = Param(Params._dummy(), "codeCol", "code whose first character counts", TypeConverters.toString)
    dropCols: Param[list[str]] = Param(Params._dummy(), "dropCols", "columns to remove", TypeConverters.toListString)
    titleCol: Param[str] = Param(Params._dummy(), "titleCol", "output: title", TypeConverters.toString)
    initialCol: Param[str] = Param(Params._dummy(), "initialCol", "output: first character", TypeConverters.toString)
    globalMedian: Param[float] = Param(Params._dummy(), "globalMedian", "median of all values", TypeConverters.toFloat)

    def _defaults(self) -> None:
        self._setDefault(
            nameCol="Name",
            valueCol="Age",
            codeCol="Cabin",
            dropCols=["Name", "Ticket", "Cabin"],
            titleCol="title",
            initialCol="cabin_name",
        )

    def _title(self) -> Any:
        return extract_title(F.col(self.getOrDefault(self.nameCol)))


class TitleFeatures(Estimator, _TitleParams, DefaultParamsReadable, DefaultParamsWritable):
    """Title from the name, first character of a code, value filled by title median.

    Fitting learns the median of each title and of all rows; applying fills a
    missing value with the median of its title, else with the global one, and
    drops the source columns. Row keys are not dropped: they identify rows, and
    the encoder never takes them as features.
    """

    @keyword_only
    def __init__(self, *, nameCol=None, valueCol=None, codeCol=None, dropCols=None, titleCol=None, initialCol=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "TitleFeaturesModel":
        value = self.getOrDefault(self.valueCol)
        titled = dataset.select(self._title().alias("_title"), F.col(value).cast("double").alias("_value"))
        medians = keep(exact_quantiles(titled, ["_value"], [0.5], ["_title"]).select("_title", F.col("value").alias("_median")))
        overall = exact_quantiles(titled, ["_value"], [0.5]).select("value").first()
        return self._model(medians, overall[0] if overall is not None else None)

    def _model(self, medians: DataFrame, overall: float | None) -> "TitleFeaturesModel":
        model = self._copyValues(TitleFeaturesModel())
        model.frames = {"medians": medians}
        return model._set(globalMedian=overall) if overall is not None else model

    def fit_groups(self, dataset: DataFrame, group: str, groups: list[int]) -> tuple[list["TitleFeaturesModel"], DataFrame]:
        """One model for each value of the column ``group``, fitted on its rows, and the table
        as each row's own model makes it, with ``group``: one pass of statistics, one join."""
        value = self.getOrDefault(self.valueCol)
        titled = dataset.select(group, self._title().alias("_title"), F.col(value).cast("double").alias("_value"))
        medians = keep(exact_quantiles(titled, ["_value"], [0.5], [group, "_title"]).select(group, "_title", F.col("value").alias("_median")))
        overall = {r[group]: r["value"] for r in exact_quantiles(titled, ["_value"], [0.5], [group]).collect()}
        models = [self._model(medians.where(F.col(group) == g).select("_title", "_median"), overall.get(g)) for g in groups]
        known = F.create_map(*[F.lit(x) for g in groups for x in (g, overall.get(g))]).cast("map<int,double>")
        # the title's median of the row's own group stands in for the lookup of one model
        lookup = medians.withColumnRenamed("_title", "_t")
        joined = dataset.withColumn("_t", self._title()).join(lookup, [group, "_t"], "left").drop("_t")
        filled = joined.withColumn(value, coalesce_fill(F.col(value).cast("double"), F.col("_median"), known[F.col(group)])).drop("_median")
        plain = self._model(medians.where(F.lit(False)).select("_title", "_median"), None)  # fills nothing
        return models, plain.transform(filled.select(*dataset.columns))


class TitleFeaturesModel(FrameModel, _TitleParams):
    FRAMES = ("medians",)

    def __init__(self) -> None:
        super().__init__()
        self._defaults()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value, title = self.getOrDefault(self.valueCol), self.getOrDefault(self.titleCol)
        initial = first_char(F.col(self.getOrDefault(self.codeCol)))
        lookup = self.frames["medians"].withColumnsRenamed({"_title": title, "_median": "_fill"})
        overall = F.lit(self.getOrDefault(self.globalMedian) if self.isSet(self.globalMedian) else None).cast("double")
        titled = dataset.withColumns({title: self._title(), self.getOrDefault(self.initialCol): initial})
        filled = lookup_join(titled, lookup, title).withColumn(
            value, coalesce_fill(F.col(value).cast("double"), F.col("_fill"), overall)
        )
        kept = [c for c in titled.columns if c not in self.getOrDefault(self.dropCols)]
        return filled.select(*kept)


class _Fills(HasInputCols):
    fills: Param[dict] = Param(Params._dummy(), "fills", "replacement of missing values by column")


class FillModel(Model, _Fills, DefaultParamsReadable, DefaultParamsWritable):
    """Replace missing values by the learned ones."""

    def __init__(self) -> None:
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = self.getOrDefault(self.fills)
        return dataset.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


class MedianImputer(Estimator, _Fills, DefaultParamsReadable, DefaultParamsWritable):
    """Exact median of each numeric column; a column without values becomes 0."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FillModel:
        columns = self.getInputCols()
        medians = {r["column"]: r["value"] for r in exact_quantiles(dataset, columns, [0.5]).collect()}
        return self._copyValues(FillModel())._set(fills={c: medians.get(c, 0.0) for c in columns})


class ModeImputer(Estimator, _Fills, DefaultParamsReadable, DefaultParamsWritable):
    """Most frequent value of each string column, ties to the smallest; a column without
    values becomes ``missing``, since a category needs a name."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FillModel:
        columns = self.getInputCols()
        modes = {r["column"]: r["mode"] for r in mode_value(dataset, columns).collect()}
        return self._copyValues(FillModel())._set(fills={c: modes.get(c, NO_VALUE) for c in columns})


class _Scales(HasInputCols):
    means: Param[dict] = Param(Params._dummy(), "means", "mean by column")
    deviations: Param[dict] = Param(Params._dummy(), "deviations", "population deviation by column")


class PopulationScaler(Estimator, _Scales, DefaultParamsReadable, DefaultParamsWritable):
    """Mean 0 and population deviation 1, written to ``num__<column>``."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        columns = self.getInputCols()
        moments = [f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for f, n in ((F.avg, "m"), (F.stddev_pop, "s"))]
        row = dataset.agg(*moments).first()
        means = {c: row[f"m_{i}"] or 0.0 for i, c in enumerate(columns)}
        deviations = {c: row[f"s_{i}"] or 1.0 for i, c in enumerate(columns)}
        return self._copyValues(PopulationScalerModel())._set(means=means, deviations=deviations)


class PopulationScalerModel(Model, _Scales, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self) -> None:
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        means, deviations = self.getOrDefault(self.means), self.getOrDefault(self.deviations)
        scaled = {f"num__{c}": (F.col(c) - F.lit(means[c])) / F.lit(deviations[c]) for c in self.getInputCols()}
        return dataset.withColumns(scaled)


class TabularEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Impute, scale and one-hot encode every column by type, into ``features``.

    Numeric block first, then the categories in sorted order; unseen categories
    become zeros. Columns in ``excludeCols`` (keys, label, fold) are no features.
    Categories are held on the driver: a column with (about) more than
    ``maxCategories`` of them fails, or is hashed to ``hashTo`` of them if that is set.
    """

    excludeCols: Param[list[str]] = Param(Params._dummy(), "excludeCols", "columns that are no features", TypeConverters.toListString)
    maxCategories: Param[int] = Param(Params._dummy(), "maxCategories", "most categories of a column", TypeConverters.toInt)
    hashTo: Param[int] = Param(Params._dummy(), "hashTo", "hashed categories of a column with too many, 0 to fail", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, excludeCols=None, maxCategories=10000, hashTo=0):
        super().__init__()
        self._setDefault(excludeCols=[], maxCategories=10000, hashTo=0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        numeric, text = select_by_type(dataset.drop(*self.getOrDefault(self.excludeCols)))
        most, slots = self.getOrDefault(self.maxCategories), self.getOrDefault(self.hashTo)
        counts = dataset.agg(*[F.approx_count_distinct(c).alias(c) for c in text]).first() if text else {}
        wide = [c for c in text if counts[c] > most]
        if wide and not slots:
            raise ValueError(f"more than {most} categories in {wide}; raise maxCategories or set hashTo")
        return Pipeline(stages=encoder_stages(numeric, text, dict.fromkeys(wide, slots))).fit(dataset)


def encoder_stages(numeric: list[str], text: list[str], hashed: dict[str, int] | None = None) -> list[Any]:
    stages: list[Any] = []
    if hashed:
        digits = [f"concat('h', CAST(pmod(xxhash64(`{c}`), {n}) AS STRING)) END AS `_hash_{c}`" for c, n in hashed.items()]
        cases = ", ".join(f"CASE WHEN `{c}` IS NOT NULL THEN {d}" for c, d in zip(hashed, digits))
        stages.append(SQLTransformer(statement=f"SELECT *, {cases} FROM __THIS__"))
    if numeric:
        stages += [MedianImputer(inputCols=numeric), PopulationScaler(inputCols=numeric)]
    blocks = [f"num__{c}" for c in numeric] + [f"cat__{c}" for c in text]
    if text:
        sources = [f"_hash_{c}" if c in (hashed or {}) else c for c in text]
        places = [f"_at_{c}" for c in text]
        stages += [
            ModeImputer(inputCols=sources),
            StringIndexer(inputCols=sources, outputCols=places, stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=places, outputCols=[f"cat__{c}" for c in text], dropLast=True),
        ]
    return [*stages, VectorAssembler(inputCols=blocks, outputCol="features")]


def build_pipeline(classifier: Estimator, features: Estimator | None, exclude: list[str]) -> Pipeline:
    """Feature creation, encoding and a fresh copy of the classifier."""
    head = [features] if features is not None else []
    return Pipeline(stages=[*head, TabularEncoder(excludeCols=exclude), classifier.copy()])


def feature_names(encoded: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector slots, from the column's metadata (``num__Age``, ``cat__title_Mr``)."""
    groups = encoded.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in groups.values() for a in kind)
    return [name for _, name in slots]


def transformed_frame(encoder: Transformer, df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and one named double column per encoded feature."""
    encoded = encoder.transform(df)
    values = vector_to_array("features")
    names = feature_names(encoded)
    return encoded.select(*keys, values.alias("_v")).select(*keys, *[F.col("_v")[i].alias(n) for i, n in enumerate(names)])
