"""Tree regression, one model per target, on Spark ML (M4-M6, M8, M15, F16 within a model)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators.evaluate import metrics_per_target
from loadloom.session import checkpoint_root

INPUTS = "_inputs"
SEED = 42


@dataclass(frozen=True)
class Boosting:
    """Gradient boosting: shrinkage, rounds, depth.

    ``max_bins``: distinct values of an input that a split can tell apart; more of them are binned by their quantiles.
    """

    learning_rate: float = 0.01
    n_estimators: int = 1000
    max_depth: int = 6
    max_bins: int = 32

    def estimator(self, target: str, output: str) -> GBTRegressor:
        return GBTRegressor(
            featuresCol=INPUTS,
            labelCol=target,
            predictionCol=output,
            stepSize=self.learning_rate,
            maxIter=self.n_estimators,
            maxDepth=self.max_depth,
            maxBins=self.max_bins,
            featureSubsetStrategy="all",
            checkpointInterval=10,
            seed=SEED,
        )


@dataclass(frozen=True)
class Forest:
    """Random forest: trees, depth; every split sees all features, every tree its own draw of the rows.

    ``max_bins`` as for ``Boosting``.
    """

    n_estimators: int = 1000
    max_depth: int = 6
    bootstrap: bool = True
    max_bins: int = 32

    def estimator(self, target: str, output: str) -> RandomForestRegressor:
        return RandomForestRegressor(
            featuresCol=INPUTS,
            labelCol=target,
            predictionCol=output,
            numTrees=self.n_estimators,
            maxDepth=self.max_depth,
            maxBins=self.max_bins,
            featureSubsetStrategy="all",
            bootstrap=self.bootstrap,
            seed=SEED,
        )


@dataclass(frozen=True)
class TargetModels:
    """A fitted pipeline and the names it works with. Inputs are matched by name, so their order is free."""

    pipeline: PipelineModel
    features: Sequence[str]
    outputs: Mapping[str, str] = field(default_factory=dict)

    def score(self, df: DataFrame) -> DataFrame:
        """M6: the frame with one prediction column per target."""
        inner = {s for stage in self.pipeline.stages for s in _made_by(stage)}
        return self.pipeline.transform(df).drop(*inner)

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str, features: Sequence[str], outputs: Mapping[str, str]) -> TargetModels:
        return cls(PipelineModel.load(path), features, outputs)

    def regressors(self) -> list:
        return [s for s in self.pipeline.stages if hasattr(s, "featureImportances")]

    def importances(self, df: DataFrame) -> DataFrame:
        """M8: ``feature, target, importance``; as many rows as features times targets."""
        widths = self.input_names()
        rows = []
        for target, stage in zip(self.outputs, self.regressors(), strict=True):
            vector = stage.featureImportances
            rows += [(name, target, float(vector[i])) for i, name in enumerate(widths)]
        return df.sparkSession.createDataFrame(rows, "feature string, target string, importance double")

    def input_names(self) -> list[str]:
        """Names of the assembled inputs, one per vector position; an encoded column has one per level."""
        levels = {}
        for stage in self.pipeline.stages:
            if isinstance(stage, OneHotEncoderModel):
                for column, size in zip(stage.getInputCols(), stage.categorySizes, strict=True):
                    levels[column] = [f"{column}_{level}" for level in range(size)]
        plain = [f for f in self.features if f not in levels]
        return plain + [name for column in levels for name in levels[column]]


def _made_by(stage) -> list[str]:
    if isinstance(stage, VectorAssembler):
        return [stage.getOutputCol()]
    if isinstance(stage, OneHotEncoderModel):
        return list(stage.getOutputCols())
    return []


@dataclass(frozen=True)
class Matrix:
    """Rows assembled once into vectors, with the targets beside them, kept while models are fitted on them."""

    stages: Sequence
    rows: DataFrame
    features: Sequence[str]
    targets: Sequence[str]


@contextmanager
def assembled(
    df: DataFrame,
    features: Sequence[str] = tuple(names.MODEL_INPUTS),
    targets: Sequence[str] = tuple(names.TARGETS),
    encode: Sequence[str] = (),
) -> Iterator[Matrix]:
    """The training matrix for the length of a block; all regressors read it many times over.

    ``encode`` one-hot encodes columns of small non-negative integers first, unknown values giving all zeros. Missing
    inputs are passed on as NaN, which the trees send to the right branch.
    """
    first = []
    plain = [f for f in features if f not in encode]
    if encode:
        encoder = OneHotEncoder(
            inputCols=list(encode),
            outputCols=[f"_hot_{c}" for c in encode],
            handleInvalid="keep",
            dropLast=True,
        )
        first.append(encoder)
    inputs = [*plain, *[f"_hot_{c}" for c in encode]]
    first.append(VectorAssembler(inputCols=inputs, outputCol=INPUTS, handleInvalid="keep"))
    narrow = df.select(*features, *targets)
    shared = Pipeline(stages=first).fit(narrow)
    rows = shared.transform(narrow).select(INPUTS, *targets).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield Matrix(shared.stages, rows, list(features), list(targets))
    finally:
        rows.unpersist()


def _fitted(matrix: Matrix, work: Sequence[tuple[Boosting | Forest, str, str]], parallelism: int) -> list:
    """A regressor for each (parameters, target, output), ``parallelism`` of them at a time, each in a scheduler pool of its own
    so that under fair scheduling short fits do not wait for long ones."""
    spark = matrix.rows.sparkSession
    checkpoint_root(spark)

    def fit_one(job: tuple[int, tuple[Boosting | Forest, str, str]]):
        number, (model, target, output) = job
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{number % parallelism}")
        return model.estimator(target, output).fit(matrix.rows.filter(F.col(target).isNotNull()))

    with ThreadPool(max(1, min(parallelism, len(work)))) as pool:
        # As in Spark's own parallel tuning: each thread submits its jobs with this thread's properties.
        return pool.map(inheritable_thread_target(spark)(fit_one), list(enumerate(work)))


def fit_per_target(
    df: DataFrame,
    model: Boosting | Forest,
    features: Sequence[str] = tuple(names.MODEL_INPUTS),
    targets: Sequence[str] = tuple(names.TARGETS),
    outputs: Sequence[str] = tuple(names.PREDICTED),
    encode: Sequence[str] = (),
    parallelism: int = 3,
) -> TargetModels:
    """M4 / M5: one regressor per target over the same assembled inputs (see ``assembled``), ``parallelism`` at a time."""
    with assembled(df, features, targets, encode) as matrix:
        return fit_variants(matrix, {"": model}, outputs, parallelism)[""]


def fit_variants(
    matrix: Matrix,
    variants: Mapping[str, Boosting | Forest],
    outputs: Sequence[str] = tuple(names.PREDICTED),
    parallelism: int = 3,
) -> dict[str, TargetModels]:
    """All variants of all targets on one matrix, ``parallelism`` fits at a time whatever they belong to."""
    work = [(model, t, o) for model in variants.values() for t, o in zip(matrix.targets, outputs, strict=True)]
    fitted, n = _fitted(matrix, work, parallelism), len(matrix.targets)
    named = dict(zip(matrix.targets, outputs, strict=True))
    return {
        name: TargetModels(PipelineModel([*matrix.stages, *fitted[i * n : (i + 1) * n]]), matrix.features, named)
        for i, name in enumerate(variants)
    }


def compare_variants(
    train: DataFrame,
    test: DataFrame,
    variants: Mapping[str, Boosting | Forest],
    features: Sequence[str] = tuple(names.MODEL_INPUTS),
    targets: Sequence[str] = tuple(names.TARGETS),
    outputs: Sequence[str] = tuple(names.PREDICTED),
    parallelism: int = 3,
) -> DataFrame:
    """Each parameter set trained and judged on the same split; one row per variant.

    The train rows are assembled once for all variants. The test rows are as well: they are read once, every model adds its
    prediction to them, and one aggregate gives the errors of all.
    """
    with assembled(train, features, targets) as matrix:
        fitted = fit_variants(matrix, variants, outputs, parallelism)
        scored = PipelineModel(list(matrix.stages)).transform(test.select(*features, *targets))
        pairs = {}
        for i, models in enumerate(fitted.values()):
            for target, stage in zip(targets, models.regressors(), strict=True):
                column = f"_{i}_{target}"
                scored = stage.copy({stage.predictionCol: column}).transform(scored)
                pairs[column] = (target, column)
        errors = metrics_per_target(scored, pairs)
    rows = []
    for i, (name, model) in enumerate(variants.items()):
        settings = F.create_map(*[F.lit(x) for k, v in vars(model).items() for x in (k, str(v))])
        rows += [F.struct(F.lit(f"_{i}_{t}").alias("target"), F.lit(name).alias("variant"), settings.alias("parameters"), F.lit(i).alias("place")) for t in targets]
    named = train.sparkSession.range(1).select(F.inline(F.array(*rows)))
    means = [F.avg(m).alias(m) for m in ("mse", "mae", "r2")]
    return errors.join(named, "target").groupBy("place", "variant").agg(F.any_value("parameters").alias("parameters"), *means).drop("place")
