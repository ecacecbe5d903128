"""Model fitting with Spark ML on the prepared splits."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagemill import session
from vintagemill.functions.numeric import ratio
from vintagemill.operators import columns, features, ranking
from vintagemill.schemas import CATEGORY_COLUMNS, LABEL, MODEL_NUMERIC, MONOTONE_DIRECTIONS
from vintagemill.sources import documents

# Search space of the tuned model.
SEARCH_SPACE = {
    "stepSize": [0.03, 0.05, 0.07, 0.10],
    "maxDepth": [5, 6, 7],
    "minInstancesPerNode": [1000, 3000, 6000, 10000, 15000],
    "featureSubsetStrategy": ["0.7", "0.8", "0.9", "1.0"],
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    "weight_scale": [0.7, 1.0, 1.3],
}


TREE_SETTINGS = dict(
    maxIter=100, maxDepth=6, stepSize=0.03, subsamplingRate=0.85, featureSubsetStrategy="0.85",
    minInstancesPerNode=100, seed=42, maxBins=64, validationTol=0.01,
)


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Class-imbalance weights in one row.

    ``negatives_per_positive`` is 1 without positives; ``odds_weight`` is
    ``(1 - r) / r`` with a bad rate of zero taken as 0.01; the balanced weights
    give both classes equal total weight.
    """
    y = F.col(label).cast("int")
    counted = df.agg(F.count(y).alias("n"), F.sum(y).alias("pos")).withColumn("neg", F.col("n") - F.col("pos"))
    rate = F.when(F.col("pos") > 0, F.col("pos") / F.col("n")).otherwise(0.01)
    return counted.select(
        ratio(F.col("neg"), F.col("pos"), 1.0).alias("negatives_per_positive"),
        ((1 - rate) / rate).alias("odds_weight"),
        ratio(F.col("n"), 2 * F.col("pos")).alias("balanced_positive"),
        ratio(F.col("n"), 2 * F.col("neg")).alias("balanced_negative"),
    )


@dataclass
class CreditModel:
    """A fitted pipeline with what scoring needs: feature order and training medians."""

    pipeline: PipelineModel
    numeric: list[str]
    medians: dict[str, float]
    categorical: tuple[str, ...] = ()

    def prepare(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Conform, coerce and impute the inputs; ``keep`` columns travel along."""
        carried = [c for c in dict.fromkeys([*keep, *self.categorical]) if c in df.columns and c not in self.numeric]
        ready = columns.conform(df, self.numeric, carried)
        absent = [c for c in self.categorical if c not in df.columns]
        ready = ready.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else ready
        return columns.impute(ready, self.numeric, self.medians)

    def score(self, df: DataFrame, keep: Sequence[str] = ("loan_id", "orig_date", "msa"), out: str = "pd_raw") -> DataFrame:
        """(keep..., ``out``): predicted probability of bad, row by row."""
        shadowed = {k: f"_keep_{k}" for k in keep if k in df.columns and k in self.numeric}
        df = df.withColumns({new: F.col(k) for k, new in shadowed.items()})
        present = [shadowed.get(k, k) for k in keep if k in df.columns]
        scored = self.pipeline.transform(self.prepare(df, present))
        names = {new: k for k, new in shadowed.items()}
        return scored.select(
            *[F.col(k).alias(names.get(k, k)) for k in present],
            F.element_at(vector_to_array("probability"), 2).alias(out),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Pipeline and medians side by side under one run path."""
        self.pipeline.save(f"{path}/pipeline")
        pairs = F.create_map(*itertools.chain.from_iterable((F.lit(f), F.lit(self.medians.get(f))) for f in self.numeric))
        inputs = spark.range(1).select(
            F.array(*[F.lit(f) for f in self.numeric]).alias("numeric"),
            F.array(*[F.lit(c) for c in self.categorical]).cast("array<string>").alias("categorical"),
            pairs.alias("medians"),
        )
        documents.write_document(inputs, f"{path}/inputs")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CreditModel:
        text = T.ArrayType(T.StringType())
        schema = T.StructType([
            T.StructField("numeric", text), T.StructField("categorical", text),
            T.StructField("medians", T.MapType(T.StringType(), T.DoubleType())),
        ])
        row = documents.read_document(spark, f"{path}/inputs", schema).first()
        return cls(
            PipelineModel.load(f"{path}/pipeline"), list(row["numeric"]), dict(row["medians"]),
            tuple(row["categorical"] or ()),
        )


def _training_frame(
    train: DataFrame, valid: DataFrame | None, model: CreditModel, label: str, positive_weight: float | None
) -> DataFrame:
    def ready(df: DataFrame, held_out: bool) -> DataFrame:
        y = F.col(label).cast("double").alias("_y")
        kept = model.prepare(df.withColumn("_y", y).filter(F.col("_y").isNotNull()), ["_y"])
        return kept.withColumn("_held_out", F.lit(held_out))

    frame = ready(train, False)
    frame = frame.unionByName(ready(valid, True)) if valid is not None else frame
    weight = 1.0 if positive_weight is None else float(positive_weight)
    return frame.withColumn("_w", F.when(F.col("_y") == 1, F.lit(weight)).otherwise(1.0))


def fit_logistic(
    train: DataFrame, names: Sequence[str] = MODEL_NUMERIC, label: str = LABEL, max_iter: int = 200,
    directions: Mapping[str, int] | None = None,
) -> CreditModel:
    """Balanced, standardised, L2-regularised logistic baseline.

    ``directions`` bounds coefficient signs: +1 may only raise the risk, -1 only
    lower it.
    """
    names = [c for c in names if c in train.columns]
    model = CreditModel(None, names, features.median_values(train, names))
    weights = class_weights(train, label).first()
    scale = weights["negatives_per_positive"]
    total = train.filter(F.col(label).isNotNull()).count()
    negative = weights["balanced_negative"] or 1.0
    frame = _training_frame(train, None, model, label, scale).withColumn("_w", F.col("_w") * F.lit(negative))
    bounds = {}
    if directions:
        wanted = [directions.get(c, 0) for c in names]
        low = [0.0 if d > 0 else float("-inf") for d in wanted]
        high = [0.0 if d < 0 else float("inf") for d in wanted]
        bounds = {
            "lowerBoundsOnCoefficients": DenseMatrix(1, len(names), low),
            "upperBoundsOnCoefficients": DenseMatrix(1, len(names), high),
        }
    stages = [
        VectorAssembler(inputCols=names, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(
            labelCol="_y", weightCol="_w", maxIter=max_iter, regParam=1.0 / max(1, total), elasticNetParam=0.0,
            standardization=False, tol=1e-10, **bounds,
        ),
    ]
    model.pipeline = Pipeline(stages=stages).fit(frame)
    return model


def linear_terms(model: CreditModel) -> dict[str, tuple[float, float]]:
    """feature -> (coefficient per unit, training mean) of a logistic model."""
    scaler, logistic = model.pipeline.stages[1], model.pipeline.stages[2]
    return {
        f: (float(c) / float(s) if s else 0.0, float(m))
        for f, c, s, m in zip(model.numeric, logistic.coefficients, scaler.std, scaler.mean)
    }


def _booster(with_valid: bool, settings: Mapping) -> GBTClassifier:
    held_out = {"validationIndicatorCol": "_held_out"} if with_valid else {}
    return GBTClassifier(labelCol="_y", weightCol="_w", featuresCol="features", **held_out, **settings)


def fit_boosted_trees(
    train: DataFrame,
    valid: DataFrame | None = None,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] = (),
    label: str = LABEL,
    positive_weight: float | None = None,
    medians: Mapping[str, float] | None = None,
    stop_gain: float = 0.01,
    **params,
) -> CreditModel:
    """Gradient-boosted trees, stopping early on the validation rows when given.

    ``stop_gain`` is the relative gain in validation error under which no more trees
    are added; ``medians`` spares fits on the same rows the search for them.
    """
    numeric = list(numeric or columns.numeric_features(train))
    categorical = tuple(c for c in categorical if c in train.columns)
    model = CreditModel(None, numeric, dict(medians) if medians is not None else features.median_values(train, numeric), categorical)
    frame = _training_frame(train, valid, model, label, positive_weight)
    settings = TREE_SETTINGS | {"validationTol": stop_gain} | params
    indexers = []
    if categorical:
        # Category counts bound the number of bins a split may look at.
        indexer = StringIndexer(
            inputCols=list(categorical), outputCols=[f"_ix_{c}" for c in categorical], handleInvalid="keep"
        ).fit(frame.filter(~F.col("_held_out")))
        settings["maxBins"] = max(settings["maxBins"], 2 + max(len(x) for x in indexer.labelsArray))
        indexers = [indexer]
    booster = _booster(valid is not None, settings)
    assembler = VectorAssembler(inputCols=[*numeric, *[f"_ix_{c}" for c in categorical]], outputCol="features")
    model.pipeline = Pipeline(stages=[*indexers, assembler, booster]).fit(frame)
    return model


def fit_mixed_trees(train: DataFrame, valid: DataFrame, label: str = LABEL, **params) -> CreditModel:
    """Numeric and categorical inputs, positives weighted by the class ratio."""
    weight = class_weights(train, label).first()["negatives_per_positive"]
    numeric = [c for c in MODEL_NUMERIC if c in train.columns]
    settings = dict(subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=20) | params
    return fit_boosted_trees(train, valid, numeric, CATEGORY_COLUMNS, label, weight, **settings)


class KolmogorovSmirnov(Evaluator):
    """Tie-exact KS of a scored table, for model selection; ``count`` as in :func:`ranking.evaluate`."""

    def __init__(self, score: str = "y_pred", label: str = "y_true", count: str | None = None):
        super().__init__()
        self._score, self._label, self._count = score, label, count

    def _evaluate(self, dataset: DataFrame) -> float:
        return ranking.evaluate(dataset, self._score, self._label, metrics=["ks"], count=self._count).first()["ks"] or 0.0

    def isLargerBetter(self) -> bool:  # noqa: N802 - interface name
        return True


def sample_settings(space: Mapping[str, Sequence], draws: int, seed: int = 42) -> list[dict]:
    """Distinct random combinations of the search space."""
    sizes = [len(v) for v in space.values()]
    total = 1
    for n in sizes:
        total *= n
    picks = random.Random(seed).sample(range(total), min(draws, total))

    def decode(i: int) -> dict:
        chosen = {}
        for name, options in space.items():
            i, at = divmod(i, len(options))
            chosen[name] = options[at]
        return chosen

    return [decode(i) for i in picks]


def random_search(
    train: DataFrame, valid: DataFrame, draws: int = 30, seed: int = 42, space: Mapping[str, Sequence] = SEARCH_SPACE,
    label: str = LABEL, numeric: Sequence[str] | None = None, at_once: int = 4, **fixed,
) -> tuple[CreditModel, DataFrame]:
    """Best model by validation KS, and the table of all draws; of equal ones the first drawn is best.

    The assembled rows are written once, and kept in memory as far as they fit there; ``at_once`` draws are
    fitted and judged on them side by side.
    """
    base = class_weights(train, label).first()["odds_weight"]
    numeric = list(numeric or columns.numeric_features(train))
    model = CreditModel(None, numeric, features.median_values(train, numeric))
    assembler = VectorAssembler(inputCols=numeric, outputCol="features")
    frame = assembler.transform(_training_frame(train, valid, model, label, None))
    ready = session.materialise(frame.select("features", "_y", "_held_out"), "search").persist()
    evaluator = KolmogorovSmirnov(count="n")

    def draw(settings: Mapping) -> tuple[GBTClassificationModel, float]:
        chosen = {k: v for k, v in settings.items() if k != "weight_scale"}
        weight = F.when(F.col("_y") == 1, F.lit(base * settings.get("weight_scale", 1.0))).otherwise(1.0)
        fitted = _booster(True, TREE_SETTINGS | chosen | fixed).fit(ready.withColumn("_w", weight))
        scored = fitted.transform(ready.filter("_held_out")).select(
            F.col("_y").cast("int").alias("y_true"), F.element_at(vector_to_array("probability"), 2).alias("y_pred"))
        # counted, as trees give few different scores; written, as the metric's tests for NULL would predict each row once more
        counts = scored.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))
        return fitted, float(evaluator.evaluate(session.materialise(counts, "draw")))

    best, log, drawn = None, [], sample_settings(space, draws, seed)
    try:
        with ThreadPool(at_once) as pool:
            results = pool.imap(inheritable_thread_target(train.sparkSession)(draw), drawn)
            for i, (settings, (fitted, ks)) in enumerate(zip(drawn, results), 1):
                log.append((i, str(settings), ks))
                if best is None or ks > log[best - 1][2]:
                    best, model.pipeline = i, PipelineModel([assembler, fitted])
    finally:
        ready.unpersist()
    table = train.sparkSession.createDataFrame(log, "draw int, settings string, ks double")
    return model, table.withColumn("best", F.col("draw") == F.lit(best))


def predictions(model: CreditModel, df: DataFrame, label: str = LABEL, keys: Sequence[str] = ("loan_id", "vintage_q")) -> DataFrame:
    """(loan_id, vintage_q, y_true, y_pred); the loan key always travels along."""
    labelled = df.withColumn("y_true", F.col(label).cast("int"))
    return model.score(labelled, [*keys, "y_true"], out="y_pred")


def feature_importance(model: CreditModel) -> DataFrame:
    """(feature, gain, split, monotone): normalised gain and number of splits."""
    booster = model.pipeline.stages[-1]
    names = [*model.numeric, *model.categorical]
    uses = Counter(int(i) for i in re.findall(r"If \(feature (\d+)", booster.toDebugString))
    gains = booster.featureImportances.toArray()
    rows = [(n, float(gains[i]), uses.get(i, 0), MONOTONE_DIRECTIONS.get(n, 0)) for i, n in enumerate(names)]
    spark = SparkSession.getActiveSession()
    table = spark.createDataFrame(rows, "feature string, gain double, split int, monotone int")
    return table.orderBy(F.desc("gain"), "feature")
