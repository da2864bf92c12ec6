"""Classifier training and parameter search on MLlib."""

from __future__ import annotations

import ast
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from traceframe.functions.labels import first_maximum
from traceframe.operators.evaluation import outcome_counts, summary_metrics
from traceframe.operators.pruning import SplitSize
from traceframe.session import cut_lineage

FEATURES, LABEL, WEIGHT = "features", "label", "weight"
# Both use the weights of the whole training set, which are those of a resampled one on average.
FIT_ROWS = 20_000  # rows of a partition, where there are few
WEIGHTED = ("balanced", "balanced_subsample")


def assemble(df: DataFrame, columns: list[str], label: str = "class_label") -> DataFrame:
    """Feature vector and double label beside the existing columns."""
    ready = df.withColumn(LABEL, F.col(label).cast("double"))
    return VectorAssembler(inputCols=columns, outputCol=FEATURES, handleInvalid="error").transform(ready)


def _random_forest(p: dict, weighted: bool):
    est = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        numTrees=p.get("n_estimators", 100),
        maxDepth=min(30, p.get("max_depth", 15)),
        minInstancesPerNode=p.get("min_samples_leaf", 2),
        featureSubsetStrategy={None: "all"}.get(p.get("max_features", "sqrt"), p.get("max_features", "sqrt")),
        seed=42,
        cacheNodeIds=True,
    )
    return est.setWeightCol(WEIGHT) if weighted else est


def _decision_tree(p: dict, weighted: bool):
    if "max_features" in p:
        # One tree of a forest without resampling: the only tree of MLlib that draws features per split.
        return _random_forest({"max_depth": 15, "min_samples_leaf": 2, **p, "n_estimators": 1}, weighted).setBootstrap(False)
    est = DecisionTreeClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        maxDepth=min(30, p.get("max_depth", 15)),
        minInstancesPerNode=p.get("min_samples_leaf", 2),
        seed=42,
        cacheNodeIds=True,
    )
    return est.setWeightCol(WEIGHT) if weighted else est


def _logistic(p: dict, weighted: bool, n: int):
    est = LogisticRegression(
        featuresCol=FEATURES,
        labelCol=LABEL,
        family="multinomial",
        regParam=1.0 / (p.get("C", 1.0) * max(1, n)),
        elasticNetParam=1.0 if p.get("penalty", "l2") == "l1" else 0.0,
        standardization=False,
        maxIter=p.get("max_iter", 1000),
    )
    return est.setWeightCol(WEIGHT) if weighted else est


def _boosted(p: dict):
    # Boosting is binary in MLlib, so three classes go one against the rest.
    tree = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        maxIter=p.get("n_estimators", 100),
        maxDepth=min(30, p.get("max_depth", 5)),
        stepSize=p.get("learning_rate", 0.1),
        minInstancesPerNode=p.get("min_samples_leaf", 1),
        subsamplingRate=p.get("subsample", 1.0),
        seed=42,
    )
    return OneVsRest(classifier=tree, featuresCol=FEATURES, labelCol=LABEL, parallelism=3)


def estimator(model_type: str, params: dict | None = None, weighted: bool = True, n: int = 1):
    """One of RandomForest, DecisionTree, LogisticRegression, GradientBoosting.

    ``n`` is the number of training rows; the inverse regularisation strength
    ``C`` is relative to it.
    """
    p = params or {}
    if model_type in ("RandomForest", "DecisionTree"):
        tree = (_random_forest if model_type == "RandomForest" else _decision_tree)(p, weighted)
        return SplitSize(classifier=tree, minSplit=p.get("min_samples_split", 5))
    if model_type == "LogisticRegression":
        return _logistic(p, weighted, n)
    if model_type == "GradientBoosting":
        return _boosted(p)
    raise ValueError(f"unknown model type {model_type}")


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Append ``prediction`` and ``scores``: class probabilities of every model kind.

    A model without probabilities gives one raw score per class; each goes
    through a sigmoid and the results are divided by their sum.
    """
    out = model.transform(df)
    if "probability" in out.columns:
        return out.withColumn("scores", vector_to_array("probability"))
    raw = vector_to_array("rawPrediction")
    squashed = F.transform(raw, lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * x)))
    size = F.aggregate(squashed, F.lit(0.0), lambda a, x: a + x)
    scores = F.transform(squashed, lambda x: x / size)
    return out.withColumn("scores", scores).withColumn("prediction", first_maximum(scores).cast("double"))


def split_metrics(model: Model, df: DataFrame, split: str = "split") -> DataFrame:
    """Metrics of every split of one assembled table, in one pass."""
    counts = outcome_counts(predict(model, df), LABEL, "prediction", [split])
    return summary_metrics(counts, [split])


def importance(spark: SparkSession, model: Model, columns: list[str]) -> DataFrame:
    """Rows (feature, importance): tree importances or mean absolute coefficients."""
    if hasattr(model, "models"):
        parts = [m.featureImportances.toArray() for m in model.models]
        values = sum(parts) / len(parts)
    elif hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()).mean(axis=0)
    else:
        raise ValueError("model has no importances")
    # One row per feature column.
    return spark.createDataFrame([(c, float(v)) for c, v in zip(columns, values)], "feature string, importance double")


# Search space of every model type. (low, high) are whole numbers,
# (low, high, "log") and (low, high, "real") real ones, lists are choices.
SPACES: dict[str, dict] = {
    "RandomForest": {
        "n_estimators": (50, 300),
        "max_depth": (3, 20),
        "min_samples_split": (2, 20),
        "min_samples_leaf": (1, 10),
        "max_features": ["sqrt", "log2", None],
        "class_weight": ["balanced", "balanced_subsample", None],
    },
    "GradientBoosting": {
        "n_estimators": (50, 300),
        "max_depth": (2, 10),
        "learning_rate": (0.01, 0.3, "log"),
        "min_samples_leaf": (1, 10),
        "subsample": (0.6, 1.0, "real"),
    },
    "LogisticRegression": {
        "C": (0.001, 100.0, "log"),
        "penalty": ["l1", "l2"],
        "class_weight": ["balanced", None],
    },
    "DecisionTree": {
        "max_depth": (3, 30),
        "min_samples_split": (2, 20),
        "min_samples_leaf": (1, 10),
        "max_features": ["sqrt", "log2", None],
        "class_weight": ["balanced", None],
    },
}


def draw_parameters(model_type: str, trial: int, seed: int = 42, space: dict | None = None) -> dict:
    """The parameters of one trial, from hashes of seed, type, trial and name."""
    import hashlib

    out = {}
    for name, domain in (space or SPACES[model_type]).items():
        head = hashlib.md5(f"{seed}:{model_type}:{trial}:{name}".encode()).hexdigest()[:8]
        u = int(head, 16) / 2**32
        if isinstance(domain, list):
            out[name] = domain[int(u * len(domain))]
        elif len(domain) == 2:
            out[name] = domain[0] + int(u * (domain[1] - domain[0] + 1))
        elif domain[2] == "log":
            out[name] = domain[0] * (domain[1] / domain[0]) ** u
        else:
            out[name] = domain[0] + u * (domain[1] - domain[0])
    return out


@dataclass
class SearchResult:
    trials: DataFrame
    best_type: str
    best_params: dict
    best_score: float
    all_params: dict = field(default_factory=dict)

    def save(self, path: str) -> None:
        """Store all trials; the best one follows from them."""
        self.trials.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SearchResult:
        """Read trials, as many rows as were tried; of equal values the first type and trial win."""
        trials = spark.read.schema(TRIALS).parquet(path)
        rows = trials.collect()
        params = {(r["model_type"], r["trial"]): {k: _value(v) for k, v in r["params"].items()} for r in rows}
        types = list(SPACES)
        best = max(rows, key=lambda r: (r["value"], -types.index(r["model_type"]) if r["model_type"] in types else 0, -r["trial"]))
        return cls(trials, best["model_type"], params[(best["model_type"], best["trial"])], best["value"], params)

    def refit(self, df: DataFrame, n: int) -> Model:
        weighted = self.best_params.get("class_weight") in WEIGHTED
        return estimator(self.best_type, self.best_params, weighted, n).fit(df)


def _value(text: str):
    """A parameter from its stored text: a number, None or a word."""
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


TRIALS = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("trial", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    ]
)


def _set_parameters(base, tuned) -> dict:
    """What is set in ``tuned`` as a map over the parameters of ``base``."""
    return {getattr(base, q.name): tuned.getOrDefault(q) for q in tuned.params if tuned.isSet(q)}


def search(
    df: DataFrame,
    model_types: list[str],
    n_trials: int,
    fold: str = "fold",
    n_folds: int = 5,
    parallelism: int | None = None,
    seed: int = 42,
    spaces: dict | None = None,
) -> SearchResult:
    """Random search by k-fold weighted F1 over assembled rows with a fold column.

    The trials of one model type run through one cross-validator, so folds are cached once
    and fits run side by side, as many as there are cores (or ``parallelism``). Assembled rows of
    little data are gathered in few partitions, as each fit runs hundreds of short stages.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parallelism = parallelism or cores
    total = df.count()
    n = total * (n_folds - 1) // n_folds  # a fit sees all folds but one
    df = cut_lineage(df.coalesce(max(1, min(cores, -(-total // FIT_ROWS)))), "search")
    evaluator = MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction", metricName="f1")
    rows, best = [], None
    params_of = {}
    for model_type in model_types:
        for trial in range(n_trials):
            p = draw_parameters(model_type, trial, seed, (spaces or SPACES)[model_type])
            params_of[(model_type, trial)] = p
        # The cross-validator takes parameter maps of one estimator; every trial
        # is one map over the estimator's own parameters.
        base = estimator(model_type, {"max_features": None} if "max_features" in (spaces or SPACES)[model_type] else {}, False, n)
        maps = []
        for trial in range(n_trials):
            p = params_of[(model_type, trial)]
            tuned = estimator(model_type, p, p.get("class_weight") in WEIGHTED, n)
            if isinstance(tuned, SplitSize):
                maps.append({base.classifier: tuned.getClassifier(), base.minSplit: tuned.getOrDefault("minSplit")})
            elif model_type == "GradientBoosting":
                # A copy of OneVsRest keeps its own classifier and gives it the map, so the map names the classifier's parameters.
                maps.append(_set_parameters(base.getClassifier(), tuned.getClassifier()))
            else:
                maps.append(_set_parameters(base, tuned))
        cv = CrossValidator(
            estimator=base,
            estimatorParamMaps=maps,
            evaluator=evaluator,
            numFolds=n_folds,
            foldCol=fold,
            parallelism=parallelism,
        ).fit(df)
        for trial, value in enumerate(cv.avgMetrics):
            rows.append((model_type, trial, float(value), {k: str(v) for k, v in params_of[(model_type, trial)].items()}))
            # Strictly better only: a tie keeps the earlier type and trial.
            if best is None or value > best[2]:
                best = (model_type, trial, float(value))
    trials = df.sparkSession.createDataFrame(rows, TRIALS)
    return SearchResult(trials, best[0], params_of[best[:2]], best[2], params_of)
