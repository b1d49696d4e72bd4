"""Classifiers, training, the experiment grid and model persistence.

Each classifier of the reference is an exact objective:

* logistic regression (liblinear, C, balanced): |w|^2 / 2 + C * sum of weighted
  logistic losses, the intercept penalised as a constant feature;
* linear SVC: the same with the squared hinge; no probabilities;
* SGD log-loss (alpha, balanced): alpha / 2 * |w|^2 + the weighted mean of the
  logistic loss, free intercept - the optimum that stochastic steps approach;
* complement naive Bayes (alpha): ``NaiveBayes(modelType="complement")``.

The first three are fitted by ``operators.linear``: all linear models of a
variant share one scan of the rows per solver round, and the gradient norm at
the end is reported.  Fitted weights become Spark ML models, so scoring,
persistence and streams are Spark's own.  Features are fitted once per variant
and written once; the variants run concurrently from a thread pool.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel, NaiveBayes
from pyspark.ml.common import _py2java
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.ml.wrapper import JavaParams
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.operators import features as feat
from polarity.operators import linear
from polarity.operators import metrics as mx
from polarity.operators.quality import require_columns
from polarity.session import materialize, merged, spread

# The reference's classifier settings.
MODEL_CONFIGS = {
    "logistic_regression": {"enabled": True, "class_weight": "balanced", "max_iter": 1000, "solver": "liblinear", "C": 1.0},
    "linear_svc": {"enabled": True, "class_weight": "balanced", "max_iter": 5000, "C": 1.0},
    "sgd_classifier": {"enabled": True, "loss": "log_loss", "penalty": "l2", "alpha": 0.0001,
                       "class_weight": "balanced", "max_iter": 1000, "random_state": 42},
    "complement_nb": {"enabled": True, "alpha": 1.0},
}

# Gradient norm, as a share of the norm at zero weights, at which a solver
# stops; ``tol`` in a model's settings overrides it.
DEFAULT_TOL = 1e-4

LABEL, TEXT, FEATURES = "sentiment", "clean_text", "features"
LINEAR = ("logistic_regression", "linear_svc", "sgd_classifier")


def class_counts(df: DataFrame, label: str = LABEL) -> dict:
    """Rows per label (k rows); B16: the positive class must be learnable."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    if 1 not in counts:
        raise ValueError("the training labels hold no positive class (1)")
    return counts


def linear_objective(name: str, cfg: dict, counts: dict) -> linear.Objective:
    """J13 for the linear models: the objective on rows with these label
    counts.  Balanced classes (J12) weigh n / (k * n_c)."""
    n, k = sum(counts.values()), len(counts)
    weight = {c: n / (k * m) for c, m in counts.items()} if cfg.get("class_weight") == "balanced" else {}
    positive = weight.get(1, 1.0)
    negative = next((w for c, w in weight.items() if c != 1), 1.0)
    if name in ("logistic_regression", "linear_svc"):
        loss = "logistic" if name == "logistic_regression" else "squared_hinge"
        return linear.Objective(loss, 1.0, float(cfg.get("C", 1.0)), negative=negative, positive=positive)
    if name == "sgd_classifier":
        if cfg.get("loss", "log_loss") != "log_loss" or cfg.get("penalty", "l2") != "l2":
            raise ValueError("sgd_classifier supports loss='log_loss' with penalty='l2'")
        return linear.Objective("logistic", float(cfg.get("alpha", 1e-4)), 1.0 / n, free_intercept=True,
                                negative=negative, positive=positive)
    raise ValueError(f"no such model: {name}")


def bayes_classifier(cfg: dict, label: str = LABEL) -> NaiveBayes:
    """Complement naive Bayes, unweighted."""
    return NaiveBayes(featuresCol=FEATURES, labelCol=label, modelType="complement", smoothing=float(cfg.get("alpha", 1.0)))


def both_classes(train: DataFrame, counts: dict, length: int, label: str = LABEL) -> DataFrame:
    """(label, features) with a row of zeros for a class that has no rows.

    Spark's naive Bayes has as many classes as it meets labels.  Cleaning can
    leave one (every text of the other is in conflict): its sums are zeros, and
    the model still tells 0 from 1."""
    rows = train.select(label, FEATURES)
    absent = [(c, SparseVector(length, [])) for c in (0, 1) if c not in counts]
    if not absent:
        return rows
    zeros = train.sparkSession.createDataFrame(absent, ["c", FEATURES])
    return rows.unionByName(zeros.select(F.col("c").cast(rows.schema[label].dataType).alias(label), FEATURES))


def linear_stage(name: str, fit: linear.Fit):
    """Fitted weights as a Spark ML model over the feature column."""
    kind = LinearSVCModel if name == "linear_svc" else LogisticRegressionModel
    java = JavaParams._new_java_obj(f"org.apache.spark.ml.classification.{kind.__name__}", f"{name}_{uuid.uuid4().hex[:12]}",
                                    _py2java(SparkSession.active().sparkContext, DenseVector(fit.weights)), float(fit.intercept))
    return kind(java).setFeaturesCol(FEATURES)


def check_training_frame(df: DataFrame, what: str, text: str = TEXT, label: str = LABEL) -> None:
    """C1/C2 for a training or validation frame (one aggregation)."""
    require_columns(df, [text, label], f"{what} data")
    row = df.agg(F.count_if(F.col(text).isNull()).alias("t"), F.count_if(F.col(label).isNull()).alias("l")).first()
    if row["t"]:
        raise ValueError(f"{what} rows lack {text}")
    if row["l"]:
        raise ValueError(f"{what} rows lack {label}")


def check_threshold(threshold: float) -> None:
    """A decision threshold is a probability."""
    if not 0.0 <= float(threshold) <= 1.0:
        raise ValueError(f"a threshold is a probability, not {threshold}")


def has_probability(model: PipelineModel) -> bool:
    last = model.stages[-1]
    return last.hasParam("probabilityCol") if hasattr(last, "hasParam") else False


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """One ``transform``: prediction plus (when available) both probabilities."""
    out = model.transform(df)
    if has_probability(model):
        arr = vector_to_array(F.col("probability"))
        out = out.withColumn("negative_probability", arr[0]).withColumn("positive_probability", arr[1])
    else:
        out = (out.withColumn("negative_probability", F.lit(None).cast("double"))
                  .withColumn("positive_probability", F.lit(None).cast("double")))
    return out.withColumn("prediction", F.col("prediction").cast("int"))


def evaluate_model(model: PipelineModel, df: DataFrame, threshold: float | None = None,
                   label: str = LABEL) -> tuple[DataFrame, DataFrame]:
    """E9 for a fitted model: (one-row metrics, predictions).

    With a threshold the decision is ``p >= t`` (never the model's strict
    ``p > 0.5``); models without probabilities cannot take a threshold.
    """
    require_columns(df, [label], "The evaluated table")
    preds = predict(model, df)
    if threshold is not None:
        check_threshold(threshold)
        if not has_probability(model):
            raise ValueError("a threshold needs a model with probabilities")
        preds = preds.withColumn("prediction", mx.decide(F.col("positive_probability"), threshold))
    return mx.evaluate(preds, label, "prediction", threshold), preds


@dataclass
class FittedVariant:
    name: str
    features: PipelineModel
    train: DataFrame
    validation: DataFrame
    counts: dict
    length: int
    seconds: float


@dataclass
class Trained:
    """One classifier on a variant: its stage, the seconds of its own work and,
    for a linear model, the solver's account."""
    stage: object
    seconds: float
    fit: linear.Fit | None = None


def prepare_variant(name: str, spec: feat.FeatureSpec, train: DataFrame, validation: DataFrame,
                    text: str = TEXT, label: str = LABEL, id_col: str = "row_id",
                    vocabs: dict | None = None, vocab_seconds: dict | None = None) -> FittedVariant:
    """Fit one feature variant and write train/validation vectors once.

    With shared ``vocabs`` the variant's time includes the fit time of the
    vocabularies it uses (as if fitted alone)."""
    t0 = time.perf_counter()
    train, validation = spread(train, id_col), spread(validation, id_col)
    fm = feat.fit_features(train, spec, text, FEATURES, id_col, vocabs)
    shared = sum((vocab_seconds or {}).get(p, 0.0) for p in spec.parts)
    counts = class_counts(train, label)
    tr = materialize(feat.drop_feature_intermediates(fm.transform(train)).select(id_col, label, FEATURES))
    va = materialize(feat.drop_feature_intermediates(fm.transform(validation)).select(id_col, label, FEATURES))
    # every solver round is one job over the vectors: partitions follow their
    # bytes, so small sets do not pay per-task overhead
    tr, va = merged(tr), merged(va)
    length = sum(s.getScalingVec().size for s in fm.stages if isinstance(s, ElementwiseProduct))
    return FittedVariant(name, fm, tr, va, counts, length, time.perf_counter() - t0 + shared)


def fit_classifiers(fv: FittedVariant, models: dict, label: str = LABEL) -> dict[str, Trained]:
    """Fit several classifiers on the written vectors of one variant: the
    linear ones together, one scan a round; naive Bayes in closed form.

    ``seconds`` of a linear model is the time its own sums took, over all
    tasks, so it doesn't depend on what else runs."""
    unknown = [m for m in models if m not in LINEAR and m != "complement_nb"]
    if unknown:
        raise ValueError(f"no such model: {unknown[0]}")
    objectives = {m: linear_objective(m, cfg, fv.counts) for m, cfg in models.items() if m in LINEAR}
    out = {}
    if objectives:
        data = merged(linear.blocks(fv.train, FEATURES, label))
        tol = {m: float(models[m].get("tol", DEFAULT_TOL)) for m in objectives}
        steps = {m: int(models[m].get("max_iter", 1000)) for m in objectives}
        for m, fit in linear.solve(data, fv.length, objectives, tol, steps).items():
            out[m] = Trained(linear_stage(m, fit), fit.task_seconds, fit)
    if "complement_nb" in models:
        t0 = time.perf_counter()
        stage = bayes_classifier(models["complement_nb"], label).fit(both_classes(fv.train, fv.counts, fv.length, label))
        out["complement_nb"] = Trained(stage, time.perf_counter() - t0)
    return {m: out[m] for m in models}


def pipeline_of(fv: FittedVariant, trained: Trained) -> PipelineModel:
    """Feature stages plus classifier: scores raw clean text."""
    return PipelineModel(stages=[*fv.features.stages, trained.stage])


def fit_classifier(fv: FittedVariant, model_name: str, cfg: dict, label: str = LABEL) -> tuple[PipelineModel, float]:
    """One classifier: (pipeline, seconds)."""
    trained = fit_classifiers(fv, {model_name: cfg}, label)[model_name]
    return pipeline_of(fv, trained), trained.seconds


def _vector_model(model: PipelineModel, fv: FittedVariant) -> PipelineModel:
    """The classifier part only (for written feature vectors)."""
    return PipelineModel(stages=model.stages[len(fv.features.stages):])


LEADERBOARD = ("experiment_name string, model_name string, tfidf_variant string, accuracy double, macro_precision double, "
               "macro_recall double, macro_f1 double, weighted_f1 double, negative_f1 double, positive_f1 double, "
               "training_time_seconds double, relative_gradient double")
METRICS = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1", "negative_f1", "positive_f1"]


def leaderboard(board: DataFrame) -> DataFrame:
    """G1: experiments by macro-F1, best first (ties: experiment name)."""
    return board.orderBy(F.col("macro_f1").desc(), "experiment_name")


def run_experiments(train: DataFrame, validation: DataFrame, models: dict | None = None,
                    variants: dict | None = None, parallelism: int = 8):
    """Every enabled model x feature variant, scored on validation only.

    Each distinct vectoriser is fitted once.  Variants run side by side; in a
    variant the linear models share their scans (``fit_classifiers``).
    Returns (leaderboard sorted by macro-F1, {experiment: fitted pipeline}).
    ``training_time_seconds`` = the variant's feature fit + the classifier's
    own work; ``relative_gradient`` = gradient norm at the end over that at
    zero (null for naive Bayes, which has a closed form).
    """
    check_training_frame(train, "train")
    check_training_frame(validation, "validation")
    models = MODEL_CONFIGS if models is None else models
    variants = feat.VARIANTS if variants is None else variants
    enabled = {m: c for m, c in models.items() if c.get("enabled", False)}
    if not enabled:
        raise ValueError("no model is enabled")
    workers = max(1, parallelism)
    configs = list(dict.fromkeys(p for spec in variants.values() for p in spec.parts))
    fit_train = spread(train, "row_id")

    def fit_vocab(cfg):
        t0 = time.perf_counter()
        return cfg, feat.fit_vocabulary_lists(fit_train, cfg, TEXT), time.perf_counter() - t0

    with ThreadPoolExecutor(max_workers=min(workers, len(configs))) as pool:
        fitted_vocabs = list(pool.map(fit_vocab, configs))
    vocabs = {cfg: v for cfg, v, _ in fitted_vocabs}
    vocab_seconds = {cfg: secs for cfg, _, secs in fitted_vocabs}

    def one_variant(item):
        fv = prepare_variant(item[0], item[1], train, validation, vocabs=vocabs, vocab_seconds=vocab_seconds)
        trained = fit_classifiers(fv, enabled)
        scored = {m: evaluate_model(PipelineModel(stages=[t.stage]), fv.validation)[0].first().asDict()
                  for m, t in trained.items()}
        return fv, trained, scored

    with ThreadPoolExecutor(max_workers=min(workers, len(variants))) as pool:
        done = list(pool.map(one_variant, variants.items()))
    rows, fitted = [], {}
    for fv, trained, scored in done:
        for m, t in trained.items():
            name = f"{m}__{fv.name}"
            fitted[name] = pipeline_of(fv, t)
            rows.append((name, m, fv.name, *[scored[m][c] for c in METRICS], float(fv.seconds + t.seconds),
                         t.fit.gradient if t.fit else None))
    return leaderboard(train.sparkSession.createDataFrame(rows, LEADERBOARD)), fitted


def select_best(board: DataFrame, metric: str = "macro_f1") -> dict:
    """Best experiment row (ties: experiment name)."""
    return mx.best_row(board, metric, "experiment_name").first().asDict()


def train_baseline(train: DataFrame, validation: DataFrame, spec: feat.FeatureSpec | None = None,
                   cfg: dict | None = None) -> tuple[PipelineModel, DataFrame]:
    """TF-IDF (1-2 grams) + logistic regression; (model, validation metrics)."""
    check_training_frame(train, "train")
    check_training_frame(validation, "validation")
    spec = spec or feat.VARIANTS["unigram_bigram"]
    fv = prepare_variant("baseline", spec, train, validation)
    model, _ = fit_classifier(fv, "logistic_regression", cfg or MODEL_CONFIGS["logistic_regression"])
    return model, evaluate_model(_vector_model(model, fv), fv.validation)[0]


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML persistence (a directory of metadata + parquet)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline; a missing path raises ``FileNotFoundError``."""
    try:
        return PipelineModel.load(path)
    except Exception as exc:  # Spark reports a missing path as an analysis/IO error
        text = str(exc)
        if "does not exist" in text or "FileNotFound" in text or "PATH_NOT_FOUND" in text:
            raise FileNotFoundError(f"Model file not found: {path}") from exc
        raise ValueError(f"{path} holds no readable model: {exc}") from exc
