"""Training, selection, tuning and lineage of Spark ML regressors."""

from __future__ import annotations

import random
import uuid
from collections.abc import Callable
from concurrent.futures import Executor, ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.timegrid import ntz, shift
from gridpulse.operators.evaluate import evaluation_metrics
from gridpulse.operators.ridge import FoldMoments, fold_moments
from gridpulse.operators.split import fold_boundaries
from gridpulse.operators.tuning import Range, search
from gridpulse.sources.manifest import Manifest
from gridpulse.sources.tables import append_plain, cut_lineage
from gridpulse.spec import LINEAGE_SCHEMA, SeriesSpec

VECTOR = "_features"
VALIDATION = "_validation"
#: A tree level is one job over all rows; with fewer rows a task, starting tasks costs more than their work.
TASK_ROWS = 16_384


@dataclass(frozen=True)
class Candidate:
    """A kind of regressor, its fixed parameters and its search space.

    ``early_stopping`` lets Spark stop boosting; ``patience`` stops it in its place after so many rounds
    without gain on the validation part. ``penalty`` names the parameter of a linear model whose folds
    are scored from moments.
    """

    name: str
    estimator: type
    base: dict[str, Any] = field(default_factory=dict)
    space: dict[str, Callable[[random.Random], Any]] = field(default_factory=dict)
    early_stopping: bool = False
    penalty: str | None = None
    patience: int | None = None

    def build(
        self, spec: SeriesSpec, params: dict[str, Any] | None = None, validated: bool = True
    ) -> Pipeline:
        """``validated``: the rows flag a validation part, on which early stopping may look."""
        settings = {**self.base, **(params or {})}
        if self.early_stopping and validated and self.patience is None:
            settings["validationIndicatorCol"] = VALIDATION
        regressor = self.estimator(
            featuresCol=VECTOR, labelCol=spec.target_col, predictionCol="yhat", **settings
        )
        assembler = VectorAssembler(inputCols=spec.feature_names, outputCol=VECTOR)
        return Pipeline(stages=[assembler, regressor])


def require_checkpoint_dir(spark: SparkSession) -> None:
    """Boosting cuts its lineage into ``spark.checkpoint.dir``; a cluster without it fails at once."""
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            spark.sparkContext.setCheckpointDir(configured)
        elif not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")


def default_candidates(seed: int = 0) -> list[Candidate]:
    """Gradient-boosted trees, a random forest and ridge, with the ranges searched by ``tune``."""
    return [
        Candidate(
            name="GBTRegressor",
            estimator=GBTRegressor,
            base={"lossType": "squared", "maxIter": 100, "seed": seed, "cacheNodeIds": True},
            space={
                "maxIter": Range(100, 500, whole=True),
                "maxDepth": Range(3, 10, whole=True),
                "stepSize": Range(0.01, 0.3),
                "minInstancesPerNode": Range(5, 300, whole=True),
            },
            early_stopping=True,
        ),
        Candidate(
            name="RandomForestRegressor",
            estimator=RandomForestRegressor,
            base={"numTrees": 100, "seed": seed, "cacheNodeIds": True},
            space={
                "numTrees": Range(100, 500, whole=True),
                "maxDepth": Range(3, 10, whole=True),
                "minInstancesPerNode": Range(5, 300, whole=True),
            },
        ),
        Candidate(
            name="LinearRegression",
            estimator=LinearRegression,
            base={"solver": "normal", "standardization": False, "regParam": 1.0},
            space={"regParam": Range(1e-3, 1e4, log=True)},
            penalty="regParam",
        ),
    ]


@dataclass
class Trained:
    """A fitted model with its mean validation RMSE and what led to it."""

    candidate: Candidate
    params: dict[str, Any]
    model: PipelineModel | None
    rmse: float
    fold_scores: list[dict[str, Any]]
    untuned_rmse: float | None = None


def training_columns(frame: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows a regressor can be fitted on: a null or NaN label is left out."""
    return frame.select(*spec.key, *spec.feature_names, spec.target_col).where(
        F.col(spec.target_col).isNotNull() & ~F.isnan(spec.target_col)
    )


def compact(frame: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """The rows of a cached frame, cached anew without its lineage and in partitions of about ``task_rows``.

    Boosting runs jobs by the thousand over the same rows: each has a task for every partition, and its
    plan is compared with the cached one, which takes long for plans of many joins and windows. A frame
    of fewer partitions keeps them.
    """
    partitions = max(1, -(-frame.count() // task_rows))
    packed = cut_lineage(frame.coalesce(partitions)).persist()
    packed.count()
    frame.unpersist()
    return packed


def stopping_round(losses: list[float], patience: int) -> int:
    """Rounds to keep: up to the least loss before ``patience`` rounds in a row brought no gain."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def staged_losses(model: PipelineModel, rows: DataFrame) -> list[float]:
    """Mean squared error of a boosted model after each of its rounds, from one pass over ``rows``."""
    assembled = model.stages[0].transform(rows)
    return model.stages[-1].evaluateEachIteration(assembled, "squared")


def fit_with_patience(
    train: DataFrame, validation: DataFrame, pipeline: Pipeline, patience: int
) -> tuple[PipelineModel, int]:
    """A boosted model of the rounds that patience keeps, and their number.

    All rounds are fitted once and scored in one pass. Boosting is seeded, so fitting again with fewer
    rounds gives the first trees of the same model.
    """
    full = pipeline.fit(train)
    kept = stopping_round(staged_losses(full, validation), patience)
    if kept == full.stages[-1].getNumTrees:
        return full, kept
    assembler, regressor = pipeline.getStages()
    return Pipeline(stages=[assembler, regressor.copy({regressor.maxIter: kept})]).fit(train), kept


def _fit_fold(
    frame: DataFrame, pipeline: Pipeline, spec: SeriesSpec, bounds: dict[str, Any], patience: int | None = None
) -> tuple[PipelineModel, dict[str, Any]]:
    ts = F.col(spec.time_col)
    train_end, fold_end = ntz(bounds["train_end"]), ntz(bounds["fold_end"])
    part = frame.where(ts <= fold_end).withColumn(VALIDATION, ts > train_end)
    regressor = pipeline.getStages()[-1]
    stops_early = regressor.hasParam("validationIndicatorCol") and regressor.isDefined(
        "validationIndicatorCol"
    )
    if patience is None:
        fitted = pipeline.fit(part if stops_early else part.where(~F.col(VALIDATION)))
    else:
        fitted, _ = fit_with_patience(part.where(~F.col(VALIDATION)), part.where(VALIDATION), pipeline, patience)
    scored = fitted.transform(part.where(VALIDATION))
    metrics = evaluation_metrics(scored, spec.target_col, "yhat").first()
    return fitted, {**bounds, "r2": metrics["r2"], "rmse": metrics["rmse"]}


def collect_folds(frame: DataFrame, spec: SeriesSpec, k: int) -> list[dict[str, Any]]:
    """The ``k`` fold bounds on the driver; every validation part must hold at least one time."""
    rows = fold_boundaries(frame, spec, k).orderBy("fold").collect()
    folds = [row.asDict() for row in rows]
    if len(folds) < k or any(f["train_end"] >= f["fold_end"] for f in folds):
        raise ValueError(f"too few timestamps for {k} folds")
    return folds


def walk_forward(
    frame: DataFrame,
    candidate: Candidate,
    spec: SeriesSpec,
    k: int = 5,
    params: dict[str, Any] | None = None,
    folds: list[dict[str, Any]] | None = None,
    parallelism: int = 4,
    refit_all: bool = False,
    moments: FoldMoments | None = None,
    pool: Executor | None = None,
) -> Trained:
    """Fit on each fold's train part, score on its validation part, average the RMSE.

    The returned model is the last fold's; with ``refit_all`` it is fitted on all rows, with as many
    trees as the last fold kept. Folds are independent jobs on one cached frame, submitted
    ``parallelism`` at a time or as ``pool`` takes them. Folds of a linear model are scored from ``moments``, which are gathered
    in one pass if they are not given; given moments leave the model out.
    """
    if candidate.penalty:
        return _walk_forward_linear(frame, candidate, spec, k, params, folds, refit_all, moments)
    require_checkpoint_dir(frame.sparkSession)
    data = training_columns(frame, spec)
    folds = folds or collect_folds(data, spec, k)
    pipeline = candidate.build(spec, params)
    with nullcontext(pool) if pool else ThreadPoolExecutor(max_workers=parallelism) as workers:
        fitted = list(workers.map(lambda bounds: _fit_fold(data, pipeline, spec, bounds, candidate.patience), folds))
    model = fitted[-1][0]
    if refit_all:
        kept = getattr(model.stages[-1], "getNumTrees", None)
        stops = candidate.early_stopping or candidate.patience is not None
        trees = {"maxIter": kept} if stops and kept else {}
        model = candidate.build(spec, {**(params or {}), **trees}, validated=False).fit(data)
    scores = [score for _, score in fitted]
    rmse = sum(score["rmse"] for score in scores) / len(scores)
    return Trained(candidate, {**candidate.base, **(params or {})}, model, rmse, scores)


def _walk_forward_linear(
    frame: DataFrame,
    candidate: Candidate,
    spec: SeriesSpec,
    k: int,
    params: dict[str, Any] | None,
    folds: list[dict[str, Any]] | None,
    refit_all: bool,
    moments: FoldMoments | None,
) -> Trained:
    settings = {**candidate.base, **(params or {})}
    model = None
    if moments is None:
        data = training_columns(frame, spec)
        folds = folds or collect_folds(data, spec, k)
        moments = fold_moments(data, spec.feature_names, spec, folds)
        last = data if refit_all else data.where(F.col(spec.time_col) <= ntz(folds[-1]["train_end"]))
        model = candidate.build(spec, params).fit(last)
    scores = moments.scores(settings[candidate.penalty], by_spread=True)
    rmse = sum(score["rmse"] for score in scores) / len(scores)
    return Trained(candidate, settings, model, rmse, scores)


def select_model(
    frame: DataFrame,
    spec: SeriesSpec,
    candidates: list[Candidate] | None = None,
    k: int = 5,
    parallelism: int = 4,
) -> tuple[Trained, list[Trained]]:
    """The candidate with the lowest mean RMSE (the first of equals), and all of them."""
    folds = collect_folds(training_columns(frame, spec), spec, k)
    trained = [
        walk_forward(frame, candidate, spec, folds=folds, parallelism=parallelism)
        for candidate in candidates or default_candidates()
    ]
    return min(trained, key=lambda t: t.rmse), trained


def draw_params(candidate: Candidate, n_trials: int, seed: int) -> list[dict[str, Any]]:
    rng = random.Random(seed)
    return [{name: draw(rng) for name, draw in candidate.space.items()} for _ in range(n_trials)]


def tune(
    frame: DataFrame,
    candidate: Candidate,
    spec: SeriesSpec,
    n_trials: int = 20,
    k: int = 5,
    seed: int = 0,
    parallelism: int = 4,
    untuned_rmse: float | None = None,
) -> tuple[Trained, list[Trained]]:
    """Seeded random search; the best trial is refitted and adopted, even if no better than before.

    ``parallelism`` folds are fitted at a time, whichever trials they belong to.
    """
    data = training_columns(frame, spec)
    folds = collect_folds(data, spec, k)
    moments = fold_moments(data, spec.feature_names, spec, folds) if candidate.penalty else None
    with ThreadPoolExecutor(max_workers=parallelism) as pool, ThreadPoolExecutor(max_workers=parallelism) as some:

        def trial(params: dict[str, Any]) -> Trained:
            return walk_forward(frame, candidate, spec, params=params, folds=folds, moments=moments, pool=pool)

        trials = list(some.map(trial, draw_params(candidate, n_trials, seed)))
    best = min(trials, key=lambda t: t.rmse)
    final = walk_forward(
        frame, candidate, spec, params=best.params, folds=folds, parallelism=parallelism
    )
    final.untuned_rmse = untuned_rmse
    return final, trials


def tune_adaptive(
    frame: DataFrame,
    candidate: Candidate,
    spec: SeriesSpec,
    n_trials: int = 20,
    k: int = 5,
    seed: int = 0,
    per_round: int = 4,
    parallelism: int = 4,
    untuned_rmse: float | None = None,
) -> tuple[Trained, list[Trained]]:
    """As :func:`tune`, but each round of trials is proposed from what the rounds before found.

    ``per_round`` trials run at the same time, each with its folds.
    """
    data = training_columns(frame, spec)
    folds = collect_folds(data, spec, k)
    moments = fold_moments(data, spec.feature_names, spec, folds) if candidate.penalty else None
    done: dict[str, Trained] = {}

    def loss(params: dict[str, Any]) -> float:
        trial = walk_forward(
            frame, candidate, spec, params=params, folds=folds, parallelism=parallelism, moments=moments
        )
        done[repr(params)] = trial
        return trial.rmse

    history = search(loss, candidate.space, n_trials, seed, per_round)
    best, _ = min(history, key=lambda trial: trial[1])
    final = walk_forward(frame, candidate, spec, params=best, folds=folds, parallelism=parallelism)
    final.untuned_rmse = untuned_rmse
    return final, [done[repr(params)] for params, _ in history]


def scores_table(frame: DataFrame, trained: list[Trained]) -> DataFrame:
    """Fold scores of several training runs as a small table."""
    rows = [
        (number, t.candidate.name, s["fold"], s["train_end"], s["fold_end"], s["r2"], s["rmse"], t.rmse)
        for number, t in enumerate(trained, start=1)
        for s in t.fold_scores
    ]
    return frame.sparkSession.createDataFrame(
        rows,
        "run INT, name STRING, fold INT, train_end TIMESTAMP_NTZ, fold_end TIMESTAMP_NTZ, "
        "r2 DOUBLE, rmse DOUBLE, mean_rmse DOUBLE",
    )


def model_lineage(
    frame: DataFrame,
    spec: SeriesSpec,
    name: str,
    data_location: str,
    params: dict[str, Any],
    rmse: float | None,
    when_trained: datetime,
    untuned_rmse: float | None = None,
) -> DataFrame:
    """One row that says which model was trained on what.

    ``data_start`` is the first observation behind the first feature row; ``data_end`` is
    ``data_start`` plus the look-back; ``data_max`` is the true last time.
    """
    if when_trained.tzinfo is None:
        raise ValueError("when_trained must be zone-aware")
    start = shift(F.min(spec.time_col), -spec.max_lag * spec.every)
    recorded = [F.lit(value).alias(key) for key, value in params.items()]
    moment = when_trained.astimezone(timezone.utc).replace(microsecond=0)
    return frame.agg(
        start.alias("data_start"), F.max(spec.time_col).alias("data_max")
    ).select(
        F.lit(name).alias("name"),
        F.lit(data_location).alias("data_location"),
        "data_start",
        shift(F.col("data_start"), spec.lookback).alias("data_end"),
        "data_max",
        F.timestamp_seconds(F.lit(int(moment.timestamp()))).alias("when_trained"),
        (F.to_json(F.struct(*recorded)) if recorded else F.lit("{}")).alias("params"),
        F.lit(rmse).cast("double").alias("rmse"),
        F.lit(untuned_rmse).cast("double").alias("untuned_rmse"),
    )


def lineage_newest_first(lineage: DataFrame) -> DataFrame:
    """Lineage rows, newest training first."""
    return lineage.orderBy(F.col("when_trained").desc(), "name")


def save_model(model: PipelineModel, path: str) -> None:
    """Store a model beside earlier ones and make it the current one at once.

    A reader finds the model before or this one, whole; the two newest are kept.
    """
    manifest = Manifest(SparkSession.getActiveSession(), path)
    version = manifest.latest()
    name = uuid.uuid4().hex
    model.write().save(f"{path}/models/{name}")
    manifest.publish(version, {"model": name})
    manifest.forget(2)
    named = {manifest.read(v)["model"] for v in manifest.versions()}
    for old in set(manifest.children("models")) - named:
        manifest.remove(f"models/{old}")


def model_exists(spark: SparkSession, path: str) -> bool:
    return Manifest(spark, path).latest() > 0


def load_model(path: str) -> PipelineModel:
    """The current model."""
    manifest = Manifest(SparkSession.getActiveSession(), path)
    return PipelineModel.load(f"{path}/models/{manifest.read(manifest.latest())['model']}")


def train_and_record(
    frame: DataFrame,
    spec: SeriesSpec,
    model_path: str,
    lineage_path: str,
    data_location: str,
    candidates: list[Candidate] | None = None,
    k: int = 5,
    n_trials: int = 20,
    seed: int = 0,
    now: datetime | None = None,
) -> PipelineModel:
    """Select, tune, save and record a model. A frame that is not cached is, while it is being read."""
    own = frame.storageLevel == StorageLevel.NONE
    frame = frame.persist() if own else frame
    try:
        chosen, _ = select_model(frame, spec, candidates, k)
        tuned, _ = tune(
            frame, chosen.candidate, spec, n_trials, k, seed, untuned_rmse=chosen.rmse
        )
        record = model_lineage(
            frame,
            spec,
            tuned.candidate.name,
            data_location,
            tuned.params,
            tuned.rmse,
            now or datetime.now(timezone.utc),
            tuned.untuned_rmse,
        )
        save_model(tuned.model, model_path)
        append_plain(record, lineage_path)
    finally:
        if own:
            frame.unpersist()
    return tuned.model


def get_or_build_model(frame: DataFrame, spec: SeriesSpec, model_path: str, **training: Any) -> PipelineModel:
    """Load the stored model; train and store one if there is none."""
    if model_exists(frame.sparkSession, model_path):
        return load_model(model_path)
    return train_and_record(frame, spec, model_path, **training)


def read_lineage(frame_session, path: str) -> DataFrame:
    return lineage_newest_first(frame_session.read.schema(LINEAGE_SCHEMA).parquet(path))
