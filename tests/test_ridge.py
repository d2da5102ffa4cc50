import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.operators import modeling, ridge
from gridpulse.operators.ridge import Moments
from gridpulse.plans import queries
from gridpulse.sources.panels import PANEL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frame(spark):
    return queries.type_frame(spark, SF_DIR).persist()


def ridge_candidate():
    return next(c for c in modeling.default_candidates() if c.penalty)


def test_merged_moments_equal_direct_ones():
    rng = np.random.default_rng(1)
    values = rng.normal(1e6, 3, (500, 4))
    parts = [Moments.of(v) for v in np.split(values, [0, 1, 7, 200, 200])]
    merged = sum(parts, Moments.none(4))
    direct = Moments.of(values)
    assert merged.n == 500
    np.testing.assert_allclose(merged.means, direct.means, rtol=1e-14)
    np.testing.assert_allclose(merged.products, direct.products, rtol=1e-7, atol=1e-6)


@pytest.mark.parametrize("penalty", [0.0, 0.3, 100.0])
def test_scores_equal_direct_fit(penalty):
    rng = np.random.default_rng(2)
    x = rng.normal(50, 5, (300, 3))
    y = x @ [1.0, -2.0, 0.5] + 7 + rng.normal(0, 1, 300)
    train, valid = slice(0, 200), slice(200, 300)
    centred, mean = x[train] - x[train].mean(0), y[train].mean()
    weights = np.linalg.solve(centred.T @ centred + 200 * penalty * np.eye(3), centred.T @ (y[train] - mean))
    error = y[valid] - mean - (x[valid] - x[train].mean(0)) @ weights
    rows = np.column_stack([x, y])
    got = Moments.of(rows[valid]).scores(*Moments.of(rows[train]).fit(penalty))
    assert got["rmse"] == pytest.approx(np.sqrt((error**2).mean()), abs=1e-4)
    assert got["r2"] == pytest.approx(1 - (error**2).sum() / ((y[valid] - y[valid].mean()) ** 2).sum(), abs=1e-4)


def test_constant_label_and_no_rows():
    flat = Moments.of(np.array([[1.0, 5.0], [2.0, 5.0]]))
    assert flat.scores(np.array([0.0]), 5.0) == {"r2": None, "rmse": 0.0}
    assert Moments.none(2).scores(np.array([0.0]), 0.0) == {"r2": None, "rmse": None}


def test_equals_fitting_every_fold(frame):
    candidate = ridge_candidate()
    run = modeling.walk_forward(frame, candidate, PANEL)
    data = modeling.training_columns(frame, PANEL)
    pipeline = candidate.build(PANEL)
    for score in run.fold_scores:
        bounds = {c: score[c] for c in ("fold", "train_end", "fold_end")}
        _, fitted = modeling._fit_fold(data, pipeline, PANEL, bounds)
        assert fitted["rmse"] == pytest.approx(score["rmse"], rel=1e-4)
        assert fitted["r2"] == pytest.approx(score["r2"], abs=2e-4)
    assert run.model.transform(frame).where(F.col("yhat").isNull()).isEmpty()


def test_one_job_gathers_all_folds(spark, frame):
    folds = modeling.collect_folds(frame, PANEL, 5)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("moments", "moments")
    try:
        moments = ridge.fold_moments(frame, queries.RIDGE_FEATURES, PANEL, folds)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # Adaptive execution runs the stage before the exchange as a job of its own.
    assert len(tracker.getJobIdsForGroup("moments")) <= 2
    sizes = [m.n for m in moments.train]
    assert sizes == sorted(sizes) and min(m.n for m in moments.validation) > 0


def test_null_and_nan_rows_are_left_out(spark, frame):
    folds = modeling.collect_folds(frame, PANEL, 5)
    odd = frame.limit(3).withColumn("lag_1", F.lit(float("nan"))).unionByName(frame.limit(2).withColumn("y", F.lit(None).cast("double")))
    names = queries.RIDGE_FEATURES
    with_odd = ridge.fold_moments(frame.unionByName(odd), names, PANEL, folds).scores(0.5)
    assert with_odd == ridge.fold_moments(frame, names, PANEL, folds).scores(0.5)


def test_tuning_passes_over_the_rows_once(frame, monkeypatch):
    calls = []
    original = modeling.fold_moments
    monkeypatch.setattr(modeling, "fold_moments", lambda *a: calls.append(1) or original(*a))
    best, trials = modeling.tune(frame, ridge_candidate(), PANEL, n_trials=8, seed=3)
    assert len(calls) == 2 and len(trials) == 8
    assert best.rmse == min(t.rmse for t in trials) and best.model is not None
