import random
import statistics

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor

from gridpulse.operators import modeling, tuning
from gridpulse.operators.tuning import Range
from gridpulse.plans import queries
from gridpulse.sources.panels import PANEL

SF_DIR = "/root/testdata/sf0.001"
SPACE = {"a": Range(0, 10), "b": Range(1e-3, 1e3, log=True), "c": Range(5, 300, whole=True)}


def bowl(params):
    return (params["a"] - 7) ** 2 + (SPACE["b"].place(params["b"]) * 6 - 1) ** 2 + ((params["c"] - 40) / 50) ** 2


def test_ranges():
    rng = random.Random(0)
    for span in SPACE.values():
        drawn = [span(rng) for _ in range(500)]
        assert all(span.low <= v < span.high for v in drawn)
        for v in drawn[:50]:
            assert 0 <= span.place(v) <= 1
            assert span.at(span.place(v)) == pytest.approx(v, abs=1 if span.whole else 1e-9)
    assert SPACE["c"].at(1.0) == 299 and SPACE["c"].at(-1) == 5


@pytest.mark.parametrize("places", [[], [0.5], [0.0, 1.0], [0.1, 0.11, 0.12, 0.9]])
def test_density_is_one_in_all(places):
    steps = 4000
    assert sum(tuning.density((i + 0.5) / steps, places) for i in range(steps)) / steps == pytest.approx(1, abs=2e-3)


def test_better_than_random():
    adaptive, plain = [], []
    for seed in range(15):
        adaptive.append(min(v for _, v in tuning.search(bowl, SPACE, 60, seed, per_round=1)))
        rng = random.Random(seed)
        plain.append(min(bowl({n: span(rng) for n, span in SPACE.items()}) for _ in range(60)))
    assert statistics.median(adaptive) < 0.6 * statistics.median(plain)


def test_seeded_whatever_runs_first():
    one = tuning.search(bowl, SPACE, 20, 3, per_round=4)
    assert one == tuning.search(bowl, SPACE, 20, 3, per_round=4)
    assert one != tuning.search(bowl, SPACE, 20, 4, per_round=4)
    assert all(isinstance(p["c"], int) for p, _ in one)


def test_proposals_equal_a_plain_version():
    history = tuning.search(bowl, SPACE, 20, 1)
    rng, check = random.Random(9), random.Random(9)
    got = tuning.propose(history, SPACE, rng)
    ranked = sorted(history, key=lambda t: t[1])
    for name, span in SPACE.items():
        good = [span.place(p[name]) for p, _ in ranked[:5]]
        bad = [span.place(p[name]) for p, _ in ranked[5:]]
        best = None
        for _ in range(tuning.DRAWS):
            place = tuning.draw(good, check)
            ratio = tuning.density(place, good) / tuning.density(place, bad)
            if best is None or ratio > best[0]:
                best = ratio, place
        assert got[name] == span.at(best[1])


def test_tuned_ridge(spark):
    frame = queries.type_frame(spark, SF_DIR).persist()
    linear = next(c for c in modeling.default_candidates() if c.penalty)
    best, trials = modeling.tune_adaptive(frame, linear, PANEL, n_trials=12, seed=1)
    assert len(trials) == 12 and best.rmse == min(t.rmse for t in trials)


@pytest.mark.parametrize("losses, patience, kept", [
    ([5, 4, 3, 2], 1, 4), ([5, 4, 4.5, 3], 1, 2), ([5, 4, 4.5, 3], 2, 4), ([1, 1, 1], 2, 1), ([3], 5, 1), ([5, 4, 6, 6, 6, 1], 3, 2),
])
def test_stopping_round(losses, patience, kept):
    assert modeling.stopping_round(losses, patience) == kept


def test_patience_equals_fitting_every_number_of_rounds(spark):
    frame = modeling.training_columns(queries.type_frame(spark, SF_DIR), PANEL).persist()
    folds = modeling.collect_folds(frame, PANEL, 3)
    candidate = modeling.Candidate(
        "boosted", GBTRegressor, base={"maxIter": 7, "maxDepth": 4, "stepSize": 0.9, "seed": 1}, patience=2
    )
    bounds = folds[0]
    train = frame.where(frame.ts <= bounds["train_end"])
    valid = frame.where((frame.ts > bounds["train_end"]) & (frame.ts <= bounds["fold_end"]))
    score = RegressionEvaluator(labelCol="y", predictionCol="yhat", metricName="mse")
    brute = [score.evaluate(candidate.build(PANEL, {"maxIter": r}).fit(train).transform(valid)) for r in range(1, 8)]
    pipeline = candidate.build(PANEL)
    staged = modeling.staged_losses(pipeline.fit(train), valid)
    assert staged == pytest.approx(brute, rel=1e-9)
    model, kept = modeling.fit_with_patience(train, valid, pipeline, 2)
    assert kept == modeling.stopping_round(brute, 2) == model.stages[-1].getNumTrees
    run = modeling.walk_forward(frame, candidate, PANEL, folds=folds[:1])
    assert run.model.stages[-1].getNumTrees == kept
