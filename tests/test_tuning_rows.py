import threading
from dataclasses import replace
from datetime import timedelta

import pytest
from panel_helpers import panel
from pyspark.ml.regression import GBTRegressor

from gridpulse.operators import features, modeling
from gridpulse.operators.tuning import Range
from gridpulse.plans import queries
from gridpulse.sources.panels import PANEL

SF_DIR = "/root/testdata/sf0.001"
SMALL = replace(PANEL, max_lag=6, step=2, lookback=timedelta(days=3))


def small_frame(spark):
    rows = [(s, h, 10 + (h * k) % 17 + h % 5) for s, k in (("a", 3), ("b", 5)) for h in range(120)]
    return features.feature_frame(panel(spark, rows), SMALL)


def test_tuning_jobs_have_tasks_by_rows(spark, monkeypatch):
    seen = []

    def tune(frame, *args, **kwargs):
        seen.append((frame.rdd.getNumPartitions(), sorted(map(repr, frame.collect()))))
        raise InterruptedError

    monkeypatch.setattr(modeling, "tune", tune)
    with pytest.raises(InterruptedError):
        queries.REGISTRY["tuning_trials"](spark, SF_DIR)
    [(partitions, rows)] = seen
    assert partitions == 1
    assert rows == sorted(map(repr, queries.type_frame(spark, SF_DIR).collect()))


@pytest.mark.parametrize("task_rows, partitions", [(1000, 1), (100, 3), (10, 8)])
def test_compact_keeps_every_row(spark, task_rows, partitions):
    frame = small_frame(spark).unionByName(small_frame(spark).limit(40)).repartition(8).persist()
    before = sorted(map(repr, frame.collect()))
    packed = modeling.compact(frame, task_rows)
    assert packed.rdd.getNumPartitions() == partitions and packed.is_cached and not frame.is_cached
    assert sorted(map(repr, packed.collect())) == before
    packed.unpersist()


def test_compact_of_no_rows(spark):
    packed = modeling.compact(small_frame(spark).where("false").persist())
    assert packed.count() == 0 and packed.columns == small_frame(spark).columns
    packed.unpersist()


def test_trials_share_the_workers_and_keep_their_order(spark, monkeypatch):
    frame = modeling.compact(small_frame(spark).persist())
    space = {"maxDepth": Range(1, 4, whole=True), "stepSize": Range(0.05, 0.9)}
    candidate = modeling.Candidate("boosted", GBTRegressor, {"maxIter": 3, "seed": 1}, space)
    alone = [modeling.walk_forward(frame, candidate, SMALL, 3, p) for p in modeling.draw_params(candidate, 3, 5)]
    fit, lock, running, most = modeling._fit_fold, threading.Lock(), set(), []

    def watched(data, pipeline, spec, bounds, patience=None):
        me = (pipeline.uid, bounds["fold"])
        with lock:
            running.add(me)
            most.append((len(running), len({uid for uid, _ in running})))
        try:
            return fit(data, pipeline, spec, bounds, patience)
        finally:
            with lock:
                running.discard(me)

    monkeypatch.setattr(modeling, "_fit_fold", watched)
    best, trials = modeling.tune(frame, candidate, SMALL, n_trials=3, k=3, seed=5, parallelism=2)
    assert [t.fold_scores for t in trials] == [t.fold_scores for t in alone]
    assert [t.params for t in trials] == [t.params for t in alone]
    assert best.params == min(trials, key=lambda t: t.rmse).params and best.rmse == min(t.rmse for t in trials)
    assert max(n for n, _ in most) == 2 and max(n for _, n in most) == 2
    frame.unpersist()
