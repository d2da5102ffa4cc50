from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from panel_helpers import HOUR, T0, as_dict, hours, panel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from gridpulse.operators import features, modeling
from gridpulse.operators.quality import QualityError
from gridpulse.plans import jobs
from gridpulse.sources.panels import PANEL
from gridpulse.sources.tables import read_table
from gridpulse.streaming.ingest import start_ingest

SMALL = replace(PANEL, max_lag=6, step=2, lookback=timedelta(days=3))


def predictor(df):
    return df.withColumn("yhat", F.expr("lag_1"))


@pytest.fixture
def tables(tmp_path):
    return jobs.Tables(
        *[str(tmp_path / name) for name in ("raw", "processed", "forecasts", "model", "lineage")]
    )


def write_raw(spark, tables, n=400):
    rows = [(s, h, 10 + (h * k) % 17) for s, k in (("a", 3), ("b", 5)) for h in range(n)]
    panel(spark, rows).write.mode("overwrite").parquet(tables.raw)


def test_jobs_end_to_end(spark, tables):
    write_raw(spark, tables)
    jobs.feature_job(spark, tables, SMALL, T0 + 80 * HOUR)
    processed = jobs.read_processed(spark, tables, SMALL)
    assert processed.count() == 2 * 73
    jobs.feature_job(spark, tables, SMALL, T0 + 80 * HOUR)
    assert jobs.read_processed(spark, tables, SMALL).count() == 2 * 73
    jobs.feature_job(spark, tables, SMALL, T0 + 83 * HOUR)
    processed = jobs.read_processed(spark, tables, SMALL)
    assert processed.count() == 2 * 76
    assert len(as_dict(processed)) == 2 * 76

    jobs.inference_job(spark, tables, SMALL, predictor)
    jobs.inference_job(spark, tables, SMALL, predictor)
    first = as_dict(jobs.read_forecasts(spark, tables, SMALL), "forecast")
    assert first == {(s, hours(84)): as_dict(processed)[(s, hours(83))] for s in ("a", "b")}

    assert jobs.backfill_job(spark, tables, SMALL, predictor) is False
    jobs.feature_job(spark, tables, SMALL, T0 + 88 * HOUR)
    jobs.inference_job(spark, tables, SMALL, predictor)
    assert jobs.backfill_job(spark, tables, SMALL, predictor) is True
    stored = as_dict(jobs.read_forecasts(spark, tables, SMALL), "forecast")
    observed = as_dict(jobs.read_processed(spark, tables, SMALL))
    assert stored == {
        (s, hours(h)): observed[(s, hours(h - 1))] for s in ("a", "b") for h in range(84, 90)
    }
    assert jobs.backfill_job(spark, tables, SMALL, predictor) is False


def test_failed_check_writes_nothing(spark, tables):
    panel(spark, [("a", 0, None), ("a", 1, 2)]).write.parquet(tables.raw)
    with pytest.raises(QualityError):
        jobs.feature_job(spark, tables, SMALL, T0 + HOUR)
    assert not jobs.table_exists(spark, tables.processed)


def tiny_candidates():
    return [
        modeling.Candidate("GBTRegressor", GBTRegressor, {"maxIter": 2, "maxDepth": 2, "seed": 1},
                           {"maxDepth": lambda rng: rng.randrange(1, 3)}, True),
        modeling.Candidate("RandomForestRegressor", RandomForestRegressor,
                           {"numTrees": 2, "maxDepth": 2, "seed": 1}, {}),
    ]


def test_monitor_trains_saves_and_records(spark, tables):
    write_raw(spark, tables, 200)
    jobs.feature_job(spark, tables, SMALL, T0 + 72 * HOUR)
    training = {"candidates": tiny_candidates(), "k": 2, "n_trials": 1}
    jobs.inference_job(
        spark, tables, SMALL, now=datetime(2025, 1, 4, tzinfo=timezone.utc), **training
    )
    assert jobs.read_forecasts(spark, tables, SMALL).count() == 2
    # Nothing passes a threshold above one, so a second model is trained.
    passed = jobs.monitor_job(
        spark, tables, SMALL, threshold=1.5, horizons=2,
        now=datetime(2025, 1, 5, tzinfo=timezone.utc), **training,
    )
    assert passed is False
    lineage = modeling.read_lineage(spark, tables.lineage).collect()
    assert len(lineage) == 2
    assert lineage[0]["when_trained"] > lineage[1]["when_trained"]
    assert lineage[0]["data_start"] == T0
    assert lineage[0]["data_end"] == T0 + timedelta(days=3)
    assert lineage[0]["data_max"] == T0 + 72 * HOUR
    assert lineage[0]["untuned_rmse"] is not None and '"maxDepth"' in lineage[0]["params"]
    assert jobs.monitor_job(spark, tables, SMALL, threshold=-1e9, horizons=2) in (True, False)


def test_walk_forward(spark):
    rows = [(s, h, (h * k) % 11) for s, k in (("a", 3), ("b", 4)) for h in range(60)]
    frame = features.feature_frame(panel(spark, rows), SMALL).cache()
    candidate = tiny_candidates()[1]
    one = modeling.walk_forward(frame, candidate, SMALL, k=2)
    two = modeling.walk_forward(frame, candidate, SMALL, k=2)
    assert one.rmse == two.rmse == sum(s["rmse"] for s in one.fold_scores) / 2
    assert all(s["train_end"] < s["fold_end"] for s in one.fold_scores)
    assert "yhat" in one.model.transform(frame).columns
    with pytest.raises(ValueError, match="too few"):
        modeling.walk_forward(frame.where(F.col("ts") < F.lit(hours(9))), candidate, SMALL, k=5)
    chosen, runs = modeling.select_model(frame, SMALL, tiny_candidates(), k=2)
    assert chosen.rmse == min(r.rmse for r in runs)


def test_ties_keep_the_first_candidate_and_draws_are_seeded(monkeypatch):
    boosted, forest, _ = modeling.default_candidates()
    assert modeling.draw_params(boosted, 3, 5) == modeling.draw_params(boosted, 3, 5)
    for params in modeling.draw_params(boosted, 50, 0):
        assert 100 <= params["maxIter"] < 500 and 3 <= params["maxDepth"] < 10
        assert 0.01 <= params["stepSize"] <= 0.3 and 5 <= params["minInstancesPerNode"] < 300
    monkeypatch.setattr(modeling, "training_columns", lambda frame, spec: frame)
    monkeypatch.setattr(modeling, "collect_folds", lambda *args: [])
    monkeypatch.setattr(
        modeling, "walk_forward",
        lambda frame, candidate, *args, **kwargs: modeling.Trained(candidate, {}, None, 1.0, []),
    )
    assert modeling.select_model(None, SMALL)[0].candidate.name == boosted.name


def test_stream_admits_only_rows_above_each_watermark(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def deliver(rows):
        panel(spark, rows).coalesce(1).write.mode("append").parquet(source)
        query = start_ingest(spark, source, target, checkpoint, SMALL)
        query.awaitTermination(60)
        assert query.exception() is None
        return as_dict(read_table(spark, target, SMALL.series_schema, SMALL.time_col))

    first = deliver([("a", 0, 1), ("a", 1, 2), ("a", 1, 1)])
    assert first == {("a", hours(0)): 1.0, ("a", hours(1)): 1.0}
    second = deliver([("a", 0, 9), ("a", 3, 4), ("b", 0, 5)])
    assert second == {**first, ("a", hours(3)): 4.0, ("b", hours(0)): 5.0}
    assert deliver([("a", 2, 7), ("a", 3, 9)]) == second


def test_since_prunes_date_folders(spark, tables):
    write_raw(spark, tables, 200)
    jobs.feature_job(spark, tables, SMALL, T0 + 72 * HOUR)
    recent = read_table(
        spark, tables.processed, SMALL.series_schema, SMALL.time_col, since=hours(50)
    )
    assert recent.count() == 2 * 23
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters")[1]
