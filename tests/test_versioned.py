from dataclasses import replace
from datetime import timedelta

import pytest
from panel_helpers import HOUR, T0, as_dict, hours, panel
from pyspark.sql import functions as F

from gridpulse.operators import modeling
from gridpulse.operators.quality import QualityError
from gridpulse.plans import jobs, stored_jobs
from gridpulse.sources.manifest import ConflictError, Manifest
from gridpulse.sources.panels import PANEL
from gridpulse.sources.versioned import VersionedTable, append_batches

SMALL = replace(PANEL, max_lag=6, step=2, lookback=timedelta(days=3))


def predictor(df):
    return df.withColumn("yhat", F.expr("lag_1"))


def span(a, b, series="ab"):
    return [(s, h, h * 2 + (s == "b")) for s in series for h in range(a, b)]


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"), PANEL)


def files_read(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numFiles").value()


def data_files(table):
    return [f for c in table.manifest.children("data") for d in table.manifest.children(f"data/{c}") if "=" in d
            for f in table.manifest.children(f"data/{c}/{d}") if f.endswith(".parquet")]


def test_empty_table(spark, table):
    assert table.snapshot().version == 0 and table.read().collect() == [] and table.watermarks().collect() == []
    assert table.trailing_start() is None
    assert table.compact().version == 0
    table.append(panel(spark, []))
    assert table.snapshot().version == 0


def test_appends_are_versions(spark, table):
    first = table.append(panel(spark, span(0, 30)))
    second = table.append(panel(spark, span(30, 50, "a")))
    assert (first.version, second.version, second.rows) == (1, 2, 80)
    assert as_dict(table.read(first)) == as_dict(panel(spark, span(0, 30)))
    assert as_dict(table.read()) == as_dict(panel(spark, span(0, 30) + span(30, 50, "a")))
    assert {r[0]: (r[1], r[2]) for r in table.marks().collect()} == {"a": (T0, hours(49)), "b": (T0, hours(29))}
    assert {r[0]: r[1] for r in table.watermarks(first).collect()} == {"a": hours(29), "b": hours(29)}


@pytest.mark.parametrize("bad", [
    [("a", 1, 1), ("a", 1, 2)], [("a", 1, 1), ("a", 1, 1)], [(None, 1, 1)], [("a", 1, None)],
])
def test_failed_check_leaves_nothing(spark, table, bad):
    table.append(panel(spark, span(0, 3)))
    with pytest.raises(QualityError):
        table.append(panel(spark, bad + span(5, 9, "c")))
    assert table.snapshot().version == 1 and len(table.manifest.children("data")) == 1
    assert as_dict(table.read()) == as_dict(panel(spark, span(0, 3)))


def test_nan_and_schema(spark, table):
    nan = panel(spark, [("a", 1, float("nan"))])
    with pytest.raises(QualityError):
        table.append(nan, allow_nan=False)
    table.append(nan)
    with pytest.raises(QualityError):
        table.append(nan.withColumn("y", F.col("y").cast("float")))


def test_repeated_keys_are_found_when_a_date_is_spread(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), PANEL, spread=3)
    rows = [(f"s{i}", h, i) for i in range(20) for h in range(24)]
    table.append(panel(spark, rows))
    assert 1 <= len(data_files(table)) <= 3
    with pytest.raises(QualityError, match="repeated keys': 1"):
        table.append(panel(spark, [*rows, ("s7", 5, 1.0)]).repartition(7))


def test_checked_in_the_write_pass(spark, table):
    """The rows are computed once, by the write: the plan is not run a second time for the checks."""
    runs = spark.sparkContext.accumulator(0)
    rows = panel(spark, span(0, 30)).repartition(1)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    table.append(rows.mapInArrow(count, rows.schema))
    assert runs.value == 60


def test_crash_between_staging_and_publishing(spark, table, monkeypatch):
    table.append(panel(spark, span(0, 30)))
    before = as_dict(table.read())

    def killed(self, *args):
        raise SystemExit

    monkeypatch.setattr(Manifest, "publish", killed)
    monkeypatch.setattr(Manifest, "remove", lambda self, path: None)
    with pytest.raises(SystemExit):
        table.append(panel(spark, span(30, 90)))
    monkeypatch.undo()
    assert len(table.manifest.children("data")) == 2
    assert as_dict(table.read()) == before and table.snapshot().version == 1
    table.append(panel(spark, span(30, 90)))
    assert len(as_dict(table.read())) == 180
    table.vacuum()
    assert len(table.manifest.children("data")) == 2 and len(as_dict(table.read())) == 180


def test_two_writers(spark, table):
    base = table.append(panel(spark, span(0, 3)))
    table.append(panel(spark, span(3, 5)), base=base)
    with pytest.raises(ConflictError):
        table.append(panel(spark, span(3, 6)), base=base)
    assert len(as_dict(table.read())) == 10 and len(table.manifest.children("data")) == 2
    with pytest.raises(ConflictError):
        table.manifest.publish(1, {})
    assert not [f for f in table.manifest.children("_versions") if f.endswith("draft")]


def test_compaction(spark, table):
    for h in range(0, 40, 4):
        table.append(panel(spark, span(h, h + 4)))
    pinned = table.snapshot()
    reader = table.read(pinned)
    before = as_dict(table.read())
    assert len(data_files(table)) == 10
    after = table.compact()
    assert len(after.commits) == 1 and after.rows == pinned.rows and after.marks == pinned.marks
    assert as_dict(table.read()) == before == as_dict(reader)
    table.vacuum()
    assert len(data_files(table)) == 2 and as_dict(table.read()) == before
    table.append(panel(spark, span(40, 44)))
    assert len(table.compact(small=10).commits) == 2


def test_bounds_prune_files(spark, table):
    for day in range(6):
        table.append(panel(spark, span(24 * day, 24 * day + 24)))
    assert files_read(table.read()) == 6
    assert files_read(table.read(since=hours(100), until=hours(110))) == 1
    table.compact()
    assert files_read(table.read()) == 6
    some = table.read(since=hours(30), until=hours(50))
    assert files_read(some) == 2
    assert as_dict(some) == as_dict(panel(spark, span(30, 51)))


def test_batch_that_comes_again(spark, table):
    body = append_batches(table, "q", lambda batch, marks: batch.join(marks, "series", "left").where("_watermark IS NULL OR ts > _watermark").select("series", "ts", "y"))
    body(panel(spark, span(0, 10)), 0)
    body(panel(spark, span(5, 15)), 1)
    body(panel(spark, span(5, 25)), 1)
    body(panel(spark, span(0, 15)), 2)
    assert as_dict(table.read()) == as_dict(panel(spark, span(0, 15)))
    assert table.snapshot().sources == {"q": 2}
    body(panel(spark, span(0, 99)), 2)
    assert len(as_dict(table.read())) == 30


def test_batch_does_not_read_stored_rows(spark, table):
    for h in range(0, 200, 40):
        table.append(panel(spark, span(h, h + 40)))
    fresh = table.watermarks()
    assert files_read(fresh) == 1
    assert "/data/" not in str(fresh.inputFiles()) and "/marks/" in fresh.inputFiles()[0]


def test_stream(spark, tmp_path, table):
    source = str(tmp_path / "source")
    for a, b in ((0, 10), (6, 20), (3, 5), (20, 31)):
        panel(spark, span(a, b)).coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):
        stored_jobs.start_stored_ingest(spark, source, table, str(tmp_path / "cp"), "q", max_files=1).awaitTermination()
    stored = as_dict(table.read())
    assert stored == {k: v for k, v in as_dict(panel(spark, span(0, 31))).items() if k in stored}
    assert max(k[1] for k in stored) == hours(30)
    assert table.snapshot().sources == {"q": 3}


def test_jobs_equal_those_over_plain_tables(spark, tmp_path):
    plain = jobs.Tables(*[str(tmp_path / name) for name in ("raw", "processed", "forecasts", "model", "lineage")])
    rows = [(s, h, 10 + (h * k) % 17) for s, k in (("a", 3), ("b", 5)) for h in range(400)]
    raw = panel(spark, rows)
    raw.write.parquet(plain.raw)
    stored = stored_jobs.StoredTables.at(spark, str(tmp_path / "stored"), SMALL)
    for end in (80, 80, 84, 90):
        jobs.feature_job(spark, plain, SMALL, T0 + end * HOUR)
        stored_jobs.ingest(raw, stored, SMALL, T0 + end * HOUR)
        jobs.inference_job(spark, plain, SMALL, predictor)
        stored_jobs.forecast_next_step(stored, SMALL, predictor)
    assert stored.processed.snapshot().version == 3
    assert as_dict(stored.processed.read()) == as_dict(jobs.read_processed(spark, plain, SMALL))
    for repaired in (True, False):
        assert jobs.backfill_job(spark, plain, SMALL, predictor) is repaired
        before = stored.forecasts.snapshot().version
        assert (stored_jobs.backfill(stored, SMALL, predictor).version > before) is repaired
    want = as_dict(jobs.read_forecasts(spark, plain, SMALL), "forecast")
    assert as_dict(stored.forecasts.read(), "forecast") == want and len(want) == 2 * 11


def test_model_store_is_atomic(spark, tmp_path, monkeypatch):
    from gridpulse.plans.queries import type_frame

    frame = type_frame(spark, "/root/testdata/sf0.001").limit(300)
    candidate = next(c for c in modeling.default_candidates() if c.penalty)
    path = str(tmp_path / "model")
    assert not modeling.model_exists(spark, path)
    models = [candidate.build(PANEL, {"regParam": p}).fit(frame) for p in (0.1, 5000.0, 1.0, 2.0)]

    def weights(model):
        return list(model.stages[-1].coefficients)

    modeling.save_model(models[0], path)
    monkeypatch.setattr(Manifest, "publish", lambda *a: (_ for _ in ()).throw(SystemExit()))
    with pytest.raises(SystemExit):
        modeling.save_model(models[1], path)
    monkeypatch.undo()
    assert weights(modeling.load_model(path)) == weights(models[0])
    for model in models[2:]:
        modeling.save_model(model, path)
        assert weights(modeling.load_model(path)) == weights(model)
    assert len(Manifest(spark, path).children("models")) == 2
