"""One registered query per operator, over panels derived from the event and order tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.timegrid import ntz, shift
from gridpulse.operators import analysis, backfill, evaluate, features, forecast, modeling
from gridpulse.operators import neighbours, prepare, quality, ridge, split, upsert
from gridpulse.sources import panels
from gridpulse.sources.panels import DAILY, PANEL
from gridpulse.sources.tables import shared_folder
from gridpulse.sources.versioned import VersionedTable, append_batches
from gridpulse.spec import SeriesSpec
from gridpulse.streaming.ingest import fresh_rows

Query = Callable[[SparkSession, str], DataFrame]

ALIGNED_AS_OF = datetime(2025, 1, 25)
AS_OF = datetime(2024, 1, 25, 12)
CUT = datetime(2024, 1, 20)
OVERLAP = datetime(2024, 1, 15)
TRAINED = datetime(2024, 2, 1, 6, 30, tzinfo=timezone.utc)
TEST_SIZE = 24
HORIZON = 12
FOLDS = 5
BINS = 16
QUANTILE = 0.5
ONE_SERIES = "click"
NEAR_FEATURES = ["lag_1", "lag_24", "avg_8_lags", "sine_hour", "is_night"]
NEIGHBOURS = 3
RIDGE_FEATURES = ["lag_1", "lag_24", "avg_4_lags", "sine_hour"]
RIDGE_PENALTIES = [0.0, 0.5, 2000.0]
LINEAGE_PARAMS = {"test_size": TEST_SIZE, "kind": "persistence"}

REGISTRY: dict[str, Query] = {}


def registered(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def predictor(df: DataFrame) -> DataFrame:
    """A fixed mix of the last value and the short mean, so that results can be checked in SQL.

    The weights have no short decimal form, so rounding never meets a tie.
    """
    return df.withColumn("yhat", F.expr("0.6180339887D * lag_1 + 0.3819660113D * avg_4_lags"))


def rounded_means(df: DataFrame, spec: SeriesSpec = PANEL, places: int = 8) -> DataFrame:
    """Means to some places: engines add floating-point numbers in different orders."""
    return df.withColumns({name: F.round(name, places) for name in spec.mean_names})


def dense_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.densify(panels.hourly_group_series(spark, sf_dir), PANEL, fill=True)


def dense_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.densify(panels.hourly_series(spark, sf_dir), PANEL, fill=True)


def group_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_frame(dense_groups(spark, sf_dir), PANEL, gap_free=True)


def recent_frame(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    return features.recent_feature_rows(dense_groups(spark, sf_dir), PANEL, n)


def type_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_frame(dense_types(spark, sf_dir), PANEL, gap_free=True)


# --- prepare ------------------------------------------------------------------------------------


@registered
def align_series_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.align_series_start(panels.event_readings(spark, sf_dir), PANEL)


@registered
def clip_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.clip_time_range(panels.event_readings(spark, sf_dir), PANEL, AS_OF)


@registered
def densify_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.densify(panels.hourly_group_series(spark, sf_dir), PANEL)


@registered
def densify_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.densify(panels.daily_orders(spark, sf_dir), DAILY, fill=True)


@registered
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.forward_fill(densify_hourly(spark, sf_dir), PANEL)


@registered
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.dedup_keep_first(panels.hourly_readings(spark, sf_dir), PANEL)


@registered
def preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.preprocess(panels.hourly_readings(spark, sf_dir), PANEL, ALIGNED_AS_OF)


@registered
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(panels.hourly_group_readings(spark, sf_dir), PANEL)


@registered
def quality_report_off_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings at any second: only those a whole number of hours after a series' first fill a slot."""
    return quality.quality_report(panels.event_readings(spark, sf_dir), PANEL)


@registered
def trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.trailing_window(panels.hourly_group_series(spark, sf_dir), PANEL)


# --- features -----------------------------------------------------------------------------------


@registered
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags by row over a panel with holes."""
    return features.lag_features(panels.hourly_group_series(spark, sf_dir), PANEL)


@registered
def window_mean_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = panels.hourly_group_series(spark, sf_dir)
    return rounded_means(features.window_mean_features(panel, PANEL))


@registered
def hour_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = panels.events(spark, sf_dir).select("event_id", "ts")
    return features.with_hour_encoding(events, PANEL)


@registered
def daypart_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = panels.events(spark, sf_dir).select("event_id", "ts")
    return features.with_daypart_flags(events, PANEL)


@registered
def feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_means(group_frame(spark, sf_dir))


@registered
def feature_frame_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = prepare.densify(panels.daily_orders(spark, sf_dir), DAILY, fill=True)
    return rounded_means(features.feature_frame(daily, DAILY, gap_free=True))


# --- splits and folds ---------------------------------------------------------------------------


@registered
def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.holdout_flag(dense_groups(spark, sf_dir), PANEL, TEST_SIZE)


@registered
def fold_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.fold_boundaries(panels.hourly_group_series(spark, sf_dir), PANEL, FOLDS)


@registered
def fold_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = panels.hourly_group_series(spark, sf_dir)
    return split.fold_membership(panel, split.fold_boundaries(panel, PANEL, FOLDS), PANEL)


@registered
def fold_membership_one_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = panels.hourly_series(spark, sf_dir)
    return split.fold_membership_one_series(panel, PANEL, ONE_SERIES, FOLDS)


# --- forecasts ----------------------------------------------------------------------------------


@registered
def latest_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.latest_per_series(panels.hourly_group_series(spark, sf_dir), PANEL)


@registered
def next_step_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_means(forecast.next_step_features(recent_frame(spark, sf_dir, 1), PANEL))


@registered
def one_step_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_means(
        forecast.one_step_forecast(recent_frame(spark, sf_dir, 1), predictor, PANEL)
    )


@registered
def multi_step_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = recent_frame(spark, sf_dir, 1)
    # Forecasts have four decimals, so a mean of 32 has nine: rounding later meets no tie.
    return rounded_means(forecast.multi_step_forecast(frame, predictor, PANEL, HORIZON), places=10)


@registered
def persistence_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = split.holdout_flag(dense_groups(spark, sf_dir), PANEL, TEST_SIZE)
    return forecast.persistence_of_flagged(flagged, PANEL)


# --- scores -------------------------------------------------------------------------------------


@registered
def evaluation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.evaluation_metrics(
        persistence_forecast(spark, sf_dir), "y", "naive_forecast"
    )


@registered
def evaluation_metrics_unanswered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores per series where some series lack forecasts for some hours."""
    scored = persistence_forecast(spark, sf_dir).withColumn(
        "naive_forecast",
        F.expr("CASE WHEN series LIKE 'c%' AND hour(ts) = 3 THEN NULL ELSE naive_forecast END"),
    )
    return evaluate.evaluation_metrics(scored, "y", "naive_forecast", by=["series"])


@registered
def backtest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = recent_frame(spark, sf_dir, HORIZON + 1)
    return evaluate.backtest_report(frame, predictor, PANEL, HORIZON)


@registered
def backtest_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = evaluate.backtest_gate(backtest_report(spark, sf_dir))
    return gate.select(
        F.round("mean_r2", 8).alias("mean_r2"),
        F.round("mean_naive_r2", 8).alias("mean_naive_r2"),
        "passed",
    )


# --- stored tables ------------------------------------------------------------------------------


def stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed hours up to a cut: every series ends at its own last observation."""
    return panels.hourly_group_series(spark, sf_dir).where(F.col("ts") <= ntz(CUT))


def batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch that overlaps the stored rows."""
    return dense_groups(spark, sf_dir).where(F.col("ts") >= ntz(OVERLAP))


def stored_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast for the hour after each observed hour; hours without data had no run."""
    observed = panels.hourly_group_series(spark, sf_dir)
    return observed.select(
        "series", shift(F.col("ts"), PANEL.every).alias("ts"), F.col("y").alias("forecast")
    )


def gappy_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast for each observed hour but those at 5 and 17 o'clock."""
    observed = panels.hourly_group_series(spark, sf_dir)
    return observed.where(~F.hour("ts").isin(5, 17)).withColumnRenamed("y", "forecast")


@registered
def new_rows_above_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    watermarks = upsert.high_watermarks(stored_rows(spark, sf_dir), PANEL)
    return upsert.new_rows_above_watermark(batch_rows(spark, sf_dir), watermarks, PANEL)


@registered
def append_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.append_processed(
        stored_rows(spark, sf_dir), batch_rows(spark, sf_dir), PANEL
    )


@registered
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = batch_rows(spark, sf_dir).select(
        "series",
        shift(F.col("ts"), PANEL.every).alias("ts"),
        (F.col("y") / 2).alias("forecast"),
    )
    return upsert.insert_if_absent(new, stored_forecasts(spark, sf_dir), PANEL)


@registered
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches of readings, through the body of the streaming job."""
    readings = panels.hourly_group_readings(spark, sf_dir)
    first = readings.where(F.col("ts") <= ntz(CUT))
    second = readings.where(F.col("ts") >= ntz(OVERLAP))
    stored = fresh_rows(first, None, PANEL)
    return stored.unionByName(fresh_rows(second, stored, PANEL))


@registered
def versioned_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches as commits of a versioned table, one of them delivered twice, then compacted."""
    readings = panels.hourly_group_readings(spark, sf_dir)
    table = VersionedTable(spark, f"{shared_folder(spark)}/versioned-{uuid.uuid4().hex}", PANEL)

    def fresh(batch: DataFrame, watermarks: DataFrame) -> DataFrame:
        return upsert.new_rows_above_watermark(prepare.dedup_keep_first(batch, PANEL), watermarks, PANEL)

    take = append_batches(table, "readings", fresh)
    take(readings.where(F.col("ts") <= ntz(CUT)), 0)
    for _ in range(2):
        take(readings.where(F.col("ts") >= ntz(OVERLAP)), 1)
    return table.read(table.compact())


@registered
def forecast_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.forecast_coverage(stored_forecasts(spark, sf_dir), PANEL)


@registered
def missing_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.missing_forecasts(
        dense_groups(spark, sf_dir), stored_forecasts(spark, sf_dir), PANEL
    )


@registered
def backfill_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.backfill_forecasts(
        dense_groups(spark, sf_dir),
        stored_forecasts(spark, sf_dir),
        predictor,
        PANEL,
        gap_free=True,
    )


@registered
def backfill_forecasts_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On a panel with holes, where a key's lags may lie outside its own look-back."""
    return backfill.backfill_forecasts(
        panels.hourly_group_series(spark, sf_dir), gappy_forecasts(spark, sf_dir), predictor, PANEL
    )


# --- analysis -----------------------------------------------------------------------------------


@registered
def autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = analysis.autocorrelation(dense_groups(spark, sf_dir), PANEL, gap_free=True)
    return table.withColumn("acf", F.round("acf", 8))


@registered
def partial_autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = analysis.partial_autocorrelation(dense_groups(spark, sf_dir), PANEL, gap_free=True)
    return table.withColumn("pacf", F.round("pacf", 8))


@registered
def suggested_max_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.suggested_max_lag(dense_groups(spark, sf_dir), PANEL, gap_free=True)


@registered
def mutual_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = analysis.mutual_information(
        group_frame(spark, sf_dir), PANEL.feature_names, "y", BINS
    )
    return scores.withColumns({c: F.round(c, 8) for c in ("mi", "score")})


@registered
def mutual_information_null_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame that keeps rows without a label."""
    frame = group_frame(spark, sf_dir).withColumn("y", F.expr("CASE WHEN hour(ts) <> 3 THEN y END"))
    scores = analysis.mutual_information(frame, PANEL.feature_names, "y", BINS)
    return scores.withColumns({c: F.round(c, 8) for c in ("mi", "score")})


@registered
def selected_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = analysis.mutual_information(
        group_frame(spark, sf_dir), PANEL.feature_names, "y", BINS
    )
    return analysis.selected_features(scores, QUANTILE).withColumn("score", F.round("score", 8))


@registered
def neighbour_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-neighbour mutual information with the demand of the same hour, over all rows of the frame."""
    frame = rounded_means(type_frame(spark, sf_dir))
    scores = neighbours.neighbour_information(frame, NEAR_FEATURES, "y", NEIGHBOURS)
    return scores.withColumns({c: F.round(c, 8) for c in ("mi", "score")})


# --- models -------------------------------------------------------------------------------------


def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_frame(spark, sf_dir).persist()


@registered
def walk_forward_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = training_frame(spark, sf_dir)
    try:
        run = modeling.walk_forward(frame, modeling.default_candidates()[0], PANEL, k=FOLDS)
        return modeling.scores_table(frame, [run])
    finally:
        frame.unpersist()


@registered
def walk_forward_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all folds and several penalties from one pass over the rows."""
    frame = type_frame(spark, sf_dir)
    folds = modeling.collect_folds(frame, PANEL, FOLDS)
    moments = ridge.fold_moments(frame, RIDGE_FEATURES, PANEL, folds)
    rows = [
        (penalty, s["fold"], s["train_end"], s["fold_end"], train.n, s["r2"], s["rmse"])
        for penalty in RIDGE_PENALTIES
        for s, train in zip(moments.scores(penalty), moments.train, strict=True)
    ]
    return spark.createDataFrame(
        rows,
        "penalty DOUBLE, fold INT, train_end TIMESTAMP_NTZ, fold_end TIMESTAMP_NTZ, n_train BIGINT, "
        "r2 DOUBLE, rmse DOUBLE",
    )


@registered
def model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = training_frame(spark, sf_dir)
    try:
        chosen, runs = modeling.select_model(frame, PANEL, modeling.default_candidates(), k=FOLDS)
        scores = modeling.scores_table(frame, runs)
        return (
            scores.groupBy("run", "name")
            .agg(F.max("mean_rmse").alias("mean_rmse"))
            .withColumn("selected", F.col("name") == chosen.candidate.name)
        )
    finally:
        frame.unpersist()


@registered
def tuning_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = modeling.compact(training_frame(spark, sf_dir))
    try:
        boosted = modeling.default_candidates()[0]
        _, trials = modeling.tune(frame, boosted, PANEL, n_trials=20, k=FOLDS, seed=7)
        return modeling.scores_table(frame, trials)
    finally:
        frame.unpersist()


@registered
def tuning_adaptive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of ridge trials, each proposed from those before; one pass over the rows scores all."""
    frame = type_frame(spark, sf_dir)
    linear = next(c for c in modeling.default_candidates() if c.penalty)
    _, trials = modeling.tune_adaptive(frame, linear, PANEL, n_trials=24, k=FOLDS, seed=7)
    return modeling.scores_table(frame, trials)


@registered
def model_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = group_frame(spark, sf_dir).select(*PANEL.key)
    rmse = evaluation_metrics(spark, sf_dir).select("rmse").scalar()
    row = modeling.model_lineage(
        frame, PANEL, "persistence", "processed", LINEAGE_PARAMS, rmse, TRAINED
    )
    return row.withColumn("when_trained", F.unix_seconds("when_trained"))


@registered
def lineage_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One training record per series, dated by the end of its data."""
    dated = panels.hourly_group_series(spark, sf_dir).groupBy("series").agg(
        F.max("ts").alias("when_trained")
    )
    scores = evaluate.evaluation_metrics(
        persistence_forecast(spark, sf_dir), "y", "naive_forecast", by=["series"]
    )
    lineage = dated.join(scores, "series").select(
        F.col("series").alias("name"), "when_trained", "rmse"
    )
    return modeling.lineage_newest_first(lineage)
