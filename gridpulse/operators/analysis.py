"""Offline analysis: autocorrelation, the lag depth it suggests, and feature relevance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridpulse.operators.blocks import BLOCK, HALO, attach_per_series, with_preceding_rows
from gridpulse.spec import SeriesSpec


def autocorrelation_arrays(
    df: DataFrame, spec: SeriesSpec, nlags: int = 30, gap_free: bool = False
) -> DataFrame:
    """Per series, ``acf``: autocorrelations at lags ``0 .. nlags`` as one array.

    Autocovariances are sums over the whole series divided by its length (not by ``length - lag``), of
    the target less its series mean. Products are summed inside each block before the shuffle by
    series. A constant series has null correlations.
    """
    y = spec.target_col
    means = df.groupBy(spec.series_col).agg(F.avg(y).alias("_mean"))
    centred = attach_per_series(df.select(*spec.columns), means, spec).select(
        *spec.key, (F.col(y) - F.col("_mean")).alias(y)
    )
    over = f"PARTITION BY `{spec.series_col}`, {BLOCK} ORDER BY `{spec.time_col}`"
    products = (
        with_preceding_rows(centred, spec, nlags, gap_free)
        .selectExpr(
            f"`{spec.series_col}`",
            HALO,
            f"`{y}` * `{y}` AS p0",
            *[f"`{y}` * lag(`{y}`, {k}) OVER ({over}) AS p{k}" for k in range(1, nlags + 1)],
        )
        .where(~F.col(HALO))
    )
    sums = products.groupBy(spec.series_col).agg(
        *[F.coalesce(F.sum(f"p{k}"), F.lit(0.0)).alias(f"p{k}") for k in range(nlags + 1)]
    )
    variance = F.nullif("p0", F.lit(0.0))
    return sums.select(
        spec.series_col,
        F.array(*[F.col(f"p{k}") / variance for k in range(nlags + 1)]).alias("acf"),
    )


def partial_from_acf(acf: Column) -> Column:
    """Partial autocorrelations of an ``acf`` array, by the Durbin-Levinson recursion over its lags.

    The state has the coefficients of the lags so far, the variance they leave, and the results. What
    follows a lag that leaves no variance is null.
    """
    state = "struct<phi: array<double>, left: double, partial: array<double>>"
    start = F.struct(
        F.array().cast("array<double>").alias("phi"), F.lit(1.0).alias("left"), F.array(F.lit(1.0)).alias("partial")
    ).cast(state)

    def next_lag(done: Column, k: Column) -> Column:
        phi = done["phi"]
        latest_first = F.reverse(F.slice(acf, F.lit(2), k - 1))
        explained = F.aggregate(
            F.zip_with(phi, latest_first, lambda a, b: a * b), F.lit(0.0), lambda total, term: total + term
        )
        new = F.try_divide(F.get(acf, k) - explained, done["left"])

        def extended(value: Column) -> Column:
            return F.struct(
                F.concat(
                    F.zip_with(phi, F.reverse(phi), lambda a, b: a - value * b), F.array(value)
                ).alias("phi"),
                (done["left"] * (1 - value * value)).alias("left"),
                F.concat(done["partial"], F.array(value)).alias("partial"),
            )

        # One element, so that the new value is computed once and then only named.
        return F.get(F.transform(F.array(new), extended), 0)

    lags = F.filter(F.sequence(F.lit(0), F.size(acf) - 1), lambda k: k > 0)
    return F.when(F.get(acf, 0).isNotNull(), F.aggregate(lags, start, next_lag)["partial"])


def _one_row_per_lag(df: DataFrame, spec: SeriesSpec, arrays: list[str]) -> DataFrame:
    zipped = F.arrays_zip(*arrays)
    return df.select(spec.series_col, F.posexplode(zipped).alias("lag", "_v")).select(
        spec.series_col, "lag", *[F.col(f"_v.{name}").alias(name) for name in arrays]
    )


def autocorrelation(
    df: DataFrame, spec: SeriesSpec, nlags: int = 30, gap_free: bool = False
) -> DataFrame:
    """Rows ``(series, lag, acf)``."""
    return _one_row_per_lag(autocorrelation_arrays(df, spec, nlags, gap_free), spec, ["acf"])


def partial_autocorrelation(
    df: DataFrame, spec: SeriesSpec, nlags: int = 30, gap_free: bool = False
) -> DataFrame:
    """Rows ``(series, lag, pacf)``, Yule-Walker estimates."""
    arrays = autocorrelation_arrays(df, spec, nlags, gap_free)
    with_pacf = arrays.withColumn("pacf", partial_from_acf(F.col("acf")))
    return _one_row_per_lag(with_pacf, spec, ["pacf"])


def suggested_max_lag(
    df: DataFrame,
    spec: SeriesSpec,
    nlags: int = 30,
    threshold: float = 0.1,
    gap_free: bool = False,
) -> DataFrame:
    """One row ``max_lag``: the largest lag of any series with a strong partial autocorrelation,
    rounded (half to even) to a multiple of ``spec.step``."""
    strong = partial_autocorrelation(df, spec, nlags, gap_free).where(F.abs("pacf") > threshold)
    steps = F.bround(F.max("lag") / F.lit(spec.step), 0).cast("int")
    return strong.agg((steps * spec.step).alias("max_lag"))


def mutual_information(
    frame: DataFrame, features: list[str], target: str, bins: int = 16
) -> DataFrame:
    """Mutual information (nats) between each feature and the target, both cut into equal-width bins.

    Pairs with a null are left out. One pass finds the ranges, one counts ``(feature, bin, bin)`` cells. The number of cells is
    bounded by ``features * bins^2``, and cells are counted before the shuffle. Sums are rounded to ten
    places, so that equal features tie whatever the order of addition. Adds ``score``, scaled
    to [0, 1] over the features, and ``position``, the place of the feature in ``features``.
    """
    columns = [*features, target]
    values = frame.select(*[F.col(c).cast("double").alias(c) for c in columns])
    ranges = values.agg(
        F.array(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")) for c in columns])
    ).scalar()

    def bin_of(value: str, position: Column) -> Column:
        span = F.get(ranges, position)
        lo, hi = span["lo"], span["hi"]
        place = F.floor((F.col(value) - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins)
        return F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0))).cast("int")

    # The bin is computed after the unpivot: one short expression instead of one per feature.
    binned = values.select(
        F.col(target).alias("_y"), F.posexplode(F.array(*features)).alias("position", "_x")
    ).where("_x IS NOT NULL AND _y IS NOT NULL").select(
        "position",
        bin_of("_x", F.col("position")).alias("bin_x"),
        bin_of("_y", F.lit(len(features))).alias("bin_y"),
    )
    cells = binned.groupBy("position", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n"))
    per_feature = Window.partitionBy("position")
    n = F.col("n")
    joint = cells.select(
        "position",
        n,
        F.sum(n).over(per_feature).alias("total"),
        F.sum(n).over(Window.partitionBy("position", "bin_x")).alias("n_x"),
        F.sum(n).over(Window.partitionBy("position", "bin_y")).alias("n_y"),
    )
    term = n / F.col("total") * F.log(n * F.col("total") / (F.col("n_x") * F.col("n_y")))
    names = F.array(*[F.lit(name) for name in features])
    # One row per feature from here on.
    everything = Window.partitionBy(F.lit(1))
    low, high = F.min("mi").over(everything), F.max("mi").over(everything)
    return (
        joint.groupBy("position")
        .agg(F.round(F.sum(term), 10).alias("mi"))
        .select(
            "position",
            F.element_at(names, F.col("position") + 1).alias("feature"),
            "mi",
            ((F.col("mi") - low) / F.nullif(high - low, F.lit(0.0))).alias("score"),
        )
    )


def selected_features(scores: DataFrame, threshold: float) -> DataFrame:
    """Features whose score is at least the ``threshold`` quantile (nearest rank) of all scores."""
    everything = Window.partitionBy(F.lit(1))
    rank = F.row_number().over(everything.orderBy("score"))
    n = F.count(F.lit(1)).over(everything)
    cut_rank = F.round((n - 1) * F.lit(threshold), 0) + 1
    ranked = scores.select("*", rank.alias("_rank"), cut_rank.alias("_cut_rank"))
    cut = F.max(F.when(F.col("_rank") == F.col("_cut_rank"), F.col("score"))).over(everything)
    return (
        ranked.withColumn("_cut", cut)
        .where(F.col("score") >= F.col("_cut"))
        .select("position", "feature", "score")
    )


def select_features(
    frame: DataFrame, features: list[str], target: str, threshold: float, bins: int = 16
) -> list[str]:
    """Names of the selected features, in input order (at most ``len(features)`` driver rows)."""
    chosen = selected_features(mutual_information(frame, features, target, bins), threshold)
    return [row["feature"] for row in chosen.orderBy("position").collect()]
