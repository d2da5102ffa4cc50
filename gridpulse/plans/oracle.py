"""SQL counterparts of the registered queries, for an independent engine over the same tables.

Written from the definitions of the operators: self-contained statements built from shared common
table expressions.
"""

from __future__ import annotations

from gridpulse.plans.queries import (
    ALIGNED_AS_OF,
    AS_OF,
    BINS,
    CUT,
    FOLDS,
    HORIZON,
    NEAR_FEATURES,
    NEIGHBOURS,
    ONE_SERIES,
    OVERLAP,
    QUANTILE,
    RIDGE_FEATURES,
    RIDGE_PENALTIES,
    TEST_SIZE,
    TRAINED,
)
from gridpulse.sources.panels import DAILY, PANEL
from gridpulse.spec import SeriesSpec

LOOKBACK = f"INTERVAL {PANEL.lookback.days} DAY"


def _stamp(value) -> str:
    return f"TIMESTAMP '{value.isoformat(sep=' ')}'"


def _dense(source: str, unit: str = "HOUR") -> str:
    return f"""
    SELECT g.series, g.ts, p.y
    FROM (
        SELECT series, unnest(generate_series(min(ts), max(ts), INTERVAL 1 {unit})) AS ts
        FROM {source} GROUP BY series
    ) g LEFT JOIN {source} p ON p.series = g.series AND p.ts = g.ts"""


def _filled(source: str) -> str:
    return f"""
    SELECT series, ts, last_value(y IGNORE NULLS) OVER (
        PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y
    FROM {source}"""


def _lagged(source: str, spec: SeriesSpec = PANEL) -> str:
    lags = ", ".join(f"lag(y, {k}) OVER w AS lag_{k}" for k in spec.lags)
    complete = " AND ".join(f"lag_{k} IS NOT NULL" for k in spec.lags)
    return f"""
    SELECT * FROM (
        SELECT series, ts, {lags}, y FROM {source} WINDOW w AS (PARTITION BY series ORDER BY ts)
    ) WHERE {complete}"""


def _mean(k: int) -> str:
    return "(" + " + ".join(f"lag_{i}" for i in range(1, k + 1)) + f") / {k}"


def _means(rounded: bool, spec: SeriesSpec = PANEL) -> str:
    form = "round({}, 8)" if rounded else "{}"
    return ", ".join(f"{form.format(_mean(k))} AS avg_{k}_lags" for k in spec.mean_sizes)


def _encoding(hour: str) -> str:
    angle = f"2 * pi() * {hour} / 24"
    return f"round(sin({angle}), 4) + 0.0 AS sine_hour, round(cos({angle}), 4) + 0.0 AS cosine_hour"


def _flags(hour: str) -> str:
    return f"""
        {hour} BETWEEN 5 AND 11 AS is_morning,
        {hour} BETWEEN 12 AND 16 AS is_afternoon,
        {hour} BETWEEN 17 AND 20 AS is_evening,
        {hour} < 5 OR {hour} > 20 AS is_night"""


def _calendar(ts: str = "ts") -> str:
    hour = f"hour({ts} - INTERVAL 5 HOUR)"
    return f"{_encoding(hour)}, {_flags(hour)}"


def _features(source: str, rounded: bool, spec: SeriesSpec = PANEL) -> str:
    lags = ", ".join(spec.lag_names)
    return f"SELECT series, ts, {_calendar()}, {_means(rounded, spec)}, {lags}, y FROM {source}"


WEIGHTED = "0.6180339887::DOUBLE * {last} + 0.3819660113::DOUBLE * {mean}"


def _forecast(lags: str) -> str:
    """Forecast from a list of lags, oldest first."""
    last4 = " + ".join(f"{lags}[-{i}]" for i in range(1, 5))
    value = WEIGHTED.format(last=f"{lags}[-1]", mean=f"(({last4}) / 4)")
    return f"greatest(0.0::DOUBLE, round({value}, 4))"


LAG_LIST = "[" + ", ".join(PANEL.lag_names) + "]"

# Common table expressions by name; each may use the ones before it.
CTES: dict[str, str] = {
    "hourly": "SELECT event_type AS series, date_trunc('hour', ts) AS ts, value AS y FROM events",
    "group_hourly": """
        SELECT event_type || '-' || (user_id % 10) AS series, date_trunc('hour', ts) AS ts, value AS y
        FROM events""",
    "types": """
        SELECT series, ts, CAST(sum(CAST(y AS DECIMAL(18, 2))) AS DOUBLE) AS y
        FROM hourly GROUP BY series, ts""",
    "groups": """
        SELECT series, ts, CAST(sum(CAST(y AS DECIMAL(18, 2))) AS DOUBLE) AS y
        FROM group_hourly GROUP BY series, ts""",
    "days": """
        SELECT o_orderpriority AS series, date_trunc('day', o_orderdate)::TIMESTAMP AS ts,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS y
        FROM orders GROUP BY ALL""",
    "days_grid": _dense("days", "DAY"),
    "days_dense": _filled("days_grid"),
    "days_lagged": _lagged("days_dense", DAILY),
    "grid": _dense("groups"),
    "dense": _filled("grid"),
    "gappy_lagged": _lagged("groups"),
    "lagged": _lagged("dense"),
    "frame": _features("lagged", rounded=False),
    "latest": "SELECT * FROM frame QUALIFY row_number() OVER (PARTITION BY series ORDER BY ts DESC) = 1",
    "states": f"SELECT series, ts + INTERVAL 1 HOUR AS ts, list_append({LAG_LIST}[2:], y) AS l FROM latest",
    "flagged": f"""
        SELECT *, ts > max(ts) OVER (PARTITION BY series) - INTERVAL {TEST_SIZE} HOUR AS is_test
        FROM dense""",
    "naive": """
        SELECT t.series, t.ts, t.y, n.naive_forecast
        FROM flagged t JOIN (
            SELECT series, arg_max(y, ts) AS naive_forecast FROM flagged WHERE NOT is_test GROUP BY series
        ) n USING (series)
        WHERE t.is_test""",
    "stored": f"SELECT * FROM groups WHERE ts <= {_stamp(CUT)}",
    "batch": f"SELECT * FROM dense WHERE ts >= {_stamp(OVERLAP)}",
    "fresh": """
        SELECT b.series, b.ts, b.y FROM batch b
        WHERE b.ts > (SELECT max(s.ts) FROM stored s WHERE s.series = b.series)""",
    "forecasts": "SELECT series, ts + INTERVAL 1 HOUR AS ts, y AS forecast FROM groups",
    "coverage": """
        SELECT series, min(ts) AS first_forecast, max(ts) AS last_forecast
        FROM forecasts GROUP BY series""",
    "missing": f"""
        SELECT d.series, d.ts
        FROM (SELECT *, max(ts) OVER (PARTITION BY series) AS latest_ts FROM dense) d
        JOIN coverage c USING (series)
        LEFT JOIN forecasts f ON f.series = d.series AND f.ts = d.ts
        WHERE d.ts >= d.latest_ts - {LOOKBACK}
          AND d.ts BETWEEN c.first_forecast AND c.last_forecast
          AND f.forecast IS NULL""",
    "numbered": """
        SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT ts FROM groups)""",
    "folds": f"""
        SELECT f.fold,
               max(ts) FILTER (i = e - e // {FOLDS + 1}) AS train_end,
               max(ts) FILTER (i = e) AS fold_end
        FROM (
            SELECT ts, i, fold, n - 1 - (n // {FOLDS + 1}) * ({FOLDS} - fold) AS e
            FROM numbered, range(1, {FOLDS + 1}) r(fold)
        ) f GROUP BY f.fold""",
    "one": f"SELECT * FROM types WHERE series = '{ONE_SERIES}'",
    "one_numbered": """
        SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT ts FROM one)""",
}
CTES["type_grid"] = _dense("types")
CTES["type_dense"] = _filled("type_grid")
CTES["type_lagged"] = _lagged("type_dense")
CTES["type_frame"] = _features("type_lagged", rounded=False)
CTES["near_frame"] = _features("type_lagged", rounded=True)
CTES["type_numbered"] = CTES["numbered"].replace("groups", "type_frame")
CTES["type_folds"] = CTES["folds"].replace("numbered", "type_numbered")
CTES["one_folds"] = CTES["folds"].replace("numbered", "one_numbered")


def _with(names: str, body: str, recursive: str = "") -> str:
    parts = ", ".join(f"{name} AS ({CTES[name]})" for name in names.split())
    extra = f", {recursive}" if recursive else ""
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}{extra} {body}"


FRAME = "group_hourly groups grid dense lagged frame"
DENSE = "group_hourly groups grid dense"


def _membership(rows: str, folds: str) -> str:
    return f"""
    SELECT p.series, p.ts, p.y, CAST(f.fold AS INTEGER) AS fold,
           CASE WHEN p.ts <= f.train_end THEN 'train' ELSE 'validation' END AS role
    FROM {rows} p JOIN {folds} f ON p.ts <= f.fold_end"""


def _scores(y: str, yhat: str) -> str:
    unanswered = f"count(*) FILTER ({y} IS NOT NULL AND {yhat} IS NULL)"
    return f"""
        CASE WHEN {unanswered} = 0
            THEN round(1 - sum(({y} - {yhat}) ** 2) / nullif(regr_syy({y}, {y}), 0), 4) END AS r2,
        CASE WHEN {unanswered} = 0 THEN round(sqrt(avg(({y} - {yhat}) ** 2)), 4) END AS rmse"""


def _digamma(n: str) -> str:
    first = " - ".join(f"1.0::DOUBLE / ({n} + {i})" for i in range(6))
    x = f"({n} + 6)::DOUBLE"
    return f"(ln({x}) - 1 / (2 * {x}) - 1 / (12 * {x} ** 2) + 1 / (120 * {x} ** 4) - 1 / (252 * {x} ** 6) - {first})"


def _near() -> str:
    """Every row against every other one of its feature, on the grid of the operator."""
    grid = 1 << 20
    each = " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS feature, CAST({c} AS DOUBLE) AS x, y FROM near_frame" for i, c in enumerate(NEAR_FEATURES)
    )
    return _with(
        "hourly types type_grid type_dense type_lagged near_frame",
        """
        SELECT CAST(position AS INTEGER) AS position, feature, round(mi, 8) AS mi,
               round((mi - min(mi) OVER ()) / nullif(max(mi) OVER () - min(mi) OVER (), 0), 8) AS score
        FROM (SELECT position, feature, round(greatest(0, {all_} + sum({kth} - {near_x} - {near_y}) / count(*)), 10) AS mi
              FROM near GROUP BY position, feature)""".format(
            all_=_digamma("count(*)"), kth=_digamma("kth"), near_x=_digamma("nx"), near_y=_digamma("ny")
        ),
        f"""given AS ({each}),
        placed AS (
            SELECT position, feature, row_number() OVER () AS id,
                   CAST(floor(x / stddev_pop(x) OVER (PARTITION BY position) * {grid} + 0.5) AS BIGINT) AS x,
                   CAST(floor(y / stddev_pop(y) OVER (PARTITION BY position) * {grid} + 0.5) AS BIGINT) AS y
            FROM given
        ),
        reach AS (
            SELECT a.position, a.id, min(greatest(abs(a.x - b.x), abs(a.y - b.y)), {NEIGHBOURS})[{NEIGHBOURS}] AS eps
            FROM placed a JOIN placed b ON a.position = b.position AND a.id <> b.id GROUP BY ALL
        ),
        near AS (
            SELECT a.position, a.feature, a.id,
                   CASE WHEN eps > 0 THEN {NEIGHBOURS} ELSE count(*) FILTER (a.x = b.x AND a.y = b.y) - 1 END AS kth,
                   count(*) FILTER (abs(a.x - b.x) < greatest(eps, 1)) AS nx,
                   count(*) FILTER (abs(a.y - b.y) < greatest(eps, 1)) AS ny
            FROM placed a JOIN reach r ON r.id = a.id JOIN placed b ON a.position = b.position
            GROUP BY a.position, a.feature, a.id, eps
        )""",
    )


def _ridge() -> str:
    """Normal equations of each fold and penalty, solved by elimination row by row, and their scores."""
    columns = RIDGE_FEATURES
    p = len(columns)

    def cell(i: int, j: int) -> str:
        other = columns[j] if j < p else "y"
        ridge = " + penalty * count(*)" if i == j else ""
        return f"covar_pop({columns[i]}, {other}) * count(*){ridge}"

    matrix = ", ".join("[" + ", ".join(cell(i, j) for j in range(p + 1)) + "]" for i in range(p))
    means = ", ".join(f"avg({c})" for c in columns)
    penalties = ", ".join(f"{v}::DOUBLE" for v in RIDGE_PENALTIES)
    fitted = " + ".join(f"m[{i + 1}][{p + 1}] * {c}" for i, c in enumerate(columns))
    centre = " + ".join(f"m[{i + 1}][{p + 1}] * means[{i + 1}]" for i in range(p))
    return _with(
        "hourly types type_grid type_dense type_lagged type_frame type_numbered type_folds",
        f"""
        SELECT e.penalty, CAST(e.fold AS INTEGER) AS fold, e.train_end, e.fold_end, e.n_train, {_scores("y", "yhat")}
        FROM (
            SELECT s.*, f.y, s.mean_y - ({centre}) + ({fitted}) AS yhat
            FROM solved s JOIN type_frame f ON f.ts > s.train_end AND f.ts <= s.fold_end
            WHERE s.k = {p}
        ) e GROUP BY ALL""",
        f"""sums AS (
            SELECT penalty, fold, train_end, fold_end, count(*) AS n_train, [{matrix}] AS m, [{means}] AS means, avg(y) AS mean_y
            FROM type_frame JOIN type_folds ON ts <= train_end, (SELECT unnest([{penalties}]) AS penalty)
            GROUP BY penalty, fold, train_end, fold_end
        ),
        solved AS (
            SELECT *, 0 AS k FROM sums
            UNION ALL
            SELECT penalty, fold, train_end, fold_end, n_train,
                   list_transform(range(1, {p + 1}), lambda i: CASE WHEN i = k + 1
                       THEN list_transform(m[i], lambda x: x / m[i][i])
                       ELSE list_transform(range(1, {p + 2}), lambda j: m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END),
                   means, mean_y, k + 1
            FROM solved WHERE k < {p}
        )""",
    )


_BACKTEST = f"""
origins AS (
    SELECT o.series, n.n AS horizon, o.split, arg_max(f.y, f.ts) AS naive_forecast, max(f.ts) AS origin
    FROM (
        SELECT series, n, max(ts) - n * INTERVAL 1 HOUR AS split
        FROM frame, range(1, {HORIZON + 1}) r(n) GROUP BY series, n
    ) o
    JOIN range(1, {HORIZON + 1}) n(n) ON n.n = o.n
    JOIN frame f ON f.series = o.series AND f.ts <= o.split
    GROUP BY ALL
),
starts AS (
    SELECT o.series, o.horizon, o.split, o.naive_forecast, f.ts + INTERVAL 1 HOUR AS ts,
           list_append({LAG_LIST}[2:], f.y) AS l
    FROM origins o JOIN frame f ON f.series = o.series AND f.ts = o.origin
),
path AS (
    SELECT series, horizon, split, naive_forecast, 1 AS step, ts, l, {_forecast("l")} AS f FROM starts
    UNION ALL
    SELECT series, horizon, split, naive_forecast, step + 1, ts + INTERVAL 1 HOUR, l2, {_forecast("l2")}
    FROM (SELECT *, list_append(l[2:], f) AS l2 FROM path) WHERE step < horizon
),
report AS (
    SELECT CAST(horizon AS INTEGER) AS horizon,
        round(1 - sum((y - f) ** 2) / nullif(regr_syy(y, y), 0), 4) AS r2,
        round(sqrt(avg((y - f) ** 2)), 4) AS rmse,
        round(1 - sum((y - naive_forecast) ** 2) / nullif(regr_syy(y, y), 0), 4) AS naive_r2,
        round(sqrt(avg((y - naive_forecast) ** 2)), 4) AS naive_rmse
    FROM path JOIN frame USING (series, ts)
    WHERE ts > split
    GROUP BY horizon
)"""

_NLAGS = 30
_ACF = f"""
centred AS (SELECT series, ts, y - avg(y) OVER (PARTITION BY series) AS c FROM dense),
products AS (
    SELECT series, c, {", ".join(f"lag(c, {k}) OVER w AS c{k}" for k in range(_NLAGS + 1))}
    FROM centred WINDOW w AS (PARTITION BY series ORDER BY ts)
),
correlations AS (
    SELECT series, [{", ".join(f"coalesce(sum(c * c{k}), 0) / nullif(sum(c * c), 0)" for k in range(_NLAGS + 1))}] AS r
    FROM products GROUP BY series
)"""
_PACF = f"""{_ACF},
durbin AS (
    SELECT series, r, 0 AS k, []::DOUBLE[] AS phi, 1.0::DOUBLE AS v, 1.0::DOUBLE AS pacf
    FROM correlations
    UNION ALL
    SELECT series, r, k + 1,
           list_append([phi[i] - a * phi[k + 1 - i] FOR i IN range(1, k + 1)], a),
           v * (1 - a * a), a
    FROM (
        SELECT *, (r[k + 2] - coalesce(list_sum([phi[i] * r[k + 2 - i] FOR i IN range(1, k + 1)]), 0)) / v AS a
        FROM durbin WHERE k < {_NLAGS}
    )
)"""


def _mutual_information(label: str = "y") -> str:
    names = PANEL.feature_names
    listed = ", ".join(f"CAST({name} AS DOUBLE)" for name in names)
    labels = ", ".join(f"'{name}'" for name in names)
    bin_of = "CAST(least({last}, coalesce(floor(({v} - {lo}) / nullif({hi} - {lo}, 0) * {bins}), 0)) AS INTEGER)"

    def binned(v: str, lo: str, hi: str) -> str:
        return bin_of.format(v=v, lo=lo, hi=hi, last=BINS - 1, bins=BINS)

    return f"""
    long AS (
        SELECT unnest(range(0, {len(names)})) AS position, unnest([{listed}]) AS x, {label} AS y FROM frame
    ),
    binned AS (
        SELECT position, {binned("x", "lo", "hi")} AS bx, {binned("y", "y_lo", "y_hi")} AS by_
        FROM (
            SELECT *, min(x) OVER (PARTITION BY position) AS lo, max(x) OVER (PARTITION BY position) AS hi,
                   min(y) OVER () AS y_lo, max(y) OVER () AS y_hi
            FROM long
        )
        WHERE x IS NOT NULL AND y IS NOT NULL
    ),
    cells AS (SELECT position, bx, by_, count(*) AS n FROM binned GROUP BY ALL),
    joint AS (
        SELECT position, n, sum(n) OVER (PARTITION BY position) AS total,
               sum(n) OVER (PARTITION BY position, bx) AS nx, sum(n) OVER (PARTITION BY position, by_) AS ny
        FROM cells
    ),
    info AS (
        SELECT position, round(sum(n / total * ln(n * total / (nx * ny))), 10) AS mi
        FROM joint GROUP BY position
    ),
    scores AS (
        SELECT CAST(position AS INTEGER) AS position, ([{labels}])[position + 1] AS feature, mi,
               (mi - min(mi) OVER ()) / nullif(max(mi) OVER () - min(mi) OVER (), 0) AS score
        FROM info
    )"""


def _with_extra(names: str, extra: str, body: str) -> str:
    parts = ", ".join(f"{name} AS ({CTES[name]})" for name in names.split())
    return f"WITH {parts}, {extra} {body}"


def oracle_queries() -> dict[str, str]:
    shift = f"datesub('hour', min(ts) OVER (PARTITION BY {{key}}), {_stamp(PANEL.anchor)})"
    sql = {
        "align_series_start": f"""
            SELECT event_type AS series, ts + to_hours({shift.format(key="event_type")}) AS ts, value AS y
            FROM events""",
        "clip_time_range": f"""
            SELECT event_type AS series, ts, value AS y FROM events
            WHERE ts BETWEEN {_stamp(AS_OF - PANEL.lookback)} AND {_stamp(AS_OF)}""",
        "densify_hourly": _with("group_hourly groups grid", "SELECT series, ts, y FROM grid"),
        "densify_daily": _with("days days_grid days_dense", "SELECT series, ts, y FROM days_dense"),
        "forward_fill": _with(DENSE, "SELECT series, ts, y FROM dense"),
        "dedup_keep_first": _with(
            "hourly", "SELECT series, ts, min(y) AS y FROM hourly GROUP BY series, ts"
        ),
        "preprocess": f"""
            WITH hourly AS ({CTES["hourly"]}),
            moved AS (
                SELECT series, ts + to_hours({shift.format(key="series")}) AS ts, y FROM hourly
            ),
            kept AS (
                SELECT series, ts, min(y) AS y FROM moved
                WHERE ts BETWEEN {_stamp(ALIGNED_AS_OF - PANEL.lookback)} AND {_stamp(ALIGNED_AS_OF)}
                GROUP BY series, ts
            ),
            grid AS ({_dense("kept")})
            {_filled("grid")}""",
        "quality_report": _with(
            "group_hourly",
            """
            , keys AS (SELECT series, ts, count(*) AS n FROM group_hourly GROUP BY series, ts),
            copies AS (SELECT count(*) AS n FROM group_hourly GROUP BY series, ts, y HAVING count(*) > 1),
            gaps AS (
                SELECT greatest(0, datesub('hour', min(ts), max(ts)) + 1 - count(*)) AS g
                FROM keys GROUP BY series
            )
            SELECT CAST(count(*) AS BIGINT) AS rows,
                   CAST(count(*) FILTER (series IS NULL) AS BIGINT) AS null_series,
                   CAST(count(*) FILTER (ts IS NULL) AS BIGINT) AS null_times,
                   CAST(count(*) FILTER (y IS NULL) AS BIGINT) AS null_targets,
                   CAST(count(*) FILTER (isnan(y)) AS BIGINT) AS nan_targets,
                   CAST((SELECT coalesce(sum(n), 0) FROM copies) AS BIGINT) AS duplicate_rows,
                   CAST((SELECT coalesce(sum(n), 0) FROM keys WHERE n > 1) AS BIGINT) AS duplicate_keys,
                   CAST((SELECT sum(g) FROM gaps) AS BIGINT) AS missing_slots
            FROM group_hourly""",
        ),
        "quality_report_off_grid": """
            WITH readings AS (SELECT event_type AS series, ts, value AS y FROM events),
            copies AS (SELECT count(*) AS n FROM readings GROUP BY series, ts, y HAVING count(*) > 1),
            keys AS (SELECT series, ts, count(*) AS n FROM readings GROUP BY series, ts),
            grid AS (
                SELECT series, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
                FROM readings GROUP BY series
            )
            SELECT CAST(count(*) AS BIGINT) AS rows,
                   CAST(count(*) FILTER (series IS NULL) AS BIGINT) AS null_series,
                   CAST(count(*) FILTER (ts IS NULL) AS BIGINT) AS null_times,
                   CAST(count(*) FILTER (y IS NULL) AS BIGINT) AS null_targets,
                   CAST(count(*) FILTER (isnan(y)) AS BIGINT) AS nan_targets,
                   CAST((SELECT coalesce(sum(n), 0) FROM copies) AS BIGINT) AS duplicate_rows,
                   CAST((SELECT coalesce(sum(n), 0) FROM keys WHERE n > 1) AS BIGINT) AS duplicate_keys,
                   CAST((SELECT count(*) FROM grid ANTI JOIN keys USING (series, ts)) AS BIGINT) AS missing_slots
            FROM readings""",
        "trailing_window": _with(
            "group_hourly groups",
            f"""SELECT series, ts, y FROM groups
            QUALIFY ts >= max(ts) OVER (PARTITION BY series) - {LOOKBACK}""",
        ),
        "lag_features": _with("group_hourly groups gappy_lagged", "SELECT * FROM gappy_lagged"),
        "window_mean_features": _with(
            "group_hourly groups gappy_lagged",
            f"SELECT series, ts, {_means(rounded=True)} FROM gappy_lagged",
        ),
        "hour_encoding": f"SELECT event_id, ts, {_encoding('hour(ts - INTERVAL 5 HOUR)')} FROM events",
        "daypart_flags": f"SELECT event_id, ts, {_flags('hour(ts - INTERVAL 5 HOUR)')} FROM events",
        "feature_frame": _with(
            "group_hourly groups grid dense lagged", _features("lagged", rounded=True)
        ),
        "feature_frame_daily": _with(
            "days days_grid days_dense days_lagged",
            _features("days_lagged", rounded=True, spec=DAILY),
        ),
        "holdout_split": _with(DENSE + " flagged", "SELECT series, ts, y, is_test FROM flagged"),
        "neighbour_information": _near(),
        "walk_forward_ridge": _ridge(),
        "fold_boundaries": _with(
            "group_hourly groups numbered folds",
            "SELECT CAST(fold AS INTEGER) AS fold, train_end, fold_end FROM folds",
        ),
        "fold_membership": _with(
            "group_hourly groups numbered folds", _membership("groups", "folds")
        ),
        "fold_membership_one_series": _with(
            "hourly types one one_numbered one_folds", _membership("one", "one_folds")
        ),
        "latest_per_series": _with(
            "group_hourly groups",
            """SELECT series, ts, y FROM groups
            QUALIFY row_number() OVER (PARTITION BY series ORDER BY ts DESC) = 1""",
        ),
        "next_step_features": _with(
            FRAME + " latest states", _step_features(forecast=False)
        ),
        "one_step_forecast": _with(FRAME + " latest states", _step_features(forecast=True)),
        "multi_step_forecast": _with(
            FRAME + " latest states",
            _step_features(forecast=False, source="path", also=", f AS forecast", places=10),
            recursive=f"""path AS (
                SELECT series, ts, l, 1 AS step, {_forecast("l")} AS f FROM states
                UNION ALL
                SELECT series, ts + INTERVAL 1 HOUR, l2, step + 1, {_forecast("l2")}
                FROM (SELECT *, list_append(l[2:], f) AS l2 FROM path) WHERE step < {HORIZON}
            )""",
        ),
        "persistence_forecast": _with(
            DENSE + " flagged naive", "SELECT series, ts, y, naive_forecast FROM naive"
        ),
        "evaluation_metrics": _with(
            DENSE + " flagged naive", f"SELECT {_scores('y', 'naive_forecast')} FROM naive"
        ),
        "evaluation_metrics_unanswered": _with(
            DENSE + " flagged naive",
            f"""SELECT series, {_scores('y', 'f')} FROM (
                SELECT series, y,
                    CASE WHEN series LIKE 'c%' AND hour(ts) = 3 THEN NULL ELSE naive_forecast END AS f
                FROM naive
            ) GROUP BY series""",
        ),
        "backtest_report": _with(FRAME, "SELECT * FROM report", recursive=_BACKTEST),
        "backtest_gate": _with(
            FRAME,
            """SELECT round(avg(r2), 8) AS mean_r2, round(avg(naive_r2), 8) AS mean_naive_r2,
                bool_and(coalesce(r2 > 0.8, false)) AND avg(r2) > greatest(0.8, avg(naive_r2)) AS passed
            FROM report""",
            recursive=_BACKTEST,
        ),
        "new_rows_above_watermark": _with(
            DENSE + " stored batch fresh", "SELECT series, ts, y FROM fresh"
        ),
        "append_processed": _with(
            DENSE + " stored batch fresh", "SELECT * FROM stored UNION ALL SELECT * FROM fresh"
        ),
        "insert_if_absent": _with(
            DENSE + " batch forecasts",
            """SELECT * FROM forecasts
            UNION ALL
            SELECT b.series, b.ts + INTERVAL 1 HOUR, b.y / 2 FROM batch b
            WHERE NOT EXISTS (
                SELECT 1 FROM forecasts f WHERE f.series = b.series AND f.ts = b.ts + INTERVAL 1 HOUR)""",
        ),
        "incremental_ingest": _with(
            "group_hourly",
            f""", kept AS (SELECT series, ts, min(y) AS y FROM group_hourly GROUP BY series, ts),
            first_batch AS (SELECT * FROM kept WHERE ts <= {_stamp(CUT)}),
            marks AS (SELECT series, max(ts) AS mark FROM first_batch GROUP BY series)
            SELECT * FROM first_batch
            UNION ALL
            SELECT k.series, k.ts, k.y FROM kept k LEFT JOIN marks m USING (series)
            WHERE k.ts >= {_stamp(OVERLAP)} AND (m.mark IS NULL OR k.ts > m.mark)""",
        ),
        "forecast_coverage": _with("group_hourly groups forecasts coverage", "SELECT * FROM coverage"),
        "missing_forecasts": _with(
            DENSE + " forecasts coverage missing", "SELECT series, ts FROM missing"
        ),
        "backfill_forecasts": _with(
            FRAME + " forecasts coverage missing",
            f"""SELECT series, ts, forecast FROM forecasts
            UNION ALL
            SELECT m.series, m.ts, {_forecast("s.l")}
            FROM missing m JOIN (
                SELECT series, ts + INTERVAL 1 HOUR AS ts, list_append({LAG_LIST}[2:], y) AS l FROM frame
            ) s ON s.series = m.series AND s.ts = m.ts""",
        ),
        "backfill_forecasts_gappy": _with(
            "group_hourly groups",
            f""", forecasts AS (
                SELECT series, ts, y AS forecast FROM groups WHERE hour(ts) NOT IN (5, 17)
            ),
            observed AS (SELECT *, max(ts) OVER (PARTITION BY series) AS latest FROM groups),
            missing AS (
                SELECT o.series, o.ts FROM observed o
                JOIN (SELECT series, min(ts) AS a, max(ts) AS b FROM forecasts GROUP BY series) c USING (series)
                WHERE o.ts >= o.latest - {LOOKBACK} AND o.ts BETWEEN c.a AND c.b
                  AND NOT EXISTS (SELECT 1 FROM forecasts f WHERE f.series = o.series AND f.ts = o.ts)
            )
            SELECT series, ts, forecast FROM forecasts
            UNION ALL
            SELECT series, ts, {_forecast("l")} FROM (
                SELECT m.series, m.ts, list(g.y ORDER BY g.ts) AS l, max(g.ts) AS last
                FROM missing m JOIN groups g
                    ON g.series = m.series AND g.ts BETWEEN m.ts - INTERVAL 1 HOUR - {LOOKBACK} AND m.ts - INTERVAL 1 HOUR
                GROUP BY m.series, m.ts
            ) WHERE last = ts - INTERVAL 1 HOUR AND len(l) > {PANEL.max_lag}""",
        ),
        "autocorrelation": _with_extra(
            DENSE,
            _ACF,
            f"""SELECT series, CAST(k AS INTEGER) AS lag, round(r[k + 1], 8) AS acf
            FROM correlations, range(0, {_NLAGS + 1}) t(k)""",
        ),
        "partial_autocorrelation": _with(
            DENSE,
            "SELECT series, CAST(k AS INTEGER) AS lag, round(pacf, 8) AS pacf FROM durbin",
            recursive=_PACF,
        ),
        "suggested_max_lag": _with(
            DENSE,
            f"""SELECT CAST(round_even(max(k) / {PANEL.step}, 0) AS INTEGER) * {PANEL.step} AS max_lag
            FROM durbin WHERE abs(pacf) > 0.1""",
            recursive=_PACF,
        ),
        "mutual_information": _with_extra(
            FRAME,
            _mutual_information(),
            "SELECT position, feature, round(mi, 8) AS mi, round(score, 8) AS score FROM scores",
        ),
        "mutual_information_null_labels": _with_extra(
            FRAME,
            _mutual_information("CASE WHEN hour(ts) <> 3 THEN y END"),
            "SELECT position, feature, round(mi, 8) AS mi, round(score, 8) AS score FROM scores",
        ),
        "selected_features": _with_extra(
            FRAME,
            _mutual_information(),
            f"""SELECT position, feature, round(score, 8) AS score FROM scores
            WHERE score >= (
                SELECT score FROM (
                    SELECT score, row_number() OVER (ORDER BY score) AS r, count(*) OVER () AS n FROM scores
                ) WHERE r = round((n - 1) * {QUANTILE}, 0) + 1)""",
        ),
        "model_lineage": _with(
            FRAME + " flagged naive",
            f"""SELECT 'persistence' AS name, 'processed' AS data_location,
                min(ts) - INTERVAL {PANEL.max_lag} HOUR AS data_start,
                min(ts) - INTERVAL {PANEL.max_lag} HOUR + {LOOKBACK} AS data_end,
                max(ts) AS data_max, {int(TRAINED.timestamp())}::BIGINT AS when_trained,
                '{{"test_size":{TEST_SIZE},"kind":"persistence"}}' AS params,
                (SELECT round(sqrt(avg((y - naive_forecast) ** 2)), 4) FROM naive) AS rmse,
                CAST(NULL AS DOUBLE) AS untuned_rmse
            FROM frame""",
        ),
        "lineage_newest_first": _with(
            DENSE + " flagged naive",
            f""", scored AS (SELECT series, {_scores('y', 'naive_forecast')} FROM naive GROUP BY series),
            dated AS (SELECT series, max(ts) AS when_trained FROM groups GROUP BY series)
            SELECT series AS name, when_trained, rmse
            FROM dated JOIN scored USING (series) ORDER BY when_trained DESC, series""",
        ),
    }
    sql["versioned_ingest"] = sql["incremental_ingest"]
    return {name: " ".join(text.split()) for name, text in sql.items()}


def _step_features(forecast: bool, source: str = "states", also: str = "", places: int = 8) -> str:
    means = ", ".join(
        "round((" + " + ".join(f"l[-{i}]" for i in range(1, k + 1)) + f") / {k}, {places}) AS avg_{k}_lags"
        for k in PANEL.mean_sizes
    )
    lags = ", ".join(f"l[-{k}] AS lag_{k}" for k in PANEL.lags)
    extra = f", {_forecast('l')} AS forecast" if forecast else also
    return f"SELECT series, ts, {_calendar()}, {means}, {lags}{extra} FROM {source}"
