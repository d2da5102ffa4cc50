import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from panel_helpers import HOUR, T0, as_dict, hours, panel

from gridpulse.operators import prepare
from gridpulse.operators.blocks import attach_per_series
from gridpulse.sources.panels import PANEL

BLOCKS = [3, 4096]


def spec_of(block_rows):
    return replace(PANEL, block_rows=block_rows)


def holey(seed, n_series=4, span=60, keep=0.4, null=0.2):
    """Random rows with holes, nulls, one off-grid series start and off-grid rows."""
    rng = random.Random(seed)
    rows = []
    for s in range(n_series):
        offset = rng.choice([0, 0.25])
        start = rng.randrange(0, 20)
        rows.append((f"s{s}", start + offset, rng.random()))
        for h in range(start + 1, start + span):
            if rng.random() < keep:
                rows.append((f"s{s}", h + offset, None if rng.random() < null else rng.random()))
            if rng.random() < 0.1:
                rows.append((f"s{s}", h + 0.6, 99.0))
    return rows


def brute_dense(rows, fill):
    out = {}
    for series in {s for s, _, _ in rows}:
        own = {hours(h): v for s, h, v in rows if s == series}
        ts, end, last = min(own), max(own), None
        while ts <= end:
            value = own.get(ts)
            last = value if value is not None else last
            out[(series, ts)] = last if fill else value
            ts += HOUR
    return out


@pytest.mark.parametrize("block_rows", BLOCKS)
@pytest.mark.parametrize("fill", [False, True])
def test_densify_equals_brute_force(spark, block_rows, fill):
    rows = holey(block_rows)
    result = prepare.densify(panel(spark, rows).repartition(5), spec_of(block_rows), fill=fill)
    collected = result.collect()
    assert len(collected) == len({(r["series"], r["ts"]) for r in collected})
    assert {(r["series"], r["ts"]): r["y"] for r in collected} == brute_dense(rows, fill)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_forward_fill_after_densify(spark, block_rows):
    rows = holey(17)
    spec = spec_of(block_rows)
    dense = prepare.densify(panel(spark, rows), spec)
    assert as_dict(prepare.forward_fill(dense, spec)) == brute_dense(rows, True)


def test_densify_is_idempotent_and_crosses_long_gaps(spark):
    spec = spec_of(4)
    rows = [("a", 0, 1), ("a", 50, 2), ("b", 7, 3)]
    once = prepare.densify(panel(spark, rows), spec, fill=True)
    assert once.count() == 52
    assert as_dict(prepare.densify(once, spec, fill=True)) == as_dict(once)
    assert as_dict(once)[("a", hours(49))] == 1.0


def test_grid_end_is_floor_of_off_grid_last_row(spark):
    rows = [("a", 0, 1), ("a", 2, 5), ("a", 4.5, 7)]
    dense = as_dict(prepare.densify(panel(spark, rows), spec_of(3), fill=True))
    assert dense == {("a", hours(h)): v for h, v in [(0, 1), (1, 1), (2, 5), (3, 5), (4, 5)]}


def test_forward_fill_golden(spark):
    rows = [("a", 0, 5), ("a", 1, None), ("a", 3, 9), ("b", 0, None), ("b", 1, 2)]
    dense = as_dict(prepare.densify(panel(spark, rows), PANEL, fill=True))
    assert [dense[("a", hours(h))] for h in range(4)] == [5, 5, 5, 9]
    assert dense[("b", hours(0))] is None


def test_alignment_truncates_and_keeps_phase(spark):
    first = datetime(2025, 3, 1, 0, 30)
    df = spark.createDataFrame(
        [("a", first, 1.0), ("a", first + HOUR, 2.0), ("b", datetime(2024, 12, 31, 22, 30), 3.0)],
        "series STRING, ts TIMESTAMP_NTZ, y DOUBLE",
    )
    moved = {r["y"]: r["ts"] for r in prepare.align_series_start(df, PANEL).collect()}
    assert moved[1.0] == datetime(2025, 1, 1, 0, 30)
    assert moved[2.0] == datetime(2025, 1, 1, 1, 30)
    assert moved[3.0] == datetime(2024, 12, 31, 23, 30)


def test_align_and_clip_equals_the_two_steps(spark):
    rows = [(f"s{s}", 40 * s + h, h) for s in range(3) for h in range(60)]
    spec = replace(PANEL, lookback=timedelta(hours=20), block_rows=7)
    df = panel(spark, rows)
    as_of = T0 + 50 * HOUR
    stepwise = prepare.clip_time_range(prepare.align_series_start(df, spec), spec, as_of)
    assert as_dict(prepare.align_and_clip(df, spec, as_of)) == as_dict(stepwise)
    assert stepwise.count() == 3 * 21


def test_dedup_tie_breaks(spark):
    rows = [("a", 0, 3), ("a", 0, 2), ("a", 0, None), ("a", 1, None), ("b", 0, 7), ("b", 0, 7)]
    kept = prepare.dedup_keep_first(panel(spark, rows), PANEL)
    assert as_dict(kept) == {("a", T0): 2.0, ("a", hours(1)): None, ("b", T0): 7.0}
    extra = spark.createDataFrame(
        [("a", T0, 3.0, 1), ("a", T0, 2.0, 2), ("a", T0, 1.0, None)],
        "series STRING, ts TIMESTAMP_NTZ, y DOUBLE, arrived INT",
    )
    row = prepare.dedup_keep_first(extra, PANEL, order=["arrived"]).first()
    assert (row["y"], row["arrived"]) == (3.0, 1)


def test_preprocess_fills_gap_with_kept_duplicate(spark):
    rows = [("a", 0, 9), ("a", 0, 4), ("a", 2, 6), ("b", 0, 1)]
    result = as_dict(prepare.preprocess(panel(spark, rows), PANEL, T0 + 10 * HOUR))
    assert result == {
        ("a", hours(0)): 4.0,
        ("a", hours(1)): 4.0,
        ("a", hours(2)): 6.0,
        ("b", hours(0)): 1.0,
    }


def test_grid_functions_ignore_the_session_zone(spark):
    rows = [("a", h, h) for h in range(0, 24 * 200, 24)]
    expected = as_dict(prepare.densify(panel(spark, rows), PANEL, fill=True))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert as_dict(prepare.densify(panel(spark, rows), PANEL, fill=True)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_attach_per_series_how(spark):
    df = panel(spark, [("a", 0, 1), ("a", 9, 2), ("b", 0, 3)])
    per_series = spark.createDataFrame([("a", 5)], "series STRING, extra INT")
    spec = spec_of(2)
    inner = attach_per_series(df, per_series, spec).collect()
    assert sorted(r["y"] for r in inner) == [1.0, 2.0]
    left = attach_per_series(df, per_series, spec, how="left").collect()
    assert {r["y"]: r["extra"] for r in left} == {1.0: 5, 2.0: 5, 3.0: None}
