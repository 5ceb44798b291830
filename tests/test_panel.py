"""Window features, runs and fills against plain Python, on histories that cross many years."""

import random
import re
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygauge.operators import features as X, labels as L, learning as M
from skygauge.operators.blocks import in_blocks, nearest, run_lengths


def by_date(df, district, *columns):
    rows = df.filter(F.col("District") == district).orderBy("Date").select(*columns).collect()
    return [r[0] if len(columns) == 1 else tuple(r) for r in rows]


def maybe(value, rng, share):
    return None if rng.random() < share else value


@pytest.fixture(scope="module", params=[1, 40])
def step(request):
    """Days between rows: consecutive days, or so sparse that a year holds nine rows."""
    return request.param


@pytest.fixture(scope="module")
def values():
    rng = random.Random(5)
    def series(n):
        return [(20 + 25 * rng.random(), maybe(100 * rng.random(), rng, 0.2), maybe(40 + 50 * rng.random(), rng, 0.6)) for _ in range(n)]
    return {"A": series(500), "B": series(20), "C": series(1)}


def test_rolling_and_lags(panel, values, step):
    out = X.build_features(panel(values, step=step))
    for district, series in values.items():
        got = by_date(out, district, "precip_3d", "precip_7d", "maxT_3d_mean", "precip_lag_1", "maxT_lag_14", "API")
        assert len(got) == len(series)
        api = 0.0
        for i, row in enumerate(got):
            def total(n):
                known = [r for _, r, _ in series[max(0, i - n + 1):i + 1] if r is not None]
                return sum(known) if known else None
            temps = [t for t, _, _ in series[max(0, i - 2):i + 1]]
            api = 0.8 * api + (series[i][1] or 0.0)
            assert row[0] == pytest.approx(total(3), abs=1e-8)
            assert row[1] == pytest.approx(total(7), abs=1e-8)
            assert row[2] == pytest.approx(sum(temps) / len(temps), abs=1e-8)
            assert row[3] == (series[i - 1][1] if i >= 1 else None)
            assert row[4] == (series[i - 14][0] if i >= 14 else None)
            assert row[5] == pytest.approx(api, abs=1e-5)


@pytest.mark.parametrize("decay", [0.05, 0.5, 0.6, 0.8, 0.97])
def test_api_decays(panel, values, step, decay):
    got = by_date(X.add_api(panel(values, step=step), decay), "A", "API")
    state, want = 0.0, []
    for _, rain, _ in values["A"]:
        state = decay * state + (rain or 0.0)
        want.append(state)
    assert got == pytest.approx(want, abs=1e-5)


def test_recurrence_by_hand(panel):
    out = X.add_api(panel({"A": [(1.0, 10.0, 1.0), (1.0, None, 1.0), (1.0, 5.0, 1.0)]}))
    assert by_date(out, "A", "API") == [10.0, 8.0, 11.4]


def test_rolling_skips_nulls(panel):
    out = X.add_rolling(panel({"A": [(1.0, 1.0, 1.0)] + [(1.0, None, 1.0)] * 3}))
    assert by_date(out, "A", "precip_3d") == [1.0, 1.0, 1.0, None]


def test_runs_by_hand(panel):
    temps = [0, 50, 50, 50, 50, 0, 50]
    df = in_blocks(panel({"A": [(float(t), 0.0, 1.0) for t in temps]})).withColumn("hot", F.col("MaxTemp_2m") > 40)
    assert by_date(run_lengths(df, "hot", "run"), "A", "run") == [0, 1, 2, 3, 4, 0, 1]


def test_runs_and_fills_cross_years(panel, values, step):
    df = in_blocks(panel(values, step=step)).withColumn("hot", F.col("MaxTemp_2m") > 26)
    got = by_date(nearest(run_lengths(df, "hot", "run"), {"back": F.col("RH_2m")}, {"ahead": F.col("RH_2m")}), "A", "run", "back", "ahead")
    run, back = 0, None
    for i, (temp, _, rh) in enumerate(values["A"]):
        run = run + 1 if temp > 26 else 0
        back = back if rh is None else rh
        ahead = next((h for _, _, h in values["A"][i:] if h is not None), None)
        assert got[i] == (run, back, ahead)


def test_endless_run_over_years(panel):
    df = in_blocks(panel({"A": [(50.0, 0.0, 1.0)] * 60}, step=30)).withColumn("hot", F.lit(True))
    assert by_date(run_lengths(df, "hot", "run"), "A", "run") == list(range(1, 61))


def test_heatwave_flags_and_backfill(panel):
    limits_of = lambda df: df.sparkSession.createDataFrame([("A", 40.0)], "District string, temp_p95 double")
    df = panel({"A": [(float(t), 0.0, 1.0) for t in (0, 50, 50, 50, 50, 0, 50, 50, 0)]})
    plain = L.label_heatwave(df, limits=limits_of(df))
    assert by_date(plain, "A", "heatwave") == [0, 0, 0, 1, 1, 0, 0, 0, 0]
    whole = L.label_heatwave(df, limits=limits_of(df), backfill_run=True)
    assert by_date(whole, "A", "heatwave") == [0, 1, 1, 1, 1, 0, 0, 0, 0]
    assert by_date(L.label_heatwave(df, limits=limits_of(df), min_run=1), "A", "heatwave") == [0, 1, 1, 1, 1, 0, 1, 1, 0]


def test_flood_with_unknown_humidity(panel):
    df = panel({"A": [(1.0, 500.0, None), (1.0, 0.0, None), (1.0, 500.0, 99.0)]})
    limits = df.sparkSession.createDataFrame([("A", 100.0, 1e9, 90.0)], "District string, precip_p99 double, precip3_p98 double, rh_p90 double")
    assert by_date(L.label_flood(df, fill=False, limits=limits), "A", "flood_proxy") == [0, 0, 1]
    assert by_date(L.label_flood(df, fill=False, nulls="propagate", limits=limits), "A", "flood_proxy") == [None, 0, 1]
    assert by_date(L.label_flood(df, limits=limits), "A", "flood_proxy") == [1, 0, 1]  # humidity filled backward


def test_hazard_labels_agree_with_single_labels(panel, values):
    df = panel(values)
    both = L.hazard_labels(df)
    heat, flood = L.label_heatwave(df), L.label_flood(df)
    for d in values:
        assert by_date(both, d, "heatwave") == by_date(heat, d, "heatwave")
        assert by_date(both, d, "flood_proxy") == by_date(flood, d, "flood_proxy")


def test_calendar_windows_see_gaps(panel):
    df = panel({"A": [(1.0, 1.0, 1.0)] * 5}, start=date(2020, 1, 25), step=3)
    assert by_date(X.add_rolling_calendar(df), "A", "precip_3cd", "precip_7cd") == [(1, 1), (1, 2), (1, 3), (1, 3), (1, 3)]


def test_sequences_of_short_history(panel):
    df = panel({"A": [(float(i), 1.0, 1.0) for i in range(14)], "B": [(float(i), 1.0, 1.0) for i in range(16)]}).withColumn("y", F.lit(1))
    train = M.training_sequences(df, ["MaxTemp_2m"], "y").orderBy("District", "Date").collect()
    assert [(r.District, r.sequence[0][0], r.sequence[-1][0]) for r in train] == [("B", 0.0, 13.0), ("B", 1.0, 14.0)]
    scored = M.scoring_sequences(df, ["MaxTemp_2m"]).filter("sequence is not null and District = 'A'").collect()
    assert len(scored) == 1 and scored[0].sequence[-1] == [13.0]
    ahead = M.scoring_sequences(df, ["MaxTemp_2m"], align="next_day").filter("sequence is not null and District = 'B'").collect()
    assert len(ahead) == 2


def test_cold_start_rows(panel):
    early = by_date(X.serving_features(panel({"A": [(30.0 + i, 2.0, 85.0) for i in range(9)]})), "A", "precip_3d", "precip_7d", "maxT_3d_mean", "maxT_lag_1", "API")
    assert early[0] == (6.0, 14.0, 30.0, 30.0, 3.0)
    assert early[3] == (6.0, 14.0, 31.0, 32.0, 3.0)
    assert early[8] == (6.0, 14.0, 36.0, 37.0, 3.0)


@pytest.mark.parametrize("group", [3, 64])
def test_rain_index_over_many_small_blocks(panel, monkeypatch, group):
    """States pass through stretches, blocks and groups of blocks."""
    monkeypatch.setattr(X, "GROUP", group)
    monkeypatch.setattr(X, "STRETCH", 4)
    rng = np.random.default_rng(1)
    rain = [None if r < 0.5 else float(r) for r in rng.exponential(3, 700)]
    df = panel({"A": [(1.0, r, 1.0) for r in rain], "B": [(1.0, 5.0, 1.0)] * 3})
    for block in (F.col("Date"), F.expr("unix_date(Date) div 11"), F.lit(1)):
        for decay in (0.8, 0.02):
            got, state = by_date(X.add_api(df, decay, block=block), "A", "API"), 0.0
            assert len(got) == len(rain)
            for value, r in zip(got, rain):
                state = state * decay + (r or 0.0)
                assert abs(value - state) < 2e-6


def test_windows_never_gather_a_whole_district(panel, values):
    """Row windows run per (District, block); only block summaries are scanned per District."""
    plan = X.build_features(panel(values))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan
    for line in plan.splitlines():
        if "Window [" in line:
            partition = re.findall(r"\[([^\[\]]*)\]", line)[-2]
            # one row per block: sizes, the blocks within reach, and the tree scan of the rain index
            summaries = any(x in line for x in ("sum(_n#", "AS _next#", "row_number() windowspecdefinition(District#", "lead(_block_group#", "collect_list(_group_whole#"))
            assert "District" in partition and ("_block" in partition or summaries), line
