"""The incremental run against a full one, and which files it leaves alone."""

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skygauge.operators import features as X, labels as L, propagate as P
from skygauge.plans import advance as A


def table(df):
    columns = sorted(df.columns)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()), key=repr)


def files(root, zone):
    """(district, year) -> names of its data files."""
    found = {}
    for f in Path(root, zone).rglob("*.parquet"):
        parts = dict(p.split("=") for p in f.parts if "=" in p)
        found.setdefault((parts["District"], int(parts["year"])), set()).add(f.name)
    return found


def rewritten(before, after):
    return {block for block in after if before.get(block) != after[block]}


@pytest.fixture(scope="module")
def series():
    rng = random.Random(3)

    def values(n, gaps=0.3):
        return [(20 + 25 * rng.random(), None if rng.random() < 0.2 else 90 * rng.random(), None if rng.random() < gaps else 40 + 50 * rng.random())
                for _ in range(n)]
    return {"A": values(1500), "007": values(900), "C": values(2)}


def assert_like_full(spark, root, whole):
    """Every zone equals what a full run over ``whole`` gives."""
    merged = A._zone(spark, root, "merged")
    assert table(merged.select(whole.columns)) == table(whole)
    full = X.build_features(whole)
    assert table(A.read_features(spark, root).select(full.columns)) == table(full)
    labels = L.hazard_labels(whole)
    assert table(A.read_labels(spark, root).select(labels.columns)) == table(labels)
    assert A._zone(spark, root, "predictions").count() == 2 * whole.count()


def test_a_late_row_rewrites_what_it_reaches(spark, panel, series, tmp_path):
    root, history = str(tmp_path / "zones"), panel(series)
    A.apply_changes(spark, root, history, newest=None)
    zones = ("merged", "features", "labeled", "predictions")
    before = {z: files(root, z) for z in zones}
    # A has rows of 2019 to 2024; one row early in 2021 is replaced by a slightly warmer, drier one
    day = date(2021, 2, 3)
    late = history.filter((F.col("District") == "A") & (F.col("Date") == F.lit(day))).withColumns({
        "MaxTemp_2m": F.lit(21.5), "Precip": F.lit(1.0), "ingestion_time": F.lit("2030-01-01 00:00:00")})
    A.apply_changes(spark, root, late)
    whole = history.join(late.select("District", "Date"), ["District", "Date"], "left_anti").unionByName(late.drop("ingestion_time"))
    assert_like_full(spark, root, whole)
    after = {z: files(root, z) for z in zones}
    assert rewritten(before["merged"], after["merged"]) == {("A", 2021)}
    assert rewritten(before["features"], after["features"]) == {("A", 2021)}  # 331 rows of the year follow: more than the reach
    assert rewritten(before["predictions"], after["predictions"]) == {("A", 2021)}
    assert {d for d, _ in rewritten(before["labeled"], after["labeled"])} <= {"A"}


def test_changes_at_a_block_end_and_repeats(spark, panel, series, tmp_path):
    root, history = str(tmp_path / "zones"), panel(series)
    first = history.filter("Date < '2021-12-20' or District <> 'A'")
    A.apply_changes(spark, root, first, newest=None)
    before = files(root, "features")
    # new rows reach into the next year, a new district appears, rows of one key repeat
    new = history.filter("District = 'A' and Date >= '2021-12-20'").withColumn("ingestion_time", F.lit("2030-01-01 00:00:00"))
    older = new.withColumns({"MaxTemp_2m": F.lit(99.0), "ingestion_time": F.lit("2029-01-01 00:00:00")})
    fresh = new.filter("Date < '2021-12-23'").withColumn("District", F.lit("Z"))
    rows = new.unionByName(older).unionByName(fresh).unionByName(fresh)
    A.apply_changes(spark, root, rows)
    assert not {d for d, _ in rewritten(before, files(root, "features"))} & {"007", "C"}
    labeled = files(root, "labeled")
    A.apply_changes(spark, root, rows)  # a repeated run changes nothing, nor does one without rows
    A.apply_changes(spark, root, rows.limit(0))
    assert files(root, "labeled") == labeled
    assert_like_full(spark, root, history.unionByName(fresh.drop("ingestion_time")))


def test_fills_and_runs_travel_through_whole_years(spark, panel, tmp_path):
    """Humidity known on one day only, and one heat run over three years: both reach far blocks."""
    root = str(tmp_path / "zones")
    history = panel({"A": [(20.0, 1.0, 60.0)] + [(30.0 if i > 20 else 10.0 + i / 100, 0.0, None) for i in range(800)]})
    A.apply_changes(spark, root, history, newest=None)
    for value, temp in ((77.0, 45.0), (None, 5.0)):
        late = history.filter(F.col("Date") == F.lit(date(2020, 3, 1))).withColumns({
            "RH_2m": F.lit(value).cast("double"), "MaxTemp_2m": F.lit(temp), "ingestion_time": F.lit(f"2030-01-0{1 if value else 2} 00:00:00")})
        A.apply_changes(spark, root, late)
    whole = history.filter(F.col("Date") != F.lit(date(2020, 3, 1))).unionByName(late.drop("ingestion_time"))
    assert_like_full(spark, root, whole)


def test_no_rows_at_all(spark, panel, tmp_path):
    root = str(tmp_path / "zones")
    A.apply_changes(spark, root, panel({"A": [(1.0, 1.0, 1.0)]}).limit(0), newest=None)
    assert A._zone(spark, root, "merged") is None and A._zone(spark, root, "features") is None


def test_reach_by_hand(spark):
    rows = spark.createDataFrame([("A", y, date(y, 1, d)) for y in range(2000, 2010) for d in range(1, 5)], "District string, year int, Date date")
    touched = spark.createDataFrame([("A", 2003, date(2003, 1, 3))], "District string, year int, last date")
    got = {r.year: (r.affected, r.context) for r in P.reached(rows, touched, 5).collect()}
    # one row of 2003 follows, so the fifth row after the change is the last of 2004; 2002 and 2001 hold the five rows before
    assert [y for y, (a, _) in sorted(got.items()) if a] == [2003, 2004]
    assert [y for y, (_, c) in sorted(got.items()) if c] == [2001, 2002]
