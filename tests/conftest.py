import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("skygauge-tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").config("spark.log.level", "ERROR")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def panel(spark):
    """Build a panel from {district: [(date, temp, rain, humidity), ...]}."""
    from datetime import date, timedelta

    def build(histories, start=date(2019, 12, 25), step=1):
        rows = []
        for district, values in histories.items():
            for i, (temp, rain, rh) in enumerate(values):
                rows.append((district, start + timedelta(days=i * step), temp, rain, rh, 5.0))
        return spark.createDataFrame(
            rows, "District string, Date date, MaxTemp_2m double, Precip double, RH_2m double, TempRange_2m double").repartition(3)
    return build
