import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gaugeflow.runtime import session

    shared = str(tmp_path_factory.mktemp("shared"))
    s = session("tests", "local[8]", 4, spark__driver__memory="8g", spark__checkpoint__dir=shared)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tiny_groups(spark):
    """Settings under which every group of more than a few rows is split."""
    names = {"spark.gaugeflow.maxGroupRows": "25", "spark.gaugeflow.maxFrameRows": "5"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def rows(df, *columns):
    """Rows as a sorted list of plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def under(plan, *texts):
    """Whether a printed plan has nodes with these texts, each somewhere below the one before."""
    above = []
    for edge, node in re.findall(r"^([ :+|-]*)(?:\*\(\d+\) )?(\w.*)", plan, re.M):
        above = [x for x in above if x < len(edge)]
        if texts[len(above)] in node:
            above.append(len(edge))
            if len(above) == len(texts):
                return True
    return False


CITIES = ["London", "New York", "Tokyo", "Sydney", "Berlin", "Mumbai", "Singapore", "Dubai"]
CONDITIONS = ["Clear", "Clouds", "Rain", "Snow", "Thunderstorm", "Drizzle", "Mist"]


@pytest.fixture(scope="session")
def hourly(spark):
    """24 hours of 8 cities."""
    from datetime import datetime, timedelta

    data = [
        (
            city,
            datetime(2024, 1, 1) + timedelta(hours=h),
            float(15 + i % 10 + h % 5),
            50 + i * 3 % 40,
            1010 + i % 20,
            float(3 + i % 8 + h % 3),
            CONDITIONS[i % 7],
            CONDITIONS[i % 7] + " description",
        )
        for i, city in enumerate(CITIES)
        for h in range(24)
    ]
    schema = (
        "city string, observation_time timestamp_ntz, temperature_celsius double, humidity int, pressure int, "
        "wind_speed double, weather_main string, weather_description string"
    )
    return spark.createDataFrame(data, schema)
