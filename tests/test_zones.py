"""Run times are read in the session time zone, whatever the machine's zone is."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from storelens.functions import convert


@pytest.mark.parametrize("zone", ["UTC", "Asia/Vladivostok", "America/New_York"])
def test_run_time_is_wall_clock_of_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        shown = spark.range(1).select(
            F.date_format(convert.at(datetime(2024, 1, 2, 3, 4, 5, 600)), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        ).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert shown == "2024-01-02 03:04:05.000600"
