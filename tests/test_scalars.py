from datetime import date

import pytest
from pyspark.sql import functions as F

from rankloom.functions import scalars as S

SECOND = 1_704_189_845  # 2024-01-02 10:04:05 in UTC
TIMES = {
    "2024-01-02T10:04:05Z": SECOND,
    "2024-01-02T10:04:05": SECOND,
    "2024-01-02 10:04:05": SECOND,
    "2024-01-02T18:04:05+08:00": SECOND,
    "2024-01-02T04:34:05.000-05:30": SECOND,
    "2024-01-02T10:04": SECOND - 5,
    "2024-01-02": SECOND - 36245,
    **dict.fromkeys(["12:30", "2024", "2024-01", "2024-1-2 3:4:5", "2024-01-02T", "2024-13-02", "2024-01-02T10:04:05 UTC", "yesterday", "", None]),
}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_times_are_strict_and_in_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in TIMES], "t STRING")
        assert {r.t: r.s for r in df.select("t", F.unix_seconds(S.parse_timestamp_utc(F.col("t"))).alias("s")).collect()} == TIMES
        late = spark.createDataFrame([("2024-01-01T23:30:00-02:00",)], "t STRING")
        assert late.select(S.age_days(F.lit(date(2024, 1, 5)), F.col("t"))).first()[0] == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lists_of_violations(spark):
    rules = [(F.col("id") > k, f"over_{k}") for k in range(3)] + [(F.lit(None).cast("boolean"), "unknown")]
    df = spark.range(4).select(S.violations(*rules).alias("v"))
    assert [r.v for r in df.collect()] == [[], ["over_0"], ["over_0", "over_1"], ["over_0", "over_1", "over_2"]]
    assert "WholeStageCodegen" in df._jdf.queryExecution().executedPlan().toString() or "*(1)" in df._jdf.queryExecution().executedPlan().toString()
