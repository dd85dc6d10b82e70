"""Parsing dates and times, the dearest part of typing a row (finding F4)."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.cleaning import to_date_col, to_timestamp_col
from ledgerlake.sources.landing import write_csv

DATES = ["2024-02-29", "2023-02-29", "2015-02-30", "0000-01-01", "0001-01-01", "9999-12-31", "2024-1-01",
         "2024-01-1", "24-01-01", "2024-13-01", "2024-00-10", "2024-01-01 ", " 2024-01-01", "2024-01-01\n",
         "2024-01-01T", "+2024-01-01", "12024-01-01", "2024/01/01", "31/12/2020", "2024-01", "", "x", None,
         "٢٠٢٤-01-01", "epoch", "now", "1582-10-10"]
TIMES = [None if d is None else f"{d} {t}" for d in DATES for t in (
    "00:00:00", "23:59:59", "24:00:00", "23:60:00", "23:59:60", "1:02:03", "01:02", "01:02:03.5", "01:02:03Z",
    "01:02:03 UTC")] + ["2024-01-01T01:02:03", "2024-01-01  01:02:03", "2024-03-31 02:30:00",
                        "2024-10-27 02:30:00", "01:02:03"]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_plain_texts_are_cast_and_all_read_as_by_the_pattern(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        d = spark.createDataFrame([(t,) for t in DATES], "t string").select(
            "t", to_date_col("t", "null").cast("string").alias("got"),
            F.try_to_date("t", "yyyy-MM-dd").cast("string").alias("want")).collect()
        s = spark.createDataFrame([(t,) for t in TIMES], "t string").select(
            "t", to_timestamp_col("t", "null").cast("bigint").alias("got"),
            F.try_to_timestamp("t", F.lit("yyyy-MM-dd HH:mm:ss")).cast("bigint").alias("want")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r for r in [*d, *s] if r["got"] != r["want"]] == []
    assert sum(r["got"] is not None for r in d) >= 4 and sum(r["got"] is not None for r in s) >= 8
    # the formatter only sees what a cast can't read
    for parse in (to_date_col, to_timestamp_col):
        plan = spark.range(1).select(F.col("id").cast("string").alias("t")).select(parse("t"))
        assert "RLIKE" in plan._jdf.queryExecution().analyzed().toString()


def test_bad_texts_still_fail_the_strict_parse(spark):
    for text, parse in (("2015-02-30", to_date_col), ("2024-01-01 24:00:00", to_timestamp_col)):
        with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|parse"):
            spark.createDataFrame([(text,)], "t string").select(parse("t")).collect()


def test_line_breaks_are_counted_in_any_column(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", None), (2, None, "c\rd"), (3, "e\n", "f\r"), (4, "g", None)],
                               "n int, x string, y string")
    assert write_csv(df, str(tmp_path / "out")) == 3
