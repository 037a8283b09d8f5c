"""Dates as people write them, held against an independent parser."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tripgauge.functions.columns import parse_time
from tripgauge.functions.dates import lenient_time

DEFAULT = datetime(2026, 5, 7)
DAYS = [datetime(2026, 5, 6, 14, 0, 39), datetime(1999, 12, 31, 0, 5, 0), datetime(2024, 2, 29, 12, 30, 1)]
SHAPES = [
    "%B %d, %Y %I%p", "%b %d %Y %H:%M:%S", "%d %B %Y", "%d-%b-%Y %H:%M", "%A, %d %B %Y %I:%M %p", "%a %b %d %H:%M:%S %Y",
    "%m/%d/%Y", "%m/%d/%y %I:%M%p", "%d/%m/%Y %H:%M", "%d.%m.%Y", "%Y/%m/%d %H:%M:%S", "%Y.%m.%d", "%Y %B %d",
    "%B %Y", "%b %d", "%d %b", "%b %dth, %Y", "%I:%M:%S %p %d %b %Y", "%m-%d-%Y %H:%M:%S.%f", "%Y-%m", "%d %b %y",
    "%Y-%b-%d", "%d of %B %Y", "%Y/%m/%dT%H:%M:%S", "%b %d, %Y at %H:%M", "%a, %d %b %Y %H:%M:%S GMT",
    "%d %b %Y %H:%M:%S +0200", "%d %b %Y %H:%M:%S -05:30", "%b. %d, %Y %I:%M a.m.",
]
OTHERS = [
    "May 6, 2026 2pm", "2pm", "12 am", "12:30 p.m.", "friday", "Thursday 9am", "6 May 26", "may 6 26", "31/12/99", "13/1/2026",
    "1/13/2026", "May", "2026 May", "feb 30 2026", "13:61", "25:00 May 6", "14pm May 6", "14:00 pm May 6", "30pm May 6", "May June 6", "garbage", "about 7",
    "May 6 2026 nonsense", "32/13/2026", "", "  ", "Sept 5, 2026", "5", "Feb", "1/2/3", "99-1-2", "may 6 70", "may 6 80",
]


def expected(text):
    parser = pytest.importorskip("dateutil.parser")
    try:
        out = parser.parse(text.strip(), default=DEFAULT)
    except Exception:
        return None
    return out.astimezone(timezone.utc).replace(tzinfo=None) if out.tzinfo else out


def read(spark, texts, column):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return {r.text: r.parsed for r in df.select("text", column.alias("parsed")).collect()}


def test_written_dates_against_another_parser(spark):
    texts = [day.strftime(shape) for day in DAYS for shape in SHAPES] + OTHERS
    got = read(spark, texts, lenient_time(F.col("text"), F.lit(DEFAULT)))
    # Two-digit years go by today there, by the default day here.
    years = {t: v for t, v in got.items() if t not in ("may 6 70", "may 6 80")}
    assert years == {t: expected(t) for t in years}
    assert got["may 6 70"] == datetime(2070, 5, 6) and got["may 6 80"] == datetime(1980, 5, 6)


def test_only_what_the_plain_forms_leave_is_read_leniently(spark):
    texts = ["May 6, 2026 2pm", "2026-05-06 14:00:39.165", "garbage", "", None]
    got = read(spark, texts, parse_time(F.col("text"), F.lit(DEFAULT)))
    assert got["May 6, 2026 2pm"] == datetime(2026, 5, 6, 14)
    assert got["2026-05-06 14:00:39.165"] == datetime(2026, 5, 6, 14, 0, 39, 165000)
    assert got["garbage"] == got[""] == got[None] == DEFAULT


def test_offsets_do_not_depend_on_the_zone_of_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        micros = F.unix_micros(lenient_time(F.col("text"), F.lit("2026-05-07").cast("timestamp")))
        got = read(spark, ["6 May 2026 14:00 +0200", "6 May 2026 14:00"], micros)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    noon = int((datetime(2026, 5, 6, 12) - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    assert got["6 May 2026 14:00 +0200"] == noon
    assert got["6 May 2026 14:00"] == noon + 7 * 3_600_000_000


def test_years_no_timestamp_holds_are_no_dates(spark):
    texts = ["300004", "about 300004", "May 6 294247", "about 2147483647", "about 99999999999", "6 May 294246"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", F.unix_micros(lenient_time(F.col("text"), F.lit(DEFAULT))).alias("us")
    ).collect()
    found = {r.text: r.us for r in got}
    assert {t for t, us in found.items() if us is not None} == {"6 May 294246"}
    assert found["6 May 294246"] // 31_556_952_000_000 + 1970 == 294_246
