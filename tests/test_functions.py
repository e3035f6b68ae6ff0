import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import moment, rows, values
from pyspark.sql import functions as F

from muster.functions import rounding, text
from muster.functions.attendance import attendance_flags
from muster.functions.dates import parse_date, parse_datetime


def test_clean_string(spark):
    dirty = ["  a b \t", "\xa0\u3000\n x\x1f\u2029", "NaN", " nat ", "None", "NULL\n", "", "   ", None, "nano", "0"]
    expected = ["a b", "x", None, None, None, None, None, None, None, "nano", "0"]
    assert values(spark, dirty, text.clean_string) == expected


def test_whitespace_is_what_python_strips():
    stripped = {chr(c) for c in range(0x110000) if not chr(c).strip()}
    assert set(text.WHITESPACE) == stripped


def test_null_tokens_match_exactly(spark):
    fields = ["[NULL]", "NULL", "", "NA", "<NA>", "n/a", " NULL", "Null", "nan", "Nan", "x", None]
    expected = [None] * 6 + [" NULL", "Null", None, "Nan", "x", None]
    assert values(spark, fields, text.null_token) == expected
    assert values(spark, ["NA", "-"], lambda c: text.null_token(c, ["-"])) == ["NA", None]


def test_parse_bool(spark):
    words = ["1", "TRUE", "Yes", "0", "no", "t", "", None]
    assert values(spark, words, text.parse_bool) == [True] * 3 + [False] * 5


def test_parse_double(spark):
    texts = ["1.5", "1e3", "-.5", "1_000", "5.", "1.0d", "NaN", "inf", "1e999", "1__0", "abc", "", None]
    expected = [1.5, 1000.0, -0.5, 1000.0, 5.0] + [None] * 8
    assert values(spark, texts, text.parse_double) == expected


def test_parse_decimal_rounds_half_away_and_overflow_is_null(spark):
    texts = ["37.125", "-37.125", "37.1249", "abc", "999.994", "999.995", "99999"]
    expected = [Decimal(x) for x in ("37.13", "-37.13", "37.12")] + [None, Decimal("999.99"), None, None]
    assert values(spark, texts, lambda c: text.parse_decimal(c, 5, 2)) == expected
    too_large = values(spark, texts + [None], lambda c: text.overflows(c, 5, 2))
    assert too_large == [False] * 5 + [True, True, False]


def test_finite_columns(spark):
    numbers = [(1, 1.5), (2, float("nan")), (3, float("inf")), (4, -float("inf")), (5, None)]
    df = spark.createDataFrame(numbers, "id int, x double")
    assert [x for _, x in rows(text.finite_columns(df))] == [1.5, None, None, None, None]


@pytest.mark.parametrize(
    ("written", "expected"),
    [
        ("2025-05-28 10:53:00.000", "2025-05-28 10:53:00"),
        ("2025-05-28T10:53:00.123456789", "2025-05-28 10:53:00.123456"),
        ("2025-05-28", "2025-05-28 00:00:00"),
        ("2025-5-8 9:05", "2025-05-08 09:05:00"),
        ("2025/05/28 10:53", "2025-05-28 10:53:00"),
        ("05/06/2025", "2025-05-06 00:00:00"),
        ("28/05/2025 07:00", "2025-05-28 07:00:00"),
        ("5/28/2025 1:05:30 PM", "2025-05-28 13:05:30"),
        ("5/28/2025 12:05 am", "2025-05-28 00:05:00"),
        ("2025-05-28 12:00 p.m.", "2025-05-28 12:00:00"),
        ("28/05/2025 11:59:59PM", "2025-05-28 23:59:59"),
        ("2025-05-28 10:53:00+01:00", "2025-05-28 10:53:00"),
        ("2024", "2024-01-01 00:00:00"),
        ("12024-01-01", None),
        ("02/30/2024", None),
        ("13/13/2024", None),
        ("10:30 PM", None),
        ("5/28/2025 0:30", "2025-05-28 00:30:00"),
        ("20250528", "2025-05-28 00:00:00"),
        ("20250528103000", "2025-05-28 10:30:00"),
        ("9999-12-31", "9999-12-31 00:00:00"),
        ("0000-01-01", None),
        ("202505", None),
        ("May 28, 2025", "2025-05-28 00:00:00"),
        ("september 3rd 2025 1:05 pm", "2025-09-03 13:05:00"),
        ("28-May-2025", "2025-05-28 00:00:00"),
        ("28 Dec. 2025 10:53", "2025-12-28 10:53:00"),
        ("28.05.2025", "2025-05-28 00:00:00"),
        ("05.06.2025 12:10 AM", "2025-05-06 00:10:00"),
        ("2025.05.28", "2025-05-28 00:00:00"),
        ("05/28/25", "2025-05-28 00:00:00"),
        ("28-5-75 08:00", "2075-05-28 08:00:00"),
        ("5.28.76", "1976-05-28 00:00:00"),
        ("Mayday 28, 2025", None),
        ("31-Feb-2025", None),
        ("2024-13-40", None),
        ("31/02/2024", None),
        ("5/28/2025 13:05 PM", None),
        ("not a date", None),
        (None, None),
    ],
)
def test_parse_datetime(spark, written, expected):
    assert values(spark, [written], parse_datetime) == [expected and moment(expected)]
    assert values(spark, [written], parse_date) == [expected and moment(expected).date()]


def test_parse_datetime_ignores_the_session_time_zone(spark, settings):
    settings(session__timeZone="America/New_York")
    # Clocks skipped this hour in New York.
    assert values(spark, ["2025-03-09 02:30:00"], parse_datetime) == [dt.datetime(2025, 3, 9, 2, 30)]
    assert values(spark, ["3/9/2025 2:30 AM"], parse_datetime) == [dt.datetime(2025, 3, 9, 2, 30)]


def half_up(x: Decimal) -> float:
    return float(x.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_rounding_equals_exact_half_up(spark):
    draw = random.Random(7)
    cases = [(draw.randint(-(10**9), 10**9), draw.randint(1, 10**5)) for _ in range(3000)]
    cases += [(285, 1000), (-285, 1000), (1, 8), (5, 0), (0, 7)]
    df = spark.createDataFrame(cases, "a bigint, b bigint")
    a, b = F.col("a"), F.col("b")
    for r in df.select(
        a, b, rounding.rate_pct(a, b).alias("rate"), rounding.mean_of_hundredths(a, b).alias("mean")
    ).collect():
        if r.b == 0:
            assert r.rate is None and r.mean is None
        else:
            assert r.rate == half_up(Decimal(r.a) * 100 / Decimal(r.b))
            assert r.mean == half_up(Decimal(r.a) / 100 / Decimal(r.b))


def test_years(spark):
    df = spark.range(-800, 40000).select(
        F.col("id"), rounding.from_hundredths(rounding.years_in_hundredths(F.col("id"))).alias("years")
    )
    for r in df.collect():
        assert r.years == half_up(Decimal(r.id) / Decimal("365.25"))


SHIFTS = [
    # in, out, start, end, late, early, overtime, unscheduled
    ("09:16", "17:00", "09:00", "17:00", True, False, False, False),
    ("09:00", "17:16", "09:00", "17:00", False, False, True, False),
    ("09:00", "17:00", None, None, False, False, False, True),
    ("09:00", "16:54", "09:00", "17:00", False, True, False, False),
    ("09:05", "16:55", "09:00", "17:00", False, False, False, False),
    ("09:00", "17:05", "09:00", "17:00", False, False, False, False),
    ("09:30", "18:00", "09:00", None, False, False, False, True),
    ("09:30", "18:00", None, "17:00", False, False, False, True),
    (None, None, "09:00", "17:00", False, False, False, False),
    ("09:30", "16:00", "09:00", "17:00", True, True, False, False),
]


def _flags(spark, grace=5):
    clock = [[t and moment(f"2025-05-28 {t}") for t in shift[:4]] for shift in SHIFTS]
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(clock)],
        "n int, i timestamp_ntz, o timestamp_ntz, s timestamp_ntz, e timestamp_ntz",
    )
    flags = attendance_flags(F.col("i"), F.col("o"), F.col("s"), F.col("e"), grace)
    return df.orderBy("n").select(*(f.alias(n) for n, f in flags.items())).collect()


def test_attendance_flags(spark):
    assert [tuple(r) for r in _flags(spark)] == [shift[4:] for shift in SHIFTS]


def test_grace_is_a_parameter(spark):
    assert _flags(spark, grace=4)[4].is_late_arrival
    assert not _flags(spark, grace=16)[0].is_late_arrival
