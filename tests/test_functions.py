from __future__ import annotations

import pytest
from helpers import scalar, ts, utc
from pyspark.sql import functions as F

from tickstream.constants import WHITESPACE
from tickstream.functions import stats, text, times, vectors


@pytest.mark.parametrize("value, expected", [
    ("2026-04-24T03:45:55Z", "2026-04-24 03:45:55.000000"),
    ("2026-04-24T09:30:00-04:00", "2026-04-24 13:30:00.000000"),
    ("2026-04-24T03:45:55.123456+00:00", "2026-04-24 03:45:55.123456"),
    ("garbage", None),
    ("2026-13-45T03:45:55Z", None),
    ("2026", None),
    (None, None),
])
def test_iso_instant(spark, value, expected):
    assert utc(scalar(spark, times.iso_instant(F.lit(value).cast("string")))) == expected


@pytest.mark.parametrize("value, expected", [
    ("2026-04-24 03:00:00", "2026-04-24 03:00:00.000000"),
    ("2026-04-24T03:00:00+02:00", "2026-04-24 01:00:00.000000"),
    ("soon", None),
])
def test_lenient_timestamp(spark, value, expected):
    assert utc(scalar(spark, times.lenient_timestamp(F.lit(value)))) == expected


def test_iso_string(spark):
    at = F.lit(ts("2026-04-24T03:45:55.120000"))
    assert scalar(spark, times.iso_string(at)) == "2026-04-24T03:45:55+00:00"
    assert scalar(spark, times.iso_string(at, micros=True)) == "2026-04-24T03:45:55.120000+00:00"


def test_lookback_is_date_granular(spark):
    start = times.lookback_start(F.lit(ts("2026-04-24T03:45:55")), 24)
    assert utc(scalar(spark, start)) == "2026-04-23 00:00:00.000000"


@pytest.mark.parametrize("mean, sd, expected", [
    (2.0, 4.0, 2.0), (2.0, 0.0, 0.0), (2.0, None, 0.0),
])
def test_zscore(spark, mean, sd, expected):
    z = stats.zscore(F.lit(10.0), F.lit(mean), F.lit(sd).cast("double"))
    assert scalar(spark, z) == expected


@pytest.mark.parametrize("scores, expected", [
    ((2.0, 0.0), False), ((2.0001, 0.0), True), ((0.0, -2.1), True), ((None, None), False),
])
def test_exceeds(spark, scores, expected):
    got = stats.exceeds(2.0, *[F.lit(s).cast("double") for s in scores])
    assert scalar(spark, got) is expected


def test_percent_change(spark):
    assert scalar(spark, stats.percent_change(F.lit(11.0), F.lit(10.0))) == pytest.approx(10.0)
    assert scalar(spark, stats.percent_change(F.lit(11.0), F.lit(0.0))) is None


def test_strip_all_removes_what_python_strips(spark):
    padded = WHITESPACE + "a b" + WHITESPACE
    assert scalar(spark, text.strip_all(F.lit(padded))) == padded.strip()


@pytest.mark.parametrize("title, description, content, expected", [
    ("T", "D", "body [+120 chars]", "Title: T | Description: D | Content: body"),
    ("T", None, "[+120 chars]", "Title: T"),
    ("T", "", "\t [+9 chars]", "Title: T"),
    (None, "", None, ""),
    ("T", "D", "a [+1 b [+2 chars]", "Title: T | Description: D | Content: a"),
])
def test_compose_text(spark, title, description, content, expected):
    parts = [F.lit(v).cast("string") for v in (title, description, content)]
    assert scalar(spark, text.compose_text(*parts)) == expected


@pytest.mark.parametrize("body, phrase, expected", [
    ("Microsoft's new AI chip", "Microsoft AI", True),
    ("Microsoft said so", "Microsoft AI", False),
    ("the stock-market today", "stock market", True),
    ("U.S. stocks fall", "U.S. stocks", True),
])
def test_has_all_words(spark, body, phrase, expected):
    assert scalar(spark, text.has_all_words(text.words(F.lit(body)), phrase)) is expected


def test_citation(spark):
    cite = text.citation(F.lit(1), F.lit("T"), F.lit(None).cast("string"), F.lit("2026"),
                         F.lit(0.98765), F.lit("x" * 300))
    assert scalar(spark, cite) == (
        "[1] T\n    Source: Unknown | Published: 2026 | Relevance: 0.988\n    "
        + "x" * 200 + "..."
    )


@pytest.mark.parametrize("change, pct, expected", [
    (1.5, 2.0, "+1.50 (+2.00%)"), (-1.5, -2.0, "-1.50 (-2.00%)"), (0.0, 0.0, "+0.00 (+0.00%)"),
    (None, None, ""), (1.5, None, "+1.50"),
])
def test_signed_change(spark, change, pct, expected):
    got = text.signed_change(F.lit(change).cast("double"), F.lit(pct).cast("double"))
    assert scalar(spark, got) == expected


def test_money_and_ticker(spark):
    assert scalar(spark, text.money(F.lit(1234.5))) == "USD 1234.50"
    assert scalar(spark, text.normal_ticker(F.lit(" nvda\n"))) == "NVDA"


def test_vector_expressions(spark):
    a = F.array(F.lit(3.0).cast("float"), F.lit(4.0).cast("float"))
    zero = F.array(F.lit(0.0).cast("float"), F.lit(0.0).cast("float"))
    assert scalar(spark, vectors.dot(a, a)) == 25.0
    assert scalar(spark, vectors.l2_normalise(a)) == pytest.approx([0.6, 0.8])
    assert scalar(spark, vectors.l2_normalise(zero)) == [0.0, 0.0]
