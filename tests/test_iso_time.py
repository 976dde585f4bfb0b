"""Times against the standard library's reading of ISO-8601."""

from __future__ import annotations

from datetime import UTC, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paystream.functions.iso_time import format_boundary, has_zone, parse_iso8601

TEXTS = [
    "2026-01-01T12:00:00.000Z", "2026-01-01T12:00:00Z", "2026-01-01 12:00:00+00:00",
    "2026-01-01T12:00Z", "2026-01-01T12Z", "2026-01-01T12:00:00,5Z", "2026-01-01",
    "2026-01-01T12:00:00", "20260101T120000Z", "20260101T1200+0530", "2026-W01-1T00:00:00Z",
    "2026W011T00Z", "2026-W53-7", "2020-W53-7T01:00:00Z", "2026-W00-1", "2026-W01-8",
    "2026-01-01T12:00:00.1234567Z", "2026-01-01T12:00:00.123456789+01:00",
    "2026-01-01T12:00:00+23:59", "2026-01-01T12:00:00-18:30", "2026-01-01T12:00:00+24:00",
    "2026-01-01T12:00:00+05:30:15", "2026-01-01T12:00:00+05", "2026-02-30T12:00:00Z",
    "2026-13-01T12:00:00Z", "2026-01-01T25:00:00Z", "2026-01-01T12:60:00Z",
    "2026-01-01T12:00:60Z", "2024-02-29T12:00:00Z", "2023-02-29T12:00:00Z", "", "x", "2026",
    "12:00:00Z", "2026-01-01T12:00:00Europe/Paris", "now", "T12:00Z",
    "2026-01-01x12:00:00Z", "2026-1-1T12:00:00Z", " 2026-01-01T12:00:00Z", "0001-01-01T00:00:00Z",
    "2026-01-01T12:00:00Z ", "2026-01-01T", "2026-01-01T12:",
    "1969-12-31T23:59:59.999999Z", "2026-01-01T12:00:00z", "9999-12-31T23:59:59Z",
    "0000-01-01T00:00:00Z", "2026-01-01T12:0000Z", "2026-0101T12:00:00Z",
]


def _expected(text: str) -> tuple[int | None, bool]:
    try:
        moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None, False
    zoned = moment.tzinfo is not None
    delta = (moment if zoned else moment.replace(tzinfo=UTC)) - datetime(1970, 1, 1, tzinfo=UTC)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds, zoned


def _actual(spark, texts):
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n INT, t STRING")
    rows = frame.select(
        "n", F.expr(f"unix_micros({parse_iso8601('t')}) AS us"), F.expr(f"{has_zone('t')} AS z")
    ).orderBy("n").collect()
    return [(r.us, r.z and r.us is not None) for r in rows]


def test_listed_texts(spark):
    actual = _actual(spark, TEXTS)
    wrong = {
        t: (a, _expected(t)) for t, a in zip(TEXTS, actual, strict=True) if a != _expected(t)
    }
    assert wrong == {}


_part = st.sampled_from
_date = st.one_of(
    st.dates().map(lambda d: d.isoformat()),
    st.dates().map(lambda d: d.isoformat().replace("-", "")),
    st.dates().map(lambda d: "{:04d}-W{:02d}-{}".format(*d.isocalendar())),
)
_clock = st.tuples(
    st.times(), _part(["%H", "%H:%M", "%H:%M:%S", "%H:%M:%S.%f", "%H%M", "%H%M%S", "%H:%M:%S,%f"])
).map(lambda p: p[0].strftime(p[1]))
_zone = _part(["", "Z", "+00:00", "-03:00", "+0530", "+14", "-23:59", "+01:02:03"])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_date, _part("T T T _t"), _clock, _zone).map("".join), min_size=40))
def test_any_text(spark, texts):
    assert _actual(spark, texts) == [_expected(t) for t in texts]


def test_stray_characters_before_the_zone_are_refused(spark):
    """The standard library lets these two pass."""
    texts = ["2026-01-01T12:00:00 Z", "2026-01-01T12:00:00.Z"]
    assert _actual(spark, texts) == [(None, False)] * 2


def test_boundary_format(spark):
    texts = [("2026-01-01 12:00:45.500999",), ("2026-01-01 12:00:00",)]
    rows = spark.createDataFrame(texts, "t STRING").select(
        F.expr(format_boundary("cast(t AS TIMESTAMP)"))
    ).collect()
    assert [r[0] for r in rows] == ["2026-01-01T12:00:45.500Z", "2026-01-01T12:00:00.000Z"]
