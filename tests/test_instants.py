"""Timestamps: forms, zones, impossible and ambiguous times, against the standard library."""

from datetime import UTC, datetime
from zoneinfo import ZoneInfo

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.functions import instants, zones
from newsloom.plans.mail_queries import message_instants

_, TABLES = zones.tables()


def parse(*texts):
    return [None if pd.isna(x) else int(x) for x in instants.parse_texts(pd.Series(texts, dtype=object), TABLES)]


def us(*args, tz=UTC):
    return int(datetime(*args, tzinfo=tz).timestamp() * 1_000_000)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Wed, 08 Jan 2025 03:47:03 -0800", us(2025, 1, 8, 11, 47, 3)), ("  Wed,  08  Jan 2025 03:47:03 -0800 (PST)\t", us(2025, 1, 8, 11, 47, 3)), ("WED, 08 JAN 2025 03:47:03 EST", us(2025, 1, 8, 8, 47, 3)),
        ("Thu, 09 Jan 2025 03:47:03 -0800", us(2025, 1, 9, 11, 47, 3)), ("Mon, 08 Jan 2025 03:47:03 -0800", us(2025, 1, 8, 11, 47, 3)), ("Mon, 08 Jan 2025 03:47:03 EST", None),
        ("22 Jan 25 18:02:07 +0900", us(2025, 1, 22, 9, 2, 7)), ("2025-01-09T08:46:09Z", us(2025, 1, 9, 8, 46, 9)), ("20250115T195155Z", us(2025, 1, 15, 19, 51, 55)), ("2025-01-11T11:42:50.967", us(2025, 1, 11, 16, 42, 50, 967000)),
        ("2025-09-17T10:59:59+02:00[America/Denver]", us(2025, 9, 17, 8, 59, 59)), ("2025-01-14 21:30:02 Europe/Berlin", us(2025, 1, 14, 20, 30, 2)), ("1/11/2025 5:51:06 AM", us(2025, 1, 11, 10, 51, 6)), ("1/19/2026 12:10:25 PM", us(2026, 1, 19, 17, 10, 25)),
        ("04/26/2025 04:23 PM EDT", us(2025, 4, 26, 20, 23)), ("31.03.2025 02:28:15 CEST", us(2025, 3, 31, 0, 28, 15)), ("January 25, 2025 at 8:05 PM ET", us(2025, 1, 26, 1, 5)), ("April 30, 2025 at 5:57 AM PT", us(2025, 4, 30, 12, 57)),
        ("23. April 2025, 09:23:51 -0400", us(2025, 4, 23, 13, 23, 51)), ("10 août 2025 12:15:01 -0300", us(2025, 8, 10, 15, 15, 1)), ("25 de septiembre de 2025 18:52:09 -0700", us(2025, 9, 26, 1, 52, 9)), ("14. März 2025, 06:12:46 +0545", us(2025, 3, 14, 0, 27, 46)),
        ("1736725001", 1736725001_000000), ("1736462293164", 1736462293164000), ("1736253700669598", 1736253700669598), ("2025-01-05", us(2025, 1, 5, 5)), ("Sat, 11 Jan 2025 17:47:25 UT", us(2025, 1, 11, 17, 47, 25)),
        ("2025-03-09 02:14:43", None), ("2025-11-02T01:40:21.417", None), ("2025-11-02T01:40:21 EST", us(2025, 11, 2, 6, 40, 21)), ("2025-10-26 02:38:07 Europe/Berlin", None), ("2026-13-05T10:00:00Z", None), ("Mon, 31 Feb 2026 10:00:00 +0000", None),
        ("Thu, 12 Mar 2026 27:71:00 +0000", None), ("yesterday", None), ("", None), (None, None), ("n/a", None), ("2025-01-14 21:30:02 Mars/Base", None), ("9" * 40, None), ("x" * 100_000, None), ("13/11/2025 5:51:06 AM", None), ("1/11/2025 13:51:06 AM", None),
    ],
)
def test_forms(text, expected):
    assert parse(text) == [expected]


@settings(max_examples=300, deadline=None)
@given(st.datetimes(datetime(1975, 1, 1), datetime(2040, 1, 1)), st.sampled_from(["America/New_York", "Europe/Berlin", "Australia/Lord_Howe", "Asia/Kathmandu", "America/Sao_Paulo"]))
def test_wall_times_as_the_library_has_them(wall, zone):
    wall = wall.replace(microsecond=0)
    z = ZoneInfo(zone)
    found = {int((wall.replace(tzinfo=z, fold=f)).timestamp()) for f in (0, 1)}
    exact = [u for u in found if datetime.fromtimestamp(u, z).replace(tzinfo=None) == wall]
    expected = exact[0] * 1_000_000 if len(exact) == 1 else None
    assert parse(f"{wall:%Y-%m-%d %H:%M:%S} {zone}") == [expected]


def test_one_instant_per_message(spark):
    rows = spark.createDataFrame(
        [(" AB", "2025-01-09T08:46:09Z", 1), ("ab", "1736412369", 2), ("cd", "unknown", 3), ("ef", "2025-01-09T08:46:09Z", 4), ("ef", "2025-01-09T08:46:10Z", 5), ("gh", None, 6), ("gh", "1736412369", 7), (None, "1736412369", 8)], "msg_id string, date_h string, us int"
    )
    found = {r.msg_id: r.utc_us for r in message_instants(spark, rows).collect()}
    assert found == {"ab": 1736412369_000000, "gh": 1736412369_000000}
    assert message_instants(spark, rows.limit(0)).count() == 0


def test_zone_tables_are_versioned():
    assert zones.version() != "unknown" and len(TABLES["america/new_york"][0]) > 100


def test_weekdays_of_four_languages_and_unknown_ones():
    at = us(2025, 1, 6, 9)
    assert parse("Montag, 6. Januar 2025, 10:00:00 +0100", "lundi, 6 janvier 2025 10:00 +0100", "lunes, 6 de enero de 2025 10:00 +0100", "Ponedeljek, 6 Jan 2025 10:00 +0100") == [at] * 4
    assert parse("Montag, 6. Januar 2025, 09:00 UTC", "lundi, 6 janvier 2025 09:00 UTC", "lunes, 6 de enero de 2025 09:00 UTC") == [at] * 3
    assert parse("Dienstag, 6. Januar 2025, 09:00 UTC", "Ponedeljek, 6 Jan 2025 09:00 UTC") == [None, None]


@settings(max_examples=300, deadline=None)
@given(st.datetimes(datetime(2045, 1, 1), datetime(2600, 1, 1)), st.sampled_from(["America/New_York", "Europe/Berlin", "Australia/Lord_Howe", "Asia/Kathmandu", "America/Santiago", "Africa/Cairo"]))
def test_wall_times_after_the_tables(wall, zone):
    wall = wall.replace(microsecond=0)
    z = ZoneInfo(zone)
    found = {int((wall.replace(tzinfo=z, fold=f)).timestamp()) for f in (0, 1)}
    exact = [u for u in found if datetime.fromtimestamp(u, z).replace(tzinfo=None) == wall]
    assert parse(f"{wall:%Y-%m-%d %H:%M:%S} {zone}") == [exact[0] * 1_000_000 if len(exact) == 1 else None]


def test_zones_without_a_rule_have_no_later_instants():
    assert not TABLES["africa/casablanca"][2] and TABLES["europe/berlin"][2] and TABLES["asia/tokyo"][2]
    assert parse("2070-07-06 12:00 Africa/Casablanca", "2030-07-06 12:00 Africa/Casablanca")[0] is None
    assert parse("2060-07-06 12:00 Europe/Berlin") == [us(2060, 7, 6, 10)]


def test_long_texts_and_comments():
    at = us(2025, 1, 8, 11, 47, 3)
    long = "Wed, 08 Jan 2025 03:47:03 -0800"
    assert parse(f"{long} (a comment, of sixty characters or so; it says nothing at all)", f"{long} (x) (y.z: 9)", f"{long}{' ' * 900}({'very ' * 500}long)", f"{' ' * 5000}{long}") == [at] * 4
    assert parse("Wed, 08 Jan 2025 03:47:03 (see below, please)", "Wed, 08 Jan 2025 03:47:03 EST (see below, please)") == [None, us(2025, 1, 8, 8, 47, 3)]
    assert parse("1/11/2025 5:51:06 aM", "am " * 50_000) == [us(2025, 1, 11, 10, 51, 6), None]
