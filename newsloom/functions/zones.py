"""Versioned zone transition tables: for each zone the instants at which its offset from UTC changes, as plain arrays.

The tables are built once on the driver, so that every task converts by the same version whatever its machine has installed.
"""

from __future__ import annotations

import functools
import os
import zoneinfo
from datetime import UTC, datetime

import numpy as np

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
#: The tables hold for instants between these years; before, the first offset goes on. After, a zone goes by its rule: as in the
#: year of the last CYCLE years of the table that begins on the same weekday and is as long. Zones without such a rule (those
#: that follow the moon) have no known offset then.
FROM_YEAR, TO_YEAR, CYCLE = 1970, 2055, 28
#: Offsets are probed this many days apart and changes are then found to the second; no zone changes twice within it and back.
PROBE_DAYS = 20

ZoneTable = tuple[np.ndarray, np.ndarray, bool]


def version() -> str:
    """The version of the installed zone data."""
    for d in zoneinfo.TZPATH:
        p = os.path.join(d, "tzdata.zi")
        if os.path.exists(p):
            with open(p) as f:
                return f.readline().removeprefix("# version").strip()
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "unknown"


def _offset(zone: zoneinfo.ZoneInfo, at: int) -> int:
    return int(datetime.fromtimestamp(at, zone).utcoffset().total_seconds())


def table_of(name: str) -> ZoneTable:
    """(starts, offsets, ruled): offsets[i] seconds hold from starts[i] on, in seconds since 1970 UTC; starts[0] is far in the past.
    ruled tells whether the zone keeps to one rule from then on."""
    zone = zoneinfo.ZoneInfo(name)
    begin, end = (int((datetime(y, 1, 1, tzinfo=UTC) - EPOCH).total_seconds()) for y in (FROM_YEAR, TO_YEAR))
    starts, offsets = [-(2**62)], [_offset(zone, begin)]
    at = begin
    while at < end:
        nxt = at + PROBE_DAYS * 86400
        now = _offset(zone, nxt)
        while now != offsets[-1]:
            low, high, was = at, nxt, offsets[-1]
            while high - low > 1:
                mid = (low + high) // 2
                if _offset(zone, mid) == was:
                    low = mid
                else:
                    high = mid
            starts.append(high)
            offsets.append(_offset(zone, high))
            at = high
        at = nxt
    later = np.arange(end, end + CYCLE * 366 * 86400, PROBE_DAYS * 5 * 86400, dtype=np.int64)
    ruled = all(_offset(zone, int(x)) == _offset(zone, int(x - s)) for x, s in zip(later, _shifts(later), strict=True))
    return np.array(starts, dtype=np.int64), np.array(offsets, dtype=np.int64), ruled


@functools.cache
def tables() -> tuple[str, dict[str, ZoneTable]]:
    """The version and the table of every zone, by lower-case name."""
    made: dict[str, ZoneTable] = {}
    by_file: dict[bytes | str, ZoneTable] = {}  # many names share one file's content
    for name in sorted(zoneinfo.available_timezones()):
        if not name.startswith(("posix/", "right/", "Factory")):
            file = next((f for d in zoneinfo.TZPATH if os.path.isfile(f := os.path.join(d, name))), None)
            same = open(file, "rb").read() if file else name
            try:
                if same not in by_file:
                    by_file[same] = table_of(name)
            except Exception:  # a file that can't be read is a zone that we don't know
                continue
            made[name.lower()] = by_file[same]
    return version(), made


def _january(year: np.ndarray) -> np.ndarray:
    """Seconds of the year's beginning."""
    return (year - 1970).astype("datetime64[Y]").astype("datetime64[s]").astype(np.int64)


def _leap(year: np.ndarray) -> np.ndarray:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def _shifts(seconds: np.ndarray) -> np.ndarray:
    """For times after the tables: how far back the like year begins; 0 for all others."""
    last = np.arange(TO_YEAR - CYCLE, TO_YEAR)  # without a century in it, so every kind of year is there
    kind = lambda y: (_january(y) // 86400 + 3) % 7 * 2 + _leap(y)
    like = np.zeros(14, dtype=np.int64)
    like[kind(last)] = last
    year = seconds.astype("datetime64[s]").astype("datetime64[Y]").astype(np.int64) + 1970
    return np.where(year >= TO_YEAR, _january(year) - _january(like[kind(year)]), 0)


def offset_at(table: ZoneTable, utc: np.ndarray) -> np.ndarray:
    return table[1][np.searchsorted(table[0], utc, side="right") - 1]


def wall_to_utc(table: ZoneTable, wall: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTC seconds of wall seconds, and whether the zone's clocks show that wall time exactly once, as far as its rule is known."""
    shift = _shifts(wall)
    known = (shift == 0) | table[2]
    wall = wall - shift
    before, after = wall - offset_at(table, wall - 86400), wall - offset_at(table, wall + 86400)
    a, b = wall - offset_at(table, before) == before, wall - offset_at(table, after) == after
    same = before == after
    return np.where(a, before, after) + shift, np.where(same, a, a ^ b) & known
