"""Timestamps of many forms, precisions and zones, normalised to microseconds since 1970 UTC.

A text is reduced to its shape mask (digits to 9, letters to a, AM and PM to pp, runs of blanks to one blank). Each distinct mask is mapped
to a parser once; a mask fixes the place of every field, so all texts of a mask are converted together as arrays, wall
times through the zone transition tables of newsloom.functions.zones.

Defined results: null for texts that are null, empty or of an unknown shape, for impossible dates and times, for wall times
that the zone's clocks show twice or never, for unknown zones, and for a weekday that contradicts the date where
no offset is stated. What a text leaves out is zero; beyond microseconds digits are cut off.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import zones

#: Wall times without any zone belong here.
DEFAULT_ZONE = "America/New_York"
#: The parsers of shorter masks are kept; longer ones, which hardly recur, are found anew.
KEPT_CHARS = 200

# Month and weekday names in English, German, French and Spanish (the first three letters or more, lower case).
MONTHS = {
    "jan": 1, "january": 1, "januar": 1, "jänner": 1, "janvier": 1, "janv": 1, "enero": 1, "ene": 1,
    "feb": 2, "february": 2, "februar": 2, "février": 2, "fevrier": 2, "févr": 2, "febrero": 2,
    "mar": 3, "march": 3, "märz": 3, "maerz": 3, "mars": 3, "marzo": 3, "mär": 3,
    "apr": 4, "april": 4, "avril": 4, "avr": 4, "abril": 4, "abr": 4,
    "may": 5, "mai": 5, "mayo": 5,
    "jun": 6, "june": 6, "juni": 6, "juin": 6, "junio": 6,
    "jul": 7, "july": 7, "juli": 7, "juillet": 7, "juil": 7, "julio": 7,
    "aug": 8, "august": 8, "août": 8, "aout": 8, "agosto": 8, "ago": 8,
    "sep": 9, "sept": 9, "september": 9, "septembre": 9, "septiembre": 9, "setiembre": 9,
    "oct": 10, "okt": 10, "october": 10, "oktober": 10, "octobre": 10, "octubre": 10,
    "nov": 11, "november": 11, "novembre": 11, "noviembre": 11,
    "dec": 12, "dez": 12, "déc": 12, "dic": 12, "december": 12, "dezember": 12, "décembre": 12, "decembre": 12, "diciembre": 12,
}
WEEKDAYS = {
    "mon": 0, "monday": 0, "tue": 1, "tues": 1, "tuesday": 1, "wed": 2, "wednesday": 2, "thu": 3, "thur": 3, "thurs": 3, "thursday": 3,
    "fri": 4, "friday": 4, "sat": 5, "saturday": 5, "sun": 6, "sunday": 6,
    "mo": 0, "montag": 0, "di": 1, "dienstag": 1, "mi": 2, "mittwoch": 2, "do": 3, "donnerstag": 3, "fr": 4, "freitag": 4, "sa": 5, "samstag": 5, "sonnabend": 5, "so": 6, "sonntag": 6,
    "lun": 0, "lundi": 0, "mar": 1, "mardi": 1, "mer": 2, "mercredi": 2, "jeu": 3, "jeudi": 3, "ven": 4, "vendredi": 4, "sam": 5, "samedi": 5, "dim": 6, "dimanche": 6,
    "lunes": 0, "martes": 1, "mié": 2, "mie": 2, "miércoles": 2, "miercoles": 2, "jue": 3, "jueves": 3, "vie": 4, "viernes": 4, "sáb": 5, "sab": 5, "sábado": 5, "sabado": 5, "dom": 6, "domingo": 6,
}
# Zone abbreviations as hours from UTC, and abbreviations that name a zone.
FIXED_HOURS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 1, "cet": 1, "cest": 2, "met": 1, "mest": 2, "eet": 2, "eest": 3, "msk": 3,
    "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7, "akst": -9, "akdt": -8, "hst": -10,
    "jst": 9, "kst": 9, "aest": 10, "aedt": 11, "awst": 8, "nzst": 12, "nzdt": 13,
}
NAMED_ZONES = {"et": "america/new_york", "pt": "america/los_angeles", "ct": "america/chicago", "mt": "america/denver"}

CLOCK = r"(?P<H>9{1,2}):(?P<M>99)(?::(?P<S>99)(?P<f>[.,]9{1,9})?)?"
OFFSET = r"(?P<off>[+-]99(?::?99)?)"
ZONE = r"(?P<zone>a+(?:[/_+-][a9_]+)*)"
TAIL = rf"(?: ?{OFFSET})?(?: ?{ZONE})?(?: ?[(\[](?P<note>a[a9/_ +-]*)[)\]])?(?P<comment>(?: ?\([^()]*\))*)"
#: Masks of the accepted forms. m or mon is the month, ap the half of the day, w1 and w2 are words whose value is fixed.
FORMS = [
    re.compile(p + r"\Z")
    for p in (
        rf"(?:(?P<wd>a+)\.?,? )?(?P<d>9{{1,2}})\.? (?:(?P<w1>aa) )?(?P<mon>a{{3,12}})\.? (?:(?P<w2>aa) )?(?P<y>9999|99),?(?: (?:(?P<at>aa?) )?{CLOCK}(?: ?(?P<ap>pp))?{TAIL})?",
        rf"(?:(?P<wd>a+)\.?,? )?(?P<mon>a{{3,12}})\.? (?P<d>9{{1,2}}),? (?P<y>9999),?(?: (?:(?P<at>aa) )?{CLOCK}(?: ?(?P<ap>pp))?{TAIL})?",
        rf"(?P<y>9999)-(?P<m>99)-(?P<d>99)(?:(?:(?P<t>a)| ){CLOCK}{TAIL})?",
        rf"(?P<y>9999)(?P<m>99)(?P<d>99)(?P<t>a)(?P<H>99)(?P<M>99)(?:(?P<S>99)(?P<f>[.,]9{{1,9}})?)?{TAIL}",
        rf"(?P<m>9{{1,2}})/(?P<d>9{{1,2}})/(?P<y>9999|99),?(?: {CLOCK}(?: ?(?P<ap>pp))?{TAIL})?",
        rf"(?P<d>9{{1,2}})\.(?P<m>9{{1,2}})\.(?P<y>9999|99),?(?: {CLOCK}(?: ?(?P<ap>pp))?{TAIL})?",
    )
]
#: Bare digits count from 1970 UTC; their number tells the unit.
UNITS = [(11, 1_000_000, 1), (14, 1_000, 1), (17, 1, 1), (19, 1, 1_000)]
#: Words that may stand at the places w1, w2, at and t.
FILLERS = {"w1": {"de"}, "w2": {"de"}, "at": {"at", "um", "à", "a"}, "t": {"t"}}


_MARK = "\ue000"  # in place of each letter of AM and PM


class _Classes(dict):
    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = "p" if c == _MARK else "a" if c.isalpha() else "?" if c.isdigit() or c in "9a" else c
        return out


CLASSES = _Classes({ord(c): "9" for c in "0123456789"})


HALF = re.compile(r"\b[ap]m\b", re.IGNORECASE)


def mask_of(text: str) -> str:
    """The shape of a text; the halves of the day keep a class of their own, pp."""
    return HALF.sub(_MARK * 2, text).translate(CLASSES)


def spans_of(mask: str) -> dict[str, tuple[int, int]] | None:
    return _kept_spans(mask) if len(mask) <= KEPT_CHARS else _find_spans(mask)


def _find_spans(mask: str) -> dict[str, tuple[int, int]] | None:
    """The place of each field in texts of this mask, or None if the mask is of no known form."""
    if mask and not mask.strip("9"):
        return {"digits": (0, len(mask))} if len(mask) <= 19 else None
    for form in FORMS:
        if m := form.match(mask):
            return {k: m.span(k) for k in form.groupindex if m.start(k) >= 0}
    return None


_kept_spans = lru_cache(maxsize=4096)(_find_spans)


def _numbers(chars: np.ndarray, span: tuple[int, int]) -> np.ndarray:
    out = np.zeros(len(chars), dtype=np.int64)
    for i in range(*span):
        out = out * 10 + (chars[:, i].astype(np.int64) - 48)
    return out


def _words(texts: np.ndarray, span: tuple[int, int], value: Callable[[str], object]) -> np.ndarray:
    found, back = np.unique([t[span[0] : span[1]].lower() for t in texts], return_inverse=True)
    return np.array([value(w) for w in found], dtype=object)[back]


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    first = (y - 1970).astype("datetime64[Y]").astype("datetime64[M]") + (m - 1).astype("timedelta64[M]")
    return first.astype("datetime64[D]").astype(np.int64) + d - 1


def _month_length(y: np.ndarray, m: np.ndarray) -> np.ndarray:
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    return np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[m] + ((m == 2) & leap)


def _zone_of(word: str, tables: dict[str, zones.ZoneTable]) -> object:
    """Seconds from UTC, or a zone's name, or None."""
    if word in FIXED_HOURS:
        return FIXED_HOURS[word] * 3600
    name = NAMED_ZONES.get(word, word)
    return name if name in tables else None


def convert(texts: np.ndarray, spans: dict[str, tuple[int, int]], tables: dict[str, zones.ZoneTable]) -> tuple[np.ndarray, np.ndarray]:
    """Microseconds since 1970 UTC of texts of one mask, and which of them denote exactly one instant."""
    n, size = len(texts), len(texts[0])
    chars = np.array(texts, dtype=f"U{size}").view(np.uint32).reshape(n, size)
    num = lambda k, default: _numbers(chars, spans[k]) if k in spans else np.full(n, default, dtype=np.int64)
    if "digits" in spans:
        _, times, over = next(u for u in UNITS if size <= u[0])
        value = _numbers(chars, spans["digits"])
        good = value <= 2**62
        return np.where(good, value, 0) // over * times, good
    good = np.ones(n, dtype=bool)
    if "comment" in spans and spans["comment"][0] < spans["comment"][1] and not ("off" in spans or "zone" in spans):
        return np.zeros(n, dtype=np.int64), ~good  # a comment that may name the zone
    for k, allowed in FILLERS.items():
        if k in spans:
            good &= _words(texts, spans[k], lambda w, a=allowed: w in a).astype(bool)
    y, d = num("y", 0), num("d", 0)
    if spans["y"][1] - spans["y"][0] == 2:
        y += np.where(y < 50, 2000, 1900)
    m = num("m", 0) if "m" in spans else _words(texts, spans["mon"], lambda w: MONTHS.get(w, 0)).astype(np.int64)
    hour, minute, second = num("H", 0), num("M", 0), num("S", 0)
    if "ap" in spans:
        half = _words(texts, spans["ap"], lambda w: {"am": 0, "pm": 12}.get(w, -1)).astype(np.int64)
        good &= (half >= 0) & (hour >= 1) & (hour <= 12)
        hour = hour % 12 + np.maximum(half, 0)
    good &= (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1) & (hour <= 23) & (minute <= 59) & (second <= 59)
    m = np.where((m >= 1) & (m <= 12), m, 1)
    y = np.maximum(y, 1)
    good &= d <= _month_length(y, m)
    days = _days(y, m, np.where(good, d, 1))
    wall = days * 86400 + hour * 3600 + minute * 60 + second
    micros = np.zeros(n, dtype=np.int64)
    if "f" in spans:
        a, b = spans["f"][0] + 1, min(spans["f"][1], spans["f"][0] + 7)
        micros = _numbers(chars, (a, b)) * 10 ** (6 - (b - a))
    if "wd" in spans:
        named = _words(texts, spans["wd"], lambda w: WEEKDAYS.get(w, -1)).astype(np.int64)
        if "off" not in spans:  # a stated offset prevails over any weekday, known or not
            good &= named == (days + 3) % 7
    if "off" in spans:
        a, b = spans["off"]
        sign = np.where(chars[:, a] == ord("-"), -1, 1)
        minutes = _numbers(chars, (b - 2, b)) if b - a > 3 else np.zeros(n, dtype=np.int64)
        hours = _numbers(chars, (a + 1, a + 3))
        good &= (hours <= 23) & (minutes <= 59)
        return (wall - sign * (hours * 3600 + minutes * 60)) * 1_000_000 + micros, good
    # without an offset: the zone that is named, else the note in brackets, else the default
    at = spans.get("zone") or spans.get("note")
    named_zones = _words(texts, at, lambda w: _zone_of(w, tables)) if at else np.full(n, DEFAULT_ZONE.lower(), dtype=object)
    utc = np.zeros(n, dtype=np.int64)
    for z in set(named_zones):
        own = np.array([x == z for x in named_zones])
        if z is None:
            good[own] = False
        elif isinstance(z, str):
            utc[own], once = zones.wall_to_utc(tables[z], wall[own])
            good[own] &= once
        else:
            utc[own] = wall[own] - z
    return utc * 1_000_000 + micros, good


def parse_texts(texts: pd.Series, tables: dict[str, zones.ZoneTable]) -> pd.Series:
    """Microseconds since 1970 UTC for each text; <NA> where it does not denote exactly one instant."""
    out = pd.Series(pd.NA, index=texts.index, dtype="Int64")
    known = texts.dropna()
    if known.empty:
        return out
    clean = known.map(lambda t: " ".join(t.split()))
    clean = clean[clean.str.len() > 0]
    for mask, own in clean.groupby(clean.map(mask_of), sort=False):
        if (spans := spans_of(mask)) is not None:
            value, good = convert(own.to_numpy(dtype=object), spans, tables)
            out[own.index[good]] = value[good]
    return out


def instant_us(spark: SparkSession, c: Column | str) -> Column:
    """Microseconds since 1970 UTC of a text column (BIGINT); see the module for its defined results."""
    shared = spark.sparkContext.broadcast(zones.tables())  # a few MB at most: the zones of the world

    @F.pandas_udf("long")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, tables = shared.value
        for texts in batches:
            yield parse_texts(texts, tables)

    return parse(c)
