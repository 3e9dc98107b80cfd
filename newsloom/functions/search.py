"""Predicate strings of mail searches as columns, options of a command line, templates."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_TERM = re.compile(r'(-?)(?:(\w+):)?(?:"([^"]*)"|(\S+))')
_SPAN = {"h": "hours", "d": "days", "m": "months", "y": "years"}


def predicate(query: str, now: Column, ts: str = "ts", texts: tuple[str, ...] = ("subject", "snippet"), fields: dict[str, str] | None = None, labels: str | None = "label_ids") -> Column:
    """A search as a condition that is pushed to the scan as far as Spark can: all terms must hold, `-` turns one round.

    `newer_than:20d`, `older_than:2m` (h, d, m, y), `after:2025/01/31`, `before:`, `label:x`, `from:x` and other fields (the text is
    part of the column, in any case), plain words and "phrases" in one of the texts. `in:anywhere` holds for every message. A
    null column satisfies no term, nor its opposite unless the term is about texts. Unknown fields are an error.
    """
    columns = {"from": "from_h", "to": "to_h", "subject": "subject", **(fields or {})}
    parts = []
    for minus, field, phrase, word in _TERM.findall(query):
        value = phrase or word
        holds = lambda c, v=value: F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(v.lower()))
        if field == "in":
            if value != "anywhere":
                raise ValueError(f"in:{value}")
            continue
        if field in ("newer_than", "older_than"):
            m = re.fullmatch(r"(\d+)([hdmy])", value)
            if not m:
                raise ValueError(f"{field}:{value}")
            edge = now - F.make_interval(**{_SPAN[m[2]]: F.lit(int(m[1]))}) if m[2] != "h" else now - F.make_interval(hours=F.lit(int(m[1])))
            part = F.col(ts) > edge if field == "newer_than" else F.col(ts) < edge
        elif field in ("after", "before"):
            edge = F.to_timestamp(F.lit(value.replace("-", "/")), "yyyy/MM/dd")
            part = F.col(ts) >= edge if field == "after" else F.col(ts) < edge
        elif field == "label" and labels:
            part = F.coalesce(F.array_contains(labels, value), F.lit(False))
        elif field in columns:
            part = holds(columns[field])
        elif field:
            raise ValueError(f"unknown field {field}")
        else:
            part = reduce(lambda a, b: a | b, map(holds, texts))
        parts.append(~part if minus else part)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def options(arguments: Column) -> Column:
    """`--k=v` arguments as a map: a value may hold `=`, a missing one is `true`, of a repeated key the last counts, other
    arguments are left out."""
    named = F.filter(arguments, lambda a: a.rlike("^--[^=]+"))
    pairs = F.transform(named, lambda a: F.struct(F.regexp_extract(a, "^--([^=]+)", 1).alias("key"), F.when(F.contains(a, F.lit("=")), F.regexp_extract(a, "^--[^=]+=([\\s\\S]*)$", 1)).otherwise("true").alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def filled(template: Column, values: dict[str, Column]) -> Column:
    """A template with `{{name}}` replaced; a null value leaves nothing, names without a value stay."""
    for name, value in values.items():
        template = F.replace(template, F.lit(f"{{{{{name}}}}}"), F.coalesce(value.cast("string"), F.lit("")))
    return template
