"""Repair of JSON as models write it: fenced, with commas too many, or cut off."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FENCE = re.compile(r"^\s*```\w*\s*|\s*```\s*$")


def repaired(text: str | None) -> str | None:
    """The text if it is JSON, else the text without fences and what stands before the first bracket, without commas before a closing
    bracket, and with what was cut off closed; null if that is no JSON either. One pass over the text, whatever its length."""
    if text is None:
        return None
    try:
        json.loads(text)
        return text
    except (ValueError, RecursionError):
        pass
    plain = _FENCE.sub("", text)
    begin = min((i for i in (plain.find("{"), plain.find("[")) if i >= 0), default=-1)
    if begin < 0:
        return None
    out: list[str] = []
    closers: list[str] = []
    quoted = escaped = False
    for c in plain[begin:]:
        if quoted:
            out.append(c)
            quoted, escaped = escaped or c != '"', c == "\\" and not escaped
            continue
        if c == '"':
            quoted = True
        elif c in "{[":
            closers.append("}" if c == "{" else "]")
        elif c in "}]":
            if not closers or closers.pop() != c:
                return None
            _drop_comma(out)
        out.append(c)
        if c in "}]" and not closers:
            break
    if quoted:
        out.append('"')
    if closers:
        _drop_comma(out)
        if out and "".join(out[-1:]) == ":":
            out.append("null")
    done = "".join(out) + "".join(reversed(closers))
    for end in (done, re.sub(r'([{,])\s*"[^"]*"\s*([}\]]+)$', r"\1\2", done)):  # a name that has lost its value
        try:
            json.loads(fixed := re.sub(r",(\s*[}\]]+)$", r"\1", end))
            return fixed
        except (ValueError, RecursionError):
            continue
    return None


def _drop_comma(out: list[str]) -> None:
    i = len(out) - 1
    while i >= 0 and out[i].isspace():
        i -= 1
    if i >= 0 and out[i] == ",":
        del out[i]


def _repair(texts: pd.Series) -> pd.Series:
    return texts.map(repaired, na_action="ignore")


def repair(text: Column) -> Column:
    """Only texts that are no JSON go through Python."""
    return F.when(F.try_parse_json(text).isNotNull(), text).otherwise(F.pandas_udf(_repair, T.StringType())(text))
