"""Raw messages parsed in Arrow batches with the standard library: headers, encoded words, bodies of multipart mail."""

from __future__ import annotations

from email import message_from_bytes, policy
from email.header import decode_header, make_header

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADERS = ("Message-ID", "From", "To", "Delivered-To", "Subject", "Date")
PARSED = T.StructType([*(T.StructField(n, T.StringType()) for n in ("message_id", "from_h", "to_h", "delivered_to", "subject", "date_h", "body", "html_body")), T.StructField("attachments", T.IntegerType())])


def decoded(text: str | None) -> str | None:
    """Encoded header words of any form and charset decoded; broken ones stay as they are."""
    if not text or "=?" not in text:
        return text
    try:
        return str(make_header(decode_header(text)))
    except Exception:
        return text


def _text(part) -> str:
    data = part.get_payload(decode=True) or b""
    try:
        return data.decode(part.get_content_charset() or "utf-8", "replace")
    except LookupError:
        return data.decode("utf-8", "replace")


def parsed(raw: bytes | None) -> tuple:
    """One row of PARSED. Of several text or HTML parts the last wins, so nested parts override outer ones."""
    if raw is None:
        return (None,) * 9
    message = message_from_bytes(bytes(raw), policy=policy.compat32)
    heads = [decoded(" ".join(str(message.get(h) or "").split())) for h in HEADERS]
    body = html = None
    attachments = 0
    for part in message.walk():
        if part.is_multipart():
            continue
        if part.get_filename():
            attachments += 1
        elif part.get_content_type() == "text/plain":
            body = _text(part)
        elif part.get_content_type() == "text/html":
            html = _text(part)
    return (*heads, body, html, attachments)


def _parse(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parsed(r) for r in raw], columns=PARSED.names)


def _decode(texts: pd.Series) -> pd.Series:
    return texts.map(decoded)


def parse_messages(raw: DataFrame, column: str = "raw") -> DataFrame:
    """raw with the parsed fields in place of the bytes."""
    others = [F.col(f"`{c}`") for c in raw.columns if c != column]
    return raw.select(*others, F.pandas_udf(_parse, PARSED)(F.col(column)).alias("_nl_p")).select(*others, "_nl_p.*")


def decode_words(c: Column) -> Column:
    """Only texts that hold an encoded word go through Python."""
    return F.when(F.contains(c, F.lit("=?")), F.pandas_udf(_decode, T.StringType())(c)).otherwise(c)
