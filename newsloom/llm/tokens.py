"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import importlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.plans.durable import durable

#: The setting of the session that names a file of byte-level BPE ranks, the same on all executors. Without it the file of this
#: name is taken from the installed package of public tokenizers.
SETTING, FILE = "spark.newsloom.vocabulary", "byte_bpe_50k.tiktoken"
# Fixed value: how texts are cut before merging, as published with this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_of() -> str:
    """The path of the installed package's file."""
    return importlib.import_module("public_tokenizers").path(FILE)


@lru_cache(maxsize=4)
def encoding(vocabulary: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str, vocabulary: str | None = None) -> int:
    return len(encoding(vocabulary or vocabulary_of()).encode_ordinary(text))


def sized(docs: DataFrame, key: str, text: str, also: tuple[str, ...] = (), vocabulary: str | None = None) -> DataFrame:
    """(key, also..., tokens) of the documents with a text, written once; whole texts are counted, empty ones dropped."""
    file = vocabulary or docs.sparkSession.conf.get(SETTING, None)  # else each executor takes it from its own package

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(file or vocabulary_of()).encode_ordinary
        for b in batches:
            sizes = [len(encode(t)) for t in b.pop("_nl_text")]
            yield b.assign(tokens=sizes)

    slim = docs.filter(F.length(text) > 0).select(*(F.col(f"`{c}`") for c in (key, *also)), F.col(f"`{text}`").alias("_nl_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return durable(slim.mapInPandas(run, f"{schema}, tokens long"))
