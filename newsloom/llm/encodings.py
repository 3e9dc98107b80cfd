"""Text that was decoded with the wrong character encoding: found and, where possible, restored.

For every pair of a true and a wrong encoding the garbled sequences of a wide repertoire of characters are computed
beforehand and put into one multi-pattern automaton. UTF-8 read as a single-byte encoding garbles a character into two to
four characters beyond ASCII, so the automaton only has to look at runs of such characters; equal runs are looked up once.
Only matched spans are replaced; correct text around them stays as it is, also in the same field.

A match that could also be ordinary text (two letters of one script, a dash before a letter, a Cyrillic capital before a
quote) is weak and counts only beside another match or between letters of another script. Text garbled more than once is
undone pass by pass.

Single-byte Cyrillic read as Western European ("Ìàëûé") has no such sequences; there a word is garbled if all its letters
decode to one well-formed Cyrillic word, and a word of one or two letters only beside another such or a Cyrillic word.

Defined results: null and empty texts are clean; replacement characters make a text `lossy`, whatever else could be
restored in it; C1 control characters count as garbled. Texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from itertools import count

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Wrong encodings by which UTF-8 is commonly read, likelier ones first.
WRONG = ("cp1252", "latin-1", "mac_roman", "cp437", "cp1251", "iso8859-2", "cp1250", "cp850", "iso8859-15", "koi8-r", "cp866", "cp1254", "cp1253")
#: Characters whose garbled forms are computed: Latin, Greek, Cyrillic, punctuation, symbols, kana, Han, emoji.
REPERTOIRE = ((0xA0, 0x24F), (0x2B0, 0x2FF), (0x370, 0x4FF), (0x2000, 0x206F), (0x20A0, 0x20CF), (0x2100, 0x22FF), (0x2460, 0x27BF), (0xFB00, 0xFB06), (0xFE0E, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFFD, 0xFFFD), (0x1F300, 0x1FAFF))
#: Control characters appear within text that was garbled twice: those that the first wrong reading had left.
CONTROLS = {"latin-1": ((0x80, 0x9F),), "cp1252": ((0x81, 0x81), (0x8D, 0x8D), (0x8F, 0x90), (0x9D, 0x9D))}
#: Hebrew and Arabic, two characters when garbled, which may stand side by side in correct text too: one alone is no sign.
PAIRED = ((0x590, 0x6FF),)
#: Scripts of India, Thai and Lao: three characters when garbled.
BRAHMIC = ((0x900, 0xEFF),)
#: Kana, Han and Hangul, whose garbled forms are computed for the likeliest encodings only.
EAST_ASIAN, EAST_ASIAN_WRONG = ((0x3000, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3)), ("cp1252", "latin-1")

NON_ASCII = re.compile(r"[^\x00-\x7f]+")
LOST = "�"
BOX = re.compile(r"[─-╿]")
DASHES_QUOTES = set("–—‘’“”‚„…•·«»‹›§°†‡")
CYRILLIC = re.compile(r"[Ѐ-ӿ]")


def _table(encoding: str) -> list[str]:
    """The character of each byte; undefined bytes come out as control characters, as lenient decoders give them."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def _is_weak(garbled: str, encoding: str) -> bool:
    if garbled.isalpha() and all(CYRILLIC.match(c) for c in garbled):
        return garbled in (garbled.lower(), garbled.upper(), garbled.title())
    if len(garbled) > 2 or encoding in ("latin-1", "cp1252", "cp1254"):
        return False
    first, second = garbled
    if all(BOX.match(c) for c in garbled) or first in DASHES_QUOTES:
        return True
    if encoding in ("cp1251", "koi8-r", "cp866", "cp850", "cp1253", "mac_roman"):
        return first.isalpha() and (second.isalpha() or encoding == "cp1251" or second in DASHES_QUOTES)
    return False


@lru_cache(maxsize=1)
def automaton() -> tuple[ahocorasick.Automaton, list[tuple[int, list[tuple[str, str, bool]]]]]:
    """The automaton and, by its values, the length and the readings of each sequence: (wrong encoding, true character, weak)."""
    readings: dict[str, list[tuple[str, str, bool]]] = {}
    for encoding in WRONG:
        chars = _table(encoding)
        for low, high in REPERTOIRE + CONTROLS.get(encoding, ()) + PAIRED + BRAHMIC + EAST_ASIAN * (encoding in EAST_ASIAN_WRONG):
            for code in range(low, high + 1):
                c = chr(code)
                garbled = "".join(chars[b] for b in c.encode("utf-8"))
                readings.setdefault(garbled, []).append((encoding, c, (low, high) in PAIRED or _is_weak(garbled, encoding)))
    for b in range(0x80, 0xA0):  # Western Windows text read as Latin-1 keeps one control character for each of these
        c = _table("cp1252")[b]
        if c != chr(b):
            readings.setdefault(chr(b), []).append(("latin-1", c, False))
    auto = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    values = []
    for i, (garbled, own) in enumerate(readings.items()):
        auto.add_word(garbled, i)
        values.append((len(garbled), own))
    auto.make_automaton()
    return auto, values


#: The matches of shorter runs are kept, as the same words recur; longer runs hardly do.
KEPT_CHARS = 64


def _matches(run: str) -> tuple[tuple[int, int, int], ...]:
    """(start, end, value) of the longest matches in a run, from the left, without overlap."""
    return _kept_matches(run) if len(run) <= KEPT_CHARS else _find_matches(run)


def _find_matches(run: str) -> tuple[tuple[int, int, int], ...]:
    auto, values = automaton()
    return tuple((end + 1 - values[v][0], end + 1, v) for end, v in auto.iter_long(run))


_kept_matches = lru_cache(maxsize=200_000)(_find_matches)


def spans(text: str) -> list[tuple[int, int, int]]:
    """The garbled spans of a text: (start, end, value in the automaton)."""
    found: list[tuple[int, int, int]] = []
    for m in NON_ASCII.finditer(text):
        own = _matches(m.group())
        if not own:
            continue
        at = m.start()
        values = automaton()[1]
        for i, (a, b, v) in enumerate(own):
            if all(weak for _, _, weak in values[v][1]):
                natural = CYRILLIC.match(m.group()[a]) and not _mixed(m.group())
                beside = not natural and ((i > 0 and own[i - 1][1] == a) or (i + 1 < len(own) and own[i + 1][0] == b))
                before = text[at + a - 1 : at + a]
                after = text[at + b : at + b + 1]
                if not (beside or _stands_out(text[at + a : at + b], before, after)):
                    continue
            found.append((at + a, at + b, v))
    return found


def _mixed(run: str) -> bool:
    """Whether a run with Cyrillic letters can't be words: capitals inside, or signs between its letters."""
    words = re.split(r"[^\w]+", run)
    return len([w for w in words if w]) > 1 or any(w[1:] != w[1:].lower() and w != w.upper() for w in words)


def _stands_out(garbled: str, before: str, after: str) -> bool:
    """Whether a weak match can't be ordinary text where it stands."""
    if all(BOX.match(c) for c in garbled):
        return not (BOX.match(before or " ") or BOX.match(after or " "))
    if CYRILLIC.match(garbled):
        if before.isalpha() or after.isalpha():
            return not (CYRILLIC.match(before or " ") or CYRILLIC.match(after or " "))
        if garbled.isalpha():
            return len(garbled) == 2 and after.isdigit() and garbled[1] not in "Ёё"
        return garbled[1] not in "«»„“”‘’…–—" or (garbled[1] in "«„“‘" and not after.isalnum())
    return bool(garbled[0] in "–—" and re.fullmatch(r"/|[–—]", after or " "))


# ---- single-byte Cyrillic read as Western European

WESTERN_WORD = re.compile(r"(?<![^\W\d_])[À-ÿ¨¸]+(?![^\W\d_])")
CYRILLIC_SOURCES = ("cp1251", "koi8-r")
VOWELS = set("аеёиоуыэюя")


def _cyrillic_reading(word: str) -> str | None:
    """The Cyrillic word that these Western letters are, or None."""
    for source in CYRILLIC_SOURCES:
        try:
            read = word.encode("cp1252").decode(source)
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if read.isalpha() and (read.islower() or read.istitle() or (read.isupper() and len(read) > 2)) and (VOWELS & set(read.lower()) or len(read) == 1) and all("Ѐ" <= c <= "џ" for c in read):
            return read
    return None


def western_cyrillic(text: str) -> list[tuple[int, int, str]]:
    """Words of Cyrillic text that was read as Western European: (start, end, true word)."""
    sure, short = [], []
    for m in WESTERN_WORD.finditer(text):
        if read := _cyrillic_reading(m.group()):
            (sure if len(read) > 2 else short).append((m.start(), m.end(), read))
    if not short:
        return sure
    marked = {p for a, b, _ in sure for p in (a, b)}
    for a, b, read in short:
        left, right = text[:a].rstrip(" "), text[b:].lstrip(" ")
        if CYRILLIC.match(left[-1:] or " ") or CYRILLIC.match(right[:1] or " ") or len(left) in marked or len(text) - len(right) in marked:
            sure.append((a, b, read))
            marked |= {a, b}
    return sorted(sure)


CONTROL = re.compile("[\x80-\x84\x86-\x9f]")


def is_garbled(text: str | None) -> bool:
    if not text or text.isascii():
        return False
    return LOST in text or CONTROL.search(text) is not None or bool(spans(text)) or bool(western_cyrillic(text))


def restore(text: str | None) -> tuple[str | None, str]:
    """The text with its garbled spans replaced, and its state: clean, restored or lossy."""
    if not text or text.isascii():
        return text, "clean"
    out, state = text, "clean"
    for n in count():  # every pass makes the text shorter or takes control characters away, so it ends
        own, words = spans(out), western_cyrillic(out) if n == 0 else []  # what has just been restored is no garbled Cyrillic
        if not own and not words:
            break
        values = automaton()[1]
        votes = Counter(encoding for _, _, v in own for encoding, _, _ in values[v][1])
        edits = [(a, b, max(values[v][1], key=lambda r: votes[r[0]])[1]) for a, b, v in own]
        taken = {p for a, b, _ in edits for p in range(a, b)}
        edits += [(a, b, w) for a, b, w in words if not taken.intersection(range(a, b))]
        if not edits:
            break
        parts, at = [], 0
        for a, b, c in sorted(edits):
            parts += [out[at:a], c]
            at = b
        out, state = "".join([*parts, out[at:]]), "restored"
    return out, "lossy" if LOST in out or CONTROL.search(out) else state


# ---- Spark

SUSPECT = r"[^\x00-\x7F]"


def _garbled(texts: pd.Series) -> pd.Series:
    return texts.map(is_garbled).astype(bool)


def _restored(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([restore(t) for t in texts], columns=["fixed", "state"])


RESTORED = T.StructType([T.StructField("fixed", T.StringType()), T.StructField("state", T.StringType())])


def garbled_rows(df: DataFrame, field: str) -> DataFrame:
    """The rows whose field holds wrongly decoded characters; texts in pure ASCII are dropped before Python sees them."""
    c = F.col(f"`{field}`")
    return df.filter(c.rlike(SUSPECT)).filter(F.pandas_udf(_garbled, T.BooleanType())(c))


def with_restored(df: DataFrame, field: str, fixed: str = "fixed", state: str = "state") -> DataFrame:
    """df with the restored text and its state (clean, restored, lossy); null stays null. Columns of these two names are replaced."""
    c: Column = F.col(f"`{field}`")
    done = F.when(c.rlike(SUSPECT), F.pandas_udf(_restored, RESTORED)(c))
    return df.withColumn("_nl_r", done).withColumn(fixed, F.coalesce("_nl_r.fixed", c)).withColumn(state, F.coalesce("_nl_r.state", F.lit("clean"))).drop("_nl_r")
