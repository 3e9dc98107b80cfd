"""Column functions over headers, subjects and bodies. All stay inside the JVM; null gives null unless stated otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Reading speed in words a minute.
WORDS_PER_MINUTE = 230


# ---- encodings of mail


def from_base64url(c: Column) -> Column:
    """Text from the URL-safe alphabet, with or without padding."""
    plain = F.translate(c, "-_", "+/")
    return F.decode(F.unbase64(F.concat(plain, F.repeat(F.lit("="), F.pmod(-F.length(plain), F.lit(4))))), "UTF-8")


def to_base64url(c: Column) -> Column:
    return F.regexp_replace(F.translate(F.base64(c.cast("binary")), "+/", "-_"), r"[=\s]+", "")


def encode_header_word(c: Column) -> Column:
    """An encoded word if there is a character beyond printable ASCII, else the text itself."""
    return F.when(c.rlike(r"^[\x20-\x7E]*$"), c).otherwise(F.concat(F.lit("=?UTF-8?B?"), F.regexp_replace(F.base64(c.cast("binary")), r"\s", ""), F.lit("?=")))


def decode_base64_word(c: Column) -> Column:
    """A header that is one base64 UTF-8 word, decoded; anything else as it is (see newsloom.sources.mime for all forms)."""
    inner = F.regexp_extract(c, r"(?i)^\s*=\?utf-8\?b\?([A-Za-z0-9+/=]*)\?=\s*$", 1)
    return F.when(inner == "", c).otherwise(F.decode(F.unbase64(inner), "UTF-8"))


# ---- headers


def header_block(raw: Column) -> Column:
    """The lines before the first blank line, with continued lines joined by one space."""
    return F.regexp_replace(F.element_at(F.split(raw, r"\r?\n\r?\n", 2), 1), r"\r?\n[ \t]+", " ")


def header(block: Column, name: str) -> Column:
    """The first header of that name in any case, trimmed; empty if it is absent or empty. An empty header never takes the next line."""
    return F.trim(F.regexp_extract(block, rf"(?im)^{name}:[ \t]*([^\r\n]*)$", 1))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in columns))


def address_of(c: Column) -> Column:
    """The address in angle brackets, else the whole text; lower case."""
    inner = F.regexp_extract(c, r"<([^>]+)>", 1)
    return F.lower(F.trim(F.when(inner == "", c).otherwise(inner)))


def shown_name(c: Column) -> Column:
    """The text before the angle bracket without quotes, else the whole text."""
    return F.when(F.contains(c, F.lit("<")), F.trim(F.regexp_replace(F.regexp_extract(c, r"^([^<]*)<", 1), '"', ""))).otherwise(F.trim(c))


def plus_tag(c: Column) -> Column:
    """The tag between `+` and `@`, lower case; null without one."""
    return F.nullif(F.regexp_extract(F.lower(c), r"\+([a-z]+)@", 1), F.lit(""))


def domain_of(address: Column) -> Column:
    return F.lower(F.regexp_extract(address, r"@([^@>\s]+)", 1))


def slug(c: Column, size: int = 28) -> Column:
    """Lower case, runs of other characters as one hyphen, none at the ends before cutting; `x` for null or empty."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", "")
    return F.when(F.coalesce(c, F.lit("")) == "", "x").otherwise(F.substring(plain, 1, size))


# ---- measures


def words_of(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words_of(c)).cast("long")


def reading_minutes(words: Column) -> Column:
    return words / WORDS_PER_MINUTE


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def summary_line(c: Column, size: int = 140) -> Column:
    """One line: blanks collapsed, cut with an ellipsis above the size."""
    flat = F.regexp_replace(F.trim(c), r"\s+", " ")
    return F.when(F.length(flat) > size, F.concat(F.rtrim(F.substring(flat, 1, size)), F.lit("…"))).otherwise(flat)


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", "")


def safe_file_name(c: Column) -> Column:
    return F.regexp_replace(c, r'[/\\?%*:|"<>]', "_")


# Types of attachments by extension.
MIME_TYPES = {
    "pdf": "application/pdf", "txt": "text/plain", "html": "text/html", "csv": "text/csv", "json": "application/json", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif",
    "zip": "application/zip", "doc": "application/msword", "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "xls": "application/vnd.ms-excel", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}


def mime_type(file_name: Column) -> Column:
    ext = F.lower(F.regexp_extract(file_name, r"\.([A-Za-z0-9]+)$", 1))
    known = F.create_map(*(F.lit(x) for kv in MIME_TYPES.items() for x in kv))
    return F.coalesce(F.try_element_at(known, ext), F.lit("application/octet-stream"))


def csv_cell(c: Column) -> Column:
    """Always quoted; quotes doubled, line breaks as blanks; null as an empty cell."""
    return F.concat(F.lit('"'), F.replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\r?\n", " "), F.lit('"'), F.lit('""')), F.lit('"'))


def insert_after(text: Column, marker: str, entry: str) -> Column:
    """The entry after the first occurrence of the marker, else at the end."""
    at = F.locate(marker, text)
    end = at + len(marker)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), end - 1), F.lit(entry), F.substring(text, end, F.length(text)))).otherwise(F.concat(text, F.lit(entry)))


def split_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


# ---- items in subjects and bodies


def subject_topics(c: Column) -> Column:
    """Topics of a list subject: `Plus! a; b; c`, `N: a; b`, else parts between semicolons; empty array if there is no list."""
    rest = F.regexp_replace(c, r"^(?:Fwd: )?(?:Plus!|\d+:) *", "")
    return F.when(F.contains(rest, F.lit(";")), F.filter(F.transform(F.split(rest, ";"), lambda x: F.trim(x)), lambda x: x != "")).otherwise(F.array().cast("array<string>"))


EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE0F}\x{200D}]+"


def listed_topics(c: Column) -> Column:
    """Topics of all list subjects: `a; b`, three or more between commas, `N: ` or `Plus! ` before a list, an emoji after each."""
    rest = F.regexp_replace(c, r"^(?:Fwd: )?(?:Plus!|(?:[^:;,]* )?\d+:) *", "")
    by = F.when(F.contains(rest, F.lit(";")), F.split(rest, ";")).when(rest.rlike(r",.*,") | ((rest != c) & F.contains(rest, F.lit(","))), F.split(rest, r",(?!\d{3}\b)"))
    by = by.when(rest.rlike(rf"{EMOJI}[^,;]*{EMOJI}[^,;]*{EMOJI}"), F.split(rest, EMOJI))
    clean = F.transform(by, lambda x: F.trim(F.regexp_replace(x, rf"^\s*and |{EMOJI}", "")))
    return F.coalesce(F.filter(clean, lambda x: x != ""), F.array().cast("array<string>"))


# Verbs of a move up and down.
UP = "soars?|soared|jumps?|jumped|surges?|surged|rises?|rose|gains?|gained|climbs?|climbed|rallies|rallied|adds|added|leaps?|up"
DOWN = "falls?|fell|drops?|dropped|slides?|slid|sinks?|sank|plunges?|plunged|tumbles?|tumbled|slips?|slipped|loses|lost|sheds?|crashes|crashed|down"
_PART = r"[\p{L}\p{N}.&’'_-]"
_NUMBER = r"(\d[\d,]*(?:\.\d+)?) ?%\)?(?: (?:on|after|as|amid) ([^,;.|\n]+))?"
#: The same without looking ahead, as SQL has it: name, verb, sign after a verb, sign alone, number, reason.
MOVER_RE2 = rf"(\p{{Lu}}{_PART}+(?: [\p{{Lu}}\d]{_PART}*)*|[\p{{L}}\p{{N}}_]+)(?: (?:is |are )?({UP}|{DOWN})(?: by)? +([+−–▲▼-]?)|[ :(]+([+−–▲▼-])) ?{_NUMBER}"
_MOVER = rf"(\p{{Lu}}(?!ƒ)[\p{{L}}\p{{N}}.&’'_-]+(?: [\p{{Lu}}\d][\p{{L}}\p{{N}}.&’'_-]*)*|[\p{{L}}\p{{N}}_]+)(?: (?:is |are )?({UP}|{DOWN})(?: by)? +|[ :(]+(?=[+−–▲▼-]))([+−–▲▼-]?) ?(\d[\d,]*(?:\.\d+)?) ?%\)?(?: (?:on|after|as|amid) ([^,;.|\n]+))?"


def movers(c: Column) -> Column:
    """Each move of a line as (name, pct, direction, reason): by verb or by sign; pct is negative for a move down."""

    def one(x: Column) -> Column:
        part = lambda i: F.regexp_extract(x, _MOVER, i)
        down = part(2).rlike(f"^(?:{DOWN})$") | part(3).isin("−", "–", "-", "▼")
        pct = F.replace(part(4), F.lit(","), F.lit("")).cast("double")
        return F.struct(part(1).alias("name"), F.when(down, -pct).otherwise(pct).alias("pct"), F.when(down, "down").otherwise("up").alias("direction"), F.nullif(F.trim(part(5)), F.lit("")).alias("reason"))

    return F.transform(F.regexp_extract_all(c, F.lit(_MOVER), F.lit(0)), one)


#: A deal in a subject: company, amount, magnitude.
DEAL = r"(?i)([\p{L}\p{N}_]+)(?:’s| raises| raised| lands| secures| closes| gets) (?:[$€£])([0-9][0-9,]*(?:\.[0-9]+)?) ?(K|M|B|T|million|billion|)\b"


def subject_deal(c: Column) -> Column:
    """`Acme’s $12M bet`, `Acme raises $12M` and the like as (company, amount)."""
    scale = F.regexp_extract(c, DEAL, 3)
    times = F.when(scale == "K", 1000).when(scale.isin("B", "billion"), 1_000_000_000).when(scale == "T", 1_000_000_000_000).when(scale == "", 1).otherwise(1_000_000)
    return F.struct(F.trim(F.regexp_extract(c, DEAL, 1)).alias("company"), (F.replace(F.regexp_extract(c, DEAL, 2), F.lit(","), F.lit("")).try_cast("decimal(18,4)") * times).alias("amount"))


def signpost(c: Column) -> Column:
    """The take after `Why it matters:` or `The bottom line:`; empty if there is none."""
    return F.trim(F.regexp_extract(c, r"(?i)(?:why it matters|the bottom line): *([^\n]+)", 1))


def tickers(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\$([A-Z]{1,5})\b"), F.lit(1))


NUMBER = r"[$€£]?\d[\d,]*(?:\.\d+)?(?: ?(?:%|bps|[KMBT]\b))?"


def numbers(c: Column) -> Column:
    """Amounts as written, with currency, unit and magnitude."""
    return F.regexp_extract_all(c, F.lit(f"({NUMBER})"), F.lit(1))


def number_value(c: Column) -> Column:
    """The number with its magnitude applied: `$81B` is 81e9; null if there is none."""
    plain = F.try_to_number(F.nullif(F.regexp_replace(F.regexp_extract(c, r"(\d[\d,]*(?:\.\d+)?)", 1), ",", ""), F.lit("")), F.lit("999999999999999999.999999"))
    scale = F.regexp_extract(c, r"\d ?([KMBT])\b", 1)
    times = F.when(scale == "K", 1e3).when(scale == "M", 1e6).when(scale == "B", 1e9).when(scale == "T", 1e12).otherwise(1.0)
    return plain.cast("double") * times


def number_unit(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("%")), "%").when(F.contains(c, F.lit("bps")), "bps").when(c.rlike("^[$]"), "$").when(c.rlike("^€"), "€").when(c.rlike("^£"), "£").otherwise("")


def read_label(c: Column) -> Column:
    """Minutes of the label `N min read` or `(N MINUTE READ)`; null without one."""
    return F.regexp_extract(c, r"(?i)\b(\d+) min(?:ute)? read\b", 1).try_cast("long")


def token_set(c: Column) -> Column:
    """Distinct words in lower case, sorted; signs are no part of words."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")))


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return F.try_divide(common, F.size(a) + F.size(b) - common)


def edit_similarity(a: Column, b: Column) -> Column:
    return 1 - F.try_divide(F.levenshtein(a, b), F.greatest(F.length(a), F.length(b)))


def strip_cells(n: Column, positions: Column) -> Column:
    """A coverage strip: one sign for each of n places, filled where positions says so."""
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.when(F.array_contains(positions, i), "■").otherwise("□")), "")


# ---- lines of structured items


def deal(c: Column) -> Column:
    """`Acme, a Berlin-based maker of X, raised $12M in Series A funding led by Y with participation from Z` as (company, place,
    amount, round, lead, participants, sector); empty where not stated. The sector is the emoji before the line."""
    part = lambda p: F.trim(F.regexp_extract(c, p, 1))
    return F.struct(
        part(r"^\W*([^,:]+?)(?:,| raised| raises)").alias("company"), part(r", an? ([^,]+?)-based").alias("place"), part(r"(?i)rais(?:ed|es) ([$€£]\d[\d.,]* ?(?:[KMBT]|million|billion)?)").alias("amount"),
        part(r"(?i)\b((?:pre-)?seed|series [a-z])\b").alias("round"), part(r"(?i)led by ([^.,;]+)").alias("lead"),
        part(r"(?i)(?:participation (?:from|by)|joined by|participants:) ([^.;]+)").alias("participants"), F.regexp_extract(c, rf"^\s*({EMOJI})", 1).alias("sector"),
    )


def item_parts(c: Column) -> Column:
    """An item's subhead after an ellipsis and its link to the whole story, as (subhead, more); empty where not stated."""
    return F.struct(F.trim(F.regexp_extract(c, r"\n\s*(?:\.\.\.|…) *([^\n]+)", 1)).alias("subhead"), F.regexp_extract(c, r"(?i)(?:read more|full story|continue reading)[^\n]{0,40}?(https?://[^\s<>\"]+)", 1).alias("more"))


def calendar_day(c: Column) -> Column:
    """The date before the colon of a calendar line; null if it is no date."""
    return F.try_to_date(F.nullif(F.regexp_extract(c, r"^\s*(\d{4}-\d{2}-\d{2}):", 1), F.lit("")))


def repo(c: Column) -> Column:
    """`owner/name ★ 1,234` as (name, stars)."""
    return F.struct(F.regexp_extract(c, r"([\w.-]+/[\w.-]+)", 1).alias("name"), F.regexp_replace(F.regexp_extract(c, r"(?:★|⭐|stars:?) ?(\d[\d,]*)", 1), ",", "").try_cast("long").alias("stars"))


def calendar_items(c: Column) -> Column:
    """Items of `Tue: a · b · c`, without the day."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, r"^[^:]{1,20}: *", ""), "·"), lambda x: F.trim(x)), lambda x: x != "")


def contents(c: Column) -> Column:
    """The list after `In this issue:` (or a like marker) up to the next blank line; empty if there is none."""
    return F.trim(F.regexp_extract(c, r"(?is)(?:in this issue|in today.s issue|what's inside|table of contents):?[ \t]*\n(.*?)(?:\n[ \t]*\n|$)", 1))


def holds_any(c: Column, words: list[str]) -> Column:
    """Whether one of the words stands in the text as a whole word, in any case."""
    return c.rlike(r"(?i)(?:^|[^\p{L}])(?:" + "|".join(words) + r")(?:[^\p{L}]|$)")


def cells_text(paragraphs: Column) -> Column:
    """Rows of cells as text: cells joined by tabs, rows by line breaks."""
    return F.array_join(F.transform(paragraphs, lambda row: F.array_join(row, "\t")), "\n")


# ---- evidence in headers, structured values


def exact_header(block: Column, name: str) -> Column:
    """As `header`, but the name must have the very case; empty if there is none."""
    return F.trim(F.regexp_extract(block, rf"(?m)^{name}:[ \t]*([^\r\n]*)$", 1))


def sending_platform(block: Column) -> Column:
    """The domain that signed or sent a message: of DKIM, else of SPF, else of the ARC results; lower case, null without any."""
    of = lambda p: F.nullif(F.lower(F.regexp_extract(block, p, 1)), F.lit(""))
    return F.coalesce(of(r"(?im)^DKIM-Signature:[^\r\n]*\bd=([a-z0-9.-]+)"), of(r"(?im)^Received-SPF: *pass[^\r\n]*domain of [^@\s)]*@?([a-z0-9.-]+)"), of(r"(?im)^ARC-Authentication-Results:[^\r\n]*\bsmtp\.mailfrom=(?:[^@\s;]*@)?([a-z0-9.-]+)"))


def payload_value(payload: Column, path: str, kind: str) -> Column:
    """A typed value of a JSON payload; null where the payload is broken, the path absent or the value of another type."""
    return F.try_variant_get(F.try_parse_json(payload), path, kind)


def filled_emails(attendees: Column) -> Column:
    """The addresses of a JSON list of attendees, without the empty ones; an empty array for anything else."""
    parsed = F.from_json(attendees, "array<struct<email string>>")
    return F.coalesce(F.filter(F.transform(parsed, lambda a: a["email"]), lambda e: e != ""), F.array().cast("array<string>"))


def link_state(status: Column, took_ms: Column, limit_ms: int = 5000) -> Column:
    """`ok` for 2xx and 3xx in time, `slow` beyond it, `dead` for other answers, `unchecked` without one."""
    return F.when(status.isNull(), "unchecked").when(~status.between(200, 399), "dead").when(took_ms > limit_ms, "slow").otherwise("ok")
