"""Newsletters of a tracker and senders of a mailbox, which share no key, linked as one graph.

Profiles are what the mailbox shows of a sender: address, shown name, box written to. Both sides are described by partial,
noisy attributes (bags of name words in any order, compact names, names with one letter missing, publishers, hosts).

1. Candidate graph: profiles and tracker rows that share an attribute, each shared attribute weighted by how rare it is.
2. Meta-blocking: attributes that very many newsletters bear are purged, and of each profile only the edges at or above its
   mean edge weight remain.
3. Own similarity of each edge from the kinds of its evidence. A shown name that equals a current or former name is sure; an
   address that spells the name is strong; a misspelt name, a publisher or a host alone are weak.
4. Propagation: an address hands what its sure profiles say to its other profiles (a bare first name, initials, a publisher,
   a misspelling), split among its newsletters by the box that was written to, until no similarity moves. Only sure evidence
   is handed on, so that many misspellings or look-alikes never add up to a link, and a profile that names another
   newsletter of the same publisher takes no such support.

Confidence is the final similarity; links below LEAST are not made. Ties go to the larger similarity, then the smaller id.

Every step is a DataFrame: hot senders are one profile each, aggregates combine on the map side, and what is broadcast is
counted first. Defined results: rows without an address or a name are not linked; null publishers, hosts and boxes are no
evidence; an empty side gives an empty result.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from email.header import decode_header, make_header
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from newsloom.plans.durable import durable, join_counted

#: Similarity that each kind of evidence gives alone; kinds add up as independent chances.
SURE, SPELT, MISSPELT, PUBLISHER, HOST, WORD = 1.0, 0.7, 0.4, 0.25, 0.2, 0.1
#: Links below are not made.
LEAST = 0.5
#: How well the box written to fits a newsletter: the one it was ordered to, not known, another.
BOX_SAME, BOX_UNKNOWN, BOX_OTHER = 1.0, 0.3, 0.05
#: The weight of a neighbour's newsletter for a profile that itself shows nothing of it.
NO_EVIDENCE = 0.05
#: The share of a neighbour's certainty that is handed on; the change below which it is stable; the rounds after which
#: similarities may only grow, so that the propagation always ends.
HANDED_ON, STABLE, CALM_ROUNDS = 0.9, 0.01, 12
#: Block purging: an attribute borne by so many newsletters that it would add less to an edge than this names none of them.
LEAST_WEIGHT = 0.002
#: Tables are broadcast up to so many rows.
BROADCAST_ROWS = 200_000
#: Names with a letter missing are written out up to this length, longer ones as a hash.
WRITTEN_OUT = 40

# Words that names are written with or without, legal forms of publishers, habits of host names.
FILL_WORDS = {"the", "a", "newsletter", "newsletters", "team", "daily", "no", "reply", "noreply"}
LEGAL_FORMS = {"llc", "ltd", "inc", "co", "l", "c", "gmbh", "corp", "company"}
HOST_PREFIXES, HOST_SUFFIXES = ("get", "the", "join", "try", "read"), ("hq", "mail", "news", "media", "letters", "letter", "app")

SPLIT_OFF = re.compile(r"\s+(?:[|•·]|by)\s+")
PERSON_AT = re.compile(r"\s+(?:at|from|@|of|via|bei|chez|von)\s+", re.IGNORECASE)
FORMER = re.compile(r"\((?:ex-|ex |formerly |fka )\s*([^)]*)\)", re.IGNORECASE)
HOST_NOTE = re.compile(r"\(([\w-]+(?:\.[\w-]+)+)\)")
_BASE, _PRIME = 1_000_003, 2**61 - 1
LETTERS = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ß": "ss", "ı": "i"})


def fold(text: str) -> str:
    """Lower case without marks on letters."""
    return text.lower() if text.isascii() else _fold(text) if len(text) <= 200 else _fold.__wrapped__(text)


@lru_cache(maxsize=100_000)
def _fold(text: str) -> str:
    plain = unicodedata.normalize("NFKD", text.lower().translate(LETTERS))
    return "".join(c for c in plain if not unicodedata.combining(c))


def words(text: str, drop: set[str] = FILL_WORDS) -> list[str]:
    found = re.findall(r"[^\W_]+", fold(re.sub(r"['’]", "", text)))
    return [w for w in found if w not in drop] or found


def _deletions(compact: str) -> set[str]:
    """The name and all forms of it with one letter missing, in time that grows with the length only."""
    n = len(compact)
    if n <= WRITTEN_OUT:
        return {compact[:i] + compact[i + 1 :] for i in range(n)} | {compact} if n > 4 else set()
    # a polynomial hash of the letters before and after the gap
    before, powers = [0], [1]
    for c in compact:
        before.append((before[-1] * _BASE + ord(c)) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    whole = before[n]
    found = {f"#{whole}"}
    for i in range(n):
        after = whole - before[i + 1] * powers[n - i - 1]
        found.add(compact[:i] + compact[i + 1 :] if n - 1 <= WRITTEN_OUT else f"#{(before[i] * powers[n - i - 1] + after) % _PRIME}")
    return found


def _bags(parts: list[list[str]]) -> set[tuple[str, str]]:
    out = set()
    for p in parts:
        if p:
            out |= {("k:" + " ".join(sorted(p)), "name"), ("c:" + "".join(p), "name")}
    return out


@lru_cache(maxsize=100_000)
def _host_cores(host: str) -> set[str]:
    labels = host.split(".")[:-1] or [host]
    out = set()
    for label in labels:
        plain = fold(label)
        out |= {plain.replace("-", "")}
        for piece in (plain, plain.split("-")[0]) if plain.rpartition("-")[2] in HOST_SUFFIXES else (plain,):
            core = piece.replace("-", "")
            for p in ("", *HOST_PREFIXES):
                for s in ("", *HOST_SUFFIXES):
                    if core.startswith(p) and core.endswith(s) and len(core) - len(p) - len(s) > 2:
                        out.add(core[len(p) : len(core) - len(s)])
    return out


def _publisher(text: str) -> str:
    return "p:" + " ".join(w for w in words(text, set()) if w not in LEGAL_FORMS)


def describe_sender(header: str | None) -> tuple[str | None, str, list[str], list[tuple[str, str]]]:
    """Address, shown name in normal form, the words that name the newsletter, and the attributes with their kinds."""
    header = header or ""
    m = re.search(r"<([^<>]*)>\s*$", header)
    address = (m[1] if m else header).strip().lower()
    shown = re.sub(r"\s*<[^<>]*>\s*$", "", header).strip().strip("\"'").strip() if m else ""
    if "=?" in shown:
        try:
            shown = str(make_header(decode_header(shown)))
        except Exception:  # a broken header word stays as it is
            pass
    local, _, host = address.partition("@")
    if not host:
        return None, "", [], []
    local = local.partition("+")[0]
    address = f"{local}@{host}"
    if "@" in shown and "." in shown.rpartition("@")[2] and " " not in shown:
        shown = ""
    shown = re.sub(r"\([^)]*\)", " ", shown)
    first, *rest = SPLIT_OFF.split(shown)
    ends = [words(x) for x in PERSON_AT.split(first) if x.strip()]
    core = [w for e in ends for w in e] if len(ends) == 2 and len(ends[1]) == 1 else ends[-1] if ends else []
    attrs = {(a, "shown") for a, _ in _bags([words(first), core, *ends])}
    for bag in (core, words(first)):
        attrs |= {("d:" + d, "misspelt") for d in _deletions("".join(sorted(bag, key=bag.index)))}
    attrs |= {(_publisher(x), "publisher") for x in [first, *rest] if x.strip()} | {("w:" + w, "word") for w in core if len(w) > 2}
    cores = _host_cores(host)
    attrs |= {("c:" + c, "spelt") for c in cores | {fold(local).replace("-", "")}} | {("k:" + " ".join(sorted({local, c})), "spelt") for c in cores} | {("h:" + host, "host")}
    return address, " ".join(core), core, sorted(attrs)


def describe_row(name: str | None, publisher: str | None, url: str | None) -> tuple[list[str], list[tuple[str, str]]]:
    """The words of a tracker row's name, and its attributes with their kinds."""
    name = name or ""
    current = words(re.sub(r"\([^)]*\)", " ", name))
    names = [current, *(words(x) for x in FORMER.findall(name))]
    attrs = _bags(names)
    for bag in names:
        attrs |= {("d:" + d, "misspelt") for d in _deletions("".join(bag))} | {("w:" + w, "word") for w in bag if len(w) > 2}
    for p in [re.sub(r"\([^)]*\)", " ", publisher or ""), *FORMER.findall(publisher or "")]:
        if p.strip():
            attrs.add((_publisher(p), "publisher"))
            plain = [w for w in words(p, set()) if w not in LEGAL_FORMS]
            if len(plain) > 1:
                attrs.add(("p:" + plain[0], "publisher"))
    hosts = HOST_NOTE.findall(name) + re.findall(r"^https?://([^/:?#]+)", url or "")
    attrs |= {("h:" + h.lower(), "host") for h in hosts}
    return current, sorted(attrs)


#: Attributes leave Python as plain texts, `kind|attribute`, since nested values are slow to convert.
SENDER = T.StructType([T.StructField("address", T.StringType()), T.StructField("label", T.StringType()), T.StructField("core", T.ArrayType(T.StringType())), T.StructField("attrs", T.ArrayType(T.StringType()))])
ROW = T.StructType([T.StructField("core", T.ArrayType(T.StringType())), T.StructField("attrs", T.ArrayType(T.StringType()))])


def _texts(attrs: list[tuple[str, str]]) -> list[str]:
    return [f"{kind}|{a}" for a, kind in attrs]


def _unpacked(df: DataFrame) -> DataFrame:
    """df with attrs as (kind, a) again."""
    return df.withColumn("attrs", F.transform("attrs", lambda x: F.struct(F.substring_index(x, "|", 1).alias("kind"), F.regexp_replace(x, r"^[a-z]+\|", "").alias("a"))))


def _rows(name: pd.Series, publisher: pd.Series, url: pd.Series) -> pd.DataFrame:
    described = (describe_row(*x) for x in zip(name, publisher, url, strict=True))
    return pd.DataFrame([(core, _texts(attrs)) for core, attrs in described], columns=["core", "attrs"])


def _broadcast(written: DataFrame) -> DataFrame:
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def _join_lists(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """rows joined with other, which has few rows for each key; it is broadcast if it is small, else hot keys of rows are split."""
    if other.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(other), key)
    per = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    values = [c for c in other.columns if c != key]
    lists = durable(other.groupBy(key).agg(F.collect_list(F.struct(*values)).alias("_v")).join(per, key))
    total = lists.agg(F.sum("_n")).first()[0] or 0
    return join_counted(rows, lists, key, "_n", total).select(*rows.columns, F.inline("_v"))


def box_of(*headers: Column) -> Column:
    """The first address with a `+` tag in the headers, else the first address at all."""
    found = [F.lower(F.regexp_extract(F.coalesce(h, F.lit("")), r"([\w.+-]+@[\w.-]+)", 1)) for h in headers]
    return F.coalesce(*(F.when(F.contains(x, F.lit("+")), x) for x in found), *(F.nullif(x, F.lit("")) for x in found), F.lit(""))


def known_attributes(tracker: DataFrame) -> set[str] | None:
    """The tracker's attributes, if they are few enough to send to all tasks: an attribute that it lacks can't be shared."""
    names = tracker.select(F.explode("attrs.a").alias("a")).distinct()
    return {r.a for r in names.collect()} if names.count() <= BROADCAST_ROWS else None


def profiles_of(headers: DataFrame, known: set[str] | None = None) -> DataFrame:
    """(from_h, box, n) with address, label, core and attributes; headers has from_h, box and n, each pair once."""
    shared = headers.sparkSession.sparkContext.broadcast(known)

    def senders(batch: pd.Series) -> pd.DataFrame:
        keep = shared.value
        rows = (describe_sender(h) for h in batch)
        rows = [(a, label, core, _texts(attrs if keep is None else [x for x in attrs if x[0] in keep])) for a, label, core, attrs in rows]
        return pd.DataFrame(rows, columns=["address", "label", "core", "attrs"])

    # the headers are small but slow to describe: they are spread over all cores again after the shuffle has gathered them
    spread = headers.select("from_h").distinct().repartition(headers.sparkSession.sparkContext.defaultParallelism)
    # declared non-deterministic so that the filter below never moves the description to the rows before they are made distinct
    describe = F.pandas_udf(senders, SENDER).asNondeterministic()
    names = spread.withColumn("s", describe("from_h")).select("from_h", "s.*")
    return headers.join(_unpacked(names.filter("address IS NOT NULL")), "from_h")


def merged(described: DataFrame) -> DataFrame:
    """One row per pid with the attributes of all its headers: with and without a publisher, a person or another order of words.

    Address, box and core are the same in all rows of a pid.
    """
    one = described.groupBy("pid").agg(F.first("address").alias("address"), F.first("box").alias("box"), F.first("core").alias("core"), F.sum("n").alias("n"))
    attrs = described.select("pid", F.explode("attrs").alias("x")).distinct().groupBy("pid").agg(F.sort_array(F.collect_list("x")).alias("attrs"))
    return one.join(attrs, "pid", "left").withColumn("attrs", F.coalesce("attrs", F.array().cast(attrs.schema["attrs"].dataType)))


def candidate_edges(profiles: DataFrame, tracker: DataFrame) -> DataFrame:
    """(pid, sid, own): edges of the pruned candidate graph with their own similarity."""
    ours = profiles.select("pid", F.explode("attrs").alias("x")).select("pid", F.col("x.a").alias("a"), F.col("x.kind").alias("kind"))
    theirs = tracker.select("sid", F.explode("attrs").alias("x")).select("sid", F.col("x.a").alias("a"))
    per = W.Window.partitionBy("a")
    theirs = durable(theirs.distinct().withColumn("df", F.count(F.lit(1)).over(per)))
    weight = {"shown": SURE, "spelt": SPELT, "misspelt": MISSPELT, "publisher": PUBLISHER, "host": HOST, "word": WORD}
    base = F.coalesce(*(F.when(F.col("kind") == k, F.lit(w)) for k, w in weight.items()))
    # rare shared attributes weigh more; a name that several rows bear is no sure sign of one of them
    hits = _join_lists(ours, theirs.filter(F.col("df") <= SURE / LEAST_WEIGHT), "a").withColumn("w", base / F.col("df")).filter(F.col("w") >= LEAST_WEIGHT)
    edges = hits.groupBy("pid", "sid", "kind").agg(F.max("w").alias("top"), F.sum("w").alias("sum"))
    edges = edges.groupBy("pid", "sid").agg(F.sum("sum").alias("weight"), (1 - F.try_divide(F.exp(F.sum(F.log(F.greatest(F.lit(1e-6), 1 - F.col("top"))))), F.lit(1.0))).alias("own"))
    mine = W.Window.partitionBy("pid")
    return edges.withColumn("mean", F.avg("weight").over(mine)).filter(F.col("weight") >= F.col("mean") * (1 - 1e-9)).select("pid", "sid", "own")


def _publishers(attrs: str) -> Column:
    return F.transform(F.filter(attrs, lambda x: x["kind"] == "publisher"), lambda x: x["a"]).alias("publishers")


def _contradicts(shown: Column, name: Column, same_publisher: Column) -> Column:
    """Whether a shown name shares words with the name and differs in one that isn't a misspelling: another newsletter.

    A publisher's own name in full is none."""
    a, b = F.array_except(shown, name), F.array_except(name, shown)
    one = (F.size(a) == 1) & (F.size(b) == 1) & (F.size(F.array_intersect(shown, name)) > 0)
    return ~same_publisher & F.coalesce(one & (F.levenshtein(F.try_element_at(a, F.lit(1)), F.try_element_at(b, F.lit(1))) > 2), F.lit(False))


def link_profiles(profiles: DataFrame, tracker: DataFrame) -> DataFrame:
    """(pid, sid, confidence): at most one tracker row for each profile."""
    own = durable(candidate_edges(profiles, tracker))
    slim = durable(profiles.select("pid", "address", "box", "n", "core", _publishers("attrs")))
    rows = _broadcast(durable(tracker.select("sid", F.col("box").alias("ordered_to"), F.col("core").alias("name"), _publishers("attrs").alias("published_by"))))
    state = own.withColumnRenamed("own", "s")
    for done in itertools.count():
        # what each address knows for sure: only similarities above LEAST count, a full one as 1
        sure = F.greatest(F.lit(0.0), (F.col("s") - LEAST) / (1 - LEAST))
        known = state.filter(F.col("s") > LEAST).join(slim.select("pid", "address", "n"), "pid").groupBy("address", "sid").agg(F.sum(sure * F.col("n")).alias("mass"))
        total = slim.groupBy("address").agg(F.sum("n").alias("all"))
        known = durable(known.join(total, "address").select("address", "sid", (F.col("mass") / F.col("all")).alias("share")))
        beside = _join_lists(slim, known, "address").join(rows, "sid")
        fit = F.when(F.col("box") == F.col("ordered_to"), BOX_SAME).when((F.col("box") == "") | F.col("ordered_to").isNull() | ~F.contains("box", F.lit("+")), BOX_UNKNOWN).otherwise(BOX_OTHER)
        mine = W.Window.partitionBy("pid")
        beside = beside.filter(~_contradicts(F.col("core"), F.col("name"), F.arrays_overlap("publishers", "published_by"))).join(own, ["pid", "sid"], "left")
        beside = beside.withColumn("part", F.col("share") * fit * (NO_EVIDENCE + F.coalesce("own", F.lit(0.0))))
        beside = beside.withColumn("all_parts", F.sum("part").over(mine)).withColumn("certain", F.least(F.lit(1.0), F.sum("share").over(mine)))
        support = beside.select("pid", "sid", (F.sqrt("certain") * F.col("part") / F.col("all_parts") * HANDED_ON).alias("support"))
        both = own.join(support, ["pid", "sid"], "full_outer").select("pid", "sid", F.coalesce("own", F.lit(0.0)).alias("own"), F.coalesce("support", F.lit(0.0)).alias("support"))
        both = both.withColumn("s", F.col("own") + (1 - F.col("own")) * F.col("support")).select("pid", "sid", "s").join(state.withColumnRenamed("s", "was"), ["pid", "sid"], "left")
        was = F.coalesce("was", F.lit(0.0))
        state = durable(both.select("pid", "sid", F.greatest("s", was).alias("s") if done >= CALM_ROUNDS else "s", was.alias("was")))
        moved = state.select(F.max(F.abs(F.col("s") - F.col("was")))).first()[0] or 0.0
        state = state.drop("was")
        if moved < STABLE:
            break
    best = state.groupBy("pid").agg(F.max(F.struct("s", (-F.col("sid")).alias("minus"))).alias("b"))
    return best.select("pid", (-F.col("b.minus")).alias("sid"), F.col("b.s").alias("confidence")).filter(F.col("confidence") >= LEAST)


def link(messages: DataFrame, tracker: DataFrame, key: str = "msg_id") -> DataFrame:
    """(source_id, key, confidence) for each message that comes from a row of the tracker.

    messages has key, from_h, to_h and delivered_to, possibly several deliveries of a message; tracker has source_id,
    newsletter_name, publisher, signup_url and subscribe_email.
    """
    slim = messages.select(key, F.coalesce("from_h", F.lit("")).alias("from_h"), box_of(F.col("to_h"), F.col("delivered_to")).alias("box"))
    headers = durable(slim.groupBy("from_h", "box").agg(F.count(F.lit(1)).alias("n")))
    rows = tracker.withColumn("r", F.pandas_udf(_rows, ROW)("newsletter_name", "publisher", "signup_url"))
    rows = durable(_unpacked(rows.select(F.col("source_id").alias("sid"), F.lower(F.trim("subscribe_email")).alias("box"), "r.*")))
    described = durable(profiles_of(headers, known_attributes(rows)).withColumn("pid", F.xxhash64("address", "label", "box")))
    linked = link_profiles(durable(merged(described)), rows)
    by_header = durable(described.select("pid", "from_h", "box", "n").join(linked, "pid").select(F.xxhash64("from_h", "box").alias("header"), "n", "sid", "confidence"))
    total = by_header.agg(F.sum("n")).first()[0] or 0
    found = join_counted(slim.select(key, F.xxhash64("from_h", "box").alias("header")), by_header, "header", "n", total)
    return found.groupBy(key).agg(F.max(F.struct("confidence", (-F.col("sid")).alias("minus"))).alias("b")).select((-F.col("b.minus")).alias("source_id"), key, F.col("b.confidence").alias("confidence"))
