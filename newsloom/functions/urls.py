"""Column functions over links. The engine never requests one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(c: Column) -> Column:
    """The host in lower case without `www.`; null if there is none."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), r"^www\.", ""), F.lit(""))


def canonical(c: Column) -> Column:
    """No fragment, no `utm_` or click parameters, other parameters sorted, no slash at the end, scheme and host in lower case."""
    bare = F.regexp_replace(F.trim(c), "#.*$", "")
    head = F.regexp_replace(F.element_at(F.split(bare, r"\?", 2), 1), "/+$", "")
    start = F.regexp_extract(head, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    query = F.coalesce(F.try_element_at(F.split(bare, r"\?", 2), F.lit(2)), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(?:utm_[^=]*|gclid|fbclid|mc_cid|mc_eid)(?:=|$)")))
    path = F.substring(head, F.length(start) + 1, F.length(head))
    return F.concat(F.lower(start), path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def unwrapped(c: Column) -> Column:
    """The target that a redirect carries in itself, decoded; null if it carries none."""
    return F.nullif(F.try_url_decode(F.regexp_extract(c, r"[?&](?:url|u|q|target)=(https?(?:%3A|:)[^&#]+)", 1)), F.lit(""))


def is_tracking(c: Column, wrappers: list[str]) -> Column:
    """A link of a known wrapper whose target is not embedded."""
    return F.coalesce(host(c).isin(wrappers) & unwrapped(c).isNull(), F.lit(False))


def links(c: Column) -> Column:
    """All http links of a plain text, without the punctuation after them."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(https?://[^\s<>\"]+)"), F.lit(1)), lambda u: F.regexp_replace(u, r"[.,;:!?)\]]+$", ""))


def anchors(html: Column) -> Column:
    """Links of a page as (href, anchor)."""
    pattern = r'<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
    return F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("anchor"))


def video_url(c: Column) -> Column:
    return F.when(c.rlike("^https?://"), c).otherwise(F.concat(F.lit("https://www.youtube.com/watch?v="), c))


def channel_url(c: Column) -> Column:
    return F.when(c.rlike("^https?://"), c).when(F.startswith(c, F.lit("@")), F.concat(F.lit("https://www.youtube.com/"), c)).when(F.startswith(c, F.lit("UC")), F.concat(F.lit("https://www.youtube.com/channel/"), c)).otherwise(F.concat(F.lit("https://www.youtube.com/@"), c))
