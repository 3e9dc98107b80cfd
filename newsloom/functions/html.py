"""Text from HTML: a fast form of built-in replacements, and a Markdown form that keeps structure, in Arrow batches."""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DROPPED = r"(?is)<(script|style|nav|footer)\b[^>]*>.*?</\1\s*>"
PIXEL = r"(?i)<img\b[^>]*(?:width|height)=[\"']?1(?:px)?[\"' >][^>]*>"
AD_BLOCK = r"(?is)<div[^>]*class=[\"'][^\"']*\b(?:ad|sponsor|promo)\b[^\"']*[\"'][^>]*>.*?</div>"


def plain_text(html: Column) -> Column:
    """Scripts, styles, navigation, footers, comments and tags removed, blanks collapsed; entities of the basic five decoded."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for tag in ("script", "style", "nav", "footer"):
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    out = F.trim(F.regexp_replace(F.regexp_replace(out, r"<[^>]+>", " "), r"\s+", " "))
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return out


def without_ads(html: Column) -> Column:
    return F.regexp_replace(html, AD_BLOCK, " ")


def without_pixels(html: Column) -> Column:
    return F.regexp_replace(html, PIXEL, "")


class _Markdown(HTMLParser):
    """Headings, paragraphs, lists, tables (also nested) and links; what scripts, styles and navigation hold is left out."""

    SKIP = {"script", "style", "nav", "footer", "head"}
    BLOCK = {"p", "div", "section", "article", "tr", "table", "ul", "ol", "blockquote", "br"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0
        self.links: list[str] = []
        self.lists: list[list] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in self.SKIP:
            self.skip += 1
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n")
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("\n" + "  " * (len(self.lists) - 1) + (f"{kind[1]}. " if kind[0] == "ol" else "- "))
        elif tag in ("td", "th"):
            self.out.append(" | ")
        elif tag == "a":
            self.links.append(dict(attrs).get("href") or "")
            self.out.append("[")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in self.BLOCK:
            self.out.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag == "a" and self.links:
            self.out.append(f"]({self.links.pop()})")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.out.append("\n")
        elif tag in self.BLOCK or tag[:1] == "h" and tag[1:].isdigit():
            self.out.append("\n")

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.out.append(" ".join(data.split()) if data.strip() else " " if data else "")


def markdown_of(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _Markdown()
    parser.feed(html)
    parser.close()
    lines = [" ".join(line.split()) if not line.lstrip().startswith(("-", "#")) else line.rstrip() for line in "".join(parser.out).split("\n")]
    text = "\n".join(lines)
    while "\n\n\n" in text:
        text = text.replace("\n\n\n", "\n\n")
    return text.strip()


def _markdown(html: pd.Series) -> pd.Series:
    return html.map(markdown_of)


def markdown(html: Column) -> Column:
    return F.pandas_udf(_markdown, T.StringType())(html)


def body_or_html(body: Column, html: Column) -> Column:
    """The text body, or text from HTML where the body is null or blank."""
    return F.coalesce(F.when(F.trim(body) != "", body), plain_text(html))


# ---- HTML from Markdown


def _inline(text: str) -> str:
    out = escape(text, quote=False)
    out = re.sub(r"\[([^\]]+)\]\((https?://[^)\s]+)\)", r'<a href="\2">\1</a>', out)
    out = re.sub(r"\*\*([^*]+)\*\*", r"<strong>\1</strong>", out)
    return re.sub(r"(?<!\*)\*([^*\n]+)\*(?!\*)", r"<em>\1</em>", re.sub(r"`([^`]+)`", r"<code>\1</code>", out))


def _cells(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def html_of(markdown: str | None, styles: dict[str, str] | None = None) -> str | None:
    """Headings, paragraphs, lists, tables, quotes, rules, fenced code and the inline forms; text is escaped. Null gives null.

    With styles (css by tag) every opening tag carries its own, as mail clients want it. Code that is not closed goes on to the
    end; a table needs a line of dashes below its head."""
    if markdown is None:
        return None
    out: list[str] = []
    inside = ""
    lines = [*markdown.replace("\r\n", "\n").split("\n"), ""]
    at = 0
    while at < len(lines):
        line = lines[at]
        at += 1
        item = re.match(r"\s*(?:([-*])|\d+\.)\s+(.*)", line)
        kind = "" if item is None else "ul" if item[1] else "ol"
        if inside and kind != inside:
            out.append(f"</{inside}>")
            inside = ""
        if line.startswith("```"):
            end = next((i for i in range(at, len(lines)) if lines[i].startswith("```")), len(lines))
            code = "\n".join(lines[at:end]).strip("\n")
            out.append(f"<pre><code>{escape(code, quote=False)}</code></pre>")
            at = end + 1
        elif line.lstrip().startswith("|") and at < len(lines) and re.fullmatch(r"\s*\|?[\s:|-]*-[\s:|-]*", lines[at]):
            rows = [f"<tr>{''.join(f'<th>{_inline(c)}</th>' for c in _cells(line))}</tr>"]
            at += 1
            while at < len(lines) and lines[at].lstrip().startswith("|"):
                rows.append(f"<tr>{''.join(f'<td>{_inline(c)}</td>' for c in _cells(lines[at]))}</tr>")
                at += 1
            out.append("<table>" + "".join(rows) + "</table>")
        elif re.fullmatch(r"\s*(?:(?:-\s*){3,}|(?:\*\s*){3,}|(?:_\s*){3,})", line):
            out.append("<hr>")
        elif item:
            if not inside:
                out.append(f"<{kind}>")
                inside = kind
            out.append(f"<li>{_inline(item[2])}</li>")
        elif head := re.match(r"(#{1,6})\s+(.*)", line):
            out.append(f"<h{len(head[1])}>{_inline(head[2])}</h{len(head[1])}>")
        elif quote := re.match(r">\s?(.*)", line):
            out.append(f"<blockquote>{_inline(quote[1])}</blockquote>")
        elif line.strip():
            out.append(f"<p>{_inline(line.strip())}</p>")
    html = "\n".join(out)
    for tag, css in (styles or {}).items():
        html = re.sub(rf"<{tag}(?=[ >])", f'<{tag} style="{escape(css)}"', html)
    return html


def from_markdown(text: Column, styles: dict[str, str] | None = None) -> Column:
    """HTML of a Markdown text, plain or, with styles, for mail."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: html_of(t, styles), na_action="ignore")

    return F.pandas_udf(run, T.StringType())(text)


def markdown_title(text: Column, default: str = "Report") -> Column:
    """The first heading of the first level, else the default; null for null."""
    return F.when(text.isNotNull(), F.coalesce(F.nullif(F.trim(F.regexp_extract(text, r"(?m)^# (.+)$", 1)), F.lit("")), F.lit(default)))
