"""Column functions: numbers, months, names, links and JSON out of messy text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"


def number(text: Column) -> Column:
    """A double from grouped digits ("29,52,542.05"); null for "", "-", "NA", "N/A" and other text."""
    clean = F.regexp_replace(F.trim(text), ",", "")
    return F.when(~clean.isin("", "-", "NA", "N/A"), clean.try_cast("double"))


def month_number(name: Column) -> Column:
    """1 to 12 from the first three letters of a month's name, else null."""
    at = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(name, 1, 3)))
    return F.when(at > 0, at.cast("int"))


def full_year(digits: Column) -> Column:
    """Four-digit year; two digits below 50 are of this century."""
    year = digits.try_cast("int")
    return F.when(F.length(digits) == 4, year).when(year < 50, 2000 + year).otherwise(1900 + year)


def month_from_text(text: Column) -> Column:
    """Month start from free text with a month's name and a year ("Sept-19", "as on March 31, May 2025"); four digits go before two."""
    out = []
    for year in (r"[\s,.'-]*(\d{4})(?!\d)", r"[\s.'-]*(\d{2})(?!\d)"):
        pattern = f"(?i){_MONTH}{year}"
        name = F.regexp_extract(text, pattern, 1)
        out.append(F.when(name != "", F.make_date(full_year(F.regexp_extract(text, pattern, 2)), month_number(name), F.lit(1))))
    return F.coalesce(*out)


def month_from_path(path: Column) -> Column:
    """Month start from a file name or URL: year and name ("2024-Aug"), name and year ("ATMAPRIL2026") or number and year ("ATM122025")."""
    a, b, c = rf"(?i)(\d{{4}})[-_]?{_MONTH}", rf"(?i){_MONTH}[-_]?(\d{{4}})", r"(?i)[a-z_-](0[1-9]|1[0-2])(20\d{2})(?!\d)"
    pick = lambda p, y, m: F.make_date(F.regexp_extract(path, p, y).try_cast("int"), m(F.regexp_extract(path, p, 3 - y)), F.lit(1))
    as_int = lambda x: x.try_cast("int")
    return F.when(path.rlike(a), pick(a, 1, month_number)).when(path.rlike(b), pick(b, 2, month_number)).when(path.rlike(c), pick(c, 2, as_int))


def fiscal_year(date: Column) -> Column:
    """Label of the year from April to March, "2025-26"."""
    y = F.year(F.add_months(date, -3))
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def stripped_name(name: Column) -> Column:
    """Upper-case name without company suffixes, repeated spaces and edge punctuation: the key for alias lookups."""
    up = F.regexp_replace(F.upper(F.trim(name)), r"\b(LIMITED|LTD|PVT|PRIVATE|CORPORATION|CORP|CO)\b\.?", " ")
    return F.regexp_replace(F.regexp_replace(up, r"\s+", " "), r"^[\s.,\-]+|[\s.,\-]+$", "")


def is_number_name(name: Column) -> Column:
    """Whether a name is the artefact of a numeric cell."""
    return name.rlike(r"^\d+\.?\d*$")


def plain_text(html: Column, limit: int = 8000) -> Column:
    """Tags out, white space to single spaces, at most `limit` characters (the feature's own cap)."""
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"\s+", " ")), 1, limit)


def content_hash(text: Column) -> Column:
    """16 hex digits of SHA-256; null for empty text."""
    return F.when(F.length(text) > 0, F.substring(F.sha2(text, 256), 1, 16))


def links(html: Column) -> Column:
    """Array of (href, text) of the page's links; those with empty text or href are left out."""
    pattern = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("text"))
    named = F.transform(pairs, lambda p: F.struct(p["href"].alias("href"), F.trim(F.regexp_replace(p["text"], "<[^>]+>", "")).alias("text")))
    return F.filter(named, lambda p: (p["href"] != "") & (p["text"] != ""))


def resolved(href: Column, page_url: Column) -> Column:
    """An absolute URL from an absolute, root-relative or page-relative one."""
    root = F.regexp_extract(page_url, r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(page_url, r"[?#].*$", ""), r"/[^/]*$", "/")
    return F.when(href.rlike("^https?://"), href).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(folder, href))


def about(found: Column, words: list[str]) -> Column:
    """Of an array of links those whose text or address holds one of the words, in any case."""
    pattern = "(?i)" + "|".join(re.escape(w) for w in words)
    return F.filter(found, lambda p: p["text"].rlike(pattern) | p["href"].rlike(pattern))


def titled(name: Column) -> Column:
    """Every letter that follows none in upper case, the others in lower case."""
    parts = F.regexp_extract_all(F.lower(F.trim(name)), F.lit("[a-z]+|[^a-z]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))), "")


SIGNAL = "signal_type string, bank_name string, title string, impact_direction string, impact_magnitude string, effective_date string, confidence double"


def signal_array(answer: Column, bank: Column, least: float = 0.5) -> Column:
    """Findings of a model's JSON answer, in or out of a code fence, one object or an array of them; those of too little confidence are left out.

    A finding without a bank gets that of the text; without a confidence it has none; text that is no JSON has no findings.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(answer), r"^```[^\n]*\n", ""), r"\s*```\s*$", "")
    listed = F.when(F.ltrim(bare).startswith("["), bare).otherwise(F.concat(F.lit("["), bare, F.lit("]")))
    found = F.coalesce(F.from_json(listed, f"array<struct<{', '.join(x.strip().replace(' ', ':', 1) for x in SIGNAL.split(','))}>>"), F.array().cast(f"array<struct<{', '.join(x.strip().replace(' ', ':', 1) for x in SIGNAL.split(','))}>>"))
    sure = F.filter(found, lambda s: F.coalesce(s["confidence"], F.lit(0.0)) >= least)
    return F.transform(sure, lambda s: s.withField("bank_name", F.coalesce(F.nullif(s["bank_name"], F.lit("")), bank)))


#: How many single units each unit holds.
UNITS = {"one": 1.0, "thousand": 1e3, "lakh": 1e5, "million": 1e6, "crore": 1e7, "billion": 1e9}


def converted(value: Column, unit: str, into: str) -> Column:
    """An amount in one unit as an amount in another; an unknown unit is an error."""
    return value * F.lit(UNITS[unit]) / F.lit(UNITS[into])


def signed_percent(value: Column, digits: int = 1) -> Column:
    """A percentage as text with its sign; what rounds to zero has none, null stays null."""
    x = F.round(value, digits)
    return F.when(x == 0, F.lit(f"{0:.{digits}f}%")).otherwise(F.when(x.isNotNull(), F.format_string(f"%+.{digits}f%%", x)))
