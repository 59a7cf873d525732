"""Column functions on text: cleaning, keys, tokens, dates, ids, URLs.

Patterns avoid look-around and Unicode-dependent classes where a query is
compared with SQL. An unmatched extraction is null, never "".
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonempty(c: Column) -> Column:
    """Null for a blank text."""
    return F.nullif(F.trim(c), F.lit(""))


def coalesce_nonempty(*columns: Column) -> Column:
    """The first text that is not blank, trimmed."""
    return F.coalesce(*(nonempty(c) for c in columns))


def coalesce_positive(*columns: Column, least: float = 0.01) -> Column:
    """The first number above ``least``; values up to it count as missing."""
    return F.coalesce(*(F.when(c > least, c) for c in columns))


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def searchable(*columns: Column) -> Column:
    """Lower-cased texts joined by blanks; nulls are left out."""
    return F.lower(F.concat_ws(" ", *columns))


def any_term(text: Column, terms: Sequence[str]) -> Column:
    """Whether one of the terms is a substring; false for no terms and for null."""
    return F.coalesce(reduce(lambda a, t: a | text.contains(t), terms, F.lit(False)), F.lit(False))


def count_terms(text: Column, terms: Sequence[str]) -> Column:
    """How many different terms are substrings."""
    return reduce(lambda a, t: a + F.coalesce(text.contains(t), F.lit(False)).cast("int"), dict.fromkeys(terms), F.lit(0))


def first_term(text: Column, terms: Sequence[str]) -> Column:
    """The first of the terms, in their order, that is a substring."""
    return F.coalesce(*(F.when(text.contains(t), F.lit(t)) for t in terms))


def sentence_count(text: Column, least_length: int = 10) -> Column:
    """Parts between ``.!?`` longer than ``least_length``; points between digits don't end one."""
    guarded = F.regexp_replace(text, r"([0-9])\.([0-9])", "$1_$2")
    return F.size(F.filter(F.split(guarded, r"[.!?]+"), lambda p: F.length(F.trim(p)) > least_length))


def first_line(text: Column) -> Column:
    return F.split_part(text, F.lit("\n"), F.lit(1))


def clean_iso_date(text: Column) -> Column:
    """``yyyy-mm-dd`` of a date or time that may repeat by line or carry a zone; null for other shapes."""
    return extract(F.trim(first_line(text)), r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[T+Z ].*)?$")


def _plain_number(text: Column) -> Column:
    """A number without its commas and blanks; null where anything else is in it."""
    bare = F.regexp_replace(F.translate(text, ", ", ""), r"(?U)^\s+|\s+$", "")
    return F.when(bare.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"), bare).try_cast("double")


def clean_number(text: Column, least: float = 0.01) -> Column:
    """A number with commas or blanks as thousands; null for other texts and for placeholders up to ``least``."""
    n = _plain_number(text)
    return F.when(n > least, n)


def clean_int(text: Column) -> Column:
    """The whole part of such a number, of whatever size."""
    return _plain_number(text).cast("long")


def tokens(text: Column, least: int = 3) -> Column:
    """Distinct lower-cased words of letters, digits and ``_`` with at least ``least`` characters, in order."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"[\p{{L}}\p{{N}}_]{{{least},}}"), F.lit(0)))


def tokens_without(text: Column, stop_words: Sequence[str], least: int = 3) -> Column:
    return F.array_except(tokens(text, least), F.array(*(F.lit(w) for w in stop_words)))


def normalised_name(text: Column) -> Column:
    """A buyer's name for comparison: lower-cased, single blanks; letters of all scripts stay."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def code_prefixes(codes: Column, n: int) -> Column:
    return F.array_distinct(F.transform(codes, lambda c: F.substring(c, 1, n)))


def dedup_key(*parts: tuple[Column, int]) -> Column:
    """Lower-cased leading characters of each part, joined by ``|``."""
    return F.concat_ws("|", *(F.lower(F.left(F.coalesce(c.cast("string"), F.lit("")), F.lit(n))) for c, n in parts))


def cache_key(text: Column, digits: int = 40) -> Column:
    return F.left(F.sha1(text), F.lit(digits))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\r\n\f\x0B]+", " "))


def truncate(text: Column, n: int) -> Column:
    return F.left(text, F.lit(n))


def strip_html(html: Column) -> Column:
    """Text of a page by patterns: scripts, styles and tags go, common entities are put in, blanks collapse."""
    out = F.regexp_replace(html, r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return collapse_space(out)


def normalised_url(url: Column) -> Column:
    """A URL with a scheme; null for blanks."""
    u = nonempty(url)
    return F.when(u.rlike("^https?://"), u).when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.isNotNull(), F.concat(F.lit("https://"), u))


def url_host(url: Column) -> Column:
    return F.lower(extract(normalised_url(url), r"^https?://([^/?#:]+)"))


def url_format(url: Column) -> Column:
    """pdf, docx, xml or html by the path's ending; html where it has none of them."""
    return F.coalesce(F.lower(extract(url, r"(?i)\.(pdf|docx|xml|html)(?:[?#].*)?$")), F.lit("html"))


def url_health(code: Column, body: Column, missing_words: Sequence[str]) -> Column:
    """ok, soft_404, redirect, gone, blocked, error or unknown, from an HTTP status and a body."""
    return F.when(code.isNull(), "unknown").when(code.between(200, 299), F.when(any_term(F.lower(body), missing_words), "soft_404").otherwise("ok")).when(code.between(300, 399), "redirect").when(code.isin(404, 410), "gone").when(code.isin(401, 403, 429), "blocked").otherwise("error")


def likely_english(text: Column, stop_words: Sequence[str], least_ascii: float = 0.9) -> Column:
    """Mostly ASCII, and one of the stop words among its tokens; false for empty texts."""
    n = F.length(text)
    ascii_part = F.length(F.regexp_replace(text, r"[^\x00-\x7F]", "")) / F.nullif(n, F.lit(0))
    return F.coalesce((ascii_part >= least_ascii) & F.arrays_overlap(tokens(text, 2), F.array(*(F.lit(w) for w in stop_words))), F.lit(False))


def formatted_id(raw: Column, prefix: Column) -> Column:
    """``PP-…`` with the prefix once; ids of digits and a year, and blanks, stay as they are."""
    doubled, once = F.concat(prefix, F.lit("-"), prefix, F.lit("-")), F.concat(prefix, F.lit("-"))
    return F.when(raw.isNull() | (F.trim(raw) == "") | raw.rlike("^[0-9]+-[0-9]{4}$"), raw).when(raw.startswith(doubled), F.right(raw, F.length(raw) - F.length(once))).when(raw.startswith(once), raw).otherwise(F.concat(once, raw))


def without_prefix(title: Column, pattern: str, least: int = 8) -> Column:
    """The title without a leading pattern, unless less than ``least`` characters would be left."""
    short = F.trim(F.regexp_replace(title, pattern, ""))
    return F.when(F.length(short) >= least, short).otherwise(title)


def distinct_lines(text: Column, separator: str = " / ") -> Column:
    """The non-blank lines, each once, in order."""
    return F.array_join(F.array_distinct(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")), separator)


def short_name(text: Column, separators: Sequence[str] = (" - ", " | ", ","), most: int = 80) -> Column:
    """The part before the first separator, cut to ``most`` characters at the last blank before that."""
    out = collapse_space(text)
    for s in separators:
        out = F.split_part(out, F.lit(s), F.lit(1))
    cut = F.left(out, F.lit(most))
    return F.trim(F.when(F.length(out) > most, F.regexp_replace(cut, r" [^ ]*$", "")).otherwise(out))


def repaired_json(text: Column) -> Column:
    """JSON text without code fences and trailing commas."""
    out = F.regexp_replace(F.trim(text), r"^```(?:json)?\s*|\s*```$", "")
    return F.regexp_replace(out, r",\s*([}\]])", "$1")


def language_pick(texts: Column, languages: Sequence[str] = ("eng", "en", "fra", "fr", "deu", "de")) -> Column:
    """From a map of texts: the first preferred language that has one, then any."""
    values = F.filter(F.map_values(texts), lambda v: nonempty(v).isNotNull())
    return F.coalesce(*(nonempty(F.try_element_at(texts, F.lit(k))) for k in languages), F.try_element_at(values, F.lit(1)))
