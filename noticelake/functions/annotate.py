"""Amounts in texts with their value in euros beside them; texts of JSON and of element trees, over Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Mapping
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .extract import amount

# Currencies that are looked for in texts, in any case.
CURRENCIES = ("CZK", "PLN", "UAH", "NOK", "SEK", "DKK", "HUF", "RON", "BGN", "GBP", "CHF", "TRY", "USD", "JPY", "CNY")
# A number, its thousands in threes, before a currency; neither may go on as a word.
_NUMBER = r"[0-9]{1,3}(?:[,.\s\u00A0][0-9]{3})*(?:[,.][0-9]{1,4})?"
AMOUNT = rf"(?iU)(?<!\w){_NUMBER}\s*(?:{'|'.join(CURRENCIES)})(?![A-Za-z])"


def _to_tenth(x: Column) -> Column:
    """A number from 1 on to its nearest tenth, by the double's exact value: 12.35 lies below its tie. Ties go to the even digit."""
    parts = ((x - F.floor(x)) * 2**52).cast("long") * 10  # no such double has a finer part
    down = F.shiftright(parts, 52)
    rest = parts - F.shiftleft(down, 52)
    up = (rest > 2**51) | ((rest == 2**51) & (down % 2 == 1))
    return (F.floor(x) * 10 + down + up.cast("int")) / 10


def short(n: Column) -> Column:
    """932, 4.9K, 2.5M; rounded by the exact value, halves to the even digit."""
    return F.when(n >= 1e6, F.format_string("%.1fM", _to_tenth(n / 1e6))).when(n >= 1e3, F.format_string("%.1fK", _to_tenth(n / 1e3))).otherwise(F.format_string("%.0f", F.bround(n)))


def annotate_amounts(text: Column, rates: Mapping[str, float], least: float = 1.0, most: float = 1e10) -> Column:
    """The text with `` (~€…)`` after each amount in a currency of ``rates``; one that is followed by such a note stays as it is.

    What stands between the amounts alternates with them, so the text is put
    together again from both. Amounts outside ``least`` to ``most`` euros stay.
    """
    between = F.split(text, AMOUNT, -1)
    found = F.regexp_extract_all(text, F.lit(AMOUNT), F.lit(0))
    known = F.create_map(*(F.lit(x) for k, v in rates.items() if v > 0 for x in (k, float(v))))

    def noted(match: Column, at: Column) -> Column:
        after = F.ltrim(F.left(F.get(between, at + 1), F.lit(5)))
        euros = amount(F.regexp_extract(match, rf"(?U)^{_NUMBER}", 0)) * F.try_element_at(known, F.upper(F.right(match, F.lit(3))))
        told = lambda e: F.when(~after.startswith("(~€") & e.between(least, most), F.concat(match, F.lit(" (~€"), short(e), F.lit(")"))).otherwise(match)
        return F.transform(F.array(euros), told)[0]  # as a lambda's variable the euros are computed once

    pairs = F.zip_with(between, F.transform(found, noted), lambda b, m: F.concat(b, F.coalesce(m, F.lit(""))))
    return F.when(text.rlike(AMOUNT), F.array_join(pairs, "")).otherwise(text)


def _leaves(value, depth: int) -> list[str]:
    if depth < 0 or value is None or isinstance(value, bool):
        return []
    if isinstance(value, dict):
        return [x for v in value.values() for x in _leaves(v, depth - 1)]
    if isinstance(value, list):
        return [x for v in value for x in _leaves(v, depth - 1)]
    return [str(value)]


def deep_text(data: Column, depth: int = 5) -> Column:
    """All values of a JSON text down to a depth, joined by blanks; null for broken JSON."""

    @pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return " ".join(_leaves(json.loads(t), depth)) if t is not None else None
            except ValueError:
                return None

        return texts.map(one)

    return run(data)


class _Text(HTMLParser):
    # Elements whose text is no content.
    SKIP = {"script", "style", "nav", "header", "footer", "aside", "form", "button", "noscript"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.inside = [], []

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.inside.append(tag)

    def handle_endtag(self, tag):
        if tag in self.inside:
            while self.inside.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.inside:
            self.out.append(data)


def page_text(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    return " ".join(" ".join(parser.out).split())


def dom_text(html: Column) -> Column:
    """Text of a page without navigation, forms and scripts, by the element tree."""

    @pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(page_text)

    return run(html)
