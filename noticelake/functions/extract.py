"""Values mined from free text: ordered patterns of which the first valid one counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import extract


def first_valid(text: Column, patterns: Sequence[str], convert: Callable[[Column], Column], valid: Callable[[Column], Column]) -> Column:
    """The converted first group of the first pattern whose value is valid; null if none is."""

    def one(pattern: str) -> Column:
        value = convert(extract(text, pattern))
        return F.when(valid(value), value)

    return F.coalesce(*(one(p) for p in patterns))


# Patterns of quantities by name, in order of trust. Case is ignored, also outside ASCII.
QUANTITY = {
    "up_to_N_trailer": r"(?iuU)(?:bis zu|up to|jusqu.{1,3}à|fino a)\s+([0-9.,]+)\s+(?:anhänger|trailer|remorque|rimorchi|przycze)",
    "N_trailer": r"(?iuU)([0-9.,]+)\s+(?:anhänger|trailer|remorque|semi-trailer|sattelanhänger|przycze|rimorchi|påhängsvogn)",
    "N_units": r"(?iuU)([0-9.,]+)\s*(?:stück|units?|pièces?|items?|stk\.?|pcs\.?|stuks?|szt\.?)",
    "quantity_field": r"(?iuU)(?:quantity|menge|quantité|cantidad|antal)\s*[:=]\s*([0-9.,]+)",
    "Nx_trailer": r"(?iuU)([0-9.,]+)\s*[xX×]\s+(?:anhänger|trailer|remorque)",
}


def grouped_int(text: Column) -> Column:
    """A whole number, its digits in threes between points or between commas, or plain; null for anything else."""
    return F.when(text.rlike(r"^[0-9]{1,3}(?:\.[0-9]{3})+$"), F.replace(text, F.lit("."), F.lit(""))).when(text.rlike(r"^[0-9]{1,3}(?:,[0-9]{3})+$"), F.replace(text, F.lit(","), F.lit(""))).otherwise(text).try_cast("int")


def detected_quantity(text: Column, least: int = 1, most: int = 100_000) -> Column:
    """``quantity, source``: of the first pattern whose first match is a number in range; null if none is."""

    def one(name: str, pattern: str) -> Column:
        n = grouped_int(extract(text, pattern))
        return F.when(n.between(least, most), F.struct(n.alias("quantity"), F.lit(name).alias("source")))

    return F.coalesce(*(one(name, pattern) for name, pattern in QUANTITY.items()))


def quantity(text: Column, least: int = 1, most: int = 100_000) -> Column:
    return detected_quantity(text, least, most)["quantity"]


def duration_in_months(n: Column, unit: Column) -> Column:
    """A length in days, weeks, months or years as months of 30 days; halves go to the even number, days and weeks make one month at least."""
    short = F.when(unit == "day", n / 30).when(unit == "week", n * 7 / 30)
    return F.coalesce(F.when(short.isNotNull(), F.greatest(F.lit(1.0), F.bround(short))), F.bround(F.when(unit == "month", n * F.lit(1.0)).when(unit == "year", n * F.lit(12.0)))).cast("int")


def months_of(text: Column) -> Column:
    """The first length in a text, as months."""
    pattern = r"(?i)([0-9]+(?:\.[0-9]+)?)\s*(month|year|week|day)s?"
    return duration_in_months(F.regexp_extract(text, pattern, 1).try_cast("double"), F.lower(F.regexp_extract(text, pattern, 2)))


def amount(text: Column, style: str = "auto") -> Column:
    """A number with locale separators as a double; null where it is none.

    ``dot_thousands``: 1.234,5; ``space_thousands``: 1 234,5; ``auto``: of two
    kinds of separators the one that comes last is the decimal mark. Commas alone
    are a decimal mark if there is one with at most two digits after it, else
    thousands. Dots alone are thousands if there are several with three digits
    after each, else a decimal mark.
    """
    t = F.regexp_replace(F.trim(text), r"[ \u00A0\u202F]", "")
    if style == "dot_thousands":
        return F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    if style == "space_thousands":
        return F.replace(t, F.lit(","), F.lit(".")).try_cast("double")
    if style != "auto":
        raise ValueError(f"no such style: {style}")
    no_commas, no_dots = F.replace(t, F.lit(","), F.lit("")), F.replace(t, F.lit("."), F.lit(""))
    commas, dots = t.contains(","), t.contains(".")
    number = (
        F.when(commas & dots & t.rlike(r",[^.]*$"), F.replace(no_dots, F.lit(","), F.lit(".")))
        .when(commas & dots, no_commas)
        .when(commas & t.rlike(r"^[^,]*,[^,]{0,2}$"), F.replace(t, F.lit(","), F.lit(".")))
        .when(commas, no_commas)
        .when(t.rlike(r"^[^.]*(?:\.[^.]{3}){2,}$"), no_dots)
        .otherwise(t)
    )
    return F.when(number.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"), number).try_cast("double")


def short_amount(n: Column) -> Column:
    """932, 4.9K, 2.5M: one decimal above a thousand."""
    return F.when(n >= 1e6, F.format_string("%.1fM", n / 1e6)).when(n >= 1e3, F.format_string("%.1fK", n / 1e3)).otherwise(F.format_string("%.0f", n))
