"""Status, value, country and label resolution through ordered fallbacks.

Variants that disagree stay apart under names of their own. The current day is a parameter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import first_line


def status_for_ui(winner: Column, kind: Column, trusted: Column, deadline: Column, published: Column, today: Column) -> Column:
    """Open, Closed, Awarded or Cancelled: winner, then type words, a trusted status, the deadline, the age."""
    age, k = F.datediff(today, published), F.lower(kind)
    has = lambda *words: F.coalesce(F.greatest(*(k.contains(w) for w in words)) if len(words) > 1 else k.contains(words[0]), F.lit(False))
    open_kind = has("open", "cn")
    return (
        F.when(winner.isNotNull() & (winner != ""), "Awarded")
        .when(has("cancel", "withdraw"), "Cancelled")
        .when(has("modification", "corrigendum"), "Closed")
        .when(has("award", "result"), "Awarded")
        .when(open_kind & deadline.isNotNull(), F.when(deadline > today, "Open").otherwise("Closed"))
        .when(open_kind & (age <= 180), "Open")
        .when(trusted.isin("Open", "Closed", "Awarded", "Cancelled"), trusted)
        .when(deadline > today, "Open")
        .when(deadline.isNull() & (age < 90), "Open")
        .otherwise("Closed")
    )


def status_for_sheet(winner: Column, deadline: Column, published: Column, record_year: Column, today: Column) -> Column:
    """The sheet's rules: Unknown exists, a deadline of today is open, an age of up to 179 days too."""
    age = F.datediff(today, published)
    return (
        F.when(winner.isNotNull() & (winner != ""), "Awarded")
        .when(deadline.isNotNull(), F.when(deadline >= today, "Open").otherwise("Closed"))
        .when(age.between(0, 179), "Open")
        .when(age.isNotNull(), "Closed")
        .when(record_year.isNotNull(), F.when(record_year >= F.year(today), "Open").otherwise("Closed"))
        .otherwise("Unknown")
    )


def vendor_status(raw: Column, names: Mapping[str, str], default: str = "") -> Column:
    """A vendor's status by a small table, by lower-cased name."""
    out, low = None, F.lower(F.trim(raw))
    for k, v in names.items():
        out = F.when(low == k.lower(), v) if out is None else out.when(low == k.lower(), v)
    return F.lit(default) if out is None else out.otherwise(default)


def rate(currency: Column, rates: Mapping[str, float]) -> Column:
    table = F.create_map(*(F.lit(x) for kv in rates.items() for x in kv))
    return F.try_element_at(table, F.upper(F.trim(currency)))


def eur_for_ui(known: Column, paths: list[tuple[Column, Column]], rates: Mapping[str, float], least: float = 0.01) -> Column:
    """The known amount, else the first path with a known currency; 0 where none has. Two decimals."""
    tries = [F.when(known > least, known)] + [F.when(a > least, a * rate(c, rates)) for a, c in paths]
    return F.round(F.coalesce(*tries, F.lit(0.0)), 2)


def eur_for_filter(paths: list[tuple[Column, Column]], rates: Mapping[str, float]) -> Column:
    """The first positive amount; an unknown currency leaves it unchanged; null where there is none."""
    return F.coalesce(*(F.when(a > 0, a * F.coalesce(rate(c, rates), F.lit(1.0))) for a, c in paths))


def eur_for_sheet(amount: Column, currency: Column, rates: Mapping[str, float]) -> Column:
    """Whole euros; null for an unknown currency."""
    return F.round(amount * rate(currency, rates)).cast("long")


def country(alias_of: Mapping[str, str], *fallbacks: Column, default: str | None = None) -> Column:
    """The first fallback that the alias table knows, as written, in capitals or in title case."""
    table = F.create_map(*(F.lit(x) for kv in alias_of.items() for x in kv))
    tries = []
    for f in fallbacks:
        name = F.trim(first_line(f))
        tries += [F.try_element_at(table, name), F.try_element_at(table, F.upper(name)), F.try_element_at(table, F.initcap(name))]
    return F.coalesce(*tries, F.lit(default))


def source_label(source: Column, record_id: Column, labels: Mapping[str, str]) -> Column:
    """A label by source, else by the id's two letters, else ``TED`` for a number and year."""
    table = F.create_map(*(F.lit(x) for kv in labels.items() for x in kv))
    return F.coalesce(F.try_element_at(table, source), F.try_element_at(table, F.left(record_id, F.lit(2))), F.when(record_id.rlike("^[0-9]+-[0-9]{4}$"), "TED"), F.lit("other"))


def publication_date(awarded: Column, own: Column, own_is_fallback: Column, cross: Column) -> Column:
    """The cross-referenced date, else the own one, which is dropped where it is a stand-in on an awarded row."""
    return F.coalesce(cross, F.when(~(awarded & own_is_fallback), own))


def numbered_lots(values: Column, names: Column) -> Column:
    """Parallel arrays as lots ``LOT-0001`` and so on; the longer one tells their number."""
    return F.transform(F.arrays_zip(values.alias("value"), names.alias("name")), lambda x, i: F.struct(F.format_string("LOT-%04d", i + 1).alias("lot"), x["value"].alias("value"), x["name"].alias("name")))


def vehicle_slots(slots: list[tuple[Column, Column]], mined: Column) -> Column:
    """Slots up to the first empty one; the first takes the mined quantity if it has none."""
    out, before = [], F.lit(True)
    for k, (kind, n) in enumerate(slots):
        before = before & kind.isNotNull() & (kind != "")
        out.append(F.when(before, F.struct(kind.alias("type"), (F.coalesce(n, mined) if k == 0 else n).alias("quantity"))))
    return F.array_compact(F.array(*out))


def first_positive_amount(top: Column, lots: Column, step: Column) -> Column:
    """The top amount, else the first positive one of the lots, else the minimal step."""
    return F.coalesce(F.when(top > 0, top), F.try_element_at(F.filter(lots, lambda x: x > 0), F.lit(1)), F.when(step > 0, step))
