"""Quantities, delivery dates, durations and kinds of contracts named in a notice's text.

Each miner tries ordered patterns. Of each pattern only the first match in the
text counts, and the first pattern whose match is valid gives the value, with
its name, the match and the text around it. No pattern matches an empty text. Null and empty texts give null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import lru_cache, reduce
from operator import or_
from re import _constants as C
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

AROUND = 60

# Quantities by name, in order of trust; group 1 is the number. Case is ignored, also outside ASCII.
QUANTITY = {
    "qty_en_inline": r"\b(?:Qty\.?|QTY)\s*[:=]?\s*([0-9]{1,5})\b",
    "quantity_en_inline": r"\bQuantity\s*[:=]\s*([0-9]{1,5})\b",
    "quantity_en_of": r"\bquantity\s+of\s+([0-9]{1,5})\b",
    "qty_en_units": r"\b([0-9]{1,5})\s+(?:units?|pieces?|pcs?|items?)\b",
    "qty_en_trailers": r"\b([0-9]{1,5})\s+(?:trailers?|semi[- ]?trailers?|dollies|tankers?|kitchens?|shelters?|remorques?|Anhänger|naczep[ay])\b",
    "qty_en_lowbed": r"\b(?:procure|supply|deliver(?:y of)?|provision of)\s+(?:Qty\.?\s*)?([0-9]{1,5})\s+(?:Lowbed|Low[- ]bed|Cargo|Tank|Ammunition|Mobile Kitchen|Field)",
    "qty_en_total": r"\btotal\s+(?:of\s+)?([0-9]{1,5})\s+(?:units?|trailers?|pieces?)\b",
    "qty_de_stueck": r"\b([0-9]{1,5})\s+Stück\b",
    "qty_de_anzahl": r"\bAnzahl\s*[:=]?\s*([0-9]{1,5})\b",
    "qty_de_menge": r"\bMenge\s*[:=]?\s*([0-9]{1,5})\b",
    "qty_fr_quantite": r"\bquantité\s*[:=]?\s*([0-9]{1,5})\b",
    "qty_fr_nombre": r"\bnombre\s+de\s+([0-9]{1,5})\b",
    "qty_pl_ilosc": r"\bilość\s*[:=]?\s*([0-9]{1,5})\b",
    "qty_pl_szt": r"\b([0-9]{1,5})\s+szt\.?\b",
    "qty_pl_sztuk": r"\b([0-9]{1,5})\s+sztuk\b",
    "qty_cz_pocet": r"\bpočet\s*(?:ks\.?)?\s*[:=]?\s*([0-9]{1,5})\b",
    "qty_cz_kusy": r"\b([0-9]{1,5})\s+(?:ks\.?|kusů|kusy)\b",
    "qty_it_quantita": r"\bquantità\s*[:=]?\s*([0-9]{1,5})\b",
    "qty_es_cantidad": r"\bcantidad\s*[:=]?\s*([0-9]{1,5})\b",
    "qty_es_unidades": r"\b([0-9]{1,5})\s+unidades\b",
    "qty_ua_kilkist": r"кількість\s*[:=]?\s*([0-9]{1,5})",
    "qty_ua_shtuk": r"([0-9]{1,5})\s+шт(?:ук)?\.?",
    "qty_sv_antal": r"\bantal\s*[:=]?\s*([0-9]{1,5})\b",
    "qty_sv_stk": r"\b([0-9]{1,5})\s+stk\.?\b",
    "qty_nl_aantal": r"\baantal\s*[:=]?\s*([0-9]{1,5})\b",
}
# Words around a number that make it an identifier.
IDENTIFIER_NEAR = r"(?:file\s+number\s*[:=]?\s*\S*[0-9]|nsn\s*[:=][^.]*?[0-9]|reference\s+(?:no|number)\s*[:=]?\s*\S*[0-9]|contract\s+(?:no|number)\s*[:=]?\s*\S*[0-9]|page\s+[0-9]|seite\s+[0-9])"
# Dates by name, with the groups of year, month and day.
DATES = {
    "dl_en_by_monthname": (r"\b(?:by|until|before|no\s+later\s+than|on\s+or\s+before|delivery\s+(?:by|date|date\s+of|date\s+is)|delivery\s+is\s+requested\s+(?:at[^.]*?)\s*by)\s+([A-Za-z]{3,9})\s+([0-9]{1,2}),?\s+([0-9]{4})\b", (3, 1, 2)),
    "dl_en_by_dashdate": (r"\b(?:by|until|before|delivery\s+by)\s+([0-9]{1,2})-([A-Za-z]{3})-([0-9]{4})\b", (3, 2, 1)),
    "dl_en_by_slashdate_dmy": (r"\b(?:by|until|before|delivery\s+by)\s+([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\b", (3, 2, 1)),
    "dl_de_bis": (r"\b(?:Lieferung|delivery)\s+(?:bis|until)\s+([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})\b", (3, 2, 1)),
    "dl_de_bis_zum_dotted": (r"\bbis\s+(?:zum\s+)?([0-9]{1,2})\.\s*([A-Za-zäöüÄÖÜ]+)\s+([0-9]{4})\b", (3, 2, 1)),
    "dl_iso_by": (r"\b(?:by|until|before|delivery\s+by|deadline)\s+([0-9]{4})-([0-9]{2})-([0-9]{2})\b", (1, 2, 3)),
}
# Names of months.
MONTHS = {
    "january": 1, "jan": 1, "januar": 1, "february": 2, "februar": 2, "feb": 2, "march": 3, "mar": 3, "märz": 3, "marz": 3,
    "april": 4, "apr": 4, "may": 5, "mai": 5, "june": 6, "jun": 6, "juni": 6, "july": 7, "jul": 7, "juli": 7,
    "august": 8, "aug": 8, "september": 9, "sep": 9, "sept": 9, "october": 10, "oct": 10, "oktober": 10,
    "november": 11, "nov": 11, "december": 12, "dec": 12, "dez": 12, "dezember": 12,
}
# Offsets from the award by name, with the days of their unit.
OFFSETS = {
    "dl_en_days_after_award": (r"\b([0-9]{1,4})\s+days?\s+(?:after|from|of|following)\s+(?:the\s+)?(?:contract\s+award|award\s+of\s+the\s+contract|signing|award)\b", 1),
    "dl_en_within_days_award": (r"\bwithin\s+([0-9]{1,4})\s+days?\s+(?:of|after|from|following)\s+(?:the\s+)?award\b", 1),
    "dl_en_months_after_award": (r"\b([0-9]{1,3})\s+(?:months?|m)\s+(?:after|from|following)\s+(?:contract\s+award|signing|award)\b", 30),
    "dl_en_delivery_days": (r"\bdelivery\s+(?:is\s+)?(?:requested|required|expected)\s+(?:within\s+)?([0-9]{1,4})\s+days?\b", 1),
    "dl_de_tage_nach": (r"\b([0-9]{1,4})\s+Tage\s+nach\s+(?:Zuschlag|Vertragsschluss|Auftragserteilung)\b", 1),
    "dl_de_monate_nach": (r"\b([0-9]{1,3})\s+Monate\s+nach\s+(?:Zuschlag|Vertragsschluss|Auftragserteilung)\b", 30),
    "dl_fr_jours_apres": (r"\b([0-9]{1,4})\s+jours?\s+(?:à\s+compter\s+de|après)\s+(?:la\s+notification|l'attribution|signature\s+du\s+contrat)\b", 1),
}
# Durations by name, with the months that each group counts.
DURATIONS = {
    "dur_en_months": (r"\bcontract\s+duration\s*[:=]?\s*([0-9]{1,3})\s+months?\b", (1,)),
    "dur_en_period_months": (r"\b(?:period|term)\s+of\s+([0-9]{1,3})\s+months?\b", (1,)),
    "dur_en_years_months": (r"\b([0-9]{1,2})\s+years?\s+(?:and\s+)?([0-9]{1,2})\s+months?\s+contract\b", (12, 1)),
    "dur_de_monate": (r"\bVertragsdauer\s*[:=]?\s*([0-9]{1,3})\s+Monate\b", (1,)),
    "dur_fr_mois": (r"\bdurée\s+(?:du\s+marché|contractuelle)\s*[:=]?\s*([0-9]{1,3})\s+mois\b", (1,)),
}
# Words of the kinds of contracts, the first that occurs counts; of extensions; of lengths.
KINDS = {
    "framework_agreement": r"\b(?:framework[\s-]?agreement|framework[\s-]?contract|rahmenvertrag|rahmenvereinbarung|accord[\s-]cadre|umowa[\s-]ramowa|rámcová[\s-]smlouva|rámcová[\s-]dohoda|ramavtal|rammeaftale|rammeavtale|raamovereenkomst|accordo[\s-]quadro|acuerdo[\s-]marco|contrat[\s-]cadre|dynami[cč]k[ýé][\s-]nákupní[\s-]systém|dynamic[\s-]purchasing[\s-]system|kader[\s-]overeenkomst)\b",
    "recurring": r"\b(?:recurring|periodic|repeat|standing[\s-]offer|indefinite[\s-]delivery|monthly|quarterly|annual(?:ly)?|jährlich|annuel(?:lement)?|transport[\s-]service|logistics[\s-]service|forwarding[\s-]service|freight[\s-]forwarding|spedition(?:sdienst)?|maintenance[\s-]service|service[\s-]contract|dienstleistung)\b",
}
FRAMEWORK_CODES = ("fa-wo-rc", "fa-w-rc", "fa-mix")
EXTENSION = r"\b(?:option|extension|renewal|verlängerung|prorogation|extend|renew|optional[\s-]period)\b"
LENGTH_IN_MONTHS = r"([0-9]+(?:\.[0-9]+)?)\s*(month|months|monate?|mois|месяц|måneder?|månader?|mesi|meses|měsíc[ůi]?)"
LENGTH_IN_YEARS = r"([0-9]+(?:\.[0-9]+)?)\s*(year|years|jahre?|ans?|rok[ůi]?|år|anni?)"
LENGTH_UNITS_WITHOUT_VALUE = ("месяц", "månede", "månade")

_FLAGS = "(?iuU)"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once. As a lambda it also stays out of generated methods, which may not grow as dozens of patterns would make them."""
    return F.transform(F.array(value), then)[0]


@lru_cache(None)
def needed_words(pattern: str) -> tuple[str, ...]:
    """Lower-cased parts of which every match of a pattern holds one; empty where there are none."""

    def better(a: set[str], b: set[str]) -> set[str]:
        return max(a, b, key=lambda words: min(map(len, words), default=0))

    def of(items) -> set[str]:
        best, run = set(), ""
        for op, arg in [*items, (None, None)]:
            if op is C.LITERAL:
                run += chr(arg)
                continue
            best, run = better(best, {run} - {""}), ""
            if op is C.SUBPATTERN:
                best = better(best, of(arg[-1]))
            elif op is C.BRANCH:
                each = [of(x) for x in arg[1]]
                best = better(best, set().union(*each) if all(each) else set())
            elif op is C.MAX_REPEAT and arg[0] > 0:
                best = better(best, of(arg[2]))
        return best

    return tuple(sorted(w.lower() for w in of(_parser.parse(pattern))))


def _folded(text: Column) -> Column:
    """The text so that whatever a letter matches in any case is that letter in lower case."""
    return F.lower(F.translate(text, "İıſᲂᲃᲄᲅ", "iisостт"))  # letters whose lower case alone does not tell it


def _both(text: Column) -> Column:
    return F.struct(text.alias("text"), _folded(text).alias("low"))


def _mined(both: Column, name: str, pattern: str, value: Callable[[Callable[[int], Column]], Column], guard: str | None = None) -> Column:
    """``value, pattern, match, fragment`` of the first match; null where it has no value or the guard is near.

    A text without the words that the pattern needs isn't searched: nearly all are without.
    """
    full, text = _FLAGS + pattern, both["text"]
    may = reduce(or_, (both["low"].contains(w) for w in needed_words(pattern)), F.lit(not needed_words(pattern)))

    def around(match: Column) -> Column:
        before = F.regexp_extract(text, rf"{_FLAGS}\A((?s:.*?))(?:{pattern})", 1)  # as little as may stand before a match: the first one
        sides = lambda x: F.concat(F.right(x, F.lit(AROUND)), match, F.substring(text, F.length(x) + F.length(match) + 1, F.lit(AROUND)))
        return _let(before, sides)

    def told(match: Column, value: Column) -> Column:
        row = lambda near: F.struct(value.alias("value"), F.lit(name).alias("pattern"), match.alias("match"), F.left(F.trim(near), F.lit(200)).alias("fragment"))
        return _let(around(match), lambda near: row(near) if guard is None else F.when(~near.rlike(_FLAGS + guard), row(near)))

    got = value(lambda k: F.regexp_extract(text, full, k))
    tried = lambda match: F.when(match != "", _let(got, lambda v: F.when(v.isNotNull(), told(match, v))))
    return F.when(may, _let(F.regexp_extract(text, full, 0), tried))


def mined_quantity(text: Column, least: int = 1, most: int = 10_000) -> Column:
    """A number of pieces between ``least`` and ``most`` that no identifier's words stand near."""

    def value(group):
        return _let(group(1).try_cast("int"), lambda n: F.when(n.between(least, most), n))

    return _let(_both(text), lambda t: F.coalesce(*(_mined(t, name, p, value, IDENTIFIER_NEAR) for name, p in QUANTITY.items())))


def _date(group: Callable[[int], Column], at: tuple[int, int, int]) -> Column:
    year, month, day = (group(k) for k in at)
    names: Mapping[str, int] = MONTHS
    by_name = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    number = F.coalesce(month.try_cast("int"), F.try_element_at(by_name, F.lower(month)))
    return F.try_to_date(F.concat_ws("-", year, number.cast("string"), day.try_cast("int").cast("string")), "yyyy-M-d")


def mined_deadline(text: Column, anchor: Column, today: Column | None = None) -> Column:
    """``value, pattern, match, fragment, anchor, approximate, offset``: a date in the text, else days or months (30 days) after ``anchor``.

    Where the anchor is null, ``today`` stands in for it and ``approximate`` is
    true. A date that the calendar lacks is passed over.
    """
    return _let(F.struct(_both(text).alias("both"), anchor.alias("anchor")), lambda row: _deadline(row["both"], row["anchor"], today))


def _deadline(both: Column, anchor: Column, today: Column | None) -> Column:
    base = F.coalesce(anchor, F.current_date() if today is None else today)
    none = {"anchor": F.lit(None).cast("date"), "approximate": F.lit(None).cast("boolean"), "offset": F.lit(None).cast("int")}
    tries = []
    for name, (pattern, at) in DATES.items():
        m = _mined(both, name, pattern, lambda group, at=at: _date(group, at))
        tries.append(_let(m, lambda m: F.when(m.isNotNull(), F.struct(*(m[k].alias(k) for k in ("value", "pattern", "match", "fragment")), *(c.alias(k) for k, c in none.items())))))

    def after(days: int) -> Callable[[Column], Column]:
        def dated(m: Column) -> Column:
            rest = {"anchor": base, "approximate": anchor.isNull(), "offset": m["value"]}
            return F.when(m.isNotNull(), F.struct(F.date_add(base, m["value"] * days).alias("value"), *(m[k].alias(k) for k in ("pattern", "match", "fragment")), *(c.alias(k) for k, c in rest.items())))

        return dated

    for name, (pattern, days) in OFFSETS.items():
        tries.append(_let(_mined(both, name, pattern, lambda group: group(1).try_cast("int")), after(days)))
    return F.coalesce(*tries)


def mined_duration(text: Column, most: int = 600) -> Column:
    """Months from 1 to ``most``."""

    def value_of(weights):
        def value(group):
            n = sum((group(k + 1).try_cast("int") * w for k, w in enumerate(weights)), F.lit(0))
            return _let(n, lambda n: F.when(n.between(1, most), n))

        return value

    return _let(_both(text), lambda t: F.coalesce(*(_mined(t, name, p, value_of(w)) for name, (p, w) in DURATIONS.items())))


def mined(text: Column, anchor: Column, today: Column | None = None) -> Column:
    """``quantity, deadline, duration``, each with its provenance or null."""
    all_of = lambda t: F.struct(mined_quantity(t).alias("quantity"), mined_deadline(t, anchor, today).alias("deadline"), mined_duration(t).alias("duration"))
    return _let(text, all_of)  # a plain struct would be put in place of each of its uses, and mined again for each


def named_length(text: Column) -> Column:
    """The first length in months, else in years, as whole months, at least one; halves go to the even number."""

    def months(pattern: str, weight: int) -> Column:
        n, unit = (F.regexp_extract(text, _FLAGS + pattern, k) for k in (1, 2))
        return F.when((unit != "") & ~F.lower(unit).isin(*LENGTH_UNITS_WITHOUT_VALUE), F.greatest(F.lit(1), F.bround(n.try_cast("double") * weight).cast("int")))

    return F.coalesce(months(LENGTH_IN_MONTHS, 1), months(LENGTH_IN_YEARS, 12))


def contract_profile(code: Column, text: Column) -> Column:
    """``contract_type, duration_months, extension_options``: by the structured code, else by words, else ``one_time``."""
    by_code = F.when(F.lower(F.trim(code)).isin(*FRAMEWORK_CODES), "framework_agreement")
    by_text = (F.when(text.rlike(_FLAGS + p), name) for name, p in KINDS.items())
    return F.struct(
        F.coalesce(by_code, *by_text, F.lit("one_time")).alias("contract_type"),
        named_length(text).alias("duration_months"),
        F.coalesce(text.rlike(_FLAGS + EXTENSION), F.lit(False)).alias("extension_options"),
    )
