"""Column rules on notices: dates in several forms, where a date came from, what is missing, specs, terms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import sentence_count

# Months in dates of tender portals.
MONTHS = {"jan": "01", "feb": "02", "mar": "03", "apr": "04", "may": "05", "jun": "06", "jul": "07", "aug": "08", "sep": "09", "oct": "10", "nov": "11", "dec": "12"}
# Zones that a date may end with.
ZONES = ("+01:00", "+02:00", "+00:00", "+03:00", "Z")
# How descriptions begin that were not cleaned.
BAD_BEGINNINGS = (
    "file number", "notice of proposed procurement", "avis de projet", "solicitation number", "reissue of request", "this solicitation", "nso number",
    "abn:", "procurement identification", "solicitation cancels", "this request for", "note:", "the contracting authority hereby", "amendment",
)
# Beginnings of ids and what their date is.
DATE_SOURCES = (("CA-", "tender_notice"), ("AU-CN", "contract_notice_fallback"), ("AU-", "tender_notice"), ("UK-", "tender_notice"), *((p, "tender_notice") for p in ("CZ-", "FR-", "NO-", "UA-", "NL-", "EE-", "NATO-")))
PROTECTED = r"(?i)\b(?:armou?red|mrap|blast[\s-]proof|ballistic|protected)\b"


def _group(text: Column, pattern: str, k: int) -> Column:
    return F.regexp_extract(F.coalesce(text, F.lit("")), pattern, k)


def _found(text: Column, pattern: str) -> Column:
    return F.coalesce(text, F.lit("")).rlike(pattern)


def plain_date(text: Column) -> Column:
    """A date of ``2024-01-31``, the same with a time of day, or ``20240131``; zones are dropped, anything else is null."""
    bare = text
    for zone in ZONES:
        bare = F.replace(bare, F.lit(zone), F.lit(""))
    bare = F.trim(bare)
    day = F.when(bare.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?$"), F.split_part(bare, F.lit("T"), F.lit(1)))
    return F.coalesce(F.try_to_date(day, "yyyy-M-d"), F.when(bare.rlike("^[0-9]{8}$"), F.try_to_date(bare, "yyyyMMdd")))


def _month(name: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in MONTHS.items() for x in kv))
    return F.coalesce(F.try_element_at(table, F.lower(name)), F.lit("00"))


def portal_date(text: Column, form: str) -> Column:
    """``yyyy-mm-dd`` of a portal's date; null where it has none of the form's shapes. Days aren't checked against a calendar.

    ``mail``: Wed, 01 Apr 2026 00:00:00 GMT; ``dashed``: 1-Apr-2026 or 11-May-2026 10:00 am, or 01 Apr 2026 alone;
    ``leading``: 2026-04-01 or 01.04.2026 at the start; ``dotted``: 1.4.2026 anywhere.
    """
    t = F.coalesce(text, F.lit(""))

    def named(pattern: str, source: Column) -> Column:
        d, m, y = (_group(source, pattern, k) for k in (1, 2, 3))
        return F.when(_found(source, pattern), F.concat_ws("-", y, _month(m), F.lpad(d, 2, "0")))

    def numbered(pattern: str) -> Column:
        d, m, y = (_group(t, pattern, k) for k in (1, 2, 3))
        return F.when(_found(t, pattern), F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))

    if form == "mail":
        return named(r"^\s*(?:[A-Za-z]+,\s*)?([0-9]{1,2})\s+([A-Za-z]{3})[a-z]*\s+([0-9]{4})(?:\s|$)", t)
    if form == "dashed":
        first = F.split_part(F.trim(t), F.lit(" "), F.lit(1))
        return F.coalesce(named(r"^([0-9]{1,2})-([A-Za-z]{3})-([0-9]{4})$", first), named(r"^([0-9]{1,2})\s+([A-Za-z]{3})\s+([0-9]{4})$", F.trim(t)))
    if form == "leading":
        return F.coalesce(F.nullif(_group(t, r"^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit("")), numbered(r"^([0-9]{2})\.([0-9]{2})\.([0-9]{4})"))
    if form == "dotted":
        return numbered(r"([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})")
    raise ValueError(f"no such form: {form}")


def picked_date(start: Column, published: Column, documents: Column, released: Column) -> Column:
    """``day, source``: the tender's period, else its publication, else its first document's, else the release that came after the award."""
    day = lambda c: F.nullif(F.left(c, F.lit(10)), F.lit(""))
    told = lambda c, source: F.when(day(c).isNotNull(), F.struct(day(c).alias("day"), F.lit(source).alias("source")))
    last = F.struct(day(released).alias("day"), F.lit("contract_notice_fallback").alias("source"))
    return F.coalesce(told(start, "tender_period_start"), told(published, "tender_notice"), told(F.get(documents, F.lit(0)), "tender_notice"), last)


def date_source(known: Column, record_id: Column, kind: Column) -> Column:
    """What a date is: what is known of it, else by the id's beginning, for numbered ids by the notice's kind."""
    r, k = F.coalesce(record_id, F.lit("")), F.lower(F.coalesce(kind, F.lit("")))
    out = F.when((known != "") & (known != "unknown"), known)
    for beginning, source in DATE_SOURCES:
        out = out.when(r.startswith(beginning), source)
    numbered = F.when(k.contains("award") | k.contains("can") | k.contains("result"), "contract_notice_fallback").when(k.contains("prior") | k.contains("pin"), "pin_notice").otherwise("tender_notice")
    return out.when(r.rlike("^[0-9]+-[0-9]{4}$"), numbered).otherwise("unknown")


def needs_enrichment(winner: Column, amount: Column, quantity: Column) -> Column:
    """No winner, no amount above 0.01, or no quantity."""
    return ~F.coalesce(winner != "", F.lit(False)) | ~F.coalesce(amount > 0.01, F.lit(False)) | quantity.isNull()


def needs_cleaning(description: Column, source: Column) -> Column:
    """Missing, a known bad beginning, or more than four sentences, its own or those of the source it repeats."""
    low = F.lower(F.trim(description))
    bad = F.coalesce(*(F.when(low.startswith(b), True) for b in BAD_BEGINNINGS), F.lit(False))
    repeats = F.coalesce((source != "") & (F.trim(description) == F.trim(source)) & (sentence_count(source) > 4), F.lit(False))
    return F.coalesce(description == "", F.lit(True)) | bad | (sentence_count(description) > 4) | repeats


def candidate_url(*urls: Column) -> Column:
    """The first with a scheme of the web."""
    return F.coalesce(*(F.when(u.startswith("http://") | u.startswith("https://"), u) for u in urls))


def lifted_specs(spec: Column, kind: Column, description: Column) -> Column:
    """``axles, payload_kg, dimensions, protection`` of a vehicle, from its first spec (type, axle_load_t, payload_t, mass_t, length_mm,
    width_mm, height_mm), then from the words of its kind; protection also from the description's first 500 letters.

    Tonnes become kilograms; the mass stands in for a payload; two or more dimensions are joined. Halves round to the even number.
    """
    axle = lambda c: F.when(_found(c, r"(?i)([0-9]+)[\s-]axle"), F.concat(_group(c, r"(?i)([0-9]+)[\s-]axle", 1), F.lit("-axle")))
    kilos = lambda c, factor: F.bround(c.try_cast("double") * factor).cast("long")
    kg, tonnes = r"(?i)([0-9.]+)\s*kg", r"(?i)([0-9.]+)\s*t(?:onne|on)?(?:ne)?[\s-]"
    from_words = F.when(_found(kind, kg), kilos(_group(kind, kg, 1), 1)).when(_found(kind, tonnes), kilos(_group(kind, tonnes, 1), 1000))
    parts = F.array_compact(F.array(*(F.when(spec[c] != 0, F.concat(spec[c].cast("int").cast("string"), F.lit("mm"))) for c in ("length_mm", "width_mm", "height_mm"))))
    words = F.concat(F.coalesce(kind, F.lit("")), F.lit(" "), F.left(F.coalesce(description, F.lit("")), F.lit(500)))
    return F.struct(
        F.coalesce(axle(spec["type"]), F.when(spec["axle_load_t"].isNotNull(), "single-axle"), axle(kind)).alias("axles"),
        F.coalesce(kilos(F.coalesce(spec["payload_t"], spec["mass_t"]), 1000), from_words).alias("payload_kg"),
        F.when(F.size(parts) >= 2, F.array_join(parts, " × ")).alias("dimensions"),
        F.when(words.rlike(PROTECTED), "armoured").alias("protection"),
    )


def spec_quality(types: Column, confidence: Column) -> Column:
    """``none`` without specs at all, ``good`` with types and confidence, else ``empty``."""
    return F.when(types.isNull() & confidence.isNull(), "none").when((F.coalesce(F.size(types), F.lit(0)) > 0) & (F.coalesce(confidence, F.lit(0)) > 0), "good").otherwise("empty")


def type_class(kind: Column, first_spec: Column, generic: str) -> Column:
    """``generic`` by a pattern, else ``specific``; without a kind by the first spec's type, ``null`` where that is missing too."""
    return F.when(F.coalesce(kind != "", F.lit(False)), F.when(kind.rlike(generic), "generic").otherwise("specific")).when(F.coalesce(first_spec != "", F.lit(False)), "specific").otherwise("null")


def curated(term: Column, stop: Sequence[str], known: Column) -> Column:
    """``keep, reason`` of a proposed keyword; ``known`` says whether it is there already."""
    t = F.trim(F.coalesce(term, F.lit("")))
    n = F.length(t).cast("string")
    told = lambda keep, *reason: F.struct(F.lit(keep).alias("keep"), F.concat(*(F.lit(r) if isinstance(r, str) else r for r in reason)).alias("reason"))
    return (
        F.when(t == "", told(False, "empty")).when(F.length(t) < 4, told(False, "length <4 (", n, ")")).when(F.lower(t).isin(*stop), told(False, "stoplist")).when(known, told(False, "already in settings"))
        .when(t.rlike(r"\S\s+\S"), told(True, "multi-word phrase")).when(F.length(t) >= 6, told(True, "single word ≥6 chars (", n, ")")).otherwise(told(True, "borderline single word (", n, " chars)"))
    )


def gaps(*columns: Column) -> Column:
    """How many are missing: null, "" or 0."""
    return sum((F.coalesce(c.cast("string").isin("", "0"), F.lit(True)).cast("int") for c in columns), F.lit(0))


def applied_slots(result: Column, known: Column, slots: int = 3) -> Column:
    """Slots of ``type, category, quantity`` after a decision: ``result`` has ``slots`` (null for the old form), ``type, category, quantity``.

    Types and categories come from the decision, "" as null; a quantity that is
    known stays unless the decision has one. The old form fills the first slot alone.
    """
    none = lambda c: F.nullif(c, F.lit(""))
    old = F.array(F.struct(result["type"].alias("type"), result["category"].alias("category"), result["quantity"].alias("quantity")))
    given = F.coalesce(result["slots"], old)

    def slot(k: int) -> Column:
        g, before = F.get(given, F.lit(k)), F.get(known, F.lit(k))["quantity"]
        keeps = result["slots"].isNotNull() if k else F.lit(True)
        return F.struct(none(g["type"]).alias("type"), none(g["category"]).alias("category"), F.coalesce(g["quantity"], F.when(keeps, before)).alias("quantity"))

    return F.array(*(slot(k) for k in range(slots)))


def is_stale(entry: Column, text_hash: Column, model: str, now: Column, days: int, better: Column, best_source: str) -> Column:
    """Whether a cached decision counts no longer: another text, another model, too old or undated, or older than a better source.

    ``entry`` has ``hash, model, checked_at, source``; a null hash or model of the entry is none to compare.
    """
    other = lambda a, b: F.coalesce(a != b, F.lit(False))
    old = F.coalesce(F.unix_timestamp(now) - F.unix_timestamp(entry["checked_at"]) >= days * 86_400, F.lit(True))
    return other(entry["hash"], text_hash) | other(entry["model"], F.lit(model)) | old | (F.coalesce(better, F.lit(False)) & ~entry["source"].eqNullSafe(F.lit(best_source)))


def merged_terms(current: Mapping[str, Sequence[str]], added: Mapping[str, Sequence[str]], dropped: Sequence[str] = ()) -> dict[str, list[str]]:
    """Keywords by category: the current ones, then new ones once, without those dropped. A rule's configuration, so no table."""
    gone = {d.lower() for d in dropped}
    return {k: [t for t in dict.fromkeys([*current.get(k, ()), *added.get(k, ())]) if t.lower() not in gone] for k in dict.fromkeys([*current, *added])}


# Short forms of a country's name before titles, and currencies where a portal names none (euros elsewhere).
COUNTRY_SHORT = {"Czech Republic": ("Czech", "Czechia"), "United Kingdom": ("UK",)}
CURRENCY_OF = {"DE": "EUR", "PL": "PLN", "SE": "SEK", "NO": "NOK", "CZ": "CZK", "DK": "DKK", "GB": "GBP", "CH": "CHF", "TR": "TRY"}


def without_country(title: Column, country: Column, least: int = 8) -> Column:
    """The title without ``Country -`` or ``Country Defence –`` before it, unless less than ``least`` characters would be left.

    A country's short forms count as its name; of those that fit, the first.
    """
    short = F.create_map(*(x for k, v in COUNTRY_SHORT.items() for x in (F.lit(k), F.array(*(F.lit(n) for n in v)))))
    names = F.concat(F.array(country), F.coalesce(F.try_element_at(short, country), F.array().cast("array<string>")))
    patterns = F.transform(names, lambda n: F.concat(F.lit(r"(?iU)^\Q"), n, F.lit(r"\E(?:\s+(?:Ministry of Defence|Defence))?\s*[-–]\s+")))
    hit = F.get(F.filter(patterns, lambda p: F.regexp_like(title, p)), F.lit(0))
    rest = F.regexp_replace(title, hit, F.lit(""))
    known = F.coalesce((country != "") & (country != "Unknown"), F.lit(False)) & hit.isNotNull()
    return F.when(known & (F.length(rest) >= least), rest).otherwise(title)


def prefixed_id(reference: Column, country: Column) -> Column:
    """``CC-reference`` with the prefix once; "" without a reference."""
    prefix = F.concat(country, F.lit("-"))
    return F.when(F.coalesce(reference, F.lit("")) == "", "").when(reference.startswith(prefix), reference).otherwise(F.concat(prefix, reference))


def standard_notice(detail: Column, country_code: Column, country: Column, source: Column) -> Column:
    """A portal's detail (reference, url, title, authority, date, value, currency, winner, description, raw_text, status, quantity,
    duration) in the schema that all portals share: texts cut at 500 and 10,000 characters, missing texts as ""."""
    text = lambda name, n=None: F.coalesce(detail[name] if n is None else F.left(detail[name], F.lit(n)), F.lit(""))
    currency = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in CURRENCY_OF.items() for x in kv)), country_code), F.lit("EUR"))
    return F.struct(
        prefixed_id(detail["reference"], country_code).alias("tender_id"), source.alias("source"), detail["url"].alias("source_url_national"), detail["title"].alias("title"), country.alias("country"), detail["authority"].alias("authority"), text("date", 10).alias("published"),
        detail["value"].alias("value"), F.coalesce(F.nullif(detail["currency"], F.lit("")), currency).alias("currency"), detail["winner"].alias("winner"), text("description", 500).alias("description"), text("raw_text", 10_000).alias("raw_text"), text("status").alias("status"),
        detail["quantity"].alias("quantity"), detail["duration"].alias("duration"),
    )


def buyer_names(flat: Sequence[Column], buyer: Column, parties: Column, roles: Sequence[str] = ("buyer", "procuringentity")) -> Column:
    """All names that may be the buyer's: flat fields, the buyer, then parties with a role, by lower-cased roles; one that comes twice stays twice."""
    fits = F.filter(F.coalesce(parties, F.array().cast("array<struct<name:string,roles:array<string>>>")), lambda p: F.exists(F.coalesce(p["roles"], F.array().cast("array<string>")), lambda r: F.lower(r).isin(*roles)))
    return F.filter(F.concat(F.array(*flat, buyer), F.transform(fits, lambda p: p["name"])), lambda n: n.isNotNull() & (n != ""))


def gathered_codes(plain: Column, extended: Column, items: Column, scheme: str = "CPV") -> Column:
    """Codes of a list in a text, those of a second list that are new, then of items' and further classifications of the scheme."""
    words = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != "")
    of = lambda classes: F.transform(F.filter(classes, lambda c: (F.upper(c["scheme"]) == scheme) & (c["id"] != "")), lambda c: c["id"])
    none = F.array().cast("array<struct<scheme:string,id:string>>")
    nested = F.flatten(F.transform(F.coalesce(items, F.array().cast("array<struct<classification:struct<scheme:string,id:string>,more:array<struct<scheme:string,id:string>>>>")), lambda i: of(F.concat(F.array(i["classification"]), F.coalesce(i["more"], none)))))
    return F.concat(words(plain), F.array_except(words(extended), words(plain)), nested)
