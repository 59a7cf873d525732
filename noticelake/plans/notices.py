"""Queries on notices that are put together from the given tables: fields by rule table, cross-references."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.field_rules import RULES, STATUS
from ..operators import crossref
from ..operators.fields import FIELDS, extracted_fields, rule_table
from .tables import query, read

# What a page's notice says, by language: labels before its title, host, day, number, text, amount and so on.
_LANGUAGES = ("cs", "no", "de", "da", "es", "fi", "it", "pl", "sv")
_LABELS = {
    "cs": "Název: {title}\nZadavatel: {host}\nEvidenční číslo: N{id}-{day_dmy_slash}\nPopis: {body}\n\nPočet: {count}\nPředpokládaná hodnota: {blank} Kč\nDodavatel: {winner}\nSTAV ZADÁVACÍHO ŘÍZENÍ\n{status}\nCODE FROM THE CPV CODE LIST\n{code}\nDoba trvání: {months} měsíců\n",
    "no": "Tittel: {title}\nOppdragsgiver: {host}\nPublisert {day_dmy_dot}\nReferanse: 2026-{id}\nBeskrivelse: {body}\n\nAntall: {count}\nKontraktsverdi: {mixed} NOK\nValgt leverandør: {winner}\nVarighet: {months} måneder\n",
    "de": "Vergabestelle: {host}\nVeröffentlicht am {day_dmy_dot}\nAktenzeichen: V-{id}\nBeschreibung: {body}\n\nMenge: {count}\nAuftragswert: {dot} EUR\nZuschlag an: {winner}\nLaufzeit: {months} Monate\n",
    "da": "Titel: {title}\nOrdregiver: {host}\nDato: {day_iso}\nReferencenummer: R-{id}\nBeskrivelse: {body}\n\nAntal: {count}\nKontraktvaerdi: {blank} DKK\nTilbudsgiver: {winner}\nVarighed: {months} maaneder\n",
    "es": "Nombre del contrato: {title}\nPoder adjudicador: {host}\nFecha de publicación: {day_dmy_slash}\nExpediente: E-{id}\nDescripción: {body}\n\n{count} unidades\nValor estimado: {dot} €\nAdjudicatario: {winner}\nDuración: {months} meses\nFecha límite: {day_dmy_slash}\n",
    "fi": "Hankinnan nimi: {title}\nTilaaja: {host}\nJulkaistu: {day_iso}\nViite: F-{id}\nKuvaus: {body}\n\nMaara: {count}\nKokonaisarvo: {blank} EUR\nToimittaja: {winner}\nKesto: {months} kuukautta\n",
    "it": "Titolo: {title}\nEnte appaltante: {host}\nPubblicato il: {day_dmy_slash}\nCIG: Z{id}00000000\nDescrizione: {body}\n\n{count} veicoli\nImporto complessivo: {dot} EUR\nAppaltatore: {winner}\nDurata: {months} mesi\nScadenza: {day_dmy_slash}\n",
    "pl": "Zamawiający: {host}\nData publikacji: {day_iso}\nNumer referencyjny: P-{id}\nKrótki opis: {body}\n\n{count} sztuk\nWartość zamówienia: {blank} PLN\nNazwa wykonawcy: {winner}\nOkres realizacji: {months} miesięcy\n",
    "sv": "Rubrik: {title}\nUpphandlande myndighet: {host}\nPublicerad: {day_iso}\nDnr: D-{id}\nBeskrivning: {body}\n\nAntal: {count}\nVärde: {space} SEK\nLeverantör: {winner}\nAvtalstid: {months} månader\n",
}
_STATES = ("Probíhající", "Vyhlášený", "Neukončen", "Ukončený plněním", "Zadán", "Zrušen")
_TITLE, _BODY = r"(?is)<title>(.*?)</title>", r"(?is)<p[^>]*>(.*?)</p>"


def notices_of_pages(spark, sf_dir):
    """``page_id, language, text``: every page as a notice in one of nine languages, with its own words after it."""
    pages = read(spark, sf_dir, "pages")
    p = F.col("page_id")
    amount = 1000 + p * 7 % 900
    day = F.date_add(F.lit("2024-01-01").cast("date"), (p % 700).cast("int"))
    parts = {
        "title": F.regexp_extract("html", _TITLE, 1), "host": F.regexp_extract("url", "^https?://([^/?#:]+)", 1), "id": p.cast("string"), "body": F.trim(F.regexp_replace(F.regexp_extract("html", _BODY, 1), "<[^>]*>", " ")),
        "day_dmy_dot": F.date_format(day, "dd.MM.yyyy"), "day_dmy_slash": F.date_format(day, "dd/MM/yyyy"), "day_iso": F.date_format(day, "yyyy-MM-dd"),
        "count": (1 + p % 400).cast("string"), "months": (1 + p % 48).cast("string"), "winner": F.when(p % 10 == 9, F.concat(p.cast("string"), F.lit(" 000,00"))).otherwise(F.concat(F.lit("Supplier "), F.regexp_extract("html", _TITLE, 1))),
        "dot": F.concat((p % 9).cast("string"), F.lit("."), amount.cast("string").substr(2, 3), F.lit(",50")), "blank": F.concat((1 + p % 9).cast("string"), F.lit(" "), amount.cast("string").substr(2, 3), F.lit(",5")), "space": F.concat((1 + p % 9).cast("string"), F.lit(" "), amount.cast("string").substr(2, 3)),
        "mixed": F.concat(F.lit("1."), amount.cast("string").substr(2, 3), F.lit(".250")), "status": F.element_at(F.array(*(F.lit(s) for s in _STATES)), (p % len(_STATES) + 1).cast("int")), "code": F.concat((p % 90000000 + 10000000).cast("string"), F.lit("-"), (p % 10).cast("string")),
    }
    language = F.element_at(F.array(*(F.lit(x) for x in _LANGUAGES)), (p % len(_LANGUAGES) + 1).cast("int"))
    text = F.lit(None).cast("string")
    for name, form in _LABELS.items():
        pieces = [parts[x[1:-1]] if x.startswith("{") else F.lit(x) for x in re.split(r"(\{\w+\})", form) if x]
        text = F.when(language == name, F.concat(*pieces)).otherwise(text)
    return pages.select("page_id", language.alias("language"), F.concat(text, F.lit("\n"), T.strip_html(F.col("html"))).alias("text"))


# The same notices in SQL.
_PARTS_SQL = {
    "title": "title", "host": "regexp_extract(url, '^https?://([^/?#:]+)', 1)", "id": "CAST(p AS VARCHAR)", "body": "trim(regexp_replace(regexp_extract(html, '(?is)<p[^>]*>(.*?)</p>', 1), '<[^>]*>', ' ', 'g'))",
    "day_dmy_dot": "strftime(d, '%d.%m.%Y')", "day_dmy_slash": "strftime(d, '%d/%m/%Y')", "day_iso": "strftime(d, '%Y-%m-%d')", "count": "CAST(1 + p % 400 AS VARCHAR)", "months": "CAST(1 + p % 48 AS VARCHAR)",
    "winner": "CASE WHEN p % 10 = 9 THEN p || ' 000,00' ELSE 'Supplier ' || title END", "dot": "(p % 9) || '.' || substr(a, 2, 3) || ',50'", "blank": "(1 + p % 9) || ' ' || substr(a, 2, 3) || ',5'", "space": "(1 + p % 9) || ' ' || substr(a, 2, 3)",
    "mixed": "'1.' || substr(a, 2, 3) || '.250'", "status": f"([{', '.join(repr(s) for s in _STATES)}])[p % {len(_STATES)} + 1]", "code": "(p % 90000000 + 10000000) || '-' || (p % 10)",
}
_FORMS_SQL = " ".join(f"WHEN '{name}' THEN " + " || ".join(f"({_PARTS_SQL[x[1:-1]]})" if x.startswith("{") else "'" + x.replace("'", "''") + "'" for x in re.split(r"(\{\w+\})", form) if x) for name, form in _LABELS.items())
_STRIP_SQL = r"trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r\n\f\v]+', ' ', 'g'))".replace('\\"', '"')
_NOTICES_SQL = f"""pages_ AS (SELECT page_id AS p, url, html, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, CAST(1000 + page_id * 7 % 900 AS VARCHAR) AS a, DATE '2024-01-01' + CAST(page_id % 700 AS INTEGER) AS d, ([{", ".join(repr(x) for x in _LANGUAGES)}])[page_id % {len(_LANGUAGES)} + 1] AS lang FROM pages),
 notices AS (SELECT p AS page_id, lang, (CASE lang {_FORMS_SQL} END) || chr(10) || {_STRIP_SQL} AS t FROM pages_)"""


def _rule_sql(field: str, convert: str, pattern: str, least, most, cut) -> str:
    """A rule as SQL. RE2 has no Unicode-aware classes, which makes no difference to these pages."""
    flags = "(?is)" if field == "description" else "(?i)"
    p = pattern.replace("(?-iu)", "(?-i)").replace("'", "''")
    raw = f"nullif(regexp_extract(t, '{flags}{p}', 1), '')"
    strip = lambda x: rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
    number = lambda x: rf"CASE WHEN regexp_full_match({strip(x)}, '[0-9]+\.?[0-9]*|\.[0-9]+') THEN TRY_CAST({strip(x)} AS DOUBLE) END"
    over = lambda x: f"(SELECT CASE WHEN {'n > ' + str(least) if least is not None else 'true'} THEN n END FROM (SELECT {number(x)} AS n))"
    in_range = lambda x: f"(SELECT CASE WHEN {f'n BETWEEN {least} AND {most}' if least is not None else 'true'} THEN CAST(n AS VARCHAR) END FROM (SELECT TRY_CAST({strip(x)} AS BIGINT) AS n))"
    left = lambda x: f"left({x}, {cut})" if cut else x
    lines = lambda each: left(rf"array_to_string(list_filter(string_split({strip(raw)}, chr(10)), lambda x: {strip('x')} <> '')[1:3], ' ')" if not each else rf"array_to_string(list_transform(list_filter(string_split({strip(raw)}, chr(10)), lambda x: {strip('x')} <> '')[1:3], lambda x: {strip('x')}), ' ')")
    bare = f"replace({strip(raw)}, ' ', '')"
    mixed = f"CASE WHEN contains({bare}, ',') AND NOT contains({bare}, '.') THEN replace({bare}, ',', '.') WHEN length({bare}) - length(replace({bare}, '.', '')) > 1 THEN replace(regexp_extract({bare}, '^(.*)\\.', 1), '.', '') || '.' || regexp_extract({bare}, '([^.]*)$', 1) ELSE {bare} END"
    return {
        "text": left(strip(raw)), "name": rf"CASE WHEN NOT regexp_full_match({strip(raw)}, '[0-9\s,.+€]+') THEN {left(strip(raw))} END", "lines": lines(True), "block": lines(False),
        "dmy": rf"regexp_extract({raw}, '([0-9]+)$', 1) || '-' || lpad(regexp_extract({raw}, '[0-9]+[^0-9]+([0-9]+)', 1), 2, '0') || '-' || lpad(regexp_extract({raw}, '^([0-9]+)', 1), 2, '0')",
        "date": f"left({raw}, 10)", "count": in_range(f"replace({raw}, ' ', '')"), "dotted": in_range(f"replace({raw}, '.', '')"), "dots": over(f"replace(replace({raw}, '.', ''), ',', '.')"), "blanks": over(f"replace(replace({raw}, ' ', ''), ',', '.')"), "commas": over(f"replace({bare}, ',', '')"), "mixed": over(mixed),
        "status": "CASE " + " ".join(f"WHEN contains(lower({raw}), '{word}') THEN '{meaning}'" for word, meaning in STATUS.items()) + " END",
    }[convert]


def _field_sql(field: str) -> str:
    by_language = []
    for language in _LANGUAGES:
        tries = [_rule_sql(field, convert, pattern, least, most, cut) for lang, f, convert, pattern, least, most, cut in RULES if (lang, f) == (language, field)]
        if tries:
            by_language.append(f"WHEN '{language}' THEN coalesce({', '.join(f'nullif({x}, {chr(39) * 2})' if field not in ('value', 'quantity') else x for x in tries)})")
    return "CASE lang " + " ".join(by_language) + " END"


_AS_NUMBER = {"quantity": "CAST({} AS BIGINT)", "value": "round(CAST({} AS DOUBLE), 4)"}


def _family(field: str):
    """The query of one field's family over all pages, with its SQL."""
    sql = f"WITH {_NOTICES_SQL} SELECT page_id, lang AS language, {_AS_NUMBER.get(field, '{}').format(_field_sql(field))} AS {field} FROM notices"

    def run(spark, sf_dir):
        found = extracted_fields(notices_of_pages(spark, sf_dir), rule_table(spark), F.col("text"), F.col("language"), (field,))
        value = F.col(f"{field}.value")
        typed = {"quantity": value.cast("long"), "value": F.round(value.cast("double"), 4)}.get(field, value)
        return found.select("page_id", "language", typed.alias(field))

    run.__name__ = f"field_{field}"
    run.__doc__ = f"The {field} that the rules of its language find in every page's notice."
    return query(sql)(run)


for _name in FIELDS:
    _family(_name)


# Records are turns of conversations, notices are documents; a fifth of the notices name a record.
_STOP = ", ".join(f"'{w}'" for w in crossref.STOP_WORDS)
_TOKENS_SQL = lambda c: f"list_filter(list_distinct(regexp_extract_all(lower({c}), '[a-z0-9]+')), lambda w: length(w) > 2 AND w NOT IN ({_STOP}))"
_CROSS_SQL = f"""WITH n AS (SELECT doc_id AS id, coalesce(source, '') AS buyer, {_TOKENS_SQL("left(text, 60)")} AS words, replace(replace(replace(lower(text || CASE WHEN doc_id % 5 = 0 THEN ' conv/' || (doc_id * 7 % 997) || '-1' ELSE '' END), '/', ''), '_', ''), '-', '') AS t, CASE WHEN doc_id % 4 > 0 THEN doc_id % 11 END AS code, CASE WHEN doc_id % 6 > 0 THEN DATE '2024-01-01' + CAST(doc_id % 1500 AS INTEGER) END AS day FROM documents),
 r AS (SELECT conv_id * 1000 + turn AS place, 'conv' || conv_id || turn AS ref, 'office of src' || (conv_id % 29) || ' command' AS buyer, {_TOKENS_SQL("left(text, 60)")} AS words, CASE WHEN turn % 3 > 0 THEN conv_id % 11 END AS code, CASE WHEN conv_id % 5 > 0 THEN DATE '2024-01-01' + CAST(conv_id % 1500 AS INTEGER) END AS day FROM conversations),
 m AS (SELECT id, place, length(ref) >= 6 AND contains(t, ref) AS s1, length(n.buyer) > 4 AND contains(r.buyer, n.buyer) AS b, len(list_intersect(n.words, r.words)) >= 3 AS s2, coalesce(n.code = r.code, true) AND coalesce(abs(date_diff('day', n.day, r.day)) <= 180, true) AS s3 FROM n, r),
 w AS (SELECT id, min(place) FILTER (s1) AS p1, max(place) FILTER (b AND s2) AS p2, min(place) FILTER (b AND s3) AS p3 FROM m GROUP BY 1)
 SELECT id, coalesce(p1, p2, p3) AS record, CASE WHEN p1 IS NOT NULL THEN 1 WHEN p2 IS NOT NULL THEN 2 ELSE 3 END AS strategy FROM w WHERE coalesce(p1, p2, p3) IS NOT NULL"""


@query(_CROSS_SQL)
def cross_reference(spark, sf_dir):
    """Each document's conversation turn by number in its text, else by source and first words, else by source, code and day."""
    d, c = F.col("doc_id"), F.col("conv_id")
    start = F.lit("2024-01-01").cast("date")
    after = lambda n: F.date_add(start, (n % 1500).cast("int"))
    named = F.when(d % 5 == 0, F.concat(F.lit(" conv/"), (d * 7 % 997).cast("string"), F.lit("-1"))).otherwise("")
    notices = read(spark, sf_dir, "documents").select(d.alias("id"), F.col("source").alias("buyer"), F.left("text", F.lit(60)).alias("title"), F.concat("text", named).alias("description"), F.when(d % 4 > 0, d % 11).alias("code"), F.when(d % 6 > 0, after(d)).alias("day"))
    turn = F.col("turn")
    place = c * 1000 + turn
    records = read(spark, sf_dir, "conversations").select(place.alias("id"), F.concat(F.lit("conv/"), c.cast("string"), F.lit("-"), turn.cast("string")).alias("ref"), F.concat(F.lit("office of  SRC"), (c % 29).cast("string"), F.lit(" command")).alias("buyer"), F.left("text", F.lit(60)).alias("title"), F.when(turn % 3 > 0, c % 11).alias("code"), F.when(c % 5 > 0, after(c)).alias("day"), place.alias("place"))
    return crossref.cross_reference(notices, records)
