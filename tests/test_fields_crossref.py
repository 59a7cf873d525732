"""Field rules on labelled texts, and cross-references against all pairs."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from noticelake.operators import crossref, fields

fields_any = (None, None, None)
CASES = [
    ("cs", "Název: Nákup přívěsů pro armádu\nZadavatel: Ministerstvo obrany\nDatum 5. 3. 2024\nPočet: 1 200", {"title": "Nákup přívěsů pro armádu", "authority": "Ministerstvo obrany", "date": "2024-03-05", "quantity": "1200"}),
    ("cs", "ESTIMATED VALUE (EXCL. VAT)\n153,107.43\nSUPPLIER\nTatra Trucks a.s.\nCURRENT STATUS OF THE PROCUREMENT PROCEDURE\nTermination of performance\nCODE FROM THE CPV CODE LIST\n34223300-9", {"value": 153107.43, "winner": "Tatra Trucks a.s.", "status": "Closed", "code": "34223300-9"}),
    ("cs", "Předpokládaná hodnota: 1.234.567 Kč\nDodavatel: 12 000,50\nVybraný dodavatel: VOP CZ", {"value": 1234.567, "winner": None}),
    ("cs", "hodnota 99 Kč", {"value": None}),
    ("no", "Kjøper: Forsvarsmateriell\nPublisert 01.02.2024\nDoffin: 2024-123456\nKontraktsverdi: 2 500 000,50 NOK\nVinner: Volvo AS\nAntall: 12", {"authority": "Forsvarsmateriell", "date": "2024-02-01", "reference": "2024-123456", "value": 2500000.5, "winner": "Volvo AS", "quantity": "12"}),
    ("de", "Vergabestelle: BAAINBw Koblenz\nAktenzeichen: Q/U2AF/LA158\nMenge: 1.200\nAuftragswert: 1.234.567,89 EUR\nZuschlag an: Krone GmbH\nLaufzeit: 24 Monate\n17.04.2024", {"authority": "BAAINBw Koblenz", "reference": "Q/U2AF/LA158", "quantity": "1200", "value": 1234567.89, "winner": "Krone GmbH", "duration": "24 Monate", "date": "2024-04-17"}),
    ("da", "Ordregiver: Forsvaret FMI\nDato: 2024-05-06\n00253032-2026\nKontraktvaerdi: 500 000 DKK\nAntal: 10001", {"authority": "Forsvaret FMI", "date": "2024-05-06", "reference": "00253032-2026", "value": 500000.0, "quantity": None}),
    ("es", "Expediente: 2024/AR40\nFecha de publicación: 07/08/2024\nValor estimado: 99,5 €\n5 remolques\nAdjudicatario: 1.000,00\nFecha límite: 01/09/2024", {"reference": "2024/AR40", "date": "2024-08-07", "value": 99.5, "quantity": "5", "winner": None, "deadline": "2024-09-01"}),
    ("fi", "Tilaaja: Puolustusvoimat\n3.7.2024\nKokonaisarvo: 1 000,5 EUR\nViite: PV-1/2024", {"authority": "Puolustusvoimat", "date": "2024-07-03", "value": 1000.5, "reference": "PV-1/2024"}),
    ("fr", '{"OBJET": {"VALEUR_ESTIMEE": {"MONTANT": "12 500,5", "DEVISE": "EUR"}}, "QTE": "7", "DUREE": "24 mois", "DESCRIPTION": "short"}', {"value": 12500.5, "quantity": "7", "duration": "24 mois", "description": None}),
    ("fr", '{"ATTRIBUTION": {"VALEUR_TOTALE": 300}, "CRITERES": {"VALEUR_ESTIMEE": "x"}}', {"value": 300.0}),
    ("it", "Oggetto: Fornitura di rimorchi\nCIG: A1B2C3D4E5\nImporto a base d'asta: 2.000.000,00 €\nContraente: Iveco Defence\nScadenza: 30/09/2024", {"title": "Fornitura di rimorchi", "reference": "A1B2C3D4E5", "value": 2000000.0, "winner": "Iveco Defence", "deadline": "2024-09-30"}),
    ("pl", "Zamawiający: 1. Regionalna Baza\n2026/BZP 00123456\n4.3.) Wartość zamówienia: 123 456 PLN\n7.3.1) Nazwa wykonawcy zamówienia: Jelcz Sp. z o.o.\n12 sztuk", {"authority": "1. Regionalna Baza", "reference": "2026/BZP 00123456", "value": 123456.0, "winner": "Jelcz Sp. z o.o.", "quantity": "12"}),
    ("sv", "Upphandlande myndighet: FMV\nKöpare: Försvarets materielverk\n25FMVU2821\n7/8/2024\nVärde: 900 000 SEK\nBeskrivning: " + "ord " * 20, {"authority": "Försvarets materielverk", "reference": "25FMVU2821", "date": "2024-08-07", "value": 900000.0, "description": ("ord " * 20).strip()}),
    ("xx", "Title: nothing is known of this language", {"title": None}),
    ("de", None, {"title": None}),
]


def test_rules_find_what_labels_say(spark):
    df = spark.createDataFrame([(k, lang, text) for k, (lang, text, _) in enumerate(CASES)], "k int, lang string, text string")
    names = {"de": ("Bundeswehr",), "da": ("Nobody", "forsvaret fmi")}
    rows = {r.k: r for r in fields.extracted_fields(df, fields.rule_table(spark, names=names), F.col("text"), F.col("lang")).collect()}
    for k, (_, _, want) in enumerate(CASES):
        for field, value in want.items():
            got = rows[k][field]
            assert (float(got.value) if isinstance(value, float) and got else got and got.value) == value, (k, field, got)
    assert rows[0].title.rule == "cs:title:1" and rows[4].winner.rule == "no:winner:3"
    listed = spark.createDataFrame([("de", "Post der BUNDESWEHR in Bonn")], "lang string, text string")
    assert fields.extracted_fields(listed, fields.rule_table(spark, names=names), F.col("text"), F.col("lang")).first().authority.value == "Bundeswehr"


def test_only_rules_that_count_are_tried(spark):
    """A broken pattern stops the run if it is tried: neither other fields' rules are nor those after the first valid one."""
    rules = [("de", "title", "text", "T: (.*)", *fields_any), ("de", "title", "text", "(", *fields_any), ("de", "code", "text", "(", *fields_any)]
    df = spark.createDataFrame([("de", "T: short"), ("xx", "T: none"), ("de", None)], "lang string, text string")
    made = lambda d, names: [r.title and tuple(r.title) for r in fields.extracted_fields(d, fields.rule_table(spark, rules), F.col("text"), F.col("lang"), names).collect()]
    assert made(df.where("text IS NOT NULL"), ("title",)) == [("short", "de:title:1"), None]
    with pytest.raises(Exception, match="(?i)pattern|group"):
        made(df.where("text IS NOT NULL"), ("title", "code"))


def brute_references(notices, records):
    stop = set(crossref.STOP_WORDS)
    import re

    name = lambda s: re.sub(r"\s+", " ", (s or "").strip().lower())
    words = lambda s: {w for w in re.findall("[a-z0-9]+", (s or "").lower()) if len(w) > 2 and w not in stop}
    bare = lambda s: re.sub("[/_-]", "", (s or "").lower())
    out = {}
    for i, buyer, title, text, code, day in notices:
        match = None
        for j, ref, buyer2, title2, code2, day2, _ in sorted(records, key=lambda r: r[-1]):
            if len(bare(ref)) >= 6 and bare(ref) in bare(text):
                match = (j, 1)
                break
            a, b = name(buyer), name(buyer2)
            if a and b and any(len(w) > 4 and w not in stop and w in b for w in a.split()) and len(words(title) & words(title2)) >= 3:
                match = (j, 2)
                continue
            near = day is None or day2 is None or abs((day - day2).days) <= 180
            if match is None and a and b and any(len(w) > 4 and w in b for w in a.split()) and not (code and code2 and code != code2) and near:
                match = (j, 3)
        if match:
            out[i] = match
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_references_equal_all_pairs(spark, seed):
    r = random.Random(seed)
    buyers = ["Defence Materiel Group", "materiel  DEFENCE", "Navy Logistics", "Landforces group", "Army", None, "", "Supply contract"]
    terms = ["lowbed", "trailer", "tank", "heavy", "recovery", "vehicle", "supply", "fleet"]
    title = lambda: None if r.random() < 0.1 else " ".join(r.sample(terms, r.randint(1, 6)))
    day = lambda: None if r.random() < 0.2 else datetime.date(2024, 1, 1) + datetime.timedelta(days=r.randint(0, 900))
    code = lambda: r.choice([None, "2510", "2511", "2512"])
    records = [(f"r{k}", r.choice([f"ATM/2024/{k % 40}", f"L-{k}", None, f"land{k}_25", f"lot {k % 30} of 9"]), r.choice(buyers), title(), code(), day(), k * 3 % 121) for k in range(121)]
    notices = [(k, r.choice(buyers), title(), r.choice([None, "text of atm-2024/%d here" % r.randint(0, 60), "xLAND%d/25y" % r.randint(0, 130), "see Lot %d of_9" % r.randint(0, 40), "none"]), code(), day()) for k in range(150)]
    n = spark.createDataFrame(notices, "id int, buyer string, title string, description string, code string, day date")
    m = spark.createDataFrame(records, "id string, ref string, buyer string, title string, code string, day date, place int")
    got = {x.id: (x.record, x.strategy) for x in crossref.cross_reference(n, m).collect()}
    assert got == brute_references(notices, records) and {s for _, s in got.values()} == {1, 2, 3}
    assert crossref.cross_reference(n, m.limit(0)).count() == 0 and crossref.cross_reference(n.limit(0), m).count() == 0
