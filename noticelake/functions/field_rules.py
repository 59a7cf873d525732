"""Rules that find a field's value in a notice's page text, by language: fixed values.

A rule is (language, field, convert, pattern, least, most, cut). Of a field's rules
the first one that gives a value counts, in the order of this table. ``convert`` says
what becomes of the first group:

text     white space around it goes; ``cut`` characters stay
name     the same, but a text of digits and separators alone is none
lines    its first three lines that aren't blank, each stripped, joined by a blank
block    the same without stripping the lines
dmy      day, month and year between any separators, as yyyy-mm-dd
date     its first ten characters
count    a whole number from ``least`` to ``most``; blanks between digits go
dots     an amount with dots as thousands and a decimal comma, over ``least``
blanks   an amount with blanks as thousands and a decimal comma or point
commas   an amount with commas as thousands
mixed    a comma alone is decimal; of several points only the last stays
dotted   a whole number whose dots go
status   a word of ``STATUS`` in it
listed   the name in place of the pattern, where it stands in the text, case ignored
json     a number at a path of a JSON text, or at ``MONTANT`` or ``val`` below it
"""

from __future__ import annotations

# What a status contains, in order, and what it means.
STATUS = {
    "probíhající": "Open", "vyhlášený": "Open", "neukončen": "Open", "not terminated": "Open", "ukončený": "Closed",
    "termination of performance": "Closed", "zadán": "Awarded", "awarded": "Awarded", "zrušen": "Cancelled", "cancelled": "Cancelled",
}

_DAY = r"(\d{1,2}\s*\.\s*\d{1,2}\s*\.\s*\d{4})"
_ISO = r"(\d{4}-\d{2}-\d{2})"
_UP_TO_PARAGRAPH = r"(?:\n\n|$)"
#: A range without bounds.
ANY = (None, None, None)

# The rules of each language.
RULES: tuple[tuple, ...] = (
    # Czech
    ("cs", "title", "text", r"(?:Název|Předmět|Name|Title)[:\s]+([^\n]{10,200})", *ANY),
    ("cs", "authority", "text", r"(?:Zadavatel|Objednatel|Contracting authority)[:\s]+([^\n]{5,120})", None, None, 120),
    ("cs", "date", "dmy", r"(\d{1,2}/\d{1,2}/\d{4})", *ANY),
    ("cs", "date", "dmy", _DAY, *ANY),
    ("cs", "date", "date", _ISO, *ANY),
    ("cs", "reference", "text", r"(?:Evidenční číslo|Systémové číslo|Č\. j\.)[:\s]+([A-Z0-9/\-_.]{4,40})", *ANY),
    ("cs", "reference", "text", r"\b(N\d{3}[/\-]\d{2,4}[/\-][A-Z0-9]+)\b", *ANY),
    ("cs", "description", "lines", rf"(?:Popis|Předmět zakázky|Description|Stručný popis)[:\s]+(.{{30,500}}?){_UP_TO_PARAGRAPH}", None, None, 400),
    ("cs", "quantity", "count", r"(\d[\d\s]*)\s*(?:ks|kusů|kus|přívěsů|návěsů|vozidel)", 1, 9999, None),
    ("cs", "quantity", "count", r"(?:Počet|Množství|Quantity)[:\s]+(\d[\d\s]*)", 1, 9999, None),
    ("cs", "value", "commas", r"(?-iu)ESTIMATED VALUE \(EXCL\. VAT\)\n([\d,. ]+)", 0, None, None),
    ("cs", "value", "mixed", r"(?:Předpokládaná hodnota|Odhadovaná hodnota)[^\d]{0,20}([\d\s,.]+)\s*(?:CZK|Kč|KČ)", 100, None, None),
    ("cs", "value", "mixed", r"([\d\s,.]+)\s*(?:CZK|Kč|KČ)\b", 100, None, None),
    ("cs", "winner", "name", r"(?:Vítěz|Dodavatel|Vybraný dodavatel|Winner|Jméno dodavatele)[:\s]+([^\n]{5,120})", None, None, 120),
    ("cs", "winner", "name", r"(?:Supplier|Selected supplier|Selected tenderer|Contractor)[:\s]+([^\n]{5,120})", None, None, 120),
    ("cs", "winner", "name", r"SUPPLIER\s*\n\s*([^\n]{5,120})", None, None, 120),
    ("cs", "winner", "name", r"SELECTED TENDERER\s*\n\s*([^\n]{5,120})", None, None, 120),
    ("cs", "winner", "name", r"DODAVATEL\s*\n\s*([^\n]{5,120})", None, None, 120),
    ("cs", "winner", "name", r"VÍTĚZ\s*\n\s*([^\n]{5,120})", None, None, 120),
    ("cs", "winner", "name", r"JMÉNO DODAVATELE\s*\n\s*([^\n]{5,120})", None, None, 120),
    ("cs", "status", "status", r"CURRENT STATUS OF THE PROCUREMENT PROCEDURE\s*\n\s*([^\n]+)", *ANY),
    ("cs", "status", "status", r"STAV ZADÁVACÍHO ŘÍZENÍ\s*\n\s*([^\n]+)", *ANY),
    ("cs", "code", "text", r"CODE FROM THE CPV CODE LIST\s*\n\s*([\d]{8}-[\d])", *ANY),
    ("cs", "code", "text", r"CODE FROM THE CPV CODE LIST\s*\n\s*([\d\-]{9,12})", *ANY),
    ("cs", "duration", "text", r"(?:Doba trvání|Délka smlouvy|Duration)[:\s]+([^\n]{3,80})", None, None, 80),
    ("cs", "duration", "text", r"(\d+)\s*(?:měsíců|měsíce|měsíc|týdnů|let|dní)", None, None, 80),
    # Norwegian
    ("no", "title", "text", r"(?:Tittel|Subject|Title|Heading)[:\s]+([^\n]{10,200})", *ANY),
    ("no", "authority", "text", r"(?:Oppdragsgiver|Kjøper|Contracting authority)[:\s]+([^\n]{5,120})", None, None, 120),
    ("no", "authority", "text", r"(?:Organisasjon|Organisation|Buyer)[:\s]+([^\n]{5,120})", None, None, 120),
    ("no", "date", "dmy", r"(\d{2}\.\d{2}\.\d{4})", *ANY),
    ("no", "date", "date", _ISO, *ANY),
    ("no", "reference", "text", r"(?:Doffin|Referanse|Reference)[:\s\-#]+([A-Z0-9\-/]{4,40})", *ANY),
    ("no", "reference", "text", r"(\d{4}-\d+)", *ANY),
    ("no", "description", "lines", rf"(?:Beskrivelse|Kontraktsbeskrivelse|Description)[:\s]+(.{{30,500}}?){_UP_TO_PARAGRAPH}", None, None, 400),
    ("no", "description", "lines", rf"(?:Kort beskrivelse)[:\s]+(.{{30,400}}?){_UP_TO_PARAGRAPH}", None, None, 400),
    ("no", "quantity", "count", r"(\d[\d\s]*)\s*(?:stk|stykk|enheter|tilhengere|kjøretøy)", 1, 9999, None),
    ("no", "quantity", "count", r"(?:Antall|Mengde|Quantity)[:\s]+(\d[\d\s]*)", 1, 9999, None),
    ("no", "value", "mixed", r"(?:Estimert verdi|Kontraktsverdi|Estimated value)[^\d]{0,20}([\d\s.,]+)\s*(?:NOK|kr\.?)", 100, None, None),
    ("no", "value", "mixed", r"NOK\s+([\d\s.,]+)", 100, None, None),
    ("no", "winner", "name", r"(?:Kontraktsvinner|Valgt leverandør|Navn på leverandør)[:\s]+([^\n]{5,150})", None, None, 120),
    ("no", "winner", "name", r"(?:Leverandørnavn|Leverandør)[:\s]+([^\n]{5,150})", None, None, 120),
    ("no", "winner", "name", r"(?:Tildelt|Vinner)[:\s]+([^\n]{5,150})", None, None, 120),
    ("no", "winner", "name", r"(?:Winner|Award(?:ed to)?)[:\s]+([^\n]{5,150})", None, None, 120),
    ("no", "duration", "text", r"(?:Varighet|Kontraktslengde|Duration)[:\s]+([^\n]{3,80})", None, None, 80),
    ("no", "duration", "text", r"(\d+)\s*(?:måneder|uker|år|dager)", None, None, 80),
    # German
    ("de", "authority", "text", r"(?:Vergabestelle|Auftraggeber)[:\s]+([^\n]{5,80})", *ANY),
    ("de", "authority", "text", r"Vergabestelle\s+([^\n\|]{4,60})", *ANY),
    ("de", "date", "dmy", r"(\d{2}\.\d{2}\.\d{4})", *ANY),
    ("de", "date", "date", _ISO, *ANY),
    ("de", "reference", "text", r"(?:Aktenzeichen|Vergabenummer|Referenznummer)[:\s]+([A-Z0-9/\-_.]{4,40})", *ANY),
    ("de", "description", "text", rf"(?:Beschreibung|Leistung|Gegenstand|Auftragsgegenstand)[:\s]+(.{{50,500}}?){_UP_TO_PARAGRAPH}", None, None, 500),
    ("de", "quantity", "dotted", r"(\d[\d.]*)\s*(?:Stück|Stk\.?|Einheiten|Fahrzeuge|Anhänger)", *ANY),
    ("de", "quantity", "dotted", r"(?:Menge|Anzahl)[:\s]+(\d[\d.]*)", *ANY),
    ("de", "quantity", "dotted", r"(\d+)\s*x\s*(?:Anhänger|Fahrzeug|Sattelzug)", *ANY),
    ("de", "value", "dots", r"(?:Auftragswert|Schätzwert|Gesamtwert)[^\d]{0,20}(\d[\d.,]+)\s*(?:EUR|€)", 100, None, None),
    ("de", "value", "dots", r"(\d[\d.,]+)\s*EUR\b", 100, None, None),
    ("de", "winner", "text", r"(?:Auftragnehmer|Zuschlag erteilt|Zuschlag an)[:\s]+([^\n]{5,100})", None, None, 100),
    ("de", "duration", "text", r"(?:Laufzeit|Vertragsdauer)[:\s]+([^\n]{3,60})", None, None, 60),
    ("de", "duration", "text", r"(\d+)\s*(?:Monate?|Wochen|Jahre?)", None, None, 60),
    # Danish
    ("da", "title", "text", r"(?:Titel|Overskrift|Udbudsbekendtgoerelse)[:\s]+([^\n]{5,150})", None, None, 150),
    ("da", "title", "text", r"(?:Title|Subject)[:\s]+([^\n]{5,150})", None, None, 150),
    ("da", "authority", "text", r"(?:Ordregiver|Myndighed|Organisation)[:\s]+([^\n]{5,120})", None, None, 120),
    ("da", "authority", "text", r"(?:Contracting authority|Buyer)[:\s]+([^\n]{5,120})", None, None, 120),
    ("da", "date", "date", rf"(?-iu)(?:Offentliggorelsesdato|Dato|Publiceret)[:\s]+{_ISO}", *ANY),
    ("da", "date", "dmy", r"(\d{2}-\d{2}-\d{4})", *ANY),
    ("da", "date", "date", _ISO, *ANY),
    ("da", "reference", "text", r"\b(\d{8}-\d{4})\b", *ANY),
    ("da", "reference", "text", r"(?:Referencenummer|ID)[:\s]+([A-Z0-9/\-_.]{4,40})", *ANY),
    ("da", "description", "text", rf"(?:Beskrivelse|Kort beskrivelse|Resume)[:\s]+(.{{30,500}}?){_UP_TO_PARAGRAPH}", None, None, 400),
    ("da", "description", "text", rf"(?:Description)[:\s]+(.{{30,500}}?){_UP_TO_PARAGRAPH}", None, None, 400),
    ("da", "quantity", "count", r"(\d+)\s*(?:stk\.?|enheder|anhænger|sættevogn|blokvogn)", 1, 10000, None),
    ("da", "quantity", "count", r"(?:Antal|Maengde)[:\s]+(\d+)", 1, 10000, None),
    ("da", "value", "blanks", r"(?:Anslaaet vaerdi|Kontraktvaerdi|Vaerdi)[:\s]+([\d\s,.]+)\s*(?:DKK|kr\.?|EUR)", 100, None, None),
    ("da", "value", "blanks", r"([\d\s]{5,})\s*(?:DKK|kroner)", 100, None, None),
    ("da", "winner", "text", r"(?:Tilbudsgiver|Leverandoer|Tildelingsmodtager)[:\s]+([^\n]{5,120})", None, None, 120),
    ("da", "winner", "text", r"(?:Winner|Awarded to)[:\s]+([^\n]{5,120})", None, None, 120),
    ("da", "duration", "text", r"(?:Kontraktens varighed|Varighed)[:\s]+([^\n]{3,60})", None, None, 60),
    ("da", "duration", "text", r"(\d+)\s*(?:maaneder|uger|aar|dage)", None, None, 60),
    # Spanish
    ("es", "title", "text", r"(?:Objeto del contrato|Nombre del contrato|Denominación)[:\s]+([^\n]{10,200})", None, None, 200),
    ("es", "authority", "text", r"(?:Órgano de contratación|Poder adjudicador|Entidad contratante)[:\s]+([^\n]{5,150})", None, None, 150),
    ("es", "reference", "text", r"(?:Expediente|Número de expediente)[:\s]+([A-Z0-9/\-\.]{4,40})", *ANY),
    ("es", "date", "dmy", r"(?:Fecha de publicación|Fecha)[:\s]+(\d{2}/\d{2}/\d{4})", *ANY),
    ("es", "date", "date", _ISO, *ANY),
    ("es", "description", "block", r"(?:Objeto del contrato|Descripción)[:\s]+(.{30,500}?)(?:\n\n|\n\d|$)", None, None, 500),
    ("es", "value", "dots", r"(?:Valor estimado|Importe estimado|Presupuesto base)[^\d]{0,30}([\d\.,]+)\s*€", *ANY),
    ("es", "quantity", "count", r"(\d+)\s*(?:unidades?|remolques?|vehículo)", 1, 5000, None),
    ("es", "winner", "name", r"(?:Adjudicatario|Empresa adjudicataria)[:\s]+([^\n]{5,120})", None, None, 120),
    ("es", "duration", "text", r"(?:Plazo de ejecución|Duración)[:\s]+([^\n]{3,80})", None, None, 80),
    ("es", "deadline", "dmy", r"(?:Plazo de presentación|Fecha límite)[:\s]+(\d{2}/\d{2}/\d{4})", *ANY),
    # Finnish
    ("fi", "title", "text", r"(?:Hankinnan nimi|Hankintakohde|Ilmoituksen nimi)[:\s]+([^\n]{5,150})", None, None, 150),
    ("fi", "title", "text", r"(?:Subject|Title)[:\s]+([^\n]{5,150})", None, None, 150),
    ("fi", "authority", "text", r"(?:Hankintaviranomainen|Hankintayksikko|Tilaaja)[:\s]+([^\n]{5,120})", None, None, 120),
    ("fi", "authority", "text", r"(?:Contracting authority|Organisation name)[:\s]+([^\n]{5,120})", None, None, 120),
    ("fi", "date", "date", rf"(?-iu)(?:Julkaisupaivamaara|Julkaistu)[:\s]+{_ISO}", *ANY),
    ("fi", "date", "date", _ISO, *ANY),
    ("fi", "date", "dmy", r"(\d{1,2}\.\d{1,2}\.\d{4})", *ANY),
    ("fi", "description", "text", rf"(?:Hankinnan kuvaus|Lyhyt kuvaus|Kuvaus)[:\s]+(.{{30,500}}?){_UP_TO_PARAGRAPH}", None, None, 400),
    ("fi", "description", "text", rf"(?:Description|Short description)[:\s]+(.{{30,500}}?){_UP_TO_PARAGRAPH}", None, None, 400),
    ("fi", "quantity", "count", r"(\d+)\s*(?:kappaletta|kpl\.?|yksikko|ajoneuvo|peravaunu)", 1, 10000, None),
    ("fi", "quantity", "count", r"(?:Maara|Lukumaara)[:\s]+(\d+)", 1, 10000, None),
    ("fi", "value", "blanks", r"(?:Arvioitu arvo|Kokonaisarvo|Hankinnan arvo)[:\s]+([\d\s,]+)\s*(?:EUR|euro)", 100, None, None),
    ("fi", "value", "blanks", r"([\d\s]{5,})\s*(?:EUR|euro)", 100, None, None),
    ("fi", "winner", "text", r"(?:Toimittaja|Voittanut tarjoaja|Sopimuspuoli)[:\s]+([^\n]{5,120})", None, None, 120),
    ("fi", "winner", "text", r"(?:Winner|Successful tenderer|Awarded to)[:\s]+([^\n]{5,120})", None, None, 120),
    ("fi", "duration", "text", r"(?:Sopimuksen kesto|Kesto)[:\s]+([^\n]{3,60})", None, None, 60),
    ("fi", "duration", "text", r"(\d+)\s*(?:kuukautta|viikkoa|vuotta|paivaa)", None, None, 60),
    ("fi", "reference", "text", r"(?:Viite|Hankinnan numero|Diaarinumero|Ilmoitusnumero)[:\s]+([A-Z0-9/\-_.]{4,50})", *ANY),
    ("fi", "reference", "text", r"(?:Notice number|Reference number)[:\s]+([A-Z0-9/\-_.]{4,50})", *ANY),
    # French: the text is a JSON object
    ("fr", "value", "json", "$.CRITERES.VALEUR_ESTIMEE", *ANY),
    ("fr", "value", "json", "$.OBJET.VALEUR_ESTIMEE", *ANY),
    ("fr", "value", "json", "$.ATTRIBUTION.VALEUR_TOTALE", *ANY),
    ("fr", "value", "json", "$.DONNEES.VALEUR", *ANY),
    ("fr", "quantity", "count", r""""QUANTITE"\s*:\s*["']?(\d+)["']?""", 1, 10000, None),
    ("fr", "quantity", "count", r""""QTE"\s*:\s*["']?(\d+)["']?""", 1, 10000, None),
    ("fr", "quantity", "count", r""""NOMBRE"\s*:\s*["']?(\d+)["']?""", 1, 10000, None),
    ("fr", "description", "text", r'"DESCRIPTION"\s*:\s*"([^"]{30,500})"', None, None, 500),
    ("fr", "description", "text", r'"OBJET_MARCHE"\s*:\s*"([^"]{30,500})"', None, None, 500),
    ("fr", "description", "text", r'"NATURE_MARCHE"\s*:\s*"([^"]{10,200})"', None, None, 500),
    ("fr", "duration", "text", r""""DUREE_MARCHE"\s*:\s*["']?(\d+[^"']{0,20})["']?""", None, None, 80),
    ("fr", "duration", "text", r""""DUREE"\s*:\s*["']?(\d+[^"']{0,20})["']?""", None, None, 80),
    # Italian
    ("it", "title", "text", r"(?:Oggetto|Descrizione gara|Denominazione)[:\s]+([^\n]{10,200})", None, None, 200),
    ("it", "title", "text", r"(?:Titolo|Oggetto del contratto)[:\s]+([^\n]{10,200})", None, None, 200),
    ("it", "authority", "text", r"(?:Stazione appaltante|Ente appaltante|Amministrazione aggiudicatrice)[:\s]+([^\n]{5,150})", None, None, 150),
    ("it", "authority", "text", r"(?:Denominazione dell'ente|Acquirente)[:\s]+([^\n]{5,150})", None, None, 150),
    ("it", "reference", "text", r"CIG[:\s]+([A-Z0-9]{8,10})", *ANY),
    ("it", "reference", "text", r"(?:Numero|N\.)[:\s]*([A-Z0-9]{8,12})", *ANY),
    ("it", "date", "dmy", r"(?:Data di pubblicazione|Pubblicato il|Data)[:\s]+(\d{2}/\d{2}/\d{4})", *ANY),
    ("it", "date", "dmy", r"(\d{2}/\d{2}/\d{4})", *ANY),
    ("it", "date", "date", _ISO, *ANY),
    ("it", "description", "block", r"(?:Oggetto del contratto|Descrizione|Oggetto della gara)[:\s]+(.{30,500}?)(?:\n\n|\n\d|$)", None, None, 500),
    ("it", "description", "block", rf"(?:Oggetto|Object)[:\s]+(.{{30,500}}?){_UP_TO_PARAGRAPH}", None, None, 500),
    ("it", "value", "dots", r"(?:Importo|Valore stimato|Importo a base d'asta)[^\d]{0,30}([\d\.,]+)\s*(?:€|EUR|euro)", 100, None, None),
    ("it", "value", "dots", r"(?:Importo complessivo)[^\d]{0,20}([\d\.,]+)", 100, None, None),
    ("it", "quantity", "count", r"(\d+)\s*(?:unità|rimorchi|veicoli|sistemi)", 1, 5000, None),
    ("it", "quantity", "count", r"(?:Quantità|Numero di unità)[:\s]+(\d+)", 1, 5000, None),
    ("it", "quantity", "count", r"n\.\s*(\d+)\s*(?:rimorchi|veicoli)", 1, 5000, None),
    ("it", "winner", "name", r"(?:Aggiudicatario|Impresa aggiudicataria|Appaltatore)[:\s]+([^\n]{5,120})", None, None, 120),
    ("it", "winner", "name", r"(?:Contraente|Fornitore selezionato)[:\s]+([^\n]{5,120})", None, None, 120),
    ("it", "duration", "text", r"(?:Durata del contratto|Durata|Periodo di esecuzione)[:\s]+([^\n]{3,80})", None, None, 80),
    ("it", "duration", "text", r"(\d+)\s*(?:mesi|settimane|anni|giorni)", None, None, 80),
    ("it", "deadline", "dmy", r"(?:Termine per la presentazione|Scadenza|Data di scadenza)[:\s]+(\d{2}/\d{2}/\d{4})", *ANY),
    ("it", "deadline", "dmy", r"(?:Termine|Deadline)[:\s]+(\d{2}/\d{2}/\d{4})", *ANY),
    # Polish
    ("pl", "authority", "text", r"(?:Zamawiający|Nazwa zamawiającego)[:\s]+([^\n]{5,100})", *ANY),
    ("pl", "authority", "text", r"(?:Instytucja zamawiająca)[:\s]+([^\n]{5,100})", *ANY),
    ("pl", "date", "date", rf"(?-iu)(?:Data publikacji|Data ogłoszenia)[:\s]+{_ISO}", *ANY),
    ("pl", "date", "date", _ISO, *ANY),
    ("pl", "date", "dmy", r"(\d{2}\.\d{2}\.\d{4})", *ANY),
    ("pl", "description", "block", r"4\.5\.1\.\)[^\n]*\n(.{20,600}?)(?:\n4\.|$)", None, None, 400),
    ("pl", "description", "block", r"(?:Krótki opis|Przedmiot zamówienia|Opis zamówienia)[:\s]+(.{30,500}?)(?:\n\d|\n\n|$)", None, None, 400),
    ("pl", "quantity", "count", r"(\d[\d\s]*)\s*(?:sztuk|szt\.?|egzemplarz|egz\.|komplet|zestawów)", 1, 10000, None),
    ("pl", "quantity", "count", r"(?:Ilość|Liczba)[:\s]+(\d[\d\s]*)", 1, 10000, None),
    ("pl", "quantity", "count", r"(\d+)\s*(?:przyczepa|naczepa|pojazd|szt)", 1, 10000, None),
    ("pl", "value", "blanks", r"4\.3\.\)[^\n]*zamówienia[:\s]*([\d\s]+)\s*PLN", 100, None, None),
    ("pl", "value", "blanks", r"8\.2\.\)[^\n]*umow[^\n]*:\s*([\d\s,.]+)\s*PLN", 100, None, None),
    ("pl", "value", "blanks", r"(?:Wartość zamówienia|Szacunkowa wartość|Łączna wartość)[^\d]{0,20}([\d\s,.]+)\s*(?:PLN|zł)", 100, None, None),
    ("pl", "winner", "name", r"7\.3\.1\)[^\n]*zamówienia[:\s]+([^\n]{5,120})", None, None, 120),
    ("pl", "winner", "name", r"(?:Nazwa \(firma\) wykonawcy)[^\n]*:\s+([^\n]{5,120})", None, None, 120),
    ("pl", "winner", "name", r"(?:Nazwa wykonawcy|Wybrany wykonawca)[:\s]+([^\n]{5,100})", None, None, 120),
    ("pl", "duration", "text", r"8\.3\.\)[^\n]*realizacji[^\n]*:\s+([^\n]{3,80})", None, None, 80),
    ("pl", "duration", "text", r"(?:Okres realizacji|Czas trwania zamówienia)[:\s]+([^\n]{3,60})", None, None, 80),
    ("pl", "duration", "text", r"(\d+)\s*(?:miesięcy|miesiące|tygodni|lat|dni)", None, None, 80),
    ("pl", "reference", "text", r"(?:Numer ogłoszenia|Nr ogłoszenia)[:\s]+(20\d\d/BZP\s[\d/]+)", *ANY),
    ("pl", "reference", "text", r"(20\d\d/BZP\s[\d]+(?:/\d+)?)", *ANY),
    ("pl", "reference", "text", r"(?:Numer referencyjny)[:\s]+([A-Z0-9/\-_.]{4,40})", *ANY),
    # Swedish
    ("sv", "title", "text", r"(?:Rubrik|Upphandlingsföremål|Titel)[:\s]+([^\n]{5,150})", None, None, 150),
    ("sv", "title", "text", r"(?:Subject|Title)[:\s]+([^\n]{5,150})", None, None, 150),
    ("sv", "authority", "text", r"(?:Upphandlande myndighet|Organisation|Myndighet)[:\s]+([^\n]{5,120})", None, None, 120),
    ("sv", "authority", "text", r"(?:Contracting authority|Buyer)[:\s]+([^\n]{5,120})", None, None, 120),
    ("sv", "authority", "text", r"(?:Köpare|Beställare)[:\s]+([^\n]{5,120})", None, None, 120),
    ("sv", "date", "date", rf"(?-iu)(?:Publiceringsdatum|Publicerad)[:\s]+{_ISO}", *ANY),
    ("sv", "date", "date", _ISO, *ANY),
    ("sv", "date", "dmy", r"(\d{1,2}/\d{1,2}/\d{4})", *ANY),
    ("sv", "description", "text", rf"(?:Kort beskrivning|Beskrivning|Föremål)[:\s]+(.{{30,500}}?){_UP_TO_PARAGRAPH}", None, None, 400),
    ("sv", "description", "text", rf"(?:Description|Short description)[:\s]+(.{{30,500}}?){_UP_TO_PARAGRAPH}", None, None, 400),
    ("sv", "quantity", "count", r"(\d+)\s*(?:stycken|st\.?|fordon|ekipage|släpvagn)", 1, 10000, None),
    ("sv", "quantity", "count", r"(?:Antal|Kvantitet)[:\s]+(\d+)", 1, 10000, None),
    ("sv", "value", "blanks", r"(?:Uppskattad value|Kontraktsvärde|Värde)[:\s]+([\d\s]+)\s*(?:SEK|kr)", 100, None, None),
    ("sv", "value", "blanks", r"([\d\s]{5,})\s*(?:SEK|kronor)", 100, None, None),
    ("sv", "winner", "text", r"(?:Leverantör|Tilldelad|Vinnande)[:\s]+([^\n]{5,120})", None, None, 120),
    ("sv", "winner", "text", r"(?:Winner|Awarded to|Contractor)[:\s]+([^\n]{5,120})", None, None, 120),
    ("sv", "duration", "text", r"(?:Kontraktslängd|Avtalstid|Löptid)[:\s]+([^\n]{3,60})", None, None, 60),
    ("sv", "duration", "text", r"(\d+)\s*(?:månader|veckor|år|dagar)", None, None, 60),
    ("sv", "reference", "text", r"\b(\d{2}FMV[A-Z0-9]+)\b", *ANY),
    ("sv", "reference", "text", r"\b(\d{6}-\d{4})\b", *ANY),
    ("sv", "reference", "text", r"(?:Referensnummer|Diarienummer|Dnr)[:\s]+([A-Z0-9/\-_.]{4,40})", *ANY),
)
