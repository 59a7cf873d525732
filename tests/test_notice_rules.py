"""Cases of the rules on dates, sources of dates, specs, upkeep, terms and decisions."""

import datetime

import pytest
from pyspark.sql import functions as F

from noticelake.functions import notice_rules as N
from noticelake.functions import text as T
from noticelake.operators import metrics, portals


def each(spark, rows, schema, make):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(make).collect()]


@pytest.mark.parametrize("form, cases", [
    ("mail", {"Wed, 01 Apr 2026 00:00:00 GMT": "2026-04-01", "1 Jan 2024 10:00": "2024-01-01", "April 2026": None, "": None}),
    ("dashed", {"11-May-2026 10:00 am": "2026-05-11", "1-Apr-2026": "2026-04-01", "01 Apr 2026": "2026-04-01", "1-Xyz-2026": "2026-00-01", "01 Apr 2026 10:00": None, "": None}),
    ("leading", {"2026-04-01T10:00": "2026-04-01", "01.04.2026 12:00": "2026-04-01", "am 01.04.2026": None}),
    ("dotted", {"am 1.4.2026": "2026-04-01", "1/4/2026": None}),
])
def test_portal_dates(spark, form, cases):
    assert each(spark, [(c,) for c in cases] + [(None,)], "x string", N.portal_date(F.col("x"), form)) == [*cases.values(), None]


def test_plain_dates(spark):
    d = datetime.date(2024, 1, 31)
    cases = {"2024-01-31": d, "2024-01-31+01:00": d, "2024-01-31Z": d, "2024-01-31T10:00:00+02:00": d, "20240131": d, " 2024-01-31 ": d, "2024-02-30": None, "2024-01-31 10:00": None, "None": None, "": None}
    assert each(spark, [(c,) for c in cases], "x string", N.plain_date(F.col("x"))) == list(cases.values())


def test_date_sources(spark):
    rows = [("tender_notice", "X", None), (None, "CA-1", None), ("", "AU-CN1", None), ("unknown", "AU-AT-1", None), (None, "UK-FTS-1", None), (None, "NATO-7", None), (None, "1-2024", "CAN standard"), (None, "1-2024", "PIN only"), (None, "1-2024", None), (None, "SE-1", None), (None, None, None)]
    assert each(spark, rows, "k string, i string, t string", N.date_source(F.col("k"), F.col("i"), F.col("t"))) == ["tender_notice", "tender_notice", "contract_notice_fallback", "tender_notice", "tender_notice", "tender_notice", "contract_notice_fallback", "pin_notice", "tender_notice", "unknown", "unknown"]


def test_upkeep(spark):
    long = "This is sentence one. This is sentence two. This is sentence three. This is sentence four. This is sentence five."
    rows = [(None, None), ("", "x"), ("Amendment 5", None), ("Short text.", "Short text."), (long, None), ("A weight of 3.5 tonnes and 12.5 metres.", long)]
    assert each(spark, rows, "d string, s string", N.needs_cleaning(F.col("d"), F.col("s"))) == [True, True, True, False, True, False]
    rows = [("w", 5.0, 1), (None, 5.0, 1), ("", 5.0, 1), ("w", 0.01, 1), ("w", None, 1), ("w", 5.0, None), ("w", 5.0, 0)]
    assert each(spark, rows, "w string, a double, q int", N.needs_enrichment(F.col("w"), F.col("a"), F.col("q"))) == [False, True, True, True, True, True, False]
    assert each(spark, [("", None, "0", "x")], "a string, b int, c string, d string", N.gaps(F.col("a"), F.col("b"), F.col("c"), F.col("d"))) == [3]


def test_specs(spark):
    schema = "s struct<type:string,axle_load_t:double,payload_t:double,mass_t:double,length_mm:double,width_mm:double,height_mm:double>, k string, d string"
    rows = [(("2-axle flatbed", 9.0, 3.5, 9.0, 6000.0, 2500.0, None), None, None), ((None, 9.0, None, 7.2, 6000.0, 0.0, None), None, "an MRAP carrier"), (None, "3.5t 2-axle cargo trailer", "x" * 500 + " ballistic"), (None, "750 kg box", "armored"), (None, None, None), (None, "trailer tank", None)]
    got = [tuple(x) for x in each(spark, rows, schema, N.lifted_specs(F.col("s"), F.col("k"), F.col("d")))]
    assert got == [("2-axle", 3500, "6000mm × 2500mm", None), ("single-axle", 7200, None, "armoured"), ("2-axle", 3500, None, None), (None, 750, None, "armoured"), (None, None, None, None), (None, None, None, None)]


def test_decisions(spark):
    kind = "array<struct<type:string,category:string,quantity:int>>"
    schema = f"r struct<slots:{kind},type:string,category:string,quantity:int>, k {kind}"
    rows = [(([("low", "", None), ("tank", "c", 4)], None, None, None), [("x", "y", 9), (None, None, 8), (None, None, 7)]), ((None, "old", "c", None), [("x", "y", 9), ("z", None, 8)]), ((None, "", None, 3), None)]
    got = [[tuple(s) for s in x] for x in each(spark, rows, schema, N.applied_slots(F.col("r"), F.col("k")))]
    assert got == [[("low", None, 9), ("tank", "c", 4), (None, None, 7)], [("old", "c", 9), (None, None, None), (None, None, None)], [(None, None, 3), (None, None, None), (None, None, None)]]
    now = datetime.datetime(2024, 2, 1)
    entries = [(("h", "m", now, "s"), False), (("g", "m", now, "s"), False), (("h", "n", now, "s"), False), (("h", "m", now - datetime.timedelta(days=30), "s"), False), (("h", "m", None, "s"), False), (("h", "m", now, None), True), (("h", "m", now, "best"), True), ((None, None, now, "s"), None)]
    stale = N.is_stale(F.col("e"), F.lit("h"), "m", F.lit("2024-02-01 00:00:00").cast("timestamp"), 30, F.col("b"), "best")
    assert each(spark, entries, "e struct<hash:string,model:string,checked_at:timestamp,source:string>, b boolean", stale) == [False, True, True, True, True, True, False, False]


def test_terms_and_urls(spark):
    got = [tuple(x) for x in each(spark, [(" ",), ("abc",), ("Tank",), ("known",), ("low bed",), ("trailer",), ("axle",)], "t string", N.curated(F.col("t"), ("tank",), F.col("t") == "known"))]
    assert got == [(False, "empty"), (False, "length <4 (3)"), (False, "stoplist"), (False, "already in settings"), (True, "multi-word phrase"), (True, "single word ≥6 chars (7)"), (True, "borderline single word (4 chars)")]
    assert N.merged_terms({"a": ["x", "y"]}, {"a": ["y", "z"], "b": ["w", "x"]}, ["X"]) == {"a": ["y", "z"], "b": ["w"]}
    assert each(spark, [("www.a", None, "http://c"), ("https://a", "http://b", None), (None, None, "c")], "a string, b string, c string", N.candidate_url(F.col("a"), F.col("b"), F.col("c"))) == ["http://c", "https://a", None]
    assert each(spark, [("The tank and the TRAILER of 3",)], "t string", T.tokens_without(F.col("t"), ["the", "and"])) == [["tank", "trailer"]]
    assert spark.createDataFrame([(1_000_000, 500_000), (1_000_000, 0)], "i long, o long").agg(metrics.token_cost(F.col("i"), F.col("o"), 3.0, 15.0)).first()[0] == 13.5


def test_portals_fall_back_by_source(spark):
    rows = [(1, "NO-DF", "army", "truck"), (2, "NO-DF", "army", "x"), (3, "EE-RP", "army", "x"), (4, "EE-RP", "army", "truck"), (5, "IT-AN", "none", "x"), (6, "AU-TEN", "none", "truck"), (7, "AU-TEN", "army", "x"), (8, "ES-PL", None, "x"), (9, "ES-PL", "none", "x"), (10, "XX", "army", "truck"), (11, "DE-SB", "none", None)]
    df = spark.createDataFrame([(*r, "the vsv" if r[0] == 11 else None, ["3422"] if r[0] == 6 else None) for r in rows], "id int, s string, buyer string, title string, snippet string, codes array<string>")
    rules = portals.portal_table(spark, {"*": ("Army",)}, {"*": ("Truck",)}, ("342",), {"DE-SB": "vsv"})
    run = lambda d: {(r.id, r.confidence) for r in portals.wanted_listings(d, rules, "s", "buyer", "title", "snippet", "codes").collect()}
    assert run(df) == {(1, "high"), (4, "high"), (5, "high"), (6, "medium"), (8, "high"), (11, "high")}
    assert run(df.where("id <> 1")) >= {(2, "high")}


def test_portal_words_stand_within_one_field(spark):
    rows = [(1, "AU-AT", "x", "under the", "sea"), (2, "AU-AT", "x", "the sea", ""), (3, "LT-CV", "army the", "a", "b"), (4, "LV-IUB", "the army", "a", None), (5, "BE-EP", "of ar", "my the sea", None), (6, "BE-EP", None, "the army", None)]
    df = spark.createDataFrame([(*r, None) for r in rows], "id int, s string, buyer string, title string, snippet string, codes array<string>")
    rules = portals.portal_table(spark, {"*": ("army", "ar m")}, {"*": ("the ",)}, ())
    assert {r.id for r in portals.wanted_listings(df, rules, "s", "buyer", "title", "snippet", "codes").collect()} == {2, 4, 6}


def test_titles_ids_and_gathering(spark):
    rows = [("Sweden - Aircraft Maintenance Trailers", "Sweden"), ("Belgium Defence - 780 Military Trailers", "Belgium"), ("Netherlands Ministry of Defence – Low beds", "Netherlands"), ("czechia - Cisterny polni", "Czech Republic"), ("UK - Short", "United Kingdom"), ("Sweden-Trailers of all kinds", "Sweden"), ("Unknown - title of that", "Unknown"), ("A (b) - something long", "A (b)"), ("x", None), (None, "Sweden")]
    assert each(spark, rows, "t string, c string", N.without_country(F.col("t"), F.col("c"))) == ["Aircraft Maintenance Trailers", "780 Military Trailers", "Low beds", "Cisterny polni", "UK - Short", "Sweden-Trailers of all kinds", "Unknown - title of that", "something long", "x", None]
    assert each(spark, [("1", "UA"), ("UA-1", "UA"), ("", "UA"), (None, "UA")], "r string, c string", N.prefixed_id(F.col("r"), F.col("c"))) == ["UA-1", "UA-1", "", ""]
    parties = [("Army", ["BUYER"]), ("Firm", ["supplier"]), ("Office", ["procuringEntity"]), (None, ["buyer"])]
    assert each(spark, [("a", None, "b", parties), (None, "", None, None)], "x string, y string, b string, p array<struct<name:string,roles:array<string>>>", N.buyer_names([F.col("x"), F.col("y")], F.col("b"), F.col("p"))) == [["a", "b", "Army", "Office"], []]
    items = [(("cpv", "7"), [("CPV", "8"), ("X", "9")]), (("CPV", None), None)]
    schema = "a string, b string, i array<struct<classification:struct<scheme:string,id:string>,more:array<struct<scheme:string,id:string>>>>"
    assert each(spark, [("1 2", "2 3 ", items), (None, None, None)], schema, N.gathered_codes(F.col("a"), F.col("b"), F.col("i"))) == [["1", "2", "3", "7", "8"], []]
