"""Miners on single texts: forms, bounds, guards and what stands around a match."""

import datetime

from pyspark.sql import functions as F

from noticelake.functions import mining

DAY = datetime.date(2026, 5, 1)
LOWBED = "A requirement to procure Qty 27 Lowbed Trailers for delivery to various bases. The requested delivery date is 120 days after contract award."
KITCHEN = "File Number: W8486-260442/A/SV NOTICE. The delivery is requested at Montreal & Edmonton by December 7 2026. Item 1, NSN: 21-8969342: JACK. Part No.: 8476207-1 NSCM/CAGE: 35907 Quantity: 10 Unit of Issue: Each"


def every(spark, raws, f):
    rows = spark.createDataFrame(list(enumerate(raws)), "k int, t string").coalesce(1).select("k", f(F.col("t")).alias("v")).collect()
    return [r.v for r in sorted(rows, key=lambda r: r.k)]


def one(spark, raw, f):
    return every(spark, [raw], f)[0]


QUANTITIES = [
    (LOWBED, 27), (KITCHEN, 10), ("Supply of 480 units of axles.", 480), ("Beschaffung von 50 Stück Anhängern.", 50), ("15 sztuk", 15), ("počet ks: 8", 8), ("22 kusů", 22),
    ("КІЛЬКІСТЬ: 22", 22), ("5 шт.", 5), ("antal 9", 9), ("aantal: 4", 4), ("ILOŚĆ: 7", 7), ("quantità 3", 3), ("a quantity of 12", 12), ("nombre de 6", 6), ("a total of 31 pieces", 31),
    ("File Number: 12345 Item NSN: 21-8969342 Part No.: 1234", None), ("contract no 99, 5 units", None), ("Quantity: 999999 units", None), ("qty 10001", None), ("qty 0, 3 units", 3), ("software services", None), ("", None), (None, None),
]


def test_quantity(spark):
    got = every(spark, [raw for raw, _ in QUANTITIES], mining.mined_quantity)
    assert [(raw, g and g.value) for (raw, _), g in zip(QUANTITIES, got, strict=True)] == QUANTITIES


def test_quantity_tells_where_it_was_found(spark):
    got = one(spark, LOWBED, mining.mined_quantity)
    assert (got.pattern, got.match) == ("qty_en_inline", "Qty 27") and "Lowbed" in got.fragment
    text = "é" * 100 + " 3 units " + "z" * 100
    assert one(spark, text, mining.mined_quantity).fragment == "é" * 59 + " 3 units " + "z" * 59


def test_words_that_patterns_need(spark):
    assert mining.needed_words(r"\b(?:Qty\.?|number)\s+([0-9]+)\s*(?:STÜCK)?") == ("number", "qty")
    assert mining.needed_words(r"(?:period|term)\s+of\s+([0-9]+)\s+Monate?\b") == ("monat",) and mining.needed_words(r"x?([0-9]+)|units") == ()
    odd = ["QUANT\u0130TY: 5", "quant\u0131ty: 6", "12 unit\u017f", "8 \u017ftk", "9 \u212as", "7 STÜC\u212a", "\U0001f69a 3 units \U0001f69a"]
    got = every(spark, odd, mining.mined_quantity)
    assert [g and g.value for g in got] == [5, 6, 12, 8, 9, 7, 3] and got[-1].fragment == odd[-1]


def test_mined_once_for_all_its_uses(spark):
    m = spark.createDataFrame([("Qty 5",)], "t string").select(mining.mined(F.col("t"), F.lit(DAY)).alias("m")).select("m.quantity.value", "m.deadline.value", "m.duration.value", "m.deadline.pattern")
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("dl_de_bis_zum_dotted") == 1


DEADLINES = [
    (LOWBED, "2026-08-29"), (KITCHEN, "2026-12-07"), ("Delivery deadline 2026-09-15.", "2026-09-15"), ("Lieferung bis 31.12.2026 nach Bonn.", "2026-12-31"), ("bis zum 3. März 2027", "2027-03-03"),
    ("by 11-Apr-2026", "2026-04-11"), ("before 11/04/2026", "2026-04-11"), ("by July 7, 2026", "2026-07-07"), ("by Smarch 7, 2026, within 10 days of award", "2026-05-11"), ("by 2026-02-30", None),
    ("2 months after signing", "2026-06-30"), ("30 Tage nach Zuschlag", "2026-05-31"), ("10 jours après la notification", "2026-05-11"), ("delivery is required within 9 days", "2026-05-10"), ("none", None), (None, None),
]


def test_deadline(spark):
    got = every(spark, [raw for raw, _ in DEADLINES], lambda c: mining.mined_deadline(c, F.lit(DAY)))
    assert [(raw, g and str(g.value)) for (raw, _), g in zip(DEADLINES, got, strict=True)] == DEADLINES


def test_deadline_without_an_anchor(spark):
    got = one(spark, "within 30 days of the award", lambda c: mining.mined_deadline(c, F.lit(None).cast("date"), F.lit(DAY)))
    assert (got.value, got.approximate, got.offset) == (datetime.date(2026, 5, 31), True, 30)
    assert not one(spark, LOWBED, lambda c: mining.mined_deadline(c, F.lit(DAY))).approximate


LENGTHS = [("The contract duration: 48 months", 48), ("A 2 years and 6 months contract.", 30), ("Vertragsdauer: 36 Monate", 36), ("durée du marché : 12 mois", 12), ("period of 700 months", None), ("24 months", None), ("", None), (None, None)]


def test_duration(spark):
    got = every(spark, [raw for raw, _ in LENGTHS], mining.mined_duration)
    assert [(raw, g and g.value) for (raw, _), g in zip(LENGTHS, got, strict=True)] == LENGTHS


PROFILES = [
    (None, "Rahmenvertrag, 4 Jahre, with option", ("framework_agreement", 48, True)), ("FA-MIX", "annual", ("framework_agreement", None, False)), ("none", "annual service", ("recurring", None, False)),
    (None, "supply of 3 tanks, 2.5 months", ("one_time", 2, False)), (None, "frameworks annually 0.1 month", ("recurring", 1, False)), (None, "12 месяц, 2 ans", ("one_time", 24, False)), (None, None, ("one_time", None, False)),
]


def test_contract_profile(spark):
    rows = spark.createDataFrame([(k, c, t) for k, (c, t, _) in enumerate(PROFILES)], "k int, c string, t string")
    got = rows.select("k", mining.contract_profile(F.col("c"), F.col("t")).alias("v")).collect()
    assert [tuple(r.v) for r in sorted(got, key=lambda r: r.k)] == [want for *_, want in PROFILES]
