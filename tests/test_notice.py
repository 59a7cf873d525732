"""Canonical notices and what is made of them."""

from pyspark.sql import functions as F

from noticelake.operators import notice

SCHEMA = "id string, title map<string,string>, description map<string,string>, buyer string, country string, codes array<string>, pub string, due string, amount double, currency string, winner string, source string"
ROWS = [
    ("1-2024", {"deu": "Anhänger", "eng": " Low  bed "}, {"fra": "texte"}, "Army\nArmy", "DEU\nDEU", ["34220000", "34220000"], "2024-01-02+01:00", None, 5.0, None, None, "ted"),
    ("2-2024", {"xx": "only"}, None, "", None, None, "garbage", "2024-05-01", 0.01, "USD", "Winner Ltd\nsecond", "ted"),
]


def notices(spark):
    return notice.canonical(spark.createDataFrame(ROWS, SCHEMA), "id", "title", "description", "buyer", "country", "codes", "pub", "due", "amount", "currency", "winner", "source")


def test_canonical(spark):
    a, b = notices(spark).orderBy("notice_id").collect()
    assert (a.title, a.description, a.authority.name, a.authority.country, a.codes, a.published) == ("Low bed", "texte", "Army", "DEU", ["34220000"], "2024-01-02")
    assert (a.value.amount, a.value.currency, a.award.awarded) == (5.0, "EUR", False)
    assert (b.title, b.authority.name, b.codes, b.published, b.deadline, b.value) == ("only", None, [], None, "2024-05-01", None)
    assert (b.award.awarded, b.award.winner) == (True, "Winner Ltd")


def test_output_rows(spark):
    n = notices(spark)
    sheet = notice.sheet_rows(n, F.lit("Open"), F.col("value.amount")).orderBy("notice_id").collect()
    assert str(sheet[0].published) == "2024-01-02" and sheet[1].value_eur is None
    front = notice.frontend_rows(n, F.lit("Open"), F.col("value.amount")).orderBy("id").collect()
    assert front[1].value_eur == 0.0 and front[0].deadline is None


def test_awards_documents_and_parties(spark):
    n = notices(spark)
    cache = spark.createDataFrame([("1-2024", "2-2024", 80), ("1-2024", "9-2024", 60)], "k string, m string, c int")
    assert [tuple(r) for r in notice.best_cached_award(cache, n, "k", "m", "c").collect()] == [("1-2024", "Winner Ltd")]
    refs = spark.createDataFrame([("1", "u1", 1), ("1", "u2", 2), ("1", "u3", 3)], "n string, u string, o int")
    texts = spark.createDataFrame([("u1", "short"), ("u2", "x" * 300), ("u3", "y" * 300)], "u string, t string")
    assert [r.u for r in notice.first_usable_document(refs, texts, "n", "u", "o", "t").collect()] == ["u2"]
    df = spark.createDataFrame([([("A", ["supplier"]), ("B", ["buyer", "procuringEntity"])], [("CPV", "1"), ("UNSPSC", "2")])], "p array<struct<name:string,roles:array<string>>>, i array<struct<scheme:string,id:string>>")
    r = df.select(notice.party_with_role(F.col("p"), "buyer")["name"].alias("a"), notice.code_of_scheme(F.col("i"), "UNSPSC").alias("b"), notice.code_of_scheme(F.col("i"), "none").alias("c")).first()
    assert tuple(r) == ("B", "2", None)


def test_listing_confirmation_and_two_stages(spark):
    known = spark.createDataFrame([("DE", k, f"2024-01-0{k}", "heavy low bed trailer" if k == 3 else "other words entirely") for k in range(1, 8)], "c string, id int, d string, t string")
    listing = spark.createDataFrame([("DE", "Heavy LOW bed trailers"), ("FR", "other words entirely")], "c string, title string")
    got = {r.id: r.confirmed for r in notice.confirmed_by_listing(known, listing, "c", "id", "d", "t", "title").collect()}
    assert got == {3: True, 4: False, 5: False, 6: False, 7: False}
    detail = known.select("id", F.col("t").alias("text"))
    out = notice.two_stage(known.select("c", "id"), detail, "id", F.col("c") == "DE", F.col("text").contains("low"))
    assert [r.id for r in out.collect()] == [3]


def test_hosts_and_eval(spark):
    df = spark.createDataFrame([("www.evergabe.example.de",), ("tenders.gov",)], "h string")
    assert [r[0] for r in df.select(notice.country_of_host(F.col("h"), {"tenders": "AU"})).collect()] == ["DE", "AU"]
    assert [r[0] for r in df.select(notice.text_eval(F.col("h"), ["EVERGABE", "de"], ["gov"])).collect()] == [1.0, 0.0]
