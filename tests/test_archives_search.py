"""Archives, XML notices, recorded searches and state, on files that the tests write."""

import datetime
import glob
import json
import os
import time
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from noticelake.operators import metrics
from noticelake.sources import archives, search, xml_notices
from noticelake.streaming import state


@pytest.fixture
def yearly(tmp_path):
    for year, name, head in ((2020, "CPV", "ID_NOTICE_CN,CPV,TITLE"), (2021, "cpv_code", "ID_NOTICE_CN,cpv_code,title")):
        with zipfile.ZipFile(tmp_path / f"{year}.zip", "w", zipfile.ZIP_DEFLATED if year == 2020 else zipfile.ZIP_STORED) as z:
            for part in (1, 2):
                rows = "".join(f'{year}{part}{k:04d},{34220000 + k % 3},"line one\nTrailer ""{k}"" é"\n' for k in range(2000))
                z.writestr(f"data/part{part}.CSV", ("﻿" + head + "\n" + rows).encode())
            z.writestr("readme.txt", "none")
    return {y: str(tmp_path / f"{y}.zip") for y in (2020, 2021)}


def test_yearly_archives(spark, yearly, tmp_path):
    names = {"id": ["ID_NOTICE_CN"], "code": ["CPV", "cpv_code"], "title": ["TITLE", "title"]}
    all_rows = archives.yearly_archives(spark, yearly, names)
    assert all_rows.count() == 8000 and all_rows.where("title NOT LIKE '%\"%\" é'").count() == 0
    keep = archives.wanted_by_codes_or_words([F.col("code")], F.col("title"), F.lit(None), ("34220002",), ("none",))
    (tmp_path / "2019.zip").write_bytes(b"no archive")
    some = archives.yearly_archives(spark, {**yearly, 2019: str(tmp_path / "gone.zip")}, names, keep, since=2021)
    assert some.select("year").distinct().collect()[0].year == 2021 and some.count() == 2 * sum(k % 3 == 2 for k in range(2000))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "2021.zip" in plan and "2020.zip" not in plan
    members = archives.archive_members(spark, list(yearly.values()), "*.csv", spread=4)
    assert members.count() == 4 and members.rdd.getNumPartitions() == 4
    assert archives.archive_members(spark, str(tmp_path / "2019.zip")).count() == 0


def test_ids_and_catalogue(spark):
    df = spark.createDataFrame([("2023423", None), ("x", "ted?uri=TED:NOTICE:7-2022:TEXT"), (" 2021 ", None), ("20x1234", "")], "i string, u string")
    assert [r[0] for r in df.select(archives.api_id(F.col("i"), F.col("u"))).collect()] == ["423-2023", "7-2022", "2021", "20x1234"]
    titles = spark.createDataFrame([("Contract notices 2020", "a"), ("Contract award notices 2020", "b"), ("Contract notices 2021 *deprecated", "c"), ("Contract notices 2009-2015", "d"), ("Contract notice 2022", ""), ("Contract notices 2023", "e")], "t string, u string")
    assert {tuple(r) for r in archives.catalogue(titles, "t", "u", "notices").collect()} == {(2020, "a"), (2023, "e")}
    assert {tuple(r) for r in archives.catalogue(titles, "t", "u", "awards").collect()} == {(2020, "b")}


def test_documents_and_spreadsheets(spark, tmp_path):
    w = 'xmlns:w="urn:w"'
    cell = lambda t: f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    body = f"<w:document {w}><w:body><w:p><w:r><w:t>First </w:t><w:tab/><w:t>line</w:t></w:r></w:p><w:tbl><w:tr>{cell('a')}{cell(' ')}{cell('b')}</w:tr></w:tbl><w:p/><w:p><w:r><w:t>Last</w:t></w:r></w:p></w:body></w:document>"
    for name, xml in (("a", body), ("broken", "<w")):
        with zipfile.ZipFile(tmp_path / f"{name}.docx", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("word/document.xml", xml)
    parts = archives.document_parts(spark, str(tmp_path / "*.docx"))
    assert [tuple(r)[1:] for r in parts.orderBy("place").collect()] == [(0, "paragraph", "First \tline"), (1, "paragraph", "Last"), (2, "row", "a | b")]
    assert archives.document_texts(parts, 8).first().text == "First li\n[… truncated at 8 chars]"
    sheet = '<worksheet xmlns="u"><sheetData><row r="4"><c r="A4" t="s"><v>0</v></c><c r="C4" t="s"><v>1</v></c></row><row r="5"><c r="A5" t="inlineStr"><is><t>T-1</t></is></c><c r="C5"><v>7.5</v></c></row><row r="6"><c r="C6"><v>8</v></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="u"><si><t>Tender</t><t> ID</t></si><si><t>Value</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    rows = archives.spreadsheet_rows(spark, str(tmp_path / "b.xlsx"))
    assert [(r.row, r.cells) for r in rows.orderBy("row").collect()] == [(4, ["Tender ID", None, "Value"]), (5, ["T-1", None, "7.5"]), (6, [None, None, "8"])]
    assert [(r["Tender ID"], r.Value, r.more) for r in archives.with_header(rows, 4, ["Tender ID", "Value", "more"], "Tender ID").collect()] == [("T-1", "7.5", None)]


EFORM = """<?xml version="1.0"?><ContractNotice xmlns="urn:n" xmlns:a="urn:a" xmlns:b="urn:b"><b:ID> u-1 </b:ID><b:ContractFolderID>f-1</b:ContractFolderID><a:ContractingParty><b:BuyerProfileURI>www.x.org/profil/1</b:BuyerProfileURI></a:ContractingParty>
<a:Lot><a:Party><b:ID>wrong</b:ID></a:Party></a:Lot><a:ProcurementProject><b:Name>n</b:Name><a:Deep><b:ID></b:ID><b:ID>R 7</b:ID></a:Deep></a:ProcurementProject>{more}<a:TenderRecipientParty><b:EndpointID>https://e</b:EndpointID></a:TenderRecipientParty></ContractNotice>"""
LEGACY = '<TED_EXPORT xmlns="r" DOC_ID="d-1"><A><URL_GENERAL>www.g.org</URL_GENERAL><NO_DOC_OJS>2022/S 1-2</NO_DOC_OJS><URL_PARTICIPATION>http://p</URL_PARTICIPATION></A></TED_EXPORT>'


def first_text(root, path):
    """All elements in document order, the first with text whose ancestors hold the path's other names in order."""
    def walk(e, above):
        name = e.tag.rsplit("}", 1)[-1]
        names = iter(above)
        if name == path[-1] and all(p in names for p in path[:-1]) and (e.text or "").strip():
            return e.text.strip()
        for c in e:
            if (found := walk(c, [*above, name])) is not None:
                return found
        return None

    return walk(root, [])


def test_xml_notices(spark):
    call = "<a:CallForTendersDocumentReference><a:Attachment><a:ExternalReference><b:URI>docs.org/1</b:URI></a:ExternalReference></a:Attachment></a:CallForTendersDocumentReference>"
    docs = [EFORM.format(more=call), EFORM.format(more=""), LEGACY, "<broken", "", None]
    df = spark.createDataFrame(list(enumerate(docs)), "k int, x string")
    got = [tuple(r)[2:] for r in xml_notices.notice_fields(df, "x").orderBy("k").collect()]
    profile = "https://www.x.org/profil/1"
    assert got[0] == ("R 7", "https://docs.org/1", profile, "https://e", "f-1", "u-1", None)
    assert got[1] == ("R 7", profile, profile, "https://e", "f-1", "u-1", None)
    assert got[2] == (None, "http://p", "https://www.g.org", "http://p", None, "d-1", "2022/S 1-2")
    assert got[3:] == [(None,) * 7] * 3
    for d in docs[:3]:
        found, root = xml_notices.parsed(d), ElementTree.fromstring(d)
        assert {f: found.get(f) for f in xml_notices.FORM_PATHS} == {f: first_text(root, p) for f, p in xml_notices.FORM_PATHS.items()}


def test_bulk_notices(spark, tmp_path):
    one = lambda k, org: f"<ContractNotice><ext:UBLExtensions><ext:UBLExtension><ext:ExtensionContent><e:EformsExtension><e:Organizations>{org}</e:Organizations></e:EformsExtension></ext:ExtensionContent></ext:UBLExtension></ext:UBLExtensions><c:ContractFolderID>{k}</c:ContractFolderID><c:IssueDate>2024-01-0{k}+02:00</c:IssueDate><a:ProcurementProject><c:Name> T{k} </c:Name><c:Description>D</c:Description></a:ProcurementProject></ContractNotice>"
    org = lambda n: f"<e:Organization><e:Company><a:PartyName><c:Name>{n}</c:Name></a:PartyName></e:Company></e:Organization>"
    (tmp_path / "2024-01.xml").write_text(f'<OPEN-DATA xmlns:ext="x" xmlns:e="e" xmlns:c="c" xmlns:a="a">{one(1, org("Army") + org("Other"))}{one(2, "<e:Organization/>" + org("Navy"))}{one("", "")}</OPEN-DATA>')
    got = sorted(tuple(r) for r in xml_notices.bulk_notices(spark, str(tmp_path / "*.xml")).collect())
    assert got == [("1", "T1", "Army", "2024-01-01", "D"), ("2", "T2", "Navy", "2024-01-02", "D")]


def pages(path, spans, broken=()):
    os.makedirs(path, exist_ok=True)
    known = {}
    for k, (first, last) in enumerate(spans):
        rows = [{"id": f"{os.path.basename(path)}{k}-{i}", "date": f"2024-01-{d:02d}", "title": f"Trailer {d}" if d % 2 else f"Tank {d}"} for i, d in enumerate(range(first, last + 1))]
        body = "{broken" if k in broken else json.dumps({"results": rows})
        (open(f"{path}/page-{k}.json", "w")).write(body)
        known[f"page-{k}.json"] = [f"2024-01-{first:02d}", f"2024-01-{last:02d}"]
    json.dump({"by": "date", "pages": known}, open(f"{path}/pages.json", "w"))


def test_conditions_reach_the_search_and_unneeded_pages_stay_closed(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "id string, date string, title string"
    pages(path, [(1, 5), (6, 10), (11, 15)], broken=(0,))  # page 0 can't be read at all
    load = lambda **more: search.search(spark, path, schema, ["title"], **more)
    late = load().where("date >= '2024-01-08' AND title LIKE '%ank%'")
    assert sorted(r.title for r in late.collect()) == ["Tank 10", "Tank 12", "Tank 14", "Tank 8"]
    plan = load().where("date >= '2024-01-08'")._jdf.queryExecution().executedPlan().toString()
    assert ") Filter" not in plan and "recorded_search" in plan  # nothing is left for Spark to filter
    assert sorted(r.title for r in load(any_of=["tank 8", "TRAILER 9"]).where("date > '2024-01-05'").collect()) == ["Tank 8", "Trailer 9"]
    assert load(all_of=["tank", "1"]).where("date > '2024-01-05' AND (title = 'Tank 10' OR title = 'Tank 12')").count() == 2
    pages(path, [(1, 5), (6, 10), (11, 15)], broken=(1, 2))  # the limit is reached on page 0
    assert load(any_of=["trailer"], limit=3).count() == 3
    pages(str(tmp_path / "s1"), [(1, 5), (6, 10)])
    table = spark.createDataFrame([("s1", ["tank"], None, "2024-01-03", None, "date"), ("s2", None, ["trailer"], None, "2024-01-04", "date")], "name string, any_of array<string>, all_of array<string>, since string, until string, date string")
    pages(str(tmp_path / "s2"), [(1, 5)])
    assert {(r.search, r.title) for r in search.searches_of(spark, table, str(tmp_path), schema, ["title"]).collect()} == {("s1", "Tank 4"), ("s1", "Tank 6"), ("s1", "Tank 8"), ("s1", "Tank 10"), ("s2", "Trailer 1"), ("s2", "Trailer 3")}


def test_searches_go_on_where_each_was(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    pages(a, [(1, 2)])
    pages(b, [(1, 3), (4, 5)])
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        stream = search.search_stream(spark, [a, b], "id string, date string, title string", "title")
        state.run_to_end(stream, out, check)
        return sorted(r.title for r in spark.read.parquet(out).collect())

    assert run() == ["Tank 2", "Tank 4", "Trailer 1", "Trailer 3", "Trailer 5"]
    pages(a, [(1, 2), (3, 6)], broken=(0,))  # a page that was read isn't opened again
    assert run() == ["Tank 2", "Tank 4", "Tank 6", "Trailer 1", "Trailer 3", "Trailer 5"]
    assert run() == ["Tank 2", "Tank 4", "Tank 6", "Trailer 1", "Trailer 3", "Trailer 5"]


def test_a_key_comes_again_after_its_time_to_live(spark, tmp_path):
    state.use_state_store(spark)
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))

    def batch(*rows):
        spark.createDataFrame(list(rows), "k string, v int").coalesce(1).write.mode("append").parquet(src)
        state.run_to_end(state.expiring(state.file_stream(spark, src), "k", "v", 15.0), out, check, idle=False)
        return sorted(tuple(r) for r in spark.read.parquet(out).collect())

    assert batch(("a", 2), ("a", 1), ("b", 5)) == [("a", 1), ("b", 5)]
    began = time.time()
    again = batch(("a", 3), ("c", 7))
    assert again == [("a", 1), ("b", 5), ("c", 7)] or time.time() - began > 9
    time.sleep(16)
    assert batch(("a", 4))[:2] in ([("a", 1), ("a", 4)], [("a", 1), ("a", 3)])


def test_only_touched_buckets_are_written(spark, tmp_path):
    target = str(tmp_path / "t")
    put = state.upsert_latest(target, ["id"], ["ts"], buckets=8)
    schema = "id int, ts int, v string"
    put(spark.createDataFrame([(k, 1, "old") for k in range(200)], schema), 0)
    files = lambda n: {os.path.relpath(f, target) for f in glob.glob(f"{target}/rows/batch={n}/*/*.parquet")}
    before = files(0)
    for _ in range(2):  # a batch that runs again gives the same
        put(spark.createDataFrame([(3, 2, "new"), (4, 0, "older"), (500, 1, "more")], schema), 1)
    rows = {r.id: r.v for r in state.read_latest(spark, target).collect()}
    assert len(rows) == 201 and rows[3] == "new" and rows[4] == "old" and rows[500] == "more"
    assert files(0) == before and 1 <= len({f.split("/")[2] for f in files(1)}) <= 3
    put(spark.createDataFrame([], schema), 2)
    assert state.read_latest(spark, target).count() == 201


def test_first_seen_over_two_files(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    for rows in ([("a", datetime.datetime(2024, 1, 2)), ("b", datetime.datetime(2024, 1, 3))], [("a", datetime.datetime(2024, 1, 1)), ("b", datetime.datetime(2024, 1, 5))]):
        spark.createDataFrame(rows, "k string, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(src)
        seen = state.run_to_end(state.first_seen_stream(state.file_stream(spark, src), "k", "ts"), out, check, "update")
    assert {(r.k, r.t.day) for r in seen.groupBy("k").agg(F.min("first_seen").alias("t")).collect()} == {("a", 1), ("b", 3)}


def test_observed_counts_come_with_the_querys_own_job(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    watched, seen = metrics.observed(df.where("v > 2"), rows=F.count("*"), high=F.count_if(F.col("v") == 6), total=F.sum("v"))
    spark.sparkContext.setJobGroup("observed", "")
    watched.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("plain", "")
    df.where("v > 2").write.format("noop").mode("overwrite").save()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    assert len(jobs("observed")) == len(jobs("plain"))
    want = df.where("v > 2").agg(F.count("*"), F.count_if(F.col("v") == 6), F.sum("v")).first()
    assert (seen.get["rows"], seen.get["high"], seen.get["total"]) == tuple(want)


def test_flips_are_exact_on_all_rows_and_near_on_a_tenth(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 4).cast("string").alias("s"), (F.col("id") * 7 % 50).alias("b"), (F.col("id") * 7 % 50 + F.when(F.col("id") % 5 == 0, 20).otherwise(-3)).alias("a"))
    run = lambda share: {r.stratum: r for r in metrics.flips(df, F.col("s"), F.col("id"), F.col("b"), F.col("a"), 25, share).collect()}
    exact, near = run({}), run(dict.fromkeys("0123", 0.1))
    rows = [(str(i % 4), i * 7 % 50, i * 7 % 50 + (20 if i % 5 == 0 else -3)) for i in range(20_000)]
    for s in "0123":
        assert exact[s].gained == sum(x == s and b < 25 <= a for x, b, a in rows) and exact[s].lost == sum(x == s and a < 25 <= b for x, b, a in rows)
        assert exact[s].gained_total == exact[s].gained and exact[s].gained_error == 0 and exact[s].sampled == 5000
        assert 300 < near[s].sampled < 700 and abs(near[s].gained_total - exact[s].gained) <= 4 * near[s].gained_error and abs(near[s].lost_total - exact[s].lost) <= 4 * near[s].lost_error


def test_scores_of_models(spark):
    one = lambda rows, schema, make: [r[0] for r in spark.createDataFrame(rows, schema).select(make).collect()]
    c = F.col
    assert one([("low bed trailer", "Trailer low-bed heavy"), ("tank", "tank trailer flat"), ("x", "tank"), (None, ""), ("y", None), ("", "tank"), ("Heavy Duty", "heavy duty")], "p string, t string", metrics.type_overlap(c("p"), c("t"))) == [0.5, 0.5, 0.0, 1.0, 0.5, 0.0, 1.0]
    assert one([("10", "10"), ("11", "10"), ("18", "10"), ("30", "10"), (None, "10"), (None, None), ("3", None), ("x", "10"), ("0", "0"), ("1", "0")], "p string, t string", metrics.count_band(c("p"), c("t"))) == [1.0, 1.0, 0.5, 0.0, 0.0, 1.0, 0.5, 0.0, 1.0, 0.0]
    assert [tuple(x) for x in one([("a", "a", 70), ("a", "a", 50), ("b", "a", 90), (None, None, 60), (None, None, 61), ("a", None, 0), (None, "a", 0)], "p string, t string, f int", metrics.match_scores(c("p"), c("t"), c("f"), F.lit(60), F.lit(60)))] == [(1.0, 1.0), (1.0, 0.5), (0.0, 0.0), (1.0, 1.0), (1.0, 0.5), (0.0, 0.0), (0.0, 0.0)]
    got = one([("Heavy tank  trailer", "heavy trailer unit", ["TANK"], ["panzer"]), ("Panzer", "tank", [], ["panzer"]), ("", "", None, None)], "p string, t string, r array<string>, f array<string>", metrics.translation_scores(c("p"), c("t"), c("r"), c("f")))
    assert [tuple(x) for x in got] == [(1.0, 1.0, 0.67), (0.0, 0.0, 0.0), (1.0, 1.0, 0.0)]


def test_medians_of_groups_are_exact(spark):
    import random
    import statistics

    r = random.Random(2)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.choice([1.0, 5.0, r.random() * 100, None])) for _ in range(5000)] + [("c", 7.0)] + [("d", 1.0), ("d", 2.0)] + [("e", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    want = {k: (statistics.median(x), len(x)) for k in {k for k, _ in rows} if (x := [v for g, v in rows if g == k and v is not None])}
    for parts in (2, 64):
        assert {x.k: (x.median, x.n) for x in metrics.group_medians(df, ["k"], "v", parts=parts).collect()} == want
    assert {x.k for x in metrics.group_medians(df, ["k"], "v", least=2).collect()} == {"a", "b", "d", None}
    waterfall = lambda split: sorted((tuple(r) for r in metrics.median_waterfall(df.where("k IS NOT NULL"), "v", [(["k"], 3)], split).collect()), key=repr)
    assert waterfall(True) == waterfall(False)
