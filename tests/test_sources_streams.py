"""Readers, writers and streams on small files."""

import datetime
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.sources import readers, writers
from noticelake.streaming import state


def test_json_folder_leaves_out_broken_and_failed(spark, tmp_path):
    for name, body in (("a", '{"id": "1"}'), ("b", '{"id": "2", "_fetch_failed": true}'), ("c", "{broken")):
        (tmp_path / f"{name}.json").write_text(body)
    rows = readers.json_folder(spark, str(tmp_path), T.StructType([T.StructField("id", T.StringType())])).collect()
    assert [(r.id, r._file) for r in rows] == [("1", "a.json")]


def test_csv_sources(spark, tmp_path):
    (tmp_path / "2020.csv").write_text("ID,VALUE\n1,5\n")
    (tmp_path / "2021.csv").write_text("ident,amount\n2,6\n")
    names = {"id": ["ID", "ident"], "value": ["VALUE", "amount"], "more": ["none"]}
    paths = {2020: str(tmp_path / "2020.csv"), 2021: str(tmp_path / "2021.csv")}
    assert sorted((r.id, r.value, r.more, r.year) for r in readers.yearly_csv(spark, paths, names).collect()) == [("1", "5", None, 2020), ("2", "6", None, 2021)]
    assert readers.yearly_csv(spark, paths, names, since=2021).count() == 1
    (tmp_path / "t.csv").write_text("﻿ref,date,amendment\nA,2024-01-01,1\nA,2024-01-02,10\nB,2024-01-03,x\nspill,over,\n", encoding="utf-8")
    assert sorted((r.ref, r.date) for r in readers.clean_csv(spark, str(tmp_path / "t.csv"), "date", "ref", "amendment").collect()) == [("A", "2024-01-02"), ("B", "2024-01-03")]


def test_xml_sources(spark, tmp_path):
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>T</title><link>l</link><description>&lt;b&gt;D&lt;/b&gt;</description><guid>g</guid><pubDate>Mon, 6 May 2024 10:00:00 +0000</pubDate></item></channel></rss>")
    r = readers.rss_items(spark, str(tmp_path / "feed.xml")).first()
    assert (r.title, r.description, r.guid) == ("T", "D", "g") and r.published is not None
    df = spark.createDataFrame([('<a xmlns:n="u"><n:b><n:c>7</n:c></n:b></a>',)], "x string")
    assert df.select(readers.xml_path(F.col("x"), "b", "c")).first()[0] == "7"
    assert df.select(readers.xml_path(F.col("x"), "z")).first()[0] is None


def test_union_of_searches_keeps_the_first(spark):
    rows = lambda v, *ids: spark.createDataFrame([(i, v) for i in ids], "id int, v string")
    assert sorted(tuple(r) for r in readers.union_of_searches([rows("a", 1, 2), rows("b", 2, 3)], "id").collect()) == [(1, "a"), (2, "a"), (3, "b")]


def test_month_windows(spark):
    w = spark.range(1).select(readers.month_windows(F.to_date(F.lit("2024-01-15")), F.to_date(F.lit("2024-03-02"))).alias("w")).first().w
    d = datetime.date
    assert [(x.first, x.last) for x in w] == [(d(2024, 1, 15), d(2024, 1, 31)), (d(2024, 2, 1), d(2024, 2, 29)), (d(2024, 3, 1), d(2024, 3, 2))]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "https://x.org", None), (2, "b<&", 2.5)], "id int, url string, v double")
    assert writers.write_spreadsheet(df, str(tmp_path / "o.xlsx"), ["id", "url", "v"]) == 2
    sheet = zipfile.ZipFile(tmp_path / "o.xlsx").read("xl/worksheets/sheet1.xml").decode()
    assert "HYPERLINK" in sheet and "b&lt;&amp;" in sheet and 'ref="A1:C3"' in sheet
    for v in range(4):
        there = writers.write_snapshot(df, str(tmp_path / "snap"), v, keep=2)
    assert there == [2, 3]
    writers.write_id_list(spark, df.select("id"), spark.createDataFrame([("9",), ("1",)], "id string"), str(tmp_path / "ids"))
    assert [r.value for r in spark.read.text(str(tmp_path / "ids")).orderBy("value").collect()] == ["1", "2", "9"]
    writers.write_json(df, str(tmp_path / "json"))
    assert not any('"v":null' in r.value for r in spark.read.text(str(tmp_path / "json")).collect())
    assert writers.markdown_table(df.select("id").orderBy("id")).splitlines()[2] == "| 1 |"


def test_stream_reads_each_file_once_and_keeps_the_latest(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    batch = lambda rows: spark.createDataFrame(rows, "id int, v int, ts timestamp").coalesce(1).write.mode("append").parquet(src)
    t = lambda h: datetime.datetime(2024, 1, 1, h)
    batch([(1, 10, t(1)), (2, 20, t(2))])
    stream = state.file_stream(spark, src)
    put = state.upsert_latest(out, ["id"], ["ts"])
    for _ in range(2):
        q = stream.writeStream.foreachBatch(put).option("checkpointLocation", check).trigger(availableNow=True).start()
        q.awaitTermination()
        batch([(1, 11, t(3))])
    q = stream.writeStream.foreachBatch(put).option("checkpointLocation", check).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.id, r.v) for r in state.read_latest(spark, out).collect()) == [(1, 11), (2, 20)]


def test_failures_are_skipped(spark):
    df = spark.createDataFrame([(1, True)] * 3 + [(2, True), (2, False)], "id int, failed boolean")
    assert [r.id for r in state.failures_skipped(df, "id", "failed").collect()] == [1]


def test_late_rows_over_several_batches(spark, tmp_path):
    """A key is dropped while its state lives, and passes again when the watermark has gone beyond it."""
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    at = lambda days, hours=0: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=days, hours=hours)
    for rows in ([("a", 1, at(0)), ("b", 2, at(0))], [("a", 3, at(0, 1)), ("c", 4, at(5))], [("a", 5, at(6)), ("c", 6, at(5, 2))]):
        spark.createDataFrame(rows, "k string, v int, ts timestamp").coalesce(1).write.mode("append").parquet(src)
        seen = state.run_to_end(state.late_deduplicated(state.file_stream(spark, src), "ts", ["k"]), out, check)
    assert sorted(r.v for r in seen.collect()) == [1, 2, 4, 5]
