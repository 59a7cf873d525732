"""Members of zip archives as rows: yearly CSV, documents, spreadsheets.

Archives come through Spark's own file source, so any store that Spark reads will do.
A first step cuts an archive at its directory into one row a member, still compressed;
the members are then dealt out, so a task has single members and not whole archives,
and each is unpacked as a stream. An archive is one value here, 2 GB at most.
"""

from __future__ import annotations

import codecs
import csv
import io
import zipfile
import zlib
from collections.abc import Iterator, Mapping, Sequence
from fnmatch import fnmatch
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MEMBERS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("method", pa.int32()), ("size", pa.int64()), ("packed", pa.binary())])


def archive_members(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*", spread: int | None = None) -> DataFrame:
    """``archive, member, method, size, packed`` of members whose name fits the pattern, case ignored.

    Files that are no archives give no rows; an encrypted member gives none. Members
    are dealt out by their names over ``spread`` partitions, or as Spark shuffles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data = memoryview(content.as_buffer())
                try:
                    there = zipfile.ZipFile(io.BytesIO(data)).infolist()
                except zipfile.BadZipFile:
                    continue
                for m in there:
                    if m.is_dir() or m.flag_bits & 1 or not fnmatch(m.filename.lower(), pattern.lower()):
                        continue
                    at = m.header_offset  # a local header has 30 bytes, then its name and extra field
                    at += 30 + int.from_bytes(data[at + 26 : at + 28], "little") + int.from_bytes(data[at + 28 : at + 30], "little")
                    yield pa.RecordBatch.from_pylist([{"archive": path, "member": m.filename, "method": m.compress_type, "size": m.file_size, "packed": bytes(data[at : at + m.compress_size])}], schema=_MEMBERS)

    files = spark.read.format("binaryFile").load(list(paths) if not isinstance(paths, str) else paths)
    found = files.select("path", "content").mapInArrow(run, "archive string, member string, method int, size long, packed binary")
    return found.repartition(spread, "archive", "member") if spread else found.repartition("archive", "member")


def unpacked(packed: bytes, method: int, at_once: int = 1 << 20) -> Iterator[bytes]:
    """A member's bytes in pieces: stored, or deflated."""
    if method == zipfile.ZIP_STORED:
        yield packed
        return
    if method != zipfile.ZIP_DEFLATED:
        raise ValueError(f"compression {method} is not read")
    inflate, left = zlib.decompressobj(-15), packed
    while left and not inflate.eof:
        yield inflate.decompress(left, at_once)
        left = inflate.unconsumed_tail
    yield inflate.flush()


def _lines(parts: Iterator[bytes], encoding: str) -> Iterator[str]:
    """Lines with their ends; bytes that are no characters become the replacement mark, a leading mark of order goes."""
    decode, rest = codecs.getincrementaldecoder(encoding)(errors="replace"), ""
    for part in parts:
        rest += decode.decode(part)
        lines = rest.split("\n")
        rest = lines.pop()
        yield from (x + "\n" for x in lines)
    rest += decode.decode(b"", True)
    if rest:
        yield rest


def zipped_csv(spark: SparkSession, paths: str | Sequence[str], names: Mapping[str, Sequence[str]], encoding: str = "utf-8-sig", pattern: str = "*.csv", rows_a_batch: int = 5_000) -> DataFrame:
    """``archive, member`` and the wanted columns, as texts, of every CSV row of the archives.

    ``names`` gives for each column what members may call it: the first one that is
    filled counts; null where none is. Rows are read one by one, so a member may be
    larger than a worker's memory when unpacked.
    """
    columns = ["archive", "member", *names]
    schema = pa.schema([(n, pa.string()) for n in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.to_pylist():
                held: list[dict] = []
                for row in csv.DictReader(_lines(unpacked(m["packed"], m["method"]), encoding)):
                    held.append({"archive": m["archive"], "member": m["member"], **{c: next((v for o in options if (v := row.get(o))), None) for c, options in names.items()}})
                    if len(held) == rows_a_batch:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    return archive_members(spark, paths, pattern).mapInArrow(run, ", ".join(f"`{n}` string" for n in columns))


def yearly_archives(spark: SparkSession, paths: Mapping[int, str], names: Mapping[str, Sequence[str]], keep: Column | None = None, since: int | None = None, until: int | None = None, encoding: str = "utf-8-sig") -> DataFrame:
    """Rows of the wanted years' archives under common names, with ``year``; ``keep`` is a filter on these names.

    Archives of other years are not opened.
    """
    wanted = {y: p for y, p in paths.items() if (since is None or y >= since) and (until is None or y <= until)}
    if not wanted:
        raise ValueError("no archive of the wanted years")
    out = None
    for year in sorted(wanted):
        part = zipped_csv(spark, wanted[year], names, encoding).select(*names).withColumn("year", F.lit(year))
        part = part.where(keep) if keep is not None else part
        out = part if out is None else out.unionByName(part)
    return out


def wanted_by_codes_or_words(codes: Sequence[Column], text: Column, legal: Column, prefixes: Sequence[str], words: Sequence[str]) -> Column:
    """Rows with one of the code prefixes anywhere in their codes, or else one of the words in their text."""
    all_codes = F.concat_ws(" ", *codes)
    by_code = F.coalesce(*(F.when(all_codes.contains(p), True) for p in prefixes), F.lit(False))
    low = F.lower(F.coalesce(text, F.lit("")))
    return by_code | F.coalesce(*(F.when(low.contains(w.lower()), True) for w in words), F.lit(False))


def api_id(csv_id: Column, url: Column) -> Column:
    """A number and year, ``423-2023``: of a notice's URL, else of an id that begins with the year, else the id as it is."""
    n, y = (F.regexp_extract(F.coalesce(url, F.lit("")), r"NOTICE:([0-9]+)-([0-9]{4})", k) for k in (1, 2))
    bare = F.trim(csv_id)
    return F.when(n != "", F.concat_ws("-", n, y)).when(bare.rlike("^[0-9]{5,}$"), F.concat_ws("-", F.substring(bare, F.lit(5), F.length(bare)), F.left(bare, F.lit(4)))).otherwise(bare)


def catalogue(titles: DataFrame, title: str, url: str, kind: str, first_year: int = 2006, last_year: int = 2026) -> DataFrame:
    """``year, url`` of a catalogue's yearly files of a kind, ``notices`` or ``awards``; deprecated bundles are left out.

    The last row of a year counts, in the order of titles and URLs.
    """
    t, low = F.col(title), F.lower(title)
    award = low.contains("contract award") | low.contains("award notice")
    fits = award if kind == "awards" else low.contains("contract notice") & ~award
    gone = t.contains("*deprecated") | t.contains("VEAT") | t.contains("2009-2015")
    year = F.coalesce(*(F.when(t.contains(str(y)), y) for y in range(first_year, last_year + 1)))
    rows = titles.where(fits & ~gone & F.coalesce(F.col(url) != "", F.lit(False))).select(year.alias("year"), F.col(url).alias("url"), t.alias("t"))
    return rows.where("year IS NOT NULL").groupBy("year").agg(F.max_by("url", F.struct("t", "url")).alias("url"))


def _local(element: ElementTree.Element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _own_text(paragraph: ElementTree.Element) -> str:
    marks = {"tab": "\t", "br": "\n", "cr": "\n"}
    return "".join(e.text or "" if _local(e) == "t" else marks.get(_local(e), "") for e in paragraph.iter())


def document_parts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``archive, place, kind, text``: paragraphs of word-processor documents, then their tables' rows with `` | `` between cells.

    Blank paragraphs, cells and rows are left out; a document that is no XML gives no rows.
    """
    schema = pa.schema([("archive", pa.string()), ("place", pa.int32()), ("kind", pa.string()), ("text", pa.string())])

    def parts(body: ElementTree.Element) -> Iterator[tuple[str, str]]:
        for e in body:
            if _local(e) == "p" and (text := _own_text(e)).strip():
                yield "paragraph", text
        for e in body:
            if _local(e) == "tbl":
                for row in (r for r in e if _local(r) == "tr"):
                    cells = ("\n".join(_own_text(p) for p in c.iter() if _local(p) == "p").strip() for c in row if _local(c) == "tc")
                    if text := " | ".join(c for c in cells if c):
                        yield "row", text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.to_pylist():
                try:
                    root = ElementTree.fromstring(b"".join(unpacked(m["packed"], m["method"])))
                except ElementTree.ParseError:
                    continue
                body = next((e for e in root if _local(e) == "body"), root)
                rows = [{"archive": m["archive"], "place": k, "kind": kind, "text": text} for k, (kind, text) in enumerate(parts(body))]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return archive_members(spark, paths, "word/document.xml").mapInArrow(run, "archive string, place int, kind string, text string")


def document_texts(parts: DataFrame, most: int = 20_000) -> DataFrame:
    """``archive, text``: a document's parts as lines, cut at ``most`` characters with a remark."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "\n")
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace("text", r"\r\n|\r", "\n"), r"\n{3,}", "\n\n"), r"[ \t]{2,}", " "))
    whole = parts.groupBy("archive").agg(text.alias("text")).select("archive", clean.alias("text"))
    return whole.select("archive", F.when(F.length("text") > most, F.concat(F.left("text", F.lit(most)), F.lit(f"\n[… truncated at {most} chars]"))).otherwise(F.col("text")).alias("text"))


def spreadsheet_rows(spark: SparkSession, paths: str | Sequence[str], sheet: int = 1) -> DataFrame:
    """``archive, row, cells`` of a workbook's sheet: cells as texts in the order of columns, null where empty.

    Shared texts and the sheet are two members of one archive, so a workbook is
    read by one task; rows and columns are numbered from 1.
    """
    schema = pa.schema([("archive", pa.string()), ("row", pa.int32()), ("cells", pa.list_(pa.string()))])
    wanted = ("xl/sharedStrings.xml", f"xl/worksheets/sheet{sheet}.xml")

    def column(reference: str) -> int:
        n = 0
        for letter in reference:
            if letter.isalpha():
                n = n * 26 + ord(letter.upper()) - 64
        return n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                try:
                    book = zipfile.ZipFile(io.BytesIO(content.as_py()))
                    xml = {n: ElementTree.fromstring(book.read(n)) for n in wanted if n in book.namelist()}
                except (zipfile.BadZipFile, ElementTree.ParseError):
                    continue
                shared = ["".join(t.text or "" for t in s.iter() if _local(t) == "t") for s in xml.get(wanted[0], ())]
                rows = []
                for row in (e for e in xml.get(wanted[1], ElementTree.Element("none")).iter() if _local(e) == "row"):
                    cells: list[str | None] = []
                    for c in (e for e in row if _local(e) == "c"):
                        at = column(c.get("r", "")) or len(cells) + 1
                        cells += [None] * (at - len(cells))
                        value = "".join(e.text or "" for e in c.iter() if _local(e) in ("v", "t"))
                        cells[at - 1] = (shared[int(value)] if c.get("t") == "s" and value else value) or None
                    rows.append({"archive": path, "row": int(row.get("r") or len(rows) + 1), "cells": cells})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").load(list(paths) if not isinstance(paths, str) else paths)
    return files.select("path", "content").mapInArrow(run, "archive string, row int, cells array<string>")


def with_header(rows: DataFrame, header: int, columns: Sequence[str], key: str) -> DataFrame:
    """The wanted columns below a header row, by their names there, of rows whose ``key`` is filled."""
    heads = rows.where(F.col("row") == header).select("archive", F.col("cells").alias("_heads"))
    at = lambda name: F.get(F.col("cells"), (F.array_position("_heads", name) - 1).cast("int"))
    named = rows.where(F.col("row") > header).join(F.broadcast(heads), "archive")
    return named.select("archive", "row", *(F.when(F.array_position("_heads", c) > 0, at(c)).alias(c) for c in columns)).where(F.coalesce(F.col(key) != "", F.lit(False)))
