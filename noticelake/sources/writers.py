"""Sinks: snapshots, front-end JSON, id lists, spreadsheets and Markdown reports."""

from __future__ import annotations

import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, omit_nulls: bool = True) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", omit_nulls).json(path)


def write_snapshot(df: DataFrame, folder: str, version: int, keep: int = 10) -> list[int]:
    """Writes ``version=n`` and removes all but the last ``keep`` versions; returns those there."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{folder}/version={version}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    there = sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path) if s.getPath().getName().startswith("version="))
    for old in there[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/version={old}"), True)
    return there[-keep:]


def write_id_list(spark: SparkSession, ids: DataFrame, known: DataFrame | None, path: str) -> None:
    """Sorted distinct ids, one a line, with those known before."""
    column = ids.columns[0]
    rows = ids.select(F.col(column).cast("string").alias("value"))
    if known is not None:
        rows = rows.unionByName(known.select(F.col(known.columns[0]).cast("string").alias("value")))
    rows.distinct().orderBy("value").write.mode("overwrite").text(path)


def markdown_table(df: DataFrame, most: int = 100) -> str:
    """A report table of the first ``most`` rows of an ordered aggregate."""
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in row) + " |" for row in df.limit(most).collect()])


def write_spreadsheet(df: DataFrame, path: str, columns: Sequence[str], most: int = 100_000, sheet: str = "rows") -> int:
    """An .xlsx of at most ``most`` rows, a filter on its header and links for URLs; more rows are an error.

    A spreadsheet is one small file by nature, so rows come to the driver, counted first.
    """
    rows = df.select(*columns).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")

    def cell(v) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"<c><v>{v}</v></c>"
        text = escape(str(v))
        if text.startswith("http"):
            return f'<c t="str"><f>HYPERLINK("{text.replace(chr(34), "")}")</f><v>{text}</v></c>'
        return f'<c t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'

    body = "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in [columns, *rows])
    last, n = "", len(columns)
    while n:
        n, k = divmod(n - 1, 26)
        last = chr(65 + k) + last
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    files = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kinds}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData><autoFilter ref="A1:{last}{len(rows) + 1}"/></worksheet>',
    }
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, text in files.items():
            out.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text)
    return len(rows)
