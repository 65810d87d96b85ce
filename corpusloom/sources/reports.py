"""Reports of small results: Markdown and HTML tables, and workbooks. Larger results are refused; they are tables."""

from __future__ import annotations

import html
import io
import zipfile
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a page or a workbook may have.
REPORT_ROWS = 100_000


def cell_text(value: Column) -> Column:
    """A value as the text of a cell: null is empty, line breaks and bars don't end it."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(value.cast("string"), r"\|", r"\\|"), r"[\r\n]+", " "), F.lit(""))


def markdown_lines(rows: DataFrame) -> DataFrame:
    """``rows`` with ``line``, theirs in a Markdown table of all columns."""
    cells = [x for c in rows.columns for x in (cell_text(F.col(c)), F.lit(" | "))][:-1]
    return rows.withColumn("line", F.concat(F.lit("| "), *cells, F.lit(" |")))


def _few(rows: DataFrame) -> list:
    found = rows.limit(REPORT_ROWS + 1).collect()
    if len(found) > REPORT_ROWS:
        raise ValueError(f"more than {REPORT_ROWS} rows in a report")
    return found


def markdown(rows: DataFrame) -> str:
    """A Markdown table of a small result, in its order."""
    head = "| " + " | ".join(rows.columns) + " |\n|" + " --- |" * len(rows.columns)
    return "\n".join([head, *(r.line for r in _few(markdown_lines(rows).select("line")))]) + "\n"


def html_page(rows: DataFrame, title: str) -> str:
    """A page with a table of a small result; every value is escaped."""
    tag = lambda name, inner: f"<{name}>{inner}</{name}>"
    body = [tag("tr", "".join(tag("td", html.escape("" if v is None else str(v))) for v in r)) for r in _few(rows)]
    head = tag("tr", "".join(tag("th", html.escape(c)) for c in rows.columns))
    return f'<!DOCTYPE html><html><head><meta charset="utf-8">{tag("title", html.escape(title))}</head><body>{tag("table", head + "".join(body))}</body></html>'


def _column_name(i: int) -> str:
    name = ""
    while i >= 0:
        name, i = chr(65 + i % 26) + name, i // 26 - 1
    return name


def workbook(rows: DataFrame) -> bytes:
    """A workbook of one sheet with a header; numbers are numbers, everything else is text, null cells are left out."""

    def cell(value, at: str) -> str:
        if value is None:
            return ""
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return f'<c r="{at}"><v>{value!r}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{html.escape(str(value), quote=False)}</t></is></c>'

    lines = [
        f'<row r="{n}">{"".join(cell(v, f"{_column_name(i)}{n}") for i, v in enumerate(values))}</row>' for n, values in enumerate([rows.columns, *_few(rows)], 1)
    ]
    space = "http://schemas.openxmlformats.org"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    office, package = f"{space}/officeDocument/2006/relationships", f"{space}/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{space}/spreadsheetml/2006/main" xmlns:r="{office}"><sheets><sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{space}/spreadsheetml/2006/main"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, head + text)
    return out.getvalue()


def write_bytes(spark, path: str, content: bytes) -> None:
    """A file on any file system that the session knows."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    out.write(bytearray(content))
    out.close()


def write_workbook(rows: DataFrame, path: str) -> None:
    write_bytes(rows.sparkSession, path, workbook(rows))


def write_page(rows: DataFrame, path: str, title: str) -> None:
    write_bytes(rows.sparkSession, path, html_page(rows, title).encode())


def write_markdown(tables: dict[str, DataFrame], path: str) -> None:
    """Several tables under headings in one file."""
    text = reduce(lambda done, item: done + f"## {item[0]}\n\n{markdown(item[1])}\n", tables.items(), "")
    write_bytes(next(iter(tables.values())).sparkSession, path, text.encode())
