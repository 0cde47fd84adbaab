"""Spreadsheets: one XLSX file for each group of rows, written by the tasks that hold the groups.

A Python data source with commit: each task writes its files row by row under another name, and they get their own names
when all tasks are done; if the job fails, they are removed. No task holds a sheet. What a sheet cannot hold goes on in a
next file.
"""

from __future__ import annotations

import datetime as dt
import decimal
import itertools
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tidemark.sinks.tables import target

#: Rows of a sheet with its header, fixed by the format.
SHEET_ROWS = 1 << 20
#: Fixed parts of a workbook with one sheet.
PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
#: Characters that XML cannot hold.
BARRED = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿\ud800-\udfff]")


def column_name(n: int) -> str:
    """A, B, ..., Z, AA, ... of column 0, 1, ..."""
    name = ""
    while n >= 0:
        n, rest = divmod(n, 26)
        name, n = chr(65 + rest) + name, n - 1
    return name


def cell(value, at: str) -> str:
    """One cell; null is no cell, a number too long for a double is text."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float, decimal.Decimal)) and (not isinstance(value, float) or abs(value) < float("inf")) and len(str(value).strip("-").replace(".", "")) <= 15:
        return f'<c r="{at}"><v>{value}</v></c>'
    text = value.isoformat(" ") if isinstance(value, dt.datetime) else str(value)
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(BARRED.sub("", text)[:32767])}</t></is></c>'


def write_workbook(out, sheet: str, columns: list[str], rows: Iterator) -> None:
    """A workbook of one sheet, row by row, to an open binary stream."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in PARTS.items():
            book.writestr(name, HEAD + text.replace("{sheet}", escape(re.sub(r"[\[\]:*?/\\]", "_", sheet)[:31], {'"': "&quot;"})))
        with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as part:
            part.write((HEAD + SHEET).encode())
            for n, row in enumerate(itertools.chain([columns], rows), 1):
                cells = "".join(cell(v, f"{column_name(i)}{n}") for i, v in enumerate(row))
                part.write(f'<row r="{n}">{cells}</row>'.encode())
            part.write(b"</sheetData></worksheet>")


def filesystem(path: str):
    """Arrow's file system of a path or address, and the path there."""
    from pyarrow import fs

    if re.match("^[A-Za-z][A-Za-z0-9+.-]+:", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class XlsxWriter(DataSourceWriter):
    def __init__(self, path: str, kind: str, by: list[str], columns: list[str], run: str, rows: int) -> None:
        self.path, self.kind, self.by, self.columns, self.run, self.rows = path, kind, by, columns, run, rows

    def hidden(self, name: str) -> str:
        return f".{name}.{self.run}"

    def write(self, iterator: Iterator) -> Written:
        store, folder = filesystem(self.path)
        store.create_dir(folder, recursive=True)
        body, names = [c for c in self.columns if c not in self.by], []
        for key, rows in itertools.groupby(iterator, key=lambda r: tuple(r[c] for c in self.by)):
            parts = ["none" if v is None else re.sub(r"[^\w-]", "_", str(v)) for v in key]
            picked = (tuple(row[c] for c in body) for row in rows)
            for n in itertools.count():
                first = next(picked, None)
                if first is None:
                    break
                name = "_".join([self.kind, *parts]) + (f"_{n + 1}" if n else "") + ".xlsx"
                with store.open_output_stream(f"{folder}/{self.hidden(name)}") as out:
                    write_workbook(out, "_".join(parts) or self.kind, body, itertools.chain([first], itertools.islice(picked, self.rows - 2)))
                names.append(name)
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = filesystem(self.path)
        for name in itertools.chain.from_iterable(m.names for m in messages if m):
            store.move(f"{folder}/{self.hidden(name)}", f"{folder}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        """Removes what this run wrote, also what a task left that did not end."""
        from pyarrow import fs

        store, folder = filesystem(self.path)
        for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.base_name.endswith(self.run):
                store.delete_file(info.path)


class XlsxSource(DataSource):
    """Format ``xlsx``. Options: ``by``, columns that name files, comma-joined; ``kind``, how names begin; ``rows``, most of a sheet."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def writer(self, schema, overwrite: bool) -> XlsxWriter:
        by = [c for c in self.options.get("by", "").split(",") if c]
        return XlsxWriter(self.options["path"], self.options.get("kind", "export"), by, schema.fieldNames(), uuid.uuid4().hex, int(self.options.get("rows", SHEET_ROWS)))


def export_xlsx(df: DataFrame, folder: str, by: list[str], order: list[str], kind: str = "prices", rows: int = SHEET_ROWS) -> None:
    """A file ``kind_<values of by>.xlsx`` for each group, its rows in ``order``; files of that name are replaced.

    Groups go to tasks by their key; a group beyond a sheet's rows gives several files. The folder is one that driver
    and executors share, or an address that Arrow's file systems know.
    """
    spark: SparkSession = df.sparkSession
    spark.dataSource.register(XlsxSource)
    dealt = df.repartition(*by).sortWithinPartitions(*by, *order) if by else df.coalesce(1).sortWithinPartitions(*order)
    dealt.write.format("xlsx").mode("append").option("by", ",".join(by)).option("kind", kind).option("rows", rows).save(target(spark, folder))
