"""Workbooks with nothing but the standard library: a reader as a Spark data source, and a writer."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from decimal import Decimal
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def column_number(reference: str) -> int:
    """Zero-based column of a cell reference such as ``AB12``."""
    n = 0
    for c in re.match(r"[A-Z]+", reference).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def column_letters(number: int) -> str:
    out = ""
    number += 1
    while number:
        number, rest = divmod(number - 1, 26)
        out = chr(65 + rest) + out
    return out


def _sheets(book: zipfile.ZipFile) -> dict[str, str]:
    rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    found = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
    return {s.get("name"): "xl/" + rels[s.get(_LINK)].removeprefix("/xl/").removeprefix("xl/") for s in found}


def read_rows(path: str, sheet: str | None = None) -> Iterator[tuple[int, list[str]]]:
    """(row number, cells as text) of one sheet, the first unless named; rows without a value are left out."""
    with zipfile.ZipFile(path) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        sheets = _sheets(book)
        with book.open(sheets[sheet] if sheet else next(iter(sheets.values()))) as file:
            for _, row in ElementTree.iterparse(file):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list[str] = []
                for cell in row.iter(f"{_MAIN}c"):
                    at, kind, value = column_number(cell.get("r")), cell.get("t"), cell.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                    else:
                        text = "" if value is None else value.text or ""
                        text = shared[int(text)] if kind == "s" and text else text
                        if kind in (None, "n") and re.fullmatch(r"-?\d+\.0+|-?\d+(\.\d+)?[eE]\+?\d{1,3}", text):
                            exact = Decimal(text)  # a long number stays its digits, a part is never cut off
                            text = str(int(exact)) if exact == exact.to_integral_value() else format(exact, "f")
                    cells += [""] * (at + 1 - len(cells))
                    cells[at] = text
                if any(cells):
                    yield int(row.get("r")), cells
                row.clear()


class XlsxDataSource(DataSource):
    """Options: path, sheet (default the first), headerRow (default 1). Columns as the header names them, and source_sheet, source_row."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _header(self) -> list[str]:
        at = int(self.options.get("headerRow", 1))
        header = next((cells for n, cells in read_rows(self.options["path"], self.options.get("sheet")) if n >= at), [])
        names = ["source_sheet", "source_row"]  # taken; a column of that name gets its number added
        for i, cell in enumerate(header):
            name = cell.strip() or f"_c{i}"
            names.append(name if name not in names else f"{name}_{i}")
        return names[2:]

    def schema(self) -> StructType:
        own = [StructField(n, StringType()) for n in self._header()]
        return StructType([*own, StructField("source_sheet", StringType()), StructField("source_row", IntegerType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return XlsxReader(self.options, len(schema) - 2)


class XlsxReader(DataSourceReader):
    def __init__(self, options, width: int):
        self.options, self.width = dict(options), width

    def read(self, partition):
        path, sheet, at = self.options["path"], self.options.get("sheet"), int(self.options.get("headerrow", self.options.get("headerRow", 1)))
        if not sheet:
            with zipfile.ZipFile(path) as book:
                sheet = next(iter(_sheets(book)))
        header = True
        for number, cells in read_rows(path, sheet):
            if number < at:
                continue
            if header:
                header = False
                continue
            yield (*(cells + [""] * self.width)[: self.width], sheet, number)


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None, header_row: int = 1) -> DataFrame:
    """A sheet as text columns. The workbook lies where driver and executors both see it."""
    from loomspan.sources.tables import ship_package

    ship_package(spark)
    spark.dataSource.register(XlsxDataSource)
    reader = spark.read.format("xlsx").option("headerRow", header_row)
    return (reader.option("sheet", sheet) if sheet else reader).option("path", path).load()


def write_xlsx(path: str, sheets: Iterable[tuple[str, Sequence[str], Iterable[Sequence]]], overwrite: bool = False) -> None:
    """Sheets (name, header, rows) as a workbook of text cells; a file that is there is refused unless told otherwise."""
    sheets = list(sheets)
    with zipfile.ZipFile(path, "w" if overwrite else "x", zipfile.ZIP_DEFLATED) as book:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        book.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        base = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        book.writestr("_rels/.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{base}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{base}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        names = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, (n, _, _) in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{base}"><sheets>{names}</sheets></workbook>')
        for i, (_, header, rows) in enumerate(sheets, 1):
            with book.open(f"xl/worksheets/sheet{i}.xml", "w") as out:
                out.write(f'{head}<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())
                number = 0
                for number, row in enumerate((header, *rows) if isinstance(rows, list | tuple) else _chain(header, rows), 1):
                    cells = "".join(f'<c r="{column_letters(k)}{number}" t="inlineStr"><is><t xml:space="preserve">{escape("" if v is None else str(v))}</t></is></c>' for k, v in enumerate(row))
                    out.write(f'<row r="{number}">{cells}</row>'.encode())
                out.write(b"</sheetData></worksheet>")


def _chain(header, rows):
    yield header
    yield from rows


def export_frames(path: str, frames: Sequence[tuple[str, DataFrame]], overwrite: bool = False) -> None:
    """Result tables as sheets, streamed to the driver a partition at a time."""
    write_xlsx(path, [(name, df.columns, (tuple(r) for r in df.toLocalIterator())) for name, df in frames], overwrite)
