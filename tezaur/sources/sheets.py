"""Spreadsheets (xlsx) and timetable XML."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def sheet_rows(path: str, sheet: int = 1) -> Iterator[list[str | None]]:
    """Cell texts of a worksheet, row after row."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ET.parse(z.open("xl/sharedStrings.xml")).getroot().findall("m:si", _NS)]
        for _, row in ET.iterparse(z.open(f"xl/worksheets/sheet{sheet}.xml")):
            if not row.tag.endswith("}row"):
                continue
            cells: list[str | None] = []
            for c in row.findall("m:c", _NS):
                letters = re.match("[A-Z]+", c.get("r", "") or "")
                at = sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(letters[0]))) - 1 if letters else len(cells)
                cells += [None] * (at + 1 - len(cells))
                v, t = c.find("m:v", _NS), c.get("t")
                if t == "inlineStr":
                    cells[at] = "".join(x.text or "" for x in c.iter(f"{{{_NS['m']}}}t"))
                elif v is not None and v.text is not None:
                    cells[at] = shared[int(v.text)] if t == "s" else v.text
            yield cells
            row.clear()


def headers(cells: list[str | None]) -> list[str]:
    """Column names: blank ones are called col_<place>."""
    return [c.strip() if c and c.strip() else f"col_{i}" for i, c in enumerate(cells)]


class Sheet(DataSource):
    """spark.read.format("sheet").option("header", place).load(path): rows below the header row (counted from 0) as text columns; rows
    without any value are left out, of equal column names the last one's value counts."""

    @classmethod
    def name(cls) -> str:
        return "sheet"

    def _header(self) -> list[str]:
        skip = int(self.options.get("header", "0"))
        for i, cells in enumerate(sheet_rows(self.options["path"])):
            if i == skip:
                return headers(cells)
        return []

    def schema(self) -> StructType:
        return StructType([StructField(n, StringType()) for n in dict.fromkeys(self._header())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SheetReader(dict(self.options), schema.fieldNames())


class _SheetReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]) -> None:
        self.options, self.names = options, names

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        skip, given = int(self.options.get("header", "0")), []
        for i, cells in enumerate(sheet_rows(self.options["path"])):
            if i == skip:
                given = headers(cells)
            elif i > skip and any(c is not None for c in cells):
                row = dict(zip(given, [*cells, *[None] * (len(given) - len(cells))]))
                yield tuple(row.get(n) for n in self.names)


def read_sheet(spark: SparkSession, path: str, header: int = 0) -> DataFrame:
    spark.dataSource.register(Sheet)
    return spark.read.format("sheet").option("header", str(header)).load(path)


TRAIN = """_Numar string, _Operator string, _CategorieTren string, Trase struct<Trasa: struct<ElementTrasa: array<struct<_CodStaDest string,
_DenStaDestinatie string, _OraS string, _OraP string, _Rci string, CalendarTren struct<_Zile string>>>>>, RestrictiiTren struct<CalendarTren: struct<_Zile string>>,
CalendarTren struct<_Zile string>"""


def read_trains(spark: SparkSession, path: str, tag: str = "Tren", schema: str = TRAIN) -> DataFrame:
    """One row for each train element, attributes as text."""
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
