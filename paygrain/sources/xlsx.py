"""Workbooks, with the standard library alone: a Spark data source that reads, a writer for small results.

    spark.dataSource.register(XlsxSource)
    spark.read.format("xlsx").option("sheet", "*").load("dir/*.xlsx")
"""

from __future__ import annotations

import glob as _glob
import os
import re
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path
from typing import BinaryIO
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def workbooks(path: str) -> list[str]:
    """Workbooks of a folder or pattern, in the order of their names, without the lock files of open ones."""
    path = path.removeprefix("file://").removeprefix("file:")
    found = _glob.glob(os.path.join(path, "*.xlsx")) if os.path.isdir(path) else _glob.glob(path)
    return sorted(f for f in found if not os.path.basename(f).startswith("~$"))


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheets(path: str | BinaryIO, sheet: str = "*", skip: int = 0) -> Iterator[tuple[str, list[str], Iterator[tuple[int, list[str | None]]]]]:
    """(sheet name, headers, rows) of the sheets that match: * for all, a number from 1, or a name. path: or an open file."""
    with zipfile.ZipFile(path) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ET.fromstring(z.read("xl/workbook.xml")).find("m:sheets", _NS)
        for i, s in enumerate(book, 1):
            if sheet not in ("*", str(i), s.get("name")):
                continue
            target = rels[s.get(_REL)].lstrip("/")
            target = target if target.startswith("xl/") else f"xl/{target}"
            rows = _rows(z, target, shared)
            for _ in range(skip):
                next(rows, None)
            head = next(rows, None)
            if head is not None:
                yield s.get("name"), [h if h is not None else f"_{k + 1}" for k, h in enumerate(head[1])], rows


def _rows(z: zipfile.ZipFile, member: str, shared: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    tag = f"{{{_NS['m']}}}"
    with z.open(member) as f:
        for _, e in ET.iterparse(f):
            if e.tag != f"{tag}row":
                continue
            out: list[str | None] = []
            for c in e:
                k = _column(c.get("r")) if c.get("r") else len(out)
                out += [None] * (k + 1 - len(out))
                v, kind = c.find("m:v", _NS), c.get("t")
                if kind == "inlineStr":
                    out[k] = "".join(t.text or "" for t in c.iter(f"{tag}t"))
                elif v is not None and v.text is not None:
                    out[k] = shared[int(v.text)] if kind == "s" else v.text
            yield int(e.get("r") or 0), out
            e.clear()


class XlsxSource(DataSource):
    """One row per sheet row: fichier, feuille, no_ligne, cells (map of header to text). One partition per workbook."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> StructType:
        return StructType([StructField("fichier", StringType()), StructField("feuille", StringType()), StructField("no_ligne", IntegerType()), StructField("cells", MapType(StringType(), StringType()))])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


class _Book(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.sheet, self.skip = options["path"], options.get("sheet", "*"), int(options.get("skip", 0))

    def partitions(self) -> Sequence[InputPartition]:
        return [_Book(p) for p in workbooks(self.path)]

    def read(self, partition: _Book) -> Iterator[tuple]:
        if partition is None:
            return
        for name, head, rows in sheets(partition.path, self.sheet, self.skip):
            for n, (_, row) in enumerate(rows, 1):
                yield os.path.basename(partition.path), name, n, {h: v for h, v in zip(head, row) if v is not None}


def write(path: str | BinaryIO, tables: dict[str, tuple[Sequence[str], Sequence[Sequence]]], freeze: bool = True) -> None:
    """Write a workbook of (headers, rows) per sheet, with a bold, frozen header row. For small results on the driver."""
    names = [re.sub(r"[\\/*?:\[\]]", "_", n)[:31] for n in tables]
    col = lambda k: (chr(64 + k // 26) if k >= 26 else "") + chr(65 + k % 26)

    def cell(r: int, k: int, v: object, style: int) -> str:
        s = f' s="{style}"' if style else ""
        if v is None or v != v:
            return ""
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            return f'<c r="{col(k)}{r}"{s} t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
        return f'<c r="{col(k)}{r}"{s}><v>{v!r}</v></c>'

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(
            "[Content_Types].xml",
            '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
            + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1))
            + "</Types>",
        )
        rel = "http://schemas.openxmlformats.org/package/2006/relationships"
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("_rels/.rels", f'<Relationships xmlns="{rel}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{rel}">' + "".join(f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)) + f'<Relationship Id="rId0" Type="{office}/styles" Target="styles.xml"/></Relationships>',
        )
        z.writestr("xl/workbook.xml", f"<workbook {main}><sheets>" + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr(
            "xl/styles.xml",
            f'<styleSheet {main}><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
            '<cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
        )
        for i, (head, rows) in enumerate(tables.values(), 1):
            pane = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>' if freeze else ""
            body = [f'<row r="1">{"".join(cell(1, k, h, 1) for k, h in enumerate(head))}</row>']
            body += [f'<row r="{r}">{"".join(cell(r, k, v, 0) for k, v in enumerate(row))}</row>' for r, row in enumerate(rows, 2)]
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}>{pane}<sheetData>{''.join(body)}</sheetData></worksheet>")


def sheet_names(path: str | Path) -> list[str]:
    return [n for n, _, _ in sheets(str(path))]
