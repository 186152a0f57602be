"""Excel workbooks (Office Open XML) and zipped outputs, with the standard library only.

A sheet holds 1,048,576 rows at most, so one task reads or makes one; many files or groups spread over the cluster.
"""

from __future__ import annotations

import io
import math
import os
import re
import uuid
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a sheet under its header: the format's limit.
MOST_ROWS = 1_048_575
# fixed values of the format: namespaces and relationship types
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
TYPES = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def column_number(reference: str) -> int:
    """0 for ``A1``, 27 for ``AB7``."""
    n = 0
    for c in reference.rstrip("0123456789"):
        n = n * 26 + ord(c) - 64
    return n - 1


def column_letters(n: int) -> str:
    out = ""
    while n >= 0:
        out, n = chr(65 + n % 26) + out, n // 26 - 1
    return out


def _text(node: ET.Element | None) -> str | None:
    """The text of a string item, its runs joined without phonetic hints; ``_x000A_`` stands for a character."""
    if node is None:
        return None
    parts = [t.text or "" for child in (node, *node.findall(f"{{{MAIN}}}r")) for t in child.findall(f"{{{MAIN}}}t")]
    return re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), "".join(parts))


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet of a workbook, as texts; rows without a value are left out, an error value is null."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        first = ET.fromstring(book.read("xl/workbook.xml")).find(f"{{{MAIN}}}sheets/{{{MAIN}}}sheet")
        links = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = next(x.get("Target") for x in links if x.get("Id") == first.get(f"{{{LINKS}}}id"))
        path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(x) for x in ET.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{{{MAIN}}}si")]
        with book.open(path) as sheet:
            for _, row in ET.iterparse(sheet):
                if row.tag != f"{{{MAIN}}}row":
                    continue
                cells: list[str | None] = []
                for i, cell in enumerate(row.findall(f"{{{MAIN}}}c")):
                    at = column_number(cell.get("r")) if cell.get("r") else i
                    cells += [None] * (at + 1 - len(cells))
                    kind, value = cell.get("t", "n"), cell.findtext(f"{{{MAIN}}}v")
                    if kind == "s" and value is not None:
                        value = shared[int(value)]
                    elif kind == "inlineStr":
                        value = _text(cell.find(f"{{{MAIN}}}is"))
                    cells[at] = None if kind == "e" else value
                row.clear()
                if any(x is not None for x in cells):
                    yield cells


def parse_sheets(files: DataFrame, ddl: str) -> DataFrame:
    """The columns of ``ddl`` from the first sheets of workbooks (path, content), found by the names in the first row.

    A column that a sheet lacks, and a value that does not fit its type, is null; of equal names the first column counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = sheet_rows(content.as_py())
                names = next(rows, [])
                cells = []
                for row in rows:
                    found: dict[str, str] = {}
                    for name, value in zip(names, row, strict=False):
                        if name is not None and value is not None:
                            found.setdefault(name, value)
                    cells.append(list(found.items()))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(cells), pa.string()), pa.array(cells, pa.map_(pa.string(), pa.string()))], ["path", "cells"])

    rows = files.select("path", "content").mapInArrow(run, "path string, cells map<string,string>")
    out = []
    for field in T.StructType.fromDDL(ddl).fields:
        value = F.try_element_at("cells", F.lit(field.name))
        if isinstance(field.dataType, T.IntegralType):  # whole numbers may be written as 3.0
            value = F.coalesce(value.try_cast(field.dataType), value.try_cast("double").try_cast(field.dataType))
        out.append(value.try_cast(field.dataType).alias(field.name))
    return rows.select(*out)


def read_sheets(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """``parse_sheets`` of the .xlsx files at ``path``, a file, folder or pattern."""
    return parse_sheets(spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path), ddl)


def _cell(at: str, value: object) -> str:
    if value is None or (isinstance(value, float) and not math.isfinite(value)):
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float):
        return f'<c r="{at}"><v>{value!r}</v></c>'
    text = re.sub("_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", str(value))
    text = re.sub(r"[\x00-\x08\x0b-\x1f\ufffe\uffff]", lambda m: f"_x{ord(m[0]):04X}_", text)
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def workbook(names: list[str], rows: list[tuple], sheet: str = "Sheet1") -> bytes:
    """A workbook with one sheet: a header and rows. Null, NaN and infinities are empty cells; the same rows give the same bytes."""
    if len(rows) > MOST_ROWS:
        raise ValueError(f"a sheet holds {MOST_ROWS} rows, not {len(rows)}")
    letters = [column_letters(i) for i in range(len(names))]
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{TYPES}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{TYPES}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for path, xml in parts.items():
            book.writestr(zipfile.ZipInfo(path), f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n{xml}')
        info = zipfile.ZipInfo("xl/worksheets/sheet1.xml")
        info.compress_type = zipfile.ZIP_DEFLATED
        with book.open(info, "w") as body:
            body.write(f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<worksheet xmlns="{MAIN}"><sheetData>'.encode())
            for n, row in enumerate([tuple(names), *rows], 1):
                cells = "".join(_cell(f"{c}{n}", v) for c, v in zip(letters, row, strict=True))
                body.write(f'<row r="{n}">{cells}</row>'.encode())
            body.write(b"</sheetData></worksheet>")
    return out.getvalue()


def sheet_files(df: DataFrame, order: str, by: str | None = None, name: str = "sheet") -> DataFrame:
    """(name, content) of a workbook of ``df``'s rows by ``order``, or of one for each value of ``by``; ``write_files``
    puts them into a folder. A frame without rows still gives a workbook with its header, unless ``by`` is given."""
    columns = df.columns
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("_order"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))))
    held = df.groupBy(*([by] if by else [])).agg(rows.alias("_rows"))
    file = F.concat(F.lit(name), F.concat(F.lit("-"), F.coalesce(F.col(by).cast("string"), F.lit("null"))) if by else F.lit(""), F.lit(".xlsx"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                made = workbook(columns, [tuple(x["_row"].values()) for x in found.as_py()])
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([made], pa.binary())], ["name", "content"])

    return held.select(file.alias("name"), "_rows").mapInArrow(run, "name string, content binary")


def zip_outputs(directory: str, archive: str, suffix: str = ".mha") -> int:
    """The files of a mounted folder that end in ``suffix`` go into an archive there; they are deleted once it is complete.
    The number of files comes back; without any, nothing is written."""
    found = sorted(x for x in os.listdir(directory) if x.endswith(suffix))
    if found:
        part = os.path.join(directory, f".{uuid.uuid4().hex}")
        with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as out:
            for x in found:
                out.write(os.path.join(directory, x), x)
        os.replace(part, os.path.join(directory, archive))
        for x in found:
            os.remove(os.path.join(directory, x))
    return len(found)
