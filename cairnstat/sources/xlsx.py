"""A minimal workbook writer: one sheet per table, labels as header, written on the driver."""

from __future__ import annotations

import os
import re
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame

from ..errors import require

MOST_ROWS = 1_048_575


def _cell(ref: str, value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        text = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value))
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
    return f'<c r="{ref}"><v>{value!r}</v></c>' if value == value else ""


def _column(k: int) -> str:
    name = ""
    while k >= 0:
        name, k = chr(65 + k % 26) + name, k // 26 - 1
    return name


def _sheet(df: DataFrame) -> str:
    rows = df.limit(MOST_ROWS + 1).collect()
    require(len(rows) <= MOST_ROWS, 198, "the table has more rows than a sheet can hold")
    lines = [[(f.metadata or {}).get("label") or f.name for f in df.schema], *map(list, rows)]
    body = "".join(f'<row r="{i}">' + "".join(_cell(f"{_column(k)}{i}", v) for k, v in enumerate(line)) + "</row>" for i, line in enumerate(lines, 1))
    return f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>'


def save_tables(tables: dict[str, DataFrame], path: str, *, replace: bool = False) -> str:
    """Sheets by name; ``.xlsx`` is added to a path without ending."""
    require("../" not in path, 198, "the path may not leave its folder")
    path = path if os.path.splitext(path)[1] else f"{path}.xlsx"
    require(os.path.isdir(os.path.dirname(path) or "."), 601, f"no folder for {path}")
    require(replace or not os.path.exists(path), 602, f"file {path} already exists")
    kind, main = "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "application/vnd.openxmlformats-officedocument.spreadsheetml"
    n = range(1, len(tables) + 1)
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{main}.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{main}.worksheet+xml"/>' for k in n) + "</Types>")
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{kind}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="{kind}"><sheets>' + "".join(f'<sheet name="{escape(name[:31])}" sheetId="{k}" r:id="r{k}"/>' for k, name in zip(n, tables, strict=True)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{k}" Type="{kind}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in n) + "</Relationships>")
        for k, df in zip(n, tables.values(), strict=True):
            z.writestr(f"xl/worksheets/sheet{k}.xml", _sheet(df))
    return path
