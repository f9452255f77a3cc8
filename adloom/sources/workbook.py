"""Workbooks of several sheets (.xlsx), read and written with the standard library: a zip of XML parts."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession

#: Rows of a sheet, which the format limits.
MOST_ROWS = 1_048_576
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACK = "http://schemas.openxmlformats.org/package/2006"
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")
_PLACE = re.compile(r"([A-Z]+)(\d+)")


def _letters(k: int) -> str:
    out = ""
    while k >= 0:
        k, r = divmod(k, 26)
        out, k = chr(65 + r) + out, k - 1
    return out


def _cell(k: int, row: int, value) -> str:
    at = f"{_letters(k)}{row}"
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{at}"><v>{value!r}</v></c>'
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(_BAD.sub("", str(value)))}</t></is></c>'


def to_bytes(sheets: dict[str, tuple[list[str], list[tuple]]]) -> bytes:
    """A workbook of named sheets, each column names and rows."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    names, out = list(sheets), io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(len(names)))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{_PACK}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{_PACK}/relationships"><Relationship Id="r1" Type="{_LINK}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n[:31], {chr(34): "&quot;"})}" sheetId="{i + 1}" r:id="r{i + 1}"/>' for i, n in enumerate(names))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN}" xmlns:r="{_LINK}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i + 1}" Type="{_LINK}/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names)))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{_PACK}/relationships">{links}</Relationships>')
        for i, (columns, rows) in enumerate(sheets.values()):
            lines = (f'<row r="{r}">{"".join(_cell(k, r, v) for k, v in enumerate(row))}</row>' for r, row in enumerate([tuple(columns), *rows], 1))
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", f'{head}<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()


def rows_of(data: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """The rows of a sheet (the first without a name) as text, all as long as the longest."""
    tag = lambda n: f"{{{_MAIN}}}{n}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        listed = ElementTree.fromstring(z.read("xl/workbook.xml")).find(tag("sheets"))
        links = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        found = [e for e in listed if sheet is None or e.get("name") == sheet]
        if not found:
            raise ValueError(f"no sheet {sheet!r}")
        target = links[found[0].get(f"{{{_LINK}}}id")].lstrip("/").removeprefix("xl/")
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in e.iter(tag("t"))) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        out: list[list[str | None]] = []
        for row in ElementTree.fromstring(z.read(f"xl/{target}")).iter(tag("row")):
            line: list[str | None] = []
            for c in row:
                m = _PLACE.fullmatch(c.get("r", ""))
                k = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(m[1]))) - 1 if m else len(line)
                line += [None] * (k + 1 - len(line))
                v = c.find(tag("v"))
                text = "".join(t.text or "" for t in c.iter(tag("t"))) if c.get("t") == "inlineStr" else v.text if v is not None else None
                line[k] = shared[int(text)] if c.get("t") == "s" and text is not None else text
            out.append(line)
    width = max(map(len, out), default=0)
    return [r + [None] * (width - len(r)) for r in out]


def write_workbook(sheets: dict[str, DataFrame], path: str) -> None:
    """A report's tables as sheets of one workbook. A sheet that is longer than the format allows raises; data that grows belongs in other formats."""
    made, spark = {}, None
    for name, df in sheets.items():
        spark = df.sparkSession
        rows = df.limit(MOST_ROWS).collect()
        if len(rows) >= MOST_ROWS:
            raise ValueError(f"sheet {name!r} has more rows than a workbook holds")
        made[name] = (df.columns, [tuple(r) for r in rows])
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(to_bytes(made)))
    out.close()


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A sheet as text columns, named by its first row. The file is read on the driver, as the format can't be split and is bounded."""
    data = spark.read.format("binaryFile").load(path).select("content").first()
    rows = rows_of(bytes(data[0]), sheet)
    names = [n or f"column{k}" for k, n in enumerate(rows[0])] if rows else ["empty"]
    return spark.createDataFrame([tuple(r) for r in rows[1:]], ", ".join(f"`{n}` string" for n in names))
