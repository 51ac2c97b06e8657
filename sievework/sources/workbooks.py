"""Excel workbooks: cells as text as they stand, and workbooks for people with lists to choose from.

Reading: Spark reads the files, a task takes one workbook at a time and goes through a sheet's XML row by row. Text keeps its spaces and
line breaks; a whole number has no point; true and false are TRUE and FALSE; formulas give their stored value; errors and empty cells are
null. Writing: a workbook is put together in memory from a bounded number of rows (more are an error) and takes its name only when it is
whole; one that exists is never written over.
"""

import io
import os
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .sinks import copy_files

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
MOST_ROWS, MOST_CHARS, MOST_INLINE = 100_000, 32_767, 250

# reading


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n


def column_letters(n: int) -> str:
    out = ""
    while n:
        n, k = divmod(n - 1, 26)
        out = chr(65 + k) + out
    return out


def _said(element) -> str:
    """The text of a string item, its runs joined; readings for other scripts are left out."""
    return "".join(t.text or "" for part in element if part.tag != f"{MAIN}rPh" for t in ([part] if part.tag == f"{MAIN}t" else part.iter(f"{MAIN}t")))


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, path in the file) of the sheets, in their order."""
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    found = []
    for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet"):
        target = links[s.get(LINK)]
        found.append((s.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return found


def _value(cell, shared: list[str]) -> str | None:
    kind, v = cell.get("t", "n"), cell.find(f"{MAIN}v")
    if kind == "inlineStr":
        inline = cell.find(f"{MAIN}is")
        return _said(inline) if inline is not None else None
    if v is None or v.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "TRUE" if v.text == "1" else "FALSE"
    if kind in ("str", "d"):
        return v.text
    n = float(v.text)
    return str(int(n)) if n.is_integer() else repr(n)


def rows_of(content: bytes, wanted: str | None = None) -> Iterator[tuple[str, int, dict[int, str]]]:
    """(sheet, row, {column: text}) of every row with a cell that is not null; columns and rows count from 1."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as f:
                for _, e in ElementTree.iterparse(f):
                    if e.tag == f"{MAIN}si":
                        shared.append(_said(e))
                        e.clear()
        for name, path in _sheets(book):
            if wanted not in (None, name):
                continue
            with book.open(path) as f:
                row_no = 0
                for _, e in ElementTree.iterparse(f):
                    if e.tag != f"{MAIN}row":
                        continue
                    row_no = int(e.get("r") or row_no + 1)
                    cells, at = {}, 0
                    for c in e.iter(f"{MAIN}c"):
                        at = column_number(re.match("[A-Z]+", c.get("r"))[0]) if c.get("r") else at + 1
                        if (v := _value(c, shared)) is not None:
                            cells[at] = v
                    e.clear()
                    if cells:
                        yield name, row_no, cells


def lists_of(content: bytes) -> dict[tuple[str, str], list[str]]:
    """The values to choose from, by sheet and range of cells; also those that stand in cells of another sheet."""
    out = {}
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheets = _sheets(book)
        for name, path in sheets:
            for v in ElementTree.fromstring(book.read(path)).iter(f"{MAIN}dataValidation"):
                if v.get("type") != "list":
                    continue
                rule = v.findtext(f"{MAIN}formula1") or ""
                if rule.startswith('"'):
                    out[name, v.get("sqref")] = rule.strip('"').replace('""', '"').split(",")
                elif m := re.fullmatch(r"'?(.+?)'?!\$([A-Z]+)\$(\d+):\$[A-Z]+\$(\d+)", rule):
                    rows = {r: cells for _, r, cells in rows_of(content, m[1])}
                    out[name, v.get("sqref")] = [rows.get(r, {}).get(column_number(m[2]), "") for r in range(int(m[3]), int(m[4]) + 1)]
    return out


def cells(spark: SparkSession, path: str) -> DataFrame:
    """path, sheet, row_no, column_no and value of every cell of the workbooks at a path (a folder or a pattern, too)."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for source, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                found = []
                for name, row, values in rows_of(content):
                    found += [(source, name, row, column, value) for column, value in values.items()]
                    if len(found) > 50_000:
                        yield _batch(found, pa)
                        found = []
                yield _batch(found, pa)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, "path string, sheet string, row_no long, column_no int, value string")


def _batch(rows: list[tuple], pa):
    columns = zip(*rows) if rows else ((),) * 5
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "sheet", "row_no", "column_no", "value"])


def sheet(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A sheet as it stands, with row_no, the row's number in it (the header is 1). A column without a name is col_N, one whose name
    stands before has its number added; rows without any text are left out. A workbook without the sheet is an error."""
    files = spark.read.format("binaryFile").load(path)

    def heads(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for content in batch.column("content").to_pylist():
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    found = name in dict(_sheets(book))
                    widest = max((max(c) for _, _, c in rows_of(content, name)), default=0) if found else 0
                first = next(((r, c) for _, r, c in rows_of(content, name)), (1, {})) if found else (1, {})
                head = first[1] if first[0] == 1 else {}
                yield pa.RecordBatch.from_pydict({"found": [found], "head": pa.array([[head.get(i) for i in range(1, widest + 1)]], pa.list_(pa.string()))})

    head = files.select("content").mapInArrow(heads, "found boolean, head array<string>").first()
    if head is None or not head.found:
        raise ValueError(f"{path} has no sheet {name!r}")
    names: list[str] = []
    for i, x in enumerate(head.head, 1):
        x = x if x else f"col_{i}"
        names.append(f"{x}_{i}" if x in names else x)

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for content in batch.column("content").to_pylist():
                held = []
                for _, row, values in rows_of(content, name):
                    if row > 1 and any(v for v in values.values()):
                        held.append((row, *[values.get(i) for i in range(1, len(names) + 1)]))
                    if len(held) >= 4096:
                        yield wide(held, pa)
                        held = []
                yield wide(held, pa)

    def wide(held: list[tuple], pa):
        columns = list(zip(*held)) if held else [()] * (len(names) + 1)
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.string()) for c in columns[1:]]], names=["row_no", *names])

    schema = StructType([StructField("row_no", LongType()), *[StructField(n, StringType()) for n in names]])
    return files.select("content").mapInArrow(rows, schema)


# writing


@dataclass
class Look:
    """How a sheet of rows looks. lists: values to choose from, by column, or by (column, row) with rows counted from 1 under the header;
    hidden, answer (to be filled in, coloured) and widths are of columns; frozen: the columns left of it stay; filtered: with filter arrows."""

    lists: dict = field(default_factory=dict)
    hidden: tuple[str, ...] = ()
    answer: tuple[str, ...] = ()
    widths: dict[str, float] = field(default_factory=dict)
    frozen: str | None = None
    filtered: bool = True
    message: str = "Choose a value of the list."


STYLES = (
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><fonts count="2"><font><sz val="11"/><name val="Calibri"/></font><font><b/><sz val="11"/><name val="Calibri"/></font></fonts>'
    '<fills count="4"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill><fill><patternFill patternType="solid"><fgColor rgb="FFE8ECEF"/></patternFill></fill>'
    '<fill><patternFill patternType="solid"><fgColor rgb="FFFFF2A8"/></patternFill></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="5">'
    + "".join(f'<xf fontId="{font}" fillId="{fill}" applyFont="1" applyFill="1" applyAlignment="1"><alignment wrapText="1" vertical="top"/></xf>' for font, fill in ((0, 0), (1, 2), (0, 3), (1, 3), (1, 0)))
    + "</cellXfs></styleSheet>"
)
PLAIN, HEAD, ANSWER, ANSWER_HEAD, BOLD = range(5)


def _cell(column: int, row: int, value, style: int) -> str:
    at = f'r="{column_letters(column)}{row}" s="{style}"'
    if value is None or value == "":
        return f"<c {at}/>"
    if isinstance(value, bool):
        return f'<c {at} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and abs(value) < 1e15 and value == value:
        return f"<c {at}><v>{value!r}</v></c>"
    text = str(value)
    if len(text) > MOST_CHARS:
        raise ValueError(f"the cell {column_letters(column)}{row} has more than {MOST_CHARS} characters")
    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", text).replace("\r", "&#13;") if not text.isprintable() else text
    return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(text).replace("&amp;#13;", "&#13;")}</t></is></c>'


def _rule(values: list[str], at: str, message: str, far: list[list[str]]) -> str:
    """A list to choose from: in place if it is short and has no commas, else in a column of the hidden sheet (far)."""
    inline = ",".join(values)
    if len(inline) <= MOST_INLINE and not any("," in v for v in values):
        rule = '"' + inline.replace('"', '""') + '"'
    else:
        if values not in far:
            far.append(values)
        column = column_letters(far.index(values) + 1)
        rule = f"lists!${column}$1:${column}${len(values)}"
    return f'<dataValidation type="list" allowBlank="1" showErrorMessage="1" error={quoteattr(message[:225])} sqref="{at}"><formula1>{escape(rule)}</formula1></dataValidation>'


def _rows_sheet(columns: list[str], rows: list, look: Look, far: list[list[str]]) -> str:
    place = {c: i for i, c in enumerate(columns, 1)}
    out = ['<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">']
    left = place[look.frozen] - 1 if look.frozen else 0
    split = f'xSplit="{left}" ' if left else ""
    out.append(f'<sheetViews><sheetView workbookViewId="0"><pane {split}ySplit="1" topLeftCell="{column_letters(left + 1)}2" activePane="{"bottomRight" if left else "bottomLeft"}" state="frozen"/></sheetView></sheetViews>')
    shown = [f'<col min="{i}" max="{i}" width="{look.widths.get(c, 14)}" customWidth="1"{" hidden=" + chr(34) + "1" + chr(34) if c in look.hidden else ""}/>' for c, i in place.items()]
    out.append(f"<cols>{''.join(shown)}</cols><sheetData>")
    answer = [c in look.answer for c in columns]
    out.append('<row r="1">' + "".join(_cell(i, 1, c, ANSWER_HEAD if a else HEAD) for i, (c, a) in enumerate(zip(columns, answer), 1)) + "</row>")
    for n, row in enumerate(rows, 2):
        out.append(f'<row r="{n}">' + "".join(_cell(i, n, v, ANSWER if a else PLAIN) for i, (v, a) in enumerate(zip(row, answer), 1)) + "</row>")
    out.append("</sheetData>")
    last = len(rows) + 1
    if look.filtered and columns:
        out.append(f'<autoFilter ref="A1:{column_letters(len(columns))}{last}"/>')
    rules: dict[tuple, list[str]] = {}
    for key, values in look.lists.items():
        column, row = key if isinstance(key, tuple) else (key, None)
        letters = column_letters(place[column])
        rules.setdefault(tuple(values), []).append(f"{letters}{row + 1}" if row else f"{letters}2:{letters}{max(2, last)}")
    if rules:
        out.append(f'<dataValidations count="{len(rules)}">' + "".join(_rule(list(v), " ".join(at), look.message, far) for v, at in rules.items()) + "</dataValidations>")
    return "".join([*out, "</worksheet>"])


def _text_sheet(lines: list[str]) -> str:
    """Lines of a note, one a row; a line that begins with ## is a heading."""
    rows = "".join(f'<row r="{n}">{_cell(1, n, x.removeprefix("## "), BOLD if x.startswith("## ") else PLAIN)}</row>' for n, x in enumerate(lines, 1))
    return f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><cols><col min="1" max="1" width="120" customWidth="1"/></cols><sheetData>{rows}</sheetData></worksheet>'


def workbook(sheets: dict) -> bytes:
    """A workbook of named sheets: (columns, rows, Look) or a list of lines."""
    far: list[list[str]] = []
    pages = {n: _text_sheet(s) if isinstance(s, list) else _rows_sheet(*s, far) for n, s in sheets.items()}
    if bad := [n for n in pages if not n or len(n) > 31 or re.search(r"[\[\]:*?/\\]", n) or n == "lists"]:
        raise ValueError(f"no names for sheets: {', '.join(map(repr, bad))}")
    names = list(pages)
    if far:
        deep = max(map(len, far))
        body = "".join(f'<row r="{r}">' + "".join(_cell(c, r, v[r - 1], PLAIN) for c, v in enumerate(far, 1) if r <= len(v)) + "</row>" for r in range(1, deep + 1))
        pages["lists"] = f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    listed = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"{"" if n in names else " state=" + chr(34) + "hidden" + chr(34)}/>' for i, n in enumerate(pages, 1))
    links = "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(pages) + 1))
    parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(pages) + 1))
    files = {
        "[Content_Types].xml": f'<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{parts}</Types>',
        "_rels/.rels": f'<Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{pack}/relationships">{links}<Relationship Id="rId0" Type="{rel}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": STYLES,
    } | {f"xl/worksheets/sheet{i}.xml": p for i, p in enumerate(pages.values(), 1)}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for path, text in files.items():
            book.writestr(zipfile.ZipInfo(path), '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def write_workbook(path: str, sheets: dict, looks: dict[str, Look] | None = None, most: int = MOST_ROWS) -> dict[str, int]:
    """A workbook of DataFrames and of lists of lines, written by the driver; gives the number of rows of each sheet.

    Rows stand in the DataFrame's own order. A path that exists and a sheet of more rows than `most` are errors; the file takes its name
    when it is whole, and nobody's file is replaced.
    """
    if os.path.exists(path):
        raise FileExistsError(path)
    parts, counts = {}, {}
    for name, s in sheets.items():
        if isinstance(s, list):
            parts[name] = s
            continue
        rows = s.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{name} has more than {most} rows; write it as Parquet")
        parts[name], counts[name] = (s.columns, rows, (looks or {}).get(name, Look())), len(rows)
    content = workbook(parts)
    with open(part := f"{path}.part", "xb") as f:
        f.write(content)
    try:
        os.link(part, path)  # fails where a file of that name has come meanwhile
    finally:
        os.unlink(part)
    return counts


def write_workbooks(df: DataFrame, by: str, order: list[str], folder: str, sheet_name: str, look: Look | None = None, most: int = MOST_ROWS, numbered: bool = False) -> DataFrame:
    """name and size of one workbook for each value of a column, with its rows in order, put together and written by the tasks to a folder
    that all share. A value names its file; one with more rows than `most` is an error. Lists are given by column only.

    If numbered, a value has as many workbooks as it needs, each of at most `most` rows: its rows are ranged over the tasks, and the names
    end in the task's and the workbook's number (`value-00002-0001.xlsx`), so that they stand in the order of the rows.
    """
    columns, look = [c for c in df.columns if c != by], look or Look()
    kinds = df.schema

    def books(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, held, n = None, [], 0
        task = TaskContext.get().partitionId() if numbered else 0

        def book():
            number = f"-{task:05}-{n:04}" if numbered else ""
            return pa.RecordBatch.from_pydict({"name": [f"{re.sub(r'[^\w.-]', '_', str(key))}{number}.xlsx"], "content": pa.array([workbook({sheet_name: (columns, held, look)})], pa.binary())})

        for batch in batches:
            rows = zip(batch.column(by).to_pylist(), zip(*(batch.column(c).to_pylist() for c in columns)))
            for value, row in rows:
                if held and (value != key or numbered and len(held) == most):
                    n += 1
                    yield book()
                    held = []
                key = value
                held.append(row)
                if len(held) > most:
                    raise ValueError(f"{by} {key} has more than {most} rows; write it as Parquet")
        if held:
            n += 1
            yield book()

    assert by in kinds.names
    rows = df.where(F.col(by).isNotNull())
    rows = rows.repartitionByRange(by, *order) if numbered else rows.repartition(by)
    made = rows.sortWithinPartitions(by, *order).mapInArrow(books, "name string, content binary")
    return copy_files(made, folder)
