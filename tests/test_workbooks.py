import io
import os
import zipfile

import pytest

from sievework.sources import workbooks as w

ROWS = [(1, " two  spaces ", 1.5, True, None), (2, "line\nbreak <&> \"q\" ' é \U0001f600", 12.0, False, "x"), (3, "", -3.25e-7, None, "a,b"), (4, "00012", 1e14, None, "TRUE")]
KIND = "id long, t string, n double, b boolean, v string"


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, KIND).orderBy("id")
    many = [f"value {i}" for i in range(60)]
    look = w.Look(lists={"v": ["x", "y z"], ("t", 2): many, ("t", 4): ["a,b", "c"]}, hidden=("n",), answer=("v",), widths={"t": 40}, frozen="t")
    path = f"{tmp_path}/book.xlsx"
    assert w.write_workbook(path, {"READ ME": ["## Title", "a line", ""], "rows & more": df}, {"rows & more": look}) == {"rows & more": 4}
    assert os.listdir(tmp_path) == ["book.xlsx"]
    got = {(r.row_no, r.column_no): r.value for r in w.cells(spark, path).where("sheet = 'rows & more'").collect()}
    text = lambda x: str(x).upper() if isinstance(x, bool) else str(int(x)) if isinstance(x, float) and x.is_integer() else str(x)
    want = {(1, i): c for i, c in enumerate(df.columns, 1)} | {(r, i): text(x) for r, row in enumerate(ROWS, 2) for i, x in enumerate(row, 1) if x not in (None, "")}
    assert got == want
    content = open(path, "rb").read()
    lists = w.lists_of(content)
    assert lists["rows & more", "E2:E5"] == ["x", "y z"] and lists["rows & more", "B3"] == many and lists["rows & more", "B5"] == ["a,b", "c"]
    xml = zipfile.ZipFile(io.BytesIO(content)).read("xl/worksheets/sheet2.xml").decode()
    assert 'topLeftCell="B2"' in xml and '<col min="3" max="3" width="14" customWidth="1" hidden="1"/>' in xml and "autoFilter" in xml
    assert [r.value for r in w.cells(spark, path).where("sheet = 'READ ME'").orderBy("row_no").collect()] == ["Title", "a line"]
    with pytest.raises(FileExistsError):
        w.write_workbook(path, {"a": df})
    with pytest.raises(ValueError, match="more than 3"):
        w.write_workbook(f"{tmp_path}/no.xlsx", {"a": df}, most=3)
    with pytest.raises(ValueError, match="characters"):
        w.write_workbook(f"{tmp_path}/no.xlsx", {"a": spark.createDataFrame([("x" * 40_000,)], "t string")})
    with pytest.raises(ValueError, match="names"):
        w.workbook({"a/b": ["x"]})
    assert os.listdir(tmp_path) == ["book.xlsx"]


def test_a_sheet_by_name(spark, tmp_path):
    rows = [("a", None, "1", " "), (None, "", None, None), (" ", "x", None, "3"), (None, None, None, None), ("z", None, None, None)]
    book = w.workbook({"other": ["x"], "data": (["name", "", "name", "d"], rows, w.Look())})
    open(f"{tmp_path}/b.xlsx", "wb").write(book)
    d = w.sheet(spark, f"{tmp_path}/b.xlsx", "data")
    assert d.columns == ["row_no", "name", "col_2", "name_3", "d"]
    assert sorted(map(tuple, d.collect()), key=str) == [(2, "a", None, "1", " "), (4, " ", "x", None, "3"), (6, "z", None, None, None)]
    with pytest.raises(ValueError, match="no sheet"):
        w.sheet(spark, f"{tmp_path}/b.xlsx", "none")
    empty = w.workbook({"data": (["a"], [], w.Look())})
    open(f"{tmp_path}/e.xlsx", "wb").write(empty)
    assert w.sheet(spark, f"{tmp_path}/e.xlsx", "data").collect() == []


def test_what_other_programs_write(spark, tmp_path):
    """Shared strings with runs and readings, cells without places, formulas, errors, and a sheet path from the root."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    parts = {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="a"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="a" Target="/xl/worksheets/s.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst {main}><si><t>plain </t></si><si><r><t>two </t></r><r><t>runs</t></r><rPh sb="0" eb="1"><t>no</t></rPh></si></sst>',
        "xl/worksheets/s.xml": f'<worksheet {main}><sheetData><row><c t="s"><v>0</v></c><c t="s"><v>1</v></c></row><row r="5"><c r="AB5" t="e"><v>#N/A</v></c><c r="AC5" t="str"><f>A1</f><v>made</v></c><c r="AD5"><v>0.1</v></c><c r="AE5" t="b"><v>1</v></c></row></sheetData></worksheet>',
    }
    with zipfile.ZipFile(f"{tmp_path}/o.xlsx", "w") as z:
        for n, x in parts.items():
            z.writestr(n, x)
    got = sorted((r.row_no, r.column_no, r.value) for r in w.cells(spark, f"{tmp_path}/o.xlsx").collect())
    assert got == [(1, 1, "plain "), (1, 2, "two runs"), (5, 29, "made"), (5, 30, "0.1"), (5, 31, "TRUE")]


def test_one_workbook_for_each_value(spark, tmp_path):
    df = spark.range(40).selectExpr("concat('r', id % 3) AS reviewer", "id", "concat('t ', id) AS t")
    made = w.write_workbooks(df, "reviewer", ["id"], f"{tmp_path}/out", "review", w.Look(lists={"t": ["a"]}, answer=("t",)))
    assert sorted(r.name for r in made.collect()) == ["r0.xlsx", "r1.xlsx", "r2.xlsx"]
    d = w.sheet(spark, f"{tmp_path}/out/r1.xlsx", "review")
    assert [int(r.id) for r in d.orderBy("row_no").collect()] == list(range(1, 40, 3))
    with pytest.raises(Exception, match="more than 5"):
        w.write_workbooks(df, "reviewer", ["id"], f"{tmp_path}/no", "review", most=5).collect()


def test_a_value_with_more_rows_than_a_workbook_holds_has_several(spark, tmp_path):
    df = spark.range(40).selectExpr("concat('r', id % 3) AS reviewer", "id", "concat('t ', id) AS t")
    made = w.write_workbooks(df, "reviewer", ["id"], f"{tmp_path}/out", "review", most=5, numbered=True).collect()
    assert len({r.name for r in made}) == len(made) >= 9
    got = {}
    for name in sorted(os.listdir(f"{tmp_path}/out")):
        ids = [int(r.id) for r in w.sheet(spark, f"{tmp_path}/out/{name}", "review").orderBy("row_no").collect()]
        assert 0 < len(ids) <= 5
        got[name[:2]] = got.get(name[:2], []) + ids
    assert got == {f"r{i}": list(range(i, 40, 3)) for i in range(3)}
