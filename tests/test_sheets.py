import math
import zipfile

from larkspur.sources import files, sheets


def test_column_names():
    for n, letters in ((0, "A"), (25, "Z"), (26, "AA"), (701, "ZZ"), (702, "AAA")):
        assert sheets.column_letters(n) == letters and sheets.column_number(f"{letters}12") == n


def test_round_trip(spark, tmp_path):
    ddl = "id long, name string, score double, ok boolean"
    rows = [(1, "a <b> & \"c\"", 0.1, True), (2, None, None, False), (3, "  spaces \n two lines\t", -1e300, None), (4, "_x0041_ \x07 é漢", 3.0, True), (None, "", 5.5, None)]
    df = spark.createDataFrame(rows, ddl)
    sheets_of = sheets.sheet_files(df, "id", name="all")
    assert [r["name"] for r in files.write_files(sheets_of, str(tmp_path)).collect()] == ["all.xlsx"]
    got = {tuple(r) for r in sheets.read_sheets(spark, str(tmp_path), ddl).collect()}
    assert got == set(rows)
    assert [r[0] for r in sheets.read_sheets(spark, str(tmp_path / "all.xlsx"), "other string, id int").select("id", "other").collect()] == [None, 1, 2, 3, 4]


def test_groups_and_empty_frames(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "id long, g string")
    made = sheets.sheet_files(df, "id", "g")
    assert sorted(r["name"] for r in made.collect()) == ["sheet-null.xlsx", "sheet-x.xlsx"]
    none = sheets.sheet_files(df.where("id > 9"), "id").collect()
    assert len(none) == 1 and list(sheets.sheet_rows(none[0]["content"])) == [["id", "g"]]


def test_shared_strings_gaps_and_errors(tmp_path):
    book = tmp_path / "b.xlsx"
    main = f'xmlns="{sheets.MAIN}"'
    with zipfile.ZipFile(book, "w") as out:
        out.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{sheets.LINKS}"><sheets><sheet name="s" sheetId="1" r:id="r7"/></sheets></workbook>')
        out.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{sheets.PACKAGE}/relationships"><Relationship Id="r7" Target="/xl/worksheets/one.xml"/></Relationships>')
        out.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Key</t></si><si><r><t>two </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></si></sst>")
        out.writestr("xl/worksheets/one.xml", f'<worksheet {main}><sheetData><row><c t="s"><v>0</v></c></row><row/><row r="4"><c r="A4" t="s"><v>1</v></c><c r="C4"><v>2.5</v></c><c r="D4" t="e"><v>#N/A</v></c></row></sheetData></worksheet>')
    assert list(sheets.sheet_rows(book.read_bytes())) == [["Key"], ["two runs", None, "2.5", None]]


def test_values_without_a_cell():
    found = list(sheets.sheet_rows(sheets.workbook(["a", "b"], [(math.nan, 1), (math.inf, None), (2, "x")])))
    assert found == [["a", "b"], [None, "1"], ["2", "x"]]


def test_zip_outputs(tmp_path):
    for name in ("b.mha", "a.mha", "keep.txt"):
        (tmp_path / name).write_text(name)
    assert sheets.zip_outputs(str(tmp_path), "predictions.zip") == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["keep.txt", "predictions.zip"]
    with zipfile.ZipFile(tmp_path / "predictions.zip") as z:
        assert z.namelist() == ["a.mha", "b.mha"] and z.read("a.mha") == b"a.mha"
    assert sheets.zip_outputs(str(tmp_path), "predictions.zip") == 0 and (tmp_path / "predictions.zip").exists()
