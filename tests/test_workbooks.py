"""Workbooks written part by part, read back by folder; into rent rolls."""

from __future__ import annotations

import zipfile

import pytest

from lodeworks.operators import roll_rules
from lodeworks.sources import workbooks as wb

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def write(path, sheets, shared=("Unit", "Market Rent", "Move-In")):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {NS}><sheets>" + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si><r><t>{s[:2]}</t></r><r><t>{s[2:]}</t></r></si>" for s in shared) + "</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {NS}><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="&quot;day&quot; 0.00"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {NS}><sheetData>{rows}</sheetData></worksheet>")


ROLL = (
    '<row r="1"><c r="A1" t="inlineStr"><is><t>As Of = 3/31/2025</t></is></c></row><row r="3"><c r="A3" t="s"><v>0</v></c><c r="B3" t="s"><v>1</v></c><c r="D3" t="s"><v>2</v></c></row>'
    '<row r="4"><c r="A4"><v>101</v></c><c r="B4"><f>1+1</f><v>1250.5</v></c><c r="D4" s="1"><v>45413</v></c></row><row r="5"><c r="A5" t="str"><v>102 &amp; up</v></c><c r="C5" t="b"><v>1</v></c><c r="D5" t="e"><v>#N/A</v></c></row>'
)


def test_cells(spark, tmp_path):
    (tmp_path / "more").mkdir()
    write(tmp_path / "a.xlsx", {"Roll": ROLL, "Other": '<row><c><v>0.5</v></c><c s="2"><v>45413.25</v></c><c s="3"><v>7</v></c><c s="1"><v>0.5</v></c></row>'})
    write(tmp_path / "more" / "b.xlsx", {"Roll": ROLL.replace("101", "201")})
    (tmp_path / "c.xlsx").write_bytes(b"no workbook")
    (tmp_path / "d.txt").write_text("x")
    rows = wb.read_workbooks(spark, str(tmp_path))
    got = {(r.path.rsplit("/", 1)[1], r.sheet, r.row_idx): list(r.cells) for r in rows.collect()}
    assert got["a.xlsx", "Roll", 1] == [] and got["a.xlsx", "Roll", 2] == ["Unit", "Market Rent", None, "Move-In"]
    assert got["a.xlsx", "Roll", 3] == ["101", "1250.5", None, "2024-05-01 00:00:00"] and got["a.xlsx", "Roll", 4] == ["102 & up", None, "TRUE", None]
    assert got["a.xlsx", "Other", 0] == ["0.5", "2024-05-01 06:00:00", "7", "12:00:00"] and ("b.xlsx", "Roll", 3) in got and len(got) == 11
    assert {r.sheet for r in wb.read_workbooks(spark, str(tmp_path), 1).collect()} == {"Other"} and wb.read_workbooks(spark, str(tmp_path), "Roll").count() == 10
    with pytest.raises(Exception, match="no workbook"):
        wb.read_workbooks(spark, str(tmp_path), strict=True).count()


def test_positional_and_rules(spark, tmp_path):
    write(tmp_path / "a.xlsx", {"Roll": ROLL})
    rows = wb.read_workbooks(spark, str(tmp_path), 0)
    got = wb.positional(rows, ["sheet"], {"unit": 0, "rent": 1}, 3).orderBy("row_idx").collect()
    assert [(r.unit, r.rent) for r in got] == [("101", "1250.5"), ("102 & up", None)]
    rules = {
        "file_settings": {"header_row": "auto", "detect_header_keywords": ["unit"], "skip_rows_after_header": 0}, "column_mappings": {"unit_id": ["Unit"], "market_rent": ["Market Rent"], "move_in_date": ["Move-In"]},
        "transformations": {"date_format": "%Y-%m-%d %H:%M:%S"},
    }
    units = {r.unit_id: r for r in roll_rules.standardise(rows, ["path", "sheet"], rules).collect()}
    assert units["101"].market_rent == 1250.5 and units["101"].move_in_date == "2024-05-01" and units["102 & up"].market_rent is None
    rules["file_settings"] = {"header_row": 2, "skip_rows_after_header": 1}
    assert [r.unit_id for r in roll_rules.standardise(rows, ["path", "sheet"], rules).collect()] == ["102 & up"]
