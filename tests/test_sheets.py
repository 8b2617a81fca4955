"""Worksheets of workbooks written by hand."""

import zipfile

import pytest

from annoforge.sources import sheets as W
from annoforge.sources.readers import SourceError

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def workbook(path, sheets, shared=(), early=False):
    """sheets: name to XML of its rows."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook {MAIN}><workbookPr{" date1904=" + chr(34) + "1" + chr(34) if early else ""}/><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="t" Target="{"/xl/" if i == 2 else ""}worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="&quot;days&quot; 0.0"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f'<sst {MAIN}>' + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        for i, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet {MAIN}><dimension ref="A1"/><sheetData>{rows}</sheetData></worksheet>')


SHARED = ["<t>id</t>", '<t xml:space="preserve"> note </t>', "<r><t>rich </t></r><r><t>text</t></r>", "<t>x &amp; y</t>", "<t>when</t>", "<t></t>"]
ROWS = """<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>4</v></c><c r="AB1" t="inlineStr"><is><t>far</t></is></c></row>
<row r="2"><c r="A2"><v>7</v></c><c r="B2" t="s"><v>2</v></c><c r="C2" s="1"><v>45000</v></c><c r="AB2" t="b"><v>1</v></c></row>
<row r="4"><c r="A4"><v>1.5</v></c><c r="B4"><f>SUM(A1:A2)</f><v>3</v></c><c r="C4" s="2"><v>45000.75</v></c><c r="AB4" t="e"><v>#N/A</v></c></row>
<row r="5"><c r="A5" s="3"><v>2</v></c><c r="B5" t="s"><v>3</v></c></row>
<row r="6"><c r="A6"/><c r="B6" t="str"><f t="shared" si="0">A1&amp;"!"</f><v>id!</v></c></row>
<row r="7"><c r="A7" s="1"/></row>"""


def test_cells_of_every_kind(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {"Other": '<row r="1"><c r="A1"><v>1</v></c></row>', "Review": ROWS}, SHARED)
    rows = {r["row"]: tuple(r)[2:] for r in W.records(spark, str(tmp_path), "Review").collect()}
    assert W.records(spark, str(tmp_path), "Review").columns == ["archive", "row", "id", "note", "when", "far"]
    assert rows == {
        2: ("7", "rich text", "2023-03-15 00:00:00", "True"), 4: ("1.5", "=SUM(A1:A2)", "2023-03-15 18:00:00", "#N/A"),
        5: ("2", "x & y", "", ""), 6: ("", '=A1&"!"', "", ""),
    }


def test_several_workbooks_and_faults(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {"S": '<row><c t="inlineStr"><is><t>id</t></is></c><c t="inlineStr"><is><t>b</t></is></c></row><row><c><v>1</v></c></row>'})
    workbook(tmp_path / "b.xlsx", {"S": '<row r="3"><c r="B3" t="inlineStr"><is><t>id</t></is></c><c r="A3" t="inlineStr"><is><t>b</t></is></c></row><row r="9"><c r="B9" s="1"><v>0</v></c><c r="A9"><v>2</v></c></row>'}, early=True)
    got = {(r["archive"].rsplit("/", 1)[1], r["row"]): (r["id"], r["b"]) for r in W.records(spark, str(tmp_path), "S", ["id", "b"]).collect()}
    assert got == {("a.xlsx", 2): ("1", ""), ("b.xlsx", 9): ("1904-01-01 00:00:00", "2")}
    with pytest.raises(SourceError, match="missing columns: c"):
        W.records(spark, str(tmp_path), "S", ["id", "c"])
    with pytest.raises(SourceError, match="no sheet T"):
        W.cells(spark, str(tmp_path), "T")
