import io
import struct
import zipfile

import pytest

from inkmill.sources import files, packages, workbooks
from inkmill.sources.writers import binary_book, record, zipped


def values(cells):
    return {(s, r, c): v for _, s, r, c, v in cells}


def test_zipped_sheets_strings_and_places():
    data = zipped({"sheet2": '<row><c r="A1"><v>2</v></c></row>', "sheet10": '<row><c r="B1" t="s"><v>0</v></c><c r="B1" t="b"><v>1</v></c></row><row r="9"><c t="inlineStr"><is><t>in</t></is></c></row>'}, [f"n{k}" for k in range(1, 11)], ["<si><r><t>a</t></r><r><t>b</t></r></si>"])
    cells = list(workbooks.read_zipped(data))
    assert [s for _, s, *_ in cells] == ["n10", "n10", "n10", "n2"]  # part names sort as text, names follow the number
    assert values(cells)["n10", 0, 1] == "1"  # of a column given twice the last holds
    assert values(cells)["n10", 1, 0] == "in"  # rows count as they stand; without a reference it is the first column
    assert list(workbooks.read_zipped(zipped({"sheet1": "<row><c><v>1</v></c></row>" * 3}, ["x"]), cap=2))[-1][4] == workbooks.CUT_NOTE


def test_binary_numbers_strings_and_broken_records():
    cells = record(0x0203, struct.pack("<HHHd", 0, 0, 0, 2.5)) + record(0x027E, struct.pack("<HHHI", 0, 1, 0, (1234 << 2) | 3)) + record(0x00FD, struct.pack("<HHHI", 1, 0, 0, 1)) + record(0x00FD, struct.pack("<HHHI", 1, 1, 0, 99))
    cells += record(0x0006, struct.pack("<HHH", 2, 0, 0) + b"\x00\0\0\0\0\0\xff\xff" + b"\0" * 6) + record(0x0207, struct.pack("<HB", 2, 0) + b"ok") + record(0x0205, struct.pack("<HHHBB", 2, 1, 0, 1, 0))
    cells += record(0x00BD, struct.pack("<HH", 3, 0) + struct.pack("<HI", 0, (7 << 2) | 2) + struct.pack("<HI", 0, ((-5 & 0x3FFFFFFF) << 2) | 2) + struct.pack("<H", 1))
    strings = [struct.pack("<HB", 3, 0) + b"abc", struct.pack("<HB", 4, 0) + b"wxyz"]
    got, warning = workbooks.read_any(binary_book(cells, strings))
    v = values(got)
    assert v["S", 0, 0] == "2.5" and v["S", 0, 1] == "12.34" and v["S", 1, 0] == "wxyz" and v["S", 2, 0] == "ok" and v["S", 2, 1] == "1"
    assert (v["S", 3, 0], v["S", 3, 1]) == ("7", "-5") and ("S", 1, 1) not in v and warning == ""


def test_a_string_goes_on_in_a_continuation_with_its_own_flag():
    strings = [struct.pack("<HB", 6, 0) + b"abcdef"]
    cells = record(0x00FD, struct.pack("<HHHI", 0, 0, 0, 0))
    got, warning = workbooks.read_any(binary_book(cells, strings, sst_cut=8 + 3 + 2))
    assert values(got) == {("S", 0, 0): "abcdef"} and warning == ""
    with pytest.raises(workbooks.Unreadable):
        workbooks.read_any(binary_book(cells, strings, extra=record(0x002F, b"\0\0")))


def test_missing_shared_strings_are_told():
    data = binary_book(b"", [struct.pack("<HB", 3, 0) + b"abc"]).replace(struct.pack("<II", 1, 1) + struct.pack("<HB", 3, 0), struct.pack("<II", 9, 9) + struct.pack("<HB", 3, 0))
    assert workbooks.read_any(data)[1] == "1 of 9 shared strings"


def test_pages_with_spans_nested_tables_and_code_pages():
    page = "<table><tr><td colspan=2>가&nbsp; b</td><td>c</td></tr></table><table><tr><td>outer<table><tr><td>inner</td></tr></table>lost</td></tr></table>"
    v = values(workbooks.read_any(page.encode("cp949"))[0])
    assert v == {("table1", 0, 0): "가 b", ("table1", 0, 2): "c", ("table2", 0, 0): "inner"}
    assert workbooks.column_of("BC12") == 54 and workbooks.column_of("12") == 0 and workbooks.number_text(0.1 + 0.2) == "0.3"


def package(sections):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("mimetype", "application/hwp+zip", compress_type=zipfile.ZIP_STORED)
        for name, xml in sections.items():
            z.writestr(name, f'<sec xmlns:hp="http://x">{xml}</sec>', compress_type=zipfile.ZIP_DEFLATED)
    return out.getvalue()


def test_packages_read_and_written_back():
    p = "<hp:p><hp:run><hp:t>{}</hp:t></hp:run></hp:p>"
    table = '<hp:p><hp:t>lost</hp:t><hp:tbl><hp:tr><hp:tc><hp:cellSpan colSpan="2" rowSpan="1"/><hp:subList><hp:p><hp:t>a &lt; b</hp:t></hp:p></hp:subList></hp:tc></hp:tr></hp:tbl></hp:p>'
    data = package({"Contents/section10.xml": p.format("ten"), "Contents/section2.xml": p.format("two") + table})
    assert packages.package_text(data) == 'ten\n\ntwo\n\n<table><tr><td colspan="2">a &lt; b</td></tr></table>'
    new = packages.rewritten(data, {"Contents/section2.xml": b"<x/>"})
    before, after = list(packages.parts(data)), list(packages.parts(new))
    assert [x[:3] for x in before] == [x[:3] for x in after] and after[2][3] == b"<x/>"


def test_scans_give_one_row_for_a_broken_file(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(zipped({"sheet1": '<row><c r="A1"><v>5</v></c></row>'}, ["x"]))
    (tmp_path / "b.xlsx").write_bytes(b"PK\x03\x04broken")
    rows = {r["path"].rsplit("/", 1)[1]: r for r in files.cells(files.binary(spark, str(tmp_path), "*.xlsx")).collect()}
    assert rows["a.xlsx"]["value"] == "5" and rows["a.xlsx"]["error"] is None and rows["b.xlsx"]["error"]
    spark.dataSource.register(files.WorkbookSource)
    again = spark.read.format("workbooks").option("path", str(tmp_path)).load()
    assert again.where("value = '5'").count() == 1 and again.where("error IS NOT NULL").count() == 1


def test_packages_in_a_scan_and_the_refined_text(spark, tmp_path):
    from pyspark.sql import functions as F

    (tmp_path / "a.hwpx").write_bytes(package({"Contents/section0.xml": "<hp:p><hp:t>hi</hp:t></hp:p>"}))
    (tmp_path / "b.hwpx").write_bytes(b"no")
    t = files.package_texts(files.binary(spark, str(tmp_path), "*.hwpx"))
    got = {r["path"][-6:]: (r["text"], r["error"] is None) for r in t.collect()}
    assert got == {"a.hwpx": ("hi", True), "b.hwpx": (None, False)}
    assert files.package_parts(files.binary(spark, str(tmp_path), "*.hwpx")).count() == 2
    text = files.refined(t.where("text IS NOT NULL").withColumn("title", F.lit("T")), "title", {"via": F.lit("x"), "confidence": F.lit(None)}, "text").first()[0]
    assert text == "---\nvia: x\n---\n\n# T\n\nhi"
