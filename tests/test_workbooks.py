"""Feeds from workbooks built here, against the same drops as CSV."""

import datetime as dt
import re
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.enrich import store_directory
from ledgerloom.plans import monthly
from ledgerloom.sources import workbooks as wb
from tests.conftest import rows


def _ref(i):
    name = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        name = chr(65 + r) + name
    return name


def make(path, table, other=(("not", "this"),), refs=True, old=False):
    """A workbook with ``table`` as its first sheet; text as shared strings, dates by style."""
    texts: list[str] = []

    def sheet(data):
        out = []
        for r, row in enumerate(data, 1):
            if row is None:
                continue
            cells = []
            for i, v in enumerate(row):
                at = f' r="{_ref(i)}{r}"' if refs else ""
                if v is None:
                    if not refs:
                        cells.append("<c/>")
                elif isinstance(v, bool):
                    cells.append(f'<c{at} t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, (int, float)):
                    cells.append(f'<c{at}><v>{v!r}</v></c>')
                elif isinstance(v, dt.datetime):
                    base = dt.datetime(1904, 1, 1) if old else dt.datetime(1899, 12, 30)
                    cells.append(f'<c{at} s="{2 if v.time() != dt.time() else 1}"><v>{(v - base) / dt.timedelta(days=1)!r}</v></c>')
                elif v.startswith("#"):
                    cells.append(f'<c{at} t="e"><v>{v}</v></c>')
                elif v.startswith("inline:"):
                    cells.append(f'<c{at} t="inlineStr"><is><t>{escape(v[7:])}</t></is></c>')
                else:
                    if v not in texts:
                        texts.append(v)
                    cells.append(f'<c{at} t="s"><v>{texts.index(v)}</v></c>')
            out.append(f'<row r="{r}">' + "".join(cells) + "</row>")
        ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        return f'<?xml version="1.0"?><worksheet xmlns="{ns}"><sheetData>{"".join(out)}</sheetData></worksheet>'

    first, second = sheet(table), sheet(other)
    strings = "".join(f'<si><r><t xml:space="preserve">{escape(t[:2])}</t></r><r><t xml:space="preserve">{escape(t[2:])}</t></r>'
                      "<rPh><t>reading</t></rPh></si>" for t in texts)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns:r="rel"><workbookPr date1904="%d"/><sheets><sheet name="b" r:id="x2"/>'
                   '<sheet name="a" r:id="x1"/></sheets></workbook>' % old)
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="x1" Target="worksheets/sheet1.xml"/>'
                   '<Relationship Id="x2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst>{strings}</sst>")
        z.writestr("xl/styles.xml", '<styleSheet><numFmts><numFmt numFmtId="170" formatCode="dd\\.mm\\.yyyy\\ hh:mm"/>'
                   '<numFmt numFmtId="171" formatCode="0.00&quot; days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/>'
                   '<xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet2.xml", first)
        z.writestr("xl/worksheets/sheet1.xml", second)
    return path


@pytest.mark.parametrize("refs,old", [(True, False), (False, True)])
def test_cells_as_text(tmpdir_path, refs, old):
    table = [("Head", "Two", "3"), ("text & <more>", 1.0, 2.5), (dt.datetime(2026, 5, 31), dt.datetime(2026, 5, 31, 10, 15), True),
             None, (None, None, None), (1e20, "#N/A", "inline:in é"), ("a", None, -0.125, "beyond")]
    path = make(f"{tmpdir_path}/b.xlsx", table, refs=refs, old=old)
    with open(path, "rb") as f:
        got = list(wb.sheet_rows(f.read()))
    assert [n for n, _ in got] == [1, 2, 3, 6, 7]
    cells = [c for _, c in got]
    assert cells[0] == ["Head", "Two", "3"] and cells[1] == ["text & <more>", "1", "2.5"]
    assert cells[2] == ["2026-05-31", "2026-05-31 10:15:00", "TRUE"]
    assert cells[3] == ["1e+20", None, "in é"] and cells[4] == ["a", None, "-0.125", "beyond"]
    with pytest.raises(Exception):
        list(wb.sheet_rows(b"no archive"))


def _csv(path, table):
    with open(path, "w", encoding="utf-8") as f:
        for row in table:
            f.write(",".join("" if v is None else f'"{v}"' if "," in str(v) else str(v) for v in row) + "\n")


def _both(tmpdir_path, name, table):
    """The same drop as a workbook and as CSV, in folders of their own."""
    import os
    for kind in ("x", "c"):
        os.makedirs(f"{tmpdir_path}/{kind}", exist_ok=True)
    make(f"{tmpdir_path}/x/{name}.xlsx", table)
    plain = [[v.strftime("%Y-%m-%d") if isinstance(v, dt.datetime) else v for v in row] for row in table]
    _csv(f"{tmpdir_path}/c/{name}.csv", plain)


def _findings(run):
    return sorted((r.check, r.subject, r.n) for r in run.dq.collect())


def test_tariff_from_workbooks(spark, tmpdir_path):
    _both(tmpdir_path, "tariff_2604", [("'МВЗ (Код)", "Место возникновения затрат", "kwt", "uah"),
                                       ("M1", "a", 100, 500), ("M1", "a", 50, 100.5), ("-", "c", 5, 5), ("M3", "f", None, None)])
    # another layout: the columns in another order, headers spelled differently
    _both(tmpdir_path, "tariff_2605", [("UAH", "k w t", "мвз (код)"), (7, 2, "M1")])
    x = monthly.tariff_drop(spark, f"{tmpdir_path}/x/tariff_*.xlsx", fmt="xlsx")
    c = monthly.tariff_drop(spark, f"{tmpdir_path}/c/tariff_*.csv")
    assert rows(x.result) == rows(c.result) and len(rows(x.result)) == 3
    assert _findings(x) == _findings(c) and x.periods == c.periods == [(2026, 4), (2026, 5)]
    found = {r.check: r.n for r in monthly.load(x, f"{tmpdir_path}/t").collect() if r.check in ("rows", "invalid_key")}
    assert found == {"rows": 5, "invalid_key": 1}


def test_meter_from_workbooks(spark, tmpdir_path):
    head = ("Дата", "Час", "Магазин", "Піч піца", "Пічпіца", "ПКВ допік", "ПКВ")
    _both(tmpdir_path, "meter_2605", [
        head, (dt.datetime(2026, 5, 31), 10, "002, Київ", 1, 2, 5, 4), (dt.datetime(2026, 5, 31), 10, "003, Київ (Оренда)", 0, 0, 0, 0),
        (dt.datetime(2026, 6, 1), 10, "002, Київ", 9, 9, 9, 9), (dt.datetime(2026, 5, 31), 10, "XYZ", 1, 1, 1, 1)])
    directory = store_directory(spark.createDataFrame([(21, "2"), (31, "3")], "id int, AccountantNumber string"),
                                name_col=None, mvz_col=None)
    x = monthly.meter_drop(spark, f"{tmpdir_path}/x/meter_2605.xlsx", directory, fmt="xlsx")
    c = monthly.meter_drop(spark, f"{tmpdir_path}/c/meter_2605.csv", directory)
    assert rows(x.result) == rows(c.result) == [(2026, 5, 21, 3.0, 0.0, 0.0, 5.0, 4.0)]
    assert _findings(x) == _findings(c)


def test_labour_and_accounts_from_workbooks(spark, tmpdir_path):
    _both(tmpdir_path, "labor_2605", [("filid", "mm", "h", "category", "filialname"),
                                      (1, 5, 6, "Касир", "S1"), (1, 5, 4.5, "Касир", "S1"), (2, 4, 1, "Касир", "S2"), (None, 5, 1, "Касир", "S3")])
    roles = spark.createDataFrame([("Касир", "Касир", "106", "Каса")],
                                  "`посада з годин` string, `Посада з зп` string, depid string, `Відділ` string")
    card = spark.createDataFrame([("1001", "Касир", 150.0)], "`№ магазина` string, `посада` string, rate double")
    directory = store_directory(spark.createDataFrame([(1, "A", "1001", "1001")], "id int, name string, AccountantNumber string, MVZ string"))
    sales = spark.createDataFrame([], "filid int, depid int, year int, month int, type_oper string, sumout double")
    x, c = (monthly.labor_drop(spark, f"{tmpdir_path}/{k}/labor_*", roles, card, directory, sales, "rate", fmt=fmt)
            for k, fmt in (("x", "xlsx"), ("c", "csv")))
    assert rows(x.result) == rows(c.result) == [(2026, 5, 1, 106, 10.5, 150.0, 1575.0)]
    # row checks come with the load
    found = {r.check: r.n for r in monthly.load(x, f"{tmpdir_path}/labour").collect()}
    assert (found["rows"], found["period_mismatch"], found["null_key"], found["unmatched"], found["no_rate"]) == (4, 1, 1, 0, 0)

    report = [("Стаття/МВЗ", "Назва", "uah", "percent"), ("1001", "above", "7", 0.9), ("84090200", "Bank fees", None, None),
              ("1001", "Store A", "1 200.50 UAH", 0.5), ("9999", "Unknown", "10", 0.3)]
    make(f"{tmpdir_path}/x/accounts_2604.xlsx", report)
    run = monthly.accounts_drop(spark, f"{tmpdir_path}/x/accounts_2604.xlsx", directory, fmt="xlsx")
    assert rows(run.result, "filid", "account", "name", "sum", "share_TO") == [(1, 84090200, "Bank fees", 1200.5, 0.5)]
    found = {r.check: r.n for r in monthly.load(run, f"{tmpdir_path}/accounts").collect()}
    assert (found["rows"], found["no_article"], found["unmatched"]) == (3, 1, 1)
    assert {r.check: r.n for r in run.dq.collect()}["no_article"] == 1


def test_one_scan_whatever_the_layouts(spark, tmpdir_path):
    for i in range(4):
        make(f"{tmpdir_path}/x_260{i + 1}.xlsx", [tuple(["k", "v", "V ", "w"][j] for j in ((0, 1, 2), (2, 0), (3, 0), (1, 0, 3))[i]),
                                                 tuple(range(1, 4))[:2 + (i % 3 == 0)]])
    out, layouts = wb.scan_workbooks(spark, f"{tmpdir_path}/x_*.xlsx", ["K", "v", "none"], ["v"])
    assert len(layouts) == 4 and sum(len(f) for _, f in layouts) == 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan binaryFile|Scan binaryFile|BatchScan|FileScan", plan)) == 1
    assert rows(out, "file_month", "k", "v", "none", "row_no") == [
        (1, "1", 5.0, None, 2), (2, "2", 1.0, None, 2), (3, "2", None, None, 2), (4, "2", 1.0, None, 2)]
    empty = wb.scan_workbooks(spark, make(f"{tmpdir_path}/y_2601.xlsx", []), ["k"], [])[0]
    assert empty.where(F.lit(True)).count() == 0
