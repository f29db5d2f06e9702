import datetime as dt
import os

import pytest

from paylake import schemas as S
from paylake.plans import bronze
from paylake.sources.daily_files import DailyFiles, day_range, days_present, read_days, snapshot_day

FIRST, LAST = "2025-10-01", "2025-10-31"


@pytest.fixture
def folder(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def read(spark, path, prefix="payments", contract=None, first=FIRST, last=LAST):
    return read_days(spark, DailyFiles(path, prefix), first, last, contract)


def test_text_columns(spark, folder):
    path = folder(
        "payments-20251002.csv",
        'id,name,note\n1,NA,\n2,"",NaN\n3,"say ""hi""","a,b"\n4, x ,"two\nlines"\n5,é,"{""k"": ""v""}"\n',
    )
    rows = {r.id: r for r in read(spark, path).collect()}
    assert rows["1"].name == "NA" and rows["1"].note is None
    assert rows["2"].name is None and rows["2"].note == "NaN"
    assert rows["3"].name == 'say "hi"' and rows["3"].note == "a,b"
    assert rows["4"].name == " x " and rows["4"].note == "two\nlines"
    assert rows["5"].name == "é" and rows["5"].note == '{"k": "v"}'
    assert rows["1"][S.SOURCE_FILE] == "payments-20251002.csv"
    assert rows["1"][S.SNAPSHOT] == dt.date(2025, 10, 2)
    assert rows["1"][S.INGESTED] is not None


def test_no_file_and_empty_files(spark, folder):
    path = folder("payments-20251002.csv", "")
    assert read(spark, path, contract=S.BRONZE_PAYMENTS).count() == 0
    path = folder("payments-20251003.csv", "id,state\n")
    frame = read(spark, path, contract=S.BRONZE_PAYMENTS)
    assert frame.count() == 0 and frame.columns == S.BRONZE_PAYMENTS.fieldNames()
    assert read(spark, path, prefix="merchants").count() == 0
    assert read(spark, path + "/absent").count() == 0


def test_headers_may_differ_between_days(spark, folder):
    folder("payments-20251001.csv", "id,state\n1,a\n")
    folder("payments-20251002.csv", "state,extra,id\nb,e,2\n")
    path = folder("payments-20251103.csv", "id\n9\n")
    frame = read(spark, path, contract=S.BRONZE_PAYMENTS)
    rows = {r.id: (r.state, r.extra, r.card_type) for r in frame.collect()}
    assert rows == {"1": ("a", None, None), "2": ("b", "e", None)}


def test_a_day_may_be_a_folder_of_parts(spark, folder):
    folder("payments-20251001.csv/part-0.csv", "id,state\n1,a\n")
    path = folder("payments-20251001.csv/part-1.csv", "id,state\n2,b\n")
    rows = read(spark, path).collect()
    assert {(r.id, r[S.SOURCE_FILE], r[S.SNAPSHOT]) for r in rows} == {
        (i, "payments-20251001.csv", dt.date(2025, 10, 1)) for i in ("1", "2")
    }


def test_quoted_line_breaks_across_splits(spark, folder, setting):
    """Records, quotes and line breaks that fall on any side of a split."""
    lines, expected = ["id,note,tail"], []
    for i in range(400):
        note = [f"plain {i}", f"a\nb{i}", f'"q"\n\n{i}', "x" * (i % 37) + "\n" * (i % 5) + "y", ""][i % 5]
        quoted = '"' + note.replace('"', '""') + '"'
        lines.append(f"{i},{quoted},t{i}")
        expected.append((str(i), note or None, f"t{i}"))
    path = folder("payments-20251001.csv", "\n".join(lines) + "\n")
    size = os.path.getsize(f"{path}/payments-20251001.csv")
    for split in (97, 512, size * 2):
        setting("spark.sql.files.maxPartitionBytes", str(split))
        setting("spark.sql.files.openCostInBytes", "0")
        rows = read(spark, path).collect()
        got = sorted(((r.id, r.note, r.tail) for r in rows), key=lambda r: int(r[0]))
        assert got == expected, split


def test_quoted_line_breaks_in_a_day_of_parts(spark, folder):
    """Only one of the part files has a line break, and another day has none."""
    folder("payments-20251001.csv/part-0.csv", 'id,note\n1,"a\nb"\n2,c\n')
    folder("payments-20251001.csv/part-1.csv", "id,note\n3,d\n")
    path = folder("payments-20251002.csv/part-0.csv", "id,note\n4,e\n")
    assert {(r.id, r.note) for r in read(spark, path).collect()} == {
        ("1", "a\nb"), ("2", "c"), ("3", "d"), ("4", "e"),
    }


def test_unbalanced_quote_stays_in_its_file(spark, folder):
    folder("payments-20251001.csv/part-0.csv", 'id,note\n1,a\n2,"b\n3,c\n')
    path = folder("payments-20251001.csv/part-1.csv", "id,note\n4,d\n")
    rows = {r.id: r.note for r in read(spark, path).collect()}
    assert rows["1"] == "a" and rows["4"] == "d"


def test_run_day(spark, folder):
    assert snapshot_day("2025-10-30") == dt.date(2025, 10, 30)
    assert snapshot_day("2025-10-30", lag_days=29) == dt.date(2025, 10, 1)
    assert snapshot_day("2025-10-30", 29, "20251015") == dt.date(2025, 10, 15)
    path = folder("payments-20251002.csv", "id\n1\n")
    days = day_range("2025-10-01", "2025-10-03")
    assert days_present(spark, DailyFiles(path, "payments"), days) == [dt.date(2025, 10, 2)]


def test_landed_documents(spark, folder):
    path = folder(
        "link_transactions-20251001.csv",
        "id,created_at,state,payment_details,other\n"
        '1,2025-10-01T12:00:00.5+02:00,a,"{""r"": ""é""}",x\n2,bad,b,oops,x\n3,,c, ,x\n',
    )
    frame = bronze.land_link_transactions(spark, DailyFiles(path, "link_transactions"), FIRST, LAST)
    assert frame.columns == S.BRONZE_LINK_TX.fieldNames()
    rows = {r.id: (r.created_at, r.payment_details, r.linkpay_reference) for r in frame.collect()}
    assert rows == {
        "1": ("2025-10-01T10:00:00", '{"r":"é"}', None), "2": (None, None, None), "3": (None, None, None),
    }


def test_blank_in_path_and_windows_line_ends(spark, folder):
    text = 'id,note\r\n1,"a\r\nb"\r\n2,plain\r\n3,"x\ny"\r\n'
    path = folder("my files/payments-20251002.csv", "") + "/my files"
    with open(f"{path}/payments-20251002.csv", "w", encoding="utf-8", newline="") as out:
        out.write(text)
    rows = {r.id: r.note for r in read(spark, path).collect()}
    assert rows == {"1": "a\r\nb", "2": "plain", "3": "x\ny"}


def test_lineage_by_the_end_of_the_path(spark, folder):
    """The day's name is the folder's or the file's, whatever stands before it; no path is searched."""
    folder("payments-20250909.csv/in=1/payments-20251001.csv", "id\n1\n")
    path = folder("payments-20250909.csv/in=1/payments-20251002.csv/payments-7.csv", "id\n2\n") + "/payments-20250909.csv/in=1"
    folder("payments-20250909.csv/in=1/file=payments-20251003.csv/part-0.csv", "id\n3\n")
    frame = read(spark, path)
    assert "regexp_extract" not in frame._jdf.queryExecution().optimizedPlan().toString()
    rows = frame.unionByName(read(spark, path, prefix="file=payments")).collect()
    assert {(r.id, r[S.SOURCE_FILE], r[S.SNAPSHOT].day) for r in rows} == {
        (str(day), f"payments-2025100{day}.csv", day) for day in (1, 2, 3)
    }
