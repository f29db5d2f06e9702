"""Files to gold, day by day and as one range; and files picked up as they arrive."""

import os

import pytest

from paylake import schemas as S
from paylake.plans import gold
from paylake.plans.lakehouse import Lakehouse
from paylake.session import fresh_path
from paylake.sources.daily_files import DailyFiles
from paylake.sources.tables import read_table
from paylake.streaming.arrivals import ingest_available

DAYS = ["2025-10-01", "2025-10-02", "2025-10-03"]


def write(folder, entity, day, text):
    path = f"{folder}/{entity}/{entity}-{day.replace('-', '')}.csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write(text)


@pytest.fixture
def folder(tmp_path):
    """Three days: a payment that settles later, a merchant that is renamed, a day without merchants."""
    for n, day in enumerate(DAYS):
        links = "id,created_at,updated_at,state,linkpay_reference,payment_details\n"
        links += "".join(
            f'{n}{i},{day} 10:00:0{i},,open,,"{{""payment_reference"": ""P{n}{i}""}}"\n' for i in range(5)
        )
        write(tmp_path, "link_transactions", day, links)
        pays = "id,merchant_id,acquirer_id,state,card_type,reference,order_reference,details,created_at,updated_at\n"
        pays += "".join(f"{n}{i}1,7,1,initial,1,P{n}{i},O,,{day} 10:01:00,\n" for i in range(4))
        if n:
            pays += f"{n - 1}01,7,1,settled,1,P{n - 1}0,O,,{DAYS[n - 1]} 10:01:00,{day} 11:00:00\n"
        write(tmp_path, "payments", day, pays)
        if n < 2:
            write(tmp_path, "merchants", day,
                  f"id,acquirer_id,name,state,created_at,updated_at\n7,1,shop{n},active,2025-09-01,{day}\n")
    return str(tmp_path)


def fact(lake):
    return sorted(map(str, lake.fact().select(S.FACT_COLUMNS).collect()))


def test_daily_runs_equal_one_range(spark, folder):
    daily = Lakehouse(spark, fresh_path(spark, "daily"), buckets=4)
    for day in DAYS:
        daily.run(folder, day, day)
    whole = Lakehouse(spark, fresh_path(spark, "whole"), buckets=4)
    whole.run(folder, DAYS[0], DAYS[-1])
    assert fact(daily) == fact(whole)
    assert len(fact(daily)) == 15
    settled = daily.fact().where("payment_state = 1").count()
    assert settled == 2
    for name in ("payments", "link_transactions", "merchants"):
        assert sorted(map(str, daily.silver(name).collect())) == sorted(map(str, whole.silver(name).collect()))
    assert daily.merchants().first().merchant_name == "shop1"

    # A day is delivered again without all but one of its transactions.
    write(folder, "link_transactions", DAYS[1],
          "id,created_at,updated_at,state,linkpay_reference,payment_details\n"
          f'10,{DAYS[1]} 10:00:00,,open,,"{{""payment_reference"": ""P10""}}"\n')
    for _ in range(2):
        daily.run(folder, DAYS[1], DAYS[1])
        kept = gold.fact_transactions(daily.silver("link_transactions"), daily.silver("payments"), daily.merchants())
        assert fact(daily) == sorted(map(str, kept.select(S.FACT_COLUMNS).collect())) and len(fact(daily)) == 11


def test_new_column_reaches_bronze(spark, folder):
    write(folder, "merchants", "2025-10-03",
          "id,acquirer_id,name,state,created_at,updated_at,country\n8,1,new,active,,,EE\n")
    lake = Lakehouse(spark, fresh_path(spark, "lake"), buckets=4)
    lake.load_bronze(folder, DAYS[0], DAYS[-1])
    rows = {r.id: r.country for r in lake.bronze("merchants").collect()}
    assert rows == {"7": None, "8": "EE"}


def test_arrivals(spark, folder):
    table, progress = fresh_path(spark, "bronze"), fresh_path(spark, "progress")
    files = DailyFiles(f"{folder}/payments", "payments")

    def load():
        ingest_available(spark, files, table, S.BRONZE_PAYMENTS, progress)
        return read_table(spark, table, S.BRONZE_PAYMENTS)

    assert load().count() == 14
    assert load().count() == 14
    write(folder, "payments", "2025-10-05", "id,state\n900,a\n")
    rows = load()
    assert rows.count() == 15
    assert rows.where("id = '900'").first()[S.SOURCE_FILE] == "payments-20251005.csv"
    # A file that is written again, with a correction and one more row.
    write(folder, "payments", "2025-10-05", "id,state\n900,b\n901,c\n")
    os.utime(f"{folder}/payments/payments-20251005.csv", (2e9, 2e9))
    rows = load()
    assert rows.count() == 16
    assert {r.id: r.state for r in rows.where("id >= '900'").collect()} == {"900": "b", "901": "c"}
    assert load().count() == 16
    # An earlier version of the file, of another length.
    write(folder, "payments", "2025-10-05", "id,state\n900,first\n")
    os.utime(f"{folder}/payments/payments-20251005.csv", (1e9, 1e9))
    assert {r.state for r in load().where("id >= '900'").collect()} == {"first"}
    # The log of known files has one row per file, however many runs there were.
    assert spark.read.parquet(f"{progress}-files").count() == 4


def test_rejected_rows_are_stored_and_counted(spark, folder):
    write(folder, "payments", DAYS[1],
          "id,merchant_id,acquirer_id,state,card_type,reference,order_reference,details,created_at,updated_at\n"
          "1,7,1,a,1,P,O,,,\n1,7,1,b,1,P,O,,,\nx,7,1,a,1,P,O,,,\n,7,1,a,1,P,O,,,\n")
    lake = Lakehouse(spark, fresh_path(spark, "lake"), buckets=4)
    lake.run(folder, DAYS[0], DAYS[-1])
    rows = {(r.id, r._reason) for r in lake.rejected("payments").collect()}
    assert rows == {("x", "id is not a number"), (None, "missing id")}
    counts = {str(r[S.SNAPSHOT]): tuple(r)[:4] for r in lake.load_counts("payments").collect()}
    assert counts[DAYS[1]] == (4, 2, 2, 1) and counts[DAYS[0]] == (4, 4, 0, 4)
    write(folder, "payments", DAYS[1], "id,state\n5,a\n")
    lake.run(folder, DAYS[1], DAYS[1])
    assert lake.rejected("payments").count() == 0
    assert {str(r[S.SNAPSHOT]): r.rejected_rows for r in lake.load_counts("payments").collect()}[DAYS[1]] == 0


def test_merchants_without_a_needed_column(spark, folder):
    """Silver stays empty but typed until the column is delivered."""
    for day in DAYS[:2]:
        write(folder, "merchants", day, f"id,acquirer_id,state,created_at,updated_at\n7,1,active,2025-09-01,{day}\n")
    lake = Lakehouse(spark, fresh_path(spark, "lake"), buckets=4)
    lake.run(folder, DAYS[0], DAYS[1])
    assert lake.silver("merchants").count() == 0 and lake.merchants().count() == 0
    assert lake.silver("merchants").columns == S.SILVER_MERCHANTS.fieldNames()
    assert lake.fact().count() == 10
    write(folder, "merchants", DAYS[2], "id,acquirer_id,name,state,created_at,updated_at\n7,1,shop,active,2025-09-01,\n")
    lake.run(folder, DAYS[2], DAYS[2])
    assert [r.merchant_name for r in lake.merchants().collect()] == ["shop"]
    assert lake.fact().where("merchant_sk IS NOT NULL").count() == lake.fact().where("hasPayment = 1").count()


def test_run_options(spark, folder):
    lake = Lakehouse(spark, fresh_path(spark, "lake"), buckets=4)
    assert str(lake.run_day(folder, "2025-10-04", lag_days=3)) == DAYS[0]
    assert str(lake.run_day(folder, "2025-10-04", override="20251002", full_load=True)) == DAYS[1]
    days = {(r.transaction_id, str(r[S.SNAPSHOT])) for r in lake.silver("link_transactions").collect()}
    assert len(days) == 15 and len({t for t, _ in days}) == 10
    assert lake.fact().count() == 10


def test_bronze_rows_are_not_copied_for_silver(spark, folder, tmp_path):
    from paylake.session import shared_folder

    scratch = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    lake = Lakehouse(spark, str(tmp_path / "lake"), buckets=4)
    lake.run(folder, DAYS[0], DAYS[-1])
    stored = {name.rsplit("-", 1)[0] for name in set(os.listdir(scratch)) - before}
    assert "silver-payments" in stored and not stored & {"payments", "link_transactions", "merchants"}
    counts = lake.load_counts("payments").agg({"bronze_rows": "sum", "accepted_rows": "sum"}).first()
    assert counts[0] == counts[1] > 0


def test_incoming_files_are_packed(spark, sf_dir):
    from paylake import fixtures as X
    from paylake.queries import _daily_files

    files = _daily_files(X.bronze_merchants(spark, sf_dir), "merchants", S.MERCHANT_COLUMNS)
    names = [n for day in os.listdir(files.folder) if "merchants" in day for n in os.listdir(f"{files.folder}/{day}")]
    assert names and all(n.endswith((".csv.gz", ".crc")) for n in names)
