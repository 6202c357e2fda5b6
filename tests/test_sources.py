"""CSV ingest (pandas-style missing markers, file order), warehouse, calendar."""

import datetime as dt
import os

from shiftline.operators import calendar
from shiftline.operators.star import build_star
from shiftline.sources import files, warehouse


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_star_load_end_to_end(spark, tmp_dir):
    d = os.path.join(tmp_dir, "csv")
    _write(f"{d}/dim_plant.csv/part-0.csv", "plant_id,plant_name,city,state,plant_type\n"
           "P01,North,Northport,NO,Heavy\nP01,Dup,X,Y,Z\nNA,Nobody,,,\nP02,South,Southford,SO,Light\n")
    _write(f"{d}/dim_machine.csv/part-0.csv",
           "machine_id,plant_id,machine_name,machine_type,install_date,rated_capacity_units_per_hour,"
           "base_energy_kwh_per_hour\nM001,P01,Press #1,Press,2020-01-05,50.5,4.2\n"
           "M002,P02,Press #2,Press,2019-03-01,n/a,3.9\n")
    _write(f"{d}/dim_shift.csv/part-0.csv", "shift_id,shift_name,start_time,end_time\n"
           "S1,Morning,06:00,14:00\nS2,Afternoon,14:00,22:00\nS3,Night,22:00,06:00\n")
    _write(f"{d}/dim_product.csv/part-0.csv", "uom,category,product_name,product_id\nUnits,Vessels,Shell,PR01\n")
    _write(f"{d}/dim_date.csv/part-0.csv", "date,date_id,year,quarter,month,day,day_of_week,is_weekend\n"
           "2025-09-01,20250901,2025,3,9,1,Monday,False\n2025-09-06,20250906,2025,3,9,6,Saturday,True\n")
    _write(f"{d}/fact_production.csv/part-0.csv",
           "record_id,date_id,plant_id,machine_id,shift_id,product_id,planned_qty,produced_qty,defective_qty,"
           "downtime_minutes,energy_consumed_kwh,failure_event,machine_wear_index\n"
           "1,20250901,P01,M001,S1,PR01,100.0,90.5,2,10.0,50.25,False,0.1\n"
           "2,20250901,P01,M001,S2,PR01,100.0,10.6,12,480.0,50.0,True,0.2\n"
           "3,20250906,P02,M002,S3,PR01,100.0,NaN,1,5.0,1.0,False,0.3\n"
           "4,20250906,P02,M002,S1,PR01,100.0,20.0,1,480.1,1.0,False,0.3\n"
           "5,20250907,P02,M002,S1,PR01,100.0,20.0,1,5.0,1.0,False,0.3\n")
    _write(f"{d}/fact_maintenance.csv/part-0.csv",
           "maintenance_id,machine_id,date_id,maintenance_type,duration_minutes,cost_inr,technician_team\n"
           "MT1,M001,20250901,Corrective,120,5000,Team A\nMT2,M999,20250901,Preventive,60,100,Team B\n")
    raw = files.read_csv_star(spark, d)
    star = build_star(raw, dim_order={n: [files.ORDER_COL] for n in
                                      ["dim_plant", "dim_machine", "dim_shift", "dim_product", "dim_date"]})
    plants = {r.plant_id: r.plant_name for r in star.dim_plant.collect()}
    assert plants == {"P01": "North", "P02": "South"}           # first in file order; NA key dropped
    m = {r.machine_id: r for r in star.dim_machine.collect()}
    assert m["M001"].install_date == dt.date(2020, 1, 5) and m["M002"].rated_capacity_units_per_hour is None
    assert {r.date_id: r.is_weekend for r in star.dim_date.collect()} == {"20250901": 0, "20250906": 1}
    prod = {r.record_id: r for r in star.fact_production.collect()}
    assert set(prod) == {1, 2}                                    # NaN, >480 and orphan date rejected
    assert prod[2].defective_qty == 11 and prod[2].failure_event == 1
    assert [r.maintenance_id for r in star.fact_maintenance.collect()] == ["MT1"]
    assert [tuple(r) for r in star.dim_product.collect()] == [("PR01", "Shell", "Vessels", "Units")]

    out = os.path.join(tmp_dir, "wh")
    counts = {r.table_name: r.n_rows for r in warehouse.full_refresh(star, out, fact_files=2).collect()}
    assert counts["fact_production"] == 2 and counts["dim_shift"] == 3
    files.write_csv_table(star.fact_production, os.path.join(tmp_dir, "out_csv"))
    back = files.read_csv_table(spark, os.path.join(tmp_dir, "out_csv"), "fact_production", keep_order=False)
    assert back.count() == 2


def test_calendar_builder_210_days(spark):
    cal = calendar.calendar_from_days("2025-09-01", 210, spark)
    rows = cal.collect()
    assert len(rows) == 210 and sum(r.is_weekend for r in rows) == 60
    first = rows[0]
    assert (first.date_id, first.day_of_week, first.quarter) == ("20250901", "Monday", 3)


def test_missing_slots_small(spark):
    prod = spark.createDataFrame([("M1", "20250101", "S1"), ("M1", "20250103", "S2")],
                                 "machine_id string, date_id string, shift_id string")
    shifts = spark.createDataFrame([("S1",), ("S2",)], "shift_id string")
    assert calendar.expected_slots(prod, shifts).count() == 6        # 3 days x 2 shifts
    got = sorted(map(tuple, calendar.missing_slots(prod, shifts).collect()))
    assert got == [("M1", "20250101", "S2"), ("M1", "20250102", "S1"), ("M1", "20250102", "S2"),
                   ("M1", "20250103", "S1")]


def test_clean_dim_keeps_first_across_files(spark, tmp_dir):
    from shiftline.operators import cleaning
    d = os.path.join(tmp_dir, "plants")
    _write(f"{d}/part-0.csv", "plant_id,plant_name,city,state,plant_type\nP01,first,a,b,c\nP02,two,a,b,c\n")
    _write(f"{d}/part-1.csv", "plant_id,plant_name,city,state,plant_type\nP01,second,a,b,c\nP03,three,a,b,c\n"
                              "P03,three-dup,a,b,c\n")
    df = files.read_csv_table(spark, d, "dim_plant")
    out = cleaning.clean_dim(df, "plant_id", order_cols=[files.ORDER_COL])
    assert out.columns == ["plant_id", "plant_name", "city", "state", "plant_type"]
    assert {r.plant_id: r.plant_name for r in out.collect()} == {"P01": "first", "P02": "two", "P03": "three"}


def test_fixture_tables_follow_the_warehouse_schemas(spark):
    """Raw tables carry the warehouse column order (CSV files are positional)."""
    from conftest import SF_SMALL
    from shiftline.schemas import TABLES
    from shiftline.sources.fixtures import load_raw
    raw = load_raw(spark, SF_SMALL)
    assert raw.raw_production.columns == TABLES["fact_production"].fieldNames()
    assert raw.raw_maintenance.columns == TABLES["fact_maintenance"].fieldNames()
    for name in ["dim_plant", "dim_machine", "dim_shift", "dim_product", "dim_date"]:
        assert getattr(raw, name).columns == TABLES[name].fieldNames(), name


def test_files_with_other_column_orders_are_refused(spark, tmp_dir):
    import pytest
    d = os.path.join(tmp_dir, "swapped")
    _write(f"{d}/part-0.csv", "plant_id,plant_name,city,state,plant_type\nP01,Alpha,a,b,c\n")
    _write(f"{d}/part-1.csv", "plant_name,plant_id,city,state,plant_type\nBeta,P02,a,b,c\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv_table(spark, d, "dim_plant").collect()


def test_integer_texts(spark, tmp_dir):
    d = os.path.join(tmp_dir, "ints")
    head = "date,date_id,year,quarter,month,day,day_of_week,is_weekend\n"
    _write(f"{d}/part-0.csv", head + "2025-09-01,20250901,2025.0,3,9.5,1e0,Monday,0\n2025-09-02,20250902,x,,NaN,2,Tuesday,true\n")
    rows = files.read_csv_table(spark, d, "dim_date", keep_order=False).orderBy("date_id").collect()
    assert [(r.year, r.quarter, r.month, r.day, r.is_weekend) for r in rows] == \
        [(2025, 3, None, 1, 0), (None, None, None, 2, 1)]


def test_missing_slot_runs(spark):
    prod = spark.createDataFrame([("M1", "20250101", "S1"), ("M1", "20250103", "S2"), ("M2", "20250102", "S1")],
                                 "machine_id string, date_id string, shift_id string")
    machines = spark.createDataFrame([("M1",), ("M2",), ("M3",)], "machine_id string")
    shifts = spark.createDataFrame([("S1",), ("S2",)], "shift_id string")
    got = sorted(map(tuple, calendar.missing_slot_runs(prod, machines, shifts).collect()))
    assert got == [("M1", "20250101 S2", "20250103 S1", 4), ("M2", "20250101 S1", "20250101 S2", 2),
                   ("M2", "20250102 S2", "20250103 S2", 3), ("M3", "20250101 S1", "20250103 S2", 6)]
