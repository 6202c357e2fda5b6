"""Validated ingest on inline edge fixtures (FIXTURES.md §4, quirks K5, K7, K8)."""

from shiftline.operators import cleaning
from shiftline.schemas import DIM_DATE, DIM_MACHINE, DIM_PLANT, DIM_PRODUCT
from shiftline.sources.literals import dim_shift


def _dims(spark):
    import datetime as dt
    plant = spark.createDataFrame([("P01", "North", "c", "s", "t")], DIM_PLANT)
    machine = spark.createDataFrame([("M1", "P01", "Press #1", "Press", dt.date(2020, 1, 1), 10.0, 2.0)],
                                    DIM_MACHINE)
    product = spark.createDataFrame([("PR1", "Shell", "Vessels", "Units")], DIM_PRODUCT)
    date = spark.createDataFrame([("20250901", dt.date(2025, 9, 1), 2025, 3, 9, 1, "Monday", 0)], DIM_DATE)
    return {"dim_plant": plant, "dim_machine": machine, "dim_shift": dim_shift(spark),
            "dim_product": product, "dim_date": date}


def _raw(spark, rows):
    cols = ["record_id", "date_id", "plant_id", "machine_id", "shift_id", "product_id", "planned_qty",
            "produced_qty", "defective_qty", "downtime_minutes", "energy_consumed_kwh", "failure_event",
            "machine_wear_index"]
    base = dict(record_id=1, date_id="20250901", plant_id="P01", machine_id="M1", shift_id="S1",
                product_id="PR1", planned_qty=100.0, produced_qty=90.0, defective_qty=2.0,
                downtime_minutes=10.0, energy_consumed_kwh=5.0, failure_event=0, machine_wear_index=0.1)
    data = []
    for i, r in enumerate(rows):
        d = dict(base, record_id=i + 1)
        d.update(r)
        data.append(tuple(d[c] for c in cols))
    schema = ("record_id long, date_id string, plant_id string, machine_id string, shift_id string, "
              "product_id string, planned_qty double, produced_qty double, defective_qty double, "
              "downtime_minutes double, energy_consumed_kwh double, failure_event int, "
              "machine_wear_index double")
    return spark.createDataFrame(data, schema)


def test_clean_dim_keeps_first_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [(3, "P01", "second"), (1, "P01", "first"), (2, None, "nullkey"), (4, "P02", "only")],
        "seq int, plant_id string, plant_name string")
    out = cleaning.clean_dim(df, "plant_id", order_cols=["seq"])
    assert out.columns == ["plant_id", "plant_name"]
    assert sorted(map(tuple, out.collect())) == [("P01", "first"), ("P02", "only")]
    counts = {r.status: r.n_rows for r in cleaning.dim_reject_counts(df, "plant_id", "t").collect()}
    assert counts == {"kept": 2, "null_key": 1, "duplicate_key": 1}


def test_reject_reasons_in_check_order(spark):
    nan = float("nan")
    raw = _raw(spark, [
        {},                                                   # kept
        {"plant_id": "P99"},                                  # orphan plant
        {"machine_id": None},                                 # null FK = orphan
        {"shift_id": "S4"},
        {"product_id": "nope", "produced_qty": -1.0},         # first failing check wins
        {"date_id": "20250902"},
        {"produced_qty": -0.5},
        {"produced_qty": nan},                                # K5: NaN is rejected
        {"defective_qty": -1.0},
        {"downtime_minutes": 480.1},
        {"downtime_minutes": 480.0},                          # inclusive bound: kept
        {"downtime_minutes": 0.0},                            # kept
        {"downtime_minutes": None},
        {"energy_consumed_kwh": nan},
    ])
    flagged = cleaning.flag_production(raw, _dims(spark))
    got = {r.record_id: r.reject_reason for r in flagged.collect()}
    assert got == {1: None, 2: "orphan_plant", 3: "orphan_machine", 4: "orphan_shift",
                   5: "orphan_product", 6: "orphan_date", 7: "negative_produced",
                   8: "negative_produced", 9: "negative_defective", 10: "downtime_out_of_range",
                   11: None, 12: None, 13: "downtime_out_of_range", 14: "negative_energy"}
    report = {r.status: r.n_rows for r in cleaning.fact_reject_counts(flagged, "f").collect()}
    assert sum(report.values()) == raw.count()          # kept + rejected = input
    assert report["kept"] == 3


def test_defective_clamp_rounds_half_even_after_min(spark):
    raw = _raw(spark, [
        {"produced_qty": 0.0, "defective_qty": 3.0},      # -> 0
        {"produced_qty": 10.5, "defective_qty": 12.0},    # min 10.5 -> half-even 10
        {"produced_qty": 10.6, "defective_qty": 12.0},    # min 10.6 -> 11 (> produced, K7)
        {"produced_qty": 11.5, "defective_qty": 12.0},    # -> 12
        {"produced_qty": 50.0, "defective_qty": 4.0},     # unchanged
    ])
    out = cleaning.clean_production(raw, _dims(spark))
    got = {r.record_id: r.defective_qty for r in out.collect()}
    assert got == {1: 0, 2: 10, 3: 11, 4: 12, 5: 4}
    assert dict(out.dtypes)["defective_qty"] == "int"


def test_constraint_report_flags_duplicates_and_orphans(spark):
    dims = _dims(spark)
    raw = _raw(spark, [{}, {}, {}])
    fact = cleaning.clean_production(raw, dims).union(cleaning.clean_production(raw, dims).limit(1))
    tables = dict(dims, fact_production=fact)
    rep = {(r.table_name, r.check_name): r.n_violations for r in cleaning.constraint_report(tables).collect()}
    assert rep[("fact_production", "pk_duplicate")] == 1
    assert rep[("fact_production", "fk_orphan:machine_id")] == 0
    assert rep[("dim_machine", "fk_orphan:plant_id")] == 0
    orphan_machine = dims["dim_machine"].withColumn("plant_id", dims["dim_machine"].plant_id.substr(1, 1))
    rep2 = {(r.table_name, r.check_name): r.n_violations
            for r in cleaning.constraint_report(dict(dims, dim_machine=orphan_machine)).collect()}
    assert rep2[("dim_machine", "fk_orphan:plant_id")] == 1       # K4: never checked by the loader


def test_table_counts(spark):
    dims = _dims(spark)
    got = {r.table_name: r.n_rows for r in cleaning.table_counts(dims).collect()}
    assert got == {"dim_plant": 1, "dim_machine": 1, "dim_shift": 3, "dim_product": 1, "dim_date": 1}
