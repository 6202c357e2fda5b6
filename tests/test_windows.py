"""History features and wear cycles against plain walks over sorted rows."""

import random
from functools import reduce
from operator import add

import pandas as pd

from shiftline.operators import windows


def _history(spark, seed=7, machines=4, days=40):
    rnd = random.Random(seed)
    rows = []
    rid = 0
    for m in range(machines):
        for d in range(days):
            if rnd.random() < 0.35:          # sparse days: halos must span several days
                continue
            for s in ("S1", "S2", "S3"):
                if rnd.random() < 0.4:
                    continue
                rid += 1
                down = None if rnd.random() < 0.05 else round(rnd.uniform(0, 300), 1)
                rows.append((rid, f"M{m}", f"202501{d + 1:02d}" if d < 31 else f"202502{d - 30:02d}", s,
                             down, round(rnd.uniform(0, 1), 4), int(rnd.random() < 0.1)))
    # one machine with a single row: W2 = 0, W3 = own wear
    rows.append((rid + 1, "MX", "20250105", "S2", 33.0, 0.77, 0))
    schema = ("record_id long, machine_id string, date_id string, shift_id string, downtime_minutes double, "
              "machine_wear_index double, failure_event int")
    return spark.createDataFrame(rows, schema), pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _missing(v):
    return v is None or v != v


def _expected(rows):
    """record_id -> (mean of the three values before, wear before), by a walk over the sorted rows."""
    out, before, machine = {}, [], None
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[3], r[0])):
        if r[1] != machine:
            before, machine = [], r[1]
        known = [d for d, _ in before[-3:] if not _missing(d)]
        wear = before[-1][1] if before and not _missing(before[-1][1]) else r[5]
        out[r[0]] = (reduce(add, known) / len(known) if known else 0.0, wear)
        before.append((r[4], r[5]))
    return out


def _check(sdf, rows):
    got = {r.record_id: (r.prior_downtime_avg3, r.prior_wear) for r in windows.prior_features(sdf).collect()}
    assert got == _expected(rows)


def test_prior_features_match_a_walk(spark):
    sdf, pdf = _history(spark)
    rows = [tuple(None if v != v else v for v in r) for r in pdf.itertuples(index=False)]
    _check(sdf, rows)
    assert _expected(rows)[pdf.record_id.max()] == (0.0, 0.77)


def test_prior_features_keep_small_values_and_skip_nan(spark):
    nan = float("nan")
    rows = [(1, "M", "20250101", "S1", 30.0, 0.5, 0), (2, "M", "20250101", "S2", None, 0.123456789, 0),
            (3, "M", "20250102", "S1", 0.00004, nan, 0), (4, "M", "20250103", "S1", nan, 0.25, 0),
            (5, "M", "20250103", "S2", 7.0, 0.75, 0), (6, "M", "20250104", "S1", 1.0, 0.1, 0)]
    schema = ("record_id long, machine_id string, date_id string, shift_id string, downtime_minutes double, "
              "machine_wear_index double, failure_event int")
    _check(spark.createDataFrame(rows, schema), rows)
    assert _expected(rows)[4][0] == (30.0 + 0.00004) / 2


def test_wear_cycles_match_brute_force(spark):
    sdf, pdf = _history(spark, seed=11)
    maint = pd.DataFrame([("M0", "20250110", "Preventive"), ("M0", "20250110", "Preventive"),
                          ("M1", "20250103", "Corrective"), ("M1", "20250120", "Preventive"),
                          ("M2", "20250201", "Preventive"), ("M9", "20250101", "Preventive")],
                         columns=["machine_id", "date_id", "maintenance_type"])
    got = windows.wear_cycles(sdf, spark.createDataFrame(maint)).toPandas().set_index("record_id")
    prev = {(m, d) for m, d, t in maint.itertuples(index=False) if t == "Preventive"}
    for m, grp in pdf.sort_values(["machine_id", "date_id", "shift_id"]).groupby("machine_id"):
        cycle, pos, fails_before = 0, 0, 0
        prev_days = sorted(d for mm, d in prev if mm == m)
        last_cycle = None
        for r in grp.itertuples():
            cycle = fails_before + sum(1 for d in prev_days if d < r.date_id)
            pos = pos + 1 if cycle == last_cycle else 1
            last_cycle = cycle
            assert got.loc[r.record_id, "cycle_id"] == cycle, (m, r)
            assert got.loc[r.record_id, "shifts_in_cycle"] == pos, (m, r)
            fails_before += r.failure_event


def test_defect_rate_row_zero_produced(spark):
    df = spark.createDataFrame([(1, 0.0, 3), (2, 10.0, 1), (3, None, 1)],
                               "record_id long, produced_qty double, defective_qty int")
    got = {r.record_id: r.defect_rate for r in windows.defect_rate_row(df).collect()}
    assert got == {1: 0.0, 2: 0.1, 3: 0.0}


def test_hot_machine_history_matches_a_walk(spark):
    """One machine holds ~40 % of all rows: results stay exact (the work is
    split per (machine, day), not per machine)."""
    rnd = random.Random(19)
    rows, rid = [], 0
    for d in range(120):
        day = f"2025{1 + d // 28:02d}{1 + d % 28:02d}"
        for s in ("S1", "S2", "S3"):
            rid += 1
            rows.append((rid, "HOT", day, s, round(rnd.uniform(0, 400), 1), round(rnd.random(), 4), 0))
        if d % 3 == 0:
            for m in "ABCDEFGHIJKL":
                rid += 1
                rows.append((rid, m, day, rnd.choice(["S1", "S2", "S3"]), round(rnd.uniform(0, 400), 1),
                             round(rnd.random(), 4), 0))
    cols = ["record_id", "machine_id", "date_id", "shift_id", "downtime_minutes", "machine_wear_index",
            "failure_event"]
    pdf = pd.DataFrame(rows, columns=cols).drop_duplicates(["machine_id", "date_id", "shift_id"])
    sdf = spark.createDataFrame(pdf)
    assert (pdf.machine_id == "HOT").mean() > 0.35
    _check(sdf, list(pdf.itertuples(index=False, name=None)))
