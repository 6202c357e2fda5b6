"""Month folders, run-time pruning, Bloom key filters, shuffles of M1 and W5, life of written folders."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shiftline import session
from shiftline.operators import cleaning, keysets, windows
from shiftline.operators.star import MONTH
from shiftline.plans import bi, dashboard as db, registry, risk, sql_api
from shiftline.sources import warehouse
from shiftline.sources.fixtures import load_raw


@pytest.fixture(scope="module")
def star(spark):
    return registry.fixture_star(spark, SF_SMALL)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_filter_on_the_calendar_prunes_month_folders(spark, star):
    year = (F.col("year") == 1996) & (F.col("month") == 2)
    df = db.filtered_production(star, calendar=year)
    scan = next(x for x in _plan(df).splitlines() if "PartitionFilters" in x and MONTH in x)
    assert "dynamicpruning" in scan
    rows = sorted(df.collect())
    assert rows == sorted(star.fact_production.where(F.col("date_id").startswith("199602")).collect()) and rows
    assert df.columns == star.fact_production.columns
    bare = type(star)(**{n: getattr(star, n) for n in star.tables()})
    assert sorted(db.filtered_production(bare, calendar=year).collect()) == rows


def test_a_date_range_prunes_month_folders_when_planned(star):
    df = db.filtered_production(star, start="1996-01-15", end="1996-03-02")
    scan = next(x for x in _plan(df).splitlines() if "PartitionFilters" in x and MONTH in x)
    assert f"({MONTH}" in scan and "199601" in scan and "199603" in scan
    days = [r[0] for r in df.agg(F.min("date_id"), F.max("date_id")).collect()][0]
    assert days >= "19960115"


def test_bloom_filter_keeps_every_key_and_drops_most_others(spark):
    keys = spark.range(0, 50_000, 5).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    values = spark.range(50_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("v")).union(
        spark.createDataFrame([(None,)], "v string"))
    passed = {r.v for r in values.where(keysets.may_hold(keys, "k", F.col("v"), 1 << 17)).collect()}
    known = {f"k{i}" for i in range(0, 50_000, 5)}
    assert known <= passed and None not in passed and len(passed - known) < 2_000
    # a small filter lets more through, an empty set nothing
    assert known <= {r.v for r in values.where(keysets.may_hold(keys, "k", F.col("v"), 1 << 12)).collect()}
    assert values.where(keysets.may_hold(keys.where("false"), "k", F.col("v"), 1 << 12)).count() == 0
    assert keysets.LEAST <= keysets.bits_for(keys) <= keysets.MOST



def test_unknown_keys_are_left_out_before_the_shuffle(spark, no_broadcast):
    raw = load_raw(spark, SF_SMALL)
    dims = {n: getattr(raw, n) for n in ("dim_plant", "dim_machine", "dim_shift", "dim_product", "dim_date")}
    fks = cleaning._fks("fact_production", dims)
    left = cleaning.without_unknown_keys(raw.raw_production, fks)
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "xxhash64" in plan
    assert left.count() < raw.raw_production.count()
    clean = cleaning.clean_production(raw.raw_production, dims, raw.slot_order)
    whole = cleaning.flag_production(raw.raw_production, dims, raw.slot_order).where(F.col(cleaning.REASON).isNull())
    assert clean.count() == whole.count()
    assert sorted(r.record_id for r in clean.select("record_id").collect()) == sorted(
        r.record_id for r in whole.select("record_id").collect())


def test_small_key_sets_take_no_filter(spark):
    raw = load_raw(spark, SF_SMALL)
    dims = {n: getattr(raw, n) for n in ("dim_plant", "dim_machine", "dim_shift", "dim_product", "dim_date")}
    df = cleaning.without_unknown_keys(raw.raw_production, [("plant_id", spark.range(3).selectExpr("string(id) plant_id"), "plant_id")])
    assert df.columns == raw.raw_production.columns and "scalar-subquery" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert cleaning.clean_production(raw.raw_production, dims, raw.slot_order).count() > 0


def test_features_shuffle_the_fact_only_for_its_windows(spark, star, no_broadcast):
    """With broadcast off, machine and date attributes come through the day-level table."""
    plan = _plan(risk.failure_features(star))
    wide = [x for x in plan.splitlines() if "Exchange" in x and "planned_qty" in x]
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    by = [x for x in dealt if x.count("#") == 2 and "machine_id" in x and "date_id" in x]
    assert not wide and by
    # above an exchange by (machine, day) the fact's columns meet no other exchange
    lines = plan.splitlines()
    fact = next(k for k, x in enumerate(lines) if "Scan parquet" in x and "planned_qty" in x)
    indent = lambda x: len(x) - len(x.lstrip(" :+-"))
    above, level = [], indent(lines[fact])
    for x in reversed(lines[:fact]):
        if indent(x) < level:
            level = indent(x)
            above.append(x)
    exchanges = [x for x in above if "Exchange " in x]
    assert len(exchanges) == 1 and "machine_id" in exchanges[0] and "date_id" in exchanges[0], exchanges
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    usual = sorted(risk.failure_features(star).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert sorted(risk.failure_features(star).collect()) == usual


def test_wear_cycles_join_back_once(star):
    plan = windows.wear_cycles(star.fact_production, star.fact_maintenance)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "FullOuter" not in plan


def test_split_reads_the_stored_fact_below_the_windows(star):
    plan = risk.split_features(star)._jdf.queryExecution().optimizedPlan().toString()
    # the history windows are planned once: one over the rows, one over the day table
    assert plan.count("Window [collect_list") == 2
    with_keys = sorted(risk.split_features(star).select(*risk.KEYS, "is_test").collect())
    assert with_keys == sorted(risk.split(risk.failure_features(star)).select(*risk.KEYS, "is_test").collect())


def test_same_period_over_leap_days(spark, star):
    days = [("19950228", 1.0), ("19960227", 2.0), ("19960228", 3.0), ("19960229", 5.0), ("19970228", 7.0), ("19970301", 9.0)]
    fact = spark.createDataFrame([(d, "P01", u) for d, u in days], "date_id string, plant_id string, produced_qty double")
    plants = spark.createDataFrame([("P01", "ASIA")], "plant_id string, plant_name string")
    small = type(star)(plants, star.dim_machine, star.dim_shift, star.dim_product, star.dim_date, fact, star.fact_maintenance)
    by_day = {r.period: r.units_same_period_last_year for r in bi.same_period_by(fact, small, "day").collect()}
    assert by_day == {"1995-02-28": None, "1996-02-27": None, "1996-02-28": 1.0, "1996-02-29": 1.0, "1997-02-28": 3.0,
                      "1997-03-01": None}
    by_month = {r.period: r.units_same_period_last_year for r in bi.same_period_by(fact, small, "month").collect()}
    # February 1996 has two days that go to 28 February 1995, which counts once
    assert by_month["1996-02"] == 1.0 and by_month["1997-02"] == 5.0 and by_month["1997-03"] is None


def test_quotes_in_a_marker_are_harmless(spark, star):
    text = sql_api.FILTERED_SQL["filtered_kpis"]
    run = lambda *a, **k: sql_api.run_sql(spark, star, text, sql_api.filter_args(*a, **k)).first()
    assert run(["AS'IA", "x') OR 1=1 --"]).units_produced is None
    assert run([]).units_produced is None                                      # an empty choice selects nothing
    assert run() == run(None, None, "1990-01-01", None)                        # a range needs both ends
    assert tuple(run()) == tuple(db.kpi_summary(db.filtered_production(star)).first())
    assert tuple(run(["ASIA"], ["TYPE_1"], "1995-01-01", "1996-12-31")) == tuple(db.kpi_summary(
        db.filtered_production(star, ["ASIA"], ["TYPE_1"], "1995-01-01", "1996-12-31")).first())


def test_other_categories_stay_in_the_pivot(star):
    cut = bi.plant_category_matrix(db.filtered_production(star), wide=True, categories=["PROMO", "SMALL"], star=star)
    whole = bi.plant_category_matrix(db.filtered_production(star), wide=True, star=star)
    assert cut.columns == ["plant_name", "PROMO", "SMALL", "other"]
    total = lambda df: {r.plant_name: sum(v or 0 for v in r[1:]) for r in df.collect()}
    assert total(cut) == pytest.approx(total(whole))


def test_snapshots_are_pruned_on_request_only(spark, tmp_dir):
    raw = load_raw(spark, SF_SMALL)
    for _ in range(2):
        warehouse.refresh(raw, tmp_dir, fact_files=2)
    folders = lambda: sorted(x for x in os.listdir(tmp_dir) if x.startswith("snapshot-"))
    assert len(folders()) == 2
    gone = warehouse.prune(spark, tmp_dir)
    assert len(gone) == 1 and folders() and gone[0] not in folders()
    assert warehouse.open_star(spark, tmp_dir).fact_production.count() > 0
    assert warehouse.prune(spark, tmp_dir) == gone and len(folders()) == 1


def test_scratch_folders_have_an_end(spark):
    one, two = (session.scratch_path(spark, f"life/{n}") for n in ("one", "two"))
    before = set(session._SCRATCH[spark.sparkContext.applicationId])
    for path in (one, two):
        spark.range(3).write.parquet(path)
    session.remove_folder(spark, one)
    assert not os.path.exists(one) and os.path.exists(two)
    session._SCRATCH[spark.sparkContext.applicationId] = {two}
    session.clear_scratch(spark)
    assert not os.path.exists(two) and not session._SCRATCH[spark.sparkContext.applicationId]
    session._SCRATCH[spark.sparkContext.applicationId] = before - {one, two}


def test_runs_of_missing_slots_expand_on_demand(spark, star):
    from shiftline.operators import calendar
    from shiftline.plans import history
    runs = history.missing_slot_runs(star).where("machine_id = 'M000001'")
    got = {tuple(r) for r in calendar.slots_of_runs(runs, star.dim_shift, "19950110", "19950215").collect()}
    used = {(r.date_id, r.shift_id) for r in star.fact_production.where("machine_id = 'M000001'").collect()}
    days = [r[0].strftime("%Y%m%d") for r in spark.sql(
        "SELECT explode(sequence(DATE'1995-01-10', DATE'1995-02-15'))").collect()]
    assert got == {("M000001", d, s) for d in days for s in ("S1", "S2", "S3") if (d, s) not in used} and got


def test_small_key_sets_and_bad_values_are_decided_before_the_shuffles(spark, star):
    """Rows of unknown machines and shifts are not shuffled for their slots; the loaded rows are those without a reason."""
    raw, dims = load_raw(spark, SF_SMALL), star.dims()
    clean = cleaning.clean_production(raw.raw_production, dims, raw.slot_order)
    plan = clean._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(i for i, line in enumerate(plan) if "Window [" in line)
    assert sum("Join LeftSemi" in line for line in plan[window:]) == 3          # machine, shift, date
    assert not any("LeftOuter" in line for line in plan)
    columns = ["record_id", "machine_id", "date_id", "shift_id", "product_id"]
    whole = cleaning.flag_production(raw.raw_production, dims, raw.slot_order).where(F.col(cleaning.REASON).isNull())
    assert sorted(clean.select(columns).collect()) == sorted(whole.select(columns).collect()) and clean.count() > 0
    orders = cleaning.clean_maintenance(raw.raw_maintenance, dims).select("maintenance_id").collect()
    kept = cleaning.flag_maintenance(raw.raw_maintenance, dims).where(F.col(cleaning.REASON).isNull())
    assert sorted(orders) == sorted(kept.select("maintenance_id").collect()) and orders
