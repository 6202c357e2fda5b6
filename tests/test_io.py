"""Model persistence (S7), the streaming ingest and the fail-fast constraint check."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shiftline.operators import cleaning
from shiftline.plans import dashboard as db
from shiftline.plans import risk
from shiftline.plans.registry import fixture_star
from shiftline.sources import warehouse


def test_model_save_and_load(spark, tmp_dir):
    st = fixture_star(spark, SF_SMALL)
    fitted = risk.fit_failure_model(st, max_iter=3, max_bins=32)
    warehouse.save_model(fitted, tmp_dir)
    model, cols = warehouse.load_model(spark, tmp_dir)
    assert cols == fitted.features and cols[:6] == risk.NUMERIC
    a = fitted.model.transform(fitted.test).select("prediction").collect()
    b = model.transform(fitted.test).select("prediction").collect()
    assert a == b
    imp = risk.permutation_importance(fitted, repeats=2).collect()
    assert [r.feature for r in imp] == fitted.features          # one row per feature, in order
    assert all(r.importance_std >= 0 and abs(r.importance_mean) <= 1 for r in imp)
    # a column that is constant in the test rows cannot change predictions when shuffled
    const = [f for f in fitted.features
             if fitted.test.select(f"`{f}`").distinct().count() == 1]
    for r in imp:
        if r.feature in const:
            assert r.importance_mean == 0.0
    f1 = risk.permutation_importance(fitted, repeats=1, metric="f1").collect()
    assert len(f1) == len(fitted.features)
    with pytest.raises(ValueError):
        risk.permutation_importance(fitted, metric="nope")


def test_streaming_ingest_matches_batch_rules(spark, tmp_dir):
    from shiftline.streaming.ingest import start_validated_ingest
    st = fixture_star(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "landing")
    from shiftline.sources.fixtures import SLOT_ORDER, raw_production
    rp = raw_production(spark, SF_SMALL)
    late = cleaning.later_in_slot(rp, cleaning.PRODUCTION_GRAIN, SLOT_ORDER)
    rp = rp.withColumn("late", late).where("not late").drop("late")
    rp.withColumn("failure_event", F.when(F.col("failure_event") == 1, "True").otherwise("False")) \
      .coalesce(2).write.option("header", True).csv(src)
    q = start_validated_ingest(spark, src, st.dims(), os.path.join(tmp_dir, "sink"),
                               os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(300)
    clean = spark.read.parquet(os.path.join(tmp_dir, "sink", "clean"))
    assert clean.count() == st.fact_production.count()
    rej = spark.read.parquet(os.path.join(tmp_dir, "sink", "rejects"))
    assert rej.agg(F.sum("n_rows")).first()[0] == rp.count()
    got = clean.drop("batch_id").select(sorted(st.fact_production.columns)).exceptAll(
        st.fact_production.select(sorted(st.fact_production.columns)))
    assert got.isEmpty()


def test_load_refuses_repeated_keys_and_publishes_nothing(spark, tmp_dir):
    from shiftline.sources import warehouse
    from shiftline.sources.fixtures import load_raw
    raw = load_raw(spark, SF_SMALL)
    good = os.path.join(tmp_dir, "wh")
    star = warehouse.refresh(raw, good)
    assert cleaning.constraint_report(star.tables()).where("n_violations > 0").isEmpty()
    n = star.fact_production.count()
    assert warehouse.open_star(spark, good).fact_production.count() == n
    # One record id on two slots: the load stops and the published snapshot stays.
    twice = raw.raw_production.withColumn("record_id", F.lit(1).cast("bigint"))
    bad = dataclasses.replace(raw, raw_production=twice)
    with pytest.raises(cleaning.ConstraintViolation, match="fact_production.pk_duplicate"):
        warehouse.refresh(bad, good)
    assert warehouse.open_star(spark, good).fact_production.count() == n
    assert warehouse.open_star(spark, os.path.join(tmp_dir, "none")) is None


def test_input_version_follows_the_files(spark, tmp_dir):
    from shiftline.sources import warehouse
    path = os.path.join(tmp_dir, "t.parquet")
    spark.range(10).write.parquet(path)
    before = warehouse.input_version(spark, [path])
    assert before == warehouse.input_version(spark, [path])
    spark.range(5).write.mode("append").parquet(path)
    assert before != warehouse.input_version(spark, [path])


def test_maintenance_filters_plant_only_vs_synced(spark):
    st = fixture_star(spark, SF_SMALL)
    m = st.maintenance_wide().join(st.dim_machine.select("machine_id", "machine_type"), "machine_id")
    first = m.orderBy("maintenance_id").first()
    plant, mtype = first.plant_name, first.machine_type
    all_types = db.filtered_maintenance(st, plants=[plant]).count()
    synced = db.filtered_maintenance(st, plants=[plant], machine_types=[mtype],
                                     start="1996-01-01", end="1998-12-31")
    want = m.where((F.col("plant_name") == plant) & (F.col("machine_type") == mtype)
                   & F.col("date_id").between("19960101", "19981231")).count()
    assert 0 < synced.count() == want < all_types
    assert synced.where((F.col("date_id") < "19960101") | (F.col("date_id") > "19981231")).isEmpty()


def test_streaming_maintenance_ingest(spark, tmp_dir):
    from shiftline.sources.fixtures import raw_maintenance
    from shiftline.streaming.ingest import start_validated_ingest
    st = fixture_star(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "landing_m")
    raw_maintenance(spark, SF_SMALL).repartition(3).write.option("header", True).csv(src)
    q = start_validated_ingest(spark, src, st.dims(), os.path.join(tmp_dir, "sink_m"),
                               os.path.join(tmp_dir, "ckpt_m"),
                               table="fact_maintenance", max_files_per_trigger=1)
    q.awaitTermination(300)
    clean = spark.read.parquet(os.path.join(tmp_dir, "sink_m", "clean")).drop("batch_id")
    assert clean.exceptAll(st.fact_maintenance).isEmpty() and st.fact_maintenance.exceptAll(clean).isEmpty()
    batches = spark.read.parquet(os.path.join(tmp_dir, "sink_m", "rejects")).select("batch_id").distinct().count()
    assert batches >= 3                                   # one file per trigger


def test_one_hot_width_and_split_ratio(spark):
    """Invariants: 19 model columns (6 numeric + 7 + 2 + 4 indicators, first
    level of each category dropped) and per-class test share = ceil(20 %)."""
    import math
    st = fixture_star(spark, "/root/testdata/sf0.01")
    feats, names = risk.one_hot_features(risk.failure_features(st))
    assert len(names) == 19 and names[:6] == risk.NUMERIC
    assert [n for n in names if n.startswith("shift_id_")] == ["shift_id_S2", "shift_id_S3"]
    assert not any(n.endswith("TYPE_0") or n.endswith("P01") or n.endswith("S1") for n in names)
    counts = {(r.failure_event, r.is_test): r["count"]
              for r in risk.split(feats).groupBy("failure_event", "is_test").count().collect()}
    for y in (0, 1):
        n = counts[(y, 0)] + counts[(y, 1)]
        assert counts[(y, 1)] == math.ceil(n * 20 / 100)


def test_reject_report_accounts_for_every_raw_row(spark):
    import __spark_entry__ as E
    from shiftline.plans.registry import _loaded
    raw, st = _loaded(spark, SF_SMALL)
    rep = E.queries()["reject_report"](spark, SF_SMALL).collect()
    per = {}
    for r in rep:
        per.setdefault(r.table_name, {})[r.status] = r.n_rows
    assert sum(per["fact_production"].values()) == raw.raw_production.count()
    assert sum(per["fact_maintenance"].values()) == raw.raw_maintenance.count()
    assert per["fact_production"]["kept"] == st.fact_production.count()
    assert per["fact_maintenance"]["kept"] == st.fact_maintenance.count()


def _repeating_tables(spark, folder):
    """The sf0.001 tables with ten lines whose order, line and price come again at another supplier, and ten orders again."""
    for t in ("region", "nation", "supplier", "part"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    lines, orders = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("lineitem", "orders"))
    valid = lines.where("l_linenumber = 1 and l_quantity > 10 and l_extendedprice < 50000").orderBy(
        "l_orderkey", "l_extendedprice").limit(10)
    again = valid.withColumn("l_suppkey", (F.col("l_suppkey") + 1) % 10)
    lines.unionByName(again).write.parquet(f"{folder}/lineitem.parquet")
    twice = orders.where("o_orderdate > '1996-01-01'").orderBy("o_orderkey").limit(10)
    orders.unionByName(twice.withColumn("o_totalprice", F.col("o_totalprice") + 1)).write.parquet(f"{folder}/orders.parquet")


def test_queries_keep_and_report_rows_whose_ids_repeat(spark, tmp_dir):
    """Two lines of one order, number and price have one record id: the SQL keeps both, and so do the queries."""
    import duckdb

    import __spark_entry__ as E
    from test_oracle import _key
    _repeating_tables(spark, tmp_dir)
    con = duckdb.connect()
    for t in ("region", "nation", "supplier", "part", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_dir}/{t}.parquet/*.parquet')")
    with pytest.warns(UserWarning, match="fact_production.pk_duplicate=.*fact_maintenance.pk_duplicate="):
        fixture_star(spark, tmp_dir)
    for name in ("clean_production", "clean_maintenance", "constraint_report", "calendar_dim", "failure_features",
                 "reject_report", "defect_rate_row", "cost_by_maintenance_type"):
        df = E.queries()[name](spark, tmp_dir)
        want = con.execute(E.oracle_sql()[name])
        columns = [d[0] for d in want.description]
        assert sorted(df.columns) == sorted(columns)
        assert _key(df.columns, [tuple(r) for r in df.collect()]) == _key(columns, want.fetchall()), name


def test_load_refuses_every_other_breach(spark):
    from shiftline.plans.registry import REPORTED
    breach = lambda *rows: spark.createDataFrame(rows, "table_name string, check_name string, n_violations long")
    with pytest.warns(UserWarning, match="fact_production.pk_duplicate=1"):
        cleaning.assert_constraints(breach(("fact_production", "pk_duplicate", 1)), REPORTED)
    for other in (("dim_plant", "pk_duplicate"), ("fact_production", "pk_null"), ("fact_production", "fk_orphan:plant_id")):
        with pytest.raises(cleaning.ConstraintViolation, match=f"{other[0]}.{other[1]}=2"):
            cleaning.assert_constraints(breach(("fact_production", "pk_duplicate", 1), (*other, 2)), REPORTED)


def test_orders_beyond_64_bits_get_record_ids(spark, tmp_dir):
    from shiftline.sources.fixtures import raw_production
    for t in ("supplier", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_dir}/{t}.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    far = lines.withColumn("l_orderkey", F.col("l_orderkey") + 60_000_000_000)
    none = lines.limit(1).withColumn("l_linenumber", F.lit(None).cast("int"))
    lines.unionByName(far).unionByName(none).write.parquet(f"{tmp_dir}/lineitem.parquet")
    ids = raw_production(spark, tmp_dir).select("record_id")
    known = raw_production(spark, SF_SMALL).select("record_id")
    assert ids.where("record_id >= 0").exceptAll(known).isEmpty() and known.exceptAll(ids).isEmpty()
    assert ids.where("record_id is null").count() == 1
    assert ids.where("record_id < 0").distinct().count() == known.distinct().count()
