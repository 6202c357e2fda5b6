"""Name → query callable ``(spark, sf_dir) -> DataFrame`` for every plan.

Each callable starts from the driver's tables: the fixture mapping gives
the raw star, which is loaded — validated, its constraints checked, repeated
ids of the facts reported, any other breach refused — into a
Parquet warehouse (``warehouse.refresh``) unless one is published for these
inputs. Queries read those files: the load cuts the lineage, so an executor
loss costs a file re-read, not a rerun of the mapping and validation. The
loaded ``Star`` is shared per (application, folder, input version).
"""

from __future__ import annotations

import datetime as _dt
import re
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.operators import evaluation
from shiftline.operators.star import Star, filter_choices
from shiftline.plans import bi, csv_ingest, dashboard as db, history, ingest, risk, saved_models, sql_api
from shiftline.plans import sample_queries as sq
from shiftline.session import scratch_path
from shiftline.sources import warehouse
from shiftline.sources.fixtures import RawStar, load_raw

_STARS: dict[tuple[str, str, str], tuple[RawStar, Star]] = {}
_LOCK = threading.RLock()

# Fixed parameters of the registered filtered views.
FILTER_PLANTS = ["ASIA", "EUROPE"]
FILTER_TYPES = ["TYPE_1", "TYPE_3", "TYPE_5"]
FILTER_START, FILTER_END = "1996-01-01", "1997-06-30"
TREND_TYPES = ["TYPE_0", "TYPE_2"]
# The product categories of the driver's part table.
PIVOT_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
AGE_AS_OF = _dt.date(2002, 1, 1)


#: Folder of the persistent warehouse. Sessions that name one load it once and
#: read it from then on; without it a session keeps its own in the shared
#: checkpoint folder.
WAREHOUSE_CONF = "spark.shiftline.warehouse.dir"
_INPUTS = ["region", "nation", "supplier", "part", "lineitem", "orders"]
#: Ids that the mapping makes of columns which are no keys of the given tables: in large ones an order's line comes
#: twice at one price, or an order twice. The SQL keeps such rows, so a load keeps and reports them.
REPORTED = [("fact_production", "pk_duplicate"), ("fact_maintenance", "pk_duplicate")]


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[RawStar, Star]:
    app, folder = spark.sparkContext.applicationId, sf_dir.rstrip("/")
    version = warehouse.input_version(spark, [f"{folder}/{t}.parquet" for t in _INPUTS])
    key = (app, folder, version)
    with _LOCK:                      # one load per (application, folder, input version), even across threads
        if key not in _STARS:
            raw = load_raw(spark, sf_dir)
            tag = re.sub(r"[^A-Za-z0-9_.-]", "_", folder.strip("/"))
            home = spark.conf.get(WAREHOUSE_CONF, None)
            base = (f"{home.rstrip('/')}/{tag}-{version}" if home
                    else scratch_path(spark, f"shiftline-warehouse/{app}-{uuid.uuid4().hex[:8]}/{tag}"))
            # A folder whose files have changed is loaded anew; what was loaded of it before is let go.
            for old in [k for k in _STARS if k[:2] == key[:2]]:
                del _STARS[old]
            _STARS[key] = (raw, (warehouse.open_star(spark, base) if home else None)
                           or warehouse.refresh(raw, base, reported=REPORTED))
        return _STARS[key]


def fixture_star(spark: SparkSession, sf_dir: str) -> Star:
    return _loaded(spark, sf_dir)[1]


_MODELS: dict[tuple[str, str], tuple[Star, "risk.FittedRisk"]] = {}
# Boosting rounds at most; ten rounds without a gain on the validation slice end the fit.
MODEL_MAX_ITER = 200


def fitted_model(spark: SparkSession, sf_dir: str) -> "risk.FittedRisk":
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    star = fixture_star(spark, sf_dir)
    with _LOCK:
        if key not in _MODELS or _MODELS[key][0] is not star:       # fitted on this version of the inputs
            _MODELS[key] = (star, risk.fit_failure_model(star, max_iter=MODEL_MAX_ITER))
        return _MODELS[key][1]


def _with_model(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fitted_model(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "model_view")
    return run


def _one_hot(st: Star) -> DataFrame:
    df, names = risk.one_hot_features(risk.failure_features(st))
    return df.select(*risk.KEYS, risk.LABEL, *names)


def _sliced(st: Star, attrs=()) -> DataFrame:
    """Production under all slicers."""
    return db.filtered_production(st, FILTER_PLANTS, FILTER_TYPES, FILTER_START, FILTER_END, attrs=attrs)


def _with_raw(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(*_loaded(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


def _on_star(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fixture_star(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _sql(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sql_api.run_sql(spark, fixture_star(spark, sf_dir), sql_api.SAMPLE_SQL[name])
    run.__name__ = f"sql_{name}"
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_energy_machines": _on_star(sq.top_energy_machines),
    "monthly_production_by_plant": _on_star(sq.monthly_production_by_plant),
    "oee_by_machine": _on_star(sq.oee_by_machine),
    "maintenance_cost_by_plant_type": _on_star(sq.maintenance_cost_by_plant_type),
    "failure_rate_by_machine_type": _on_star(sq.failure_rate_by_machine_type),
    "monthly_units_by_category": _on_star(sq.monthly_units_by_category),
    # the same six as SQL text through spark.sql (S3)
    **{f"sql_{n}": _sql(n) for n in sql_api.SAMPLE_SQL},
    # the dashboard's filters as named markers of an SQL text
    "sql_filtered_kpis": lambda spark, sf_dir: sql_api.run_sql(
        spark, fixture_star(spark, sf_dir), sql_api.FILTERED_SQL["filtered_kpis"],
        sql_api.filter_args(FILTER_PLANTS, FILTER_TYPES, FILTER_START, FILTER_END)),
    # ingest (C1–C10, S5)
    "clean_dim_plant": _on_star(lambda st: st.dim_plant),
    "clean_dim_machine": _on_star(lambda st: st.dim_machine),
    "clean_dim_shift": _on_star(lambda st: st.dim_shift),
    "clean_dim_product": _on_star(lambda st: st.dim_product),
    "clean_dim_date": _on_star(lambda st: st.dim_date),
    "clean_production": _on_star(lambda st: st.fact_production),
    "clean_maintenance": _on_star(lambda st: st.fact_maintenance),
    "reject_report": _with_raw(ingest.reject_report),
    "constraint_report": _on_star(ingest.constraint_report),
    "table_counts": _on_star(ingest.table_counts),
    # the CSV path: files written from the given tables with faults, then read and cleaned
    "csv_products": csv_ingest.products,
    "csv_production": lambda spark, sf_dir: csv_ingest.production(spark, sf_dir, fixture_star(spark, sf_dir)),
    "csv_production_rejects": lambda spark, sf_dir: csv_ingest.production_rejects(
        spark, sf_dir, fixture_star(spark, sf_dir)),
    # star joins and filters
    "wide_production": _on_star(lambda st: st.wide_production()),
    "maintenance_wide": _on_star(lambda st: st.maintenance_wide()),
    "filtered_production": _on_star(lambda st: db.filtered_production(
        st, FILTER_PLANTS, FILTER_TYPES, FILTER_START, FILTER_END,
        attrs=["plant_name", "machine_type", "date"]).select(
        "record_id", "machine_id", "date_id", "shift_id", "plant_name", "machine_type", "date",
        "produced_qty")),
    "filter_choices": _on_star(lambda st: filter_choices(st, db.filtered_production(st))),
    # dashboard
    "kpi_summary": _on_star(lambda st: db.kpi_summary(db.filtered_production(st))),
    # a range needs both ends: with one the full range applies (F3); an empty choice selects nothing
    "kpi_one_bound": _on_star(lambda st: db.kpi_summary(db.filtered_production(st, start=FILTER_START))),
    # a filter on the calendar's attributes prunes the fact's month folders
    "calendar_kpis": _on_star(lambda st: db.kpi_summary(db.filtered_production(
        st, FILTER_PLANTS, calendar=(F.col("year") == 1996) & F.col("month").isin(2, 3)))),
    "weekly_production_no_plant": _on_star(lambda st: db.weekly_production(
        db.filtered_production(st, plants=[], attrs=["date"]))),
    "weekly_production": _on_star(lambda st: db.weekly_production(
        db.filtered_production(st, attrs=["date"]))),
    "production_by_category": _on_star(lambda st: db.production_by_category(db.filtered_production(st), st)),
    "defect_rate_by_plant": _on_star(lambda st: db.defect_rate_by_plant(db.filtered_production(st), st)),
    "energy_by_machine_name": _on_star(lambda st: db.energy_by_machine_name(db.filtered_production(st), st)),
    "downtime_by_machine_type": _on_star(lambda st: db.downtime_by_machine_type(db.filtered_production(st), st)),
    "peak_energy_machine": _on_star(lambda st: db.peak_energy_machine(db.filtered_production(st), st)),
    "cost_by_maintenance_type": _on_star(lambda st: db.cost_by_maintenance_type(
        db.filtered_maintenance(st))),
    "maintenance_cost_by_plant": _on_star(lambda st: db.maintenance_cost_by_plant(
        db.filtered_maintenance(st), st)),
    "top_maintenance_events": _on_star(lambda st: db.top_maintenance_events(
        db.filtered_maintenance(st), st)),
    # maintenance views under the plant filter (F5) and under all slicers
    "plant_maintenance_cost_by_type": _on_star(lambda st: db.cost_by_maintenance_type(
        db.filtered_maintenance(st, FILTER_PLANTS))),
    "sliced_maintenance_cost_by_plant": _on_star(lambda st: db.maintenance_cost_by_plant(
        db.filtered_maintenance(st, FILTER_PLANTS, FILTER_TYPES, FILTER_START, FILTER_END), st)),
    "sliced_top_maintenance_events": _on_star(lambda st: db.top_maintenance_events(
        db.filtered_maintenance(st, FILTER_PLANTS, FILTER_TYPES, FILTER_START, FILTER_END), st)),
    "overall_failure_rate": _on_star(lambda st: db.overall_failure_rate(st.fact_production)),
    # BI measures and pages
    "production_measures": _on_star(lambda st: bi.production_measures(
        db.filtered_production(st), "plant_name", star=st)),
    "maintenance_measures": _on_star(lambda st: bi.maintenance_measures(
        st.maintenance_wide(), "plant_name")),
    "executive_overview": _on_star(lambda st: bi.executive_overview(
        st.fact_production, st.fact_maintenance)),
    "production_by_plant": _on_star(lambda st: bi.production_by_plant(
        db.filtered_production(st), star=st)),
    "plant_category_matrix": _on_star(lambda st: bi.plant_category_matrix(
        db.filtered_production(st), star=st)),
    "plant_category_pivot": _on_star(lambda st: bi.plant_category_matrix(
        db.filtered_production(st), wide=True, categories=PIVOT_CATEGORIES, star=st)),
    "defect_rate_trend": _on_star(lambda st: bi.defect_rate_trend(
        db.filtered_production(st, machine_types=TREND_TYPES, attrs=["date"]))),
    "energy_per_unit_vs_age": _on_star(lambda st: bi.energy_per_unit_vs_age(st, AGE_AS_OF)),
    # the production pages under all slicers (V1, V4, V5, V8)
    "sliced_executive_overview": _on_star(lambda st: bi.executive_overview(
        _sliced(st), db.filtered_maintenance(st, FILTER_PLANTS, FILTER_TYPES, FILTER_START, FILTER_END))),
    "sliced_plant_category_matrix": _on_star(lambda st: bi.plant_category_matrix(_sliced(st), star=st)),
    "sliced_defect_rate_trend": _on_star(lambda st: bi.defect_rate_trend(_sliced(st, ["date"]))),
    "sliced_energy_per_unit_vs_age": _on_star(lambda st: bi.energy_per_unit_vs_age(st, AGE_AS_OF, _sliced(st))),
    "same_day_last_year": _on_star(lambda st: bi.same_period_by(db.filtered_production(st), st, "day")),
    "same_week_last_year": _on_star(lambda st: bi.same_period_by(db.filtered_production(st), st, "week", "machine_type")),
    "same_period_last_year": _on_star(lambda st: bi.same_period_last_year(db.filtered_production(st), st)),
    # machine history, calendar, grain
    "prior_downtime_avg3": _on_star(lambda st: history.machine_history(st).select(
        *history.KEYS, "prior_downtime_avg3")),
    "prior_wear": _on_star(lambda st: history.machine_history(st).select(*history.KEYS, "prior_wear")),
    "defect_rate_row": _on_star(lambda st: history.machine_history(st).select(*history.KEYS, "defect_rate")),
    "wear_cycles": _on_star(history.wear_cycles),
    "calendar_dim": _on_star(history.calendar_dim),
    "missing_slots": _on_star(history.missing_slots),
    "missing_slot_runs": _on_star(history.missing_slot_runs),
    # failure-risk model
    "failure_features": _on_star(risk.failure_features),
    "one_hot_features": _on_star(_one_hot),
    "stratified_split": _on_star(lambda st: risk.split_features(st).select(
        *risk.KEYS, risk.LABEL, "is_test")),
    "class_weights": _on_star(lambda st: risk.class_weights(risk.split_features(st).where("is_test = 0"))),
    "classification_report": _on_star(lambda st: evaluation.classification_report(
        risk.rule_predictions(st), risk.LABEL, "prediction", risk.TARGET_NAMES)),
    "roc_auc": _on_star(lambda st: evaluation.roc_auc(risk.rule_predictions(st), risk.LABEL, "score")),
    # permutation importance of a fixed rule, which an SQL engine can repeat
    "rule_permutation_importance": _on_star(lambda st: risk.rounded(risk.rule_importance(st))),
    "rule_top_features": _on_star(lambda st: risk.rounded(risk.top_features(risk.rule_importance(st), 2))),
    # stored models, read back in another session and applied
    "saved_linear_scores": _on_star(saved_models.linear_scores),
    "saved_tree_scores": _on_star(saved_models.tree_scores),
    "saved_tree_report": _on_star(saved_models.tree_report),
    "failure_model": _with_model(risk.model_summary),
    "score_failures": _with_model(lambda m: risk.score(m).select(
        *risk.KEYS, risk.LABEL, "prediction", "p_failure")),
    "failure_model_report": _with_model(lambda m: evaluation.classification_report(
        risk.score(m), risk.LABEL, "prediction", risk.TARGET_NAMES)),
    "permutation_importance": _with_model(risk.permutation_importance),
    "top_features": _with_model(lambda m: risk.top_features(risk.permutation_importance(m))),
}
