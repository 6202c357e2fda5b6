"""Per-query oracle bodies (appended to ``PREFIX``). Column names match the
Spark plans exactly. Totals are taken over nine decimals, more than any
column of the tables has, and read back as the nearest double; names are
looked up by scalar subqueries."""


def _s(c: str) -> str:
    """Exact sum of a double measure, as the nearest double."""
    return f"CAST(CAST(sum(CAST({c} AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE)"


def _avg(c: str) -> str:
    return f"{_s(c)} / count({c})"


def _name(attribute: str, dim: str, key: str, of: str) -> str:
    """The attribute of the dimension row that ``of`` refers to."""
    return f"(SELECT x.{attribute} FROM {dim} x WHERE x.{key} = {of})"


BODIES: dict[str, str] = {}

BODIES["top_energy_machines"] = f"""
SELECT machine_id, {_name('machine_name', 'dim_machine', 'machine_id', 't.machine_id')} AS machine_name,
       {_name('plant_name', 'dim_plant', 'plant_id', _name('plant_id', 'dim_machine', 'machine_id', 't.machine_id'))}
         AS plant_name, round(kwh, 1) AS total_energy_kwh
FROM (SELECT machine_id, {_s('energy_consumed_kwh')} AS kwh FROM fact_production GROUP BY 1) t
ORDER BY total_energy_kwh DESC, machine_id LIMIT 10
"""

_MONTHLY = lambda dim, key, attribute, out: f"""
SELECT who AS {attribute}, yr AS year, mo AS month, round({_s('produced_qty')}, 0) AS {out}
FROM (SELECT {_name(attribute, dim, key, 'f.' + key)} AS who, produced_qty,
             CAST(left(date_id, 4) AS INTEGER) AS yr, CAST(substr(date_id, 5, 2) AS INTEGER) AS mo
      FROM fact_production f)
GROUP BY who, yr, mo ORDER BY 1, 2, 3
"""  # noqa: E731

BODIES["monthly_production_by_plant"] = _MONTHLY("dim_plant", "plant_id", "plant_name", "total_produced")

BODIES["monthly_units_by_category"] = _MONTHLY("dim_product", "product_id", "category", "total_units_produced")

BODIES["oee_by_machine"] = f"""
, per AS (
  SELECT machine_id, 1.0::DOUBLE - {_avg('downtime_minutes')} / 480.0::DOUBLE AS up,
         avg(1.0::DOUBLE - defective_qty::DOUBLE / NULLIF(produced_qty, 0)) AS good
  FROM fact_production GROUP BY machine_id)
SELECT machine_id, {_name('machine_name', 'dim_machine', 'machine_id', 'per.machine_id')} AS machine_name,
       round(up, 3) AS avg_availability, round(good, 3) AS avg_quality, round(up * good, 3) AS oee_proxy
FROM per ORDER BY oee_proxy ASC NULLS FIRST, machine_id LIMIT 10
"""

BODIES["maintenance_cost_by_plant_type"] = f"""
SELECT site AS plant_name, maintenance_type, count(*) AS n_events, round({_s('cost_inr')}, 0) AS total_cost_inr,
       round({_avg('duration_minutes')}, 0) AS avg_duration_minutes
FROM (SELECT *, {_name('plant_name', 'dim_plant', 'plant_id', _name('plant_id', 'dim_machine', 'machine_id', 'v.machine_id'))} AS site
      FROM fact_maintenance v)
GROUP BY site, maintenance_type ORDER BY total_cost_inr DESC, 1, 2
"""

BODIES["failure_rate_by_machine_type"] = f"""
SELECT kind AS machine_type, count(*) AS total_shifts, count(*) FILTER (failure_event = 1) AS failure_shifts,
       round(100.0::DOUBLE * count(*) FILTER (failure_event = 1) / count(*), 2) AS failure_rate_pct
FROM (SELECT failure_event, {_name('machine_type', 'dim_machine', 'machine_id', 'f.machine_id')} AS kind
      FROM fact_production f)
GROUP BY kind ORDER BY failure_rate_pct DESC, 1
"""

# ----------------------------------------------------------------------------- ingest
from shiftline.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS  # noqa: E402

_DIMS = ["dim_plant", "dim_machine", "dim_shift", "dim_product", "dim_date"]
_ALL = _DIMS + ["fact_production", "fact_maintenance"]

for _t in _DIMS + ["fact_production", "fact_maintenance"]:
    BODIES[f"clean_{_t.replace('fact_', '')}" if _t.startswith("fact_") else f"clean_{_t}"] = \
        f"SELECT * FROM {_t}"


def _dim_rejects(t: str) -> str:
    k = PRIMARY_KEYS[t]
    return f"""
  SELECT '{t}' AS table_name, 'kept' AS status, count(DISTINCT {k}) AS n_rows FROM {t}
  UNION ALL SELECT '{t}', 'null_key', count(*) FILTER (WHERE {k} IS NULL) FROM {t}
  UNION ALL SELECT '{t}', 'duplicate_key', count({k}) - count(DISTINCT {k}) FROM {t}"""


BODIES["reject_report"] = "SELECT * FROM (" + " UNION ALL ".join(
    _dim_rejects(t) for t in _DIMS) + """
  UNION ALL SELECT 'fact_production', 'duplicate_slot', (SELECT count(*) FROM prod_rows) - count(*)
            FROM raw_production
  UNION ALL SELECT 'fact_production', coalesce(reject_reason, 'kept'), count(*)
            FROM flagged_production GROUP BY 2
  UNION ALL SELECT 'fact_maintenance', coalesce(reject_reason, 'kept'), count(*)
            FROM flagged_maintenance GROUP BY 2
) WHERE n_rows > 0
"""


def _constraints(t: str) -> str:
    k = PRIMARY_KEYS[t]
    parts = [f"SELECT '{t}' AS table_name, 'pk_null' AS check_name, "
             f"CAST(count(*) FILTER (WHERE {k} IS NULL) AS BIGINT) AS n_violations FROM {t}",
             f"SELECT '{t}', 'pk_duplicate', count({k}) - count(DISTINCT {k}) FROM {t}"]
    parts += [f"SELECT '{t}', 'not_null:{c}', count(*) FILTER (WHERE {c} IS NULL) FROM {t}"
              for c in NOT_NULL[t]]
    parts += [f"SELECT '{t}', 'fk_orphan:{c}', count(*) FROM {t} x WHERE NOT EXISTS "
              f"(SELECT 1 FROM {d} y WHERE y.{PRIMARY_KEYS[d]} = x.{c})"
              for c, d in FOREIGN_KEYS.get(t, [])]
    return "\n  UNION ALL ".join(parts)


BODIES["constraint_report"] = "\n  UNION ALL ".join(_constraints(t) for t in _ALL)

BODIES["table_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _ALL)

# ----------------------------------------------------------------------------- star
# The attributes of the wide views by table, in the order of its schema.
_WIDE = {"dim_plant": ["plant_name", "city"], "dim_machine": ["machine_name", "machine_type"],
         "dim_shift": ["shift_name"], "dim_product": ["product_name", "category"],
         "dim_date": ["date", "year", "month", "day_of_week", "is_weekend"]}
_MAINTENANCE_WIDE = {"dim_machine": ["plant_id", "machine_name"]}


def _looked_up(row: str, spec: dict[str, list[str]]) -> str:
    """Attributes of the dimension rows that ``row`` refers to."""
    return ", ".join(f"{_name(c, d, PRIMARY_KEYS[d], f'{row}.{PRIMARY_KEYS[d]}')} AS {c}"
                     for d, columns in spec.items() for c in columns)


def _total(c: str) -> str:
    """Exact partial sum, to be added up again."""
    return f"sum(CAST({c} AS DECIMAL(38,9)))"


def _double(total: str) -> str:
    return f"CAST(CAST({total} AS VARCHAR) AS DOUBLE)"


def _plant_of(machine: str) -> str:
    """Name of the plant of a machine."""
    return _name("plant_name", "dim_plant", "plant_id", _name("plant_id", "dim_machine", "machine_id", machine))


def _through(source: str, key: str, sums: dict[str, str], names: dict[str, str], more: tuple[str, ...] = ()) -> str:
    """``source`` totalled on a foreign key (and columns ``more``), with ``names`` looked up for the totals.

    In ``names`` the key of a total is written {key}."""
    own = ", ".join((key, *more))
    looked = ", ".join(f"{sql.format(key=f'totals.{key}')} AS {n}" for n, sql in names.items())
    return (f"(SELECT totals.*, {looked} FROM (SELECT {own}, "
            + ", ".join(f"{sql} AS {n}" for n, sql in sums.items()) + f" FROM {source} GROUP BY {own}) totals)")


_PLANT_NAME = _name("plant_name", "dim_plant", "plant_id", "{key}")
_CATEGORY = _name("category", "dim_product", "product_id", "{key}")
_MACHINE_NAME, _MACHINE_TYPE = (_name(c, "dim_machine", "machine_id", "{key}") for c in ("machine_name", "machine_type"))
_DAY = _name("date", "dim_date", "date_id", "{key}")
_MONDAY = "date_trunc('week', {d})"
_WEEK = (f"strftime({_MONDAY}, '%Y-%m-%d') || '/' || strftime({_MONDAY} + INTERVAL 6 DAY, '%Y-%m-%d')").format

BODIES["wide_production"] = f"SELECT made.*, {_looked_up('made', _WIDE)} FROM fact_production made"

BODIES["maintenance_wide"] = f"""
SELECT placed.*, {_looked_up('placed', {'dim_plant': ['plant_name']})}
FROM (SELECT event.*, {_looked_up('event', _MAINTENANCE_WIDE)} FROM fact_maintenance event) placed
"""

_PLANTS = "plant_id IN (SELECT plant_id FROM dim_plant WHERE plant_name IN ('ASIA', 'EUROPE'))"
_TYPES = "machine_id IN (SELECT machine_id FROM dim_machine WHERE machine_type IN ('TYPE_1', 'TYPE_3', 'TYPE_5'))"
_DAYS = "date_id BETWEEN '19960101' AND '19970630'"
_CHOSEN = f"(SELECT * FROM fact_production WHERE {_PLANTS} AND {_TYPES} AND {_DAYS})"

BODIES["filtered_production"] = f"""
SELECT record_id, machine_id, date_id, shift_id, produced_qty,
       {_looked_up('chosen', {'dim_plant': ['plant_name'], 'dim_machine': ['machine_type'], 'dim_date': ['date']})}
FROM {_CHOSEN} chosen
"""

_USED = "{k} IN (SELECT {k} FROM fact_production)".format
BODIES["filter_choices"] = f"""
SELECT DISTINCT 'plant_name' AS kind, plant_name AS value FROM dim_plant WHERE {_USED(k='plant_id')}
UNION ALL SELECT DISTINCT 'machine_type', machine_type FROM dim_machine WHERE {_USED(k='machine_id')}
UNION ALL SELECT unnest(['date_min', 'date_max']), unnest([CAST(min(date) AS VARCHAR), CAST(max(date) AS VARCHAR)])
FROM dim_date WHERE {_USED(k='date_id')}
"""

# ----------------------------------------------------------------------------- dashboard
BODIES["kpi_summary"] = f"""
SELECT {_s('produced_qty')} AS units_produced,
       {_avg('downtime_minutes')} AS avg_downtime_minutes,
       CAST(sum(defective_qty) AS DOUBLE) / NULLIF({_s('produced_qty')}, 0) * 100.0::DOUBLE AS defect_rate_pct,
       {_s('energy_consumed_kwh')} AS total_energy_kwh,
       CAST(sum(failure_event) AS BIGINT) AS failure_events
FROM fact_production
"""

_MADE = {"made": _total("produced_qty")}
BODIES["weekly_production"] = f"""
SELECT {_WEEK(d='day')} AS week, {_double('sum(made)')} AS produced_qty
FROM {_through('fact_production', 'date_id', _MADE, {'day': _DAY})} GROUP BY 1 ORDER BY 1
"""

BODIES["kpi_one_bound"] = BODIES["kpi_summary"]

BODIES["weekly_production_no_plant"] = BODIES["weekly_production"].replace("GROUP BY 1", "WHERE false GROUP BY 1")

BODIES["production_by_category"] = f"""
SELECT category, {_double('sum(made)')} AS produced_qty
FROM {_through('fact_production', 'product_id', _MADE, {'category': _CATEGORY})}
GROUP BY category ORDER BY 2 DESC, 1
"""

BODIES["defect_rate_by_plant"] = f"""
SELECT plant_name, {_double('sum(made)')} AS produced, CAST(sum(bad) AS BIGINT) AS defective,
       CAST(sum(bad) AS DOUBLE) / NULLIF({_double('sum(made)')}, 0) * 100.0::DOUBLE AS defect_rate_pct
FROM {_through('fact_production', 'plant_id', _MADE | {'bad': 'sum(defective_qty)'}, {'plant_name': _PLANT_NAME})}
GROUP BY plant_name ORDER BY 1
"""

_KWH = _through("fact_production", "machine_id", {"kwh": _total("energy_consumed_kwh")}, {"machine_name": _MACHINE_NAME})
_ENERGY_BY_NAME = f"SELECT machine_name, {_double('sum(kwh)')} AS {{out}} FROM {_KWH} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {{k}}"
BODIES["energy_by_machine_name"] = _ENERGY_BY_NAME.format(out="energy_consumed_kwh", k=10)
BODIES["peak_energy_machine"] = _ENERGY_BY_NAME.format(out="total_energy_kwh", k=1)

BODIES["downtime_by_machine_type"] = f"""
SELECT machine_type, {_double('sum(down)')} / sum(timed) AS downtime_minutes
FROM {_through('fact_production', 'machine_id', {'down': _total('downtime_minutes'), 'timed': 'count(downtime_minutes)'},
               {'machine_type': _MACHINE_TYPE})}
GROUP BY machine_type ORDER BY 2 DESC, 1
"""

_COST = {"cost": _total("cost_inr")}
_SITE = {"plant_name": _plant_of("{key}")}
BODIES["cost_by_maintenance_type"] = f"""
SELECT maintenance_type, {_s('cost_inr')} AS cost_inr FROM fact_maintenance GROUP BY 1 ORDER BY 1
"""

BODIES["maintenance_cost_by_plant"] = f"""
SELECT plant_name, {_double('sum(cost)')} AS cost_inr
FROM {_through('fact_maintenance', 'machine_id', _COST, _SITE)} GROUP BY 1 ORDER BY 2 DESC, 1
"""

_EVENTS = """
SELECT maintenance_id, {machine} AS machine_name, {plant} AS plant_name, maintenance_type, duration_minutes, cost_inr,
       technician_team
FROM (SELECT * FROM {source} ORDER BY cost_inr DESC, maintenance_id LIMIT 20) costliest
ORDER BY cost_inr DESC, maintenance_id
"""
_NAMES = {"machine": _MACHINE_NAME.format(key="costliest.machine_id"), "plant": _plant_of("costliest.machine_id")}
BODIES["top_maintenance_events"] = _EVENTS.format(source="fact_maintenance", **_NAMES)

BODIES["overall_failure_rate"] = """
SELECT count(*) AS n_rows, CAST(sum(failure_event) AS DOUBLE) / count(failure_event) * 100.0::DOUBLE AS failure_rate_pct
FROM fact_production
"""

# ----------------------------------------------------------------------------- BI measures
# Partial sums on a foreign key, and the measures over them.
_SUMS = _MADE | {"bad": "sum(defective_qty)", "down": _total("downtime_minutes"), "timed": "count(downtime_minutes)",
                 "kwh": _total("energy_consumed_kwh"), "failed": "sum(failure_event)", "run": "count(*)"}
_UNITS, _DOWN, _ENERGY = (_double(f"sum({c})") for c in ("made", "down", "kwh"))
_BAD, _FAILED = "CAST(sum(bad) AS BIGINT)", "CAST(sum(failed) AS BIGINT)"
_DEFECTIVE = f"coalesce({_BAD} / NULLIF({_UNITS}, 0), 0.0::DOUBLE) * 100.0::DOUBLE"
_AVAILABLE = f"(1.0::DOUBLE - coalesce({_DOWN} / (CAST(sum(run) AS BIGINT) * 480.0::DOUBLE), 0.0::DOUBLE)) * 100.0::DOUBLE"
_MEASURES = {
    "total_units_produced": _UNITS,
    "total_defective_units": _BAD,
    "defect_rate_pct": _DEFECTIVE,
    "total_downtime_hrs": f"{_DOWN} / 60.0::DOUBLE",
    "avg_downtime_per_shift_min": f"{_DOWN} / sum(timed)",
    "total_energy_kwh": _ENERGY,
    "energy_per_unit_kwh": f"coalesce({_ENERGY} / NULLIF({_UNITS}, 0), 0.0::DOUBLE)",
    "failure_count": _FAILED,
    "failure_rate_pct": f"coalesce({_FAILED} / CAST(sum(run) AS BIGINT), 0.0::DOUBLE) * 100.0::DOUBLE",
    "availability_pct": _AVAILABLE,
    "quality_pct": f"100.0::DOUBLE - {_DEFECTIVE}",
    "oee_proxy_pct": f"{_AVAILABLE} * (100.0::DOUBLE - {_DEFECTIVE}) / 100.0::DOUBLE",
}
_COSTS = _COST | {k: _total(f"CASE WHEN maintenance_type = '{v}' THEN cost_inr END")
                  for k, v in (("planned", "Preventive"), ("repair", "Corrective"))}
_PLANNED, _ALL_COST = _double("sum(planned)"), _double("sum(cost)")
_MMEASURES = {
    "total_maintenance_cost": _ALL_COST,
    "preventive_maintenance_cost": _PLANNED,
    "corrective_maintenance_cost": _double("sum(repair)"),
    "preventive_cost_share_pct": f"coalesce({_PLANNED} / NULLIF({_ALL_COST}, 0), 0.0::DOUBLE) * 100.0::DOUBLE",
}


def _sel(spec: dict, names=None) -> str:
    return ",\n       ".join(f"{spec[n]} AS {n}" for n in (names or spec))


_BY_PLANT = _through("fact_production", "plant_id", _SUMS, {"plant_name": _PLANT_NAME})

BODIES["production_measures"] = f"SELECT plant_name, {_sel(_MEASURES)} FROM {_BY_PLANT} GROUP BY plant_name ORDER BY 1"

BODIES["maintenance_measures"] = f"""
SELECT plant_name, {_sel(_MMEASURES)}
FROM {_through('fact_maintenance', 'machine_id', _COSTS, _SITE)} GROUP BY plant_name ORDER BY 1
"""

_CARDS = ["total_units_produced", "failure_rate_pct", "availability_pct", "oee_proxy_pct"]
_OVERVIEW = """
SELECT {cards}, (SELECT {cost} FROM {events}) AS total_maintenance_cost
FROM (SELECT {sums} FROM {source}) totals
"""
_OVERVIEW_OF = {"cards": _sel(_MEASURES, _CARDS), "cost": _s("cost_inr"),
                "sums": ", ".join(f"{sql} AS {n}" for n, sql in _SUMS.items())}
BODIES["executive_overview"] = _OVERVIEW.format(**_OVERVIEW_OF, events="fact_maintenance", source="fact_production")

BODIES["production_by_plant"] = f"SELECT plant_name, {_UNITS} AS total_units_produced FROM {_BY_PLANT} GROUP BY 1 ORDER BY 1"


def _matrix(source: str) -> str:
    """Totals by product and plant, with the names of both."""
    return _through(source, "product_id", _SUMS, {
        "category": _CATEGORY, "plant_name": _name("plant_name", "dim_plant", "plant_id", "totals.plant_id")}, ("plant_id",))


_MATRIX = f"""
SELECT plant_name, category, {_sel(_MEASURES, ['total_units_produced', 'defect_rate_pct'])}
FROM {{cells}} GROUP BY plant_name, category ORDER BY 1, 2
"""
BODIES["plant_category_matrix"] = _MATRIX.format(cells=_matrix("fact_production"))

_TREND = f"""
SELECT {_WEEK(d='day')} AS period, {_sel(_MEASURES, ['total_defective_units', 'total_units_produced', 'defect_rate_pct'])}
FROM {{days}} GROUP BY 1 ORDER BY 1
"""
BODIES["defect_rate_trend"] = _TREND.format(days=_through(
    "(SELECT * FROM fact_production WHERE machine_id IN (SELECT machine_id FROM dim_machine "
    "WHERE machine_type = 'TYPE_0' OR machine_type = 'TYPE_2'))", "date_id", _SUMS, {"day": _DAY}))

_INSTALLED = _name("install_date", "dim_machine", "machine_id", "{key}")
_AGED = f"""
SELECT machine_id, machine_name, machine_type, install_date,
       date_diff('day', install_date, DATE '2002-01-01') / 365.25::DOUBLE AS machine_age_years,
       {_double('kwh')} AS total_energy_kwh, {_double('made')} AS total_units_produced,
       coalesce({_double('kwh')} / NULLIF({_double('made')}, 0), 0.0::DOUBLE) AS energy_per_unit_kwh
FROM {{machines}} ORDER BY machine_id
"""


def _aged(source: str) -> str:
    return _AGED.format(machines=_through(
        source, "machine_id", {"kwh": _total("energy_consumed_kwh"), **_MADE},
        {"machine_name": _MACHINE_NAME, "machine_type": _MACHINE_TYPE, "install_date": _INSTALLED}))


BODIES["energy_per_unit_vs_age"] = _aged("fact_production")

BODIES["same_period_last_year"] = f"""
, monthly AS (
  SELECT plant_name, CAST(left(date_id, 4) AS INTEGER) AS year, CAST(substr(date_id, 5, 2) AS INTEGER) AS month,
         {_double('sum(made)')} AS units
  FROM {_through('fact_production', 'date_id', _MADE, {'plant_name': _name('plant_name', 'dim_plant', 'plant_id', 'totals.plant_id')}, ('plant_id',))}
  GROUP BY ALL)
SELECT plant_name, year, month, units AS total_units_produced, earlier AS units_same_period_last_year,
       units - earlier AS yoy_change
FROM (SELECT *, (SELECT ago.units FROM monthly ago WHERE ago.plant_name = now.plant_name AND ago.month = now.month
                 AND ago.year = now.year - 1) AS earlier FROM monthly now)
ORDER BY 1, 2, 3
"""

# ----------------------------------------------------------------------------- history
_W = "PARTITION BY machine_id ORDER BY date_id, shift_id, record_id"

def _prior3(w: str) -> str:
    """Mean of the three values before, added in sequence order."""
    lags = [f"lag(downtime_minutes, {k}) OVER ({w})" for k in (3, 2, 1)]
    total = " + ".join(f"coalesce({x}, 0.0::DOUBLE)" for x in lags)
    found = " + ".join(f"({x} IS NOT NULL)::INTEGER" for x in lags)
    return f"coalesce(({total}) / NULLIF({found}, 0), 0.0::DOUBLE)"


BODIES["prior_downtime_avg3"] = f"""
SELECT machine_id, date_id, shift_id, record_id, {_prior3(_W)} AS prior_downtime_avg3
FROM fact_production
"""

BODIES["prior_wear"] = f"""
SELECT machine_id, date_id, shift_id, record_id,
       coalesce(lag(machine_wear_index) OVER ({_W}), machine_wear_index) AS prior_wear
FROM fact_production
"""

BODIES["defect_rate_row"] = """
SELECT machine_id, date_id, shift_id, record_id,
       coalesce(CAST(defective_qty AS DOUBLE) / NULLIF(produced_qty, 0), 0.0::DOUBLE) AS defect_rate
FROM fact_production
"""

BODIES["wear_cycles"] = f"""
, wc AS (
  SELECT f.machine_id, f.date_id, f.shift_id, f.record_id, f.failure_event,
         CAST(coalesce(sum(f.failure_event) OVER ({_W.replace('machine_id', 'f.machine_id')}
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + (SELECT count(DISTINCT m.date_id) FROM fact_maintenance m
                 WHERE m.machine_id = f.machine_id AND m.maintenance_type = 'Preventive'
                   AND m.date_id < f.date_id) AS BIGINT) AS cycle_id
  FROM fact_production f)
SELECT *, row_number() OVER (PARTITION BY machine_id, cycle_id ORDER BY date_id, shift_id, record_id)
       AS shifts_in_cycle
FROM wc
"""

BODIES["calendar_dim"] = """
SELECT strftime(d, '%Y%m%d') AS date_id, d AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       dayname(d) AS day_of_week, CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(CAST(strptime(min(date_id), '%Y%m%d') AS DATE),
                                         CAST(strptime(max(date_id), '%Y%m%d') AS DATE),
                                         INTERVAL 1 DAY)) AS DATE) AS d
      FROM fact_production)
"""

BODIES["missing_slots"] = """
, span AS (SELECT machine_id, min(date_id) AS lo, max(date_id) AS hi FROM fact_production GROUP BY machine_id),
expected AS (
  SELECT s.machine_id, strftime(g.d, '%Y%m%d') AS date_id, sh.shift_id
  FROM span s,
       LATERAL (SELECT unnest(generate_series(strptime(s.lo, '%Y%m%d'), strptime(s.hi, '%Y%m%d'),
                                              INTERVAL 1 DAY)) AS d) g,
       dim_shift sh)
SELECT * FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM fact_production f
                  WHERE f.machine_id = e.machine_id AND f.date_id = e.date_id AND f.shift_id = e.shift_id)
"""

# ----------------------------------------------------------------------------- risk model
_FEAT = f"""
, feat AS (
  SELECT machine_id, date_id, shift_id, record_id, plant_id, planned_qty,
         coalesce(lag(machine_wear_index) OVER ({_W}), machine_wear_index) AS prior_wear,
         {_prior3(_W)} AS prior_downtime_avg3, failure_event,
         {_looked_up('made', {'dim_machine': ['rated_capacity_units_per_hour', 'base_energy_kwh_per_hour', 'machine_type'],
                              'dim_date': ['is_weekend']})}
  FROM fact_production made
),
split AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY failure_event ORDER BY k)
                 <= ceil(CAST(count(*) OVER (PARTITION BY failure_event) * 20 AS DOUBLE) / 100.0::DOUBLE)
                 AS INTEGER) AS is_test
  FROM (SELECT *, md5(concat_ws('|', '42', machine_id, date_id, shift_id)) AS k FROM feat)
)
"""

BODIES["failure_features"] = _FEAT + """
SELECT machine_id, date_id, shift_id, record_id, plant_id, planned_qty, prior_wear, prior_downtime_avg3,
       rated_capacity_units_per_hour, base_energy_kwh_per_hour, is_weekend, machine_type, failure_event
FROM feat
"""

# Category levels of the fixture (8 machine types, 3 shifts, 5 plants);
# the first level of each is dropped.
_LEVELS = {"machine_type": [f"TYPE_{i}" for i in range(1, 8)], "shift_id": ["S2", "S3"],
           "plant_id": ["P02", "P03", "P04", "P05"]}
_NUM = ["planned_qty", "prior_wear", "prior_downtime_avg3", "rated_capacity_units_per_hour",
        "base_energy_kwh_per_hour", "is_weekend"]
BODIES["one_hot_features"] = _FEAT + "SELECT machine_id, date_id, shift_id, failure_event, " + ", ".join(
    [f"CAST({c} AS DOUBLE) AS {c}" for c in _NUM]
    + [f"CAST({c} = '{lv}' AS DOUBLE) AS {c}_{lv}" for c, lvs in _LEVELS.items() for lv in lvs]) + " FROM feat"

BODIES["stratified_split"] = _FEAT + "SELECT machine_id, date_id, shift_id, failure_event, is_test FROM split"

BODIES["class_weights"] = _FEAT + """
SELECT failure_event, count(*) AS n_rows,
       CAST((SELECT count(*) FROM split WHERE is_test = 0) AS DOUBLE)
       / ((SELECT count(DISTINCT failure_event) FROM split WHERE is_test = 0) * count(*)) AS weight
FROM split WHERE is_test = 0 GROUP BY failure_event
"""

_P = lambda tp, den: f"coalesce(CAST({tp} AS DOUBLE) / NULLIF({den}, 0), 0.0::DOUBLE)"
_F1 = lambda p, r: f"coalesce(2.0::DOUBLE * {p} * {r} / NULLIF({p} + {r}, 0), 0.0::DOUBLE)"

BODIES["classification_report"] = _FEAT + f"""
, rp AS (SELECT failure_event AS y, CAST(prior_wear >= 0.5 AS INTEGER) AS p FROM split WHERE is_test = 1),
c AS (SELECT count(*) FILTER (WHERE y = 0 AND p = 0) AS n00, count(*) FILTER (WHERE y = 0 AND p = 1) AS n01,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS n10, count(*) FILTER (WHERE y = 1 AND p = 1) AS n11
      FROM rp),
s AS (SELECT *, {_P('n00', 'n00 + n10')} AS p0, {_P('n00', 'n00 + n01')} AS r0,
             {_P('n11', 'n11 + n01')} AS p1, {_P('n11', 'n11 + n10')} AS r1,
             n00 + n01 AS s0, n10 + n11 AS s1 FROM c),
t AS (SELECT *, {_F1('p0', 'r0')} AS f0, {_F1('p1', 'r1')} AS f1, s0 + s1 AS tot FROM s)
SELECT 'No failure' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM t
UNION ALL SELECT 'Failure', p1, r1, f1, s1 FROM t
UNION ALL SELECT 'accuracy', NULL, NULL, CAST(n00 + n11 AS DOUBLE) / tot, tot FROM t
UNION ALL SELECT 'macro avg', (p0 + p1) / 2.0::DOUBLE, (r0 + r1) / 2.0::DOUBLE, (f0 + f1) / 2.0::DOUBLE, tot FROM t
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / tot, (r0 * s0 + r1 * s1) / tot, (f0 * s0 + f1 * s1) / tot, tot
FROM t
"""

BODIES["roc_auc"] = _FEAT + """
, per AS (SELECT prior_wear AS s, count(*) FILTER (WHERE failure_event = 0) AS n0,
                 count(*) FILTER (WHERE failure_event = 1) AS n1
          FROM split WHERE is_test = 1 GROUP BY prior_wear),
cum AS (SELECT n0, n1, coalesce(sum(n0) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS below FROM per)
SELECT CAST(sum(n1 * (2 * below + n0)) AS DOUBLE) / CAST(2 * sum(n1) * sum(n0) AS DOUBLE) AS roc_auc,
       CAST(sum(n1) AS BIGINT) AS n_pos, CAST(sum(n0) AS BIGINT) AS n_neg
FROM cum
"""

# ----------------------------------------------------------------------------- SQL text (S3)
for _n in ["top_energy_machines", "monthly_production_by_plant", "oee_by_machine",
           "maintenance_cost_by_plant_type", "failure_rate_by_machine_type", "monthly_units_by_category"]:
    BODIES[f"sql_{_n}"] = BODIES[_n]

# The product categories of the part table.
_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_PIVOTED = ", ".join([_double(f"sum(CASE WHEN category = '{c}' THEN made END)") + f' AS "{c}"' for c in _CATEGORIES])
_REST = "category IS NULL OR category NOT IN (" + ", ".join(f"'{c}'" for c in _CATEGORIES) + ")"
BODIES["plant_category_pivot"] = f"""
SELECT plant_name, {_PIVOTED}, {_double(f"sum(CASE WHEN {_REST} THEN made END)")} AS other
FROM {_matrix('fact_production')} GROUP BY 1 ORDER BY 1
"""

_SLICED = f"""(SELECT * FROM fact_maintenance WHERE {_DAYS} AND {_TYPES}
  AND machine_id IN (SELECT machine_id FROM dim_machine WHERE {_PLANTS}))"""

BODIES["plant_maintenance_cost_by_type"] = f"""
SELECT maintenance_type, {_s('cost_inr')} AS cost_inr FROM fact_maintenance
WHERE machine_id IN (SELECT machine_id FROM dim_machine WHERE {_PLANTS}) GROUP BY 1 ORDER BY 1
"""

BODIES["sliced_maintenance_cost_by_plant"] = f"""
SELECT plant_name, {_double('sum(cost)')} AS cost_inr
FROM {_through(_SLICED, 'machine_id', _COST, _SITE)} GROUP BY 1 ORDER BY 2 DESC, 1
"""

BODIES["sliced_top_maintenance_events"] = _EVENTS.format(source=_SLICED, **_NAMES)

# All slicers on the production pages (V1, V4, V5, V8).
BODIES["sliced_executive_overview"] = _OVERVIEW.format(**_OVERVIEW_OF, events=_SLICED, source=_CHOSEN)
BODIES["sliced_plant_category_matrix"] = _MATRIX.format(cells=_matrix(_CHOSEN))
BODIES["sliced_defect_rate_trend"] = _TREND.format(days=_through(_CHOSEN, "date_id", _SUMS, {"day": _DAY}))
BODIES["sliced_energy_per_unit_vs_age"] = _aged(_CHOSEN)

# ----------------------------------------------------------------------------- CSV path
BODIES["csv_products"] = """
SELECT product_id, product_name, category, uom FROM dim_product WHERE CAST(product_id AS BIGINT) % 40 <> 0
UNION ALL
SELECT product_id, product_name || ' (again)', category, uom FROM dim_product
WHERE CAST(product_id AS BIGINT) % 40 = 0 AND CAST(product_id AS BIGINT) % 7 = 0
"""

_CSV = """
, dirty AS (
  SELECT * REPLACE (
    CASE WHEN record_id % 11 = 0 THEN NULL ELSE downtime_minutes END AS downtime_minutes,
    defective_qty + CASE WHEN record_id % 3 = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS defective_qty,
    CASE WHEN record_id % 5 = 0 THEN defective_qty - 0.4::DOUBLE ELSE produced_qty END AS produced_qty,
    CASE WHEN record_id % 13 = 0 THEN NULL ELSE failure_event END AS failure_event)
  FROM prod_rows),
judged AS (
  SELECT d.*, CASE
    WHEN NOT EXISTS (SELECT 1 FROM dim_plant x WHERE x.plant_id = d.plant_id) THEN 'orphan_plant'
    WHEN NOT EXISTS (SELECT 1 FROM dim_machine x WHERE x.machine_id = d.machine_id) THEN 'orphan_machine'
    WHEN NOT EXISTS (SELECT 1 FROM dim_shift x WHERE x.shift_id = d.shift_id) THEN 'orphan_shift'
    WHEN NOT EXISTS (SELECT 1 FROM dim_product x WHERE x.product_id = d.product_id) THEN 'orphan_product'
    WHEN NOT EXISTS (SELECT 1 FROM dim_date x WHERE x.date_id = d.date_id) THEN 'orphan_date'
    WHEN produced_qty < 0 THEN 'negative_produced' WHEN defective_qty < 0 THEN 'negative_defective'
    WHEN downtime_minutes IS NULL OR downtime_minutes < 0 OR downtime_minutes > 480 THEN 'downtime_out_of_range'
    WHEN energy_consumed_kwh < 0 THEN 'negative_energy' WHEN failure_event IS NULL THEN 'missing_failure_flag'
    ELSE 'kept' END AS status FROM dirty d)
"""

BODIES["csv_production"] = _CSV + """
SELECT record_id, machine_id, date_id, shift_id, produced_qty,
       CAST(round_even(least(defective_qty, produced_qty), 0) AS INTEGER) AS defective_qty,
       downtime_minutes, failure_event
FROM judged WHERE status = 'kept'
"""

BODIES["csv_production_rejects"] = _CSV + """
SELECT 'fact_production' AS table_name, status, count(*) AS n_rows FROM judged GROUP BY status
"""

BODIES["missing_slot_runs"] = """
, bounds AS (SELECT strptime(min(date_id), '%Y%m%d') AS lo, strptime(max(date_id), '%Y%m%d') AS hi FROM fact_production),
slots AS (
  SELECT strftime(d, '%Y%m%d') || ' ' || shift_id AS slot, row_number() OVER (ORDER BY d, shift_id) AS n
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM bounds), dim_shift),
missing AS (
  SELECT machine_id, slot, n, n - row_number() OVER (PARTITION BY machine_id ORDER BY n) AS island
  FROM (SELECT machine_id, slot, n FROM dim_machine, slots) e
  WHERE NOT EXISTS (SELECT 1 FROM fact_production f
                    WHERE f.machine_id = e.machine_id AND f.date_id || ' ' || f.shift_id = e.slot))
SELECT machine_id, min(slot) AS first_slot, max(slot) AS last_slot, count(*) AS n_slots
FROM missing GROUP BY machine_id, island
"""

# ----------------------------------------------------------------------------- importance of a fixed rule
_RULE = "CAST({w} >= 0.5 OR ({d} >= 200 AND {q} >= 25) AS INTEGER) = y"
_IMPORTANCE = _FEAT + f"""
, t AS (
  SELECT failure_event AS y, prior_wear AS w, prior_downtime_avg3 AS d, planned_qty AS q,
         concat_ws('|', machine_id, date_id, shift_id) AS id FROM split WHERE is_test = 1),
placed AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || id)) AS pos FROM t),
given AS (
  SELECT f, r, CASE f WHEN 'prior_wear' THEN w WHEN 'prior_downtime_avg3' THEN d ELSE q END AS v,
         row_number() OVER (PARTITION BY f, r ORDER BY md5('42|' || r || '|' || f || '|' || id)) AS pos
  FROM t, (SELECT unnest(['prior_wear', 'prior_downtime_avg3', 'planned_qty']) AS f), (SELECT unnest(range(5)) AS r)),
scored AS (
  SELECT f, r, avg(CASE WHEN {_RULE.format(w="CASE f WHEN 'prior_wear' THEN v ELSE w END",
                                            d="CASE f WHEN 'prior_downtime_avg3' THEN v ELSE d END",
                                            q="CASE f WHEN 'planned_qty' THEN v ELSE q END")}
                        THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS m
  FROM given JOIN placed USING (pos) GROUP BY f, r)
SELECT f AS feature, round(avg(b - m), 9) AS importance_mean, round(stddev_pop(b - m), 9) AS importance_std
FROM scored, (SELECT avg(CASE WHEN {_RULE.format(w='w', d='d', q='q')} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS b FROM t)
GROUP BY f
"""
BODIES["rule_permutation_importance"] = _IMPORTANCE
BODIES["rule_top_features"] = _IMPORTANCE + " ORDER BY importance_mean DESC, feature LIMIT 2"

# ----------------------------------------------------------------------------- calendar filters, SQL markers, shifted periods
BODIES["sql_filtered_kpis"] = BODIES["kpi_summary"].replace("FROM fact_production", f"FROM {_CHOSEN} chosen")

BODIES["calendar_kpis"] = BODIES["kpi_summary"].replace(
    "FROM fact_production", f"FROM fact_production WHERE {_PLANTS} AND left(date_id, 6) IN ('199602', '199603')")

_YEAR_BEFORE = """
, daily AS (SELECT {group}, CAST(strptime(date_id, '%Y%m%d') AS DATE) AS d, sum(made) AS made FROM {totals} GROUP BY ALL),
days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM daily),
bridge AS (SELECT DISTINCT {period} AS period, CAST(d - INTERVAL 12 MONTH AS DATE) AS ago FROM days),
now AS (SELECT {group}, {period} AS period, sum(made) AS made FROM daily GROUP BY ALL),
earlier AS (SELECT {group}, period, sum(made) AS made FROM daily JOIN bridge ON d = ago GROUP BY ALL),
paired AS (
  SELECT now.{group}, now.period, {now} AS total_units_produced, {earlier} AS units_same_period_last_year
  FROM now LEFT JOIN earlier ON earlier.{group} = now.{group} AND earlier.period = now.period)
SELECT *, total_units_produced - units_same_period_last_year AS yoy_change FROM paired ORDER BY 1, 2
"""
_SHIFTED = {"now": _double("now.made"), "earlier": _double("earlier.made")}
BODIES["same_day_last_year"] = _YEAR_BEFORE.format(
    group="plant_name", period="strftime(d, '%Y-%m-%d')", **_SHIFTED,
    totals=_through("fact_production", "plant_id", _MADE, {"plant_name": _PLANT_NAME}, ("date_id",)))
BODIES["same_week_last_year"] = _YEAR_BEFORE.format(
    group="machine_type", period=_WEEK(d="d"), **_SHIFTED,
    totals=_through("fact_production", "machine_id", _MADE, {"machine_type": _MACHINE_TYPE}, ("date_id",)))

# ----------------------------------------------------------------------------- stored models
from shiftline.plans import saved_models as _models  # noqa: E402  (the stored numbers only)

_TEST = ", test AS (SELECT * FROM split WHERE is_test = 1)"
_VALUE = {**{c: c for c in _NUM}, **{f"{c}_{lv}": f"({c} = '{lv}')" for c, lvs in _LEVELS.items() for lv in lvs}}
_MARGIN = " + ".join([f"({_models.LINEAR_BASE}::DOUBLE)"] + [
    f"({w}::DOUBLE) * CAST({_VALUE[n]} AS DOUBLE)" for n, w in _models.LINEAR.items()])
BODIES["saved_linear_scores"] = _FEAT + _TEST + f"""
, scored AS (SELECT machine_id, date_id, shift_id, failure_event, 1 / (1 + exp(-({_MARGIN}))) AS p FROM test)
SELECT machine_id, date_id, shift_id, failure_event, round(p, 9) AS p_failure, CAST(p >= 0.5 AS INTEGER) AS prediction
FROM scored
"""

_NODES = ", ".join(
    f"({t}, {k}, '{n[0]}', {n[1]}::DOUBLE, {n[2]}, {n[3]}, NULL)" if isinstance(n, tuple) else
    f"({t}, {k}, NULL, NULL, NULL, NULL, {n}::DOUBLE)" for t, tree in enumerate(_models.TREES) for k, n in enumerate(tree))
_CELLS = "MAP {" + ", ".join(f"'{n}': CAST({sql} AS DOUBLE)" for n, sql in _VALUE.items()) + "}"
_WALKED = _FEAT + _TEST + f"""
, nodes(tree, node, feature, threshold, yes, no, value) AS (VALUES {_NODES}),
at0 AS (SELECT machine_id, date_id, shift_id, failure_event, {_CELLS} AS x, tree, 0 AS node
        FROM test, (SELECT DISTINCT tree FROM nodes))
""" + "".join(f"""
, at{k + 1} AS (SELECT a.* REPLACE (CASE WHEN feature IS NULL THEN a.node WHEN x[feature] <= threshold THEN yes ELSE no END AS node)
          FROM at{k} a JOIN nodes n ON n.tree = a.tree AND n.node = a.node)""" for k in range(3)) + f"""
, scored AS (
  SELECT machine_id, date_id, shift_id, failure_event,
         1 / (1 + exp(-(({_models.TREES_BASE}::DOUBLE) + ({_models.TREES_RATE}::DOUBLE) * sum(value)))) AS p
  FROM at3 a JOIN nodes n ON n.tree = a.tree AND n.node = a.node GROUP BY ALL)
"""
BODIES["saved_tree_scores"] = _WALKED + """
SELECT machine_id, date_id, shift_id, failure_event, round(p, 9) AS p_failure, CAST(p >= 0.5 AS INTEGER) AS prediction
FROM scored
"""
BODIES["saved_tree_report"] = _WALKED + BODIES["classification_report"][len(_FEAT):].replace(
    "SELECT failure_event AS y, CAST(prior_wear >= 0.5 AS INTEGER) AS p FROM split WHERE is_test = 1",
    "SELECT failure_event AS y, CAST(p >= 0.5 AS INTEGER) AS p FROM scored")
