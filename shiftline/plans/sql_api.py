"""SQL-text access to the star: register views, run SQL strings.

Users who query the warehouse with SQL text keep doing so: the seven
tables are registered as temporary views and ``spark.sql`` plans the text
through the same optimizer as the DataFrame plans. The sample queries are
given here in Spark SQL: facts are totalled by foreign key first, exactly,
and names are looked up for the totals only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.operators.star import Star, date_bounds

# Exact total of a double column: NaN and null are missing.
_TOTAL = "SUM(CAST(NULLIF({c}, DOUBLE('NaN')) AS DECIMAL(38,18)))".format
# Fact totals by foreign key; every statement looks names up afterwards.
_UNITS_BY = """
        WITH units AS (
          SELECT {keys}, {total} AS made FROM fact_production GROUP BY {keys})"""

SAMPLE_SQL: dict[str, str] = {
    "top_energy_machines": f"""
        WITH used AS (
          SELECT machine_id AS machine, {_TOTAL(c='energy_consumed_kwh')} AS kwh
          FROM fact_production GROUP BY machine_id),
        placed AS (
          SELECT mach.machine_id, mach.machine_name, site.plant_name, kwh
          FROM used, dim_machine AS mach, dim_plant AS site
          WHERE mach.machine_id = used.machine AND site.plant_id = mach.plant_id)
        SELECT machine_id, machine_name, plant_name, DOUBLE(ROUND(kwh, 1)) AS total_energy_kwh
        FROM placed
        ORDER BY 4 DESC, 1
        LIMIT 10""",
    "monthly_production_by_plant": _UNITS_BY.format(keys="plant_id, date_id", total=_TOTAL(c="produced_qty")) + """
        SELECT plant_name, year, month, DOUBLE(ROUND(SUM(made), 0)) AS total_produced
        FROM units JOIN dim_plant USING (plant_id) JOIN dim_date USING (date_id)
        GROUP BY ALL ORDER BY 1, 2, 3""",
    "oee_by_machine": f"""
        WITH ratios AS (
          SELECT machine_id,
                 1D - DOUBLE({_TOTAL(c='downtime_minutes')}) / COUNT(NULLIF(downtime_minutes, DOUBLE('NaN'))) / 480D
                   AS up,
                 DOUBLE({_TOTAL(c='1D - try_divide(DOUBLE(defective_qty), produced_qty)')})
                   / NULLIF(COUNT(try_divide(DOUBLE(defective_qty), produced_qty)), 0) AS good
          FROM fact_production GROUP BY machine_id)
        SELECT machine_id, machine_name, ROUND(up, 3) AS avg_availability, ROUND(good, 3) AS avg_quality,
               ROUND(up * good, 3) AS oee_proxy
        FROM ratios JOIN dim_machine USING (machine_id)
        ORDER BY oee_proxy NULLS FIRST, machine_id
        LIMIT 10""",
    "maintenance_cost_by_plant_type": f"""
        WITH visits AS (
          SELECT machine_id, maintenance_type, COUNT(*) AS events, {_TOTAL(c='cost_inr')} AS cost,
                 {_TOTAL(c='duration_minutes')} AS minutes,
                 COUNT(NULLIF(duration_minutes, DOUBLE('NaN'))) AS timed
          FROM fact_maintenance GROUP BY machine_id, maintenance_type)
        SELECT plant_name, maintenance_type, SUM(events) AS n_events,
               DOUBLE(ROUND(SUM(cost), 0)) AS total_cost_inr,
               ROUND(DOUBLE(SUM(minutes)) / SUM(timed), 0) AS avg_duration_minutes
        FROM visits JOIN dim_machine USING (machine_id) JOIN dim_plant USING (plant_id)
        GROUP BY plant_name, maintenance_type
        ORDER BY 4 DESC, 1, 2""",
    "failure_rate_by_machine_type": """
        WITH shifts AS (
          SELECT machine_id, COUNT(*) AS run, SUM(failure_event) AS failed
          FROM fact_production GROUP BY machine_id)
        SELECT machine_type, SUM(run) AS total_shifts, SUM(failed) AS failure_shifts,
               ROUND(100D * SUM(failed) / SUM(run), 2) AS failure_rate_pct
        FROM shifts JOIN dim_machine USING (machine_id)
        GROUP BY machine_type
        ORDER BY 4 DESC, 1""",
    "monthly_units_by_category": _UNITS_BY.format(keys="product_id, date_id", total=_TOTAL(c="produced_qty")) + """
        SELECT category, year, month, DOUBLE(ROUND(SUM(made), 0)) AS total_units_produced
        FROM units JOIN dim_product USING (product_id) JOIN dim_date USING (date_id)
        GROUP BY ALL ORDER BY 1, 2, 3""",
}


def register_views(star: Star, prefix: str = "") -> list[str]:
    """Register the seven tables as temp views ``<prefix><table>``."""
    names = []
    for name in star.tables():
        getattr(star, name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


# The dashboard's filters as named markers; a null leaves its filter out, an empty list selects nothing.
FILTERED_SQL: dict[str, str] = {
    "filtered_kpis": f"""
        WITH sites AS (
          SELECT plant_id FROM dim_plant
          WHERE CAST(:plants AS ARRAY<STRING>) IS NULL OR ARRAY_CONTAINS(CAST(:plants AS ARRAY<STRING>), plant_name)),
        kinds AS (
          SELECT machine_id FROM dim_machine
          WHERE CAST(:types AS ARRAY<STRING>) IS NULL OR ARRAY_CONTAINS(CAST(:types AS ARRAY<STRING>), machine_type)),
        chosen AS (
          SELECT * FROM fact_production LEFT SEMI JOIN sites USING (plant_id) LEFT SEMI JOIN kinds USING (machine_id)
          WHERE :first IS NULL OR :last IS NULL OR date_id BETWEEN :first AND :last)
        SELECT DOUBLE({_TOTAL(c='produced_qty')}) AS units_produced,
               try_divide(DOUBLE({_TOTAL(c='downtime_minutes')}), COUNT(NULLIF(downtime_minutes, DOUBLE('NaN'))))
                 AS avg_downtime_minutes,
               try_divide(DOUBLE(SUM(defective_qty)), DOUBLE({_TOTAL(c='produced_qty')})) * 100D AS defect_rate_pct,
               DOUBLE({_TOTAL(c='energy_consumed_kwh')}) AS total_energy_kwh, SUM(failure_event) AS failure_events
        FROM chosen""",
}


def filter_args(plants=None, machine_types=None, start=None, end=None) -> dict:
    """The markers of FILTERED_SQL. Values are passed, never pasted into the text."""
    lo, hi = date_bounds(start, end)
    names = lambda xs: None if xs is None else F.array(*[F.lit(x) for x in xs])
    day = lambda d: None if d is None else d.strftime("%Y%m%d")
    return {"plants": names(plants), "types": names(machine_types), "first": day(lo), "last": day(hi)}


def run_sql(spark: SparkSession, star: Star, sql: str, args: dict | None = None) -> DataFrame:
    """Plan SQL text against the star, with values for its named markers
    (``:name``). The returned DataFrame keeps the tables it was analysed
    against, even if the views are re-registered."""
    register_views(star)
    return spark.sql(sql, args=args) if args else spark.sql(sql)
