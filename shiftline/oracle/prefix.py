"""Fixture mapping + cleaning as DuckDB CTEs (see FIXTURES.md §2–§3)."""

PREFIX = r"""
WITH
dim_plant AS (
  SELECT 'P' || lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') AS plant_id,
         r_name AS plant_name, r_name AS city, r_name AS state,
         'Regional Plant' AS plant_type
  FROM region
),
dim_machine AS (
  SELECT 'M' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 6, '0') AS machine_id,
         'P' || lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') AS plant_id,
         'TYPE_' || CAST(s_suppkey % 8 AS VARCHAR) || ' #' || CAST(s_suppkey % 8 + 1 AS VARCHAR) AS machine_name,
         'TYPE_' || CAST(s_suppkey % 8 AS VARCHAR) AS machine_type,
         DATE '1985-01-01' + CAST((s_suppkey * 37) % 3000 AS INTEGER) AS install_date,
         CAST(25 + s_suppkey % 76 AS DOUBLE) AS rated_capacity_units_per_hour,
         CAST(29 + s_suppkey % 64 AS DOUBLE) / 10 AS base_energy_kwh_per_hour
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE s_acctbal >= 0
),
dim_shift AS (
  SELECT * FROM (VALUES ('S1', 'Morning', '06:00', '14:00'),
                        ('S2', 'Afternoon', '14:00', '22:00'),
                        ('S3', 'Night', '22:00', '06:00')) t(shift_id, shift_name, start_time, end_time)
  WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_linenumber <> 7 AND 'S' || (l_linenumber % 3 + 1) = shift_id)
),
dim_product AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         p_type AS category, 'Units' AS uom
  FROM part WHERE p_size <= 48
),
dim_date AS (
  SELECT strftime(d, '%Y%m%d') AS date_id, d AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
         dayname(d) AS day_of_week, CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
),
prod_rows AS (
  SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) * 100000000
           + CAST(round(l_extendedprice * 100) AS BIGINT) AS record_id,
         strftime(l_shipdate, '%Y%m%d') AS date_id,
         'P' || lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') AS plant_id,
         'M' || lpad(CAST(l_suppkey + 1 AS VARCHAR), 6, '0') AS machine_id,
         CASE WHEN l_linenumber = 7 THEN 'S4' ELSE 'S' || CAST(l_linenumber % 3 + 1 AS VARCHAR) END AS shift_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         l_quantity AS planned_qty,
         l_quantity - 2 AS produced_qty,
         CAST(round(l_tax * 100) AS INTEGER) AS defective_qty,
         CAST(floor(round(l_extendedprice * 100) / 2000) AS DOUBLE) / 10 AS downtime_minutes,
         CAST(floor(round(l_extendedprice * 100) * (100 - round(l_discount * 100)) / 10000) AS DOUBLE) / 100
           AS energy_consumed_kwh,
         CASE WHEN l_returnflag = 'R' AND round(l_tax * 100) = 8 THEN 1 ELSE 0 END AS failure_event,
         round(l_discount * 100) / 100 * 8 AS machine_wear_index
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
raw_production AS (
  SELECT record_id, date_id, plant_id, machine_id, shift_id, product_id, planned_qty, produced_qty,
         defective_qty, downtime_minutes, energy_consumed_kwh, failure_event, machine_wear_index
  FROM (SELECT *, row_number() OVER (
          PARTITION BY machine_id, date_id, shift_id
          ORDER BY record_id, product_id, downtime_minutes, energy_consumed_kwh, planned_qty,
                   plant_id, produced_qty, defective_qty, failure_event, machine_wear_index) AS rn
        FROM prod_rows)
  WHERE rn = 1
),
flagged_production AS (
  SELECT r.*,
         CASE
           WHEN r.plant_id NOT IN (SELECT plant_id FROM dim_plant) OR r.plant_id IS NULL THEN 'orphan_plant'
           WHEN r.machine_id NOT IN (SELECT machine_id FROM dim_machine) OR r.machine_id IS NULL THEN 'orphan_machine'
           WHEN r.shift_id NOT IN (SELECT shift_id FROM dim_shift) OR r.shift_id IS NULL THEN 'orphan_shift'
           WHEN r.product_id NOT IN (SELECT product_id FROM dim_product) OR r.product_id IS NULL THEN 'orphan_product'
           WHEN r.date_id NOT IN (SELECT date_id FROM dim_date) OR r.date_id IS NULL THEN 'orphan_date'
           WHEN NOT coalesce(r.produced_qty >= 0 AND NOT isnan(r.produced_qty), false) THEN 'negative_produced'
           WHEN NOT coalesce(r.defective_qty >= 0, false) THEN 'negative_defective'
           WHEN NOT coalesce(r.downtime_minutes BETWEEN 0 AND 480 AND NOT isnan(r.downtime_minutes), false)
             THEN 'downtime_out_of_range'
           WHEN NOT coalesce(r.energy_consumed_kwh >= 0 AND NOT isnan(r.energy_consumed_kwh), false)
             THEN 'negative_energy'
         END AS reject_reason
  FROM raw_production r
),
fact_production AS (
  SELECT record_id, date_id, plant_id, machine_id, shift_id, product_id, planned_qty, produced_qty,
         CAST(round_even(least(CAST(defective_qty AS DOUBLE), produced_qty), 0) AS INTEGER) AS defective_qty,
         downtime_minutes, energy_consumed_kwh, failure_event, machine_wear_index
  FROM flagged_production WHERE reject_reason IS NULL
),
raw_maintenance AS (
  SELECT 'MT' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS maintenance_id,
         'M' || lpad(CAST(o_custkey % (SELECT count(*) FROM supplier) + 1 AS VARCHAR), 6, '0') AS machine_id,
         strftime(o_orderdate, '%Y%m%d') AS date_id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Corrective' ELSE 'Preventive' END
           AS maintenance_type,
         CAST(60 + o_orderkey % 301 AS DOUBLE) AS duration_minutes,
         o_totalprice AS cost_inr,
         'Team ' || o_orderstatus AS technician_team
  FROM orders
),
flagged_maintenance AS (
  SELECT r.*,
         CASE
           WHEN r.machine_id NOT IN (SELECT machine_id FROM dim_machine) OR r.machine_id IS NULL THEN 'orphan_machine'
           WHEN r.date_id NOT IN (SELECT date_id FROM dim_date) OR r.date_id IS NULL THEN 'orphan_date'
         END AS reject_reason
  FROM raw_maintenance r
),
fact_maintenance AS (
  SELECT maintenance_id, machine_id, date_id, maintenance_type, duration_minutes, cost_inr, technician_team
  FROM flagged_maintenance WHERE reject_reason IS NULL
)
"""
