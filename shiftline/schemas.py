"""Fixed schemas of the seven star tables (explicit; never inferred).

Keys and dates stay strings where the warehouse stores them as text
(``date_id`` is ``yyyyMMdd``); measures are doubles; flags are 0/1 ints.
"""

from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _st(*fields, not_null=()):
    return T.StructType([T.StructField(n, t, n not in not_null) for n, t in fields])


DIM_PLANT = _st(("plant_id", S), ("plant_name", S), ("city", S), ("state", S), ("plant_type", S))

DIM_MACHINE = _st(("machine_id", S), ("plant_id", S), ("machine_name", S), ("machine_type", S),
                  ("install_date", T.DateType()), ("rated_capacity_units_per_hour", D),
                  ("base_energy_kwh_per_hour", D))

DIM_SHIFT = _st(("shift_id", S), ("shift_name", S), ("start_time", S), ("end_time", S))

DIM_PRODUCT = _st(("product_id", S), ("product_name", S), ("category", S), ("uom", S))

DIM_DATE = _st(("date_id", S), ("date", T.DateType()), ("year", I), ("quarter", I), ("month", I),
               ("day", I), ("day_of_week", S), ("is_weekend", I))

FACT_PRODUCTION = _st(("record_id", L), ("date_id", S), ("plant_id", S), ("machine_id", S),
                      ("shift_id", S), ("product_id", S), ("planned_qty", D), ("produced_qty", D),
                      ("defective_qty", I), ("downtime_minutes", D), ("energy_consumed_kwh", D),
                      ("failure_event", I), ("machine_wear_index", D))

FACT_MAINTENANCE = _st(("maintenance_id", S), ("machine_id", S), ("date_id", S),
                       ("maintenance_type", S), ("duration_minutes", D), ("cost_inr", D),
                       ("technician_team", S))

# CSV layouts as files carry them: dim_date has ``date`` first and a
# True/False weekend flag; production carries failure_event as True/False.
CSV_DIM_DATE = _st(("date", S), ("date_id", S), ("year", I), ("quarter", I), ("month", I),
                   ("day", I), ("day_of_week", S), ("is_weekend", S))
CSV_DIM_MACHINE = _st(("machine_id", S), ("plant_id", S), ("machine_name", S), ("machine_type", S),
                      ("install_date", S), ("rated_capacity_units_per_hour", D),
                      ("base_energy_kwh_per_hour", D))
CSV_FACT_PRODUCTION = _st(("record_id", L), ("date_id", S), ("plant_id", S), ("machine_id", S),
                          ("shift_id", S), ("product_id", S), ("planned_qty", D), ("produced_qty", D),
                          ("defective_qty", D), ("downtime_minutes", D), ("energy_consumed_kwh", D),
                          ("failure_event", S), ("machine_wear_index", D))

TABLES = {
    "dim_plant": DIM_PLANT,
    "dim_machine": DIM_MACHINE,
    "dim_shift": DIM_SHIFT,
    "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE,
    "fact_production": FACT_PRODUCTION,
    "fact_maintenance": FACT_MAINTENANCE,
}

CSV_TABLES = dict(TABLES, dim_date=CSV_DIM_DATE, dim_machine=CSV_DIM_MACHINE,
                  fact_production=CSV_FACT_PRODUCTION)

# Primary key and NOT NULL columns of the warehouse DDL.
PRIMARY_KEYS = {
    "dim_plant": "plant_id",
    "dim_machine": "machine_id",
    "dim_shift": "shift_id",
    "dim_product": "product_id",
    "dim_date": "date_id",
    "fact_production": "record_id",
    "fact_maintenance": "maintenance_id",
}

NOT_NULL = {
    "dim_plant": ["plant_name"],
    "dim_machine": ["plant_id", "machine_name"],
    "dim_shift": ["shift_name"],
    "dim_product": ["product_name"],
    "dim_date": ["date"],
    "fact_production": ["date_id", "plant_id", "machine_id", "shift_id", "product_id"],
    "fact_maintenance": ["machine_id", "date_id"],
}

# Foreign keys: (table, column) -> (dimension, key)
FOREIGN_KEYS = {
    "fact_production": [("plant_id", "dim_plant"), ("machine_id", "dim_machine"),
                        ("shift_id", "dim_shift"), ("product_id", "dim_product"),
                        ("date_id", "dim_date")],
    "fact_maintenance": [("machine_id", "dim_machine"), ("date_id", "dim_date")],
    "dim_machine": [("plant_id", "dim_plant")],
}
