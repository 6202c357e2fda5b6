"""Projection of the driver's TPC-H-style tables onto the seven star tables.

The engine never sees this module: it only gets star-schema DataFrames.
This mapping is the test fixture described in FIXTURES.md §2. Every column
is one built-in expression, so the whole mapping is a lazy plan that
Catalyst prunes and pushes filters into.

Orphans are intentional: suppliers with a negative balance are not
machines, parts with size > 48 are not products, line number 7 maps to an
unknown shift S4, and some order dates fall outside the ship-date calendar.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.functions.scalar import date_key, day_name, padded_id, weekend_flag
from shiftline.sources.literals import SHIFTS


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plant_id(regionkey) -> F.Column:
    return padded_id("P", F.col(regionkey) + 1, 2)


def _machine_id(n) -> F.Column:
    return padded_id("M", n + 1, 6)


def _cents(c) -> F.Column:
    return F.round(F.col(c) * 100)


def _record_id() -> F.Column:
    """Order and line repeat in the driver's tables; with the price they seldom do (``registry.REPORTED``).

    Orders from 11.5 billion on do not fit with line and price into 64 bits:
    their id is a hash, and negative, so never that of a smaller order.
    """
    parts = [F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("bigint"),
             _cents("l_extendedprice").cast("bigint")]
    order, line, cents = parts
    packed = F.try_add(F.try_multiply(F.try_add(F.try_multiply(order, F.lit(8)), line), F.lit(100_000_000)), cents)
    hashed = F.xxhash64(*parts).bitwiseOR(F.lit(-1 << 63))
    known = order.isNotNull() & line.isNotNull() & cents.isNotNull()
    return F.coalesce(packed, F.when(known, hashed)).cast("bigint")


# A slot's first row is the smallest full tuple: a total order but for equal rows.
SLOT_ORDER = ["record_id", "product_id", "downtime_minutes", "energy_consumed_kwh", "planned_qty",
              "plant_id", "produced_qty", "defective_qty", "failure_event", "machine_wear_index"]


@dataclass
class RawStar:
    """Dimensions and raw (uncleaned) facts as produced by the source system."""
    dim_plant: DataFrame
    dim_machine: DataFrame
    dim_shift: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    raw_production: DataFrame
    raw_maintenance: DataFrame
    slot_order: list[str] | None = None


def raw_dim_plant(spark, sf_dir) -> DataFrame:
    r = _read(spark, sf_dir, "region")
    return r.select(_plant_id("r_regionkey").alias("plant_id"),
                    F.col("r_name").alias("plant_name"),
                    F.col("r_name").alias("city"),
                    F.col("r_name").alias("state"),
                    F.lit("Regional Plant").alias("plant_type"))


def raw_dim_machine(spark, sf_dir) -> DataFrame:
    s = _read(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
    n = _read(spark, sf_dir, "nation")
    k = F.col("s_suppkey")
    mtype = F.concat(F.lit("TYPE_"), (k % 8).cast("string"))
    return (s.join(n, s.s_nationkey == n.n_nationkey)
            .select(_machine_id(k).alias("machine_id"),
                    _plant_id("n_regionkey").alias("plant_id"),
                    F.concat(mtype, F.lit(" #"), (k % 8 + 1).cast("string")).alias("machine_name"),
                    mtype.alias("machine_type"),
                    F.date_add(F.lit("1985-01-01").cast("date"), ((k * 37) % 3000).cast("int"))
                    .alias("install_date"),
                    (F.lit(25) + k % 76).cast("double").alias("rated_capacity_units_per_hour"),
                    ((F.lit(29) + k % 64).cast("double") / 10).alias("base_energy_kwh_per_hour")))


def _shift_id() -> F.Column:
    return (F.when(F.col("l_linenumber") == 7, F.lit("S4"))
            .otherwise(F.concat(F.lit("S"), (F.col("l_linenumber") % 3 + 1).cast("string"))))


def raw_dim_shift(spark, sf_dir) -> DataFrame:
    """The shifts that occur in the line items and have a name: S1 to S3."""
    used = _read(spark, sf_dir, "lineitem").select(_shift_id().alias("shift_id")).distinct()
    columns = ["shift_name", "start_time", "end_time"]
    named = [F.create_map(*[F.lit(v) for s in SHIFTS for v in (s[0], s[k])])[F.col("shift_id")].alias(c)
             for k, c in enumerate(columns, 1)]
    return used.where(F.col("shift_id").isin([s[0] for s in SHIFTS])).select("shift_id", *named)


def raw_dim_product(spark, sf_dir) -> DataFrame:
    p = _read(spark, sf_dir, "part").where(F.col("p_size") <= 48)
    return p.select(F.col("p_partkey").cast("string").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"),
                    F.lit("Units").alias("uom"))


def raw_dim_date(spark, sf_dir) -> DataFrame:
    d = (_read(spark, sf_dir, "lineitem")
         .select(F.col("l_shipdate").cast("date").alias("date")).distinct())
    return d.select(date_key("date").alias("date_id"), "date",
                    F.year("date").alias("year"), F.quarter("date").alias("quarter"),
                    F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
                    day_name("date").alias("day_of_week"),
                    weekend_flag("date").alias("is_weekend"))


def raw_production(spark, sf_dir) -> DataFrame:
    """One row per line item. Several may land on one (machine, date, shift)
    slot; validation keeps the first by ``SLOT_ORDER`` and rejects the rest."""
    li = _read(spark, sf_dir, "lineitem")
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    tax = _cents("l_tax")
    return (li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == n.n_nationkey)
            .select(_record_id().alias("record_id"),
                    date_key("l_shipdate").alias("date_id"),
                    _plant_id("n_regionkey").alias("plant_id"),
                    _machine_id(F.col("l_suppkey")).alias("machine_id"),
                    _shift_id().alias("shift_id"),
                    F.col("l_partkey").cast("string").alias("product_id"),
                    F.col("l_quantity").alias("planned_qty"),
                    (F.col("l_quantity") - 2).alias("produced_qty"),
                    tax.cast("int").alias("defective_qty"),
                    (F.floor(_cents("l_extendedprice") / 2000).cast("double") / 10)
                    .alias("downtime_minutes"),
                    (F.floor(_cents("l_extendedprice") * (100 - _cents("l_discount")) / 10000)
                     .cast("double") / 100).alias("energy_consumed_kwh"),
                    F.when((F.col("l_returnflag") == "R") & (tax == 8), 1).otherwise(0)
                    .alias("failure_event"),
                    (_cents("l_discount") / 100 * 8).alias("machine_wear_index")))


def raw_maintenance(spark, sf_dir) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    n_machines = _read(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    return o.select(padded_id("MT", F.col("o_orderkey"), 9).alias("maintenance_id"),
                    _machine_id(F.col("o_custkey") % n_machines).alias("machine_id"),
                    date_key("o_orderdate").alias("date_id"),
                    F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Corrective")
                    .otherwise("Preventive").alias("maintenance_type"),
                    (F.lit(60) + F.col("o_orderkey") % 301).cast("double").alias("duration_minutes"),
                    F.col("o_totalprice").alias("cost_inr"),
                    F.concat(F.lit("Team "), F.col("o_orderstatus")).alias("technician_team"))


def load_raw(spark: SparkSession, sf_dir: str) -> RawStar:
    return RawStar(
        dim_plant=raw_dim_plant(spark, sf_dir),
        dim_machine=raw_dim_machine(spark, sf_dir),
        dim_shift=raw_dim_shift(spark, sf_dir),
        dim_product=raw_dim_product(spark, sf_dir),
        dim_date=raw_dim_date(spark, sf_dir),
        raw_production=raw_production(spark, sf_dir),
        raw_maintenance=raw_maintenance(spark, sf_dir),
        slot_order=SLOT_ORDER,
    )
