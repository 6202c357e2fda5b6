"""Stored risk models, read back by another session and applied.

The models are fixed, so an SQL engine can repeat their scores. Each query
encodes the features, stores encoding and model in a folder, loads that folder
in a new session, and scores the test rows with what it has read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.operators import evaluation
from shiftline.operators.boosting import Boosted
from shiftline.operators.linear import Linear
from shiftline.operators.star import Star
from shiftline.plans import risk
from shiftline.session import scratch_path
from shiftline.sources import warehouse

# Weights of a linear scorer by feature.
LINEAR_BASE = -1.5
LINEAR = {"planned_qty": -0.02, "prior_wear": 1.25, "prior_downtime_avg3": 0.005, "is_weekend": 0.3,
          "machine_type_TYPE_3": 0.5, "shift_id_S2": -0.25, "plant_id_P02": 0.125}

# Small trees; a node is (feature, threshold, yes, no), a leaf its value.
TREES_BASE, TREES_RATE = -0.25, 0.5
TREES = [
    [("prior_wear", 0.35, 1, 2), ("prior_downtime_avg3", 200.0, 3, 4), ("machine_type_TYPE_3", 0.5, 5, 6),
     -0.75, 0.25, 0.5, 1.5],
    [("planned_qty", 25.0, 1, 2), -0.5, ("shift_id_S3", 0.5, 3, 4), 0.125, ("prior_wear", 0.6, 5, 6), 0.75, 1.25],
    [("plant_id_P04", 0.5, 1, 2), ("is_weekend", 0.5, 3, 4), ("base_energy_kwh_per_hour", 6.0, 5, 6),
     -0.25, 0.5, -1.0, 1.0],
]


def _linear(features: list[str]) -> Linear:
    return Linear(LINEAR_BASE, {features.index(n): w for n, w in LINEAR.items() if n in features})


def _trees(features: list[str]) -> Boosted:
    """The trees by feature number; a level that the data does not have is 0 throughout, so its node says yes."""
    def node(k, n):
        if not isinstance(n, tuple):
            return k, None, None, None, None, n
        known = n[0] in features
        return k, features.index(n[0] if known else features[0]), n[1] if known else float("inf"), n[2], n[3], None
    return Boosted(TREES_BASE, TREES_RATE, [[node(k, n) for k, n in enumerate(tree)] for tree in TREES])


def _scored(star: Star, make) -> DataFrame:
    """Test rows scored by the model that ``make`` gives, after it was stored and read back."""
    spark = star.fact_production.sparkSession
    rows = risk.split_features(star)
    encoding = risk.fit_encoding(risk.category_columns(star))
    path = scratch_path(spark, f"models/{uuid.uuid4().hex}")
    warehouse.save_model(risk.RiskModel(encoding, make(encoding.features)), path, spark)
    model, _ = warehouse.load_model(spark.newSession(), path)
    scored = model.transform(rows.where(F.col("is_test") == 1))
    return scored.select(*risk.KEYS, risk.LABEL, F.round("p_failure", 9).alias("p_failure"),
                         F.col("prediction").cast("int").alias("prediction"))


def linear_scores(star: Star) -> DataFrame:
    return _scored(star, _linear)


def tree_scores(star: Star) -> DataFrame:
    return _scored(star, _trees)


def tree_report(star: Star) -> DataFrame:
    """M7 of the stored trees."""
    return evaluation.classification_report(tree_scores(star), risk.LABEL, "prediction", risk.TARGET_NAMES)
