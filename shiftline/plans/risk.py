"""Failure-risk model on Spark ML.

Features use only what is known before a shift starts: planned quantity,
the previous shift's wear, the mean downtime of the previous three shifts,
machine ratings, the weekend flag and one-hot machine type / shift / plant
(first alphabetical level dropped). The current shift's downtime and
defects are consequences of a failure, so they are never features.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftline.operators import boosting, evaluation, linear, permutation, ranking, windows
from shiftline.operators.star import Star
from shiftline.session import checkpoint_dir, shuffles_deleted

KEYS = ["machine_id", "date_id", "shift_id"]
LABEL = "failure_event"
# The report's class names.
TARGET_NAMES = ("No failure", "Failure")
# The model's columns.
NUMERIC = ["planned_qty", "prior_wear", "prior_downtime_avg3", "rated_capacity_units_per_hour",
           "base_energy_kwh_per_hour", "is_weekend"]
CATEGORICAL = ["machine_type", "shift_id", "plant_id"]
SEED = 42


def failure_features(star: Star) -> DataFrame:
    """M1: J7 (production ⋈ machine ⋈ date) + W2 + W3, one row per shift."""
    machine = star.dim("dim_machine", "machine_id", "machine_type", "rated_capacity_units_per_hour",
                       "base_energy_kwh_per_hour")
    f = windows.prior_features(star.fact_production, attach=(
        (machine, "machine_id"), (star.dim("dim_date", "date_id", "is_weekend"), "date_id")))
    return f.select(*KEYS, "record_id", "plant_id", *NUMERIC, "machine_type", LABEL)


@dataclass
class Encoding:
    """M2 as a fitted pipeline: sparse indicators of every level but the first, after the numbers.

    The plan has one column however many levels there are; names are the
    levels, bounded by the columns' cardinality.
    """
    model: PipelineModel
    features: list[str]
    #: Number of indicators of each column that has some, in the order of ``features``.
    groups: list[int] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features``, a sparse vector."""
        out = self.model.transform(df)
        return out.select(*df.columns, "features")

    def wide(self, df: DataFrame) -> DataFrame:
        """``df`` with a column for each feature, instead of the numbers as they were."""
        x = F.col("_x")
        kept = [c for c in df.columns if c not in self.features]
        return df.withColumn("_x", vector_to_array("features")).select(
            *kept, *[x[k].alias(n) for k, n in enumerate(self.features)])


def category_columns(star: Star) -> DataFrame:
    """The model's numbers and categories as far as an encoding is fitted on them, without the history windows."""
    made = star.fact_production.select("machine_id", "shift_id", "plant_id")
    typed = made.distinct().join(star.dim("dim_machine", "machine_id", "machine_type"), "machine_id")
    return typed.select(*CATEGORICAL, *[F.lit(0.0).alias(c) for c in NUMERIC])


def fit_encoding(df: DataFrame, numeric=NUMERIC, categorical=CATEGORICAL) -> Encoding:
    """M2: indicators ``<col>_<level>`` for every level but the first alphabetical one.

    Levels are indexed in descending order and the last index is dropped. One
    job reads the categorical columns alone. A level that was not there, or a
    null, is an error when the pipeline is applied.
    """
    numeric, categorical = list(numeric), list(categorical)
    at, hot = [f"{c}__at" for c in categorical], [f"{c}__hot" for c in categorical]
    indexer = StringIndexer(inputCols=categorical, outputCols=at, stringOrderType="alphabetDesc").fit(
        df.select(*categorical))
    # A column with one level has no indicator.
    levels = [list(x) for x in indexer.labelsArray]
    used = [k for k, x in enumerate(levels) if len(x) > 1]
    encoder = OneHotEncoder(inputCols=[at[k] for k in used], outputCols=[hot[k] for k in used], dropLast=True)
    assembler = VectorAssembler(inputCols=numeric + [hot[k] for k in used], outputCol="features")
    indexed = indexer.transform(df.select(*numeric, *categorical))
    stages = [indexer, *([encoder.fit(indexed)] if used else []), assembler]
    names = numeric + [f"{categorical[k]}_{lv}" for k in used for lv in levels[k][:-1]]
    return Encoding(PipelineModel(stages=stages), names, [len(levels[k]) - 1 for k in used])


def one_hot_features(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """M2 as columns (pandas ``get_dummies(drop_first=True)``). Returns (frame, feature names)."""
    encoding = fit_encoding(df)
    # Levels are listed in ascending order, the vector has them in descending order.
    names = [n for n in encoding.features if n in NUMERIC]
    for column, levels in zip(CATEGORICAL, encoding.model.stages[0].labelsArray):
        names += [f"{column}_{lv}" for lv in reversed(levels[:-1])]
    kept = [c for c in df.columns if c not in names]
    return encoding.wide(encoding.transform(df)).select(*kept, *[F.col(f"`{n}`") for n in names]), names


def split(df: DataFrame, test_percent: int = 20, seed: int = SEED, by_time: bool = False,
          keys: DataFrame | None = None) -> DataFrame:
    """M3: exact stratified split on the label (``is_test`` 0/1).

    ``keys``: the fact that ``df`` has a row for each row of; the split is then
    decided on its narrow columns, below the windows of ``df``.

    Default: random, as the reference does (neighbouring shifts of one
    machine land on both sides, quirk K9). ``by_time=True`` holds out the
    latest shifts of each class instead.
    """
    if by_time:
        return ranking.time_split(df, LABEL, ["date_id", "shift_id", "machine_id"], test_percent, keys=keys)
    return ranking.stratified_split(df, LABEL, KEYS, test_percent=test_percent, seed=seed, keys=keys)


def split_features(star: Star, **how) -> DataFrame:
    """M1 + M3: every shift's features with ``is_test``."""
    return split(failure_features(star), keys=star.fact_production, **how)


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """M4: balanced weights n / (k · n_c) per class (k = number of classes)."""
    c = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    tot = train.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(label).alias("k"))
    return c.select(label, "n_rows",
                    (tot.select("n").scalar().cast("double")
                     / (tot.select("k").scalar() * F.col("n_rows"))).alias("weight"))


def with_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Each training row with its class's weight: one small aggregate, then a literal per class."""
    chosen = F.lit(None).cast("double")
    for r in class_weights(train, label).collect():      # one row per class
        chosen = F.when(F.col(label) == r[label], F.lit(r.weight)).otherwise(chosen)
    return train.withColumn("weight", chosen)


@dataclass
class RiskModel:
    """M6: the encoding and the scorer; all that is stored of a fitted model."""
    encoding: Encoding
    scorer: boosting.Boosted | linear.Linear

    @property
    def features(self) -> list[str]:
        return self.encoding.features

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with p_failure and prediction (1 from 0.5 on)."""
        encoded = df if "features" in df.columns else self.encoding.transform(df)
        p = self.scorer.probability(boosting.as_array())
        return encoded.withColumn("p_failure", p).withColumn("prediction", (F.col("p_failure") >= 0.5).cast("double"))


@dataclass
class FittedRisk:
    model: RiskModel
    #: Rows with their keys, categories, label and sparse ``features``.
    train: DataFrame
    test_rows: DataFrame

    @property
    def features(self) -> list[str]:
        return self.model.features

    @property
    def test(self) -> DataFrame:
        """The test rows with a column for each feature too."""
        return self.model.encoding.wide(self.test_rows)


def fit_failure_model(star: Star, max_iter: int = 200, step: float = 0.08, depth: int = 6,
                      validation_percent: int = 10, patience: int = 10, min_gain: float = 1e-7,
                      min_leaf: int = 20, max_bins: int = 255, seed: int = SEED,
                      split_by_time: bool = False) -> FittedRisk:
    """M5: boosted trees with the reference's settings (200 rounds, rate
    0.08, depth 6, balanced class weights, seed 42) and its early stopping: a
    fit ends once ``patience`` rounds have not lowered the loss on a
    stratified 10 % validation slice of the training rows by ``min_gain``,
    and keeps the rounds up to there. Each round is fitted once (``boosting``).
    ``split_by_time`` holds out the latest shifts instead of random ones (K9).

    The split feature table is written to the shared checkpoint folder
    first, so the iterative fit and all later scoring read a short lineage
    and survive executor loss.
    """
    spark = star.fact_production.sparkSession
    checkpoint_dir(spark)
    with shuffles_deleted(spark):
        rows = split_features(star, by_time=split_by_time).checkpoint(eager=True)
    encoding = fit_encoding(rows)
    data = encoding.transform(rows)
    train = data.where(F.col("is_test") == 0).drop("is_test")
    test = data.where(F.col("is_test") == 1).drop("is_test")
    learn = ranking.stratified_split(train.select(*KEYS, LABEL, "features"), LABEL, KEYS,
                                     test_percent=validation_percent, seed=seed + 1, out="is_validation")
    boosted = boosting.fit(with_weights(learn), LABEL, "weight", "is_validation", max_iter, step, depth, min_leaf,
                           max_bins, patience, min_gain, numbers=len(NUMERIC), groups=encoding.groups)
    return FittedRisk(RiskModel(encoding, boosted), train, test)


stop_round = boosting.stop_round


def score(fitted: FittedRisk, df: DataFrame | None = None) -> DataFrame:
    """M6: predicted class and probability of failure."""
    return fitted.model.transform(fitted.test_rows if df is None else df).drop("features")


def model_summary(fitted: FittedRisk) -> DataFrame:
    """One row: training/test sizes, trees kept, test accuracy and ROC-AUC."""
    s = score(fitted)
    auc = evaluation.roc_auc(s, LABEL, "p_failure").select("roc_auc")
    acc = s.agg(F.avg((F.col("prediction") == F.col(LABEL)).cast("double")).alias("accuracy"),
                F.count(F.lit(1)).alias("n_test"))
    return (acc.select("n_test", "accuracy", auc.scalar().alias("roc_auc"),
                       fitted.train.select(F.count(F.lit(1))).scalar().alias("n_train"))
            .withColumn("n_trees", F.lit(len(fitted.model.scorer.trees))))


def _metric(name: str, tp: F.Column | None = None, fp: F.Column | None = None, fn: F.Column | None = None,
            rows: F.Column | None = None) -> F.Column:
    """Classification metric (class 1 = failure) of a scored group, or of the given counts."""
    if tp is None:
        y, p = F.col(LABEL) == 1, F.col("prediction") == 1
        right = F.avg((F.col("prediction") == F.col(LABEL)).cast("double"))
        tp, predicted, actual = F.count(F.when(y & p, 1)), F.count(F.when(p, 1)), F.count(F.when(y, 1))
    else:
        right, predicted, actual = (rows - fp - fn).cast("double") / rows, tp + fp, tp + fn
    if name == "accuracy":
        return right
    prec = F.coalesce(F.try_divide(tp.cast("double"), predicted), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp.cast("double"), actual), F.lit(0.0))
    if name == "precision":
        return prec
    if name == "recall":
        return rec
    if name == "f1":
        return F.coalesce(F.try_divide(2.0 * prec * rec, prec + rec), F.lit(0.0))
    raise ValueError(f"unknown metric {name!r}")


def permutation_importance(fitted: FittedRisk, repeats: int = 5, seed: int = SEED,
                           features: list[str] | None = None, metric: str = "accuracy") -> DataFrame:
    """M9 of the fitted model on its test rows; see ``importance``.

    A feature that no tree tests changes no prediction, so its importance is
    0 and its values are not shuffled. Of the others, a row carries how many of
    the trees' thresholds its value exceeds, which is all that the trees see of it.
    """
    names = features or fitted.features
    boosted, spark = fitted.model.scorer, fitted.test_rows.sparkSession
    used = [fitted.features[f] for f in boosted.used()]
    read = [n for n in names if n in used]
    _metric(metric)
    order = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "at int, feature string")
    if not read:
        return order.orderBy("at").select("feature", F.lit(0.0).alias("importance_mean"), F.lit(0.0).alias("importance_std"))
    classes = boosting.exchanges(boosted)
    if classes is None:
        test = fitted.test_rows.select(*KEYS, LABEL, *[
            boosting.as_array()[fitted.features.index(n)].alias(n) for n in used])
        walk = boosting.evaluator(boosted)
        predict = lambda df: df.withColumn("prediction", (walk(F.array(
            *[F.col(f"`{n}`").cast("double") for n in used])) >= 0.5).cast("double"))
        found = importance(test, predict, read, repeats, seed, metric)
    else:
        found = _tree_importance(fitted, classes, used, read, repeats, seed, metric)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return order.join(found, "feature", "left").orderBy("at").select("feature", zero("importance_mean"), zero("importance_std"))


def _tree_importance(fitted: FittedRisk, classes, used: list[str], features: list[str], repeats: int, seed: int,
                     metric: str) -> DataFrame:
    """``importance`` of trees: tasks count the classes of their rows for every feature, so no shuffled row is made."""
    test = boosting.coded(fitted.test_rows, [*KEYS, LABEL], fitted.model.scorer, fitted.features)
    label, place = LABEL, {k: used.index(f) for k, f in enumerate(features)}

    def tally(repeat, rows, values, step=4096):
        import numpy as np
        import pyarrow as pa
        y = rows.column(label).to_numpy() == 1
        codes = [rows.column(f).to_numpy().astype(np.int64) for f in used]
        counts = {k: np.zeros(4, np.int64) for k in (-1, *values)}
        for at in range(0, len(y), step):
            some = slice(at, at + step)
            plain, changed = classes([c[some] for c in codes], {place[k]: v[some].astype(np.int64) for k, (v, _) in values.items()})
            for k in counts:
                counts[k] += np.bincount(2 * y[some] + (plain if k < 0 else changed[place[k]]), minlength=4)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), *[
            pa.array([int(c[j]) for c in counts.values()], pa.int64()) for j in range(4)]], names=["fi", "n00", "n01", "n10", "n11"])

    found, base = [], None
    for repeat, frame in permutation.shuffled(test, _row_key(), features, repeats, seed, tally,
                                              "fi int, n00 long, n01 long, n10 long, n11 long"):
        sums = frame.groupBy("fi").agg(*[F.sum(c).alias(c) for c in ("n00", "n01", "n10", "n11")])
        rows = F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")
        for fi, m in sums.select("fi", _metric(metric, F.col("n11"), F.col("n01"), F.col("n10"), rows)).collect():
            base, found = (m, found) if fi < 0 else (base, [*found, (fi, repeat, m)])
    return _drops(fitted.test_rows.sparkSession, features, found, base)


def _row_key() -> F.Column:
    return F.concat_ws("|", *KEYS)


def importance(test: DataFrame, predict, features: list[str], repeats: int = 5, seed: int = SEED,
               metric: str = "accuracy") -> DataFrame:
    """M9: mean and std of the drop in ``metric`` (accuracy by default; also
    precision / recall / f1 of class 1) when one feature is shuffled across
    the test rows, per feature over ``repeats`` shuffles.

    Every (feature, repeat) has an order of its own: the value of the row at
    place p of that order (md5 of seed, repeat, feature and keys) goes to the
    row at place p of the plain order (md5 of seed and keys); see
    ``permutation``. The test rows are written once and multiplied only where
    the values have come to their places.
    """
    types, spark = dict(test.dtypes), test.sparkSession
    names = test.columns
    _metric(metric)

    def tally(repeat, rows, values):
        import numpy as np
        import pyarrow as pa
        for k, (v, null) in [*([(-1, (np.zeros(rows.num_rows), np.ones(rows.num_rows, bool)))] if not repeat else []), *values.items()]:
            out = pa.table([*rows.columns, pa.array(np.full(rows.num_rows, k), pa.int32()), pa.array(v.astype("f8"), mask=null)],
                           names=[*names, "fi", "v"])
            yield from out.to_batches()

    schema = T.StructType([*test.schema.fields, T.StructField("fi", T.IntegerType()), T.StructField("v", T.DoubleType())])
    found, base = [], None
    for repeat, given in permutation.shuffled(test, _row_key(), features, repeats, seed, tally, schema):
        for k, f in enumerate(features):
            given = given.withColumn(f, F.when(F.col("fi") == k, F.col("v").cast(types[f])).otherwise(F.col(f"`{f}`")))
        for fi, m in predict(given.drop("v")).groupBy("fi").agg(_metric(metric)).collect():
            base, found = (m, found) if fi < 0 else (base, [*found, (fi, repeat, m)])
    return _drops(spark, features, found, base)


def _drops(spark: SparkSession, features: list[str], found: list[tuple[int, int, float]], base: float | None) -> DataFrame:
    """Mean and std over the repeats of what each feature's metric lacks of ``base``; a row for each feature."""
    names = F.array(*[F.lit(f) for f in features])
    per = spark.createDataFrame(sorted(found, key=lambda r: r[:2]), "fi int, repeat int, m double").coalesce(1)
    drop = per.select("fi", (F.lit(base).cast("double") - F.col("m")).alias("d"))
    out = drop.groupBy("fi").agg(F.avg("d").alias("importance_mean"), F.stddev_pop("d").alias("importance_std"))
    return out.select(F.get(names, F.col("fi")).alias("feature"), "importance_mean", "importance_std", "fi").orderBy(
        "fi").drop("fi")


RULE_FEATURES = ["prior_wear", "prior_downtime_avg3", "planned_qty"]


def rule_importance(star: Star) -> DataFrame:
    """M9 of the fixed rule: wear, or a long mean downtime on a large plan, predicts a failure."""
    test = split_features(star).where(F.col("is_test") == 1).select(*KEYS, LABEL, *RULE_FEATURES)
    rule = (F.col("prior_wear") >= 0.5) | ((F.col("prior_downtime_avg3") >= 200) & (F.col("planned_qty") >= 25))
    return importance(test, lambda df: df.withColumn("prediction", rule.cast("int")), RULE_FEATURES)


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Means of a few doubles differ in their last bits by the order of addition."""
    return df.select("feature", *[F.round(c, digits).alias(c) for c in ("importance_mean", "importance_std")])


def top_features(importance: DataFrame, k: int = 10) -> DataFrame:
    """M10."""
    return importance.orderBy(F.desc("importance_mean"), "feature").limit(k)


def rule_predictions(star: Star, threshold: float = 0.5) -> DataFrame:
    """A deterministic scorer for oracle-checkable evaluation: prior_wear as
    the score, ``prior_wear >= threshold`` as the predicted class, on the
    test split."""
    worn = windows.prior_features(star.fact_production.select(*KEYS, "record_id", LABEL, "downtime_minutes",
                                                              "machine_wear_index"))
    held = split(worn, keys=star.fact_production).where(F.col("is_test") == 1)
    return held.select(*KEYS, LABEL, F.col("prior_wear").alias("score"),
                       (F.col("prior_wear") >= threshold).cast("int").alias("prediction"))
