"""Classifier evaluation as DataFrame aggregates (M7, M8).

Both metrics come out of aggregates whose shuffles carry counts only; the
ROC-AUC is the exact Mann–Whitney statistic (ties count one half).
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftline.functions.scalar import safe_divide
from shiftline.session import checkpoint_dir


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          target_names: tuple[str, str] = ("0", "1")) -> DataFrame:
    """Binary report: one row per class (named by ``target_names``), then
    'accuracy', 'macro avg', 'weighted avg'; columns precision, recall,
    f1_score, support (undefined ratios are 0)."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = df.agg(*[F.count(F.when((y == a) & (p == b), 1)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)])

    def stats(cls: int):
        other = 1 - cls
        tp = F.col(f"n{cls}{cls}").cast("double")
        pred = F.col(f"n{cls}{cls}") + F.col(f"n{other}{cls}")
        sup = F.col(f"n{cls}{cls}") + F.col(f"n{cls}{other}")
        prec = F.coalesce(safe_divide(tp, pred), F.lit(0.0))
        rec = F.coalesce(safe_divide(tp, sup), F.lit(0.0))
        f1 = F.coalesce(safe_divide(2.0 * prec * rec, prec + rec), F.lit(0.0))
        return prec, rec, f1, sup

    p0, r0, f0, s0 = stats(0)
    p1, r1, f1, s1 = stats(1)
    total = s0 + s1
    acc = safe_divide((F.col("n00") + F.col("n11")).cast("double"), total)
    row = lambda name, a, b, f, s: F.struct(F.lit(name).alias("class_label"), a.alias("precision"),
                                            b.alias("recall"), f.alias("f1_score"),
                                            s.cast("bigint").alias("support"))
    none = F.lit(None).cast("double")
    rows = F.array(
        row(target_names[0], p0, r0, f0, s0), row(target_names[1], p1, r1, f1, s1),
        row("accuracy", none, none, acc, total),
        row("macro avg", (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, total),
        row("weighted avg", safe_divide(p0 * s0 + p1 * s1, total), safe_divide(r0 * s0 + r1 * s1, total),
            safe_divide(f0 * s0 + f1 * s1, total), total))
    return c.select(F.explode(rows).alias("r")).select("r.*")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", n_buckets: int = 1024,
            rel_err: float = 1e-3) -> DataFrame:
    """Exact ROC-AUC (one row: roc_auc, n_pos, n_neg).

    AUC = Σ_s n1(s)·(2·n0(<s) + n0(s)) / (2·N1·N0) over distinct scores s.
    The prefix counts n0(<s) need the scores in order; instead of one
    global window, scores are cut into ranges at approximate quantiles
    (a bounded list), range totals give each range's offset, and only
    scores inside a range are ordered together.
    """
    y = F.col(label).cast("int")
    per = (df.where(F.col(score).isNotNull())
           .groupBy(F.col(score).alias("s")).agg(F.count(F.when(y == 0, 1)).alias("n0"),
                                                F.count(F.when(y == 1, 1)).alias("n1")))
    # The per-score table (one row per distinct score) is read twice: for the
    # range cuts and for the sums. Checkpointing it to the shared folder runs
    # the upstream plan once and cuts its lineage.
    checkpoint_dir(df.sparkSession)
    per = per.checkpoint(eager=True)
    qs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = sorted(set(x for x in per.approxQuantile("s", qs, rel_err) if x is not None)) or [0.0]
    splits = [float("-inf")] + cuts + [float("inf")]
    per = Bucketizer(splits=splits, inputCol="s", outputCol="_r", handleInvalid="keep").transform(per)
    ranges = per.groupBy("_r").agg(F.sum("n0").alias("_r0"))
    w_r = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)   # ≤ n_buckets rows
    ranges = ranges.select("_r", F.coalesce(F.sum("_r0").over(w_r), F.lit(0)).alias("_off"))
    per = per.join(ranges, "_r")
    w_in = Window.partitionBy("_r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_off") + F.coalesce(F.sum("n0").over(w_in), F.lit(0))
    # Products of two counts pass bigint at scale: exact decimals instead.
    wide = lambda c: c.cast("decimal(19,0)")
    terms = per.select((wide(F.col("n1")) * wide(2 * below + F.col("n0"))).alias("t"), "n0", "n1")
    tot = terms.agg(F.sum("t").alias("t"), F.sum("n1").alias("n_pos"), F.sum("n0").alias("n_neg"))
    return tot.select(safe_divide(F.col("t").cast("double"),
                                  (2 * wide(F.col("n_pos")) * wide(F.col("n_neg"))).cast("double"))
                      .alias("roc_auc"),
                      F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg"))
