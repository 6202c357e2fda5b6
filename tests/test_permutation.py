"""M9: digests, places and shuffled values against hashlib and plain lists."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftline.operators import boosting, permutation
from shiftline.plans import risk


def _bytes(rows):
    return np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0] + [len(r) for r in rows])


def test_digests_are_md5():
    rnd = random.Random(1)
    rows = ["".join(rnd.choice("abcé|1") for _ in range(rnd.choice([0, 1, 19, 40, 55, 56, 64, 100, 130]))).encode() for _ in range(500)]
    digest = permutation.digests()
    for prefix in (b"", b"42|", b"x" * 55, b"y" * 64):
        got = digest(prefix, *_bytes(rows), step=128)
        assert [bytes(g) for g in got] == [hashlib.md5(prefix + r).digest() for r in rows]
    assert digest(b"42|", *_bytes([])).shape == (0, 16)


def _expected(data, features, repeats, seed=42):
    """By feature and repeat: every row's shuffled value, by the row's key."""
    order = lambda text: sorted(data, key=lambda r: hashlib.md5(f"{text}|{r['key']}".encode()).hexdigest())
    plain = order(seed)
    return {(f, n): {r["key"]: g[f] for r, g in zip(plain, order(f"{seed}|{n}|{f}"))} for f in features for n in range(repeats)}


@pytest.mark.parametrize("bucket, chunk, together", [(1 << 16, 1 << 15, 1 << 17), (40, 37, 50)])
def test_shuffled_values_come_to_the_places_of_the_plain_order(spark, monkeypatch, bucket, chunk, together):
    monkeypatch.setattr(permutation, "BUCKET", bucket)
    monkeypatch.setattr(permutation, "CHUNK", chunk)
    monkeypatch.setattr(permutation, "TOGETHER", together)
    rnd = random.Random(3)
    data = [{"key": f"k{k}", "a": None if k % 7 == 0 else rnd.random(), "b": rnd.randrange(5), "c": f"text {k}"} for k in range(700)]
    df = spark.createDataFrame(data, "key string, a double, b smallint, c string").repartition(3)

    def tally(repeat, rows, values):
        import pyarrow as pa
        for k, (v, null) in values.items():
            yield pa.RecordBatch.from_arrays([rows.column("key").combine_chunks(), rows.column("c").combine_chunks(), pa.array(
                [k] * len(v), pa.int32()), pa.array(v.astype("f8"), mask=null)], names=["key", "c", "fi", "v"])

    want, got = _expected(data, ["a", "b"], 2), {}
    for repeat, frame in permutation.shuffled(df, F.col("key"), ["a", "b"], 2, 42, tally, "key string, c string, fi int, v double"):
        for r in frame.collect():
            assert r.c == f"text {r.key[1:]}"
            got.setdefault(("ab"[r.fi], repeat), {})[r.key] = r.v
    assert got == want


def _test_rows(spark, n=400):
    rnd = random.Random(5)
    return spark.createDataFrame([(f"M{k % 9}", 20200101 + k // 9, f"S{k % 3}", int(rnd.random() < 0.3), rnd.random(), k % 2) for k in range(n)],
                                 "machine_id string, date_id int, shift_id string, failure_event int, a double, b int")


def test_importance_leaves_no_shuffle_files_and_reads_the_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        read.add(1)
        return v

    test = _test_rows(spark)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = disk.getAllBlocks().size()
    got = risk.importance(test.withColumn("a", seen("a")), lambda d: d.withColumn("prediction", (F.col("a") > 0.5).cast("int")), ["a", "b"], 3)
    assert disk.getAllBlocks().size() == before             # all orders' files before
    rows = {r.feature: r for r in got.collect()}
    assert rows["b"].importance_mean == 0.0 and rows["a"].importance_std > 0
    assert read.value == test.count()                       # several times before


def _tree(cuts):
    """A tree whose splits go down its right side."""
    nodes = []
    for k, (f, t) in enumerate(cuts):
        nodes += [(2 * k, f, t, 2 * k + 1, 2 * k + 2, None), (2 * k + 1, None, None, None, None, float((-1) ** k))]
    return [*nodes, (2 * len(cuts), None, None, None, None, 0.25)]


@pytest.mark.parametrize("n", [4, 70])
def test_exchanged_values_give_the_classes_of_the_changed_rows(spark, n):
    rnd = np.random.default_rng(2)
    model = boosting.Boosted(0.05, 0.5, [_tree([(int(f), float(t)) for f, t in zip(rnd.integers(0, 3, n), rnd.random(n))]),
                                         _tree([(1, 0.5)]), [(0, None, None, None, None, 0.1)]])
    run = boosting.exchanges(model)
    if n > 63:
        assert run is None
        return
    cells, other = rnd.random((500, 3)), rnd.random((500, 3))
    other[0, 0], cells[1, 1] = np.nan, np.nan
    cuts = boosting.thresholds(model)
    code = lambda x: [np.searchsorted(c, x[:, f]) for f, c in zip(model.used(), cuts)]
    plain, changed = run(code(cells), dict(enumerate(code(other))))

    def classes(x):
        df = spark.createDataFrame([(k, [float(v) for v in r]) for k, r in enumerate(x)], "k int, x array<double>")
        return [r.p >= 0.5 for r in df.select("k", model.probability("x").alias("p")).orderBy("k").collect()]

    assert plain.tolist() == classes(cells)
    for k, f in enumerate(model.used()):
        one = cells.copy()
        one[:, f] = other[:, f]
        assert changed[k].tolist() == classes(one)
