"""Sparse indicators, round-by-round boosting, trees as a table, stored models."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shiftline.operators import boosting
from shiftline.operators.linear import Linear
from shiftline.plans import registry, risk, saved_models
from shiftline.sources import warehouse


def test_twenty_thousand_levels_stay_one_sparse_column(spark):
    df = spark.range(40_000).select(
        F.concat(F.lit("m"), F.format_string("%05d", F.col("id") % 20_000)).alias("machine"),
        F.concat(F.lit("p"), (F.col("id") % 3).cast("string")).alias("plant"), (F.col("id") % 7).cast("double").alias("x"))
    encoding = risk.fit_encoding(df, ["x"], ["machine", "plant"])
    assert len(encoding.features) == 1 + 19_999 + 2 and len(set(encoding.features)) == 20_002
    encoded = encoding.transform(df)
    assert encoded.columns == ["machine", "plant", "x", "features"]
    assert len(encoded._jdf.queryExecution().optimizedPlan().toString()) < 20_000       # no expression a level
    for r in encoded.where("machine in ('m00000', 'm00001', 'm19999')").collect():
        at = {encoding.features[i]: v for i, v in zip(r.features.indices, r.features.values)}
        want = {f"machine_{r.machine}": 1.0, f"plant_{r.plant}": 1.0, "x": r.x}
        assert at == {k: v for k, v in want.items() if v and k not in ("machine_m00000", "plant_p0")}


def test_one_level_gives_no_indicator(spark):
    df = spark.createDataFrame([(1.0, "a", "u"), (2.0, "a", "v")], "x double, one string, two string")
    encoding = risk.fit_encoding(df, ["x"], ["one", "two"])
    assert encoding.features == ["x", "two_v"]
    assert [tuple(r) for r in encoding.wide(encoding.transform(df)).select("x", "two_v").orderBy("x").collect()] == [(1, 0), (2, 1)]


def _rows(spark, n=3000, signal=2.0):
    rnd = random.Random(5)
    data = []
    for k in range(n):
        a, b = rnd.random(), rnd.random()
        y = int(rnd.random() < 1 / (1 + math.exp(-signal * (4 * a - 2 + (b > 0.7)))))
        data.append((k, a, b, rnd.random(), y, 2.0 if y else 1.0, int(k % 10 == 0)))
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame(data, "k int, a double, b double, c double, y int, w double, held int")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


FIT = dict(rate=0.3, depth=3, min_leaf=20, max_bins=64, patience=3, min_gain=1e-7)


@pytest.fixture(scope="module")
def boosted(spark):
    rows = _rows(spark).persist()
    return rows, boosting.fit(rows, "y", "w", "held", 40, **FIT)


def test_each_round_is_fitted_once_and_the_stop_is_stop_round(spark, boosted):
    rows, model = boosted
    assert len(model.trees) == len(model.losses)
    assert boosting.stop_round(model.losses, 3, 1e-7) in (None, len(model.trees))
    assert model.losses[5] < model.losses[0]
    # fewer rounds give the same first trees
    short = boosting.fit(rows, "y", "w", "held", 3, **FIT)
    assert short.trees == model.trees[:3] and short.losses == pytest.approx(model.losses[:3])


def test_a_fit_leaves_no_margins_behind(spark):
    """Margins that a checkpoint has cut are let go as well."""
    rows = _rows(spark, 400)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = boosting.fit(rows, "y", "w", "held", 2 * boosting.LINEAGE + 1, **FIT | {"patience": 99})
    assert len(model.trees) == 2 * boosting.LINEAGE + 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_histograms_added_in_a_shuffle_give_the_same_trees(spark, boosted, monkeypatch):
    rows, model = boosted
    monkeypatch.setattr(boosting, "TO_DRIVER", 0)
    monkeypatch.setattr(boosting, "CELLS", 300)
    shuffled = boosting.fit(rows, "y", "w", "held", 2, **FIT)
    for one, two in zip(shuffled.trees, model.trees):
        assert [n[:5] for n in one] == [n[:5] for n in two] and [n[5] or 0 for n in one] == pytest.approx([n[5] or 0 for n in two])


def test_leaves_are_newton_steps(spark, boosted):
    rows, model = boosted
    learn = rows.where("held = 0").select("a", "b", "c", "y", "w").toPandas()
    first = {n[0]: n for n in model.trees[0]}
    sums = {}
    p = 1 / (1 + math.exp(-model.base))
    assert model.base == pytest.approx(math.log((learn.w * learn.y).sum() / (learn.w * (1 - learn.y)).sum()))
    for a, b, c, y, w in learn.itertuples(index=False):
        at = 0
        while first[at][1] is not None:
            _, f, t, yes, no, _ = first[at]
            at = yes if (a, b, c)[f] <= t else no
        g, h, n = sums.get(at, (0, 0, 0))
        sums[at] = g + w * (y - p), h + w * p * (1 - p), n + 1
    assert all(n >= 20 for *_, n in sums.values())
    assert {at: first[at][5] for at in sums} == pytest.approx({at: g / h for at, (g, h, _) in sums.items()})


def test_trees_as_a_table_give_the_same_scores_in_sql(spark, boosted):
    rows, model = boosted
    scored = rows.select("k", "a", "b", "c", model.probability(vector_to_array("features")).alias("p"))
    got = {r.k: r.p for r in scored.collect()}
    con = duckdb.connect()
    nodes, cells = model.nodes(spark).toPandas(), rows.select("k", "a", "b", "c").toPandas()
    con.register("nodes", nodes.astype({c: "Float64" for c in ("feature", "yes", "no")}))
    con.register("cells", cells)
    sql = f"""
        WITH RECURSIVE walk AS (
          SELECT k, [a, b, c] AS x, tree, 0 AS node FROM cells, (SELECT DISTINCT tree FROM nodes)
          UNION ALL
          SELECT k, x, n.tree, CASE WHEN x[feature::INT + 1] <= threshold THEN yes ELSE no END::INT
          FROM walk JOIN nodes n USING (tree, node) WHERE feature IS NOT NULL)
        SELECT k, 1 / (1 + exp(-({model.base} + {model.rate} * sum(value)))) AS p
        FROM walk JOIN nodes USING (tree, node) WHERE feature IS NULL GROUP BY k"""
    want = dict(con.execute(sql).fetchall())
    assert got == pytest.approx(want)
    y = dict(rows.select("k", "y").collect())
    # the first tree's split is on a feature that matters
    assert np.mean([got[k] for k in y if y[k]]) > np.mean([got[k] for k in y if not y[k]]) + 0.2


def test_splits_maximise_the_gain(spark, boosted):
    """The first tree's root against every cut of every feature."""
    rows, model = boosted
    data = rows.where("held = 0").select("a", "b", "c", "y", "w").toPandas()
    p = 1 / (1 + math.exp(-model.base))
    g, h = data.w * (data.y - p), data.w * p * (1 - p)
    score = lambda m: g[m].sum() ** 2 / h[m].sum()
    gain = lambda f, t: score(data[f] <= t) + score(data[f] > t)
    _, f, t, *_ = model.trees[0][0]
    best = max(gain(c, v) for c in "abc" for v in data[c].quantile([k / 64 for k in range(1, 64)], "lower"))
    assert gain("abc"[f], t) >= 0.999 * best


def test_a_single_leaf_and_missing_values(spark):
    single = boosting.Boosted(0.5, 0.1, [[(0, None, None, None, None, 1.0)]])
    df = spark.createDataFrame([([1.0],)], "x array<double>")
    assert df.select(single.probability("x").alias("p")).first().p == pytest.approx(1 / (1 + math.exp(-0.6)))
    one = boosting.Boosted(0.0, 1.0, [[(0, 0, 2.0, 1, 2, None), (1, None, None, None, None, -1.0), (2, None, None, None, None, 1.0)]])
    p = {r.k: r.p for r in spark.createDataFrame([(0, [2.0]), (1, [2.5]), (2, [float("nan")])], "k int, x array<double>").select(
        "k", one.probability("x").alias("p")).collect()}
    assert p[0] < 0.5 < p[1] == p[2]


def test_constant_features_and_few_rows_give_a_leaf(spark):
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(1.0, k % 2, 1.0, 0) for k in range(50)], "a double, y int, w double, held int")
    rows = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    model = boosting.fit(rows, "y", "w", "held", 2, **FIT)
    assert [len(t) for t in model.trees] == [1, 1] and model.losses == []      # no held-out row


def test_needs_both_classes(spark):
    with pytest.raises(ValueError, match="both classes"):
        boosting.fit(_rows(spark, 50).withColumn("y", F.lit(0)), "y", "w", "held", 3, **FIT)


@pytest.mark.parametrize("make", [saved_models._linear, saved_models._trees])
def test_a_stored_model_scores_alike_in_another_session(spark, tmp_dir, make):
    st = registry.fixture_star(spark, SF_SMALL)
    encoding = risk.fit_encoding(risk.category_columns(st))
    model = risk.RiskModel(encoding, make(encoding.features))
    warehouse.save_model(model, tmp_dir, spark)
    other = spark.newSession()
    loaded, columns = warehouse.load_model(other, tmp_dir)
    rows = risk.failure_features(st)
    assert columns == encoding.features and isinstance(loaded.scorer, (boosting.Boosted, Linear))
    one, two = (m.transform(rows).select(*risk.KEYS, "p_failure", "prediction") for m in (model, loaded))
    assert sorted(one.collect()) == sorted(two.collect())


def test_importance_of_features_that_no_tree_reads_is_zero(spark):
    st = registry.fixture_star(spark, SF_SMALL)
    rows = risk.split_features(st)
    encoding = risk.fit_encoding(risk.category_columns(st))
    scorer = saved_models._trees(encoding.features)
    test = encoding.transform(rows.where("is_test = 1"))
    fitted = risk.FittedRisk(risk.RiskModel(encoding, scorer), test, test)
    got = {r.feature: (r.importance_mean, r.importance_std) for r in risk.permutation_importance(fitted, 2).collect()}
    read = {encoding.features[f] for f in scorer.used()}
    assert list(got) == encoding.features
    assert all(got[f] == (0.0, 0.0) for f in got if f not in read) and any(got[f][0] for f in read)
    # the same as shuffling the columns of the wide rows
    wide = encoding.wide(test).select(*risk.KEYS, risk.LABEL, *[F.col(f"`{f}`") for f in encoding.features])
    predict = lambda df: df.withColumn(
        "prediction", (scorer.probability(F.array(*[F.col(f"`{f}`") for f in encoding.features])) >= 0.5).cast("double"))
    plain = {r.feature: r.importance_mean for r in risk.importance(wide, predict, sorted(read), 2).collect()}
    assert {f: got[f][0] for f in plain} == pytest.approx(plain)


def _typed(spark, n=3000):
    """Rows with a number and indicators of two columns of four and three levels."""
    rnd = random.Random(7)
    data = []
    for k in range(n):
        a, t, s = rnd.random(), rnd.randrange(4), rnd.randrange(3)
        y = int(rnd.random() < 1 / (1 + math.exp(-(3 * a - 1.5 + (t == 2) - (s == 1)))))
        data.append((a, *[float(t == i) for i in (1, 2, 3)], *[float(s == i) for i in (1, 2)], y, 2.0 if y else 1.0, int(k % 10 == 0)))
    from pyspark.ml.feature import VectorAssembler
    names = ["a", "t1", "t2", "t3", "s1", "s2"]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in names) + ", y int, w double, held int")
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


def test_runs_of_indicators_are_one_code_and_give_the_same_trees(spark, monkeypatch):
    rows = _typed(spark)
    plain = boosting.fit(rows, "y", "w", "held", 4, numbers=1, **FIT)
    runs = boosting.fit(rows, "y", "w", "held", 4, numbers=1, groups=[3, 2], **FIT)
    monkeypatch.setattr(boosting, "JOINT", 1)
    apart = boosting.fit(rows, "y", "w", "held", 4, numbers=1, groups=[3, 2], **FIT)
    for other in (runs, apart):
        assert [[n[:5] for n in t] for t in other.trees] == [[n[:5] for n in t] for t in plain.trees]
        assert other.losses == pytest.approx(plain.losses)
    assert {f for t in plain.trees for _, f, *_ in t} > {0, 2, 4}
    with pytest.raises(Exception, match="more than one indicator"):
        boosting.fit(rows, "y", "w", "held", 1, numbers=1, groups=[5], **FIT)


def test_a_row_has_few_cells_and_a_level_sums_one_node_of_each_split(spark, monkeypatch):
    edges = [np.arange(254.0), np.arange(9.0), *[np.array([0.5])] * 13]
    columns = boosting._columns(edges, 2, [7, 2, 4])
    assert sorted(f for c in columns for features, _ in c for f in features) == list(range(15))
    assert len(columns) == 3 and max(map(boosting._codes, columns)) <= boosting.JOINT     # 15 cells before
    asked, rows = [], _rows(spark, 1500)
    grown = boosting._grown
    monkeypatch.setattr(boosting, "_grown", lambda root, histograms, *rest: grown(
        root, lambda nodes, wanted: asked.append((len([n for n in nodes if n[1] is not None]), len(wanted))) or histograms(nodes, wanted), *rest))
    boosting.fit(rows, "y", "w", "held", 1, **FIT | {"depth": 4})
    assert asked[0] == (1, 1) and sum(w for _, w in asked) == asked[-1][0]


def test_more_than_64_leaves(spark):
    rows = _rows(spark, 4000)
    model = boosting.fit(rows, "y", "w", "held", 3, **FIT | {"depth": 8, "min_leaf": 2})
    assert max(sum(n[1] is None for n in t) for t in model.trees) > 64
    held = rows.where("held = 1").withColumn("p", model.probability(vector_to_array("features"))).toPandas()
    loss = -(held.w * np.log(np.where(held.y == 1, held.p, 1 - held.p))).sum() / held.w.sum()
    assert model.losses[-1] == pytest.approx(loss)


def test_weights_that_differ_by_row(spark):
    rows = _rows(spark, 1500).withColumn("w", 1 + F.rand(3))
    model = boosting.fit(rows, "y", "w", "held", 2, **FIT)
    held = rows.where("held = 1").withColumn("p", model.probability(vector_to_array("features"))).toPandas()
    loss = -(held.w * np.log(np.where(held.y == 1, held.p, 1 - held.p))).sum() / held.w.sum()
    assert model.losses[-1] == pytest.approx(loss)


def test_of_splits_that_divide_alike_the_first_feature_is_taken(spark):
    """Two features with the same cut, whose sums are added in another order."""
    edges, columns = [np.array([0.5])] * 3, [[([0], 2)], [([1], 2)], [([2], 2)]]
    rnd = np.random.default_rng(4)
    g, h = rnd.normal(size=2) * 10, rnd.random(2) * 100
    more = np.nextafter(g, np.inf)
    both = [np.array([50.0, 60.0]), g, h]
    tied = np.concatenate([np.concatenate([both[0]] * 3), np.concatenate([g, [g[0], g[1]], more]), np.concatenate([h] * 3)])
    assert boosting._best_split(tied, edges, columns, 20)[1] == 0
    tied = np.concatenate([np.concatenate([both[0]] * 3), np.concatenate([g, more, more + np.sign(g) * 1]), np.concatenate([h] * 3)])
    assert boosting._best_split(tied, edges, columns, 20)[1] == 2
