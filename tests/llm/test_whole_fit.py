"""The classifier learns from every labelled row, however many groups they make."""

import numpy as np
from common import documents
from loanbook.llm import preference


def _gain(worth, good, cut):
    return (good & (worth > cut)).sum() / good.sum() + (~good & (worth <= cut)).sum() / (~good).sum()


def test_threshold_and_weights_come_from_all_rows(spark):
    rng = np.random.RandomState(3)
    rows = [(k, [float(x) for x in rng.randn(len(preference.NAMES)) + 0.3 * (k % 4 == 0)], k % 4 == 0, k * 7919 % 1009) for k in range(900)]
    labelled = spark.createDataFrame(rows, "doc_id long, features array<double>, good boolean, place long")
    groups = preference._dealt(labelled, 100).cache()
    assert groups.count() == 9
    own = [r for g in groups.collect() for r in g.rows if r.own]
    assert sorted(r.doc_id for r in own) == list(range(900))
    assert all(sum(r.good for r in g.rows) >= 90 for g in groups.collect())
    x, good = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    ranking = preference.Ranking()
    assert ranking.fit(preference._over(groups))
    assert np.allclose(ranking.mean, x.mean(axis=0)) and np.allclose(ranking.spread, x.std(axis=0) + 1e-6)
    worth = ranking.worths(x)
    cut = preference.threshold(groups.mapInArrow(preference._worths(ranking), "worth double, good boolean"))
    assert abs(_gain(worth, good, cut) - max(_gain(worth, good, c) for c in worth)) < 1e-9


def test_one_group_equals_the_local_fit(spark):
    rng = np.random.RandomState(4)
    good = rng.rand(200) < 0.5
    x = rng.randn(200, len(preference.NAMES)) + good[:, None] * 0.4
    local = preference.Ranking(x, good)
    rows = spark.createDataFrame([(k, x[k].tolist(), bool(good[k]), k) for k in range(200)], "doc_id long, features array<double>, good boolean, place long")
    groups = preference._dealt(rows, 1000).cache()
    ranking = preference.Ranking()
    assert ranking.fit(preference._over(groups)) and np.allclose(ranking.weights, local.weights, atol=1e-9)
    assert abs(preference.threshold(groups.mapInArrow(preference._worths(ranking), "worth double, good boolean")) - local.cut) < 1e-9


def test_equal_worths(spark):
    df = spark.createDataFrame([(1.5, True), (1.5, False)], "worth double, good boolean")
    assert preference.threshold(df) == 1.5


def test_small_groups_still_tell_quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = preference.ranked(documents(spark, sf), labels, group_rows=200).join(labels, "doc_id").where("held_out").toPandas()
    assert len(held) > 60 and (held.predicted == held.quality).mean() > 0.97
