"""Consensus on simulated annotators: good ones, careless ones and one that swaps two labels."""

import random

from textmill.llm.consensus import LABELS, Consensus, chi_squared_quantile, votes_of


def simulate(seed, items=400):
    r = random.Random(seed)
    truth = {i: r.choice(LABELS) for i in range(items)}
    rows = []
    for i, t in truth.items():
        for a in r.sample(range(9), r.randint(3, 6)):
            if a == 8:
                lab = {"negative": "neutral", "neutral": "negative"}.get(t, t)
            else:
                lab = t if r.random() < (0.9 if a < 3 else 0.5) else r.choice(LABELS)
            rows.append((i, f"a{a}", f" {lab.upper()} "))
    return truth, rows


def test_beats_majority(spark):
    truth, rows = simulate(1)
    c = Consensus(votes_of(spark.createDataFrame(rows, "item long, agent string, label string"), spark.createDataFrame([], "item long, label string")))
    got = {r["item"]: r["label"] for r in c.items().collect()}
    right = sum(got[i] == t for i, t in truth.items())
    count = {}
    for i, _, lab in rows:
        count.setdefault(i, {}).setdefault(lab.strip().lower(), []).append(1)
    majority = sum(max(v, key=lambda x: len(v[x])) == truth[i] for i, v in count.items())
    assert right > majority and right >= 0.85 * len(truth)
    acc = {r["agent"]: r["accuracy"] for r in c.agents().collect()}
    assert min(acc["a0"], acc["a1"], acc["a2"]) > max(acc[f"a{k}"] for k in range(3, 9))


def test_rules(spark):
    rows = [(1, "a", "positive"), (1, "a", "positive"), (1, "b", "negative"), (1, "b", "positive"), (1, "c", "negative"), (1, "d", ""), (1, None, "neutral"), (2, "a", "bogus"), (2, "b", "neutral"), (None, "a", "neutral"), (3, "z", "neutral")]
    ruled = [(2, " Positive"), (2, "positive"), (3, "negative"), (3, "positive"), (4, "neutral"), (1, None)]
    v = votes_of(spark.createDataFrame(rows, "item long, agent string, label string"), spark.createDataFrame(ruled, "item long, label string"))
    assert sorted((r["item"], r["agent"], LABELS[r["lab"]]) for r in v.collect()) == [(1, "a", "positive"), (1, "c", "negative"), (2, "b", "neutral"), (3, "z", "neutral")]
    got = {r["item"]: r for r in Consensus(v).items().collect()}
    assert got[2]["label"] == "positive" and got[2]["ruled"] and not got[3]["ruled"] and got[1]["agents"] == 2 and got[1]["agreement"] == 0.0 and got[3]["agreement"] is None
    assert Consensus(v.limit(0)).items().count() == 0


def test_quantile(spark):
    from pyspark.sql import functions as F

    q = spark.range(1).select(chi_squared_quantile(0.975, F.lit(10)), chi_squared_quantile(0.025, F.lit(100))).first()
    assert abs(q[0] - 20.483) < 0.05 and abs(q[1] - 74.222) < 0.05


def test_the_chi_squared_bound_decides(spark):
    """Two votes from annotators hardly seen do not outweigh one from an annotator seen often, though they never erred."""
    rows = [(i, a, lab) for i in range(200) for a, lab in (("old", LABELS[i % 3]), ("also", LABELS[i % 3]))]
    rows += [(1000, "old", "positive"), (1000, "new1", "negative"), (0, "new1", LABELS[0]), (1, "new1", LABELS[1])]
    c = Consensus(votes_of(spark.createDataFrame(rows, "item long, agent string, label string"), spark.createDataFrame([], "item long, label string")))
    got = {r["item"]: r["label"] for r in c.items().where("item = 1000").collect()}
    sure = {r["agent"]: r["confidence"] for r in c.agents().collect()}
    assert got == {1000: "positive"} and sure["new1"] < 0.2 < 0.8 < sure["old"]


def test_settles_and_leaves_no_cache(spark):
    _, rows = simulate(5)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    c = Consensus(votes_of(spark.createDataFrame(rows, "item long, agent string, label string"), spark.createDataFrame([], "item long, label string")))
    assert 1 < c.rounds < 100 and len(spark.sparkContext._jsc.getPersistentRDDs()) == before
