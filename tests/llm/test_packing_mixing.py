"""Containers and mixes: nothing lost, nothing over, seeds repeat."""

import collections
import random

import pytest

from textmill.llm import mixing, packing, tokens


@pytest.mark.parametrize("seed", range(4))
def test_histogram(seed):
    r = random.Random(seed)
    cap = r.choice([8, 100, 512])
    counts = {r.randint(1, cap): r.randint(1, 900) for _ in range(r.randint(1, 60))}
    packs = packing.pack_histogram(counts, cap)
    used = collections.Counter()
    for n, content in packs:
        assert n > 0 and sum(length * k for length, k in content) <= cap
        for length, k in content:
            used[length] += n * k
    assert used == collections.Counter(counts)


def test_items(spark):
    r = random.Random(9)
    items = [(i, r.choice([7, 7, 7, r.randint(1, 60)])) for i in range(900)] + [(900, 0), (901, 130), (902, 64), (903, None)]
    df = spark.createDataFrame(items, "id long, tokens long")
    kinds = spark.createDataFrame([("s", 64), ("l", 200), ("none", 0)], "kind string, capacity long")
    got = packing.packed(df, kinds).collect()
    for kind, cap in (("s", 64), ("l", 200)):
        mine = [x for x in got if x["kind"] == kind]
        assert len({(x["id"], x["piece"]) for x in mine}) == len(mine)
        per, fill = collections.Counter(), collections.Counter()
        for x in mine:
            per[x["id"]] += x["length"]
            fill[x["container"]] += x["length"]
        assert per == collections.Counter({i: n for i, n in items if n}) and max(fill.values()) <= cap
        assert sorted(fill) == list(range(len(fill)))  # numbered without a gap
        assert len(fill) <= -(-sum(per.values()) // cap) * 1.05 + 2
        if kind == "s":
            assert sorted(x["length"] for x in mine if x["id"] == 901) == [2, 64, 64]
    assert packing.packed(df.limit(0), kinds).count() == 0
    assert sum(x["unused"] + x["used"] for x in packing.containers(packing.packed(df, kinds), kinds).collect()) % 4 == 0


def test_joined_slots_agree(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE", 7)
    df = spark.createDataFrame([(i, 1 + i % 37 if i % 3 else 5) for i in range(700)] + [(999, 260)], "id long, tokens long")
    kinds = spark.createDataFrame([("s", 50)], "kind string, capacity long")
    key = lambda d: sorted(tuple(r) for r in d.select("kind", "container", "id", "piece", "length").collect())
    plain = key(packing.packed(df, kinds))
    monkeypatch.setattr(packing, "MOST_SLOTS", 0)
    assert key(packing.packed(df, kinds)) == plain


def test_water():
    s = [mixing.Source("a", 0.5, 1, 10), mixing.Source("b", 0.3, 2, 100), mixing.Source("c", 0.2, 9, 1000), mixing.Source("d", 0.1, 3, 0)]
    got = mixing.water_fill(s, 500)
    assert got["a"] == 10 and got["b"] == 200 and got["c"] == pytest.approx(290) and got["d"] == 0
    assert sum(mixing.water_fill(s, 10**9).values()) == 10 + 200 + 9000


def test_mix(spark):
    r = random.Random(3)
    items = [(i, r.choice(["a", "a", "a", "b", "c", None, "other"]), r.randint(1, 20)) for i in range(6000)]
    df = spark.createDataFrame(items, "id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.4, 2), ("c", 0.2, 5), ("empty", 0.1, 2), (None, 0.5, 1)], "source string, target_share double, max_repeats long")
    m = mixing.Mix(df, targets)
    draw = m.draw().collect()
    assert {x["source"] for x in draw} == {"a", "b", "c"} and len({x["id"] for x in draw}) == len(draw)
    cap = {"a": 1, "b": 2, "c": 5}
    got = collections.Counter()
    for x in draw:
        assert x["repeats"] <= cap[x["source"]]
        got[x["source"]] += x["repeats"] * x["tokens"]
    for s, v in got.items():
        assert abs(v - m.amount[s]) <= 20
    shares = m.shares().collect()
    assert len(shares) == 4 and sum(x["actual_share"] for x in shares) == pytest.approx(1, abs=1e-5)
    assert sorted(tuple(x) for x in mixing.Mix(df.repartition(5), targets).draw().collect()) == sorted(tuple(x) for x in draw)
    assert mixing.Mix(df.limit(0), targets).draw().count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "<|endoftext|> نص")], "id long, text string")
    n = {x["id"]: x["tokens"] for x in tokens.token_counts(df, "text", "id").collect()}
    with open(tokens.VOCABULARY, "rb") as f:
        e = tokens.encoder(f.read())
    assert n == {1: len(e.encode_ordinary("hello world")), 2: 0, 3: 0, 4: len(e.encode_ordinary("<|endoftext|> نص"))}
