"""Near-duplicates, split overlaps and history against brute force, with copies, reordering, hot words and skew."""

import collections
import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import crosssplit, fulltext, history, neardup, nearsame


def corpus(seed, n=160, hot=40):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(n // 4):
        base = ["hot"] + r.choices(vocab, k=r.randint(11, 30))
        out.append(" ".join(base))
        for _ in range(3):
            t = list(base)
            for _ in range(r.randint(0, 6)):
                i = r.randrange(len(t))
                r.choice([lambda: t.__setitem__(i, r.choice(vocab)), lambda: t.insert(i, r.choice(vocab)), lambda: len(t) > 2 and t.pop(i), lambda: r.shuffle(t)])()
            out.append("  ".join(t))
    copy = " ".join(["hot"] + vocab[:15])
    out += [copy] * hot  # one text in a third of all rows
    out += ["short text", "", "   ", None, "a a a a a a a a a a a a", "a a a a a a a a a a a a a", "x " * 3000]
    r.shuffle(out)
    return out


def bag(t):
    return collections.Counter((nearsame.clean_text(t) or "").split())


def near(a, b):
    n, m = sum(a.values()), sum(b.values())
    return n >= 12 and m >= 12 and 2 * sum((a & b).values()) >= 0.75 * (n + m)


def brute(left, right=None):
    if right is None:
        b = [bag(t) for t in left]
        return {(i, j) for i in range(len(b)) for j in range(i + 1, len(b)) if near(b[i], b[j])}
    x, y = [bag(t) for t in left], [bag(t) for t in right]
    return {(i, j) for i in range(len(x)) for j in range(len(y)) if near(x[i], y[j])}


def table(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t) for i, t in enumerate(texts)], "row long, text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs(spark, seed):
    texts = corpus(seed)
    got = neardup.near_duplicate_pairs(table(spark, texts), "row", "text").collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == brute(texts)


def test_groups(spark):
    texts = corpus(3)
    want = brute(texts)
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in want:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    links = collections.Counter(x for p in want for x in p)
    got = {r["row"]: r for r in neardup.near_duplicate_groups(table(spark, texts), "row", "text").collect()}
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert got[i]["group"] == top(i) and got[i]["links"] == links[i]


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(r.randrange(100, 140), r.randrange(100, 140)) for _ in range(25)]
    parent = {x: x for e in edges for x in e}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    got = dict(tuple(x) for x in neardup.connected(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got.get(x, x) == top(x) for x in parent)


@pytest.mark.parametrize("seed", [5, 6])
def test_across_splits(spark, seed):
    texts = corpus(seed)
    df = table(spark, texts).withColumn("split", F.when(F.col("row") % 3 == 0, "test").when(F.col("row") % 3 == 1, "val").otherwise("train")).withColumn("source", F.lit("s"))
    got = crosssplit.cross_pairs(df, "row", "text", "split = 'train'").collect()
    want = {p for p in brute(texts) if (p[0] % 3 == 2) != (p[1] % 3 == 2)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    counts = crosssplit.cross_counts(df, "row", "text", "split", "source").collect()
    assert sum(r["row_pairs"] for r in counts) == len(want)


def test_history(spark):
    old, new = corpus(7), corpus(7)[:90] + corpus(8)[:60]
    day = lambda i, k: (datetime.date(2026, 1, 1) + datetime.timedelta(days=(i * 7) % k)).isoformat()
    h = spark.createDataFrame([(f"h{i}", t, day(i, 40)) for i, t in enumerate(old)], "name string, text string, day string")
    b = spark.createDataFrame([(i, t, day(i, 45)) for i, t in enumerate(new)], "row long, text string, day string")
    number = "datediff(to_date(day), date'1970-01-01')"
    got = history.repeated_rows(b, "row", "text", number, h, "name", "text", number).collect()
    want = {(i, f"h{j}") for i, j in brute(new, old) if day(j, 40) < day(i, 45)}
    assert {(r["row"], r["name"]) for r in got} == want and len(got) == len(want)


def numbered(spark, texts):
    return nearsame.classes(nearsame.word_sets(table(spark, texts), "row", "text")).cache()


def test_hot_elements_and_pairs_are_spread(spark, monkeypatch):
    monkeypatch.setattr(nearsame, "HOT_PAIR", 500)
    texts = [f"hot common {' '.join(f'u{i}x{k}' for k in range(12))}" for i in range(3000)]
    pair = sorted(nearsame.element_arrays(["hot common " + " ".join(f"z{k}" for k in range(12))])[2].tolist())
    cls = numbered(spark, texts)
    to = nearsame.routing(cls, shards=20)
    assert len(to.elements) == 2 and set(to.elements.tolist()) <= set(pair)
    every = [f"{' '.join(f'same{k}' for k in range(6))} {' '.join(f'u{i}x{k}' for k in range(8))}" for i in range(3000)]
    cls = numbered(spark, every)
    to = nearsame.routing(cls, shards=20)
    assert len(to.pairs) and to.spread.min() >= 2
    spread = nearsame.segments(cls, 0, to, False).groupBy("shard").agg(F.sum(F.size("seg")).alias("n")).collect()
    assert len(spread) == 20 and max(r["n"] for r in spread) < 2 * sum(r["n"] for r in spread) / 20


def test_segments_keep_every_neighbour(spark):
    cls = numbered(spark, [t for t in corpus(9) if t])
    rows = cls.select("elems").collect()
    pairs = sum(len(r["elems"]) - 1 for r in rows)
    first, none = max((r["elems"] for r in rows), key=len), np.zeros(0, np.int64)
    name = nearsame.pair_name(np.array(first[2:3]), np.array(first[3:4]))
    held = sum((first[2], first[3]) in zip(r["elems"], r["elems"][1:]) for r in rows)
    for hot, two, ways, more in (([], none, none, 0), ([int(first[0])], none, none, 0), ([], name, np.array([3]), 2 * held)):
        to = nearsame.Routing(5, np.array(sorted(hot), np.int64), two, ways)
        count = lambda copied: sum(len(r["seg"]) - 1 for r in nearsame.segments(cls, 0, to, copied).select("seg").collect())  # noqa: E731, B023
        assert count(False) == pairs and count(True) == pairs + more


def test_hot_pairs_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(nearsame, "HOT_PAIR", 10)
    texts = corpus(12)
    df = table(spark, texts).withColumn("split", F.when(F.col("row") % 2 == 0, "test").otherwise("train"))
    got = crosssplit.cross_pairs(df, "row", "text", "split = 'train'").collect()
    want = {p for p in brute(texts) if p[0] % 2 != p[1] % 2}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_ids_of_any_type(spark):
    texts = corpus(13, n=40, hot=5)
    df = table(spark, texts).select(F.concat(F.lit("r"), F.lpad(F.col("row").cast("string"), 4, "0")).alias("row"), "text", (F.col("row") % 2).alias("split"))
    name = lambda i: f"r{i:04d}"
    want = {(name(a), name(b)) for a, b in brute(texts)}
    assert {tuple(r) for r in neardup.near_duplicate_pairs(df, "row", "text").collect()} == want
    groups = {r["row"]: r["group"] for r in neardup.near_duplicate_groups(df, "row", "text").collect()}
    assert all(groups[a] == groups[b] <= a for a, b in want)
    assert {tuple(r) for r in crosssplit.cross_pairs(df, "row", "text", "split = 1").collect()} == {p for p in want if int(p[0][1:]) % 2 != int(p[1][1:]) % 2}


def test_no_band_or_element_table_is_broadcast(spark):
    """Even where the threshold is far above what Spark takes the tables for."""
    df = table(spark, corpus(14))
    split = df.withColumn("split", F.when(F.col("row") % 2 == 0, "test").otherwise("train")).withColumn("day", (F.col("row") % 9).cast("int"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 100 << 20)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", 100 << 20)
    try:
        plans = [neardup.near_duplicate_pairs(df, "row", "text"), crosssplit.cross_pairs(split, "row", "text", "split = 'train'"), history.repeated_rows(split, "row", "text", "day", split.withColumnRenamed("row", "other"), "other", "text", "day")]
        for plan in plans:
            plan.collect()
            assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString()
        cls = written_classes(spark, df)
        for plan in (neardup.similar_classes(cls), crosssplit.class_overlaps(cls, cls)):
            plan.collect()
            assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def written_classes(spark, df):
    return neardup.prepared(df, "row", "text")[1]


@pytest.mark.parametrize("words", [30, 120, 500, 3000])
def test_sketches_reject_at_every_length_and_keep_the_threshold(words):
    """Texts without a common word are told apart however long they are; at the threshold nothing is thrown out."""
    import pyarrow as pa

    r = np.random.default_rng(words)
    limit, odd = neardup.most_odd(0.75), []
    common = int(0.75 * words + 0.999)
    sets = []
    for _ in range(60):
        a, b, c = (r.integers(-(2**63), 2**63, words) for _ in range(3))
        near = np.r_[a[:common], b[: words - common]]
        sets += [a, near, c]
    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(sets) + 1) * words, words, dtype=np.int32)), pa.array(np.concatenate(sets)))
    sketch = neardup.band_keys(flat)[1]
    odd = lambda i, j: int(np.bitwise_count(sketch[:, i] ^ sketch[:, j]).sum())
    assert all(odd(i, i + 1) <= limit for i in range(0, len(sets), 3))
    assert sum(odd(i, i + 2) <= limit for i in range(0, len(sets), 3)) <= 1


def test_suffix_array():
    r = np.random.default_rng(1)
    for n in (1, 2, 50, 300):
        t = r.integers(0, 4, n)
        want = sorted(range(n), key=lambda i: tuple(t[i:]))
        assert list(nearsame.suffix_array(t)) == want
    assert len(nearsame.suffix_array(np.zeros(0, np.int64))) == 0


def test_elias_fano():
    r = np.random.default_rng(3)
    for n, top in ((0, 10), (1, 1), (5, 3), (400, 401), (1000, 10**12), (3000, 700), (70, 2**62)):
        x = np.sort(r.integers(0, top, n))
        e = fulltext.EliasFano(x, top)
        assert e.read(np.arange(n)).tolist() == x.tolist()
        asked = np.r_[x, np.minimum(x + 1, top), r.integers(0, top, 50), 0, top]
        assert e.below(asked).tolist() == np.searchsorted(x, asked).tolist()


def test_index_is_compressed():
    """A third of one 64-bit array or less, where the parts it replaces were several."""
    import pyarrow as pa

    r = np.random.default_rng(4)
    segs = [r.zipf(1.3, 12).clip(max=20000).astype(np.int32).tolist() for _ in range(20000)]
    k = len(segs)
    ints = lambda t: pa.array(np.zeros(k), t)
    index = fulltext.FullTextIndex(crosssplit.Stretches(pa.table({"cls": ints(pa.int64()), "n": ints(pa.int32()), "s1": ints(pa.int64()), "s2": ints(pa.int64()), "seg": pa.array(segs, pa.list_(pa.int32()))})))
    assert index.nbytes < 8 * index.size / 2.5
    assert index.stretch_of(np.arange(index.size)).tolist().count(7) == 13  # twelve words and the mark


def test_backward_search_counts():
    import pyarrow as pa

    r = random.Random(11)
    segs = [[r.randrange(6) for _ in range(r.randint(2, 9))] for _ in range(40)]
    batch = pa.table({"cls": pa.array(range(40), pa.int64()), "n": pa.array([20] * 40, pa.int32()), "s1": pa.array([0] * 40, pa.int64()), "s2": pa.array([0] * 40, pa.int64()), "seg": pa.array(segs, pa.list_(pa.int32()))})
    s = crosssplit.Stretches(batch)
    index = fulltext.FullTextIndex(s)
    q = crosssplit.Stretches(batch.slice(3, 5))
    got = collections.Counter()
    for mine, other, _ in crosssplit.matches(index, q, 0.75):
        got.update(zip(mine.tolist(), other.tolist()))
    want = collections.Counter()
    for a, x in enumerate(segs[3:8]):
        for b, y in enumerate(segs):
            want[(a, b)] = sum(x[i : i + 2] == y[j : j + 2] for i in range(len(x) - 1) for j in range(len(y) - 1))
    assert got == +want


def test_kept_index(spark, tmp_path, monkeypatch):
    """Batches added one by one, in fresh objects and as after a restart: each finds what it repeats, arrays merge, files are only added."""
    batches = [[(f"{k}-{i}", t) for i, t in enumerate(corpus(20 + k % 3, n=40, hot=8))] for k in range(5)]
    path = str(tmp_path / "index")
    seen = []
    for k, b in enumerate(batches):
        index = history.HistoryIndex(spark, path, buckets=3)
        df = spark.createDataFrame(b, "name string, text string")
        got = [(r["name"], r["held"]) for r in index.check(df, "name", "text").collect()]
        old = [x for c in seen for x in c]
        want = {(b[i][0], old[j][0]) for i, j in brute([t for _, t in b], [t for _, t in old])}
        assert set(got) == want and len(got) == len(want)
        if k == 2:  # a run that dies before its manifest leaves nothing that counts
            with monkeypatch.context() as m:
                m.setattr(history.HistoryIndex, "_commit", lambda *_: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    history.HistoryIndex(spark, path).add(df, "name", "text")
        if k == 3:  # another session knows the files only
            for t in ("arrays", "classes", "members"):
                spark.sql(f"DROP TABLE {index._table(t)}")
            index = history.HistoryIndex(spark, path)
            assert {(r["name"], r["held"]) for r in index.check(df, "name", "text").collect()} == want
        index.add(df, "name", "text")
        seen.append(b)
        assert sorted(lv for lv, _ in index.live) == [i for i in range(4) if (k + 1) >> i & 1]
    empty = history.HistoryIndex(spark, path)
    assert empty.buckets == 3 and empty.check(df.limit(0), "name", "text").count() == 0
    empty.add(df.limit(0), "name", "text")


def test_history_is_not_shuffled_by_a_check(spark, tmp_path):
    index = history.HistoryIndex(spark, str(tmp_path / "index"), buckets=3)
    df = spark.createDataFrame([(f"a{i}", t) for i, t in enumerate(corpus(31))], "name string, text string")
    index.add(df, "name", "text")
    plan = index._arrays([n for _, n in index.live]).join(spark.range(3).select(F.col("id").cast("int").alias("shard")).repartition(3, "shard").hint("shuffle_hash"), "shard")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in text and text.count("Exchange") <= 2 and "Bucketed: true" in text


def test_arrays_are_bounded(spark, tmp_path, monkeypatch):
    """What is larger than one array is several, and finds the same."""
    assert history.sized([3, 3, 3, 100, 1, 1], 50) == [0, 0, 1, 2, 3, 3] and history.sized([], 5) == []
    old, new = corpus(41), corpus(41)[:60]
    index = history.HistoryIndex(spark, str(tmp_path / "index"), buckets=2)
    real = history._build
    monkeypatch.setattr(history, "_build", lambda name: real(name, 40))
    index.add(table(spark, old), "row", "text")
    assert index._arrays([n for _, n in index.live]).count() > 20
    got = {(r["row"], r["held"]) for r in index.check(table(spark, new), "row", "text").collect()}
    assert got == {p for p in brute(new, old)}


def test_components_are_settled_however_many_rounds_it_takes(spark, monkeypatch):
    monkeypatch.setattr(neardup, "range", lambda n: [0], raising=False)  # a bound on the rounds would end after the first
    chain = spark.createDataFrame([(i, i + 1) for i in (*range(0, 40, 2), *range(1, 40, 2))], "a long, b long")
    assert {r["component"] for r in neardup.connected(chain).collect()} == {0}
