"""Operators on small tables against plain Python."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.operators import cleaning, dialect, drift, evaluation, features, feedback, pairing, scoring, similarity, splitting
from textmill.sources import files


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def slow_lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


def test_lcs_is_exact():
    r = random.Random(1)
    for _ in range(200):
        a, b = ("".join(r.choices("abcd", k=r.randint(0, 30))) for _ in range(2))
        assert similarity.lcs(a, b) == slow_lcs(a, b)
    assert round(similarity.ratio("abcde", "abXde"), 1) == 80.0 and similarity.ratio("", "") == 100.0


def test_fuzzy_keep_first_is_greedy(spark):
    r = random.Random(2)
    base = ["".join(r.choices("abcdefghij ", k=80)) for _ in range(12)]
    texts = list(base)
    for t in base:
        for _ in range(4):
            s = list(t)
            for _ in range(r.randint(1, 3)):
                s[r.randrange(len(s))] = r.choice("xyz")
            texts.append("".join(s))
    texts = list(dict.fromkeys(texts))
    kept = []
    for i, t in enumerate(texts):
        if all(similarity.ratio(texts[j], t) < 90 for j in kept):
            kept.append(i)
    got = similarity.fuzzy_keep_first(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), 0.9)
    assert sorted(x["id"] for x in got.collect()) == kept


def test_fuzzy_on_empty_and_single(spark):
    empty = spark.createDataFrame([], "id long, text string")
    assert similarity.fuzzy_keep_first(empty).count() == 0
    assert similarity.fuzzy_keep_first(spark.createDataFrame([(1, ""), (2, "a")], "id long, text string")).count() == 2


def test_insertion_only_pairs_are_all_found(spark):
    """Scattered insertions at 90 to 91 leave few trigrams alike; short texts, copies of a length and two tables too."""
    r = random.Random(7)
    texts = []
    for k in range(150):
        base = "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=r.randint(5, 900 if k < 15 else 180)))
        s = list(base)
        for _ in range(max(1, int(len(base) / 4.5))):
            s.insert(r.randrange(len(s) + 1), r.choice("xyz\u200b\u064b"))
        texts += [base, "".join(s)]
    texts = list(dict.fromkeys(["", *texts]))
    want = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if similarity.ratio(texts[i], texts[j]) >= 90}
    assert len(want) > 120
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert {(x["a"], x["b"]) for x in similarity.similar_pairs(df, 0.9).collect()} == want
    held = df.select(F.concat(F.lit("h"), F.col("id")).alias("id"), "text")
    both = want | {(j, i) for i, j in want} | {(i, i) for i in range(len(texts))}
    assert {(x["a"], int(x["b"][1:])) for x in similarity.overlapping(df, held, 0.9).collect()} == both


def test_blocks_meet_where_lengths_fit(monkeypatch, spark):
    monkeypatch.setattr(similarity, "BLOCK", 3)
    monkeypatch.setattr(similarity, "LEAST_BLOCK", 2)
    r = random.Random(8)
    texts = list(dict.fromkeys("".join(r.choices("ab", k=r.choice((9, 10, 10, 10, 11, 12)))) for _ in range(120)))
    want = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if similarity.ratio(texts[i], texts[j]) >= 90}
    got = [(x["a"], x["b"]) for x in similarity.similar_pairs(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), 0.9).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_keep_first_and_funnel(spark):
    df = spark.createDataFrame([(3, "a", "z"), (1, "a", "x"), (2, "b", "y")], "id long, text string, other string")
    assert rows(cleaning.keep_first(df, "text", "id")) == [(1, "a", "x"), (2, "b", "y")]
    f = cleaning.funnel(spark.createDataFrame([(1, "Some longer text"), (2, "some longer text"), (3, "hi"), (4, None)], "id long, t string"), "t", "id").first()
    assert tuple(f) == (4, 1, 1, 2, 1)


def test_pipeline_counts_every_step(spark):
    from textmill.plans import catalog

    data = [(1, "One longer text to keep"), (2, "one longer text to keep"), (3, "one longer text to keeps"), (4, "hi"), (5, "HI"), (6, None), (7, "something else altogether")]
    got = cleaning.pipeline(spark.createDataFrame(data, "id long, t string"), "t", "id").first().asDict()
    assert got == {"raw_rows": 7, "null_text": 1, "near_empty_flagged": 2, "exact_removed": 2, "near_removed": 1, "final_rows": 3}
    assert tuple(cleaning.pipeline(spark.createDataFrame([], "id long, t string"), "t", "id").first()) == (0,) * 6
    assert catalog.FLAGSHIP == "clean_pipeline_metrics" and catalog.FLAGSHIP in catalog.queries()


@pytest.mark.parametrize("text,want", [("انا عايز ده دلوقتي", "egyptian"), ("وايد زين هالحين", "gulf"), ("شو هيك بدي", "levantine"), ("واش بزاف مزيان", "maghrebi"), ("ana 3ayez", "arabizi"), ("هذا جيد", "msa"), (None, "msa")])
def test_dialects(spark, text, want):
    r = dialect.tagged(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert r["dialect"] == want and 0 <= r["dialect_confidence"] <= 1


def test_split_shares(spark):
    df = spark.createDataFrame([(i, "a" if i < 60 else "b" if i < 90 else "c") for i in range(100)], "id long, label string")
    n = dict(rows(splitting.stratified(df, "label", "id").groupBy("part").count()))
    assert abs(n["test"] - 20) <= 1 and abs(n["val"] - 10) <= 1 and sum(n.values()) == 100
    again = splitting.stratified(df.repartition(7), "label", "id")
    assert rows(again.select("id", "part")) == rows(splitting.stratified(df, "label", "id").select("id", "part"))


def test_ranks_follow_the_hash(spark):
    from textmill.functions.text import ordering_hash

    df = spark.createDataFrame([(i, "x" if i % 3 else "y") for i in range(500)], "id long, s string")
    got = splitting.ranked(df, "s", ordering_hash(1, F.col("id"))).withColumn("k", ordering_hash(1, F.col("id"))).collect()
    for s in "xy":
        part = sorted((r for r in got if r["s"] == s), key=lambda r: r["k"])
        assert [r["rank"] for r in part] == list(range(1, len(part) + 1))


@pytest.mark.parametrize("n", [0, 5, 70_000, 140_000])
def test_fingerprint_at_any_size(spark, n):
    """The plain sum while a long holds it; past 2**63 and 2**64 (about 65,536 and 131,072 rows) that sum in 64 bits."""
    df = spark.range(n).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("ن"), "id")).alias("text"))
    whole = sum(int(hashlib.sha256(f"{i}\x1f{f'ن{i}' if i % 3 else chr(0)}".encode()).hexdigest()[:12], 16) for i in range(n))
    assert (whole < 2**63) == (n < 65_000) and (whole < 2**64) == (n < 130_000)
    got = splitting.fingerprint(df, "id", "text")
    assert got.dtypes == [("rows", "bigint"), ("content", "bigint")]
    want = [(n, (whole + 2**63) % 2**64 - 2**63 if n else None)]
    assert rows(got) == rows(splitting.fingerprint(df.repartition(7, "text"), "id", "text")) == want
    if n:
        changed = df.withColumn("text", F.when(F.col("id") == n - 1, "other").otherwise(F.col("text")))
        assert rows(splitting.fingerprint(changed, "id", "text")) != want


def test_psi_against_numpy(spark):
    r = np.random.default_rng(3)
    a, b = r.normal(0, 1, 700), r.normal(0.5, 1.2, 600)
    data = [(True, float(x), "k" if x > 0 else "l") for x in a] + [(False, float(x), "k" if x > 0 else "l") for x in b]
    df = spark.createDataFrame(data, "ref boolean, v double, c string").withColumn("flat", F.lit(1.0)).withColumn("none", F.lit(None).cast("double"))
    got = {x["column"]: x for x in drift.psi(df, F.col("ref"), ["c"], ["v", "flat", "none"]).collect()}
    both = np.r_[a, b]
    k = math.ceil(math.log2(len(both))) + 1
    p, q = (np.histogram(x, bins=k, range=(both.min(), both.max()))[0] / len(x) for x in (a, b))
    keep = (p > 0) | (q > 0)
    p, q = np.maximum(p[keep], 1e-4), np.maximum(q[keep], 1e-4)
    assert got["v"]["score"] == pytest.approx(round(float(((p - q) * np.log(p / q)).sum()), 4), abs=2e-4)
    assert got["flat"]["decision"] == "SKIPPED" and got["none"]["decision"] == "SKIPPED" and got["c"]["decision"] != "SKIPPED"
    v = drift.verdict(spark.createDataFrame([("x", None, "SKIPPED")], "column string, score double, decision string")).first()
    assert v["overall"] == "SKIPPED" and v["drift_share"] == 0.0


def test_total_variation(spark):
    df = spark.createDataFrame([(True, "a")] * 8 + [(True, "b")] * 2 + [(False, "a")] * 2 + [(False, "b")] * 8, "r boolean, c string")
    assert drift.total_variation(df, F.col("r"), "c").first()["tvd"] == 0.6


def test_rolling(spark):
    df = spark.createDataFrame([(f"2026-01-{i:02d}", 0.8 + i % 3 / 100) for i in range(1, 11)], "day string, mean double").withColumn("day", F.to_date("day"))
    z = [r["z_score"] for r in drift.rolling_confidence(df).orderBy("day").collect()]
    assert z[:7] == [None] * 7 and z[7] is not None


def test_evaluation(spark):
    r = random.Random(5)
    data = [(r.choice("abc"), r.choice("abc"), r.choice("xy")) for _ in range(300)]
    df = spark.createDataFrame(data, "t string, p string, g string")
    o = evaluation.overall(df, "t", "p").first()
    assert o["accuracy"] == pytest.approx(sum(a == b for a, b, _ in data) / 300, abs=1e-6)
    f1 = [2 * sum(a == b == c for a, b, _ in data) / (sum(a == c for a, _, _ in data) + sum(b == c for _, b, _ in data)) for c in "abc"]
    assert o["f1_macro"] == pytest.approx(sum(f1) / 3, abs=1e-6)
    assert sum(r["n"] for r in evaluation.confusion(df, "t", "p", ("a", "b", "c")).collect()) == 300
    assert evaluation.overall(spark.createDataFrame([("a", "a", "x")], "t string, p string, g string"), "t", "p", "g").first()["accuracy"] is None


def test_metric_diff(spark):
    base = spark.createDataFrame([("p", "a", 1.0), ("p", "b", 2.0), ("p", "c", 3.0)], "path string, metric string, value double")
    work = spark.createDataFrame([("p", "a", 1.001), ("p", "b", 2.5), ("q", "a", 1.0), ("p", "d", 1.0)], "path string, metric string, value double")
    got = {(r["path"], r["metric"]): r["status"] for r in evaluation.metric_diff(base, work).collect()}
    assert got == {("p", "a"): "ok", ("p", "b"): "changed", ("p", "c"): "removed", ("p", "d"): "added", ("q", "a"): "new_path"}


def test_votes(spark):
    data = [("t", "a1", "positive"), ("t", "a2", "positive"), ("t", "a2", "positive"), ("t", "a3", "negative"), ("u", "a1", "positive"), ("u", "a1", "negative"), ("v", "a1", "neutral")]
    df = feedback.keyed(spark.createDataFrame(data, "text string, agent_id string, corrected_label string"))
    assert rows(feedback.votes(df)) == [("t", 3, 3, "positive", "a1;a2"), ("u", 1, 0, "", ""), ("v", 1, 1, "", "")]


def test_merge_is_idempotent(spark):
    schema = ", ".join(f"{c} string" for c in feedback.MERGED)
    held = spark.createDataFrame([tuple("old" if c == "text" else "x" for c in feedback.MERGED)], schema)
    new = spark.createDataFrame([("old", "n", "1", "a"), ("new", "n", "2", "b"), (" new", "m", "1", "c"), ("OLD ", "n", "1", "d")], "text string, label string, captured_at string, override_id string")
    once = feedback.merged(held, new)
    assert [tuple(r) for r in once.where("text <> 'old'").select("text", "label", "company").collect()] == [(" new", "m", "")] and rows(feedback.merged(once, new)) == rows(once)


def test_capped(spark):
    df = spark.createDataFrame([("neutral", i) for i in range(5)] + [("positive", 9), (None, 8)], "label string, o int")
    assert feedback.capped(df, "label", "neutral", 2, ["o"]).count() == 4
    assert feedback.capped(df, "label", "neutral", -1, ["o"]).count() == 7


def test_pairs(spark):
    ev = [("a", "stable", "x", 0), ("a", "candidate", "x", 5), ("b", "candidate", "x", 1), ("b", "stable", "y", 2), ("c", "stable", "x", 0), ("d", "stable", "x", 0), ("d", "candidate", "x", 99), ("", "stable", "x", 0)]
    df = spark.createDataFrame(ev, "key string, worker string, label string, s int").withColumn("ts", F.timestamp_seconds("s"))
    assert rows(pairing.pairs(df)) == [("a", "agree"), ("b", "disagree"), ("c", "gap_candidate"), ("d", "gap_candidate")]


def test_softmax_and_first_of_ties(spark):
    df = spark.createDataFrame([(0.4, 0.4, 0.2)], "positive double, negative double, neutral double")
    assert scoring.with_decision(df).first()["predicted_label"] == "positive"
    got = spark.range(1).select(scoring.softmax(F.array(F.lit(1000.0), F.lit(1001.0)))).first()[0]
    assert got[1] == pytest.approx(1 / (1 + math.exp(-1)))


def test_scorer_must_answer_every_text(spark):
    df = spark.createDataFrame([("a",), (None,)], "t string").coalesce(1)
    with pytest.raises(Exception, match="scorer gave"):
        scoring.scored(df, "t", lambda: (lambda texts: np.ones((1, 3)))).collect()


def test_projection_matches_svd(spark):
    m = np.random.default_rng(4).normal(size=(60, 6)) * [3, 2, 1, 1, 1, 1] + 5
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(m)], "id long, e array<double>")
    basis = features.fit_basis(df, "e", 2, encoder="x", max_length=8, pooling="mean")
    got = np.array([[r["embedding_pc1"], r["embedding_pc2"]] for r in features.project(df, "e", basis).orderBy("id").collect()])
    c = m - m.mean(axis=0)
    want = c @ np.linalg.svd(c, full_matrices=False)[2][:2].T
    assert np.allclose(abs(got), abs(want), atol=1e-6)
    assert features.fit_basis(df, "e", 99).components.__len__() == 6
    assert basis.incompatibility("x", 9, "mean")[0] and basis.incompatibility("y", 8, "mean") == (None, "encoder y is not x")


def test_oov(spark):
    vocab = spark.createDataFrame([("good",), ("bad",)], "word string")
    df = spark.createDataFrame([(1, "good odd bad new"), (2, ""), (3, None)], "id long, t string")
    assert rows(features.oov_rate(df, "id", "t", vocab).select("id", "tokens", "oov_rate", "oov_bucket")) == [(1, 4, 0.5, "high"), (2, 0, 0.0, "none"), (3, 0, 0.0, "none")]


def test_csv_round_trip(spark, tmp_path):
    data = [("1", 'He said "no"\nand left, twice', ""), ("2", " padded ", "NA"), ("3", "نص", "nan")]
    df = spark.createDataFrame(data, "a string, b string, c string")
    files.write_csv_sorted(df, str(tmp_path / "x"), ("a", "b", "c"), "a")
    assert rows(files.read_csv_strings(spark, str(tmp_path / "x"), ("a", "b", "c"))) == sorted(data)
    assert files.read_csv_strings(spark, str(tmp_path / "nothing"), ("a",)).count() == 0
    with pytest.raises(ValueError, match="missing columns: z"):
        files.read_csv(spark, str(tmp_path / "x"), "a string, z string")


def test_reports(spark, tmp_path):
    (tmp_path / "2026-01-02.json").write_text('{"overall": "PASS", "n": 3}')
    (tmp_path / "2026-01-03.json").write_text('{"overall": "FAIL", "n": 4}')
    (tmp_path / "2026-01-01.json").write_text("{broken")
    r = files.read_json_reports(spark, str(tmp_path), "overall string, n int")
    assert r.count() == 3 and files.newest(r).first()["report"]["overall"] == "FAIL"
    cal = files.calendar(spark, [{"name": "x", "date": "2026-11-01"}, {"name": "y"}, "bad", {"name": "z", "rule": "black_friday", "confirmed": True}])
    assert rows(cal.select("name")) == [("x",), ("y",), ("z",)] and files.calendar(spark, None).count() == 0
    assert "| a |" in files.markdown(spark.createDataFrame([(1,)], "a int"))


def test_percentiles(spark):
    v = [float(x) for x in np.random.default_rng(6).exponential(size=101)]
    r = evaluation.percentiles(spark.createDataFrame([(x, "g") for x in v], "v double, g string"), "v", "g").first()
    assert (r["p50"], r["p95"], r["p99"]) == tuple(round(float(x), 6) for x in np.percentile(v, [50, 95, 99]))


def test_all_pairs_of_small_ints_have_a_ratio():
    assert all(0 <= similarity.ratio(str(a), str(b)) <= 100 for a, b in itertools.combinations(range(50), 2))


def test_written_tables_and_cleaning(spark):
    from textmill.sources import store

    df = store.written(spark.range(5), "t")
    assert df.count() == 5 and store.clean(spark) and not store.clean(spark)
    assert store.written(spark.range(3), "t").count() == 3
