"""Shared spans against every window of every text."""

import collections
import random

import pytest

from textmill.llm import sharedspans
from textmill.llm.sharedspans import Shared


def texts(seed):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefghنصم😀", k=r.randint(1, 7))) for _ in range(400)]
    make = lambda n: " ".join(r.choices(words, k=n))
    notice, passage = make(60), make(35)
    out = [f"{make(20)} {notice} {make(r.randint(0, 30))}" for _ in range(30)]  # one notice in a third of all texts
    out += [f"{make(r.randint(0, 9))}{passage}{make(9)}" for _ in range(6)]
    out += [make(r.randint(5, 80)) for _ in range(40)]
    out += [passage + passage, notice, notice, "z" * 1000, "z" * 400, "", None, "short", make(3000)]
    return out


@pytest.mark.parametrize("seed,hot", [(1, 5000), (2, 3)])
def test_brute(spark, seed, hot):
    t = texts(seed)
    n = 60
    where = collections.defaultdict(set)
    for i, x in enumerate(t):
        for k in range(len(x or "") - n + 1):
            where[x[k : k + n]].add(i)
    want = {(a, b) for s in where.values() if len(s) > 1 for a in s for b in s if a < b}
    df = spark.createDataFrame(list(enumerate(t)), "doc long, text string")
    s = Shared(df, "doc", "text", length=n, seed=24, hot=hot)
    got = s.pairs().collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    cover = {r["doc"]: r for r in s.coverage(df, "text").collect()}
    assert len(cover) == len(t)
    for i, x in enumerate(t):
        mark = bytearray(len(x or ""))
        for k in range(len(mark) - n + 1):
            if len(where[x[k : k + n]]) > 1:
                mark[k : k + n] = b"\1" * n
        assert cover[i]["shared_chars"] == sum(mark), i


def test_nothing(spark):
    df = spark.createDataFrame([], "doc long, text string")
    s = Shared(df, "doc", "text")
    assert s.pairs().count() == 0 and s.coverage(df, "text").count() == 0


@pytest.mark.parametrize("hot", [5000, 3])
def test_letters_decide_where_hashes_agree(spark, monkeypatch, hot):
    """With a hash that takes few values, on either side of the switch, the result is the same."""
    import numpy as np

    t = texts(5)[30:90]
    df = spark.createDataFrame(list(enumerate(t)), "doc long, text string")
    want = {tuple(r) for r in Shared(df, "doc", "text", length=60, seed=24).pairs().collect()}
    real = sharedspans.window_keys

    def few(strings, length):
        row, off, key = real(strings, length)
        return row, off, key % np.uint64(5)

    b, h = sharedspans._bucket_groups, sharedspans._hot_windows

    def patched(make):
        def made(length):
            run = make(length)

            def go(batches):
                from textmill.llm import sharedspans as m

                m.window_keys, kept = few, m.window_keys
                try:
                    yield from run(batches)
                finally:
                    m.window_keys = kept

            return go

        return made

    monkeypatch.setattr(sharedspans, "_bucket_groups", patched(b))
    monkeypatch.setattr(sharedspans, "_hot_windows", patched(h))
    assert {tuple(r) for r in Shared(df, "doc", "text", length=60, seed=24, hot=hot).pairs().collect()} == want and want


def test_groups_are_parted_by_letters():
    import numpy as np

    got = sharedspans.by_letters(np.array([0, 0, 0, 0, 1, 1]), ["a", "b", "a", "b", "a", "a"]).tolist()
    assert got[0] == got[2] != got[1] == got[3] and got[4] == got[5] not in got[:4]
