"""Phrase mining against plain Python, over memory budgets small and large."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import phrases
from strata.llm.common import ship_library

SCHEMA = "lang string, text string, n long, phrase string, part string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, keep=2000, longest=3, least=10):
    f, n = Counter(), Counter()
    for lang, text, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) >= 2 and a >= least}
    covered = Counter()
    for (lang, w), a in found.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                covered[lang, w[i:i + size]] = max(covered[lang, w[i:i + size]], a)
    out = {}
    for (lang, w), a in found.items():
        if 100 * covered[lang, w] >= 50 * a:
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]],
                                         f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:keep], 1))


def some_rows():
    pick = random.Random(2)
    words = ["the", "of", "The", "x\x01", "x", "é", "漢字", "a-b", "new", "york", "city", "\x00"]
    weights = [30, 12, 6, 4, 9, 3, 3, 2, 8, 8, 8, 1]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", ",", "? "]
    rows = [(pick.choice(["en", "fr", None]),
             "".join(w + pick.choice(ends) for w in pick.choices(words, weights, k=pick.randint(0, 60))))
            for _ in range(400)]
    rows += [("en", "new york city " * 200), ("en", None), (None, ""), ("de", "..."),
             ("only", "one two three. " * 12), ("fr", "the " * 3000)]
    return [(*r, 7, "p", "q") for r in rows + rows[:5]]


@pytest.mark.parametrize("budget", [96 << 20, 48 * 700, 48 * 60])
def test_mining_equals_brute_force(spark, budget):
    ship_library(spark)
    rows = some_rows()
    got = phrases.mine(spark.createDataFrame(rows, SCHEMA).repartition(5), group_bytes=budget)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_distinct_rows_whether_or_not_ranks_fit_one_integer():
    columns = [np.array([1, 0, 1, 1, 0]), np.array([5, 2, 5, 3, 2]), np.array([0, 9, 0, 9, 9])]
    for sizes in ([2, 10, 10], [2, 1 << 40, 1 << 40]):
        rows, counts = phrases._distinct([c.copy() for c in columns], sizes)
        assert list(zip(*[r.tolist() for r in rows])) == [(0, 2, 9), (1, 3, 9), (1, 5, 0)]
        assert counts.tolist() == [2, 1, 2]


def test_ranking_in_parts(spark, monkeypatch):
    rows = [("en" if i % 3 else "fr", f"p{i}", i * 7 % 50, i % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, score long")
    want = []
    for lang in ("en", "fr"):
        mine = sorted((-s, -a, p) for l, p, a, s in rows if l == lang)[:6]
        want += [(lang, p, i) for i, (_, _, p) in enumerate(mine, 1)]
    assert sorted((r.lang, r.phrase, r["rank"]) for r in phrases._best(df, 6).collect()) == sorted(want)


@pytest.mark.parametrize("longest", [2, 4])
def test_other_lengths_and_limits(spark, longest):
    rows = some_rows()
    got = phrases.mine(spark.createDataFrame(rows, SCHEMA), max_words=longest, keep=9,
                       group_bytes=48 * 100)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 9, longest)


def test_groups_stay_within_the_budget(spark):
    rows = some_rows()
    df = phrases._sources(spark.createDataFrame(rows, SCHEMA), "text", "lang")
    words = phrases._counts(df, 1, set()).collect()
    budget = 700
    over = {phrases._spell(r.lang, r.phrase) for r in words if r.n > budget}
    assert over
    pairs = phrases._counts(df, 2, over)
    light = (phrases._counts(df, 1, set()).filter(f"n <= {budget}")
             .union(pairs.filter(f"n <= {budget}")))
    cuts = phrases._cuts(light, budget, sum(r.n for r in words))
    load = Counter()
    for r in light.collect():
        load[sum(c <= phrases._spell(r.lang, r.phrase) for c in cuts)] += r.n
    assert len(load) > 2 and max(load.values()) <= budget


def test_large_counts_stay_exact(spark):
    a, l, r = 999_999_999_999_937, 1_000_000_000_000_037, 2_000_000_000_000_003
    counts = spark.createDataFrame([("en", 2, "x y", a), ("en", 1, "x", l), ("en", 1, "y", r)],
                                   phrases.NODES)
    totals = spark.createDataFrame([("en", l + r)], "lang string, n long")
    original, phrases.phrase_counts = phrases.phrase_counts, lambda *_: (counts, totals)
    try:
        row = phrases.mine(None).first()
    finally:
        phrases.phrase_counts = original
    assert (row.score, row.n) == (1000000 * a * a // (l * r), l + r)


def test_empty_table(spark):
    assert phrases.mine(spark.createDataFrame([], "lang string, text string")).count() == 0
