"""N-gram Jaccard join: components and set sizes against all pairs in plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import common, ngram_join
from strata.llm.common import ship_library

SCHEMA = "doc_id long, text string, n long, node string, digest int, x long"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def grams(text):
    words = lowered(text).encode().split()  # bytes: exactly 0x20, 0x09-0x0D
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3)))


def brute(rows):
    sets = [grams(text) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted(((row[0], len(s), least.get(find(i))) for i, (row, s) in enumerate(zip(rows, sets))),
                  key=repr)


def some_rows(families=12, members=25):
    pick = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "漢", "\x1f", "A", "a"]
    texts = [None, "", " \t\n", "one", "ONE", "one two three", "one two  three", "a b c d", "a b c d"]
    passage = pick.choices(vocabulary, k=60)
    for _ in range(families):
        base = pick.choices(vocabulary, k=pick.choice((5, 30, 120, 300)))
        texts.append(" ".join(base))
        for _ in range(pick.randint(0, members)):
            copy = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 20))):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            texts.append(" ".join(copy))
        texts.append(" ".join(base + passage))  # shares a passage with every other family
    texts += [texts[-1]] * 30
    texts.append("long " + " ".join(f"v{i % 5003}" for i in range(40_000)))
    texts.append(texts[-1].upper() + " tail")
    rows = [(i * 7 % 1009, t, 1, "c", 2, 3) for i, t in enumerate(texts)]
    rows[20] = (None, *rows[20][1:])
    rows[21] = (None, "all alone with a null id here", *rows[21][2:])
    return rows + rows[30:33]


@pytest.mark.parametrize("bits, load, hub_rows", [(22, 1 << 18, 4), (10, 40, 4), (6, 64, 10**9)])
def test_components_equal_brute_force(spark, monkeypatch, bits, load, hub_rows):
    ship_library(spark)
    monkeypatch.setattr(ngram_join, "HUB_ROWS", hub_rows)
    rows = some_rows()
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4),
                                     sketch_bits=bits, load=load)
    assert got.columns == ["id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_hot_keys_are_dealt_out(spark):
    many = spark.createDataFrame([(i % 3 and 1, i) for i in range(9000)], "k long, v long")
    one = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, w string")
    counts = many.groupBy("k").count()
    assert {r.hot_key: r.hot_parts for r in common.hot_parts(counts, "k", "count", 9000).collect()} == {0: 3, 1: 6}
    got = common.deal_join(many, one, "k", "v").collect()
    assert sorted((r.k, r.v, r.w) for r in got) == sorted(
        (i % 3 and 1, i, "ab"[i % 3 and 1]) for i in range(9000))


def test_blocks_meet_once_and_never_within_one_component():
    blocks = ngram_join.Blocks({5: 100, 9: 30}, 60, 20)
    nodes = np.arange(500)
    comps = np.where(nodes % 3 == 0, 5, np.where(nodes % 3 == 1, 9, nodes))
    mine = blocks.of(nodes, comps)
    met = set(blocks.pairs)
    for i in range(0, 500, 7):
        for j in range(i + 1, 500):
            if comps[i] != comps[j]:
                a, b = sorted((mine[i], mine[j]))
                assert (a, b) in met
    owner = {b: {int(c) if c in (5, 9) else None for c in comps[mine == b]} for b in set(mine)}
    assert all(len(o) == 1 for o in owner.values())
    assert not any(a != b and owner.get(a) == owner.get(b) == {5} for a, b in met)


def packed(nodes, comps, tokens, n=60, block=""):
    sizes = [len(t) for t in tokens]
    values = {"node": np.diff(nodes, prepend=0), "comp": np.array(comps) ^ np.array(nodes),
              "n": [n] * len(nodes), "start": [0] * len(nodes), "size": sizes, "side": [0] * len(nodes)}
    return pa.table({**{k: [np.array(values[k], kind).tobytes()] for k, kind in ngram_join._ARRAYS.items()},
                     "tokens": [np.concatenate(tokens).astype("<u8").tobytes()], "block": [block]})


def test_fragment_counts_every_shared_gram_of_fitting_pairs():
    tokens = [np.arange(10, dtype=np.uint64), np.arange(1, 11, dtype=np.uint64)]
    assert ngram_join.Fragment.packed(packed([8, 3], [8, 3], tokens), 85).pairs().to_pylist() == [
        {"x": 3, "y": 8, "nx": 60, "ny": 60, "c": 9}]


def test_only_grams_of_several_components_live():
    tokens = [np.array(t, np.uint64) for t in ([1, 2, 5], [1, 2, 7], [2, 7, 9], [5, 11])]
    live = ngram_join.Fragment.packed(packed([4, 6, 8, 9], [4, 4, 8, 4], tokens), 85).live(3)
    got = {r["node"]: (np.frombuffer(r["tokens"], "<u8").tolist(), np.frombuffer(r["positions"], "<i4").tolist())
           for r in live.to_pylist()}
    # 1 and 5 occur in component 4 alone
    assert got == {4: ([2], [1]), 6: ([2, 7], [1, 2]), 8: ([2, 7], [0, 1])}
    assert live["here"].to_pylist() == [1, 2, 2] and set(live["fragment"].to_pylist()) == {3}


def test_cuts_balance_whatever_the_hashes():
    loads = {7: 5, 8: 50, 9: 1, 1 << 12: 3, (1 << 12) + 1: 3}
    cuts = ngram_join._balanced_cuts(loads, 10, 44).tolist()
    place = [sum(c <= k << 44 for c in cuts) for k in sorted(loads)]
    held = [sum(n for p, (_, n) in zip(place, sorted(loads.items())) if p == i) for i in set(place)]
    assert held == [5, 50, 7]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.near_duplicates(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.near_duplicates(blank).collect()) == [
        (1, 0, 1), (2, 0, 2)]
