"""Small cases of every operator: nulls, empty and long texts, ties, repeats, clashing names."""

import base64
import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from strata.llm import (bpe, components, decontaminate, exact_dedup, html_blocks, sharding,
                        simhash, substring_dedup, suffix_dedup, toxicity, warc)
from strata.llm.common import ROW, ship_library

LONG = " ".join(f"word{i % 977} x{i}" for i in range(12_000))
TEXTS = [(0, "Same TEXT here"), (1, "same text here"), (2, None), (3, ""), (4, "ÀB c"),
         (5, "Àb c"), (6, "àb c"), (7, LONG), (8, LONG.upper()), (9, "one"), (10, " \t\n ")]


@pytest.fixture(scope="module")
def docs(spark):
    ship_library(spark)
    clash = "row struct<a:int>, key string, kept boolean, id string, text_sha256 int"
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", "named_struct('a', 1) row", "'k' key", "true kept",
                         "'i' id", "1 text_sha256"), clash


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_id(df, name="doc_id"):
    return {r[name]: r for r in df.collect()}


# --- exact dedup ------------------------------------------------------------------------

def test_exact_dedup_against_brute_force(docs):
    got = exact_dedup.annotate(docs[0]).select(F.col(ROW)["doc_id"].alias("doc_id"), "keep_id",
                                               "group_size", "kept", "text_sha256")
    groups = {}
    for i, t in TEXTS:
        groups.setdefault(lowered(t), []).append(i)
    for r in got.collect():
        members = groups[lowered(dict(TEXTS)[r.doc_id])]
        assert (r.keep_id, r.group_size, r.kept) == (max(members), len(members),
                                                     r.doc_id == max(members))
        assert r.text_sha256 == hashlib.sha256(lowered(dict(TEXTS)[r.doc_id]).encode()).hexdigest()


def test_exact_dedup_keeps_one_of_repeated_rows_and_all_columns(spark, docs, empty):
    twice = docs[0].union(docs[0])
    left = exact_dedup.drop_duplicates(twice)
    assert left.columns == docs[0].columns
    assert left.count() == len({lowered(t) for _, t in TEXTS})
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a")], "doc_id long, text string")
    assert [r.doc_id for r in exact_dedup.drop_duplicates(nulls).collect()] == [1]
    assert exact_dedup.annotate(empty).count() == 0


def test_exact_dedup_is_exact_with_a_full_filter(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "filter_bits", lambda rows: 1)
    assert exact_dedup.drop_duplicates(docs[0]).count() == len({lowered(t) for _, t in TEXTS})


def test_exact_dedup_deals_a_hot_text_out(spark, monkeypatch):
    rows = [(i, "Hot" if i % 3 else f"text {i // 6}") for i in range(1_500)] + [(None, "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    real, dealt = type(df).join, []

    def join(self, other, on=None, how=None):
        out = real(self, other, on, how)
        if "dealt" in self.columns:
            dealt.append(self)
        return out
    monkeypatch.setattr(type(df), "join", join)
    got = exact_dedup.annotate(df).select(F.col(ROW)["doc_id"].alias("doc_id"), "keep_id",
                                          "group_size", "kept").collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(-1 if i is None else i)
    for r in got:
        members = groups[lowered(dict(rows)[r.doc_id])]
        assert (r.keep_id, r.group_size, r.kept) == (max(members), len(members),
                                                     r.doc_id == max(members))
    # No part of the join by (text, part) holds much more than hot_rows rows.
    most = dealt[0].groupBy("sha", "dealt").count().agg(F.max("count")).first()[0]
    assert most < 2 * exact_dedup.hot_rows(len(rows)) < 1_000


# --- sharding ---------------------------------------------------------------------------

def test_sharding_law_key_places_and_growth(spark, docs, empty, tmp_path):
    owner = sharding.initial_map(5, 64)
    grown = sharding.grow(owner)
    assert {a for a, b in zip(owner, grown) if a != b} <= set(range(5))
    assert all(b == 5 for a, b in zip(owner, grown) if a != b)
    sizes = np.bincount(grown)
    assert sizes.max() - sizes.min() <= 1 + 64 // 6
    big = sharding.initial_map(5)
    path = str(tmp_path / "map")
    sharding.store_map(spark, path, 1, big)
    sharding.store_map(spark, path, 2, sharding.grow(big))
    args = sharding.load_map(spark, path, 1), sharding.load_map(spark, path, 2)
    rows = spark.range(2_000).selectExpr("id doc_id", "'same' text").unionByName(
        docs[0].selectExpr("cast(null as long) doc_id", "text"))
    got = sharding.place(rows, *args).collect()
    assert len(got) == 2_000 + len(TEXTS)
    for shard in range(5):
        places = sorted(r.slot for r in got if r.shard == shard)
        assert places == list(range(len(places)))
    assert all(r.grown_shard in (r.shard, 5) for r in got)
    # id and shard count decide: rows without an id share one shard
    assert len({(r.shard, r.grown_shard) for r in got if r.doc_id is None}) == 1
    assert sharding.place(empty, *args).count() == 0
    crc = {r.doc_id: (r["size"], r.text_crc32) for r in sharding.place(docs[0], *args).collect()}
    import zlib
    assert crc == {i: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                   for i, t in TEXTS}


def test_rebalance_evens_bytes_and_moves_little():
    owner = sharding.initial_map(4, 256)
    load = {s: 1 + (s % 7) * 10 for s in range(256)}
    load[3] = 500
    out = sharding.rebalance(owner, load)
    total = [sum(load[s] for s in range(256) if out[s] == k) for k in range(4)]
    assert max(total) - min(total) <= 0.02 * sum(total) / 4 + 60
    assert sharding.rebalance(out, load) == out


# --- WARC -------------------------------------------------------------------------------

def test_warc_round_trip_and_revisits(spark, tmp_path):
    ship_library(spark)
    big = "<p>é" + "x" * 200_000
    rows = [(1, "http://a/1", "a" * 100), (2, "http://a/ 2\n", "a" * 100), (3, None, "short"),
            (4, "u", "short"), (5, "u", None), (6, "u", big), (7, "u", big), (None, "u", big),
            (8, "u", "a\r\n\r\nb" * 40), (1, "again", "a" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "data", F.lit(1))
    chunks = warc.write_archive(pages)
    assert max(len(r.data) for r in chunks.collect()) <= warc.CHUNK_BYTES + 1024
    got = warc.read_records(chunks).collect()
    assert len(got) == len(rows)
    want = []
    for page, url, text in rows:
        raw = (text or "").encode()
        first = min((p for p, _, t in rows if t == text and p is not None), default=None)
        revisit = len(raw) >= 100 and page != first
        want.append((str(page) if page is not None else None, len(raw),
                     hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
                     str(first) if revisit else None))
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got), key=key) == sorted(want, key=key)
    # Each chunk carries the digest of the payload so far.
    mine = sorted((r for r in chunks.collect() if r.page_id == "6"), key=lambda r: r.chunk_no)
    assert len(mine) > 3
    for r in mine:
        assert r.payload_sha256 == hashlib.sha256(big.encode()[:r.payload_end]).hexdigest()
    path = str(tmp_path / "one.warc")
    warc.export_archive(chunks, mine[0].archive, path)
    stream = open(path, "rb").read()
    assert stream.startswith(b"WARC/1.1\r\n") and stream.endswith(b"\r\n\r\n")
    assert warc.read_records(warc.write_archive(pages.limit(0))).count() == 0


def test_warc_detects_damage(spark):
    ship_library(spark)
    pages = spark.createDataFrame([(1, "u", "z" * 500)], "page_id long, url string, html string")
    bad = warc.write_archive(pages).withColumn(
        "data", F.encode(F.regexp_replace(F.decode("data", "UTF-8"), "zzz$|zzz\r", "yyy"), "UTF-8"))
    broken = bad.withColumn("data", F.encode(F.translate(F.decode("data", "UTF-8"), "z", "y"),
                                             "UTF-8"))
    with pytest.raises(Exception, match="digest mismatch"):
        warc.read_records(broken).collect()


# --- decontamination --------------------------------------------------------------------

def brute_hits(text, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words, hit, ids = word.findall(lowered(text)), set(), set()
    for item, body in items:
        w = word.findall(lowered(body))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for s in range(len(words) - n + 1):
                if words[s:s + n] == w[k:k + n]:
                    hit |= set(range(s, s + n))
                    ids.add(str(item) if item is not None else "")
    return len(words), len(hit), sorted(ids)


def test_decontamination_against_brute_force(spark, docs, empty):
    rng = np.random.default_rng(5)
    vocabulary = ["a", "B", "ç", "d1"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, text(int(rng.integers(0, 16)))) for i in range(30)] + [(30, None), (31, "a!B"),
                                                                        (31, "b a"), (None, "d1")]
    many = [(100 + i, text(int(rng.integers(0, 60)))) for i in range(60)] + TEXTS[:7]
    df = spark.createDataFrame(many, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for r in decontaminate.annotate(df, bench).collect():
        found = sum(s.end - s.start for s in r.spans)
        assert (r.n_words, found, r["items"]) == brute_hits(r[ROW].text, items), r[ROW].text
    assert decontaminate.annotate(empty, bench).count() == 0
    none = decontaminate.annotate(docs[0], bench.limit(0))
    assert none.filter("size(spans) > 0").count() == 0


def test_decontamination_in_blocks_equals_one_block(spark, monkeypatch):
    ship_library(spark)
    rng = np.random.default_rng(8)
    text = lambda n: " ".join(rng.choice(["a", "B", "ç", "d1"], n))
    items = [(i, text(int(rng.integers(0, 16)))) for i in range(40)] + [(40, None)]
    many = [(i % 50, text(int(rng.integers(0, 60)))) for i in range(70)] + [(None, None), (None, "")]
    df = spark.createDataFrame([(*r, "k", [1]) for r in many], "doc_id long, text string, key string, spans array<int>")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    got = decontaminate.annotate(df, bench).collect()
    assert len(got) == len(many) and decontaminate._blocks(bench, "item_id", "text")[1] > 5
    for r in got:
        found = sum(s.end - s.start for s in r.spans)
        assert (r.n_words, found, r["items"]) == brute_hits(r[ROW].text, items) and r[ROW].key == "k"
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_decontamination_in_blocks_and_cleaning(spark, monkeypatch):
    ship_library(spark)
    passage = "one two three four five six seven eight nine ten eleven"
    df = spark.createDataFrame(
        [(1, f"Kept words before; {passage.upper()} (and many kept words after that, in full, "
             "so that most of it stays here)", 7), (2, passage, 7), (3, "clean text", 7),
         (4, None, 7)], "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, passage), (2, "other words " * 9)],
                                  "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40)
    got = by_id(decontaminate.clean(df, bench, length_col="n_chars"))
    assert set(got) == {1, 3, 4} and got[3].text == "clean text" and got[3].n_chars == 7
    assert got[1].text.startswith("Kept words before; ") and "EIGHT" not in got[1].text
    assert got[1].n_chars == len(got[1].text)


# --- BPE --------------------------------------------------------------------------------

def test_bpe_equals_tiktoken_and_round_trips(spark, docs, empty):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    reference = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    odd = ["<|endoftext|>", "it's we'll I'M", "a" * 700, " \n\n  x \t ", "²½ naïve 日本 😀",
           "\x1c\x1d a \x85b c", " a", "a ", "a  b", "a \n b", "x\0y z", "=" * 90 + " " * 40]
    rows = TEXTS + [(100 + i, t) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1))
    out = bpe.encode(df, path, pattern)
    for r in out.collect():
        want = reference.encode_ordinary(r[ROW].text or "")
        assert bytes(r.ids) == struct.pack(f"<{len(want)}I", *want)
        assert r.n_tokens == len(want) and bytes(r.decoded) == (r[ROW].text or "").encode()
    ids = out.select(F.col(ROW)["doc_id"].alias("doc_id"), "ids")
    for r in bpe.decode(ids, path, pattern).collect():
        assert bytes(r.decoded) == (dict(rows)[r[ROW].doc_id] or "").encode()
    assert bpe.encode(empty, path, pattern).count() == 0


@pytest.mark.parametrize("query_tokens", [bpe.QUERY_TOKENS, 40_000])
def test_bpe_long_matches_equal_tiktoken(query_tokens, monkeypatch):
    monkeypatch.setattr(bpe, "QUERY_TOKENS", query_tokens)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    own = bpe.Tokenizer(path, pattern)
    reference = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=own.ranks,
                                  special_tokens={})
    rng = np.random.default_rng(9)
    letters = lambda of, n: "".join(rng.choice(list(of), n))
    texts = ["a" * 100_000, "-" * 100_000, letters("ACGT", 100_000), "ab" * 40 + "c" * 65,
             letters("abcdefghijklmnopqrstuvwxyz", 2_000), letters("-=", 2_000), "日本語" * 500]
    texts += [letters("aeinorst", int(n)) for n in rng.integers(50, 200, 300)]
    for text, (ids, back) in zip(texts, own.encode(texts)):
        want = reference.encode_ordinary(text)
        assert ids == struct.pack(f"<{len(want)}I", *want) and back == text.encode()


# --- SimHash ----------------------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_components(values, bits):
    names = dict.fromkeys(values)
    parent = {v: v for v in names}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for a in names:
        for b in names:
            if bin(a ^ b).count("1") <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in names}


def test_fingerprints_against_brute_force(docs):
    for _, text in TEXTS:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("sphere_rows", [4_096, 20])
def test_components_against_brute_force(spark, sphere_rows, monkeypatch):
    ship_library(spark)
    monkeypatch.setattr(simhash, "SPHERE_ROWS", sphere_rows)
    rng = np.random.default_rng(3)
    values = [0]
    for seed in rng.integers(0, 1 << 63, 12).tolist() + [0, (1 << 64) - 1]:
        at = seed
        for _ in range(25):  # chains: neighbours link, the ends do not
            for bit in rng.integers(0, 64, int(rng.integers(1, 6))).tolist():
                at ^= 1 << bit
            values.append(at)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    want = brute_components(values, simhash.MAX_BITS)
    fps = spark.createDataFrame([(v,) for v in sorted(set(signed))], "fp long")
    edges = simhash.links(fps)
    assert edges.count() < 5 * 2 * len(set(values))
    got = {r.node: r.root for r in components.components(edges).collect()}
    groups, expected = {}, {}
    for v, s in zip(values, signed):
        groups.setdefault(got.get(s, s), set()).add(s)
        expected.setdefault(want[v], set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_near_duplicates_keep_one_of_a_group(spark, docs, empty):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(10, base), (11, base + " tail"), (5, base), (20, "other text entirely " * 9),
            (30, None), (31, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x"))
    got = by_id(simhash.near_duplicates(df), "id")
    assert got[10].component_id == got[11].component_id == got[5].component_id == 5
    assert got[31].component_id == 30 and got[30].fp == 0
    assert set(by_id(simhash.drop_near_duplicates(df))) == {5, 20, 30}
    assert simhash.near_duplicates(empty).count() == 0


def test_near_duplicates_keep_one_row_whatever_ids_repeat(spark):
    ship_library(spark)
    text = lambda k: " ".join(f"{k}{i}" for i in range(400))
    a, b, c, d = map(text, "abcd")
    rows = [(1, a), (2, a + " tail"), (2, b),                  # a clean row beside a copy's id
            (None, c), (None, c + " tail"), (None, c),         # only null ids
            (7, d + " tail"), (7, d), (7, d), (None, d),       # least id on several rows
            (9, "alone and short"), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("k"))
    left = simhash.drop_near_duplicates(df)
    assert left.columns == df.columns
    want = [(1, a), (2, b), (None, c), (7, d), (9, "alone and short")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)


# --- repeats ----------------------------------------------------------------------------

def repeat_rows():
    rng = np.random.default_rng(11)
    words = [f"{a}{b}" for a in ("ba", "é", "ko", "zu") for b in ("n", "rt", "")]
    text = lambda n: " ".join(rng.choice(words, n))
    passage, line = text(45), text(22)
    rows = list(TEXTS)
    for i in range(40):
        parts = [text(int(rng.integers(0, 50)))]
        if i % 3 == 0:
            parts.append(passage)
        if i % 2 == 0:
            parts += [line, text(5), line]
        rows.append((100 + i, " ".join([*parts, text(int(rng.integers(0, 30)))])))
    return rows + [(200, "a" * 300), (201, "a" * 120 + "b"), (202, rows[-1][1]), (None, passage)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


@pytest.mark.parametrize("shard_bytes, hot", [(1 << 20, 2_000), (2_000, 2_000), (2_000, 2)])
def test_byte_repeats_against_brute_force(spark, shard_bytes, hot):
    ship_library(spark)
    rows = repeat_rows()
    first, want = {}, {}
    for i, text in in_order(rows):
        raw = (text or "").encode()
        rank = -1 if i is None else i
        gone = bytearray(len(raw))
        for s in range(len(raw) - 49):
            if first.setdefault(raw[s:s + 50], rank) < rank:
                gone[s:s + 50] = b"\1" * 50
        want[i] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))),
                   bytes(b for b, g in zip(raw, gone) if not g))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit(1))
    got = suffix_dedup.dedup(df, shard_bytes=shard_bytes, hot_pieces=hot)
    for r in got.collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.id], r.id
        assert r.kept_sha256 == hashlib.sha256(want[r.id][3]).hexdigest()
    assert suffix_dedup.dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2_000])
def test_word_repeats_against_brute_force(spark, shard_bytes):
    ship_library(spark)
    rows = repeat_rows()
    seen, want = set(), {}
    for i, text in in_order(rows):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        gone = [0] * len(words)
        for s in range(len(words) - 19):
            key = tuple(words[s:s + 20])
            if key in seen:
                gone[s:s + 20] = [1] * 20
            seen.add(key)
        want[i] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit(1))
    for r in substring_dedup.dedup(df, shard_bytes=shard_bytes).collect():
        assert (r.n_words, r.n_removed, r.kept.encode()) == want[r.id], r.id
        assert r.kept_sha256 == hashlib.sha256(want[r.id][2]).hexdigest()
    assert substring_dedup.dedup(df.limit(0)).count() == 0


def test_merge_equals_one_sort():
    rng = np.random.default_rng(2)
    groups = [["".join(rng.choice(list("ab"), int(rng.integers(50, 70)))).encode()
               for _ in range(6)] for _ in range(4)]
    groups[2] += groups[0][:2]
    ranks = [[10 * k + j for j in range(len(g))] for k, g in enumerate(groups)]
    least = {}
    for g, r in zip(groups, ranks):
        for s, d in zip(g, r):
            for i in range(len(s) - 49):
                least[s[i:i + 50]] = min(d, least.get(s[i:i + 50], d))
    for g, r, flags in zip(groups, ranks, suffix_dedup.repeats(groups, ranks)):
        want = [int(least[s[i:i + 50]] < d) for s, d in zip(g, r) for i in range(len(s) - 49)]
        assert flags.tolist() == want


@pytest.mark.parametrize("pass_bytes", [1, 700, 1 << 16])
def test_merge_costs_the_same_per_byte_for_many_small_shards(monkeypatch, pass_bytes):
    """One string a shard, as at large inputs: shards share the sorts, with the same result."""
    rng = random.Random(pass_bytes)
    texts = ["".join(rng.choice("ab") for _ in range(58)).encode() for _ in range(12)]
    groups = [[rng.choice(texts)[rng.randrange(5):] + rng.choice([b"", b"a", b"ba"])] for _ in range(400)]
    ranks = [[rng.randrange(300)] for _ in groups]
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(suffix_dedup, "_PASS_BYTES", pass_bytes, raising=False)
    monkeypatch.setattr(np, "argsort", lambda *a, **kw: sorts.append(1) or argsort(*a, **kw))
    got = suffix_dedup.repeats(groups, ranks)
    monkeypatch.undo()
    least: dict[bytes, int] = {}
    for (s,), (d,) in zip(groups, ranks):
        for i in range(len(s) - 49):
            least[s[i:i + 50]] = min(d, least.get(s[i:i + 50], d))
    for (s,), (d,), flags in zip(groups, ranks, got):
        assert flags.tolist() == [int(least[s[i:i + 50]] < d) for i in range(len(s) - 49)]
    assert len(sorts) < 40 or pass_bytes < 1 << 16


# --- HTML -------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<script>var t="</p><article>no</article>";</script><nav><ul><li><a href="/a>b">Home</a></li></ul></nav>
<header>Site name</header><div id="cookie-banner">We use cookies to make this site better for you
and for everyone else who reads it.</div><!-- <p>no</p> --><article><h1>A &amp; B</h1>
<p>First <b>bold</b>ly   said&nbsp;&mdash; caf&eacute;, with <a href="x">a link</a>.<p>Second
paragraph &#60;here&#x3E;<br>next line</p><div class="ad">Buy now</div><form><p>Your mail</p></form>
<p>Last.</p></article><aside><p>Side note that is long enough to look like some real text.</p></aside>
<section class="comments"><p>I think that this article is quite good and I would read it again.</p>
</section><footer>&copy; Example, all rights reserved, in all countries of the world.</footer>"""


def test_html_main_text(spark):
    ship_library(spark)
    tree = html_blocks.train(spark)
    want = "A & B First boldly said — café, with a link. Second paragraph <here> next line Last."
    cases = {1: (PAGE, want), 2: (PAGE[:PAGE.rindex("</article>")], want), 3: (None, ""),
             4: ("", ""), 5: ("<article><p>Cut in a tag <b class=", "Cut in a tag"),
             6: ("<article><p>One &am", "One &am"), 7: ("<article>" + "<p>w x</p>" * 5_000,
                                                        " ".join(["w x"] * 5_000))}
    df = spark.createDataFrame([(i, "u", h) for i, (h, _) in cases.items()],
                               "page_id long, main_text string, html string")
    for r in html_blocks.extract(df.union(df), tree).collect():
        assert r.main_text == cases[r[ROW].page_id][1], r[ROW].page_id
    assert html_blocks.extract(df.limit(0), tree).count() == 0


BODY = " ".join(["The old bridge over the river was closed on Monday after a long inspection."] * 3)
OTHER = "A reader writes that this was all quite clear to anyone who had walked there before."
TEMPLATES = {
    "body class": ("<body class='single-post no-sidebar'><article><p>{}</p></article>", BODY),
    "main class": ("<main class='has-share-buttons'><p>{}</p></main>", BODY),
    "article class": ("<article class='post tags-news widget'><p>{}</p></article>", BODY),
    "wrapper": ("<div class='post tags-news'><div id='with-sidebar'><p>{}</p></div></div>", BODY),
    "named wrapper": ("<div class='widget'><article><p>{}</p></article></div>", BODY),
    "form wrapper": ("<form id=aspnet><main><p>{}</p></main></form>", BODY),
    "sidebar": ("<article><p>{}</p></article><div class='sidebar widget-area'><p>" + OTHER
                + "</p></div>", BODY),
    "inside": ("<article><p>{}</p><div class='newsletter-box'><p>" + OTHER + "</p></div></article>",
               BODY),
    "comments": ("<main><p>{}</p><div id='comments'><article class='comment'><p>" + OTHER
                 + "</p></article></div></main>", BODY),
    "open head": ("<html><head><title>Site</title><meta charset=utf-8><body><article><p>{}</p>"
                  "</article>", BODY),
    "open head, no body": ("<head><title>Site</title><link rel=x><main><p>{}</p></main>", BODY),
    "open title": ("<head><title>Site</head><body><main><p>{}</p></main>", BODY),
    "parts": ("<article><p>{}</p><figure><img src=x><figcaption>The bridge in May.</figcaption>"
              "</figure><p>So <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds.</p>"
              "<p>Press <button>Start</button> now.</p></article>",
              BODY + " The bridge in May. So a=2 holds. Press Start now."),
}


TEMPLATES |= {
    **{f"named {name}": (f"<article><p>{{}}</p><div class='{name}'><p>{OTHER}</p></div><p>It ends here.</p></article>",
                         BODY + " It ends here.")
       for name in ("user-comments", "reader_responses", "c-adslot", "alert", "comment-list-wrap", "js-advert-top")},
    "denied names": ("<div class='comments-open has-comments no-adverts'><article><p>{}</p></article></div>", BODY),
    "plain divs": ("<div><a href=/>Home</a> <a href=/n>News</a></div><div><h1>Bridge</h1><p>{}</p><p>Why now?</p>"
                   "<p>" + OTHER + "</p><p>It opens again.</p><p>{}</p></div><div>7 likes</div><div><a>Share</a></div>",
                   f"Bridge {BODY} Why now? {OTHER} It opens again. {BODY}"),
    "plain paragraphs": ("<a href=/>Home</a><h2>On foot</h2><p>{}</p><p>Really?</p><p>{}</p><div><a>Next</a></div>"
                         "<div>Imprint</div>", f"On foot {BODY} Really? {BODY}"),
    "plain links": ("<div><p>{}</p><p>Yes.</p><p>{}</p></div><ul><li><a>Ten things to see in the old town</a></li>"
                    "<li><a>How it was built</a></li></ul>", f"{BODY} Yes. {BODY}"),
}


def test_the_tree_splits_on_neighbours(spark):
    def splits(tree):
        return set() if tree[0] == "leaf" else {tree[0]} | splits(tree[2]) | splits(tree[3])
    used = {html_blocks.FEATURES[i] for i in splits(html_blocks.train(spark))}
    assert used & {"words_before", "words_after"} and used & {"words"}


def test_html_of_other_templates(spark):
    ship_library(spark)
    tree = html_blocks.train(spark)
    df = spark.createDataFrame([(n, t.format(BODY, BODY)) for n, (t, _) in TEMPLATES.items()],
                               "name string, html string")
    got = {r[ROW].name: r.main_text for r in html_blocks.extract(df, tree).collect()}
    assert got == {n: want for n, (_, want) in TEMPLATES.items()}


# --- toxicity ---------------------------------------------------------------------------

def test_toxicity_learns_scores_and_ignores_held_out_labels(spark, empty):
    ship_library(spark)
    rng = np.random.default_rng(4)
    words = ["calm", "river", "stone", "you", "tree", "walk", "green", "light"]
    rows, labels = [], []
    for i in range(1_500):
        toxic = i % 6 == 0
        text = list(rng.choice(words, int(rng.integers(5, 40))))
        if toxic:
            text += [f"zorgle{rng.choice(list('abcdefgh'))}"] * 2 + ["you"]
        rows.append((i, " ".join(text), "row"))
        labels.append((i, int(toxic)))
    rows += [(5_000, None, "row"), (5_001, "", "row"), (5_002, "zorglex you " * 3_000, "row")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    table = spark.createDataFrame(labels + [(7, None), (None, 1)], "doc_id long, toxic int")
    got = {r[ROW].doc_id: r for r in toxicity.Model(docs, table).score(docs).collect()}
    assert len(got) == len(rows)
    held = [i for i, _ in labels if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == dict(labels)[i] for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[5_000].predicted == got[5_001].predicted == 0 and got[5_002].predicted == 1
    # Held-out labels turned round change nothing.
    turned = spark.createDataFrame([(i, 1 - t if i in set(held) else t) for i, t in labels],
                                   "doc_id long, toxic int")
    again = {r[ROW].doc_id: r["score"]
             for r in toxicity.Model(docs, turned).score(docs).collect()}
    assert again == {i: r["score"] for i, r in got.items()}
    few = toxicity.Model(docs, table.limit(0)).score(docs.limit(9))
    assert few.count() == 9
    assert toxicity.Model(empty, table.limit(0)).score(empty).count() == 0


# --- pipeline ---------------------------------------------------------------------------

def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline
    from strata.llm.common import stored, table

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), "test-stage")
        assert docs.columns == columns, name
        assert 0.5 * n < docs.count() <= n
        n = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(last) == n
    for r in last:
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
