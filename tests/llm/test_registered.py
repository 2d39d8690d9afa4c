"""The registered queries and the whole pipeline on planted tables, row by row against plain Python."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import decontaminate, simhash, toxicity
from strata.llm.common import ROW, ship_library
from strata.llm.registry import QUERIES
from strata.session import scratch_path
from tests.llm.test_operators import (brute_components, brute_fingerprint, brute_hits, in_order, lowered)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, "
          "text_sha256 int, `key` boolean")


def planted():
    """Documents with copies, near copies, toxic texts, test items, repeated passages and odd rows."""
    pick = random.Random(23)
    words = [f"{a}{b}{c}" for a in ("ba", "ko", "zu", "é", "li") for b in ("n", "rt", "sk", "m")
             for c in ("a", "o", "um", "ir")] + ["you", "The", "A", "漢字"]

    def text(n):
        return " ".join(pick.choices(words, k=n))

    items = [(i, text(14)) for i in range(6)] + [(6, None), (7, "two words"), (8, "")]
    rows, labels, i = [], [], 0

    def add(t):
        nonlocal i
        i += 3
        rows.append((i, t))
        return i

    for n in range(420):
        toxic = n % 6 == 0
        t = text(pick.randint(25, 60))
        if toxic:
            t += " you " + " ".join(pick.choices(["zorgle", "zorgling", "vrask"], k=4)) + "!"
        labels.append((add(t), int(toxic)))
    plain = [t for _, t in rows if "zorgl" not in t and "vrask" not in t]
    for n in range(12):
        add(plain[n])                                    # exact copies
        add(plain[n + 20].upper())                       # equal but for case
        add(plain[n + 40] + " " + text(1))               # near copies
    passage = text(26)
    for n in range(8):
        add(text(20) + " " + passage + " " + text(15))   # shared passage
        add(text(30) + "; " + items[n % 6][1] + ". " + text(30))  # a test item inside
    for n in range(4):
        add(text(3) + " " + items[n][1])                 # mostly a test item: goes whole
    for t in (None, "", " \t\n", "one", "two words here", "x" * 3000, text(6000)):
        add(t)
        add(t)
    out = [(d, t, "en", "s", len(t or ""), "r", 1, True) for d, t in rows]
    out.append((None, text(30), None, None, None, None, None, None))
    out.append((None, text(31), None, None, None, None, None, None))
    other = text(33)
    out.append((out[3][0], other, "en", "s", len(other), "r", 1, True))  # an id twice, with another text
    out += out[5:8]                                      # whole rows twice
    return out, labels, items


@pytest.fixture(scope="module")
def tables(spark):
    ship_library(spark)
    rows, labels, items = planted()
    folder = scratch_path(spark, "t-planted")
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, t) for d, t in labels], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, labels, items


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_op3_byte_repeats(spark, tables):
    folder, rows, _, _ = tables
    first, want = {}, []
    for r in in_order([r[:2] for r in rows]):
        raw, rank = (r[1] or "").encode(), -1 if r[0] is None else r[0]
        gone = bytearray(len(raw))
        for s in range(len(raw) - 49):
            if first.setdefault(raw[s:s + 50], rank) < rank:
                gone[s:s + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        want.append((r[0], len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    got = rows_of(QUERIES["op3_suffix_dedup"](spark, folder), "doc_id", "n_bytes", "n_removed", "n_spans",
                  "kept_sha256")
    assert got == sorted(want, key=repr)


def tokens(text):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    import base64
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if not hasattr(tokens, "made"):
        tokens.made = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                        special_tokens={})
    ids = tokens.made.encode_ordinary(text or "")
    return len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(text or "")


def test_op6_byte_bpe(spark, tables):
    folder, rows, _, _ = tables
    got = rows_of(QUERIES["op6_byte_bpe"](spark, folder), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((r[0], *tokens(r[1])) for r in rows), key=repr)


def simhash_groups(rows):
    """Row numbers by component of their fingerprints."""
    prints = [brute_fingerprint(r[1]) for r in rows]
    root = brute_components(prints, simhash.MAX_BITS)
    groups = {}
    for n, p in enumerate(prints):
        groups.setdefault(root[p], []).append(n)
    return prints, list(groups.values())


def test_op7_simhash(spark, tables):
    folder, rows, _, _ = tables
    prints, groups = simhash_groups(rows)
    want = []
    for group in groups:
        least = min((rows[n][0] for n in group if rows[n][0] is not None), default=None)
        want += [(rows[n][0], f"{prints[n]:016x}", least) for n in group]
    got = rows_of(QUERIES["op7_simhash"](spark, folder), "doc_id", "fingerprint", "component_id")
    assert got == sorted(want, key=repr)


def test_op8_toxicity(spark, tables):
    folder, rows, labels, _ = tables
    got = QUERIES["op8_toxicity"](spark, folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    toxic = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) / len(held) > 0.95


def test_op9_word_repeats(spark, tables):
    folder, rows, _, _ = tables
    seen, want = set(), []
    for doc_id, text in in_order([r[:2] for r in rows]):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        gone = [0] * len(words)
        for s in range(len(words) - 19):
            key = tuple(words[s:s + 20])
            if key in seen:
                gone[s:s + 20] = [1] * 20
            seen.add(key)
        want.append((doc_id, len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    got = rows_of(QUERIES["op9_substring_dedup"](spark, folder), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(want, key=repr)


def test_op10_sharding(spark, tables):
    folder, rows, _, _ = tables
    got = QUERIES["op10_sharding"](spark, folder).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert {r.law for r in got} == {"key"} and {r.shard for r in got} <= set(range(40))
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    places = {}
    for r in got:
        assert r.grown_shard in (r.shard, 40)  # one more shard takes rows only into itself
        if r.doc_id is not None:
            assert places.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)


def cut_items(text, items):
    """(text without the hit words and what stands between them, or None if it goes whole, was it cut)"""
    at = [m.span() for m in WORD.finditer(lowered(text))]
    words = [lowered(text)[a:b] for a, b in at]
    hit = [False] * len(words)
    for _, item in items:
        w = WORD.findall(lowered(item))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for s in range(len(words) - n + 1):
                if words[s:s + n] == w[k:k + n]:
                    hit[s:s + n] = [True] * n
    assert sum(hit) == brute_hits(text, items)[1]
    if sum(hit) > decontaminate.MAX_COVERAGE * len(words):
        return None, True
    kept, last = "", 0
    for n, (a, b) in enumerate(at):
        if hit[n] and (n == 0 or not hit[n - 1]):
            kept += text[last:a]
        if hit[n]:
            last = b
    return (kept + text[last:] if any(hit) else text), any(hit)


def test_pipeline_equals_plain_python(spark, tables):
    folder, rows, labels, items = tables
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    scored = toxicity.Model(documents, spark.read.parquet(f"{folder}/labels.parquet")).score(documents)
    clean = [tuple(r[ROW]) for r in scored.filter("predicted = 0").collect()]
    toxic = {d for d, t in labels if t}
    assert len(clean) < len(rows) and sum(r[0] in toxic for r in clean) < 0.1 * len(toxic)

    # exact copies: the largest id stays, null ids least; of equal rows any one
    groups = {}
    for r in clean:
        groups.setdefault(lowered(r[1]), []).append(r)
    unique = [max(g, key=lambda r: (r[0] is not None, r[0] or 0)) for g in groups.values()]
    # near copies: the least id stays, null ids last
    near = [min((unique[n] for n in g), key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
            for g in simhash_groups(unique)[1]]
    want = []
    for r in near:
        text, _ = (r[1], False) if r[1] is None else cut_items(r[1], items)
        if r[1] is None or text is not None:
            want.append((r[0], *tokens(text)))
    assert len(near) < len(unique) < len(clean) and len(want) < len(near)
    # Of equal texts whose ids differ in case only, either spelling has its own tokens: the row decides.
    got = rows_of(corpus_pipeline.run(spark, folder), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=repr)


def test_pipeline_stages_take_empty_and_odd_tables(spark, tables):
    folder, rows, _, _ = tables
    frame = spark.createDataFrame(rows[-60:], SCHEMA)
    for docs in (frame, frame.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns, name
            assert out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, frame.limit(0), folder)
    assert last.count() == 0 and "doc_id" in last.columns
    touched = corpus_pipeline.cut_benchmark(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert touched.filter(F.col("n_chars") != F.char_length(F.coalesce("text", F.lit("")))).count() == 0
