"""Fill-in-middle: brute force of the contract, exact restoration, bounded residuals."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import fim
from strata.llm.common import ROW, ship_library

TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text, key = text or "", "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    tokens = TOKENS.findall(text)
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def some_texts():
    pick = random.Random(5)
    parts = ["a", " ", "é", "\n", "bcd", "\x1f", "漢", "<", "P>", "<S", "> ", "x" * 400, " ", "𝄞"]
    made = ["".join(pick.choice(parts) for _ in range(pick.choice((1, 2, 9, 300)))) for _ in range(300)]
    return [*made, None, "", " ", "\t\n", "word", " lead", "trail ", "has <P> marker", "a<<S", "word " * 50_000]


@pytest.fixture(scope="module")
def df(spark):
    ship_library(spark)
    rows = [(None if i == 7 else i % 290, t) for i, t in enumerate(some_texts())]
    rows += rows[:3]  # repeated rows
    return rows, (spark.createDataFrame(rows, "doc_id long, text string")
                  .selectExpr("*", "1 AS n", "'x' AS form", "'y' AS output", "2 AS text_", "3 AS `row`"))


def test_transform_equals_brute_force_and_restores(df):
    rows, frame = df
    out = fim.transform(frame)
    got = out.select(F.col(f"{ROW}.doc_id").alias("i"), F.col(f"{ROW}.text").alias("t"),
                     F.col(f"{ROW}.n").alias("clash"), "n", "form", "prefix_chars", "middle_chars",
                     "output", fim.restore(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(got) == len(rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.i, r.t)
        assert r.back == (r.t or "") and r.clash == 1


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rank_index_is_exact_and_its_error_bounded():
    for texts in (some_texts(), ["x" * 1_000_000 + " y" * 10], [None], ["word lorem ip " * 30_000]):
        curve, tokens = fim.boundaries(pa.array(texts, pa.string()))
        index = fim.RankIndex(curve)
        assert tokens.tolist() == [len(TOKENS.findall(t or "")) for t in texts]
        assert (index.at(np.arange(len(curve))) == curve).all()
        assert index.residuals.dtype == np.int8
    assert len(index.first) < len(curve) / 1000  # regular text needs few segments
