"""Toxicity scores: gradient-boosted trees over dense features, isotonically calibrated.

Features of a text: densities of a seed lexicon and of a lexicon learned from
labelled rows (words and word beginnings), nearness of second-person words to
lexicon hits, capitals, punctuation, and obfuscation (letters joined by digits
or symbols). Labels, language, source and id are no inputs.

Labelled rows are split by crc32(id as text) mod FOLDS: remainder 0 is held out
and never read; 1 and 2 teach the lexicon, 3 the trees, 4 the calibration. At
most MAX_LABELLED_ROWS labelled rows (by hash order of the id) are used: that
bounds the sample. Every document is scored, over its whole text.

Defined results: null text counts as empty and is scored like any text without
words; a null label is ignored; an id labelled twice counts as toxic if at
least half its labels say so; repeated rows get equal scores; with fewer than
MIN_CLASS_ROWS rows of a class the seed lexicon's rule alone gives the score;
an empty table gives an empty result; extra columns are carried unchanged.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import ROW, packed, release_memory, stored
from .decontaminate import words_of

FOLDS = 5
LEXICON_FOLDS, TREE_FOLD, CALIBRATION_FOLD = (1, 2), 3, 4
MAX_LABELLED_ROWS = 60_000
MIN_CLASS_ROWS = 5
LEXICON_SIZE = 2_000
MIN_EVIDENCE = 1.0  # least lower bound of a term's log-odds
PREFIX_BYTES = range(4, 10)  # lengths of the word beginnings that are learned
NEAR_WORDS = 3

#: Common English insults; further terms are learned.
SEED_LEXICON = frozenset(w.encode() for w in (
    "idiot idiots stupid moron morons loser losers pathetic worthless trash scum disgusting "
    "clown dumb fool ugly hate garbage filth jerk liar ignorant creep").split())
SECOND_PERSON = frozenset(w.encode() for w in (
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous "
    "votre vos usted ustedes vosotros ti tus").split())
_LEET = bytes.maketrans(b"013457@$!", b"oieastasi")
_OBFUSCATED = re.compile(rb"[a-z]+(?:[0-9@$!*.+_-]+[a-z]+)+")
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
FEATURES = ("words", "seed", "learned", "learned_best", "begun", "begun_best", "evidence", "hits",
            "second", "near", "capitals", "shouting", "punctuation", "exclamation", "obfuscated", "masked")

Lexicon = dict[bytes, float]


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")),
                  F.lit(FOLDS))


Judged = tuple[bool, float, float]  # in the seed lexicon, weight of word, of its beginning
_NOTHING: Judged = (False, 0.0, 0.0)
MEMO_WORDS = 150_000


class Judge:
    """What the lexicons say of a word; bounded memory of the words seen before."""

    def __init__(self, terms: Lexicon, prefixes: Lexicon) -> None:
        self.terms, self.prefixes = terms, prefixes
        self.memo: dict[bytes, Judged | None] = {}

    def __call__(self, w: bytes) -> Judged | None:
        begun = max((self.prefixes.get(w[:n], 0.0) for n in PREFIX_BYTES if n < len(w)),
                    default=0.0)
        found = (w in SEED_LEXICON, self.terms.get(w, 0.0), begun)
        if len(self.memo) >= MEMO_WORDS:
            self.memo.clear()
        out = self.memo[w] = None if found == _NOTHING else found
        return out


def features(text: str | None, judge: Judge) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = words_of(text)
    n, size = max(len(words), 1), max(len(raw), 1)
    memo = judge.memo
    found = [memo[w] if w in memo else judge(w) for w in words]
    hits = [i for i, f in enumerate(found) if f is not None]
    seed = sum(found[i][0] for i in hits)
    learned = [found[i][1] for i in hits if found[i][1]]
    begun = [found[i][2] for i in hits if found[i][2]]
    evidence = sum({words[i]: max(found[i][1:]) for i in hits}.values())
    near = sum(any(w in SECOND_PERSON for w in words[max(0, i - NEAR_WORDS):i + NEAR_WORDS + 1])
               for i in hits)
    second = sum(w in SECOND_PERSON for w in words)
    capitals = size - len(raw.translate(None, _UPPER)) if raw else 0
    shouting = sum(len(w) > 2 and w.isupper() for w in raw.split()) if capitals > 0.1 * size else 0
    odd = masked = 0
    for token in _OBFUSCATED.findall(raw.lower()):
        plain = token.translate(_LEET, b"*.+_-")
        odd += 1
        masked += (memo[plain] if plain in memo else judge(plain)) is not None
    punctuation = size - len(raw.translate(None, _PUNCTUATION)) if raw else 0
    return [math.log1p(len(words)), seed / n, len(learned) / n, max(learned, default=0.0),
            len(begun) / n, max(begun, default=0.0), math.log1p(evidence), math.log1p(len(hits)),
            second / n,
            near / n, capitals / size, shouting / n, punctuation / size, raw.count(b"!") / size,
            odd / n, masked / n]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word and each beginning of a word (marked by ^), by label."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            words = set(words_of(text.as_py()))
            counts[label].update(words)
            counts[label].update({b"^" + w[:n] for w in words for n in PREFIX_BYTES
                                  if n < len(w)})
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([counts[0][t] for t in names], pa.int64()),
             pa.array([counts[1][t] for t in names], pa.int64())],
            names=["term", "clean", "toxic"])
    release_memory()


def learn_lexicon(rows: DataFrame) -> tuple[Lexicon, Lexicon]:
    """Words and word beginnings whose log-odds of toxicity are surely high.

    ``rows`` has text and label. Equal texts count once, so copies of one text
    do not make its words toxic. At most LEXICON_SIZE terms reach the driver.
    """
    once = rows.groupBy("text").agg(F.max("label").alias("label"))
    once = stored(once, "toxicity-lexicon-rows")
    sizes = {r.label: r["count"] for r in once.groupBy("label").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if min(n_clean, n_toxic) < MIN_CLASS_ROWS:
        return {}, {}
    counts = (once.mapInArrow(_term_counts, "term binary, clean long, toxic long")
              .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .filter("toxic > 1"))
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(t / (n_toxic + 1.0 - t)) - F.log(c / (n_clean + 1.0 - c))
    least = odds - 2 * F.sqrt(1 / t + 1 / c)
    found = (counts.select("term", least.alias("weight")).filter(F.col("weight") >= MIN_EVIDENCE)
             .orderBy(F.desc("weight"), "term").limit(LEXICON_SIZE).collect())
    terms = {bytes(r.term): r.weight for r in found if not r.term.startswith(b"^")}
    return terms, {bytes(r.term)[1:]: r.weight for r in found if r.term.startswith(b"^")}


def with_features(df: DataFrame, text: Column, lexicon: tuple[Lexicon, Lexicon],
                  **extra: Column) -> DataFrame:
    """``row``, the extra columns and ``values``, the dense features."""
    shared = df.sparkSession.sparkContext.broadcast(lexicon)
    source = packed(df, text=text, **extra)
    names = [ROW, *extra, "values"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(*shared.value)
        for batch in batches:
            dense = np.array([features(t.as_py(), judge) for t in batch.column(1)])
            flat = pa.array(dense.reshape(-1), pa.float64())
            ends = np.arange(len(batch) + 1, dtype=np.int32) * len(FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:],
                 pa.ListArray.from_arrays(pa.array(ends), flat)], names=names)
        judge.memo.clear()
        release_memory()

    schema = StructType([source.schema[ROW], *[source.schema[n] for n in extra],
                         StructField("values", ArrayType(DoubleType()))])
    return source.mapInArrow(run, schema)


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                  label_col: str) -> DataFrame:
    """(text, fold, label) of the bounded labelled sample; no held-out row is read."""
    votes = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("labelled_id"))
             .agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
             .withColumn("fold", fold(F.col("labelled_id"))).filter("fold <> 0"))
    sample = votes.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(MAX_LABELLED_ROWS)
    texts = docs.select(F.col(id_col).alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return stored(texts.join(F.broadcast(sample), F.col("id") == F.col("labelled_id"))
                  .select("text", "fold", "label"), "toxicity-labelled")


class Model:
    """Lexicon, trees and calibration; ``score`` adds score to a frame's rows."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "toxic") -> None:
        self.text_col = text_col
        rows = labelled_rows(docs, labels, id_col, text_col, label_col)
        self.lexicon = learn_lexicon(rows.filter(F.col("fold").isin(*LEXICON_FOLDS)))
        seen = stored(with_features(
            rows.filter(F.col("fold").isin(TREE_FOLD, CALIBRATION_FOLD)),
            F.col("text"), self.lexicon,
            fold=F.col("fold"), label=F.col("label").cast("double")).drop(ROW),
            "toxicity-features").withColumn("features", array_to_vector("values"))
        sizes = {(r.fold, int(r.label)): r["count"]
                 for r in seen.groupBy("fold", "label").count().collect()}
        self.trees = self.calibration = None
        if min(sizes.get((f, c), 0) for f in (TREE_FOLD, CALIBRATION_FOLD)
               for c in (0, 1)) < MIN_CLASS_ROWS:
            return
        self.trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.3, seed=7,
                                   minInstancesPerNode=2).fit(seen.filter(F.col("fold") == TREE_FOLD))
        raw = self._raw(seen.filter(F.col("fold") == CALIBRATION_FOLD))
        self.calibration = IsotonicRegression(featuresCol="raw", predictionCol="calibrated").fit(raw)

    def _raw(self, df: DataFrame) -> DataFrame:
        out = self.trees.transform(df)
        return out.withColumn("raw", vector_to_array("probability")[1])

    def score(self, df: DataFrame) -> DataFrame:
        """``row`` (the source row), score, predicted."""
        dense = with_features(df, F.col(self.text_col), self.lexicon)
        if self.trees is None:
            score = 1 - F.exp(-20 * F.col("values")[FEATURES.index("seed")])
        else:
            dense = self.calibration.transform(
                self._raw(dense.withColumn("features", array_to_vector("values"))))
            score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated")))
        return dense.select(ROW, score.alias("score")).withColumn(
            "predicted", (F.col("score") >= 0.5).cast("int"))
