"""Benchmark decontamination with a generalised suffix automaton of words.

All test items, normalised to words, go into one suffix automaton over words.
Streaming a document's words through it keeps, at every word, the length of
the longest match that ends there with any item; a length of WINDOW or more
means that the last WINDOW words are an item's window. The state that holds
the match names the items.

Words: A-Z lower-cased, runs of 0-9, a-z and non-ASCII characters. An item of
fewer than WINDOW words, but not none, is one window.

A benchmark of at most BLOCK_BYTES of text (its size is measured first) is one
broadcast automaton, through which documents stream without a shuffle. A larger
one is taken in blocks, one pass over the documents each, so that one automaton
at a time is resident in the driver and the workers; the passes' spans are
gathered by row and merged.

Defined results: null or empty text has no words and no hits; null or empty
items match nothing; a null item id counts as the empty id, repeated item ids
are one item; repeated documents are judged alike; empty tables give empty or
clean results; extra columns are carried unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import ROW, packed, stored

WINDOW = 10
BLOCK_BYTES = 2 << 20  # an automaton takes about a hundred times that
MAX_COVERAGE = 0.5

#: Byte table: A-Z lower-cased, every other ASCII byte that is no word byte becomes a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Automaton:
    """Suffix automaton of all items; ``need`` is the match length at which a state reports."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        n = len(self.next)
        self.windows: dict[int, set[str]] = {}
        self.shorts: dict[int, list[tuple[int, str]]] = {}
        for item, words in items:
            state = 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= window:
                    holder = state
                    while self.length[self.link[holder]] >= window:
                        holder = self.link[holder]
                    self.windows.setdefault(holder, set()).add(item)
            if 0 < len(words) < window:
                self.shorts.setdefault(state, []).append((len(words), item))
        never = 1 << 60
        self.need = [never] * n
        for state in sorted(range(1, n), key=self.length.__getitem__):
            own = [m for m, _ in self.shorts.get(state, ())]
            if state in self.windows:
                own.append(window)
            # What a shorter state reports is always matched in full here.
            self.need[state] = min([never, self.need[self.link[state]], *own])

    def _extend(self, last: int, w: bytes) -> int:
        known = self.next[last].get(w)
        if known is not None:
            return (known if self.length[known] == self.length[last] + 1
                    else self._clone(last, w, known))
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        at = last
        while at != -1 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at != -1:
            other = self.next[at][w]
            self.link[new] = (other if self.length[other] == self.length[at] + 1
                              else self._clone(at, w, other))
        return new

    def _clone(self, at: int, w: bytes, state: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[state]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[state])
        self.link[state] = copy
        while at != -1 and self.next[at].get(w) == state:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges [start, end), merged, and the ids of the items hit."""
        next_, link, length, need = self.next, self.link, self.length, self.need
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        state = matched = 0
        for i, w in enumerate(words):
            to = next_[state].get(w)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = next_[state].get(w)
            if to is None:
                continue
            state = to
            matched += 1
            if matched >= need[state]:
                self._report(state, matched, i + 1, found, items)
        return merged(found), items

    def _report(self, state: int, matched: int, end: int, found: list[tuple[int, int]],
                items: set[str]) -> None:
        while state > 0:
            if matched >= self.window and state in self.windows:
                found.append((end - self.window, end))
                items |= self.windows[state]
            for m, item in self.shorts.get(state, ()):
                if matched >= m:
                    found.append((end - m, end))
                    items.add(item)
            state = self.link[state]
            matched = min(matched, self.length[state])


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(block, item, text) and the number of blocks; a block holds about BLOCK_BYTES of text."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + total // BLOCK_BYTES
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count))), count


def _automaton(items: DataFrame, block: int, window: int):
    """The broadcast automaton of one block."""
    rows = items.filter(F.col("block") == block).collect()
    return items.sparkSession.sparkContext.broadcast(
        Automaton([(r.item, words_of(r.text)) for r in rows], window))


_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_FOUND = [StructField("n_words", LongType()), StructField("spans", ArrayType(_SPAN)),
          StructField("items", ArrayType(StringType()))]
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _spans_array(found: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": s, "end": e} for s, e in spans] for spans in found], _ARROW_SPANS)


def _judged(source: DataFrame, automaton, all_rows: bool = True) -> DataFrame:
    """``source`` is (kept column, text); the kept column, n_words, spans and items of every row,
    or of the rows that are hit."""
    kept = source.schema[0]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ranges, ids = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                found, items = automaton.value.spans(words)
                counts.append(len(words))
                ranges.append(found)
                ids.append(sorted(items))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), _spans_array(ranges),
                 pa.array(ids, pa.list_(pa.string()))],
                names=[kept.name, "n_words", "spans", "items"])
            yield out if all_rows else out.filter(pa.array([bool(r) for r in ranges], pa.bool_()))

    return source.mapInArrow(judge, StructType([kept, *_FOUND]))


def _in_blocks(source: DataFrame, items: DataFrame, blocks: int, window: int) -> DataFrame:
    """One block after the other: one automaton is resident at a time, in driver and workers."""
    rows = stored(source.withColumn("key", F.monotonically_increasing_id()), "decontaminate-rows")
    passes = []
    for block in range(blocks):
        automaton = _automaton(items, block, window)
        passes.append(stored(_judged(rows.select("key", "text"), automaton, all_rows=block == 0),
                             "decontaminate-hits"))
        automaton.destroy()
    found = passes[0]
    for more in passes[1:]:
        found = found.unionByName(more)
    # The first pass has every row once; the others add the spans of their blocks.
    gathered = found.groupBy("key").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = rows.select("key", ROW).join(gathered, "key").select(ROW, "n_words", "spans", "items")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [merged([(s["start"], s["end"]) for s in r]) for r in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _spans_array(spans), batch.column(3)],
                names=batch.schema.names)
    return joined.mapInArrow(merge, StructType([source.schema[ROW], *_FOUND]))


def annotate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text",
             window: int = WINDOW) -> DataFrame:
    """``row`` (the source row), n_words, spans (word ranges hit), items (ids, sorted).

    A benchmark beyond BLOCK_BYTES is taken in blocks, each over all documents.
    """
    items, blocks = _blocks(benchmark, item_col, item_text_col)
    source = packed(docs, text=F.col(text_col))
    if blocks == 1:
        return _judged(source, _automaton(items, 0, window))
    return _in_blocks(source, items, blocks, window)


def n_hit(spans="spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(raw.translate(_WORD_BYTES))]
    kept, last = [], 0
    for start, end in spans:
        kept.append(raw[last:at[start][0]])
        last = at[end - 1][1]
    return b"".join([*kept, raw[last:]]).decode("utf-8", "surrogatepass")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
          max_coverage: float = MAX_COVERAGE, length_col: str | None = None) -> DataFrame:
    """Documents without the hit spans, with the columns of the input.

    A document more than ``max_coverage`` of whose words are hit goes whole.
    ``length_col``, if given, is set to the characters that stay.
    """
    judged = annotate(docs, benchmark, text_col)

    @F.pandas_udf("string")
    def cut_spans(texts, spans):
        import pandas as pd

        return pd.Series([cut(t, [(s["start"], s["end"]) for s in r])
                          for t, r in zip(texts, spans)], dtype=object)

    kept = judged.filter(n_hit() <= F.col("n_words") * max_coverage)
    untouched = kept.filter(F.size("spans") == 0).select(f"{ROW}.*")
    touched = kept.filter(F.size("spans") > 0).select(
        ROW, cut_spans(F.col(ROW)[text_col], "spans").alias("cut"))
    shorter = F.col(ROW).withField(text_col, F.col("cut"))
    if length_col:
        kind = docs.schema[length_col].dataType
        shorter = shorter.withField(length_col, F.char_length("cut").cast(kind))
    return untouched.unionByName(touched.select(shorter.alias(ROW)).select(f"{ROW}.*"))
