"""Phrase collocation mining by vertical partitioning of the word suffixes.

Every word of a piece (a stretch without punctuation or line end) starts a
suffix, truncated to as many words as the longest phrase has. The suffixes are
dealt out by their first words, so that each group's suffix subtree fits a
memory budget:

1. Prefixes. Words are counted (per language). A word with more suffixes than
   the budget is extended by its next word and those pairs are counted, and so
   on. Prefixes within the budget, in lexicographic order, are put into groups
   of at most the budget by cutting the order where the running count fills up.
   An extension of full length is a leaf: its count is final and it needs no group.
2. Subtrees. A second reading sends every suffix to the group of its prefix,
   packed: a run of texts gives one sorted, pre-counted block a group. A group
   merges its blocks into the depth-truncated suffix subtree (sorted leaves;
   an inner node is a run of leaves with equal first words) and reads every
   phrase's count from its leaves' totals. No group needs another.
3. Scores. A cut of a phrase needs two more counts, which joins bring. Counts
   are exact decimals there, for products beyond 64 bits.

What the driver holds is bounded by words / budget: the prefixes over the
budget, and the cuts between groups. A word or pair that makes up a third of
the input is one of those prefixes, so no group and no join key exceeds its
bound: a join key with more than 1/HOT_SHARE of all words is joined from a
broadcast of at most HOT_SHARE rows a phrase length, and any other key has few
candidates.

Defined results: null text has no words; a null language is ``und``; repeated
rows count as often as they occur; ties are broken by count, then phrase; an
empty table gives an empty result; extra columns are not read. Counts must stay
below 10^16.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release_memory, stored
from .words import byte_table, slices, words_of

MIN_WORDS, MAX_WORDS = 2, 3
MIN_COUNT = 10
KEEP = 2000
#: A phrase goes if a longer one has at least this percentage of its occurrences.
COVERED_PERCENT = 50
SCALE = 1_000_000
GROUP_BYTES = 96 << 20
_SUFFIX_BYTES = 48  # of a suffix while its group is merged
HOT_SHARE = 10_000
MAX_PARTS = 256  # in which a language's phrases are ranked first
SLICE_BYTES = 8 << 20
UNKNOWN = "und"
_TABLE = byte_table(spaces=(0x20, 0x09), breaks=(*b".,;:!?", *range(0x0A, 0x0E)))

Prefix = tuple[bytes, ...]  # language, then words
COUNTED = "lang string, phrase string, n long"
BLOCKS = "part long, lang string, words binary, codes binary, counts binary"
NODES = "lang string, size int, phrase string, f long"


def _ranked(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values in byte order, and the rank of each."""
    order = pc.sort_indices(values).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return values.take(pa.array(order)), rank


def combine(columns: list[np.ndarray], sizes: list[int]) -> np.ndarray:
    """One integer a row that orders as the columns do."""
    key, span = columns[0], sizes[0]
    for column, size in zip(columns[1:], sizes[1:]):
        if span * size >= 1 << 62:
            distinct, key = np.unique(key, return_inverse=True)
            span = len(distinct)
        key, span = key * size + column, span * size
    return key


def _runs(sorted_key: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1])[:len(sorted_key)])


def _distinct(columns: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows in order, and how often each occurs."""
    key = combine(columns, sizes)
    if math.prod(sizes) >= 1 << 62:  # ranks were compressed: the key cannot be read back
        order = np.argsort(key)
        starts = _runs(key[order])
        return [c[order[starts]] for c in columns], np.diff(np.append(starts, len(key)))
    key.sort()
    starts = _runs(key)
    counts = np.diff(np.append(starts, len(key)))
    key, out = key[starts], []
    for size in reversed(sizes[1:]):
        key, last = np.divmod(key, size)
        out.append(last)
    return [key, *reversed(out)], counts


class Suffixes:
    """Distinct suffixes of a run of texts, cut to ``depth`` words, in order, with counts.

    ``columns`` is language and words as ranks into ``langs`` and (from 1) ``words``;
    0 is past the end of a piece.
    """

    def __init__(self, texts: pa.Array, langs: pa.Array, depth: int) -> None:
        found = words_of(texts, _TABLE)
        self.words, rank = _ranked(found.distinct)
        coded = pc.fill_null(langs, UNKNOWN).cast(pa.large_string()).cast(pa.large_binary())
        coded = coded.dictionary_encode()
        self.langs, lang_rank = _ranked(coded.dictionary)
        lang = lang_rank[coded.indices.to_numpy()]
        ids, piece, n = rank[found.ids] + 1, found.piece, len(found.ids)
        columns = [lang[found.text]]
        for d in range(depth):
            column = np.zeros(n, np.int64)
            if d < n:
                column[:n - d] = np.where(piece[d:] == piece[:n - d], ids[d:], 0)
            columns.append(column)
        self.sizes = [len(self.langs) + 1] + [len(self.words) + 1] * depth
        self.columns, self.counts = _distinct(columns, self.sizes)

    def keep(self, mask: np.ndarray) -> None:
        self.columns = [c[mask] for c in self.columns]
        self.counts = self.counts[mask]

    def begin_with(self, prefixes: set[Prefix]) -> np.ndarray:
        """Which suffixes begin with one of the prefixes (all of one length)."""
        if not prefixes or not len(self.counts):
            return np.zeros(len(self.counts), bool)
        listed = list(prefixes)
        length = len(listed[0])
        theirs = []
        for i in range(length):
            values = pa.array([p[i] for p in listed], pa.large_binary())
            at = pc.index_in(values, value_set=self.words if i else self.langs)
            theirs.append(pc.fill_null(at, -1).to_numpy().astype(np.int64) + (i > 0))
        known = np.logical_and.reduce([t >= (i > 0) for i, t in enumerate(theirs)])
        both = [np.append(c, t[known]) for c, t in zip(self.columns, theirs)]
        key = combine(both, self.sizes[:length])
        return np.isin(key[:len(self.counts)], key[len(self.counts):])

    def spelled(self, i: int) -> Prefix:
        return (self.langs[self.columns[0][i]].as_py(),
                *(self.words[c[i] - 1].as_py() for c in self.columns[1:] if c[i]))

    def phrases(self) -> pa.Array:
        """The words of full-length suffixes, joined by a space."""
        return _joined(self.words, self.columns[1:])


def _joined(words: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    parts = [words.take(pa.array(c - 1)) for c in columns]
    joined = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(
        *parts, pa.scalar(b" ", words.type))
    return joined.cast(pa.large_string()).cast(pa.string())


def _sources(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))


def _over_slices(rows: DataFrame, work, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES):
                yield from work(part.column(0), part.column(1))
        release_memory()
    return rows.mapInArrow(run, schema)


def _counts(rows: DataFrame, depth: int, under: set[Prefix]) -> DataFrame:
    """(lang, phrase, n) of all phrases of ``depth`` words, or only those under the prefixes."""
    def count(texts: pa.Array, langs: pa.Array) -> Iterator[pa.RecordBatch]:
        found = Suffixes(texts, langs, depth)
        keep = found.columns[depth] > 0
        if depth > 1:
            keep &= found.begin_with(under)
        found.keep(keep)
        lang = found.langs.take(pa.array(found.columns[0])).cast(pa.large_string())
        yield pa.RecordBatch.from_arrays(
            [lang.cast(pa.string()), found.phrases(), pa.array(found.counts, pa.int64())],
            names=["lang", "phrase", "n"])

    return (_over_slices(rows, count, COUNTED).groupBy("lang", "phrase")
            .agg(F.sum("n").alias("n")))


def _spell(lang: str, phrase: str) -> Prefix:
    return (lang.encode(), *phrase.encode().split(b" "))


def _cuts(light: DataFrame, budget: int, total: int) -> list[Prefix]:
    """The first prefix of every group after the first; no group exceeds the budget."""
    ordered = (light.withColumn("words", F.split("phrase", " "))
               .repartitionByRange(max(1, total // (4 * budget)), "lang", "words")
               .sortWithinPartitions("lang", "words").select("lang", "phrase", "n"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = budget  # a range begins a group
        for batch in batches:
            at = []
            for i, n in enumerate(batch.column(2).to_pylist()):
                filled += n
                if filled > budget:
                    filled = n
                    at.append(i)
            yield batch.take(pa.array(at, pa.int64()))

    found = ordered.mapInArrow(cut, COUNTED).select("lang", "phrase").collect()
    return sorted(_spell(*r) for r in found)[1:]


def _blocks(rows: DataFrame, depth: int, cuts: list[Prefix], over: list[set[Prefix]]) -> DataFrame:
    """Every suffix, packed, at the group of its prefix; ``over`` are the extended prefixes."""
    def pack(texts: pa.Array, langs: pa.Array) -> Iterator[pa.RecordBatch]:
        found = Suffixes(texts, langs, depth)
        for size, extended in enumerate(over, 1):  # counted: their leaves and their ends
            inside = found.begin_with(extended)
            found.keep(~(inside & ((size == depth - 1) | (found.columns[size + 1] == 0))))
        n = len(found.counts)
        if not n:
            return
        first, last = (bisect_left(cuts, found.spelled(i)) for i in (0, n - 1))
        edges = {0: 0}
        for group in range(max(0, first - 1), min(len(cuts), last + 1)):
            edges[bisect_left(range(n), cuts[group], key=found.spelled)] = 0
        edges = np.array(sorted({*edges, *_runs(found.columns[0]).tolist()} - {n}))
        out: dict[str, list] = {c: [] for c in ("part", "lang", "words", "codes", "counts")}
        for s, e in zip(edges, np.append(edges[1:], n)):
            codes = np.stack([c[s:e] for c in found.columns[1:]])
            used, codes = np.unique(np.append(0, codes.ravel()), return_inverse=True)
            spelled = found.words.take(pa.array(used[1:] - 1)).to_pylist()
            width = np.uint16 if len(used) <= 1 << 16 else np.uint32
            head = found.spelled(int(s))
            out["part"].append(bisect_left(cuts, head + (b"",)))
            out["lang"].append(head[0].decode())
            out["words"].append(b" ".join(spelled))
            out["codes"].append(codes[1:].astype(width).tobytes())
            out["counts"].append(found.counts[s:e].astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["part"], pa.int64()), pa.array(out["lang"], pa.string()),
             *(pa.array(out[c], pa.binary()) for c in ("words", "codes", "counts"))],
            names=list(out))

    return _over_slices(rows, pack, BLOCKS)


def _subtree(depth: int, min_count: int, extended: set[Prefix]):
    """A group's suffix subtree: the nodes with enough leaves, but for extended prefixes."""
    def run(blocks: pa.Table) -> pa.Table:
        found = [_nodes(blocks.filter(pc.equal(blocks["lang"], lang)), lang.as_py(), depth,
                        min_count, extended) for lang in blocks["lang"].unique()]
        release_memory()
        return pa.concat_tables(found)
    return run


def _nodes(blocks: pa.Table, lang: str, depth: int, min_count: int,
           extended: set[Prefix]) -> pa.Table:
    spelled = [b.as_py().split(b" ") for b in blocks["words"]]
    counts = np.concatenate([np.frombuffer(b.as_py(), np.uint32)
                             for b in blocks["counts"]]).astype(np.int64)
    coded = pa.array([w for words in spelled for w in words], pa.large_binary()).dictionary_encode()
    words, rank = _ranked(coded.dictionary)
    ranks = rank[coded.indices.to_numpy()] + 1
    columns: list[list[np.ndarray]] = [[] for _ in range(depth)]
    at = 0
    for text, codes in zip(spelled, blocks["codes"]):
        width = np.uint16 if len(text) + 1 <= 1 << 16 else np.uint32
        table = np.append(0, ranks[at:at + len(text)])
        at += len(text)
        for column, part in zip(columns, np.frombuffer(codes.as_py(), width).reshape(depth, -1)):
            column.append(table[part])
    del spelled
    flat = [np.concatenate(c) for c in columns]
    key = combine(flat, [len(words) + 1] * depth)
    order = np.argsort(key)
    starts = _runs(key[order])
    leaves, totals = order[starts], np.add.reduceat(counts[order], starts)
    flat = [c[leaves] for c in flat]
    out = []
    for size in range(1, depth + 1):
        starts = _runs(combine(flat[:size], [len(words) + 1] * size))
        f = np.add.reduceat(totals, starts)
        keep = (f >= min_count) & (flat[size - 1][starts] > 0)
        starts, f = starts[keep], f[keep]
        phrases = _joined(words, [c[starts] for c in flat[:size]])
        if extended:  # only part of such a node's leaves is here; its own count is known
            mine = {b" ".join(p[1:]).decode() for p in extended
                    if p[0].decode() == lang and len(p) == size + 1}
            keep = ~pc.is_in(phrases, value_set=pa.array(sorted(mine), pa.string())).to_numpy(
                zero_copy_only=False)
            phrases, f = phrases.filter(pa.array(keep)), f[keep]
        out.append(pa.table({"lang": pa.array([lang] * len(f), pa.string()),
                             "size": pa.array([size] * len(f), pa.int32()),
                             "phrase": phrases, "f": pa.array(f, pa.int64())}))
    return pa.concat_tables(out)


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  depth: int = MAX_WORDS, min_count: int = MIN_COUNT,
                  group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``depth`` words that occur at least ``min_count`` times
    (lang, size, phrase, f), and the number of words of every language (lang, n)."""
    rows = _sources(docs, text_col, lang_col)
    budget = max(1, group_bytes // _SUFFIX_BYTES)
    levels = [stored(_counts(rows, 1, set()), "phrases-1")]
    totals = stored(levels[0].groupBy("lang").agg(F.sum("n").alias("n")), "phrases-n")
    total = totals.agg(F.sum("n")).first()[0] or 0
    over = [{_spell(*r) for r in levels[0].filter(F.col("n") > budget)
             .select("lang", "phrase").collect()}] if depth > 1 else [set()]
    while over[-1] and len(levels) < depth:
        size = len(levels) + 1
        levels.append(stored(_counts(rows, size, over[-1]), f"phrases-{size}"))
        if size < depth:
            over.append({_spell(*r) for r in levels[-1].filter(F.col("n") > budget)
                         .select("lang", "phrase").collect()})
    whole = len(levels) == depth  # then the last level holds leaves, already counted
    inner = levels[:-1] if whole and depth > 1 else levels
    light = inner[0].filter(F.col("n") <= budget)
    for level in inner[1:]:
        light = light.unionByName(level.filter(F.col("n") <= budget))
    cuts = _cuts(light, budget, total)
    extended = set().union(*over)
    nodes = (_blocks(rows, depth, cuts, over if depth > 1 else []).groupBy("part")
             .applyInArrow(_subtree(depth, min_count, extended), NODES))
    for size, level in enumerate(levels, 1):
        final = level if whole and size == depth else level.filter(F.col("n") > budget)
        nodes = nodes.unionByName(
            final.filter(F.col("n") >= min_count)
            .select("lang", F.lit(size).alias("size"), "phrase", F.col("n").alias("f")))
    return stored(nodes, "phrases"), totals


def _with_count(cuts: DataFrame, part: str, name: str, counts: DataFrame,
                hot: DataFrame) -> DataFrame:
    """``cuts`` with the count of the phrase in ``part``, hot phrases joined by broadcast."""
    known = F.broadcast(hot.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"),
                                   F.col("f").alias(name)))
    same = (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_phrase"))
    seen = cuts.join(known, same, "left").drop("_lang", "_phrase")
    others = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"),
                           F.col("f").alias("_f"))
    rest = (seen.filter(F.col(name).isNull()).drop(name).join(others, same)
            .withColumnRenamed("_f", name).select(*seen.columns))
    return seen.filter(F.col(name).isNotNull()).unionByName(rest)


def _best(scored: DataFrame, keep: int) -> DataFrame:
    """Each language's ``keep`` best phrases, ranked. A large language's phrases first compete
    within parts, so no task ranks more than ``MAX_PARTS`` times ``keep`` of them at once."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]

    def top(df: DataFrame, keys: list[str]) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("rank", nth).filter(F.col("rank") <= keep)

    parts = min(MAX_PARTS, -(-scored.count() // (8 * keep)))
    if parts > 1:
        dealt = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
        scored = top(dealt, ["lang", "part"]).drop("part", "rank")
    return top(scored, ["lang"])


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
         min_words: int = MIN_WORDS, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
         keep: int = KEEP, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's ``keep`` best phrases."""
    counts, totals = phrase_counts(docs, text_col, lang_col, max_words, min_count, group_bytes)
    total = totals.agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("f") > total // HOT_SHARE)  # at most HOT_SHARE a phrase length
    candidates = (counts.filter(F.col("size") >= min_words)
                  .select("lang", "size", "phrase", F.col("f").alias("a"),
                          F.split("phrase", " ").alias("w")))
    inside = candidates.filter(F.col("size") > min_words).select(
        "lang", "a", F.explode(F.expr(
            f"flatten(transform(sequence({min_words}, size - 1), s -> "
            "transform(sequence(1, size - s + 1), i -> array_join(slice(w, i, s), ' '))))"))
        .alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    free = (candidates.join(longer, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * F.col("longest") < COVERED_PERCENT * F.col("a"), F.lit(True)))
            .select("lang", "size", "phrase", "a", "w"))
    cuts = free.select("lang", "phrase", "a", "w", "size",
                       F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(w, k + 1, size - k), ' ')").alias("rest"))
    both = _with_count(_with_count(cuts, "first", "l", counts, hot), "rest", "r", counts, hot)
    # Up to 10^16 each: a * a * SCALE and l * r fit 38 digits, and the division is integral.
    score = F.expr(f"({SCALE} * (cast(a as decimal(16, 0)) * cast(a as decimal(16, 0)))) div "
                   "(cast(l as decimal(16, 0)) * cast(r as decimal(16, 0)))")
    scored = (both.withColumn("score", score).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))
              .select("lang", "phrase", "a", "least.*"))
    ranked = _best(stored(scored, "phrases-scored"), keep)
    # At most ``keep`` rows a language are left here.
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
