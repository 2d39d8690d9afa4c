"""Byte-level BPE encoding and decoding with DuckDB recursive queries per partition.

In every Spark task, texts are split by the tokenizer's pattern; the distinct
words that are not known yet become rows (word, pos, token) of a DuckDB
recursive query. Each round joins adjacent tokens to the merge table and
contracts, in every word, the leftmost pair of least rank, until no pair of a
word can merge. Decoding joins ids to the vocabulary and concatenates the token
bytes by an ordered aggregation.

A word of more than LONG_WORD bytes would need as many rounds as bytes. For such
words a round contracts all pairs whose turn is certain:
* every pair of the word's least rank, from left to right, without overlap;
* every pair (a, b) that no neighbour can take apart first: no token that ends in
  the token before a joins a, and no token that begins with the token after b
  joins b, at the pair's rank or a lower one.
Both hold only where the new token cannot at once join a neighbour at a lower rank;
the leftmost pair of least rank is contracted in any case, and pairs of least rank
after one that could are left to the next round.

Encoded pieces are kept during a task, about CACHE_CHUNKS of them.
WORDS_PER_QUERY and QUERY_TOKENS bound what the rounds of a query add up to; a
query over long words stops there, and the next one goes on from its last rows.
So memory grows with the longest match of the pattern, not with its square, nor
with the input.
Text goes through in whole, one batch after the other; nothing is shuffled.

Defined results: null counts as empty text (no ids, empty bytes); special
tokens are ordinary text; repeated rows are encoded alike; an empty table
gives an empty result; extra columns are carried unchanged.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import ROW, packed, release_memory

CACHE_CHUNKS = 200_000
WORDS_PER_QUERY = 100_000
LONG_WORD = 64
QUERY_TOKENS = 4_000_000
DUCKDB_MEMORY = "300MB"  # a worker's limit; queries are sized to stay well below
LONG_TOKENS = 250_000
SLICE_BYTES = 4 << 20

#: The pattern of the public byte-level vocabularies: no match of it reaches over a
#: single space from left to right, so its texts can be cut before such spaces.
_SPACED_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                   r"|\s+(?!\S)|\s+")
_WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def _has_space_run(text: str) -> bool:
    """A space beside other white space, where a match may reach over the space."""
    return any(w in text and (" " + w in text or w + " " in text) for w in _WHITE)


_ENCODE = """
WITH RECURSIVE state(word, tokens) AS (
    SELECT word, tokens FROM start
    UNION ALL
    SELECT word, list_concat(list_append(tokens[:p - 1], (best >> 32)::INT), tokens[p + 2:])
    FROM (SELECT word, s.tokens, best, (best & 4294967295)::INT AS p
          FROM state s
          JOIN (SELECT word, min(m.merged::BIGINT << 32 | pos) AS best
                FROM (SELECT word, unnest(range(1, len(tokens))) AS pos,
                             unnest(tokens[:-2]) AS a, unnest(tokens[2:]) AS b FROM state)
                JOIN merges m ON m.pair = a::BIGINT << 32 | b
                GROUP BY word) USING (word)))
SELECT word, tokens FROM state
"""
_ENCODE_LONG = """
WITH RECURSIVE state(word, round, tokens) AS (
    SELECT word, 0, tokens FROM start
    UNION ALL
    SELECT word, round + 1,
           list(CASE WHEN picked THEN merged ELSE a END ORDER BY pos) FILTER (NOT taken)
    FROM (SELECT word, round, pos, a, merged, picked,
                 lag(picked, 1, false) OVER (PARTITION BY word ORDER BY pos) AS taken
          FROM (SELECT *, coalesce(alone OR pos = leftmost & 4294967295 OR turn
                    AND pos < coalesce(min(CASE WHEN turn AND NOT safe THEN pos END)
                                       OVER (PARTITION BY word), pos + 1), false) AS picked
                FROM (SELECT *, merged = leftmost >> 32 AND (pos - coalesce(
                          max(CASE WHEN merged IS DISTINCT FROM leftmost >> 32 THEN pos END)
                              OVER (PARTITION BY word ORDER BY pos), 0)) % 2 = 1 AS turn
                      FROM (SELECT p.word, round, pos, a, merged, safe,
                                   safe AND (l.least IS NULL OR merged < l.least)
                                        AND (r.least IS NULL OR merged < r.least) AS alone,
                                   min(merged::BIGINT << 32 | pos) OVER (PARTITION BY word)
                                       AS leftmost
                            FROM (SELECT p.*, m.merged, m.twin_safe
                                      AND (l.least IS NULL OR m.merged < l.least)
                                      AND (r.least IS NULL OR m.merged < r.least) AS safe
                                  FROM (SELECT word, round,
                                               unnest(range(1, len(tokens) + 1)) AS pos,
                                               unnest(list_prepend(NULL, tokens[:-2])) AS before,
                                               unnest(tokens) AS a, unnest(tokens[2:]) AS b,
                                               unnest(tokens[3:]) AS after
                                        FROM state WHERE round < $rounds) p
                                  LEFT JOIN long_merges m ON m.pair = a::BIGINT << 32 | b
                                  LEFT JOIN lefts l ON l.pair = before::BIGINT << 32 | m.merged
                                  LEFT JOIN rights r ON r.pair = m.merged::BIGINT << 32 | after) p
                            LEFT JOIN lefts l ON l.pair = before::BIGINT << 32 | a
                            LEFT JOIN rights r ON r.pair = b::BIGINT << 32 | after))))
    GROUP BY word, round HAVING bool_or(picked))
SELECT word, round, tokens FROM state
"""
_DECODE = """
SELECT t.word, unhex(string_agg(v.hex, '' ORDER BY t.pos)) AS bytes
FROM tokens t JOIN vocabulary v USING (token) GROUP BY t.word ORDER BY t.word
"""


class Tokenizer:
    """Ranks, pattern and the per-process DuckDB tables derived from them."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        self.split = regex.compile(pattern).findall
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.byte_ranks = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        merges = self._merges()
        # No spill folder: a query fits its memory, and a worker's own disk is not to be used.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY,
                                         "temp_directory": ""})
        pairs = pa.table({"pair": pa.array([a << 32 | b for a, b, _ in merges], pa.int64()),
                          "merged": pa.array([m for _, _, m in merges], pa.int32())})
        self.near = False
        names = pa.table({"token": pa.array(self.ranks.values(), pa.int32()),
                          "hex": [t.hex() for t in self.ranks]})
        for name, rows in (("merges", pairs), ("vocabulary", names)):
            self._create(name, rows)
        self.spaced = pattern == _SPACED_PATTERN
        # chunk -> (ids as little-endian uint32, decoded bytes), in two generations:
        # what the last chunks needed moves to the young one, the old one goes.
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def _merges(self) -> list[tuple[int, int, int]]:
        """(left, right, merged) of every way a token comes from two."""
        return [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items()
                for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]

    def _create(self, name: str, rows: pa.Table) -> None:
        self.db.register("rows_", rows)
        self.db.execute(f"CREATE TABLE {name} AS FROM rows_")
        self.db.unregister("rows_")

    def _long_tables(self) -> None:
        """Tables of the long-word query, made when the first long word comes."""
        if self.near:
            return
        token_of, merges = {r: t for t, r in self.ranks.items()}, self._merges()
        # Least rank at which b joins any token that ends in the key's left token,
        # and a any token that begins with the key's right token.
        lefts: dict[int, int] = {}
        rights: dict[int, int] = {}
        for a, b, m in merges:
            left, right = token_of[a], token_of[b]
            for end in (self.ranks.get(left[i:]) for i in range(len(left))):
                if end is not None:
                    lefts[end << 32 | b] = min(m, lefts.get(end << 32 | b, m))
            for begin in (self.ranks.get(right[:i + 1]) for i in range(len(right))):
                if begin is not None:
                    rights[a << 32 | begin] = min(m, rights.get(a << 32 | begin, m))
        twins = pa.table({"pair": pa.array([a << 32 | b for a, b, _ in merges], pa.int64()),
                          "merged": pa.array([m for _, _, m in merges], pa.int32()),
                          "twin_safe": [self.ranks.get(2 * token_of[m], m) >= m
                                        for _, _, m in merges]})
        self._create("long_merges", twins)
        for name, least in (("lefts", lefts), ("rights", rights)):
            self._create(name, pa.table({"pair": pa.array(least.keys(), pa.int64()),
                                         "least": pa.array(least.values(), pa.int32())}))
        self.near = True

    def _chunks(self, text: str) -> list[str]:
        """Pieces that matches of the pattern never reach over; the whole text if in doubt."""
        if not self.spaced or "\0" in text or _has_space_run(text):
            return [text]
        return text.replace(" ", "\0 ").split("\0")

    def _decoded(self, word: np.ndarray, pos: np.ndarray, token: np.ndarray) -> dict[int, bytes]:
        self.db.register("tokens", pa.table({"word": word, "pos": pos, "token": token}))
        found = self.db.sql(_DECODE).to_arrow_table().to_pydict()
        return dict(zip(found["word"], found["bytes"]))

    def _rounds(self, query: str, lists: pa.ListArray, word: np.ndarray, **limits: int) -> pa.Table:
        self.db.register("start", pa.table({
            "word": pa.array(word.astype(np.int32)), "tokens": lists.take(pa.array(word))}))
        return self.db.sql(query, params=limits or None).to_arrow_table().combine_chunks()

    def _fixpoints(self, lists: pa.ListArray, sizes: np.ndarray) -> pa.ListArray:
        """Each word's tokens when no pair can merge any more."""
        done, at = [], np.empty(len(sizes), np.int64)
        held = 0

        def keep(rounds: pa.Table, last: np.ndarray, word: np.ndarray) -> None:
            nonlocal held
            done.append(rounds["tokens"].combine_chunks().take(pa.array(last)))
            at[word] = held + np.arange(len(word))
            held += len(word)

        def batches(word: np.ndarray, cost: np.ndarray, limit: int) -> list[np.ndarray]:
            return np.split(word, np.flatnonzero(np.diff(np.cumsum(cost[word]) // limit)) + 1)

        square = sizes.astype(np.int64) ** 2 // 2 + 1
        for word in batches(np.flatnonzero(sizes <= LONG_WORD), square, QUERY_TOKENS):
            rounds = self._rounds(_ENCODE, lists, word)
            # Rounds come in order: a word's last row is its fixpoint.
            last = np.empty(len(sizes), np.int64)
            last[rounds["word"].to_numpy()] = np.arange(rounds.num_rows)
            keep(rounds, last[word], word)
        for word in batches(np.flatnonzero(sizes > LONG_WORD), sizes.astype(np.int64),
                            LONG_TOKENS):
            now = lists
            if len(word):
                self._long_tables()
            while len(word):
                left = len(now.take(pa.array(word)).values)
                limit = max(1, QUERY_TOKENS // left)
                rounds = self._rounds(_ENCODE_LONG, now, word, rounds=limit)
                last = np.empty(len(sizes), np.int64)
                last[rounds["word"].to_numpy()] = np.arange(rounds.num_rows)
                more = rounds["round"].to_numpy()[last[word]] == limit
                keep(rounds, last[word[~more]], word[~more])
                where = np.zeros(len(sizes), np.int64)
                where[word] = last[word]
                now = rounds["tokens"].combine_chunks().take(pa.array(where))
                word = word[more]
        return pa.concat_arrays(done).take(pa.array(at))

    def _contract(self, words: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids and decoded bytes of distinct words, by contraction to the fixpoint."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        # A word that is a token is taken as it is, before any merge.
        whole = [self.ranks.get(r) for r in raw]
        sizes = np.array([len(r) if w is None else 1 for r, w in zip(raw, whole)], np.int32)
        spelled = self.byte_ranks[np.frombuffer(
            b"".join([r if w is None else b" " for r, w in zip(raw, whole)]), np.uint8)]
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        known = np.array([w is not None for w in whole])
        spelled[starts[known]] = [w for w in whole if w is not None]
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(starts, np.int32(len(spelled)))), pa.array(spelled))
        lists = self._fixpoints(lists, sizes)
        ends = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy()[ends[0]:ends[-1]].astype("<i4")
        ends -= ends[0]
        word = np.repeat(np.arange(len(raw), dtype=np.int32), np.diff(ends))
        back = self._decoded(word, np.arange(len(flat), dtype=np.int32), flat)
        ids = flat.tobytes()
        at = (4 * ends).tolist()
        return {w: (ids[at[i]:at[i + 1]], back[i]) for i, w in enumerate(words)}

    def forget(self) -> None:
        """Drop the cached pieces, at the end of a task."""
        self.young, self.old = {}, {}

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian uint32, bytes decoded from the ids) of each text."""
        gc.disable()  # hundreds of thousands of new tuples, none in a cycle
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        if len(self.young) > CACHE_CHUNKS // 2:
            self.old, self.young = self.young, {}
        cut = [self._chunks(t) for t in texts]
        young, old = self.young, self.old
        new = []
        for chunk in set().union(*cut).difference(young):
            seen = old.get(chunk)
            if seen is None:
                new.append(chunk)
            else:
                young[chunk] = seen
        # " " and letters only is one word of the pattern.
        split = [[c] if self.spaced and c[:1] == " " and c[1:].isalpha() else self.split(c)
                 for c in new]
        pairs: dict[str, tuple[bytes, bytes]] = {}
        words = []
        for word in set().union(*split):  # a word may be known as a chunk of its own
            seen = young.get(word) or old.get(word)
            if seen is None:
                words.append(word)
            else:
                pairs[word] = seen
        for i in range(0, len(words), WORDS_PER_QUERY):
            pairs |= self._contract(words[i:i + WORDS_PER_QUERY])
        for chunk, ws in zip(new, split):
            young[chunk] = (pairs[ws[0]] if len(ws) == 1 else
                            tuple(b"".join([pairs[w][k] for w in ws]) for k in (0, 1)))
        out = []
        for chunks in cut:
            ids, back = zip(*map(young.__getitem__, chunks))
            out.append((b"".join(ids), b"".join(back)))
        return out

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each id sequence, by ordered aggregation."""
        arrays = [np.frombuffer(i, "<u4") for i in ids]
        sizes = [len(a) for a in arrays]
        if not sum(sizes):
            return [b""] * len(ids)
        word = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        by_word = self._decoded(word, np.arange(len(word), dtype=np.int32),
                                np.concatenate(arrays).astype(np.int32))
        return [by_word.get(i, b"") for i in range(len(ids))]


_open: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(ranks_path: str, pattern: str) -> Tokenizer:
    """One tokenizer per worker process."""
    key = (ranks_path, pattern)
    if key not in _open:
        _open[key] = Tokenizer(ranks_path, pattern)
    return _open[key]


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES; at least one row each."""
    start = held = 0
    for i in range(len(column)):
        held += len(column[i].as_buffer() or b"") if column[i].is_valid else 0
        if held >= SLICE_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(column):
        yield start, len(column)


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
           carry: list[str] | None = None) -> DataFrame:
    """``row`` (the source row), n_tokens, ids (little-endian uint32), decoded (bytes).

    ``carry`` names the source columns that ``row`` holds (default: all). Texts that are
    not needed afterwards are better left out: they travel to the workers and back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks_path, pattern)
        for batch in batches:
            for start, end in _slices(batch.column(1)):
                part = batch.slice(start, end - start)
                pairs = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) // 4 for i, _ in pairs], pa.int64()),
                     pa.array([i for i, _ in pairs], pa.binary()),
                     pa.array([d for _, d in pairs], pa.binary())],
                    names=[ROW, "n_tokens", "ids", "decoded"])
                del pairs, part
        bpe.forget()
        release_memory()

    source = packed(df, carry, text=F.col(text_col))
    schema = StructType([source.schema[ROW], StructField("n_tokens", LongType()),
                         StructField("ids", BinaryType()), StructField("decoded", BinaryType())])
    return source.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``row`` (the source row) and decoded, the bytes of its ids; null ids give empty bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks_path, pattern)
        for batch in batches:
            for start, end in _slices(batch.column(1)):
                part = batch.slice(start, end - start)
                back = bpe.decode([i or b"" for i in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(back, pa.binary())],
                                                 names=[ROW, "decoded"])

    source = packed(df, ids=F.col(ids_col))
    schema = StructType([source.schema[ROW], StructField("decoded", BinaryType())])
    return source.mapInArrow(run, schema)
