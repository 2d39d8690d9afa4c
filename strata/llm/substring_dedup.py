"""Repeated word sequences by fixed-block anchors.

A window is WINDOW consecutive words of one document. Every word covered by a
window that also starts earlier (smaller id, or same document and earlier
start) goes.

Round 1, anchors: the reference index holds every document's non-overlapping
blocks of BLOCK words; every rolling window of BLOCK words probes it. BLOCK is
half of WINDOW, so each occurrence of a repeated window holds a whole indexed
block, and the other occurrence's rolling windows hit it. Round 2, extension:
every window of WINDOW words that reaches over a hit is compared with those of
other occurrences, one word further at a time; the union of the windows that
agree is the hit extended to the maximal exact repeat.

Documents are split by ids into ordered shards (see ``rounds``); a window that
repeats inside a shard is settled there, and a bucket only has to say whether
an earlier shard holds it. Anchors are compared by 48 bits; what is removed is
decided by two independent 64-bit hashes of a window's words, each from their XXH64.

Defined results: null text has no words; rows of one id count in the order of
their texts; a null id is the least; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .rounds import Asked, Payload, Texts, bucket_limits, pack, sharded, two_rounds, unpack

WINDOW = 20
BLOCK = WINDOW // 2
SHARD_BYTES = 8 << 20
_ANCHOR_BITS = 48
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_CHECK = np.uint64(0xA0761D6478BD642F)
SCHEMA = "id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _SPREAD
    return h ^ (h >> np.uint64(29))


def sequence_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` word hashes, by doubling."""
    n = max(0, len(words) - length + 1)
    parts, size, level = [], 1, words
    while size <= length:
        parts.append((size, level))
        if 2 * size <= length:
            level = _mix(level[:-size] * _ODD + level[size:]) if len(level) > size else level[:0]
        size *= 2
    out, at = np.zeros(n, np.uint64), 0
    for size, level in reversed(parts):
        if at + size <= length:
            out = _mix(out * _ODD + level[at:at + n])
            at += size
    return out


class Words:
    """A shard's words: hashes, document ends, and the sorted distinct anchors."""

    def __init__(self, texts: Texts) -> None:
        self.words = [raw.split() for raw in texts.raw]  # bytes: exactly 0x20, 0x09-0x0D
        sizes = np.array([len(w) for w in self.words], np.int64)
        digest = xxhash.xxh64_intdigest
        self.hashes = np.fromiter((digest(w) for ws in self.words for w in ws), np.uint64,
                                  int(sizes.sum()))
        self.ends = np.cumsum(sizes)
        end = np.repeat(self.ends, sizes)
        at = np.arange(len(self.hashes))
        self.start = at - np.repeat(self.ends - sizes, sizes)
        self.rolling = np.flatnonzero(at + BLOCK <= end)
        self.windows = at + WINDOW <= end
        keys = sequence_hashes(self.hashes, BLOCK)[self.rolling] >> np.uint64(64 - _ANCHOR_BITS)
        self.anchors, self.anchor_of = np.unique(keys, return_inverse=True)

    def ask_anchors(self, buckets: int) -> list[Asked]:
        """Distinct anchors, each with: repeats in this shard (1), indexed block (2)."""
        times = np.bincount(self.anchor_of, minlength=len(self.anchors))
        indexed = np.zeros(len(self.anchors), np.uint8)
        indexed[self.anchor_of[self.start[self.rolling] % BLOCK == 0]] = 2
        marks = indexed | (times > 1)
        cut = bucket_limits(self.anchors, _ANCHOR_BITS, buckets)
        return [Asked(b, int(e - s), [pack(self.anchors[s:e]), marks[s:e].tobytes()])
                for b, (s, e) in enumerate(zip(cut, cut[1:]))]

    def candidates(self, hit: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows that hold a hit anchor: places, whether first here; the distinct windows' sorted
        keys and checks, and which one each place has."""
        marked = np.zeros(len(self.hashes) + 1, np.int64)
        if len(hit):
            marked[self.rolling[hit[self.anchor_of] > 0] + 1] = 1
        upto = np.cumsum(marked)
        at = np.flatnonzero(self.windows)
        at = at[upto[at + WINDOW - BLOCK + 1] > upto[at]]
        n = len(self.hashes) - WINDOW + 1
        empty = np.zeros(0, np.uint64)
        keys = sequence_hashes(self.hashes, WINDOW)[at] if n > 0 else empty
        # The words around the hit, hashed again independently: equal windows agree in 128 bits.
        checks = sequence_hashes(_mix(self.hashes ^ _CHECK), WINDOW)[at] if n > 0 else empty
        order = np.lexsort((checks, keys))
        keys, checks = keys[order], checks[order]
        begins = np.flatnonzero(np.append(
            True, (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1]))[:len(keys)])
        sizes = np.diff(np.append(begins, len(keys)))
        of = np.empty(len(at), np.int64)
        of[order] = np.repeat(np.arange(len(begins)), sizes)
        is_first = np.zeros(len(at), bool)
        is_first[order[begins]] = True  # the sort is stable: the earliest place of each window
        return at, is_first, keys[begins], checks[begins], of


def _judge_anchors(shards: list[int], payloads: list[Payload]) -> list[np.ndarray]:
    """1 where an anchor is an indexed block somewhere and occurs at least twice."""
    keys = [unpack(p[0]) for p in payloads]
    marks = np.concatenate([np.frombuffer(p[1], np.uint8) for p in payloads])
    _, of = np.unique(np.concatenate(keys), return_inverse=True)
    times = np.bincount(of, weights=1 + (marks & 1))
    indexed = np.bincount(of, weights=marks & 2)
    hit = ((times > 1) & (indexed > 0))[of].astype(np.uint8)
    return np.split(hit, np.cumsum([len(k) for k in keys])[:-1])


def _judge_windows(shards: list[int], payloads: list[Payload]) -> list[np.ndarray]:
    """1 where an earlier shard holds the window."""
    keys = [unpack(p[0]) for p in payloads]
    everything = np.concatenate(keys)
    checks = np.concatenate([np.frombuffer(p[1], "<u8") for p in payloads])
    # Shards come in ascending order: the first place of a window is in its earliest shard.
    order = np.lexsort((checks, everything))
    one, two = everything[order], checks[order]
    begins = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[:len(one)]
    later = np.ones(len(everything), np.uint8)
    later[order[begins]] = 0
    return np.split(later, np.cumsum([len(k) for k in keys])[:-1])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 and kept, the words left joined by one space."""
    rows, buckets = sharded(docs, id_col, text_col, shard_bytes)

    def ask1(texts: Texts):
        return Words(texts).ask_anchors(buckets)

    def ask2(texts: Texts, hit: np.ndarray):
        _, _, keys, checks, _ = Words(texts).candidates(hit)
        cut = bucket_limits(keys, 64, buckets)
        return [Asked(b, int(e - s), [pack(keys[s:e]), checks[s:e].astype("<u8").tobytes()])
                for b, (s, e) in enumerate(zip(cut, cut[1:]))]

    def finish(texts: Texts, hit: np.ndarray, later: np.ndarray) -> pa.Table:
        shard = Words(texts)
        at, is_first, _, _, of = shard.candidates(hit)
        repeated = at[~is_first | (later[of] > 0)] if len(at) else at
        edge = np.zeros(len(shard.hashes) + 1, np.int64)
        np.add.at(edge, repeated, 1)
        np.add.at(edge, repeated + WINDOW, -1)
        gone = (np.cumsum(edge[:-1]) > 0).tolist()
        sizes, removed, digests, kept = [], [], [], []
        start = 0
        for words, end in zip(shard.words, shard.ends.tolist()):
            drop = gone[start:end]
            left = b" ".join([w for w, d in zip(words, drop) if not d] if any(drop) else words)
            sizes.append(len(words))
            removed.append(sum(drop))
            digests.append(hashlib.sha256(left).hexdigest())
            kept.append(left.decode("utf-8", "replace"))
            start = end
        return pa.table({"id": pa.array(texts.ids, pa.int64()),
                         "n_words": pa.array(sizes, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()),
                         "kept_sha256": digests, "kept": pa.array(kept, pa.string())})

    return two_rounds(rows, ask1, _judge_anchors, ask2, _judge_windows, finish, SCHEMA)
