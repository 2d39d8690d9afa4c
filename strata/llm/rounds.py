"""Two question-and-answer rounds between document shards and hash buckets.

The repeat finders have one shape. Documents go, once, into shards: contiguous
ranges of the id, so shards are ordered as ids are. Each shard asks every hash
bucket about its distinct keys in one packed row (sorted keys, as differences);
a bucket sees all shards' rows for its range of keys and answers with one flag
byte a key. A second round refines what the first left open, and a last pass
over the shards builds the result. Shards recompute their keys instead of
storing them: a shard's keys depend on its documents alone.

No key, however hot, weighs more than one entry a shard. Everything is one
lazy plan, in which the exchange of the documents is planned three times and
run once. The number of buckets equals the number of shards, so both stay of
the size SHARD_BYTES asks for at any input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_SHARDS = 1 << 20  # bounds the range limits that the driver holds (8 MB)
_SAMPLE_PER_SHARD = 32

ASKED = "bucket long, shard long, n long, payload array<binary>"
ANSWERED = "shard long, bucket long, round int, flags binary"
Payload = list[bytes]


def sharded(docs: DataFrame, id_col: str, text_col: str, shard_bytes: int) -> tuple[DataFrame, int]:
    """(shard, id, raw) with id ranges as shards, and the number of shards.

    Range limits come from a bounded hash sample of the ids; they decide the
    balance only. Null ids go first.
    """
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), raw.alias("raw"))
    count, total = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("raw"))).first()
    shards = int(min(MAX_SHARDS, max(1, (total or 0) // shard_bytes, 1)))
    cuts: list[float] = []
    if shards > 1:
        every = max(1, count // (_SAMPLE_PER_SHARD * shards))
        ids = sorted(r[0] for r in rows.filter(F.col("id").isNotNull()).select("id")
                     .filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).collect())
        cuts = sorted({float(ids[len(ids) * i // shards]) for i in range(1, shards)} if ids else ())
    if not cuts:
        return rows.select(F.lit(0).cast("long").alias("shard"), "id", "raw"), 1
    place = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="place",
                       outputCol="bucket_")
    placed = place.transform(rows.withColumn(
        "place", F.coalesce(F.col("id").cast("double"), F.lit(float("-inf")))))
    return placed.select(F.col("bucket_").cast("long").alias("shard"), "id", "raw"), len(cuts) + 1


class Texts(NamedTuple):
    """A shard's documents in order of (id, text); a null id is the least."""

    ids: list[int | None]
    ranks: np.ndarray  # equal for equal ids, ordered as ids
    raw: list[bytes]


def texts_of(shard: pa.Table) -> Texts:
    ids, raw = shard["id"].to_pylist(), shard["raw"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, raw[i]))
    ids = [ids[i] for i in order]
    ranks = np.array([np.iinfo(np.int64).min if i is None else i for i in ids], np.int64)
    return Texts(ids, ranks, [raw[i] for i in order])


def pack(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as differences, in 4 bytes each where they fit."""
    steps = np.diff(keys, prepend=np.uint64(0))
    small = not len(steps) or int(steps[1:].max(initial=0)) < 1 << 32 and int(steps[0]) < 1 << 32
    if small:
        return b"\x04" + steps.astype("<u4").tobytes()
    if int(steps[1:].max(initial=0)) < 1 << 32:
        return b"\x05" + steps[:1].astype("<u8").tobytes() + steps[1:].astype("<u4").tobytes()
    return b"\x08" + keys.astype("<u8").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    kind, body = packed[0], packed[1:]
    if kind == 8:
        return np.frombuffer(body, "<u8").copy()
    if kind == 4:
        return np.cumsum(np.frombuffer(body, "<u4"), dtype=np.uint64)
    first = np.frombuffer(body[:8], "<u8")
    rest = np.frombuffer(body[8:], "<u4").astype(np.uint64)
    return np.cumsum(np.concatenate([first, rest]), dtype=np.uint64)


def bucket_limits(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Where each bucket's slice of the sorted keys begins; equal ranges of the key space."""
    edges = np.array([(i << bits) // buckets for i in range(buckets)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


class Asked(NamedTuple):
    bucket: int
    n: int
    payload: Payload


def _asked(shard: int, found: Iterable[Asked]) -> pa.Table:
    rows = [a for a in found if a.n]
    return pa.table({"bucket": pa.array([a.bucket for a in rows], pa.int64()),
                     "shard": pa.array([shard] * len(rows), pa.int64()),
                     "n": pa.array([a.n for a in rows], pa.int64()),
                     "payload": pa.array([a.payload for a in rows], pa.list_(pa.binary()))})


def _answers(answers: pa.Table, round_: int) -> np.ndarray:
    """A shard's flags of one round, in bucket order."""
    rows = sorted((b, f) for b, r, f in zip(answers["bucket"].to_pylist(),
                                            answers["round"].to_pylist(),
                                            answers["flags"].to_pylist()) if r == round_)
    return np.frombuffer(b"".join(f for _, f in rows), np.uint8)


Ask1 = Callable[[Texts], Iterable[Asked]]
Ask2 = Callable[[Texts, np.ndarray], Iterable[Asked]]
Judge = Callable[[list[int], list[Payload]], list[np.ndarray]]
Finish = Callable[[Texts, np.ndarray, np.ndarray], pa.Table]


def two_rounds(docs: DataFrame, ask1: Ask1, judge1: Judge, ask2: Ask2, judge2: Judge,
               finish: Finish, schema: str) -> DataFrame:
    """``docs`` is (shard, id, raw). Judges get shard numbers, ascending, and their payloads."""

    def first(key, shard):
        return _asked(key[0].as_py(), ask1(texts_of(shard)))

    def second(key, shard, answers):
        return _asked(key[0].as_py(), ask2(texts_of(shard), _answers(answers, 1)))

    def last(key, shard, answers):
        return finish(texts_of(shard), _answers(answers, 1), _answers(answers, 2))

    def judged(judge: Judge, round_: int):
        def run(key, rows):
            shards, payloads = rows["shard"].to_pylist(), rows["payload"].to_pylist()
            order = sorted(range(len(shards)), key=shards.__getitem__)
            shards = [shards[i] for i in order]
            flags = judge(shards, [payloads[i] for i in order])
            return pa.table({"shard": pa.array(shards, pa.int64()),
                             "bucket": pa.array([key[0].as_py()] * len(shards), pa.int64()),
                             "round": pa.array([round_] * len(shards), pa.int32()),
                             "flags": pa.array([f.tobytes() for f in flags], pa.binary())})
        return run

    by_shard = docs.groupBy("shard")
    answers1 = (by_shard.applyInArrow(first, ASKED).groupBy("bucket")
                .applyInArrow(judged(judge1, 1), ANSWERED))
    answers2 = (docs.groupBy("shard").cogroup(answers1.groupBy("shard"))
                .applyInArrow(second, ASKED).groupBy("bucket")
                .applyInArrow(judged(judge2, 2), ANSWERED))
    return (docs.groupBy("shard").cogroup(answers1.union(answers2).groupBy("shard"))
            .applyInArrow(last, schema))
