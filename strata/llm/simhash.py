"""SimHash near-duplicates by sharded vantage-point trees.

Fingerprint: 64 bits; bit i is 1 if it is set in over half of the XXH64 hashes
(seed 42) of the text's shingles, repeats included. Two fingerprints link at
MAX_BITS or fewer differing bits; a component is what links reach.

Random 64-bit fingerprints lie about 32 bits apart, give or take 4, so one
vantage-point tree over all of them prunes next to nothing at a radius of 4
and its cost grows almost with the square of the input. The partition by
Hamming distance therefore starts from the vantage point zero in MAX_BITS + 1
masked metrics (the bits are dealt to MAX_BITS + 1 disjoint masks): of two
linked fingerprints at least one mask shows distance 0, so both lie in the
same sphere of radius 0 there. A sphere with more than SPHERE_ROWS
fingerprints is cut again, into rings by the distance to a vantage point of
its own; a ring is wider than the radius, so a link stays in a ring or
reaches the next one, and every shard also gets the next ring's points (the
boundary overlap). Each shard builds a vantage-point tree, prunes branches by
triangle bounds and finds all links within the radius exactly.

Only distinct fingerprints enter the search, so copies cost nothing. A shard
returns a spanning forest of its links, never all pairs of a group: the forest
joins exactly what the links join.

Defined results: null or empty text has no words and fingerprint 0, linked like
any other; fewer words than the shingle length make one shingle of the whole
sequence; repeated rows share a fingerprint; an empty table gives an empty
result; extra columns are carried unchanged. Of a component's rows exactly one
stays: least id, null ids last, then least text, null first; of rows equal in
both, any one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import ROW, deal_join, hot_parts, release_memory, stored
from .components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SPHERE_ROWS = 4_096
LEAF = 64
#: Byte table: A-Z lower-cased, 0x09-0x0D become spaces.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN)
    words = [w for w in raw.split(b" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; counted in blocks, so memory is bounded."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        block = hashes[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > len(hashes)))


def fingerprints(df: DataFrame, text: Column, shingle: int = SHINGLE, **extra: Column) -> DataFrame:
    """The extra columns and fp, the fingerprint as a signed long."""
    source = df.select(text.alias("text"), *[c.alias(n) for n, c in extra.items()])
    names = [*extra, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(0)],
                             np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found)], names=names)
        release_memory()

    schema = StructType([*[source.schema[n] for n in extra], StructField("fp", LongType())])
    return source.mapInArrow(run, schema)


class VantageTree:
    """Vantage-point tree over distinct 64-bit fingerprints, for exact range queries."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.root = self._build(np.arange(len(points)))

    def _build(self, at: np.ndarray):
        if len(at) <= LEAF:
            return at
        vantage, rest = at[0], at[1:]
        d = np.bitwise_count(self.points[rest] ^ self.points[vantage])
        radius = int(np.median(d))
        near, far = rest[d <= radius], rest[d > radius]
        if not len(far):  # all as near: no bound would prune
            return at
        return (vantage, radius, self._build(near), self._build(far))

    def links(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query indexes, point indexes) of all pairs within ``radius``, a node at a time."""
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            node, live = todo.pop()
            if not len(live):
                continue
            if isinstance(node, np.ndarray):
                for i in range(0, len(live), 4096):
                    some = live[i:i + 4096]
                    d = np.bitwise_count(queries[some, None] ^ self.points[node][None, :])
                    q, p = np.nonzero(d <= radius)
                    if len(q):
                        yield some[q], node[p]
                continue
            vantage, bound, near, far = node
            d = np.bitwise_count(queries[live] ^ self.points[vantage]).astype(np.int64)
            hit = live[d <= radius]
            if len(hit):
                yield hit, np.full(len(hit), vantage)
            todo.append((near, live[d - radius <= bound]))
            todo.append((far, live[d + radius > bound]))


def _forest(home: np.ndarray, points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning edges (indexes into ``points``) of the links from the first ``len(home)``."""
    parent = list(range(len(points)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for q, p in VantageTree(points).links(home, radius):
        for a, b in zip(q.tolist(), p.tolist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                edges.append((a, b))
    return edges


def _search(radius: int):
    def run(shard):
        fp = shard["fp"].to_numpy().view(np.uint64)
        overlap = shard["overlap"].to_numpy()
        order = np.argsort(overlap, kind="stable")  # home points first
        points = fp[order]
        home = points[:int((overlap == 0).sum())]
        found = points.view(np.int64)
        edges = [sorted((int(found[a]), int(found[b]))) for a, b in _forest(home, points, radius)]
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()),
                         "b": pa.array([e[1] for e in edges], pa.int64())})
    return run


def _masks(count: int) -> list[int]:
    """Disjoint masks over 64 bits, as signed longs."""
    bounds = [64 * i // count for i in range(count + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def shards(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(mask, sphere, ring, overlap, fp): every shard's home points and boundary overlap."""
    spheres = F.explode(F.array(*[
        F.struct(F.lit(n).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("sphere"))
        for n, m in enumerate(_masks(max_bits + 1))]))
    placed = distinct.select("fp", spheres.alias("s")).select("fp", "s.mask", "s.sphere")
    large = (placed.groupBy("mask", "sphere")
             .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("vantage"))
             .filter(F.col("n") > SPHERE_ROWS).drop("n"))
    ring = F.floor(F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage"))) / F.lit(max_bits + 1))
    ringed = (placed.join(large, ["mask", "sphere"], "left")
              .withColumn("ring", F.coalesce(ring.cast("int"), F.lit(-1))))
    # Ring r + 1 also visits the shard of ring r, as its boundary overlap.
    visits = F.when(F.col("ring") > 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (ringed.withColumn("overlap", F.explode(visits))
            .select("mask", "sphere", (F.col("ring") - F.col("overlap")).alias("ring"),
                    "overlap", "fp"))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a < b) that join exactly the fingerprints that links join."""
    return (shards(distinct, max_bits).groupBy("mask", "sphere", "ring")
            .applyInArrow(_search(max_bits), "a long, b long"))


def _components_of(marked: DataFrame, max_bits: int) -> DataFrame:
    """shared (a fingerprint), root, component_id (least id) and n_rows of its component, copies."""
    groups = marked.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    reached = components(links(groups.select("fp"), max_bits))
    named = stored(groups.join(reached, F.col("fp") == F.col("node"), "left")
                   .select("fp", "first", "n", F.coalesce("root", "fp").alias("root")),
                   "simhash-roots")
    least = stored(named.groupBy("root").agg(
        F.min("first").alias("component_id"), F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("prints")), "simhash-least")
    hot = hot_parts(least, "root", "prints", named.count())
    return stored(deal_join(named.select("root", F.col("n").alias("copies"), F.col("fp").alias("shared")),
                            least.drop("prints"), "root", "shared", hot)
                  .select("shared", "root", "component_id", "n_rows", "copies"), "simhash-components")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """id, fp and component_id (the smallest id reachable over links) of every row."""
    marked = stored(fingerprints(df, F.col(text_col), shingle, id=F.col(id_col)), "simhash")
    found = _components_of(marked, max_bits).withColumnRenamed("shared", "fp")
    hot = hot_parts(found, "fp", "copies", marked.count())
    return deal_join(marked, found, "fp", "id", hot).select("id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component stays: least id, null ids last, then least text."""
    # Stored with the rows, a key names one row for good, whatever ids repeat.
    marked = stored(fingerprints(df, F.col(text_col), shingle, **{ROW: F.struct("*")},
                                 id=F.col(id_col), key=F.monotonically_increasing_id()),
                    "simhash-rows")
    narrow = marked.select("key", "id", "fp")
    shared = _components_of(narrow, max_bits).filter("n_rows > 1")
    shared = shared.withColumnRenamed("shared", "fp")
    hot = hot_parts(shared, "fp", "copies", narrow.count())
    members = stored(deal_join(narrow, shared, "fp", "key", hot)
                     .select("key", "root", F.expr("id <=> component_id").alias("least")),
                     "simhash-members")
    firsts = members.filter("least").groupBy("root").agg(F.min("key").alias("kept"),
                                                         F.count(F.lit(1)).alias("n"))
    # Only rows that tie on the least id have their texts compared.
    tied = members.filter("least").join(firsts.filter("n > 1").select("root"), "root", "left_semi")
    by_text = (marked.select("key", F.col(ROW)[text_col].alias("text")).join(tied, "key")
               .groupBy("root").agg(F.min(F.struct("text", "key"))["key"].alias("kept")))
    kept = firsts.filter("n = 1").select("kept").union(by_text.select("kept"))
    dropped = members.join(kept, F.col("key") == F.col("kept"), "left_anti").select("key")
    return marked.join(dropped, "key", "left_anti").select(f"{ROW}.*")
