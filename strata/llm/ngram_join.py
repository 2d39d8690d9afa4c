"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

A document's set is its distinct SHINGLE-word shingles, as 64-bit hashes. All
n-grams have one global order, rare ones first: (frequency class, hash). The
class is the bit length of a count in a sketch of fixed size over all
documents; any order gives right results, a better one fewer candidates.
Documents with equal sets form one node and never meet each other again.

1. Fragments. The order is cut into fragments of about equal load. A node sends
   the part of its prefix (the n-grams of which a linked partner must hold one)
   that lies in a fragment to it. A first look keeps the n-grams that nodes of
   several components hold; how many a node has bounds what it can share.
   Then a fragment counts, for every pair that shares n-grams there, how many
   (length, position, component and bound first); these partial overlaps are
   summed per pair, and a pair stays only if its sum can still reach the threshold.
2. Exact overlaps. The whole sets of the pairs that stay are cut at fixed places
   of the same order; the overlaps of the parts are counted separately and
   summed per pair, which decides the link.
3. Components of all links.

Copies and hot groups. Before step 1, each min-hash bucket with several nodes
compares its members with one hub, the member whose prefix is most common (of a
family of edited copies, that is the least edited one), one pair a member. The
links join most of a family, and pairs within a component are not counted
again: a link between them would join nothing new. No link between components
is lost, so the components are exact. A fragment that holds more than its load
(an n-gram hotter than a whole fragment) is dealt out as pairs of blocks;
blocks of one component need not meet.

The driver holds the sketch (2^SKETCH_BITS bytes), a filter of 2^FILTER_BITS
bits over the nodes of pairs, the cuts and the hot fragments, whose number
total / load bounds. At 100 TB raise SKETCH_BITS to 28 and FILTER_BITS to 30.

Defined results: null text or no words is the empty set, linked with nothing;
fewer words than SHINGLE make one shingle of the whole sequence; a null id
never names a component unless all ids of it are null; repeated rows link; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import deal_join, release_memory, stored
from .components import components
from .substring_dedup import sequence_hashes
from .words import byte_table, slices, word_hashes

SHINGLE = 4
PERCENT = 85
SKETCH_BITS = 22
FILTER_BITS = 24
FRAGMENT_TOKENS = 1 << 20
PARTS = 4            # fragments of the exact overlap
HUB_KEYS = 4         # min-hash keys a node
HUB_ROWS = 4         # nodes from which a bucket has a hub
_CHUNK = 1 << 12
_LANES = 64
_TABLE = byte_table()
_ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93,
                               0xFF51AFD7ED558CCD)]
SIGNED = ("id long, n long, digest binary, slot long, keys array<long>, common int, tokens binary")


# --- sets, order and prefixes -----------------------------------------------------------

def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): every text's distinct shingles in hash order."""
    hashes, of, words = word_hashes(texts, _TABLE)
    ends = np.cumsum(words)
    whole = np.flatnonzero(np.arange(len(hashes)) + shingle <= np.repeat(ends, words))
    keys, text = sequence_hashes(hashes, shingle)[whole], of[whole]
    for length in range(1, shingle):
        short = np.flatnonzero(words == length)
        if len(short):
            keys = np.append(keys, sequence_hashes(hashes, length)[ends[short] - length])
            text = np.append(text, short)
    order = np.argsort(keys)
    order = order[np.argsort(_narrow(text[order], len(words)), kind="stable")]
    keys, text = keys[order], text[order]
    distinct = np.append(True, (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]))[:len(keys)]
    sizes = np.bincount(text[distinct], minlength=len(words))
    return keys[distinct], np.append(0, np.cumsum(sizes))


def _narrow(values: np.ndarray, bound: int) -> np.ndarray:
    """Small numbers in 16 bits, which numpy's stable sort takes in one linear pass."""
    return values.astype(np.uint16) if bound <= 1 << 16 else values


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """So many first n-grams hold one of any linked partner's, too."""
    return np.where(n > 0, n + (-percent * n) // 100 + 1, 0)


def _linked(overlap: Column, percent: int) -> Column:
    both = F.col("nx") + F.col("ny")
    return (100 + percent) * overlap >= percent * both


class Order:
    """The global n-gram order: rare n-grams first."""

    def __init__(self, classes: np.ndarray) -> None:
        self.classes = classes
        self.shift = np.uint64(64 - (len(classes).bit_length() - 1))

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """A number that orders (but for ties) as the order does."""
        level = self.classes[(hashes >> self.shift).astype(np.int64)].astype(np.uint64)
        return (level << np.uint64(56)) | (hashes >> np.uint64(8))


def _balanced_cuts(loads: dict[int, int], load: int, shift: int) -> np.ndarray:
    """Cuts between bins of the order (its keys without the last ``shift`` bits), so that a
    fragment holds at most ``load``; a bin beyond that is a fragment of its own."""
    cuts, held = [], 0
    for place, n in sorted(loads.items()):
        if held and held + n > load:
            cuts.append(place << shift)
            held = 0
        held += n
    return np.array(cuts, np.uint64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, id, slot); the slot is a hash of the raw text, taken before any work on it."""
    text = F.col(text_col).cast("string")
    return docs.select(text.alias("text"), F.col(id_col).cast("long").alias("id"),
                       F.shiftrightunsigned(F.xxhash64(text), 64 - FILTER_BITS).alias("slot"))


def _counted(task_counts: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    chunks, packed = [], []
    for chunk, counts in task_counts:
        width = next(w for w in (np.uint8, np.uint16, np.uint32, np.uint64)
                     if counts.max() <= np.iinfo(w).max)
        chunks.append(chunk)
        packed.append(bytes([np.dtype(width).itemsize]) + counts.astype(width).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(packed, pa.binary())],
                                      names=["chunk", "counts"])


def _uncounted(packed: pa.ChunkedArray) -> np.ndarray:
    total = np.zeros(0, np.uint64)
    for cell in packed:
        raw = cell.as_py()
        part = np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.uint64)
        total = part if not len(total) else total + part
    return total


def global_order(docs: DataFrame, shingle: int = SHINGLE, sketch_bits: int = SKETCH_BITS) -> Order:
    """Count every shingle of every document into a sketch of fixed size; merge in two steps."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << sketch_bits, np.uint64)
        for batch in batches:
            for part in slices(batch):
                hashes, _ = shingle_sets(part.column(0), shingle)
                np.add.at(counts, (hashes >> np.uint64(64 - sketch_bits)).astype(np.int64),
                          np.uint64(1))
        chunks = counts.reshape(-1, min(_CHUNK, 1 << sketch_bits))
        yield _counted((i, c) for i, c in enumerate(chunks) if c.any())
        release_memory()

    def merge(rows: pa.Table) -> pa.Table:
        merged = _counted([(rows["chunk"][0].as_py(), _uncounted(rows["counts"]))])
        return pa.Table.from_batches([merged])

    schema = "chunk long, counts binary"
    lanes = docs.select("text").mapInArrow(sketch, schema).withColumn(
        "lane", F.spark_partition_id() % _LANES)
    merged = (lanes.groupBy("chunk", "lane").applyInArrow(merge, schema)
              .groupBy("chunk").applyInArrow(merge, schema)).collect()
    classes = np.zeros((-(-(1 << sketch_bits) // _CHUNK), min(_CHUNK, 1 << sketch_bits)), np.uint8)
    for row in merged:
        counts = _uncounted([pa.scalar(bytes(row.counts))])
        classes[row.chunk] = np.frexp(counts.astype(np.float64))[1]  # bit length
    return Order(classes.ravel())


def _digests(hashes: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    raw = hashes.astype("<u8").tobytes()
    return [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) for a, b in zip(offsets, offsets[1:])]


def _signed(docs: DataFrame, order, shingle: int, percent: int) -> DataFrame:
    """Per document: set size, digest, min-hash keys and the prefix in the global order."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield one(part)
        release_memory()

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        hashes, offsets = shingle_sets(part.column(0), shingle)
        sizes = np.diff(offsets)
        digests = _digests(hashes, offsets)
        text = np.repeat(np.arange(len(sizes)), sizes)
        ranks = order.value.keys(hashes)
        # The hashes are in order within a text; so it takes only their classes, then the texts.
        at = np.argsort((ranks >> np.uint64(56)).astype(np.uint16), kind="stable")
        at = at[np.argsort(_narrow(text[at], len(sizes)), kind="stable")]
        place = np.arange(len(hashes)) - offsets[text]
        prefix = prefix_size(sizes, percent)
        head = at[place < prefix[text]]
        levels = (ranks[head] >> np.uint64(56)).astype(np.int64)
        common = np.bincount(text[head], weights=levels, minlength=len(sizes))
        full = np.flatnonzero(sizes > 0)
        keys = np.zeros((len(sizes), HUB_KEYS), np.int64)
        for k in range(HUB_KEYS if len(full) else 0):
            mixed = hashes * _ODD[k]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[(k + 1) % len(_ODD)]
            least = np.minimum.reduceat(mixed, offsets[full]) ^ np.uint64(k)
            keys[full, k] = least.view(np.int64)
        ends = np.append(0, np.cumsum(prefix)).astype(np.int32) * 8
        return pa.RecordBatch.from_arrays([
            part.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
            part.column(2),
            pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * HUB_KEYS, pa.int32()),
                                     pa.array(keys.ravel(), pa.int64())),
            pa.array((1000 * common // np.maximum(prefix, 1)), pa.int32()),
            pa.Array.from_buffers(pa.binary(), len(sizes), [
                None, pa.py_buffer(ends), pa.py_buffer(hashes[head].astype("<u8"))])],
            names=["id", "n", "digest", "slot", "keys", "common", "tokens"])

    return docs.mapInArrow(sign, SIGNED)


# --- exact overlaps ---------------------------------------------------------------------

def _filter_of(slots: DataFrame) -> np.ndarray:
    """A bitmap of the slots, bounded by FILTER_BITS; a full one lets every document pass."""
    words = (slots.groupBy(F.shiftright("slot", 5).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 31 as int)))").alias("bits")).collect())
    bitmap = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for row in words:
        bitmap[row.word] = row.bits
    return bitmap


def _sets(docs: DataFrame, needed: DataFrame, order, cuts: np.ndarray, shingle: int) -> DataFrame:
    """(node, part, hashes): the whole sets of the needed nodes, cut at ``cuts``."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(_filter_of(needed.select("slot")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column(2).to_numpy()
            bits = wanted.value[slots >> 5] >> (slots & 31).astype(np.uint32)
            for part in slices(batch.filter(pa.array((bits & 1).astype(bool)))):
                yield one(part)
        release_memory()

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        hashes, offsets = shingle_sets(part.column(0), shingle)
        digests = _digests(hashes, offsets)
        slots = part.column(2).to_pylist()
        places = np.searchsorted(cuts, order.value.keys(hashes), side="right")
        out: list[list] = [[], [], [], []]
        for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
            mine, place = hashes[a:b].view(np.int64), places[a:b]
            for p in np.unique(place).tolist():
                for column, value in zip(out, (digests[i], slots[i], p, mine[place == p])):
                    column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
             pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.int64()))],
            names=["digest", "slot", "part", "hashes"])

    found = docs.mapInArrow(cut, "digest binary, slot long, part int, hashes array<long>")
    return stored(found.join(needed, ["digest", "slot"]).select("node", "part", "hashes")
                  .dropDuplicates(["node", "part"]), "jaccard-sets")


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, order, cuts: np.ndarray,
           shingle: int, percent: int) -> DataFrame:
    """The pairs (x, y, nx, ny) whose exact overlap reaches the threshold, as (a, b), a < b."""
    named = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()
    needed = stored(nodes.select("node", "digest", "slot").join(named, "node"), "jaccard-needed")
    sets = _sets(docs, needed, order, cuts, shingle)
    one = deal_join(pairs, sets.withColumnRenamed("node", "x"), "x", "y")
    both = deal_join(one.withColumnRenamed("hashes", "mine"),
                     sets.select(F.col("node").alias("y"), F.col("part").alias("their_part"),
                                 F.col("hashes").alias("theirs")), "y", "x", keys=pairs)
    partial = both.filter("part = their_part").select(
        "x", "y", "nx", "ny", F.size(F.array_intersect("mine", "theirs")).alias("overlap"))
    summed = partial.groupBy("x", "y", "nx", "ny").agg(F.sum("overlap").alias("overlap"))
    linked = summed.filter(_linked(F.col("overlap"), percent))
    return stored(linked.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")),
                  "jaccard-links")


# --- hubs -------------------------------------------------------------------------------

def _hub_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """(x, y, nx, ny): the members of min-hash buckets, each with its bucket's hub."""
    placed = nodes.select("node", "n", "common", F.explode("keys").alias("bucket"))
    hubs = (placed.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("members"),
                 F.max(F.struct("common", F.negate("n").alias("less"), "node")).alias("hub"))
            .filter(F.col("members") >= HUB_ROWS)
            .select("bucket", F.col("hub.node").alias("x"), F.negate("hub.less").alias("nx")))
    met = deal_join(placed.select("bucket", F.col("node").alias("y"), F.col("n").alias("ny")),
                    hubs, "bucket", "y")
    near = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    return met.filter(near & (F.col("x") != F.col("y"))).select("x", "y", "nx", "ny").distinct()


# --- partial overlaps in fragments ------------------------------------------------------

Place = Callable[[np.ndarray], np.ndarray]  # keys of the order to fragment numbers


def _by_cuts(cuts: np.ndarray) -> Place:
    return lambda keys: np.searchsorted(cuts, keys, side="right")


def _by_bins(shift: int) -> Place:
    return lambda keys: (keys >> np.uint64(shift)).astype(np.int64)


def _placed(batch: pa.RecordBatch, order: Order, place: Place):
    """(node row, fragment, token, position) of all prefix n-grams of a batch."""
    raw = batch.column("tokens")
    sizes = pc.binary_length(raw).to_numpy().astype(np.int64) // 8
    tokens = np.frombuffer(b"".join(raw.to_pylist()), "<u8")
    row = np.repeat(np.arange(len(sizes)), sizes)
    position = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return row, place(order.keys(tokens)), tokens, position


def _loads(nodes: DataFrame, order, place: Place, only: set[int] | None = None) -> DataFrame:
    """Prefix n-grams of every fragment (or of every component in the fragments ``only``)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, fragment, _, _ = _placed(batch, order.value, place)
            comp = np.zeros(len(row), np.int64)
            if only is not None:
                keep = np.isin(fragment, list(only))
                row, fragment = row[keep], fragment[keep]
                comp = batch.column("comp").to_numpy()[row]
            pairs, n = np.unique(np.stack([fragment, comp]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()),
                                              pa.array(pairs[1], pa.int64()), pa.array(n)],
                                             names=["fragment", "comp", "n"])
    return (nodes.mapInArrow(count, "fragment long, comp long, n long")
            .groupBy("fragment", "comp").agg(F.sum("n").alias("n")))


def _cuts_of(nodes: DataFrame, order, load: int) -> np.ndarray:
    """Cuts of the order by the loads of bins, of which there are some times total / load."""
    total = nodes.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    shift = 56 - min(24, max(8, (total // (8 * load)).bit_length() + 4))
    loads = {r.fragment: r.n for r in _loads(nodes, order, _by_bins(shift)).collect()}
    return _balanced_cuts(loads, load, shift)


class Blocks:
    """A hot fragment's nodes in blocks; pairs of blocks meet, but not within one component."""

    def __init__(self, large: dict[int, int], rest: int, load: int) -> None:
        self.first, self.parts, owner = {}, {}, []
        for comp, n in [*sorted(large.items()), (None, rest)]:
            self.first[comp], self.parts[comp] = len(owner), max(1, -(-n // load))
            owner += [comp] * self.parts[comp]
        self.pairs = [(a, b) for a in range(len(owner)) for b in range(a, len(owner))
                      if owner[a] is None or owner[a] != owner[b]]

    def of(self, nodes: np.ndarray, comps: np.ndarray) -> np.ndarray:
        spread = ((nodes.astype(np.uint64) * _ODD[1]) >> np.uint64(33)).astype(np.int64)
        block = self.first[None] + spread % self.parts[None]
        for comp in self.first:
            if comp is not None:
                mine = comps == comp
                block[mine] = self.first[comp] + spread[mine] % self.parts[comp]
        return block


def _hot_fragments(nodes: DataFrame, order, cuts: np.ndarray, load: int) -> dict[int, Blocks]:
    """At most total / load fragments, each with at most its load / (load / 4) large components."""
    place = _by_cuts(cuts)
    hot = {r.fragment: r.n for r in _loads(nodes, order, place).filter(F.col("n") > 2 * load).collect()}
    if not hot:
        return {}
    large: dict[int, dict[int, int]] = {f: {} for f in hot}
    for r in _loads(nodes, order, place, set(hot)).filter(F.col("n") > load // 4).collect():
        large[r.fragment][r.comp] = r.n
    return {f: Blocks(large[f], n - sum(large[f].values()), load) for f, n in hot.items()}


# A fragment's arrays, in widths and differences that compress well.
_ARRAYS = {"node": "<i8", "comp": "<i8", "n": "<i4", "start": "<i4", "size": "<i4", "side": "<i1"}
PACKED = ("fragment long, block string, " + ", ".join(f"{a} binary" for a in _ARRAYS)
          + ", tokens binary")
LIVE = ("fragment long, block string, node long, comp long, n long, side int, here long, "
        "tokens binary, positions binary")


def _fragments(nodes: DataFrame, order, cuts: np.ndarray, hot: dict[int, Blocks]) -> DataFrame:
    """Every node's prefix, cut into fragments; a batch packs one row a fragment and block pair."""
    place = _by_cuts(cuts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch.column("node")))
            row, fragment, tokens, position = _placed(batch, order.value, place)
            at = np.lexsort((position, row, fragment))
            row, fragment, tokens, position = (x[at] for x in (row, fragment, tokens, position))
            begin = np.append(True, (row[1:] != row[:-1]) | (fragment[1:] != fragment[:-1]))[:len(row)]
            begins = np.flatnonzero(begin)
            sizes = np.diff(np.append(begins, len(row)))
            rows, places = row[begins], fragment[begins]
            node = batch.column("node").to_numpy()[rows]
            fields = {"node": node, "comp": batch.column("comp").to_numpy()[rows],
                      "n": batch.column("n").to_numpy()[rows], "start": position[begins],
                      "size": sizes, "side": np.zeros(len(rows), np.int64)}
            out: dict[str, list] = {c: [] for c in ("fragment", "block", *_ARRAYS, "tokens")}

            def emit(place: int, block: str, keep: np.ndarray, side: np.ndarray | None) -> None:
                values = {name: fields[name][keep] for name in _ARRAYS}
                if side is not None:
                    values["side"] = side
                values["comp"] = values["comp"] ^ values["node"]
                values["node"] = np.diff(values["node"], prepend=0)
                out["fragment"].append(place)
                out["block"].append(block)
                for name, kind in _ARRAYS.items():
                    out[name].append(values[name].astype(kind).tobytes())
                spans = [tokens[b:b + s] for b, s in zip(begins[keep].tolist(), sizes[keep].tolist())]
                out["tokens"].append(np.concatenate(spans).astype("<u8").tobytes())

            edges = np.searchsorted(places, np.unique(places))
            for s, e in zip(edges, np.append(edges[1:], len(places))):
                keep, blocks = np.arange(s, e), hot.get(int(places[s]))
                if blocks is None:
                    emit(int(places[s]), "", keep, None)
                    continue
                mine = blocks.of(fields["node"][keep], fields["comp"][keep])
                for a, b in blocks.pairs:
                    met = (mine == a) | (mine == b)
                    if met.any():
                        emit(int(places[s]), f"{a},{b}", keep[met],
                             (mine[met] == b).astype(np.int64) if a != b else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["fragment"], pa.int64()), pa.array(out["block"], pa.string()),
                 *(pa.array(out[c], pa.binary()) for c in (*_ARRAYS, "tokens"))], names=list(out))
        release_memory()
    return nodes.mapInArrow(pack, PACKED)


class Fragment:
    """The postings in one fragment: n-grams of the nodes' prefixes, in order of the n-gram.

    Per node: node, comp, n, side, and the n-grams ``here`` and ``alive`` anywhere that some
    node of another component holds, too. Per posting: row (of the node), position (in its set).
    """

    def __init__(self, fields: dict[str, np.ndarray], row: np.ndarray, position: np.ndarray,
                 tokens: np.ndarray, block: str, percent: int) -> None:
        self.percent, self.block = percent, block
        self.node, self.comp, self.n, self.side = (fields[c] for c in ("node", "comp", "n", "side"))
        self.here, self.alive = fields.get("here"), fields.get("alive")
        self.cross = bool(block) and len(set(block.split(","))) == 2
        order = np.lexsort((self.n[row], tokens))
        self.tokens, self.row, self.position = tokens[order], row[order], position[order]
        self.begins = np.flatnonzero(
            np.append(True, self.tokens[1:] != self.tokens[:-1])[:len(tokens)])
        self.posted = np.diff(np.append(self.begins, len(tokens)))

    @classmethod
    def packed(cls, rows: pa.Table, percent: int) -> "Fragment":
        fields: dict[str, np.ndarray] = {}
        for name, kind in _ARRAYS.items():
            parts = [np.frombuffer(b.as_py(), kind).astype(np.int64) for b in rows[name]]
            fields[name] = np.concatenate([np.cumsum(p) for p in parts] if name == "node" else parts)
        fields["comp"] ^= fields["node"]
        size = fields["size"]
        row = np.repeat(np.arange(len(size)), size)
        begin = np.cumsum(size) - size
        position = np.arange(len(row)) - np.repeat(begin - fields["start"], size)
        tokens = np.frombuffer(b"".join(rows["tokens"].to_pylist()), "<u8")
        return cls(fields, row, position, tokens, rows["block"][0].as_py(), percent)

    @classmethod
    def living(cls, rows: pa.Table, percent: int) -> "Fragment":
        fields = {c: rows[c].to_numpy() for c in ("node", "comp", "n", "side", "here", "alive")}
        row = np.repeat(np.arange(len(fields["node"])), fields["here"])
        tokens = np.frombuffer(b"".join(rows["tokens"].to_pylist()), "<u8")
        position = np.frombuffer(b"".join(rows["positions"].to_pylist()), "<i4").astype(np.int64)
        return cls(fields, row, position, tokens, rows["block"][0].as_py(), percent)

    def live(self, fragment: int) -> pa.Table:
        """The postings whose n-gram occurs in several components (and on both sides)."""
        def mixed(values: np.ndarray) -> np.ndarray:
            at = values[self.row]
            return np.minimum.reduceat(at, self.begins) != np.maximum.reduceat(at, self.begins)

        alive = mixed(self.comp) & (mixed(self.side) if self.cross else True)
        at = np.flatnonzero(np.repeat(alive, self.posted))
        at = at[np.lexsort((self.position[at], self.row[at]))]
        rows, here = np.unique(self.row[at], return_counts=True)
        ends = np.append(0, np.cumsum(here)).astype(np.int32)

        def cut(values: np.ndarray) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(rows), [
                None, pa.py_buffer(ends * values.itemsize), pa.py_buffer(np.ascontiguousarray(values))])
        return pa.table({
            "fragment": pa.array(np.full(len(rows), fragment), pa.int64()),
            "block": pa.array([self.block] * len(rows), pa.string()),
            "node": self.node[rows], "comp": self.comp[rows], "n": self.n[rows],
            "side": pa.array(self.side[rows], pa.int32()), "here": pa.array(here, pa.int64()),
            "tokens": cut(self.tokens[at].astype("<u8")),
            "positions": cut(self.position[at].astype("<i4"))})

    def _fits(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Can the postings' nodes link? i and j index postings."""
        a, b = self.row[i], self.row[j]
        na, nb, pa_, pb = self.n[a], self.n[b], self.position[i], self.position[j]
        fits = (self.comp[a] != self.comp[b]) & (100 * np.minimum(na, nb) >= self.percent * np.maximum(na, nb))
        most = np.minimum(pa_, pb) + np.minimum(na - pa_, nb - pb)
        fits &= (100 + self.percent) * most >= self.percent * (na + nb)
        if self.cross:
            fits &= self.side[a] != self.side[b]
        if self.alive is not None:
            fits &= self._suffices(np.minimum(self.alive[a], self.alive[b]), na, nb)
        return fits

    def _suffices(self, shared: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
        """Can sets whose prefixes share so many n-grams still link?"""
        # Past its prefix a set has ceil(percent * n / 100) n-grams less one; the prefix that
        # ends first in the order bounds what else is shared.
        rest = (self.percent * np.maximum(na, nb) + 99) // 100 - 1
        return (100 + self.percent) * (shared + rest) >= self.percent * (na + nb)

    def _shared(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of postings of one n-gram, in bounded pieces."""
        for m in np.unique(self.posted[(self.posted > 1) & (self.posted <= 32)]).tolist():
            one, two = np.triu_indices(m, 1)
            begins = self.begins[self.posted == m]
            step = max(1, (1 << 20) // len(one))
            for k in range(0, len(begins), step):
                some = begins[k:k + step, None]
                yield (some + one).ravel(), (some + two).ravel()
        for begin, m in zip(self.begins[self.posted > 32].tolist(), self.posted[self.posted > 32].tolist()):
            comps = self.comp[self.row[begin:begin + m]]
            if comps.min() == comps.max():
                continue
            sizes = self.n[self.row[begin:begin + m]]  # ascending
            upto = np.searchsorted(sizes, 100 * sizes // self.percent, side="right")
            for i in range(m - 1):
                j = np.arange(begin + i + 1, begin + upto[i])
                yield np.full(len(j), begin + i), j

    def pairs(self) -> pa.Table:
        held, found, waiting = [], [], 0
        total = np.int64(max(1, len(self.node)))

        def settle() -> None:
            keys = np.concatenate([k for k, _ in held + found]) if held or found else np.zeros(0, np.int64)
            counts = np.concatenate([c for _, c in held + found]) if held or found else keys
            distinct, of = np.unique(keys, return_inverse=True)
            held[:] = [(distinct, np.bincount(of, weights=counts, minlength=len(distinct)).astype(np.int64))]
            found.clear()

        for i, j in self._shared():
            fits = self._fits(i, j)
            if not fits.any():
                continue
            a, b = self.row[i[fits]], self.row[j[fits]]
            found.append((np.minimum(a, b) * total + np.maximum(a, b), np.ones(len(a), np.int64)))
            waiting += len(a)
            if waiting > 1 << 21:
                settle()
                waiting = 0
        settle()
        keys, counts = held[0]
        a, b = keys // total, keys % total
        if self.alive is not None:  # elsewhere a pair shares at most what is alive elsewhere
            more = np.minimum(self.alive[a] - self.here[a], self.alive[b] - self.here[b])
            fits = self._suffices(counts + more, self.n[a], self.n[b])
            a, b, counts = a[fits], b[fits], counts[fits]
        swap = self.node[a] > self.node[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        return pa.table({"x": self.node[a], "y": self.node[b], "nx": self.n[a], "ny": self.n[b],
                         "c": pa.array(counts, pa.int64())})


def _candidates(nodes: DataFrame, order, percent: int, load: int) -> DataFrame:
    """Pairs (x, y, nx, ny) of different components whose summed prefix overlap may suffice.

    A first look at the fragments finds the n-grams that several components hold; the pairs
    are then counted among those alone, and a node's number of them bounds its overlaps.
    """
    cuts = _cuts_of(nodes, order, load)
    hot = _hot_fragments(nodes, order, cuts, load)

    def look(key, rows):
        found = Fragment.packed(rows, percent).live(key[0].as_py())
        release_memory()
        return found

    def count(rows: pa.Table) -> pa.Table:
        found = Fragment.living(rows, percent).pairs()
        release_memory()
        return found

    live = stored(_fragments(nodes, order, cuts, hot).groupBy("fragment", "block")
                  .applyInArrow(look, LIVE), "jaccard-live")
    alive = live.groupBy("node").agg(F.sum("here").alias("alive"))
    partial = (live.join(alive, "node").groupBy("fragment", "block")
               .applyInArrow(count, "x long, y long, nx long, ny long, c long"))
    summed = partial.groupBy("x", "y", "nx", "ny").agg(F.sum("c").alias("c"))
    rest = [F.expr(f"({percent} * {n} + 99) div 100 - 1") for n in ("nx", "ny")]
    return summed.filter(_linked(F.col("c") + F.greatest(*rest), percent)).drop("c")


# --- the join ---------------------------------------------------------------------------

def _with_roots(nodes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    roots = components(links).withColumnRenamed("root", name)
    return nodes.join(roots, "node", "left").withColumn(name, F.coalesce(name, "node"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT, sketch_bits: int = SKETCH_BITS,
                    load: int = FRAGMENT_TOKENS) -> DataFrame:
    """id, n_shingles and component_id (the smallest id reachable over links) of every row."""
    spark = df.sparkSession
    docs = _texts(df, id_col, text_col)
    sketched = global_order(docs, shingle, sketch_bits)
    order = spark.sparkContext.broadcast(sketched)
    # Stored with its row, a number names one row of every set, the node, for good.
    signed = stored(_signed(docs, order, shingle, percent)
                    .withColumn("node", F.monotonically_increasing_id()), "jaccard-signed")
    full = signed.filter("n > 0")
    nodes = stored(full.groupBy("digest").agg(
        F.min_by(F.struct("node", "n", "slot", "keys", "common"),
                 F.struct(F.col("id").isNull(), "id", "node")).alias("s"), F.min("id").alias("least"))
        .select("digest", "least", "s.*"), "jaccard-nodes")
    cuts = _whole_cuts(full, order)
    hub_links = _links(stored(_hub_pairs(nodes, percent), "jaccard-hub-pairs"), nodes, docs, order,
                       cuts, shingle, percent)
    comps = _with_roots(nodes.select("node", "n"), hub_links, "comp")
    grouped = stored(full.select("node", "tokens").join(comps, "node"), "jaccard-grouped")
    pairs = stored(_candidates(grouped, order, percent, load), "jaccard-pairs")
    links = hub_links.union(_links(pairs, nodes, docs, order, cuts, shingle, percent))
    rooted = stored(_with_roots(nodes.select("node", "digest", "least"), links, "root"),
                    "jaccard-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = deal_join(rooted.select("root", "digest"), least, "root", "digest")
    joined = deal_join(full.select("id", "n", "digest"), named.select("digest", "component_id"),
                       "digest", "id")
    empty = signed.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return (joined.select("id", "n", "component_id").union(empty)
            .withColumnRenamed("n", "n_shingles"))


def _whole_cuts(nodes: DataFrame, order) -> np.ndarray:
    """Cuts of the order into PARTS of about equal load of prefixes."""
    total = nodes.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    return _cuts_of(nodes, order, max(1, -(-total // (8 * PARTS))))[:PARTS]
