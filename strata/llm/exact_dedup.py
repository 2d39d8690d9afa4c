"""Exact deduplication with a two-pass Bloom filter, DataFrame functions only.

Pass 1 sets two bits per text and keeps the bits that were set at least twice.
Pass 2 probes that filter: a text both of whose bits were set twice is
*possibly repeated*; every other text is certainly unique and passes straight
through, without a shuffle. Only possibly repeated rows are grouped by the
SHA-256 of their normalised text.

The filter takes BITS_PER_ROW bits a row, rounded up to a power of two, and at
most MAX_FILTER_BITS (64 MB): that proves the bound of its broadcast. Past the
bound more unique rows take the grouped path; results stay exact at any size.

A text of more than ``hot_rows`` rows is joined in parts of about that many rows.
There are at most HOT_GROUPS such texts, which bounds their broadcast.

Defined results: null text counts as empty (so all null and empty texts are one
group); the row with the largest id stays; null ids rank below every other id;
of fully repeated rows (same id, same text) exactly one stays; an empty table
gives an empty result; extra columns, whatever their names, are carried
unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, ascii_lower, packed, stored

BITS_PER_ROW = 16
MAX_FILTER_BITS = 1 << 29
HOT_GROUPS = 100_000
MIN_HOT_ROWS = 100
_BUCKET_BITS = 1 << 15  # one bitmap row holds 32,768 bits


def filter_bits(rows: int) -> int:
    bits = _BUCKET_BITS
    while bits < BITS_PER_ROW * rows and bits < MAX_FILTER_BITS:
        bits *= 2
    return bits


def hot_rows(rows: int) -> int:
    return max(MIN_HOT_ROWS, rows // HOT_GROUPS)


def _slots(key: Column, bits: int) -> list[Column]:
    return [key.bitwiseAND(F.lit(bits - 1)),
            F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(bits - 1))]


def _is_set(bitmap: Column, slot: Column) -> Column:
    pos = slot.bitwiseAND(F.lit(_BUCKET_BITS - 1)).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(pos, 3) + 1, F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("int"), pos.bitwiseAND(F.lit(7))) == 1, F.lit(False))


def repeated_bits(keys: Column, df: DataFrame, bits: int) -> DataFrame:
    """Pass 1: bitmap rows (bucket, bitmap) of the bits set at least twice."""
    slots = df.select(F.explode(F.array(*_slots(keys, bits))).alias("slot"))
    twice = slots.groupBy("slot").count().filter("count > 1")
    return (twice.groupBy(F.shiftright("slot", 15).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(_BUCKET_BITS - 1)))
                 .alias("bitmap")))


def annotate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (the source row), text_sha256, keep_id, group_size, kept."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Unicode lower case merges at least the texts that ASCII lower case merges,
    # so this cheap key never separates equal texts.
    key = F.xxhash64(F.lower(text))
    # First reading: one number a row, kept beside the scan's own size.
    keys = stored(df.select(key.alias("key")), "exact-keys")
    rows = keys.count()
    bits = filter_bits(rows)
    bitmaps = stored(repeated_bits(F.col("key"), keys, bits), "exact-bits")

    base = packed(df, id=F.col(id_col), key=key, text=text)
    maybe = F.lit(True)
    for n, slot in enumerate(_slots(F.col("key"), bits)):
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(f"bucket{n}"),
                                          F.col("bitmap").alias(f"bitmap{n}")))
        base = (base.withColumn(f"slot{n}", slot)
                .join(side, F.shiftright(f"slot{n}", 15) == F.col(f"bucket{n}"), "left"))
        maybe = maybe & _is_set(F.col(f"bitmap{n}"), F.col(f"slot{n}"))
    base = base.select(ROW, "id", "text", maybe.alias("maybe"))
    sha = F.sha2(ascii_lower(F.col("text")), 256)

    unique = base.filter(~F.col("maybe")).select(
        ROW, sha.alias("text_sha256"), F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))

    # Second reading, of which the few possibly repeated rows are kept for the steps below;
    # the third one passes the others through.
    candidates = stored(base.filter("maybe").select(ROW, "id", sha.alias("sha")), "exact-maybe")
    groups = (candidates.groupBy(F.col("sha").alias("text_sha256"))
              .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .withColumn("parts", F.floor(F.col("group_size") / hot_rows(rows)) + 1))
    hot = F.broadcast(groups.filter("parts > 1").select(F.col("text_sha256").alias("hot_sha"),
                                                        F.col("parts").alias("hot_parts")))
    parts = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"),
                                                           F.col("parts") - 1)))
    # Rows that repeat an id and a text are numbered, so that one of them stays.
    # Spread by (text, id): a hot text is spread over all tasks.
    numbered = candidates.repartition("sha", "id").withColumn(
        "nth", F.row_number().over(Window.partitionBy("sha", "id").orderBy(F.lit(0))))
    # The join spreads it too: a row takes one of its text's parts.
    dealt = (numbered.join(hot, F.col("sha") == F.col("hot_sha"), "left")
             .withColumn("dealt", F.pmod(F.xxhash64("id", "nth"),
                                         F.coalesce("hot_parts", F.lit(1)))))
    grouped = (dealt.join(parts, (F.col("sha") == F.col("text_sha256"))
                          & (F.col("dealt") == F.col("part")))
               .select(ROW, "text_sha256", "keep_id", "group_size",
                       (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1))
                       .alias("kept")))
    return unique.unionByName(grouped)


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of the input."""
    return annotate(df, id_col, text_col).filter("kept").select(f"{ROW}.*")
