"""Fill-in-middle transformation over a learned rank index of token boundaries.

A text is cut into tokens (optional white space and a run of other characters;
white space at the end stands alone). Two pseudo-random ranks of the boundaries
cut it into prefix, middle and suffix, which are put together again in the
order prefix-suffix-middle (psm) or suffix-prefix-middle (spm), with markers.

The place of a boundary comes from a piecewise-linear learned index. All
boundary offsets of a run of texts form one rising curve over their ranks;
segments are fitted until every prediction is within ERROR characters, and the
difference to the true offset is stored in one byte a boundary. A cut is the
prediction of its segment plus the stored residual, so it is exact. Segments
that miss the bound are halved, all of them at once; one boundary alone is
always met, so the fit ends whatever the text holds.

Only the text and the two hashes go to Python and four numbers come back; the
row, the parts and the output stay in Spark. Texts are worked on in runs of
bounded size, so memory is bounded by the longest text. Output and form restore
the text exactly: a text that holds a marker is never transformed, and a
marker's first character occurs in it nowhere else, so no part's end can
combine with a marker to an earlier one.

Defined results: null text is empty and plain, with no tokens; a null id hashes
as the empty string; repeated rows are transformed alike; an empty table gives
an empty result; extra columns are carried unchanged in ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import ROW, packed
from .words import byte_table, slices, utf8

SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ERROR = 127  # a residual fits one signed byte
_FIRST_RUN = 4096
_SPACES = byte_table(lower=False) < 0
CUTS = StructType([StructField(c, LongType()) for c in ("n", "prefix_chars", "middle_chars")])


class RankIndex:
    """Offset of every rank of a rising curve: segments with bounded error, and residuals."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR) -> None:
        total = len(offsets)
        first = np.arange(0, total, _FIRST_RUN, dtype=np.int64)
        last = np.append(first[1:], total) - 1
        residuals = np.zeros(total, np.int8)
        done_first, done_last = [], []
        while len(first):
            sizes = last - first + 1
            begins = np.cumsum(sizes) - sizes
            ranks = np.arange(int(sizes.sum())) - np.repeat(begins - first, sizes)
            miss = offsets[ranks] - _line(ranks, *(np.repeat(x, sizes) for x in (
                first, offsets[first], last - first, offsets[last] - offsets[first])))
            bad = np.maximum.reduceat(np.abs(miss), begins) > error
            met = ~np.repeat(bad, sizes)
            residuals[ranks[met]] = miss[met]
            done_first.append(first[~bad])
            done_last.append(last[~bad])
            a, b = first[bad], last[bad]
            half = (a + b) // 2
            first, last = np.append(a, half + 1), np.append(half, b)
        first, last = (np.concatenate(x) if x else np.zeros(0, np.int64)
                       for x in (done_first, done_last))
        order = np.argsort(first)
        self.first, last = first[order], last[order]
        self.start = offsets[self.first]
        self.run = last - self.first
        self.rise = offsets[last] - self.start
        self.residuals = residuals

    def at(self, ranks: np.ndarray) -> np.ndarray:
        """Predict, then correct by the stored residual."""
        s = np.searchsorted(self.first, ranks, side="right") - 1
        return (_line(ranks, self.first[s], self.start[s], self.run[s], self.rise[s])
                + self.residuals[ranks])


def _line(ranks, first, start, run, rise):
    return start + (ranks - first) * rise // np.maximum(run, 1)


def boundaries(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (code points over all texts) of all boundaries, each text's 0 included,
    and the number of tokens of every text."""
    data, offsets = utf8(texts)
    space = _SPACES[data]
    ends = ~space
    ends[:-1] &= space[1:]
    filled = offsets[:-1] < offsets[1:]
    lasts = offsets[1:][filled] - 1
    ends[lasts] = True  # a text's end ends its last token, white space or not
    at = np.flatnonzero(ends) + 1
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    text = np.searchsorted(offsets, at, side="left") - 1
    tokens = np.bincount(text, minlength=len(offsets) - 1)
    curve = np.empty(len(at) + len(tokens), np.int64)
    zero = np.cumsum(tokens + 1) - tokens - 1
    is_zero = np.zeros(len(curve), bool)
    is_zero[zero] = True
    curve[is_zero], curve[~is_zero] = points[offsets[:-1]], points[at]
    return curve, tokens


def cut_texts(texts: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens, prefix characters and middle characters of every text."""
    curve, tokens = boundaries(texts)
    index = RankIndex(curve)
    zero = np.cumsum(tokens + 1) - tokens - 1
    one, two = h1 % (tokens + 1), h2 % (tokens + 1)
    begin = index.at(zero)
    end = index.at(zero + np.minimum(one, two))
    return tokens, end - begin, index.at(zero + np.maximum(one, two)) - end


@F.arrow_udf(CUTS)
def _cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    rows = pa.RecordBatch.from_arrays([text, h1, h2], names=["text", "h1", "h2"])
    parts = [cut_texts(p.column(0), p.column(1).to_numpy(), p.column(2).to_numpy())
             for p in slices(rows)]
    found = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64)
             for i in range(3)]
    return pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in found],
                                      names=CUTS.fieldNames())


def hashes(id_: Column, seed: int = SEED) -> list[Column]:
    """The first four 8-digit groups of the id's SHA-256, as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``row``, n, form (plain, psm or spm), prefix_chars, middle_chars and output."""
    h1, h2, h3, h4 = hashes(F.col(id_col), seed)
    rows = packed(df, text_=F.coalesce(F.col(text_col), F.lit("")), h1=h1, h2=h2, h3=h3, h4=h4)
    text = F.col("text_")
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(marker))
    form = (F.when((text == "") | marked | (F.col("h3") % 100 >= fim_percent), "plain")
            .when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm"))
    cut = (rows.withColumn("cuts", _cuts("text_", "h1", "h2")).withColumn("form", form)
           .select(ROW, "text_", "form", "cuts.*"))
    p, m = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix, middle = F.substring(text, F.lit(1), p), F.substring(text, p + 1, m)
    suffix = F.substring(text, p + m + 1, F.char_length(text))
    output = (F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix,
                                                      F.lit(MIDDLE), middle))
              .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix,
                                                     F.lit(MIDDLE), middle))
              .otherwise(text))
    moved = F.col("form") != "plain"
    return cut.select(ROW, "n", "form", F.when(moved, F.col("prefix_chars")).alias("prefix_chars"),
                      F.when(moved, F.col("middle_chars")).alias("middle_chars"),
                      output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text, from output and form alone."""
    size = len(PREFIX)
    head = F.substring(output, F.lit(size + 1), F.char_length(output))
    second = F.when(form == "psm", SUFFIX).otherwise(PREFIX)
    one = F.when(form == "psm", F.substring_index(head, SUFFIX, 1)).otherwise(
        F.substring_index(head, PREFIX, 1))
    rest = F.substring(head, F.char_length(one) + F.char_length(second) + 1, F.char_length(head))
    two = F.substring_index(rest, MIDDLE, 1)
    middle = F.substring(rest, F.char_length(two) + size + 1, F.char_length(rest))
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one)))
