"""Sets that have much in common, without lists of pairs for what many of them hold and without a bound on such lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import cut, ship
from .blocks import PARTS

#: Common elements that two prefixes must show; rows and elements of a block, about; cells and elements that are counted at once.
LEAD = 8
ROWS, ELEMENTS = 8192, 2_000_000
AT_ONCE = 4_000_000


def _column(t: pa.Table, name: str) -> np.ndarray:
    return np.asarray(t[name].combine_chunks())


def _met(x: pa.Table, y: pa.Table, same: bool, share: float, lead: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of the sets of two blocks whose prefixes have enough in common; of one block, each two sets once."""
    x_id, y_id, x_size, y_size = _column(x, "id"), _column(y, "id"), _column(x, "size"), _column(y, "size")
    n = len(y_id)
    lists = y["t"].combine_chunks()
    held, at = np.unique(np.asarray(lists.flatten()), return_inverse=True)
    order = np.argsort(at, kind="stable")
    of = np.repeat(np.arange(n), np.diff(np.asarray(lists.offsets)))[order]
    starts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(held)))])
    lists = x["t"].combine_chunks()
    asked = np.asarray(lists.flatten())
    row = np.repeat(np.arange(len(x_id)), np.diff(np.asarray(lists.offsets)))
    code = np.minimum(np.searchsorted(held, asked), max(len(held) - 1, 0))
    found = held[code] == asked if len(held) else np.zeros(len(asked), bool)
    row, code = row[found], code[found]
    lengths = starts[code + 1] - starts[code]
    rows_to = np.searchsorted(row, np.arange(len(x_id) + 1))
    upto = np.concatenate([[0], np.cumsum(lengths)])[rows_to]  # elements of lists before each row
    first = 0
    while first < len(x_id):
        last = max(first + 1, min(first + max(AT_ONCE // max(n, 1), 1), int(np.searchsorted(upto, upto[first] + AT_ONCE, "right")) - 1))
        mine = slice(rows_to[first], rows_to[last])
        many, total = lengths[mine], int(upto[last] - upto[first])
        place = np.repeat(starts[code[mine]] - (np.cumsum(many) - many), many) + np.arange(total)
        cell = np.repeat(row[mine] - first, many) * n + of[place]
        if total * 8 < (last - first) * n:
            cell, count = np.unique(cell, return_counts=True)
        else:
            count = np.bincount(cell)
            cell = np.flatnonzero(count)
            count = count[cell]
        i, j = cell // max(n, 1) + first, cell % max(n, 1)
        low, high = np.minimum(x_size[i], y_size[j]), np.maximum(x_size[i], y_size[j])
        least = np.ceil(share * high - 1e-9)
        keep = (low >= least) & (count >= np.minimum(least, lead))
        if same:
            keep &= i < j
        if keep.any():
            yield x_id[i[keep]], y_id[j[keep]]
        first = last


def likely_pairs(sets: DataFrame, share: float, lead: int = LEAD) -> DataFrame:
    """(a, b), a < b, each once: all pairs of sets (id long, unique; t: distinct longs) that have ``share`` of the larger one or more in
    common, and others that the caller tells apart by the whole sets.

    Elements are ordered from the rarest on. Sets with c elements in common have ``lead`` of them (or all c) among the first
    size - c + lead of each, so only these prefixes are compared, and what is common lies behind them. Prefixes are dealt into
    blocks, and every two blocks meet in a cell of bounded size where common elements are counted in arrays: no list of pairs
    leaves a cell, and an element of many sets takes no task of its own.
    """
    ship(sets.sparkSession)
    s = sets.where("id is not null").select("id", F.size("t").alias("size"), "t")
    each = s.select("id", "size", F.explode("t").alias("h"))
    shared = each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = each.join(shared, "h").groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct("n", "h"))).alias("t"))
    # elements that no other set holds come first in the order, take their places, and need not be kept
    left = F.col("size") - F.ceil(F.col("size") * share - 1e-9) + lead - (F.col("size") - F.size("t"))
    prefix = cut(ranked.where(left > 0).select("id", "size", F.slice("t.h", F.lit(1), left.cast("int")).alias("t")))
    n, elements = prefix.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("t")), F.lit(0))).first()
    blocks = int(max(n // ROWS, elements // ELEMENTS)) + 1
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    dealt = prefix.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = dealt.select(F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "id", "size", "t")
    cells = blocks * (blocks + 1) // 2
    if cells > 1:
        dealt = dealt.repartition(min(cells, PARTS), "x", "y")

    def cell(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = (k.as_py() for k in key)
        rows = pa.Table.from_batches(list(batches)).sort_by("id")
        own = _column(rows, "own")
        for a, b in _met(rows.filter(pa.array(own == x)), rows.filter(pa.array(own == y)), x == y, share, lead):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return dealt.groupBy("x", "y").applyInArrow(cell, "a long, b long")
