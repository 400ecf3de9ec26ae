"""Best-fit packing into bins of several permitted lengths.

Every document is ``words + 1`` tokens long (its words and an end mark). What
is longer than the largest permitted length is cut into pieces of that length
and a rest. Pieces are dealt by hash into groups of about ``GROUP`` pieces; in
each group, in falling order of length, a piece goes into the open bin that it
fills best, or opens a bin. For each permitted length the table of sizes still
to come tells what such a bin would hold; the length with the least cost per
token held is opened. At the end each bin shrinks to the smallest permitted
length that holds its contents.

Ties in cost open the shorter length. Which group a piece falls into depends on
its row's place in the files, so that repeated rows spread over all groups.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.llm.common import stored, word_count

LENGTHS = (512, 1024, 2048, 4096, 8192)
GROUP = 20_000


def cost(length: int) -> float:
    """Of one bin: its tokens, their attention over each other, a fixed part."""
    return length + length * length / 65_536 + 64


class SizesLeft:
    """The table of the sizes still to come, taken away in falling order."""

    def __init__(self, sizes):
        self.sizes, self.counts = (x.tolist() for x in np.unique(np.asarray(sizes, np.int64), return_counts=True))

    def take(self) -> None:
        """Away with one piece of the largest size."""
        self.counts[-1] -= 1
        if not self.counts[-1]:
            self.sizes.pop()
            self.counts.pop()

    def fill(self, room: int) -> int:
        """What the pieces fill of the room, the largest that fit first."""
        free, end = room, len(self.sizes)
        while end := bisect_right(self.sizes, free, 0, end):
            end -= 1
            free -= min(self.counts[end], free // self.sizes[end]) * self.sizes[end]
        return room - free


def cheapest(size: int, left: SizesLeft, lengths: list[int]) -> int:
    """The permitted length whose bin, opened by a piece and filled by those still
    to come, has the least cost per token; it is priced as it will be shrunk."""

    def price(length: int) -> float:
        held = size + left.fill(length - size)
        return cost(lengths[bisect_left(lengths, held)]) / held

    return min((c for c in lengths if c >= size), key=lambda c: (price(c), c))


def best_fit(sizes, lengths=LENGTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Sizes in falling order -> (bin, offset, capacity) of each, used of each bin."""
    lengths, left = sorted(lengths), SizesLeft(sizes)
    used, room = [], []
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i, size in enumerate(map(int, sizes)):
        left.take()
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = cheapest(size, left, lengths), len(used)
            used.append(0)
        where[i], offset[i] = b, used[b]
        used[b] += size
        if free > size:
            insort(room, (free - size, b))
    final = np.array([lengths[bisect_left(lengths, u)] for u in used], np.int64)
    return where, offset, final[where] if len(sizes) else where, used


def pack(docs: DataFrame, lengths=LENGTHS, group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start (token of the document it
    starts with), length, bin_id, offset in the bin, capacity and used of the bin.

    Every row of ``docs`` has a piece at least; a null or empty text is its end
    mark alone. Repeated rows are packed each. An empty table gives none.
    """
    most = max(lengths)
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (word_count(F.col("text")) + 1).alias("n"))
    sized = stored(sized.withColumn("row", F.monotonically_increasing_id()), "lengths")
    pieces = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / most).cast("int"))))
    start = F.col("piece").cast("long") * most
    pieces = pieces.select("doc_id", "row", "piece", start.alias("start"),
                           F.least(F.lit(most).cast("long"), F.col("n") - start).alias("length"))
    n = sized.agg(F.sum(F.floor((F.col("n") - 1) / most) + 1)).first()[0] or 0
    groups = max(1, -(-int(n) // group))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "row", "piece"], ascending=[False, True, True, True])
        where, offset, capacity, used = best_fit(rows["length"].to_numpy(), lengths)
        high = np.int64(int(rows["group"].iloc[0])) << 32
        return rows.assign(bin_id=high + where, offset=offset, capacity=capacity, used=np.array(used)[where])[
            ["doc_id", "piece", "start", "length", "bin_id", "offset", "capacity", "used"]]

    spread = F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("group")
    return pieces.select("*", spread).groupBy("group").applyInPandas(
        run, "doc_id long, piece int, start long, length long, bin_id long, offset long, capacity long, used long")
