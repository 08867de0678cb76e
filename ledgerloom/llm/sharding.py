"""Contiguous shards of nearly equal size: minimax partition of ordered atomic groups.

Rows with equal texts form a group, groups are ordered by the hash of their text, and a
shard is a run of groups. The smallest capacity that lets the runs fit into the shards is
found by binary search with a greedy check. The driver never sees the groups: it works on
sums over cells of the hash range, and refines only the cells in which a cut can fall,
until each of these holds one group. The number of cells is bounded by the shards, not by
the data.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.storage import stored

#: The hash range at first, and each refined cell later, is cut into 2**CELL_BITS cells.
FIRST_BITS, CELL_BITS = 12, 8
#: Rows of a shard are numbered in so many parts, so that no task holds a whole shard.
NUMBERING_PARTS = 256


@dataclass
class _Cells:
    """Consecutive stretches of the hash range that hold groups: first hash, bits left, sum, groups."""

    rows: list[tuple[int, int, int, int]]
    ends: list[int] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.rows.sort()
        total = 0
        self.ends = []
        for _, _, size, _ in self.rows:
            total += size
            self.ends.append(total)
        self.starts = [0, *self.ends]

    @property
    def total(self) -> int:
        return self.ends[-1] if self.ends else 0

    def before(self, i: int) -> int:
        """Bytes before cell ``i``."""
        return self.ends[i - 1] if i else 0

    def forward(self, start: int, capacity: int) -> int:
        """The first cell that no longer fits into ``capacity`` from cell ``start`` on."""
        return bisect.bisect_right(self.ends, self.before(start) + capacity)

    def backward(self, stop: int, capacity: int) -> int:
        """The first cell of the longest run before ``stop`` that fits into ``capacity``."""
        return bisect.bisect_left(self.starts, self.before(stop) - capacity)

    def feasible(self, capacity: int, shards: int) -> bool:
        at = 0
        for _ in range(shards):
            at = self.forward(at, capacity)
            if at == len(self.rows):
                return True
        return not self.rows

    def least_capacity(self, shards: int) -> int:
        """With each cell whole."""
        low = max(-(-self.total // shards), max((r[2] for r in self.rows), default=0))
        high = self.total
        while low < high:
            middle = (low + high) // 2
            if self.feasible(middle, shards):
                high = middle
            else:
                low = middle + 1
        return low

    def cuts(self, shards: int, capacity: int) -> list[int]:
        """Cells at which the second and later shards start.

        Each cut lies where both sides can still be filled within the capacity, and there as
        near as can be to an equal share of what is left.
        """
        latest_start = [len(self.rows)] * (shards + 1)
        for k in range(shards - 1, -1, -1):
            latest_start[k] = self.backward(latest_start[k + 1], capacity)
        cuts, at = [], 0
        for k in range(1, shards):
            low, high = max(at, latest_start[k]), self.forward(at, capacity)
            goal = self.before(at) + (self.total - self.before(at)) // (shards - k + 1)
            near = bisect.bisect_left(self.starts, goal)
            if near > at and goal - self.starts[near - 1] <= self.starts[min(near, len(self.rows))] - goal:
                near -= 1
            at = min(max(near, low), high)
            cuts.append(at)
        return cuts

    def unclear(self, shards: int, capacity: int, cuts: list[int]) -> set[int]:
        """Cells of several groups in which finer sums could move a cut or the capacity."""
        # A cell larger than a small part of a shard widens all that follows: first those.
        heavy = {i for i, r in enumerate(self.rows) if r[3] > 1 and r[2] * shards * 16 > self.total}
        if heavy:
            return heavy
        lower = max(-(-self.total // shards), max((r[2] for r in self.rows if r[3] == 1), default=0))
        touched: set[int] = set()
        first = last = 0
        for _ in range(shards):
            # where a greedy cut can fall for any capacity from the lower bound to the one found
            first = min(bisect.bisect_right(self.ends, first + lower), len(self.rows) - 1)
            last = min(bisect.bisect_right(self.ends, last + capacity), len(self.rows) - 1)
            touched.update(range(first, last + 1))
            first, last = self.before(first), self.ends[last]
        for k, cut in enumerate(cuts):
            start = self.before(cuts[k - 1]) if k else 0
            goal = start + (self.total - start) // (shards - k)
            near = bisect.bisect_right(self.ends, goal)
            touched.update(range(max(0, near - 1), near + 2))
            touched.update(range(max(0, cut - 1), cut + 1))
        return {i for i in touched if i < len(self.rows) and self.rows[i][3] > 1 and self.rows[i][1] > 0}


def _sums(groups: DataFrame, bits_left: int, parents: DataFrame | None = None) -> list[tuple[int, int, int, int]]:
    rows = groups
    if parents is not None:
        parent = F.shiftrightunsigned("place", bits_left + CELL_BITS).alias("parent")
        rows = rows.withColumn("parent", parent).join(F.broadcast(parents), "parent", "left_semi")
    cell = F.shiftrightunsigned("place", bits_left).alias("cell")
    found = rows.groupBy(cell).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    return [(r["cell"] << bits_left, bits_left, r["size"], r["n"]) for r in found]


def shard_starts(groups: DataFrame, shards: int) -> list[int]:
    """The first ``place`` (63 bits) of each shard but the first.

    ``groups`` has one row per place with its total ``size``. At most
    ``2**FIRST_BITS`` sums come to the driver at first, and then ``2**CELL_BITS`` for each
    of the few cells around the cuts.
    """
    cells = _Cells(_sums(groups, 63 - FIRST_BITS))
    if not cells.rows:
        return [(1 << 63) - 1] * (shards - 1)
    while True:
        capacity = cells.least_capacity(shards)
        cuts = cells.cuts(shards, capacity)
        unclear = cells.unclear(shards, capacity, cuts)
        if not unclear:
            places = [r[0] for r in cells.rows]
            return [places[c] if c < len(places) else (1 << 63) - 1 for c in cuts]
        kept = [r for i, r in enumerate(cells.rows) if i not in unclear]
        by_bits: dict[int, list[int]] = {}
        for i in unclear:
            by_bits.setdefault(cells.rows[i][1], []).append(cells.rows[i][0])
        for bits, places in by_bits.items():
            left = max(0, bits - CELL_BITS)
            parents = groups.sparkSession.createDataFrame([(p >> bits,) for p in places], "parent long")
            if left + CELL_BITS == bits:
                kept += _sums(groups, left, parents)
            else:  # the last few bits: one cell for each place
                at = groups.withColumn("parent", F.shiftrightunsigned("place", bits)).join(F.broadcast(parents), "parent", "left_semi")
                kept += [(r["place"], 0, r["size"], 1) for r in at.collect()]
        cells = _Cells(kept)


def shard_by_bytes(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    The size of a row is the UTF-8 length of its text (null: 0) plus ``overhead``. Rows with
    equal texts are never parted, so that a group larger than a fair share sets the
    capacity, and the other shards share the rest evenly. Null and empty texts count as
    equal. Slots number the rows of a shard from 0 without gaps, by ``doc_id`` within parts
    of the shard; rows that agree in all columns take any of their slots. Other columns are
    ignored; a table without rows gives none.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(text), 1).alias("place"),
        ),
        "shard-rows",
    )
    groups = stored(rows.groupBy("place").agg(F.sum("size").alias("size")), "shard-groups")
    starts = shard_starts(groups, shards)
    shard = sum((F.when(F.col("place") >= s, 1).otherwise(0) for s in starts), F.lit(0))
    placed = rows.withColumn("shard", shard.cast("int")).withColumn(
        "part", F.pmod(F.xxhash64("doc_id"), F.lit(NUMBERING_PARTS)).cast("int")
    )
    sizes = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    offsets = sizes.selectExpr(
        "shard",
        "part",
        "sum(n) over (partition by shard order by part rows between unbounded preceding and current row) - n as offset",
    )
    numbered = placed.selectExpr(
        "*", "row_number() over (partition by shard, part order by doc_id, text_crc32, size) - 1 as position"
    )
    # at most shards * NUMBERING_PARTS rows
    return numbered.join(F.broadcast(offsets), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("position")).cast("long").alias("slot")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the whole rows of ``docs`` (unique ``doc_id``), one folder for each shard."""
    where = placed.select(F.col("doc_id").alias("_doc"), "shard", "slot")
    whole = docs.join(where, F.col("doc_id").eqNullSafe(F.col("_doc"))).drop("_doc")
    whole.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
