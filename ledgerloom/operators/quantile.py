"""Exact quantiles over distributed data."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 4096
#: Every pass but those at the very ends of the doubles narrows the range some 4,000 times.
MOST_PASSES = 300


def _value_at_rank(df: DataFrame, col: str, rank: int, low: float, high: float) -> tuple[float, int]:
    """The value at a zero-based rank, and how many rows are at or below it.

    Each pass counts the rows of a value range in equal cells on the executors and goes on
    in the cell that holds the rank, between that cell's own smallest and largest value.
    It ends when the cell holds one value. The driver sees at most ``CELLS`` counts a pass.
    """
    below = 0
    for _ in range(MOST_PASSES):
        if low >= high:
            break
        # halves, as the width of the whole range of doubles is none
        part = (F.col(col) / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
        cell = F.least(F.floor(part * F.lit(CELLS)), F.lit(CELLS - 1))
        counts = (
            df.where(F.col(col).between(low, high))
            .groupBy(cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
            .orderBy("cell")
            .collect()
        )
        for row in counts:
            if below + row.n > rank:
                low, high = row.lo, row.hi
                break
            below += row.n
    else:
        raise ArithmeticError(f"the percentile did not narrow down in {MOST_PASSES} passes")
    at_or_below = df.where(F.col(col) <= F.lit(low)).count()
    return low, at_or_below


def exact_percentile(df: DataFrame, col: str, p: float) -> float | None:
    """Percentile with linear interpolation between the two nearest ranks, NULLs skipped.

    Give a written table: it is read a few times, one narrow column each. Values that are
    not finite have no place between others and raise an error.
    """
    values = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias(col))
    n, low, high = values.agg(F.count(F.lit(1)), F.min(col), F.max(col)).first()
    if not n:
        return None
    if not (math.isfinite(low) and math.isfinite(high)):  # NaN counts as the largest
        raise ValueError(f"{col} holds values that are not finite")
    position = p * (n - 1)
    rank = math.floor(position)
    value, at_or_below = _value_at_rank(values, col, rank, low, high)
    fraction = position - rank
    if fraction == 0 or at_or_below > rank + 1:
        return value
    above = values.where(F.col(col) > F.lit(value)).agg(F.min(col)).first()[0]
    return value + (above - value) * fraction


#: Cells of one pass over all wanted ranks, and the values that end a search when so few are left.
ALL_CELLS, LAST_VALUES = 16384, 50_000
#: The quantile summary that seeds a search places a value within this share of the rows.
SUMMARY_ACCURACY = 10_000


def _chosen(value: Column, borders: list[float], leaves: list[Column]) -> Column:
    """The leaf of the stretch that ``value`` lies in, by a balanced tree of comparisons with ``borders``."""
    if not borders:
        return leaves[0]
    half = len(borders) // 2
    below = _chosen(value, borders[:half], leaves[: half + 1])
    return F.when(value < F.lit(borders[half]), below).otherwise(_chosen(value, borders[half + 1 :], leaves[half + 1 :]))


def _counted_slots(values: DataFrame, col: str, stretches: list[tuple[float, float]], cells: int) -> list:
    """Rows, smallest and largest value of every cell of every stretch, and of what lies between stretches.

    Stretches are apart and in order. Slots ascend with the values: an even ``part`` lies
    before the stretch of the next odd one.
    """
    value, borders, leaves = F.col(col), [], [F.struct(F.lit(0).alias("part"), F.lit(0).alias("cell"))]
    for i, (low, high) in enumerate(stretches):
        width = high / 2 - low / 2  # halves, as the width of the whole range of doubles is none
        if width:
            cell = F.least(F.floor((value / 2 - F.lit(low / 2)) / F.lit(width) * F.lit(cells)), F.lit(cells - 1)).cast("int")
        else:
            cell = (value > F.lit(low)).cast("int")
        borders += [low, math.nextafter(high, math.inf)]
        leaves += [
            F.struct(F.lit(2 * i + 1).alias("part"), cell.alias("cell")),
            F.struct(F.lit(2 * i + 2).alias("part"), F.lit(0).alias("cell")),
        ]
    slots = values.groupBy(_chosen(value, borders, leaves).alias("slot"))
    found = slots.agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("low"), F.max(col).alias("high"))
    return found.orderBy("slot").collect()


def _joined(stretches: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(set(stretches)):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def values_at_ranks(values: DataFrame, col: str, ranks: list[int], seeds: list[tuple[float, float]]) -> dict[int, float]:
    """The values at many zero-based ranks, all narrowed down together.

    ``seeds`` are stretches that should hold the ranks, such as a quantile summary gives; a
    wrong one costs a pass and no more. A pass counts the cells of all stretches, and every
    rank goes on in its cell. When few rows are left in all cells together, they are counted
    by value and the search ends. The driver sees ``ALL_CELLS`` counts a pass, or
    ``LAST_VALUES`` values once.
    """
    found: dict[int, float] = {}
    stretches, below = _joined(seeds), 0
    wanted = sorted(set(ranks))
    rows, before = values, {}
    for _ in range(MOST_PASSES):
        slots = _counted_slots(rows, col, stretches, max(4, ALL_CELLS // len(stretches)))
        # rows outside of all stretches are left out of later passes, so ranks are told by what lies below a stretch
        left: dict[int, tuple[float, float, int, int]] = {}
        below, i = 0, 0
        for slot in slots:
            while i < len(wanted):
                offset = before.get(wanted[i], 0)
                if wanted[i] - offset >= below + slot.n:
                    break
                left[wanted[i]] = (slot.low, slot.high, offset + below, slot.n)
                i += 1
            below += slot.n
        found.update({r: low for r, (low, high, *_) in left.items() if low == high})
        open_ones = {r: w for r, w in left.items() if w[0] < w[1]}
        if not open_ones:
            return found
        stretches = sorted({(low, high) for low, high, *_ in open_ones.values()})
        inside = F.lit(False)
        for low, high in stretches:
            inside = inside | F.col(col).between(low, high)
        rows, wanted = values.where(inside), sorted(open_ones)
        sizes = {(low, high): n for low, high, _, n in open_ones.values()}
        # what lies below a stretch in all rows, less what lies below it in the rows of later passes
        earlier = {w: sum(n for s, n in sizes.items() if s < w) for w in stretches}
        before = {r: at - earlier[low, high] for r, (low, high, at, _) in open_ones.items()}
        if sum(sizes.values()) <= LAST_VALUES:
            counts = rows.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(col).collect()
            below, i = 0, 0
            for row in counts:
                below += row.n
                while i < len(wanted) and wanted[i] - before[wanted[i]] < below:
                    found[wanted[i]] = row[0]
                    i += 1
            return found
    raise ArithmeticError(f"the quantiles did not narrow down in {MOST_PASSES} passes")


def _seeded(df: DataFrame, col: str, shares: list[float]) -> tuple[DataFrame, int, list[tuple[float, float]]]:
    """Values as doubles, their number, and a stretch around each share from a mergeable summary."""
    values = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias(col))
    margin = 2.0 / SUMMARY_ACCURACY
    places = [min(1.0, max(0.0, s + side)) for s in shares for side in (-margin, margin)]
    summary = F.percentile_approx(col, F.array(*map(F.lit, places)), SUMMARY_ACCURACY)
    n, low, high, around = values.agg(F.count(F.lit(1)), F.min(col), F.max(col), summary).first()
    if n and not (math.isfinite(low) and math.isfinite(high)):  # NaN counts as the largest
        raise ValueError(f"{col} holds values that are not finite")
    return values, n, list(zip(around[::2], around[1::2], strict=True)) if n else []


def exact_quantiles(df: DataFrame, col: str, shares: list[float]) -> list[float] | None:
    """Quantiles with linear interpolation between the two nearest ranks, NULLs skipped; None without values.

    All are found together: a pass for the summary, and as a rule two to narrow down and
    end, however many there are. Give a written table.
    """
    if not shares:
        return []
    values, n, seeds = _seeded(df, col, shares)
    if not n:
        return None
    places = [s * (n - 1) for s in shares]
    ranks = [r for p in places for r in (math.floor(p), min(math.floor(p) + 1, n - 1))]
    at = values_at_ranks(values, col, ranks, seeds)
    lower = [at[math.floor(p)] for p in places]
    upper = [at[min(math.floor(p) + 1, n - 1)] for p in places]
    return [a if a == b else a + (b - a) * (p - math.floor(p)) for a, b, p in zip(lower, upper, places, strict=True)]


def level_borders(df: DataFrame, col: str, levels: int) -> list[float]:
    """The largest value of each of ``levels`` levels of equal depth, but the last: values at whole ranks."""
    shares = [Fraction(i, levels) for i in range(1, levels)]
    values, n, seeds = _seeded(df, col, [float(s) for s in shares]) if shares else (df, 0, [])
    if not n:
        return []
    ranks = [max(math.ceil(s * n) - 1, 0) for s in shares]
    at = values_at_ranks(values, col, ranks, seeds)
    return [at[r] for r in ranks]


def equi_depth_levels(df: DataFrame, col: str, levels: int) -> DataFrame:
    """``df`` with ``Level``, 1 to ``levels``, NULL where ``col`` is.

    A value belongs to the first level whose border it does not exceed, so equal values share
    a level and a value that fills several levels leaves some empty.
    """
    borders = sorted(set(every := level_borders(df, col, levels)))
    numbers = [every.index(b) + 1 for b in borders] + [levels]
    value = F.col(col).cast("double")
    level = _chosen(value, [math.nextafter(b, math.inf) for b in borders], [F.lit(i) for i in numbers])
    return df.withColumn("Level", F.when(value.isNotNull(), level))
