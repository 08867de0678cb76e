"""Embedding near-duplicates: exact threshold pairs by dual traversal of cover trees.

Equal vectors are one class. Classes go to the cell of their nearest pivot (a bounded
sample), large cells are split, and each class visits the other cells it can have links in
by their covering radius. A task holds one part of a cell and a block of its visitors,
builds a cover tree over each (nested nets whose radii halve) and walks both trees together:
node pairs that are too far apart by their covering radii are dropped, pairs that are near
enough as a whole are linked as a whole, and the rest is opened.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.storage import stored

#: Vectors of a cell part and of a block of visitors, and pivots at most.
CELL, MAX_PIVOTS = 6000, 1024
#: Radii of the nets on the unit sphere; a root above them holds the rest.
RADII = (0.125, 0.25, 0.5)
#: Roots compared at a time with all of the other tree.
_ROOTS = 1024
#: Node pairs opened at a time.
_OPENED = 1 << 16
#: Pairs held before they are folded into labels.
_HELD = 1 << 18
#: Bounds keep so far from the threshold that rounding cannot decide; nearer pairs are computed.
_ROUNDING = 1e-9


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares stay finite
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _net(points: np.ndarray, radius: float) -> list[np.ndarray]:
    """Greedy groups of points within ``radius`` of the first point of each, their center."""
    centers: list[int] = []
    place = np.empty(len(points), np.int64)
    least = 1.0 - radius * radius / 2.0
    for first in range(0, len(points), 256):
        block = points[first : first + 256]
        near, at = np.full(len(block), -np.inf), np.zeros(len(block), np.int64)
        for c in range(0, len(centers), 4096):
            cos = block @ points[centers[c : c + 4096]].T
            best = cos.argmax(axis=1)
            most = cos[np.arange(len(block)), best]
            closer = most > near
            near[closer], at[closer] = most[closer], best[closer] + c
        left = np.flatnonzero(near < least)
        own = block[left] @ block[left].T >= least if len(left) else None
        free = np.ones(len(left), bool)
        for k in range(len(left)):
            if free[k]:
                reached = free & own[k]
                reached[k] = True
                at[left[reached]] = len(centers)
                centers.append(first + int(left[k]))
                free &= ~reached
        place[first : first + 256] = at
    order = np.argsort(place, kind="stable")  # a center comes before all that it covers
    return np.split(order, np.cumsum(np.bincount(place, minlength=len(centers)))[:-1])


def _in_one_row(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists], np.int64)
    return np.concatenate(lists) if lists else np.empty(0, np.int64), np.cumsum(counts) - counts, counts


@dataclass
class Tree:
    """Levels from the points (0) up: center point, covering radius, children and members of each node."""

    points: np.ndarray
    centers: list[np.ndarray]
    radius: list[np.ndarray]
    children: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # of all nodes in one row, first place and count of each
    members: list[list[np.ndarray]]
    sizes: list[np.ndarray]  # numbers of members

    @classmethod
    def over(cls, points: np.ndarray) -> Tree:
        """Nets from the largest radius down, each within the nodes of the one above."""
        levels = [_net(points, RADII[-1])]
        children: list[list[np.ndarray]] = []
        for radius in reversed(RADII[:-1]):
            below: list[np.ndarray] = []
            inside = []
            for members in levels[-1]:
                groups = [members] if len(members) == 1 else [members[g] for g in _net(points[members], radius)]
                inside.append(np.arange(len(below), len(below) + len(groups)))
                below += groups
            children.append(inside)
            levels.append(below)
        everyone = np.arange(len(points))
        # level 0 are the points themselves
        members = [[np.array([i]) for i in everyone], *levels[::-1]]
        rows = [_in_one_row(c) for c in [[], levels[-1], *children[::-1]]]
        tree = cls(points, [everyone], [np.zeros(len(points))], rows, members, [np.array([len(m) for m in nodes], np.int64) for nodes in members])
        for nodes in members[1:]:
            tree.centers.append(np.array([m[0] for m in nodes], np.int64))
            tree.radius.append(
                np.array([_distance(points[m] @ points[m[0]]).max() if len(m) > 1 else 0.0 for m in nodes])
            )
        return tree


class Links:
    """Counts of linked vectors by point, and which points are joined.

    Pairs are held until there are ``_HELD`` of them; then they are folded into one label for
    each point, so that a dense cluster costs no more memory than its points.
    """

    def __init__(self, weights: list[np.ndarray]) -> None:
        self.weights = weights
        self.counts = [np.zeros(len(w), np.int64) for w in weights]
        self.pairs: list[np.ndarray] = []
        self.held = 0
        self.shift = len(weights[0])
        self.label = np.arange(sum(map(len, weights)))

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        self.pairs.append(np.stack([a, b]))
        self.held += len(a)
        if self.held >= _HELD:
            self.fold()

    def fold(self) -> None:
        """Points joined by the pairs held get the smallest label among them."""
        if not self.pairs:
            return
        a, b = self.label[np.concatenate(self.pairs, axis=1)]
        self.pairs, self.held = [], 0
        while (apart := a != b).any():
            a, b = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            up = np.arange(len(self.label))
            np.minimum.at(up, b, a)
            while not np.array_equal(further := up[up], up):
                up = further
            self.label, a, b = up[self.label], up[a], up[b]

    def add(self, a: np.ndarray, b: np.ndarray, sides: tuple[int, int]) -> None:
        np.add.at(self.counts[sides[0]], a, self.weights[sides[1]][b])
        np.add.at(self.counts[sides[1]], b, self.weights[sides[0]][a])
        self._join(a + self.shift * sides[0], b + self.shift * sides[1])

    def add_all(self, a: np.ndarray, b: np.ndarray, sides: tuple[int, int]) -> None:
        """All of ``a`` with all of ``b``; a spanning set of pairs joins them."""
        self.counts[sides[0]][a] += self.weights[sides[1]][b].sum()
        self.counts[sides[1]][b] += self.weights[sides[0]][a].sum()
        self._join(a + self.shift * sides[0], np.full(len(a), b[0] + self.shift * sides[1]))
        self._join(np.full(len(b), a[0] + self.shift * sides[0]), b + self.shift * sides[1])

    def add_within(self, a: np.ndarray) -> None:
        """All of ``a``, of the first side, with each other."""
        weights = self.weights[0][a]
        self.counts[0][a] += weights.sum() - weights
        self._join(a, np.full(len(a), a[0]))

    def roots(self, ids: np.ndarray) -> np.ndarray:
        """For each point of both sides the smallest id it is joined with here."""
        self.fold()
        least = ids.copy()
        np.minimum.at(least, self.label, ids)
        return least[self.label]


def _near_roots(a: Tree, b: Tree, start: int, limit: float, same: bool) -> np.ndarray:
    """Pairs of a block of roots of ``a`` and a root of ``b`` that can hold links, and some more.

    Unrelated vectors are roots of their own, so this is where the work grows with their
    square. Cosines in single precision are compared with bounds that allow for its errors;
    the pairs that are left are computed again in double precision.
    """
    top = len(RADII)
    radius = a.radius[top][start : start + _ROOTS]
    begin = start if same else 0  # within one tree each pair comes once
    reach = b.radius[top][begin:] + limit + _ROUNDING
    slack = np.finfo(np.float32).eps * (a.points.shape[1] + 8)
    least = lambda r: (1.0 - r * r / 2.0 - slack).astype(np.float32)
    cos = a.points[a.centers[top][start : start + _ROOTS]].astype(np.float32) @ b.points[b.centers[top][begin:]].astype(np.float32).T
    near = cos >= least(reach)
    wide = np.flatnonzero(radius > 0)
    near[wide] = cos[wide] >= least(radius[wide, None] + reach)
    if same:
        near &= np.arange(len(radius))[:, None] <= np.arange(len(reach))
    x, y = np.nonzero(near)
    return np.stack([x + start, y + begin])


def traverse(a: Tree, b: Tree, cosine: float, links: Links, same: bool) -> None:
    """Find all linked pairs of points of two trees, or within one (``same``)."""
    limit = float(_distance(np.float64(cosine)))
    sides = (0, 0) if same else (0, 1)
    top = len(RADII)
    starts = [_near_roots(a, b, i, limit, same) for i in range(0, len(a.centers[top]), _ROOTS)]
    first = np.concatenate(starts, axis=1) if starts else np.empty((2, 0), np.int64)
    # parts of pairs come one at a time, so that few are held at each level
    stack = [(top, iter(np.array_split(first, first.shape[1] // _OPENED + 1, axis=1)))]
    while stack:
        level, parts = stack[-1]
        pairs = next(parts, None)
        if pairs is None:
            stack.pop()
            continue
        x, y = pairs
        cos = np.einsum("ij,ij->i", a.points[a.centers[level][x]], b.points[b.centers[level][y]])
        if level == 0:
            keep = cos >= cosine
            if same:
                keep &= x != y
            if keep.any():
                links.add(x[keep], y[keep], sides)
            continue
        d, reach = _distance(cos), a.radius[level][x] + b.radius[level][y]
        own = (x == y) if same else np.zeros(len(x), bool)
        whole = d + reach < limit - _ROUNDING
        # single points are linked all at once, and none with itself
        many = (a.sizes[level][x] > 1) | (b.sizes[level][y] > 1)
        single = whole & ~many & ~own
        if single.any():
            links.add(a.centers[level][x[single]], b.centers[level][y[single]], sides)
        for i in np.flatnonzero(whole & many):
            if own[i]:
                links.add_within(a.members[level][x[i]])
            else:
                links.add_all(a.members[level][x[i]], b.members[level][y[i]], sides)
        opened = np.flatnonzero(~whole & (d <= reach + limit + _ROUNDING))
        if not len(opened):
            continue
        stack.append((level - 1, _children(a, b, level, x[opened], y[opened], own[opened])))


def _children(a: Tree, b: Tree, level: int, x: np.ndarray, y: np.ndarray, own: np.ndarray) -> Iterator[np.ndarray]:
    """All pairs of a child of ``x`` and one of ``y``, in parts; within a node each pair once."""
    (row_a, first_a, count_a), (row_b, first_b, count_b) = a.children[level], b.children[level]
    wide = count_b[y]
    # a part has some children of x, so that a node of many children does not fill the memory
    rows = np.repeat(np.arange(len(x)), count_a[x])
    child = row_a[np.arange(len(rows)) - np.repeat(np.cumsum(count_a[x]) - count_a[x] - first_a[x], count_a[x])]
    ends = np.cumsum(wide[rows])
    start = 0
    while start < len(rows):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + _OPENED, "right")))
        some = rows[start:stop]
        repeats = wide[some]
        p = np.repeat(child[start:stop], repeats)
        within = np.arange(len(p)) - np.repeat(np.cumsum(repeats) - repeats, repeats)
        q = row_b[np.repeat(first_b[y[some]], repeats) + within]
        keep = ~np.repeat(own[some], repeats) | (p <= q)
        yield np.stack([p[keep], q[keep]])
        start = stop


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _to_pivots(pivots: np.ndarray):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                d = _distance(unit(_matrix(part.column(2))) @ pivots.T)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(near, pa.int64()), pa.array(d[np.arange(len(d)), near])],
                    ["rep", "weight", "v", "pivot", "far"],
                )

    return work


def _visits(pivots: np.ndarray, reach: np.ndarray, firsts: np.ndarray, limit: float):
    """Adds the parts of other cells, of a smaller number, that a vector can have links in."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                d = _distance(unit(_matrix(part.column(2))) @ pivots.T)
                can = d <= reach[None, :] + limit + _ROUNDING
                own = part.column(3).to_numpy()
                found = []
                for i in range(len(d)):
                    cells = np.flatnonzero(can[i])
                    ranges = [np.arange(firsts[c], min(firsts[c + 1], own[i])) for c in cells if firsts[c] < own[i]]
                    found.append(np.concatenate(ranges) if ranges else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.list_(pa.int64()))], ["rep", "weight", "v", "part", "visits"]
                )

    return work


def _joined(cosine: float):
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("owner", "descending"), ("rep", "ascending")])
        owner, ids = table.column("owner").to_numpy(zero_copy_only=False), table.column("rep").to_numpy()
        weights, points = table.column("weight").to_numpy(), unit(_matrix(table.column("v")))
        n = int(owner.sum())
        links = Links([weights[:n], weights[n:]])
        if n:
            own = Tree.over(points[:n])
            if table.column("block")[0].as_py() == 0:
                traverse(own, own, cosine, links, same=True)
            if n < len(ids):
                traverse(own, Tree.over(points[n:]), cosine, links, same=False)
        counts, roots = np.concatenate(links.counts), links.roots(ids)
        some = (counts > 0) | (roots != ids)
        return pa.table({"rep": ids[some], "n": counts[some], "root": roots[some]})

    return work


def _links_of(classes: DataFrame, cosine: float) -> DataFrame:
    """Rows (rep, n, root) from all tasks; all vectors of ``classes`` (rep, weight, v) have one length."""
    count = classes.count()
    pivots = unit(
        np.array(
            [
                r["v"]
                for r in classes.orderBy(F.xxhash64("rep"), "rep").limit(min(MAX_PIVOTS, -(-count // CELL))).collect()
            ]
        )
    )
    celled = stored(
        classes.mapInArrow(_to_pivots(pivots), "rep long, weight long, v array<double>, pivot long, far double"), "cells"
    )
    cells = {r["pivot"]: r for r in celled.groupBy("pivot").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    reach = np.array([cells[p]["far"] if p in cells else -np.inf for p in range(len(pivots))])
    splits = [-(-cells[p]["n"] // CELL) if p in cells else 0 for p in range(len(pivots))]
    firsts = np.concatenate([[0], np.cumsum(splits)])
    # at most MAX_PIVOTS rows
    numbers = classes.sparkSession.createDataFrame(
        [(p, int(firsts[p]), int(splits[p])) for p in range(len(pivots)) if splits[p]], "pivot long, first long, parts long"
    )
    placed = celled.join(F.broadcast(numbers), "pivot").select(
        "rep", "weight", "v", (F.col("first") + F.pmod(F.xxhash64("rep"), F.col("parts"))).alias("part")
    )
    limit = float(_distance(np.float64(cosine)))
    placed = stored(
        placed.mapInArrow(
            _visits(pivots, reach, firsts, limit), "rep long, weight long, v array<double>, part long, visits array<long>"
        ),
        "visits",
    )
    visits = placed.select(F.explode("visits").alias("part"), "rep", "weight", "v")
    blocks = visits.groupBy("part").agg(F.ceil(F.count("*") / CELL).alias("blocks"))
    owners = (
        placed.join(blocks, "part", "left")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)).cast("int") - 1)))
        .select("part", "block", F.lit(True).alias("owner"), "rep", "weight", "v")
    )
    guests = visits.join(blocks, "part").select(
        "part", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"), F.lit(False).alias("owner"), "rep", "weight", "v"
    )
    return owners.unionByName(guests).groupBy("part", "block").applyInArrow(_joined(cosine), "rep long, n long, root long")


def embedding_links(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """One row per row of ``vectors`` (``vec_id``, ``embedding``): links, component, and whether it is kept.

    ``n_links`` counts the other vectors with a cosine of at least ``cosine``, in double
    precision; ``component_id`` is the smallest ``vec_id`` reachable by links, and its row is
    ``kept``. Vectors that are null, empty, zero or hold null or non-finite components are
    linked with nothing, as are vectors of different lengths. A null ``vec_id`` is linked
    with nothing, its component is null, and it is kept. Repeated rows are vectors of their
    own and count as links of each other. Other columns are ignored.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = stored(rows.withColumn("v", F.when(fine & F.col("vec_id").isNotNull(), F.col("v"))), "vectors")
    classes = stored(
        rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")).select("rep", "weight", "v"),
        "classes",
    )
    # lengths that fill more than a task have cells of their own; each of the others, however many, is one task
    lengths = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).where(F.col("n") > CELL)
    wide = sorted(r["d"] for r in lengths.collect())
    others = classes.where(~F.size("v").isin(wide)) if wide else classes
    small = others.select(F.size("v").alias("part"), F.lit(0).alias("block"), F.lit(True).alias("owner"), "rep", "weight", "v")
    found = stored(small.groupBy("part", "block").applyInArrow(_joined(cosine), "rep long, n long, root long"), "joined")
    for size in wide:
        found = found.unionByName(stored(_links_of(classes.where(F.size("v") == size), cosine), "joined"))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = components(found, "rep", "root", "vectors")
    named = (
        classes.join(counts, "rep", "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            "v",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component"),
        )
    )
    return rows.join(named, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
