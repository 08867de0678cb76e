from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerloom.llm import covertree

ROWS = "vec_id long, embedding array<float>, label int, rep long, v string"


def table():
    draw = np.random.default_rng(3)
    near = draw.normal(size=8)
    vectors = [draw.normal(size=8) for _ in range(120)]
    vectors += [near + draw.normal(size=8) * s for s in draw.uniform(0, 0.6, 150)]
    vectors += [near + draw.normal(size=8) * 1e-4 for _ in range(40)]  # linked as a whole
    vectors += [draw.normal(size=8) * 3] * 9  # equal
    vectors += [np.array(v) * 2 for v in vectors[:5]]  # of one direction
    rows = [[float(np.float32(x)) for x in v] for v in vectors]
    rows += [None, [], [0.0] * 8, [math.nan] * 8, [math.inf] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 0.0], [1.0, 0.1], [2.0, 0.0]]
    rows += [[1e38] * 8, [1e-38] * 8]
    return [(3 * i + 2, v, i % 3, 1, "x") for i, v in enumerate(rows)]


def brute(rows, cosine):
    fine = {i: np.array(v, float) for i, v, *_ in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: set() for i, *_ in rows}
    for i, a in fine.items():
        for j, b in fine.items():
            if i != j and len(a) == len(b):
                a1, b1 = a / abs(a).max(), b / abs(b).max()
                if a1 @ b1 / math.sqrt(a1 @ a1) / math.sqrt(b1 @ b1) >= cosine:
                    links[i].add(j)
    root = {}
    for i in sorted(links):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo += links[x]
    return sorted((i, len(links[i]), root[i], root[i] == i) for i in links)


@pytest.mark.parametrize("cell", [6000, 40])
def test_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(covertree, "CELL", cell)
    got = covertree.embedding_links(spark.createDataFrame(table(), ROWS).repartition(3)).collect()
    assert sorted(map(tuple, got)) == brute(table(), 0.9)


def test_trees_cover_and_nest():
    points = covertree.unit(np.random.default_rng(1).normal(size=(300, 4)))
    tree = covertree.Tree.over(points)
    for level in range(1, len(covertree.RADII) + 1):
        assert set(tree.centers[level]) <= set(tree.centers[level - 1])
        assert sorted(np.concatenate(tree.members[level])) == list(range(300))
        for center, radius, members in zip(tree.centers[level], tree.radius[level], tree.members[level], strict=True):
            assert np.linalg.norm(points[members] - points[center], axis=1).max() <= radius + 1e-7


def test_one_dense_cluster_is_held_by_point(monkeypatch):
    """Points that are all linked but too far apart to be one node."""
    draw = np.random.default_rng(5)
    points = covertree.unit(1 + 0.29 * draw.normal(size=(1500, 64)))
    cosines = points @ points.T
    assert 0.9 < np.median(cosines) < 0.94
    monkeypatch.setattr(covertree, "_HELD", 1 << 12)
    held = []
    fold = covertree.Links.fold
    monkeypatch.setattr(covertree.Links, "fold", lambda self: (held.append((len(self.pairs), self.held)), fold(self))[1])
    links = covertree.Links([np.ones(1500, np.int64), np.empty(0, np.int64)])
    tree = covertree.Tree.over(points)
    covertree.traverse(tree, tree, 0.9, links, same=True)
    near = cosines >= 0.9
    assert links.counts[0].tolist() == (near.sum(axis=1) - 1).tolist()
    assert near.sum() > 1_000_000 and max(n for _, n in held) <= covertree._HELD + covertree._OPENED + 1500
    assert sum(n for n, _ in held) < 5000
    ids = draw.permutation(1500)
    assert set(links.roots(ids)) == {0}


def test_labels_are_components():
    draw = np.random.default_rng(2)
    links = covertree.Links([np.ones(400, np.int64), np.ones(200, np.int64)])
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 600, (330, 2))]
    for a, b in pairs:
        links._join(np.array([a]), np.array([b]))
        if a % 50 == 0:
            links.fold()
    ids = draw.permutation(600)
    least = {i: int(ids[i]) for i in range(600)}
    for _ in range(600):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert links.roots(ids).tolist() == [least[i] for i in range(600)]


@pytest.mark.parametrize("cell", [6000, 3])
def test_many_lengths(spark, monkeypatch, cell):
    monkeypatch.setattr(covertree, "CELL", cell)
    lengths = [*range(1, 71), 70, 70, 69]
    rows = [(i, [1.0] * n + [0.5 * (i % 2)], 0, 1, "x") for i, n in enumerate(lengths)]
    got = covertree.embedding_links(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 0.9)


def test_odd_rows(spark):
    rows = [(None, [1.0, 0.0], 1, 1, "x"), (4, [1.0, 0.0], 1, 1, "x"), (4, [1.0, 0.0], 1, 1, "x")]
    got = covertree.embedding_links(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted(map(tuple, got), key=str) == [(4, 1, 4, True), (4, 1, 4, True), (None, 0, None, True)]
    assert covertree.embedding_links(spark.createDataFrame([], ROWS)).collect() == []


@pytest.mark.parametrize("same", [True, False])
def test_unrelated_roots_are_told_apart_without_distances(monkeypatch, same):
    draw = np.random.default_rng(8)
    points = covertree.unit(draw.normal(size=(3000, 64)))
    points[::7] = covertree.unit(points[1::7][: len(points[::7])] + 0.05 * draw.normal(size=(len(points[::7]), 64)))
    points[2] = points[5] * 0.9 + covertree.unit(points[6:7] - (points[6] @ points[5]) * points[5])[0] * np.sqrt(0.19)
    a, b = (points, points) if same else (points[::2], points[1::2])
    one = covertree.Tree.over(a)
    other = one if same else covertree.Tree.over(b)
    links = covertree.Links([np.ones(len(a), np.int64), np.ones(0 if same else len(b), np.int64)])
    distance, computed = covertree._distance, []
    monkeypatch.setattr(covertree, "_distance", lambda cos: (computed.append(np.size(cos)), distance(cos))[1])
    covertree.traverse(one, other, 0.9, links, same=same)
    near = a @ b.T >= 0.9
    assert links.counts[0].tolist() == (near.sum(axis=1) - same).tolist() and near.sum() > same * len(a) + 100
    assert sum(computed) < len(a) * len(b) / 10
