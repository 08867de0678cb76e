from __future__ import annotations

import itertools
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerloom.llm import filteraudit as A
from tests.llm.fixtures import DOCS, empty, odd_table

LABELS = "doc_id long, quality int, toxic int, part string"


def failing(rows: list[tuple]) -> list[set[str]]:
    first: dict[str, int] = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append(
            {
                name
                for name, failed in {
                    "A": len(words) < 200,
                    "B": 100 * len(set(words)) < 50 * len(words),
                    "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                    "D": re.search(r"[#$%&*|]", text) is not None,
                    "E": i is not None and i > first[text],
                }.items()
                if failed
            }
        )
    return out


def plain(rows: list[tuple], labels: list[tuple]) -> list[tuple]:
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails, out = failing(rows), []
    for part in {s or "" for _, _, s in rows}:
        own = [(i, f) for (i, _, s), f in zip(rows, fails, strict=True) if (s or "") == part]
        found, shapley = [], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shapley[name] += len(gone)
                earlier = sum(name in f for _, f in own) - len(gone)
                alone = sum(f == {name} for _, f in own)
                found.append((part, order, step, len(left), len(gone), earlier, alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in found]
    return sorted(out)


def rows() -> list[tuple]:
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6)))
    out = []
    for i in range(160):
        pool = [word() for _ in range(draw.choice([20, 400]))]
        text = draw.choice([" ", "\n", "\x0b\x0c "]).join(draw.choice(pool) for _ in range(draw.choice([5, 199, 200, 260])))
        text += draw.choice(["", "", " $ 5", " a|b"]) + draw.choice(["", "X" * draw.choice([3, 80])])
        out.append((i, text, draw.choice(["web", "wiki", "", None])))
    out += [(300 + i, out[i % 4][1], "web") for i in range(30)] + [(2, out[2][1], "wiki")]  # copies, and one of the first id
    out += [(400, None, "s"), (401, "", "s"), (None, out[1][1], "s"), (None, None, None), (402, "a\0b \x85 " * 300, "s"), (403, "A" * 2 + "b" * 98, "s")]
    return out


def test_against_all_orders(spark):
    table = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows()], DOCS).repartition(3)
    labels = [(i, i % 2, i % 3 % 2) for i in range(0, 400, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (6, None, None), (999, 1, 1)]
    tags = spark.createDataFrame([(*r, "x") for r in labels], LABELS)
    got = A.audit_filters(table.withColumns({"part": F.lit(1), "mask": F.lit(2), "n": F.lit(3), "digest": F.lit(4)}), tags)
    assert sorted(map(tuple, got.collect())) == plain(rows(), labels)


def test_long_texts_are_cut_at_white_space(monkeypatch):
    draw = random.Random(9)
    text = "".join(draw.choice(["wörter ", "a", "B\t", "c d\n", "é"]) for _ in range(4000))
    want = A.text_mask(text.encode(), len(text))
    for size in (1, 7, 1000):
        monkeypatch.setattr(A, "_PIECE", size)
        assert A.text_mask(text.encode(), len(text)) == want
        assert [w for p in A._pieces(text.encode()) for w in p.split()] == text.encode().split()


def test_swaps_lead_through_all_orders():
    for n in range(1, 7):
        order = list(range(n))
        seen = {tuple(order)}
        for i in A.adjacent_swaps(n):
            order[i : i + 2] = order[i + 1], order[i]
            seen.add(tuple(order))
        assert len(seen) == len(A.adjacent_swaps(n)) + 1 == len(list(itertools.permutations(range(n))))


def test_swapped_diagram_is_that_of_the_order():
    """After any swaps the diagram has the nodes that one built in that order has."""
    draw = random.Random(1)
    counts = {m: (draw.choice([0, 0, 3, 5]), 1, 0) for m in range(16)}
    diagram = A.Diagram("wxyz", counts)
    for place in A.adjacent_swaps(4):
        diagram.swap(place)
        moved = {}
        for mask, weight in counts.items():
            moved[sum((mask >> "wxyz".index(f) & 1) << i for i, f in enumerate(diagram.order))] = weight
        fresh = A.Diagram("".join(diagram.order), moved)

        def unfolded(d, node):
            name, *below = d.nodes[node]
            return (name, d.weights[node], *(unfolded(d, b) for b in below if isinstance(b, int)))

        assert unfolded(diagram, diagram.root) == unfolded(fresh, fresh.root)
        assert len(reached(diagram)) == len(reached(fresh))


def reached(diagram) -> set[int]:
    todo, seen = [diagram.root], set()
    while todo:
        node = todo.pop()
        if node not in seen:
            seen.add(node)
            todo += [b for b in diagram.nodes[node][1:] if isinstance(b, int)]
    return seen


def test_odd_and_empty_tables(spark):
    odd = odd_table(spark)
    none = spark.createDataFrame([], LABELS)
    got = sorted(map(tuple, A.audit_filters(odd, none).collect()))
    assert got == plain([(r.doc_id, r.text, r.source) for r in odd.collect()], [])
    assert A.audit_filters(empty(spark), none).collect() == []
